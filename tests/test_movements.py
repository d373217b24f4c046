"""Movement events: the reference's hire / transfer / termination cases."""

from tidemark.operators.movements import movements

KEYS, TRACKED = ["employee_id"], ["department_id", "role_id"]


def hc(spark, rows):
    return spark.createDataFrame(rows, "employee_id string, department_id string, role_id string, period string")


def ev(df):
    return sorted((tuple(r) for r in df.select(
        "employee_id", "period", "event_type", "from_department_id", "department_id",
        "from_role_id", "role_id").collect()),
                  key=lambda t: tuple("" if x is None else str(x) for x in t))


def test_first_appearance_is_hire(spark):
    out = ev(movements(hc(spark, [("E1", "D1", "R1", "2025-01")]), KEYS, "period", TRACKED))
    assert out == [("E1", "2025-01", "HIRE", None, "D1", None, "R1")]


def test_department_change_is_transfer(spark):
    out = ev(movements(hc(spark, [("E1", "D1", "R1", "2025-01"), ("E1", "D2", "R1", "2025-02")]),
                       KEYS, "period", TRACKED))
    assert ("E1", "2025-02", "TRANSFER", "D1", "D2", "R1", "R1") in out


def test_role_change_is_transfer(spark):
    out = ev(movements(hc(spark, [("E1", "D1", "R1", "2025-01"), ("E1", "D1", "R2", "2025-02")]),
                       KEYS, "period", TRACKED))
    assert [e for e in out if e[2] == "TRANSFER"] == [("E1", "2025-02", "TRANSFER", "D1", "D1", "R1", "R2")]


def test_absence_is_termination_dated_next_period(spark):
    out = ev(movements(hc(spark, [("E1", "D1", "R1", "2025-01"), ("E2", "D1", "R1", "2025-01"),
                                  ("E2", "D1", "R1", "2025-02")]), KEYS, "period", TRACKED))
    assert ("E1", "2025-02", "TERMINATION", "D1", None, "R1", None) in out
    assert not [e for e in out if e[0] == "E2" and e[2] == "TERMINATION"]


def test_combined_three_keys_three_periods(spark):
    rows = [("E1", "D1", "R1", "2025-01"), ("E1", "D1", "R1", "2025-02"), ("E1", "D1", "R1", "2025-03"),
            ("E2", "D1", "R1", "2025-01"), ("E2", "D2", "R1", "2025-02"), ("E2", "D2", "R1", "2025-03"),
            ("E3", "D1", "R1", "2025-01"), ("E3", "D1", "R1", "2025-02")]
    out = ev(movements(hc(spark, rows), KEYS, "period", TRACKED))
    kinds = [e[2] for e in out]
    assert kinds.count("HIRE") == 3 and kinds.count("TRANSFER") == 1 and kinds.count("TERMINATION") == 1


def test_null_change_options_and_rehire(spark):
    rows = [("E1", "D1", "R1", "2025-01"), ("E1", None, "R1", "2025-02"),
            ("E2", "D1", "R1", "2025-02"),
            ("E1", None, "R1", "2025-04"), ("E2", "D1", "R1", "2025-03"), ("E2", "D1", "R1", "2025-04")]
    default = ev(movements(hc(spark, rows), KEYS, "period", TRACKED))
    assert not [e for e in default if e[2] == "TRANSFER"]            # null change ignored
    assert not [e for e in default if e[0] == "E1" and e[1] == "2025-04"]  # return: no hire
    safe = ev(movements(hc(spark, rows), KEYS, "period", TRACKED, null_safe=True, rehire=True))
    assert ("E1", "2025-02", "TRANSFER", "D1", None, "R1", "R1") in safe
    assert ("E1", "2025-04", "HIRE", None, None, None, "R1") in safe
    # with rehire, hires - terminations = net change of headcount per period
    from collections import Counter
    net = Counter()
    for e in safe:
        net[e[1]] += 1 if e[2] == "HIRE" else (-1 if e[2] == "TERMINATION" else 0)
    per = Counter(r[3] for r in rows)
    periods = sorted(per)
    for a, b in zip(periods, periods[1:]):
        assert net[b] == per[b] - per[a]


def test_the_shuffle_by_key_is_not_merged_to_few_tasks(spark):
    # The rows are few, so AQE would merge them to a task or two; what a task
    # holds (window, the counts above it) must not depend on that.
    rows = [(f"E{i}", "D1", f"R{i % 3}", f"2025-0{1 + j}") for i in range(40) for j in range(1 + i % 4)]
    out = movements(hc(spark, rows), KEYS, "period", TRACKED)
    cores = spark.sparkContext.defaultParallelism
    assert out.rdd.getNumPartitions() >= max(8, 4 * cores)
    assert sorted((e[0], e[1]) for e in ev(out) if e[2] == "HIRE") == sorted((f"E{i}", "2025-01") for i in range(40))
    assert sorted((e[0], e[1]) for e in ev(out) if e[2] == "TERMINATION") == sorted(
        (f"E{i}", f"2025-0{2 + i % 4}") for i in range(40) if i % 4 < 3)
