"""Type-2 history kept in a stream's state equals the one-pass replay."""

import json
import os
import random

import pytest

from tidemark.functions.periods import period_from_path
from tidemark.operators.dedup import latest_per_key
from tidemark.operators.scd2 import replay_snapshots
from tidemark.sources.landing import NEWEST, read_landing
from tidemark.streaming.history import compact, maintain_dimension, stored_dimension

KEYS, TRACKED = ["department_id"], ["name", "cost_centre", "parent_department_id"]
COLUMNS = KEYS + TRACKED + ["__START_AT", "__END_AT"]


def put(base, period, rows, name="part-0.json", at=None):
    d = f"{base}/{period}/departments"
    os.makedirs(d, exist_ok=True)
    with open(f"{d}/{name}", "w") as f:
        for r in rows:
            f.write(json.dumps(r) + "\n")
    if at is not None:
        os.utime(f"{d}/{name}", (at, at))


def replayed(spark, base):
    bronze = read_landing(spark, base, "departments").where("department_id IS NOT NULL") \
        .withColumn("period", period_from_path("_source_file_name")).where("period IS NOT NULL")
    return replay_snapshots(latest_per_key(bronze, KEYS + ["period"], NEWEST), KEYS, TRACKED, "period")


def rows_of(df):
    return sorted((tuple("" if x is None else str(x) for x in r) for r in df.select(COLUMNS).collect()))


def run(spark, base, root, **options):
    return maintain_dimension(spark, base, "departments", f"{root}/dim", f"{root}/checkpoint", KEYS, buckets=3, **options)


def test_stream_emits_what_changes(spark, tmp_path):
    base, root = str(tmp_path / "landing"), str(tmp_path)
    snaps = {
        "2025-01": [{"department_id": "D1", "name": "A"}, {"department_id": "D2", "name": "B"}, {"department_id": "D4", "name": "D"}],
        "2025-02": [{"department_id": "D1", "name": "A2"}, {"department_id": "D3", "name": "C"}, {"department_id": "D4", "name": "D"}],
        "2025-03": [{"department_id": "D1", "name": "A2"}, {"department_id": "D2", "name": "B"},
                    {"department_id": "D4", "name": "D"}, {"department_id": None, "name": "junk"}],
    }
    for p, rows in snaps.items():           # one period lands per run
        put(base, p, rows)
        dim = run(spark, base, root)
        assert rows_of(stored_dimension(spark, dim)) == rows_of(replayed(spark, base))
    # February: D1 and D2 close (an open version each is void), D1 and D3 open
    feb = spark.read.parquet(f"{dim}/changes").where("batch = '1'")
    assert {(r["department_id"], r["__START_AT"], r["__END_AT"], r["_sign"]) for r in feb.collect()} == {
        ("D1", "2025-01", None, -1), ("D1", "2025-01", "2025-02", 1), ("D1", "2025-02", None, 1),
        ("D2", "2025-01", None, -1), ("D2", "2025-01", "2025-02", 1), ("D3", "2025-02", None, 1)}
    run(spark, base, root)                   # nothing new: no batch
    assert spark.read.parquet(f"{dim}/changes").select("batch").distinct().count() == 3


def test_a_run_reads_new_files_only(spark, tmp_path):
    """Files taken up are not opened again: they may be gone."""
    base, root = str(tmp_path / "landing"), str(tmp_path)
    put(base, "2025-01", [{"department_id": "D1", "name": "A"}, {"department_id": "D2", "name": "B"}])
    run(spark, base, root)
    os.remove(f"{base}/2025-01/departments/part-0.json")
    put(base, "2025-02", [{"department_id": "D1", "name": "A"}])
    dim = run(spark, base, root)
    assert rows_of(stored_dimension(spark, dim)) == [
        ("D1", "A", "", "", "2025-01", ""), ("D2", "B", "", "", "2025-01", "2025-02")]


@pytest.mark.parametrize("seed", [1, 2])
def test_stream_equals_replay_in_any_order(spark, tmp_path, seed):
    """Late periods, periods in parts, corrections, older files after newer ones,
    a file without rows and one without a period, in a random order of runs."""
    rng, base, root = random.Random(seed), str(tmp_path / "landing"), str(tmp_path)
    files = []
    for period in ("2025-01", "2025-02", "2025-03", "2025-04"):
        for part in range(2):
            rows = [{"department_id": f"D{i}", "name": rng.choice("AB"), "cost_centre": rng.choice([None, "C"])}
                    for i in range(part, 12, 2) if rng.random() < .8]
            files.append((period, rows, f"part-{part}.json"))
        fixes = [{"department_id": f"D{rng.randint(0, 11)}", "name": "fixed"} for _ in range(2)]
        files.append((period, fixes, "fix.json"))
    files += [("2025-05", [], "empty.json"), ("2025-06", [{"department_id": None, "name": "x"}], "nokey.json"),
              ("none", [{"department_id": "D1", "name": "x"}], "noperiod.json")]
    files = [(*f, 1_700_000_000 + i) for i, f in enumerate(rng.sample(files, len(files)))]
    rng.shuffle(files)
    for i in range(0, len(files), 4):
        for period, rows, name, at in files[i:i + 4]:
            put(base, period, rows, name, at)
        dim = run(spark, base, root)
        if i == 8:
            before = rows_of(stored_dimension(spark, dim))
            compact(spark, dim)
            assert rows_of(stored_dimension(spark, dim)) == before
    assert rows_of(stored_dimension(spark, dim)) == rows_of(replayed(spark, base))


def test_a_batch_run_again_replaces_its_output(spark, tmp_path):
    """A crash between a batch's output and its commit: the batch runs again."""
    base, root = str(tmp_path / "landing"), str(tmp_path)
    put(base, "2025-01", [{"department_id": "D1", "name": "A"}])
    run(spark, base, root)
    put(base, "2025-02", [{"department_id": "D1", "name": "B"}])
    dim = run(spark, base, root)
    want = rows_of(stored_dimension(spark, dim))
    for name in ("1", ".1.crc"):
        os.remove(f"{root}/checkpoint/commits/{name}")
    run(spark, base, root)
    assert rows_of(stored_dimension(spark, dim)) == want == rows_of(replayed(spark, base))
