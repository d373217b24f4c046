"""Sinks and guards (S7-S15) and the snapshot export."""

from tidemark.functions.periods import period_from_path
from tidemark.session import cluster_conf
from tidemark.sources.landing import export_snapshot, read_landing
from tidemark.sources.tables import (
    append_once,
    empty_frame,
    read_table,
    register_views,
    table_exists,
    write_new,
)


def test_export_then_read_back(spark, tmp_path):
    base = str(tmp_path / "landing")
    snap = spark.createDataFrame([("D1", "Ops", "C1", None), ("D2", "HR", None, None)],
                                 "department_id string, name string, cost_centre string, "
                                 "parent_department_id string")
    path = export_snapshot(snap, base, "departments", "2025-04")
    assert path.endswith("/2025-04/departments")
    back = read_landing(spark, base, "departments")
    assert back.count() == 2
    # the all-null column is missing from the files but declared, so present
    assert "parent_department_id" in back.columns
    assert {r[0] for r in back.select(period_from_path("_source_file_name")).collect()} == {"2025-04"}


def test_versions_append_once_and_guards(spark, tmp_path):
    root = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    p1, p2 = write_new(df, root), write_new(df, root)
    assert p1 != p2 and read_table(spark, p1).count() == 2 and table_exists(spark, p2)
    assert not table_exists(spark, str(tmp_path / "nope"))
    target = str(tmp_path / "once")
    assert append_once(df, target, ["k"]) == 2
    assert append_once(df, target, ["k"]) == 0           # re-run adds nothing
    more = spark.createDataFrame([(2, "b"), (3, "c")], "k int, v string")
    assert append_once(more, target, ["k"]) == 1
    assert read_table(spark, target).count() == 3
    register_views({"once_view": read_table(spark, target)})
    assert spark.sql("SELECT count(*) FROM once_view").first()[0] == 3
    assert empty_frame(spark, df.schema).count() == 0


def test_cluster_conf_sizes_partitions():
    c = cluster_conf(10 * 1024 ** 4, total_cores=800)
    assert int(c["spark.sql.shuffle.partitions"]) == 40960
    assert int(cluster_conf(1024 ** 3, total_cores=800)["spark.sql.shuffle.partitions"]) == 2400
