"""The plans of the registered queries: pushdown, pruning, no Python, no cross joins, skew."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import propgraph as pg
from propgraph.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
# Queries that write tables while they are built; their results are plain scans.
WRITING = ("insert", "upsert", "overwrite", "delete", "stored", "types_", "duration_",
           "dangling", "drop_property", "drop_types_of_store", "compacted")


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def scans(plan: str) -> list[str]:
    return [line for line in plan.splitlines() if "FileScan" in line]


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(WRITING)))
def test_no_python_and_no_cross_joins(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF_DIR))
    assert "Python" not in plan and "Pandas" not in plan and "ArrowEval" not in plan
    assert "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("name, pushed", [
    ("f_and", "GreaterThanOrEqual(c_acctbal,1000.0)"), ("f_or", "Or(Or(EqualTo(p_size,43),EqualTo(p_size,39)),EqualTo(p_size,99))"),
    ("f_not", "Not(EqualTo(c_mktsegment,BUILDING))"), ("f_ne", "Not(EqualTo(o_orderstatus,F))"),
    ("f_eq_string", "EqualTo(p_name,small ring)"), ("f_eq_number", "EqualTo(p_size,20)"),
    ("f_eq_timestamp", "EqualTo(o_orderdate,1999-02-02T00:00)"), ("f_gt", "GreaterThan(p_size,20)"),
    ("f_ge", "GreaterThanOrEqual(p_size,20)"), ("f_lt", "LessThan(p_size,20)"), ("f_le", "LessThanOrEqual(p_size,20)"),
    ("f_gt_date", "GreaterThan(o_orderdate,1999-01-01T00:00)"), ("f_in_number", "In(p_size, [41,43])"),
    ("f_in_string", "In(c_mktsegment, [BUILDING,FURNITURE])"), ("f_contains", "StringContains(p_name,mal)"),
    ("f_starts_with", "StringStartsWith(p_name,small)"), ("f_ends_with", "StringEndsWith(p_name,ring)"),
    ("f_in_date", "GreaterThanOrEqual(o_orderdate,1999-02-02T00:00)"), ("f_is_not_null", "IsNotNull(c_acctbal)"), ("f_concept_and_prop", "GreaterThan(c_acctbal,10.0)"),
    ("match_label_prop", "EqualTo(c_mktsegment,BUILDING)"), ("f_contains_text", "StringContains(text,the)"),
])
def test_filters_reach_the_tables(spark, name, pushed):
    assert pushed in plan_of(entry.queries()[name](spark, SF_DIR)), plan_of(entry.queries()[name](spark, SF_DIR))


@pytest.mark.parametrize("name, tables, read", [
    ("f_concept_and_prop", 1, "struct<c_custkey:bigint,c_acctbal:double>"), ("f_gt", 1, "struct<p_partkey:bigint,p_size:int>"),
    ("f_label", 1, "struct<o_orderkey:bigint,o_custkey:bigint>"), ("match_label", 1, "struct<p_name:string,p_brand:string,p_size:int>"),
    ("f_in_reserved", 3, "struct<n_nationkey:int>"),
])
def test_only_the_tables_and_columns_needed_are_read(spark, name, tables, read):
    found = scans(plan_of(entry.queries()[name](spark, SF_DIR)))
    assert len(found) == tables
    assert any(read in scan for scan in found)


def test_plain_scans_have_no_shuffle_but_for_distinct_users(spark):
    plan = plan_of(entry.queries()["vertex_scan"](spark, SF_DIR))
    assert plan.count("Exchange") == 1


def test_hot_vertices_are_split_by_the_join(spark):
    """A third of all edges start at one vertex; no task gets them all."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        start = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000)
        edges = spark.range(0, 60_000, 1, 16).select(
            F.concat(F.lit("e"), "id").alias("_id"), F.lit("knows").alias("_edgeLabel"),
            start.cast("string").alias("_sid"), F.lit("1").alias("_did"),
        )
        vertices = spark.range(1000).select(F.col("id").cast("string").alias("_id"), F.lit("P").alias("_conceptType"))
        graph = pg.graph_of(spark, [vertices], [edges])
        ends = pg.read_elements(graph, "VERTEX").select(F.col("_id").alias("_sid"), "_conceptType")
        for how, expected in (("inner", 60_000), ("left_semi", 60_000)):
            joined = pg.read_elements(graph, "EDGE").join(ends, "_sid", how)
            assert len(joined.collect()) == expected
            assert "skew=true" in plan_of(joined), plan_of(joined)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_scratch_tables_go_to_the_shared_folder(spark):
    from propgraph.plans.scratch import scratch_root
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert scratch_root(spark).startswith(f"{shared}/propgraph-")
    assert scratch_root(spark) != scratch_root(spark)
    frame = entry.queries()["stored_filter"](spark, SF_DIR)
    assert all(f"{shared}/propgraph-" in file for file in frame.inputFiles())


class _Session:
    """A session with nothing but what the choice of the scratch folder looks at."""

    def __init__(self, master, **settings):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = type("Conf", (), {"get": staticmethod(lambda name, default=None: settings.get(name.replace(".", "_"), default))})


def test_scratch_tables_of_a_cluster_are_never_local():
    from propgraph.plans.scratch import _shared
    assert _shared(_Session("spark://x", spark_checkpoint_dir="s3://a", spark_sql_warehouse_dir="s3://b")) == "s3://a"
    assert _shared(_Session("spark://x", spark_sql_warehouse_dir="s3://b")) == "s3://b"
    assert _shared(_Session("local[2]", spark_sql_warehouse_dir="s3://b")).startswith("/tmp/")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        _shared(_Session("local-cluster[1,1,900]"))


def test_scratch_tables_are_removed(spark):
    from propgraph.plans.scratch import remove_scratch, scratch_root
    folder = Path(scratch_root(spark))
    pg.create_vertices(spark.createDataFrame([("1",)], "_id string"), str(folder), "T")
    assert folder.exists()
    remove_scratch(spark)
    assert not folder.parent.exists()


def test_staged_tables_are_removed_after_the_commit(spark, root):
    for turn in range(2):
        pg.create_vertices(spark.createDataFrame([("1", turn)], "_id string, n int"), root, "T")
    assert pg.load(spark, root, {"element.type": "VERTEX"}).first().n == 1
    assert not list(Path(root, "_staging").iterdir())
