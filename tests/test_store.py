"""Stored graphs: inserts, upserts, overwrites, deletes, catalog changes, plans."""

import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import propgraph as pg
from propgraph.columns import EDGE, VERTEX
from propgraph.operators.catalog import Catalog
from propgraph.sources.element_table import ElementTable, with_buckets

PERSON = pg.GraphOptions(VERTEX, concept_type="Person")
CAT = pg.GraphOptions(VERTEX, concept_type="Cat")
KNOWS = pg.GraphOptions(EDGE, label_type="knows")


@pytest.fixture
def store(spark, root):
    return pg.GraphStore(spark, root)


def rows(store, *columns, kind=VERTEX, **options):
    frame = pg.read_elements(store.graph(), kind, **options).select(*columns)
    return sorted((tuple(r) for r in frame.collect()), key=str)


def people(spark, *data, columns="_id string, name string, age int"):
    return spark.createDataFrame(list(data), columns)


def files(store, kind):
    return set(pg.read_elements(store.graph(), kind).inputFiles())


# ---- inserts ---------------------------------------------------------------------------------


@pytest.mark.parametrize("make", [
    lambda s: s.range(1, 11).select(F.array(*[F.col("id").cast("string")] * 2).alias("foo")),
    lambda s: s.range(1, 11).select(F.col("id").cast("string").alias("foo")),
    lambda s: s.range(1, 11).select(F.col("id").cast("int").alias("foo")),
    lambda s: s.range(1, 6).select(F.make_date(F.lit(2020), F.lit(1), "id").alias("foo")),
    lambda s: s.range(1, 6).select(F.make_timestamp(*[F.lit(x) for x in (2020, 1)], "id", *[F.lit(x) for x in (11, 11, 11.11)]).alias("foo")),
    lambda s: s.range(1, 11).select(F.array("id", "id").alias("foo")),
    lambda s: s.range(1, 11).select(pg.make_duration(months="id", seconds="id").alias("foo")),
    lambda s: s.range(1, 11).select(F.array(pg.make_duration(days="id"), pg.make_duration(weeks="id")).alias("foo")),
    lambda s: s.range(1, 11).select(F.encode(F.col("id").cast("string"), "utf-8").alias("foo")),
    lambda s: s.range(1, 11).select(F.array(F.col("id") > 5).alias("foo")),
    lambda s: s.range(1, 11).select((F.col("id") / 4).cast("decimal(9,2)").alias("foo")),
])
def test_values_come_back_as_written(spark, store, make):
    batch = make(spark)
    store.write(batch, pg.GraphOptions(VERTEX), mode="overwrite")
    back = pg.match_vertices(store.graph(), "thing").select("foo")
    assert back.schema["foo"].dataType.simpleString() == batch.schema["foo"].dataType.simpleString()
    assert sorted(map(str, back.collect())) == sorted(map(str, batch.collect()))


def test_generated_ids_are_new_whole_numbers(spark, store):
    for _ in range(2):
        store.write(spark.range(100).repartition(10).select(F.lit("x").alias("name")), PERSON)
    store.write(people(spark, ("9000000000000", "y", 1)), PERSON)
    store.write(spark.range(3).select(F.lit("x").alias("name")), CAT)
    ids = [int(r[0]) for r in rows(store, "_id")]
    assert len(set(ids)) == 204
    assert min(ids) > -1
    assert max(ids) > 9_000_000_000_000


def test_type_comes_from_the_option_unless_asked_otherwise(spark, store):
    batch = spark.createDataFrame(
        [("1", "Dog", "a"), ("2", None, "b"), ("3", " ", "c")], "_id string, _conceptType string, name string"
    )
    store.write(batch, CAT)
    assert rows(store, "_conceptType") == [("Cat",)] * 3
    store.write(batch, CAT, type_from_column=True)
    assert rows(store, "_id", "_conceptType") == [("1", "Dog"), ("2", "Cat"), ("3", "Cat")]


def test_a_null_is_an_absent_property(spark, store):
    store.write(spark.createDataFrame([("Andrea", None)], "name string, surname string"), PERSON, mode="overwrite")
    found = pg.match_vertices(store.graph(), "Person", {"name": "Andrea"}).first()
    assert found.surname is None
    assert [p.name for p in store.catalog().properties] == ["name", "surname"]


def test_type_names_with_odd_characters(spark, store):
    store.write(people(spark, ("1", "a", 1)), pg.GraphOptions(VERTEX, concept_type="A/b=c: ü%"))
    store.write(people(spark, ("2", "a", 1)), pg.GraphOptions(VERTEX, concept_type="2024"))
    store.write(people(spark, ("1", "b", 2)), pg.GraphOptions(VERTEX, concept_type="A/b=c: ü%"))
    assert rows(store, "_id", "_conceptType", "name") == [("1", "A/b=c: ü%", "b"), ("2", "2024", "a")]


def test_property_names_with_odd_characters(spark, store):
    batch = spark.createDataFrame([("1", 1, 2)], "_id string, `a.b` int, `c``d e` int")
    store.write(batch, PERSON)
    store.write(batch.withColumn("a.b", F.lit(5)), PERSON)
    assert rows(store, "`a.b`", "`c``d e`") == [(5, 2)]


# ---- edges -----------------------------------------------------------------------------------


def test_edges(spark, store):
    batch = spark.createDataFrame(
        [("100000", "200000", "x", "str1"), ("200000", "300000", "x", "str2")],
        "_sid string, _did string, _edgeLabel string, prop1 string",
    )
    store.write(batch, pg.GraphOptions(EDGE), mode="overwrite")
    assert rows(store, "_sid", "_did", "_edgeLabel", "prop1", kind=EDGE) == [
        ("100000", "200000", "hasEntity", "str1"), ("200000", "300000", "hasEntity", "str2")
    ]
    assert [(t.kind, t.name) for t in store.catalog().types] == [("concept", "thing"), ("relationship", "hasEntity")]


@pytest.mark.parametrize("missing", ["_sid", "_did"])
def test_edges_need_both_ends(spark, store, missing):
    batch = spark.createDataFrame([("e", "1", "2")], "_id string, _sid string, _did string")
    with pytest.raises(ValueError, match=f"Schema does not contain {missing} column for edge"):
        store.write(batch.drop(missing), KNOWS)
    with pytest.raises(PySparkException, match=f"Column {missing} must not be null"):
        store.write(batch.withColumn(missing, F.lit(None).cast("string")), KNOWS)
    assert store.catalog() == Catalog()


def test_ids_must_not_be_null(spark, store):
    with pytest.raises(PySparkException, match="Column _id must not be null"):
        store.write(people(spark, (None, "x", 1)), PERSON)


# ---- upserts ---------------------------------------------------------------------------------


def test_upsert(spark, store):
    store.write(people(spark, ("1", "a", 1), ("2", "b", 2)), PERSON)
    store.write(spark.createDataFrame([("2", 20, "new"), ("3", 30, "new")], "_id string, age int, note string"), PERSON)
    assert rows(store, "_id", "name", "age", "note") == [
        ("1", "a", 1, None), ("2", "b", 20, "new"), ("3", None, 30, "new")
    ]
    store.write(people(spark, ("1", None, 5)), PERSON)
    assert rows(store, "_id", "name", "age")[0] == ("1", None, 5), "a null clears, a column not written stays"


def test_upsert_edges(spark, store):
    edge = "_id string, _sid string, _did string, since int"
    store.write(spark.createDataFrame([("e1", "1", "2", 1), ("e2", "2", "3", 2)], edge), KNOWS)
    store.write(spark.createDataFrame([("e1", "1", "9", 5), ("e3", "3", "1", 3)], edge), KNOWS)
    assert rows(store, "_id", "_sid", "_did", "since", kind=EDGE) == [
        ("e1", "1", "9", 5), ("e2", "2", "3", 2), ("e3", "3", "1", 3)
    ]


def test_upsert_can_move_a_vertex_to_another_concept(spark, store):
    store.write(people(spark, ("1", "a", 1), ("2", "b", 2)), PERSON)
    store.write(spark.createDataFrame([("1",)], "_id string"), CAT)
    assert rows(store, "_id", "_conceptType", "name") == [("1", "Cat", "a"), ("2", "Person", "b")]


def test_upsert_rewrites_only_the_folders_it_hits(spark, store):
    store.write(people(spark, ("1", "a", 1)), PERSON)
    store.write(people(spark, ("2", "b", 2)), CAT)
    before = files(store, VERTEX)
    store.write(people(spark, ("2", "c", 3), ("3", "d", 4)), CAT)
    assert {f for f in before if "Person" in f} <= files(store, VERTEX)
    assert not {f for f in before if "Cat" in f} & files(store, VERTEX)
    before = files(store, VERTEX)
    store.write(people(spark, ("4", "e", 5)), CAT)
    assert before < files(store, VERTEX), "a batch of new ids only adds files"


def test_repeated_ids(spark, store):
    batch = people(spark, ("1", "a", 1), ("1", "b", 3), ("1", "c", 2), ("2", "d", None))
    with pytest.raises(ValueError, match="More than one row in the batch for _id 1"):
        store.write(batch, PERSON)
    store.write(batch, PERSON, order_by="age")
    assert rows(store, "_id", "name") == [("1", "b"), ("2", "d")]


def test_repeated_ids_with_equal_rank_are_settled_the_same_way_each_time(spark):
    from propgraph.operators.mutate import last_of_each_id
    batch = people(spark, *[("1", n, 1) for n in "abcdefgh"])
    picked = {last_of_each_id(batch.repartition(n), "age").first().name for n in (1, 3, 8)}
    assert len(picked) == 1


def test_a_hot_repeated_id_fails_the_commit(spark, store):
    hot = spark.range(300_000).select(F.lit("1").alias("_id"), F.col("id").alias("n"))
    for _ in range(2):  # into an empty store, and into one with elements
        with pytest.raises(ValueError, match="More than one row in the batch for _id 1"):
            store.write(hot, PERSON)
        store.write(people(spark, ("9", "x", 1)), CAT)
    assert rows(store, "_id") == [("9",)]


def test_updates_of_frames(spark):
    from propgraph.operators.mutate import update_matched
    base = people(spark, ("1", "a", 1), ("2", "b", 2))
    batch = spark.createDataFrame([("2", None, 7), ("3", "c", 8)], "_id string, name string, extra int")
    assert sorted(map(tuple, update_matched(base, batch).collect())) == [("1", "a", 1, None), ("2", None, 2, 7)]


def test_types_are_the_catalogs(spark, store):
    store.write(spark.createDataFrame([("1", 1)], "_id string, n bigint"), PERSON)
    store.write(spark.createDataFrame([("2", 2)], "_id string, n int"), PERSON)
    with pytest.raises(ValueError, match="'n' is LONG in the catalog, not STRING"):
        store.write(spark.createDataFrame([("3", "3")], "_id string, n string"), PERSON)
    store.write(spark.createDataFrame([("3", "3")], "_id string, n string"), PERSON, allow_lossy=True)
    assert rows(store, "_id", "n") == [("1", 1), ("2", 2), ("3", 3)]


def test_visibility_is_kept(spark, store):
    store.write(spark.createDataFrame(
        [("1", "a", "x", False), ("2", "b", None, None), ("3", "c", "", True)],
        "_id string, name string, _visibility string, _hidden boolean",
    ), PERSON)
    store.write(people(spark, ("1", "A", 1), ("2", "B", 2)), PERSON)
    assert rows(store, "name") == [("B",)]
    assert rows(store, "name", authorizations=("x",)) == [("A",), ("B",)]
    assert rows(store, "name", fetch_hints="ALL_INCLUDING_HIDDEN") == [("B",), ("c",)]
    assert [p.name for p in store.catalog().properties] == ["name", "age"]


# ---- overwrites and deletes ------------------------------------------------------------------


def start(spark, store):
    store.write(people(spark, ("1", "a", 1), ("2", "b", None), ("3", "c", 9)), PERSON)
    store.write(people(spark, ("4", "d", 2), ("5", "e", 9)), CAT)


def test_overwrite_replaces_everything_of_the_kind(spark, store):
    start(spark, store)
    store.write(spark.createDataFrame([("e", "1", "2")], "_id string, _sid string, _did string"), KNOWS)
    store.write(people(spark, ("7", "x", 1)), CAT, mode="overwrite")
    assert rows(store, "_id") == [("7",)]
    assert rows(store, "_id", kind=EDGE) == [("e",)]


def test_overwrite_where(spark, store):
    start(spark, store)
    store.write(people(spark, ("7", "x", 1), ("2", "B", 5), ("3", "C", 6)), CAT, mode="overwrite_where", where=F.col("age") > 5)
    assert rows(store, "_id", "name", "_conceptType") == [
        ("1", "a", "Person"), ("2", "B", "Cat"), ("3", "C", "Cat"), ("4", "d", "Cat"), ("7", "x", "Cat")
    ]
    with pytest.raises(ValueError, match="overwrite_where"):
        store.write(people(spark), CAT, where=F.col("age") > 5)
    with pytest.raises(ValueError, match="mode"):
        store.write(people(spark), CAT, mode="ignore")


def test_overwrite_where_without_ids(spark, store):
    start(spark, store)
    store.write(spark.createDataFrame([("new",)], "name string"), CAT, mode="overwrite_where", where=F.col("age") == 9)
    assert rows(store, "name") == [("a",), ("b",), ("d",), ("new",)]


def test_overwrite_dynamic_replaces_the_types_it_brings(spark, store):
    start(spark, store)
    store.write(people(spark, ("7", "x", 1)), CAT, mode="overwrite_dynamic")
    assert rows(store, "_id") == [("1",), ("2",), ("3",), ("7",)]
    mixed = spark.createDataFrame([("8", "Person"), ("9", "Dog")], "_id string, _conceptType string")
    store.write(mixed, CAT, mode="overwrite_dynamic", type_from_column=True)
    assert rows(store, "_id", "_conceptType") == [("7", "Cat"), ("8", "Person"), ("9", "Dog")]
    # An id that lives on under another type is updated, not doubled.
    store.write(people(spark, ("8", "y", 1)), CAT, mode="overwrite_dynamic")
    assert rows(store, "_id", "_conceptType") == [("8", "Cat"), ("9", "Dog")]


def test_delete_where_keeps_unknowns(spark, store):
    start(spark, store)
    store.delete(VERTEX, F.col("age") > 5)
    assert rows(store, "_id") == [("1",), ("2",), ("4",)]
    store.delete(VERTEX, F.col("_conceptType") == "Person")
    assert rows(store, "_id") == [("4",)]
    before = files(store, VERTEX)
    store.delete(VERTEX, F.col("age") > 100)
    assert rows(store, "_id") == [("4",)] and files(store, VERTEX) == before


def test_delete_all_leaves_an_empty_graph(spark, store):
    start(spark, store)
    store.delete(VERTEX)
    assert rows(store, "_id", "name") == []
    store.write(people(spark, ("1", "z", 1)), PERSON)
    assert rows(store, "_id", "name") == [("1", "z")]


@pytest.mark.parametrize("where, detach, expected", [
    ("age > 5", False, ["e1", "e2", "e3", "e4"]), ("age > 5", True, ["e1"]),
    (None, False, ["e1", "e2", "e3", "e4"]), (None, True, []),
])
def test_detach(spark, store, where, detach, expected):
    start(spark, store)
    ends = [("e1", "1", "2"), ("e2", "1", "3"), ("e3", "3", "1"), ("e4", "5", "3")]
    store.write(spark.createDataFrame(ends, "_id string, _sid string, _did string"), KNOWS)
    store.delete(VERTEX, None if where is None else F.expr(where), detach=detach)
    assert [r[0] for r in rows(store, "_id", kind=EDGE)] == expected


# ---- commits and the catalog -----------------------------------------------------------------


def test_a_failed_write_changes_nothing(spark, store):
    start(spark, store)
    before = store.catalog(), files(store, VERTEX)
    broken = people(spark, ("1", "x", 1)).withColumn("age", F.raise_error(F.lit("broken")).cast("int"))
    with pytest.raises(PySparkException, match="broken"):
        store.write(broken, PERSON)
    assert (store.catalog(), files(store, VERTEX)) == before
    assert len(rows(store, "_id")) == 5


def test_the_graph_may_be_written_from_what_was_read(spark, store):
    start(spark, store)
    read = pg.read_elements(store.graph(), VERTEX)
    store.write(read.filter("age > 1").select("_id", "_conceptType", "name"), PERSON, mode="overwrite", type_from_column=True)
    assert rows(store, "_id", "_conceptType", "name", "age") == [("3", "Person", "c", None), ("4", "Cat", "d", None), ("5", "Cat", "e", None)]
    store.write(pg.read_elements(store.graph(), VERTEX).select("_id", F.lit(1).alias("age")), CAT)
    assert rows(store, "_id", "_conceptType", "age") == [("3", "Cat", 1), ("4", "Cat", 1), ("5", "Cat", 1)]


def test_dropped_properties(spark, store):
    start(spark, store)
    before = files(store, VERTEX)
    store.drop_property("age")
    assert files(store, VERTEX) == before, "no data is rewritten"
    assert "age" not in pg.read_elements(store.graph(), VERTEX).columns
    store.write(spark.createDataFrame([("1", "old")], "_id string, age string"), PERSON)
    assert rows(store, "_id", "age")[:2] == [("1", "old"), ("2", None)]


def test_dropped_types_stay_in_the_data(spark, store):
    start(spark, store)
    store.drop_concept("Cat")
    assert [t.name for t in store.catalog().types] == ["thing", "Person"]
    assert len(rows(store, "_id")) == 5
    with pytest.raises(ValueError, match="root concept"):
        store.drop_concept("thing")
    with pytest.raises(ValueError, match="No relationship"):
        store.drop_label("knows")


def test_the_catalog_is_only_appended_to(spark, store):
    from pathlib import Path
    start(spark, store)
    noted = set(Path(store.root, "catalog").glob("*.parquet"))
    store.write(people(spark, ("1", "a", 1)), PERSON)
    assert set(Path(store.root, "catalog").glob("*.parquet")) == noted, "nothing new, nothing noted"
    store.drop_property("age")
    store.write(spark.createDataFrame([("1", "x")], "_id string, age string"), CAT)
    store.drop_concept("Cat")
    store.write(spark.createDataFrame([("1",)], "_id string"), CAT)
    assert noted < set(Path(store.root, "catalog").glob("*.parquet"))
    catalog = store.catalog()
    assert [(p.name, p.type, p.column) for p in catalog.properties] == [("name", "STRING", "name"), ("age", "STRING", "age@1")]
    assert [t.name for t in catalog.types] == ["thing", "Person", "Cat"] and catalog.retired_columns == ("age",)


def test_option_maps(spark, root):
    pg.create_vertices(people(spark, ("1", "a", 1)), root, "Person")
    pg.create_edges(spark.createDataFrame([("1", "1")], "_sid string, _did string"), root, "self")
    pg.save(people(spark, ("2", "b", 2)), root, {"element.type": "VERTEX", "conceptType": "Cat"})
    assert pg.load(spark, root, {"element.type": "VERTEX"}).count() == 2
    assert pg.load(spark, root, {"element.type": "EDGE", "reader.fetchHints": "EDGE_REFS"}).first()._edgeLabel == "self"
    with pytest.raises(ValueError, match="Parameter 'element.type' is required"):
        pg.load(spark, root, {})


def test_scan_of_a_store_prunes_and_pushes_down(spark, store):
    start(spark, store)
    frame = pg.read_elements(store.graph(), VERTEX).filter("_conceptType = 'Cat' AND age > 1 AND _id = '4'").select("name")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "_conceptType" in scan.split("PartitionFilters: ")[1].split("]")[0]
    assert "GreaterThan(age,1)" in scan and "EqualTo(_id,4)" in scan and "In(_visibility" in scan or "EqualTo(_visibility" in scan
    assert "ReadSchema: struct<_id:string,_visibility:string,_hidden:boolean,name:string,age:int>" in scan
    assert "Python" not in plan and "Exchange" not in plan


def test_small_updates_do_not_shuffle_the_stored_rows(spark, root):
    from propgraph.operators.mutate import update_matched
    spark.range(1000).select(F.col("id").cast("string").alias("_id"), "id").write.parquet(f"{root}/base")
    spark.range(10).select(F.col("id").cast("string").alias("_id"), (-F.col("id")).alias("id")).write.parquet(f"{root}/batch")
    joined = update_matched(spark.read.parquet(f"{root}/base"), spark.read.parquet(f"{root}/batch"))
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.agg(F.sum("id")).first()[0] == sum(range(10, 1000)) - sum(range(10))


# ---- buckets, crashes, upkeep ------------------------------------------------------------------


def big(spark, n=200_000):
    return spark.range(n).select(F.concat(F.lit("p"), "id").alias("_id"), F.col("id").alias("n"))


def test_one_row_changes_rewrite_one_partition(spark, store):
    store.write(big(spark), PERSON)
    folders = [{f.rsplit("/", 1)[0] for f in files(store, VERTEX)}]
    before = files(store, VERTEX)
    store.write(spark.createDataFrame([("p77", -1)], "_id string, n bigint"), PERSON)
    second = files(store, VERTEX)
    assert len({f.rsplit("/", 1)[0] for f in second - before}) == 1
    store.delete(VERTEX, F.col("_id") == "p100")
    third = files(store, VERTEX)
    assert len({f.rsplit("/", 1)[0] for f in third - second}) == 1 and [{f.rsplit("/", 1)[0] for f in third}] == folders
    found = pg.read_elements(store.graph(), VERTEX)
    assert found.agg(F.count("*"), F.sum("n")).first()[:] == (199_999, sum(range(200_000)) - 77 - 1 - 100)


class Written:
    """The plans of tables that are written."""

    def __init__(self, monkeypatch):
        from pyspark.sql import DataFrameWriter
        self.plans, original = {}, DataFrameWriter.parquet

        def parquet(writer, path, **options):
            self.plans[path] = writer._df._jdf.queryExecution().executedPlan().toString()
            return original(writer, path, **options)

        monkeypatch.setattr(DataFrameWriter, "parquet", parquet)

    def scans(self, table):
        return [x for path, plan in self.plans.items() for x in plan.splitlines() if "FileScan" in x and f"/{table}]" in x]


def test_only_hit_partitions_are_read_and_written(spark, store, monkeypatch):
    store.write(big(spark, 4000), PERSON)
    store.write(people(spark, *[(f"c{k}", "x", k) for k in range(40)]), CAT)
    one = spark.createDataFrame([("p1", -5)], "_id string, n bigint")
    bucket = with_buckets(one, 8).first()._bucket
    for change in (
        lambda: store.write(one, PERSON), lambda: store.delete(VERTEX, F.col("_id") == "p1"),
        lambda: store.write(one, PERSON, mode="overwrite_where", where=F.col("_id") == "p9"),
    ):
        written = Written(monkeypatch)
        change()
        rewritten = written.plans[f"{store.root}/vertices"] if not written.scans("vertices") else "\n".join(written.scans("vertices"))
        assert "_bucket" in rewritten.split("PartitionFilters: ")[1].split("]")[0]
    found = store._table(VERTEX, store.catalog())
    assert 0 < found.scan.filter(found.among({("Person", bucket)})).count() < 1500
    plan = found.scan.filter(found.among({("Person", bucket)}))._jdf.queryExecution().executedPlan().toString()
    assert "_conceptType" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]


def test_partitions_left_empty_stay_empty(spark, store):
    """The last row of a partition goes: by a move, by a delete, by an overwrite."""
    store.write(people(spark, ("1", "a", 1)), PERSON)
    store.write(people(spark, ("1", "b", 2)), CAT)
    assert rows(store, "_id", "_conceptType", "name") == [("1", "Cat", "b")]
    store.delete(VERTEX, F.col("age") == 2)
    assert rows(store, "_id") == []
    store.write(people(spark, ("1", "c", 3), ("2", "d", 4)), PERSON)
    store.write(people(spark, ("3", "e", 5)), CAT, mode="overwrite")
    assert rows(store, "_id", "_conceptType") == [("3", "Cat")]
    store.write(people(spark), CAT, mode="overwrite")
    assert rows(store, "_id") == []


def test_a_change_that_died_between_its_jobs_can_be_repeated(spark, store, monkeypatch):
    store.write(people(spark, *[(str(k), "a", k) for k in range(30)]), PERSON)
    batch = people(spark, *[(str(k), "b", k) for k in range(25, 60)])
    original, puts = ElementTable.put, []

    def put(self, frame, touched=None):
        if touched is None:
            puts.append(1)
            raise RuntimeError("died")
        original(self, frame, touched)

    monkeypatch.setattr(ElementTable, "put", put)
    with pytest.raises(RuntimeError, match="died"):
        store.write(batch, CAT)
    monkeypatch.setattr(ElementTable, "put", original)
    assert puts and len(rows(store, "_id")) >= 30
    store.write(batch, CAT)
    wanted = [(str(k), "Person" if k < 25 else "Cat", "a" if k < 25 else "b") for k in range(60)]
    assert rows(store, "_id", "_conceptType", "name") == sorted(wanted, key=str)


def test_buckets_stay_those_of_the_first_write(spark, store):
    for count, name in (("2", "a"), ("16", "b"), ("4", "c")):
        spark.conf.set("spark.propgraph.buckets", count)
        store.write(people(spark, *[(f"{name}{k}", name, k) for k in range(40)]), PERSON)
    spark.conf.unset("spark.propgraph.buckets")
    assert len({f.rsplit("/", 2)[1] for f in files(store, VERTEX)}) == 2
    store.write(people(spark, ("a3", "new", 1), ("b3", "new", 1), ("d", "new", 1)), PERSON)
    assert len(rows(store, "_id")) == 121
    assert [r[0] for r in rows(store, "_id", "name") if r[1] == "new"] == ["a3", "b3", "d"]
    store.delete(VERTEX, F.col("name") == "new")
    assert len(rows(store, "_id")) == 118


@pytest.mark.parametrize("taken", [str(2**63 - 1), "9" * 30, "1" * 40, "9223372036854775000", "-5"])
def test_new_ids_after_large_ones(spark, store, taken):
    store.write(people(spark, (taken, "x", 1)), PERSON)
    store.write(spark.range(8, numPartitions=4).select("id"), PERSON)
    store.write(spark.range(8, numPartitions=4).select("id"), PERSON)
    ids = [r[0] for r in rows(store, "_id")]
    assert len(set(ids)) == 17 and all(i.isdigit() for i in ids if i != taken)


def test_new_ids_are_dense_and_the_same_each_time(spark, store):
    from propgraph.operators.mutate import assign_ids
    store.write(spark.range(1000, numPartitions=7).select(F.uuid().alias("u")), PERSON)
    store.write(spark.range(500, numPartitions=3).select(F.uuid().alias("u")), CAT)
    assert sorted(int(r[0]) for r in rows(store, "_id")) == list(range(1500))
    spark.range(3000, numPartitions=9).select(F.uuid().alias("u")).write.parquet(f"{store.root}/fixed")
    fixed = spark.read.parquet(f"{store.root}/fixed")
    first = assign_ids(fixed, 5)
    again = assign_ids(fixed, 5)
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, again.collect()))
    assert sorted(int(r._id) for r in first.collect()) == list(range(5, 3005))


def test_a_task_that_runs_again_gives_the_same_ids(spark, store):
    """Tasks that read other splits, in another order, number rows alike."""
    from propgraph.operators.mutate import assign_ids
    spark.range(3000, numPartitions=4).select(F.uuid().alias("u")).write.parquet(f"{store.root}/fixed")
    fixed = spark.read.parquet(f"{store.root}/fixed")
    wanted = {r.u: r._id for r in assign_ids(fixed, 0).collect()}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        assert {r.u: r._id for r in assign_ids(fixed, 0).collect()} == wanted
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_written_rows_are_shuffled_once(spark, store, monkeypatch):
    written = Written(monkeypatch)
    store.write(big(spark, 1000), PERSON)
    plan = written.plans[f"{store.root}/vertices"]
    assert plan.count("Exchange") == 1 and "Python" not in plan and "Cartesian" not in plan
    store.write(big(spark, 10), PERSON)
    assert all("Cartesian" not in p and "NestedLoop" not in p and "Python" not in p for p in written.plans.values())


def test_compaction(spark, store):
    for k in range(24):
        store.write(people(spark, (str(k), f"n{k}", k)), PERSON if k % 2 else CAT)
    store.delete(VERTEX, F.col("age") == 3)
    wanted, before = rows(store, "_id", "name", "_conceptType"), files(store, VERTEX)
    store.compact()
    after = files(store, VERTEX)
    assert len(after) < len(before) and len({f.rsplit("/", 1)[0] for f in after}) == len(after)
    assert rows(store, "_id", "name", "_conceptType") == wanted and len(wanted) == 23
    store.compact()
    assert files(store, VERTEX) == after, "nothing left to merge"
    store.write(people(spark, ("99", "x", 1)), PERSON)
    assert len(rows(store, "_id")) == 24


def test_only_small_files_are_merged(spark, store):
    store.write(big(spark), PERSON)
    before = files(store, VERTEX)
    store.write(people(spark, *[(str(k), "x", k) for k in range(100)]), PERSON)
    store.compact(below=20_000)
    assert before < files(store, VERTEX)
    assert pg.read_elements(store.graph(), VERTEX).count() == 200_100


def test_a_read_of_many_ranges(spark, root):
    pg.create_vertices(big(spark, 5000), root, "P")
    frame = pg.load(spark, root, {"element.type": "VERTEX", "partitioning.strategy": "range"}, partitions=1000)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert frame.rdd.getNumPartitions() > 900
        assert pg.load(spark, root, {"element.type": "VERTEX", "partitioning.strategy": "range"}, partitions=1000, max_ranges=7).rdd.getNumPartitions() in (7, 8)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


@pytest.mark.parametrize("strategy", ["range", "shard"])
def test_a_stored_graph_is_laid_out_without_a_shuffle(spark, root, strategy):
    pg.create_vertices(big(spark, 20_000), root, "P")
    frame = pg.load(spark, root, {"element.type": "VERTEX", "partitioning.strategy": strategy}, partitions=5).filter("n >= 0")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and frame.rdd.getNumPartitions() in (5, 6)
    assert frame.agg(F.count("*"), F.countDistinct("_id"), F.sum("n")).first()[:] == (20_000, 20_000, sum(range(20_000)))
    part = F.least(F.spark_partition_id(), F.lit(4)).alias("p")
    sizes = frame.groupBy(part).agg(F.count("*").alias("n"), F.min("_id").alias("a"), F.max("_id").alias("b")).orderBy("a").collect()
    assert max(r.n for r in sizes) < 2 * 20_000 / 5 * (1 if strategy == "range" else 1.5)
    scans = [x for x in plan.splitlines() if "FileScan" in x]
    if strategy == "range":
        assert all(x.b < y.a for x, y in zip(sizes, sizes[1:]))
        assert sum("GreaterThanOrEqual(_id," in x for x in scans) == sum("LessThan(_id," in x for x in scans) == 4
    else:
        assert all("_bucket" in x.split("PartitionFilters: ")[1].split("]")[0] for x in scans)
    empty = pg.load(spark, f"{root}-none", {"element.type": "VERTEX", "partitioning.strategy": strategy}, partitions=5)
    assert empty.count() == 0
