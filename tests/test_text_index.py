"""Searches through a text index against full scans."""

import random

import pytest
from pyspark.sql import functions as F

import propgraph as pg
from propgraph.columns import VERTEX
from propgraph.sources import text_index
from propgraph.sources.text_index import TextIndex, grams_of, grams_sought

NOTE = pg.GraphOptions(VERTEX, concept_type="Note")
MEMO = pg.GraphOptions(VERTEX, concept_type="Memo")
WORDS = ("house", "mouse", "a", "é", "日本語", "\U0001f600x", "the\nend", "x.*y", "%_", "")


@pytest.fixture
def store(spark, root):
    return pg.GraphStore(spark, root)


def texts(n, seed=1):
    r = random.Random(seed)
    return [(f"n{k}", r.choice([None, " ".join(r.choices(WORDS, k=r.randint(0, 12)))])) for k in range(n)]


def written(spark, store, data, options=NOTE):
    store.write(spark.createDataFrame(data, "_id string, body string"), options)


def check(store, needles):
    for needle in needles:
        wanted = sorted(r._id for r in pg.read_elements(store.graph(), VERTEX).filter(F.col("body").contains(needle)).collect())
        assert sorted(r._id for r in store.containing(VERTEX, "body", needle).collect()) == wanted, needle


@pytest.mark.parametrize("named", [1000, 3])
def test_like_a_full_scan(spark, store, monkeypatch, named):
    monkeypatch.setattr(text_index, "NAMED", named)
    written(spark, store, texts(80))
    store.index_text(VERTEX, "body")
    check(store, ["house", "ouse mou", "é 日", "\U0001f600x", "e\ne", ".*y", "%_", "a", "", "no such words", "house house mouse"])


def test_changed_partitions_are_searched_whole_until_refreshed(spark, store):
    written(spark, store, texts(60))
    check(store, ["house"])  # no index yet
    store.index_text(VERTEX, "body")
    index = lambda: TextIndex(store._table(VERTEX, store.catalog()), "body")
    assert index().changed()[1] == set()
    written(spark, store, [("n1", "a new house"), ("n70", "mouse house")], MEMO)
    store.delete(VERTEX, F.col("_id") == "n2")
    fresh, stale = index().changed()
    assert fresh and stale
    check(store, ["house", "new hou"])
    store.index_text(VERTEX, "body")
    assert index().changed()[1] == set()
    check(store, ["house", "new hou"])
    store.delete(VERTEX)
    store.index_text(VERTEX, "body")
    check(store, ["house"])


def test_texts_of_others_are_not_scanned(spark, store):
    """A passage in one element: its partition is read, and in it what its id's filter lets through."""
    written(spark, store, [(f"n{k}", f"text number {k} of many") for k in range(400)])
    written(spark, store, [("odd", "here is the needle")], MEMO)
    store.index_text(VERTEX, "body")
    frame = store.containing(VERTEX, "body", "needle")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "EqualTo(_id,odd)" in plan
    parts = plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "Memo" in parts and "_bucket" in parts
    assert [r._id for r in frame.collect()] == ["odd"]
    none = store.containing(VERTEX, "body", "no such thing")._jdf.queryExecution().executedPlan().toString()
    assert none.count("FileScan") == 0
    postings = TextIndex(store._table(VERTEX, store.catalog()), "body").candidates("needle", {("Memo", b) for b in range(8)})
    scan = postings._jdf.queryExecution().executedPlan().toString()
    assert "In(__gram, [dle,edl,eed,nee])" in scan and "body" not in scan


def test_hints_decide_what_is_indexed(spark, store):
    store.write(spark.createDataFrame([("1", 5)], "_id string, n int"), NOTE)
    for name in ("n", "other"):
        with pytest.raises(ValueError, match=f"Property '{name}' has no text index"):
            store.index_text(VERTEX, name)


def test_visibility_holds_in_searches(spark, store):
    store.write(spark.createDataFrame([("1", "a house", "x&y"), ("2", "my house", "")], "_id string, body string, _visibility string"), NOTE)
    store.index_text(VERTEX, "body")
    assert [r._id for r in store.containing(VERTEX, "body", "house").collect()] == ["2"]
    assert store.containing(VERTEX, "body", "house", authorizations=("x", "y")).count() == 2


def test_grams(spark):
    text = "ab\U0001f600\ncd"
    got = spark.createDataFrame([(text,), ("ab",), ("",), ("aaaa",)], "t string").select(grams_of(F.col("t")).alias("g")).collect()
    assert set(grams_sought(text)) <= set(got[0].g) and [r.g for r in got[1:]] == [[], [], ["aaa"]]
    assert grams_sought("ab") == [] and grams_sought("abcd") == ["abc", "bcd"] and len(grams_sought("".join(map(chr, range(97, 190))))) <= 16


def test_postings_hold_many_elements_a_row_and_are_not_shuffled(spark, store):
    """A row for each gram of a few MB of texts, not for each gram of each text; no exchange before the write."""
    data = [(f"n{k}", f"a number of words, {k % 7}") for k in range(4000)]
    written(spark, store, data)
    index = TextIndex(store._table(VERTEX, store.catalog()), "body")
    plans, write = [], index._write
    index._write = lambda what, frame: (plans.append(frame._jdf.queryExecution().executedPlan().toString()), write(what, frame))
    index.refresh()
    assert "Exchange" not in plans[0]
    found = index._read("postings", index._postings).filter("__gram IS NOT NULL")
    grams = spark.createDataFrame(data, "_id string, body string").select("_id", F.explode(grams_of(F.col("body"))).alias("g"))
    assert found.count() < grams.count() / 50
    held = found.select(F.explode("__ids").alias("_id"), F.col("__gram").alias("g"))
    assert held.count() == grams.count() and held.exceptAll(grams).isEmpty()


@pytest.mark.parametrize("piece, width", [(1, 3), (40, 3), (4 << 20, 3), (4 << 20, 4)])
def test_pieces_of_batches(monkeypatch, piece, width):
    """Whatever the pieces, types and buckets, each gram of each text once; also letters too many for one number, and bytes that are no text."""
    import pyarrow as pa

    from propgraph.sources import grams

    monkeypatch.setattr(grams, "PIECE_BYTES", piece)
    r = random.Random(3)
    wide = "".join(map(chr, range(0x100, 0xA000)))
    bodies = [" ".join(r.choices(WORDS, k=r.randint(0, 9))) for _ in range(40)] + [wide, wide[::-1], "", "ab", "aaaa"] * 2
    kinds, buckets = [f"T{k // 17}" for k in range(len(bodies))], [k // 9 for k in range(len(bodies))]
    rows = [[f"n{k}" for k in range(len(bodies))], [b.encode() for b in bodies], kinds, buckets]
    rows = [[*own, last] for own, last in zip(rows, ("odd", b"\xffabc\xe2", "T9", 9))]
    types = (pa.string(), pa.binary(), pa.string(), pa.int32())
    batch = pa.RecordBatch.from_arrays([pa.array(own, t) for own, t in zip(rows, types)], names=["i", "b", "k", "n"])
    task = grams.postings_task(width, ["gram", "ids", "kind", "bucket"])
    got = [(row["gram"], i, row["kind"], row["bucket"]) for out in task(iter([batch])) for row in out.to_pylist() for i in row["ids"]]
    whole = [*zip(bodies, *rows[:1], kinds, buckets), ("\ufffdabc\ufffd", "odd", "T9", 9)]
    wanted = {(b[k : k + width], *own) for b, *own in whole for k in range(len(b) - width + 1)}
    assert len(got) == len(wanted) and set(got) == wanted
