"""Visibility expressions against a parser by hand, in frames and in stored graphs."""

import itertools
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import propgraph as pg
from propgraph.columns import VERTEX
from propgraph.functions.visibility import permits, well_formed

PERSON = pg.GraphOptions(VERTEX, concept_type="Person")


def random_expression(r, depth=0):
    if depth == 3 or r.random() < 0.3:
        return r.choice(["a", "b", "c", "x:1/y", '"a b"', '"q\\"\\\\&|("'])
    inner = [random_expression(r, depth + 1) for _ in range(r.randint(2, 4))]
    inner = [f"({x})" if any(s in x for s in "&|") or r.random() < 0.2 else x for x in inner]
    return r.choice("&|").join(inner)


def by_hand(text, known):
    """Python's own evaluation of the expression."""
    out, at = "", 0
    while at < len(text):
        if text[at] == '"':
            term, at = "", at + 1
            while text[at] != '"':
                at += text[at] == "\\"
                term, at = term + text[at], at + 1
            out, at = out + str(term in known), at + 1
        elif text[at] in "&|()":
            out, at = out + {"&": " and ", "|": " or "}.get(text[at], text[at]), at + 1
        else:
            end = next((k for k in range(at, len(text)) if text[k] in '&|()"'), len(text))
            out, at = out + str(text[at:end] in known), end
    return eval(out)  # noqa: S307 - made above of True, False, and, or and parentheses


@pytest.mark.parametrize("known", [(), ("a",), ("a", "c"), ("b", "a b"), ("x:1/y", 'q"\\&|('), ("a", "b", "c")])
def test_like_a_parser_by_hand(spark, known):
    r = random.Random(7)
    texts = sorted({random_expression(r) for _ in range(400)} | {"a", "b", '"a"', "(a)", "((a))&b"})
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", permits(F.col("t"), known).alias("p")).collect()
    assert {x.t: x.p for x in got} == {t: by_hand(t, known) for t in texts}


def test_texts_without_operators_are_one_term(spark):
    texts = [None, "", "a", "top secret", "a,b", "ü"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", permits(F.col("t"), ("top secret", "ü")).alias("p")).collect()
    assert {x.t for x in got if x.p} == {None, "", "top secret", "ü"}


def test_an_authorization_with_signs_satisfies_no_expression(spark):
    frame = spark.createDataFrame([("a&b",), ('"a&b"',)], "t string")
    assert [x.t for x in frame.filter(permits(F.col("t"), ("a&b",))).collect()] == ['"a&b"']


@pytest.mark.parametrize("text", ["a&", "&a", "a|b&c", "(a", "a)", "()", "a(b)", '"a', 'a"b"', "a&&b", "a b&c", "(a)(b)", '""', "&", '"a\\b"&c', ")("])
def test_malformed_texts_raise(spark, store, text):
    frame = spark.createDataFrame([("1", text)], "_id string, _visibility string")
    with pytest.raises(PySparkException, match="Malformed visibility"):
        frame.filter(permits(F.col("_visibility"), ("a",))).collect()
    with pytest.raises(PySparkException, match="Malformed visibility"):
        frame.select(well_formed(F.col("_visibility"))).collect()


@pytest.fixture
def store(spark, root):
    return pg.GraphStore(spark, root)


def test_malformed_texts_are_not_written(spark, store):
    with pytest.raises(PySparkException, match="Malformed visibility"):
        store.write(spark.createDataFrame([("1", "a&")], "_id string, _visibility string"), PERSON)
    assert store.graph().vertices.count() == 0


@pytest.mark.parametrize("limit", [8 << 20, 0])
def test_stored_expressions_are_looked_up_or_evaluated(spark, store, monkeypatch, limit):
    monkeypatch.setattr("propgraph.sources.store.EXPRESSION_BYTES", limit)
    r = random.Random(3)
    texts = [random_expression(r) for _ in range(60)] + ["", None, "a", "z"]
    for part in (texts[:30], texts[20:], texts):
        store.write(spark.createDataFrame([(str(texts.index(t)), t) for t in dict.fromkeys(part)], "_id string, _visibility string"), PERSON)
    for known in itertools.chain([()], itertools.combinations(("a", "b", "c", "a b"), 2)):
        frame = pg.read_elements(store.graph(), VERTEX, authorizations=known)
        wanted = {t for t in texts if not t or by_hand(t, known)}
        assert {texts[int(x._id)] for x in frame.collect()} == wanted
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan
        assert ("BroadcastHashJoin" in plan) == (limit > 0)
    listed = spark.read.parquet(f"{store.root}/visibilities").collect()
    assert len(listed) == len({x._visibility for x in listed}) == len({t for t in texts if t and any(s in t for s in '&|()"')})


def test_graphs_without_expressions_have_no_join(spark, store):
    store.write(spark.createDataFrame([("1", "a"), ("2", "")], "_id string, _visibility string"), PERSON)
    frame = pg.read_elements(store.graph(), VERTEX, authorizations=("b",))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "aggregate" not in plan and [x._id for x in frame.collect()] == ["2"]
