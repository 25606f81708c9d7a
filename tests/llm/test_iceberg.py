import random
import re
from collections import Counter, defaultdict

import pytest

from oracle import connect, expected, rows_of
from propgraph.llm import iceberg
from propgraph.llm.common import Scratch
from propgraph.llm.iceberg import OP13_SQL, divergence, frequent_terms, op13_divergence, term_bags

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
FOLD = {b: b + 32 for b in range(65, 91)}
DOCS = "lang string, source string, text string"


def words(text):
    return TERM.findall((text or "").translate(FOLD))


def kept_of(docs, least):
    seen = defaultdict(Counter)
    for lang, _, text in docs:
        seen[lang or ""].update(set(words(text)))
    return {lang: sorted(t for t, n in c.items() if n >= least) for lang, c in seen.items()}


def brute(docs, least=10, terms=10):
    kept = kept_of(docs, least)
    groups, langs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in docs:
        groups[lang or "", source or ""].update(words(text))
        langs[lang or ""].update(words(text))

    def shares(lang, c):
        own = {t: c[t] for t in kept[lang]}
        return {t: 1 + 10**9 * (n + 2) // (sum(own.values()) + 2 * len(own)) for t, n in own.items()}

    def f(p, q):
        return (p - q) ** 2 // (p + q)

    out = []
    for (lang, source), c in groups.items():
        p, q = shares(lang, c), shares(lang, langs[lang])
        pairs = [(-sum(f(p[t], o[t]) for t in p), other.encode(), other) for (l2, other), c2 in groups.items() if l2 == lang and other != source for o in [shares(lang, c2)]]
        listed = [(-f(p[t], q[t]), t.encode(), t) for t in p if c[t] and p[t] > q[t]]
        out += [(lang, source, "pair", item, -v, r + 1) for r, (v, _, item) in enumerate(sorted(pairs))]
        out += [(lang, source, "term", item, -v, r + 1) for r, (v, _, item) in enumerate(sorted(listed)[:terms])]
    return sorted(out)


def documents(r, n=260):
    vocabulary = [f"{a}{b}" for a in ("a", "ab", "abc", "é", "éa", "日本語", "x" * 7, "x" * 8, "y" * 40) for b in ("", "a", "bcd", "ü", "z" * 3, "q" * 20)]
    docs = []
    for _ in range(n):
        lang = r.choice(["en", "en", "en", "fr", None])
        some = vocabulary[:: r.choice([1, 2, 5])]
        docs.append((lang, r.choice(["s1", "s2", "S3", "s4", "é", None]), r.choice([" ", "1", ", "]).join(r.choice(some).title() for _ in range(r.choice([0, 2, 9, 40])))))
    docs += [("de", "s1", None), ("de", "s2", "einmal"), (None, None, None), ("it", "s1", ""), ("en", "s1", "long" * 5000)] + [("fr", "s9", "long" * 3000)] * 12
    return docs


@pytest.mark.parametrize("how", [{}, {"tile_sources": 1, "tile_terms": 3}, {"first_level": 1, "deep": 2}, {"first_level": 64}])
def test_like_brute_force(rows, how):
    docs = documents(random.Random(4))
    got = divergence(rows(docs, DOCS, 5), **how)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == brute(docs)


def test_joined_by_shuffle(rows, monkeypatch):
    monkeypatch.setattr(iceberg, "light", lambda frame: frame)
    docs = documents(random.Random(8), 120)
    assert sorted(map(tuple, divergence(rows(docs, DOCS), 4, 3).collect())) == brute(docs, 4, 3)


def test_levels_discard_prefixes(rows, spark):
    """A prefix below the threshold isn't extended; the terms are those that a plain count keeps."""
    docs = [("en", "s", f"rare{'abcdefghij'[k % 10]}{k:03d}".translate({48 + i: 97 + i for i in range(10)}) + " common commons commonsense" + " unique" * (k < 9)) for k in range(40)]
    scratch = Scratch(spark, "test")
    bags = scratch.keep(term_bags(rows(docs, DOCS)), "bags")
    got = frequent_terms(bags, scratch, 10, 2)
    assert {(r.lang, bytes(r.term).decode()) for r in got.collect()} == {("en", t) for t in kept_of(docs, 10)["en"]}
    levels = {k: {bytes(r.term) for r in spark.read.parquet(f"{scratch.root}/level-{k}").collect()} for k in (2, 4, 8, 16)}
    assert levels[2] == {b"ra", b"co"} and levels[4] == {b"rare", b"comm"} and levels[8] == {b"common\0", b"commons\0", b"commonse"} and levels[16] == {b"commonsense\0"}


def test_repeated_rows_and_clashing_columns(rows):
    docs = [("en", "a", "one two two")] * 10 + [("en", "b", "two three")] * 10
    more = rows([(*d, 1, "x") for d in docs], f"{DOCS}, n int, Term string")
    assert sorted(map(tuple, divergence(more).collect())) == brute(docs)


def test_empty_tables_and_texts(rows):
    assert divergence(rows([], DOCS)).count() == 0
    docs = [("en", "a", None), ("en", "b", "123"), (None, None, "")]
    assert sorted(map(tuple, divergence(rows(docs, DOCS)).collect())) == brute(docs) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_counts_beyond_64_bits(spark):
    frame = spark.sql("select 30000000000L as n, 40000000000L as total, 5L as v")
    assert frame.select(iceberg._p("n", "total", "v").alias("p")).first().p == 1 + 10**9 * (3 * 10**10 + 2) // (4 * 10**10 + 10)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_like_its_sql(spark, folder):
    frame = op13_divergence(spark, folder)
    names, wanted, _ = expected(connect(folder), OP13_SQL)
    assert sorted(frame.columns) == names and rows_of(frame.columns, frame.collect()) == wanted
