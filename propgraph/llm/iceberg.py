"""Source divergence audit: frequent terms by iceberg prefix refinement, then how sources differ over them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propgraph.llm.common import Scratch, light, table

#: Documents of a language that a kept term stands in.
LEAST_DOCS = 10
#: Terms that a part lists for a source.
TERMS = 10
#: Bytes of the first level's prefixes; each level doubles them.
FIRST_LEVEL = 4
#: Level from which the terms still open are written anew, as they are few.
DEEP = 16
#: Terms counted at once in a task, bytes of text read at once, and rows handed on at once.
TALLY, CHUNK, BATCH = 1 << 19, 2 << 20, 1 << 16
#: Different values up to which counts are an array with a place for each.
PLACES = 1 << 23
#: Sources and terms of a tile of the comparison: a task holds two tiles.
TILE_SOURCES, TILE_TERMS = 48, 4096

#: Every byte that is part of no term becomes a space, A-Z become a-z.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Ends a term; no term holds it.
_END = b"\0"


def _summed(values: np.ndarray, n: np.ndarray | None, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The different values, all below `most`, and the sum of n (None: 1 each) of each."""
    if most <= PLACES and (n is None or n.sum() < 2**53):
        sums = np.bincount(values, n).astype(np.int64)
        met = np.flatnonzero(sums)
        return met, sums[met]
    met, which = np.unique(values, return_inverse=True)
    sums = np.zeros(len(met), np.int64)
    np.add.at(sums, which, 1 if n is None else n)
    return met, sums


def _blobs(flat: pa.Array, bounds: np.ndarray) -> pa.Array:
    """The terms of each row as one value, one after the other: flat has ended terms, bounds where each row's begin."""
    ends = np.frombuffer(flat.buffers()[1], np.int32)[flat.offset : flat.offset + len(flat) + 1]
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(ends[bounds].tobytes()), flat.buffers()[2] or pa.py_buffer(b"")])


def _ended_terms(blobs: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of a column of blobs, with their end marks, and where each row's begin."""
    ends = np.frombuffer(blobs.buffers()[1], np.int32)[blobs.offset : blobs.offset + len(blobs) + 1]
    data = np.frombuffer(blobs.buffers()[2] or b"", np.uint8)[: ends[-1]]
    marks = np.flatnonzero(data[ends[0] :] == 0) + 1 + ends[0]
    bounds = np.searchsorted(marks, ends, "right")
    places = np.concatenate([ends[:1], marks]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(marks), [None, pa.py_buffer(places.tobytes()), pa.py_buffer(data)]), bounds


def _bag(texts: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Of texts: their distinct terms with end marks, text after text, each in order of bytes; counts; where each text's begin."""
    tokens, lengths = [], []
    for text in texts:
        own = text.translate(_FOLD).split()
        tokens += own
        lengths.append(len(own))
    coded = pa.array(tokens, pa.binary()).dictionary_encode()
    order = pc.array_sort_indices(coded.dictionary).to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    pair = np.repeat(np.arange(len(texts)), lengths) * max(1, len(order)) + place[coded.indices.to_numpy()]
    met, counts = np.unique(pair, return_counts=True)
    bounds = np.searchsorted(met, np.arange(len(texts) + 1) * max(1, len(order)))
    ended = pc.binary_join_element_wise(coded.dictionary.take(pa.array(order)), pa.scalar(_END, pa.binary()), pa.scalar(b"", pa.binary()))
    return ended.take(pa.array(met % max(1, len(order)))), counts, bounds


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, at = batch.column("text"), 0
        while at < len(batch):
            raw, size = [], 0
            while at + len(raw) < len(batch) and size < CHUNK:
                text = texts[at + len(raw)]
                raw.append(text.as_buffer().to_pybytes() if text.is_valid else b"")
                size += len(raw[-1])
            terms, counts, bounds = _bag(raw)
            rows = batch.slice(at, len(raw))
            packed = pa.Array.from_buffers(pa.binary(), len(raw), [None, pa.py_buffer((8 * bounds).astype(np.int32).tobytes()), pa.py_buffer(counts.astype("<i8").tobytes())])
            yield pa.RecordBatch.from_arrays([rows.column("lang"), rows.column("source"), _blobs(terms, bounds), packed], names=["lang", "source", "terms", "counts"])
            at += len(raw)


def term_bags(docs: DataFrame) -> DataFrame:
    """A row for each document: lang, source, its distinct terms and their counts.

    Terms stand in one value in the order of their bytes, each closed by a zero byte; counts in one of 64-bit numbers.
    """
    own = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    return own.mapInArrow(_bags, "lang string, source string, terms binary, counts binary")


def _longer(level: int):
    """Bags with only the terms of `level` bytes or more, and only those that have any."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, bounds = _ended_terms(batch.column("terms"))
            some = pc.greater(pc.binary_length(terms), level).to_numpy(zero_copy_only=False)
            kept = np.append(0, np.cumsum(some))[bounds]
            rows = np.flatnonzero(np.diff(kept))
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang").take(pa.array(rows)), _blobs(terms.filter(pa.array(some)), np.append(kept[rows], kept[-1]))], names=["lang", "terms"])

    return task


def _codes(columns: list[pa.Array]) -> tuple[np.ndarray, pa.RecordBatch]:
    """A number for each row's values, and the values of each number."""
    numbers, parts = np.zeros(len(columns[0]), np.int64), [c.dictionary_encode() for c in columns]
    for part in parts:
        numbers = numbers * len(part.dictionary) + part.indices.to_numpy()
    met, numbers = np.unique(numbers, return_inverse=True)
    values = []
    for part in reversed(parts):
        values.insert(0, part.dictionary.take(pa.array(met % max(1, len(part.dictionary)))))
        met //= max(1, len(part.dictionary))
    return numbers, pa.RecordBatch.from_arrays(values, names=[str(i) for i in range(len(values))])


def _slices(bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """Rows that hold about TALLY terms."""
    at = 0
    while at < len(bounds) - 1:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + TALLY, "right")) - 1)
        yield at, to
        at = to


def _prefix_counts(done: int, level: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(lang, term, n): in how many of a slice's documents the first `level` bytes of an ended term of more than `done` stand."""
        for batch in batches:
            own, names = _codes([batch.column("lang")])
            terms, bounds = _ended_terms(batch.column("terms"))
            for at, to in _slices(bounds):
                part, rows = terms.slice(bounds[at], bounds[to] - bounds[at]), np.repeat(np.arange(at, to), np.diff(bounds[at : to + 1]))
                if done:
                    still = pc.greater(pc.binary_length(part), done)
                    part, rows = part.filter(still), rows[still.to_numpy(zero_copy_only=False)]
                if not len(part):
                    continue
                coded = pc.binary_slice(part, 0, level).dictionary_encode()
                code, values = coded.indices.to_numpy().astype(np.int64), coded.dictionary
                # each document once: equal prefixes of its terms stand side by side
                first = np.append(True, (np.diff(rows) != 0) | (np.diff(code) != 0))
                met, sums = _summed(own[rows[first]] * len(values) + code[first], None, len(names) * len(values))
                for a in range(0, len(met), BATCH):
                    name, term = pa.array(met[a : a + BATCH] // len(values)), pa.array(met[a : a + BATCH] % len(values))
                    yield pa.RecordBatch.from_arrays([names.column(0).take(name), values.take(term), pa.array(sums[a : a + BATCH])], names=["lang", "term", "n"])

    return task


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n): occurrences in a slice's documents."""
    for batch in batches:
        own, names = _codes([batch.column("lang"), batch.column("source")])
        terms, bounds = _ended_terms(batch.column("terms"))
        for at, to in _slices(bounds):
            coded = pc.binary_slice(terms.slice(bounds[at], bounds[to] - bounds[at]), 0, -1).dictionary_encode()
            n = np.frombuffer(b"".join(batch.column("counts").slice(at, to - at).to_pylist()), "<i8")
            pair = np.repeat(own[at:to], np.diff(bounds[at : to + 1])) * len(coded.dictionary) + coded.indices.to_numpy()
            met, sums = _summed(pair, n, len(names) * max(1, len(coded.dictionary)))
            for a in range(0, len(met), BATCH):
                name, term = pa.array(met[a : a + BATCH] // len(coded.dictionary)), pa.array(met[a : a + BATCH] % len(coded.dictionary))
                yield pa.RecordBatch.from_arrays(
                    [*(c.take(name) for c in names.columns), coded.dictionary.take(term), pa.array(sums[a : a + BATCH])], names=["lang", "source", "term", "n"])


def _numbered_occurrences(shared):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(cell, n): occurrences of kept terms in a slice's documents; a cell is group times number of kept terms, plus term."""
        kept, many, groups = shared.value
        for batch in batches:
            own, names = _codes([batch.column("lang"), batch.column("source")])
            langs = names.column(0).to_pylist()
            group = np.array([groups[g] for g in zip(langs, names.column(1).to_pylist(), strict=True)], np.int64)
            terms, bounds = _ended_terms(batch.column("terms"))
            for at, to in _slices(bounds):
                part, of_row = terms.slice(bounds[at], bounds[to] - bounds[at]), np.repeat(own[at:to], np.diff(bounds[at : to + 1]))
                n = np.frombuffer(b"".join(batch.column("counts").slice(at, to - at).to_pylist()), "<i8")
                code = np.full(len(part), -1, np.int64)
                for lang in set(langs) & set(kept):
                    mine, first = kept[lang]
                    where = np.flatnonzero(np.array([x == lang for x in langs])[of_row])
                    code[where] = pc.index_in(part.take(pa.array(where)), mine).fill_null(-1 - first).to_numpy() + first
                some = np.flatnonzero(code >= 0)
                if not len(some):
                    continue
                met, sums = _summed(of_row[some] * many + code[some], n[some], len(names) * many)
                cells = group[met // many] * many + met % many
                for a in range(0, len(met), BATCH):
                    yield pa.RecordBatch.from_arrays([pa.array(cells[a : a + BATCH]), pa.array(sums[a : a + BATCH])], names=["cell", "n"])

    return task


def frequent_terms(bags: DataFrame, scratch: Scratch, least: int = LEAST_DOCS, first_level: int = FIRST_LEVEL, deep: int = DEEP) -> DataFrame:
    """(lang, term): the terms that stand in at least `least` of a language's documents.

    A prefix stands in every document that a term beginning with it stands in. So the documents of each
    prefix are counted level by level, only prefixes of kept ones are taken further, and what is below the
    threshold goes before the next level. An end mark closes each term, so a term is complete when
    its prefix shows the mark; levels go on until no kept prefix is open, however long its terms are.
    """
    done, level, kept, open_bags, survivors = 0, first_level, [], bags, None
    while True:
        counted = open_bags.select("lang", "terms").mapInArrow(_prefix_counts(done, level), "lang string, term binary, n long")
        if survivors is not None:
            parents = survivors.filter(~_ended("term")).select("lang", F.col("term").alias("parent"))
            counted = counted.withColumn("parent", F.expr(f"substring(term, 1, {done})")).join(light(parents), ["lang", "parent"], "left_semi")
        found = counted.groupBy("lang", "term").agg(F.sum("n").alias("docs")).filter(F.col("docs") >= least)
        survivors = scratch.keep(found.select("lang", "term"), f"level-{level}")
        kept.append(survivors.filter(_ended("term")).select("lang", F.expr("substring(term, 1, octet_length(term) - 1)").alias("term")))
        if survivors.filter(~_ended("term")).isEmpty():
            break
        if level >= deep:
            open_bags = scratch.keep(open_bags.select("lang", "terms").mapInArrow(_longer(level), "lang string, terms binary"), f"open-{level}")
        done, level = level, 2 * level
    out = kept[0]
    for more in kept[1:]:
        out = out.union(more)
    return out


def _ended(column: str) -> Column:
    return F.expr(f"substring({column}, -1, 1) = x'00'")


def _p(count: Column | str, total: str, v: str) -> Column:
    """1 + floor(10^9 (count + 2) / (total + 2 v)), also beyond 64 bits in between; 1 if nothing is kept."""
    count, whole = F.col(count) if isinstance(count, str) else count, F.col(total) + 2 * F.col(v)
    wide = F.call_function("div", (count.cast("decimal(20,0)") + 2) * F.lit(1_000_000_000).cast("decimal(10,0)"), whole.cast("decimal(20,0)"))
    share = F.when(count < 9_000_000_000, F.call_function("div", (count + 2) * F.lit(1_000_000_000).cast("long"), whole)).otherwise(wide)
    return F.when(F.col(v) == 0, F.lit(1).cast("long")).otherwise(share + 1)


def _by_language(kept: pa.Table) -> dict[str, tuple[pa.Array, int]]:
    """Of kept terms in order of their numbers: each language's, with end marks, and the first one's number."""
    lang, term = (kept[c].combine_chunks() for c in ("lang", "term"))
    names, firsts = np.unique(lang.to_numpy(zero_copy_only=False).astype(object), return_index=True)
    ends = [*firsts[1:], len(kept)][: len(firsts)]  # languages are in order
    term = pc.binary_join_element_wise(term, pa.scalar(_END, pa.binary()), pa.scalar(b"", pa.binary()))
    return {name: (term.slice(int(a), int(b - a)), int(a)) for name, a, b in zip(names, firsts, ends, strict=True)}


def _apart(p, q):
    return (p - q) * (p - q) // (p + q)


def _compared(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """Sums of one block of terms for all pairs of two tiles of sources, each pair once.

    Cells that no row has hold the source's least value. Each pair starts with what it has if every
    kept term is such a cell (counted in block 0 only); terms of the block then change that.
    """
    lang, block, i, j = (k.as_py() for k in key)
    tile, share = rows["tile"].to_numpy(), rows["p"].to_numpy()
    names = rows["source"].combine_chunks().dictionary_encode()
    source, number = names.indices.to_numpy(), rows["tid"].to_numpy()  # a source's own row has no term: -1
    terms = np.unique(number[number >= 0])
    term = np.where(number >= 0, np.searchsorted(terms, number), -1)
    sides = []
    for own in (i, j):
        head = np.flatnonzero((tile == own) & (term < 0))
        row = np.zeros(len(names.dictionary), np.int64)
        row[source[head]] = np.arange(len(head))
        matrix = np.repeat(share[head][:, None], len(terms), 1)
        cell = np.flatnonzero((tile == own) & (term >= 0))
        matrix[row[source[cell]], term[cell]] = share[cell]
        sides.append((source[head], share[head], matrix))
    (left, p0, p), (right, q0, q) = sides
    least = rows["v"][0].as_py() if block == 0 else 0
    out = [np.empty((3, 0), np.int64)]
    for a in range(len(left)):
        after = a + 1 if i == j else 0
        sums = _apart(p[a], q[after:]).sum(1) + _apart(p0[a], q0[after:]) * (least - len(terms))
        out.append(np.array([np.full(len(sums), left[a]), right[after:], sums]))
    left, right, value = np.concatenate(out, 1)
    return pa.table({"lang": pa.array([lang] * len(value), pa.string()), "source": names.dictionary.take(pa.array(left)), "item": names.dictionary.take(pa.array(right)), "value": value})


def divergence(docs: DataFrame, least: int = LEAST_DOCS, terms: int = TERMS, tile_sources: int = TILE_SOURCES, tile_terms: int = TILE_TERMS,
               first_level: int = FIRST_LEVEL, deep: int = DEEP) -> DataFrame:
    """(lang, source, part, item, value, rank): how each source of a language differs from others over the kept terms.

    Part `pair` has every other source of the language, part `term` the terms that a source has most above its
    language, the first `terms` of them. Each row of docs (lang, source, text) is a document, repeated
    rows too; null lang, source and text are ''. Other columns aren't read. A source without terms
    compares by its smoothed shares; a language without kept terms has pairs of value 0 and no terms.
    An empty table gives no rows.

    Terms, counts and sums cover all documents. Texts are read once; every level and the counts
    sum in the tasks before anything is shuffled. Pairs are compared in tiles of sources and terms, so no
    task grows with either; there are as many pairs as the report lists.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "divergence")
    bags = scratch.keep(term_bags(docs), "bags")
    found = frequent_terms(bags, scratch, least, first_level, deep)
    # numbers in the order of languages and of terms' bytes
    kept = scratch.keep(scratch.numbered(found, [F.col("lang"), F.col("term")], "tid", "found"), "kept")
    groups = scratch.numbered(bags.groupBy("lang", "source").count().select("lang", "source"), [F.col("lang"), F.col("source")], "gid", "all-groups")
    groups, total = scratch.keep(groups, "numbered-groups"), F.sum("n").alias("n")
    if light(kept) is kept or light(groups) is groups:  # too many to send: sum first, so that the join's shuffle has a row for each value
        counted = bags.mapInArrow(_occurrences, "lang string, source string, term binary, n long")
        counted = counted.groupBy("lang", "source", "term").agg(total).join(kept, ["lang", "term"])
    else:
        many = kept.count()
        numbers = {(r.lang, r.source): r.gid for r in groups.collect()}
        shared = spark.sparkContext.broadcast((_by_language(kept.orderBy("tid").toArrow()), many, numbers))
        counted = bags.mapInArrow(_numbered_occurrences(shared), "cell long, n long").groupBy("cell").agg(total)
        group, term = (F.call_function(f, F.col("cell"), F.lit(max(many, 1)).cast("long")) for f in ("div", "mod"))
        counted = counted.withColumns({"gid": group, "tid": term}).join(light(groups), "gid")
    cells = scratch.keep(counted.select("lang", "source", "tid", "n"), "cells")
    groups = groups.drop("gid")
    groups = groups.join(cells.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
    groups = groups.join(kept.groupBy("lang").agg(F.count("*").alias("v")), "lang", "left").fillna(0, ["total", "v"])
    groups = scratch.keep(groups, "groups")
    langs = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.count("*").alias("sources"))
    groups = scratch.keep(groups.join(langs, "lang"), "sized-groups")
    sums = scratch.keep(cells.groupBy("tid").agg(F.sum("n").alias("all")), "sums")
    cells = cells.join(light(groups), ["lang", "source"])

    of_terms = cells.join(light(sums), "tid").select("lang", "source", "tid", _p("n", "total", "v").alias("p"), _p("all", "lang_total", "v").alias("q")).filter("p > q")
    listed = of_terms.select("lang", "source", "tid", F.expr("(p - q) * (p - q) div (p + q)").alias("value"))
    first = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "tid"))
    listed = listed.withColumn("rank", first).filter(F.col("rank") <= terms)
    listed = listed.join(kept.select("tid", F.col("term").cast("string").alias("item")), "tid")

    tiles = F.ceil(F.col("sources") / tile_sources)
    tile = F.pmod(F.xxhash64("source"), tiles)
    blocks = F.greatest(F.lit(1), F.ceil(F.col("v") / tile_terms))
    heads = groups.select("lang", "source", F.lit(-1).cast("long").alias("tid"), _p(F.lit(0).cast("long"), "total", "v").alias("p"), "v", tile.alias("tile"), tiles.alias("tiles"),
                          F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("block"))
    full = cells.select("lang", "source", "tid", _p("n", "total", "v").alias("p"), "v", tile.alias("tile"), tiles.alias("tiles"), F.pmod("tid", blocks).alias("block"))
    dealt = heads.union(full).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    dealt = dealt.withColumns({"i": F.least("tile", "other"), "j": F.greatest("tile", "other")}).select("lang", "block", "i", "j", "tile", "source", "tid", "p", "v")
    sums = dealt.groupBy("lang", "block", "i", "j").applyInArrow(_compared, "lang string, source string, item string, value long")
    sums = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    both = sums.select("lang", "value", F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))).alias("x"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    pairs = both.select("lang", "x.source", "x.item", "value").withColumn("rank", rank)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(columns).union(listed.withColumn("part", F.lit("term")).select(columns))


def op13_divergence(spark, sf_dir: str) -> DataFrame:
    """All sources of all documents."""
    return divergence(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS t
    FROM documents),
o AS (SELECT k, lang, source, unnest(t) AS term FROM d),
kept AS (SELECT lang, term FROM o GROUP BY lang, term HAVING count(DISTINCT k) >= 10),
v AS (SELECT lang, count(term) AS v FROM (SELECT DISTINCT lang FROM d) LEFT JOIN kept USING (lang) GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM o GROUP BY lang, source, term),
f AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n, v FROM g JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term)),
p AS (SELECT *, 1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v) AS p FROM f),
l AS (SELECT lang, term, sum(n) AS n, any_value(v) AS v FROM f GROUP BY lang, term),
q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang) + 2 * v) AS q FROM l),
pair AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
    SELECT a.lang, a.source, b.source AS item, coalesce(value, 0)::BIGINT AS value
    FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source),
terms AS (SELECT lang, source, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank FROM pairs
UNION ALL
SELECT lang, source, 'term' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank FROM terms
QUALIFY rank <= 10
"""
