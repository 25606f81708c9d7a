"""Ranked lexical search: exact largest inner products of sparse vectors through ball trees."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from propgraph.llm.common import Scratch, table

#: Bytes of terms up to which items are searched together; more items are searched in blocks.
BLOCK_BYTES = 16 << 20
#: Terms of documents that one tree holds at most, but for a document of more.
TREE_TERMS = 1 << 20
#: Documents of a leaf.
LEAF = 128
#: Times that a node's halves are dealt anew by their centres.
REFINE = 3
#: Rows that a task hands on at once.
BATCH = 4096

#: Every byte that is part of no term becomes a space, A-Z become a-z.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_ULP = 2.0**-50


def terms_of(text: bytes) -> list[bytes]:
    """Maximal runs of letters, digits and signs beyond ASCII, A-Z lower-cased."""
    return text.translate(_FOLD).split()


def _bytes(column: pa.Array) -> Iterator[bytes]:
    return (x.as_buffer().to_pybytes() if x.is_valid else b"" for x in column)


def slices(bounds: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the slices bounds[i] : bounds[i + 1] for i in which, and where each begins among them."""
    lengths = bounds[which + 1] - bounds[which]
    ends = np.cumsum(lengths)
    starts = ends - lengths
    return np.repeat(bounds[which] - starts, lengths) + np.arange(ends[-1] if len(ends) else 0), np.append(starts, len(starts) and ends[-1])


class BallTree:
    """Documents in a binary tree; each node knows the centre and radius of its documents.

    Rows are sparse: the terms ids[bounds[i] : bounds[i + 1]] have the whole numbers `values`, and
    weights (over all terms) make the inner product of a query, which is a set of terms. For bounds,
    rows and queries are both scaled by the root of the weights, which leaves inner products as they are.
    """

    def __init__(self, ids: np.ndarray, values: np.ndarray, bounds: np.ndarray, weights: np.ndarray, leaf: int = LEAF):
        self.terms, ids = np.unique(ids, return_inverse=True)
        self.weights = weights[self.terms]
        self.roots = np.sqrt(self.weights.astype(float))
        self.centres: list[tuple[np.ndarray, np.ndarray]] = []
        self.radius: list[float] = []
        self.children: list[tuple[int, int] | None] = []
        self.range: list[tuple[int, int]] = []
        scaled = values * self.roots[ids]
        order = np.arange(len(bounds) - 1)
        open_nodes = [(0, len(order), -1, 0)]
        while open_nodes:
            a, b, parent, side = open_nodes.pop()
            node = len(self.radius)
            if parent >= 0:
                self.children[parent] = (node, -1) if not side else (self.children[parent][0], node)
            place, starts = slices(bounds, order[a:b])
            own, x = ids[place], scaled[place]
            centre, far = self._ball(own, x, starts)
            self.range.append((a, b))
            self.children.append(None)
            if b - a <= leaf:
                continue
            # from two documents far from each other to one, then between the centres of the halves, which parts groups
            middle = (a + b) // 2
            along = -self._products(own, x, starts, np.argmax(far))
            along += self._products(own, x, starts, np.argmax(np.add.reduceat(x * x, starts[:-1]) + 2 * along))
            for _ in range(REFINE):
                side = np.where(np.argsort(np.argsort(along, kind="stable")) < middle - a, -1.0, 1.0)
                apart = np.bincount(own, x * np.repeat(side, np.diff(starts)), len(self.terms))
                along = np.add.reduceat(x * apart[own], starts[:-1])
            order[a:b] = order[a:b][np.argsort(along, kind="stable")]
            self.children[node] = (-1, -1)
            open_nodes += [(middle, b, node, 1), (a, middle, node, 0)]
        place, self.bounds = slices(bounds, order)
        self.ids, self.values, self.order = ids[place], values[place], order

    def _ball(self, ids: np.ndarray, x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Notes centre and radius, rounded up; also returns each document's distance."""
        if 4 * len(ids) > len(self.terms):
            sums = np.bincount(ids, x, len(self.terms))
            support = np.flatnonzero(np.bincount(ids, minlength=len(self.terms)))
            centre = sums / (len(starts) - 1)
            dots = np.add.reduceat(x * centre[ids], starts[:-1])
            centre = centre[support]
        else:
            support, at = np.unique(ids, return_inverse=True)
            centre = np.bincount(at, x) / (len(starts) - 1)
            dots = np.add.reduceat(x * centre[at], starts[:-1])
        squares = np.add.reduceat(x * x, starts[:-1]) + centre @ centre
        # what rounding may have taken off is given back: sums of k terms err by k units in the last place
        far = np.sqrt(np.maximum(squares - 2 * dots, 0) + (len(ids) + 64) * _ULP * squares) * (1 + _ULP)
        self.centres.append((support, centre))
        self.radius.append(float(far.max()))
        return centre, far

    def _products(self, ids: np.ndarray, x: np.ndarray, starts: np.ndarray, one: int) -> np.ndarray:
        dense = np.zeros(len(self.terms))
        dense[ids[starts[one] : starts[one + 1]]] = x[starts[one] : starts[one + 1]]
        return np.add.reduceat(x * dense[ids], starts[:-1])

    def bound(self, node: int, query: np.ndarray) -> float:
        """No document of the node has a larger inner product with the query.

        A query's terms that no document of the node has don't count for its length.
        """
        support, centre = self.centres[node]
        own = query[support]
        return (own @ centre + math.sqrt(own @ own) * self.radius[node]) * (1 + (len(support) + 64) * _ULP)

    def search(self, terms: np.ndarray, top: "Top", names: np.ndarray, unnamed: np.ndarray) -> int:
        """Offers all documents that may be among the top; best bound first. Returns how many were scored."""
        at = np.searchsorted(self.terms, terms)
        at = at[at < len(self.terms)]
        at = at[np.isin(self.terms[at], terms)]
        if not len(at) or not self.weights[at].any():
            return 0
        query, weights, scored = np.zeros(len(self.terms)), np.zeros(len(self.terms), np.int64), 0
        query[at], weights[at] = self.roots[at], self.weights[at]
        open_nodes = [(-self.bound(0, query), 0)]
        while open_nodes and -open_nodes[0][0] >= top.least:
            node = heapq.heappop(open_nodes)[1]
            if self.children[node]:
                for child in self.children[node]:
                    if (most := self.bound(child, query)) >= top.least:
                        heapq.heappush(open_nodes, (-most, child))
                continue
            a, b = self.range[node]
            low, high = self.bounds[a], self.bounds[b]
            scores = np.add.reduceat(weights[self.ids[low:high]] * self.values[low:high], self.bounds[a:b] - low)
            scored += b - a
            found = np.flatnonzero(scores >= top.least)
            if len(found):
                rows = self.order[a:b][found]
                top.offer(scores[found], names[rows], unnamed[rows])
        return scored


class Top:
    """The k largest scores above 0; equal ones by ascending name, no name last."""

    def __init__(self, k: int):
        self.k, self.least = k, 1
        self.scores, self.names, self.unnamed = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    def offer(self, scores: np.ndarray, names: np.ndarray, unnamed: np.ndarray) -> None:
        scores, names, unnamed = (np.concatenate(x) for x in ((self.scores, scores), (self.names, names), (self.unnamed, unnamed)))
        order = np.lexsort((names, unnamed, -scores))[: self.k]
        self.scores, self.names, self.unnamed = scores[order], names[order], unnamed[order]
        if len(order) == self.k:
            self.least = int(self.scores[-1])


def _counting_task(shared):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each document with a term: doc_id, n, and its terms that some item has, with their counts."""
        known = shared.value
        for batch in batches:
            rows, n, ids, counts = [], [], [], []

            def out() -> pa.RecordBatch:
                arrays = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(n, pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))]
                for kept in (rows, n, ids, counts):
                    kept.clear()
                return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n", "ids", "counts"])

            for i, text in enumerate(_bytes(batch.column(1))):
                words = terms_of(text)
                if not words:
                    continue
                own, many = np.unique(np.array([k for k in map(known.get, words) if k is not None], np.int32), return_counts=True)
                rows.append(i), n.append(len(words)), ids.append(own), counts.append(many)
                if len(rows) == BATCH:
                    yield out()
            yield out()

    return task


def _search_task(shared, k: int, tree_terms: int, leaf: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The best documents of the task's rows for each item; trees of bounded size one after the other."""
        items, weights, total, terms = shared.value
        tops = [Top(k) for _ in items]
        names, unnamed, ids, values, lengths, held = [], [], [], [], [], 0

        def searched() -> None:
            tree = BallTree(np.concatenate(ids), np.concatenate(values), np.append(0, np.cumsum(np.concatenate(lengths))), weights, leaf)
            own, null = np.concatenate(names), np.concatenate(unnamed)
            for (_, asked), top in zip(items, tops, strict=True):
                tree.search(asked, top, own, null)
            for kept in (names, unnamed, ids, values, lengths):
                kept.clear()

        for batch in batches:
            doc = batch.column("doc_id")
            n = batch.column("n").to_numpy()
            bounds = batch.column("ids").offsets.to_numpy()
            own, many = batch.column("ids").values.to_numpy(), batch.column("counts").values.to_numpy()
            # 50 * n * N may pass 64 bits: then whole numbers of Python's
            m = 50 + (50 * n.astype(object) * total // terms if 50 * int(n.max(initial=0)) * total >= 2**63 else 50 * n * total // terms)
            a = 0
            while a < len(batch):
                b = max(a + 1, int(np.searchsorted(bounds, bounds[a] + tree_terms, "right")) - 1)
                length = np.diff(bounds[a : b + 1])
                tf = many[bounds[a] : bounds[b]]
                value = 1_000_000_000 * tf // (1000 * tf + 20 * np.repeat(m[a:b].astype(np.int64), length))
                some = np.flatnonzero(length) + a
                names.append(doc.fill_null(0).to_numpy()[some]), unnamed.append(doc.is_null().to_numpy(zero_copy_only=False)[some])
                ids.append(own[bounds[a] : bounds[b]]), values.append(value), lengths.append(length[length > 0])
                held += len(tf)
                if held >= tree_terms:
                    searched()
                    held = 0
                a = b
        if held:
            searched()
        for (item, _), top in zip(items, tops, strict=True):
            if len(top.scores):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(top.scores), pa.int64()), pa.array(top.names, mask=top.unnamed), pa.array(top.scores)], names=["item_id", "doc_id", "score"])

    return task


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for item, text in zip(batch.column(0), _bytes(batch.column(1)), strict=True):
            own = sorted(set(terms_of(text)))
            yield pa.RecordBatch.from_arrays([pa.array([item.as_py()] * len(own), pa.int64()), pa.array(own, pa.binary())], names=["item_id", "term"])


def blocks_of(asked: DataFrame, block_bytes: int) -> int:
    """Into how many blocks items are dealt by hash, so that no block's terms pass block_bytes (an item alone may)."""
    size = F.sum(F.octet_length("term") + 16)
    own = asked.groupBy("item_id").agg(size.alias("size"))
    total, largest = own.agg(F.sum("size"), F.max("size")).first()
    blocks = max(1, -(-(total or 0) // block_bytes))
    limit = max(2 * block_bytes, 2 * (largest or 0))
    while blocks > 1 and own.groupBy(F.pmod(F.xxhash64("item_id"), F.lit(blocks)).alias("b")).agg(F.sum("size").alias("s")).agg(F.max("s")).first()[0] > limit:
        blocks *= 2
    return blocks


def search(docs: DataFrame, items: DataFrame, k: int = 50, block_bytes: int = BLOCK_BYTES, tree_terms: int = TREE_TERMS, leaf: int = LEAF) -> DataFrame:
    """(item_id, rank, doc_id, score): the k highest-scoring of all docs for each item, scores above 0.

    docs: doc_id, text; items: item_id, text. Terms are runs of letters, digits and anything beyond ASCII,
    A-Z lower-cased. The score of a document sums, over an item's distinct terms, the term's weight
    floor(1000 ln((2N + 2) / (2 df + 1))) times 10^9 tf div (1000 tf + 20 m), m = 50 + 50 n N div L: n terms in the
    document, L in all N documents that have any. Equal scores go by ascending doc_id, null last.

    Every row of docs is a document, so a doc_id that repeats may be listed repeatedly. Items of one
    item_id, null too, are one item with the terms of all. Null and empty texts have no terms. Other
    columns aren't read. Empty tables give no rows.

    The statistics cover all documents. Items are the stated query set; their terms go to every task,
    in blocks of bounded size, each with a pass over the texts. A task holds one tree at a time and
    k documents an item; the rows shuffled are k an item and task.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lexical")
    asked = items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).mapInArrow(_item_terms, "item_id long, term binary").distinct()
    asked = scratch.keep(asked, "asked")
    blocks, parts = blocks_of(asked, block_bytes), []
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    for b in range(blocks):
        rows = asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).groupBy("item_id").agg(F.sort_array(F.collect_list("term")).alias("terms")).collect()
        known = {term: i for i, term in enumerate(sorted({bytes(t) for r in rows for t in r.terms}))}
        known_shared = spark.sparkContext.broadcast(known)
        counted = scratch.keep(texts.mapInArrow(_counting_task(known_shared), "doc_id long, n long, ids array<int>, counts array<long>"), f"counted-{b}")
        total, terms = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        weights = np.zeros(len(known), np.int64)
        for i, df in counted.select(F.explode("ids").alias("id")).groupBy("id").count().collect():  # at most the block's terms
            weights[i] = math.floor(1000 * math.log((2 * total + 2) / (2 * df + 1)))
        own = [(r.item_id, np.array([known[bytes(t)] for t in r.terms], np.int64)) for r in rows]
        shared = spark.sparkContext.broadcast((own, weights, total, max(terms, 1)))
        found = counted.filter("size(ids) > 0").mapInArrow(_search_task(shared, k, tree_terms, leaf), "item_id long, doc_id long, score long")
        parts.append(scratch.keep(found, f"found-{b}"))
        scratch.drop(f"counted-{b}")
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def op12_lexical_search(spark, sf_dir: str) -> DataFrame:
    """Every benchmark item's 50 best documents."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""
OP12_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, {_TERMS} AS t FROM documents),
a AS (SELECT count(*) AS all_docs, sum(len(t))::BIGINT AS all_terms FROM d WHERE len(t) > 0),
q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
f AS (SELECT k, term, count(*) AS tf FROM (SELECT k, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * all_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM f, a GROUP BY term, all_docs),
s AS (
    SELECT item_id, k, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * len(t) * all_docs) // all_terms)))))::BIGINT AS score
    FROM q JOIN w USING (term) JOIN f USING (term) JOIN d USING (k), a GROUP BY item_id, k, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 50
"""
