"""Approximate nearest neighbours with robust-pruned directed graphs, one a shard.

Vectors are dealt into shards of bounded size. In a shard, points enter batch by batch: a greedy
search from the medoid over the graph so far proposes neighbours, robust pruning keeps a diverse few
(a candidate goes if a kept neighbour is alpha times closer to it than the point is), and edges run
back as well, pruned where there are too many. Queries walk each shard's graph by beam search.
Batches are searched together: each step is a few numpy operations over all points of the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from propgraph.llm.common import Scratch, table

#: Vectors of a shard, about; edges of a point; beam of searches when building and when querying; pruning slack.
SHARD_ROWS, DEGREE, BUILD_BEAM, QUERY_BEAM, ALPHA = 4096, 32, 48, 96, 1.05
#: Points searched together.
BATCH = 512


def _gathered(points: np.ndarray, of: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Squared distances of each query to its row of points; -1 stands for none."""
    out = 2 - 2 * np.einsum("qd,qkd->qk", of, points[rows])
    return np.where(rows >= 0, out, np.inf)


def beam_search(points: np.ndarray, edges: np.ndarray, start: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """The beam closest points found for each query, nearest first, and their squared distances; -1: none.

    Each step expands every query's nearest point that isn't expanded yet, until there is none.
    """
    n = len(queries)
    ids = np.full((n, beam), -1)
    far = np.full((n, beam), np.inf)
    open_ = np.zeros((n, beam), bool)
    ids[:, 0], open_[:, 0] = start, True
    far[:, 0] = _gathered(points, queries, ids[:, :1])[:, 0]
    seen = np.zeros((n, len(points)), bool)
    seen[:, start] = True
    live = np.arange(n)
    while len(live):
        first = open_[live].argmax(1)
        some = open_[live, first]
        live, first = live[some], first[some]
        if not len(live):
            break
        open_[live, first] = False
        new = edges[ids[live, first]]
        new = np.where((new >= 0) & ~seen[live[:, None], new], new, -1)
        at, k = np.nonzero(new >= 0)
        seen[live[at], new[at, k]] = True
        both = np.concatenate([ids[live], new], 1)
        away = np.concatenate([far[live], _gathered(points, queries[live], new)], 1)
        opened = np.concatenate([open_[live], new >= 0], 1)
        order = np.argsort(away, 1, kind="stable")[:, :beam]
        ids[live] = np.take_along_axis(both, order, 1)
        far[live] = np.take_along_axis(away, order, 1)
        open_[live] = np.take_along_axis(opened, order, 1) & np.isfinite(far[live])
    return np.where(np.isfinite(far), ids, -1), far


def robust_prune(points: np.ndarray, own: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Neighbours of each of `own` out of its row of candidates (-1: none), nearest first."""
    candidates = np.where(candidates == own[:, None], -1, candidates)
    candidates = np.sort(candidates, 1)
    candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = -1
    away = _gathered(points, points[own], candidates)
    order = np.argsort(away, 1, kind="stable")
    candidates, away = np.take_along_axis(candidates, order, 1), np.take_along_axis(away, order, 1)
    between = 2 - 2 * np.einsum("qad,qbd->qab", points[candidates], points[candidates])
    out = np.full((len(own), degree), -1)
    left = np.isfinite(away)
    rows = np.arange(len(own))
    for k in range(degree):
        best = left.argmax(1)
        some = left[rows, best]
        if not some.any():
            break
        out[some, k] = candidates[some, best[some]]
        # squared distances: the slack counts twice
        left &= ~(some[:, None] & (alpha * alpha * between[rows, best] <= away))
        left[rows, best] = False
    return out


def build(points: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA) -> tuple[np.ndarray, int]:
    """(edges of each point, entry point) over unit vectors. Batches double from one point to BATCH."""
    n = len(points)
    edges = np.full((n, degree), -1)
    start = int(np.argmax(points @ points.mean(0)))
    order = np.random.default_rng(7).permutation(n)
    order = np.concatenate([[start], order[order != start]])
    for slack in (1.0, alpha):
        at = 1 if slack == 1.0 else 0
        while at < n:
            to = min(n, at + (min(at, BATCH) if slack == 1.0 else BATCH))
            own = order[at:to]
            found, _ = beam_search(points, edges, start, points[own], beam)
            edges[own] = robust_prune(points, own, np.concatenate([found, edges[own]], 1), degree, slack)
            # edges back: those of one target come together, and are pruned with its own
            source, k = np.nonzero(edges[own] >= 0)
            target, source = edges[own][source, k], own[source]
            by = np.argsort(target, kind="stable")
            target, source = target[by], source[by]
            met, first, many = np.unique(target, return_index=True, return_counts=True)
            rank = np.arange(len(target)) - np.repeat(first, many)
            for low in range(0, int(many.max()) if len(many) else 0, degree):  # so that rows stay narrow
                part = (rank >= low) & (rank < low + degree)
                more = np.full((len(met), degree), -1)
                more[np.repeat(np.arange(len(met)), many)[part], rank[part] - low] = source[part]
                some = (more >= 0).any(1)
                for a in range(0, int(some.sum()), BATCH):
                    rows = np.flatnonzero(some)[a : a + BATCH]
                    edges[met[rows]] = robust_prune(points, met[rows], np.concatenate([edges[met[rows]], more[rows]], 1), degree, slack)
            at = to
    return edges, start


def _shard_task(k: int, beam: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by shard, its vectors first (query_id null), then queries: the index is built once."""
        shard, rows, waiting, graph = None, [], [], None

        def searched() -> pa.RecordBatch:
            ids, points, edges, start = graph
            asked = np.array([v for _, v in waiting])
            found, far = beam_search(points, edges, start, asked, max(beam, k))
            own, j = np.nonzero(found[:, :k] >= 0)
            out = pa.RecordBatch.from_arrays(
                [pa.array(np.array([q for q, _ in waiting], np.int64)[own]), pa.array(ids[found[own, j]])], names=["query_class", "class"])
            waiting.clear()
            return out

        for batch in batches:
            sid, kind, cid = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("shard", "asks", "class"))
            flat, ends = batch.column("unit").values.to_numpy(zero_copy_only=False), batch.column("unit").offsets.to_numpy()
            for i in range(len(sid)):
                if sid[i] != shard:
                    if waiting:
                        yield searched()
                    shard, rows, graph = sid[i], [], None
                vector = flat[ends[i] : ends[i + 1]]
                if not kind[i]:
                    rows.append((cid[i], vector.copy()))
                    continue
                if not rows:
                    continue
                if graph is None:
                    points = np.array([v for _, v in rows])
                    graph = (np.array([c for c, _ in rows], np.int64), points, *build(points))
                waiting.append((cid[i], vector.copy()))
                if len(waiting) == BATCH:
                    yield searched()
        if waiting:
            yield searched()

    return task


def nearest(vectors: DataFrame, asks: str, k: int = 5, beam: int = QUERY_BEAM, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest others of each row of vectors for which the condition `asks` holds.

    vectors: vec_id, embedding (array of numbers). Score is the cosine in double precision, computed
    from the original vectors for what the graphs propose; nearest first, ties to smaller vec_id. Vectors
    that are null, empty, zero or hold null or not finite components take no part, nor do rows without
    vec_id; vectors of another length than most share no query with them. A vec_id that repeats is as
    many candidates and, asking, one query for each of its vectors. Other columns aren't read.

    Rows of one vector are one point of the graphs, with its k + 1 least ids: no query needs more of
    them, so a vector that a third of all rows share costs no more than one. Shards are dealt by hash and
    hold about shard_rows points; each is built and searched in one task. Queries go to every shard.
    """
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    own = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("v"), F.expr(asks).alias("asks")).filter(
        "vec_id is not null and size(v) > 0 and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    own = own.withColumn("norm", norm).filter(F.col("norm") > 0)
    scratch = Scratch(vectors.sparkSession, "vectors")
    # -0.0 and 0.0 are one: adding 0.0 makes them equal
    own = own.withColumn("v", F.transform("v", lambda x: x + 0.0))
    rank = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    heads = own.groupBy("v").agg(F.first("norm").alias("norm"), F.max(F.coalesce("asks", F.lit(False))).alias("asks"), F.count("*").alias("rows"))
    classes = scratch.keep(heads.withColumn("class", F.monotonically_increasing_id()), "classes")
    shards = max(1, -(-classes.count() // shard_rows))
    members = own.select("vec_id", "v").withColumn("k", rank).filter(F.col("k") <= k + 1)
    members = scratch.keep(members.join(classes.select("v", "class"), "v").select("class", "vec_id"), "members")
    queries = scratch.keep(own.filter("asks").select(F.col("vec_id").alias("query_id"), "v").join(
        classes.select("v", F.col("class").alias("query_class")), "v").select("query_id", "query_class").distinct(), "queries")
    unit = F.transform("v", lambda x: x / F.col("norm"))
    width = F.size("v")
    points = classes.select(F.pmod(F.xxhash64("v"), F.lit(shards)).alias("shard"), width.alias("width"), F.lit(False).alias("asks"), "class", unit.alias("unit"))
    asked = classes.filter("asks").select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"), width.alias("width"), F.lit(True).alias("asks"), "class", unit.alias("unit"))
    rows = points.union(asked).withColumn("shard", F.col("shard") + F.lit(shards) * F.col("width"))  # vectors of one length meet
    found = rows.repartition("shard").sortWithinPartitions("shard", "asks", "class").mapInArrow(
        _shard_task(k + 1, beam), "query_class long, class long")
    # scores anew, in one order of sums, from the original vectors
    left, right = classes.select(F.col("class").alias("query_class"), F.col("v").alias("a"), F.col("norm").alias("p")), classes.select("class", F.col("v").alias("b"), F.col("norm").alias("q"), "rows")
    dot = F.aggregate(F.arrays_zip("a", "b"), F.lit(0.0), lambda s, x: s + x["a"] * x["b"])
    own_class = classes.filter("asks and rows > 1").select(F.col("class").alias("query_class"), "class")  # copies of the query itself
    pairs = found.union(own_class).distinct().join(left, "query_class").join(right, "class").filter("query_class <> class or rows > 1")
    pairs = scratch.keep(pairs.select("query_class", "class", (dot / (F.col("p") * F.col("q"))).alias("score")), "pairs")
    # k + 1 classes hold the k nearest; those that tie with the last stay
    pairs = pairs.withColumn("r", F.rank().over(Window.partitionBy("query_class").orderBy(F.desc("score")))).filter(F.col("r") <= k + 1)
    few = pairs.join(members, "class").withColumn(
        "r", F.row_number().over(Window.partitionBy("query_class").orderBy(F.desc("score"), "vec_id"))).filter(F.col("r") <= k + 1)
    out = queries.join(few.select("query_class", "vec_id", "score"), "query_class").filter("query_id <> vec_id")
    return out.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "query_class").orderBy(F.desc("score"), "vec_id"))).filter(
        F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op4_vector_graph(spark, sf_dir: str) -> DataFrame:
    """The five nearest others of every vector whose id is divisible by 50."""
    return nearest(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0")
