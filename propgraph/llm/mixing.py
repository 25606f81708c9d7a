"""Mixing sources to target weights by entropy balancing.

Of all rates r >= 0 with which documents may be taken, entropy balancing picks those closest to one
(in relative entropy) that give each source its target of words. They are exponentially tilted,
r = min(cap, exp(l * size)), with one multiplier l a source: the dual variable of its constraint.
Newton steps find the multipliers of all sources at once; each is an aggregate over the counts of
documents by source and size. Rates then become whole copies by error diffusion.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propgraph.llm.common import SPACE, Scratch, free_prefix, hashable, light, table, with_fields

#: Copies of a document at most; words of a target at most, in sizes of its source.
CAP = 3
#: Weights of sources in the order of their names, repeating.
WEIGHTS = (1, 2, 3)
#: Documents of a rounding bin, about.
BIN_ROWS = 20_000
#: Newton steps at most; a constraint holds when it is met to this share of its target, or half a word.
STEPS, TOLERANCE = 80, 1e-9


def sizes_of(text):
    """Words of a text, those between ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")


def targets(hist: DataFrame, scratch: Scratch) -> DataFrame:
    """(source, sid, docs, total, target) of each source, from (source, size, n).

    All sources together keep their words, shared by weight; a target above CAP times its source is cut
    to that and what is over shared by weight among the others, until none is above. One row a source; each
    round of cuts is an aggregate over them.
    """
    sums = hist.groupBy("source").agg(F.sum("n").alias("docs"), F.sum(F.col("size") * F.col("n")).alias("total"))
    out = scratch.numbered(sums, [F.col("source").asc_nulls_last()], "sid", "named")
    out = out.withColumn("weight", F.array(*map(F.lit, WEIGHTS))[(F.col("sid") % len(WEIGHTS)).cast("int")])
    full, level, cut = F.col("total") * CAP, 0.0, 0
    above = F.lit(False)
    while True:  # the level rises, so what was cut stays cut
        words, held, weights, n = out.agg(
            F.sum("total"), F.sum(F.when(above, full).otherwise(0)), F.sum(F.when(above, 0).otherwise(F.col("weight"))), F.count_if(above)).first()
        if (level > 0 and n == cut) or not weights:
            break
        level, cut = (words - held) / weights, n
        above = full <= F.col("weight") * F.lit(level)
    share = F.least(full.cast("double"), F.col("weight") * F.lit(float(level)))
    return out.select("source", "sid", "docs", "total", (full.cast("double") if not weights else share).alias("target"))


def multipliers(hist: DataFrame, sources: DataFrame, scratch: Scratch) -> DataFrame:
    """(sid, lam, mean): rates are min(CAP, exp(lam * size / mean)); lam null: all are CAP.

    Newton steps on the dual, kept within a bracket: a step that leaves it is halved, or doubled where
    one end is open. Each step is one pass over the counts; the driver sees how many sources are left.
    """
    state = scratch.keep(sources.filter("total > 0").select(
        "sid", "target", (F.col("total") / F.col("docs")).alias("mean"), (F.col("target") >= CAP * F.col("total") * (1 - 1e-12)).alias("full"),
        F.lit(0.0).alias("lam"), F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"), F.lit(False).alias("done")),
        "state-0")
    for k in range(1, STEPS + 1):
        y = F.col("size") / F.col("mean")
        rate = F.least(F.lit(float(CAP)), F.exp(F.least(F.col("lam") * y, F.lit(50.0))))
        words = F.col("n") * F.col("size") * rate
        sums = hist.filter("size > 0").join(light(state.filter("not done and not full")), "sid").groupBy("sid").agg(
            F.sum(words).alias("taken"), F.sum(F.when(rate < CAP, words * y).otherwise(0.0)).alias("slope"))
        gap = F.col("taken") - F.col("target")
        lo = F.when(gap < 0, F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(gap >= 0, F.col("lam")).otherwise(F.col("hi"))
        step = F.col("lam") - F.when(F.col("slope") > 0, gap / F.col("slope"))
        inside = step.isNotNull() & (lo.isNull() | (step > lo)) & (hi.isNull() | (step < hi)) & (F.abs(step - F.col("lam")) <= 4 + F.abs("lam"))
        fallback = F.when(lo.isNull(), hi - 1 - F.abs(hi)).when(hi.isNull(), lo + 1 + F.abs(lo)).otherwise((lo + hi) / 2)
        done = F.abs(gap) <= F.greatest(F.lit(0.5), F.col("target") * TOLERANCE)
        moved = state.join(sums, "sid", "left").withColumn("done", F.coalesce(done, F.col("done") | F.col("full")))
        state = scratch.keep(moved.select(
            "sid", "target", "mean", "full", F.when(F.col("taken").isNull() | F.col("done"), F.col("lam"))
            .otherwise(F.when(inside, step).otherwise(fallback)).alias("lam"),
            F.when(F.col("taken").isNull(), F.col("lo")).otherwise(lo).alias("lo"), F.when(F.col("taken").isNull(), F.col("hi")).otherwise(hi).alias("hi"),
            "done"), f"state-{k}")
        scratch.drop(f"state-{k - 1}")
        if state.filter("not done").isEmpty():
            break
    else:
        raise RuntimeError(f"{state.filter('not done').count()} sources don't meet their targets after {STEPS} steps")
    return state.select("sid", F.when(~F.col("full"), F.col("lam")).alias("lam"), "mean")


def _diffuse(names: list[str], p: str):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by bin, large documents first; what rounding leaves over goes to the next."""
        key, over = None, 0.0
        for batch in batches:
            at = {n: batch.column(k) for k, n in enumerate(batch.schema.names)}
            sid, bins, size, rate = (at[n].to_numpy(zero_copy_only=False) for n in (f"{p}sid", f"{p}bin", f"{p}size", f"{p}rate"))
            copies = np.zeros(len(sid), np.int64)
            for k in range(len(sid)):
                if (sid[k], bins[k]) != key:
                    key, over = (sid[k], bins[k]), 0.0
                if size[k] == 0:
                    copies[k] = 1
                    continue
                want = rate[k] * size[k] + over
                copies[k] = min(CAP, max(0, int(want / size[k] + 0.5)))
                over = want - copies[k] * size[k]
            mixed = {"size": at[f"{p}size"], "source_size": at[f"{p}total"], "target": at[f"{p}target"],
                     "taken": pa.array(copies * size), "copies": pa.array(copies)}
            yield pa.RecordBatch.from_arrays([mixed[n] if n in mixed else at[n] for n in names], names=names)

    return task


def mix(docs: DataFrame, source: str = "source", size: Column | None = None) -> DataFrame:
    """docs with size, source_size, target, taken and copies: how often the mix takes each document.

    size is the number of words of `text` (null: 0), unless given. A null source is a source of its own, after all names.
    copies is from 0 to CAP, taken = size * copies; documents without words count as taken once. The
    words taken of a source differ from its target by about the smallest document of each rounding bin.
    Repeated rows are documents like any other. Columns of docs pass; those named like the new ones,
    whatever the case, are replaced. Reruns give the same rows, as order and bins depend on the rows' values
    only (but for maps). Sources whose multipliers aren't found in STEPS steps are an error.

    Bins hold about BIN_ROWS documents, so that a source with a third of all rows is rounded in many
    tasks; rows alike in every column share one. A task streams through its bins and keeps one number.
    """
    new = ("size", "source_size", "target", "taken", "copies")
    docs = docs.drop(*(c for c in docs.columns if c.lower() in new))
    scratch, p = Scratch(docs.sparkSession, "mix"), free_prefix(docs)
    size = sizes_of(F.col("text")) if size is None else size
    hist = docs.select(F.col(source).alias("source"), size.alias("size")).groupBy("source", "size").agg(F.count("*").alias("n"))
    hist = scratch.keep(hist, "hist")
    sources = scratch.keep(targets(hist, scratch), "sources")
    named = hist.withColumnRenamed("source", "name").join(light(sources), F.col("name").eqNullSafe(F.col("source"))).select("sid", "size", "n")
    lam = multipliers(scratch.keep(named, "counts"), sources, scratch)
    scratch.drop("hist")
    plan = scratch.keep(sources.join(lam, "sid", "left").select(
        F.col("source").alias(f"{p}name"), F.col("sid").alias(f"{p}sid"), F.col("total").alias(f"{p}total"), F.col("target").alias(f"{p}target"),
        F.col("lam").alias(f"{p}lam"), F.col("mean").alias(f"{p}mean"), F.ceil(F.col("docs") / BIN_ROWS).alias(f"{p}bins")), "plan")
    own = docs.withColumns({f"{p}size": size, f"{p}mark": F.xxhash64(*hashable(docs))}).join(light(plan), F.col(source).eqNullSafe(F.col(f"{p}name")))
    rate = F.least(F.lit(float(CAP)), F.exp(F.least(F.col(f"{p}lam") * F.col(f"{p}size") / F.col(f"{p}mean"), F.lit(50.0))))
    own = own.select(*(f"`{c}`" for c in docs.columns), *(f"{p}{c}" for c in ("sid", "total", "target", "size", "mark")),
                     F.coalesce(rate, F.lit(float(CAP))).alias(f"{p}rate"), F.pmod(f"{p}mark", f"{p}bins").alias(f"{p}bin"))
    kind = with_fields(docs.schema, "size long, source_size long, target double, taken long, copies long")
    return own.repartition(f"{p}sid", f"{p}bin").sortWithinPartitions(f"{p}sid", f"{p}bin", F.desc(f"{p}size"), f"{p}mark", "doc_id").mapInArrow(
        _diffuse(kind.names, p), kind)


def op5_mixing(spark, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes, by its source's target."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", sizes_of(F.col("text")).alias("words"))
    return mix(docs, size=F.col("words")).drop("words")
