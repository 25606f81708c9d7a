"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled.

A document is toxic if any of its sentences is: with p the score of each sentence, the document's is
the noisy-or 1 - prod(1 - p). Only documents have labels; the gradient of the document's likelihood
runs through the noisy-or to its sentences, so training itself finds those that carry the label.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propgraph.llm.common import Scratch, table, text_key, with_fields

#: Labelled documents that the model is fitted on, at most, of each label (those of least hash).
SAMPLE_TOXIC, SAMPLE_CLEAN = 3000, 6000
THRESHOLD = 0.7
#: A sentence of at least this score is an offending one.
OFFENDING = 0.5

#: G statistic from which a feature tells something (chance alone: 1 in 3,000).
SIGNIFICANT = 13.0

_SENTENCE = re.compile(r"[^.!?\n\r]+")
_WORD = re.compile(r"\w+")
#: Words of a sentence's score at once; unseen words are looked up anew beyond this.
_SEEN = 500_000


def stem(word: str) -> str | None:
    """Inflected words share their first letters."""
    return f"{word[:4]}~" if len(word) > 4 else None


def features(sentence: str) -> set[str]:
    words = set(_WORD.findall(sentence.lower()))
    return words | {s for w in words if (s := stem(w))}


def telling(texts: list[str], labels: list[int], least: float = SIGNIFICANT) -> dict[str, float]:
    """Features commoner in toxic documents than chance would have it, by the G statistic.

    With each, half the logarithm of how much commoner: a word counts along with its stem. One text's
    features are held at a time, and counts of those that two toxic texts have.
    """
    toxic_of: Counter[str] = Counter()
    clean_of: Counter[str] = Counter()
    for text in (t for t, y in zip(texts, labels, strict=True) if y):
        toxic_of.update(features(text))
    toxic_of = Counter({f: n for f, n in toxic_of.items() if n >= 2})
    for text in (t for t, y in zip(texts, labels, strict=True) if not y):
        clean_of.update(f for f in features(text) if f in toxic_of)
    total, toxic = len(labels), sum(labels)

    def g(a: int, b: int) -> float:
        cells = ((a, toxic), (b, total - toxic))
        share = (a + b) / total
        return 2 * sum(x * math.log(x / (n * p)) for k, n in cells for x, p in ((k, share), (n - k, 1 - share)) if x)

    return {
        f: math.log((a + 0.5) / (clean_of[f] + 0.5) * (total - toxic + 1) / (toxic + 1)) / 2 for f, a in sorted(toxic_of.items())
        if a * (total - toxic) > clean_of[f] * toxic and g(a, clean_of[f]) >= least}


def fit(texts: list[str], labels: list[int], steps: int = 150, penalty: float = 3e-4) -> dict[str, float]:
    """Weights of features by gradient steps (Adam) on the documents' mean log-likelihood; '' is the bias.

    Weights start from, and are drawn to, those that `telling` gives. Both labels weigh alike, and
    copies of a text count once. Without documents of both labels there is nothing to learn: every
    score is 0.
    """
    known = dict(zip(texts, labels, strict=True))
    texts, labels = list(known), list(known.values())
    if len(set(labels)) < 2:
        return {"": -1e3}
    found = telling(texts, labels)
    index = {f: k for k, f in enumerate(found)}
    doc, row, word = array("l"), array("l"), array("l")  # of sentences with such features, and of features in them
    plain = np.zeros(len(texts))  # sentences without
    for d, text in enumerate(texts):
        for sentence in _SENTENCE.finditer(text):
            own = features(sentence[0])
            if told := own & found.keys():
                word.extend(sorted(index[f] for f in told))
                row.extend([len(doc)] * len(told))
                doc.append(d)
            elif own:
                plain[d] += 1
    doc, row, word = (np.array(x, np.int64) for x in (doc, row, word))
    y = np.array(labels, float)
    share = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    prior = np.array([*found.values(), -5.0])
    w, m, v = prior.copy(), 0.0, 0.0
    for t in range(1, steps + 1):
        z = np.bincount(row, w[word], len(doc)) + w[-1]
        # -log of the chance of no offending sentence
        hazard = np.bincount(doc, np.logaddexp(0, z), len(y)) + plain * np.logaddexp(0, w[-1])
        pull = np.where(y == 1, -1 / np.expm1(np.maximum(hazard, 1e-12)), 1.0) * share
        slope = pull[doc] / (1 + np.exp(-z))
        g = np.append(np.bincount(word, slope[row], len(index)), slope.sum() + (pull * plain).sum() / (1 + np.exp(-w[-1])))
        g[:-1] += penalty * (w - prior)[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    return {f: float(w[k]) for f, k in index.items() if abs(w[k]) >= 1e-3} | {"": float(w[-1])}


class _Words(dict):
    """Weight of a word, with that of its stem; bounded."""

    def __init__(self, weights: dict[str, float]):
        self.weights = weights

    def __missing__(self, word: str) -> float:
        if len(self) > _SEEN:
            self.clear()
        out = self[word] = self.weights.get(word, 0.0)
        return out


def judge(text: str, words: _Words, stems: _Words, bias: float) -> tuple[float, list[tuple[int, int, float]]]:
    """The score of a text and its offending sentences as (start, end, score)."""
    hazard, found = 0.0, []
    for place in _SENTENCE.finditer(text):
        own = set(_WORD.findall(place[0].lower()))
        if not own:
            continue
        z = bias + sum(map(words.__getitem__, own)) + sum(map(stems.__getitem__, {w[:4] for w in own if len(w) > 4}))
        if z > -30:
            hazard += z if z > 30 else math.log1p(math.exp(z))
            if z >= 0:
                found.append((*place.span(), 1 / (1 + math.exp(-z))))
    return -math.expm1(-hazard), found


def train(docs: DataFrame, labels: DataFrame, toxic: int = SAMPLE_TOXIC, clean: int = SAMPLE_CLEAN) -> dict[str, float]:
    """Fit on labelled rows whose crc32(doc_id) mod 3 isn't 1: bounded samples of each label, whole texts.

    The sample is fitted in one task; the driver gets the weights, bounded by the sample's words. A doc_id that
    is labelled both ways isn't learned from; one that stands with several texts gives that of the least digest, once.
    """
    own = (
        labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int").alias("toxic"))
        .filter("doc_id is not null and toxic in (0, 1) and pmod(crc32(cast(doc_id as string)), 3) <> 1")
        .groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).filter("toxic = most").drop("most"))
    order = F.xxhash64("doc_id"), "doc_id"
    sample = own.filter("toxic = 1").orderBy(*order).limit(toxic).union(own.filter("toxic = 0").orderBy(*order).limit(clean))
    scratch = Scratch(docs.sparkSession, "toxicity")
    sample = scratch.keep(sample, "sample")
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id")
    texts = texts.groupBy("doc_id").agg(F.min_by("text", text_key(F.col("text"))).alias("text"), F.first("toxic").alias("toxic"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r["doc_id"], r["text"], r["toxic"]) for b in batches for r in b.to_pylist())
        weights = fit([r[1] for r in rows], [r[2] for r in rows])
        yield pa.RecordBatch.from_arrays([pa.array(list(weights), pa.string()), pa.array(list(weights.values()))], names=["f", "w"])

    out = {r.f: r.w for r in texts.repartition(1).mapInArrow(task, "f string, w double").collect()}
    scratch.drop("sample")
    return out or fit([], [])


def score(docs: DataFrame, weights: dict[str, float]) -> DataFrame:
    """docs with tox_score (double) and tox_sentences (start, end, score of each offending sentence).

    Offsets are code points from 0. Null and empty texts, and texts without words, score 0. Columns
    of docs pass unchanged (of these two names: are replaced); rows may repeat. One row in, one out.
    """
    docs = docs.drop("tox_score", "tox_sentences")
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    columns = docs.columns

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words({f: w for f, w in shared.value.items() if not f.endswith("~")})
        stems = _Words({f[:-1]: w for f, w in shared.value.items() if f.endswith("~")})
        bias = shared.value[""]
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        for batch in batches:
            judged = [judge(t or "", words, stems, bias) for t in batch.column(columns.index("text")).to_pylist()]
            found = [[{"start": a, "end": b, "score": p} for a, b, p in x[1]] for x in judged]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([x[0] for x in judged], pa.float64()), pa.array(found, kind)],
                names=[*columns, "tox_score", "tox_sentences"])

    kind = with_fields(docs.schema, "tox_score double, tox_sentences array<struct<start:int,end:int,score:double>>")
    return docs.mapInArrow(task, kind)


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    """Every document's score, with its offending sentences located."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = score(docs, train(docs, table(spark, sf_dir, "labels")))
    worst = F.expr("aggregate(tox_sentences, get(tox_sentences, 0), (a, x) -> if(x.score > a.score, x, a))")
    return out.select(
        "doc_id", F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1, F.lit(False)).alias("held_out"),
        F.col("tox_score").alias("score"), (F.col("tox_score") >= THRESHOLD).cast("int").alias("predicted"),
        F.size("tox_sentences").alias("n_offending"), worst["start"].alias("worst_start"), worst["end"].alias("worst_end"))
