"""License scans by ordered signature rules, with built-in Spark functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propgraph.llm.common import ascii_lower, table, text_key
from propgraph.llm.license_rules import CONFIDENCE, rules

#: Base phrases and labels, by label.
BASE = (("apache", "apache license"), ("cc-by", "cc by"), ("gpl", "gnu general public license"), ("mit", "mit license"))
#: Parts of words, one of which any rule's text holds: other texts meet no rule.
KEYWORDS = sorted({"licen", "spdx", "cc0", "c by", "commons"} | {r.gate for r in rules()})

_PHRASES = "|".join(p for _, p in BASE)


def normalised(text: Column) -> Column:
    """Words (0-9, a-z, all beyond ASCII) of a text in lower case (A-Z only), one space between."""
    return F.trim(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _holds(text: Column, parts: list[str]) -> Column:
    out = F.lit(False)
    for part in parts:
        out = out | F.contains(text, F.lit(part))
    return out


def _hits() -> Column:
    """Of the rules whose gate a text passes: priority, label, and per match (k) its length and that before it."""
    listed = F.array(*(F.struct(*(F.lit(x).alias(n) for n, x in zip(("gate", "pattern", "priority", "label"), r))) for r in rules()))
    passed = F.filter(listed, lambda r: F.contains(F.col("norm"), r["gate"]))

    def of(rule: Column) -> Column:
        found = F.regexp_extract_all("norm", rule["pattern"], F.lit(0))
        between = F.split("norm", rule["pattern"], -1)
        return F.transform(found, lambda m, k: F.struct(
            rule["pattern"].alias("rule"), rule["priority"].alias("priority"), rule["label"].alias("label"), k.alias("k"),
            F.length(F.get(between, k)).alias("before"), F.length(m).alias("length")))

    return F.flatten(F.transform(passed, of))


def detections(docs: DataFrame) -> DataFrame:
    """A row for each match that stays, and one (label null) for each document without any: doc_id, tkey,
    copies (repeated rows), the base columns, label, confidence, start, end (code points of the normalised
    text).

    Matches in a match of the same or a more important rule go: of equal ones the more important stays,
    then that of the smaller label. One sweep by start finds them, not pairs of matches.
    """
    own = docs.select(F.col("doc_id"), text_key(F.col("text")).alias("tkey"), normalised(F.col("text")).alias("norm"))
    padded = F.concat(F.lit(" "), F.col("norm"), F.lit(" "))
    gated = F.contains(F.col("norm"), F.lit("license")) | F.contains(F.col("norm"), F.lit("cc by"))
    place = f" (?=(?:{_PHRASES}) )"
    n_base = F.when(gated, F.regexp_count(padded, F.lit(place))).otherwise(0).cast("long")
    word = lambda many: F.when(F.col("n_base") > 0, _spaces(F.regexp_extract(padded, f"(?s)^({many}){place}", 1)).cast("long"))
    own = own.withColumn("n_base", n_base).select(
        "doc_id", "tkey", "n_base", F.when(F.col("norm") == "", 0).otherwise(_spaces(F.col("norm")) + 1).cast("long").alias("n_words"),
        word(".*?").alias("first_word"), word(".*").alias("last_word"),
        F.array_compact(F.array(*(F.when((F.col("n_base") > 0) & F.contains(padded, F.lit(f" {p} ")), F.lit(label)) for label, p in BASE))).alias("base"),
        F.when(_holds(F.col("norm"), KEYWORDS), _hits()).alias("hits"))
    # repeated rows are taken once and counted, so that matches aren't mixed up
    rest = ("n_words", "n_base", "first_word", "last_word", "base")
    own = own.groupBy("doc_id", "tkey").agg(F.count("*").alias("copies"), F.first(F.struct(*rest, "hits")).alias("x")).select(
        "doc_id", "tkey", "copies", *(F.col(f"x.{c}").alias(c) for c in rest), F.explode_outer("x.hits").alias("h"))
    text = Window.partitionBy("doc_id", "tkey")
    along = text.partitionBy("doc_id", "tkey", "h.rule").orderBy("h.k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = own.withColumn("end", F.sum(F.col("h.before") + F.col("h.length")).over(along)).withColumn("start", F.col("end") - F.col("h.length"))
    earlier = text.orderBy("start", F.desc("end"), "h.priority", "h.label").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.lit(False)
    for level in range(len(CONFIDENCE)):
        reach = F.max(F.when(F.col("h.priority") <= level, F.col("end"))).over(earlier)
        inside = inside | ((F.col("h.priority") == level) & (reach >= F.col("end")))
    confidence = F.array(*map(F.lit, CONFIDENCE))
    return own.withColumn("inside", F.coalesce(inside, F.lit(False))).select(
        "doc_id", "tkey", "copies", *rest, "start", "end", F.when(~F.col("inside"), F.col("h.label")).alias("label"),
        F.when(~F.col("inside"), F.get(confidence, F.col("h.priority"))).alias("confidence"))


def license_scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score; a row for each of docs.

    Words are counted from 0. n_base counts all places where the words of a base phrase stand together;
    labels adds those of the signature rules that stay to the base labels, each once, sorted, with commas
    between. score is the confidence of the best rule, 0.7 at least where a base phrase stands, 0 without
    any. Null and empty texts have no words and no labels. Repeated rows stay; doc_id may be null or
    repeat. Other columns aren't read.
    """
    found = detections(docs)
    keys = ("doc_id", "tkey", "copies", "n_words", "n_base", "first_word", "last_word", "base")
    out = found.groupBy(*keys).agg(F.collect_set("label").alias("more"), F.max("confidence").alias("best"))
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", "more")), ",").alias("labels"),
        F.greatest(F.coalesce("best", F.lit(0.0)), F.when(F.col("n_base") > 0, F.lit(CONFIDENCE[-1])).otherwise(0.0)).alias("score"))


def op7_license_scan(spark, sf_dir: str) -> DataFrame:
    """Licences named in every document."""
    return license_scan(table(spark, sf_dir, "documents"))
