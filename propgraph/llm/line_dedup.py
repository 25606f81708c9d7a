"""Line dedup by site-relative frequency: lines on too large a share of a host's pages go."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propgraph.llm.common import Scratch, free_prefix, light, table

#: Share of a host's pages above which a line is boilerplate, and pages that must hold it at least.
RATIO, LEAST_PAGES = 0.1, 2

_KEY = "unhex(md5(cast(btrim(l, ' \\t\\r') as binary)))"
_BLANK = "btrim(l, ' \\t\\r') = ''"


def boilerplate(docs: DataFrame, host: str, ratio: float, least: int) -> DataFrame:
    """(host, keys): digests of each host's boilerplate lines.

    Pages are the distinct texts of a host: a page that is stored a thousand times is one page. Counts
    combine before each shuffle. A host has at most (lines of a mean page) / ratio such lines.
    """
    pages = docs.filter("text is not null").groupBy(F.col(host).alias("host"), F.unhex(F.md5(F.col("text").cast("binary"))).alias("page")).agg(
        F.first(F.expr(f"array_distinct(transform(filter(split(text, '\\n'), l -> not ({_BLANK})), l -> {_KEY}))")).alias("lines"))
    totals = pages.groupBy("host").agg(F.count("*").alias("total"))
    counts = pages.select("host", F.explode("lines").alias("line")).groupBy("host", "line").agg(F.count("*").alias("n"))
    counts = counts.filter(F.col("n") >= least)
    met = counts.join(totals.withColumnRenamed("host", "site"), F.col("host").eqNullSafe(F.col("site")))
    return met.filter(F.col("n") > ratio * F.col("total")).groupBy("host").agg(F.collect_list("line").alias("keys"))


def line_dedup(docs: DataFrame, host: str = "source", ratio: float = RATIO, least: int = LEAST_PAGES, flag: str | None = None) -> DataFrame:
    """docs with each text's boilerplate lines left out; same rows, same columns.

    A line is what stands between newlines, without white space at its ends. It goes from every page of
    a host if more than `ratio` of the host's distinct pages hold it, and `least` of them do. Blank
    lines stay. A text that would be left without any word stays whole: no document is emptied; `flag` names a
    boolean column to add (or to replace) that is true for these. A null host is a host of its own; a null text
    stays null. Repeated rows stay. Only `host` and `text` are read; other columns pass through, whatever their names.
    """
    scratch, p = Scratch(docs.sparkSession, "lines"), free_prefix(docs)
    if flag:
        docs = docs.drop(flag)
    found = scratch.keep(boilerplate(docs.select(host, "text"), host, ratio, least), "boilerplate")
    found = found.select(F.col("host").alias(f"{p}site"), F.col("keys").alias(f"{p}keys"))
    own = docs.join(light(found), F.col(host).eqNullSafe(F.col(f"{p}site")), "left")
    rest = F.expr(f"array_join(filter(split(text, '\\n'), l -> {_BLANK} or not array_contains({p}keys, {_KEY})), '\\n')")
    own = own.withColumn(f"{p}rest", F.when(F.col(f"{p}keys").isNull(), F.col("text")).otherwise(rest))
    whole = (F.col(f"{p}rest") != F.col("text")) & ~F.col(f"{p}rest").rlike(r"[^\x20\x09-\x0D]")
    text = F.when(whole, F.col("text")).otherwise(F.col(f"{p}rest")).alias("text")
    flags = [F.coalesce(whole, F.lit(False)).alias(flag)] if flag else []
    return own.select(*(text if c == "text" else own[c] for c in docs.columns), *flags)


def op6_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document's text without its source's boilerplate lines."""
    return line_dedup(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).select("doc_id", "text")


OP6_SQL = f"""
WITH pages AS (SELECT DISTINCT source, text FROM documents WHERE text IS NOT NULL),
totals AS (SELECT source, count(*) AS total FROM pages GROUP BY source),
lines AS (SELECT source, text, unnest(list_distinct(list_transform(string_split(text, chr(10)),
    lambda l: trim(l, ' ' || chr(9) || chr(13))))) AS line FROM pages),
counts AS (SELECT source, line, count(*) AS n FROM lines WHERE line <> '' GROUP BY source, line HAVING count(*) >= {LEAST_PAGES}),
found AS (SELECT c.source, list(line) AS keys FROM counts c JOIN totals t ON c.source IS NOT DISTINCT FROM t.source
    WHERE n > {RATIO} * total GROUP BY c.source),
cut AS (SELECT doc_id, text, CASE WHEN keys IS NULL THEN text ELSE array_to_string(list_filter(string_split(text, chr(10)),
    lambda l: trim(l, ' ' || chr(9) || chr(13)) = '' OR NOT list_contains(keys, trim(l, ' ' || chr(9) || chr(13)))), chr(10)) END AS rest
    FROM documents d LEFT JOIN found f ON d.source IS NOT DISTINCT FROM f.source)
SELECT doc_id, CASE WHEN regexp_matches(rest, '[^\\x20\\x09-\\x0D]') THEN rest ELSE text END AS text FROM cut
"""
