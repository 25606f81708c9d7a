"""URL filters: rules found by binary search in a sorted, memory-mapped array of 64-bit digests."""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propgraph.llm.common import ascii_lower, table, with_fields

#: Rules that are laid into one array, shipped to each executor; more rules are joined instead.
ARRAY_RULES = 4_000_000
ALLOW, BLOCK = "allow", "block"


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def _clean(rules: DataFrame) -> DataFrame:
    """Distinct rules, hosts in lower case; of equal rules that disagree, block counts."""
    host = ascii_lower(F.substring_index("rule", "/", 1))
    rule = F.concat(host, F.expr("substring(rule, length(substring_index(rule, '/', 1)) + 1)"))
    return rules.filter("rule like '_%/%' and rule not like '/%'").groupBy(rule.alias("rule")).agg(F.max("verdict").alias("verdict")).filter(
        F.col("verdict").isin(ALLOW, BLOCK))


class DigestArray:
    """A file of sorted digests, and in their order the full strings and the verdicts."""

    def __init__(self, path: str):
        count, size, kinds = np.fromfile(path, np.int64, 3)
        self.lengths = np.fromfile(path, np.int64, kinds, offset=24).tolist()  # of paths of rules
        at = 24 + 8 * kinds
        if not count:
            self.digests = np.empty(0, np.uint64)
            return
        self.digests = np.memmap(path, np.uint64, "r", at, (count,))
        self.ends = np.memmap(path, np.int64, "r", at + 8 * count, (count + 1,))
        self.blocks = np.memmap(path, np.uint8, "r", at + 8 + 16 * count, (count,))
        self.text = np.memmap(path, np.uint8, "r", at + 8 + 17 * count, (size,))

    @staticmethod
    def write(rules: list[tuple[str, str]], path: str) -> None:
        rows = sorted((xxhash.xxh64_intdigest(r.encode()), r.encode(), v == BLOCK) for r, v in rules)
        text = b"".join(r for _, r, _ in rows)
        with open(path, "wb") as out:
            lengths = sorted({len(r) - r.index(b"/") for _, r, _ in rows})
            np.array([len(rows), len(text), len(lengths), *lengths], np.int64).tofile(out)
            np.array([d for d, _, _ in rows], np.uint64).tofile(out)
            np.cumsum([0, *(len(r) for _, r, _ in rows)], dtype=np.int64).tofile(out)
            np.array([b for _, _, b in rows], np.uint8).tofile(out)
            out.write(text)

    def string(self, k: int) -> bytes:
        return self.text[self.ends[k] : self.ends[k + 1]].tobytes()

    def probe(self, keys: list[bytes]) -> np.ndarray:
        """Place of each key, or -1: binary search for all at once, then the stored strings decide."""
        digests = np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys))
        at = np.searchsorted(self.digests, digests)
        found = np.full(len(keys), -1)
        open_ = np.flatnonzero(at < len(self.digests))
        while len(open_ := open_[self.digests[at[open_]] == digests[open_]]):  # more than once only where digests collide
            right = np.array([self.string(at[k]) == keys[k] for k in open_], bool)
            found[open_[right]] = at[open_[right]]
            open_ = open_[~right]
            at[open_] += 1
            open_ = open_[at[open_] < len(self.digests)]
        return found

    def longest(self, hosts: list[str], paths: list[str]) -> tuple[list[str | None], list[str | None]]:
        """The longest rule that fits each url and its verdict; of equally long ones that of the longer host."""
        keys, owner = [], []
        for k, (host, path) in enumerate(zip(hosts, paths, strict=True)):
            if host and path:
                suffixes, path = _suffixes(host), path.encode()
                own = [s + path[:n] for s in suffixes for n in self.lengths if n <= len(path)]
                keys += own
                owner += [k] * len(own)
        best: dict[int, tuple[int, int, int]] = {}
        found = self.probe(keys)
        for j in np.flatnonzero(found >= 0):
            rule = keys[j].decode(errors="replace")
            best[owner[j]] = max(best.get(owner[j], (-1, 0, 0)), (len(rule), rule.index("/"), int(found[j])))
        rules, verdicts = [None] * len(hosts), [None] * len(hosts)
        for k, (_, _, at) in best.items():
            rules[k], verdicts[k] = self.string(at).decode(), BLOCK if self.blocks[at] else ALLOW
        return rules, verdicts


def _suffixes(host: str) -> list[bytes]:
    labels = host.encode().split(b".")
    return [b".".join(labels[k:]) for k in range(len(labels))]


def _by_array(urls: DataFrame, rules: DataFrame) -> DataFrame:
    spark = urls.sparkSession
    rows = [(r.rule, r.verdict) for r in rules.collect()]  # at most ARRAY_RULES
    name = f"url-rules-{hashlib.sha256(repr(sorted(rows)).encode()).hexdigest()[:24]}.bin"
    if not any(f.endswith(f"/{name}") for f in spark.sparkContext.listFiles):
        path = os.path.join(tempfile.mkdtemp(prefix="url-rules-"), name)
        DigestArray.write(rows, path)
        spark.sparkContext.addFile(path)  # each executor fetches it once, also one that comes later
    columns = urls.columns

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = DigestArray(SparkFiles.get(name))
        for batch in batches:
            hosts, paths = (batch.column(columns.index(c)).to_pylist() for c in ("host", "path"))
            rule, verdict = array.longest(hosts, paths)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(rule, pa.string()), pa.array(verdict, pa.string())], names=[*columns, "rule", "verdict"])

    return urls.mapInArrow(task, with_fields(urls.schema, "rule string, verdict string"))


def _by_join(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The same by shuffles, for rules beyond one array: hosts and paths led to rules by equal strings."""
    rules = rules.withColumn("length", F.length("rule")).withColumn("label", F.length(F.substring_index("rule", "/", 1)))
    lengths = [r[0] for r in rules.select((F.col("length") - F.col("label")).alias("n")).distinct().collect()]  # at most the longest path
    own = urls.select(F.col("host").alias("h"), F.col("path").alias("p")).filter("h <> '' and p <> ''").distinct()
    parts = F.split("h", "\\.")
    own = own.withColumn("s", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, k, F.size(parts)), "."))))
    own = own.withColumn("n", F.explode(F.array(*map(F.lit, lengths)))).filter("n <= length(p)").withColumn("rule", F.expr("s || left(p, n)"))
    best = own.join(rules, "rule").groupBy("h", "p").agg(F.max(F.struct("length", "label", "rule", "verdict")).alias("best"))
    return urls.join(best, (F.col("host") == F.col("h")) & (F.col("path") == F.col("p")), "left").select(
        *urls.columns, F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"))


def url_filter(pages: DataFrame, rules: DataFrame, default: str = ALLOW, array_rules: int = ARRAY_RULES) -> DataFrame:
    """pages with host, path, rule (or null) and verdict: the longest rule's that fits, else `default`.

    rules: rule ('host/path', path from the slash) and verdict (allow or block); others, and null, are
    left out. A rule fits its host and all hosts below it, where the url's path starts with the rule's.
    The host is what stands after the first '://' up to '/', '?', '#' or the end, A-Z lower-cased, the
    path what follows up to '?', '#' or the end; both are empty for a null url or one without '://'.
    Lengths are in characters. Repeated rows stay; columns of pages with the new names, whatever the
    case, are replaced, others pass unchanged.
    """
    new = ("host", "path", "rule", "verdict")
    urls = pages.withColumns({"__host": host_of(F.col("url")), "__path": path_of(F.col("url"))})
    urls = urls.drop(*(c for c in pages.columns if c.lower() in new)).withColumnsRenamed({"__host": "host", "__path": "path"})
    rules = _clean(rules)
    found = (_by_array if rules.count() <= array_rules else _by_join)(urls, rules)
    return found.withColumn("verdict", F.coalesce("verdict", F.lit(default)))


RULES = [("org/", ALLOW), ("example.org/es/", BLOCK), ("example.org/en/1", BLOCK), ("com/fr/", ALLOW), ("com/de/", BLOCK)]


def op3_url_filter(spark, sf_dir: str) -> DataFrame:
    """Every page's url judged by RULES; what no rule fits is allowed."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter(pages, spark.createDataFrame(RULES, "rule string, verdict string")).drop("url")


OP3_SQL = f"""
WITH rules(rule, verdict) AS (VALUES {', '.join(str(r) for r in RULES)}),
parts AS (SELECT rule, verdict, split_part(rule, '/', 1) AS rule_host, substr(rule, length(split_part(rule, '/', 1)) + 1) AS rule_path FROM rules),
urls AS (SELECT row_number() OVER () AS k, page_id,
    translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
found AS (SELECT k, max({{'n': length(rule), 'h': length(rule_host), 'rule': rule, 'verdict': verdict}}) AS best FROM urls JOIN parts
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY k)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict FROM urls LEFT JOIN found USING (k)
"""
