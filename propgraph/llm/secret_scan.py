"""Secret scans: candidates by pattern, false positives taken out by a random forest.

Built-in functions and the forest of Spark's own ML library only. The forest sees a candidate's length,
its character transitions, how far a dictionary covers it, the path and the neighbouring words; it is
trained on labelled findings.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propgraph.llm.common import SPACE, Scratch, light, table, text_key

#: Labelled findings that the forest is trained on, at most, of each label (those of least hash).
SAMPLE = 5_000
TREES, DEPTH, SEED = 24, 6, 7
THRESHOLD = 0.5
#: Words before and after a candidate that are kept with it.
AROUND = 5
#: Letters of a word of the dictionary, at least and at most; characters of a candidate that are looked at together.
LETTERS, PIECE = (4, 20), 64
#: Characters of a candidate up to which none is shown, and how many are shown of longer ones.
HIDDEN, SHOWN = 12, 4

_RUN = r"[A-Za-z0-9+/_-]{16,}"
#: Sixteen characters of which one is a digit, or twenty.
CANDIDATE = r"(?<![A-Za-z0-9+/_-])(?:(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{16,}|[A-Za-z0-9+/_-]{20,})"
_ASKS = r"(?i)pass(?:word|wd|phrase)?|pwd|secret|token|api.?key|access.?key|auth|credential|bearer|private"
#: A value after a keyword and an assignment mark, and the userinfo of a URL.
_VALUE = rf"{_ASKS.replace('(?i)', '(?i)(?:')})(?:[_-]\w+)?[\"'`\]]*\s*(?::=|=>|[=:]+)\s*[\"'`]?([^\s\"'`]+)"
_USERINFO = r"://(?:[^\s/@:]*:)?([^\s/]+)@"
_ASSIGNS = r"[=:]\s*[\"'`]?$"
_ISSUED = r"^(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abpr]-[A-Za-z0-9-]{10,}|glpat-[A-Za-z0-9_-]{20,}|sk-[A-Za-z0-9_-]{20,})$"
_MOCK = r"(?i)test|example|sample|mock|fixture|doc"

FEATURES = (
    "length", "digits", "uppers", "vowels", "distinct", "switches", "cases", "hex", "likelihood", "coverage",
    "asks", "asks_far", "assigns", "quoted", "path_mock", "path_depth", "path_bucket",
)


def findings(docs: DataFrame, path: str = "source") -> DataFrame:
    """Candidates: doc_id, tkey, word (its index, from 0), nth (in the word), candidate, head (of the word
    before it), before, after (words around), path. Rows that repeat give their findings once.
    """
    own = docs.select("doc_id", text_key(F.col("text")).alias("tkey"), F.col(path).cast("string").alias("path"), "text")
    own = own.filter(F.col("text").rlike(_RUN) | F.col("text").rlike(_VALUE) | F.col("text").rlike(_USERINFO)).withColumn("words", F.split("text", f"[{SPACE}]+"))
    lead = lambda k: F.array_join(F.slice("words", F.greatest(k - 1, F.lit(1)), F.least(k, F.lit(2))), " ")  # noqa: E731 - two words before
    given = lambda k: F.concat(F.when(k > 0, F.concat(lead(k), F.lit(" "))).otherwise(F.lit("")), F.get("words", k))
    at = F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda k: F.get("words", k).rlike(CANDIDATE) | F.get("words", k).rlike(_USERINFO) | given(k).rlike(_VALUE + r"[\"'`]*[^\s\w]*$"))
    own = own.select("doc_id", "tkey", "path", "words", F.explode(at).alias("word")).withColumn("given", given(F.col("word")))
    own = own.select(
        "doc_id", "tkey", "path", "word", F.get("words", F.col("word")).alias("own"),
        F.slice("words", F.greatest(F.col("word") - AROUND, F.lit(0)) + 1, F.least(F.col("word"), F.lit(AROUND))).alias("before"),
        F.slice("words", F.col("word") + 2, AROUND).alias("after"), "given")
    own = own.withColumn("runs", F.regexp_extract_all("own", F.lit(CANDIDATE), F.lit(0)))
    # those that stand in the word itself, without the signs that close a sentence or a bracket
    values = F.concat(F.regexp_extract_all("given", F.lit(_VALUE), F.lit(1)), F.regexp_extract_all("own", F.lit(_USERINFO), F.lit(1)))
    values = F.transform(values, lambda v: F.regexp_replace(v, r"[,;.)\]}>]+$", ""))
    own = own.withColumn("values", F.filter(F.array_distinct(values), lambda v: (v != "") & F.contains("own", v)))
    own = own.withColumn("values", F.array_except("values", "runs"))
    own = own.select("*", F.posexplode(F.concat("runs", "values")).alias("nth", "candidate")).withColumn(
        "head", F.when(F.col("nth") < F.size("runs"), F.get(F.split("own", CANDIDATE, -1), F.col("nth")))
        .otherwise(F.expr("left(own, instr(own, candidate) - 1)")))
    return own.drop("own", "given", "runs", "values").distinct()


def known(found: DataFrame) -> Column:
    """The label of findings that need no forest: 1 for issued formats and assigned mixtures of letters and
    digits, 0 for letters or digits alone, null for the rest.
    """
    lead = F.concat(F.array_join("before", " "), F.lit(" "), F.col("head"))
    assigned = lead.rlike(f"(?:{_ASKS})[\"']?\\s*{_ASSIGNS}")
    mixed = F.col("candidate").rlike("[0-9]") & F.col("candidate").rlike("[A-Za-z]")
    return F.when(F.col("candidate").rlike(_ISSUED) | (assigned & mixed), 1).when(~mixed & ~assigned, 0)


def _grams(word: Column, n: int) -> Column:
    own = F.lower(word)
    return F.when(F.length(own) >= n, F.transform(F.sequence(F.lit(1), F.length(own) - n + 1), lambda k: F.substring(own, k, F.lit(n)))).otherwise(
        F.array().cast("array<string>"))


def dictionary(frame: DataFrame) -> DataFrame:
    """(gram, weight) of all words of the documents, or of those next to findings if the frame has no text:
    log-likelihood of pairs of characters, and 1 for words that occur twice. Words are letters only, but for
    signs around them, and are counted before they are taken apart.
    """
    words = F.split("text", f"[{SPACE}]+") if "text" in frame.columns else F.concat("before", "after")
    words = frame.select(F.explode(words).alias("w")).select(F.lower(F.regexp_extract("w", r"^[^\p{L}\p{Nd}]*(\p{L}{3,})[^\p{L}\p{Nd}]*$", 1)).alias("w"))
    words = Scratch(frame.sparkSession, "words").keep(words.filter("w <> ''").groupBy("w").agg(F.count("*").alias("n")), "words")
    pairs = words.select(F.explode(_grams(F.col("w"), 2)).alias("gram"), "n").groupBy("gram").agg(F.sum("n").alias("n"))
    first = pairs.groupBy(F.substring("gram", 1, 1).alias("c")).agg(F.sum("n").alias("of"))
    pairs = pairs.join(first, F.substring("gram", 1, 1) == F.col("c")).select("gram", F.log((F.col("n") + 1) / (F.col("of") + 30)).alias("weight"))
    return pairs.union(words.filter(f"n >= 2 and length(w) between {LETTERS[0]} and {LETTERS[1]}").select(F.col("w").alias("gram"), F.lit(1.0).alias("weight")))


def featured(found: DataFrame, grams: DataFrame) -> DataFrame:
    """found with `key` and FEATURES."""
    c = F.col("candidate")
    share = lambda pattern: F.regexp_count(c, F.lit(pattern)) / F.length(c)
    key = F.struct("doc_id", "tkey", "word", "nth")
    unit = found.select(c.alias("c")).distinct().withColumn("digest", text_key(F.col("c")))
    # pieces of fixed length with what stands around them: each is looked at by itself, so long candidates cost in proportion
    pieces = F.regexp_extract_all(F.lower("c"), F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    unit = unit.select("digest", F.length("c").alias("n"), pieces.alias("p")).select("digest", "n", "p", F.posexplode("p").alias("at", "piece"))
    before, after = F.coalesce(F.right(F.get("p", F.col("at") - 1), F.lit(LETTERS[1] - 1)), F.lit("")), F.coalesce(F.left(F.get("p", F.col("at") + 1), F.lit(LETTERS[1] - 1)), F.lit(""))
    unit = unit.select("digest", "n", "at", F.concat(before, "piece", after).alias("w"), (F.length(before) + 1).alias("a"), (F.length(before) + F.length("piece")).alias("b"))
    parts = f"""filter(flatten(transform(sequence(1, length(w)), i -> transform(filter(sequence({LETTERS[0]}, {LETTERS[1]}), k -> i <= b and i + k > a and i + k - 1 <= length(w)),
        k -> named_struct('i', i, 'k', k, 'gram', substring(w, i, k))))), x -> x.gram rlike '^[a-z]+$')"""
    pairs = "transform(filter(sequence(a, b), i -> i < length(w)), i -> named_struct('i', i, 'k', 2, 'gram', substring(w, i, 2)))"
    grams_of = unit.select("digest", "n", "at", "a", "b", F.explode(F.expr(f"concat({pairs}, {parts})")).alias("x")).select("digest", "n", "at", "a", "b", "x.*")
    held = F.when((F.col("k") > 2) & F.col("weight").isNotNull(), F.struct(F.greatest("i", "a").alias("i"), F.least(F.col("i") + F.col("k") - 1, "b").alias("j")))
    sums = grams_of.join(light(grams), "gram", "left").groupBy("digest", "n", "at").agg(
        F.sum(F.when(F.col("k") == 2, F.coalesce("weight", F.lit(-7.0)))).alias("sum"), F.count_if(F.col("k") == 2).alias("pairs"), F.collect_set(held).alias("held"))
    covered = F.expr("size(array_distinct(flatten(transform(held, x -> sequence(x.i, x.j)))))")
    sums = sums.groupBy("digest").agg((F.sum("sum") / F.sum("pairs")).alias("likelihood"), (F.sum(covered) / F.first("n")).alias("coverage"))
    near = F.concat(F.coalesce(F.get("before", F.size("before") - 2), F.lit("")), F.lit(" "), F.coalesce(F.get("before", F.size("before") - 1), F.lit("")), F.lit(" "), F.col("head"))
    path = F.coalesce("path", F.lit(""))
    flag = lambda condition: F.coalesce(condition.cast("double"), F.lit(0.0))
    found = found.join(sums, text_key(c) == F.col("digest"), "left").drop("digest").fillna({"likelihood": -7.0, "coverage": 0.0})
    return found.select(
        "*", key.alias("key"), F.length(c).cast("double").alias("length"), share("[0-9]").alias("digits"), share("[A-Z]").alias("uppers"),
        share("[aeiouAEIOU]").alias("vowels"), (F.size(F.array_distinct(F.split(c, ""))) / F.length(c)).alias("distinct"),
        share("(?<=[A-Za-z])[0-9]|(?<=[0-9])[A-Za-z]").alias("switches"), share("(?<=[a-z])[A-Z]|(?<=[A-Z])[a-z]").alias("cases"),
        flag(c.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")).alias("hex"), flag(near.rlike(_ASKS)).alias("asks"),
        flag(F.array_join(F.concat("before", "after"), " ").rlike(_ASKS)).alias("asks_far"), flag(near.rlike(_ASSIGNS)).alias("assigns"),
        flag(F.col("head").rlike("[\"'`]$")).alias("quoted"), flag(path.rlike(_MOCK)).alias("path_mock"),
        F.regexp_count(path, F.lit("/")).cast("double").alias("path_depth"), F.pmod(F.xxhash64(path), F.lit(16)).cast("double").alias("path_bucket"))


def _assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features", handleInvalid="keep").transform(rows)


def train(labelled: DataFrame, sample: int = SAMPLE) -> RandomForestClassificationModel | None:
    """The forest of labelled findings (FEATURES and label 0 or 1), or None if all have one label.

    It is trained on at most `sample` findings of each label, those of least hash; the rest only count.
    """
    order = F.xxhash64("candidate", "word"), "candidate", "word", "nth"
    parts = [labelled.filter(F.col("label") == k).orderBy(*order).limit(sample) for k in (0, 1)]
    rows = Scratch(labelled.sparkSession, "forest").keep(parts[0].union(parts[1]).select(*FEATURES, F.col("label").cast("double").alias("label")), "sample")
    if rows.select("label").distinct().count() < 2:
        return None
    rows = rows.repartition(1).sortWithinPartitions("label", *FEATURES)  # in one order, so that reruns agree
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED).fit(_assembled(rows))


def secret_scan(docs: DataFrame, path: str = "source", labels: DataFrame | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """Findings with score (0 to 1) and secret (score >= threshold): doc_id, word, nth, candidate, score, secret.

    labels: labelled findings (candidate, label 0 or 1) to train on. Without, findings that `known` labels
    serve, those of documents whose crc32(doc_id) mod 3 isn't 1. If labels are of one kind, or there are none,
    there is no forest: scores are the `known` label, and 0.5 where there is none.

    Null, empty and wordless texts have no findings; repeated rows have theirs once; doc_id may be null or
    repeat. path may be null. Other columns aren't read.
    """
    scratch = Scratch(docs.sparkSession, "secrets")
    found = scratch.keep(findings(docs, path), "findings")
    rows = scratch.keep(featured(found, scratch.keep(dictionary(docs.select("text")), "grams")).withColumn("label", known(found)), "featured")
    if labels is None:
        labelled = rows.filter("label is not null and pmod(crc32(cast(doc_id as string)), 3) <> 1")
    else:
        given = labels.filter("label in (0, 1)").groupBy("candidate").agg(F.max("label").alias("label"))
        labelled = rows.drop("label").join(given, "candidate")
    forest = train(labelled)
    if forest is None:
        scored = rows.withColumn("score", F.coalesce(F.col("label").cast("double"), F.lit(0.5)))
    else:
        scored = forest.transform(_assembled(rows)).withColumn("score", F.get(vector_to_array("probability"), F.lit(1)))
    return scored.select("doc_id", "word", "nth", "candidate", "label", "score", (F.col("score") >= threshold).alias("secret"))


def masked(candidate: Column) -> Column:
    """Stars for a candidate's characters, but for the first of a long one."""
    shown = F.when(F.length(candidate) >= HIDDEN, F.left(candidate, F.lit(SHOWN))).otherwise(F.lit(""))
    return F.rpad(shown, F.length(candidate), "*")


def op1_secret_scan(spark, sf_dir: str) -> DataFrame:
    """All findings of the documents, judged; of candidates a digest is shown, and of longer ones the first characters."""
    found = secret_scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "word", "nth", masked(F.col("candidate")).alias("masked"),
        F.sha2("candidate", 256).alias("sha256"), "score", "secret")
