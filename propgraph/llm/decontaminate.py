"""Benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders, so a question that is asked anew with other
values has the same template. Windows of templates are joined by hash; what matches must then fill
its slots consistently: a value of the benchmark's stands for one value of the document's.
Built-in Spark functions only.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propgraph.llm.common import Scratch, light, table, text_key

#: Tokens of a window, and the share of an item's tokens that matching windows must cover.
WINDOW, COVER = 8, 0.5
#: Tokens put in or left out between two matching runs up to which they are one place.
DRIFT = 4
#: Distinct words of a benchmark up to which documents' words are looked up in a constant, beyond by a join.
KNOWN = 50_000
#: Bits that say which words a benchmark can have.
BITS = 1 << 20
#: Words that are units when they follow a number.
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg t lb lbs oz pound pounds ton tons "
    "ml l litre litres liter liters gallon gallons ms s sec second seconds min minute minutes h hr hour hours day days "
    "week weeks month months year years kb mb gb tb hz khz mhz ghz v kv w kw mw kwh j kj cal kcal pa kpa bar k c f "
    "dollar dollars cent cents euro euros usd eur gbp percent degree degrees mph kmh acre acres"
).split()


def marked(frame: DataFrame, text: str) -> DataFrame:
    """frame with __t instead of a text: lower case, with marks on numbers (#n), names (#p) and what may be a name (#s).

    A name is a capitalised word after a lower-case word, comma or semicolon, and names with but a space
    between them are one. Other capitalised words, such as the first of a sentence, may be names. Null is the empty text.

    Each step is a projection of its own, so that none is computed twice.
    """
    t = F.col("__t")
    frame = frame.withColumn("__t", F.replace(F.coalesce(F.col(text), F.lit("")), F.lit("#"), F.lit(" "))).drop(text)
    frame = frame.withColumn("__t", F.regexp_replace(t, r"(\p{Lu})(?<=[\p{Ll},;] .)(\p{L}*)", "#p$1$2"))
    frame = frame.withColumn("__t", F.regexp_replace(t, r"(?<![\p{L}\p{Nd}])(\p{Lu}\p{L}*\p{Ll})", "#s$1"))
    frame = frame.withColumn("__t", F.regexp_replace(t, r"(#[ps]\p{L}+) (?=#p)", "$1"))
    frame = frame.withColumn("__t", F.regexp_replace(t, r"(\p{Nd})(?<![\p{L}\p{Nd}#].)([\p{Nd}.,]*)", " #n$1$2 "))
    return frame.withColumn("__t", F.trim(F.regexp_replace(F.lower(t), r"(?:[^\p{L}\p{Nd}#.,]+|[.,](?!\p{Nd}))+", " ")))


#: The word of a token w that may be a name, as a hash.
_MAYBE = "xxhash64(substring_index(substr(w, 3), '#', 1))"


def templates(frame: DataFrame, tokens: str, words: str, named: Column | None = None) -> DataFrame:
    """Marked texts as arrays of tokens and of template words; __t goes.

    Tokens are words in lower case, or #n, #p and #u with the value that they stand for; the template
    has #n, #p and #u alone. `named` is __t with #p for #s where a word is a name; other marks #s go. Signs between
    words go.
    """
    t = F.col("__t")
    if named is not None:
        frame = frame.withColumn("__t", named)
    frame = frame.withColumn("__t", F.replace(F.regexp_replace(t, r"(#s\p{L}+)(?=#p)", "$1 "), F.lit("#s"), F.lit("")))
    unit = rf"(#n\S+) (?:#p)?({'|'.join(UNITS)})(?= |$)"
    frame = frame.withColumn("__t", F.when(F.contains(t, F.lit("#n")), F.regexp_replace(t, unit, "$1 #u$2")).otherwise(t))
    bare = F.when(F.contains(t, F.lit("#")), F.regexp_replace(t, "#([npu])\\S*", "#$1")).otherwise(t)
    return frame.withColumns({tokens: F.split(t, " "), words: F.split(bare, " ")}).drop("__t")


def _naming(is_name) -> Column:
    """__t with #p for #s at the words whose hash is_name takes."""
    def token(w: Column) -> Column:
        word = F.xxhash64(F.substring_index(F.substr(w, F.lit(3)), "#", 1))
        return F.when(F.startswith(w, F.lit("#s")) & is_name(word), F.concat(F.lit("#p"), F.substr(w, F.lit(3)))).otherwise(w)

    return F.when(F.contains("__t", F.lit("#s")), F.array_join(F.transform(F.split("__t", " "), token), " ")).otherwise(F.col("__t"))


def annotated(frame: DataFrame, text: str, tokens: str, words: str) -> DataFrame:
    """frame with the tokens and the template of a text; what only may be a name is none."""
    return templates(marked(frame, text), tokens, words)


def _by_join(frame: DataFrame, key: str, listed: DataFrame, how: str) -> tuple[DataFrame, Column]:
    """Marked frame and its naming: names are the words that `listed` (h) has (left_semi) or lacks (left_anti).

    Only hashes of words that may be names are joined and, with the text's key, come back.
    """
    maybe = F.expr(f"array_distinct(transform(filter(split(__t, ' '), w -> startswith(w, '#s')), w -> {_MAYBE}))")
    names = frame.select(key, F.explode(maybe).alias("h")).join(light(listed), "h", how).groupBy(key).agg(F.collect_set("h").alias("__names"))
    named = _naming(lambda word: F.coalesce(F.array_contains("__names", word), F.lit(False)))
    return frame.join(names, key, "left"), named


def _among(hashes: list[int]) -> Callable[[Column], Column]:
    """Is a hash one of a bounded list? The list is one constant: buckets, of which a word looks into its own."""
    size = 1 << max(4, len(hashes).bit_length())
    buckets: list[list[int]] = [[] for _ in range(size)]
    for h in hashes:
        buckets[h % size].append(h)
    known = F.from_json(F.lit(json.dumps(buckets)), "array<array<bigint>>")
    return lambda word: F.array_contains(F.element_at(known, (F.pmod(word, F.lit(size)) + 1).cast("int")), word)


def _bitmap(hashes: DataFrame) -> Callable[[Column], Column]:
    """Can a hash be among those of a frame (h)? A constant of BITS bits whatever the frame's size: it may say yes of others."""
    rows = hashes.groupBy(F.expr(f"cast(pmod(h, {BITS}) div 64 as int)").alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(pmod(h, 64) as int)))").alias("bits"))
    words = [0] * (BITS // 64)
    for r in rows.collect():  # a row for each 64 bits at most
        words[r["at"]] = r.bits
    known = F.from_json(F.lit(json.dumps(words)), "array<bigint>")
    return lambda word: F.getbit(F.element_at(known, (F.floor(F.pmod(word, F.lit(BITS)) / 64) + 1).cast("int")), F.pmod(word, F.lit(64)).cast("int")) == 1


def _hashes(words: str) -> Column:
    return F.expr(f"transform({words}, w -> xxhash64(w))")


def _windows(hashes: str, tokens: str, sizes: list[int], known: str | None = None) -> Column:
    """(hash, pos from 0, size) of the windows of each size over an array of hashed words of a template.

    Windows of which more than half are placeholders have the hash of their tokens, with the values.

    With known, an array saying which words may be among those sought, windows with another word at any of
    four places are passed over: they match nothing.
    """
    parts = []
    for n in sizes:
        places = f"sequence(0, size({hashes}) - {n})"
        if known is not None:
            places = f"filter({places}, i -> {' and '.join(f'get({known}, i + {k})' for k in sorted({0, n - 1, n // 2, n // 4}))})"
        typed = f"size(filter(slice({hashes}, i + 1, {n}), x -> x in (xxhash64('#n'), xxhash64('#p'), xxhash64('#u'))))"
        own = f"if(2 * {typed} > {n}, xxhash64(slice({tokens}, i + 1, {n})), xxhash64(slice({hashes}, i + 1, {n})))"
        window = f"named_struct('hash', {own}, 'pos', i, 'size', {n})"
        parts.append(f"if(size({hashes}) >= {n}, transform({places}, i -> {window}), array())")
    return F.expr(parts[0] if len(parts) == 1 else f"concat({', '.join(parts)})")


def _item_names(benchmark: DataFrame) -> DataFrame:
    """(h) of words that are names in items wherever they stand in capitals: names elsewhere in the benchmark, never in small letters."""
    all_words = annotated(benchmark.select("t"), "t", "tokens", "words").select(F.explode("tokens").alias("w")).distinct()
    names = all_words.filter("startswith(w, '#p')").select(F.explode(F.split(F.expr("substr(w, 3)"), "#p")).alias("w")).distinct()
    # what stands in small letters, so that taking out capitals leaves it
    small_ones = benchmark.select(F.explode(F.split(F.coalesce("t", F.lit("")), r"[^\p{L}]+")).alias("w")).filter("w <> '' and w = lower(w)").distinct()
    return names.join(small_ones, "w", "left_anti").select(F.xxhash64("w").alias("h"))


def _slots(start: str, end: str, shift: str) -> str:
    """The values under the item's placeholders from start to end, and the document's at that shift."""
    pairs = f"transform(sequence({start}, {end}), p -> named_struct('a', element_at(item, p + 1), 'b', element_at(words, p + {shift} + 1)))"
    return f"array_distinct(filter({pairs}, x -> x.a like '#%'))"


def _consistent(slots: str) -> str:
    return f"size(array_distinct(transform({slots}, x -> x.a))) = size({slots}) and size(array_distinct(transform({slots}, x -> x.b))) = size({slots})"


def _chained(runs: str, drift: int) -> Column:
    """(n, same) of the chain that covers most: runs (d, a, b, shift; a to b of the item, d of the document, by d) that
    follow each other in both with shifts that differ by `drift` at most, and fill slots consistently.

    Each run is added to that chain before it that covers most with it. Chains too far back are let go.
    """
    kind = "array<struct<n: int, b: int, shift: int, slots: array<struct<a: string, b: string>>>>"
    start = "greatest(r.a, c.b + 1, c.b + c.shift + 1 - r.shift)"
    longer = f"""transform(filter(acc.open, c -> c.b < r.b and c.b + c.shift < r.b + r.shift and abs(c.shift - r.shift) <= {drift}), c ->
        named_struct('n', c.n + r.b - {start} + 1, 'b', r.b, 'shift', r.shift, 'slots', array_union(c.slots, {_slots(start, "r.b", "r.shift")})))"""
    alone = f"array(named_struct('n', r.b - r.a + 1, 'b', r.b, 'shift', r.shift, 'slots', {_slots('r.a', 'r.b', 'r.shift')}))"
    best = f"array(array_max(filter(concat({longer}, {alone}), z -> {_consistent('z.slots')})))"
    near = f"filter(acc.open, c -> c.b + c.shift + n + {drift} >= r.d)"
    step = f"""element_at(transform({best}, z -> if(z is null, acc, named_struct('open', concat({near}, array(z)),
        'best', array_max(array(acc.best, named_struct('n', z.n, 'same', forall(z.slots, x -> x.a = x.b))))))), 1)"""
    return F.expr(f"aggregate({runs}, named_struct('open', cast(array() as {kind}), 'best', named_struct('n', 0, 'same', false)), (acc, r) -> {step}, acc -> acc.best)")


def leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, cover: float = COVER, drift: int = DRIFT) -> DataFrame:
    """(doc_id, tkey, item_id, coverage, verbatim): documents that hold a benchmark item, or a variant of it.

    An item is held if windows of its template stand in the document's and cover at least `cover` of its
    tokens, at one distance from their places in the item or in a chain of runs in the item's order, between any two
    of which the distance changes by `drift` at most; and if the tokens under them fill slots consistently: equal
    values by equal values, unequal by unequal. `verbatim`: all are equal. An item shorter than the window must
    match whole. Windows of which more than half are placeholders match with equal values only. coverage is the best of the
    item's places in the document; that of chains only where no place at one distance is enough.

    Capitalised words that don't show by their place whether they are names, as the first of a sentence, are names in
    items if they are elsewhere in the benchmark, and in documents also if the benchmark lacks the word.

    Null and empty texts hold nothing, and null and empty items are held by nothing. Rows that repeat
    are found once; doc_id may be null or repeat with other texts (tkey tells them apart). Other
    columns aren't read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "leaks")
    raw = benchmark.select("item_id", F.col("text").alias("t"))
    names = scratch.keep(_item_names(raw), "names")
    of_items, named = _by_join(marked(raw.withColumn("key", text_key(F.col("t"))), "t"), "key", names, "left_semi")
    items = templates(of_items, "item", "words", named).select("item_id", "item", "words").filter("words[0] <> ''").distinct()
    items = scratch.keep(items.withColumn("n", F.size("words")).withColumn("h", _hashes("words")), "items")
    sizes = [r[0] for r in items.select(F.least("n", F.lit(window)).alias("n")).distinct().orderBy("n").collect()]  # at most `window`
    if not sizes:
        return spark.createDataFrame([], "doc_id long, tkey binary, item_id long, coverage double, verbatim boolean")
    vocabulary = scratch.keep(items.select(F.explode("h").alias("h")).distinct(), "vocabulary")
    plain = scratch.keep(vocabulary.join(names, "h", "left_anti"), "plain")

    def told(frame: DataFrame, tokens: str, words: str) -> DataFrame:
        """Documents' templates. A word that may be a name is one unless the benchmark has it as a plain word."""
        frame = marked(frame, "text")
        few = [r.h for r in plain.limit(KNOWN + 1).collect()]
        if len(few) <= KNOWN:
            is_plain = _among(few)
            return templates(frame, tokens, words, _naming(lambda word: ~is_plain(word)))
        joined, named = _by_join(frame, "tkey", plain, "left_anti")
        return templates(joined, tokens, words, named).drop("__names")

    keys = scratch.keep(
        items.withColumn("x", F.explode(_windows("h", "item", sizes))).filter(F.col("x.size") == F.least("n", F.lit(window)))
        .select("x.hash", "item_id", F.col("x.pos").alias("item_pos"), F.col("x.size").alias("size")).distinct(), "keys")
    probes = light(scratch.keep(keys.select("hash").distinct(), "probes"))
    own = docs.select(F.col("doc_id").cast("long"), text_key(F.col("text")).alias("tkey"), "text")
    hashed = told(own, "tokens", "words").withColumn("h", _hashes("words")).drop("words")
    found = hashed.withColumn("k", F.transform("h", _bitmap(vocabulary))).select("doc_id", "tkey", F.explode(_windows("h", "tokens", sizes, "k")).alias("x"))
    seen = found.select("doc_id", "tkey", "x.hash", "x.pos", "x.size").join(probes, ["hash"], "left_semi").join(light(keys), ["hash", "size"])
    ways = (
        seen.groupBy("doc_id", "tkey", "item_id", (F.col("pos") - F.col("item_pos")).alias("shift"), "size")
        .agg(F.collect_set("item_pos").alias("at"))
        .withColumn("covered", F.expr("array_sort(array_distinct(flatten(transform(at, p -> sequence(p, p + size - 1)))))")))
    places = ways.groupBy("doc_id", "tkey", "item_id").agg(F.collect_list(F.struct("shift", "covered")).alias("ways"))
    places = places.join(items.select("item_id", "item", "n"), "item_id").filter(
        F.expr("size(array_distinct(flatten(ways.covered)))") >= cover * F.col("n"))
    places = scratch.keep(places.select(
        F.col("doc_id").alias("held_id"), F.col("tkey").alias("held_key"), "item_id", "ways", "item", "n"), "places")
    held = F.col("doc_id").eqNullSafe(F.col("held_id")) & (F.col("tkey") == F.col("held_key"))
    # only keys are sent to where the texts are; tokens are written down, as lambdas would compute them anew for each place
    holders = scratch.keep(places.select("held_id", "held_key").distinct(), "holders")
    texts = scratch.keep(told(own.join(light(holders), held, "left_semi"), "words", "template").drop("template"), "texts")
    texts = texts.join(places, held)
    key = "doc_id", "tkey", "item_id"
    single = texts.select(*key, "item", "words", "n", F.explode("ways").alias("way")).select(*key, "item", "words", "n", "way.*")
    single = single.filter(F.size("covered") >= cover * F.col("n")).withColumn("pairs", F.expr(
        "transform(covered, p -> named_struct('a', element_at(item, p + 1), 'b', element_at(words, p + shift + 1)))"))
    single = single.withColumn("slots", F.expr("array_distinct(filter(pairs, x -> x.a like '#%'))")).filter(_consistent("slots"))
    single = single.select(*key, F.lit(True).alias("one"), (F.size("covered") / F.col("n")).alias("coverage"), F.expr("forall(slots, x -> x.a = x.b)").alias("same"))
    ends = "arrays_zip(filter(w.covered, p -> not array_contains(w.covered, p - 1)), filter(w.covered, p -> not array_contains(w.covered, p + 1)))"
    runs = f"array_sort(flatten(transform(ways, w -> transform({ends}, e -> named_struct('d', e['0'] + w.shift, 'a', e['0'], 'b', e['1'], 'shift', w.shift)))))"
    chains = texts.filter("size(ways) > 1").withColumn("runs", F.expr(runs)).withColumn("best", _chained("runs", drift))
    chains = chains.select(*key, F.lit(False).alias("one"), (F.col("best.n") / F.col("n")).alias("coverage"), F.col("best.same").alias("same"))
    return single.union(chains.filter(F.col("coverage") >= cover)).groupBy(*key).agg(*(
        F.coalesce(F.max(F.when(F.col("one"), F.col(c))), F.max(c)).alias(name) for c, name in (("coverage", "coverage"), ("same", "verbatim"))))


def without_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of docs that hold no benchmark item; columns pass unchanged."""
    found = Scratch(docs.sparkSession, "leaks").keep(
        leaks(docs, benchmark, **options).select(F.col("doc_id").alias("__id"), F.col("tkey").alias("__key")).distinct(), "found")
    return docs.join(
        light(found), docs["doc_id"].eqNullSafe(F.col("__id")) & (text_key(docs["text"]) == F.col("__key")), "left_anti")


def op9_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Pairs of a document and a benchmark item that it holds."""
    found = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "coverage", "verbatim")
