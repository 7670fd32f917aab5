"""Benchmark passages in documents, found by winnowed fingerprints and confirmed word by word.

Everything here is DataFrame functions, so it runs without Python workers.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.llm.common import quoted
from stationflow.storage import BROADCAST_ROWS, broadcast_if_small, stage

# What lies between words of the lower-cased text, and A-Z kept: all of ASCII but digits and letters.
BETWEEN_SQL = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def lower_words(text: Column) -> Column:
    """Words of a text with A-Z lower-cased; none for null.

    Splitting takes an eighth of the time of matching the complement. Texts and words within ASCII are lower-cased
    by ``lower``, which does the same there as the slower ``translate``, and more elsewhere.
    """

    def plain(x: Column) -> Column:
        return F.octet_length(x) == F.length(x)

    def lowered(word: Column) -> Column:
        other = F.translate(word, string.ascii_uppercase, string.ascii_lowercase)
        return F.when(plain(word), F.lower(word)).otherwise(other)

    found = F.when(plain(text), F.split(F.lower(text), BETWEEN_SQL)).otherwise(
        F.transform(F.split(text, BETWEEN_SQL), lowered)
    )
    return F.coalesce(F.array_remove(found, ""), F.array().cast("array<string>"))


def gram_words(length: int) -> int:
    """Words of a gram: the largest power of two within half a window, so that few grams are met by chance."""
    return 1 << (max(1, length // 2).bit_length() - 1)


def _let(value: Column, use) -> Column:
    """``use(value)``, with the value bound as a lambda variable: the optimiser would else put it in wherever named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _with_next(array: Column, by: int, combine, then) -> Column:
    """``then`` of: ``combine`` of every element and the one ``by`` places later (null past the end)."""
    return _let(array, lambda a: then(F.zip_with(a, F.slice(a, by + 1, F.size(a)), combine)))


def fingerprints(words: Column, length: int) -> Column:
    """Fingerprints of an array of at least ``length`` words: structs (length, print, at).

    Of every run of length - gram + 1 neighbouring grams the one with the least hash is kept, the first of equals.
    Every window of ``length`` words holds one such run, so two texts that share a window share a fingerprint in
    it. Hashes of grams and minima of runs are put together from halves, so each word costs a few operations
    whatever the length.
    """
    gram = gram_words(length)
    run = length - gram + 1

    def hashed(grams: Column, words_in: int) -> Column:
        if words_in == gram:
            return _let(grams, chosen)
        return _with_next(grams, words_in, lambda x, y: F.xxhash64(x, y), lambda g: hashed(g, 2 * words_in))

    def chosen(grams: Column) -> Column:
        # The place in the low 31 bits: the least of a run names its place, and of equal grams the first.
        placed = F.transform(grams, lambda x, i: x.bitwiseAND(-1 << 31).bitwiseOR(i.cast("bigint")))
        n = F.size(grams)

        def described(x: Column) -> Column:
            at = x.bitwiseAND((1 << 31) - 1).cast("int")
            return F.struct(F.lit(length).alias("length"), F.get(grams, at).alias("print"), at.alias("at"))

        def least(of_runs: Column, reach: int) -> Column:
            if reach == run:
                kept = F.array_distinct(F.slice(of_runs, 1, n - (length - 1)))
                return F.transform(kept, described)
            step = min(reach, run - reach)
            return _with_next(of_runs, step, lambda x, y: F.least(x, y), lambda m: least(m, reach + step))

        return least(placed, 1)

    return hashed(F.transform(words, lambda w: F.xxhash64(w)), 1)


def winnowed(lengths: list[int], keep=lambda length: F.lit(True)) -> Column:
    """Fingerprints of the column ``words`` for every window length; ``keep(length)`` says which rows take part."""
    none = F.array().cast("array<struct<length:int,print:bigint,at:int>>")
    words = F.col("words")
    found = [F.when(keep(n) & (F.size(words) >= n), fingerprints(words, n)).otherwise(none) for n in lengths]
    return F.concat(none, *found)


def _joined(words: Column | str, first: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, first + 1, length), " ")


def benchmark_windows(benchmark: DataFrame, item_id: str, text: str, length: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The windows of a benchmark: (window, names), the sets of items (names, items), fingerprints (length, print).

    Windows with the same items share one name of that set of items, so a passage that many items hold costs a
    document one row, not one for each item.
    """
    words = lower_words(quoted(text)).alias("words")
    items = benchmark.select(F.coalesce(quoted(item_id).cast("string"), F.lit("")).alias("item"), words)
    items = items.where(F.size("words") > 0).withColumn("length", F.least(F.size("words"), F.lit(length)))
    items = stage(items, "items")
    firsts = F.explode(F.sequence(F.lit(0), F.size("words") - F.col("length")))
    windows = items.select("item", "words", "length", firsts.alias("first"))
    windows = windows.select("item", _joined("words", F.col("first"), F.col("length")).alias("window"))
    windows = windows.groupBy("window").agg(F.sort_array(F.collect_set("item")).alias("items"))
    windows = stage(windows.withColumn("names", F.sha2(F.to_json("items"), 256)), "windows")
    sets = windows.select("names", "items").distinct()
    lengths = sorted(row[0] for row in items.select("length").distinct().collect())
    prints = items.select(winnowed(lengths, lambda size: F.col("length") == size).alias("prints"))
    prints = prints.select(F.explode("prints").alias("f"))
    prints = prints.select("f.length", "f.print").distinct()
    return windows.select("window", "names"), sets, stage(prints, "prints")


def small(df: DataFrame) -> bool:
    """Whether a table may be broadcast: counted, up to the limit."""
    return df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS


def covered(hits: Column) -> Column:
    """Words inside a sorted array of windows (first, length)."""
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("reach"))

    def add(state: Column, hit: Column) -> Column:
        end = hit["first"] + hit["length"]
        new = F.greatest(end - F.greatest(hit["first"], state["reach"]), F.lit(0))
        return F.struct((state["n"] + new).alias("n"), F.greatest(end, state["reach"]).alias("reach"))

    return F.aggregate(hits, start, add, lambda state: state["n"])


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    length: int = 10,
) -> DataFrame:
    """One row per document: doc_id, n_words, hits (windows as first, length), n_hit, items, n_items, items_sha256.

    An item's windows are its runs of ``length`` words; an item of fewer words is one window, one without words has
    none. Documents keep the gram of least hash of every run of neighbours, the same is done to the items, and
    where fingerprints meet the whole windows around are compared as text. So every window that occurs is found
    and nothing else. Fingerprints of the benchmark are broadcast if they are few, else joined by shuffle; a
    document then is one row and its hits.

    Null and empty texts have no words and no hits. Repeated rows of documents come out repeatedly; repeated items
    of one id count once, an item without id counts as one of an empty id. With an empty benchmark nothing is
    hit, without documents there are no rows. Other columns of both tables are not used, whatever their names.
    """
    windows, sets, prints = benchmark_windows(benchmark, item_id, item_text, length)
    lengths = sorted(row[0] for row in prints.select("length").distinct().collect())
    rows = docs.select(
        F.monotonically_increasing_id().alias("seat"),
        quoted(doc_id).alias("doc_id"),
        lower_words(quoted(text)).alias("words"),
    )
    # One row of length zero per document, its print spread at random, and its fingerprints.
    own = F.struct(F.lit(0).alias("length"), F.xxhash64("seat").alias("print"), F.lit(0).alias("at"))
    rows = rows.withColumn("prints", F.concat(F.array(own), winnowed(lengths))).withColumn("n_words", F.size("words").cast("bigint"))
    # The outer form: the plain one has Spark test the array's size first, and so build it twice.
    rows = rows.select("seat", "doc_id", "n_words", "words", F.explode_outer("prints").alias("f"))
    rows = rows.select("seat", "doc_id", "n_words", "words", "f.*")
    # Everything that windows around the gram can reach.
    run = F.lit(0)
    gram = F.lit(0)
    for size in lengths:
        run = F.when(F.col("length") == size, F.lit(size - gram_words(size))).otherwise(run)
        gram = F.when(F.col("length") == size, F.lit(gram_words(size))).otherwise(gram)
    start = F.greatest(F.col("at") - run, F.lit(0))
    around = F.when(F.col("length") > 0, F.slice("words", start + 1, F.col("at") + gram + run - start))
    shown = ["seat", "doc_id", "n_words", "length", "print", start.alias("start"), around.alias("around")]
    known = prints.withColumn("met", F.lit(True))
    met = F.expr("length = 0 or met")
    if small(prints):
        # The words go along by reference up to the filter, and are cut only where a fingerprint is met.
        rows = rows.join(F.broadcast(known), ["length", "print"], "left").where(met).select(*shown)
    else:
        rows = rows.select(*shown).join(known, ["length", "print"], "left").where(met)
    steps = F.when(F.col("length") == 0, F.array(F.lit(0))).otherwise(
        F.sequence(F.lit(0), F.size("around") - F.col("length"))
    )
    rows = rows.select("seat", "doc_id", "n_words", "length", "start", "around", F.explode(steps).alias("step"))
    rows = rows.withColumn(
        "window",
        F.when(F.col("length") == 0, F.concat_ws(" ", F.lit(""), "seat", F.lit(""))).otherwise(
            _joined("around", F.col("step"), F.col("length"))
        ),
    )
    rows = rows.join(F.broadcast(windows) if small(windows) else windows, "window", "left")
    rows = rows.where("length = 0 or names is not null")
    hit = F.struct((F.col("start") + F.col("step")).alias("first"), "length")
    judged = rows.groupBy("seat", "doc_id", "n_words").agg(
        F.sort_array(F.collect_set(F.when(F.col("length") > 0, hit))).alias("hits"),
        F.sort_array(F.collect_set("names")).alias("sets"),
    )
    judged = stage(judged, "judged")
    # Documents that hold the same sets of items have the same items: put together once.
    asked = judged.where(F.size("sets") > 0).select("sets").distinct()
    items = asked.select("sets", F.explode("sets").alias("names")).join(sets, "names")
    items = items.select("sets", F.explode("items").alias("item")).groupBy("sets").agg(F.sort_array(F.collect_set("item")).alias("items"))
    items = items.withColumns({"n_items": F.size("items").cast("bigint"), "digest": F.sha2(F.array_join("items", ","), 256)})
    # Documents without hits take no part in the join, where they would all meet under one key.
    clean = judged.where(F.size("sets") == 0)
    named = judged.where(F.size("sets") > 0).join(broadcast_if_small(items), "sets", "left")
    return named.unionByName(clean, allowMissingColumns=True).select(
        "doc_id",
        "n_words",
        "hits",
        covered(F.col("hits")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("n_items", F.lit(0).cast("bigint")).alias("n_items"),
        F.coalesce("digest", F.sha2(F.lit("").cast("binary"), 256)).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )
