"""Benchmark decontamination by winnowing, in DataFrame operations only.

A window is WINDOW consecutive words of an item; an item of fewer words is one window. A
document word inside an occurrence of any window is hit.

Fingerprints: of every run of GRAMS - k + 1 consecutive k-gram hashes the least is kept, in
documents and items alike. A shared span of WINDOW words holds one such run in full, so it
shares a fingerprint: no window can be missed. Documents that share one are read again;
their hits are extended to the windows around them, and those are compared word by word
(as text, not as hashes) with the items' windows. Items of fewer words than a window have
no complete run: their only window is looked up by its own hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.columns import compute_once
from tidelog.llm.components import written

WINDOW = 13
GRAM = 7
# fixed values: ASCII characters that are no part of a word, once A-Z are lowered
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ["doc_id", "text_key"]


def words(text: Column) -> Column:
    """Words of a text in order; null and blank texts have none."""
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), SEPARATORS)
    return F.filter(parts, lambda w: w != "")


def _run_hashes(hashes: Column, size: int) -> Column:
    """Hash of the `size` words from each position; null where they pass the end."""
    return F.transform(
        hashes,
        lambda h, i: F.when(
            F.get(hashes, i + (size - 1)).isNotNull(),
            F.xxhash64(h, *[F.get(hashes, i + j) for j in range(1, size)]),
        ),
    )


def _with_hashes(df: DataFrame) -> DataFrame:
    # once for each text, not again for each reference in a lambda or pushed filter
    return compute_once(df, hashes=F.transform("words", lambda w: F.xxhash64(w)))


def _with_grams(df: DataFrame) -> DataFrame:
    return compute_once(_with_hashes(df), grams=_run_hashes(F.col("hashes"), GRAM))


def _winnowed(grams: Column) -> Column:
    """The least hash of each full run of k-grams, without repeats."""
    run = WINDOW - GRAM + 1
    least = F.transform(
        grams,
        lambda g, i: F.when(
            F.get(grams, i + (run - 1)).isNotNull(), F.least(g, *[F.get(grams, i + j) for j in range(1, run)])
        ),
    )
    return F.array_distinct(F.filter(least, lambda g: g.isNotNull()))


def _text_of(words_: Column, start: Column, size: Column) -> Column:
    return F.array_join(F.slice(words_, start + 1, size), " ")


def benchmark_windows(spark: SparkSession, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(fingerprints, windows) of items (item_id, text), as written tables.

    fingerprints: size (GRAM, or the word count of short items) and hash.
    windows: text, size, item_id.
    """
    split = items.select("item_id", words(F.col("text")).alias("words")).where(F.size("words") > 0)
    split = _with_grams(split.withColumn("n", F.size("words")))
    windows = split.select(
        "item_id",
        "words",
        F.least("n", F.lit(WINDOW)).alias("size"),
        F.explode(F.sequence(F.lit(0), F.greatest(F.col("n") - WINDOW, F.lit(0)))).alias("start"),
    ).select(_text_of(F.col("words"), F.col("start"), F.col("size")).alias("window"), "size", "item_id")
    long = split.where(f"n >= {WINDOW}").select(F.lit(GRAM).alias("size"), F.explode(_winnowed(F.col("grams"))).alias("hash"))
    prints = written(spark, long.withColumn("long", F.lit(True)).distinct(), "prints")
    short = split.where(f"n < {WINDOW}")
    sizes = sorted(r.n for r in short.select("n").distinct().collect())
    for size in sizes:
        own = short.where(F.col("n") == size).select(F.explode(_run_hashes(F.col("hashes"), size)).alias("hash"))
        own = own.where("hash IS NOT NULL").select(F.lit(size).alias("size"), "hash", F.lit(False).alias("long"))
        prints = prints.union(own.distinct())
    return written(spark, prints, "prints"), written(spark, windows.distinct(), "windows")


def _hits(docs: DataFrame, prints: DataFrame, sizes: list[int]) -> DataFrame:
    """(key, start, size) of the windows to compare: those that hold a shared fingerprint."""
    at = F.posexplode("grams").alias("pos", "hash")
    # a text of fewer words holds no window, though it may share a fingerprint with one
    long = (
        docs.where(F.col("n_words") >= WINDOW)
        .select(*KEY, "n_words", at)
        .join(prints.where("long").select("hash"), "hash")
        .select(
            *KEY,
            F.explode(
                F.sequence(
                    F.greatest(F.col("pos") - (WINDOW - GRAM), F.lit(0)),
                    F.least(F.col("pos"), F.col("n_words") - WINDOW),
                )
            ).alias("start"),
            F.lit(WINDOW).alias("size"),
        )
    )
    for size in sizes:
        runs = compute_once(docs, runs=_run_hashes(F.col("hashes"), size))
        runs = runs.select(*KEY, F.posexplode("runs").alias("start", "hash"))
        own = runs.join(prints.where(~F.col("long") & (F.col("size") == size)).select("hash"), "hash")
        long = long.union(own.select(*KEY, "start", F.lit(size).alias("size")))
    return long.distinct()


def _covered(spans: Column) -> Column:
    """Number of words in the union of (start, size) spans."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("total"))
    return F.aggregate(
        F.array_sort(spans),
        zero,
        lambda acc, s: F.struct(
            F.greatest(acc["end"], s["start"] + s["size"]).alias("end"),
            (acc["total"] + F.greatest(F.lit(0), s["start"] + s["size"] - F.greatest(acc["end"], s["start"]))).alias("total"),
        ),
        lambda acc: acc["total"],
    )


def _same(a: str, b: str) -> Column:
    """Equal keys; a null doc_id equals a null doc_id."""
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.text_key") == F.col(f"{b}.text_key"))


def overlaps(spark: SparkSession, docs: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, matches, windows): where item windows occur.

    documents: doc_id, text_key (hash of the text), n_words; one row for each row of docs.
    matches: doc_id, text_key, start, size, window; one row for each occurrence in a text,
    once for repeated rows.
    windows: window, size, item_id.
    """
    prints, windows = benchmark_windows(spark, items)
    sizes = sorted(r["size"] for r in prints.where("NOT long").select("size").distinct().collect())
    given = docs.select("doc_id", F.xxhash64("text").alias("text_key"), words(F.col("text")).alias("words"))
    given = given.withColumn("n_words", F.size("words"))

    winnowed = _with_grams(given).select(*KEY, "n_words", _winnowed(F.col("grams")).alias("prints"))
    seen = written(spark, winnowed, "winnowed")
    found = seen.select(*KEY, F.explode("prints").alias("hash")).join(prints.where("long").select("hash"), "hash")
    found = found.select(*KEY)
    for size in sizes:
        hashed = compute_once(_with_hashes(given), runs=F.array_distinct(_run_hashes(F.col("hashes"), size)))
        runs = hashed.select(*KEY, F.explode("runs").alias("hash"))
        own = prints.where(~F.col("long") & (F.col("size") == size)).select("hash")
        found = found.union(runs.join(own, "hash").select(*KEY))
    suspects = written(spark, found.distinct(), "suspects")

    again = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")).alias("d")
    again = again.join(suspects.alias("s"), _same("d", "s"), "left_semi").dropDuplicates(KEY)
    again = again.select(*KEY, words(F.col("text")).alias("words")).withColumn("n_words", F.size("words"))
    again = written(spark, again, "suspect_words")
    starts = _hits(_with_grams(again), prints, sizes).groupBy(*KEY).agg(
        F.collect_list(F.struct("start", "size")).alias("spans")
    )
    spans = (
        again.alias("d")
        .join(starts.alias("s"), _same("d", "s"))
        .select("d.doc_id", "d.text_key", "words", F.explode("spans").alias("span"))
    )
    texts = spans.select(
        *KEY,
        F.col("span.start").alias("start"),
        F.col("span.size").alias("size"),
        _text_of(F.col("words"), F.col("span.start"), F.col("span.size")).alias("window"),
    )
    matches = texts.join(windows.select("window", "size").distinct(), ["window", "size"])
    return seen.select(*KEY, "n_words"), written(spark, matches, "matches"), windows


def contamination(spark: SparkSession, docs: DataFrame, items: DataFrame, share: int = 20) -> DataFrame:
    """One row for each row of docs (doc_id, text): how much of it is benchmark text.

    Columns: doc_id, text_key, n_words, n_hit, n_items, item_ids (sorted as text) and
    contaminated (n_hit > 0 and share * n_hit >= n_words). Null and blank texts have no
    words and are clean; items without words have no window; an item without item_id makes
    words hit but is not listed; repeated items count once, repeated rows come back as
    often as they went in, and a null doc_id is a value like any other. Other columns are
    not read.
    """
    seen, matches, windows = overlaps(spark, docs, items)
    hit = matches.groupBy(*KEY).agg(_covered(F.collect_set(F.struct("start", "size"))).alias("n_hit"))
    named = (
        matches.select(*KEY, "window")
        .distinct()
        .join(windows.select("window", "item_id").where("item_id IS NOT NULL"), "window")
        .select(*KEY, F.col("item_id").cast("string").alias("item_id"))
        .distinct()
        .groupBy(*KEY)
        .agg(F.array_sort(F.collect_list("item_id")).alias("item_ids"))
    )
    found = hit.alias("h").join(named.alias("i"), _same("h", "i"), "left").select("h.*", "i.item_ids")
    none = F.array().cast("array<string>")
    out = (
        seen.alias("d")
        .join(found.alias("h"), _same("d", "h"), "left")
        .select(
            "d.doc_id",
            "d.text_key",
            F.col("d.n_words").cast("long").alias("n_words"),
            F.coalesce("h.n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce("h.item_ids", none).alias("item_ids"),
        )
        .withColumn("n_items", F.size("item_ids").cast("long"))
    )
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words")))
