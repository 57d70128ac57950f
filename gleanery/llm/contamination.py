"""Benchmark decontamination by a distributed positional inverted index.

The postings of the training documents, (row, position, term), are kept for the
words that the test items use. Every window of a test item (``window``
consecutive words) is looked up from its three rarest words: their postings,
each moved back by the word's offset in the window, give places where the
window could start; the places met by all three are checked against every
other word of the window by its postings. What passes is an exact phrase
match. A document word inside a match is *hit*.

The texts are read once. Nothing is shuffled by document: postings move by term
for the frequencies and by (row, start) for the intersections; the tables of
windows, rare terms and candidates are broadcast only after their size was
measured, else joined by shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.session import Scratch, hint_if_small, stored

# Fixed values of the contract: words are runs of digits, lower-case ASCII
# letters and anything outside ASCII, after A-Z were lower-cased.
ITEM_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
# The ASCII characters that ITEM_WORDS leaves out, built from its ranges (A-Z are lower-cased instead).
SEPARATORS = "".join(chr(c) for c in (*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)))
# Candidate starts must be met by this many of a window's rarest terms before every term is checked.
RAREST = 3
# Joins the two words of a pair term; words never hold it.
PAIR = " "


def item_words(text: Column) -> Column:
    """The words of a text as an array (matches of ``ITEM_WORDS``); null has none.

    Separators become spaces and A-Z lower case in one character mapping, then
    the text is split at spaces: the same words as the pattern, without a regex.
    """
    mapped = F.translate(F.coalesce(text, F.lit("")), SEPARATORS + UPPER, " " * len(SEPARATORS) + LOWER)
    return F.array_remove(F.split(mapped, " "), "")


def _windows(bench: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """(item_id, phrase): every window of every item, an item shorter than ``window`` as one."""
    items = bench.select(F.col(item_col).alias("item_id"), item_words(F.col(text_col)).alias("w"))
    items = items.where(F.size("w") > 0).withColumn("n", F.least(F.size("w"), F.lit(window)))
    starts = F.explode(F.sequence(F.lit(1), F.size("w") - F.col("n") + 1)).alias("s")
    return items.select("item_id", "w", "n", starts).select("item_id", F.slice("w", F.col("s"), F.col("n")).alias("phrase"))


def contamination(
    docs: DataFrame,
    bench: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    Words: see ``item_words``; null texts have none, and items without words have
    no window. n_hit counts the document's words inside at least one occurrence of
    a window; n_items the distinct non-null item ids with an occurring window
    (items with a null id hit words but are not named); items_sha256 is the
    SHA-256 of those ids as text, sorted as strings and joined by commas (of the
    empty string where there are none). Rows with null or repeated doc_ids are
    judged one by one; repeated items and windows count once. Other columns of
    both tables are ignored, whatever their names. A very long text is one row
    of postings per word: its memory is that of its word array in one task.
    """
    with Scratch(docs.sparkSession) as tmp:
        return stored(_contamination(tmp, docs, bench, id_col, text_col, item_col, item_text_col, window))


def _contamination(
    tmp: Scratch,
    docs: DataFrame,
    bench: DataFrame,
    id_col: str,
    text_col: str,
    item_col: str,
    item_text_col: str,
    window: int,
) -> DataFrame:
    windows = tmp.store(_windows(bench, item_col, item_text_col, window).distinct())
    phrases = tmp.store(windows.select("phrase").distinct().withColumn("pid", F.monotonically_increasing_id()))
    owners = windows.join(phrases, "phrase").select("pid", "item_id")
    # A window's terms: its pairs of consecutive words at their offsets; a window of one word is its one term.
    size = F.size("phrase")
    pairs = F.transform(
        F.sequence(F.lit(1), F.greatest(size - 1, F.lit(1))),
        lambda i: F.concat_ws(PAIR, F.element_at("phrase", i), F.element_at("phrase", i + 1)),
    )
    keys = phrases.select("pid", size.alias("words"), F.when(size >= 2, pairs).otherwise(F.col("phrase")).alias("keys"))
    keys = keys.select("pid", "words", F.size("keys").alias("len"), F.posexplode("keys").alias("off", "key"))
    vocab = tmp.store(keys.select("key").distinct().withColumn("term", F.monotonically_increasing_id()))
    terms = keys.join(vocab, "key").select("pid", "words", "len", "off", "term")
    singles = vocab.where(~F.col("key").contains(PAIR))

    # One pass over the documents: a posting per pair of consecutive words (and per single word, where
    # windows of one word exist) that the test set has, as term ids; per row one posting without term
    # whose position is the row's word count.
    words = item_words(F.col(text_col))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), words.alias("a"))
    rows = rows.select("row", "doc_id", F.concat("a", F.array(F.lit(None).cast("string"))).alias("a"))
    rows = rows.select("row", "doc_id", "a", F.slice("a", 2, F.size("a")).alias("b"))
    spots = rows.select("row", "doc_id", F.posexplode(F.arrays_zip("a", "b")).alias("pos", "t"))
    spots = spots.select(
        "row",
        F.when(F.col("t.a").isNull(), F.col("doc_id")).alias("doc_id"),
        "pos",
        F.col("t.a").alias("single"),
        F.when(F.col("t.b").isNotNull(), F.concat_ws(PAIR, "t.a", "t.b")).alias("key"),
    )
    spots = spots.join(hint_if_small(vocab), "key", "left")
    if not singles.isEmpty():
        one = singles.select(F.col("key").alias("single"), F.col("term").alias("term1"))
        spots = spots.join(hint_if_small(one), "single", "left")
    else:
        spots = spots.withColumn("term1", F.lit(None).cast("long"))
    spots = spots.where(F.col("term").isNotNull() | F.col("term1").isNotNull() | F.col("single").isNull())
    entries = tmp.store(spots.select("row", "pos", "term", "term1", "doc_id"))
    # Rows that kept neither term are the word counts.
    counted = entries.where(F.col("term").isNull() & F.col("term1").isNull()).select("row", "doc_id", F.col("pos").alias("n_words"))
    postings = entries.where(F.col("term").isNotNull()).select("row", "pos", "term").unionByName(
        entries.where(F.col("term1").isNotNull()).select("row", "pos", F.col("term1").alias("term"))
    )
    # Term frequencies; a window with a term that no document has cannot occur.
    freq = postings.groupBy("term").agg(F.count("*").alias("df"))
    known = terms.join(freq, "term")
    complete = known.groupBy("pid").agg(F.count("*").alias("k"), F.first("len").alias("len")).where("k = len")
    known = tmp.store(known.join(complete.select("pid"), "pid"))
    rarity = F.row_number().over(Window.partitionBy("pid").orderBy("df", "off"))
    rare = known.withColumn("rank", rarity).where(F.col("rank") <= RAREST).select("pid", "off", "term", "rank")
    need = rare.groupBy("pid").agg(F.count("*").alias("need"))

    # Starts where the rarest terms all stand at their offsets.
    rare = tmp.store(rare.join(need, "pid"))
    hits = postings.join(hint_if_small(rare), "term").select("pid", "row", (F.col("pos") - F.col("off")).alias("start"), "need")
    candidates = hits.where("start >= 0").groupBy("pid", "row", "start").agg(F.count("*").alias("k"), F.first("need").alias("need"))
    candidates = tmp.store(candidates.where("k = need").select("pid", "row", "start"))

    # Every term of a candidate checked against the postings; all pairs in place mean all words are.
    checks = candidates.join(known.select("pid", "off", "term", "len", "words"), "pid").select(
        "pid", "row", "start", "len", "words", (F.col("start") + F.col("off")).alias("pos"), "term"
    )
    checks = tmp.store(checks)
    met = postings.join(hint_if_small(checks), ["row", "pos", "term"])
    matches = tmp.store(
        met.groupBy("pid", "row", "start")
        .agg(F.count("*").alias("k"), F.first("len").alias("len"), F.first("words").alias("words"))
        .where("k = len")
    )

    covered = matches.select("row", F.explode(F.sequence("start", F.col("start") + F.col("words") - 1)).alias("pos"))
    n_hit = covered.distinct().groupBy("row").agg(F.count("*").alias("n_hit"))
    named = matches.select("pid", "row").distinct().join(owners.where(F.col("item_id").isNotNull()), "pid")
    items = named.groupBy("row").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))

    out = counted.join(n_hit, "row", "left").join(items, "row", "left")
    listed = F.coalesce(F.col("items"), F.array().cast("array<string>"))
    return out.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )
