"""Phrase collocations from count streams in prefix and suffix order.

Every piece of text (texts cut at sentence and clause marks) gives its phrases
of one to three words. Their counts form one table, read as two streams: in
*prefix order* (by lang, first words) it meets each candidate with the count of
its first part and with the three-word phrases that extend it to the right; in
*suffix order* (by lang, last words) with the count of its last part and the
phrases that extend it to the left. The streams are joined by sort-merge joins
(merge hints), so no side is ever built into a hash table; only counted rows
move, never texts.

A candidate is scored at each cut into a first and a last part,
``floor(1e6 * a^2 / (l * r))``, in 38-digit decimals; the weakest cut counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.session import Scratch, hint_if_small, stored

# Fixed values of the contract: pieces end at these marks and line ends;
# words are separated by spaces and tabs only.
PIECE_END = r"[.,;:!?\x0A-\x0D]"
PIECE_WORDS = r"[^\x20\x09]+"
PIECE_CHARS = ".,;:!?\x0a\x0b\x0c\x0d"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
# The per-lang ranking is done in this many parts of each lang first, then once over their leaders.
RANK_PARTS = 256


def collocations(
    docs: DataFrame,
    top: int = 2000,
    least: int = 10,
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """Per lang the ``top`` candidates: lang, rank, phrase, a, l, r, n, score (numbers long).

    Texts are lower-cased in A-Z (null: empty) and cut at ``PIECE_END`` into
    pieces, pieces into words. Per lang (null: ``und``) n counts word occurrences
    and f(phrase) the phrase's contiguous occurrences inside pieces, overlaps
    included. Candidates are phrases of two or three words with a = f >= ``least``;
    l and r are the counts of the two parts at the lowest-scoring cut (ties: the
    earlier cut). A two-word candidate is left out where a three-word candidate
    that holds it (as first or last two words) has 2 * f >= a. Order: score,
    then a, descending, then phrase ascending by UTF-8 bytes; ties of all three
    cannot occur. Rows with null or repeated ids count like others; other
    columns are ignored; an empty table gives no rows.
    """
    with Scratch(docs.sparkSession) as tmp:
        return stored(_collocations(tmp, docs, top, least, text_col, lang_col))


def _collocations(tmp: Scratch, docs: DataFrame, top: int, least: int, text_col: str, lang_col: str) -> DataFrame:
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang")
    # One character mapping: A-Z lower-cased, piece ends to line feeds, tabs to spaces; then plain splits.
    mapped = F.translate(
        F.coalesce(F.col(text_col), F.lit("")), UPPER + PIECE_CHARS + "\t", LOWER + "\n" * len(PIECE_CHARS) + " "
    )
    pieces = docs.select(lang, F.explode(F.split(mapped, "\n")).alias("piece"))
    words = tmp.store(pieces.select("lang", F.array_remove(F.split("piece", " "), "").alias("w")).where(F.size("w") > 0))
    # Every word with the two after it in its piece (nulls past the end), without lambdas.
    size = F.size("w")
    zipped = words.select("lang", "w", F.slice("w", 2, size).alias("y"), F.slice("w", 3, size).alias("z"))
    spots = zipped.select("lang", F.explode(F.arrays_zip(F.col("w").alias("x"), "y", "z")).alias("t")).select("lang", "t.*")

    # Pass 1: one rollup counts words, pairs and each lang's words (grouping id 0, 1, 3).
    rolled = spots.rollup("lang", "x", "y").agg(F.count("*").alias("f"), F.grouping_id().alias("gid"))
    kind = F.when(F.col("gid") == 0, 2).when(F.col("gid") == 1, 1).when(F.col("gid") == 3, 0)
    short = rolled.select("lang", kind.alias("k"), "x", "y", F.lit(None).cast("string").alias("z"), "f")
    short = short.where(F.col("k").isNotNull() & ((F.col("k") < 2) | F.col("y").isNotNull()))
    # Any part of a candidate occurs at least as often as the candidate: rarer phrases are never looked up.
    short = tmp.store(short.where((F.col("k") == 0) | (F.col("f") >= least)))
    # Pass 2: a phrase of three words can only reach ``least`` if both its pairs do; only those are counted.
    pairs = short.where("k = 2").select("lang", "x", "y")
    frequent = hint_if_small(pairs)
    triples = spots.where(F.col("z").isNotNull()).join(frequent, ["lang", "x", "y"], "left_semi")
    triples = triples.join(frequent.select("lang", F.col("x").alias("y"), F.col("y").alias("z")), ["lang", "y", "z"], "left_semi")
    triples = triples.groupBy("lang", "x", "y", "z").agg(F.count("*").alias("f")).where(F.col("f") >= least)
    summed = short.unionByName(tmp.store(triples.select("lang", F.lit(3).alias("k"), "x", "y", "z", "f")))
    totals = short.where("k = 0").select("lang", F.col("f").alias("n"))
    counts = summed.where("k > 0")

    def count_of(size: int, keys: list[str], name: str) -> DataFrame:
        """Counts of phrases of ``size`` words, their words named ``keys``; a sort-merge join side."""
        parts = ["x", "y", "z"][:size]
        side = counts.where(F.col("k") == size).select(
            "lang", *(F.col(p).alias(k) for p, k in zip(parts, keys, strict=True)), F.col("f").alias(name)
        )
        return side.hint("merge")

    cands = counts.where("k >= 2").select("lang", F.col("k").alias("len"), "x", "y", "z", F.col("f").alias("a"))
    # The last word, and the word before it (for two words, the phrase is its own last two).
    cands = cands.withColumns(
        {
            "last": F.when(F.col("len") == 2, F.col("y")).otherwise(F.col("z")),
            "before": F.when(F.col("len") == 2, F.col("x")).otherwise(F.col("y")),
        }
    )
    # Prefix order: counts of first parts; suffix order: counts of last parts.
    scored = (
        cands.join(count_of(1, ["x"], "f_h1"), ["lang", "x"])
        .join(count_of(2, ["x", "y"], "f_h2"), ["lang", "x", "y"])
        .join(count_of(1, ["last"], "f_t1"), ["lang", "last"])
        .join(count_of(2, ["before", "last"], "f_t2"), ["lang", "before", "last"])
    )
    big = "decimal(38,0)"
    scored = scored.withColumns(
        {
            "_l1": F.col("f_h1").cast(big),
            "_r1": F.when(F.col("len") == 2, F.col("f_t1")).otherwise(F.col("f_t2")).cast(big),
            "_l2": F.col("f_h2").cast(big),
            "_r2": F.col("f_t1").cast(big),
        }
    )
    s1 = F.expr("(cast(a as decimal(38,0)) * cast(a as decimal(38,0)) * 1000000) div (_l1 * _r1)")
    s2 = F.expr("(cast(a as decimal(38,0)) * cast(a as decimal(38,0)) * 1000000) div (_l2 * _r2)")
    second = (F.col("len") == 3) & (s2 < s1)
    scored = scored.select(
        "lang",
        "len",
        "x",
        "y",
        "z",
        "a",
        F.when(second, F.col("f_h2")).otherwise(F.col("f_h1")).alias("l"),
        F.when(second | (F.col("len") == 2), F.col("f_t1")).otherwise(F.col("f_t2")).alias("r"),
        F.when(second, s2).otherwise(s1).alias("score"),
    )

    # Extensions: three-word candidates by their first two and by their last two words.
    longer = cands.where("len = 3")
    ext = (
        longer.select("lang", "x", "y", "a")
        .unionByName(longer.select("lang", F.col("y").alias("x"), F.col("z").alias("y"), "a"))
        .groupBy("lang", "x", "y")
        .agg(F.max("a").alias("ext"))
    )
    pairs = scored.where("len = 2").join(ext.hint("merge"), ["lang", "x", "y"], "left")
    pairs = pairs.where(F.col("ext").isNull() | (F.col("ext") * 100 < F.col("a") * 50)).drop("ext")
    kept = pairs.unionByName(scored.where("len = 3"))
    phrase = F.concat_ws(" ", "x", "y", "z")
    kept = tmp.store(kept.select("lang", phrase.alias("phrase"), "a", "l", "r", "score"))

    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    leaders = kept.withColumn("k", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))).where(F.col("k") <= top)
    ranked = leaders.drop("k").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    ranked = ranked.where(F.col("rank") <= top).join(hint_if_small(totals), "lang")
    return ranked.select(
        "lang",
        "rank",
        "phrase",
        F.col("a").cast("long").alias("a"),
        F.col("l").cast("long").alias("l"),
        F.col("r").cast("long").alias("r"),
        "n",
        F.col("score").cast("long").alias("score"),
    )
