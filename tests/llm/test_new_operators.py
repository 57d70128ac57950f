"""Decontamination, run detection and collocations against brute force on small tables with edge cases."""

import hashlib
import re

import pytest

from gleanery.llm.contamination import contamination

ITEM_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def item_words(text):
    return ITEM_WORDS.findall((text or "").translate(LOWER))


def brute_contamination(docs, items, window=10):
    phrases = set()
    for item_id, text in items:
        w = item_words(text)
        n = min(len(w), window)
        phrases |= {(item_id, tuple(w[s : s + n])) for s in range(len(w) - n + 1)} if w else set()
    out = []
    for doc_id, text in docs:
        w = item_words(text)
        hit, named = set(), set()
        for item_id, p in phrases:
            for s in range(len(w) - len(p) + 1):
                if tuple(w[s : s + len(p)]) == p:
                    hit |= set(range(s, s + len(p)))
                    if item_id is not None:
                        named.add(str(item_id))
        listed = sorted(named)
        out.append((doc_id, len(w), len(hit), len(listed), sha(",".join(listed)), bool(hit)))
    return sorted(out, key=repr)


BENCH = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today."),
    (2, "Short ITEM only"),
    (3, None),
    (4, "..."),
    (None, "nameless passage of words that still hits"),
    (5, "ünïcode wörds 42 are words; too, and so"),
    (1, "The quick brown fox jumps over the lazy dog near the river bank today."),
]
DOCS = [
    (0, None),
    (1, ""),
    (2, "the QUICK brown fox jumps over the lazy dog near the river, and more"),
    (3, "quick brown fox jumps over the lazy dog near the river bank"),
    (4, "x short item only y short item only"),
    (5, "a nameless passage of words that still hits b"),
    (6, "ÜNÏCODE wörds 42 are words too and so on"),
    (6, "ünïcode wörds 42 are words too and so on"),
    (None, "short item only"),
    (8, " ".join(["fox jumps over"] * 4000) + " the quick brown fox jumps over the lazy dog near the river bank today"),
    (9, "short item"),
]


def test_contamination_against_brute_force(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").repartition(3)
    docs = docs.withColumns({"row": docs.doc_id, "pid": docs.doc_id, "term": docs.text})
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    bench = bench.withColumns({"phrase": bench.item_id, "w": bench.text, "word": bench.text})
    got = sorted(map(tuple, contamination(docs, bench).collect()), key=repr)
    assert got == brute_contamination(DOCS, BENCH)
    by_id = {r[0]: r for r in got}
    assert by_id[2][2] == 12 and by_id[3][2] == 12 and by_id[4][2] == 6 and by_id[5][3] == 0 and by_id[5][2] == 7


def test_contamination_of_empty_tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    none = spark.createDataFrame([], "doc_id long, text string")
    assert contamination(none, bench).count() == 0
    rows = contamination(docs, none.withColumnRenamed("doc_id", "item_id")).collect()
    assert len(rows) == len(DOCS) and not any(r.contaminated for r in rows)
    assert {r.items_sha256 for r in rows} == {sha("")}


@pytest.mark.parametrize("window", [1, 3])
def test_contamination_other_windows(spark, window):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    got = sorted(map(tuple, contamination(docs, bench, window=window).collect()), key=repr)
    assert got == brute_contamination(DOCS, BENCH, window)


PIECE_END = re.compile(r"[.,;:!?\x0A-\x0D]")
PIECE_WORDS = re.compile(r"[^\x20\x09]+")


def brute_collocations(rows, top, least):
    from collections import Counter

    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in PIECE_END.split((text or "").translate(LOWER)):
            w = PIECE_WORDS.findall(piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    f[lang, " ".join(w[i : i + k])] += 1
    cands = {key: a for key, a in f.items() if a >= least and key[1].count(" ") >= 1}
    out = []
    for (lang, phrase), a in cands.items():
        w = phrase.split(" ")
        if len(w) == 2 and any(
            lang == la and len(p.split(" ")) == 3 and phrase in (" ".join(p.split(" ")[:2]), " ".join(p.split(" ")[1:])) and 2 * b >= a
            for (la, p), b in cands.items()
        ):
            continue
        cuts = []
        for k in range(1, len(w)):
            left, right = f[lang, " ".join(w[:k])], f[lang, " ".join(w[k:])]
            cuts.append((1_000_000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out.append((lang, phrase, a, left, right, n[lang], score))
    ranked = []
    for lang in {r[0] for r in out}:
        mine = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        ranked += [(r[0], i + 1, *r[1:]) for i, r in enumerate(mine[:top])]
    return sorted(ranked)


def collocation_corpus():
    import random

    rng = random.Random(7)
    vocab = ["of", "the", "New", "york", "city", "ünï", "a\x0bb", "x", "Ω", "big apple"]
    rows = [(None, None), ("en", ""), (None, "new york. New York; NEW YORK city")]
    for i in range(300):
        text = " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 25)))
        text = text.replace(" the ", rng.choice([" the ", ". the ", "\tthe ", " the\n"]))
        rows.append((rng.choice(["en", "de", None]), text))
    return rows + rows[:20]


@pytest.mark.parametrize("top,least", [(2000, 10), (5, 3)])
def test_collocations_against_brute_force(spark, top, least):
    from gleanery.llm.collocations import collocations

    rows = collocation_corpus()
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    docs = docs.withColumns({"phrase": docs.text, "f": docs.lang, "a": docs.lang, "weight": docs.text})
    got = collocations(docs, top=top, least=least)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    got = sorted((r.lang, r.rank, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got.collect())
    want = brute_collocations(rows, top, least)
    assert got == want and len(want) > 10


def test_collocations_of_nothing(spark):
    from gleanery.llm.collocations import collocations

    empty = spark.createDataFrame([], "lang string, text string")
    assert collocations(empty).count() == 0


def test_collocation_scores_are_exact_past_64_bits(spark):
    a, left, right = 3_000_000_019, 3_000_000_021, 3_000_000_037
    row = spark.sql(
        f"SELECT (cast({a} as decimal(38,0)) * cast({a} as decimal(38,0)) * 1000000)"
        f" div (cast({left} as decimal(38,0)) * cast({right} as decimal(38,0))) AS s"
    ).first()
    assert row.s == 1_000_000 * a * a // (left * right)


def brute_runs(x):
    """Every maximal stretch per period from the definition, kept at its smallest period."""
    n, out = len(x), set()
    for q in range(1, n + 1):
        i = 0
        while i < n - q:
            if x[i] != x[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and x[j] == x[j + q]:
                j += 1
            s, length = i, j + q - i
            seg = x[s : s + length]
            smallest = next(d for d in range(1, length + 1) if all(seg[k] == seg[k + d] for k in range(length - d)))
            if smallest == q and length >= max(6, 4 * q):
                out.add((s, length, q))
            i = j + 1
    return sorted(out)


def test_runs_against_definition():
    import random

    import numpy as np

    from gleanery.llm.periodic import runs

    rng = random.Random(3)
    for trial in range(400):
        unit = [rng.randrange(3) for _ in range(rng.randint(1, 4))]
        x = [rng.randrange(3) for _ in range(rng.randint(0, 30))]
        at = rng.randint(0, len(x))
        x = x[:at] + unit * rng.randint(1, 8) + x[at:] + [rng.randrange(2) for _ in range(rng.randint(0, 9))]
        assert runs(np.array(x, dtype=np.int64)) == brute_runs(x), x


def test_planted_tail_follows_the_contract():
    import zlib

    from gleanery.llm.periodic import planted

    ids = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 10 == 0]
    words = [f"w{k}" for k in range(50)]
    for doc_id in ids[:20]:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a, p = g % 50, 1 + (50 - g % 50) // (3 + g % 8)
        assert planted(words, doc_id) == [words[i] if i < a else words[a + (i - a) % p] for i in range(50)]
    assert planted(words, 1) == words or zlib.crc32(b"1") % 10 == 0
    assert planted([], ids[0]) == [] and planted(words, None) == words


def test_periodic_runs_rows(spark):
    from gleanery.llm.periodic import WORDS, describe, periodic_runs

    texts = [None, "", "   ", "a a a a a a", "a b a b a b a b c", "x " * 5000, "one two three", "y\tz " * 3 + "y z y z"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "q q q q q q q"), (3, "a a a a a a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    docs = docs.withColumns({"n_runs": docs.text, "start": docs.text})
    got = sorted(map(tuple, periodic_runs(docs).collect()), key=repr)
    assert got == sorted((describe(i, t) for i, t in rows), key=repr)
    by_text = {t: describe(i, t) for i, t in rows}
    assert by_text["a a a a a a"][1:6] == (1, 0, 6, 1, 6000)
    assert by_text["a b a b a b a b c"][1:6] == (1, 0, 8, 2, 4000)
    assert by_text[""][1:6] == (0, None, None, None, None) and by_text[""][7] == sha("")
    assert by_text["a a a a a a"][7] == sha("a")
    assert all(WORDS.pattern for _ in "x")
    assert periodic_runs(docs.where("false")).count() == 0
