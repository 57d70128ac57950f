"""Every operator against brute force on small tables with nulls, empty and long texts, ties, repeats and clashing names."""

import base64
import hashlib
import os
import pickle
import random
import re
import textwrap
import time
import zlib
from itertools import pairwise

import numpy as np
import public_tokenizers as public
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gleanery.llm import licences, lines, near, neighbours, packing, words
from gleanery.llm.bpe import Bpe, encode_documents, load_ranks
from gleanery.llm.components import components
from gleanery.llm.exact import exact_duplicates
from gleanery.llm.licences import recognise_licences
from gleanery.llm.lines import near_duplicate_lines
from gleanery.llm.near import NearRule, least_matches, near_duplicates
from gleanery.llm.neighbours import nearest
from gleanery.llm.packing import WordEncoder, best_fit_plan, pack_documents
from gleanery.llm.quality import Crf, fit_quality, forward_backward, score_quality
from gleanery.llm.sharding import communication_matrix, shard_rows
from gleanery.llm.substring import SuffixAutomaton, remove_repeats
from gleanery.session import Scratch
from tests.conftest import plan_of

RANKS = "file://" + public.path("byte_bpe_multi_50k.tiktoken")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, row long, kept string, sig binary, length int"


def corpus():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 4)))
    base = [word() for _ in range(120)]
    texts = [None, "", " \n\t ", "one", "one two", "One  TWO", " ".join(base), "\n".join(base), "x " * 300]
    for _ in range(12):
        changed = list(base)
        for _ in range(rng.randint(1, 6)):
            changed[rng.randrange(len(changed))] = word()
        texts.append(" ".join(changed))
    texts += [" ".join(word() for _ in range(rng.randint(1, 60))) for _ in range(12)]
    texts += [" ".join([*(word() for _ in range(15)), *base[20:60], *(word() for _ in range(5))]) for _ in range(3)]
    texts.append(" ".join(word() for _ in range(30_000)))
    return dict(enumerate(texts)) | {100: texts[6], 101: texts[6], 102: None}


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, -1, "no", b"", 7) for k, t in corpus().items()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


class Links:
    def __init__(self, nodes):
        self.up = {k: k for k in nodes}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def linked(sets, least=(75, 100)):
    keys = sorted(sets)
    links = Links(keys)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            both = len(sets[a] & sets[b])
            if both and least[1] * both >= least[0] * len(sets[a] | sets[b]):
                links.join(a, b)
    return {k: links.find(k) for k in keys}


def shingles(units, n):
    return frozenset([tuple(units)] if 0 < len(units) < n else [tuple(units[i : i + n]) for i in range(len(units) - n + 1)])


def test_components(spark):
    rng = random.Random(1)
    edges = [(a, a + 1) for a in range(60)] + [(100 + rng.randrange(40), 100 + rng.randrange(40)) for _ in range(30)]
    edges += [(200, x) for x in range(201, 260)] + [(5, 5)]
    links = Links({x for e in edges for x in e})
    for e in edges:
        links.join(*e)
    with Scratch(spark) as tmp:
        got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long"), tmp).collect()))
    assert got == {x: links.find(x) for e in edges for x in e if e[0] != e[1]}


def test_near(docs, empty):
    texts = corpus()
    sets = {k: shingles(WORDS.findall((t or "").lower()), 5) for k, t in texts.items()}
    want = linked(sets)
    got = {r.doc_id: r for r in near_duplicates(docs).collect()}
    assert {k: (r.n_shingles, r.component_id, r.kept) for k, r in got.items()} == {
        k: (len(sets[k]), want[k], want[k] == k) for k in texts
    }
    assert near_duplicates(empty).count() == 0


def test_near_repeated_and_null_ids(spark):
    rows = [(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (None, None)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id is None, r.component_id, r.kept) for r in got if r.n_shingles) == [
        (False, 3, False),
        (False, 3, True),
        (True, 3, False),
    ]
    assert [r.kept for r in got if not r.n_shingles] == [True]


def test_near_pairs_of_a_group_under_the_threshold(spark, monkeypatch):
    """Copies that are alike, but mostly not enough: pairs that can't be links are not compared."""
    rng = random.Random(11)
    base = [f"w{i}" for i in range(200)]
    texts = {}
    for i, share in enumerate([0.015] * 40 + [0.03] * 120):
        texts[i] = " ".join(str(rng.random()) if rng.random() < share else w for w in base)
    sent, test = [], near._test
    monkeypatch.setattr(near, "_test", lambda pairs, *rest: (sent.append(pairs.count()), test(pairs, *rest))[1])
    got = near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    sets = {k: shingles(t.split(), 5) for k, t in texts.items()}
    want = linked(sets)
    assert {r.doc_id: r.component_id for r in got} == {k: want[k] for k in texts}
    several = len({want[k] for k in texts})
    assert several > 20
    assert sent[-1] < 5 * len(texts)


def test_sequential_test_hardly_drops_links():
    rule = NearRule()
    rng = np.random.default_rng(0)
    agree = np.cumsum(rng.random((200_000, rule.hashes)) < 0.75, axis=1)
    dropped = np.zeros(len(agree), dtype=bool)
    for n, least in least_matches(rule):
        dropped |= agree[:, n - 1] < least
    assert dropped.sum() == 0
    assert least_matches(rule)[-1][1] > 0.5 * rule.hashes


def test_lines(docs, empty):
    sets = {}
    for k, t in corpus().items():
        for i, line in enumerate((t or "").split("\n")):
            sets[k, i] = shingles(" ".join(line.lower().split()), 8)
    want = linked({k: s for k, s in sets.items() if s})
    got = {(r.doc_id, r.line): r for r in near_duplicate_lines(docs).collect()}
    assert set(got) == set(sets)
    for k, r in got.items():
        assert (r.component_doc, r.component_line) == want.get(k, k)
        assert r.kept == (want.get(k, k) == k)
    assert near_duplicate_lines(empty).count() == 0


def test_equal_lines_are_sketched_once(spark, monkeypatch):
    sent = []
    monkeypatch.setattr(lines, "near_duplicates", lambda df, *a, **k: (sent.append(df.count()), near_duplicates(df, *a, **k))[1])
    rows = [(i, "A line  that comes in every text\n\na line\tthat comes in\x0bEVERY text ") for i in (5, None, 3, 3)]
    got = near_duplicate_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sent == [2]  # one line and the empty one
    alike = [r for r in got if r.n_shingles]
    assert len(got) == 12 and {(r.component_doc, r.component_line) for r in alike} == {(3, 0)}
    assert [(r.doc_id, r.line) for r in alike if r.kept] == [(3, 0)]
    assert all(r.kept and (r.component_doc, r.component_line) == (r.doc_id, 1) for r in got if not r.n_shingles)


def test_lines_leave_no_shuffles_behind_and_find_texts_by_their_hashes(spark, monkeypatch):
    monkeypatch.setattr(near, "_bodies", None)  # which makes the sets of all lines again
    rng = random.Random(3)
    line = "".join(rng.choices("abcdefgh ", k=200))
    rows = [(i, f"{line[:i]}X{line[i:]}\n" + "".join(rng.choices("abc ", k=50))) for i in range(40, 60)]
    folder = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {f for f in map(str, folder.getAllFiles().mkString("\n").split("\n")) if f.endswith(".data")}
    before = files()
    found = near_duplicate_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    for _ in range(50):  # Spark removes them in the background
        # Sums that come to the driver, a row each, are no tables that are written.
        if not (left := [f for f in files() - before if os.path.exists(f) and os.path.getsize(f) > 1000]):
            break
        time.sleep(0.2)
    assert not left
    assert {r.component_doc for r in found.where("line = 0").collect()} == {40}


@pytest.mark.parametrize("settings", [{}, {"block_bytes": 16, "hash_bits": 8}])
def test_exact(docs, empty, settings):
    folded = {k: re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for k, t in corpus().items()}
    got = {r.doc_id: tuple(r)[1:] for r in exact_duplicates(docs, **settings).collect()}
    for k, t in folded.items():
        same = [j for j in folded if folded[j] == t]
        assert got[k] == (min(same), len(same), min(same) == k, hashlib.sha256(t.encode()).hexdigest())
    assert exact_duplicates(empty).count() == 0


@pytest.mark.parametrize("settings", [{}, {"window": 9, "shard_runs": 1}])
def test_substring(docs, empty, settings):
    window, seen, want = settings.get("window", 20), set(), {}
    for k, t in sorted(corpus().items()):
        words = WORDS.findall(t or "")
        gone = set()
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            if key in seen:
                gone.update(range(i, i + window))
            seen.add(key)
        kept = [w for i, w in enumerate(words) if i not in gone]
        want[k] = (len(words), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest(), kept)
    out = remove_repeats(docs, with_text=True, **settings).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in out} == {k: v[:3] for k, v in want.items()}
    for r in out:
        assert (r.kept_text is None) == (r.n_removed == 0)
        assert r.kept_text is None or WORDS.findall(r.kept_text) == want[r.doc_id][3]
    assert remove_repeats(empty).count() == 0


def test_suffix_automaton():
    rng = random.Random(2)
    for _ in range(100):
        automaton, known = SuffixAutomaton(), []
        for _ in range(4):
            words = [rng.choice("ab") for _ in range(rng.randint(0, 12))]
            for end, n in enumerate(automaton.matching(words), 1):
                def there(m, end=end, words=words):
                    return m <= end and (not m or any("".join(words[end - m : end]) in k for k in known))
                assert there(n) and not there(n + 1)
            automaton.add(words)
            known.append("".join(words))


def test_bpe(spark, docs, empty):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS.removeprefix("file://"), "rb"))}
    assert load_ranks(spark, RANKS) == ranks
    known = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in encode_documents(docs, RANKS, public.PATTERN).collect():
        text = corpus()[r.doc_id] or ""
        ids = known.encode_ordinary(text)
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert encode_documents(empty, RANKS, public.PATTERN).count() == 0
    bpe = Bpe(ranks, public.PATTERN)
    bpe.__setstate__(bpe.__getstate__())
    assert None not in bpe.whole.keys and bpe.whole.get(b"no such token") == -1
    rng = random.Random(3)
    pieces = [" ", "  ", "\n", "\t", " \n", "\x1c", "\x85", "'s", "I", "don't", "été", "日本", "½", "123", "...", "🙂", "́"]
    for _ in range(3000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 9)))
        assert bpe.encode(text).tolist() == known.encode_ordinary(text)


def test_bpe_pieces_carry_digests(spark):
    """What is remembered of a piece is its ids as decimals and what they decode to: nothing is made again for each text."""
    bpe = pickle.loads(pickle.dumps(Bpe(load_ranks(spark, RANKS), public.PATTERN)))
    for text in ("", " ", "a", " a", "a ", "  a  b", "one two\n three  four", "\u00e9t\u00e9 \U0001f600 x" * 3):
        for _ in range(2):
            ids, pieces = bpe.encode(text).tolist(), bpe.pieces(text)
            assert sum(p[0] for p in pieces) == len(ids)
            assert ",".join(p[1] for p in pieces) == ",".join(map(str, ids))
            assert b"".join(p[2] for p in pieces) == bpe.decode(ids) == text.encode()


def test_bpe_looks_up_the_pieces_of_a_batch_once(spark):
    bpe = pickle.loads(pickle.dumps(Bpe(load_ranks(spark, RANKS), public.PATTERN)))
    spaces = [chr(c) for c in range(0x3100) if chr(c).isspace()]
    texts = ["one two two", " two\nthree two ", "", None, " ", "  two", "two\u00a0three", *(f"a {s}b{s} c" for s in spaces)]
    for _ in range(2):
        for text, (n, decimals, decoded, raw) in zip(texts, bpe.joined(pa.array(texts)), strict=True):
            ids = bpe.encode(text or "").tolist()
            assert (n, bytes(decimals).decode()) == (len(ids), ",".join(map(str, ids)))
            assert bytes(decoded) == (text or "").encode() and np.frombuffer(raw, dtype="<u4").tolist() == ids
    assert list(bpe.joined(pa.array([], pa.string()))) == []
    met, after_space = [], bpe.after_space
    bpe.young, bpe.after_space = {}, lambda part: (met.append(part), after_space(part))[1]
    list(bpe.joined(pa.array(["x new words new words", "y words and new words"])))
    assert sorted(met) == ["and", "new", "words"]


def test_best_fit_plan():
    rng = random.Random(1)
    for _ in range(150):
        capacity = rng.randint(1, 40)
        histogram = {rng.randint(1, capacity): rng.randint(1, 30) for _ in range(rng.randint(0, 12))}
        rooms = []
        for length in sorted(histogram, reverse=True):
            for _ in range(histogram[length]):
                fits = [i for i, room in enumerate(rooms) if room >= length]
                if not fits:
                    rooms.append(capacity)
                    fits = [len(rooms) - 1]
                rooms[min(fits, key=rooms.__getitem__)] -= length
        filled = {}
        for length, a, b, first, offset in best_fit_plan(histogram, capacity):
            for s in range(first, first + b - a):
                filled.setdefault(s, []).append((offset, length))
        for parts in filled.values():
            assert all(o + n == after for (o, n), (after, _) in pairwise(sorted(parts)))
        assert sorted(capacity - sum(n for _, n in p) for p in filled.values()) == sorted(rooms)


def test_packing(docs, empty):
    path = public.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    rows = pack_documents(docs, "file://" + path, capacity=512).collect()
    for k, t in corpus().items():
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4")
        mine = sorted((r.piece, r.start, r.length, r.ids_crc32) for r in rows if r.doc_id == k)
        cuts = range(0, len(ids), 512)
        assert mine == [(i, s, len(ids[s : s + 512]), zlib.crc32(ids[s : s + 512].tobytes())) for i, s in enumerate(cuts)]
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        parts.sort()
        assert parts[0][0] == 0 and all(o + n == after for (o, n), (after, _) in pairwise(parts))
        assert sum(parts[-1]) <= 512
    assert pack_documents(empty, "file://" + path).count() == 0


def test_sharding(docs, empty):
    rows = shard_rows(docs, shards=7).collect()
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == {
        k: (len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for k, t in corpus().items()
    }
    slots = {s: sorted(r.slot for r in rows if r.shard == s) for s in range(7)}
    assert all(v == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert shard_rows(empty).count() == 0
    matrix = communication_matrix([10, 0, 25, 7], 5, seed=3)
    assert matrix.sum(axis=1).tolist() == [10, 0, 25, 7] and sorted(matrix.sum(axis=0)) == [8, 8, 8, 9, 9]
    means = np.mean([communication_matrix([10, 30], 4, seed=s)[0] for s in range(2000)], axis=0)
    assert abs(means - 2.5).max() < 0.15


def exact_neighbours(vectors, step, k):
    ids = np.array(sorted(vectors))
    x = np.array([vectors[i] for i in ids], dtype=np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for q in np.flatnonzero(ids % step == 0):
        cosine = x @ x[q]
        order = [j for j in np.lexsort((ids, -np.round(cosine, 13))) if j != q][:k]
        out |= {(int(ids[q]), r): (int(ids[j]), cosine[j]) for r, j in enumerate(order, 1)}
    return out


def test_neighbours(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 64))
    vectors = [(centres[i % 6] + rng.normal(size=64) * 0.7).astype(np.float32).tolist() for i in range(1500)]
    rows = [(i, v, 1, "x") for i, v in enumerate(vectors)]
    rows += [(2000 + i, vectors[50], 1, "x") for i in range(40)] + [(2000, vectors[50], 2, "y")]
    bad = [None, [0.0] * 64, [float("nan")] * 64, [float("inf"), *[1.0] * 63], [None, *[1.0] * 63], [1.0] * 3]
    rows += [(3000 + 50 * i, v, 1, "x") for i, v in enumerate(bad)] + [(None, vectors[0], 1, "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int, query string").repartition(4)
    out = nearest(df, df.where("vec_id % 50 = 0"), visits=600)
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in out.collect()}
    want = exact_neighbours({i: v for i, v, *_ in rows[:1541]}, 50, 5)
    assert {q for q, _ in got} == {q for q, _ in want} and len(got) == len(want)
    hits = sum(abs(got[k][1] - want[k][1]) < 1e-12 for k in want)
    assert hits >= 0.9 * len(want)
    assert [got[50, r][0] for r in range(1, 6)] == [2000, 2001, 2002, 2003, 2004]
    few = spark.createDataFrame(rows[:3], df.schema)
    assert {r.vec_id for r in nearest(few, few.where("vec_id = 0")).collect()} == {1, 2}
    assert nearest(df.where("false"), df.where("false")).count() == 0


@pytest.mark.parametrize(("spread", "probe_cost", "probed"), [(1e9, 100, False), (0.6, 0, True)])
def test_neighbours_look_as_far_as_recall_needs(spark, monkeypatch, spread, probe_cost, probed):
    """Few visits at the start, without and with near vectors: the rest is raised by measuring."""
    monkeypatch.setattr(neighbours, "PROBE_COST", probe_cost)
    taken, far_enough = [], neighbours._far_enough
    monkeypatch.setattr(neighbours, "_far_enough", lambda *a: taken.append(far_enough(*a)) or taken[-1])
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(60, 64))
    vectors = {i: (centres[i % 60] + rng.normal(size=64) * spread).tolist() for i in range(4000)}
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>").repartition(3)
    got = {(r.query_id, r["rank"]): r.vec_id for r in nearest(df, df.where("vec_id % 20 = 0"), visits=64).collect()}
    want = exact_neighbours(vectors, 20, 5)
    per_query = {(q, i) for (q, _), (i, _) in want.items()} & {(q, i) for (q, _), i in got.items()}
    assert len(got) == len(want) and len(per_query) >= 0.98 * len(want)
    assert taken[0] > 64 // 16 if probed else taken[0] is None


def test_forward_backward():
    rng = np.random.default_rng(2)
    first, score, move = np.array([0, 1, 4, 6]), rng.normal(size=6), rng.normal(size=(2, 2))
    total, good, moved = forward_backward(score, move, first)
    all_moves = np.zeros((2, 2))
    for i, (a, b) in enumerate(pairwise(first)):
        n = b - a
        paths = [[p >> t & 1 for t in range(n)] for p in range(2**n)]
        w = np.array([np.exp(sum(score[a + t] * y for t, y in enumerate(p)) + sum(move[x, y] for x, y in pairwise(p))) for p in paths])
        assert np.isclose(total[i], np.log(w.sum()))
        for t in range(n):
            assert np.isclose(good[a + t], sum(x for x, p in zip(w, paths, strict=True) if p[t]) / w.sum())
        for x, p in zip(w, paths, strict=True):
            for move_ in pairwise(p):
                all_moves[move_] += x / w.sum()
    assert np.allclose(moved, all_moves)


def test_quality(spark, docs):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = fit_quality(table, labels)
    assert isinstance(model, Crf)
    out = score_quality(table, model).join(labels, "doc_id").where("held_out").select("quality", "predicted").collect()
    assert sum(r.quality == r.predicted for r in out) >= 0.95 * len(out)
    rows = score_quality(docs.withColumn("score", F.lit("x")), model).collect()
    assert len(rows) == len(corpus()) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert fit_quality(table, labels.where("quality = 1")) is None
    assert {r.score for r in score_quality(docs, None).collect()} == {0.5}
    assert score_quality(docs.where("false"), model).count() == 0


def test_licences(spark, empty):
    texts = {
        1: "Some words.\nReleased under the MIT License.\nMore",
        2: "Redistributions of source code must retain the above copyright notice, this list of\nconditions and the "
        "following disclaimer.\nRedistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        3: None,
        4: "",
        5: "licensed under the APACHE Licence, version 2.0. All rights reserved.",
        6: "Unlicensed under the Apache License, Version 2.0.",
    }
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("licences", F.lit(1))
    got = {r.doc_id: (r.n_found, r.sentence_ids, r.licences) for r in recognise_licences(rows).collect()}
    assert got == {
        1: (1, "mit-line", "MIT"),
        2: (1, "bsd-binary", "BSD-2-Clause"),
        3: (0, "", ""),
        4: (0, "", ""),
        5: (2, "apache2-line reserved", "Apache-2.0 LicenseRef-All-Rights-Reserved"),
        6: (0, "", ""),
    }
    assert recognise_licences(empty).count() == 0


def test_licence_anchors(spark):
    """Texts without a word of a known sentence take no regex; any spelling, cut or sentence of the caller's still counts."""
    known = licences.SENTENCES | {"dots": "..."}
    assert licences.anchors({"x": "Of the Licence.", "y": "A licenCed work."}) == ["licen"]
    for key, sentence in licences.SENTENCES.items():
        words = licences.normalised_sentence(sentence).replace("license", "licence").split()
        for form in (sentence.upper(), "\n".join(words), "\u00e9".join(words)):
            assert any(a in form.lower() for a in licences.anchors(licences.SENTENCES)), key
    rows = spark.createDataFrame([(1, "x ... y"), (2, "RELEASED UNDER THE MIT LICENCE.\u00a0"), (3, "plain")], "doc_id long, text string")
    own = recognise_licences(rows, known, [("MIT", ["mit-line"])])
    assert {r.doc_id: r.n_found for r in own.collect()} == {1: 0, 2: 1, 3: 0}
    blank = spark.createDataFrame([(1, "x\n...\ny"), (2, None)], "doc_id long, text string")
    assert {r.doc_id: r.n_found for r in recognise_licences(blank, known).collect()} == {1: 1, 2: 1}

    # What is cut reads the text column of the filter, not that of the table.
    plan = plan_of(recognise_licences(rows))
    assert plan.count("Contains(") == len(licences.anchors(licences.SENTENCES))


def test_licence_files(spark):
    """Whole standard files with copyright lines: wrapped, one line per paragraph, as comments, with bullets."""

    def paragraphs(text, width=72, before="", first=""):
        return "\n\n".join(textwrap.fill(p, width, initial_indent=first, subsequent_indent=before) for p in text)

    sentence = licences.SENTENCES
    grant, notice = sentence["mit-grant"].split(": ")
    mit = ["MIT License", "Copyright (c) 2020 Jane Doe", grant + ":", notice, "THE SOFTWARE IS PROVIDED \"AS IS\""]
    gpl = ["a program", "Copyright (C) 2020 Jane Doe", sentence["gpl-free"], "This program is distributed in the hope"]
    gpl2 = [*gpl[:2], sentence["gpl2-free"]]
    isc = ["ISC License", "Copyright 2020 Jane Doe", sentence["isc-grant"]]
    terms, *items = (sentence[f"bsd-{x}"] for x in ("terms", "source", "binary", "name"))

    def bsd(mark, n):
        made = [textwrap.fill(t, 72, initial_indent=mark(i), subsequent_indent="   ") for i, t in enumerate(items[:n], 1)]
        return "Copyright (c) 2020, Jane Doe\n\n" + textwrap.fill(terms, 72) + "\n" + "\n".join(made)

    texts = {}
    for name, text in (("MIT", mit), ("GPL-3.0-or-later", gpl), ("GPL-2.0-or-later", gpl2), ("ISC", isc)):
        wrapped = paragraphs(text)
        comment = "/*\n" + "\n".join(" * " + x if x else " *" for x in wrapped.split("\n")) + "\n */"
        dense = "\n".join("# " + x for x in wrapped.split("\n") if x).replace("# MIT License\n", "").replace("# ISC License\n", "")
        for form in (wrapped, paragraphs(text, 10**6), wrapped.replace("\n", "\r\n"), comment, dense.partition("# THE")[0]):
            texts[form] = name
    for mark in (lambda i: "* ", lambda i: "- ", lambda i: f"{i}. ", lambda i: f"({i}) ", lambda i: f"{i}) ", lambda i: f"{'abc'[i - 1]}) "):
        texts[bsd(mark, 3)], texts[bsd(mark, 2)] = "BSD-3-Clause", "BSD-2-Clause"
    texts |= {"Copyright (c) 2020 Jane Doe\n\n" + grant + ":": "", "a b\n\nc: d": "", sentence["mpl2"]: "MPL-2.0"}
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.licences for r in recognise_licences(rows).collect()}
    assert {t: got[i] for i, t in enumerate(texts)} == texts


def test_word_encoder_is_the_tokenizer():
    """Odd characters, contractions and markers, word by word, against the tokenizer over whole texts."""
    definition = open(public.path("word_bpe_49k.json")).read()
    encoder = pickle.loads(pickle.dumps(WordEncoder(definition)))
    assert encoder.model is not None
    letters = "abzAZéÉßÿ×÷Àþ'stdmrevl0189,.!-_~|<>#́µªİΣσ漢  \t\n \x85\x1c\x00\x7f²½🙂"
    rng = random.Random(4)
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 40))) for _ in range(3000)]
    texts += ["", " ", "It's <|endoftext|> WE'LL <|startoftext|>b", "x" * 5000, "don't,'s''re 'd"]
    for text, ids in zip(texts, encoder.encode(t.encode() for t in texts), strict=True):
        assert ids.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_word_encoder_leaves_no_parsed_rules_in_a_worker(monkeypatch):
    """The rules are parsed on the driver; each task gives freed memory back before it begins and when it ends."""
    data = pickle.dumps(WordEncoder(open(public.path("word_bpe_49k.json")).read()))
    monkeypatch.setattr(packing.json, "loads", None)
    encoder = pickle.loads(data)
    assert encoder.model is not None and encoder.added.search("a<|endoftext|>")
    times = []
    monkeypatch.setattr(words, "release", lambda: times.append(1))
    parts = words.small(iter([pa.record_batch({"x": [1, 2, 3]})]), 2)
    assert next(parts).num_rows == 2 and len(times) == 1
    assert [p.num_rows for p in parts] == [1] and len(times) == 2


def test_word_encoder_remembers_so_many_bytes_however_long_the_words(monkeypatch):
    monkeypatch.setattr(packing, "MEMO_BYTES", 100_000)
    encoder = pickle.loads(pickle.dumps(WordEncoder(open(public.path("word_bpe_49k.json")).read())))
    untouched = Tokenizer.from_file(public.path("word_bpe_49k.json"))
    rng = random.Random(8)
    text = lambda i: " ".join("".join(rng.choices("abcé漢1-", k=rng.choice([3, 2000]))) for _ in range(8)) if i % 3 else "a bc"
    texts = [text(i) for i in range(150)]
    largest = 0
    for t, ids in zip(texts, encoder.encode(t.encode() for t in texts), strict=True):
        assert ids.tolist() == untouched.encode(t, add_special_tokens=False).ids
        for memo in (encoder.young, encoder.old, encoder.young_parts, encoder.old_parts):
            largest = max(largest, sum(len(k) + len(v) for k, v in memo.items()))
    assert 50_000 < largest < 250_000  # and what one text brings


def test_word_encoder_takes_added_tokens_as_the_untouched_tokenizer():
    untouched = Tokenizer.from_file(public.path("word_bpe_49k.json"))
    encoder = pickle.loads(pickle.dumps(WordEncoder(open(public.path("word_bpe_49k.json")).read())))
    pieces = ["a", "É", "It's", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext|", ">", "<", " ", "\n", "e\u0301", "漢"]
    rng = random.Random(6)
    texts = ["a <|endoftext|> b", "a<|endoftext|>b <|startoftext|><|endoftext|>"]
    texts += ["".join(rng.choices(pieces, k=rng.randint(1, 12))) for _ in range(2000)]
    want = [untouched.encode(t, add_special_tokens=False).ids for t in texts]
    assert want[0] == [320, 49407, 321]
    assert [ids.tolist() for ids in encoder.encode(t.encode() for t in texts)] == want
