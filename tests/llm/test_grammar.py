"""Re-Pair grammars against the sequential method, and runs found by them against the definition."""

import random
from collections import Counter

import numpy as np


def sequences(seed, n):
    """Random sequences with units that repeat, some of them repeated as a whole."""
    rng, out = random.Random(seed), [[], [0], [0, 0]]
    while len(out) < n:
        x = []
        for _ in range(rng.randint(0, 4)):
            x += [rng.randrange(3) for _ in range(rng.randint(0, 9))]
            x += [rng.randrange(2) for _ in range(rng.randint(1, 6))] * rng.randint(1, 7)
        out.append((x * rng.randint(1, 3))[:120])
    return out


def together(seqs):
    """The sequences one after the other with ids of their own, and their bounds."""
    ids, x, bounds = {}, [], [0]
    for k, seq in enumerate(seqs):
        x += [ids.setdefault((k, w), len(ids)) for w in seq]
        bounds.append(len(x))
    return np.array(x, dtype=np.int64), np.array(bounds)


def pair_counts(seq):
    counts, last = Counter(), {}
    for i, p in enumerate(zip(seq, seq[1:])):
        if p[0] == p[1] and last.get(p) == i - 1:
            last[p] = None
            continue
        last[p] = i
        counts[p] += 1
    return counts


def brute_runs(x):
    n, out = len(x), set()
    for q in range(1, n + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and x[j] == x[j + q]:
                j += 1
            seg = x[i : j + q]
            if len(seg) >= max(6, 4 * q) and not any(seg[d:] == seg[:-d] for d in range(1, q)):
                out.add((i, len(seg), q))
            i = j + 1
    return sorted(out)


def test_grammar_is_that_of_re_pair():
    from gleanery.llm.grammar import repair

    for x in sequences(1, 250):
        x, bounds = together([x])
        g = repair(x, bounds)
        used, seq = np.bincount(g.rule, minlength=len(g.left)), x.tolist()
        # One pair after the other, the most frequent first.
        for r in sorted(range(len(g.left)), key=lambda r: (-used[r], r)):
            counts, pair = pair_counts(seq), (int(g.left[r]), int(g.right[r]))
            assert counts[pair] == used[r] == max(counts.values())
            out = []
            while seq:
                rule = tuple(seq[:2]) == pair
                out.append(g.first_rule + r if rule else seq[0])
                del seq[: 1 + rule]
            seq = out
        assert max(pair_counts(seq).values(), default=0) < 2
        assert len(g.rest) == max(0, len(seq) - 1)


def test_grammars_of_many_documents_hold_one_each():
    from gleanery.llm.grammar import repair

    x, bounds = together(sequences(2, 120))
    g = repair(x, bounds)
    doc = np.searchsorted(bounds, g.start, side="right")
    assert (doc == np.searchsorted(bounds, g.end - 1, side="right")).all()
    spelled = [(w,) for w in range(g.first_rule)]
    for left, right in zip(g.left, g.right, strict=True):
        spelled.append(spelled[left] + spelled[right])
    at, last = Counter(), {}
    for r, d, s, t, e in zip(g.rule.tolist(), doc.tolist(), g.start.tolist(), g.split.tolist(), g.end.tolist(), strict=True):
        assert tuple(x[s:e].tolist()) == spelled[g.first_rule + r] and tuple(x[s:t].tolist()) == spelled[g.left[r]]
        assert last.setdefault(r, d) == d
        at[r] += 1
    assert len(at) == len(g.left) > 500 and min(at.values()) > 1


def test_runs_of_many_documents_against_the_definition():
    from gleanery.llm.periodic import runs, runs_of

    seqs = sequences(3, 500)
    x, bounds = together(seqs)
    start, length, period = runs_of(x, bounds)
    got = {k: [] for k in range(len(seqs))}
    for s, n, q in zip(start.tolist(), length.tolist(), period.tolist(), strict=True):
        k = int(np.searchsorted(bounds, s, side="right")) - 1
        got[k].append((s - int(bounds[k]), n, q))
    want = [brute_runs(seq) for seq in seqs]
    assert list(got.values()) == want and sum(map(len, want)) > 500
    assert [runs(np.array(seq, dtype=np.int64)) for seq in seqs] == want


def test_a_run_in_a_rule_is_looked_for_once_and_moved(monkeypatch):
    from gleanery.llm import periodic

    searched = []
    crossing = periodic._Grams.crossing

    def spy(self, low, b, high):
        found = crossing(self, low, b, high)
        searched.append((len(b), len(found[0])))
        return found

    monkeypatch.setattr(periodic._Grams, "crossing", spy)
    # "0 1 0 1 0 1 0 1 0 1" between words that stand alone, at 100 places.
    x = np.array([w for k in range(100) for w in [0, 1] * 5 + [10 + k]])
    assert periodic.runs(x) == [(11 * k, 10, 2) for k in range(100)]
    (rest, _), (rules, found) = searched
    assert rest == 0 and rules <= 3 and found <= 3


def test_a_rule_that_ends_in_a_run_goes_on_beside_it():
    from gleanery.llm.periodic import runs

    # The same passage, followed by more of its last run at one place and by something else at the other.
    unit = [5, 6, 7] + [8, 9] * 4
    x = unit + [1] + unit + [8, 9, 8] + [2] + unit + [3]
    assert runs(np.array(x)) == brute_runs(x) == [(3, 8, 2), (15, 11, 2), (30, 8, 2)]


def test_long_texts_of_few_words():
    from gleanery.llm.periodic import runs

    n = 300_000  # words apart at every period are equal: a search per period would look at all of them each time
    assert runs(np.zeros(n, dtype=np.int64)) == [(0, n, 1)]
    assert runs(np.tile(np.arange(700), 300)) == [(0, 210_000, 700)]
    a, b = [0], [0, 1]
    while len(b) < 100_000:
        a, b = b, b + a
    assert runs(np.array(b)) == []  # the Fibonacci word has no fourth power


def test_words_are_those_of_the_contract(spark):
    import hashlib

    from gleanery.llm.periodic import WORDS, periodic_runs

    text = "a\x1cb\x1fc \x85d\xa0e f g\x0bh\x0ci\r\nj\x00k é\tü "
    texts = [text, text * 700, " ".join(["x y"] * 4), "z"] + ["w " * 3000 + str(k) for k in range(60)]
    docs = spark.createDataFrame([(1, t) for t in texts], "doc_id long, text string").coalesce(1)
    got = Counter((r.n_runs, r.start, r.length, r.period, r.collapsed_sha256) for r in periodic_runs(docs).collect())

    def sha(words):
        return hashlib.sha256(" ".join(words).encode()).hexdigest()

    unit = WORDS.findall(text)
    want = Counter([(0, None, None, None, sha(unit)), (0, None, None, None, sha(["z"])), (1, 0, 8, 2, sha(["x", "y"]))])
    want.update((1, 0, 3000, 1, sha(["w", str(k)])) for k in range(60))
    want[(1, 0, 700 * len(unit), len(unit), sha(unit))] += 1
    assert got == want
