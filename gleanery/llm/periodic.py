"""Periodic runs of words: maximal stretches with a small period, and the text without their repeats.

A *run* is a stretch of words whose smallest period q (words q apart are
equal) repeats at least four times (length >= max(6, 4q)) and that no
neighbouring word extends with the same period. The words of a document become
a Re-Pair grammar (``grammar.py``). A run lies whole in a smallest rule, or in
none; there it crosses the boundary between the rule's two symbols, or one
that no rule spans. So runs are looked for across the boundary of each rule
once, moved to all of the rule's places, and kept where no word beside them
extends them; then across the boundaries that are left. A stretch found again
at a larger period is the same run (its smallest period divides the larger
one), so each run is kept once, at its smallest period.

Documents are independent: they are dealt to Python workers in Arrow batches
as they lie, and nothing is shuffled. A grammar holds one document; those of
many documents are built together, array by array.
"""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gleanery.session import prepare

from .grammar import repair
from .words import small

# Fixed value of the contract: words are runs of anything but ASCII white space
# (``bytes.split`` cuts UTF-8 at the same places).
WORDS = re.compile(r"[^\x20\x09-\x0D]+")

# Documents are taken together up to about so many words (a longer one is taken alone),
# and so many pairs of places are compared at a time.
TOGETHER = 1 << 17
CANDIDATES = 1 << 18

OUTPUT = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)


def planted(words: list, doc_id: int | None) -> list:
    """The contract's repeated tail: for crc32(decimal id) % 10 == 0, words from a on repeat with period p."""
    n = len(words)
    if doc_id is None or n == 0:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


class _Grams:
    """Names of all grams of 1, 2, 4, ... words that occur twice in a sequence: equal grams, and only these, share a name."""

    def __init__(self, x: np.ndarray, end: np.ndarray):
        """``end`` holds for each place where its sequence ends; no two sequences share an id."""
        n = self.n = len(x)
        kind = np.int32 if n < 2**31 - 1 else np.int64
        alone = -1 - np.arange(n + 1, dtype=kind)  # grams without a second place, and one place past the end
        self.names, self.places = [np.append(x.astype(kind), alone[-1:])], [np.zeros(0, dtype=kind)]
        again = np.bincount(x)[x] > 1 if n else x > 0
        live = np.flatnonzero(again)
        while len(live):
            half, names = 1 << len(self.names) - 1, self.names[-1]
            live = live[live + 2 * half <= end[live]]
            live = live[again[live + half]]
            key = names[live].astype(np.int64) * (n + 1) + names[live + half]
            order = np.argsort(key, kind="stable")
            key, place = key[order], live[order]
            first = np.append(True, key[1:] != key[:-1])[: len(key)]
            group = np.cumsum(first) - 1
            twice = np.bincount(group)[group] > 1 if len(group) else first
            group, place = group[twice], place[twice]
            if not len(place):
                return
            names = alone.copy()
            names[place] = group
            self.names.append(names)
            self.places.append(place.astype(kind))  # by name, then by place
            again = names >= 0
            live = np.flatnonzero(again)

    def forward(self, c: np.ndarray, q: np.ndarray) -> np.ndarray:
        """How many words from c on equal those from c + q on."""
        off = np.zeros(len(c), dtype=np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            off += (self.names[k][c + off] == self.names[k][c + q + off]).astype(np.int64) << k
        return off

    def backward(self, c: np.ndarray, q: np.ndarray) -> np.ndarray:
        """How many words before c equal those before c + q."""
        off = np.zeros(len(c), dtype=np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            at = c - off - (1 << k)
            out = at < 0
            off += (self.names[k][np.where(out, self.n, at)] == self.names[k][np.where(out, 0, at + q)]).astype(np.int64) << k
        return off

    def crossing(self, low: np.ndarray, b: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
        """(query, start, end, period) of the runs of ``x[low:high]`` that hold both words beside the boundary b.

        A run of period q holds 2q words on one side of b, so for m = 2^k <= q < 2m
        the m words at b are the same q further on, or q before. Such places are
        looked up, and each stretch is measured by the names of its grams.
        """
        found = [np.zeros((4, 0), dtype=np.int64)]
        for k in range(1, len(self.names)):
            m, names, places = 1 << k, self.names[k], self.places[k].astype(np.int64)
            keys = names[places].astype(np.int64) * (self.n + 1) + places
            least, most = 1 if k == 1 else m, np.minimum(2 * m - 1, (high - low) // 4)
            for side in (1, -1):
                u = b - 1 if side > 0 else b - m + 1
                far = np.minimum(most, high - m - u if side > 0 else u - low)
                query = np.flatnonzero((far >= least) & (u >= low))
                query = query[names[u[query]] >= 0]
                if not len(query):
                    continue
                here = names[u[query]].astype(np.int64) * (self.n + 1) + u[query]
                near, far = here + side * least, here + side * far[query]
                first = np.searchsorted(keys, np.minimum(near, far))
                count = np.searchsorted(keys, np.maximum(near, far), side="right") - first
                some = count > 0
                query, first, count = query[some], first[some], count[some]
                # So many at a time that memory is bounded.
                part = np.cumsum(count) // CANDIDATES
                for at in np.split(np.arange(len(query)), np.flatnonzero(np.diff(part)) + 1):
                    of = np.repeat(at, count[at])
                    place = places[np.arange(len(of)) + np.repeat(first[at] - np.cumsum(count[at]) + count[at], count[at])]
                    i = query[of]
                    q = np.abs(place - u[i])
                    c = np.minimum(place, u[i])
                    start = c - np.minimum(self.backward(c, q), c - low[i])
                    end = c + q + np.minimum(self.forward(c, q), high[i] - c - q)
                    long = end - start >= np.maximum(6, 4 * q)
                    found.append(_smallest(np.stack([i, start, end, q])[:, long]))
        return tuple(_smallest(np.concatenate(found, axis=1)))


def _smallest(found: np.ndarray) -> np.ndarray:
    """Of rows (query, start, end, period) with the same stretch, the one with the smallest period."""
    found = found[:, np.lexsort(found[::-1])]
    first = np.ones(found.shape[1], dtype=bool)
    first[1:] = (found[:3, 1:] != found[:3, :-1]).any(axis=0)
    return found[:, first]


def runs_of(x: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """(start, length, period) in ``x`` of the runs of every sequence ``x[bounds[k]:bounds[k + 1]]``, by start.

    Ids count from 0, and no two sequences share one.
    """
    size = np.diff(bounds)
    first, last = np.repeat(bounds[:-1], size), np.repeat(bounds[1:], size)
    grams, grammar = _Grams(x, last), repair(x, bounds)
    # Runs that no rule holds whole cross a boundary of the rest; a pair of words that stands alone is in none.
    rest = grammar.rest[grams.names[1][grammar.rest - 1] >= 0] if len(grams.names) > 1 else grammar.rest[:0]
    _, start, end, period = grams.crossing(first[rest], rest, last[rest])
    # In each rule once, at its first place, then moved to all of its places.
    place = np.searchsorted(grammar.rule, np.arange(len(grammar.left) + 1))
    head = place[:-1][(grammar.end - grammar.start)[place[:-1]] >= 6]
    query, s, e, q = grams.crossing(grammar.start[head], grammar.split[head], grammar.end[head])
    rule = grammar.rule[head[query]]
    count = place[rule + 1] - place[rule]
    of = np.repeat(np.arange(len(rule)), count)
    to = grammar.start[np.arange(len(of)) + np.repeat(place[rule] - np.cumsum(count) + count, count)]
    move = to - grammar.start[head[query]][of]
    s, e, q = s[of] + move, e[of] + move, q[of]
    # A run that ends with its rule may go on beside it: then a larger rule or the rest has it.
    ends = (s == first[s]) | (x[s - 1] != x[s - 1 + q])
    ends &= (e == last[s]) | (x[np.minimum(e, len(x) - 1)] != x[e - q])
    whole = np.unique(np.concatenate([np.stack([start, end, period], axis=1), np.stack([s, e, q], axis=1)[ends]]), axis=0)
    return whole[:, 0], whole[:, 1] - whole[:, 0], whole[:, 2]


def runs(x: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of the id sequence ``x``, by start, then period."""
    x = np.unique(x, return_inverse=True)[1]
    return list(zip(*(c.tolist() for c in runs_of(x, np.array([0, len(x)]))), strict=True))


def _row(doc_id: int | None, words: list[bytes], found: list[tuple[int, int, int]]) -> tuple:
    if not found:
        return (doc_id, 0, None, None, None, None, hashlib.sha256().hexdigest(), hashlib.sha256(b" ".join(words)).hexdigest())
    drop = np.zeros(len(words) + 1, dtype=np.int64)
    for s, length, q in found:
        drop[s + q] += 1
        drop[s + length] -= 1
    kept = b" ".join(itertools.compress(words, np.cumsum(drop[:-1]) == 0))
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]))
    return (
        doc_id,
        len(found),
        *best,
        1000 * best[1] // best[2],
        hashlib.sha256(listed.encode()).hexdigest(),
        hashlib.sha256(kept).hexdigest(),
    )


def _rows(ids: list[int | None], docs: list[list[bytes]]) -> list[tuple]:
    """The output rows of documents given as words; their grammars are built together."""
    bounds = np.cumsum([0, *map(len, docs)])
    x = np.empty(bounds[-1], dtype=np.int64)
    next_id = itertools.count()
    for k, words in enumerate(docs):
        numbers = defaultdict(next_id.__next__)
        x[bounds[k] : bounds[k + 1]] = np.fromiter(map(numbers.__getitem__, words), dtype=np.int64, count=len(words))
    start, length, period = runs_of(x, bounds)
    cut = np.searchsorted(start, bounds)
    start -= np.repeat(bounds[:-1], np.diff(cut))
    found = list(zip(start.tolist(), length.tolist(), period.tolist(), strict=True))
    return [_row(i, words, found[cut[k] : cut[k + 1]]) for k, (i, words) in enumerate(zip(ids, docs, strict=True))]


def describe(doc_id: int | None, text: str | None) -> tuple:
    """One output row of ``periodic_runs`` for one document."""
    return _rows([doc_id], [planted((text or "").encode().split(), doc_id)])[0]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256.

    Words are runs of non-white-space (null text: none), numbered from 0, after
    the contract's planting (``planted``; a null id plants nothing). The longest
    run (ties: smallest start, then period) gives start, length, period and
    floor(1000 * length / period); without runs these four are null.
    runs_sha256 hashes every run's ``start,length,period`` and a line feed, by
    start, then period; collapsed_sha256 the words not dropped, joined by one
    space, where a word is dropped if a run holds it after its first period.
    Empty and null texts hash the empty string. Rows with null or repeated ids
    are described one by one; other columns are ignored. A text is held whole by
    one Python worker, about 200 bytes per word (400 where all words are the same).
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            rows: list[tuple] = []
            ids, docs, held = [], [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = planted((text or b"").split(), doc_id)
                if held and held + len(words) > TOGETHER:
                    rows += _rows(ids, docs)
                    ids, docs, held = [], [], 0
                ids.append(doc_id)
                docs.append(words)
                held += len(words)
            rows += _rows(ids, docs)
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 8
            out = pa.RecordBatch.from_arrays(
                [pa.array(c, type=pa.string() if k >= 6 else pa.int64()) for k, c in enumerate(columns)],
                names=["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
            )
            yield out

    source = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").cast("binary").alias("text"))
    return source.mapInArrow(run, OUTPUT)
