"""Re-Pair grammars of many sequences at a time.

Re-Pair replaces the most frequent pair of neighbouring symbols of a sequence by
a new symbol (a rule), until no pair occurs twice without overlap. Here many
pairs are replaced in a round: a pair goes as soon as no pair beside one of its
places is more frequent (ties: by a hash of the pair). This is the order of
counts still: two places that have the same pair later have the same pair now,
so the pairs beside it only get rarer, and those elsewhere do not touch it.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np


class Grammar(NamedTuple):
    """Rules and the places where they were made, in the sequences as they lie one after the other.

    Rule r is the symbol ``first_rule + r`` and stands for ``left[r]``,
    ``right[r]``. Place k, of rule ``rule[k]`` (ascending, then by place), reaches
    from ``start[k]`` to ``end[k]``, its second symbol begins at ``split[k]``.
    ``rest`` are the boundaries between words that no rule spans.
    """

    first_rule: int
    left: np.ndarray
    right: np.ndarray
    rule: np.ndarray
    start: np.ndarray
    split: np.ndarray
    end: np.ndarray
    rest: np.ndarray


def repair(x: np.ndarray, bounds: np.ndarray) -> Grammar:
    """The grammar of each sequence ``x[bounds[k]:bounds[k + 1]]``; their ids count from 0, and no two share one."""
    n = len(x)
    symbol, end = x.astype(np.int64), np.arange(1, n + 1)
    before = np.arange(-1, n)  # of each boundary: where the symbol before it begins
    inner = np.ones(n, dtype=bool)
    inner[bounds[bounds < n]] = False
    rest = inner.copy()
    twice = np.bincount(x)[x] > 1 if n else inner
    inner[1:] &= twice[1:] & twice[:-1]
    live = np.flatnonzero(inner)  # boundaries whose pair may occur again
    first_rule = symbols = int(x.max()) + 1 if n else 0
    touched = np.zeros(n + 1, dtype=bool)
    made: list[tuple[np.ndarray, ...]] = []

    def pairs_of(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs at boundaries, numbered, and a hash of each."""
        keys, pair = np.unique(symbol[before[at]] * (first_rule + n) + symbol[at], return_inverse=True)
        return pair, keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)

    pair, tie = pairs_of(live)
    while len(live):
        # In a a a a only every other place counts.
        at = np.arange(len(live))
        alone = at.copy()
        alone[1:][(before[live[1:]] == live[:-1]) & (pair[1:] == pair[:-1])] = 0
        counts = (at - np.maximum.accumulate(alone)) % 2 == 0
        count = np.bincount(pair[counts], minlength=len(tie))
        stays = count[pair] > 1
        live, pair, counts = live[stays], pair[stays], counts[stays]
        beside = np.flatnonzero((before[live[1:]] == live[:-1]) & (pair[1:] != pair[:-1]))
        a, b = pair[beside], pair[beside + 1]
        waits = count < 2
        waits[np.where((count[a] < count[b]) | (count[a] == count[b]) & (tie[a] < tie[b]), a, b)] = True
        number = symbols + np.cumsum(~waits) - 1
        now = ~waits[pair] & counts
        split, new = live[now], number[pair[now]]
        start, after = before[split], end[split]
        made.append((new - first_rule, start, split, after, symbol[start], symbol[split]))
        symbol[start], end[start] = new, after
        before[after] = start
        rest[split] = False
        symbols += int((~waits).sum())
        # Only pairs with a new symbol are new.
        live, pair = live[~now], pair[~now]
        touched[start] = touched[after] = True
        changed = touched[live]
        touched[start] = touched[after] = False
        pair_new, tie_new = pairs_of(live[changed])
        pair[changed] = len(tie) + pair_new
        tie = np.concatenate([tie, tie_new])
        used = np.bincount(pair, minlength=len(tie)) > 0
        pair, tie = (np.cumsum(used) - 1)[pair], tie[used]
    rule, start, split, stop, left, right = (np.concatenate(c) for c in zip(*made, strict=True)) if made else np.zeros((6, 0), dtype=np.int64)
    order = np.argsort(rule, kind="stable")
    first = order[np.searchsorted(rule[order], np.arange(symbols - first_rule))]
    return Grammar(first_rule, left[first], right[first], rule[order], start[order], split[order], stop[order], np.flatnonzero(rest))
