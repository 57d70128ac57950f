"""Repeated passages: suffix automata over reference shards give matching statistics; maximal spans go.

A window is a fixed number of consecutive words. Every window that starts with
the same words earlier (in a smaller document, or earlier in its own) is
repeated, and the words under repeated windows are removed.

1. *Anchors.* The window's word 8-gram of least hash is its anchor (the last of
   equals), so equal windows have equal anchors at the same place. Consecutive
   windows with one anchor form a run, of 32 words at most.
2. *Shards.* Only anchors that occur twice matter. Their runs are folded by
   content, so that thousands of copies are one row, and the distinct runs of an
   anchor are its reference shard: small, and independent of all others.
3. *Automata.* The runs of a shard are streamed in document order through the
   suffix automaton of the runs before; where the matching statistic reaches the
   window's length, the window is repeated. Then the run joins the automaton.

Automata go where the shard's runs are instead of being broadcast: broadcast,
every shard would have to be met by every document, which is quadratic in the
corpus. Shards of more than ``SHARD_RUNS`` distinct runs are compared window by
window in a grouped aggregate, which Spark spreads by content.

Runs are told apart by 128 bits of hashes (of the anchor and of all words), windows inside a shard by the words themselves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.session import Scratch, hint_if_small, prepare, stored

from .words import BASE, INVERSE, gram_hashes, mix, powers_of, small, text_slices, word_bounds, word_hashes

ANCHOR_WORDS = 8
# Distinct runs of one anchor that are taken into one automaton: at most 32 words each.
SHARD_RUNS = 4096


class SuffixAutomaton:
    """Of several sequences of words, extended one sequence at a time."""

    def __init__(self) -> None:
        self.next: list[dict[str, int]] = [{}]
        self.link = [-1]
        self.length = [0]

    def _state(self, length: int, link: int, edges: dict[str, int]) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, p: int, q: int, word: str) -> int:
        """The state of the longest sequence at ``p`` plus ``word``, parted from ``q`` if that is longer."""
        if self.length[q] == self.length[p] + 1:
            return q
        copy = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def add(self, words: list[str]) -> None:
        last = 0
        for word in words:
            q = self.next[last].get(word)
            if q is not None:
                last = self._split(last, q, word)
                continue
            new, p = self._state(self.length[last] + 1, 0, {}), last
            while p >= 0 and word not in self.next[p]:
                self.next[p][word] = new
                p = self.link[p]
            if p >= 0:
                self.link[new] = self._split(p, self.next[p][word], word)
            last = new

    def matching(self, words: list[str]) -> Iterator[int]:
        """For each word, how many words up to it occur together in a sequence added before."""
        state = matched = 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            state = self.next[state].get(word, 0)
            matched = matched + 1 if state else 0
            yield matched


def _runs(words: np.ndarray, first: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, anchor hash, content hash) of runs, for the words of several texts."""
    grams = gram_hashes(words, ANCHOR_WORDS)
    wide = window - ANCHOR_WORDS + 1
    none = np.zeros(0, dtype=np.int64)
    if len(grams) < wide:
        return none, none, none, none
    view = np.lib.stride_tricks.sliding_window_view(grams, wide)
    anchor = np.arange(len(view)) + wide - 1 - np.argmin(view[:, ::-1], axis=1)
    text = np.searchsorted(first, np.arange(len(view)), side="right") - 1
    inside = np.arange(len(view)) + window <= first[text + 1]
    new = np.ones(len(view), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    start = np.flatnonzero(new & inside)
    if not len(start):
        return none, none, none, none
    text, anchor = text[start], anchor[start]
    # A run ends before the next one starts, or with the last window of its text.
    stop = first[text + 1] - window + 1
    stop[:-1] = np.where(text[1:] == text[:-1], start[1:], stop[:-1])
    end = stop + window - 1
    sums = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(mix(words) * powers_of(BASE, len(words)), out=sums[1:])
    inverse = powers_of(INVERSE, len(words))
    content = mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))
    return text, start - first[text], grams[anchor].view(np.int64), content.view(np.int64)


def _anchors(df: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for batch in small(batches):
            n, starts, anchors, contents, digests, bodies = [], [], [], [], [], []
            for _, offsets, data in text_slices(batch.column("text")):
                begin, end, first = word_bounds(offsets, data)
                text, start, anchor, content = _runs(word_hashes(data, begin, end), first, window)
                cuts = np.searchsorted(text, np.arange(len(first)))
                raw = data.tobytes()
                for i in range(len(first) - 1):
                    a, b = cuts[i], cuts[i + 1]
                    body = raw[offsets[i] : offsets[i + 1]]
                    n.append(int(first[i + 1] - first[i]))
                    starts.append(start[a:b].astype(np.int32))
                    anchors.append(anchor[a:b])
                    contents.append(content[a:b])
                    digests.append(hashlib.sha256(b" ".join(body.split())).digest())
                    bodies.append(pack.compress(body))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("doc_id"),
                    pa.array(n, pa.int64()),
                    pa.array(starts, pa.list_(pa.int32())),
                    pa.array(anchors, pa.list_(pa.int64())),
                    pa.array(contents, pa.list_(pa.int64())),
                    pa.array(digests, pa.binary()),
                    pa.array(bodies, pa.binary()),
                ],
                names=["row", "doc_id", "n_words", "starts", "anchors", "contents", "digest", "body"],
            )

    id_type = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(
        run,
        f"row long, doc_id {id_type}, n_words long, starts array<int>, anchors array<long>, "
        "contents array<long>, digest binary, body binary",
    )


def _order() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("row"), F.col("start"))


def _with_bodies(tmp: Scratch, docs: DataFrame, lists: DataFrame) -> DataFrame:
    """``lists`` (row, items) with the bodies of their rows; other bodies stay where they are if the ids are few."""
    lists = tmp.store(lists)
    bodies = docs.select("row", "body").join(hint_if_small(lists.select("row")), "row", "left_semi")
    return bodies.join(lists, "row")


def _cut_runs(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """The words of the runs listed for each body."""
    unpack = zstandard.ZstdDecompressor()
    for batch in small(batches):
        row, anchor, content, start, n, text = [], [], [], [], [], []
        for r, body, items in zip(*(batch.column(c).to_pylist() for c in ("row", "body", "items")), strict=True):
            words = unpack.decompress(body).split() if body else []
            for item in items:
                row.append(r)
                anchor.append(item["anchor"])
                content.append(item["content"])
                start.append(item["start"])
                n.append(item["n"])
                text.append(b" ".join(words[item["start"] : item["start"] + item["n"] + window - 1]))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(row, pa.int64()),
                pa.array(anchor, pa.int64()),
                pa.array(content, pa.int64()),
                pa.array(start, pa.int32()),
                pa.array(n, pa.int32()),
                pa.array(text, pa.binary()),
            ],
            names=["row", "anchor", "content", "start", "n", "text"],
        )


def _match_shards(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Repeated windows, as bits, of runs that come sorted by anchor and document order."""
    shard, automaton = None, SuffixAutomaton()
    for batch in small(batches):
        anchors, contents = batch.column("anchor").to_pylist(), batch.column("content").to_pylist()
        masks = []
        for anchor, text in zip(anchors, batch.column("text").to_pylist(), strict=True):
            if anchor != shard:
                shard, automaton = anchor, SuffixAutomaton()
            words = text.split(b" ")
            mask = 0
            for i, matched in enumerate(automaton.matching(words)):
                if matched >= window:
                    mask |= 1 << (i - window + 1)
            masks.append(mask)
            automaton.add(words)
        yield pa.RecordBatch.from_arrays(
            [batch.column("anchor"), batch.column("content"), pa.array(masks, pa.int64())], names=["anchor", "content", "mask"]
        )


def _split_windows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in small(batches):
        at, bit, texts = [], [], []
        for i, text in enumerate(batch.column("text").to_pylist()):
            words = text.split(b" ")
            for k in range(len(words) - window + 1):
                at.append(i)
                bit.append(k)
                texts.append(b" ".join(words[k : k + window]))
        at = pa.array(at, pa.int64())
        columns = [batch.column(c).take(at) for c in ("anchor", "content", "first")]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(bit, pa.int32()), pa.array(texts, pa.binary())], names=["anchor", "content", "first", "bit", "text"]
        )


def _remove(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor()
    for batch in small(batches):
        removed, digests, texts = [], [], []
        for body, items in zip(batch.column("body").to_pylist(), batch.column("items").to_pylist(), strict=True):
            raw = unpack.decompress(body)
            data = np.frombuffer(raw, np.uint8)
            begin, end, _ = word_bounds(np.array([0, len(data)]), data)
            step = np.zeros(len(begin) + 1, dtype=np.int64)
            for item in items:
                for k in range(item["mask"].bit_length()):
                    if item["mask"] >> k & 1:
                        step[item["start"] + k] += 1
                        step[item["start"] + k + window] -= 1
            kept = np.cumsum(step)[:-1] == 0
            removed.append(int((~kept).sum()))
            words = [raw[a:b] for a, b in zip(begin[kept].tolist(), end[kept].tolist(), strict=True)]
            digests.append(hashlib.sha256(b" ".join(words)).digest())
            # What stays of the text: all but removed words and the white space after each.
            after = np.append(begin[1:], len(raw))
            edge = np.diff(np.concatenate([[True], kept, [True]]).astype(np.int8))
            gone = zip(begin[np.flatnonzero(edge == -1)].tolist(), after[np.flatnonzero(edge == 1) - 1].tolist(), strict=True)
            parts, at = [], 0
            for a, b in gone:
                parts.append(raw[at:a])
                at = b
            texts.append((b"".join(parts) + raw[at:]).decode())
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(removed, pa.int64()), pa.array(digests, pa.binary()), pa.array(texts, pa.string())],
            names=["row", "n_removed", "kept", "kept_text"],
        )


def remove_repeats(
    df: DataFrame,
    window: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_text: bool = False,
    shard_runs: int = SHARD_RUNS,
) -> DataFrame:
    """One row per row of ``df``: doc_id, n_words, n_removed, kept_sha256 and, if asked for, kept_text.

    Words are runs of bytes other than white space (0x20, 0x09-0x0D), unchanged.
    Windows are judged on the input. kept_sha256 is the hash of the kept words
    joined by one space; kept_text the text without removed words and the white
    space after each, or null where nothing was removed. Null and blank texts
    have no words. Ids may repeat or be null: rows are ordered by id, nulls
    last, then by place in the table. Windows must have from 9 to 60 words.
    Other columns are ignored.
    """
    spark = prepare(df.sparkSession)
    with Scratch(spark) as tmp:
        return stored(_remove_repeats(tmp, df, window, id_col, text_col, with_text, shard_runs))


def _remove_repeats(
    tmp: Scratch,
    df: DataFrame,
    window: int,
    id_col: str,
    text_col: str,
    with_text: bool,
    shard_runs: int,
) -> DataFrame:
    if not ANCHOR_WORDS < window <= 60:
        raise ValueError("window must have from 9 to 60 words")
    docs = tmp.store(_anchors(df, id_col, text_col, window))

    runs = docs.select(
        "row",
        "doc_id",
        "n_words",
        "starts",
        F.explode(F.arrays_zip(F.sequence(F.lit(1), F.size("starts")).alias("i"), "starts", "anchors", "contents")).alias("run"),
    ).where(F.size("starts") > 0)
    until = F.coalesce(F.get("starts", F.col("run.i")), (F.col("n_words") - window + 1).cast("int"))
    runs = runs.select(
        "row",
        "doc_id",
        F.col("run.starts").alias("start"),
        (until - F.col("run.starts")).alias("n"),
        F.col("run.anchors").alias("anchor"),
        F.col("run.contents").alias("content"),
    )
    anchors = docs.select(F.explode("anchors").alias("anchor")).groupBy("anchor").agg(F.count("*").alias("times"))
    found = tmp.store(runs.join(anchors.where("times > 1").select("anchor"), "anchor"))

    distinct = tmp.store(
        found.groupBy("anchor", "content").agg(F.min(_order()).alias("first"), F.max("n").alias("n"), F.count("*").alias("times"))
    )
    shards = distinct.groupBy("anchor").agg(F.count("*").alias("runs")).where("runs > 1")
    wanted = distinct.join(shards, "anchor").select(
        F.col("first.row").alias("row"), F.struct("anchor", "content", F.col("first.start").alias("start"), "n").alias("item")
    )
    lists = wanted.groupBy("row").agg(F.collect_list("item").alias("items"))
    cut = _with_bodies(tmp, docs, lists).mapInArrow(
        partial(_cut_runs, window=window), "row long, anchor long, content long, start int, n int, text binary"
    )
    keyed = cut.join(docs.select("row", "doc_id"), "row").select("anchor", "content", _order().alias("first"), "text")
    keyed = tmp.store(keyed.join(shards, "anchor"))
    mask_schema = "anchor long, content long, mask long"
    masks = (
        keyed.where(F.col("runs") <= shard_runs)
        .select("anchor", "content", "text", "first")
        .repartition("anchor")
        .sortWithinPartitions("anchor", "first")
        .select("anchor", "content", "text")
        .mapInArrow(partial(_match_shards, window=window), mask_schema)
    )
    first_type = keyed.schema["first"].dataType.simpleString()
    single = keyed.where(F.col("runs") > shard_runs).mapInArrow(
        partial(_split_windows, window=window), f"anchor long, content long, first {first_type}, bit int, text binary"
    )
    earliest = single.groupBy("text").agg(F.min("first").alias("least"))
    late = single.join(earliest, "text").where("first > least")
    late = late.groupBy("anchor", "content").agg(F.sum(F.expr("shiftleft(1L, bit)")).alias("mask"))
    masks = tmp.store(masks.union(late))

    ends = distinct.where("times > 1").select("anchor", "content", "first")
    repeated = found.join(ends, ["anchor", "content"], "left").join(
        masks.where("mask <> 0"), ["anchor", "content"], "left"
    )
    again = F.col("first").isNotNull() & (F.col("first") != _order())
    mask = F.when(again, F.expr("shiftleft(1L, n) - 1")).otherwise(F.coalesce("mask", F.lit(0)))
    spans = repeated.select("row", "start", mask.alias("mask")).where("mask <> 0")
    lists = spans.groupBy("row").agg(F.collect_list(F.struct("start", "mask")).alias("items"))
    cleaned = _with_bodies(tmp, docs, lists).mapInArrow(
        partial(_remove, window=window), "row long, n_removed long, kept binary, kept_text string"
    )
    out = docs.select("row", "doc_id", "n_words", "digest").join(cleaned, "row", "left")
    return out.select(
        "doc_id",
        "n_words",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.lower(F.hex(F.coalesce("kept", "digest"))).alias("kept_sha256"),
        *(["kept_text", "row"] if with_text else []),
    )
