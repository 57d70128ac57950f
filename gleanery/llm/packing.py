"""Best-fit decreasing packing of tokenised documents into sequences.

Pieces are placed from the longest to the shortest, each in the open sequence
with the least remaining room that is enough. As only lengths matter, the plan
is made from the histogram of lengths, which has no more entries than a
sequence has tokens: sequences with the same room are kept as one run of
numbers, and a segment tree over the rooms finds the tightest in logarithmic
time. Pieces of a length take the places of that length by their rank, so the
result is that of one packer over the whole table, while neither pieces nor
texts pass through the driver.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gleanery.session import Scratch, prepare, stored

from .words import small

# Pieces of one length are ranked in so many parts, each counted by itself.
RANK_PARTS = 512
# Bytes that a worker may take for words, and for parts of words, in each of two generations; an entry takes about so many besides its own.
MEMO_BYTES = 17_000_000
ENTRY_BYTES = 150

# Words of printable ASCII and Latin-1 letters, and how the tokenizer parts them: contractions, letters, digits, the rest.
_PLAIN = re.compile(r"[!-~\u00C0-\u00FF]+")
_LETTER = r"a-z\u00DF-\u00F6\u00F8-\u00FF"
_PARTS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[0-9]|[^0-9{_LETTER}]+")


def _byte_letters() -> dict[int, str]:
    """The letters by which a byte-level vocabulary writes each character of Latin-1: bytes in print as themselves, others from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in own]
    letter = {byte: chr(byte) for byte in own} | {byte: chr(256 + i) for i, byte in enumerate(others)}
    return {code: "".join(letter[byte] for byte in chr(code).encode()) for code in range(256)}


_BYTE_LETTERS = _byte_letters()
# What these shortcuts take for granted of a tokenizer; with another one every new word takes the tokenizer's whole way.
_CASELESS = ["NFC", "Replace", "Lowercase"]
_PARTED = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _parts_known(definition: str) -> bool:
    rules = json.loads(definition)
    steps = [step["type"] for step in (rules["normalizer"] or {}).get("normalizers", [])]
    cuts = (rules["pre_tokenizer"] or {}).get("pretokenizers", [])
    return steps == _CASELESS and [cut["type"] for cut in cuts] == ["Split", "ByteLevel"] and cuts[0]["pattern"] == {"Regex": _PARTED}


class WordEncoder:
    """Token ids of UTF-8 texts, once it is unpickled, by a tokenizer whose tokens never reach across ASCII white space."""

    def __init__(self, definition: str) -> None:
        self.definition = definition
        # Found out here, as a worker that has parsed the rules does not give all of that memory back.
        self.parts_known = _parts_known(definition)
        self.added_tokens = [t["content"] for t in json.loads(definition).get("added_tokens", [])]

    def __getstate__(self):
        return {k: getattr(self, k) for k in ("definition", "parts_known", "added_tokens")}

    def __setstate__(self, state):
        # One thread per task, as Spark plans its cores; the library would start one per core of the machine.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.__dict__.update(state)
        self.tokenizer = Tokenizer.from_str(self.definition)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.model = self.tokenizer.model if self.parts_known else None
        # Words that hold an added token, like <|endoftext|>, take the tokenizer's whole way.
        self.added = re.compile("|".join(map(re.escape, self.added_tokens)) or r"(?!)", re.IGNORECASE)
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.young_parts: dict[str, bytes] = {}
        self.old_parts: dict[str, bytes] = {}
        self.young_bytes = self.young_parts_bytes = 0

    def encode(self, texts: Iterable[bytes]) -> Iterator[np.ndarray]:
        for text in texts:
            if self.young_bytes >= MEMO_BYTES:
                self.old, self.young, self.young_bytes = self.young, {}, 0
            words = text.split()  # of bytes: at ASCII white space only
            missing = set(words).difference(self.young)
            if missing:
                self._learn(missing)
            yield np.frombuffer(b"".join(map(self.young.__getitem__, words)), dtype="<u4")

    def _learn(self, words: set[bytes]) -> None:
        """Remember ``words``; those not met before are put together from parts or go through the tokenizer."""
        whole = []
        for w in words:
            if w in self.old:
                self.young[w] = self.old[w]
                continue
            word = w.decode()
            if self.model is not None and _PLAIN.fullmatch(word) and not self.added.search(word):
                self.young[w] = b"".join(map(self._part, _PARTS.findall(word.lower())))
            else:
                whole.append(word)
        if whole:
            self._learn_whole(whole)
        self.young_bytes += sum(map(len, words)) + sum(len(self.young[w]) for w in words) + ENTRY_BYTES * len(words)

    def _part(self, part: str) -> bytes:
        found = self.young_parts.get(part)
        if found is None:
            found = self.old_parts.get(part)
            if found is None:
                tokens = self.model.tokenize(part if part.isascii() else part.translate(_BYTE_LETTERS))
                found = struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])
            if self.young_parts_bytes >= MEMO_BYTES:
                self.old_parts, self.young_parts, self.young_parts_bytes = self.young_parts, {}, 0
            self.young_parts[part] = found
            self.young_parts_bytes += ENTRY_BYTES + len(part) + len(found)
        return found

    def _learn_whole(self, words: list[str]) -> None:
        """``words`` encoded as one text and told apart by where their tokens start."""
        found = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
        ids = np.array(found.ids, dtype="<u4")
        begin = np.cumsum([0, *[len(w) + 1 for w in words]])
        cuts = np.searchsorted([a for a, _ in found.offsets], begin)
        for w, a, b in zip(words, cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            self.young[w.encode()] = ids[a:b].tobytes()


class Tree:
    """Segment tree over rooms: the smallest room from ``least`` on that some sequence has."""

    def __init__(self, size: int) -> None:
        self.leaves = 1 << max(1, size).bit_length()
        self.any = [False] * (2 * self.leaves)

    def set(self, room: int, there: bool) -> None:
        i = room + self.leaves
        self.any[i] = there
        while i > 1:
            i //= 2
            self.any[i] = self.any[2 * i] or self.any[2 * i + 1]

    def tightest(self, least: int) -> int | None:
        i = least + self.leaves
        if self.any[i]:
            return least
        while i > 1:
            if i % 2 == 0 and self.any[i + 1]:
                i += 1
                while i < self.leaves:
                    i = 2 * i if self.any[2 * i] else 2 * i + 1
                return i - self.leaves
            i //= 2
        return None


def best_fit_plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Steps (length, first rank, last rank + 1, first sequence, offset) of best-fit decreasing.

    A run of pieces of one length goes to a run of sequences with equal room, or
    to new ones, as many to each as fit, which is what the packer does piece by
    piece: after a piece, its sequence is the tightest if it still has the room.
    """
    tree = Tree(capacity)
    runs: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room -> (first sequence, sequences)

    def put(room: int, first: int, n: int) -> None:
        if n and room:
            runs[room].append((first, n))
            tree.set(room, True)

    def take(room: int, most: int) -> tuple[int, int]:
        first, n = runs[room].pop()
        if n > most:
            runs[room].append((first + most, n - most))
        if not runs[room]:
            tree.set(room, False)
        return first, min(n, most)

    steps, opened = [], 0
    for length in sorted(histogram, reverse=True):
        rank, total = 0, histogram[length]
        while rank < total:
            room = tree.tightest(length)
            if room is None:
                room, each = capacity, capacity // length
                n = max(1, (total - rank) // each)
                first, opened = opened, opened + n
            else:
                each = room // length
                first, n = take(room, max(1, (total - rank) // each))
            if each > total - rank:  # a single sequence takes what is left
                each = total - rank
            for i in range(each):
                steps.append((length, rank, rank + n, first, capacity - room + i * length))
                rank += n
            put(room - each * length, first, n)
    return steps


def pack_documents(
    df: DataFrame,
    tokenizer_path: str,
    capacity: int = 4096,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset and, if asked for, ids.

    A document is its ids with nothing added by the tokenizer, then ``end_id``;
    special tokens that the text itself holds are such tokens. Null and
    empty texts are ``end_id`` alone. Only longer documents are cut, into pieces
    of ``capacity`` and a last one that may be shorter. Documents of equal or
    null id are packed like others. ids_crc32 is that of the ids as unsigned
    little-endian 32-bit numbers. An empty table gives no rows. Other columns
    are ignored. Ties between pieces of one length go by part, id, piece and
    place in the table.
    """
    spark = prepare(df.sparkSession)
    with Scratch(spark) as tmp:
        return stored(_pack_documents(tmp, df, tokenizer_path, capacity, end_id, id_col, text_col, with_ids))


def _pack_documents(
    tmp: Scratch,
    df: DataFrame,
    tokenizer_path: str,
    capacity: int,
    end_id: int,
    id_col: str,
    text_col: str,
    with_ids: bool,
) -> DataFrame:
    spark = df.sparkSession
    definition = "\n".join(r["value"] for r in spark.read.text(tokenizer_path, wholetext=True).collect())
    shared = spark.sparkContext.broadcast(WordEncoder(definition))
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared.value  # with what this worker has met before
        names = ["row", "doc_id", "piece", "start", "length", "ids_crc32", "ids"]
        for batch in small(batches):
            at, piece, start, length, crc, kept = [], [], [], [], [], []
            texts = (t.as_py() or b"" for t in batch.column("text").cast(pa.binary()))
            for i, ids in enumerate(encoder.encode(texts)):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for k, first in enumerate(range(0, len(ids), capacity)):
                    part = ids[first : first + capacity]
                    at.append(i)
                    piece.append(k)
                    start.append(first)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
                    kept.append(part.view("<i4") if with_ids else None)
            columns = [pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
            columns = [batch.column("row").take(pa.array(at, pa.int64())), batch.column("doc_id").take(pa.array(at, pa.int64())), *columns]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(kept, pa.list_(pa.int32()))], names=names)

    schema = f"row long, doc_id {id_type}, piece int, start long, length long, ids_crc32 long, ids array<int>"
    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    pieces = tmp.store(rows.mapInArrow(run, schema)).withColumn("part", F.pmod(F.xxhash64("row", "piece"), F.lit(RANK_PARTS)))

    counts = tmp.store(pieces.groupBy("length", "part").agg(F.count("*").alias("n")))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = best_fit_plan(histogram, capacity)
    # As an Arrow table: rows in a list would take Python workers of another kind, beside those that hold the encoder.
    columns = np.array(plan, dtype=np.int64).reshape(-1, 5).T
    steps = spark.createDataFrame(pa.table(dict(zip(["length", "from_rank", "to_rank", "first", "offset"], columns, strict=True))))

    ahead = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("length", "part", F.coalesce(ahead, F.lit(0)).alias("ahead"))
    inner = F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "piece", "row")) - 1
    ranked = pieces.withColumn("inner", inner).join(counts, ["length", "part"])
    ranked = ranked.withColumn("rank", F.col("ahead") + F.col("inner")).drop("inner", "ahead", "part")
    # The plan has a few steps per length at most (its size is bounded by the capacity), so it is broadcast.
    placed = ranked.join(
        F.broadcast(steps.withColumnRenamed("length", "of")), F.expr("of = length AND rank >= from_rank AND rank < to_rank")
    )
    return placed.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("first") + F.col("rank") - F.col("from_rank")).alias("sequence_id"),
        "offset",
        *(["ids"] if with_ids else []),
    )
