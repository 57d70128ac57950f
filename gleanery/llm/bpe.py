"""Byte-level BPE encoding and decoding by a two-tier lookup.

A minimal perfect hash over the vocabulary resolves pre-tokens that are whole
entries; others are merged by a heap over a linked list of bytes, always the
pair of least rank first, the leftmost of equals. The tables are bounded by the
vocabulary: they are made once on the driver and broadcast.

Texts are cut at single spaces between other characters, where no pre-token
can reach across, and pieces that were met before are taken from a bounded memo,
with what their ids decode to. The distinct pieces of a batch are looked up
once, and the texts put together from them in Arrow.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from operator import concat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.session import prepare

from .words import small

# Pieces, and pre-tokens of them, that a worker remembers in each of two generations.
MEMO_PIECES = 300_000
MEMO_TOKENS = 200_000
# Texts whose distinct pieces are looked up together, at most.
BATCH_ROWS = 2048

# Of a piece or pre-token: its number of ids, these as decimals joined by commas, the bytes decoded from them, and
# the ids as 32-bit numbers where they are asked for, else nothing.
Piece = tuple[int, str, bytes, bytes]

_BYTES = [bytes([byte]) for byte in range(256)]
_ODD_SPACE = re.compile(r" \s|\s ")
# The same for Arrow, whose \s is that of ASCII.
_ODD_SPACE_ARROW = r" [\t-\r\x1c-\x1f\x{85}\p{Z}]|[\t-\r\x1c-\x1f\x{85}\p{Z}] "
_PLAIN_SPACE = re.compile(r"(?<=\S) (?=\S)")


def load_ranks(spark, path: str) -> dict[bytes, int]:
    """The ranks of a file of lines ``base64 rank``, read by Spark, so that it may be in any store."""
    lines = spark.read.text(path).where("value <> ''").collect()
    return {base64.b64decode(a): int(b) for a, b in (row["value"].split() for row in lines)}


# Keys are hashed as numbers modulo this prime, which lets no two byte strings of an honest vocabulary meet.
_PRIME = (1 << 61) - 1


class PerfectHash:
    """A minimal perfect hash of byte strings: hash, displace, and compare.

    Keys are grouped by one hash; for each group, the largest first, a
    displacement is sought that sends its keys to free places. A place holds
    the key itself, so that strings outside the set are told apart.
    """

    def __init__(self, values: dict[bytes, int]) -> None:
        n = max(1, len(values))
        self.n, self.groups = n, max(1, n // 4)
        by_group: dict[int, list[tuple[int, bytes]]] = {}
        for key in values:
            h = self._hash(key)
            by_group.setdefault(h % self.groups, []).append((h, key))
        self.shift = [0] * self.groups
        self.keys: list[bytes | None] = [None] * n
        self.values = [0] * n
        for group, members in sorted(by_group.items(), key=lambda item: (-len(item[1]), item[0])):
            shift = 0
            while True:
                places = [self._place(h, shift) for h, _ in members]
                if len(set(places)) == len(places) and all(self.keys[p] is None for p in places):
                    break
                shift += 1
            self.shift[group] = shift
            for place, (_, key) in zip(places, members, strict=True):
                self.keys[place] = key
                self.values[place] = values[key]

    @staticmethod
    def _hash(key: bytes) -> int:
        # The last byte tells keys apart that end in null bytes.
        return int.from_bytes(key + b"\1", "little") % _PRIME

    def _place(self, h: int, shift: int) -> int:
        return ((h ^ (shift * 0x9E3779B97F4A7C15)) * 0xD6E8FEB86659FD93 >> 32 & 0xFFFFFFFF) % self.n

    def get(self, key: bytes) -> int:
        """The value of ``key``, or -1."""
        # ``_hash`` and ``_place`` written out, as this runs for every new pre-token.
        h = int.from_bytes(key + b"\1", "little") % _PRIME
        place = (h ^ (self.shift[h % self.groups] * 0x9E3779B97F4A7C15)) * 0xD6E8FEB86659FD93 >> 32 & 0xFFFFFFFF
        place %= self.n
        return self.values[place] if self.keys[place] == key else -1


class Bpe:
    def __init__(self, ranks: dict[bytes, int], pattern: str, with_ids: bool = True) -> None:
        self.pattern = pattern
        self.with_ids = with_ids
        self.whole = PerfectHash(ranks)
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}

    def __getstate__(self):
        return {"pattern": self.pattern, "with_ids": self.with_ids, "whole": self.whole, "ranks": self.ranks}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.match = regex.compile(self.pattern).findall
        self.decimal = {rank: str(rank) for rank in self.tokens}
        # By what follows the piece's space.
        self.young: dict[str, Piece] = {}
        self.old: dict[str, Piece] = {}
        self.young_tokens: dict[str, Piece] = {}
        self.old_tokens: dict[str, Piece] = {}

    def pre_token(self, match: str) -> Piece:
        """A pre-token: a whole entry or merged; with a memo, as words come with many sorts of punctuation around them."""
        found = self.young_tokens.get(match)
        if found is None:
            found = self.old_tokens.get(match)
            if found is None:
                token = match.encode()
                rank = self.whole.get(token)
                ids = [rank] if rank >= 0 else self.merge(token)
                decimals, raw = ",".join(map(self.decimal.__getitem__, ids)), array("I", ids).tobytes() if self.with_ids else b""
                found = len(ids), decimals, self.decode(ids), raw
            if len(match) <= 64:
                if len(self.young_tokens) >= MEMO_TOKENS:
                    self.old_tokens, self.young_tokens = self.young_tokens, {}
                self.young_tokens[match] = found
        return found

    def merge(self, token: bytes) -> list[int]:
        """Ids of a pre-token that is no entry itself, by merging adjacent parts."""
        rank_of, n = self.ranks.get, len(token)
        parts: list[bytes | None] = list(map(_BYTES.__getitem__, token))
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        # Of the pair that starts at a part: its rank, None if it is no entry or the part is gone.
        ranks = [*map(rank_of, map(concat, parts, parts[1:])), None]
        heap = [rank * n + i for i, rank in enumerate(ranks) if rank is not None]  # by rank, then place
        heapify(heap)
        while heap:
            rank, i = divmod(heappop(heap), n)
            if ranks[i] != rank:
                continue  # one of the two parts has changed since
            j = after[i]
            parts[i] = part = parts[i] + parts[j]
            parts[j] = ranks[i] = ranks[j] = None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                ranks[i] = rank = rank_of(part + parts[k])
                if rank is not None:
                    heappush(heap, rank * n + i)
            h = before[i]
            if h >= 0:
                ranks[h] = rank = rank_of(parts[h] + part)
                if rank is not None:
                    heappush(heap, rank * n + h)
        return [self.ranks[part] for part in parts if part is not None]

    def encode_piece(self, piece: str) -> Piece:
        found = list(map(self.pre_token, self.match(piece)))
        if len(found) == 1:
            return found[0]
        if not found:
            return 0, "", b"", b""
        counts, decimals, decoded, raw = zip(*found, strict=True)
        return sum(counts), ",".join(decimals), b"".join(decoded), b"".join(raw)

    def after_space(self, part: str) -> Piece:
        """``encode_piece`` of a space and ``part`` with a memo; its older half goes when the younger is full."""
        found = self.old.get(part)
        if found is None:
            found = self.encode_piece(" " + part)
        if len(self.young) >= MEMO_PIECES:
            self.old, self.young = self.young, {}
        self.young[part] = found
        return found

    def pieces(self, text: str) -> list[Piece]:
        if not text:
            return []
        first, *parts = _PLAIN_SPACE.split(text) if _ODD_SPACE.search(text) else text.split(" ")
        # Without a first part, the text begins with one space.
        found = [self.encode_piece(first)] if first else []
        if parts:
            found += [self.young.get(part) or self.after_space(part) for part in parts]
        return found

    def joined(self, texts: pa.Array) -> Iterator[tuple[int, bytes, bytes, bytes]]:
        """Of each text what ``pieces`` gives, put together."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        odd = pc.match_substring_regex(texts, _ODD_SPACE_ARROW).to_numpy(zero_copy_only=False)
        parts = pc.split_pattern(texts.filter(pa.array(~odd)), " ")
        offsets = parts.offsets.to_numpy()
        first = np.zeros(offsets[-1] - offsets[0], dtype=bool)
        begin = offsets[:-1] - offsets[0]
        first[begin] = True
        parts = parts.flatten()
        rest = parts.filter(pa.array(~first)).dictionary_encode()
        # The first part of a text has no space before it.
        known = [self.young.get(part) or self.after_space(part) for part in rest.dictionary.to_pylist()]
        at = np.empty(len(first), dtype=np.int64)
        at[~first] = rest.indices.to_numpy()
        at[first] = len(known) + np.arange(len(begin))
        known += [self.encode_piece(part) if part else (0, "", b"", b"") for part in parts.take(pa.array(begin)).to_pylist()]

        counts = np.fromiter((piece[0] for piece in known), dtype=np.int64, count=len(known))[at]
        ends = np.concatenate([[0], np.cumsum(counts > 0)])[offsets - offsets[0]]
        totals = np.diff(np.concatenate([[0], np.cumsum(counts)])[offsets - offsets[0]])
        at = pa.array(at[counts > 0])

        def put_together(k: int, kind: pa.DataType, between: str | bytes) -> Iterator[bytes]:
            each = pa.array([piece[k] for piece in known], kind).take(at)
            return (x.as_buffer() for x in pc.binary_join(pa.LargeListArray.from_arrays(ends, each), pa.scalar(between, kind)))

        decimals = put_together(1, pa.large_string(), ",")
        decoded, raw = (put_together(k, pa.large_binary(), b"") for k in (2, 3))
        plain = zip(totals.tolist(), decimals, decoded, raw, strict=True)
        for i, is_odd in enumerate(odd.tolist()):
            if is_odd:
                counts, decimals, decoded, raw = zip(*self.pieces(texts[i].as_py()), strict=True)
                yield sum(counts), ",".join(filter(None, decimals)).encode(), b"".join(decoded), b"".join(raw)
            else:
                yield next(plain)

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join([raw for *_, raw in self.pieces(text)]), dtype="<u4")

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def encode_documents(
    df: DataFrame,
    ranks_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """One row per row of ``df``: doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids.

    ids_sha256 is the hash of the decimal ids joined by commas, decoded_sha256
    that of the bytes decoded from the ids, both in lower-case hex. Null and
    empty texts have no ids and the hash of nothing. Null and repeated ids of
    documents stay as they are. Other columns are ignored. Every single byte
    must be an entry of the ranks, as in all byte-level vocabularies.
    """
    spark = prepare(df.sparkSession)
    shared = spark.sparkContext.broadcast(Bpe(load_ranks(spark, ranks_path), pattern, with_ids))
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = shared.value
        for batch in small(batches, BATCH_ROWS):
            n, hashed, decoded, kept = [], [], [], []
            for count, decimals, text, raw in bpe.joined(batch.column("text")):
                n.append(count)
                hashed.append(hashlib.sha256(decimals).hexdigest())
                decoded.append(hashlib.sha256(text).hexdigest())
                if with_ids:
                    kept.append(np.frombuffer(raw, dtype="<i4"))
            columns = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(hashed), pa.array(decoded)]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, schema + (", ids array<int>" if with_ids else ""))
