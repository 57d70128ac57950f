"""Size and format of encoded images, read from their headers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Bytes of header that hold the size, by kind of file.
HEADER_BYTES = {
    "PNG": 24,
    "GIF": 10,
    "BMP core": 22,
    "BMP": 26,
    "WEBP lossy": 30,
    "WEBP lossless": 25,
    "WEBP extended": 30,
}


def _at(signature: bytes, offset: int = 0) -> str:
    return f"substring(head, {2 * offset + 1}, {2 * len(signature)}) = '{signature.hex().upper()}'"


def _big_endian(offset: int, length: int) -> str:
    return f"substring(head, {2 * offset + 1}, {2 * length})"


def _little_endian(offset: int, length: int) -> str:
    return "concat(" + ", ".join(_big_endian(offset + i, 1) for i in reversed(range(length))) + ")"


def _by_kind(values: dict[str, str | int], other: str = "NULL") -> str:
    return "CASE kind " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in values.items()) + f" ELSE {other} END"


def _bind(name: str, value: str, body: str) -> str:
    return f"get(transform(array({value}), {name} -> {body}), 0)"


_WEBP = f"{_at(b'RIFF')} AND {_at(b'WEBP', 8)}"

# The kind of file by its signature; NULL where none fits.
_KIND = f"""CASE
  WHEN {_at(bytes.fromhex("89504E470D0A1A0A"))} AND {_at(b"IHDR", 12)} THEN 'PNG'
  WHEN {_at(bytes.fromhex("FFD8FF"))} THEN 'JPEG'
  WHEN {_at(b"GIF87a")} OR {_at(b"GIF89a")} THEN 'GIF'
  WHEN {_at(b"BM")} AND {_at(bytes.fromhex("0C000000"), 14)} THEN 'BMP core'
  WHEN {_at(b"BM")} THEN 'BMP'
  WHEN {_WEBP} AND {_at(b"VP8 ", 12)} THEN 'WEBP lossy'
  WHEN {_WEBP} AND {_at(b"VP8L", 12)} THEN 'WEBP lossless'
  WHEN {_WEBP} AND {_at(b"VP8X", 12)} THEN 'WEBP extended'
END"""

# Hex digits of the two fields as they stand in the header.
_WIDTH_DIGITS = _by_kind(
    {
        "PNG": _big_endian(16, 4),
        "GIF": _little_endian(6, 2),
        "BMP core": _little_endian(18, 2),
        "BMP": _little_endian(18, 4),
        "WEBP lossy": _little_endian(26, 2),
        "WEBP lossless": _little_endian(21, 4),
        "WEBP extended": _little_endian(24, 3),
    }
)
_HEIGHT_DIGITS = _by_kind(
    {
        "PNG": _big_endian(20, 4),
        "GIF": _little_endian(8, 2),
        "BMP core": _little_endian(20, 2),
        "BMP": _little_endian(22, 4),
        "WEBP lossy": _little_endian(28, 2),
        "WEBP lossless": _little_endian(21, 4),
        "WEBP extended": _little_endian(27, 3),
    }
)


def _number(digits: str) -> str:
    complete = f"length(head) >= 2 * {_by_kind(HEADER_BYTES)}"
    return f"bigint(conv(CASE WHEN {complete} THEN {digits} END, 16, 10))"


# Some kinds pack other bits into a field or store one less than the size;
# a negative BMP height, as two's complement, says that rows run from the top.
_WIDTH = _by_kind(
    {"WEBP lossy": "size.w & 16383", "WEBP lossless": "(size.w & 16383) + 1", "WEBP extended": "size.w + 1"},
    "size.w",
)
_HEIGHT = _by_kind(
    {
        "BMP": f"CASE WHEN size.h >= {2**31} THEN {2**32} - size.h ELSE size.h END",
        "WEBP lossy": "size.h & 16383",
        "WEBP lossless": "(shiftright(size.h, 14) & 16383) + 1",
        "WEBP extended": "size.h + 1",
    },
    "size.h",
)


def header_probe(bytes_col: str) -> Column:
    """``struct<format, width, height>`` from the first bytes of a payload.

    The size of a JPEG does not stand at a fixed place and stays NULL here.
    """
    name = bytes_col.replace("`", "``")
    found = (
        "named_struct('format', substring_index(kind, ' ', 1), "
        f"'width', try_cast({_WIDTH} AS int), 'height', try_cast({_HEIGHT} AS int))"
    )
    sized = _bind("size", f"named_struct('w', {_number(_WIDTH_DIGITS)}, 'h', {_number(_HEIGHT_DIGITS)})", found)
    header = f"hex(substring(`{name}`, 1, {max(HEADER_BYTES.values())}))"
    return F.expr(_bind("head", header, _bind("kind", _KIND, sized)))


def jpeg_dimensions(data: bytes | memoryview) -> tuple[int, int] | None:
    """Width and height from the first start-of-frame segment."""
    at, end = 2, len(data)
    while at + 4 <= end:
        if data[at] != 0xFF:
            return None
        marker = data[at + 1]
        if marker == 0xFF:  # fill byte
            at += 1
        elif marker == 0x01 or 0xD0 <= marker <= 0xD7:  # no payload
            at += 2
        elif marker in (0xD9, 0xDA):  # end of image, start of scan
            return None
        elif 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
            if at + 9 > end:
                return None
            height = int.from_bytes(data[at + 5 : at + 7], "big")
            return int.from_bytes(data[at + 7 : at + 9], "big"), height
        else:
            at += 2 + int.from_bytes(data[at + 2 : at + 4], "big")
    return None


_SIZE_TYPE = pa.struct([("width", pa.int32()), ("height", pa.int32())])


@F.arrow_udf(
    T.StructType([T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType())])
)
def _jpeg_sizes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        sizes = []
        for value in batch:
            found = jpeg_dimensions(memoryview(value.as_buffer()).cast("B")) if value.is_valid else None
            sizes.append({"width": found[0], "height": found[1]} if found else None)
        yield pa.array(sizes, type=_SIZE_TYPE)


def jpeg_size(data: Column, form: Column) -> Column:
    """``struct<width, height>`` of JPEG payloads.

    The frame header follows a chain of variable-length segments, so this one
    format is walked in Python; other payloads are sent there as NULL.  Marked
    as nondeterministic, so that a filter on the result does not run it again.
    """
    return _jpeg_sizes.asNondeterministic()(F.when(form == "JPEG", data))


def decoded_size(data: Column, decoder: Callable[[bytes], tuple[str, int, int] | None]) -> Column:
    """``struct<format, width, height>`` by a decoder of the caller, NULL where it fails."""

    @F.arrow_udf(
        T.StructType(
            [
                T.StructField("format", T.StringType()),
                T.StructField("width", T.IntegerType()),
                T.StructField("height", T.IntegerType()),
            ]
        )
    )
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.struct([("format", pa.string()), ("width", pa.int32()), ("height", pa.int32())])
        for batch in batches:
            found = []
            for value in batch:
                try:
                    image = decoder(value.as_py()) if value.is_valid and len(value.as_buffer()) else None
                except Exception:
                    image = None
                found.append(dict(zip(("format", "width", "height"), image)) if image else None)
            yield pa.array(found, type=kind)

    return decode.asNondeterministic()(data)
