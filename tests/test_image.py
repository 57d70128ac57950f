import random
import struct

from gleanery.functions.image import jpeg_dimensions
from gleanery.operators.project import image_metadata
from tests.conftest import png


def jpeg(width, height, segments=(), sof=0xC0):
    body = b"".join(b"\xff" + bytes([m]) + struct.pack(">H", len(p) + 2) + p for m, p in segments)
    return b"\xff\xd8" + body + b"\xff" + bytes([sof]) + struct.pack(">HBHHB", 17, 8, height, width, 3) + b"\0" * 9


def riff(kind, payload):
    return b"RIFF" + struct.pack("<I", len(payload) + 12) + b"WEBP" + kind + payload


CASES = {
    "png": (png(640, 480), ("PNG", 640, 480)),
    "png cut": (png(640, 480)[:22], None),
    "png zero": (png(0, 5), ("PNG", None, 5)),
    "gif": (b"GIF87a" + struct.pack("<HH", 5, 700), ("GIF", 5, 700)),
    "gif cut": (b"GIF89a\x05", None),
    "bmp": (b"BM" + b"\0" * 12 + struct.pack("<Iii", 40, 31, 17), ("BMP", 31, 17)),
    "bmp from the top": (b"BM" + b"\0" * 12 + struct.pack("<Iii", 40, 31, -17), ("BMP", 31, 17)),
    "bmp core": (b"BM" + b"\0" * 12 + struct.pack("<IHH", 12, 9, 8), ("BMP", 9, 8)),
    "webp lossy": (riff(b"VP8 ", b"\0" * 10 + struct.pack("<HH", 0x4000 | 321, 123)), ("WEBP", 321, 123)),
    "webp lossless": (riff(b"VP8L", b"\0\0\0\0\x2f" + struct.pack("<I", 319 | 199 << 14) + b"\0" * 9), ("WEBP", 320, 200)),
    "webp extended": (
        riff(b"VP8X", b"\0" * 8 + (9_999).to_bytes(3, "little") + (70_000).to_bytes(3, "little")),
        ("WEBP", 10_000, 70_001),
    ),
    "webp cut": (riff(b"VP8X", b"\0" * 5), None),
    "jpeg": (jpeg(33, 44), ("JPEG", 33, 44)),
    "jpeg progressive": (jpeg(33, 44, sof=0xC2), ("JPEG", 33, 44)),
    "jpeg with much exif": (jpeg(1, 2, [(0xE0, b"JFIF\0")] + [(0xE1, b"\xff\xc0" * 30_000)] * 5 + [(0xC4, b"h" * 50)]), ("JPEG", 1, 2)),
    "jpeg cut": (jpeg(33, 44, [(0xE0, b"x" * 100)])[:50], None),
    "jpeg without frame": (b"\xff\xd8\xff\xda\0\x02", None),
    "text": (b"hello", None),
    "empty": (b"", None),
    "null": (None, None),
}


def test_headers(spark):
    df = spark.createDataFrame([(n, bytearray(d) if d is not None else None) for n, (d, _) in CASES.items()], "name string, image_bytes binary")
    for row in image_metadata(df).collect():
        want = CASES[row["name"]][1]
        got = (row["image_format"], row["width"], row["height"]) if row["decodable"] else None
        assert got == want, row["name"]
        if want is None:
            assert (row["image_format"], row["width"], row["height"]) == (None, None, None), row["name"]


def test_one_format_name(spark):
    df = spark.createDataFrame([(bytearray(png()),), (bytearray(b"no"),)], "image_bytes binary")
    assert {r["image_format"] for r in image_metadata(df, mode="reference").collect()} == {"JPEG", None}


def test_filter_on_metadata(spark):
    df = spark.createDataFrame([(bytearray(jpeg(i, 7)),) for i in range(1, 50)], "image_bytes binary")
    assert image_metadata(df).where("width > 20 AND decodable").count() == 29


def test_a_decoder_decides_instead(spark):
    def decoder(data):
        if data == b"bad":
            raise OSError("cannot decode")
        return ("TIFF", len(data), 2) if data.startswith(b"II") else None

    rows = [(bytearray(d),) if d is not None else (None,) for d in (b"II*", b"bad", png(), b"", None)]
    got = image_metadata(spark.createDataFrame(rows, "image_bytes binary"), decoder=decoder).collect()
    assert [(r["image_format"], r["width"], r["decodable"]) for r in got] == [("TIFF", 3, True)] + [(None, None, False)] * 4


def test_damaged_jpegs_never_fail():
    rng = random.Random(3)
    whole = jpeg(640, 480, [(0xE0, b"JFIF\0"), (0xFE, b"note")])
    for _ in range(3000):
        data = bytearray(whole[: rng.randrange(len(whole) + 1)])
        for _ in range(rng.randrange(4)):
            if data:
                data[rng.randrange(len(data))] = rng.randrange(256)
        found = jpeg_dimensions(bytes(data))
        assert found is None or all(0 <= n < 65536 for n in found)
