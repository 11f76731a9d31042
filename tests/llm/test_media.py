import hashlib
import struct
import time

import pytest
import zlib

from llm_helpers import odd_rows, pandas_of

from waveline.llm import media


def png(colour=b"\x10\x20\x30"):
    chunk = lambda name, data: struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 1, 1, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"\0" + colour)) + chunk(b"IEND", b"")


GIF = b"GIF89a" + struct.pack("<HHBBB", 1, 1, 0x80, 0, 0) + b"\0\0\0\xff\xff\xff" + b"\x2c" + struct.pack("<HHHHB", 0, 0, 1, 1, 0) + b"\x02\x02\x44\x01\x00\x3b"
JPEG = b"\xff\xd8\xff\xe0" + struct.pack(">H", 16) + b"JFIF\0\1\1\0\0\1\0\1\0\0" + b"\xff\xda" + struct.pack(">H", 8) + b"\1\1\0\0\x3f\0" + b"\x12\x34\xff\x00\x56" + b"\xff\xd9"
BMP = b"BM" + struct.pack("<IIIIiiHHIIiiII", 58, 0, 54, 40, 1, 1, 1, 24, 0, 4, 0, 0, 0, 0) + b"\1\2\3\0"


def test_signatures_and_lengths():
    for kind, data in (("image/png", png()), ("image/gif", GIF), ("image/jpeg", JPEG), ("image/bmp", BMP), ("audio/wav", media.pack_wav(b"abc"))):
        found, inner = media.carve(b"xx" + data + b"tail")
        assert [(f.kind, f.offset, f.length) for f in found] == [(kind, 2, len(data))], kind
        assert inner == 0
        for torn in (data[: len(data) // 2], data[:-1]):
            assert not [f for f in media.carve(torn)[0] if f.kind == kind], kind


def test_magic_without_structure_is_nothing():
    assert media.carve(b"BM and RIFF and GIF89a in prose \xff\xd8\xff")[0] == []
    broken = bytearray(png())
    broken[-6] ^= 1
    assert media.carve(bytes(broken))[0] == []


def test_carving_is_outermost():
    found, inner = media.carve(media.pack_wav(b"--" + png() + b"--") + GIF)
    assert [f.kind for f in found] == ["audio/wav", "image/gif"] and inner == 1


def test_wav_round_trip():
    for payload in (b"", b"a", b"ab" * 96):
        assert media.read_wav(media.pack_wav(payload)) == (media.RATE, payload)
    assert [len(media.pad_text(b"x" * n)) for n in (0, 1, 192, 193)] == [192, 192, 192, 384]


def test_texts_come_back(make_docs):
    rows = odd_rows() + [(50, "RIFF and BM in a text", "en", "a")]
    out = pandas_of(media.sniff(media.store_texts(make_docs(rows)), ["doc_id", "n_bytes"]))
    assert len(out) == len(rows)
    texts = sorted((t or "").encode() for _, t, *_ in rows)
    assert sorted(out.n_bytes) == sorted(map(len, texts))
    padded = [media.pad_text(t) for t in texts]
    assert sorted(out.payload_sha256) == sorted(hashlib.sha256(p).hexdigest() for p in padded)
    assert sorted(out.tail_crc32) == sorted(zlib.crc32(p[-16:]) for p in padded)
    assert sorted(out.media_sha256) == sorted(hashlib.sha256(media.pack_wav(p)).hexdigest() for p in padded)
    assert set(out.kind) == {"audio/wav"} and out.corrected.all()
    assert out[out.payload_sha256 == hashlib.sha256(b" " * 192).hexdigest()].feature.nunique() == 1


def test_declared_types_are_corrected(spark):
    rows = [(1, "image/png", png()), (2, "image/gif", png()), (3, "text/plain", None), (4, None, b""), (5, "image/gif", b"junk" + GIF)]
    out = {r.id: r for r in media.sniff(spark.createDataFrame(rows, "id int, declared string, media binary"), ["id"], with_parts=True).collect()}
    assert [out[k].kind for k in range(1, 6)] == ["image/png", "image/png", None, None, None]
    assert [out[k].corrected for k in range(1, 6)] == [False, True, False, False, False]
    assert [(p.kind, p.offset, bytes(p.data)) for p in out[5].parts] == [("image/gif", 4, GIF)]


def test_empty_table(make_docs):
    assert media.sniff(media.store_texts(make_docs([])), ["doc_id"]).collect() == []


def test_large_jpeg_takes_linear_time():
    """Many markers in the scan, each of which once copied the whole buffer."""
    scan = (b"\x11\x22\xff\x00" * 8 + b"\xff\xd0") * 120_000
    data = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xda\x00\x04cd" + scan + b"\xff\xd9"
    began = time.perf_counter()
    (found,), inner = media.carve(data)
    assert (found.kind, found.offset, found.length, inner) == ("image/jpeg", 0, len(data), 0)
    assert time.perf_counter() - began < 5


def test_media_inside_others_are_carved_too(spark):
    thumb = GIF
    outer = media.pack_wav(b"--" + thumb + b"--")
    (r,) = media.sniff(spark.createDataFrame([(1, "x/y", outer + thumb)], "doc_id long, declared string, media binary"), ["doc_id"], with_parts=True).collect()
    assert (r.carved, r.inner) == (2, 1)
    assert [(p.kind, p.offset, p.inner, bytes(p.data)) for p in r.parts] == [("audio/wav", 0, False, outer), ("image/gif", len(outer), False, thumb), ("image/gif", outer.index(thumb), True, thumb)]


@pytest.mark.parametrize("unit", [b"GIF89a0000000!x", b"GIF89a0000000!x\x01", b"GIF87a\x01\0\x01\0\0\0\0!\xf9\x04aaaa", b"\xff\xd8\xff\xe0\0\x04ab", b"\xff\xd8\xff\xda\0\x04ab\0\0", b"\x89PNG\r\n\x1a\n\0\0\0\rIHDR", b"BM......"])
def test_many_signatures_take_linear_time(unit):
    """Every magic starts a walk over the rest; walks that meet are one."""
    took = []
    for n in (100_000, 400_000):
        data = unit * (n // len(unit))
        began = time.perf_counter()
        media.carve_all(data)
        took.append(time.perf_counter() - began)
    assert took[1] < 12 * took[0] + 0.5 and took[1] < 6


def test_walks_that_meet_give_what_each_gives():
    import random

    rng = random.Random(3)
    gif = b"GIF89a\x01\0\x01\0\0\0\0" + b"!\xf9\x02ab\0" + b";"
    jpeg = b"\xff\xd8\xff\xe0\0\x04ab\xff\xda\0\x04cd" + b"xyz\xff\0zz" + b"\xff\xd9"
    for _ in range(300):
        data = b"".join(rng.choice([gif, jpeg, gif[:13], jpeg[:8], b";", b"\xff\xd9", b"!", b"\0", bytes([rng.randrange(256)]) * 3]) for _ in range(25))
        found = sorted((f.kind, f.offset, f.length) for part in media.carve_all(data) for f in part)
        alone = []
        for kind, magic, check in media.FORMATS:
            at = data.find(magic)
            while at >= 0:
                if length := check(data, at, {}):
                    alone.append((kind, at, length))
                at = data.find(magic, at + 1)
        assert found == sorted(alone)
