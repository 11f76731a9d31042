"""Media columns: signature sniffing, type correction, carving and stored features.

One Aho-Corasick automaton over all magic bytes finds where a medium may begin; the format's
validator then walks its structure and declared lengths and gives its true length or refuses.
The outermost validated media are carved; what they hold inside is reported with them.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Callable
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waveline.llm.common import small_batches

RATE = 8000


@dataclass(frozen=True)
class Found:
    kind: str
    offset: int
    length: int


#: What the walks over one medium column's value have found: of a place where a walk passed, where it ends.
Seen = dict[tuple[str, int], int]


def _settle(seen: Seen, kind: str, path: list[int], end: int) -> int:
    """All places of a walk end where it does; a later walk that comes by stops there."""
    for at in path:
        seen[kind, at] = end
    return end


def _wav(b: bytes, at: int, seen: Seen) -> int:
    """RIFF/WAVE: the declared size fits and the chunks fill it, fmt before data."""
    if len(b) - at < 44 or b[at + 8 : at + 12] != b"WAVE":
        return 0
    end, at0 = at + 8 + struct.unpack_from("<I", b, at + 4)[0], at
    if end > len(b):
        return 0
    at, names = at + 12, set()
    while at + 8 <= end:
        name, size = bytes(b[at : at + 4]), struct.unpack_from("<I", b, at + 4)[0]
        if at + 8 + size > end or name == b"fmt " and size < 16 or name == b"data" and b"fmt " not in names:
            return 0
        names.add(name)
        at += 8 + size + size % 2
    return end - at0 if at in (end, end + 1) and b"data" in names else 0


def _png(b: bytes, at: int, seen: Seen) -> int:
    """PNG: chunks from an IHDR of 13 bytes to IEND, each with its check sum."""
    at0, at, end, path = at, at + 8, 0, []
    if b[at : at + 8] != b"\0\0\0\rIHDR":
        return 0
    while at + 12 <= len(b):
        if ("png", at) in seen:
            end = seen["png", at]
            break
        path.append(at)
        size, name = struct.unpack_from(">I", b, at)[0], bytes(b[at + 4 : at + 8])
        if at + 12 + size > len(b) or zlib.crc32(memoryview(b)[at + 4 : at + 8 + size]) != struct.unpack_from(">I", b, at + 8 + size)[0]:
            break
        at += 12 + size
        if name == b"IEND":
            end = at
            break
    _settle(seen, "png", path, end)
    return end - at0 if end else 0


def _gif(b: bytes, at: int, seen: Seen) -> int:
    """GIF: colour tables, then blocks of sub-blocks up to the trailer."""
    at0, n, end, path = at, len(b), 0, []

    def table(flags: int) -> int:
        return 3 << (flags & 7) + 1 if flags & 128 else 0

    def blocks(at: int) -> int:
        walked = []
        while at < n and b[at] and ("sub", at) not in seen:
            walked.append(at)
            at += b[at] + 1
        return _settle(seen, "sub", walked, seen.get(("sub", at), at + 1))

    if n - at < 14:
        return 0
    at += 13 + table(b[at + 10])
    while at < n:
        if ("gif", at) in seen:
            end = seen["gif", at]
            break
        path.append(at)
        if b[at] == 0x3B:
            end = at + 1
            break
        if b[at] == 0x21:
            at = blocks(at + 2)
        elif b[at] == 0x2C and at + 10 < n:
            at = blocks(at + 11 + table(b[at + 9]))
        else:
            break
    _settle(seen, "gif", path, end)
    return end - at0 if end else 0


def _jpeg(b: bytes, at: int, seen: Seen) -> int:
    """JPEG: marker segments by their lengths, then entropy-coded data up to EOI."""
    at0, n, scan, end, paths = at, len(b), False, 0, {False: [], True: []}
    at += 2
    while at + 2 <= n:
        kind = "scan" if scan else "jpeg"
        if (kind, at) in seen:
            end = seen[kind, at]
            break
        paths[scan].append(at)
        if b[at] != 0xFF:
            if not scan or (at := b.find(b"\xff", at)) < 0:
                break
            continue
        mark = b[at + 1]
        if mark == 0xD9:
            end = at + 2 if scan else 0
            break
        if mark == 0 or 0xD0 <= mark <= 0xD7:
            if not scan:
                break
            at += 2
        elif mark == 0xFF:
            at += 1
        elif at + 4 <= n and (size := struct.unpack_from(">H", b, at + 2)[0]) >= 2:
            scan = scan or mark == 0xDA
            at += 2 + size
        else:
            break
    _settle(seen, "jpeg", paths[False], end)
    _settle(seen, "scan", paths[True], end)
    return end - at0 if end else 0


def _bmp(b: bytes, at: int, seen: Seen) -> int:
    """BMP: the declared file size holds the header and the pixels it declares."""
    if len(b) - at < 54:
        return 0
    size, _, off, head, w, h, planes, bits = struct.unpack_from("<IIIIiiHH", b, at + 2)
    rows = (abs(w) * bits + 31) // 32 * 4 * abs(h)
    fits = planes == 1 and bits in (1, 4, 8, 16, 24, 32) and head >= 40 and 14 + head <= off and w > 0 and h
    return size if fits and off + rows <= size <= len(b) - at else 0


#: Fixed values of the formats: kind, magic bytes, validator.
FORMATS: list[tuple[str, bytes, Callable[[bytes, int, Seen], int]]] = [
    ("audio/wav", b"RIFF", _wav),
    ("image/png", b"\x89PNG\r\n\x1a\n", _png),
    ("image/gif", b"GIF87a", _gif),
    ("image/gif", b"GIF89a", _gif),
    ("image/jpeg", b"\xff\xd8\xff", _jpeg),
    ("image/bmp", b"BM", _bmp),
]
_automaton = None


def _signatures():
    global _automaton
    if _automaton is None:
        made = ahocorasick.Automaton()
        for k, (_, magic, _) in enumerate(FORMATS):
            made.add_word(magic.decode("latin-1"), (k, len(magic)))
        made.make_automaton()
        _automaton = made
    return _automaton


def carve(data: bytes) -> tuple[list[Found], int]:
    """The outermost valid media in order, and how many more lie inside them."""
    found, inside = carve_all(data)
    return found, len(inside)


def carve_all(data: bytes) -> tuple[list[Found], list[Found]]:
    """The outermost valid media in order, and those that lie inside them, such as a thumbnail."""
    out, inside, end, seen = [], [], 0, {}
    hits = sorted((last - length + 1, k) for last, (k, length) in _signatures().iter(data.decode("latin-1")))
    for at, k in hits:
        if length := FORMATS[k][2](data, at, seen):
            if at < end:
                inside.append(Found(FORMATS[k][0], at, length))
            else:
                out.append(Found(FORMATS[k][0], at, length))
                end = at + length
    return out, inside


def pack_wav(payload: bytes, rate: int = RATE) -> bytes:
    """Payload bytes as 8-bit unsigned mono samples: one byte, one sample."""
    pad = len(payload) % 2
    fmt = struct.pack("<4sIHHIIHH", b"fmt ", 16, 1, 1, rate, rate, 1, 8)
    head = struct.pack("<4sI4s", b"RIFF", 36 + len(payload) + pad, b"WAVE")
    return head + fmt + struct.pack("<4sI", b"data", len(payload)) + payload + b"\0" * pad


def read_wav(data: bytes) -> tuple[int, bytes]:
    """Sample rate and the data chunk's bytes of a validated WAV."""
    at, rate = 12, 0
    while at + 8 <= len(data):
        name, size = data[at : at + 4], struct.unpack_from("<I", data, at + 4)[0]
        if name == b"fmt ":
            rate = struct.unpack_from("<I", data, at + 12)[0]
        elif name == b"data":
            return rate, data[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("no data chunk")


def pad_text(text: bytes, unit: int = 192) -> bytes:
    """A text with blanks appended up to a positive multiple of ``unit`` bytes."""
    return text + b" " * (max(unit, -len(text) // unit * -unit) - len(text))


def store_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, declared, media)``: whole texts as 8-bit WAV with an undeclared type.

    A null text is empty: its payload is blanks. Repeated rows and null ids come back as they
    went in; an empty table gives none; other columns are ignored.
    """

    def run(batches):
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            sizes = pa.array(map(len, texts), pa.int64(), size=len(texts))
            declared = pa.array(["application/octet-stream"] * len(texts), pa.string())
            media = pa.array((pack_wav(pad_text(t)) for t in texts), pa.binary(), size=len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, declared, media], ["doc_id", "n_bytes", "declared", "media"])

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    return small_batches(docs).select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"doc_id {kind}, n_bytes bigint, declared string, media binary")


def _wav_feature(data: bytes) -> tuple[bytes, str]:
    rate, payload = read_wav(data)
    samples = np.frombuffer(payload, np.uint8)
    mean = int(samples.sum(dtype=np.int64)) * 1000 // max(1, len(samples))
    above = samples >= 128
    crossings = int(np.count_nonzero(above[1:] != above[:-1]))
    return payload, f"{rate} Hz, 8 bit, {len(samples)} samples, mean {mean}/1000, range {samples.min(initial=255)}-{samples.max(initial=0)}, crossings {crossings}"


def sniff(stored: DataFrame, keep: list[str], declared_col: str = "declared", media_col: str = "media", with_parts: bool = False) -> DataFrame:
    """Types and features of a media column, from its bytes alone; the ``keep`` columns stay.

    Adds ``kind`` (the type of what begins at the first byte, else null), ``corrected`` (it
    isn't the declared one), ``carved`` and ``inner`` (counts), ``payload_bytes``,
    ``payload_sha256``, ``tail_crc32`` (of the last 16), ``media_bytes``, ``media_sha256``
    and ``feature``; with ``with_parts`` also ``parts``, the carved bytes with kind, offset and
    whether they lie inside another medium.
    The payload is a WAV's samples, another type's whole bytes. Null or empty media have no
    type and an empty payload. Rows come back as often as they went in; none from an empty table.
    """
    fields = [f for f in stored.select(*keep).schema.fields]
    parts_type = pa.list_(pa.struct([("kind", pa.string()), ("offset", pa.int64()), ("inner", pa.bool_()), ("data", pa.binary())]))

    def run(batches):
        for batch in batches:
            rows, parts = [], []
            declared = batch.column(len(keep)).to_pylist()
            for said, data in zip(declared, batch.column(len(keep) + 1).to_pylist(), strict=True):
                data = data or b""
                found, inside = carve_all(data)
                kind = found[0].kind if found and found[0].offset == 0 else None
                if kind == "audio/wav":
                    payload, feature = _wav_feature(data[: found[0].length])
                else:
                    payload, feature = data, f"{len(data)} bytes"
                feature = f"{kind or 'unknown'}: {feature}"
                rows.append((kind, kind is not None and kind != said, len(found), len(inside), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(data), hashlib.sha256(data).hexdigest(), feature))
                if with_parts:
                    parts.append([{"kind": f.kind, "offset": f.offset, "inner": nested, "data": data[f.offset : f.offset + f.length]} for nested, of in ((False, found), (True, inside)) for f in of])
            types = [pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            cols = [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]
            cols += [pa.array(parts, parts_type)] if with_parts else []
            yield pa.RecordBatch.from_arrays([batch.column(k) for k in range(len(keep))] + cols, names)

    added = "kind string, corrected boolean, carved bigint, inner bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string"
    added += ", parts array<struct<kind: string, offset: bigint, inner: boolean, data: binary>>" if with_parts else ""
    names = [f.name for f in fields] + [x.strip().split(" ")[0] for x in added.split(", parts")[0].split(",")] + ["parts"] * with_parts
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + [added])
    return small_batches(stored).select(*keep, F.col(declared_col), F.col(media_col)).mapInArrow(run, schema)
