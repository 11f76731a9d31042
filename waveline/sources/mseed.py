"""miniSEED (SEED 2.4) records to traces and back, in numpy."""

from __future__ import annotations

import datetime as dt
import io
import struct
from collections.abc import Collection, Iterator
from dataclasses import dataclass
from typing import BinaryIO

import numpy as np

#: Fixed values of the format: encodings with a plain sample type.
PLAIN = {1: "i2", 3: "i4", 4: "f4", 5: "f8"}
STEIM1, STEIM2 = 10, 11
_HEADER = 48


@dataclass
class Trace:
    station: str
    channel: str
    t0: float
    fs: float
    data: np.ndarray


def _rate(factor: int, multiplier: int) -> float:
    if factor == 0:
        return 0.0
    f = float(factor) if factor > 0 else -1.0 / factor
    return f * multiplier if multiplier > 0 else -f / multiplier if multiplier else f


def _signed(word: np.ndarray, shifts: list[int], bits: int) -> np.ndarray:
    """Fields of a word, sign-extended, leftmost first."""
    parts = np.stack([(word >> s) & ((1 << bits) - 1) for s in shifts], axis=-1).astype(np.int64)
    return np.where(parts >= 1 << (bits - 1), parts - (1 << bits), parts)


#: Fields of a compressed word by level, its code and, in level 2, its own two high bits.
_FIELDS = {
    (1, 1, None): (4, 8), (1, 2, None): (2, 16), (1, 3, None): (1, 32),
    (2, 1, None): (4, 8), (2, 2, 1): (1, 30), (2, 2, 2): (2, 15), (2, 2, 3): (3, 10),
    (2, 3, 0): (5, 6), (2, 3, 1): (6, 5), (2, 3, 2): (7, 4),
}


def decode_steim(data: bytes, n: int, level: int, order: str = ">") -> np.ndarray:
    """Samples from compressed differences; the first sample is given, the last one checked."""
    words = np.frombuffer(data[: len(data) // 64 * 64], f"{order}u4").astype(np.uint64).reshape(-1, 16)
    codes = np.stack([(words[:, 0] >> np.uint64(30 - 2 * k)) & np.uint64(3) for k in range(16)], axis=1)
    flat, code = words.ravel().astype(np.int64), codes.ravel().astype(np.int64)
    code[::16] = 0
    code[1:3] = 0
    first, last = (int(np.int64(v) - (1 << 32 if v >= 1 << 31 else 0)) for v in (flat[1], flat[2]))
    own = flat >> 30
    out = np.zeros((len(flat), 7), np.int64)
    count = np.zeros(len(flat), np.int64)
    for (lv, c, nib), (k, bits) in _FIELDS.items():
        if lv != level:
            continue
        here = (code == c) & ((own == nib) if nib is not None else True)
        out[here, :k] = _signed(flat[here], [bits * (k - 1 - i) for i in range(k)], bits)
        count[here] = k
    differences = out[np.arange(7) < count[:, None]][:n]
    if len(differences) < n:
        raise ValueError(f"{len(differences)} of {n} samples")
    samples = first + np.concatenate(([0], np.cumsum(differences[1:])))
    if n and samples[-1] != last:
        raise ValueError("the last sample differs from the header's")
    return samples


def _record(data: bytes, at: int) -> tuple[Trace | None, int]:
    """The record at a place, None if it has no samples, and its length."""
    order = ">"
    year = struct.unpack_from(">H", data, at + 20)[0]
    if not 1900 <= year <= 2100:
        order = "<"
    year, day, hour, minute, second, _, ticks, n, factor, multiplier = struct.unpack_from(f"{order}HHBBBBHHhh", data, at + 20)
    flags = data[at + 36]
    correction, begin, blockette = struct.unpack_from(f"{order}iHH", data, at + 40)
    encoding, length, micros = None, None, 0
    while blockette:
        kind, following = struct.unpack_from(f"{order}HH", data, at + blockette)
        if kind == 1000:
            encoding, word, power = data[at + blockette + 4 : at + blockette + 7]
            length = 1 << power
            sample_order = ">" if word else "<"
        elif kind == 1001:
            micros = struct.unpack_from("b", data, at + blockette + 5)[0]
        elif kind == 100:
            pass
        blockette = following
    if length is None:
        raise ValueError(f"no blockette 1000 at {at}")
    if not n:
        return None, length
    start = dt.datetime(year, 1, 1, hour, minute, min(second, 59), tzinfo=dt.UTC) + dt.timedelta(days=day - 1, seconds=second - min(second, 59))
    t0 = start.timestamp() + ticks / 1e4 + micros / 1e6 + (correction / 1e4 if not flags & 2 else 0.0)
    body = data[at + begin : at + length]
    if encoding in PLAIN:
        samples = np.frombuffer(body, sample_order + PLAIN[encoding], n)
    elif encoding in (STEIM1, STEIM2):
        samples = decode_steim(body, n, encoding - 9, sample_order)
    else:
        raise ValueError(f"encoding {encoding} isn't read")
    text = lambda a, b: data[at + a : at + b].decode("ascii", "replace").strip()
    return Trace(text(8, 13), text(15, 18), t0, _rate(factor, multiplier), samples.astype(np.float64)), length


def stream_records(f: BinaryIO, window: int = 1 << 20) -> Iterator[Trace]:
    """One trace of each record, in file order, read as the stream goes on; records without samples are left out.

    A record is at most ``window`` bytes long; no more than two windows are held.
    """
    data, at, more = b"", 0, True
    while True:
        while more and len(data) - at < window:
            part = f.read(window)
            more = bool(part)
            data, at = data[at:] + part, 0
        if at + _HEADER > len(data):
            return
        trace, length = _record(data, at)
        if trace is not None:
            yield trace
        at += length


def read_records(data: bytes) -> list[Trace]:
    """One trace of each record, in file order."""
    return list(stream_records(io.BytesIO(data)))


@dataclass
class Piece:
    """Some samples of a trace: the trace's number and start, and the place of the first."""

    seq: int
    at: int
    trace: Trace


def stream_pieces(f: BinaryIO, size: int, channels: Collection[str] | None = None) -> Iterator[Piece]:
    """The traces of a stream in pieces of ``size`` samples, or what is left, in file order.

    Records that follow on from each other, to half a sample, are one trace; traces are numbered
    in file order. With ``channels``, only these.
    """
    seq, last, held, count, done = -1, None, [], 0, 0

    def flush(n: int) -> Piece:
        nonlocal held, count, done
        whole = np.concatenate(held)
        piece = Piece(seq, done, Trace(last.station, last.channel, start, last.fs, whole[:n]))
        held, count, done = [whole[n:]] if n < len(whole) else [], count - n, done + n
        return piece

    start = 0.0
    for r in stream_records(f):
        if not (last is not None and last.channel == r.channel and last.fs == r.fs and abs(last.t0 + len(last.data) / r.fs - r.t0) < 0.5 / r.fs):
            if count:
                yield flush(count)
            seq, start, held, count, done = seq + 1, r.t0, [], 0, 0
        last = r
        if channels is not None and r.channel not in channels:
            continue
        held.append(r.data)
        count += len(r.data)
        while count >= size:
            yield flush(size)
    if count:
        yield flush(count)


def read_traces(data: bytes) -> list[Trace]:
    """Records that follow on from each other, to half a sample, as one trace."""
    out: dict[int, list[Trace]] = {}
    for p in stream_pieces(io.BytesIO(data), 1 << 20):
        out.setdefault(p.seq, []).append(p.trace)
    return [Trace(p[0].station, p[0].channel, p[0].t0, p[0].fs, np.concatenate([r.data for r in p])) for p in out.values()]


def _steim1(samples: np.ndarray, before: int) -> bytes:
    """Frames of level 1 with the narrowest words that hold the next differences."""
    d = np.diff(samples, prepend=before).tolist()
    words: list[tuple[int, int]] = []
    i = 0
    while i < len(d):
        for code, k, bits in ((1, 4, 8), (2, 2, 16), (3, 1, 32)):
            part = d[i : i + k]
            if code == 3 or len(part) == k and all(-(1 << bits - 1) <= x < 1 << bits - 1 for x in part):
                words.append((code, sum((x & (1 << bits) - 1) << bits * (len(part) - 1 - j) for j, x in enumerate(part))))
                i += k
                break
    heads = [(0, int(samples[0]) & 0xFFFFFFFF), (0, int(samples[-1]) & 0xFFFFFFFF)]
    words = heads + words
    out = b""
    for at in range(0, len(words), 15):
        frame = words[at : at + 15] + [(0, 0)] * (15 - len(words[at : at + 15]))
        control = sum(c << 28 - 2 * k for k, (c, _) in enumerate(frame))
        out += struct.pack(">16I", control, *[w for _, w in frame])
    return out


def write_traces(traces: list[Trace], network: str = "XX", encoding: int = STEIM1, power: int = 12) -> bytes:
    """Records of whole-number samples (cut toward zero), plain or compressed."""
    out, number, size = b"", 0, 1 << power
    for t in traces:
        samples = np.trunc(t.data).astype(np.int64)
        at = 0
        per = (size - 64) // 4 if encoding == 3 else (size - 64) // 64 * 15 - 2
        while at < len(samples):
            part = samples[at : at + per]
            body = part.astype(">i4").tobytes() if encoding == 3 else _steim1(part, int(samples[at - 1]) if at else int(part[0]))
            start = dt.datetime.fromtimestamp(0, dt.UTC) + dt.timedelta(microseconds=round((t.t0 + at / t.fs) * 1e6))
            number += 1
            ticks, micros = divmod(start.microsecond, 100)
            rate = (round(t.fs), 1) if t.fs >= 1 and t.fs == round(t.fs) else (round(t.fs * 1000), -1000)
            head = f"{number % 1_000_000:06d}D ".encode() + t.station.ljust(5)[:5].encode() + b"  " + t.channel.ljust(3)[:3].encode() + network.ljust(2)[:2].encode()
            head += struct.pack(">HHBBBBHHhhBBBBiHH", start.year, start.timetuple().tm_yday, start.hour, start.minute, start.second, 0, ticks, len(part), *rate, 0, 0, 0, 2, 0, 64, 48)
            head += struct.pack(">HHBBBB", 1000, 56, encoding, 1, power, 0) + struct.pack(">HHBbBB", 1001, 0, 100, micros, 0, 0)
            out += (head + body).ljust(size, b"\0")
            at += len(part)
    return out
