"""GIF as a media column: lossless storage of 8-bit samples, and decoding to timed frames."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import tidy
from .textvec import texts

_GREY = bytes(v for i in range(256) for v in (i, i, i))
_ROOTS = [bytes([i]) for i in range(256)]
_FRAMES = "array<struct<frame:int,delay_ms:int,left:int,top:int,width:int,height:int,samples:binary,histogram:array<int>>>"


# --- writing ---------------------------------------------------------------------------------


def _nine_bits(codes: np.ndarray) -> bytes:
    """9-bit codes as a stream, lowest bits first; 8 codes fill 9 bytes."""
    n = len(codes)
    c = np.zeros((-(-n // 8), 8), np.uint16)
    c.ravel()[:n] = codes
    out = np.zeros((len(c), 9), np.uint8)
    for i in range(8):
        out[:, i] |= (c[:, i] << i).astype(np.uint8)
        out[:, i + 1] |= (c[:, i] >> (8 - i)).astype(np.uint8)
    return out.tobytes()[: -(-n * 9 // 8)]


def lzw_literal(samples: np.ndarray) -> bytes:
    """An LZW stream of literal codes; the table is cleared before codes would get wider."""
    n, step = len(samples), 254
    groups = -(-n // step)
    codes = np.full((groups, step + 1), 256, np.uint16)
    body = np.zeros(groups * step, np.uint16)
    body[:n] = samples
    codes[:, 1:] = body.reshape(groups, step)
    return _nine_bits(np.append(codes.ravel()[: n + groups], 257))


def lzw_compress(samples: bytes) -> bytes:
    """An LZW stream with growing codes; the table is cleared when it is full."""
    if not samples:
        return _growing_bits(np.array([256, 257]))
    # codes are held eight bits up, so that a sample behind one is a key
    clear, full = 256 << 8, 4096 << 8
    codes = [clear]
    put, table, free = codes.append, {}, 258 << 8
    get = table.get
    rest = iter(samples)
    known = next(rest) << 8
    for x in rest:
        if longer := get(known | x):
            known = longer
            continue
        put(known)
        if free < full:
            table[known | x] = free
            free += 256
        else:
            put(clear)
            table.clear()
            free = 258 << 8
        known = x << 8
    codes += (known, 257 << 8)
    return _growing_bits(np.array(codes) >> 8)


@lru_cache
def _layout(roots: int) -> tuple[np.ndarray, np.ndarray]:
    """Bits of the codes behind a clear code, by the number of roots, until they stay at 12; and the bits before each, and before the next."""
    width = np.minimum(12, np.frexp(roots + np.arange(1, 4097))[1]).astype(np.int64)
    return width, np.r_[0, np.cumsum(width)]


def _growing_bits(codes: np.ndarray) -> bytes:
    """8-bit LZW codes as a stream, lowest bits first, each as wide as the table needs there."""
    at = np.arange(len(codes))
    clear = np.maximum.accumulate(np.where(codes == 256, at, 0))
    behind = at - np.r_[0, clear[:-1]]  # codes since the clear code before each
    width = np.where(behind > 0, _layout(256)[0][np.minimum(behind, 4096) - 1], 9)
    end = np.cumsum(width)
    begin = end - width
    # a code lies in up to three bytes; no bit is another's, so that sums put them together
    byte, bits = begin >> 3, codes << (begin & 7)
    n = -(-int(end[-1]) // 8)
    return sum(np.bincount(byte + i, bits >> 8 * i & 255, n + 2) for i in range(3))[:n].astype(np.uint8).tobytes()


def _blocks(data: bytes) -> bytes:
    full = len(data) // 255
    a = np.empty((full, 256), np.uint8)
    a[:, 0] = 255
    a[:, 1:] = np.frombuffer(data, np.uint8, full * 255).reshape(full, 255)
    rest = data[full * 255 :]
    return a.tobytes() + (bytes([len(rest)]) + rest if rest else b"") + b"\0"


def write_gif(samples: bytes, width: int = 192, rows: int = 4096, delay_ms: int = 100, compress: bool = True) -> bytes:
    """A GIF89a whose grey palette shows each sample as it is; ``samples`` fills whole rows, and
    each ``rows`` rows are a frame of their own.  ``compress=False`` writes literal codes."""
    data = np.frombuffer(samples, np.uint8)
    if not len(data) or len(data) % width:
        raise ValueError("samples must fill whole rows")
    height = min(rows, len(data) // width)
    out = [b"GIF89a", struct.pack("<HHBBB", width, height, 0xF7, 0, 0), _GREY]
    for i in range(0, len(data), width * rows):
        part = data[i : i + width * rows]
        out.append(struct.pack("<BBBBHBB", 0x21, 0xF9, 4, 1 << 2, delay_ms // 10, 0, 0))
        out.append(struct.pack("<BHHHHBB", 0x2C, 0, 0, width, len(part) // width, 0, 8))
        out.append(_blocks(lzw_compress(part.tobytes()) if compress else lzw_literal(part)))
    return b"".join(out) + b"\x3b"


# --- reading ---------------------------------------------------------------------------------


def _literal(data: bytes, n: int) -> np.ndarray | None:
    """The samples of a stream of 8-bit literals that never leaves 9-bit codes, else nothing."""
    m = len(data) * 8 // 9
    if m < n:
        return None
    groups = -(-m // 8)
    b = np.zeros((groups, 10), np.uint16)
    raw = np.zeros(groups * 9, np.uint8)
    raw[: min(len(data), len(raw))] = np.frombuffer(data, np.uint8)[: len(raw)]
    b[:, :9] = raw.reshape(groups, 9)
    c = np.empty((groups, 8), np.uint16)
    for i in range(8):
        c[:, i] = ((b[:, i] >> i) | (b[:, i + 1] << (8 - i))) & 511
    c = c.ravel()[:m]
    stop = np.flatnonzero(c == 257)
    if not len(stop):
        return None
    c = c[: stop[0]]
    clear = np.flatnonzero(c == 256)
    if not len(clear) or clear[0] or (c > 257).any() or (np.diff(np.append(clear, len(c))) > 256).any():
        return None
    c = c[c < 256]
    return c.astype(np.uint8) if len(c) == n else None


def _groups(data: bytes, min_size: int) -> Iterator[np.ndarray]:
    """The codes between clear codes, up to the stop code or the end of ``data``."""
    clear, at, bits = 1 << min_size, 0, 8 * len(data)
    raw = np.frombuffer(data + b"\0\0", np.uint8).astype(np.int64)
    raw = raw[:-2] | raw[1:-1] << 8 | raw[2:] << 16
    width, ends = _layout(clear)
    group: list[np.ndarray] = []
    while True:
        if group:  # a table that was not cleared when it was full
            width, ends = np.full(4096, 12), 12 * np.arange(4097)
        m = int(np.searchsorted(ends, bits - at, "right")) - 1
        begin = at + ends[:m]
        codes = raw[begin >> 3] >> (begin & 7) & ((1 << width[:m]) - 1)
        special = np.flatnonzero((codes == clear) | (codes == clear + 1))
        last = int(special[0]) if len(special) else m
        group.append(codes[:last])
        if last == m == 4096:
            at += int(ends[-1])
            continue
        yield np.concatenate(group)
        if last == m or codes[last] != clear:
            return
        group, at = [], at + int(ends[last + 1])
        width, ends = _layout(clear)


def _words(codes: list[int], min_size: int) -> list[bytes]:
    """The words of a group's codes one by one, the plain form of ``_samples``; codes that nothing has defined yet repeat the word before with its first sample."""
    if not len(codes):
        return []
    table = [*_ROOTS[: 1 << min_size], b"", b""]
    top = len(table)
    before = table[codes[0]] if codes[0] < top else b"\0"
    words = [before]
    emit, define = words.append, table.append
    for code in codes[1:]:
        word = table[code] if code < top else before + before[:1]
        if top < 4096:
            define(before + word[:1])
            top += 1
        emit(word)
        before = word
    return words


def _samples(codes: np.ndarray, min_size: int, most: int) -> np.ndarray:
    """What the codes of a group stand for, at least the first ``most`` samples of it.  A code that is no sample stands for a word before and the
    sample behind that: for what was written from there on.  One that nothing has defined yet repeats the word before with its first sample."""
    roots, place = 1 << min_size, np.arange(len(codes))
    if not len(codes):
        return np.zeros(0, np.uint8)
    literal = codes < roots
    literal[:1] = True
    from_ = np.where(literal, place, np.minimum(codes - roots - 2, place - 1))  # the word that each repeats
    # its length is the number of words that lead to a sample; steps are doubled
    size, to = (~literal).astype(np.int64), from_
    while not literal[to].all():
        size, to = size + size[to], to[to]
    start = np.cumsum(size + 1) - size - 1
    n = int(np.searchsorted(start, most))  # words that are needed
    start, size, from_, literal, codes = start[:n], size[:n] + 1, from_[:n], literal[:n], codes[:n]
    total = int(size.sum())
    known = np.zeros(total, np.uint8)
    known[start[literal]] = np.where(codes[literal] < roots, codes[literal], 0)
    to = np.arange(total) - np.repeat(start - start[from_], size)
    while True:  # each sample is that of an earlier place, down to one that a code says
        next_ = to[to]
        if (next_ == to).all():
            return known[to]
        to = next_


def lzw_decode(data: bytes, min_size: int, n: int) -> np.ndarray:
    """The first ``n`` samples of an LZW code stream (missing ones are 0)."""
    if min_size == 8 and (fast := _literal(data, n)) is not None:
        return fast
    out = [np.zeros(0, np.uint8)]
    size = 0
    for codes in _groups(data, min_size):
        out.append(_samples(codes, min_size, n - size))
        size += len(out[-1])
        if size >= n:
            break
    got = np.concatenate(out)[:n]
    return got if len(got) == n else np.concatenate([got, np.zeros(n - len(got), np.uint8)])


@dataclass
class Frame:
    number: int
    delay_ms: int
    left: int
    top: int
    samples: np.ndarray  # palette indices of the frame's own rectangle
    colours: np.ndarray  # the whole screen after drawing: height, width, RGBA
    histogram: np.ndarray  # of these colours


def _unblock(data: bytes, at: int) -> tuple[bytes, int]:
    parts = []
    while n := data[at]:
        parts.append(data[at + 1 : at + 1 + n])
        at += n + 1
    return b"".join(parts), at + 1


def _rows(height: int) -> np.ndarray:
    """The order in which an interlaced frame's rows are stored."""
    return np.concatenate([np.arange(a, height, step) for a, step in ((0, 8), (4, 8), (2, 4), (1, 2))])


def read_gif(data: bytes) -> Iterator[Frame]:
    """All frames in order, drawn by the rules of disposal and transparency."""
    if data[:3] != b"GIF":
        raise ValueError("not a GIF")
    width, height, packed = struct.unpack_from("<HHB", data, 6)
    at, common = 13, None
    if packed & 0x80:
        n = 2 << (packed & 7)
        common = np.frombuffer(data, np.uint8, 3 * n, at).reshape(n, 3)
        at += 3 * n
    screen = np.zeros((height, width, 4), np.uint8)
    number, delay, disposal, clear = 0, 0, 0, None
    while at < len(data) and data[at] != 0x3B:
        if data[at] == 0x21:
            if data[at + 1] == 0xF9:
                flags, delay, index = struct.unpack_from("<BHB", data, at + 3)
                disposal, clear = flags >> 2 & 7, index if flags & 1 else None
            _, at = _unblock(data, at + 2)
            continue
        if data[at] != 0x2C:
            raise ValueError(f"no GIF block at {at}")
        left, top, w, h, packed = struct.unpack_from("<HHHHB", data, at + 1)
        at += 10
        palette = common
        if packed & 0x80:
            n = 2 << (packed & 7)
            palette = np.frombuffer(data, np.uint8, 3 * n, at).reshape(n, 3)
            at += 3 * n
        min_size = data[at]
        stream, at = _unblock(data, at + 1)
        samples = lzw_decode(stream, min_size, w * h).reshape(h, w)
        if packed & 0x40:
            samples = samples[np.argsort(_rows(h))]
        before = screen.copy() if disposal == 3 else None
        box = screen[top : top + h, left : left + w]
        seen = samples[: box.shape[0], : box.shape[1]]
        table = np.zeros((256, 4), np.uint8)
        if palette is not None:
            table[: len(palette), :3] = palette
        table[:, 3] = 255
        if clear is None:
            box[:] = table.view(np.uint32)[seen].view(np.uint8).reshape(box.shape)
        else:
            drawn = seen != clear
            box[drawn] = table[seen[drawn]]
        if clear is None and box.shape == screen.shape:  # nothing else is to be seen: colours are counted by their indices
            counts = np.bincount(np.where(table[:, 3] > 0, _bins(table), 64), np.bincount(seen.ravel(), minlength=256), 65)[:64].astype(np.int64)
        else:
            counts = histogram(screen)
        yield Frame(number, delay * 10, left, top, samples, screen.copy(), counts)
        if disposal == 2:
            box[:] = 0
        elif disposal == 3:
            screen = before
        number, delay, disposal, clear = number + 1, 0, 0, None


def _bins(colours: np.ndarray) -> np.ndarray:
    """The colour of 64 for each RGBA row."""
    c = colours >> 6
    return c[:, 0] * 16 + c[:, 1] * 4 + c[:, 2]


def histogram(colours: np.ndarray) -> np.ndarray:
    """Counts of 64 colours: two bits each of red, green and blue; undrawn pixels don't count."""
    c = colours.reshape(-1, 4)
    return np.bincount(_bins(c[c[:, 3] > 0]), minlength=64)


# --- columns ---------------------------------------------------------------------------------


def text_to_gif(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 192) -> DataFrame:
    """(``id_col``, n_bytes, media): each whole text as UTF-8, filled with blanks to a positive
    multiple of ``width`` bytes, stored as a GIF.  Null and empty texts are one row of blanks; equal texts
    give equal media; rows are kept one to one, with any id or none."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in texts(b.column(1)):
                n = np.diff(t.offsets)
                media = []
                for i, size in enumerate(n.tolist()):
                    raw = t.data[t.offsets[i] : t.offsets[i + 1]].tobytes()
                    media.append(write_gif(raw.ljust(max(1, -(-size // width)) * width, b" "), width))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(t.first, len(t)), pa.array(n), pa.array(media, pa.binary())], [id_col, "n_bytes", "media"])

    return docs.select(id_col, text_col).mapInArrow(tidy(run), f"`{id_col}` {kind}, n_bytes long, media binary")


def gif_frames(df: DataFrame, media_col: str = "media") -> DataFrame:
    """``df`` with ``frames``: for each media value its timed frames in order, each with the samples
    read back (palette indices by rows) and the colour histogram of the screen.  Null media have null frames;
    bytes that are no GIF fail the job;
    a column ``frames`` is replaced."""
    df = df.drop("frames")
    names = df.columns
    kind = pa.list_(pa.struct([(n, pa.int32()) for n in ("frame", "delay_ms", "left", "top", "width", "height")] + [("samples", pa.binary()), ("histogram", pa.list_(pa.int32()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = names.index(media_col)
            for t in texts(b.column(at), 1 << 21):  # runs of about 2 MB of media
                part = b.slice(t.first, len(t))
                found = [
                    None if x is None else [
                        {"frame": f.number, "delay_ms": f.delay_ms, "left": f.left, "top": f.top, "width": f.samples.shape[1], "height": f.samples.shape[0], "samples": f.samples.tobytes(), "histogram": f.histogram}
                        for f in read_gif(x)
                    ]
                    for x in part.column(at).to_pylist()
                ]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, kind)], [*names, "frames"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(tidy(run), f"{schema}, frames {_FRAMES}")
