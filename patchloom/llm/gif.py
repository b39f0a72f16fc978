"""GIF media columns: lossless storage of bytes as frames, and a reader of timed frames.

The reader takes any GIF: it decodes LZW code streams, applies global and local
palettes, transparency and disposal, and gives each frame's time and colour
histogram.  The writer stores a payload as frames of 24 x 24 samples with a grey
palette.  A sample that the frame before has at its place is left transparent,
where a byte is free to say so; the rest is a compressed code stream.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchloom.llm import kernels
from patchloom.llm.session import prepare, schema_of, with_names

SIDE = 24
SAMPLES = SIDE * SIDE
FILL = 255
DELAY = 10
BINS = 8
CHUNK_BYTES = 1 << 20
#: A screen or frame has at most so many samples, and a GIF's screens together.
MOST_PIXELS, MOST_SAMPLES = 1 << 24, 1 << 31
#: Streams of frames up to this size are decoded together, 1,024 at a time.
ALIKE_PIXELS = 1 << 10
#: Frames are encoded so many at a time; their tables take up to 430 KB each, with text about 100 KB.
FRAMES_AT_ONCE = 256
#: UTF-8 never has this byte, so frames of text can use it as the transparent index.
CLEAR_INDEX = 0xF5
CODE_SIZE, LONGEST = 8, 12

HEADER = b"GIF89a" + bytes([SIDE, 0, SIDE, 0, 0xF7, 0, 0]) + bytes(c for i in range(256) for c in (i, i, i))
TRAILER = b"\x3b"


class GifError(ValueError):
    """The bytes are not a GIF that can be read."""


def _pad(text: bytes) -> bytes:
    return text + bytes([FILL]) * (max(1, -(-len(text) // SAMPLES)) * SAMPLES - len(text))


def lzw_codes(samples: bytes, code_size: int = CODE_SIZE) -> list[int]:
    """The code stream of a frame: a clear code, the longest known runs, the stop code; cleared again when the table is full."""
    clear = 1 << code_size
    table: dict[int, int] = {}
    known, new = table.get, clear + 2
    codes, run = [clear], samples[0] if samples else -1
    put = codes.append
    for sample in samples[1:]:
        key = run << 8 | sample
        longer = known(key)
        if longer is not None:
            run = longer
            continue
        put(run)
        run = sample
        table[key] = new
        new += 1
        if new == 1 << LONGEST:
            put(clear)
            table.clear()
            new = clear + 2
    if run >= 0:
        put(run)
    put(clear + 1)
    return codes


def code_widths(since: np.ndarray, code_size: int) -> np.ndarray:
    """Bits of the codes by their place after a clear code, whose own place is 0: as many as a reader's table asks for by then."""
    entries = (1 << code_size) + 2 + np.maximum(since - 2, 0)
    return np.clip(np.ceil(np.log2(entries + 1)).astype(np.int64), code_size + 1, LONGEST)


def packed_codes(codes: list[int], code_size: int = CODE_SIZE) -> bytes:
    """A code stream as bytes, lowest bits first."""
    values, place = np.array(codes, np.uint32), np.arange(len(codes))
    starts = np.flatnonzero(values == 1 << code_size)
    width = code_widths(place - starts[np.maximum(np.searchsorted(starts, place, "left") - 1, 0)], code_size)
    bit = np.arange(LONGEST)
    bits = (values[:, None] >> bit & 1).astype(np.uint8)
    return np.packbits(bits[bit < width[:, None]], bitorder="little").tobytes()


def _codes_alike(frames: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The codes of ``lzw_codes`` for rows of samples too few to fill a table, sample by sample for all rows at once, and their numbers."""
    n, size = frames.shape
    symbols, dense = np.unique(frames, return_inverse=True)
    dense, own, rows = dense.reshape(n, size).astype(np.int64), len(symbols), len(symbols) + size
    table = np.zeros(n * rows * own, np.uint16)
    base = np.arange(n) * (rows * own)
    codes = np.zeros((n, size + 2), np.uint16)
    codes[:, 0] = 1 << CODE_SIZE
    count, new, run = np.ones(n, np.int64), np.full(n, own), dense[:, 0]
    named = np.concatenate([symbols.astype(np.uint16), np.arange((1 << CODE_SIZE) + 2, (1 << CODE_SIZE) + 2 + size, dtype=np.uint16)])
    for k in range(1, size):
        sample = dense[:, k]
        place = base + run * own + sample
        longer = table[place]
        miss = np.flatnonzero(longer == 0)
        codes[miss, count[miss]] = named[run[miss]]
        count[miss] += 1
        table[place[miss]] = new[miss]
        new[miss] += 1
        run = longer.astype(np.int64)
        run[miss] = sample[miss]
    codes[np.arange(n), count] = named[run]
    codes[np.arange(n), count + 1] = (1 << CODE_SIZE) + 1
    return codes, count + 2


def _packed_alike(frames: np.ndarray) -> list[bytes]:
    """The code streams of many frames as bytes."""
    codes, n = _codes_alike(frames)
    codes = codes[:, : int(n.max())]
    width = code_widths(np.arange(codes.shape[1]), CODE_SIZE)
    parts = [codes[:, width == w][:, :, None] >> np.arange(w, dtype=np.uint16) & 1 for w in np.unique(width).tolist()]
    packed = np.packbits(np.concatenate([p.astype(np.uint8).reshape(len(n), -1) for p in parts], axis=1), axis=1, bitorder="little")
    return [packed[i, :k].tobytes() for i, k in enumerate((-(-np.cumsum(width)[n - 1] // 8)).tolist())]


def _blocks(data: bytes) -> bytes:
    return b"".join(bytes([len(data[lo : lo + 255])]) + data[lo : lo + 255] for lo in range(0, len(data), 255)) + b"\0"


def write(payloads: list[bytes]) -> list[bytes]:
    """A GIF for each payload, whose length is a positive multiple of 576."""
    frames = np.frombuffer(b"".join(payloads), np.uint8).reshape(-1, SAMPLES)
    first = np.cumsum([0, *(len(p) // SAMPLES for p in payloads)])
    has = (frames == CLEAR_INDEX).any(1)
    follows = np.ones(len(frames), bool)
    follows[first[:-1]] = False
    follows[1:] &= ~has[1:] & ~has[:-1]
    shown = frames.copy()
    shown[1:][follows[1:, None] & (frames[1:] == frames[:-1])] = CLEAR_INDEX
    streams: list[bytes] = []
    for at in range(0, len(shown), FRAMES_AT_ONCE):
        streams += _packed_alike(shown[at : at + FRAMES_AT_ONCE])
    made = [bytes([0x21, 0xF9, 4, 1 << 2 | flag, DELAY, 0, CLEAR_INDEX, 0, 0x2C, 0, 0, 0, 0, SIDE, 0, SIDE, 0, 0, CODE_SIZE]) + _blocks(data) for flag, data in zip(follows.tolist(), streams, strict=True)]
    return [b"".join([HEADER, *made[lo:hi], TRAILER]) for lo, hi in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]


class Frame(NamedTuple):
    left: int
    top: int
    width: int
    height: int
    interlaced: bool
    palette: bytes
    disposal: int
    transparent: int
    delay: int
    code_size: int
    data: bytes


def _sub_blocks(raw: bytes, at: int) -> tuple[bytes, int]:
    parts = []
    while n := raw[at]:
        parts.append(raw[at + 1 : at + 1 + n])
        at += 1 + n
    return b"".join(parts), at + 1


def parse(raw: bytes) -> tuple[int, int, list[Frame]]:
    """Screen width, height and the frames with their control values; GifError if cut short or no GIF."""
    try:
        if raw[:6] not in (b"GIF87a", b"GIF89a"):
            raise GifError("no GIF header")
        width, height, flags = raw[6] | raw[7] << 8, raw[8] | raw[9] << 8, raw[10]
        at = 13
        shared = b""
        if flags & 0x80:
            n = 3 << (flags & 7) + 1
            shared, at = raw[at : at + n], at + n
        frames, disposal, transparent, delay = [], 0, -1, 0
        while (kind := raw[at]) != 0x3B:
            if kind == 0x21:
                label = raw[at + 1]
                if label == 0xF9:
                    packed = raw[at + 3]
                    disposal, delay, transparent = packed >> 2 & 7, raw[at + 4] | raw[at + 5] << 8, raw[at + 6] if packed & 1 else -1
                _, at = _sub_blocks(raw, at + 2)
            elif kind == 0x2C:
                left, top, w, h = (raw[at + i] | raw[at + i + 1] << 8 for i in (1, 3, 5, 7))
                packed, at = raw[at + 9], at + 10
                palette = shared
                if packed & 0x80:
                    n = 3 << (packed & 7) + 1
                    palette, at = raw[at : at + n], at + n
                code_size = raw[at]
                data, at = _sub_blocks(raw, at + 1)
                frames.append(Frame(left, top, w, h, bool(packed & 0x40), palette, disposal, transparent, delay, code_size, data))
                disposal, transparent, delay = 0, -1, 0
            else:
                raise GifError(f"unknown block {kind}")
        return width, height, frames
    except IndexError:
        raise GifError("cut short") from None


def lzw_decode(data: bytes, code_size: int, size: int) -> bytes:
    """The first ``size`` samples of a code stream; missing ones are 0."""
    if not 1 <= code_size <= 8:
        raise GifError(f"code size {code_size}")
    clear, stop = 1 << code_size, (1 << code_size) + 1
    roots = [bytes([i]) for i in range(clear)] + [b"", b""]
    table, width, before, last = roots[:], code_size + 1, b"", 1 << LONGEST
    out, made, held, bits, mask = [], 0, 0, 0, (1 << code_size + 1) - 1
    put, grow, known = out.append, table.append, len(roots)
    for byte in data:
        held |= byte << bits
        bits += 8
        while bits >= width:
            code = held & mask
            held >>= width
            bits -= width
            if code == clear:
                table, width, before, known = roots[:], code_size + 1, b"", len(roots)
                mask, grow = (1 << width) - 1, table.append
                continue
            if code == stop or made >= size:
                return (b"".join(out) + bytes(max(0, size - made)))[:size]
            if code < known:
                entry = table[code]
            elif code == known and before:
                entry = before + before[:1]
            else:
                raise GifError("code beyond the table")
            put(entry)
            made += len(entry)
            if before and known < last:
                grow(before + entry[:1])
                known += 1
                if known > mask and width < LONGEST:
                    width += 1
                    mask = (1 << width) - 1
            before = entry
    return (b"".join(out) + bytes(max(0, size - made)))[:size]


def _alike(data: list[bytes], code_size: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Samples of many streams that are cleared at their start only, and which of them are so and whole.

    Code by code for all streams at once.  A table's entry is the string of a
    code and the sample after it, so it stands in the output where that code
    was met; each sample points to where it stands first, until it is a root.
    """
    clear, n = 1 << code_size, len(data)
    longest = max(map(len, data))
    raw = np.zeros((n, longest + 3), np.uint32)
    for i, d in enumerate(data):
        raw[i, : len(d)] = np.frombuffer(d, np.uint8)
    width = code_widths(np.arange(longest * 8 // (code_size + 1)), code_size)
    at = np.cumsum(width) - width
    at, width = at[at + width <= longest * 8], width[at + width <= longest * 8]
    byte = at >> 3
    codes = ((raw[:, byte] | raw[:, byte + 1] << 8 | raw[:, byte + 2] << 16) >> (at & 7).astype(np.uint32) & ((1 << width) - 1).astype(np.uint32)).astype(np.int32)
    stops = codes == clear + 1
    end = np.where(stops.any(1), stops.argmax(1), 0)
    inside = np.arange(codes.shape[1]) < end[:, None]
    good = (codes[:, 0] == clear) & (end > 0) & (((codes == clear) & inside).sum(1) == 1)
    length, start = np.zeros(codes.shape, np.int32), np.zeros(codes.shape, np.int32)
    total, row = np.zeros(n, np.int64), np.arange(n)
    for j in range(1, int(end.max(initial=0))):
        of = codes[:, j] - (clear + 1)
        root = codes[:, j] < clear
        good &= root | (of < j) | ~inside[:, j]
        own = np.where(root, 1, length[row, np.clip(of, 0, j - 1)] + 1) * inside[:, j]
        length[:, j], start[:, j] = own, total
        total += own
        good &= total <= size
        if not good.any():
            break
    out = np.zeros((n, size), np.uint8)
    if not good.any():
        return out, good
    stream, j = np.nonzero(inside & good[:, None] & (length > 0))
    code, n_out = codes[stream, j], length[stream, j]
    to = stream * size + start[stream, j]
    root = code < clear
    value, point = np.zeros(n * size, np.uint8), np.arange(n * size, dtype=np.int32)
    value[to[root]] = code[root]
    to, n_out, stream, of = to[~root], n_out[~root], stream[~root], code[~root] - (clear + 1)
    back = to - (stream * size + start[stream, of])
    each = np.repeat(to - (np.cumsum(n_out) - n_out), n_out) + np.arange(int(n_out.sum()))
    point[each] = each - np.repeat(back, n_out)
    while True:
        further = point[point]
        if (further == point).all():
            return value[point].reshape(n, size), good
        point = further


def samples(frames: list[Frame]) -> list[np.ndarray]:
    """The palette indices of each frame, top to bottom; streams of a kind are decoded together."""
    out: list[np.ndarray | None] = [None] * len(frames)
    kinds: dict[tuple[int, int], list[int]] = {}
    for i, f in enumerate(frames):
        if f.width * f.height > MOST_PIXELS:
            raise GifError("frame too large")
        if 1 <= f.code_size <= 8 and f.data and f.width * f.height <= ALIKE_PIXELS:
            kinds.setdefault((f.code_size, f.width * f.height), []).append(i)
    for (code_size, size), own in kinds.items():
        for lo in range(0, len(own), 1024):
            some = own[lo : lo + 1024]
            got, good = _alike([frames[i].data for i in some], code_size, size)
            for k in np.flatnonzero(good).tolist():
                out[some[k]] = got[k]
    for i, f in enumerate(frames):
        flat = out[i] if out[i] is not None else np.frombuffer(lzw_decode(f.data, f.code_size, f.width * f.height), np.uint8)
        if f.interlaced and f.height:
            rows = [r for first, step in ((0, 8), (4, 8), (2, 4), (1, 2)) for r in range(first, f.height, step)]
            straight = np.empty((f.height, f.width), np.uint8)
            straight[rows] = flat.reshape(f.height, f.width)
            flat = straight.ravel()
        out[i] = flat
    return out


def _colours(palette: bytes) -> np.ndarray:
    table = np.zeros((256, 3), np.uint8)
    own = np.frombuffer(palette[: len(palette) // 3 * 3], np.uint8).reshape(-1, 3)
    table[: len(own)] = own
    return table


def canvases(width: int, height: int, frames: list[Frame], indices: list[np.ndarray] | None = None) -> Iterator[np.ndarray]:
    """The screen (height, width, 3) after each frame, good until the next; what no frame has drawn is black."""
    if width * height > MOST_PIXELS or width * height * len(frames) > MOST_SAMPLES:
        raise GifError("screen too large")
    screen = np.zeros((height, width, 3), np.uint8)
    palette, colours = None, None
    for f, index in zip(frames, samples(frames) if indices is None else indices, strict=True):
        if f.palette != palette:
            palette, colours = f.palette, _colours(f.palette)
        before = screen.copy() if f.disposal == 3 else None
        box = (slice(f.top, min(f.top + f.height, height)), slice(f.left, min(f.left + f.width, width)))
        part = index.reshape(f.height, f.width)[: max(0, height - f.top), : max(0, width - f.left)]
        if f.transparent < 0:
            screen[box] = colours[part]
        else:
            drawn = part != f.transparent
            screen[box][drawn] = colours[part[drawn]]
        yield screen
        if f.disposal == 2:
            screen[box] = 0
        elif before is not None:
            screen = before


def _histogram(screen: np.ndarray) -> list[int]:
    """``BINS`` counts for each of red, green and blue."""
    bins = (screen.reshape(-1, 3) >> 5) + np.arange(0, 3 * BINS, BINS, dtype=np.uint8)
    return np.bincount(bins.ravel(), minlength=3 * BINS).tolist()


def read(media: list[bytes]) -> Iterator[tuple[bytes, list[tuple[int, int, list[int]]]]]:
    """Per GIF: the red samples of all its screens, and each frame's start and length in ms with its colour histogram."""
    parsed = [parse(raw) for raw in media]
    every, at = samples([f for _, _, frames in parsed for f in frames]), 0
    for width, height, frames in parsed:
        own = every[at : at + len(frames)]
        at += len(frames)
        red, timed, start = [], [], 0
        for f, screen in zip(frames, canvases(width, height, frames, own), strict=True):
            red.append(screen[..., 0].tobytes())
            timed.append((start, f.delay * 10, _histogram(screen)))
            start += f.delay * 10
        yield b"".join(red), timed


def _store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = kernels.text_buffer(batch.column(1))
        for lo, hi in kernels.doc_chunks(offsets, CHUNK_BYTES):
            texts = [data[offsets[i] : offsets[i + 1]].tobytes() for i in range(lo, hi)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array([len(t) for t in texts], pa.int64()), pa.array(write([_pad(t) for t in texts]), pa.binary())], ["doc_id", "n_bytes", "media"])


def store_texts(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_bytes`` and the GIF ``media`` that holds each text's UTF-8 bytes, padded with 255.

    A null text is empty and has one frame.  Rows are kept as they are, also
    when repeated; other columns are not read; an empty table stays empty.
    """
    prepare(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(_store, f"doc_id {id_type}, n_bytes bigint, media binary")


FRAMES = "array<struct<start_ms:bigint,length_ms:bigint,histogram:array<bigint>>>"


def _decode(media_at: int):
    kind = pa.list_(pa.struct([("start_ms", pa.int64()), ("length_ms", pa.int64()), ("histogram", pa.list_(pa.int64()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payload, frames, errors = [], [], []
            for raw in batch.column(media_at).to_pylist():
                try:
                    got, timed = next(read([raw])) if raw is not None else (None, None)
                    error = None
                except GifError as e:
                    got = timed = None
                    error = str(e)
                payload.append(got)
                frames.append(None if timed is None else [{"start_ms": s, "length_ms": n, "histogram": h} for s, n, h in timed])
                errors.append(error)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(payload, pa.binary()), pa.array(frames, kind), pa.array(errors, pa.string())], [*batch.schema.names, "samples", "frames", "error"])

    return run


def decode_media(table: DataFrame, column: str = "media") -> DataFrame:
    """The rows with the GIF's screen ``samples``, its timed ``frames`` and an ``error`` where it can't be read.

    Columns of those names in ``table`` are replaced; null media give nulls;
    media that are cut short, no GIF, or larger than ``MOST_PIXELS`` and
    ``MOST_SAMPLES`` allow have an error; an empty table stays empty.
    """
    prepare(table.sparkSession)
    table = table.drop(*(c for c in ("samples", "frames", "error") if c != column))
    plain = lambda d: d.mapInArrow(_decode(d.columns.index(column)), f"{schema_of(d)}, samples binary, frames {FRAMES}, error string")
    return with_names(table, [column], plain)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, media = [], [x.as_buffer() for x in batch.column(2)]
        lo = 0
        while lo < len(media):
            hi, size = lo, 0
            while hi < len(media) and (hi == lo or size + len(media[hi]) <= CHUNK_BYTES):
                size += len(media[hi])
                hi += 1
            some = [m.to_pybytes() for m in media[lo:hi]]
            for raw, (payload, timed) in zip(some, read(some), strict=True):
                grey = np.sum([h[:BINS] for _, _, h in timed], axis=0)
                feature = f"{len(timed)}x{sum(n for _, n, _ in timed)}ms:" + ",".join(map(str, grey.tolist()))
                rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(raw), hashlib.sha256(raw).hexdigest(), feature))
            lo = hi
        columns = list(zip(*rows, strict=True)) if rows else [()] * 6
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True))], ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])


def media_digests(docs: DataFrame) -> DataFrame:
    """What is read back from each text's stored GIF, as digests and a feature string.

    Null and empty texts have one frame of filling; a text of any length is
    stored whole; equal texts have equal values; repeated rows stay; other
    columns are not read; an empty table stays empty.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return store_texts(docs).mapInArrow(_digest, f"doc_id {id_type}, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string")
