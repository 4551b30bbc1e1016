"""ISO media containers: a walk over nested boxes, decoded sample tables, and columns about the media.

``write`` stores bytes losslessly as an uncompressed video track of 8 by 8 grey pixels, 64 bytes a sample.
``walk`` and ``describe`` read any ISO container: codec, duration and the byte ranges of keyframes come from the
boxes alone; no payload is decoded. Files are built and read inside one task and row, so memory follows the
longest text, not the table.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import only, raw

SAMPLE, CHUNK_SAMPLES, GROUP, RATE, DEEPEST = 64, 1024, 32, 25, 32

#: Boxes that hold boxes, and how many bytes stand before the first of them.
NESTED = {b"moov": 0, b"trak": 0, b"mdia": 0, b"minf": 0, b"dinf": 0, b"stbl": 0, b"edts": 0, b"udta": 0, b"mvex": 0, b"moof": 0, b"traf": 0, b"meta": 4, b"dref": 8}
MATRIX = struct.pack(">9i", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)


class MediaError(ValueError):
    """The bytes are no ISO container, or one whose tables contradict each other."""


def box(kind: bytes, *content: bytes) -> bytes:
    size = 8 + sum(map(len, content))
    if size < 1 << 32:
        return b"".join((struct.pack(">I4s", size, kind), *content))
    return b"".join((struct.pack(">I4sQ", 1, kind, size + 8), *content))


def full(kind: bytes, version: int, flags: int, *content: bytes) -> bytes:
    return box(kind, struct.pack(">I", version << 24 | flags), *content)


def padded(payload: bytes, unit: int = SAMPLE) -> bytes:
    """payload with zero bytes up to a positive multiple of unit."""
    return payload + bytes(-len(payload) % unit or (unit if not payload else 0))


def write(payload: bytes, group: int = GROUP, chunk_samples: int = CHUNK_SAMPLES) -> bytes:
    """A container whose samples are payload, in order; payload is a positive multiple of SAMPLE bytes."""
    n = len(payload) // SAMPLE
    if not n or len(payload) % SAMPLE:
        raise MediaError(f"a payload of {len(payload)} bytes is no positive multiple of {SAMPLE}")
    chunks = -(-n // chunk_samples)
    tail = n - (chunks - 1) * chunk_samples
    runs = [(1, min(n, chunk_samples), 1)] + ([(chunks, tail, 1)] if chunks > 1 and tail != chunk_samples else [])
    keys = np.arange(1, n + 1, group, dtype=">u4")
    entry = box(b"raw ", bytes(6), struct.pack(">HHHIIIHHIIIH32sHh", 1, 0, 0, 0, 0, 0, 8, 8, 0x480000, 0x480000, 0, 1, b"", 40, -1))
    head = box(b"ftyp", b"isom", struct.pack(">I", 512), b"isom", b"iso2")

    def moov(first: int) -> bytes:
        at = first + np.arange(chunks, dtype=np.int64) * (chunk_samples * SAMPLE)
        wide = first + len(payload) >= 1 << 32
        table = box(
            b"stbl",
            full(b"stsd", 0, 0, struct.pack(">I", 1), entry),
            full(b"stts", 0, 0, struct.pack(">III", 1, n, 1)),
            full(b"stss", 0, 0, struct.pack(">I", len(keys)), keys.tobytes()),
            full(b"stsc", 0, 0, struct.pack(">I", len(runs)), *(struct.pack(">III", *r) for r in runs)),
            full(b"stsz", 0, 0, struct.pack(">II", SAMPLE, n)),
            full(b"co64" if wide else b"stco", 0, 0, struct.pack(">I", chunks), at.astype(">u8" if wide else ">u4").tobytes()),
        )
        track = box(
            b"trak",
            full(b"tkhd", 1, 7, struct.pack(">QQIIQ8shhhH", 0, 0, 1, 0, n, b"", 0, 0, 0, 0), MATRIX, struct.pack(">II", 8 << 16, 8 << 16)),
            box(
                b"mdia",
                full(b"mdhd", 1, 0, struct.pack(">QQIQHH", 0, 0, RATE, n, 0x55C4, 0)),
                full(b"hdlr", 0, 0, struct.pack(">I4s12s", 0, b"vide", b""), b"grey\0"),
                box(b"minf", full(b"vmhd", 0, 1, bytes(8)), box(b"dinf", full(b"dref", 0, 0, struct.pack(">I", 1), full(b"url ", 0, 1))), table),
            ),
        )
        return box(b"moov", full(b"mvhd", 1, 0, struct.pack(">QQIQIH10s", 0, 0, RATE, n, 0x10000, 0x100, b""), MATRIX, bytes(24), struct.pack(">I", 2)), track)

    first = len(head) + len(moov(0)) + (8 if len(payload) + 8 < 1 << 32 else 16)
    index = moov(first)
    first = len(head) + len(index) + (8 if len(payload) + 8 < 1 << 32 else 16)
    return b"".join((head, moov(first), box(b"mdat", payload)))


def walk(data, start: int = 0, end: int | None = None, path: tuple[bytes, ...] = ()):
    """Yields (path, start of content, end) of each box, outer ones first. Boxes nested deeper than DEEPEST are an error."""
    if len(path) > DEEPEST:
        raise MediaError(f"boxes are nested deeper than {DEEPEST}")
    end = len(data) if end is None else end
    while start + 8 <= end:
        size, kind = struct.unpack_from(">I4s", data, start)
        head = 8
        if size == 1:
            if start + 16 > end:
                raise MediaError("a large box's size is cut off")
            (size,) = struct.unpack_from(">Q", data, start + 8)
            head = 16
        elif size == 0:
            size = end - start
        if size < head or start + size > end:
            raise MediaError(f"box {kind!r} at {start} doesn't fit into what holds it")
        here = (*path, kind)
        yield here, start + head, start + size
        if kind in NESTED:
            yield from walk(data, start + head + NESTED[kind], start + size, here)
        start += size


@dataclass
class Track:
    """One track's tables, decoded; samples of fragments come after those of the sample table."""

    number: int = 0
    handler: str = ""
    codec: str = ""
    width: int = 0
    height: int = 0
    timescale: int = 0
    duration: int = 0
    offsets: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    sizes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    lengths: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def ranges(self, which: np.ndarray | None = None) -> list[tuple[int, int]]:
        """Byte ranges (offset, length) of samples, neighbours in the file as one."""
        at, size = (self.offsets, self.sizes) if which is None else (self.offsets[which], self.sizes[which])
        if not len(at):
            return []
        first = np.concatenate(([True], at[1:] != at[:-1] + size[:-1]))
        begin = np.flatnonzero(first)
        return list(zip(at[begin].tolist(), np.add.reduceat(size, begin).tolist(), strict=True))


def _numbers(data, at: int, count: int, kind: str, end: int) -> np.ndarray:
    width = np.dtype(kind).itemsize
    if at + count * width > end:
        raise MediaError("a table is longer than its box")
    return np.frombuffer(data, kind, count, at).astype(np.int64)


def tracks(data) -> list[Track]:
    """All tracks of a container, fragments included. A file without moov, or with broken tables, raises MediaError.

    Whatever a table claims is checked against its box and the file before anything of that size is made.
    """
    try:
        return _tracks(data)
    except (struct.error, IndexError, ValueError, OverflowError) as e:
        raise MediaError(str(e) or type(e).__name__) from None


def _tracks(data) -> list[Track]:
    found: list[Track] = []
    tables: list[dict[bytes, tuple[int, int]]] = []
    defaults: dict[int, tuple[int, int, int]] = {}
    moofs: list[tuple[int, list]] = []
    seen = False
    for path, a, b in walk(data):
        kind = path[-1]
        seen |= path == (b"moov",)
        if path == (b"moof",):
            moofs.append((a - 8 if struct.unpack_from(">I", data, a - 8)[0] != 1 and bytes(data[a - 4 : a]) == b"moof" else a - 16, []))
        elif path == (b"moof", b"traf"):
            moofs[-1][1].append(([], []))
        elif path == (b"moof", b"traf", b"tfhd"):
            moofs[-1][1][-1][0].append((a, b))
        elif path == (b"moof", b"traf", b"trun"):
            moofs[-1][1][-1][1].append((a, b))
        elif path == (b"moov", b"mvex", b"trex"):
            _holds(a, b, 24)
            number, _, length, size, flags = struct.unpack_from(">5I", data, a + 4)
            defaults[number] = length, size, flags
        elif path == (b"moov", b"trak"):
            found.append(Track())
            tables.append({})
        elif path[:2] == (b"moov", b"trak"):
            track = found[-1]
            if kind == b"tkhd":
                at = a + (20 if data[a] == 1 else 12)
                _holds(at, b, 4)
                (track.number,) = struct.unpack_from(">I", data, at)
            elif kind == b"mdhd":
                wide = data[a] == 1
                _holds(a, b, 32 if wide else 20)
                track.timescale, track.duration = struct.unpack_from(">IQ" if wide else ">II", data, a + (20 if wide else 12))
            elif kind == b"hdlr" and b"mdia" in path:
                _holds(a, b, 12)
                track.handler = bytes(data[a + 8 : a + 12]).decode("latin-1")
            elif kind == b"stsd":
                _holds(a, b, 16)
                track.codec = bytes(data[a + 12 : a + 16]).decode("latin-1")
                if track.handler == "vide" and a + 44 <= b:
                    track.width, track.height = struct.unpack_from(">HH", data, a + 40)
            elif path[-2] == b"stbl":
                tables[-1][kind] = a, b
    if not seen:
        raise MediaError("there is no moov box")
    for track, table in zip(found, tables, strict=True):
        _samples(track, data, table)
    by = {t.number: t for t in found}
    for begin, trafs in moofs:
        end = begin
        for k, (heads, runs) in enumerate(trafs):
            if not heads:
                raise MediaError("a fragment has no header")
            end = _fragment(by, defaults, data, begin, begin if k == 0 else end, heads[0], runs)
    for track in found:
        track.duration = max(track.duration, int(track.lengths.sum()))
    return found


def _holds(a: int, b: int, n: int) -> None:
    if a + n > b:
        raise MediaError("a box is too short for its fields")


def _sizes(data, table: dict[bytes, tuple[int, int]]) -> np.ndarray:
    if b"stsz" in table:
        a, b = table[b"stsz"]
        _holds(a, b, 12)
        each, n = struct.unpack_from(">II", data, a + 4)
        if each and each * n > len(data):
            raise MediaError("samples are larger than the file")
        return np.full(n, each, np.int64) if each else _numbers(data, a + 12, n, ">u4", b)
    if b"stz2" in table:
        a, b = table[b"stz2"]
        _holds(a, b, 12)
        width, n = data[a + 7], struct.unpack_from(">I", data, a + 8)[0]
        if width == 4:
            pairs = _numbers(data, a + 12, (n + 1) // 2, ">u1", b)
            return np.stack((pairs >> 4, pairs & 15), 1).ravel()[:n]
        if width not in (8, 16):
            raise MediaError(f"sample sizes of {width} bits")
        return _numbers(data, a + 12, n, f">u{width // 8}", b)
    return np.zeros(0, np.int64)


def _samples(track: Track, data, table: dict[bytes, tuple[int, int]]) -> None:
    def count(kind: bytes) -> tuple[int, int, int]:
        a, b = table[kind]
        _holds(a, b, 8)
        return a + 8, struct.unpack_from(">I", data, a + 4)[0], b

    track.sizes = _sizes(data, table)
    n = len(track.sizes)
    if b"stts" in table:
        a, m, b = count(b"stts")
        runs = _numbers(data, a, 2 * m, ">u4", b).reshape(-1, 2)
        if runs[:, 0].sum() != n:
            raise MediaError(f"the time table has {runs[:, 0].sum()} samples, the size table {n}")
        track.lengths = np.repeat(runs[:, 1], runs[:, 0])
    else:
        track.lengths = np.zeros(n, np.int64)
    wide = b"co64" in table
    if wide or b"stco" in table:
        a, m, b = count(b"co64" if wide else b"stco")
        chunks = _numbers(data, a, m, ">u8" if wide else ">u4", b)
        runs = np.zeros((0, 3), np.int64)
        if b"stsc" in table:
            a, m, b = count(b"stsc")
            runs = _numbers(data, a, 3 * m, ">u4", b).reshape(-1, 3)
        if len(runs) and len(chunks):
            if (np.diff(runs[:, 0]) <= 0).any() or runs[0, 0] != 1 or runs[-1, 0] > len(chunks):
                raise MediaError("runs of chunks aren't in order")
            per = np.repeat(runs[:, 1], np.diff(np.append(runs[:, 0] - 1, len(chunks))))
            if per.sum() != n:
                raise MediaError(f"chunks hold {per.sum()} samples, the size table {n}")
            first = np.cumsum(per) - per
            before = np.cumsum(track.sizes) - track.sizes
            chunk = np.repeat(np.arange(len(per)), per)
            track.offsets = chunks[chunk] + before - before[first[chunk]] if n else chunks[:0]
    _inside(track.offsets, track.sizes, data)
    if len(track.offsets) != n:
        raise MediaError("samples have no place")
    if b"stss" in table:
        a, m, b = count(b"stss")
        track.keys = _numbers(data, a, m, ">u4", b) - 1
        if len(track.keys) and not 0 <= track.keys.min() <= track.keys.max() < n:
            raise MediaError("a keyframe isn't among the samples")
    else:  # without the table every sample is one
        track.keys = np.arange(n)


def _inside(offsets: np.ndarray, sizes: np.ndarray, data) -> None:
    if len(offsets) and (offsets.min() < 0 or (offsets + sizes[: len(offsets)]).max() > len(data)):
        raise MediaError("samples lie outside the file")


def _fragment(by: dict[int, Track], defaults: dict[int, tuple[int, int, int]], data, moof: int, begin: int, head: tuple[int, int], runs: list[tuple[int, int]]) -> int:
    """Adds the samples of one track's runs in a fragment and returns where its data ends.

    A run says where its data begins, from the fragment's base; else it follows the run before it. What a run
    doesn't say of its samples is in the fragment's header, or in the track's defaults.
    """
    a, b = head
    _holds(a, b, 8)
    flags, number = struct.unpack_from(">II", data, a)
    flags &= 0xFFFFFF
    track, own = by.get(number), dict(zip(("length", "size", "flags"), defaults.get(number, (0, 0, 0)), strict=True))
    if track is None:
        raise MediaError(f"a fragment is of track {number}, which isn't there")
    at, base = a + 8, moof if flags & 0x20000 else begin
    for bit, name, width in ((0x1, "base", 8), (0x2, "entry", 4), (0x8, "length", 4), (0x10, "size", 4), (0x20, "flags", 4)):
        if flags & bit:
            _holds(at, b, width)
            (own[name],) = struct.unpack_from(">Q" if width == 8 else ">I", data, at)
            at += width
    base = own.get("base", base)
    end = base
    for a, b in runs:
        _holds(a, b, 8)
        flags, n = struct.unpack_from(">II", data, a)
        flags &= 0xFFFFFF
        at, first = a + 8, None
        if flags & 0x1:
            _holds(at, b, 4)
            end = base + struct.unpack_from(">i", data, at)[0]
            at += 4
        if flags & 0x4:
            _holds(at, b, 4)
            (first,) = struct.unpack_from(">I", data, at)
            at += 4
        fields = [name for bit, name in ((0x100, "length"), (0x200, "size"), (0x400, "flags"), (0x800, "shift")) if flags & bit]
        if n and "size" not in fields and (not own["size"] or own["size"] * n > len(data)):
            raise MediaError("a run's samples have no size, or are larger than the file")
        table = dict(zip(fields, _numbers(data, at, n * len(fields), ">u4", b).reshape(n, len(fields)).T, strict=True))
        size, length, mark = (table.get(f, np.full(n, own[f], np.int64)) for f in ("size", "length", "flags"))
        if n and first is not None and "flags" not in table:
            mark[0] = first
        offsets = end + np.cumsum(size) - size
        _inside(offsets, size, data)
        track.keys = np.concatenate((track.keys, len(track.sizes) + np.flatnonzero((mark >> 16 & 1) == 0)))
        track.offsets, track.sizes, track.lengths = (np.concatenate(x) for x in ((track.offsets, offsets), (track.sizes, size), (track.lengths, length)))
        end = end + int(size.sum())
    return end


def read(data, track: Track) -> bytes:
    """The stored samples, in order."""
    return b"".join(bytes(data[a : a + n]) for a, n in track.ranges())


def feature(track: Track) -> str:
    """Codec, picture, duration, samples and keyframes of a track as one string."""
    keys = track.ranges(track.keys)
    mark = zlib.crc32(np.array(keys, ">u8").tobytes())
    return f"codec={track.codec.strip()};size={track.width}x{track.height};seconds={track.duration / max(1, track.timescale):.3f};samples={len(track.sizes)};keyframes={len(track.keys)};first={keys[0] if keys else None};ranges={mark:08x}"


KEYFRAME = T.StructType([T.StructField("offset", T.LongType()), T.StructField("length", T.LongType())])
TRACK = {"number": T.LongType(), "codec": T.StringType(), "handler": T.StringType(), "width": T.IntegerType(), "height": T.IntegerType(), "seconds": T.DoubleType(), "samples": T.LongType(), "keyframes": T.ArrayType(KEYFRAME)}
MEDIA_SCHEMA = T.StructType([T.StructField("tracks", T.ArrayType(T.StructType([T.StructField(n, k) for n, k in TRACK.items()]))), T.StructField("error", T.StringType())])


def media_columns(df: DataFrame, media: str = "media", out: str = "about") -> DataFrame:
    """Adds a struct about the container in a binary column: ``tracks``, one for each in order, or ``error``.

    Null gives null. Bytes that are no container, or one that contradicts itself, give only ``error``; so does an
    empty value. All columns of df stay; one called ``out`` is replaced. Repeated rows have equal results, an empty
    table gives an empty one. No shuffle.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    df = df.drop(out) if media != out else df
    at, schema = df.columns.index(media), T.StructType([*df.schema.fields, T.StructField(out, MEDIA_SCHEMA)])
    kind = to_arrow_schema(T.StructType([T.StructField(out, MEDIA_SCHEMA)])).field(0).type

    def one(data: bytes | None) -> dict | None:
        if data is None:
            return None
        try:
            found = tracks(data)
        except MediaError as e:
            return {"error": str(e)}
        about = []
        for t in found:
            keys = [{"offset": a, "length": n} for a, n in t.ranges(t.keys)]
            about.append({"number": t.number, "codec": t.codec, "handler": t.handler, "width": t.width, "height": t.height, "seconds": t.duration / max(1, t.timescale), "samples": len(t.sizes), "keyframes": keys})
        return {"tracks": about}

    def run(batches):
        for batch in batches:
            got = pa.array([one(x) for x in batch.column(at).to_pylist()], kind)
            yield pa.RecordBatch.from_arrays([*batch.columns, got], names=[*batch.schema.names, out])

    return df.mapInArrow(run, schema)


def stored(df: DataFrame, text: str = "text", out: str = "media") -> DataFrame:
    """Adds the container of each text's UTF-8 bytes (null: of an empty text)."""
    at, schema = df.columns.index(text), T.StructType([*df.schema.fields, T.StructField(out, T.BinaryType())])

    def run(batches):
        for batch in batches:
            got = [write(padded((t or "").encode())) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.binary())], names=[*batch.schema.names, out])

    return df.mapInArrow(run, schema)


DIGEST = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def text_media(docs: DataFrame) -> DataFrame:
    """Stores every whole text as a container, reads it back through its tables and returns digests.

    Null and empty texts store 64 zero bytes. Equal texts give equal values; each row has its own result, also
    repeated ones and those with a null doc_id. An empty table gives an empty result. Other columns aren't read.
    One pass without a shuffle; containers never leave the task.
    """

    def run(batches):
        for batch in batches:
            data, offsets = raw(batch.column(1))
            view, rows = memoryview(data) if len(data) else memoryview(b""), []
            for i in range(batch.num_rows):
                text = bytes(view[offsets[i] : offsets[i + 1]])
                media = write(padded(text))
                track = tracks(media)[0]
                back = read(media, track)
                rows.append((len(text), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-SAMPLE:]), len(media), hashlib.sha256(media).hexdigest(), feature(track)))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 7
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            made = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=names)

    return only(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(run, DIGEST)
