"""Media columns: Matroska files and their packet tables.

The parser reads EBML elements with variable-length ids and sizes, tracks, clusters (of known and
unknown size), SimpleBlocks and BlockGroups with no, Xiph, fixed-size or EBML lacing, and cues, into a
table of packets: track, timestamp, cluster, block, byte range. A packet's time within a lace comes from
its track's DefaultDuration or, of 8-bit PCM, from its samples; other tracks' laced packets have the
block's time. Cues lead to clusters: `packets_from` reads from the last cue before a time, without the
clusters before it. The writer stores bytes as one track of unsigned 8-bit PCM samples, eight packets to
a laced block, with a cue for each cluster.

Defined results: a null payload is empty; a payload is padded with zero bytes to a positive multiple
of 64; repeated rows give repeated rows; null ids stay null; an empty table gives an empty result;
further columns are ignored. What can't be read raises ValueError: a file that ends inside an element, an
element that reaches past its parent, sizes of a lace that don't fit its block, a fixed-size lace that
leaves a rest, a block without its header, a track or cue without a number, a cue that leads to no cluster.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docpool.llm import common

UNIT = 64
PACKET, LACED, BLOCKS = 1024, 8, 2
RATE = 8000

# Fixed values of the format: element ids.
EBML, EBML_VERSION, EBML_READ_VERSION, EBML_MAX_ID, EBML_MAX_SIZE, DOC_TYPE, DOC_VERSION, DOC_READ_VERSION = 0x1A45DFA3, 0x4286, 0x42F7, 0x42F2, 0x42F3, 0x4282, 0x4287, 0x4285
SEGMENT, INFO, TIMESTAMP_SCALE, MUXING_APP, WRITING_APP = 0x18538067, 0x1549A966, 0x2AD7B1, 0x4D80, 0x5741
TRACKS, TRACK_ENTRY, TRACK_NUMBER, TRACK_UID, TRACK_TYPE, CODEC_ID, AUDIO, SAMPLING, CHANNELS, BIT_DEPTH = 0x1654AE6B, 0xAE, 0xD7, 0x73C5, 0x83, 0x86, 0xE1, 0xB5, 0x9F, 0x6264
DEFAULT_DURATION = 0x23E383
CLUSTER, CLUSTER_TIME, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK = 0x1F43B675, 0xE7, 0xA3, 0xA0, 0xA1
CUES, CUE_POINT, CUE_TIME, CUE_POSITIONS, CUE_TRACK, CUE_CLUSTER = 0x1C53BB6B, 0xBB, 0xB3, 0xB7, 0xF7, 0xF1
UNKNOWN = -1
#: Ids that end a cluster of unknown size.
_TOP = {CLUSTER, CUES, INFO, TRACKS, SEGMENT, EBML}


class Packet(NamedTuple):
    track: int
    timestamp: int
    cluster: int
    block: int
    start: int
    size: int


class Media(NamedTuple):
    scale: int
    tracks: list[dict]
    packets: list[Packet]
    cues: list[tuple[int, int, int]]
    clusters: list[int]
    segment: int


# --- writing -----------------------------------------------------------------------------------


def vint(value: int, width: int = 0) -> bytes:
    """A size: as few bytes as hold it, or `width`; all ones is kept for the unknown size."""
    n = width or next(k for k in range(1, 9) if value < (1 << 7 * k) - 1)
    return (value | 1 << 7 * n).to_bytes(n, "big")


def element(kind: int, body: bytes) -> bytes:
    return kind.to_bytes((kind.bit_length() + 7) // 8, "big") + vint(len(body)) + body


def number(kind: int, value: int) -> bytes:
    return element(kind, value.to_bytes(max(1, (value.bit_length() + 7) // 8), "big"))


def laced(frames: list[bytes]) -> tuple[int, bytes]:
    """Flag bits and body of a block's frames under EBML lacing; one frame is not laced."""
    if len(frames) == 1:
        return 0, frames[0]
    sizes = [len(f) for f in frames[:-1]]
    head = bytearray([len(frames) - 1])
    head += vint(sizes[0])
    for before, now in zip(sizes, sizes[1:]):
        diff = now - before
        n = next(k for k in range(1, 9) if abs(diff) < (1 << 7 * k - 1) - 1)
        head += vint(diff + (1 << 7 * n - 1) - 1, n)
    return 0x06, bytes(head) + b"".join(frames)


def write_media(payload: bytes) -> bytes:
    """A Matroska file of the payload as 8-bit samples, a tick for each sample."""
    head = element(EBML, number(EBML_VERSION, 1) + number(EBML_READ_VERSION, 1) + number(EBML_MAX_ID, 4) + number(EBML_MAX_SIZE, 8) + element(DOC_TYPE, b"matroska") + number(DOC_VERSION, 4) + number(DOC_READ_VERSION, 2))
    info = element(INFO, number(TIMESTAMP_SCALE, 10**9 // RATE) + element(MUXING_APP, b"docpool") + element(WRITING_APP, b"docpool"))
    audio = element(AUDIO, element(SAMPLING, np.array([RATE], ">f8").tobytes()) + number(CHANNELS, 1) + number(BIT_DEPTH, 8))
    tracks = element(TRACKS, element(TRACK_ENTRY, number(TRACK_NUMBER, 1) + number(TRACK_UID, 1) + number(TRACK_TYPE, 2) + element(CODEC_ID, b"A_PCM/INT/LIT") + audio))
    parts, at, cues = [info, tracks], len(info) + len(tracks), []
    step = PACKET * LACED
    for begin in range(0, len(payload), step * BLOCKS):
        body = [number(CLUSTER_TIME, begin)]
        for k in range(begin, min(begin + step * BLOCKS, len(payload)), step):
            chunk = payload[k : k + step]
            flags, frames = laced([chunk[i : i + PACKET] for i in range(0, len(chunk), PACKET)])
            body.append(element(SIMPLE_BLOCK, vint(1) + (k - begin).to_bytes(2, "big", signed=True) + bytes([0x80 | flags]) + frames))
        cluster = element(CLUSTER, b"".join(body))
        cues.append(element(CUE_POINT, number(CUE_TIME, begin) + element(CUE_POSITIONS, number(CUE_TRACK, 1) + number(CUE_CLUSTER, at))))
        parts.append(cluster)
        at += len(cluster)
    return head + element(SEGMENT, b"".join(parts) + element(CUES, b"".join(cues)))


# --- parsing -----------------------------------------------------------------------------------


def read_vint(data: bytes, at: int, keep: bool = False) -> tuple[int, int]:
    """A variable-length number and the place after it; keep: with its length bit, as ids are."""
    if at >= len(data) or data[at] == 0:
        raise ValueError(f"no variable-length number at byte {at}")
    width = 9 - data[at].bit_length()
    if at + width > len(data):
        raise ValueError(f"the file ends inside a number at byte {at}")
    value = int.from_bytes(data[at : at + width], "big")
    if keep:
        return value, at + width
    value &= (1 << 7 * width) - 1
    return (UNKNOWN if value == (1 << 7 * width) - 1 else value), at + width


def elements(data: bytes, at: int, end: int) -> Iterator[tuple[int, int, int, int]]:
    """(id, place of the element, start, stop) of the elements in a range.

    An element of unknown size reaches to the end of the range; who reads it says where it stops.
    """
    while at < end:
        begin = at
        kind, at = read_vint(data, at, True)
        size, at = read_vint(data, at)
        stop = end if size == UNKNOWN else at + size
        if stop > end:
            raise ValueError(f"element {kind:X} at byte {begin} reaches past its parent")
        if size == UNKNOWN and kind == CLUSTER:
            stop = at
            while stop < end:  # children go on until an element of the top level
                child, after = read_vint(data, stop, True)
                if child in _TOP:
                    break
                length, after = read_vint(data, after)
                stop = after + length
        yield kind, begin, at, stop
        at = stop


def _int(data: bytes, start: int, stop: int) -> int:
    return int.from_bytes(data[start:stop], "big")


def frame_sizes(data: bytes, at: int, stop: int, lacing: int) -> tuple[list[int], int]:
    """Sizes of a block's frames and where the first begins. lacing: 0 none, 1 Xiph, 2 fixed, 3 EBML."""
    if lacing == 0:
        return [stop - at], at
    if at >= stop:
        raise ValueError(f"a lace without its count at byte {at}")
    count = data[at] + 1
    at += 1
    if lacing == 2:
        if (stop - at) % count:
            raise ValueError(f"a lace of {count} equal frames leaves a rest at byte {at}")
        return [(stop - at) // count] * count, at
    sizes: list[int] = []
    for k in range(count - 1):
        if lacing == 1:
            run = at
            while run < stop and data[run] == 255:
                run += 1
            if run >= stop:
                raise ValueError(f"a lace ends inside a size at byte {at}")
            sizes.append(255 * (run - at) + data[run])
            at = run + 1
        else:
            before = at
            value, at = read_vint(data[:stop], at)
            sizes.append(value if k == 0 else sizes[-1] + value - ((1 << 7 * (at - before) - 1) - 1))
    sizes.append(stop - at - sum(sizes))
    if min(sizes) < 0:
        raise ValueError(f"a lace's frames reach past its block at byte {at}")
    return sizes, at


def _fields(data: bytes, start: int, stop: int, needed: dict[int, str]) -> dict[int, tuple[int, int]]:
    """Where the children of an element are, of each kind the last; those needed must be there."""
    found = {kind: (p, q) for kind, _, p, q in elements(data, start, stop)}
    for kind, name in needed.items():
        if kind not in found:
            raise ValueError(f"the element at byte {start} has no {name}")
    return found


def _cluster(data: bytes, start: int, stop: int, number: int, scale: int, tracks: dict[int, dict]) -> Iterator[Packet]:
    """The packets of a cluster."""
    time = index = 0
    for kind, _, x, y in elements(data, start, stop):
        if kind == CLUSTER_TIME:
            time = _int(data, x, y)
        blocks = [(x, y)] if kind == SIMPLE_BLOCK else [(p, q) for k, _, p, q in elements(data, x, y) if k == BLOCK] if kind == BLOCK_GROUP else []
        for p, q in blocks:
            track, at = read_vint(data[:q], p)
            if at + 3 > q:
                raise ValueError(f"a block of {q - p} bytes at byte {p} has no header")
            begins = time + int.from_bytes(data[at : at + 2], "big", signed=True)
            sizes, at = frame_sizes(data, at + 3, q, data[at + 2] >> 1 & 3)
            known, first = tracks.get(track, {}), at
            for k, size in enumerate(sizes):
                if known.get("duration"):  # in ns
                    later = round(k * known["duration"] / scale)
                else:
                    later = (at - first) * known["tick"] if known.get("tick") else 0
                yield Packet(track, begins + later, number, index, at, size)
                at += size
            index += 1


def _track(data: bytes, start: int, stop: int, scale: int) -> dict:
    fields = _fields(data, start, stop, {TRACK_NUMBER: "number"})
    out = {"number": _int(data, *fields[TRACK_NUMBER]), "codec": data[slice(*fields[CODEC_ID])].decode("ascii", "replace") if CODEC_ID in fields else ""}
    if DEFAULT_DURATION in fields:
        out["duration"] = _int(data, *fields[DEFAULT_DURATION])
    if out["codec"] == "A_PCM/INT/LIT" and AUDIO in fields:
        audio = _fields(data, *fields[AUDIO], {})
        depth = _int(data, *audio[BIT_DEPTH]) if BIT_DEPTH in audio else 0
        channels = _int(data, *audio[CHANNELS]) if CHANNELS in audio else 1
        rate = data[slice(*audio[SAMPLING])] if SAMPLING in audio else b""
        if depth == 8 and channels == 1 and len(rate) in (4, 8):
            hertz = float(np.frombuffer(rate, f">f{len(rate)}")[0])
            if hertz > 0:
                out["tick"] = round(1e9 / hertz / scale)  # ticks of a byte
    return out


def _walk(data: bytes, want: Callable[[int], bool] | None = None) -> Media:
    """want: whether the packets of the cluster at this place are read."""
    scale, entries, packets, cues, clusters, segment = 1_000_000, [], [], [], [], 0
    for kind, _, start, stop in elements(data, 0, len(data)):
        if kind != SEGMENT:
            continue
        segment = start
        places: list[tuple[int, int, int]] = []
        for kind1, place, a, b in elements(data, start, stop):
            if kind1 == INFO:
                scale = next((_int(data, x, y) for k, _, x, y in elements(data, a, b) if k == TIMESTAMP_SCALE), scale)
                if not scale:
                    raise ValueError(f"a timestamp scale of 0 at byte {a}")
            elif kind1 == TRACKS:
                entries += [(x, y) for k, _, x, y in elements(data, a, b) if k == TRACK_ENTRY]
            elif kind1 == CLUSTER:
                places.append((place - start, a, b))
            elif kind1 == CUES:
                for k, _, x, y in elements(data, a, b):
                    if k == CUE_POINT:
                        time = _int(data, *_fields(data, x, y, {CUE_TIME: "time", CUE_POSITIONS: "position"})[CUE_TIME])
                        for k2, _, p, q in elements(data, x, y):
                            if k2 == CUE_POSITIONS:
                                spot = _fields(data, p, q, {CUE_TRACK: "track", CUE_CLUSTER: "cluster"})
                                cues.append((time, _int(data, *spot[CUE_TRACK]), _int(data, *spot[CUE_CLUSTER])))
        tracks = [_track(data, x, y, scale) for x, y in entries]
        numbered = {t["number"]: t for t in tracks}
        for where, a, b in places:
            if want is None or want(where):
                packets += _cluster(data, a, b, len(clusters), scale, numbered)
            clusters.append(where)
    return Media(scale, [_track(data, x, y, scale) for x, y in entries], packets, cues, clusters, segment)


def read_media(data: bytes) -> Media:
    """The packets, tracks and cues of a Matroska file."""
    return _walk(data)


def packets_from(data: bytes, ticks: int, track: int = 1) -> list[Packet]:
    """The track's packets from the last one that begins at `ticks` or before; clusters before its cue aren't read."""
    media = _walk(data, lambda place: False)
    before = [(time, place) for time, t, place in media.cues if t == track and time <= ticks]
    start = max(before)[1] if before else 0
    if before and start not in media.clusters:
        raise ValueError(f"a cue leads to byte {start}, where no cluster is")
    found = [p for p in _walk(data, lambda place: place >= start).packets if p.track == track]
    early = [p.timestamp for p in found if p.timestamp <= ticks]
    return [p for p in found if p.timestamp >= max(early, default=ticks)]


def stored_bytes(data: bytes, media: Media, track: int = 1) -> bytes:
    return b"".join(data[p.start : p.start + p.size] for p in media.packets if p.track == track)


# --- operators ---------------------------------------------------------------------------------


def padded(raw: bytes) -> bytes:
    return raw + bytes(-len(raw) % UNIT or (0 if raw else UNIT))


def with_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and media: each text's bytes, padded, as a Matroska file."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.steps(batches, "text"):
            files = [write_media(padded(x.encode())) for x in common.texts_of(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(files, pa.binary())], ["doc_id", "media"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(make, "doc_id long, media binary")


def packet_table(files: DataFrame, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """A row for each packet: doc_id, track, timestamp in ns, cluster, block, first byte and size."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "track", "timestamp_ns", "cluster", "block", "byte_start", "byte_size"]
        for batch in batches:
            for key, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                media = read_media(data or b"")
                rows = [(key, p.track, p.timestamp * media.scale, *p[2:]) for p in media.packets]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(7)], names)

    schema = "doc_id long, track long, timestamp_ns long, cluster long, block long, byte_start long, byte_size long"
    return files.select(F.col(id_col).cast("long").alias("doc_id"), F.col(media_col).alias("media")).mapInArrow(parse, schema)


def media_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What is stored for each text, read back from the stored form."""
    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.steps(batches, "text"):
            rows = []
            for text in common.texts_of(batch, "text"):
                raw = text.encode()
                data = write_media(padded(raw))
                media = read_media(data)
                back = stored_bytes(data, media)
                if [c[2] for c in media.cues] != media.clusters:
                    raise ValueError("cues don't lead to the clusters")
                samples = np.frombuffer(back, np.uint8)
                last = media.packets[-1]
                feature = f"packets={len(media.packets)} clusters={len(media.clusters)} ticks={last.timestamp + last.size} sum={int(samples.sum(dtype=np.int64))} peak={int(samples.max())} crossings={int(np.count_nonzero((samples[1:] >= 128) != (samples[:-1] >= 128)))}"
                rows.append((len(raw), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-UNIT:]), len(data), hashlib.sha256(data).hexdigest(), feature))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds))], [x.split()[0] for x in schema.split(", ")])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)
