"""Matroska: round trips, every lacing, unknown sizes, odd rows."""

import hashlib
import os
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docpool.llm import matroska as M
from docpool.llm import queries as Q


@settings(max_examples=60, deadline=None)
@given(st.one_of(st.binary(max_size=3000), st.integers(0, 70_000).map(os.urandom)))
def test_round_trip(raw):
    data = M.padded(raw)
    assert len(data) % 64 == 0 and len(data) > 0 and data.startswith(raw)
    file = M.write_media(data)
    media = M.read_media(file)
    assert M.stored_bytes(file, media) == data
    assert [c[2] for c in media.cues] == media.clusters and [c[0] for c in media.cues] == sorted(c[0] for c in media.cues)
    assert [p.timestamp for p in media.packets] == [k * M.PACKET for k in range(len(media.packets))]
    assert media.tracks == [{"number": 1, "codec": "A_PCM/INT/LIT", "tick": 1}] and media.scale == 125_000


@given(st.integers(0, (1 << 56) - 2))
def test_vint(n):
    raw = M.vint(n)
    assert M.read_vint(raw, 0) == (n, len(raw)) and M.read_vint(b"\xff", 0)[0] == M.UNKNOWN


@pytest.mark.parametrize("lacing", [0, 1, 2, 3])
def test_lacing(lacing):
    frames = {0: [b"a" * 300], 2: [b"a" * 7, b"b" * 7, b"c" * 7]}.get(lacing, [b"a" * 600, b"b" * 255, b"", b"c" * 9])
    head = b""
    if lacing == 1:
        head = bytes([3]) + b"".join(b"\xff" * (len(f) // 255) + bytes([len(f) % 255]) for f in frames[:-1])
    elif lacing == 2:
        head = bytes([2])
    elif lacing == 3:
        head = M.laced(frames)[1][: -sum(map(len, frames))]
    body = M.vint(1) + (5).to_bytes(2, "big") + bytes([lacing << 1]) + head + b"".join(frames)
    for wrapped in (M.element(M.SIMPLE_BLOCK, body), M.element(M.BLOCK_GROUP, M.element(M.BLOCK, body))):
        known = M.element(M.CLUSTER, M.number(M.CLUSTER_TIME, 100) + wrapped)
        unknown = M.CLUSTER.to_bytes(4, "big") + b"\x01\xff\xff\xff\xff\xff\xff\xff" + M.number(M.CLUSTER_TIME, 100) + wrapped
        file = M.element(M.EBML, b"") + M.element(M.SEGMENT, unknown + known + M.element(M.CUES, b""))
        media = M.read_media(file)
        assert [file[p.start : p.start + p.size] for p in media.packets] == frames * 2
        assert [p.cluster for p in media.packets] == [0] * len(frames) + [1] * len(frames) and media.packets[0].timestamp == 105


def test_broken_files():
    file = M.write_media(M.padded(b"x" * 500))
    for cut in (file[:-1], file[:50], b"\x00"):
        with pytest.raises(ValueError):
            M.read_media(cut)
    assert M.read_media(b"").packets == []


def test_digest(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = Q.op9_matroska(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        raw = docs[r["doc_id"]].encode()
        data = M.padded(raw)
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-64:]))
        assert r["media_bytes"] > r["payload_bytes"]


def test_odd_rows(spark):
    odd = spark.createDataFrame([(1, None, "c"), (2, "", "c"), (None, "é" * 50_000, "c"), (2, "", "c")], "doc_id long, text string, media string")
    rows = M.media_digest(odd).collect()
    assert len(rows) == 4 and len({(r["media_sha256"], r["feature"]) for r in rows if r["doc_id"] is not None}) == 1
    packets = M.packet_table(M.with_media(odd)).collect()
    assert sum(p["byte_size"] for p in packets if p["doc_id"] is None) == 100_032 and {p["track"] for p in packets} == {1}
    assert M.media_digest(odd.limit(0)).count() == 0


def _file(blocks, duration=b"", codec=b"A_TEST", cues=b"", scale=1_000_000):
    entry = M.number(M.TRACK_NUMBER, 1) + (M.element(M.CODEC_ID, codec) if codec else b"") + duration
    cluster = M.element(M.CLUSTER, M.number(M.CLUSTER_TIME, 100) + b"".join(blocks))
    info, tracks = M.element(M.INFO, M.number(M.TIMESTAMP_SCALE, scale)), M.element(M.TRACKS, M.element(M.TRACK_ENTRY, entry))
    return M.element(M.EBML, b"") + M.element(M.SEGMENT, info + tracks + cluster + cues)


def _block(lacing, body, relative=5):
    return M.element(M.SIMPLE_BLOCK, M.vint(1) + relative.to_bytes(2, "big") + bytes([lacing << 1]) + body)


def test_times_in_a_lace():
    three = _block(2, bytes([2]) + b"aabbcc")
    at = lambda data: [(p.timestamp, data[p.start : p.start + p.size]) for p in M.read_media(data).packets]
    assert at(_file([three])) == [(105, b"aa"), (105, b"bb"), (105, b"cc")]
    assert at(_file([three], M.number(M.DEFAULT_DURATION, 20_000_000))) == [(105, b"aa"), (125, b"bb"), (145, b"cc")]
    assert M.read_media(_file([three], codec=b"")).tracks == [{"number": 1, "codec": ""}]


def test_every_cue_position():
    spot = lambda track, place: M.element(M.CUE_POSITIONS, M.number(M.CUE_TRACK, track) + M.number(M.CUE_CLUSTER, place))
    cues = M.element(M.CUES, M.element(M.CUE_POINT, M.number(M.CUE_TIME, 7) + spot(1, 29) + spot(2, 40)))
    assert M.read_media(_file([], cues=cues)).cues == [(7, 1, 29), (7, 2, 40)]
    with pytest.raises(ValueError, match="no cluster"):
        M.packets_from(_file([], cues=cues), 9)
    with pytest.raises(ValueError, match="no position"):
        M.read_media(_file([], cues=M.element(M.CUES, M.element(M.CUE_POINT, M.number(M.CUE_TIME, 7)))))


@pytest.mark.parametrize("block", [_block(2, bytes([2]) + b"aabbc"), _block(1, bytes([1, 200]) + b"short"), _block(1, bytes([1, 255])), _block(3, bytes([1, 0x9F]) + b"ab"), _block(1, b""), M.element(M.SIMPLE_BLOCK, b"\x81"), M.element(M.SIMPLE_BLOCK, b"")])
def test_blocks_that_do_not_fit(block):
    with pytest.raises(ValueError):
        M.read_media(_file([block]))


def test_track_without_number():
    tracks = M.element(M.TRACKS, M.element(M.TRACK_ENTRY, M.element(M.CODEC_ID, b"x")))
    with pytest.raises(ValueError, match="no number"):
        M.read_media(M.element(M.SEGMENT, tracks))


def test_any_damage_raises_value_error_or_reads():
    data = M.write_media(bytes(range(256)) * 100)
    rng = np.random.RandomState(3)
    for _ in range(400):
        hurt = bytearray(data)
        for k in rng.randint(0, 400, 3):
            hurt[k] = rng.randint(256)
        try:
            M.read_media(bytes(hurt[: rng.randint(1, len(data))] if rng.rand() < 0.5 else hurt))
        except ValueError:
            pass


@pytest.mark.parametrize("ticks", [0, 1, 1023, 1024, 16383, 16384, 20000, 39999, 10**6])
def test_seeking(ticks):
    data = M.write_media(bytes(i * 7 % 251 for i in range(40000)))
    every = M.read_media(data).packets
    late = [p for p in every if p.timestamp <= ticks][-1:] + [p for p in every if p.timestamp > ticks]
    assert M.packets_from(data, ticks) == late
