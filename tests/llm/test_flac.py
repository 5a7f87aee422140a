import hashlib
import math
import os
import zlib

import numpy as np
import pytest

from cropledger.llm import flac, queries

CASES = [b"a", b"", os.urandom(5000), bytes(3000), bytes(range(256)) * 9, b"\0\xff" * 2000, "é😀 text, ".encode() * 700, b"\x80" * 64]


def plain_frames(stream):
    """(byte offset, samples, subframe kind) of every frame of a stream, sample by sample; signed 8-bit samples in all."""
    at = 4
    while True:
        last, size = stream[at] >= 128, int.from_bytes(stream[at + 1 : at + 4], "big")
        if stream[at] & 127 == 0:
            total = int.from_bytes(stream[at + 14 : at + 22], "big") & (1 << 36) - 1
        at += 4 + size
        if last:
            break
    done, frames, samples = 0, [], []
    while done < total:
        bits, pos = stream, at * 8

        def take(n):
            nonlocal pos
            out = 0
            for p in range(pos, pos + n):
                out = out << 1 | bits[p // 8] >> (7 - p % 8) & 1
            pos += n
            return out

        def signed(n):
            x = take(n)
            return x - (1 << n) if x >> (n - 1) else x

        assert take(32) == 0xFFF87002
        first = take(8)
        pos += 8 * (8 - (first ^ 0xFF).bit_length() - 1) if first >= 0x80 else 0
        n = take(16) + 1
        pos += 8
        kind = take(8) >> 1
        if kind == 1:
            x = [signed(8) for _ in range(n)]
        else:
            order = kind - 31 if kind >= 32 else kind - 8
            x = [signed(8) for _ in range(order)]
            if kind >= 32:
                precision, shift = take(4) + 1, take(5)
                c = [signed(precision) for _ in range(order)]
            else:
                shift, c = 0, [[], [1], [2, -1], [3, -3, 1], [4, -6, 4, -1]][order]
            assert take(6) == 0
            k = take(4)
            for i in range(order, n):
                q = 0
                while not take(1):
                    q += 1
                u = q << k | take(k)
                x.append((sum(a * x[i - 1 - j] for j, a in enumerate(c)) >> shift) + (u >> 1 ^ -(u & 1)))
        frames.append((at, n, kind))
        samples += x
        done += n
        at = (pos + 7) // 8 + 2
    return frames, samples


def test_a_plain_decoder_reads_the_same():
    payloads = [flac.payload(c[:3000]) for c in CASES] + [flac.payload("The rain fell over the plain, and then it fell again. ".encode() * 60)]
    wave = [int(128 + 90 * math.sin(i / 9) + 20 * math.sin(i / 2.3)) for i in range(4096)]
    kinds = set()
    for p in [*payloads, bytes(wave)]:
        stream = flac.encode_streams([p])[0]
        frames, samples = plain_frames(stream)
        assert bytes(x + 128 for x in samples) == p
        kinds |= {k for _, _, k in frames}
        pcm, blocks = flac.decode_streams([stream])[0]
        assert pcm == p and [(b[2], b[1]) for b in blocks] == [f[:2] for f in frames]
    assert 1 in kinds and any(k >= 32 for k in kinds) and any(8 <= k < 32 for k in kinds)


def test_seek_points():
    payload = flac.payload(os.urandom(3000) + b"word " * 9000)
    stream = flac.encode_streams([payload])[0]
    size = int.from_bytes(stream[43:46], "big")
    assert stream[42] == 0x83 and size % 18 == 0
    frames_at = 46 + size
    points = [(int.from_bytes(stream[p : p + 8], "big"), int.from_bytes(stream[p + 8 : p + 16], "big"), int.from_bytes(stream[p + 16 : p + 18], "big")) for p in range(46, frames_at, 18)]
    blocks = flac.decode_streams([stream])[0][1]
    assert points == [(s, at - frames_at, n) for s, n, at in blocks[:: flac.SEEK]]


def test_long_payloads_are_cut_between_frames(monkeypatch):
    payload = flac.payload(b"a long text of many words " * 2000)
    whole = flac.encode_streams([payload])
    monkeypatch.setattr(flac, "BATCH_BYTES", 8192)
    assert flac.encode_streams([payload, b"x" * 64]) == [whole[0], flac.encode_streams([b"x" * 64])[0]]
    assert flac.decode_streams(whole)[0][0] == payload
    small = flac.feature(payload)
    monkeypatch.undo()
    x = np.frombuffer(payload, np.uint8).astype(float) - 128
    signs = x < 0
    want = f"rms={np.sqrt((x * x).mean()):.4f};zcr={(signs[1:] != signs[:-1]).sum() / len(x):.4f};peak={int(np.abs(x).max())};step={np.abs(np.diff(x)).mean():.4f}"
    assert small == flac.feature(payload) == want


def test_round_trip():
    payloads = [flac.payload(c) for c in CASES]
    streams = flac.encode_streams(payloads)
    for (pcm, blocks), p, s in zip(flac.decode_streams(streams), payloads, streams):
        assert pcm == p and sum(b[1] for b in blocks) == len(p)
        assert all(s[b[2] : b[2] + 2] == b"\xff\xf8" for b in blocks)
    assert flac.decode_streams(streams[:1])[0][0] == payloads[0]


def test_damage_is_noticed():
    stream = bytearray(flac.encode_streams([flac.payload(b"hello world " * 300)])[0])
    stream[len(stream) // 2] ^= 4
    with pytest.raises(ValueError):
        flac.decode_streams([bytes(stream)])


def test_frame_numbers():
    for n in (0, 127, 128, 2047, 2048, 65535, 65536, 10**6, 2**26, 2**31):
        assert flac._read_number(flac._coded_number(n), 0) == (n, len(flac._coded_number(n)))


def test_table(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op10_flac(spark, sf).collect()
    assert {r.doc_id for r in rows} == set(texts)
    for r in rows:
        p = flac.payload(texts[r.doc_id])
        assert (r.n_bytes, r.payload_bytes) == (len(texts[r.doc_id]), len(p)) and len(p) % 64 == 0
        assert r.media_sha256 == hashlib.sha256(flac.encode_streams([p])[0]).hexdigest() and r.feature == flac.feature(p)
        assert r.n_blocks == -(-len(p) // flac.BLOCK) and [int(b.split(":")[0]) for b in r.block_offsets.split(",")] == list(range(0, len(p), flac.BLOCK))
        assert (r.payload_sha256, r.tail_crc32) == (hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]))


def test_null_and_repeated_rows(spark):
    df = spark.createDataFrame([(1, None, 1), (1, None, 1), (None, "x", 2)], "doc_id long, text string, media int")
    rows = flac.decode(flac.encode(df)).collect()
    assert sorted(len(r.pcm) for r in rows) == [64, 64, 64]
    assert flac.decode(flac.encode(df.limit(0))).collect() == []
    none = spark.createDataFrame([(1, None, 5), (2, flac.encode_streams([b"y" * 64])[0], 6)], "doc_id long, media binary, extra int")
    assert {(r.doc_id, r.pcm and bytes(r.pcm), r.extra) for r in flac.decode(none).collect()} == {(1, None, 5), (2, b"y" * 64, 6)}


def test_a_frame_that_holds_the_next_header():
    """Random bytes are stored plain, so the first frame can hold the very bytes of the second one's header."""
    rng = np.random.default_rng(3)
    noise = bytearray(rng.integers(0, 256, 3 * flac.BLOCK, np.uint8).tobytes())
    stream = flac.encode_streams([bytes(noise)])[0]
    blocks = flac.decode_streams([stream])[0][1]
    for number in (1, 2):
        header = stream[blocks[number][2] :][:16]
        noise[100 * number : 100 * number + 16] = bytes(b ^ 128 for b in header)
    stream = flac.encode_streams([bytes(noise)])[0]
    assert stream.count(header[:8]) == 2 and flac._frames_of(stream) != flac._frames_of(stream, sure=True)
    for streams in ([stream], [flac.encode_streams([b"x" * 64])[0], stream]):
        assert flac.decode_streams(streams)[-1][0] == bytes(noise)
    for at in (blocks[1][2] - 1, blocks[1][2] + 40, len(stream) - 2):
        damaged = bytearray(stream)
        damaged[at] ^= 1
        with pytest.raises(ValueError):
            flac.decode_streams([bytes(damaged)])
