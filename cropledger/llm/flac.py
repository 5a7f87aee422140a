"""FLAC for byte payloads: 8-bit mono frames, Rice residuals, fixed and linear predictors, checksums, seekable blocks.

Frames of a batch of streams are coded and decoded side by side: step i handles sample i of every frame, so numpy
works on as many samples at once as the batch has frames.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

BLOCK = 1024
#: Payload bytes that are handled side by side; a longer payload is cut between frames, so memory does not grow with it.
BATCH_BYTES = 1 << 20
#: Most coefficients of an estimated linear predictor and the bits of each; frames between two seek points of a stream.
TAPS, PRECISION, SEEK = 8, 9, 16


def _table(poly: int, width: int) -> np.ndarray:
    out = np.arange(256, dtype=np.int64) << (width - 8)
    for _ in range(8):
        out = ((out << 1) ^ np.where(out >> (width - 1) & 1, poly, 0)) & ((1 << width) - 1)
    return out


_CRC8, _CRC16 = _table(0x07, 8), _table(0x8005, 16)
_CRC8_LIST = _CRC8.tolist()


def _crc8(raw: bytes) -> int:
    crc = 0
    for b in raw:
        crc = _CRC8_LIST[crc ^ b]
    return crc


def _crc16(buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-16 of buf[start : start + size] for every frame."""
    order = np.argsort(-size, kind="stable")
    at, left = start[order], size[order]
    crc = np.zeros(len(at), np.int64)
    active = np.searchsorted(-left, -np.arange(int(left.max(initial=0))), side="left")
    for i, a in enumerate(active):
        c = crc[:a]
        crc[:a] = ((c << 8) & 0xFFFF) ^ _CRC16[(c >> 8) ^ buf[at[:a] + i]]
    out = np.empty_like(crc)
    out[order] = crc
    return out


def _coded_number(n: int) -> bytes:
    """A frame number in the format's extension of UTF-8."""
    if n < 0x80:
        return bytes([n])
    tail: list[int] = []
    while True:
        tail.insert(0, 0x80 | n & 0x3F)
        n >>= 6
        if n < 1 << (6 - len(tail)):
            return bytes([(0xFF << (7 - len(tail))) & 0xFF | n, *tail])


def _read_number(raw: bytes, at: int) -> tuple[int, int]:
    first = raw[at]
    if first < 0x80:
        return first, at + 1
    size = 8 - (first ^ 0xFF).bit_length()
    if size > 7:
        return -1, at + 1  # no number starts so
    n = first & ((1 << (7 - size)) - 1)
    for b in raw[at + 1 : at + size]:
        n = n << 6 | b & 0x3F
    return n, at + size


def _rice(residual: np.ndarray, coded: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(folded residuals, parameter, bits) of each frame: the better of the two parameters next to the mean's logarithm."""
    u = np.where(coded, (residual << 1) ^ (residual >> 31), 0)
    count = coded.sum(1)
    k = np.clip(np.floor(np.log2(np.maximum(u.sum(1) / np.maximum(1, count), 1))).astype(np.int64), 0, 13)
    k = np.maximum(0, k - 1)[:, None] + np.arange(2)
    bits = np.stack([np.where(coded, u >> k[:, j : j + 1], 0).sum(1) + count * (1 + k[:, j]) for j in (0, 1)], 1)
    return u, k[np.arange(len(u)), bits.argmin(1)], bits.min(1)


def _predictors(samples: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, whole coefficients, shift) of a linear predictor for each frame, order 0 where there is none.

    Levinson and Durbin's recursion on the autocorrelations, for all frames at once; the order is the one whose expected
    residual and coefficients take the fewest bits.
    """
    x = samples.astype(np.float64)
    r = np.stack([np.einsum("ij,ij->i", x[:, j:], x[:, : x.shape[1] - j]) for j in range(TAPS + 1)], 1)
    a, left = np.zeros((len(x), TAPS)), np.maximum(r[:, 0], 1e-9)
    order, best, cost = np.zeros(len(x), np.int64), np.zeros_like(a), np.full(len(x), np.inf)
    for i in range(TAPS):
        k = (r[:, i + 1] - (a[:, :i] * r[:, i:0:-1]).sum(1)) / left
        a[:, :i] -= k[:, None] * a[:, :i][:, ::-1].copy()
        a[:, i] = k
        left = np.maximum(left * (1 - k * k), 1e-9)
        bits = n / 2 * np.log2(left / n) + (i + 1) * (8 + PRECISION)
        better = (bits < cost) & (n > 2 * TAPS)
        order[better], best[better], cost[better] = i + 1, a[better], bits[better]
    top = np.maximum(np.abs(best).max(1), 1e-9)
    shift = PRECISION - 2 - np.floor(np.log2(top)).astype(np.int64)
    order[(shift < 0) | (shift > 15)] = 0
    shift = np.clip(shift, 0, 15)
    whole = np.clip(np.round(best * (1 << shift)[:, None]), -(1 << (PRECISION - 1)), (1 << (PRECISION - 1)) - 1)
    return order, whole.astype(np.int32), shift


def _encode_frames(chunks: list[tuple[bytes, int]]) -> list[tuple[bytes, np.ndarray]]:
    """(frames, size of each) of every chunk, a stretch of whole blocks of a stream (its last may be short) and its first block's number."""
    sizes = [len(c) for c, _ in chunks]
    frames = [(number + s // BLOCK, min(BLOCK, size - s)) for (_, number), size in zip(chunks, sizes) for s in range(0, size, BLOCK)]
    n = np.array([f[1] for f in frames])
    base = np.concatenate(([0], np.cumsum(sizes)))
    flat = np.frombuffer(b"".join(c for c, _ in chunks) + bytes(BLOCK), np.uint8)
    starts = np.array([b + s for b, size in zip(base, sizes) for s in range(0, size, BLOCK)])
    inside = np.arange(BLOCK) < n[:, None]
    samples = np.where(inside, flat[starts[:, None] + np.arange(BLOCK)].astype(np.int32) - 128, 0)

    # Each frame takes the shortest of the best fixed predictor, the estimated one, and plain samples.
    least, order, residual = np.full(len(n), np.inf), np.zeros(len(n), np.int64), np.zeros_like(samples)
    diff = samples
    for o in range(5):
        if o:
            diff = np.concatenate((diff[:, :1], diff[:, 1:] - diff[:, :-1]), axis=1)
        weight = (np.abs(diff) * inside)[:, o:].sum(1) + 40.0 * o
        better = (weight < least) & (n > o)
        least[better], order[better] = weight[better], o
        residual[better] = diff[better]
    coded = inside & (np.arange(BLOCK) >= order[:, None])
    u, k, bits = _rice(residual, coded)
    head_bits = 8 + 8 * order + 10
    taps, whole, shift = _predictors(samples, n)
    guess = np.zeros_like(samples)
    for j in range(TAPS):
        guess[:, j + 1 :] += whole[:, j : j + 1] * samples[:, : BLOCK - j - 1]
    own = inside & (np.arange(BLOCK) >= taps[:, None])
    u_l, k_l, bits_l = _rice(samples - (guess >> shift[:, None].astype(np.int32)), own)
    head_l = 8 + 8 * taps + 4 + 5 + PRECISION * taps + 10
    is_linear = (taps > 0) & (head_l + bits_l < head_bits + bits)
    order, k, bits, head_bits = (np.where(is_linear, y, x) for x, y in ((order, taps), (k, k_l), (bits, bits_l), (head_bits, head_l)))
    u[is_linear], coded[is_linear] = u_l[is_linear], own[is_linear]
    plain = head_bits + bits >= 8 + 8 * n
    body = np.where(plain, 1 + n, (head_bits + bits + 7) // 8)

    heads = []
    for number, size in frames:
        raw = b"\xff\xf8\x70\x02" + _coded_number(number) + (size - 1).to_bytes(2, "big")
        heads.append(raw + bytes([_crc8(raw)]))
    head = np.array([len(h) for h in heads])
    total = head + body + 2
    at = np.concatenate(([0], np.cumsum(total)))[:-1]
    buf = np.zeros(int(total.sum()) + 8, np.uint8)
    for h in np.unique(head):
        same = np.flatnonzero(head == h)
        buf[at[same][:, None] + np.arange(h)] = np.frombuffer(b"".join(heads[i] for i in same), np.uint8).reshape(-1, h)
    sub = at + head
    buf[sub] = np.where(plain, 2, np.where(is_linear, (32 + order - 1) << 1, (8 + order) << 1))
    rows, cols = np.nonzero(inside & plain[:, None])
    buf[sub[rows] + 1 + cols] = samples[rows, cols].astype(np.uint8)
    rice = np.flatnonzero(~plain)
    for o in range(int(order[rice].max(initial=0))):
        warm = rice[order[rice] > o]
        buf[sub[warm] + 1 + o] = samples[warm, o].astype(np.uint8)
    if len(rice):
        # Values of up to 17 bits, placed at a bit offset: they never overlap, so sums of 32-bit words are their union.
        values, places, widths = [k[rice]], [(sub[rice] * 8 + head_bits[rice] - 4)], [np.full(len(rice), 4)]  # method 0, order 0, parameter
        lin = rice[is_linear[rice]]
        for o in range(-1, int(order[lin].max(initial=0))):
            has = lin if o < 0 else lin[order[lin] > o]
            behind = sub[has] * 8 + 8 + 8 * order[has]
            values.append((PRECISION - 1) << 5 | shift[has] if o < 0 else whole[has, o].astype(np.int64) & ((1 << PRECISION) - 1))
            places.append(behind + (0 if o < 0 else 9 + PRECISION * o))
            widths.append(np.full(len(has), 9 if o < 0 else PRECISION))
        count = n[rice] - order[rice]
        value, kk = u[rice][coded[rice]].astype(np.int64), np.repeat(k[rice], count)
        length = (value >> kk) + 1 + kk
        ends = np.cumsum(length)
        first = np.cumsum(count) - count
        ahead = sub[rice] * 8 + head_bits[rice] - (ends - length)[first]
        places.append(np.repeat(ahead, count) + ends - kk - 1)
        values.append((1 << kk) | (value & ((1 << kk) - 1)))
        widths.append(kk + 1)
        place = np.concatenate(places)
        value = np.concatenate(values).astype(np.uint64) << (64 - (place & 31) - np.concatenate(widths)).astype(np.uint64)
        size = len(buf) // 4 + 2
        words = np.bincount(place >> 5, weights=(value >> np.uint64(32)).astype(np.float64), minlength=size)
        words[1:] += np.bincount(place >> 5, weights=(value & np.uint64(0xFFFFFFFF)).astype(np.float64), minlength=size)[:-1]
        buf += words.astype(np.uint64).astype(">u4").view(np.uint8)[: len(buf)]
    crc = _crc16(buf, at, total - 2)
    buf[at + total - 2], buf[at + total - 1] = crc >> 8, crc & 255

    out, raw, i = [], buf.tobytes(), 0
    for size in sizes:
        j = i + -(-size // BLOCK)
        out.append((raw[at[i] : at[j - 1] + total[j - 1]], total[i:j]))
        i = j
    return out


def encode_streams(payloads: list[bytes]) -> list[bytes]:
    """A FLAC stream for each payload (any positive number of bytes), with a seek point for every SEEK-th frame."""
    chunks = [(d, s) for d, p in enumerate(payloads) for s in range(0, len(p), BATCH_BYTES // 2)]
    raw: list[list[bytes]] = [[] for _ in payloads]
    sizes: list[list[np.ndarray]] = [[] for _ in payloads]
    for run in _runs(chunks, lambda c: min(BATCH_BYTES // 2, len(payloads[c[0]]) - c[1])):
        for (d, _), (frames, total) in zip(run, _encode_frames([(payloads[d][s : s + BATCH_BYTES // 2], s // BLOCK) for d, s in run])):
            raw[d].append(frames)
            sizes[d].append(total)
    out = []
    for payload, frames, total in zip(payloads, raw, map(np.concatenate, sizes)):
        digest = hashlib.md5()
        for s in range(0, len(payload), BATCH_BYTES):
            digest.update((np.frombuffer(payload[s : s + BATCH_BYTES], np.uint8) ^ 128).tobytes())
        info = BLOCK.to_bytes(2, "big") * 2 + int(total.min()).to_bytes(3, "big") + int(total.max()).to_bytes(3, "big")
        info += (8000 << 44 | 0 << 41 | 7 << 36 | len(payload)).to_bytes(8, "big") + digest.digest()
        starts = np.cumsum(total) - total
        points = b"".join((i * BLOCK).to_bytes(8, "big") + int(starts[i]).to_bytes(8, "big") + min(BLOCK, len(payload) - i * BLOCK).to_bytes(2, "big") for i in range(0, len(total), SEEK))
        out.append(b"fLaC\x00\x00\x00\x22" + info + b"\x83" + len(points).to_bytes(3, "big") + points + b"".join(frames))
    return out


def _frames_of(raw: bytes, sure: bool = False) -> tuple[int, bytes, list[tuple[int, int, int]]]:
    """Total samples, md5 and the (offset, header size, samples) of each frame of a stream, found by sync code, CRC-8 and number.

    The bytes of a frame may look like the header of the next one. With sure, a header counts only where the CRC-16 of the frame before it closes.
    """
    if raw[:4] != b"fLaC":
        raise ValueError("not a FLAC stream")
    at, last, total, md5 = 4, False, 0, b""
    while not last:
        last, kind, size = raw[at] >= 128, raw[at] & 127, int.from_bytes(raw[at + 1 : at + 4], "big")
        if kind == 0:
            packed = int.from_bytes(raw[at + 14 : at + 22], "big")
            total, md5 = packed & (1 << 36) - 1, raw[at + 22 : at + 38]
            if packed >> 41 & 7 or (packed >> 36 & 31) != 7:
                raise ValueError("only 8-bit mono streams are read")
        at += 4 + size
    frames, samples = [], 0
    while samples < total:
        at = raw.find(b"\xff\xf8\x70\x02", at)
        if at < 0 or at + 8 > len(raw):
            raise ValueError("a frame is missing")
        number, end = _read_number(raw, at + 4)
        if number == len(frames) and end + 2 < len(raw) and _crc8(raw[at : end + 2]) == raw[end + 2] and not (sure and frames and not _closes(raw, frames[-1][0], at)):
            size = int.from_bytes(raw[end : end + 2], "big") + 1
            frames.append((at, end + 3 - at, size))
            samples += size
            at = end + 3
        else:
            at += 1
    return total, md5, frames


def _closes(raw: bytes, start: int, end: int) -> bool:
    """Whether raw[start:end] ends with its own CRC-16."""
    own = np.frombuffer(raw, np.uint8)[start : end - 2]
    return end - 2 > start and int(_crc16(own, np.zeros(1, np.int64), np.array([len(own)]))[0]) == int.from_bytes(raw[end - 2 : end], "big")


def decode_streams(streams: list[bytes]) -> list[tuple[bytes, list[tuple[int, int, int]]]]:
    """(payload, [(sample offset, samples, byte offset of the frame)]) of each stream; a wrong checksum or digest raises.

    Frames are looked for by their headers first. If what is found so fails a check, the streams are walked again frame by frame.
    """
    try:
        return _decoded(streams, [_frames_of(s) for s in streams])
    except ValueError:
        return _decoded(streams, [_frames_of(s, sure=True) for s in streams])


def _decoded(streams: list[bytes], parsed: list[tuple[int, bytes, list[tuple[int, int, int]]]]) -> list[tuple[bytes, list[tuple[int, int, int]]]]:
    ends = [[*(f[0] for f in fs[1:]), len(s)] for s, (_, _, fs) in zip(streams, parsed)]
    most = max(1, BATCH_BYTES // 2 // BLOCK)
    parts = [(d, i) for d, (_, _, fs) in enumerate(parsed) for i in range(0, len(fs), most)]
    found: list[list[bytes]] = [[] for _ in streams]
    for run in _runs(parts, lambda p: sum(f[2] for f in parsed[p[0]][2][p[1] : p[1] + most])):
        todo = []
        for d, i in run:
            frames = parsed[d][2][i : i + most]
            first = frames[0][0]
            todo.append((streams[d][first : ends[d][i + len(frames) - 1]], [(f[0] - first, f[1], f[2]) for f in frames]))
        for (d, _), samples in zip(run, _decode_frames(todo)):
            found[d].append(samples)
    results = []
    for d, (total, md5, frames) in enumerate(parsed):
        digest, size = hashlib.md5(), 0
        for x in found[d]:
            digest.update((np.frombuffer(x, np.uint8) ^ 128).tobytes())
            size += len(x)
        if size != total or digest.digest() != md5:
            raise ValueError("the decoded samples don't have the stream's digest")
        offsets = np.concatenate(([0], np.cumsum([f[2] for f in frames])))
        results.append((b"".join(found[d]), [(int(offsets[j]), f[2], f[0]) for j, f in enumerate(frames)]))
    return results


def _decode_frames(stretches: list[tuple[bytes, list[tuple[int, int, int]]]]) -> list[bytes]:
    """The samples of each of them, a stretch of bytes and the (offset, header size, samples) of the frames that fill it."""
    bases = np.concatenate(([0], np.cumsum([len(raw) for raw, _ in stretches])))
    buf = np.frombuffer(b"".join(raw for raw, _ in stretches) + bytes(16), np.uint8)
    start = np.array([b + f[0] for b, (_, fs) in zip(bases, stretches) for f in fs], np.int64)
    n = np.array([f[2] for _, fs in stretches for f in fs], np.int64)
    sub = start + np.array([f[1] for _, fs in stretches for f in fs], np.int64)
    ends = np.append(start[1:], bases[-1])
    stored = buf[ends - 2].astype(np.int64) << 8 | buf[ends - 1]
    if (_crc16(buf, start, ends - 2 - start) != stored).any():
        raise ValueError("a frame's CRC-16 is wrong")

    kind = buf[sub].astype(np.int64)
    if (kind & 129).any():
        raise ValueError("reserved or wasted bits are not read")
    kind >>= 1
    out = np.zeros((len(n), int(n.max(initial=1))), np.int64)
    flat = np.flatnonzero(kind == 1)
    if len(flat):
        rows, cols = np.nonzero(np.arange(out.shape[1]) < n[flat][:, None])
        out[flat[rows], cols] = buf[sub[flat[rows]] + 1 + cols].astype(np.int8)
    for i in np.flatnonzero(kind == 0):
        out[i, : n[i]] = np.int8(buf[sub[i] + 1])
    rice = np.flatnonzero(kind > 1)
    if len(rice):
        rice = rice[np.argsort(-n[rice], kind="stable")]
        order = np.where(kind[rice] >= 32, (kind[rice] & 31) + 1, kind[rice] & 7)
        m, pos = n[rice], (sub[rice] + 1 + order) * 8
        for o in range(int(order.max(initial=0))):
            own = rice[order > o]
            out[own, o] = buf[sub[own] + 1 + o].astype(np.int8)
        window = np.zeros(len(buf) - 7, np.uint64)
        for j in range(8):
            window |= buf[j : len(buf) - 7 + j].astype(np.uint64) << np.uint64(56 - 8 * j)

        def peek(p: np.ndarray) -> np.ndarray:
            return window[p >> 3] << (p & 7).astype(np.uint64)

        def take(where: np.ndarray, width: int) -> np.ndarray:
            got = (peek(pos[where]) >> np.uint64(64 - width)).astype(np.int64)
            pos[where] += width
            return got

        linear = np.flatnonzero(kind[rice] >= 32)
        coefficients, shift = np.zeros((len(rice), 32), np.int64), np.zeros(len(rice), np.int64)
        if len(linear):
            precision = take(linear, 4) + 1
            shift[linear] = take(linear, 5)
            for o in range(int(order[linear].max())):
                has = order[linear] > o
                for p in np.unique(precision[has]):
                    own = linear[has & (precision == p)]
                    c = take(own, int(p))
                    coefficients[own, o] = np.where(c >> (p - 1), c - (1 << p), c)
        every = np.arange(len(rice))
        method, parts = take(every, 2), take(every, 4)
        wide = np.where(method == 1, 5, 4)
        if (method > 1).any():
            raise ValueError("reserved residual coding")
        per = m >> parts
        k = np.zeros(len(rice), np.int64)
        lowest = int(order.min())
        active = np.searchsorted(-m, -np.arange(int(m.max())), side="left")
        values = np.zeros((len(rice), int(m.max())), np.int64)
        one_part, top = bool((parts == 0).all()), int(order.max())
        for i in range(lowest, int(m.max())):
            a = int(active[i])
            all_under_way = one_part and i > top
            live = slice(0, a) if all_under_way else np.flatnonzero(order[:a] <= i)
            if not all_under_way:
                entering = live[(i == order[live]) | (i % per[live] == 0)]
                if len(entering):
                    for w in np.unique(wide[entering]):
                        own = entering[wide[entering] == w]
                        k[own] = take(own, int(w))
                    if (k[entering] > 14).any():
                        raise ValueError("escaped partitions and parameters beyond 14 are not read")
            p, kk = pos[live], k[live]
            w = peek(p)
            zeros = 32 - np.frexp((w >> np.uint64(32)).astype(np.float64))[1].astype(np.int64)
            w <<= (zeros + 1).astype(np.uint64)  # at least 24 bits are left, and a parameter is 14 at most
            more = np.flatnonzero(zeros == 32)
            far = more
            while len(more):  # a run of zeros beyond this window
                at = p[more] + zeros[more]
                add = 32 - np.frexp((peek(at) >> np.uint64(32)).astype(np.float64))[1].astype(np.int64)
                zeros[more] += add
                more = more[add == 32]
            p = p + zeros + 1
            if len(far):
                w[far] = peek(p[far])
            rest = ((w >> np.uint64(1)) >> (63 - kk).astype(np.uint64)).astype(np.int64)
            x = zeros << kk | rest
            values[live, i] = (x >> 1) ^ -(x & 1)
            pos[live] = p + kk
        for o in range(5):
            own = np.flatnonzero((kind[rice] < 32) & (order == o))
            if len(own):
                x = values[own]
                warm = out[rice[own], :o]
                # Put the leading differences before the residual, then sum it up once per order.
                for step in range(o, 0, -1):
                    lead = np.diff(warm, n=step - 1, axis=1)[:, 0] if step > 1 else warm[:, 0]
                    x[:, step - 1] = lead
                    x[:, step - 1 :] = np.cumsum(x[:, step - 1 :], axis=1)
                out[rice[own], : x.shape[1]] = x
        if len(linear):
            # Step i restores sample i of every such frame; rows are samples, and TAPS or more zero rows stand before the first.
            taps, most = order[linear], int(order[linear].max())
            c, moved = coefficients[linear, :most].T[::-1].copy(), shift[linear]
            x = np.zeros((most + out.shape[1], len(linear)), np.int64)
            x[most : 2 * most] = out[rice[linear], :most].T[: out.shape[1]] if out.shape[1] >= most else 0
            given = values[linear].T
            for i in range(given.shape[0]):
                restored = ((x[i : i + most] * c).sum(0) >> moved) + given[i]
                x[most + i] = restored if i >= most else np.where(i >= taps, restored, x[most + i])
            out[rice[linear], : given.shape[0]] = x[most : most + given.shape[0]].T
    body = (out + 128).astype(np.uint8)
    results, i = [], 0
    for _, frames in stretches:
        results.append(b"".join(body[i + j, : f[2]].tobytes() for j, f in enumerate(frames)))
        i += len(frames)
    return results


def _runs(items: list, size_of=len) -> Iterator[list]:
    """items in runs of about BATCH_BYTES."""
    run: list = []
    size = 0
    for x in items:
        run.append(x)
        size += size_of(x)
        if size >= BATCH_BYTES:
            yield run
            run, size = [], 0
    if run:
        yield run


def payload(raw: bytes) -> bytes:
    """raw and zero bytes up to a positive multiple of 64."""
    return raw + bytes(-len(raw) % 64 or (0 if raw else 64))


def feature(pcm: bytes) -> str:
    """Loudness, zero-crossing rate, peak and roughness of unsigned 8-bit samples."""
    power = crossings = peak = steps = 0
    for s in range(0, len(pcm), BATCH_BYTES):
        x = np.frombuffer(pcm[max(0, s - 1) : s + BATCH_BYTES], np.uint8).astype(np.int32) - 128  # with the sample before
        power += int((x[s > 0 :] ** 2).sum())
        peak = max(peak, int(np.abs(x).max()))
        crossings += int(((x[1:] < 0) != (x[:-1] < 0)).sum())
        steps += int(np.abs(np.diff(x)).sum())
    return f"rms={(power / len(pcm)) ** 0.5:.4f};zcr={crossings / len(pcm):.4f};peak={peak};step={steps / max(1, len(pcm) - 1):.4f}"


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, media): each whole text as UTF-8, padded and stored as a FLAC stream.

    A null text is an empty one; repeated rows give repeated results; an empty table gives none; a text of any length is one
    stream, coded in stretches of bounded size. Extra columns are not read.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in _runs([t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(part)), pa.array([len(x) for x in part], pa.int64()), pa.array(encode_streams([payload(x) for x in part]), pa.binary())], names=["doc_id", "n_bytes", "media"]
                )
                at += len(part)

    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {id_type}, n_bytes long, media binary")


def decode(media: DataFrame) -> DataFrame:
    """encode()'s rows with pcm (unsigned 8-bit samples), blocks (sample offset, samples, byte offset of its frame) and feature.

    A block can be read alone: its frame starts at its byte offset and its samples are pcm from its sample offset.
    Streams are 8-bit mono of 8 kHz with frames of a fixed blocking, as encode() writes them: constant, plain, fixed and linear-predictor
    subframes, any partition order, no escapes. Whatever encode() writes is read, even if the bytes of a frame look like the next one's header.
    Other streams, and one with a wrong frame checksum or digest, fail the job rather than give wrong samples. A null medium gives null pcm, blocks and feature. An empty table gives no rows.
    """
    names = media.columns
    block = pa.struct([("sample_offset", pa.int64()), ("n_samples", pa.int64()), ("byte_offset", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in _runs(batch.column(names.index("media")).to_pylist(), lambda m: len(m or b"")):
                decoded = iter(decode_streams([m for m in part if m is not None]))
                found = [(None, None) if m is None else next(decoded) for m in part]
                blocks = [x[1] and [dict(zip(("sample_offset", "n_samples", "byte_offset"), b)) for b in x[1]] for x in found]
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(at, len(part)) for c in batch.columns), pa.array([x[0] for x in found], pa.binary()), pa.array(blocks, pa.list_(block)), pa.array([x[0] and feature(x[0]) for x in found], pa.string())],
                    names=[*names, "pcm", "blocks", "feature"],
                )
                at += len(part)

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in media.schema)
    return media.mapInArrow(run, f"{kinds}, pcm binary, blocks array<struct<sample_offset:long,n_samples:long,byte_offset:long>>, feature string")
