"""Adaptive context-mixing range coder for token ids, many blocks side by side.

Every block is coded on its own from a fresh model.  All blocks of a batch
advance in step, one id each, as numpy vectors ("lanes"), so the cost of a step
is shared by hundreds of blocks.  The coder's state are whole numbers below
2^53 kept as doubles, hence exact; the model uses element-wise single-precision
arithmetic, which gives the same bits everywhere.

Model of a lane: the id seen last after the same two ids (order 2), after the
same id (order 1), and the block's majority id (order 0) predict the next id.
Three adaptive probabilities that the prediction holds, one per order, are mixed
with weights that follow each order's success.  The arithmetic coder codes
whether it holds, and for a missed id its bit length by an adaptive order-0
distribution; the bits below the leading one follow as they are.
"""

from __future__ import annotations

import zlib

import numpy as np

#: the greatest id that can be coded
MAX_ID = (1 << 31) - 2
#: the greatest id whose prediction fits 32 bits
_NARROW = (1 << 29) - 2
_SLOTS = 1 << 10
_CLASSES = 32
_REBUILD = 32
#: lanes or steps turned at once
_SIDE = 64
_ONE = float(1 << 16)
_FULL = float(1 << 48)
_LEAST = float(1 << 32)


class BlockError(ValueError):
    """A block does not hold what was written."""


class _Encoder:
    """Lanes of a range coder: 48-bit range, 16-bit digits, carries resolved at the end."""

    def __init__(self, lanes: int, expected: int):
        self.low = np.zeros(lanes)
        self.rng = np.full(lanes, _FULL)
        self.n = np.zeros(lanes, np.int64)
        self.digits = np.zeros((expected // 2 + 64, lanes), np.int32)

    def room(self) -> None:
        if int(self.n.max(initial=0)) + 2 * _REBUILD > len(self.digits):
            self.digits = np.concatenate([self.digits, np.zeros_like(self.digits)])

    def _emit(self, idx: np.ndarray) -> None:
        low = self.low[idx]
        top = np.floor(low / _LEAST)
        self.digits[self.n[idx], idx] = top
        self.low[idx] = (low - top * _LEAST) * _ONE
        self.n[idx] += 1

    def narrow(self, a: int, start: np.ndarray, freq: np.ndarray, r: np.ndarray) -> None:
        self.low[:a] += start * r
        rng = self.rng[:a]
        np.multiply(freq, r, out=rng)
        idx = np.flatnonzero(rng < _LEAST)
        if len(idx):
            self._emit(idx)
            rng[idx] *= _ONE

    def finish(self) -> list[bytes]:
        every = np.arange(len(self.low))
        for _ in range(3):
            self.room()
            self._emit(every)
        carry = np.zeros(len(self.low), np.int32)
        for i in range(int(self.n.max(initial=0)) - 1, -1, -1):
            row = self.digits[i]
            row += carry
            carry = row >> 16
            row &= 0xFFFF
        out = np.ascontiguousarray(self.digits.T.astype("<u2"))
        return [out[j, :k].tobytes() for j, k in enumerate(self.n.tolist())]


class _Decoder:
    def __init__(self, digits: list[bytes], raw: list[bytes]):
        self.data = np.frombuffer(b"".join(p + b"\0" * 8 for p in digits), "<u2").astype(np.float64)
        self.pos = np.cumsum([0] + [len(p) // 2 + 4 for p in digits[:-1]])
        self.code = (self.data[self.pos] * _ONE + self.data[self.pos + 1]) * _ONE + self.data[self.pos + 2]
        self.pos = self.pos + 3
        self.rng = np.full(len(digits), _FULL)
        words = np.frombuffer(b"".join(p + b"\0" * 8 for p in raw) + b"\0" * 8, "<u2").astype(np.int64)
        self.window = words[:-2] | words[1:-1] << 16 | words[2:] << 32
        self.bit = 16 * np.cumsum([0] + [len(p) // 2 + 4 for p in raw[:-1]])

    def narrow(self, a: int, start: np.ndarray, freq: np.ndarray, r: np.ndarray) -> None:
        code, rng = self.code[:a], self.rng[:a]
        code -= start * r
        np.multiply(freq, r, out=rng)
        idx = np.flatnonzero(rng < _LEAST)
        if len(idx):
            at = self.pos[idx]
            code[idx] = code[idx] * _ONE + self.data.take(at, mode="clip")  # a damaged block may run on; its checksum tells
            rng[idx] *= _ONE
            self.pos[idx] = at + 1

    def bits(self, a: int, cls: np.ndarray) -> np.ndarray:
        """The numbers of these bit lengths (a 1 for none), the bits below the leading one read."""
        n = np.maximum(cls, 1).astype(np.int64)
        n -= 1
        bit, top = self.bit[:a], 1 << n
        value = self.window.take(bit >> 4, mode="clip")
        value >>= bit & 15
        value &= top - 1
        value += top
        bit += n
        return value


def _shares(count: np.ndarray) -> np.ndarray:
    """Class frequencies in 256ths, at least one each; what is left goes to the most frequent."""
    total = np.maximum(count.sum(axis=1, keepdims=True), 1)
    n8 = np.floor(count * float(256 - _CLASSES) / total).astype(np.int64) + 1
    n8[np.arange(len(count)), count.argmax(axis=1)] += 256 - n8.sum(axis=1)
    return n8


def _run(coder, lengths: np.ndarray, known: np.ndarray | None, kind: type) -> tuple[np.ndarray, np.ndarray | None]:
    """Code all lanes (lengths descending).  known: id + 1 by [step, lane], or None to decode; kind: type of ids.

    Returns it and, when encoding, the bit lengths of the missed ids (0 for the others).
    """
    lanes, steps = len(lengths), int(lengths[0])
    coding = known is not None
    every = known if coding else np.zeros((steps, lanes), kind)
    lane = np.arange(lanes)
    if coding:
        tails = np.zeros((steps, lanes), np.uint8)
    seen = np.zeros((_REBUILD, lanes), np.uint8)  # classes of the last steps
    classes = np.tile(np.arange(_CLASSES, dtype=np.uint8), lanes)
    slot = np.stack([lane * _SLOTS, (lane + lanes) * _SLOTS])
    pred = np.zeros(2 * lanes * _SLOTS, kind)  # (id + 1) * 4 + confidence, of orders 1 and 2
    major, votes = np.ones(lanes, kind), np.zeros(lanes, np.int64)
    table = np.full(lanes * 24, 0.25, np.float32)  # adaptive probabilities: 8 states for each order
    base = np.stack([lane * 24, lane * 24 + 8, lane * 24 + 16])
    weights = np.full((3, lanes), 1 / 3, np.float32)
    count = np.zeros((lanes, _CLASSES), np.int64)
    hashes = np.zeros((2, lanes), kind)
    recents = np.zeros(lanes, np.int64)
    rate, keep, least, even = (np.float32(x) for x in (1 / 16, 0.98, 1e-6, 0.02 / 3))
    scale, offset, one = np.float32(_ONE - 1024), np.float32(256), np.float32(1)
    active = np.searchsorted(-lengths, -np.arange(steps), side="left").tolist()  # lanes longer than t
    width = -1
    for t in range(steps):
        a = active[t]
        if a != width:
            width = a
            sl, bs, wt, mj, vt = slot[:, :a], base[:, :a], weights[:, :a].copy(), major[:a], votes[:a]
            l32, l256 = lane[:a] * _CLASSES, lane[:a] * 256
            h, recent = hashes[:, :a].copy(), recents[:a].copy()
            weights, hashes, recents = wt, h, recent
            at, st = np.empty((2, a), np.int64), np.empty((3, a), np.int64)
            np.add(sl, [[0], [0]], out=at)
            at[0] += h[0]
            at[1] += h[0] + 37 * h[1] & (_SLOTS - 1)
            e, g, k, up = (np.empty((2, a), kind) for _ in range(4))
            agree = np.empty((2, a), bool)
            p, d, m = (np.empty((3, a), np.float32) for _ in range(3))
            hit, miss = np.empty(a, bool), np.empty(a, bool)
            guess, f, left, r, start, freq = np.empty(a, kind), *(np.empty(a) for _ in range(5))
            norm, ix, fresh = np.empty(a, np.float32), np.empty(a, np.int64), np.empty(a, kind)
        if t % _REBUILD == 0:
            if coding:
                coder.room()
                # the exponents of id + 1 are its bit lengths
                lengths_of = np.frexp(every[t:t + _REBUILD].astype(np.float64))[1].astype(np.uint8)
            # class 0 is no class: a hit
            count += np.bincount((seen + lane * _CLASSES).ravel(), minlength=lanes * _CLASSES).reshape(count.shape)
            count[:, 0] = 0
            seen.fill(0)
            n8 = _shares(count)
            f8 = n8.astype(np.float64)
            c8, f8 = (np.cumsum(f8, axis=1) - f8).ravel(), f8.ravel()
            if not coding:
                find = np.repeat(classes, n8.ravel())
        np.take(pred, at, out=e, mode="clip")
        np.right_shift(e, 2, out=g)
        np.bitwise_and(e, 3, out=k)
        np.copyto(guess, mj)
        np.greater(g, 0, out=agree)
        np.copyto(guess, g[0], where=agree[0])
        np.copyto(guess, g[1], where=agree[1])
        np.equal(g, guess, out=agree)
        st[0] = recent
        np.left_shift(agree.view(np.uint8), 2, out=st[1:])
        st[1:] += k
        st += bs
        np.take(table, st, out=p, mode="clip")
        np.multiply(wt, p, out=m)
        mixed = m[0]
        mixed += m[1]
        mixed += m[2]
        mixed *= scale
        mixed += offset
        np.floor(mixed, out=f)
        np.multiply(coder.rng[:a], 1 / _ONE, out=r)
        np.floor(r, out=r)
        np.subtract(_ONE, f, out=left)
        left *= 1 / 256
        np.floor(left, out=left)
        if coding:
            now = every[t, :a]
            np.equal(now, guess, out=hit)
            np.logical_not(hit, out=miss)
            cls = tails[t, :a]
            np.multiply(lengths_of[t % _REBUILD, :a], miss.view(np.uint8), out=cls)
        else:
            value = coder.code[:a] / r
            np.floor(value, out=value)
            np.less(value, f, out=hit)
            np.logical_not(hit, out=miss)
            value -= f
            value /= left
            np.minimum(value, 255, out=value)
            value *= miss
            cls = find.take(l256 + value.astype(np.int64))
            cls *= miss.view(np.uint8)
        seen[t % _REBUILD, :a] = cls
        np.add(l32, cls, out=ix)
        np.take(c8, ix, out=start, mode="clip")
        np.take(f8, ix, out=freq, mode="clip")
        start *= left
        start += f
        start *= miss
        freq *= left
        np.copyto(freq, f, where=hit)
        coder.narrow(a, start, freq, r)
        if not coding:
            now = every[t, :a]
            np.copyto(now, coder.bits(a, cls), casting="unsafe")
            np.copyto(now, guess, where=hit)
        # adapt
        np.subtract(hit, p, out=d)
        np.multiply(d, rate, out=m)
        m += p
        table[st] = m
        np.abs(d, out=d)
        np.subtract(one, d, out=d)
        wt *= d
        np.add(wt[0], wt[1], out=norm)
        norm += wt[2]
        np.maximum(norm, least, out=norm)
        np.divide(keep, norm, out=norm)
        wt *= norm
        wt += even
        np.less(k, 3, out=agree)
        np.add(e, agree, out=up)
        np.not_equal(g, now, out=agree)
        np.left_shift(now, 2, out=fresh)
        np.copyto(up, fresh, where=agree)
        pred[at] = up
        if t % 4 == 0:  # majority vote over every fourth id
            vt += np.where(now == mj, 1, -1)
            lost = vt < 0
            np.copyto(mj, now, where=lost)
            np.copyto(vt, 1, where=lost)
        recent += recent
        recent += hit
        recent &= 7
        # contexts of the next id: a hash of this one, and of this one and the one before
        h[1] = h[0]
        np.multiply(now, 40503, out=fresh)
        fresh >>= 4
        np.bitwise_and(fresh, _SLOTS - 1, out=h[0])
        np.add(sl[0], h[0], out=at[0])
        np.multiply(h[1], 37, out=fresh)
        fresh += h[0]
        fresh &= _SLOTS - 1
        np.add(sl[1], fresh, out=at[1])
    return every, tails if coding else None


def _pack(ids: np.ndarray, tails: np.ndarray) -> list[bytes]:
    """Per lane of id + 1, the bits below the leading one of its missed ids, end to end in 32-bit words."""
    out = []
    for i in range(0, tails.shape[1], _SIDE):
        size = np.ascontiguousarray(tails[:, i:i + _SIDE].T)
        at = np.flatnonzero(size > 1)  # a leading one alone has no bits below it
        n = size.ravel()[at].astype(np.int64) - 1
        values = np.ascontiguousarray(ids[:, i:i + _SIDE].T).ravel()[at].astype(np.int64) & ((1 << n) - 1)
        lane = np.searchsorted(at, np.arange(len(size) + 1) * size.shape[1])
        ends = np.concatenate([[0], np.cumsum(n)])
        words = (np.diff(ends[lane]) + 31) // 32 + 2
        first = np.cumsum(words) - words
        bit = ends[:-1] + np.repeat(32 * first - ends[lane[:-1]], np.diff(lane))
        values <<= bit & 31
        word = bit >> 5
        data = np.zeros(int(words.sum()) + 1, np.uint32)
        if len(word):
            start = np.flatnonzero(np.diff(word, prepend=-1))
            data[word[start]] = np.bitwise_or.reduceat(values & 0xFFFFFFFF, start)
            data[word[start] + 1] |= np.bitwise_or.reduceat(values >> 32, start).astype(np.uint32)
        data = data.astype("<u4")
        out += [data[j:j + m].tobytes() for j, m in zip(first.tolist(), words.tolist())]
    return out


def _turned(x: np.ndarray) -> np.ndarray:
    """The transposed matrix, in order, made in squares."""
    out = np.empty(x.shape[::-1], x.dtype)
    for i in range(0, x.shape[0], _SIDE):
        for j in range(0, x.shape[1], _SIDE):
            out[j:j + _SIDE, i:i + _SIDE] = x[i:i + _SIDE, j:j + _SIDE].T
    return out


def _kinds(wide: list[bool]) -> list[tuple[type, list[int]]]:
    """The type of ids and the places of the blocks with ids of 29 bits at most, and of the others."""
    return [(kind, [i for i, w in enumerate(wide) if w == flag]) for kind, flag in ((np.int32, False), (np.int64, True))]


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """One payload per block of ids (each 0 to ``MAX_ID``).  Raises ``ValueError`` for others."""
    if any(len(b) and not (0 <= int(np.min(b)) and int(np.max(b)) <= MAX_ID) for b in blocks):
        raise ValueError(f"ids are from 0 to {MAX_ID}")
    payloads: list[bytes] = [b""] * len(blocks)
    for kind, some in _kinds([len(b) > 0 and int(np.max(b)) > _NARROW for b in blocks]):
        order = sorted((i for i in some if len(blocks[i])), key=lambda i: -len(blocks[i]))
        if not order:
            continue
        lengths = np.array([len(blocks[i]) for i in order], np.int64)
        rows = np.zeros((len(order), int(lengths[0])), kind)
        for row, i in zip(rows, order):
            row[:len(blocks[i])] = blocks[i]
        rows += 1
        ids = _turned(rows)
        coder = _Encoder(len(order), int(lengths[0]))
        _, tails = _run(coder, lengths, ids, kind)
        for i, digits, raw in zip(order, coder.finish(), _pack(ids, tails)):
            # the length's lowest bit tells of greater ids; digits are pairs of bytes
            body = (len(digits) | (kind is np.int64)).to_bytes(4, "little") + digits + raw
            payloads[i] = zlib.crc32(body).to_bytes(4, "little") + body
    return payloads


def decode_blocks(payloads: list[bytes], lengths: list[int]) -> list[np.ndarray]:
    """The blocks of ids, as unsigned 32-bit integers.  Raises ``BlockError`` for a damaged payload."""
    blocks: list[np.ndarray] = [np.empty(0, np.uint32)] * len(payloads)
    heads = [0] * len(payloads)
    for i, payload in enumerate(payloads):
        if lengths[i]:
            if len(payload) < 8 or zlib.crc32(payload[4:]) != int.from_bytes(payload[:4], "little"):
                raise BlockError(f"payload {i} of the batch: checksum differs")
            heads[i] = int.from_bytes(payload[4:8], "little")
    for kind, some in _kinds([head & 1 == 1 for head in heads]):
        order = sorted((i for i in some if lengths[i]), key=lambda i: -lengths[i])
        if not order:
            continue
        cut = [8 + (heads[i] & -2) for i in order]
        coder = _Decoder([payloads[i][8:c] for i, c in zip(order, cut)], [payloads[i][c:] for i, c in zip(order, cut)])
        sizes = np.array([lengths[i] for i in order], np.int64)
        ids, _ = _run(coder, sizes, None, kind)
        ids -= 1
        for row, i in zip(_turned(ids), order):
            blocks[i] = row[:lengths[i]].astype("<u4")
    return blocks
