"""Token ids by an adaptive context-mixing range coder, in independent checksummed blocks.

A block is cut into lanes that are coded side by side, each by a range coder of its own (64-bit range, 32-bit output,
carries carried back), over models that all lanes of the block share and that start afresh with every block:

- order 2 and order 1: the id last seen after the two ids before, or after the one before, with a confidence;
- order 0: counts of the block's ids so far, rounded to a table of 2**18 slots in which every id has one at least.

The probability of an id is a mixture: the order-2 id's share, the order-1 id's, and the order-0 table scaled to the
rest. The shares are mixing weights learned online for each pair of confidences. Encoder and decoder update the models
alike, step by step, in integers.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC, LANES, STEPS = b"FLID1\0", 4096, 512
_SLOTS, _UNIT = 18, np.uint64(18)
_TOTAL = np.uint64(26)
_HASH = 18
_NONE, _ALL = np.uint64(0), np.uint64(1) << _UNIT
_LOW = np.uint64(1) << np.uint64(32)
_S32 = np.uint64(32)
_HEAD, _HEAD_SIZE = "<6sIIII", 22  # magic, documents, ids, lanes, vocabulary


#: By 2 * confidence + whether the id came true: the confidence's change, and whether the id stays.
_CHANGE = np.array([x for c in range(16) for x in (-((c + 1) >> 1), int(c < 15))], np.int32)
_KEPT = np.array([x for c in range(16) for x in (c >= 2, True)])


class _Models:
    def __init__(self, lanes: int, vocabulary: int):
        self.two = np.zeros(1 << _HASH, np.int32)
        self.one = np.zeros(vocabulary, np.int32)
        c2, c1 = np.divmod(np.arange(512) >> 1, 16)
        self.seen = np.column_stack([1 + 4 * c2, 1 + 2 * c1, np.full(512, 6)]).astype(np.int64)
        self.ids = np.zeros(vocabulary, np.int64)
        self.a = np.zeros(lanes, np.int64)
        self.b = np.zeros(lanes, np.int64)
        self.steps, self.classes, self.recent = 0, [], []
        self._shares()
        self._slots()

    def _shares(self) -> None:
        s = self.seen.sum(1)
        h2, h1 = 1 + 253 * self.seen[:, 0] // s, 1 + 253 * self.seen[:, 1] // s
        share = np.column_stack([h2, h1, 256 - h2 - h1])
        start = np.column_stack([np.zeros(512, np.int64), h2, h2 + h1])
        self.m = share[:, 2].astype(np.uint64)
        self.bound1, self.bound2 = start[:, 1].astype(np.uint64), start[:, 2].astype(np.uint64)
        self.start = (start.astype(np.uint64) << _UNIT).ravel()
        self.part = share.astype(np.uint64).ravel()
        self.share = (share.astype(np.uint64) << _UNIT).ravel()

    def _slots(self) -> None:
        free = (1 << _SLOTS) - len(self.ids)
        f = 1 + self.ids * free // max(1, int(self.ids.sum()))
        f[int(np.argmax(self.ids))] += (1 << _SLOTS) - int(f.sum())
        self.f = f.astype(np.uint64)
        self.c = (np.cumsum(f) - f).astype(np.uint64)
        self.look = None

    def lookup(self) -> np.ndarray:
        if self.look is None:
            self.look = np.repeat(np.arange(len(self.f), dtype=np.int32), self.f.astype(np.int64))
        return self.look

    def predict(self) -> None:
        """Order-2 and order-1 ids and the mixing context of each lane."""
        self.h = (self.b * 0x2545F491 + self.a * 0x9E3779B1 >> 9) & ((1 << _HASH) - 1)
        self.e2, self.e1 = self.two.take(self.h, mode="clip"), self.one.take(self.a, mode="clip")
        self.p2, self.p1 = self.e2 >> 4, self.e1 >> 4
        self.ctx = (((self.e2 & 15) << 4 | (self.e1 & 15)) << 1 | (self.p1 == self.p2)).astype(np.int64)

    def update(self, x: np.ndarray, k: np.ndarray, hit2: np.ndarray, hit1: np.ndarray) -> None:
        """x: the ids; k: 3 * mixing context + which part coded it; which of the two ids came true."""
        first = (x.astype(np.int32) << 4) | 1
        for table, at, e, hit in ((self.two, self.h, self.e2, hit2), (self.one, self.a, self.e1, hit1)):
            # an id that came true gains confidence, a confident one that did not loses half of it, any other is replaced
            state = (e & 15).astype(np.int64)
            state += state
            state += hit
            table[at] = np.where(_KEPT.take(state, mode="clip"), e + _CHANGE.take(state, mode="clip"), first)
        self.b, self.a = self.a, x
        self.classes.append(k)
        self.recent.append(x)
        self.steps += 1
        t = self.steps
        if t < 8 or t % 8 == 0:
            self.seen += np.bincount(np.concatenate(self.classes), minlength=1536).reshape(512, 3)
            self.classes = []
            self._shares()
        if t % 64 == 0 or t & (t - 1) == 0:
            self.ids += np.bincount(np.concatenate(self.recent), minlength=len(self.ids))
            self.recent = []
            self._slots()


def _lanes(n: int) -> int:
    return int(np.clip(-(-n // STEPS), 1, LANES))


def encode_ids(ids: np.ndarray, vocabulary: int) -> bytes:
    """A block's lanes: their sizes in words, then their words."""
    n = len(ids)
    lanes = _lanes(n)
    steps = -(-n // lanes)
    grid = np.zeros(lanes * steps, np.int64)
    grid[:n] = ids
    grid = np.ascontiguousarray(grid.reshape(lanes, steps).T)
    model = _Models(lanes, vocabulary)
    low, rng = np.zeros(lanes, np.uint64), np.full(lanes, 2**64 - 1, np.uint64)
    out, at = np.zeros((lanes, steps + 3), np.uint32), np.ones(lanes, np.int64)  # word 0 takes a carry out of the first
    for x in grid:
        model.predict()
        hit2, hit1 = x == model.p2, x == model.p1
        cls = 2 - (hit2.view(np.int8) * 2 + (hit1 & ~hit2))
        k = model.ctx * 3 + cls
        start, part = model.start.take(k, mode="clip"), model.part.take(k, mode="clip")
        miss = cls == 2
        start += np.where(miss, model.c.take(x, mode="clip"), _NONE) * part
        share = np.where(miss, model.f.take(x, mode="clip"), _ALL) * part
        rng >>= _TOTAL
        start *= rng
        low += start
        rng *= share
        for lane in np.nonzero(low < start)[0]:
            p = at[lane] - 1
            while out[lane, p] == 0xFFFFFFFF:
                out[lane, p] = 0
                p -= 1
            out[lane, p] += 1
        full = np.nonzero(rng < _LOW)[0]
        v = low[full]
        out[full, at[full]] = v >> _S32
        at[full] += 1
        low[full] = v << _S32
        rng[full] <<= _S32
        model.update(x, k, hit2, hit1)
    for word in (low >> _S32, low & np.uint64(0xFFFFFFFF)):
        out[np.arange(lanes), at] = word
        at += 1
    return at.astype("<u4").tobytes() + b"".join(out[k, : at[k]].astype("<u4").tobytes() for k in range(lanes))


def decode_ids(data: bytes, n: int, lanes: int, vocabulary: int) -> np.ndarray:
    steps = -(-n // lanes)
    words = np.frombuffer(data, "<u4")
    sizes = words[:lanes].astype(np.int64)
    at = lanes + np.cumsum(sizes) - sizes
    words = np.concatenate((words, np.zeros(2, np.uint32))).astype(np.uint64)
    if words[at].any():
        raise ValueError("a lane starts with a carry")
    at += 1
    off = (words[at] << _S32) | words[at + 1]
    at += 2
    rng = np.full(lanes, 2**64 - 1, np.uint64)
    model = _Models(lanes, vocabulary)
    grid = np.empty((steps, lanes), np.int32)
    for t in range(steps):
        model.predict()
        rng >>= _TOTAL
        value = off // rng
        unit = value >> _UNIT
        ctx = model.ctx
        cls = (unit >= model.bound1.take(ctx, mode="clip")).astype(np.int8) + (unit >= model.bound2.take(ctx, mode="clip"))
        k = ctx * 3 + cls
        start, share = model.start.take(k, mode="clip"), model.share.take(k, mode="clip")
        x = np.where(cls == 0, model.p2, model.p1).astype(np.int64)
        miss = np.nonzero(cls == 2)[0]
        m = share[miss] >> _UNIT
        y = model.lookup()[((value[miss] - start[miss]) // m).astype(np.int64)]
        x[miss] = y
        start[miss] += model.c.take(y, mode="clip") * m
        share[miss] = model.f.take(y, mode="clip") * m
        off -= start * rng
        rng *= share
        full = np.nonzero(rng < _LOW)[0]
        p = at[full]
        off[full] = (off[full] << _S32) | words[p]
        at[full] = p + 1
        rng[full] <<= _S32
        grid[t] = x
        model.update(x, k, x == model.p2, x == model.p1)
    return grid.T.reshape(-1)[:n]


def encode_block(doc_ids: list, counts: list[int], ids: np.ndarray, vocabulary: int) -> bytes:
    """One block: header, checksum, documents (ids, nulls, lengths), coded ids. It needs no other block to be read."""
    nulls = bytes(x is None for x in doc_ids)
    table = zlib.compress(nulls + np.array([x or 0 for x in doc_ids], "<i8").tobytes() + np.array(counts, "<i8").tobytes(), 1)
    head = struct.pack(_HEAD, MAGIC, len(doc_ids), len(ids), _lanes(len(ids)), vocabulary)
    body = struct.pack("<I", len(table)) + table + encode_ids(ids, vocabulary)
    return head + struct.pack("<I", zlib.crc32(body, zlib.crc32(head))) + body


def decode_block(data: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """-> (doc_ids, counts, ids); a damaged block raises ValueError."""
    if len(data) < _HEAD_SIZE + 8 or data[:6] != MAGIC:
        raise ValueError("not a block of token ids")
    head, body = data[: _HEAD_SIZE], data[_HEAD_SIZE + 4 :]
    if zlib.crc32(body, zlib.crc32(head)) != struct.unpack_from("<I", data, _HEAD_SIZE)[0]:
        raise ValueError("a block's checksum is wrong")
    _, docs, n, lanes, vocabulary = struct.unpack(_HEAD, head)
    (size,) = struct.unpack_from("<I", body)
    table = zlib.decompress(body[4 : 4 + size])
    doc_ids = [None if null else x for null, x in zip(table[:docs], np.frombuffer(table, "<i8", docs, docs).tolist())]
    return doc_ids, np.frombuffer(table, "<i8", docs, 9 * docs), decode_ids(body[4 + size :], n, lanes, vocabulary)
