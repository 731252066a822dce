"""Substring dedup by seed and extend.

Seeds: texts are winnowed. Every window of `length` words has one anchor, the smallest (the last of equal ones) of its
6-word hashes; equal windows have the same anchor at the same place. Anchors meet by hash; each that is found more
than once gets a leader, its first occurrence in order of (doc_id, place).

Extension: every other occurrence is laid on its leader and the match is extended both ways, word by word. Windows of the
anchor that lie inside the match also start earlier, in the leader. A window that leaves the match differs from the
leader's, and so do all windows equal to it: these meet by the window's hash (96 bits) and the first of them stays.
Overlapping windows to remove merge into maximal repeats, whose words go.

Comparing with the leader alone makes a passage that a million documents share cost its own length in each and no
pairs. Documents are read into pieces of about PIECE words; a piece names each of its anchors and windows once and asks a
leader's piece for each word once, so nothing grows with the frequency of one passage but the number of pieces asking.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import binary_column, gram_hashes, materialize, release
from .packed import by_part, column, framed, only, pack, pack_sorted, rows_table, unframed, unpack, unpack_sorted

GRAM, PIECE = 6, 1_500_000
_BASE2 = 0xD6E8FEB86659FD93
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


class Numbers(dict):
    """word -> number, in order of first use."""

    def __missing__(self, word: bytes) -> int:
        found = self[word] = len(self)
        return found


def window_anchors(h: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the windows that lie within one document, the places of their anchors, and all 6-word hashes.

    h: word hashes of documents one after the other; ends: where each of them ends.
    """
    g = gram_hashes(h, GRAM)
    w = length - GRAM + 1
    n = len(h) - length + 1
    if n < 1:
        return np.empty(0, np.int64), np.empty(0, np.int64), g
    at, low, width = np.arange(len(g)), g, 1
    while width < w:  # place of the sliding minimum by doubling; the later one of equals
        step = min(width, w - width)
        a, b, pa_, pb = low[: len(low) - step], low[step:], at[: len(at) - step], at[step:]
        right = (b < a) | ((b == a) & (pb > pa_))
        low, at, width = np.where(right, b, a), np.where(right, pb, pa_), width + step
    starts = np.arange(n)
    inside = starts + length <= np.repeat(ends, np.diff(ends, prepend=0))[:n]
    return starts[inside], at[:n][inside], g


_PIECE = "piece long, n long, ids binary, lengths binary, words binary, counts binary, tokens binary"


def _pieces(length: int):
    """Documents with an id and a window at least, as numbers of words; order within a piece is by doc_id."""

    def run(batches):
        part, seq = TaskContext.get().partitionId(), 0
        number, docs, at, size = Numbers(), [], [], 0

        def flush():
            order = sorted(range(len(docs)), key=docs.__getitem__)
            token = np.concatenate([at[k] for k in order])
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, number), np.uint64, len(number))
            words, to = np.unique(hashes, return_inverse=True)
            token = to[token]
            counts = np.bincount(token, minlength=len(words))
            rank = np.empty(len(words), np.int64)
            rank[np.argsort(-counts, kind="stable")] = np.arange(len(words))  # small numbers pack well
            row = ((part << 32) | seq, len(token), pack(np.array([docs[k] for k in order]), "<i8"), pack(np.array([len(at[k]) for k in order])), pack_sorted(words), pack(counts), pack(rank[token]))
            return rows_table([row], _PIECE).to_batches()

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), binary_column(batch, "text")):
                words = (text or b"").split()
                if i is None or len(words) < length:
                    continue
                at.append(np.fromiter(map(number.__getitem__, words), np.int32, len(words)))
                docs.append(i)
                size += len(words)
                if size >= PIECE:
                    yield from flush()
                    number, docs, at, size, seq = Numbers(), [], [], 0, seq + 1
        if docs:
            yield from flush()

    return run


class _Piece:
    def __init__(self, row: dict, length: int):
        words, counts = unpack_sorted(row["words"]), unpack(row["counts"]).astype(np.int64)
        self.h = words[np.argsort(-counts, kind="stable")][unpack(row["tokens"])]
        self.ids = unpack(row["ids"], "<i8")
        self.lengths = unpack(row["lengths"]).astype(np.int64)
        self.ends = np.cumsum(self.lengths)
        self.first = self.ends - self.lengths
        self.length = length

    def seeds(self) -> None:
        """Windows, their anchors' places, and the distinct anchors with their first place."""
        self.starts, self.anchor, g = window_anchors(self.h, self.ends, self.length)
        self.places, self.window_place = np.unique(self.anchor, return_inverse=True)
        # documents stand in order of doc_id, so the first of equal anchors is the smallest (doc_id, place)
        self.hashes, first, self.place_hash = np.unique(g[self.places], return_index=True, return_inverse=True)
        self.first_place = self.places[first]
        self.twice = np.bincount(self.place_hash, minlength=len(self.hashes)) > 1

    def doc_of(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, place, "right")


_ASK = "part long, piece long, keys binary, docs binary, at binary, twice binary"
_LED = "kind long, piece long, part long, other long, mask binary, pieces binary, docs binary, at binary"
_LEADERS, _WANTED = 0, 1


def _ask_anchors(length: int, n: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                p = _Piece(row, length)
                p.seeds()
                doc = p.doc_of(p.first_place)
                at = p.first_place - p.first[doc]
                out = [(q, row["piece"], pack_sorted(p.hashes[r]), pack(p.ids[doc[r]], "<i8"), pack(at[r]), np.packbits(p.twice[r]).tobytes()) for q, r in by_part((p.hashes % np.uint64(n)).astype(np.int64), n)]
                yield from rows_table(out, _ASK).to_batches()

    return run


def _lead(key, t):
    """For each asking piece the repeated anchors and their leaders; for the leaders' pieces what they are asked for."""
    q = key[0].as_py()
    pieces = np.array(column(t, "piece"), np.int64)
    keys = [unpack_sorted(x) for x in column(t, "keys")]
    asker = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
    every = np.concatenate(keys)
    docs, at = np.concatenate([unpack(x, "<i8") for x in column(t, "docs")]), np.concatenate([unpack(x) for x in column(t, "at")]).astype(np.int64)
    twice = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=len(k)) for x, k in zip(column(t, "twice"), keys)]).astype(bool)
    order = np.lexsort((pieces[asker], at, docs, every))
    new = np.concatenate(([True], every[order][1:] != every[order][:-1]))
    group = np.empty(len(every), np.int64)
    group[order] = np.cumsum(new) - 1
    leader = order[new][group]
    again = (np.bincount(group)[group] > 1) | twice[leader]
    out, end = [], 0
    wanted: dict = {}
    for k, piece in enumerate(pieces.tolist()):
        mine = np.arange(end, end + len(keys[k]))
        end += len(keys[k])
        mask = again[mine]
        led = leader[mine[mask]]
        from_piece = asker[led]
        out.append((_LEADERS, piece, q, 0, np.packbits(mask).tobytes(), pack(pieces[from_piece], "<i8"), pack(docs[led], "<i8"), pack(at[led])))
        for other in np.unique(from_piece).tolist():
            if other != k:
                r = led[from_piece == other]
                wanted.setdefault(other, []).append((piece, docs[r], at[r]))
    for other, asks in wanted.items():
        for piece, d, a in asks:
            out.append((_WANTED, int(pieces[other]), q, piece, None, None, pack(d, "<i8"), pack(a)))
    return rows_table(out, _LED)


_WORDS = "piece long, other long, keys binary, sizes binary, words binary"


def _spans_of(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of sorted ranges [first, last) that do not cross documents, as disjoint ranges."""
    reach = np.maximum.accumulate(last)
    new = np.concatenate(([True], first[1:] >= reach[:-1]))
    where = np.nonzero(new)[0]
    return first[where], np.concatenate((reach[where[1:] - 1], reach[-1:]))


def _give_words(length: int):
    """The words around the places that each other piece wants: ranges, as document and place, and 48 bits of each word's hash."""

    def run(key, left, right):
        if not left.num_rows or not right.num_rows:
            return rows_table([], _WORDS)
        p = _Piece(only(left), length)
        others = np.array(column(right, "other"), np.int64)
        docs, at = column(right, "docs"), column(right, "at")
        out = []
        for other in np.unique(others).tolist():
            mine = np.nonzero(others == other)[0].tolist()
            d = np.searchsorted(p.ids, np.concatenate([unpack(docs[k], "<i8") for k in mine]))
            place = p.first[d] + np.concatenate([unpack(at[k]) for k in mine]).astype(np.int64)
            place = np.unique(np.minimum(place, p.ends[d] - GRAM))
            d = p.doc_of(place)
            a, b = _spans_of(np.maximum(place - (length - GRAM), p.first[d]), np.minimum(place + length, p.ends[d]))
            size = b - a
            take = np.repeat(a - np.cumsum(size) + size, size) + np.arange(size.sum())
            d = p.doc_of(a)
            out.append((other, key[0].as_py(), pack(p.ids[d], "<i8"), framed(a - p.first[d]) + framed(size), pack_words(p.h[take])))
        return rows_table(out, _WORDS)

    return run


def pack_words(h: np.ndarray) -> bytes:
    return h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpack_words(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


_FOUND = "kind long, piece long, part long, h1 binary, h2 binary, docs binary, starts binary, rest binary, order binary, ids binary, lengths binary"
_STATE, _REST = 0, 1


def extend(own: np.ndarray, place: np.ndarray, low: np.ndarray, high: np.ndarray, other: np.ndarray, lead: np.ndarray, other_low: np.ndarray, other_high: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """How many words to the left of `place` in `own` equal those before `lead` in `other`, and from them to the right.

    Matches stay within [low, high) and [other_low, other_high) and are followed for `most` words to the left and
    GRAM + most to the right.
    """

    def run(steps, sign):
        length = np.zeros(len(place), np.int64)
        alive = np.arange(len(place))
        for k in range(steps):
            x, y = (place[alive] + k, lead[alive] + k) if sign > 0 else (place[alive] - k - 1, lead[alive] - k - 1)
            fine = (x >= low[alive]) & (x < high[alive]) & (y >= other_low[alive]) & (y < other_high[alive])
            alive, x, y = alive[fine], x[fine], y[fine]
            alive = alive[own[x] == other[y]]
            length[alive] += 1
            if not len(alive):
                break
        return length

    return run(most, -1), run(GRAM + most, 1)


def _extend(length: int, n: int):
    def run(key, left, right):
        if not left.num_rows:
            return rows_table([], _FOUND)
        row = only(left)
        piece = key[0].as_py()
        p = _Piece(row, length)
        p.seeds()
        told = right.to_pydict()
        hashes_in = {q: r for q, r in by_part((p.hashes % np.uint64(n)).astype(np.int64), n)}
        m = len(p.hashes)
        repeated, lead_piece, lead_doc, lead_at = np.zeros(m, bool), np.zeros(m, np.int64), np.zeros(m, np.int64), np.zeros(m, np.int64)
        own48 = p.h & np.uint64(0xFFFFFFFFFFFF)
        # the leaders' words: this piece's own, then the ranges of each other piece
        buffers, origin, range_low, range_high, range_key = [own48], len(own48), [], [], []
        for k in range(len(told["kind"])):
            if told["kind"][k] == _LEADERS:
                r = hashes_in[told["part"][k]]
                r = r[np.unpackbits(np.frombuffer(told["mask"][k], np.uint8), count=len(r)).astype(bool)]
                repeated[r] = True
                lead_piece[r], lead_doc[r], lead_at[r] = unpack(told["pieces"][k], "<i8"), unpack(told["docs"][k], "<i8"), unpack(told["at"][k])
        ranges = {}
        for k in range(len(told["kind"])):
            if told["kind"][k] == 2:
                at, size = (x.astype(np.int64) for x in unframed(told["at"][k]))
                begin = origin + np.cumsum(size) - size
                ranges[told["other"][k]] = (unpack(told["docs"][k], "<i8"), at, size, begin)
                buffers.append(unpack_words(told["mask"][k]))
                origin += len(buffers[-1])
        words = np.concatenate(buffers)
        # every occurrence of a repeated anchor but the leader's own
        occ = np.nonzero(repeated[p.place_hash])[0]
        h, place = p.place_hash[occ], p.places[occ]
        doc = p.doc_of(place)
        is_leader = (p.ids[doc] == lead_doc[h]) & (place - p.first[doc] == lead_at[h])
        lead, low, high = (np.full(len(occ), -1, np.int64) for _ in range(3))
        own = lead_piece[h] == piece
        d = np.searchsorted(p.ids, lead_doc[h[own]])
        lead[own], low[own], high[own] = p.first[d] + lead_at[h[own]], p.first[d], p.ends[d]
        for other, (ids, at, size, begin) in ranges.items():
            r = np.nonzero(lead_piece[h] == other)[0]
            order = np.lexsort((at, ids))
            # the last range that starts at or before the leader's place in its document
            k = _last_at_most(ids[order], at[order], lead_doc[h[r]], lead_at[h[r]])
            k = order[k]
            lead[r], low[r], high[r] = begin[k] + lead_at[h[r]] - at[k], begin[k], begin[k] + size[k]
        before, after = extend(own48, place, p.first[doc], p.ends[doc], words, lead, low, high, length - GRAM)
        # windows by their anchors' occurrences
        to = np.full(len(p.places), -1, np.int64)
        to[occ] = np.arange(len(occ))
        k = to[p.window_place]
        seeded = np.nonzero(k >= 0)[0]
        k = k[seeded]
        start = p.starts[seeded]
        inside = (p.anchor[seeded] - start <= before[k]) & (start + length - p.anchor[seeded] <= after[k])
        first_one = is_leader[k]
        sure = start[inside & ~first_one]
        rest = start[~inside & ~first_one]
        h1 = gram_hashes(p.h, length)[rest] if len(rest) else np.empty(0, np.uint64)
        h2 = (gram_hashes(p.h, length, _BASE2)[rest] >> np.uint64(32)) if len(rest) else np.empty(0, np.uint64)
        by = np.lexsort((rest, h2, h1))
        new = np.ones(len(by), bool)
        new[1:] = (h1[by][1:] != h1[by][:-1]) | (h2[by][1:] != h2[by][:-1])
        group = np.empty(len(by), np.int64)
        group[by] = np.cumsum(new) - 1
        head = by[new]
        part = (h1[head] % np.uint64(n)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        doc = p.doc_of(rest[head])
        out = [(_REST, piece, q, pack_sorted(h1[head][r]), pack(h2[head][r]), pack(p.ids[doc[r]], "<i8"), None, None, None, None, None) for q, r in by_part(part, n)]
        rank = np.empty(len(head), np.int64)
        rank[order] = np.arange(len(head))
        out.append((_STATE, piece, 0, None, None, None, pack_sorted(sure), pack_sorted(rest), pack(rank[group]), row["ids"], row["lengths"]))
        return rows_table(out, _FOUND)

    return run


def _last_at_most(ids: np.ndarray, at: np.ndarray, want_id: np.ndarray, want_at: np.ndarray) -> np.ndarray:
    """Row of sorted (ids, at) that is the last at or before each (want_id, want_at)."""
    names = np.unique(np.concatenate((ids, want_id)))
    key = lambda i, a: np.searchsorted(names, i).astype(np.int64) << 32 | a
    return np.maximum(np.searchsorted(key(ids, at), key(want_id, want_at), "right") - 1, 0)


_FIRST = "piece long, part long, n long, mask binary"


def _first_of_rest(key, t):
    """For each piece and window: whether a smaller doc_id of another piece has it too."""
    h1 = [unpack_sorted(x) for x in column(t, "h1")]
    sizes = [len(x) for x in h1]
    h2, docs = np.concatenate([unpack(x) for x in column(t, "h2")]), np.concatenate([unpack(x, "<i8") for x in column(t, "docs")])
    every = np.concatenate(h1)
    order = np.lexsort((docs, h2, every))
    new = np.ones(len(order), bool)
    new[1:] = (every[order][1:] != every[order][:-1]) | (h2[order][1:] != h2[order][:-1])
    later = np.empty(len(order), bool)
    later[order] = docs[order] > docs[order][new][np.cumsum(new) - 1]
    cuts = np.cumsum(sizes)
    return rows_table([(piece, key[0].as_py(), size, np.packbits(later[b - size : b]).tobytes()) for piece, size, b in zip(column(t, "piece"), sizes, cuts.tolist())], _FIRST)


_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_REPEATS = "doc_id long, spans array<struct<start:long,end:long>>"


def _repeats(length: int):
    def run(key, left, right):
        empty = pa.table({"doc_id": pa.array([], pa.int64()), "spans": pa.array([], _SPAN)})
        if not left.num_rows:
            return empty
        row = only(left)
        sure, rest, rank = (unpack_sorted(row["starts"]).astype(np.int64), unpack_sorted(row["rest"]).astype(np.int64), unpack(row["order"]).astype(np.int64))
        answers = sorted(zip(column(right, "part"), column(right, "n"), column(right, "mask")))
        later = np.concatenate([np.unpackbits(np.frombuffer(m, np.uint8), count=k).astype(bool) for _, k, m in answers]) if answers else np.empty(0, bool)
        ids, lengths = unpack(row["ids"], "<i8"), unpack(row["lengths"]).astype(np.int64)
        ends = np.cumsum(lengths)
        # of windows that no other piece has earlier, the first of this piece stays, and its like in repeats of its row
        doc = np.searchsorted(ends, rest, "right")
        place = rest - (ends - lengths)[doc]
        _, first = np.unique(rank, return_index=True)  # rest is in order, so the first is the smallest (doc_id, place)
        same = (ids[doc] == ids[doc[first]][rank]) & (place == place[first][rank]) if len(rest) else np.empty(0, bool)
        starts = np.sort(np.concatenate((sure, rest[later[rank] | ~same] if len(rest) else rest)))
        if not len(starts):
            return empty
        doc = np.searchsorted(ends, starts, "right")
        new = np.ones(len(starts), bool)
        new[1:] = (np.diff(starts) > length) | (np.diff(doc) > 0)
        at = np.nonzero(new)[0]
        a, b = starts[at], np.concatenate((starts[at[1:] - 1], starts[-1:])) + length
        d = doc[at]
        shift = (ends - lengths)[d]
        which, begin = np.unique(d, return_index=True)
        spans = pa.StructArray.from_arrays([pa.array(a - shift), pa.array(b - shift)], ["start", "end"])
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate((begin, [len(d)])).astype(np.int32)), spans)
        return pa.table({"doc_id": pa.array(ids[which]), "spans": lists})

    return run


def _keep(batches):
    for batch in batches:
        kept, total, removed, found = [], [], [], []
        for text, gone in zip(binary_column(batch, "text"), batch.column(2).to_pylist()):
            words = (text or b"").split()
            left, end = [], 0
            for span in gone or ():
                left += words[end : span["start"]]
                end = span["end"]
            left = left + words[end:] if gone else words
            kept.append(b" ".join(left))
            total.append(len(words))
            removed.append(len(words) - len(left))
            found.append(gone or [])
        arrays = [batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array([x.decode("utf-8", "replace") for x in kept], pa.string()), pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()), pa.array(found, _SPAN)]
        yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "n_removed", "kept_text", "kept_sha256", "spans"])


def find_repeats(docs: DataFrame, length: int = 20) -> DataFrame:
    """docs(doc_id, text, ...) -> (doc_id, spans) of documents with words to remove; spans are word positions, end exclusive."""
    if length < GRAM:
        raise ValueError(f"repeats are at least {GRAM} words long")
    pieces = materialize(docs.select("doc_id", "text").mapInArrow(_pieces(length), _PIECE))
    n = max(1, (pieces.agg(F.sum("n")).first()[0] or 0) // PIECE)
    led = materialize(pieces.mapInArrow(_ask_anchors(length, n), _ASK).groupBy("part").applyInArrow(_lead, _LED))
    wanted = led.where(f"kind = {_WANTED}").select("piece", "other", "docs", "at")
    words = pieces.groupBy("piece").cogroup(wanted.groupBy("piece")).applyInArrow(_give_words(length), _WORDS)
    words = words.selectExpr("2L AS kind", "piece", "0L AS part", "other", "words AS mask", "cast(NULL AS binary) AS pieces", "keys AS docs", "sizes AS at")
    told = led.where(f"kind = {_LEADERS}").unionByName(words)
    found = materialize(pieces.groupBy("piece").cogroup(told.groupBy("piece")).applyInArrow(_extend(length, n), _FOUND))
    release(pieces)
    release(led)
    firsts = found.where(f"kind = {_REST}").select("piece", "part", "h1", "h2", "docs").groupBy("part").applyInArrow(_first_of_rest, _FIRST)
    state = found.where(f"kind = {_STATE}").select("piece", "starts", "rest", "order", "ids", "lengths")
    repeats = state.groupBy("piece").cogroup(firsts.groupBy("piece")).applyInArrow(_repeats(length), _REPEATS)
    out = materialize(repeats.dropDuplicates(["doc_id"]))
    release(found)
    return out


def remove_repeats(docs: DataFrame, length: int = 20) -> DataFrame:
    """docs(doc_id, text, ...) -> (doc_id, n_words, n_removed, kept_text, kept_sha256, spans), a row for each row of docs.

    Removes every word that a window of `length` consecutive words covers whose words also start earlier: in a smaller
    doc_id, or earlier in the same document (overlaps included). Windows are judged on the input. spans holds the
    maximal repeats as word positions, end exclusive. Null, empty and short texts lose nothing. Rows that share a doc_id
    are repeats of one row and are no copies of each other; rows without doc_id take no part and are returned whole.
    Other columns are not read. An empty table gives an empty table.
    """
    docs = docs.select("doc_id", "text")
    # joined by a shuffle at every size, as documents with repeats grow with the input; rows without doc_id would all meet there
    repeats = find_repeats(docs, length)
    marked = docs.where("doc_id is not null").join(repeats.hint("merge"), "doc_id", "left").select("doc_id", "text", "spans")
    marked = marked.unionByName(docs.where("doc_id is null").withColumn("spans", F.lit(None).cast(repeats.schema["spans"].dataType)))
    out = "doc_id long, n_words long, n_removed long, kept_text string, kept_sha256 string, spans array<struct<start:long,end:long>>"
    return marked.mapInArrow(_keep, out)
