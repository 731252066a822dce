"""LM scoring with a hierarchical Pitman-Yor model of word pairs.

Every token is a customer in the restaurant of the word before it (the end token at a text's start); there is one
restaurant for each word of the corpus. All of them share one parent, the word restaurant, whose customers are their
tables; its base measure is uniform over the training words and one unknown token, the event space of the base score.

Seatings are sampled by Gibbs steps: a customer drawn at random leaves, its table closes if it was alone, and it sits
down again at a table of its dish (weight: others there less the discount) or a new one (weight: concentration plus
discount times the restaurant's tables, times the parent's probability). A sweep takes every customer of each
dish once; all dishes move side by side, on the other dishes' tables as they were after the sweep before, and are told
the new totals after it. The first KEEP_FROM samples are burn-in; predictive probabilities of the later ones are
averaged. A pair seen once has one table always and needs no sampling.

Hyper-parameters: concentrations are THETA; discounts are n1 / (n1 + 2 n2) of the counts of counts, of pairs and of the
first parent customers. Words are told apart by 64-bit hashes.

All counts and seatings are Spark tables that grow with the corpus. Documents are read once, into pieces of about
PIECE tokens; a piece asks for each distinct word and pair once, so a word of every text costs a row's share for each
piece, and parts of words and of pairs are dealt out by hash: none grows with one word's frequency. A sweep does take
time and memory for each customer of a dish, who move one after the other. Rows hold packed arrays (sorted numbers, byte
planes, zstd), as rows of single numbers would take several times the space.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import binary_column, crc_mod, materialize, mix, release
from .packed import by_part, column, dealt, framed, only, pack, pack_pairs, pack_sorted, rows_table, unframed, unpack, unpack_pairs, unpack_sorted

SAMPLES, KEEP_FROM, THETA = 3, 2, 1.0
PIECE = 1_600_000
#: Parts of words and pairs; None: one for each PIECE tokens.
PARTS = None
#: Dishes for which a step at once takes as long as for one after the other.
AT_ONCE = 64
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_32 = np.uint64(32)
#: The hash of the end token, which is the empty word.
END = np.uint64(xxhash.xxh64_intdigest(b""))


def pair_part(key: np.ndarray, n: int) -> np.ndarray:
    return (mix(key * _GOLD) % np.uint64(n)).astype(np.int64)


def word_part(x: np.ndarray, n: int) -> np.ndarray:
    return (x % np.uint64(n)).astype(np.int64)


# ---------------------------------------------------------------- seating


def tables_of(c: np.ndarray, gain: np.ndarray, d: float) -> np.ndarray:
    """About the tables that c customers take who come one by one; the start of the sampling, not a sample."""
    t, i = np.minimum(c, 1).astype(np.float64), 1
    alive = np.nonzero(c > 1)[0]
    while len(alive):
        n = np.minimum(max(1, i // 8), c[alive] - i)
        t[alive] += n * gain[alive] / (np.maximum(i + (n - 1) / 2 - d * t[alive], 1e-9) + gain[alive])
        i += max(1, i // 8)
        alive = alive[c[alive] > i]
    return np.minimum(np.floor(t + 0.5), c).astype(np.int64)


def seat_all(c: np.ndarray, t: np.ndarray, d: float) -> np.ndarray:
    """Flat sizes of t tables for c customers of each dish, the first ones large."""
    first = np.cumsum(t) - t
    rank = np.arange(int(t.sum())) - np.repeat(first, t)
    weight = (1.0 + rank) ** (-1 / max(d, 0.05))
    total = np.add.reduceat(weight, first[t > 0]) if len(rank) else weight
    share = weight / np.repeat(total, t[t > 0])
    sizes = 1 + np.floor(np.repeat(c - t, t) * share).astype(np.int64)
    given = np.add.reduceat(sizes, first[t > 0]) if len(rank) else sizes
    sizes[first[t > 0]] += c[t > 0] - given
    return sizes


def resize(sizes: np.ndarray, t: np.ndarray, old: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sizes for `new` customers where there were `old`, in proportion; dishes that had none get one table."""
    first = np.cumsum(t) - t
    had = t > 0
    ratio = np.ones(len(t))
    ratio[had] = new[had] / old[had]
    sizes = np.floor(sizes * np.repeat(ratio, t) + 1e-9).astype(np.int64)
    if had.any():
        sizes[first[had]] += new[had] - np.add.reduceat(sizes, first[had])
    owner = np.repeat(np.arange(len(t)), t)
    fresh = np.nonzero(~had & (new > 0))[0]
    owner, sizes = np.concatenate((owner[sizes > 0], fresh)), np.concatenate((sizes[sizes > 0], new[fresh]))
    order = np.argsort(owner, kind="stable")
    return sizes[order], np.bincount(owner, minlength=len(t))


def gibbs(sizes: np.ndarray, t: np.ndarray, c: np.ndarray, fixed: np.ndarray, slope: np.ndarray, d: float, hashes: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Every customer of each dish leaves once and sits down again, one after the other, in a random order.

    sizes: the tables, dish after dish; t: tables, c: customers of each dish. A new table weighs fixed + slope * (the
    dish's tables without the customer). -> new sizes (without empty tables) and t.
    """
    source = np.cumsum(t) - t
    active = np.argsort(-c, kind="stable")[: np.count_nonzero(c > 1)]
    # the most frequent dishes go one by one, as steps for a few dishes at once cost more
    alone = int(np.argmin(np.concatenate(([0], np.cumsum(c[active]))) + AT_ONCE * np.append(c[active], 0)))
    idle = np.ones(len(t), bool)
    idle[active] = False
    every, owner = [sizes[np.repeat(idle, t)]], [np.repeat(np.nonzero(idle)[0], t[idle])]
    for k in active[:alone].tolist():
        every.append(_move_alone(sizes[source[k] : source[k] + t[k]], float(fixed[k]), float(slope[k]), d, int(hashes[k]), salt))
        owner.append(np.full(len(every[-1]), k))
    active = active[alone:]
    moved, room = _move_together(sizes, t[active], source[active], c[active], fixed[active], slope[active], d, hashes[active], salt)
    every.append(moved[moved > 0])
    owner.append(np.repeat(active, room)[moved > 0])
    every, owner = np.concatenate(every), np.concatenate(owner)
    return every[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(t))


def _move_together(sizes: np.ndarray, t: np.ndarray, source: np.ndarray, c: np.ndarray, fixed: np.ndarray, slope: np.ndarray, d: float, h: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """A sweep of dishes in order of falling c, a customer of each at a step. -> sizes in t + c slots a dish, slots."""
    room = t + c  # every step may open one table in a slot of its own
    start, first = np.cumsum(room) - room, np.cumsum(c) - c
    rank = np.arange(int(t.sum())) - np.repeat(np.cumsum(t) - t, t)
    flat = np.zeros(int(room.sum()), np.int64)
    slots = np.repeat(start, t) + rank
    flat[slots] = sizes[np.repeat(source, t) + rank]
    seat = np.repeat(slots, flat[slots])  # the table of each customer
    used, now = t.copy(), t.astype(np.float64)
    rng = np.random.Generator(np.random.PCG64([salt, *h[:1].tolist()]))
    others = c - 1
    dishes = len(c) - np.searchsorted(c[::-1], np.arange(c.max(initial=0)), "right")  # those with more than `step` customers
    for step, n in enumerate(dishes.tolist()):
        begin, rest, tables = first[:n], others[:n], now[:n]
        pick, new, at = rng.random((3, n))
        # one of those who have not moved yet leaves; its seat is the step's place from here on
        place = begin + step
        pick = place + (pick * (rest + (1 - step))).astype(np.int64)
        table = seat[pick]
        seat[pick] = seat[place]
        size = flat[table] - 1
        flat[table] = size
        tables -= size == 0
        gain = fixed[:n] + slope[:n] * tables
        new = new * (rest - d * tables + gain) < gain
        # a table by its other customers, kept with (size - discount) / size
        at *= rest
        other = at.astype(np.int64)
        table = seat[begin + other + (other >= step)]
        size = flat[table]
        left = np.nonzero(~(((at - other) * size < size - d) | (tables == 1) | new))[0]
        while len(left):
            at = rng.random(len(left)) * rest[left]
            other = at.astype(np.int64)
            found = seat[begin[left] + other + (other >= step)]
            fine = (at - other) * flat[found] < flat[found] - d
            table[left[fine]] = found[fine]
            left = left[~fine]
        opened = np.nonzero(new)[0]
        table[opened] = start[opened] + used[opened]
        used[opened] += 1
        tables[opened] += 1
        flat[table] += 1
        seat[place] = table
    return flat, room


def _move_alone(sizes: np.ndarray, fixed: float, slope: float, d: float, h: int, salt: int) -> np.ndarray:
    """A sweep of one dish. Takes 4 bytes a customer, whatever their number."""
    rng = np.random.Generator(np.random.PCG64([h, salt]))
    seat = memoryview(np.repeat(np.arange(len(sizes), dtype=np.uint32), sizes))
    now, c, sizes, free = len(sizes), len(seat), sizes.tolist(), []

    def chance(now):  # of a new table, with `now` of the others
        gain = fixed + slope * now
        return gain / (max(c - 1 - d * now, 0.0) + gain)

    same, fewer = chance(now), chance(now - 1)
    for done in range(0, c, 1 << 14):
        steps = np.arange(done, min(c, done + (1 << 14)))
        pick, new, at = rng.random((3, len(steps)))
        pick = steps + (pick * (c - steps)).astype(np.int64)
        other = (at * (c - 1)).astype(np.int64)
        at = at * (c - 1) - other
        other += other >= steps
        for i, j, u, o, v in zip(steps.tolist(), pick.tolist(), new.tolist(), other.tolist(), at.tolist()):
            k = seat[j]
            seat[j] = seat[i]
            size = sizes[k] = sizes[k] - 1
            if u < (same if size else fewer):
                if size:
                    now += 1
                    fewer, same = same, chance(now)
                    if free:
                        k = free.pop()
                    else:
                        k = len(sizes)
                        sizes.append(0)
                sizes[k] = 1
                seat[i] = k
                continue
            if not size:
                free.append(k)
                now -= 1
                fewer, same = chance(now - 1), fewer
            k = seat[o]
            size = sizes[k]
            while now > 1 and v * size >= size - d:
                o, v = int(rng.integers(c - 1)), rng.random()
                k = seat[o + (o >= i)]
                size = sizes[k]
            sizes[k] = size + 1
            seat[i] = k
    return np.array([x for x in sizes if x], np.int64)


def discount(n1: float, n2: float) -> float:
    return float(np.clip(n1 / (n1 + 2 * n2), 0.1, 0.95)) if n1 else 0.5


# ---------------------------------------------------------------- documents to pieces


class Numbers(dict):
    """word -> number, in order of first use."""

    def __missing__(self, word: bytes) -> int:
        found = self[word] = len(self)
        return found


def _pieces(batches):
    part, seq = TaskContext.get().partitionId(), 0
    number, docs, held, at, size = Numbers(), [], [], [], 0

    def flush():
        token = np.concatenate(at)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, number), np.uint64, len(number))
        # equal hashes of two words become one
        words, to = np.unique(hashes, return_inverse=True)
        token = to[token]
        lengths = np.array([len(x) for x in at])
        train = np.repeat(~np.array(held), lengths)
        counts, trained = (np.bincount(x, minlength=len(words)) for x in (token, token[train]))
        rank = np.empty(len(words), np.int64)
        rank[np.argsort(-counts, kind="stable")] = np.arange(len(words))  # small numbers pack well
        ids = np.array([i or 0 for i in docs], np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array([(part << 32) | seq], pa.int64()), pa.array([len(token)], pa.int64()), *[pa.array([x], pa.binary()) for x in (pack(ids, "<i8"), pack(np.array([i is None for i in docs]) * 2 + np.array(held), "<u1"), pack(lengths), pack_sorted(words), pack(counts), pack(trained), pack(rank[token]))]],
            _PIECE_NAMES,
        )

    for batch in batches:
        for i, text, out in zip(batch.column(0).to_pylist(), binary_column(batch, "text"), batch.column(2).to_pylist()):
            words = (text or b"").lower().split()
            words.append(b"")
            at.append(np.fromiter(map(number.__getitem__, words), np.int32, len(words)))
            docs.append(i)
            held.append(out)
            size += len(words)
            if size >= PIECE:
                yield flush()
                number, docs, held, at, size, seq = Numbers(), [], [], [], 0, seq + 1
    if docs:
        yield flush()


_PIECE_NAMES = ["piece", "n", "ids", "flags", "lengths", "words", "counts", "trained", "tokens"]
_PIECE = "piece long, n long, " + ", ".join(f"{x} binary" for x in _PIECE_NAMES[2:])


# ---------------------------------------------------------------- numbers of words

_ASK = "part long, piece long, words binary, trained binary"
_MSG = "kind long, part long, piece long, a binary, b binary, c binary, d binary, n1 long, n2 long"
_ANSWER, _STATE, _SINGLES = 0, 1, 2


def _ask_words(n: int):
    def run(batches):
        for batch in batches:
            rows = batch.to_pydict()
            out = []
            for piece, words, trained in zip(rows["piece"], rows["words"], rows["trained"]):
                words, trained = unpack_sorted(words), unpack(trained)
                out += [(q, piece, pack_sorted(words[r]), pack(trained[r])) for q, r in by_part(word_part(words, n), n)]
            yield from rows_table(out, _ASK).to_batches()

    return run


def _number(n: int):
    """Words of a part get numbers part + n * k, from 1 up in answers; words that training lacks get 0."""

    def run(key, t):
        q = key[0].as_py()
        asked = [unpack_sorted(x) for x in column(t, "words")]
        words, back = np.unique(np.concatenate(asked), return_inverse=True)
        c = np.bincount(back, np.concatenate([unpack(x) for x in column(t, "trained")]), len(words)).astype(np.int64)
        number = np.where(c > 0, (np.cumsum(c > 0) - 1) * n + q + 1, 0)
        if number.max(initial=0) >= 2**32:
            raise ValueError("more than 2**32 distinct words")
        out, at = [], 0
        for piece, x in zip(column(t, "piece"), asked):
            out.append((_ANSWER, q, piece, pack(number[back[at : at + len(x)]]), None, None, None, 0, 0))
            at += len(x)
        end = np.searchsorted(words, END)
        out.append((_STATE, q, int(number[end]) if end < len(words) and words[end] == END else 0, pack(c[c > 0]), None, None, None, int(c.sum()), int((c > 0).sum())))
        return rows_table(out, _MSG)

    return run


class _Piece:
    """A piece's tokens as numbers of words, and its distinct pairs of known words."""

    def __init__(self, row: dict, answers: dict, n: int, end: int):
        words = unpack_sorted(row["words"])
        order, _ = dealt(word_part(words, n), n)
        self.number = np.zeros(len(words), np.uint64)
        if len(words):
            self.number[order] = np.concatenate([unpack(answers[q]) for q in sorted(answers)])
        self.order = order
        by_rank = np.argsort(-unpack(row["counts"]).astype(np.int64), kind="stable")
        self.token = by_rank[unpack(row["tokens"])]
        self.lengths = unpack(row["lengths"]).astype(np.int64)
        self.flags = unpack(row["flags"], "<u1")
        self.starts = np.cumsum(self.lengths) - self.lengths
        w = self.number[self.token]
        u = np.concatenate(([np.uint64(0)], w[:-1]))
        u[self.starts] = end
        self.known = (u > 0) & (w > 0)
        self.pairs, self.back = np.unique((u << _32 | w)[self.known], return_inverse=True)
        train = np.repeat((self.flags & 1) == 0, self.lengths)[self.known]
        self.trained = np.bincount(self.back[train], minlength=len(self.pairs))
        # u as a place among the piece's words; the end token is one of them always
        self.before = np.concatenate((self.token[:1], self.token[:-1]))
        self.before[self.starts] = np.searchsorted(words, END)
        self.pair_order, self.pair_ends = dealt(pair_part(self.pairs, n), n)


def _answers(t: pa.Table, kind: int = _ANSWER) -> dict:
    return {part: a for k, part, a in zip(column(t, "kind"), column(t, "part"), column(t, "a")) if k == kind}


def _ask_pairs(n: int, end: int):
    def run(key, left, right):
        if not left.num_rows:
            return rows_table([], _ASK)
        p = _Piece(only(left), _answers(right), n, end)
        out = [(q, key[0].as_py(), pack_pairs(p.pairs[r]), pack(p.trained[r])) for q, r in by_part(pair_part(p.pairs, n), n)]
        return rows_table(out, _ASK)

    return run


def _count_pairs(n: int):
    """Pairs to keep: seen twice, or once while more than one piece asks. The others have one table and no further use."""

    def run(key, t):
        q = key[0].as_py()
        asked = [unpack_pairs(x) for x in column(t, "words")]
        pairs, back = np.unique(np.concatenate(asked), return_inverse=True)
        c = np.bincount(back, np.concatenate([unpack(x) for x in column(t, "trained")]), len(pairs)).astype(np.int64)
        keep = (c > 1) | ((c == 1) & (np.bincount(back, minlength=len(pairs)) > 1))
        place = np.cumsum(keep) - 1
        out = [(_STATE, q, 0, pack_pairs(pairs[keep]), pack(c[keep]), None, None, int((c == 1).sum()), int((c == 2).sum()))]
        at = 0
        for piece, x in zip(column(t, "piece"), asked):
            mine = back[at : at + len(x)]
            at += len(x)
            out.append((_ANSWER, q, piece, np.packbits(keep[mine]).tobytes(), pack_sorted(place[mine[keep[mine]]]), None, None, len(x), 0))
        once = pairs[(c == 1) & ~keep]
        words, su, sw = _sums(once, np.ones(len(once), np.int64))
        out += [(_SINGLES, p, q, pack_sorted(words[r]), pack(su[r]), pack(sw[r]), None, 0, 0) for p, r in _by_word_part(words, n)]
        return rows_table(out, _MSG)

    return run


def _sums(pairs: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of pairs with sums of t over the pairs they begin and over those they end."""
    u, w = pairs >> _32, pairs & np.uint64(0xFFFFFFFF)
    words, back = np.unique(np.concatenate((u, w)), return_inverse=True)
    sums = [np.bincount(x, t, len(words)).astype(np.int64) for x in (back[: len(u)], back[len(u) :])]
    return words, *sums


def _by_word_part(words: np.ndarray, n: int):
    return by_part(word_part(words - np.uint64(1), n), n)


# ---------------------------------------------------------------- sweeps

_PAIRS = "part long, pairs binary, c binary, t binary, sizes binary, kept binary"
_WORDS = "kind long, part long, piece long, c binary, once binary, tu binary, up binary, sizes binary, t binary, kept binary, customers long, tables long, n1 long, n2 long"


def _one_table_each(batches):
    for batch in batches:
        rows = batch.to_pydict()
        yield from rows_table([(q, a, b, pack(np.ones(len(unpack(b)))), None, None) for q, a, b in zip(rows["part"], rows["a"], rows["b"])], _PAIRS).to_batches()


def _report(n: int):
    """Sums of tables of a part of pairs, to the parts of its words."""

    def run(batches):
        for batch in batches:
            rows = batch.to_pydict()
            out = []
            for q, pairs, t in zip(rows["part"], rows["pairs"], rows["t"]):
                words, tu, up = _sums(unpack_pairs(pairs), unpack(t).astype(np.int64))
                out += [(_SINGLES, p, q, pack_sorted(words[r]), pack(tu[r]), pack(up[r]), None, 0, 0) for p, r in _by_word_part(words, n)]
            yield from rows_table(out, _MSG).to_batches()

    return run


def _add(n: int, size: int, t: pa.Table) -> tuple[np.ndarray, np.ndarray, list]:
    tu, up, asked = np.zeros(size, np.int64), np.zeros(size, np.int64), []
    for piece, a, b, c in zip(*(column(t, x) for x in ("piece", "a", "b", "c"))):
        rows = ((unpack_sorted(a) - np.uint64(1)) // np.uint64(n)).astype(np.int64)
        tu[rows] += unpack(b)
        up[rows] += unpack(c)
        asked.append((piece, rows))
    return tu, up, asked


def _first_words(n: int):
    def run(key, left, right):
        c = unpack(left.column("a")[0].as_py())
        tu, up, _ = _add(n, len(c), right)
        return rows_table([(_STATE, key[0].as_py(), 0, pack(c), framed(tu) + framed(up), None, None, None, None, None, 0, 0, 0, 0)], _WORDS)

    return run


def _move_words(n: int, sample: int, d: float, all_tables: float, base: float):
    """The word restaurant after a sweep of the pairs: its customers are their tables."""

    def run(key, left, right):
        row = only(left)
        q = key[0].as_py()
        c, (once_u, once_w) = unpack(row["c"]).astype(np.int64), unframed(row["once"])
        tu, up, asked = _add(n, len(c), right)
        tu, up = tu + once_u, up + once_w
        others = THETA + d * all_tables
        if row["sizes"] is None:
            t = tables_of(up, np.full(len(up), others * base), d)
            sizes = seat_all(up, t, d)
        else:
            sizes, t = resize(unpack(row["sizes"]).astype(np.int64), unpack(row["t"]).astype(np.int64), unpack(row["up"]).astype(np.int64), up)
        hashes = np.arange(len(c), dtype=np.uint64) * np.uint64(n) + np.uint64(q)
        sizes, t = gibbs(sizes, t, up, (others - d * t) * base, np.full(len(t), d * base), d, mix(hashes * _GOLD), 1000 + sample)
        kept = (row["kept"] or b"") + (b"".join(framed(x) for x in (tu, up, t)) if sample >= KEEP_FROM else b"")
        out = [(_STATE, q, 0, row["c"], row["once"], pack(tu), pack(up), pack(sizes), pack(t), kept, int(up.sum()), int(t.sum()), int((up == 1).sum()), int((up == 2).sum()))]
        out += [(_ANSWER, q, piece, None, None, pack(tu[rows]), pack(up[rows]), None, pack(t[rows]), None, 0, 0, 0, 0) for piece, rows in asked]
        return rows_table(out, _WORDS)

    return run


def _move_pairs(n: int, sample: int, d: float, word_probability):
    """A sweep of a part of pairs; right: tables and parent counts of its words, from each part of words."""

    def run(key, left, right):
        row = only(left)
        pairs, c = unpack_pairs(row["pairs"]), unpack(row["c"]).astype(np.int64)
        words, tu, up = _sums(pairs, unpack(row["t"]).astype(np.int64))
        told = {part: k for k, part in enumerate(column(right, "part"))}
        cols = {x: column(right, x) for x in ("tu", "up", "t")}
        tables, p = np.zeros(len(words)), np.zeros(len(words))
        for q, rows in _by_word_part(words, n):
            k = told[q]
            tables[rows] = unpack(cols["tu"][k])
            p[rows] = word_probability(unpack(cols["up"][k]), unpack(cols["t"][k]))
        u, w = np.searchsorted(words, pairs >> _32), np.searchsorted(words, pairs & np.uint64(0xFFFFFFFF))
        t = unpack(row["t"]).astype(np.int64)
        prior = p[w]
        if row["sizes"] is None:
            t0, t = t, tables_of(c, (THETA + d * tables[u]) * prior, d)
            sizes = seat_all(c, t, d)
        else:
            t0, sizes = t, unpack(row["sizes"]).astype(np.int64)
        sizes, t = gibbs(sizes, t, c, (THETA + d * (tables[u] - t0)) * prior, d * prior, d, mix(pairs * _GOLD), sample)
        kept = (row["kept"] or b"") + (framed(t) if sample >= KEEP_FROM else b"")
        return rows_table([(key[0].as_py(), row["pairs"], row["c"], pack(t), pack(sizes), kept)], _PAIRS)

    return run


class _Level:
    """The word restaurant's totals of one sample."""

    def __init__(self, customers: int, tables: int, d: float, v: int):
        self.customers, self.d, self.rest = customers, d, (THETA + d * tables) / (v + 1)

    def __call__(self, up: np.ndarray, t: np.ndarray) -> np.ndarray:
        return (up - self.d * t.astype(np.float64) + self.rest) / (self.customers + THETA)


# ---------------------------------------------------------------- scores


def _answer_words(n: int):
    def run(key, left, right):
        out = []
        if left.num_rows:
            c, kept = unpack(left.column("c")[0].as_py()), unframed(left.column("kept")[0].as_py())
            for piece, a in zip(column(right, "piece"), column(right, "a")):
                number = unpack(a)
                rows = (number[number > 0].astype(np.int64) - 1) // n
                out.append((3, key[0].as_py(), piece, pack(c[rows]), b"".join(framed(x[rows]) for x in kept), None, None, 0, 0))
        return rows_table(out, _MSG)

    return run


def _answer_pairs(key, left, right):
    out = []
    if left.num_rows:
        c, kept = unpack(left.column("c")[0].as_py()), unframed(left.column("kept")[0].as_py())
        for piece, mask, places, size in zip(*(column(right, x) for x in ("piece", "a", "b", "n1"))):
            rows = unpack_sorted(places).astype(np.int64)
            out.append((4, key[0].as_py(), piece, mask, pack(c[rows]), b"".join(framed(x[rows]) for x in kept), None, size, 0))
    return rows_table(out, _MSG)


_OUT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score(n: int, end: int, n_train: int, v: int, d: float, levels: list[_Level]):
    size = n_train + 0.1 * (v + 1)

    def run(key, left, right):
        if not left.num_rows:
            return rows_table([], _OUT)
        row = only(left)
        kind, part = np.array(column(right, "kind")), column(right, "part")
        a, b, c_, n1 = (column(right, x) for x in ("a", "b", "c", "n1"))
        at = {k: sorted((part[i], i) for i in np.nonzero(kind == k)[0].tolist()) for k in (_ANSWER, 3, 4)}
        p = _Piece(row, {q: a[i] for q, i in at[_ANSWER]}, n, end)
        # words: counts, and tables as a context, customers and tables in the word restaurant for each sample
        seen = p.order[p.number[p.order] > 0]
        c = np.zeros(len(p.number), np.int64)
        samples = np.zeros((3 * len(levels), len(p.number)))
        if len(seen):
            c[seen] = np.concatenate([unpack(a[i]) for _, i in at[3]])
            got = [unframed(b[i]) for _, i in at[3]]
            for k in range(len(samples)):
                samples[k, seen] = np.concatenate([x[k] for x in got])
        # pairs: those kept by their part; the others are this piece's own, seen once or not at all
        pair_c = p.trained.astype(np.float64)
        pair_t = np.repeat(pair_c[None, :], len(levels), 0)
        first = np.concatenate(([0], p.pair_ends[:-1]))
        for q, i in at[4]:
            rows = p.pair_order[first[q] : p.pair_ends[q]]
            rows = rows[np.unpackbits(np.frombuffer(a[i], np.uint8), count=n1[i]).astype(bool)]
            pair_c[rows] = unpack(b[i])
            for s, x in enumerate(unframed(c_[i])):
                pair_t[s, rows] = x
        one = np.zeros(len(p.pairs), np.int64)  # a token of each pair
        places = np.nonzero(p.known)[0]
        one[p.back] = places
        known = np.zeros(len(p.pairs))
        unknown = np.nonzero(~p.known)[0]
        other = np.zeros(len(unknown))
        for s, level in enumerate(levels):
            tables, prob = samples[3 * s], level(samples[3 * s + 1], samples[3 * s + 2])
            back_off = (THETA + d * tables) / (c + THETA)
            u, w = p.before[one], p.token[one]
            known += (pair_c - d * pair_t[s]) / (c[u] + THETA) + back_off[u] * prob[w]
            other += back_off[p.before[unknown]] * prob[p.token[unknown]]
        log_p = np.empty(len(p.token))
        log_p[places] = np.log10(known / len(levels))[p.back]
        log_p[unknown] = np.log10(other / len(levels))
        log_b = np.log10((c + 0.1) / size)[p.token]
        ids = unpack(row["ids"], "<i8").tolist()
        return pa.table(
            {
                "doc_id": pa.array([None if f & 2 else i for i, f in zip(ids, p.flags.tolist())], pa.int64()),
                "held_out": pa.array((p.flags & 1) == 1),
                "n_tokens": pa.array(p.lengths),
                "n_known": pa.array(np.add.reduceat((c[p.token] > 0).astype(np.int64), p.starts)),
                "train_tokens": pa.array(np.full(len(ids), n_train, np.int64)),
                "base_score": pa.array(np.add.reduceat(log_b, p.starts)),
                "score": pa.array(np.add.reduceat(log_p, p.starts)),
            }
        )

    return run


def language_model(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text, ...) -> (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), a row for each row.

    Tokens are words, lower-cased A-Z, and one end for each text; null texts are empty and have the end alone. held_out:
    crc32(doc_id) mod 10 is 0; the others train, rows without doc_id among them, repeated rows as often as they come.
    base_score is the smoothed unigram's log10 probability, score the model's; words that training lacks are the one
    unknown token in both. With nothing to train on, that token has probability 1 in both. The result does not depend on
    how the rows are partitioned.
    """
    held = F.coalesce(crc_mod("doc_id", 10) == 0, F.lit(False))
    pieces = materialize(docs.select("doc_id", "text", held.alias("held")).mapInArrow(_pieces, _PIECE))
    n = PARTS or max(1, (pieces.agg(F.sum("n")).first()[0] or 0) // PIECE)

    asked = pieces.select("piece", "words", "trained").mapInArrow(_ask_words(n), _ASK)
    numbers = materialize(asked.groupBy("part").applyInArrow(_number(n), _MSG))
    vocabulary, told = numbers.where(f"kind = {_STATE}"), numbers.where(f"kind = {_ANSWER}")
    total = vocabulary.agg(F.coalesce(F.sum("n1"), F.lit(0)).alias("n"), F.coalesce(F.sum("n2"), F.lit(0)).alias("v"), F.coalesce(F.max("piece"), F.lit(0)).alias("end")).first()
    n_train, v, end = total["n"], total["v"], total["end"]

    grouped = pieces.groupBy("piece").cogroup(told.groupBy("piece")).applyInArrow(_ask_pairs(n, end), _ASK)
    counted = materialize(grouped.groupBy("part").applyInArrow(_count_pairs(n), _MSG))
    state = counted.where(f"kind = {_STATE}")
    once = state.agg(F.sum("n1").alias("n1"), F.sum("n2").alias("n2")).first()
    d = discount(once["n1"] or 0, once["n2"] or 0)

    pairs = materialize(state.select("part", "a", "b").mapInArrow(_one_table_each, _PAIRS))
    words = materialize(vocabulary.groupBy("part").cogroup(counted.where(f"kind = {_SINGLES}").groupBy("part")).applyInArrow(_first_words(n), _WORDS))
    levels, d0, all_tables = [], 0.5, float(v)
    for sample in range(SAMPLES + 1):
        if sample:
            answers = words.where(f"kind = {_ANSWER}").selectExpr("piece AS to", "part", "tu", "up", "t")
            new = materialize(pairs.groupBy("part").cogroup(answers.groupBy("to")).applyInArrow(_move_pairs(n, sample, d, levels[-1]), _PAIRS))
            release(pairs)
            pairs = new
        reports = pairs.select("part", "pairs", "t").mapInArrow(_report(n), _MSG)
        new = materialize(words.where(f"kind = {_STATE}").groupBy("part").cogroup(reports.groupBy("part")).applyInArrow(_move_words(n, sample, d0, all_tables, 1 / (v + 1)), _WORDS))
        release(words)
        words = new
        sums = words.where(f"kind = {_STATE}").agg(F.coalesce(F.sum("customers"), F.lit(0)).alias("customers"), F.coalesce(F.sum("tables"), F.lit(0)).alias("tables"), F.sum("n1").alias("n1"), F.sum("n2").alias("n2")).first()
        levels.append(_Level(sums["customers"], sums["tables"], d0, v))
        all_tables = float(sums["tables"])
        if not sample:
            d0 = discount(sums["n1"] or 0, sums["n2"] or 0)

    of_words = words.where(f"kind = {_STATE}").groupBy("part").cogroup(told.groupBy("part")).applyInArrow(_answer_words(n), _MSG)
    of_pairs = pairs.groupBy("part").cogroup(counted.where(f"kind = {_ANSWER}").groupBy("part")).applyInArrow(_answer_pairs, _MSG)
    all_answers = told.unionByName(of_words).unionByName(of_pairs)
    return pieces.groupBy("piece").cogroup(all_answers.groupBy("piece")).applyInArrow(_score(n, end, n_train, v, d, levels[KEEP_FROM:]), _OUT)
