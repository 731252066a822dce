"""Token-id files: texts to ids in a given order, by default of doc_id, coded in blocks by idcoder, written and read back through Spark."""

from __future__ import annotations

import gc
import json
import os
import re
import sys
import zlib
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from . import idcoder
from .common import materialize, mix

BLOCK_IDS, MEMO, SLICE = 1 << 21, 2_000_000, 1 << 24
# Fixed value: the pre-tokenizer's pattern under which texts may be encoded word by word. It keeps no white space, so no
# token crosses it, takes a run of letters as one piece, and a run of other signs after it as another.
_APART = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def words_apart(path: str) -> bool:
    """Whether the tokenizer's file says that texts are lower-cased, cut by _APART and ended word by word."""
    with open(path, encoding="utf-8") as f:
        made = json.load(f)
    steps = [n.get("type") for n in (made.get("normalizer") or {}).get("normalizers", [])]
    cut, level = [*((made.get("pre_tokenizer") or {}).get("pretokenizers") or []), {}, {}][:2]
    fine = cut.get("type") == "Split" and (cut.get("pattern") or {}).get("Regex") == _APART and cut.get("behavior") == "Removed" and cut.get("invert")
    fine = fine and level.get("type") == "ByteLevel" and not level.get("add_prefix_space") and made["model"].get("type") == "BPE"
    return bool(fine) and steps == ["NFC", "Replace", "Lowercase"] and made["model"].get("end_of_word_suffix") == "</w>" and not any(" " in t["content"] for t in made["added_tokens"])


# The byte-level alphabet. Printable bytes are themselves, the others follow from 256 in order.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_ALPHABET = dict(zip((b for b in range(256) if b not in _PRINTABLE), range(256, 512)))
del _ALPHABET[32]  # the space that parts words here


def _plain(text: str) -> bool:
    """Whether letters stay letters: composed, and without the one letter whose lower case has a mark."""
    return text.isascii() or (is_normalized("NFC", text) and "\u0130" not in text)


_rng = np.random.default_rng(20241107)
#: Multipliers of a word's bytes by their place, for either hash; longer words are not kept.
LONGEST = 64
_MULTIPLIERS = [_rng.integers(0, 2**63, LONGEST, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2)]


def word_hashes(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each string, and its length in bytes."""
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]].astype(np.uint64) + np.uint64(1)
    ends -= ends[0]
    size = np.diff(ends)
    place = np.minimum(np.arange(len(data)) - np.repeat(ends[:-1], size), LONGEST - 1)
    out = []
    for m in _MULTIPLIERS:
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(data * m[place], dtype=np.uint64)))
        out.append(mix(sums[ends[1:]] - sums[ends[:-1]] + size.astype(np.uint64)))
    return *out, size


class Encoder:
    """Texts to ids by the tokenizer of a file; ids of words are kept, up to about `memo` of them, as one array with their places.

    Words are found again by two hashes, 128 bits in all. Where words_apart() does not hold, whole texts are encoded instead.
    """

    def __init__(self, path: str, memo: int = MEMO):
        self.memo = memo
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.apart = words_apart(path)
        if self.apart:
            # runs of letters are one piece each; the byte-level alphabet, in order of bytes, is what the model reads
            self.pieces = self.tokenizer.model.tokenize
            self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
            self.keys, self.checks, self.places = (np.empty(0, t) for t in (np.uint64, np.uint64, np.int64))
            self.ids, self.used, self.n = np.empty(1 << 20, np.int32), 0, 0
            self.start, self.size = np.empty(1 << 18, np.int64), np.empty(1 << 18, np.int64)

    def forget(self) -> None:
        """Keeps the first half of the words, which hold the frequent ones."""
        keep = self.memo // 2
        self.ids = self._gather(np.arange(keep))
        self.used, self.n = len(self.ids), keep
        self.start[:keep] = np.cumsum(self.size[:keep]) - self.size[:keep]
        early = self.places < keep
        self.keys, self.checks, self.places = self.keys[early], self.checks[early], self.places[early]

    def _find(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The words' places, -1 for those that are not kept, and their hashes; a hash of 0 is never kept."""
        h, check, size = word_hashes(words)
        h[size > LONGEST] = 0
        order = np.argsort(h)
        at = np.empty(len(h), np.int64)
        at[order] = np.searchsorted(self.keys, h[order])
        at = np.minimum(at, len(self.keys) - 1)
        if not len(self.keys):
            return np.full(len(h), -1, np.int64), h, check
        return np.where((self.keys[at] == h) & (self.checks[at] == check), self.places[at], -1), h, check

    def _store(self, h: np.ndarray, check: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Keeps the ids of words that follow one another in `ids`; -> the words' places."""
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.empty_like(self.ids)))
        while self.n + len(sizes) > len(self.start):
            self.start, self.size = (np.concatenate((x, np.empty_like(x))) for x in (self.start, self.size))
        place = np.arange(self.n, self.n + len(sizes))
        self.ids[self.used : self.used + len(ids)] = ids
        self.start[place] = self.used + np.cumsum(sizes) - sizes
        self.size[place] = sizes
        self.used, self.n = self.used + len(ids), self.n + len(sizes)
        fresh = np.argsort(h)[int((h == 0).sum()) :]
        at = np.searchsorted(self.keys, h[fresh])
        if len(self.keys):  # of two words with one hash the first is kept; the other is found by none
            alone = self.keys[np.minimum(at, len(self.keys) - 1)] != h[fresh]
            fresh, at = fresh[alone], at[alone]
        self.keys, self.checks, self.places = (np.insert(x, at, y[fresh]) for x, y in ((self.keys, h), (self.checks, check), (self.places, place)))
        return place

    def _whole(self, words: list[str]) -> list[list[int]]:
        """Words one by one, as texts of their own."""
        return [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _ids(self, words: pa.Array, letters: np.ndarray) -> list[list[int]]:
        """Ids of each word; runs of letters go to the model, in the byte-level alphabet."""
        out: list = words.to_pylist()
        spelled, rest = out.copy(), []
        marked = np.nonzero(letters & ~pc.string_is_ascii(words).to_numpy(zero_copy_only=False))[0].tolist()
        if marked:  # in lower case each sign by itself, as the tokenizer does, then bytes as letters
            lower = " ".join(["".join(map(str.lower, out[k])) for k in marked])
            for k, word in zip(marked, lower.encode().decode("latin-1").translate(_ALPHABET).split(" ")):
                spelled[k] = word
            rest = [k for k in marked if not _plain(out[k])]
        pieces, plain = self.pieces, letters.copy()
        plain[rest] = False
        gc.disable()  # a million small objects come and go here, in no cycles
        try:
            for k in np.nonzero(plain)[0].tolist():
                out[k] = [t.id for t in pieces(spelled[k])]
        finally:
            gc.enable()
        rest += np.nonzero(~letters)[0].tolist()
        for k, ids in zip(rest, self._whole([out[k] for k in rest])):
            out[k] = ids
        return out

    def _learn(self, words: pa.Array, h: np.ndarray, check: np.ndarray) -> np.ndarray:
        """Places of distinct words that are not kept; words of letters and signs are put together from both."""
        letters = pc.utf8_is_alpha(words)
        stems = pc.utf8_rtrim(words, characters=_SIGNS)
        special = pc.match_substring_regex(words, "|".join(map(re.escape, self.special)) or r"\z\A")
        plain = pc.and_(pc.utf8_is_alpha(stems), pc.and_(pc.invert(letters), pc.invert(special))).to_numpy(zero_copy_only=False)
        mixed = np.nonzero(plain)[0]
        ends = stems.take(pa.array(mixed)).to_pylist()
        fine = np.array([_plain(x) for x in ends], bool)
        ends, mixed = [x for x, ok in zip(ends, fine) if ok], mixed[fine]
        rest = np.ones(len(words), bool)
        rest[mixed] = False
        simple = np.nonzero(rest)[0]
        place = np.empty(len(words), np.int64)
        ids = self._ids(words.take(pa.array(simple)), letters.to_numpy(zero_copy_only=False)[simple])
        place[simple] = self._store(h[simple], check[simple], np.array([len(x) for x in ids], np.int64), np.array([i for x in ids for i in x], np.int32))
        if len(mixed):
            whole = words.take(pa.array(mixed)).to_pylist()
            parts = pa.array([x for word, stem in zip(whole, ends) for x in (stem, word[len(stem) :])], pa.string()).dictionary_encode()
            at = self._place(parts.dictionary)[parts.indices.to_numpy()]
            place[mixed] = self._store(h[mixed], check[mixed], self.size[at[::2]] + self.size[at[1::2]], self._gather(at))
        return place

    def _place(self, words: pa.Array) -> np.ndarray:
        place, h, check = self._find(words)
        new = np.nonzero(place < 0)[0]
        if len(new):
            place[new] = self._learn(words.take(pa.array(new)), h[new], check[new])
        return place

    def _gather(self, at: np.ndarray) -> np.ndarray:
        out, used = np.empty(int(self.size[at].sum()), np.int32), 0
        for a in range(0, len(at), 1 << 18):
            size = self.size[at[a : a + (1 << 18)]]
            ends = np.cumsum(size)
            n = int(ends[-1])
            out[used : used + n] = self.ids[np.repeat(self.start[at[a : a + (1 << 18)]] - ends + size, size) + np.arange(n)]
            used += n
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each has."""
        texts = texts.fill_null("")
        if not self.apart:
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
            return np.array([i for x in ids for i in x], np.int32), np.array([len(x) for x in ids], np.int64)
        if self.n > self.memo:
            self.forget()
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        ends = np.cumsum(np.concatenate(([0], pc.list_value_length(split).to_numpy())))
        coded = split.flatten().dictionary_encode()
        at = self._place(coded.dictionary)[coded.indices.to_numpy()]
        bounds = np.concatenate(([0], np.cumsum(self.size[at])))
        return self._gather(at), np.diff(bounds[ends])


def slices(texts: pa.Array, most: int = SLICE):
    """(from, to) of runs of texts of about so many bytes; a longer text is a run of its own."""
    size = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    group = np.cumsum(size) // most
    cut = np.concatenate(([0], np.nonzero(np.diff(group))[0] + 1, [len(size)]))
    return [(a, b) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()) if b > a]


_KEPT = "_factloom_token_encoders"


def encoder(path: str, memo: int) -> Encoder:
    """One encoder for each worker process and file, kept from task to task until forget_encoders(); what it remembers changes no result."""
    kept = sys.modules.setdefault(_KEPT, {})
    if (path, memo) not in kept:
        kept[path, memo] = Encoder(path, memo)
    return kept[path, memo]


def forget_encoders() -> None:
    """Gives the memory of this process's encoders back; reading files does so, as nothing is written any more then."""
    if sys.modules.pop(_KEPT, None):
        gc.collect()
    pa.default_memory_pool().release_unused()


def _encode(path: str, end_id: int, memo: int, slice_bytes: int):
    def run(batches):
        made = encoder(path, memo)
        part, block = TaskContext.get().partitionId(), 0
        docs, counts, parts, size = [], [], [], 0

        def flush():
            frame = idcoder.encode_block(docs, counts, np.concatenate(parts), made.vocabulary)
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([block], pa.int64()), pa.array([size], pa.int64()), pa.array([frame], pa.binary())], ["part", "block", "n_ids", "frame"])

        for batch in batches:
            texts = batch.column(batch.schema.names.index("text"))
            for a, b in slices(texts, slice_bytes):
                some = batch.column(0)[a:b].to_pylist()
                x, n = made.encode(texts[a:b])
                pa.default_memory_pool().release_unused()
                ends = np.cumsum(n + 1)
                with_end = np.empty(len(x) + len(some), np.int32)
                with_end[ends - 1] = end_id
                text_ids = np.ones(len(with_end), bool)
                text_ids[ends - 1] = False
                with_end[text_ids] = x
                docs += some
                counts += (n + 1).tolist()
                parts.append(with_end)
                size += len(with_end)
                if size >= BLOCK_IDS:
                    yield flush()
                    docs, counts, parts, size, block = [], [], [], 0, block + 1
        if docs:
            yield flush()

    return run


def write_ids(docs: DataFrame, path: str, end_id: int = 2, order: tuple = ("doc_id",), memo: int = MEMO, slice_bytes: int = SLICE) -> DataFrame:
    """docs(doc_id, text, ...) -> the written files: (part, block, n_ids, frame), by (part, block) in the order of `order`.

    frame is a block that idcoder.decode_block reads by itself. Null texts are empty and have the end id alone; rows
    without doc_id come first in order of doc_id; rows that are equal in `order` stand together, in no fixed order. path: a tokenizer's file, the
    same on all machines. memo: the words whose ids a worker process keeps, some 60 bytes each; slice_bytes:
    the text that it splits at once, which takes some ten times as much.
    """
    ordered = docs.select(*dict.fromkeys(["doc_id", "text", *order])).repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    return materialize(ordered.mapInArrow(_encode(path, end_id, memo, slice_bytes), "part long, block long, n_ids long, frame binary"))


def _decode(batches):
    forget_encoders()
    for batch in batches:
        parts, blocks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for part, block, frame in zip(parts, blocks, batch.column(2).to_pylist()):
            docs, counts, ids = idcoder.decode_block(frame)
            ends = np.cumsum(counts)
            raw = memoryview(ids.astype("<u4").tobytes())
            crc = [zlib.crc32(raw[4 * (b - n) : 4 * b]) for n, b in zip(counts.tolist(), ends.tolist())]
            n = len(docs)
            yield pa.RecordBatch.from_arrays([pa.array([part] * n, pa.int64()), pa.array([block] * n, pa.int64()), pa.array(docs, pa.int64()), pa.array(ends - counts), pa.array(counts), pa.array(crc, pa.int64())], ["part", "block", "doc_id", "at", "n_tokens", "ids_crc32"])


def read_ids(files: DataFrame) -> DataFrame:
    """Files of write_ids -> (doc_id, start, n_tokens, ids_crc32): a row for each document, from the decoded blocks.

    start counts the ids of all documents before; it is summed over blocks of a part and over parts, never over rows.
    """
    sizes = files.select("part", "block", "n_ids")
    within = sizes.withColumn("in_part", F.sum("n_ids").over(Window.partitionBy("part").orderBy("block")) - F.col("n_ids"))
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    offsets = within.join(parts, "part").select("part", "block", (F.col("in_part") + F.col("before")).alias("offset"))
    rows = files.select("part", "block", "frame").mapInArrow(_decode, "part long, block long, doc_id long, at long, n_tokens long, ids_crc32 long")
    return rows.join(offsets, ["part", "block"]).select("doc_id", (F.col("offset") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
