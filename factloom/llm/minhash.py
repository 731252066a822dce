"""MinHash near-dedup by a signature-coordinate inverted join.

1. Each text becomes a set of shingle hashes and a signature of K minima; equal sets share one representative.
2. Every (coordinate, value) of a signature is a posting. Postings that only one representative has collide with
   nothing and are left out. Two representatives that agree in at least T of K coordinates must share one among the
   K - T + 1 rarest of either, so only that prefix is posted.
3. Each representative is verified against the smallest one of each of its posted lists, the smallest of those that post
   it; links merge into components. A list of two is settled by this.
4. Lists that still hold several components are cut into blocks. Block pairs count collisions, skip pairs already
   merged, pairs under T, and pairs that an earlier shared posting covers, and verify the rest on the full sets.
5. The components of all links are the result.

K = 32; T is the largest number of coordinates in which a pair at the asked similarity agrees less often than LOSS of
times: 16 at Jaccard 0.85, 13 at 0.8. Pairs above it are lost less often still.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from .common import WordHashes, binary_column, materialize, shingle_set
from .components import components

K, BLOCK, LOSS = 32, 1024, 1e-6
_rng = np.random.default_rng(20240607)
_MUL = _rng.integers(1, 2**63, K, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 2**63, K, dtype=np.uint64)


def least_matches(percent: int) -> int:
    """The largest T such that a pair of this similarity agrees in fewer than T of K coordinates with probability under LOSS."""
    p, lost = percent / 100, 0.0
    for t in range(K):
        lost += comb(K, t) * p**t * (1 - p) ** (K - t)
        if lost >= LOSS:
            return max(t, 1)
    return K


def signature(s: np.ndarray) -> np.ndarray:
    out = np.full(K, 0xFFFFFFFF, np.uint64)
    for at in range(0, len(s), 4096):
        part = s[at : at + 4096]
        out = np.minimum(out, ((part[None, :] * _MUL[:, None] + _ADD[:, None]) >> np.uint64(32)).min(1))
    return out.astype(np.uint32)


def _signed(words: int):
    def run(batches):
        memo = WordHashes()
        for batch in batches:
            ids = batch.column(0)
            size, keys, sigs = [], [], []
            for text in binary_column(batch, "text"):
                s = shingle_set(memo.of((text or b"").lower().split()), words)
                size.append(len(s))
                keys.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                sigs.append(signature(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([ids, pa.array(size, pa.int64()), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary())], ["doc_id", "n_shingles", "set_key", "sig"])

    return run


def _sets(words: int):
    def run(batches):
        memo = WordHashes()
        for batch in batches:
            sets = [shingle_set(memo.of((t or b"").lower().split()), words).tobytes() for t in binary_column(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sets, pa.binary())], ["rep", "sig", "set"])

    return run


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, for sorted distinct hashes."""
    small, large = sorted((len(x), len(y)))
    if 100 * small < percent * large:
        return False
    both = np.concatenate((x, y))
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (small + large - common)


def _verify(percent: int):
    def run(batches):
        for batch in batches:
            a, b = binary_column(batch, "set_a"), binary_column(batch, "set_b")
            ok = [similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent) for x, y in zip(a, b)]
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["u", "v"])

    return run


def _within(percent: int, least: int):
    """Verified links of a block pair; both blocks are bounded by BLOCK on average."""

    def run(key, pdf):
        coord, block_a, block_b = int(key[0]), int(key[2]), int(key[3])
        sig = np.stack([np.frombuffer(x, np.uint32) for x in pdf["sig"]])
        prefix = pdf["prefix"].to_numpy().astype(np.int64)
        comp, rep, own = pdf["component"].to_numpy(), pdf["rep"].to_numpy(), pdf["block"].to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in pdf["set"]]
        sizes = np.array([len(x) for x in sets])
        parent = {c: c for c in comp}

        def root(c):
            while parent[c] != c:
                parent[c] = parent[parent[c]]
                c = parent[c]
            return c

        out, earlier = [], np.int64((1 << coord) - 1)
        bits = np.int64(1) << np.arange(K, dtype=np.int64)
        for i in range(len(rep)):
            other = np.nonzero((comp != comp[i]) & (rep > rep[i]) & ((own != own[i]) | (block_a == block_b)) & (100 * np.minimum(sizes, sizes[i]) >= percent * np.maximum(sizes, sizes[i])))[0]
            if not len(other):
                continue
            same = sig[other] == sig[i]
            shared = (same * bits).sum(1) & prefix[other] & prefix[i]
            other = other[(same.sum(1) >= least) & ((shared & earlier) == 0)]
            for j in other:
                if root(comp[i]) != root(comp[j]) and similar(sets[i], sets[j], percent):
                    parent[root(comp[i])] = root(comp[j])
                    out.append((rep[i], rep[j]))
        return pd.DataFrame(out, columns=["u", "v"], dtype="int64")

    return run


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """docs(doc_id, text, ...) -> (doc_id, n_shingles, component_id, kept), a row for each row of docs.

    Texts are lower-cased A-Z only; a set holds distinct `words`-word shingles, the whole sequence where there are fewer
    words. Null and empty texts and texts without words have an empty set, link with nothing and are kept. Rows without
    doc_id take no part: their component_id is null and they are kept. Repeated rows fall into one component; each of
    them carries the result of its doc_id. Other columns are not read, so clashing names do no harm.
    """
    least = least_matches(percent)
    signed = materialize(docs.select("doc_id", "text").mapInArrow(_signed(words), "doc_id long, n_shingles long, set_key binary, sig binary"))
    part = signed.where("set_key is not null and doc_id is not null")
    reps = part.groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig"))
    reps = materialize(reps)
    hexed = F.hex("sig")
    posted = reps.select("rep", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(K - 1)), lambda i: F.substring(hexed, i * 8 + 1, F.lit(8)))).alias("coord", "value"))
    posted = posted.select("rep", F.col("coord").cast("byte").alias("coord"), F.conv("value", 16, 10).cast("long").alias("value"))
    lists = posted.groupBy("coord", "value").agg(F.count("*").alias("n")).where("n > 1")
    multi = posted.join(lists, ["coord", "value"])
    # the rest of the K coordinates collide with nothing and are the rarest
    rank = F.row_number().over(Window.partitionBy("rep").orderBy("n", "coord"))
    in_lists = F.count("*").over(Window.partitionBy("rep"))
    multi = materialize(multi.withColumn("at", rank + K - in_lists).where(f"at <= {K - least + 1}").drop("at"))

    wanted = multi.groupBy("rep").agg(F.sum(F.expr("shiftleft(1L, cast(coord AS int))")).alias("prefix"))
    texts = docs.select("doc_id", "text")
    sets = materialize(
        texts.join(wanted.join(reps, "rep"), F.col("doc_id") == F.col("rep"), "inner").select("rep", "sig", "text").mapInArrow(_sets(words), "rep long, sig binary, set binary")
    )
    one = sets.groupBy("rep").agg(F.first("sig").alias("sig"), F.first("set").alias("set")) if _repeats(sets) else sets
    heads = multi.groupBy("coord", "value").agg(F.min("rep").alias("leader"))
    pairs = multi.select("rep", "coord", "value").join(heads, ["coord", "value"]).where("leader <> rep").select("rep", "leader").distinct()
    joined = pairs.join(one.select("rep", F.col("set").alias("set_a")), "rep").join(one.select(F.col("rep").alias("leader"), F.col("set").alias("set_b")), "leader")
    links = materialize(joined.select("rep", "leader", "set_a", "set_b").mapInArrow(_verify(percent), "u long, v long"))
    found = components(links)

    labelled = multi.select("rep", "coord", "value", "n").join(found, F.col("rep") == F.col("node"), "left").select("rep", "coord", "value", "n", F.coalesce("component", "rep").alias("component"))
    open_lists = labelled.groupBy("coord", "value").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("m")).where("low <> high and m > 2").select("coord", "value", "m")
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    left = labelled.join(open_lists, ["coord", "value"]).withColumn("block", F.pmod(F.xxhash64("rep"), blocks).cast("int")).withColumn("blocks", blocks)
    left = left.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    left = left.select("coord", "value", F.least("block", "o").alias("a"), F.greatest("block", "o").alias("b"), "block", "rep", "component")
    left = left.join(wanted, "rep").join(one, "rep")
    more = left.groupBy("coord", "value", "a", "b").applyInPandas(_within(percent, least), "u long, v long")
    more = materialize(more.distinct())
    if more.limit(1).count():
        found = components(links.unionByName(more))
    final = reps.join(found, F.col("rep") == F.col("node"), "left").select("set_key", F.coalesce("component", "rep").alias("component_id"))
    out = signed.join(final, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _repeats(sets: DataFrame) -> bool:
    """Whether a doc_id came more than once."""
    return sets.groupBy("rep").count().where("count > 1").limit(1).count() > 0
