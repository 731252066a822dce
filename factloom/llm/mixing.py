"""Mixing sources to target weights by Pfair scheduling.

Each source is cut into blocks of BLOCK documents. With weight w, its block j may be placed from slot floor(j / w) and
must be placed before slot ceil((j + 1) / w); at each slot the released block with the earliest deadline is taken (ties:
the source that sorts first). After t slots every source has had more than w t - 1 and less than w t + 1 blocks.

Weights are exact: integers over their sum. The driver simulates every block of the mix once. A block holds BLOCK rows, or
the smallest power of two times as many under which the mix has at most SLOTS blocks, so the driver's work and memory are
bounded at every size; rows then find the slots of their block by a join.
"""

from __future__ import annotations

import heapq
from fractions import Fraction
from math import lcm

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import materialize

BLOCK, BUCKET, SLOTS = 32, 256, 1 << 21
#: Up to so many slots are broadcast (32 bytes each); more are joined by a shuffle.
BROADCAST_SLOTS = 500_000


def shares(weights: dict) -> dict:
    """Positive weights as integers in exactly their ratios."""
    exact = {s: Fraction(w) for s, w in weights.items()}
    scale = lcm(*(x.denominator for x in exact.values()))
    return {s: int(x * scale) for s, x in exact.items()}


def schedule(quota: dict, period: int, blocks: dict | None = None) -> dict:
    """Slots of each source's blocks by earliest deadline first, with weights quota / period.

    Covers one period or, given `blocks`, all slots until each source has given so many blocks.
    """
    rank = {s: k for k, s in enumerate(sorted(quota, key=lambda s: (s is None, str(s))))}
    slots = {s: [] for s in quota}
    waiting = [(0, rank[s], s, 0) for s in quota]
    heapq.heapify(waiting)
    ready: list = []
    short = set(blocks or ())
    t = 0
    while short if blocks is not None else t < period:
        while waiting and waiting[0][0] <= t:
            _, k, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * period // quota[s]), k, s, j))
        _, k, s, j = heapq.heappop(ready)
        slots[s].append(t)
        heapq.heappush(waiting, ((j + 1) * period // quota[s], k, s, j + 1))
        if s in short and j + 1 >= blocks[s]:
            short.remove(s)
        t += 1
    return slots


def block_size(counts: dict, quota: dict) -> int:
    """Rows of a block: BLOCK, doubled until every source has given all its blocks within SLOTS slots."""
    total, size = sum(quota.values()), BLOCK
    if len(counts) > SLOTS // 2:
        raise ValueError(f"more than {SLOTS // 2} sources")
    while max(-(-n // size) * total // quota[s] for s, n in counts.items()) > SLOTS and size < max(counts.values()):
        size *= 2
    return size


def placed(docs: DataFrame, weights: dict | None = None, alpha: float = 0.9) -> DataFrame:
    """As mix(), but the row of docs is one column `doc`, so no name of its columns can clash."""
    made = ["source_block", "epoch", "slot", "place"]
    row = F.struct("*").alias("doc")
    counts = {r["source"]: r["n"] for r in docs.groupBy("source").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return docs.select(row, *[F.lit(None).cast("long").alias(c) for c in made])
    if weights is None:
        weights = {s: n**alpha for s, n in counts.items()}
    if not all(0 < w < float("inf") for w in weights.values()):
        raise ValueError("weights are positive numbers")
    low = min(weights.values(), default=1.0)
    quota = shares({s: weights.get(s, low) for s in counts})
    size = block_size(counts, quota)
    blocks = {s: -(-n // size) for s, n in counts.items()}
    slots = schedule(quota, sum(quota.values()), blocks)
    spark = docs.sparkSession
    numbers = spark.createDataFrame([(s, k) for k, s in enumerate(counts)], f"named {docs.schema['source'].dataType.simpleString()}, number long")
    j = [np.arange(len(slots[s]), dtype=np.int64) for s in counts]
    columns = [[np.full(len(x), k, np.int64) for k, x in enumerate(j)], [x % blocks[s] for s, x in zip(counts, j)], [x // blocks[s] for s, x in zip(counts, j)], [np.array(slots[s], np.int64) for s in counts]]
    plan = spark.createDataFrame(pa.table([np.concatenate(x) for x in columns], ["number", "source_block", "epoch", "slot"]))
    if sum(map(len, slots.values())) <= BROADCAST_SLOTS:
        plan = F.broadcast(plan)

    # ranks within a source without sorting it in one task: small hash buckets, then counts of the buckets before
    buckets = max(1, sum(counts.values()) // BUCKET)
    plain = [f.name for f in docs.schema.fields if f.dataType.typeName() in ("string", "long", "integer", "double", "boolean")]
    dealt = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id")).otherwise(F.xxhash64(*[F.col(f"`{c}`") for c in plain]))
    keyed = docs.select(row, F.col("doc_id").alias("id"), F.pmod(dealt, F.lit(buckets)).alias("bucket"), F.col("source").alias("name"))
    keyed = keyed.join(F.broadcast(numbers), F.col("name").eqNullSafe(F.col("named"))).drop("name", "named")  # one row for each source
    high = F.floor(F.col("bucket") / 1024)
    sizes = materialize(keyed.groupBy("number", "bucket").agg(F.count("*").alias("n")).withColumn("high", high))
    inner = F.sum("n").over(Window.partitionBy("number", "high").orderBy("bucket")) - F.col("n")
    tops = sizes.groupBy("number", "high").agg(F.sum("n").alias("t"))
    tops = tops.withColumn("top", F.sum("t").over(Window.partitionBy("number").orderBy("high")) - F.col("t")).drop("t")
    before = sizes.withColumn("inner", inner).join(tops, ["number", "high"]).select("number", "bucket", (F.col("inner") + F.col("top")).alias("before"))
    within = F.row_number().over(Window.partitionBy("number", "bucket").orderBy("id")) - 1
    ranked = keyed.withColumn("within", within).join(before, ["number", "bucket"]).withColumn("rank", F.col("before") + F.col("within"))
    out = ranked.withColumn("source_block", F.floor(F.col("rank") / size).cast("long")).withColumn("place", F.col("rank") % size)
    out = out.join(plan, ["number", "source_block"])  # one row for each epoch
    return out.select("doc", *[F.col(c).cast("long").alias(c) for c in made])


def mix(docs: DataFrame, weights: dict | None = None, alpha: float = 0.9) -> DataFrame:
    """docs(doc_id, source, ...) -> the rows of docs in mixed order, with source_block, epoch, slot and place added.

    slot orders the blocks, place the rows of a block (from 0); the mix is read by (slot, place). weights: source -> target
    weight, positive or ValueError (a null source is one of its own; sources without a weight take part with the smallest);
    by default n ** alpha for a source of n rows. Every row of every source is placed: the schedule runs until each source
    has given all its blocks, and a source that ends before starts again (epoch 1, 2, ...). An empty table gives an empty
    mix. Repeated rows and rows without doc_id are rows like others. Columns of docs with the four names are replaced;
    other names cannot clash.
    """
    made = ["source_block", "epoch", "slot", "place"]
    return placed(docs.drop(*made), weights, alpha).select("doc.*", *made)
