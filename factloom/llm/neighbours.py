"""Approximate nearest neighbours with learned partitions.

On a bounded sample (SAMPLE distinct vectors, by hash of the vector's id) the exact neighbour graph is built and cut into
balanced partitions: a recursive bisection starts it, and sweeps then move vectors to the partition that holds most of
their neighbours while sizes stay within SLACK. A small softmax classifier learns the partitions. It puts every vector of
the table into its most probable partition and sends each query to the most probable ones, whose vectors are reranked by
exact distance in double precision. How many that are is measured: a fifth of the sample is kept from the classifier, and
the probes are the fewest that reach RECALL of those vectors' neighbours in the sample. (Neighbours in the whole table are
nearer than those, hence likelier to share the partition.) Vectors without any structure need most of the partitions,
clustered ones few.

There is a partition for every PER_PARTITION distinct vectors, two at least and MOST at most, as the sample must hold
enough of each; under SMALLEST vectors there is nothing to cut and one partition.

Equal vectors are one entry with its k + 1 smallest ids: no further id can be among the k nearest, as ties go to smaller
ids, so a vector that a third of the rows share costs one entry and nothing is lost. Partitions are split into hashed
pieces of about PIECE entries, and the queries of a partition into blocks of about QUERIES, so no task grows with a large
partition or with the queries sent to it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import materialize

SAMPLE, PER_PARTITION, MOST, SLACK, GRAPH, RECALL = 16_384, 512, 512, 1.15, 10, 0.95
PIECE, QUERIES, SMALLEST = 2048, 4096, 40


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int, dtype) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten()).astype(dtype).reshape(-1, dim)


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest others of each row, in blocks."""
    k = min(k, len(x) - 1)
    norm = (x * x).sum(1)
    out = np.empty((len(x), k), np.int64)
    for a in range(0, len(x), 1024):
        d = norm[None, :] - 2 * x[a : a + 1024] @ x.T
        d[np.arange(len(d)), np.arange(a, a + len(d))] = np.inf
        out[a : a + 1024] = np.argpartition(d, k - 1, axis=1)[:, :k]
    return out


def balanced_partition(x: np.ndarray, graph: np.ndarray, parts: int) -> np.ndarray:
    """A partition of each row; sizes are within SLACK of the mean."""
    label = np.zeros(len(x), np.int64)

    def split(rows: np.ndarray, first: int, n: int) -> None:
        if n == 1:
            label[rows] = first
            return
        y = x[rows] - x[rows].mean(0)
        v = np.random.default_rng(first + n).normal(size=x.shape[1])
        for _ in range(12):  # power iterations for the main direction
            v = y.T @ (y @ v)
            v /= np.linalg.norm(v) + 1e-12
        order = rows[np.argsort(y @ v, kind="stable")]
        cut = len(rows) * (n // 2) // n
        split(order[:cut], first, n // 2)
        split(order[cut:], first + n // 2, n - n // 2)

    split(np.arange(len(x)), 0, parts)
    both = np.concatenate((np.column_stack((np.repeat(np.arange(len(x)), graph.shape[1]), graph.ravel())), np.column_stack((graph.ravel(), np.repeat(np.arange(len(x)), graph.shape[1])))))
    most, least = int(len(x) / parts * SLACK) + 1, int(len(x) / parts / SLACK)
    for _ in range(12):
        votes = np.bincount(both[:, 0] * parts + label[both[:, 1]], minlength=len(x) * parts).reshape(-1, parts)
        best = votes.argmax(1)
        gain = votes.max(1) - votes[np.arange(len(x)), label]
        size = np.bincount(label, minlength=parts)
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if size[best[i]] < most and size[label[i]] > least:
                size[best[i]] += 1
                size[label[i]] -= 1
                label[i] = best[i]
                moved += 1
        if moved < len(x) // 200:
            break
    return label


class Router:
    """A softmax classifier over partitions; inputs are standardised and get their squares' sum as one more."""

    def __init__(self, x: np.ndarray, label: np.ndarray, parts: int):
        self.mean, self.scale = x.mean(0), x.std() + 1e-9
        z = self._inputs(x)
        rng = np.random.default_rng(5)
        self.w = np.zeros((z.shape[1], parts), np.float32)
        m, s, t = np.zeros_like(self.w), np.zeros_like(self.w), 0
        for epoch in range(30):
            order = rng.permutation(len(z))
            for a in range(0, len(z), 256):
                rows = order[a : a + 256]
                p = self._softmax(z[rows] @ self.w)
                p[np.arange(len(rows)), label[rows]] -= 1
                g = z[rows].T @ p / len(rows) + 1e-5 * self.w
                t += 1
                m, s = 0.9 * m + 0.1 * g, 0.99 * s + 0.01 * g * g
                self.w -= 0.03 / (1 + epoch / 6) * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.99**t)) + 1e-8)

    def _inputs(self, x: np.ndarray) -> np.ndarray:
        z = ((x - self.mean) / self.scale).astype(np.float32)
        return np.column_stack((z, (z * z).mean(1), np.ones(len(z), np.float32)))

    @staticmethod
    def _softmax(y: np.ndarray) -> np.ndarray:
        y = np.exp(y - y.max(1, keepdims=True))
        return y / y.sum(1, keepdims=True)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return self._inputs(x) @ self.w


def _probes(router: Router, x: np.ndarray, graph: np.ndarray, queries: np.ndarray) -> int:
    """The fewest probes that reach RECALL of the queries' neighbours."""
    scores = router.scores(x)
    place = np.argsort(np.argsort(-scores[queries], axis=1, kind="stable"), axis=1, kind="stable")
    at = np.take_along_axis(place, scores.argmax(1)[graph], 1)
    return int(np.quantile(at, RECALL, method="higher")) + 1


def usable(vectors: DataFrame) -> DataFrame:
    """vectors(vec_id, embedding, ...) with an id and a vector of finite, not all zero components, as doubles' array."""
    v = vectors.where("vec_id is not null and embedding is not null").select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return v.where(F.forall("embedding", fine) & F.exists("embedding", lambda x: x != 0))


def nearest(vectors: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """vectors(vec_id, embedding, ...) -> (query_id, rank, vec_id, score), the k nearest found for each vec_id divisible by `every`.

    score is the Euclidean distance; ties go to smaller vec_ids; the query's own row is no candidate. Vectors that are
    null, empty, zero, of a length other than the most common one, or hold null or non-finite components, take no part,
    nor do rows without vec_id. Repeated rows count once. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    good = usable(vectors)
    schema = "query_id long, rank int, vec_id long, score double"
    common = good.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if common is None:
        return spark.createDataFrame([], schema)
    dim = common["dim"]
    good = good.where(F.size("embedding") == dim)
    rank = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    entries = materialize(good.dropDuplicates(["vec_id"]).withColumn("rank", rank).where(f"rank <= {k + 1}"))
    distinct = entries.where("rank = 1")
    n = distinct.count()
    parts = int(np.clip(n // PER_PARTITION, 2, MOST)) if n >= SMALLEST else 1
    if parts > 1:
        sample = distinct.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("embedding").toArrow()
        x = _matrix(sample.column(0), dim, np.float32)
        graph = neighbour_graph(x, GRAPH)
        label = balanced_partition(x, graph, parts)
        unseen = np.arange(len(x)) % 5 == 4
        router = Router(x[~unseen], label[~unseen], parts)
        probes = _probes(router, x, graph[unseen], unseen)

    def assign(batches):
        for batch in batches:
            y = _matrix(batch.column(1), dim, np.float32)
            best = router.scores(y).argmax(1) if parts > 1 else np.zeros(len(y), np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(best, pa.int32())], ["vec_id", "embedding", "part"])

    def route(batches):
        for batch in batches:
            y = _matrix(batch.column(1), dim, np.float32)
            best = np.argsort(-router.scores(y), axis=1, kind="stable")[:, :probes] if parts > 1 else np.zeros((len(y), 1), np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(best.astype(np.int32)), pa.list_(pa.int32()))], ["query_id", "query", "parts"])

    kind = good.schema["embedding"].dataType.simpleString()
    index = materialize(entries.select("vec_id", "embedding").mapInArrow(assign, f"vec_id long, embedding {kind}, part int"))
    pieces = index.groupBy("part").agg(F.ceil(F.count("*") / PIECE).cast("int").alias("pieces"))  # one row for each of at most MOST partitions
    queries = good.dropDuplicates(["vec_id"]).where(f"vec_id % {every} = 0").select("vec_id", "embedding").mapInArrow(route, f"query_id long, query {kind}, parts array<int>")
    queries = materialize(queries.select("query_id", "query", F.explode("parts").alias("part")))
    blocks = queries.groupBy("part").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("blocks"))
    plan = pieces.join(blocks, "part")  # no partition without queries is searched
    queries = queries.join(F.broadcast(plan), "part").withColumn("block", F.pmod(F.xxhash64("query_id"), F.col("blocks")).cast("int"))
    queries = queries.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).select("query_id", "query", "part", "piece", "block")
    index = index.join(F.broadcast(plan), "part").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    index = index.select("vec_id", "embedding", "part", F.pmod(F.xxhash64("vec_id"), F.col("pieces")).cast("int").alias("piece"), "block")

    def rerank(key, left, right):
        q, qid = _matrix(left.column("query"), dim, np.float64), left.column("query_id").to_numpy()
        c, cid = _matrix(right.column("embedding"), dim, np.float64), right.column("vec_id").to_numpy()
        out = []
        norm = (c * c).sum(1)
        for a in range(0, len(q) if len(c) else 0, 256):
            near = norm[None, :] - 2 * q[a : a + 256] @ c.T
            for i, d in enumerate(near, a):
                own = (q[i] * q[i]).sum()
                most = min(k + 1, len(d))
                limit = np.partition(d, most - 1)[most - 1]
                some = np.nonzero(d <= limit + 1e-9 * (1 + own + abs(limit)))[0]
                some = some[cid[some] != qid[i]]
                exact = np.sqrt(((c[some] - q[i]) ** 2).sum(1))
                for j in np.lexsort((cid[some], exact))[:k]:
                    out.append((qid[i], cid[some[j]], exact[j]))
        cols = list(zip(*out)) or [()] * 3
        return pa.table({"query_id": pa.array(cols[0], pa.int64()), "vec_id": pa.array(cols[1], pa.int64()), "score": pa.array(cols[2], pa.float64())})

    found = queries.groupBy("part", "piece", "block").cogroup(index.groupBy("part", "piece", "block")).applyInArrow(rerank, "query_id long, vec_id long, score double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", place).where(f"rank <= {k}").select("query_id", "rank", "vec_id", "score")
