"""Embedding and exact inner-product search over one table of chunks with their embeddings."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T


class Embedder(Protocol):
    def embed(self, texts: list[str]) -> np.ndarray:
        """One L2-normalised float32 row for each text."""


class NgramEmbedder:
    """Deterministic and offline: hashed trigrams of code points, L2-normalised.

    A trigram of a padded text, read as a number in base 31, is multiplied by 2654435761 modulo 2**32; bits 16 and up name
    the dimension, bit 22 the sign.
    """

    def __init__(self, dim: int = 64):
        self.dim = dim

    def embed(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dim))
        for row, text in zip(out, texts):
            c = np.frombuffer(f"^{text}$".encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
            if len(c) < 3:
                c = np.concatenate((c, np.zeros(3 - len(c), np.int64)))
            h = ((c[:-2] * 31 + c[1:-1]) * 31 + c[2:]) * 2654435761 % 2**32
            row += np.bincount((h >> 16) % self.dim, np.where(h >> 22 & 1, 1.0, -1.0), self.dim)
        norm = np.sqrt((out * out).sum(1, keepdims=True))
        return (out / np.where(norm > 0, norm, 1)).astype(np.float32)


def embed(df: DataFrame, embedder: Embedder, text: str = "text", name: str = "embedding") -> DataFrame:
    @F.pandas_udf("array<float>")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(list(embedder.embed(batch.fillna("").tolist())))

    return df.withColumn(name, of(text))


def embed_text(embedder: Embedder, text: str) -> list[float]:
    return [float(x) for x in embedder.embed([text])[0]]


def dot(a: Column, b: Column) -> Column:
    """Inner product in double precision."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def _vector(query: list[float]) -> Column:
    return F.array(*[F.lit(float(x)) for x in query])


def build(chunks: DataFrame, embedder: Embedder) -> DataFrame:
    return embed(chunks, embedder)


def append(index: DataFrame, new: DataFrame, replace: bool = True) -> DataFrame:
    """Adds chunks; those of documents that come again are replaced, or kept beside with replace=False."""
    old = index.join(new.select("doc_id").distinct(), "doc_id", "left_anti") if replace else index
    return old.unionByName(new)


def search(index: DataFrame, query: list[float], top_k: int | None = None, doc_id=None, compat: bool = False) -> DataFrame:
    """The k best by inner product, ties by (doc_id, chunk_id). compat ranks 3 k over all documents, then filters."""
    k = 8 if top_k is None else top_k
    order = [F.desc("score"), "doc_id", "chunk_id"]
    if doc_id is not None and not compat:
        index = index.where(F.col("doc_id") == doc_id)
    hits = index.withColumn("score", dot(F.col("embedding"), _vector(query))).drop("embedding")
    if doc_id is not None and compat:
        hits = hits.orderBy(*order).limit(3 * k).where(F.col("doc_id") == doc_id)
    return hits.orderBy(*order).limit(k)


def search_sections(index: DataFrame, query: list[float], keywords: list[str], top_k: int | None = None, doc_id=None) -> DataFrame:
    """As search, over chunks whose section holds any of the keywords."""
    if not keywords:
        return search(index.where("false"), query, top_k)
    any_word = F.lit(False)
    for word in keywords:
        any_word = any_word | F.contains("section", F.lit(word))
    return search(index.where(any_word), query, top_k, doc_id)


def search_text(index: DataFrame, embedder: Embedder, text: str, **how) -> DataFrame:
    return search(index, embed_text(embedder, text), **how)


def search_sections_text(index: DataFrame, embedder: Embedder, text: str, keywords: list[str], **how) -> DataFrame:
    return search_sections(index, embed_text(embedder, text), keywords, **how)


def batch_search(index: DataFrame, queries: DataFrame, k: int, on: list[str], by: list[str]) -> DataFrame:
    """queries(*by, query, ...) against chunks with equal `on` columns: the k best of each query, with score and rank.

    Without `on` every query meets every chunk; pairs are made in blocks then, and each gives its k best alone.
    """
    if on:
        pairs = index.join(queries, on).withColumn("score", dot(F.col("embedding"), F.col("query"))).drop("embedding", "query")
    else:
        pairs = _best_by_block(index, queries, k, by)
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), F.asc_nulls_last("chunk_id")))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k)


#: Chunks and queries of a block, about; scores held at once; columns among which a maximum is taken first.
CHUNKS, QUERIES, CELLS, RUN = 32_768, 4_096, 4_194_304, 64


def _best_by_block(index: DataFrame, queries: DataFrame, k: int, by: list[str]) -> DataFrame:
    """Chunks and queries are dealt into blocks by hash, every block of chunks meets every block of queries."""
    pieces, blocks = (max(1, -(-df.count() // most)) for df, most in ((index, CHUNKS), (queries, QUERIES)))
    deal = lambda n, *of: F.pmod(F.xxhash64(*of), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.withColumn("_block", deal(blocks, *by, "query")).withColumn("_piece", every(pieces))
    right = index.withColumn("_piece", deal(pieces, "doc_id", "chunk_id", "embedding")).withColumn("_block", every(blocks))
    of_index, of_queries = ([f for f in df.schema.fields if f.name != name] for df, name in ((index, "embedding"), (queries, "query")))

    def search(asked: pa.Table, chunks: pa.Table) -> pa.Table:
        chunks = chunks.take(pc.sort_indices(chunks, [("doc_id", "ascending"), ("chunk_id", "ascending")], null_placement="at_end"))
        at, score, known = best(asked["query"].combine_chunks(), chunks["embedding"].combine_chunks(), k)
        row = pa.array(np.repeat(np.arange(len(at)), at.shape[1]))
        columns = {f.name: chunks[f.name].take(pa.array(at.ravel())) for f in of_index} | {f.name: asked[f.name].take(row) for f in of_queries}
        return pa.table(columns | {"score": pa.array(score.ravel(), pa.float64(), mask=~known.ravel())})

    schema = T.StructType([*of_index, *of_queries, T.StructField("score", T.DoubleType())])
    return left.groupBy("_piece", "_block").cogroup(right.groupBy("_piece", "_block")).applyInArrow(search, schema)


def _lengths(vectors: pa.Array) -> np.ndarray:
    """The length of each vector, -1 for one that is null or holds a null."""
    n = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False).copy()
    if pc.list_flatten(vectors).null_count:
        n[pc.list_parent_indices(vectors).filter(pc.is_null(pc.list_flatten(vectors))).to_numpy()] = -1
    return n


def best(queries: pa.Array, chunks: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each query the positions of its k best chunks (all, if fewer), their inner products, and which of these are known.

    The order is that of dot() in Spark: NaN first, unknown last (a vector that is null or holds a null, lengths that
    differ), ties to earlier chunks.
    """
    of_query, of_chunk, m = _lengths(queries), _lengths(chunks), min(k, len(chunks))
    at, score, known = np.tile(np.arange(m), (len(queries), 1)), np.zeros((len(queries), m)), np.zeros((len(queries), m), bool)
    for dim in np.unique(of_query[of_query >= 0]) if m else ():
        q, c = np.flatnonzero(of_query == dim), np.flatnonzero(of_chunk == dim)
        rest = np.flatnonzero(of_chunk != dim)
        matrix = lambda v, rows: pc.list_flatten(v.take(pa.array(rows))).to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), dim)
        t = min(m, len(c))
        if t:
            top, score[q, :t] = _top(matrix(queries, q), matrix(chunks, c), t)
            at[q, :t], known[q, :t] = c[top], True
        at[q, t:] = rest[: m - t]
    return at, score, known


def _same(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first row of each group of equal rows, and each row's group."""
    if not x.shape[1]:
        return np.zeros(1, np.int64), np.zeros(len(x), np.int64)
    _, first, group = np.unique(np.ascontiguousarray(x).view(f"V{x.shape[1] * x.itemsize}").ravel(), return_index=True, return_inverse=True)
    return first, group.ravel()


def _top(queries: np.ndarray, chunks: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and inner products of the k best of at least k chunks, each sum taken in order, as dot() does.

    Matrix products come first; all that their rounding leaves in question is summed again. Equal queries are one, and of
    equal chunks the first k are enough.
    """
    first, group = _same(queries)
    q = queries[first]
    same = _same(chunks)[1]
    order = np.argsort(same, kind="stable")
    run = np.r_[0, np.flatnonzero(np.diff(same[order])) + 1]
    copy = np.arange(len(order)) - np.repeat(run, np.diff(np.r_[run, len(order)]))
    kept = np.sort(order[copy < k])
    c = chunks[kept]
    with np.errstate(all="ignore"):
        norms = [np.sqrt((x * x).sum(1)) for x in (q, c)]
        fine_q, fine_c = map(np.isfinite, norms)
        wild = np.flatnonzero(~fine_c)
        groups = -(-len(c) // RUN)
        short = np.zeros((groups * RUN, c.shape[1]))
        short[: len(c)][fine_c] = c[fine_c]
        usable = np.r_[fine_c, np.zeros(len(short) - len(c), bool)]
        slack = 4 * (c.shape[1] + 2) * np.finfo(float).eps * norms[0] * np.max(norms[1], where=fine_c, initial=0) + 1e-300
        q_t, c_t = np.ascontiguousarray(q.T), np.ascontiguousarray(c.T)
        at, score = np.empty((len(q), k), np.int64), np.empty((len(q), k))
        step = max(1, CELLS // len(short))
        for a in range(0, len(q), step):
            fine = fine_q[a : a + step]
            near = np.where(fine[:, None], q[a : a + step], 0) @ short.T
            near[:, ~usable] = -np.inf
            near = near.reshape(len(fine), RUN, groups)  # column r * groups + g is in run g
            most = near.max(1)
            least = np.partition(most, groups - k, axis=1)[:, groups - k] - slack[a : a + step] if groups >= k else np.full(len(fine), -np.inf)
            least = np.where(fine, least, -np.inf)
            i, g = np.nonzero(most >= least[:, None])
            p, r = np.nonzero(near[i, :, g] >= least[i, None])
            i, j = i[p], r * groups + g[p]
            i, j = i[usable[j]], j[usable[j]]
            i, j = np.r_[i, np.repeat(np.arange(len(fine)), len(wild))], np.r_[j, np.tile(wild, len(fine))]
            exact = np.zeros(len(i))
            for x, y in zip(q_t[:, a : a + step], c_t):
                exact += x[i] * y[j]
            nan = np.isnan(exact)
            o = np.lexsort((j, np.where(nan, 0, -exact), ~nan, i))
            o = o[np.searchsorted(i[o], np.arange(len(fine)))[:, None] + np.arange(k)]
            at[a : a + step], score[a : a + step] = kept[j[o]], exact[o]
    return at[group], score[group]


def indexed_docs(index: DataFrame) -> DataFrame:
    return index.select("doc_id").distinct()


def dimension(index: DataFrame) -> Column:
    return F.size("embedding")


def dedup_hits(hits: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Per (by, doc_id, chunk_id) the best score, earliest by `order` on ties; `first_seen` orders equal scores."""
    seq = F.struct(*order)
    rest = [c for c in hits.columns if c not in {*by, "doc_id", "chunk_id"}]
    keys = list(dict.fromkeys([*by, "doc_id", "chunk_id"]))
    score = F.col("score")
    best = F.min_by(F.struct(*rest), F.struct(score.isNull().alias("n"), (~F.isnan(score)).alias("f"), (-score).alias("s"), seq.alias("q")))
    return hits.groupBy(*keys).agg(best.alias("best"), F.min(seq).alias("first_seen")).select(*keys, "best.*", "first_seen")
