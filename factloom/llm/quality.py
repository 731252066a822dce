"""Compression quality classifier.

Two zstandard dictionaries are trained, on good and on bad labelled texts. A text is compressed in pieces of PIECE bytes
with either; the difference of the two sizes over the text's length says which kind it is closer to. A logistic
calibrator, fitted on labelled texts that no dictionary has seen, turns it, with the size without a dictionary (which
shows repetition) and the length, into a score from 0 to 1.

Fitted on a bounded sample of labelled rows: `per_class` of each class by hash of doc_id, long ones among them, as far as
`characters` in all go. Scoring reads whole texts.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F, types as T

from .common import binary_column, crc_mod

PER_CLASS, CHARACTERS, PIECE, DICT_BYTES, LEVEL = 2000, 64_000_000, 1024, 65_536, 3


class _Compressors:
    def __init__(self, good: bytes, bad: bytes):
        def of(data: bytes) -> zstandard.ZstdCompressor:
            d = zstandard.ZstdCompressionDict(data)
            d.precompute_compress(level=LEVEL)
            return zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_dict_id=False)

        self.good, self.bad = of(good), of(bad)
        self.plain = zstandard.ZstdCompressor(level=1, write_content_size=False)

    def features(self, text: bytes | None) -> list[float]:
        if not text:
            return [0.0, 0.0, 0.0]
        good = bad = 0
        for at in range(0, len(text), PIECE):
            piece = text[at : at + PIECE]
            good += len(self.good.compress(piece))
            bad += len(self.bad.compress(piece))
        n = len(text)
        return [(bad - good) / n, len(self.plain.compress(text)) / (n + 16), float(np.log1p(n))]


def _expand(x: np.ndarray) -> np.ndarray:
    d, r, n = (x[:, i] for i in range(3))
    return np.column_stack([np.ones(len(x)), d, r, n, d * n, r * n, r * r, d * r, n * n, d * d])


@dataclass(frozen=True)
class QualityModel:
    good: bytes
    bad: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = (_expand(x) - self.mean) / self.scale
        return 1 / (1 + np.exp(-np.clip(z @ self.weights, -30, 30)))


def _dictionary(texts: list[bytes]) -> bytes:
    """Small or uniform samples can't train a dictionary; their own last bytes serve then."""
    pieces = [t[at : at + PIECE] for t in texts for at in range(0, len(t), PIECE)]
    try:
        return zstandard.train_dictionary(DICT_BYTES, pieces, k=256, d=8).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(pieces)[-DICT_BYTES:] or b"\n" * 8


def fit(docs: DataFrame, labels: DataFrame, learn, per_class: int = PER_CLASS, characters: int = CHARACTERS) -> QualityModel:
    """learn: a condition on doc_id that the labelled rows to learn from meet.

    per_class and characters bound the sample, which the driver holds: rows in order of a hash of doc_id, each of them whole,
    without those that do not fit what is left of `characters`.

    Rows without doc_id, or with a quality other than 0 and 1, teach nothing. With one class alone, or no labels, scores
    tend to that class's share, or 0.5.
    """
    known = labels.where("doc_id is not null and quality in (0, 1)").where(learn).select("doc_id", "quality").dropDuplicates(["doc_id"])
    order = F.xxhash64("doc_id")
    some = [known.where(F.col("quality") == q).orderBy(order, "doc_id").limit(per_class) for q in (0, 1)]
    named = F.broadcast(some[0].unionByName(some[1]))  # at most 2 * per_class rows
    sizes = docs.join(named, "doc_id").groupBy("doc_id").agg(F.coalesce(F.max(F.length("text")), F.lit(0)).alias("n")).collect()
    chosen, left = [], characters
    for r in sorted(sizes, key=lambda r: zlib.crc32(str(r["doc_id"]).encode())):
        if r["n"] <= left:
            chosen.append((r["doc_id"],))
            left -= r["n"]
    wanted = F.broadcast(docs.sparkSession.createDataFrame(chosen, "doc_id long"))
    rows = docs.select("doc_id", "text").join(wanted, "doc_id").join(named, "doc_id").dropDuplicates(["doc_id"])
    rows = sorted((r["doc_id"], r["quality"], r["text"] or "") for r in rows.collect())
    texts = {(q, half): [t.encode() for k, (_, label, t) in enumerate(rows) if label == q and k % 2 == half and t] for q in (0, 1) for half in (0, 1)}
    good, bad = _dictionary(texts[1, 0]), _dictionary(texts[0, 0])
    made = _Compressors(good, bad)
    y = np.array([1.0] * len(texts[1, 1]) + [0.0] * len(texts[0, 1]))
    x = np.array([made.features(t) for t in texts[1, 1] + texts[0, 1]]).reshape(-1, 3)
    # one pseudo-row of either class keeps empty and one-sided samples defined
    y, x = np.concatenate((y, [0.0, 1.0])), np.concatenate((x, np.zeros((2, 3)))) if len(x) == 0 else np.concatenate((x, [x.mean(0)] * 2))
    e = _expand(x)
    mean, scale = e.mean(0), e.std(0) + 1e-9
    mean[0], scale[0] = 0, 1
    e = (e - mean) / scale
    w = np.zeros(e.shape[1])
    for _ in range(30):  # Newton steps with a ridge
        p = 1 / (1 + np.exp(-np.clip(e @ w, -30, 30)))
        w += np.linalg.solve((e * (p * (1 - p))[:, None]).T @ e + 0.05 * np.eye(len(w)), e.T @ (y - p) - 0.05 * w)
    return QualityModel(good, bad, mean, scale, w)


def score_rows(docs: DataFrame, model: QualityModel, name: str = "score") -> DataFrame:
    """docs(text, ...) with a column `name` (which replaces one of that name); null and empty texts get the score of no text."""
    docs = docs.drop(name)

    def run(batches):
        made = _Compressors(model.good, model.bad)
        for batch in batches:
            x = np.array([made.features(t) for t in binary_column(batch, "text")]).reshape(-1, 3)
            yield batch.append_column(name, pa.array(model.probability(x), pa.float64()))

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """docs(doc_id, text, ...) -> (doc_id, score), a row for each row of docs."""
    return score_rows(docs.select("doc_id", "text"), model).select("doc_id", "score")


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """-> (doc_id, held_out, score, predicted); learns from labels whose crc32(doc_id) mod 3 is not 1. A null doc_id is not held out."""
    model = fit(docs, labels, crc_mod("doc_id", 3) != 1)
    out = score(docs, model)
    return out.select("doc_id", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
