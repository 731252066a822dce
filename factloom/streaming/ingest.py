"""Page files as a stream: each micro-batch re-runs the documents that it touches, with all their pages so far."""

from __future__ import annotations

from pyspark.sql import SparkSession

from factloom.operators import facts
from factloom.plans import pipeline
from factloom.schemas import PAGE
from factloom.shared import materialize


def start(spark: SparkSession, path: str, checkpoint: str, store: facts.FactStore, settings, extractor, embedder):
    """Takes what is there (availableNow) of parquet page files and ends; -> the StreamingQuery.

    Pages of a document may come in several micro-batches: each one that brings some replaces the document's chunks, index
    rows and facts by those of all its pages. A replayed batch gives the same rows again.
    """

    def batch(pages, _):
        touched = materialize(pages.select("doc_id").distinct())
        if touched.limit(1).count():
            whole = spark.read.schema(PAGE).parquet(path).join(touched, "doc_id", "left_semi")
            pipeline.process(spark, materialize(whole), store, settings, extractor, embedder)

    return spark.readStream.schema(PAGE).parquet(path).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
