"""The batch run: files, pages, chunks, index, facts; finished documents are skipped."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession, functions as F

from factloom.config import Settings
from factloom.functions.text import company_name, stock_code
from factloom.operators import chunking, extract, facts, vector
from factloom.schemas import FAILED
from factloom.shared import materialize
from factloom.sources import files

log = logging.getLogger("factloom")
#: Failed files that the log names one by one; all of them are counted and have an outcome.
NAMED = 20


def process(spark: SparkSession, pages: DataFrame, store: facts.FactStore, settings: Settings, extractor, embedder) -> DataFrame:
    """pages of new documents -> (doc_id, outcome). The index is written before the facts, so a resumed run finds it."""
    chunks = materialize(chunking.chunk_pages(pages, settings.chunk_size, settings.chunk_overlap))
    index = materialize(vector.build(chunks, embedder))
    files.dump_chunks(chunks, f"{settings.output_dir}/chunks")
    files.save_index(index, f"{settings.index_dir}/chunks")
    docs = pages.select("doc_id").distinct().withColumn("stock_code", stock_code(F.col("doc_id"))).withColumn("company_name", company_name(F.col("doc_id")))
    results = extract.extract_fields(index, docs, extractor, embedder, settings.top_k, settings.enable_multi_round, settings.llm_max_retries)
    made = materialize(extract.to_facts(results, docs))
    store.save(made)
    return made.select("doc_id", F.col("status").alias("outcome"))


def run(spark: SparkSession, path: str, settings: Settings, extractor, embedder, parser: files.PageParser, resume: bool = True) -> dict[str, int]:
    """Counts of the run's documents by outcome. A file that fails is logged and counted; the others go on."""
    store = facts.FactStore(spark, settings.db_path)
    found = files.list_files(spark, path)
    todo = materialize(facts.pending(found, store.read(), resume))
    read = materialize(files.read_files(spark, todo, parser, path))
    bad = read.where("error is not null")
    for r in bad.limit(NAMED).collect():
        log.error("%s cannot be read: %s", r["doc_id"], r["error"])
    done = process(spark, read.where("error is null").drop("error"), store, settings, extractor, embedder)
    skipped = found.join(todo, "doc_id", "left_anti").select("doc_id", F.lit("skipped").alias("outcome"))
    outcomes = todo.select("doc_id").join(done, "doc_id", "left").select("doc_id", F.coalesce("outcome", F.lit(FAILED)).alias("outcome"))
    counts = facts.run_stats(outcomes.unionByName(skipped)).first().asDict()
    log.info("documents: %(total)d, success %(success)d, failed %(failed)d, skipped %(skipped)d", counts)
    return counts
