"""Corpus pipeline: quality, near-dedup, decontamination, mixing, token files. Each stage takes the former's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from factloom.llm import leaks, minhash, mixing, quality, tokenfile
from factloom.llm.common import crc_mod, materialize, table
from factloom.llm.queries import tokenizer_path


#: Words whose ids a worker keeps, and bytes of text that it splits at once: less than in op6, as an executor of the pipeline
#: holds what earlier stages left too.
WORDS_KEPT, SLICE = 200_000, 1 << 22


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier scores under 0.5; it learns from the labels of all documents of the corpus.

    Every row has its own score, those without doc_id and repeated ones too; null and empty texts have that of no text. The
    columns are those of docs, whatever their names.
    """
    model = quality.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), crc_mod("doc_id", 3) != 1)
    name = "score"
    while name in (c.lower() for c in docs.columns):
        name += "_"
    return quality.score_rows(docs, model, name).where(F.col(name) >= 0.5).drop(name)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (5-word shingles, similarity 0.8): the smallest doc_id, once.

    Null and empty texts are like nothing and stay, as do rows without doc_id; of repeated rows of a doc_id one stays.
    """
    gone = minhash.near_duplicates(docs).where("not kept").select("doc_id").distinct()
    named = docs.where("doc_id is not null")  # rows without doc_id would all meet in one task of the join
    once = named.join(gone, "doc_id", "left_anti").select(docs.columns)
    return once.dropDuplicates(["doc_id"]).unionByName(docs.where("doc_id is null"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage similar to a benchmark item, all rows of them.

    Null and empty texts hold nothing; rows without doc_id stay, as they cannot be told apart.
    """
    bad = leaks.find_leaks(docs, table(spark, sf_dir, "benchmark")).where("contaminated").select("doc_id").distinct()
    clean = docs.where("doc_id is not null").join(bad, "doc_id", "left_anti").select(docs.columns)
    return clean.unionByName(docs.where("doc_id is null"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents of sources that are short of their target weight; rows are written in the mix's order.

    Every row is placed once at least, whatever its text or doc_id; a null source is one of its own. The columns are those
    of docs, whatever their names.
    """
    return mixing.placed(docs).repartitionByRange("slot", "place").sortWithinPartitions("slot", "place").select("doc.*")


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str, order: tuple = ("doc_id",)) -> DataFrame:
    """Encodes the texts, writes coded blocks in the given order and returns the documents' places as read back from them.

    A row for each row of docs: null and empty texts have the end id alone, rows without doc_id come first in order of
    doc_id, repeated rows stand together. Only doc_id, text and the order's columns are read.
    """
    return tokenfile.read_ids(tokenfile.write_ids(docs, tokenizer_path(), order=order, memo=WORDS_KEPT, slice_bytes=SLICE))


STAGES = [
    ("quality classifier", keep_quality),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_leaks),
    ("mixing sources to target weights", mix_sources),
    ("token-ID output", write_tokens),
]

#: SQL can express neither the compression classifier nor the tokenizer; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; slot and place are carried from the mix to the token files, which are written in the mix's order."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        if stage is mix_sources:
            docs = mixing.mix(docs)
        elif stage is write_tokens:
            docs = write_tokens(spark, docs, sf_dir, ("slot", "place"))
        else:
            docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs)
    return docs
