"""File and page sources, and the sinks; all paths are Spark's, so any file system it knows will do."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import Protocol

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from factloom.functions.text import doc_id, strip
from factloom.schemas import CHUNK, PAGE
from factloom.shared import materialize

#: Folders of a sink of documents; a document lies in one of them, by hash, so a run rewrites the folders it touches.
BUCKETS = 64


class PageParser(Protocol):
    def pages(self, content: bytes) -> list[tuple[int, str]]:
        """(page number from 1, Markdown text) of a file."""


class TextParser:
    """Offline: form feeds part the pages of a UTF-8 text."""

    def pages(self, content: bytes) -> list[tuple[int, str]]:
        return list(enumerate(content.decode("utf-8", "replace").split("\f"), 1))


class PdfParser:
    """Markdown pages by pymupdf4llm, where that is installed; numbers come from the pages' own metadata."""

    def pages(self, content: bytes) -> list[tuple[int, str]]:
        import pymupdf
        import pymupdf4llm

        found = pymupdf4llm.to_markdown(pymupdf.open(stream=content, filetype="pdf"), page_chunks=True)
        return [(int(p.get("metadata", {}).get("page") or k), p.get("text") or "") for k, p in enumerate(found, 1)]


def _missing(error: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in (error.getCondition() or "")


def _files(spark: SparkSession, path: str) -> DataFrame:
    # folders below are no partitions of a table, whatever their names
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """A file of any extension, or a folder's *.pdf (not below it), by path -> (path, doc_id). Spark lists, not the driver."""
    try:
        found = _files(spark, path).select("path")
    except AnalysisException as e:
        if _missing(e):
            raise FileNotFoundError(path) from None
        raise
    root = re.sub(r"^[a-z0-9]+:(//[^/]*)?", "", path.rstrip("/"))
    folder = F.regexp_extract(F.col("path"), r"(.*)/[^/]*\z", 1)
    inside = F.endswith(F.col("path"), F.lit(".pdf")) & F.endswith(folder, F.lit(root))
    kept = found.where(inside | (F.endswith(F.col("path"), F.lit(root)) & ~F.endswith(folder, F.lit(root))))
    return kept.withColumn("doc_id", doc_id(F.col("path"))).orderBy("path")


def read_files(spark: SparkSession, files: DataFrame, parser: PageParser, root: str) -> DataFrame:
    """files(path) below `root` -> (doc_id, page_number, text, error): stripped pages, or one row with the error of a file that cannot be parsed."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for name, content in zip(pdf["doc_id"], pdf["content"]):
                try:
                    out += [(name, n, t, None) for n, t in parser.pages(bytes(content))]
                except Exception as e:
                    out.append((name, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["doc_id", "page_number", "text", "error"]).astype({"page_number": "Int32"})

    wanted = files.select("path")
    content = _files(spark, root).select("path", "content").join(wanted, "path", "left_semi")
    pages = content.select(doc_id(F.col("path")).alias("doc_id"), "content").mapInPandas(run, f"{PAGE}, error string")
    return pages.withColumn("text", strip(F.col("text"))).where("error is not null or text <> ''")


def read_pages(spark: SparkSession, path: str, parser: PageParser) -> DataFrame:
    """Pages of a file or of a folder's files, stripped, without empty ones; files that cannot be parsed have none."""
    return read_files(spark, list_files(spark, path), parser, path).where("error is null").drop("error")


def read_chunks_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Blank lines are skipped; a malformed one fails."""
    return spark.read.schema(CHUNK).option("mode", "FAILFAST").json(path)


def _stored(spark: SparkSession, path: str, schema: str, kind: str) -> DataFrame | None:
    try:
        return spark.read.schema(schema).format(kind).load(path)
    except AnalysisException as e:
        if _missing(e):
            return None
        raise


def _replace_documents(new: DataFrame, path: str, schema: str, kind: str) -> None:
    """Writes new documents; stored ones stay, but for those that come again. Only touched folders are written."""
    new = new.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS)).cast("int"))
    old = _stored(new.sparkSession, path, f"{schema}, bucket int", kind)
    if old is not None:
        touched = [r["bucket"] for r in new.select("bucket").distinct().collect()]  # at most BUCKETS
        rest = old.where(F.col("bucket").isin(touched)).join(new.select("doc_id").distinct(), "doc_id", "left_anti")
        new = materialize(new.unionByName(rest))
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").format(kind).save(path)


def dump_chunks(chunks: DataFrame, path: str) -> None:
    """Chunks as JSON lines; documents in it replace their former rows, others stay."""
    _replace_documents(chunks, path, CHUNK, "json")


def save_index(index: DataFrame, path: str) -> bool:
    """Writes the index unless it is empty; documents in it replace their former rows, others stay."""
    if index.limit(1).count() == 0:
        return False
    _replace_documents(index, path, _INDEX, "parquet")
    return True


_INDEX = f"{CHUNK}, embedding array<float>"


def load_index(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored index, or None where there is none."""
    return _stored(spark, path, _INDEX, "parquet")
