"""Text and table blocks, paragraph packing, sliding windows, page lookup, and the chunker made of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from factloom.functions.text import SPACE, blank, let, strip
from factloom.operators.sections import documents, with_sections

def blocks(section: Column) -> Column:
    """array<struct<type,content>>: maximal runs of table lines (stripped, they start with |) and of others; blank runs go."""
    lines = F.split(section, "\n", -1)
    marked = F.struct(lines.alias("lines"), F.transform(lines, lambda x: x.rlike(rf"(?U)\A{SPACE}*\|")).alias("table"))

    def cut(m: Column) -> Column:
        every = F.sequence(F.lit(0), F.size(m["lines"]) - 1)
        starts = F.filter(every, lambda i: (i == 0) | (F.get(m["table"], i) != F.get(m["table"], i - 1)))
        return let(starts, lambda s: F.transform(s, lambda i, j: run(m, i, F.coalesce(F.get(s, j + 1), F.size(m["lines"])))))

    def run(m: Column, first: Column, end: Column) -> Column:
        kind = F.when(F.get(m["table"], first), "table").otherwise("text")
        return F.struct(kind.alias("type"), strip(F.array_join(F.slice(m["lines"], first + 1, end - first), "\n")).alias("content"))

    return F.filter(let(marked, cut), lambda b: b["content"] != "")


def sliding_windows(text: Column, size: int, overlap: int) -> Column:
    """Stripped slices of `size` characters from 0, size - overlap, ...; a last one inside its neighbour stays.

    The text is cut into steps once; a window is a step and as many of the following as it overlaps.
    """
    _check(size, overlap)
    step = size - overlap
    steps = 1 + -(-overlap // step)
    pieces = F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{step}}}"), F.lit(0))
    return let(pieces, lambda p: F.transform(p, lambda x, i: strip(F.substring(F.array_join(F.slice(p, i + 1, F.lit(steps)), ""), 1, size))))


def _check(size: int, overlap: int) -> None:
    if size < 1 or not 0 <= overlap < size:
        raise ValueError("chunk_overlap must be at least 0 and smaller than chunk_size")


def pack(text: Column, size: int, overlap: int) -> Column:
    """array<string>: a text that fits is one chunk; else paragraphs are packed, and longer ones cut into windows."""
    _check(size, overlap)
    paras = F.filter(F.transform(F.split(text, rf"(?U)\n{SPACE}*\n", -1), strip), lambda p: p != "")
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit("").alias("cur"))

    def step(acc: Column, p: Column) -> Column:
        cur, out = acc["cur"], acc["out"]
        flushed = F.when(cur != "", F.concat(out, F.array(strip(cur)))).otherwise(out)
        fits = F.length(cur) + F.length(p) + 2 <= size
        joined = F.when(cur != "", F.concat(cur, F.lit("\n\n"), p)).otherwise(p)
        new_out = F.when(fits, out).when(F.length(p) <= size, flushed).otherwise(F.concat(flushed, sliding_windows(p, size, overlap)))
        return F.struct(new_out.alias("out"), F.when(fits, joined).when(F.length(p) <= size, p).otherwise(F.lit("")).alias("cur"))

    done = F.aggregate(paras, start, step, lambda acc: F.when(acc["cur"] != "", F.concat(acc["out"], F.array(strip(acc["cur"])))).otherwise(acc["out"]))
    return F.when(F.length(text) <= size, F.array(text)).otherwise(done)


def page_at(bounds: Column, position: Column) -> Column:
    """The first page whose end is after the position; past the end the last; without pages 1."""
    later = F.filter(bounds, lambda b: position < b["end"])
    return F.coalesce(F.get(later, F.lit(0))["page"], F.try_element_at(bounds, F.lit(-1))["page"], F.lit(1))


def chunk_pages(pages: DataFrame, size: int | None = None, overlap: int | None = None) -> DataFrame:
    """pages(doc_id, page_number, text) -> chunks; ids count from 0 in each document; None takes the defaults."""
    size, overlap = 512 if size is None else size, 64 if overlap is None else overlap
    _check(size, overlap)
    docs = with_sections(documents(pages))
    rows = docs.select("doc_id", "bounds", F.posexplode("sections").alias("s", "section"))
    rows = rows.select("doc_id", "bounds", "s", F.col("section.title").alias("section"), F.col("section.start").alias("start"), blocks(F.col("section.text")).alias("blocks"))
    rows = rows.select("doc_id", "bounds", "s", "section", "start", F.posexplode("blocks").alias("b", "block"))
    # the documents are dealt out by doc_id already, so this and the numbering below need no further exchange
    earlier = Window.partitionBy("doc_id", "s").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.length("block.content") + 2).over(earlier), F.lit(0)).cast("int")
    rows = rows.withColumn("position", F.col("start") + before)
    rows = rows.select("doc_id", "s", "b", "section", page_at(F.col("bounds"), F.col("position")).alias("page"), F.col("block.type").alias("type"), F.col("block.content").alias("content"))
    texts = F.when(F.col("type") == "table", F.array("content")).otherwise(pack(F.col("content"), size, overlap))
    rows = rows.select("doc_id", "s", "b", "section", "page", "type", F.posexplode(F.filter(texts, lambda t: ~blank(t))).alias("c", "text"))
    number = (F.row_number().over(Window.partitionBy("doc_id").orderBy("s", "b", "c")) - 1).cast("int")
    return rows.select("doc_id", number.alias("chunk_id"), "text", F.col("page").cast("int").alias("page"), "section", F.create_map(F.lit("chunk_type"), "type").alias("metadata"))


def chunk_type_counts(chunks: DataFrame) -> DataFrame:
    kind = F.col("metadata")["chunk_type"]
    return chunks.groupBy("doc_id").agg(F.count_if(kind == "text").alias("n_text"), F.count_if(kind == "table").alias("n_table"))


def is_table(block: Column) -> Column:
    """At least two lines, of which at least 60 % are table lines."""
    lines = F.split(strip(block), "\n", -1)
    return let(lines, lambda x: (F.size(x) >= 2) & (F.size(F.filter(x, lambda y: strip(y).startswith("|"))) >= F.size(x) * 0.6))
