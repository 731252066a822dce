"""Full-text assembly, section detection and section split, in higher-order functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from factloom.functions.text import SPACE, let, strip

# Headings are numbered parts, numbered points, and Markdown headings.
PATTERNS = [
    rf"^#{{0,3}}{SPACE}*第[一二三四五六七八九十百\d]+[节章]{SPACE}+.+",
    rf"^#{{0,3}}{SPACE}*[一二三四五六七八九十]+[、．.]{SPACE}*.+",
    rf"^#{{1,3}}{SPACE}+.{{2,30}}{SPACE}*$",
]
_HITS = "struct<at:int,hits:array<struct<pos:int,title:string>>>"


def _clean(text: Column) -> Column:
    """Without the two control characters that mark headings below; taken out first, so that all positions agree."""
    return F.translate(text, "\x01\x02", "")


def documents(pages: DataFrame) -> DataFrame:
    """pages(doc_id, page_number, text) -> (doc_id, full_text, bounds): each page's text and a blank line, in page order."""
    ordered = F.array_sort(F.collect_list(F.struct("page_number", _clean(F.col("text")).alias("text"))))
    docs = pages.groupBy("doc_id").agg(ordered.alias("pages"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,page:int>>").alias("bounds"))

    def step(acc: Column, p: Column) -> Column:
        end = (acc["at"] + F.length(p["text"]) + 2).cast("int")
        return F.struct(end.alias("at"), F.concat(acc["bounds"], F.array(F.struct(acc["at"].alias("start"), end.alias("end"), p["page_number"].alias("page")))).alias("bounds"))

    bounds = F.aggregate("pages", start, step)["bounds"]
    return docs.select("doc_id", F.concat(F.array_join(F.transform("pages", lambda p: p["text"]), "\n\n"), F.lit("\n\n")).alias("full_text"), bounds.alias("bounds"))


def _found(text: Column, pattern: str) -> Column:
    """Leftmost matches with positions: sentinels around each match, cut apart, lengths summed."""
    marked = F.split(F.regexp_replace(text, f"(?Umd){pattern}", "\x01$0\x02"), "\x01", -1)

    def step(acc: Column, p: Column) -> Column:
        hit = F.struct(acc["at"].alias("pos"), strip(F.regexp_replace(strip(F.substring_index(p, "\x02", 1)), r"\A#+", "")).alias("title"))
        return F.struct((acc["at"] + F.length(p) - 1).alias("at"), F.concat(acc["hits"], F.array(hit)).alias("hits")).cast(_HITS)

    def walk(parts: Column) -> Column:
        start = F.struct(F.length(F.element_at(parts, 1)).alias("at"), F.array().cast("array<struct<pos:int,title:string>>").alias("hits")).cast(_HITS)
        return F.aggregate(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), start, step)["hits"]

    return let(marked, walk)


def section_hits(text: Column) -> Column:
    """array<struct<pos,title>>: titles of 2 to 50 characters; of hits less than 5 apart the first stays."""
    every = let(_clean(text), lambda t: F.concat(*[_found(t, p) for p in PATTERNS]))
    fit = F.array_sort(F.filter(every, lambda h: F.length(h["title"]).between(2, 50)))
    none = F.array().cast("array<struct<pos:int,title:string>>")
    return F.aggregate(fit, none, lambda acc, h: F.when((F.size(acc) > 0) & (h["pos"] - F.try_element_at(acc, F.lit(-1))["pos"] < 5), acc).otherwise(F.concat(acc, F.array(h))))


def with_sections(docs: DataFrame) -> DataFrame:
    """docs(full_text, ...) with sections: array<struct<title,text,start>>; full_text loses U+0001 and U+0002."""
    docs = docs.withColumn("full_text", _clean(F.col("full_text")))
    docs = docs.withColumn("_hits", section_hits(F.col("full_text")))
    n = F.size("_hits")

    def section(h: Column, i: Column) -> Column:
        end = F.coalesce(F.get("_hits", i + 1)["pos"], F.length("full_text"))
        return F.struct(h["title"].alias("title"), strip(F.substring(F.col("full_text"), h["pos"] + 1, end - h["pos"])).alias("text"), h["pos"].alias("start"))

    first = F.get("_hits", F.lit(0))["pos"]
    before = F.struct(F.lit("").alias("title"), strip(F.substring(F.col("full_text"), F.lit(1), first)).alias("text"), F.lit(0).alias("start"))
    whole = F.array(F.struct(F.lit("").alias("title"), F.col("full_text").alias("text"), F.lit(0).alias("start")))
    split = F.filter(F.concat(F.array(before), F.transform("_hits", section)), lambda s: s["text"] != "")
    return docs.withColumn("sections", F.when(n == 0, whole).otherwise(split)).drop("_hits")
