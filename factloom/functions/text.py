"""Text functions as Column expressions, with the white space and digits of Python's str and re modules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SPACE = r"[\s\x1c-\x1f]"
#: The characters of SPACE, for trimming without a regular expression.
SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACES))


def let(value: Column, use) -> Column:
    """use(value) with value computed once; named columns may be merged into every place that uses them, this is not."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def blank(c: Column) -> Column:
    return strip(c) == ""


def doc_id(path: Column) -> Column:
    """The last path component without its last suffix; names that only start with a dot keep it."""
    name = F.regexp_extract(path, r"([^/]*)/*\z", 1)
    return F.when(name.rlike(r"(?s)\A.+\.[^.]+\z"), F.regexp_replace(name, r"\.[^.]+\z", "")).otherwise(name)


# Words that end a company name, and the letters of one.
STOP_WORDS = "发行|向|资产|关于|重大|收购|吸收|合并|出售"
NAME = "[一-鿿Ａ-Ｚａ-ｚ]"


def stock_code(stem: Column) -> Column:
    return F.regexp_extract(stem, r"(?U)(\d{6})", 1)


def company_name(stem: Column) -> Column:
    first = F.regexp_extract(stem, rf"(?U)\d{{6}}[_\-]?({NAME}+?)(?={STOP_WORDS})", 1)
    other = F.regexp_extract(stem, rf"(?U)\d{{6}}[_\-]?({NAME}{{2,6}})", 1)
    return F.when(first != "", first).otherwise(other)


def format_context(hits: Column) -> Column:
    """hits: array of struct(page, section, text) in order."""
    return F.array_join(F.transform(hits, lambda h: F.concat(F.lit("[page "), h["page"].cast("string"), F.lit(" | section "), h["section"], F.lit("]\n"), h["text"])), "\n\n---\n\n")


def source_id(doc: Column, chunk: Column, page: Column) -> Column:
    return F.concat(doc.cast("string"), F.lit(":chunk"), chunk.cast("string"), F.lit(":p"), page.cast("string"))
