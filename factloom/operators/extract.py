"""Three-round extraction as stages over all documents: retrieve, ask, validate, find what is missing, ask again.

Every stage with language-model calls is written out (lineage cut by a table in the shared folder), so no later plan calls
the model a second time. Rounds 2 and 3 take only (document, sub-group) pairs that still miss a field.
"""

from __future__ import annotations

import json
import re
import time
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from factloom.functions.text import format_context, source_id
from factloom.operators import records, vector
from factloom.schemas import ABOUT, FAILED, GROUPS, MONOLITHIC, PARTIAL, RECORDS, SUCCESS
from factloom.shared import materialize


class Extractor(Protocol):
    def complete_json(self, system: str, user: str) -> str:
        """JSON text; may raise."""

    def complete_text(self, system: str, user: str) -> str: ...


#: What format_context puts before a passage.
HEAD = re.compile(r"(?m)(?:\n\n---\n\n)?^\[page -?\d+ \| section .*\]\n")


def stated(field: str, passages: list[str]) -> str:
    """The value in the first passage that has one.

    If it ends that passage it may be cut: the passage that overlaps it most goes on; without one, the first value elsewhere
    that begins with it and is longer is taken.
    """
    line = re.compile(rf"(?m)^\s*{field}[^\S\n]*[:：][^\S\n]*(\S.*)$")
    found = [(p, m, m.group(1).strip()) for p in passages if (m := line.search(p))]
    if not found:
        return ""
    passage, at, value = found[0]
    while at.end() == len(passage):
        others = [x for x in found if x[0] != passage]
        more = max((x for x in others if passage.endswith(x[0][: x[1].start(1) + len(value)])), key=lambda x: x[1].start(1), default=None)
        more = more or next((x for x in others if len(x[2]) > len(value) and x[2].startswith(value)), None)
        if more is None or more[2] == value:
            break
        passage, at, value = more
    return value


class RuleExtractor:
    """Deterministic and offline: a field's value is what follows `field:` on a line of a passage.

    A passage may end inside that line; other passages then tell the whole value, where they were found too.
    """

    def complete_json(self, system: str, user: str) -> str:
        named, context = user.split("\n", 1)
        passages = [p.rstrip() for p in HEAD.split(context)]
        return json.dumps({f.strip(): stated(f.strip(), passages) for f in named.removeprefix("fields:").split(",")}, ensure_ascii=False)

    def complete_text(self, system: str, user: str) -> str:
        return user


def chat_json(extractor: Extractor, system: str, user: str, attempts: int = 3, sleep=time.sleep) -> str | None:
    """JSON text that parses, after at most `attempts` calls with 1 s, 2 s, ... between them; else None."""
    for k in range(attempts):
        try:
            reply = extractor.complete_json(system, user)
            json.loads(reply)
            return reply
        except Exception:
            if k + 1 < attempts:
                sleep(2**k)
    return None


def chat_text(extractor: Extractor, system: str, user: str) -> str:
    try:
        return extractor.complete_text(system, user) or ""
    except Exception:
        return ""


SYSTEM = "Take values from the given passages only. Leave a field empty if they do not state it. Quotes are verbatim. Reply with one JSON object of the listed fields."
HYDE = "Write a passage of 100 to 200 characters, as a transaction report would put it, with concrete details, that answers the question."


def prompt(fields: Column, context: Column) -> Column:
    """The fields by name, a line that says what each of them means, and the passages."""
    about = F.create_map(*[F.lit(x) for f, text in ABOUT.items() for x in (f, text)])
    named = F.filter(fields, lambda f: about[f].isNotNull())
    told = F.array_join(F.transform(named, lambda f: F.concat(f, F.lit(" = "), about[f])), "; ")
    return F.concat(F.lit("fields:"), F.array_join(fields, ","), F.lit("\nmeaning of the fields: "), told, F.lit("\n"), context)


def ask(df: DataFrame, extractor: Extractor, text: bool = False, attempts: int = 3) -> DataFrame:
    """Adds `reply` for column `prompt`; rows with an empty prompt are not sent."""

    def run(batches):
        for pdf in batches:
            if text:
                replies = [chat_text(extractor, HYDE, p) if p else "" for p in pdf["prompt"]]
            else:
                replies = [chat_json(extractor, SYSTEM, p, attempts) if p else None for p in pdf["prompt"]]
            yield pdf.assign(reply=pd.Series(replies, dtype=object, index=pdf.index))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return materialize(df.mapInPandas(run, f"{fields}, reply string"))


def _queries(spark: SparkSession, rows: list[tuple], embedder) -> DataFrame:
    """(group, sub, text) of the fixed configuration, embedded once on the driver."""
    return F.broadcast(spark.createDataFrame([(g, s, vector.embed_text(embedder, q)) for g, s, q in rows], "field_name string, sub string, query array<float>"))


def _contexts(hits: DataFrame, by: list[str], k: int) -> DataFrame:
    """Ordered contexts and source ids of the first k hits of each `by`."""
    one = F.struct((-F.col("score")).alias("s"), "first_seen", "chunk_id", "page", "section", "text")
    top = hits.groupBy(*by).agg(F.slice(F.array_sort(F.collect_list(one)), 1, k).alias("hits"))
    return top.select(*by, format_context(F.col("hits")).alias("context"), F.transform("hits", lambda h: source_id(F.col("doc_id"), h["chunk_id"], h["page"])).alias("sources"))


def extract_fields(index: DataFrame, docs: DataFrame, extractor: Extractor, embedder, top_k: int = 8, multi_round: bool = True, attempts: int = 3) -> DataFrame:
    """index: chunks with embeddings; docs(doc_id) -> (doc_id, field_name, status, data, raw_response, source_chunks, error)."""
    spark = index.sparkSession
    subs = {(g, s.name): s for g, groups in GROUPS.items() for s in groups}
    if multi_round:
        rows = [(g, s.name, s.query) for (g, _), s in subs.items()]
        per = {g: max(4, top_k // len(GROUPS[g])) for g in GROUPS}
    else:
        rows, per = [(g, "", q) for g, q in MONOLITHIC.items()], {g: top_k for g in GROUPS}
    wanted = docs.select("doc_id").distinct().crossJoin(_queries(spark, rows, embedder))  # a fixed handful of queries a document
    hits = vector.batch_search(index, wanted, max(per.values()), ["doc_id"], ["doc_id", "field_name", "sub"])
    limit = F.create_map(*[F.lit(x) for g, k in per.items() for x in (g, k)])
    order = F.create_map(*[F.lit(x) for n, (g, s, _) in enumerate(rows) for x in (f"{g}/{s}", n)])
    hits = hits.where(F.col("rank") <= limit[F.col("field_name")]).withColumn("group_at", order[F.concat_ws("/", "field_name", "sub")])
    hits = vector.dedup_hits(hits.select("doc_id", "field_name", "chunk_id", "text", "page", "section", "score", "group_at", "rank"), ["doc_id", "field_name"], ["group_at", "rank"])
    context = _contexts(hits, ["doc_id", "field_name"], top_k)
    lists = F.create_map(*[x for g in GROUPS for x in (F.lit(g), F.array(*map(F.lit, RECORDS[g])))])
    every = docs.select("doc_id").distinct().crossJoin(F.broadcast(spark.createDataFrame([(g,) for g in GROUPS], "field_name string")))
    first = every.join(context, ["doc_id", "field_name"], "left").withColumn("prompt", prompt(lists[F.col("field_name")], F.col("context"))).drop("context")
    state = ask(first, extractor, attempts=attempts)

    def by_group(of):
        out = None
        for g in GROUPS:
            out = F.when(F.col("field_name") == g, of(g)) if out is None else out.when(F.col("field_name") == g, of(g))
        return out

    state = state.withColumn("data", by_group(lambda g: records.to_record(F.col("reply"), RECORDS[g])))
    error = F.when(F.col("sources").isNull(), "no passages").when(F.col("reply").isNull(), "no reply").when(F.col("data").isNull(), "invalid reply").otherwise("")
    state = state.select("doc_id", "field_name", F.coalesce("reply", F.lit("")).alias("raw_response"), F.coalesce("sources", F.array().cast("array<string>")).alias("source_chunks"), "data", error.alias("error"))
    if not multi_round:
        status = F.when(F.col("error") == "", SUCCESS).otherwise(FAILED)
        return state.select("doc_id", "field_name", status.alias("status"), "data", "raw_response", "source_chunks", "error")
    gap = by_group(lambda g: records.missing(F.col("data"), records.targets(g)))
    state = materialize(state.withColumn("missing", F.when(F.col("data").isNotNull(), gap).otherwise(F.array().cast("array<string>"))))
    names = spark.createDataFrame([(g, s.name, n, list(s.target_fields), list(s.section_keywords), s.hyde_query, vector.embed_text(embedder, s.query)) for n, ((g, _), s) in enumerate(subs.items())], "field_name string, sub string, at int, targets array<string>, keywords array<string>, hyde string, query array<float>")
    for hyde in (True, False):
        need = state.where(F.size("missing") > 0).join(F.broadcast(names), "field_name").where(F.arrays_overlap("targets", "missing"))
        need = need.select("doc_id", "field_name", "sub", "at", "keywords", "hyde", "query", F.array_intersect("targets", "missing").alias("fields"))
        if need.limit(1).count() == 0:
            break
        if hyde:
            passages = ask(need.drop("query").withColumn("prompt", F.col("hyde")), extractor, text=True).where("reply <> ''")
            asked = vector.embed(passages, embedder, "reply", "query").drop("prompt", "reply")
            found = vector.batch_search(index, asked.select("doc_id", "field_name", "sub", "query"), top_k, ["doc_id"], ["doc_id", "field_name", "sub"])
        else:
            asked = need.select("doc_id", "field_name", "sub", "query", "keywords")
            fit = index.join(asked, "doc_id").where(F.exists("keywords", lambda w: F.contains("section", w))).withColumn("score", vector.dot(F.col("embedding"), F.col("query")))
            rank = F.row_number().over(Window.partitionBy("doc_id", "field_name", "sub").orderBy(F.desc("score"), "chunk_id"))
            found = fit.drop("embedding", "query", "keywords").withColumn("rank", rank).where(F.col("rank") <= top_k)
        context = _contexts(found.withColumn("first_seen", F.struct("rank")), ["doc_id", "field_name", "sub"], top_k)
        turn = need.drop("query", "keywords", "hyde").join(context, ["doc_id", "field_name", "sub"])
        turn = ask(turn.withColumn("prompt", prompt(F.col("fields"), F.col("context"))).drop("context"), extractor, attempts=attempts)
        turn = turn.withColumn("got", by_group(lambda g: records.to_record(F.col("reply"), RECORDS[g])))
        merged = turn.groupBy("doc_id", "field_name").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("at", "sources"))), lambda x: x["sources"])).alias("more"), F.collect_list(F.when(F.col("got").isNotNull(), F.struct("fields", "got"))).alias("turns"))
        state = state.join(merged, ["doc_id", "field_name"], "left")
        # sub-groups have disjoint targets, so a round's replies make one map: each field from the turn that asked for it
        pick = lambda f: F.get(F.filter("turns", lambda t: F.array_contains(t["fields"], f.removesuffix("_quote"))), F.lit(0))["got"][f]
        fresh = by_group(lambda g: F.create_map(*[x for f in RECORDS[g] for x in (F.lit(f), F.coalesce(pick(f), F.lit("")))]))
        state = state.withColumn("fresh", F.when(F.col("turns").isNotNull(), fresh))
        data = by_group(lambda g: records.merge(F.col("data"), F.col("fresh"), F.col("missing"), RECORDS[g]))
        state = state.withColumn("data", F.when(F.col("fresh").isNotNull(), data).otherwise(F.col("data")))
        state = state.withColumn("source_chunks", F.concat("source_chunks", F.coalesce("more", F.array().cast("array<string>"))))
        left = F.when(F.col("data").isNotNull(), gap).otherwise(F.array().cast("array<string>"))
        state = materialize(state.withColumn("missing", left).drop("more", "turns", "fresh"))
    status = F.when(F.col("error") != "", FAILED).when(F.size("missing") == 0, SUCCESS).otherwise(PARTIAL)
    return state.select("doc_id", "field_name", status.alias("status"), "data", "raw_response", "source_chunks", "error")


def to_facts(results: DataFrame, docs: DataFrame) -> DataFrame:
    """Group results and docs(doc_id, company_name, stock_code) -> fact rows with provenance."""
    of = lambda g: F.first(F.when(F.col("field_name") == g, F.col("data")), ignorenulls=True).alias(g)
    wide = results.groupBy("doc_id").agg(*[of(g) for g in GROUPS], F.map_from_entries(F.array_sort(F.collect_list(F.struct("field_name", "raw_response")))).alias("raw_responses"), F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("field_name", "source_chunks"))), lambda x: x["source_chunks"])).alias("source_chunks"))
    out = docs.select("doc_id", "company_name", "stock_code").join(wide, "doc_id").join(records.roll_up(results), "doc_id")
    return out.select("doc_id", "company_name", "stock_code", *[records.as_struct(F.col(g), g).alias(g) for g in GROUPS], "status", "raw_responses", "source_chunks")
