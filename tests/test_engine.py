"""Behaviour of the document engine on small inputs, and a randomised check of packing against plain Python."""

import json
import random
import re
import sys
import threading
import types
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from factloom import cli, shared
from factloom.config import Settings
from factloom.functions.text import company_name, doc_id, format_context, stock_code
from factloom.operators import chunking, extract, facts, records, sections, vector
from factloom.plans import catalog, pipeline
from factloom.schemas import ABOUT, CHUNK, DEAL_FIELDS, GROUPS, PAGE
from factloom.sources import files, models
from factloom.streaming import ingest


cloudpickle.register_pickle_by_value(sys.modules[__name__])


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], list(values)).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "name, code, company",
    [("000022深赤湾Ａ_重组", "000022", "深赤湾Ａ"), ("000035_中国天楹_报告", "000035", "中国天楹"), ("600000平安关于收购", "600000", "平安"), ("report", "", ""), ("1234567万科", "123456", "万科")],
)
def test_file_names(spark, name, code, company):
    assert one(spark, stock_code(F.col("s")), s=name) == code
    assert one(spark, company_name(F.col("s")), s=name) == company


def test_doc_id(spark):
    rows = spark.createDataFrame([("/a/b.v1.pdf",), ("x",), ("/a/.hidden",)], "p string").select(doc_id(F.col("p")).alias("d")).collect()
    assert [r["d"] for r in rows] == ["b.v1", "x", ".hidden"]


def hits(spark, text):
    return [(h["pos"], h["title"]) for h in one(spark, sections.section_hits(F.col("t")), t=text)]


def test_section_hits(spark):
    assert hits(spark, "intro\n## 第一节 概述\nbody\n一、方案\nmore\n### Heading\nend") == [(6, "第一节 概述"), (21, "一、方案"), (31, "Heading")]
    assert hits(spark, "nothing here") == []
    assert hits(spark, "#### too deep\ntext") == []
    assert hits(spark, "# " + "x" * 31) == []


def test_section_split(spark):
    docs = sections.with_sections(spark.createDataFrame([("before\n## One\na\n## Two\nb",), ("plain",)], "full_text string"))
    got = [[(s["title"], s["text"]) for s in r["sections"]] for r in docs.collect()]
    assert got == [[("", "before"), ("One", "## One\na"), ("Two", "## Two\nb")], [("", "plain")]]


def test_blocks(spark):
    got = one(spark, chunking.blocks(F.col("t")), t="a\n\n| x |\n|---|\n\n| y |\nb")
    assert [(b["type"], b["content"]) for b in got] == [("text", "a"), ("table", "| x |\n|---|"), ("table", "| y |"), ("text", "b")]


def packed(text, size, overlap):
    if len(text) <= size:
        return [text]
    out, cur = [], ""
    for p in (p.strip() for p in re.split(r"\n\s*\n", text)):
        if not p:
            continue
        if len(cur) + len(p) + 2 <= size:
            cur = f"{cur}\n\n{p}" if cur else p
            continue
        out += [cur] if cur else []
        cur = p if len(p) <= size else ""
        if not cur:
            out += [p[k : k + size].strip() for k in range(0, len(p), size - overlap)]
    return out + ([cur] if cur else [])


def test_packing_is_the_plain_algorithm(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice(["ab", "c", "\n", "\n\n", " ", "　", "\n \n", "Ａ", "x" * 30]) for _ in range(rng.randrange(1, 80))) for _ in range(300)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", chunking.pack(F.col("t"), 40, 7).alias("c")).collect()
    assert {r["i"]: r["c"] for r in rows} == {i: packed(t, 40, 7) for i, t in enumerate(texts)}


def test_overlap_must_be_smaller(spark):
    with pytest.raises(ValueError):
        chunking.pack(F.col("t"), 10, 10)


def test_chunk_pages(spark):
    table = "| a | b |\n" + "\n".join(f"| {k} | {k} |" for k in range(50))
    pages = spark.createDataFrame([("d", 1, "## First\nsome text"), ("d", 2, f"## Second\n{table}\nlast")], PAGE)
    got = chunking.chunk_pages(pages, 100, 20).orderBy("chunk_id").collect()
    assert [(r["chunk_id"], r["section"], r["page"], r["metadata"]["chunk_type"]) for r in got] == [(0, "First", 1, "text"), (1, "Second", 2, "text"), (2, "Second", 2, "table"), (3, "Second", 2, "text")]
    assert got[2]["text"] == table
    assert chunking.chunk_pages(spark.createDataFrame([], PAGE)).count() == 0
    counts = chunking.chunk_type_counts(chunking.chunk_pages(pages, 100, 20)).first()
    assert (counts["n_text"], counts["n_table"]) == (3, 1)


def index(spark):
    rows = [("a", 0, "deal overview", 1, "交易概述"), ("a", 1, "price", 2, "定价"), ("b", 0, "deal overview again", 1, "评估")]
    chunks = spark.createDataFrame([(*r, {"chunk_type": "text"}) for r in rows], "doc_id string, chunk_id int, text string, page int, section string, metadata map<string,string>")
    return vector.build(chunks, vector.NgramEmbedder())


def test_search(spark):
    ix, e = index(spark), vector.NgramEmbedder()
    assert vector.search_text(ix, e, "deal overview", top_k=1).first()["chunk_id"] == 0
    assert {r["doc_id"] for r in vector.search_text(ix, e, "price", doc_id="b").collect()} == {"b"}
    assert vector.search_text(ix, e, "price", top_k=1, doc_id="b", compat=True).count() <= 1
    assert [r["section"] for r in vector.search_sections_text(ix, e, "x", ["定", "评"]).orderBy("section").collect()] == ["定价", "评估"]
    assert vector.append(ix, ix.where("doc_id = 'a'")).count() == 3
    assert vector.append(ix, ix.where("doc_id = 'a'"), replace=False).count() == 5


def test_dedup_keeps_the_best_score(spark):
    h = spark.createDataFrame([("d", 1, 0.5, 0), ("d", 1, 0.9, 1), ("d", 2, 0.7, 2)], "doc_id string, chunk_id int, score double, seq int")
    got = vector.dedup_hits(h, [], ["seq"]).orderBy(F.desc("score")).collect()
    assert [(r["chunk_id"], r["score"]) for r in got] == [(1, 0.9), (2, 0.7)]


def test_dedup_takes_known_scores_first_and_nan_for_the_largest(spark):
    h = spark.createDataFrame([("d", 1, None, 0), ("d", 1, 0.5, 1), ("d", 2, 0.7, 0), ("d", 2, float("nan"), 1), ("d", 3, None, 2)], "doc_id string, chunk_id int, score double, seq int")
    assert {r["chunk_id"]: str(r["score"]) for r in vector.dedup_hits(h, [], ["seq"]).collect()} == {1: "0.5", 2: "nan", 3: "None"}


def test_a_search_of_all_chunks_by_blocks_is_the_plain_one(spark, monkeypatch):
    for name, value in (("CHUNKS", 150), ("QUERIES", 20), ("CELLS", 500), ("RUN", 4)):
        monkeypatch.setattr(vector, name, value)
    rng = random.Random(4)
    odd = [None, [], [1.0, None, 1.0], [1.0], [float("nan"), 1.0, 1.0], [float("inf"), 0.0, 1.0], [1e200, -1e200, 1e200], [0.0, 0.0, 0.0]]
    make = lambda: rng.choice(odd) if rng.random() < 0.2 else [rng.choice([-1.0, 0.0, 0.3, 1.0]) for _ in range(3)]
    rows = [(rng.choice([None, "a", "b", "ä"]), n, make()) for n in range(400)] + [(None, None, make()) for _ in range(3)]
    asked = [(n, make()) for n in range(45)]

    def score(q, c):
        if q is None or c is None or len(q) != len(c) or None in q or None in c:
            return None
        total = 0.0
        for x, y in zip(q, c):
            total += x * y
        return total

    def key(r):
        d, n, s = r
        return s is None, s == s, -s if s is not None and s == s else 0, d is None, (d or "").encode(), n is None, n or 0

    want = {q: [(d, n, str(s)) for d, n, s in sorted(((d, n, score(v, c)) for d, n, c in rows), key=key)[:4]] for q, v in asked}
    index = spark.createDataFrame(rows, "doc_id string, chunk_id long, embedding array<double>")
    hits = vector.batch_search(index, spark.createDataFrame(asked, "query_id long, query array<double>"), 4, [], ["query_id"]).orderBy("query_id", "rank").collect()
    got = {}
    for r in hits:
        got.setdefault(r["query_id"], []).append((r["doc_id"], r["chunk_id"], str(r["score"])))
    assert got == want
    assert vector.batch_search(index.limit(0), spark.createDataFrame(asked, "query_id long, query array<double>"), 4, [], ["query_id"]).count() == 0


def test_queries_of_all_chunks_are_not_joined_row_by_row(spark, tmp_path):
    spark.createDataFrame([(n, [float(n), 1.0], n % 10) for n in range(40)], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    found = catalog.vector_multi_query_dedup(spark, str(tmp_path))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "Join" not in plan
    # query 0 scores every chunk 1, so ties go to the smallest labels; query 20 takes the largest
    assert sorted(r["chunk_id"] for r in found.collect()) == [0, 10, 20, 30, 36, 37, 38, 39]


@pytest.mark.parametrize("reply, valid", [('{"target": "x", "other": 1}', True), ("{}", True), ('{"target": 1}', False), ('{"target": null}', False), ("[]", False), ('{"target"', False)])
def test_validation_does_not_coerce(spark, reply, valid):
    assert one(spark, records.is_valid(F.col("r"), DEAL_FIELDS), r=reply) is valid


class Scripted:
    """Replies by the fields asked for; counts calls."""

    def __init__(self, folder, replies):
        self.folder, self.replies = str(folder), replies

    def complete_json(self, system, user):
        with open(f"{self.folder}/calls", "a") as f:
            f.write("j\n")
        fields = user.split("\n", 1)[0].removeprefix("fields:").split(",")
        return json.dumps({f: self.replies.get(f, "") for f in fields}) if len(fields) > 4 else json.dumps({f: f"late {f}" for f in fields})

    def complete_text(self, system, user):
        with open(f"{self.folder}/calls", "a") as f:
            f.write("t\n")
        return user


def run_fields(spark, extractor):
    ix = shared.materialize(index(spark).where("doc_id = 'a'"))
    return {r["field_name"]: r for r in extract.extract_fields(ix, ix.select("doc_id").distinct(), extractor, vector.NgramEmbedder(), attempts=1).collect()}


def test_full_replies_take_one_call_a_group(spark, tmp_path):
    full = {f: "v" for f in [*DEAL_FIELDS, "strategic_purpose", "synergy", "industry_logic", "summary"]}
    got = run_fields(spark, Scripted(tmp_path, full))
    assert {r["status"] for r in got.values()} == {"success"}
    assert (tmp_path / "calls").read_text().split() == ["j", "j"]


def test_a_missing_field_is_filled_in_round_two(spark, tmp_path):
    full = {f: "v" for f in [*DEAL_FIELDS, "strategic_purpose", "synergy", "industry_logic", "summary"]} | {"target_valuation": ""}
    got = run_fields(spark, Scripted(tmp_path, full))
    assert got["deal_summary"]["data"]["target_valuation"] == "late target_valuation"
    assert got["deal_summary"]["data"]["acquirer"] == "v"
    assert sorted((tmp_path / "calls").read_text().split()) == ["j", "j", "j", "t"]


@pytest.mark.parametrize("cut", ["deal_type:", "deal_type: c", "deal_type: cash an", "deal_type: cash and", "deal_type: cash and shares"])
def test_rules_take_whole_values_of_cut_passages(spark, cut):
    texts = [f"so much\nacquirer:\ntarget: B\n{cut}", "target: B\ndeal_type: cash and shares\nacquirer: A", "deal_type: cash and shares, but of another"]
    hits = spark.createDataFrame([([(n, "user", t) for n, t in enumerate(texts)],)], "hits array<struct<page:int,section:string,text:string>>")
    prompt = extract.prompt(F.array(*map(F.lit, DEAL_FIELDS)), format_context(F.col("hits")))
    got = json.loads(extract.RuleExtractor().complete_json("", hits.select(prompt.alias("p")).first()["p"]))
    assert {f: v for f, v in got.items() if v} == {"acquirer": "A", "target": "B", "deal_type": "cash and shares"}


def test_rules_complete_a_cut_value_by_another_page(spark):
    passages = ["much\ndeal_type: c", "some\ndeal_type: stock", "other\ndeal_type: ca", "end\ndeal_type: cash"]
    context = "\n\n---\n\n".join(f"[page {n} | section user]\n{p}" for n, p in enumerate(passages))
    assert json.loads(extract.RuleExtractor().complete_json("", f"fields:deal_type\n{context}")) == {"deal_type": "cash"}


def test_retries(monkeypatch):
    class Bad:
        calls = 0

        def complete_json(self, system, user):
            self.calls += 1
            return "no json"

    waits, bad = [], Bad()
    assert extract.chat_json(bad, "", "", 3, waits.append) is None
    assert (bad.calls, waits) == (3, [1, 2])


def test_fact_store(spark, tmp_path):
    store = facts.FactStore(spark, f"file://{tmp_path}/facts")
    row = lambda i, s: spark.createDataFrame([(i, s)], "doc_id string, status string")
    store.save(row("a", "success"), F.lit("2020-01-01").cast("timestamp"))
    store.save(row("b", "failed"), F.lit("2020-01-02").cast("timestamp"))
    store.save(row("a", "partial"), F.lit("2020-01-03").cast("timestamp"))
    assert store.get("a")["status"] == "partial" and str(store.get("a")["created_at"]).startswith("2020-01-01")
    assert store.get("c") is None
    assert [r["doc_id"] for r in store.list().collect()] == ["a", "b"]
    assert [r["doc_id"] for r in store.processed().collect()] == ["a"]


def test_a_save_rewrites_the_buckets_it_touches(spark, tmp_path):
    store = facts.FactStore(spark, f"file://{tmp_path}/facts")
    row = lambda *ids: spark.createDataFrame([(i, "success") for i in ids], "doc_id string, status string")
    store.save(row(*(f"d{k}" for k in range(200)), None))
    reader = store.read()  # of the version before, which stays readable
    first = store._current()
    store.save(row("d7", "d7"))
    second = store._current()
    assert len(first) == store.BUCKETS - sum(k not in first for k in range(store.BUCKETS)) and sum(first[k] != second[k] for k in first) == 1
    assert reader.count() == 200 and store.read().count() == 200 and store.get("d7")["status"] == "success"
    store.save(row("new"))
    store.save(row())
    assert store.read().count() == 201 and store._versions() == [2, 3]


def test_run_and_resume(spark, tmp_path):
    for name in ("000001甲公司关于", "000002乙"):
        (tmp_path / f"{name}.pdf").write_text("## 第一节 交易概述\nacquirer: A\ntarget: B\n\f## 二\n承诺 text")
    settings = Settings(output_dir=f"{tmp_path}/o", index_dir=f"{tmp_path}/i", upload_dir=f"{tmp_path}/u", log_dir=f"{tmp_path}/l", db_path=f"file://{tmp_path}/f", llm_max_retries=1)
    go = lambda **k: pipeline.run(spark, str(tmp_path), settings, extract.RuleExtractor(), vector.NgramEmbedder(), files.TextParser(), **k)
    assert go() == {"total": 2, "success": 2, "failed": 0, "skipped": 0}
    assert go() == {"total": 2, "success": 0, "failed": 0, "skipped": 2}
    found = facts.FactStore(spark, settings.db_path).get("000001甲公司关于")
    assert (found["deal_summary"]["acquirer"], found["company_name"], found["status"]) == ("A", "甲公司", "partial")
    assert found["source_chunks"]
    with pytest.raises(FileNotFoundError):
        files.list_files(spark, f"{tmp_path}/none")


def test_control_characters_move_nothing(spark):
    text = "\x01 b\n## Head one\nbody\x02\n## Head two\nend"
    r = sections.with_sections(spark.createDataFrame([(text,)], "full_text string")).first()
    assert [(x["title"], x["text"]) for x in r["sections"]] == [("", "b"), ("Head one", "## Head one\nbody"), ("Head two", "## Head two\nend")]
    assert all(r["full_text"][x["start"] :].startswith("## ") for x in r["sections"][1:])
    d = sections.documents(spark.createDataFrame([("d", 1, text), ("d", 2, "x")], PAGE)).first()
    assert d["full_text"][d["bounds"][1]["start"] :].startswith("x")


def windows(text, size, overlap):
    return [text[k : k + size].strip() for k in range(0, len(text), size - overlap)]


@pytest.mark.parametrize("size, overlap", [(10, 3), (10, 9), (7, 0), (1, 0), (50, 49)])
def test_sliding_windows_are_slices(spark, size, overlap):
    rng = random.Random(size)
    texts = ["".join(rng.choice("a b\n　Ａ😀") for _ in range(rng.randrange(0, 70))) for _ in range(60)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", chunking.sliding_windows(F.col("t"), size, overlap).alias("w")).collect()
    assert {r["i"]: r["w"] for r in rows} == {i: windows(t, size, overlap) for i, t in enumerate(texts)}


def test_blocks_are_runs_of_lines(spark):
    rng = random.Random(5)
    texts = ["\n".join(rng.choice(["| a |", " | b", "text", "", "　", "|"]) for _ in range(rng.randrange(1, 30))) for _ in range(100)]

    def runs(text):
        out = []
        for line in text.split("\n"):
            kind = "table" if line.strip().startswith("|") else "text"
            if out and out[-1][0] == kind:
                out[-1][1].append(line)
            else:
                out.append((kind, [line]))
        return [(k, "\n".join(x).strip()) for k, x in out if "\n".join(x).strip()]

    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", chunking.blocks(F.col("t")).alias("b")).collect()
    assert {r["i"]: [(b["type"], b["content"]) for b in r["b"]] for r in rows} == {i: runs(t) for i, t in enumerate(texts)}


def test_trimming_is_that_of_str(spark):
    rows = [(i, f"{chr(i)}a{chr(i)}") for i in [*range(0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x2010), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF, 0x180E]]
    got = spark.createDataFrame(rows, "i int, t string").select("i", sections.strip(F.col("t")).alias("s")).collect()
    assert {r["i"]: r["s"] for r in got} == {i: t.strip() for i, t in rows}


def chunk_rows(spark, *rows):
    return spark.createDataFrame([(d, c, t, 1, "s", {"chunk_type": "text"}) for d, c, t in rows], CHUNK)


def test_dumps_keep_other_documents(spark, tmp_path):
    path = f"file://{tmp_path}/chunks"
    files.dump_chunks(chunk_rows(spark, ("a", 0, "x"), ("b", 0, "y")), path)
    files.dump_chunks(chunk_rows(spark, ("b", 0, "new"), ("c", 0, "z")), path)
    files.dump_chunks(chunk_rows(spark), path)
    got = {(r["doc_id"], r["text"], r["metadata"]["chunk_type"]) for r in files.read_chunks_jsonl(spark, path).collect()}
    assert got == {("a", "x", "text"), ("b", "new", "text"), ("c", "z", "text")}


def test_index_is_saved_and_loaded(spark, tmp_path):
    path, e = f"file://{tmp_path}/index", vector.NgramEmbedder()
    assert files.load_index(spark, path) is None
    assert not files.save_index(vector.build(chunk_rows(spark), e), path)
    assert files.save_index(vector.build(chunk_rows(spark, ("a", 0, "x"), ("b", 0, "y")), e), path)
    assert files.save_index(vector.build(chunk_rows(spark, ("b", 1, "w")), e), path)
    got = files.load_index(spark, path)
    assert {(r["doc_id"], r["chunk_id"]) for r in got.collect()} == {("a", 0), ("b", 1)}
    assert got.select(vector.dimension(got)).first()[0] == 64


def test_jsonl_skips_blank_lines_and_refuses_broken_ones(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"doc_id": "a", "chunk_id": 1, "text": "x"}\n\n{"doc_id": "b"}\n')
    assert [r["doc_id"] for r in files.read_chunks_jsonl(spark, f"{tmp_path}/a.jsonl").collect()] == ["a", "b"]
    (tmp_path / "b.jsonl").write_text('{"doc_id": ')
    with pytest.raises(Exception):
        files.read_chunks_jsonl(spark, f"{tmp_path}/b.jsonl").collect()


def test_an_upsert_gives_a_key_one_row(spark):
    old = spark.createDataFrame([("a", 1)], "doc_id string, v int").withColumn("created_at", F.lit("2020-01-01").cast("timestamp"))
    new = spark.createDataFrame([("a", 2), ("a", 3), ("b", 5), ("b", 4)], "doc_id string, v int")
    got = facts.upsert(old, new, F.lit("2021-01-01").cast("timestamp")).collect()
    assert sorted((r["doc_id"], r["v"], r["created_at"].year) for r in got) == [("a", 3, 2020), ("b", 5, 2021)]
    assert {r["created_at"].year for r in facts.upsert(old, new, F.lit("2021-01-01").cast("timestamp"), keep_created=False).collect()} == {2021}


class Picky(files.TextParser):
    def pages(self, content):
        if b"broken" in content:
            raise ValueError("cannot read")
        return super().pages(content)


def settings_in(folder):
    return Settings(output_dir=f"file://{folder}/o", index_dir=f"file://{folder}/i", log_dir=f"{folder}/l", db_path=f"file://{folder}/f", llm_max_retries=1)


def test_a_broken_file_stops_no_other(spark, tmp_path, caplog):
    inputs = tmp_path / "in"
    (inputs / "below").mkdir(parents=True)
    (inputs / "000001甲公司关于.pdf").write_text("## 第一节 交易概述\nacquirer: A\f\f## 二\nx")
    (inputs / "000002乙.pdf").write_text("broken")
    (inputs / "note.txt").write_text("no input")
    (inputs / "below" / "c.pdf").write_text("no input")
    assert [r["doc_id"] for r in files.list_files(spark, str(inputs)).collect()] == ["000001甲公司关于", "000002乙"]
    assert [r["doc_id"] for r in files.list_files(spark, f"{inputs}/note.txt").collect()] == ["note"]
    pages = files.read_pages(spark, str(inputs), Picky()).collect()
    assert [(r["page_number"], r["text"][:4]) for r in sorted(pages, key=lambda r: r["page_number"])] == [(1, "## 第"), (3, "## 二")]
    with caplog.at_level("INFO", "factloom"):
        got = pipeline.run(spark, str(inputs), settings_in(tmp_path), extract.RuleExtractor(), vector.NgramEmbedder(), Picky())
    assert got == {"total": 2, "success": 1, "failed": 1, "skipped": 0}
    assert "000002乙 cannot be read: ValueError: cannot read" in caplog.text


def test_pages_of_a_document_in_several_micro_batches(spark, tmp_path):
    store, settings = facts.FactStore(spark, f"file://{tmp_path}/f"), settings_in(tmp_path)

    def arrive(*rows):
        spark.createDataFrame(list(rows), PAGE).write.mode("append").parquet(f"{tmp_path}/pages")
        ingest.start(spark, f"{tmp_path}/pages", f"{tmp_path}/c", store, settings, extract.RuleExtractor(), vector.NgramEmbedder()).awaitTermination()

    arrive(("d", 1, "## 第一节 交易概述\nacquirer: A"), ("e", 1, "target: T"))
    assert store.get("d")["deal_summary"]["target"] == ""
    arrive(("d", 2, "## 第二节 交易方案\ntarget: B"))
    got = store.get("d")["deal_summary"]
    assert (got["acquirer"], got["target"], store.get("e")["deal_summary"]["target"]) == ("A", "B", "T")
    index = files.load_index(spark, f"{settings.index_dir}/chunks")
    assert {(r["doc_id"], r["section"]) for r in index.collect()} == {("d", "第一节 交易概述"), ("d", "第二节 交易方案"), ("e", "")}


def test_command_line(spark, tmp_path, capsys):
    (tmp_path / "000001甲公司关于.txt").write_text("acquirer: A")
    settings = settings_in(tmp_path)
    go = lambda *a: cli.main(list(a), spark, settings)
    assert go("--list") == 0 and "no documents yet" in capsys.readouterr().out
    assert go("--show", "x") == 1 and "not found" in capsys.readouterr().err
    assert go(f"{tmp_path}/000001甲公司关于.txt", "--text") == 0 and "'success': 1" in capsys.readouterr().out
    assert go(f"{tmp_path}/000001甲公司关于.txt", "--text") == 0 and "'skipped': 1" in capsys.readouterr().out
    assert go(f"{tmp_path}/000001甲公司关于.txt", "--text", "--no-resume") == 0 and "'success': 1" in capsys.readouterr().out
    assert go("--list") == 0 and "1 documents" in capsys.readouterr().out
    assert go("--show", "000001甲公司关于") == 0 and json.loads(capsys.readouterr().out)["company_name"] == "甲公司"
    with pytest.raises(SystemExit):
        go()


def test_settings_come_from_the_environment():
    s = Settings.load({"LLM_MODEL": "m", "chunk_size": "100", "ENABLE_MULTI_ROUND": "false", "LLM_TEMPERATURE": "0.5", "other": "x"})
    assert (s.llm_model, s.chunk_size, s.enable_multi_round, s.llm_temperature, s.top_k) == ("m", 100, False, 0.5, 8)
    assert isinstance(s.extractor(), extract.RuleExtractor) and isinstance(s.embedder(), vector.NgramEmbedder)
    made = Settings(llm_api_key="k", llm_base_url="http://h/v1", llm_model="m", hyde_max_tokens=9, embedding_model="e")
    assert made.extractor() == models.ChatClient("http://h/v1", "k", "m", (0.1, 4096), (0.7, 9)) and made.embedder() == models.SentenceEmbedder("e")


def test_chat_client():
    seen = []

    class Answer(BaseHTTPRequestHandler):
        def do_POST(self):
            seen.append((self.path, self.headers["Authorization"], json.loads(self.rfile.read(int(self.headers["Content-Length"])))))
            body = json.dumps({"choices": [{"message": {"content": '{"target": "x"}'}}]}).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *a):
            pass

    server = HTTPServer(("127.0.0.1", 0), Answer)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    client = models.ChatClient(f"http://127.0.0.1:{server.server_port}/v1/", "key", "m", (0.1, 100), (0.7, 20), timeout=5)
    assert extract.chat_json(client, "s", "u") == '{"target": "x"}' and extract.chat_text(client, "s", "u")
    server.shutdown()
    server.server_close()
    (path, auth, first), (_, _, second) = seen
    assert (path, auth) == ("/v1/chat/completions", "Bearer key")
    assert (first["temperature"], first["max_tokens"], first["response_format"]) == (0.1, 100, {"type": "json_object"})
    assert (second["temperature"], second["max_tokens"], second["messages"][1]) == (0.7, 20, {"role": "user", "content": "u"})
    assert extract.chat_text(client, "s", "u") == ""  # the server is gone


def test_pdf_pages_and_sentence_vectors_by_their_libraries(monkeypatch):
    """With stand-ins for libraries that are not installed here."""
    import numpy as np

    monkeypatch.setitem(sys.modules, "pymupdf", types.SimpleNamespace(open=lambda stream, filetype: stream))
    monkeypatch.setitem(sys.modules, "pymupdf4llm", types.SimpleNamespace(to_markdown=lambda doc, page_chunks: [{"metadata": {"page": 4}, "text": "x"}, {"text": "y"}]))
    assert files.PdfParser().pages(b"pdf") == [(4, "x"), (2, "y")]
    loads = []

    class Model:
        def __init__(self, name):
            loads.append(name)

        def encode(self, texts, batch_size, normalize_embeddings):
            assert normalize_embeddings
            return np.ones((len(texts), 3))

    monkeypatch.setitem(sys.modules, "sentence_transformers", types.SimpleNamespace(SentenceTransformer=Model))
    e = models.SentenceEmbedder("small")
    assert e.embed(["a", "b"]).shape == (2, 3) and e.embed(["c"]).dtype == np.float32 and loads == ["small"]


def test_a_cluster_needs_a_shared_folder(spark):
    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    far = lambda **conf: types.SimpleNamespace(conf=Conf({k.replace("_", "."): v for k, v in conf.items()}))
    with pytest.raises(RuntimeError):
        shared.shared_dir(far(spark_master="spark://host:7077"))
    assert shared.shared_dir(far(spark_master="spark://host:7077", **{"spark_checkpoint_dir": "hdfs://x/y/"})) == "hdfs://x/y"


class Silent:
    """Fills nothing but what is asked for by section, i.e. in the third round; counts calls."""

    def __init__(self, folder):
        self.folder = str(folder)

    def complete_json(self, system, user):
        with open(f"{self.folder}/calls", "a") as f:
            f.write("j\n")
        fields = user.split("\n", 1)[0].removeprefix("fields:").split(",")
        assert all(f in user.split("\n")[1] for f in fields if f in ABOUT)
        return json.dumps({f: "by section" if len(fields) <= 4 and "估" in user.split("\n", 2)[2] else "" for f in fields})

    def complete_text(self, system, user):
        return ""


def test_round_three_asks_by_section(spark, tmp_path):
    rows = [("a", 0, "price of it", 1, "评估"), ("a", 1, "other things", 2, "其他")]
    ix = shared.materialize(vector.build(spark.createDataFrame([(*r, {"chunk_type": "text"}) for r in rows], CHUNK), vector.NgramEmbedder()))
    got = {r["field_name"]: r for r in extract.extract_fields(ix, ix.select("doc_id").distinct(), Silent(tmp_path), vector.NgramEmbedder(), attempts=1).collect()}
    data = got["deal_summary"]["data"]
    assert data["target_valuation"] == data["valuation_method"] == "by section" and data["acquirer"] == ""
    assert {r["status"] for r in got.values()} == {"partial"}
    # one call a group, none of round two as no passage was written, one for each sub-group with a fitting section
    assert len((tmp_path / "calls").read_text().split()) == len(GROUPS) + 1


def test_a_single_round(spark, tmp_path):
    ix = shared.materialize(index(spark).where("doc_id = 'a'"))
    got = {r["field_name"]: r for r in extract.extract_fields(ix, ix.select("doc_id").distinct(), Scripted(tmp_path, {"target": "x"}), vector.NgramEmbedder(), multi_round=False, attempts=1).collect()}
    assert {r["status"] for r in got.values()} == {"success"} and got["deal_summary"]["data"]["target"] == "x"
    assert (tmp_path / "calls").read_text().split() == ["j", "j"]


def test_a_failing_model_fails_the_group(spark):
    class Down:
        def complete_json(self, system, user):
            raise OSError("down")

        complete_text = complete_json

    got = run_fields(spark, Down())
    assert {(r["status"], r["error"]) for r in got.values()} == {("failed", "no reply")}
