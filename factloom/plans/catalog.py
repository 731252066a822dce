"""Queries of the engine's own operators on the driver's tables, with their SQL.

The tables hold no paged reports, so inputs are derived: conversations are paged documents with a heading for each turn,
labels of embeddings play documents, events play fact versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from factloom.functions.text import company_name, doc_id, format_context, source_id, stock_code
from factloom.operators import chunking, extract, facts, records, sections, vector
from factloom.schemas import DEAL_FIELDS, FAILED, GROUPS, PARTIAL, SUCCESS
from factloom.shared import materialize

QUERIES: dict = {}
ORACLES: dict = {}
SECTIONS = ["overview", "pricing", "valuation", "commitment", "purpose"]


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _index(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _table(spark, sf_dir, "embeddings")
    section = F.element_at(F.array(*map(F.lit, SECTIONS)), F.col("label") % 5 + 1)
    return v.select(F.col("label").alias("doc_id"), F.col("vec_id").alias("chunk_id"), section.alias("section"), "embedding")


def _vector_of(spark: SparkSession, sf_dir: str, vec_id: int) -> list[float]:
    return list(_table(spark, sf_dir, "embeddings").where(F.col("vec_id") == vec_id).first()["embedding"])


_SCORED = """WITH q AS (SELECT list_transform(embedding, lambda x: x::DOUBLE) AS q FROM embeddings WHERE vec_id = 0),
    s AS (SELECT label AS doc_id, vec_id AS chunk_id, ['overview','pricing','valuation','commitment','purpose'][label % 5 + 1] AS section,
          list_inner_product(list_transform(embedding, lambda x: x::DOUBLE), q) AS score FROM embeddings, q)"""
_OUT = "doc_id, chunk_id, section, round(score, 6) + 0.0 AS score"
_ORDER = "ORDER BY score DESC, doc_id, chunk_id"


def _hits(df: DataFrame) -> DataFrame:
    return df.select("doc_id", "chunk_id", "section", (F.round("score", 6) + 0.0).alias("score"))


@query(f"{_SCORED} SELECT {_OUT} FROM (SELECT * FROM s {_ORDER} LIMIT 8)")
def vector_topk(spark, sf_dir):
    return _hits(vector.search(_index(spark, sf_dir), _vector_of(spark, sf_dir, 0), 8))


@query(f"{_SCORED} SELECT {_OUT} FROM (SELECT * FROM (SELECT * FROM s {_ORDER} LIMIT 24) WHERE doc_id = 3 {_ORDER} LIMIT 8)")
def vector_topk_docfilter_compat(spark, sf_dir):
    return _hits(vector.search(_index(spark, sf_dir), _vector_of(spark, sf_dir, 0), 8, doc_id=3, compat=True))


@query(f"{_SCORED} SELECT {_OUT} FROM (SELECT * FROM s WHERE doc_id = 3 {_ORDER} LIMIT 8)")
def vector_topk_docfilter_exact(spark, sf_dir):
    return _hits(vector.search(_index(spark, sf_dir), _vector_of(spark, sf_dir, 0), 8, doc_id=3))


@query(f"{_SCORED} SELECT {_OUT} FROM (SELECT * FROM s WHERE contains(section, 'pri') OR contains(section, 'valu') {_ORDER} LIMIT 8)")
def vector_topk_section(spark, sf_dir):
    return _hits(vector.search_sections(_index(spark, sf_dir), _vector_of(spark, sf_dir, 0), ["pri", "valu"], 8))


@query("""WITH q AS (SELECT vec_id AS query_id, list_transform(embedding, lambda x: x::DOUBLE) AS q FROM embeddings WHERE vec_id % 20 = 0),
    s AS (SELECT query_id, label AS doc_id, vec_id AS chunk_id, list_inner_product(list_transform(embedding, lambda x: x::DOUBLE), q) AS score FROM embeddings, q),
    r AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id, chunk_id) <= 4),
    d AS (SELECT doc_id, chunk_id, max(score) AS score FROM r GROUP BY ALL)
    SELECT doc_id, chunk_id, round(score, 6) + 0.0 AS score FROM d""")
def vector_multi_query_dedup(spark, sf_dir):
    """The four best of every query, joined, each chunk once with its best score."""
    asked = _table(spark, sf_dir, "embeddings").where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    hits = vector.batch_search(_index(spark, sf_dir), asked, 4, [], ["query_id"])
    best = vector.dedup_hits(hits.select("doc_id", "chunk_id", "section", "score", "query_id", "rank"), [], ["query_id", "rank"])
    return best.select("doc_id", "chunk_id", (F.round("score", 6) + 0.0).alias("score"))


@query("""WITH a AS (SELECT label AS doc_id, vec_id AS chunk_id FROM embeddings WHERE label < 6), b AS (SELECT label AS doc_id, vec_id + 1000000 AS chunk_id FROM embeddings WHERE label >= 4)
    SELECT * FROM a WHERE doc_id NOT IN (SELECT doc_id FROM b) UNION ALL SELECT * FROM b""")
def index_append(spark, sf_dir):
    """Chunks of documents that come again replace the former ones."""
    ix = _index(spark, sf_dir)
    new = ix.where("doc_id >= 4").withColumn("chunk_id", F.col("chunk_id") + 1000000)
    return vector.append(ix.where("doc_id < 6"), new).select("doc_id", "chunk_id")


@query("SELECT DISTINCT label AS doc_id FROM embeddings")
def indexed_docs(spark, sf_dir):
    return vector.indexed_docs(_index(spark, sf_dir))


@query("SELECT vec_id, len(embedding) AS dim FROM embeddings")
def embedding_dimension(spark, sf_dir):
    v = _table(spark, sf_dir, "embeddings")
    return v.select("vec_id", vector.dimension(v).alias("dim"))


def _embed_sql(source: str, key: str) -> str:
    """CTEs `vectors(key, v)` of a relation (key, text), by the arithmetic of NgramEmbedder."""
    return f"""chars AS (SELECT {key}, list_transform(string_split('^' || text || '$', ''), lambda c: ord(c)::BIGINT) AS c FROM {source}),
    grams AS (SELECT {key}, unnest(list_transform(range(1, greatest(len(c) - 1, 2)), lambda i: ((c[i] * 31 + c[i + 1]) * 31 + coalesce(c[i + 2], 0)) * 2654435761 % 4294967296)) AS h FROM chars),
    dims AS (SELECT {key}, (h // 65536) % 64 AS d, sum(CASE WHEN (h // 4194304) % 2 = 1 THEN 1 ELSE -1 END)::DOUBLE AS x FROM grams GROUP BY ALL),
    norms AS (SELECT {key}, sqrt(sum(x * x)) AS n FROM dims GROUP BY ALL),
    vectors AS (SELECT {key}, list_transform(range(0, 64), lambda i: coalesce(m[i], 0.0)::FLOAT) AS v FROM
        (SELECT {key}, map(list(d), list((CASE WHEN n > 0 THEN x / n ELSE 0.0 END))) AS m FROM dims JOIN norms USING ({key}) GROUP BY {key}))"""


_ROUNDED = "array_to_string(list_transform(v, lambda x: round(x::DOUBLE * 10000)::BIGINT), ',')"


def _rounded(vector_column: str):
    return F.array_join(F.transform(vector_column, lambda x: F.round(x.cast("double") * 10000).cast("long")), ",")


@query(f"WITH {_embed_sql('documents', 'doc_id')} SELECT doc_id, {_ROUNDED} AS embedding FROM vectors")
def embed_texts(spark, sf_dir):
    return vector.embed(_table(spark, sf_dir, "documents").select("doc_id", "text"), vector.NgramEmbedder()).select("doc_id", _rounded("embedding").alias("embedding"))


def _items(spark, sf_dir):
    b = _table(spark, sf_dir, "benchmark")
    section = F.element_at(F.array(*map(F.lit, SECTIONS)), (F.col("item_id") % 5 + 1).cast("int"))
    return vector.build(b.select((F.col("item_id") % 7).alias("doc_id"), F.col("item_id").alias("chunk_id"), section.alias("section"), "text"), vector.NgramEmbedder())


_ITEMS_SQL = f"""WITH src AS (SELECT item_id, text FROM benchmark UNION ALL SELECT -1, 'transaction price and payment'), {_embed_sql('src', 'item_id')},
    s AS (SELECT x.item_id % 7 AS doc_id, x.item_id AS chunk_id, ['overview','pricing','valuation','commitment','purpose'][x.item_id % 5 + 1] AS section,
          list_inner_product(list_transform(x.v, lambda a: a::DOUBLE), list_transform(q.v, lambda a: a::DOUBLE)) AS score FROM vectors x, vectors q WHERE x.item_id >= 0 AND q.item_id = -1)"""


@query(f"{_ITEMS_SQL} SELECT {_OUT} FROM (SELECT * FROM s {_ORDER} LIMIT 8)")
def text_search(spark, sf_dir):
    return _hits(vector.search_text(_items(spark, sf_dir), vector.NgramEmbedder(), "transaction price and payment"))


@query(f"{_ITEMS_SQL} SELECT {_OUT} FROM (SELECT * FROM s WHERE doc_id = 2 AND (contains(section, 'pri') OR contains(section, 'pur')) {_ORDER} LIMIT 5)")
def text_search_section(spark, sf_dir):
    return _hits(vector.search_sections_text(_items(spark, sf_dir), vector.NgramEmbedder(), "transaction price and payment", ["pri", "pur"], top_k=5, doc_id=2))


def _paragraphs(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("text"))


_TRIM = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"


@query(f"""SELECT doc_id, i AS pos, {_TRIM.format("substring(text, i * 448 + 1, 512)")} AS piece FROM
    (SELECT doc_id, text, unnest(range(0, (length(text) + 447) // 448)) AS i FROM documents)""")
def sliding_windows(spark, sf_dir):
    d = _table(spark, sf_dir, "documents").select("doc_id", F.posexplode(chunking.sliding_windows(F.col("text"), 512, 64)).alias("pos", "piece"))
    return d.select("doc_id", F.col("pos").cast("long").alias("pos"), "piece")


_PACK_SQL = rf"""
    WITH RECURSIVE src AS (SELECT doc_id, replace(text, chr(10), chr(10) || chr(10)) AS t FROM documents),
    p AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(t, '\n\s*\n'), lambda x: {_TRIM.format('x')}), lambda x: x <> '') AS ps, t FROM src WHERE length(t) > 512),
    r AS (SELECT doc_id, ps, 0 AS k, '' AS cur, []::VARCHAR[] AS out FROM p
      UNION ALL SELECT doc_id, ps, k + 1,
        CASE WHEN length(cur) + length(ps[k+1]) + 2 <= 512 THEN (CASE WHEN cur = '' THEN ps[k+1] ELSE cur || chr(10) || chr(10) || ps[k+1] END)
             WHEN length(ps[k+1]) <= 512 THEN ps[k+1] ELSE '' END,
        CASE WHEN length(cur) + length(ps[k+1]) + 2 <= 512 THEN out
             WHEN length(ps[k+1]) <= 512 THEN (CASE WHEN cur = '' THEN out ELSE list_append(out, cur) END)
             ELSE list_concat(CASE WHEN cur = '' THEN out ELSE list_append(out, cur) END,
                  list_transform(range(0, (length(ps[k+1]) + 447) // 448), lambda i: {_TRIM.format('substring(ps[k+1], i * 448 + 1, 512)')})) END
      FROM r WHERE k < len(ps)),
    done AS (SELECT doc_id, CASE WHEN cur = '' THEN out ELSE list_append(out, cur) END AS c FROM r WHERE k = len(ps) UNION ALL SELECT doc_id, [t] FROM src WHERE length(t) <= 512)
    SELECT doc_id, generate_subscripts(c, 1) - 1 AS chunk_id, unnest(c) AS text FROM done"""


@query(_PACK_SQL)
def paragraph_pack(spark, sf_dir):
    out = _paragraphs(spark, sf_dir).select("doc_id", F.posexplode(chunking.pack(F.col("text"), 512, 64)).alias("chunk_id", "text"))
    return out.select("doc_id", F.col("chunk_id").cast("long").alias("chunk_id"), "text")


def _pages(spark, sf_dir):
    c = _table(spark, sf_dir, "conversations")
    return c.select(F.col("conv_id").cast("string").alias("doc_id"), (F.col("turn") + 1).cast("int").alias("page_number"), F.concat(F.lit("## "), "role", F.lit("\n"), "text").alias("text"))


# one heading a page, at the page's start: sections are pages, whatever the heading's words
_PAGES_SQL = """WITH page AS (SELECT conv_id::VARCHAR AS doc_id, turn + 1 AS page, role, '## ' || role || chr(10) || text AS t FROM conversations),
    pg AS (SELECT *, coalesce(sum(length(t) + 2) OVER (PARTITION BY doc_id ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM page)"""


@query(rf"""{_PAGES_SQL} SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY start) - 1 AS pos, role AS title, {_TRIM.format('t')} AS text, start FROM pg""")
def section_split(spark, sf_dir):
    docs = sections.with_sections(sections.documents(_pages(spark, sf_dir)))
    out = docs.select("doc_id", F.posexplode("sections").alias("pos", "s"))
    return out.select("doc_id", F.col("pos").cast("long").alias("pos"), F.col("s.title").alias("title"), F.col("s.text").alias("text"), F.col("s.start").cast("long").alias("start"))


@query(f"{_PAGES_SQL} SELECT doc_id, string_agg(t || chr(10) || chr(10), '' ORDER BY page) AS full_text, count(*) AS n_pages, max(start + length(t) + 2) AS last_end FROM pg GROUP BY doc_id")
def full_text(spark, sf_dir):
    return sections.documents(_pages(spark, sf_dir)).select("doc_id", "full_text", F.size("bounds").cast("long").alias("n_pages"), F.element_at("bounds", -1)["end"].cast("long").alias("last_end"))


_CHUNK_SQL = rf"""
    {_PAGES_SQL.replace('WITH page', 'WITH RECURSIVE page')},
    sec AS (SELECT doc_id, page, role, {_TRIM.format('t')} AS t FROM pg),
    p AS (SELECT doc_id, page, role, t, list_filter(list_transform(regexp_split_to_array(t, '\n\s*\n'), lambda x: {_TRIM.format('x')}), lambda x: x <> '') AS ps FROM sec),
    r AS (SELECT doc_id, page, role, ps, 0 AS k, '' AS cur, []::VARCHAR[] AS out FROM p WHERE length(t) > 512
      UNION ALL SELECT doc_id, page, role, ps, k + 1,
        CASE WHEN length(cur) + length(ps[k+1]) + 2 <= 512 THEN (CASE WHEN cur = '' THEN ps[k+1] ELSE cur || chr(10) || chr(10) || ps[k+1] END)
             WHEN length(ps[k+1]) <= 512 THEN ps[k+1] ELSE '' END,
        CASE WHEN length(cur) + length(ps[k+1]) + 2 <= 512 THEN out
             WHEN length(ps[k+1]) <= 512 THEN (CASE WHEN cur = '' THEN out ELSE list_append(out, cur) END)
             ELSE list_concat(CASE WHEN cur = '' THEN out ELSE list_append(out, cur) END,
                  list_transform(range(0, (length(ps[k+1]) + 447) // 448), lambda i: {_TRIM.format('substring(ps[k+1], i * 448 + 1, 512)')})) END
      FROM r WHERE k < len(ps)),
    done AS (SELECT doc_id, page, role, CASE WHEN cur = '' THEN out ELSE list_append(out, cur) END AS c FROM r WHERE k = len(ps)
      UNION ALL SELECT doc_id, page, role, [t] FROM sec WHERE length(t) <= 512),
    flat AS (SELECT doc_id, page, role, generate_subscripts(c, 1) AS i, unnest(c) AS text FROM done)
    SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY page, i) - 1 AS chunk_id, text, page, role AS section, 'text' AS chunk_type FROM flat WHERE trim(text) <> ''"""


@query(_CHUNK_SQL)
def chunk_pages(spark, sf_dir):
    c = chunking.chunk_pages(_pages(spark, sf_dir))
    return c.select("doc_id", F.col("chunk_id").cast("long").alias("chunk_id"), "text", F.col("page").cast("long").alias("page"), "section", F.col("metadata")["chunk_type"].alias("chunk_type"))


def _order_texts(spark, sf_dir):
    li = _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), "l_linenumber", F.concat(F.lit("| "), F.col("l_partkey").cast("string"), F.lit(" | "), F.col("l_returnflag"), F.lit(" |")).alias("line"))
    table = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "line"))), lambda x: x["line"]), "\n")
    return li.groupBy("doc_id").agg(F.concat(F.lit("Lines of the order\n"), table, F.lit("\n\nEnd of "), F.col("doc_id").cast("string"), F.lit("\n| total |\n")).alias("text"))


_ORDER_SQL = """WITH o AS (SELECT l_orderkey AS doc_id, string_agg('| ' || l_partkey || ' | ' || l_returnflag || ' |', chr(10) ORDER BY l_linenumber, '| ' || l_partkey || ' | ' || l_returnflag || ' |') AS t FROM lineitem GROUP BY l_orderkey),
    b AS (SELECT doc_id, 0 AS pos, 'text' AS type, 'Lines of the order' AS content FROM o UNION ALL SELECT doc_id, 1, 'table', t FROM o
          UNION ALL SELECT doc_id, 2, 'text', 'End of ' || doc_id FROM o UNION ALL SELECT doc_id, 3, 'table', '| total |' FROM o)"""


@query(f"{_ORDER_SQL} SELECT doc_id, pos::BIGINT AS pos, type, content FROM b")
def table_blocks(spark, sf_dir):
    out = _order_texts(spark, sf_dir).select("doc_id", F.posexplode(chunking.blocks(F.col("text"))).alias("pos", "b"))
    return out.select("doc_id", F.col("pos").cast("long").alias("pos"), F.col("b.type").alias("type"), F.col("b.content").alias("content"))


@query("SELECT l_orderkey::VARCHAR AS doc_id, 2 AS n_text, 2 AS n_table FROM lineitem GROUP BY l_orderkey")
def chunk_type_counts(spark, sf_dir):
    pages = _order_texts(spark, sf_dir).select(F.col("doc_id").cast("string").alias("doc_id"), F.lit(1).alias("page_number"), "text")
    return chunking.chunk_type_counts(chunking.chunk_pages(pages))


@query("SELECT l_orderkey AS doc_id, count(*) >= 2 AS is_table FROM lineitem GROUP BY l_orderkey")
def table_ratio(spark, sf_dir):
    li = _table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("doc_id")).agg(F.array_join(F.collect_list(F.concat(F.lit("| "), F.col("l_partkey").cast("string"))), "\n").alias("t"))
    return li.select("doc_id", chunking.is_table(F.col("t")).alias("is_table"))


@query(f"""{_PAGES_SQL}, probe AS (SELECT DISTINCT doc_id, unnest([0, 100, 700, 1500, 1000000]) AS position FROM pg)
    SELECT probe.doc_id, position, coalesce(min(CASE WHEN position < start + length(t) + 2 THEN page END), max(page)) AS page FROM probe JOIN pg USING (doc_id) GROUP BY ALL""")
def page_for_position(spark, sf_dir):
    docs = sections.documents(_pages(spark, sf_dir)).select("doc_id", "bounds", F.explode(F.array(*[F.lit(x) for x in (0, 100, 700, 1500, 1000000)])).alias("position"))
    return docs.select("doc_id", "position", chunking.page_at(F.col("bounds"), F.col("position")).cast("long").alias("page"))


_NAMES = ["深赤湾Ａ发行股份", "中国天楹_报告", "平安银行关于收购", "万科", "招商蛇口吸收合并", "无"]


@query("""WITH f AS (SELECT c_custkey, '/in/' || lpad(c_custkey::VARCHAR, 6, '0') || (CASE WHEN c_custkey % 2 = 0 THEN '_' ELSE '' END) || ['深赤湾Ａ发行股份','中国天楹_报告','平安银行关于收购','万科','招商蛇口吸收合并','无'][c_nationkey % 6 + 1] || '.v1.pdf' AS path FROM customer),
    s AS (SELECT c_custkey, regexp_replace(regexp_extract(path, '([^/]*)$', 1), '\\.[^.]+$', '') AS doc_id FROM f),
    n AS (SELECT *, regexp_extract(doc_id, '\\d{6}[_-]?([一-鿿Ａ-Ｚａ-ｚ]+?)(?:发行|向|资产|关于|重大|收购|吸收|合并|出售)', 1) AS a FROM s)
    SELECT c_custkey, doc_id, regexp_extract(doc_id, '(\\d{6})', 1) AS stock_code, CASE WHEN a <> '' THEN a ELSE regexp_extract(doc_id, '\\d{6}[_-]?([一-鿿Ａ-Ｚａ-ｚ]{2,6})', 1) END AS company_name FROM n""".replace("\\\\", "\\"))
def filename_metadata(spark, sf_dir):
    c = _table(spark, sf_dir, "customer")
    name = F.element_at(F.array(*map(F.lit, _NAMES)), F.col("c_nationkey") % 6 + 1)
    path = F.concat(F.lit("/in/"), F.lpad(F.col("c_custkey").cast("string"), 6, "0"), F.when(F.col("c_custkey") % 2 == 0, "_").otherwise(""), name, F.lit(".v1.pdf"))
    c = c.select("c_custkey", doc_id(path).alias("doc_id"))
    return c.select("c_custkey", "doc_id", stock_code(F.col("doc_id")).alias("stock_code"), company_name(F.col("doc_id")).alias("company_name"))


def _versions(spark, sf_dir):
    status = F.when(F.col("event_type").isin("click", "view"), FAILED).when(F.col("event_type") == "purchase", SUCCESS).otherwise(PARTIAL)
    return _table(spark, sf_dir, "events").select(F.col("user_id").alias("doc_id"), "ts", "event_id", status.alias("status"))


_FACTS_SQL = """WITH v AS (SELECT user_id AS doc_id, ts, event_id, CASE WHEN event_type IN ('click', 'view') THEN 'failed' WHEN event_type = 'purchase' THEN 'success' ELSE 'partial' END AS status FROM events),
    facts AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY ts DESC, event_id DESC) = 1)"""


def _facts(spark, sf_dir):
    return facts.latest(_versions(spark, sf_dir), "doc_id", ["ts", "event_id"])


@query(f"""{_FACTS_SQL}, old AS (SELECT * FROM v WHERE event_id % 2 = 0 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY ts DESC, event_id DESC) = 1),
    new AS (SELECT * FROM v WHERE event_id % 2 = 1 AND doc_id % 3 > 0 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY ts DESC, event_id DESC) = 1)
    SELECT doc_id, event_id, status, epoch_us(ts) AS created, epoch_us(ts) AS updated FROM old WHERE doc_id NOT IN (SELECT doc_id FROM new)
    UNION ALL SELECT new.doc_id, new.event_id, new.status, coalesce(epoch_us(old.ts), 1600000000000000), 1600000000000000 FROM new LEFT JOIN old USING (doc_id)""")
def fact_upsert(spark, sf_dir):
    """Versions with even event ids are stored; all those with odd ones of some keys come in one batch."""
    v = _versions(spark, sf_dir)
    old = facts.latest(v.where("event_id % 2 = 0"), "doc_id", ["ts", "event_id"]).withColumns({"created_at": F.col("ts").cast("timestamp"), "updated_at": F.col("ts").cast("timestamp")})
    out = facts.upsert(old, v.where("event_id % 2 = 1 and doc_id % 3 > 0"), F.timestamp_seconds(F.lit(1600000000)), order=["ts", "event_id"])
    return out.select("doc_id", "event_id", "status", F.unix_micros("created_at").alias("created"), F.unix_micros("updated_at").alias("updated"))


@query(f"{_FACTS_SQL} SELECT doc_id, '' AS company_name, lpad(doc_id::VARCHAR, 6, '0') AS stock_code, status, epoch_us(ts) AS created_at FROM facts")
def fact_list(spark, sf_dir):
    f = _facts(spark, sf_dir).select("doc_id", F.lit("").alias("company_name"), F.lpad(F.col("doc_id").cast("string"), 6, "0").alias("stock_code"), "status", F.col("ts").alias("created_at"))
    return facts.listing(f).withColumn("created_at", F.unix_micros(F.col("created_at").cast("timestamp")))


@query(f"{_FACTS_SQL} SELECT doc_id, event_id, status FROM facts WHERE doc_id = 7")
def fact_lookup(spark, sf_dir):
    return _facts(spark, sf_dir).where("doc_id = 7").select("doc_id", "event_id", "status")


@query(f"{_FACTS_SQL} SELECT doc_id FROM facts WHERE status IN ('success', 'partial')")
def processed_ids(spark, sf_dir):
    return facts.processed(_facts(spark, sf_dir))


@query(f"{_FACTS_SQL} SELECT c_custkey AS doc_id FROM customer WHERE c_custkey NOT IN (SELECT doc_id FROM facts WHERE status IN ('success', 'partial'))")
def resume_pending(spark, sf_dir):
    return facts.pending(_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("doc_id")), _facts(spark, sf_dir))


@query(f"{_FACTS_SQL} SELECT count(*) AS total, count(*) FILTER (status IN ('success', 'partial')) AS success, count(*) FILTER (status = 'failed') AS failed, 0 AS skipped FROM facts")
def run_stats(spark, sf_dir):
    return facts.run_stats(_facts(spark, sf_dir).withColumnRenamed("status", "outcome"))


_KINDS = ["props", "text", "broken", "null", "list", "extra"]


def _replies(spark, sf_dir):
    """Event props (numbers), and made replies: strings, cut off, null value, list, unknown key."""
    e = _table(spark, sf_dir, "events").select("event_id", "event_type", (F.col("event_id") % 6).alias("kind"), "props")
    made = F.when(F.col("kind") == 0, F.replace("props", F.lit('"k"'), F.lit('"target"'))).when(F.col("kind") == 1, F.to_json(F.struct(F.col("event_type").alias("acquirer")))).when(F.col("kind") == 2, F.lit('{"acquirer": "x"')).when(F.col("kind") == 3, F.lit('{"acquirer": null}')).when(F.col("kind") == 4, F.lit('["x"]')).otherwise(F.lit('{"other": 5, "target": "y"}'))
    return e.select("event_id", "kind", made.alias("reply"))


@query("SELECT event_id, event_id % 6 IN (1, 5) AS valid, CASE event_id % 6 WHEN 1 THEN event_type WHEN 5 THEN '' END AS acquirer, CASE event_id % 6 WHEN 1 THEN '' WHEN 5 THEN 'y' END AS target FROM events")
def validate_json(spark, sf_dir):
    r = _replies(spark, sf_dir).withColumn("data", records.to_record(F.col("reply"), DEAL_FIELDS))
    return r.select("event_id", records.is_valid(F.col("reply"), DEAL_FIELDS).alias("valid"), F.col("data")["acquirer"].alias("acquirer"), F.col("data")["target"].alias("target"))


def _blanked(spark, sf_dir):
    d = _table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    pick = lambda c, n: F.when(F.col("doc_id") % n == 0, "").otherwise(F.col(c))
    return d.select("doc_id", F.create_map(F.lit("acquirer"), pick("lang", 2), F.lit("target"), pick("source", 3), F.lit("acquirer_quote"), F.lit("")).alias("old"), F.create_map(F.lit("acquirer"), F.upper("source"), F.lit("target"), pick("lang", 5), F.lit("acquirer_quote"), F.lit("q")).alias("new"))


@query("SELECT doc_id, (CASE WHEN doc_id % 2 = 0 THEN 'acquirer,' ELSE '' END) || (CASE WHEN doc_id % 3 = 0 THEN 'target,' ELSE '' END) || 'deal_type' AS missing, (CASE WHEN true THEN 'parties' END) AS groups FROM documents")
def missing_fields(spark, sf_dir):
    m = records.missing(F.col("old"), ["acquirer", "target", "deal_type"])
    return _blanked(spark, sf_dir).select("doc_id", F.array_join(m, ",").alias("missing"), F.array_join(records.affected("deal_summary", m), ",").alias("groups"))


@query("""SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN upper(source) ELSE lang END AS acquirer, CASE WHEN doc_id % 3 <> 0 THEN source WHEN doc_id % 5 = 0 THEN '' ELSE lang END AS target,
    CASE WHEN doc_id % 2 = 0 THEN 'q' ELSE '' END AS acquirer_quote FROM documents""")
def merge_fill_only(spark, sf_dir):
    fields = ["acquirer", "acquirer_quote", "target"]
    d = _blanked(spark, sf_dir).withColumn("m", records.merge(F.col("old"), F.col("new"), records.missing(F.col("old"), ["acquirer", "target"]), fields))
    return d.select("doc_id", *[F.col("m")[f].alias(f) for f in fields])


@query("""SELECT conv_id::VARCHAR AS doc_id, CASE WHEN bool_and(role = 'system') THEN 'failed' WHEN bool_and(role = 'user') THEN 'success' ELSE 'partial' END AS status FROM conversations GROUP BY conv_id""")
def status_rollup(spark, sf_dir):
    c = _table(spark, sf_dir, "conversations")
    status = F.when(F.col("role") == "user", SUCCESS).when(F.col("role") == "system", FAILED).otherwise(PARTIAL)
    return records.roll_up(c.select(F.col("conv_id").cast("string").alias("doc_id"), status.alias("status"), F.when(F.col("role") == "system", "").otherwise("reply").alias("raw_response")))


@query("""SELECT conv_id, string_agg('[page ' || (turn + 1) || ' | section ' || role || ']' || chr(10) || text, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY turn) AS context,
    string_agg(conv_id || ':chunk' || turn || ':p' || (turn + 1), ',' ORDER BY turn) AS sources FROM conversations GROUP BY conv_id""")
def format_hits(spark, sf_dir):
    c = _table(spark, sf_dir, "conversations").select("conv_id", "turn", (F.col("turn") + 1).alias("page"), F.col("role").alias("section"), "text")
    g = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "page", "section", "text"))).alias("hits"))
    return g.select("conv_id", format_context(F.col("hits")).alias("context"), F.array_join(F.transform("hits", lambda h: source_id(F.col("conv_id"), h["turn"], h["page"])), ",").alias("sources"))


_FLAT_SQL = _CHUNK_SQL.split("SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY page, i) - 1 AS chunk_id")[0].rstrip()
_STATED = "CASE WHEN turn = 0 THEN chr(10) || 'acquirer: A' || chr(10) || 'target: B' || chr(10) ELSE chr(10) || 'deal_type: cash' || chr(10) END"


def _rounds_sql() -> str:
    """Round one's contexts by group and round two's by sub-group; what a context states is found. No section fits round three."""
    subs = [(g, x.name, n, x.query, x.hyde_query) for n, (g, x) in enumerate((g, x) for g, of in GROUPS.items() for x in of)]
    asked = " UNION ALL ".join(f"SELECT 'q{n}', '{q}' UNION ALL SELECT 'h{n}', '{h}'" for _, _, n, q, h in subs)
    names = ", ".join(f"('{g}', '{sub}', {n})" for g, sub, n, _, _ in subs)
    held = lambda field: f"bool_or(regexp_matches(text, '(^|\\n)\\s*{field}\\s*[:：]\\s*.'))"
    return f"""{_FLAT_SQL.replace("|| text AS t FROM conversations", f"|| text || {_STATED} AS t FROM conversations")},
    chunks AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY page, i) - 1 AS chunk_id, text FROM flat WHERE trim(text) <> ''),
    subs(g, sub, n) AS (VALUES {names}),
    src(k, text) AS (SELECT doc_id || '/' || chunk_id, text FROM chunks UNION ALL {asked}),
    {_embed_sql('src', 'k')},
    wide AS (SELECT k, list_transform(v, lambda a: a::DOUBLE) AS v FROM vectors),
    scored AS (SELECT c.doc_id, c.chunk_id, c.text, g, sub, n, list_inner_product(x.v, q.v) AS score, list_inner_product(x.v, h.v) AS late
        FROM chunks c JOIN wide x ON x.k = c.doc_id || '/' || c.chunk_id CROSS JOIN subs JOIN wide q ON q.k = 'q' || n JOIN wide h ON h.k = 'h' || n),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id, n ORDER BY score DESC, chunk_id) AS rank, row_number() OVER (PARTITION BY doc_id, n ORDER BY late DESC, chunk_id) AS late_rank FROM scored),
    best AS (SELECT doc_id, g, chunk_id, any_value(text) AS text, max(score) AS score, min(n * 1000 + rank) AS first_seen FROM ranked WHERE rank <= 4 GROUP BY ALL),
    one AS (SELECT * FROM best QUALIFY row_number() OVER (PARTITION BY doc_id, g ORDER BY score DESC, first_seen, chunk_id) <= 8),
    early AS (SELECT doc_id, count(*) AS n, {held('acquirer').replace('text', "CASE WHEN g = 'deal_summary' THEN text ELSE '' END")} AS a, {held('target').replace('text', "CASE WHEN g = 'deal_summary' THEN text ELSE '' END")} AS t, {held('deal_type').replace('text', "CASE WHEN g = 'deal_summary' THEN text ELSE '' END")} AS d FROM one GROUP BY doc_id),
    two AS (SELECT doc_id, least(count(*), 8) AS each, {held('acquirer').replace('text', "CASE WHEN late_rank <= 8 THEN text ELSE '' END")} AS a, {held('deal_type').replace('text', "CASE WHEN late_rank <= 8 THEN text ELSE '' END")} AS d FROM ranked WHERE sub = 'parties' GROUP BY doc_id)
    SELECT doc_id, 'partial' AS status, CASE WHEN early.a OR two.a THEN 'A' ELSE '' END AS acquirer, CASE WHEN early.d OR two.d THEN 'cash' ELSE '' END AS deal_type,
        early.n + two.each * ({len(subs) - 1} + CASE WHEN early.a AND early.t AND early.d THEN 0 ELSE 1 END) AS n_sources FROM early JOIN two USING (doc_id)"""


@query(_rounds_sql())
def extract_three_rounds(spark, sf_dir):
    """Conversations as documents: the offline extractor over chunked, embedded pages; the first turns state some fields."""
    stated = F.when(F.col("page_number") == 1, F.lit("\nacquirer: A\ntarget: B\n")).otherwise(F.lit("\ndeal_type: cash\n"))
    pages = _pages(spark, sf_dir).withColumn("text", F.concat("text", stated))
    embedder = vector.NgramEmbedder()
    index = materialize(vector.build(chunking.chunk_pages(pages), embedder))
    docs = pages.select("doc_id").distinct().withColumns({"company_name": F.lit(""), "stock_code": F.lit("")})
    results = extract.extract_fields(index, docs, extract.RuleExtractor(), embedder)
    f = extract.to_facts(results, docs)
    return f.select("doc_id", "status", F.col("deal_summary.acquirer").alias("acquirer"), F.col("deal_summary.deal_type").alias("deal_type"), F.size("source_chunks").alias("n_sources"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunk conversations as paged documents, embed them, and take each document's best chunks for its first turn."""
    embedder = vector.NgramEmbedder()
    index = vector.build(chunking.chunk_pages(_pages(spark, sf_dir)), embedder)
    queries = vector.embed(_pages(spark, sf_dir).where("page_number = 1").select("doc_id", "text"), embedder, "text", "query").select("doc_id", "query")
    hits = vector.batch_search(index, queries, 8, ["doc_id"], ["doc_id"])
    return hits.select("doc_id", "chunk_id", "page", "section", "rank", (F.round("score", 6) + 0.0).alias("score"))


_FLAGSHIP_SQL = f"""{_FLAT_SQL},
    chunks AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY page, i) - 1 AS chunk_id, text, page, role AS section FROM flat WHERE trim(text) <> ''),
    src AS (SELECT doc_id || '/' || chunk_id AS k, text FROM chunks UNION ALL SELECT doc_id || '/q', t FROM pg WHERE page = 1),
    {_embed_sql('src', 'k')},
    s AS (SELECT c.doc_id, c.chunk_id, c.page, c.section, list_inner_product(list_transform(x.v, lambda a: a::DOUBLE), list_transform(q.v, lambda a: a::DOUBLE)) AS score
          FROM chunks c JOIN vectors x ON x.k = c.doc_id || '/' || c.chunk_id JOIN vectors q ON q.k = c.doc_id || '/q')
    SELECT doc_id, chunk_id, page, section, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, chunk_id) AS rank, round(score, 6) + 0.0 AS score FROM s QUALIFY rank <= 8"""


@query(_FLAGSHIP_SQL)
def flagship_grouped_topk(spark, sf_dir):
    return flagship(spark, sf_dir).withColumns({"chunk_id": F.col("chunk_id").cast("long"), "page": F.col("page").cast("long"), "rank": F.col("rank").cast("long")})


_HEADED = ["第一节 交易概述", "第十二章　定价方式", "二、标的估值", "十一．业绩承诺", "### 交易目的"]


@query("""WITH p AS (SELECT c_custkey, c_custkey % 5 AS a, c_custkey % 3 AS b, ['第一节 交易概述','第十二章　定价方式','二、标的估值','十一．业绩承诺','### 交易目的'] AS h FROM customer),
    t AS (SELECT c_custkey, 'x' || repeat('y', (c_custkey % 4)::INT) || chr(10) || h[a + 1] || chr(10) || 'body ' || c_custkey || chr(10) || h[b + 3] || chr(10) || 'end' AS text, h[a + 1] AS one, h[b + 3] AS two FROM p),
    pos AS (SELECT *, 2 + c_custkey % 4 AS p1, 2 + c_custkey % 4 + length(one) + 1 + length('body ' || c_custkey) + 1 AS p2 FROM t)
    SELECT c_custkey, p1::BIGINT AS first_at, ltrim(replace(one, '#', '')) AS first_title, p2::BIGINT AS second_at, ltrim(replace(two, '#', '')) AS second_title, 2::BIGINT AS n FROM pos""")
def chinese_headings(spark, sf_dir):
    """Headings of all three patterns between lines of text."""
    every = F.array(*map(F.lit, _HEADED))
    c = _table(spark, sf_dir, "customer").select("c_custkey", F.element_at(every, (F.col("c_custkey") % 5 + 1).cast("int")).alias("one"), F.element_at(every, (F.col("c_custkey") % 3 + 3).cast("int")).alias("two"))
    text = F.concat(F.lit("x"), F.repeat(F.lit("y"), (F.col("c_custkey") % 4).cast("int")), F.lit("\n"), "one", F.lit("\nbody "), F.col("c_custkey").cast("string"), F.lit("\n"), "two", F.lit("\nend"))
    h = c.select("c_custkey", sections.section_hits(text).alias("h"))
    at = lambda i, f: F.get("h", F.lit(i))[f]
    return h.select("c_custkey", at(0, "pos").cast("long").alias("first_at"), at(0, "title").alias("first_title"), at(1, "pos").cast("long").alias("second_at"), at(1, "title").alias("second_title"), F.size("h").cast("long").alias("n"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 2 END AS n, '一、' || chr(65 + (c_custkey % 26)::INT) AS first_title FROM customer""")
def heading_dedup(spark, sf_dir):
    """Two headings that start less than five characters apart are one, the first."""
    letter = F.char(F.col("c_custkey") % 26 + 65)
    gap = F.when(F.col("c_custkey") % 2 == 0, "").otherwise("filler\n")
    h = _table(spark, sf_dir, "customer").select("c_custkey", sections.section_hits(F.concat(F.lit("一、"), letter, F.lit("\n"), gap, F.lit("二、B\n"))).alias("h"))
    return h.select("c_custkey", F.size("h").alias("n"), F.get("h", F.lit(0))["title"].alias("first_title"))


@query("""SELECT c_custkey, 1 + (c_custkey % 3) AS n_chunks, 1 + CASE WHEN c_custkey % 3 = 2 THEN 1 ELSE 0 END AS last_page FROM customer""")
def chunk_offset_pages(spark, sf_dir):
    """A page's end lies between two blocks of one section, whose pages are found by the estimated offsets."""
    table = F.concat(F.lit("| "), F.repeat(F.lit("t"), 400), F.lit(" |\n"))
    extra = F.col("c_custkey") % 3
    one = F.concat(F.lit("## Part\nbefore\n"), F.when(extra >= 1, table).otherwise(""))
    c = _table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("doc_id"), extra.alias("extra"), one.alias("one"))
    first = c.select("doc_id", F.lit(1).alias("page_number"), F.col("one").alias("text"))
    second = c.where("extra = 2").select("doc_id", F.lit(2).alias("page_number"), F.lit("after the table").alias("text"))
    chunks = chunking.chunk_pages(first.unionByName(second))
    return chunks.groupBy(F.col("doc_id").cast("long").alias("c_custkey")).agg(F.count("*").alias("n_chunks"), F.max("page").alias("last_page"))
