"""The fact table: one row for each doc_id in parquet, by buckets that are replaced one by one."""

from __future__ import annotations

import json
import uuid
import zlib

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from factloom.schemas import DEAL_FIELDS, FAILED, PARTIAL, PURPOSE_FIELDS, SUCCESS

STRUCT = "struct<" + ",".join(f"{f}:string" for f in DEAL_FIELDS) + ">"
PURPOSE = "struct<" + ",".join(f"{f}:string" for f in PURPOSE_FIELDS) + ">"
FACTS = f"doc_id string, company_name string, stock_code string, deal_summary {STRUCT}, acquisition_purpose {PURPOSE}, status string, raw_responses map<string,string>, source_chunks array<string>, created_at timestamp, updated_at timestamp"


def latest(versions: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last version of each key."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*[F.desc(c) for c in order]))
    return versions.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def upsert(facts: DataFrame, new: DataFrame, now: Column, keep_created: bool = True, order: list[str] | None = None) -> DataFrame:
    """new replaces rows of equal doc_id; created_at of a replaced row stays, or becomes now with keep_created=False.

    A key that comes more than once in `new` gives one row, the last by `order` (by default by all columns that can be
    ordered, maps cannot).
    """
    if order is None:
        order = [f.name for f in new.schema.fields if f.name != "doc_id" and "map<" not in f.dataType.simpleString()]
    new = latest(new, "doc_id", order) if order else new.dropDuplicates(["doc_id"])
    made = facts.select("doc_id", F.col("created_at").alias("_made"))
    fresh = new.drop("created_at", "updated_at").join(made, "doc_id", "left")
    created = F.coalesce("_made", now) if keep_created else now
    fresh = fresh.withColumn("created_at", created).withColumn("updated_at", now).drop("_made")
    return facts.join(new.select("doc_id").distinct(), "doc_id", "left_anti").unionByName(fresh, allowMissingColumns=True)


class FactStore:
    """Facts by bucket of their doc_id (crc32 modulo BUCKETS), and manifests that name each bucket's folder.

    A save rewrites the buckets it touches, into a folder of its own, and then adds the next manifest in one step, so no
    reader sees half of it. The folders of the manifest before stay for readers that have begun; older ones go.
    """

    BUCKETS = 64

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(f"{self.path}/manifests"))

    def _path(self, p: str):
        return self._jvm.org.apache.hadoop.fs.Path(p)

    def _versions(self) -> list[int]:
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self.path}/manifests"))]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def _manifest(self, version: int) -> dict[int, str]:
        """Bucket -> the folder that holds it."""
        stream = self._fs.open(self._path(f"{self.path}/manifests/{version}.json"))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return {int(k): v for k, v in json.loads(text).items()}

    def _current(self) -> dict[int, str]:
        found = self._versions()
        return self._manifest(found[-1]) if found else {}

    def _read(self, folders: dict[int, str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], FACTS)
        return self.spark.read.schema(FACTS).parquet(*[f"{self.path}/{f}/bucket={k}" for k, f in sorted(folders.items())])

    def read(self) -> DataFrame:
        return self._read(self._current())

    def save(self, new: DataFrame, now: Column | None = None, keep_created: bool = True) -> None:
        bucket = (F.crc32(F.col("doc_id")) % self.BUCKETS).cast("int")
        now = F.current_timestamp() if now is None else now
        found = self._versions()
        before = self._manifest(found[-1]) if found else {}
        touched = {r[0] for r in new.select(bucket.alias("b")).distinct().collect() if r[0] is not None}  # at most BUCKETS
        if not touched:
            return
        out = upsert(self._read({k: f for k, f in before.items() if k in touched}), new.where("doc_id is not null"), now, keep_created)
        folder = f"data-{uuid.uuid4().hex}"
        out.select(_columns()).withColumn("bucket", bucket).repartition("bucket").write.partitionBy("bucket").parquet(f"{self.path}/{folder}")
        after = before | dict.fromkeys(touched, folder)
        version = (found or [0])[-1] + 1
        draft = self._path(f"{self.path}/manifests/{version}.draft")
        stream = self._fs.create(draft, True)
        stream.write(json.dumps(after).encode())
        stream.close()
        if not self._fs.rename(draft, self._path(f"{self.path}/manifests/{version}.json")):
            raise RuntimeError(f"version {version} of {self.path} was made by another writer")
        for v in found[:-1]:
            self._fs.delete(self._path(f"{self.path}/manifests/{v}.json"), False)
        needed = {*after.values(), *before.values()}
        for s in self._fs.listStatus(self._path(self.path)):
            name = s.getPath().getName()
            if name.startswith("data-") and name not in needed:
                self._fs.delete(s.getPath(), True)

    def get(self, doc_id: str) -> dict | None:
        """One fact, from its bucket alone."""
        k = zlib.crc32(doc_id.encode()) % self.BUCKETS
        rows = self._read({b: f for b, f in self._current().items() if b == k}).where(F.col("doc_id") == doc_id).limit(1).collect()
        return rows[0].asDict(recursive=True) if rows else None

    def list(self) -> DataFrame:
        return listing(self.read())

    def processed(self) -> DataFrame:
        return processed(self.read())


def _columns() -> list[str]:
    return ["doc_id", "company_name", "stock_code", "deal_summary", "acquisition_purpose", "status", "raw_responses", "source_chunks", "created_at", "updated_at"]


def listing(facts: DataFrame) -> DataFrame:
    return facts.select("doc_id", "company_name", "stock_code", "status", "created_at").orderBy("created_at", "doc_id")


def processed(facts: DataFrame) -> DataFrame:
    return facts.where(F.col("status").isin(SUCCESS, PARTIAL)).select("doc_id")


def pending(files: DataFrame, facts: DataFrame, resume: bool = True) -> DataFrame:
    return files.join(processed(facts), "doc_id", "left_anti") if resume else files


def run_stats(outcomes: DataFrame) -> DataFrame:
    """(doc_id, outcome in success, failed, skipped) -> one row; a partial document counts as success."""
    count = lambda *names: F.count_if(F.col("outcome").isin(*names))
    return outcomes.agg(F.count("*").alias("total"), count(SUCCESS, PARTIAL).alias("success"), count(FAILED).alias("failed"), count("skipped").alias("skipped"))
