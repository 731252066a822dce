"""Command line: a run over files, --list, --show."""

from __future__ import annotations

import argparse
import json
import logging
import sys
from pathlib import Path

from pyspark.sql import SparkSession

from factloom.config import Settings
from factloom.operators.facts import FactStore
from factloom.plans import pipeline
from factloom.sources.files import PdfParser, TextParser


def setup_logger(name: str = "factloom", level: str = "INFO", file: str | None = None) -> logging.Logger:
    """Console and optional file handlers, added once; the log is the driver's own."""
    log = logging.getLogger(name)
    if not log.handlers:
        if file:
            Path(file).parent.mkdir(parents=True, exist_ok=True)
        log.setLevel(level)
        for h in [logging.StreamHandler(), *([logging.FileHandler(file)] if file else [])]:
            h.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(name)s: %(message)s"))
            log.addHandler(h)
    return log


def main(args: list[str] | None = None, spark: SparkSession | None = None, settings: Settings | None = None) -> int:
    ap = argparse.ArgumentParser(prog="factloom")
    ap.add_argument("input", nargs="?")
    ap.add_argument("--no-resume", action="store_true")
    ap.add_argument("--list", action="store_true")
    ap.add_argument("--show", metavar="DOC_ID")
    ap.add_argument("--text", action="store_true", help="inputs are texts with form feeds between pages")
    ns = ap.parse_args(args)
    settings = settings or Settings.load()
    setup_logger(level=settings.log_level, file=f"{settings.log_dir}/factloom.log" if settings.log_dir else None)
    spark = spark or SparkSession.builder.appName("factloom").getOrCreate()
    store = FactStore(spark, settings.db_path)
    if ns.list:
        rows = store.list().collect()
        for r in rows:
            print(r["doc_id"], r["company_name"], r["stock_code"], r["status"], r["created_at"], sep="\t")
        print(f"{len(rows)} documents" if rows else "no documents yet")
        return 0
    if ns.show:
        found = store.get(ns.show)
        if found is None:
            print(f"{ns.show}: not found", file=sys.stderr)
            return 1
        print(json.dumps(found, ensure_ascii=False, indent=2, default=str))
        return 0
    if not ns.input:
        ap.error("an input is needed")
    print(pipeline.run(spark, ns.input, settings, settings.extractor(), settings.embedder(), TextParser() if ns.text else PdfParser(), not ns.no_resume))
    return 0


if __name__ == "__main__":
    sys.exit(main())
