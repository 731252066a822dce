import sys

import __spark_entry__ as entry


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_other_queries_stay_where_a_library_is_missing(monkeypatch):
    for name in [n for n in sys.modules if n == "corpus_pipeline" or n.startswith("factloom.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "zstandard", None)
    monkeypatch.delattr("factloom.llm", raising=False)
    found = entry.queries()
    assert "vector_topk" in found and not any(n.startswith("op") or n == "pipeline" for n in found)
    assert set(entry.oracle_sql()) <= set(found)
