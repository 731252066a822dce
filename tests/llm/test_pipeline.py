"""The corpus pipeline, stage by stage, against the operators' meaning in plain Python."""

from collections import Counter

import corpus_pipeline as cp
from factloom.llm.common import materialize

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, ids = docs.columns, [{r["doc_id"] for r in docs.select("doc_id").collect()}]
    for k, (name, stage) in enumerate(cp.STAGES[:-1]):
        docs = materialize(stage(spark, docs, SF))
        assert docs.columns == columns, name
        ids.append({r["doc_id"] for r in docs.select("doc_id").collect()})
        assert ids[-1] <= ids[-2]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good, bad = ([i for i in labels if labels[i] == q] for q in (1, 0))
    assert sum(i in ids[1] for i in good) >= 0.97 * len(good) and sum(i in ids[1] for i in bad) <= 0.1 * len(bad)
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    kept = [texts[i] for i in ids[2]]
    assert len(set(kept)) == len(kept) and {texts[i] for i in ids[1]} >= set(kept)
    bench = [" ".join(r["text"].split()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert not any(b in " ".join(texts[i].split()) for i in ids[3] for b in bench)
    assert ids[4] == ids[3]  # mixing repeats, but drops nothing
    mixed = Counter(r["doc_id"] for r in docs.select("doc_id").collect())
    out = cp.STAGES[-1][1](spark, docs, SF).collect()
    assert Counter(r["doc_id"] for r in out) == mixed
    rows = sorted((r["start"], r["n_tokens"], r["doc_id"]) for r in out)
    assert [r[2] for r in rows] == sorted(r[2] for r in rows)
    assert all(a[0] + a[1] == b[0] for a, b in zip(rows, rows[1:]))


def test_token_files_are_in_the_order_of_the_mix(spark, tmp_path, monkeypatch):
    """Every prefix of the files holds each source by its weight, to a block of the mix and the one begun."""
    n = {"a": 3000, "b": 1000, "c": 500}
    names = [s for s, k in n.items() for _ in range(k)]
    rows = [(i, f"word {i}", s) for i, s in enumerate(names)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(cp, "STAGES", cp.STAGES[-2:])
    out = sorted((r["start"], r["doc_id"]) for r in cp.run(spark, str(tmp_path)).collect())
    total, given = sum(k**0.9 for k in n.values()), Counter()
    for t, (_, i) in enumerate(out, 1):
        given[names[i]] += 1
        assert all(abs(given[s] - k**0.9 / total * t) < 96 for s, k in n.items())


ODD = [
    (None, "nobody has this id", "fr", None, 0, "a", 1.0, 2),
    (None, "nobody has this id", "fr", None, 0, "a", 1.0, 2),
    (1, None, None, None, None, None, None, None),
    (2, "", "en", "web", 0, "b", 0.5, 3),
    (3, " \t\n", "en", "web", 3, "b", 0.5, 3),
    (4, "the same row of words that comes again and again", "en", "web", 5, "c", 0.1, 4),
    (4, "the same row of words that comes again and again", "en", "web", 5, "c", 0.1, 4),
    (5, " ".join(f"w{k % 977}" for k in range(120_000)), "en", "books", 9, "d", 0.2, 5),
]
WIDE = "doc_id long, text string, lang string, source string, n_chars long, slot string, score double, place int"


def test_stages_take_odd_rows_and_clashing_names(spark):
    """Rows that a stage does not drop come back whole; each stage's rule for odd rows is in its docstring."""
    docs = spark.createDataFrame(ODD, WIDE)
    stages = dict(cp.STAGES)
    rows = Counter(map(tuple, docs.collect()))
    kept = {name: Counter(map(tuple, stages[name](spark, docs, SF).select(docs.columns).collect())) for name, _ in cp.STAGES[:4]}
    assert all(stages[name](spark, docs, SF).columns == docs.columns for name, _ in cp.STAGES[:4])
    assert not kept["quality classifier"] - rows
    once = Counter({r: 1 if r[0] is not None else n for r, n in rows.items()})
    assert kept["MinHash near-dedup"] == once
    assert kept["benchmark decontamination"] == rows
    mixed = kept["mixing sources to target weights"]
    assert set(mixed) == set(rows) and all(mixed[r] >= n for r, n in rows.items())
    out = sorted((r["start"], r["doc_id"], r["n_tokens"]) for r in stages["token-ID output"](spark, docs, SF).collect())
    assert [r[1] for r in out] == [None, None, 1, 2, 3, 4, 4, 5] and [r[2] for r in out[2:5]] == [1, 1, 1]


def test_stages_take_an_empty_table(spark):
    docs = spark.createDataFrame([], WIDE)
    for name, stage in cp.STAGES:
        assert stage(spark, docs, SF).count() == 0, name


def test_stages_against_plain_python(spark):
    """Near-dedup by all pairs of 5-word shingle sets; leaks by all windows of every item's size."""
    rows = [r for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    texts = {r["doc_id"]: r["text"] for r in rows}
    docs = spark.createDataFrame(rows)
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    own = {i: i for i in sets}

    def root(i):
        while own[i] != i:
            i = own[i]
        return i

    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) > 0:
                x, y = sorted((root(a), root(b)))
                own[y] = x
    left = {r["doc_id"] for r in dict(cp.STAGES)["MinHash near-dedup"](spark, docs, SF).collect()}
    assert left == {i for i in sets if root(i) == i}
