"""The training-data operators against brute force, round trips and held-out accuracy, with odd rows among the input."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest

from factloom.llm import idcoder, leaks, licences, lm, minhash, mixing, neighbours, pii, quality, queries, substring, tokenfile

SF = "/root/testdata/sf0.001"
ODD = [(900001, None), (900002, ""), (900003, " \t\n"), (900004, "one two"), (900005, "Ünï çödé　word\x1cx"), (None, "nobody has this id"), (900006, "the same row " * 9), (900006, "the same row " * 9)]
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def rows(spark):
    found = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    return found + [(900010, " ".join(f"w{k % 977}" for k in range(30_000)))] + ODD


@pytest.fixture(scope="module")
def docs(spark, rows):
    """With extra columns whose names clash with those that operators make."""
    wide = [(*r, "s0", 1, "x", 0.5) for r in rows]
    return spark.createDataFrame(wide, f"{SCHEMA}, source string, n long, kept string, score double").repartition(3)


def empty(spark):
    return spark.createDataFrame([], f"{SCHEMA}, source string")


def words(text, lower=False):
    data = (text or "").encode()
    return (data.lower() if lower else data).split()


def test_near_duplicates(spark, docs, rows):
    got = {(r["doc_id"], r["component_id"], r["n_shingles"], r["kept"]) for r in minhash.near_duplicates(docs, 3, 85).collect()}
    sets = {}
    for i, t in rows:
        w = words(t, True)
        sets[i] = {tuple(w[k : k + 3]) for k in range(len(w) - 2)} if len(w) >= 3 else ({tuple(w)} if w else set())
    own = {i: i for i in sets if i is not None}

    def root(i):
        while own[i] != i:
            i = own[i]
        return i

    ids = sorted(own)
    for a in ids:
        for b in ids:
            if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]) > 0:
                x, y = sorted((root(a), root(b)))
                own[y] = x
    assert got == {(i, root(i) if i is not None else None, len(sets[i]), i is None or root(i) == i) for i in sets}
    assert minhash.near_duplicates(empty(spark)).count() == 0


@pytest.mark.parametrize("block", [1024, 50])
def test_a_large_group_loses_no_link(spark, monkeypatch, block):
    """Also where lists are cut into many blocks."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    rng = random.Random(5)
    base = [f"b{k}" for k in range(120)]
    texts = []
    for i in range(400):
        w = list(base)
        for _ in range(rng.randrange(0, 7)):
            w[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        texts.append((i + 1, " ".join(w)))
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(spark.createDataFrame(texts, SCHEMA), 3, 85).collect()}
    sets = {i: {tuple(t.split()[k : k + 3]) for k in range(118)} for i, t in texts}
    own = {i: i for i in sets}

    def root(i):
        while own[i] != i:
            i = own[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and root(a) != root(b) and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                own[y] = x
    assert got == {i: root(i) for i in sets}


def test_a_quoted_passage_hides_no_pair(spark):
    """Two near-copies of a passage whose shingles smaller doc_ids quote among words of their own are linked, and nothing else."""
    passage = [f"p{k}" for k in range(100)]
    texts = [(i, " ".join([f"q{i}x{k}" for k in range(3)] + passage[i % 98 : i % 98 + 3] + [f"r{i}x{k}" for k in range(3)])) for i in range(1, 393)]
    texts += [(1001, " ".join([*passage, "one", "end"])), (1002, " ".join([*passage, "other", "close"]))]
    sets = {i: {tuple(t.split()[k : k + 3]) for k in range(len(t.split()) - 2)} for i, t in texts}
    linked = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    assert linked == [(1001, 1002)]
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(spark.createDataFrame(texts, SCHEMA), 3, 85).collect()}
    assert got == {i: 1001 if i == 1002 else i for i in sets}


def test_substring_removal(spark, docs, rows):
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring.remove_repeats(docs, 20).collect()}
    seen, want = set(), {}
    for i, t in sorted({r for r in rows if r[0] is not None}):
        w = words(t)
        keep = [True] * len(w)
        for k in range(len(w) - 19):
            g = tuple(w[k : k + 20])
            if g in seen:
                keep[k : k + 20] = [False] * 20
            seen.add(g)
        left = [x for x, y in zip(w, keep) if y]
        want[i] = (len(w), len(w) - len(left), hashlib.sha256(b" ".join(left)).hexdigest())
    nobody = dict(rows)[None].encode()
    assert got.pop(None) == (len(nobody.split()), 0, hashlib.sha256(nobody).hexdigest())
    assert got == want
    assert substring.remove_repeats(empty(spark)).count() == 0


def removed(rows, length):
    seen, want = set(), {}
    for i, t in sorted({r for r in rows if r[0] is not None}):
        w = words(t)
        keep = [True] * len(w)
        for k in range(len(w) - length + 1):
            g = tuple(w[k : k + length])
            if g in seen:
                keep[k : k + length] = [False] * length
            seen.add(g)
        want[i] = hashlib.sha256(b" ".join(x for x, y in zip(w, keep) if y)).hexdigest()
    return want


@pytest.mark.parametrize("piece, parts", [(300, 3), (3000, 5), (10**6, 1)])
def test_matches_are_extended_across_pieces(spark, monkeypatch, piece, parts):
    """Overlapping cuts of a few passages, some with a changed word, repeated rows, one word over and over."""
    monkeypatch.setattr(substring, "PIECE", piece)
    rng = random.Random(1)
    passages = [[f"w{rng.randrange(50)}" for _ in range(80)] for _ in range(4)]
    rows = []
    for i in range(150):
        w = []
        for _ in range(rng.randrange(1, 4)):
            a = rng.randrange(0, 40)
            cut = list(rng.choice(passages))[a : rng.randrange(a + 10, 80)]
            if rng.random() < 0.5:
                cut[rng.randrange(len(cut))] = f"X{rng.randrange(3)}"
            w += cut
        rows.append((i, " ".join(w)))
    rows += [rows[3], rows[50], (1000, "go " * 300)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    got = substring.remove_repeats(docs, 20).collect()
    assert {r["doc_id"]: r["kept_sha256"] for r in got} == removed(rows, 20) and len(got) == len(rows)


def test_extension_counts_equal_words():
    own, other = np.array([9, 1, 2, 3, 4, 5, 6, 7, 8, 0]), np.array([0, 2, 3, 4, 5, 6, 7, 8, 8, 8])
    n = substring.GRAM
    left, right = substring.extend(own, np.array([2]), np.array([0]), np.array([10]), other, np.array([1]), np.array([0]), np.array([10]), 4)
    assert (left.tolist(), right.tolist()) == ([0], [7]) and n == 6


def test_quality(spark):
    found = queries.op1_quality_compression(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in found]) >= 0.95


def test_clean_long_documents_are_kept(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    good = [r["text"] for r in docs.join(labels.where("quality = 1"), "doc_id").orderBy("doc_id").limit(60).collect()]
    bad = [r["text"] for r in docs.join(labels.where("quality = 0"), "doc_id").orderBy("doc_id").limit(60).collect()]
    model = quality.fit(docs, labels, quality.crc_mod("doc_id", 3) != 1, per_class=150, characters=2_000_000)
    long = spark.createDataFrame([(1, " ".join(good * 8)), (2, " ".join(bad * 8))], SCHEMA)
    got = {r["doc_id"]: r["score"] for r in quality.score(long, model).collect()}
    assert got[1] >= 0.5 > got[2]


def test_quality_of_odd_rows(spark, docs):
    labels = spark.createDataFrame([(1, 1), (None, 0), (2, None)], "doc_id long, quality int")
    got = quality.quality(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert quality.quality(empty(spark), labels).count() == 0


def test_neighbours(spark):
    got = queries.op2_learned_partitions(spark, "/root/testdata/sf0.1").collect()
    v = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").toPandas()
    x, ids = np.stack(v.embedding).astype(float), v.vec_id.to_numpy()
    hit = total = 0
    for q in np.nonzero(ids % 100 == 0)[0]:
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        hit += len(set(ids[np.lexsort((ids, d))[:10]]) & {r["vec_id"] for r in got if r["query_id"] == ids[q]})
        total += 10
    assert hit / total >= 0.9


def test_neighbours_over_many_partitions(spark, monkeypatch):
    """Recall against brute force over the whole table, with more than 50 partitions and queries in blocks."""
    monkeypatch.setattr(neighbours, "PER_PARTITION", 128)
    monkeypatch.setattr(neighbours, "PIECE", 100)
    monkeypatch.setattr(neighbours, "QUERIES", 16)
    made = []
    partition = neighbours.balanced_partition
    monkeypatch.setattr(neighbours, "balanced_partition", lambda x, graph, parts: made.append(partition(x, graph, parts)) or made[-1])
    rng = np.random.default_rng(4)
    x = (rng.normal(size=(200, 12))[rng.integers(0, 200, 8000)] + 0.35 * rng.normal(size=(8000, 12))).astype(np.float32)
    v = spark.createDataFrame([(i, row.tolist(), "extra", 1) for i, row in enumerate(x)], "vec_id long, embedding array<float>, part string, rank int")
    got = {}
    for r in neighbours.nearest(v, 100, 10).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert made[0].max() + 1 > 50 and np.bincount(made[0]).max() <= len(made[0]) / (made[0].max() + 1) * 1.2 + 1
    y, hit = x.astype(float), 0
    for q in range(0, 8000, 100):
        d = ((y - y[q]) ** 2).sum(1)
        d[q] = np.inf
        hit += len(set(np.argsort(d, kind="stable")[:10].tolist()) & got[q])
    assert hit / 800 >= 0.9


def test_neighbours_of_odd_vectors(spark):
    nan = float("nan")
    v = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [nan, 1.0]), (5, [1.0, None]), (6, [1.0]), (7, [0.0, 2.0]), (7, [0.0, 2.0]), (100, [1.0, 0.0]), (None, [1.0, 1.0])]
    got = neighbours.nearest(spark.createDataFrame(v, "vec_id long, embedding array<float>"), 100, 10).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 6)) for r in got) == [(0, 1, 1, 0.0), (0, 2, 100, 0.0), (0, 3, 7, round(5**0.5, 6)), (100, 1, 0, 0.0), (100, 2, 1, 0.0), (100, 3, 7, round(5**0.5, 6))]
    assert neighbours.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


@pytest.mark.parametrize("weights", [{"a": 1, "b": 2, "c": 7}, {k: 1 for k in range(13)}, {"x": 0.999, "y": 0.001}, {"a": 1 / 3, "b": 1 / 7, "c": 1 - 1 / 3 - 1 / 7}, {"a": 1, "b": 1e-6}])
def test_schedule_deviates_by_less_than_a_block(weights):
    """From the given weights, over 50,000 slots; each slot goes to the released block with the earliest deadline."""
    quota = mixing.shares(weights)
    total, n = sum(quota.values()), 50_000
    slots = mixing.schedule(quota, total, {max(weights, key=weights.get): int(n * max(weights.values()) / sum(weights.values())) + 2})
    order = {t: s for s, at in slots.items() for t in at}
    assert sorted(order) == list(range(len(order))) and len(order) >= n
    for s, at in slots.items():
        assert np.abs(np.cumsum(np.isin(np.arange(n), at)) - weights[s] / sum(weights.values()) * np.arange(1, n + 1)).max() < 1
        assert all(j * total // quota[s] <= t < -(-(j + 1) * total // quota[s]) for j, t in enumerate(at))


def test_mix_refuses_weights_and_keeps_names(spark):
    docs = spark.createDataFrame([(1, "a", "x", 2, None), (None, None, "y", 3, None), (None, None, "y", 3, None)], "doc_id long, source string, bucket string, number int, doc string")
    got = mixing.mix(docs).collect()
    assert {(r["doc_id"], r["bucket"], r["number"], r["doc"]) for r in got} == {(1, "x", 2, None), (None, "y", 3, None)}
    assert mixing.placed(docs).select("doc.*").columns == docs.columns
    for bad in (0, -1, float("nan"), float("inf")):
        with pytest.raises(ValueError):
            mixing.mix(docs, {"a": bad})


def test_blocks_grow_so_that_the_drivers_schedule_is_bounded(monkeypatch):
    monkeypatch.setattr(mixing, "SLOTS", 1000)
    counts, quota = {"a": 10**7, "b": 10}, {"a": 9, "b": 1}
    size = mixing.block_size(counts, quota)
    assert max(-(-n // size) * 10 // quota[s] for s, n in counts.items()) <= 1000 and size & (size - 1) == 0


def test_mix_places_every_row(spark):
    rows = [(i, "big") for i in range(3000)] + [(i, "small") for i in range(3000, 3100)] + [(None, None), (1, "big")]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string"), {"big": 1, "small": 1, None: 1}).collect()
    assert Counter((r["doc_id"], r["source"]) for r in got if r["epoch"] == 0) == Counter(rows)
    slots = {}
    for r in got:
        assert slots.setdefault(r["slot"], r["source"]) == r["source"]
    assert sorted(slots) == list(range(len(slots)))
    shares = Counter(slots.values())
    assert all(abs(n - len(slots) / 3) < 2 for n in shares.values())
    assert mixing.mix(spark.createDataFrame([], "doc_id long, source string")).count() == 0


def test_mix_deviates_by_less_than_a_block_from_the_given_weights(spark):
    """Over many thousand slots, with a source whose weight is under 1 / 4096."""
    weights = {"big": 0.7, "mid": 0.29995, "tiny": 0.00005}
    n = 320_000
    docs = spark.range(n).selectExpr("id AS doc_id", f"CASE WHEN id < 64 THEN 'tiny' WHEN id < {n} * 0.3 THEN 'mid' ELSE 'big' END AS source")
    at = dict(mixing.mix(docs, weights).select("slot", "source").distinct().toPandas().itertuples(index=False))
    assert sorted(at) == list(range(len(at))) and len(at) >= 20_000  # the tiny source's second block is released at slot 20,000
    order = np.array([at[t] for t in range(len(at))])
    for s, w in weights.items():
        assert np.abs(np.cumsum(order == s) - w * np.arange(1, len(at) + 1)).max() < 1


@pytest.mark.parametrize("n", [1, 2, 511, 513, 5000, 40_000])
def test_ids_come_back(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.3, n), 49407).astype(np.int64)
    block = idcoder.encode_block([7, None], [n - 1, 1], ids, 49408)
    docs, counts, back = idcoder.decode_block(block)
    assert docs == [7, None] and counts.tolist() == [n - 1, 1] and (back == ids).all()
    with pytest.raises(ValueError):
        idcoder.decode_block(block[:-1] + bytes([block[-1] ^ 1]))


def test_token_files(spark, docs, rows):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer_path())
    got = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in tokenfile.read_ids(tokenfile.write_ids(docs, queries.tokenizer_path())).collect())
    want, at = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        want.append((at, i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == want
    assert tokenfile.read_ids(tokenfile.write_ids(empty(spark), queries.tokenizer_path())).count() == 0


def test_orders_one_and_two_help():
    rng = np.random.default_rng(3)
    phrases = [rng.integers(0, 5000, 40) for _ in range(60)]
    ids = np.concatenate([phrases[k] for k in rng.integers(0, 60, 4000)])
    share = np.bincount(ids)[ids] / len(ids)
    assert 8 * len(idcoder.encode_ids(ids, 50_000)) / len(ids) < 0.6 * -np.log2(share).mean()


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_are_those_of_the_tokenizer(name):
    """Words apart where the tokenizer allows, else whole texts."""
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path(name)
    made, t = tokenfile.Encoder(path), Tokenizer.from_file(path)
    assert made.apart == name.startswith("word")
    texts = [None, "", " \t\n", "Ünï ÇÖDÉ İstanbul İstanbul. ΣΑΣ word's don't x<|endoftext|>y <|startoftext|> a.b.c 12ab \'\'\'s 's 漢字かな é e\u0301. क़ b\u00a0x　y ﬁ ﬃ. ǅ! K ½ ²x +1 (555) --", "a" * 3000 + "!?", "Stem,stem stem, stem... (stem) STEM*** 'stem'"]
    x, n = made.encode(tokenfile.pa.array(texts))
    want = [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]
    assert n.tolist() == [len(w) for w in want] and x.tolist() == [i for w in want for i in w]


def test_a_full_memory_changes_no_ids():
    """Words are forgotten and met again; hashes of two words that are the same find the first alone."""
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    rng = random.Random(12)
    texts = [" ".join("".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 5))) + rng.choice(["", ".", "!?", "'s"]) for _ in range(200)) for _ in range(60)]
    small, large = tokenfile.Encoder(path, 300), tokenfile.Encoder(path)
    for text in texts + texts:
        a, b = small.encode(tokenfile.pa.array([text])), large.encode(tokenfile.pa.array([text]))
        assert a[0].tolist() == b[0].tolist() == large.tokenizer.encode(text, add_special_tokens=False).ids and a[1].tolist() == b[1].tolist()
    assert small.n < large.n and len(large.keys) == large.n


MIT = """MIT License

Copyright (c) 2020 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

{0}Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

{1}Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
THIRD = """
{0}Neither the name of {1} nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
GPL = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.
"""
LGPL = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version."""


def test_licences_of_wrapped_texts_and_notices(spark):
    texts = {
        MIT: ["MIT"],
        BSD.format("1. ", "2. "): ["BSD-2-Clause"],
        BSD.format("* ", "* ") + THIRD.format("* ", "Foo Corp."): ["BSD-3-Clause"],
        BSD.format("", "") + THIRD.format("3. ", "the University"): ["BSD-3-Clause"],
        GPL: ["GPL-3.0"],
        LGPL: ["LGPL-2.1"],
        "This file is licensed under the MIT License.": ["MIT"],
        "Released under the MIT license by Foo Corp.": ["MIT"],
        "// SPDX-License-Identifier: BSD-3-Clause": ["BSD-3-Clause"],
        "# SPDX-License-Identifier:   LGPL-2.1-or-later\nimport os": ["LGPL-2.1"],
        "Licensed under CC BY-SA 4.0": ["CC-BY-SA-4.0"],
        'Licensed under the Apache License, Version 2.0 (the "License");\nyou may not use this file except in compliance with the License.': ["Apache-2.0"],
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.": ["MPL-2.0"],
        "available under the terms of the Eclipse Public License 2.0, see below": ["EPL-2.0"],
        "under the rights of man, licensed software": [],
        "word " * 200_000 + "\nAll rights reserved.": ["all-rights-reserved"],
    }
    docs = spark.createDataFrame([(k, t, "x", [1], 2) for k, t in enumerate(texts)] + [(None, MIT, "x", [1], 2), (0, MIT, "x", [1], 2)], f"{SCHEMA}, licences string, a array<int>, holds int")
    got = [(r["doc_id"], r["licences"]) for r in licences.scan_licences(docs).collect()]
    assert sorted(got, key=str) == sorted([*enumerate(texts.values()), (None, ["MIT"]), (0, ["MIT"])], key=str)
    assert licences.scan_licences(empty(spark)).count() == 0


def test_licences(spark):
    texts = [(1, "words\nReleased under the MIT License."), (2, "RELEASED!! UNDER!! THE!! MIT!! LICENSE.!!"), (3, "Nothing. All rights reserved. More"), (4, None), (5, ""), (6, "A licence of mine.")]
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met. "
    texts.append((7, bsd + licences.SENTENCES[8] + ". Between. " + licences.SENTENCES[9] + "."))
    texts.append((8, licences.SENTENCES[9] + ". " + licences.SENTENCES[8] + ". " + bsd))
    got = {r["doc_id"]: r["licences"] for r in licences.scan_licences(spark.createDataFrame(texts, SCHEMA)).collect()}
    assert got == {1: ["MIT"], 2: ["MIT"], 3: ["all-rights-reserved"], 4: [], 5: [], 6: [], 7: ["BSD-2-Clause"], 8: []}


def test_language_model(spark, docs, rows):
    got = {(r["doc_id"], r["n_tokens"]): r for r in lm.language_model(docs).collect()}
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    c = Counter(w for i, t in rows if not held(i) for w in [*words(t, True), b""])
    n, v = sum(c.values()), len(c)
    for i, t in rows:
        w = [*words(t, True), b""]
        r = got[i, len(w)]
        assert (r["held_out"], r["n_known"], r["train_tokens"]) == (held(i), sum(c[x] > 0 for x in w), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w))
    out = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)
    assert lm.language_model(empty(spark)).count() == 0


def test_scores_do_not_depend_on_partitions_or_pieces(spark, monkeypatch, docs):
    seen = []
    for piece, parts in ((10**6, 1), (2000, 2), (20_000, 7)):
        # the number of parts follows from the size of a piece and numbers the words, so it is kept the same
        monkeypatch.setattr(lm, "PARTS", 3)
        monkeypatch.setattr(lm, "PIECE", piece)
        seen.append(sorted(((r["doc_id"] or -1, r["n_tokens"], round(r["score"], 9)) for r in lm.language_model(docs.repartition(parts)).collect())))
    assert seen[0] == seen[1] == seen[2]


@pytest.mark.parametrize("c, fixed, slope, d", [(2, 0.3, 0.1, 0.5), (5, 0.05, 0.02, 0.8), (9, 1.0, 0.3, 0.3)])
def test_gibbs_steps_sample_the_restaurant(c, fixed, slope, d):
    """Tables of c customers against their exact distribution: seatings counted by the recursion over customers, times gains."""
    ways = {1: 1.0}
    for n in range(1, c):
        nxt = Counter()
        for t, x in ways.items():
            nxt[t] += x * (n - d * t)
            nxt[t + 1] += x
        ways = nxt
    weight = {t: x * math.prod(fixed + slope * k for k in range(t)) for t, x in ways.items()}
    want = np.array([weight.get(t, 0) for t in range(1, c + 1)]) / sum(weight.values())
    n = 40_000
    t, sizes = np.ones(n, np.int64), np.full(n, c, np.int64)
    hashes = lm.mix(np.arange(n, dtype=np.uint64) + np.uint64(7))
    for sweep in range(12):
        sizes, t = lm.gibbs(sizes, t, np.full(n, c), np.full(n, fixed), np.full(n, slope), d, hashes, sweep)
        assert sizes.min() > 0 and sizes.sum() == n * c and t.sum() == len(sizes)
    got = np.bincount(t, minlength=c + 1)[1:] / n
    assert np.abs(got - want).max() < 0.02, (got, want)


@pytest.mark.parametrize("at_once", [0, 64, 10**12])
def test_a_sweep_moves_every_customer(monkeypatch, at_once):
    """With a new table next to certain, every customer that leaves opens one; those who stay would be seen at the old one."""
    monkeypatch.setattr(lm, "AT_ONCE", at_once)  # 0: all dishes side by side; the most: one by one
    c = np.array([1, 300, 2, 7, 0, 1000, 40])
    t = np.minimum(c, 1)
    hashes = lm.mix(np.arange(len(c), dtype=np.uint64))
    sizes, t = lm.gibbs(c[c > 0], t, c, np.full(len(c), 1e15), np.zeros(len(c)), 0.5, hashes, 1)
    assert t.tolist() == c.tolist() and set(sizes.tolist()) == {1}
    for sweep in range(2, 40):  # and with one next to impossible those of small dishes meet at one
        sizes, t = lm.gibbs(sizes, t, c, np.full(len(c), 1e-15), np.zeros(len(c)), 0.0, hashes, sweep)
        assert np.add.reduceat(sizes, np.cumsum(t)[c > 0] - t[c > 0]).tolist() == c[c > 0].tolist() and sizes.min() > 0
    assert t[c < 10].tolist() == [1, 1, 1, 0]


@pytest.mark.parametrize("at_once", [0, 10**12])
@pytest.mark.parametrize("c, fixed, slope, d", [(30, 1.0, 0.2, 0.5), (40, 2.0, 0.4, 0.8)])
def test_frequent_dishes_reach_the_exact_distribution(monkeypatch, at_once, c, fixed, slope, d):
    """As above, with more customers than few steps could move, and from one table and from as many as customers."""
    monkeypatch.setattr(lm, "AT_ONCE", at_once)
    ways = {1: 1.0}
    for n in range(1, c):
        nxt = Counter()
        for t, x in ways.items():
            nxt[t] += x * (n - d * t)
            nxt[t + 1] += x
        ways = nxt
    want = np.array([ways[t] * math.prod(fixed + slope * k for k in range(t)) for t in range(1, c + 1)])
    want /= want.sum()
    n = 4000
    t = np.where(np.arange(n) % 2, c, 1)
    sizes = np.repeat(c // t, t)
    hashes = lm.mix(np.arange(n, dtype=np.uint64) + np.uint64(7))
    for sweep in range(25):
        sizes, t = lm.gibbs(sizes, t, np.full(n, c), np.full(n, fixed), np.full(n, slope), d, hashes, sweep)
    got = np.bincount(t, minlength=c + 1)[1:] / n
    assert np.abs(got - want).max() < 0.025, (got, want)


def test_a_plain_gibbs_sampler_agrees(spark):
    """Held-out log-probabilities of a tiny corpus against a plain sampler, customer by customer, of the same model."""
    rng = random.Random(8)
    texts = [" ".join(rng.choice(["a b", "a c", "d e f", "b", "g"]) for _ in range(6)) for _ in range(60)]
    rows = list(enumerate(texts))
    got = {r["doc_id"]: r["score"] for r in lm.language_model(spark.createDataFrame(rows, SCHEMA)).collect() if r["held_out"]}
    train = [words(t, True) + [b""] for i, t in rows if i not in got]
    pairs = [(u, w) for t in train for u, w in zip([b"", *t], t)]
    known = {w for _, w in pairs}
    counts = Counter(Counter(pairs).values())
    d, theta, base = lm.discount(counts[1], counts[2]), lm.THETA, 1 / (len(known) + 1)
    seats = {}  # (context, word) -> sizes; the word restaurant has the context None

    def total(u, f):
        return sum(f(s) for (x, _), s in seats.items() if x == u)

    def prob(u, w, d0):
        if u is not None and not any(x == u for x, _ in seats):
            return prob(None, w, d0)
        own = seats.get((u, w), [])
        dd = d if u is not None else d0
        up = base if u is None else prob(None, w, d0)
        return (sum(own) - dd * len(own) + (theta + dd * total(u, len)) * up) / (total(u, sum) + theta)

    def sit(u, w, d0):
        own = seats.setdefault((u, w), [])
        dd = d if u is not None else d0
        new = (theta + dd * total(u, len)) * (base if u is None else prob(None, w, d0))
        pick = rng.random() * (sum(own) - dd * len(own) + new)
        for k, size in enumerate(own):
            pick -= size - dd
            if pick < 0:
                own[k] += 1
                return
        own.append(1)
        if u is not None:
            sit(None, w, d0)

    def leave(u, w):
        own = seats[u, w]
        pick = rng.randrange(sum(own))
        for k, size in enumerate(own):
            pick -= size
            if pick < 0:
                own[k] -= 1
                if not own[k]:
                    del own[k]
                    if u is not None:
                        leave(None, w)
                return

    ups = Counter(w for _, w in set(pairs))
    d0 = lm.discount(sum(n == 1 for n in ups.values()), sum(n == 2 for n in ups.values()))
    for u, w in pairs:
        sit(u, w, d0)
    want = {i: [] for i in got}
    for sweep in range(12):
        for u, w in pairs:
            leave(u, w)
            sit(u, w, d0)
        if sweep >= 4:
            for i in got:
                t = words(texts[i], True) + [b""]
                want[i].append([prob(u, w if w in known else None, d0) for u, w in zip([b"", *t], t)])
    for i, score in got.items():
        assert score == pytest.approx(np.log10(np.mean(want[i], 0)).sum(), rel=0.03)


PII = [
    (1, "mail bob.x@mail.example.com now, a@b.c@d.e and x@y"),
    (2, "ip 10.0.0.256 1.2.3.4.5 999.1.1.1 192.168.0.1"),
    (3, "card 4111 1111 1111 1111 or 4111-1111-1111-1112 +1 (555) 123-4567 +12"),
    (4, 'é token = "9c8b45435718dcc700c184a7e303cdc64c6a8f7f" and 6874314485609552 end'),
    (5, None),
    (6, ""),
    (7, "aaaa" * 20_000 + "@" + "b" * 1000),
]


def test_personal_data(spark):
    got = {r["doc_id"]: r for r in pii.find_pii(spark.createDataFrame(PII, SCHEMA)).collect()}
    for i, t in PII:
        t, base = t or "", []
        small = t if len(t) < 10_000 else ""
        base += [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", small)]
        base += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) < 256 for x in m.group().split("."))]
        base += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 13 <= len(re.sub(r"\D", "", m.group())) <= 19 and pii.luhn(re.sub(r"\D", "", m.group()))]
        base += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub(r"\D", "", m.group())) <= 15]
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest(), i
    assert "secret:11:51" in got[4]["spans"] and "account:57:73" in got[4]["spans"]
    assert got[4]["n_spans"] == 2 and got[1]["n_spans"] == got[1]["n_email"]
    assert pii.find_pii(empty(spark)).count() == 0


def test_personal_data_in_long_texts_takes_time_by_length():
    for text in ("1" * 10**6, "1." * 500_000, "a@" * 500_000, "+1 (" * 250_000, "0-" * 500_000, "x" * 10**6):
        start = time.time()
        pii.candidates(text, pii.base_spans(text))
        assert time.time() - start < 5


def test_base_kinds_are_the_patterns(spark):
    rng = random.Random(6)
    bits = ["1", "23", "456", ".", "..", "@", "+", "-", " ", "(", ")", "a", "b%", "_", "x@y.z", "4111 1111 1111 1111", "10.0.0.1"]
    rows = [(k, "".join(rng.choice(bits) for _ in range(60))) for k in range(400)] + [(None, "1.2.3.4"), (None, "1.2.3.4")]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], f"{SCHEMA}, spans string, n_ip int")
    got = [r["base_sha256"] for r in sorted(pii.find_pii(docs).collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))]
    for (_, t), digest in zip(rows, got):
        base = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
        base += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) < 256 for x in m.group().split("."))]
        base += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 13 <= len(re.sub(r"\D", "", m.group())) <= 19 and pii.luhn(re.sub(r"\D", "", m.group()))]
        base += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub(r"\D", "", m.group())) <= 15]
        assert digest == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest(), t


def test_planted_personal_data_is_found(spark):
    """By kind, among words and long numbers that are none."""
    rng = random.Random(9)
    say = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(n))
    code = lambda n, of: "".join(rng.choice(of) for _ in range(n))
    planted = {"secret": lambda: f'token = "{code(40, "0123456789abcdef")}"', "account": lambda: f"konto {code(16, '123456789')}0", "idnum": lambda: f"ssn: {code(3, '123456789')}-{code(2, '123456789')}-{code(4, '123456789')}", "email": lambda: "x.y@mail.example.com"}
    rows, kinds = [], {}
    for i in range(800):
        kind = [*planted, None][i % 5]
        kinds[i] = kind
        rows.append((i, f"{say(20)} {planted[kind]() if kind else 'abcdefghabcdefghabcdefgh'} {say(20)}"))
    got = {r["doc_id"]: r for r in pii.find_pii(spark.createDataFrame(rows, SCHEMA)).collect()}
    for kind in planted:
        assert np.mean([got[i]["n_spans"] > 0 for i in got if kinds[i] == kind]) >= 0.9, kind
    assert not any(got[i]["n_spans"] for i in got if kinds[i] is None)


def test_leaks(spark):
    rng = random.Random(2)
    say = lambda n: [f"v{rng.randrange(5000)}" for _ in range(n)]
    items = [(k, " ".join(say(40))) for k in range(5)] + [(5, "too few"), (6, None), (7, ""), (0, None)]
    item = items[1][1].split()
    edited = [*item[:38], "other", item[39]]
    half = item[:20] + say(20)
    docs = [(1, " ".join(say(50) + item + say(50))), (2, " ".join(edited)), (3, " ".join(half)), (4, "Too, few!"), (5, None), (6, ""), (None, items[2][1]), (7, " ".join(w.upper() + "!!" for w in item)), (1, items[0][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = [(r["doc_id"], r["item_ids"]) for r in leaks.find_leaks(spark.createDataFrame(docs, SCHEMA), bench).collect()]
    assert dict(got) == {1: [0, 1], 2: [1], 3: [], 4: [5], 5: [], 6: [], None: [], 7: [1]} and len(got) == len(docs)
    assert leaks.find_leaks(empty(spark), bench).count() == 0
    assert not any(r["contaminated"] for r in leaks.find_leaks(spark.createDataFrame(docs, SCHEMA), bench.where("false")).collect())


def test_leaks_of_odd_rows(spark):
    """Very long texts, repeated rows, equal items, clashing names, an item's text that changes."""
    item = [f"w{k}" for k in range(60)]
    long = " ".join([f"z{k % 501}" for k in range(100_000)] + item)
    docs = [(1, long, "x", 1, [2]), (1, long, "x", 1, [2]), (2, " ".join(item[:59]), "y", 1, None), (3, None, None, None, None)]
    bench = [(1, " ".join(item), 7), (1, " ".join(item), 7), (2, " ".join(item), 7), (3, "other words that nobody has in any text at all", 7), (3, " ".join(item[5:]), 7)]
    got = leaks.find_leaks(spark.createDataFrame(docs, f"{SCHEMA}, words string, n int, starts array<int>"), spark.createDataFrame(bench, "item_id long, text string, block int")).collect()
    assert sorted((r["doc_id"], r["item_ids"]) for r in got) == [(1, [1, 2, 3]), (1, [1, 2, 3]), (2, [1, 2, 3]), (3, [])]


def test_leaks_with_a_moved_sentence(spark):
    """Against brute force over all windows of an item's size."""
    rng = random.Random(3)
    say = lambda n: [f"v{rng.randrange(5000)}" for _ in range(n)]
    items = {0: say(60), 1: say(45), 2: ["go"] * 7 + say(10)}
    a, b, c = items.values()
    texts = {1: say(50) + a[50:] + a[:50] + say(50), 2: say(9) + b[22:] + b[:22] + say(30), 3: a[50:] + a[:50], 4: say(20) + a[30:] + a[:30], 5: ["go"] * 40 + c[7:], 6: say(7) + a[:55], 7: a[:56], 8: say(80)}
    grams = lambda w: Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    want = {}
    for i, w in texts.items():
        best = {}
        for k, item in items.items():
            y = grams(item)
            best[k] = max((x & y).total() / (x | y).total() for x in (grams(w[s : s + len(item)]) for s in range(max(1, len(w) - len(item) + 1))))
        want[i] = ([k for k in best if best[k] >= 0.8], max([0.0, *(v for v in best.values() if v >= 0.8)]))
    assert want[1][0] == [0]
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()], "item_id long, text string")
    got = leaks.find_leaks(spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], SCHEMA), bench).collect()
    assert {r["doc_id"]: (r["item_ids"], pytest.approx(r["similarity"])) for r in got} == want
