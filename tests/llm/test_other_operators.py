"""Chat windows, neighbours and the pipeline against brute force, and their edge cases."""

from __future__ import annotations

import importlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowloom.llm import chat_windows, neighbour_graph, queries

corpus_pipeline = importlib.import_module("corpus_pipeline")
MARKS = "<|im_end|><|im_start|>assistant ok"


def chats(spark):
    rows = []
    for c in range(12):
        for t in range(c * 3):
            role = "system" if t == 0 and c % 2 else ("user" if t % 2 else "assistant")
            rows.append((c, t, role, f"turn {t} of {c} " + "word " * (c * t % 37)))
    rows += [(-1, 0, "user", MARKS), (-1, 1, "assistant", MARKS), (50, 0, "system", "alone"), (51, 0, "assistant", None), (51, None, None, "first")]
    rows += [(None, 0, "user", "no id"), (None, 1, "assistant", "x<⁠|y<|z<⁠⁠|"), (52, 0, "a\nb%0A<|im_end|>", "odd role"), (53, 1, "assistant", "long " * 3000)]
    rows += [(54, 3, "assistant", "same"), (54, 3, "assistant", "same"), (54, 3, "user", "")]
    rows += [(60, t, "assistant" if t % 2 else "user", f"m{t} " + "w" * (t % 50)) for t in range(900)]
    return rows


@pytest.mark.parametrize(("budget", "history"), [(64, 16), (300, 100), (100, 0)])
def test_windows_read_back_to_what_was_said(spark, budget, history):
    rows = chats(spark)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat_windows.chat_windows(df.withColumn("at", F.lit("clash")).withColumn("conv", F.lit(1)), budget, history)
    told, targets = defaultdict(list), defaultdict(list)
    for r in chat_windows.read_back(made).collect():
        told[r["conv_id"]].append((r["window_start"], [tuple(t) for t in r["turns"]]))
        targets[r["conv_id"]].append((r["window_start"], r["targets"]))
    want = defaultdict(list)
    for c, t, role, text in rows:
        want[c].append((t is not None, t or 0, role or "", chat_windows.TURN_OVERHEAD + -(-len((text or "").encode()) // 4), text or ""))
    assert set(told) == set(want)
    for c, turns in want.items():
        turns.sort()
        assert [x for _, w in sorted(told[c]) for x in w] == [(r, x) for _, _, r, _, x in turns]
        assert [x for _, w in sorted(targets[c]) for x in w] == [x for _, _, r, _, x in turns if r == "assistant"]
    for r in made.collect():
        assert r["over_budget"] == (r["n_tokens"] > budget)
        turns = want[r["conv_id"]]
        if r["over_budget"]:
            assert max(t[3] for t in turns) * 2 > (budget - history) / 2 - turns[0][3]
        if r["conv_id"] in (1, 3, 5, 7, 9, 11):
            assert r["formatted"].startswith("<|im_start|>system\n")
    if history:
        assert any(r["n_repeated"] > 1 for r in made.collect())


def test_windows_of_nothing(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_windows.chat_windows(df).collect() == []
    with pytest.raises(ValueError):
        chat_windows.chat_windows(df, 10, 10)


def brute(rows, asked, k):
    out = {}
    for q, v in asked:
        score = sorted((-float((np.array(v) * np.array(x)).sum()), i) for i, x in rows if i != q)[:k]
        out[q] = [i for _, i in score]
    return out


def test_neighbours_recall_on_given_vectors(spark, sf):
    df = spark.read.parquet(f"{sf.replace('0.001', '0.1')}/embeddings.parquet")
    got = defaultdict(list)
    for r in neighbour_graph.nearest_by_product(df, df.where("vec_id % 20 = 0"), 20, shard_vectors=600).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    rows = [(r["vec_id"], np.array(r["embedding"], dtype=float)) for r in df.collect()]
    want = brute(rows, [r for r in rows if r[0] % 20 == 0], 20)
    assert set(got) == set(want)
    hits = sum(len({i for _, i, _ in got[q]} & set(want[q])) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.95
    vectors = dict(rows)
    for q, found in got.items():
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 21))
        assert [(-s, i) for _, i, s in found] == sorted((-s, i) for _, i, s in found)
        assert all(s == pytest.approx(float(vectors[q] @ vectors[i]), abs=1e-12) for _, i, s in found)


def test_neighbours_of_lengths_copies_and_unusable_vectors(spark):
    rng = np.random.default_rng(8)
    rows = [(i, (rng.normal(size=6) * rng.uniform(0.1, 5)).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(120)] + [rows[3]]
    bad = [(2000, None), (2001, [0.0] * 6), (2002, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2003, [float("nan")] + [1.0] * 5), (2004, [float("inf")] + [1.0] * 5), (2005, [1.0]), (None, [1.0] * 6)]
    df = spark.createDataFrame([*rows, *bad], "vec_id long, embedding array<double>").withColumn("shard", F.lit("clash"))
    asked = df.where("vec_id % 20 = 0")
    got = defaultdict(list)
    for r in neighbour_graph.nearest_by_product(df, asked, 10, shard_vectors=100).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["vec_id"])
    unique = list({i: (i, v) for i, v in rows}.values())
    want = brute(unique, [r for r in unique if r[0] % 20 == 0], 10)
    assert set(got) == set(want)
    assert sum(len(set(got[q]) & set(want[q])) for q in want) / sum(map(len, want.values())) >= 0.95
    few = spark.createDataFrame(rows[:3], "vec_id long, embedding array<double>")
    assert neighbour_graph.nearest_by_product(few, few, 10).count() == 6
    assert neighbour_graph.nearest_by_product(few.limit(0), few.limit(0), 10).collect() == []
    assert neighbour_graph.nearest_by_product(few, few.limit(0), 10).collect() == []


def test_pipeline_stages_and_their_decisions(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "ngram_jaccard_join", "suffix_array_dedup", "private_data", "best_fit_packing"]
    good = corpus_pipeline.good_documents(spark, docs, sf)
    unlike = corpus_pipeline.unlike_documents(spark, docs, sf)
    cut = corpus_pipeline.unrepeated_text(spark, docs, sf)
    clean = corpus_pipeline.redacted_text(spark, docs, sf)
    for made in (good, unlike, cut, clean):
        assert made.dtypes == docs.dtypes
    junk = {r[0] for r in spark.read.parquet(f"{sf}/labels.parquet").where("quality = 0").collect()}
    kept = {r["doc_id"] for r in good.collect()}
    assert len(junk & kept) <= 1 and len(kept) >= 0.8 * docs.count()
    classes = queries.op6(spark, sf).collect()
    assert {r["doc_id"] for r in unlike.collect()} == {r["class_id"] for r in classes}
    assert cut.count() == docs.count() and clean.count() == docs.count()
    sizes = {r["doc_id"]: r["n_bytes"] - r["n_removed"] for r in queries.op2(spark, sf).collect()}
    for r in cut.collect():
        assert len(r["text"].encode()) <= sizes[r["doc_id"]] and r["n_chars"] == len(r["text"])
    assert not clean.where(F.col("text").rlike(r"[A-Za-z0-9]@[A-Za-z0-9-]+\.[A-Za-z0-9]")).count()


def test_pipeline_of_repeated_and_missing_rows(spark, sf):
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(1, text, "en", "s", 1), (1, text, "en", "s", 1), (2, text, None, None, None), (None, "apart from all others, quite", "en", "s", 1), (3, None, "en", "s", 0), (4, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), sf).count() == 0, name
    left = [(r["doc_id"], r["text"]) for r in corpus_pipeline.unlike_documents(spark, docs, sf).collect()]
    assert sorted(left, key=repr) == sorted([(1, text), (3, None), (None, rows[3][1])], key=repr)
    assert corpus_pipeline.good_documents(spark, docs, sf).count() >= 4
    assert corpus_pipeline.packed_sequences(spark, docs, sf).count() == 6
