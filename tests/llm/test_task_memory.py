"""Memory of tasks, and what they are sent."""

from __future__ import annotations

import importlib
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from rowloom.llm import quality
from rowloom.llm.common import components, freeing_group, text_bytes
from rowloom.session import shared_root

corpus_pipeline = importlib.import_module("corpus_pipeline")


def test_a_worker_gives_back_what_a_task_freed():
    """Arrays below the C library's bound of mapping stay in a worker until they are given back."""
    def kept() -> int:
        return int(re.search(r"RssAnon:\s+(\d+)", Path("/proc/self/status").read_text())[1])

    still = []

    def task(rows):
        held = [np.ones(12_000) for _ in range(2000)]  # 190 MB in pieces
        still.append(np.ones(12_000))  # behind them, so that the C library does not give them back by itself
        del held
        return rows

    before, rows = kept(), pa.table({"x": [1]})
    task(rows)
    assert kept() - before > 100_000
    assert freeing_group(task)(rows) is rows
    assert kept() - before < 50_000


def test_the_text_is_passed_to_a_scoring_task_once(spark):
    """A stage that passes its documents on sends each text once, and gives the same columns and scores."""
    docs = spark.createDataFrame([(1, "a b", "en", "x", 3), (2, None, None, "y", None)], "doc_id long, text string, lang string, source string, n_chars long")
    untrained = quality._unpacked(None)[0]
    passed = quality.score_documents(docs, untrained, extra=docs.columns)
    sent = passed._jdf.queryExecution().optimizedPlan().toString()
    assert sent.count("AS extra_") == 4
    assert sorted(r[4:] for r in passed.collect()) == sorted(tuple(r) for r in docs.collect())


def test_repeats_are_cut_without_sending_texts_twice(spark):
    """``unrepeated_text`` keeps all columns, and passes only those that it does not make anew."""
    long_text = "one passage of well over fifty bytes that stands in two documents"
    docs = spark.createDataFrame([(1, long_text, "en", 65), (2, "x " + long_text, "de", 67)], "doc_id long, text string, lang string, n_chars long")
    out = corpus_pipeline.unrepeated_text(spark, docs, "")
    assert out._jdf.queryExecution().analyzed().toString().count("AS extra_") == 3 * 2  # three passes, two columns
    assert sorted(map(tuple, out.collect())) == [(1, long_text, "en", 65), (2, "x ", "de", 2)]


def test_fit_reads_texts_in_place_and_orders_their_features():
    """Features of a table in pieces are those of the table in order."""
    n = 40
    text = [f"word{i} word{i % 7} shared " * (1 + i % 3) for i in range(n)]
    rows = pa.table({
        "id": pa.array(range(n), pa.int64()), "text": pa.chunked_array([text[:13], text[13:]]), "lang": ["en"] * n, "source": ["s"] * n,
        "n_chars": pa.array([len(t) for t in text], pa.int64()), "y": pa.array([i % 2 for i in range(n)], pa.int32()),
        "h": pa.array([(i * 29) % n for i in range(n)], pa.int64()), "held": [False] * n, "origin": pa.array([0] * n, pa.int32()),
    })
    order = np.argsort(rows.column("h").to_numpy())
    body, starts = text_bytes(pa.array([text[i] for i in order]))
    dense, slots, at, meta, y, _, _ = quality._collected(rows)
    for have, want in zip((dense, slots, at), quality.content_features(body, starts)):
        assert np.array_equal(have, want)
    assert np.array_equal(y, order % 2) and meta[:, 3].tolist() == quality.metadata_features(["en"] * n, ["s"] * n, [len(text[i]) for i in order])[:, 3].tolist()


def test_rounds_of_components_write_few_files(spark):
    """Links that fill one partition are not written as a file for each shuffle partition, in any round."""
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    shared_root(spark)
    root = Path(re.sub("^file:", "", spark.sparkContext.getCheckpointDir()))
    seen = set(root.rglob("part-*"))
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        edges = spark.range(40).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
        found = sorted(map(tuple, components(edges, nodes=41).collect()))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert found == [(i, 0) for i in range(41)]
    folders = Counter(p.parent for p in set(root.rglob("part-*")) - seen)
    assert folders and max(folders.values()) <= 8
