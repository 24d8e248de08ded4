"""Whole training of the language model, and what collocations send."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowloom.llm import attention_lm as lm
from rowloom.llm.queries import BYTE_BPE, public_tokenizers

PATH = public_tokenizers.path(BYTE_BPE)


@pytest.mark.parametrize("shift", [0, 5, lm.WINDOW - 1])
@pytest.mark.parametrize("closes", [True, False])
def test_every_slot_is_a_target_once(shift, closes):
    sizes = [0, 1, lm.WINDOW - 1, lm.WINDOW, lm.WINDOW + 1, 100]
    at = np.concatenate([[0], np.cumsum(sizes)])
    slots = np.arange(1, at[-1] + 1)
    rows = lm.training_windows(slots, at, 777, closes, shift).astype(int)
    seen = []
    for row in rows:
        told = row[1:] != lm.NOTHING
        assert told.any() and told[:told.sum()].all()
        seen += zip(row[:-1][told].tolist(), row[1:][told].tolist())
    want = []
    for i, j in zip(at[:-1], at[1:]):
        whole = [777, *slots[i:j].tolist(), *([lm.END] if closes else [])]
        want += zip(whole[:-1], whole[1:])
    assert seen == want


def test_minibatches_hold_every_place_of_all_texts(spark):
    """Beyond some 100 kB, spans of 128 bytes would lie apart and their windows would leave places out."""
    texts = [" ".join(f"w{(i * 31 + j * 7) % 900}" for j in range(2000)) for i in range(60)]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3).cache()
    model = lm.fit_language_model(df, PATH)
    spelled = lm._spelled_words(lm.word_table(df), PATH)
    slots = lm._subword_counts(spelled, lm.vocabulary_size(PATH)).sum() + len(texts)
    for passes in (1, 2):
        got = lm._minibatches(df, PATH, model.slot_of, model.frequent, passes, 256).collect()
        windows = np.concatenate([np.frombuffer(r["windows"], np.uint16).reshape(-1, lm.WINDOW + 1) for r in got])
        assert (windows[:, 1:] != lm.NOTHING).sum() == passes * slots
        assert (windows[:, 1:] == lm.END).sum() == passes * len(texts)
        assert {r["round"] for r in got} == set(range(lm.ROUNDS))


def test_long_text_in_parts_is_trained_whole(spark, monkeypatch):
    from rowloom.llm import common
    text = " ".join(f"w{i % 300}" for i in range(3000))
    df = spark.createDataFrame([(text,)], "text string")
    model = lm.fit_language_model(df, PATH)
    monkeypatch.setattr(common, "CHUNK_BYTES", 1000)
    import pyarrow as pa
    seen = []
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, run, schema: seen.extend(run(iter([pa.record_batch([pa.array([text])], names=["t"])]))) or self)
    lm._minibatches(df, PATH, model.slot_of, model.frequent, 1, 32)
    windows = np.concatenate([np.frombuffer(w.as_py(), np.uint16).reshape(-1, lm.WINDOW + 1) for b in seen for w in b.column(1)])
    words, at = lm._spelled(PATH, pa.array([f"w{i % 300}" for i in range(3000)]), model.slot_of)
    assert (windows[:, 1:] != lm.NOTHING).sum() == len(words) + 1
    assert (windows == lm.END).sum() == 2
