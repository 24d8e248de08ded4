"""The conversation trie, collocations and the attention model against brute force and their defining properties."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rowloom.llm import attention_lm as lm
from rowloom.llm import collocations as col
from rowloom.llm import common
from rowloom.llm import conversation_trie as trie

PATH = public_tokenizers.path("byte_bpe_50k.json")


# ---- conversation trie

def rebuilt(rows):
    """Conversations by id: turns in order, the first ones those of the hundred's first conversation."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def trie_of(conversations):
    members = defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = set()
    for node, of in members.items():
        below = [m for m in members if m[:len(node)] == node]
        children = [m for m in below if len(m) == len(node) + 1]
        leaves = [m for m in below if not any(o[:len(m)] == m and len(o) == len(m) + 1 for o in below)]
        saved = sum((len(members[m]) - 1) * (len(m[-1][1]) if m else 0) for m in below)
        ends = ",".join(str(c) for c in sorted(c for c in of if len(conversations[c]) == len(node)))
        out.add((min(of), len(node), min(members[node[:-1]]) if node else None, len(of), len(children), len(leaves), saved,
                 hashlib.sha256(ends.encode()).hexdigest()))
    return out


def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_trie_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = []
    for c in [*range(0, 12), 100, 101, 107, 250, 251, -3, 10**15]:
        for t in range(int(rng.integers(1, 30))):
            rows.append((c, t, str(rng.choice(["user", "assistant"])), str(rng.choice(["a", "bé", "𝄞c", ""]))))
    # Null turn, role and text, equal turns, repeated rows, copies of a conversation, a conversation without id.
    rows += [(5, None, None, None), (5, None, "user", "x"), (6, 2, "user", "z"), (6, 2, "user", "z"), (None, 0, "user", "lost")]
    rows += [(300 + k, t, "user", "same") for k in range(40) for t in range(20)]
    got = trie.prefix_trie(*trie.with_shared_openings(trie.placed_turns(conversations(spark, rows))))
    got_rows = [tuple(r) for r in got.collect()]
    assert len(got_rows) == len(set(got_rows))
    assert set(got_rows) == trie_of(rebuilt(rows))


def test_trie_of_given_conversations_and_of_none(spark):
    rows = [(1, 0, "user", "hi"), (2, 0, "user", "hi"), (2, 1, "assistant", "yo")]
    clash = conversations(spark, rows).withColumn("place", F.lit("x")).withColumn("k0", F.lit(None).cast("string"))
    got = {tuple(r) for r in trie.conversation_trie(clash).collect()}
    assert got == trie_of({1: [("user", "hi")], 2: [("user", "hi"), ("assistant", "yo")]})
    assert trie.conversation_trie(conversations(spark, [])).collect() == []


def test_ends_of_one_node_span_rows_and_batches(spark, monkeypatch):
    monkeypatch.setattr(trie, "IDS_A_ROW", 7)
    got = trie.conversation_trie(conversations(spark, [(c, 0, "u", "t") for c in range(500)])).where("depth = 1").first()
    assert got["ends_sha256"] == hashlib.sha256(",".join(map(str, range(500))).encode()).hexdigest()
    assert (got["n_convs"], got["saved_tokens"]) == (500, 499)


# ---- collocations

def phrases_of(docs, min_count, top, percent=100):
    f, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, 6):
                for i in range(len(words) - m + 1):
                    f[lang][tuple(words[i:i + m])] += 1
    out = []
    for lang, counts in f.items():
        frequent = {p: a for p, a in counts.items() if len(p) > 1 and a >= min_count}
        rows = []
        for p, a in frequent.items():
            score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            inside = any(
                len(q) > len(p) and 100 * b >= percent * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in frequent.items()
            )
            if not inside:
                rows.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def texts(spark, rows):
    return spark.createDataFrame(rows, "lang string, text string")


def made_up(seed, n=60):
    rng = np.random.default_rng(seed)
    vocabulary = ["the", "of", "The", "red fox", "in New York, city", "a b c d e f", "é\tü", "x", "stop.", "go\nnow", "||", "日本"]
    rows = [(str(rng.choice(["en", "fr"])), " ".join(rng.choice(vocabulary, int(rng.integers(0, 60))))) for _ in range(n)]
    return rows + [(None, "null lang here null lang here"), ("en", None), ("en", ""), ("und", "null lang here")] + rows[:5]


@pytest.mark.parametrize("group_rows", [5, 100_000])
def test_collocations_equal_brute_force(spark, group_rows):
    """With a tiny budget prefixes of every length are extended, and equal suffixes beyond it become one row."""
    docs = made_up(1)
    got = col.collocations(texts(spark, docs).withColumn("word", F.lit(1)), 3, 5, 30, group_rows=group_rows)
    assert sorted(tuple(r) for r in got.collect()) == phrases_of(docs, 3, 30)


def test_collocations_absorb_by_share_and_give_nothing_for_nothing(spark):
    docs = made_up(2)
    got = col.collocations(texts(spark, docs), 3, 5, 1000, absorb_percent=60)
    assert sorted(tuple(r) for r in got.collect()) == phrases_of(docs, 3, 1000, 60)
    assert col.collocations(texts(spark, [])).collect() == []
    assert col.collocations(texts(spark, docs), min_count=10**6).collect() == []


def test_long_texts_are_parted_without_loss(spark, monkeypatch):
    monkeypatch.setattr(common, "CHUNK_BYTES", 64)
    docs = [("en", t) for _, t in made_up(3, 12)] + [("en", "one two three " * 80), ("en", "w" * 500 + " one two " + "v" * 300)]
    got = col.collocations(texts(spark, docs), 3, 5, 1000)
    assert sorted(tuple(r) for r in got.collect()) == phrases_of(docs, 3, 1000)


def test_scores_stay_exact_beyond_64_bits(spark):
    a, n, left, right = 3 * 10**11, 9 * 10**13 + 7, 4 * 10**11 + 1, 5 * 10**12 + 3
    row = spark.range(1).select(*[F.lit(v).cast("long").alias(c) for c, v in zip("anlr", (a, n, left, right))])
    wide = {c: f"cast({c} AS decimal(19, 0))" for c in "anlr"}
    got = row.select(F.expr(f"(cast(1000 AS decimal(4, 0)) * {wide['a']} * {wide['n']}) div ({wide['l']} * {wide['r']})").alias("s")).first()["s"]
    assert got == 1000 * a * n // (left * right)


# ---- attention model

@pytest.fixture(scope="module")
def pairs():
    rng = np.random.default_rng(5)
    return lm.log_pairs(rng.random((lm.SLOTS, lm.SLOTS)), rng.random(lm.SLOTS), rng.random(lm.SLOTS), 3)


def some_weights(seed=0):
    return (np.random.default_rng(seed).standard_normal(lm.SIZE) * 0.2).astype(np.float64)


def test_gradient_is_that_of_the_loss(pairs):
    rng = np.random.default_rng(1)
    flat, after = some_weights(), pairs.astype(np.float64)
    batch = rng.integers(0, lm.SLOTS, size=(3, lm.WINDOW + 1))
    batch[1, 9:] = lm.NOTHING
    _, grad = lm.gradient(flat, after, batch)
    at = 0
    for name, shape in lm.SHAPES.items():
        n = int(np.prod(shape))
        for i in at + rng.integers(0, n, 4):
            step = np.zeros_like(flat)
            step[i] = 1e-5
            slope = (lm.gradient(flat + step, after, batch)[0] - lm.gradient(flat - step, after, batch)[0]) / 2e-5
            assert abs(slope - grad[i]) < 1e-5 * (1 + abs(slope)), name
        at += n


def test_probabilities_sum_to_one_and_ignore_what_comes_later(pairs):
    flat = some_weights(2).astype(np.float32)
    w = lm.views(flat)
    ids = np.random.default_rng(0).integers(0, lm.SLOTS, size=(1, lm.WINDOW))
    hidden, _ = lm._attend(w, ids)
    for place in (0, 5, lm.WINDOW - 1):
        every = np.arange(lm.SLOTS)
        p = np.exp(lm.log_probabilities(w, lm.offsets(w, pairs), np.repeat(hidden[place:place + 1], lm.SLOTS, 0), np.full(lm.SLOTS, ids[0, place]), every))
        assert abs(p.sum() - 1) < 1e-4
    changed = ids.copy()
    changed[0, 6:] = (changed[0, 6:] + 1) % lm.SLOTS
    assert np.allclose(lm._attend(w, changed)[0][:6], hidden[:6], atol=1e-5)


def test_windows_score_each_token_once_with_the_context_they_have(pairs):
    flat = some_weights(3).astype(np.float32)
    w = lm.views(flat)
    rng = np.random.default_rng(4)
    sizes = [0, 1, 5, lm.WINDOW, lm.WINDOW + 1, 100, lm.WINDOW + 2 * lm.STRIDE]
    starts = np.concatenate([[0], np.cumsum(sizes)])
    inputs, targets = rng.integers(0, lm.SLOTS, starts[-1]), rng.integers(0, lm.SLOTS, starts[-1])
    added = lm.offsets(w, pairs)
    got = lm._window_scores(w, added, inputs, targets, starts, np.zeros(len(sizes), int))
    for a, b in zip(starts[:-1], starts[1:]):
        for t in range(b - a):
            begin = 0 if t < lm.WINDOW else ((t - lm.WINDOW) // lm.STRIDE + 1) * lm.STRIDE
            ids = np.full((1, lm.WINDOW), 0)
            ids[0, :t - begin + 1] = inputs[a + begin:a + t + 1]
            hidden = lm._attend(w, ids)[0][t - begin:t - begin + 1]
            want = lm.log_probabilities(w, added, hidden, inputs[a + t:a + t + 1], targets[a + t:a + t + 1])[0]
            assert abs(got[a + t] - want) < 1e-3


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def plain_base(rows):
    train = [t or "" for i, t in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2]
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)) + [None]
    count = Counter(w for t in train for w in split(t))
    n, v = sum(count.values()), len(count)
    out = []
    for i, t in rows:
        words = split(t or "")
        base = sum(np.log10((count[w] + 1) / (n + v + 1)) for w in words)
        out.append((i, len(words), sum(count[w] > 0 for w in words), round(float(base), 6)))
    return n, sorted(out, key=repr)


def learned(spark, rows):
    docs = documents(spark, rows).withColumn("row", F.lit("clash")).withColumn("score", F.lit(0))
    model = lm.fit_language_model(docs.where(~lm.held_out(F.col("doc_id"))).select("text"), PATH)
    return model, lm.score_texts(docs, model).collect()


def sentences(n, seed=0):
    rng = np.random.default_rng(seed)
    parts = ["the", "red", "Fox", "jumps", "over", "lazy", "dogs.", "été", "<|endoftext|>", "x" * 70]
    return [(i, " ".join(rng.choice(parts, int(rng.integers(0, 40))))) for i in range(n)]


@pytest.mark.parametrize("frequent", [1 << 18, 3, 0])
def test_word_scores_equal_brute_force(spark, monkeypatch, frequent):
    monkeypatch.setattr(lm, "FREQUENT_WORDS", frequent)
    monkeypatch.setattr(lm, "SPREAD", 100)
    rows = sentences(80) + [(None, "no id here"), (7, None), (8, ""), (9, " \t\n"), (3, "the red"), (3, "the red")]
    model, got = learned(spark, rows)
    n, want = plain_base(rows)
    assert model.n_tokens == n
    assert sorted(((r["id"], r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in got), key=repr) == want
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in got)
    same = [r["score"] for r in got if r["id"] == 3 and r["n_tokens"] == 3]
    assert len(same) == 2 and same[0] == same[1]


def test_attention_tells_more_than_pairs_on_held_out_texts(spark):
    """Words depend on the word two before, which pairs of subwords do not see."""
    rng = np.random.default_rng(9)
    rows = []
    for i in range(400):
        words = [str(rng.choice(["red", "blue"])), str(rng.choice(["fox", "dog"]))]
        for _ in range(30):
            words.append({"red": "fox", "blue": "dog", "fox": "blue", "dog": "red"}[words[-2]])
        rows.append((i, " ".join(words)))
    model, got = learned(spark, rows)
    score = {r["id"]: r["score"] for r in got}
    out = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 7 == 2]
    model.weights = lm.first_weights()
    alone = {r["id"]: r["score"] for r in lm.score_texts(documents(spark, rows), model).collect()}
    base = {r["id"]: r["base_score"] for r in got}
    assert sum(score[i] for i in out) > 0.5 * sum(alone[i] for i in out)
    assert sum(score[i] for i in out) > 0.5 * sum(base[i] for i in out)


def test_model_of_no_text_and_of_an_empty_table(spark):
    model = lm.fit_language_model(documents(spark, []).select("text"), PATH)
    assert lm.score_texts(documents(spark, []), model).collect() == []
    row = lm.score_texts(documents(spark, [(1, "a b")]), model).first()
    assert (row["n_tokens"], row["n_known"], row["base_score"]) == (3, 0, 0.0) and np.isfinite(row["score"])


def test_long_text_keeps_its_tokens_over_its_parts(spark, monkeypatch):
    monkeypatch.setattr(lm, "SPREAD", 2000)
    rows = sentences(30) + [(100, "the red fox jumps over lazy dogs. " * 60)]
    model, whole = learned(spark, rows)
    monkeypatch.setattr(common, "CHUNK_BYTES", 50)
    parted = lm.score_texts(documents(spark, rows), model).collect()
    for a, b in zip(sorted(whole, key=lambda r: r["id"]), sorted(parted, key=lambda r: r["id"])):
        assert (a["id"], a["n_tokens"], a["n_known"]) == (b["id"], b["n_tokens"], b["n_known"])
        assert abs(a["base_score"] - b["base_score"]) < 1e-6
        assert abs(a["score"] - b["score"]) < 0.05 * abs(a["score"]) + 0.5


# ---- mended operators

def test_parts_give_the_identifiers_of_the_library(monkeypatch):
    """Blanks, line ends, white space beyond ASCII, special strings, repeated and empty texts; a table that is often emptied."""
    import random

    from tokenizers import Tokenizer

    from rowloom.llm import bpe_parts

    draw = random.Random(1)
    pieces = ["a", "B", " ", "  ", "\n", "\t", "é", "日", " ", "　", " ", "\x1c", "\x85", ".", "'s", "1", "<|endoftext|>", "𝄞", " the", " of", "ã\xa0"]
    docs = ["".join(draw.choice(pieces) for _ in range(draw.randint(0, 30))) for _ in range(3000)] + ["", None, " ", "a", "a ", "x" * 50_000]
    monkeypatch.setattr(bpe_parts, "STRETCH_BYTES", 3000)
    monkeypatch.setattr(bpe_parts, "MOST_PARTS", 500)
    table = bpe_parts.PartTable(bpe_parts.vocabulary(PATH))
    got = [ids[a:b - 1].tolist() for _, ids, at in table.encode(pa.array(docs)) for a, b in zip(at[:-1], at[1:])]
    want = [e.ids for e in Tokenizer.from_file(PATH).encode_batch([d or "" for d in docs], add_special_tokens=False)]
    assert got == want


def test_addresses_with_thousands_of_zeros():
    from rowloom.llm.private_data import base_spans

    long = "0" * 5000 + ".1.1.1"
    assert base_spans(long)["ip"] == [(0, len(long))]
    assert base_spans("0" * 5000 + "256.1.1.1")["ip"] == []
    assert base_spans("9" * 5000 + ".1.1.1")["ip"] == []
    assert base_spans("000.0.00.255")["ip"] == [(0, 12)]


def test_documents_without_id_send_each_text_once(spark):
    from rowloom.llm import ngram_join

    rows = [(None, f"text {i} " + "word " * (i % 7)) for i in range(60)] + [(None, "text 1 word ")] * 3
    docs = spark.createDataFrame(rows, "id long, text string").withColumn("mark", F.xxhash64("text"))
    members = docs.groupBy("text").agg(F.min("id").alias("rep"), F.min("mark").alias("rep_mark")).drop("text")
    assert ngram_join.with_texts(members, docs).count() == len(rows)
    got = ngram_join.similar_documents(docs.select(F.col("id").alias("doc_id"), "text")).collect()
    assert len(got) == len(rows) and {r["class_id"] for r in got} == {None}


@pytest.mark.parametrize("ids", [lambda i: i * (2**63 // 400) - 2**62, lambda i: i, lambda i: (-1) ** i * 2**62 + i, lambda i: None if i % 5 == 0 else i])
def test_next_document_of_sparse_and_missing_ids(spark, monkeypatch, ids):
    from rowloom.llm import fingerprints

    monkeypatch.setattr(fingerprints, "SLICE", 8)
    monkeypatch.setattr(fingerprints, "GROUP", 4)
    rows = [(ids(i), f"text {i}") for i in range(300)]
    got = fingerprints.with_next(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text")[0]
    # The last row of the last slice gets the first text of all, so each text follows one other.
    nexts = {r["text"]: r["next_text"] for r in got.collect()}
    assert sorted(nexts.values()) == sorted(t for _, t in rows)
    order = sorted(((i, t) for i, t in rows if i is not None), reverse=True)
    assert all(nexts[a[1]] == b[1] for a, b in zip(order[:-1], order[1:]))


def test_the_whole_chain_equals_brute_force_on_what_each_stage_got(spark, sf):
    import corpus_pipeline
    from tokenizers import Tokenizer

    from rowloom.llm import private_data

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES:
        path = corpus_pipeline.shared_path(spark, "chain")
        stage(spark, kept[-1], sf).write.parquet(path)
        kept.append(spark.read.parquet(path))
    good, unlike, cut, clean = ({r["doc_id"]: r["text"] or "" for r in df.collect()} for df in kept[1:5])

    # Near duplicates: the least id of each class that is linked by five-word shingles at 0.8.
    sets = {}
    for i, t in good.items():
        w = re.sub("[A-Z]", lambda m: m[0].lower(), t).split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    least = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if least[b] < least[a] and (sets[a] == sets[b] or 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])):
                    least[a], changed = least[b], True
    assert unlike == {i: good[i] for i in good if least[i] == i}

    # Repeated passages: every byte of a 50-byte string that a document of smaller id has.
    seen = set()
    for i in sorted(unlike):
        raw = unlike[i].encode()
        windows = [raw[k:k + 50] for k in range(len(raw) - 49)]
        gone = np.zeros(len(raw) + 1, bool)
        for k, w in enumerate(windows):
            if w in seen:
                gone[k:k + 50] = True
        left = bytes(b for b, g in zip(raw, gone) if not g)
        try:
            assert cut[i] == left.decode()
        except UnicodeDecodeError:
            assert abs(len(cut[i].encode()) - len(left)) < 64
        seen.update(windows)
    assert set(cut) == set(unlike)

    # Personal data: no exact match is left as it was, and texts without any proposal stay.
    assert set(clean) == set(cut)
    for i, t in cut.items():
        for spans in private_data.base_spans(t).values():
            assert all(t[a:b] not in clean[i] for a, b in spans if b - a > 8)
        if not private_data.proposals(t) and not any(private_data.base_spans(t).values()):
            assert clean[i] == t

    # Packing: all tokens and an end, in gapless sequences; the whole run gives the same pieces.
    rows = kept[5].collect()
    library = Tokenizer.from_file(PATH)
    tokens = {i: len(library.encode(t, add_special_tokens=False).ids) + 1 for i, t in clean.items()}
    total, places = Counter(), defaultdict(list)
    for r in rows:
        total[r["doc_id"]] += r["length"]
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    assert dict(total) == tokens
    for pieces in places.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    piece = lambda rs: sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rs)
    assert piece(corpus_pipeline.run(spark, sf).collect()) == piece(rows)
