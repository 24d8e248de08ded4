"""Operators on documents against brute force, round trips and the public libraries, and their edge cases."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rowloom.llm import bpe_tokens, fingerprints, ngram_join, packing, private_data, quality, sentence_pieces, suffix_dedup
from rowloom.llm.common import components

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
random.seed(5)
WORDS = ["alpha", "beta", "gamma", "delta", "épsilon", "zeta", "eta", "theta", "iota", "kappa", "日本", "mu"]


def prose(n: int) -> str:
    return " ".join(random.choice(WORDS) + str(random.randint(0, 40)) for _ in range(n))


LONG = prose(60)
TEXTS = [
    (1, prose(50)), (2, LONG + " " + prose(20)), (3, prose(10) + " " + LONG + " end"), (4, LONG + " " + prose(20)), (5, None), (6, ""),
    (7, "short"), (8, "a" * 3000), (9, "b" + "a" * 300), (10, LONG), (10, LONG), (11, LONG.replace("alpha", "ALPHA")), (None, LONG + " last"),
    (12, "  \n\t "), (13, "x  y   z\n\n w"), (14, "one two three four"), (15, "One two  three\tfour"), (16, prose(4000)),
]


@pytest.fixture(scope="module")
def docs(spark):
    # Names that clash with what operators use inside.
    rows = [(i, t, "en", f"s{n % 3}", n, n, "x") for n, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, id long, `block` string")


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def cut_by_hand(rows, width=50):
    rows = [(float("inf") if i is None else i, (t or "").encode()) for i, t in rows]
    first: dict[bytes, float] = {}
    for i, b in rows:
        for s in range(len(b) - width + 1):
            w = b[s:s + width]
            first[w] = min(first.get(w, i), i)
    out = []
    for i, b in rows:
        gone = bytearray(len(b))
        for s in range(len(b) - width + 1):
            if first[b[s:s + width]] < i:
                gone[s:s + width] = b"\x01" * width
        spans = sum(1 for k in range(len(gone)) if gone[k] and (not k or not gone[k - 1]))
        out.append((None if i == float("inf") else i, len(b), sum(gone), spans, bytes(c for c, g in zip(b, gone) if not g)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_bytes", [2_000, 1 << 22])
def test_suffix_dedup_equals_brute_force(docs, block_bytes):
    got = suffix_dedup.remove_repeats(docs, block_bytes=block_bytes, sample_bytes=1000).collect()
    assert sorted([(r["id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got], key=repr) == cut_by_hand(TEXTS)
    for r in got:
        assert sum(e - b for b, e in zip(r["spans"][::2], r["spans"][1::2])) == r["n_removed"]


def test_suffix_dedup_of_random_strings_of_few_letters(spark):
    rows = [(i, "".join(random.choice("ab") * random.randint(1, 30) for _ in range(random.randint(0, 40)))) for i in range(60)]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), block_bytes=3000).collect()
    assert sorted([(r["id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got], key=repr) == cut_by_hand(rows)


def test_suffix_dedup_knows_the_last_repeated_stretch_of_a_block(spark):
    # One block: the last repeated stretch is the end of document 2, which also ends document 1 and no other; text of its own follows.
    passage, own = prose(12), "".join(random.choice("0123456789abcdef") for _ in range(400))
    rows = [(1, passage), (2, prose(5) + passage), (3, own)]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted([(r["id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got], key=repr) == cut_by_hand(rows)


@pytest.mark.parametrize("hot", [0, 3, 20])
@pytest.mark.parametrize("block_bytes", [2_000, 1 << 22])
def test_suffix_dedup_parts_hot_anchors_by_windows(docs, spark, hot, block_bytes):
    got = suffix_dedup.remove_repeats(docs, block_bytes=block_bytes, sample_bytes=1000, hot=hot).collect()
    assert sorted([(r["id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got], key=repr) == cut_by_hand(TEXTS)
    footer = " All rights reserved by the makers. "
    rows = [(i, "".join(random.choice("01") for _ in range(100)) + " x"[i % 2] + footer + "yz"[i % 2] + str(i)) for i in range(80)] + [(None, "v" + footer), (None, "v" + footer)]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), block_bytes=block_bytes, hot=hot).collect()
    assert sorted([(r["id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got], key=repr) == cut_by_hand(rows)


def test_suffix_dedup_bounds_what_a_task_compares():
    # A phrase of 40 bytes between different bytes: no bucket of stretches may hold them all.
    import pyarrow as pa

    phrase, blocks = "the licence of this page is told below. ", 16
    part = [pa.table({"id": range(b, 3200, blocks), "text": ["".join(random.choices("abcdefgh", k=60)) + phrase + "".join(random.choices("abcdefgh", k=60)) for _ in range(b, 3200, blocks)]}) for b in range(blocks)]
    key = [(pa.scalar(b),) for b in range(blocks)]
    sent = pa.concat_tables([suffix_dedup._send_hashes(50, blocks)(k, p) for k, p in zip(key, part)])
    to = [sent.filter(pa.array([x == b for x in sent.column("bucket").to_pylist()])) for b in range(blocks)]
    answers = pa.concat_tables([suffix_dedup._repeated(500)(t) for t in to if t.num_rows])
    splitters = np.array([bytes([c]) * 16 for c in range(97, 97 + blocks - 1)], "S16")
    windows = Counter()
    for b in range(blocks):
        mine = answers.filter(pa.array([x == b for x in answers.column("block").to_pylist()]))
        for r in suffix_dedup._send_suffixes(50, blocks, splitters)(key[b], part[b], mine).to_pylist():
            sizes = suffix_dedup.unpack(r["blob"])
            windows[r["bucket"]] += int(sizes[1].sum()) if r["bucket"] < blocks else len(sizes[0])
    assert max(windows.values()) < 3 * sum(windows.values()) / blocks


def test_suffix_dedup_deals_a_hot_id_over_blocks(spark):
    rows = [(None, prose(30)) for _ in range(200)]
    done = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), block_bytes=3000)
    assert {r["n_removed"] for r in done.collect()} == {0}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert done.select(F.spark_partition_id()).distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_suffix_dedup_of_nothing_and_text_of_cut_characters(spark, none):
    assert suffix_dedup.remove_repeats(none).collect() == []
    raw = "é日x�".encode()
    df = spark.createDataFrame([(bytearray(raw[1:]),), (bytearray(raw[:3]),), (bytearray(raw),), (bytearray(),)], "kept binary")
    assert [r[0] for r in df.select(suffix_dedup.as_valid_text(F.col("kept"))).collect()] == ["日x�", "é", "é日x�", ""]


def test_multikey_groups_equal_strings():
    rows = [tuple(random.choice([1, 2, 3]) for _ in range(4)) for _ in range(500)]
    a = np.array(rows, np.uint64)
    group = suffix_dedup.multikey(lambda level, which: a[which, level], len(a), 4)
    by = defaultdict(set)
    for g, r in zip(group.tolist(), rows):
        by[g].add(r)
    assert all(len(s) == 1 for s in by.values()) and len(by) == len(set(rows))
    assert [next(iter(by[g])) for g in sorted(by)] == sorted(set(rows))


def sets_by_hand(text):
    words = [w for w in re.split("[ \t\n\r\f\v]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")) if w]
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_similar_documents_equal_brute_force(docs, none):
    got = ngram_join.similar_documents(docs).collect()
    sets = [(i, sets_by_hand(t)) for i, t in TEXTS]
    n = len(sets)
    link = [[a != b and (sets[a][1] == sets[b][1] or 5 * len(sets[a][1] & sets[b][1]) >= 4 * len(sets[a][1] | sets[b][1])) for b in range(n)] for a in range(n)]
    want = []
    for a in range(n):
        seen, todo = {a}, [a]
        while todo:
            x = todo.pop()
            for y in range(n):
                if link[x][y] and y not in seen:
                    seen.add(y)
                    todo.append(y)
        ids = [sets[y][0] for y in seen if sets[y][0] is not None]
        want.append((sets[a][0], min(ids) if ids else None, sum(link[a]), sum(sets[a][1] == sets[b][1] for b in range(n)) - 1))
    assert sorted([tuple(r) for r in got], key=repr) == sorted(want, key=repr)
    assert ngram_join.similar_documents(none).collect() == []


def test_large_groups_are_split_and_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_CLASSES", 8)
    base = prose(300).split()
    rows = []
    for i in range(60):
        words = list(base)
        words[i * 5] = f"other{i}"
        rows.append((i, " ".join(words)))
    got = ngram_join.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["class_id"] for r in got} == {0} and {r["n_links"] for r in got} == {59}


def test_forest_depth_reaches_the_target():
    k = ngram_join.forest_depth(0.8, 32, 12, 0.9999)
    assert 1 - (1 - 0.8**k) ** 32 >= 0.9999 > 1 - (1 - 0.8 ** (k + 1)) ** 32


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 90)] + [(200, 200 + i) for i in range(1, 50)] + [(300, 300)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(91)) and all(got[200 + i] == 200 for i in range(50))
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


HARD = [
    "hello <|endoftext|> world", "<|endoftext|><|endoftext|>", "", " ", "   three   blanks ", "a\n\n b\t\tc \r\n", "it's we'll I'd 'S", "naïve 日本語 🙂🙂", "x" * 5000,
    "12345 6 789", "a  b", " lead", "trail ", "nbsp x  y", "a \nb", "\x1c a\x1f b", "mixed123abc!?.;  ok",
]


def test_token_counts_equal_the_library(spark, docs, none):
    library = Tokenizer.from_file(BPE)
    words = bpe_tokens.Vocabulary(BPE)
    texts = HARD + [t for _, t in TEXTS if t] + ["".join(random.choice("ab 1.\n'é") for _ in range(60)) for _ in range(300)]
    for text in texts + texts[::-1]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert words.count(text) == len(ids), text[:60]
        assert np.frombuffer(words.encode(text), "<u4").tolist() == ids, text[:60]
    got = bpe_tokens.count_tokens(docs, BPE).collect()
    want = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in TEXTS]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert bpe_tokens.count_tokens(none, BPE).collect() == []
    with pytest.raises(ValueError):
        bpe_tokens.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))


def test_pieces_equal_the_library():
    model, library = sentence_pieces.PieceModel(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = HARD + [t for _, t in TEXTS if t] + ["".join(random.choice("ab  ▁é🙂x\n") for _ in range(40)) for _ in range(300)] + ["a" * 300 + " " + "ab" * 200]
    for text, raw in zip(texts, model.encode(texts)):
        ids = library.encode(text)
        assert np.frombuffer(raw, "<i4").tolist() == ids, text[:60]
        assert model.decode(ids) == library.decode(ids)
    for ids in ([3 + 0xE6, 300, 3 + 0xFF], [3 + 0xE6, 3 + 0x97], [0, 300], [1, 2]):
        assert model.decode(ids) == library.decode(ids)


def test_unigram_search_finds_the_best_path():
    raw = sentencepiece.SentencePieceProcessor(model_file=PIECES).serialized_model_proto()
    at = raw.find(bytes([0x18, 2, 0x20]))
    model = sentence_pieces.PieceModel(proto=raw[:at] + bytes([0x18, 1]) + raw[at + 2:])
    assert not model.merging
    for word in ["▁therethe", "▁antidote", "▁onlyher", "▁naïveté"]:
        best = [0.0] + [-np.inf] * len(word)
        for i in range(1, len(word) + 1):
            best[i] = max(best[j] + model.scores[model.id_of[word[j:i]]] for j in range(i) if word[j:i] in model.id_of)
        for raw_ids in (model.search([word])[0], model.search_one(word)):
            ids = np.frombuffer(raw_ids, "<i4")
            assert sum(model.scores[i] for i in ids) == pytest.approx(best[-1]) and "".join(model.name[i] for i in ids) == word


def test_pieces_of_a_table(docs, none):
    done = sentence_pieces.decode_pieces(sentence_pieces.encode_pieces(docs, PIECES), PIECES)
    for r in done.collect():
        assert (r["decoded"], r["ids"] is None) == (r["text"], r["text"] is None)
    assert sentence_pieces.decode_pieces(sentence_pieces.encode_pieces(none, PIECES), PIECES).collect() == []


def test_packing_is_gapless_and_near_its_bound(docs, none):
    got = packing.pack_documents(docs, BPE, 64).collect()
    library = Tokenizer.from_file(BPE)
    sequences, by = defaultdict(list), defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        by[r["id"]].append(r)
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(r["length"] for r in got)
    assert len(sequences) <= -(-total // 64) + 1
    for i, t in TEXTS:
        if i == 10:
            continue  # stands twice
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        pieces = sorted(by[i], key=lambda r: r["piece"])
        assert [p["piece"] for p in pieces] == list(range(len(pieces))) and all(p["length"] == 64 for p in pieces[1:])
        at = 0
        for p in pieces:
            assert p["start"] == at and zlib.crc32(ids[at:at + p["length"]].tobytes()) == p["ids_crc32"]
            at += p["length"]
        assert at == len(ids)
    assert packing.pack_documents(none, BPE).collect() == []


def test_best_fit_decreasing_and_bounds():
    rng = np.random.default_rng(1)
    for _ in range(60):
        capacity = int(rng.integers(5, 60))
        lengths = rng.integers(1, capacity + 1, int(rng.integers(1, 120)))
        sequence, offset = packing.best_fit_decreasing(lengths, capacity)
        room: list[int] = []
        for size in sorted(lengths.tolist(), reverse=True):  # one by one
            fits = [(r, k) for k, r in enumerate(room) if r >= size]
            if fits:
                room[min(fits)[1]] -= size
            else:
                room.append(capacity - size)
        assert len(room) == sequence.max() + 1
        load = np.bincount(sequence, weights=lengths)
        assert load.max() <= capacity
        for s in range(len(load)):
            of = np.flatnonzero(sequence == s)
            of = of[np.argsort(offset[of])]
            assert (offset[of] == np.concatenate([[0], np.cumsum(lengths[of])[:-1]])).all()
        assert packing.lower_bound(*np.unique(lengths, return_counts=True), capacity) <= len(room)
    assert packing.lower_bound(np.array([33]), np.array([10]), 64) == 10


def test_partitions_with_gaps_exchange(spark, monkeypatch):
    monkeypatch.setattr(packing, "TASK_PIECES", 40)
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(int(n),) for n in rng.integers(1, 100, 600)], "n long")
    got = packing.pack(df, "n", 100).collect()
    alone = [packing.best_fit_decreasing(np.array([r["n"] for r in got]), 100)[0].max() + 1, packing.lower_bound(*np.unique([r["n"] for r in got], return_counts=True), 100)]
    assert len(got) == 600 and len({r["sequence_id"] for r in got}) <= alone[0] + 2 and alone[0] >= alone[1]
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(0,)], "n long"), "n", 100)


def base_by_hand(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    return {
        "email": [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)],
        "ip": [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m.group().split("."))],
        "card": [m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 13 <= len(digits(m.group())) <= 19 and private_data.luhn(digits(m.group()))],
        "phone": [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(digits(m.group())) <= 15],
    }


def test_exact_kinds_equal_their_patterns():
    for _ in range(4000):
        t = "".join(random.choice("ab1290@.-+ ()%é\n1.5") for _ in range(random.randint(0, 60)))
        assert private_data.base_spans(t) == base_by_hand(t), t
    for t in ["4111 1111 1111 1111 4111-1111-1111-1111", "+1 (222) 333-4444+49 30 1234567", "1.2.3.4.5.6.7.8 300.1.1.1 001.002.003.0004"]:
        assert private_data.base_spans(t) == base_by_hand(t)
    # No time beyond the length of a text.
    for t in ("a" * 300_000, "1" * 300_000, "+1" * 100_000, "a@" * 100_000, "1." * 100_000):
        private_data.base_spans(t)
        private_data.proposals(t)


def test_trees_calibration_and_redaction(spark, none):
    rng = np.random.default_rng(4)
    x = rng.random((3000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    margin = private_data.fit_trees(x[:2000], y[:2000]).margin(x[2000:])
    assert ((margin > 0) == y[2000:]).mean() > 0.95
    edges, shares = private_data.calibrate(margin, y[2000:])
    assert (np.diff(shares) > 0).all() and (np.diff(edges) > 0).all()
    rows = []
    for i in range(1500):
        secret = "".join(random.choice("0123456789abcdef") for _ in range(40))
        word = "".join(random.choice("abcdefgh") for _ in range(9)) + str(i)
        rows.append((i, f'some words token = "{secret}" and {word}abcdefg here, mail a.b{i}@x.example.com' if i % 2 else f"plain words {word}mnopqrstu only {i}"))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = private_data.fit_private(df)
    assert np.isfinite(model.thresholds[private_data.KINDS.index("secret")])
    out = {r["doc_id"]: r for r in private_data.redact(df, model).collect()}
    assert sum("[SECRET]" in out[i]["text"] for i in range(1, 1500, 2)) > 700
    assert not any("[" in out[i]["text"] for i in range(0, 1500, 2))
    assert all("[EMAIL]" in out[i]["text"] and "@" not in out[i]["text"] for i in range(1, 1500, 2))
    few = private_data.fit_private(none)
    assert private_data.redact(none, few).collect() == []
    assert private_data.redacted("x 1.2.3.4 y", [("ip", 2, 9)]) == "x [IP] y"
    nulls = spark.createDataFrame([(1, None), (2, ""), (None, "a@b.cd")], "doc_id long, text string")
    assert [r["text"] for r in private_data.redact(nulls, few).orderBy(F.asc_nulls_last("doc_id")).collect()] == [None, "", "[EMAIL]"]


def test_rare_secrets_get_a_threshold_among_many_numbers(spark):
    # Proposals of numbers use up any sample of all kinds; one document in forty holds a secret.
    rng = random.Random(8)
    rows = []
    for i in range(4000):
        numbers = " ".join(str(rng.randint(10**6, 10**9)) + "," for _ in range(8))
        secret = "".join(rng.choice("0123456789abcdef") for _ in range(40))
        rows.append((i, f'{numbers} token = "{secret}" end' if i % 40 == 0 else f"{numbers} plain item{i}abcdefghij end"))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = private_data.fit_private(df, max_candidates=1200)
    assert np.isfinite(model.thresholds[private_data.KINDS.index("secret")])
    out = {r["doc_id"]: r["text"] for r in private_data.redact(df, model).collect()}
    assert sum("[SECRET]" in out[i] for i in range(0, 4000, 40)) >= 95
    assert not any("[SECRET]" in out[i] for i in range(4000) if i % 40)


def test_trees_find_what_the_patterns_do_not(spark):
    rng = random.Random(9)
    number = lambda: f"{rng.randint(20, 99)} {rng.randint(100, 999)} {rng.randint(1000, 9999)}-{rng.randint(10, 99)}"
    rows = []
    for i in range(2000):
        name, host = rng.choice(["ann", "j.doe", "sales"]) + str(rng.randint(1, 99)), f"mail{rng.randint(1, 9)}.example.com"
        rows.append((i, [
            f"words of {name}@{host} and +{number()} end, dated {rng.randint(10**5, 10**8)} so",
            f"words of {name} (at) {host} and {number()} end, dated {rng.randint(10**5, 10**8)} so",
            f"we meet (at) noon, dated {rng.randint(10**5, 10**8)} or {rng.randint(10**15, 10**16)} so",
            'a token = "' + "".join(rng.choice("0123456789abcdef") for _ in range(300)) + '" there',
        ][i % 4]))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = private_data.fit_private(df)
    out = {r["doc_id"]: r["text"] for r in private_data.redact(df, model).collect()}
    assert sum("[CONTACT]" in out[i] for i in range(1, 2000, 4)) >= 490 and sum("[NUMBER]" in out[i] for i in range(1, 2000, 4)) >= 490
    assert sum("[CONTACT]" in out[i] or "[NUMBER]" in out[i] for i in range(2, 2000, 4)) <= 10
    # A run longer than a proposal goes as a whole.
    assert sum(re.search("[0-9a-f]{12}", out[i]) is None for i in range(3, 2000, 4)) >= 490


def test_cotraining_holds_out_of_sample(spark, sf, none):
    docs = spark.read.parquet(f"{sf.replace('0.001', '0.1')}/documents.parquet")
    labels = spark.read.parquet(f"{sf.replace('0.001', '0.1')}/labels.parquet")
    known = labels.where("doc_id % 2 = 0")
    scores = {r["id"]: r["score"] for r in quality.score_documents(docs, quality.fit_cotraining(docs, known)).collect()}
    test = labels.where("doc_id % 2 = 1").collect()
    good = [scores[r["doc_id"]] >= 0.5 for r in test if r["quality"] == 1 and r["toxic"] == 0]
    junk = [scores[r["doc_id"]] >= 0.5 for r in test if r["quality"] == 0]
    toxic = [scores[r["doc_id"]] >= 0.5 for r in test if r["quality"] == 1 and r["toxic"] == 1]
    assert np.mean(good) > 0.97 and np.mean(junk) < 0.05 and np.mean(toxic) < 0.3
    untrained = quality.fit_cotraining(docs, labels.limit(5))
    assert not untrained.trained
    assert {r["score"] for r in quality.score_documents(docs.limit(5), untrained).collect()} == {1.0}
    assert quality.score_documents(none, untrained).collect() == []
    assert not quality.fit_cotraining(none, labels).trained
    odd = spark.createDataFrame([(1, None, None), (None, "x", 3)], "doc_id long, text string, n_chars long")
    assert len(quality.score_documents(odd, quality.fit_cotraining(docs, known)).collect()) == 2


def test_fingerprints(spark, docs, none):
    got = fingerprints.edited_fingerprints(docs.where("doc_id is null or doc_id <> 10")).collect()
    rows = sorted([(-1 if i is None else i, t or "") for i, t in TEXTS if i != 10], reverse=True)
    by = {-1 if r["id"] is None else r["id"]: r for r in got}
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)]
        cut = len(t) // 3
        assert by[i]["edited_sha256"] == hashlib.sha256((t[:len(t) - cut] + after[1][:cut]).encode()).hexdigest()
        assert by[i]["n_chars"] == len(t)
        differ = bin(int(by[i]["fingerprint"], 16) ^ int(by[after[0]]["fingerprint"], 16)).count("1")
        assert by[i]["near_next"] == pytest.approx(1 - differ / fingerprints.BITS)
        others = {r["fingerprint"] for r in got} - {by[i]["fingerprint"]}
        assert by[i]["n_within"] == sum(bin(int(by[i]["fingerprint"], 16) ^ int(o, 16)).count("1") <= fingerprints.RADIUS for o in others)
    assert by[5]["fingerprint"] == by[6]["fingerprint"] == "0" * 32
    assert fingerprints.edited_fingerprints(none).collect() == []
    assert len(fingerprints.edited_fingerprints(docs.where("doc_id = 10")).collect()) == 2
    spread = spark.createDataFrame([(i * 700, f"text number {i} of many") for i in range(9)], "doc_id long, text string")
    assert len(fingerprints.edited_fingerprints(spread).collect()) == 9


@pytest.mark.parametrize("bucket", [4, 256])
def test_all_fingerprints_within_a_radius(spark, monkeypatch, bucket):
    monkeypatch.setattr(fingerprints, "BUCKET_PRINTS", bucket)
    rng = np.random.default_rng(6)
    base = [int(v) for v in rng.integers(0, 1 << 62, 40)]
    rows = set()
    for b in base:
        for _ in range(5):
            high, low = b, b ^ 12345
            for bit in rng.integers(0, 126, int(rng.integers(0, 7))):
                if bit < 63:
                    high ^= 1 << int(bit)
                else:
                    low ^= 1 << int(bit - 63)
            rows.add((high, low))
    rows = sorted(rows)
    df = spark.createDataFrame([*rows, *rows[:5]], "high long, low long")
    name = lambda r: f"{r[0]:016x}{r[1]:016x}"
    want = set()
    for i, a in enumerate(rows):
        for b in rows[i + 1:]:
            d = bin(a[0] ^ b[0]).count("1") + bin(a[1] ^ b[1]).count("1")
            if d <= 5:
                want.add((name(a), name(b), d))
    got = [(r["a"], r["b"], r["distance"]) for r in fingerprints.within_radius(df, 5).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    counted = {name(r): r[2] for r in fingerprints.count_within_radius(df, 5).collect()}
    assert counted == Counter(x for a, b, _ in want for x in (a, b))
    assert fingerprints.count_within_radius(df.limit(0), 5).collect() == []
