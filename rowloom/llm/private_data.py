"""Personal data: exact patterns, and candidates chosen by gradient boosted trees with calibrated thresholds.

Four kinds follow fixed patterns and checks and are always redacted. Beyond them generators propose overlapping spans
with high recall: anything around an ``@`` or a spelled-out one, runs of digits with separators, and strings that mix
digits and letters. Boosted trees score each proposal by its format and context. They learn from the corpus what the
patterns do not match: exact addresses are also shown spelled out, exact phone numbers without their plus, and addresses cut
to one name as what is none. A spelled-out address is positive where the address it spells passes the exact check, a number
without plus where it reads as a phone number after a word for phones, a secret after a name such as ``token``; the words that
label are no feature. Numbers with separators that may be phone numbers, without such a word, are left out as unknown. Scores are calibrated on
held-out documents, and a kind's threshold is where the chosen proposals would have been right as often as asked.

The trees are fitted on about ``max_candidates`` proposals chosen by hash, an equal part of each kind and label, from three
fourths of all documents. Calibration and thresholds come from counts over all proposals of the other fourth.
"""

from __future__ import annotations

import hashlib
import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import freeing, quoted
from rowloom.llm.suffix_dedup import pack, unpack

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BASE = ("email", "ip", "card", "phone")
KINDS = ("contact", "number", "secret")
LONGEST = 200
BINS = 32
MARGIN_BINS = 64  # to one of margin
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match begins at the beginning of a run of digits and ends at the end of one, so looking behind changes none.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_DIGITS = re.compile("[0-9]++")
_NUMBER = re.compile(r"\+?\(?[0-9](?:[\x20().:/-]{0,3}[0-9]){5,40}+")
_SPELLED = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\s?[\[({]\s?(?:at|@)\s?[\])}]\s?[A-Za-z0-9.-]{1,64}", re.I)
_SPELLED_PARTS = re.compile(r"([A-Za-z0-9._%+-]{1,64})\s?[\[({]\s?(?:at|@)\s?[\])}]\s?([A-Za-z0-9.-]{1,64})", re.I)
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
_FORMS = (" (at) ", "(at)", " [at] ", "[at]", " {at} ", "(@)")
_CALL = re.compile(r"(?<![A-Za-z])(?:tele)?(?:phone|tel|mobile|cell|fax|call|dial|whatsapp)\.?\s?(?:(?:number|no|us|me|at|on|is)\b\.?\s?){0,2}[:=]?\s?$", re.I)
_TOKEN = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_+/=-")
_CUE = re.compile(r"(?:token|secret|passw(?:or)?d|pwd|api[_ -]?key|access[_ -]?key|auth|bearer)\w*\s*(?:is\s*)?[=:]?\s*[\"'`]?$", re.I)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i & 1:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from each ``@``: the longest run of allowed characters before it, as far as it is free."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL:
            begin -= 1
        found = _DOMAIN.match(text, at) if begin < at else None
        if found:
            out.append((begin, found.end()))
        free = found.end() if found else at + 1
        at = text.find("@", free)
    return out


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Matches of the exact kinds: leftmost, not overlapping within a kind, failing ones dropped."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in BASE}
    if "@" in text:
        out["email"] = _emails(text)
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            # A part may have thousands of leading zeros, so only what is left without them is read as a number.
            if all(len(p) <= 3 and int(p or "0") <= 255 for p in (p.lstrip("0") for p in m.group().split("."))):
                out["ip"].append(m.span())
        for m in _CARD.finditer(text):
            digits = "".join(_DIGITS.findall(m.group()))
            if 13 <= len(digits) <= 19 and luhn(digits):
                out["card"].append(m.span())
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(map(len, _DIGITS.findall(m.group()))) <= 15:
                    out["phone"].append(m.span())
    return out


def proposals(text: str) -> list[tuple[str, int, int]]:
    """Spans that may be personal data, with high recall; they may overlap."""
    out: set[tuple[str, int, int]] = set()
    at = text.find("@")
    while at >= 0:
        begin, end = at, at + 1
        while begin > 0 and at - begin < 64 and not text[begin - 1].isspace() and text[begin - 1] not in "<>()[]{},;:\"'":
            begin -= 1
        while end < len(text) and end - at < 128 and not text[end].isspace() and text[end] not in "<>()[]{},;:\"'":
            end += 1
        if end - begin > 2:
            out.add(("contact", begin, end))
        at = text.find("@", end)
    if "(" in text or "[" in text or "{" in text:
        out.update(("contact", *m.span()) for m in _SPELLED.finditer(text))
    if _DIGIT.search(text):
        out.update(("number", *m.span()) for m in _NUMBER.finditer(text))
        done = 0
        for m in _DIGITS.finditer(text):
            begin, end = m.span()
            if begin < done:
                continue
            while begin > done and end - begin < LONGEST and text[begin - 1] in _TOKEN:
                begin -= 1
            while end < len(text) and end - begin < LONGEST and text[end] in _TOKEN:
                end += 1
            done = end
            if end - begin >= 12 and any(c.isalpha() for c in text[begin:end]):
                out.add(("secret", begin, end))
    return sorted(out, key=lambda x: (x[1], x[2], x[0]))


def features(text: str, kind: str, begin: int, end: int) -> list[float]:
    """Format of a proposal and its context; neither checksums nor the names that label secrets."""
    s = text[begin:end]
    n = len(s)
    digits, letters = sum(c.isdigit() for c in s), sum(c.isalpha() for c in s)
    upper, blanks = sum(c.isupper() for c in s), s.count(" ")
    counts = np.unique(np.frombuffer(s.encode("utf-32-le"), np.uint32), return_counts=True)[1] / max(n, 1)
    groups = [len(g) for g in _DIGITS.findall(s)] or [0]
    before, after = text[max(0, begin - 24):begin], text[end:end + 12]
    switches = sum(a.isdigit() != b.isdigit() for a, b in zip(s, s[1:]))
    hexadecimal = all(c in "0123456789abcdefABCDEF" for c in s)
    return [
        KINDS.index(kind), n, digits, letters, upper, blanks, s.count("."), s.count("-"), s.count("("), s.count("@"), s.count("+"),
        s.count("/") + s.count(":"), len(groups), max(groups), min(groups), groups[0], groups[-1], float(-(counts * np.log2(counts)).sum()),
        switches / max(n, 1), float(hexadecimal), float(s[:1] == "+"),
        float(before[-1:].isspace()), float(before[-1:] in ("\"", "'", "`") and before != ""), float("=" in before[-4:]), float(":" in before[-4:]),
        float(after[:1].isspace()), float(after[:1] in ("\"", "'", "`") and after != ""), float(after[:1].isalnum()),
        float(_DIGIT.search(before[-6:]) is not None), float(_DIGIT.search(after[:6]) is not None),
    ]


def label(text: str, kind: str, begin: int, end: int) -> int | None:
    """1 for what its own form or a word before it confirms, 0 for what is none, None where neither can be told."""
    s = text[begin:end]
    if kind == "secret":
        return int(_CUE.search(text[max(0, begin - 40):begin]) is not None)
    if kind == "contact":
        parts = _SPELLED_PARTS.fullmatch(s)
        return int(parts is not None and _HOST.fullmatch(parts[2].rstrip(".-")) is not None)
    if s[0] == "+" or not _PHONE.fullmatch("+" + s.lstrip("(")) or not 9 <= sum(map(len, _DIGITS.findall(s))) <= 15:
        return 0
    if _CALL.search(text[max(0, begin - 30):begin]):
        return 1
    return 0 if s.isdigit() else None


def labelled(text: str) -> list[tuple[str, str, int, int, int]]:
    """Proposals with a label, and the text that they stand in: those of ``text`` that the trees decide on, and its exact
    addresses and phone numbers in forms that no pattern matches."""
    found = proposals(text)
    base = base_spans(text) if found else {}
    taken = sorted(s for spans in base.values() for s in spans)
    out = []
    for kind, begin, end in found:
        if kind == "secret" or all(end <= b or begin >= e for b, e in taken):
            y = label(text, kind, begin, end)
            if y is not None:
                out.append((text, kind, begin, end, y))

    def rewritten(kind: str, begin: int, end: int, new: str, y: int) -> None:
        before, after = text[max(0, begin - 24):begin], text[end:end + 12]
        whole, stop = before + new + after, len(before) + len(new)
        for k, b, e in proposals(whole):
            if k == kind and min(e, stop) - max(b, len(before)) >= 0.8 * max(e - b, len(new)):
                out.append((whole, kind, b, e, y))

    for begin, end in base.get("email", ()):
        local, host = text[begin:end].split("@")
        form = _FORMS[zlib.crc32(text[begin:end].encode()) % len(_FORMS)]
        if _HOST.fullmatch(host):
            rewritten("contact", begin, end, local + form + host, 1)
        rewritten("contact", begin, end, local + form + host.split(".")[0], 0)
        rewritten("contact", begin, end, local + "@" + host.split(".")[0], 0)
    for begin, end in base.get("phone", ()):
        rewritten("number", begin, end, text[begin + 1:end], 1)
    return out


# ---------------------------------------------------------------- boosted trees

@dataclass
class Trees:
    """Trees of fixed depth as arrays: feature and cut of each inner node, value of each leaf."""

    feature: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.int64))
    cut: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    value: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    base: float = 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, c, v in zip(self.feature, self.cut, self.value):
            node = np.zeros(len(x), np.int64)
            while len(f) and node.min(initial=len(f)) < len(f):
                node = 2 * node + 1 + (x[rows, f[node]] > c[node])
            out += v[node - len(f)]
        return out


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, rate: float = 0.2, l2: float = 1.0) -> Trees:
    """Newton boosting of the logistic loss over histograms of quantile bins."""
    n, d = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.arange(1, BINS) / BINS, method="nearest")) for j in range(d)]
    code = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    flat = code + np.arange(d) * BINS
    prior = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(prior / (1 - prior)))
    margin = np.full(n, base)
    inner = 2**depth - 1
    out = Trees(np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1)), base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, np.maximum(p * (1 - p), 1e-9)
        node = np.zeros(n, np.int64)
        for at in range(inner):
            here = np.flatnonzero(node == at)
            if len(here) > 1:
                index = flat[here].ravel()
                gs = np.bincount(index, np.repeat(g[here], d), d * BINS).reshape(d, BINS).cumsum(axis=1)
                hs = np.bincount(index, np.repeat(h[here], d), d * BINS).reshape(d, BINS).cumsum(axis=1)
                g_all, h_all = gs[0, -1], hs[0, -1]
                gain = gs**2 / (hs + l2) + (g_all - gs) ** 2 / (h_all - hs + l2) - g_all**2 / (h_all + l2)
                gain[:, -1] = -1
                for j, c in enumerate(cuts):
                    gain[j, len(c):] = -1
                j, b = np.unravel_index(int(np.argmax(gain)), gain.shape)
                if gain[j, b] > 1e-6:
                    out.feature[t, at], out.cut[t, at] = j, cuts[j][b]
            node[here] = 2 * at + 1 + (x[here, out.feature[t, at]] > out.cut[t, at])
        leaf = node - inner
        sums_g, sums_h = np.bincount(leaf, g, inner + 1), np.bincount(leaf, h, inner + 1)
        out.value[t] = -rate * sums_g / (sums_h + l2)
        margin += out.value[t][leaf]
    return out


def calibrate(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic curve of the share of positives over the margin: edges of its steps and their shares."""
    order = np.argsort(margin, kind="stable")
    edges, first, count = np.unique(margin[order], return_index=True, return_counts=True)
    return _pooled(edges, np.add.reduceat(y[order].astype(np.float64), first), count)


def _pooled(edges: np.ndarray, positive: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    stack: list[list[float]] = []
    for e, s, c in zip(edges, positive / count, count):
        stack.append([e, s, c])
        while len(stack) > 1 and stack[-2][1] >= stack[-1][1]:
            _, s2, c2 = stack.pop()
            e1, s1, c1 = stack.pop()
            stack.append([e1, (s1 * c1 + s2 * c2) / (c1 + c2), c1 + c2])
    return np.array([s[0] for s in stack]), np.array([s[1] for s in stack])


def threshold(bins: np.ndarray, y: np.ndarray, n: np.ndarray, right: float) -> tuple[np.ndarray, np.ndarray, float]:
    """From counts of held-out proposals by margin bin and label: the calibration, and the least probability from which the
    proposals were right as often as asked (infinite where there is none, or fewer than ten positives)."""
    if n[y == 1].sum() < 10:
        return np.zeros(1), np.zeros(1), np.inf
    edges, at = np.unique(bins, return_inverse=True)
    positive, count = np.bincount(at, n * y, len(edges)), np.bincount(at, n, len(edges))
    steps, shares = _pooled(edges / MARGIN_BINS, positive, count)
    p = shares[np.searchsorted(steps, edges / MARGIN_BINS, side="right") - 1]
    for t in np.unique(p):
        if t >= 0.5 and positive[p >= t].sum() >= right * count[p >= t].sum():
            return steps, shares, float(t)
    return steps, shares, np.inf


@dataclass
class PrivateModel:
    trees: Trees = field(default_factory=Trees)
    #: Of each kind: edges and shares of the calibration, and the probability from which a proposal is redacted.
    edges: list[np.ndarray] = field(default_factory=lambda: [np.zeros(1)] * len(KINDS))
    shares: list[np.ndarray] = field(default_factory=lambda: [np.zeros(1)] * len(KINDS))
    thresholds: np.ndarray = field(default_factory=lambda: np.full(len(KINDS), np.inf))

    def probability(self, x: np.ndarray) -> np.ndarray:
        margin, kind = self.trees.margin(x), x[:, 0].astype(int)
        out = np.zeros(len(x))
        for k in range(len(KINDS)):
            of = kind == k
            at = np.maximum(np.searchsorted(self.edges[k], margin[of], side="right") - 1, 0)
            out[of] = self.shares[k][at]
        return out


def _fit_task(rows: pa.Table) -> pa.Table:
    x, y = np.array(rows.column("x").to_pylist(), dtype=np.float64), rows.column("y").to_numpy().astype(np.float64)
    order = np.lexsort((*x.T, y, rows.column("h").to_numpy()))  # an order that no shuffle changes
    x, y = x[order], y[order]
    parts: list[np.ndarray] = []
    if min((y == 1).sum(), (y == 0).sum()) >= 20:
        trees = fit_trees(x, y)
        parts = [trees.feature.reshape(-1), trees.cut.reshape(-1), trees.value.reshape(-1), np.array([trees.base, len(trees.value)])]
    return pa.table([pa.array([pack(*parts) if parts else b""], pa.binary())], names=["model"])


def fit_private(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_candidates: int = 20_000, right: float = 0.98,
) -> PrivateModel:
    """Fit trees on about ``max_candidates`` proposals, an equal part of each kind and label, and calibrations and thresholds
    on counts over all proposals of the held-out fourth of the documents.

    Kinds with fewer than ten positives among all held-out documents get no threshold: only the exact patterns are redacted.
    """
    rows = docs.select(quoted(id_col).cast("long").alias("id"), quoted(text_col).cast("string").alias("text")).where("text is not null")
    dealt = rows.select(F.xxhash64("id", "text", F.lit("private")).alias("h"), "text")
    held = F.pmod(F.xxhash64("h", F.lit(1)), F.lit(4)) == 0
    train, test = dealt.where(~held), dealt.where(held)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = Counter((KINDS.index(kind), y) for text in batch.column(1).to_pylist() for _, kind, _, _, y in labelled(text))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in n], pa.int32()), pa.array([y for _, y in n], pa.int32()), pa.array(list(n.values()), pa.int64())], ["kind", "y", "n"]
            )

    counts = train.mapInArrow(count, "kind int, y int, n bigint").groupBy("kind", "y").agg(F.sum("n").alias("n")).collect()
    part = max(1, max_candidates // (2 * len(KINDS)))
    share = {(r["kind"], r["y"]): max(1, r["n"] // part) for r in counts}

    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], []]
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for at, (of, kind, begin, end, y) in enumerate(labelled(text)):
                    draw = int.from_bytes(hashlib.blake2b(f"{key} {at}".encode(), digest_size=8).digest(), "little")
                    if draw % share[KINDS.index(kind), y] == 0:
                        out[0].append(key)
                        out[1].append(features(of, kind, begin, end))
                        out[2].append(y)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.list_(pa.float64())), pa.array(out[2], pa.int32())], ["h", "x", "y"]
            )

    some = train.mapInArrow(propose, "h bigint, x array<double>, y int").withColumn("task", F.pmod("h", F.lit(1)))
    found = some.groupBy("task").applyInArrow(_fit_task, "model binary").collect()
    if not found or not found[0][0]:
        return PrivateModel()
    parts = unpack(found[0][0])
    n = int(parts[3][1])
    trees = Trees(parts[0].reshape(n, -1), parts[1].reshape(n, -1), parts[2].reshape(n, -1), float(parts[3][0]))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(features(of, kind, begin, end), y) for text in batch.column(1).to_pylist() for of, kind, begin, end, y in labelled(text)]
            x = np.array([f for f, _ in found], dtype=np.float64)
            bins = np.floor(trees.margin(x) * MARGIN_BINS).astype(np.int64) if found else []
            n = Counter((int(f[0]), int(b), y) for (f, y), b in zip(found, bins))
            kind, at, y = (list(c) for c in zip(*n)) if n else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [pa.array(kind, pa.int32()), pa.array(at, pa.int64()), pa.array(y, pa.int32()), pa.array(list(n.values()), pa.int64())], ["kind", "bin", "y", "n"]
            )

    seen = test.mapInArrow(judge, "kind int, bin bigint, y int, n bigint").groupBy("kind", "bin", "y").agg(F.sum("n").alias("n")).collect()
    model = PrivateModel(trees, [np.zeros(1)] * len(KINDS), [np.zeros(1)] * len(KINDS), np.full(len(KINDS), np.inf))
    for k in range(len(KINDS)):
        of = np.array([(r["bin"], r["y"], r["n"]) for r in seen if r["kind"] == k], dtype=np.float64).reshape(-1, 3)
        model.edges[k], model.shares[k], model.thresholds[k] = threshold(of[:, 0], of[:, 1], of[:, 2], right)
    return model


def private_spans(texts: list[str | None], model: PrivateModel) -> list[list[tuple[str, int, int]]]:
    """All spans of each text by kind, then place: the exact ones, and chosen proposals that overlap none chosen before. A
    chosen secret takes the whole run of its characters, whatever else matches inside."""
    base = [base_spans(t) if t else {k: [] for k in BASE} for t in texts]
    chosen: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    if np.isfinite(model.thresholds).any():
        found = [(i, *p) for i, t in enumerate(texts) if t for p in proposals(t) if np.isfinite(model.thresholds[KINDS.index(p[0])])]
        if found:
            x = np.array([features(texts[i], kind, begin, end) for i, kind, begin, end in found], dtype=np.float64)
            p = model.probability(x)
            good = np.flatnonzero(p >= model.thresholds[x[:, 0].astype(int)])
            taken = [sorted(s for spans in b.values() for s in spans) for b in base]
            # The surest first, of equally sure ones the longest.
            for j in sorted(good.tolist(), key=lambda j: (found[j][0], -p[j], found[j][2] - found[j][3], found[j][2], found[j][1])):
                i, kind, begin, end = found[j]
                if kind == "secret":
                    if any(k == kind and b < end and begin < e for k, b, e in chosen[i]):
                        continue
                    text = texts[i]
                    while begin > 0 and text[begin - 1] in _TOKEN:
                        begin -= 1
                    while end < len(text) and text[end] in _TOKEN:
                        end += 1
                if kind == "secret" or all(end <= b or begin >= e for b, e in taken[i]):
                    taken[i].append((begin, end))
                    chosen[i].append((kind, begin, end))
    out = []
    for b, c in zip(base, chosen):
        spans = [(k, *s) for k in BASE for s in b[k]]
        out.append(spans + sorted(c, key=lambda s: (KINDS.index(s[0]), s[1])))
    return out


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with each group of overlapping spans replaced by the kind of its first one."""
    out, at = [], 0
    for kind, begin, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if begin >= at:
            out += [text[at:begin], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, model: PrivateModel, text_col: str = "text", spans_col: str = "private_spans") -> DataFrame:
    """``docs`` with personal data in ``text_col`` replaced by ``[KIND]``, and the spans found, in code points of the text
    given, as an array of (kind, begin, end) in ``spans_col`` (replaced if it is there). Null text stays null, without spans.
    """
    kept = [c for c in docs.columns if c.lower() != spans_col.lower()]
    at = kept.index(text_col)
    plain = [f"c{i}" for i in range(len(kept))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("begin", pa.int64()), ("end", pa.int64())]))
        for whole in batches:
            for begin in range(0, whole.num_rows, 1024):
                batch = whole.slice(begin, 1024)
                texts = batch.column(at).to_pylist()
                spans = private_spans(texts, model)
                columns = list(batch.columns)
                columns[at] = pa.array([redacted(t, s) if s else t for t, s in zip(texts, spans)], pa.string())
                found = pa.array([[{"kind": k, "begin": b, "end": e} for k, b, e in s] for s in spans], kind)
                yield pa.RecordBatch.from_arrays([*columns, found], [*plain, "spans"])

    rows = docs.select(*[(quoted(c).cast("string") if c == text_col else quoted(c)).alias(n) for c, n in zip(kept, plain)])
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    done = rows.mapInArrow(freeing(run), f"{fields}, spans array<struct<kind:string,begin:bigint,end:bigint>>")
    return done.select(*[F.col(n).alias(c) for c, n in zip(kept, plain)], F.col("spans").alias(spans_col))
