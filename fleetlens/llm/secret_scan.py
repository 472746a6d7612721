"""Operator 1, secret scans: fixed rules plus a character convolutional network.

The rules find ``assign``, ``access`` and ``hex`` spans. Every other run of
key-like characters is a candidate; a small convolutional network in numpy
reads its characters with the context on both sides and adds a ``model``
span where its calibrated probability passes a threshold.

A long candidate is read whole, in overlapping windows; of one
that a rule span overlaps, the rest is judged.

The network learns from labelled findings: at most ``MAX_MINED`` of the
scanned documents' rule findings (those with the smallest hash) and
``MAX_MADE`` examples of each label written by fixed recipes, so that it also knows key
names and alphabets the rules don't have. No run of the documents counts as
clean only because no rule finds it. A quarter of them is kept apart:
it calibrates the probability (Platt) and sets the threshold, the highest
that keeps ``RECALL`` of the findings there.

Cases: a null or empty text has no spans; positions are code points, end
exclusive; repeated rows are each scanned; a null doc_id is kept; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import random
import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_id, bound_batches, full_text, pairs, rows_to_batch

KINDS = ("assign", "access", "hex", "model")
# The rules' patterns and least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_VALUE = 6

CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
LEAST_RUN = 16
LEFT, BODY, RIGHT = 20, 36, 8         # characters of a window
STEP = 12                             # between the windows of a long candidate
ALPHABET = string.ascii_lowercase + string.ascii_uppercase + string.digits + " +/_-=.:,;\"'@#$%&*()<>\n"
WIDTH, FILTERS, EMBED, EPOCHS = 5, 24, 8, 12
MAX_MINED, MAX_MADE = 1500, 1500
RECALL = 0.97


def base_spans(text: str) -> list[tuple[int, int, str]]:
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def key_like(run: str) -> bool:
    return len(run) >= LEAST_RUN and any(c.isdigit() for c in run) and any(c.isalpha() for c in run)


def candidates(text: str, taken: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """Key-like runs; of a run that rule spans overlap, the parts outside them."""
    out = []
    for m in CANDIDATE.finditer(text):
        s, e = m.span()
        for a, b, _ in taken:                   # by start
            if a < e and s < b:
                if key_like(text[s:a]):
                    out.append((s, a))
                s = max(s, b)
        if key_like(text[s:e]):
            out.append((s, e))
    return out


def windows(text: str, start: int, end: int) -> list[str]:
    """The whole candidate in windows of ``BODY`` characters, each with its
    context, padded to a fixed width: every ``STEP`` characters, and at the end."""
    last = max(start, end - BODY)
    return [window(text, at, end) for at in [*range(start, last, STEP), last]]


def window(text: str, start: int, end: int) -> str:
    stop = min(end, start + BODY)
    left = text[max(0, start - LEFT):start].rjust(LEFT, "\0")
    return left + text[start:stop].ljust(BODY, "\0") + text[stop:stop + RIGHT].ljust(RIGHT, "\0")


_CODE = {c: i + 2 for i, c in enumerate(ALPHABET)} | {"\0": 0}


def encode(windows: list[str]) -> np.ndarray:
    return np.array([[_CODE.get(c, 1) for c in w] for w in windows], dtype=np.int64).reshape(len(windows), -1)


class CharNet:
    """Embedding, one convolution, rectifier, max over positions in the left
    context and in the rest, logistic output."""

    def __init__(self, seed: int = 11):
        r = np.random.default_rng(seed)
        self.e = r.normal(0, 0.3, (len(ALPHABET) + 2, EMBED))
        self.k = r.normal(0, 0.2, (WIDTH * EMBED, FILTERS))
        self.b = np.zeros(FILTERS)
        self.w = r.normal(0, 0.1, 2 * FILTERS)
        self.c = np.zeros(1)

    def parameters(self) -> list[np.ndarray]:
        return [self.e, self.k, self.b, self.w, self.c]

    def forward(self, x: np.ndarray):
        v = self.e[x]
        n, t, _ = v.shape
        cols = np.concatenate([v[:, i:t - WIDTH + 1 + i] for i in range(WIDTH)], axis=2)
        h = np.maximum(cols @ self.k + self.b, 0)
        at = [h[:, :LEFT].argmax(axis=1), LEFT + h[:, LEFT:].argmax(axis=1)]
        top = np.concatenate([np.take_along_axis(h, a[:, None, :], 1)[:, 0] for a in at], axis=1)
        return cols, at, top, top @ self.w + self.c[0]

    def gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        cols, at, top, z = self.forward(x)
        d = (1 / (1 + np.exp(-z)) - y) / len(y)
        dtop = d[:, None] * self.w * (top > 0)
        dk, db, de = np.zeros_like(self.k), np.zeros_like(self.b), np.zeros_like(self.e)
        rows = np.arange(len(x))
        for side, a in enumerate(at):
            for f in range(FILTERS):
                g = dtop[:, side * FILTERS + f]
                src = cols[rows, a[:, f]]
                dk[:, f] += g @ src
                db[f] += g.sum()
                back = (g[:, None] * self.k[:, f]).reshape(len(x), WIDTH, EMBED)
                for i in range(WIDTH):
                    np.add.at(de, x[rows, a[:, f] + i], back[:, i])
        return [de, dk, db, top.T @ d, np.array([d.sum()])]

    def fit(self, x: np.ndarray, y: np.ndarray, seed: int = 5) -> None:
        """Adam over shuffled mini-batches."""
        r = np.random.default_rng(seed)
        ps = self.parameters()
        m, v, step = [np.zeros_like(p) for p in ps], [np.zeros_like(p) for p in ps], 0
        for _ in range(EPOCHS):
            for part in np.array_split(r.permutation(len(y)), max(1, len(y) // 128)):
                step += 1
                for i, g in enumerate(self.gradients(x[part], y[part])):
                    m[i] = 0.9 * m[i] + 0.1 * g
                    v[i] = 0.99 * v[i] + 0.01 * g * g
                    ps[i] -= 0.01 * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.99 ** step)) + 1e-8)


def spread_windows(text: str, start: int, end: int) -> tuple[list[str], list[int]]:
    last = max(start, end - BODY)
    return windows(text, start, end), [*range(start, last, STEP), last]


def made_examples(n: int, seed: int = 3) -> tuple[list[str], list[int]]:
    """Labelled windows by fixed recipes: keys after key names, and long runs
    that are not keys (words, numbers, addresses, paths, identifiers)."""
    r = random.Random(seed)
    names = ["pwd", "auth", "bearer", "credential", "private_key", "access_key", "client_secret", "session",
             "passphrase", "token", "secret", "apikey", "password", "signature"]
    sets = [string.ascii_letters + string.digits, string.hexdigits.upper(), string.ascii_lowercase + string.digits,
            string.ascii_letters + string.digits + "+/", "0123456789abcdef"]

    def word(lo=2, hi=9):
        return "".join(r.choice(string.ascii_lowercase) for _ in range(r.randint(lo, hi)))

    def prose(k):
        return " ".join(word() for _ in range(k))

    def number(k):
        return "".join(r.choice(string.digits) for _ in range(k))

    texts, labels = [], []
    for i in range(n):
        key = "".join(r.choice(r.choice(sets[:1]) if i % 3 == 0 else sets[i % 5]) for _ in range(r.randint(20, 48)))
        key = key[:9] + r.choice(string.digits) + r.choice("abcdef") + key[9:]
        name = r.choice(names)
        name = name.upper() if r.random() < 0.3 else name
        lead = r.choice([" = ", "=", ": ", ":", " ", ' = "', "='", '": "'])
        before, after = prose(3) + r.choice([" ", "\n"]) + name + lead, r.choice(['" ', "' ", " ", "\n"]) + prose(2)
        # one key in four stands at the end of a longer run; windows that hold most of it are positive, those before it are not
        path = "".join(word(3, 9) + r.choice("/_-") for _ in range(r.randint(1, 5))) if i % 4 == 0 else ""
        at = len(before) + len(path)
        for w, start in zip(*spread_windows(before + path + key + after, len(before), at + len(key)), strict=True):
            held = min(start + BODY, at + len(key)) - max(start, at)
            if held >= min(18, len(key)) or held <= 0:
                texts.append(w)
                labels.append(int(held > 0))
        junk = r.choice([
            lambda: word(12, 24) + number(2), lambda: number(16) + word(1, 2), lambda: word(5, 8) + "-" + number(4) + "-" + word(5, 8),
            lambda: word() + "/" + word() + "/" + number(3) + "/" + word(6, 9), lambda: f"20{number(2)}-{number(2)}-{number(2)}T{number(8)}",
            lambda: word(6, 9) + "_" + word(6, 9) + "_" + number(1), lambda: word(4, 6).upper() + number(14),
            lambda: word(8, 12) + "." * 0 + number(2) + word(8, 12)])()
        junk = junk if len(junk) >= 16 else junk + word(16, 18)
        before, after = prose(5) + " ", r.choice([" ", ". ", "@", "\n"]) + prose(2)
        texts.append(window(before + junk + after, len(before), len(before) + len(junk)))
        labels.append(0)
    return texts, labels


def mined_examples(docs: DataFrame, most: int) -> list[str]:
    """Windows of rule findings (of assignments, the value), at most ``most``.
    The documents' other runs are no examples: any of them may be a secret."""
    fields = pa.schema([("window", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            rows = set()
            for text in b.column(0).to_pylist():
                found = [(s, e) for s, e, k in base_spans(text) if k != "assign"]
                found += [m.span(2) for m in ASSIGN.finditer(text)]
                rows |= {window(text, s, e) for s, e in found if key_like(text[s:e])}
            yield rows_to_batch([(w,) for w in sorted(rows)], fields)

    found = docs.select(full_text().alias("text")).mapInArrow(run, "window string").distinct()
    return [r.window for r in found.orderBy(F.xxhash64("window"), "window").limit(most).collect()]


def train(docs: DataFrame, most: int = MAX_MINED) -> tuple[CharNet, tuple[float, float], float]:
    """The network, its calibration (slope, shift) and the threshold."""
    texts, labels = made_examples(MAX_MADE)
    mined = mined_examples(docs, most)
    x, y = encode(texts + mined), np.array(labels + [1] * len(mined), dtype=float)
    order = np.random.default_rng(1).permutation(len(y))
    x, y = x[order], y[order]
    kept = len(y) // 4
    net = CharNet()
    net.fit(x[kept:], y[kept:])
    z, t = net.forward(x[:kept])[3], y[:kept]
    slope, shift = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-(slope * z + shift)))
        slope -= 0.1 * float(((p - t) * z).mean())
        shift -= 0.1 * float((p - t).mean())
    p = 1 / (1 + np.exp(-(slope * z + shift)))
    threshold = float(np.quantile(p[t == 1], 1 - RECALL)) if t.any() else 1.0
    return net, (slope, shift), threshold


def finder(docs: DataFrame, most: int = MAX_MINED):
    """A function from texts to their spans, (start, end, kind) by start, with
    the network trained on ``docs``."""
    bound_batches(docs.sparkSession)
    net, (slope, shift), threshold = train(docs, most)

    def find(texts: list[str]) -> list[list[tuple[int, int, str]]]:
        found, ask = [], []
        for i, text in enumerate(texts):
            spans = base_spans(text)
            ask += [(i, s, e, w) for s, e in candidates(text, spans) for w in windows(text, s, e)]
            found.append(spans)
        keep = set()                            # a candidate is as likely as its likeliest window
        for at in range(0, len(ask), 512):
            part = ask[at:at + 512]
            p = 1 / (1 + np.exp(-(slope * net.forward(encode([a[3] for a in part]))[3] + shift)))
            keep |= {a[:3] for a, likely in zip(part, p >= threshold, strict=True) if likely}
        for i, s, e in keep:
            found[i].append((s, e, "model"))
        return [sorted(f, key=lambda x: (x[0], KINDS.index(x[2]))) for f in found]

    return find


def scan(docs: DataFrame, most: int = MAX_MINED) -> DataFrame:
    """(doc_id, spans) with spans as array of (start, end, kind), by start."""
    find = finder(docs, most)
    kind, atype = arrow_id(docs, "doc_id")
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())])
    fields = pa.schema([("doc_id", atype), ("spans", pa.list_(span))])

    def run(batches):
        for ids, texts in pairs(batches):
            yield rows_to_batch([(i, [dict(zip(("start", "end", "kind"), x, strict=True)) for x in spans])
                                 for i, spans in zip(ids, find(texts), strict=True)], fields)

    return docs.select("doc_id", full_text().alias("text")).mapInArrow(
        run, f"doc_id {kind}, spans array<struct<start: int, end: int, kind: string>>")


def masked(text: str, spans: list[tuple[int, int, str]], mark: str) -> str:
    """``text`` with the union of the spans cut out, one mark for each piece."""
    out, at = [], 0
    for s, e, _ in spans:
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, most: int = MAX_MINED, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with findings replaced by ``mark``; ``n_chars``, if there, follows."""
    find = finder(docs, most)
    at, counted = docs.columns.index("text"), "n_chars" in docs.columns

    def run(batches):
        for b in batches:
            texts = b.column(at).to_pylist()
            new = [t if not sp else masked(t, sp, mark)
                   for t, sp in zip(texts, find([t or "" for t in texts]), strict=True)]
            b = b.set_column(at, b.schema.field(at), pa.array(new, b.schema.field(at).type))
            if counted:
                i = b.schema.get_field_index("n_chars")
                old = b.column(i).to_pylist()
                n = [len(y) if x != y else o for x, y, o in zip(texts, new, old, strict=True)]
                b = b.set_column(i, b.schema.field(i), pa.array(n, b.schema.field(i).type))
            yield b

    return docs.mapInArrow(run, docs.schema)


def digest(found: DataFrame) -> DataFrame:
    """Counts by kind, hash of the rules' spans, and all spans as text."""
    def only(k):
        return F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{k}")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = joined(F.filter("spans", lambda s: s["kind"] != "model"))
    return found.select("doc_id", only("assign"), only("access"), only("hex"),
                        F.sha2(base.cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
                        only("model"))
