"""Operator 5, toxicity by class-conditional Kneser-Ney models.

Two models of the characters of words, one of toxic and one of ordinary
documents, share their lower levels: an expression that a class has not seen
often backs off to continuation counts pooled over both classes, so a rare
one says the same in both. (Characters, because abuse is inflected.) The
log-likelihood differences, normalised by length over the whole text, become
a probability by a logistic calibration on training documents left out of
the counts.

Training uses at most ``MAX_TRAIN`` labelled documents of each class (those
with the smallest hash of doc_id), in every table. Scoring reads every whole
text.

Cases: null or empty text gets the score of no evidence; rows of ``labels``
with a null are ignored; a document labelled twice counts as toxic if any
label says so; with one class or none in training every score is the share
of toxic labels (0 if none); repeated rows are each scored; other columns
are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_id, bound_batches, fold, full_text, pairs, rows_to_batch

MAX_TRAIN = 4000          # labelled documents of each class
FOLDS, HELD_OUT = 5, 0
CALIBRATION = 4           # one training document in so many calibrates
DISCOUNTS = (2.0, 4.0, 8.0)
ORDER, CLASS_ORDER = 5, 4  # longest n-gram; shorter ones than CLASS_ORDER are shared by both classes
MIN_COUNT = 3
FLOOR = 1e-5
NOTHING = [0.0, 0.0, 0.0, 0.0, 0.0, 1.0]
WORD = re.compile(r"\w+")


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def grams(word: str) -> list[str]:
    """Character n-grams of a word with its ends marked, 1 to ``ORDER`` long."""
    s = f"^{word}$"
    return [s[i:j] for j in range(2, len(s) + 1) for i in range(max(0, j - ORDER), j)]


class KneserNey:
    """Log-likelihood difference (toxic less ordinary) of words.

    The difference of an n-gram seen in training is stored; an n-gram not
    seen takes that of its own end, plus the difference of both classes'
    backoff weights. ``counts``: n-gram -> (ordinary, toxic) counts.
    """

    def __init__(self, counts: dict, discount: float):
        n = {g: np.array(c, dtype=float) for g, c in counts.items()}
        wide = {}
        for g in n:                       # continuation counts: different characters before it
            if len(g) > 1:
                wide[g[1:]] = wide.get(g[1:], 0) + (n[g] > 0)
        use = {g: c if len(g) == ORDER or g[0] == "^" else np.maximum(wide.get(g, 0), 0) + np.zeros(2)
               for g, c in n.items()}
        pooled = {g: c.sum() for g, c in use.items() if len(g) < CLASS_ORDER}
        head, kept = {}, {}
        for g, c in use.items():
            shared = len(g) < CLASS_ORDER
            c = np.full(2, pooled[g]) if shared else c
            k = np.maximum(c - (0.75 if shared else discount), 0)
            head[g[:-1]] = head.get(g[:-1], 0) + c
            kept[g[:-1]] = kept.get(g[:-1], 0) + k
        rest = {ctx: 1 - kept[ctx] / np.maximum(h, 1e-9) for ctx, h in head.items()}
        prob = {}
        for g in sorted(use, key=len):
            ctx, shared = g[:-1], len(g) < CLASS_ORDER
            c = np.full(2, pooled[g]) if shared else use[g]
            own = np.maximum(c - (0.75 if shared else discount), 0) / np.maximum(head[ctx], 1e-9)
            low = prob.get(g[1:], np.full(2, FLOOR)) if len(g) > 1 else np.full(2, FLOOR)
            prob[g] = own + rest[ctx] * low + 1e-12
        self.diff = {g: float(np.log(p[1]) - np.log(p[0])) for g, p in prob.items() if len(g) >= CLASS_ORDER}
        self.rest = {ctx: float(np.log(r[1] + 1e-12) - np.log(r[0] + 1e-12))
                     for ctx, r in rest.items() if len(ctx) >= CLASS_ORDER - 1}
        self.known: dict[str, float] = {}

    def word(self, word: str) -> float:
        s, total, diff, rest = f"^{word}$", 0.0, self.diff, self.rest
        for j in range(CLASS_ORDER, len(s) + 1):
            for i in range(max(0, j - ORDER), j - CLASS_ORDER + 1):
                if (d := diff.get(s[i:j])) is not None:
                    total += d
                    break
                total += rest.get(s[i:j - 1], 0.0)
        return total

    def evidence(self, text: str) -> list[float]:
        """Length-normalised differences: per word, per root of the words, of
        the strongest one, three and eight words, and 1."""
        known, word = self.known, self.word
        if len(known) > 200_000:                      # a cache only, bounded
            known.clear()
        out = []
        for w in words(text):
            d = known.get(w)
            if d is None:
                d = known[w] = word(w)
            out.append(d)
        if not out:
            return NOTHING
        d = np.array(out)
        top = np.sort(d)[::-1]
        return [float(d.mean()), float(d.sum() / np.sqrt(len(d))), float(top[0]), float(top[:3].sum() / 3),
                float(top[:8].sum() / 8), 1.0]


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.05, steps: int = 50) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w -= np.linalg.solve(h, x.T @ (weight * (p - y)) + ridge * w)
    return w


def training_labels(labels: DataFrame, folds: int, held_out: int) -> DataFrame:
    """(doc_id, toxic) of all labelled training documents."""
    return (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
              .where(fold(F.col("doc_id"), folds) != held_out)
              .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")))


def training_sample(docs: DataFrame, marked: DataFrame, most: int) -> DataFrame:
    """(doc_id, text, toxic) of at most ``most`` training documents a class."""
    picked = [marked.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for c in (0, 1)]
    chosen = picked[0].union(picked[1])                    # at most 2 * most rows
    texts = docs.select("doc_id", full_text().alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id")


def train(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, held_out: int = HELD_OUT,
          most: int = MAX_TRAIN) -> tuple[KneserNey | None, np.ndarray]:
    """The models and the calibration's weights. Bigrams are counted in Spark;
    those of the bounded sample that occur twice come to the driver."""
    marked = training_labels(labels, folds, held_out)
    # labels of the class for one in the sample
    stands_for = {r.toxic: max(1.0, r.n / most) for r in marked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    sample = training_sample(docs, marked, most)
    sample = sample.withColumn("calibrates", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(CALIBRATION)) == 0)
    out = pa.schema([("gram", pa.string()), ("ordinary", pa.int64()), ("toxic", pa.int64())])

    def count(batches):
        for b in batches:
            seen, found = (Counter(), Counter()), (Counter(), Counter())
            for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                seen[toxic].update(words(text))
            for c in (0, 1):
                for w, n in seen[c].items():
                    for g in grams(w):
                        found[c][g] += n
            yield rows_to_batch([(g, found[0][g], found[1][g]) for g in found[0].keys() | found[1].keys()], out)

    bound_batches(docs.sparkSession)
    table = (sample.where(~F.col("calibrates")).select("text", "toxic")
             .mapInArrow(count, "gram string, ordinary bigint, toxic bigint")
             .groupBy("gram").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))
             .where(F.col("ordinary") + F.col("toxic") >= MIN_COUNT))
    counts = {r.gram: (r.ordinary, r.toxic) for r in table.toLocalIterator()}
    check = sample.where("calibrates").select("text", "toxic")
    best = None
    models = [KneserNey(counts, d) for d in DISCOUNTS] if counts else []
    kind = "toxic int, " + ", ".join(f"e{i} array<double>" for i in range(len(models)))
    fields = pa.schema([("toxic", pa.int32()), *[(f"e{i}", pa.list_(pa.float64())) for i in range(len(models))]])

    def look(batches):
        for texts, toxic in pairs(batches):
            yield rows_to_batch([(y, *[m.evidence(t) for m in models])
                                 for t, y in zip(texts, toxic, strict=True)], fields)

    if models:
        seen = check.mapInArrow(look, kind).collect()          # numbers only, at most 2 * most rows
        y = np.array([r.toxic for r in seen], dtype=float)
        if 0 < y.sum() < len(y):
            weight = np.where(y == 1, stands_for[1], stands_for[0])
            weight = weight * len(y) / weight.sum()
            for i, m in enumerate(models):
                x = np.array([r[1 + i] for r in seen])
                w = fit_logistic(x, y, weight)
                p = np.clip(1 / (1 + np.exp(-np.clip(x @ w, -30, 30))), 1e-6, 1 - 1e-6)
                loss = float(-(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).mean())
                if best is None or loss < best[0]:
                    best = (loss, m, w)
    if best is None:
        each = {r.toxic: r.n * stands_for[r.toxic] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
        share = each.get(1, 0.0) / max(sum(each.values()), 1.0)
        share = min(max(share, 1e-9), 1 - 1e-9)
        return None, np.array([*NOTHING[:-1], np.log(share / (1 - share))])
    return best[1], best[2]


def score(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, held_out: int = HELD_OUT,
          most: int = MAX_TRAIN) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    model, w = train(docs, labels, folds, held_out, most)
    kind, atype = arrow_id(docs, "doc_id")
    out = pa.schema([("doc_id", atype), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])

    def run(batches):
        for b in batches:
            ids, texts, held = (b.column(i).to_pylist() for i in range(3))
            x = np.array([model.evidence(t) if model else NOTHING for t in texts]).reshape(-1, len(w))
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            yield rows_to_batch(list(zip(ids, held, p.tolist(), (p >= 0.5).astype(int).tolist(), strict=True)), out)

    return (docs.select("doc_id", full_text().alias("text"), (fold(F.col("doc_id"), folds) == held_out).alias("held"))
            .mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int"))


def keep_ordinary(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows predicted toxic, in one pass."""
    model, w = train(docs, labels)
    at = docs.columns.index("text")

    def run(batches):
        for b in batches:
            x = [model.evidence(t or "") if model else NOTHING for t in b.column(at).to_pylist()]
            yield b.filter(pa.array((np.array(x).reshape(-1, len(w)) @ w < 0).tolist(), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
