import hashlib
import math
import re
import zlib

import numpy as np
import pytest

from fleetlens.llm import importance as I
from fleetlens.llm import queries

from .helpers import SF, empty_docs, odd_docs, rows, texts

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(w), [zlib.crc32(" ".join(w[i:i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def brute(docs, target, percent=5, least=20):
    s, t = [0] * 10000, [0] * 10000
    per = [(i, *features(x)) for i, x in docs]
    for _, _, f in per:
        for b in f:
            s[b] += 1
    for _, x in target:
        for b in features(x)[1]:
            t[b] += 1
    S, T = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((b + 1) * (S + 10000) / ((a + 1) * (T + 10000)))) for a, b in zip(s, t)]
    out = []
    for i, n, f in per:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    order = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    ranks = {id(r): k + 1 for k, r in enumerate(order[:len(order) * percent // 100])}
    return sorted((tuple(r[:4]) + (ranks.get(id(r)),) for r in out), key=repr)


def test_query_equals_brute_force(spark):
    got = queries.op13_importance_resampling(spark, SF)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert [t for _, t in got.dtypes] == ["bigint"] * 5
    assert sorted(rows(got), key=repr) == brute(texts(), texts("benchmark", "item_id, text"))


def test_blocks_of_words_change_nothing(monkeypatch):
    text = "Éa b c9 d-e f. g  h\ti j k l m n o" * 7
    whole = features(text)
    for size in (1, 2, 3, 7, 50, 1 << 20):
        monkeypatch.setattr(I, "BLOCK", size)
        found = list(I.buckets(text))
        assert sum(n for n, _ in found) == whole[0]
        assert sorted(np.concatenate([b for _, b in found]).tolist()) == sorted(whole[1])
    assert list(I.buckets("")) == [] and sum(len(b) for _, b in I.buckets(" .,\n")) == 0


@pytest.mark.parametrize("margin", [1e-9, 0.002, 0.4, 2.0])
def test_bracket_is_widened_until_it_holds_the_cutoff(spark, margin):
    docs = [(i % 150, f"word{i % 3} " * (15 + i % 20) + "the same end") for i in range(400)] + [(7, "x y " * 30)] * 90
    target = [(1, "word1 word1 the end x y")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    to = spark.createDataFrame(target, "item_id bigint, text string")
    for percent in (1, 30, 100):
        assert sorted(rows(I.draw(df, to, percent, margin=margin)), key=repr) == brute(docs, target, percent)


def test_odd_rows_and_empty_tables(spark):
    long = [" ".join(f"w{i % 50}" for i in range(j)) for j in (19, 20, 21, 400)] * 12
    docs = odd_docs(spark, long)
    target = spark.createDataFrame([(1, "w1 w2 w3 word"), (2, None)], "item_id bigint, text string")
    got = sorted(rows(I.draw(docs, target, 50)), key=repr)
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()], [(1, "w1 w2 w3 word"), (2, None)], 50)
    drawn = {r[0] for r in got if r[4] and r[0] is not None}
    kept = I.resample(docs, target, 50)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == drawn
    assert rows(I.draw(empty_docs(spark), target)) == []
    assert all(r.rank is None for r in I.draw(docs.where("doc_id < 4"), target).collect())
    assert I.draw(docs, target.limit(0)).count() == docs.count()
