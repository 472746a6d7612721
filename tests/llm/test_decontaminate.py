import random
import re
from collections import Counter

import pytest

from fleetlens.llm import decontaminate as D
from fleetlens.llm import queries

from .helpers import SF, empty_docs, odd_docs, rows, texts


def shingles(w):
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def brute(docs, items, threshold=0.8):
    ws = lambda t: re.findall(r"\w+", (t or "").lower())
    out = set()
    for k, t in items:
        w, s = ws(t), shingles(ws(t))
        for i, d in docs:
            v = ws(d)
            if w and v and any(sum((x & s).values()) >= threshold * sum((x | s).values())
                               for x in (shingles(v[p:p + len(w)]) for p in range(len(v)))):
                out.add((i, k))
    return out


def test_query_against_all_windows(spark):
    got = {(r.doc_id, r.item_id) for r in queries.op9_benchmark_decontamination(spark, SF).collect()}
    items = texts("benchmark", "item_id, text")
    grams = {g for _, t in items for g in shingles(re.findall(r"\w+", t.lower()))}
    docs = [(i, t) for i, t in texts() if any(g in grams for g in shingles(re.findall(r"\w+", (t or "").lower())))]
    assert got == brute(docs, items)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_edited_passages(spark, seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(5))
    items = [(k, " ".join(word() for _ in range(r.choice([3, 5, 8, 20, 60, 90])))) for k in range(25)]
    docs = []
    for i in range(120):
        _, t = r.choice(items)
        w = t.split()
        for _ in range(r.randint(0, 3)):
            p, kind = r.randrange(len(w)), r.random()
            w = w[:p] + ([word()] if kind < 0.6 else [] if kind < 0.8 else [w[p], word()]) + w[p + 1:]
        docs.append((i, " ".join([word() for _ in range(r.randint(0, 40))] + w + [word() for _ in range(r.randint(0, 40))])))
    got = {(x.doc_id, x.item_id) for x in D.matches(spark.createDataFrame(docs, "doc_id bigint, text string"),
                                                    spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    assert got == brute(docs, items)


@pytest.mark.parametrize("seed", [4, 5])
def test_moved_parts(spark, seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(5))
    items = [(k, " ".join(word() for _ in range(r.choice([40, 59, 59, 90, 150])))) for k in range(15)]
    docs = []
    for i in range(60):
        w = r.choice(items)[1].split()
        cut = sorted(r.sample(range(len(w)), r.choice([1, 1, 1, 2])))
        parts = [w[a:b] for a, b in zip([0, *cut], [*cut, len(w)])]
        r.shuffle(parts)
        w = sum(parts, [])
        if r.random() < 0.3:
            w[r.randrange(len(w))] = word()
        if r.random() < 0.3:
            w = w[:len(w) // 2] + [word() for _ in range(r.randint(1, 3))] + w[len(w) // 2:]
        docs.append((i, " ".join([word() for _ in range(r.randint(0, 30))] + w + [word() for _ in range(r.randint(0, 30))])))
    want = brute(docs, items)
    got = {(x.doc_id, x.item_id) for x in D.matches(spark.createDataFrame(docs, "doc_id bigint, text string"),
                                                    spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    assert got == want and len(want) > 30
    a, b = items[1][1].split()[:30], items[1][1].split()[30:]
    swapped = spark.createDataFrame([(1, " ".join(b + a))], "doc_id bigint, text string")
    if len(a + b) >= 59:
        assert D.matches(swapped, spark.createDataFrame(items[1:2], "item_id bigint, text string")).count() == 1


def test_no_python_in_the_plan(spark):
    plan = queries.op9_benchmark_decontamination(spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_odd_rows(spark):
    bench = spark.createDataFrame([(1, None, 1), (2, "", 1), (3, "one two three four five six seven", 1), (None, "word word", 1),
                                   (4, "word " * 30, 1), (4, "word " * 30, 1)], "item_id bigint, text string, score int")
    got = rows(D.matches(odd_docs(spark, ["ONE two; three four five six seven"]), bench))
    assert {r[:2] for r in got} == {(4, 3), (100, 3), (6, 4)} and len(got) == 3
    assert rows(D.matches(empty_docs(spark), bench)) == [] and rows(D.matches(odd_docs(spark), bench.limit(0))) == []
