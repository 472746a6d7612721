import hashlib
import re

import duckdb
import pytest

from fleetlens.llm import exact_dedup as D
from fleetlens.llm import queries

from .helpers import SF, empty_docs, odd_docs, rows, texts


def brute(docs):
    """[(doc_id, keep_id, group_size, kept, sha256, n)] of (doc_id, text) pairs."""
    groups = {}
    for place, (i, t) in enumerate(docs):
        key = hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", t or "").encode()).hexdigest()
        groups.setdefault(key, []).append((-len(t or ""), i is None, i or 0, place, i))
    out = []
    for key, members in groups.items():
        members.sort(key=lambda m: m[:4])
        out += [(m[4], members[0][4], len(members), m is members[0], key, -m[0]) for m in members]
    return sorted(out, key=repr)


def test_query_equals_sql(spark):
    got = queries.op12_exact_dedup(spark, SF)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = con.execute(D.ORACLE)
    assert got.columns == [c[0] for c in want.description]
    assert sorted(rows(got)) == sorted(want.fetchall())
    assert sorted(rows(got), key=repr) == brute(texts())


@pytest.mark.parametrize("counters", [2, 1024])
def test_hot_groups_ties_and_odd_rows(spark, counters):
    extra = ["a b\nc", "abc", "a\tbc ", "A bc"] * 40 + [f"once {i}" for i in range(200)] + ["x y"] * 300 + ["a\x85b", "a\xa0b", "ab"]
    docs = odd_docs(spark, extra).repartition(7)
    got = rows(D.groups(docs, counters))
    assert sorted(got, key=repr) == brute([(r.doc_id, r.text) for r in docs.collect()])
    kept = D.keep_one(docs, counters)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, len(r.text or "")) for r in kept.collect() if r.doc_id is not None) == sorted(
        (g[0], g[5]) for g in got if g[3] and g[0] is not None)


def test_frequent_digests_leave_the_shuffle(spark):
    docs = spark.range(9000).selectExpr("id doc_id", "if(id % 3 = 0, 'same text', concat('text ', id)) text")
    base = docs.select("doc_id", D.digest().alias("digest"))
    heads = D.frequent(base, 64)
    hot = base.where("doc_id = 0").selectExpr("xxhash64(digest) h").first().h
    assert hot in {r.head for r in heads.collect()} and heads.count() <= 64
    plan = D.groups(docs, 64)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan and "LeftAnti" in plan


def test_empty_table(spark):
    assert rows(D.groups(empty_docs(spark))) == [] and rows(D.keep_one(empty_docs(spark))) == []
