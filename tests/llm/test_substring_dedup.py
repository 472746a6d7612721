import hashlib
import random

import numpy as np
import pytest

from fleetlens.llm import queries
from fleetlens.llm import substring_dedup as S

from .helpers import SF, empty_docs, odd_docs, rows, texts


def brute(docs):
    """(n_bytes, n_removed, n_spans, kept_sha256) by a set of all strings seen."""
    seen, out = set(), {}
    for i in sorted(docs):
        b = (docs[i] or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 99):
            w = b[p:p + 100]
            if w in seen:
                gone[p:p + 100] = b"x" * 100
            seen.add(w)
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out[i] = (len(b), len(b) - len(kept), len(bytes(gone).replace(b"\0", b" ").split()), hashlib.sha256(kept).hexdigest())
    return out


def check(df, docs):
    got = rows(df)
    want = brute(docs)
    assert len(got) == len(docs)
    assert {r[0]: r[1:] for r in got} == want


def test_query(spark):
    check(queries.op3_suffix_dedup(spark, SF), dict(texts()))


@pytest.mark.parametrize("most", [3, S.MOST])
def test_random_overlaps(spark, most):
    """Passages put into other texts, shifted, cut and repeated, also with
    more contexts than one task sorts."""
    r = random.Random(4)
    passages = ["".join(r.choice("abcde ") for _ in range(r.choice([99, 100, 101, 130, 400]))) for _ in range(6)]
    docs = {}
    for i in range(40):
        parts = []
        for _ in range(r.randint(1, 5)):
            p = r.choice(passages)
            cut = r.randint(0, 60)
            parts += ["".join(r.choice("abcde ") for _ in range(r.randint(0, 80))), p[cut:] if r.random() < 0.4 else p]
        docs[i] = "".join(parts)
    docs[40], docs[41], docs[42], docs[43] = "ab" * 300, "ab" * 200, "é" * 120, docs[3]
    df = spark.createDataFrame(list(docs.items()), "doc_id bigint, text string").repartition(5)
    check(S.remove_repeats(df, most), docs)


def test_suffix_sort_is_that_of_bytes():
    r = np.random.default_rng(1)
    rows_ = r.integers(0, 2, (60, 8)).astype(np.uint8) + 97
    size = r.integers(1, 9, 60)
    for i, n in enumerate(size):
        rows_[i, n:] = 0
    group = np.sort(r.integers(0, 5, 60))
    start = np.searchsorted(group, group)
    count = np.searchsorted(group, group, side="right") - start
    with np.errstate(over="ignore"):
        order = S.Suffixes(rows_, size).sort(start, count)
    want = sorted(range(60), key=lambda i: (group[i], bytes(rows_[i, :size[i]]), i))
    assert order.tolist() == want


def test_collisions_are_verified(monkeypatch):
    """With a hash that always collides, extensions come from the bytes."""
    monkeypatch.setattr(S, "prefix_hashes", lambda x: np.zeros((*x.shape[:-1], x.shape[-1] + 1), np.uint64))
    a, b = b"a" * 100, b"a" * 60 + b"b" * 40
    low, high = S.covered(np.zeros(2, np.int64), [b"", b""], [a, b])
    assert high.tolist() == [-1, -1]


def test_odd_rows(spark):
    docs = odd_docs(spark, ["p" * 30 + "q" * 100, "q" * 100])
    got = rows(S.remove_repeats(docs))
    assert len(got) == 12
    by = {r[0]: r[1:] for r in got}
    assert by[1] == by[2] == (0, 0, 0, hashlib.sha256().hexdigest())
    assert by[7][1:3] == (150_000 - 1, 1) and by[101][1:3] == (100, 1) and by[None][1] == 0
    assert rows(S.remove_repeats(empty_docs(spark))) == []
