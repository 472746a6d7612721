import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from fleetlens.llm import collocations as C
from fleetlens.llm import queries

from .helpers import SF, empty_docs, odd_docs, rows, texts


def count(docs):
    """{lang: Counter of phrases of one to three words, as tuples} of (lang, text)."""
    out = {}
    for lang, text in docs:
        c = out.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            for n in (1, 2, 3):
                c.update(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
    return out


def brute(docs, least=10, top=2000):
    out = []
    for lang, f in count(docs).items():
        n = sum(v for k, v in f.items() if len(k) == 1)
        cands = {k: v for k, v in f.items() if len(k) > 1 and v >= least}
        longest = Counter()
        for k, v in cands.items():
            if len(k) == 3:
                for part in (k[:2], k[1:]):
                    longest[part] = max(longest[part], v)
        scored = []
        for k, a in cands.items():
            if 100 * longest[k] >= 50 * a:
                continue
            best = min((10**6 * a * a // (f[k[:i]] * f[k[i:]]), i) for i in range(1, len(k)))
            scored.append((-best[0], -a, " ".join(k).encode(), f[k[:best[1]]], f[k[best[1]:]]))
        out += [(lang, r + 1, p.decode(), -a, x, y, n, -s) for r, (s, a, p, x, y) in enumerate(sorted(scored)[:top])]
    return sorted(out)


def invented(spark, n=400, seed=1):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)] + ["É", "ß", "ab", "Ab", "x\x1cy", "漢字"]
    make = lambda: "".join(r.choice(vocab) + r.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", " strong tea ", " as well as "])
                           for _ in range(r.randrange(60)))
    docs = [(i, make(), r.choice(["en", "de", None, "und", "fr"])) for i in range(n)]
    return docs, spark.createDataFrame([(*d, 1.0, 2) for d in docs], "doc_id bigint, text string, lang string, n double, phrase int").repartition(5)


def test_query_equals_brute_force(spark):
    got = queries.op11_phrase_collocations(spark, SF)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert [t for _, t in got.dtypes] == ["string", "bigint", "string", *["bigint"] * 5]
    want = brute(texts(columns="lang, text"))
    assert sorted(rows(got)) == want and len(want) > 100


@pytest.mark.parametrize("how", ["one trie", "many passes", "shuffle", "small blocks"])
def test_tries_passes_and_shuffle_agree_with_brute_force(spark, monkeypatch, how):
    if how != "one trie":
        monkeypatch.setattr(C, "TRIE_PHRASES", 150)
        monkeypatch.setattr(C, "TRIES_AT_ONCE", 2)
    if how == "shuffle":
        monkeypatch.setattr(C, "MOST_PASSES", 0)
        monkeypatch.setattr(C, "trie_counts", None)
    if how == "small blocks":
        for name, value in (("CHUNK", 50), ("KEYS", 100), ("BLOCK", 16), ("TRIE_PART", 7), ("BITMAP_BITS", 1 << 15)):
            monkeypatch.setattr(C, name, value)
    docs, df = invented(spark)
    want = brute([(lang, t) for _, t, lang in docs])
    assert sorted(rows(C.collocations(df))) == want and {r[0] for r in want} == {"en", "de", "fr", "und"}
    if how == "one trie":
        assert sorted(rows(C.collocations(df, 7))) == brute([(lang, t) for _, t, lang in docs], top=7)


def test_double_array_holds_its_phrases_only():
    r = np.random.default_rng(3)
    vocab = r.integers(1, 2**63, 700).astype(np.uint64)
    pick = lambda: int(vocab[min(int(r.exponential(60)), 699)])
    phrases = sorted({(lang, pick(), pick(), pick() if three else 0) for lang in ("a", "b", "c") for three in (0, 1) for _ in range(1500)})
    frame = pd.DataFrame([(*p, i) for i, p in enumerate(phrases)], columns=["lang", "a", "b", "c", "tag"])
    trie = C.build(frame)
    used = np.flatnonzero(trie["check"] >= 0)
    assert len(trie["base"]) < 3 * len(used) + 2048
    h = vocab[np.minimum(r.exponential(60, 30_000).astype(int), 699)]
    h[r.random(30_000) < 0.1] = 0
    h = np.concatenate([h, np.zeros(2, np.uint64)])
    for lang in ("a", "c", "other"):
        hits = trie["accept"][C.advance(trie, lang, h, 30_000)]
        got = Counter(trie["tags"][hits[hits >= 0]].tolist())
        known = {p[1:]: i for i, p in enumerate(phrases) if p[0] == lang}
        x = h.tolist()
        want = Counter(known[k] for i in range(30_000) for k in ((x[i], x[i + 1], 0), (x[i], x[i + 1], x[i + 2]))
                       if k in known and (k[2] or k[:2] == (x[i], x[i + 1])))
        zero_third = [i for i in range(30_000) if x[i + 2] == 0 and (x[i], x[i + 1], 0) in known]
        want.subtract(known[x[i], x[i + 1], 0] for i in zero_third)     # counted twice above
        assert got == +want


def test_words_are_split_as_by_the_pattern(monkeypatch):
    import pyarrow as pa
    r = random.Random(5)
    texts = ["".join(r.choice(["a", "B", "é", "漢", "word", "longer-than-eight-bytes", "x" * 40, " ", " ", "\t", ".", "!", "\n", "\r", "\x00"]) for _ in range(n))
             for n in (0, 1, 5, 0, 200, 3, 77, 0)]
    for block in (1, 7, 64, 1 << 22):
        monkeypatch.setattr(C, "BLOCK", block)
        got = [[] for _ in texts]
        seen = {}
        for found, of in C.word_blocks(pa.array(["skip"] + texts)[1:], 3):
            for w, d, new, h in zip(found.texts(np.arange(len(of))).to_pylist(), of, found.new, found.symbols.tolist()):
                got[d] += [[]] if new else []
                got[d][-1].append(w)
                assert seen.setdefault(w, h) == h
        assert len(set(seen.values())) == len(seen) and 0 not in seen.values()
        want = [[re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), t))] for t in texts]
        assert got == [[p for p in t if p] for t in want]


def test_words_that_share_a_symbol_are_told_apart(spark, monkeypatch):
    real = C.Words._hash
    monkeypatch.setattr(C.Words, "_hash", lambda self, salt: real(self, salt) if salt == 2 else self.sizes.astype(np.uint64))
    docs, df = invented(spark, 200)
    df = df.selectExpr("coalesce(lang, 'und') lang", "text")
    counts, salt = C.counted_words(df)
    assert salt == 2
    for k in (0, 2):
        got = {(r.lang, r.word): r.n for r in C.word_counts(df, k).collect()}
        assert got == {(lang, w[0]): n for lang, c in count([(x, t) for _, t, x in docs]).items() for w, n in c.items() if len(w) == 1}


def test_score_is_exact_beyond_64_bits(spark):
    cases = [(10, 10, 10), (3_000_000_019, 3_000_000_021, 3_000_000_027), (10**12, 10**12 + 1, 10**12), (7, 13, 7)]
    df = spark.createDataFrame(cases, "a bigint, l bigint, r bigint")
    assert [r[0] for r in df.select(C.score(C.F.col("a"), C.F.col("l"), C.F.col("r"))).collect()] == [10**6 * a * a // (x * y) for a, x, y in cases]


def test_odd_rows_and_empty_tables(spark):
    docs = odd_docs(spark, ["to be or not", "To  be\tor NOT", "to be, or not"] * 12)
    assert sorted(rows(C.collocations(docs))) == brute([(r.lang, r.text) for r in docs.collect()])
    assert rows(C.collocations(empty_docs(spark))) == []
