import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from fleetlens.llm import packing as P
from fleetlens.llm import queries

from .helpers import SF, empty_docs, odd_docs, texts


def check(got, docs, seq_len=1024):
    """Every document's ids come back from its pieces, sequences have no gap."""
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(P.tokenizer_path())
    want = sorted(((str(i), s, n, zlib.crc32(np.array(ids[s:s + n], "<u4").tobytes()))
                   for i, t in docs for ids in [tok.encode(t or "", add_special_tokens=False).ids + [2]]
                   for s, n in P.cut(len(ids), seq_len)))
    assert sorted((str(r.doc_id), r.start, r.length, r.ids_crc32) for r in got) == want
    seqs = defaultdict(list)
    for r in got:
        seqs[r.sequence_id].append((r.offset, r.length))
    for parts in seqs.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= seq_len
    return len(seqs)


def test_query_round_trip_and_few_sequences(spark):
    got = queries.op10_best_fit_packing(spark, SF).collect()
    n = check(got, texts())
    assert n <= 1.02 * -(-sum(r.length for r in got) // 1024) + 1


def test_pieces():
    assert P.cut(1, 1024) == [(0, 1)] and P.cut(1024, 1024) == [(0, 1024)]
    assert P.cut(2050, 1024) == [(0, 2), (2, 1024), (1026, 1024)] and P.cut(2048, 1024) == [(0, 1024), (1024, 1024)]


@pytest.mark.parametrize("seed", range(8))
def test_plan_places_all_and_is_near_the_bound(seed):
    r = random.Random(seed)
    cap = r.choice([16, 64, 1024])
    hist = {r.randint(1, cap): r.randint(1, 500) for _ in range(r.randint(1, 60))}
    patterns = P.plan(hist, cap)
    used = defaultdict(int)
    for times, pattern in patterns:
        assert times > 0 and sum(n * k for n, k in pattern) <= cap
        for n, k in pattern:
            used[n] += times * k
    assert dict(used) == hist
    bins, total = sum(t for t, _ in patterns), sum(n * c for n, c in hist.items())
    big = sum(c for n, c in hist.items() if 2 * n > cap)
    assert bins <= 1.25 * max(-(-total // cap), big) + 1


def test_exact_complements_fill_sequences():
    assert sum(t for t, _ in P.plan({700: 10, 324: 10}, 1024)) == 10
    assert sum(t for t, _ in P.plan({600: 6, 400: 6, 24: 6}, 1024)) == 6
    assert sum(t for t, _ in P.plan({500: 3, 300: 3, 200: 3, 24: 3}, 1024)) == 3


def test_fast_ids_are_the_tokenizers_ids():
    from tokenizers import Tokenizer
    tok, fast = Tokenizer.from_file(P.tokenizer_path()), P.load_encoder(P.tokenizer_path())
    assert list(fast("<|endoftext|> a")) == [50256, 257]
    r = random.Random(0)
    odd = ["", " ", "a" * 3000, "<|endoftext|> x", "a<|endoftext|><|endoftext|>\n", "<|endoftext", "é漢\U0001f600​  z", "it's 12345,678\n\n\t end ", "\x00\x01\x7f", "ſḰ"]
    odd += ["".join(chr(r.choice([r.randrange(32, 127), r.randrange(160, 0x600), r.randrange(0x3000, 0xD000)]))
                    for _ in range(200)) for _ in range(30)]
    for t in odd + [t or "" for _, t in texts()[:40]]:
        assert list(fast(t)) == tok.encode(t, add_special_tokens=False).ids


def test_odd_rows_and_ranks_in_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(P, "RANK_BUCKET", 3)
    docs = odd_docs(spark, ["same text"] * 20 + ["x <|endoftext|> y"])
    check(P.pack(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()])
    assert P.pack(empty_docs(spark)).collect() == []
