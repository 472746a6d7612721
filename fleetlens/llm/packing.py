"""Operator 10, best-fit packing by exact-complement hashing.

Documents become token pieces of at most ``seq_len`` ids; only piece lengths
matter for packing, so the whole problem is a histogram of at most
``seq_len`` numbers. The plan is made from that histogram: the longest
length looks up its gap among single lengths, pair sums and triple sums that
are still available and consumes as many of the exact combination as the
counts allow; what has no exact complement is packed best-fit decreasing.
The plan has patterns with multiplicities; every piece finds its place from
its rank among the pieces of its length, in parallel.

Cases: a null or empty text is the single end id; repeated rows are packed
each; a null doc_id is kept; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import base64
import functools
import json
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_id, bound_batches, full_text, pairs, rows_to_batch, stored

SEQ_LEN = 1024
END_ID = 2
# Pieces of one length are ranked in buckets of about this many.
RANK_BUCKET = 1_000
TOKENIZER = "byte_bpe_50k"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name + ".json")


def load_encoder(path: str):
    """``text -> ids`` of the tokenizer file at ``path``, without special
    tokens added. Where the same vocabulary lies beside it as plain ranks,
    those encode texts in about a fifth of the time, with the same ids
    (tested); texts that hold one of the tokenizer's added tokens, which ranks
    don't know, go through the tokenizer."""
    import os

    from tokenizers import Tokenizer
    plain = lambda text: tokenizer().encode(text, add_special_tokens=False).ids
    tokenizer = functools.cache(lambda: Tokenizer.from_file(path))
    ranks_path = path.removesuffix(".json") + ".tiktoken"
    if not os.path.exists(ranks_path):
        return plain
    import public_tokenizers
    import tiktoken
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    with open(path, encoding="utf-8") as f:
        added = [re.escape(t["content"]) for t in json.load(f).get("added_tokens", [])]
    if not added:
        return fast
    holds = re.compile("|".join(added)).search
    return lambda text: plain(text) if holds(text) else fast(text)


def cut(n: int, seq_len: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids; the first takes the rest."""
    first = n % seq_len or min(n, seq_len)
    return [(0, first)] + [(s, seq_len) for s in range(first, n, seq_len)]


def token_pieces(docs: DataFrame, path: str, seq_len: int = SEQ_LEN, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document."""
    kind, atype = arrow_id(docs, "doc_id")
    schema = pa.schema([("doc_id", atype), ("piece", pa.int32()), ("start", pa.int64()),
                        ("length", pa.int64()), ("ids_crc32", pa.int64())])
    bound_batches(docs.sparkSession)

    def run(batches):
        encode = load_encoder(path)
        for ids, texts in pairs(batches):
            rows = []
            for doc_id, text in zip(ids, texts, strict=True):
                toks = np.array([*encode(text), end_id], dtype="<u4")
                rows += [(doc_id, i, s, n, zlib.crc32(toks[s:s + n].tobytes()))
                         for i, (s, n) in enumerate(cut(len(toks), seq_len))]
            yield rows_to_batch(rows, schema)

    return docs.select("doc_id", full_text().alias("text")).mapInArrow(
        run, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def _pair(gap: int, left: np.ndarray) -> tuple[int, int] | None:
    """Two available lengths with sum ``gap``, the longest first."""
    for a in range(gap - 1, (gap - 1) // 2, -1):
        b = gap - a
        if left[a] and left[b] and (a != b or left[a] > 1):
            return a, b
    return None


def _complement(gap: int, left: np.ndarray) -> tuple[int, ...] | None:
    """One, two or three available lengths that fill ``gap`` exactly."""
    if left[gap]:
        return (gap,)
    if pair := _pair(gap, left):
        return pair
    for a in range(gap - 2, (gap + 2) // 3 - 1, -1):
        if left[a]:
            left[a] -= 1
            pair = _pair(gap - a, left)
            left[a] += 1
            if pair:
                return (a, *pair)
    return None


def plan(hist: dict[int, int], seq_len: int = SEQ_LEN) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """(multiplicity, ((length, copies), ...)) patterns that hold all of ``hist``.

    Each exact step uses up one length, so there are at most ``seq_len`` of
    them for each length; best-fit works on groups of equal bins likewise.
    """
    left = np.zeros(seq_len + 1, dtype=np.int64)
    for n, c in hist.items():
        left[n] += c
    out: list[tuple[int, tuple[tuple[int, int], ...]]] = []

    def emit(times: int, lengths) -> None:
        need = defaultdict(int)
        for n in lengths:
            need[n] += 1
        out.append((times, tuple(need.items())))

    if left[seq_len]:
        emit(int(left[seq_len]), [seq_len])
        left[seq_len] = 0
    for n in range(seq_len - 1, 0, -1):
        while left[n]:
            left[n] -= 1
            found = _complement(seq_len - n, left)
            left[n] += 1
            if not found:
                break
            need = defaultdict(int)
            for x in (n, *found):
                need[x] += 1
            times = int(min(left[x] // k for x, k in need.items()))
            for x, k in need.items():
                left[x] -= times * k
            emit(times, (n, *found))
    # best-fit decreasing over groups of equal bins: gap -> [[bins, pattern], ...]
    groups: dict[int, list] = defaultdict(list)
    for n in range(seq_len, 0, -1):
        c = int(left[n])
        while c:
            gap = min((g for g, v in groups.items() if v and g >= n), default=None)
            if gap is None:
                k = seq_len // n
                if c >= k:
                    groups[seq_len - k * n].append([c // k, ((n, k),)])
                if c % k:
                    groups[seq_len - (c % k) * n].append([1, ((n, c % k),)])
                break
            bins, pattern = groups[gap].pop()
            k = min(gap // n, max(1, c // bins))
            used = min(bins, c // k)
            groups[gap - k * n].append([used, (*pattern, (n, k))])
            if used < bins:
                groups[gap].append([bins - used, pattern])
            c -= used * k
    for v in groups.values():
        out += [(bins, pattern) for bins, pattern in v]
    return out


def slots(patterns) -> np.ndarray:
    """Where ranks of each length go: rows (length, first rank, first sequence,
    copies per sequence, offset), sorted by length and rank."""
    cursor: dict[int, int] = defaultdict(int)
    rows, seq = [], 0
    for times, pattern in patterns:
        offset = 0
        for n, k in pattern:
            rows.append((n, cursor[n], seq, k, offset))
            cursor[n] += times * k
            offset += n * k
        seq += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pack(docs: DataFrame, path: str | None = None, seq_len: int = SEQ_LEN, end_id: int = END_ID) -> DataFrame:
    """One row per piece with its ``sequence_id`` and ``offset``."""
    pieces = stored(token_pieces(docs, path or tokenizer_path(), seq_len, end_id))
    hist = {r["length"]: r["n"] for r in                       # at most seq_len rows
            pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    buckets = {n: 1 + c // RANK_BUCKET for n, c in hist.items()}
    table = slots(plan(hist, seq_len))
    many = F.element_at(F.create_map(*[F.lit(x) for kv in buckets.items() for x in kv]), F.col("length")) \
        if buckets else F.lit(1)
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), many))
    before = (dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
              .withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n"))
              .drop("n"))
    order = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece")
    ranked = (dealt.withColumn("place", F.row_number().over(order) - 1)
              .join(before, ["length", "bucket"])
              .select(*pieces.columns, (F.col("place") + F.col("before")).alias("place")))
    names = pieces.columns

    def place(batches):
        stride = int(table[:, 1].max()) + 1 if len(table) else 1
        keys = table[:, 0] * stride + table[:, 1]
        for b in batches:
            n = b.column(names.index("length")).to_numpy(zero_copy_only=False)
            rank = b.column(len(names)).to_numpy(zero_copy_only=False)
            row = table[np.searchsorted(keys, n * stride + np.minimum(rank, stride - 1), side="right") - 1]
            q = rank - row[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(i) for i in range(len(names))], pa.array(row[:, 2] + q // row[:, 3]),
                 pa.array(row[:, 4] + q % row[:, 3] * n)], names=[*names, "sequence_id", "offset"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(place, f"{fields}, sequence_id bigint, offset bigint")
