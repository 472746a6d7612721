"""Operator 3, exact substring removal by hash-compared suffix sorting.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts
earlier: in a document with a smaller doc_id, or earlier in its own.

Every such string holds ``WINDOW`` strings of ``GRAM`` bytes; the one with the
least hash is its anchor, the same one wherever the string occurs. So equal
strings meet under the hash of their anchors (one position in 26 is one),
and only anchors that occur again go on, each with the ``REACH`` bytes before
and ``LENGTH`` bytes from it. Under one hash, the contexts are sorted as
suffixes, once to the right and once (reversed) to the left: a merge sort
whose comparisons find the common extension by binary search over prefix
polynomial hashes. Neighbours' common extensions are verified byte by byte.
Contexts that share a bytes to the left and ``LENGTH - a`` to the right, by
their classes in the two orders, hold the same string; all but the earliest
are covered.

Exact copies leave before that, and of equal contexts (by a second hash of all
their bytes) only the earliest is sorted. A hash with more than ``MOST`` contexts is not sorted in one task: its strings
are grouped one by one with partial minima.

Cases: null text is empty; texts under ``LENGTH`` bytes lose nothing; rows with
the same doc_id are one document (a doc_id names one text), reported each;
rows with a null doc_id are before or after no other: they lose nothing and
take nothing from others; other columns are ignored; an empty table gives no
rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, full_text, pairs, rows_to_batch, small, stored

LENGTH, GRAM = 100, 50
WINDOW = LENGTH - GRAM + 1
REACH = LENGTH - GRAM
MOST = 20_000
CHUNK = 10_000
MOST_BROADCAST = 32 << 20  # bytes
PIECE = 1 << 18            # bytes of a long text hashed at once
_B = 0x9E3779B97F4A7C15 | 1
_INV = pow(_B, -1, 1 << 64)
_M = np.uint64(0xBF58476D1CE4E5B9)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_B, PIECE + 4 * LENGTH), _powers(_INV, PIECE + 4 * LENGTH)


def prefix_hashes(x: np.ndarray) -> np.ndarray:
    """Polynomial hashes of all prefixes, along the last axis, modulo 2**64."""
    n = x.shape[-1]
    out = np.zeros((*x.shape[:-1], n + 1), np.uint64)
    np.cumsum((x.astype(np.uint64) + np.uint64(1)) * _UP[:n], axis=-1, dtype=np.uint64, out=out[..., 1:])
    return out


def _slide(x: np.ndarray, w: int, op, pad) -> np.ndarray:
    """``op`` (minimum or maximum) over every window of ``w``."""
    n = len(x)
    full = np.full(-(-n // w) * w, pad, x.dtype)
    full[:n] = x
    grid = full.reshape(-1, w)
    ahead = op.accumulate(grid, axis=1).ravel()
    back = op.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(back[:n - w + 1], ahead[w - 1:n])


def scrambled(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _M
    return h ^ (h >> np.uint64(29))


def anchors(b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of the anchors of a text's strings, with the hashes of their
    grams and of their contexts."""
    out = []
    for s in range(0, max(len(b) - LENGTH + 1, 0), PIECE):
        lead = min(s, REACH)
        p = prefix_hashes(b[s - lead:s + PIECE + 2 * LENGTH])
        n = min(PIECE + LENGTH - 1, len(b) - s)                  # bytes of this piece's strings
        at = np.arange(lead, lead + n - GRAM + 1)
        h = scrambled((p[at + GRAM] - p[at]) * _DOWN[at])
        least = _slide(h, WINDOW, np.minimum, np.uint64(2 ** 64 - 1))
        edge = np.zeros(WINDOW - 1, np.uint64)
        k = np.flatnonzero(_slide(np.concatenate([edge, least, edge]), WINDOW, np.maximum, np.uint64(0)) == h)
        c0, c1 = np.maximum(k + lead - REACH, 0), np.minimum(k + lead + LENGTH, len(p) - 1)
        size = (k + lead - c0) * 1000 + (c1 - k - lead)
        context = scrambled((p[c1] - p[c0]) * _DOWN[c0] + size.astype(np.uint64) * _M)
        out.append((k + s, h[k], context))
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64)
    pos, h, c = (np.concatenate(x) for x in zip(*out, strict=True))
    pos, first = np.unique(pos, return_index=True)
    return pos, h[first], c[first]


class Suffixes:
    """Rows of bytes (``n`` x width, lengths ``size``) compared by hashes."""

    def __init__(self, rows: np.ndarray, size: np.ndarray):
        self.rows, self.size = rows, size
        self.hash = prefix_hashes(rows)

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common extension of rows ``i`` and ``j`` by binary search."""
        low, high = np.zeros(len(i), np.int64), np.minimum(self.size[i], self.size[j])
        while (low < high).any():
            mid = (low + high + 1) >> 1
            same = self.hash[i, mid] == self.hash[j, mid]
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low

    def after(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """-1, 0 or 1: how row ``i`` compares with row ``j``."""
        c = self.common(i, j)
        ei, ej = c >= self.size[i], c >= self.size[j]
        at = np.minimum(c, self.rows.shape[1] - 1)
        x, y = self.rows[i, at].astype(np.int64), self.rows[j, at].astype(np.int64)
        return np.where(ei | ej, ej.astype(np.int64) - ei, np.sign(x - y))

    def sort(self, start: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Order of the rows, sorted within groups (each row's group start and
        size): merge sort of all groups at once."""
        order = np.arange(len(start))
        place = order - start
        run = 1
        while run < count.max(initial=0):
            act = np.flatnonzero(count > run)
            li, gs, gc = place[act], start[act], count[act]
            sib = (li // run) ^ 1
            low, end = gs + np.minimum(sib * run, gc), gs + np.minimum((sib + 1) * run, gc)
            first, right = low.copy(), (li // run) & 1
            me = order[act]
            while (open_ := low < end).any():
                q = np.flatnonzero(open_)
                mid = (low[q] + end[q]) >> 1
                c = self.after(order[mid], me[q])
                goes = (c < 0) | ((c == 0) & (right[q] == 1))
                low[q] = np.where(goes, mid + 1, low[q])
                end[q] = np.where(goes, end[q], mid)
            new = order.copy()
            new[gs + li // (2 * run) * (2 * run) + li % run + (low - first)] = me
            order = new
            run *= 2
        return order

    def classes(self, start: np.ndarray, count: np.ndarray):
        """A function of a length: the class of each row by its first bytes."""
        order = self.sort(start, count)
        i, j = order[:-1], order[1:]
        same = start[i] == start[j]
        ext = np.where(same, self.common(i, j), -1)
        for a in range(0, len(i), 4096):             # collisions: verify the bytes of the extension
            s = slice(a, a + 4096)
            within = np.arange(self.rows.shape[1]) < ext[s, None]
            differ = (self.rows[i[s]] != self.rows[j[s]]) & within
            if differ.any():
                ext[s] = np.where(differ.any(axis=1), differ.argmax(axis=1), ext[s])
        out = np.empty(len(order), np.int64)

        def at(length: int) -> np.ndarray:
            out[order] = np.concatenate([[0], np.cumsum(ext < length)])
            return out.copy()

        return at


def covered(group: np.ndarray, left: list[bytes], right: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For contexts in document order within sorted ``group``: the least and
    the greatest reach to the left of their repeated strings, or -1."""
    n = len(group)
    start = np.searchsorted(group, group)
    count = np.searchsorted(group, group, side="right") - start

    def matrix(parts, width):
        m = np.zeros((n, width), np.uint8)
        for k, p in enumerate(parts):
            m[k, :len(p)] = np.frombuffer(p, np.uint8)
        return m

    nl, nr = np.array([len(x) for x in left]), np.array([len(x) for x in right])
    by_left = Suffixes(matrix([x[::-1] for x in left], REACH), nl).classes(start, count)
    by_right = Suffixes(matrix(right, LENGTH), nr).classes(start, count)
    low, high = np.full(n, -1), np.full(n, -1)
    for a in range(REACH + 1):
        ok = np.flatnonzero((nl >= a) & (nr >= LENGTH - a) & (count > 1))
        if not len(ok):
            continue
        key = by_left(a)[ok] * n + by_right(LENGTH - a)[ok]
        _, first, back = np.unique(key, return_index=True, return_inverse=True)
        again = ok[first[back] != np.arange(len(ok))]
        low[again] = np.where(low[again] < 0, a, low[again])
        high[again] = a
    return low, high


def repeated_anchors(texts: DataFrame, most: int) -> DataFrame:
    """(doc_id, at, low, high, hot): anchors whose gram occurs again. Those
    whose whole context occurred before are covered from ``low`` to ``high``;
    for the first of each context ``low`` is -1: it has to be sorted, unless
    its gram has no other context. A row with ``hot`` names a gram with more
    than ``most`` contexts.

    Equal contexts of a batch leave it as one row to be compared (the others
    keep a key of their own); the rest is decided by sorted neighbours, so a
    task holds no group.
    """
    names = ["gram", "context", "doc_id", "at", "after"]
    fields = pa.schema([("gram", pa.int64()), ("context", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int32()),
                        ("after", pa.int16())])

    def find(batches):
        with np.errstate(over="ignore"):
            for ids, docs in pairs(batches):
                parts = []
                for i, t in sorted(zip(ids, docs, strict=True), key=lambda x: x[0]):
                    b = np.frombuffer(t.encode("utf-8", "surrogatepass"), np.uint8)
                    pos, h, c = anchors(b)
                    parts.append((h.view(np.int64), c.view(np.int64), np.full(len(pos), i, np.int64), pos,
                                  np.minimum(len(b) - pos, LENGTH)))
                if not parts:
                    continue
                g, c, d, p, after = (np.concatenate(x) for x in zip(*parts, strict=True))
                both = g ^ (c * np.int64(3))
                _, first = np.unique(both, return_index=True)
                later = np.ones(len(g), bool)
                later[first] = False
                after = np.where(later, -after, after)           # covered rows go anywhere
                g = np.where(later, d * 1_000_003 + p * 7919, g)
                yield pa.RecordBatch.from_arrays([pa.array(g), pa.array(c), pa.array(d), pa.array(p.astype(np.int32)),
                                                  pa.array(after.astype(np.int16))], schema=fields)

    out = pa.schema([("doc_id", pa.int64()), ("at", pa.int32()), ("low", pa.int32()), ("high", pa.int32()),
                     ("hot", pa.int64())])

    def rows(d, p, low, high, hot=None):
        return pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(p, pa.int32()), pa.array(low, pa.int32()),
                                           pa.array(high, pa.int32()), pa.array(hot if hot is not None else [None] * len(d), pa.int64())],
                                          schema=out)

    def neighbours(batches):
        held = None                  # the last first-of-context: (gram, context, doc, at), sent already, contexts so far
        for b in batches:
            if not b.num_rows:
                continue
            g, c, d, p, after = (x.to_numpy(zero_copy_only=False) for x in b.columns)
            done = after < 0
            nl, nr = np.minimum(p, REACH), np.abs(after)
            low, high = np.maximum(LENGTH - nr, 0), nl
            use = done & (low <= high)
            yield rows(d[use], p[use], low[use], high[use])
            k = np.flatnonzero(~done)
            if not len(k):
                continue
            g, c, d, p, low, high = g[k], c[k], d[k], p[k], low[k], high[k]
            new_gram = np.concatenate([[held is None or held[0] != g[0]], g[1:] != g[:-1]])
            new = new_gram | np.concatenate([[held is None or held[1] != c[0]], c[1:] != c[:-1]])
            use = ~new & (low <= high)
            yield rows(d[use], p[use], low[use], high[use])
            r = np.flatnonzero(new)
            if not len(r):
                continue
            if held is not None and not new_gram[r[0]] and not held[4]:
                yield rows([held[2]], [held[3]], [-1], [-1])
            again = ~new_gram[r]                                    # an earlier context has the gram
            ahead = np.concatenate([again[1:], [False]])            # a later one in this batch has
            send = again | ahead
            yield rows(d[r[send]], p[r[send]], np.full(send.sum(), -1), np.full(send.sum(), -1))
            runs = np.flatnonzero(np.concatenate([[True], ~again[1:]]))
            sizes = np.diff(np.concatenate([runs, [len(r)]]))
            before = held[5] if held is not None and again[0] else 0
            sizes[0] += before
            hot = [int(g[r[a]]) for i, (a, n) in enumerate(zip(runs, sizes, strict=True))
                   if n > most and not (i == 0 and before > most)]
            if hot:
                yield rows([None] * len(hot), [None] * len(hot), [None] * len(hot), [None] * len(hot), hot)
            held = (g[r[-1]], c[r[-1]], int(d[r[-1]]), int(p[r[-1]]), bool(send[-1]), int(sizes[-1]))

    bound_batches(texts.sparkSession)
    found = (texts.mapInArrow(find, "gram bigint, context bigint, doc_id bigint, at int, after smallint")
             .repartition(shuffles(texts), "gram").sortWithinPartitions("gram", "context", "doc_id", "at").select(names))
    return found.mapInArrow(neighbours, "doc_id bigint, at int, low int, high int, hot bigint")


def shuffles(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def by_document(reach: DataFrame) -> DataFrame:
    """(doc_id, places, spans, hot): 32-bit positions to be sorted, and merged
    (start, end) to be removed, of each document; the row without doc_id has
    the hot grams."""
    fields = pa.schema([("doc_id", pa.int64()), ("places", pa.binary()), ("spans", pa.binary()),
                        ("hot", pa.list_(pa.int64()))])

    def run(batches):
        for b in batches:
            out = []
            for d, found in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if d is None:
                    out.append((None, b"", b"", [f["hot"] for f in found]))
                    continue
                places = np.array(sorted(f["at"] for f in found if f["low"] < 0), dtype="<i4")
                spans = merged(sorted((f["at"] - f["high"], f["at"] - f["low"] + LENGTH) for f in found if f["low"] >= 0))
                out.append((d, places.tobytes(), np.array(spans, dtype="<i4").tobytes(), []))
            yield rows_to_batch(out, fields)

    return (reach.groupBy("doc_id").agg(F.collect_list(F.struct("at", "low", "high", "hot")).alias("found"))
            .mapInArrow(run, "doc_id bigint, places binary, spans binary, hot array<bigint>"))


def merged(spans) -> list[list[int]]:
    """Sorted (start, end) joined where they touch."""
    out: list[list[int]] = []
    for s, e in spans:
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def few_bytes(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with a broadcast hint if its binary columns are small."""
    size = df.agg(F.sum(sum((F.octet_length(c) + 32 for c in columns), F.lit(0)))).first()[0] or 0
    return F.broadcast(df) if size <= MOST_BROADCAST else df


def contexts(texts: DataFrame) -> DataFrame:
    """(gram, doc_id, at, left, right) of ``texts`` (doc_id, text, places)."""
    fields = pa.schema([("gram", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int32()), ("left", pa.binary()),
                        ("right", pa.binary())])

    def run(batches):
        with np.errstate(over="ignore"):
            for batch in batches:
                rows = []
                for d, t, places in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    b = t.encode("utf-8", "surrogatepass")
                    at = np.frombuffer(places, "<i4").astype(np.int64)
                    grams = np.lib.stride_tricks.sliding_window_view(np.frombuffer(b, np.uint8), GRAM)
                    for j in range(0, len(at), 4096):
                        part = at[j:j + 4096]
                        h = scrambled(((grams[part].astype(np.uint64) + np.uint64(1)) * _UP[:GRAM]).sum(axis=1, dtype=np.uint64))
                        rows += [(g, d, q, b[max(0, q - REACH):q], b[q:q + LENGTH])
                                 for g, q in zip(h.view(np.int64).tolist(), part.tolist(), strict=True)]
                    if len(rows) > 20_000:
                        yield rows_to_batch(rows, fields)
                        rows = []
                yield rows_to_batch(rows, fields)

    return texts.mapInArrow(run, "gram bigint, doc_id bigint, at int, left binary, right binary")


def sorted_reach(found: DataFrame) -> DataFrame:
    """(doc_id, at, low, high) of the contexts, from suffix sorts of whole hashes."""
    out = pa.schema([("doc_id", pa.int64()), ("at", pa.int32()), ("low", pa.int32()), ("high", pa.int32())])

    def solve(rows):
        gram = np.array([r[0] for r in rows])
        with np.errstate(over="ignore"):
            low, high = covered(gram, [r[3] for r in rows], [r[4] for r in rows])
        return rows_to_batch([(r[1], r[2], a, b) for r, a, b in zip(rows, low.tolist(), high.tolist(), strict=True) if a >= 0], out)

    def run(batches):
        rows: list[tuple] = []
        for batch in batches:
            rows += zip(*(c.to_pylist() for c in batch.columns), strict=True)
            if len(rows) >= CHUNK and rows[0][0] != rows[-1][0]:
                k = next(i for i in range(len(rows) - 1, -1, -1) if rows[i][0] != rows[-1][0]) + 1
                yield solve(rows[:k])
                rows = rows[k:]
        if rows:
            yield solve(rows)

    dealt = found.repartition(shuffles(found), "gram").sortWithinPartitions("gram", "doc_id", "at")
    return dealt.mapInArrow(run, "doc_id bigint, at int, low int, high int")


def counted_reach(found: DataFrame) -> DataFrame:
    """The same for hashes with too many contexts: each of their strings by
    itself, with partial minima before the shuffle."""
    fields = pa.schema([("string", pa.binary()), ("doc_id", pa.int64()), ("start", pa.int32())])

    def run(batches):
        for b in batches:
            rows = []
            for d, p, left, right in zip(*(c.to_pylist() for c in b.columns), strict=True):
                whole, k = left + right, len(left)
                rows += [(hashlib.blake2b(whole[k - a:k - a + LENGTH], digest_size=16).digest(), d, p - a)
                         for a in range(k + 1) if len(whole) - k + a >= LENGTH]
            yield rows_to_batch(rows, fields)

    strings = found.select("doc_id", "at", "left", "right").mapInArrow(run, "string binary, doc_id bigint, start int")
    first = strings.groupBy("string").agg(F.min(F.struct("doc_id", "start")).alias("first"))
    return (strings.join(first, "string").where(F.struct("doc_id", "start") != F.col("first"))
            .select("doc_id", F.col("start").alias("at"), F.lit(0).alias("low"), F.lit(0).alias("high")))


def spans(docs: DataFrame, most: int = MOST) -> DataFrame:
    """(doc_id, text, whole, spans): ``whole`` if the text is a later copy;
    ``spans`` are the merged (start, end) to be removed."""
    bound_batches(docs.sparkSession)
    texts = docs.select("doc_id", full_text().alias("text"))
    long = texts.where((F.octet_length("text") >= LENGTH) & F.col("doc_id").isNotNull())
    named = stored(long.select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("copy")).distinct())
    first = named.groupBy("copy").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    later = small(stored(named.join(first, "copy").where("doc_id <> first").select("doc_id")))
    fresh = long.join(later, "doc_id", "left_anti")
    if repeated_ids(named):
        fresh = fresh.dropDuplicates(["doc_id"])
    met = stored(by_document(repeated_anchors(fresh, most)))
    hot = met.where("doc_id is null").select(F.explode("hot").alias("gram")).distinct()
    places = few_bytes(met.where("octet_length(places) > 0").select("doc_id", "places"), ["places"])
    found = contexts(fresh.join(places, "doc_id").select("doc_id", "text", "places"))
    if hot.isEmpty():
        reach = sorted_reach(found)
    else:
        reach = (sorted_reach(found.join(small(hot), "gram", "left_anti"))
                 .union(counted_reach(found.join(small(hot), "gram"))))
    more = by_document(reach.withColumn("hot", F.lit(None).cast("bigint")))
    removed = stored(met.where("doc_id is not null").select("doc_id", "spans").union(more.select("doc_id", "spans"))
                     .where("octet_length(spans) > 0")
                     .groupBy("doc_id").agg(F.collect_list("spans").alias("spans")))
    size = removed.agg(F.sum(F.aggregate("spans", F.lit(40), lambda n, x: n + F.octet_length(x) + 16))).first()[0] or 0
    return (texts.join(later.withColumn("whole", F.lit(True)), "doc_id", "left")
            .join(F.broadcast(removed) if size <= MOST_BROADCAST else removed, "doc_id", "left"))


def repeated_ids(named: DataFrame) -> bool:
    return not named.groupBy("doc_id").count().where("count > 1").isEmpty()


def remove_repeats(docs: DataFrame, most: int = MOST) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document."""
    fields = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                        ("n_spans", pa.int64()), ("kept_sha256", pa.string())])

    def run(batches):
        for b in batches:
            rows = []
            for d, t, whole, found in zip(*(c.to_pylist() for c in b.columns), strict=True):
                x = t.encode("utf-8", "surrogatepass")
                cuts, kept, at = 0, hashlib.sha256(), 0
                end = 0
                for s, e in ([(0, len(x))] if whole else merged(sorted(
                        p for f in found or () for p in np.frombuffer(f, "<i4").reshape(-1, 2).tolist()))):
                    kept.update(x[end:s])
                    at += s - end
                    cuts += 1
                    end = e
                kept.update(x[end:])
                at += len(x) - end
                rows.append((d, len(x), len(x) - at, cuts, kept.hexdigest()))
            yield rows_to_batch(rows, fields)

    return spans(docs, most).select("doc_id", "text", "whole", "spans").mapInArrow(
        run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
