"""Operator 11, phrase collocation mining with broadcast double-array tries.

Phrases of two and three words that occur often enough are scored, per
language, by how much more often they occur than their two parts would let
expect. Counting phrases as text would shuffle every phrase of the corpus;
here only candidates are counted, where the text is:

1. Words are counted per language (each block of text sums its own first).
   Words have 64-bit hashes as symbols; words are compared byte by byte
   with the one that their symbol stands for, and another salt is taken if
   two words of a language share a symbol.
2. The text becomes arrays of symbols, 0 between pieces and for words that
   are too rare to be in any candidate. Frequent words are known from a
   bitmap of bounded size, which may let rare ones pass, never the reverse.
3. Apriori-safe candidates: sums of hashed word pairs bound the pairs' counts
   from above; pairs below the threshold are out, and so is every triple that
   holds one (a second bitmap); the other triples are bounded likewise. What
   passes is a superset of all frequent phrases, whatever the hashes do. The
   sums are made of sorted arrays of short hashes. Of the tasks that hold a
   candidate one is picked to name its words.
4. Candidates become double-array tries of at most ``TRIE_PHRASES`` phrases,
   built in tasks. A path is the language, then the words, each symbol three
   digits of eight bits. At most ``TRIES_AT_ONCE`` tries are broadcast in a
   pass over the symbol arrays: the states of all text positions advance
   together, one digit a step, in numpy; accepting states are counted with
   ``bincount`` and the tasks' counts summed. These counts are exact.
5. If there are more candidates than ``MOST_PASSES`` passes can hold, they are
   counted by shuffling the positions' symbols instead (the same rows).
6. Parts, scores (decimal arithmetic), contained phrases and ranks are joins
   and windows over the frequent phrases alone.

Cases: a null text is empty, a null lang is ``und``; repeated rows count each
time; an empty table gives no rows; other columns of any name are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches, full_text, stored

# Fixed by the task.
LEAST = 10
TOP = 2000
CONTAINED_PERCENT = 50
SCALE = 1_000_000
# Lower-cases A-Z; piece ends become a full stop, tabs a blank. No word holds either.
ENDS = b".,;:!?\n\x0b\x0c\r"
TEXT_BYTES = bytes(c + 32 if 65 <= c <= 90 else 46 if c in ENDS else 32 if c == 9 else c for c in range(256))
# Of translated bytes: 0 in a word, 1 a blank, 2 the end of a piece.
KINDS = np.array([2 if c == 46 else 1 if c == 32 else 0 for c in range(256)], dtype=np.uint8)
LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)     # the low k bytes

BLOCK = 1 << 22             # bytes of text that are split at once
CHUNK = 1 << 20             # symbols in a row of the symbol table
KEYS = 6 << 20              # hashed phrases that a task sorts at once
BITMAP_BITS = 1 << 27       # 16 MB at most
TRIE_PHRASES = 250_000
TRIES_AT_ONCE = 4
MOST_PASSES = 16
TRIE_PART = 1 << 12         # phrases whose counts are summed together
MIX = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def spread(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit integers."""
    x = (x ^ (x >> np.uint64(29))) * MIX[0]
    x = (x ^ (x >> np.uint64(32))) * MIX[1]
    return x ^ (x >> np.uint64(29))


class Words:
    """The words of a block of text: where each starts and how long it is,
    whether a piece or document ends before it, the document it is in, and its
    symbol. Words are read as 8-byte windows, all of them together."""

    def __init__(self, data: np.ndarray, heads: np.ndarray, ended: bool, salt: int):
        """``data``: translated bytes; ``heads``: where documents start; ``ended``: a piece ends just before."""
        n = len(data)
        kind = KINDS[data]
        head = np.zeros(n + 1, dtype=bool)
        head[heads] = True
        word = np.append(kind == 0, False)
        before = np.concatenate([[False], word[:-1]])
        self.data = data
        self.starts = np.flatnonzero(word & (~before | head))
        self.sizes = np.flatnonzero(before & (~word | head)) - self.starts
        ends = np.cumsum((kind == 2) | head[:n], dtype=np.int32)
        at = ends[self.starts]
        self.new = np.empty(len(at), dtype=bool)
        if len(at):
            self.new[0] = ended or at[0] > 0
            np.not_equal(at[1:], at[:-1], out=self.new[1:])
            self.ended = bool(ends[-1] != at[-1])
        else:
            self.ended = ended or bool(n and ends[-1])
        padded = np.concatenate([data, np.zeros(8, np.uint8)]).tobytes()
        self.window = np.ndarray(shape=(n + 1,), dtype="<u8", buffer=padded, strides=(1,))
        self.symbols = self._hash(salt)

    def _part(self, at: np.ndarray, k: int) -> np.ndarray:
        """Bytes 8k to 8k+7 of the words ``at`` (zeros behind their ends)."""
        return self.window[self.starts[at] + 8 * k] & LOW[np.minimum(self.sizes[at] - 8 * k, 8)]

    def _hash(self, salt: int) -> np.ndarray:
        h = spread(self.sizes.astype(np.uint64) * MIX[2] + np.uint64(salt))
        at, k = np.arange(len(h)), 0
        while len(at):
            h[at] = spread(h[at] ^ self._part(at, k))
            k += 1
            at = at[self.sizes[at] > 8 * k]
        return np.maximum(h, np.uint64(1))                  # 0 parts pieces

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether words ``a[i]`` and ``b[i]`` are the same bytes."""
        same = self.sizes[a] == self.sizes[b]
        at, k = np.flatnonzero(same), 0
        while len(at):
            same[at] = ok = self._part(a[at], k) == self._part(b[at], k)
            k += 1
            at = at[ok]
            at = at[self.sizes[a[at]] > 8 * k]
        return same

    def texts(self, at: np.ndarray) -> pa.Array:
        ends = np.concatenate([[0], np.cumsum(self.sizes[at])])
        places = np.repeat(self.starts[at] - ends[:-1], self.sizes[at]) + np.arange(ends[-1])
        return pa.Array.from_buffers(pa.string(), len(at), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(self.data[places].tobytes())])


def word_blocks(texts: pa.Array, salt: int):
    """(``Words``, document of each word) of a batch of texts, in blocks that end between words."""
    texts = texts.cast(pa.large_binary())
    ends = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    if raw is None or not len(texts):
        return
    data = np.frombuffer(raw.to_pybytes()[ends[0]:ends[-1]].translate(TEXT_BYTES), dtype=np.uint8)
    heads = ends[:-1] - ends[0]
    at, ended = 0, True
    while at < len(data):
        end = min(at + BLOCK, len(data))
        while end < len(data) and KINDS[data[end]] == 0:            # on to the end of the word
            more = np.flatnonzero(KINDS[data[end:end + BLOCK]])
            end = end + int(more[0]) if len(more) else min(end + BLOCK, len(data))
        found = Words(data[at:end], heads[np.searchsorted(heads, at):np.searchsorted(heads, end)] - at, ended, salt)
        yield found, np.searchsorted(heads, found.starts + at, side="right") - 1
        at, ended = end, found.ended


def of_langs(langs: pa.Array, docs: np.ndarray):
    """(lang, places of its words) for the languages of a block."""
    coded = langs.dictionary_encode()
    if len(coded.dictionary) == 1:
        yield coded.dictionary[0].as_py(), np.arange(len(docs))
        return
    code = coded.indices.to_numpy()[docs]
    for c in np.unique(code):
        yield coded.dictionary[int(c)].as_py(), np.flatnonzero(code == c)


def word_counts(docs: DataFrame, salt: int) -> DataFrame:
    """(lang, word, h, n): all words, their symbols and counts. Every word is
    compared with the one that stands for its symbol in its block; words that
    only share a symbol are counted apart."""
    schema = pa.schema([("lang", pa.string()), ("word", pa.string()), ("h", pa.int64()), ("n", pa.int64())])

    def rows(found, lang, at):
        h = found.symbols[at]
        order = np.argsort(h)
        new = np.concatenate([[True], h[order][1:] != h[order][:-1]])
        first = at[order[new]]
        group = np.cumsum(new) - 1
        same = found.equal(at[order], first[group])
        yield (lang, first, np.bincount(group[same], minlength=len(first)))
        if not same.all():
            yield (lang, at[order[~same]], np.ones(int((~same).sum()), np.int64))

    def run(batches):
        for b in batches:
            for found, of in word_blocks(b.column(1), salt):
                for lang, at in of_langs(b.column(0), of):
                    for lang, words, n in rows(found, lang, at):
                        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(words), pa.string()), found.texts(words),
                                                          pa.array(found.symbols[words].view(np.int64)), pa.array(n.astype(np.int64))], schema=schema)

    return (docs.mapInArrow(run, "lang string, word string, h bigint, n bigint")
            .groupBy("lang", "h", "word").agg(F.sum("n").alias("n")))


def counted_words(docs: DataFrame) -> tuple[DataFrame, int]:
    """``word_counts`` under a salt by which no two words of a language share a symbol, and the salt."""
    for salt in range(64):
        counts = stored(word_counts(docs, salt))
        if counts.groupBy("lang", "h").agg(F.count(F.lit(1)).alias("words")).where("words > 1").isEmpty():
            return counts, salt
    raise RuntimeError("no salt keeps the words apart")


def bitmap(keys: DataFrame, name: str) -> np.ndarray:
    """A bit at each key's hash, of 64 bits a key or ``BITMAP_BITS`` in all:
    made in tasks by blocks of 4 KB, and so bounded on the driver too."""
    bits = min(BITMAP_BITS, max(1 << 15, 1 << (64 * keys.count()).bit_length()))
    at = F.pmod(F.col(name), F.lit(bits)) + 1           # Spark's blocks count from 1
    blocks = (keys.groupBy(F.bitmap_bucket_number(at).alias("block"))
              .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).collect())
    out = np.zeros(bits // 8, dtype=np.uint8)
    for r in blocks:
        out[(r.block - 1) * 4096:r.block * 4096] = np.frombuffer(r.bits, dtype=np.uint8)
    return out


def known(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys & np.uint64(8 * len(bits) - 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def symbol_arrays(docs: DataFrame, frequent, salt: int) -> DataFrame:
    """(lang, source, symbols): 64-bit symbols (compressed), 0 between pieces
    and documents and for runs of rare words; ``source`` numbers the task that
    made the row. A row starts phrases at its first ``CHUNK`` symbols; two
    more follow to end them."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.int64()), ("symbols", pa.binary())])

    def rows(lang, parts):
        h = np.concatenate([*parts, np.zeros(1, np.uint64)])
        h = h[(h != 0) | np.concatenate([[True], h[:-1] != 0])]
        for i in range(0, len(h), CHUNK):
            data = pa.Codec("zstd", compression_level=1).compress(h[i:i + CHUNK + 2].tobytes(), asbytes=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang], pa.string()), pa.array([TaskContext.get().partitionId()], pa.int64()),
                                              pa.array([len(h[i:i + CHUNK + 2]).to_bytes(8, "little") + data], pa.binary())], schema=schema)

    def run(batches):
        bits, held, size = frequent.value, {}, 0
        for b in batches:
            for found, of in word_blocks(b.column(1), salt):
                for lang, at in of_langs(b.column(0), of):
                    new = found.new[at]         # also where words of other languages lie between
                    h = np.zeros(len(at) + int(new.sum()), np.uint64)
                    own = found.symbols[at]
                    h[np.arange(len(at)) + np.cumsum(new)] = np.where(known(bits, own), own, np.uint64(0))
                    held.setdefault(lang, []).append(h)
                    size += len(h)
            if size >= CHUNK:
                for lang, parts in held.items():
                    yield from rows(lang, parts)
                held, size = {}, 0
        for lang, parts in held.items():
            yield from rows(lang, parts)

    return docs.mapInArrow(run, "lang string, source bigint, symbols binary")


def arrays(batches):
    """(lang, source, symbols with two zeros behind them, number of places that start a phrase) of each row."""
    for b in batches:
        for lang, source, x in zip(*(c.to_pylist() for c in b.columns), strict=True):
            n = int.from_bytes(x[:8], "little")
            h = np.frombuffer(pa.Codec("zstd").decompress(x[8:], 8 * n), dtype=np.uint64)
            yield lang, source, np.concatenate([h, np.zeros(2, np.uint64)]), min(n, CHUNK)


def pair_keys(lang: np.uint64, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return spread(a * MIX[1] + spread(b + lang))


def triple_keys(pair: np.ndarray, c: np.ndarray) -> np.ndarray:
    return spread(pair * MIX[2] + c)


def lang_key(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))


def phrase_keys(lang: str, h: np.ndarray, n: int, parts: int, pairs_bits=None):
    """(places, pair keys, triple keys or None) of the places that start a
    phrase; with a bitmap only known pairs, and triples of two known pairs."""
    a, b, c = h[:n], h[1:n + 1], h[2:n + 2]
    at = np.flatnonzero((a != 0) & (b != 0))
    first = pair_keys(lang_key(lang), a[at], b[at])
    if pairs_bits is None:
        return at, first, None
    ok = known(pairs_bits, folded(first, parts))
    at, first = at[ok], first[ok]
    second = folded(pair_keys(lang_key(lang), b[at], c[at]), parts)
    return at, first, np.where((c[at] != 0) & known(pairs_bits, second), np.maximum(triple_keys(first, c[at]), np.uint64(1)), np.uint64(0))


SUMS = pa.schema([("part", pa.int32()), ("source", pa.int64()), ("keys", pa.binary()), ("n", pa.binary())])
PACKED = "part int, source bigint, keys binary, n binary"


def packed(part: np.ndarray, source: int, keys: np.ndarray, n: np.ndarray):
    """A row for each run of equal ``part``, which is sorted."""
    if len(part):
        cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
        spans = list(zip(cuts[:-1], cuts[1:], strict=True))
        yield pa.RecordBatch.from_arrays([
            pa.array(part[cuts[:-1]], pa.int32()), pa.array([source] * len(spans), pa.int64()),
            pa.array([keys[a:b].tobytes() for a, b in spans], pa.binary()), pa.array([n[a:b].tobytes() for a, b in spans], pa.binary())], schema=SUMS)


def summed(rows: DataFrame, parts: int, key_type, n_type) -> DataFrame:
    """(part, key, n, source) of the keys whose counts add up to ``LEAST`` or
    more, with one source that has the key. Tasks send arrays of their keys, a
    row for each share of the keys, and the arrays of a share are merged: no
    row per key is shuffled."""
    schema = pa.schema([("part", pa.int32()), ("key", pa.int64()), ("n", pa.int64()), ("source", pa.int64())])

    def run(batches):
        held: dict[int, list] = {}
        for b in batches:
            for part, source, keys, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                held.setdefault(part, []).append((source, np.frombuffer(keys, key_type), np.frombuffer(n, n_type)))
        while held:
            part, own = held.popitem()
            keys, n = (np.concatenate([x[i] for x in own]) for i in (1, 2))
            source = np.repeat(np.array([x[0] for x in own], dtype=np.int64), [len(x[1]) for x in own])
            order = np.argsort(keys)
            keys = keys[order]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            total = np.add.reduceat(n[order].astype(np.int64), first)
            first, total = first[total >= LEAST], total[total >= LEAST]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(first), part), pa.int32()), pa.array(keys[first].astype(np.int64)),
                                              pa.array(total), pa.array(source[order[first]])], schema=schema)

    return rows.repartition(max(1, parts // 4), "part").mapInArrow(run, "part int, key bigint, n bigint, source bigint")


def shares(words: int) -> int:
    """Into how many shares hashed phrases are dealt: a power of two, for about a million words a share."""
    return 1 << max(4, (words >> 20).bit_length())


def folded(keys: np.ndarray, parts: int) -> np.ndarray:
    """The first bits of the keys: the share's number, then 32 more. So wide
    are the keys that are summed; they widen with the corpus."""
    return keys >> np.uint64(64 - 32 - (parts.bit_length() - 1))


def owned(keys: np.ndarray, source) -> np.ndarray:
    """Hash of keys in a source."""
    return spread(keys * MIX[2] + np.asarray(source, dtype=np.uint64))


def bounded(symbols: DataFrame, parts: int, pairs_bits=None) -> DataFrame:
    """(key, own): folded pairs, or with the pairs' bitmap triples, whose places
    add up to ``LEAST`` or more; ``own`` hashes the key with one of its sources."""
    def rows(held, source):
        keys, n = np.unique(folded(np.concatenate(held), parts), return_counts=True)
        # a sum that reaches LEAST needs no more than LEAST from any task
        return packed((keys >> np.uint64(32)).astype(np.int32), source, keys.astype(np.uint32), np.minimum(n, LEAST).astype(np.uint8))

    def run(batches):
        held, size = {}, 0
        for lang, source, h, n in arrays(batches):
            _, first, triples = phrase_keys(lang, h, n, parts, pairs_bits and pairs_bits.value)
            keys = first if triples is None else triples[triples != 0]
            held.setdefault(source, []).append(keys)
            size += len(keys)
            if size > KEYS:
                for x, y in held.items():
                    yield from rows(y, x)
                held, size = {}, 0
        for x, y in held.items():
            yield from rows(y, x)

    def own(batches):
        for b in batches:
            part, key, source = (b.column(i).to_numpy() for i in (0, 1, 3))
            key = (part.astype(np.uint64) << np.uint64(32)) | key.astype(np.uint64)
            mine = owned(key, source.astype(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(mine.view(np.int64))], names=["key", "own"])

    return stored(summed(symbols.mapInArrow(run, PACKED), parts, np.uint32, np.uint8).mapInArrow(own, "key bigint, own bigint"))


def candidates(symbols: DataFrame, parts: int, pairs_bits, pairs_own, triples_bits, triples_own) -> DataFrame:
    """(lang, a, b, c): the distinct phrases whose folded sums reach ``LEAST``;
    c is 0 in pairs. Each source emits those that it owns."""
    schema = pa.schema([("lang", pa.string()), *((x, pa.int64()) for x in "abc")])

    def rows(lang, held):
        f = pd.concat(held).drop_duplicates()
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(f), pa.string()), *(pa.array(f[x].to_numpy()) for x in "abc")], schema=schema)

    def run(batches):
        held: dict[str, list] = {}
        for lang, source, h, n in arrays(batches):
            at, first, triples = phrase_keys(lang, h, n, parts, pairs_bits.value)
            two = known(pairs_own.value, owned(folded(first, parts), source))
            own = folded(triples, parts)
            three = (triples != 0) & known(triples_bits.value, own) & known(triples_own.value, owned(own, source))
            frame = lambda at, c: pd.DataFrame({"a": h[at].view(np.int64), "b": h[at + 1].view(np.int64), "c": c})
            held.setdefault(lang, []).append(pd.concat([
                frame(at[two], 0), frame(at[three], h[at[three] + 2].view(np.int64))]).drop_duplicates())
            if sum(map(len, held[lang])) > KEYS // 4:
                yield from rows(lang, held.pop(lang))
        for lang, x in held.items():
            yield from rows(lang, x)

    return symbols.mapInArrow(run, "lang string, a bigint, b bigint, c bigint").distinct()


# ------------------------------------------------------------------ tries
def place(starts: np.ndarray, sizes: np.ndarray, digits: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Offsets for nodes whose children ``digits[start:start + size]`` must
    fall on free cells: largest first, then single children on what is left.
    Returns the offsets and the cells in use."""
    used = np.zeros(size + 1024, dtype=bool)
    used[0] = True
    offsets = np.zeros(len(starts), dtype=np.int64)
    window, hint = np.arange(256), {}
    for i in np.argsort(-sizes, kind="stable"):
        n = int(sizes[i])
        if n < 2:
            break
        own = digits[starts[i]:starts[i] + n].astype(np.int64)
        at = hint.get(n, 0)
        while True:
            if at + 1024 > len(used):
                used = np.concatenate([used, np.zeros(len(used), dtype=bool)])
            free = np.flatnonzero(~used[at + own[:, None] + window].any(0))
            if len(free):
                break
            at += 256
        offsets[i] = hint[n] = at = at + int(free[0])
        used[at + own] = True
    single = np.flatnonzero(sizes == 1)
    if len(used) < used.sum() + len(single) + 1024:
        used = np.concatenate([used, np.zeros(len(single) + 1024, dtype=bool)])
    cells = np.flatnonzero(~used[256:])[:len(single)] + 256
    used[cells] = True
    offsets[single] = cells - digits[starts[single]]
    return offsets, used


def build(phrases: pd.DataFrame) -> dict:
    """The double-array trie of phrases (lang, a, b, c, tag)."""
    langs = sorted(phrases.lang.unique())
    sym = phrases[["a", "b", "c"]].to_numpy().view(np.uint64)
    vocab = np.unique(sym[sym != 0])
    ids = np.column_stack([np.searchsorted(np.array(langs, dtype=object), phrases.lang.to_numpy()), *(np.searchsorted(vocab, sym[:, k]) for k in range(3))])
    three = sym[:, 2] != 0
    ids[~three, 2 + 1] = 0
    order = np.lexsort((ids[:, 3], three, ids[:, 2], ids[:, 1], ids[:, 0]))
    ids, three, tags = ids[order], three[order], phrases.tag.to_numpy()[order]
    node = np.zeros(len(ids), dtype=np.int64)
    parents, digits, total = [], [], 1
    for word in range(4):
        if word == 3:
            pairs_end, ids, rest = node[~three], ids[three], three
            node = node[three]
        for shift in (16, 8, 0):
            d = (ids[:, word] >> shift) & 255
            new = np.ones(len(ids), dtype=bool)
            new[1:] = (node[1:] != node[:-1]) | (d[1:] != d[:-1])
            parents.append(node[new])
            digits.append(d[new])
            node = total + np.cumsum(new) - 1
            total += int(new.sum())
    parent, digit = np.concatenate(parents), np.concatenate(digits)         # of nodes 1, 2, ...
    sizes = np.bincount(parent, minlength=total)
    starts = np.searchsorted(parent, np.arange(total))
    offsets, used = place(starts, sizes, digit, 2 * total)
    cell = np.zeros(total, dtype=np.int64)
    cell[1:] = offsets[parent] + digit
    length = int(np.flatnonzero(used)[-1]) + 1 + 256
    base, check, accept = np.zeros(length, np.int32), np.full(length, -1, np.int32), np.full(length, -1, np.int32)
    base[cell] = np.where(sizes > 0, offsets, 0)
    check[cell[1:]] = cell[parent]
    accept[cell[pairs_end]] = np.flatnonzero(~rest)
    accept[cell[node]] = np.flatnonzero(rest)
    return {"langs": langs, "vocab": vocab, "base": base, "check": check, "accept": accept, "tags": tags}


NUMBERS = {"vocab": np.uint64, "base": np.int32, "check": np.int32, "accept": np.int32, "tags": np.int64}


def tries(found: DataFrame, number: int) -> DataFrame:
    """(trie, langs, and the arrays as bytes), a row for each of ``number`` tries; a phrase's trie follows from its hash."""
    dealt = found.withColumn("trie", F.pmod(F.xxhash64("lang", "a", "b", "c"), F.lit(number)).cast("int"))

    def run(key: tuple, phrases: pd.DataFrame) -> pd.DataFrame:
        made = build(phrases)
        return pd.DataFrame([{"trie": key[0], "langs": made["langs"], **{k: made[k].tobytes() for k in NUMBERS}}])

    return dealt.groupBy("trie").applyInPandas(run, "trie int, langs array<string>, " + ", ".join(f"{k} binary" for k in NUMBERS))


def look_up(trie: dict, h: np.ndarray) -> np.ndarray:
    """The symbols' numbers in the trie, -1 for others: by a table that their
    low bits index; where two of the trie's symbols meet there, by search."""
    vocab = trie["vocab"]
    if "table" not in trie:
        size = 1 << (8 * len(vocab)).bit_length()
        at = (vocab & np.uint64(size - 1)).astype(np.int64)
        table = np.full(size, -1, dtype=np.int32)
        table[at] = np.arange(len(vocab), dtype=np.int32)
        table[at[table[at] != np.arange(len(vocab))]] = -2
        trie["table"] = table
    table = trie["table"]
    ids = table[(h & np.uint64(len(table) - 1)).astype(np.int64)]
    meet = np.flatnonzero(ids == -2)
    ids[meet] = np.minimum(np.searchsorted(vocab, h[meet]), len(vocab) - 1)
    ids[(ids >= 0) & (vocab[np.maximum(ids, 0)] != h)] = -1
    return ids


def advance(trie: dict, lang: str, h: np.ndarray, n: int) -> np.ndarray:
    """The states that the first ``n`` places of ``h`` reach after two and
    three words: all places go on together, a digit a step."""
    base, check, vocab = trie["base"], trie["check"], trie["vocab"]
    if lang not in trie["langs"]:
        return np.zeros(0, dtype=np.int64)
    ids = look_up(trie, h)
    number, state = trie["langs"].index(lang), 0
    for shift in (16, 8, 0):
        state = int(base[state]) + (number >> shift & 255)
    at = np.flatnonzero(ids[:n] >= 0)
    state = np.full(len(at), state, dtype=np.int64)
    reached = []
    for word in range(3):
        own = ids[at + word]
        ok = own >= 0
        at, state, own = at[ok], state[ok], own[ok]
        for shift in (16, 8, 0):
            nxt = base[state] + (own >> shift & 255)
            ok = check[nxt] == state
            at, state, own = at[ok], nxt[ok], own[ok]
        if word:
            reached.append(state)
    return np.concatenate(reached)


def trie_counts(symbols: DataFrame, found: DataFrame, number: int) -> DataFrame:
    """(tag, n) of the candidates ``found``, by ``number`` tries."""
    spark = symbols.sparkSession
    made = stored(tries(found, number))
    passes = []
    for first in range(0, number, TRIES_AT_ONCE):
        part = [{"langs": list(r.langs), **{k: np.frombuffer(r[k], t) for k, t in NUMBERS.items()}}
                for r in made.where(F.col("trie").between(first, first + TRIES_AT_ONCE - 1)).collect()]
        shared = spark.sparkContext.broadcast(part)

        def run(batches, shared=shared):
            counts = [np.zeros(len(t["base"]), dtype=np.int64) for t in shared.value]
            for lang, source, h, n in arrays(batches):
                for t, c in zip(shared.value, counts, strict=True):
                    c += np.bincount(advance(t, lang, h, n), minlength=len(c))
            for i, (t, c) in enumerate(zip(shared.value, counts, strict=True)):
                hit = np.flatnonzero((c > 0) & (t["accept"] >= 0))
                phrase = np.sort(t["accept"][hit])
                per = np.zeros(len(t["tags"]), dtype=np.int64)
                per[t["accept"][hit]] = c[hit]
                yield from packed(((i << 20) + phrase // TRIE_PART).astype(np.int32), 0, t["tags"][phrase], per[phrase])

        shares_ = len(part) * (1 + TRIE_PHRASES // TRIE_PART)
        passes.append(stored(summed(symbols.mapInArrow(run, PACKED), shares_, np.int64, np.int64).select(F.col("key").alias("tag"), "n")))
    out = passes[0]
    for p in passes[1:]:
        out = out.union(p)
    return out


def shuffled_counts(symbols: DataFrame, parts: int, pairs_bits, triples_bits) -> DataFrame:
    """(lang, a, b, c, n): the same counts without tries, every place's phrases summed by shuffle."""
    schema = pa.schema([("lang", pa.string()), *((x, pa.int64()) for x in "abcn")])

    def run(batches):
        for lang, source, h, n in arrays(batches):
            at, _, triples = phrase_keys(lang, h, n, parts, pairs_bits.value)
            three = at[(triples != 0) & known(triples_bits.value, folded(triples, parts))]
            f = pd.DataFrame({"a": h[np.concatenate([at, three])], "b": h[np.concatenate([at, three]) + 1],
                              "c": np.concatenate([np.zeros(len(at), np.uint64), h[three + 2]])})
            f = f.groupby(["a", "b", "c"], sort=False).size().reset_index(name="n")
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(f), pa.string()), *(pa.array(f[x].to_numpy().view(np.int64)) for x in "abcn")],
                                             schema=schema)

    found = symbols.mapInArrow(run, "lang string, a bigint, b bigint, c bigint, n bigint")
    return found.groupBy("lang", "a", "b", "c").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST)


def frequent_phrases(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(lang, word, n) of all words, (lang, h, word, n) of the frequent ones and
    (lang, a, b, c, n) of the frequent phrases by their words' symbols."""
    spark = docs.sparkSession
    bound_batches(spark)
    docs = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), full_text().alias("text"))
    counts, salt = counted_words(docs)
    common = counts.where(F.col("n") >= LEAST)
    share = spark.sparkContext.broadcast
    symbols = stored(symbol_arrays(docs, share(bitmap(common, "h")), salt))
    parts = shares(counts.agg(F.sum("n")).first()[0] or 0)
    pairs = bounded(symbols, parts)
    pairs_bits = share(bitmap(pairs, "key"))
    triples = bounded(symbols, parts, pairs_bits)
    triples_bits = share(bitmap(triples, "key"))
    found = stored(candidates(symbols, parts, pairs_bits, share(bitmap(pairs, "own")), triples_bits, share(bitmap(triples, "own")))
                   .withColumn("tag", F.monotonically_increasing_id()))
    number = -(-found.count() // TRIE_PHRASES)
    if not number:
        phrases = found.withColumn("n", F.lit(0).cast("bigint")).drop("tag")
    elif number > TRIES_AT_ONCE * MOST_PASSES:
        phrases = shuffled_counts(symbols, parts, pairs_bits, triples_bits)
    else:
        phrases = found.join(trie_counts(symbols, found, number), "tag").drop("tag")
    return counts, common, stored(phrases)


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(SCALE * a * a / (left * right)), exactly."""
    wide = lambda c: c.cast("decimal(19,0)")
    top, bottom = (F.lit(SCALE).cast("decimal(7,0)") * wide(a) * wide(a)), wide(left) * wide(right)
    return F.call_function("div", top, bottom)


def collocations(docs: DataFrame, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases."""
    counts, common, phrases = frequent_phrases(docs)
    one = lambda x: common.select("lang", F.col("h").alias(x), F.col("word").alias(f"word_{x}"), F.col("n").alias(f"n_{x}"))
    two = stored(phrases.where("c = 0").select("lang", "a", "b", F.col("n").alias("f"))
                 .join(one("a"), ["lang", "a"]).join(one("b"), ["lang", "b"]))
    head = two.select("lang", "a", "b", "word_a", F.col("word_b"), "n_a", F.col("f").alias("f_ab"))
    tail = two.select("lang", F.col("a").alias("b"), F.col("b").alias("c"), F.col("word_b").alias("word_c"),
                      F.col("n_b").alias("n_c"), F.col("f").alias("f_bc"))
    three = stored(phrases.where("c <> 0").select("lang", "a", "b", "c", F.col("n").alias("f"))
                   .join(head, ["lang", "a", "b"]).join(tail, ["lang", "b", "c"])
                   .withColumns({"early": score(F.col("f"), F.col("n_a"), F.col("f_bc")),
                                 "late": score(F.col("f"), F.col("f_ab"), F.col("n_c"))}))
    inside = (three.select("lang", "a", "b", "f").union(three.select("lang", F.col("b").alias("a"), F.col("c").alias("b"), "f"))
              .groupBy("lang", "a", "b").agg(F.max("f").alias("longer")))
    kept = two.join(inside, ["lang", "a", "b"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < CONTAINED_PERCENT * F.col("f")))
    first = F.col("early") <= F.col("late")
    scored = kept.select("lang", F.concat_ws(" ", "word_a", "word_b").alias("phrase"), F.col("f").alias("a"), F.col("n_a").alias("l"),
                         F.col("n_b").alias("r"), score(F.col("f"), F.col("n_a"), F.col("n_b")).alias("score"))
    scored = scored.union(three.select(
        "lang", F.concat_ws(" ", "word_a", "word_b", "word_c"), "f", F.when(first, F.col("n_a")).otherwise(F.col("f_ab")),
        F.when(first, F.col("f_bc")).otherwise(F.col("n_c")), F.least("early", "late")))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the best of each share of a language first, then the best of those
    shares = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    best = scored.withColumn("rank", F.row_number().over(shares)).where(F.col("rank") <= top).drop("rank")
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    size = counts.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(size, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n",
                                            F.col("score").cast("long").alias("score"))
