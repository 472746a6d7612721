"""Operator 4, license scans by conditional compression.

Lines of a document with a license word (and the lines between two of them
that are close) are candidate blocks. Each block is compressed alone and with
every template as a raw zstandard dictionary; how much smaller it gets is the
template's gain. Every template whose distinctive words (names and versions)
are in the block or as many words around it as the longest template has, is
confirmed by its wording, whatever its gain: its words are aligned with the
block's, first where they stand verbatim, then around each place of its rarest
distinctive word, and an alignment counts if it has enough of them and all of
the distinctive ones. Words left out, put in and replaced between the first
and the last aligned word are reported.

Cases: null or empty text has no findings; positions are code points, end
exclusive; findings of one license in a document don't overlap (that with most
of its template's words stays); repeated rows are each scanned; a null doc_id is
kept; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import difflib
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_id, bound_batches, full_text, pairs, rows_to_batch

# Wordings of public licenses and notices, and the words that tell them apart.
TEMPLATES = (
    ("MIT", "Released under the MIT License.", "mit"),
    ("MIT", "Licensed under the MIT License.", "mit"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction, including without limitation the rights to "
            "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software", "deal sublicense"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0.", "apache 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at", "apache 2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3.", "gnu general 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License", "gnu general 3"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2.", "gnu general 2"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation; either version 2 of the License", "gnu general 2"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3.", "gnu lesser 3"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3.", "gnu affero 3"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mozilla 2.0"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License.", "bsd 3-clause"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License.", "bsd 2-clause"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met", "redistribution binary"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted", "fee hereby"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0.", "by 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0.", "by-sa 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0.", "by-nc 4.0"),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0.", "by-nd 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "attribution 4.0"),
    ("CC0-1.0", "This work has been dedicated to the public domain under CC0 1.0.", "cc0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain.", "unencumbered"),
    ("Proprietary", "All rights reserved.", "rights reserved"),
)
CUE = re.compile(r"licen[cs]|copyright|permission|redistribut|warrant|all\s+rights|public\s+domain|spdx|"
                 r"free\s+software|creative\s+commons|\bcc0\b|\bcc\s+by", re.I)
WORD = re.compile(r"\w+(?:[.-]\w+)*")
BETWEEN = 2                # lines without a license word inside a block
LEAST_WORDS = 0.8
REMEMBERED = 20_000


def blocks(text: str) -> list[tuple[int, int]]:
    """(start, end) of the candidate blocks."""
    out: list[tuple[int, int]] = []
    at = 0
    while m := CUE.search(text, at):
        s = text.rfind("\n", 0, m.start()) + 1
        e = text.find("\n", m.end())
        e = len(text) if e < 0 else e
        if out and text.count("\n", out[-1][1], s) <= BETWEEN + 1:
            out[-1] = (out[-1][0], e)
        else:
            out.append((s, e))
        at = e
    return out


class Templates:
    """Compressors with each template as dictionary."""

    def __init__(self, templates=TEMPLATES):
        import zstandard as z

        plain = {"level": 19, "write_checksum": False, "write_content_size": False, "write_dict_id": False}
        self.alone = z.ZstdCompressor(**plain)
        self.rows = []
        for name, wording, distinct in templates:
            d = z.ZstdCompressionDict(wording.lower().encode(), dict_type=z.DICT_TYPE_RAWCONTENT)
            self.rows.append((name, [m.group() for m in WORD.finditer(wording.lower())], set(distinct.split()),
                              z.ZstdCompressor(dict_data=d, **plain)))
        self.longest = max(len(r[1]) for r in self.rows)
        self.known: dict[str, list] = {}

    def ranked(self, block: str) -> list[tuple[float, int]]:
        """(gain, template) by falling share of bytes saved."""
        if (out := self.known.get(block)) is not None:
            return out
        b = block.lower().encode("utf-8", "surrogatepass")
        base = len(self.alone.compress(b))
        if len(self.known) > REMEMBERED:
            self.known.clear()
        out = self.known[block] = sorted(((1 - len(r[3].compress(b)) / base, i) for i, r in enumerate(self.rows)), key=lambda x: (-x[0], x[1]))
        return out

    def findings(self, block: str, before: str = "", after: str = "") -> list[tuple]:
        """(start, end, license, gain, coverage, exact, differences) in a block
        and the text around it; positions count from the block's start."""
        whole = before + block + after
        low = whole.lower()
        low = low if len(low) == len(whole) else whole
        found = [(m.group(), m.start() - len(before), m.end() - len(before)) for m in WORD.finditer(low)]
        mine = [f[0] for f in found]
        places: dict[str, list[int]] = {}
        for i, w in enumerate(mine):
            places.setdefault(w, []).append(i)
        tried = {i for i, r in enumerate(self.rows) if r[2] <= places.keys()}
        out = []
        for gain, i in self.ranked(block) if tried else ():
            if i not in tried:
                continue
            name, words, distinct, _ = self.rows[i]
            for runs in alignments(mine, words, distinct, places):
                first, last = runs[0][0], runs[-1][0] + runs[-1][2]
                differ, x, y = [], first, 0
                for ax, by, n in [*runs, (last, len(words), 0)]:
                    gone, new = " ".join(words[y:by]), " ".join(mine[x:ax])
                    if gone or new:
                        differ.append(f"-{gone}" if not new else f"+{new}" if not gone else f"{gone}>{new}")
                    x, y = ax + n, by + n
                cover = sum(r[2] for r in runs) / len(words)
                out.append((found[first][1], found[last - 1][2], name, gain, cover, not differ, "; ".join(differ)))
        return apart(out)

    def document(self, text: str) -> list[tuple]:
        """Findings of all blocks of a text."""
        out = []
        for s, e in blocks(text):
            a, b = words_before(text, s, self.longest), words_after(text, e, self.longest)
            out += [(s + f[0], s + f[1], *f[2:]) for f in self.findings(text[s:e], text[a:s], text[e:b])]
        return apart(out)


def words_before(text: str, at: int, n: int) -> int:
    """Start of the ``n``-th word before ``at``."""
    reach = 16 * n
    while True:
        lo = max(0, at - reach)
        found = [m.start() for m in WORD.finditer(text, lo, at)]
        if lo == 0 or len(found) > n:                  # the first one may be cut
            return found[-n] if len(found) > n else 0
        reach *= 4


def words_after(text: str, at: int, n: int) -> int:
    """End of the ``n``-th word after ``at``."""
    for k, m in enumerate(WORD.finditer(text, at), 1):
        if k == n:
            return m.end()
    return len(text)


def apart(findings: list[tuple]) -> list[tuple]:
    """Findings by start, those of one license without overlap: the exact and
    fuller ones stay, then the longer ones."""
    kept: dict[str, list[tuple]] = {}
    for f in sorted(findings, key=lambda f: (-f[4], not f[5], f[0] - f[1], f[0], -f[3])):
        rows = kept.setdefault(f[2], [])
        if all(f[1] <= k[0] or k[1] <= f[0] for k in rows):
            rows.append(f)
    return sorted(f for rows in kept.values() for f in rows)


def alignments(mine: list[str], words: list[str], distinct: set[str], places: dict[str, list[int]]) -> list[list[tuple]]:
    """Alignments of ``words`` in ``mine`` that don't overlap, each as its
    runs (place in mine, place in words, length)."""
    n, out, free, at = len(words), [], [], 0
    rarest = min(distinct, key=lambda w: (len(places[w]), w))
    offset = words.index(rarest)
    for p in places[rarest]:
        s = p - offset
        if s >= at and mine[s:s + n] == words:
            out.append([(s, 0, n)])
            free.append((at, s))
            at = s + n
    free.append((at, len(mine)))
    for lo, hi in free:
        for p in places[rarest]:
            if not lo <= p < hi:
                continue
            for left, right in ((2 * n, 2 * n), (offset + n // 2, n - offset + n // 2)):   # the narrow one can't scatter
                a, b = max(lo, p - left), min(hi, p + right)
                runs = [(a + r.a, r.b, r.size) for r in
                        difflib.SequenceMatcher(None, mine[a:b], words, autojunk=False).get_matching_blocks() if r.size]
                first, last = (runs[0][0], runs[-1][0] + runs[-1][2]) if runs else (0, 0)
                if (sum(r[2] for r in runs) >= LEAST_WORDS * n and last - first <= 2 * n
                        and distinct <= set(mine[first:last])):
                    out.append(runs)
                    lo = last
                    break
    return out


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, start, end, license, gain, coverage, exact, differences): one
    row per wording found."""
    bound_batches(docs.sparkSession)
    kind, atype = arrow_id(docs, "doc_id")
    fields = pa.schema([("doc_id", atype), ("start", pa.int64()), ("end", pa.int64()), ("license", pa.string()),
                        ("gain", pa.float64()), ("coverage", pa.float64()), ("exact", pa.bool_()), ("differences", pa.string())])

    def run(batches):
        templates = Templates()
        for ids, texts in pairs(batches):
            yield rows_to_batch([(d, *f) for d, t in zip(ids, texts, strict=True) for f in templates.document(t)], fields)

    return docs.select("doc_id", full_text().alias("text")).mapInArrow(
        run, f"doc_id {kind}, start bigint, end bigint, license string, gain double, coverage double, exact boolean, "
             "differences string")
