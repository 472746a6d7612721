from fleetlens.llm import license_scan as S
from fleetlens.llm import queries

from .helpers import SF, empty_docs, odd_docs, rows, texts

MIT = S.TEMPLATES[2][1]


def test_query_finds_every_wording(spark):
    got = {(r.doc_id, r.license, r.exact) for r in queries.op4_license_scan(spark, SF).collect()}
    for i, t in texts():
        for name, wording, _ in S.TEMPLATES:
            if wording in (t or ""):
                assert (i, name, True) in got
    assert all(e for _, _, e in got)


def test_exact_and_changed_wording(spark):
    changed = MIT.replace("software", "program").replace("without restriction", "freely")
    docs = odd_docs(spark, [f"before\n{MIT}\nafter", changed, "A license to print money, without warranty.",
                            "All rights reserved.\nfiller line\n\nReleased under the MIT License.", "Licensed under CC BY-SA 4.0."])
    got = {(r.doc_id, r.license): r for r in S.scan(docs).collect()}
    assert got[100, "MIT"].exact and (got[100, "MIT"].start, got[100, "MIT"].end) == (7, 7 + len(MIT))
    assert not got[101, "MIT"].exact and "software>program" in got[101, "MIT"].differences
    assert {k for k in got if k[0] > 101} == {(103, "Proprietary"), (103, "MIT"), (104, "CC-BY-SA-4.0")}


def test_every_wording_whatever_its_rank_or_block():
    t = S.Templates()
    maps = ("Licensed under the Apache License, Version 2.0. Maps drawn by the Ostrava regional office come from another source, "
            "and their owners say: All rights reserved. Ask the editors of the handbook first.")
    assert [(f[2], f[5]) for f in t.document(maps)] == [("Apache-2.0", True), ("Proprietary", True)]
    twice = "Licensed under CC BY 4.0. The photographs too: licensed under CC BY 4.0."
    assert [(f[2], f[5]) for f in t.document(twice)] == [("CC-BY-4.0", True)] * 2
    for _, wording, _ in S.TEMPLATES:                    # a word to a line, between other lines
        text = "one\ntwo\n" + wording.replace(" ", "\n\n") + "\nthree"
        assert any(f[5] and f[:2] == (8, len(text) - 6 - (wording[-1] in ".")) for f in t.document(text)), wording


def test_versions_are_told_apart():
    t = S.Templates()
    assert [f[2] for f in t.findings("This work is licensed under the GNU General Public License, version 2.")] == ["GPL-2.0"]
    assert [f[2] for f in t.findings("Licensed under CC BY 4.0.")] == ["CC-BY-4.0"]


def test_compression_ranks_the_right_template_first():
    t = S.Templates()
    for i, (_, wording, _) in enumerate(S.TEMPLATES):
        assert t.rows[t.ranked(wording)[0][1]][0] == S.TEMPLATES[i][0]


def test_odd_rows(spark):
    assert rows(S.scan(odd_docs(spark))) == []
    assert rows(S.scan(empty_docs(spark))) == []
