import __spark_entry__ as entry
import corpus_pipeline as C
from fleetlens.llm import decontaminate, near_dup, toxicity
from fleetlens.llm.common import table

from .helpers import SF, empty_docs, odd_docs


def test_stages_take_effect_in_turn(spark):
    docs = table(spark, SF, "documents")
    assert [n for n, _ in C.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "packing"]
    labels, bench = table(spark, SF, "labels"), table(spark, SF, "benchmark")
    bad = {r.doc_id for r in toxicity.score(docs, labels).collect() if r.predicted}
    a = C.drop_toxic(spark, docs, SF).cache()
    assert a.columns == docs.columns and {r.doc_id for r in a.collect()} == {r.doc_id for r in docs.collect()} - bad
    b = C.drop_near_duplicates(spark, a, SF).cache()
    assert {r.doc_id for r in b.collect()} == {r.class_id for r in near_dup.classes(a).collect()}
    c = C.drop_contaminated(spark, b, SF).cache()
    assert {r.doc_id for r in c.collect()} == {r.doc_id for r in b.collect()} - {
        r.doc_id for r in decontaminate.matches(b, bench).collect()}
    d = C.redact_secrets(spark, c, SF).cache()
    assert d.columns == docs.columns and d.count() == c.count()
    assert {r.doc_id for r in C.pack(spark, d, SF).collect()} == {r.doc_id for r in d.collect()}
    for df in (a, b, c, d):
        df.unpersist()


def test_run_covers_the_documents(spark):
    got = C.run(spark, SF)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(got.columns) and got.count() > 0


def test_stages_survive_odd_and_empty_tables(spark):
    for docs in (odd_docs(spark, ["token = 'abcdefgh'"]), empty_docs(spark)):
        for _, stage in C.STAGES[:-1]:
            docs = stage(spark, docs, SF)
            assert docs.columns == empty_docs(spark).columns
            docs = docs.cache()
            docs.count()
        C.pack(spark, docs, SF).count()
    spark.catalog.clearCache()


def test_entry_registers_each_operator_once():
    names = entry.queries()
    for n in range(1, 14):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
    assert "pipeline" in names
