import random
import zlib

from fleetlens.llm import queries
from fleetlens.llm import toxicity as T

from .helpers import SF, empty_docs, odd_docs, rows, texts


def corpus(spark, n=600):
    r = random.Random(1)
    word = lambda: "".join(r.choice(["ba", "lo", "mi", "tu", "re", "sa"]) for _ in range(r.randint(1, 4)))
    docs, labels = [], []
    for i in range(n):
        ws = [word() for _ in range(r.randint(5, 120))]
        bad = i % 4 == 0
        for _ in range(r.randint(2, 6) if bad else 0):
            ws.insert(r.randint(0, len(ws)), "krud" + word())
        docs.append((i, " ".join(ws)))
        labels.append((i, int(bad)))
    return spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int"), dict(labels)


def test_held_out_accuracy_on_inflected_words(spark):
    docs, labels, truth = corpus(spark)
    got = [r for r in T.score(docs, labels).collect() if r.held_out]
    assert len(got) > 80
    assert sum(r.predicted == truth[r.doc_id] for r in got) / len(got) > 0.97
    kept = {r.doc_id for r in T.keep_ordinary(docs, labels).collect()}
    assert kept == {r.doc_id for r in T.score(docs, labels).collect() if not r.predicted}


def test_decision_does_not_move_with_the_cap(spark):
    """Texts that tell nothing: scores are near the share of toxic labels, also where both classes are sampled."""
    r = random.Random(4)
    docs = [(i, " ".join(r.choice(["balo", "mitu", "resa", "lomi", "tuba"]) for _ in range(30))) for i in range(4000)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 8 == 0)) for i, _ in docs], "doc_id bigint, toxic int")
    got = T.score(df, labels, most=300).collect()
    assert 0.06 < sum(x.score for x in got) / len(got) < 0.2
    assert sum(x.predicted for x in got) < 0.02 * len(got)


def test_labels_held_out_are_not_read(spark):
    docs, labels, truth = corpus(spark, 300)
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in truth.items()]
    other = spark.createDataFrame(flipped, "doc_id bigint, toxic int")
    assert sorted(rows(T.score(docs, labels))) == sorted(rows(T.score(docs, other)))


def test_query_covers_all_rows(spark):
    got = queries.op5_toxicity(spark, SF).collect()
    assert len(got) == len(texts())
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
               and r.predicted == (r.score >= 0.5) for r in got)


def test_odd_rows(spark):
    labels = spark.createDataFrame([(4, 1), (4, 0), (5, None), (None, 1), (6, 0), (100, 0)], "doc_id bigint, toxic int")
    got = rows(T.score(odd_docs(spark, ["a b c"]), labels))
    assert len(got) == 11 and len({r[2] for r in got if r[0] in (1, 2, 3)}) == 1
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert all(r[3] == 0 for r in rows(T.score(odd_docs(spark), none)))
    assert rows(T.score(empty_docs(spark), labels)) == []
