"""Small frames that every operator has to survive."""

import pathlib

import duckdb

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, n int, seg string, spans string"


def odd_docs(spark, texts=()):
    """Nulls, empty, blank, repeated, very long and non-ASCII texts, with
    extra columns whose names operators use themselves."""
    rows = [(1, None), (2, ""), (3, "  \n\t "), (4, "one two three four five six seven"), (4, "one two three four five six seven"),
            (5, "ÉÀ ß 漢字 \U0001f600 é"), (6, "word " * 40_000), (7, "x" * 150_000), (None, "null id text here now"), (None, None),
            *[(100 + i, t) for i, t in enumerate(texts)]]
    return spark.createDataFrame([(i, t, None, None, None if t is None else len(t), 0.5, 1, "s", "p") for i, t in rows], SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def texts(name="documents", columns="doc_id, text"):
    p = pathlib.Path(SF, f"{name}.parquet")
    return duckdb.sql(f"select {columns} from '{p}'").fetchall()


def rows(df):
    return [tuple(r) for r in df.collect()]
