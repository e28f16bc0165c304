"""Queries with SQL equal it: over the small tables, over a table of awkward rows, and over empty tables."""

import math
import os

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tarmac.llm.queries import ORACLE, QUERIES
from tests.conftest import SF_SMALL

TABLES = ["documents", "embeddings", "benchmark", "labels", "conversations"]
LONG = " ".join(f"w{i * i % 9973}" for i in range(30_000))
PASSAGE = "Alpha beta, gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega"
DOCUMENTS = [
    (0, None, "a"), (1, "", None), (2, " \t\r\n\x0b\x0c ", "b"), (None, PASSAGE + " null id", "a"), (None, PASSAGE + " null id", "a"),
    (3, "one two three", "a"), (4, "ONE two Three", "a"), (4, "ONE two Three", "a"), (4, "another text of the same id", "c"),
    (5, "x y " * 300, "c"), (6, "x y " * 301, "c"), (7, LONG, "d"), (8, LONG.replace("w4 ", "v4 "), "d"), (9, "Before. " + PASSAGE.upper() + " after", "a"),
    (10, PASSAGE, "b"), (11, PASSAGE, "b"), (12, "Kİ ÉtÉ  nbsp stays " + PASSAGE, None), (13, PASSAGE.replace("mu", "MU") + " " + PASSAGE, "a"),
    (-5, "negative " + PASSAGE, "b"), (14, "short item", "a"), (15, "a short item, and short item.", "a"), (2**40, "word", "z"),
]
BENCHMARK = [(1, PASSAGE), (2, "Short item"), (2, PASSAGE + " again"), (None, "epsilon zeta"), (3, None), (4, "..."), (10, "no such words at all anywhere in these documents, none of them, not one")]
VECTORS = [(0, [1.0, 0.0, 0.0]), (1, [2.0, 0.0, 0.0]), (2, [1.0, 0.1, 0.0]), (3, None), (4, [0.0, 0.0, 0.0]), (5, [1.0, None, 0.0]), (6, [float("nan"), 1.0, 0.0]),
           (7, [float("inf"), 1.0, 0.0]), (8, []), (9, [0.0, 1.0, 0.0]), (10, [0.0, 1.0, 0.2]), (11, [0.0, 1.0, 0.6]), (12, [1.0, 0.0, 0.0]), (13, [-1.0, 0.0, 0.0])]
CHATS = [(1, 0, "user", "hi"), (1, 1, "assistant", "hello <|im_end|> \\ \\\\ <s>"), (1, 1, "assistant", "tie"), (1, 1, "assistant", "tie"), (1, 2, None, None),
         (2, None, "assistant", ""), (2, 0, "ro\nle<|", "<<SYS>> [INST] [/INST] <</SYS>>\n<\\s> \\"), (3, 0, "assistant", "é" * 1000 + "\U0001f600"), (None, 0, "user", "no id")]


def write(folder, name, rows, schema, extra=None):
    t = pa.Table.from_pylist([dict(zip(schema.names, r)) for r in rows], schema=schema)
    for k in extra or []:
        t = t.append_column(k, pa.array([7] * len(rows), pa.int64()))
    pq.write_table(t, f"{folder}/{name}.parquet")


def tables(folder, empty=False):
    cut = (lambda x: []) if empty else (lambda x: x)
    write(folder, "documents", cut([(i, t, "en" if t else None, s, len(t or "")) for i, t, s in DOCUMENTS]), pa.schema(
        [("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())]),
        ["size", "score", "position", "target", "key", "component_id", "n_words", "held_out", "_row", "Taken"])
    write(folder, "benchmark", cut(BENCHMARK), pa.schema([("item_id", pa.int64()), ("text", pa.string())]), ["win", "fp"])
    write(folder, "embeddings", cut([(i, v, 0) for i, v in VECTORS]), pa.schema([("vec_id", pa.int64()), ("embedding", pa.list_(pa.float32())), ("label", pa.int32())]), ["cid", "x"])
    write(folder, "labels", cut([(i, 1, int(i is not None and i % 3 == 0)) for i, _, _ in DOCUMENTS] + [(5, None, None)]),
          pa.schema([("doc_id", pa.int64()), ("quality", pa.int32()), ("toxic", pa.int32())]))
    write(folder, "conversations", cut(CHATS), pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())]), ["seq", "msg", "piece"])
    return folder


def same(spark, name, folder):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{folder}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    norm = lambda v: None if v is None else float(f"{v:.9g}") if isinstance(v, float) and not math.isnan(v) else v
    key = lambda row: [(x is None, str(x)) for x in row]
    df = QUERIES[name](spark, folder)
    got = sorted((tuple(norm(r[c]) for c in sorted(df.columns)) for r in df.collect()), key=key)
    res = con.execute(ORACLE[name])
    order = sorted(range(len(res.description)), key=lambda i: res.description[i][0])
    assert [res.description[i][0] for i in order] == sorted(df.columns)
    want = sorted((tuple(norm(r[i]) for i in order) for r in res.fetchall()), key=key)
    assert got == want
    return got


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_small_tables(spark, name):
    assert same(spark, name, SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_awkward_rows(spark, name, scratch):
    assert same(spark, name, tables(scratch))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_empty_tables(spark, name, scratch):
    assert len(same(spark, name, tables(scratch, empty=True))) == (name == "op7_chat_events")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_awkward_and_empty_tables_without_sql(spark, name, scratch):
    rows = QUERIES[name](spark, tables(scratch)).collect()
    assert sorted((r.doc_id for r in rows), key=str) == sorted((i for i, _, _ in DOCUMENTS), key=str)
    if "score" in rows[0]:
        assert all(r.score is not None and not math.isnan(r.score) for r in rows)
    assert QUERIES[name](spark, tables(scratch, empty=True)).collect() == []
