"""Each stage of the pipeline against a brute-force version on its own input."""

import json
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tarmac.llm import common, curriculum, jaccard_join, mil_toxicity, winnowing
from tests.conftest import SF_SMALL
from tests.llm.test_queries import tables


def rows(df):
    return Counter(json.dumps(list(r), default=str) for r in df.collect())


def sql(text, docs, sf_dir):
    con = duckdb.connect()
    documents = docs.toArrow()
    con.register("documents", documents)
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM read_parquet('{sf_dir}/benchmark.parquet')")
    return con.execute(text).fetchall()


@pytest.fixture(params=["small", "awkward"])
def folder(request, scratch):
    return SF_SMALL if request.param == "small" else tables(scratch)


def test_stages(spark, folder):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "near_duplicates", "decontamination", "mixing", "token_output"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")

    kept = common.written(stages["toxicity"](spark, docs, folder), "t")
    model = mil_toxicity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    judge = model.scorer()
    assert kept.columns == docs.columns
    assert rows(kept) == Counter(json.dumps(list(r), default=str) for r in docs.collect() if judge(r.text)[0] < 0.3)

    one = common.written(stages["near_duplicates"](spark, kept, folder), "t")
    groups = {}
    for i, (doc_id, n, component) in enumerate(sql(jaccard_join.OP4_SQL, kept.select("doc_id", "text"), folder)):
        groups.setdefault(("none", i) if n == 0 else component, []).append(doc_id)
    assert one.columns == docs.columns and one.count() == len(groups)
    assert Counter(r.doc_id for r in one.collect()) == Counter(min(g, key=lambda x: (x is None, x)) for g in groups.values())
    assert not rows(one) - rows(kept)

    clean = common.written(stages["decontamination"](spark, one, folder), "t")
    bad = {r[0] for r in sql(winnowing.OP2_SQL.replace("SELECT doc_id, len(w)::BIGINT AS n_words", "SELECT doc_id || '|' || md5(array_to_string(w, ' ')) AS k, len(w)::BIGINT AS n_words")
                                 .replace("coalesce(items_sha256, sha256('')) AS items_sha256, ", ""), one, folder) if r[-1]}
    assert clean.columns == docs.columns and clean.count() == one.count() - len(bad) and not rows(clean) - rows(one)

    mix = common.written(stages["mixing"](spark, clean, folder), "t")
    taken = Counter()
    for doc_id, size, _, _, n in sql(curriculum.OP9_SQL, clean, folder):
        if n:
            taken[doc_id] += n // size
    assert mix.columns == docs.columns and Counter(r.doc_id for r in mix.collect()) == taken

    out = stages["token_output"](spark, mix, folder)
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lines = mix.select("doc_id", "text", F.col("_metadata.file_name").alias("f"), F.col("_metadata.row_index").alias("i")).orderBy("f", "i").collect()
    start, want = 0, []
    for r in lines:
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1]
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert [tuple(r) for r in out.orderBy("start").collect()] == want


def test_empty_tables(spark, scratch):
    assert corpus_pipeline.run(spark, tables(scratch, empty=True)).collect() == []
