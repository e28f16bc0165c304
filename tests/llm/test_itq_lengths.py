"""Operator 1: vectors of several lengths, and how many pairs are compared."""

import duckdb
import numpy as np

from tarmac.llm import common, itq_dedup
from tests.conftest import SF_SMALL


def plain(vectors):
    out = {}
    for i, v in vectors:
        out[i] = {j for j, w in vectors if j != i and len(w) == len(v) and np.dot(v, w) / np.linalg.norm(v) / np.linalg.norm(w) >= 0.9}
    return out


def test_lengths_are_linked_apart(spark):
    common.shipped(spark)
    rng = np.random.default_rng(4)
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.05]), (2, [1.0, 0.0, 0.0]), (3, [1.0, 0.1, 0.0]), (4, [2.0])]
    for d, n in ((24, 150), (64, 120), (8, 20)):
        base = rng.normal(size=(n, d))
        rows += [(len(rows) + i, [float(x) for x in (v if i % 2 else base[i // 3] + 0.15 * v)]) for i, v in enumerate(base)]
    want = plain(rows)
    got = {r.vec_id: r for r in itq_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    missed = [i for i in want if got[i].n_links != len(want[i])]
    assert not missed and sum(map(len, want.values())) > 40
    assert got[1].component_id == 0 and got[3].component_id == 2 and got[4].n_links == 0


def test_few_pairs_are_compared_among_unrelated_vectors(spark):
    """40,000 vectors spread as those of the table: groups stay small, and no pair at 0.9 is missed."""
    common.shipped(spark)
    v = np.array(duckdb.sql(f"SELECT embedding FROM read_parquet('{SF_SMALL}/embeddings.parquet') WHERE embedding IS NOT NULL").fetchnumpy()["embedding"].tolist(), float)
    rng = np.random.default_rng(1)
    x = rng.multivariate_normal(v.mean(0), np.cov(v.T), 39_000)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.normal(size=(1_000, x.shape[1]))
    z -= (z * x[:1000]).sum(1, keepdims=True) * x[:1000]
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    t = rng.uniform(0.901, 0.92, (1_000, 1))
    x = np.concatenate([x, t * x[:1000] + np.sqrt(1 - t * t) * z])
    classes = common.written(spark.createDataFrame([(i * 2_654_435_761 % 2**40, r) for i, r in enumerate(x.tolist())], "cid long, x array<double>").repartition(8), "vectors")
    groups = {}
    for r in itq_dedup.candidate_groups(classes).collect():
        groups.setdefault(r.cluster, set()).add(r.cid)
    compared = sum(len(g) ** 2 for g in groups.values())
    cluster = {c: k for k, g in groups.items() for c in g}
    number = [i * 2_654_435_761 % 2**40 for i in range(len(x))]
    found = sum(number[i] in cluster and cluster[number[i]] == cluster.get(number[39_000 + i]) for i in range(1_000))
    assert compared < 40_000 and max(map(len, groups.values())) < 100
    assert found >= 990
