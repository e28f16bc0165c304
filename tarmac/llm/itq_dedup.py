"""Embedding near-duplicates: iterative quantisation, multi-index Hamming tables, exact reranking.

1. Equal vectors become one class. For each vector length, rotations are learnt by iterative quantisation
   (alternating the sign codes and the orthogonal Procrustes fit, from random starts) on the up to ``BITS`` principal
   axes of unit vectors less their mean, from a sample of at most ``SAMPLE`` classes chosen by hash (shared by the
   lengths, ``LEAST_SAMPLE`` each at least). The signs after all rotations, as many as give ``CODE_BITS``, are a
   vector's code. A length of at most ``SMALL`` classes needs no index: it is one group.
2. Codes are cut into substrings of ``SUBSTRING`` bits, one Hamming table each. A class is entered under its own
   substring and under all that differ in one bit, so classes with a substring at most two bits apart meet: all
   pairs up to 47 of 256 bits apart, and most beyond. Those that meet are compared by the Hamming distance of their
   whole codes; those within ``RADIUS`` are candidates. A bucket returns links that join its candidates into groups,
   not their pairs; groups over all tables are connected components.
3. Groups are reranked with the original vectors: all cosines inside a group, in double precision. Each
   vector's links at or above the threshold are counted there, and links that join components returned.

Whole codes keep false candidates rare (about 25 pairs among 12,000 unrelated vectors, against 5,700 with 128 bits
within 38), so they do not chain vectors into large groups.

A bucket or group of more than ``BLOCK`` classes is cut into blocks, and a task gets two of them.
The index holds every vector; recall is that of step 2 (a pair is missed if no table and no chain of
candidates brings it together) and is measured in the tests.

Defined results: a vector that is null, empty, zero or holds a null or a non-finite component links with nothing,
and vectors of different lengths do not link; repeated ids are vectors of their own; a null id is never the
smallest and never kept; an empty table gives no rows. Columns named like a result are replaced, others pass.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm import common as C

SAMPLE, CODE_BITS, ITERATIONS, BITS = 20_000, 256, 40, 64
SUBSTRING, RADIUS, BLOCK, LEAST_SAMPLE = 16, 68, 4_096, 256
SMALL = 32  # rows of a bucket that are compared together with other buckets' rows
CODES = [f"c{i}" for i in range(CODE_BITS // 64)]
NEW = ["n_links", "component_id", "kept"]


def unit(rows: list) -> np.ndarray:
    x = np.array(rows, float).reshape(len(rows), -1)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def learn(sample: np.ndarray, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projections): each projection is the principal axes turned by a learnt rotation."""
    mean = sample.mean(0)
    x = sample - mean
    _, _, axes = np.linalg.svd(x.T @ x)
    d = x.shape[1]
    bits = min(BITS, d)
    v, out = x @ axes[:bits].T, []
    for i in range(-(-CODE_BITS // bits)):
        r, _ = np.linalg.qr(np.random.default_rng([seed, i]).normal(size=(bits, bits)))
        for _ in range(ITERATIONS):
            a, _, b = np.linalg.svd(np.sign(v @ r).T @ v)
            r = (a @ b).T
        out.append(axes[:bits].T @ r)
    return mean, np.stack(out)


def encode(x: np.ndarray, mean: np.ndarray, projections: np.ndarray) -> np.ndarray:
    """Signs after each rotation, one code of ``CODE_BITS`` or a few more bits a vector."""
    return np.concatenate([(x - mean) @ p > 0 for p in projections], 1)


def packed(bits: np.ndarray) -> np.ndarray:
    """Up to 64 bits a row as one number."""
    return (bits * (np.uint64(1) << np.arange(bits.shape[1], dtype=np.uint64))).sum(1, dtype=np.uint64)


def grouped(m: int, near) -> np.ndarray:
    """For each of m items the smallest item of its group; ``near(frontier, rest)`` tells, for each of
    ``rest``, whether one of ``frontier`` is a neighbour. Each item is in the frontier once."""
    root, rest = np.arange(m), np.arange(m)
    while len(rest):
        frontier, rest, first = rest[:1], rest[1:], rest[0]
        while len(frontier) and len(rest):
            hit = np.zeros(len(rest), bool)
            for i in range(0, len(frontier), 256):
                todo = np.flatnonzero(~hit)
                if len(todo):
                    hit[todo] = near(frontier[i:i + 256], rest[todo])
            frontier, rest = rest[hit], rest[~hit]
            root[frontier] = first
    return root


def _blocked(df: DataFrame, key: str, block: int) -> DataFrame:
    """Rows of a key with more than ``block`` rows, dealt to all pairs (i, j) of its blocks; others to (0, 0).
    ``home`` is the row's own block."""
    hot = df.groupBy(key).count().where(F.col("count") > block).select(key, F.ceil(F.col("count") / block).cast("int").alias("blocks"))
    d = df.join(hot, key, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    d = d.withColumn("home", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    pair = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least("home", o).alias("i"), F.greatest("home", o).alias("j")))
    return d.select("*", F.inline(pair)).drop("blocks").repartition(key, "i", "j").sortWithinPartitions(key, "i", "j", "cid")


def _groups(batches, key: str, columns: list[str]):
    """(i, j, rows) of each (key, i, j) of a sorted stream; a group is at most two blocks."""
    group, rows = None, []
    for b in batches:
        for row in zip(*(b.column(c).to_pylist() for c in [key, "i", "j", *columns])):
            if row[:3] != group:
                if rows:
                    yield group[1], group[2], rows
                group, rows = row[:3], []
            rows.append(row[3:])
    if rows:
        yield group[1], group[2], rows


def _buckets(batches):
    """(keys, cid, codes) of a sorted stream of (bucket, i, j, cid, codes...), cut between buckets."""
    held = None
    for b in batches:
        rows = np.stack([np.array(b.column(c)).astype(np.int64) for c in ["bucket", "i", "j", "cid", *CODES]], 1)
        held = rows if held is None else np.concatenate([held, rows])
        if len(held):
            last = (held[:, :3] != held[-1, :3]).any(1)
            cut = np.flatnonzero(last)[-1] + 1 if last.any() else 0
            if cut:
                yield held[:cut, :3], held[:cut, 3], held[:cut, 4:].copy().view(np.uint64)
                held = held[cut:]
    if held is not None and len(held):
        yield held[:, :3], held[:, 3], held[:, 4:].copy().view(np.uint64)


def candidate_groups(classes: DataFrame, block: int = BLOCK) -> DataFrame:
    """(cid, cluster): groups of classes that the Hamming tables bring together; ``classes`` has cid, x."""
    spark = classes.sparkSession
    d = F.size("x")
    n = {r.d: r.n for r in classes.groupBy(d.alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()}  # a number a length
    large = {k: v for k, v in n.items() if v > SMALL}
    alone = classes.where(~d.isin(list(large))).select("cid", d.alias("d"))
    groups = alone.join(alone.groupBy("d").agg(F.min("cid").alias("cluster")), "d").select("cid", "cluster")
    if not large:
        return groups
    most = {k: max(LEAST_SAMPLE, SAMPLE * v // sum(large.values())) for k, v in large.items()}
    share = F.create_map(*[F.lit(x) for k, v in large.items() for x in (k, int((1 << 30) * min(1.0, 1.1 * most[k] / v + 1e-3)))])
    few = classes.where(F.pmod("cid", F.lit(1 << 30)) < share[d]).select(d.alias("d"), "cid", "x")
    few = few.withColumn("o", F.row_number().over(Window.partitionBy("d").orderBy("cid")))
    samples = {}
    for r in few.where(F.col("o") <= F.create_map(*[F.lit(x) for k, v in most.items() for x in (k, v)])[F.col("d")]).orderBy("d", "cid").collect():
        samples.setdefault(r.d, []).append(r.x)
    held = spark.sparkContext.broadcast({k: learn(unit(v)) for k, v in samples.items()})

    def tables(it):
        for b in it:
            length = np.asarray(b.column(1).value_lengths()) if b.num_rows else np.zeros(0, int)
            for k in np.unique(length).tolist():
                at = pa.array(np.flatnonzero(length == k))
                mean, projections = held.value[k]
                code = encode(unit(b.column(1).take(at).to_pylist()), mean, projections)
                width = min(SUBSTRING, projections.shape[2])
                keys = [packed(code[:, i:i + width]) for i in range(0, code.shape[1] - width + 1, width)]
                flips = np.uint64(1) << np.arange(width, dtype=np.uint64)
                keys = [(k << 32) + (t << width) + x.astype(np.int64) for t, y in enumerate(keys) for x in [y, *(y ^ f for f in flips)]]
                codes = [packed(code[:, i:i + 64]).view(np.int64) for i in range(0, CODE_BITS, 64)]
                again = lambda x: pa.array(np.tile(x, len(keys)))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), again(np.array(b.column(0).take(at))), *map(again, codes)], ["bucket", "cid", *CODES])

    def retrieve(it):
        for key, cid, code in _buckets(it):
            start = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(1)])
            size = np.diff(np.r_[start, len(key)])
            group = np.repeat(np.arange(len(start)), size)
            hit = (size > SMALL)[group]  # rows that may link: all of a large bucket, those with a candidate of a small one
            for o in range(1, min(SMALL, size.max())):
                a = np.flatnonzero((group[o:] == group[:-o]) & (size <= SMALL)[group[o:]])
                a = a[np.bitwise_count(code[a] ^ code[a + o]).sum(1, dtype=np.int16) <= RADIUS]
                hit[a] = hit[a + o] = True
            at = np.flatnonzero(hit)
            src, dst = [], []
            for rows in np.split(at, np.flatnonzero(np.diff(group[at])) + 1):
                if len(rows) == 2 and size[group[rows[0]]] <= SMALL:
                    root = np.zeros(2, int)
                elif len(rows):
                    c = code[rows]
                    root = grouped(len(rows), lambda a, b: (np.bitwise_count(c[a][:, None] ^ c[b][None]).sum(2, dtype=np.int16) <= RADIUS).any(0))
                else:
                    continue
                moved = np.flatnonzero(root != np.arange(len(rows)))
                src.append(cid[rows[moved]])
                dst.append(cid[rows[root[moved]]])
            if src:
                pairs = np.unique(np.stack([np.concatenate(src), np.concatenate(dst)], 1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["src", "dst"])

    rows = classes.where(d.isin(list(samples))).select("cid", "x").mapInArrow(tables, f"bucket long, cid long, {', '.join(f'{c} long' for c in CODES)}")
    edges = _blocked(rows, "bucket", block).mapInArrow(retrieve, "src long, dst long")
    return groups.unionByName(C.connected_components(edges).select(F.col("node").alias("cid"), F.col("component").alias("cluster")))


def rerank(members: DataFrame, threshold: float, block: int = BLOCK) -> DataFrame:
    """(cid, dst, n): of a class, n other vectors linked to it in a block, or a link that joins components.
    ``members`` has cluster, cid, size and x."""

    def judge(it):
        for i, j, rows in _groups(it, "cluster", ["cid", "size", "home", "x"]):
            cid, size, home = (np.array([r[k] for r in rows]) for k in range(3))
            x = unit([r[3] for r in rows])
            n = np.zeros(len(rows), np.int64)
            for a in range(0, len(rows), 512):
                link = x[a:a + 512] @ x.T >= threshold
                link[np.arange(len(link)), a + np.arange(len(link))] = False
                if i != j:
                    link &= home[a:a + 512, None] != home[None, :]
                n[a:a + 512] = link @ size
            root = grouped(len(rows), lambda a, b: ((x[a] @ x[b].T >= threshold) & ((i == j) | (home[a][:, None] != home[b][None, :]))).any(0))
            at, moved = np.flatnonzero(n), np.flatnonzero(root != np.arange(len(rows)))
            yield pa.RecordBatch.from_arrays([pa.array(np.r_[cid[at], cid[moved]]), pa.array([None] * len(at) + cid[root[moved]].tolist(), pa.int64()),
                                              pa.array(np.r_[n[at], np.zeros(len(moved), np.int64)])], ["cid", "dst", "n"])

    return _blocked(members, "cluster", block).mapInArrow(judge, "cid long, dst long, n long")


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, block: int = BLOCK) -> DataFrame:
    """``vectors`` (vec_id, embedding, ...) with n_links, component_id and kept."""
    bare = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("x", lambda v: v != 0)
    valid = F.coalesce(finite, F.lit(False))
    cid = F.when(valid, F.xxhash64("x"))
    classes = C.written(bare.where(valid).groupBy(cid.alias("cid")).agg(
        F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("size"), F.first("x").alias("x")), "classes")
    cluster = candidate_groups(classes, block)
    found = C.written(rerank(classes.join(cluster, "cid").select("cluster", "cid", "size", "x"), threshold, block), "links")
    labels = C.connected_components(found.where("dst is not null").select(F.col("cid").alias("src"), "dst"))
    labels = labels.select(F.col("node").alias("cid"), F.col("component").alias("root"))
    counts = found.groupBy("cid").agg(F.sum("n").alias("more"))
    c = classes.select("cid", "first", "size").join(labels, "cid", "left").join(counts, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    smallest = c.groupBy("root").agg(F.min("first").alias("component"))
    c = c.join(smallest, "root").select("cid", "component", (F.col("size") - 1 + F.coalesce("more", F.lit(0))).alias("links"))
    row = F.struct(*[F.col(f"`{n}`") for n in C.keep_columns(vectors, NEW)])
    rows = vectors.select(row.alias("_row"), F.col("embedding").cast("array<double>").alias("x")).select("_row", cid.alias("cid"))
    component = F.when(F.col("cid").isNull(), F.col("_row")["vec_id"]).otherwise(F.col("component"))
    return rows.join(c, "cid", "left").select("_row.*", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                                              F.coalesce(F.col("_row")["vec_id"] == component, F.lit(False)).alias("kept"))


def op1_query(spark, sf_dir):
    return near_duplicates(C.read(spark, sf_dir, "embeddings").select("vec_id", "embedding")).select("vec_id", "n_links", "component_id", "kept")


OP1_SQL = r"""
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings),
ok AS (SELECT vec_id, x FROM (SELECT vec_id, CASE WHEN len(x) > 0 AND len(list_filter(x, lambda y: y IS NULL OR NOT isfinite(y))) = 0
         AND len(list_filter(x, lambda y: y <> 0)) > 0 THEN x END AS x FROM v) WHERE x IS NOT NULL),
e AS (SELECT a.vec_id AS p, b.vec_id AS q FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) AND list_cosine_similarity(list_transform(a.x, lambda y: coalesce(y, 0)), list_transform(b.x, lambda y: coalesce(y, 0))) >= 0.9),
n AS (SELECT p, count(*) AS n_links FROM e GROUP BY p),
walk AS (SELECT vec_id AS p, vec_id AS q FROM v UNION SELECT walk.p, e.q FROM walk JOIN e ON walk.q = e.p),
c AS (SELECT p, min(q) AS component_id FROM walk GROUP BY p)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM v LEFT JOIN n ON n.p = vec_id JOIN c ON c.p = vec_id
"""
