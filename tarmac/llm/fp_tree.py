"""Ranked lexical search over document FP-trees.

1. Items are cut into blocks of about ``BLOCK_TERMS`` distinct terms an item, added up; a block's terms are its
   vocabulary. One pass over the texts gives each document's number of terms and its term vector restricted to
   the vocabulary (written), and from these the collection's N and L and the terms' document frequencies.
2. A task packs its documents in trees of at most ``TREE_DOCS``: vectors ordered by falling document frequency are
   put in a prefix tree, where documents that share their frequent terms share a path (paths without a branch
   are one node). A node keeps the largest tf of each term and the smallest m of its subtree. Maxima are one byte:
   exact up to 127, rounded up beyond, so they stay upper bounds.
3. Each item is searched depth first, the most promising children first and a stack's top ``STEP`` nodes at once.
   A subtree whose bound (score of the maxima under the smallest m) lies below the item's 20th score so far is
   cut off; documents below the others are scored exactly. The 20 best go on from tree to tree of a task.
4. The tasks' lists are merged in two steps, so no task gets more than a share of them.

Results are exact: floors keep the score's order in tf and m, so no bound lies below a document of its subtree.

Defined results: a document or item without a term (null, empty) takes part in nothing; every benchmark row is an
item, repeated rows too; repeated documents rank beside each other, a null doc_id after all equal scores;
terms that no document has score nothing; very long texts are a longer vector, very long items a block of their
own with smaller trees; empty tables give no rows. Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm import common as C

TOP, BLOCK_TERMS, TREE_DOCS, TREE_CELLS, STEP, MERGE = 20, 20_000, 4_096, 1 << 25, 128, 256
LAST = np.iinfo(np.int64).max
#: Bytes of the terms: digits, letters in lower case and whatever is not ASCII; all others become blanks.
TERMS = bytes(b if 48 <= b < 58 or 97 <= b < 123 or b >= 128 else b + 32 if 65 <= b < 91 else 32 for b in range(256))
#: tf that a byte stands for: itself up to 127, then steps of a quarter, up to more than any text holds.
LEVELS = np.array([*range(128), *(int(128 * 1.25 ** i) for i in range(128))], np.int64)


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(TERMS).split()


def gain(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1_000 * tf + 12 * m)


class Tree:
    """FP-tree of documents given by row: ``begin`` (where the row's terms start, and the end), ``rank`` of its
    terms (rising inside a row; 0 is the most frequent term of ``width``), ``tf`` and ``m``."""

    def __init__(self, begin: np.ndarray, rank: np.ndarray, tf: np.ndarray, m: np.ndarray, width: int):
        rows = [rank[a:b] for a, b in zip(begin[:-1], begin[1:])]
        keys = [r.astype(">u4").tobytes() for r in rows]
        self.docs = sorted(range(len(rows)), key=keys.__getitem__)
        self.begin, self.rank, self.tf, self.m, self.width = begin, rank, tf, m, width
        self.cells = np.repeat(np.arange(len(rows)), np.diff(begin)) * width + rank
        self.most, self.least, self.children, self.leaves = [], [], [], []
        open_, last, before = [(0, [])], None, None
        for d in [*self.docs, None]:
            depth = -1 if d is None else 0 if before is None else _shared(rows[before], rows[d])
            if last is not None:
                while open_ and open_[-1][0] > depth:
                    _, below = open_.pop()
                    below.append(last)
                    last = self._close(below)
                if open_ and open_[-1][0] < depth:
                    open_.append((depth, []))
                if open_:
                    open_[-1][1].append(last)
            last, before = None if d is None else ~d, d
        self.most, self.least = np.array(self.most, np.uint8).reshape(-1, width), np.array(self.least, np.int64)

    def _close(self, below: list[int]) -> int:
        """Number of a new node with these children (documents as their complement)."""
        most, least = np.zeros(self.width, np.uint8), LAST
        nodes, docs = [x for x in below if x >= 0], [~x for x in below if x < 0]
        for d in docs:
            at = slice(self.begin[d], self.begin[d + 1])
            r = self.rank[at]
            most[r] = np.maximum(most[r], np.searchsorted(LEVELS, self.tf[at]))
            least = min(least, int(self.m[d]))
        for x in nodes:
            np.maximum(most, self.most[x], out=most)
            least = min(least, self.least[x])
        self.most.append(most)
        self.least.append(least)
        self.children.append(nodes)
        self.leaves.append(docs)
        return len(self.children) - 1

    def bounds(self, nodes: np.ndarray, query: np.ndarray, weight: np.ndarray) -> np.ndarray:
        tf = LEVELS[self.most[nodes[:, None], query]]
        return gain(tf, self.least[nodes][:, None]) @ weight

    def scores(self, docs: np.ndarray, query: np.ndarray, weight: np.ndarray) -> np.ndarray:
        cell = docs[:, None] * self.width + query
        at = np.minimum(np.searchsorted(self.cells, cell), len(self.cells) - 1)
        tf = np.where(self.cells[at] == cell, self.tf[at], 0)
        return gain(tf, self.m[docs][:, None]) @ weight

    def search(self, query: np.ndarray, weight: np.ndarray, ids: np.ndarray, best: np.ndarray, top: int = TOP) -> tuple[np.ndarray, int]:
        """``best`` (score, id by row, highest first) with this tree's documents, and how many were scored.
        ``weight``: of each term of ``query``, times its repeats."""
        if not len(self.children):
            return best, 0
        stack, bound, scored = np.array([len(self.children) - 1]), np.array([LAST]), 0
        while len(stack):
            least = best[top - 1, 0] if len(best) == top else 1
            here = stack[-STEP:][bound[-STEP:] >= least]
            stack, bound = stack[:-STEP], bound[:-STEP]
            docs = np.array([d for x in here for d in self.leaves[x]], np.int64)
            if len(docs):
                scored += len(docs)
                s = self.scores(docs, query, weight)
                good = (s >= least) & (s > 0)
                if good.any():
                    best = np.concatenate([best, np.stack([s[good], ids[docs[good]]], 1)])
                    best = best[np.lexsort((best[:, 1], -best[:, 0]))[:top]]
                    least = best[top - 1, 0] if len(best) == top else 1
            nodes = np.array([c for x in here for c in self.children[x]], np.int64)
            if len(nodes):
                b = self.bounds(nodes, query, weight)
                order = np.argsort(b, kind="stable")
                order = order[b[order] >= least]
                stack, bound = np.concatenate([stack, nodes[order]]), np.concatenate([bound, b[order]])
        return best, scored


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    return int(differ[0]) if len(differ) else n


def item_terms(benchmark: DataFrame) -> DataFrame:
    """(no, item_id, terms, counts): a row for each item with a term, numbered; written."""

    def count(it):
        for b in it:
            out = {"no": [], "terms": [], "counts": []}
            for no, text in zip(b.column(0).to_pylist(), b.column(1)):
                words, n = np.unique(np.array(terms(text.as_py()), object), return_counts=True)
                out["no"].append(no), out["terms"].append(words.tolist()), out["counts"].append(n.tolist())
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("no", pa.int64()), ("terms", pa.list_(pa.binary())), ("counts", pa.list_(pa.int64()))]))

    items = C.written(benchmark.select(F.monotonically_increasing_id().alias("no"), "item_id", F.col("text").cast("string")), "items")
    found = items.select("no", "text").mapInArrow(count, "no long, terms array<binary>, counts array<long>").where(F.size("terms") > 0)
    return C.written(items.select("no", "item_id").join(found, "no"), "item_terms")


def _blocks(items: DataFrame, most: int):
    """Lists of (no, terms, counts) of at most ``most`` terms, or of one item."""
    held, n = [], 0
    for r in items.select("no", "terms", "counts").toLocalIterator():
        if held and n + len(r.terms) > most:
            yield held
            held, n = [], 0
        held.append((r.no, [bytes(t) for t in r.terms], list(r.counts)))
        n += len(r.terms)
    if held:
        yield held


def vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, term, tf): of each document with a term its number of terms, and the vocabulary's terms among
    them with their occurrences, as packed 32-bit numbers; written."""
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def restrict(it):
        get = held.value.get
        for b in it:
            ids, n, term, tf = [], [], [], []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                words = terms(text.as_py())
                if words:
                    t, k = np.unique(np.array([x for x in map(get, words) if x is not None], np.int32), return_counts=True)
                    ids.append(doc_id), n.append(len(words)), term.append(t.tobytes()), tf.append(k.astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(term, pa.binary()), pa.array(tf, pa.binary())], ["doc_id", "n", "term", "tf"])

    d = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return C.written(d.mapInArrow(restrict, "doc_id long, n long, term binary, tf binary"), "vectors")


def document_frequencies(held: DataFrame, width: int) -> np.ndarray:
    """How many documents hold each term of the block's vocabulary."""

    def count(it):
        n = np.zeros(width, np.int64)
        for b in it:
            for t in b.column(0):
                n[np.frombuffer(t.as_py(), np.int32)] += 1
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(n[at], pa.int64())], ["term", "n"])

    out = np.zeros(width, np.int64)
    for r in held.select("term").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[r.term] = r.n
    return out


def search_block(docs: DataFrame, block: list, top: int = TOP) -> DataFrame:
    """(no, part, doc_id, score): each task's best documents of each item of ``block``."""
    spark, vocabulary = docs.sparkSession, {}
    for _, words, _ in block:
        for w in words:
            vocabulary.setdefault(w, len(vocabulary))
    width = len(vocabulary)
    held = vectors(docs, vocabulary)
    n_docs, n_terms = held.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(1))).first()
    df = document_frequencies(held, width)
    w = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)
    rank = np.empty(width, np.int64)
    rank[np.argsort(-df, kind="stable")] = np.arange(width)
    queries = []
    for no, words, counts in block:
        at = np.array([vocabulary[x] for x in words])
        use = df[at] > 0
        queries.append((no, rank[at][use], (w[at] * np.array(counts, np.int64))[use]))
    known = spark.sparkContext.broadcast((rank, queries))
    tree_docs = max(64, min(TREE_DOCS, TREE_CELLS // max(1, width)))

    def search(it):
        from pyspark import TaskContext

        rank, queries = known.value
        best = [np.zeros((0, 2), np.int64) for _ in queries]
        rows = []

        def flush():
            t = [rank[np.frombuffer(r[2], np.int32)] for r in rows]
            order = [np.argsort(x) for x in t]
            begin = np.concatenate([[0], np.cumsum([len(x) for x in t])])
            tree = Tree(begin, np.concatenate([x[o] for x, o in zip(t, order)]), np.concatenate([np.frombuffer(r[3], np.int32)[o] for r, o in zip(rows, order)]).astype(np.int64),
                        np.array([75 + 25 * r[1] * n_docs // n_terms for r in rows], np.int64), width)
            ids = np.array([LAST if r[0] is None else r[0] for r in rows], np.int64)
            for i, (_, q, weight) in enumerate(queries):
                if len(q):
                    best[i], _ = tree.search(q, weight, ids, best[i], top)
            rows.clear()

        for b in it:
            for r in zip(*(b.column(i).to_pylist() for i in range(4))):
                if r[2]:
                    rows.append(r)
                    if len(rows) == tree_docs:
                        flush()
        if rows:
            flush()
        part = TaskContext.get().partitionId()
        out = np.concatenate(best) if best else np.zeros((0, 2), np.int64)
        no = np.repeat(np.array([q[0] for q in queries], np.int64), [len(x) for x in best])
        yield pa.RecordBatch.from_arrays([pa.array(no), pa.array([part] * len(no), pa.int32()), pa.array(out[:, 1], mask=out[:, 1] == LAST), pa.array(out[:, 0])], ["no", "part", "doc_id", "score"])

    return held.mapInArrow(search, "no long, part int, doc_id long, score long")


def ranked_search(docs: DataFrame, benchmark: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of ``docs`` (doc_id, text) for each row of
    ``benchmark`` (item_id, text)."""
    items = item_terms(benchmark)
    found = None
    for block in _blocks(items, block_terms):
        f = C.written(search_block(docs, block, top), "found")
        found = f if found is None else found.unionByName(f)
    if found is None:
        return items.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).where(F.lit(False))
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    share = Window.partitionBy("no", "share").orderBy(*order)
    some = found.withColumn("share", F.col("part") % MERGE).withColumn("rank", F.row_number().over(share)).where(F.col("rank") <= top)
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("no").orderBy(*order))).where(F.col("rank") <= top)
    return some.join(items.select("no", "item_id"), "no").select("item_id", "rank", "doc_id", "score")


def op11_query(spark, sf_dir):
    return ranked_search(C.read(spark, sf_dir, "documents").select("doc_id", "text"), C.read(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT row_number() OVER () AS no, item_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
q AS (SELECT no, term, count(*) AS k FROM (SELECT no, unnest(w) AS term FROM b) GROUP BY no, term),
size AS (SELECT count(*) AS docs, sum(len(w))::BIGINT AS terms FROM d WHERE len(w) > 0),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) SEMI JOIN (SELECT DISTINCT term FROM q) USING (term) GROUP BY r, term),
idf AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS weight FROM tf, size GROUP BY term, docs),
m AS (SELECT r, doc_id, 75 + (25 * len(w) * docs) // terms AS m FROM d, size WHERE len(w) > 0),
s AS (SELECT no, r, doc_id, sum(k * weight * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
      FROM q JOIN tf USING (term) JOIN idf USING (term) JOIN m USING (r) GROUP BY no, r, doc_id),
top AS (SELECT no, doc_id, score, row_number() OVER (PARTITION BY no ORDER BY score DESC, doc_id ASC NULLS LAST)::INTEGER AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM top JOIN b USING (no) WHERE rank <= 20
"""
