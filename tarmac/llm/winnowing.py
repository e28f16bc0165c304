"""Benchmark decontamination by winnowing, with DataFrame functions only.

A window is ``window`` consecutive words of a benchmark item (all of them where an item is shorter). Its
fingerprint is the smallest hash of its k-grams. A document's windows are fingerprinted in the same way;
since the choice depends on the window's words alone, a span of ``window`` shared words always shares a
fingerprint. Neighbouring windows mostly share their smallest k-gram, so a document gives a run of windows
per fingerprint, about 2 / (window - k + 2) a word, and only runs whose fingerprint the benchmark holds
go on. Hits are then extended: each window of a surviving run is compared word by word with the
benchmark's windows, and equal ones are joined to spans. Windows of short items are fingerprinted whole
(k = their length).

The fingerprints of the documents are never shuffled while those of the benchmark are at most
``BROADCAST_ROWS`` (counted first); beyond that Spark joins both sides by key.

Defined results: null texts have no words and hit nothing; items without words have no window; a null item
id counts as the id ''; items that share an id are one item. Rows with equal texts get equal results.
Empty documents or benchmark give no hits. Input columns named like a result are replaced, others pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm import common as C

#: The runs of [^\x00-\x2F\x3A-\x60\x7B-\x7F] once A-Z are lower-cased, written as the characters it holds:
#: a negated class of several ranges takes Java's matcher five times as long.
ITEM_WORD = r"[a-z\x{80}-\x{10FFFF}0-9A-Z]+"
WINDOW, K = 13, 7
BROADCAST_ROWS = 500_000
NEW = ["n_words", "n_hit", "n_items", "items", "spans", "contaminated"]


def words(text: Column) -> Column:
    return F.regexp_extract_all(C.lower_ascii(F.coalesce(text, F.lit(""))), F.lit(ITEM_WORD), F.lit(0))


def _held(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``value`` computed once a row: a lambda that names the column then reads it instead of computing it
    again for each element."""
    return df.withColumn(name, F.explode(F.array(value)))


def fingerprint_runs(df: DataFrame, length: int, k: int) -> DataFrame:
    """A row for each run of neighbouring windows with one fingerprint: fp, start (of the first window, from
    0) and seg (all words of the run). ``df`` has the array column ``w``."""
    df = _held(df.where(F.size("w") >= length), "h", F.transform("w", lambda x: F.xxhash64(x)))
    df = _held(df, "kh", F.transform(F.sequence(F.lit(1), F.size("h") - (k - 1)), lambda i: F.xxhash64(F.slice("h", i, F.lit(k))))).drop("h")
    if k < length:
        df = _held(df, "m", F.transform(F.sequence(F.lit(0), F.size("w") - length),
                                        lambda i: F.least(*[F.get("kh", i + j) for j in range(length - k + 1)])))
    else:
        df = df.withColumn("m", F.col("kh"))
    df = _held(df, "s", F.filter(F.sequence(F.lit(0), F.size("m") - 1), lambda i: (i == 0) | (F.get("m", i) != F.get("m", i - 1))))
    run = F.transform("s", lambda s, j: F.struct(F.get("m", s).alias("fp"), s.alias("start"), F.slice(
        "w", s + 1, F.coalesce(F.get("s", j + 1), F.size("m")) - s + (length - 1)).alias("seg")))
    return df.select(*[c for c in df.columns if c not in ("w", "kh", "m", "s")], F.inline(run), F.lit(length).alias("len"))


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """(item, len, win, fp), one row for each distinct window of each item."""
    b = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words(F.col("text")).alias("w"))
    b = _held(b.where(F.size("w") > 0), "len", F.least(F.size("w"), F.lit(window)))
    b = b.select("item", "len", F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - F.col("len") + 1),
                                                      lambda i: F.slice("w", i, F.col("len")))).alias("win"))
    h = F.transform("win", lambda x: F.xxhash64(x))
    fp = F.when(F.col("len") == window, F.array_min(F.transform(
        F.sequence(F.lit(1), F.lit(window - k + 1)), lambda i: F.xxhash64(F.slice(h, i, F.lit(k)))))).otherwise(F.xxhash64(h))
    return b.select("item", "len", fp.alias("fp"), F.array_join("win", " ").alias("win")).distinct()


def find_hits(texts: DataFrame, windows: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """(key, start, len, win) of every occurrence of a benchmark window; ``texts`` has key and text."""
    lengths = sorted(r.len for r in windows.select("len").distinct().collect())  # at most ``window`` numbers
    prints = _small(windows.select("len", "fp").distinct())
    distinct = _small(windows.select("win").distinct())
    docs = texts.select("key", words(F.col("text")).alias("w"))
    found = None
    for length in lengths:
        runs = fingerprint_runs(docs, length, min(k, length) if length == window else length).join(prints, ["len", "fp"])
        at = runs.select("key", "start", "len", "seg", F.explode(F.sequence(F.lit(0), F.size("seg") - length)).alias("o"))
        at = at.select("key", (F.col("start") + F.col("o")).alias("start"), "len", F.array_join(F.slice("seg", F.col("o") + 1, F.lit(length)), " ").alias("win"))
        hits = at.join(distinct, "win").select("key", "start", "len", "win")
        found = hits if found is None else found.union(hits)
    if found is None:
        found = docs.select("key", F.lit(0).alias("start"), F.lit(0).alias("len"), F.lit("").alias("win")).where(F.lit(False))
    return found.distinct()


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, k: int = K, least_share: float = 0.05) -> DataFrame:
    """``docs`` with n_words, n_hit (words inside an occurrence), n_items, items (their ids, sorted as text),
    spans (start and length of each covered stretch, from word 0) and contaminated (hit, and at least
    ``least_share`` of its words are). Texts are joined to their results by a 128-bit digest."""
    key = F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))
    windows = C.written(benchmark_windows(benchmark, window, k), "windows")
    hits = C.written(find_hits(docs.select(key.alias("key"), "text"), windows, window, k), "hits")
    zero = F.array().cast("array<struct<start:int,len:int>>")

    def cover(acc, x):
        last = F.try_element_at(acc, F.lit(-1))
        joins = F.coalesce(x["start"] <= last["start"] + last["len"], F.lit(False))
        grown = F.struct(last["start"].alias("start"), F.greatest(last["len"], x["start"] + x["len"] - last["start"]).alias("len"))
        return F.when(joins, F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(grown))).otherwise(F.concat(acc, F.array(x)))

    spans = hits.groupBy("key").agg(F.array_sort(F.collect_set(F.struct("start", "len"))).alias("at"))
    spans = spans.select("key", F.aggregate("at", zero, cover).alias("spans"))
    items = hits.select("key", "win").distinct().join(windows.select("win", "item"), "win").select("key", "item").distinct()
    items = items.groupBy("key").agg(F.array_sort(F.collect_list("item")).alias("items"))
    per_text = spans.join(items, "key")
    row = F.struct(*[F.col(f"`{c}`") for c in C.keep_columns(docs, NEW)])
    n_words = F.coalesce(F.regexp_count("text", F.lit(ITEM_WORD)), F.lit(0)).cast("long")
    base = docs.select(row.alias("_row"), key.alias("key"), n_words.alias("n_words"))
    out = base.join(per_text, "key", "left").select(
        "_row.*", "n_words",
        F.coalesce(F.aggregate("spans", F.lit(0), lambda a, x: a + x["len"]), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), F.coalesce("spans", zero).alias("spans"))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") >= least_share * F.col("n_words")))


def op2_query(spark, sf_dir):
    docs = C.read(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontaminate(docs, C.read(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                      ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


OP2_SQL = r"""
WITH b AS (SELECT coalesce(item_id::VARCHAR, '') AS item,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
           FROM benchmark),
bw AS (SELECT DISTINCT item, l, array_to_string(w[i:i + l - 1], ' ') AS win
       FROM (SELECT item, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM (SELECT *, least(len(w), 13) AS l FROM b WHERE len(w) > 0))),
d AS (SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM documents),
dw AS (SELECT r, i, l, array_to_string(w[i:i + l - 1], ' ') AS win
       FROM (SELECT r, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM d, (SELECT DISTINCT l FROM bw))),
hits AS (SELECT DISTINCT r, i, l, win FROM dw SEMI JOIN bw USING (win)),
n AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + l)) AS p FROM hits) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
      FROM (SELECT DISTINCT r, item FROM hits JOIN bw USING (win)) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN t USING (r)
"""
