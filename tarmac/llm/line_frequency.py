"""Quality rules by cross-document line frequency, with DataFrame functions only.

A host is a ``source``. Lines are normalised (lower case, runs of digits as 0, runs of blanks as one, no blanks at
the ends) and hashed with their host to 128 bits. For each line the distinct documents of the host that hold it
are counted; a document is its text, so exact copies count once. A line is above the limits of its host if more
than ``MIN_DOCS`` documents and more than ``HOST_SHARE`` of the host's documents hold it. Such lines are removed
from every document of the host, and a document is depleted, thus rejected, if more than ``DEPLETED`` of its
words lie in removed lines.

1. (host, line, document) is made distinct, lines are counted per host (both with partial aggregation, so a line
   in a third of all documents is a row a task), and the lines above the limits written.
2. Texts are read again and their lines joined to those above the limits. At most ``HEAVY`` of them (16 bytes
   each), the most frequent, are broadcast; what is left is rarer than one in ``HEAVY`` of the hits and joined by key.
3. Each distinct text of a host gets its removed lines, which are joined to the rows by (host, digest).

Base rules need no other document: words, code points in words, symbols, lines equal to an earlier one and words
in repeated 3-word windows. Windows of a text are found again by sorting their hashes inside the row.

Defined results: a null text is the empty text; texts without words have no line and fail the base rule; a null
source is a host of its own; repeated rows and ids are judged by their text; very long texts stay in one row;
empty tables give no rows. Input columns named like a result are replaced, others pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm import common as C

MIN_DOCS, HOST_SHARE, DEPLETED = 20, 0.02, 0.5
MIN_WORDS, REPEAT_PERCENT, SHINGLE = 50, 50, 3
HEAVY = 100_000
NEW = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_lines_removed", "n_words_removed", "kept", "kept_text"]


def _held(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``value`` computed once a row, so that lambdas read it instead of computing it for each element."""
    return df.withColumn(name, F.explode(F.array(value)))


def text_lines(text: Column) -> Column:
    return F.split(text, "\n")


def normalised(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), "[0-9]+", "0"), r"[\x20\x09\x0B-\x0D]+", " "))


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def _host() -> Column:
    return F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n"))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(_host().alias("host"), _text().alias("text"))


def host_lines(docs: DataFrame) -> DataFrame:
    """(host, digest, at, words, h1, h2): each line with a word of each row."""
    t = _texts(docs)
    t = t.select("host", _digest(F.col("text")).alias("digest"), F.posexplode(text_lines(F.col("text"))).alias("at", "line"))
    t = t.withColumn("words", F.regexp_count("line", F.lit(C.WORD))).where("words > 0").withColumn("line", normalised(F.col("line")))
    return t.select("host", "digest", "at", "words", F.xxhash64("host", "line").alias("h1"), F.xxhash64(F.lit(1), "line", "host").alias("h2"))


def frequent_lines(docs: DataFrame, min_docs: int = MIN_DOCS, host_share: float = HOST_SHARE) -> DataFrame:
    """(host, h1, h2, docs): the lines above the limits of their host, written."""
    hosts = _texts(docs).select("host", _digest(F.col("text")).alias("digest")).distinct().groupBy("host").agg(F.count(F.lit(1)).alias("host_docs"))
    lines = host_lines(docs).select("host", "h1", "h2", "digest").distinct()
    lines = lines.groupBy("host", "h1", "h2").agg(F.count(F.lit(1)).alias("docs")).where(F.col("docs") > min_docs)
    return C.written(lines.join(hosts, "host").where(F.col("docs") > host_share * F.col("host_docs")).drop("host_docs"), "frequent_lines")


def removed_lines(docs: DataFrame, frequent: DataFrame) -> DataFrame:
    """(host, digest, gone): for each text of a host that holds lines of ``frequent``, their places and words."""
    lines, keys = host_lines(docs), frequent.select("h1", "h2", "docs")
    rows, hits = keys.agg(F.count(F.lit(1)), F.coalesce(F.sum("docs"), F.lit(0))).first()
    if rows <= HEAVY:
        found = lines.join(F.broadcast(keys.drop("docs")), ["h1", "h2"])
    else:
        limit = hits // HEAVY  # fewer than HEAVY lines can have more documents
        found = (lines.join(F.broadcast(keys.where(F.col("docs") > limit).drop("docs")), ["h1", "h2"])
                 .unionByName(lines.join(keys.where(F.col("docs") <= limit).drop("docs"), ["h1", "h2"])))
    return found.groupBy("host", "digest").agg(F.sort_array(F.collect_set(F.struct("at", "words"))).alias("gone"))


def repeated_words(df: DataFrame, out: str, shingle: int = SHINGLE) -> DataFrame:
    """``df``, which has the array column ``w``, with ``out``: how many words lie in windows of ``shingle`` words
    that the text holds twice or more."""
    windows = F.when(F.size("w") > shingle, F.transform(F.sequence(F.lit(0), F.size("w") - shingle), lambda i: F.xxhash64(*[F.get("w", i + k) for k in range(shingle)])))
    df = _held(df, "_h", F.coalesce(windows, F.array().cast("array<bigint>")))
    again = F.size(F.array_distinct("_h")) < F.size("_h")
    df = _held(df, "_h", F.when(again, F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).otherwise(
        F.array().cast("array<struct<h:bigint,i:int>>")))
    same = lambda x, i: (x["h"] == F.get("_h", i - 1)["h"]) | (x["h"] == F.get("_h", i + 1)["h"])
    df = _held(df, "_h", F.sort_array(F.transform(F.filter("_h", lambda x, i: F.coalesce(same(x, i), F.lit(False))), lambda x: x["i"])))
    covered = F.transform("_h", lambda x, i: F.least(F.lit(shingle), F.coalesce(F.get("_h", i + 1) - x, F.lit(shingle))))
    return df.withColumn(out, F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x)).drop("_h")


def without(lines: Column, gone: Column) -> Column:
    """``lines`` less those at the sorted places ``gone``: the stretches between them, joined."""
    before = lambda i: F.coalesce(F.get(gone, i - 1)["at"], F.lit(-1)) + 1
    until = lambda i: F.coalesce(F.get(gone, i)["at"], F.size(lines))
    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(gone)), lambda i: F.slice(lines, before(i) + 1, until(i) - before(i))))


def quality_rules(docs: DataFrame, min_docs: int = MIN_DOCS, host_share: float = HOST_SHARE, depleted: float = DEPLETED) -> DataFrame:
    """``docs`` (doc_id, text, source, ...) with the columns ``NEW``; ``kept_text`` is the text without removed lines."""
    frequent = frequent_lines(docs, min_docs, host_share)
    gone = removed_lines(docs, frequent)
    row = F.struct(*[F.col(f"`{c}`") for c in C.keep_columns(docs, NEW)])
    t = docs.select(row.alias("_row"), _text().alias("_text"), _host().alias("host"))
    lines = F.filter(text_lines(F.col("_text")), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]")))
    t = _held(t.withColumn("digest", _digest(F.col("_text"))).withColumn("n_symbols", F.regexp_count("_text", F.lit("[#*$%&|<>]")).cast("long")), "_lines", lines)
    t = t.withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long")).drop("_lines")
    t = _held(t, "w", F.regexp_extract_all("_text", F.lit(C.WORD), F.lit(0)))
    t = t.withColumn("n_words", F.size("w").cast("long")).withColumn("word_chars", F.length(F.array_join("w", "")).cast("long"))
    t = repeated_words(t, "n_repeat_words").drop("w")
    t = t.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")))
    t = t.join(gone, ["host", "digest"], "left")
    lost = F.coalesce(F.aggregate("gone", F.lit(0).cast("long"), lambda a, x: a + x["words"]), F.lit(0))
    return t.select("_row.*", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_lines_removed"), lost.alias("n_words_removed"),
                    (~F.col("base_failed") & (lost <= depleted * F.col("n_words"))).alias("kept"),
                    F.when(F.col("gone").isNull(), F.col("_text")).otherwise(F.array_join(without(text_lines(F.col("_text")), F.col("gone")), "\n")).alias("kept_text"))


def op12_query(spark, sf_dir):
    docs = C.read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return quality_rules(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, coalesce('s' || source::VARCHAR, 'n') AS host,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT r, host, t, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM (SELECT r, host, t, unnest(string_split(t, chr(10))) AS line FROM d)),
lines AS (SELECT *, trim(regexp_replace(regexp_replace(lower(line), '[0-9]+', '0', 'g'), '[\x20\x09\x0B-\x0D]+', ' ', 'g')) AS norm FROM l WHERE words > 0),
hosts AS (SELECT host, count(DISTINCT t) AS host_docs FROM d GROUP BY host),
often AS (SELECT host, norm FROM (SELECT host, norm, count(DISTINCT t) AS docs FROM lines GROUP BY host, norm) JOIN hosts USING (host)
          WHERE docs > 20 AND docs > 0.02 * host_docs),
gone AS (SELECT r, sum(words) AS lost FROM lines SEMI JOIN often USING (host, norm) GROUP BY r),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY r),
win AS (SELECT r, i, w[i:i + 2] AS x FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, x) AS n FROM win) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT p) AS n_repeat_words FROM (SELECT r, unnest(range(i, i + 3)) AS p FROM again) GROUP BY r),
f AS (SELECT r, doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(lost, 0) AS lost
      FROM d LEFT JOIN dup USING (r) LEFT JOIN rep USING (r) LEFT JOIN gone USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND 2 * lost <= n_words AS kept FROM b
"""
