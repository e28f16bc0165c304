"""Phrase collocations from FM-indexes of shards of words.

1. Texts are cut into pieces and words, and packed in shards of about ``SHARD_WORDS`` words (ends of pieces are
   symbols, languages share a shard: a word of two languages is two symbols). Written, with each shard's words
   and their counts, which are summed to the word counts of each language.
2. Words counted ``min_count`` times or more go into a bitmap of 2^``FILTER_BITS`` bits (8 MB at any size of
   the corpus; a rare word that falls on a set bit is only kept longer). A shard turns other words to one symbol
   that ends phrases. In the FM-index of its reverse every word's interval is extended to the right: pairs with
   their counts, and how often a word stands before and after them. Pairs are summed over the shards.
3. The pairs that are frequent over all shards make the second bitmap. In the FM-index of its text each shard
   extends its pairs that are in it to the left where the new pair is too. Triples are summed; phrases below
   ``min_count`` go.
4. Phrases meet the counts of their parts by joins; scores are exact (decimals of 38 digits). A pair inside a
   triple with at least ``ABSORBED`` percent of its count goes. Each language's first ``top`` are found in rounds
   of windows over bounded shares of its phrases.

Bitmaps only save work: each count is a sum over all shards, compared word by word.

Defined results: a null text has no words; a null language is ``und``; repeated rows count each time; a very long
text goes on in the next shard after any piece (a piece stays whole); empty tables give no rows. Only ``text`` and
``lang`` are read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard as zstd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm import common as C
from tarmac.llm.phrase_index import PIECE, RARE, pairs as index_pairs, triples as index_triples

MIN_COUNT, TOP, ABSORBED = 10, 2_000, 50
SHARD_WORDS, FILTER_BITS, ROWS, SHARE_ROWS = 500_000, 26, 50_000, 200_000
PAIR = 7919  # factor of the first word's checksum in a pair's
#: A-Z in lower case, ends of pieces (.,;:!? and the bytes 10 to 13) as line feeds, tabs as blanks.
TEXT = bytes(10 if b in b".,;:!?" or 10 <= b <= 13 else 32 if b == 9 else b + 32 if 65 <= b < 91 else b for b in range(256))


class _Numbers(dict):
    """Number of each word of one language in a shard; ``words`` are all the shard's (language, word)."""

    def __init__(self, lang: str, words: list):
        super().__init__({b"\n": PIECE, b"": -1})
        self.lang, self.words = lang, words

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self.words)
        self.words.append((self.lang, word))
        return n


def _pack(x: np.ndarray) -> bytes:
    return zstd.ZstdCompressor(level=1).compress(x.tobytes())


def _unpack(x: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstd.ZstdDecompressor().decompress(x), kind)


def word_shards(docs: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(langs, words, counts, ids): ids are numbers of the lists' entries, 0 the end of a piece; written."""

    def pack(it):
        words, numbers, held, size = [(None, b"\n")], {}, [], 0

        def flush():
            ids = np.concatenate([*held, np.zeros(1, np.int32)])
            ids = ids[(ids != PIECE) | (np.concatenate([[1], ids[:-1]]) != PIECE)]
            langs = sorted({x for x, _ in words[1:]})
            number = {x: i for i, x in enumerate(langs)}
            return pa.RecordBatch.from_pylist([{
                "langs": langs, "lang": _pack(np.array([0, *(number[x] for x, _ in words[1:])], np.int32)), "words": zstd.ZstdCompressor(level=1).compress(b"\n".join(w for _, w in words[1:])),
                "counts": _pack(np.bincount(ids, minlength=len(words)).astype(np.int32)), "ids": _pack(ids)}], schema=schema)

        for b in it:
            for text, lang in zip(b.column(0), b.column(1).to_pylist()):
                raw = (text.as_py() or "").encode().translate(TEXT)
                while raw:
                    cut = raw.find(b"\n", 8 * shard_words) + 1 or len(raw)  # not more than a shard at once
                    some, raw = raw[:cut], raw[cut:]
                    if lang not in numbers:
                        numbers[lang] = _Numbers(lang, words)
                    ids = np.array(list(map(numbers[lang].__getitem__, some.replace(b"\n", b" \n ").split(b" "))), np.int32)
                    held += [ids[ids >= 0], np.zeros(1, np.int32)]
                    size += len(held[-2])
                    if size >= shard_words:
                        yield flush()
                        words, numbers, held, size = [(None, b"\n")], {}, [], 0
        if size:
            yield flush()

    schema = pa.schema([("langs", pa.list_(pa.string())), *((c, pa.binary()) for c in ("lang", "words", "counts", "ids"))])
    d = docs.select(F.col("text").cast("string"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    return C.written(d.mapInArrow(pack, "langs array<string>, lang binary, words binary, counts binary, ids binary"), "word_shards")


def _words(row) -> tuple[pa.Array, np.ndarray, list[bytes]]:
    """(languages, number of each word's language, words) of a shard; entry 0 is the end of a piece."""
    lang = _unpack(row["lang"], np.int32)
    raw = zstd.ZstdDecompressor().decompress(row["words"])
    return pa.array(row["langs"] or [""], pa.string()), lang, [b"", *(raw.split(b"\n") if len(lang) > 1 else [])]


def _rows(it, *names):
    """Shards one by one: a batch may hold many."""
    for b in it:
        for i in range(b.num_rows):
            yield {n: b.column(n)[i].as_py() for n in names}


def word_counts(shards: DataFrame) -> DataFrame:
    """(lang, word, n), written."""

    def send(it):
        for row in _rows(it, "langs", "lang", "words", "counts"):
            langs, lang, words = _words(row)
            n = _unpack(row["counts"], np.int32)
            for i in range(1, len(words), ROWS):
                at = slice(i, i + ROWS)
                yield pa.RecordBatch.from_arrays([langs.take(pa.array(lang[at])), pa.array(words[at], pa.binary()).cast(pa.string()), pa.array(n[at].astype(np.int64))], ["lang", "word", "n"])

    rows = shards.select("langs", "lang", "words", "counts").mapInArrow(send, "lang string, word string, n long")
    return C.written(rows.groupBy("lang", "word").agg(F.sum("n").alias("n")), "word_counts")


def checksum(lang: Column, *words: Column) -> Column:
    """The place of a word, or of two in a row, in a bitmap, before it is cut to its size."""
    one, *two = [F.crc32(F.concat_ws("\n", lang, w).cast("binary")) for w in words]
    return one * PAIR + two[0] if two else one


def bitmap(df: DataFrame, place: Column, bits: int = FILTER_BITS) -> bytes:
    """A bit for the checksum of each row: at most 2^(bits - 3) bytes, for the driver to broadcast."""
    bucket = 1 << min(15, bits)
    at = place % (1 << bits) + 1
    rows = df.groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).collect()
    out = np.zeros(1 << max(0, bits - 3), np.uint8)
    for r in rows:
        begin = (r.bucket - 1) * (bucket // 8)
        out[begin:begin + bucket // 8] = np.frombuffer(r.bits, np.uint8)[:bucket // 8]
    return out.tobytes()


def in_bitmap(held: np.ndarray, place: np.ndarray) -> np.ndarray:
    at = place % (8 * len(held))
    return (held[at >> 3] >> (at & 7)) & 1 == 1


def _phrases(langs, lang, words: pa.Array, parts: list[np.ndarray], *numbers):
    """Batches of (lang, phrase, numbers...)."""
    for i in range(0, len(parts[0]), ROWS):
        at = slice(i, i + ROWS)
        phrase = pc.binary_join_element_wise(*(words.take(pa.array(p[at])) for p in parts), " ")
        yield pa.RecordBatch.from_arrays([langs.take(pa.array(lang[parts[0][at]])), phrase, *(pa.array(x[at].astype(np.int64)) for x in numbers)], ["lang", "phrase", "n", "n_left", "n_right"])


def _symbols(row, frequent: np.ndarray):
    """(languages, language and checksum of each symbol, symbols' words, text) of a shard; rare words end phrases."""
    langs, lang, words = _words(row)
    prefix = [x.encode() + b"\n" for x in langs.to_pylist()]
    place = np.fromiter((zlib.crc32(prefix[k] + w) for k, w in zip(lang.tolist(), words)), np.int64)
    known = in_bitmap(frequent, place)
    known[0] = False
    symbol = np.where(known, np.cumsum(known) + RARE, RARE)
    symbol[0] = PIECE
    at = np.flatnonzero(known)
    lang, place, words = np.concatenate([[0, 0], lang[at]]), np.concatenate([[0, 0], place[at]]), ["", "", *(words[i].decode() for i in at)]
    return langs, lang, place, pa.array(words, pa.string()), symbol[_unpack(row["ids"], np.int32)]


SUMMED = "lang string, phrase string, n long, n_left long, n_right long"


def _summed(rows: DataFrame, min_count: int, name: str) -> DataFrame:
    sums = rows.groupBy("lang", "phrase").agg(*[F.sum(c).alias(c) for c in ("n", "n_left", "n_right")])
    return C.written(sums.where(F.col("n") >= min_count), name)


def pair_counts(shards: DataFrame, frequent: bytes, min_count: int = MIN_COUNT) -> DataFrame:
    """(lang, phrase, n, n_left, n_right) of pairs of words; written."""
    held = shards.sparkSession.sparkContext.broadcast(frequent)

    def send(it):
        for row in _rows(it, "langs", "lang", "words", "ids"):
            langs, lang, _, words, text = _symbols(row, np.frombuffer(held.value, np.uint8))
            one, two, *numbers = index_pairs(text)
            yield from _phrases(langs, lang, words, [one, two], *numbers)

    return _summed(shards.select("langs", "lang", "words", "ids").mapInArrow(send, SUMMED), min_count, "pairs")


def triple_counts(shards: DataFrame, frequent: bytes, pairs: bytes, min_count: int = MIN_COUNT) -> DataFrame:
    """(lang, phrase, n, n_left, n_right) of three words in a row, both pairs of which are in ``pairs``; written."""
    held = shards.sparkSession.sparkContext.broadcast((frequent, pairs))

    def send(it):
        for row in _rows(it, "langs", "lang", "words", "ids"):
            words_map, pairs_map = (np.frombuffer(x, np.uint8) for x in held.value)
            langs, lang, place, words, text = _symbols(row, words_map)
            one, two, three, *numbers = index_triples(text, lambda a, b: in_bitmap(pairs_map, place[a] * PAIR + place[b]))
            yield from _phrases(langs, lang, words, [one, two, three], *numbers)

    return _summed(shards.select("langs", "lang", "words", "ids").mapInArrow(send, SUMMED), min_count, "triples")


def _part(i: int) -> Column:
    return F.substring_index(F.substring_index("phrase", " ", i), " ", -1)


def _score(a: str, left: str, right: str) -> Column:
    d = lambda c: f"CAST({c} AS DECIMAL(16, 0))"
    return F.expr(f"(CAST(1000000 AS DECIMAL(7, 0)) * {d(a)} * {d(a)}) DIV ({d(left)} * {d(right)})")


def scored(words: DataFrame, pairs: DataFrame, triples: DataFrame, absorbed: int = ABSORBED) -> DataFrame:
    """(lang, phrase, a, l, r, score, n_left, n_right) of candidates that no longer one absorbs."""
    count = lambda df, col, key, n: df.select("lang", F.col(col).alias(key), F.col("n").alias(n))
    two = pairs.select("lang", "phrase", F.col("n").alias("a"), "n_left", "n_right", _part(1).alias("w1"), _part(2).alias("w2"))
    three = triples.select("lang", "phrase", F.col("n").alias("a"), "n_left", "n_right", _part(1).alias("w1"), _part(2).alias("w2"), _part(3).alias("w3"))
    three = three.withColumn("head", F.concat_ws(" ", "w1", "w2")).withColumn("tail", F.concat_ws(" ", "w2", "w3"))
    longer = three.select("lang", F.explode(F.array("head", "tail")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    two = (two.join(longer, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("longer") < absorbed * F.col("a"), F.lit(True)))
           .join(count(words, "word", "w1", "l"), ["lang", "w1"]).join(count(words, "word", "w2", "r"), ["lang", "w2"]))
    two = two.select("lang", "phrase", "a", "l", "r", _score("a", "l", "r").alias("score"), "n_left", "n_right")
    three = (three.join(count(words, "word", "w1", "f1"), ["lang", "w1"]).join(count(words, "word", "w3", "f3"), ["lang", "w3"])
             .join(count(pairs, "phrase", "head", "f12"), ["lang", "head"]).join(count(pairs, "phrase", "tail", "f23"), ["lang", "tail"]))
    three = three.withColumn("s1", _score("a", "f1", "f23")).withColumn("s2", _score("a", "f12", "f3"))
    first = F.col("s1") <= F.col("s2")
    three = three.select("lang", "phrase", "a", F.when(first, F.col("f1")).otherwise(F.col("f12")).alias("l"), F.when(first, F.col("f23")).otherwise(F.col("f3")).alias("r"),
                         F.least("s1", "s2").alias("score"), "n_left", "n_right")
    return two.unionByName(three)


def first_of_each(df: DataFrame, top: int, share_rows: int = SHARE_ROWS) -> DataFrame:
    """``df`` with ``rank``, the first ``top`` of each language; no task ranks more than about ``share_rows`` rows."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rows = df.count()
    while rows > share_rows and rows > 2 * top:
        shares = -(-rows // max(share_rows, 4 * top)) + 1
        window = Window.partitionBy("lang", "share").orderBy(*order)
        df = df.withColumn("share", F.pmod(F.xxhash64("phrase", F.lit(shares)), F.lit(shares))).withColumn("rank", F.row_number().over(window))
        df = C.written(df.where(F.col("rank") <= top).drop("share", "rank"), "first")
        before, rows = rows, df.count()
        if rows * 2 > before:  # as many languages as that: shares of a language are small already
            break
    return df.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, absorbed: int = ABSORBED, shard_words: int = SHARD_WORDS, filter_bits: int = FILTER_BITS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score, n_left, n_right) of ``docs`` (text, lang)."""
    shards = word_shards(docs, shard_words)
    counts = word_counts(shards)
    total = counts.groupBy("lang").agg(F.sum("n").alias("n"))
    words = counts.where(F.col("n") >= min_count)
    frequent = bitmap(words, checksum(F.col("lang"), F.col("word")), filter_bits)
    pairs = pair_counts(shards, frequent, min_count)
    place = checksum(F.col("lang"), _part(1), _part(2))
    triples = triple_counts(shards, frequent, bitmap(pairs, place, filter_bits), min_count)
    best = first_of_each(C.written(scored(words, pairs, triples, absorbed), "scored"), top)
    return best.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "n_left", "n_right")


def op13_query(spark, sf_dir):
    return collocations(C.read(spark, sf_dir, "documents").select("text", "lang")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


OP13_SQL = r"""
WITH p AS (SELECT row_number() OVER () AS id, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
      SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, (SELECT unnest([1, 2, 3]) AS k))),
total AS (SELECT lang, count(*) AS n FROM g WHERE k = 1 GROUP BY lang),
f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY lang, k, phrase HAVING count(*) >= 10),
c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cut AS (SELECT lang, k, phrase, a, i, array_to_string(w[1:i], ' ') AS head, array_to_string(w[i + 1:k], ' ') AS tail FROM (SELECT *, unnest(range(1, k)) AS i FROM c)),
s AS (SELECT cut.lang, cut.k, cut.phrase, cut.a, i, x.a AS l, y.a AS r, (1000000::HUGEINT * cut.a * cut.a // (x.a::HUGEINT * y.a))::BIGINT AS score
      FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = head JOIN f y ON y.lang = cut.lang AND y.phrase = tail),
least AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) AS o FROM s) WHERE o = 1),
absorbed AS (SELECT DISTINCT c.lang, c.phrase FROM c JOIN (SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase FROM c WHERE k = 3) t
             ON t.lang = c.lang AND t.phrase = c.phrase WHERE 100 * t.a >= 50 * c.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM least ANTI JOIN absorbed USING (lang, phrase))
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""
