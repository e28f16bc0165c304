"""Substring deduplication with an FM-index per shard.

A window is ``WINDOW`` consecutive words. Words that a window covers are removed where the same window also
starts earlier: in a smaller id, or earlier in the same document. The corpus is split so that equal
windows meet in one shard, and each shard indexes only what may repeat:

1. Documents are packed into batches (a table of compressed texts). Each window has its smallest
   ``K``-gram hash; neighbouring windows mostly share it and form a run. A batch sends its distinct run
   hashes, marked where two of its runs have it or one has it at two places; a hash is shared if two
   batches have it or one marks it.
2. A batch sends its distinct segments (the words of a run) with a shared hash to the shard of the hash,
   each with the earliest place the batch has it at. A hash in more than ``HOT_BATCHES`` batches is
   split by its windows: each goes alone, to the shard of its own hash. So a shard gets a passage once
   a batch, however often the batch repeats it, and no passage meets all its contexts in one task.
3. A shard builds a compressed FM-index of its distinct segments and streams them through backward search:
   matching statistics give the interval of each window, and the interval's earliest place goes back
   to the batches, for each segment they sent.
4. Batches compare that place with their own, mark covered words and digest what is left.

Words are compared, not hashes: hashes only choose the shard. Batches and shards are of bounded size.

Defined results: null and wordless texts have no words; documents of fewer words than a window are kept
whole; documents that share an id count as one place in the order, none earlier than the other; a null id
is after all others; an empty table gives no rows. Only ``doc_id`` and ``text`` are read.
"""

import hashlib

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm import common as C
from tarmac.llm.fm_index import FMIndex
from tarmac.llm.hashing import mixed, ngrams, word_hashes

WINDOW, K = 20, 8
RUN, HOT_BATCHES = 64, 64
BATCH_CHARS, BUCKET_HASHES, SHARD_RUNS = 4 << 20, 3_000_000, 40_000
LAST = np.iinfo(np.int64).max


def _pack(x, kind=None) -> bytes:
    return zstd.ZstdCompressor(level=3).compress(x if kind is None else np.asarray(x, kind).tobytes())


def _unpack(x, kind=None):
    raw = zstd.ZstdDecompressor().decompress(x)
    return raw if kind is None else np.frombuffer(raw, kind)


def _smallest(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours."""
    size = 1
    while size * 2 <= width:
        x, size = np.minimum(x[:-size], x[size:]), size * 2
    return np.minimum(x[:len(x) - (width - size)], x[width - size:])


def _runs(hashes: np.ndarray, counts: np.ndarray):
    """Runs of windows with one smallest k-gram: (document, start in it, windows, hash), documents of ``counts``
    words one after another. The hash's lowest bit tells whether the k-gram occurs twice in the run."""
    empty = [np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)]
    if len(hashes) < WINDOW:
        return empty
    grams = ngrams(hashes, K) >> np.uint64(1)
    least = _smallest(grams, WINDOW - K + 1)
    begin = np.cumsum(counts) - counts
    doc = np.repeat(np.arange(len(counts)), counts)[:len(least)]
    at = np.flatnonzero(np.arange(len(least)) + WINDOW <= (begin + counts)[doc])
    if not len(at):
        return empty
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (least[at[1:]] != least[at[:-1]]) | (doc[at[1:]] != doc[at[:-1]])
    first = np.flatnonzero(new)
    offset = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
    first = np.flatnonzero(offset % RUN == 0)
    size, first = np.diff(np.append(first, len(at))), at[first]
    n = size + (WINDOW - K)
    place = np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)
    again = np.add.reduceat(grams[place] == np.repeat(least[first], n), np.cumsum(n) - n, dtype=np.int64) > 1
    return doc[first], first - begin[doc[first]], size, least[first] * np.uint64(2) + again


def document_batches(docs: DataFrame, batch_chars: int) -> DataFrame:
    """Texts packed in batches of about ``batch_chars``, with ids, word counts, digests and runs; written."""

    def pack(batches):
        from pyspark import TaskContext

        number, held, chars = TaskContext.get().partitionId() << 32, [], 0

        def flush():
            texts = [(t or "").encode() for _, t in held]
            words = [t.split() for t in texts]
            counts = np.array([len(w) for w in words])
            doc, start, size, least = _runs(word_hashes([w for x in words for w in x]), counts)
            digests = b"".join(hashlib.sha256(b" ".join(w)).digest() for w in words)
            return pa.RecordBatch.from_pylist([{
                "batch": number, "ids": np.array([LAST if i is None else i for i, _ in held], np.int64).tobytes(),
                "has": np.array([i is not None for i, _ in held], np.uint8).tobytes(), "n_words": counts.astype(np.int64).tobytes(), "digests": digests,
                "sizes": np.array([len(t) for t in texts], np.int64).tobytes(), "texts": _pack(b"".join(texts)),
                "run_doc": _pack(doc, np.int32), "run_start": _pack(start, np.int32), "run_size": _pack(size, np.uint8), "run_hash": least.tobytes()}],
                schema=schema)

        schema = pa.schema([(f.name, pa.int64() if f.name == "batch" else pa.binary()) for f in fields])
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                held.append((doc_id, text.as_py()))
                chars += len(held[-1][1] or "")
                if chars >= batch_chars:
                    yield flush()
                    number, held, chars = number + 1, [], 0
        if held:
            yield flush()

    names = "batch long, ids binary, has binary, n_words binary, digests binary, sizes binary, texts binary, run_doc binary, run_start binary, run_size binary, run_hash binary"
    fields = docs.sparkSession.createDataFrame([], names).schema.fields
    d = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return C.written(d.mapInArrow(pack, names), "batches")


def _rows(batches, *names):
    for b in batches:
        yield from zip(*(b.column(n).to_pylist() for n in names))


def _groups(rows):
    """Rows of a sorted stream by their first column."""
    key, held = None, []
    for row in rows:
        if held and row[0] != key:
            yield key, held
            held = []
        key = row[0]
        held.append(row[1:])
    if held:
        yield key, held


def shared_hashes(batches: DataFrame, hot_batches: int) -> DataFrame:
    """(batch, shared): sorted run hashes of a batch that occur elsewhere or again in it, their lowest bit
    telling whether they are hot."""
    spark = batches.sparkSession
    total = batches.agg(F.coalesce(F.sum(F.length("run_hash")), F.lit(0))).first()[0] // 8
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_HASHES))

    def send(it):
        for number, raw in _rows(it, "batch", "run_hash"):
            raw = np.frombuffer(raw, np.uint64)
            u, inv, count = np.unique(raw >> np.uint64(1), return_inverse=True, return_counts=True)
            h = u * np.uint64(2) + ((count > 1) | (np.bincount(inv, raw & np.uint64(1), len(u)) > 0))  # the lowest bit: the batch repeats it
            bucket = (mixed(h >> np.uint64(1)) % np.uint64(n)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            h, bucket = h[order], bucket[order]
            at = np.flatnonzero(np.diff(bucket, prepend=-1))
            yield pa.RecordBatch.from_arrays([pa.array(bucket[at]), pa.array([number] * len(at), pa.int64()),
                                              pa.array([x.tobytes() for x in np.split(h, at[1:])] if len(at) else [], pa.binary())], ["bucket", "batch", "h"])

    def compare(it):
        for _, rows in _groups(_rows(it, "bucket", "batch", "h")):
            h = np.concatenate([np.frombuffer(x, np.uint64) for _, x in rows])
            u, inv, count = np.unique(h >> np.uint64(1), return_inverse=True, return_counts=True)
            shared = (count > 1) | (np.bincount(inv, h & np.uint64(1), len(u)) > 0)
            out, i = [], 0
            for number, x in rows:
                mine = inv[i:i + len(x) // 8]
                i += len(mine)
                mine = np.sort(mine[shared[mine]])
                if len(mine):
                    out.append((number, (u[mine] * np.uint64(2) + (count[mine] > hot_batches)).tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([x for _, x in out], pa.binary())], ["batch", "h"])

    sent = batches.select("batch", "run_hash").mapInArrow(send, "bucket int, batch long, h binary")
    back = sent.repartition(n, "bucket").sortWithinPartitions("bucket", "batch").mapInArrow(compare, "batch long, h binary")
    return back.groupBy("batch").agg(F.collect_list("h").alias("shared"))


def segments(batches: DataFrame, shared: DataFrame) -> DataFrame:
    """Rows by (batch, shard): shard >= 0 has the batch's distinct segments for it and their earliest places;
    shard -1 the batch's documents that have any, and where their segments are. Written."""
    shared = C.written(shared, "shared")
    total = shared.agg(F.coalesce(F.sum(F.aggregate("shared", F.lit(0).cast("long"), lambda a, x: a + F.length(x))), F.lit(0))).first()[0] // 8
    n = max(int(batches.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // SHARD_RUNS))

    def cut(it):
        for row in _rows(it, "batch", "ids", "sizes", "texts", "run_doc", "run_start", "run_size", "run_hash", "shared"):
            number, ids, sizes, least = row[0], np.frombuffer(row[1], np.int64), np.frombuffer(row[2], np.int64), np.frombuffer(row[7], np.uint64)
            known = np.sort(np.concatenate([np.frombuffer(x, np.uint64) for x in row[8]]))
            key = least >> np.uint64(1)
            at = np.minimum(np.searchsorted(known >> np.uint64(1), key), len(known) - 1)
            kept = np.flatnonzero(known[at] >> np.uint64(1) == key)
            hot = (known[at[kept]] & np.uint64(1)).astype(bool)
            doc, start, size = (_unpack(x, k)[kept] for x, k in zip(row[4:7], (np.int32, np.int32, np.uint8)))
            shard = (mixed(key[kept] + np.uint64(7)) % np.uint64(n)).astype(np.int64)
            raw, end = _unpack(row[3]), np.cumsum(sizes)
            order = np.lexsort((start, doc, ids[doc]))  # the first place met of a segment is its earliest
            held, found, texts, last = {}, [], [], None  # shard -> {segment: (number, id, start)}
            for r in order:
                d = int(doc[r])
                if d != last:
                    last, text = d, raw[end[d] - sizes[d]:end[d]]
                    words = text.split()
                    texts.append((d, text))
                    grams = None
                i, m = int(start[r]), int(size[r])
                if hot[r]:
                    if grams is None:
                        grams = mixed(ngrams(word_hashes(words), WINDOW)) % np.uint64(n)
                    parts = [(int(grams[j]), j, 1) for j in range(i, i + m)]
                else:
                    parts = [(int(shard[r]), i, m)]
                for s, j, m in parts:
                    mine = held.setdefault(s, {})
                    place = mine.setdefault(b" ".join(words[j:j + m + WINDOW - 1]), (len(mine), int(ids[d]), j))
                    found.append((len(texts) - 1, j, m, s, place[0]))
            if not found:
                continue
            out = [{"batch": number, "shard": -1, "a": _pack(np.array(found, np.int64).T.copy(), np.int64), "b": _pack([d for d, _ in texts], np.int64),
                    "c": _pack([len(t) for _, t in texts], np.int64), "d": _pack(b"".join(t for _, t in texts)), "ids": ids[[d for d, _ in texts]].tobytes()}]
            for s, mine in held.items():
                out.append({"batch": number, "shard": s, "a": _pack([x[1] for x in mine.values()], np.int64), "b": _pack([x[2] for x in mine.values()], np.int64),
                            "c": b"", "d": _pack(b"\n".join(mine)), "ids": b""})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("batch", pa.int64()), ("shard", pa.int32()), *[(x, pa.binary()) for x in ("a", "b", "c", "d", "ids")]]))

    b = batches.select("batch", "ids", "sizes", "texts", "run_doc", "run_start", "run_size", "run_hash").join(shared, "batch")
    return C.written(b.mapInArrow(cut, "batch long, shard int, a binary, b binary, c binary, d binary, ids binary"), "segments")


def earliest(parts: DataFrame) -> DataFrame:
    """(batch, shard, ids, starts): for each window of each segment that the batch sent to the shard, the
    earliest place of the corpus that it starts at."""

    def index(it):
        for shard, rows in _groups(_rows(it, "shard", "batch", "a", "b", "d")):
            vocabulary, seen, sent = {}, {}, []
            symbols, doc, start = [], [], []
            for number, a, b, d in rows:
                mine = []
                for text, i, j in zip(_unpack(d).split(b"\n"), _unpack(a, np.int64).tolist(), _unpack(b, np.int64).tolist()):
                    g = seen.get(text)
                    if g is None:
                        g = seen[text] = len(seen)
                        symbols.append(np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in text.split(b" ")], np.int32))
                        doc.append(i), start.append(j)
                    elif (i, j) < (doc[g], start[g]):
                        doc[g], start[g] = i, j
                    mine.append(g)
                sent.append((number, np.array(mine)))
            del seen
            lengths = np.array([len(x) for x in symbols])
            flat = np.concatenate(symbols).astype(np.int64)
            fm = FMIndex(flat, lengths, WINDOW)
            lo, hi = fm.search(flat, lengths)
            at = np.flatnonzero(hi > lo)  # one for each window, segment by segment
            begin = np.cumsum(lengths) - lengths
            segment = np.repeat(np.arange(len(lengths)), lengths)[at]
            d, s = np.array(doc)[segment], np.array(start)[segment] + at - begin[segment]
            order = np.lexsort((s, d))
            first = np.full(fm.size + 1, len(at), np.int64)
            np.minimum.at(first, lo[at[order]], np.arange(len(at)))  # the interval's smallest place
            best = order[first[lo[at]]]
            d, s = d[best], s[best]
            windows = lengths - WINDOW + 1
            base = np.cumsum(windows) - windows
            for number, mine in sent:
                n = windows[mine]
                pick = np.arange(n.sum()) + np.repeat(base[mine] - (np.cumsum(n) - n), n)
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([shard], pa.int32()), pa.array([_pack(n, np.uint8)], pa.binary()),
                                                  pa.array([_pack(d[pick], np.int64)], pa.binary()), pa.array([_pack(s[pick], np.int64)], pa.binary())],
                                                 ["batch", "shard", "n", "d", "s"])

    shards = parts.where("shard >= 0").select("shard", "batch", "a", "b", "d").repartition("shard").sortWithinPartitions("shard", "batch")
    return shards.mapInArrow(index, "batch long, shard int, n binary, d binary, s binary")


def removed(parts: DataFrame, places: DataFrame) -> DataFrame:
    """(batch, i, n_removed, digest, spans) of documents that lose words: their place in the batch, words
    removed, digest of the words kept, and the stretches removed (start and length in words)."""

    def apply(it):
        for number, a, b, c, d, ids, found in _rows(it, "batch", "a", "b", "c", "d", "ids", "found"):
            doc, start, size, shard, segment = _unpack(a, np.int64).reshape(5, -1)
            which, sizes, raw, ids = _unpack(b, np.int64), _unpack(c, np.int64), _unpack(d), np.frombuffer(ids, np.int64)
            gone = {}
            for x in found:
                at = np.flatnonzero(shard == x["shard"])
                n = _unpack(x["n"], np.uint8).astype(np.int64)
                first_id, first_start = _unpack(x["d"], np.int64), _unpack(x["s"], np.int64)
                base = (np.cumsum(n) - n)[segment[at]]
                m = size[at]
                o = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
                pick, place, owner = np.repeat(base, m) + o, np.repeat(start[at], m) + o, np.repeat(doc[at], m)
                mine = ids[owner]
                early = (first_id[pick] < mine) | ((first_id[pick] == mine) & (first_start[pick] < place) & (mine != LAST))
                for k in np.unique(owner[early]):
                    gone.setdefault(int(k), []).append(place[early & (owner == k)])
            out, end = [], np.cumsum(sizes)
            for k, places in gone.items():
                words = raw[end[k] - sizes[k]:end[k]].split()
                edge = np.zeros(len(words) + 1, np.int64)
                p = np.unique(np.concatenate(places))
                edge[p] += 1
                edge[p + WINDOW] -= 1
                cover = np.cumsum(edge[:-1]) > 0
                left = b" ".join([w for w, x in zip(words, cover.tolist()) if not x])
                turn = np.flatnonzero(np.diff(np.concatenate([[False], cover, [False]])))
                out.append({"batch": number, "i": int(which[k]), "n_removed": int(cover.sum()), "digest": hashlib.sha256(left).hexdigest(),
                            "spans": [{"start": int(i), "length": int(j - i)} for i, j in zip(turn[::2], turn[1::2])]})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("batch", pa.int64()), ("i", pa.int64()), ("n_removed", pa.int64()), ("digest", pa.string()),
                                                                        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())])))]))

    mine = parts.where("shard < 0").drop("shard")
    back = places.groupBy("batch").agg(F.collect_list(F.struct("shard", "n", "d", "s")).alias("found"))
    return mine.join(back, "batch").mapInArrow(apply, "batch long, i long, n_removed long, digest string, spans array<struct<start:long,length:long>>")


def deduplicate(docs: DataFrame, batch_chars: int = BATCH_CHARS, hot_batches: int = HOT_BATCHES) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, spans), one row a document of ``docs`` (doc_id, text)."""
    batches = document_batches(docs, batch_chars)
    parts = segments(batches, shared_hashes(batches, hot_batches))
    changed = removed(parts, earliest(parts))

    def unpack(it):
        for number, ids, has, n, digests in _rows(it, "batch", "ids", "has", "n_words", "digests"):
            n = np.frombuffer(n, np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array([number] * len(n), pa.int64()), pa.array(np.arange(len(n))), pa.array(np.frombuffer(ids, np.int64), mask=np.frombuffer(has, np.uint8) == 0),
                pa.array(n), pa.array([digests[i:i + 32].hex() for i in range(0, len(digests), 32)])], ["batch", "i", "doc_id", "n_words", "whole"])

    rows = batches.select("batch", "ids", "has", "n_words", "digests").mapInArrow(unpack, "batch long, i long, doc_id long, n_words long, whole string")
    return rows.join(changed, ["batch", "i"], "left").select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("digest", "whole").alias("kept_sha256"),
        F.coalesce("spans", F.array().cast("array<struct<start:long,length:long>>")).alias("spans"))


def op3_query(spark, sf_dir):
    return deduplicate(C.read(spark, sf_dir, "documents").select("doc_id", "text")).drop("spans")


OP3_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
v AS (SELECT r, coalesce(doc_id, 9223372036854775807) AS o, doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS h
      FROM (SELECT *, unnest(range(1, len(w) - 18)) AS i FROM d)),
f AS (SELECT h, min((o, i)) AS first FROM v GROUP BY h),
c AS (SELECT DISTINCT r, unnest(range(i, i + 20)) AS p FROM v JOIN f USING (h)
      WHERE first[1] < o OR (first[1] = o AND first[2] < i AND doc_id IS NOT NULL)),
u AS (SELECT d.r, count(c.p) AS n_removed, sha256(coalesce(string_agg(x, ' ' ORDER BY p0) FILTER (c.p IS NULL), '')) AS kept_sha256
      FROM (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p0 FROM d) d LEFT JOIN c ON c.r = d.r AND c.p = p0 GROUP BY d.r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(kept_sha256, sha256('')) AS kept_sha256
FROM d LEFT JOIN u USING (r)
"""
