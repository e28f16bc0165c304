"""Token ids as compressed binary shards with a shared zstandard dictionary.

``write_tokens`` range-sorts documents by id, encodes every whole text with a public tokenizer, appends
the end id and writes one shard a partition. In a shard each document is a zstandard frame of its own,
compressed with a dictionary trained on serialized id arrays, so that a short document is read and
unpacked alone and still compresses well. Layout of ``shard-NNNNNN.tkz`` (little-endian):

    magic 8 bytes | frames, one a document | index | footer (JSON) | footer length u4 | magic 8 bytes
    index: doc_id i8, has_id u1, offset u8, length u8, n_tokens u8, each one array over all documents
    footer: n_docs, n_tokens, index_offset, dtype of ids, end id, tokenizer name, SHA-256 of the dictionary

Beside the shards lie the dictionary and a manifest table (one row a shard). A shard is written under a
name of its attempt and then moved in place, so a task that runs again leaves the same files.

The dictionary is fitted on a bounded sample (``sample_docs`` texts of up to ``sample_chars`` characters,
chosen by a hash of the id); it only affects sizes. Texts are encoded word by word between spaces, as the
tokenizer's rules never look across a space.

Defined results: a null text counts as empty and holds the end id alone; a null id comes first; rows with
one id are ordered by a hash of their text, so copies are interchangeable; an empty table gives an empty
manifest and no rows. Only ``doc_id`` and ``text`` are read, whatever other columns there are.
"""

from __future__ import annotations

import hashlib
import json
import struct
import sys
import uuid
import zlib
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarmac.llm import common as C

MAGIC = b"TKZSHRD1"
INDEX = [("doc_id", "<i8"), ("has_id", "u1"), ("offset", "<u8"), ("length", "<u8"), ("n_tokens", "<u8")]
MANIFEST = "shard int, file string, n_docs long, n_tokens long, min_id long, max_id long, bytes long"
CACHE_WORDS, HOT_WORDS, FIRST_WORDS = 600_000, 16_384, 400_000
MARKS = ".,;:!?&$%#@*+=~^/-"  # ASCII marks that begin no special token and no contraction


#: The characters that byte-level vocabularies write bytes as: printable Latin-1 bytes as they are, the others
#: as the characters from U+0100 on, in order.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_CHARACTERS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}


class Encoder:
    """Whole texts to serialized ids with the end id.

    Words between spaces are encoded once and kept as bytes: the ``HOT_WORDS`` most frequent of the first texts
    in a small table, others in two generations of at most ``CACHE_WORDS``: a full new one becomes the
    old one, and words found in the old one move on. A word of Latin letters alone
    (up to U+017F, where normal forms and lower case are plain) is one piece to the tokenizer, so its model
    gets the piece directly: the lower-cased bytes, each as its character in byte-level vocabularies.
    """

    def __init__(self, tokenizer_path: str, end_id: int, dtype: str):
        from tokenizers import Tokenizer

        self.tokenizer, self.dtype = Tokenizer.from_file(tokenizer_path), np.dtype(dtype)
        self.code, self.tokenize = {2: "H", 4: "I"}[self.dtype.itemsize], self.tokenizer.model.tokenize
        self.end, self.new, self.old, self.hot, self.first = self.pack([end_id]), {}, {}, {}, Counter()

    def pack(self, ids: list[int]) -> bytes:
        ids = array(self.code, ids)
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def word(self, word: str) -> bytes:
        ids = self.new.get(word)
        if ids is not None:
            return ids
        ids = self.old.get(word)
        if ids is None:
            if word.isalpha() and len(word) < 64 and (word.isascii() or max(word) <= "\u017f" and "\u0130" not in word):
                piece = word.lower()
                if not word.isascii():
                    piece = piece.encode().decode("latin-1").translate(BYTE_CHARACTERS)
                ids = self.pack([t.id for t in self.tokenize(piece)])
            elif (n := len(stem := word.rstrip(MARKS))) < len(word) and n and stem[-1].isalpha() and stem[-1] <= "\u017f" and stem[-1] != "\u0130":
                ids = self.word(stem) + self.word(word[n:])  # marks after a letter are a piece of their own
            else:
                ids = self.pack(self.tokenizer.encode(word, add_special_tokens=False).ids)
        if len(word) < 64:
            if len(self.new) >= CACHE_WORDS:
                self.old, self.new = self.new, {}  # the caller's ``known`` is then the old one, as good
            self.new[word] = ids
        return ids

    def __call__(self, text: str | None) -> bytes:
        words = (text or "").replace("\n", " ").split(" ")
        if self.first is not None:
            self.first.update(words)
            if self.first.total() > FIRST_WORDS:
                self.hot = {w: self.word(w) for w, _ in self.first.most_common(HOT_WORDS)}
                self.first = None
        found = list(map(self.hot.get, words))
        i, known = -1, self.new.get
        for _ in range(found.count(None)):
            i = found.index(None, i + 1)
            ids = known(words[i])
            found[i] = self.word(words[i]) if ids is None else ids
        found.append(self.end)
        return b"".join(found)


def encoder(tokenizer_path: str, end_id: int, dtype: str) -> Encoder:
    """One for each Python worker, so that its tasks share the words met so far."""
    key = (tokenizer_path, end_id, dtype)
    return C.worker_cache(key, lambda: Encoder(*key))


def vocabulary_dtype(tokenizer_path: str, end_id: int) -> str:
    from tokenizers import Tokenizer

    return "<u2" if max(Tokenizer.from_file(tokenizer_path).get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"


def train_dictionary(docs: DataFrame, tokenizer_path: str, end_id: int, dtype: str, sample_docs: int = 400,
                     sample_chars: int = 8_000, size: int = 32_768) -> bytes:
    """A dictionary from at most ``sample_docs`` texts of at most ``sample_chars`` characters; empty where
    there is too little to learn from."""
    import zstandard as zstd

    h = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    few = docs.where((h <= int((1 << 30) * min(1.0, 4 * sample_docs / max(1, docs.count())))) & (F.length("text") <= sample_chars))
    encode = encoder(tokenizer_path, end_id, dtype)
    rows = few.select("text").orderBy(h, F.xxhash64("text")).limit(sample_docs).collect()
    samples = [encode(r.text) for r in rows]
    try:
        return zstd.train_dictionary(size, samples).as_bytes()
    except (zstd.ZstdError, ValueError):
        return b""


def _codec(dictionary: bytes, level: int | None = None):
    import zstandard as zstd

    d = {"dict_data": zstd.ZstdCompressionDict(dictionary)} if dictionary else {}
    return zstd.ZstdCompressor(level=level, **d) if level is not None else zstd.ZstdDecompressor(**d)


def write_tokens(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 1, level: int = 1, order: list[str] | None = None) -> DataFrame:
    """Write shards of ``docs`` (doc_id, text) below ``folder``, a path that driver and executors share, in
    ascending order of doc_id or of the columns ``order``; returns the manifest as read back."""
    spark = docs.sparkSession
    by = [F.col(c).alias(f"by{i}") for i, c in enumerate(order or [])]
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *by)
    by = [f"by{i}" for i in range(len(by))] or ["doc_id", F.xxhash64("text")]
    dtype = vocabulary_dtype(tokenizer_path, end_id)
    dictionary = train_dictionary(docs, tokenizer_path, end_id, dtype)
    sha = hashlib.sha256(dictionary).hexdigest()
    files, base = C.files(folder)
    files.create_dir(base, recursive=True)
    with files.open_output_stream(f"{base}/dictionary.zdict") as f:
        f.write(dictionary)
    ordered = docs.repartitionByRange(*by).sortWithinPartitions(*by).select("doc_id", "text")
    name = tokenizer_path.rsplit("/", 1)[-1]

    def shard(batches):
        from pyspark import TaskContext

        files, base = C.files(folder)
        encode, pack, width = encoder(tokenizer_path, end_id, dtype), _codec(dictionary, level), np.dtype(dtype).itemsize
        part, out, index, at, tokens = TaskContext.get().partitionId(), None, [], len(MAGIC), 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if out is None:
                    attempt = f"{base}/.{part}-{uuid.uuid4().hex}"
                    out = files.open_output_stream(attempt)
                    out.write(MAGIC)
                ids = encode(text.as_py())
                frame, n = pack.compress(ids), len(ids) // width
                out.write(frame)
                index.append((doc_id or 0, doc_id is not None, at, len(frame), n))
                at, tokens = at + len(frame), tokens + n
        if out is not None:
            for (_, kind), column in zip(INDEX, zip(*index)):
                out.write(np.array(column, kind).tobytes())
            footer = json.dumps({"n_docs": len(index), "n_tokens": tokens, "index_offset": at, "dtype": dtype, "end_id": end_id,
                                 "tokenizer": name, "dictionary_sha256": sha}).encode()
            out.write(footer + struct.pack("<I", len(footer)) + MAGIC)
            size = out.tell()
            out.close()
            files.move(attempt, f"{base}/shard-{part:06d}.tkz")
            ids = [x[0] for x in index if x[1]]
            yield pa.RecordBatch.from_pylist([{"shard": part, "file": f"shard-{part:06d}.tkz", "n_docs": len(index), "n_tokens": tokens,
                                               "min_id": min(ids, default=None), "max_id": max(ids, default=None), "bytes": size}], schema=ARROW_MANIFEST)

    ordered.mapInArrow(shard, MANIFEST).write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


ARROW_MANIFEST = pa.schema([("shard", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()),
                            ("min_id", pa.int64()), ("max_id", pa.int64()), ("bytes", pa.int64())])


def open_shard(files, path: str, dictionary: bytes):
    """(open file, footer, index arrays) of a shard; the dictionary must be the one it was written with."""
    f = files.open_input_file(path)
    f.seek(f.size() - 12)
    n, magic = struct.unpack("<I8s", f.read(12))
    f.seek(f.size() - 12 - n)
    footer = json.loads(f.read(n))
    if magic != MAGIC or footer["dictionary_sha256"] != hashlib.sha256(dictionary).hexdigest():
        raise ValueError(f"{path}: not a shard of this dictionary")
    f.seek(footer["index_offset"])
    index = {k: np.frombuffer(f.read(np.dtype(kind).itemsize * footer["n_docs"]), kind) for k, kind in INDEX}
    return f, footer, index


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = True, chunk: int = 4 << 20) -> DataFrame:
    """Documents of the shards: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (of the
    ids as little-endian unsigned 32-bit integers) and, if asked for, ids. Reads ``chunk`` bytes at a time."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row a shard
    m = manifest.select("file", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("start"))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    kinds = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
                      + [("ids", pa.list_(pa.int32()))] * with_ids)

    def documents(batches):
        files, base = C.files(folder)
        with files.open_input_stream(f"{base}/dictionary.zdict") as f:
            dictionary = f.read()
        unpack = _codec(dictionary)
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                f, footer, x = open_shard(files, f"{base}/{name}", dictionary)
                starts = start + np.concatenate([[0], np.cumsum(x["n_tokens"].astype(np.int64))[:-1]])
                ends, i = (x["offset"] + x["length"]).astype(np.int64), 0
                while i < footer["n_docs"]:
                    first = int(x["offset"][i])
                    j = max(i + 1, int(np.searchsorted(ends, first + chunk, "right")))
                    f.seek(first)
                    raw, crc, all_ids = memoryview(f.read(int(ends[j - 1]) - first)), [], []
                    for k in range(i, j):
                        o = int(x["offset"][k]) - first
                        ids = np.frombuffer(unpack.decompress(raw[o:o + int(x["length"][k])]), footer["dtype"])
                        if len(ids) != x["n_tokens"][k]:
                            raise ValueError(f"{name}: document {k} is damaged")
                        crc.append(zlib.crc32(ids.astype("<u4").tobytes()))
                        if with_ids:
                            all_ids.append(ids.astype(np.int32))
                    columns = [pa.array(x["doc_id"][i:j], pa.int64(), mask=x["has_id"][i:j] == 0), pa.array(starts[i:j], pa.int64()),
                               pa.array(x["n_tokens"][i:j].astype(np.int64)), pa.array(crc, pa.int64())]
                    if with_ids:
                        columns.append(pa.array(all_ids, pa.list_(pa.int32())))
                    yield pa.RecordBatch.from_arrays(columns, schema=kinds)
                    i = j
                f.close()

    return m.repartition(max(1, manifest.count())).mapInArrow(documents, schema)


def read_document(spark: SparkSession, folder: str, doc_id: int) -> list[np.ndarray]:
    """Ids of the documents with this id, by the index alone: only their frames are read."""
    files, base = C.files(folder)
    with files.open_input_stream(f"{base}/dictionary.zdict") as f:
        dictionary = f.read()
    found = []
    for r in spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").where(F.lit(doc_id).between(F.col("min_id"), F.col("max_id"))).orderBy("shard").collect():
        f, footer, x = open_shard(files, f"{base}/{r.file}", dictionary)
        for k in np.flatnonzero((x["doc_id"] == doc_id) & (x["has_id"] == 1)):
            f.seek(int(x["offset"][k]))
            found.append(np.frombuffer(_codec(dictionary).decompress(f.read(int(x["length"][k]))), footer["dtype"]))
        f.close()
    return found


def op6_query(spark, sf_dir):
    import public_tokenizers

    folder = C.shared_path(spark, "tokens")
    write_tokens(C.read(spark, sf_dir, "documents").select("doc_id", "text"), folder, public_tokenizers.path("word_bpe_49k.json"))
    return read_tokens(spark, folder, with_ids=False)
