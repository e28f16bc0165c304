"""Chat formatting by event-sourced reconstruction.

A log holds events (conv_id, seq, op, msg, role, text). It is partitioned by conversation and sorted by
``seq``; the fold leaves what a reader would see at the end:

    append      adds ``text`` to message ``msg`` (streamed delta); opens it if need be
    edit        replaces the text that message ``msg`` has so far
    regenerate  drops message ``msg`` and every later one as they stand; what follows builds them anew

An event lives if no later regenerate at or before its message and no later edit of its message follows.
A message is its living texts in order; its role is that of its first living event. The fold is windows and
grouped sums, so a very long conversation is sorted with spilling and no message list is held.

A message is rendered as ``<|im_start|>role\\ntext<|im_end|>\\n``, a conversation is its messages one after
another. Inside roles and texts a backslash becomes two, and each control string gets one after its first
character, so none appears; ``unescape`` drops a backslash and keeps what follows it. A line break in a role
also gets a backslash. The loss mask covers the escaped texts of assistant messages.

Defined results: a null text or role is empty; null conversation ids are one conversation; ties in ``seq``
go by message, op, role and text; an unknown op changes nothing; an empty log gives no rows.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm import common as C

#: Marks of this template and of the common ones.
CONTROLS = ["<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
START, END = "<|im_start|>", "<|im_end|>"
PIECE = re.compile(r"<\|im_start\|>((?:\\.|[^\\\n])*)\n(.*)<\|im_end\|>\n\Z", re.S)
DELTA = 256


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in CONTROLS:
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return out


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def fold(events: DataFrame) -> DataFrame:
    """(conv_id, msg, role, text): the messages that the log ends with."""
    e = events.select("conv_id", "seq", "op", F.col("msg").cast("long").alias("msg"), "role", F.coalesce("text", F.lit("")).alias("text"))
    order = ["seq", "msg", "op", "role", "text"]
    later = [F.col(c).desc() for c in order]
    rows = (Window.unboundedPreceding, -1)
    cut = F.min(F.when(F.col("op") == "regenerate", F.col("msg"))).over(Window.partitionBy("conv_id").orderBy(*later).rowsBetween(*rows))
    edited = F.max(F.col("op") == "edit").over(Window.partitionBy("conv_id", "msg").orderBy(*later).rowsBetween(*rows))
    live = e.withColumn("cut", cut).withColumn("edited", edited).where(
        F.col("op").isin("append", "edit") & (F.col("cut").isNull() | (F.col("cut") > F.col("msg"))) & ~F.coalesce("edited", F.lit(False)))
    parts = live.groupBy("conv_id", "msg").agg(F.array_sort(F.collect_list(F.struct("seq", "op", "role", "text"))).alias("p"))
    return parts.select("conv_id", "msg", F.coalesce(F.get("p", F.lit(0))["role"], F.lit("")).alias("role"),
                        F.array_join(F.transform("p", lambda x: x["text"]), "").alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, msg, piece, loss_start, loss_chars): pieces of the formatted text and, in code points of
    the piece, what is under the loss mask."""
    role = F.replace(escape(F.col("role")), F.lit("\n"), F.lit("\\\n"))
    text = escape(F.col("text"))
    head = F.concat(F.lit(START), role, F.lit("\n"))
    return messages.select("conv_id", "msg", F.concat(head, text, F.lit(END + "\n")).alias("piece"), F.length(head).alias("loss_start"),
                           F.when(F.col("role") == "assistant", F.length(text)).otherwise(F.lit(0)).alias("loss_chars"))


def format_chats(events: DataFrame, path: str) -> DataFrame:
    """Fold and render a log, write the pieces as a table at ``path`` and return it as read back."""
    out = render(fold(events))
    out.write.parquet(path)
    return events.sparkSession.read.schema(out.schema).parquet(path)


def digests(pieces: DataFrame) -> DataFrame:
    """One row a conversation, parsed back from its pieces. Pieces stream by in order; only running hashes
    are kept, whatever the length of a conversation."""

    def close(s):
        return {"conv_id": s["id"], "n_turns": s["n"], "turns_sha256": s["turns"].hexdigest(), "loss_chars": s["loss_n"],
                "loss_sha256": s["loss"].hexdigest(), "formatted_chars": s["chars"]}

    def walk(batches):
        import pyarrow as pa

        s, schema = None, pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                                     ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
        for batch in batches:
            out = []
            for conv, piece, start, n in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if s is None or s["id"] != conv:
                    if s:
                        out.append(close(s))
                    s = {"id": conv, "n": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256(), "loss_n": 0, "chars": 0}
                role, text = map(unescape, PIECE.match(piece).groups())
                s["turns"].update(f"{role}\n{text}\n".encode())
                loss = unescape(piece[start:start + n])
                s["loss"].update(loss.encode())
                s["n"], s["loss_n"], s["chars"] = s["n"] + 1, s["loss_n"] + len(loss), s["chars"] + len(piece)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
        if s:
            yield pa.RecordBatch.from_pylist([close(s)], schema=schema)

    ordered = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "msg").select(F.col("conv_id").cast("long"), "piece", "loss_start", "loss_chars")
    return ordered.mapInArrow(walk, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def table_events(rows: DataFrame, delta: int = DELTA) -> DataFrame:
    """The log of a table (conv_id, turn, role, text) as if each text had been streamed in deltas. Rows with
    the same turn stay messages of their own, by role and text."""
    r = rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    r = r.withColumn("msg", F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")).cast("long"))
    r = r.withColumn("k", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.length("text") - 1) / delta).cast("int")))))
    return r.select("conv_id", (F.col("msg") * (1 << 32) + F.col("k")).alias("seq"), F.lit("append").alias("op"), "msg", "role",
                    F.substring("text", F.col("k") * delta + 1, F.lit(delta)).alias("text"))


PROBE = "</s>[INST] ok [/INST]"


def op7_query(spark, sf_dir):
    rows = C.read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)], "conv_id long, turn long, role string, text string")
    return digests(format_chats(table_events(rows.union(probe)), C.shared_path(spark, "chats")))


_ESCAPED = "replace({}, '\\', '\\\\')"
for _c in CONTROLS:
    _ESCAPED = f"replace({_ESCAPED}, '{_c}', '{_c[0]}\\{_c[1:]}')"
OP7_SQL = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(24 + length(replace({_ESCAPED.format('role')}, chr(10), '\\' || chr(10))) + length({_ESCAPED.format('text')}))::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""
