"""Sinks (K1-K8). Files are written in parallel by default; a file count is
an option, never forced to one writer task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.sources.readers import QUOTED


def _files(df: DataFrame, files: int | None) -> DataFrame:
    return df.repartition(files) if files else df


# K1 / K4
def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", files: int | None = None,
                  compression: str = "snappy") -> None:
    _files(df, files).write.mode(mode).option("compression", compression).parquet(path)


# K2
def write_csv(df: DataFrame, path: str, header: bool = False, mode: str = "overwrite",
              files: int | None = None, quoted_lines: bool = False) -> None:
    """``quoted_lines``: cells may hold line breaks and quotes; read them back
    with the readers' option of the same name."""
    w = _files(df, files).write.mode(mode).option("header", header)
    (w.options(**QUOTED) if quoted_lines else w).csv(path)


# K3
def write_eventdate(df: DataFrame, base: str, date: str, mode: str = "overwrite",
                    fmt: str = "parquet") -> None:
    """Output under ``eventdate=YYYYMMDD``. Overwrite replaces only that
    date's partition (dynamic partition overwrite); append adds files."""
    if mode not in ("overwrite", "append"):
        raise ValueError("mode must be 'overwrite' or 'append'")
    (df.withColumn("eventdate", F.lit(date)).write.mode(mode)
       .option("partitionOverwriteMode", "dynamic").partitionBy("eventdate").format(fmt).save(base))


# K5
def stream_to_csv(df: DataFrame, path: str, checkpoint: str, partition_by: str = "date",
                  trigger: dict | None = None, query_name: str | None = None):
    """Append-mode CSV with header, partitioned by date; the checkpoint keeps
    source offsets and state so a restart resumes without re-emitting.
    The checkpoint must live outside the data directory."""
    w = (df.writeStream.outputMode("append").format("csv").option("header", True)
           .option("path", path).option("checkpointLocation", checkpoint).partitionBy(partition_by))
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


# K6
def decode_message(df: DataFrame, kind: str) -> DataFrame:
    """Message -> raw CSV line (``value``): flights carry a JSON string
    holding the line (trailing newline removed), reviews a JSON string,
    weather a JSON array of cell texts joined by commas."""
    v = F.col("value").cast("string")
    if kind in ("flights", "reviews"):
        line = F.from_json(F.concat(F.lit("["), v, F.lit("]")), "array<string>")[0]
        return df.select(F.regexp_replace(line, r"\n$", "").alias("value"))
    if kind == "weather":
        return df.select(F.array_join(F.from_json(v, "array<string>"), ",").alias("value"))
    raise ValueError("kind must be 'flights', 'reviews' or 'weather'")


def land_raw(stream: DataFrame, kind: str, path: str, checkpoint: str, trigger: dict | None = None):
    """Append decoded lines to a text directory (no header line)."""
    return (decode_message(stream, kind).writeStream.format("text").outputMode("append")
            .option("path", path).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


# K7
def to_messages(df: DataFrame, cells: list[str], key: Column | None = None, kind: str = "line") -> DataFrame:
    """Row -> message text. ``line``: key (optional) and cells joined by
    commas (unquoted, as the landing format expects), JSON-quoted with a
    trailing newline; ``reviews``: commas inside cells become blanks first;
    ``array``: JSON array of the cell texts."""
    parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in cells]
    if kind == "array":
        return df.select(F.to_json(F.array(*([key] if key is not None else []), *parts)).alias("value"))
    if kind == "reviews":
        parts = [F.regexp_replace(p, ",", " ") for p in parts]
    elif kind != "line":
        raise ValueError("kind must be 'line', 'reviews' or 'array'")
    line = F.concat(F.concat_ws(",", *([key] if key is not None else []), *parts), F.lit("\n"))
    quoted = F.to_json(F.array(line))
    return df.select(quoted.alias("_q")).select(F.expr("substring(_q, 2, length(_q) - 2)").alias("value"))


def write_messages(df: DataFrame, topic: str, options: dict[str, str]) -> None:
    """Publish ``value`` rows to a Kafka topic (needs the connector)."""
    df.write.format("kafka").options(**options).option("topic", topic).save()


# K8
def compact_partitions(spark: SparkSession, src: str, dst: str, column: str = "date",
                       rows_per_file: int = 1_000_000, fmt: str = "csv") -> None:
    """Many small files per ``column=`` partition -> few files per partition,
    in one distributed job (no per-date driver loop). Rows are counted per
    partition value first; a value gets one writer task for each
    ``rows_per_file`` rows, by a row hash, so a date holding a third of the
    data is split and its files stay of bounded size."""
    reader = spark.read.option("header", True) if fmt == "csv" else spark.read
    df = reader.format(fmt).load(src)
    files = df.groupBy(F.col(column).alias("_k")).agg(F.ceil(F.count(F.lit(1)) / rows_per_file).cast("int").alias("_files"))
    out = df.join(files, df[column].eqNullSafe(files["_k"]), "left").drop("_k")
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.col("_files"))
    out = out.withColumn("_salt", salt).repartition(column, "_salt").drop("_files", "_salt")
    w = out.write.mode("overwrite").partitionBy(column)
    (w.option("header", True) if fmt == "csv" else w).format(fmt).save(dst)
