"""Application log parsing, batch and Structured Streaming (H1).

A line ``time | LEVEL | logger | message`` splits into four trimmed fields
(at most 4 parts; other lines keep the whole text as message).  The batch
form filters levels and a case-insensitive keyword over all fields and keeps
the last n lines; the streaming form reads new files as they arrive and
counts lines per level in event-time windows with a watermark.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LOG_LEVELS = ["DEBUG", "INFO", "WARNING", "ERROR", "CRITICAL"]
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss,SSS"


def parse_log_line(line: str | Column) -> Column:
    """struct<time, level, logger, message> of one line."""
    c = F.col(line) if isinstance(line, str) else line
    parts = F.split(c, r"\|", 4)
    ok = F.size(parts) == 4
    get = lambda i: F.trim(F.element_at(parts, i))
    return F.struct(
        F.when(ok, get(1)).otherwise(F.lit("")).alias("time"),
        F.when(ok, get(2)).otherwise(F.lit("")).alias("level"),
        F.when(ok, get(3)).otherwise(F.lit("")).alias("logger"),
        F.when(ok, get(4)).otherwise(c).alias("message"),
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the log files at ``path`` with ``line_no``, a struct that sorts
    as the lines stand in their files (file, block, place)."""
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("place"))
    return spark.read.text(path).select("value", place.alias("line_no"))


def parse_logs(lines: DataFrame, *, line_col: str = "value") -> DataFrame:
    """(time, level, logger, message, ts) per line, and ``line_no`` if the
    lines have one; ts parsed from time."""
    keep = ["line_no"] if "line_no" in lines.columns else []
    p = lines.select(parse_log_line(line_col).alias("p"), *keep).select("p.*", *keep)
    return p.withColumn("ts", F.try_to_timestamp(F.col("time"), F.lit(TIME_FORMAT)).cast("timestamp_ntz"))


def filter_logs(parsed: DataFrame, *, levels: Sequence[str] = (), query: str | None = None,
                last_n: int | None = None, order_col: str = "line_no") -> DataFrame:
    """The tail view: the last ``last_n`` lines in the order of ``order_col``
    (without that column: by time), of these the chosen levels and the lines
    whose fields contain ``query`` (any case).  Without ``last_n`` all lines
    are filtered."""
    out = parsed
    if last_n:
        order = [F.desc(order_col)] if order_col in parsed.columns else [F.desc("ts"), F.desc("message")]
        out = out.orderBy(*order).limit(last_n)
    if levels:
        out = out.where(F.col("level").isin(list(levels)))
    if query:
        hay = F.lower(F.concat_ws(" ", "time", "level", "logger", "message"))
        out = out.where(F.instr(hay, query.lower()) > 0)
    return out


def level_counts(parsed: DataFrame, *, window: str = "1 hour", watermark: str | None = None) -> DataFrame:
    """Lines per level per event-time window (works on batch and streams)."""
    src = parsed.where(F.col("ts").isNotNull())
    start, end = F.col("w.start"), F.col("w.end")
    if watermark:
        # event-time watermarks need TIMESTAMP (instants): use the instant whose
        # UTC reading is the logged wall-clock time, so windows fall on
        # wall-clock boundaries whatever the session time zone; batch windows
        # stay on TIMESTAMP_NTZ directly
        epoch = "timestamp_ntz'1970-01-01 00:00:00'"
        src = src.withColumn("ts", F.timestamp_micros(F.expr(f"timestampdiff(MICROSECOND, {epoch}, ts)")))
        src = src.withWatermark("ts", watermark)
        start = F.expr(f"timestampadd(MICROSECOND, unix_micros(w.start), {epoch})")
        end = F.expr(f"timestampadd(MICROSECOND, unix_micros(w.end), {epoch})")
    return src.groupBy(F.window("ts", window).alias("w"), "level").agg(F.count(F.lit(1)).alias("n")) \
        .select(start.cast("timestamp_ntz").alias("window_start"), end.cast("timestamp_ntz").alias("window_end"),
                "level", "n")


def stream_level_counts(spark: SparkSession, log_dir: str, *, window: str = "1 hour", watermark: str = "10 minutes"):
    """Streaming DataFrame: text files appearing in ``log_dir`` -> windowed
    counts per level (append mode emits a window once the watermark passes)."""
    lines = spark.readStream.format("text").load(log_dir)
    return level_counts(parse_logs(lines), window=window, watermark=watermark)


def stream_lines(spark: SparkSession, log_dir: str, *, files_per_batch: int | None = None) -> DataFrame:
    """Streaming DataFrame: lines of the files that appear in ``log_dir``, with
    the file and block they stand in."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(log_dir).select("value", F.col("_metadata.file_path").alias("file"),
                                       F.col("_metadata.file_block_start").alias("block"))


def run_tail(lines: DataFrame, path: str, checkpoint: str, *, last_n: int = 2000) -> None:
    """Keep the last ``last_n`` lines of a growing log folder.

    ``lines``: as from ``stream_lines``.  After each micro-batch the folder
    ``path``/batch=N holds the tail of all files so far, in the order of
    ``read_lines``, however late or unordered the files came: the tail of the
    batch before and the batch's own last lines, merged.  The state is that one
    tail, ``last_n`` rows; a repeated batch writes the same tail again.  Waits
    until the input is used up; the checkpoint makes it restartable.
    """
    spark = lines.sparkSession

    def keep(batch: DataFrame, epoch: int) -> None:
        place = F.struct("file", "block", F.monotonically_increasing_id().alias("place"))
        tail = filter_logs(parse_logs(batch.select("value", place.alias("line_no"))), last_n=last_n)
        if epoch:
            before = spark.read.schema(tail.schema).parquet(f"{path}/batch={epoch - 1}")
            tail = filter_logs(before.unionByName(tail), last_n=last_n)
        tail.write.mode("overwrite").parquet(f"{path}/batch={epoch}")

    q = (lines.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def latest_tail(spark: SparkSession, path: str) -> DataFrame:
    """The newest tail under ``path``; ``filter_logs`` chooses levels and words."""
    rows = spark.read.parquet(path)
    newest = rows.agg(F.max("batch")).first()[0]
    return rows.where(F.col("batch") == newest).drop("batch")


def event_line() -> Column:
    """The log line of a row of the events table: time, level from the event
    type, logger from the user, value and properties."""
    level = (F.when(F.col("event_type") == "error", "ERROR").when(F.col("event_type") == "purchase", "WARNING")
             .when(F.col("event_type") == "view", "DEBUG").otherwise("INFO"))
    return F.concat_ws(
        " | ", F.date_format("ts", TIME_FORMAT), F.rpad(level, 8, " "),
        F.rpad(F.concat(F.lit("user."), F.col("user_id").cast("string")), 20, " "),
        F.concat(F.col("event_type"), F.lit(" value="), F.floor("value").cast("string"), F.lit(" "), F.col("props")))


def lines_from_events(events: DataFrame) -> DataFrame:
    """Log lines derived from the events table (one per event)."""
    return events.select(event_line().alias("value"))


def run_to_table(stream_df: DataFrame, path: str, checkpoint: str) -> None:
    """Run a windowed count over everything available now, in update mode.

    Each micro-batch writes only the windows it changed, to a folder of its
    own (written again as a whole if the batch is repeated); ``latest_counts``
    reads the newest count per window and level.  Waits until the input is
    used up and raises if the query fails; the checkpoint makes it restartable.
    """
    def write(batch: DataFrame, epoch: int) -> None:
        batch.withColumn("epoch", F.lit(epoch)).write.mode("overwrite").parquet(f"{path}/batch={epoch}")

    q = (stream_df.writeStream.outputMode("update").foreachBatch(write)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def latest_counts(spark: SparkSession, path: str) -> DataFrame:
    """The newest count of every window and level under ``path``."""
    rows = spark.read.parquet(path)
    return rows.groupBy("window_start", "window_end", "level").agg(F.max_by("n", "epoch").alias("n"))
