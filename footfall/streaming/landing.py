"""Land a message stream as batch files."""

from __future__ import annotations

from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from footfall.schemas import LONG, RAW, columns, conform


def land_batches(
    events: DataFrame, path: str, checkpoint: str, fmt: str = "csv", every: str | None = "10 seconds"
) -> StreamingQuery:
    """Append decoded events to files, five columns without a header, each exactly once.

    The size of a batch is set at the source (offsets or files per trigger); ``every`` is the
    longest a partial batch waits. ``every=None`` works off what is there and stops.
    """
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        conform(events, RAW)
        .writeStream.format(fmt)
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


_COUNTERS = columns(files=LONG, rows=LONG, open_rows=LONG)
#: The bits of a monotonically increasing id that number the rows of a partition.
_ROW_BITS = (1 << 33) - 1
#: Files that one task writes; a small file costs its creation, not its bytes.
_FILES_A_TASK = 32


class LimitReached(Exception):
    """Ends a query whose writer takes no more rows."""


class NumberedFiles:
    """Writes a stream's rows as numbered CSV files of at most ``file_rows`` rows each.

    A file is a folder ``batch=N`` with one file in it. Full files are written as soon as their
    rows have come; the rest stays open and goes before the rows of the next micro-batch.
    :meth:`flush` closes it as a last, shorter file. With ``max_rows`` the writer takes exactly so
    many rows in total, over all restarts, and is ``full`` from then on: the micro-batch that
    reaches the limit is cut, the one after it ends the query and stays unread.

    What a micro-batch leaves (files, rows and open rows so far) is kept beside the stream's
    checkpoint under the number of the batch and read by the batch after it, so a batch that is
    repeated after a failure finds what it found before and writes the same files again.
    """

    def __init__(self, path: str, checkpoint: str, file_rows: int, max_rows: int | None = None):
        if file_rows < 1:
            raise ValueError("file_rows must be positive")
        self.path, self.state = path.rstrip("/"), f"{checkpoint.rstrip('/')}/numbered"
        self.file_rows, self.max_rows = file_rows, max_rows
        self.last: int | None = None
        self.full = False

    def resume(self, spark: SparkSession) -> None:
        """Find out what earlier runs have left."""
        try:
            kept = spark.read.schema(columns(rows=LONG, batch=LONG)).json(f"{self.state}/counters")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return
        self.last, rows = kept.agg(F.max("batch"), F.max("rows")).first()
        self.full = self.max_rows is not None and rows >= self.max_rows

    def _counters(self, spark: SparkSession, number: int) -> tuple[int, int, int]:
        if number < 0:
            return 0, 0, 0
        return tuple(spark.read.schema(_COUNTERS).json(f"{self.state}/counters/batch={number}").first())

    def _keep(self, spark: SparkSession, number: int, counters: tuple[int, int, int]) -> None:
        rows = spark.createDataFrame([counters], _COUNTERS)
        rows.coalesce(1).write.mode("overwrite").json(f"{self.state}/counters/batch={number}")

    def _open(self, spark: SparkSession, number: int) -> DataFrame:
        return spark.read.schema(RAW).parquet(f"{self.state}/open/{number}")

    def _write_files(self, rows: DataFrame, files: int) -> None:
        # All rows of a file meet in one task, so each folder gets one file. The number of tasks is
        # given, as adaptive execution would merge so few bytes into one task, whatever the files.
        tasks = -(-files // _FILES_A_TASK)
        writer = rows.repartition(tasks, "batch").write.partitionBy("batch").mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").csv(self.path)

    def write(self, batch: DataFrame, number: int) -> None:
        """Take the rows of a micro-batch; the function of ``foreachBatch``."""
        spark = batch.sparkSession
        files, taken, waiting = self._counters(spark, number - 1)
        if self.max_rows is not None and taken >= self.max_rows:
            self.full = True
            raise LimitReached(f"{taken} rows have been taken")
        rows = conform(batch, RAW).withColumn("new", F.lit(True))
        if waiting:
            before = self._open(spark, number - 1).withColumn("new", F.lit(False))
            rows = before.unionByName(rows)
        # rows keep the place they are written with: their task, and their number within it
        step = F.monotonically_increasing_id()
        staged = f"{self.state}/staged/{number}"
        rows.withColumns(
            {"task": F.shiftright(step, 33), "at": step.bitwiseAND(F.lit(_ROW_BITS))}
        ).write.mode("overwrite").parquet(staged)
        rows = spark.read.parquet(staged)

        tasks = rows.groupBy("new", "task").agg(F.count("*").alias("n"))
        before = F.sum("n").over(Window.orderBy("new", "task")) - F.col("n")  # a row per task
        rows = rows.join(tasks.withColumn("first", before), ["new", "task"])
        total = rows.count()
        if self.max_rows is not None:
            total = waiting + min(total - waiting, self.max_rows - taken)
        done = total // self.file_rows
        place = F.col("first") + F.col("at")
        rows = rows.filter(place < total).select(
            *RAW.names, (F.lit(files + 1) + F.floor(place / self.file_rows)).alias("batch")
        )
        if done:
            self._write_files(rows.filter(F.col("batch") <= files + done), done)
        left = rows.filter(F.col("batch") > files + done).drop("batch")
        left.write.mode("overwrite").parquet(f"{self.state}/open/{number}")
        counters = (files + done, taken + total - waiting, total - done * self.file_rows)
        self._keep(spark, number, counters)
        self.last = number
        self.full = self.max_rows is not None and counters[1] >= self.max_rows

    def flush(self, spark: SparkSession) -> None:
        """Close the open rows as a file; does nothing if there are none or no batch has run."""
        if self.last is None:
            return
        files, taken, waiting = self._counters(spark, self.last)
        if waiting:
            self._write_files(self._open(spark, self.last).withColumn("batch", F.lit(files + 1)), 1)
            self._keep(spark, self.last, (files + 1, taken, 0))


def land_numbered(
    events: DataFrame,
    path: str,
    checkpoint: str,
    file_rows: int,
    max_rows: int | None = None,
    every: str | None = "10 seconds",
) -> tuple[StreamingQuery, NumberedFiles]:
    """Land decoded events as numbered files of at most ``file_rows`` rows.

    Hand both results to :func:`finish_landing`, which ends the query when ``max_rows`` rows have
    been taken and closes the last file. ``every=None`` works off what is there and stops.
    """
    files = NumberedFiles(path, checkpoint, file_rows, max_rows)
    files.resume(events.sparkSession)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    query = (
        conform(events, RAW)
        .writeStream.foreachBatch(files.write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
    return query, files


def finish_landing(query: StreamingQuery, files: NumberedFiles, poll_seconds: float = 0.5) -> None:
    """Wait until the query ends, the limit is reached or the keyboard interrupts; then flush."""
    try:
        while not query.awaitTermination(poll_seconds):
            if files.full and not query.status["isTriggerActive"]:
                query.stop()
    except KeyboardInterrupt:
        query.stop()
    except StreamingQueryException:
        if not files.full:
            raise
    files.flush(SparkSession.active())


def read_numbered(spark: SparkSession, path: str) -> DataFrame:
    """The rows of numbered files, with ``batch``, the number of their file."""
    with_number = columns(**{f.name: f.dataType for f in RAW}, batch=LONG)
    return spark.read.option("header", False).schema(with_number).csv(path)
