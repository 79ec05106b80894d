"""Structured Streaming jobs over file sources; each runs until the available input is used up."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..plans.ingest import ingest_documents
from ..session import work_folder
from ..sources.datasets import DatasetStore


def file_stream(spark: SparkSession, folder: str, schema, *, pattern: str | None = None, files_per_batch: int = 64) -> DataFrame:
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return (reader.option("pathGlobFilter", pattern) if pattern else reader).parquet(folder)


def event_time(df: DataFrame, column: str, delay: str) -> DataFrame:
    """Zone-less timestamps cannot carry a watermark, so they are read as UTC first."""
    return df.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, delay)


def run_to_table(stream: DataFrame, purpose: str, *, folder: str | None = None) -> DataFrame:
    """Run a stream over all available input into a Parquet table and read that table.

    With a ``folder`` of your own, table and progress live there and a later run goes on where this
    one ended.
    """
    spark = stream.sparkSession
    base = folder or work_folder(spark, purpose)
    out, log = f"{base}/table", f"{base}/progress"
    stream.writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", log).trigger(
        availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def ingest_stream(docs: DataFrame, store: DatasetStore, *, progress: str | None = None, **options) -> None:
    """Append arriving documents to a dataset; a repeated batch or document adds nothing.

    With a ``progress`` folder a later run only reads files that are new since.
    """
    log = progress or work_folder(docs.sparkSession, "ingest-progress")
    docs.writeStream.foreachBatch(lambda batch, _: ingest_documents(store, batch, **options)).option(
        "checkpointLocation", log).trigger(availableNow=True).start().awaitTermination()


STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


BLOCK_PIECES = 128  # of consecutive numbers in one entry of the state


class ReplyAssembler(StatefulProcessor):
    """State of one request: its pieces in blocks of ``BLOCK_PIECES`` consecutive numbers, one entry each, and how many are there.

    The pieces of a micro-batch read and write the blocks they fall into once, however many they are, and never the
    reply so far. A reply that is whole leaves a done mark until its timer fires, so pieces repeated after
    the last one start nothing new. The timer stands at the newest piece plus the timeout and is the state's time to
    live: nothing stays behind it. Rows are (request_id, piece_no, n_pieces, piece, sent_at).
    """

    def __init__(self, timeout_ms: int):
        self.timeout_ms = timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.blocks = handle.getMapState("blocks", "block int", "numbers array<int>, pieces array<string>")
        self.progress = handle.getValueState("progress", "known int, wanted int, done boolean, timer long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known, wanted, done, timer = self.progress.get() if self.progress.exists() else (0, 0, False, 0)
        newest, arrived = None, {}
        for _, number, n_pieces, piece, sent_at in rows:
            if newest is None or sent_at > newest:
                newest = sent_at
            wanted = max(wanted, n_pieces)
            if not done:
                arrived.setdefault(None if number is None else number // BLOCK_PIECES, {})[number] = piece
        newest = max(0, int(newest.timestamp() * 1000))
        for block, pieces in arrived.items():
            stored = dict(zip(*self.blocks.getValue((block,)), strict=True)) if known and self.blocks.containsKey((block,)) else {}
            merged = {**stored, **pieces}
            known += len(merged) - len(stored)
            self.blocks.updateValue((block,), (list(merged), list(merged.values())))
        whole = not done and known >= wanted
        if whole:
            yield self._reply(key, True)
            self.blocks.clear()
        due = max(timer, newest, timerValues.getCurrentWatermarkInMs()) + (self.timeout_ms if newest > timer - self.timeout_ms else 0)
        if due != timer:
            if timer:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(due)
        self.progress.update((known, wanted, done or whole, due))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.progress.get()[2]:
            yield self._reply(key, False)
        self.blocks.clear()
        self.progress.clear()

    def _reply(self, key, complete: bool) -> Row:
        in_order = sorted(pair for _, block in self.blocks.iterator() for pair in zip(*block, strict=True))
        return Row(request_id=key[0], text="".join(piece for _, piece in in_order), complete=complete)

    def close(self) -> None:
        pass


def assemble_replies(pieces: DataFrame, timeout_ms: int = 600_000) -> DataFrame:
    """Join the pieces (request_id, piece_no, n_pieces, piece, sent_at) of each reply in piece order.

    A reply is emitted once, when its last missing piece arrives, or incomplete once the watermark on
    ``sent_at`` has passed its newest piece by the timeout. A processing-time timeout would keep an
    available-now run going, so timers follow the event time. Map state needs the RocksDB state store,
    which is set for the session when nothing else was.
    """
    conf = pieces.sparkSession.conf
    if "RocksDB" not in conf.get("spark.sql.streaming.stateStore.providerClass", ""):
        conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    return pieces.select("request_id", "piece_no", "n_pieces", "piece", "sent_at").groupBy("request_id").transformWithState(
        ReplyAssembler(timeout_ms), "request_id string, text string, complete boolean", "Append", "EventTime")


def attach_late_feedback(messages: DataFrame, feedback: DataFrame, interval: str = "15 minutes") -> DataFrame:
    """Feedback (request_id, fb_ts, feedback) joined to messages (request_id, ts) when it comes in time.

    Both sides carry watermarks, so state older than the interval is dropped. Request ids are unique
    per message, which keeps the join keys spread out.
    """
    m, f = messages.alias("m"), feedback.alias("f")
    in_time = F.col("f.fb_ts").between(F.col("m.ts"), F.col("m.ts") + F.expr(f"interval {interval}"))
    return m.join(f, (F.col("m.request_id") == F.col("f.request_id")) & in_time).select(
        "m.request_id", "m.ts", "f.fb_ts", "f.feedback")


def messages_with_feedback(messages: DataFrame, feedback: DataFrame, interval: str = "15 minutes") -> DataFrame:
    """Every message with each feedback that comes in time, and once without when none can come any more.

    A message without feedback leaves when the watermark of both sides has passed its interval; it is
    never emitted before and not emitted when feedback came.
    """
    m, f = messages.alias("m"), feedback.alias("f")
    in_time = F.col("f.fb_ts").between(F.col("m.ts"), F.col("m.ts") + F.expr(f"interval {interval}"))
    return m.join(f, (F.col("m.request_id") == F.col("f.request_id")) & in_time, "left_outer").select(
        "m.request_id", "m.ts", "f.fb_ts", "f.feedback")


def latest_feedback(joined: DataFrame) -> DataFrame:
    """One row per message: later feedback replaces earlier feedback of the same id."""
    last = F.max(F.struct("fb_ts", "feedback"))
    return joined.groupBy("request_id", "ts").agg(last.alias("last")).select("request_id", "ts", "last.fb_ts", "last.feedback")


def first_per_interval(df: DataFrame, key: str, ts: str, payload: Column, duration: str) -> DataFrame:
    """First event of each key per tumbling interval; batch or stream. Tasks pre-aggregate."""
    return df.groupBy(key, F.window(ts, duration)).agg(F.min(F.struct(F.col(ts).alias("ts"), payload.alias("payload"))).alias("first")
                                                       ).select(key, F.col("window.start").alias("window_start"), "first.ts", "first.payload")


def sessions(df: DataFrame, key: str, ts: str, gap: str) -> DataFrame:
    """Sessions of activity closed by a gap; batch or stream.

    ``build_session`` has sessions merged on the map side first, so a busy key sends sessions through
    the shuffle instead of all its events.
    """
    return df.groupBy(key, F.session_window(ts, gap).alias("s")).agg(F.count(F.lit(1)).alias("n_events")).select(
        key, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "n_events")
