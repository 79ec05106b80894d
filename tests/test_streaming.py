from datetime import datetime

from pyspark.sql import Row
from pyspark.sql import functions as F

from foliospark.session import work_folder
from foliospark.sources.datasets import DatasetStore
from foliospark.streaming import jobs


def test_replies_from_pieces_out_of_order(spark):
    folder = work_folder(spark, "test-pieces")
    schema = "request_id string, piece_no int, n_pieces int, piece string, sent_at timestamp"
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("piece_no"))
    for batch in ([("a", 1, 3, "el"), ("b", 0, 2, "x")], [("a", 2, 3, "lo"), ("a", 1, 3, "el")], [("a", 0, 3, "h")],
                  [("a", 1, 3, "el"), ("a", 2, 3, "lo")], [("a", 0, 3, "h"), ("late", 100_000, 2, "z")], [("late", 100_001, 2, "z")]):
        spark.createDataFrame(batch, "request_id string, piece_no int, n_pieces int, piece string").withColumn(
            "sent_at", at).coalesce(1).write.mode("append").parquet(folder)
    stream = jobs.file_stream(spark, folder, schema, files_per_batch=1)
    rows = jobs.run_to_table(jobs.assemble_replies(jobs.event_time(stream, "sent_at", "1 hour")), "test-replies").collect()
    assert sorted(tuple(r) for r in rows) == [("a", "hello", True), ("b", "x", False), ("late", "zz", True)]


def test_replies_go_on_from_their_checkpoint(spark):
    """Half a reply is kept over a restart, and pieces repeated after it was emitted start nothing new."""
    folder, base = work_folder(spark, "test-pieces"), work_folder(spark, "test-replies")
    schema = "request_id string, piece_no int, n_pieces int, piece string, sent_at timestamp"

    def run(*rows):
        spark.createDataFrame(list(rows), "request_id string, piece_no int, n_pieces int, piece string, s long").select(
            "request_id", "piece_no", "n_pieces", "piece", F.timestamp_seconds("s").alias("sent_at")).coalesce(1).write.mode("append").parquet(folder)
        stream = jobs.event_time(jobs.file_stream(spark, folder, schema, files_per_batch=1), "sent_at", "1 minute")
        return sorted(map(tuple, jobs.run_to_table(jobs.assemble_replies(stream), "", folder=base).collect()))

    assert run(("a", 1, 2, "b", 1000), ("c", 0, 2, "never", 1000)) == []
    assert run(("a", 0, 2, "a", 1001)) == [("a", "ab", True)]
    assert run(("a", 0, 2, "a", 1002), ("a", 1, 2, "b", 1002)) == [("a", "ab", True)]
    assert run(("z", 0, 1, "late", 9000)) == [("a", "ab", True), ("c", "never", False), ("z", "late", True)]
    assert run(("y", 0, 1, "later", 20000)) == [("a", "ab", True), ("c", "never", False), ("y", "later", True), ("z", "late", True)]


def test_messages_without_feedback_leave_once(spark):
    def frames(rows, names):
        folder = work_folder(spark, "test-feedback")
        for row in rows:
            spark.createDataFrame([row], names).coalesce(1).write.parquet(folder, mode="append")
        return folder

    base = work_folder(spark, "test-feedback-out")
    sent = frames([(i, 60 * i) for i in (1, 2, 3, 200)], "request_id long, s long")
    posts = frames([(1, 90, "click"), (1, 120, "error"), (2, 9000, "click"), (7, 12000, "click")], "request_id long, s long, feedback string")

    def run():
        m = jobs.file_stream(spark, sent, "request_id long, s long", files_per_batch=1).select("request_id", F.timestamp_seconds("s").alias("ts"))
        f = jobs.file_stream(spark, posts, "request_id long, s long, feedback string", files_per_batch=1).select(
            "request_id", F.timestamp_seconds("s").alias("fb_ts"), "feedback")
        out = jobs.run_to_table(jobs.messages_with_feedback(jobs.event_time(m, "ts", "1 minute"), jobs.event_time(f, "fb_ts", "1 minute")), "", folder=base)
        return sorted((r.request_id, r.feedback or "") for r in out.collect()), sorted((r.request_id, r.feedback or "") for r in jobs.latest_feedback(out).collect())

    want = [(1, "click"), (1, "error"), (2, ""), (3, "")], [(1, "error"), (2, ""), (3, "")]
    assert run() == want and run() == want  # message 200 may still get feedback


def test_rate_limit_and_sessions(spark):
    rows = [(1, 0, 1), (1, 5, 2), (1, 65, 3), (2, 10, 4), (1, 300, 5)]
    df = spark.createDataFrame(rows, "user long, s long, id long").withColumn("ts", F.timestamp_seconds("s"))
    first = jobs.first_per_interval(df, "user", "ts", F.col("id"), "1 minute").collect()
    assert sorted(r.payload for r in first) == [1, 3, 4, 5]
    got = jobs.sessions(df, "user", "ts", "2 minutes").collect()
    assert sorted((r.user, r.n_events) for r in got) == [(1, 1), (1, 3), (2, 1)]


def test_streams_go_on_where_they_ended(spark):
    source, base = work_folder(spark, "test-source"), work_folder(spark, "test-resume")
    for start in (0, 5):
        spark.range(start, start + 5).withColumn("v", F.col("id") * 2).coalesce(1).write.mode("append").parquet(source)
        stream = jobs.file_stream(spark, source, "id long, v long")
        assert jobs.run_to_table(stream, "test", folder=base).count() == start + 5


def test_incremental_ingest_adds_only_new_documents(spark):
    store, progress = DatasetStore(spark, work_folder(spark, "test-store")), work_folder(spark, "test-progress")
    source = work_folder(spark, "test-docs")
    for number, text in ((1, "a b c"), (1, "a b c"), (2, "d e")):
        spark.createDataFrame([("one", f"k{number}", number, text)], "dataset string, dockey string, doc_id long, text string").coalesce(
            1).write.mode("append").parquet(source)
        jobs.ingest_stream(jobs.file_stream(spark, source, "dataset string, dockey string, doc_id long, text string"), store,
                           progress=progress, size=2)
    assert (store.docs().count(), store.chunks().count()) == (2, 3)


def test_pieces_of_a_batch_are_written_together():
    """State calls grow with the blocks of a micro-batch, not with its pieces; repeats and sparse numbers count once."""
    calls = []

    class State(dict):
        exists = lambda self: "v" in self
        get = lambda self: self["v"]
        update = lambda self, v: self.__setitem__("v", v)
        containsKey = lambda self, k: calls.append("has") or k in self
        getValue = lambda self, k: calls.append("get") or self[k]
        updateValue = lambda self, k, v: calls.append("put") or self.__setitem__(k, v)
        iterator = lambda self: iter(list(self.items()))

    class Handle:
        getMapState = getValueState = lambda self, *_: State()
        registerTimer = deleteTimer = lambda self, _: None

    class Timer:
        getCurrentWatermarkInMs = lambda self: 0

    made = jobs.ReplyAssembler(1000)
    made.init(Handle())
    row, at = Row("request_id", "piece_no", "n_pieces", "piece", "sent_at"), datetime(2024, 1, 1)
    numbers = [*range(1999), 1_000_000]

    def send(some):
        return list(made.handleInputRows(("a",), iter([row("a", n, 2000, f"{n} ", at) for n in some]), Timer()))

    assert send(numbers[1::2]) == [] and send(numbers[1::2]) == []  # every second piece, and again
    (reply,) = send(numbers[::2])
    assert (reply.text, reply.complete) == ("".join(f"{n} " for n in numbers), True) and len(calls) < 200
    assert send(numbers[:5]) == []
