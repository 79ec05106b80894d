import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from foliospark.functions.constants import DEFAULT_MODEL, DEFAULT_PROMPT
from foliospark.operators import chat, joins, sets
from foliospark.operators.retrieval import chat_window
from foliospark.plans.chat_import import import_history, refused_bundles

MESSAGES = [{"role": "user", "content": "what's up ?"}, {"role": "assistant", "content": "Hi"}]
OLD = {"id": 1, "name": "conversation 1", "messages": MESSAGES}
FULL = {**OLD, "id": "1", "model": {"id": "gpt-4", "name": "GPT-4", "maxLength": 24000, "tokenLimit": 8000}, "prompt": "p",
        "temperature": 1, "folderId": None}


def upgraded(spark, bundle):
    df = spark.createDataFrame([(bundle if isinstance(bundle, str) else json.dumps(bundle),)], "raw string")
    return chat.upgrade_bundles(df, "raw").first()


@pytest.mark.parametrize("bundle, version", [
    ([], 1), ({"history": [], "folders": []}, 2), ({"history": None, "folders": None}, 2), ({"history": []}, None),
    ({"version": 3, "history": [], "folders": []}, 3), ({"version": 4, "history": [], "folders": [], "prompts": []}, 4),
    ({"version": 5, "history": [], "folders": []}, None), ("not json", None), ("[{broken", None), ("\n [ ]", 1)])
def test_versions(spark, bundle, version):
    assert upgraded(spark, bundle).version_found == version


def test_version_1(spark):
    row = upgraded(spark, [OLD, None])
    (c,) = row.history
    assert (c.id, c.name, c.prompt, c.temperature, c.folderId, c.model.id) == ("1", "conversation 1", DEFAULT_PROMPT, 0.0, None, DEFAULT_MODEL)
    assert [(m.role, m.content) for m in c.messages] == [(m["role"], m["content"]) for m in MESSAGES]
    assert row.folders == [] and row.prompts == []


def test_version_2_folders(spark):
    row = upgraded(spark, {"history": [OLD], "folders": [{"id": 7, "name": "f"}]})
    assert [tuple(f) for f in row.folders] == [("7", "f", "chat")] and len(row.history) == 1
    empty = upgraded(spark, {"history": None, "folders": None})
    assert empty.history == [] and empty.folders == []


def test_version_3_and_4_keep_their_content(spark):
    folders = [{"id": "a", "name": "A", "type": "prompt"}]
    three = upgraded(spark, {"version": 3, "history": [FULL], "folders": folders})
    assert tuple(three.folders[0]) == ("a", "A", "prompt") and three.prompts == [] and three.history[0].prompt == "p"
    four = upgraded(spark, {"version": 4, "history": [FULL], "folders": folders, "prompts": [{"id": "p1", "name": "P"}]})
    assert four.prompts[0].id == "p1" and four.history[0].model.id == "gpt-4"


def test_unknown_version_can_fail(spark):
    df = spark.createDataFrame([('{"version": 5}',)], "raw string")
    with pytest.raises(PySparkException, match="Unsupported data format"):
        chat.upgrade_bundles(df, "raw", on_unknown="error").collect()


def test_import_is_idempotent(spark):
    df = spark.createDataFrame([(1, json.dumps([OLD])), (2, json.dumps([{**OLD, "name": "later"}, {**OLD, "id": 2}]))], "n long, raw string")
    stored = import_history(spark.createDataFrame([], f"x {chat.CONVERSATION}, position struct<bundle:long,item:int>").select("x.*", "position"),
                            df, "raw", "n")
    rows = {r.id: r.name for r in stored.collect()}
    assert rows == {"1": "conversation 1", "2": "conversation 1"}
    again = import_history(stored, df, "raw", "n")
    assert sorted(map(str, again.collect())) == sorted(map(str, stored.collect()))


def talk(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "user", "c"), (1, 3, "user", "d"), (1, 4, "assistant", "e"), (2, 0, "user", "x")]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def ids(df):
    return sorted((r.conv_id, r.turn) for r in df.select("conv_id", "turn").collect())


def test_delete_message(spark):
    gone = lambda *turns: ids(chat.delete_with_reply(talk(spark), spark.createDataFrame([(1, t) for t in turns], "conv_id long, turn long")))
    assert gone(0) == [(1, 2), (1, 3), (1, 4), (2, 0)]
    assert gone(2) == [(1, 0), (1, 1), (1, 3), (1, 4), (2, 0)]
    assert gone(4) == [(1, 0), (1, 1), (1, 2), (1, 3), (2, 0)]


def test_replace_tail(spark):
    edits = spark.createDataFrame([(1, "user", "new"), (2, "user", "new")], "conv_id long, role string, text string")
    got = chat.replace_tail(talk(spark), edits, 2)
    assert ids(got) == [(1, 0), (1, 1), (1, 2), (1, 3), (2, 0)]
    assert sorted(r.text for r in got.collect()) == ["a", "b", "c", "new", "new"]
    more = spark.createDataFrame([(1, "user", "new"), (7, "user", "first")], "conv_id long, role string, text string")
    appended = chat.replace_tail(talk(spark), more, 0)
    assert ids(appended) == [(1, 0), (1, 1), (1, 2), (1, 3), (1, 4), (1, 5), (2, 0), (7, 0)]


def test_refused_bundles_are_kept_with_a_reason(spark):
    df = spark.createDataFrame([(1, '{"version":9,"history":[],"folders":[]}'), (2, "[]"), (3, "no json")], "n long, raw string")
    assert sorted((r.n, r.reason) for r in refused_bundles(df, "raw").collect()) == [(1, "Unsupported data format"), (3, "Unsupported data format")]


def test_positions_ignore_gaps(spark):
    gapped = talk(spark).where("turn <> 2").withColumn("turn", F.col("turn") * 10_000)  # turns 0, 1, 3, 4 far apart
    names = spark.createDataFrame([(1, "Plan")], "conv_id long, name string")
    assert [r.conv_id for r in chat.search_conversations(gapped, names, "b d", piece=2).collect()] == [1]
    gone = chat.delete_with_reply(gapped, spark.createDataFrame([(1, 30_000)], "conv_id long, turn long"))
    assert ids(gone) == [(1, 0), (1, 10_000), (2, 0)]
    history = {(r.conv_id, r.turn): r.history for r in chat_window(gapped, 2).collect()}
    assert history == {(1, 0): [], (1, 30_000): ["a", "b"], (2, 0): []}


def test_search_over_message_borders(spark):
    names = spark.createDataFrame([(1, "Plan"), (2, "y")], "conv_id long, name string")
    found = lambda term: [r.conv_id for r in chat.search_conversations(talk(spark), names, term, piece=2).collect()]
    assert found("PLAN A B C") == [1]
    assert found("b c d e") == [1] and found("a c") == [] and found("y x") == [2]


def test_long_conversations_are_cut_into_segments(spark):
    rows = chat.assemble(talk(spark), segment_turns=2).orderBy("conv_id", "segment").collect()
    assert [(r.conv_id, r.segment, [m.turn for m in r.messages]) for r in rows] == [
        (1, 0, [0, 1]), (1, 1, [2, 3]), (1, 2, [4]), (2, 0, [0])]


def test_feedback_and_folders(spark):
    posts = spark.createDataFrame([(1, 0, "positive", 1), (1, 0, "negative", 2), (9, 9, "positive", 3)], "conv_id long, turn long, feedback string, at int")
    got = joins.attach_feedback(talk(spark).withColumn("feedback", F.when(F.col("turn") == 1, "old")), posts, ["conv_id", "turn"], ["at"])
    assert {(r.conv_id, r.turn): r.feedback for r in got.collect() if r.feedback} == {(1, 0): "negative", (1, 1): "old"}
    folders = spark.createDataFrame([("f2", "beta"), ("f1", "Alpha")], "fid string, name string")
    items = spark.createDataFrame([(1, "f2"), (2, "gone"), (3, None), (4, "f1"), (5, "f2")], "item long, folder string")
    kept = joins.drop_dangling(items, folders, "folder", "fid")
    assert [r.item for r in joins.filed_items(kept, folders, "folder", "fid", "name", "item").collect()] == [4, 1, 5, 3, 2]


def test_sets(spark):
    old = spark.createDataFrame([(1, "a", 0), (2, "b", 1)], "id long, v string, pos long")
    new = spark.createDataFrame([(2, "c", 0), (3, "d", 1), (3, "e", 2)], "id long, v string, pos long")
    merged = sets.merge_first_wins([old, new], "id", "pos")
    assert sorted(r.v for r in merged.collect()) == ["a", "b", "d"]
    assert sorted(r.v for r in sets.merge_first_wins([merged, merged], "id", "pos").collect()) == ["a", "b", "d"]
    assert sorted(r.v for r in sets.upsert(old, new.where("v = 'c'"), "id").collect()) == ["a", "c"]
    typed = spark.createDataFrame([(1, "chat"), (2, None), (3, "prompt")], "id long, type string")
    assert sorted(r.id for r in sets.clear_type(typed, "type", "chat").collect()) == [2, 3]


def test_export_can_be_imported(spark, tmp_path):
    long = spark.range(3000).select(F.lit(3).cast("long").alias("conv_id"), (F.col("id") * 2).alias("turn"), F.lit("user").alias("role"),
                                    F.concat(F.lit('say "'), F.col("id").cast("string")).alias("text"))
    settings = spark.createDataFrame([(c, f"n{c}", f"p{c}", c / 4, f"f{c}" if c > 1 else None) for c in (1, 2, 3, 4)],
                                     "conv_id long, name string, prompt string, temperature double, folderId string")
    out = chat.export_fragments(talk(spark).unionByName(long), settings.withColumn("model", chat.default_model()))
    chat.write_bundles(out, str(tmp_path / "export"), 5)
    written = "".join(p.read_text() for p in sorted((tmp_path / "export").glob("part-*")))
    raw = spark.createDataFrame([(bundle,) for bundle in written.split("\n\n") if bundle], "bundle string")
    assert raw.count() == 4
    up = chat.upgrade_bundles(raw, "bundle").collect()
    assert all(r.version_found == 4 and len(r.history) == 1 for r in up)
    found = {r.history[0].id: r.history[0] for r in up}
    assert {i: [m.content for m in c.messages] for i, c in found.items()} == {
        "1": ["a", "b", "c", "d", "e"], "2": ["x"], "3": [f'say "{i}' for i in range(3000)], "4": []}
    assert [(found[i].name, found[i].prompt, found[i].temperature, found[i].folderId, found[i].model.id) for i in ("1", "3")] == [
        ("n1", "p1", 0.25, None, "gpt-3.5-turbo"), ("n3", "p3", 0.75, "f3", "gpt-3.5-turbo")]
    lines = chat.transcript(long).orderBy("position").collect()
    assert "".join(r.fragment for r in lines).count("\n") == 2999
    folders = spark.createDataFrame([("f", "F", "chat")], "id string, name string, type string")
    prompts = spark.createDataFrame([("p", "P", "text")], "id string, name string, content string")
    rest = chat.upgrade_bundles(chat.export_folders_and_prompts(folders, prompts), "bundle").collect()
    assert [f.id for r in rest for f in r.folders] == ["f"] and [(p.id, p.content) for r in rest for p in r.prompts] == [("p", "text")]
    day = spark.sql("SELECT DATE'2024-03-07' AS d").select(chat.export_file_name(F.col("d"))).first()[0]
    assert day == "chat_history_3-7.json"
