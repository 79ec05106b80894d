"""Conversation operators: titles, defaults, bundle versions, search, message edits, export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.constants import DEFAULT_MODEL, DEFAULT_PROMPT, DEFAULT_TEMPERATURE, MODELS
from ..functions.keys import falsy_default
from ..functions.text import title_of
from .ordering import global_row_number, with_halo, with_position

MESSAGE = "struct<role:string,content:string,id:string,feedback:boolean>"
MODEL = "struct<id:string,name:string,maxLength:int,tokenLimit:int>"
CONVERSATION = (f"struct<id:string,name:string,messages:array<{MESSAGE}>,model:{MODEL},prompt:string,"
                "temperature:double,folderId:string>")
FOLDER = "struct<id:string,name:string,type:string>"
PROMPT = f"struct<id:string,name:string,description:string,content:string,model:{MODEL},folderId:string>"
BUNDLE = f"struct<version:int,history:array<{CONVERSATION}>,folders:array<{FOLDER}>,prompts:array<{PROMPT}>>"


def titles(messages: DataFrame, length: int = 30) -> DataFrame:
    """Title of each conversation from its first message; only the start of the text is shuffled."""
    start = F.substring("text", 1, length + 1)
    return messages.groupBy("conv_id").agg(F.min_by(start, F.col("turn")).alias("_first")).select(
        "conv_id", title_of(F.col("_first"), length).alias("title"))


def default_model() -> Column:
    row = next(m for m in MODELS if m[0] == DEFAULT_MODEL)
    return F.struct(*[F.lit(v).alias(n) for n, v in zip(("id", "name", "maxLength", "tokenLimit"), row)]).cast(MODEL)


def clean_conversation(c: Column) -> Column:
    """Fill the fields older versions lack. Empty text and zero count as missing, as null does."""
    return F.struct(
        c["id"].alias("id"), c["name"].alias("name"),
        F.coalesce(c["messages"], F.array().cast(f"array<{MESSAGE}>")).alias("messages"),
        F.coalesce(c["model"], default_model()).alias("model"),
        falsy_default(c["prompt"], F.lit(DEFAULT_PROMPT), F.lit("")).alias("prompt"),
        falsy_default(c["temperature"], F.lit(DEFAULT_TEMPERATURE), F.lit(0.0)).alias("temperature"),
        F.nullif(c["folderId"], F.lit("")).alias("folderId"))


def clean_history(history: Column) -> Column:
    """All conversations of a bundle; entries that are no object are left out, a missing list is empty."""
    kept = F.filter(F.coalesce(history, F.array().cast(f"array<{CONVERSATION}>")), lambda c: c.isNotNull())
    return F.transform(kept, clean_conversation)


def bundle_version(raw: Column) -> Column:
    """Version of an export bundle by its shape; null when unsupported or no valid JSON."""
    keys = F.coalesce(F.json_object_keys(raw), F.array().cast("array<string>"))
    has = lambda key: F.array_contains(keys, key)
    stated = F.get_json_object(raw, "$.version")
    return (F.when(F.json_array_length(raw).isNotNull(), 1)
            .when(~has("version") & has("folders") & has("history"), 2)
            .when(stated == "3", 3).when(stated == "4", 4))


def upgrade_bundles(df: DataFrame, raw: str, *, on_unknown: str = "quarantine") -> DataFrame:
    """Bundles as version 4 columns (history, folders, prompts) beside the version found.

    Unsupported bundles keep a null ``version_found`` so they can be set aside, or fail the job with
    ``on_unknown="error"``. Each version is parsed with its own fixed schema.
    """
    text = F.col(raw)
    version = bundle_version(text)
    if on_unknown == "error":
        version = F.coalesce(version, F.raise_error(F.lit("Unsupported data format")).cast("int"))
    out = df.withColumn("version_found", version)
    out = out.withColumns({
        "_list": F.when(F.col("version_found") == 1, F.from_json(text, f"array<{CONVERSATION}>")),
        "_bundle": F.when(F.col("version_found") > 1, F.from_json(text, BUNDLE))})
    v, b = F.col("version_found"), F.col("_bundle")
    no_folders = F.array().cast(f"array<{FOLDER}>")
    chat_folders = F.transform(F.coalesce(b["folders"], no_folders), lambda f: F.struct(
        f["id"].alias("id"), f["name"].alias("name"), F.lit("chat").alias("type")))
    return out.withColumns({
        "history": F.when(v == 1, clean_history(F.col("_list"))).when(v == 2, clean_history(b["history"])).otherwise(b["history"]),
        "folders": F.when(v == 1, no_folders).when(v == 2, chat_folders).otherwise(b["folders"]),
        "prompts": F.when(v < 4, F.array().cast(f"array<{PROMPT}>")).otherwise(b["prompts"]),
    }).drop("_list", "_bundle")


def search_conversations(messages: DataFrame, names: DataFrame, term: str, piece: int = 4096) -> DataFrame:
    """Conversations whose name and messages, joined by spaces, contain a term in any case.

    A term with ``s`` spaces can run over at most ``s`` message borders, so each message is searched
    together with the ``s`` that follow; no conversation is ever joined into one text.
    """
    needle, borders = term.lower(), term.count(" ")
    texts = messages.select("conv_id", "turn", "text")
    title = names.select("conv_id", F.col("name").alias("text"))
    if borders == 0:
        hits = texts.select("conv_id", "text").unionByName(title).where(F.lower("text").contains(needle))
    else:
        placed = with_position(texts, "conv_id", "turn").select("conv_id", "position", "text")
        rows = placed.unionByName(title.withColumn("position", F.lit(-1).cast("long")))
        cut = with_halo(rows, "position", piece, after=borders)
        ahead = Window.partitionBy("conv_id", "_piece").orderBy("position").rangeBetween(0, borders)
        joined = F.lower(F.array_join(F.collect_list("text").over(ahead), " "))
        hits = cut.withColumn("_seen", joined).where(F.col("_seen").contains(needle))
    return hits.select("conv_id").distinct()


def transcript(messages: DataFrame) -> DataFrame:
    """(conv_id, position, fragment): the lines of each conversation's transcript; joined in order they are its text.

    One row per message, so a conversation of any length is whole and no task has to hold it.
    """
    line = F.concat(F.when(F.col("position") > 0, "\n").otherwise(""), "role", F.lit(": "), F.col("text"))
    return with_position(messages.select("conv_id", "turn", "role", "text"), "conv_id", "turn").select(
        "conv_id", "position", line.alias("fragment"))


def assemble(messages: DataFrame, segment_turns: int) -> DataFrame:
    """Messages of each conversation as ordered arrays, each of a range of ``segment_turns`` turn numbers."""
    segment = F.floor(F.col("turn") / segment_turns).alias("segment")
    items = F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content"))))
    return messages.groupBy("conv_id", segment).agg(items.alias("messages"))


def _bundle(history: Column, folders: Column, prompts: Column) -> Column:
    return F.to_json(F.struct(F.lit(4).alias("version"), history.alias("history"), folders.alias("folders"),
                              prompts.alias("prompts"))).alias("bundle")


def export_fragments(messages: DataFrame, settings: DataFrame) -> DataFrame:
    """(conv_id, position, fragment): a version 4 bundle per conversation; its fragments in order are the JSON text.

    ``settings`` has one row per conversation: conv_id, name, model, prompt, temperature, folderId. The
    opening comes at position -1, then one fragment per message, then the closing, so a conversation of
    any length is one bundle and no task has to hold it.
    """
    head = F.to_json(F.struct(F.col("conv_id").cast("string").alias("id"), "name", "model", "prompt", "temperature", "folderId"))
    opening = F.concat(F.lit('{"version":4,"history":['), F.substring(head, F.lit(1), F.length(head) - 1), F.lit(',"messages":['))
    message = F.to_json(F.struct("role", F.col("text").alias("content")))
    placed = with_position(messages.select("conv_id", "turn", "role", "text"), "conv_id", "turn")
    ends = messages.groupBy("conv_id").agg(F.count(F.lit(1)).alias("position"))
    closing = settings.select("conv_id").join(ends, "conv_id", "left").select(
        "conv_id", F.coalesce("position", F.lit(0).cast("long")).alias("position"), F.lit(']}],"folders":[],"prompts":[]}').alias("fragment"))
    return (settings.select("conv_id", F.lit(-1).cast("long").alias("position"), opening.alias("fragment"))
            .unionByName(placed.join(settings.select("conv_id"), "conv_id", "left_semi").select(
                "conv_id", "position", F.concat(F.when(F.col("position") > 0, ",").otherwise(""), message).alias("fragment")))
            .unionByName(closing))


HISTORY, FOLDERS, PROMPTS, END = 1, 3, 5, 6  # sections of a whole bundle; the others hold what stands between


def export_whole_bundle(messages: DataFrame, settings: DataFrame, folders: DataFrame, prompts: DataFrame) -> DataFrame:
    """(section, item, position, fragment): everything as one version 4 bundle; the fragments in order are the JSON text.

    ``settings`` as for ``export_fragments``, ``folders`` and ``prompts`` as their rows with unique ids. One
    fragment per message, folder and prompt: the bundle may be of any size.
    """
    spark = messages.sparkSession
    between = spark.createDataFrame([(0, 0, 0, '{"version":4,"history":['), (2, 0, 0, '],"folders":['), (4, 0, 0, '],"prompts":['), (END, 0, 0, "]}")],
                                    "section int, item long, position long, fragment string")
    first = settings.agg(F.min("conv_id").alias("first"))
    opening = export_fragments(messages, settings).crossJoin(F.broadcast(first))  # one row
    head, tail = F.lit('{"version":4,"history":['), F.lit('],"folders":[],"prompts":[]}')
    text = F.when(F.col("position") == -1, F.concat(F.when(F.col("conv_id") > F.col("first"), ",").otherwise(""),
                                                    F.substring(F.col("fragment"), F.length(head) + 1, F.length("fragment"))))
    text = text.otherwise(F.when(F.endswith("fragment", tail), F.substring(F.col("fragment"), F.lit(1), F.length("fragment") - F.length(tail)))
                          .otherwise(F.col("fragment")))
    history = opening.select(F.lit(HISTORY).alias("section"), F.col("conv_id").cast("long").alias("item"), "position", text.alias("fragment"))

    def listed(rows: DataFrame, section: int) -> DataFrame:
        numbered = global_row_number(rows, "id", "_no")
        comma = F.when(F.col("_no") > 1, ",").otherwise("")
        return numbered.select(F.lit(section).alias("section"), F.col("_no").alias("item"), F.lit(0).cast("long").alias("position"),
                               F.concat(comma, F.to_json(F.struct(*rows.columns))).alias("fragment"))

    return between.unionByName(history).unionByName(listed(folders, FOLDERS)).unionByName(listed(prompts, PROMPTS))


def write_bundles(fragments: DataFrame, folder: str, parts: int) -> None:
    """Fragments as lines in (conversation, position) order: the files, read by name, are one bundle after another.

    JSON takes the line ends between fragments for blanks; an empty line ends a bundle.
    """
    ordered = fragments.repartitionByRange(parts, "conv_id", "position").sortWithinPartitions("conv_id", "position")
    closed = F.endswith(F.col("fragment"), F.lit('"prompts":[]}'))
    ordered.select(F.concat("fragment", F.when(closed, "\n").otherwise("")).alias("value")).write.text(folder)


def export_folders_and_prompts(folders: DataFrame, prompts: DataFrame) -> DataFrame:
    """Version 4 bundle text per folder (id, name, type) and per prompt."""
    empty = F.array().cast("array<string>")
    return folders.select(_bundle(empty, F.array(F.struct("id", "name", "type")), empty)).unionByName(
        prompts.select(_bundle(empty, empty, F.array(F.struct(*prompts.columns)))))


def export_file_name(day: Column, prefix: str = "chat_history") -> Column:
    """Name of an export file with month and day, such as ``chat_history_3-7.json``."""
    return F.concat(F.lit(f"{prefix}_"), F.date_format(day, "M-d"), F.lit(".json"))


def last_message(messages: DataFrame) -> DataFrame:
    return nth_from_end(messages, 1)


def nth_from_end(messages: DataFrame, n: int) -> DataFrame:
    """The n-th message from the end; partial top-n per task keeps a huge conversation cheap."""
    back = Window.partitionBy("conv_id").orderBy(F.desc("turn"))
    return messages.withColumn("_back", F.row_number().over(back)).where(F.col("_back") <= n).where(
        F.col("_back") == n).drop("_back")


def replace_tail(messages: DataFrame, edits: DataFrame, drop_last: int) -> DataFrame:
    """Drop the last messages of the edited conversations and append the edited message in their place.

    ``edits`` has one (conv_id, role, text) per conversation; other conversations stay as they are.
    With nothing to drop, or an empty conversation, the message is appended.
    """
    back = Window.partitionBy("conv_id").orderBy(F.desc("turn"))
    own = messages.select("conv_id", "turn").join(edits.select("conv_id"), "conv_id", "left_semi")
    cuts = own.groupBy("conv_id").agg((F.max("turn") + 1).alias("_end"))
    if drop_last:
        tail = own.withColumn("_back", F.row_number().over(back)).where(F.col("_back") <= drop_last)
        cuts = tail.groupBy("conv_id").agg(F.min("turn").alias("_end"))
    cut = edits.join(cuts, "conv_id", "left").withColumn("_cut", F.coalesce("_end", F.lit(0).cast("long")))
    kept = messages.join(cut.select("conv_id", "_cut"), "conv_id", "left").where(
        F.col("_cut").isNull() | (F.col("turn") < F.col("_cut"))).drop("_cut")
    return kept.unionByName(cut.select("conv_id", F.col("_cut").alias("turn"), "role", "text"))


def delete_with_reply(messages: DataFrame, deleted: DataFrame) -> DataFrame:
    """Remove the given (conv_id, turn) and an assistant message directly behind each, over gaps in the turns.

    The message behind is found by a join on (conversation, position), which spreads evenly.
    """
    own = deleted.select("conv_id", "turn").distinct()
    placed = with_position(messages.select("conv_id", "turn", "role"), "conv_id", "turn")
    behind = placed.join(own, ["conv_id", "turn"], "left_semi").select("conv_id", (F.col("position") + 1).alias("position"))
    replies = placed.where(F.col("role") == "assistant").join(behind, ["conv_id", "position"], "left_semi").select("conv_id", "turn")
    return messages.join(own.unionByName(replies).distinct(), ["conv_id", "turn"], "left_anti")


def newest(df: DataFrame, order: str) -> DataFrame:
    """The last row by position."""
    columns = [c for c in df.columns if c != order]
    return df.agg(F.max(F.struct(order, *columns)).alias("x")).select("x.*")


def sorted_folders(folders: DataFrame, name: str) -> DataFrame:
    return folders.orderBy(F.lower(name), name)
