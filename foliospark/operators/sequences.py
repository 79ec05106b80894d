"""Token sequences for training: ratio, constant-length packing, infilling, sample packing, instruction rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.generate import inline_rows, let, posexplode_rows
from ..functions.keys import stable_hash
from ..functions.packing import greedy_runs
from ..functions.text import token_count, tokens
from .ordering import global_row_number, running_totals, with_position

VOCABULARY = 49152
EOS_ID = 49152
CHARS_PER_TOKEN = 3.6
BUFFERED_SEQUENCES = 1024
PACKED_ROWS = 2_000  # documents of one segment of the order
IGNORED_LABEL = -100
# The instruction layout used for fine-tuning rows.
INSTRUCTION = "### Instruction:\n{instruction}\n\n### Response:\n"


def token_ids(text: Column, vocabulary: int = VOCABULARY) -> Column:
    """Whitespace tokens as stable ids below ``vocabulary`` (a stand-in for a trained tokenizer)."""
    return F.transform(tokens(text), lambda t: F.conv(F.substring(F.md5(t), 1, 8), 16, 10).cast("long") % vocabulary)


def chars_per_token(df: DataFrame, key: str, text: str, examples: int | None = 400) -> DataFrame:
    """Characters per token over the first rows (all rows when ``examples`` is None)."""
    rows = df if examples is None else df.orderBy(key).limit(examples)
    return rows.agg(F.sum(F.length(text)).cast("long").alias("n_chars"), F.sum(token_count(F.col(text))).cast("long").alias("n_tokens")
                    ).withColumn("chars_per_token", F.round(F.try_divide(F.col("n_chars"), F.col("n_tokens")), 6))


def pack_constant_length(df: DataFrame, key: str, ids: str, n_chars: str, seq_length: int, *, buffer_chars: int | None = None,
                         eos: int = EOS_ID, rows_per_segment: int = PACKED_ROWS) -> DataFrame:
    """Concatenate documents in key order with an end mark between them and cut to ``seq_length``.

    The stream is cut into buffers of about ``buffer_chars`` characters (a document stays whole), and a
    buffer's incomplete tail is dropped. Offsets are running totals over the whole order, whatever the
    keys are; pieces, not single tokens, are regrouped, by sequence.
    """
    buffer_chars = buffer_chars or int(seq_length * CHARS_PER_TOKEN * BUFFERED_SEQUENCES)
    rows = df.select(F.col(key), F.col(n_chars).alias("_chars"), F.concat(F.col(ids), F.array(F.lit(eos).cast("long"))).alias("_all"))
    rows = running_totals(rows.withColumn("_n", F.size("_all")), key, {"_read": "_chars", "_end": "_n"}, rows_per_segment)
    rows = rows.withColumns({"buffer_no": F.floor((F.col("_read") - F.col("_chars")) / buffer_chars), "_at": F.col("_end") - F.col("_n")})
    first = rows.groupBy("buffer_no").agg(F.min("_at").alias("_first"))
    rows = rows.join(first, "buffer_no").withColumn("_at", F.col("_at") - F.col("_first"))
    end = F.col("_at") + F.col("_n")
    numbers = F.sequence(F.floor(F.col("_at") / seq_length), F.floor((end - 1) / seq_length))

    def piece(no: Column) -> Column:
        start, stop = F.greatest(no * seq_length, F.col("_at")), F.least((no + 1) * seq_length, end)
        return F.struct(no.alias("seq_no"), start.alias("at"), F.slice(
            "_all", (start - F.col("_at") + 1).cast("int"), (stop - start).cast("int")).alias("piece"))

    pieces = inline_rows(rows, ["buffer_no"], F.transform(numbers, piece), "seq_no")
    packed = pieces.groupBy("buffer_no", "seq_no").agg(
        F.array_sort(F.collect_list(F.struct("at", "piece"))).alias("p"), F.sum(F.size("piece")).alias("_n"))
    joined = packed.where(F.col("_n") == seq_length).select(
        "buffer_no", "seq_no", F.flatten(F.transform("p", lambda x: x["piece"])).alias("input_ids"))
    return joined.withColumn("labels", F.col("input_ids"))


def fill_in_middle(df: DataFrame, key: str, ids: str, *, prefix: int | None, middle: int | None, suffix: int | None,
                   rate: float = 0.5, spm_rate: float = 0.5, seed: int = 0, truncate: bool = False) -> DataFrame:
    """Rearrange a share of the sequences for infilling.

    Two cut points split a sequence into prefix, middle and suffix. Suffix-first rows read
    [prefix mark, suffix mark, suffix, middle mark, prefix, middle]; the others read
    [prefix mark, prefix, suffix mark, suffix, middle mark, middle]. With ``truncate`` the length is
    kept by shortening the suffix; rows whose suffix is too short stay unchanged. All choices come
    from hashes of the key. Without mark ids nothing is rearranged.
    """
    if None in (prefix, middle, suffix) or rate <= 0:
        return df
    marks = {name: F.array(F.lit(v).cast("long")) for name, v in
             (("prefix", prefix), ("middle", middle), ("suffix", suffix))}

    def chance(salt: str, share: float) -> Column:
        return stable_hash(f"{salt}:{seed}", F.col(key)) % 10_000 < F.lit(int(round(share * 10_000)))

    n = F.size(ids)
    cuts = [(stable_hash(f"cut{i}:{seed}", F.col(key)) % (n + 1)).cast("int") for i in (1, 2)]
    out = df.withColumns({"_lo": F.least(*cuts), "_hi": F.greatest(*cuts)})
    first, mid = F.slice(ids, F.lit(1), F.col("_lo")), F.slice(ids, F.col("_lo") + 1, F.col("_hi") - F.col("_lo"))
    last_n = n - F.col("_hi") - (len(marks) if truncate else 0)
    last = F.slice(ids, F.col("_hi") + 1, F.greatest(last_n, F.lit(0)))
    spm = F.concat(marks["prefix"], marks["suffix"], last, marks["middle"], first, mid)
    psm = F.concat(marks["prefix"], first, marks["suffix"], last, marks["middle"], mid)
    apply = chance("fim", rate) & (last_n > 0 if truncate else F.lit(True))
    moved = F.when(apply, F.when(chance("spm", spm_rate), spm).otherwise(psm)).otherwise(F.col(ids))
    return out.withColumn(ids, moved).drop("_lo", "_hi")


def pack_samples(df: DataFrame, key: str, ids: str, seq_length: int, *, samples_per_shard: int,
                 pad: int = 0) -> DataFrame:
    """Whole samples into sequences, filled in key order and padded to ``seq_length``.

    A sample longer than a sequence is cut into full pieces, so no token is lost. A shard is a run
    of ``samples_per_shard`` consecutive samples, which bounds what one task holds.
    """
    df = global_row_number(df, key, "_row", rows_per_segment=PACKED_ROWS)
    def cut(sample: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(sample), F.lit(1)), F.lit(seq_length))
        return F.transform(starts, lambda at: F.struct(at.alias("at"), F.slice(sample, at, seq_length).alias("ids")))

    def runs(pieces: Column) -> Column:
        sizes = F.transform(pieces, lambda p: F.size(p["ids"]))
        return F.transform(let(sizes, lambda s: greedy_runs(s, seq_length)),
                           lambda r: F.slice(pieces, r["start"] + 1, r["stop"] - r["start"]))

    # The pieces are made before the shuffle; a filter on their size would compute the ids twice.
    shards = df.select(F.floor((F.col("_row") - 1) / samples_per_shard).alias("shard"), F.col(key), let(F.col(ids), cut).alias("_cut")
                       ).groupBy("shard").agg(F.array_sort(F.collect_list(F.struct(key, "_cut"))).alias("_samples"))
    pieces = F.filter(F.flatten(F.transform("_samples", lambda s: s["_cut"])), lambda p: F.size(p["ids"]) > 0)
    bins = posexplode_rows(shards, ["shard"], let(pieces, runs), "bin_no", "_run")
    filled = bins.select("shard", "bin_no", F.size("_run").alias("n_samples"),
                         F.flatten(F.transform("_run", lambda p: p["ids"])).alias("_ids"))
    missing = F.lit(seq_length) - F.size("_ids")
    return filled.select("shard", "bin_no", "n_samples", missing.alias("n_pad"),
                         F.concat("_ids", F.array_repeat(F.lit(pad).cast("long"), missing)).alias("input_ids"))


def instruction_rows(messages: DataFrame, template: str = INSTRUCTION) -> DataFrame:
    """User messages with the assistant message right after them, over gaps in the turns; prompt tokens carry no loss.

    The pairing is a join on (conversation, position), so a huge conversation spreads over tasks.
    """
    placed = with_position(messages.select("conv_id", "turn", "role", "text"), "conv_id", "turn")
    user = placed.where(F.col("role") == "user").select("conv_id", "turn", "position", F.col("text").alias("instruction"))
    reply = placed.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("position") - 1).alias("position"), F.col("text").alias("answer"))
    pairs = user.join(reply, ["conv_id", "position"])
    prompt = F.replace(F.lit(template), F.lit("{instruction}"), F.col("instruction"))
    ids = pairs.select("conv_id", "turn", token_ids(prompt).alias("_prompt"), token_ids(F.col("answer")).alias("_answer"))
    return ids.select("conv_id", "turn", F.concat("_prompt", "_answer").alias("input_ids"), F.concat(
        F.array_repeat(F.lit(IGNORED_LABEL).cast("long"), F.size("_prompt")), "_answer").alias("labels"))


def clip_tokens(text: Column, length: int) -> Column:
    """First ``length`` tokens, the input limit of an embedding model."""
    return F.array_join(F.slice(tokens(text), 1, length), " ")
