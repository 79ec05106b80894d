"""Order-dependent operators that never pull an unbounded group into one task.

A window without a partition key, or keyed by something one third of the rows may share, runs in
one task. Here rows are first cut into bounded segments of the order; windows run inside the
segments, and a second, small pass over one row per segment carries totals across them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import stable_hash
from ..session import materialise

SEGMENT_ROWS = 200_000
SAMPLED_PER_SEGMENT = 200


def order_bounds(df: DataFrame, key: str, rows_per_segment: int = SEGMENT_ROWS) -> list:
    """Cut points that split a numeric key into segments of about ``rows_per_segment`` rows.

    The cut points come from a sample of the key, so one task never merges summaries of the whole
    table. They only balance the work: any set of them gives the same, whole result.
    """
    keys = df.select(key)
    count = keys.count()
    segments = -(-count // rows_per_segment)  # follows the rows, so no segment grows with the table
    if segments <= 1:
        return []
    share = SAMPLED_PER_SEGMENT * segments / count
    sample = keys if share >= 1 else keys.sample(share, seed=17)
    marks = [i / segments for i in range(1, segments)]
    (points,) = sample.agg(F.percentile_approx(key, marks, max(10_000, 4 * segments))).first()
    return sorted(set(points or []))


def with_segment(df: DataFrame, key: str, bounds: list, name: str = "segment") -> DataFrame:
    """Number of cut points at or below the key, found by binary search inside Spark."""
    if not bounds:
        return df.withColumn(name, F.lit(0))
    if len(bounds) <= 64:
        return df.withColumn(name, F.size(F.filter(F.lit(bounds), lambda b: b <= F.col(key))))
    # Two levels: find the block of cut points first, then count inside that block.
    step = int(len(bounds) ** 0.5) + 1
    blocks = [bounds[i:i + step] for i in range(0, len(bounds), step)]
    block = F.size(F.filter(F.lit([b[0] for b in blocks]), lambda b: b <= F.col(key)))
    cuts = F.array(*[F.lit(b) for b in blocks])
    inner = F.size(F.filter(F.element_at(cuts, F.greatest(block, F.lit(1))), lambda b: b <= F.col(key)))
    return df.withColumn(name, F.when(block == 0, 0).otherwise((block - 1) * step + inner))


def segmented(df: DataFrame, key: str, rows_per_segment: int = SEGMENT_ROWS, tie: str | None = None) -> DataFrame | None:
    """Rows cut along the order into segments of about ``rows_per_segment``, as a written table; None for one segment.

    Adds ``_segment``, ascending with the order, and ``_inside``, the row's 1-based number in it. Spark's range
    partitioning finds the cuts, so the plan does not grow with the table, and the written table fixes them.
    With a tie breaker a key that very many rows share is cut too.
    """
    segments = -(-df.select(key).count() // rows_per_segment)  # follows the rows, so no segment grows with the table
    if segments <= 1:
        return None
    order = [key, *([tie] if tie else [])]
    placed = df.repartitionByRange(segments, *order).sortWithinPartitions(*order).withColumns({
        "_segment": F.spark_partition_id(), "_inside": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + 1})
    return materialise(placed, "segments")


def global_row_number(df: DataFrame, key: str, name: str = "row_no", *, tie: str | None = None,
                      rows_per_segment: int = SEGMENT_ROWS) -> DataFrame:
    """1-based row number over the whole table in order of a key (and a tie breaker).

    Rows are numbered inside segments as these are written; row counts per segment give each its offset.
    """
    parts = segmented(df, key, rows_per_segment, tie)
    if parts is None:  # the whole table is one segment of bounded size
        return df.withColumn(name, F.row_number().over(Window.orderBy(key, *([tie] if tie else []))).cast("long"))
    counts = parts.groupBy("_segment").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_segment", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (parts.join(F.broadcast(offsets), "_segment")  # one row per segment
            .withColumn(name, (F.col("_inside") + F.col("_offset")).cast("long")).drop("_segment", "_inside", "_offset"))


def running_totals(df: DataFrame, key: str, values: dict[str, str],
                   rows_per_segment: int = SEGMENT_ROWS) -> DataFrame:
    """Running sums ``{output: input}`` over a unique key, without a global window."""
    parts = segmented(df, key, rows_per_segment)
    if parts is None:  # the whole table is one segment of bounded size
        upto = Window.orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns({o: F.sum(v).over(upto) for o, v in values.items()})
    upto = Window.partitionBy("_segment").orderBy("_inside").rowsBetween(Window.unboundedPreceding, 0)
    totals = parts.groupBy("_segment").agg(*[F.sum(v).alias(f"_t_{o}") for o, v in values.items()])
    before = Window.orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_segment", *[F.coalesce(F.sum(f"_t_{o}").over(before), F.lit(0)).alias(f"_o_{o}")
                                          for o in values])
    inner = parts.withColumns({f"_r_{o}": F.sum(v).over(upto) for o, v in values.items()})
    joined = inner.join(F.broadcast(offsets), "_segment")  # one row per segment
    return joined.withColumns({o: F.col(f"_r_{o}") + F.col(f"_o_{o}") for o in values}).drop(
        "_segment", "_inside", *[f"_r_{o}" for o in values], *[f"_o_{o}" for o in values])


def with_halo(df: DataFrame, position: str, width: int, before: int = 0, after: int = 0) -> DataFrame:
    """Cut ordered groups into pieces of ``width`` positions and copy their edges to the neighbours.

    Adds ``_piece`` and ``_halo``. A window keyed by (group, ``_piece``) with a RANGE frame of at
    most ``before`` back and ``after`` ahead then sees every row it needs, while a group of any
    size is spread over many tasks. Drop rows with ``_halo`` afterwards.
    """
    width = max(width, before, after)  # an edge must lie within the neighbouring piece
    own = F.floor(F.col(position) / width)
    offset = F.col(position) - own * width
    pieces = [F.struct(own.alias("_piece"), F.lit(False).alias("_halo"))]
    if before:
        pieces.append(F.when(offset >= width - before, F.struct((own + 1).alias("_piece"), F.lit(True).alias("_halo"))))
    if after:
        pieces.append(F.when(offset < after, F.struct((own - 1).alias("_piece"), F.lit(True).alias("_halo"))))
    if len(pieces) == 1:
        return df.withColumns({"_piece": own, "_halo": F.lit(False)})
    return df.select("*", F.inline(F.filter(F.array(*pieces), lambda p: p.isNotNull())))


def carry_forward(df: DataFrame, group: list[str], order: list[str], piece: str,
                  carried: dict[str, str], number: str | None = None) -> DataFrame:
    """Last non-null value of earlier-or-equal rows per group, and optionally a row number.

    ``piece`` is a coarser form of the leading order column (such as its date). Windows run
    per (group, piece); one summary row per piece carries the state across pieces.
    """
    inner = Window.partitionBy(*group, piece).orderBy(*order)
    upto = inner.rowsBetween(Window.unboundedPreceding, 0)
    ends = df.groupBy(*group, piece).agg(
        *[F.max_by(source, F.when(F.col(source).isNotNull(), F.struct(*order))).alias(f"_end_{out}")
          for out, source in carried.items()], F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(*group).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    start = ends.select(*group, piece,
                        *[F.last(f"_end_{o}", ignorenulls=True).over(earlier).alias(f"_start_{o}") for o in carried],
                        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    out = df.join(start, [*group, piece]).withColumns({
        o: F.coalesce(F.last(s, ignorenulls=True).over(upto), F.col(f"_start_{o}")) for o, s in carried.items()})
    if number:
        out = out.withColumn(number, (F.row_number().over(inner) + F.col("_before")).cast("long"))
    return out.drop("_before", *[f"_start_{o}" for o in carried])


GROUP_ROWS = 4096  # a group of so many rows may be one window


def all_groups_within(df: DataFrame, group: str, rows: int = GROUP_ROWS) -> bool:
    """Whether no group has more rows; counted over the key column alone, combined in the map tasks."""
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > rows).isEmpty()


def with_position(df: DataFrame, group: str, order: str, name: str = "position", piece: int = GROUP_ROWS) -> DataFrame:
    """Zero-based position of every row in its group, dense whatever gaps ``order`` has.

    Groups of a checked size are numbered by one window. Otherwise the order is cut into segments that are
    numbered on their own, so a group of any size spreads over many tasks.
    """
    if all_groups_within(df, group, piece):
        return df.withColumn(name, (F.row_number().over(Window.partitionBy(group).orderBy(order)) - 1).cast("long"))
    placed = df.repartitionByRange(-(-df.select(group).count() // piece), group, order).withColumn("_part", F.spark_partition_id())
    numbered = carry_forward(materialise(placed, "positions"), [group], [order], "_part", {}, number=name)
    return numbered.withColumn(name, F.col(name) - 1).drop("_part")


def keyset_page(df: DataFrame, key: str, cursor: int | str | None = None, size: int = 10) -> DataFrame:
    """The next ``size`` rows behind a cursor; the comparison reaches the Parquet scan."""
    if cursor is not None:
        df = df.where(F.col(key) > F.lit(cursor))
    return df.orderBy(key).limit(size)


def page_bounds(df: DataFrame, key: str, size: int = 10) -> DataFrame:
    """Every page of a full cursor walk: page number, first and last key, row count."""
    numbered = global_row_number(df.select(key), key)
    return (numbered.groupBy(F.floor((F.col("row_no") - 1) / size).alias("page_no"))
            .agg(F.min(key).alias("first_key"), F.max(key).alias("last_key"), F.count(F.lit(1)).alias("n_rows")))


def first_rows(df: DataFrame, order: str, n: int | None) -> DataFrame:
    """First ``n`` rows in order, all rows when ``n`` is None."""
    return df if n is None else df.orderBy(order).limit(n)


def head_and_rest(df: DataFrame, key: str, n: int) -> DataFrame:
    """Mark the first ``n`` rows of a unique key as ``valid`` and the others as ``train``.

    Only the cut key is looked up (a top-n of one column), so no row number is needed.
    """
    cut = df.select(key).orderBy(key).limit(n).agg(F.max(key).alias("_cut"))
    (last,) = cut.first()
    split = F.lit("train") if last is None else F.when(F.col(key) <= F.lit(last), "valid").otherwise("train")
    return df.withColumn("split", split)


def shuffled(df: DataFrame, key: str, seed: int) -> DataFrame:
    """Repeatable full shuffle: a global sort by a seeded hash of the key."""
    return df.withColumn("_h", stable_hash(seed, F.col(key))).orderBy("_h", key).drop("_h")


def shuffle_position(df: DataFrame, key: str, seed: int, name: str = "position") -> DataFrame:
    """Zero-based position of each row in the seeded shuffle."""
    order = df.withColumn("_order", stable_hash(seed, F.col(key)))
    return global_row_number(order, "_order", name, tie=key).withColumn(name, F.col(name) - 1).drop("_order")


def split_by_hash(key: Column, seed: int, test_percent: int = 25) -> Column:
    return F.when(stable_hash(seed, key) % 100 < test_percent, "test").otherwise("train")


def global_batches(df: DataFrame, key: str, batch_size: int, workers: int) -> DataFrame:
    """Batch number in key order and the worker that takes each row of a batch."""
    per_worker = batch_size // workers
    numbered = global_row_number(df, key)
    position = F.col("row_no") - 1
    return numbered.withColumns({
        "batch_no": F.floor(position / batch_size),
        "worker": F.least(F.floor((position % batch_size) / per_worker), F.lit(workers - 1)).cast("int"),
    }).drop("row_no")


def epochs(df: DataFrame, n: int) -> DataFrame:
    """Every row once per epoch."""
    return df.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(n))))
