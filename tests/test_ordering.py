import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from foliospark.operators import ordering


def test_row_numbers_over_many_segments(spark):
    ids = random.Random(1).sample(range(10_000), 900)
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    for rows in (1, 7, 100, 5000):
        got = ordering.global_row_number(df, "id", rows_per_segment=rows).collect()
        assert {r.id: r.row_no for r in got} == {i: n + 1 for n, i in enumerate(sorted(ids))}


def test_row_numbers_with_a_hot_key(spark):
    df = spark.createDataFrame([(1 if i % 3 else i, i) for i in range(600)], "k long, id long")
    got = ordering.global_row_number(df, "k", tie="id", rows_per_segment=50).collect()
    assert [r.id for r in sorted(got, key=lambda r: r.row_no)] == [r.id for r in sorted(got, key=lambda r: (r.k, r.id))]


def test_running_totals(spark):
    values = random.Random(2).sample(range(5000), 400)
    df = spark.createDataFrame([(v, v % 7) for v in values], "k long, n long")
    got = {r.k: r.total for r in ordering.running_totals(df, "k", {"total": "n"}, rows_per_segment=9).collect()}
    total, want = 0, {}
    for v in sorted(values):
        total += v % 7
        want[v] = total
    assert got == want


def test_the_plan_does_not_grow_with_the_rows(spark):
    df = spark.range(5000).withColumnRenamed("id", "k").withColumn("n", F.lit(1))

    def size(frame):
        return len(frame._jdf.queryExecution().optimizedPlan().toString())

    few, many = (size(ordering.global_row_number(df, "k", rows_per_segment=r)) for r in (1000, 20))
    assert abs(few - many) < 200
    few, many = (size(ordering.running_totals(df, "k", {"t": "n"}, rows_per_segment=r)) for r in (1000, 20))
    assert abs(few - many) < 200


def test_positions_of_groups_of_any_length_and_gaps(spark):
    rng = random.Random(8)
    rows = [(g, t) for g, n in ((1, 300), (2, 3), (3, 90), (None, 40)) for t in rng.sample(range(10**15), n)]
    df = spark.createDataFrame(rows, "g long, t long")
    want = {(g, t): i for g in (1, 2, 3, None) for i, t in enumerate(sorted(t for h, t in rows if h == g))}
    for piece in (4096, 25):
        assert {(r.g, r.t): r.position for r in ordering.with_position(df, "g", "t", piece=piece).collect() if r.g} == {k: v for k, v in want.items() if k[0]}


def test_halo_gives_each_window_its_neighbours(spark):
    df = spark.createDataFrame([(g, t) for g in (1, 2) for t in range(-1, 40) if t % 5 != 3], "g long, t long")
    wide = Window.partitionBy("g").orderBy("t").rangeBetween(-2, 1)
    want = df.select("g", "t", F.collect_list("t").over(wide).alias("w")).collect()
    cut = ordering.with_halo(df, "t", 4, before=2, after=1)
    got = cut.select("g", "t", "_halo", F.collect_list("t").over(
        Window.partitionBy("g", "_piece").orderBy("t").rangeBetween(-2, 1)).alias("w")).where("not _halo").drop("_halo").collect()
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_carry_forward(spark):
    rng = random.Random(3)
    rows = [(rng.randint(0, 2), t, t // 10, rng.choice([None, None, f"v{t}"])) for t in range(200)]
    df = spark.createDataFrame(rows, "g long, t long, piece long, own string")
    got = ordering.carry_forward(df, ["g"], ["t"], "piece", {"value": "own"}, number="n").collect()
    for g in range(3):
        last, n = None, 0
        for r in sorted((r for r in got if r.g == g), key=lambda r: r.t):
            last, n = r.own or last, n + 1
            assert (r.value, r.n) == (last, n)


def test_pages_batches_splits(spark):
    df = spark.range(103).withColumnRenamed("id", "k")
    assert [r.k for r in ordering.keyset_page(df, "k", 50, 3).collect()] == [51, 52, 53]
    assert [r.k for r in ordering.keyset_page(df, "k", None, 2).collect()] == [0, 1]
    assert ordering.page_bounds(df, "k", 10).count() == 11
    assert ordering.head_and_rest(df, "k", 5).where("split = 'valid'").count() == 5
    assert ordering.head_and_rest(df.limit(0), "k", 5).count() == 0
    assert ordering.first_rows(df, "k", None).count() == 103
    order = [r.k for r in ordering.shuffled(df, "k", 1).collect()]
    assert sorted(order) == list(range(103)) and order != sorted(order)
    assert order == [r.k for r in ordering.shuffled(df.repartition(7), "k", 1).collect()]
    position = {r.k: r.position for r in ordering.shuffle_position(df, "k", 1).collect()}
    assert [position[k] for k in order] == list(range(103))
