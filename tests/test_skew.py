"""One key holds a third of all rows: the skew-safe plans stay exact and
spread the hot key's work over many small groups."""

from pyspark.sql import Window, functions as F

from martflow.operators import joins, traffic

DAY = 86_400_000


def _skewed(spark, n_hot=9_000, n_cold=18_000):
    hot = spark.range(n_hot).select(
        F.col("id").alias("seq"), F.lit("hot").alias("mid"),
        (F.lit(1_700_000_000_000) + F.col("id") * 7_000).alias("ts"),
        ((F.col("id") % 3) == 0).alias("is_entry"),
        F.when(F.col("id") % 5 == 0, "1").otherwise("0").alias("is_new"))
    cold = spark.range(n_cold).select(
        (F.col("id") + n_hot).alias("seq"), F.concat(F.lit("c"), (F.col("id") % 3000).cast("string")).alias("mid"),
        (F.lit(1_700_000_000_000) + F.col("id") * 3_333).alias("ts"),
        ((F.col("id") % 2) == 0).alias("is_entry"),
        F.when(F.col("id") % 7 == 0, "1").otherwise("0").alias("is_new"))
    return hot.unionByName(cold)


def test_hot_key_user_jump_and_unique_visitor(spark):
    df = _skewed(spark)
    w = Window.partitionBy("mid").orderBy("ts", "seq")
    x = df.withColumn("nts", F.lead("ts").over(w)).withColumn("nen", F.lead("is_entry").over(w))
    naive = x.filter(F.col("is_entry") & (F.col("nts").isNull() | (F.col("nts") - F.col("ts") >= 15_000)
                                          | F.col("nen")))
    fast = traffic.user_jump(df, F.col("is_entry"), order=["ts", "seq"])
    assert sorted(r.seq for r in fast.collect()) == sorted(r.seq for r in naive.collect())
    # the largest window group of the bucketed plan is tiny next to the hot key
    groups = df.groupBy("mid", F.floor(F.col("ts") / 15_000)).count()
    assert groups.agg(F.max("count")).first()[0] + 1 <= 4
    d = F.date_format(F.timestamp_millis("ts"), "yyyy-MM-dd")
    y = df.withColumn("d", d).withColumn("p", F.lag(d).over(w))
    naive3 = y.filter(F.col("p").isNull() | (F.col("p") != F.col("d")))
    fast3 = traffic.unique_visitor(df, order=["ts", "seq"])
    assert sorted(r.seq for r in fast3.collect()) == sorted(r.seq for r in naive3.collect())


def test_hot_key_visitor_repair(spark):
    df = _skewed(spark)
    w = Window.partitionBy("mid").orderBy("ts", "seq")
    day = F.date_format(F.timestamp_millis("ts"), "yyyy-MM-dd")
    seed = F.when(F.col("is_new") == "1", day).otherwise(
        F.date_format(F.timestamp_millis(F.col("ts") - DAY), "yyyy-MM-dd"))
    naive = df.withColumn("f", F.first(seed).over(w.rowsBetween(Window.unboundedPreceding, 0))) \
        .select("seq", F.when((F.col("is_new") == "1") & (day != F.col("f")), "0")
                .otherwise(F.col("is_new")).alias("is_new"))
    fast = traffic.repair_new_visitor(df, order=["ts", "seq"]).select("seq", "is_new")
    assert sorted(map(tuple, fast.collect())) == sorted(map(tuple, naive.collect()))


def test_hot_key_interval_join(spark):
    df = _skewed(spark, 3_000, 6_000)
    left = df.filter("is_entry").select(F.col("seq").alias("lid"), F.col("mid").alias("lk"), F.col("ts").alias("lts"))
    right = df.filter("not is_entry").select(F.col("seq").alias("rid"), F.col("mid").alias("rk"),
                                             F.col("ts").alias("rts"))
    fast = joins.interval_join(left, right, "lk", "rk", "lts", "rts", -10_000, 10_000)
    naive = left.join(right, (left.lk == right.rk) & right.rts.between(left.lts - 10_000, left.lts + 10_000))
    assert sorted((r.lid, r.rid) for r in fast.collect()) == sorted((r.lid, r.rid) for r in naive.collect())


def test_repair_joins_flagged_rows_by_day_and_ignores_input_order(spark):
    # the same rows in any order and partitioning give the same flags: no random salt decides
    df = _skewed(spark)
    want = sorted(map(tuple, traffic.repair_new_visitor(df, order=["ts", "seq"]).select("seq", "is_new").collect()))
    for n, by in ((3, F.xxhash64("seq")), (7, F.col("ts"))):
        shuffled = df.repartition(n, by)
        r = traffic.repair_new_visitor(shuffled, order=["ts", "seq"]).select("seq", "is_new")
        assert sorted(map(tuple, r.collect())) == want
    # building the plan runs nothing: an input that fails when read is only met at the action
    broken = df.withColumn("ts", F.raise_error(F.lit("read")).cast("long"))
    traffic.repair_new_visitor(broken, order=["ts", "seq"])


def test_bucketed_lag_matches_window_lag(spark):
    import random
    from martflow.operators.sequence import bucketed_lag
    rnd = random.Random(5)
    rows = [(rnd.choice(["hot", "hot", "hot", "a", "b"]), rnd.randint(0, 5000), i, rnd.randint(1, 50))
            for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, t long, s long, v long")
    w = Window.partitionBy("k").orderBy("t", "s")
    want = {r.s: (r.p, r.p is not None or r.rn > 1) for r in
            df.withColumn("p", F.lag("v").over(w)).withColumn("rn", F.row_number().over(w)).collect()}
    for width in (1, 37, 1000, 10_000):
        got = bucketed_lag(df, ["k"], ["t", "s"], F.floor(F.col("t") / width), "v", "p", has_prev="h")
        assert {r.s: (r.p, r.h) for r in got.collect()} == want, width
