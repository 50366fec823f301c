from pyspark.sql import functions as F

from veracast.operators import keyed, stats


def test_dedupe_latest(spark):
    rows = spark.createDataFrame([("a", 1, 1), ("b", 2, 2), ("a", 3, 3), ("", 4, 4), (None, 5, 5)], "id string, v int, seq int")
    got = {row["id"]: (row["v"], row["first_seq"]) for row in keyed.dedupe_latest(rows, "id").collect()}
    assert got == {"a": (3, 1), "b": (2, 2)}
    counts = keyed.id_counts(rows, "id", F.col("v") > 2).first()
    assert (counts["raw_rows"], counts["duplicate_rows"], counts["distinct_ids"], counts["removed_ids"]) == (5, 1, 2, 1)


def test_last_n_with_a_hot_key(spark):
    rows = spark.range(3000, numPartitions=7).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 11).cast("string"))).alias("k"),
        ((F.col("id") * 7919) % 3001).alias("t"),
    )
    got = keyed.last_n(rows, ["k"], [F.desc("t")], 20).collect()
    expected = {}
    for row in rows.collect():
        expected.setdefault(row["k"], []).append(row["t"])
    wanted = {(k, t, n + 1) for k, ts in expected.items() for n, t in enumerate(sorted(ts, reverse=True)[:20])}
    assert {(row["k"], row["t"], row["recency"]) for row in got} == wanted and len(got) == len(wanted)


def test_attach_keeps_every_row(spark, monkeypatch):
    monkeypatch.setattr(keyed, "HOT_KEYS", 2)
    rows = spark.range(900).select(
        F.col("id").alias("row"),
        F.when(F.col("id") < 300, "hot").when(F.col("id") < 350, "lost").when(F.col("id") < 360, None)
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 9).cast("string"))).alias("k"),
    )
    lookup = spark.createDataFrame([("hot", 1), *[(f"k{n}", n) for n in range(8)]], "k string, v int")
    got = {row["row"]: row["v"] for row in keyed.attach_per_key(rows, lookup, ["k"], ["row"]).collect()}
    values = {"hot": 1, **{f"k{n}": n for n in range(8)}}
    assert got == {row["row"]: values.get(row["k"]) for row in rows.collect()}


def test_global_rank(spark):
    rows = spark.range(500, numPartitions=5).select("id", (F.col("id") % 13).alias("s"))
    ranked = keyed.global_rank(rows, [F.desc("s"), F.col("id")]).collect()
    order = sorted(((-row["s"], row["id"]) for row in rows.collect()))
    assert [row["id"] for row in sorted(ranked, key=lambda row: row["rank"])] == [pair[1] for pair in order]
    assert sorted(row["rank"] for row in ranked) == list(range(1, 501))


def test_plans(spark):
    """Last-N limits rows before its shuffles; dedupe combines before its one."""
    rows = spark.range(100).select((F.col("id") % 5).alias("k"), F.col("id").alias("t"))
    plan = keyed.last_n(rows, ["k"], [F.desc("t")], 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Partial") >= 1 and "WindowGroupLimit" in plan
    plan = keyed.dedupe_latest(rows.withColumn("seq", F.col("t")), "k")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_max_by" in plan


def test_newest_rows_are_cut_before_they_move(spark):
    """A hot key leaves every input partition with n rows at most."""
    rows = spark.range(20000).select((F.col("id") % 1000 == 0).cast("int").alias("k"), F.col("id").alias("t")).repartition(6)
    newest = keyed.last_n(rows, ["k"], [F.desc("t")], 7)
    assert sorted((r.k, r.t, r.recency) for r in newest.collect()) == sorted(
        (k, t, n) for k, own in ((0, range(19999, 19992, -1)), (1, range(19000, 12000, -1000))) for n, t in enumerate(own, 1)
    )
    plan = newest._jdf.queryExecution().executedPlan().toString()
    first = plan[plan.rindex("Exchange hashpartitioning(k"):]
    assert "WindowGroupLimit" in first and "Partial" in first


def test_observed_groups_of_a_deduplication(spark):
    """What the groups show does not change which rows stay."""
    data = [("a", 1, 5), ("a", 2, 0), ("b", 3, 0), (None, 4, 9), ("", 5, 9), ("c", 6, 1), ("c", 7, 2)]
    rows = spark.createDataFrame(data, "id string, seq int, views int").repartition(3)
    kept = F.col("views") > 0
    plain = keyed.dedupe_latest(rows, "id", kept=kept)
    figures = stats.BuildFigures()
    seen = keyed.dedupe_latest(rows, "id", kept=kept, watch=figures.raw("videos", True))
    expected = [("a", 1, 5, 1), ("c", 7, 2, 6)]
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, seen.collect())) == expected
    measured = {(r.section, r.metric): r.value for r in figures.rows(spark).collect()}
    assert measured == {("raw", "videos"): 7, ("quality", "duplicate_videos_removed"): 2, ("quality", "removed_zero_view_videos"): 1}
