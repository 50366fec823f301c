"""Plans whose work must not grow faster than their input."""

import json
import re
from types import SimpleNamespace

from pyspark.sql import functions as F

from veracast.functions import sentiment, text
from veracast.functions.sentiment import with_comment_sentiment
from veracast.ml import sentiment as sentiment_ml
from veracast.operators import keyed, quality, silver
from veracast.plans import api, catalogue
from veracast.sources import writers
from veracast.streaming.scoring import score_stream


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def event_records(spark, payloads):
    rows = [(json.dumps(p), "t", 0, n, None) for n, p in enumerate(payloads)]
    table = spark.createDataFrame(rows, "value string, topic string, partition int, offset bigint, timestamp timestamp")
    return table.withColumn("value", F.col("value").cast("binary"))


def test_alerts_parse_each_record_once(spark):
    calm = [{"kol_id": f"c{n}", "video_id": "v", "timestamp": f"2024-01-0{n + 1}T00:00:00", "views": 100, "likes": 1, "text": "good", "upload_frequency_7d": 7} for n in range(3)]
    wild = [{"kol_id": f"w{n}", "video_id": "v", "timestamp": f"2024-01-0{n + 1}T00:00:00", "views": 1, "comment_spam_ratio": 1.0, "follower_growth_rate": 2.0} for n in range(3)]
    rows = api.alerts(score_stream(event_records(spark, calm + wild)), 5)
    assert [row["kol_id"] for row in rows.collect()] == ["w2", "w1", "w0"]
    assert [row["kol_id"] for row in api.alerts(score_stream(event_records(spark, calm + wild)), 2).collect()] == ["w2", "w1"]
    assert plan_of(rows).count("from_json") == 1


def comments(spark):
    texts = ["không good clip", "good  great\u2009x", "not a b c bad", "ko a b bad P N X", "cảm ơn \u3000k\u1680tot", "", None, "qua hay; te, de thuong"]
    rows = [("youtube", f"UC{n}", f"v{n}", text, n == 2, label, score, source)
            for n, text in enumerate(texts)
            for label, score, source in ((None, None, None), ("negative", 0.0, "imported"), ("positive", 80.0, "own"), (None, 1.0, "imported"), ("neutral", 1.0, None))]
    table = spark.createDataFrame(
        rows, "platform string, channel_id string, video_id string, comment_text string, comment_text_is_hashed boolean, comment_sentiment string, comment_sentiment_score double, comment_sentiment_source string"
    )
    more = ["comment_id", "parent_comment_id", "comment_author_display_name", "comment_author_channel_id", "comment_like_count", "comment_published_at", "collected_at"]
    return table.withColumns({**{name: F.lit("1") for name in more}, "is_reply": F.lit(False)})


def test_comments_are_scored_once_when_a_source_is_left_out(spark):
    raw = comments(spark)
    left = sentiment_ml.labelled_texts(silver.comment_sentiment_rows(silver.without_source(raw, "imported"), anonymize=False))
    finished = silver.comment_sentiment_rows(raw, anonymize=False).where(F.col("sentiment_source") != "imported")
    assert sorted(map(str, left.collect())) == sorted(map(str, sentiment_ml.labelled_texts(finished).collect()))
    once = plan_of(silver.comment_sentiment_rows(raw, anonymize=False)).count("regexp")
    assert plan_of(left).count("regexp") == once
    rows = spark.createDataFrame([(row["comment_text"],) for row in raw.where("comment_sentiment IS NULL AND comment_sentiment_score IS NULL").select("comment_text").collect()], "text string")
    scores = {row["text"]: row["s"] and row["s"]["score"] for row in with_comment_sentiment(rows, F.col("text")).collect()}
    assert scores == {"không good clip": 30, "good  great\u2009x": 90, "not a b c bad": 30, "ko a b bad P N X": 70, "cảm ơn \u3000k\u1680tot": 50, "": 50, None: None, "qua hay; te, de thuong": 70}


def test_the_guard_finds_every_blank_but_the_space():
    def in_python(pattern):
        return re.compile(re.sub(r"\\x\{([0-9a-f]+)\}", lambda code: chr(int(code[1], 16)), pattern), re.ASCII)

    guard, blanks = in_python(sentiment.ODD_BLANK), in_python(sentiment.BLANKS)
    letters = [chr(code) for code in range(0x110000) if not 0xD800 <= code < 0xE000]
    assert [c for c in letters if blanks.match(c) and not guard.match(c)] == [" "]
    assert not guard.search("Tiếng Việt cảm ơn 😀 “x”")


def test_a_larger_topic_has_more_files_not_larger_ones(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(catalogue, "_run_stream", lambda spark, records, files, compact_every=None: seen.update(files=files, parts=records.rdd.getNumPartitions()))
    monkeypatch.setattr(catalogue, "TOPIC_FILE_ROWS", 10)
    catalogue._run_batches(spark, spark.range(100).withColumnRenamed("id", "offset"), 2, least_files=2)
    assert seen == {"files": 5, "parts": 10}
    catalogue._run_batches(spark, spark.range(10).withColumnRenamed("id", "offset"), 6, least_files=1)
    assert seen == {"files": 1, "parts": 6}


def test_quality_report_takes_features_and_leaderboard_from_the_same_tables(spark, monkeypatch):
    seen, row = [], quality.missing_report(spark, "x")
    for name in ("_feature_report", "_trust_report"):
        monkeypatch.setattr(catalogue, name, lambda tables: seen.append(tables) or row)
    for name in ("quality_comments", "quality_raw_orders", "_event_lines"):
        monkeypatch.setattr(catalogue, name, lambda spark, sf_dir: row)
    monkeypatch.setattr(quality, "json_events_report", lambda lines: lines)
    catalogue.quality_report(spark, "none")
    assert len(seen) == 2 and seen[0] is seen[1]


def test_both_sides_of_the_sentiment_fit_come_from_one_stored_table(spark, monkeypatch):
    seen = []
    rows = spark.createDataFrame([("good", "positive"), ("bad", "negative")], "text string, label_name string")
    monkeypatch.setattr(catalogue, "_labelled_comments", lambda spark, sf_dir: rows)
    monkeypatch.setattr(sentiment_ml, "train_sentiment", lambda train: seen.append(train))
    monkeypatch.setattr(sentiment_ml, "predict_labels", lambda test, model: seen.append(test))
    monkeypatch.setattr(sentiment_ml, "classification_report", lambda rows: rows)
    catalogue.train_eval_sentiment(spark, "none")
    assert all("parquet" in plan_of(side) for side in seen) and sum(side.count() for side in seen) == 2


def largest_method(df):
    """Bytes of the largest method made for a plan; the JVM compiles none over 8,000."""
    text = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
    return max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", text)))


def test_repair_of_a_wide_table_stays_small_enough_to_be_compiled(spark):
    names = [f"t{n}" for n in range(20)]
    wide = spark.range(3).select("id", *[F.col("id").cast("string").alias(name) for name in names])
    assert 0 < largest_method(writers.cleaned(wide)) < 8000
    assert 0 < largest_method(wide.select("id", *[text.has_mojibake(F.col(name)) for name in names[:8]])) < 4000


def test_texts_of_a_row_are_repaired_together(spark):
    rows = [("Tiáº¿ng", None, 1, "plain"), (None, None, 2, "đ"), ("Ã©", "Ã© đ", 3, "Ä\u0091"), ("", "Ã", None, " "), (None, "a", 4, "Ã  la")]
    table = spark.createDataFrame(rows, "a string, b string, n int, c string")
    got = writers.cleaned(table, ["c", "a", "missing", "n", "b"])
    assert got.columns == ["c", "a", "missing", "n", "b"]
    each = table.select(*[text.repair_mojibake(F.col(name)).alias(name) for name in ("c", "a")], F.lit(None).alias("missing"), "n", text.repair_mojibake(F.col("b")).alias("b"))
    assert got.collect() == each.collect()
    assert writers.cleaned(table.select("n")).collect() == table.select("n").collect()
    shown = table.select([text.has_mojibake(F.col(name)) for name in ("a", "b", "c")]).collect()
    assert [[any(m in (v or "") for m in text.MOJIBAKE_MARKERS) for v in (a, b, c)] for a, b, _, c in rows] == [list(row) for row in shown]


def test_events_are_planned_only_when_their_turn_comes(spark):
    rows, none = spark.range(2), spark.range(0)
    asked = []
    assert keyed.first_non_empty(none, rows, lambda: asked.append(1)).count() == 2 and not asked
    assert keyed.first_non_empty(none, lambda: none, lambda: rows).count() == 2
    assert keyed.first_non_empty(none, none).count() == 0


def test_directory_leaves_the_features_alone_while_there_is_a_leaderboard(spark, monkeypatch):
    # Stand-in tables without features: asking for them is an error.
    monkeypatch.setattr(catalogue, "_tables", lambda spark, sf_dir: SimpleNamespace(leaderboard=spark.range(2)))
    monkeypatch.setattr(catalogue, "_scores", lambda spark, sf_dir: spark.range(3))
    monkeypatch.setattr(api, "available_scores", lambda scores, leaderboard, events: leaderboard)
    monkeypatch.setattr(api, "creator_directory", lambda scores: scores.select(F.lit(1).alias("reputation_score"), F.col("id").alias("kol_id")))
    assert [row["kol_id"] for row in catalogue.directory_from_leaderboard(spark, "none").collect()] == [0, 1]


def test_first_features_join_only_their_own_rows_with_all_content_of_their_creators(spark, monkeypatch):
    joined = []
    attach = silver.attach_per_key
    monkeypatch.setattr(silver, "attach_per_key", lambda rows, *more, **named: joined.append(rows.count()) or attach(rows, *more, **named))
    rows = [("youtube" if n % 3 else "tiktok", f"c{n % 5}" if n % 7 else None, f"x{n}", f"2024-01-{n + 1:02d}", None if n % 2 else n, None, n) for n in range(25)]
    content = spark.createDataFrame(rows, "platform string, creator_id string, content_id string, publish_time string, follower_count bigint, content_count bigint, first_seq bigint")
    sizes = spark.createDataFrame([("tiktok", "c1", 50, 5), ("youtube", "c2", 60, 6)], "platform string, creator_id string, _followers bigint, _contents bigint")
    monkeypatch.setattr(catalogue, "_tables", lambda spark, sf_dir: SimpleNamespace(stored_content=content, sizes=sizes))
    whole = silver.with_creators(content, sizes)
    first = catalogue._first_features(spark, "none", 7)
    assert joined == [25, 7]
    assert sorted(map(str, first.collect())) == sorted(map(str, api.export_features(whole, 7).collect()))


def test_a_token_is_looked_up_once_unless_it_is_a_term(spark):
    rows = spark.createDataFrame([(value,) for value in ("- not good!", "good", "...bad", "x, y; z", "", "no a b bad?")], "text string")
    codes = rows.select(sentiment._token_codes(F.col("text")).alias("codes"))
    assert [row["codes"].strip(".") for row in codes.collect()] == ["XP", "P", "N", "", "", "X..N"]
    assert plan_of(codes).count("regexp_replace") == 0
