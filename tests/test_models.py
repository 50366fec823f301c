import pytest
from pyspark.sql import functions as F

from veracast.ml import formula, sentiment, store, trust
from veracast.plans import scoring
from veracast.schemas import TRUST_NUMERIC_FEATURES


def test_sentiment_model(spark, tmp_path):
    rows = [("tuyệt vời good clip", "2"), ("good great", "pos"), ("awful bad", "neg"), ("bad scam", "0"), ("it is a clip", "1"), ("a plain clip", "neu")]
    table = spark.createDataFrame([(t, l, False) for t, l in rows * 3] + [("f" * 64, "pos", True)], "comment string, sentiment string, comment_text_is_hashed boolean")
    labelled = sentiment.labelled_texts(table)
    assert labelled.count() == 18
    model = sentiment.train_sentiment(labelled, term_space=256)
    scored = {row["comment"]: row for row in sentiment.predict_sentiment(table, model=model).collect()}
    assert scored["good great"]["pred_sentiment_score"] > scored["bad scam"]["pred_sentiment_score"]
    assert scored["good great"]["pred_sentiment_source"] == "trained_model"
    report = sentiment.classification_report(sentiment.predict_labels(labelled, model)).collect()
    assert {row["class"] for row in report} == {"negative", "neutral", "positive"} and all(row["recall"] == 1.0 for row in report)
    with pytest.raises(ValueError):
        sentiment.train_sentiment(labelled.limit(3))
    summary = sentiment.report_summary(sentiment.predict_labels(labelled, model)).first()
    assert (summary["accuracy"], summary["macro_f1"], summary["weighted_recall"], summary["support"]) == (1.0, 1.0, 1.0, 18)
    # Saved and loaded again, the model gives the same scores.
    folder = str(tmp_path / "sentiment")
    store.save_model(model, folder, "sentiment", "random", sentiment.classification_report(sentiment.predict_labels(labelled, model)))
    loaded, notes = store.load_model(spark, folder)
    again = {row["comment"]: row["pred_sentiment_score"] for row in sentiment.predict_sentiment(table, model=loaded).collect()}
    assert again == {text: row["pred_sentiment_score"] for text, row in scored.items()}
    assert notes["kind"] == "sentiment" and notes["notice"] == store.NOTICE and len(notes["metrics"]) == 3


def test_sentiment_fit_reads_stored_counts_of_terms(spark, monkeypatch):
    stored, fitted_on = [], []
    store_rows, fit = sentiment.cut_lineage, sentiment.Pipeline.fit
    monkeypatch.setattr(sentiment, "cut_lineage", lambda rows: stored.append(rows.columns) or store_rows(rows))
    monkeypatch.setattr(sentiment.Pipeline, "fit", lambda self, rows: fitted_on.append(rows) or fit(self, rows))
    texts = [("tuyệt vời good clip", "positive"), ("good great", "positive"), ("awful bad clip", "negative"), ("", "neutral"), ("it is it is", "neutral"), ("it is", "neutral")]
    rows = spark.createDataFrame(texts * 4, "text string, label_name string")
    model = sentiment.train_sentiment(rows, term_space=64)
    assert stored == [["label_name", "counts"]]
    # No text is cut or hashed again under the fits.
    plan = fitted_on[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "UDF" not in plan and "parquet" in plan
    # The same model as from all stages in a row over the texts.
    weights = {"positive": 24 / (3 * 8), "negative": 24 / (3 * 4), "neutral": 24 / (3 * 12)}
    weight = F.create_map(*[F.lit(part) for pair in weights.items() for part in pair])[F.col("label_name")]
    plain = rows.select(sentiment._plain(F.col("text")).alias("plain"), "label_name", weight.alias("weight"))
    labels, *counting = model.stages[:5]
    estimators = [
        sentiment.IDF(inputCol="counts", outputCol="weighted"), model.stages[6],
        sentiment.LogisticRegression(labelCol="label", weightCol="weight", maxIter=sentiment.MAX_ITERATIONS, regParam=1 / 24, tol=sentiment.TOLERANCE, family="multinomial", standardization=False),
    ]
    whole = fit(sentiment.Pipeline(stages=[labels, *counting, *estimators]), plain)
    assert [type(stage) for stage in model.stages] == [type(stage) for stage in whole.stages]
    assert model.stages[5].docFreq == whole.stages[5].docFreq
    assert model.stages[-1].coefficientMatrix.toArray() == pytest.approx(whole.stages[-1].coefficientMatrix.toArray(), abs=1e-9)


def test_creators_stay_in_one_split(spark):
    rows = spark.range(400).select(F.lit("youtube").alias("platform"), (F.col("id") % 40).cast("string").alias("creator_id"),
                                   F.lit("good").alias("comment"), F.lit("pos").alias("sentiment"))
    train, test = sentiment.creator_split(sentiment.labelled_texts(rows))
    sides = [{row["creator_id"] for row in part.collect()} for part in (train, test)]
    assert sides[0] and sides[1] and not sides[0] & sides[1]


def test_trust_model(spark):
    rows = spark.range(200).select(
        *[(F.col("id") * (n + 1) % 17).cast("double").alias(name) for n, name in enumerate(TRUST_NUMERIC_FEATURES)],
        F.when(F.col("id") % 2 == 0, "youtube").otherwise("tiktok").alias("platform"), (F.col("id") % 17 * 5.0).alias("trust_score"),
    )
    model = trust.train_trust(rows, trees=5)
    figures = trust.evaluate_trust(model, rows).first()
    assert figures["rows"] == 200 and figures["r2"] > 0.5
    events = spark.createDataFrame([("a", 100, 5)], "kol_id string, views int, likes int")
    row = scoring.score_events(events, trust_model=model).first()
    assert row["trust_source"] == "trained_model" and 0 <= row["trust_score"] <= 100


def test_rows_of_the_forest_keep_their_nodes_and_the_forest_stays_the_same(spark):
    rows = spark.range(300).select(
        *[(F.xxhash64("id", F.lit(n)) % 23).cast("double").alias(name) for n, name in enumerate(TRUST_NUMERIC_FEATURES)],
        F.when(F.col("id") % 3 == 0, "youtube").otherwise("tiktok").alias("platform"), (F.col("id") * 7 % 101).cast("double").alias("trust_score"),
    ).localCheckpoint()
    model = trust.train_trust(rows, trees=6)
    forest = model.stages[-1]
    assert forest.getCacheNodeIds()
    vectors = trust.PipelineModel(model.stages[:-1]).transform(trust.cut_lineage(trust.balanced(trust.prepare(rows))))
    walked = trust.RandomForestRegressor(
        featuresCol="vector", labelCol="target", numTrees=6, maxDepth=trust.DEPTH, minInstancesPerNode=trust.MIN_LEAF, seed=trust.SEED, maxMemoryInMB=trust.NODE_STATS_MB
    ).fit(vectors)
    assert not walked.getCacheNodeIds()
    assert [tree.toDebugString.split("\n", 1)[1] for tree in forest.trees] == [tree.toDebugString.split("\n", 1)[1] for tree in walked.trees]


def test_models_by_formula(spark, tmp_path):
    """They are saved, loaded and applied as trained models are."""
    folder = str(tmp_path / "trust")
    none = spark.createDataFrame([], "measure string, value double")
    store.save_model(formula.trust_formula("1.0 * view_count + if(platform = 'tiktok', 5, 0)"), folder, "trust", "none", none)
    model, notes = store.load_model(spark, folder)
    events = spark.createDataFrame([("a", "tiktok", 40), ("b", None, 500), ("c", None, None)], "kol_id string, platform string, views int")
    rows = {r["kol_id"]: (r["trust_score"], r["trust_source"]) for r in scoring.score_events(events, trust_model=model).collect()}
    assert rows == {"a": (45.0, "trained_model"), "b": (100.0, "trained_model"), "c": (0.0, "trained_model")} and notes["kind"] == "trust"
    empty = scoring.score_events(events, trust_model=formula.trust_formula("NULL")).collect()
    assert {r["trust_source"] for r in empty} == {"rule_fallback"}
    chances = {"positive": "if(plain LIKE '%tot%', 1, 0)", "neutral": "if(plain LIKE '%tot%', 0, 1)", "negative": "0"}
    texts = spark.createDataFrame([("Tốt",), ("x",), ("",), (None,)], "comment string")
    scored = sentiment.predict_sentiment(texts, model=formula.sentiment_formula(chances)).collect()
    assert [(r["pred_sentiment_label"], r["pred_sentiment_score"], r["pred_sentiment_source"]) for r in scored] == [
        ("positive", 0.85, "trained_model"), ("neutral", 0.5, "trained_model"), ("neutral", 0.5, "rule_fallback"), ("neutral", 0.5, "rule_fallback")]
    predicted = sentiment.predict_labels(texts.withColumnRenamed("comment", "text"), formula.sentiment_formula(chances)).collect()
    assert [r["predicted"] for r in predicted][:2] == ["positive", "neutral"]
