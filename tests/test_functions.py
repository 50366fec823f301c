import pytest
from pyspark.sql import functions as F

from veracast.functions import buckets, numeric, score, sentiment, text, timeparse
from veracast.operators.api_items import add_rule_labels


def values(spark, given, expression, kind="string"):
    rows = spark.createDataFrame(list(enumerate(given)), f"n int, v {kind}")
    return [row[1] for row in rows.select("n", expression(F.col("v"))).orderBy("n").collect()]


def test_numbers(spark):
    given = ["7", " 7 ", "1.5", "x", None, "3000000000", "NaN"]
    assert values(spark, given, numeric.safe_int) == [7, 7, 0, 0, 0, 3000000000, 0]
    assert values(spark, given, lambda v: numeric.to_float(v, 0.5)) == [7.0, 7.0, 1.5, 0.5, 0.5, 3e9, 0.5]
    assert values(spark, [1.9, -0.4], numeric.safe_int, "double") == [1, 0]
    assert values(spark, [0.125, 0.124], lambda v: numeric.half_up(v, 2), "double") == [0.13, 0.12]
    assert values(spark, ["50", "0.4", None], score.normalize_unit_score) == [0.5, 0.4, 0.5]


def test_timestamps(spark):
    given = ["1704067200", "1704067200999", "2024-01-01T07:00:00+07:00", "2024-01-01", "2024-01-01 00:00:00.5Z", "soon", "", None]
    new_year = "2024-01-01T00:00:00Z"
    assert values(spark, given, timeparse.normalize_timestamp) == [new_year] * 5 + ["soon", "", ""]
    typed = values(spark, given, timeparse.parse_timestamp)
    assert len(set(typed[:5])) == 1 and typed[5:] == [None] * 3


def python_repair(value):
    if not any(marker in value for marker in text.MOJIBAKE_MARKERS):
        return value
    try:
        return value.encode("cp1252").decode("utf-8") or value
    except UnicodeError:
        return value


def test_mojibake(spark):
    given = ["Tiáº¿ng Viá»‡t", "Ã©tÃ©", "Ã© đ", "Ä\u0091", "plain", "Ã  la", "Ã©ç", "chào", "â€œÃ©â€\u009d"]
    assert values(spark, given, text.repair_mojibake) == [python_repair(value) for value in given]


def test_hashtags(spark):
    rows = spark.createDataFrame(
        [(["#a", "b", "a", ""], "x #c"), (None, "see #Đẹp, #b.c #b")], "tags array<string>, caption string"
    )
    shown = rows.select(text.format_hashtags(F.col("tags"), F.col("caption"), F.lit(""))).collect()
    assert [row[0] for row in shown] == ["a,b", "Đẹp,b"]
    texts = spark.createDataFrame([("#a , b,#a", "")], "tags string, caption string")
    assert texts.select(text.format_hashtags(F.col("tags"), F.col("caption"), F.lit(""), False)).first()[0] == "a,b"


def test_category(spark):
    rows = spark.createDataFrame([("Unknown", "my daily vlog"), (" Food ", "x"), (None, "zzz"), (None, "music tour")], "c string, t string")
    named = text.with_category(rows, F.col("c"), F.lower("t")).collect()
    assert [row["category"] for row in named] == ["technology", "food", "unknown", "music"]


def brute_sentiment(value):
    import re

    if not value.strip():
        return 50.0
    folded = re.sub(r"\s+", " ", value.casefold()).strip()
    tokens = re.findall(r"[\wÀ-ỹ]+", folded)

    def hits(terms):
        total = 0
        for place, token in enumerate(tokens):
            if " " not in token and token in terms:
                negated = any(t in sentiment.NEGATION_TERMS for t in tokens[max(0, place - 3) : place])
                total += -1 if negated else 1
        return total + sum(f" {term} " in f" {folded} " for term in terms if " " in term)

    return float(max(0, min(100, 50 + 20 * (hits(sentiment.POSITIVE_TERMS) - hits(sentiment.NEGATIVE_TERMS)))))


def test_comment_sentiment(spark):
    given = [
        "rất hay", "không hay", "", "  ", "GOOD,good not a b good", "not a b c good", "bad do te", "lừa  đảo quá tệ",
        "k no not good bad", "cảm ơn bạn", "Đỉnh!", "goodness", "x_good good_", "good. good! no good", "not not good great best",
    ]
    rows = spark.createDataFrame(list(enumerate(given)), "n int, t string")
    scored = sentiment.with_comment_sentiment(rows, F.col("t")).orderBy("n").collect()
    assert [row["s"]["score"] for row in scored] == [brute_sentiment(value) for value in given]
    assert scored[0]["s"]["score"] == 90.0 and scored[0]["s"]["label"] == "positive"
    assert scored[1]["s"]["score"] == 30.0 and scored[1]["s"]["label"] == "negative"


def test_unit_sentiment(spark):
    rows = spark.createDataFrame([("great trust",), (None,), ("scam",), ("ok",)], "t string")
    got = [row["u"] for row in sentiment.with_unit_sentiment(rows, F.col("t"), "u").collect()]
    assert got == pytest.approx([0.5 + 2 / 4 * 0.5, 0.5, 0.375, 0.5])


def test_rule_scores(spark):
    rows = spark.createDataFrame([(1000, 40, 10), (200000, 0, 4)], "view_count bigint, like_count bigint, comment_count bigint")
    first, second = add_rule_labels(rows, F.lit(50.0)).collect()
    assert (first["engagement_rate"], first["trust_score"], first["is_suspicious"]) == (0.05, 40.2, 0)
    assert (second["engagement_rate"], second["trust_score"], second["is_suspicious"]) == (0.00002, 15.09, 1)
    tiktok = spark.range(1).select(score.rule_trust(F.lit(0.1), F.lit(50.0), F.lit(6.0))).first()[0]
    assert tiktok == 66.2


def test_splits(spark):
    import hashlib

    keys = [("youtube", "UC1"), ("tiktok", "x"), ("youtube", "")]
    rows = spark.createDataFrame(keys, "p string, c string")
    names = [row[0] for row in rows.select(buckets.split_name(F.col("p"), F.col("c"))).collect()]
    numbers = [int(hashlib.sha256(f"{p}:{c}".encode()).hexdigest()[:8], 16) % 10 for p, c in keys]
    assert names == ["train" if n < 6 else "eval" if n < 8 else "analysis_profile" for n in numbers]
    assert numbers[0] == 7
