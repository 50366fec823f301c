"""Comment sentiment model: n-gram TF-IDF and a class-balanced logistic regression."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, NGram, Normalizer, RegexTokenizer, SQLTransformer, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import clamp, half_up
from ..functions.sentiment import unit_label, with_unit_sentiment
from ..operators.gold import split_rows
from ..session import balanced, cut_lineage

# What a class is worth, and other spellings of the classes.
LABEL_TO_SCORE = {"negative": 0.15, "neutral": 0.50, "positive": 0.85}
LABEL_ALIASES = {"0": "negative", "1": "neutral", "2": "positive", "neg": "negative", "neu": "neutral", "pos": "positive"}

MEASURES = ("precision", "recall", "f1")
MIN_ROWS = 6
MAX_ITERATIONS = 1000
# The fit ends when ten iterations improve the loss by less than this share on average.
TOLERANCE = 1e-3
SEED = 42
TEST_SHARE = 0.25
# Words and word pairs hashed to one space need no vocabulary on the driver, so none has to be dropped.
TERM_SPACE = 1 << 18


def normalize_label(label: Column) -> Column:
    """One of the three class names; anything else is NULL."""
    text = F.lower(F.trim(label.cast("string")))
    named = F.create_map(*[F.lit(part) for pair in LABEL_ALIASES.items() for part in pair])
    full = F.coalesce(F.element_at(named, text), text)
    return F.when(full.isin(list(LABEL_TO_SCORE)), full)


def _plain(text: Column) -> Column:
    """Lower case without accents: decompose what matters for Latin script by a letter table."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    return F.translate(lowered, _ACCENTED, _BARE)


def _accent_table() -> tuple[str, str]:
    """Accented lower-case Latin letters and their base letters, from Unicode decompositions."""
    import unicodedata

    accented, bare = [], []
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        letter = chr(code)
        base = "".join(part for part in unicodedata.normalize("NFKD", letter) if not unicodedata.combining(part))
        if letter.islower() and len(base) == 1 and base != letter:
            accented.append(letter)
            bare.append(base)
    return "".join(accented), "".join(bare)


_ACCENTED, _BARE = _accent_table()


def labelled_texts(rows: DataFrame, text: str = "comment", label: str = "sentiment") -> DataFrame:
    """Training rows: text present and not hashed, label known. Hashes carry no sentiment, so
    hashed comments are refused rather than learned from."""
    if "comment_text_is_hashed" in rows.columns:
        rows = rows.where(~F.coalesce(F.col("comment_text_is_hashed"), F.lit(False)))
    named = normalize_label(F.col(label))
    kept = [name for name in ("platform", "creator_id") if name in rows.columns]
    return rows.where(F.trim(F.coalesce(F.col(text), F.lit(""))) != "").select(
        *kept,
        F.col(text).alias("text"),
        F.when(named.isNull(), F.raise_error(F.concat(F.lit("unsupported label: "), F.col(label).cast("string"))))
        .otherwise(named)
        .alias("label_name"),
    )


def creator_split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Train and eval rows by their creator's split, so that no creator is in both. The rows need
    `platform` and `creator_id`."""
    parts = split_rows(rows)
    return parts["train"], parts["eval"]


def stratified_split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """75/25 by a hash of the text, which draws the same share from every class."""
    part = F.pmod(F.xxhash64("text", F.lit(SEED)), F.lit(100))
    cut = int(TEST_SHARE * 100)
    return rows.where(part >= cut), rows.where(part < cut)


def train_sentiment(train: DataFrame, term_space: int = TERM_SPACE) -> PipelineModel:
    """Fit on (text, label_name) rows. Rare classes weigh more, in inverse proportion. Texts are cut and
    their terms hashed once: what the fits read many times are the stored counts of terms."""
    counting = [
        RegexTokenizer(inputCol="plain", outputCol="words", pattern=r"[\p{L}\p{N}_]{2,}", gaps=False),
        NGram(n=2, inputCol="words", outputCol="pairs"),
        SQLTransformer(statement="SELECT *, concat(words, pairs) AS terms FROM __THIS__"),
        HashingTF(inputCol="terms", outputCol="counts", numFeatures=term_space),
    ]
    texts = balanced(train).select(_plain(F.col("text")).alias("plain"), "label_name")
    counted = cut_lineage(PipelineModel(counting).transform(texts).select("label_name", "counts"))
    per_label = counted.groupBy("label_name").agg(F.count(F.lit(1)).alias("n"))
    # At most three classes come back.
    counts = {row["label_name"]: row["n"] for row in per_label.collect()}
    total = sum(counts.values())
    if total < MIN_ROWS:
        raise ValueError(f"need at least {MIN_ROWS} labelled comments, got {total}")
    weight = F.lit(0.0)
    for name, rows in counts.items():
        weight = F.when(F.col("label_name") == name, F.lit(total / (len(counts) * rows))).otherwise(weight)
    fitting = [
        StringIndexer(inputCol="label_name", outputCol="label", handleInvalid="error", stringOrderType="alphabetAsc"),
        IDF(inputCol="counts", outputCol="weighted"),
        Normalizer(inputCol="weighted", outputCol="features", p=2.0),
        LogisticRegression(
            featuresCol="features", labelCol="label", weightCol="weight", maxIter=MAX_ITERATIONS,
            regParam=1.0 / total, tol=TOLERANCE, family="multinomial", standardization=False,
        ),
    ]
    labels, *fitted = Pipeline(stages=fitting).fit(counted.withColumn("weight", weight)).stages
    return PipelineModel([labels, *counting, *fitted])


def _scoring_stages(model: PipelineModel) -> tuple[list[str], PipelineModel]:
    labels = model.stages[0].labels
    return labels, PipelineModel(model.stages[1:])


def text_scores(df: DataFrame, text: str, output: str, model: PipelineModel) -> DataFrame:
    """Adds the 0-1 score: class probabilities times what each class is worth."""
    labels, stages = _scoring_stages(model)
    keep = df.columns
    scored = stages.transform(df.withColumn("plain", _plain(F.col(text))))
    chances = vector_to_array(F.col("probability"))
    worth = F.lit(0.0)
    for index, name in enumerate(labels):
        worth = worth + chances[index] * F.lit(LABEL_TO_SCORE.get(name, 0.5))
    return scored.select(*keep, clamp(worth).alias(output))


def predict_sentiment(df: DataFrame, text: str = "comment", model: PipelineModel | None = None, prefix: str = "pred_") -> DataFrame:
    """Label, score and source per row; without a model the word rule scores the text."""
    if model is None:
        scored = with_unit_sentiment(df, F.col(text), "_score")
    else:
        scored = text_scores(df, text, "_score", model)
    blank = F.coalesce(F.col(text), F.lit("")) == ""
    score = F.when(blank, F.lit(0.5)).otherwise(F.col("_score"))
    source = F.when(blank | F.lit(model is None), "rule_fallback").otherwise("trained_model")
    return scored.select(
        *df.columns,
        unit_label(score).alias(f"{prefix}sentiment_label"),
        half_up(score, 6).alias(f"{prefix}sentiment_score"),
        source.alias(f"{prefix}sentiment_source"),
    )


def predict_labels(df: DataFrame, model: PipelineModel, text: str = "text") -> DataFrame:
    """Adds `predicted`, the most likely class name."""
    labels, stages = _scoring_stages(model)
    scored = stages.transform(df.withColumn("plain", _plain(F.col(text))))
    names = F.array(*[F.lit(name) for name in labels])
    return scored.select(*df.columns, names[F.col("prediction").cast("int")].alias("predicted"))


def _class_totals(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Support, claims, hits, precision, recall and F1 of each class, from the confusion counts."""
    pairs = df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )
    sides = pairs.select(
        F.explode(
            F.array(
                F.struct(F.col("actual").alias("class"), F.col("n").alias("support"), F.lit(0).alias("claimed")),
                F.struct(F.col("predicted").alias("class"), F.lit(0).alias("support"), F.col("n").alias("claimed")),
            )
        ).alias("s"),
        F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0).alias("hit"),
    )
    totals = sides.groupBy("s.class").agg(
        F.sum("s.support").alias("support"),
        F.sum("s.claimed").alias("claimed"),
        F.sum(F.when(F.col("s.support") > 0, F.col("hit")).otherwise(0)).alias("hits"),
    )
    precision = F.coalesce(F.try_divide("hits", "claimed"), F.lit(0.0))
    recall = F.coalesce(F.try_divide("hits", "support"), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(precision * recall * F.lit(2.0), precision + recall), F.lit(0.0))
    return totals.where(F.col("class").isNotNull()).withColumns({"precision": precision, "recall": recall, "f1": f1})


def classification_report(df: DataFrame, actual: str = "label_name", predicted: str = "predicted") -> DataFrame:
    """Precision, recall, F1 and support per class."""
    measures = [half_up(F.col(name), 4).alias(name) for name in MEASURES]
    return _class_totals(df, actual, predicted).select("class", *measures, "support")


def report_summary(df: DataFrame, actual: str = "label_name", predicted: str = "predicted") -> DataFrame:
    """The closing rows of the report as one: accuracy, and the means over the classes, plain and by support."""
    support = F.sum("support")
    by_support = [F.try_divide(F.sum(F.col(name) * F.col("support")), support) for name in MEASURES]
    return _class_totals(df, actual, predicted).agg(
        half_up(F.try_divide(F.sum("hits"), support), 4).alias("accuracy"),
        *[half_up(F.avg(name), 4).alias(f"macro_{name}") for name in MEASURES],
        *[half_up(mean, 4).alias(f"weighted_{name}") for name, mean in zip(MEASURES, by_support)],
        support.alias("support"),
    )
