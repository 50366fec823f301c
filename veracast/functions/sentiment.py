"""Keyword sentiment: the 0-100 comment score and the 0-1 stream score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .numeric import clamp

# The comment lexicon (Vietnamese with and without accents, English).
POSITIVE_TERMS = (
    "amazing", "beautiful", "best", "cool", "excellent", "funny", "good", "great", "helpful", "love",
    "nice", "perfect", "thanks", "wonderful", "cam on", "cảm ơn", "de thuong", "dễ thương", "dinh", "đỉnh",
    "hay", "qua hay", "rat hay", "rất hay", "tot", "tốt", "tuyet", "tuyệt", "tuyet voi", "tuyệt vời",
    "ung ho", "ủng hộ", "xinh", "xuat sac", "xuất sắc",
)
NEGATIVE_TERMS = (
    "awful", "bad", "boring", "disappointed", "fake", "hate", "poor", "scam", "terrible", "trash",
    "worst", "chan", "chán", "do", "dở", "gia tao", "giả tạo", "kem", "kém", "lua dao",
    "lừa đảo", "nham", "nhảm", "qua te", "quá tệ", "te", "tệ", "that vong", "thất vọng", "xam", "xàm",
)
NEGATION_TERMS = ("khong", "không", "ko", "k", "not", "no", "chua", "chưa")
NEGATION_REACH = 3

# The smaller word sets of the stream score, matched as substrings.
UNIT_POSITIVE_WORDS = (
    "good", "great", "love", "excellent", "amazing", "trust", "trusted", "hay", "tot", "uy tin", "thich", "chat luong",
)
UNIT_NEGATIVE_WORDS = ("bad", "fake", "spam", "scam", "hate", "poor", "bot", "lua dao", "te", "kem", "ao")

# Label sources.
RULE_SOURCE = "rule_keyword_baseline"
NO_COMMENTS_SOURCE = "no_comments_default_neutral"
MISSING_TEXT_SOURCE = "missing_comment_text_default_neutral"

TOKEN = r"[\p{L}\p{N}_À-ỹ]+"
BETWEEN_TOKENS = r"[^a-z0-9_À-ỹ\p{L}\p{N}]+"
BLANKS = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
# Control characters and every blank but the space: what the ranges leave out, common characters first.
ODD_BLANK = (
    r"[^ -~\x{a1}-\x{167f}\x{1681}-\x{1fff}\x{200b}-\x{2027}\x{202a}-\x{202e}\x{2030}-\x{205e}\x{2060}-\x{2fff}\x{3001}-\x{10ffff}]"
)


def one_blank(text: Column) -> Column:
    """Every run of blanks as a single space. A quick look for double spaces and for other blanks
    than the space spares all other texts, accented ones too, the slow search for all kinds of blanks."""
    return F.when(text.contains("  ") | text.rlike(ODD_BLANK), F.regexp_replace(text, BLANKS, " ")).otherwise(text)


def fold_text(text: Column) -> Column:
    """Blanks collapsed and ends trimmed, of text in lower case."""
    return F.trim(one_blank(text))


def lower_fold(text: Column) -> Column:
    """Lower case with sharp s spelled out."""
    return F.replace(F.lower(text), F.lit("ß"), F.lit("ss"))


def _phrases(terms: tuple[str, ...]) -> list[str]:
    return [term for term in terms if " " in term]


def _single(terms: tuple[str, ...]) -> list[str]:
    return [term for term in terms if " " not in term]


def _phrase_hits(padded: Column, terms: tuple[str, ...]) -> Column:
    hits = F.lit(0)
    for phrase in _phrases(terms):
        hits = hits + padded.contains(f" {phrase} ").cast("int")
    return hits


def _token_codes(folded: Column) -> Column:
    """One letter per token: P positive, N negative, X negation, a dot for any other. Every token is looked
    up in one set of all terms, which takes as long for many terms as for few; only the few tokens found there
    are told apart. An empty piece before the first or after the last token is a dot that no hit or negation minds."""
    terms = [_single(POSITIVE_TERMS), _single(NEGATIVE_TERMS), list(NEGATION_TERMS)]

    def code(token: Column) -> Column:
        return (
            F.when(~token.isin(sum(terms, [])), ".")
            .when(token.isin(terms[0]), "P")
            .when(token.isin(terms[1]), "N")
            .otherwise("X")
        )

    return F.array_join(F.transform(F.split(folded, BETWEEN_TOKENS), code), "")


def _token_balance(codes: Column) -> Column:
    """Positive minus negative token hits; a hit counts -1 with a negation among the three tokens
    before it."""

    def hits(code: str) -> Column:
        found = F.length(codes) - F.length(F.replace(codes, F.lit(code), F.lit("")))
        negated = F.regexp_count(codes, F.lit(f"(?<=X.{{0,{NEGATION_REACH - 1}}}){code}"))
        return found - F.when(codes.contains("X"), negated).otherwise(F.lit(0)) * 2

    return hits("P") - hits("N")


def with_comment_sentiment(df: DataFrame, text: Column, output: str = "s") -> DataFrame:
    """Adds the struct `output` of label, 0-100 score and source. Blank text is neutral 50 and NULL
    text gives NULL. The folded and the padded text and the score are columns of their own, so that each is
    made once per row."""
    phrases = _phrase_hits(F.col("_padded"), POSITIVE_TERMS) - _phrase_hits(F.col("_padded"), NEGATIVE_TERMS)
    raw = _token_balance(F.col("_codes")) + phrases
    score = F.greatest(F.lit(0), F.least(F.lit(100), F.lit(50) + raw * 20)).cast("double")
    # greatest and least pass over NULL, so text that is not there is kept out here.
    known = F.when(F.col("_folded").isNotNull(), score)
    folded = df.withColumn("_lowered", lower_fold(text)).withColumn("_folded", fold_text(F.col("_lowered")))
    padded = F.concat(F.lit(" "), F.col("_folded"), F.lit(" "))
    staged = folded.withColumns({"_codes": _token_codes(F.col("_folded")), "_padded": padded}).withColumn("_score", known)
    # Positive hits lift the score over 50 and negative ones push it below, so the score tells the label.
    parts = F.struct(
        score_label(F.col("_score")).alias("label"), F.col("_score").alias("score"), F.lit(RULE_SOURCE).alias("source")
    )
    return staged.withColumn(output, F.when(F.col("_score").isNotNull(), parts)).drop("_lowered", "_folded", "_codes", "_padded", "_score")


def score_label(score: Column) -> Column:
    return F.when(score > 50, "positive").when(score < 50, "negative").otherwise("neutral")


def content_label(score: Column) -> Column:
    """Label of a content's mean comment score."""
    return F.when(score >= 60, "positive").when(score <= 40, "negative").otherwise("neutral")


def with_unit_sentiment(df: DataFrame, text: Column, output: str) -> DataFrame:
    """Adds the 0-1 score from substring hits of the small word sets; no text or no hit is 0.5."""

    def hits(words: tuple[str, ...]) -> Column:
        found = F.lit(0)
        for word in words:
            found = found + F.col("_lowered").contains(word).cast("int")
        return found

    cased = df.withColumn("_cased", F.lower(F.coalesce(text, F.lit(""))))
    staged = cased.withColumn("_lowered", one_blank(F.col("_cased"))).withColumns(
        {"_good": hits(UNIT_POSITIVE_WORDS), "_bad": hits(UNIT_NEGATIVE_WORDS)}
    )
    good, bad = F.col("_good"), F.col("_bad")
    lean = (good - bad) / F.greatest(F.lit(4), good + bad).cast("double")
    return staged.withColumn(output, clamp(F.lit(0.5) + lean * F.lit(0.5))).drop("_cased", "_lowered", "_good", "_bad")


def unit_label(score: Column) -> Column:
    return F.when(score >= 0.65, "positive").when(score <= 0.35, "negative").otherwise("neutral")
