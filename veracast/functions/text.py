"""Text repair, hashtags, categories and hashing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Character pairs that betray UTF-8 text read as a one-byte code page.
MOJIBAKE_MARKERS = (
    "\u00c3\u00a0",
    "\u00c3\u00a1",
    "\u00c3\u00a8",
    "\u00c3\u00a9",
    "\u00c3\u00ac",
    "\u00c3\u00ad",
    "\u00c3\u00b2",
    "\u00c3\u00b3",
    "\u00c3\u00b9",
    "\u00c3\u00ba",
    "\u00c3\u00bd",
    "\u00c4\u0091",
    "\u00c4\u0083",
    "\u00c6\u00b0",
    "\u00e1\u00ba",
    "\u00e1\u00bb",
)

# Category keywords; the first category with a keyword in the text wins.
CATEGORY_KEYWORDS = {
    "gaming": ("game", "gaming", "esports", "valorant", "fc online", "gamer", "gametv"),
    "music": ("music", "song", "festival", "instrumental"),
    "food": ("food", "cooking", "recipe", "cuisine", "street food"),
    "travel": ("travel", "tourism", "tour", "destination", "trip"),
    "technology": ("tech", "technology", "ai", "software", "b2b", "electronics", "mikrotik"),
    "beauty": ("makeup", "beauty", "skincare", "fashion"),
    "education": ("education", "school", "learn", "learning", "study", "master"),
    "business": ("business", "factory", "kpmg", "noventiq", "company", "official"),
    "entertainment": ("talent", "tv", "media", "show", "entertainment"),
}

# All markers as one pattern, those with the same first character together.
_MARKED = "|".join(
    f"{first}[{''.join(marker[1:] for marker in MOJIBAKE_MARKERS if marker[0] == first)}]"
    for first in dict.fromkeys(marker[0] for marker in MOJIBAKE_MARKERS)
)

HASHTAG_IN_CAPTION = r"#([^\s#,.!?;:]+)"
HASHTAG_RAW = r"#([\p{L}\p{N}_À-ỹ]+)"

# The printable characters the cp1252 code page keeps in its bytes 0x80-0x9F.
_HIGH_CHARS = "".join(
    bytes([code]).decode("cp1252") for code in range(0x80, 0xA0) if code not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)
)
_HIGH_BYTES = _HIGH_CHARS.encode("cp1252").decode("latin-1")


def has_mojibake(value: Column) -> Column:
    """A text of as many bytes as characters is ASCII and holds no marker; others are searched once for all of them.
    A search per marker made the methods of wide tables larger than the JVM compiles (8,000 bytes)."""
    return F.coalesce((F.octet_length(value) != F.length(value)) & value.rlike(_MARKED), F.lit(False))


def repair_mojibake(value: Column) -> Column:
    """Read the text back as cp1252 bytes and decode those as UTF-8.

    Text without a marker, text with a character outside the code page and byte sequences that
    are not UTF-8 stay as they are.
    """
    encodable = ~value.rlike(f"[^\\x00-\\x7f\\xa0-\\xff{_HIGH_CHARS}]")
    as_bytes = F.encode(F.translate(value, _HIGH_CHARS, _HIGH_BYTES), "ISO-8859-1")
    decoded = F.try_validate_utf8(as_bytes.cast("string"))
    return F.coalesce(F.when(has_mojibake(value), F.when(encodable, decoded)), value)


def hash_pii(value: Column) -> Column:
    """SHA-256 hex of non-empty text; empty text stays empty."""
    text = F.coalesce(value.cast("string"), F.lit(""))
    return F.when(text != "", F.sha2(text, 256)).otherwise(text)


def hash_text(value: Column) -> Column:
    return F.sha2(F.coalesce(value, F.lit("")), 256)


def format_hashtags(hashtags: Column, caption: Column, title: Column, is_list: bool = True) -> Column:
    """Comma-joined distinct tags from the list, else from the comma text, else from the caption."""
    text = F.coalesce(F.nullif(caption, F.lit("")), title, F.lit(""))
    in_caption = F.regexp_extract_all(text, F.lit(HASHTAG_IN_CAPTION), F.lit(1))
    if is_list:
        given = F.transform(hashtags, lambda tag: F.ltrim(tag, F.lit("#")))
        tags = F.when(hashtags.isNotNull(), given).otherwise(in_caption)
    else:
        given = F.transform(F.split(hashtags, ","), lambda tag: F.ltrim(F.trim(tag), F.lit("#")))
        tags = F.when(F.coalesce(hashtags, F.lit("")) != "", given).otherwise(in_caption)
    return F.array_join(F.array_distinct(F.filter(tags, lambda tag: tag != "")), ",")


def extract_hashtags(challenges: Column, extras: Column, caption: Column) -> Column:
    """Distinct tags, in order, from challenge titles, text extras and the caption."""

    def bare(tags: Column) -> Column:
        return F.transform(tags, lambda tag: F.ltrim(tag, F.lit("#")))

    titles = F.transform(
        challenges, lambda item: F.coalesce(item["title"], item["hashtagName"], item["name"], F.lit(""))
    )
    names = F.transform(extras, lambda item: F.coalesce(item["hashtagName"], item["tagName"], F.lit("")))
    nothing = F.array().cast("array<string>")
    in_caption = F.regexp_extract_all(F.coalesce(caption, F.lit("")), F.lit(HASHTAG_RAW), F.lit(1))
    everything = F.concat(F.coalesce(bare(titles), nothing), F.coalesce(bare(names), nothing), in_caption)
    return F.array_distinct(F.filter(everything, lambda tag: tag != ""))


def category_mask(lowered: Column) -> Column:
    """One bit per category with a keyword in the lower-case text. Masks of many texts of one
    creator combine with bit_or, which is how a category is found without joining the texts."""
    mask = F.lit(0)
    for bit, keywords in enumerate(CATEGORY_KEYWORDS.values()):
        found = F.lit(False)
        for keyword in keywords:
            found = found | lowered.contains(keyword)
        mask = mask.bitwiseOR(F.when(found, F.lit(1 << bit)).otherwise(F.lit(0)))
    return mask


def category_of_mask(mask: Column) -> Column:
    """The first category whose bit is set."""
    named = F.when(F.lit(False), F.lit("unknown"))
    for bit, category in enumerate(CATEGORY_KEYWORDS):
        named = named.when(mask.bitwiseAND(F.lit(1 << bit)) != 0, F.lit(category))
    return named.otherwise(F.lit("unknown"))


def joined_text(*values: Column) -> Column:
    """Non-empty values joined by single blanks, each repaired, in lower case."""
    return F.lower(F.concat_ws(" ", *[repair_mojibake(F.nullif(value, F.lit(""))) for value in values]))


def with_category(df: DataFrame, explicit: Column, lowered: Column, more: Column | None = None) -> DataFrame:
    """Adds `category`: the explicit one in lower case unless it is missing or `unknown`, else the
    first with a keyword in the text or in the mask `more` of other texts."""
    given = F.trim(repair_mojibake(F.col("_given")))
    staged = df.withColumns({"_given": F.coalesce(explicit, F.lit("")), "_lowered": lowered})
    mask = category_mask(F.col("_lowered"))
    if more is not None:
        mask = mask.bitwiseOR(F.coalesce(more, F.lit(0)))
    staged = staged.withColumns({"_given": F.lower(given), "_mask": mask})
    usable = (F.col("_given") != "") & (F.col("_given") != "unknown")
    named = F.when(usable, F.col("_given")).otherwise(category_of_mask(F.col("_mask")))
    return staged.withColumn("category", named).drop("_given", "_lowered", "_mask")
