"""The given star-schema tables read as raw inputs of the engine.

Customers stand for creators, orders for content, line items for the interactions with it,
document lines for comments, and the event table for the live feed and the stream. Even customer
keys are YouTube creators and odd ones TikTok creators; both parts are always built, so every
query runs over the whole tables. Everything is a projection or one grouped join that the
DuckDB statements in `plans.oracle` repeat.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.buckets import identity_profile

SECOND_CRAWL = 1_000_000_000_000
COLLECTED_AT = "2024-01-01T00:00:00Z"
# Frequent words of the synthetic prose and the lexicon words put in their place.
WORD_SWAPS = (
    (" of ", " great "),
    (" und ", " không "),
    (" is ", " cảm ơn "),
    (" et ", " tốt "),
    (" on ", " bad "),
    (" la ", " lừa đảo "),
    (" for ", " not "),
)
# Letters of the documents that the mojibake query breaks; others keep a text from being repaired.
BROKEN_LETTERS = "éèóüöáíàêßäçÉÈÖÜÄÇÊ"
EVENT_TYPES = {"view": "view", "click": "like", "error": "comment", "signup": "follower", "purchase": "purchase"}


# Tables whose rows are dear to work on: each comes as one file of one row group, so it is dealt out first.
SPREAD = {"documents": "doc_id", "events": "event_id"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if name not in SPREAD:
        return rows
    return rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), F.xxhash64(SPREAD[name]))


def _text(value: Column) -> Column:
    return value.cast("string")


def _prefixed(prefix: str, value: Column) -> Column:
    return F.concat(F.lit(prefix), _text(value))


def content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per crawl of an order: closed orders were crawled twice, the second time with
    doubled views. Some view counts do not parse."""
    interactions = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            F.sum("l_quantity").cast("bigint").alias("likes"),
            F.count(F.lit(1)).alias("comments"),
            F.count_if(F.col("l_returnflag") == "R").alias("shares"),
        )
    )
    orders = table(spark, sf_dir, "orders").join(interactions, "o_orderkey", "left")
    crawls = F.when(F.col("o_orderstatus") == "F", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    price = F.col("o_totalprice")
    views = F.floor(F.when(F.col("o_orderpriority") == "1-URGENT", price).otherwise(price / F.lit(100.0)))
    seconds = F.unix_date(F.col("o_orderdate").cast("date")).cast("bigint") * 86400 + F.col("o_orderkey") % 86400
    unread = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "4-NOT SPECIFIED")
    return (
        orders.withColumn("crawl", F.explode(crawls))
        .withColumn("views", views * (F.col("crawl") + 1))
        .select(
            "o_orderkey",
            "o_custkey",
            "o_orderpriority",
            F.when(F.col("o_custkey") % 2 == 0, "youtube").otherwise("tiktok").alias("platform"),
            F.format_string("Customer#%09d", "o_custkey").alias("creator_name"),
            F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM-dd"))
            .when(F.col("o_orderstatus") == "O", _text(seconds))
            .otherwise(_text(seconds * 1000))
            .alias("published"),
            F.when(unread, "n/a").otherwise(_text(F.col("views"))).alias("view_count"),
            _text(F.col("likes")).alias("like_count"),
            _text(F.col("comments")).alias("comment_count"),
            _text(F.col("shares")).alias("share_count"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("collected_at"),
            (F.col("crawl") * F.lit(SECOND_CRAWL) + F.col("o_orderkey")).alias("seq"),
        )
    )


def youtube_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.when(F.col("o_orderpriority") == "2-HIGH", "Tiáº¿ng Viá»‡t ").otherwise("Clip ")
    return content(spark, sf_dir).where(F.col("platform") == "youtube").select(
        "platform",
        _prefixed("UC", F.col("o_custkey")).alias("channel_id"),
        F.col("creator_name").alias("channel_name"),
        _prefixed("v", F.col("o_orderkey")).alias("video_id"),
        F.concat(title, F.col("o_orderpriority")).alias("video_title"),
        F.col("published").alias("published_at"),
        "view_count",
        "like_count",
        "comment_count",
        _text(F.col("o_custkey") * 10).alias("subscriber_count"),
        _text(F.col("o_custkey") % 500 + 1).alias("video_count"),
        "collected_at",
        "seq",
    )


def tiktok_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    tag = F.replace(F.col("o_orderpriority"), F.lit(" "), F.lit("_"))
    return content(spark, sf_dir).where(F.col("platform") == "tiktok").select(
        "platform",
        _prefixed("t", F.col("o_orderkey")).alias("content_id"),
        _prefixed("tk", F.col("o_custkey")).alias("creator_id"),
        "creator_name",
        _prefixed("user", F.col("o_custkey")).alias("username"),
        F.concat(F.lit("Live "), F.col("o_orderpriority")).alias("content_title"),
        F.concat(F.lit("New #"), tag, F.lit(" and #deal, #deal!")).alias("caption"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.array(F.lit("#low"), F.lit("low"), F.lit("street food"))).alias(
            "hashtags"
        ),
        F.col("published").alias("publish_time"),
        "view_count",
        "like_count",
        "comment_count",
        "share_count",
        "collected_at",
        "seq",
    )


def _creators(spark: SparkSession, sf_dir: str, platform: str) -> DataFrame:
    even = F.col("c_custkey") % 2 == 0
    return table(spark, sf_dir, "customer").where(even if platform == "youtube" else ~even)


def youtube_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Building-segment channels were crawled twice, the second time under a new name."""
    segment = F.col("c_mktsegment")
    suffix = F.when(segment == "BUILDING", " Official").when(segment == "AUTOMOBILE", " GameTV").otherwise("")
    crawls = F.when(segment == "BUILDING", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return _creators(spark, sf_dir, "youtube").withColumn("crawl", F.explode(crawls)).select(
        F.lit("youtube").alias("platform"),
        _prefixed("UC", F.col("c_custkey")).alias("channel_id"),
        F.concat(F.col("c_name"), suffix, F.when(F.col("crawl") == 1, " Travel").otherwise("")).alias("channel_name"),
        _text(F.floor(F.abs("c_acctbal")) + F.col("crawl")).alias("subscriber_count"),
        _text(F.col("c_custkey") % 500 + 1).alias("video_count"),
        _text(F.col("c_custkey") * 1000).alias("view_count"),
        F.lit(COLLECTED_AT).alias("collected_at"),
        (F.col("crawl") * F.lit(SECOND_CRAWL) + F.col("c_custkey")).alias("seq"),
    )


def youtube_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    keyword = F.when(segment == "MACHINERY", "Technology").when(segment == "HOUSEHOLD", "")
    return _creators(spark, sf_dir, "youtube").select(
        keyword.alias("seed_keyword"),
        F.lit("youtube").alias("platform"),
        _prefixed("UC", F.col("c_custkey")).alias("channel_id"),
        F.col("c_name").alias("channel_name"),
        _text(F.floor(F.abs("c_acctbal"))).alias("subscriber_count"),
        F.lit(COLLECTED_AT).alias("collected_at"),
        F.col("c_custkey").alias("seq"),
    )


def tiktok_creators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Furniture-segment creators lack an id; machinery ones name their category."""
    segment = F.col("c_mktsegment")
    return _creators(spark, sf_dir, "tiktok").select(
        F.lit("tiktok").alias("platform"),
        F.when(segment != "FURNITURE", _prefixed("tk", F.col("c_custkey"))).alias("creator_id"),
        F.col("c_name").alias("creator_name"),
        _prefixed("user", F.col("c_custkey")).alias("username"),
        F.when(segment == "MACHINERY", "Beauty").otherwise("unknown").alias("category"),
        _text(F.floor(F.abs("c_acctbal"))).alias("follower_count"),
        _text(F.col("c_nationkey")).alias("following_count"),
        _text(F.col("c_custkey") % 300).alias("content_count"),
        F.lit(COLLECTED_AT).alias("collected_at"),
        F.col("c_custkey").alias("seq"),
    )


def localised(text: Column) -> Column:
    for word, swap in WORD_SWAPS:
        text = F.replace(text, F.lit(word), F.lit(swap))
    return text


def comment_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document."""
    documents = table(spark, sf_dir, "documents")
    return documents.select(
        "doc_id", "lang", "source", F.posexplode(F.split(localised(F.col("text")), "\n")).alias("line", "text")
    )


def youtube_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments without a score; German ones carry a score of 0, Spanish ones came hashed."""
    german, spanish = F.col("lang") == "de", F.col("lang") == "es"
    first = F.col("line") == 0
    return comment_lines(spark, sf_dir).select(
        F.lit("youtube").alias("platform"),
        F.concat(F.lit("UC"), F.substring("source", 4, 10)).alias("channel_id"),
        _prefixed("v", F.col("doc_id")).alias("video_id"),
        F.concat_ws(":", _prefixed("c", F.col("doc_id")), _text(F.col("line"))).alias("comment_id"),
        F.when(first, "").otherwise(F.concat(_prefixed("c", F.col("doc_id")), F.lit(":0"))).alias("parent_comment_id"),
        (~first).alias("is_reply"),
        F.concat(F.lit("author "), F.col("source")).alias("comment_author_display_name"),
        F.col("source").alias("comment_author_channel_id"),
        F.when(spanish, F.sha2("text", 256)).otherwise(F.col("text")).alias("comment_text"),
        spanish.alias("comment_text_is_hashed"),
        _text(F.length("text")).alias("comment_like_count"),
        F.when(german, "negative").alias("comment_sentiment"),
        F.when(german, 0.0).alias("comment_sentiment_score"),
        F.when(german, "imported").alias("comment_sentiment_source"),
        F.lit(COLLECTED_AT).alias("comment_published_at"),
        F.lit(COLLECTED_AT).alias("collected_at"),
    )


def comment_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document as one nested thread: the first line on top, the others as replies."""
    lines = F.split(localised(F.col("text")), "\n")

    def item(text: Column, number: Column) -> Column:
        return F.struct(
            F.concat_ws(":", _prefixed("c", F.col("doc_id")), _text(number)).alias("id"),
            F.struct(
                text.alias("textOriginal"),
                F.lit(None).cast("string").alias("textDisplay"),
                F.col("source").alias("authorDisplayName"),
                F.to_json(F.struct(F.col("source").alias("value"))).alias("authorChannelId"),
                _text(F.length(text)).alias("likeCount"),
                F.lit(COLLECTED_AT).alias("publishedAt"),
            ).alias("snippet"),
        )

    numbered = F.transform(F.col("lines"), lambda text, index: item(text, index))
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", lines.alias("lines"))
    return documents.withColumn("items", numbered).select(
        _prefixed("v", F.col("doc_id")).alias("video_id"),
        F.concat(F.lit("UC"), F.substring("source", 4, 10)).alias("channel_id"),
        F.lit(COLLECTED_AT).alias("collected_at"),
        F.struct(F.col("items")[0].alias("topLevelComment")).alias("snippet"),
        F.struct(F.slice("items", 2, F.greatest(F.size("items") - 1, F.lit(0))).alias("comments")).alias("replies"),
    )


def channel_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as channel items of the API; those of one segment were fetched twice."""
    twice = F.when(F.col("c_mktsegment") == "BUILDING", F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    rows = table(spark, sf_dir, "customer").withColumn("crawl", F.explode(twice))
    none = F.lit(None).cast("string")
    return rows.select(
        _prefixed("UC", F.col("c_custkey")).alias("id"),
        F.struct(F.concat_ws(" ", F.col("c_name"), _text(F.col("crawl"))).alias("title"), none.alias("channelId"), none.alias("channelTitle"), none.alias("publishedAt")).alias("snippet"),
        F.struct(
            _text(F.col("c_custkey") * 1000).alias("viewCount"), none.alias("likeCount"), none.alias("commentCount"),
            _text(F.floor(F.abs("c_acctbal")) + F.col("crawl")).alias("subscriberCount"), _text(F.col("c_custkey") % 500).alias("videoCount"),
        ).alias("statistics"),
        F.concat(F.lit("2024-01-0"), _text(F.col("crawl"))).alias("collected_at"),
    )


def video_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as video items of the API, without the channel's title."""
    none = F.lit(None).cast("string")
    return table(spark, sf_dir, "orders").select(
        _prefixed("v", F.col("o_orderkey")).alias("id"),
        F.struct(F.col("o_orderpriority").alias("title"), _prefixed("UC", F.col("o_custkey")).alias("channelId"), F.lit("").alias("channelTitle"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("publishedAt")).alias("snippet"),
        F.struct(
            _text(F.floor("o_totalprice")).alias("viewCount"), _text(F.col("o_custkey") % 1000).alias("likeCount"), _text(F.col("o_orderkey") % 9).alias("commentCount"),
            none.alias("subscriberCount"), none.alias("videoCount"),
        ).alias("statistics"),
        F.lit(COLLECTED_AT).alias("collected_at"),
    )


class RawTables(Mapping):
    """The raw inputs by name, each planned when first asked for."""

    BUILDERS = {
        "youtube_channels": youtube_channels,
        "youtube_channel_seeds": youtube_seeds,
        "youtube_videos": youtube_videos,
        "youtube_comments": youtube_comments,
        "tiktok_creators": tiktok_creators,
        "tiktok_videos": tiktok_videos,
    }

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self._source = (spark, sf_dir)
        self._planned: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._planned:
            self._planned[name] = self.BUILDERS[name](*self._source)
        return self._planned[name]

    def __iter__(self):
        return iter(self.BUILDERS)

    def __len__(self) -> int:
        return len(self.BUILDERS)


def raw_tables(spark: SparkSession, sf_dir: str) -> RawTables:
    return RawTables(spark, sf_dir)


def broken_letters(text: Column) -> Column:
    for letter in BROKEN_LETTERS:
        text = F.replace(text, F.lit(letter), F.lit(misread(letter)))
    return text


def misread(letter: str) -> str:
    """The letter's UTF-8 bytes read as cp1252."""
    return letter.encode("utf-8").decode("cp1252")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))


def live_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table as a live feed; errors stand for comments with a sentiment."""
    named = F.create_map(*[F.lit(part) for pair in EVENT_TYPES.items() for part in pair])
    comment = F.col("event_type") == "error"
    sentiment = F.when(comment & (F.col("k") % 10 != 0), (F.col("k") - 50) / F.lit(50.0))
    return _events(spark, sf_dir).select(
        "event_id",
        _prefixed("k", F.col("user_id")).alias("kol_id"),
        F.element_at(named, F.col("event_type")).alias("event_type"),
        F.col("ts").alias("timestamp"),
        _prefixed("u", F.col("k")).alias("user_id"),
        _text(F.col("value")).alias("value"),
        sentiment.alias("sentiment_score"),
        (F.col("k") >= 80).alias("is_suspicious"),
    )


def live_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One session per creator with events: its totals and the profile from its id."""
    kind = F.col("event_type")
    totals = live_events(spark, sf_dir).groupBy("kol_id").agg(
        F.count_if(kind == "view").alias("viewers"),
        F.count_if(kind == "like").alias("likes"),
        F.count_if(kind == "comment").alias("comments"),
        F.count_if(kind == "follower").alias("shares"),
        F.count_if(kind == "purchase").alias("purchases"),
        F.min("timestamp").alias("started_at"),
        F.max("timestamp").alias("timestamp"),
    )
    profiles = table(spark, sf_dir, "customer").select(
        _prefixed("k", F.col("c_custkey")).alias("kol_id"),
        F.col("c_name").alias("name"),
        F.when(F.col("c_custkey") % 2 == 0, "youtube").otherwise("tiktok").alias("platform"),
        F.floor(F.abs("c_acctbal")).alias("followers"),
        F.lower("c_mktsegment").alias("category"),
        F.concat(F.lit("Live with "), "c_name").alias("title"),
    )
    sessions = totals.join(profiles, "kol_id", "left")
    return sessions.withColumn("_p", identity_profile(F.col("kol_id"))).select(
        *sessions.columns, "_p.*", F.concat(F.lit("live_"), "kol_id").alias("live_id")
    )


def stream_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event ids and the flat payload fields of the stream, alias fields included."""
    kind, k, value, user = F.col("event_type"), F.col("k"), F.col("value"), F.col("user_id")
    creator, size = _prefixed("k", user), F.floor(value * 10)
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    text = (
        F.when(kind == "purchase", "Great  LOVE it")
        .when(kind == "error", "SCAM spam bot")
        .when(kind == "click", "ok")
        .when(kind == "signup", "Uy tin, chat  luong")
    )
    return _events(spark, sf_dir).select(
        "event_id",
        "ts",
        F.when(kind != "signup", creator).alias("kol_id"),
        F.when(kind == "signup", creator).alias("channel_id"),
        F.when(kind.isin("view", "purchase"), _prefixed("Name ", user)).alias("kol_name"),
        F.when(kind == "click", _prefixed("Title ", user)).alias("channel_title"),
        F.when(k < 50, "tiktok").alias("platform"),
        F.when(k >= 90, "facebook").alias("source"),
        _prefixed("e", F.col("event_id")).alias("video_id"),
        F.when(kind != "error", stamp).alias("timestamp"),
        F.when(kind == "error", stamp).alias("crawled_at"),
        F.when(kind != "view", size).alias("views"),
        F.when(kind == "view", size).alias("view_count"),
        F.when(kind != "purchase", k).alias("likes"),
        F.when(kind == "purchase", k).alias("like_count"),
        (k % 7).alias("comments"),
        (k % 5).alias("shares"),
        F.when(kind != "signup", user * 100).alias("followers"),
        F.when(kind == "signup", user * 100).alias("subscriber_count"),
        F.when(k % 4 != 0, (k % 15) / F.lit(2.0)).alias("upload_frequency_7d"),
        (F.floor(value) * F.lit(10.0)).alias("live_concurrent_viewers"),
        (k / F.lit(80.0)).alias("follower_growth_rate"),
        F.when(kind == "error", k / F.lit(100.0)).alias("comment_spam_ratio"),
        text.alias("text"),
    )


def stream_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same payloads as JSON records of the event topic."""
    rows = stream_payloads(spark, sf_dir)
    fields = [name for name in rows.columns if name not in ("event_id", "ts")]
    return rows.select(
        F.to_json(F.struct(*fields)).cast("binary").alias("value"),
        F.lit("events").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def short_creator_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as items of the short-video API: some without an id or a nickname, counts under either name."""
    key, segment = F.col("c_custkey"), F.col("c_mktsegment")
    user = F.struct(
        F.when(segment != "FURNITURE", _prefixed("tk", key)).alias("id"),
        F.when(segment != "MACHINERY", F.col("c_name")).alias("nickname"),
        F.when(segment != "BUILDING", _prefixed("u", key)).alias("uniqueId"),
    )
    counts = F.struct(F.when(key % 2 == 0, _text(key * 3)).alias("followerCount"), _text(key * 5).alias("followers"), _text(key % 7).alias("following"), _text(key % 11).alias("videoCount"))
    return table(spark, sf_dir, "customer").select(
        _prefixed("asked", key).alias("username"), segment.alias("category"), F.lit(COLLECTED_AT).alias("collected_at"), F.struct(user.alias("user"), counts.alias("stats")).alias("userInfo")
    )


def short_video_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as items of the short-video API: the asked creator wins over the author, tags come from three places."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    tag = F.concat(F.lit("#"), F.lower("o_orderstatus"))
    return table(spark, sf_dir, "orders").select(
        F.when(key % 3 != 0, _prefixed("t", key)).alias("id"),
        _prefixed("aweme", key).alias("aweme_id"),
        F.when(key % 5 != 0, F.concat(F.lit("clip "), _text(customer), F.lit(" #go"))).alias("desc"),
        F.struct(F.when(key % 4 == 0, _prefixed("c", customer)).alias("creator_id"), F.lit("").alias("creator_name")).alias("creator"),
        F.struct(_prefixed("a", customer).alias("uid"), F.when(key % 2 == 0, _prefixed("Nick ", customer)).alias("nickname"), _prefixed("u", customer).alias("uniqueId")).alias("author"),
        F.struct(_text(F.floor("o_totalprice")).alias("playCount"), F.when(key % 2 == 0, _text(key)).alias("diggCount"), _text(customer).alias("likes"), F.lit("x").alias("commentCount")).alias("stats"),
        F.array(F.struct(tag.alias("title"), F.lit(None).cast("string").alias("hashtagName"), F.lit(None).cast("string").alias("name"))).alias("challenges"),
        _text(key * 10).alias("createTime"),
        F.lit(COLLECTED_AT).alias("collected_at"),
    )
