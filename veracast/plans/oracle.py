"""DuckDB statements equal to the registered queries, over the same given tables.

Common table expressions are named once in `CTES`; a statement takes those it needs. Rounding,
means and the order of arithmetic follow the engine's helpers, so values agree to the last bit.
"""

from __future__ import annotations

import re

from ..functions.sentiment import (
    BLANKS,
    NEGATION_TERMS,
    NEGATIVE_TERMS,
    POSITIVE_TERMS,
    TOKEN,
    UNIT_NEGATIVE_WORDS,
    UNIT_POSITIVE_WORDS,
)
from ..functions.text import CATEGORY_KEYWORDS, MOJIBAKE_MARKERS
from ..schemas import TRUST_NUMERIC_FEATURES
from ..sources.given import BROKEN_LETTERS, COLLECTED_AT, SECOND_CRAWL, WORD_SWAPS, misread

LABEL = "'rule_generated_not_ground_truth'"


def half_up(value: str, digits: int) -> str:
    return f"(floor(({value}) * 1e{digits} + 0.5::DOUBLE) / 1e{digits})"


def units(value: str, digits: int) -> str:
    return f"floor(({value}) * 1e{digits} + 0.5::DOUBLE)::BIGINT"


def mean(value: str, digits: int) -> str:
    total = f"sum({units(value, digits)})"
    return f"(((2 * {total} + count(*)) // (2 * count(*))) / 1e{digits})"


def clamp(value: str, low: str = "0e0", high: str = "1e0") -> str:
    return f"greatest({low}, least({high}, {value}))"


def per_view(count: str) -> str:
    return half_up(f"({count}) / greatest(view_count, 1)::DOUBLE", 6)


def names(values) -> str:
    return ", ".join("'" + value.replace("'", "''") + "'" for value in values)


def bucket(key: str, buckets: int) -> str:
    return f"((('0x' || substr(sha256({key}), 1, 8))::BIGINT) % {buckets})"


def split_name(platform: str, creator: str) -> str:
    number = bucket(f"{platform} || ':' || {creator}", 10)
    return f"CASE WHEN {number} < 6 THEN 'train' WHEN {number} < 8 THEN 'eval' ELSE 'analysis_profile' END"


def falsy(value: str, default: str) -> str:
    return f"coalesce(nullif({value}, 0e0), {default})"


def trust_label(score: str) -> str:
    return f"CASE WHEN {score} >= 70 THEN 'high_trust' WHEN {score} >= 45 THEN 'medium_trust' ELSE 'low_trust' END"


def mask(text: str) -> str:
    bits = []
    for bit, keywords in enumerate(CATEGORY_KEYWORDS.values()):
        found = " OR ".join(f"contains({text}, '{keyword}')" for keyword in keywords)
        bits.append(f"(CASE WHEN {found} THEN {1 << bit} ELSE 0 END)")
    return "(" + " + ".join(bits) + ")::INTEGER"


def category(mask_name: str) -> str:
    cases = " ".join(f"WHEN {mask_name} & {1 << bit} <> 0 THEN '{name}'" for bit, name in enumerate(CATEGORY_KEYWORDS))
    return f"CASE {cases} ELSE 'unknown' END"


def localised(text: str) -> str:
    for word, swap in WORD_SWAPS:
        text = f"replace({text}, '{word}', '{swap}')"
    return text


def hits(text: str, words) -> str:
    return "(" + " + ".join(f"contains({text}, '{word}')::INTEGER" for word in words) + ")"


def phrase_hits(text: str, terms) -> str:
    return hits(text, [f" {term} " for term in terms if " " in term])


def unit_sentiment(text: str) -> str:
    folded = f"regexp_replace(lower(coalesce({text}, '')), '{BLANKS}', ' ', 'g')"
    good, bad = hits(folded, UNIT_POSITIVE_WORDS), hits(folded, UNIT_NEGATIVE_WORDS)
    return clamp(f"0.5e0 + (({good} - {bad}) / greatest(4, {good} + {bad})::DOUBLE) * 0.5e0")


def rule_trust(engagement: str, sentiment: str, activity: str) -> str:
    reach = f"(least({engagement} / 0.10e0, 1e0) * 100e0)"
    return half_up(clamp(f"0.5e0 * {reach} + 0.3e0 * {sentiment} + 0.2e0 * {activity}", "0e0", "100e0"), 2)


def suspicious(engagement: str) -> str:
    return f"CASE WHEN {engagement} > 0.30e0 OR (view_count > 100000 AND comment_count < 5) THEN 1 ELSE 0 END"


SINGLE_POSITIVE = [term for term in POSITIVE_TERMS if " " not in term]
SINGLE_NEGATIVE = [term for term in NEGATIVE_TERMS if " " not in term]
NEGATED = "coalesce(l1 IN ({0}), false) OR coalesce(l2 IN ({0}), false) OR coalesce(l3 IN ({0}), false)".format(names(NEGATION_TERMS))

CTES: dict[str, str] = {
    "interactions": """
        SELECT l_orderkey AS o_orderkey, sum(l_quantity)::BIGINT AS likes, count(*) AS comments,
               count(*) FILTER (WHERE l_returnflag = 'R') AS shares
        FROM lineitem GROUP BY 1""",
    "content": f"""
        SELECT o.o_orderkey, o.o_custkey, o.o_orderpriority, crawl,
               CASE WHEN o.o_custkey % 2 = 0 THEN 'youtube' ELSE 'tiktok' END AS platform,
               'Customer#' || lpad(o.o_custkey::VARCHAR, 9, '0') AS creator_name,
               CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED' THEN 0
                    ELSE floor(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice ELSE o_totalprice / 100e0 END)::BIGINT
                         * (1 + crawl) END AS view_count,
               coalesce(likes, 0) AS like_count, coalesce(comments, 0) AS comment_count,
               coalesce(shares, 0) AS share_count,
               CASE WHEN o_orderstatus = 'F' THEN date_trunc('day', o_orderdate)::TIMESTAMP
                    ELSE date_trunc('day', o_orderdate)::TIMESTAMP + to_seconds(o_orderkey % 86400) END AS published,
               strftime(o_orderdate, '%Y-%m-%d') AS collected_at,
               crawl * {SECOND_CRAWL} + o_orderkey AS seq
        FROM orders o LEFT JOIN interactions USING (o_orderkey), (VALUES (0), (1)) AS c(crawl)
        WHERE crawl = 0 OR o_orderstatus = 'F'""",
    "kept": """
        SELECT *, min(seq) OVER (PARTITION BY o_orderkey) AS first_seq FROM content WHERE view_count > 0
        QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY seq DESC) = 1""",
    "yt": """
        SELECT 'youtube' AS platform, 'UC' || o_custkey AS channel_id, creator_name AS channel_name,
               'v' || o_orderkey AS video_id,
               CASE WHEN o_orderpriority = '2-HIGH' THEN 'Tiếng Việt ' ELSE 'Clip ' END || o_orderpriority AS title,
               strftime(published, '%Y-%m-%dT%H:%M:%SZ') AS published_at, published, view_count, like_count, comment_count,
               o_custkey * 10 AS subscriber_count, o_custkey % 500 + 1 AS channel_video_count, collected_at, first_seq
        FROM kept WHERE platform = 'youtube'""",
    "tt": """
        SELECT 'tiktok' AS platform, 't' || o_orderkey AS content_id, 'tk' || o_custkey AS creator_id, creator_name,
               'user' || o_custkey AS username, 'Live ' || o_orderpriority AS content_title,
               'New #' || replace(o_orderpriority, ' ', '_') || ' and #deal, #deal!' AS caption,
               CASE WHEN o_orderpriority = '5-LOW' THEN 'low,street food'
                    ELSE replace(o_orderpriority, ' ', '_') || ',deal' END AS hashtags,
               strftime(published, '%Y-%m-%dT%H:%M:%SZ') AS publish_time, published, view_count, like_count, comment_count,
               share_count, collected_at, first_seq
        FROM kept WHERE platform = 'tiktok'""",
    "tt_creators": f"""
        SELECT c_custkey, 'tiktok' AS platform,
               CASE WHEN c_mktsegment = 'FURNITURE' THEN 'user' ELSE 'tk' END || c_custkey AS creator_id,
               c_name AS creator_name, 'user' || c_custkey AS username, c_mktsegment,
               floor(abs(c_acctbal))::BIGINT AS follower_count, c_nationkey::BIGINT AS following_count,
               c_custkey % 300 AS content_count, '{COLLECTED_AT}' AS collected_at
        FROM customer WHERE c_custkey % 2 <> 0""",
    "lines": f"""
        SELECT doc_id, lang, source, unnest(ls) AS text, generate_subscripts(ls, 1) - 1 AS line
        FROM (SELECT doc_id, lang, source, string_split({localised('text')}, chr(10)) AS ls FROM documents)""",
    "folded": f"""
        SELECT doc_id, line, trim(regexp_replace(replace(lower(text), 'ß', 'ss'), '{BLANKS}', ' ', 'g')) AS folded
        FROM lines""",
    "tokens": f"""
        SELECT doc_id, line, unnest(toks) AS t, generate_subscripts(toks, 1) AS pos
        FROM (SELECT doc_id, line, regexp_extract_all(folded, '{TOKEN}') AS toks FROM folded)""",
    "reached": """
        SELECT doc_id, line, t, lag(t, 1) OVER w AS l1, lag(t, 2) OVER w AS l2, lag(t, 3) OVER w AS l3
        FROM tokens WINDOW w AS (PARTITION BY doc_id, line ORDER BY pos)""",
    "balances": f"""
        SELECT doc_id, line, sum((CASE WHEN {NEGATED} THEN -1 ELSE 1 END)
               * (CASE WHEN t IN ({names(SINGLE_POSITIVE)}) THEN 1 ELSE -1 END)) AS balance
        FROM reached WHERE t IN ({names(SINGLE_POSITIVE + SINGLE_NEGATIVE)}) GROUP BY 1, 2""",
    "line_scores": f"""
        SELECT *, CASE WHEN score > 50 THEN 'positive' WHEN score < 50 THEN 'negative' ELSE 'neutral' END AS label
        FROM (SELECT l.*, greatest(0, least(100, 50 + 20 * (coalesce(balance, 0)
                     + {phrase_hits("' ' || folded || ' '", POSITIVE_TERMS)}
                     - {phrase_hits("' ' || folded || ' '", NEGATIVE_TERMS)})))::DOUBLE AS score
              FROM lines l JOIN folded USING (doc_id, line) LEFT JOIN balances USING (doc_id, line))""",
    "comment_rows": """
        SELECT doc_id, line, lang, source, text,
               CASE lang WHEN 'de' THEN 'negative' WHEN 'es' THEN 'neutral' ELSE label END AS label,
               CASE WHEN lang IN ('de', 'es') THEN 50e0 ELSE coalesce(nullif(score, 0e0), 50e0) END AS score,
               CASE lang WHEN 'de' THEN 'imported' WHEN 'es' THEN 'missing_comment_text_default_neutral'
                    ELSE 'rule_keyword_baseline' END AS origin
        FROM line_scores""",
    "content_sent": f"""
        SELECT 'v' || doc_id AS video_id, sentiment_score, positive_comment_count, neutral_comment_count,
               negative_comment_count,
               CASE WHEN sentiment_score >= 60 THEN 'positive' WHEN sentiment_score <= 40 THEN 'negative'
                    ELSE 'neutral' END AS sentiment_label, 'rule_keyword_baseline' AS sentiment_source
        FROM (SELECT doc_id, {mean('score', 2)} AS sentiment_score,
                     count(*) FILTER (WHERE label = 'positive') AS positive_comment_count,
                     count(*) FILTER (WHERE label = 'neutral') AS neutral_comment_count,
                     count(*) FILTER (WHERE label = 'negative') AS negative_comment_count
              FROM comment_rows GROUP BY doc_id)""",
    "yt_features": f"""
        SELECT platform, channel_id AS creator_id, channel_name AS creator_name, video_id AS content_id,
               title AS content_title, published_at AS publish_time, published, subscriber_count AS follower_count,
               channel_video_count AS content_count, view_count, like_count, comment_count, 0 AS share_count,
               engagement_rate, {per_view('like_count')} AS likes_per_view, {per_view('comment_count')} AS comments_per_view,
               0e0 AS shares_per_view, sentiment_score, sentiment_label, positive_comment_count, neutral_comment_count,
               negative_comment_count, {half_up('activity', 2)} AS activity_score,
               {rule_trust('engagement_rate', 'sentiment_score', 'activity')} AS trust_score,
               {suspicious('engagement_rate')} AS is_suspicious, collected_at, first_seq
        FROM (SELECT yt.*, coalesce(sentiment_score, 50e0) AS sentiment_score,
                     coalesce(sentiment_label, 'neutral') AS sentiment_label,
                     coalesce(positive_comment_count, 0) AS positive_comment_count,
                     coalesce(neutral_comment_count, 0) AS neutral_comment_count,
                     coalesce(negative_comment_count, 0) AS negative_comment_count,
                     {per_view('like_count + comment_count')} AS engagement_rate,
                     least(comment_count / 1000e0 * 100e0, 100e0) AS activity
              FROM yt LEFT JOIN content_sent USING (video_id))""",
    "tt_features": f"""
        SELECT t.platform, t.creator_id, t.creator_name, t.content_id, t.content_title, t.publish_time, t.published,
               coalesce(c.follower_count, 0) AS follower_count, coalesce(c.content_count, 0) AS content_count,
               view_count, like_count, comment_count, share_count, engagement_rate,
               {per_view('like_count')} AS likes_per_view, {per_view('comment_count')} AS comments_per_view,
               {per_view('share_count')} AS shares_per_view, 50e0 AS sentiment_score, 'neutral' AS sentiment_label,
               0 AS positive_comment_count, 0 AS neutral_comment_count, 0 AS negative_comment_count, activity_score,
               {rule_trust('engagement_rate', '50e0', 'activity_score')} AS trust_score,
               {suspicious('engagement_rate')} AS is_suspicious, t.collected_at, first_seq
        FROM (SELECT *, {per_view('like_count + comment_count + share_count')} AS engagement_rate,
                     {half_up('least((comment_count + share_count) / 1000e0 * 100e0, 100e0)', 2)} AS activity_score
              FROM tt) t LEFT JOIN tt_creators c USING (creator_id)""",
    "both_platforms": "SELECT * FROM yt_features UNION ALL SELECT * FROM tt_features",
    "frequency": f"""
        SELECT platform, creator_id,
               CASE WHEN count(*) <= 1 THEN count(*)::DOUBLE
                    ELSE {half_up("count(*) / greatest(floor((epoch(max(published)) - epoch(min(published))) / 86400e0), 1)::DOUBLE * 7e0", 4)}
               END AS upload_frequency
        FROM both_platforms GROUP BY 1, 2""",
    "unified": f"""
        SELECT b.*, coalesce(upload_frequency, 0e0) AS upload_frequency, NULL::DOUBLE AS follower_growth_rate,
               {LABEL} AS label_source
        FROM both_platforms b LEFT JOIN frequency USING (platform, creator_id)""",
    "totals": f"""
        SELECT platform, creator_id, arg_min(creator_name, first_seq) AS creator_name,
               max(follower_count) AS follower_count, max(content_count) AS content_count,
               count(*) AS observed_content_count, sum(view_count)::BIGINT AS total_views,
               {mean('engagement_rate', 6)} AS avg_engagement_rate,
               {mean(falsy('sentiment_score', '50e0'), 2)} AS avg_sentiment_score,
               {mean('activity_score', 2)} AS avg_activity_score, {mean('trust_score', 2)} AS trust_score,
               sum(is_suspicious)::BIGINT AS suspicious_content_count, {LABEL} AS label_source,
               max(collected_at) AS collected_at, min(first_seq) AS first_seq
        FROM unified GROUP BY platform, creator_id""",
    "leaderboard": """
        SELECT row_number() OVER (ORDER BY trust_score DESC, total_views DESC, platform DESC, first_seq) AS rank, *
        EXCLUDE (first_seq) FROM totals""",
    "feed": """
        SELECT *, regexp_extract(props, '"k": *([0-9]+)', 1)::BIGINT AS k FROM events""",
    "live": """
        SELECT event_id, 'k' || user_id AS kol_id,
               CASE event_type WHEN 'click' THEN 'like' WHEN 'error' THEN 'comment' WHEN 'signup' THEN 'follower'
                    ELSE event_type END AS event_type,
               ts, 'u' || k AS user_id, value,
               CASE WHEN event_type = 'error' AND k % 10 <> 0 THEN (k - 50) / 50e0 END AS sentiment_score,
               k >= 80 AS is_suspicious
        FROM feed""",
    "recent_live": """
        SELECT *, row_number() OVER (PARTITION BY kol_id ORDER BY ts DESC, event_id DESC) AS recency FROM live
        QUALIFY recency <= 260""",
    "live_stats": f"""
        SELECT kol_id, count(*) FILTER (WHERE recency <= 180) AS metric_events,
               count(*) FILTER (WHERE recency <= 180 AND is_suspicious) AS metric_suspicious,
               count(*) FILTER (WHERE recency <= 180 AND event_type = 'comment' AND sentiment_score IS NOT NULL) AS metric_comments,
               coalesce(sum({units('sentiment_score', 6)}) FILTER (WHERE recency <= 180 AND event_type = 'comment'
                        AND sentiment_score IS NOT NULL), 0)::BIGINT AS metric_sentiment,
               count(*) AS feature_events, count(*) FILTER (WHERE is_suspicious) AS feature_suspicious,
               count(*) FILTER (WHERE event_type = 'comment') AS feature_comments,
               coalesce(sum({units('sentiment_score', 6)}) FILTER (WHERE event_type = 'comment'
                        AND sentiment_score IS NOT NULL), 0)::BIGINT AS feature_sentiment,
               count(DISTINCT user_id) AS feature_users
        FROM recent_live GROUP BY kol_id""",
    "id_profiles": f"""
        SELECT c_custkey, kol_id,
               CASE b WHEN 0 THEN 0.42e0 WHEN 1 THEN 0.58e0 WHEN 2 THEN 0.72e0 ELSE 0.80e0 END AS reputation_score,
               CASE b WHEN 0 THEN 'risky' WHEN 1 THEN 'watch' ELSE 'trusted' END AS risk_profile,
               CASE b WHEN 0 THEN 'bot_attack' WHEN 1 THEN 'trust_drop' WHEN 2 THEN 'viral' ELSE 'normal' END AS default_mode,
               b >= 2 AS verified
        FROM (SELECT c_custkey, 'k' || c_custkey AS kol_id, {bucket("'k' || c_custkey", 5)} AS b FROM customer)""",
    "sessions": """
        SELECT t.*, c.c_name AS name, CASE WHEN c.c_custkey % 2 = 0 THEN 'youtube' ELSE 'tiktok' END AS platform,
               floor(abs(c.c_acctbal))::BIGINT AS followers, p.reputation_score, p.risk_profile, p.verified,
               'live_' || t.kol_id AS live_id, lower(c.c_mktsegment) AS category, 'Live with ' || c.c_name AS title
        FROM (SELECT kol_id, count(*) FILTER (WHERE event_type = 'view') AS viewers,
                     count(*) FILTER (WHERE event_type = 'like') AS likes,
                     count(*) FILTER (WHERE event_type = 'comment') AS comments,
                     count(*) FILTER (WHERE event_type = 'follower') AS shares,
                     count(*) FILTER (WHERE event_type = 'purchase') AS purchases,
                     strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS started_at, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS timestamp
              FROM live GROUP BY kol_id) t
        JOIN id_profiles p USING (kol_id) JOIN customer c ON c.c_custkey = p.c_custkey""",
    "measured": f"""
        SELECT *, {half_up('least(0.98e0, risk * 1.65e0)', 4)} AS bot,
               CASE WHEN risk > 0.35e0 OR sentiment < -0.18e0 THEN 'risky'
                    WHEN risk > 0.18e0 OR sentiment < 0.05e0 THEN 'watch' ELSE 'trusted' END AS signal
        FROM (SELECT *, metric_sentiment / (greatest(metric_comments, 1) * 1e6) AS sentiment,
                     {half_up('(likes + comments + shares) / greatest(followers, 1)::DOUBLE', 5)} AS engagement,
                     metric_suspicious / greatest(metric_events, 1)::DOUBLE + (1e0 - reputation_score) * 0.28e0 AS risk
              FROM sessions JOIN live_stats USING (kol_id))""",
    "live_features": f"""
        SELECT kol_id, name AS kol_name, platform, category, followers, verified, reputation_score AS profile_reputation_score,
               risk_profile AS profile_risk_label, live_id, viewers AS viewer_count, likes AS like_count,
               shares AS share_count, comments AS comment_count, purchases AS purchase_count,
               engagement AS engagement_rate, {half_up('sentiment', 4)} AS sentiment_score, bot AS bot_probability,
               {half_up('feature_suspicious / greatest(feature_events, 1)::DOUBLE', 4)} AS suspicious_event_ratio,
               {half_up('feature_users / greatest(feature_events, 1)::DOUBLE', 4)} AS unique_user_ratio,
               {half_up('feature_sentiment / (greatest(feature_comments, 1) * 1e6)', 4)} AS avg_comment_sentiment,
               {half_up('least(1e0, viewers / 8000e0 + engagement)', 4)} AS activity_score,
               risk > 0.28e0 AS is_suspicious, signal AS trust_label, timestamp
        FROM measured""",
    "payloads": """
        SELECT event_id, ts, event_type, k, 'k' || user_id AS kol_id,
               CASE WHEN event_type IN ('view', 'purchase') THEN 'Name ' || user_id
                    WHEN event_type = 'click' THEN 'Title ' || user_id ELSE 'Unknown KOL' END AS kol_name,
               CASE WHEN k < 50 THEN 'tiktok' WHEN k >= 90 THEN 'facebook' ELSE 'youtube' END AS platform,
               'e' || event_id AS video_id, floor(value * 10)::BIGINT AS views, k AS likes, k % 7 AS comments,
               k % 5 AS shares, user_id * 100 AS followers,
               CASE WHEN k % 4 <> 0 THEN (k % 15) / 2e0 ELSE 2e0 END AS uploads, floor(value) * 10e0 AS viewers,
               k / 80e0 AS growth, CASE WHEN event_type = 'error' THEN k / 100e0 ELSE 0e0 END AS spam,
               CASE event_type WHEN 'purchase' THEN 'Great  LOVE it' WHEN 'error' THEN 'SCAM spam bot'
                    WHEN 'click' THEN 'ok' WHEN 'signup' THEN 'Uy tin, chat  luong' END AS text
        FROM feed""",
    "measures": f"""
        SELECT *, CASE WHEN views > 0 THEN {clamp('(likes + comments * 2e0 + shares * 3e0) / views')} ELSE 0e0 END AS eng,
               {unit_sentiment('text')} AS sent,
               {clamp('uploads / 7e0 * 0.75e0 + log10(viewers + 1e0) / 5e0 * 0.25e0')} AS stream_act,
               {clamp(clamp('uploads / 7e0') + ' * 0.75e0 + ' + clamp('log10(viewers + 1e0) / 5e0') + ' * 0.25e0')} AS act
        FROM payloads""",
    "anomalies": f"""
        SELECT *, least(1e0, greatest(0e0, (growth - 0.15e0) / 0.85e0) * 0.35e0
                             + greatest(0e0, (eng - 0.25e0) / 0.75e0) * 0.25e0 + {clamp('spam')} * 0.40e0) AS stream_anom,
               {clamp(clamp('(growth - 0.15e0) / 0.85e0') + ' * 0.35e0 + ' + clamp('(eng - 0.25e0) / 0.75e0')
                      + ' * 0.25e0 + ' + clamp('spam') + ' * 0.40e0')} AS anom,
               {clamp(clamp('(0e0 - 0.15e0) / 0.85e0') + ' * 0.35e0 + ' + clamp('(eng - 0.25e0) / 0.75e0')
                      + ' * 0.25e0 + ' + clamp('0e0') + ' * 0.40e0')} AS eng_anom
        FROM measures""",
    "scores": f"""
        SELECT *, stream_anom >= 0.55e0 OR trust_score < 45 AS is_suspicious
        FROM (SELECT event_id, ts, kol_id, kol_name, platform, video_id, views, likes, comments, shares, followers,
                     {half_up('eng', 6)} AS engagement_rate, {half_up('sent', 6)} AS sentiment_score,
                     {half_up('stream_act', 6)} AS activity_score, {half_up('stream_anom', 6)} AS anomaly_score, stream_anom,
                     {half_up(clamp('0.50e0 * (1e0 - eng_anom) + 0.25e0 * sent + 0.25e0 * stream_act') + ' * 100e0', 2)} AS trust_score
              FROM anomalies)""",
    "score_rows": """
        SELECT kol_id, kol_name, platform, video_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS event_time, views, likes,
               comments, shares, followers, engagement_rate, sentiment_score, activity_score, anomaly_score,
               trust_score, is_suspicious, ts
        FROM scores""",
    "newest": """
        SELECT * FROM score_rows QUALIFY row_number() OVER (PARTITION BY kol_id ORDER BY ts DESC, video_id DESC) = 1""",
    "recent_scores": """
        SELECT *, row_number() OVER (PARTITION BY kol_id ORDER BY ts DESC, video_id) AS recency FROM score_rows""",
    "summary": f"""
        SELECT *, {half_up('(1e0 - risk) * 100e0', 1)} AS trust_score, {half_up('risk', 4)} AS risk_score,
               CASE WHEN risk >= 0.65e0 THEN 'risky' WHEN risk >= 0.38e0 THEN 'watch' ELSE 'trusted' END AS risk_label
        FROM (SELECT r.kol_id, kol_name AS name, platform, followers, views AS viewers, comments, events, suspicious_events,
                     {trust_label('trust_score')} AS trust_signal, {falsy('sentiment_score', '0.5e0')} AS sentiment_score,
                     anomaly_score AS bot_probability, anomaly_score AS suspicious_event_ratio,
                     is_suspicious AS suspicious_spike, event_time AS timestamp,
                     {clamp('anomaly_score * 0.4e0 + anomaly_score * 0.3e0 + (1e0 - ' + falsy('sentiment_score', '0.5e0')
                            + ') * 0.2e0 + (1e0 - 0.5e0) * 0.1e0')} AS risk
              FROM newest r
              JOIN (SELECT kol_id, count(*) AS events, count(*) FILTER (WHERE is_suspicious) AS suspicious_events
                    FROM score_rows GROUP BY kol_id) n ON n.kol_id = r.kol_id)""",
    "directory": f"""
        SELECT kol_id, kol_name AS name, platform, followers, trust_score >= 70 AS verified,
               {half_up('trust_score / 100e0', 4)} AS reputation_score,
               CASE WHEN trust_score >= 70 THEN 'trusted' WHEN trust_score >= 45 THEN 'watch' ELSE 'risky' END AS risk_profile,
               'normal' AS default_mode
        FROM newest""",
    "event_lines": """
        SELECT event_id AS line, CASE WHEN event_type = 'signup' THEN 'invalid JSON' END AS error,
               CASE event_type WHEN 'error' THEN 'platform' WHEN 'click' THEN 'trust_score' WHEN 'signup' THEN NULL ELSE '' END AS missing
        FROM events""",
    "yt_channels": f"""
        SELECT 'youtube' AS platform, 'UC' || c_custkey AS channel_id,
               c_name || CASE c_mktsegment WHEN 'BUILDING' THEN ' Official Travel' WHEN 'AUTOMOBILE' THEN ' GameTV' ELSE '' END AS channel_name,
               CASE c_mktsegment WHEN 'MACHINERY' THEN 'technology' WHEN 'BUILDING' THEN 'travel' WHEN 'AUTOMOBILE' THEN 'gaming'
                    ELSE 'unknown' END AS category,
               floor(abs(c_acctbal))::BIGINT + CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS subscriber_count,
               c_custkey % 500 + 1 AS video_count, c_custkey * 1000 AS total_view_count, '{COLLECTED_AT}' AS collected_at
        FROM customer WHERE c_custkey % 2 = 0""",
    "feature_scores": f"""
        SELECT *, {clamp('0.50e0 * (1e0 - anom) + 0.25e0 * sent + 0.25e0 * unit_act')} * 100e0 AS raw_trust
        FROM (SELECT *, {clamp('0e0 * 0.35e0 + ' + clamp('(eng - 0.25e0) / 0.75e0') + ' * 0.25e0 + 0e0 * 0.40e0')} AS anom,
                     {clamp('CASE WHEN act * 100e0 > 1 THEN act * 100e0 / 100e0 ELSE act * 100e0 END')} AS unit_act
              FROM (SELECT *, {clamp('(like_count + comment_count * 2e0 + share_count * 3e0) / view_count')} AS eng,
                           {unit_sentiment('content_title')} AS sent,
                           {clamp(clamp('upload_frequency / 7e0') + ' * 0.75e0 + 0e0 * 0.25e0')} AS act
                    FROM unified))""",
}

UNIFIED = (
    "platform, creator_id, creator_name, content_id, content_title, publish_time, follower_count, content_count, view_count, "
    "like_count, comment_count, share_count, engagement_rate, likes_per_view, comments_per_view, shares_per_view, "
    "sentiment_score, sentiment_label, positive_comment_count, neutral_comment_count, negative_comment_count, "
    "upload_frequency, follower_growth_rate, activity_score, trust_score, is_suspicious, label_source, collected_at"
)
SCORE_ROW = (
    "kol_id, kol_name, platform, video_id, event_time, views, likes, comments, shares, followers, engagement_rate, "
    "sentiment_score, activity_score, anomaly_score, trust_score, is_suspicious"
)
EVENT_SCORE = f"""
    kol_id, kol_name, platform, video_id, timestamp, views, likes, comments, shares, followers, engagement_rate,
    sentiment_score, activity_score, anomaly_score, {half_up('raw', 2)} AS trust_score, {trust_label('raw')} AS trust_label,
    'rule_fallback' AS trust_source, anom >= 0.55e0 OR raw < 45 AS is_suspicious"""
FEATURE_SCORE = f"""
    SELECT creator_id AS kol_id, creator_name AS kol_name, platform, content_id AS video_id, publish_time AS timestamp,
           view_count AS views, like_count AS likes, comment_count AS comments, share_count AS shares,
           follower_count AS followers, {half_up('eng', 6)} AS engagement_rate, {half_up('sent', 6)} AS sentiment_score,
           {half_up('act', 6)} AS activity_score, {half_up('anom', 6)} AS anomaly_score, {half_up('raw_trust', 2)} AS trust_score,
           {trust_label('raw_trust')} AS trust_label, 'rule_fallback' AS trust_source, raw_trust < 45 AS is_suspicious
    FROM feature_scores"""
IN_ORDER = "ORDER BY platform DESC, first_seq"


def quality_rows(source: str, table: str, rules: list[tuple[str, str]], exact: dict[str, tuple] | None = None) -> str:
    """Report rows of a table that keeps all rules, but for the counts in `exact`."""
    rows = []
    for column, rule in rules:
        present, nulls, typed, broken = (exact or {}).get(column, ("true", "0", "0", "0"))
        rows.append(
            f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{rule}' AS rule, {present} AS present, "
            f"({nulls}) AS null_rows, ({typed}) AS type_rows, ({broken}) AS broken_rows, "
            f"(SELECT count(*) FROM {source}) AS row_count"
        )
    return (
        "SELECT *, CASE WHEN present AND null_rows + type_rows + broken_rows = 0 THEN 'ok' ELSE 'failed' END AS status "
        "FROM (" + " UNION ALL ".join(rows) + ")"
    )


def count_where(source: str, condition: str) -> str:
    return f"SELECT count(*) FROM {source} WHERE {condition}"


INFLUENCER_RULES = [
    ("platform", "isin"), ("creator_id", "type"), ("creator_name", "type"), ("content_id", "type"),
    ("view_count", "at_least"), ("like_count", "at_least"), ("comment_count", "at_least"), ("share_count", "at_least"),
    ("engagement_rate", "at_least"), ("sentiment_score", "in_range"), ("activity_score", "in_range"),
    ("trust_score", "in_range"), ("is_suspicious", "isin"), ("label_source", "type"),
]
COMMENT_RULES = [
    ("platform", "isin"), ("creator_id", "type"), ("content_id", "type"), ("comment_id", "type"), ("is_reply", "type"),
    ("comment_text_is_hashed", "type"), ("like_count", "at_least"), ("sentiment", "isin"), ("sentiment_score", "in_range"),
    ("sentiment_source", "type"),
]
TRUST_RULES = [
    ("rank", "at_least"), ("platform", "isin"), ("creator_id", "type"), ("creator_name", "type"),
    ("follower_count", "at_least"), ("observed_content_count", "at_least"), ("avg_engagement_rate", "at_least"),
    ("avg_sentiment_score", "in_range"), ("avg_activity_score", "in_range"), ("trust_score", "in_range"),
    ("suspicious_content_count", "at_least"), ("label_source", "type"),
]
INFLUENCER_EXACT = {
    "platform": ("true", count_where("unified", "platform IS NULL"), "0", count_where("unified", "platform NOT IN ('youtube', 'tiktok')")),
    "engagement_rate": ("true", count_where("unified", "engagement_rate IS NULL"), "0", count_where("unified", "engagement_rate < 0")),
    "trust_score": ("true", count_where("unified", "trust_score IS NULL"), "0", count_where("unified", "trust_score NOT BETWEEN 0 AND 100")),
}

def _mojibake() -> str:
    """A broken text decodes to the original one if no letter outside ASCII was left unbroken."""
    broken = "text"
    for letter in BROKEN_LETTERS:
        broken = f"replace({broken}, '{letter}', '{misread(letter)}')"
    return f"""
        SELECT doc_id, marked, CASE WHEN marked AND NOT regexp_matches(text, '[^\\x00-\\x7f{BROKEN_LETTERS}]') THEN text
                                    ELSE broken END AS repaired
        FROM (SELECT *, regexp_matches(broken, '{"|".join(MOJIBAKE_MARKERS)}') AS marked
              FROM (SELECT doc_id, text, {broken} AS broken FROM documents))"""


def _report(actual: str, predicted: str, source: str) -> str:
    return f"""
        SELECT class, {half_up('p', 4)} AS precision, {half_up('r', 4)} AS recall,
               {half_up('coalesce(p * r * 2e0 / nullif(p + r, 0e0), 0e0)', 4)} AS f1, support
        FROM (SELECT class, coalesce(hits / nullif(claimed, 0)::DOUBLE, 0e0) AS p,
                     coalesce(hits / nullif(support, 0)::DOUBLE, 0e0) AS r, support
              FROM (SELECT class, (SELECT count(*) FROM {source} WHERE {actual} = class) AS support,
                           (SELECT count(*) FROM {source} WHERE {predicted} = class) AS claimed,
                           (SELECT count(*) FROM {source} WHERE {actual} = class AND {predicted} = class) AS hits
                    FROM (SELECT {actual} AS class FROM {source} UNION SELECT {predicted} FROM {source})))"""


CTES["pairs"] = """
    SELECT CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive' ELSE 'neutral' END AS human,
           sentiment_label AS predicted
    FROM labels JOIN content_sent ON video_id = 'v' || doc_id"""

COMMENT_TABLE = """
    SELECT 'youtube' AS platform, 'UC' || substr(source, 4) AS creator_id, 'v' || doc_id AS content_id,
           'c' || doc_id || ':' || line AS comment_id, CASE WHEN line = 0 THEN '' ELSE 'c' || doc_id || ':0' END AS parent_comment_id,
           line <> 0 AS is_reply, {name} AS comment_author_display_name, {author} AS comment_author_channel_id,
           {text} AS comment, {hashed} AS comment_text_is_hashed, length(text) AS like_count, label AS sentiment,
           score AS sentiment_score, origin AS sentiment_source, '{at}' AS comment_published_at, '{at}' AS collected_at
    FROM comment_rows"""
COMMENT_TEXT = "CASE WHEN lang = 'es' THEN sha256(text) ELSE text END"
ANON_TEXT = f"CASE WHEN text = '' AND lang <> 'es' THEN '' ELSE sha256({COMMENT_TEXT}) END"


QUERIES: dict[str, str] = {
    "creator_trust_leaderboard": "SELECT * FROM leaderboard",
    "youtube_channels": "SELECT * FROM yt_channels",
    "youtube_videos": "SELECT * EXCLUDE (published, first_seq) FROM yt",
    "tiktok_creators": """
        SELECT platform, creator_id, creator_name, username,
               CASE WHEN c_mktsegment = 'MACHINERY' THEN 'beauty'
                    WHEN c_mktsegment <> 'FURNITURE' AND EXISTS (SELECT 1 FROM content o WHERE o.o_custkey = tt_creators.c_custkey
                         AND o_orderpriority = '5-LOW') THEN 'food' ELSE 'unknown' END AS category,
               follower_count, following_count, content_count, collected_at
        FROM tt_creators""",
    "tiktok_videos": "SELECT * EXCLUDE (published, first_seq) FROM tt",
    "unified_features": f"SELECT {UNIFIED} FROM unified",
    "content_engagement": """
        SELECT platform, creator_id, creator_name, content_id, view_count, like_count, comment_count, share_count,
               engagement_rate, likes_per_view, comments_per_view, shares_per_view, upload_frequency, activity_score, collected_at
        FROM unified""",
    "suspicious_content": """
        SELECT platform, creator_id, creator_name, content_id, follower_count, view_count, like_count, comment_count,
               share_count, engagement_rate, likes_per_view, comments_per_view, shares_per_view, is_suspicious, label_source,
               collected_at
        FROM unified WHERE is_suspicious = 1""",
    "upload_frequency": "SELECT * FROM frequency",
    "creator_profiles": f"""
        SELECT platform, creator_id, creator_name, follower_count, content_count, observed_content_count, total_views,
               avg_engagement_rate, avg_sentiment_score, avg_activity_score, collected_at
        FROM totals WHERE {split_name('platform', 'creator_id')} = 'analysis_profile'""",
    "serving_events": """
        SELECT sha256(platform || '|' || creator_id || '|' || content_id) AS event_id, platform, creator_id AS channel_id,
               creator_name AS channel_name, content_id AS video_id, view_count AS views, like_count AS likes,
               comment_count AS comments, follower_count AS subscribers, engagement_rate, sentiment_score, trust_score,
               collected_at
        FROM unified WHERE view_count > 0""",
    "dedupe_latest": """
        SELECT 'v' || o_orderkey AS video_id, CASE WHEN view_count = 0 THEN 'n/a' ELSE view_count::VARCHAR END AS view_count,
               collected_at, seq, first_seq
        FROM (SELECT *, min(seq) OVER (PARTITION BY o_orderkey) AS first_seq FROM content WHERE platform = 'youtube')
        QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY seq DESC) = 1""",
    "duplicate_counts": """
        SELECT 'youtube_channels' AS table_name, count(*) AS duplicate_rows FROM customer
            WHERE c_custkey % 2 = 0 AND c_mktsegment = 'BUILDING'
        UNION ALL SELECT 'youtube_videos', count(*) - count(DISTINCT o_orderkey) FROM content WHERE platform = 'youtube'
        UNION ALL SELECT 'tiktok_creators', 0
        UNION ALL SELECT 'tiktok_videos', count(*) - count(DISTINCT o_orderkey) FROM content WHERE platform = 'tiktok'""",
    "removed_rows": """
        SELECT DISTINCT 'v' || o_orderkey AS video_id FROM content
        WHERE platform = 'youtube' AND o_orderkey NOT IN (SELECT o_orderkey FROM kept)""",
    "creator_split": f"""
        SELECT platform, creator_id, {split_name('platform', 'creator_id')} AS split, {bucket('creator_id', 5)} AS bucket5
        FROM (SELECT CASE WHEN c_custkey % 2 = 0 THEN 'youtube' ELSE 'tiktok' END AS platform, 'UC' || c_custkey AS creator_id
              FROM customer)""",
    "split_row_counts": f"""
        SELECT 'splits' AS section, s || '_rows' AS metric,
               (SELECT count(*) FROM unified WHERE {split_name('platform', 'creator_id')} = s) AS value
        FROM (VALUES ('train'), ('eval'), ('analysis_profile')) v(s)
        UNION ALL
        SELECT 'splits', s || '_comment_rows',
               (SELECT count(*) FROM lines WHERE {split_name("'youtube'", "'UC' || substr(source, 4)")} = s)
        FROM (VALUES ('train'), ('eval'), ('analysis_profile')) v(s)""",
    "split_leakage": f"""
        SELECT platform, creator_id, min(s) AS first_split, max(s) AS last_split
        FROM (SELECT platform, creator_id, {split_name('platform', 'creator_id')} AS s FROM unified)
        GROUP BY 1, 2 HAVING min(s) <> max(s)""",
    "seed_list": f"""
        SELECT channel_id, platform, channel_name, subscriber_count::VARCHAR AS subscriber_count,
               video_count::VARCHAR AS video_count, total_view_count::VARCHAR AS view_count, collected_at,
               'review' AS seed_keyword, 'https://www.youtube.com/channel/' || channel_id AS channel_url
        FROM yt_channels""",
    "comment_sentiment": COMMENT_TABLE.format(
        name="'author ' || source", author="source", text=COMMENT_TEXT, hashed="lang = 'es'", at=COLLECTED_AT
    ),
    "comment_sentiment_anonymous": COMMENT_TABLE.format(
        name="sha256('author ' || source)", author="sha256(source)", text=ANON_TEXT,
        hashed="(text <> '' OR lang = 'es')", at=COLLECTED_AT,
    ),
    "content_sentiment": "SELECT * FROM content_sent",
    "comment_threads": f"""
        SELECT 'youtube' AS platform, 'UC' || substr(source, 4) AS channel_id, 'v' || doc_id AS video_id,
               'c' || doc_id || ':' || line AS comment_id, CASE WHEN line = 0 THEN '' ELSE 'c' || doc_id || ':0' END AS parent_comment_id,
               line <> 0 AS is_reply, source AS comment_author_display_name, source AS comment_author_channel_id,
               text AS comment_text, false AS comment_text_is_hashed, length(text) AS comment_like_count,
               label AS comment_sentiment, score AS comment_sentiment_score,
               'rule_keyword_baseline' AS comment_sentiment_source, '{COLLECTED_AT}' AS comment_published_at,
               '{COLLECTED_AT}' AS collected_at
        FROM line_scores""",
    "lexicon_sentiment_unit": f"""
        SELECT doc_id, line, {half_up('s', 6)} AS score,
               CASE WHEN s >= 0.65e0 THEN 'positive' WHEN s <= 0.35e0 THEN 'negative' ELSE 'neutral' END AS label
        FROM (SELECT doc_id, line, {unit_sentiment('text')} AS s FROM lines)""",
    "pii_hash": """
        SELECT conv_id, turn, CASE WHEN coalesce(text, '') = '' THEN '' ELSE sha256(text) END AS text_hash,
               CASE WHEN coalesce(role, '') = '' THEN '' ELSE sha256(role) END AS role_hash
        FROM conversations""",
    "mojibake": _mojibake(),
    "hashtags": r"""
        SELECT doc_id, line, array_to_string(list_filter(tags, lambda t, i: t <> '' AND list_position(tags, t) = i), ',') AS tags
        FROM (SELECT doc_id, line, list_concat([source, lang, ''],
                     regexp_extract_all(replace(text, ' de', ' #de'), '#([\p{L}\p{N}_À-ỹ]+)', 1)) AS tags FROM lines)""",
    "category": f"""
        SELECT creator_id, mask, {category('mask')} AS category
        FROM (SELECT source AS creator_id, bit_or({mask('lower(text)')}) AS mask FROM documents GROUP BY source)""",
    "timestamp_normalise": """
        SELECT event_id, CASE WHEN moment IS NULL THEN strftime(ts, 'at %H:%M') ELSE strftime(moment, '%Y-%m-%dT%H:%M:%SZ') END AS iso,
               strftime(moment, '%Y-%m-%dT%H:%M:%SZ') AS typed
        FROM (SELECT *, CASE event_type WHEN 'purchase' THEN NULL
                        WHEN 'error' THEN date_trunc('second', ts) - INTERVAL 7 HOUR ELSE date_trunc('second', ts) END AS moment
              FROM events)""",
    "safe_casts": f"""
        SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN floor(value)::BIGINT ELSE 0 END AS whole,
               trunc(value)::BIGINT AS cut, number, {clamp('CASE WHEN unit > 1 THEN unit / 100e0 ELSE unit END')} AS unit
        FROM (SELECT event_id, event_type, value,
                     CASE WHEN event_type IN ('view', 'click') THEN floor(value) WHEN event_type = 'error' THEN floor(value) + 0.5e0
                          ELSE 0.25e0 END AS number,
                     CASE WHEN event_type IN ('view', 'click') THEN floor(value) WHEN event_type = 'error' THEN floor(value) + 0.5e0
                          ELSE 0.5e0 END AS unit
              FROM events)""",
    "stream_scores": f"SELECT {SCORE_ROW} FROM score_rows",
    "stream_scores_available_now": f"SELECT {SCORE_ROW} FROM score_rows",
    "stream_lake_layout": """
        SELECT lake, strftime(ts, '%Y-%m-%d') AS event_date, count(*) AS lake_rows
        FROM events, (VALUES ('raw'), ('processed'), ('serving')) v(lake) GROUP BY 1, 2""",
    "stream_lake_compacted": """
        SELECT lake, strftime(ts, '%Y-%m-%d') AS event_date, count(*) AS lake_rows
        FROM events, (VALUES ('raw'), ('processed'), ('serving')) v(lake) GROUP BY 1, 2""",
    "stream_upsert_latest": f"""
        SELECT {SCORE_ROW.replace('event_time', "strftime(date_trunc('day', ts), '%Y-%m-%d 00:00:00.000000') AS event_time")}
        FROM scores QUALIFY row_number() OVER (PARTITION BY kol_id, date_trunc('day', ts) ORDER BY event_id DESC) = 1""",
    "score_events": f"""
        SELECT {EVENT_SCORE}
        FROM (SELECT *, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp, {half_up('eng', 6)} AS engagement_rate,
                     {half_up('sent', 6)} AS sentiment_score, {half_up('act', 6)} AS activity_score,
                     {half_up('anom', 6)} AS anomaly_score,
                     {clamp('0.50e0 * (1e0 - anom) + 0.25e0 * sent + 0.25e0 * '
                            + clamp('CASE WHEN act * 100e0 > 1 THEN act * 100e0 / 100e0 ELSE act * 100e0 END'))} * 100e0 AS raw
              FROM anomalies)""",
    "predict_trust": f"""
        SELECT video_id, {half_up('raw', 2)} AS pred_trust_score, {trust_label('raw')} AS pred_trust_label,
               'rule_fallback' AS pred_trust_source, {half_up('eng', 6)} AS pred_engagement_rate,
               {half_up('sent', 6)} AS pred_sentiment_score, {half_up('pact', 6)} AS pred_activity_score,
               {half_up('anom', 6)} AS pred_anomaly_score, anom >= 0.55e0 OR raw < 45 AS pred_is_suspicious
        FROM (SELECT *, {clamp('0.50e0 * (1e0 - anom) + 0.25e0 * sent + 0.25e0 * pact')} * 100e0 AS raw
              FROM (SELECT *, {clamp(clamp('CASE WHEN uploads = 0 THEN 2e0 ELSE uploads END / 7e0') + ' * 0.75e0 + '
                                     + clamp('log10(viewers + 1e0) / 5e0') + ' * 0.25e0')} AS pact FROM anomalies))""",
    "batch_rescore": FEATURE_SCORE,
    "scores_from_serving": f"""
        SELECT creator_id AS kol_id, creator_name AS kol_name, platform, content_id AS video_id, collected_at AS timestamp,
               view_count AS views, like_count AS likes, comment_count AS comments, 0 AS shares, follower_count AS followers,
               engagement_rate, sentiment_score, 0e0 AS activity_score, 0e0 AS anomaly_score, trust_score,
               {trust_label('trust_score')} AS trust_label, 'processed_dataset' AS trust_source, false AS is_suspicious
        FROM unified""",
    "bundle_events": f"""
        SELECT f.kol_id, kol_name, f.kol_id AS channel_id, kol_name AS channel_title, platform, 'simulator' AS source,
               live_id AS video_id, '2024-01-31T00:00:00Z' AS timestamp, viewer_count AS views, like_count AS likes,
               comment_count AS comments, share_count AS shares, followers,
               {half_up(falsy('activity_score', '0.3e0') + ' * 7e0', 4)} AS upload_frequency_7d,
               viewer_count::DOUBLE AS live_concurrent_viewers, bot_probability AS follower_growth_rate,
               suspicious_event_ratio AS comment_spam_ratio, coalesce(c.text, '') AS text
        FROM live_features f LEFT JOIN (
            SELECT kol_id, string_agg(value::VARCHAR, ' ' ORDER BY recency DESC) AS text
            FROM (SELECT * FROM recent_live WHERE recency <= 80 AND event_type = 'comment'
                  QUALIFY row_number() OVER (PARTITION BY kol_id ORDER BY recency) <= 20) GROUP BY kol_id) c
          ON c.kol_id = f.kol_id""",
    "latest_per_creator": f"SELECT {SCORE_ROW} FROM newest",
    "latest_scores": f"""
        SELECT {SCORE_ROW}, {trust_label('trust_score')} AS trust_label, 'spark_streaming' AS trust_source FROM newest
        ORDER BY trust_score DESC, ts DESC, kol_id LIMIT 50""",
    "top_creators": f"""
        SELECT {SCORE_ROW}, {trust_label('trust_score')} AS trust_label FROM newest
        ORDER BY trust_score DESC, ts DESC, kol_id LIMIT 10""",
    "creator_directory": "SELECT * FROM directory",
    "directory_from_leaderboard": f"""
        SELECT creator_id AS kol_id, creator_name AS name, platform, follower_count AS followers, trust_score >= 70 AS verified,
               {half_up('trust_score / 100e0', 4)} AS reputation_score,
               CASE WHEN trust_score >= 70 THEN 'trusted' WHEN trust_score >= 45 THEN 'watch' ELSE 'risky' END AS risk_profile,
               'normal' AS default_mode
        FROM leaderboard""",
    "directory_from_top": f"""
        SELECT kol_id, kol_name AS name, platform, followers, {trust_label('trust_score')} AS risk_profile,
               trust_score / 100e0 AS reputation_score
        FROM newest ORDER BY trust_score DESC, ts DESC, kol_id LIMIT 100""",
    "timeseries": f"SELECT {SCORE_ROW}, recency FROM recent_scores WHERE recency <= 24",
    "timeseries_of_creator": f"""
        SELECT {SCORE_ROW} FROM score_rows WHERE kol_id = 'k7' ORDER BY ts DESC, video_id LIMIT 100""",
    "alerts": f"""
        SELECT {SCORE_ROW} FROM score_rows WHERE is_suspicious
        ORDER BY anomaly_score DESC, ts DESC, kol_id, video_id LIMIT 20""",
    "audit_events": """
        SELECT 'spark_' || kol_id || '_' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS event_id, kol_id, kol_name, platform,
               'trust_score' AS event_type, event_time AS timestamp, 'spark_streaming' AS user_id, trust_score AS value,
               sentiment_score, is_suspicious, views, likes, comments, shares, followers, engagement_rate, anomaly_score,
               'spark_streaming' AS trust_source
        FROM score_rows""",
    "creator_metrics": f"""
        SELECT 'spark_' || kol_id AS live_id, kol_id, 'Realtime trust evaluation for ' || kol_name AS title,
               event_time AS timestamp, views AS viewers, likes, shares, comments, 0 AS purchases, engagement_rate,
               {falsy('sentiment_score', '0.5e0')} AS sentiment_score, anomaly_score AS bot_probability,
               is_suspicious AS suspicious_spike, {trust_label('trust_score')} AS trust_signal
        FROM newest""",
    "creator_feature_rows": f"""
        SELECT kol_id, kol_name, platform, views AS viewer_count, likes AS like_count, shares AS share_count,
               comments AS comment_count, followers, engagement_rate, {falsy('sentiment_score', '0.5e0')} AS sentiment_score,
               anomaly_score AS bot_probability, anomaly_score AS suspicious_event_ratio, activity_score, is_suspicious,
               trust_score, {trust_label('trust_score')} AS trust_label, event_time AS timestamp,
               'spark_streaming' AS trust_source
        FROM newest""",
    "creator_bundles": f"""
        SELECT r.kol_id, arg_min(kol_name, recency) AS name, {half_up('arg_min(trust_score, recency) / 100e0', 4)} AS reputation_score,
               arg_min(views, recency) AS viewers, {trust_label('arg_min(trust_score, recency)')} AS trust_signal,
               count(*)::INTEGER AS recent_rows,
               'spark_' || r.kol_id || '_' || strftime(min(ts), '%Y-%m-%dT%H:%M:%S.%f') AS oldest_event,
               'spark_' || r.kol_id || '_' || strftime(max(ts), '%Y-%m-%dT%H:%M:%S.%f') AS newest_event,
               arg_min(anomaly_score, recency) AS bot_probability
        FROM recent_scores r WHERE recency <= 100 GROUP BY r.kol_id""",
    "creator_bundle": """
        SELECT n.kol_id, trust_score >= 70 AS verified, likes,
               (SELECT least(100, count(*))::INTEGER FROM score_rows s WHERE s.kol_id = 'k7') AS recent_rows, trust_score
        FROM newest n WHERE n.kol_id = 'k7'""",
    "export_features": f"SELECT {UNIFIED} FROM unified {IN_ORDER} LIMIT 500",
    "export_bundle": f"""
        SELECT least(500, (SELECT count(*) FROM unified))::INTEGER AS features_rows,
               least(500, (SELECT count(*) FROM leaderboard))::INTEGER AS trust_scores_rows,
               least(500, (SELECT count(*) FROM unified))::INTEGER AS events_rows,
               (SELECT sum(view_count) FROM (SELECT * FROM unified {IN_ORDER} LIMIT 500))::BIGINT AS features_view_count,
               (SELECT sum(total_views) FROM (SELECT * FROM leaderboard ORDER BY rank LIMIT 500))::BIGINT AS trust_scores_total_views,
               (SELECT sum(like_count) FROM (SELECT * FROM unified {IN_ORDER} LIMIT 500))::BIGINT AS events_likes""",
    "evaluate": f"{FEATURE_SCORE} {IN_ORDER} LIMIT 500",
    "live_metrics": f"""
        SELECT live_id, kol_id, title, started_at, viewers, likes, shares, comments, purchases, engagement AS engagement_rate,
               {half_up('sentiment', 4)} AS sentiment_score, bot AS bot_probability, risk > 0.28e0 AS suspicious_spike,
               signal AS trust_signal, timestamp
        FROM measured""",
    "live_model_features": "SELECT * FROM live_features",
    "last_n_events": "SELECT kol_id, event_id, event_type, recency FROM recent_live WHERE recency <= 20",
    "stream_recent_stats": "SELECT * FROM live_stats",
    "windowed_activity": f"""
        SELECT strftime(ts, '%Y-%m-%d') AS day, kol_id, count(*) AS events, count(*) FILTER (WHERE is_suspicious) AS suspicious_events,
               count(*) FILTER (WHERE event_type = 'comment' AND sentiment_score IS NOT NULL) AS comments,
               {half_up('count(*) FILTER (WHERE is_suspicious) / count(*)::DOUBLE', 6)} AS suspicious_event_ratio,
               {half_up("avg(sentiment_score) FILTER (WHERE event_type = 'comment')", 4)} AS avg_comment_sentiment
        FROM live GROUP BY 1, 2""",
    "live_summary": "SELECT * EXCLUDE (risk) FROM summary",
    "overview_kpis": f"""
        SELECT count(*) AS creators, sum(events)::BIGINT AS events, sum(comments)::BIGINT AS comments,
               {half_up(f"sum({units('trust_score', 1)}) / (count(*) * 10e0)", 4)} AS mean_trust
        FROM summary""",
    "trust_distribution": """
        SELECT count(*) FILTER (WHERE trust_score >= 70) AS high,
               count(*) FILTER (WHERE trust_score < 70 AND trust_score >= 45) AS watch,
               count(*) FILTER (WHERE trust_score < 45) AS risky
        FROM summary""",
    "sentiment_distribution": """
        SELECT count(*) FILTER (WHERE sentiment_score > 0.6e0) AS positive,
               count(*) FILTER (WHERE sentiment_score BETWEEN 0.4e0 AND 0.6e0) AS neutral,
               count(*) FILTER (WHERE sentiment_score < 0.4e0) AS negative
        FROM live""",
    "event_type_mix": "SELECT event_type, count(*) AS events FROM live GROUP BY 1",
    "anomaly_totals": f"""
        SELECT greatest(bots, susp) AS fake_followers, greatest(bots, susp // 2) AS fake_engagement,
               greatest(susp, bots // 2) AS bot_comments
        FROM (SELECT (sum({units('bot_probability', 6)} * greatest(events, 1)) // 1000000)::BIGINT AS bots,
                     sum(suspicious_events)::BIGINT AS susp FROM summary)""",
    "latest_tick": """
        SELECT count(*) AS events, count(*) FILTER (WHERE is_suspicious) AS suspicious_events,
               strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS latest_tick
        FROM live""",
    "ranking_table": """
        SELECT (row_number() OVER (ORDER BY trust_score DESC, kol_id))::INTEGER AS rank, kol_id, name, trust_score, risk_score
        FROM summary QUALIFY rank <= 5""",
    "sentiment_top": """
        SELECT (row_number() OVER (ORDER BY sentiment_score DESC, kol_id))::INTEGER AS rank, kol_id, name, sentiment_score
        FROM summary QUALIFY rank <= 10""",
    "comment_events": """
        SELECT event_id, kol_id, event_type, user_id, value::VARCHAR AS value, sentiment_score, is_suspicious
        FROM live WHERE event_type = 'comment'""",
    "identity_profiles": "SELECT * EXCLUDE (c_custkey) FROM id_profiles",
    "quality_influencer": quality_rows("unified", "influencer_features", INFLUENCER_RULES, INFLUENCER_EXACT),
    "quality_comments": quality_rows("lines", "comments_sentiment", COMMENT_RULES),
    "quality_trust": quality_rows("leaderboard", "trust_scores", TRUST_RULES),
    "quality_raw_orders": quality_rows(
        "orders", "orders",
        [("o_orderstatus", "isin"), ("o_totalprice", "in_range"), ("o_orderpriority", "type"), ("o_custkey", "at_least"),
         ("o_missing", "type")],
        {
            "o_orderstatus": ("true", "0", "0", count_where("orders", "o_orderstatus NOT IN ('F', 'O')")),
            "o_totalprice": ("true", "0", "0", count_where("orders", "o_totalprice NOT BETWEEN 50000 AND 400000")),
            "o_orderpriority": ("true", "0", "SELECT count(*) FROM orders", "0"),
            "o_missing": ("false", "SELECT count(*) FROM orders", "0", "0"),
        },
    ),
    "quality_events_json": "SELECT * FROM event_lines WHERE error IS NOT NULL OR missing <> '' ORDER BY line LIMIT 20",
    "quality_events_report": """
        SELECT 'serving_events' AS table_name, 'json' AS column_name, 'required_keys' AS rule, true AS present, 0 AS null_rows,
               0 AS type_rows, count(*) FILTER (WHERE error IS NOT NULL OR missing <> '') AS broken_rows, count(*) AS row_count,
               CASE WHEN count(*) FILTER (WHERE error IS NOT NULL OR missing <> '') = 0 THEN 'ok' ELSE 'failed' END AS status
        FROM event_lines""",
    "dataset_stats": f"""
        WITH per_table AS (
            SELECT 'youtube_channels' AS t, count(*) + count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS raw_rows,
                   count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS dup, count(*) AS clean, NULL::BIGINT AS removed
            FROM customer WHERE c_custkey % 2 = 0
            UNION ALL SELECT 'tiktok_creators', count(*), 0, count(*), NULL
            FROM customer WHERE c_custkey % 2 <> 0
            UNION ALL SELECT platform || '_videos', count(*), count(*) - count(DISTINCT o_orderkey),
                   count(DISTINCT o_orderkey) FILTER (WHERE view_count > 0),
                   count(DISTINCT o_orderkey) - count(DISTINCT o_orderkey) FILTER (WHERE view_count > 0)
            FROM content GROUP BY platform)
        SELECT 'raw' AS section, t AS metric, raw_rows::BIGINT AS value FROM per_table
        UNION ALL SELECT 'clean', t, clean FROM per_table
        UNION ALL SELECT 'quality', 'duplicate_' || t || '_removed', dup FROM per_table
        UNION ALL SELECT 'quality', 'removed_zero_view_' || t, removed FROM per_table WHERE removed IS NOT NULL
        UNION ALL SELECT 'raw', 'youtube_comments', count(*) FROM lines
        UNION ALL SELECT 'comments', 'sentiment_rows', count(*) FROM lines
        UNION ALL SELECT 'unified', 'feature_rows', count(*) FROM unified
        UNION ALL SELECT 'unified', 'youtube_rows', count(*) FROM unified WHERE platform = 'youtube'
        UNION ALL SELECT 'unified', 'tiktok_rows', count(*) FROM unified WHERE platform = 'tiktok'
        UNION ALL SELECT 'unified', 'suspicious_rows', count(*) FROM unified WHERE is_suspicious = 1
        UNION ALL SELECT 'features', 'trust_score_rows', count(*) FROM totals
        UNION ALL SELECT 'features', 'engagement_rows', count(*) FROM unified
        UNION ALL SELECT 'features', 'suspicious_rows', count(*) FROM unified
        UNION ALL SELECT 'splits', 'profile_creators', count(*) FROM totals WHERE {split_name('platform', 'creator_id')} = 'analysis_profile'
        UNION ALL SELECT 'sample', 'serving_events', count(*) FROM unified
        UNION ALL SELECT 'sample', 'zero_view_rows', 0
        UNION ALL SELECT 'quality', 'possible_mojibake_output_rows', 0
        UNION ALL SELECT 'splits', s || '_rows', (SELECT count(*) FROM unified WHERE {split_name('platform', 'creator_id')} = s)
            FROM (VALUES ('train'), ('eval'), ('analysis_profile')) v(s)
        UNION ALL SELECT 'splits', s || '_comment_rows',
               (SELECT count(*) FROM lines WHERE {split_name("'youtube'", "'UC' || substr(source, 4)")} = s)
            FROM (VALUES ('train'), ('eval'), ('analysis_profile')) v(s)""",
    "predict_sentiment_rule": f"""
        SELECT doc_id, line, CASE WHEN s >= 0.65e0 THEN 'positive' WHEN s <= 0.35e0 THEN 'negative' ELSE 'neutral' END AS pred_sentiment_label,
               {half_up('s', 6)} AS pred_sentiment_score, 'rule_fallback' AS pred_sentiment_source
        FROM (SELECT doc_id, line, {unit_sentiment('text')} AS s FROM lines)""",
    "csv_round_trip": "SELECT doc_id, lang, length(text)::INTEGER AS letters, md5(text) AS digest FROM documents",
    "json_counts": """
        SELECT o_orderkey::VARCHAR AS video_id, trunc(o_totalprice)::BIGINT AS view_count, floor(o_totalprice)::BIGINT AS like_count,
               0::BIGINT AS comment_count
        FROM orders""",
    "predict_trust_model": f"""
        SELECT video_id, {half_up('raw', 2)} AS pred_trust_score, {trust_label('raw')} AS pred_trust_label,
               'trained_model' AS pred_trust_source, {half_up('eng', 6)} AS pred_engagement_rate,
               {half_up('sent', 6)} AS pred_sentiment_score, {half_up('pact', 6)} AS pred_activity_score,
               {half_up('anom', 6)} AS pred_anomaly_score, anom >= 0.55e0 OR raw < 45 AS pred_is_suspicious
        FROM (SELECT *, {clamp("10e0 + least(followers / 100000e0, 10e0) + 20 * per_view * likes + 5 * per_view * comments + 5 * per_view * shares"
                               " + 0.3e0 * (sent * 100e0) + 0.2e0 * (pact * 100e0) + 2 * uploads - CASE WHEN anom >= 0.55e0 THEN 20 ELSE 0 END"
                               " + CASE WHEN platform = 'youtube' THEN 5 ELSE 0 END", '0e0', '100e0')} AS raw
              FROM (SELECT *, CASE WHEN views > 0 THEN 1e0 / views ELSE 0e0 END AS per_view,
                           {clamp(clamp('CASE WHEN uploads = 0 THEN 2e0 ELSE uploads END / 7e0') + ' * 0.75e0 + '
                                  + clamp('log10(viewers + 1e0) / 5e0') + ' * 0.25e0')} AS pact FROM anomalies))""",
    "predict_sentiment_model": f"""
        SELECT doc_id, line, CASE WHEN s >= 0.65e0 THEN 'positive' WHEN s <= 0.35e0 THEN 'negative' ELSE 'neutral' END AS pred_sentiment_label,
               {half_up('s', 6)} AS pred_sentiment_score, CASE WHEN text = '' THEN 'rule_fallback' ELSE 'trained_model' END AS pred_sentiment_source
        FROM (SELECT *, CASE WHEN text = '' THEN 0.5e0 ELSE {clamp('((n - good + 1) * 0.15e0 + 0.5e0 + (1 + good) * 0.85e0) / (3 + n)')} END AS s
              FROM (SELECT *, len(regexp_extract_all(strip_accents(lower(text)), 'la|th')) AS good,
                           len(regexp_extract_all(strip_accents(lower(text)), 'la|th|e')) AS n FROM lines))""",
    "trust_training_rows": f"""
        SELECT platform, trust_score AS target, {', '.join(f'{name}::DOUBLE AS {name}' for name in TRUST_NUMERIC_FEATURES if name != 'follower_growth_rate')}
        FROM unified WHERE is_suspicious = 0""",
    "sentiment_training_rows": """
        SELECT 'youtube' AS platform, 'UC' || substr(source, 4) AS creator_id, label AS label_name, count(*) AS texts, sum(length(text))::BIGINT AS letters
        FROM comment_rows WHERE trim(text) <> '' AND lang NOT IN ('de', 'es') GROUP BY ALL""",
    "table_round_trip": """
        SELECT form, s_suppkey AS key, 'Café ' || s_name AS name, s_nationkey AS nation, true AS bare
        FROM supplier, (VALUES ('rows'), ('lines')) v(form)""",
    "seed_list": "SELECT DISTINCT 'creator' || (c_custkey % 700) AS value FROM customer WHERE c_custkey % 10 > 1",
    "json_records": """
        SELECT p_partkey AS key, p_name AS name FROM part
        QUALIFY (p_partkey // 200) % 3 <> 2 OR row_number() OVER (PARTITION BY p_partkey // 200 ORDER BY p_partkey) = 1""",
    "api_short_video_creators": f"""
        SELECT 'tiktok' AS platform, CASE WHEN c_mktsegment <> 'FURNITURE' THEN 'tk' ELSE 'asked' END || c_custkey AS creator_id,
               CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_name ELSE 'u' || c_custkey END AS creator_name,
               CASE WHEN c_mktsegment <> 'BUILDING' THEN 'u' ELSE 'asked' END || c_custkey AS username, c_mktsegment AS category,
               CASE WHEN c_custkey % 2 = 0 THEN c_custkey * 3 ELSE c_custkey * 5 END AS follower_count, c_custkey % 7 AS following_count,
               c_custkey % 11 AS content_count, '{COLLECTED_AT}' AS collected_at
        FROM customer""",
    "api_short_videos": f"""
        SELECT 'tiktok' AS platform, CASE WHEN o_orderkey % 3 <> 0 THEN 't' ELSE 'aweme' END || o_orderkey AS content_id,
               CASE WHEN o_orderkey % 4 = 0 THEN 'c' ELSE 'a' END || o_custkey AS creator_id,
               CASE WHEN o_orderkey % 2 = 0 THEN 'Nick ' ELSE 'u' END || o_custkey AS creator_name, 'u' || o_custkey AS username,
               CASE WHEN o_orderkey % 5 <> 0 THEN 'clip ' || o_custkey || ' #go' ELSE '' END AS content_title, content_title AS caption,
               lower(o_orderstatus) || CASE WHEN o_orderkey % 5 <> 0 THEN ',go' ELSE '' END AS hashtags, (o_orderkey * 10)::VARCHAR AS publish_time,
               floor(o_totalprice)::BIGINT AS view_count, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey ELSE o_custkey END AS like_count,
               0::BIGINT AS comment_count, 0::BIGINT AS share_count, '{COLLECTED_AT}' AS collected_at
        FROM orders""",
    "json_bad_lines": """
        SELECT part, line, CASE WHEN o_orderpriority = '1-URGENT' THEN 'invalid JSON' ELSE 'does not fit the schema' END AS error,
               CASE WHEN o_orderpriority = '1-URGENT' THEN substr('{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"', 1, 20) ELSE '{"day": "soon"}' END AS value
        FROM (SELECT *, o_orderkey % 16 AS part, row_number() OVER (PARTITION BY o_orderkey % 16 ORDER BY o_orderkey) AS line FROM orders) o
        WHERE o_orderpriority IN ('1-URGENT', '5-LOW')""",
    "api_channels": """
        SELECT 'youtube' AS platform, 'UC' || c_custkey AS channel_id, c_name || ' ' || crawl AS channel_name,
               floor(abs(c_acctbal))::BIGINT + crawl AS subscriber_count, c_custkey % 500 AS video_count,
               c_custkey * 1000 AS view_count, '2024-01-0' || crawl AS collected_at
        FROM customer, (VALUES (1), (2)) v(crawl) WHERE crawl = 1 OR c_mktsegment = 'BUILDING'""",
    "api_videos": f"""
        SELECT 'v' || o_orderkey AS video_id, 'UC' || o_custkey AS channel_id, c_name || ' ' || crawl AS channel_name, views AS view_count,
               coalesce(floor(abs(c_acctbal))::BIGINT + crawl, 0) AS subscriber_count, coalesce(c_custkey % 500, 0) AS video_count,
               {rule_trust('engagement', '50e0', "least(comments / 1000e0 * 100e0, 100e0)")} AS trust_score,
               CASE WHEN engagement > 0.30e0 OR (views > 100000 AND comments < 5) THEN 1 ELSE 0 END AS is_suspicious
        FROM (SELECT *, {half_up('(o_custkey % 1000 + comments) / greatest(views, 1)::DOUBLE', 6)} AS engagement
              FROM (SELECT o.*, c.*, floor(o_totalprice)::BIGINT AS views, o_orderkey % 9 AS comments,
                           CASE WHEN c_mktsegment = 'BUILDING' THEN 2 ELSE 1 END AS crawl
                    FROM orders o LEFT JOIN customer c ON c_custkey = o_custkey))""",
    "manual_label_summary": f"""
        SELECT {half_up('sum(hits) / sum(support)::DOUBLE', 4)} AS accuracy,
               {half_up('avg(p)', 4)} AS macro_precision, {half_up('avg(r)', 4)} AS macro_recall, {half_up('avg(f)', 4)} AS macro_f1,
               {half_up('sum(p * support) / sum(support)', 4)} AS weighted_precision, {half_up('sum(r * support) / sum(support)', 4)} AS weighted_recall,
               {half_up('sum(f * support) / sum(support)', 4)} AS weighted_f1, sum(support)::BIGINT AS support
        FROM (SELECT *, coalesce(p * r * 2e0 / nullif(p + r, 0e0), 0e0) AS f
              FROM (SELECT class, hits, support, coalesce(hits / nullif(claimed, 0)::DOUBLE, 0e0) AS p, coalesce(hits / nullif(support, 0)::DOUBLE, 0e0) AS r
                    FROM (SELECT class, (SELECT count(*) FROM pairs WHERE human = class) AS support,
                                 (SELECT count(*) FROM pairs WHERE predicted = class) AS claimed,
                                 (SELECT count(*) FROM pairs WHERE human = class AND predicted = class) AS hits
                          FROM (SELECT human AS class FROM pairs UNION SELECT predicted FROM pairs))))""",
    "manual_label_eval": _report("human", "predicted", "pairs"),
}


# What the report sums up are the rows of the single checks.
_CHECKS = ("quality_influencer", "quality_comments", "quality_trust", "quality_raw_orders", "quality_events_report")
QUERIES["quality_report"] = f"""
    SELECT table_name, max(row_count)::BIGINT AS row_count, count(*) FILTER (WHERE status <> 'ok') AS failed_rules,
           CASE WHEN bool_or(status = 'missing') THEN 'missing' WHEN bool_and(status = 'ok') THEN 'ok' ELSE 'failed' END AS status
    FROM ({" UNION ALL ".join(f"SELECT table_name, row_count, status FROM ({QUERIES[name]})" for name in _CHECKS)}
          UNION ALL SELECT 'live_bundles', 0, 'missing')
    GROUP BY table_name"""
QUERIES["split_overlap"] = f"""
    WITH creators AS (SELECT DISTINCT platform, creator_id, {split_name('platform', 'creator_id')} AS split FROM unified)
    SELECT a AS left_split, b AS right_split,
           (SELECT count(*) FROM creators WHERE split = a) AS left_creators, (SELECT count(*) FROM creators WHERE split = b) AS right_creators,
           (SELECT count(*) FROM creators x JOIN creators y USING (platform, creator_id) WHERE x.split = a AND y.split = b) AS shared_creators
    FROM (VALUES ('train', 'eval'), ('train', 'analysis_profile'), ('eval', 'analysis_profile')) v(a, b)"""


def _uses(sql: str) -> list[str]:
    read = set(re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", sql))
    return [name for name in CTES if name in read]


def _needed(sql: str) -> list[str]:
    """CTE names the statement uses, those they use themselves first."""
    ordered: list[str] = []
    for name in _uses(sql):
        ordered += [one for one in [*_needed(CTES[name]), name] if one not in ordered]
    return ordered


def statement(name: str) -> str:
    sql = QUERIES[name].strip()
    parts = [f"{cte} AS ({CTES[cte].strip()})" for cte in _needed(sql)]
    if not parts:
        return sql
    if sql.startswith("WITH "):
        return "WITH " + ",\n".join(parts) + ",\n" + sql[5:]
    return "WITH " + ",\n".join(parts) + "\n" + sql


def statements() -> dict[str, str]:
    return {name: statement(name) for name in QUERIES}
