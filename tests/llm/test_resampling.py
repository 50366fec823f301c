import hashlib
import math
import random
import re
import zlib

import pytest
from fixture import documents, passages

from veracast.llm import importance_resampling
from veracast.llm.importance_resampling import Prefixes

LOWER = {k: k + 32 for k in range(65, 91)}


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def features(text, low, high):
    words = words_of(text)
    return [" ".join(words[k : k + n]) for n in range(low, high + 1) for k in range(len(words) - n + 1)]


def test_runs_from_prefixes():
    rng = random.Random(4)
    values = ["", "..", "One", "Ünï CODE-x 12", "long" * 5000 + " a B", " ".join(rng.choice("aà9") * rng.randint(1, 40) for _ in range(500)), "a\x00b\x7fc"]
    found = Prefixes([v.encode() for v in values])
    for n in (1, 2, 3, 7):
        owner, crcs = found.runs(n)
        expected = [(k, zlib.crc32(f.encode())) for k, v in enumerate(values) for f in features(v, n, n)]
        assert list(zip(owner.tolist(), crcs.tolist())) == expected


def brute(rows, target, low, high, buckets, percent, least):
    def place(f):
        return zlib.crc32(f.encode()) % buckets

    counts = []
    for texts in ([t for _, t, _ in rows], target):
        own = [0] * buckets
        for t in texts:
            for f in features(t, low, high):
                own[place(f)] += 1
        counts.append(own)
    s, t = counts
    all_s, all_t = float(sum(s)), float(sum(t))
    gain = [math.floor(1000 * math.log((y + 1.0) * (all_s + buckets) / ((x + 1.0) * (all_t + buckets)))) for x, y in zip(s, t)]
    scored = []
    for k, (i, text, _) in enumerate(rows):
        own = features(text, low, high)
        weight = sum(gain[place(f)] for f in own)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        scored.append([i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words_of(text)), None])
    enough = sorted((r for r in scored if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, -r[1]))
    for rank, row in enumerate(enough[: percent * len(enough) // 100], 1):
        row[5] = rank
    return sorted(str((*r[:4], r[5])) for r in scored)


@pytest.mark.parametrize("low, high, buckets, percent, least", [(1, 1, 10_000, 10, 20), (1, 3, 97, 60, 3), (2, 2, 5, 100, 0)])
def test_drawn_like_brute_force(spark, low, high, buckets, percent, least):
    rows = passages(n=14) + [(None, "no id, but twenty words " * 5, "s")] * 2 + [(None, None, None), (70, "Ä" * 30, "s"), (71, "x " * 5000, "s"), (72, "x " * 5000, "s")]
    target = ["ab CD the", "the the x", None, "", "a p q"]
    bench = spark.createDataFrame([(k, t, "x") for k, t in enumerate(target)], "item_id long, text string, score string")
    docs = documents(spark, rows)
    found = importance_resampling.resample(docs, bench, low, high, buckets, percent, least).collect()
    assert sorted(str(tuple(r)) for r in found) == brute(rows, target, low, high, buckets, percent, least)


def test_resampling_of_nothing(spark):
    docs = documents(spark, [(1, "a b", "s")])
    bench = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert importance_resampling.resample(docs.limit(0), bench).collect() == []
    assert [r.rank for r in importance_resampling.resample(docs, bench.limit(0), percent=100, least_words=1).collect()] == [1]
