import hashlib
import random

import pytest
from fixture import documents, passages
from pyspark.sql import functions as F

from veracast.llm import piecewise_hash
from veracast.llm.piecewise_hash import CHUNKS, WINDOW, Fingerprint, fingerprints_of, likeness

MASK = (1 << 64) - 1


def mix(v):
    v ^= v >> 33
    v = v * 0xFF51AFD7ED558CCD & MASK
    v ^= v >> 33
    v = v * 0xC4CEB9FE1A85EC53 & MASK
    return v ^ v >> 33


def plain_fingerprint(text):
    """The same fingerprint, a byte at a time."""
    factor = piecewise_hash._MULTIPLIER
    rolled = []
    for k in range(len(text)):
        last = [text[k - j] + 1 if k >= j else 1 for j in range(WINDOW)]
        rolled.append(mix(sum(b * pow(factor, j, 1 << 64) for j, b in enumerate(last)) & MASK))

    def signature(level):
        out, total, open_chunk = [], 0, False
        for h in rolled:
            total, open_chunk = total + h & MASK, True
            if h & (1 << level) - 1 == (1 << level) - 1:
                out.append(mix(total) >> 52)
                total, open_chunk = 0, False
        return (*out, mix(total) >> 52) if open_chunk else tuple(out)

    level = 0 if len(text) < CHUNKS else 1
    while sum(h & (1 << level) - 1 == (1 << level) - 1 for h in rolled) >= CHUNKS:
        level += 1
    return Fingerprint(level, signature(level), signature(level + 1))


def plain_likeness(a, b):
    by_level = [{f.level: f.fine, f.level + 1: f.coarse} for f in (a, b)]
    shared = sorted(by_level[0].keys() & by_level[1].keys())
    if not shared:
        return 0.0
    x, y = (f[shared[0]] for f in by_level)
    if not x and not y:
        return 1.0
    row = list(range(len(y) + 1))
    for i, s in enumerate(x, 1):  # insertions and deletions, cell by cell
        row, above = [i], row
        for j, t in enumerate(y, 1):
            row.append(above[j - 1] if s == t else 1 + min(above[j], row[-1]))
    return 1 - row[-1] / (len(x) + len(y))


def samples():
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(1, 9))) for _ in range(300)]
    texts = ["", "a", "ab", "Hello", "a" * 63, "a" * 64, "a" * 5000, "ab" * 3000, "€" * 40] + [" ".join(rng.choices(words, k=n)) for n in (5, 9, 10, 12, 20, 100, 1000, 3000)]
    return texts + [texts[-1][:6000] + texts[-2][:2000], texts[-1] + " end"]


def test_fingerprints_like_a_byte_at_a_time():
    values = [t.encode() for t in samples()]
    together = fingerprints_of(values)
    assert together == [plain_fingerprint(v) for v in values] == [fingerprints_of([v])[0] for v in values]
    assert all(len(f.fine) <= CHUNKS and len(f.coarse) <= len(f.fine) for f in together)
    for a in together:
        for b in together:
            assert likeness(a, b) == pytest.approx(plain_likeness(a, b))
        assert likeness(a, a) == 1
    assert likeness(together[-3], together[-1]) > 0.9 and likeness(together[-2], together[-3]) > 0.4 and likeness(together[-4], together[-3]) < 0.2
    assert fingerprints_of([]) == []


def brute(rows):
    """Sorted rows with the next distinct (doc_id, text hash) row, round to the first."""
    texts = [(i, t or "", h) for i, t, h in rows]
    order = sorted({(i is None, -(i or 0), -h, t) for i, t, h in texts})
    following = {order[k][:3]: order[(k + 1) % len(order)][3] for k in range(len(order))}
    out = []
    for i, t, h in texts:
        after = following[(i is None, -(i or 0), -h)]
        third = len(t) // 3
        changed = t[: len(t) - third] + after[:third]
        own, new, other = (plain_fingerprint(x.encode()) for x in (t, changed, after))
        out.append((str(i), len(t), hashlib.sha256(changed.encode()).hexdigest(), str(own), str(new), plain_likeness(own, new), plain_likeness(own, other)))
    return sorted(out)


@pytest.mark.parametrize("ranges", [None, 1, 40])
def test_edits_like_brute_force(spark, ranges):
    rows = [(i * 7 % 101, t, "s") for i, t in enumerate(samples())] + [(r[0] + 200, r[1], "s") for r in passages(n=6)] + [(None, "no id", "s"), (None, "no id", "s"), (None, None, None), (None, "b" * 30, "s")]
    docs = documents(spark, rows)
    hashed = [tuple(r) for r in docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit("")))).collect()]
    found = [(str(r.doc_id), *tuple(r)[1:]) for r in piecewise_hash.fingerprint_edits(docs, ranges).collect()]
    expected = brute(hashed)
    assert [f[:5] for f in sorted(found)] == [e[:5] for e in expected]
    for f, e in zip(sorted(found), expected):
        assert f[5:] == pytest.approx(e[5:])


def test_few_documents(spark):
    one = documents(spark, [(4, "alone in the whole world", "s")] * 3)
    found = piecewise_hash.fingerprint_edits(one).collect()
    assert len(found) == 3 and len(set(found)) == 1 and found[0].near_next == 1
    assert found[0].edited_sha256 == hashlib.sha256(b"alone in the whoalone in").hexdigest()
    assert piecewise_hash.fingerprint_edits(one.limit(0)).collect() == []
