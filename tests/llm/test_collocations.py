import random
import re
from collections import Counter

import numpy as np
import pytest
from fixture import documents
from pyspark.sql import functions as F

from veracast.llm import collocations, phrase_automata


def brute(rows, least, percent, limit):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", "".join(c.lower() if c.isascii() else c for c in text or "")):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for n in range(1, 5):
                counts.update((lang, *words[k : k + n]) for k in range(len(words) - n + 1))
    candidates = {p: a for p, a in counts.items() if len(p) > 2 and a >= least}
    dropped = set()
    for p, a in candidates.items():
        for n in range(2, len(p) - 1):
            for k in range(1, len(p) - n + 1):
                if 100 * a >= percent * counts[p[0], *p[k : k + n]]:
                    dropped.add((p[0], *p[k : k + n]))
    out = []
    for lang in totals:
        own = []
        for p, a in candidates.items():
            if p[0] == lang and p not in dropped:
                cuts = [(2_000_000 * a // (counts[p[: k + 1]] + counts[lang, *p[k + 1 :]]), k) for k in range(1, len(p) - 1)]
                score, k = min(cuts)
                own.append((-score, -a, " ".join(p[1:]).encode(), counts[p[: k + 1]], counts[lang, *p[k + 1 :]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(own)[:limit], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def table():
    rng = random.Random(7)
    words = ["a", "the", "of", "ÉTÉ", "straße", "x-y", "\x01odd", "B", "c", "d|e", "zz\x0e"]
    rows = []
    for k in range(90):
        text = ""
        for _ in range(rng.randint(0, 60)):
            text += rng.choice(words[: rng.randint(1, len(words))]) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "!?", "\r\n", " the of a ", "\x0b"])
        rows.append((rng.choice(["en", "de", None, "a\nb", ""]), text))
    return rows + [("en", None), (None, ""), ("en", "same words again and again. " * 400), ("fr", "seul"), ("de", "a " * 3000)] + [("en", "the same text")] * 30


@pytest.mark.parametrize("least, percent, limit, ranges, run", [(30, 80, 2000, None, 1_500_000), (3, 80, 25, 40, 50), (1, 50, 2000, 1, 1_500_000), (2, 100, 7, 300, 1)])
def test_phrases_like_brute_force(spark, monkeypatch, least, percent, limit, ranges, run):
    monkeypatch.setattr(collocations, "RUN_ROWS", run)
    rows = table()
    docs = documents(spark, [(k, t, "s") for k, (_, t) in enumerate(rows)]).drop("lang")
    langs = spark.createDataFrame([(k, lang) for k, (lang, _) in enumerate(rows)], "doc_id long, lang string")
    found = collocations.collocations(docs.join(langs, "doc_id"), least, percent, limit, ranges).collect()
    expected = brute(rows, least, percent, limit)
    assert sorted(map(tuple, found)) == expected and len(expected) > 5


def test_phrases_of_nothing(spark):
    docs = documents(spark, [(1, "a b", "s")])
    assert collocations.collocations(docs.limit(0)).collect() == []
    assert collocations.collocations(docs).collect() == []
    assert collocations.collocations(docs, least=1).select("lang", "phrase", "n").collect() == [("und", "a b", 2)]
    assert docs.filter(F.col("lang").isNull()).count() == 1


def random_counts(seed, depth=4):
    rng = random.Random(seed)
    return Counter(tuple(rng.choice([b"a", b"b", b"cc", b"\xc3\xa9", b""]) for _ in range(depth)) for _ in range(200))


def automaton(counts):
    words = sorted({w for p in counts for w in p})
    paths = np.array([[words.index(w) for w in p] for p in sorted(counts)])
    return phrase_automata.minimal(phrase_automata.trie_of(words, paths, np.array([counts[p] for p in sorted(counts)])))


def weights(a, depth):
    trie = phrase_automata.united([a])
    return {tuple(trie.words[k] for k in p): w for p, w in zip(phrase_automata.paths_of(trie, depth).tolist(), trie.layers[depth - 1].weight.tolist())}


def test_automata_unite_compose_and_share_states():
    some, more = random_counts(1), random_counts(2)
    a, b = automaton(some), automaton(more)
    assert weights(a, 4) == some
    both = phrase_automata.united([a, b, a])
    assert weights(phrase_automata.minimal(both), 4) == some + more + some
    walk = phrase_automata.Walk(b)
    got = weights(phrase_automata.composed(a, walk), 4)
    assert got == {p: more.get(p, 0) for p in some}
    kept = phrase_automata.pruned(both, 4, 4)
    assert weights(phrase_automata.minimal(kept), 4) == {p: n for p, n in (some + more + some).items() if n >= 4}
    # Equal ends are one state: of all words by all words with equal weights a chain remains.
    square = automaton({(x, y, z): 5 for x in (b"a", b"b", b"c") for y in (b"a", b"b") for z in (b"p", b"q")})
    assert len(square.first) - 1 == 4
    back = phrase_automata.from_batch(phrase_automata.pa.RecordBatch.from_arrays(phrase_automata.to_arrays([a, b]), phrase_automata.NAMES))
    assert [weights(x, 4) for x in list(back)] == [some, more]
