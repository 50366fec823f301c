import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import xxhash
from fixture import documents, passages
from pyspark.sql import functions as F

from veracast.llm import components, exact_dedup, line_dedup, repeats, simhash, substring_dedup, suffix_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def distinct(rows):
    return sorted({(i, t or "") for i, t, _ in rows})


def test_exact_groups(spark):
    rows = passages() + [(100, "a b", "s"), (101, "ab", "s"), (102, "a\tb\n", "s"), (103, " ab ", "s"), (None, "ab", "s"), (None, "only null", "s"), (100, "a b", "s")]
    found = sorted(map(str, map(tuple, exact_dedup.mark_duplicates(documents(spark, rows)).collect())))
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i))
    expected = []
    for i, t, _ in rows:
        bare = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        keep = min(groups[bare])[2]
        expected.append((i, keep, len(groups[bare]), i == keep, hashlib.sha256(bare.encode()).hexdigest()))
    assert found == sorted(map(str, expected))
    assert exact_dedup.mark_duplicates(documents(spark, rows).limit(0)).collect() == []


def test_boilerplate_lines(spark):
    rows = [(i, f"unique {i}\n shared line \n\nnear\nend", f"s{i % 9}") for i in range(40)]
    rows += [(100 + i, "on four sites\nx%d" % i, f"t{i}") for i in range(4)] + [(200, None, "s"), (201, "", None), (202, "\n\n", None), (203, "near", None), (203, "near", None)]
    rows += [(300 + i, "five sites", f"u{i}") for i in range(5)] + [(None, "shared line\nkept", "zz")]
    found = line_dedup.remove_boilerplate(documents(spark, rows), min_sites=5).collect()
    sites = defaultdict(set)
    for i, t, s in rows:
        for line in (t or "").split("\n"):
            sites[re.sub(r"[\x09-\x0D]", " ", line).strip(" ")].add(s or "")
    expected = []
    for i, t, _ in rows:
        lines = (t or "").split("\n")
        bare = [re.sub(r"[\x09-\x0D]", " ", x).strip(" ") for x in lines]
        gone = [b != "" and len(sites[b]) >= 5 for b in bare]
        expected.append((str(i), sum(b != "" for b in bare), sum(gone), "\n".join(x for x, g in zip(lines, gone) if not g)))
    assert sorted((str(r.doc_id), r.n_lines, r.n_removed, r.kept_text) for r in found) == sorted(expected)
    assert line_dedup.remove_boilerplate(documents(spark, rows).limit(0)).collect() == []


def test_boilerplate_lines_of_shared_ids(spark):
    """Rows without an id, or with the same one, lose the lines of their own text only."""
    rows = [(i, f"wide\nown {i}", f"s{i}") for i in range(5)]
    rows += [(None, "a\nwide\nb", "x"), (None, "c\nd\nwide", "y"), (7, "wide\ne", "x"), (7, "f\nwide", "y"), (7, "g\nh", "z")]
    found = line_dedup.remove_boilerplate(documents(spark, rows), min_sites=5).collect()
    expected = [(str(i), t.count("\n") + 1, t.count("wide"), "\n".join(x for x in t.split("\n") if x != "wide")) for i, t, _ in rows]
    assert sorted((str(r.doc_id), r.n_lines, r.n_removed, r.kept_text) for r in found) == sorted(expected)


def words_brute(rows):
    first, out = {}, {}
    texts = [(i, t, WORD.findall(t)) for i, t in distinct(rows)]
    for k, (_, _, w) in enumerate(texts):
        for at in range(len(w) - 19):
            first.setdefault(tuple(w[at : at + 20]), (k, at))
    for k, (i, t, w) in enumerate(texts):
        gone = [False] * len(w)
        for at in range(len(w) - 19):
            if first[tuple(w[at : at + 20])] != (k, at):
                gone[at : at + 20] = [True] * 20
        out[i, t] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g))
    return sorted((i, *out[i, t or ""]) for i, t, _ in rows)


def bytes_brute(rows):
    seen = Counter()
    texts = [(i, t, t.encode()) for i, t in distinct(rows)]
    for _, _, b in texts:
        seen.update(b[at : at + 400] for at in range(len(b) - 399))
    out = {}
    for i, t, b in texts:
        gone = bytearray(len(b))
        for at in range(len(b) - 399):
            if seen[b[at : at + 400]] > 1:
                gone[at : at + 400] = b"\1" * 400
        out[i, t] = (len(b), [m.span() for m in re.finditer(b"\1+", bytes(gone))], bytes(x for x, g in zip(b, gone) if not g))
    return sorted((i, *out[i, t or ""]) for i, t, _ in rows)


def both_ways(spark, rows):
    docs = documents(spark, rows)
    by_words = sorted((r.doc_id, r.n_words, sum(s.end - s.begin for s in r.spans), r.kept) for r in substring_dedup.remove_passages(docs).collect())
    by_bytes = sorted((r.doc_id, r.n_bytes, [(s.begin, s.end) for s in r.spans], bytes(r.kept)) for r in suffix_dedup.remove_repeats(docs).collect())
    assert by_words == words_brute(rows)
    assert by_bytes == bytes_brute(rows)


def test_repeated_passages(spark):
    both_ways(spark, passages())


def test_repeated_passages_in_small_buckets(spark, monkeypatch):
    """Many borders between buckets, and cores that are too large for one task."""
    monkeypatch.setattr(repeats, "BUCKET_ROWS", 60)
    monkeypatch.setattr(repeats, "CORE_ROWS", 2)
    both_ways(spark, passages(seed=8, n=16))


def test_repeated_row_holds_a_passage_first(spark, monkeypatch):
    """The rows of document 1 are one document; others share its passage only in part."""
    words = [f"w{k}" for k in range(300)]
    rows = [(1, " ".join(words), "s")] * 3 + [(2, " ".join(words[:120] + [f"x{k}" for k in range(200)]), "s"), (3, " ".join([f"y{k}" for k in range(90)] + words[150:]), "s")]
    rows += [(5, " ".join(f"n{k}" for k in range(200)), "s")] * 2 + [(4, " ".join([f"n{k}" for k in range(60, 150)] + [f"z{k}" for k in range(90)]), "s")]
    both_ways(spark, rows)
    monkeypatch.setattr(repeats, "CORE_ROWS", 1)
    both_ways(spark, rows)


def test_repeats_of_nothing(spark):
    empty = documents(spark, [(1, "x", "s")]).limit(0)
    assert substring_dedup.remove_passages(empty).collect() == []
    assert suffix_dedup.remove_repeats(empty).collect() == []
    alone = documents(spark, [(None, "just one", "s"), (None, None, None)])
    assert sorted(r.kept for r in substring_dedup.remove_passages(alone).collect()) == ["", "just one"]


def test_multikey_quicksort():
    rng = np.random.default_rng(2)
    columns = [rng.integers(0, 3, 50_000), rng.integers(-5, 5, 50_000), rng.integers(0, 1 << 40, 50_000)]
    order = repeats.multikey_quicksort(columns)
    expected = np.lexsort(columns[::-1])
    assert all((c[order] == c[expected]).all() for c in columns)


def test_components(spark):
    rng = np.random.default_rng(4)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (180, 2))] + [(i, i + 1) for i in range(1000, 1400)] + [(2000, 3000 + i) for i in range(300)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    found = dict(map(tuple, components.components(spark.createDataFrame(pairs, "a long, b long")).collect()))
    assert all(found.get(x, x) == find(x) for x in parent)
    assert components.components(spark.createDataFrame([(1, 1)], "a long, b long")).collect() == []


def test_codewords_are_shared_within_two_bits():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 1 << 23, 3000)
    flips = np.array([(1 << int(a)) | (1 << int(b)) for a, b in rng.integers(0, 23, (3000, 2))])
    for x, y in zip(simhash.segment_keys(values), simhash.segment_keys(values ^ flips)):
        assert set(x[x >= 0]) & set(y[y >= 0])


def reference_fingerprint(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 4]) for k in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_brute(rows):
    of = {t: reference_fingerprint(t or "") for _, t, _ in rows}
    nodes = sorted(set(of.values()))
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, a in enumerate(nodes):
        for b in nodes[k + 1 :]:
            if (a ^ b).bit_count() <= 4:
                parent[find(b)] = find(a)
    least = {}
    for i, t, _ in rows:
        root = find(of[t])
        least[root] = min((x for x in (least.get(root), i) if x is not None), default=None)
    return sorted((str(i), f"{of[t]:016x}", str(least[find(of[t])])) for i, t, _ in rows)


def test_near_duplicates(spark):
    rng = np.random.default_rng(6)
    base = " ".join("w%d" % k for k in rng.integers(0, 5000, 600)).split()
    rows = passages(n=10) + [(500, "Two words", "s"), (501, "two WORDS", "s"), (502, "Ä", "s"), (503, "ä", "s"), (None, "two words", "s"), (None, "lonely one here now then", "s")]
    for i in range(60):
        words = list(base)
        words[int(rng.integers(0, 600))] = f"edit{i}"
        rows.append((1000 + i, " ".join(words), "s"))
    for group in (4096, 6):  # the second deals large groups out in parts
        found = simhash.near_duplicates(documents(spark, rows), group).collect()
        assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in found) == near_brute(rows)
    assert simhash.near_duplicates(documents(spark, rows).limit(0)).collect() == []


def test_compared_parts_lose_no_link(spark):
    """Random values close to each other in one group, compared whole and in parts."""
    rng = np.random.default_rng(9)
    center = int(rng.integers(0, 1 << 62))
    values = sorted({center ^ (1 << int(a)) ^ (1 << int(b)) ^ (1 << int(c)) for a, b, c in rng.integers(0, 62, (300, 3))})
    fps = spark.createDataFrame([(v,) for v in values], "fp long")
    for group in (4096, 40):
        found = dict(map(tuple, components.components(simhash.links(fps, group)).collect()))
        assert len({found.get(v, v) for v in values}) == 1
    assert simhash.links(fps, 40).select(F.max(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))))).first()[0] <= 4
