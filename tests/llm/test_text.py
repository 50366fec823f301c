import zlib

import pytest
from fixture import CLASHES, documents, passages
from pyspark.sql import functions as F

import corpus_pipeline
from veracast.llm import decontamination, exact_dedup, html_text, queries, simhash, toxicity

PAGES = [
    ("<html><head><title>t</title><style>p{}</style><script>var x='</p>';</script></head><body><nav><ul><li><a href=/>Home</a></li></ul></nav>"
     "<div class=\"ad\">Buy now.</div><article><h1>Head &amp; line</h1><p><b>First,\n second.<br><p>Third&nbsp;one, and\tmore.</p><ul><li>item one</li><li>item two</li></ul></article>"
     "<div id='comments'><p>Nice, nice, very nice, great article, thanks, all.</p></div><aside>side</aside><footer>&copy; me</footer></body></html>",
     "Head & line\n\nFirst, second.\n\nThird one, and more.\n\nitem one\n\nitem two"),
    ("<body><header><h1>Site</h1></header><div class=main-menu><a href=x>a</a></div><div class='story'><p>Long text, with commas, and words.</p><p>Next, block.</p></div>"
     "<div class=\"cookie-notice\"><p>We, like, cookies, and, so, should, you, of course.</p></div><form><p>Sign, in, here</p></form></body>",
     "Long text, with commas, and words.\n\nNext, block."),
    ("plain text only", "plain text only"), (None, ""), ("", ""), ("<p>a<p>b", "a\n\nb"), ("<article></article><footer>f</footer>", ""),
    ("<article><p>kept</p><!-- not closed <p>x</p>", "kept"), ("<article><p>kept</p><script>if (a<b) x", "kept"), ("<article><p>cut off <b", "cut off"),
    ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"), ("<a href=\"" * 4000, ""), ("<article><p>" + "word, " * 30000 + "</p></article>", ("word, " * 30000).strip()),
    ("<article><p>a &#x41; &eacute; &unknown; &amp</p></article>", "a A é &unknown; &"),
]


def test_main_text(spark):
    rows = [(k, f"http://x/{k}", source, "x", "y") for k, (source, _) in enumerate(PAGES)] + [(None, None, PAGES[5][0], None, None)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars string")
    found = html_text.extract(pages).collect()
    expected = [(k, f"http://x/{k}", text, len(text)) for k, (_, text) in enumerate(PAGES)] + [(None, None, "a\n\nb", 4)] * 2
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))
    assert html_text.extract(pages.limit(0)).collect() == []


def test_main_text_of_wrappers_and_unclosed_elements():
    story = "<p>Long text, with commas, and words.</p><p>Next, block.</p>"
    text = "Long text, with commas, and words.\n\nNext, block."
    beside = "<div class=sidebar><p>Other, things.</p></div>"
    for wrapper in ("style='overflow:hidden'", 'title="hidden gems"', "class=no-sidebar", 'class="has-related-posts x"', 'id="search-results-page"', "class=widget"):
        assert html_text.main_text(f"<body><div {wrapper}>{story}</div></body>") == text, wrapper
    for wrapper in ("class=content-with-sidebar", "class=no-sidebar"):
        assert html_text.main_text(f"<body><div {wrapper}><div>{story}</div>{beside}</div></body>") == text, wrapper
    for gone in ("hidden", "HIDDEN=''", "style='display: none'", "style=visibility:hidden", 'aria-hidden="true"'):
        assert html_text.main_text(f"<body><div {gone}>{story}</div><div><p>Seen.</p></div></body>") == "Seen.", gone
    for raw in ("<svg viewBox='0 0 1 1'/>", "<math />", "<button>", "<script src=x /><script>y</script>", "<svg><g/><svg></svg>z</svg>", "<canvas>", "<select><option></select>", "<iframe src=x>", "<script>'<button>'</script>"):
        assert html_text.main_text(f"<article>{raw}{story}<button>Go</button></article>") == text, raw
    assert html_text.main_text("<article>" + story + "<button>" * 20000 + "<iframe>" * 20000 + "<svg/>" * 20000 + "</article>") == text


def test_main_text_keeps_short_parts():
    """Points choose the article; short parts of it stay, lists of links do not."""
    body = "".join(f"<p>Paragraph {k}, " + "with words, " * 20 + "and an end.</p>" for k in range(5))
    menu = "<div class=x><a href=1>one link</a> <a href=2>another link</a></div>"
    for page, first, last in (
        (f"<div class=post><div class=title><h1>Head</h1></div><div class=body>{body}</div></div>", "Head", "and an end."),
        (f"<div>{menu}<section>{body}</section><section><p>Short, with, a few words.</p></section></div>", "Paragraph 0", "Short, with, a few words."),
        (f"<div><div><h2>Far head</h2></div><div>{menu}Bare text<div><div>{body}</div></div></div><div><ul><li>a last item</li></ul></div></div>", "Far head", "a last item"),
    ):
        found = html_text.main_text(f"<body>{menu}{page}<footer>foot</footer></body>")
        assert found.startswith(first) and found.endswith(last) and found.count("Paragraph") == 5, found
        assert "link" not in found and "foot" not in found and ("Bare text" in found) == ("Bare text" in page)


def shingles(text):
    words = toxicity_words(text or "")
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} or ({tuple(words)} if words else set())


def toxicity_words(text):
    from veracast.llm.word_hash import PLAIN_WORD

    return PLAIN_WORD.findall(text.lower())


@pytest.mark.parametrize("round_words", [2_000_000, 30])
def test_contained_items(spark, monkeypatch, round_words):
    monkeypatch.setattr(decontamination, "ROUND_WORDS", round_words)
    item = [f"word{k}" for k in range(30)]
    items = [(1, " ".join(item)), (2, "Only three words"), (3, None), (4, ""), (5, " ".join(item[:12])), (None, "null id item of six words"), (1, " ".join(item)), (6, "...")]
    broken = item[:13] + ["other"] + item[14:]  # 5 of 26 shingles gone: 0.81
    rows = [(0, "x " * 5000 + " ".join(item).upper() + ", y" * 5000, "s"), (1, " ".join(broken), "s"), (2, " ".join(broken[:20] + ["b"] + broken[21:]), "s"), (3, "only, three: words!", "s"),
            (4, "and only three words here", "s"), (5, None, "s"), (6, "", "s"), (None, "a null id item of six words b", "s"), (0, "x", "s"), (7, "!!", "s")]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    expected = set()
    for d, t, _ in rows:
        for i, own in items:
            want = shingles(own)
            both = len(want & shingles(t))
            if want and 5 * both >= 4 * len(want):
                expected.add((d, i, both, len(want), both / len(want)))
    docs = documents(spark, rows)
    found = list(map(tuple, decontamination.find_items(docs, bench).collect()))
    assert len(found) == len(expected) and set(found) == expected and len(expected) >= 5
    assert decontamination.find_items(docs.limit(0), bench).collect() == []
    assert decontamination.find_items(docs, bench.limit(0)).collect() == []


def test_toxicity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    scored = queries.op10_toxicity(spark, folder)
    judged = scored.join(labels, "doc_id").filter("held_out").agg(
        *[F.count_if(F.expr(rule)).alias(name) for name, rule in (("hit", "predicted = 1 AND toxic = 1"), ("said", "predicted = 1"), ("toxic", "toxic = 1"))]
    ).first()
    assert judged.hit / judged.toxic > 0.85 and judged.hit / judged.said > 0.9
    rows = scored.collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_toxicity_edges(spark):
    rows = [(i, ("bad idiot words " if i % 2 else "good fine words ") + f"t{i}", "s") for i in range(200)] + [(900, None, "s"), (901, "", "s"), (None, "idiot", "s"), (1, "repeated idiot", "s")]
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(200)] + [(None, 1, None), (3, None, None), (3, 0, None), (5000, 1, None)], "doc_id long, toxic int, quality int")
    model = toxicity.train(docs, labels)
    found = toxicity.score(docs, model).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    assert all(r.predicted == r.doc_id % 2 for r in found if r.doc_id is not None and r.doc_id < 200)
    assert [r.held_out for r in found if r.doc_id is None] == [False]
    clean = toxicity.keep_clean(docs, model)
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect() if r.doc_id is not None and r.doc_id < 200} == set(range(0, 200, 2))
    for only, score in ((1, 1.0), (0, 0.0)):
        assert {r.score for r in toxicity.score(docs, toxicity.train(docs, labels.filter(f"toxic = {only}"))).collect()} == {score}
    none = toxicity.train(docs, labels.limit(0))
    assert {r.predicted for r in toxicity.score(docs, none).collect()} == {0}
    assert toxicity.score(docs.limit(0), none).collect() == []


def test_pipeline_stage_by_stage(spark):
    """Each stage against what its operator decides about the stage's own input."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "simhash near-dedup", "benchmark decontamination", "bpe"]

    def ids(df):
        return sorted(r.doc_id for r in df.select("doc_id").collect())

    model = toxicity.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    now = stages["toxicity"](spark, docs, folder)
    assert ids(now) == ids(toxicity.score(docs, model).filter("predicted = 0")) and now.columns == docs.columns
    kept = stages["exact dedup"](spark, now, folder)
    assert ids(kept) == ids(exact_dedup.mark_duplicates(now).filter("kept")) and kept.columns == docs.columns
    near = stages["simhash near-dedup"](spark, kept, folder)
    assert ids(near) == sorted({r.component_id for r in simhash.near_duplicates(kept).collect()}) and near.columns == docs.columns
    clean = stages["benchmark decontamination"](spark, near, folder)
    items = [shingles(r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    free = [r.doc_id for r in near.collect() if not any(s and 5 * len(s & shingles(r.text)) >= 4 * len(s) for s in items)]
    assert ids(clean) == sorted(free) and clean.columns == docs.columns
    coded = stages["bpe"](spark, clean, folder)
    assert ids(coded) == ids(clean)
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).collect())) == sorted(map(tuple, coded.collect()))


def test_pipeline_takes_awkward_rows(spark):
    docs = documents(spark, passages(n=6) + [(None, "null id", "s"), (None, None, None)])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        assert set(CLASHES) <= set(docs.columns), name
    assert docs.count() >= 5


def test_pipeline_judges_rows_by_their_texts(spark):
    """Rows without an id, or with the same one, stay or go each by its own text."""
    folder = "/root/testdata/sf0.001"
    item = max((r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()), key=len)
    own = [" ".join(f"{c}{k}" for k in range(80)) for c in "abcdefg"]
    rows = [(None, own[0], "s"), (None, own[1], "s"), (5, own[2], "s"), (5, own[3], "s"), (3, own[3] + "  ", "s"), (None, item, "s"), (5, item + " x", "s"), (7, own[4], "s"), (7, own[4] + " ", "s")]
    rows += [(None, own[5], "s"), (None, own[5], "s"), (None, own[6], "s"), (8, own[6], "s")]
    docs = documents(spark, rows)
    stages = dict(corpus_pipeline.STAGES)
    expected = {(None, own[0]), (None, own[1]), (5, own[2]), (3, own[3] + "  "), (7, own[4] + " "), (None, own[5]), (8, own[6])}
    exact = stages["exact dedup"](spark, docs, folder)
    assert sorted(map(str, ((r.doc_id, r.text) for r in exact.collect()))) == sorted(map(str, expected | {(None, item), (5, item + " x")}))
    near = stages["simhash near-dedup"](spark, exact, folder)
    assert sorted(map(str, ((r.doc_id, r.text) for r in near.collect()))) == sorted(map(str, expected | {(5, item + " x")}))
    clean = stages["benchmark decontamination"](spark, near, folder)
    assert sorted(map(str, ((r.doc_id, r.text) for r in clean.collect()))) == sorted(map(str, expected))
    assert clean.columns == docs.columns


def test_oracles_name_queries():
    assert set(queries.ORACLE) <= set(queries.QUERIES)
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))
