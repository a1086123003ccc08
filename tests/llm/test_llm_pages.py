"""Main text, WARC archives, the quality classifier and the pipeline."""

import base64
import gzip
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from cardrail.llm import labelled_pages, main_text, quality, warc
from cardrail.session import scratch_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def weights():
    return main_text.fit([main_text.read(p) for p in labelled_pages.pages()])


def wanted(page):
    blocks, _ = main_text.read(page)
    return "\n\n".join(" ".join(b.words) for b in blocks if b.label)


def test_layouts_with_other_lengths(weights):
    for page in labelled_pages.pages(copies=4, seed=77):
        assert main_text.main_text(re.sub(r' data-label="."', "", page), weights) == wanted(page)


def test_best_run_equals_brute_force():
    draw = random.Random(2)
    for _ in range(200):
        scores = [draw.randint(-3, 3) for _ in range(draw.randrange(12))]
        a, b = main_text.best_run(scores)
        best = max((sum(scores[i:j]) for i in range(len(scores)) for j in range(i, len(scores) + 1)), default=0)
        assert sum(scores[a:b]) == max(0, best)


LONG_TEXT = "word " * 120_000
HTML = {
    1: ("<p>A &amp; B&nbsp;&lt;x&gt; caf&eacute; " + "more words here " * 9 + "</p><p>two<br>lines " + "and so on " * 9, 2),
    2: ("", 0),
    3: (None, 0),
    4: ("<article><h1>Title of it</h1><p>in<b>side</b> a word " + "and text " * 20 + "</p><script>var x = '<p>no</p>';</script>"
        "<style>p{}</style><!-- <p>no</p> --><p class=\"ad\">buy</p><nav><a>x</a></nav><p>end " + "of it " * 20 + "</p></article>", 3),
    5: (f"<article><p>{LONG_TEXT}</p></article>", 1),
    6: ("<p>cut off " + "in the middle " * 12 + "<a href=\"unclosed", 1),
    7: ("plain text only, no markup at all, " * 5, 1),
}


def test_extraction(spark, weights):
    rows = [(i, "u", h, "x", 1) for i, (h, _) in HTML.items()] + [(None, None, HTML[1][0], "x", 1), (1, "u", HTML[1][0], "x", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int").repartition(2)
    found = main_text.extract(pages, weights).collect()
    assert len(found) == len(rows)
    by_id = {r.page_id: r for r in found}
    for i, (_, blocks) in HTML.items():
        assert by_id[i].n_chars == len(by_id[i].text)
        assert (by_id[i].text.count("\n\n") + 1 if by_id[i].text else 0) == blocks, by_id[i].text[:200]
    assert by_id[1].text.startswith("A & B <x> café more") and "two lines" in by_id[1].text
    assert by_id[4].text.startswith("Title of it\n\ninside a word") and "no" not in by_id[4].text.split() and "buy" not in by_id[4].text
    assert by_id[5].text == LONG_TEXT.strip()
    assert main_text.extract(pages.limit(0), weights).count() == 0


def test_given_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    found = {r.page_id: r.text for r in main_text.extract(pages, main_text.learn(pages)).collect()}
    for row in pages.collect():
        article = row.html.partition("<article>")[2].partition("</article>")[0]
        import html

        parts = re.split(r"</?(?:h1|p)>", article)
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " " if "br" in p else "", p)).split()) for p in parts]
        assert found[row.page_id] == "\n\n".join(p for p in parts if p)


TEXT = "some words of the article " * 20


@pytest.mark.parametrize(
    "attributes",
    ['style="overflow:hidden"', 'aria-hidden="false"', 'href="/hidden/x"', "data-x=/hidden/", 'data-hidden="1"', 'title="a > b hidden"'],
)
def test_only_the_hidden_attribute_hides(weights, attributes):
    for page in (f"<article {attributes}><p>{TEXT}</p></article>", f"<div {attributes}><article><p>{TEXT}</p></article></div>"):
        assert main_text.main_text(page, weights) == TEXT.strip()
    assert main_text.main_text(f"<div {attributes}><p>{TEXT}</p></div>", weights) == TEXT.strip()


@pytest.mark.parametrize("attributes", ["hidden", 'class="a" HIDDEN=""', "hidden=until-found", "aria-hidden=true", 'aria-hidden = "True"'])
def test_hidden_elements_are_no_content(weights, attributes):
    page = f"<article><p>{TEXT}</p><div {attributes}><p>not shown</p></div><p>{TEXT}</p></article>"
    assert main_text.main_text(page, weights) == f"{TEXT.strip()}\n\n{TEXT.strip()}"


@pytest.mark.parametrize("label", ["Amount", "", "0", "1"])
def test_labels_of_given_pages_are_ignored(spark, weights, label):
    page = f'<nav data-label="{label}">to other pages</nav><article><p>{TEXT}</p><div data-label="{label}">{TEXT}</div></article>'
    assert main_text.main_text(page, weights) == f"{TEXT.strip()}\n\n{TEXT.strip()}"
    assert [b.label for b in main_text.self_labelled(page)[0]] == [0, 1, 1]
    pages = spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")
    assert main_text.extract(pages, main_text.learn(pages)).first().text == f"{TEXT.strip()}\n\n{TEXT.strip()}"


@pytest.mark.parametrize(
    "part",
    ["<svg class='i' />", "<math/>", "<svg><title/><style/><path d='M0'/></svg>", "<svg><path d='M0'/>", "<button>Share it", "<option>one",
     "<object data='x'>", "<div><button>Share <b>it</b></div>", "<select><option>one<option>two</select>", "<button>a<button>b</button>",
     "<object><object>a</object><p>b</p></object>", "<template><article><p>not shown</p></article></template>",
     "<svg><a><text>c</text></a></svg>", "<noscript><p>d</p></noscript>", "<script>'<p>e'</script>", "<textarea><p>f</textarea>"],
)
def test_only_the_words_of_skipped_elements_are_lost(weights, part):
    whole = f"{TEXT.strip()}\n\n{TEXT.strip()}"
    for page in (
        f"<article><p>{TEXT}</p>{part}<p>{TEXT}</p></article>",
        f"<body>{part}<article><p>{TEXT}</p><p>{TEXT}</p></article></body>",
        f"<body><div class='post-content'><p>{TEXT}</p>{part}<p>{TEXT}</p></div></body>",
    ):
        assert main_text.main_text(page, weights) == whole, page


PAGES = [
    (1, "http://a/ b", "same"),
    (2, "http://b", "same"),
    (7, None, "same"),
    (3, "http://c", ""),
    (4, "http://d", None),
    (5, "http://e", "é\r\n\r\nWARC/1.1\r\nx\x00" * 5000),
    (6, "http://f", "é\r\n\r\nWARC/1.1\r\nx\x00" * 5000),
    (None, "http://g", "only here, without an id"),
    (None, "http://h", "same"),
    (8, "http://i", "x" * 200_000),
    (9, "http://j", "twice " * 9000),
    (9, "http://j", "twice " * 9000),
]


def expected_pages(min_bytes):
    out = []
    for page_id, _, html in PAGES:
        raw = (html or "").encode()
        same = [p for p, _, h in PAGES if (h or "") == (html or "")]
        most = max((p for p in same if p is not None), default=None)
        again = len(raw) >= min_bytes and page_id != most
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out.append((page_id, len(raw), digest, "revisit" if again else "response", most if again else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("segment_bytes,min_bytes", [(1000, 0), (1 << 20, 0), (4096, 10)])
def test_archives(spark, segment_bytes, min_bytes):
    pages = spark.createDataFrame([(*p, "x", 1) for p in PAGES], "page_id long, url string, html string, sha1 string, stored_id int")
    path = scratch_path(spark, "warc")
    found = warc.archive_round_trip(pages.repartition(3), path, segment_bytes, min_bytes)
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[c] for c in columns) for r in found.collect()), key=repr) == expected_pages(min_bytes)
    payloads = warc.read_archives(spark, path, payloads=True).filter("record_type = 'response'")
    stored = {(e[0], e[2]) for e in expected_pages(min_bytes) if e[3] == "response"}
    assert {(r.page_id, bytes(r.payload).decode()) for r in payloads.collect()} == {
        (p, h or "") for p, _, h in PAGES if (p, warc.bare_digest((h or "").encode())) in stored
    }
    empty = scratch_path(spark, "warc")
    assert warc.archive_round_trip(pages.limit(0), empty, segment_bytes).count() == 0


def test_archive_files_are_gzip_and_whole(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").coalesce(1)
    path = scratch_path(spark, "warc")
    warc.write_archives(pages, path, 1000)
    import glob

    raw = b"".join(gzip.open(f).read() for f in sorted(glob.glob(f"{path.removeprefix('file:')}/*.gz")))
    records = list(warc.parse(raw))
    assert sum(f["warc-type"] == "continuation" for f, _ in records) > 200
    assert raw.count(b"WARC-Segment-Total-Length") == sum("warc-segment-total-length" in f for f, _ in records)
    broken = raw[: len(raw) - 50]
    with pytest.raises(warc.ArchiveError):
        list(warc.parse(broken))


def test_segments_and_chunks():
    block = b"abcdefgh"
    parts = [(3, 8, b"gh"), (1, None, b"abc"), (2, None, b"def")]
    assert warc.reassemble("r", parts) == block
    for bad in (parts[:2], parts[1:], [(3, 9, b"gh"), *parts[1:]], [*parts, parts[1]]):
        with pytest.raises(warc.ArchiveError):
            warc.reassemble("r", bad)
    for payload in (b"", b"x" * 20_000, b"0\r\n\r\n"):
        assert warc.from_chunks(warc.to_chunks(payload, 7)) == payload
    assert warc.from_chunks(b"3;ext=1\r\nabc\r\n0\r\nTrailer: x\r\n\r\n") == b"abc"
    for bad in (b"", b"5\r\nabc", b"zz\r\n", b"3\r\nabcX0\r\n\r\n", b"3\r\nabc\r\n"):
        with pytest.raises(warc.ArchiveError):
            warc.from_chunks(bad)


def labelled(draw, good):
    names = [f"{a}{b}" for a in ("th", "re", "on", "in", "st") for b in ("ing", "ed", "er", "al", "ous")]
    text = [draw.choice(names) for _ in range(draw.randrange(20, 200))]
    if not good:
        text = draw.choice([[w.upper() + "!!" for w in text], [w + "###" for w in text], [text[i // 30] for i in range(len(text))]])
    return " ".join(text)


@pytest.fixture(scope="module")
def marked(spark):
    draw = random.Random(3)
    rows = [(i, labelled(draw, i % 4 > 0), int(i % 4 > 0)) for i in range(600)]
    docs = spark.createDataFrame([(i, t, "x", 1.0, "y") for i, t, _ in rows], "doc_id long, text string, source string, score double, quality string")
    odd = [(None, rows[0][1], "x", 1.0, "y"), (9001, None, "x", 1.0, "y"), (9002, "", "x", 1.0, "y"), (9003, "reing " * 90_000, "x", 1.0, "y")]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema)).repartition(4)
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in rows] + [(None, 1, 0), (1, None, 0), (2, 7, 0)], "doc_id long, quality int, toxic int")
    return docs, labels, {i: q for i, _, q in rows}


def test_classifier_on_held_out_rows(marked):
    docs, labels, truth = marked
    model = quality.learn(docs, labels, quality.Settings(sample_rows=300))
    found = quality.score(docs, model).collect()
    assert len(found) == len(truth) + 4
    right = []
    for r in found:
        assert 0 <= r.score <= 1
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        if r.held_out and r.doc_id in truth:
            right.append((r.score >= 0.7) == bool(truth[r.doc_id]))
    assert len(right) > 100 and sum(right) / len(right) >= 0.97
    scores = {r.doc_id: r.score for r in found}
    assert scores[9001] == scores[9002] and scores[9003] != scores[9002]
    kept = quality.keep_good(docs, model, 0.7)
    assert kept.schema == docs.schema
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in found if r.score >= 0.7}


def test_classifier_learns_from_no_held_out_row(marked):
    docs, labels, _ = marked
    model = quality.learn(docs, labels, quality.Settings(sample_rows=300))
    turned = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality.learn(docs, turned, quality.Settings(sample_rows=300))
    assert (model.flat() == again.flat()).all()


def test_classifier_without_labels_or_rows(marked):
    docs, labels, _ = marked
    model = quality.learn(docs, labels.limit(0))
    assert {r.score for r in quality.score(docs, model).collect()} == {0.5}
    assert quality.score(docs.limit(0), model).count() == 0


def test_pipeline(spark):
    import corpus_pipeline
    from cardrail.llm import near_copies, passages

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = docs
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_copies", "passages", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in kept.collect()}
        path = scratch_path(spark, name)
        stage(spark, kept, SF).write.parquet(path)
        kept = spark.read.parquet(path)
        assert kept.columns == docs.columns
        after = {r.doc_id: r.text for r in kept.collect()}
        if name == "quality":
            judged = [(i in after, labels[i]) for i in before if i in labels]
            assert sum(a == bool(q) for a, q in judged) / len(judged) >= 0.97
        elif name == "near_copies":
            classes = near_copies.classes(spark.createDataFrame(list(before.items()), "doc_id long, text string")).collect()
            assert set(after) == {r.class_id for r in classes}
        else:
            cut = {r.doc_id for r in passages.repeats(spark.createDataFrame(list(before.items()), "doc_id long, text string")).filter("not kept").collect()}
            assert set(after) == set(before) and {i for i in after if after[i] != before[i]} == cut
            again = passages.repeats(kept).filter("not kept")
            assert again.count() < max(1, len(cut))
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, SF).collect()
    assert {r.doc_id for r in packed} == set(after)
    assert corpus_pipeline.ORACLE_SQL is None


def test_pipeline_of_an_empty_table(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


P = "<p>" + "The first long paragraph tells a story about rivers and towns and people who live there for years. " * 3 + "</p>"


def whole_page(inner, article="<article>"):
    menu = "<nav><a href=/>Home</a><a href=/a>About</a></nav>"
    return f"<html><body>{menu}<main>{article}<h1>Title here</h1>{inner}</article></main><footer>Footer words</footer></body></html>"


@pytest.fixture(scope="module")
def own_weights():
    return main_text.fit([main_text.read(p) for p in labelled_pages.pages()])


def test_forms_links_and_comments(own_weights):
    def text(page):
        return main_text.main_text(page, own_weights).split("\n\n")

    para = " ".join(P[3:-4].split())
    items = [f"Item number {i}" for i in range(6)]
    links = "<ul>" + "".join(f"<li><a href=/{i}>{x}</a></li>" for i, x in enumerate(items)) + "</ul>"
    assert text(whole_page(P + "<form><p>Subscribe to our list now please</p><label>Your name</label></form>" + P)) == ["Title here", para, para]
    assert text(whole_page("<h2>Links</h2>" + links + P)) == ["Title here", "Links", *items, para]
    assert text(whole_page(P + links)) == ["Title here", para, *items]
    replies = "<div class='feedback'><h3>2 replies</h3><p>I liked it very much and will read it again.</p></div>"
    assert text(whole_page(P + replies)) == ["Title here", para]
    assert text(whole_page(P, "<article class='post comments'>")) == ["Title here", para]
    # a form around the whole page is its frame
    assert text(f"<form action=x>{whole_page(P)}</form>") == ["Title here", para]
    assert text(f"<html><body><form><div class=content><h1>Title here</h1>{P * 3}</div></form></body></html>") == ["Title here", *[para] * 3]
    advert = "<div class='advert'><p>" + "Buy this now cheap offer. " * 40 + "</p></div>"
    assert text(whole_page(P + advert + P)) == ["Title here", para, para]
