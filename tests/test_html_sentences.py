from pyspark.sql import functions as F

from hazardlake.operators import sentences as S

HTML = (
    '<html><head><script>var t="</p>";</script><style>p{margin:0}</style></head><body>'
    '<nav><a href="/a">A</a></nav><!-- <p>hidden</p> -->'
    '<div class="ad">Ad text.</div><article><h1>T</h1>'
    '<p><b>First para.</b> Second sentence here!<br>'
    '<p class="x">Tom &amp; Jerry &quot;run&quot; &copy; 2021 &middot; ok. One</p>'
    '<p></p><p>Unclosed at end</article><footer>f</footer></body></html>'
)


def test_paragraphs_handle_scripts_comments_unclosed_and_entities(spark):
    df = spark.createDataFrame([(1, HTML)], "page_id long, html string")
    got = [r.paragraph for r in S.page_paragraphs(df).orderBy("para_pos").collect()]
    assert got == ["First para. Second sentence here!",
                   'Tom & Jerry "run" © 2021 · ok. One',
                   "Unclosed at end"]


def test_sentences_and_min_words(spark):
    df = spark.createDataFrame([(1, HTML)], "page_id long, html string")
    sents = S.page_sentences(df).orderBy("para_pos", "sent_pos").collect()
    # "One" is a one-word sentence and is dropped (>= 2 words kept).
    assert [s.sentence for s in sents] == [
        "First para.", "Second sentence here!", 'Tom & Jerry "run" © 2021 · ok.', "Unclosed at end"]


def test_boilerplate_dropped_when_on_k_pages(spark):
    rows = [(p, 0, 0, "Share this story now.") for p in range(3)] + \
           [(p, 0, 1, f"Unique text number {p}.") for p in range(3)] + [(9, 0, 0, "share  THIS story now.")]
    df = spark.createDataFrame(rows, "page_id long, para_pos int, sent_pos int, sentence string")
    kept = S.boilerplate_filter(df, min_pages=3)
    assert sorted(r.sentence for r in kept.collect()) == [f"Unique text number {p}." for p in range(3)]


def test_page_text_concat_has_no_separator(spark):
    df = spark.createDataFrame([(1, "<p>a b.</p><p>c d.</p>")], "page_id long, html string")
    assert S.page_text_concat(df).first().text == "a b.c d."


def test_lines_after_marker_and_doc_lines(spark):
    text = "intro\nsee references below\nhttp://x.org/a\nend"
    df = spark.createDataFrame([(1, text), (2, "no marker\nhere")], "doc_id long, text string")
    got = [(r.line_no, r.line) for r in S.lines_after_marker(df, "eference").orderBy("line_no").collect()]
    assert got == [(1, "see references below"), (2, "http://x.org/a"), (3, "end")]
    assert S.doc_lines(df).count() == 6


def test_url_line_stitch_picks_first_known_candidate(spark):
    docs = spark.createDataFrame([
        (1, "References\nSee http://ex.org/a\nb/c"),        # broken in two -> cand 1
        (2, "References\nSee http://ex.o rg/x\nthen"),      # stray space -> cand 2
        (3, "References\nSee http://ex.org/zz\nnext"),      # whole -> cand 0
        (4, "References\nSee http://unknown.org\n"),        # nothing known
    ], "doc_id long, text string")
    known = spark.createDataFrame([("http://ex.org/ab/c",), ("http://ex.org/x",), ("http://ex.org/zz",)], "url string")
    got = sorted((r.doc_id, r.cand_no, r.url) for r in S.url_line_stitch(docs, known).collect())
    assert got == [(1, 1, "http://ex.org/ab/c"), (2, 2, "http://ex.org/x"), (3, 0, "http://ex.org/zz")]


def test_first_occurrences(spark):
    df = spark.createDataFrame([(1, 0, "a b."), (1, 1, "c d."), (1, 2, "a b."), (2, 0, "a b.")],
                               "doc_id long, sent_pos int, sentence string")
    got = sorted(tuple(r) for r in S.first_occurrences(df, ["doc_id"]).collect())
    assert got == [(1, 0, "a b."), (1, 1, "c d."), (2, 0, "a b.")]


def test_links_and_images(spark):
    from hazardlake.functions import html as H
    page = ('<link href="x.css"><a class="c" href="a.pdf">A</a><!-- <a href="b.pdf"> --><A HREF="d.pdf">'
            '<script>var s = \'<img src="e.png">\';</script><img alt="" src="f.png"><img src="g.jpg"><IMG SRC="h.png">')
    df = spark.createDataFrame([(page,)], "html string")
    r = df.select(H.links(F.col("html")).alias("a"), H.images_with_suffix(F.col("html"), ".png").alias("i")).first()
    assert r.a == ["a.pdf", "d.pdf"] and r.i == ["f.png", "h.png"]


def test_stitch_only_after_the_marker(spark):
    docs = spark.createDataFrame([(1, "http://ex.org/a\nReferences\nhttp://ex.org/\nb"), (2, "http://ex.org/a\nnone")],
                                 "doc_id long, text string")
    known = spark.createDataFrame([("http://ex.org/a",), ("http://ex.org/b",)], "url string")
    got = [(r.doc_id, r.line_no, r.url) for r in S.url_line_stitch(docs, known, marker="References").collect()]
    assert got == [(1, 2, "http://ex.org/b")]
    assert S.url_line_stitch(docs, known).count() == 3


def test_numeric_references(spark):
    from hazardlake.functions import html as H
    rows = [("a&#233;b&#x41;&#X1F600; &amp;#65; &#0; &#55296; &#99999999999; &lt;",), ("none",), (None,), ("&#33;",)]
    df = spark.createDataFrame(rows, "t string")
    got = [r.t for r in df.select(H.unescape_entities(F.col("t")).alias("t")).collect()]
    assert got == ["a\u00e9bA\U0001F600 &#65; &#0; &#55296; &#99999999999; <", "none", None, "!"]
