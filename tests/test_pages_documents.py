from pyspark.sql import functions as F

from recordmill.operators import documents as O
from recordmill.operators import pages as P
from recordmill.plans.collection import collect_news

SITE = "https://www.river.example"
PAGES = [
    (1, f"{SITE}/?page_id=1",
     '<a href="/files/List-2025.pdf">List of  projects 2025</a><a href="/files/x.PDF">ok</a><a href="/about">About</a>'
     '<a href="https://other.example/z.pdf">Other</a><a href="/files/y.pdf"> </a><!--<a href="/files/h.pdf">hidden</a>-->'
     "<a href='/wp-content/uploads/scan'>Scan</a>"),
    (2, f"{SITE}/?page_id=2", '<a href="/files/List-2025.pdf">Same list again</a><a href="files/b.zip">Zip</a>'),
    (3, f"{SITE}/?cat=1",
     '<article><h2><a href="/?p=10">Bridge opened</a></h2>Bridge Opened Published September 3, 2026 People came.</article>'
     '<article><h1>No link here</h1><a href="/?p=11">Elsewhere</a></article>'
     '<article><p>Before <a href="/?p=12">School built</a> after July 1, 2025</p></article>'
     '<article><h3><a href="https://other.example/">Foreign</a></h3></article><h2><a href="/?p=99">ignored</a></h2>'),
    (4, f"{SITE}/?cat=2",
     '<h1><a href="/">Top</a></h1><h2>Plain</h2><div><h3><a href="/?p=20">Road report</a></h3>May 2, 2024 text</div>'
     '<div><h4><a href="/?p=10">Bridge again</a></h4></div>'),
    (10, f"{SITE}/?p=10",
     '<nav><a href="/n.pdf">n</a></nav><article><div class="entry-content"><p>Full <b>text</b></p>'
     '<a href="/b.pdf">b</a><a href="/a.pdf">a</a><a href="/b.pdf">b</a><div><a href="/c.docx">c</a></div></div>'
     '<a href="/out.pdf">o</a></article>'),
    (12, f"{SITE}/?p=12", "<article><p>Second</p></article>tail"),
]


def table(spark, pages=PAGES):
    return spark.createDataFrame(pages, "page_id long, url string, html string")


def test_document_index(spark):
    index = P.document_index(
        table(spark), F.lit("River Council"), F.concat(F.lit("c"), F.col("page_id")), "river.example", ["page_id"],
        retrieved_at=F.lit("t"),
    )
    assert index.columns == P.RESOURCE_COLUMNS
    got = sorted((r.document_url.removeprefix(SITE), r.document_title_raw, r.year_raw, r.file_type, r.category) for r in index.collect())
    assert got == [
        ("/a.pdf", "a.pdf", "", "pdf", "c10"),
        ("/b.pdf", "b.pdf", "", "pdf", "c10"),
        ("/c.docx", "c.docx", "", "docx", "c10"),
        ("/files/List-2025.pdf", "List of projects 2025", "2025", "pdf", "c1"),
        ("/files/b.zip", "Zip", "", "zip", "c2"),
        ("/files/x.PDF", "x.PDF", "", "pdf", "c1"),
        ("/n.pdf", "n.pdf", "", "pdf", "c10"),
        ("/out.pdf", "out.pdf", "", "pdf", "c10"),
        ("/wp-content/uploads/scan", "Scan", "", "unknown", "c1"),
    ]


def test_article_listing_and_fallback(spark):
    pages = table(spark).filter(F.col("page_id").isin(3, 4))
    listed = P.article_listing(pages, F.lit("River Council"), "river.example", ["page_id"])
    got = sorted((r.page_id, r.position, r.article_url.removeprefix(SITE), r.title_raw, r.published_date_raw, r.excerpt_raw)
                 for r in listed.collect())
    assert got == [
        (3, 1, "/?p=10", "Bridge opened", "September 3, 2026", "Bridge Opened Published September 3, 2026 People came."),
        (3, 2, "/?p=12", "School built", "July 1, 2025", "Before School built after July 1, 2025"),
        (4, 1, "/?p=20", "Road report", "May 2, 2024", "May 2, 2024 text"),
        (4, 2, "/?p=10", "Bridge again", "", ""),
    ]
    only = P.article_listing(pages, F.lit("C"), "river.example", ["page_id"], fallback=False)
    assert {r.page_id for r in only.collect()} == {3}


def test_article_details(spark):
    details = {r.article_url: (r.article_text_raw, r.linked_document_urls) for r in
               P.article_details(table(spark), "river.example", ["page_id"]).collect()}
    documents = ";".join(f"{SITE}/{name}" for name in ("a.pdf", "b.pdf", "c.docx"))
    assert details[f"{SITE}/?p=10"] == ("Full text b a b c", documents)
    assert details[f"{SITE}/?p=12"] == ("Second", "")


def test_long_article_text_is_bounded(spark):
    page = [(1, SITE, "<article>" + "word " * 9000 + "</article>")]
    (whole,) = P.article_details(table(spark, page), "river.example", ["page_id"]).collect()
    assert whole.article_text_raw == ("word " * 9000).strip()
    (row,) = P.article_details(table(spark, page), "river.example", ["page_id"], text_length=20000).collect()
    assert row.article_text_raw == ("word " * 9000)[:20000]


def test_collect_news(spark):
    pages = table(spark)
    articles = pages.filter("page_id >= 10")
    numbers = {3: ("a", 1), 4: ("a", 2), 1: ("a", 3), 10: ("a", 4), 12: ("b", 1), 2: ("b", 12)}
    placed = spark.createDataFrame([(k, *v) for k, v in numbers.items()], "page_id long, listing string, page int")
    listings = pages.join(placed, "page_id")
    news = collect_news(listings, articles, F.lit("River Council"), "river.example", retrieved_at=F.lit("t"))
    got = {r.article_url.removeprefix(SITE): (r.title_raw, r.article_text_raw) for r in news.collect()}
    assert got == {
        "/?p=10": ("Bridge opened", "Full text b a b c"), "/?p=12": ("School built", "Second"), "/?p=20": ("Road report", ""),
    }
    failed = listings.withColumn("html", F.when(F.col("page") < 2, F.col("html")))
    bare = collect_news(failed, articles, F.lit("C"), "river.example", fetch_details=False)
    assert {(r.page, r.article_url.removeprefix(SITE), r.article_text_raw) for r in bare.collect()} == {(1, "/?p=10", ""), (1, "/?p=12", "")}


def test_pages_behind_a_hopeless_one_are_not_parsed(spark, monkeypatch):
    from recordmill.plans import collection

    article = "<article><h2><a href=/n{}>News {}</a></h2></article>"
    page = lambda k: article.format(k, k)
    bodies = [page(1), page(2), "<article><h2>none</h2></article><a href=/x>x</a>", page(4), "<p>nothing</p>", page(6), page(7), None, page(9)]
    rows = [(1, n + 1, f"https://river.example/list/{n}", html) for n, html in enumerate(bodies)]
    rows += [(2, 1, "https://river.example/two", page(11)), (3, 1, "https://other.example/three", page(12)), (3, 2, "https://river.example/b", page(13))]
    listings = spark.createDataFrame(rows, "listing int, page int, url string, html string")
    parsed, settle = [], collection.settle
    monkeypatch.setattr(collection, "settle", lambda df: parsed.append(settle(df)) or parsed[-1])
    articles = spark.createDataFrame([], "page_id int, url string, html string")
    news = collect_news(listings, articles, F.lit("C"), "river.example", fetch_details=False)
    assert sorted(r.title_raw for r in news.collect()) == ["News 1", "News 11", "News 2"]
    # listing 1 is parsed up to the page without a heading or article, listing 3 not at all
    assert sorted((r.listing, r.page) for r in parsed[0].collect()) == [(1, 1), (1, 2), (1, 3), (1, 4), (2, 1)]


def test_download_manifest(spark):
    links = spark.createDataFrame(
        [(f"{SITE}/a/x.pdf", "t"), (f"{SITE}/b/x.pdf", "t"), (f"{SITE}/y z.pdf", "t"), (f"{SITE}/?p=1", "T")],
        "url string, title string",
    )
    for lengths, size in (((None, None), 46), ((60, 10), 16)):
        got = {r.url.removeprefix(SITE): (r.target_name, r.duplicate_target)
               for r in P.download_manifest(links, "url", "title", *lengths).collect()}
        assert got["/a/x.pdf"] == got["/b/x.pdf"] == ("x.pdf", True)
        assert got["/y z.pdf"] == ("y_z.pdf", False)
        name = got["/?p=1"][0]
        assert name.startswith("T-") and name.endswith(".bin") and len(name) == size


def test_page_indexes(spark):
    text = spark.createDataFrame(
        [("a.pdf", 1, "The  CDF fund"), ("a.pdf", 2, "nothing"), ("b.pdf", 1, "Ward\nDevelopment"), ("b.pdf", 2, "ward development")],
        "source_file string, page int, text string",
    )
    resources = spark.createDataFrame(
        [(1, "https://x/old/a.pdf"), (2, "https://x/new/a.pdf"), (3, "https://x/b.pdf?dl=1"), (4, ""), (5, "https://x/c.doc")],
        "o int, document_url string",
    )
    files = O.url_by_file(resources, "o")
    assert [tuple(r) for r in files.collect()] == [("a.pdf", "https://x/new/a.pdf")]
    index = sorted(tuple(r) for r in O.page_text_index(text, files).collect())
    assert index == [
        ("a.pdf", "https://x/new/a.pdf", 1, "The CDF fund"), ("a.pdf", "https://x/new/a.pdf", 2, "nothing"),
        ("b.pdf", "", 1, "Ward Development"), ("b.pdf", "", 2, "ward development"),
    ]
    assert sorted((r.source_file, r.page) for r in O.evidence_index(text, files).collect()) == [("a.pdf", 1), ("b.pdf", 2)]
    assert [tuple(r) for r in O.document_totals(text).collect()] == [(2, 4, 2)]


def test_tables_are_padded_and_numbered(spark):
    cells = [[["a", "b"], None, ["c"]], [], [["d", None, "f"]]]
    pages = spark.createDataFrame(
        [("r v.1.pdf", 7, "CDF", cells)], "source_file string, page int, text string, tables array<array<array<string>>>"
    )
    files = spark.createDataFrame([], "source_file string, source_url string")
    manifest = sorted(tuple(r) for r in O.table_manifest(pages, files).collect())
    assert manifest == [
        ("r v.1.pdf", "", 7, 1, "r_v_1_p007_t01.csv", True), ("r v.1.pdf", "", 7, 3, "r_v_1_p007_t03.csv", True),
    ]
    rows = [(r.table_file[-7:-4], r.row_number, r.cells) for r in O.table_cells(pages).orderBy("table_file", "row_number").collect()]
    assert rows == [
        ("t01", 1, ["a", "b"]), ("t01", 2, [None, None]), ("t01", 3, ["c", None]), ("t03", 1, ["d", None, "f"]),
    ]
