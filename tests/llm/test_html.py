import pytest
from tripmill.llm import html
from tripmill.llm.queries import QUERIES

PAGES = "page_id long, url string, html string, text string, __host string"


def one(page, texts=frozenset(), main=None):
    return html.main_text(page, set(texts), main)


@pytest.mark.parametrize(
    "page,text",
    [
        (None, ""),
        ("", ""),
        ("<article><h1>A  b</h1><p>c &amp; d&nbsp;\n e</p></article>", "A b\nc & d e"),
        ("<nav>menu</nav><main><p>x<br>y<p>z</main><footer>f</footer>", "x y\nz"),
        ("<article><p>a<script>var t='</p>';</script>b</p><style>p{}</style></article>", "ab"),
        ("<article><!-- no <p> --><p>a</p><aside>s</aside><form>f<input></form><p>b</article>", "a\nb"),
        ("<article><p>a</p><div class='comments'><p>reader</p></div></article>", "a"),
        ("<article><p>a</p><section id=comment-list><p>reader</p></section><p>b</p></article>", "a\nb"),
        ("<header>site</header><article><header><h1>t</h1></header><p>a</p></article>", "t\na"),
        ("<div class='cookie-notice'>c</div><div class=adBox>ad</div><article><p>a<div class=ad>x</div><p>b", "a\nb"),
        ("<article><p><b>bold<p>next</article>", "bold\nnext"),
        ("<article><ul><li>1<li>2</ul><table><tr><td>x<td>y</table></article>", "1\n2\nx\ny"),
        ("<article><p title='a>b'>t &lt;p&gt; &#233;&#x41; &unknown; &copy</p></article>", "t <p> éA &unknown; ©"),
        ("<article><p>a < b and c</p></article></div></p>", "a < b and c"),
        ("<article><p>cut <a href='x", "cut"),
        ("<ARTICLE><P>Upper</P></ARTICLE>", "Upper"),
        ("<article><p hidden>h</p><p style='display: none'>n</p><p>v</p></article>", "v"),
        ("<body class='has-sidebar'><article class='ad-free'><p>v</p></article></body>", "v"),
        ("<article><p></p> \n <p>&nbsp;</p></article>", ""),
        ("<title>t</title><div><p>long enough text</p><p>more</p></div><div class=sidebar><p>side side side side side</p></div>", "long enough text\nmore"),
        ("plain text only", "plain text only"),
    ],
)
def test_main_text(page, text):
    assert one(page) == text


def site(n, host="www.x.org"):
    """Pages without article elements: only the template tells menus from content."""
    return [
        (
            i,
            f"https://{host}/p{i}",
            "<body><div class=top><p>Home</p><p>About us</p></div>"
            f"<div class=wrap><div class=content><p>Story {host} {i} begins here.</p><p>It goes on {i * 7} times.</p></div>"
            f"<div class=box><p>Tip {i % 50}</p></div></div><div class=end><p>All rights</p></div></body>",
            None,
            None,
        )
        for i in range(n)
    ]


def test_template_finds_the_container(spark):
    frame = spark.createDataFrame(site(30) + [(100, None, "<p>x</p>", "t", "h")], PAGES)
    got = {r["page_id"]: r["text"] for r in html.extract(frame).collect()}
    for i in range(30):
        assert got[i] == f"Story www.x.org {i} begins here.\nIt goes on {i * 7} times."
    assert got[100] == "x"


def test_templates_are_classes_of_equal_vectors(spark):
    from pyspark.sql import functions as F

    pages = spark.createDataFrame(site(20), PAGES).select(F.lit("h").alias("host"), F.col("page_id").alias("page"), "html")
    (row,) = html.templates(pages).collect()
    fixed = {("div.top/p", t) for t in ("Home", "About us")} | {("div.end/p", "All rights")}
    assert {html.token("text", f"body/{p}", t) for p, t in fixed} == set(row["texts"])
    assert row["main"] == html.token("path", "body/div.wrap/div.content")
    # Every page has six blocks, three and two of them in a container, or one: a class for each number.
    assert row["classes"] == 4


def tagless(n, body, top=lambda i: ("Home", "About us")):
    """Pages of one host with the given bodies in a menu and an end that are the same everywhere."""
    menu = lambda i: "".join(f"<p>{t}</p>" for t in top(i))
    return [
        (i, f"http://h/{i}", f"<body><div class=top>{menu(i)}</div><div class=wrap>{body(i)}</div><div class=end><p>All rights</p></div></body>", None, None)
        for i in range(n)
    ]


def texts_of(spark, rows):
    return {r["page_id"]: r["text"] for r in html.extract(spark.createDataFrame(rows, PAGES)).collect()}


def test_a_class_of_texts_only_is_no_template(spark):
    note = lambda i: "Corrected since it came out." * (i % 2 == 0)
    got = texts_of(spark, tagless(20, lambda i: f"<div class=content><p>Story {i} begins here.</p><p>{note(i)}</p></div>"))
    assert got == {i: f"Story {i} begins here." + ("\n" + note(i)) * (i % 2 == 0) for i in range(20)}


def test_texts_of_a_class_keep_their_order(spark):
    from pyspark.sql import functions as F

    rows = tagless(20, lambda i: f"<p>Story {i} begins here.</p>", lambda i: ("Home", "About us")[:: 1 if i % 2 else -1])
    (row,) = html.templates(spark.createDataFrame(rows, PAGES).select(F.lit("h").alias("host"), F.col("page_id").alias("page"), "html")).collect()
    assert row["texts"] == [html.token("text", "body/div.end/p", "All rights")]


@pytest.mark.parametrize("n,copies", [(6, 2), (30, 10)])
def test_copies_on_a_host_keep_their_text(spark, n, copies):
    story = lambda i: "copied" if i < copies else f"told {i}"
    got = texts_of(spark, tagless(n, lambda i: f"<div class=content><p>Story {story(i)}.</p><p>It is {story(i)} again.</p></div>"))
    assert got == {i: f"Story {story(i)}.\nIt is {story(i)} again." for i in range(n)}


@pytest.mark.parametrize("n", [3, 20])
def test_a_body_in_sibling_sections_is_whole(spark, n):
    part = lambda i, k: f"Part {k} of story {i} is told here."
    got = texts_of(
        spark, tagless(n, lambda i: f"<div class=intro><p>{part(i, 1)}</p></div><div class=rest><p>{part(i, 2)}</p><p>{part(i, 3)}</p></div>", lambda i: ())
    )
    for i in range(n):
        assert all(part(i, k) in got[i] for k in (1, 2, 3))


def test_repeated_article_text_stays(spark):
    rows = [(i, "http://h/", "<article><p>same text</p></article>", None, None) for i in range(20)]
    assert {r["text"] for r in html.extract(spark.createDataFrame(rows, PAGES)).collect()} == {"same text"}


def test_edge_tables(spark):
    frame = spark.createDataFrame([], PAGES)
    assert html.extract(frame).count() == 0
    rows = [(None, None, None, "old", "x"), (1, "no url", "<p>" + "word " * 100_000, "old", "x"), (1, "no url", None, "old", "x")]
    got = html.extract(spark.createDataFrame(rows, PAGES)).collect()
    assert sorted(len(r["text"]) for r in got) == [0, 0, 499_999]


def test_query_matches_the_written_articles(spark, sf_dir):
    import re
    from html import unescape

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = {r["page_id"]: r for r in QUERIES["op10_html"](spark, sf_dir).collect()}
    assert set(got) == set(pages)
    for key, page in pages.items():
        inner = re.search("<article>(.*)</article>", page, re.S)[1]
        parts = [" ".join(unescape(re.sub("<[^>]*>", " ", p)).split()) for p in re.split("</?(?:p|h1)>", inner)]
        want = "\n".join(p for p in parts if p)
        assert got[key]["text"] == want and got[key]["n_chars"] == len(want)


def told(i):
    return f"Story {i} begins here and goes on for a while, as long as {i * 31} words or so."


@pytest.mark.parametrize("n", [12, 40])
@pytest.mark.parametrize("closing", ["<section class=closing><p>{}</p></section>", "<div><p>{}</p></div>", "<p>{}</p>", "<div class='content last'><p>{}</p></div>"])
def test_a_repeated_heading_and_a_short_section_beside_stay(spark, n, closing):
    end = lambda i: f"Told on day {i}."
    got = texts_of(spark, tagless(n, lambda i: f"<div class=content><h2>Summary</h2><p>{told(i)}</p></div>" + closing.format(end(i))))
    assert got == {i: f"Summary\n{told(i)}\n{end(i)}" for i in range(n)}


def test_a_repeated_heading_within_a_section_beside_stays(spark):
    got = texts_of(
        spark,
        tagless(20, lambda i: f"<section><h2>Summary</h2><p>{told(i)}</p></section><section><h2>Sources</h2><ul><li>Book {i}</li></ul></section>"),
    )
    assert got == {i: f"Summary\n{told(i)}\nSources\nBook {i}" for i in range(20)}


def test_repeated_texts_right_in_the_body_stay_only_between_varying_ones(spark):
    rows = [(i, f"http://h/{i}", f"<body><p>Home</p><p>{told(i)}</p><h2>More</h2><p>It ends {i}.</p><p>All rights</p></body>", None, None) for i in range(20)]
    assert texts_of(spark, rows) == {i: f"{told(i)}\nMore\nIt ends {i}." for i in range(20)}


def test_a_menu_within_the_main_element_is_left_out(spark):
    menu = "<div class=tabs><p>First tab</p><p>Second tab</p></div>"
    got = texts_of(spark, tagless(20, lambda i: f"<div class=page>{menu}<div class=a><p>{told(i)}</p></div><div class=b><p>{told(i + 100)}</p></div></div>"))
    assert got == {i: f"{told(i)}\n{told(i + 100)}" for i in range(20)}
