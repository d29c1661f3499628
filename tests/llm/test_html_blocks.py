from __future__ import annotations

import pytest

from wheelhouse.llm import html_blocks as blocks

ARTICLE = "<article><h1>Head &amp; title</h1><p>First <b>bold</b> para\n graph.<p>Second<br>line &lt;b&gt; &#233;&nbsp;x<ul><li>one<li>two <a href=x>link</a></ul></article>"
TEXT = "Head & title First bold para graph. Second line <b> é x one two link"
MENU = "<ul><li><a href=/a>Home</a></li><li><a href=/b>News of the day and more</a></li></ul>"
CASES = [
    (ARTICLE, TEXT),
    (f"<html><head><title>T</title><style>p{{}}</style><script>var a='</p><p>x';</script></head><body><nav>{MENU}</nav>{ARTICLE}<footer>&copy; me</footer>", TEXT),
    (f"<body><div class='ad'>Buy this now please, a long advert of many words indeed</div>{ARTICLE}<aside>side words</aside></body>", TEXT),
    (f"<body><header>{MENU}</header><main>{ARTICLE}</main><section id=comments><p>{'reader comment words ' * 20}</p></section>", TEXT),
    (f"<body>{ARTICLE}<form><label>Name</label><input><button>Send</button></form><div class='cookie-notice'>We use cookies</div>", TEXT),
    ("<article><p>Text<div class=ad>Advert words here</div><p>More text<!-- <p>no</p> --><noscript>x</noscript></article>", "Text More text"),
    ("<ARTICLE><P>Upper</P><P>A</P></ARTICLE>", "Upper A"),
    ("<article><p>cut of", "cut of"), ("<article><p>a < b and c > d</p></article>", "a < b and c > d"), ("", ""), (None, ""), ("<nav>only menu</nav>", ""),
    ("<article><p title='a > b'>quoted</p><p class=\"x>unclosed</p></article>", None),
    ("<article><header><h1>Inner</h1></header><p>Body</p><footer>by me</footer></article>", "Inner Body"),
    ("<article><p>&am &amp &#x41; &bogus;</p></article>", "&am & A &bogus;"),
]


@pytest.fixture(scope="module")
def extracted(spark):
    rows = [(i, page, "mine", 1) for i, (page, _) in enumerate(CASES)] + [(0, CASES[0][0], "mine", 1)]
    rows.append((99, "<article>" + "<p>word</p>" * 50000 + "</article>", "mine", 1))
    pages = spark.createDataFrame(rows, "page_id long, html string, text string, url int")
    return blocks.main_text(pages).collect()


def test_cases(extracted):
    assert len(extracted) == len(CASES) + 2
    for row in extracted:
        if row.page_id < 99 and CASES[row.page_id][1] is not None:
            assert row.text == CASES[row.page_id][1]
    assert next(r for r in extracted if r.page_id == 99).text.count("word") == 50000


def test_page_without_article_element(spark):
    long = "This is a paragraph with enough words to be the main text of a page about something. " * 3
    page = f"<body><div id=top>{MENU}</div><div><h2>What this page is all about</h2><p>{long}</p><p>{long}</p></div><div class=sidebar>{MENU}</div></body>"
    text = blocks.main_text(spark.createDataFrame([(1, page)], "page_id long, html string")).first().text
    assert text.startswith("What this page is") and "Home" not in text and text.count("This is a paragraph") == 6


def test_tree_column_equals_the_learned_model(spark):
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.functions import vector_to_array
    from pyspark.sql import functions as F

    rows = blocks.labelled_blocks(spark)
    model = DecisionTreeClassifier(maxDepth=blocks.DEPTH, minInstancesPerNode=blocks.LEAST, weightCol="weight", seed=7).fit(rows.coalesce(1))
    told = model.transform(rows).withColumn("ours", blocks.tree_column(model.toDebugString, vector_to_array("features")))
    assert told.where(F.col("ours") != (F.col("prediction") == 1)).count() == 0
    assert told.where(F.col("ours") == (F.col("label") == 1)).count() > 0.97 * rows.count()


def test_empty_table(spark):
    assert blocks.main_text(spark.createDataFrame([], "page_id long, html string")).count() == 0


def test_query_against_the_marked_article(spark):
    import html
    import re

    from wheelhouse.llm import QUERIES

    folder = "/root/testdata/sf0.001"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    got = QUERIES["op2_html_main_text"](spark, folder).collect()
    assert len(got) == len(pages)
    for row in got:
        body = re.search(r"<article>(.*?)</article>", pages[row.page_id], re.S)[1]
        want = " ".join(html.unescape(re.sub(r"<[^>]+>", "\x00", body)).replace("\x00", " ").split())
        assert row.text == want and row.n_chars == len(want)


LONG = "This paragraph has enough words in it to be taken for the main text of a page about something or other. " * 2
FOUND_WRONG = [
    # a menu of plain blocks without links, and a closing line
    (f"<body><div>Home</div><div>About</div><div>Contact</div><h1>A title of five words</h1><p>{LONG}</p><p>{LONG}</p><div>All rights reserved 2020</div></body>", f"A title of five words {LONG}{LONG}"),
    # a paragraph with three of eight words linked
    ("<body><article><p>Read <a href=x>the whole story</a> about our town</p></article></body>", "Read the whole story about our town"),
    (f"<body><h1>Some title here</h1><p>{LONG}</p><p>More on <a href=x>that old story</a> is told below.</p><p>{LONG}</p></body>", f"Some title here {LONG}More on that old story is told below. {LONG}"),
    # classes that only sound like furniture, or like the article
    (f"<body><div class=notice-of-law><p>{LONG}</p><p>{LONG}</p></div></body>", LONG + LONG),
    (f"<body><article><div class=post-header><h1>Own title</h1></div><p>{LONG}</p></article></body>", f"Own title {LONG}"),
    (f"<body><div class=article-body><p>{LONG}</p></div><div class=article-comments><p>{LONG}</p><p>me too</p></div></body>", LONG),
]


def test_pages_that_were_read_wrong(spark):
    pages = spark.createDataFrame([(i, page) for i, (page, _) in enumerate(FOUND_WRONG)], "page_id long, html string")
    for row in blocks.main_text(pages).collect():
        assert row.text == " ".join(FOUND_WRONG[row.page_id][1].split())


def _kept(tree, features):
    lines = [line.strip() for line in tree.splitlines()[1:] if line.strip()]
    import re

    def node(at):
        if lines[at].startswith("Predict"):
            return float(lines[at].split(":")[1]) == 1.0, at + 1
        number, limit = re.match(r"If \(feature (\d+) <= ([-\d.eE]+)\)", lines[at]).groups()
        yes, at = node(at + 1)
        no, at = node(at + 1)
        return (yes if features[int(number)] <= float(limit) else no), at

    return node(0)[0]


def test_words_links_and_neighbours_decide(spark):
    """On unmarked pages of another seed; without the method's features, or without neighbours, more goes wrong."""
    import random

    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.linalg import Vectors

    tree = blocks.trained_tree(spark)
    for name in ("words", "links", "words_before", "words_after"):
        assert f"feature {blocks.FEATURES.index(name)} " in tree, name
    rng = random.Random(99)
    held_out = [b for _ in range(150) for b in blocks.blocks_of(blocks.generated_page(rng))]
    labelled = [("+" in b.text.split(), b.features) for b in held_out]

    def share(printed, hidden=()):
        return sum(_kept(printed, [0.0 if i in hidden else x for i, x in enumerate(f)]) == label for label, f in labelled) / len(labelled)

    def without(*names):
        hidden = {blocks.FEATURES.index(name) for name in names}
        rows = [(Vectors.dense([0.0 if i in hidden else x for i, x in enumerate(r.features)]), r.label, r.weight) for r in blocks.labelled_blocks(spark).collect()]
        learner = DecisionTreeClassifier(maxDepth=blocks.DEPTH, minInstancesPerNode=blocks.LEAST, weightCol="weight", seed=7)
        return share(learner.fit(spark.createDataFrame(rows, ["features", "label", "weight"]).coalesce(1)).toDebugString, hidden)

    whole = share(tree)
    neighbours = ("words_before", "links_before", "words_after", "links_after")
    assert whole > 0.93
    assert without(*neighbours) < whole - 0.01
    assert without("words", "links", *neighbours) < whole - 0.15


def test_names_of_furniture():
    told = {name: blocks._hints(f'class="{name}"') for name in ("ad-slot", "cookie-notice", "CommentList", "sidebar left", "notice-of-law", "entry-header", "site-header", "article-comments", "article-body", "postNavigation", "headline")}
    assert [name for name, (furniture, _) in told.items() if furniture] == ["ad-slot", "cookie-notice", "CommentList", "sidebar left", "site-header", "article-comments", "postNavigation"]
    assert [name for name, (_, article) in told.items() if article] == ["article-body"]
