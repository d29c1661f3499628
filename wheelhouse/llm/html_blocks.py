"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is cut at its block-level tags into a flat list of text blocks.  A block is described by its number of words and
its link density (words inside links), by those of the block before and the block after it, by whether it is a heading,
and by whether it stands inside an element whose tag, class, id or role names page furniture, inside the article, or
outside of the article on a page that has one.  A decision tree, trained with Spark's own learner on the small labelled
table below, decides which blocks are main text; it is then written as one column expression, so that classifying is done
where the blocks are.  Half of the labelled pages name nothing: there words, links and neighbours decide.

Scripts, styles, templates and comments are never text.  Character references are decoded after the markup is cut, white
space in a block becomes one space, and the chosen blocks are joined in page order by one space; nothing else is dropped.
A null or empty page, and one of furniture alone, has an empty text.  Markup may be broken or cut off: an element that
never closes reaches to the end of what holds it.  Pages are read whole.  Repeated pages give repeated rows, an empty
table none; other columns are kept and those named like the results replaced.
"""

from __future__ import annotations

import html
import random
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wheelhouse.llm.batches import texts_of, with_batches

DEPTH, LEAST, MARKED = 9, 3, 8.0
FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "furniture", "article", "elsewhere", "heading")

# Element names of the HTML standard.
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table "
    "tbody td tfoot th thead title tr ul".split()
)
_HOLDERS = frozenset(
    "article aside body button details dialog div dl fieldset figure footer form head header main menu nav ol search section select table "
    "td th title tr ul span p".split()
)
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
_RAW = frozenset("script style template noscript textarea iframe object svg math canvas noembed noframes xmp".split())
_FURNITURE_TAGS = frozenset("aside button dialog footer form head header menu nav search select title".split())
_ARTICLE_TAGS = frozenset(("article", "main"))
_FURNITURE_WORDS = frozenset(
    "ad ads adv advert advertisement adverts advertising banner breadcrumb breadcrumbs byline-share comment comments consent cookie cookies "
    "copyright disclaimer disqus dialog footer form gdpr header hidden legal login masthead menu modal nav navbar navigation newsletter notice "
    "overlay pager pagination popup promo promoted promotion recommended related reply replies search share sharing sidebar signup skip social "
    "sponsor sponsored subscribe tags toolbar topbar warning widget alert notification complementary contentinfo".split()
)
_ARTICLE_WORDS = frozenset("article".split())
_OWN_WORDS = frozenset("article entry post story".split())  # whose header is not the page's
_PLAIN_WORDS = frozenset("area block body box container content group inner item items list outer row section wrap wrapper".split())
_JOINING_WORDS = frozenset("about for in of on to with".split())
_TOKEN = re.compile(r"<!--|<!\[CDATA\[|<[!?][^>]*>?|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)>")
_ATTRIBUTE = re.compile(r"""(?i)(?:^|[\s"'/])(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_HINT_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@dataclass
class Block:
    text: str
    words: int
    link_words: int
    furniture: bool
    article: bool
    heading: bool = False
    features: list[float] = field(default_factory=list)

    @property
    def links(self) -> float:
        return self.link_words / self.words if self.words else 0.0


def _names_furniture(words: list[str]) -> bool:
    """Whether a name such as ``cookie-notice-box`` means page furniture: by what it is in the end, or begins with."""
    while len(words) > 1 and words[-1] in _PLAIN_WORDS:
        words = words[:-1]
    if words[-1] == "header" and _OWN_WORDS & set(words):
        return False
    return words[-1] in _FURNITURE_WORDS or words[0] in _FURNITURE_WORDS and not _JOINING_WORDS & set(words)


def _hints(attributes: str) -> tuple[bool, bool]:
    """Whether the attributes of an element name furniture, or the article."""
    furniture = article = False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
            furniture = True
        elif name in ("class", "id", "role"):
            for one in value.split():
                words = [word.lower() for word in _HINT_WORD.findall(one)]
                if words and _names_furniture(words):
                    furniture = True
                elif _ARTICLE_WORDS & set(words):
                    article = True
    return furniture, article and not furniture


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page in order, with their features."""
    out: list[Block] = []
    texts: list[tuple[str, bool]] = []
    holders: list[tuple[str, bool, bool]] = []  # tag, furniture and article as they hold inside
    links, heading = 0, False

    def state() -> tuple[bool, bool]:
        return (holders[-1][1], holders[-1][2]) if holders else (False, False)

    def close() -> None:
        if texts:
            words = " ".join("".join(part for part, _ in texts).split())
            if words:
                in_links = sum(len(part.split()) for part, linked in texts if linked)
                furniture, article = state()
                out.append(Block(words, words.count(" ") + 1, in_links, furniture, article, heading))
            texts.clear()

    at = 0
    while at < len(page):
        match = _TOKEN.search(page, at)
        end = match.start() if match else len(page)
        if end > at:
            texts.append((html.unescape(page[at:end]), links > 0))
        if match is None:
            break
        at = match.end()
        opening = match[0]
        if opening == "<!--" or opening == "<![CDATA[":
            stop = "-->" if opening == "<!--" else "]]>"
            found = page.find(stop, at)
            at = len(page) if found < 0 else found + len(stop)
            continue
        tag = (match[2] or match[5] or "").lower()
        if not tag:
            continue
        closing, attributes = match[1] or match[4], match[3] or match[6] or ""
        if tag in _RAW:
            if not closing and not attributes.rstrip().endswith("/"):
                found = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
                at = len(page) if found is None else found.end()
            texts.append((" ", False))
            continue
        if tag == "a":
            links = max(0, links - 1) if closing else 1
        if tag == "br":
            texts.append((" ", False))
        if tag in _BLOCKS:
            close()
            links, heading = 0, not closing and tag in _HEADINGS
        if tag in _HOLDERS:
            if closing:
                if any(name == tag for name, *_ in holders):
                    if tag not in _BLOCKS and state() != _outside(holders, tag):
                        close()
                    while holders.pop()[0] != tag:
                        pass
            else:
                if tag == "p" and holders and holders[-1][0] == "p":
                    holders.pop()
                furniture, article = state()
                hinted, named = _hints(attributes)
                inside = furniture or hinted or tag in _FURNITURE_TAGS and not (tag == "header" and article)
                if tag == "body":
                    inside = False  # a class of the whole page says nothing about its parts
                if tag not in _BLOCKS and inside != furniture:
                    close()
                holders.append((tag, inside, article or named or tag in _ARTICLE_TAGS))
    close()
    return _with_neighbours(out)


def _outside(holders: list[tuple[str, bool, bool]], tag: str) -> tuple[bool, bool]:
    """The state around the innermost open element of that tag."""
    i = max(i for i, (name, *_) in enumerate(holders) if name == tag)
    return (holders[i - 1][1], holders[i - 1][2]) if i else (False, False)


def _with_neighbours(blocks: list[Block]) -> list[Block]:
    """The blocks with their features, in the order of :data:`FEATURES`."""
    marked = any(block.article and not block.furniture for block in blocks)
    for i, block in enumerate(blocks):
        before = blocks[i - 1] if i else None
        after = blocks[i + 1] if i + 1 < len(blocks) else None
        block.features = [
            float(block.words), block.links,
            float(before.words) if before else 0.0, before.links if before else 0.0,
            float(after.words) if after else 0.0, after.links if after else 0.0,
            float(block.furniture), float(block.article), float(marked and not block.article), float(block.heading),
        ]
    return blocks


_WORDS = "plain words of a sentence that goes on for a while and says what the page is about in some detail"


def _some(count: int) -> str:
    words = _WORDS.split()
    return " ".join(words[i % len(words)] for i in range(count))


def labelled_pages() -> list[str]:
    """The small labelled table as pages: blocks that begin with ``+`` are main text, all others are not."""
    article = "".join(f"<p>+ {_some(n)}</p>" for n in (40, 1, 12, 3, 80, 0, 7, 25))
    linked = f"<p>+ {_some(9)} <a href=x>{_some(6)}</a> {_some(5)}</p><p>+ <a href=y>{_some(4)}</a></p>"
    menu = "<ul>" + "".join(f"<li><a href=/{i}>- {_some(n)}</a></li>" for i, n in enumerate((0, 1, 4, 8, 2, 12))) + "</ul>"
    furniture = [
        f"<nav>{menu}</nav>", f"<header><h1>- {_some(4)}</h1>{menu}</header>", f"<div class=ad>- {_some(8)}</div>", f"<div class=ads>- {_some(60)}</div>",
        f"<aside><p>- {_some(30)}</p></aside>", f"<form><p>- {_some(5)}</p><button>- go</button></form>", f"<div id=cookie-notice>- {_some(20)}</div>",
        f"<section class=comments><p>- {_some(50)}</p><p>- {_some(2)}</p></section>", f"<footer>- {_some(9)}</footer>", f"<div class=sidebar><p>- {_some(15)}</p>{menu}</div>",
    ]
    pages = []
    for body in (f"<article><h1>+ {_some(5)}</h1>{article}</article>", f"<main>{article}{linked}</main>", f"<article><p>+ {_some(1)}</p></article>"):
        for piece in furniture:
            pages.append(f"<html><head><title>- {_some(6)}</title></head><body>{furniture[0]}{piece}{body}{piece}{furniture[8]}</body></html>")
    # Furniture within the article, also where that never closes; a header there is the article's own.
    for piece in furniture[:1] + furniture[2:]:
        pages.append(f"<body>{furniture[0]}<article><h1>+ {_some(5)}</h1>{article}{piece}{linked}</article>{furniture[8]}</body>")
        pages.append(f"<body><main><p>+ {_some(3)}</p><ul><li>+ {_some(2)}</li><li>+ {_some(9)}</li></ul>{piece}{furniture[8]}")
        links = "".join(f"<h2>+ {_some(n)}</h2><ul><li><a href=x>+ {_some(n)}</a></li><li><a href=y>+ {_some(1)}</a></li></ul>" for n in (1, 2, 4, 7))
        pages.append(f"<body>{menu}<article>{links}{article}{piece}{links}</article>{menu}{furniture[8]}</body>")
    # Pages without an article element: plain text blocks are told from lists of links and crumbs by words and links.
    for piece in furniture:
        for sizes in ((35, 22, 60, 18), (12, 9, 30), (90,), (50, 4, 40, 8, 25)):
            long = "".join(f"<p>+ {_some(n)}</p>" for n in sizes)
            pages.append(f"<body>{piece}<div><h1>+ {_some(6)}</h1>{long}</div><div>{menu}</div><p>- <a href=z>{_some(2)}</a></p>{piece}</body>")
    rng = random.Random(3)
    return pages + [generated_page(rng) for _ in range(160)] + [generated_page(rng, marked=True) for _ in range(400)]


def generated_page(rng: random.Random, marked: bool = False) -> str:
    """A labelled page that names nothing: menus, crumbs, link lists and closing lines around an article of plain blocks.

    With ``marked`` the article is an element of its own, may be of a few words, and holds something foreign now and then.
    """

    def block(sign: str, count: int, linked: float = 0.0, tag: str = "div") -> str:
        """A block of so many words, the sign among them, with a share of them in a link."""
        words = [sign, *_some(count - 1).split()] if count > 1 else [sign]
        inside = min(len(words), round(linked * len(words)))
        if not inside:
            return f"<{tag}>{' '.join(words)}</{tag}>"
        first = 0 if inside == len(words) else rng.randint(1, len(words) - inside)
        return f"<{tag}>{' '.join(words[:first])} <a href=/x>{' '.join(words[first : first + inside])}</a> {' '.join(words[first + inside :])}</{tag}>"

    def menu() -> str:
        kind, tag = rng.randrange(4), rng.choice(("div", "li", "td"))
        if kind == 3:
            return block("-", rng.randint(2, 8))  # one line of names
        return "".join(block("-", rng.choice((1, 1, 2, 2, 3)), 1.0 if kind else 0.0, tag) for _ in range(rng.randint(3, 8)))

    def paragraph() -> str:
        count = rng.choice((12, 18, 25, 30, 45, 60, 80, 120, rng.randint(10, 100)))
        return block("+", count, rng.choice((0, 0, 0, 0.1, 0.2, 0.3, 0.4)), "p")

    def article() -> str:
        if marked and rng.random() < 0.5:
            tags = ("p", "h1", "li", "div", "td")
            return "".join(block("+", rng.randint(1, 9), rng.choice((0, 0, 0.5, 1.0)), rng.choice(tags)) for _ in range(rng.randint(1, 9)))
        parts = [block("+", rng.randint(2, 10), 0, rng.choice(("h1", "h1", "h2", "div")))]
        for _ in range(rng.choice((1, 2, 4, 6, 9))):
            parts.append(paragraph())
            if rng.random() < 0.25:  # a short one, or a heading, with text on both sides
                parts.append(block("+", rng.randint(1, 9), 0, rng.choice(("p", "h2", "h3"))) + paragraph())
            if rng.random() < 0.15:
                parts += [block("+", rng.randint(4, 20), rng.choice((0, 0, 0.3)), "li") for _ in range(rng.randint(2, 5))] + [paragraph()]
        return "".join(parts)

    related = "".join(block("-", rng.randint(4, 12), 1.0, rng.choice(("div", "li"))) for _ in range(rng.randint(2, 6)))
    closing = "".join(block("-", rng.randint(1, 7), rng.choice((0, 0, 1.0))) for _ in range(rng.randint(1, 4)))
    crumbs = block("-", rng.randint(2, 6), 0.7) if rng.random() < 0.3 else ""
    before, after = menu() if rng.random() < 0.75 else "", (related if rng.random() < 0.5 else "") + (closing if rng.random() < 0.75 else "")
    if not marked:
        return f"<body>{before}{crumbs}{article()}{after}</body>"
    foreign = rng.choice(("<aside>{}</aside>", "<div class=ad>{}</div>", "<form>{}</form>", "<div id=share>{}</div>")).format(block("-", rng.randint(1, 60)))
    inside = article() + (foreign + article() if rng.random() < 0.4 else "")
    holder = rng.choice(("article", "article", "main"))
    if rng.random() < 0.5:
        return f"<body><{holder}>{inside}</{holder}></body>"
    outside = f"<div>{block('-', rng.randint(1, 80))}</div>" if rng.random() < 0.5 else ""
    return f"<body>{before}{crumbs}<{holder}>{inside}</{holder}>{outside}{after}</body>"


def labelled_blocks(spark: SparkSession) -> DataFrame:
    """(features, label, weight) of the labelled table; a block of a page that marks its article counts several times."""
    rows = [
        (Vectors.dense(b.features), float("+" in b.text.split()), MARKED if b.article or b.features[8] else 1.0)
        for page in labelled_pages()
        for b in blocks_of(page)
    ]
    return spark.createDataFrame(rows, ["features", "label", "weight"])


def trained_tree(spark: SparkSession) -> str:
    """The decision tree as the learner prints it."""
    learner = DecisionTreeClassifier(maxDepth=DEPTH, minInstancesPerNode=LEAST, weightCol="weight", seed=7)
    return learner.fit(labelled_blocks(spark).coalesce(1)).toDebugString


def tree_column(printed: str, features: Column) -> Column:
    """A printed tree as a column that is true for class 1."""
    lines = [line.strip() for line in printed.splitlines()[1:] if line.strip()]

    def node(at: int) -> tuple[Column, int]:
        if lines[at].startswith("Predict"):
            return F.lit(float(lines[at].split(":")[1]) == 1.0), at + 1
        number, limit = re.match(r"If \(feature (\d+) <= ([-\d.eE]+)\)", lines[at]).groups()
        yes, at = node(at + 1)
        no, at = node(at + 1)  # the line of the Else repeats the test
        return F.when(F.get(features, F.lit(int(number))) <= float(limit), yes).otherwise(no), at

    return node(0)[0]


def page_blocks(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """``pages`` with ``blocks``: text and features in page order."""

    def prepare():
        def work(column: pa.Array) -> list:
            return [[[{"text": b.text, "features": b.features} for b in blocks_of(page)] for page in texts_of(column)]]

        return work

    return with_batches(pages, [html_column], "blocks array<struct<text:string,features:array<double>>>", prepare)


def main_text(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """``pages`` with ``text`` (the main text) and ``n_blocks``, ``n_main_blocks``."""
    tree = trained_tree(pages.sparkSession)
    found = page_blocks(pages, html_column)
    main = F.filter("blocks", lambda block: tree_column(tree, block["features"]))
    return found.withColumn("__main", main).withColumns(
        {
            "text": F.array_join(F.transform("__main", lambda block: block["text"]), " "),
            "n_blocks": F.size("blocks"),
            "n_main_blocks": F.size("__main"),
        }
    ).drop("blocks", "__main")
