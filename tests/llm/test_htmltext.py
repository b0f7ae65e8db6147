import html
import random
import re

import pytest

from caremesa.llm import htmltext

FOLDER = "/root/testdata/sf0.01"
GOOD = "the cat and the dog of it is in the house with a ball for all of us to play "


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""), ("", ""), ("hello <b>wor</b>ld", "hello world"), ("<!-- a --><p>a &amp; b&nbsp;&eacute;&#33;", "a & b é!"),
        ("<article><p>one\n\t two<br>three<p>four</article>", "one two three\nfour"),
        ("<nav><p>menu</nav><article><header><h1>T</h1></header><p>x</article><footer>f</footer>", "T\nx"),
        ("<article><p>x<section class='comments'><p>" + GOOD + "</section><aside>s</aside><form>n</form>y</article>", "x\ny"),
        ("<div class='cookie-notice'>" + GOOD + "</div><main><p>m</main>", "m"),
        ("<article><p>a<div id=ad>buy</div><script>if (a < b) '</p>'</script><style>p{}</style>b</article>", "a\nb"),
        ("<article><p>real<article class=comment>mine</article></article>", "real"),
        ("<p>" + GOOD + "<p>short<div><a href=x>link link link</a></div>", GOOD.strip()),
        ("<p hidden>no</p><p style='display: none'>no</p><p>yes", "yes"), ("<p title='a > b'>x</p>", "x"), ("a < b and c", "a < b and c"),
        ("<ul><li>one<li>two</ul>", "one\ntwo"), ("<article></article>", ""), ("<script>x", ""),
    ],
)
def test_pages(page, text):
    assert htmltext.main_text(page) == text


def test_open_blocks_take_the_nearest_label():
    block = lambda part: htmltext.Block("x", 0, part, False, False)
    blocks = [block(0)] * 5
    assert htmltext.second_pass(blocks, [1, None, None, None, 0]) == [1, 1, 0, 0, 0]
    assert htmltext.second_pass([block(1)] * 5, [1, None, None, None, 0]) == [1, 1, 1, 0, 0]
    assert htmltext.second_pass(blocks, [None] * 5) == [1] * 5
    assert htmltext.second_pass([block(0), block(1)], [0, None]) == [0, 1]


def test_broken_and_huge_markup_takes_linear_time():
    for page in ("<p title='" * 50_000, "<" * 500_000, "<div>" * 50_000 + "x", "<p>" * 50_000, "</x>" * 50_000, "<script>" * 50_000, "<b>" * 20_000 + "</i>" * 20_000):
        htmltext.main_text(page)


def test_articles_of_the_test_pages(spark):
    rows = htmltext.extract(spark.read.parquet(f"{FOLDER}/pages.parquet")).collect()
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for row in rows:
        article = re.search(r"<article>(.*)</article>", pages[row["page_id"]], re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert row["text"] == "\n".join(b for b in blocks if b) and row["n_chars"] == len(row["text"])


def test_awkward_rows(spark):
    rows = [(1, "u", None), (None, None, "<p>x"), (2, "u", ""), (2, "u", ""), (3, "u", "<p>" + "word " * 100_000)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'clash' as text", "1 as n_chars")
    found = sorted((r["page_id"] or 0, r["n_chars"]) for r in htmltext.extract(frame).collect())
    assert found == [(0, 1), (1, 0), (2, 0), (2, 0), (3, 499_999)]
    assert htmltext.extract(frame.limit(0)).count() == 0


@pytest.mark.parametrize(
    "page, text",
    [
        # a list of links and an advert, both unmarked
        (f"<article><h1><a href=/>T</a></h1><p>{GOOD}<ul><li><a href=a>more of this</a><li><a href=b>and that</a></ul><p>{GOOD}</article>", f"T\n{GOOD.strip()}\n{GOOD.strip()}"),
        (f"<main><p>{GOOD}<div><a href=shop>New shoes, half price</a> today</div><p>{GOOD}</main>", f"{GOOD.strip()}\n{GOOD.strip()}"),
        (f"<article><p>{GOOD}<div>Advertisement</div><div>Shoes, half price.</div><p>{GOOD}</article>", f"{GOOD.strip()}\n{GOOD.strip()}"),
        # an ambiguous block stands among links
        (f"<article><p>{GOOD}<p>near<div><a href=a>link</a></div><div>read on</div><div><a href=b>link</a></div></article>", f"{GOOD.strip()}\nnear"),
        (f"<article><p>short<ul><li><a href=a>link</a></ul></article>", "short"),
        # long and dense text beside the article, and other blocks there
        (f"<article><p>x</article><p>{GOOD * 2}", f"x\n{(GOOD * 2).strip()}"), (f"<article><p>x</article><p>{GOOD}", "x"), ("<p>y</p><main>x</main>", "x"),
    ],
)
def test_blocks_inside_and_outside_an_article_are_decided(page, text):
    assert htmltext.main_text(page) == text


TEXT = GOOD.strip()


@pytest.mark.parametrize(
    "page, text",
    [
        # marks on what holds the article
        (f"<div class='page with-sidebar'><article><p>{GOOD}</article></div>", TEXT), (f"<div class=sidebar><main><p>{GOOD}</main></div>", TEXT),
        (f"<div id=popup-wrapper style='display:none'><div class='banner'><article><p>x</article></div></div>", "x"),
        (f"<div class=widget><p>{GOOD}<p>{GOOD}</div><div class=widget><p>{GOOD}</div>", f"{TEXT}\n{TEXT}"),
        (f"<div class='comments'><p>{GOOD}</div>", TEXT), (f"<p>{GOOD}<div class='comments'><p>{GOOD * 3}</div>", TEXT),
        # compounds, mentions and values that only look like marks
        (f"<article><p>{GOOD}<div class='social-science'>{GOOD}</div><div class='social-share'>{GOOD}</div></article>", f"{TEXT}\n{TEXT}"),
        (f"<article><div class='has-ads no-sidebar'>{GOOD}</div><p title='the hidden truth' data-x=hidden>{GOOD}</article>", f"{TEXT}\n{TEXT}"),
        (f"<article><div class=adBox>{GOOD}</div><div class='ad_slot-2'>{GOOD}</div><div class=Advertisement>x</div><p>{GOOD}</article>", TEXT),
        ("<div class='social-science'><p>y</div><article>x</article>", "x"),
        # links
        ("<article><p><a href=x>the whole story</a></article>", "the whole story"),
        (f"<article><p><a href=http://x.com/>link text of some length</a> and</p><p>{GOOD}</article>", TEXT),
        (f"<article><p>{GOOD}<p><a href=http://x.com/>link</a> <i/>and more of the text, which goes on and on for the reader</article>", f"{TEXT}\nlink and more of the text, which goes on and on for the reader"),
        # notices without any mark
        (f"<article><p>{GOOD}<div>We use cookies on this website. Accept our cookie policy to go on.</div><p>{GOOD}</article>", f"{TEXT}\n{TEXT}"),
        (f"<article><p>{GOOD}<div>Subscribe to our newsletter and get it in your inbox.</div></article>", TEXT),
        (f"<article><p>{GOOD}<p>She put the cookies on a plate and they agree that it was good to eat them all.</article>", f"{TEXT}\nShe put the cookies on a plate and they agree that it was good to eat them all."),
    ],
)
def test_marks_are_weighed(page, text):
    assert htmltext.main_text(page) == text


def test_attributes():
    found = htmltext.attributes_of(""" CLASS="a b" id=c data-x='d "e"' hidden href=http://x/y/ class=z style = "display : none" """)
    assert found == {"class": "a b", "id": "c", "data-x": 'd "e"', "hidden": "", "href": "http://x/y/", "style": "display : none"}
    assert [htmltext.mark_of(htmltext.attributes_of(a)) for a in ("class='ad'", "id=siteFooter", "class='footer-art'", "class='x'", "role=navigation", "title='hidden'")] == [
        htmltext.OTHER, htmltext.OTHER, htmltext.PERHAPS, None, htmltext.OTHER, None,
    ]


def test_generated_pages():
    """Pages whose text is known because they are built from it: paragraphs in any wrappers, with other parts in between."""
    random.seed(2)
    words = "the and of to in is that it was for on are with by be this from at not".split()
    noise = "house garden river mountain letter window evening story travel people market winter".split()
    wrappers = ["div", "section", "div class='content with-sidebar'", "div class='widget-story'", "div id=main", "div class='legal-history'", "span"]

    def paragraph():
        return " ".join(random.choice(words if i % 2 else noise) for i in range(random.randint(30, 60)))

    def link(text):
        return f"<a href='http://x.com/{random.randint(0, 9)}/'>{text}</a>"

    def other(depth):
        kind = random.randrange(7)
        links = "".join(f"<li>{link(random.choice(noise))}" for _ in range(random.randint(2, 5)))
        return [
            f"<nav><ul>{links}</ul></nav>", f"<ul>{links}</ul>", f"<div class='{random.choice(['ad', 'sponsored', 'ad-box', 'siteBanner'])}'>{paragraph()}</div>",
            f"<aside><p>{paragraph()}</aside>", f"<div hidden><p>{paragraph()}</div>", f"<form>{paragraph()}</form>",
            "<div>Please accept cookies and our privacy policy.</div>",
        ][kind]

    def body(depth):
        parts, text = [], []
        for _ in range(random.randint(1, 4)):
            kind = random.random()
            if kind < 0.5 or depth > 3:
                own = paragraph()
                parts.append(f"<p>{own}</p>")
                text.append(own)
            elif kind < 0.75:
                parts.append(other(depth))
            else:
                wrapper, (inner, own) = random.choice(wrappers), body(depth + 1)
                parts.append(f"<{wrapper}>{inner}</{wrapper.split()[0]}>")
                text += own
        return "".join(parts), text

    for case in range(300):
        inner, text = body(0)
        element = random.choice(["article", "main", "div", "div class='banner wrapper'"])
        own = [paragraph() for _ in range(8 if "banner" in element else 1)]  # a mark is overruled by most of the text
        page = f"{other(0)}<{element}>{''.join(f'<p>{text}</p>' for text in own)}{inner}</{element.split()[0]}>{other(0)}<footer>{paragraph()}</footer>"
        wrapper = random.choice(wrappers)
        page = f"<html><body class='no-ads'><{wrapper}>{page}</{wrapper.split()[0]}>"
        assert htmltext.main_text(page) == "\n".join([*own, *text]), (case, page)
