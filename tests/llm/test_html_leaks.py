"""Main text of small pages; benchmark leaks against brute force over all windows."""

import random
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from onblock.llm import decontamination
from onblock.llm.html import extract, main_text

ARTICLE = "<h1>A &amp; B</h1><p>First paragraph of the article with a number of words.<p>Second one, <a href=x>linked</a>, and\n\n more&nbsp;words.</p>"
TEXT = "A & B\nFirst paragraph of the article with a number of words.\nSecond one, linked, and more words."


@pytest.mark.parametrize(
    "page",
    [
        f"<html><body><nav><a href=1>One</a><a href=2>Two</a></nav><article>{ARTICLE}</article><footer>Foot</footer></body></html>",
        f"<body><div id='main-menu'><a>x</a></div><div class='post'>{ARTICLE}</div><div class='cookie-notice'>We use cookies.</div>",
        f"<script>var a='<p>';</script><style>p{{}}</style><main>{ARTICLE}<section class=comments><p>Nice!</p></section></main><aside>side</aside>",
        f"<body><header><h1>Site</h1></header><form>Name <input></form><div>{ARTICLE}</div><div class='ad'>Buy</div>",
        f"<article><header>{ARTICLE[:18]}</header>{ARTICLE[18:]}<div id=comments><p>a comment</p></div>",
    ],
)
def test_article_of_a_page(page):
    assert main_text(page) == TEXT


@pytest.mark.parametrize("named", ["class='layout with-sidebar'", "id=content class=has-sidebar", "class=post-widget", "id=search-results-explained", "class=widget"])
def test_a_name_does_not_take_the_article_away(named):
    assert main_text(f"<body><div class='ad'>Buy</div><div {named}>{ARTICLE}</div><div id='comment-list'><p>a comment</p></div>") == TEXT


@pytest.mark.parametrize(
    ("page", "text"),
    [("", ""), ("plain", "plain"), ("<nav>only a menu</nav>", ""), ("<p>a<br>b</p>", "a\nb"), ("<ul><li>one<li>two</ul>", "one\ntwo"), ("<p>cut &am", "cut &am"), ("<div>" * 3_000 + "deep", "deep")],
)
def test_odd_pages(page, text):
    assert main_text(page) == text


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<>/pdivbrali h1=\"'&;!-#x", max_size=120))
def test_any_markup_is_read(page):
    assert "\n\n" not in main_text(page)


def test_rows_of_pages(spark):
    pages = spark.createDataFrame([(None,), ("",), ("<p>x</p>",), ("<p>x</p>",)], "html string")
    assert [r[0] for r in pages.select(extract(F.col("html"))).collect()] == ["", "", "x", "x"]
    assert pages.limit(0).select(extract(F.col("html"))).count() == 0


def runs(words):
    return Counter(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))) if words else Counter()


def plain_leaks(text, items):
    words, found = re.findall(r"\w+", (text or "").lower()), set()
    for item, passage in items:
        own = re.findall(r"\w+", (passage or "").lower())
        for start in range(max(len(words) - len(own), 0) + 1):
            a, b = runs(words[start : start + len(own)]), runs(own)
            both = (a & b).total()
            if own and item is not None and both and both / (a.total() + b.total() - both) >= 0.8:
                found.add(item)
    return found


@pytest.fixture(scope="module")
def leaking():
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(1, 4)))
    items = [(i, " ".join(word() for _ in range(rng.choice([3, 6, 15, 16, 40, 59])))) for i in range(60)] + [(60, None), (61, ""), (None, "x y z a b c"), (5, "same id other words entirely here now")]
    docs = [(0, None), (1, ""), (2, items[0][1]), (3, "Short"), (4, items[7][1].upper() + "!")]
    for i in range(5, 250):
        words = [word() for _ in range(rng.randint(1, 120))]
        if i % 2:
            leak = (items[rng.randrange(60)][1]).split()
            for _ in range(rng.randint(0, 2)):
                at = rng.randrange(len(leak))
                leak[at : at + rng.randint(0, 1)] = [word()] * rng.randint(0, 1)
            at = rng.randrange(len(words) + 1)
            words[at:at] = leak * rng.choice([1, 1, 2])
        docs.append((i, " ".join(words)))
    return docs, items


def test_leaks_equal_brute_force(spark, leaking):
    docs, items = leaking
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    frame = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, found string")
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.contaminated(frame, benchmark).collect()}
    want = {(i, item) for i, t in docs for item in plain_leaks(t, items)}
    assert len(want) > 60 and got == want
    clean = {r["doc_id"] for r in decontamination.decontaminate(frame, benchmark).collect()}
    assert clean == {i for i, _ in docs} - {i for i, _ in want}


def test_long_documents_are_read_in_segments(monkeypatch, leaking):
    docs, items = leaking
    monkeypatch.setattr(decontamination, "SEGMENT", 37)
    index = decontamination.Index([(i, t) for i, t in items if i is not None and t is not None])
    for _, text in docs[5:60]:
        assert {m["item_id"] for m in index.matches(text)} == plain_leaks(text, items)


def test_without_benchmark(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.contaminated(docs, none).count() == 0 and decontamination.decontaminate(docs, none).count() == 1


def test_a_benchmark_beyond_its_bound_is_refused(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "MOST_BYTES", 3)
    with pytest.raises(ValueError, match="in parts"):
        decontamination.leaks(F.col("text"), spark.createDataFrame([(1, "abcdef")], "item_id long, text string"))
