"""Pages of plain tags and the parser's reading of them, and how pages are dealt."""

import random

import pytest

from parcelforge.functions import html
from parcelforge.functions.selectors import Page
from parcelforge.plans import fields

PIECES = ["<div>", "</div>", "<div class='a b'>", "<p>", "</p>", '<a href="/x">', "</a>", "<br>", "text ", "&amp;", '<li data-k="a b">', "</li>", "\n", "Units", '<B CLASS="card">', "</b>", "<i id='z' id='w'>", "</i>"]
SELECTORS = ["div", "div > p", "div p", "p + a", "p ~ a", "*", "li[data-k~=b] + li", "div:contains('Units') + div", "i#z", ":first-child", "* > * + *", "div.b, b.card", "b.card div"]


def test_plain_pages_are_read_as_by_the_parser():
    r = random.Random(3)
    for _ in range(500):
        markup = "".join(r.choices(PIECES, k=r.randrange(30))) + "<hr>"
        one, two = Page(markup), Page(markup + "<!-- not plain -->")
        assert not hasattr(one, "rawdata") and hasattr(two, "rawdata")
        told = [(p.tags, p.attrs, p.parents, p.before, p.ends, p.first, p.last, p.starts, p.pieces) for p in (one, two)]
        assert told[0] == told[1] and all(one.select(s) == two.select(s) for s in SELECTORS)


def test_other_pages_go_through_the_parser():
    for markup in ("<div", "a &am", "<script><b></script>", "<a title='x>y'>", "<a title='x<y'>", "<br/>", "<p a='1'b='2'>"):
        assert hasattr(Page(markup), "rawdata")


def test_several_readings_of_a_page_at_once(spark):
    markup = "<div class='k'><b>Grade</b><i>A</i></div><ul><li>x</li></ul>"
    rows = spark.createDataFrame([(markup,), (None,)], "html string")
    found = rows.select(html.block_lists(rows.html, {"a": ("div.k", "b", ("u", "i"), None)}, {"t": "li"}).alias("f"), html.card_fields(rows.html, {"x": "none"}, texts={"y": "i"}).alias("c"))
    assert found.select("f.*", "c.*").collect() == [([("Grade", "A")], "x", None, "A"), ([], "", None, "")]


@pytest.mark.parametrize("made", [fields._pages, fields.detail_blocks, fields.estate_cards, fields.listing_cards, fields.page_fields])
def test_pages_of_a_small_file_are_dealt_over_all_cores(spark, sf_dir, made):
    assert made(spark, sf_dir).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
