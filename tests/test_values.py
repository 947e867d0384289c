"""Cleaning, text, dates, nested values and pages on literal rows."""

import datetime
import random
from difflib import SequenceMatcher

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parcelforge.functions import clean, dates, html, nested, selectors, similarity, text


def column(spark, values, make, kind="string"):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, x {kind}")
    return [r[0] for r in df.select("k", make(F.col("x")).alias("y")).orderBy("k").select("y").collect()]


def test_numbers(spark):
    assert column(spark, ["", "12", "x", None, " 7 ", "1e3", "0x1f", "1_000", "1d"], clean.to_number) == [None, 12, None, None, 7, 1000, None, None, None]
    assert column(spark, ["$475萬", "@$8,684", "", None], clean.digits_to_number) == [475, 8684, None, None]
    assert column(spark, ["1,234", "x", None, ""], clean.count_from_text) == [1234, 0, 0, 0]
    assert column(spark, ["1998年", "none", "1998", None], clean.year_of) == [1998, None, 1998, None]
    assert column(spark, ["12 floors", "x 1", None], clean.first_token_integer) == [12, None, None]


def test_truth(spark):
    assert column(spark, [None, "False", "", "x"], clean.truth_of_text) == [False, True, False, True]
    assert column(spark, [None, float("nan"), 0.0, 2.0], clean.truth_of_number, "double") == [False, True, False, True]


def test_dates(spark):
    assert column(spark, ["2020-01-05", "bad", None], clean.to_date) == [datetime.date(2020, 1, 5), None, None]
    assert column(spark, [r"a\"b", 'a\\\\"b'], clean.drop_escaped_quotes) == [r"a\"b", "ab"]
    d = datetime.date
    made = spark.range(1).select(dates.safe_month_slices(F.lit("2025-02-15").cast("date"), F.lit("2025-04-13").cast("date")).alias("m")).head()[0]
    assert [tuple(x) for x in made] == [(d(2025, 4, 1), d(2025, 4, 13)), (d(2025, 3, 1), d(2025, 3, 31)), (d(2025, 2, 1), d(2025, 2, 28))]
    assert spark.range(1).select(dates.safe_month_slices(F.lit("2025-02-15").cast("date"), F.lit("2025-01-01").cast("date"))).head()[0] == []
    assert spark.range(1).select(dates.api_range(F.lit("2010-01-01").cast("date"), F.lit("2010-02-01").cast("date"))).head()[0] == "01%2F01%2F2010-01%2F02%2F2010"


def test_slugs_and_names(spark):
    assert column(spark, ["Kai Tak (East) & Co.", None], text.slug_lower_first) == ["kai-tak-east-co", None]
    assert column(spark, ["中環 st. bldg", "Sun Hse, CTR", None], text.normal_name) == ["中環 street building", "sun house center", ""]
    assert column(spark, ["1 rdx a", "12 sta b", "aver c"], text.normal_address) == ["1 road a", "12 street b", "avenue c"]
    assert column(spark, ["12-34 A"], text.digit_groups) == [["12", "34"]]
    assert column(spark, ["a/B12", "none", None], text.id_in_address) == ["B12", None, None]


def test_addresses(spark):
    rows = ["Taikoo Shing・Phase 1・Tower 2・Upper Floor・Flat A", "X・Block 1・Middle Floor・B", "X・(Block 2)・P28", "X・Tower 1・Tower 2・Flat 3", None]
    first = column(spark, rows, text.parse_address)
    assert tuple(first[0]) == ("Taikoo Shing", "Phase 1", "Tower 2", "Upper Floor", "Flat A", "Upper Floor")
    assert first[1]["Flat"] is None and first[2]["Phase"] == "(Block 2)" and first[2]["Floor"] == "P28" and first[3]["Tower/Block"] == "Tower 2"
    assert all(v is None for v in first[4])
    assert column(spark, ["A・Upper Floor 12・Flat 3", "A・Lower Floor・x Middle Floor y"], lambda c: text.parse_address(c)["Floor_Type"]) == ["Upper Floor 12", "x Middle Floor y"]
    assert column(spark, ["A・Upper Floor 12・Z", "A・・Phase 2"], lambda c: F.concat_ws("|", *(F.coalesce(text.parse_address_filling(c)[k], F.lit("-")) for k in ("Building", "Phase", "Tower/Block", "Floor", "Flat", "Floor_Type")))) == ["A|-|-|Upper Floor 12|Z|Upper Floor 12", "A|Phase 2|-|-||-"]
    second = column(spark, rows, text.parse_address_filling)
    assert second[0]["Floor_Type"] is None and second[0]["Flat"] == "Flat A" and second[1]["Flat"] == "B"


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(max_size=12), min_size=1, max_size=5))
def test_slug_of_a_slug_is_itself(spark, values):
    once = column(spark, values, text.slug)
    assert column(spark, once, text.slug) == once


def test_exploded_literals(spark):
    values = ["[{'date': '2020-01', 'p': None}, {'date': '2020-02', 'p': 3}]", "[]", None, "bad", ""]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, m string")
    out = nested.explode_literal(df, "m", {"date": "string", "p": "int"}, {"d": "date", "p": "p"}).orderBy("k", "d").collect()
    assert [tuple(r) for r in out] == [(0, "2020-01", None), (0, "2020-02", 3), (2, None, None), (3, None, None), (4, None, None)]


def test_literals_and_maps(spark):
    assert column(spark, ["{'a': None, 'b': True}", "x(", None, " "], nested.literal_to_json) == ['{"a": null, "b": true}', None, None, None]
    pairs = spark.sql("SELECT array(named_struct('key','a','value','1'), named_struct('key','b','value','2'), named_struct('key','a','value','3'), named_struct('key',CAST(NULL AS STRING),'value','4')) AS p")
    assert pairs.select(nested.last_wins(F.col("p"))).head()[0] == {"a": "3", "b": "2"}
    wide = nested.numbered_columns(spark.sql("SELECT 1 AS k, array(named_struct('type','x','name','y')) AS a"), "a", ["type", "name"], 2, "amenity")
    assert wide.columns == ["k", "amenity_1_type", "amenity_1_name", "amenity_2_type", "amenity_2_name"] and tuple(wide.head()) == (1, "x", "y", None, None)


def test_similarity():
    assert similarity.ratio("abc tower", "abd towr") == 82
    assert similarity.token_sort_of("tower abc", "ABC, tower") == 100
    assert similarity.token_set_of("sun tower", "sun tower east wing") == 100
    assert similarity.ratio("", "x") == 0 and similarity.ratio("", "") == 100


def test_scores_by_hand(spark):
    """Name 60, address 20, district 10, and 10 for a number that both addresses have; numbers of names don't count."""
    rows = [
        ("sun tower 5", "sun tower 5", "1 main", "1 main", None, "x", 90.0), ("sun tower 5", "sun tower 5", None, "1 main", "x", "X", 70.0), ("sun 5", "5 sun", "main", "main", "x", "x", 90.0),
        ("sun", "sun", "1 main", "2 main", "x", "y", 60 + 0.2 * 83), ("sun", "sun", "", "", "", "", 60.0),
    ]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string, e string, f string, s double")
    digits = (text.digit_groups(F.col("c")), text.digit_groups(F.col("d")))
    score = similarity.building_score((F.col("a"), F.col("b")), (F.col("c"), F.col("d")), (F.col("e"), F.col("f")), digits)
    assert all(r["x"] == pytest.approx(r["s"]) for r in df.select("s", score.alias("x")).collect())


def test_pages(spark):
    page = "<section><div class='col'><h5>Age</h5><span class='v'>20</span></div><div class='col'><h5>Lifts</h5><span class='v'>4</span></div></section><script>x</script>"
    assert column(spark, [page, None], lambda c: html.select_texts(c, "h5")) == [["Age", "Lifts"], []]
    assert column(spark, [page, None], lambda c: html.select_text(c, "span.v")) == ["20", ""]
    cards = "<p>\r\n<div class='c'>1<div>in</div></div>\n<div class=c>2<p>x\x0c</div></p><div class='c'>3"
    assert html.elements_of(cards, "div.c") == ["<div class='c'>1<div>in</div></div>", "<div class=c>2<p>x </div>", "<div class='c'>3"] and html.elements_of("", "div") == []
    got = column(spark, [page], lambda c: html.definition_list(c, "h5", "span.v"))[0]
    assert [tuple(x) for x in got] == [("Age", "20"), ("Lifts", "4")]
    assert column(spark, ["yes-icon", "no-icon", None], lambda c: html.icon_meaning(c, "yes", "no")) == ["Yes", "No", "Unknown"]


def test_selectors():
    page = selectors.Page("<div id=a class='x y'><p>one <b>two</b></p><br><p lang=en>three</p>four<ul><li>l1<li>l2</ul></div><p>last\u2028\nline<i>tail")
    told = lambda css: [page.text(e) for e in page.select(css)]
    assert told("p") == ["one two", "three", "last line tail"] and told("div > p") == ["one two", "three"] and told("div.x.y#a b") == ["two"]
    assert told("br + p") == ["three"] and told("p + p") == [] and told("p ~ p") == ["three"] and told("div + p, b") == ["two", "last line tail"]
    assert told("p:contains('one two')") == ["one two"] and told("div:contains('three') b") == ["two"] and told("p:-soup-contains(\"e, f\")") == [] and told("[lang=en]") == told("p[lang^='e']") == told("*[lang]") == ["three"]
    assert told("b:first-child") == ["two"] and told("p:contains(three) ~ ul") == ["l1 l2"] and page.text(page.select("p")[0], "") == "onetwo"
    assert page.markup(page.select("p")[1]) == "<p lang=en>three</p>" and page.markup(page.select("i")[0]) == "<i>tail"
    for bad in ("p >", "", "p:hover", "p,,b", "> p"):
        with pytest.raises(ValueError, match="selector"):
            selectors.compiled(bad)


def test_a_label_is_any_text_that_holds_it_and_its_value_the_next_sibling():
    cards = "<a><div>No. of Units:</div><div>12</div><div>Blocks</div><p>x</p><div>13</div><div><div>Rent</div></div><div>after</div></a>"
    found = lambda label: html.cards_of(cards, "a", {"x": f"div:contains('{label}') + div"}, {"href": "href"})[0]
    assert found("No. of Units") == ("12", None) and found("Blocks") == ("", None) and found("Rent") == ("after", None) and found("units") == ("", None)


def test_a_token_set_ratio_is_the_best_of_three():
    r = random.Random(2)
    for _ in range(3000):
        a, b = (" ".join(r.choices(["a", "b", "ab", "the", "tower", "towr", "hte"], k=r.randrange(1, 5))) for _ in range(2))
        one, two = set(a.split()), set(b.split())
        both = " ".join(sorted(one & two))
        left, right = (" ".join([both, *sorted(own)]).strip() for own in (one - two, two - one))
        pairs = [(left, right), *([(both, left), (both, right)] if both else [])]
        assert similarity.token_set_of(a, b) == max(round(100 * SequenceMatcher(None, x, y, autojunk=False).ratio()) for x, y in pairs)
