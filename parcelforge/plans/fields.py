"""Single fields: coercion, text, dates, nested values and page markup made of the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean, dates, html, nested, text
from ..operators import aggregates, columns, filters
from .register import query, spread, table

_MOMENT = "CASE s_suppkey % 5 WHEN 0 THEN '1998-03-05 10:20' WHEN 1 THEN 'bad' WHEN 2 THEN '' WHEN 3 THEN NULL ELSE '1997-12-31 23:59' END"
_LOOSE = "CASE s_suppkey % 4 WHEN 0 THEN '  a b  ' WHEN 1 THEN NULL WHEN 2 THEN 'x' || s_suppkey ELSE '' END"


@query(
    "moments_and_gaps",
    rf"""WITH t AS (SELECT s_suppkey, {_MOMENT} AS moment, {_LOOSE} AS loose, '/p/' || s_suppkey || '\\"?q=\\"' AS url FROM supplier)
    SELECT s_suppkey, try_strptime(moment, '%Y-%m-%d %H:%M') AS moment, TRY_CAST(left(moment, 10) AS DATE) AS day, coalesce(loose, '') AS filled, trim(loose) AS stripped,
      replace(url, '\\"', '') AS url, s_suppkey::VARCHAR AS id_text FROM t""",
)
def moments_and_gaps(spark, sf_dir):
    made = table(spark, sf_dir, "supplier").select("s_suppkey", F.expr(_MOMENT).alias("moment"), F.expr(_LOOSE).alias("loose"), F.concat(F.lit("/p/"), F.col("s_suppkey").cast("string"), F.lit('\\\\"?q=\\\\"')).alias("url"))
    return made.select(
        "s_suppkey", clean.to_timestamp("moment", "yyyy-MM-dd HH:mm").cast("timestamp_ntz").alias("moment"), clean.to_date(F.substring("moment", 1, 10)).alias("day"),
        clean.or_empty("loose").alias("filled"), clean.strip("loose").alias("stripped"), clean.drop_escaped_quotes("url").alias("url"), clean.id_text("s_suppkey").alias("id_text"),
    )


@query(
    "text_suite",
    r"""WITH t AS (SELECT p_partkey, p_type || ' (' || p_name || ')--' || p_size AS x, CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_brand END AS b, '/b/' || p_name || '/B' || p_partkey || '/B7' AS url,
      CASE WHEN p_size % 2 = 0 THEN '<i class="sale">' || p_size ELSE '<i>' || p_size END AS markup, p_name, p_type, p_size FROM part)
    SELECT p_partkey, regexp_replace(regexp_replace(regexp_replace(x, '\s+', '-', 'g'), '[^\w\-]', '', 'g'), '-+', '-', 'g') AS slug_words, lower(replace(p_type, ' ', '-')) AS low,
      concat_ws(', ', p_name, b) AS joined, 'https://x.example/' || lower(p_type) || '/' || regexp_replace(trim(replace(p_name, '''', '')), '\s+', '-', 'g') || '-' || p_partkey AS typed,
      nullif(regexp_extract(url, 'B\d+'), '') AS page_id, array_to_string(regexp_extract_all(x || ' 12/7', '\d+'), '|') AS digits,
      CASE WHEN contains(markup, 'class="sale"') THEN 'S' ELSE 'L' END AS tag, CASE WHEN p_size % 2 = 0 THEN p_name || ' | ' || p_type ELSE p_name END AS links, p_partkey || '_' || b AS key FROM t""",
)
def text_suite(spark, sf_dir):
    size = F.col("p_size").cast("string")
    x = F.concat("p_type", F.lit(" ("), "p_name", F.lit(")--"), size)
    b = F.when(F.col("p_size") % 3 != 0, F.col("p_brand"))
    even = F.col("p_size") % 2 == 0
    url = F.concat(F.lit("/b/"), "p_name", F.lit("/B"), F.col("p_partkey").cast("string"), F.lit("/B7"))
    markup = F.when(even, F.concat(F.lit('<i class="sale">'), size)).otherwise(F.concat(F.lit("<i>"), size))
    labels = F.when(even, F.array("p_name", "p_type", "p_brand")).otherwise(F.array("p_name"))
    return table(spark, sf_dir, "part").select(
        "p_partkey", text.slug_words(x).alias("slug_words"), text.lower_without_spaces(F.col("p_type")).alias("low"), text.join_list(F.array(F.col("p_name"), b)).alias("joined"),
        text.typed_page("https://x.example/", F.col("p_type"), F.col("p_name"), F.col("p_partkey")).alias("typed"), text.id_in_address(url).alias("page_id"),
        F.array_join(text.digit_groups(F.concat(x, F.lit(" 12/7"))), "|").alias("digits"), text.sale_or_rent(markup, 'class="sale"').alias("tag"), text.joined_links(labels).alias("links"), text.key_of(F.col("p_partkey"), b).alias("key"),
    )


@query(
    "month_gate",
    """SELECT o_orderkey, strftime(o_orderdate, '%d%%2F%m%%2F%Y') || '-31%2F12%2F1998' AS range, strftime(o_orderdate, '%Y%m') AS stamp,
      CASE WHEN o_orderkey % 7 = 0 THEN true ELSE strftime(o_orderdate, '%Y%m') <> '199503' END AS due FROM orders""",
)
def month_gate(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    last = F.when(F.col("o_orderkey") % 7 != 0, day)
    end, today = (F.lit(d).cast("date") for d in ("1998-12-31", "1995-03-20"))
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.api_range(day, end).alias("range"), dates.month_stamp(day).alias("stamp"), dates.due_this_month(last, today).alias("due"))


@query("column_suite", "SELECT n_nationkey AS key, n_name AS name, 'asia' AS zone, n_nationkey || '_asia' AS combo, '2025-03-09 01:02:03' AS LastScraped FROM nation")
def column_suite(spark, sf_dir):
    """Renamed, without a dropped column and the later one of two equal names, with context, key and time of ingestion."""
    nations = table(spark, sf_dir, "nation")
    twice = nations.select("n_nationkey", "n_name", "n_regionkey", F.lower("n_name").alias("n_name"))
    named = columns.rename(columns.keep_first_names(twice).drop("n_regionkey"), {"n_nationkey": "key", "n_name": "name", "absent": "x"})
    told = columns.with_context(named, zone="asia", combo=text.key_of(F.col("key"), F.lit("asia")))
    return columns.stamped(told, now=F.lit("2025-03-09 01:02:03").cast("timestamp"))


@query("blank_rows", "SELECT s_suppkey, x FROM (SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN '' WHEN 1 THEN '  ' WHEN 2 THEN NULL ELSE s_name END AS x FROM supplier) WHERE coalesce(trim(x), '') <> '' OR x = ''")
def blank_rows(spark, sf_dir):
    """Rows that aren't blank, and those whose text is just empty."""
    kind = F.col("s_suppkey") % 4
    made = table(spark, sf_dir, "supplier").select("s_suppkey", F.when(kind == 0, "").when(kind == 1, "  ").when(kind == 3, F.col("s_name")).alias("x"))
    return made.where(~filters.is_blank(F.col("x")) | (F.col("x") == ""))


@query("first_of_code", "SELECT p_brand, p_partkey, p_name FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_partkey) AS k FROM part) WHERE k = 1")
def first_of_code(spark, sf_dir):
    """Of the parts of each brand the first, the largest first."""
    return filters.top_of_each(table(spark, sf_dir, "part").select("p_brand", "p_partkey", "p_name", "p_size"), ["p_brand"], [F.desc("p_size"), F.col("p_partkey")]).drop("p_size")


@query(
    "best_score",
    """SELECT l_suppkey, l_extendedprice, l_orderkey * 8 + l_linenumber AS place FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey * 8 + l_linenumber) AS k
       FROM lineitem WHERE l_extendedprice >= 90000) WHERE k = 1""",
)
def best_score(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_extendedprice", (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("place"))
    return aggregates.best_of_each(rows, ["l_suppkey"], "l_extendedprice", "place", 90000)


@query("distinct_known", "SELECT DISTINCT CASE WHEN c_nationkey > 3 THEN c_nationkey END AS nation FROM customer WHERE c_nationkey > 3")
def distinct_known(spark, sf_dir):
    from ..sources.files import distinct_values

    return distinct_values(table(spark, sf_dir, "customer").select(F.when(F.col("c_nationkey") > 3, F.col("c_nationkey")).alias("nation")), "nation")


@query("label_columns", "SELECT p_partkey, p_type AS grade, CASE WHEN p_size > 20 THEN p_size::VARCHAR END AS floors FROM part")
def label_columns(spark, sf_dir):
    """Label-value pairs as columns: of equal labels the last wins, unknown and null labels are passed over."""
    pair = lambda k, v: F.struct(k.alias("key"), v.cast("string").alias("value"))
    label = F.when(F.col("p_size") > 20, "Floors")
    pairs = F.array(pair(F.lit("Grade"), F.col("p_brand")), pair(label, F.col("p_size")), pair(F.lit("Other"), F.col("p_name")), pair(F.lit("Grade"), F.col("p_type")))
    found = table(spark, sf_dir, "part").select("p_partkey", nested.last_wins(pairs).alias("m"))
    return found.select("p_partkey", F.try_element_at("m", F.lit("Grade")).alias("grade"), F.try_element_at("m", F.lit("Floors")).alias("floors"))


@query(
    "nested_suite",
    """SELECT p_partkey, p_brand AS lot_1_name, p_size AS lot_1_size, CASE WHEN p_size > 25 THEN p_type END AS lot_2_name, CASE WHEN p_size > 25 THEN p_size + 1 END AS lot_2_size,
      CASE WHEN p_size % 5 <> 0 THEN '{"a": ' || p_size || ', "b": "' || p_brand || '"}' END AS literal, CASE WHEN p_size % 5 <> 0 THEN p_size::VARCHAR ELSE '{}' END AS field,
      p_retailprice AS price, 'p' AS pricePostTypeDisplayName, p_retailprice / 2 AS avgPrice, NULL::DOUBLE AS rental, NULL::VARCHAR AS rentPostTypeDisplayName, p_size * 1.0::DOUBLE AS avgRental,
      '{"p_partkey":' || p_partkey || ',"p_brand":"' || p_brand || '"}' AS original_record, p_size % 3 = 0 AS met FROM part""",
)
def nested_suite(spark, sf_dir):
    size = F.col("p_size")
    lot = lambda name, n: F.struct(name.alias("name"), n.alias("size"))
    lots = F.when(size > 25, F.array(lot(F.col("p_brand"), size), lot(F.col("p_type"), size + 1))).otherwise(F.array(lot(F.col("p_brand"), size)))
    literal = F.when(size % 5 != 0, F.concat(F.lit(" {'a': "), size.cast("string"), F.lit(", 'b': '"), "p_brand", F.lit("'}"))).otherwise("not a literal")
    prices = F.struct(F.col("p_retailprice").alias("price"), F.lit("p").alias("pricePostTypeDisplayName"), (F.col("p_retailprice") / 2).alias("avgPrice"), F.lit(None).cast("double").alias("rental"), F.lit(None).cast("string").alias("rentPostTypeDisplayName"), size.cast("double").alias("avgRental"))
    parts = table(spark, sf_dir, "part")
    record = nested.record_json(parts.select("p_partkey", "p_brand")).select(F.col("p_partkey").alias("key"), "original_record")
    made = parts.select("p_partkey", lots.alias("lots"), nested.literal_to_json(literal).alias("literal"), nested.literal_field(literal, "a", F.lit("{}")).alias("field"), prices.alias("priceInfo"), nested.share_any(F.array(size % 3, F.lit(7)), F.array(F.lit(0), F.lit(9))).alias("met"))
    wide = nested.price_columns(nested.numbered_columns(made, "lots", ["name", "size"], 2, "lot"))
    return wide.join(record, F.col("p_partkey") == F.col("key")).drop("key")


def _parts(spark, sf_dir):
    """What pages are made of, dealt over all cores before they are read."""
    return spread(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size"))


def _pages(spark, sf_dir):
    """A page for each part: a heading, a definition list, an icon, a table, and two cards."""
    key, size = F.col("p_partkey").cast("string"), F.col("p_size").cast("string")
    big = F.col("p_size") > 25
    icon = F.when(F.col("p_size") % 3 == 0, "data:yes==").when(F.col("p_size") % 3 == 1, "data:no==").otherwise("data:else")
    card = lambda name, n: F.concat(F.lit('<div class="card"><a href="/c">'), name, F.lit("</a><div>Units</div><div>"), n, F.lit("</div><div>Empty</div><div></div></div>"))
    page = F.concat(
        F.lit("<html><body><h1 class='name'>"), F.col("p_name"), F.lit("</h1><dl><dt>Grade</dt><dd>"), F.col("p_brand"), F.lit("</dd><dt>Floors</dt><dd> "), size, F.lit(" F</dd>"),
        F.when(big, F.concat(F.lit("<dt>Grade</dt><dd>"), F.col("p_type"), F.lit("</dd>"))).otherwise(F.lit("")), F.lit("</dl><table><tr><td>"), key, F.lit("</td><td>a &amp; b</td></tr><tr><td>short</td></tr></table>"),
        card(F.col("p_name"), size), card(F.col("p_type"), F.lit("7")), F.lit("</body></html>"),
    )
    return _parts(spark, sf_dir).select("p_partkey", page.alias("html"), icon.alias("icon"), F.when(big, F.col("p_name")).otherwise("").alias("content"))


@query(
    "page_fields",
    """SELECT p_partkey, p_name AS heading, '' AS missing, CASE WHEN p_size > 25 THEN p_type ELSE p_brand END AS grade, p_size || ' F' AS floors,
      CASE p_size % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'Unknown' END AS icon, CASE WHEN p_size > 25 THEN p_name ELSE CASE p_size % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'Unknown' END END AS shown FROM part""",
)
def page_fields(spark, sf_dir):
    pages = _pages(spark, sf_dir)
    icon = html.icon_meaning(F.col("icon"), "yes", "no")
    found = pages.withColumn("f", html.fields(F.col("html"), {"heading": "h1.name", "missing": "h2"}, ("dt", "dd"))).withColumn("m", nested.last_wins(F.col("f.pairs")))
    first = lambda name: F.coalesce(F.get(f"f.{name}", 0), F.lit(""))
    return found.select("p_partkey", first("heading").alias("heading"), first("missing").alias("missing"), F.try_element_at("m", F.lit("Grade")).alias("grade"), F.try_element_at("m", F.lit("Floors")).alias("floors"), icon.alias("icon"), html.content_or_icon(F.col("content"), icon).alias("shown"))


@query("listing_cards", "SELECT p_partkey, k AS card, CASE k WHEN 0 THEN p_name ELSE p_type END AS name, CASE k WHEN 0 THEN p_size::VARCHAR ELSE '7' END AS units, '' AS empty, NULL::VARCHAR AS absent FROM part, (VALUES (0), (1)) v(k)")
def listing_cards(spark, sf_dir):
    """Each card of a listing page with its fields by label."""
    cards = _pages(spark, sf_dir).select("p_partkey", F.posexplode(html.elements(F.col("html"), "div.card")).alias("card", "markup"))
    told = cards.withColumn("c", html.card_fields(F.col("markup"), {"units": "Units", "empty": "Empty", "absent": "Absent"}, texts={"name": "a"}))
    return told.select("p_partkey", "card", "c.name", "c.units", "c.empty", "c.absent")


@query(
    "estate_cards",
    """SELECT p_name AS "Name", p_brand || 'St.' AS "Address", 'Unit Rate of Saleable Area (sq)' || p_size * 3 AS "Blocks", p_size || 'u' AS "Units", (p_size * 3)::VARCHAR AS "UnitRate", CASE WHEN p_size % 3 = 0 THEN '+1%' ELSE '' END AS "MoM",
      CASE WHEN p_size % 2 = 0 THEN p_size::VARCHAR ELSE '' END AS "ForSale", '' AS "ForRent", '/e/' || p_partkey AS "Link", p_type AS "Region", 'D' AS "District", 'S' AS "Subdistrict", p_brand AS "Code", '2025-03-09 01:02:03' AS "LastScraped" FROM part""",
)
def estate_cards(spark, sf_dir):
    """All 14 fields of the cards of listing pages: labels with further text and elements in them, label and value parted by
    another element, labels without a sibling or in other letters, and cards outside of the list."""
    size, text = F.col("p_size"), lambda x: x.cast("string")
    row = lambda label, value: F.concat(F.lit(f"<div><div>{label}</div><div> "), value, F.lit("</div></div>\n"))
    card = F.concat(
        F.lit('<a class="card" href="/e/'), text(F.col("p_partkey")), F.lit('"><div class="main-text">'), F.col("p_name"), F.lit('</div><div class="f-middle address x"> '), F.col("p_brand"), F.lit(" <b>St.</b></div>"),
        row("No. of <i>Units</i>:", F.concat(text(size), F.lit(" <b>u</b>"))), F.lit("<div><div>No. of Block(s)</div><span>5</span><div>no</div></div>"), row("Unit Rate of Saleable Area (sq)", text(size * 3)),
        F.when(size % 3 == 0, row("MoM", F.lit("+1%"))).otherwise(F.lit("<p>MoM</p><div>no</div>")), F.when(size % 2 == 0, row("For Sale", text(size))).otherwise(row("For sale", F.lit("9"))), F.lit("<div><div>For Rent</div></div><p>x</p><div>y</div></a>"),
    )
    page = F.concat(F.lit('<html><a class="card">outside</a><div class="list">'), card, F.lit('<div><a class="card">deeper</a></div></div></html>'))
    pages = _parts(spark, sf_dir).select(page.alias("html"), F.col("p_type").alias("Region"), F.lit("D").alias("District"), F.lit("S").alias("Subdistrict"), F.col("p_brand").alias("Code"))
    return html.estate_cards(pages, "html", "div.list > a.card", ["Region", "District", "Subdistrict", "Code"], F.lit("2025-03-09 01:02:03").cast("timestamp"))


@query(
    "detail_blocks",
    """SELECT p_partkey, p_brand AS grade, p_size || ' F' AS floors, CASE WHEN p_size % 2 = 0 THEN p_type END AS usage, 'first' AS twice, 'A B' AS meta, p_name AS links FROM part""",
)
def detail_blocks(spark, sf_dir):
    """Titles and values of detail pages by blocks, of both kinds of page, with lists, children and siblings in selectors."""
    block = lambda title, value: F.concat(F.lit(f'<div class="col c2"><p class="col-title"> {title} </p>'), value, F.lit("</div>"))
    text = lambda tag, x: F.concat(F.lit(f'<{tag} class="col-text">'), x, F.lit(f"</{tag}>"))
    size = F.col("p_size")
    page = F.concat(
        F.lit('<div class="col"><p class="col-title">Grade</p><p class="col-text">outside</p></div><section class="wide property-info">'),
        block("Grade", F.concat(text("div", F.lit("later")), text("p", F.col("p_brand")))), block("Floors", text("div", F.concat(size.cast("string"), F.lit("<br> <b>F</b>")))), F.when(size % 2 == 0, block("Usage", text("p", F.col("p_type")))).otherwise(block("Usage", F.lit(""))),
        F.lit('</section><section class="property-info"><div class="col"><p class="col-title">Floors</p><p class="col-text">second</p></div></section><div class="meta-info-container"><div class="title">Twice</div><div class="content">first</div><div class="content">x</div></div>'),
        F.lit('<div class="meta-info-container"><div class="content">no title</div></div><div class="meta-info-container"><div class="title">M</div><span><div class="content"> A <i>B</i></div></span></div><ul><li>x</li><li data-k="a b"><a href="/q">no</a></li><li><a href="/p">'), F.col("p_name"), F.lit("</a></li></ul>"),
    )
    pages = _parts(spark, sf_dir).select("p_partkey", page.alias("html"))
    a = ("div.col", "p.col-title", ("p.col-text", "div.col-text"), "section.property-info")
    b = ("div.meta-info-container", "div.title", ("div.content",), None)
    read = pages.select("p_partkey", html.block_lists(F.col("html"), {"a": a, "b": b}, {"links": "ul > li[data-k~=b] + li > a[href^='/p']"}).alias("f"))
    found = read.select("p_partkey", *(nested.last_wins(F.col(f"f.{n}")).alias(n) for n in "ab"), "f.links")
    at = lambda m, k: F.try_element_at(m, F.lit(k))
    return found.select("p_partkey", at("a", "Grade").alias("grade"), at("a", "Floors").alias("floors"), at("a", "Usage").alias("usage"), at("b", "Twice").alias("twice"), at("b", "M").alias("meta"), "links")


@query("page_tables", "SELECT p_partkey, p_partkey::VARCHAR AS key, 'a & b' AS both FROM part")
def page_tables(spark, sf_dir):
    from ..sources.captured import table_rows

    return table_rows(_pages(spark, sf_dir).select("p_partkey", "html"), "html", {"key": 0, "both": 1}, least=2).drop("row_html")


@query("detail_pages", "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN CASE WHEN p_size > 25 THEN p_type ELSE p_brand END END AS grade, CASE WHEN p_partkey % 2 = 0 THEN p_size || ' F' END AS floors, p_partkey || '' AS url FROM part")
def detail_pages(spark, sf_dir):
    """Every part with the fields of its detail page, of which half were captured."""
    from ..sources.captured import detail_fields

    pages = _pages(spark, sf_dir).where("p_partkey % 2 = 0").select(F.col("p_partkey").cast("string").alias("url"), "html")
    wanted = table(spark, sf_dir, "part").select("p_partkey", F.col("p_partkey").cast("string").alias("url"))
    return detail_fields(wanted, pages, "url", "html", "dt", "dd", {"Grade": "grade", "Floors": "floors"})
