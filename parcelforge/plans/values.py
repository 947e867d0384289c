"""Coercion, text, nested values, dates and pages over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean, dates, html, nested, text
from ..sources.files import repair_csv
from .register import query, table

_NUMBER = r"'^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$'"


@query("digits_parse", "SELECT c_custkey, c_name, CAST(nullif(regexp_replace(c_name, '[^0-9]', '', 'g'), '') AS DOUBLE) AS digits FROM customer")
def digits_parse(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name", clean.digits_to_number("c_name").alias("digits"))


# Made texts of every kind that the coercions tell apart.
_MADE = """CASE s_suppkey % 10 WHEN 0 THEN '' WHEN 1 THEN ' 7 ' WHEN 2 THEN '1e3' WHEN 3 THEN '0x1f' WHEN 4 THEN '1,234' WHEN 5 THEN 'built 1998, 12 floors'
    WHEN 6 THEN 'False' WHEN 7 THEN NULL WHEN 8 THEN '12 floors' ELSE s_suppkey || '' END"""


@query(
    "coerce_suite",
    f"""WITH m AS (SELECT s_suppkey, {_MADE} AS x FROM supplier), t AS (SELECT *, trim(x) AS y FROM m)
    SELECT s_suppkey, CASE WHEN regexp_matches(y, {_NUMBER}) THEN CAST(y AS DOUBLE) END AS number, coalesce(x <> '', false) AS truth, nullif(x, '') AS text,
      coalesce(CASE WHEN regexp_matches(replace(x, ',', ''), '^[0-9]+$') THEN CAST(replace(x, ',', '') AS INT) END, 0) AS counted,
      TRY_CAST(nullif(regexp_extract(x, '[0-9]+'), '') AS INT) AS first_int,
      coalesce(CASE WHEN regexp_matches(y, '^[0-9]+$') THEN CAST(y AS INT) END, TRY_CAST(nullif(regexp_extract(x, '([0-9][0-9][0-9][0-9])', 1), '') AS INT)) AS year,
      CASE WHEN regexp_matches(string_split(y, ' ')[1], '^[0-9]+$') THEN CAST(string_split(y, ' ')[1] AS INT) END AS token_int FROM t""",
)
def coerce_suite(spark, sf_dir):
    made = table(spark, sf_dir, "supplier").select("s_suppkey", F.expr(_MADE).alias("x"))
    return made.select(
        "s_suppkey", clean.to_number("x").alias("number"), clean.truth_of_text("x").alias("truth"), clean.empty_to_null("x").alias("text"), clean.count_from_text("x").alias("counted"),
        clean.first_integer("x").alias("first_int"), clean.year_of("x").alias("year"), clean.first_token_integer("x").alias("token_int"),
    )


@query(
    "slug_urls",
    """WITH p AS (SELECT p_partkey, p_type || ' (' || p_name || ') & Co.' AS x, CASE WHEN p_size > 25 THEN p_brand END AS zone, p_name FROM part),
    s AS (SELECT *, trim(regexp_replace(x, '[^A-Za-z0-9]+', '-', 'g'), '-') AS a, trim(regexp_replace(lower(zone), '[^a-z0-9]+', '-', 'g'), '-') AS z, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-') AS n FROM p)
    SELECT p_partkey, lower(a) AS slug, regexp_replace(trim(x), '\\s+', '-', 'g') AS spaced, 'https://pages.example/' || concat_ws('-', z, n, n) || '_' || p_partkey AS url FROM s""",
)
def slug_urls(spark, sf_dir):
    x = F.concat("p_type", F.lit(" ("), "p_name", F.lit(") & Co."))
    zone = F.when(F.col("p_size") > 25, F.col("p_brand"))
    return table(spark, sf_dir, "part").select("p_partkey", text.slug(x).alias("slug"), text.slug_spaces(x).alias("spaced"), text.building_page("https://pages.example/", zone, F.col("p_name"), F.col("p_name"), F.col("p_partkey")).alias("url"))


_TOKENS = r"list_filter(string_split(regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}_]+', ' ', 'g'), ' '), lambda w: w <> '')"
_NAME_CASES = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in text.NAME_WORDS)


@query(
    "normalize_text",
    f"""WITH t AS (SELECT doc_id, {_TOKENS} AS w FROM documents)
    SELECT doc_id, array_to_string(list_transform(w, lambda x: CASE x {_NAME_CASES} ELSE x END), ' ') AS name,
      array_to_string(list_transform(w, lambda x: CASE WHEN x IN ('rd', 'st', 'ave') THEN CASE x WHEN 'rd' THEN 'road' WHEN 'st' THEN 'street' ELSE 'avenue' END
        WHEN length(x) = 3 AND x LIKE 'rd%' THEN 'road' WHEN length(x) = 3 AND x LIKE 'st%' THEN 'street' WHEN length(x) = 4 AND x LIKE 'ave%' THEN 'avenue' ELSE x END), ' ') AS address FROM t""",
)
def normalize_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.normal_name(F.col("text")).alias("name"), text.normal_address(F.col("text")).alias("address"))


# Addresses of every shape, made of a part's columns.
_ADDRESS = """CASE p_partkey % 6 WHEN 0 THEN p_name || '・Phase ' || p_size || '・Tower 2・Upper Floor 12・Flat A' WHEN 1 THEN p_name || '・Block ' || p_size || '・Middle Floor・B'
    WHEN 2 THEN p_name || '・(Block 2)・P2' || p_size WHEN 3 THEN p_name || '・Tower 1・Tower ' || p_size || '・Flat 3' WHEN 4 THEN NULL ELSE p_name || '・Lower Floor ' || p_size END"""


def _has(words: list[str]) -> str:
    return " OR ".join(f"contains(p, '{w}')" for w in words)


_KEY = "CASE " + " ".join(f"WHEN {_has(w)} THEN '{k}'" for k, w in text.ADDRESS_KEYS.items()) + " END"
_LAST = ", ".join(f"list_filter(parts[2:], lambda p: ({_KEY}) = '{k}')[-1] AS {k.lower().replace('/', '_')}" for k in text.ADDRESS_KEYS)
_FLOOR = f"list_filter(parts[2:], lambda p: {_has(text.FLOOR_TYPES)})[-1]"


@query(
    "address_parse_v1",
    f"""WITH a AS (SELECT p_partkey, {_ADDRESS} AS address FROM part), s AS (SELECT *, string_split(address, '・') AS parts FROM a)
    SELECT p_partkey, parts[1] AS building, {_LAST}, {_FLOOR} AS floor_type FROM s""",
)
def address_parse_v1(spark, sf_dir):
    return _parsed(spark, sf_dir, text.parse_address)


_ORDER = ["flat", "floor", "tower_block", "phase"]
_FILLED = ", ".join(f"CASE WHEN len(parts) = 5 THEN parts[{n + 2}] ELSE coalesce({k}, spare[1 + {' + '.join(f'({x} IS NULL)::INT' for x in _ORDER[: _ORDER.index(k)]) or 0}]) END AS {k}" for n, k in enumerate(reversed(_ORDER)))


@query(
    "address_parse_v2",
    f"""WITH a AS (SELECT p_partkey, {_ADDRESS} AS address FROM part), s AS (SELECT *, string_split(address, '・') AS parts FROM a),
    k AS (SELECT p_partkey, parts, {_LAST}, {_FLOOR} AS floor_type, list_filter(parts[2:], lambda p: ({_KEY}) IS NULL AND NOT ({_has(text.FLOOR_TYPES)})) AS spare FROM s)
    SELECT p_partkey, parts[1] AS building, {_FILLED}, CASE WHEN len(parts) = 5 THEN NULL ELSE floor_type END AS floor_type FROM k""",
)
def address_parse_v2(spark, sf_dir):
    return _parsed(spark, sf_dir, text.parse_address_filling)


def _parsed(spark, sf_dir, parse):
    rows = table(spark, sf_dir, "part").select("p_partkey", parse(F.expr(_ADDRESS)).alias("a"))
    return rows.select("p_partkey", *(F.col("a")[f].alias(f.lower().replace("/", "_")) for f in ("Building", *text.ADDRESS_KEYS, "Floor_Type")))


@query("nested_path_project", "SELECT event_id, event_type, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.a.b') AS missing FROM events")
def nested_path_project(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("p", F.struct(nested.json_path(F.col("props"), "$.k", "bigint").alias("k"), F.struct(nested.json_path(F.col("props"), "$.a.b").alias("b")).alias("a")))
    return nested.project_paths(events, {"event_id": "event_id", "event_type": "event_type", "k": "p.k", "missing": "p.a.b"})


@query(
    "explode_monthly",
    """WITH o AS (SELECT o_orderkey, o_orderkey % 5 AS kind, strftime(o_orderdate, '%Y-%m') AS m, floor(o_totalprice)::BIGINT AS v FROM orders)
    SELECT o_orderkey, m AS monthly_date, CASE WHEN k = 0 THEN v END AS monthly_avg_net_ft_price FROM o, (VALUES (0), (1)) t(k) WHERE kind IN (0, 1)
    UNION ALL SELECT o_orderkey, NULL, NULL FROM o WHERE kind IN (2, 3)""",
)
def explode_monthly(spark, sf_dir):
    kind, month, value = F.col("o_orderkey") % 5, F.date_format("o_orderdate", "yyyy-MM"), F.floor("o_totalprice").cast("string")
    two = F.concat(F.lit("[{'date': '"), month, F.lit("', 'avg_net_ft_price': "), value, F.lit("}, {'date': '"), month, F.lit("', 'avg_net_ft_price': None}]"))
    literal = F.when(kind <= 1, two).when(kind == 2, F.lit(None)).when(kind == 3, "bad").otherwise("[]")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", literal.alias("market_stat_monthly"))
    return nested.explode_literal(orders, "market_stat_monthly", {"date": "string", "avg_net_ft_price": "bigint"}, {"monthly_date": "date", "monthly_avg_net_ft_price": "avg_net_ft_price"})


@query("flatten_record", "SELECT p_partkey AS id, p_name AS location_name, p_size AS location_size_value, p_brand AS developer__0_name, p_type AS developer__1_name FROM part")
def flatten_record(spark, sf_dir):
    location = F.struct(F.col("p_name").alias("name"), F.struct(F.col("p_size").alias("value")).alias("size"))
    developer = F.array(F.struct(F.col("p_brand").alias("name")), F.struct(F.col("p_type").alias("name")))
    return nested.flatten(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), location.alias("location"), developer.alias("developer")), list_width=2)


@query("nested_loops_to_rows", "SELECT r_name, n_name, s_name FROM region JOIN nation ON n_regionkey = r_regionkey JOIN supplier ON s_nationkey = n_nationkey")
def nested_loops_to_rows(spark, sf_dir):
    # Records of a hundred suppliers of one nation at most, as a source gives its answers in pages.
    page = F.floor(F.col("s_suppkey") / 100).alias("page")
    suppliers = table(spark, sf_dir, "supplier").groupBy("s_nationkey", page).agg(F.collect_list(F.struct("s_name")).alias("sm_district"))
    nations = table(spark, sf_dir, "nation").join(suppliers, F.col("n_nationkey") == F.col("s_nationkey"))
    captured = nations.join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("r_name", F.array(F.struct("n_name", "sm_district")).alias("int_district"))
    rows = nested.nested_loops(captured, ["r_name"], [("int_district", "d"), ("d.sm_district", "s")])
    return rows.select("r_name", "d.n_name", "s.s_name")


@query(
    "month_slices",
    """WITH m AS (SELECT unnest(generate_series(DATE '1996-02-01', DATE '1997-04-01', INTERVAL 1 MONTH))::DATE AS first),
    s AS (SELECT first, least(last_day(first), DATE '1997-04-13') AS last FROM m)
    SELECT first, last, count(o_orderkey) AS orders FROM s LEFT JOIN orders ON o_orderdate::DATE BETWEEN first AND last GROUP BY ALL""",
)
def month_slices(spark, sf_dir):
    start, end = F.lit("1996-02-15").cast("date"), F.lit("1997-04-13").cast("date")
    slices = spark.range(1).select(F.explode(dates.month_slices(start, end)).alias("m")).select("m.first", "m.last")
    day = F.col("o_orderdate").cast("date")
    # By month the range is an equality, so orders are counted by month before anything is joined.
    counts = table(spark, sf_dir, "orders").where(day <= end).groupBy(F.trunc(day, "MM").alias("month")).agg(F.count("o_orderkey").alias("n"))
    return slices.join(counts, F.col("first") == F.col("month"), "left").select("first", "last", F.coalesce("n", F.lit(0)).alias("orders"))


@query("page_titles", "SELECT page_id, nullif(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '') AS title FROM pages")
def page_titles(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", html.tag_text(F.col("html"), "title").alias("title"))


@query("html_fields")
def html_fields(spark, sf_dir):
    """Elements by selector, and the page's links as titles of the paragraphs that follow them."""
    pages = table(spark, sf_dir, "pages").withColumn("f", html.fields(F.col("html"), {"heading": "h1", "items": "li", "ad": "div.ad"}, ("h1", "p")))
    first = lambda name: F.coalesce(F.get(f"f.{name}", 0), F.lit(""))
    return pages.select("page_id", first("heading").alias("heading"), F.size("f.items").alias("items"), first("ad").alias("ad"), F.to_json(nested.last_wins(F.col("f.pairs"))).alias("attributes"))


@query(
    "csv_repair",
    """WITH l AS (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_partkey || ',"' || p_name || ', x",' || p_size || ',more' WHEN 1 THEN p_partkey || '' ELSE p_partkey || ',' || p_name || ',' || p_size END AS line FROM part)
    SELECT split_part(line, ',', 1) AS a, CASE p_partkey % 3 WHEN 1 THEN '' WHEN 0 THEN regexp_extract(line, '("[^"]*")', 1) ELSE split_part(line, ',', 2) END AS b,
      CASE p_partkey % 3 WHEN 1 THEN '' WHEN 0 THEN regexp_extract(line, '",(.*)$', 1) ELSE split_part(line, ',', 3) END AS c FROM l""",
)
def csv_repair(spark, sf_dir):
    key = F.col("p_partkey").cast("string")
    long = F.concat(key, F.lit(',"'), "p_name", F.lit(', x",'), F.col("p_size").cast("string"), F.lit(",more"))
    line = F.when(F.col("p_partkey") % 3 == 0, long).when(F.col("p_partkey") % 3 == 1, key).otherwise(F.concat_ws(",", key, "p_name", F.col("p_size").cast("string")))
    return repair_csv(table(spark, sf_dir, "part").select(line.alias("value")), "a,b,c")
