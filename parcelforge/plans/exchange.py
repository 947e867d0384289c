"""Files written and read again, captured responses, and entities without scoring, over the driver's tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import resolve
from ..sources import captured, excel, files, sinks
from ..sources.shared import new_path
from .register import query, spread, table


@query("csv_files", "SELECT n_nationkey::VARCHAR AS n_nationkey, n_name, n_note FROM (SELECT *, CASE WHEN n_nationkey % 2 = 0 THEN 'a, \"b\"' END AS n_note FROM nation), (VALUES (0), (1))")
def csv_files(spark, sf_dir):
    """A table with a byte order mark written as CSV, appended to once more, and read as text."""
    rows = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", F.when(F.col("n_nationkey") % 2 == 0, 'a, "b"').alias("n_note"))
    path = new_path(spark, "csv")
    sinks.write_csv(rows, path, mark=True)
    sinks.append_csv(rows, path)
    return files.read_csv(spark, path, escape='"')


@query("converted_files", "SELECT n_nationkey::VARCHAR AS n_nationkey, n_name FROM nation")
def converted_files(spark, sf_dir):
    """CSV to Parquet, Parquet to CSV, and back again."""
    first, second, third = (new_path(spark, f"converted-{k}") for k in range(3))
    sinks.write_csv(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), first)
    sinks.csv_to_parquet(spark, first, second)
    sinks.parquet_to_csv(spark, second, third)
    return files.read_csv(spark, third)


@query("json_files", "SELECT s_suppkey, s_name, 'é' AS place, 'lines' AS kind FROM supplier UNION ALL SELECT s_suppkey, s_name, 'é', 'array' FROM supplier")
def json_files(spark, sf_dir):
    """Nested rows as JSON lines, and as arrays of one row to a line, read with a declared schema."""
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", F.struct("s_name", F.lit("é").alias("place")).alias("at"))
    schema, out = rows.schema, []
    for kind, write in (("lines", sinks.write_json), ("array", sinks.write_json_array)):
        path = new_path(spark, f"json-{kind}")
        write(rows, path)
        read = files.read_json_lines(spark, path, schema) if kind == "lines" else spark.read.schema(schema).json(path, multiLine=True)
        out.append(read.select("s_suppkey", "at.*", F.lit(kind).alias("kind")))
    return out[0].unionByName(out[1])


@query("replaced_files", "SELECT r_regionkey, r_name, 'new' AS kind FROM region UNION ALL SELECT r_regionkey, r_name, 'backup' FROM region WHERE r_regionkey < 3")
def replaced_files(spark, sf_dir):
    """A folder replaced by one that was read from it, and the backup of what it held."""
    regions, path = table(spark, sf_dir, "region").select("r_regionkey", "r_name"), new_path(spark, "replaced")
    sinks.write_parquet(regions.where("r_regionkey < 3"), path)
    both = spark.read.parquet(path).unionByName(regions.where("r_regionkey >= 3"))
    sinks.replace(both, path, backup=f"{path}-backup")
    read = lambda p, kind: files.read_parquet(spark, p, ["r_regionkey", "r_name"]).withColumn("kind", F.lit(kind))
    return read(path, "new").unionByName(read(f"{path}-backup", "backup"))


@query("resumed_files", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'first' ELSE 'second' END AS run FROM orders")
def resumed_files(spark, sf_dir):
    """Rows that a first run saved stay as they are; a second run adds those that were missing."""
    orders, path = table(spark, sf_dir, "orders").select("o_orderkey"), new_path(spark, "resumed")
    sinks.append_new(orders.where("o_orderkey % 3 = 0").withColumn("run", F.lit("first")), path, ["o_orderkey"])
    return sinks.append_new(orders.withColumn("run", F.lit("second")), path, ["o_orderkey"])


@query("latest_present", "SELECT 'latest' AS name, n_nationkey AS key FROM nation UNION ALL SELECT 'there', r_regionkey FROM region")
def latest_present(spark, sf_dir):
    """The file of a pattern that was written last, and of two sources the one that is there."""
    base = new_path(spark, "dated")
    sinks.write_parquet(table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("key")), f"{base}-1")
    sinks.write_parquet(table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("key")), f"{base}-2")
    newest = files.read_parquet(spark, files.latest(spark, f"{base}-*"))
    schema = newest.schema
    loaded = files.load_present(spark, {"there": (f"{base}-1", schema, files.read_parquet), "absent": (f"{base}-3", schema, files.read_parquet)})
    return reduce(DataFrame.unionByName, (df.select(F.lit(n).alias("name"), "key") for n, df in {"latest": newest, **loaded}.items()))


@query("lenient_files", "SELECT p_partkey, CASE WHEN p_partkey % 4 = 3 THEN NULL WHEN p_partkey % 4 = 1 THEN p_name || ', x' ELSE p_name END AS name, CASE WHEN p_partkey % 4 = 3 THEN 'bad,' || p_partkey || ',x,y,z' END AS line FROM part")
def lenient_files(spark, sf_dir):
    """Rows of a file whose lines are well formed, quoted, escaped or broken; broken ones are told by their text."""
    key = F.col("p_partkey").cast("string")
    kind = F.col("p_partkey") % 4
    line = F.when(kind == 0, F.concat_ws(",", key, "p_name")).when(kind == 1, F.concat(key, F.lit(',"'), "p_name", F.lit(', x"')))
    line = line.when(kind == 2, F.concat(key, F.lit(","), "p_name")).otherwise(F.concat(F.lit("bad,"), key, F.lit(",x,y,z")))
    path = new_path(spark, "lenient")
    # Each file begins with its header, as exports do.
    lines = table(spark, sf_dir, "part").select(line.alias("value")).repartition(3).mapInArrow(_headed, "value string")
    lines.write.text(path)
    schema = "p_partkey bigint, name string"
    good, bad = files.read_csv_leniently(spark, path, spark.createDataFrame([], schema).schema)
    told = bad.select(F.regexp_extract(files.CORRUPT, r"bad,(\d+)", 1).cast("bigint").alias("p_partkey"), F.lit(None).cast("string").alias("name"), F.col(files.CORRUPT).alias("line"))
    return good.withColumn("line", F.lit(None).cast("string")).unionByName(told)


def _headed(batches):
    import pyarrow as pa

    yield pa.RecordBatch.from_arrays([pa.array(["p_partkey,name"])], ["value"])
    yield from batches


_ITEM = "struct<v:bigint>"


def _captures(spark, sf_dir, body, pages: int = 4):
    """A capture for each supplier and page from 1; ``body(page)`` gives the response's text."""
    numbered = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("area")).withColumn("page", F.explode(F.array(*map(F.lit, range(1, pages + 1)))))
    return numbered.withColumn("body", body(F.col("page")))


def _items(values) -> Column:
    return F.to_json(F.struct(F.transform(values, lambda v: F.struct(v.alias("v"))).alias("items")))


def _two(page) -> Column:
    """The two items of an area's page, as far as it has them."""
    return F.array(F.col("area") * 10 + page, F.col("area") * 100 + page)


@query("paged_rows", "SELECT s_suppkey AS area, p AS page, k AS position, CASE k WHEN 0 THEN s_suppkey * 10 + p ELSE s_suppkey * 100 + p END AS v FROM supplier, (VALUES (1), (2), (3), (4)) a(p), (VALUES (0), (1)) b(k) WHERE CASE s_suppkey % 3 WHEN 0 THEN p < 3 WHEN 1 THEN p < 2 ELSE true END")
def paged_rows(spark, sf_dir):
    """Paging until an empty page (areas of one kind), or one that can't be read (of another)."""
    kind = F.col("area") % 3
    body = lambda page: F.when((kind == 0) & (page == 3), '{"items": []}').when((kind == 1) & (page == 2), "<html>").otherwise(_items(_two(page)))
    return captured.result_rows(_captures(spark, sf_dir, body), ["area"], "page", "body", "items", _ITEM)


@query("counted_rows", "SELECT s_suppkey AS area, p AS page, k AS position, CASE k WHEN 0 THEN s_suppkey * 10 + p ELSE s_suppkey * 100 + p END AS v FROM supplier, (VALUES (1), (2)) a(p), (VALUES (0), (1)) b(k) WHERE s_suppkey % 2 = 1")
def counted_rows(spark, sf_dir):
    """Only areas whose probed count isn't what is stored are read."""
    pages = _captures(spark, sf_dir, lambda page: _items(_two(page)), 2)
    areas = pages.select("area").distinct()
    stored = areas.withColumn("n", F.when(F.col("area") % 2 == 0, 4).otherwise(3))
    return captured.counted_rows(pages, areas.withColumn("n", F.lit(4)), stored, ["area"], "page", "body", "items", _ITEM)


@query("ranged_rows", "SELECT s_suppkey AS area, p AS page, 0 AS position, s_suppkey AS v FROM supplier, (VALUES (1), (2), (3)) a(p) WHERE s_suppkey % 2 = 0 OR p < 3")
def ranged_rows(spark, sf_dir):
    """Paging that ends also where the response's code says so."""
    code = lambda page: F.when((F.col("area") % 2 == 1) & (page == 3), 0).otherwise(1)
    body = lambda page: F.to_json(F.struct(code(page).alias("responseCode"), F.array(F.struct(F.col("area").alias("v"))).alias("items")))
    return captured.ranged_rows(_captures(spark, sf_dir, body, 3), ["area"], "page", "body", "items", _ITEM)


@query("cursor_rows", "SELECT s_suppkey AS area, p AS page, k AS position, CASE k WHEN 0 THEN s_suppkey * 10 + p ELSE s_suppkey * 100 + p END AS v FROM supplier, (VALUES (1), (2), (3)) a(p), (VALUES (0), (1)) b(k) WHERE CASE s_suppkey % 3 WHEN 0 THEN p = 1 AND k = 0 WHEN 1 THEN p < 3 ELSE true END")
def cursor_rows(spark, sf_dir):
    """Paging that ends after a short page, and once the response's count is reached."""
    kind = F.col("area") % 3

    def body(page):
        values = F.when(kind == 0, F.slice(_two(page), 1, 1)).otherwise(_two(page))
        count = F.when(kind == 1, F.lit(4))
        return F.to_json(F.struct(count.alias("count"), F.transform(values, lambda v: F.struct(v.alias("v"))).alias("items")))

    return captured.cursor_rows(_captures(spark, sf_dir, body, 3), ["area"], "page", "body", "items", _ITEM, 2)


@query(
    "month_requests",
    """SELECT (row_number() OVER (ORDER BY d DESC) - 1)::INT AS slice, d::DATE AS first, least(last_day(d::DATE), z) AS last
    FROM (SELECT z, unnest(generate_series(date_trunc('month', a)::TIMESTAMP, z::TIMESTAMP, INTERVAL 1 MONTH)) AS d FROM (SELECT min(o_orderdate)::DATE AS a, max(o_orderdate)::DATE AS z FROM orders))""",
)
def month_requests(spark, sf_dir):
    """What a source by month is asked for, for all orders' time: a slice for each month, the newest first."""
    day = F.col("o_orderdate").cast("date")
    return captured.requests_between(table(spark, sf_dir, "orders").agg(F.min(day).alias("start"), F.max(day).alias("end")), "start", "end")


@query(
    "captured_folders",
    """SELECT district, day, page, (row_number() OVER (PARTITION BY district, day, page ORDER BY v) - 1)::INT AS position, v
    FROM (SELECT s_nationkey AS district, DATE '2025-01-01' + (s_suppkey % 2)::INT AS day, (s_suppkey // 2 % 3 + 1)::INT AS page, s_suppkey AS v FROM supplier) WHERE district % 3 > 0 OR page < 3""",
)
def captured_folders(spark, sf_dir):
    """All suppliers as captured pages in folders, read in two requests of districts; some districts end at an empty page."""
    key = F.col("s_suppkey")
    rows = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").cast("int").alias("district"), F.date_add(F.lit("2025-01-01").cast("date"), (key % 2).cast("int")).alias("day"), (F.floor(key / 2) % 3 + 1).cast("int").alias("page"), F.struct(key.alias("v")).alias("item"))
    ends = (F.col("district") % 3 == 0) & (F.col("page") == 3)
    items = F.when(ends, F.array().cast("array<struct<v:bigint>>")).otherwise(F.sort_array(F.collect_list("item")))  # of one district, day and page
    pages = rows.groupBy("district", "day", "page").agg(F.to_json(F.struct(items.alias("items"))).alias("body"))
    path = new_path(spark, "captures")
    captured.save_captures(pages, path, ["district", "day"], "page", "body")
    held = captured.read_captures(spark, path, "district int, day date, page int")
    return captured.result_rows(held.where("district < 12"), ["district", "day"], "page", "body", "items", _ITEM).unionByName(captured.result_rows(held.where("district >= 12"), ["district", "day"], "page", "body", "items", _ITEM))


@query("graph_rows", "SELECT s_suppkey AS area, k AS position, s_suppkey + k AS v FROM supplier, (VALUES (0), (1)) b(k) WHERE s_suppkey % 3 <> 1 AND s_suppkey % 5 <> 0")
def graph_rows(spark, sf_dir):
    """Nested lists of query responses, one for each combination of area and kind that isn't done; errors have none."""
    area = F.col("area")
    rows = F.array(F.struct(area.alias("v")), F.struct((area + 1).alias("v")))
    body = F.when(area % 3 == 1, '{"errors": [{"message": "x"}]}').otherwise(F.to_json(F.struct(F.struct(rows.alias("records")).alias("data"))))
    areas = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("area"))
    left = captured.combinations_left(areas, spark.createDataFrame([("x",)], "kind string"), areas.where(area % 5 == 0).withColumn("kind", F.lit("x")), ["area", "kind"])
    return captured.nested_rows(left.withColumn("body", body), ["area"], "body", "data.records", _ITEM)


@query("offset_rows", "SELECT s_suppkey // 4 AS page, s_suppkey // 4 * 4 AS limitstart, s_suppkey AS v FROM supplier WHERE s_suppkey // 4 % 5 <> 2 AND s_suppkey // 4 < (SELECT max(s_suppkey) // 4 FROM supplier)")
def offset_rows(spark, sf_dir):
    """All suppliers in pages of four, up to the total that the first page tells; pages that can't be read are passed over."""
    key = F.col("s_suppkey")
    suppliers = table(spark, sf_dir, "supplier").select(F.floor(key / 4).alias("page"), F.struct(key.alias("v")).alias("item"), F.lit(1).alias("one"))
    total = table(spark, sf_dir, "supplier").agg(F.floor(F.max(key) / 4).alias("total_pages")).withColumn("one", F.lit(1))
    pages = suppliers.groupBy("page", "one").agg(F.sort_array(F.collect_list("item")).alias("items")).join(total, "one")
    body = F.when(F.col("page") % 5 == 2, "<html>").otherwise(F.to_json(F.struct("total_pages", "items")))
    return captured.offset_rows(pages.select("page", body.alias("body")), "page", "body", "total_pages", "items", _ITEM, 4)


_MATCHES = "CASE WHEN s_suppkey % 2 = 0 THEN 'm' || s_suppkey END AS midland_id, CASE WHEN s_suppkey % 3 = 0 THEN 'c' || s_suppkey END AS centanet_id"


def _entities(spark, sf_dir):
    """An entity for each supplier, with matches of two sources for some; no names are scored."""
    key = F.col("s_suppkey")
    match = lambda p: F.struct(F.concat(F.lit(p), key.cast("string")).alias("id"), F.concat(F.lit(p + "k"), key.cast("string")).alias("original_key"), (key % 20 + 80).cast("double").alias("score"), F.col("s_name").alias("building_name"), F.lit("1 Road").alias("address"), F.lit("{}").alias("original_record"))
    both = F.map_from_arrays(F.array(F.lit("midland"), F.lit("centanet")), F.array(F.when(key % 2 == 0, match("m")), F.when(key % 3 == 0, match("c"))))
    text = lambda x: F.lit(x).cast("string")
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("LH_"), key.cast("string")).alias("building_key"), F.lit("landmark").alias("source"), key.cast("string").alias("source_id"), key.cast("string").alias("original_key"),
        F.col("s_name").alias("building_name"), F.sha1("s_name").alias("normalized_name"), text("1 Road").alias("address"), text("1 road").alias("normalized_address"), text("Central").alias("district"),
        text("A").alias("grade"), (key % 40 + 1970).cast("int").alias("year_built"), F.lit(0).alias("stage"), key.alias("seq"), F.map_filter(both, lambda k, v: v.isNotNull()).alias("matches"), text("{}").alias("original_record"),
    )


@query(
    "flat_entities",
    f"""WITH e AS (SELECT *, {_MATCHES} FROM supplier), m AS (SELECT *, '"score":' || (s_suppkey % 20 + 80) || '.0,"building_name":"' || s_name || '","address":"1 Road","original_record":"{{}}"}}' AS rest FROM e)
    SELECT 'LH_' || s_suppkey AS building_key, 'landmark' AS source, s_suppkey::VARCHAR AS source_id, s_suppkey::VARCHAR AS original_key, s_name AS building_name, sha1(s_name) AS normalized_name, '1 Road' AS address,
      'Central' AS district, 'A' AS grade, (s_suppkey % 40 + 1970)::INT AS year_built,
      '{{' || concat_ws(',', '"midland":{{"id":"' || midland_id || '","original_key":"mk' || s_suppkey || '",' || CASE WHEN midland_id IS NOT NULL THEN rest END, '"centanet":{{"id":"' || centanet_id || '","original_key":"ck' || s_suppkey || '",' || CASE WHEN centanet_id IS NOT NULL THEN rest END) || '}}' AS matches_json,
      coalesce(midland_id, '') AS midland_id, CASE WHEN midland_id IS NULL THEN '' ELSE 'mk' || s_suppkey END AS midland_original_key,
      coalesce(centanet_id, '') AS centanet_id, CASE WHEN centanet_id IS NULL THEN '' ELSE 'ck' || s_suppkey END AS centanet_original_key FROM m""",
)
def flat_entities(spark, sf_dir):
    return resolve.flat_entities(_entities(spark, sf_dir))


@query("mapped_entities", "SELECT 'LH_' || s_suppkey AS building_key, s_suppkey::VARCHAR AS from_id, s_suppkey::VARCHAR AS from_key, s_name AS from_name, 'm' || s_suppkey AS to_id, 'mk' || s_suppkey AS to_key, s_name AS to_name, (s_suppkey % 20 + 80)::DOUBLE AS score FROM supplier WHERE s_suppkey % 2 = 0")
def mapped_entities(spark, sf_dir):
    return resolve.mapping(_entities(spark, sf_dir), "landmark", "midland")


@query(
    "reported_entities",
    f"""WITH e AS (SELECT *, {_MATCHES} FROM supplier), r AS (SELECT s_suppkey, s_name, 'midland' AS source FROM e WHERE midland_id IS NOT NULL UNION ALL SELECT s_suppkey, s_name, 'centanet' FROM e WHERE centanet_id IS NOT NULL
      UNION ALL SELECT s_suppkey, s_name, '' FROM e WHERE midland_id IS NULL AND centanet_id IS NULL)
    SELECT 'LH_' || s_suppkey AS building_key, s_name AS building_name, '1 Road' AS address, source AS match_source, CASE source WHEN '' THEN '' ELSE s_name END AS match_name, CASE source WHEN '' THEN '' ELSE '1 Road' END AS match_address,
      CASE source WHEN '' THEN '' ELSE (s_suppkey % 20 + 80) || '.0' END AS score FROM r""",
)
def reported_entities(spark, sf_dir):
    return resolve.eyeball_report(_entities(spark, sf_dir))


@query(
    "enriched_by_id",
    """WITH t AS (SELECT o_orderkey, s_suppkey, o_orderkey % 4 AS kind FROM orders JOIN supplier ON s_suppkey = o_orderkey % (SELECT count(*) FROM supplier))
    SELECT o_orderkey, CASE kind WHEN 0 THEN 'm' || s_suppkey WHEN 1 THEN 'none' END AS building_id, CASE WHEN kind = 2 THEN s_suppkey::VARCHAR ELSE '' END AS building_name,
      CASE WHEN kind = 0 AND s_suppkey % 2 = 0 THEN 'LH_' || s_suppkey END AS building_key, CASE WHEN kind = 0 AND s_suppkey % 2 = 0 THEN 'mk' || s_suppkey END AS original_building_id,
      CASE WHEN kind = 0 AND s_suppkey % 2 = 0 THEN 'A' END AS building_grade, CASE WHEN kind = 0 AND s_suppkey % 2 = 0 THEN (s_suppkey % 40 + 1970)::INT END AS building_year,
      CASE WHEN kind = 0 AND s_suppkey % 2 = 0 THEN (s_suppkey % 20 + 80)::DOUBLE END AS match_confidence FROM t""",
)
def enriched_by_id(spark, sf_dir):
    """Orders with the building of their id among an entity's matches; names that nothing is like find nothing."""
    suppliers = table(spark, sf_dir, "supplier")
    n = suppliers.count()
    kind, key = F.col("o_orderkey") % 4, F.col("o_orderkey") % n
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.when(kind == 0, F.concat(F.lit("m"), key.cast("string"))).when(kind == 1, "none").alias("building_id"), F.when(kind == 2, key.cast("string")).otherwise("").alias("building_name"))
    return resolve.enrich(rows, _entities(spark, sf_dir), "o_orderkey", "building_id", "building_name", "midland")


@query(
    "enriched_by_name",
    """SELECT o_orderkey, NULL::VARCHAR AS building_id, sha1(s_name) AS building_name, 'LH_' || s_suppkey AS building_key, CASE WHEN s_suppkey % 2 = 0 THEN 'mk' || s_suppkey END AS original_building_id,
      'A' AS building_grade, (s_suppkey % 40 + 1970)::INT AS building_year, 100.0::DOUBLE AS match_confidence FROM orders JOIN supplier ON s_suppkey = o_orderkey % (SELECT count(*) FROM supplier)""",
)
def enriched_by_name(spark, sf_dir):
    """Orders with the building of their name; names are digests, of which no two are alike."""
    suppliers = table(spark, sf_dir, "supplier")
    n = suppliers.count()
    rows = table(spark, sf_dir, "orders").join(suppliers, F.col("s_suppkey") == F.col("o_orderkey") % n)
    rows = rows.select("o_orderkey", F.lit(None).cast("string").alias("building_id"), F.sha1("s_name").alias("building_name"))
    return resolve.enrich(rows, _entities(spark, sf_dir), "o_orderkey", "building_id", "building_name", "midland")


@query(
    "scored_buildings",
    """WITH p AS (SELECT s_suppkey AS k, sha1(s_name) AS name, s_suppkey % 2 = 0 AS same_district, s_suppkey % 3 = 0 AS same_number FROM supplier)
    SELECT k, k AS found, (90 + CASE WHEN same_district THEN 10 ELSE 0 END)::DOUBLE AS score FROM p WHERE same_number""",
)
def scored_buildings(spark, sf_dir):
    """The best building for each name that is a digest: equal names at equal addresses reach the threshold, with or
    without their district; equal names alone don't."""
    key = F.col("s_suppkey")
    common = [F.sha1("s_name").alias("normalized_name")]
    left = table(spark, sf_dir, "supplier").select(key.alias("k"), *common, F.when(key % 3 == 0, F.concat(key.cast("string"), F.lit(" road"))).alias("normalized_address"), F.lit("Central").alias("district"))
    right = table(spark, sf_dir, "supplier").select(key.alias("found"), key.alias("seq"), *common, F.concat(key.cast("string"), F.lit(" road")).alias("normalized_address"), F.when(key % 2 == 0, "central").otherwise("Harbour").alias("district"))
    return resolve.fuzzy_best(left, right, "k", "found", "seq")


@query(
    "excel_files",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 0 THEN o_orderstatus || ' é中 <&> "' || o_orderkey % 5 END AS note, o_totalprice, o_orderdate::DATE AS day, o_orderdate::TIMESTAMP + INTERVAL 3661 SECOND AS at,
      CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey % 3 = 1 END AS odd, 9007199254740993 + o_orderkey AS big, NULL::VARCHAR AS absent FROM orders""",
)
def excel_files(spark, sf_dir):
    """Orders written as workbooks and read again, with blanks, dates, flags, long numbers and letters of all kinds."""
    key = F.col("o_orderkey")
    note = F.when(key % 5 > 0, F.concat("o_orderstatus", F.lit(' é中 <&> "'), (key % 5).cast("string")))
    at = (F.col("o_orderdate").cast("timestamp") + F.expr("INTERVAL 3661 SECOND")).alias("at")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", note.alias("note"), F.lit("unread").alias("other"), "o_totalprice", F.col("o_orderdate").cast("date").alias("day"), at, F.when(key % 3 > 0, key % 3 == 1).alias("odd"), (F.lit(9007199254740993) + key).alias("big"))
    path = new_path(spark, "workbooks")
    excel.write_excel(spread(rows), path)
    return excel.read_excel(spark, path, "o_orderkey long, note string, o_totalprice double, day date, at timestamp_ntz, odd boolean, big long, absent string", sheet=None)
