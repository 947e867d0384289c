"""Joins, filters, counts, deduplication and snapshots over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import decade
from ..operators import aggregates, columns, dedupe, filters, incremental, joins
from ..streaming.snapshots import windowed_counts
from .register import query, table


@query(
    "price_metrics",
    """SELECT l.*, p.*, CASE WHEN l_quantity = 0 THEN NULL ELSE l_extendedprice / l_quantity END AS price_per_sqft,
       CASE WHEN l_quantity = 0 THEN NULL ELSE l_extendedprice / l_quantity END - p_retailprice AS price_variance
       FROM lineitem l LEFT JOIN part p ON l.l_partkey IS NOT DISTINCT FROM p.p_partkey""",
)
def price_metrics(spark, sf_dir):
    joined = joins.left_join(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part"), "l_partkey", "p_partkey", null_safe=True)
    unit = F.try_divide("l_extendedprice", "l_quantity")
    return joined.withColumn("price_per_sqft", unit).withColumn("price_variance", unit - F.col("p_retailprice"))


@query("group_size_two_keys", "SELECT c_nationkey, c_mktsegment, count(*) AS count FROM customer WHERE c_nationkey IS NOT NULL AND c_mktsegment IS NOT NULL GROUP BY ALL")
def group_size_two_keys(spark, sf_dir):
    return aggregates.group_size(table(spark, sf_dir, "customer"), ["c_nationkey", "c_mktsegment"])


@query("group_size_one_key", "SELECT c_mktsegment, count(*) AS row_count FROM customer WHERE c_mktsegment IS NOT NULL GROUP BY ALL")
def group_size_one_key(spark, sf_dir):
    return aggregates.group_size(table(spark, sf_dir, "customer"), ["c_mktsegment"], "row_count")


@query("value_counts", "SELECT event_type, count(*) AS count FROM events WHERE event_type IS NOT NULL GROUP BY ALL ORDER BY count DESC, event_type")
def value_counts(spark, sf_dir):
    return aggregates.value_counts(table(spark, sf_dir, "events"), "event_type")


@query("report_by_decade", "SELECT (floor(year(o_orderdate) / 10) * 10)::INT AS decade, count(*) AS count FROM orders WHERE o_orderdate IS NOT NULL GROUP BY ALL ORDER BY decade")
def report_by_decade(spark, sf_dir):
    return aggregates.report_by(table(spark, sf_dir, "orders"), decade(F.year("o_orderdate")), "decade", by_count=False)


@query("report_by_category", "SELECT p_type AS category, count(*) AS count FROM part WHERE p_type IS NOT NULL GROUP BY ALL ORDER BY count DESC, category")
def report_by_category(spark, sf_dir):
    return aggregates.report_by(table(spark, sf_dir, "part"), F.col("p_type"), "category")


@query("dedupe_keep_first", "SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k FROM orders) WHERE k = 1")
def dedupe_keep_first(spark, sf_dir):
    return dedupe.keep_first(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderkey"])


@query("dedupe_keep_last", "SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey DESC) AS k FROM orders) WHERE k = 1")
def dedupe_keep_last(spark, sf_dir):
    return dedupe.keep_last(table(spark, sf_dir, "orders"), ["o_custkey", "o_orderstatus"], ["o_orderkey"])


@query("anti_not_scraped", "SELECT * FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)")
def anti_not_scraped(spark, sf_dir):
    done = table(spark, sf_dir, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return incremental.to_do(table(spark, sf_dir, "customer"), done, ["c_custkey"])


@query("semi_seen", "SELECT * FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def semi_seen(spark, sf_dir):
    return filters.in_set(table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query(
    "resume_cross_anti",
    """SELECT r.r_regionkey, s.c_mktsegment, r.r_regionkey || '_' || s.c_mktsegment AS combo
       FROM region r, (SELECT DISTINCT c_mktsegment FROM customer) s
       WHERE NOT EXISTS (SELECT 1 FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey 
         WHERE n.n_regionkey = r.r_regionkey AND c.c_mktsegment = s.c_mktsegment AND c.c_custkey <= 20)""",
)
def resume_cross_anti(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    places = customers.join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    done = places.where("c_custkey <= 20")  # what an earlier run had got through
    every = joins.product(table(spark, sf_dir, "region").select("r_regionkey"), customers.select("c_mktsegment").distinct())
    left = incremental.to_do(every, done.select(F.col("n_regionkey").alias("r_regionkey"), "c_mktsegment"), ["r_regionkey", "c_mktsegment"])
    return left.withColumn("combo", F.concat(F.col("r_regionkey").cast("string"), F.lit("_"), "c_mktsegment"))


_SPLIT = "1997-01-01"
_COUNTS = f"""WITH now AS (SELECT c_custkey % 50 AS district, count(o_orderkey) FILTER (o_orderdate >= DATE '{_SPLIT}' AND o_totalprice > 400000) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL),
    old AS (SELECT c_custkey % 50 AS district, count(o_orderkey) FILTER (o_orderdate < DATE '{_SPLIT}' AND o_totalprice > 400000) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL),
    c AS (SELECT district, coalesce(old.n, 0) AS previous, now.n AS current FROM now LEFT JOIN old USING (district)),
    s AS (SELECT *, CASE WHEN previous = 0 AND current = 0 THEN 'ZERO' WHEN previous = current THEN 'SKIPPED' ELSE 'MODIFIED' END AS status FROM c)"""


def _district_counts(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left").withColumn("district", F.col("c_custkey") % 50)
    dear = F.col("o_totalprice") > 400000
    of = lambda when: rows.groupBy("district").agg(F.count_if(F.coalesce(dear & when, F.lit(False))).alias("n"))
    old = F.col("o_orderdate") < F.lit(_SPLIT).cast("timestamp_ntz")
    return of(~old), of(old)


@query("change_status", _COUNTS + " SELECT district, previous, current, status FROM s")
def change_status(spark, sf_dir):
    now, old = _district_counts(spark, sf_dir)
    return incremental.change_status(now, old, ["district"])


@query("change_report", _COUNTS + " SELECT count(*) AS total, count(*) FILTER (status = 'MODIFIED') AS changed, count(*) FILTER (status = 'SKIPPED') AS unchanged, count(*) FILTER (status = 'ZERO') AS zero FROM s")
def change_report(spark, sf_dir):
    return aggregates.status_counts(change_status(spark, sf_dir))


@query(
    "field_change",
    """WITH new AS (SELECT p_partkey, p_name, p_brand, CASE WHEN p_size > 40 THEN p_size + 1 WHEN p_size = 3 THEN NULL ELSE p_size END AS p_size FROM part)
       SELECT n.* FROM new n LEFT JOIN part o USING (p_partkey) WHERE coalesce(n.p_size::VARCHAR, '') <> coalesce(o.p_size::VARCHAR, '') OR coalesce(n.p_name, '') <> coalesce(o.p_name, '')""",
)
def field_change(spark, sf_dir):
    old = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    new = old.withColumn("p_size", F.when(F.col("p_size") > 40, F.col("p_size") + 1).when(F.col("p_size") != 3, F.col("p_size")))
    return incremental.changed_rows(old, new, ["p_partkey"], ["p_name", "p_size"])


@query(
    "upsert_snapshot",
    f"""WITH old AS (SELECT o_custkey, o_orderkey, o_totalprice, NULL::VARCHAR AS o_note, 0 AS b FROM orders WHERE o_orderdate < DATE '{_SPLIT}'),
    new AS (SELECT o_custkey, o_orderkey, o_totalprice, NULL::VARCHAR AS o_note, 1 AS b FROM orders WHERE o_orderdate >= DATE '{_SPLIT}')
    SELECT * EXCLUDE (b, k) FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY b DESC, o_orderkey DESC) AS k FROM (SELECT * FROM old UNION ALL SELECT * FROM new)) WHERE k = 1""",
)
def upsert_snapshot(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    old = F.col("o_orderdate") < F.lit(_SPLIT).cast("timestamp_ntz")
    of = lambda when: dedupe.keep_last(orders.where(when), ["o_custkey"], ["o_orderkey"])
    kinds = {"o_custkey": "bigint", "o_orderkey": "bigint", "o_totalprice": "double", "o_note": "string"}
    return incremental.upsert(of(old), of(~old), ["o_custkey"], kinds)


@query("control_date_filter", "SELECT * FROM orders WHERE o_orderdate IS NULL OR o_orderdate >= DATE '1998-01-01'")
def control_date_filter(spark, sf_dir):
    return table(spark, sf_dir, "orders").where(filters.since(F.col("o_orderdate"), F.lit("1998-01-01").cast("timestamp_ntz")))


@query(
    "control_date_take_while",
    """SELECT * EXCLUDE (old) FROM (SELECT *, max((o_orderdate < DATE '1994-01-01')::INT) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS old FROM orders)
       WHERE coalesce(old, 0) = 0 AND o_orderdate IS NOT NULL""",
)
def control_date_take_while(spark, sf_dir):
    return filters.take_until_old(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderkey", "o_orderdate", F.lit("1994-01-01").cast("timestamp_ntz"))


@query(
    "nullsafe_left_join",
    """WITH a AS (SELECT c_custkey AS id, CASE WHEN c_nationkey < 20 THEN c_nationkey END AS estate_id, c_name AS url_desc FROM customer),
    b AS (SELECT CASE WHEN n_nationkey < 20 THEN n_nationkey END AS id, n_name AS url_desc, n_regionkey AS m FROM nation)
    SELECT a.id AS id_trans, estate_id, a.url_desc AS url_desc_trans, b.id AS id_estate, b.url_desc AS url_desc_estate, m FROM a LEFT JOIN b ON a.estate_id IS NOT DISTINCT FROM b.id""",
)
def nullsafe_left_join(spark, sf_dir):
    known = lambda c: F.when(F.col(c) < 20, F.col(c))
    a = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), known("c_nationkey").alias("estate_id"), F.col("c_name").alias("url_desc"))
    b = table(spark, sf_dir, "nation").select(known("n_nationkey").alias("id"), F.col("n_name").alias("url_desc"), F.col("n_regionkey").alias("m"))
    return joins.left_join(a, b, "estate_id", "id", ("_trans", "_estate"), null_safe=True)


@query(
    "join_first_listing",
    """WITH b AS (SELECT * EXCLUDE (k) FROM (SELECT p_type AS kind, p_partkey, p_name, row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) AS k FROM part) WHERE k = 1)
    SELECT s.p_partkey, s.p_type, s.p_name, b.kind, b.p_partkey AS p_partkey_estate, b.p_name AS p_name_estate FROM part s LEFT JOIN b ON s.p_type IS NOT DISTINCT FROM b.kind""",
)
def join_first_listing(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    return joins.left_join_first(parts.select("p_partkey", "p_type", "p_name"), parts.select(F.col("p_type").alias("kind"), "p_partkey", "p_name"), "p_type", "kind", ["p_partkey"])


@query("count_lookup", "SELECT c_custkey, coalesce(n, 0) AS n FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY ALL) ON o_custkey = c_custkey")
def count_lookup(spark, sf_dir):
    counts = aggregates.group_size(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"], "n")
    return joins.with_count(table(spark, sf_dir, "customer").select("c_custkey"), counts, "c_custkey")


@query("size_ratio_check", f"SELECT count(*) FILTER (o_orderdate < DATE '{_SPLIT}') AS old_rows, count(*) AS new_rows, count(*) / count(*) FILTER (o_orderdate < DATE '{_SPLIT}') AS ratio, count(*) / count(*) FILTER (o_orderdate < DATE '{_SPLIT}') < 0.9 AS too_small FROM orders")
def size_ratio_check(spark, sf_dir):
    counts = table(spark, sf_dir, "orders").agg(F.count_if(F.col("o_orderdate") < F.lit(_SPLIT).cast("timestamp_ntz")).alias("old_rows"), F.count(F.lit(1)).alias("new_rows"))
    return counts.withColumn("c", incremental.size_check(F.col("old_rows"), F.col("new_rows"))).select("old_rows", "new_rows", "c.*")


@query("drop_null_columns", "SELECT p_partkey, p_name, CASE WHEN p_size > 30 THEN p_size END AS some FROM part")
def drop_null_columns(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", F.when(F.col("p_size") > 30, F.col("p_size")).alias("some"), F.lit(None).cast("string").alias("none"))
    return columns.drop_null_columns(parts)


@query("filter_not_constant", "SELECT * FROM nation WHERE n_nationkey IS DISTINCT FROM 0")
def filter_not_constant(spark, sf_dir):
    return table(spark, sf_dir, "nation").where(filters.differs_from(F.col("n_nationkey"), 0))


@query("any_truthy", "SELECT p_size, note FROM (SELECT CASE WHEN p_size > 10 THEN p_size ELSE 0 END AS p_size, CASE WHEN p_size < 5 THEN p_name ELSE '' END AS note FROM part) WHERE p_size <> 0 OR note <> ''")
def any_truthy(spark, sf_dir):
    size, name = F.col("p_size"), F.col("p_name")
    return filters.any_truthy(table(spark, sf_dir, "part").select(F.when(size > 10, size).otherwise(0).alias("p_size"), F.when(size < 5, name).otherwise("").alias("note")))


@query("first_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def first_rows(spark, sf_dir):
    return filters.first_rows(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.col("o_orderkey")], 10)


@query("windowed_counts", "SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL")
def windowed_event_counts(spark, sf_dir):
    found = windowed_counts(table(spark, sf_dir, "events"))
    return found.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query(
    "dedupe_with_maps",
    """WITH t AS (SELECT l_partkey, l_orderkey, l_linenumber, l_returnflag, l_quantity, l_tax FROM lineitem),
    r AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_returnflag, l_orderkey, l_quantity, l_tax, l_linenumber) AS first, row_number() OVER (PARTITION BY l_partkey ORDER BY l_returnflag DESC, l_orderkey DESC, l_quantity DESC, l_tax DESC, l_linenumber DESC) AS last FROM t)
    SELECT l_partkey, 'first' AS kept, l_orderkey, l_quantity AS qty, l_tax AS tax, l_linenumber FROM r WHERE first = 1 UNION ALL SELECT l_partkey, 'last', l_orderkey, l_quantity, l_tax, l_linenumber FROM r WHERE last = 1""",
)
def dedupe_with_maps(spark, sf_dir):
    """First and last line of each part where a column is a map: ties of the order go by the map's sorted entries."""
    entries = F.create_map(F.lit("tax"), F.col("l_tax").cast("double"), F.lit("qty"), F.col("l_quantity").cast("double"))
    rows = table(spark, sf_dir, "lineitem").select("l_partkey", "l_returnflag", "l_orderkey", entries.alias("facts"), "l_linenumber")
    order = ["l_returnflag"]
    both = [pick(rows, ["l_partkey"], order).withColumn("kept", F.lit(name)) for name, pick in (("first", dedupe.keep_first), ("last", dedupe.keep_last))]
    return both[0].unionByName(both[1]).select("l_partkey", "kept", "l_orderkey", F.col("facts")["qty"].alias("qty"), F.col("facts")["tax"].alias("tax"), "l_linenumber")
