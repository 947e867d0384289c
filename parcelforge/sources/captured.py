"""Captured responses in place of live requests: one row for each response, with the rules by which paging ends.

A capture has the request's context (district, month slice ...), its page number and the response's body as text; a folder of
captures is read with just those contexts that are asked for.
Live crawling, browsers, sessions and their retries aren't part of this library; Spark retries failed tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import safe_month_slices
from ..functions.html import definition_list, select_texts
from ..operators.filters import not_in_set
from ..operators.incremental import change_status
from ..operators.joins import product


def save_captures(pages: DataFrame, path: str, context: list[str], page: str, body: str, mode: str = "append") -> None:
    """Responses as text files, in a folder for each context and page (``district=3/day=2025-01-02/page=1``)."""
    dealt = pages.select(F.col(body).alias("value"), *context, page).where(F.col("value").isNotNull()).repartition(*context, page)
    dealt.write.mode(mode).partitionBy(*context, page).text(path)


def read_captures(spark: SparkSession, path: str, context: str, body: str = "body") -> DataFrame:
    """``body`` and the columns of ``context`` (``district int, day date, page int``) of the responses in such folders, however they came
    there. Filters of the context are settled by the folders' names: what isn't asked for isn't opened."""
    held = spark.read.schema(f"value string, {context}").text(path, wholetext=True)
    whole = F.when(F.endswith("value", F.lit("\n")), F.left("value", F.char_length("value") - 1)).otherwise(F.col("value"))  # files end their last line
    return held.withColumn("value", whole).withColumnRenamed("value", body)


def until_stop(pages: DataFrame, context: list[str], page: str, stops: Column) -> DataFrame:
    """Pages of each context before the first one that stops it. That page is aggregated and joined back."""
    first = pages.where(F.coalesce(stops, F.lit(True))).groupBy(*context).agg(F.min(page).alias("__stop"))
    names = {c: f"__{c}" for c in context}
    met = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()))
    joined = pages.join(first.withColumnsRenamed(names), met, "left")
    return joined.where(F.col("__stop").isNull() | (F.col(page) < F.col("__stop"))).drop("__stop", *names.values())


def result_rows(pages: DataFrame, context: list[str], page: str, body: str, items: str, schema: str) -> DataFrame:
    """Rows of the list at ``items`` (a name) in every body, until a page of a context has none; a body that can't be
    read ends its context too, and the rows so far stay. The context columns go with each row."""
    parsed = pages.withColumn("__items", F.from_json(body, f"struct<`{items}`:array<{schema}>>")[items])
    kept = until_stop(parsed, context, page, F.coalesce(F.size("__items"), F.lit(0)) <= 0)
    return kept.select(*context, page, F.posexplode("__items").alias("position", "item")).select(*context, page, "position", "item.*")


def counted_rows(pages: DataFrame, probes: DataFrame, stored: DataFrame, context: list[str], page: str, body: str, items: str, schema: str) -> DataFrame:
    """As ``result_rows``, for contexts alone whose probed count ``n`` isn't what is stored."""
    open_now = change_status(probes, stored, context).where("previous <> current").select(*context)
    met = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"__{c}")) for c in context))
    wanted = pages.join(open_now.withColumnsRenamed({c: f"__{c}" for c in context}), met, "left_semi")
    return result_rows(wanted, context, page, body, items, schema)


def ranged_rows(pages: DataFrame, context: list[str], page: str, body: str, items: str, schema: str, code: str = "responseCode") -> DataFrame:
    """As ``result_rows``, ending also where the response code isn't 1. Without any row at all it raises ValueError."""
    bad = F.get_json_object(body, f"$.{code}").try_cast("int") != 1
    rows = result_rows(until_stop(pages, context, page, bad), context, page, body, items, schema)
    if rows.isEmpty():
        raise ValueError("no rows in any captured page")
    return rows


def sliced_requests(spark: SparkSession, start: str, end: str) -> DataFrame:
    """A row for each month slice, the newest first: what a source by month asks for."""
    return requests_between(spark.range(1).select(F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end")), "start", "end")


def requests_between(bounds: DataFrame, start: str, end: str) -> DataFrame:
    """The same for each row of bounds, two columns of dates."""
    return bounds.select(F.posexplode(safe_month_slices(F.col(start), F.col(end))).alias("slice", "m")).select("slice", "m.first", "m.last")


def cursor_rows(pages: DataFrame, context: list[str], page: str, body: str, items: str, schema: str, limit: int) -> DataFrame:
    """Cursor paging: ends at an empty page, after a short one, and once the response's count is reached."""
    parsed = pages.withColumn("__n", F.coalesce(F.size(F.from_json(body, f"struct<`{items}`:array<{schema}>>")[items]), F.lit(0)))
    full = parsed.withColumn("__last", (F.col("__n") < limit) | (F.col(page) * limit >= F.coalesce(F.get_json_object(body, "$.count").try_cast("long"), F.lit((1 << 62) - 1))))
    after = full.where("__last").groupBy(*context).agg((F.min(page) + 1).alias("__end"))
    names = {c: f"__{c}" for c in context}
    met = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()))
    kept = full.join(after.withColumnsRenamed(names), met, "left").where(F.col("__end").isNull() | (F.col(page) < F.col("__end")))
    return result_rows(kept.drop("__n", "__last", "__end", *names.values()), context, page, body, items, schema)


def combinations_left(districts: DataFrame, kinds: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    """Every district and type that isn't done."""
    return not_in_set(product(districts, kinds), done, key)


def nested_rows(pages: DataFrame, context: list[str], body: str, path: str, schema: str) -> DataFrame:
    """Rows of the list that stands at a path of names (``data.records``) in every body; a body without it has none."""
    kind = f"array<{schema}>"
    for name in reversed(path.split(".")):
        kind = f"struct<`{name}`:{kind}>"
    items = reduce(lambda value, name: value[name], path.split("."), F.from_json(body, kind))
    return pages.select(*context, F.posexplode(items).alias("position", "item")).select(*context, "position", "item.*")


def offset_requests(spark: SparkSession, total_pages: int, limit: int) -> DataFrame:
    """``page, limitstart`` for each page of a source that is read by offset."""
    return spark.range(total_pages).select(F.col("id").alias("page"), (F.col("id") * limit).alias("limitstart"))


def offset_rows(pages: DataFrame, page: str, body: str, total: str, items: str, schema: str, limit: int) -> DataFrame:
    """Rows of every captured page below the total that page 0 tells; bodies that can't be read are passed over. Without
    a first page, or a total in it, there are none."""
    total_pages = F.get_json_object(body, f"$.{total}").try_cast("bigint")
    known = pages.where(F.col(page) == 0).agg(F.max(total_pages).alias("__pages")).withColumn("__one", F.lit(1))  # one row
    asked = pages.withColumn("__one", F.lit(1)).join(F.broadcast(known), "__one").where((F.col(page) >= 0) & (F.col(page) < F.col("__pages")))
    read = asked.withColumns({"__items": F.from_json(body, f"struct<`{items}`:array<{schema}>>")[items], "limitstart": F.col(page) * limit})
    return read.select(page, "limitstart", F.explode("__items").alias("item")).select(page, "limitstart", "item.*")


def table_rows(pages: DataFrame, html: str, fields: dict[str, int], least: int = 8, row_css: str = "tr", cell_css: str = "td") -> DataFrame:
    """Fields by cell number of every row with at least ``least`` cells; markup of cells is cut before texts are taken."""
    rows = pages.withColumn("__row", F.explode(F.regexp_extract_all(html, F.lit(rf"(?is)<{row_css}\b[^>]*>(.*?)</{row_css}>"), F.lit(1))))
    cells = rows.withColumn("__cells", select_texts(F.col("__row"), cell_css)).where(F.size("__cells") >= least)
    return cells.select(*(c for c in pages.columns if c != html), *(F.get("__cells", k).alias(n) for n, k in fields.items()), F.col("__row").alias("row_html"))


def detail_fields(wanted: DataFrame, pages: DataFrame, url: str, html: str, title: str, value: str, labels: dict[str, str] | None = None) -> DataFrame:
    """Rows with the title-value pairs of their captured detail page: as a map, or as one column for each label. Pages are read
    where they lie, before they are joined: the join moves pairs, not markup, and doesn't say how many tasks read."""
    from ..functions.nested import last_wins

    held = pages.select(F.col(url).alias("__url"), definition_list(F.col(html), title, value).alias("__pairs"))
    none = F.array().cast("array<struct<key:string,value:string>>")
    found = wanted.join(held, F.col(url) == F.col("__url"), "left").withColumn("attributes", last_wins(F.coalesce("__pairs", none))).drop("__url", "__pairs")
    return found if labels is None else found.withColumns({n: F.try_element_at("attributes", F.lit(label)) for label, n in labels.items()}).drop("attributes")
