"""Whole jobs as plain functions from frames to frames, and the named pipelines that they make up.

A job is one lazy plan between its sources and its sinks, so nothing schedules its steps but Spark.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean, nested, text
from ..operators import columns, dedupe, filters, incremental, joins, resolve
from ..sources.catalog import Catalog
from ..sources.shared import written
from ..sources.versions import Versions

# How the columns of estate details are called in listings.
DETAIL_NAMES = {"scraped_estate_name": "Name", "estate_detailed_address": "Address", "scraped_blocks": "Blocks", "developer": "Developer"}
LISTING_FIELDS = ["Address", "Blocks", "Units", "UnitRate", "ForSale", "ForRent"]


def estates(raw: DataFrame, numbers: Iterable[str] = (), flags: Iterable[str] = (), moments: dict[str, str] | None = None, urls: Iterable[str] = (), list_width: int = 3) -> DataFrame:
    """Estate records normalised: monthly statistics to rows, structs to columns, types coerced, all-null columns dropped."""
    df = raw
    if "market_stat_monthly" in df.columns:
        df = nested.explode_literal(df, "market_stat_monthly", {"date": "string", "avg_net_ft_price": "double"}, {"monthly_date": "date", "monthly_avg_net_ft_price": "avg_net_ft_price"})
    df = columns.keep_first_names(nested.flatten(df, list_width=list_width))
    here = lambda names: [c for c in names if c in df.columns]
    df = df.withColumns({c: clean.to_number(c) for c in here(numbers)} | {c: clean.truth_of_text(c) for c in here(flags)} | {c: clean.drop_escaped_quotes(c) for c in here(urls)})
    df = df.withColumns({c: clean.to_timestamp(c, f) for c, f in (moments or {}).items() if c in df.columns})
    return columns.drop_null_columns(df)


def residential_metrics(transactions: DataFrame, estate_rows: DataFrame, price: str = "price", area: str = "net_area", market: str = "market_stat_net_ft_price") -> DataFrame:
    """Transactions with their estate and price per square foot, and its difference from the market's."""
    merged = joins.left_join(filters.any_truthy(transactions), estate_rows, "estate_id", "id", ("_trans", "_estate"), null_safe=True)
    unit = F.try_divide(F.col(price), F.col(area))
    return merged.withColumn("price_per_sqft", unit).withColumn("price_variance", unit - F.col(market))


def page_transactions(rows: DataFrame, numbers: Iterable[str] = ("price", "area", "ft_price")) -> DataFrame:
    """Rows of transaction pages: empty texts null, digits as numbers, the address in its parts."""
    df = rows.withColumns({c: clean.empty_to_null(c) for c, t in rows.dtypes if t == "string"})
    df = df.withColumns({c: clean.digits_to_number(c) for c in numbers}).withColumn("__a", text.parse_address(F.col("address")))
    return df.select("*", "__a.*").drop("__a", "address")


def enriched_listings(transactions: DataFrame, details: DataFrame, order: list[str]) -> DataFrame:
    """Page transactions with the details of their building, the first of each name."""
    named = columns.rename(details, DETAIL_NAMES | {"Name": "Estate_Building"})
    named = columns.add_missing(columns.rename(named, {"Name": "Estate_Building"}), {c: "string" for c in ("Estate_Building", "Address", "Blocks", "Units", "Developer")})
    kept = named.select(*dict.fromkeys(["Estate_Building", "Address", "Blocks", "Units", "Developer", *order]))
    return joins.left_join_first(transactions, kept, "Building", "Estate_Building", order)


def listing_snapshot(existing: DataFrame, scraped: DataFrame, key: str = "Name") -> DataFrame:
    """The snapshot after a round: changed and new listings replace old ones, districts that were skipped stay."""
    return incremental.upsert(existing, incremental.changed_rows(existing, scraped, [key], LISTING_FIELDS), [key])


def commercial_transactions(raw: DataFrame, kept: list[str]) -> DataFrame:
    """The kept columns, with the six prices taken out of their struct."""
    return nested.price_columns(raw.select(*kept)) if "priceInfo" in kept else raw.select(*kept)


def commercial_resolution(catalog: Catalog, threshold: float = resolve.ENTITY_THRESHOLD) -> dict[str, DataFrame]:
    """Load the three sources, resolve entities, save them with mappings and report, enrich what transactions are there."""
    entities = resolve.consolidate(*(catalog.load(n) for n in ("masters", "listed", "detailed")), threshold)
    out = {"entities": resolve.flat_entities(entities), "report": resolve.eyeball_report(entities)}
    for a, b in (("landmark", "midland"), ("landmark", "centanet"), ("midland", "centanet")):
        out[f"map_{a}_{b}"] = resolve.mapping(entities, a, b)
    for source, id_col, name_col in (("centanet", "propertyID", "buildingNameEn"), ("midland", "building_id", "building_name")):
        if f"{source}_transactions" in catalog.datasets:
            out[f"{source}_enriched"] = resolve.enrich(catalog.load(f"{source}_transactions"), entities, "", id_col, name_col, source)
    for name, df in out.items():
        if name in catalog.datasets:
            catalog.save(name, df)
    return out


def control_date(catalog: Catalog, name: str, new: str | None = None):
    """The stored control date of a job (null at first), after storing a new one if it is given. Jobs that store theirs at
    once lose none (see ``versions``)."""
    spark, held = catalog.spark, Versions(catalog.spark, catalog.datasets["control_dates"].path)
    if new is not None:
        row = spark.createDataFrame([(name, new)], "job string, day string")
        held.update(lambda old: dedupe.keep_last(dedupe.stacked(row.limit(0) if old is None else old, row), ["job"], ["__batch"]).drop("__batch"))
    known = held.read()
    found = None if known is None else known.where(F.col("job") == name).select(F.col("day").cast("date")).head()
    return found[0] if found else None


def district_transactions(captured: DataFrame, saved: DataFrame, key: list[str]) -> DataFrame:
    """Transactions of all districts and types so far: rows of new captures join what is saved, the first of each key
    stays; columns that one side lacks are null."""
    rows = dedupe.stacked(saved, captured)
    return dedupe.keep_first(rows, key, ["__batch"]).drop("__batch")


def office_buildings(rows: DataFrame, numbers: Iterable[str], moments: dict[str, str], key: list[str], order: list[str]) -> DataFrame:
    """Building listings coerced, the last of each key."""
    df = rows.withColumns({c: clean.to_number(c) for c in numbers} | {c: clean.to_timestamp(c, f) for c, f in moments.items()})
    return dedupe.keep_last(df, key, order)


# The names of the single pipelines and of their unions.
_SINGLE: dict[str, list[Callable]] = {
    "midland_res": [estates, residential_metrics],
    "midland_ici": [district_transactions, commercial_resolution],
    "centaline_res": [listing_snapshot, page_transactions, enriched_listings],
    "centaline_oir": [office_buildings, commercial_transactions],
}
_UNIONS = {
    "centaline": ["centaline_res", "centaline_oir"], "midland": ["midland_res", "midland_ici"], "residential": ["midland_res", "centaline_res"], "commercial": ["midland_ici", "centaline_oir"],
    "__all__": ["midland_res", "midland_ici", "centaline_res", "centaline_oir"], "__default__": ["midland_res", "midland_ici", "centaline_res", "centaline_oir"],
}
PIPELINES = _SINGLE | {name: [job for own in names for job in _SINGLE[own]] for name, names in _UNIONS.items()}

#: For each job the datasets that it reads, in the order of its arguments, and the one that it writes. A dataset that a job
#: reads and writes is what it has saved so far; at first it isn't there.
WIRING: dict[Callable, tuple[tuple[str, ...], str]] = {
    estates: (("estates_raw",), "estates"),
    residential_metrics: (("transactions", "estates"), "transactions_enriched"),
    district_transactions: (("district_captures", "district_transactions"), "district_transactions"),
    listing_snapshot: (("listings", "listings_scraped"), "listings"),
    page_transactions: (("page_rows",), "page_transactions"),
    enriched_listings: (("page_transactions", "listing_details"), "page_transactions_enriched"),
    office_buildings: (("office_listings",), "office_buildings"),
    commercial_transactions: (("office_transactions_raw",), "office_transactions"),
}


def run(name: str, catalog: Catalog, parameters: dict[str, dict] | None = None) -> list[str]:
    """Run the jobs of a named pipeline one after the other, each from its datasets in the catalog to the one it writes; the
    names of what was written. ``parameters`` has further arguments by the name of a job. Each job is one lazy plan until it
    is saved, and the next reads what was saved, so a pipeline that broke off is run again from any job on."""
    if name not in PIPELINES:
        raise KeyError(f"no pipeline {name!r}; there are {', '.join(sorted(PIPELINES))}")
    given, done = parameters or {}, []
    for job in PIPELINES[name]:
        own = given.get(job.__name__, {})
        if job is commercial_resolution:
            done += [n for n in job(catalog, **own) if n in catalog.datasets]
            continue
        inputs, output = WIRING[job]
        frames = [catalog.load(n) if n != output or catalog.exists(n) else None for n in inputs]
        like = next(f for f in frames if f is not None)
        found = job(*(like.limit(0) if f is None else f for f in frames), **own)
        # What is read can't be overwritten meanwhile.
        catalog.save(output, written(found, output) if output in inputs else found)
        done.append(output)
    return done
