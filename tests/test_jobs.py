import datetime

import pytest

from parcelforge.plans import jobs
from parcelforge.sources.catalog import Catalog, Dataset


def test_residential(spark):
    raw = spark.createDataFrame([("e1", "[{'date': '2020-01', 'avg_net_ft_price': 3}, {'date': '2020-02', 'avg_net_ft_price': None}]", ("D",), "12", None), ("e2", "[]", ("E",), "x", None)], "id string, market_stat_monthly string, district struct<name:string>, market_stat_net_ft_price string, none string")
    rows = jobs.estates(raw, numbers=["market_stat_net_ft_price"])
    assert sorted(rows.columns) == sorted(["id", "district_name", "market_stat_net_ft_price", "monthly_date", "monthly_avg_net_ft_price"]) and rows.count() == 2
    trans = spark.createDataFrame([("t1", "e1", 100.0, 5.0), ("t2", None, 1.0, 0.0), (None, "", 0.0, None)], "id string, estate_id string, price double, net_area double")
    out = {(r["id_trans"], r["monthly_date"]): r for r in jobs.residential_metrics(trans, rows).collect()}
    assert set(out) == {("t1", "2020-01"), ("t1", "2020-02"), ("t2", None)} and out[("t1", "2020-01")]["price_variance"] == 8.0 and out[("t2", None)]["price_per_sqft"] is None


def test_listings(spark):
    rows = spark.createDataFrame([("$475萬", "Sun・Tower 2・Flat A", "", "@$8,684")], "price string, address string, area string, ft_price string")
    parsed = jobs.page_transactions(rows)
    assert parsed.head()["Flat"] == "Flat A" and parsed.head()["price"] == 475 and parsed.head()["area"] is None
    details = spark.createDataFrame([("Sun", "1 Road", 2), ("Sun", "other", 3)], "scraped_estate_name string, estate_detailed_address string, seq int")
    assert jobs.enriched_listings(parsed, details, ["seq"]).head()["Address"] == "1 Road"
    kinds = "Name string, Address string, Blocks string, Units string, UnitRate string, ForSale string, ForRent string"
    old = spark.createDataFrame([("a", "1", "", "", "", "", ""), ("b", "2", "", "", "", "", "")], kinds)
    new = spark.createDataFrame([("a", "9", None, "", "", "", ""), ("c", "3", "", "", "", "", "")], kinds)
    assert sorted((r["Name"], r["Address"]) for r in jobs.listing_snapshot(old, new).collect()) == [("a", "9"), ("b", "2"), ("c", "3")]


def test_control_dates(spark, tmp_path):
    catalog = Catalog(spark, {"control_dates": Dataset("parquet", str(tmp_path / "dates"))})
    assert jobs.control_date(catalog, "x") is None
    assert jobs.control_date(catalog, "x", "2025-01-03") == datetime.date(2025, 1, 3)
    assert jobs.control_date(catalog, "x", "2025-02-03") == datetime.date(2025, 2, 3) and jobs.control_date(catalog, "y") is None


def test_commercial(spark, tmp_path):
    masters = spark.createDataFrame([(1, "Sun Tower 8", "8 Main St.", "Central", "A", "1990", 1)], "ID int, Name string, `Street Name` string, `District Name` string, Grade string, `Year Built` string, seq long")
    listed = spark.createDataFrame([("Sun Twr 8", "8 Main Street", "/b/B11", 1)], "`Building Name` string, Address string, `Detail URL` string, seq long")
    detailed = spark.createDataFrame([(5, "Moon Plz 7", "x", None, "2001", 1)], "propertyID int, buildingNameEn string, address string, districtNameEn string, opDateDisplayName string, seq long")
    trans = spark.createDataFrame([(5, "any")], "propertyID int, buildingNameEn string")
    sets = {n: Dataset("parquet", str(tmp_path / n)) for n in ("masters", "listed", "detailed", "centanet_transactions", "entities")}
    catalog = Catalog(spark, sets)
    for n, df in (("masters", masters), ("listed", listed), ("detailed", detailed), ("centanet_transactions", trans)):
        catalog.save(n, df)
    out = jobs.commercial_resolution(catalog)
    assert catalog.load("entities").count() == 2 and out["centanet_enriched"].head()["building_key"] == "CN_5" and out["map_landmark_midland"].count() == 1


def test_pipelines_are_unions_of_four(spark):
    assert len(jobs.PIPELINES) == 10 and jobs.PIPELINES["__default__"] == jobs.PIPELINES["__all__"] == [j for n in ("midland_res", "midland_ici", "centaline_res", "centaline_oir") for j in jobs.PIPELINES[n]]
    assert jobs.PIPELINES["residential"] == jobs.PIPELINES["midland_res"] + jobs.PIPELINES["centaline_res"]
    saved, new = spark.createDataFrame([(1, "old")], "id int, v string"), spark.createDataFrame([(1, "new", 2), (3, "x", None)], "id int, v string, n int")
    assert sorted(tuple(r) for r in jobs.district_transactions(new, saved, ["id"]).select("id", "v", "n").collect()) == [(1, "old", None), (3, "x", None)]
    rows = spark.createDataFrame([("a", "1,", "2020-01-02", 1), ("a", "7", "bad", 2), ("b", None, None, 1)], "k string, n string, d string, seq int")
    out = {r["k"]: r for r in jobs.office_buildings(rows, ["n"], {"d": "yyyy-MM-dd"}, ["k"], ["seq"]).collect()}
    assert out["a"]["n"] == 7 and out["a"]["d"] is None and out["b"]["n"] is None and len(out) == 2


def test_named_pipelines_end_to_end(spark, tmp_path):
    """``residential`` and ``commercial`` from saved datasets to saved datasets, the second run on top of the first."""
    text = lambda *names: ", ".join(f"`{n}` string" for n in names)
    listing = text("Name", "Address", "Blocks", "Units", "UnitRate", "ForSale", "ForRent")
    given = {
        "estates_raw": ([("e1", "[{'date': '2020-01', 'avg_net_ft_price': 3}]", ("D",), "12")], "id string, market_stat_monthly string, district struct<name:string>, market_stat_net_ft_price string"),
        "transactions": ([("t1", "e1", 100.0, 5.0)], "id string, estate_id string, price double, net_area double"),
        "listings": ([("a", "1", "", "", "", "", ""), ("b", "2", "", "", "", "", "")], listing), "listings_scraped": ([("a", "9", "", "", "", "", "")], listing),
        "page_rows": ([("$475", "Sun・Tower 2・Flat A", "7", "@$8,684")], text("price", "address", "area", "ft_price")),
        "listing_details": ([("Sun", "1 Road", 2)], "scraped_estate_name string, estate_detailed_address string, seq int"),
        "district_captures": ([(1, "new"), (3, "x")], "id int, v string"),
        "masters": ([(1, "Sun Tower 8", "8 Main St.", "Central", "A", "1990", 1)], "ID int, Name string, `Street Name` string, `District Name` string, Grade string, `Year Built` string, seq long"),
        "listed": ([("Sun Twr 8", "8 Main Street", "/b/B11", 1)], "`Building Name` string, Address string, `Detail URL` string, seq long"),
        "detailed": ([(5, "Moon Plz 7", "x", None, "2001", 1)], "propertyID int, buildingNameEn string, address string, districtNameEn string, opDateDisplayName string, seq long"),
        "office_listings": ([("a", "1,200", 1), ("a", "7", 2)], "k string, n string, seq int"),
        "office_transactions_raw": ([(1, "x", (5.0, "HKD", 1.0, None, None, None))], "id int, floor string, priceInfo struct<price:double,pricePostTypeDisplayName:string,avgPrice:double,rental:double,rentPostTypeDisplayName:string,avgRental:double>"),
    }
    out = ["estates", "transactions_enriched", "page_transactions", "page_transactions_enriched", "district_transactions", "entities", "report", "office_buildings", "office_transactions"]
    catalog = Catalog(spark, {n: Dataset("parquet", str(tmp_path / n)) for n in [*given, *out]})
    for n, (rows, kind) in given.items():
        catalog.save(n, spark.createDataFrame(rows, kind))
    parameters = {
        "estates": {"numbers": ["market_stat_net_ft_price"]}, "enriched_listings": {"order": ["seq"]}, "district_transactions": {"key": ["id"]}, "commercial_transactions": {"kept": ["id", "priceInfo"]},
        "office_buildings": {"numbers": ["n"], "moments": {}, "key": ["k"], "order": ["seq"]},
    }
    assert jobs.run("residential", catalog, parameters) == ["estates", "transactions_enriched", "listings", "page_transactions", "page_transactions_enriched"]
    assert catalog.load("transactions_enriched").head()["price_variance"] == 8.0 and catalog.load("page_transactions_enriched").head()["Address"] == "1 Road"
    assert sorted((r["Name"], r["Address"]) for r in catalog.load("listings").collect()) == [("a", "9"), ("b", "2")]
    for captured in ([], [(3, "later"), (4, "y")]):
        if captured:
            catalog.save("district_captures", spark.createDataFrame(captured, "id int, v string"))
        done = jobs.run("commercial", catalog, parameters)
    assert done == ["district_transactions", "entities", "report", "office_buildings", "office_transactions"]
    assert sorted(tuple(r) for r in catalog.load("district_transactions").collect()) == [(1, "new"), (3, "x"), (4, "y")]
    assert catalog.load("entities").count() == 2 and [r["n"] for r in catalog.load("office_buildings").collect()] == [7] and catalog.load("office_transactions").head()["price"] == 5.0
    with pytest.raises(KeyError, match="no pipeline"):
        jobs.run("absent", catalog)
