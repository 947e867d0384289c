"""Relational, incremental and resolution operators on literal rows, and files."""

import datetime
import json
import os
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from parcelforge.functions import similarity
from parcelforge.operators import aggregates, columns, dedupe, filters, incremental, joins, resolve
from parcelforge.sources import captured, files, sinks
from parcelforge.sources.shared import released, written
from parcelforge.streaming.snapshots import keep_snapshot


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_columns(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert columns.reindex(df, {"b": "string", "c": "double"}).columns == ["b", "c"]
    assert columns.drop_null_columns(df).columns == ["a"]
    assert columns.keep_first_names(df.toDF("x", "x")).columns == ["x"]
    assert columns.drop_null_columns(df.limit(0)).columns == []


def test_null_keys(spark):
    a = spark.createDataFrame([("a",), (None,), (None,)], "k string")
    b = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    assert rows(joins.left_join(a, b, "k", "k", null_safe=True), "k_left") == [(None, None, 2), (None, None, 2), ("a", "a", 1)]
    assert rows(joins.left_join(a, b, "k", "k"), "k_left") == [(None, None, None), (None, None, None), ("a", "a", 1)]
    assert rows(filters.in_set(a, b, ["k"]), "k") == [(None,), (None,), ("a",)] and rows(filters.not_in_set(a, b, ["k"])) == []


def test_product(spark):
    a, b = spark.createDataFrame([(1,), (2,)], "a int"), spark.createDataFrame([("x", None), ("y", 2.5)], "b string, c double")
    assert rows(joins.product(a, b), "a", "b") == [(1, "x", None), (1, "y", 2.5), (2, "x", None), (2, "y", 2.5)]
    assert rows(joins.product(a, b.limit(0))) == []
    assert joins.product(a, spark.range(2000)).count() == 4000


def test_dedupe(spark):
    df = dedupe.stacked(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), spark.createDataFrame([(2, "c"), (3, "d"), (None, "e"), (None, "f")], "k int, v string"))
    first = dedupe.keep_first(df, ["k"], ["__batch"]).drop("__batch")
    assert rows(first, "k") == [(None, "e"), (1, "a"), (2, "b"), (3, "d")]
    assert rows(dedupe.keep_first(first.withColumn("o", F.lit(0)), ["k"], ["o"]).drop("o"), "k") == rows(first, "k")
    assert rows(dedupe.keep_last(df, ["k"], ["__batch"]).drop("__batch"), "k")[2] == (2, "c")


def test_take_until_old(spark):
    d = datetime.date
    dates = [d(2025, 2, 2), None, d(2025, 1, 10), d(2024, 12, 1), d(2025, 3, 1)]
    df = spark.createDataFrame([("a", k + 1, v) for k, v in enumerate(dates)], "area string, pos int, day date")
    control = F.lit("2025-01-03").cast("date")
    assert [r[1] for r in rows(df.where(filters.since(F.col("day"), control)), "pos")] == [1, 2, 3, 5]
    assert [r[1] for r in rows(filters.take_until_old(df, ["area"], "pos", "day", control), "pos")] == [1, 3]


def test_changes(spark):
    counts = spark.createDataFrame([("a", 0), ("b", 5), ("c", 7), ("d", 3), ("e", 0)], "k string, n int")
    before = spark.createDataFrame([("a", 0), ("b", 5), ("c", 5), ("e", 5)], "k string, n int")
    found = incremental.change_status(counts, before, ["k"])
    assert [r[3] for r in rows(found, "k")] == ["ZERO", "SKIPPED", "MODIFIED", "MODIFIED", "MODIFIED"]
    assert tuple(aggregates.status_counts(found).head()) == (5, 3, 1, 1)
    old, new = spark.createDataFrame([(1, "x"), (2, None)], "k int, v string"), spark.createDataFrame([(1, "y"), (2, ""), (3, "z")], "k int, v string")
    assert rows(incremental.changed_rows(old, new, ["k"], ["v"]), "k") == [(1, "y"), (3, "z")]
    once = incremental.upsert(old, new, ["k"])
    assert rows(once, "k") == [(1, "y"), (2, ""), (3, "z")] and rows(incremental.upsert(once, new, ["k"]), "k") == rows(once, "k")


def test_best_of_each_takes_the_first_of_ties(spark):
    df = spark.createDataFrame([("a", 80.0, 2, "x"), ("a", 80.0, 1, "y"), ("b", 50.0, 1, "z")], "k string, score double, seq long, v string")
    assert rows(aggregates.best_of_each(df, ["k"], "score", "seq", 75)) == [("a", 80.0, 1, "y")]


def test_consolidate(spark):
    masters = spark.createDataFrame([(1, "Sun Tower 8", "8 Main St.", "Central", "A", "1990", 1), (2, "Moon House 3", "3 Side Rd", "Central", "B", None, 2)], "ID int, Name string, `Street Name` string, `District Name` string, Grade string, `Year Built` string, seq long")
    listed = spark.createDataFrame([("Sun Twr 8", "8 Main Street", "/b/B11", 1), ("sun tower 8", "8 main st", "/b/B12", 2), ("Far Plaza 77", "x", None, 3), (" ", "y", None, 4)], "`Building Name` string, Address string, `Detail URL` string, seq long")
    detailed = spark.createDataFrame([(5, "Far Plz 77", "x", None, "2001", 1), (6, "Lone Garden 4", None, None, None, 2)], "propertyID int, buildingNameEn string, address string, districtNameEn string, opDateDisplayName string, seq long")
    entities = resolve.consolidate(masters, listed, detailed)
    flat = {r["building_key"]: r for r in resolve.flat_entities(entities).collect()}
    assert flat["LH_1"]["midland_id"] == "B12" and flat["LH_2"]["midland_id"] == "" and "CN_6" in flat
    far = next(r for k, r in flat.items() if k.startswith("MD_"))
    assert far["centanet_id"] == "5" and len(flat) == 4
    assert resolve.mapping(entities, "landmark", "midland").count() == 1
    assert resolve.eyeball_report(entities).count() == 4
    trans = spark.createDataFrame([(1, "5", "any"), (2, None, "Moon Hse 3"), (3, None, None), (4, "99", "nothing like it")], "t int, id string, name string")
    out = {r["t"]: r for r in resolve.enrich(trans, entities, "t", "id", "name", "centanet").collect()}
    assert out[1]["building_key"] == far["building_key"] and out[2]["building_key"] == "LH_2" and out[3]["building_key"] is None and out[4]["building_key"] is None and len(out) == 4


def test_fuzzy_matches_equal_all_pairs(spark):
    """Misspelled one-word names, long names with errors in their rare words, copies, and nulls, against every pair."""
    r = random.Random(4)
    bases = ["centrepoint", "kowloon bay exchange", "sunlight tower 8", "millennium trade plaza 12", "harbour", "grand millennium plaza", "tower", "one two three"]

    def spelled(name):
        w = list(name)
        for _ in range(r.randrange(4)):
            k = r.randrange(len(w))
            w[k : k + 1] = r.choice(["", "e", w[k] * 2, " "])
        return " ".join("".join(w).split())

    def made(n):
        return [(k, spelled(r.choice(bases)), r.choice(["1 main street", "1 mian street", "8 side road", "", None]), r.choice(["Central", "central", "East", "", None])) for k in range(n)]

    one, two = [*made(50), (50, "centrepoint", "5 queens road", "Central"), (51, "", "5 queens road", "Central"), (52, "centrepoint", "5 queens road", "Central")], [*made(60), (60, "centerpoint", "5 queens road", "central"), (61, "", "5 queens road", "central"), (62, "centerpoint", "5 queens road", "central")]
    schema = "k int, normalized_name string, normalized_address string, district string"
    left, right = spark.createDataFrame(one, schema), spark.createDataFrame(two, schema).withColumnsRenamed({"k": "other"}).withColumn("seq", F.col("other") * 7 % 101)

    def score(a, b):
        digits = set(re.findall(r"\d+", a[2] or "")) & set(re.findall(r"\d+", b[2] or ""))
        name = max(similarity.token_sort_of(a[1], b[1]), similarity.token_set_of(a[1], b[1]))
        return 0.6 * name + 0.2 * (similarity.token_sort_of(a[2], b[2]) if a[2] and b[2] else 0) + 0.1 * (100 if a[3] and b[3] and a[3].lower() == b[3].lower() else 0) + 0.1 * (100 if digits else 0)

    best = {a[0]: max((round(score(a, b), 6), -(b[0] * 7 % 101), b[0]) for b in two if a[1] and b[1]) for a in one if a[1]}
    found = {x["k"]: (x["other"], round(x["score"], 6)) for x in resolve.fuzzy_best(left, right, "k", "other", "seq").collect()}
    assert found == {k: (other, s) for k, (s, _, other) in best.items() if s >= 75} and found[50][1] > 80 and found[52] == found[50] and 51 not in found
    names = lambda rows: {x[1] for x in rows if x[1]}
    near = {(a, b) for a in names(one) for b in names(two) if max(similarity.token_sort_of(a, b), similarity.token_set_of(a, b)) >= 85}
    pairs = resolve.name_pairs(left.select(F.col("normalized_name").alias("name")), right.select(F.col("normalized_name").alias("name")), 85)
    assert {(x["name"], x["other"]) for x in pairs.collect()} == near and ("centrepoint", "centerpoint") in near


def test_transactions_find_misspelled_names(spark):
    masters = spark.createDataFrame([(1, "Centrepoint", "5 Queens Road", "Central", "A", "1990", 1)], "ID int, Name string, `Street Name` string, `District Name` string, Grade string, `Year Built` string, seq long")
    none = spark.createDataFrame([], "`Building Name` string, Address string, `Detail URL` string, seq long")
    detailed = spark.createDataFrame([(5, "Centerpoint", "5 Queens Road", "central", None, 1)], "propertyID int, buildingNameEn string, address string, districtNameEn string, opDateDisplayName string, seq long")
    entities = resolve.consolidate(masters, none, detailed)
    assert [r["building_key"] for r in entities.collect()] == ["LH_1"] and resolve.mapping(entities, "landmark", "centanet").count() == 1
    trans = spark.createDataFrame([(1, None, "Centrepiont")], "t int, id string, name string")
    assert [r["building_key"] for r in resolve.enrich(trans, entities, "t", "id", "name", "centanet").collect()] == ["LH_1"]


def test_enriched_transactions_by_hand(spark):
    """Ids of entities and of their matches, names, and the original key of each case."""
    match = {"centanet": ("77", "c77", 81.5, "Moon", "x", "{}")}
    kind = "building_key string, source string, source_id string, original_key string, building_name string, normalized_name string, grade string, year_built int, stage int, seq long, matches map<string, struct<id:string, original_key:string, score:double, building_name:string, address:string, original_record:string>>"
    entities = spark.createDataFrame([("CN_1", "centanet", "5", "c5", "Sun Tower", "sun tower", "A", 1990, 0, 1, {}), ("LH_2", "landmark", "5", "l5", "Moon House", "moon house", "B", None, 0, 2, match), ("LH_3", "landmark", "9", "l9", "Far Plaza", "far plaza", None, 2001, 0, 3, {})], kind)
    trans = spark.createDataFrame([(1, "5", "x"), (2, "77", "Sun Tower"), (3, None, "Tower Sun"), (4, None, "moon hse"), (5, "9", "Far Plz"), (6, "", " "), (7, None, None)], "t int, id string, name string")
    out = {r["t"]: tuple(r)[3:] for r in resolve.enrich(trans, entities, "t", "id", "name", "centanet").collect()}
    assert out == {
        1: ("CN_1", "c5", "A", 1990, 100.0), 2: ("LH_2", "c77", "B", None, 81.5), 3: ("CN_1", "c5", "A", 1990, 100.0), 4: ("LH_2", "c77", "B", None, 100.0), 5: ("LH_3", None, None, 2001, 100.0),
        6: (None,) * 5, 7: (None,) * 5,
    }


def test_csv_repair_and_fallbacks(spark, tmp_path):
    lines = spark.createDataFrame([("a,b,c",), ('1,"x,y",3,4',), ("1",), (" ",)], "value string")
    assert sorted(rows(files.repair_csv(lines, "a,b,c"))) == [("1", "", ""), ("1", '"x,y"', "3,4")]
    (tmp_path / "x.csv").write_text("a,b\n1,x\nbad,y\n2,z\n")
    schema = spark.createDataFrame([], "a int, b string").schema
    good, bad = files.read_csv_leniently(spark, str(tmp_path / "x.csv"), schema)
    assert rows(good, "a") == [(1, "x"), (2, "z")] and rows(bad) == [("bad,y",)]
    (tmp_path / "y.txt").write_text('a,b\n1,"x\ny"\na,b\n2,z\n')
    good, bad = files.read_csv_leniently(spark, str(tmp_path / "y.txt"), schema, multi_line=True)
    assert rows(good, "a") == [(1, "x\ny"), (2, "z")] and rows(bad) == [("a,b",)]
    assert files.read_csv_leniently(spark, str(tmp_path / "none.csv"), schema)[0].count() == 0
    assert files.latest(spark, str(tmp_path / "*.csv")).endswith("x.csv") and files.latest(spark, str(tmp_path / "*.none")) is None


def test_released_tables_go_but_for_those_kept(spark):
    places = lambda df: [f.removeprefix("file://") for f in df.inputFiles()]
    with released(spark) as keep:
        first = written(spark.range(3), "first")
        with released(spark) as inner:
            second, third = written(spark.range(4), "second"), inner(written(spark.range(5), "third"))
            gone = places(second)
        assert not any(map(os.path.exists, gone)) and third.count() == 5
        gone = places(third)
        keep(first)
    assert first.count() == 3 and gone and not any(map(os.path.exists, gone))


def test_a_written_table_leaves_no_shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        held = manager.getAllFiles()
        return {f.getName() for f in (held.apply(k) for k in range(held.size())) if f.getName().startswith("shuffle")}

    before = shuffled()
    found = written(spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count().repartition(3), "counted")
    for _ in range(50):  # executors delete them on their own
        if shuffled() <= before:
            break
        time.sleep(0.1)
    assert shuffled() <= before and found.count() == 10


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "p")
    sinks.write_parquet(spark.range(5), path)
    sinks.replace(spark.read.parquet(path).where("id < 3"), path, backup=str(tmp_path / "old"))
    assert spark.read.parquet(path).count() == 3 and spark.read.parquet(str(tmp_path / "old")).count() == 5
    assert sinks.shrunk(spark, str(tmp_path / "old"), path)
    assert sinks.append_new(spark.range(4), path, ["id"]).count() == 4
    sinks.write_parquet(spark.read.parquet(path).where("id > 1"), path)
    assert spark.read.parquet(path).count() == 2 and not files.exists(spark, f"{path}.old") and not files.exists(spark, f"{path}.fresh")
    array = str(tmp_path / "j")
    sinks.write_json_array(spark.createDataFrame([(1, "é"), (2, None), (3, "x")], "a int, b string").coalesce(1), array)
    assert [json.loads(f.read_text()) for f in (tmp_path / "j").glob("part-*")] == [[{"a": 1, "b": "é"}, {"a": 2, "b": None}, {"a": 3, "b": "x"}]]
    counted, seen = aggregates.observed(spark.range(5), "rows", n=F.count(F.lit(1)))
    assert counted.count() == 5 and seen.get == {"n": 5}
    csv = str(tmp_path / "c")
    sinks.write_csv(spark.createDataFrame([("é",)], "`名` string"), csv, mark=True)
    sinks.append_csv(spark.createDataFrame([("ü",)], "`名` string"), csv)
    assert sorted(r[0] for r in files.read_csv(spark, csv).collect()) == ["é", "ü"]


def test_captured_pages(spark):
    item = "struct<id:int>"
    pages = spark.createDataFrame([("a", 1, '{"result":[{"id":1},{"id":2}]}'), ("a", 2, '{"result":[]}'), ("a", 3, '{"result":[{"id":9}]}'), ("b", 1, '{"result":[{"id":3}]}'), ("b", 2, "broken")], "district string, page int, body string")
    assert [r[3] for r in rows(captured.result_rows(pages, ["district"], "page", "body", "result", item), "district", "page", "position")] == [1, 2, 3]
    short = captured.cursor_rows(pages, ["district"], "page", "body", "result", item, 2)
    assert [r[3] for r in rows(short, "district", "page", "position")] == [1, 2, 3]
    probes, stored = (spark.createDataFrame(x, "district string, n int") for x in ([("a", 2), ("b", 1)], [("a", 2), ("b", 0)]))
    assert [r[3] for r in rows(captured.counted_rows(pages, probes, stored, ["district"], "page", "body", "result", item))] == [3]
    with pytest.raises(ValueError):
        captured.ranged_rows(pages.withColumn("body", F.lit('{"responseCode":0}')), ["district"], "page", "body", "result", item)
    table = spark.createDataFrame([("u", "<tr>" + "".join(f"<td>{k}</td>" for k in range(8)) + "</tr><tr><td>x</td></tr>")], "url string, html string")
    assert rows(captured.table_rows(table, "html", {"date": 0, "price": 3}).drop("row_html")) == [("u", "0", "3")]
    assert captured.sliced_requests(spark, "2025-02-15", "2025-04-13").count() == 3


def test_snapshot_stream(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    for k, lines in enumerate(['{"k":1,"v":"a"}\n{"k":2,"v":"b"}\n', '{"k":2,"v":"c"}\n']):
        (source / f"{k}.json").write_text(lines)
        keep_snapshot(spark, str(source), "k int, v string", target, ["k"], str(tmp_path / "check")).awaitTermination()
    assert rows(spark.read.parquet(target), "k") == [(1, "a"), (2, "c")]


def test_captures_of_other_contexts_are_not_opened(spark, tmp_path):
    path = str(tmp_path / "captures")
    rows = [(d, datetime.date(2025, 1, day), p, f'{{"items": [{{"v": {d * p}}}]}}\n  {{') for d in (1, 2) for day in (1, 2) for p in (1, 2)]
    captured.save_captures(spark.createDataFrame([*rows, (3, datetime.date(2025, 1, 1), 1, None)], "district int, day date, page int, body string"), path, ["district", "day"], "page", "body")
    held = captured.read_captures(spark, path, "district int, day date, page int")
    assert sorted(map(tuple, held.select("district", "day", "page", "body").collect())) == sorted(rows)
    asked = held.where("district = 2 AND day = DATE'2025-01-02'").where("page > 1")
    plan = asked._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :].split("]")[0]
    assert all(n in filters for n in ("district", "day", "page")) and asked.collect()[0]["body"] == rows[-1][3]
    # A file that can't be opened is no matter where it isn't asked for.
    for folder in (tmp_path / "captures").glob("district=1/*/*"):
        for f in folder.glob("*.txt"):
            f.unlink()
    assert captured.read_captures(spark, path, "district int, day date, page int").where("district = 2").count() == 4


def test_transactions_without_a_key(spark):
    """No column tells rows apart, and one can't be hashed."""
    kind = "building_key string, source string, source_id string, original_key string, building_name string, normalized_name string, grade string, year_built int, stage int, seq long, matches map<string, struct<id:string, original_key:string, score:double, building_name:string, address:string, original_record:string>>"
    entities = spark.createDataFrame([("CN_1", "centanet", "5", "c5", "Sun Tower", "sun tower", "A", 1990, 0, 1, {})], kind)
    trans = spark.createDataFrame([("5", "x", {"a": "b"}), (None, "Tower Sun", {}), (None, None, None)], "id string, name string, more map<string, string>")
    found = resolve.enrich(trans, entities, "", "id", "name", "centanet").collect()
    assert sorted((r["name"] or "", r["building_key"] or "") for r in found) == [("", ""), ("Tower Sun", "CN_1"), ("x", "CN_1")]
