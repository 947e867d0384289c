"""The name index against all pairs, at thresholds that take two, three and no characters for a key."""

import os
import random

import pytest
from pyspark.sql import functions as F

from parcelforge.functions import similarity
from parcelforge.operators import name_index, name_tiles, resolve
from parcelforge.sources.shared import shared_dir


def spelled(r, words):
    own = r.sample(words, r.randrange(1, 4)) + r.choices(["tower", "the"], k=r.randrange(2))
    text = list(" ".join(own))
    for _ in range(r.randrange(3)):
        k = r.randrange(len(text) or 1)
        text[k : k + 1] = r.choice(["", "e", "".join(text[k : k + 1] * 2), " "])
    return " ".join("".join(text).split())


@pytest.mark.parametrize("threshold", [58.4, 75, 85, 92])
def test_no_pair_is_lost(spark, threshold):
    r = random.Random(int(threshold))
    words = ["centre", "point", "kowloon", "bay", "sun", "moon", "a", "b1", "中環", "tower", "house"]
    one, two = ({*(spelled(r, words) for _ in range(90)), "a", "ab", "...", "tower tower", "the tower"} - {""} for _ in range(2))
    frame = lambda names: spark.createDataFrame([(n,) for n in sorted(names)], "name string")
    best = lambda a, b: max(similarity.token_sort_of(a, b), similarity.token_set_of(a, b))
    found = {(x["name"], x["other"]) for x in resolve.name_pairs(frame(one), frame(two), threshold).collect()}
    assert found == {(a, b) for a in one for b in two if best(a, b) >= threshold}


def test_few_of_all_pairs_meet(spark):
    """Names of real words: of four times as many pairs, about four times as many are looked at, and few."""
    r = random.Random(1)
    words = ["".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=r.randrange(4, 10))) for _ in range(3000)]
    tried = []
    for n in (300, 600):
        names = [spark.createDataFrame([(" ".join(r.sample(words, 3)),) for _ in range(n)], "name string") for _ in range(2)]
        every = [df.select("name", F.lit("all").alias("scope")).distinct() for df in names]
        tried.append(name_index.alike(*name_index.indexed(*names), *every, 85).count() / n**2)
    assert max(tried) < 0.01


def test_scopes_part_names(spark):
    frame = spark.createDataFrame([("sun tower",), ("sun towr",)], "name string")
    scope = lambda *x: spark.createDataFrame(list(x), "name string, scope string")
    a, b = name_index.indexed(frame, frame)
    found = name_index.alike(a, b, scope(("sun tower", "x"), ("sun towr", "y")), scope(("sun tower", "y"), ("sun towr", "z")), 85)
    assert found.collect() == [("sun towr", "sun tower")]
    assert name_index.candidates(a, b, scope(("sun tower", "x")), scope(("sun tower", "x")), 101).count() == 0


def test_passes_find_all_pairs_and_leave_those_alone(spark):
    r = random.Random(3)
    words = ["centre", "point", "kowloon", "bay", "sun", "moon", "tower", "house"]
    one, two = ({spelled(r, words) for _ in range(60)} for _ in range(2))
    frame = lambda names: spark.createDataFrame([(n,) for n in sorted(names)], "name string")
    best = lambda a, b: max(similarity.token_sort_of(a, b), similarity.token_set_of(a, b))
    before = set(os.listdir(shared_dir(spark)))
    found = resolve.name_pairs(frame(one), frame(two), 85, pass_pairs=len(one) * len(two) // 3)
    assert {(x["name"], x["other"]) for x in found.collect()} == {(a, b) for a in one for b in two if a and b and best(a, b) >= 85}
    left = set(os.listdir(shared_dir(spark))) - before
    assert len(left) in (3, 4) and all(x.startswith("pairs-alike") for x in left)


def test_names_that_find_themselves_look_for_their_best_alone(spark):
    r = random.Random(7)
    words = ["centre", "point", "kowloon", "bay", "sun", "moon", "tower", "house"]
    one, two = ({spelled(r, words) for _ in range(80)} | {"sun tower", "tower"} for _ in range(2))
    one |= set(r.sample(sorted(two), 30))
    frame = lambda names: spark.createDataFrame([(n,) for n in sorted(names)], "name string")
    best = lambda a, b: max(similarity.token_sort_of(a, b), similarity.token_set_of(a, b))
    found = {(x["name"], x["other"]) for x in resolve.best_name_pairs(frame(one), frame(two), 85).collect()}
    assert found == {(a, b) for a in one for b in two if best(a, b) >= (100 if a in two else 85)}


def test_digests_that_find_themselves_meet_few_others(spark):
    """Digests share most of their characters, so nearly all of their pairs meet at 85; at 100 hardly any do."""
    names = spark.range(400).select(F.sha1(F.col("id").cast("string")).alias("name"))
    every = names.select("name", F.lit("all").alias("scope"))
    a, b = name_index.indexed(names, names)
    assert name_index.alike(a, b, every, every, 100).count() < 450 and resolve.best_name_pairs(names, names, 85).count() == 400


def test_rows_of_one_class_have_one_score(spark):
    text = lambda *names: [F.lit(None).cast("string").alias(n) for n in names]
    masters = spark.range(3).select(F.col("id").alias("ID"), F.lit("m").alias("Name"), *text("Street Name", "District Name", "Grade", "Year Built"), F.col("id").alias("seq"))
    listed = spark.range(6).select(F.lit("l").alias("Building Name"), *text("Address"), F.concat(F.lit("/B"), F.col("id").cast("string")).alias("Detail URL"), F.col("id").alias("seq"))
    detailed = spark.range(0).select(F.col("id").alias("propertyID"), *text("buildingNameEn", "address", "districtNameEn", "opDateDisplayName"), F.col("id").alias("seq"))
    none = spark.createDataFrame([], "row long, building_key string, score double")
    one = lambda entities: entities.select(F.lit(1).cast("long").alias("row"), "building_key", "order", F.lit(80.0).alias("score"))
    found = resolve.consolidate(masters, listed, detailed, scores=(one, none), scored_as=(F.col("seq") % 2, F.col("seq")))
    told = {r["building_key"]: r["matches"].get("midland", {"id": None})["id"] for r in found.collect()}
    assert told == {"LH_0": "B5", "LH_1": None, "LH_2": None, "MD_B0": None, "MD_B2": None, "MD_B4": None}


@pytest.mark.parametrize("threshold", [0, 40, 85, 100, 101])
def test_a_tile_has_every_alike_pair_once(threshold):
    """Names of few letters, with tokens said twice, other letters, none, and more of them than a word or a byte holds."""
    r = random.Random(threshold)
    words = ["an", "the", "than", "inan", "enthe", "zu", "中環", "Ā", "a", "b" * 70, "thenin" * 50, "ab" * 130]
    one, two = ([" ".join(r.choices(words[: r.choice([6, 9, 12])], k=r.randrange(1, 5))) for _ in range(60)] + ["...", "!", "the the the", "sun tower east", "中"] for _ in range(2))
    one, two = sorted(set(one)), sorted(set(two))
    best = lambda a, b: max(similarity.token_sort_of(a, b), similarity.token_set_of(a, b))
    found = sorted((one[k], two[j], n) for k, j, n in name_tiles._alike(name_tiles._Block(one), name_tiles._Block(two), threshold))
    assert found == sorted((a, b, n) for a in one for b in two if (n := best(a, b)) >= threshold)
    assert not list(name_tiles._alike(name_tiles._Block([]), name_tiles._Block(two), threshold))


def test_names_of_few_letters_are_not_written_as_pairs(spark, monkeypatch):
    """An index of such names meets a share of all pairs; all that is written is names and alike pairs."""
    r, rows = random.Random(5), []
    names = lambda: spark.createDataFrame([(" ".join("".join(r.choices(["an", "the", "in", "re", "on", "er"], k=r.randrange(1, 4))) for _ in range(4)),) for _ in range(400)], "name string")
    for module in (resolve, name_index):
        monkeypatch.setattr(module, "written", lambda df, name, f=module.written: (out := f(df, name), rows.append(out.count()))[0])
    found = resolve.name_pairs(names(), names(), 85).count()
    assert 0 < found < 1000 and max(rows) <= max(400, found)


def test_blocks_meet_in_all_tiles(spark, monkeypatch):
    monkeypatch.setattr(name_tiles, "SMALL_BLOCK", 9)
    r = random.Random(11)
    words = ["centre", "point", "kowloon", "bay", "sun", "moon", "tower", "house"]
    one, two = (sorted({spelled(r, words) for _ in range(70)} - {""}) for _ in range(2))
    frame = lambda names: spark.createDataFrame([(n,) for n in names], "name string")
    best = lambda a, b: max(similarity.token_sort_of(a, b), similarity.token_set_of(a, b))
    found = name_tiles.alike(frame(one), frame(two), 85)
    assert sorted(map(tuple, found.collect())) == sorted((a, b, float(best(a, b))) for a in one for b in two if best(a, b) >= 85)
