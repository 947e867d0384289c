"""One entity for each building out of three sources, mappings, reports, and transactions enriched with entities.

A score of the threshold needs names of some ratio: the less, the more of district and address numbers agree. For each of
these cases an inverted index over the distinct names (``name_index``) gives the pairs that can have that ratio, so none is
lost; each pair of names is scored once, and rows are put together by their names and scored whole. Rows of one
normalised name, address and district form one candidate, the first, so copies don't multiply pairs. A row whose
normalised name is empty matches nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import or_empty, year_of
from ..functions.similarity import ENTITY_THRESHOLD, NAME_THRESHOLD, WEIGHTS, name_ratio, parts, score_of, sort_bound, token_sort_ratio
from ..functions.text import digit_groups, id_in_address, normal_address, normal_name
from ..sources.shared import released, written
from . import name_tiles
from .aggregates import best_of_each
from .name_index import SLACK, candidates, indexed

#: The score from which a row that has found its own name looks for names as near alone.
HIGH = 90
#: Names on the left of one pass of ``name_pairs``, and pairs of names.
PASS_NAMES, PASS_PAIRS = 1 << 20, 1 << 40
#: Over how many keys of a join rows without one are dealt.
DEALT = 1024
ENTITY = ["building_key", "source", "source_id", "original_key", "building_name", "normalized_name", "address", "normalized_address", "district", "grade", "year_built"]


def _names_alike(left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """``name, other, ratio`` for the pairs of names of two sides (``name, district, digits``) that can be those of rows whose
    score is ``threshold`` or more."""
    c, w = F.col, WEIGHTS
    scoped = lambda rows, scope: rows.select("name", scope.alias("scope")).where("scope IS NOT NULL").distinct()
    district = F.when(c("district") != "", F.concat(F.lit("d:"), F.lower("district")))
    number = lambda rows: rows.withColumn("number", F.explode_outer("digits"))
    by_number = F.concat(F.lit("n:"), c("number"))
    # What the name's ratio has to be at least, where so much of the score may come from elsewhere.
    least = lambda *given: (threshold - 100 * (w["address"] + sum(w[g] for g in given))) / w["name"]
    a, b = indexed(left, right)
    cases = [
        (least(), lambda rows: scoped(rows, F.lit("all"))),
        (least("district"), lambda rows: scoped(rows, district)),
        (least("digits"), lambda rows: scoped(number(rows), by_number)),
        (least("district", "digits"), lambda rows: scoped(number(rows), F.concat(by_number, F.lit(" "), district))),
    ]
    found = reduce(DataFrame.unionByName, (candidates(a, b, scope(left), scope(right), n) for n, scope in cases))
    return written(found.distinct().select("name", "other", name_ratio("name", "other").alias("ratio")), "names-alike")


def fuzzy_best(left: DataFrame, right: DataFrame, left_key: str, right_key: str, right_order: str, threshold: float = ENTITY_THRESHOLD) -> DataFrame:
    """For each left row the right row of the greatest score of at least ``threshold`` (ties: the first by
    ``right_order``): ``left_key, right_key, score``. Both sides have normalised names and addresses and a district, and
    the ``address`` as it was (without it, digits are taken from the normalised one)."""
    fields = ["normalized_name", "normalized_address", "district", "digits"]
    c = F.col

    def numbered(rows: DataFrame) -> DataFrame:
        return rows.withColumn("digits", F.array_sort(F.array_distinct(digit_groups(c("address" if "address" in rows.columns else "normalized_address")))))

    side = lambda rows, p: rows.withColumn("address", parts("normalized_address")).select(*(c(x).alias(f"{p}_{x}") for x in (*fields, "address")), *(x for x in rows.columns if x not in fields))
    left, right = numbered(left), numbered(right)
    # What a row can reach at most, by what it has: below the threshold it matches nothing.
    reach = score_of(F.lit(100), F.when(F.coalesce(c("normalized_address") != "", F.lit(False)), 100).otherwise(0), F.coalesce(c("district") != "", F.lit(False)), F.coalesce(F.size("digits") > 0, F.lit(False)))
    named = lambda df: df.where((c("normalized_name") != "") & (reach >= F.lit(threshold - SLACK)))
    a = written(side(named(left).select(*fields).distinct(), "l"), "left-side")
    first = F.max(F.struct((-c(right_order)).alias("order"), c(right_key))).alias("first")
    b = written(side(named(right).groupBy(*fields).agg(first).select(*fields, "first"), "r"), "right-side")
    whole = lambda rows, p: rows.select(*(c(f"{p}_{x}").alias(n) for x, n in (("normalized_name", "name"), ("district", "district"), ("digits", "digits"))))
    others = b.withColumnRenamed("r_normalized_name", "other")
    same_district = F.coalesce((F.lower("l_district") == F.lower("r_district")) & (c("l_district") != ""), F.lit(False))
    shared = F.coalesce(F.arrays_overlap("l_digits", "r_digits"), F.lit(False))
    filled = F.coalesce((c("l_normalized_address") != "") & (c("r_normalized_address") != ""), F.lit(False))
    bound = score_of(c("ratio"), F.when(filled, F.least(sort_bound(c("l_address"), c("r_address")), F.lit(100.0))).otherwise(0.0), same_district, shared)
    score = score_of(c("ratio"), F.when(filled, token_sort_ratio("l_normalized_address", "r_normalized_address")).otherwise(0), same_district, shared)
    own = [f"l_{x}" for x in fields]

    def best_of(met: DataFrame, least: float) -> DataFrame:
        """The best right row of each left row, among pairs that have met, with the ``ratio`` of their names."""
        scored = met.where(bound >= F.lit(least - SLACK)).select(*own, score.alias("score"), c(f"first.{right_key}").alias(right_key), (-c("first.order")).alias(right_order))
        return best_of_each(scored, own, "score", right_order, least)

    # Rows that score high with a row of their own name can only be beaten by as high a score: few names are as near.
    high = max(HIGH, threshold)
    sure = written(best_of(a.join(others, c("l_normalized_name") == c("other")).withColumn("ratio", F.lit(100)), high).select(*(c(x).alias(f"s_{x}") for x in own)), "sure")
    is_own = reduce(lambda x, y: x & y, (c(x).eqNullSafe(c(f"s_{x}")) for x in own))
    parts_of = [(a.join(sure, is_own, "left_semi"), high), (a.join(sure, is_own, "left_anti"), threshold)]
    asked = [(written(whole(rows, "l"), "asked"), least) for rows, least in parts_of]
    found = [_names_alike(rows, whole(b, "r"), least) for rows, least in asked if not rows.isEmpty()]
    if not found:
        return left.select(left_key).join(right.select(right_key), F.lit(False)).withColumn("score", F.lit(0.0))
    alike = reduce(DataFrame.unionByName, found).distinct()
    best = best_of(a.join(alike.withColumnRenamed("name", "l_normalized_name"), "l_normalized_name").join(others, "other"), threshold)
    same = reduce(lambda x, y: x & y, (c(x).eqNullSafe(c(f"l_{x}")) for x in fields))
    return left.select(left_key, *fields).join(best.withColumnRenamed(right_key, "__right"), same).select(left_key, c("__right").alias(right_key), "score")


def name_pairs(left: DataFrame, right: DataFrame, threshold: float, pass_names: int = PASS_NAMES, pass_pairs: int = PASS_PAIRS) -> DataFrame:
    """``name, other, confidence``: all pairs of the distinct names (``name``) of two tables that are alike enough.

    Every name is set against every other in tiles (``name_tiles``), which leave nothing but alike pairs. Names cross the network
    once for each block of the other side, so the left is dealt to passes of ``pass_names`` names and ``pass_pairs`` of all
    pairs, and what a pass has dealt is deleted at its end. No pair is left out."""
    # Empty names go afterwards: a condition would be pushed down to the texts, where each name is made again for it.
    distinct = lambda df, to: written(df.select("name").distinct(), to).where("name <> ''")
    with released(left.sparkSession) as keep:
        mine, theirs = distinct(left, "names-left"), distinct(right, "names-right")
        n = mine.count()
        passes = max(1, -(-n // pass_names), -(-n * theirs.count() // pass_pairs))
        own = lambda k: mine.where(F.pmod(F.xxhash64("name"), F.lit(passes)) == k)
        found = [keep(written(name_tiles.alike(own(k), theirs, threshold), "pairs-alike")) for k in range(passes)]
    return reduce(DataFrame.unionByName, found)


def best_name_pairs(left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """Of the pairs of ``name_pairs`` all that can be the best of a name on the left: of a name that stands on the right as it
    is, only those of 100."""
    every = lambda df: df.select("name", F.lit("all").alias("scope")).where("name <> ''").distinct()
    a, b = indexed(left, right)
    mine, theirs = every(left), written(every(right), "names-right")
    own = theirs.select("name")
    parts_of = [(mine.join(own, "name", "left_semi"), 100), (mine.join(own, "name", "left_anti"), threshold)]
    asked = [(written(scope, "names-asked"), least) for scope, least in parts_of]
    near = [candidates(a, b, scope, theirs, least) for scope, least in asked if not scope.isEmpty()] or [candidates(a, b, mine, theirs, 101)]
    found = reduce(DataFrame.unionByName, near)
    return found.select("name", "other", name_ratio("name", "other").cast("double").alias("confidence")).where(F.col("confidence") >= threshold)


def _entity(df: DataFrame, prefix: str, source: str, source_id: Column, name: Column, address: Column, district: Column, grade: Column, year: Column, seq: str) -> DataFrame:
    own = F.coalesce(F.nullif(source_id.cast("string"), F.lit("")), F.xxhash64(or_empty(name)).cast("string"))
    return df.select(
        F.concat(F.lit(prefix), own).alias("building_key"), F.lit(source).alias("source"), source_id.cast("string").alias("source_id"), own.alias("original_key"), name.alias("building_name"),
        normal_name(name).alias("normalized_name"), address.alias("address"), normal_address(address).alias("normalized_address"), district.alias("district"), grade.alias("grade"), year.alias("year_built"),
        F.col(seq).alias("seq"), F.to_json(F.struct(*df.columns)).alias("original_record"),
    )


def _once(entities: DataFrame) -> DataFrame:
    """Of one key the last row's values at the first row's place."""
    last = F.max(F.struct("seq", F.struct(*(c for c in entities.columns if c != "seq")).alias("row"))).alias("last")
    return entities.groupBy("building_key").agg(F.min("seq").alias("seq"), last).select("seq", "last.row.*")


def best_scored(scores: DataFrame, entities: DataFrame, threshold: float) -> DataFrame:
    """``row, building_key, score``: for each row of a table of scores (``row, building_key, score``) the entity of the greatest
    score of at least ``threshold``, of ties the first; entities that aren't there are passed over. Scores that were made of the
    entities that are there have their ``order`` already."""
    told = scores.where(F.col("score") >= threshold)
    known = told if "order" in scores.columns else told.join(entities.select("building_key", "order"), "building_key")
    return best_of_each(known.select("row", "score", "order", "building_key"), ["row"], "score", "order", threshold).select("row", "building_key", "score")


def consolidate(masters: DataFrame, listed: DataFrame, detailed: DataFrame, threshold: float = ENTITY_THRESHOLD, scores: tuple | None = None, scored_as: tuple[Column, Column] | None = None) -> DataFrame:
    """Entities with ``matches``: map of source to ``struct(id, original_key, score, building_name, address, original_record)``.

    ``masters``: ID, Name, Street Name, District Name, Grade, Year Built. ``listed``: Building Name, Address, Detail URL.
    ``detailed``: propertyID, buildingNameEn, address, districtNameEn, opDateDisplayName. Each has ``seq``. Listed
    buildings are matched against the masters, detailed ones against masters and unmatched listed ones. What finds no
    entity becomes one. Of several that find the same entity the last by ``seq`` stands in ``matches``. ``scores`` are those of
    listed and of detailed rows (``row``, their ``seq``, ``building_key, score``) where they are known already: two tables, or two
    functions that make them of the entities that are there (``building_key, place, order``; the table then has ``order`` too).
    ``scored_as`` are columns by which rows stand in them in place of ``seq``, where many rows have the same scores.
    """
    c = F.col
    null = F.lit(None).cast("string")
    lh = _once(_entity(masters, "LH_", "landmark", c("ID"), c("Name"), c("Street Name"), c("District Name"), c("Grade"), year_of(c("Year Built")), "seq"))
    md = _entity(listed, "MD_", "midland", id_in_address(c("Detail URL")), c("Building Name"), c("Address"), null, null, F.lit(None).cast("int"), "seq")
    cn = _entity(detailed, "CN_", "centanet", c("propertyID"), c("buildingNameEn"), c("address"), c("districtNameEn"), null, year_of(c("opDateDisplayName")), "seq")
    named = lambda df: df.where(F.trim(or_empty(c("building_name"))) != "").withColumnsRenamed({"building_key": "own_key"})
    md, cn = named(md), named(cn)
    base = lh.withColumn("stage", F.lit(0))

    def matched(rows: DataFrame, entities: DataFrame, k: int) -> DataFrame:
        place = entities.select("building_key", F.struct("stage", "seq").alias("place"), "normalized_name", "normalized_address", "address", "district")
        ordered = place.withColumn("order", c("place.stage") * F.lit(1 << 40) + c("place.seq"))
        if scores is not None:
            known = scores[k](ordered) if callable(scores[k]) else scores[k]
            keyed = rows.select("seq", (scored_as[k] if scored_as else c("seq")).alias("row"))
            best = best_scored(known.join(keyed.select("row").distinct(), "row", "left_semi"), ordered, threshold)
            return written(keyed.join(best, "row").select(c("seq").alias("row"), "building_key", "score"), "matched")
        return written(fuzzy_best(rows.withColumn("row", c("seq")), ordered, "row", "building_key", "order", threshold), "matched")

    def fresh(rows: DataFrame, found: DataFrame, stage: int) -> DataFrame:
        left = rows.join(found.select(c("row").alias("seq")), "seq", "left_anti").withColumnsRenamed({"own_key": "building_key"})
        return _once(left).withColumn("stage", F.lit(stage))

    found_md = matched(md, base, 0)
    with_md = written(base.unionByName(fresh(md, found_md, 1)), "entities")
    found_cn = matched(cn, with_md, 1)
    entities = with_md.unionByName(fresh(cn, found_cn, 2))

    def latest(rows: DataFrame, found: DataFrame, source: str) -> DataFrame:
        joined = found.join(rows.withColumnRenamed("seq", "row"), "row")
        value = F.struct(c("source_id").alias("id"), "original_key", c("score").cast("double").alias("score"), "building_name", "address", "original_record")
        return joined.groupBy("building_key").agg(F.max(F.struct("row", value.alias("match")))["match"].alias(source))

    out = entities.join(latest(md, found_md, "midland"), "building_key", "left").join(latest(cn, found_cn, "centanet"), "building_key", "left")
    both = F.map_from_arrays(F.array(F.lit("midland"), F.lit("centanet")), F.array("midland", "centanet"))
    matches = F.map_filter(both, lambda k, v: v.isNotNull())
    return written(out.select(*ENTITY, "stage", "seq", matches.alias("matches"), "original_record"), "consolidated")


def flat_entities(entities: DataFrame) -> DataFrame:
    """Entities for saving: matches as JSON, the matched ids and keys as columns (``''`` where there is none)."""
    at = lambda s, f: F.coalesce(F.try_element_at("matches", F.lit(s))[f], F.lit(""))
    columns = {f"{s}_{n}": at(s, f) for s in ("midland", "centanet") for n, f in (("id", "id"), ("original_key", "original_key"))}
    return entities.withColumns({"matches_json": F.to_json("matches"), **columns}).drop("matches", "original_record", "normalized_address", "stage", "seq")


def mapping(entities: DataFrame, source: str, target: str) -> DataFrame:
    """Entities of one source that a row of another was matched to."""
    m = F.try_element_at("matches", F.lit(target))
    return entities.where((F.col("source") == source) & m.isNotNull()).select(
        F.col("building_key"), F.col("source_id").alias("from_id"), F.col("original_key").alias("from_key"), F.col("building_name").alias("from_name"),
        m["id"].alias("to_id"), m["original_key"].alias("to_key"), m["building_name"].alias("to_name"), m["score"].alias("score"),
    )


def eyeball_report(entities: DataFrame) -> DataFrame:
    """A row for each match, and one for each entity without any, all fields as text."""
    rows = entities.select("building_key", "building_name", "address", F.explode_outer("matches").alias("match_source", "m"))
    return rows.select("building_key", *(or_empty(F.col(c)).alias(c) for c in ("building_name", "address", "match_source")), or_empty(F.col("m.building_name")).alias("match_name"), or_empty(F.col("m.address")).alias("match_address"), or_empty(F.col("m.score")).alias("score"))


def enrich(transactions: DataFrame, entities: DataFrame, key: str, id_col: str, name_col: str, source: str, threshold: int = NAME_THRESHOLD) -> DataFrame:
    """Transactions with building_key, original_building_id, building_grade, building_year, match_confidence.

    First by id: an entity of this source, or one with a match of this source that has the id (100, or the match's
    score); the first entity wins. What has no id match is matched by name, at ``threshold`` or more.
    ``original_building_id`` is the original key of the entity, where it is of this source, else of its match of this
    source, else null. Rows without a match, and null or blank names and ids, get nulls. ``key`` tells rows apart; it may be empty.
    """
    c = F.col
    order = c("stage") * F.lit(1 << 40) + c("seq")
    m = F.try_element_at("matches", F.lit(source))
    mine = c("source") == source
    e = entities.withColumns({"order": order, "original_building_id": F.when(mine, c("original_key")).otherwise(m["original_key"])})
    fields = ["building_key", "original_building_id", "grade", "year_built"]
    own = e.where(mine).select(c("source_id").alias("id"), "order", F.lit(100.0).alias("confidence"), *fields)
    other = e.where(m.isNotNull()).select(m["id"].alias("id"), "order", m["score"].alias("confidence"), "building_key", m["original_key"].alias("original_building_id"), "grade", "year_built")
    known = own.unionByName(other).where("id IS NOT NULL AND id <> ''")
    told = ["confidence", *fields]
    # Of one entity its own id goes before its match's.
    by_id = known.groupBy(c("id").alias("__id")).agg(F.max(F.struct((-c("order")).alias("order"), (c("confidence") == 100.0).alias("own"), *told)).alias("best")).select("__id", *(f"best.{f}" for f in told))
    # Rows without an id (later: that need no name) match nothing: they are dealt by their key, without one by all that can be hashed, not all to one task.
    told_by = [key] if key else [f"`{x.replace('`', '``')}`" for x, kind in transactions.dtypes if "map<" not in kind and "variant" not in kind]
    dealt = lambda value: F.when(value.isNull(), F.pmod(F.xxhash64(*told_by), F.lit(DEALT))).otherwise(0)
    rows = transactions.withColumn("__id", c(id_col).cast("string")).withColumn("__dealt", dealt(c("__id")))
    first = rows.join(by_id.withColumn("__dealt", F.lit(0).cast("long")), ["__id", "__dealt"], "left").drop("__dealt")
    # Names are matched once each, however many transactions they have.
    open_rows = first.where(c("building_key").isNull() & (normal_name(c(name_col)) != ""))
    names = open_rows.select(normal_name(c(name_col)).alias("normalized_name")).distinct()
    pairs = best_name_pairs(names.withColumnRenamed("normalized_name", "name"), e.select(c("normalized_name").alias("name")), threshold)
    # Of entities of one name the first: the others would score the same.
    firsts = e.groupBy(c("normalized_name").alias("other")).agg(F.max(F.struct((-c("order")).alias("order"), *fields)).alias("first"))
    scored = pairs.join(firsts, "other").select("name", (-c("first.order")).alias("order"), *(f"first.{f}" for f in fields), "confidence")
    best = written(best_of_each(scored, ["name"], "confidence", "order", threshold), "by-name")
    by_name = best.select(c("name").alias("__name"), F.lit(0).cast("long").alias("__dealt"), *(c(f).alias(f"n_{f}") for f in told))
    joined = first.withColumn("__name", F.when(c("building_key").isNull(), normal_name(c(name_col)))).withColumn("__dealt", dealt(c("__name"))).join(by_name, ["__name", "__dealt"], "left")
    by = F.when(c("building_key").isNotNull(), F.struct(*told)).otherwise(F.struct(*(c(f"n_{f}").alias(f) for f in told)))
    found = joined.withColumn("__by", by)
    return found.select(*transactions.columns, *(c("__by")[f].alias(n) for f, n in (("building_key", "building_key"), ("original_building_id", "original_building_id"), ("grade", "building_grade"), ("year_built", "building_year"), ("confidence", "match_confidence"))))
