"""Versions of a table: writers that die, and writers that meet."""

import os

import pytest
from pyspark.sql import functions as F

from parcelforge.plans import jobs
from parcelforge.sources.catalog import Catalog, Dataset
from parcelforge.sources.versions import Conflict, Versions


def values(df):
    return sorted(r["x"] for r in df.collect())


def test_a_writer_that_dies_leaves_the_current_version(spark, tmp_path, monkeypatch):
    held, one = Versions(spark, str(tmp_path / "t")), lambda x: spark.createDataFrame([(x,)], "x int")
    assert held.read() is None and held.numbers() == []
    assert held.commit(one(1), 0) == 1 and values(held.read()) == [1]
    with pytest.raises(Exception, match="boom"):  # while it writes
        held.commit(one(2).select(F.raise_error(F.lit("boom")).cast("int").alias("x")), 1)
    with monkeypatch.context() as m:  # after the data, before the manifest
        m.setattr(held, "_publish", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            held.commit(one(3), 1)
    again = Versions(spark, str(tmp_path / "t"))
    assert values(again.read()) == [1] and again.numbers() == [1]
    assert again.update(lambda old: old.union(one(4))) == 2 and values(again.read()) == [1, 4] and values(again.read(1)) == [1]
    again.update(lambda old: old.union(one(5)))
    again.clean(keep=1)
    assert values(held.read()) == [1, 4, 5] and held.numbers() == [3] and sum(n.startswith("data-") for n in os.listdir(tmp_path / "t")) == 1


def test_two_writers_lose_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    one, two = Versions(spark, path), Versions(spark, path)
    row = lambda x: spark.createDataFrame([(x,)], "x int")
    one.commit(row(0), 0)
    calls = []

    def change(old):
        calls.append(values(old))
        if len(calls) == 1:  # another writer is faster
            two.update(lambda o: o.union(row(7)))
        return old.union(row(1))

    assert one.update(change) == 3 and calls == [[0], [0, 7]] and values(two.read()) == [0, 1, 7]
    with pytest.raises(Conflict):
        two.commit(row(9), 1)
    with pytest.raises(Conflict):
        one.update(lambda o: (two.update(lambda p: p.union(row(8))), o)[1], tries=2)
    assert values(one.read()) == [0, 1, 7, 8, 8]


def test_control_dates_of_two_jobs(spark, tmp_path):
    catalog = Catalog(spark, {"control_dates": Dataset("parquet", str(tmp_path / "dates"))})
    for job, day in (("a", "2025-01-03"), ("b", "2024-02-29"), ("a", "2025-03-01")):
        assert str(jobs.control_date(catalog, job, day)) == day
    assert str(jobs.control_date(catalog, "b")) == "2024-02-29" and jobs.control_date(catalog, "c") is None
