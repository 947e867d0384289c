"""Named datasets: a name stands for a format, a path and options."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from .files import exists


@dataclass(frozen=True)
class Dataset:
    kind: str
    path: str
    options: dict[str, str] = field(default_factory=dict)
    schema: str | None = None


class Catalog:
    def __init__(self, spark: SparkSession, datasets: dict[str, Dataset]):
        self.spark, self.datasets = spark, datasets

    def load(self, name: str) -> DataFrame:
        d = self.datasets[name]
        reader = self.spark.read.format(d.kind).options(**d.options)
        return (reader.schema(d.schema) if d.schema else reader).load(d.path)

    def exists(self, name: str) -> bool:
        """Whether anything has been saved there."""
        return exists(self.spark, self.datasets[name].path)

    def save(self, name: str, df: DataFrame, mode: str = "overwrite") -> None:
        d = self.datasets[name]
        df.write.mode(mode).format(d.kind).options(**d.options).save(d.path)

    def views(self) -> None:
        """Register every dataset as a temporary view of its name."""
        for name in self.datasets:
            self.load(name).createOrReplaceTempView(name)
