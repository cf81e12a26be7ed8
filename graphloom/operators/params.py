"""Statements with named parameters, and many bindings of one statement in one job."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class Statement:
    """A SQL text with :name parameters. A name that isn't bound fails when it runs; extra names are ignored."""

    spark: SparkSession
    text: str
    bound: dict[str, Any] = field(default_factory=dict)

    def bind(self, **values: Any) -> Statement:
        """Sets parameters; those bound before stay."""
        if blank := [k for k in values if not k.strip()]:
            raise ValueError(f"blank parameter name {blank[0]!r}")
        self.bound = {**self.bound, **values}
        return self

    def run(self, **views: DataFrame) -> DataFrame:
        for name, df in views.items():
            df.createOrReplaceTempView(name)
        return self.spark.sql(self.text, args=self.bound)


def run_many(spark: SparkSession, texts: list[str]) -> list[DataFrame]:
    """A result for each statement of a script."""
    return [spark.sql(t) for t in texts]


def join_bindings(table: DataFrame, key: str, bindings: DataFrame, name: str) -> DataFrame:
    """Rows of table for each binding of key = :name, with the binding's columns: one job for all of them."""
    renamed = bindings.select(*(F.col(c).alias(f"bound_{c}") for c in bindings.columns))
    return table.join(renamed, F.col(key) == F.col(f"bound_{name}"))
