"""Counting rows on the way, without a job of its own, and keeping the counts as an audit trail."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallymark.sources.writers import append_or_create

def counted(df: DataFrame, **metrics: Column) -> tuple[DataFrame, Observation]:
    """``df`` that counts its rows (and ``metrics``) while something else runs it.

    ``observation.get`` waits for that job and returns the figures. A retried task is counted once.
    """
    observation = Observation(f"counted-{uuid.uuid4().hex}")
    figures = {"n_rows": F.count(F.lit(1)), **metrics}
    return df.observe(observation, *(figure.alias(name) for name, figure in figures.items())), observation


class AuditTrail:
    """Row counts of the steps of one run."""

    def __init__(self, spark: SparkSession, run_id: str | None = None):
        self._spark = spark
        self.run_id = run_id or uuid.uuid4().hex
        self._steps: list[tuple[str, Observation]] = []

    def step(self, df: DataFrame, name: str, **metrics: Column) -> DataFrame:
        """``df`` with its rows counted under ``name`` when the job runs."""
        watched, observation = counted(df, **metrics)
        self._steps.append((name, observation))
        return watched

    def rows(self) -> DataFrame:
        """The figures as a DataFrame, one row per step and metric. Call it after the job."""
        values = [
            (self.run_id, step, metric, None if value is None else str(value))
            for step, observation in self._steps
            for metric, value in observation.get.items()
        ]
        text = self._spark.createDataFrame(values, "run_id string, step string, metric string, value string")
        return text.withColumn("value", F.col("value").cast("decimal(38,6)"))

    def save(self, table: str) -> None:
        append_or_create(self.rows(), table)
