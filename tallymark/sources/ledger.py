"""Loads of several tables that become visible at once.

Every table of such a load has a column of run ids, its partition. A load stages its rows under its run id and then publishes
itself by one row in the ledger. Readers go through the ledger and see the rows of published runs only, so a run that broke
off between two writes is invisible, whatever it left behind. It can be resumed: what it staged completely is kept, and
what it staged in part is replaced. A later run of the same scope (such as a period) takes the place of the earlier one.

The row of the ledger is one file, which Spark's committer moves into place as a whole. One driver publishes at a time; runs
of several drivers need a lock of their own, as for every other append.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.sources.writers import append_by_name, create_empty_table, replace_partition

RUN = "run_id"
SCHEMA = "job string, scope string, run_id string, state string, at bigint"
PUBLISHED = "published"


class Ledger:
    def __init__(self, spark: SparkSession, table: str):
        self._spark, self.table = spark, table
        if not spark.catalog.tableExists(table):
            create_empty_table(spark, table, SCHEMA)

    def create_target(self, table: str, schema: str) -> None:
        """(Re-)create an empty table that loads are staged in; ``schema`` is DDL without the run id."""
        create_empty_table(self._spark, table, f"{schema}, {RUN} string", [RUN])

    def _note(self, job: str, scope: str, run_id: str, state: str) -> None:
        row = self._spark.createDataFrame([(job, scope, run_id, state, time.time_ns())], SCHEMA)
        append_by_name(row.coalesce(1), self.table)

    def states(self, run_id: str) -> set[str]:
        """What a run has reached: ``staged <table>`` for each table, ``published`` at the end."""
        found = self._spark.table(self.table).where(F.col(RUN) == run_id).select("state").distinct()
        return {r.state for r in found.collect()}

    def stage(self, df: DataFrame, table: str, *, job: str, scope: str, run_id: str, allow_narrowing: bool = False) -> None:
        """Write the rows of one table of a run, unless the run has staged them before."""
        state = f"staged {table}"
        if state not in self.states(run_id):
            replace_partition(df, table, allow_narrowing=allow_narrowing, **{RUN: run_id})
            self._note(job, scope, run_id, state)

    def staged(self, table: str, run_id: str) -> DataFrame:
        """The rows that a run has staged, published or not."""
        return self._spark.table(table).where(F.col(RUN) == run_id).drop(RUN)

    def publish(self, *, job: str, scope: str, run_id: str) -> None:
        """Make all that the run has staged visible, once."""
        if PUBLISHED not in self.states(run_id):
            self._note(job, scope, run_id, PUBLISHED)

    def published(self) -> DataFrame:
        """``job, scope, run_id``: the last published run of each job and scope."""
        runs = self._spark.table(self.table).where(F.col("state") == PUBLISHED)
        return runs.groupBy("job", "scope").agg(F.max_by(RUN, F.struct("at", RUN)).alias(RUN))

    def unfinished(self) -> DataFrame:
        """``job, scope, run_id, n_staged`` of the runs that have not been published."""
        runs = self._spark.table(self.table).groupBy("job", "scope", RUN)
        done = F.count_if(F.col("state") == PUBLISHED)
        return runs.agg(F.count("*").alias("n_staged"), done.alias("_done")).where("_done = 0").drop("_done")

    def read(self, table: str) -> DataFrame:
        """The rows of published runs, without the run id. Partitions of other runs are not read."""
        return self._spark.table(table).join(F.broadcast(self.published().select(RUN)), RUN, "left_semi").drop(RUN)
