"""What a run did, step by step, measured by the jobs that did it.

Row counts come from an ``Observation`` on the very job that writes a table, so no
table is scanned again to be counted. A step that fails leaves a row as well.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import ts_literal
from .merge import INSERTED, KEPT, UNCHANGED, UPDATED

ACTIONS = (INSERTED, UPDATED, UNCHANGED, KEPT)
SUCCESS, FAILED = "Success", "Failed"
STEP_DDL = ("run_id string, run_ts string, step string, table_name string, status string, seconds double, "
            "inserted long, updated long, unchanged long, kept long, error string")


def stamp_action(run_ts) -> Column:
    """The action of a row of a merged table that carries stamps and no ``merge_action``."""
    ts = ts_literal(run_ts)
    return (F.when(F.col("created_at") == ts, F.lit(INSERTED)).when(F.col("updated_at") == ts, F.lit(UPDATED))
            .otherwise(F.lit(KEPT)))


def counted(df: DataFrame, action: Column | str = "merge_action") -> tuple[DataFrame, Observation]:
    """``df`` without its ``merge_action``, counted by action while it is written."""
    seen = Observation()
    return counted_by(df, seen, action), seen


def counted_by(df: DataFrame, seen: Observation, action: Column | str = "merge_action") -> DataFrame:
    kind = F.col(action) if isinstance(action, str) else action
    return df.observe(seen, *(F.count_if(kind == a).alias(a) for a in ACTIONS)).drop("merge_action")


class StepLog:
    """Rows of the steps of one attempt of a run."""

    def __init__(self, run_id: str, run_ts) -> None:
        self.run_id, self.run_ts, self.rows = run_id, str(run_ts), []

    def step(self, step: str, table: str, job: Callable[[], object], seen: Observation | None = None) -> Callable[[], object]:
        """``job``, leaving a row with its time, its status and what ``seen`` counted."""
        def run():
            began = time.perf_counter()
            try:
                out = job()
                counts = seen.get if seen is not None else {}
            except Exception as e:
                self._add(step, table, FAILED, began, {}, str(e).split("\n")[0][:500])
                raise
            self._add(step, table, SUCCESS, began, counts, None)
            return out
        return run

    def _add(self, step, table, status, began, counts, error) -> None:
        self.rows.append((self.run_id, self.run_ts, step, table, status, round(time.perf_counter() - began, 3),
                          *(counts.get(a) for a in ACTIONS), error))

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, STEP_DDL).coalesce(1)

    def audit(self, spark: SparkSession, step: str) -> DataFrame:
        """``table_name, action, row_count, run_ts`` of a step's tables; actions without rows are left out."""
        found = [(r[3], a, n, self.run_ts) for r in self.rows if r[2] == step for a, n in zip(ACTIONS, r[6:10]) if n]
        out = spark.createDataFrame(found, "table_name string, action string, row_count long, run_ts string")
        return out.withColumn("run_ts", F.col("run_ts").cast("timestamp_ntz")).coalesce(1)


def read_step_log(spark: SparkSession, root: str) -> DataFrame:
    """The steps of all attempts of all runs of a warehouse, failed ones included."""
    return spark.read.schema(STEP_DDL).parquet(f"{root}/_steps/*")
