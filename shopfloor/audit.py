"""Running queries by name or text, with a record of each run."""

import datetime
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shopfloor.storage import materialize

RECORD = "query string, rows bigint, cols int, duration_ms double, status string, error string"
#: What the audit table adds to a record: which run it belongs to, its place there, and when that run began.
TABLE = f"run string, started_at timestamp, step int, {RECORD}"


def sql(spark: SparkSession, text: str, **params) -> DataFrame:
    """A query with ``:name`` parameters. A schema is given as ``IDENTIFIER(:schema || '.plants')``."""
    return spark.sql(text, args=params)


class AuditedRunner:
    """Computes results once, into the shared folder, and records rows, columns, time and status.

    Errors are recorded and raised; with ``raise_errors=False`` they are recorded and None returned.
    Since Spark finds some errors only when it computes, the record covers the computation.
    """

    def __init__(self, spark: SparkSession, raise_errors: bool = True, run: str | None = None):
        self.spark = spark
        self.raise_errors = raise_errors
        self.run_id = run or uuid.uuid4().hex
        self.started_at = datetime.datetime.now(datetime.timezone.utc)
        self._history: list[tuple] = []

    def run(self, query: str, build: Callable[[], DataFrame], ordered: bool = True) -> DataFrame | None:
        """The result, written once; in its order unless ``ordered`` is False, which saves a sort of large results."""
        started = time.perf_counter()
        try:
            df = build()
            seen = Observation()
            # The place keeps the order of the result, which files don't.
            placed = df.withColumn("_place", F.monotonically_increasing_id()) if ordered else df
            result = materialize(placed.observe(seen, F.count(F.lit(1)).alias("rows")), "result")
            self._record(query, seen.get.get("rows", 0), len(df.columns), started)
            return result.orderBy("_place").drop("_place") if ordered else result
        except Exception as error:
            self._record(query, 0, 0, started, str(error))
            if self.raise_errors:
                raise
            return None

    def run_sql(self, text: str, **params) -> DataFrame | None:
        return self.run(text, lambda: sql(self.spark, text, **params))

    def _record(self, query: str, rows: int, cols: int, started: float, error: str | None = None) -> None:
        elapsed = (time.perf_counter() - started) * 1000
        self._history.append((query.strip(), rows, cols, elapsed, "success" if error is None else "error", error))

    @property
    def failed(self) -> bool:
        return any(row[4] == "error" for row in self._history)

    def records(self) -> DataFrame:
        """One row per query run so far, with its whole text and message; grows with the calls only."""
        return self.spark.createDataFrame(self._history, RECORD)

    def history(self) -> DataFrame:
        """The five-field view of ``records``."""
        status = F.concat_ws(": ", "status", "error").alias("status")
        return self.records().select(F.col("query").alias("sql_preview"), "rows", "cols", "duration_ms", status)

    def append_to(self, path: str) -> None:
        """Add this run to the parquet table at ``path``, a folder a run.

        What the table holds of this run is replaced, so that a repeated call adds nothing; other
        runs are left alone, whoever writes them at the same time.
        """
        rows = [(self.run_id, self.started_at, step, *row) for step, row in enumerate(self._history)]
        table = self.spark.createDataFrame(rows, TABLE)
        table.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(path)


def audit_runs(spark: SparkSession, path: str) -> DataFrame:
    """(run, started_at, queries, errors, rows, duration_ms) of the runs in the audit table at ``path``."""
    table = spark.read.schema(TABLE).parquet(path)
    return table.groupBy("run", "started_at").agg(
        F.count(F.lit(1)).alias("queries"),
        F.count_if(F.col("status") == "error").alias("errors"),
        F.sum("rows").alias("rows"),
        F.sum("duration_ms").alias("duration_ms"),
    )
