"""The two fact tables as catalog tables bucketed by run, so that runs and checks meet without a shuffle.

A bucket is read by one task, so rows that would make one bucket large are kept beside the bucketed
table: those of hot runs and those without a run id lie in ``<table>_rest``, spread over its files.
"""

from functools import cached_property
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor import schemas
from shopfloor.operators.joins import JoinLimits
from shopfloor.sources.tables import Tables, conform
from shopfloor.storage import fresh_path, materialize

KEY = "run_id"
FACTS = ("production_runs", "quality_checks")
ROWS_PER_BUCKET = 2_000_000
HOT_ROWS = JoinLimits.slice_rows


class BucketedTables(Tables):
    """The five tables of a schema that ``write_bucketed`` wrote; facts also as (bucketed part, rest)."""

    def __init__(self, spark: SparkSession, schema: str):
        super().__init__(spark, self._whole)
        self.schema = schema

    def _table(self, name: str, like: str) -> DataFrame:
        return conform(self.spark.table(f"{self.schema}.{name}"), schemas.TABLES[like])

    def _whole(self, name: str) -> DataFrame:
        if name in FACTS:
            return self.bucketed(name).unionByName(self.rest(name))
        return self._table(name, name)

    def bucketed(self, name: str) -> DataFrame:
        """The rows with an id that is not hot, hash-partitioned by it as they lie in the files."""
        return self._table(name, name)

    def rest(self, name: str) -> DataFrame:
        """The rows without an id, and those of hot runs."""
        return self._table(f"{name}_rest", name)

    @cached_property
    def buckets(self) -> int:
        rows = self.spark.sql(f"DESCRIBE EXTENDED {self.schema}.quality_checks").filter("col_name = 'Num Buckets'").collect()
        return int(rows[0]["data_type"])


def buckets_for(rows: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    """How many buckets a table of so many rows gets."""
    return max(1, ceil(rows / rows_per_bucket))


def _hot(facts: DataFrame, hot_rows: int) -> DataFrame:
    """Ids with more rows than ``hot_rows``: at most the table's rows over that number."""
    counts = facts.filter(F.col(KEY).isNotNull()).groupBy(KEY).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") > hot_rows).select(F.col(KEY).alias("_hot"))


def write_bucketed(tables: Tables, schema: str, buckets: int | None = None, hot_rows: int = HOT_ROWS) -> BucketedTables:
    """Write the five tables into the catalog schema ``schema``, replacing those there.

    Without ``buckets`` the larger fact table decides. Each bucket is one file, sorted by run. Both
    fact tables have the same buckets, which is what lets them be joined where they lie. The files
    are in the shared folder; the tables belong to the caller, who drops them.
    """
    spark = tables.spark
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema} LOCATION '{fresh_path(spark, 'schema')}'")
    count = buckets or buckets_for(max(getattr(tables, name).count() for name in FACTS))
    for name in schemas.TABLES:
        df = getattr(tables, name)
        if name not in FACTS:
            _save(df, schema, name)
            continue
        hot = materialize(_hot(df, hot_rows), "hot-runs")
        # A written table: Spark broadcasts it if its file is small and shuffles otherwise.
        is_hot = F.col("_hot").isNotNull() | F.col(KEY).isNull()
        marked = df.join(hot, F.col(KEY) == F.col("_hot"), "left")
        main = marked.filter(~is_hot).drop("_hot")
        # The same hash as that of the buckets, so that each task writes one file.
        main = main.repartition(count, KEY)
        _save(main, schema, name, count)
        _save(marked.filter(is_hot).drop("_hot"), schema, f"{name}_rest")
    return BucketedTables(spark, schema)


def _save(df: DataFrame, schema: str, name: str, buckets: int | None = None) -> None:
    writer = df.write.mode("overwrite").format("parquet").option("path", fresh_path(df.sparkSession, f"table-{name}"))
    if buckets:
        writer = writer.bucketBy(buckets, KEY).sortBy(KEY)
    writer.saveAsTable(f"{schema}.{name}")


def drop_bucketed(tables: BucketedTables) -> None:
    """Remove the catalog's entries; the files go with the shared folder's other intermediate tables."""
    tables.spark.sql(f"DROP DATABASE IF EXISTS {tables.schema} CASCADE")
