"""First looks at the source tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfloor.sources.tables import Tables

PREVIEW_ROWS = 10


def preview(table: DataFrame) -> DataFrame:
    """Any ten rows: without an order Spark stops reading after the first files."""
    return table.limit(PREVIEW_ROWS)


def preview_rows_found(tables: Tables) -> DataFrame:
    """(table, preview_rows): how many rows of each table are among its preview."""
    result = None
    for name, df in tables.items():
        shown = preview(df).distinct().toDF(*[f"_p_{c}" for c in df.columns])
        same = [F.col(c).eqNullSafe(F.col(f"_p_{c}")) for c in df.columns]
        # At most ten rows are sent out.
        one = df.join(F.broadcast(shown), same, "left_semi").agg(F.count(F.lit(1)).alias("preview_rows"))
        one = one.select(F.lit(name).alias("table"), "preview_rows")
        result = one if result is None else result.unionByName(one)
    return result


def table_row_counts(tables: Tables) -> DataFrame:
    counts = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("total")).select(F.lit(name).alias("table"), "total")
        counts = one if counts is None else counts.unionByName(one)
    return counts
