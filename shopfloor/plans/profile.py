"""Profile and quality flags of an extract, whether computed or read back from files."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopfloor.functions.numeric import mean_of_hundredths, percent_half_even, sum_of_hundredths

HIGH_DEFECT_RATE = 20


def as_date(df: DataFrame, name: str) -> Column:
    """The column as a date; text that is no date becomes NULL."""
    column = F.col(name)
    return column.try_cast("date") if isinstance(df.schema[name].dataType, T.StringType) else column


def extract_profile(extract: DataFrame) -> DataFrame:
    """Rows, columns, date range, plants, product categories and mean efficiency, in one row.

    The extract is added up per plant and category first, so that the two distinct counts run over
    that short list and not over an expanded copy of the extract.
    """
    parts = extract.groupBy("plant_name", "product_category").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(as_date(extract, "run_date")).alias("first_date"),
        F.max(as_date(extract, "run_date")).alias("last_date"),
        sum_of_hundredths(F.col("efficiency_pct")).alias("efficiency"),
        F.count("efficiency_pct").alias("efficiency_n"),
    )
    return parts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.lit(len(extract.columns)).cast("bigint").alias("column_count"),
        F.min("first_date").alias("first_run_date"),
        F.max("last_date").alias("last_run_date"),
        F.countDistinct("plant_name").alias("plants"),
        F.countDistinct("product_category").alias("product_categories"),
        mean_of_hundredths(F.sum("efficiency"), F.sum("efficiency_n"), 1).alias("avg_efficiency_pct"),
    )


def null_counts(df: DataFrame) -> DataFrame:
    """(column, nulls, total) for every column, from one pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_total"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    )
    return counts.unpivot("_total", list(df.columns), "column", "nulls").withColumnRenamed("_total", "total")


def null_report(extract: DataFrame) -> DataFrame:
    """Columns with at least one NULL, with their share of the rows in percent."""
    return (
        null_counts(extract)
        .filter("nulls > 0")
        .select("column", "nulls", percent_half_even(F.col("nulls"), F.col("total"), 1).alias("null_pct"))
    )


def quality_flags(extract: DataFrame) -> DataFrame:
    return extract.agg(
        F.count_if(F.col("efficiency_pct") == 0).alias("zero_efficiency_rows"),
        F.count_if(F.col("defect_rate_pct") > HIGH_DEFECT_RATE).alias("high_defect_rate_rows"),
    )
