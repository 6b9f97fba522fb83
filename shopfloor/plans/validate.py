"""Acceptance checks: completeness, fan-out, null rates, types and defect coverage."""

from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopfloor.functions.numeric import percent
from shopfloor.operators.joins import DEFAULT_LIMITS, JoinLimits, attach
from shopfloor.plans.profile import null_counts
from shopfloor.schemas import EXTRACT
from shopfloor.sources.tables import Tables

CRITICAL_COLUMNS = ["run_id", "plant_id", "product_id", "efficiency_pct"]
MAX_NULL_PCT = Decimal("2.00")
MIN_COVERAGE_PCT = Decimal("80.00")


def _known(dimension: DataFrame, key: str, prefix: str) -> DataFrame:
    """Rows and active rows per key of a dimension."""
    return dimension.groupBy(key).agg(
        F.count(F.lit(1)).alias(f"{prefix}_rows"), F.count_if("is_active").alias(f"{prefix}_active")
    )


def completeness(tables: Tables, extract: DataFrame) -> DataFrame:
    """Where the source runs went: (metric, runs).

    A run that fails several conditions is counted under the first of unknown plant, unknown
    product, inactive plant, inactive product. The runs are counted per pair of ids before any
    join, and the extract is counted on its own, so the two sides check each other.
    """
    pairs = tables.production_runs.groupBy("plant_id", "product_id").agg(F.count(F.lit(1)).alias("n"))
    flagged = (
        pairs.join(_known(tables.plants, "plant_id", "plant"), "plant_id", "left")
        .join(_known(tables.products, "product_id", "product"), "product_id", "left")
        .withColumn(
            "fate",
            F.when(F.col("plant_rows").isNull(), "unknown_plant")
            .when(F.col("product_rows").isNull(), "unknown_product")
            .when(F.col("plant_active") == 0, "inactive_plant")
            .when(F.col("product_active") == 0, "inactive_product")
            .otherwise("active_runs"),
        )
    )
    n = F.col("n")
    metrics = ["active_runs", "unknown_plant", "unknown_product", "inactive_plant", "inactive_product"]
    fates = flagged.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("source_runs"),
        *[F.coalesce(F.sum(F.when(F.col("fate") == m, n)), F.lit(0)).alias(m) for m in metrics],
        # What the joins should give, duplicate dimension keys included.
        F.coalesce(
            F.sum(F.when(F.col("fate") == "active_runs", n * F.col("plant_active") * F.col("product_active"))),
            F.lit(0),
        ).alias("expected_rows"),
    )
    columns = ["source_runs", *metrics, "expected_rows"]
    counted = extract.agg(F.count(F.lit(1)).alias("runs")).select(F.lit("extract_rows").alias("metric"), "runs")
    return fates.unpivot([], columns, "metric", "runs").unionByName(counted)


def rejected_runs(tables: Tables, limits: JoinLimits = DEFAULT_LIMITS) -> DataFrame:
    """The runs that the extract leaves out: (run_id, plant_id, product_id, reason), a row for each.

    Reasons are those of ``completeness``, in its order; a run that is kept has none. The runs pass
    through both lookups in one branch: in a union of those with and without a plant, one task would
    hold the same partition of both.
    """
    runs = tables.production_runs.select("run_id", "plant_id", "product_id")
    marked = runs
    for dimension, key, name in ((tables.plants, "plant_id", "plant"), (tables.products, "product_id", "product")):
        known = _known(dimension, key, name)
        marked = attach(marked, known, [key], "left", limits=limits, keys_from=runs, slice_by=["run_id"])
    reason = (
        F.when(F.col("plant_rows").isNull(), "unknown_plant")
        .when(F.col("product_rows").isNull(), "unknown_product")
        .when(F.col("plant_active") == 0, "inactive_plant")
        .when(F.col("product_active") == 0, "inactive_product")
    )
    found = marked.select("run_id", "plant_id", "product_id", reason.alias("reason"))
    return found.filter(F.col("reason").isNotNull())


def fan_out(tables: Tables, extract: DataFrame) -> DataFrame:
    """Duplicate keys: (relation, row_count, distinct_keys, repeated_keys), for dimensions, runs and extract."""
    relations = {
        "plants": (tables.plants, "plant_id"),
        "products": (tables.products, "product_id"),
        "production_runs": (tables.production_runs, "run_id"),
        "extract": (extract, "run_id"),
    }
    result = None
    for name, (df, key) in relations.items():
        one = (
            df.groupBy(key)
            .agg(F.count(F.lit(1)).alias("n"))
            .agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
                F.count(key).alias("distinct_keys"),
                F.count_if(F.col("n") > 1).alias("repeated_keys"),
            )
            .select(F.lit(name).alias("relation"), "row_count", "distinct_keys", "repeated_keys")
        )
        result = one if result is None else result.unionByName(one)
    return result


def null_rates(runs: DataFrame) -> DataFrame:
    """Share of NULLs in the critical columns of the source runs, against the limit of 2 percent."""
    share = percent(F.col("nulls"), F.col("total"))
    # The limit is tested on the counts, not on the rounded share.
    within = F.col("nulls") * 100 <= F.col("total") * F.lit(MAX_NULL_PCT)
    return null_counts(runs.select(*CRITICAL_COLUMNS)).select(
        "column", "nulls", share.alias("null_pct"), within.alias("within_limit")
    )


def schema_differences(df: DataFrame, expected: T.StructType = EXTRACT) -> list[str]:
    """Missing, unexpected and differently typed columns; empty if the schema is as declared."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    wanted = {f.name: f.dataType for f in expected.fields}
    missing = [f"missing: {c}" for c in wanted if c not in actual]
    extra = [f"unexpected: {c}" for c in actual if c not in wanted]
    typed = [
        f"{c}: {actual[c].simpleString()} instead of {wanted[c].simpleString()}"
        for c in wanted
        if c in actual and actual[c] != wanted[c]
    ]
    return missing + extra + typed


def schema_check(spark: SparkSession, path: str, expected: T.StructType = EXTRACT) -> DataFrame:
    """(column, expected_type, found_types, files, files_with, status): the declared schema against every file's own.

    One row for each declared column and each further one found in a parquet file at ``path``.
    ``found_types`` lists the different types in the files; ``status`` is ok, missing (from some
    file), unexpected or retyped. Schemas come from the files' footers, data is not read.
    """
    files = spark.read.parquet(path).inputFiles()
    # A footer each, read by small jobs that run side by side.
    with ThreadPoolExecutor(16) as pool:
        schemas = list(pool.map(lambda file: spark.read.parquet(file).schema, files))
    found: dict[str, list[str]] = {}
    for schema in schemas:
        for f in schema.fields:
            found.setdefault(f.name, []).append(f.dataType.simpleString())
    wanted = {f.name: f.dataType.simpleString() for f in expected.fields}
    rows = []
    for column in [*wanted, *sorted(set(found) - set(wanted))]:
        types = found.get(column, [])
        if column not in wanted:
            status = "unexpected"
        elif len(types) < len(files):
            status = "missing"
        else:
            status = "ok" if set(types) == {wanted[column]} else "retyped"
        rows.append((column, wanted.get(column), ",".join(sorted(set(types))) or None, len(files), len(types), status))
    return spark.createDataFrame(rows, "column string, expected_type string, found_types string, files bigint, files_with bigint, status string")


def dtype_check(text: DataFrame, expected: T.StructType = EXTRACT) -> DataFrame:
    """For an extract read as text: values per column and how many of them are not of the declared type."""
    filled = {f.name: F.count(f.name) for f in expected.fields}
    readable = {f.name: F.count(F.col(f.name).try_cast(f.dataType)) for f in expected.fields}
    counts = text.agg(
        *[
            F.struct(
                F.lit(f.dataType.simpleString()).alias("expected_type"),
                filled[f.name].alias("filled"),
                (filled[f.name] - readable[f.name]).alias("unreadable"),
            ).alias(f.name)
            for f in expected.fields
        ]
    )
    return counts.unpivot([], expected.fieldNames(), "column", "found").select("column", "found.*")


def defect_coverage(extract: DataFrame) -> DataFrame:
    """Share of extract rows with a defect rate, against the goal of 80 percent."""
    counts = extract.agg(F.count(F.lit(1)).alias("row_count"), F.count("defect_rate_pct").alias("with_defect_rate"))
    rows, covered = F.col("row_count"), F.col("with_defect_rate")
    return counts.select(
        "row_count",
        "with_defect_rate",
        percent(covered, rows).alias("coverage_pct"),
        (covered * 100 >= rows * F.lit(MIN_COVERAGE_PCT)).alias("sufficient"),
    )
