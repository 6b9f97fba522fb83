"""The five source tables, from files, a catalog schema or a database."""

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopfloor import schemas
from shopfloor.sources import splits


class Tables:
    """The five tables; each is opened when a query first asks for it."""

    def __init__(self, spark: SparkSession, load: Callable[[str], DataFrame]):
        self.spark = spark
        self._load = load

    @cached_property
    def production_runs(self) -> DataFrame:
        return self._load("production_runs")

    @cached_property
    def quality_checks(self) -> DataFrame:
        return self._load("quality_checks")

    @cached_property
    def equipment(self) -> DataFrame:
        return self._load("equipment")

    @cached_property
    def plants(self) -> DataFrame:
        return self._load("plants")

    @cached_property
    def products(self) -> DataFrame:
        return self._load("products")

    def items(self) -> list[tuple[str, DataFrame]]:
        return [(name, getattr(self, name)) for name in schemas.TABLES]


OPTIONAL = {"equipment_id"}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Declared columns and types only; a missing column fails at once, a value that a cast would change when read.

    ``equipment_id`` may be missing: the other columns then settle which machine comes first.
    """
    return df.select(*[_conformed(df, f) for f in schema.fields])


def _conformed(df: DataFrame, field: T.StructField) -> Column:
    if field.name in OPTIONAL and field.name not in df.columns:
        return F.lit(None).cast(field.dataType).alias(field.name)
    column = F.col(field.name)
    source = df.schema[field.name].dataType if field.name in df.columns else None
    cast = column.cast(field.dataType)
    finer = isinstance(source, T.DecimalType) and isinstance(field.dataType, T.DecimalType) and source.scale > field.dataType.scale
    if finer or (isinstance(source, T.FractionalType) and isinstance(field.dataType, T.IntegralType)):
        message = F.concat(F.lit(f"{field.name} does not fit {field.dataType.simpleString()}: "), column.cast("string"))
        cast = F.when(column.isNull() | (cast == column), cast).otherwise(F.raise_error(message))
    return cast.alias(field.name)


def from_parquet(spark: SparkSession, folder: str) -> Tables:
    """``<folder>/<table>``, each a parquet file or folder."""
    return Tables(spark, lambda name: conform(spark.read.parquet(f"{folder}/{name}"), schemas.TABLES[name]))


def from_catalog(spark: SparkSession, schema: str = "manufacturing") -> Tables:
    return Tables(spark, lambda name: conform(spark.table(f"{schema}.{name}"), schemas.TABLES[name]))


# Tables large enough to be read by several connections, with the key that splits them. Checks are
# split by their own id: one run may hold a large part of them.
SPLIT_COLUMNS = {"production_runs": "run_id", "quality_checks": "check_id", "equipment": "plant_id"}


def jdbc_options(table: str, schema: str, bounds: tuple[int, int] | None, partitions: int) -> dict[str, str]:
    """Reader options of one table; filters and aggregates go to the server where Spark can push them."""
    options = {"dbtable": f"{schema}.{table}", "fetchsize": "10000", "pushDownAggregate": "true"}
    if table in SPLIT_COLUMNS and bounds is not None:
        low, high = bounds
        options |= {
            "partitionColumn": SPLIT_COLUMNS[table],
            "lowerBound": str(low),
            "upperBound": str(high + 1),
            "numPartitions": str(partitions),
        }
    return options


def count_query(table: str, column: str, low: int, high: int, width: int) -> str:
    """Rows of each cell of a key's range, counted by the server."""
    cell = f"floor(({column} - {low}) / {width})"
    return f"SELECT {cell} AS cell, count(*) AS n FROM {table} WHERE {column} >= {low} AND {column} < {high} GROUP BY {cell}"


def from_jdbc(
    spark: SparkSession,
    url: str,
    schema: str = "manufacturing",
    partitions: int = 64,
    properties: dict[str, str] | None = None,
) -> Tables:
    """Read from a database; the large tables in ``partitions`` ranges of their key with about as many rows each.

    The ranges come from counts that the server makes; rows without a key are a range of their own.
    ``properties`` carries user, password and driver; the driver's jar must be on the classpath.
    """

    def read(**options: str) -> DataFrame:
        return spark.read.format("jdbc").options(url=url, **(properties or {}), **options).load()

    def load(name: str) -> DataFrame:
        if name not in SPLIT_COLUMNS:
            return conform(read(**jdbc_options(name, schema, None, partitions)), schemas.TABLES[name])
        column, table = SPLIT_COLUMNS[name], f"{schema}.{name}"
        row = read(query=f"SELECT min({column}) AS low, max({column}) AS high FROM {table}").first()
        cuts = []
        if row[0] is not None:

            def count(low: int, high: int, width: int) -> dict[int, int]:
                found = read(query=count_query(table, column, low, high, width)).collect()
                return {int(r[0]): int(r[1]) for r in found}

            cuts = splits.equi_depth(splits.histogram(count, int(row[0]), int(row[1]) + 1, partitions), partitions)
        options = {"fetchsize": "10000"} | (properties or {})
        ranges = splits.predicates(column, cuts)
        return conform(spark.read.jdbc(url, table, predicates=ranges, properties=options), schemas.TABLES[name])

    return Tables(spark, load)
