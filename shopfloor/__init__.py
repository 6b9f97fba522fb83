"""Production-run analytics on Spark: five factory tables in, reports and a run-level extract out."""

from shopfloor.sources.tables import Tables, from_catalog, from_jdbc, from_parquet

__all__ = ["Tables", "from_catalog", "from_jdbc", "from_parquet"]
