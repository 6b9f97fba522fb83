"""NULL placement as PostgreSQL does it: first when descending, last when ascending.

Spark's defaults are the opposite, which changes rank values and top-k rows, so no query here
uses a bare ``asc()`` or ``desc()``.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def pg_desc(name: str) -> Column:
    return F.col(name).desc_nulls_first()


def pg_asc(name: str) -> Column:
    return F.col(name).asc_nulls_last()


def newest_first(plant: str) -> list[Column]:
    """The order of the extract; the run id makes it total."""
    return [pg_desc("run_date"), pg_asc(plant), pg_asc("shift"), pg_asc("run_id")]
