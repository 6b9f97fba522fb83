"""CSV and parquet forms of the extract."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from shopfloor.functions.ordering import newest_first
from shopfloor.schemas import EXTRACT
from shopfloor.sources.csv_blocks import read_csv
from shopfloor.storage import materialize, publish, remove, staging_path

# Doubled quotes inside quoted fields, as other CSV readers expect them.
CSV_FORMAT = {"header": "true", "sep": ",", "encoding": "UTF-8", "quote": '"', "escape": '"', "dateFormat": "yyyy-MM-dd"} | {
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


class EmptyExtract(ValueError):
    """The extract has no rows; nothing was written and earlier output was left alone."""


def save_extract(extract: DataFrame, path: str, formats: tuple[str, ...] = ("csv",), staged: bool = False) -> None:
    """Write ``<path>`` as CSV (or ``<path>/<format>`` for several formats), replacing what is there.

    The extract is computed once into the shared folder, unless it is ``staged``: read from files
    already. Whether it is empty and how its keys are distributed for the sort is then read from those
    files, not by computing it again. The output is written beside ``path`` and renamed when all of
    it is there, so a write that fails leaves the earlier output whole. Part files follow the order
    of the extract: newest runs first, then plant, shift and run id. ``plant_id`` orders the plants
    if the frame carries it, as ``keyed_extract`` does; it is not written.
    """
    spark = extract.sparkSession
    rows = extract if staged else materialize(extract, "extract")
    if rows.isEmpty():
        raise EmptyExtract(f"the extract has no rows, {path} was not written")
    plant = "plant_id" if "plant_id" in rows.columns else "plant_name"
    folder = staging_path(path)
    try:
        for kind in formats:
            target = folder if len(formats) == 1 else f"{folder}/{kind}"
            writer = rows.orderBy(*newest_first(plant)).select(*EXTRACT.fieldNames()).write.format(kind)
            (writer.options(**CSV_FORMAT) if kind == "csv" else writer).save(target)
        publish(spark, folder, path)
    except Exception:
        remove(spark, folder)
        raise


# No field holds this text, so that only unquoted empty fields become NULL.
READ_FORMAT = CSV_FORMAT | {"nullValue": "\u0000", "mode": "FAILFAST"}


def read_extract_csv(spark: SparkSession, path: str, multiline: bool = True, schema: T.StructType = EXTRACT) -> DataFrame:
    """The CSV form, typed; an empty field is NULL, a quoted empty one the empty string.

    ``multiline`` allows line breaks inside fields, which the writer may produce, at the price of one
    task per file; without it such a field fails the read. ``read_extract_blocks`` has neither limit.
    """
    return spark.read.schema(schema).options(**READ_FORMAT, multiLine=str(multiline).lower()).csv(path)


def read_extract_blocks(spark: SparkSession, path: str, schema: T.StructType = EXTRACT) -> DataFrame:
    """The CSV form, typed, with line breaks inside fields allowed and files read by many tasks each."""
    return read_csv(spark, path, schema, READ_FORMAT)


def read_extract_text(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """The CSV form with every column as text, for type checks."""
    text = T.StructType([T.StructField(name, T.StringType()) for name in EXTRACT.fieldNames()])
    return read_extract_csv(spark, path, multiline, text)
