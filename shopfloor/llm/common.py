"""What the operators of this package share."""

from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor.storage import shared_folder

MISSING_TEXT = ""


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once into the shared folder.

    Spark removes the files when they are no longer used if ``spark.cleaner.referenceTracking.cleanCheckpoints``
    is set, which it is not by default; otherwise they are left to the folder's retention.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns that an operator works on; other columns can't clash. A null text is empty."""
    return docs.select(
        docs[id_col].cast("bigint").alias("doc_id"),
        F.coalesce(docs[text_col], F.lit(MISSING_TEXT)).alias("text"),
    )


def crc_of_id(column: Column) -> Column:
    """crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")))


def texts_of(batch: pa.RecordBatch, name: str) -> list[str]:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def small_batches(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``max_bytes`` of a text or binary column, one row at least."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        mean = batch.column(batch.schema.get_field_index(column)).nbytes / batch.num_rows
        rows = max(1, int(max_bytes / max(mean, 1)))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def filtered(docs: DataFrame, text_col: str, accepts: Callable[[list[str]], Sequence[bool]]) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose texts ``accepts`` marks; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, text_col):
            marks = accepts([t or MISSING_TEXT for t in texts_of(batch, text_col)])
            yield batch.filter(pa.array([bool(m) for m in marks], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
