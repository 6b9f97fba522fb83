"""Reading CSV files with line breaks inside fields by many tasks a file.

A line break ends a record if the quotes before it are even in number. So the quotes of each block
of a file are counted first; the sums over the blocks before tell how a block begins. Each task then
puts the lines of its blocks together to records. What a block begins or ends within a record is a
fragment, two a block at most; these are put together in a second, small step.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD, HEAD, TAIL = 0, 1, 2
_PIECES = "kind int, file string, start bigint, closed boolean, text string"
_NAMES = [f.split()[0] for f in _PIECES.split(", ")]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, value): lines in their order, and where in the file the block begins that they begin in."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def open_blocks(lines: DataFrame) -> DataFrame:
    """(file, start) of the blocks that begin inside quotes."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counts = lines.groupBy("file", "start").agg(F.sum(quotes.cast("bigint")).alias("n"))
    # One row for each block of a file.
    before = F.sum("n").over(Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    return counts.withColumn("before", before).filter("before % 2 = 1").select("file", "start")


class _Block:
    """Puts the lines of one block together; ``head`` while still in the record that began before the block."""

    def __init__(self, file: str, start: int, inside: bool, header: bool):
        self.file, self.start, self.open, self.head = file, start, inside, inside
        self.skip = header and start == 0
        self.parts: list[str] = []

    def records(self, lines: pa.Array) -> Iterator[tuple]:
        quotes = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False)
        ends = np.flatnonzero((int(self.open) + np.cumsum(quotes)) % 2 == 0)
        texts, at = lines.to_pylist(), 0
        for end in ends.tolist():
            text = "\n".join([*self.parts, *texts[at : end + 1]])
            self.parts, at = [], end + 1
            if self.head:
                yield HEAD, self.file, self.start, True, text
            elif not self.skip:
                yield RECORD, self.file, self.start, True, text
            self.head = self.skip = False
        self.parts += texts[at:]
        self.open = bool((int(self.open) + int(quotes.sum())) % 2)

    def rest(self) -> Iterator[tuple]:
        if self.parts:
            yield (HEAD if self.head else TAIL), self.file, self.start, False, "\n".join(self.parts)


def records(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """(text): the records of the files at ``path``, without their headers and the line break at the end."""
    lines = _lines(spark, path)
    # Two numbers for each block that begins inside quotes: far less than the blocks themselves.
    inside = {(r["file"], r["start"]) for r in open_blocks(lines).toLocalIterator()}
    shared = spark.sparkContext.broadcast(inside)

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(found: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int32(), pa.string(), pa.int64(), pa.bool_(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in found], t) for i, t in enumerate(kinds)], _NAMES)

        block = None
        for batch in batches:
            starts, files = batch.column(1).to_numpy(), batch.column(0)
            # A task reads its blocks one after the other; small files can share a batch.
            names = files.dictionary_encode()
            codes = names.indices.to_numpy()
            cuts = np.flatnonzero((np.diff(starts) != 0) | (np.diff(codes) != 0)) + 1
            out: list[tuple] = []
            for first, last in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                if first == last:
                    continue
                file, start = names.dictionary[int(codes[first])].as_py(), int(starts[first])
                if block is None or (block.file, block.start) != (file, start):
                    out += block.rest() if block else []
                    block = _Block(file, start, (file, start) in shared.value, header)
                out += block.records(batch.column(2).slice(first, last - first))
            yield rows(out)
        if block:
            yield rows(list(block.rest()))

    pieces = lines.mapInArrow(assemble, _PIECES)
    fragments = pieces.filter(F.col("kind") != RECORD)
    order = Window.partitionBy("file").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    grouped = fragments.withColumn("group", F.sum((F.col("kind") == TAIL).cast("int")).over(order))
    # The parts of one record that spans blocks.
    parts = F.array_sort(F.collect_list(F.struct("start", "text")))
    whole = grouped.groupBy("file", "group").agg(parts.alias("parts"))
    joined = whole.select(F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias("text"))
    return pieces.filter(F.col("kind") == RECORD).select("text").unionByName(joined)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, options: dict[str, str]) -> DataFrame:
    """The files at ``path`` as ``spark.read.csv`` with ``multiLine`` reads them, but each file by many tasks.

    Files are UTF-8 with ``"`` as quote, doubled inside quotes, and lines end in a line feed. A file
    that cannot be split, as a compressed one, is read by one task. Lines without text are left out.
    """
    header = options.get("header", "false") == "true"
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    given = {k: v for k, v in options.items() if k not in ("header", "multiLine")}
    parsed = records(spark, path, header).filter("text <> ''").select(F.from_csv("text", ddl, given).alias("row"))
    return parsed.select("row.*")
