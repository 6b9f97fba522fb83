"""How filters interact: what every order of them removes, from a sparse document-term matrix.

The distinct words of all documents form a dictionary of whole numbers as codes. The
matrix lies in shards of some megabytes of text, in compressed rows: for each document the codes of
its words and how often each occurs. A document's row sum is its number of words, the number of its
nonzero entries that of its distinct words. These decide two filters, the others look at the text
itself. What follows is counted by pattern: documents with the same failures, part and labels are
one row, so that the orders of the filters are tried on a few rows only.
"""

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopfloor.llm.common import small_batches
from shopfloor.llm.words import words_of
from shopfloor.storage import materialize

SHARD_BYTES = 4_000_000
#: Bytes of all shards' words that one task of the dictionary holds, about.
SLICE_BYTES = 2_000_000
LEAST_WORDS, LEAST_DISTINCT_PERCENT, MOST_UPPER_PERCENT = 200, 50, 3
FILTERS = "ABCDE"
_MARKS = np.zeros(256, bool)
_MARKS[list(b"#$%&*|")] = True

_LISTS = {"ids": "bigint", "langs": "string", "upper": "bigint", "points": "bigint", "marked": "boolean", "digests": "binary"}
_SHARDS = ", ".join(f"{c} array<{t}>" for c, t in _LISTS.items()) + ", starts array<int>, terms binary, counts binary, words binary"
_NAMES = [f.split()[0] for f in _SHARDS.split(", ")]


def packed(numbers: np.ndarray) -> bytes:
    """32-bit whole numbers, compressed: bytes of equal weight stand together, most of which are zero."""
    return zstandard.compress(numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).view("<i4").ravel().astype(np.int64)


def _as_list(values: pa.Array) -> pa.Array:
    """A column of one row that holds all values."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _sums(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many places of each text are marked."""
    rows = np.searchsorted(offsets, np.flatnonzero(mask), "right") - 1
    return np.bincount(rows, minlength=len(offsets) - 1)


def shards_of(docs: DataFrame, shard_bytes: int = SHARD_BYTES, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The matrix, one row a shard, with words numbered within each shard; written once.

    The entries of document i are those from ``starts[i]`` to ``starts[i + 1]`` of ``terms`` (places
    in ``words``, each entry as its distance to the one before) and ``counts``; ``words`` are the
    shard's distinct words with a blank between, compressed. With them go a shard's number, and of each document
    its id, language, capitals, code points, whether it is marked, and a SHA-256 of its text. Within
    a shard, words are told apart by their 64-bit numbers.
    """

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", shard_bytes):
            found = words_of(batch.column(1))
            numbers, first, local = np.unique(found.numbers, return_index=True, return_inverse=True)
            width = max(len(numbers), 1)
            cells = np.sort(found.rows.astype(np.int64) * width + local)
            new = np.flatnonzero(np.diff(cells, prepend=-1))
            rows, terms = np.divmod(cells[new], width)
            starts = np.searchsorted(rows, np.arange(batch.num_rows + 1))
            data, raw = found.data, found.data.tobytes()
            lists = {
                "ids": batch.column(0),
                "langs": batch.column(2),
                "upper": pa.array(_sums((data >= 65) & (data <= 90), found.offsets)),
                "points": pa.array(np.diff(found.offsets) - _sums((data & 0xC0) == 0x80, found.offsets)),
                "marked": pa.array(_sums(_MARKS[data], found.offsets) > 0),
                "digests": pa.array([hashlib.sha256(raw[a:b]).digest() for a, b in zip(found.offsets, found.offsets[1:])], pa.binary()),
                "starts": pa.array(starts.astype(np.int32)),
            }
            blobs = {
                "terms": packed(np.diff(terms, prepend=0)),
                "counts": packed(np.diff(np.append(new, len(cells)))),
                "words": zstandard.compress(b" ".join(raw[a:b] for a, b in zip(found.starts[first], found.ends[first])), 1),
            }
            columns = [_as_list(lists[c]) if c in lists else pa.array([blobs[c]], pa.binary()) for c in _NAMES]
            yield pa.RecordBatch.from_arrays(columns, _NAMES)

    own = docs.select(
        docs[id_col].cast("bigint").alias("doc_id"),
        F.coalesce(docs[text_col], F.lit("")).alias("text"),
        F.coalesce(docs[lang_col].cast("string"), F.lit("")).alias("lang"),
    )
    return materialize(own.mapInArrow(shard, _SHARDS).withColumn("shard", F.monotonically_increasing_id()), "term-shards")


def codes_of(shards: DataFrame, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """The dictionary: (slice, shard, first, words, codes), the codes of a shard's words that are in a slice.

    Words are dealt over slices by their numbers, as many slices as it takes for each to hold about
    ``slice_bytes`` of all shards' words, compressed. A word's code is its slice in the upper and its place in
    the slice in the lower 32 bits. ``first`` is the place of the first of ``words`` in the shard,
    where the words are in the order of their numbers and so of their slices.
    """
    total = shards.agg(F.sum(F.octet_length("words").cast("bigint"))).first()[0] or 0
    slices = max(64, -(-total // slice_bytes))
    # Slices of equal ranges of the numbers' first 32 bits.
    edges = (np.arange(1, slices, dtype=np.uint64) << np.uint64(32)) // np.uint64(slices) << np.uint64(32)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, words in zip(batch.column(0), batch.column(1)):
                found = words_of(pa.array([zstandard.decompress(words.as_py())], pa.binary()))
                cuts = np.concatenate([[0], np.searchsorted(found.numbers, edges), [len(found)]])
                full = np.flatnonzero(np.diff(cuts))
                raw = found.data.tobytes()
                parts = [zstandard.compress(raw[found.starts[cuts[s]] : found.ends[cuts[s + 1] - 1]], 1) for s in full]
                columns = [pa.array(full.astype(np.int64)), pa.array([shard.as_py()] * len(full), pa.int64())]
                columns += [pa.array(cuts[full].astype(np.int64)), pa.array(parts, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["slice", "shard", "first", "words"])

    def number(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        # In the order of the shards, so that a retry gives the same codes.
        table = table.sort_by("shard")
        known: dict[bytes, int] = {}
        codes = []
        for words in table.column("words").to_pylist():
            codes.append(packed(np.array([known.setdefault(w, len(known)) for w in zstandard.decompress(words).split(b" ")])))
        return table.append_column("codes", pa.array(codes, pa.binary()))

    schema = "slice bigint, shard bigint, first bigint, words binary"
    dealt = shards.select("shard", "words").mapInArrow(deal, schema)
    return dealt.groupBy("slice").applyInArrow(number, schema + ", codes binary")


_MATRIX = ", ".join(f"{c} array<{t}>" for c, t in _LISTS.items()) + ", starts array<int>, codes binary, counts binary"
_MATRIX_NAMES = [f.split()[0] for f in _MATRIX.split(", ")]


def term_matrix(shards: DataFrame, codes: DataFrame) -> DataFrame:
    """The matrix in compressed rows under the dictionary's codes: ``starts``, ``codes`` (64 bits each) and ``counts``."""

    def encode(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        parts = sorted(right.select(["first", "slice", "codes"]).to_pylist(), key=lambda r: r["first"])
        table = np.concatenate([np.zeros(0, np.int64), *((r["slice"] << 32) + unpacked(r["codes"]) for r in parts)])
        terms = np.cumsum(unpacked(left.column("terms")[0].as_py()))
        made = left.append_column("codes", pa.array([table[terms].astype("<i8").tobytes()], pa.binary()))
        return made.select(_MATRIX_NAMES)

    data = shards.drop("words")
    return data.groupBy("shard").cogroup(codes.select("shard", "first", "slice", "codes").groupBy("shard")).applyInArrow(encode, _MATRIX)


def flags_of(matrix: DataFrame) -> DataFrame:
    """(doc_id, part, digest, failed) for each document: which of the first four filters it fails, as bits 1, 2, 4 and 8.

    A row sum is the number of words, the number of a row's entries that of distinct words.
    """

    def flags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(batch.schema.get_field_index(c)).slice(i, 1) for c in columns}
                lists = {c: row[c].flatten() for c in (*_LISTS, "starts")}
                starts = lists["starts"].to_numpy()
                distinct = np.diff(starts)
                words = np.diff(np.concatenate([[0], np.cumsum(unpacked(row["counts"][0].as_py()))])[starts])
                failed = (words < LEAST_WORDS) * 1 + (100 * distinct < LEAST_DISTINCT_PERCENT * words) * 2
                failed += (100 * lists["upper"].to_numpy() > MOST_UPPER_PERCENT * lists["points"].to_numpy()) * 4
                failed += lists["marked"].to_numpy(zero_copy_only=False) * 8
                made = [lists["ids"], lists["langs"], lists["digests"], pa.array(failed.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(made, ["doc_id", "part", "digest", "failed"])

    columns = [*_LISTS, "starts", "counts"]
    return matrix.select(*columns).mapInArrow(flags, "doc_id bigint, part string, digest binary, failed int")


def patterns_of(flags: DataFrame, labels: DataFrame, id_col: str = "doc_id", good_col: str = "quality", toxic_col: str = "toxic") -> DataFrame:
    """(part, failed, docs, good, toxic): documents by part and by the filters they fail, E as bit 16, and how many are labelled so.

    Copies are told from their first document by counts per text, combined before they are shuffled.
    """
    marked = labels.select(labels[id_col].cast("bigint").alias("doc_id"), labels[good_col].alias("quality"), labels[toxic_col].alias("toxic"))
    is_one = lambda c: F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0)).alias(c)
    marked = marked.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(is_one("quality"), is_one("toxic"))
    none = [F.lit(0).alias("quality"), F.lit(0).alias("toxic")]
    keys = ["digest", "part", "failed", "quality", "toxic"]
    same_id = flags.groupBy("doc_id", "digest", "part", "failed").agg(F.count(F.lit(1)).alias("n"))
    # Documents without an id have no label and are no smaller one's copies.
    without = same_id.filter("doc_id IS NULL").select("part", "failed", "n", *none)
    known = same_id.join(marked, "doc_id", "left").filter("doc_id IS NOT NULL").fillna(0, ["quality", "toxic"])
    alike = known.groupBy(*keys).agg(F.min(F.struct("doc_id", "n")).alias("first"), F.sum("n").alias("n"))
    # For one text there are only as many rows as parts times labels.
    least = F.min("first.doc_id").over(Window.partitionBy("digest"))
    alike = alike.withColumn("own", F.when(F.col("first.doc_id") == least, F.col("first.n")).otherwise(F.lit(0)))
    of = F.explode(F.array(F.struct(F.col("failed"), F.col("own").alias("n")), F.struct((F.col("failed") + 16).alias("failed"), (F.col("n") - F.col("own")).alias("n"))))
    counted = alike.select("part", "quality", "toxic", of.alias("of")).select("part", "of.failed", "of.n", "quality", "toxic").filter("n > 0")
    counted = counted.unionByName(without)
    return counted.groupBy("part", "failed").agg(
        F.sum("n").alias("docs"), F.sum(F.col("n") * F.col("quality")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic")
    )


def audit(patterns: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley): a row for each part, order and step.

    ``shapley`` adds up what the step's filter removes over all orders.
    """
    steps = [
        F.struct(
            F.lit("".join(order)).alias("filter_order"),
            F.lit(i + 1).alias("step"),
            F.lit(order[i]).alias("name"),
            F.lit(1 << FILTERS.index(order[i])).alias("bit"),
            F.lit(sum(1 << FILTERS.index(f) for f in order[:i])).alias("before"),
        )
        for order in permutations(FILTERS)
        for i in range(len(FILTERS))
    ]
    tried = patterns.select("*", F.explode(F.array(*steps)).alias("at")).select("part", "failed", "docs", "good", "toxic", "at.*")
    fails, earlier = F.col("failed").bitwiseAND(F.col("bit")) > 0, F.col("failed").bitwiseAND(F.col("before")) > 0
    count = lambda where, what="docs": F.coalesce(F.sum(F.when(where, F.col(what))), F.lit(0)).cast("bigint")
    found = tried.groupBy("part", "filter_order", "step", "name").agg(
        count(~fails & ~earlier).alias("kept"),
        count(fails & ~earlier).alias("removed"),
        count(fails & earlier).alias("redundant"),
        count(F.col("failed") == F.col("bit")).alias("unique_fails"),
        count(fails & ~earlier, "good").alias("good_lost"),
        count(fails & ~earlier, "toxic").alias("toxic_lost"),
    )
    total = F.sum("removed").over(Window.partitionBy("part", "name"))
    return found.withColumn("shapley", total).drop("name")


def filter_audit(docs: DataFrame, labels: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The audit of all rows of ``docs`` (doc_id, text, lang), with ``labels`` (doc_id, quality, toxic).

    Words are runs without blanks, line and tab marks. A fails under 200 words, B with fewer than 50
    distinct of 100 words, C with more than 3 capitals of 100 code points, D with one of ``#$%&*|``,
    E if a smaller id has the same text. A null text is empty, a null language the empty part. Rows of
    one id and one text are all counted and are no copies of each other; a row without an id copies
    nothing, is copied by nothing and has no label. A document is good or toxic if any of its labels
    says so. No rows give no parts and no rows.
    """
    shards = shards_of(docs, shard_bytes)
    matrix = term_matrix(shards, codes_of(shards))
    return audit(materialize(patterns_of(flags_of(matrix), labels), "filter-patterns"))
