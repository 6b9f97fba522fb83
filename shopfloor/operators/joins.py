"""Joining a large table with a lookup of unknown size and keys of unknown skew."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopfloor.storage import materialize


@dataclass(frozen=True)
class JoinLimits:
    """When a lookup may be broadcast, and which keys count as hot otherwise."""

    broadcast_bytes: int = 64 * 1024 * 1024
    broadcast_rows: int = 1_000_000
    # A key with more rows is hot; there are at most rows / slice_rows of them.
    slice_rows: int = 1_000_000


DEFAULT_LIMITS = JoinLimits()


def _size_aggregates(df: DataFrame) -> list[Column]:
    width = F.lit(0)
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(F.col(field.name)), F.lit(0)) + F.lit(8)
        else:
            width = width + F.lit(16)
    return [F.count(F.lit(1)).alias("rows"), F.sum(width.cast("bigint")).alias("bytes")]


def measured_size(df: DataFrame) -> tuple[int, int]:
    """Rows and bytes of a flat table, counted by one aggregate."""
    row = df.agg(*_size_aggregates(df)).first()
    return row["rows"], row["bytes"] or 0


@dataclass(frozen=True)
class Measured:
    """A table and its size in rows and bytes."""

    df: DataFrame
    rows: int
    bytes: int

    def fits(self, limits: JoinLimits) -> bool:
        return self.rows <= limits.broadcast_rows and self.bytes <= limits.broadcast_bytes


def measure(df: DataFrame) -> Measured:
    return Measured(df, *measured_size(df))


def materialize_measured(df: DataFrame, label: str) -> Measured:
    """Write an expensive lookup once, measuring it on the way."""
    seen = Observation()
    written = materialize(df.observe(seen, *_size_aggregates(df)), label)
    found = seen.get
    if "rows" not in found:
        return measure(written)
    return Measured(written, found["rows"], found["bytes"] or 0)


def _match(left: Sequence[str], right: Sequence[str], null_safe: Sequence[str]) -> Column:
    condition = None
    for a, b in zip(left, right):
        same = F.col(a).eqNullSafe(F.col(b)) if a in null_safe else F.col(a) == F.col(b)
        condition = same if condition is None else condition & same
    return condition


def _prefixed(df: DataFrame, keys: Sequence[str], prefix: str) -> tuple[DataFrame, list[str]]:
    names = [prefix + key for key in keys]
    return df.withColumnsRenamed(dict(zip(keys, names))), names


def attach(
    facts: DataFrame,
    lookup: DataFrame | Measured,
    keys: Sequence[str],
    how: str = "inner",
    null_safe: Sequence[str] = (),
    limits: JoinLimits = DEFAULT_LIMITS,
    keys_from: DataFrame | None = None,
    slice_by: Sequence[str] | None = None,
) -> DataFrame:
    """Inner, left, left-semi or left-anti join of ``facts`` with ``lookup`` on equally named ``keys``.

    A row with a NULL key matches nothing unless the key is in ``null_safe``, so an anti join keeps it.
    A lookup whose measured size is within bounds is broadcast. Otherwise both sides are shuffled,
    with the rows of hot keys spread over slices by a hash of the row and the lookup rows of those
    keys repeated once per slice. Nothing is dropped on either way. Hot keys are counted in
    ``keys_from``, a cheaper table with the same keys, if ``facts`` is itself the result of joins.
    ``slice_by`` names the columns whose hash deals the rows of a hot key out, by default all.
    """
    measured = lookup if isinstance(lookup, Measured) else measure(lookup)
    if measured.fits(limits):
        renamed, right = _prefixed(measured.df, keys, "_r_")
        return facts.join(F.broadcast(renamed), _match(keys, right, null_safe), how).drop(*right)
    counted = facts if keys_from is None else keys_from
    # Used on both sides, which must agree on it; written once.
    hot = materialize(_hot_keys(counted, keys, limits), "hot-keys")
    return _sliced_join(facts, measured.df, hot, keys, how, null_safe, slice_by or facts.columns)


def _hot_keys(counted: DataFrame, keys: Sequence[str], limits: JoinLimits) -> DataFrame:
    """All hot keys and into how many slices each is cut."""
    return (
        counted.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > limits.slice_rows)
        .withColumn("_slices", F.ceil(F.col("_n") / F.lit(limits.slice_rows)).cast("bigint"))
        .drop("_n")
    )


def _sliced_join(
    facts: DataFrame,
    lookup: DataFrame,
    hot: DataFrame,
    keys: Sequence[str],
    how: str,
    null_safe: Sequence[str],
    slice_by: Sequence[str],
) -> DataFrame:
    # The list is a written table: Spark broadcasts it if its files are small and shuffles it otherwise.
    # NULL may be the hottest key, so the hot keys are matched null-safe.
    hot, hot_names = _prefixed(hot, keys, "_h_")
    on_hot = _match(keys, hot_names, keys)

    # The slice must be a function of the row: a retried task has to send it to the same place.
    slice_of_row = F.pmod(F.xxhash64(*slice_by), F.col("_slices"))
    facts = (
        facts.join(hot, on_hot, "left")
        .withColumn("_slice", F.when(F.col("_slices").isNotNull(), slice_of_row).otherwise(F.lit(0).cast("bigint")))
        .drop("_slices", *hot_names)
    )
    lookup = (
        lookup.join(hot, on_hot, "left")
        .withColumn("_slice", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("_slices", F.lit(1)) - 1)))
        .drop("_slices", *hot_names)
    )
    lookup, right = _prefixed(lookup, [*keys, "_slice"], "_r_")
    joined = facts.join(lookup, _match([*keys, "_slice"], right, null_safe), how)
    return joined.drop("_slice", *right)
