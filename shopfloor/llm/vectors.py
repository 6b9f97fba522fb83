"""Exact top-k by inner product with pivot-table elimination.

Each vector's distances to a few pivot vectors are computed once and written as the pivot table. For a
query q and a vector v the triangle inequality gives d(q, v) >= |d(q, p) - d(v, p)| for every pivot p;
with the largest of these, q.v = (|q|^2 + |v|^2 - d^2) / 2 has an upper bound.

Vectors with the same nearest pivot form a cell, cut into blocks of bounded size, and each block keeps
the range of its distances to every pivot. A query is first asked in a block of its own cell; the k-th
score found there is its floor. Then a block is read for a group of queries only if, by its ranges,
it may reach the floor of one of them. Inside a block candidates are scored in the order of their
bounds until the bound falls below the floor or the k-th score found.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopfloor.llm.common import checkpointed, small_batches
from shopfloor.operators.joins import attach

PIVOTS = 32
VECTOR_BLOCK = 16384
QUERY_BLOCK = 8192
# Blocks of which one task looks at the ranges, for one group of queries.
RANGE_SLICE = 512
# Inner products below this are exact in floating point.
EXACT = float(1 << 52)
# Pivots are kept for the most frequent vector lengths; vectors of other lengths are scored without elimination.
PIVOT_LENGTHS = 64
# Rows from which pivots are picked for a length, the farthest from those picked so far first.
PIVOT_SAMPLE = 512


def whole_numbers(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of each component; null if the vector or one of its components is null or not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~bad, F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double"))))


def usable_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "vector") -> DataFrame:
    """(vec_id, vector, length), one row per id: of several vectors the smallest; null ids and vectors take no part."""
    return (
        table.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).alias("vector"))
        .filter("vec_id IS NOT NULL AND vector IS NOT NULL")
        .groupBy("vec_id")
        .agg(F.min("vector").alias("vector"))
        .withColumn("length", F.size("vector"))
    )


def _matrix(table: pa.Table, name: str, width: int, kind: type) -> np.ndarray:
    values = table.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return values.astype(kind).reshape(table.num_rows, width)


def _norms(rows: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", rows, rows)


def _distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows to all pivots, up to a small part of the norms."""
    a, b = rows.astype(np.float64), pivots.astype(np.float64)
    return np.sqrt(np.maximum(_norms(a)[:, None] + _norms(b)[None, :] - 2 * (a @ b.T), 0))


def choose_pivots(vectors: DataFrame, pivots: int = PIVOTS) -> dict[int, np.ndarray]:
    """For each frequent length, vectors of a bounded sample that lie far from each other."""
    lengths = [r["length"] for r in vectors.groupBy("length").count().orderBy(F.desc("count"), "length").limit(PIVOT_LENGTHS).collect()]
    place = F.row_number().over(Window.partitionBy("length").orderBy(F.xxhash64("vec_id"), "vec_id"))
    sample = vectors.filter(F.col("length").isin(lengths)).withColumn("place", place).filter(F.col("place") <= PIVOT_SAMPLE)
    found: dict[int, list] = {}
    for row in sample.orderBy("length", "place").select("length", "vector").collect():
        found.setdefault(row["length"], []).append(row["vector"])
    chosen = {}
    for length, rows in found.items():
        points = np.array(rows, dtype=np.int64).reshape(len(rows), length)
        picked = [0]
        nearest = _distances(points, points[:1])[:, 0]
        while len(picked) < min(pivots, len(points)) and nearest.max() > 0:
            picked.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, _distances(points, points[picked[-1:]])[:, 0])
        chosen[length] = points[picked]
    return chosen


def pivot_table(vectors: DataFrame, chosen: dict[int, np.ndarray]) -> DataFrame:
    """(vec_id, vector, length, home, norm, far): the nearest pivot, -1 without any, the length squared and the distances to all pivots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "vector", 8_000_000):
            lengths = batch.column("length").to_numpy()
            for length in np.unique(lengths):
                table = pa.Table.from_batches([batch.take(pa.array(np.flatnonzero(lengths == length)))])
                rows = _matrix(table, "vector", int(length), np.float64)
                far = _distances(rows, chosen.get(int(length), np.zeros((0, length))))
                home = far.argmin(axis=1) if far.shape[1] else np.full(len(rows), -1)
                table = table.append_column("home", pa.array(home, pa.int32())).append_column("norm", pa.array(_norms(rows)))
                yield from table.append_column("far", pa.array(list(far.astype(np.float32)), pa.list_(pa.float32()))).to_batches()

    schema = "vec_id bigint, vector array<bigint>, length int, home int, norm double, far array<float>"
    return vectors.select("vec_id", "vector", "length").mapInArrow(run, schema)


def _most(norm, query_norm, gap, reach):
    """Upper bounds of inner products from lower bounds ``gap`` of distances; ``reach`` bounds the pivots' norms."""
    # Distances are rounded to single precision, and lose what is small against the norms.
    slack = 1e-6 * (np.sqrt(norm) + np.sqrt(query_norm) + reach)
    return (norm + query_norm - np.maximum(gap - slack, 0) ** 2) / 2 + 1e-9 * (norm + query_norm) + 1


def _range_gaps(low: np.ndarray, high: np.ndarray, far: np.ndarray) -> np.ndarray:
    """Least distance of each query to the members of each block, by the blocks' ranges of distances to the pivots."""
    gap = np.zeros((len(far), len(low)))
    for p in range(far.shape[1]):
        asked = far[:, p : p + 1]
        np.maximum(gap, low[None, :, p] - asked, out=gap)
        np.maximum(gap, asked - high[None, :, p], out=gap)
    return gap


def _best(rows, ids, most, query, query_id, floor, k):
    """The k best (score, id) among the rows and how many were scored.

    Scores below ``floor`` are left out; a row left unscored has a bound below the floor or the k-th score.
    """
    order = np.flatnonzero((most >= floor) & (ids != query_id))
    order = order[np.argsort(-most[order], kind="stable")]
    scores, found, at, step = np.zeros(0, np.int64), np.zeros(0, np.int64), 0, max(4 * k, 64)
    while at < len(order):
        if len(scores) == k and most[order[at]] < scores[-1]:
            break
        here = order[at : at + step]
        products = rows[here] @ query
        # Of most candidates the score itself is below what is kept.
        good = np.flatnonzero(products >= (scores[-1] if len(scores) == k else floor))
        scores = np.concatenate([scores, products[good].astype(np.int64)])
        found = np.concatenate([found, ids[here[good]]])
        keep = np.lexsort((found, -scores))[:k]
        scores, found = scores[keep], found[keep]
        at, step = at + len(here), step * 4
    return scores, found, at


def _search_in(chosen: dict[int, np.ndarray], k: int, own_block: bool):
    """The search of a block's vectors (left) for queries (right): k rows for a query at most, and one without a vec_id.

    That row holds the k-th score, if there are as many, and the number of vectors scored. Unless
    ``own_block``, queries whose own block this is are left out.
    """

    def search(key, left: pa.Table, right: pa.Table) -> pa.Table:
        length, home, part = (int(x.as_py()) for x in key[:3])
        out = [[], [], [], []]
        if right.num_rows and not own_block:
            other = (right.column("home").to_numpy() != home) | (right.column("part").to_numpy() != part)
            right = right.filter(pa.array(other))
        if left.num_rows and right.num_rows:
            points = chosen.get(length, np.zeros((0, length)))
            reach = np.sqrt(_norms(points.astype(np.float64)).max(initial=0))
            norms, norms_asks = (t.column("norm").to_numpy() for t in (left, right))
            exact = np.sqrt(norms.max() * norms_asks.max()) < EXACT
            rows, asks = (_matrix(t, "vector", length, np.float64 if exact else np.int64) for t in (left, right))
            far, far_asks = (_matrix(t, "far", len(points), np.float32) for t in (left, right))
            ids, names = (t.column("vec_id").to_numpy() for t in (left, right))
            floors = right.column("floor").cast(pa.float64()).to_numpy(zero_copy_only=False)
            # Rounded to a double, a floor may only get smaller.
            floors = np.where(np.isnan(floors), -np.inf, floors - np.abs(floors) * 1e-15)
            gaps = _range_gaps(far.min(axis=0)[None, :], far.max(axis=0)[None, :], far_asks)[:, 0]
            columns = np.ascontiguousarray(far.T)
            hopeful = _most(norms.max(), norms_asks, gaps, reach) >= floors
            for i in np.flatnonzero(hopeful):
                gap = np.abs(columns - far_asks[i][:, None]).max(axis=0) if len(points) else np.zeros(len(rows))
                most = _most(norms, norms_asks[i], gap, reach)
                scores, found, scored = _best(rows, ids, most, asks[i], names[i], floors[i], k)
                out[0] += [names[i]] * (len(found) + 1)
                out[1] += [*found.tolist(), None]
                out[2] += [*scores.tolist(), int(scores[-1]) if len(scores) == k else None]
                out[3] += [0] * len(found) + [scored]
        columns = [pa.array(x, pa.int64()) for x in out]
        return pa.Table.from_arrays(columns, ["query_id", "vec_id", "score", "scored"])

    return search


_FOUND = "query_id bigint, vec_id bigint, score bigint, scored bigint"
_BLOCK = ["length", "home", "part"]


def _block_ranges(table: DataFrame, pivots: int) -> DataFrame:
    """(length, home, part, norm, low, high): the largest norm and the ranges of distances of every block."""
    ends = [f(F.get("far", F.lit(i))).alias(f"{f.__name__}{i}") for i in range(pivots) for f in (F.min, F.max)]
    ranges = table.groupBy(*_BLOCK).agg(F.max("norm").alias("norm"), *ends)
    # Vectors of a length can have fewer pivots than others.
    array = lambda name: F.array_compact(F.array(*[F.col(f"{name}{i}") for i in range(pivots)]))
    return ranges.select(*_BLOCK, "norm", array("min").alias("low"), array("max").alias("high"))


def _blocks_to_read(ranges: DataFrame, asked: DataFrame, chosen: dict[int, np.ndarray]) -> DataFrame:
    """(length, home, part, group, slice): the blocks that a query of the group may find a better vector in."""

    def choose(key, left: pa.Table, right: pa.Table) -> pa.Table:
        length, group, slice_ = (int(x.as_py()) for x in key)
        chosen_blocks = np.zeros(left.num_rows, bool)
        if left.num_rows and right.num_rows:
            points = chosen.get(length, np.zeros((0, length)))
            reach = np.sqrt(_norms(points.astype(np.float64)).max(initial=0))
            low, high = (_matrix(left, c, len(points), np.float32) for c in ("low", "high"))
            far = _matrix(right, "far", len(points), np.float32)
            norm, norms_asks = (t.column("norm").to_numpy() for t in (left, right))
            home, part = (left.column(c).to_numpy() for c in ("home", "part"))
            own_home, own_part = (right.column(c).to_numpy(zero_copy_only=False) for c in ("home", "part"))
            floors = right.column("floor").cast(pa.float64()).to_numpy(zero_copy_only=False)
            floors = np.where(np.isnan(floors), -np.inf, floors - np.abs(floors) * 1e-15)
            for at in range(0, len(far), 256):
                some = slice(at, at + 256)
                most = _most(norm[None, :], norms_asks[some, None], _range_gaps(low, high, far[some]), reach)
                other = (own_home[some, None] != home[None, :]) | (own_part[some, None] != part[None, :])
                chosen_blocks |= ((most >= floors[some, None]) & other).any(axis=0)
        table = left.select(_BLOCK).filter(pa.array(chosen_blocks))
        for name, value in (("group", group), ("slice", slice_)):
            table = table.append_column(name, pa.array([value] * table.num_rows, pa.int32()))
        return table

    schema = "length int, home int, part int, group int, slice int"
    thin = asked.select("length", "group", "slice", "home", "part", "norm", "far", "floor").groupBy("length", "group", "slice")
    return ranges.groupBy("length", "for_group", "slice").cogroup(thin).applyInArrow(choose, schema)


def matches(vectors: DataFrame, queries: DataFrame, k: int, pivots: int, vector_block: int, query_block: int) -> DataFrame:
    """(query_id, vec_id, score, scored): for each query its k best vectors among others.

    Rows without a vec_id tell by ``scored`` how many vectors were scored for a query in a block.
    """
    vectors = checkpointed(vectors)
    chosen = choose_pivots(vectors, pivots)
    table, asked = checkpointed(pivot_table(vectors, chosen)), checkpointed(pivot_table(queries, chosen))
    # Equal on a retry: a function of the id. Cells are bounded by pivots for each length.
    dealt = lambda n: F.pmod(F.xxhash64("vec_id"), n)
    parts = table.groupBy("length", "home").agg(F.ceil(F.count(F.lit(1)) / F.lit(vector_block)).cast("int").alias("parts"))
    parts = checkpointed(parts)
    # A query in a cell without vectors has no block of its own.
    with_part = lambda df: attach(df, parts, ["length", "home"], "left").withColumn(
        "part", F.coalesce(dealt(F.col("parts")), F.lit(-1)).cast("int")
    ).drop("parts")
    table = with_part(table)
    # Queries of neighbouring cells share a group.
    cells = asked.groupBy("length", "home").agg(F.count(F.lit(1)).alias("n"))
    cells = cells.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("home")) - F.col("n"))
    asked = attach(with_part(asked), checkpointed(cells), ["length", "home"])
    asked = asked.withColumn("group", F.floor((F.col("before") + dealt(F.col("n"))) / F.lit(query_block)).cast("int")).drop("before", "n")

    first = (
        table.groupBy(*_BLOCK)
        .cogroup(asked.withColumn("floor", F.lit(None).cast("bigint")).groupBy(*_BLOCK))
        .applyInArrow(_search_in(chosen, k, own_block=True), _FOUND)
    )
    first = checkpointed(first)
    floors = first.filter("vec_id IS NULL").select(F.col("query_id").alias("vec_id"), F.col("score").alias("floor"))
    asked = checkpointed(asked.join(floors, "vec_id", "left"))

    ranges = checkpointed(_block_ranges(table, pivots))
    slices = max(1, -(-ranges.count() // RANGE_SLICE))
    ranges = ranges.withColumn("slice", F.pmod(F.xxhash64(*_BLOCK), F.lit(slices)).cast("int"))
    groups = checkpointed(asked.select("length", F.col("group").alias("for_group")).distinct())
    ranges = attach(ranges, groups, ["length"])
    asked = asked.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    pairs = checkpointed(_blocks_to_read(ranges, asked, chosen))

    # The block that a row of queries is sent to, beside the query's own.
    other = asked.join(pairs.withColumnsRenamed({"home": "at_home", "part": "at_part"}), ["length", "group", "slice"])
    held = table.join(pairs.select(*_BLOCK, F.col("group").alias("for_group")), _BLOCK)
    rest = (
        held.groupBy(*_BLOCK, "for_group")
        .cogroup(other.groupBy("length", "at_home", "at_part", "group"))
        .applyInArrow(_search_in(chosen, k, own_block=False), _FOUND)
    )
    return first.unionByName(rest)


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    pivots: int = PIVOTS,
    vector_block: int = VECTOR_BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """The k best vectors for each query: (query_id, rank, vec_id, score), ties to the smaller id.

    Both tables are as ``usable_vectors`` returns them, with whole numbers whose inner products fit
    64 bits. A query is compared with all vectors of its length but the one with its own id; with
    fewer than k of them all are returned. An empty table gives no rows.
    """
    found = matches(vectors, queries, k, pivots, vector_block, query_block).filter("vec_id IS NOT NULL")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
