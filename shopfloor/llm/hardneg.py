"""Hard negatives from blocks of vectors along a Hilbert curve, read only where their zone maps allow.

Rows are sorted by label and then by their place on a Hilbert curve through a few random projections,
cut into blocks of ``BLOCK`` rows and written to Parquet, one row a block, with the least and the
greatest value of every dimension and the range of labels. For an anchor, interval arithmetic over a
block's zone map bounds the inner products it can hold from below and above; a block is read only
for anchors with a window that these bounds meet.

Positives and negatives are the same search: the k best rows of a window of scores, among rows of
the anchor's label or of others. The blocks with the highest bounds are read first. What they give
is a floor for the rest: a block that cannot reach the k-th score found is not read. Anchors and zone
maps meet in groups of bounded size, so nothing grows with the table but the number of groups.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopfloor.llm.common import checkpointed
from shopfloor.storage import materialize

BLOCK = 1024
#: Consecutive blocks whose zone maps, and whose anchors, are compared in one piece.
GROUP = 50
#: Coordinates and bits of each on the curve; their product fits a long.
AXES, AXIS_BITS = 15, 4
#: Blocks read first for each window.
SEEDS = 2
POSITIVES = NEGATIVES = 5
LEAST_PERCENT = 80
_LEAST, _MOST = -(2**63), 2**63 - 1


def hilbert(axes: np.ndarray, bits: int) -> np.ndarray:
    """The place on the Hilbert curve of points with whole coordinates of ``bits`` bits, one row a point."""
    x = axes.astype(np.uint64).copy()
    n = x.shape[1]
    one = np.uint64(1)
    for bit in range(bits - 1, 0, -1):
        below = (one << np.uint64(bit)) - one
        for i in range(n):
            high = (x[:, i] >> np.uint64(bit)) & one > 0
            swap = np.where(high, np.uint64(0), (x[:, 0] ^ x[:, i]) & below)
            x[:, 0] ^= np.where(high, below, swap)
            x[:, i] ^= swap
    for i in range(1, n):
        x[:, i] ^= x[:, i - 1]
    turn = np.zeros(len(x), np.uint64)
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where((x[:, n - 1] >> np.uint64(bit)) & one > 0, (one << np.uint64(bit)) - one, np.uint64(0))
    place = np.zeros(len(x), np.uint64)
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            place = (place << one) | (((x[:, i] ^ turn) >> np.uint64(bit)) & one)
    return place


def projected(vectors: np.ndarray) -> np.ndarray:
    """Whole coordinates of vectors of one length: random projections of their directions, cut at normal quantiles."""
    length = vectors.shape[1]
    if not length:
        return np.zeros((len(vectors), AXES), np.int64)
    drawn = np.random.default_rng([71, length]).standard_normal((length, AXES))
    x = vectors.astype(np.float64)
    size = np.sqrt((x**2).sum(axis=1, keepdims=True))
    made = np.divide(x, size, out=np.zeros_like(x), where=size > 0) @ drawn
    # 1.702 makes the logistic curve follow the normal distribution.
    share = 1 / (1 + np.exp(-1.702 * made))
    return np.minimum((share * (1 << AXIS_BITS)).astype(np.int64), (1 << AXIS_BITS) - 1)


def usable_rows(table: DataFrame, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "vector") -> DataFrame:
    """(vec_id, label, vector, length), one row per id: the one of the smallest label and vector.

    Rows with a null id, label or vector, or a null component, take no part.
    """
    columns = [F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).cast("bigint").alias("label"), F.col(vector_col).alias("vector")]
    usable = table.select(*columns).filter("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    usable = usable.filter(~F.exists("vector", lambda x: x.isNull()))
    least = usable.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row"))
    return least.select("vec_id", "row.label", "row.vector", F.size("row.vector").alias("length"))


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def placed(rows: DataFrame) -> DataFrame:
    """``rows`` with the number of their ``block``, by length, label and place on the curve; written once."""

    def curve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column(3).to_numpy()
            places = np.zeros(batch.num_rows, np.int64)
            for length in np.unique(lengths):
                own = np.flatnonzero(lengths == length)
                vectors = _matrix(batch.column(2).take(pa.array(own)), int(length))
                places[own] = hilbert(projected(vectors), AXIS_BITS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places)], [*batch.schema.names, "place"])

    fields = "vec_id bigint, label bigint, vector array<bigint>, length int"
    keyed = rows.select(*[f.split()[0] for f in fields.split(", ")]).mapInArrow(curve, fields + ", place bigint")
    order = ["length", "label", "place", "vec_id"]
    ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    # The number holds the task and the place in it.
    written = materialize(ranged.withColumn("number", F.monotonically_increasing_id()).drop("place"), "curve-order")
    task, inside = F.shiftright("number", 33), F.col("number").bitwiseAND(F.lit(2**33 - 1))
    counts = written.groupBy(task.alias("task")).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("task", F.coalesce(before, F.lit(0)).alias("offset"))
    # One row for each task that wrote.
    with_offset = written.withColumn("task", task).join(F.broadcast(offsets), "task")
    block = F.floor((F.col("offset") + inside) / F.lit(BLOCK)).cast("bigint")
    return with_offset.select("vec_id", "label", "vector", "length", block.alias("block"))


BLOCKS = "block bigint, length int, low array<bigint>, high array<bigint>, first_label bigint, last_label bigint, ids binary, labels binary, vectors binary, width int"


def _packed(vectors: np.ndarray) -> tuple[bytes, int]:
    """The numbers as bytes of the narrowest whole type, and its width."""
    most = max(int(vectors.max(initial=0)), -int(vectors.min(initial=0)) - 1, 0)
    if vectors.shape[1] * (most + 1) ** 2 > _MOST:
        raise ValueError("inner products of these vectors would not fit 64 bits")
    width = next(w for w in (2, 4, 8) if most < 1 << (8 * w - 1))
    return vectors.astype(f"<i{width}").tobytes(), width


def _unpacked(data: bytes, width: int, length: int) -> np.ndarray:
    made = np.frombuffer(data, f"<i{width}").astype(np.int64)
    return made.reshape(-1, length) if length else made.reshape(0, 0)


def blocks_of(rows: DataFrame) -> DataFrame:
    """The blocks with their zone maps, written to Parquet: a zone map is read without its vectors."""

    def pack(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by([("label", "ascending"), ("vec_id", "ascending")])
        length = key[1].as_py()
        vectors = _matrix(table.column("vector"), length)
        labels = table.column("label").to_numpy()
        data, width = _packed(vectors)
        # Labels once for each vector, also where vectors have no dimension.
        values = [key[0].as_py(), length, vectors.min(axis=0).tolist(), vectors.max(axis=0).tolist(), int(labels[0]), int(labels[-1])]
        values += [table.column("vec_id").to_numpy().tobytes(), labels.tobytes(), data, width]
        return pa.Table.from_arrays([pa.array([v], t) for v, t in zip(values, _BLOCK_TYPES)], [f.split()[0] for f in BLOCKS.split(", ")])

    packed = rows.groupBy("block", "length").applyInArrow(pack, BLOCKS)
    return materialize(packed.withColumn("group", F.floor(F.col("block") / GROUP).cast("bigint")), "vector-blocks")


_LONGS = pa.list_(pa.int64())
_BLOCK_TYPES = [pa.int64(), pa.int32(), _LONGS, _LONGS, pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int32()]
ASKS = "part bigint, length int, ids binary, labels binary, vectors binary, width int, owners binary, slots binary, lows binary, highs binary"


def _asks(windows: DataFrame) -> DataFrame:
    """Windows (part, anchor_id, label, vector, length, slot, low, high), packed to one row for each part and length."""

    def pack(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by([("anchor_id", "ascending"), ("slot", "ascending")])
        ids = table.column("anchor_id").to_numpy()
        first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        owners = np.cumsum(np.concatenate([[False], ids[1:] != ids[:-1]]))
        length = key[1].as_py()
        data, width = _packed(_matrix(table.column("vector").combine_chunks().take(pa.array(first)), length))
        values = [key[0].as_py(), length, ids[first].tobytes(), table.column("label").to_numpy()[first].tobytes(), data, width]
        values += [owners.astype(np.int64).tobytes(), table.column("slot").to_numpy().astype(np.int64).tobytes()]
        values += [table.column(c).to_numpy().tobytes() for c in ("low", "high")]
        types = [pa.int64(), pa.int32(), *[pa.binary()] * 3, pa.int32(), *[pa.binary()] * 4]
        return pa.Table.from_arrays([pa.array([v], t) for v, t in zip(values, types)], [f.split()[0] for f in ASKS.split(", ")])

    return windows.groupBy("part", "length").applyInArrow(pack, ASKS)


class _Asked:
    """One packed row of windows."""

    def __init__(self, row: dict):
        read = lambda name: np.frombuffer(row[name], np.int64)
        self.ids, self.labels, self.owners, self.slots, self.lows, self.highs = map(read, ("ids", "labels", "owners", "slots", "lows", "highs"))
        self.vectors = _unpacked(row["vectors"], row["width"], row["length"])
        if not row["length"]:
            self.vectors = np.zeros((len(self.ids), 0), np.int64)


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of ``left`` with all of ``right``; in floating point only where that is exact."""
    most = [max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) for x in (left, right)]
    if left.shape[1] * most[0] * most[1] < 2**53:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    return left @ right.T


def bounds(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and the greatest inner product of each anchor with any vector between ``low`` and ``high``, by block."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return products(up, low) + products(down, high), products(up, high) + products(down, low)


def _candidates(blocks: DataFrame, asks: DataFrame, groups: int, same: bool) -> DataFrame:
    """(part, length, owner, row, block, upper): the blocks that a window's bounds and labels do not rule out.

    ``row`` is the window's place in its packed row.
    """
    zones = blocks.select("group", "block", "length", "low", "high", "first_label", "last_label")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
    zones, asking = zones.withColumn("part", every(groups)), asks.withColumn("group", every(groups))

    def choose(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        out = [np.zeros(0, np.int64)] * 4
        if left.num_rows and right.num_rows:
            asked = _Asked(right.to_pylist()[0])
            length = key[2].as_py()
            low, high = (_matrix(left.column(c), length) for c in ("low", "high"))
            least, most = bounds(asked.vectors, low, high)
            first, last = (left.column(c).to_numpy()[None, :] for c in ("first_label", "last_label"))
            labels = asked.labels[:, None]
            may = (first <= labels) & (labels <= last) if same else (first != labels) | (last != labels)
            rows = asked.owners
            meets = may[rows] & (most[rows] >= asked.lows[:, None]) & (least[rows] <= asked.highs[:, None])
            row, zone = np.nonzero(meets)
            out = [rows[row], row, left.column("block").to_numpy()[zone], most[rows[row], zone]]
        n = len(out[0])
        part, length = (pa.array(np.full(n, key[i].as_py() or 0), t) for i, t in ((1, pa.int64()), (2, pa.int32())))
        return pa.Table.from_arrays([part, length, *(pa.array(x.astype(np.int64)) for x in out)], ["part", "length", "owner", "row", "block", "upper"])

    keys = ["group", "part", "length"]
    schema = "part bigint, length int, owner bigint, row bigint, block bigint, upper bigint"
    return zones.groupBy(*keys).cogroup(asking.groupBy(*keys)).applyInArrow(choose, schema)


def _read(chosen: DataFrame, blocks: DataFrame, asks: DataFrame, same: bool, k: int) -> DataFrame:
    """(anchor_id, slot, vec_id, score): the best k of each chosen block for each of its windows."""
    wanted = chosen.groupBy("block", "part", "length").agg(F.collect_list("row").alias("rows"))
    keys = ["block", "part", "length"]
    data = blocks.select("block", "length", "ids", "labels", "vectors", "width")
    # A piece is one block and one part: bounded rows on both sides.
    left = wanted.select(*keys).join(data, ["block", "length"])
    left = left.toDF(*left.columns)
    right = wanted.join(asks, ["part", "length"])

    def search(key: tuple[pa.Scalar, ...], block: pa.Table, ask: pa.Table) -> pa.Table:
        out = [[np.zeros(0, np.int64)] for _ in range(4)]
        if block.num_rows and ask.num_rows:
            held, row = block.to_pylist()[0], ask.to_pylist()[0]
            asked, rows = _Asked(row), np.array(row["rows"])
            ids, labels = (np.frombuffer(held[c], np.int64) for c in ("ids", "labels"))
            vectors = _unpacked(held["vectors"], held["width"], held["length"]) if held["length"] else np.zeros((len(ids), 0), np.int64)
            owners, at = np.unique(asked.owners[rows], return_inverse=True)
            scores = products(asked.vectors[owners], vectors)
            ours = (labels[None, :] == asked.labels[owners][:, None]) == same
            ours &= ids[None, :] != asked.ids[owners][:, None]
            for i, r in zip(at, rows):
                of = np.flatnonzero(ours[i] & (scores[i] >= asked.lows[r]) & (scores[i] <= asked.highs[r]))
                if len(of) > k:
                    # Those below the k-th score go before ties are settled by id.
                    of = of[scores[i][of] >= np.partition(scores[i][of], -k)[-k]]
                best = of[np.lexsort((ids[of], -scores[i][of]))[:k]]
                for column, value in zip(out, (np.full(len(best), asked.ids[asked.owners[r]]), np.full(len(best), asked.slots[r]), ids[best], scores[i][best])):
                    column.append(value)
        return pa.Table.from_arrays([pa.array(np.concatenate(x)) for x in out], ["anchor_id", "slot", "vec_id", "score"])

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, "anchor_id bigint, slot bigint, vec_id bigint, score bigint")


def best_in_windows(windows: DataFrame, blocks: DataFrame, k: int, same: bool) -> tuple[DataFrame, DataFrame]:
    """The k best rows of every window, as (anchor_id, slot, vec_id, score, place), and the (part, block, row) read for them.

    ``same`` asks for rows of the anchor's own label, else for those of others; an anchor itself is
    never among them. Equal scores are in the order of their ids.
    """
    groups = (blocks.agg(F.max("group")).first()[0] or 0) + 1
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
    best = lambda found: found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)

    asks = checkpointed(_asks(windows))
    highest = F.row_number().over(Window.partitionBy("part", "length", "row").orderBy(F.desc("upper"), "block"))
    seeds = _candidates(blocks, asks, groups, same).withColumn("order", highest).filter(F.col("order") <= SEEDS).drop("order")
    seeds = checkpointed(seeds)
    first = checkpointed(best(_read(seeds, blocks, asks, same, k)))

    # With k rows found, only blocks that may reach the least of them are still of use.
    floors = first.filter(F.col("place") == k).select("anchor_id", "slot", F.col("score").alias("floor"))
    narrowed = windows.join(floors, ["anchor_id", "slot"], "left").withColumn("low", F.greatest("low", "floor")).drop("floor")
    asks = checkpointed(_asks(narrowed))
    rest = _candidates(blocks, asks, groups, same).join(seeds.select("part", "length", "row", "block"), ["part", "length", "row", "block"], "left_anti")
    rest = checkpointed(rest)
    second = _read(rest, blocks, asks, same, k)
    read = seeds.select("part", "length", "block", "row").unionByName(rest.select("part", "length", "block", "row"))
    return checkpointed(best(first.drop("place").unionByName(second))), read


def hard_negatives(
    rows: DataFrame,
    anchors: DataFrame,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least_percent: int = LEAST_PERCENT,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows`` are as ``usable_rows`` returns them, with whole numbers whose inner products fit 64 bits
    (else the job fails), and ``anchors`` has the ``vec_id`` of those to be anchors. An anchor's
    positives are its ``positives`` best other rows of its label; to each belong the ``negatives``
    best rows of other labels that score no more than it and ``least_percent`` hundredths of it at
    least. Fewer are returned where there are fewer; a positive with a negative score has none, as no
    score is in its window. Only vectors of one length are compared. No rows give no rows.
    """
    at = placed(rows)
    blocks = blocks_of(at)
    chosen = anchors.select("vec_id").distinct()
    part = F.floor(F.col("block") / GROUP).cast("bigint").alias("part")
    asking = at.join(chosen, "vec_id", "left_semi").select(part, F.col("vec_id").alias("anchor_id"), "label", "vector", "length")
    asking = checkpointed(asking)
    limits = [F.lit(0).cast("bigint").alias("slot"), F.lit(_LEAST).cast("bigint").alias("low"), F.lit(_MOST).cast("bigint").alias("high")]
    near, _ = best_in_windows(asking.select("*", *limits), blocks, positives, True)
    near = near.select("anchor_id", F.col("place").cast("bigint").alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    # ceil(least_percent * score / 100), in whole numbers.
    score = F.col("positive_score").cast("decimal(38,0)")
    low = F.ceil(score * least_percent / F.lit(100)).cast("bigint").alias("low")
    windows = asking.join(near.select("anchor_id", "slot", low, F.col("positive_score").alias("high")), "anchor_id").filter("low <= high")
    found, _ = best_in_windows(windows, blocks, negatives, False)
    named = found.join(near, ["anchor_id", "slot"])
    return named.select(
        "anchor_id",
        "positive_id",
        F.col("place").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
