"""Near duplicates by b-bit MinHash, confirmed on full shingle sets, as connected classes.

Texts with the same set are one class from the start, so a group of copies is one row. Of the
others, bands of minima give candidates; the low bits of all minima, packed, estimate the similarity
corrected for chance agreement; what may reach the threshold is confirmed on the sets.

As only the classes are wanted, a bucket need not give all its pairs. First, every member is compared
with the centre of each of its buckets: the member that meets most others over all bands, as the
original of many edited copies does. Then, in buckets whose members are still of different classes,
all pairs of different classes are compared inside the join, by sketches alone, so that only pairs
that may be links leave it; large buckets are dealt over slices before that, and each pair of slices
is joined for itself. A sketch holds the packed bits and parities: for each of 1,024 places, whether
an odd number of shingles falls there. Every place that differs needs a shingle of one set only, so
too many of them rule a pair out for certain. Whole sets are made for the pairs left over only.
"""

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopfloor.llm.common import checkpointed, id_and_text, small_batches, texts_of
from shopfloor.operators.joins import attach

WORDS = 5
PERCENT = 75
BANDS, ROWS = 24, 4
BITS = 4
SLICE = 256
PARITY_LONGS = 16
# Buckets with more members of different classes than this are dealt over slices of half as many.
SPLIT_ABOVE = 4096

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_drawn = np.random.default_rng(20).integers(1, 2**63, size=(3, 256), dtype=np.uint64)
_FACTORS, _OFFSETS, _PLACES = _drawn[0] | np.uint64(1), _drawn[1], _drawn[2] | np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; one for the whole text if it has fewer words, none without words."""
    parts = text.encode("utf-8").translate(_LOWER).split()
    if not parts:
        return np.zeros(0, np.uint64)
    if len(parts) < words:
        return np.array([xxhash.xxh64_intdigest(b" ".join(parts), seed=len(parts))], np.uint64)
    hashed = np.fromiter(map(xxhash.xxh64_intdigest, parts), np.uint64, len(parts))
    n = len(parts) - words + 1
    total = np.zeros(n, np.uint64)
    for i in range(words):
        total += hashed[i : i + n] * _PLACES[i]
    return np.unique(_mixed(total))


def minima(found: np.ndarray, count: int) -> np.ndarray:
    """The smallest value of each hash function over the set."""
    least = np.full(count, np.iinfo(np.uint64).max)
    for start in range(0, len(found), 4096):
        part = found[start : start + 4096, None] * _FACTORS[:count] + _OFFSETS[:count]
        np.minimum(least, (part ^ (part >> np.uint64(29))).min(axis=0), out=least)
    return least


def _signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64).view(np.int64)


def parity(found: np.ndarray) -> np.ndarray:
    """One bit for each place: whether the number of shingles that fall there is odd."""
    places = (found >> np.uint64(20)) % np.uint64(PARITY_LONGS * 64)
    odd = np.bincount(places.astype(np.int64), minlength=PARITY_LONGS * 64) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def signatures(docs: DataFrame, words: int = WORDS, bands: int = BANDS, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, n_shingles, set_hash, bands, bits, odd): hashes of the text and of the set, one of each band, the packed low bits and parities."""
    per_long = 64 // BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift = (np.arange(per_long) * BITS).astype(np.uint64)
        for batch in small_batches(batches, "text"):
            sizes, hashes, keys, packed, odd = [], [], [], [], []
            for text in texts_of(batch, "text"):
                found = shingles(text, words)
                sizes.append(len(found))
                if not len(found):
                    hashes.append(None), keys.append(None), packed.append(None), odd.append(None)
                    continue
                least = minima(found, bands * rows)
                hashes.append(xxhash.xxh128_digest(found.tobytes()))
                band = np.zeros(bands, np.uint64)
                for i in range(rows):
                    band = _mixed(band + least.reshape(bands, rows)[:, i] * _PLACES[i])
                keys.append(_signed(band))
                low = np.zeros(-(-bands * rows // per_long) * per_long, np.uint64)
                low[: bands * rows] = _mixed(least) >> np.uint64(64 - BITS)
                packed.append(_signed((low.reshape(-1, per_long) << shift).sum(axis=1, dtype=np.uint64)))
                odd.append(parity(found))
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (keys, packed, odd)]
            columns = [batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(hashes, pa.binary()), *lists]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "n_shingles", "set_hash", "bands", "bits", "odd"])

    schema = "doc_id bigint, text_key bigint, n_shingles bigint, set_hash binary, bands array<bigint>, bits array<bigint>, odd array<bigint>"
    return _own(docs, id_col, text_col).mapInArrow(run, schema)


def _own(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text, text_key): rows of one id are told apart by a hash of their texts."""
    return id_and_text(docs, id_col, text_col).withColumn("text_key", F.xxhash64("text"))


def shingle_sets(texts: DataFrame, words: int = WORDS) -> DataFrame:
    """(member, found) with the whole set of each (member, text) as an array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", 2_000_000):
            sets = pa.array([_signed(shingles(text, words)) for text in texts_of(batch, "text")], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), sets], ["member", "found"])

    return texts.select("member", "text").mapInArrow(run, "member bigint, found array<bigint>")


def _agreeing(left: Sequence[Column], right: Sequence[Column], hashes: int) -> Column:
    """How many of the packed values are equal, by counting bits."""
    total = F.lit(0)
    for a, b in zip(left, right):
        x = a.bitwiseXOR(b)
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        total = total + F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))
    return F.lit(hashes) - total


def likely(left: Sequence[Column], right: Sequence[Column], percent: int, hashes: int) -> Column:
    """Whether the estimate is not five standard errors below the threshold.

    Unequal minima agree in their low bits by chance once in 2**BITS, which the estimate corrects.
    """
    chance, wanted = 2.0**-BITS, percent / 100
    error = (wanted * (1 - wanted) / hashes) ** 0.5 / (1 - chance)
    agree = _agreeing(left, right, hashes)
    return (agree / F.lit(float(hashes)) - chance) / (1 - chance) >= wanted - 5 * error


def _may_link(left: Sequence[Column], right: Sequence[Column], total: Column, percent: int) -> Column:
    """False only if the parities differ in more places than linked sets, of ``total`` shingles together, can."""
    differing = F.lit(0)
    for a, b in zip(left, right):
        differing = differing + F.bit_count(a.bitwiseXOR(b))
    return differing * (100 + percent) <= total.cast("bigint") * (100 - percent)


def _sketches(classes: DataFrame, hashes: int) -> DataFrame:
    """(member, n, b0 .., o0 ..): the packed bits and the parities of each class, a column for each long."""
    longs = [F.col("bits")[i].alias(f"b{i}") for i in range(-(-hashes * BITS // 64))]
    return classes.select("member", F.col("n_shingles").alias("n"), *longs, *[F.col("odd")[i].alias(f"o{i}") for i in range(PARITY_LONGS)])


def _near(x: str, y: str, percent: int, hashes: int) -> Column:
    """Whether the sketches of two aliased rows leave it open that their sets are linked."""
    side = lambda s, c, n: [F.col(f"{s}.{c}{i}") for i in range(n)]
    longs = -(-hashes * BITS // 64)
    small, large = F.least(f"{x}.n", f"{y}.n"), F.greatest(f"{x}.n", f"{y}.n")
    may = _may_link(side(x, "o", PARITY_LONGS), side(y, "o", PARITY_LONGS), F.col(f"{x}.n") + F.col(f"{y}.n"), percent)
    return (small * 100 >= large * percent) & likely(side(x, "b", longs), side(y, "b", longs), percent, hashes) & may


def _members(classes: DataFrame) -> DataFrame:
    """(key, member, band) of buckets with two members or more."""
    rows = classes.select("member", F.posexplode("bands").alias("band", "value"))
    rows = rows.select("member", "band", F.xxhash64("band", "value").alias("key"))
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    return rows.join(shared, "key")


def _star_pairs(members: DataFrame) -> DataFrame:
    """Each member (key, member, size) with the centre of its bucket, as pairs (a, b) with a < b.

    The centre is the member whose buckets hold most rows; equal ones are told apart the same way in
    every bucket, so alike buckets have the same centre and their pairs coincide. Large buckets are
    dealt over slices, and the centre with them.
    """
    slices = F.ceil(F.col("size") / F.lit(SLICE)).cast("bigint")
    met = members.groupBy("member").agg(F.sum("size").alias("met"))
    ranked = members.join(met, "member").withColumn("slice", F.pmod(F.xxhash64("key", "member"), slices))
    centres = ranked.groupBy("key", "size").agg(F.min(F.struct(-F.col("met"), "member")).alias("centre"))
    per_slice = centres.select("key", "centre.member", F.explode(F.sequence(F.lit(0).cast("bigint"), slices - 1)).alias("slice"))
    dealt = ranked.select("key", "slice", F.col("member").alias("x"))
    pairs = dealt.join(per_slice.withColumnRenamed("member", "y"), ["key", "slice"]).filter("x <> y")
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _likely_pairs(pairs: DataFrame, sketches: DataFrame, percent: int, hashes: int) -> DataFrame:
    x, y = sketches.alias("x"), sketches.alias("y")
    joined = pairs.join(x, F.col("a") == F.col("x.member")).join(y, F.col("b") == F.col("y.member"))
    return joined.filter(_near("x", "y", percent, hashes)).select("a", "b")


def _open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members of buckets that hold different labels: (key, band, member, label, size)."""
    labelled = members.drop("size").join(labels, "member", "left").withColumn("label", F.coalesce("label", "member"))
    labelled = checkpointed(labelled)
    mixed = labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("size"))
    return labelled.join(mixed.filter("low <> high").select("key", "size"), "key")


def _linked(left: Column, right: Column, percent: int) -> Column:
    """Whether 100 * intersection >= percent * union, for arrays of distinct values; the sizes alone may rule it out."""
    low, high = F.least(F.size(left), F.size(right)), F.greatest(F.size(left), F.size(right))
    common = F.size(F.array_intersect(left, right)).cast("bigint")
    return (low * F.lit(100).cast("bigint") >= high * percent) & (common * (100 + percent) >= (low.cast("bigint") + high) * percent)


def _sets_of(pairs: DataFrame, classes: DataFrame, own: DataFrame, words: int) -> DataFrame:
    """The sets of all members of ``pairs``, each made from one of its texts."""
    ends = pairs.select(F.col("a").alias("member")).unionByName(pairs.select(F.col("b").alias("member"))).distinct()
    needed = classes.join(ends, "member", "left_semi").select("member", "first.doc_id", "first.text_key")
    # Measured first: texts are shuffled only if there are many members.
    texts = attach(own, checkpointed(needed), ["doc_id", "text_key"])
    return checkpointed(shingle_sets(texts, words).dropDuplicates(["member"]))


def _confirmed(pairs: DataFrame, classes: DataFrame, own: DataFrame, words: int, percent: int) -> DataFrame:
    """The links among ``pairs``, by their whole sets."""
    pairs = checkpointed(pairs)
    sets = _sets_of(pairs, classes, own, words)
    left = sets.select(F.col("member").alias("a"), F.col("found").alias("left"))
    right = sets.select(F.col("member").alias("b"), F.col("found").alias("right"))
    joined = pairs.join(left, "a").join(right, "b")
    return checkpointed(joined.filter(_linked(F.col("left"), F.col("right"), percent)).select("a", "b"))


def _dealt(members: DataFrame) -> DataFrame:
    """Each bucket's members over blocks (key, low, high) of two slices, so that any two members meet as slices low and high once.

    Blocks whose members all have one label are left out.
    """
    slices = F.when(F.col("size") > SPLIT_ABOVE, F.ceil(F.col("size") * 2 / F.lit(SPLIT_ABOVE))).otherwise(F.lit(1)).cast("bigint")
    sliced = members.withColumn("slices", slices).withColumn("slice", F.pmod(F.xxhash64("key", "member"), F.col("slices")))
    blocks = sliced.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("slices") - 1)).alias("other"))
    blocks = blocks.withColumns({"low": F.least("slice", "other"), "high": F.greatest("slice", "other")}).drop("other", "slices", "size")
    keys = ["key", "low", "high"]
    mixed = blocks.groupBy(*keys).agg(F.min("label").alias("least"), F.max("label").alias("most")).filter("least <> most")
    return blocks.join(mixed.select(*keys), keys)


def _across(members: DataFrame, sketches: DataFrame, percent: int, hashes: int) -> DataFrame:
    """Pairs within a bucket that are in different classes so far and whose sketches leave a link open.

    Both sides of the join are the same rows, of some 250 bytes, and shuffled once.
    """
    rows = checkpointed(_dealt(members)).join(sketches, "member")
    rows = rows.repartition("key", "low", "high")
    x, y = rows.alias("x"), rows.alias("y")
    same = (F.col("x.key") == F.col("y.key")) & (F.col("x.low") == F.col("y.low")) & (F.col("x.high") == F.col("y.high"))
    once = (F.col("x.slice") == F.col("x.low")) & (F.col("y.slice") == F.col("y.high"))
    once = once & ((F.col("x.low") < F.col("x.high")) | (F.col("x.member") < F.col("y.member")))
    differ = once & (F.col("x.label") != F.col("y.label"))
    pairs = x.join(y, same & differ & _near("x", "y", percent, hashes)).select(F.col("x.member").alias("x"), F.col("y.member").alias("y"))
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def connected(links: DataFrame) -> DataFrame:
    """(member, label) for every end of a link: the smallest member that can be reached.

    Each round gives a member the smallest label among its neighbours, then the label of its label;
    the number of rounds grows with the logarithm of the longest path. Each round is written.
    """
    ends = links.select(F.col("a").alias("x"), F.col("b").alias("y"))
    both = checkpointed(ends.unionByName(ends.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct())
    labels = checkpointed(both.groupBy("x").agg(F.least("x", F.min("y")).alias("label")).withColumnRenamed("x", "member"))
    while True:
        seen = both.join(labels, both["y"] == labels["member"]).groupBy("x").agg(F.min("label").alias("seen"))
        # A label also passes its smaller neighbour's label on to those who carry it.
        joined = labels.join(seen, labels["member"] == seen["x"]).select("member", "label", F.least("label", "seen").alias("low"))
        hooks = joined.groupBy("label").agg(F.min("low").alias("hook")).withColumnRenamed("label", "root")
        jumped = joined.join(hooks, joined["label"] == hooks["root"]).select("member", "label", F.least("low", "hook").alias("low"))
        after = checkpointed(jumped)
        if after.filter("low <> label").isEmpty():
            return labels
        labels = after.select("member", F.col("low").alias("label"))


def _grouped(docs: DataFrame, words: int, percent: int, bands: int, rows: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text_key, n_shingles, component_id, first_key, group) for every row.

    ``component_id`` and ``first_key`` are the smallest (doc_id, text_key) of the component, ``group`` its
    number; all are null for rows without an id or a word, which are in no component.
    """
    hashes = bands * rows
    own = _own(docs, id_col, text_col)
    signed = checkpointed(signatures(docs, words, bands, rows, id_col, text_col))
    worded = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    # One member for each set, numbered when written; its text is that of the smallest row that has the set.
    classes = worded.groupBy("set_hash").agg(
        F.min(F.struct("doc_id", "text_key")).alias("first"), *[F.first(c).alias(c) for c in ("n_shingles", "bands", "bits", "odd")]
    )
    classes = checkpointed(classes.withColumn("member", F.monotonically_increasing_id()))
    members = checkpointed(_members(classes.select("member", "bands")))
    sketches = _sketches(classes, hashes)

    links = _confirmed(_likely_pairs(_star_pairs(members), sketches, percent, hashes), classes, own, words, percent)
    across = _confirmed(_across(_open(members, connected(links)), sketches, percent, hashes), classes, own, words, percent)
    final = connected(links.unionByName(across))

    labelled = classes.select("set_hash", "first", "member").join(final, "member", "left")
    labelled = checkpointed(labelled.select("set_hash", "first", F.coalesce("label", "member").alias("group")))
    firsts = labelled.groupBy("group").agg(F.min("first").alias("least"))
    of_set = labelled.join(firsts, "group").select(
        "set_hash", F.col("least.doc_id").alias("component_id"), F.col("least.text_key").alias("first_key"), "group"
    )
    narrow = signed.select("doc_id", "text_key", "n_shingles", "set_hash")
    alone = "n_shingles = 0 OR doc_id IS NULL"
    nothing = {c: F.lit(None).cast("bigint") for c in ("component_id", "first_key", "group")}
    # Copies of one text may be many rows: hot sets are sliced.
    grouped = attach(narrow.filter(f"NOT ({alone})"), checkpointed(of_set), ["set_hash"], slice_by=["doc_id", "text_key"])
    return grouped.unionByName(narrow.filter(alone).withColumns(nothing)).drop("set_hash")


def near_duplicates(
    docs: DataFrame,
    words: int = WORDS,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Two documents are linked if their sets' intersection is at least ``percent`` hundredths of the
    union. ``component_id`` is the smallest id that can be reached over links, ``kept`` is true for
    the document that has it. A pair at the threshold of 75 is missed by all bands with a
    probability of about 1 in 10,000 (less the more similar it is). Null and empty texts and texts
    of blanks have an empty set and are linked with nothing. Rows of one id are rows of their own,
    with equal or different texts: each gets a row, with the component of its text. A row without an
    id takes part in no link, is kept and has itself, null, as component. Other columns are left out.
    """
    found = _grouped(docs, words, percent, bands, rows, id_col, text_col)
    component = F.coalesce("component_id", "doc_id")
    return found.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each component: that of the smallest id, and of its texts that with the smallest hash.

    Rows of one id whose texts are in different components all stay. A text without words stays; of
    rows equal in id and text one stays, the first by a hash of all columns. Rows without an id all stay.
    """
    found = _grouped(docs, WORDS, PERCENT, BANDS, ROWS, id_col, text_col)
    first = (F.col("doc_id") == F.col("component_id")) & (F.col("text_key") == F.col("first_key"))
    kept = found.filter("doc_id IS NOT NULL").filter(F.col("component_id").isNull() | first).select("doc_id", "text_key").distinct()
    keyed = docs.withColumns({"_near_id": docs[id_col].cast("bigint"), "_near_key": F.xxhash64(F.coalesce(docs[text_col], F.lit("")))})
    kept = kept.select(F.col("doc_id").alias("_near_id"), F.col("text_key").alias("_near_key"))
    order = Window.partitionBy("_near_id", "_near_key").orderBy(F.xxhash64(*docs.columns))
    named = keyed.join(kept, ["_near_id", "_near_key"], "left_semi").withColumn("_near_place", F.row_number().over(order))
    named = named.filter("_near_place = 1").select(*docs.columns)
    return named.unionByName(docs.filter(docs[id_col].isNull()))
