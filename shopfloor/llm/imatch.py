"""I-Match fingerprints over randomised lexicons.

The lexicon holds the terms whose document frequency lies in a band. A text's fingerprint hashes its
sorted distinct lexicon terms, restricted to random subsets of the lexicon, one signature for each
subset. So that texts of any length keep some signatures when half of the text changes, the subsets
come in levels, level l holding each term with probability 2**-l, and a text uses the three levels in
which about one of its terms falls into a subset. A text with too few lexicon terms uses all its terms.
"""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopfloor.llm.common import checkpointed, id_and_text, small_batches, texts_of

# The band: a term of the lexicon stands in at least LOW and at most HIGH of the documents.
LOW, HIGH = 1 / 1000, 0.15
FEWEST_TERMS = 4
LEVELS, SUBSETS = 3, 16
BLANK = "------"
# Candidate terms are sent to all tasks within this number, 32 MB; beyond it they are joined by shuffle.
BROADCAST_TERMS = 4_000_000
# Bytes of texts in a range of ids, about, so that a task's range does not grow with the table.
BUCKET_BYTES = 16 << 20

_TERMS = re.compile(rb"[^\x00-\x20!-/:-@\[-`{-\x7f]+")
_FACTORS = np.random.default_rng(8).integers(1, 2**63, size=(64, SUBSETS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def term_hashes(text: str) -> np.ndarray:
    """Sorted hashes of the distinct terms: runs of anything but ASCII blanks and punctuation, in lower case."""
    found = set(_TERMS.findall(text.lower().encode("utf-8", "replace")))
    return np.sort(np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found)))


def within(terms: np.ndarray, lexicon: np.ndarray) -> np.ndarray:
    """Which of the terms are in the sorted lexicon."""
    if not len(lexicon):
        return np.zeros(len(terms), bool)
    return lexicon[np.minimum(np.searchsorted(lexicon, terms), len(lexicon) - 1)] == terms


def fingerprint(text: str, lexicon: np.ndarray) -> str:
    """The first level and a signature of six digits for each subset; empty for a text without terms."""
    terms = term_hashes(text)
    known = terms[within(terms, lexicon)]
    if len(known) >= FEWEST_TERMS:
        terms = known
    if not len(terms):
        return ""
    first = int(len(terms)).bit_length() - 1
    signatures = []
    for level in range(first, first + LEVELS):
        chance = np.uint64(2 ** (64 - level) - 1)
        member = terms[:, None] * _FACTORS[level] <= chance
        for i in range(SUBSETS):
            own = terms[member[:, i]]
            signatures.append(f"{xxhash.xxh32_intdigest(own.tobytes(), seed=i) & 0xFFFFFF:06x}" if len(own) else BLANK)
    return f"{first}:" + "".join(signatures)


def likeness(a: str, b: str) -> float:
    """Share of equal signatures among those that either text has, in the levels that both have; 1 for equal fingerprints."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    levels = []
    for x in (a, b):
        first, _, rest = x.partition(":")
        cut = [rest[i : i + 6] for i in range(0, len(rest), 6)]
        levels.append({int(first) + i: cut[i * SUBSETS : (i + 1) * SUBSETS] for i in range(LEVELS)})
    pairs = [p for level in levels[0].keys() & levels[1].keys() for p in zip(levels[0][level], levels[1][level])]
    there = [(x, y) for x, y in pairs if x != BLANK or y != BLANK]
    return sum(x == y for x, y in there) / len(there) if there else 0.0


def _counted(docs: DataFrame, chosen: np.ndarray | None, share: float) -> DataFrame:
    """(term, n) of each task: document frequencies, and the number of documents as a term of null.

    Without ``chosen`` only terms in at least ``share`` of the task's documents are given. Every term
    in that share of all documents is among those of some task.
    """
    shared = docs.sparkSession.sparkContext.broadcast(chosen)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, counts, waiting, documents = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            every = np.concatenate([terms, *waiting])
            weight = np.concatenate([counts, np.ones(len(every) - len(terms), np.int64)])
            unique, place = np.unique(every, return_inverse=True)
            return unique, np.bincount(place, weights=weight, minlength=len(unique)).astype(np.int64)

        for batch in small_batches(batches, "text"):
            for text in texts_of(batch, "text"):
                found = term_hashes(text)
                waiting.append(found if shared.value is None else found[within(found, shared.value)])
                documents += 1
            if sum(map(len, waiting)) > 2_000_000:
                terms, counts = merged()
                waiting = []
        terms, counts = merged()
        keep = counts >= (share * documents if shared.value is None else 1)
        names = pa.array([None, *terms[keep].view(np.int64).tolist()], pa.int64())
        yield pa.RecordBatch.from_arrays([names, pa.array([documents, *counts[keep].tolist()], pa.int64())], ["term", "n"])

    return docs.select("text").mapInArrow(run, "term bigint, n bigint")


def learn_lexicon(docs: DataFrame, low: float = LOW, high: float = HIGH, text_col: str = "text") -> np.ndarray:
    """Sorted hashes of the terms that stand in ``low`` to ``high`` of all documents.

    At most (mean number of distinct terms of a document) / ``low`` terms reach the lower bound,
    however many documents there are, so the lexicon fits every task.
    """
    rows = docs.select(F.coalesce(docs[text_col], F.lit("")).alias("text"))
    heavy = checkpointed(_counted(rows, None, low).groupBy("term").agg(F.sum("n").alias("n")))
    total = heavy.filter("term IS NULL").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    names = heavy.filter("term IS NOT NULL").select("term")
    if names.count() <= BROADCAST_TERMS:
        chosen = np.sort(names.toArrow().column("term").to_numpy().astype(np.int64).view(np.uint64))
        counted = _counted(rows, chosen, low)
    else:
        counted = _counted(rows, None, 0.0).join(names, "term", "left_semi")
    counts = counted.filter("term IS NOT NULL").groupBy("term").agg(F.sum("n").alias("n"))
    inside = counts.filter((F.col("n") >= F.lit(low * total)) & (F.col("n") <= F.lit(high * total))).select("term")
    return np.sort(inside.toArrow().column("term").to_numpy().astype(np.int64).view(np.uint64))


def buckets_of(docs: DataFrame, text_col: str = "text", bucket_bytes: int = BUCKET_BYTES) -> int:
    """Into how many ranges of ids ``docs`` is cut: by the bytes of its texts, and two for each shuffle partition at least."""
    size = docs.agg(F.sum(F.octet_length(docs[text_col]).cast("bigint"))).first()[0] or 0
    least = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-size // bucket_bytes))


def with_next_text(docs: DataFrame, buckets: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, next_text): the text of the next row by id and text; the last row's next is the first.

    Ids are cut into ranges at quantiles, one range to a group; each group also gets the first row
    of the next range. So texts are shuffled once and no group holds more than its range.
    """
    rows = id_and_text(docs, id_col, text_col)
    spark: SparkSession = docs.sparkSession
    bounds = np.unique(rows.approxQuantile("doc_id", np.linspace(0, 1, buckets + 1)[1:-1].tolist(), 0.25 / buckets) if buckets > 1 else [])

    @F.pandas_udf("int")
    def bucket_of(ids):
        return ids.__class__(np.searchsorted(bounds, ids.to_numpy(), side="right")).astype("int32")

    dealt = rows.withColumn("bucket", F.when(F.col("doc_id").isNull(), -1).otherwise(bucket_of(F.coalesce("doc_id", F.lit(0)))))
    firsts = dealt.groupBy("bucket").agg(F.min("doc_id").alias("doc_id")).orderBy("bucket").collect()
    if not firsts:
        return rows.withColumn("next_text", F.lit(""))
    # One row per range, each for the range before it, the first one for the last.
    into = [(firsts[i - 1]["bucket"], firsts[i]["doc_id"]) for i in range(len(firsts))]
    heads = spark.createDataFrame(into, "bucket int, doc_id bigint")
    found = rows.join(F.broadcast(heads.withColumnRenamed("doc_id", "head")), F.col("doc_id").eqNullSafe(F.col("head")))
    found = found.groupBy("bucket", "doc_id").agg(F.min("text").alias("text"))
    both = dealt.withColumn("borrowed", F.lit(False)).unionByName(found.withColumn("borrowed", F.lit(True)))
    order = Window.partitionBy("bucket").orderBy("borrowed", "doc_id", "text")
    return both.withColumn("next_text", F.lead("text").over(order)).filter("NOT borrowed").select("doc_id", "text", "next_text")


def fingerprints(texts: DataFrame, lexicon: np.ndarray, columns: dict[str, str]) -> DataFrame:
    """``texts`` with a fingerprint column for each text column of ``columns`` (text column -> new column).

    A null text counts as empty and has the empty fingerprint. Equal texts have equal fingerprints.
    """
    shared = texts.sparkSession.sparkContext.broadcast(lexicon)
    given = list(texts.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, next(iter(columns))):
            made = [pa.array([fingerprint(t or "", shared.value) for t in texts_of(batch, c)], pa.string()) for c in columns]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*given, *columns.values()])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema] + [f"`{c}` string" for c in columns.values()])
    return texts.mapInArrow(run, schema)


def edited_likeness(docs: DataFrame, lexicon: np.ndarray, buckets: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of all texts, of their edited versions, and how alike they are.

    Returns (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).
    The edited text has the last half of the code points, rounded down, replaced by as many first
    ones of the next document's text, or all of it. Without ``buckets`` there are as many ranges of ids
    as it takes for each to have about ``BUCKET_BYTES`` of text at most. One row per row; rows with equal ids follow one
    another by text, null ids come first, and a single document is its own next. No rows, no result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    kinds = {"doc_id": pa.int64(), "n_chars": pa.int64(), "near_edited": pa.float64(), "near_next": pa.float64()}
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256

        known = shared.value
        for batch in small_batches(batches, "text"):
            out = []
            for doc_id, text, after in zip(*(texts_of(batch, c) for c in ("doc_id", "text", "next_text"))):
                half = len(text) // 2
                edited = text[: len(text) - half] + after[:half]
                own, changed, other = (fingerprint(t, known) for t in (text, edited, after))
                digest = sha256(edited.encode("utf-8")).hexdigest()
                out.append((doc_id, len(text), digest, own, changed, likeness(own, changed), likeness(own, other)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], kinds.get(c, pa.string())) for i, c in enumerate(names)], names
            )

    schema = ", ".join(f"{c} {'bigint' if c in ('doc_id', 'n_chars') else 'double' if c.startswith('near') else 'string'}" for c in names)
    ranges = buckets or buckets_of(docs, text_col)
    return with_next_text(docs, ranges, id_col, text_col).mapInArrow(run, schema)
