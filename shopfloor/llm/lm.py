"""Scoring texts by a language model kept in a log-frequency Bloom filter.

Words are counted exactly. The count c of an n-gram of two words or more is kept as its level
1 + floor(log_BASE(c)): the n-gram is put into a Bloom filter once for each level up to its own, and
read back by probing level after level until one is missing. A filter can only give a level too
high, with a probability of about 2**-HASHES for each level.

A token's probability is that of a hierarchical Dirichlet prior: the count of the n-gram plus
``prior`` times the probability given a history shorter by one word, over the count of the history
plus ``prior``; at the bottom is the word's own share, (c + 1) / (N + V + 1). No count is taken as
larger than that of a part of the n-gram.

The model lies in slices, by the first bits of a word's or n-gram's number, each with a filter as
large as its n-grams need. The slices are broadcast where all of them together are small enough;
otherwise the texts are dealt over chunks and the slices asked by shuffle, with the same result.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfloor.llm.common import id_and_text, small_batches
from shopfloor.llm.words import mixed, words_of
from shopfloor.storage import materialize

ORDER = 2
PRIOR = 200.0
HASHES = 8
BASE = 1.5
#: The model is cut into 2**SLICE_BITS slices.
SLICE_BITS = 10
#: Largest model that is broadcast, in bytes.
BROADCAST_BYTES = 256 << 20
#: Texts of about so many bytes make a chunk, and the chunks asking a slice at once are so many, where the model is not broadcast.
CHUNK_BYTES, CHUNKS_AT_ONCE = 16 << 20, 256
#: Rows collected in a task before they are added up.
HELD = 4_000_000

START, END = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)
_ORDERS = np.random.default_rng(47).integers(1, 2**63, size=16, dtype=np.uint64) | np.uint64(1)
_LEVELS = np.random.default_rng(53).integers(1, 2**63, size=256, dtype=np.uint64)
_LOW = np.uint64(0xFFFFFFFF)
MODEL = "slice int, words binary, counts binary, filter binary, bits bigint, tokens bigint, docs bigint"


@dataclass
class Tokens:
    """The tokens of a batch, each text's words and then its end: numbers, rows, and place within the text."""

    numbers: np.ndarray
    rows: np.ndarray
    places: np.ndarray
    per_row: np.ndarray

    def grams(self, length: int) -> np.ndarray:
        """The number of the last ``length`` tokens up to each token; before a text, all tokens are ``START``."""
        total = np.zeros(len(self.numbers), np.uint64)
        for back in range(length):
            shifted = np.full(len(self.numbers), START)
            if back < len(shifted):
                shifted[back:] = self.numbers[: len(shifted) - back]
            total += np.where(self.places >= back, shifted, START) * _ORDERS[back]
        return mixed(total + np.uint64(length)) if length > 1 else self.numbers


def tokens_of(column: pa.Array) -> Tokens:
    found = words_of(column, lower=True)
    per_row = found.per_row + 1
    numbers = np.full(len(found) + len(per_row), END)
    numbers[np.arange(len(found)) + found.rows] = found.numbers
    rows = np.repeat(np.arange(len(per_row)), per_row)
    places = np.arange(len(numbers)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    return Tokens(numbers, rows, places, per_row)


def _summed(numbers: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers in order, and their counts added up."""
    if not len(numbers):
        return numbers, counts
    order = np.argsort(numbers, kind="stable")
    numbers = numbers[order]
    first = np.flatnonzero(np.concatenate([[True], numbers[1:] != numbers[:-1]]))
    return numbers[first], np.add.reduceat(counts[order], first)


class _Counter:
    """Counts of numbers, added up now and then."""

    def __init__(self):
        self.numbers, self.counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        self.held = self.limit = 0

    def add(self, numbers: np.ndarray) -> None:
        self.numbers.append(numbers)
        self.counts.append(np.ones(len(numbers), np.int64))
        self.held += len(numbers)
        if self.held > max(HELD, 2 * self.limit):
            numbers, counts = self.total()
            self.numbers, self.counts, self.held, self.limit = [numbers], [counts], len(numbers), len(numbers)

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        return _summed(np.concatenate(self.numbers), np.concatenate(self.counts))


def slice_of(numbers: np.ndarray, bits: int) -> np.ndarray:
    return (numbers >> np.uint64(64 - bits)).astype(np.int64)


def levels_of(counts: np.ndarray) -> np.ndarray:
    """1 + floor(log_BASE(count)) of counts from 1 on."""
    edges = np.ceil(BASE ** np.arange(160) - 1e-9)
    return np.searchsorted(edges, counts, "right")


def counts_of_levels() -> np.ndarray:
    """The mean of the whole numbers of each level; 0 for level 0, and the level's bounds for one that holds none."""
    edges = np.ceil(BASE ** np.arange(160) - 1e-9)
    return np.concatenate([[0.0], (edges[:-1] + np.maximum(edges[1:] - 1, edges[:-1])) / 2])


def _probes(numbers: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    h = mixed(numbers + _LEVELS[level])
    return h & _LOW, (h >> np.uint64(32)) | np.uint64(1)


def _places(first: np.ndarray, step: np.ndarray, probe: int, bits: np.ndarray) -> np.ndarray:
    """The bit that a probe of each number asks for, out of ``bits``."""
    return (((first + np.uint64(probe) * step) & _LOW) * bits) >> np.uint64(32)


def bloom(numbers: np.ndarray, levels: np.ndarray, hashes: int) -> np.ndarray:
    """The filter of one slice, one bool a bit."""
    size = max(64, int(np.ceil(levels.sum() * hashes / np.log(2))))
    bits = np.zeros(size, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        first, step = _probes(numbers[levels >= level], level)
        for probe in range(hashes):
            bits[_places(first, step, probe, np.uint64(size))] = True
    return bits


def read_levels(numbers: np.ndarray, raw: np.ndarray, starts: np.ndarray, bits: np.ndarray, hashes: int) -> np.ndarray:
    """The level of each number: ``raw`` holds its slice's filter from byte ``starts`` on, of ``bits`` bits."""
    levels = np.zeros(len(numbers), np.int64)
    left = np.flatnonzero(bits > 0)
    level = 1
    while len(left) and level < len(_LEVELS):
        first, step = _probes(numbers[left], level)
        for probe in range(hashes):
            at = _places(first, step, probe, bits[left])
            hit = (raw[starts[left] + (at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0
            left, first, step = left[hit], first[hit], step[hit]
        levels[left] += 1
        level += 1
    return levels


def count(docs: DataFrame, order: int = ORDER, hashes: int = HASHES, slice_bits: int = SLICE_BITS) -> DataFrame:
    """The model's slices: exact counts of words, and a filter with the levels of longer n-grams.

    Each task adds its counts up before they are shuffled, as a few arrays for each slice.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = [_Counter() for _ in range(order)]
        docs_here = 0
        for batch in small_batches(batches, "text"):
            found = tokens_of(batch.column(0))
            docs_here += batch.num_rows
            for i, counter in enumerate(counters):
                counter.add(found.grams(i + 1))
        for i, counter in enumerate(counters):
            numbers, counts = counter.total()
            cuts = np.searchsorted(slice_of(numbers, slice_bits), np.arange((1 << slice_bits) + 1))
            full = np.flatnonzero(np.diff(cuts))
            for part in np.array_split(full, -(-len(full) // 64) or 1):
                rows = [(numbers[cuts[s] : cuts[s + 1]].tobytes(), counts[cuts[s] : cuts[s + 1]].astype(np.uint32).tobytes()) for s in part]
                kinds = pa.array(np.full(len(part), min(i, 1), np.int32))
                none = pa.array(np.zeros(len(part), np.int64))
                columns = [pa.array(part.astype(np.int32)), kinds, *(pa.array(x, pa.binary()) for x in (list(zip(*rows)) or [(), ()])), none]
                yield pa.RecordBatch.from_arrays(columns, ["slice", "kind", "numbers", "counts", "docs"])
        first = [pa.array([x], t) for x, t in ((0, pa.int32()), (0, pa.int32()), (b"", pa.binary()), (b"", pa.binary()), (docs_here, pa.int64()))]
        yield pa.RecordBatch.from_arrays(first, ["slice", "kind", "numbers", "counts", "docs"])

    def build(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        kinds = table.column("kind").to_numpy()
        numbers, counts = table.column("numbers").to_pylist(), table.column("counts").to_pylist()
        made = []
        for kind in (0, 1):
            rows = np.flatnonzero(kinds == kind)
            own = np.frombuffer(b"".join(numbers[r] for r in rows), np.uint64)
            made.append(_summed(own, np.frombuffer(b"".join(counts[r] for r in rows), np.uint32).astype(np.int64)))
        (words, exact), (grams, times) = made
        bits = bloom(grams, levels_of(times), hashes) if len(grams) else np.zeros(0, bool)
        packed = np.packbits(bits, bitorder="little").tobytes()
        docs_here = int(table.column("docs").to_numpy().sum())
        values = [key[0].as_py(), words.tobytes(), exact.tobytes(), packed, len(bits), int(exact.sum()), docs_here]
        types = [pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        return pa.Table.from_arrays([pa.array([v], t) for v, t in zip(values, types)], MODEL_NAMES)

    texts = id_and_text(docs, "doc_id", "text").select("text")
    partials = texts.mapInArrow(partial, "slice int, kind int, numbers binary, counts binary, docs bigint")
    return partials.groupBy("slice").applyInArrow(build, MODEL)


MODEL_NAMES = [field.split()[0] for field in MODEL.split(", ")]


@dataclass
class Model:
    """The written slices, their totals, and how they were made."""

    table: DataFrame
    tokens: int
    words: int
    docs: int
    bytes: int
    order: int
    prior: float
    hashes: int
    slice_bits: int


def learn(
    docs: DataFrame,
    order: int = ORDER,
    prior: float = PRIOR,
    hashes: int = HASHES,
    slice_bits: int = SLICE_BITS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Model:
    """The model of all rows of ``docs``, written once to the shared folder.

    A null text is empty and counts as one end. Equal rows count as often as they are there. No rows
    give an empty model. Other columns are left out.
    """
    table = materialize(count(id_and_text(docs, id_col, text_col), order, hashes, slice_bits), "language-model")
    size = F.octet_length("words") + F.octet_length("counts") + F.octet_length("filter")
    found = table.agg(F.sum("tokens"), F.sum(F.octet_length("words") / 8), F.sum("docs"), F.sum(size.cast("bigint"))).first()
    return Model(table, *(int(x or 0) for x in found), order, prior, hashes, slice_bits)


class Lookup:
    """Slices of a model in memory."""

    def __init__(self, rows: list, slice_bits: int, hashes: int):
        rows = sorted(rows, key=lambda r: r["slice"])
        self.hashes, self.slice_bits = hashes, slice_bits
        self.words = np.frombuffer(b"".join(r["words"] for r in rows), np.uint64)
        counts = np.frombuffer(b"".join(r["counts"] for r in rows), np.int64)
        self.counts = counts.astype(np.uint32) if counts.max(initial=0) < 2**32 else counts
        self.raw = np.frombuffer(b"".join(r["filter"] for r in rows), np.uint8)
        self.bits = np.zeros(1 << slice_bits, np.uint64)
        self.starts = np.zeros(1 << slice_bits, np.int64)
        at = 0
        for r in rows:
            self.bits[r["slice"]], self.starts[r["slice"]] = r["bits"], at
            at += len(r["filter"])

    def exact(self, numbers: np.ndarray) -> np.ndarray:
        """Counts of distinct words."""
        if not len(self.words):
            return np.zeros(len(numbers), np.int64)
        at = np.minimum(np.searchsorted(self.words, numbers), len(self.words) - 1)
        return np.where(self.words[at] == numbers, self.counts[at], 0).astype(np.int64)

    def levels(self, numbers: np.ndarray) -> np.ndarray:
        own = slice_of(numbers, self.slice_bits)
        return read_levels(numbers, self.raw, self.starts[own], self.bits[own], self.hashes)


def _scores(found: Tokens, exact: np.ndarray, levels: list[np.ndarray], model: tuple) -> dict[str, np.ndarray]:
    """Sums for each text, from each token's exact count and the levels of its n-grams of two tokens and more."""
    tokens, words, docs, prior = model
    base = np.log10((exact + 1) / (tokens + words + 1))
    # The history of one token: the word before, or the start of a text.
    before = np.full(len(exact), float(docs))
    before[1:] = np.where(found.places[1:] > 0, exact[:-1], docs)
    probability = (exact + 1) / (tokens + words + 1)
    most = exact.astype(np.float64)
    values = counts_of_levels()
    for i, level in enumerate(levels):
        times = np.minimum(np.minimum(values[level], before), most)
        probability = (times + prior * probability) / (before + prior)
        if i + 1 < len(levels):
            # The history of the next longer n-gram is this one, one token earlier.
            history = np.full(len(exact), float(docs))
            history[1:] = np.where(found.places[1:] > 0, times[:-1], docs)
            before, most = history, times
    rows = len(found.per_row)
    add = lambda x: np.bincount(found.rows, x, minlength=rows)
    return {
        "n_tokens": found.per_row.astype(np.int64),
        "n_known": add(exact > 0).astype(np.int64),
        "base_score": add(base),
        "score": add(np.log10(probability)),
    }


SCORES = "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double"


def _record(ids: pa.Array, scores: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([ids, *(pa.array(x) for x in scores.values())], ["doc_id", *scores])


def _by_broadcast(own: DataFrame, model: Model) -> DataFrame:
    rows = model.table.toLocalIterator()
    shared = own.sparkSession.sparkContext.broadcast(Lookup(list(rows), model.slice_bits, model.hashes))
    totals, order = (model.tokens, model.words, model.docs, model.prior), model.order

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = shared.value
        for batch in small_batches(batches, "text"):
            found = tokens_of(batch.column(1))
            distinct, back = np.unique(found.numbers, return_inverse=True)
            levels = [lookup.levels(found.grams(i)) for i in range(2, order + 1)]
            yield _record(batch.column(0), _scores(found, lookup.exact(distinct)[back], levels, totals))

    return own.mapInArrow(run, SCORES)


def _by_shuffle(own: DataFrame, model: Model) -> DataFrame:
    """Texts are dealt over chunks; a chunk asks each slice for its distinct words and n-grams, and gets counts and levels back."""
    size = own.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    chunks = -(-size // CHUNK_BYTES) or 1
    turns = -(-chunks // CHUNKS_AT_ONCE)
    chunked = own.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)))
    totals, order, bits, hashes = (model.tokens, model.words, model.docs, model.prior), model.order, model.slice_bits, model.hashes

    def wanted(table: pa.Table) -> tuple[Tokens, list[np.ndarray]]:
        found = tokens_of(table.column("text").cast(pa.large_string()).combine_chunks())
        return found, [found.grams(i) for i in range(1, order + 1)]

    def asks(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        out = []
        for kind, numbers in enumerate(wanted(table)[1]):
            distinct = np.unique(numbers)
            cuts = np.searchsorted(slice_of(distinct, bits), np.arange((1 << bits) + 1))
            out += [(key[0].as_py(), kind, int(s), distinct[cuts[s] : cuts[s + 1]].tobytes()) for s in np.flatnonzero(np.diff(cuts))]
        types = [("chunk", pa.int64()), ("kind", pa.int32()), ("slice", pa.int32()), ("numbers", pa.binary())]
        return pa.Table.from_arrays([pa.array([r[i] for r in out], t) for i, (_, t) in enumerate(types)], [n for n, _ in types])

    def answer(key: tuple[pa.Scalar, ...], asked: pa.Table, slices: pa.Table) -> pa.Table:
        lookup = Lookup(slices.to_pylist(), bits, hashes)
        kinds, numbers = asked.column("kind").to_pylist(), asked.column("numbers").to_pylist()
        arrays = [np.frombuffer(n, np.uint64) for n in numbers]
        values = [(lookup.exact(a) if k == 0 else lookup.levels(a)).tobytes() for k, a in zip(kinds, arrays)]
        return asked.select(["chunk", "kind", "slice"]).append_column("values", pa.array(values, pa.binary()))

    def scored(key: tuple[pa.Scalar, ...], table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.Table.from_batches([], schema=SCORED)
        found, grams = wanted(table)
        rows = sorted(answers.select(["kind", "slice", "values"]).to_pylist(), key=lambda r: (r["kind"], r["slice"]))
        read = []
        for kind, numbers in enumerate(grams):
            values = np.frombuffer(b"".join(r["values"] for r in rows if r["kind"] == kind), np.int64)
            read.append(values[np.unique(numbers, return_inverse=True)[1]])
        ids = table.column("doc_id").combine_chunks()
        return pa.Table.from_batches([_record(ids, _scores(found, read[0], read[1:], totals))])

    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(turns - 1).cast("bigint")))
    slices = model.table.select("slice", "words", "counts", "filter", "bits", every.alias("turn"))
    asked = chunked.groupBy("chunk").applyInArrow(asks, "chunk bigint, kind int, slice int, numbers binary")
    asked = asked.withColumn("turn", F.pmod("chunk", F.lit(turns)))
    answers = asked.groupBy("slice", "turn").cogroup(slices.groupBy("slice", "turn"))
    answers = answers.applyInArrow(answer, "chunk bigint, kind int, slice int, values binary")
    return chunked.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(scored, SCORES)


_TYPES = {"bigint": pa.int64(), "double": pa.float64()}
SCORED = pa.schema([(f.split()[0], _TYPES[f.split()[1]]) for f in SCORES.split(", ")])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) for every row, whatever its id.

    ``n_known`` counts the tokens the model has seen; ``base_score`` is the log10 probability by
    single words, ``score`` that by the model. A null or empty text has one token, its end. With an
    empty model, every token has the probability 1. Other columns are left out.
    """
    own = id_and_text(docs, id_col, text_col)
    return _by_broadcast(own, model) if model.bytes <= broadcast_bytes else _by_shuffle(own, model)
