"""Byte-level BPE: exact encoding by backtracking over longest matches, decoding by an offset table.

A text is cut at the special tokens, then into the pre-tokens of the tokenizer's pattern. In each
pre-token an Aho-Corasick automaton over the vocabulary gives the longest token that begins at each
byte. The encoder takes that token if it is compatible with the one before it, that is, if merging
the two tokens' bytes by rank would leave exactly these two; otherwise it tries the next shorter
token that is a prefix, and where there is none it takes back the last token. Each byte position is
given up at most once, so the work is linear in the length of the pre-token, and the result is that
of applying the merges by rank.
"""

import json
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfloor.llm.common import small_batches, texts_of

# Fixed values of byte-level BPE: the pattern of pre-tokens.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# A worker keeps at most twice as many encoded pieces of text.
CACHE_ENTRIES = 100_000


def printable_bytes() -> dict[str, int]:
    """The character that stands for each byte in the vocabulary file, as byte-level BPE defines it."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def read_tokens(path: str) -> tuple[dict, dict[str, int], dict[int, bytes]]:
    """The model of a tokenizer file, the ids of its special tokens and every token's bytes by id."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    to_byte = printable_bytes()
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    plain = ((t, i) for t, i in spec["model"]["vocab"].items() if t not in special)
    by_id = {i: bytes(to_byte[c] for c in t) for t, i in plain}
    return spec["model"], special, by_id | {i: t.encode() for t, i in special.items()}


class Vocabulary:
    """Tables derived from a tokenizer file: halves, ranks and prefixes of the tokens."""

    def __init__(self, path: str):
        model, self.special, by_id = read_tokens(path)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        ids = model["vocab"]
        self.merged = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(merges)}
        # The merge that makes a token is the first one that results in it.
        self.halves: dict[int, tuple[int, int, int]] = {}
        for (a, b), (rank, made) in self.merged.items():
            self.halves.setdefault(made, (rank, a, b))
        usable = {t: i for i, t in by_id.items() if i in self.halves or len(t) == 1}
        self.shorter = {i: self._prefix(t, usable) for t, i in usable.items()}
        self.longest = ahocorasick.Automaton()
        for token, i in usable.items():
            self.longest.add_word(token.decode("latin-1"), i)
        self.longest.make_automaton()
        self.length = {i: len(t) for t, i in usable.items()}

    @staticmethod
    def _prefix(token: bytes, usable: dict[bytes, int]) -> int:
        """The longest other token that ``token`` begins with; -1 for a single byte."""
        return next((usable[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in usable), -1)


class Kept(dict):
    """A cache that computes what it lacks. When full it keeps one older generation, so that what is
    frequent stays and the size is bounded; entries only save time."""

    def __init__(self, entries: int = CACHE_ENTRIES):
        super().__init__()
        self.entries = entries
        self.older: dict = {}

    def make_room(self) -> None:
        if len(self) > self.entries:
            self.older = dict(self)
            self.clear()

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        self[key] = value
        return value


class Encoder(Kept):
    """Encoded pieces of text, each a run of whole pre-tokens; ids as little-endian 32-bit bytes."""

    def __init__(self, path: str):
        super().__init__()
        self.vocabulary = Vocabulary(path)
        self.pattern = regex.compile(PATTERN)
        special = sorted(self.vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        # Where blanks come in longer runs, a blank before a word need not begin a pre-token.
        self.long_blanks = regex.compile(r"\s\s\s|  ")
        self.compatible: dict[tuple[int, int], bool] = {}

    def text(self, text: str) -> bytes:
        if self.special is None or not self.special.search(text):
            return self._plain(text)
        parts = self.special.split(text)
        ids = self.vocabulary.special
        return b"".join(ids[p].to_bytes(4, "little") if i % 2 else self._plain(p) for i, p in enumerate(parts))

    def _plain(self, text: str) -> bytes:
        self.make_room()
        if self.long_blanks.search(text):
            return b"".join(map(self.__getitem__, self.pattern.findall(text)))
        # A blank followed by a word begins a pre-token, so pieces cut before blanks encode alone.
        first, *rest = text.split(" ")
        return self[first] + b"".join([self[" " + piece] for piece in rest])

    def compute(self, piece: str) -> bytes:
        words = [piece] if piece.isalpha() or piece[1:].isalpha() and piece[0] == " " else self.pattern.findall(piece)
        if len(words) > 1:
            return b"".join([self[word] for word in words])
        return array("I", self._word(piece.encode("utf-8"))).tobytes() if piece else b""

    def _word(self, word: bytes) -> list[int]:
        """Token ids of one pre-token."""
        length, shorter = self.vocabulary.length, self.vocabulary.shorter
        matches, compatible = self.vocabulary.longest.iter_long, self.compatible
        shown, n = word.decode("latin-1"), len(word)
        taken: list[int] = []
        closed: set[int] = set()
        at, last, token = 0, -1, next(matches(shown))[1]
        while True:
            end = at + length[token]
            fits = end not in closed
            if fits and last >= 0:
                fits = compatible.get((last, token))
                if fits is None:
                    fits = self._stay_apart(last, token)
            if fits:
                taken.append(token)
                if end == n:
                    return taken
                at, last, token = end, token, next(matches(shown, end))[1]
            elif shorter[token] >= 0:
                token = shorter[token]
            else:
                # Nothing fits here: no token may end at this byte; try again from the last one.
                closed.add(at)
                token = taken.pop()
                at -= length[token]
                last = taken[-1] if taken else -1

    def _stay_apart(self, left: int, right: int) -> bool:
        """Whether merging by rank leaves the two tokens as they are when they stand side by side."""
        if len(self.compatible) > CACHE_ENTRIES:
            self.compatible.clear()
        known = self.compatible[left, right] = self._unmerge(left, right)
        return known

    def _unmerge(self, left: int, right: int) -> bool:
        """Undo the latest merges at the seam one by one; none of the pairs met may merge earlier.

        ``limit`` orders merges as the encoder applies them: by rank, and from the left for equal
        ranks, so that a right token's own merge precedes an equal one over the seam only if earlier.
        """
        merged, halves = self.vocabulary.merged, self.vocabulary.halves
        limit = (float("inf"), 0)
        while True:
            over_seam = merged.get((left, right))
            if over_seam is not None and (over_seam[0], 0.5) < limit:
                return False
            rank_left = halves[left][0] if left in halves else -1
            rank_right = halves[right][0] if right in halves else -1
            if rank_left < 0 and rank_right < 0:
                return True
            if rank_left > rank_right:
                limit, left = (rank_left, 0), halves[left][2]
            else:
                limit, right = (rank_right, 1), halves[right][1]


class Decoder:
    """All tokens' bytes end to end, and where each begins."""

    def __init__(self, path: str):
        by_id = read_tokens(path)[2]
        tokens = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
        self.bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.offset = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int64)

    def text(self, ids: bytes) -> str:
        index = np.frombuffer(ids, dtype="<u4").astype(np.int64)
        begin, size = self.offset[index], self.offset[index + 1] - self.offset[index]
        ends = np.cumsum(size)
        if not len(index):
            return ""
        place = np.arange(ends[-1]) + np.repeat(begin - (ends - size), size)
        return self.bytes[place].tobytes().decode("utf-8", errors="replace")


_made: dict[tuple[str, str], object] = {}


def _once(kind: type, path: str):
    """One table of each kind in a worker, which serves many tasks."""
    key = (kind.__name__, path)
    if key not in _made:
        _made[key] = kind(path)
    return _made[key]


def _rows(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    rows = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    return rows, rows.schema["id"].dataType.simpleString()


def _encoded(batch: pa.RecordBatch, encoder: Encoder) -> pa.RecordBatch:
    ids = [encoder.text(text) for text in texts_of(batch, "text")]
    counts = pa.array([len(x) // 4 for x in ids], pa.int64())
    return pa.RecordBatch.from_arrays([batch.column(0), counts, pa.array(ids, pa.binary())], ["id", "n_tokens", "ids"])


def _decoded(batch: pa.RecordBatch, decoder: Decoder) -> pa.RecordBatch:
    texts = pa.array([decoder.text(ids or b"") for ids in texts_of(batch, "ids")], pa.string())
    return pa.RecordBatch.from_arrays([*batch.columns, texts], [*batch.schema.names, "text"])


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token ids of each whole text: (id, n_tokens, ids), ids as little-endian unsigned 32-bit integers.

    ``tokenizer`` is a byte-level BPE tokenizer file that every node has under this path. A null or
    empty text has no ids. One row per row of ``docs``, whatever its id; other columns are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _once(Encoder, tokenizer)
        for batch in small_batches(batches, "text"):
            yield _encoded(batch, encoder)

    rows, kind = _rows(docs, id_col, text_col)
    return rows.mapInArrow(run, f"id {kind}, n_tokens bigint, ids binary")


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """The columns of ``encode`` and the text that the ids stand for; null ids give the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _once(Decoder, tokenizer)
        for batch in small_batches(batches, "ids"):
            yield _decoded(batch, decoder)

    kind = encoded.schema["id"].dataType.simpleString()
    return encoded.select("id", "n_tokens", "ids").mapInArrow(run, f"id {kind}, n_tokens bigint, ids binary, text string")


def round_trip(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``decode(encode(docs))`` in one pass, so that a task needs one worker with both tables, not two."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _once(Encoder, tokenizer), _once(Decoder, tokenizer)
        for batch in small_batches(batches, "text"):
            yield _decoded(_encoded(batch, encoder), decoder)

    rows, kind = _rows(docs, id_col, text_col)
    return rows.mapInArrow(run, f"id {kind}, n_tokens bigint, ids binary, text string")
