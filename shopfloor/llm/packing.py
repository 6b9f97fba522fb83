"""Packing by concatenating and cutting: prefix sums give every document its place among all tokens.

The first pass turns texts into ids and writes them, with each task's running total; the tasks'
totals, one row each, are summed up in task order. The second pass cuts the documents where the
windows end. No row is moved between tasks for it.
"""

import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopfloor.llm.bpe import Kept, printable_bytes
from shopfloor.llm.common import checkpointed, small_batches, texts_of

WINDOW = 4096
SEPARATOR = 2

# Fixed values of the tokenizer: the pattern of pre-tokens, none of which holds white space.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class Words(Kept):
    """Ids of a tokenizer that drops white space and works word by word: word -> 32-bit ids.

    As no pre-token crosses white space, a text's ids are those of its words one after the other.
    Texts in which lower-casing or normalising could depend on neighbours, or that hold a special
    token, go to the tokenizers library whole. Single words are merged by tiktoken over the same
    vocabulary, with a byte that no text holds for the end of a word; the results are the same.
    """

    END = b"\xff"

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.pattern = regex.compile(WORDS)
        # Latin letters and common punctuation; no control, no combining character, no marker.
        self.other = re.compile(r"[^\t\n\r\x20-\x7e\xa1-\u012f\u0131-\u024f\u2010-\u2027\u2030-\u205e]|<\|")
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        special = {t["content"] for t in spec["added_tokens"]}
        suffix, to_byte = spec["model"]["end_of_word_suffix"], printable_bytes()
        ranks = {}
        for token, i in spec["model"]["vocab"].items():
            if token not in special:
                stem = token.removesuffix(suffix)
                ranks[bytes(to_byte[c] for c in stem) + (self.END if stem != token else b"")] = i
        self.merge = tiktoken.Encoding("words", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece

    def text(self, text: str) -> bytes:
        self.make_room()
        if self.other.search(text):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.__getitem__, text.lower().split()))

    def compute(self, word: str) -> bytes:
        if not word.isalpha():
            if word[-1] in ".,;:!?" and word[:-1].isalpha():
                return self[word[:-1]] + self[word[-1]]
            parts = self.pattern.findall(word)
            if len(parts) > 1:
                return b"".join([self[part] for part in parts])
        return array("I", self.merge(word.encode("utf-8") + self.END)).tobytes()


_words: dict[str, Words] = {}


def tokenized(docs: DataFrame, tokenizer: str, separator: int = SEPARATOR, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, part, before, doc_tokens, ids): ids end in the separator; ``before`` counts the task's earlier ids."""
    end = int(separator).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        if tokenizer not in _words:
            _words[tokenizer] = Words(tokenizer)
        words, total = _words[tokenizer], 0
        for batch in small_batches(batches, "text"):
            ids = [words.text(text) + end for text in texts_of(batch, "text")]
            counts = np.array([len(x) // 4 for x in ids], dtype=np.int64)
            before = total + np.cumsum(counts) - counts
            total += int(counts.sum())
            parts = pa.array(np.full(len(ids), part, dtype=np.int32))
            columns = [batch.column(0), parts, pa.array(before), pa.array(counts), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "before", "doc_tokens", "ids"])

    rows = docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, part int, before bigint, doc_tokens bigint, ids binary")


def _ids_between(start: Column, length: Column) -> Column:
    return F.substring(F.col("ids"), (start * 4 + 1).cast("int"), (length * 4).cast("int"))


def pack(
    docs: DataFrame,
    tokenizer: str,
    window: int = WINDOW,
    separator: int = SEPARATOR,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of documents in sequences of ``window`` ids: (doc_id, start, length, ids, doc_tokens, sequence_id, offset).

    Every id lies in one piece and every sequence but the last is full. ``ids`` holds the piece's
    ids as little-endian unsigned 32-bit integers, ``start`` its place in its document, ``offset``
    its place in its sequence. A null or empty text is the separator alone. Rows with equal ids are
    packed each for itself; an empty table gives no piece; other columns of ``docs`` are left out.
    """
    written = checkpointed(tokenized(docs, tokenizer, separator, id_col, text_col))
    # One row per task of the first pass: the only rows that meet in one task.
    totals = written.groupBy("part").agg(F.sum("doc_tokens").alias("total"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).cast("bigint").alias("base"))
    first = F.col("base") + F.col("before")
    begin = F.greatest(F.col("first"), F.col("sequence_id") * window)
    end = F.least(F.col("first") + F.col("doc_tokens"), (F.col("sequence_id") + 1) * window)
    return (
        written.join(F.broadcast(bases), "part")
        .withColumn("first", first)
        .withColumn("sequence_id", F.explode(F.sequence(F.expr(f"first div {window}"), F.expr(f"(first + doc_tokens - 1) div {window}"))))
        .withColumns({"start": begin - F.col("first"), "length": end - begin})
        .select(
            "doc_id",
            "start",
            "length",
            _ids_between(F.col("start"), F.col("length")).alias("ids"),
            "doc_tokens",
            "sequence_id",
            (F.col("first") + F.col("start") - F.col("sequence_id") * window).alias("offset"),
        )
    )
