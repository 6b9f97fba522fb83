"""Language identification by mixtures: which languages a text is made of, and in what proportions.

Each language has a distribution over hashed byte trigrams of lower-cased letters. A text's
proportions are found by expectation-maximisation; starting from the single most likely language,
each other one joins the set if the log-likelihood gains more than a penalty. For one that joins, the
gain is at most N log(max g / N), where N is the number of trigrams and g a language's sum of counts
times its probability over that of the present mixture. So languages are tried in the order of g,
and those whose bound is within the penalty are ruled out for certain before any round. The
proportions start equal and take a fixed number of rounds, after which the gain of a passage of very
few words in a long text can still be too small. The language with the largest proportion in the
chosen set is the answer.
"""

import re
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfloor.llm.common import filtered, id_and_text, small_batches, texts_of

BINS = 1 << 14
UNKNOWN = "und"
PENALTY, ROUNDS = 4.0, 12
#: Numbers that are neither letters nor decimal digits, as superscripts and fractions.
_NUMBERS = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c) in ("No", "Nl"))
NOT_LETTERS, OTHER_NUMBERS = re.compile(r"[\W\d_]+"), re.compile(f"[{re.escape(_NUMBERS)}]+")
#: Those below U+0100 and all characters from the next one on: a class that is searched for fast.
_MAY_BE_NUMBER = re.compile(f"[{''.join(c for c in _NUMBERS if c < chr(256))}{min(c for c in _NUMBERS if c > chr(255))}-{chr(sys.maxunicode)}]")
_ASCII_LETTERS = bytes(c if chr(c).isalpha() else 32 for c in range(128)) + bytes(128)


def letters_of(text: str) -> bytes:
    """The words of letters of a text in lower case, with one blank between."""
    lower = text.lower()
    if lower.isascii():
        return b" ".join(lower.encode().translate(_ASCII_LETTERS).split())
    letters = NOT_LETTERS.sub(" ", lower)
    if _MAY_BE_NUMBER.search(letters):
        letters = NOT_LETTERS.sub(" ", OTHER_NUMBERS.sub(" ", letters))
    return letters.strip().encode("utf-8")


def trigram_counts(text: str) -> np.ndarray | None:
    """Counts of the hashed trigrams of a text's letters; None if it has no letter."""
    letters = letters_of(text)
    if not letters:
        return None
    raw = np.frombuffer(b" " + letters + b" ", dtype=np.uint8).astype(np.uint32)
    codes = (raw[:-2] << np.uint32(16)) | (raw[1:-1] << np.uint32(8)) | raw[2:]
    return np.bincount((codes * np.uint32(2654435761)) >> np.uint32(18), minlength=BINS)


class Model:
    """Trigram probabilities of the learned languages, in the order of their names."""

    def __init__(self, counts: dict[str, np.ndarray], smoothing: float = 0.5):
        self.names = sorted(counts)
        table = np.stack([counts[n] for n in self.names]).astype(np.float64) + smoothing if self.names else np.zeros((0, BINS))
        self.p = table / table.sum(axis=1, keepdims=True) if self.names else table
        self.log = np.log(self.p)

    @staticmethod
    def mixture(p: np.ndarray, counts: np.ndarray, rounds: int) -> tuple[np.ndarray, float]:
        """Proportions of the languages by expectation-maximisation, and the log-likelihood they give."""
        share, total = np.full(len(p), 1 / len(p)), counts.sum()
        for _ in range(rounds):
            joint = share[:, None] * p
            share = joint @ (counts / joint.sum(axis=0)) / total
        return share, float(counts @ np.log(share @ p))

    def languages(self, text: str, penalty: float, rounds: int) -> tuple[str, float, list[tuple[str, float]]]:
        """(language, score, chosen set with proportions)."""
        found = trigram_counts(text) if self.names else None
        if found is None:
            return UNKNOWN, 0.0, []
        bins = np.flatnonzero(found)
        counts, p = found[bins].astype(np.float64), self.p[:, bins]
        single = self.log[:, bins] @ counts
        best = int(single.argmax())
        posterior = 1 / np.exp(np.clip(single - single[best], -700, 0)).sum()
        chosen, shares, likelihood = [best], np.ones(1), single[best]
        total = counts.sum()
        cost = penalty * np.log1p(total)
        tried = {best}
        while len(tried) < len(self.names):
            g = p @ (counts / (shares @ p[chosen]))
            bound = total * np.log(np.maximum(g, g[chosen].max()) / total)
            open_ = [i for i in np.argsort(-g, kind="stable").tolist() if i not in tried and bound[i] > cost]
            if not open_:
                break
            i = open_[0]
            tried.add(i)
            more, gained = self.mixture(p[[*chosen, i]], counts, rounds)
            if gained - likelihood > cost:
                chosen, shares, likelihood = [*chosen, i], more, gained
        main = int(np.lexsort((chosen, -shares))[0])
        score = float(shares[main]) * (float(posterior) if len(chosen) == 1 else 1.0)
        return self.names[chosen[main]], min(1.0, score), [(self.names[c], float(s)) for c, s in zip(chosen, shares)]


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Counts over all rows with a language and a letter; the driver gets ``BINS`` numbers a language at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in small_batches(batches, "text"):
            for text, lang in zip(texts_of(batch, "text"), texts_of(batch, "lang")):
                found = trigram_counts(text)
                if found is not None:
                    totals[lang] = totals[lang] + found if lang in totals else found.astype(np.int64)
        for lang, found in totals.items():
            bins = np.flatnonzero(found)
            columns = [pa.array([lang] * len(bins), pa.string()), pa.array(bins.astype(np.int32)), pa.array(found[bins])]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "bin", "n"])

    rows = docs.select(docs[text_col].alias("text"), docs[lang_col].alias("lang")).filter("text IS NOT NULL AND lang IS NOT NULL")
    sums = rows.mapInArrow(count, "lang string, bin int, n bigint").groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    table = sums.toArrow()
    names = table.column("lang").combine_chunks().dictionary_encode()
    totals = np.zeros((len(names.dictionary), BINS), np.int64)
    totals[names.indices.to_numpy(), table.column("bin").to_numpy()] = table.column("n").to_numpy()
    counts = dict(zip(names.dictionary.to_pylist(), totals))
    return Model(counts)


def identify(
    docs: DataFrame, model: Model, penalty: float = PENALTY, rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, lang_pred, score, languages) for every row, whatever its id.

    ``languages`` lists the chosen set as name:proportion. ``score`` is the main language's
    proportion, times its posterior probability where it is the only one. A null text, one without
    letters, or a model without languages gives ``und`` with score 0 and an empty list; equal
    likelihoods go to the first name. Other columns are left out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            found = [shared.value.languages(text, penalty, rounds) for text in texts_of(batch, "text")]
            named = [",".join(f"{name}:{share:.3f}" for name, share in x[2]) for x in found]
            columns = [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64()), pa.array(named, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "lang_pred", "score", "languages"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, lang_pred string, score double, languages string")


def accepted(
    docs: DataFrame, model: Model, least_score: float = 0.35, penalty: float = PENALTY, rounds: int = ROUNDS, text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` with a main language: not ``und``, and a score of ``least_score`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def accepts(texts: list[str]) -> list[bool]:
        found = (shared.value.languages(text, penalty, rounds) for text in texts)
        return [name != UNKNOWN and score >= least_score for name, score, _ in found]

    return filtered(docs, text_col, accepts)
