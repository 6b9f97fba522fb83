"""Language-model scores against a plain model of dictionaries, and the filter's own promises."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from shopfloor.llm import lm
from shopfloor.llm.words import words_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), None]


def read_back(count):
    """What a count becomes in levels."""
    level = 0
    edges = [math.ceil(1.5**i - 1e-9) for i in range(60)]
    while edges[level] <= count:
        level += 1
    low, high = edges[level - 1], max(edges[level] - 1, edges[level - 1])
    return (low + high) / 2


def plain_scores(learned, texts, order, prior):
    grams = [Counter() for _ in range(order)]
    for text in learned:
        tokens = ["<s>"] * (order - 1) + plain_tokens(text)
        for i in range(order - 1, len(tokens)):
            for n in range(order):
                grams[n][tuple(tokens[i - n : i + 1])] += 1
    total, distinct = sum(grams[0].values()), len(grams[0])
    out = []
    for text in texts:
        tokens = ["<s>"] * (order - 1) + plain_tokens(text)
        base = score = known = 0
        for i in range(order - 1, len(tokens)):
            def times(start, end):
                """The count of a part of the text, no larger than those of its own parts."""
                if all(t == "<s>" for t in tokens[start:end]):
                    return float(len(learned))
                if end - start == 1:
                    return float(grams[0][tuple(tokens[start:end])])
                seen = grams[end - start - 1][tuple(tokens[start:end])]
                return min(read_back(seen) if seen else 0.0, times(start, end - 1), times(start + 1, end))

            c = grams[0][(tokens[i],)]
            p = (c + 1) / (total + distinct + 1)
            base += math.log10(p)
            known += c > 0
            for n in range(1, order):
                p = (times(i - n, i + 1) + prior * p) / (times(i - n, i) + prior)
            score += math.log10(p)
        out.append((len(tokens) - order + 1, known, base, score))
    return out


def documents(spark, texts):
    rows = [(i, t, "x", 0.5, 3) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, slice string, score double, n_tokens int")


def some_texts(n=60):
    rng = random.Random(14)
    words = ["a", "A", "the", "é", "x\x85y", "　", "Ä", "ä", "long" * 3000, "b,", "c"]
    gaps = [" ", "\n", "\t", "\x0b", "  ", "\r\n"]
    texts = ["".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randint(0, 40))) for _ in range(n)]
    return [*texts, None, "", "  ", texts[0], "unseen words here", "the end", "w " * 50_000]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_against_dictionaries(spark, order):
    texts = some_texts()
    docs = documents(spark, texts).repartition(4)
    # So many hashes that no probe of these few n-grams is wrong.
    model = lm.learn(docs.filter("doc_id % 4 <> 1"), order, prior=5.0, hashes=24)
    wanted = plain_scores([t for i, t in enumerate(texts) if i % 4 != 1], texts, order, 5.0)
    for limit in (lm.BROADCAST_BYTES, -1):
        found = {r["doc_id"]: r for r in lm.score(docs, model, broadcast_bytes=limit).collect()}
        assert len(found) == len(texts)
        for i, (n, known, base, score) in enumerate(wanted):
            assert (found[i]["n_tokens"], found[i]["n_known"]) == (n, known)
            assert found[i]["base_score"] == pytest.approx(base, rel=1e-9) and found[i]["score"] == pytest.approx(score, rel=1e-9)


def test_repeated_rows_missing_ids_and_no_rows(spark):
    docs = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, "a b"), (1, "a b"), (1, "c")], "doc_id bigint, text string")
    model = lm.learn(docs)
    assert (model.tokens, model.words, model.docs) == (14, 4, 5)
    for limit in (lm.BROADCAST_BYTES, -1):
        rows = lm.score(docs, model, broadcast_bytes=limit).collect()
        assert sorted((r["doc_id"] or -1, r["n_tokens"]) for r in rows) == [(-1, 3), (-1, 3), (1, 2), (1, 3), (1, 3)]
        assert lm.score(docs.limit(0), model, broadcast_bytes=limit).count() == 0
    empty = lm.learn(docs.limit(0))
    assert (empty.tokens, empty.words) == (0, 0)
    for limit in (lm.BROADCAST_BYTES, -1):
        assert {(r["n_known"], r["base_score"], r["score"]) for r in lm.score(docs, empty, broadcast_bytes=limit).collect()} == {(0, 0.0, 0.0)}


def test_levels_are_never_read_too_low_and_seldom_too_high():
    rng = np.random.default_rng(3)
    numbers = rng.integers(1, 2**63, 20_000, dtype=np.uint64)
    levels = lm.levels_of(rng.geometric(0.4, 20_000) ** 3)
    bits = lm.bloom(numbers, levels, 8)
    raw = np.packbits(bits, bitorder="little")
    asked = np.concatenate([numbers, rng.integers(1, 2**63, 20_000, dtype=np.uint64)])
    read = lm.read_levels(asked, raw, np.zeros(len(asked), np.int64), np.full(len(asked), len(bits), np.uint64), 8)
    wanted = np.concatenate([levels, np.zeros(20_000, np.int64)])
    assert (read >= wanted).all() and (read != wanted).mean() < 0.008
    assert [int(x) for x in lm.levels_of(np.array([1, 2, 3, 4, 5, 6, 7, 8]))] == sorted(lm.levels_of(np.arange(1, 9)).tolist())


def test_words_have_one_number_wherever_they_stand():
    texts = ["ab cd", "", "cd  ab\x0b", "x" * 300_000 + " ab", "é ab " * 60_000, "ab"]
    found = words_of(pa.array(texts))
    seen = {}
    plain = [(r, w) for r, t in enumerate(texts) for w in re.findall(r"[^\x20\x09-\x0D]+", t)]
    assert [r for r, _ in plain] == found.rows.tolist()
    for (_, word), number in zip(plain, found.numbers.tolist()):
        assert seen.setdefault(word, number) == number
    assert len(set(seen.values())) == len(seen)
    part = words_of(pa.array(texts).slice(2, 1))
    assert part.numbers.tolist() == found.numbers[2:4].tolist()
