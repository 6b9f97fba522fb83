"""The filter audit against a plain count over all orders, and the matrix against dictionaries."""

import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import zstandard


from shopfloor.llm import filters


def plain(rows, labels):
    smallest = {}
    for i, text, _ in rows:
        if i is not None:
            smallest[text or ""] = min(smallest.get(text or "", i), i)
    docs = []
    for i, text, lang in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": i is not None and smallest[text] < i,
        }
        own = [x for x in labels if x[0] == i and i is not None]
        docs.append((lang or "", fails, any(x[1] == 1 for x in own), any(x[2] == 1 for x in own)))
    out = {}
    for part in {d[0] for d in docs}:
        here = [d for d in docs if d[0] == part]
        shapley = Counter()
        for order in permutations("ABCDE"):
            for step, name in enumerate(order, 1):
                left = [d for d in here if not any(d[1][f] for f in order[: step - 1])]
                gone = [d for d in left if d[1][name]]
                shapley[name] += len(gone)
                failing = [d for d in here if d[1][name]]
                out[part, "".join(order), step] = [
                    len(left) - len(gone), len(gone), len(failing) - len(gone), sum(sum(d[1].values()) == 1 for d in failing),
                    sum(d[2] for d in gone), sum(d[3] for d in gone), name,
                ]
        for key, values in out.items():
            if key[0] == part:
                values[-1] = shapley[values[-1]]
    return out


def some_rows(n=150):
    rng = random.Random(21)
    texts = []
    for _ in range(n):
        words = [rng.choice(["a", "B", "CD", "é", "x|y", "100%"] + [f"w{rng.randrange(90)}" for _ in range(rng.choice([1, 30, 200]))]) for _ in range(rng.choice([3, 199, 200, 260]))]
        texts.append(rng.choice([" ", "\n", "\t "]).join(words))
    texts += [rng.choice(texts[:9]) for _ in range(80)] + ["", None, "  ", "", "ABC", "z " * 60_000, "# " * 199]
    rows = [(i if i % 11 else 1000 - i, t, rng.choice(["en", "de", None, ""])) for i, t in enumerate(texts)]
    return [*rows, (3, rows[3][1], "en"), (3, rows[3][1], "fr"), (None, rows[4][1], "en"), (None, rows[4][1], "en"), (5, "other text", "en")]


COLUMNS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def test_audit_against_all_orders(spark):
    rows = some_rows()
    rng = random.Random(1)
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(120)] + [(7, 1, 0), (7, 0, 1), (None, 1, 1), (99999, 1, 1)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, lang string, digest string, failed int")
    marks = spark.createDataFrame([(*r, "p") for r in labels], "doc_id bigint, quality int, toxic int, part string")
    wanted = plain(rows, labels)
    for size in (filters.SHARD_BYTES, 3000):
        found = filters.filter_audit(docs.repartition(4), marks, size).collect()
        assert len(found) == len(wanted) == 600 * len({r[2] or "" for r in rows})
        for r in found:
            assert [r[c] for c in COLUMNS] == wanted[r["part"], r["filter_order"], r["step"]]


def test_no_rows_and_no_words(spark):
    schema = "doc_id bigint, text string, lang string"
    marks = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert filters.filter_audit(spark.createDataFrame([], schema), marks).count() == 0
    alone = filters.filter_audit(spark.createDataFrame([(1, None, None)], schema), marks).collect()
    assert len(alone) == 600 and {r["part"] for r in alone} == {""} and {r["unique_fails"] for r in alone} == {0, 1}


def test_matrix_holds_every_word_under_one_code(spark):
    rows = some_rows(40)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    shards = filters.shards_of(docs, 2000)
    table = filters.codes_of(shards, slice_bytes=500)
    dictionary = {}
    for r in table.collect():
        for word, place in zip(zstandard.decompress(bytes(r["words"])).split(b" "), filters.unpacked(r["codes"]).tolist()):
            assert dictionary.setdefault(word.decode(), (r["slice"] << 32) + place) == (r["slice"] << 32) + place
    counted = Counter()
    for _, text, _ in rows:
        counted.update(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    assert set(dictionary) == set(counted) and len(set(dictionary.values())) == len(dictionary)
    assert shards.count() > 3 and table.select("slice").distinct().count() > 10
    found, totals = [], Counter()
    for r in filters.term_matrix(shards, table).collect():
        codes, counts = np.frombuffer(r["codes"], "<i8").tolist(), filters.unpacked(r["counts"]).tolist()
        for i, doc in enumerate(r["ids"]):
            cells = range(r["starts"][i], r["starts"][i + 1])
            assert len({codes[c] for c in cells}) == len(cells)
            found.append((doc or -1, sum(counts[c] for c in cells), len(cells)))
            for c in cells:
                totals[codes[c]] += counts[c]
    assert totals == {dictionary[w]: n for w, n in counted.items()}
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t, _ in rows]
    assert sorted(found) == sorted((r[0] or -1, len(w), len(set(w))) for r, w in zip(rows, words))
