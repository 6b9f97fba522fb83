"""Tokens, packing, language, quality, fingerprints and licences on small tables, against plain versions."""

import hashlib
import math
import random
import textwrap
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shopfloor.llm import bpe, imatch, langid, licenses, packing, quality

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PIECES = [
    "a", "the", " ", "  ", "\n", "\t", "'s", "'S", "é", "é", "ß", "Σ", "漢字", "😀", "\xa0", "\x85", "\x1c", "​", "1", "½",
    "!", "...", "<|", "|>", "<|endoftext|>", "<|startoftext|>", "ing", "\r\n", "　", "İ", "aaaa", "\\",
]


def odd_texts(n: int) -> list[str]:
    rng = random.Random(5)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 25))) for _ in range(n)]


def documents(spark, texts, **more):
    """Columns whose names clash with those the operators make."""
    rows = [(i, t, "x", "y", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, ids string, score string, part int")


def ids_of(data: bytes) -> list[int]:
    return np.frombuffer(data, "<u4").tolist()


def test_byte_bpe_equals_the_library(spark):
    texts = [None, "", *odd_texts(800), "x" * 50_000, "<|endoftext|>"]
    library = Tokenizer.from_file(BYTE)
    rows = {r["id"]: r for r in bpe.decode(bpe.encode(documents(spark, texts), BYTE), BYTE).collect()}
    assert {r["id"]: r for r in bpe.round_trip(documents(spark, texts), BYTE).collect()} == rows
    for i, text in enumerate(texts):
        wanted = library.encode(text or "", add_special_tokens=False).ids
        assert ids_of(rows[i]["ids"]) == wanted and rows[i]["n_tokens"] == len(wanted)
        assert rows[i]["text"] == library.decode(wanted, skip_special_tokens=False)


def test_bpe_of_no_rows_and_repeated_rows(spark):
    assert bpe.decode(bpe.encode(documents(spark, []), BYTE), BYTE).count() == 0
    twice = documents(spark, ["ab"]).unionByName(documents(spark, ["ab"]))
    assert bpe.encode(twice, BYTE).count() == 2
    assert bpe.round_trip(twice, BYTE).count() == 2 and bpe.round_trip(documents(spark, []), BYTE).count() == 0


def test_packing_holds_every_id_once(spark):
    texts = [None, "", *odd_texts(600), "the word " * 6000]
    library = Tokenizer.from_file(WORD)
    wanted = [library.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]
    rows = packing.pack(documents(spark, texts).repartition(5), WORD, window=64).collect()
    found = {i: [None] * len(w) for i, w in enumerate(wanted)}
    places = {}
    for r in rows:
        assert r["length"] > 0 and r["doc_tokens"] == len(wanted[r["doc_id"]])
        for k, token in enumerate(ids_of(r["ids"])):
            assert found[r["doc_id"]][r["start"] + k] is None
            found[r["doc_id"]][r["start"] + k] = token
            assert (r["sequence_id"], r["offset"] + k) not in places
            places[r["sequence_id"], r["offset"] + k] = token
    assert [found[i] for i in range(len(texts))] == wanted
    total = sum(map(len, wanted))
    assert set(places) == {divmod(i, 64) for i in range(total)}


def test_packing_of_no_rows(spark):
    assert packing.pack(documents(spark, []), WORD).count() == 0
    assert packing.pack(documents(spark, [None, None]), WORD).select("length").distinct().count() == 1


def test_language_of_each_and_of_mixed_texts(spark):
    rng = random.Random(1)
    known = {"xx": ["bana", "nana", "baba", "naba"], "yy": ["kiru", "ruki", "kiki", "ruru"], "zz": ["sólé", "lésó", "sósó"]}
    line = lambda lang, n=40: " ".join(rng.choice(known[lang]) for _ in range(n))
    learned = [(line(lang), lang) for lang in known for _ in range(20)] + [(None, "xx"), ("bana", None), ("123", "qq")]
    model = langid.learn(spark.createDataFrame(learned, "text string, lang string"))
    assert model.names == ["xx", "yy", "zz"]
    texts = [line("xx"), line("yy").upper(), line("zz"), line("xx", 60) + " " + line("yy", 20), "12 34 !", "", None]
    rows = {r["doc_id"]: r for r in langid.identify(documents(spark, texts), model).collect()}
    assert [rows[i]["lang_pred"] for i in range(7)] == ["xx", "yy", "zz", "xx", "und", "und", "und"]
    assert rows[3]["languages"].startswith("xx:0.7") and ",yy:0.2" in rows[3]["languages"]
    assert all(0 <= r["score"] <= 1 for r in rows.values()) and rows[4]["score"] == 0
    kept = langid.accepted(documents(spark, texts), model)
    assert {r["doc_id"] for r in kept.collect()} == {0, 1, 2, 3} and kept.columns == documents(spark, []).columns


def plain_languages(model, text, penalty, rounds):
    """The language set by trying every language in the same order, without bounds, and its proportions."""
    found = langid.trigram_counts(text)
    if found is None:
        return "und", []
    at = [i for i in range(langid.BINS) if found[i]]
    n = [float(found[i]) for i in at]
    p = [[float(row[i]) for i in at] for row in model.p]
    likelihood_of = lambda shares, rows: sum(c * math.log(sum(s * r[k] for s, r in zip(shares, rows))) for k, c in enumerate(n))

    def proportions(rows):
        shares = [1 / len(rows)] * len(rows)
        for _ in range(rounds):
            mix = [sum(s * r[k] for s, r in zip(shares, rows)) for k in range(len(n))]
            shares = [sum(c * s * r[k] / mix[k] for k, c in enumerate(n)) / sum(n) for s, r in zip(shares, rows)]
        return shares

    single = [likelihood_of([1.0], [row]) for row in p]
    chosen = [single.index(max(single))]
    shares, likelihood, tried = [1.0], max(single), set(chosen)
    while len(tried) < len(p):
        mix = [sum(s * p[j][k] for s, j in zip(shares, chosen)) for k in range(len(n))]
        g = [sum(c * row[k] / mix[k] for k, c in enumerate(n)) for row in p]
        i = max((j for j in range(len(p)) if j not in tried), key=lambda j: g[j])
        tried.add(i)
        more = proportions([p[j] for j in [*chosen, i]])
        gained = likelihood_of(more, [p[j] for j in [*chosen, i]])
        if gained - likelihood > penalty * math.log1p(sum(n)):
            chosen, shares, likelihood = [*chosen, i], more, gained
    return model.names[max(zip(shares, [-c for c in chosen]))[1] * -1], sorted((model.names[c], s) for c, s in zip(chosen, shares))


def test_languages_equal_those_found_without_bounds():
    rng = random.Random(4)
    words = {f"l{i}": ["".join(rng.choice("abcdefghijklm"[i : i + 7]) for _ in range(rng.randint(2, 6))) for _ in range(150)] for i in range(6)}
    text_in = lambda name, n: " ".join(rng.choice(words[name]) for _ in range(n))
    model = langid.Model({name: langid.trigram_counts(text_in(name, 2000)) for name in words})
    texts = [text_in("l0", 30), text_in("l1", 200) + " " + text_in("l4", 60), " ".join(text_in(f"l{i}", 40) for i in (2, 3, 5)), "a", "aa bb", "12", "Ab" * 500]
    texts += [" ".join(rng.choice(words[rng.choice(list(words))]) for _ in range(50)) for _ in range(5)]
    for text in texts:
        main, score, found = model.languages(text, langid.PENALTY, langid.ROUNDS)
        wanted, proportions = plain_languages(model, text, langid.PENALTY, langid.ROUNDS)
        assert main == wanted and 0 <= score <= 1 and [n for n, _ in sorted(found)] == [n for n, _ in proportions]
        assert [s for _, s in sorted(found)] == pytest.approx([s for _, s in proportions])


def test_numbers_that_are_no_letters_and_repeated_rows(spark):
    model = langid.learn(spark.createDataFrame([("bana nana", "xx"), ("kiru ruki", "yy")], "text string, lang string"))
    texts = ["²½", "Ⅷ ① ٣", "x²", "漢", "ー", "bana " * 50_000, "bana", "bana"]
    rows = {r["doc_id"]: r for r in langid.identify(documents(spark, texts), model).collect()}
    assert [rows[i]["lang_pred"] == "und" for i in range(8)] == [True, True, False, False, False, False, False, False]
    assert rows[5]["lang_pred"] == rows[6]["lang_pred"] == "xx" and rows[6]["score"] == rows[7]["score"]
    # Equal likelihoods go to the first name.
    even = langid.Model({"b": np.ones(langid.BINS, np.int64), "a": np.ones(langid.BINS, np.int64)})
    assert even.languages("any text", langid.PENALTY, langid.ROUNDS)[0] == "a"
    doubled = documents(spark, ["bana"]).unionByName(documents(spark, ["bana"]))
    assert langid.identify(doubled, model).count() == 2


def test_language_without_anything_learned(spark):
    empty = langid.learn(spark.createDataFrame([], "text string, lang string"))
    assert [r["lang_pred"] for r in langid.identify(documents(spark, ["abc"]), empty).collect()] == ["und"]
    assert langid.identify(documents(spark, []), empty).count() == 0


def test_mixture_likelihood_never_falls():
    rng = np.random.default_rng(0)
    p = rng.dirichlet(np.ones(50), 3)
    counts = rng.integers(1, 9, 50).astype(float)
    values = [langid.Model.mixture(p, counts, n)[1] for n in range(1, 12)]
    assert all(b >= a - 1e-9 for a, b in zip(values, values[1:]))


def good_and_bad(n: int) -> tuple[list[str], list[int]]:
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    good = [" ".join(word() for _ in range(60)).capitalize() + "." for _ in range(n)]
    bad = [" ".join(word() + rng.choice(["###", "$$$"]) for _ in range(60)) for _ in range(n)]
    return [t for pair in zip(good, bad) for t in pair], [1, 0] * n


def test_quality_on_held_out_texts(spark):
    texts, labels = good_and_bad(60)
    marks = spark.createDataFrame([(i, y) for i, y in enumerate(labels)] + [(None, 1), (1, None), (2, 7)], "doc_id bigint, quality int")
    held = quality.in_fold(F.col("doc_id"))
    docs = documents(spark, [*texts, None, "", "a"])
    model = quality.learn(docs, marks.filter(~held))
    rows = quality.classify(docs, model).withColumn("held_out", held).collect()
    assert len(rows) == len(texts) + 3 and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    tested = [r for r in rows if r["held_out"] and r["doc_id"] < len(texts)]
    assert tested and all(r["predicted"] == labels[r["doc_id"]] for r in tested)
    assert quality.accepted(docs, model).columns == docs.columns


def test_quality_scores_are_the_exact_neighbours_votes(spark):
    texts, labels = good_and_bad(20)
    rows = [quality.features(t) for t in texts]
    table = np.zeros((len(rows), quality.BINS + quality.SHAPES), np.float32)
    for i, (index, weight) in enumerate(rows):
        table[i, index] = weight
    model = quality.Model(quality.decompose(table, 8), np.zeros((0, 1)), np.array(labels, float), 0.5, neighbours=5)
    model.vectors = model.latent(rows)
    score = model.scores(texts[:6])
    near = model.latent(rows[:6]) @ model.vectors.T
    for i in range(6):
        best = sorted(range(len(texts)), key=lambda j: -near[i, j])[:5]
        weight = [max(near[i, j], 0.0) ** 8 for j in best]
        assert score[i] == pytest.approx(sum(w * labels[j] for w, j in zip(weight, best)) / sum(weight), abs=1e-4)


def test_quality_without_labels(spark):
    model = quality.learn(documents(spark, ["abc"]), spark.createDataFrame([], "doc_id bigint, quality int"))
    assert [r["score"] for r in quality.classify(documents(spark, ["abcdef", None]), model).collect()] == [0.5, 0.5]


def test_fingerprints_of_edited_texts(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghijkl") for _ in range(5)) for _ in range(400)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice([1, 5, 40, 300]))) for _ in range(120)] + [None, "", "!?"]
    texts[7] = texts[6]
    docs = documents(spark, texts).repartition(4)
    lexicon = imatch.learn_lexicon(docs, low=0.01, high=0.5)
    rows = {r["doc_id"]: r for r in imatch.edited_likeness(docs, lexicon, buckets=5).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        own, after = text or "", texts[(i + 1) % len(texts)] or ""
        half = len(own) // 2
        edited = own[: len(own) - half] + after[:half]
        r = rows[i]
        assert r["n_chars"] == len(own) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"] == imatch.fingerprint(own, lexicon) and r["edited_fingerprint"] == imatch.fingerprint(edited, lexicon)
        assert r["near_next"] == imatch.likeness(r["fingerprint"], rows[(i + 1) % len(texts)]["fingerprint"])
    assert rows[6]["fingerprint"] == rows[7]["fingerprint"] and rows[6]["near_next"] == 1.0
    long_ones = [r for i, r in rows.items() if texts[i] and len(texts[i].split()) >= 40 and i != 6]
    assert np.mean([r["near_edited"] > r["near_next"] for r in long_ones]) > 0.8


def test_lexicon_is_the_band_of_document_frequencies(spark):
    texts = ["Common rare1", "common MID", "common mid", "common", "mid, mid", None, ""]
    wanted = imatch.term_hashes("mid")
    assert imatch.learn_lexicon(documents(spark, texts).repartition(3), low=2 / 7, high=3 / 7).tolist() == wanted.tolist()
    assert imatch.learn_lexicon(documents(spark, [])).tolist() == []


def test_ranges_of_ids_follow_the_bytes_of_texts(spark):
    docs = documents(spark, ["x" * 1000] * 64 + [None, ""])
    least = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert [imatch.buckets_of(docs, bucket_bytes=n) for n in (10**6, 1000, 999, 100)] == [least, 64, 65, 640]
    assert imatch.buckets_of(documents(spark, [])) == least
    empty = np.zeros(0, np.uint64)
    assert sorted(map(tuple, imatch.edited_likeness(docs, empty).collect())) == sorted(map(tuple, imatch.edited_likeness(docs, empty, 7).collect()))


def test_fingerprints_of_few_rows(spark):
    empty = np.zeros(0, np.uint64)
    assert imatch.edited_likeness(documents(spark, []), empty, 4).count() == 0
    one = imatch.edited_likeness(documents(spark, ["ab cd"]), empty, 4).first()
    assert one["near_next"] == 1.0 and one["edited_sha256"] == hashlib.sha256(b"ab ab").hexdigest()
    repeated = documents(spark, ["b b"]).unionByName(documents(spark, ["b b"]))
    assert imatch.edited_likeness(repeated, empty, 4).count() == 2


def plain_dice(a: str, b: str) -> float:
    x, y = set(licenses.bigrams_of(a)), set(licenses.bigrams_of(b))
    return 2.0 * len(x & y) / (len(x) + len(y)) if x or y else 0.0


def plain_licenses(text: str) -> set[tuple[str, str, float]]:
    """All lines and runs of lines of at most the longest passage's words, each against every template."""
    lines = [" ".join(licenses.words_of(line)) for line in (text or "").split("\n")]
    most, markers = licenses.longest(licenses.TEMPLATES, licenses.THRESHOLD), licenses.markers_of(licenses.TEMPLATES)
    found = []
    for first in range(len(lines)):
        for last in range(first, len(lines)):
            passage = " ".join(lines[first : last + 1])
            if not lines[last] or (last > first and len(passage.split()) > most):
                break
            scored = []
            for (name, template), (has, decide) in zip(licenses.TEMPLATES, markers):
                dice = plain_dice(passage, template)
                if dice >= licenses.THRESHOLD and sorted(set(passage.split()) & set(decide)) == has:
                    scored.append((-dice, name))
            if scored:
                found.append((first, last, *min(scored), passage))
    found.sort()
    groups, reached = [], -1
    for match in found:
        if match[0] > reached:
            groups.append([])
        groups[-1].append(match)
        reached = max(reached, match[1])
    out = {}
    for group in groups:
        for name in {m[3] for m in group}:
            best = min((m for m in group if m[3] == name), key=lambda m: (m[2], m[1] - m[0], m[0]))
            out[best[4], name] = max(-best[2], out.get((best[4], name), 0))
    return {(p, n, d) for (p, n), d in out.items()}


GPL3, GPL2 = ([t for n, t in licenses.TEMPLATES if n == name][2] for name in ("GPL-3.0", "GPL-2.0"))
AGPL = [t for n, t in licenses.TEMPLATES if n == "AGPL-3.0"][2]


def wrapped(text: str, width: int, mark: str) -> str:
    return "\n".join(mark + line for line in textwrap.wrap(text, width))


def test_licenses_against_all_windows(spark):
    templates = licenses.TEMPLATES
    header = "# Copyright 2024 Somebody, version 2.1 of the tool\n#\n" + wrapped(GPL3, 50, "# ") + "\n#\nimport os\nlicense = None"
    texts = [
        "Some prose.\nLicensed under the Apache License, Version 2.0.\nMore.",
        "licensed UNDER cc by-nc 4.0",
        "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software",
        templates[6][1].replace(", ", ",\n").replace("copy", "duplicate", 1) + "\n\nand prose",
        "Released under the MIT License.\nReleased under the MIT License.",
        "License", "", None, "a b c d e f g", "from " * 3000,
        header, wrapped(GPL2, 40, " * ") + "\n" + templates[4][1], "// " + AGPL, wrapped(GPL3, 30, "-- ") + "\nprose after it\n" + wrapped(AGPL, 70, "; "),
        "License\n" * 400, "one line " * 500 + "\nLicensed under CC BY 4.0.",
    ]
    docs = documents(spark, texts)
    docs = docs.unionByName(docs.filter("doc_id = 0"))
    found = {(r["doc_id"], r["passage"], r["license"]): r["dice"] for r in licenses.scan(docs).collect()}
    wanted = {(i, p, n): d for i, text in enumerate(texts) for p, n, d in plain_licenses(text)}
    assert found == pytest.approx(wanted)
    summary = {r["doc_id"]: r for r in licenses.license_summary(docs, licenses.scan(docs)).collect()}
    assert len(summary) == len(texts) and summary[7]["n_matches"] == 0 and summary[7]["licenses"] is None
    assert summary[0]["best_license"] == "Apache-2.0" and summary[4]["n_matches"] == 1
    assert summary[10]["licenses"] == "GPL-3.0" and summary[10]["best_dice"] == 1.0
    assert summary[11]["licenses"] == "GPL-2.0,MIT" and summary[12]["licenses"] == "AGPL-3.0" and summary[13]["licenses"] == "AGPL-3.0,GPL-3.0"
    assert licenses.license_summary(documents(spark, []), licenses.scan(documents(spark, []))).count() == 0


def test_alike_licenses_are_told_apart(spark):
    work, commons = "This work is licensed under the GNU {}, version {}.", "This work is licensed under a Creative Commons Attribution{} International License."
    cases = {
        work.format("General Public License", 2): "GPL-2.0",
        work.format("General Public License", 3): "GPL-3.0",
        work.format("General Public License", 1): None,
        work.format("Affero General Public License", 3): "AGPL-3.0",
        work.format("Lesser General Public License", 3): "LGPL-3.0",
        work.format("Lesser General Public License", "2.1"): "LGPL-2.1",
        work.format("Library General Public License", 2): "LGPL-2.0",
        GPL2: "GPL-2.0", GPL3: "GPL-3.0", AGPL: "AGPL-3.0",
        commons.format(" 4.0"): "CC-BY-4.0",
        commons.format("-NonCommercial 4.0"): "CC-BY-NC-4.0",
        commons.format("-ShareAlike 4.0"): "CC-BY-SA-4.0",
        commons.format("-NoDerivatives 4.0"): "CC-BY-ND-4.0",
        commons.format("-NonCommercial-ShareAlike 4.0"): "CC-BY-NC-SA-4.0",
        commons.format("-NoDerivatives 3.0"): None,
        "Licensed under CC BY-NC-ND 4.0.": "CC-BY-NC-ND-4.0",
        "Licensed under the Apache License, Version 1.1.": None,
    }
    docs = documents(spark, list(cases))
    found = {r["doc_id"]: r["licenses"] for r in licenses.license_summary(docs, licenses.scan(docs)).collect()}
    assert [found[i] for i in range(len(cases))] == list(cases.values())


def test_a_short_passage_in_another_language_is_found():
    rng = random.Random(2)
    words = {name: ["".join(rng.choice(letters) for _ in range(rng.randint(3, 8))) for _ in range(300)] for name, letters in
             {"a": "aeioulmnr", "b": "aeiszkptr", "c": "aouybdgvn"}.items()}
    text_in = lambda name, n: " ".join(rng.choice(words[name]) for _ in range(n))
    model = langid.Model({name: langid.trigram_counts(text_in(name, 5000)) for name in words})
    text = text_in("a", 10_000) + " " + text_in("b", 300) + " " + text_in("a", 10_000)
    main, _, found = model.languages(text, langid.PENALTY, langid.ROUNDS)
    assert main == "a" and [name for name, _ in found] == ["a", "b"]
    assert [name for name, _ in model.languages(text_in("a", 20_000), langid.PENALTY, langid.ROUNDS)[2]] == ["a"]
