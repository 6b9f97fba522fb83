"""Licence scan: passages of documents against licence templates by the Dice coefficient over word bigrams.

Only DataFrame functions. A line is its words, letters and digits in lower case, so that the marks of
comments go, and a line of marks alone is empty. Passages are the lines, and all runs of lines
without an empty one that have no more words than a template could match. Dice = 2 * common /
(passage + template) over distinct bigrams; with a threshold t only templates of t / (2 - t) to
(2 - t) / t times the passage's bigrams can reach it, so the others are pruned by size before any
comparison. Alike notices of different licences are told apart by marker words, as version numbers
and "Affero": a passage must have those of the template and none that an alike template has beyond.
"""

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopfloor.llm.common import id_and_text
from shopfloor.llm.license_texts import MARKERS, TEMPLATES

THRESHOLD = 0.8
#: Templates of different licences with so large a Dice coefficient are alike.
ALIKE = 0.5


def words_of(text: str) -> list[str]:
    return [w.lower() for w in re.findall("[A-Za-z0-9]+", text)]


def bigrams_of(text: str) -> list[str]:
    words = words_of(text)
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def normalised(passage: Column) -> Column:
    return F.trim(F.lower(F.regexp_replace(passage, "[^A-Za-z0-9]+", " ")))


def longest(templates: Sequence[tuple[str, str]], threshold: float) -> int:
    """Words of the longest passage of different bigrams that can reach the threshold."""
    return int(max(len(bigrams_of(text)) for _, text in templates) * (2 - threshold) / threshold) + 1


def markers_of(templates: Sequence[tuple[str, str]]) -> list[tuple[list[str], list[str]]]:
    """For each template the markers it has, and all that decide: its own and those of alike templates of other licences."""
    own = [set(words_of(text)) & set(MARKERS) for _, text in templates]
    grams = [set(bigrams_of(text)) for _, text in templates]
    out = []
    for i, (name, _) in enumerate(templates):
        decide = set(own[i])
        for j, (other, _) in enumerate(templates):
            if other != name and grams[i] and 2 * len(grams[i] & grams[j]) >= ALIKE * (len(grams[i]) + len(grams[j])):
                decide |= own[j]
        out.append((sorted(own[i]), sorted(decide)))
    return out


def telling_words(templates: Sequence[tuple[str, str]], threshold: float) -> list[str]:
    """Words of which every passage that reaches the threshold for some template has one at least.

    Such a passage shares threshold / (2 - threshold) of the template's bigrams. So for each template
    words are taken, longest first, until the bigrams without any of them are fewer than that.
    """
    chosen: set[str] = set()
    for _, text in templates:
        grams = [set(g.split()) for g in bigrams_of(text)]
        needed = len(grams) * threshold / (2 - threshold)
        for word in sorted(set().union(*grams), key=lambda w: (w not in chosen, -len(w), w)) if grams else []:
            if sum(not (g & chosen) for g in grams) < needed:
                break
            chosen.add(word)
    return sorted(chosen)


def _has_one(text: Column, words: Sequence[str]) -> Column:
    lower = F.lower(text)
    found = F.lit(False)
    for word in words:
        found = found | F.contains(lower, F.lit(word))
    return found


def _run_length(lines: Column, words: Column, most: int, stop: Sequence[str] = ()) -> Column:
    """How many of ``lines``, from the first on, go with ``words`` words: none is empty or has a word of ``stop``, and all fit."""

    def step(at: Column, line: Column) -> Column:
        total = at["words"] + F.size(F.split(line, " "))
        ends = at["ended"] | (line == "") | (total > most)
        ends = ends | _has_one(line, stop) if stop else ends
        go_on = F.struct((at["n"] + 1).alias("n"), F.lit(False).alias("ended"), total.alias("words"))
        return F.when(ends, F.struct(at["n"].alias("n"), F.lit(True).alias("ended"), at["words"].alias("words"))).otherwise(go_on)

    start = F.struct(F.lit(0).alias("n"), F.lit(False).alias("ended"), words.alias("words"))
    return F.aggregate(lines, start, step)["n"]


def windows(docs: DataFrame, telling: Sequence[str], most: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, first, last, words): the passages that have a telling word, by their lines.

    A run is found from the first of its lines that has such a word, so it is found once. Runs of
    several lines have ``most`` words at most, a single line any number.
    """
    k, lines = F.col("k"), F.col("lines")
    found = (
        id_and_text(docs, id_col, text_col)
        # Texts without any telling word can't match; most end here, cheaply.
        .filter(_has_one(F.col("text"), telling))
        .select("doc_id", F.xxhash64("text").alias("text_key"), F.transform(F.split("text", "\n"), normalised).alias("lines"))
        .select("doc_id", "text_key", "lines", F.posexplode("lines").alias("k", "line"))
        .filter(_has_one(F.col("line"), telling))
    )
    size = F.size(F.split("line", " "))
    before = F.reverse(F.slice(lines, F.greatest(k - most + 1, F.lit(1)), F.least(k, F.lit(most))))
    after = F.slice(lines, k + 2, F.lit(most))
    found = found.withColumns({"back": _run_length(before, size, most, telling), "ahead": _run_length(after, size, most)})
    found = found.select("*", F.explode(F.sequence(k - F.col("back"), k)).alias("first"))
    found = found.select("*", F.explode(F.sequence(k, k + F.col("ahead"))).alias("last"))
    words = F.split(F.array_join(F.slice(lines, F.col("first") + 1, F.col("last") - F.col("first") + 1), " "), " ")
    found = found.select("doc_id", "text_key", "first", "last", words.alias("words"))
    return found.filter((F.col("first") == F.col("last")) | (F.size("words") <= most))


def scan(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = tuple(TEMPLATES),
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Matches (doc_id, passage, license, dice).

    A passage counts for the template it is most like, of all licences, if that is at ``threshold``
    or above; equal ones go to the first name. Of passages that overlap, directly or by others
    between them, the best one of each licence stays: the highest Dice, then the fewest lines, then
    the first. ``passage`` is the normalised text. A passage that stands several times in a document
    counts once, as do rows with equal id and text. Null and empty texts and passages of one word
    match nothing. The list of templates is given, so its size is fixed and its bigrams travel as literals.
    """
    grams = {i: bigrams_of(text) for i, (_, text) in enumerate(templates)}
    if not any(grams.values()):
        raise ValueError("no template has two words")
    ratio = threshold / (2 - threshold)
    fewest = min(len(g) for g in grams.values() if g) * ratio
    known = F.array(*[F.lit(g) for g in sorted({g for gs in grams.values() for g in gs})])
    texts = lambda values: F.array(*map(F.lit, values)).cast("array<string>")
    markers = markers_of(templates)
    table = F.array(
        *[
            F.struct(
                F.lit(templates[i][0]).alias("license"),
                texts(g).alias("grams"),
                texts(markers[i][0]).alias("has"),
                texts(markers[i][1]).alias("decide"),
            )
            for i, g in grams.items()
            if g
        ]
    )
    most = longest(templates, threshold)
    size, found = F.size("bigrams"), F.col("template.grams")
    units = (
        windows(docs, telling_words(templates, threshold), most, id_col, text_col)
        # A passage of n words has n - 1 bigrams at most.
        .filter(F.size("words") - 1 >= F.lit(fewest))
        .withColumn(
            "bigrams",
            F.array_distinct(
                F.zip_with(
                    F.slice("words", F.lit(1), F.size("words") - 1),
                    F.slice("words", F.lit(2), F.size("words") - 1),
                    lambda a, b: F.concat_ws(" ", a, b),
                )
            ),
        )
        .filter(F.arrays_overlap("bigrams", known))
    )
    place = ["doc_id", "text_key", "first", "last"]
    matched = (
        units.withColumn("template", F.explode(table))
        .filter((F.size(found) >= size * ratio) & (F.size(found) * ratio <= size))
        .withColumn("dice", F.lit(2.0) * F.size(F.array_intersect("bigrams", found)) / (size + F.size(found)))
        .filter(F.col("dice") >= threshold)
        .filter(F.array_sort(F.array_intersect(F.array_distinct("words"), "template.decide")) == F.col("template.has"))
        .groupBy(*place, F.array_join("words", " ").alias("passage"))
        .agg(F.min(F.struct((-F.col("dice")).alias("order"), F.col("template.license").alias("license"))).alias("best"))
        .select(*place, "passage", "best.license", (-F.col("best.order")).alias("dice"))
    )
    # Passages of one text that overlap form a group; it ends before a passage that begins after all before it.
    in_text = Window.partitionBy("doc_id", "text_key").orderBy("first", "last")
    reached = F.max("last").over(in_text.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.coalesce(F.col("first") > reached, F.lit(True)).cast("int")
    grouped = matched.withColumn("begins", begins).withColumn("group", F.sum("begins").over(in_text.rowsBetween(Window.unboundedPreceding, 0)))
    best = F.row_number().over(
        Window.partitionBy("doc_id", "text_key", "group", "license").orderBy(F.desc("dice"), F.col("last") - F.col("first"), "first")
    )
    return (
        grouped.withColumn("order", best)
        .filter("order = 1")
        .groupBy("doc_id", "passage", "license")
        .agg(F.max("dice").alias("dice"))
    )


def license_summary(docs: DataFrame, matches: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per document id: (doc_id, n_matches, licenses, best_license, best_dice).

    ``licenses`` is the sorted list joined by commas, null without a match. The best is the highest
    Dice, ties to the first name. Rows with equal ids are one document.
    """
    ids = docs.select(docs[id_col].cast("bigint").alias("doc_id"))
    blank = ids.withColumns({"license": F.lit(None).cast("string"), "dice": F.lit(None).cast("double")})
    best = F.min(F.when(F.col("license").isNotNull(), F.struct((-F.col("dice")).alias("order"), "license")))
    return (
        blank.unionByName(matches.select("doc_id", "license", "dice"))
        .groupBy("doc_id")
        .agg(
            F.count("license").alias("n_matches"),
            F.array_sort(F.collect_set("license")).alias("found"),
            best.alias("best"),
        )
        .select(
            "doc_id",
            "n_matches",
            F.when(F.size("found") > 0, F.array_join("found", ",")).alias("licenses"),
            F.col("best.license").alias("best_license"),
            (-F.col("best.order")).alias("best_dice"),
        )
    )
