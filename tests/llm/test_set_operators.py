"""Search, near duplicates, pages, chats and the pipeline on small tables, against plain versions."""

import json
import os
import random
import subprocess
import sys
import time

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
import public_tokenizers
from shopfloor.llm import chat, html, langid, neardup, quality, vectors
from shopfloor.operators.joins import JoinLimits
from shopfloor.storage import shared_folder


def plain_classes(texts, percent=75):
    sets = []
    for text in texts:
        words = (text or "").encode().translate(neardup._LOWER).split()
        if not words:
            sets.append(set())
        elif len(words) < 5:
            sets.append({tuple(words)})
        else:
            sets.append({tuple(words[i : i + 5]) for i in range(len(words) - 4)})
    label = list(range(len(texts)))
    changed = True
    while changed:
        changed = False
        for i in range(len(texts)):
            for j in range(i):
                common = len(sets[i] & sets[j])
                if sets[i] and sets[j] and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common) and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    return sets, label


def edited(text, rng, share):
    words = text.split()
    for _ in range(int(len(words) * share)):
        words[rng.randrange(len(words))] = f"w{rng.randrange(999)}"
    return " ".join(words)


def docs_of(spark, texts):
    rows = [(i, t, "n", True) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, n_shingles string, kept boolean")


def test_near_duplicates_against_all_pairs(spark):
    rng = random.Random(4)
    texts = []
    for _ in range(25):
        base = " ".join(f"w{rng.randrange(400)}" for _ in range(rng.choice([3, 8, 60, 200])))
        texts += [base, base.upper(), edited(base, rng, 0.02), edited(base, rng, 0.06), edited(base, rng, 0.3)]
    texts += [None, "", " \n\t", "one", "ONE", "a b c d", "long " * 20_000]
    sets, label = plain_classes(texts)
    rows = {r["doc_id"]: r for r in neardup.near_duplicates(docs_of(spark, texts).repartition(4)).collect()}
    assert [rows[i]["n_shingles"] for i in range(len(texts))] == [len(s) for s in sets]
    assert [rows[i]["component_id"] for i in range(len(texts))] == label
    assert all(rows[i]["kept"] == (label[i] == i) for i in range(len(texts)))
    assert len(set(label)) < len(label) - 50


def test_near_duplicates_in_large_groups(spark, monkeypatch):
    """Small limits, so that slices, splits and all rounds are used."""
    for name, value in {"SLICE": 4, "SPLIT_ABOVE": 3}.items():
        monkeypatch.setattr(neardup, name, value)
    rng = random.Random(6)
    base = " ".join(f"w{i}" for i in range(150))
    texts = [edited(base, rng, 0.012) for _ in range(90)] + ["same text of a group of copies"] * 40
    _, label = plain_classes(texts)
    rows = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs_of(spark, texts)).collect()}
    assert [rows[i] for i in range(len(texts))] == label


def bands_of(text):
    least = neardup.minima(neardup.shingles(text), neardup.BANDS * neardup.ROWS)
    return least.reshape(neardup.BANDS, neardup.ROWS)


def test_near_duplicates_that_share_one_large_bucket_only(spark, monkeypatch):
    """The pair's one band is a bucket of more than SPLIT_ABOVE unlike texts, and another text is its centre."""
    monkeypatch.setattr(neardup, "SPLIT_ABOVE", 4)
    rng = random.Random(3)
    while True:
        words = [f"w{rng.randrange(10**6)}" for _ in range(150)]
        changed = list(words)
        for at in rng.sample(range(5, 145), 4):
            changed[at] = f"v{rng.randrange(10**6)}"
        pair = " ".join(words), " ".join(changed)
        same = (bands_of(pair[0]) == bands_of(pair[1])).all(axis=1)
        if plain_classes(pair)[1] == [0, 0] and same.sum() == 1:
            break
    band, places = int(same.argmax()), []
    for wanted in bands_of(pair[0])[band]:
        pieces = (" ".join(words[i : i + 5]) for i in range(146))
        places.append(next(p for p in pieces if wanted in bands_of(p)[band]))
    others = []
    while len(others) < 8:
        filler = [f"u{rng.randrange(10**6)}" for _ in range(3)]
        text = " ".join(rng.sample(places, len(places)) + filler)
        if (bands_of(text)[band] == bands_of(pair[0])[band]).all():
            others += [text, text + " end"] if not others else [text]
    texts = [*others, *pair]
    _, label = plain_classes(texts)
    assert label[-2:] == [len(others)] * 2 and len(set(label)) == len(texts) - 2
    rows = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs_of(spark, texts)).collect()}
    assert [rows[i] for i in range(len(texts))] == label


def test_near_duplicates_of_few_and_repeated_rows(spark):
    assert neardup.near_duplicates(docs_of(spark, [])).count() == 0
    assert neardup.one_of_each(docs_of(spark, [])).count() == 0
    schema = "doc_id bigint, text string"
    odd = spark.createDataFrame([(None, "a b"), (None, "a b"), (7, "a b"), (7, "a b"), (9, "A b"), (3, None)], schema)
    rows = [tuple(r) for r in neardup.near_duplicates(odd).collect()]
    assert sorted(rows, key=str) == sorted(
        [(None, 1, None, True)] * 2 + [(7, 1, 7, True)] * 2 + [(9, 1, 7, False), (3, 0, 3, True)], key=str
    )
    kept = neardup.one_of_each(odd)
    assert sorted((r["doc_id"] or -1) for r in kept.collect()) == [-1, -1, 3, 7] and kept.columns == odd.columns


def test_rows_of_one_id_with_different_texts(spark):
    """Each text counts for itself; only rows equal in id and text, or in one component, are left out."""
    base = " ".join(f"w{i}" for i in range(80))
    rows = [
        (1, "a text of its own here", "x"), (1, "nothing in common with the other", "x"), (2, base, "x"), (2, base + " more", "x"),
        (3, base, "x"), (4, "", "x"), (4, None, "y"), (5, "a text of its own here", "x"), (6, "last one of all texts", "y"), (6, "last one of all texts", "z"),
        (None, base, "x"), (None, base, "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _slice string").repartition(3)
    found = sorted(((r["doc_id"] or -1, r["component_id"], r["kept"]) for r in neardup.near_duplicates(docs).collect()), key=str)
    wanted = [(1, 1, True), (1, 1, True), (2, 2, True), (2, 2, True), (3, 2, False), (4, 4, True), (4, 4, True), (5, 1, False), (6, 6, True), (6, 6, True)]
    assert found == sorted(wanted + [(-1, None, True)] * 2, key=str)
    kept = neardup.one_of_each(docs)
    left = [(r["doc_id"], r["text"] or "") for r in kept.collect()]
    assert kept.columns == docs.columns and len(left) == 7
    assert [t for i, t in left if i == 1] in (["a text of its own here", "nothing in common with the other"], ["nothing in common with the other", "a text of its own here"])
    assert sorted(i or -1 for i, _ in left) == [-1, -1, 1, 1, 2, 4, 6]


ALIKE = """
import random, sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "8")
    .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", "file://" + {events!r}).config("spark.eventLog.compress", "false")
    .config("spark.eventLog.rolling.enabled", "false").config("spark.checkpoint.dir", {shared!r}).getOrCreate())
from shopfloor.llm import neardup
rng = random.Random(5)
base = [f"word{{rng.randrange(10**6)}}" for _ in range(240)]
rows = []
for i in range(1600):
    words = list(base)
    for at in rng.sample(range(240), 12):
        words[at] = f"new{{rng.randrange(10**9)}}"
    rows.append((i, " ".join(words)))
spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet({docs!r})
spark.sparkContext.setJobGroup("measured", "near duplicates")
found = neardup.near_duplicates(spark.read.parquet({docs!r}))
found.write.parquet({out!r})
print(sum(len(t) for _, t in rows))
"""


def test_alike_texts_shuffle_little_more_than_they_are(spark, tmp_path):
    """1,600 texts a little below the threshold: no more than four times their bytes are shuffled, and no link is lost."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = {name: str(tmp_path / name) for name in ("events", "shared", "docs", "out")}
    os.mkdir(paths["events"])
    done = subprocess.run([sys.executable, "-c", ALIKE.format(root=root, **paths)], capture_output=True, text=True, env={**os.environ, "PYTHONPATH": root}, check=True)
    size = int(done.stdout.split()[-1])
    shuffled = 0
    for name in os.listdir(paths["events"]):
        for line in open(os.path.join(paths["events"], name)):
            event = json.loads(line)
            if event["Event"] == "SparkListenerTaskEnd":
                shuffled += (event.get("Task Metrics") or {}).get("Shuffle Write Metrics", {}).get("Shuffle Bytes Written", 0)
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(paths["docs"]).collect()}
    found = {r["doc_id"]: r["component_id"] for r in spark.read.parquet(paths["out"]).collect()}
    assert [found[i] for i in range(len(texts))] == plain_labels([texts[i] for i in range(len(texts))])
    assert shuffled <= 4 * size, (shuffled, size)


def plain_labels(texts, percent=75):
    """Classes by comparing all pairs, as a matrix of common shingles."""
    sets = [neardup.shingles(t) for t in texts]
    names = {x: i for i, x in enumerate(sorted({int(x) for s in sets for x in s}))}
    table = np.zeros((len(texts), len(names)), np.float32)
    for i, s in enumerate(sets):
        table[i, [names[int(x)] for x in s]] = 1
    common, sizes = table @ table.T, table.sum(axis=1)
    linked = (100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)) & (sizes[:, None] > 0) & (sizes[None, :] > 0)
    label = np.arange(len(texts))
    while True:
        least = np.where(linked, label[None, :], len(texts)).min(axis=1)
        after = np.minimum(label, least)
        if (after == label).all():
            return label.tolist()
        label = after


def test_bits_estimate_similarity(spark):
    texts = [" ".join(f"w{i}" for i in range(300)), " ".join(f"w{i}" for i in range(40, 340))]
    rows = neardup.signatures(docs_of(spark, texts)).orderBy("doc_id").collect()
    hashes = neardup.BANDS * neardup.ROWS
    frame = spark.createDataFrame([(rows[0]["bits"], rows[1]["bits"])], "a array<bigint>, b array<bigint>")
    longs = range(len(rows[0]["bits"]))
    agree = frame.select(neardup._agreeing([F.col("a")[i] for i in longs], [F.col("b")[i] for i in longs], hashes)).first()[0]
    chance = 2.0**-neardup.BITS
    exact = len(set(neardup.shingles(texts[0])) & set(neardup.shingles(texts[1]))) / len(
        set(neardup.shingles(texts[0])) | set(neardup.shingles(texts[1]))
    )
    assert (agree / hashes - chance) / (1 - chance) == pytest.approx(exact, abs=0.2)


def test_parities_never_rule_out_linked_sets(spark):
    rng = random.Random(12)
    rows, linked = [], 0
    for share in [0.0, 0.01, 0.02, 0.03, 0.04, 0.06, 0.3] * 8:
        base = " ".join(f"w{rng.randrange(5000)}" for _ in range(rng.choice([6, 80, 400, 3000])))
        x, y = neardup.shingles(base), neardup.shingles(edited(base, rng, share))
        common = len(set(x) & set(y))
        near = 100 * common >= 75 * (len(x) + len(y) - common)
        linked += near
        rows.append((neardup.parity(x).tolist(), neardup.parity(y).tolist(), len(x) + len(y), near))
    frame = spark.createDataFrame(rows, "a array<bigint>, b array<bigint>, total int, near boolean")
    longs = range(neardup.PARITY_LONGS)
    may = neardup._may_link([F.col("a")[i] for i in longs], [F.col("b")[i] for i in longs], F.col("total"), 75)
    assert linked > 20 and frame.filter(F.col("near") & ~may).count() == 0
    assert frame.filter(~may).count() > 5


def test_connected_on_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 101)], "a bigint, b bigint")
    found = {r["member"]: r["label"] for r in neardup.connected(links.repartition(3)).collect()}
    assert found == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100}


def test_top_k_against_all_pairs(spark):
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 0.4) for _ in range(8)], "s") for i in range(400)]
    rows[5] = (5, rows[4][1], "s")
    rows += [(900, None, "s"), (901, [0.1, None] * 4, "s"), (902, [float("nan")] * 8, "s"), (903, [float("inf")] * 8, "s")]
    rows += [(1000, [0.5, 0.5], "s"), (1001, [0.25, -0.5], "s"), (None, [0.1] * 8, "s"), (6, rows[6][1], "s")]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, score string")
    whole = table.select("vec_id", vectors.whole_numbers(F.col("embedding")).alias("vector"), "score")
    every = vectors.usable_vectors(whole)
    data = {r["vec_id"]: r["vector"] for r in every.collect()}
    assert len(data) == 402
    for k, block in ((10, 64), (3, 4096)):
        found = vectors.top_k(every, every.filter("vec_id % 50 = 0"), k, pivots=6, vector_block=block, query_block=4).collect()
        for q in [i for i in data if i % 50 == 0]:
            scored = [(-sum(a * b for a, b in zip(data[q], v)), i) for i, v in data.items() if i != q and len(v) == len(data[q])]
            wanted = [(n + 1, i, -s) for n, (s, i) in enumerate(sorted(scored)[:k])]
            assert sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == q) == wanted
    assert vectors.top_k(every.limit(0), every.limit(0)).count() == 0
    assert vectors.top_k(every, every.limit(0)).count() == 0


def test_top_k_reads_few_blocks_of_clustered_vectors(spark, monkeypatch):
    monkeypatch.setattr(vectors, "RANGE_SLICE", 8)
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 400, (40, 16))
    points = np.floor(centres[rng.integers(0, 40, 4000)] + rng.normal(0, 20, (4000, 16))).astype(int)
    # A third are copies of one vector, whose ties go to the smaller ids.
    points[rng.random(4000) < 0.33] = points[0]
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    # Products that floating point can't hold.
    rows += [(5000 + i, [2**30 + i, -(2**30) - 7 * i, 3]) for i in range(50)]
    every = vectors.usable_vectors(spark.createDataFrame(rows, "vec_id bigint, vector array<bigint>"))
    asking = every.filter("vec_id % 100 = 0")
    found = vectors.top_k(every, asking, 10, vector_block=200, query_block=8).collect()
    got = {}
    for r in found:
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert len(got) == 41
    for q, best in got.items():
        own = dict(rows)[q]
        scored = sorted((-sum(a * b for a, b in zip(own, v)), i) for i, v in rows if i != q and len(v) == len(own))
        assert sorted(best) == [(n + 1, i, -s) for n, (s, i) in enumerate(scored[:10])]
    looked = vectors.matches(every, asking, 10, 64, 200, 8).filter("vec_id IS NULL").groupBy("query_id").agg(F.sum("scored").alias("n"))
    # Queries that are the copied vector tie with all copies; the others are answered from few candidates.
    shares = [r["n"] / 3999 for r in looked.collect() if r["query_id"] < 5000 and tuple(points[r["query_id"]]) != tuple(points[0])]
    assert len(shares) > 20 and np.mean(shares) < 0.3


def test_top_k_without_pivots_and_of_empty_vectors(spark, monkeypatch):
    # Only the most frequent length gets pivots.
    monkeypatch.setattr(vectors, "PIVOT_LENGTHS", 1)
    rows = [(i, [i % 5, i % 3, -i]) for i in range(1, 31)] + [(100 + i, [i, 1]) for i in range(6)] + [(200 + i, []) for i in range(4)] + [(300, [7])]
    every = vectors.usable_vectors(spark.createDataFrame(rows, "vec_id bigint, vector array<bigint>"))
    # A query that isn't among the vectors, in a cell of its own.
    asking = every.unionByName(vectors.usable_vectors(spark.createDataFrame([(900, [10**6, 0, 0])], "vec_id bigint, vector array<bigint>")))
    got = {}
    for r in vectors.top_k(every, asking, 4, pivots=5, vector_block=7, query_block=3).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    wanted = {}
    for q, own in rows + [(900, [10**6, 0, 0])]:
        scored = sorted((-sum(a * b for a, b in zip(own, v)), i) for i, v in rows if i != q and len(v) == len(own))
        if scored:
            wanted[q] = [(n + 1, i, -s) for n, (s, i) in enumerate(scored[:4])]
    assert {q: sorted(best) for q, best in got.items()} == wanted


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body><nav><ul><li>Home<li>About</ul></nav>
<div class="ad">Buy {n}</div><article><h1>Title {n}</h1><p>First &amp; <b>bold</b>
  text {n}<p>Second<br>line</p><script>var x="<p>no</p>"</script><!-- no --><aside>Aside</aside>
<div class="comments"><p>Nice!</p></div></article><form><input value="x">Search</form><footer>&copy; host</footer></body></html>"""


def test_main_text_of_articles(spark):
    rows = [(n, "http://a.example/x", PAGE.format(n=n), "t") for n in range(6)]
    rows += [(10, "http://b.example/", "<p>Only &lt;one&gt;&nbsp;block", "t"), (11, None, None, "t"), (12, "::", "", "t"), (13, "http://a.example/", "<article>cut <b>of", "t")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    found = {r["page_id"]: r["text"] for r in html.extract(pages).collect()}
    for n in range(6):
        assert found[n] == f"Title {n}\nFirst & bold text {n}\nSecond\nline"
    assert found[10] == "Only <one> block" and found[11] == "" and found[12] == "" and found[13] == "cut of"
    assert html.extract(pages.limit(0)).count() == 0
    assert html.extract(pages.unionByName(pages)).count() == 2 * len(rows)


def test_template_finds_the_slot_without_named_elements(spark):
    page = "<html><body><div id=q1>Menu one two three</div><div id=q2><p>Body text number {n} of page {n}, long enough.</p></div><div id=q3>Fixed end</div></body></html>"
    rows = [(n, "http://c.example/", page.format(n=n)) for n in range(8)]
    found = html.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert {r["text"] for r in found} == {f"Body text number {n} of page {n}, long enough." for n in range(8)}


def test_comments_in_articles_of_their_own_and_named_headers(spark):
    page = (
        "<body><div class='site-header'>Name {n}</div><article class='post'><header><h1>Head {n}</h1></header><p>Body {n}.</p></article>"
        "<article class='comment'><p>Nice {n}!</p></article><article class='reply-box'><p>Yes {n}</p></article></body>"
    )
    plain = "<body><div class='site-header'>Name {n}</div><div class='post-header'><h1>Head {n}</h1></div><p>Body {n}.</p></body>"
    rows = [(i, f"http://{'ab'[i % 2]}.example/{i}", [page, plain][i % 2].format(n=i)) for i in range(6)]
    rows.append((9, "http://single.example/", page.format(n=9)))
    found = html.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert {(r["page_id"], r["text"]) for r in found} == {(i, f"Head {i}\nBody {i}.") for i in [*range(6), 9]}


def test_equal_articles_under_different_menus_stay(spark):
    top = "<body><div id=m>Menu {n}</div>"
    wrapped = top + "<div class=w><article><div><h1>Head</h1><p>Copied text.</p></div></article></div><div id=e>End</div></body>"
    plain = top + "<div id=q><p>A copied text that is longer than the menu.</p></div><p>Page {n}</p></body>"
    rows = [(n, "http://w.example/", wrapped.format(n=n)) for n in range(4)]
    rows += [(n, "http://p.example/", plain.format(n=n)) for n in range(10, 14)]
    found = {r["page_id"]: r["text"] for r in html.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert all(found[n] == "Head\nCopied text." for n in range(4))
    assert all("A copied text that is longer than the menu." in found[n] for n in range(10, 14))


def test_small_slots_beside_a_large_one_stay_without_an_article(spark):
    long = " ".join(f"word{{n}}x{i}" for i in range(60))
    page = "<body><div id=h>Headline {n}</div><div id=b><p>" + long + "</p></div><div id=l>Last words {n}</div><div id=f>Fixed</div></body>"
    rows = [(n, "http://d.example/", page.format(n=n)) for n in range(6)]
    found = html.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert {r["text"] for r in found} == {f"Headline {n}\n{long.format(n=n)}\nLast words {n}" for n in range(6)}


def test_templates_joined_by_shuffle_give_the_same(spark, monkeypatch):
    rows = [(n, f"http://h{n % 3}.example/", PAGE.format(n=n)) for n in range(30)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    wanted = sorted(map(tuple, html.extract(pages).collect()))
    # One host is hot: its pages are dealt over slices.
    monkeypatch.setattr(html, "LIMITS", JoinLimits(broadcast_bytes=-1, slice_rows=4))
    assert sorted(map(tuple, html.extract(pages).collect())) == wanted


def plain_texts(pages):
    """Main texts of one host's pages: whole paths, whole occurrence vectors and texts, no hashes, recursion over the template."""
    parsed = []
    for page in pages:
        found, every = html.blocks(page)
        paths = {}
        for e in every:
            above = paths[id(e.parent)] if e.parent else ()
            paths[id(e)] = above + ((e.tag, e.path),) if e.parent else ()
        parsed.append((found, every, paths))
    seen = {}
    for n, (found, every, paths) in enumerate(parsed):
        for e in every:
            path = paths[id(e)]
            inside = sorted(t for b, t in found if not b.noise and paths[id(b)][: len(path)] == path)
            row = seen.setdefault(path, {"on": {}, "texts": {}, "noise": e.noise})
            row["on"][n] = row["on"].get(n, 0) + 1
            row["texts"][n] = inside
    alike = lambda path: all(t == next(iter(seen[path]["texts"].values())) for t in seen[path]["texts"].values())
    once = {p for p, row in seen.items() if len(row["on"]) >= 2 and set(row["on"].values()) == {1} and 2 * len(row["on"]) >= len(pages)}
    valid = {p for p in once if all(p[:i] in once for i in range(len(p)))}
    chars = lambda p: sum(len(t) for texts in seen[p]["texts"].values() for t in texts)
    weight = lambda p: chars(p) / len(seen[p]["on"])
    main, dropped = set(), set()

    def walk(slot):
        inner = [p for p in valid if len(p) == len(slot) + 1 and p[:-1] == slot and not seen[p]["noise"]]
        rest = (chars(slot) - sum(chars(p) for p in inner if seen[p]["on"] == seen[slot]["on"])) / len(seen[slot]["on"])
        for p in inner:
            rivals = [weight(o) for o in inner if seen[o]["on"] in (seen[p]["on"], seen[slot]["on"])]
            rivals += [rest] if rest else []
            if p[-1][0] in html.MAIN:
                main.add(p)
            elif alike(()) or not alike(p):
                walk(p)
            elif p[-1][0] in html.CONTAINERS and max(rivals) > weight(p):
                dropped.add(p)

    if () in valid:
        walk(())
    texts = []
    for found, _, paths in parsed:
        under = lambda e, some: any(paths[id(e)][: len(p)] == p for p in some)
        chosen = [b for b, _ in found if under(b, main)] or [b for b, _ in found if b.main] or [b for b, _ in found]
        ids = {id(b) for b in chosen}
        kept = [t for b, t in found if id(b) in ids and not b.noise and (b.main or not under(b, dropped))]
        texts.append("\n".join(kept))
    return texts


def random_host(rng):
    """Pages of one host, whose parts are fixed, copied now and then, or vary."""

    def part(depth):
        tag = rng.choice(["div", "div", "section", "p", "ul", "article" if rng.random() < 0.3 else "td"])
        kind, named = rng.choice(["fixed", "varies", "copied"]), rng.choice(["", "", " class=ad", " id=x%d" % rng.randint(0, 99)])
        often, words = rng.choice([1.0, 1.0, 0.7, 0.3]), rng.randint(1, 9)
        inner = [part(depth + 1) for _ in range(rng.randint(0, 3))] if depth < 3 else []
        seed = rng.random()

        def write(n):
            if random.Random(f"{seed}{n}").random() > often:
                return ""
            mark = {"fixed": 0, "varies": n, "copied": n // 3}[kind]
            text = " ".join(f"w{mark}x{i}" for i in range(words)) if not inner or words < 4 else ""
            return f"<{tag}{named}>{text}{''.join(w(n) for w in inner)}</{tag}>"

        return write

    parts = [part(0) for _ in range(rng.randint(1, 5))]
    return ["<html><body>" + "".join(w(n) for w in parts) + "</body></html>" for n in range(rng.randint(1, 8))]


def test_main_text_against_plain_templates(spark):
    rng = random.Random(31)
    hosts = [random_host(rng) for _ in range(150)]
    rows = [(h * 100 + n, f"http://h{h}.example/{n}", page) for h, pages in enumerate(hosts) for n, page in enumerate(pages)]
    found = {r["page_id"]: r["text"] for r in html.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    changed = 0
    for h, pages in enumerate(hosts):
        wanted = plain_texts(pages)
        assert [found[h * 100 + n] for n in range(len(pages))] == wanted
        changed += wanted != [html.main_text(page, [], []) for page in pages]
    # The template decides, not the names alone.
    assert changed > 20


def test_names_of_classes_do_not_matter_to_the_template(spark):
    page = (
        "<body><div class='{0}'><div>Home</div><div>About us</div></div><div class='{1}'><div class='{2}'><h2>Head {n}</h2><p>Words {n} of the text.</p>"
        "</div><div class='{3}'>All our letters</div></div><div class='{4}'>House and Sons</div></body>"
    )
    named = ["menu", "wrap", "content", "newsletter", "footer"]
    odd = ["k3x", "zq", "bbq", "u7", "pp"]
    rows = [(n, f"http://{'ab'[n % 2]}.example/", page.format(*[named, odd][n % 2], n=n // 2)) for n in range(12)]
    found = {r["page_id"]: r["text"] for r in html.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert found == {n: f"Head {n // 2}\nWords {n // 2} of the text." for n in range(12)}
    assert html.main_text(rows[1][2], [], []) != found[1]


def test_slots_do_not_depend_on_the_number_of_pages(spark):
    page = "<body><div id=a>Always the same</div><div id=b>The text of page {n} is longer than that.</div></body>"
    rows = [(size * 100 + n, f"http://h{size}.example/", page.format(n=n)) for size in (2, 3, 40) for n in range(size)]
    found = html.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert all(r["text"] == f"The text of page {r['page_id'] % 100} is longer than that." for r in found)


def test_deep_and_odd_pages_take_linear_time():
    for page in ("<div>x" * 20_000, "<div>" * 20_000 + "</p></span></b></td>" * 20_000 + "x", "<a title=\">" * 20_000, "<p" * 50_000):
        started = time.process_time()
        html.tokens_of(page)
        html.main_text(page, [1], [2])
        assert time.process_time() - started < 5


def test_fold_applies_edits_and_regenerations(spark):
    events = [
        (1, 1, 1, "message", "user", "hi"), (1, 2, 2, "message", "assistant", ""), (1, 3, 2, "delta", None, "he"),
        (1, 4, 2, "delta", None, "llo"), (1, 5, 3, "message", "user", "no"), (1, 6, 2, "regenerate", None, None),
        (1, 7, 2, "delta", None, "bye"), (1, 8, 1, "edit", None, "hey"), (2, 1, 1, "delta", None, None), (None, 1, 1, "message", "user", "x"),
    ]
    frame = spark.createDataFrame(events, "conv_id bigint, seq bigint, message bigint, kind string, role string, text string")
    found = sorted((r["conv_id"] or -1, r["message"], r["role"], r["text"]) for r in chat.fold(frame).collect())
    assert found == [(-1, 1, "user", "x"), (1, 1, "user", "hey"), (1, 2, "assistant", "bye"), (2, 1, "", "")]
    assert chat.render(chat.fold(frame.limit(0))).count() == 0


def test_formatted_chats_read_back(spark):
    rng = random.Random(9)
    pieces = ["<|", "|>", "\\", "<\\|", "im_end", "<|im_end|>", "<|im_start|>", "\n", "assistant", " ok", "é😀", ""]
    make = lambda n=6: "".join(rng.choice(pieces) for _ in range(rng.randint(0, n)))
    rows = [(c, t, rng.choice(["user", "assistant", make(3)]), make()) for c in range(40) for t in range(rng.randint(1, 6))]
    rows += [(99, 0, None, None), (98, 0, "assistant", "z" * 100_000), (98, 0, "assistant", "z" * 100_000), (None, 1, "user", "q")]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    out = chat.read_back(chat.render(chat.fold(chat.as_events(frame))))
    out = out.withColumn("learned", chat.learned_text(F.col("turns"), F.col("loss_turns")))
    found = {r["conv_id"]: r for r in out.collect()}
    for conv in {r[0] for r in rows}:
        own = sorted([r for r in rows if r[0] == conv], key=lambda r: (r[1], (r[2] or "").encode(), (r[3] or "").encode()))
        wanted = [(r[2] or "", r[3] or "") for r in own]
        r = found[conv]
        assert [(t["role"], t["text"]) for t in r["turns"]] == wanted and r["n_turns"] == len(own)
        assert r["learned"] == "".join(t for role, t in wanted if role == "assistant")
        spans = [r["formatted"][s["start"] : s["start"] + s["length"]] for s in r["loss_spans"]]
        back = "".join(s.replace("<\\|", "<|").replace("\\\\", "\\") for s in spans)
        assert back == r["learned"]
        assert r["formatted"].count("<|im_start|>") == len(own)



def test_pipeline_keeps_columns_and_clean_documents(spark, tmp_path):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    clean = [" ".join(word() for _ in range(80)) + "." for _ in range(60)]
    junk = [" ".join(word() + "###" for _ in range(80)) for _ in range(40)]
    rows = [(i, t, "en", "s", len(t), "extra") for i, t in enumerate(clean + junk)]
    rows += [(200, clean[0], "en", "s", 1, "extra"), (201, clean[0] + " more", "en", "s", 1, "extra"), (202, "12 34 56", "en", "s", 8, "x"), (203, None, None, None, None, None)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    labels = spark.createDataFrame([(i, int(i < 60), 0) for i in range(100)], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == schema.replace(",", "").split()[::2], name
    assert {r["doc_id"] for r in docs.collect()} == set(range(60))
    shared = shared_folder(spark).removeprefix("file:")
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert not [name for name in os.listdir(shared) if name.startswith("pipeline-")]
    assert {r["doc_id"] for r in pieces} == set(range(60))
    assert sum(r["length"] for r in pieces) == sum({r["doc_id"]: r["doc_tokens"] for r in pieces}.values())


def plain_pipeline(spark, folder):
    """What the stages keep, by plain versions of what they decide: scores of the learned models, all pairs, ids end to end."""
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    rows = [r.asDict() for r in docs.collect()]
    model = quality.learn(docs, labels)
    rows = [r for r, score in zip(rows, model.scores([r["text"] or "" for r in rows])) if score >= quality.THRESHOLD]
    left = spark.createDataFrame([tuple(r.values()) for r in rows], docs.schema)
    languages = langid.learn(left)
    named = [languages.languages(r["text"] or "", langid.PENALTY, langid.ROUNDS) for r in rows]
    rows = [r for r, (name, score, _) in zip(rows, named) if name != "und" and score >= 0.35]
    rows.sort(key=lambda r: (r["doc_id"], r["text"] or ""))
    label = plain_labels([r["text"] or "" for r in rows])
    rows = [r for i, r in enumerate(rows) if label[i] == i]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return {r["doc_id"]: [*library.encode(r["text"] or "", add_special_tokens=False).ids, 2] for r in rows}


def test_pipeline_against_plain_stages(spark):
    folder = "/root/testdata/sf0.001"
    wanted = plain_pipeline(spark, folder)
    found = {i: [None] * len(ids) for i, ids in wanted.items()}
    places = set()
    for r in corpus_pipeline.run(spark, folder).collect():
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        found[r["doc_id"]][r["start"] : r["start"] + r["length"]] = ids
        places |= {(r["sequence_id"], r["offset"] + k) for k in range(len(ids))}
    assert found == wanted
    assert places == {divmod(i, 4096) for i in range(sum(map(len, wanted.values())))}


def test_pipeline_of_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_registered_queries():
    import __spark_entry__

    names = list(__spark_entry__.queries())
    for n in range(1, 14):
        assert any(name.startswith(f"op{n}_") for name in names)
    assert "pipeline" in names and [name for name, _ in corpus_pipeline.STAGES] == ["quality_filter", "language_filter", "near_dedup", "packing"]
