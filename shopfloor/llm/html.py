"""Main text of web pages by template deduction over the pages of a host.

A page's tokens are its elements, named by their path of tags, classes and ids; an element stands for
its opening and its closing tag, so it always encloses a slot. For every host and token the occurrence
vector, how often it occurs on which page, is summed up as hashes; tokens with equal vectors are an
equivalence class. Tokens that occur once a page on at least half of the host's pages are valid if
their parent is valid too: so classes nest into the template, a class inside a slot of the class of
its parent.

The template decides which slots are main. Below the outermost slot, a slot whose text is the same on
all its pages, while the host's pages differ, gives way if its pages hold a heavier slot beside it:
one of its own class or of its parent's, which occur on all of these pages. The heaviest slot stays
whether it varies or not, so pages that are copies keep their text. Slots that vary stay, and are
searched in the same way. Articles found on this way are the main slots. Names of tags, classes and
ids only tell what variation can't: articles, and menus, adverts, readers' comments and the like,
which may differ from page to page.

Vectors are combined on the map side, so a host of any size reaches a task as one row per token.
Work is linear in the length of a page, however deep its elements are nested.
"""

import html
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopfloor.llm.common import checkpointed, small_batches, texts_of
from shopfloor.operators.joins import JoinLimits, Measured, attach

# Slots are sent to all tasks within these limits; beyond them they are joined by shuffle, large hosts in slices.
LIMITS = JoinLimits(broadcast_bytes=32 * 1024 * 1024, slice_rows=100_000)
ROOT = 0

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|template|noscript|iframe|svg|textarea|title)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)|<[!?][^>]*(?:>|\Z)|</[^>]*(?:>|\Z)",
    re.S | re.I,
)
_NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_DIGITS = re.compile(r"\d{2,}")
_NAME_PARTS = re.compile(r"[^a-z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rp rt s samp small span strike "
    "strong sub sup time tt u var wbr img".split()
)
CONTAINERS = frozenset("html body div section main article table tbody tr td center".split())
MAIN = frozenset(["article", "main"])
NOISE_TAGS = frozenset(
    "head nav aside footer form button select option fieldset dialog menu object embed audio video canvas map input label".split()
)
NOISE_NAMES = frozenset(
    "nav navbar navigation menu menubar sidebar aside footer ad ads advert adverts advertisement banner sponsor sponsored promo "
    "promotion cookie cookies consent notice popup modal overlay comment comments disqus reply replies related recommended share "
    "sharing social subscribe newsletter signup breadcrumb breadcrumbs pagination pager search login toolbar masthead widget "
    "copyright skip contentinfo complementary alert".split()
)
# What an article can be named when it is no main text itself, such as a reader's comment in an article of its own.
MINOR_ARTICLES = frozenset("comment comments reply replies ad ads advert advertisement promo sponsored related".split())
# A header named like this is the page's, unless its name also speaks of the article.
HEADERS = frozenset(["header", "topbar"])
OF_ARTICLE = frozenset("article post entry content story title".split())
# Elements that a new block inside the same parent ends.
CLOSES = {"li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}


class Element:
    __slots__ = ("parent", "path", "tag", "noise", "main", "chars", "digest", "inside", "outside")

    def __init__(self, parent: "Element | None", path: int, tag: str, noise: bool, main: bool):
        self.parent, self.path, self.tag, self.noise, self.main = parent, path, tag, noise, main
        self.chars = self.digest = 0
        self.inside = self.outside = False


def _element(parent: Element, tag: str, attributes: str) -> Element:
    names = []
    for _, a, b, c in _NAMED.findall(attributes):
        names += (a or b or c).lower().split()
    label = ".".join([tag, *sorted(_DIGITS.sub("0", n) for n in names)])
    parts = {p for n in names for p in _NAME_PARTS.split(n)}
    if tag == "article":
        named = bool(MINOR_ARTICLES.intersection(names)) or any(n.startswith(("comment-", "reply-")) for n in names)
    else:
        named = tag not in ("html", "body", "main") and bool(parts & NOISE_NAMES)
    header = not parent.main and (tag == "header" or tag == "div" and bool(parts & HEADERS) and not parts & OF_ARTICLE)
    noise = parent.noise or tag in NOISE_TAGS or named or header
    path = xxhash.xxh64_intdigest(label.encode("utf-8", "replace"), parent.path) >> 1
    return Element(parent, path, tag, noise, parent.main or (tag in MAIN and not noise))


def blocks(page: str) -> tuple[list[tuple[Element, str]], list[Element]]:
    """The page's text blocks in order, each with its innermost element, and all elements, parents first."""
    root = Element(None, ROOT, "", False, False)
    stack, found, every, waiting, at = [root], [], [root], [], 0
    # How many elements of a tag are open, so that a stray closing tag costs nothing.
    opened = Counter()

    def flush() -> None:
        text = " ".join(html.unescape("".join(waiting)).split()) if waiting else ""
        waiting.clear()
        if text:
            found.append((stack[-1], text))

    def close() -> str:
        tag = stack.pop().tag
        opened[tag] -= 1
        return tag

    for token in _TOKEN.finditer(page):
        if token.start() > at:
            waiting.append(page[at : token.start()])
        at = token.end()
        tag = (token.group(3) or "").lower()
        if not tag or tag in INLINE:
            continue
        flush()
        if token.group(2):
            # A closing tag ends what is open inside; one without an opening is ignored.
            while opened[tag] and close() != tag:
                pass
            continue
        if tag in VOID:
            continue
        # A new block ends an open paragraph; items, cells and rows end the ones before them.
        while stack[-1].tag == "p":
            close()
        ends = CLOSES.get(tag)
        if ends and stack[-1].tag in ends:
            close()
            if tag == "tr" and stack[-1].tag == "tr":
                close()
        stack.append(_element(stack[-1], tag, token.group(4) or ""))
        opened[tag] += 1
        every.append(stack[-1])
    if at < len(page):
        waiting.append(page[at:])
    flush()
    return found, every


def tokens_of(page: str) -> list[tuple[int, int, str, int, int, int, bool, int]]:
    """(path, parent's path, tag, occurrences, characters inside, digest of the text inside, noise, place) of every path.

    Characters and digest are of the text that no name marks as noise; the digest adds up the blocks' hashes.
    """
    found, every = blocks(page)
    for element, text in found:
        if not element.noise:
            element.chars += len(text)
            element.digest += xxhash.xxh64_intdigest(text.encode("utf-8", "replace")) >> 1
    for element in reversed(every[1:]):
        element.parent.chars += element.chars
        element.parent.digest += element.digest
    table: dict[int, list] = {}
    for place, e in enumerate(every):
        above = e.parent.path if e.parent else ROOT
        row = table.setdefault(e.path, [e.path, above, e.tag, 0, 0, 0, e.noise, place])
        row[3] += 1
        row[4] += e.chars
        row[5] = (row[5] + e.digest) % (1 << 62)
    return [tuple(row) for row in table.values()]


def _host(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def templates(pages: DataFrame) -> DataFrame:
    """(host, tokens): the tokens that can be in the template of each host of ``pages`` (page_id, host, html).

    ``tokens`` are structs of place, path, parent, tag, class, characters, pages, whether the text is
    the same on all pages while the host's pages differ, and noise. A host has at most twice as many as
    its mean page has paths. Hosts of one page have none.
    """
    kinds = {
        "host": pa.string(), "page_id": pa.int64(), "path": pa.int64(), "parent": pa.int64(), "tag": pa.string(),
        "times": pa.int64(), "chars": pa.int64(), "digest": pa.int64(), "noise": pa.bool_(), "place": pa.int64(),
    }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "html", 1_000_000):
            rows = []
            for page_id, host, page in zip(*(texts_of(batch, c) for c in ("page_id", "host", "html"))):
                rows += [(host, page_id, *token) for token in tokens_of(page)]
            columns = list(zip(*rows)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values())], list(kinds))

    schema = (
        "host string, page_id bigint, path bigint, parent bigint, tag string, times bigint, chars bigint, digest bigint, "
        "noise boolean, place bigint"
    )
    seen = pages.select("page_id", "host", "html").mapInArrow(run, schema)
    part = lambda salt: F.sum(F.pmod(F.xxhash64(F.lit(salt), "page_id", "times"), F.lit(1 << 31)))
    vectors = seen.groupBy("host", "path").agg(
        F.min("parent").alias("parent"),
        F.min("tag").alias("tag"),
        F.count(F.lit(1)).alias("pages"),
        F.sum("times").alias("times"),
        F.xxhash64(part(1), part(2)).alias("class"),
        F.sum("chars").alias("chars"),
        (F.min("digest") == F.max("digest")).alias("same"),
        F.max("noise").alias("noise"),
        F.min("place").alias("place"),
    )
    vectors = checkpointed(vectors.filter("times = pages AND pages >= 2"))
    totals = vectors.filter(F.col("path") == ROOT).select(
        "host", F.col("pages").alias("all_pages"), F.col("same").alias("all_same")
    )
    frequent = vectors.join(totals, "host").filter("pages * 2 >= all_pages")
    token = F.struct(
        "place",
        "path",
        "parent",
        "tag",
        "class",
        "chars",
        "pages",
        (F.col("same") & ~F.col("all_same")).alias("fixed"),
        "noise",
    )
    return frequent.groupBy("host").agg(F.array_sort(F.collect_list(token)).alias("tokens"))


def slots_of(tokens: list[dict]) -> tuple[list[int], list[int]]:
    """The paths of a template's main slots and of the slots that are no main text; ``tokens`` in order of their places."""
    inner, valid = defaultdict(list), {ROOT}
    for token in tokens:
        # A parent comes before its children. Without a valid parent a token doesn't nest.
        if token["path"] != ROOT and token["parent"] in valid:
            valid.add(token["path"])
            inner[token["parent"]].append(token)
    weight = lambda t: t["chars"] / t["pages"]
    main, dropped = [], []
    waiting = [t for t in tokens if t["path"] == ROOT]
    while waiting:
        slot = waiting.pop()
        slots = [t for t in inner[slot["path"]] if not t["noise"]]
        # What stands beside the slots in this one weighs too, on all its pages.
        heaviest = defaultdict(float)
        beside = slot["chars"] - sum(t["chars"] for t in slots if t["class"] == slot["class"])
        heaviest[slot["class"]] = beside / slot["pages"]
        for t in slots:
            heaviest[t["class"]] = max(heaviest[t["class"]], weight(t))
        for t in slots:
            if t["tag"] in MAIN:
                main.append(t["path"])
            elif not t["fixed"]:
                waiting.append(t)
            elif t["tag"] in CONTAINERS and max(heaviest[t["class"]], heaviest[slot["class"]]) > weight(t):
                dropped.append(t["path"])
    return main, dropped


def host_slots(pages: DataFrame) -> DataFrame:
    """(host, main, dropped): the paths of each host's main slots and of its slots that are no main text; not of hosts without any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.int64())
        for batch in batches:
            found = [slots_of(tokens) for tokens in texts_of(batch, "tokens")]
            columns = [batch.column(0), *(pa.array([f[i] for f in found], kind) for i in range(2))]
            yield pa.RecordBatch.from_arrays(columns, ["host", "main", "dropped"])

    found = templates(pages).mapInArrow(run, "host string, main array<bigint>, dropped array<bigint>")
    return found.filter("size(main) + size(dropped) > 0")


def main_text(page: str, main: list[int], dropped: list[int]) -> str:
    """The blocks of the main slots without those that are no main text.

    On a page without the template's main slots its own articles are taken, or else all that is no noise.
    """
    found, every = blocks(page)
    slots, out = set(main), set(dropped)
    for e in every[1:]:
        e.inside = e.parent.inside or e.path in slots
        e.outside = not e.main and (e.parent.outside or e.path in out)
    if not any(e.inside for e, _ in found):
        articles = any(e.main for e, _ in found)
        for e in every:
            e.inside = e.main or not articles
    return "\n".join(text for e, text in found if e.inside and not e.noise and not e.outside)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text) for every row of ``pages``.

    Blocks are joined by a line break, white space in a block is one blank, character references are
    decoded. A null or empty page, or one without main text, has the empty text. A null or odd url
    has the empty host, whose pages are treated like those of any host. Rows with equal ids are
    pages each for itself; they count alike in the occurrence vectors. Other columns are left out.
    """
    rows = pages.select(
        pages[id_col].cast("bigint").alias("page_id"),
        pages[url_col].alias("url"),
        _host(pages[url_col]).alias("host"),
        F.coalesce(pages[html_col], F.lit("")).alias("html"),
    )
    found = checkpointed(host_slots(rows))
    width = (8 * (F.size("main") + F.size("dropped")) + F.octet_length("host") + 48).cast("bigint")
    size = found.agg(F.count(F.lit(1)).alias("hosts"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()
    lookup = Measured(found, size["hosts"], size["bytes"])
    joined = attach(rows, lookup, ["host"], "left", limits=LIMITS, keys_from=rows.select("host"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "html"):
            columns = (texts_of(batch, c) for c in ("html", "main", "dropped"))
            texts = pa.array([main_text(page, main or [], out or []) for page, main, out in zip(*columns)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts], ["page_id", "url", "text"])

    schema = "page_id bigint, url string, text string"
    return joined.select("page_id", "url", "html", "main", "dropped").mapInArrow(run, schema)
