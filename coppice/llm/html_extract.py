"""Main text of web pages by the maximum-scoring subsequence of words and tags.

A page is read as a row of tokens. Each word scores 1; each tag scores below zero, with weights from labelled pages: the
log ratio of how often a tag stands inside and outside their main text. Tags that build an article's lists, tables,
headings and links cost by what they enclose: the full weight if that is nothing but links, as in menus, next to nothing
if it is text. One linear scan finds the contiguous region with the largest sum; its words are the text.

A page that labels its main text, by one ``article`` or ``main`` element, is scanned with that label: tags inside it cost
nothing and words outside of it count against a region, so the region has all of the labelled text, short ends included.

Containers of boilerplate score 0 with all that they hold, so that a form or an advert inside an article does not split
it; they end where HTML ends them, also without an end tag. Some announce themselves by tag, by a sure name (as of
comments or adverts) or by a class that labelled pages have outside their main text only. Names that may mean anything,
as search or notice, hide a block unless it reads as text inside the labelled one; a page that has nothing else has them.
"""

from __future__ import annotations

import html as _html
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import numbered, release, stored

#: HTML's void, raw-text and inline elements, the other elements that pages use, elements that a start tag ends, and what bounds that.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
OTHER = frozenset("address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav noscript object ol optgroup option p picture pre search section select summary svg table tbody td template tfoot th thead tr ul video audio".split())
_BLOCKS = "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul"
ENDS = {x: frozenset(["p"]) for x in _BLOCKS.split()} | {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "option": frozenset(["option"]), "optgroup": frozenset(["option", "optgroup"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]),
    "tr": frozenset(["tr"]), "tbody": frozenset(["thead", "tbody"]), "tfoot": frozenset(["thead", "tbody"]), "body": frozenset(["head"]),
}
BOUNDS = frozenset("button table td th caption object template html ul ol menu dl select".split())
CONTENT = frozenset(["article", "main"])
#: Containers of boilerplate, names that announce one, names that say nothing beside those, and names of a state.
BOILERPLATE_TAGS = frozenset("head nav footer aside form script style noscript iframe template svg select button menu dialog title textarea object search noembed noframes xmp".split())
BOILERPLATE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner banners sponsor sponsored promo promotion sidebar menu nav navbar navigation breadcrumb breadcrumbs footer cookie cookies consent notice notices popup modal overlay comment comments respond reply replies disqus share sharing social related recommended newsletter subscribe subscription widget masthead pager pagination toolbar topbar contentinfo complementary search dialog alert login signup header".split()
)

#: Those of them that articles use as names too; what such a block holds decides.
DOUBTFUL_WORDS = frozenset("complementary contentinfo dialog header masthead pager search toolbar topbar widget".split())
NEUTRAL_WORDS = frozenset("site page main top bottom left right global primary secondary list section area box wrapper wrap container block bar slot unit inner outer links item items row col column content fixed sticky mobile desktop".split())
ENDING_WORDS = frozenset("ad ads advert adverts advertisement sponsored sidebar comments breadcrumbs newsletter disqus pagination navigation".split())
STATE_WORDS = frozenset("has have no not with without is show hide js".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)


def announces(name: str) -> str | None:
    """Whether a whole class, id or role name is that of boilerplate: a known word, alone or with words that say nothing; or a name that ends in a sure one. "sure", "doubtful" or None."""
    parts = [x for x in re.split("[^a-z0-9]+", re.sub("([a-z])([A-Z])", r"\1 \2", name).lower()) if x and not x.isdigit()]
    if not parts or parts[0] in STATE_WORDS:
        return None
    if parts[-1] in ENDING_WORDS:
        return "sure"
    known = [x for x in parts if x in BOILERPLATE_WORDS]
    if not known or not all(x in BOILERPLATE_WORDS or x in NEUTRAL_WORDS for x in parts):
        return None
    return "doubtful" if all(x in DOUBTFUL_WORDS for x in known) else "sure"


def names_of(attributes: str) -> list[str]:
    """The names in class, id and role."""
    return [x for found in _NAMES.findall(attributes) for value in found for x in value.split()] if "=" in attributes else []


def tokens(page: str) -> list[tuple[str, str]]:
    """(tag, its attributes), ("/tag", "") and ("", text), in order. Comments and declarations are left out."""
    out: list[tuple[str, str]] = []
    at = 0
    while True:
        m = _TOKEN.search(page, at)
        text = page[at : m.start() if m else len(page)]
        if text:
            out.append(("", text))
        if not m:
            return out
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        if m[1] or m[4]:
            out.append(("/" + name, ""))
            continue
        out.append((name, m[3] or m[6] or ""))
        if name in RAW:  # no markup inside
            end = re.compile(f"</{name}(?=[\\s/>]|\\Z)", re.I).search(page, at)
            to = end.start() if end else len(page)
            if to > at:
                out.append(("", page[at:to]))
            at = to


def ends(row: list[tuple[str, str]]) -> tuple[list[int], list[bool], list[bool]]:
    """For each start tag where its element ends, whether by its own end tag, and whether it lies in an article or main element."""
    close, shut, within = [len(row)] * len(row), [False] * len(row), [False] * len(row)
    stack: list[int] = []
    open_: dict[str, int] = {}

    def cut(d: int, i: int) -> None:
        for k in stack[d:]:
            close[k] = i
            open_[row[k][0]] -= 1
        del stack[d:]

    for i, (tag, _) in enumerate(row):
        if not tag:
            continue
        if tag[0] == "/":
            name = tag[1:]
            if open_.get(name):
                d = next(d for d in range(len(stack) - 1, -1, -1) if row[stack[d]][0] == name)
                shut[stack[d]] = True
                cut(d, i)
            continue
        gone = ENDS.get(tag, ())
        if any(open_.get(x) for x in gone):
            for d in range(len(stack) - 1, -1, -1):
                name = row[stack[d]][0]
                if name in gone:
                    cut(d, i)
                    break
                if name in BOUNDS:
                    break
        within[i] = any(open_.get(x) for x in CONTENT)
        if tag not in VOID:
            stack.append(i)
            open_[tag] = open_.get(tag, 0) + 1
    return close, shut, within


@dataclass(frozen=True)
class Counts:
    """Running sums over a page's tokens: words, and words inside links."""

    words: list[int]
    linked: list[int]

    def share(self, a: int, b: int) -> float | None:
        """How many of the words in [a, b) are links'; None without words."""
        n = self.words[b] - self.words[a]
        return (self.linked[b] - self.linked[a]) / n if n else None

    def reads_as_text(self, a: int, b: int, least: int = 20, most: float = 0.3) -> bool:
        return self.words[b] - self.words[a] >= least and self.share(a, b) <= most


def counts_of(row: list[tuple[str, str]], close: list[int]) -> Counts:
    words, linked, until = [0], [0], 0
    for i, (tag, text) in enumerate(row):
        if tag == "a":
            until = max(until, close[i])
        n = 0 if tag else len(text.split())
        words.append(words[-1] + n)
        linked.append(linked[-1] + (n if i < until else 0))
    return Counts(words, linked)


def label_of(row: list[tuple[str, str]], close: list[int], hidden: list[bool]) -> tuple[int, int] | None:
    """Begin and end of the one element that is labelled as the main text: the only outermost ``article`` outside of boilerplate, else the only ``main``; None if there are several or none."""
    for name in ("article", "main"):
        own, end = [], 0
        for i, (tag, _) in enumerate(row):
            if tag == name and not hidden[i] and i >= end:
                own.append((i, close[i]))
                end = close[i]
        if len(own) == 1:
            return own[0]
    return None


def masked(row: list[tuple[str, str]], learned: frozenset[str] = frozenset(), doubtful: bool = True) -> list[bool]:
    """Which tokens belong to boilerplate containers, their own tags included.

    An unclosed container ends where an article or main element begins. A container that holds all such elements of
    the page is none. Containers with ``doubtful`` names count unless they read as text inside such an element.
    """
    close, shut, within = ends(row)
    counts = counts_of(row, close)
    content = [i for i, (tag, attributes) in enumerate(row) if tag in CONTENT and "sure" not in map(announces, names_of(attributes))]
    spans = []
    for i, (tag, attributes) in enumerate(row):
        if not tag or tag[0] == "/" or tag in VOID or tag in ("html", "body") or (tag in CONTENT and i in content):
            continue
        hides = tag in BOILERPLATE_TAGS or (tag == "header" and not within[i]) or tag in CONTENT
        if not hides and tag not in INLINE:
            for x in names_of(attributes):
                said = "sure" if x in learned else announces(x)
                hides |= said == "sure" or (said == "doubtful" and doubtful and not (within[i] and counts.reads_as_text(i, close[i])))
        if hides:
            to = close[i] + (shut[i] and close[i] < len(row))
            if not shut[i] and tag not in ("p", "li"):
                to = next((j for j in content if i < j < to), to)
            spans.append((i, to))
    if content:
        spans = [(a, b) for a, b in spans if not all(a < j < b for j in content)] if any(all(a < j < b for j in content) for a, b in spans) else spans
    out, at = [False] * len(row), 0
    for a, b in spans:
        a = max(a, at)
        if b > a:
            out[a:b] = [True] * (b - a)
            at = b
    return out


def kind(tag: str) -> str:
    name = tag.lstrip("/")
    return tag if name in OTHER or name in INLINE or name in VOID else "/other" if tag[0] == "/" else "other"


#: For tags that no labelled page has.
UNSEEN, UNSEEN_INLINE = -2.0, -0.1


@dataclass(frozen=True)
class Learned:
    """What labelled pages say: the score of each tag, and classes that stand outside main texts."""

    weight: dict[str, float] = field(default_factory=dict)
    classes: frozenset[str] = frozenset()


def learn(pages: DataFrame, html: str = "html", least: float = 0.01, share: float = 0.02) -> Learned:
    """From the labelled pages, those with one ``article`` or ``main`` element, which is their main text.

    The counts cover all rows. Tags are bounded by HTML's element names. Classes are kept that block elements outside
    main texts have, on the average at least ``least`` times a labelled page, and at most the ``share`` of that inside;
    so their number is bounded by how many classes a page has, whatever the number of pages. No labelled pages: nothing
    is learned.
    """
    names = ["sort", "name", "out", "within"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, str], list[int]] = {}

        def told() -> pa.RecordBatch:
            columns = [[k[0] for k in seen], [k[1] for k in seen], [v[0] for v in seen.values()], [v[1] for v in seen.values()]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64(), pa.int64()), strict=True)], names)

        for batch in batches:
            for page in batch.column("text").to_pylist():
                row = tokens(page)
                own = [i for i, (t, _) in enumerate(row) if t in CONTENT]
                if len(own) != 1:
                    continue
                first, close, hidden = own[0], ends(row)[0], masked(row)
                seen.setdefault(("page", ""), [0, 0])[1] += 1
                for i, (tag, attributes) in enumerate(row):
                    if not tag or i in (first, close[first]):
                        continue
                    inside = first < i < close[first] and not hidden[i]
                    seen.setdefault(("tag", kind(tag)), [0, 0])[inside] += 1
                    if "=" in attributes and tag not in INLINE and not (i < first < close[i]):
                        for x in set(names_of(attributes)):
                            seen.setdefault(("class", x), [0, 0])[first < i < close[first]] += 1
                if len(seen) > 100_000:
                    yield told()
                    seen.clear()
        yield told()

    rows = numbered(pages, html).select("text").mapInArrow(count, "sort string, name string, out long, within long").groupBy("sort", "name").agg(F.sum("out").alias("out"), F.sum("within").alias("within"))
    rows = stored(rows, "counts")  # three readers, one pass over the pages
    tags = rows.where("sort = 'tag'").collect()
    labelled = rows.where("sort = 'page'").agg(F.coalesce(F.sum("within"), F.lit(0))).first()[0]
    classes = rows.where((F.col("sort") == "class") & (F.col("out") >= least * labelled) & (F.col("within") <= share * F.col("out"))).collect()
    release(rows)
    out, within = sum(r["out"] for r in tags) + 1, sum(r["within"] for r in tags) + 1
    weight = {r["name"]: min(-0.1, math.log((r["within"] + 0.5) / within) - math.log((r["out"] + 0.5) / out)) for r in tags}
    return Learned(weight, frozenset(r["name"] for r in classes))


def best_region(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous region with the largest sum above zero, the first one found; (0, 0) if there is none."""
    total, best, start, found = 0.0, 0.0, 0, (0, 0)
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, found = total, (start, i + 1)
    return found


#: Elements of an article's body: what they hold says whether they are a menu's.
BODY = frozenset("a p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr td th blockquote pre figure figcaption".split())


def tag_scores(row: list[tuple[str, str]], close: list[int], counts: Counts, weight: dict[str, float]) -> list[float]:
    """The score of each tag: its learned weight, for ``BODY`` elements by how much of what they hold is links. A link goes by the block that it stands in."""
    out = [0.0] * len(row)
    blocks: list[tuple[int, int]] = []
    least = UNSEEN_INLINE

    def score(name: str, a: int, b: int, learned: float) -> float:
        share = counts.share(a, b)
        if name not in BODY or share is None:
            return learned
        if name == "li":  # an item of a word or two is a menu's
            share = max(share, 1 - 0.15 * max(0, counts.words[b] - counts.words[a] - 1))
        return least + (min(least, learned) - least) * min(1.0, max(0.0, (share - 0.7) / 0.3))

    for i, (tag, _) in enumerate(row):
        while blocks and blocks[-1][1] <= i:
            blocks.pop()
        if not tag or tag[0] == "/":
            continue
        inline = tag in INLINE
        own = lambda t, inline=inline: weight.get(kind(t), UNSEEN_INLINE if inline else UNSEEN)
        end = close[i] if tag not in VOID else i
        span = blocks[-1] if inline and blocks else (i, end)
        out[i] = score(tag, *span, own(tag))
        if i < end < len(row) and row[end][0] == f"/{tag}":
            out[end] = score(tag, *span, own(f"/{tag}"))
        if not inline and tag not in VOID:
            blocks.append((i, end))
    for i, (tag, _) in enumerate(row):  # end tags that end nothing
        if tag and tag[0] == "/" and not out[i]:
            out[i] = least
    return out


def region(row: list[tuple[str, str]], hidden: list[bool], learned: Learned, links: bool = False) -> str:
    """The words of the best region outside of ``hidden``; its blocks joined by one space. Words of blocks that are nothing but links score 0 outside of a label, unless ``links``."""
    close, _, _ = ends(row)
    label = label_of(row, close, hidden)
    if label and not any(not tag and not h and text.strip() for (tag, text), h in zip(row[slice(*label)], hidden[slice(*label)], strict=True)):
        label = None  # it holds nothing
    counts = counts_of(row, close)
    costs = tag_scores(row, close, counts, learned.weight)
    parts, scores, blocks = [], [], []
    for i, ((tag, text), skip) in enumerate(zip(row, hidden, strict=True)):
        inside = label is not None and label[0] <= i < label[1]
        while blocks and blocks[-1][1] <= i:
            blocks.pop()
        if tag:
            if tag[0] != "/" and tag not in INLINE and tag not in VOID:
                blocks.append((i, close[i]))
            scores.append(0.0 if skip or inside else costs[i])
            parts.append("" if tag.lstrip("/") in INLINE else " ")
        elif skip:
            scores.append(0.0)
            parts.append(" ")
        else:
            text = _html.unescape(text)
            n = float(len(text.split()))
            bare = label is None and not links and blocks and counts.linked[i + 1] > counts.linked[i] and counts.share(*blocks[-1]) > 0.9
            scores.append(0.0 if bare else -n if label is not None and not inside else n)
            parts.append(text)
    return " ".join("".join(parts[slice(*best_region(scores))]).split())


def main_text(page: str, learned: Learned) -> str:
    """The main text of a page. Where nothing is left without the blocks of doubtful names, these are looked at too, then lists of links."""
    row = tokens(page)
    hidden = masked(row, learned.classes)
    return region(row, hidden, learned) or region(row, masked(row, learned.classes, doubtful=False), learned) or region(row, hidden, learned, links=True)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per row of ``pages``: key, url, text, n_chars.

    A null or empty page, or one without words outside boilerplate, has the text "". Repeated rows and null keys stay;
    other columns are not read, whatever their names; an empty table gives no rows. Pages of any length are read whole.
    """
    spark = pages.sparkSession
    shipped = spark.sparkContext.broadcast(learn(pages, html))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p, shipped.value) for p in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [key, url, "text", "n_chars"])

    kind_of = pages.schema[key].dataType.simpleString()
    rows = numbered(pages, html).select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"), "text")
    return rows.mapInArrow(run, f"`{key}` {kind_of}, `{url}` string, text string, n_chars long")
