"""Main text of web pages by a linear-chain conditional random field over the leaf blocks of the DOM.

A page is read into leaf blocks: runs of text between tags that begin or end a block, each with its ancestors. Features of a block are
its ancestors' tags, roles and words of their classes and ids, and its text's length, links and punctuation. The field gives each
block one of two labels, article or other, by these features and the label before it; Viterbi finds the best labels of a page.

It is trained on labelled pages: at most ``SAMPLE`` pages of the table, those with the least hashes, whose blocks are
labelled by an article or main element without furniture inside; each is also dealt into another layout of ``LAYOUTS``, with the
labels known, so that pages with other markup are seen too. Every page is then read and decoded whole where it is stored; only the
weights, of fixed size, go to the tasks.

Defined cases: null or empty html, and a page without article blocks, have an empty text. Broken markup is read as far as it goes:
tags that are not closed end with their parent, an unfinished tag or comment ends with the page. Repeated rows have equal results, an
empty table gives an empty one. Columns other than ``id`` and ``html`` are ignored by the operator.
"""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urlaudit.llm.common import table

SAMPLE = 400  # pages to learn from
LONGEST = 200_000  # characters of a page to learn from
FEATURES = 1 << 15
ROUNDS = 80

#: Fixed values of HTML: elements without content, elements inside a line, elements whose content is not text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
UNSEEN = frozenset("script style noscript template svg math iframe object canvas audio video select textarea button".split())
#: Elements that end when another of the list begins beside them.
ENDS = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Words of tags, classes, ids and roles of what is beside an article.
FURNITURE = frozenset(
    "nav navigation menu menubar header banner masthead footer contentinfo aside sidebar complementary notice cookie consent alert ad ads adbox advert advertisement "
    "sponsor sponsored promo form search subscribe newsletter login comment comments disqus reply replies share social related breadcrumb breadcrumbs pagination popup modal".split()
)
ARTICLE = frozenset("article main".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+>|[^>]*(?:>|\Z))|<[!?][^>]*(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@dataclass
class Block:
    path: tuple[str, ...]  # of the elements around it, each a tag and the words of its attributes
    text: str
    linked: int  # characters in links


@lru_cache(100_000)
def element(tag: str, attributes: str) -> str:
    """A tag and its marks, as one string."""
    words = []
    for name, *values in _ATTRIBUTE.findall(attributes):
        value = "".join(values)
        if name.lower() in ("hidden", "aria-hidden") and value.lower() != "false" or name.lower() == "style" and re.search(r"display\s*:\s*none", value):
            words.append("hidden")
        elif name.lower() in ("class", "id", "role"):
            words += [word.lower() for word in _WORD.findall(value)]
    return " ".join([tag, *dict.fromkeys(words)])


def leaf_blocks(html: str | None) -> list[Block]:
    """The leaf blocks of a page in order; text is decoded, and its white space turned into single spaces.

    Each open element knows the path down to it, so a block's path costs nothing more, and each tag is looked at once when it is closed: the
    work grows with the page, however deep its elements are nested. An element that is on the path already, before the article or inside
    it, is not named twice there."""
    html = html or ""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...], str]] = []  # tag, path without repetition, the element of the block
    open_tags: Counter = Counter()
    unseen: set[str] = set()
    held: list[str] = []
    started, links, path = False, 0, ()

    def add(raw: str) -> None:
        nonlocal started, links, path
        if not raw or unseen:
            return
        if raw.isspace():
            held.append(" ")
            return
        if not started and stack:
            _, names, leaf = stack[-1]
            path = names if not leaf or names[-1] == leaf else (*names, leaf)
        elif not started:
            path = ()
        started = True
        held.append(raw)
        if open_tags["a"]:
            links += len(raw)

    def flush() -> None:
        nonlocal started, links
        if held:
            text = " ".join(unescape("".join(held)).split())
            if text:
                out.append(Block(path, text, links))
            held.clear()
            started, links = False, 0

    def close(depth: int) -> None:
        for tag, *_ in stack[depth:]:
            open_tags[tag] -= 1
            if tag in UNSEEN and not open_tags[tag]:
                unseen.discard(tag)
        del stack[depth:]

    at = 0
    while match := _TAG.search(html, at):
        add(html[at : match.start()])
        at = match.end()
        if match[2] is None:
            continue
        tag = match[2].lower()
        if tag == "br":
            held.append(" ")
            continue
        block = tag not in INLINE
        if block:
            flush()
        if match[1]:
            if open_tags[tag]:
                depth = len(stack) - 1
                while stack[depth][0] != tag and (block or stack[depth][0] in INLINE):
                    depth -= 1
                if stack[depth][0] == tag:
                    close(depth)
            continue
        if tag in ("script", "style"):  # their content has no tags
            end = re.compile(rf"</{tag}", re.I).search(html, at)
            at = end.start() if end else len(html)
            if not end:
                break
        if block and stack:
            ended = ENDS.get(tag, set()) | {"p"}
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in ended:
                    close(k)
                    break
                if stack[k][0] not in INLINE:
                    break
        if tag not in VOID and not match[3].endswith("/>"):
            names, leaf = stack[-1][1:] if stack else ((), "")
            if block:
                leaf = element(tag, match[3])
                names = _named(names, leaf)
            stack.append((tag, names, leaf))
            open_tags[tag] += 1
            if tag in UNSEEN:
                unseen.add(tag)
    else:
        add(html[at:])
    flush()
    return out


def is_article(e: str) -> bool:
    tag, *words = e.split()
    return tag in ARTICLE or "main" in words


def _named(names: tuple[str, ...], leaf: str) -> tuple[str, ...]:
    """A path and an element below it. What stands before the first article element and what stands from it on are kept apart."""
    if leaf not in names:
        return (*names, leaf)
    inside = next((k for k, e in enumerate(names) if is_article(e)), None)
    return names if inside is None or leaf in names[inside:] else (*names, leaf)


@lru_cache(200_000)
def _number(feature: str) -> int:
    return zlib.crc32(feature.encode()) % FEATURES


@lru_cache(50_000)
def path_features(path: tuple[str, ...]) -> tuple[int, ...]:
    names = {"always"}
    for e in path:
        tag, *words = e.split()
        names.add(f"in {tag}")
        names.update(f"word {word}" for word in words)
        if not FURNITURE.isdisjoint((tag, *words)):
            names.add("furniture")
    if path:
        names.add(f"leaf {path[-1].split()[0]}")
    tags = {e.split()[0] for e in path}
    if not tags & ARTICLE:
        names.add("no article")
    elif "furniture" in names:
        names.add("furniture in article")
    return tuple(sorted(_number(name) for name in names))


def text_features(block: Block) -> tuple[int, ...]:
    words = block.text.count(" ") + 1
    share = block.linked / max(1, len(block.text))
    names = [f"words {min(words.bit_length(), 8)}", f"links {min(4, int(4 * share))}", f"stops {min(4, block.text.count('. ') + block.text.count(', '))}"]
    if block.text[-1] in ".!?:;\"'»”":
        names.append("ends as a sentence")
    if "©" in block.text:
        names.append("copyright")
    return tuple(_number(name) for name in names)


@dataclass
class Field:
    weights: np.ndarray  # of each feature for the label 1, against 0
    turns: np.ndarray  # of each label after each label
    first: np.ndarray

    def labels(self, blocks: list[Block]) -> list[bool]:
        """Viterbi: the best labels of a page's blocks, True for article. A tie goes to other."""
        if not blocks:
            return []
        w, ((t00, t01), (t10, t11)) = self.weights, self.turns.tolist()
        known = self._known
        back = []
        a = b = 0.0
        for k, block in enumerate(blocks):
            score = known.get(block.path)
            if score is None:
                score = known[block.path] = float(w[list(path_features(block.path))].sum())
            for feature in text_features(block):
                score += self._list[feature]
            if k:
                from_a, from_b = a + t01 > b + t11, b + t10 > a + t00
                back.append((from_b, not from_a))
                a, b = (b + t10 if from_b else a + t00), (a + t01 if from_a else b + t11) + score
            else:
                a, b = float(self.first[0]), float(self.first[1]) + score
        label = b > a
        out = [label]
        for came in reversed(back):
            label = came[label]
            out.append(label)
        return out[::-1]

    def __post_init__(self):
        self._known: dict[tuple, float] = {}
        self._list = self.weights.tolist()


def fit(pages: list[tuple[list[Block], list[bool]]]) -> Field:
    """The field that makes the labels of the pages most likely, by gradient ascent with forward-backward sums."""
    pages = [page for page in pages if page[0]]
    weights, turns, first = np.zeros(FEATURES), np.zeros((2, 2)), np.zeros(2)
    if not pages:
        return Field(weights, turns, first)
    features = [[*path_features(b.path), *text_features(b)] for blocks, _ in pages for b in blocks]
    flat, cuts = np.concatenate([np.array(f) for f in features]), np.concatenate([[0], np.cumsum([len(f) for f in features])])
    sizes = np.array([len(blocks) for blocks, _ in pages])
    longest, starts = sizes.max(), np.concatenate([[0], np.cumsum(sizes)[:-1]])
    place = np.minimum(starts[:, None] + np.arange(longest), len(features) - 1)
    mask = np.arange(longest)[None, :] < sizes[:, None]
    truth = np.array([label for _, labels in pages for label in labels], int)
    gold = np.where(mask, truth[place], 0)
    grown = [np.full(FEATURES, 1e-3), np.full((2, 2), 1e-3), np.full(2, 1e-3)]
    for _ in range(ROUNDS):
        own = np.add.reduceat(weights[flat], cuts[:-1])
        emit = np.zeros((len(pages), longest, 2))
        emit[:, :, 1] = own[place]
        forward, backward = np.zeros_like(emit), np.zeros_like(emit)
        forward[:, 0] = first + emit[:, 0]
        for t in range(1, longest):
            step = np.logaddexp.reduce(forward[:, t - 1, :, None] + turns, axis=1) + emit[:, t]
            forward[:, t] = np.where(mask[:, t, None], step, forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            step = np.logaddexp.reduce(turns[None] + (emit[:, t + 1] + backward[:, t + 1])[:, None, :], axis=2)
            backward[:, t] = np.where(mask[:, t + 1, None], step, backward[:, t + 1])
        whole = np.logaddexp.reduce(forward[:, -1], axis=1)
        share = np.exp(forward + backward - whole[:, None, None])
        gap = np.where(mask, gold - share[:, :, 1], 0.0)
        of_block = np.zeros(len(features))
        of_block[place[mask]] = gap[mask]
        slope = [np.bincount(flat, np.repeat(of_block, np.diff(cuts)), FEATURES) - 0.01 * weights, -0.01 * turns, np.zeros(2)]
        both = mask[:, 1:]
        pair = np.exp(forward[:, :-1, :, None] + turns + (emit + backward)[:, 1:, None, :] - whole[:, None, None, None]) * both[:, :, None, None]
        for i in range(2):
            slope[2][i] += ((gold[:, 0] == i) - share[:, 0, i]).sum()
            for j in range(2):
                slope[1][i, j] += (both & (gold[:, :-1] == i) & (gold[:, 1:] == j)).sum() - pair[:, :, i, j].sum()
        for value, s, g in zip((weights, turns, first), slope, grown, strict=True):
            g += s * s
            value += 0.5 * s / np.sqrt(g)
    return Field(weights, turns, first)


def labelled(blocks: list[Block]) -> list[bool] | None:
    """Labels by markup: blocks in an article or main element that are in no furniture inside it. None if a page has neither."""
    out, any_article = [], False
    for block in blocks:
        at = next((k for k, e in enumerate(block.path) if is_article(e)), None)
        any_article |= at is not None
        out.append(at is not None and not any(not FURNITURE.isdisjoint(e.split()) for e in block.path[at:]))
    return out if any_article else None


FEW = 56  # labelled pages to learn from, at least
LONG_BLOCK = 12  # words of a block that is taken for an article's where no markup says so
#: Text for the layouts of a table without any.
PLAIN = [
    "The river rose in the night, and by the morning the lower fields were under water as far as the mill.",
    "Nobody had seen the like of it for thirty years. People carried what they could to the church on the hill, and waited there.",
    "In the afternoon the rain stopped; a wind came up from the west, and the first roofs of the village could be seen again.",
]
#: Layouts to deal labelled blocks into: what stands around an article, the article's own elements, what stands inside it.
LAYOUTS = [
    ("header nav footer", "main", "aside"),
    ("header.site-header div.menu footer", "div#content", "div.share"),
    ("div.cookie-notice nav aside.sidebar footer", "article", "section.comments"),
    ("div#header ul.nav div#sidebar div#footer", "div.post", "div#comments"),
    ("header div.banner form.search footer", "main article", "div.advert"),
    ("div.topbar nav div.newsletter footer", "section.article-body", "form"),
    ("nav div.ads div.related footer", "div.entry-content", "div.comment-list"),
    ("div.alert header footer", "article div.body", "div.ad"),
    ("", "body", ""),
    ("", "article", ""),
    ("", "main", "form"),
    ("nav footer", "td", "aside.related"),
    ("div.popup div.consent header footer", "article section", "div.notice"),
    ("div.promo nav div.breadcrumbs footer", "div[main]", "ul.comments"),
]


def dealt(article: list[str], other: list[str], layout: tuple[str, str, str], pick: random.Random) -> tuple[list[Block], list[bool]]:
    """A page with the given texts in a layout, and its labels."""
    wrapped = pick.random() < 0.8

    def path(spec: str, leaf: str) -> tuple[str, ...]:
        elements = ["html", "body"] if wrapped else ["body"] if spec == "body" else []
        for part in spec.split():
            tag, mark, name = re.fullmatch(r"(\w+)([.#\[]?)([\w-]*)\]?", part).groups()
            elements.append(element(tag, f' {"role" if mark == "[" else "class" if mark == "." else "id"}="{name}"' if mark else ""))
        return tuple(e for e in [*elements, leaf] if e != "body" or spec != "body") if leaf else tuple(elements)

    around, own, inside = layout
    page: list[tuple[Block, bool]] = []
    short = lambda: " ".join(pick.choice(other).split()[: pick.randint(1, 12)]) if other else "menu"
    places = around.split()
    for k, spec in enumerate(places):
        if spec == "footer" or "footer" in spec:
            continue
        for _ in range(pick.randint(1, 5)):
            text = short()
            page.append((Block(path(spec, "li" if "nav" in spec or "menu" in spec else pick.choice(["p", ""])), text, len(text) if "nav" in spec or "menu" in spec else 0), False))
    if pick.random() < 0.2:
        article = article[: pick.randint(1, 2)]
    for k, text in enumerate(article):
        if pick.random() < 0.15:
            text = " ".join(text.split()[: pick.randint(1, 6)])
        page.append((Block(path(own, "h1" if k == 0 else "p"), text, 0), True))
        if inside and pick.random() < 0.08:
            page.append((Block(path(f"{own} {inside}", pick.choice(["p", ""])), short(), 0), False))
    if inside:
        for _ in range(pick.randint(1, 4)):
            text = pick.choice(article) if pick.random() < 0.5 else short()
            page.append((Block(path(f"{own} {inside}", "p"), text, 0), False))
    for spec in places:
        if "footer" in spec:
            page.append((Block(path(spec, pick.choice(["p", ""])), "© " + short(), 0), False))
    return [b for b, _ in page], [label for _, label in page]


def training_pages(htmls: list[str]) -> list[tuple[list[Block], list[bool]]]:
    """Labelled pages to learn from, never none.

    A page with an article or main element is taken as it is, and dealt into another layout. Where such pages are too few, the other pages
    give texts for all layouts, their blocks of many words as articles; and where there is no text, plain words do."""
    pick, out = random.Random(30_011), []
    unmarked: list[list[Block]] = []
    for k, html in enumerate(htmls):
        blocks = leaf_blocks(html)
        labels = labelled(blocks)
        if labels is None:
            unmarked.append(blocks)
            continue
        out.append((blocks, labels))
        article, other = [b.text for b, own in zip(blocks, labels, strict=True) if own], [b.text for b, own in zip(blocks, labels, strict=True) if not own]
        if article:
            out.append(dealt(article, other, LAYOUTS[k % len(LAYOUTS)], pick))
    if len(out) < FEW:
        texts = [([b.text for b in blocks if b.text.count(" ") >= LONG_BLOCK], [b.text for b in blocks if b.text.count(" ") < LONG_BLOCK]) for blocks in unmarked]
        texts = [(article, other) for article, other in texts if article] or [(PLAIN, [])]
        for k in range(FEW - len(out)):
            article, other = texts[k % len(texts)]
            out.append(dealt(article, other, LAYOUTS[k % len(LAYOUTS)], pick))
    return out


def sampled(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", size: int = SAMPLE) -> list[str]:
    """The html of at most ``size`` pages, a bounded sample to learn from."""
    rows = pages.select(F.col(id_col).alias("id"), F.col(html_col).alias("html")).where(F.col("html").isNotNull() & (F.length("html") <= LONGEST))
    # Of a large table only rows with small hashes, about twice the sample, are ordered and sent.
    span = 1 << 30
    rank = F.pmod(F.xxhash64("id", "html"), F.lit(span))
    least = rows.where(rank * F.lit(pages.count()) <= F.lit(2 * size * span))
    return [row["html"] for row in least.orderBy(rank, "id", "html").limit(size).collect()]


def main_text(html: str | None, field: Field) -> str:
    blocks = leaf_blocks(html)
    return "\n".join(block.text for block, own in zip(blocks, field.labels(blocks), strict=True) if own)


def extract(pages: DataFrame, field: Field, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``id``, ``text``, ``n_blocks`` and ``n_article_blocks`` of each page."""
    kind = pages.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            texts, n, own = [], [], []
            for html in batch.column(1):
                blocks = leaf_blocks(html.as_py())
                kept = [block.text for block, label in zip(blocks, field.labels(blocks), strict=True) if label]
                texts.append("\n".join(kept))
                n.append(len(blocks))
                own.append(len(kept))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(n, pa.int64()), pa.array(own, pa.int64())], [id_col, "text", "n_blocks", "n_article_blocks"])

    return pages.select(id_col, html_col).mapInArrow(run, f"`{id_col}` {kind}, text string, n_blocks long, n_article_blocks long")


def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query op6: the main text of every page."""
    pages = table(spark, sf_dir, "pages")
    field = fit(training_pages(sampled(pages)))
    rows = extract(pages.select(F.struct("page_id", "url").alias("page"), "html"), field, "page")
    return rows.select("page.page_id", "page.url", "text", F.length("text").cast("long").alias("n_chars"), "n_blocks", "n_article_blocks")
