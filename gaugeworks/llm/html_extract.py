"""Main text of web pages by tag-path ratios.

Every text node has a root-to-leaf tag path (tag names, with the class where there is one). Over a page,
each path gets two ratios: characters per node and punctuation marks per node. Both are smoothed over the
node sequence with a Gaussian and fused by their product, as a share of the page's deviation. What a page
says of itself enters as a prior of the path: under an <article> (or <main>) its score is raised, beside one it
is lowered, in a link it is cut, and under an element that is never content by tag, role, class or id
(made of nothing but such words: `ad`, `site-footer`, `comments-list`, but not `social-science`) it is next to
nothing. The paths above a threshold are content; no text is taken or left but by its path's score and its
place among the blocks that such paths make.

A block is content if most of its characters are on content paths. On a page with articles these blocks are the text,
with single links between them; any number of articles, and of texts of <main> around them, may take part. Small
articles (teasers) have no prior. On a page without, the smallest section that leaves hardly any content
outside is chosen; in a section without bounds of its own (the body), short blocks on other paths stay only
as headings of content or between content. A form is never content if it has fields and, for each of them, little prose;
one around a whole page is. Hidden and raw-text elements are no nodes at all.

Null or empty html, and pages without content: text '' and 0 characters. Broken markup (tags not closed,
cut references, stray '<') is read as far as it goes. Very long and deeply nested pages: every text is read
whole, in one pass over the tags. Ties: the first section in page order. Repeated rows each have their row; an
empty table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import html as references
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import small_batches

#: HTML's void elements, raw-text elements, blocks, sections, headings.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "noscript", "template", "iframe", "svg", "title")
BLOCKS = set("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
SECTIONS = {"article", "main", "section", "div", "td", "body", "center", "table", "tbody", "tr"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Start tags that close an open element of the same kind.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Never content: by tag, by role, by a class or id whose words all are one of these or of the plain ones.
UNSHOWN_TAGS = set("head button select script style noscript template iframe svg canvas object textarea title".split())
NEVER_TAGS = set("nav header footer aside menu dialog".split())
FIELDS = {"input", "select", "textarea", "button"}
NEVER_ROLES = set("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
NEVER_WORDS = set("ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies copyright discussion disqus disclaimer feedback footer footnav form header masthead menu modal nav navbar navigation newsletter notice notices pagination pager popup promo promoted reaction reactions related replies reply respond share sharing sidebar signup skip social sponsor sponsored subscribe tags toolbar widget".split())
PLAIN_WORDS = set("area bar block body bottom box btn button buttons col column container content div global group holder inner item items left link links list main outer page panel post posts reader readers row section site slot sticky text top right unit user users visitor visitors widget widgets wrap wrapper".split())

#: The least share of the largest article's prose that makes an article one of the page's, and the most that may lie outside a smaller section.
FAIR, OUTSIDE = 0.3, 0.2
#: Priors of paths: in an article, in <main> around one, beside both; what a link and what an element that is never content leave of a score.
IN_ARTICLE, IN_MAIN, BESIDE, IN_LINK, NEVER = 1.0, 0.6, -0.6, 0.3, 0.02
#: Characters of a text that may be prose, and prose that a field of a form stands for.
PROSE, FIELD = 80, 80
#: Links in a row that make a menu, where the paths don't say otherwise.
MENU = 3

_QUOTED = r"\"[^\"]*+\"(?=[\s/>])|'[^']*+'(?=[\s/>])|[\"']"
_SELF_CLOSED = r"<svg(?=[\s/])(?:=\s*[^\s\"'<>]++|[^\"'<>/=]++|/(?!>)|=|" + _QUOTED + ")*+/>"
_TOKEN = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|" + _SELF_CLOSED + "|<(?P<raw>" + "|".join(RAW) + r")(?=[\s/>])(?P<rest>(?:[^\"'>]++|" + _QUOTED + r")*+)>.*?(?:</(?P=raw)\s*>|\Z)|<(?P<close>/?)(?P<name>[A-Za-z][A-Za-z0-9:._-]*+)(?P<attrs>(?:[^\"'<>]++|" + _QUOTED + r")*+)>|<[!?][^>]*>", re.S | re.I)
#: One attribute at a time from the tag's start: each takes its whole value, so that no word of a value is read as a name.
_ATTR = re.compile(r"""([^\s/>=][^\s/>=]*+)(?:\s*=\s*("[^"]*(?:"|\Z)|'[^']*(?:'|\Z)|[^\s>]*))?""")
_HIDDEN_FIELD = re.compile(r"(?i)(?<![^\s\"'])type\s*=\s*[\"']?hidden")
_WORD = re.compile(r"[a-z]+")
_UNSHOWN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b")
_MARK = re.compile(r"[.,;:!?…。，、；：！？]")


class _Path:
    """A root-to-leaf tag path. Elements with a prior of their own (articles, forms) have paths of their own."""

    __slots__ = ("link", "never", "parent", "prior", "shut")

    def __init__(self, parent: _Path | None, link: bool, never: bool):
        self.parent, self.link, self.never, self.prior, self.shut = parent, link, never, 0.0, False


class _Node:
    """An element. Its descendants are those numbered from its own number up to `end`."""

    __slots__ = ("block", "end", "heading", "link", "never", "number", "parent", "path", "soft", "tag", "unshown")

    def __init__(self, tag: str, parent: _Node | None, never: bool, unshown: bool, number: int):
        self.tag, self.parent, self.number, self.end = tag, parent, number, -1
        self.unshown = unshown or (parent is not None and parent.unshown)
        above = parent is not None
        # an article's own header: its heading is the article's, the rest of it is not
        inside = above and parent.soft
        self.soft = inside or (tag == "header" and above and not parent.never and _within_article(parent))
        self.heading = tag in HEADINGS or (above and parent.heading)
        if self.heading and self.soft and not (above and parent.never and not inside):
            self.never = never
        else:
            self.never = never or (above and parent.never)
        self.link = tag == "a" or (above and parent.link)
        self.block = tag in BLOCKS


def _within_article(e: _Node | None) -> bool:
    while e is not None:
        if e.tag in ("article", "main"):
            return True
        e = e.parent
    return False


def _named_never(value: str) -> bool:
    """Whether one of the names in a class or id consists of words that tell what is never content."""
    for name in value.split():
        words = _WORD.findall(name)
        if any(w in NEVER_WORDS for w in words) and all(w in NEVER_WORDS or w in PLAIN_WORDS for w in words):
            return True
    return False


class _Page:
    """Elements of a page in order, and its text nodes (element, text, block number) that may be content. A block number changes wherever a block starts or ends."""

    def __init__(self, page: str):
        self.paths: dict[tuple, _Path] = {}
        self.root = _Node("html", None, False, False, 0)
        self.root.path = _Path(None, False, False)
        self.elements, self.texts, self.fields = [self.root], [], []
        self.open: Counter[str] = Counter()
        at, block, position = self.root, 0, 0
        for m in _TOKEN.finditer(page):
            if m.start() > position and not at.unshown:
                self.texts.append((at, page[position : m.start()], block))
            position = m.end()
            name = m["name"]
            raw = (m["raw"] or "").lower()
            if raw == "textarea":
                self.fields.append(at)
            if not name:
                continue
            name = name.lower()
            if name in FIELDS and not m["close"] and not _HIDDEN_FIELD.search(m["attrs"]):
                self.fields.append(at)
            if name in ("html", "body") and not m["close"] and at is not self.root:
                continue
            if m["close"]:
                if self.open[name]:
                    at = self._closed(at, {name})
                block += name in BLOCKS
            elif name in VOID:
                if name == "hr":
                    block += 1
                elif name == "br":
                    self.texts.append((at, " ", block))
            elif name != "html":
                if name in BLOCKS:
                    block += 1
                    shut = CLOSES.get(name) or ({"p"} if name != "body" else set())
                    if any(self.open[x] for x in shut):
                        here = at
                        while here is not None and here.tag not in shut and (not here.block or (here.tag in ("p", "li", "dt", "dd") and name in CLOSES)):
                            here = here.parent
                        if here is not None and here.tag in shut and here.parent is not None:
                            at = self._closed(at, shut)
                at = self._opened(name, m["attrs"], at)
        if position < len(page) and not at.unshown:
            self.texts.append((at, page[position:], block))
        while at is not None:
            at.end, at = len(self.elements), at.parent

    def _closed(self, at: _Node, names: set[str]) -> _Node:
        """Closes the nearest of these elements that are open, and what is open in it."""
        while True:
            at.end, done = len(self.elements), at.tag in names
            self.open[at.tag] -= 1
            at = at.parent
            if done:
                return at

    def _opened(self, tag: str, attrs: str, parent: _Node) -> _Node:
        cls, never, unshown = "", tag in NEVER_TAGS, tag in UNSHOWN_TAGS
        if attrs and not attrs.isspace():
            for name, value in _ATTR.findall(attrs):
                name, value = name.lower(), value.strip("\"' ").lower()
                if name == "role":
                    never |= value in NEVER_ROLES
                elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and _UNSHOWN.search(value)):
                    unshown = True
                elif name in ("class", "id"):
                    never |= tag not in ("body", "html", "article", "main", *HEADINGS) and _named_never(value)
                    if name == "class" and (words := _WORD.findall(value)):
                        cls = words[0]
        node = _Node(tag, parent, never, unshown, len(self.elements))
        own = node.number if tag in ("article", "main", "form") else -1
        key = (parent.path, tag, cls, node.never, own)
        path = self.paths.get(key)
        if path is None:
            path = self.paths[key] = _Path(parent.path, node.link, node.never)
        node.path = path
        self.elements.append(node)
        self.open[tag] += 1
        return node

    def prepare(self, texts: list[tuple[_Node, str]]) -> list[_Node]:
        """Sets never and prior of all paths; gives the page's articles and <main>s. texts: text nodes that are not blank."""
        self._forms(texts)
        for path in self.paths.values():  # parents come first
            path.shut |= path.parent.shut
            path.never |= path.shut
        prose = [0] * (len(self.elements) + 1)
        for e, t in texts:
            prose[e.number + 1] += 0 if e.path.never or e.link else len(t.strip())
        before = np.cumsum(prose)
        held = lambda e: int(before[e.end] - before[e.number])
        tops: dict[str, list[_Node]] = {"article": [], "main": []}
        for tag, own in tops.items():
            end = 0
            for e in self.elements:  # those in another one are part of it
                if e.tag == tag and e.number >= end and not e.path.never:
                    own.append(e)
                    end = e.end
        most = max(map(held, tops["article"]), default=0)
        articles = [e for e in tops["article"] if held(e) and held(e) >= FAIR * most]
        mains = [e for e in tops["main"] if held(e)]
        if articles or mains:
            own_prior = {e.path: IN_MAIN for e in mains} | {e.path: IN_ARTICLE for e in articles}
            if not articles:
                own_prior = {e.path: IN_ARTICLE for e in mains}
            self.root.path.prior = BESIDE
            for path in self.paths.values():
                path.prior = max(own_prior.get(path, BESIDE), path.parent.prior)
        return articles + mains

    def _forms(self, texts: list[tuple[_Node, str]]) -> None:
        """Forms with fields and little prose for each of them are never content."""
        forms = [e for e in self.elements if e.tag == "form"]
        if not forms:
            return
        prose, fields = np.zeros(len(self.elements) + 1, np.int64), np.zeros(len(self.elements) + 1, np.int64)
        for e, t in texts:
            if len(t.strip()) >= PROSE:
                prose[e.number + 1] += len(t.strip())
        for e in self.fields:
            fields[e.number + 1] += 1
        prose, fields = np.cumsum(prose), np.cumsum(fields)
        for e in forms:
            n = fields[e.end] - fields[e.number]
            if n and prose[e.end] - prose[e.number] < FIELD * n:
                e.path.shut = True


def smooth(values: np.ndarray, radius: int = 1) -> np.ndarray:
    """Gaussian mean over neighbours, with the weights normed at the ends."""
    if len(values) < 2:
        return values.astype(float)
    reach = np.arange(-radius, radius + 1)
    weight = np.exp(-(reach**2) / (2 * radius**2))
    # the full convolution, cut to the middle: 'same' would give the window's length for short pages
    middle = lambda x: np.convolve(x, weight)[radius : radius + len(values)]
    return middle(values.astype(float)) / middle(np.ones(len(values)))


def path_scores(nodes: list[tuple[_Path, str]]) -> dict[_Path, float]:
    """Of (path, text) nodes in page order, each path's fused ratios as a share of the page's deviation, with its prior."""
    total: dict[_Path, list[int]] = {}
    for path, text in nodes:
        t = total.setdefault(path, [0, 0, 0])
        t[0] += len(text)
        t[1] += len(_MARK.findall(text))
        t[2] += 1
    by_length = smooth(np.array([total[p][0] / total[p][2] for p, _ in nodes]))
    by_marks = smooth(np.array([(total[p][1] + 1) / total[p][2] for p, _ in nodes]))
    fused = by_length * by_marks
    own: dict[_Path, list[float]] = {}
    for (path, _), score in zip(nodes, fused, strict=True):
        own.setdefault(path, []).append(score)
    counted = np.array([not p.never for p, _ in nodes])
    unit = math.sqrt(float(np.mean(fused[counted] ** 2))) if counted.any() else 1.0
    out = {}
    for p, v in own.items():
        score = sum(v) / len(v) / (unit or 1.0)
        out[p] = score * NEVER if p.never else (score + p.prior) * IN_LINK if p.link else score + p.prior
    return out


def content_paths(nodes: list[tuple[_Path, str]], strictness: float = 0.5) -> set[_Path]:
    """The paths that pass the threshold; if none does, the best that is not one of those that are never content."""
    if not nodes:
        return set()
    scores = path_scores(nodes)
    limit = min(strictness, max((s for p, s in scores.items() if not p.never), default=strictness))
    return {p for p, s in scores.items() if s >= limit}


class _Block:
    """Text of one block: where it begins, its characters, those on content paths, those in links, and its links."""

    __slots__ = ("at", "chars", "content", "heading", "linked", "links", "text", "weight")

    def __init__(self, nodes: list[tuple[_Node, str]], chosen: set[_Path]):
        written = [(e, t, len(t.strip())) for e, t in nodes]
        written = [x for x in written if x[2]]
        self.at = written[0][0]
        self.text = " ".join("".join(t for _, t in nodes).split())
        self.chars = sum(n for *_, n in written)
        self.content = 2 * sum(n for e, _, n in written if e.path in chosen) >= self.chars
        self.linked = sum(n for e, _, n in written if e.link)
        self.links = len({id(e) for e, *_ in written if e.link})
        self.heading = all(e.heading for e, *_ in written)
        self.weight = self.chars - self.linked if self.content else 0


def _section(page: _Page, blocks: list[_Block]) -> tuple[_Node, bool]:
    """The section that the content chooses, and whether its bounds are those of the main text."""
    held = [0] * len(page.elements)
    for b in blocks:
        held[b.at.number] += b.weight
    if not any(held):
        for b in blocks:
            held[b.at.number] += b.chars if b.content else 0
    for e in reversed(page.elements):
        if e.parent is not None:
            held[e.parent.number] += held[e.number]
    below: dict[int, list[_Node]] = {}
    for e in page.elements:
        if e.tag in SECTIONS and e.parent is not None and held[e.number]:
            below.setdefault(e.parent.number, []).append(e)
    at = page.root
    while inner := below.get(at.number):
        best = max(inner, key=lambda e: held[e.number])
        if held[at.number] - held[best.number] > OUTSIDE * held[at.number]:
            break
        at = best
    return at, at.tag not in ("html", "body")


def _without_menus(blocks: list[_Block]) -> list[_Block]:
    """All blocks but runs of links that lie on no content path."""
    out: list[_Block] = []
    run: list[_Block] = []
    for b in [*blocks, None]:
        if b is not None and not b.content and not b.heading and 10 * b.linked >= 8 * b.chars:
            run.append(b)
            continue
        if sum(x.links for x in run) < MENU:
            out += run
        run = []
        if b is not None:
            out.append(b)
    return out


def _between(blocks: list[_Block]) -> list[_Block]:
    """Content blocks, headings that lead to one, and what lies between the first and the last of them."""
    content = [i for i, b in enumerate(blocks) if b.content]
    if not content:
        return []
    first, last = content[0], content[-1]
    while first and blocks[first - 1].heading:
        first -= 1
    return blocks[first : last + 1]


def main_text(page: str | None) -> str:
    """The page's text, its blocks joined by line ends."""
    if not page:
        return ""
    read = _Page(page)
    found = [(e, references.unescape(t), b) for e, t, b in read.texts]
    written = [(e, t) for e, t, _ in found if t and not t.isspace()]
    if not written:
        return ""
    tops = read.prepare(written)
    chosen = content_paths([(e.path, t) for e, t in written])
    blocks: list[_Block] = []
    held: list[tuple[_Node, str]] = []
    for i, (e, t, b) in enumerate(found):
        if not e.path.never or e.path in chosen or t.isspace():
            held.append((e, t))
        if i + 1 == len(found) or found[i + 1][2] != b:
            if any(x and not x.isspace() for _, x in held):
                blocks.append(_Block(held, chosen))
            held = []
    if not any(b.content for b in blocks):
        return ""
    if tops:
        within = lambda b: any(e.number <= b.at.number < e.end for e in tops)
        kept = [b for b in _without_menus(blocks) if b.content or (within(b) and (b.heading or b.linked))]
        return "\n".join(b.text for b in kept)
    section, bounded = _section(read, blocks)
    inside = [b for b in blocks if section.number <= b.at.number < section.end]
    kept = _without_menus(inside)
    if not bounded:
        kept = _between(kept)
    elif not any(b.heading for b in kept[:1]):
        # the title may stand before the section
        kept = [b for b in blocks if b.heading and b.at.number < section.number][-1:] + kept
    return "\n".join(b.text for b in kept)


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) for every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 2):
            text = [main_text(x) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array(map(len, text), pa.int64())], ["id", "url", "text", "n_chars"])

    df = df.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return df.mapInArrow(run, "id long, url string, text string, n_chars long").withColumnsRenamed({"id": id_col, "url": url_col})
