"""Main-text extraction by tag-path ratios.

A page is cut into blocks of text, each with its root-to-leaf tag path (inline
formatting does not count). Text length and punctuation are aggregated per
path; a path's ratio is its text per node, spread by how much the lengths
vary, times its punctuation per node. The ratios are put back on the blocks in
page order, smoothed over neighbours, fused with the raw ones, and weighted by
the share of the text outside links and by what elements and class names say:
an article or one named like it counts more, what is named like furniture
little. Blocks over the page's own threshold are content, and so are the plain
blocks of the container that such a block is in, however short: headings, list
items, cells. Names alone drop nothing: a name is read by whole tokens
("site-footer" and "sidebar-left" are furniture, "has-sidebar" and
"related-work" are not), never on the page's own article, and not where nearly
all of the text carries such names. Elements that HTML itself marks as
furniture (menus, footers, asides, buttons, hidden ones) are left out; a form
is, unless nearly all of the page is in it.

Defined results: null, empty and text-free pages give an empty text; a page
without markup is one block; unclosed and stray tags are repaired; character
references are decoded; nothing is cut or capped. One narrow map over the
pages, each page by itself, whatever its length; time and memory grow with the
page's length, not with its depth.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(script|style|noscript|template|textarea|title|iframe|svg|annotation|annotation-xml|object|select|xmp)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[a-zA-Z/][^>]*>?|[^<]+|<",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""([\w:-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NAME_PART = re.compile(r"[a-z]+")
_PUNCTUATION = re.compile(r"[.,;:!?\u2026\u3001\u3002\uff0c\uff01\uff1f\u00bf\u00a1]")

#: HTML's void elements, its inline elements, and what closes an open paragraph or item.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var br wbr img"
    " math semantics mrow mi mn mo ms mtext mfrac msqrt mroot msub msup msubsup munder mover munderover mtable mtr mtd mstyle mpadded mphantom menclose mfenced".split()
)
SIBLINGS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table", "tbody", "thead", "tfoot"), "td": ("tr",), "th": ("tr",), "option": ("select",)}
SAME = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements and roles that are page furniture by HTML's own meaning, and those that hold the article.
NOISE_TAGS = frozenset("head nav footer aside button dialog menu".split())
FORM_TAGS = frozenset("form fieldset".split())
NOISE_ROLES = frozenset("navigation banner complementary contentinfo search form dialog alert menu menubar toolbar".split())
CONTENT_TAGS = frozenset("article main".split())
#: Elements whose plain blocks belong together.
SCOPES = frozenset("article main section div td blockquote".split())
#: Parts of class names and ids of furniture, of what stands around them, and of the article.
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright disqus footer header login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promotion recommended related search share sharing sidebar signup social sponsor sponsored subscribe teaser toolbar tracking widget".split()
)
LAYOUT_WORDS = frozenset(
    "area article articles bar block body bottom box button buttons card container content form group icons inner item items left link links list main outer panel post posts respond right section slot stories thread top unit wrap wrapper".split()
)
STATES = frozenset("has is no not with without".split())
CONTENT_WORDS = frozenset("article content entry post story".split())
#: Weights of text in an article, in what is named like one, and in what is named like furniture.
IN_ARTICLE, NAMED, FURNITURE = 4.0, 2.0, 0.01
#: Content scores at least this share of the score that half of the page's characters outside named furniture reach.
SHARE = 0.1
#: A page whose text is so much more inside furniture-named elements, or inside forms, than outside has its content there.
MOSTLY = 4


class _Open:
    """An open element: its path's number, what hides it, and what its names and those around it say."""

    __slots__ = ("tag", "path", "noise", "article", "named", "furniture", "scope")

    def __init__(self, tag: str, path: int, noise: int, article: bool, named: bool, furniture: bool, scope: int):
        self.tag, self.path, self.noise, self.article, self.named, self.furniture, self.scope = tag, path, noise, article, named, furniture, scope


class Block:
    """A run of text: its tag path's number, its share of text in links, its weight, whether named as furniture, its scope."""

    __slots__ = ("path", "text", "linked", "article", "named", "furniture", "scope", "heading", "form")

    def __init__(self, top: _Open, text: str, linked: float):
        self.path, self.text, self.linked = top.path, text, linked
        self.article, self.named, self.furniture, self.scope = top.article, top.named, top.furniture, top.scope
        self.heading, self.form = top.tag in HEADINGS, top.noise == _FORM

    @property
    def weight(self) -> float:
        return (IN_ARTICLE if self.article else NAMED if self.named else 1.0) * (FURNITURE if self.furniture else 1.0) * (1.0 - 0.9 * self.linked)


_SHOWN, _FORM, _HIDDEN = 0, 1, 2


def names_furniture(name: str) -> bool:
    """Whether a token of a class or id names furniture: its last part does, or its first, with words of layout behind it."""
    parts = _NAME_PART.findall(name)
    if not parts or parts[0] in STATES or (len(parts) > 1 and STATES.intersection(parts[:-1])):
        return False
    return parts[-1] in NOISE_WORDS or (parts[0] in NOISE_WORDS and all(p in NOISE_WORDS or p in LAYOUT_WORDS for p in parts[1:]))


def names_content(name: str) -> bool:
    parts = _NAME_PART.findall(name)
    return bool(parts) and parts[0] not in STATES and (parts[0] in CONTENT_WORDS or parts[-1] in CONTENT_WORDS)


def _marks(tag: str, attributes: str, article: bool, block: bool) -> tuple[int, bool, bool, bool]:
    """(what hides it, article, named like one, named like furniture) that an element's own tag and attributes say."""
    noise = _HIDDEN if tag in NOISE_TAGS or (tag == "header" and not article) else _FORM if tag in FORM_TAGS else _SHOWN
    inside, named, furniture = tag in CONTENT_TAGS, False, False
    if attributes and noise != _HIDDEN:
        own = tag in ("html", "body") or tag in HEADINGS or (tag in CONTENT_TAGS and not article)
        for name, value in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'").lower()
            if name in ("class", "id"):
                if block and not own:
                    tokens = value.split()
                    furniture = furniture or any(map(names_furniture, tokens))
                    named = named or any(map(names_content, tokens))
            elif name == "role":
                noise = _HIDDEN if value in NOISE_ROLES else noise
                inside = inside or value in CONTENT_TAGS
            elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none", value)):
                noise = _HIDDEN
    return noise, inside, named, furniture


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page that its tags do not hide, in page order."""
    root = _Open("", 0, _SHOWN, False, False, False, 0)
    stack, out, top, scopes = [root], [], root, 0
    paths: dict[tuple[int, str], int] = {}
    buffer: list[str] = []
    in_links = 0
    count: Counter[str] = Counter()  # open elements by tag

    def close(i: int) -> None:
        for e in stack[i:]:
            count[e.tag] -= 1
        del stack[i:]

    def flush() -> None:
        nonlocal in_links
        if buffer:
            raw = "".join(buffer)
            text = " ".join(html.unescape(raw).split())
            if text:
                out.append(Block(top, text, min(1.0, in_links / max(1, sum(map(len, raw.split()))))))
            buffer.clear()
        in_links = 0

    for token in _TOKEN.finditer(page):
        raw, tag = token[0], token[3]
        if tag is None:
            if raw[0] != "<" or raw == "<":
                if top.noise != _HIDDEN:
                    buffer.append(raw)
                    in_links += sum(map(len, raw.split())) if count["a"] else 0
            elif raw.startswith("<![CDATA[") and top.noise != _HIDDEN:
                buffer.append(html.escape(raw[9:].removesuffix("]]>")))
            continue
        tag, attributes = tag.lower(), token[4]
        block = tag not in INLINE
        if tag in ("br", "wbr", "img"):
            if tag == "br" and top.noise != _HIDDEN:
                buffer.append(" ")
            continue
        if block:
            flush()
        if token[2]:  # end tag
            if count[tag]:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == tag:
                        close(i)
                        break
                    if not block and stack[i].tag not in INLINE:
                        break  # an inline end tag closes nothing outside its block
            top = stack[-1]
            continue
        if tag in VOID:
            continue
        if block:
            closes = ("p",) if tag not in SIBLINGS else SAME.get(tag, (tag,))
            stops = SIBLINGS.get(tag, ("table", "td", "th", "button", "li", "div", "section", "article", "main", "body", "blockquote"))
            for i in range(len(stack) - 1, 0, -1) if any(count[c] for c in closes) else ():
                if stack[i].tag in closes:
                    close(i)
                    break
                if stack[i].tag in stops:
                    break
            while stack[-1].tag in INLINE:
                close(len(stack) - 1)
        top = stack[-1]
        noise, article, named, furniture = _marks(tag, attributes, top.article, block)
        if attributes.rstrip().endswith("/") and not block:
            continue
        path = paths.setdefault((top.path, tag), len(paths) + 1) if block else top.path
        scope = top.scope
        if article or (tag in SCOPES and not top.article):  # inside an article, all is of its scope
            scopes += 1
            scope = scopes
        stack.append(_Open(tag, path, max(noise, top.noise), top.article or article, top.named or named, top.furniture or furniture, scope))
        count[tag] += 1
        top = stack[-1]
    flush()
    return out


def path_scores(blocks: list[Block]) -> list[float]:
    """Fused tag-path ratio of every block, weighted."""
    sums: dict[int, list[float]] = {}
    for b in blocks:
        s = sums.setdefault(b.path, [0, 0.0, 0.0, 0.0])
        s[0] += 1
        s[1] += len(b.text)
        s[2] += len(b.text) ** 2
        s[3] += len(_PUNCTUATION.findall(b.text))
    ratio = {p: (chars / n) * (1 + max(squares / n - (chars / n) ** 2, 0.0) ** 0.5) * (1 + marks / n) for p, (n, chars, squares, marks) in sums.items()}
    raw = [ratio[b.path] for b in blocks]
    padded = [raw[0], *raw, raw[-1]] if raw else []
    smooth = [(padded[i] + 2 * padded[i + 1] + padded[i + 2]) / 4 for i in range(len(raw))]
    return [(r * s) ** 0.5 * b.weight for r, s, b in zip(raw, smooth, blocks, strict=True)]


def threshold_of(blocks: list[Block], scores: list[float]) -> float:
    """SHARE of the highest score that blocks with half of the characters outside named furniture reach."""
    counted = [(score, b) for score, b in zip(scores, blocks, strict=True) if not b.furniture]
    left = sum(len(b.text) for _, b in counted) / 2
    for score, b in sorted(counted, key=lambda x: -x[0]):
        left -= len(b.text)
        if left <= 0:
            return SHARE * score
    return 0.0


def _chars(blocks: list[Block]) -> int:
    return sum(len(b.text) for b in blocks)


def main_text(page: str | None) -> str:
    """Main text of one page: the content blocks in page order, one to a line."""
    blocks = blocks_of(page or "")
    shown = [b for b in blocks if not b.form]
    if _chars(blocks) <= (MOSTLY + 1) * _chars(shown):  # else a form around the page is no furniture
        blocks = shown
    plain = [b for b in blocks if not b.furniture]
    if not any(b.article for b in plain) and _chars(blocks) > (MOSTLY + 1) * _chars(plain):
        for b in blocks:
            b.furniture = False
    scores = path_scores(blocks)
    threshold = threshold_of(blocks, scores)
    chosen = [score >= threshold for score in scores]
    scopes = {b.scope for b, c in zip(blocks, chosen, strict=True) if c and not b.furniture and b.scope}
    last = max((i for i, c in enumerate(chosen) if c), default=-1)
    before = False
    for i, b in enumerate(blocks):
        if not chosen[i] and not b.furniture and (b.article or b.linked < 0.5 or b.heading):
            follows = i + 1 < len(blocks) and chosen[i + 1]
            # plain blocks of a container with content, those between two blocks of content, and headings of content
            chosen[i] = b.scope in scopes or (before and i < last and b.linked < 0.5 and follows) or (b.heading and follows)
        before = chosen[i]
    return "\n".join(b.text for b, c in zip(blocks, chosen, strict=True) if c)


def extract(df: DataFrame, page: str, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``df`` with the main ``text`` of the page and its code points ``n_chars``."""
    source = df.select(df[page].alias("__page"), *[df[c] for c in keep])
    fields = "".join(f"`{c}` {t}, " for c, t in df.select(*keep).dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p.as_py()) for p in batch.column(0)]
            made = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *made], names=[*keep, "text", "n_chars"])

    return source.mapInArrow(run, f"{fields}text string, n_chars long")
