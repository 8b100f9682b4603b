"""Main text of web pages by consensus of their host.

1. Each page is cut into blocks once; a block's text counts for the container it
   stands in and, halved at each step, for the containers around that one. It is
   not halved on the way to the nearest article or main, out of a quotation, or
   to a container (other than the body) whose other text is mostly outside
   links: those hold headline, lead and sections beside the largest one. The
   page's points are shared out among its containers (parts of a million), without
   those around its best one, which templates of a host that differ would share.
2. Containers are named by their generalised path: tags and classes from the
   body down, digits levelled. Spark sums the votes per (host, path), partially
   before the shuffle, and the path with most votes wins the host.
3. Each page is extracted again with its host's path. A page that has no such
   container is extracted with the path that it gave most points itself.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and
reader comments are left out wherever they stand, by tag, role, class or id, as are
elements hidden by attribute or inline style. Names are cut into words at separators,
camel case and known compounds (``commentlist``). Names
of a state or subject (``has-sidebar``, ``tag-ads``) don't count, nor do usual subjects
beside words other than those of layout (``social-housing``), and inside an article
no word does beside such others. A main or article is
read in a wrapper left out by its name or as a form, and so is a form that has most of the
page's text (one left out by names: with the headline too); a page that is left empty
is read heeding neither. A headline (h1) and lead that stand right
before the winning container, in one around it, belong to it.
Character references are decoded, white space inside a block becomes one space,
blocks are joined in page order by one line break.

The winners are a table of one row per host. It is broadcast while it is within
``BROADCAST_HOSTS`` rows and ``BROADCAST_CHARS`` characters; beyond that, hosts
with many pages are joined through a bounded broadcast and all others by sort
and merge, with the same result.

Defined results: a null html has an empty text; a page without any container
counts as its body. A null or odd url belongs to the host ``''``. Unclosed,
misnested and unknown tags and cut-off pages are read as far as they go. Ties in
votes go to the path that sorts last. Repeated rows vote and are extracted each.
An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from functools import lru_cache
from html import unescape

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from chatlake.llm.common import join_skewed, stored

BROADCAST_HOSTS, BROADCAST_CHARS = 50_000, 4_000_000

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|title|noscript|template|textarea|iframe|svg|math|object)\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|</(?P<end>[a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)"
    r"|<(?P<start>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(?P<odd>[a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)",
    re.S | re.I,
)
_ATTR = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
_SPECIAL = re.compile(r"class|id|role|hidden|style", re.I)

_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_CONTAINER = set("body main article section div td blockquote center".split())
_BLOCK = _CONTAINER | set(
    "html head p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd table thead tbody tfoot tr th caption pre hr figure figcaption "
    "address nav header footer aside form fieldset details summary menu dialog hgroup legend search".split()
)
_OUT = set(
    "nav footer aside menu dialog button select option input label fieldset legend search audio video canvas".split()
)
#: A start tag in the set closes an open element of the same set, up to the nearest of the bounds.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_KEPT = {"html", "body", "main", "article"}
_ARTICLE = {"main", "article"}
#: Words of names that say that an element is no part of the text.
_SIDE = set(
    "ad ads advert adverts advertisement advertisements advertising advertorial sponsor sponsors sponsored promo promos "
    "promoted promotion promotions nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars footer masthead "
    "cookie cookies gdpr newsletter signup subscribe login popup modal toolbar pagination pager comment comments disqus".split()
)
#: The same, but usual subjects too (``social-housing``): they count with words of layout only.
_EITHER = set(
    "banner banners notice notices alert alerts consent share sharing social related recommended respond form overlay "
    "widget widgets".split()
)
_COMMENTS = {"comment", "comments", "disqus", "respond"}
#: Words of layout, which say nothing about the subject.
_LAYOUT = set(
    "left right top bottom main primary secondary box boxes bar bars wrap wrapper container outer inner content contents area "
    "block blocks section list item items link links button buttons icon icons count site page post posts article articles "
    "entry entries story stories global header title head heading body group row column col panel slot unit zone module text "
    "message msg small large mini sticky fixed float floating mobile desktop inline js media this us follow author meta reply "
    "replies thread date search user users reader readers visitor visitors more close sub layout "
    "recent popular latest".split()
)
_WHOLE = {"header", "site-header", "page-header"}
#: Parts of names that tell a state or a subject, not what the element is.
_STATES = re.compile(r"(?:^|(?<=[\s_-]))(?:has|with|without|no|category|cat|tag|tagged)[_-]\S*", re.I)
_ROLES = set("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar".split())
_CAMEL = re.compile(r"(?<=[a-z\d])(?=[A-Z])")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class _Element:
    __slots__ = ("tag", "path", "out", "link", "soft")

    def __init__(self, tag: str, path: str, out: bool, link: bool, soft: _Box | None = None):
        self.tag, self.path, self.out, self.link, self.soft = tag, path, out, link, soft


class _Box:
    """What an element holds that is left out as a form or by its names, apart from such elements inside it."""

    __slots__ = ("at", "form", "comments", "chars", "headline")

    def __init__(self, at: int, form: bool, comments: bool):
        self.at, self.form, self.comments, self.chars, self.headline = at, form, comments, 0, False

    def article(self, kept: int) -> bool:
        """Whether it has most of the page's text; a box left out by names must have a headline too."""
        return not self.comments and self.chars > kept and (self.form or self.headline)


def _left_out(tag: str, attrs: dict[str, str], stack: list[_Element]) -> bool:
    if tag in _OUT:
        return True
    if tag == "header":
        return not any(e.tag in ("article", "main") for e in stack)
    if tag in _KEPT:
        return False
    if "hidden" in attrs or _UNSEEN.search(attrs.get("style", "")) or attrs.get("aria-hidden", "").strip().lower() == "true":
        return True
    return attrs.get("role", "").strip().lower() in _ROLES


@lru_cache(4096)
def _words(part: str) -> tuple[str, ...]:
    """A part of a name, cut into a word of ``_SIDE`` or ``_EITHER`` and one of ``_LAYOUT`` if it is both run together."""
    known = _SIDE | _EITHER
    if part in known or part in _LAYOUT:
        return (part,)
    for i in range(2, len(part) - 1):
        a, b = part[:i], part[i:]
        if (a in known and b in _LAYOUT) or (a in _LAYOUT and b in known):
            return a, b
    return (part,)


@lru_cache(4096)
def _says_out(name: str, inside: bool, whole: bool) -> str:
    """The word by which a class or id names its element as no part of the text, or ``''``.

    ``inside`` an article or main, and of paragraphs and inline tags (``whole``), the rest of the name must be words of layout.
    """
    if name.lower() in _WHOLE:
        return "" if inside or whole else name.lower()
    parts = [w for p in re.split(r"[\W_]+", _CAMEL.sub("-", name).lower()) if p for w in _words(p)]
    plain = all(p in _SIDE or p in _EITHER or p in _LAYOUT or p.isdigit() for p in parts)
    for p in parts:
        if p in _EITHER and plain or p in _SIDE and (plain or not (inside or whole)):
            return p
    return ""


def _named_out(tag: str, attrs: dict[str, str], inside: bool) -> str:
    if tag in _KEPT:
        return ""
    whole = tag == "p" or tag not in _BLOCK
    names = _STATES.sub("", f"{attrs.get('class', '')} {attrs.get('id', '')}").split()
    return next(filter(None, (_says_out(n, inside, whole) for n in names)), "")


def blocks(html: str) -> list[tuple[str, str, int]]:
    """(container path, text, characters outside links) of each block that isn't left out, in page order.

    A form that has most of the page's text is read, as is what names leave out if it also has the headline; comments
    are not. A page that is left without text is read heeding neither names nor forms.
    """
    found, boxes = _blocks(html, True, frozenset())
    kept = sum(chars for _, _, chars in found)
    if again := frozenset(b.at for b in boxes if b.article(kept)):
        found, _ = _blocks(html, True, again)
    return found or _blocks(html, False, frozenset())[0]


def _blocks(html: str, soft: bool, read: frozenset[int]) -> tuple[list[tuple[str, str, int]], list[_Box]]:
    """The blocks and the boxes left out; ``soft``: heed names and forms, but for those that start at ``read``."""
    stack = [_Element("", "body", False, False)]
    found: list[tuple[str, str, int]] = []
    boxes: list[_Box] = []
    pieces: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            if text := " ".join("".join(pieces).split()):
                found.append((stack[-1].path, text, max(0, len(text) - linked)))
            pieces.clear()
        linked = 0

    def close(at: int) -> None:
        if any(e.tag in _BLOCK for e in stack[at:]):
            flush()
        del stack[at:]

    at = 0
    for token in _TOKEN.finditer(html):
        if token.start() > at:
            if not stack[-1].out:
                text = unescape(html[at : token.start()])
                pieces.append(text)
                if stack[-1].link:
                    linked += len(text)
            elif stack[-1].soft and not stack[-1].link:
                stack[-1].soft.chars += len(html[at : token.start()].strip())
        at = token.end()
        if end := token["end"]:
            end = end.lower()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == end:
                    close(i)
                    break
                if end not in _BLOCK and stack[i].tag in _BLOCK:
                    break  # an inline end tag doesn't close blocks
            continue
        tag = token["start"] or token["odd"]
        if not tag:
            continue
        tag = tag.lower()
        if tag in _VOID:
            if tag == "hr":
                flush()
            elif tag == "br" and not stack[-1].out:
                pieces.append(" ")
            continue
        if tag in _BLOCK:
            flush()
            for i in range(len(stack) - 1, 0, -1):  # a block ends an open paragraph
                if stack[i].tag == "p":
                    del stack[i:]
                    break
                if stack[i].tag in _BLOCK:
                    break
            if tag in _CLOSES:
                same, bounds = _CLOSES[tag]
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in same:
                        del stack[i:]
                        break
                    if stack[i].tag in bounds:
                        break
        raw = token["attrs"] or ""
        attrs = {}
        if raw and _SPECIAL.search(raw):
            attrs = {k.lower(): unescape(a or b or c) for k, a, b, c in _ATTR.findall(raw)}
            if re.search(r"(?:^|\s)hidden(?=$|\s|=)", raw, re.I):
                attrs["hidden"] = ""
        above = stack[-1]
        path = above.path
        if tag in _CONTAINER and tag != "body":
            names = sorted(set(re.sub(r"\d+", "#", attrs.get("class", "")).split()))
            path += "/" + ".".join([tag, *names])
        elif tag == "h1":
            path += "/h1"
        out, box = above.out, above.soft  # box: left out as a form or by names only
        inside = any(e.tag in _ARTICLE for e in stack)
        if tag in _ARTICLE and box and not inside and not box.comments:
            out, box = False, None
        if _left_out(tag, attrs, stack):
            out, box = True, None
        elif soft and (not out or box):
            form = tag == "form" or attrs.get("role", "").strip().lower() == "form"
            name = _named_out(tag, attrs, inside)
            if token.start() in read:
                out, box = False, None
            elif form or name:
                comments = name in _COMMENTS or (box is not None and box.comments)
                out, box = True, _Box(token.start(), form and not name, comments)
                boxes.append(box)
        if box and tag == "h1":
            box.headline = True
        stack.append(_Element(tag, path, out, above.link or tag == "a", box))
    if at < len(html) and not stack[-1].out:
        pieces.append(unescape(html[at:]))
    flush()
    return found, boxes


def _whole(page: list[tuple[str, str, int]]) -> set[str]:
    """Containers whose parent is the better choice, as it has more of the article."""
    text: dict[str, list[int]] = defaultdict(lambda: [0, 0])  # characters, and those outside links
    for path, block, chars in page:
        while True:
            text[path][0] += len(block)
            text[path][1] += chars
            if "/" not in path:
                break
            path = path.rpartition("/")[0]
    found = set()
    for path, (size, chars) in text.items():
        parent = path.rpartition("/")[0]
        if not parent:
            continue
        tags = [step.partition(".")[0] for step in path.split("/")]
        rest, rest_chars = text[parent][0] - size, text[parent][1] - chars
        inside = tags[-1] not in _ARTICLE and any(t in _ARTICLE for t in tags[:-1])
        beside = parent != "body" and rest > 0 and 2 * rest_chars >= rest
        if inside or beside or tags[-1] in ("blockquote", "h1"):
            found.add(path)
    return found


def points(page: list[tuple[str, str, int]]) -> dict[str, int]:
    """The page's million points by container path."""
    score: dict[str, float] = defaultdict(float)
    whole = _whole(page)
    for path, _, chars in page:
        share = float(chars)
        while share >= 1:
            score[path] += share
            if "/" not in path:
                break
            share = share if path in whole else share / 2
            path = path.rpartition("/")[0]
    best = max(score.items(), key=lambda x: (x[1], x[0]), default=("", 0))[0]
    score = {p: s for p, s in score.items() if not best.startswith(p + "/")}
    total = sum(score.values())
    return {p: int(1_000_000 * s / total) for p, s in score.items()} if total else {}


def text_at(page: list[tuple[str, str, int]], path: str | None) -> str:
    """The blocks in containers of ``path``, with a headline before them; of the page's own best path if it has none."""
    within = lambda at: [i for i, (p, _, _) in enumerate(page) if p == at or p.startswith(at + "/")]
    found = within(path) if path is not None else []
    if not found and page:
        path = max(points(page).items(), key=lambda x: (x[1], x[0]), default=("body", 0))[0]
        found = within(path)
    return "\n".join(page[i][1] for i in _headed(page, found, path))


def _headed(page: list[tuple[str, str, int]], found: list[int], path: str | None) -> list[int]:
    """``found`` with the last headline that stands before it in a container around ``path``, and what stands between
    them right there, if ``found`` has no headline itself. Links are no headline."""
    if not found or any("h1" in page[i][0].split("/") for i in found):
        return found
    for at in range(found[0] - 1, -1, -1):
        place, _, chars = page[at]
        parent = place.removesuffix("/h1")
        if parent != place and chars and path.startswith(parent + "/"):
            lead = [i for i in range(at + 1, found[0]) if page[i][0] == parent and 2 * page[i][2] >= len(page[i][1])]
            return [at, *lead, *found]
    return found


# ---- Spark --------------------------------------------------------------------


@pandas_udf(ArrayType(StructType([StructField("path", StringType()), StructField("points", LongType())])))
def _votes(pages: pd.Series) -> pd.Series:
    return pd.Series([list(points(blocks(h or "")).items()) for h in pages], dtype=object)


@pandas_udf(StringType())
def _extract(pages: pd.Series, paths: pd.Series) -> pd.Series:
    return pd.Series([text_at(blocks(h or ""), p) for h, p in zip(pages, paths)], dtype=object)


def host(url: str = "url") -> Column:
    return F.coalesce(F.lower(F.regexp_extract(F.col(url).cast("string"), r"^[A-Za-z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def winning_paths(pages: DataFrame) -> DataFrame:
    """(host, path, pages) of every host that got a vote; ``pages`` counts its rows."""
    votes = pages.select(host().alias("host"), F.explode_outer(_votes(F.col("html").cast("string"))).alias("v"))
    summed = votes.groupBy("host", "v.path").agg(F.sum("v.points").alias("votes"), F.count(F.lit(1)).alias("n"))
    return summed.groupBy("host").agg(F.max(F.struct("votes", "path")).path.alias("path"), F.sum("n").alias("pages"))


def extract(pages: DataFrame, broadcast_hosts: int = BROADCAST_HOSTS, broadcast_chars: int = BROADCAST_CHARS) -> DataFrame:
    """(page_id, url, host, path, text) of every row of ``pages``."""
    winners = stored(winning_paths(pages), "host_paths")
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"), host().alias("host"))
    size = winners.agg(
        F.count(F.lit(1)).alias("hosts"),
        F.sum(F.length("host") + F.coalesce(F.length("path"), F.lit(0))).alias("chars"),
        F.sum("pages").alias("pages"),
    ).first()
    if size.hosts <= broadcast_hosts and (size.chars or 0) <= broadcast_chars:
        joined = rows.join(F.broadcast(winners), "host")
    else:
        joined = join_skewed(rows, winners, "host", "pages", size.pages or 0)
    return joined.select("page_id", "url", "host", "path", _extract(F.col("html"), F.col("path")).alias("text"))
