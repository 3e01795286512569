"""Main text of web pages by site template removal.

A page's markup is read into a tree, and every element subtree gets a hash. Spark counts on how many different pages of
a host each hash stands; a subtree that many pages of its host share is the site's, not the page's, and is deleted.
What is left loses the parts that markup itself calls navigation, adverts, forms, notices and the like, and the main
text remains.

An article's own prose is never deleted for being repeated: a paragraph or heading inside ``article`` or ``main`` may
be quoted by many pages. Its other parts, such as share bars, are.
"""

from __future__ import annotations

import bisect
import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from wattline.llm.common import column, cut, sized_broadcast, whole

#: A subtree is the site's if it stands on at least so many different pages of its host, whatever the host's size. Callers
#: may also ask for a share of the host's pages.
MIN_PAGES = 5
MIN_SHARE = 0.0
#: Paragraphs outside of the main elements count as the page's own if they hold so many times the text of those.
OUTWEIGH = 2
#: An element whose name says noise is no noise if it holds more than this share of the page's text.
OWN_SHARE = 0.5
#: Most pages and hashes to delete, together, that are broadcast to the pages; beyond it that join is shuffled.
BROADCAST_BOUND = 1_000_000

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: Elements that never hold main text.
_NOISE = frozenset(
    "head script style title nav aside footer form button select option textarea input noscript template svg math "
    "iframe object embed dialog menu noembed noframes canvas audio video label fieldset".split()
)
_BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol optgroup option p pre search section "
    "summary table tbody td tfoot th thead tr ul".split()
)
_PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt td th tr figcaption ul ol table tbody".split())
_MAIN = ("article", "main")
#: Elements are nested at most so deep; deeper ones only end the block that they stand in.
_DEPTH = 150
#: Words of a class or id that mark a page's header, which is noise outside the main part.
_HEADER_NAMES = frozenset("header masthead topbar".split())
#: Beginnings of class names that say something of the layout around an element, not of the element.
_LAYOUT = ("has-", "has_", "with-", "with_", "no-", "no_", "is-", "is_", "without-")
#: Words of a class or id that mark a part which is not the page's own text.
_NOISE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner banners sponsor sponsored promo promotion "
    "promoted cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription "
    "signup sidebar sidebars aside related recommended recommendations share sharing social follow breadcrumb "
    "breadcrumbs crumbs menu menus nav navbar navigation topnav subnav footer foot bottombar "
    "comment comments commentlist respond reply replies disqus discussion widget widgets toolbar pagination pager "
    "login search searchbox skip skiplink disclaimer copyright".split()
)
_NOISE_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form toolbar".split()
)
#: Elements that a start tag closes if they are open (inside the nearest of the elements in the second set).
_CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tbody": (("tbody", "thead", "tr", "td", "th"), ("table",)),
    "tfoot": (("tbody", "thead", "tr", "td", "th"), ("table",)),
}
_CLOSES_P = _BLOCK - {"br", "body", "html", "li", "dd", "dt", "td", "th", "tr", "tbody", "thead", "tfoot", "caption",
                      "option", "optgroup"}

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_COMMENT_END = re.compile(r"--!?>")
_QUOTE_OR_END = re.compile(r"[>'\"]")
_ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+)))?")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class _Ends:
    """Where a tag ends: the first ``>`` outside of quotes, found in time linear in the page for all its tags."""

    def __init__(self, page: str):
        self.page, self.last = page, page.rfind(">")
        self.at: list[int] | None = None

    def of(self, start: int) -> int:
        """The end of a tag whose attributes begin at ``start``, -1 if it has none."""
        if start > self.last:
            return -1
        if self.at is None:
            end = self.page.find(">", start)
            if self.page.find('"', start, end) < 0 and self.page.find("'", start, end) < 0:
                return end
            self._all()
        nth = bisect.bisect_left(self.at, start)
        return self.ends[nth]

    def _all(self) -> None:
        """From each quote or ``>`` on, outside of quotes, the next end: from the last backwards."""
        self.at = [found.start() for found in _QUOTE_OR_END.finditer(self.page)]
        self.ends = [-1] * (len(self.at) + 1)
        following: dict[str, int] = {}
        for nth in range(len(self.at) - 1, -1, -1):
            sign = self.page[self.at[nth]]
            if sign == ">":
                self.ends[nth] = self.at[nth]
            else:
                other = following.get(sign)
                self.ends[nth] = -1 if other is None else self.ends[other + 1]
                following[sign] = nth


def _tokens(page: str) -> Iterator[tuple[int, int, str, str, str]]:
    """Markup of a page: ``start, end, slash, tag, attributes``; without a tag for comments and the like.

    A ``<`` that begins nothing is text. Markup that the page's end cuts off is left out.
    """
    ends, last = _Ends(page), page.rfind("<")
    at = page.find("<")
    while at >= 0:
        sign, found, end = page[at + 1 : at + 2], None, -1
        if page.startswith("<!--", at):
            closed = _COMMENT_END.search(page, at + 4)
            end = closed.end() if closed else len(page)
        elif page.startswith("<![CDATA[", at):
            end = page.find("]]>", at) + 3
            end = end if end > 2 else len(page)
        elif sign in ("!", "?"):
            end = page.find(">", at) + 1 or len(page)
        elif at < ends.last and (sign == "/" or sign.isascii() and sign.isalpha()):
            found = _TAG.match(page, at)
            end = ends.of(found.end()) + 1 if found else 0
            if not end and sign == "/":
                found, end = None, page.find(">", at) + 1
        if end <= 0 and at == last and sign and (sign in "/!?" or sign.isascii() and sign.isalpha()) and at > ends.last:
            end = len(page)
        if end > 0:
            if found:
                yield at, end, found[1], found[2].lower(), page[found.end() : end - 1]
            else:
                yield at, end, "", "", ""
        else:
            end = at + 1
        at = page.find("<", end)


@dataclass(eq=False)
class Node:
    tag: str
    noise: bool = False
    named: bool = False  # noise by its class or id alone
    header: bool = False
    children: list[Node | str] = field(default_factory=list)


def _judge(node: Node, attributes: str) -> bool:
    """Mark what tag and attributes say of an element; whether a ``main`` inside would prove its name wrong."""
    node.noise = node.tag in _NOISE
    node.header = node.tag == "header"
    if node.noise or not attributes.strip():
        return False
    found: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(attributes):
        found.setdefault(name.lower(), html.unescape("".join(values)))
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or _HIDDEN.search(found.get("style", "")):
        node.noise = True
    elif found.get("role", "").lower() in _NOISE_ROLES:
        node.noise = True
    elif node.tag not in ("html", "body", "main"):
        names = f"{found.get('class', '')} {found.get('id', '')}".split()
        words = {part.lower() for name in names if not name.startswith(_LAYOUT) for part in _NAME.findall(name)}
        node.header |= bool(words & _HEADER_NAMES)
        node.noise = node.named = bool(words & _NOISE_NAMES)
        return node.noise or node.header
    return False


def parse(page: str) -> Node:
    """The tree of a page's blocks and noise, with the end tags that HTML lets an author leave out supplied.

    Formatting inside a line has no element of its own.
    """
    root = Node("#root")
    stack = [root]
    by_name: set[Node] = set()
    at = 0
    for start, end, closing, tag, attributes in _tokens(page):
        if start < at:
            continue  # inside a script or the like
        if start > at:
            stack[-1].children.append(page[at:start])
        at = end
        if not tag:
            continue
        if closing:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    del stack[depth:]
                    break
                if stack[depth].tag in _MAIN and tag not in ("body", "html", *_MAIN):
                    break  # a stray end tag closes nothing beyond the article that it stands in
            continue
        if tag in _CLOSES_P:
            _close(stack, ("p",), ("table", "td", "th", "button", *_MAIN))
        elif tag in _CLOSES:
            _close(stack, *_CLOSES[tag])
        node = Node(tag)
        if _judge(node, attributes):
            by_name.add(node)
        if tag == "main":
            for outer in stack:
                if outer in by_name:
                    outer.noise = outer.named = outer.header = False
        if tag in _RAW:
            closed = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = closed.end() if closed else len(page)
        if tag in _BLOCK or node.noise:
            stack[-1].children.append(node)
            deep = len(stack) > _DEPTH and not (node.noise and not any(outer.noise for outer in stack))
            if tag not in _VOID and tag not in _RAW and not deep:
                stack.append(node)
    if at < len(page):
        stack[-1].children.append(page[at:])
    _weigh(root)
    return root


def _weigh(root: Node) -> None:
    """Clear the noise of elements whose name alone says so although they hold most of the page's text."""
    mass: dict[Node, int] = {}

    def of(node: Node) -> int:
        own = 0
        if not node.noise or node.named:
            for child in node.children:
                own += len(child) - child.count(" ") if isinstance(child, str) else of(child)
        mass[node] = own
        return own

    total = of(root)
    for node, own in mass.items():
        if node.named and own > OWN_SHARE * total:
            node.noise = node.named = False


def _close(stack: list[Node], tags: tuple[str, ...], within: tuple[str, ...]) -> None:
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth].tag in within:
            return
        if stack[depth].tag in tags:
            del stack[depth:]
            if "tr" not in tags:
                return


def _hash(parts: list) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest("\x1f".join(parts)) - (1 << 63)


def subtrees(page: str) -> tuple[list[int], int]:
    """Hashes of the element subtrees that may be deleted, and one of the page's main part, to tell pages apart."""
    root = parse(page)
    out: list[int] = []
    main: list[str] = []

    def walk(node: Node, in_main: bool) -> tuple[str, bool]:
        parts, some = [node.tag], False
        inside = in_main or node.tag in _MAIN
        for child in node.children:
            if isinstance(child, str):
                text = " ".join(html.unescape(child).split())
                if text:
                    parts.append(text)
                    some = True
                    if inside:
                        main.append(text)
            else:
                below, has = walk(child, inside)
                parts.append(below)
                some |= has
        key = _hash(parts)
        if some and not node.noise and _removable(node, in_main):
            out.append(key)
        return str(key), some

    walk(root, False)
    whole = _hash(main) if main else _hash([page])
    return sorted(set(out)), whole


def _removable(node: Node, in_main: bool) -> bool:
    if node.tag in ("#root", "html", "body", *_MAIN):
        return False
    return node.tag in _BLOCK and not (in_main and node.tag in _PROSE)


def main_text(page: str, removed: frozenset[int] = frozenset()) -> str:
    """The page's main text without noise and without the subtrees whose hashes are given."""
    root = parse(page)
    keys: dict[int, int] = {}

    def key_of(node: Node) -> str:
        parts = [node.tag]
        for child in node.children:
            if isinstance(child, str):
                text = " ".join(html.unescape(child).split())
                if text:
                    parts.append(text)
            else:
                parts.append(key_of(child))
        keys[id(node)] = _hash(parts)
        return str(keys[id(node)])

    if removed:
        key_of(root)

    def kept(node: Node, in_main: bool) -> bool:
        return not node.noise and not (removed and _removable(node, in_main) and keys[id(node)] in removed)

    def mains(node: Node) -> Iterator[Node]:
        for child in node.children:
            if isinstance(child, Node) and kept(child, False):
                if child.tag in _MAIN:
                    inner = list(mains(child)) if child.tag == "main" else []
                    yield from inner or [child]
                else:
                    yield from mains(child)

    blocks: list[str] = []
    held: list[str] = []

    def flush() -> None:
        text = " ".join(html.unescape("".join(held)).split())
        held.clear()
        if text:
            blocks.append(text)

    def write(node: Node, in_main: bool) -> None:
        for child in node.children:
            if isinstance(child, str):
                held.append(child)
                continue
            if not kept(child, in_main) or (child.header and not in_main):
                if child.tag in _BLOCK or child.tag in _NOISE:
                    flush()
                continue
            if child.tag in _BLOCK:
                flush()
                write(child, in_main or child.tag in _MAIN)
                flush()
            else:
                write(child, in_main)

    def prose(node: Node, inside: bool, outer: bool) -> int:
        """Characters of kept paragraphs below; ``outer`` counts those outside of the main parts only."""
        own = 0
        for child in node.children:
            if isinstance(child, str):
                own += len(child) if inside else 0
            elif kept(child, False) and not child.header and not (outer and child.tag in _MAIN):
                own += prose(child, inside or child.tag == "p", outer)
        return own

    found = list(mains(root))
    if found and prose(root, False, True) > OUTWEIGH * sum(prose(part, True, False) for part in found):
        found = []  # teasers beside the text
    for part in found or [root]:
        write(part, bool(found))
        flush()
    return " ".join(blocks)


def host_of(url: Column) -> Column:
    """Host name of a URL in lower case; the whole text if it has none, null stays null."""
    host = F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.when(host == "", url).otherwise(host)


def _subtree_batches(batches):
    for batch in batches:
        found = [subtrees(page or "") for page in batch["html"]]
        yield pd.DataFrame(
            {
                "host": batch["host"],
                "digest": batch["digest"],
                "main": [main for _, main in found],
                "keys": [keys for keys, _ in found],
            }
        )


def site_templates(seen: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """Subtrees of the site: ``host, key, n_pages``, from rows ``host, main, keys`` of the parsed pages.

    Pages with the same main part count once, so that copies of one page make no template of its text. Both counts are
    grouped aggregation, over (host, key) and over hosts, combined before their shuffles.
    """
    posts = seen.select("host", "main", F.explode("keys").alias("key")).distinct()
    counted = posts.groupBy("host", "key").agg(F.count("*").alias("n_pages")).where(F.col("n_pages") >= min_pages)
    sizes = seen.select(F.col("host").alias("_host"), "main").distinct().groupBy("_host").agg(F.count("*").alias("size"))
    many = counted.join(sizes, F.col("host").eqNullSafe(F.col("_host")))
    return many.where(F.col("n_pages") >= min_share * F.col("size")).select("host", "key", "n_pages")


def _texts(rows: pd.DataFrame) -> pd.Series:
    return pd.Series(
        [
            main_text(page or "", frozenset() if keys is None else frozenset(int(k) for k in keys))
            for page, keys in zip(rows["html"], rows["keys"])
        ]
    )


def extract(
    pages: DataFrame, url: str = "url", page: str = "html", min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE
) -> DataFrame:
    """The rows with ``main_text``, the text that is the page's own; a column of that name is replaced.

    Null and empty pages have an empty text. A null URL is a host of its own. Repeated rows, other columns and pages
    of any length are kept. Unclosed or cut markup is read as far as it goes.
    """
    marked = pages.select(
        whole(pages, "main_text"),
        column(page).alias("html"),
        host_of(column(url)).alias("_host"),
        F.xxhash64(F.coalesce(column(page), F.lit(""))).alias("_digest"),
    )
    rows = marked.select(F.col("_host").alias("host"), "html", F.col("_digest").alias("digest"))
    seen = cut(rows.mapInPandas(_subtree_batches, "host string, digest bigint, main bigint, keys array<bigint>"))
    templates = site_templates(seen, min_pages, min_share).select(F.col("host").alias("_site"), F.col("key").alias("_key"))
    own = seen.select("host", "digest", F.explode("keys").alias("key")).distinct()
    theirs = own.join(templates, (F.col("key") == F.col("_key")) & F.col("host").eqNullSafe(F.col("_site")))
    removed = cut(
        theirs.groupBy(F.col("host").alias("_r_host"), F.col("digest").alias("_r_digest")).agg(
            F.collect_set("key").alias("keys")
        )
    )
    size = removed.agg(F.coalesce(F.sum(F.size("keys") + 1), F.lit(0))).first()[0]
    same = F.col("_host").eqNullSafe(F.col("_r_host")) & (F.col("_digest") == F.col("_r_digest"))
    text = pandas_udf(_texts, "string")(F.struct("html", "keys"))
    removed = sized_broadcast(removed, size, BROADCAST_BOUND)
    return marked.join(removed, same, "left").select("row.*", text.alias("main_text"))
