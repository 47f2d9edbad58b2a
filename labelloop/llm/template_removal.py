"""Main text of pages by removing site templates.

Every page is parsed into a tree of elements once.  Each element has a
hash of its whole subtree (names, marks, text); Spark counts, per host, in how
many different surroundings a subtree recurs, and subtrees recurring across
many pages of their host are deleted.  An article that is served under several
urls recurs together with its surroundings and so counts once.  Where a page
marks its article, a paragraph or heading in it may be a passage quoted in many
articles: it is template only with a neighbour, where both recur side by side at
the same place of the tree, counted from the nearer end of their parent.  Besides, elements whose name, role or class says that they are no
main text (navigation, notices, adverts, forms, scripts, comments) are deleted
on any page, because a page alone on its host has nothing to recur with.

Texts are parsed once and stored as blocks; only (host, subtree) counts and the
few pages with a recurring subtree meet in a shuffle.  Hot hosts are counted by
(host, subtree), combined before the shuffle.

Defined cases: null or empty html gives empty text; html without an article or
main element is read from its body; unclosed elements end with their parent or
where html says they do; a null url belongs to the host ''; repeated pages give
equal results; only id, url and html are read.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloop.llm.common import stored
from labelloop.llm.link_trust import host_of

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*?)/?>""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/>"']++)\s*+(?:=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?""")
MARKS = frozenset("class id role hidden aria-hidden".split())

# How html's own elements behave.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol p pre search section summary table tbody td tfoot th thead "
    "title tr ul".split()) - {"br"}
ENDS_P = BLOCK - frozenset("body caption head html li dd dt tbody td tfoot th thead title tr".split())
#: An opening element closes open elements of these names, up to the nearest of the scope.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"}),
}
SCOPE = frozenset("article aside body div fieldset figure footer form header html main nav section table td th".split())

#: Names and marks of elements that are no main text.
CHROME = frozenset("nav header footer aside form script style noscript template iframe object embed svg canvas audio video "
                   "button select textarea input label fieldset menu dialog head title search map".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar "
                  "status tablist tooltip".split())
WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored sponsors promo promotion promoted cookie "
    "cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login paywall nav "
    "navbar navigation menu submenu breadcrumb breadcrumbs pagination pager toolbar topbar sidebar widget widgets related "
    "recommended recommendations trending popular share sharing social comment comments commentlist cmt cmts disqus respond reply replies "
    "footer masthead skip disclaimer".split())
#: Parts that say where or what kind of box an element is; beside them a word of ``WORDS`` is still about the box.
NEUTRAL = frozenset(
    "site page main top bottom left right center inner outer upper lower box list item items bar block section wrapper wrap "
    "container area panel link links text title heading unit slot small large primary secondary global mobile desktop col row "
    "js el c u module component group holder content".split())
KEEPS = frozenset("article main body html".split())
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li td th tr tbody thead dd dt b i em strong a span blockquote pre figcaption code".split())


class Element:
    __slots__ = ("name", "marks", "children", "parent", "digest")

    def __init__(self, name: str, marks: str, parent):
        self.name, self.marks, self.parent, self.children, self.digest = name, marks, parent, [], b""


def parse(html: str) -> Element:
    """Tree of a page; children are elements and decoded texts."""
    root = here = Element("", "", None)
    at, end = 0, len(html)
    while at < end:
        m = TAG.search(html, at)
        if m is None:
            here.children.append(entities.unescape(html[at:]))
            break
        if m.start() > at:
            here.children.append(entities.unescape(html[at:m.start()]))
        at, name = m.end(), (m[2] or "").lower()
        if not name:
            if m[0].startswith("<![CDATA["):
                here.children.append(m[0][9:].removesuffix("]]>"))
            continue
        if m[1]:
            node = here
            while node is not None and node.name != name and not (name not in SCOPE and node.name in SCOPE):
                node = node.parent
            if node is not None and node.name == name:
                here = node.parent
            continue
        if name in ENDS_P:
            here = _close(here, {"p"}, SCOPE)
        if name in CLOSES:
            here = _close(here, *CLOSES[name])
        new = Element(name, _marks(m[3]), here)
        here.children.append(new)
        if name in RAW:
            close = re.compile(rf"</{name}[\s/>]", re.I).search(html, at)
            stop = close.start() if close else end
            if name in ("textarea", "title"):
                new.children.append(entities.unescape(html[at:stop]))
            at = stop
            if close:
                at = html.find(">", stop) + 1 or end
        elif name not in VOID:
            here = new
    return root


def _close(here: Element, names, scope) -> Element:
    """Where parsing goes on once the outermost open element of ``names`` inside ``scope`` is closed."""
    node, out = here, here
    while node is not None and node.name not in scope:
        if node.name in names:
            out = node.parent
        node = node.parent
    return out


def _marks(attributes: str) -> str:
    """The attributes of ``MARKS``, as name=value parted by line breaks."""
    if not attributes or attributes.isspace():
        return ""
    found = ((k.lower(), v) for k, v in ATTRIBUTE.findall(attributes))
    return "\n".join(f"{k}={' '.join(v.strip('\"').strip(chr(39)).lower().split())}" for k, v in found if k in MARKS)


def _says_chrome(token: str) -> bool:
    """Whether a class or id names no main text: every part of it is a word of ``WORDS`` or neutral, and one is of ``WORDS``."""
    parts = [p for p in re.split(r"[^a-z]+", token) if p]
    return any(p in WORDS for p in parts) and all(p in WORDS or p in NEUTRAL for p in parts)


def is_chrome(node: Element) -> bool:
    """Whether the element's own name, role or class says that it is no main text."""
    if node.name in KEEPS and node.name != "article":
        return False
    if node.name in CHROME:
        # The heading of an article may stand in a header of its own.
        return not (node.name == "header" and _inside(node, ("article", "main")))
    if not node.marks:
        return False
    return any(_marked(mark) for mark in node.marks.split("\n"))


def _marked(mark: str) -> bool:
    key, _, value = mark.partition("=")
    if key in ("class", "id"):
        return any(map(_says_chrome, value.split(" ")))
    return key == "hidden" or key == "aria-hidden" and value == "true" or key == "role" and value in ROLES


def _inside(node: Element, names) -> bool:
    node = node.parent
    while node is not None:
        if node.name in names:
            return True
        node = node.parent
    return False


def _digests(root: Element) -> None:
    """Hash of every subtree: names, marks and text with white space evened out."""
    for node in reversed(list(_walk(root))):  # children before their parents
        h = hashlib.blake2b(f"{node.name} {node.marks}".encode("utf-8", "replace"), digest_size=8)
        for c in node.children:
            h.update(b"<" + c.digest if isinstance(c, Element) else " ".join(c.split()).encode("utf-8", "replace"))
        node.digest = h.digest()


def _number(digest: bytes) -> int:
    return int.from_bytes(digest, "big", signed=True)


def _runs(node: Element) -> tuple[dict[int, list[int]], list[tuple[int, int]]]:
    """Of neighbouring blocks in ``node``, the hashes of (path, place, both) by child, and all of them with their surroundings.

    The surroundings are the first block, or the last where the run has the first, so that near copies
    of an article count once; an article's title is never part of a run.
    """
    near, every = {}, []
    inside = [c for c in node.children if isinstance(c, Element) and c.name in BLOCK and c.children and not is_chrome(c)]
    names, up = [], node
    while up is not None:
        names.append(up.name)
        up = up.parent
    path = "/".join(names)
    for i, (a, b) in enumerate(zip(inside, inside[1:])):
        j = len(inside) - 2 - i
        if a.name not in LEAVES and b.name not in LEAVES or "h1" in (a.name, b.name):
            continue  # both are counted by themselves, or one is a title
        around = _number((inside[0] if i else inside[-1]).digest)
        for place in ([f"+{i}"] if i <= j else []) + ([f"-{j}"] if j <= i else []):
            key = _number(hashlib.blake2b(f"{path} {place} ".encode("utf-8", "replace") + a.digest + b.digest, digest_size=8).digest())
            every.append((key, around))
            for c in (a, b):
                near.setdefault(id(c), []).append(key)
    return near, every


def blocks(html: str) -> tuple[list[tuple[str, list[int]]], list[tuple[int, int]]]:
    """Blocks of text that no rule of ``is_chrome`` deletes, each with the subtrees it lies in;
    and all (subtree, surroundings) of the page that may be template."""
    root = parse(html)
    _digests(root)
    articles = [n for n in _walk(root) if n.name in ("article", "main") and not is_chrome(n)]
    # An article in a box that only its class or id says is no main text is better than none.
    wanted = [n for n in articles if not _in_chrome(n)] or [n for n in articles if not _inside(n, CHROME)]
    tops = [n for n in wanted if not _inside(n, ("article", "main"))] or \
        [n for n in _walk(root) if n.name == "body"][:1] or [root]
    found, out = [], []
    plain = not wanted  # no element is known to be the article: paragraphs may be template, too
    for top in tops:
        text: list[str] = []

        def flush(path):
            joined = " ".join("".join(text).split())
            text.clear()
            if joined:
                out.append((joined, list(path)))

        stack: list = [(top, 0, [])]
        runs: dict[int, list[int]] = {}
        while stack:
            node, i, path = stack.pop()
            if i == 0 and not plain:
                near, every = _runs(node)
                runs |= near
                found += every
            if i == len(node.children):
                if node.name in BLOCK:
                    flush(path)
                continue
            stack.append((node, i + 1, path))
            c = node.children[i]
            if isinstance(c, str):
                text.append(c)
            elif c.name == "br":
                text.append(" ")
            elif not is_chrome(c):
                if c.name in BLOCK:
                    flush(path)
                inner = path
                if (plain or c.name not in LEAVES) and c.name not in KEEPS and c.children:
                    found.append((_number(c.digest), _number(node.digest)))
                    inner = [*path, _number(c.digest)]
                if id(c) in runs:
                    inner = [*inner, *runs[id(c)]]
                stack.append((c, 0, inner))
        flush([])
    return out, found


def _walk(root: Element) -> Iterator[Element]:
    stack = [root]
    while stack:
        node = stack.pop()
        yield node
        stack += [c for c in reversed(node.children) if isinstance(c, Element)]


def _in_chrome(node: Element) -> bool:
    node = node.parent
    while node is not None:
        if is_chrome(node):
            return True
        node = node.parent
    return False


PARSED = "uid long, page_id long, url string, host string, texts array<string>, paths array<array<long>>, subtrees array<struct<h:long,around:long>>"


def parse_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``PARSED`` rows: every page's blocks and the subtrees that may be template."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            read = [blocks(h) for h in batch.pop("html")]
            batch["page_id"] = batch["page_id"].astype("Int64")
            yield batch.assign(texts=[[t for t, _ in b] for b, _ in read], paths=[[p for _, p in b] for b, _ in read],
                               subtrees=[[{"h": a, "around": c} for a, c in f] for _, f in read])

    rows = pages.select(
        F.xxhash64(id_col, url_col, html_col).alias("uid"), F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
        host_of(F.col(url_col)).alias("host"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    return rows.mapInPandas(run, PARSED)


def recurring(parsed: DataFrame, least_pages: int = 10, share: float = 0.1, enough: int = 50) -> DataFrame:
    """(host, h) of subtrees found in different surroundings on ``least_pages`` pages and ``share`` of the pages
    of their host; ``enough`` pages are enough on a host of any size."""
    seen = parsed.select("host", F.explode("subtrees").alias("s")).select("host", "s.h", "s.around").distinct()
    counts = seen.groupBy("host", "h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_pages)
    pages = parsed.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    return counts.join(pages, "host").where(F.col("n") >= F.least(F.col("pages") * share, F.lit(enough))).select("host", "h")


def main_text(pages: DataFrame, least_pages: int = 10, share: float = 0.1, id_col: str = "page_id", url_col: str = "url",
              html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    parsed = stored(parse_pages(pages, id_col, url_col, html_col), "page-blocks")
    template = recurring(parsed, least_pages, share)
    # Stored, so that its size is known when the join is planned: few pages hit are sent to the texts, not the texts to them.
    hit = stored(parsed.select("uid", "host", F.explode("subtrees.h").alias("h")).join(template, ["host", "h"])
           .groupBy("uid").agg(F.collect_set("h").alias("gone")), "pages-hit")  # at most a page's own subtrees
    kept = parsed.drop("subtrees", "host").join(hit, "uid", "left")
    stays = F.filter(F.arrays_zip(F.col("texts").alias("t"), F.col("paths").alias("p")),
                     lambda b: F.col("gone").isNull() | ~F.arrays_overlap(b["p"], F.col("gone")))
    text = F.array_join(F.transform(stays, lambda b: b["t"]), "\n\n")
    return kept.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.char_length("text").cast("long"))
