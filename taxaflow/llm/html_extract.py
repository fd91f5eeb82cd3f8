"""HTML extraction by consensus host paths."""

from __future__ import annotations

import re
from hashlib import md5
from html import unescape

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_columns, materialize, tidy

NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
#: What stands between a tag's name and its end: ``>`` in quotes doesn't end it.
REST = re.compile(r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>")
SPECIAL = re.compile("[>\"']")
COMMENT_END = re.compile("--!?>")
#: Numeric references: zeros before the number, and numbers beyond all code points (Python refuses very long ones).
ZEROS, BEYOND = re.compile(r"&#([xX]?)0+(?=[0-9a-fA-F])"), re.compile(r"&#(?:[1-9][0-9]{7,}|[xX][1-9a-fA-F][0-9a-fA-F]{6,});?")
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Form controls, and what browsers don't show: their text is never part of an article. A dialog is shown if it is open.
NEVER = {"head", "select", "option", "datalist", "label", "canvas", "audio", "video", "annotation", "annotation-xml", "desc", "metadata"}
BOILERPLATE = {"nav", "header", "footer", "aside", "form", "menu"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer",
    "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary",
    "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
CONTAINERS = {"article", "body", "center", "div", "main", "section", "td"}
WEIGHT = {"article": 1.5, "main": 1.3, "body": 0.8}
#: Characters from which a container beside the best one counts as a part of the article; headings always do.
PART = 10
#: The host's other pages can speak against text of a page only if this share of it is under a winning path.
AT_LEAST = 0.1
#: Block containers, which words in class, id or role can mark; text, headings, tables, cells and inline elements they can't.
MARKABLE = {
    "address", "aside", "blockquote", "center", "details", "dialog", "div", "dl", "fieldset", "figure", "footer", "form", "header", "hgroup", "li", "menu", "nav", "ol",
    "section", "ul",
}
#: Words in class, id or role that mark what isn't the article.
MARKED = {
    "ad", "ads", "adv", "advert", "advertisement", "adverts", "advertising", "alert", "announcement", "aside", "banner", "breadcrumb", "breadcrumbs", "comment", "comments",
    "complementary", "consent", "contentinfo", "cookie", "cookies", "copyright", "disqus", "footer", "form", "gdpr", "header", "login", "masthead", "menu", "modal", "nav",
    "navbar", "navigation", "newsletter", "notice", "notification", "overlay", "pager", "pagination", "popup", "promo", "promoted", "promotion", "recommended",
    "related", "replies", "respond", "search", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
}
#: Words that say where or what kind of part an element is. A name marks if all of its words are among these and marked ones: so
#: ``related-posts`` and ``footer-links`` do, but ``related-work`` and ``copyright-law``, which are about something, don't.
PLAIN = {
    "area", "article", "articles", "author", "bar", "block", "blog", "body", "bottom", "box", "button", "buttons", "col", "column", "component", "container", "content", "count",
    "desktop", "entry", "feed", "first", "fixed", "follow", "global", "google", "group", "heading", "holder", "icon", "icons", "inner", "input", "item", "items", "last", "layout", "leaderboard", "left",
    "link", "links", "list", "local", "main", "media", "message", "mini", "mobile", "module", "more", "news", "of", "on", "outer", "page", "pages", "panel", "policy", "post", "posts", "primary", "reader", "readers",
    "region", "reply", "right", "row", "secondary", "section", "site", "skyscraper", "slot", "small", "sponsors", "sticky", "stories", "story", "sub", "text", "the", "thread", "title", "to", "toggle", "top", "unit", "us",
    "user", "view", "wrap", "wrapper", "you", "zone",
}
#: Names that mark inline elements.
INLINE_ADS = {"ad", "ads", "advert", "advertisement", "sponsored"}
#: Of these, ones that a page may wrap round its whole content.
WRAPPING = {"form", "header", "modal", "overlay", "search", "widget", "login", "banner"}
#: Elements whose start ends an open element of the first set, unless one of the second set is nearer.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "option": ({"option"}, {"select"}),
    "body": ({"head"}, set()),
}
NOT_IN_P = BLOCKS - {"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "html", "body", "head"}


#: Characters of a path from which it goes on from a digest of itself, so that deep elements don't have long ones.
LONG_PATH = 400


class TagEnds:
    """Where tags end, in time that grows with the page only, whatever quotes are left open in it."""

    def __init__(self, html: str):
        self.html, self.last, self.known = html, html.rfind(">"), None

    def __call__(self, at: int) -> int:
        """The first ``>`` from ``at`` that isn't in quotes; the first one of all if quotes hide the rest (there is one)."""
        if self.known is None:
            found = REST.match(self.html, at)
            if found:
                return found.end() - 1
            self._learn()
        first = SPECIAL.search(self.html, at)
        end = -1 if first is None else self.known[first.start()]
        return end if end >= 0 else self.html.find(">", at)

    def _learn(self) -> None:
        """For each quote and ``>``: where a tag ends that has it outside of quotes (-1: nowhere)."""
        places = [m.start() for m in SPECIAL.finditer(self.html)]
        after = dict(zip(places, places[1:]))
        closing, self.known = {"'": -1, '"': -1}, {}
        for i in reversed(places):
            c = self.html[i]
            if c == ">":
                self.known[i] = i
            else:
                end = closing[c]
                self.known[i] = self.known[after[end]] if end >= 0 and end in after else -1
                closing[c] = i


class Page:
    """Elements as lists (tag, path, parent, mark, nearest block and container), parents first, and blocks (element, text,
    characters inside links) in page order. All work on a page is one pass over it or over its elements."""

    def __init__(self, html: str):
        self.tag, self.path, self.parent, self.mark, self.block, self.holder = [""], [""], [-1], [""], [0], [0]
        self.blocks: list[tuple[int, str, int]] = []
        self._stack, self._text, self._linked, self._links, self._hidden = [0], [], 0, 0, 0
        self._places: dict[str, list[int]] = {}  # of each open tag in the stack
        ends, at, done, lower = TagEnds(html), 0, 0, None
        while (lt := html.find("<", at)) >= 0:
            after = html[lt + 1 : lt + 2]
            if after in ("!", "?"):
                self._add(html[done:lt])
                at = done = self._skip(html, lt)
                continue
            m = NAME.match(html, lt) if lt < ends.last else None
            if m is None:
                at = lt + 1
                continue
            self._add(html[done:lt])
            tag, end = m[2].lower(), ends(m.end())
            at = done = end + 1
            if m[1]:
                self._close(tag)
            elif tag in RAW:
                lower = html.lower() if lower is None else lower
                if len(lower) != len(html):  # lower case may change lengths outside ASCII
                    found = re.compile(rf"</{re.escape(tag)}", re.I).search(html, at)
                    at = found.start() if found else len(html)
                else:
                    found = lower.find(f"</{tag}", at)
                    at = found if found >= 0 else len(html)
                if at < len(html) and (close := html.find(">", at)) >= 0:
                    at = close + 1
                done = at
            else:
                self._open(tag, html[m.end() : end])
        self._add(html[done:])
        self._flush()
        self.clear: list[bool] = []

    def _skip(self, html: str, at: int) -> int:
        """The end of a comment, declaration or CDATA section (whose content is text)."""
        if html.startswith("<!--", at):
            if html.startswith((">", "->"), at + 4):
                return html.index(">", at) + 1
            found = COMMENT_END.search(html, at + 4)
            return found.end() if found else len(html)
        if html.startswith("<![CDATA[", at):
            end = html.find("]]>", at)
            self._add(html[at + 9 : end if end >= 0 else len(html)])
            return end + 3 if end >= 0 else len(html)
        end = html.find(">", at)
        return end + 1 if end >= 0 else len(html)

    def _add(self, raw: str) -> None:
        if self._hidden or not raw:
            return
        self._text.append(raw)
        if self._links:
            self._linked += len(raw)

    def _flush(self) -> None:
        if self._text:
            text = " ".join(decoded("".join(self._text)).split())
            if text:
                self.blocks.append((self.block[self._stack[-1]], text, min(self._linked, len(text))))
            self._text, self._linked = [], 0

    def _open(self, tag: str, rest: str) -> None:
        if tag in ("br", "wbr", "img", "input"):
            if tag != "wbr":
                self._text.append(" ")
            return
        if tag in BLOCKS:
            self._flush()
        if tag in VOID:
            return
        if tag in NOT_IN_P:
            self._end({"p"}, {"td", "th", "table", "button", "object"})
        if tag in HEADINGS:
            self._end(HEADINGS, BLOCKS - HEADINGS)
        if tag in CLOSES:
            self._end(*CLOSES[tag])
        names, mark = "", "never" if tag in NEVER or tag == "dialog" else tag if tag in BOILERPLATE else ""
        if rest.strip(" \t\r\n/"):
            found = {}
            for a in ATTRIBUTE.finditer(rest):
                found.setdefault(a[1].lower(), a[2] or a[3] or a[4] or "")
            names = found.get("class", "")
            if tag == "dialog" and "open" in found:
                mark = ""
            if not mark and ("hidden" in found or re.search(r"display\s*:\s*none", found.get("style", ""))):
                mark = "never"
            if not mark and tag in MARKABLE:
                mark = marked(f"{names} {found.get('id', '')} {found.get('role', '')}")
            if not mark and tag in ("span", "ins", "a") and not INLINE_ADS.isdisjoint(names.lower().split()):
                mark = "never"
        up = self._stack[-1]
        names = ".".join(sorted({re.sub(r"\d+", "#", x.lower()) for x in names.split()}))
        path, e = f"{self.path[up]}/{tag}{'.' + names if names else ''}", len(self.tag)
        self._places.setdefault(tag, []).append(len(self._stack))
        self._stack.append(e)
        self.tag.append(tag)
        self.path.append(path if len(path) <= LONG_PATH else "#" + md5(path.encode("utf-8", "surrogatepass")).hexdigest())
        self.parent.append(up)
        self.mark.append(mark)
        self.block.append(e if tag in BLOCKS else self.block[up])
        self.holder.append(e if tag in CONTAINERS else self.holder[up])
        if tag == "a":
            self._links += 1
        if mark == "never":
            self._hidden += 1
        if rest.endswith("/") and tag not in BLOCKS:
            self._close(tag)

    def _end(self, tags: set[str], until: set[str]) -> None:
        i = max((self._places[t][-1] for t in tags if self._places.get(t)), default=0)
        if i and all(not self._places.get(t) or self._places[t][-1] < i for t in until):
            self._pop(i)

    def _close(self, tag: str) -> None:
        if tag in BLOCKS or tag == "br":
            self._flush()
        if self._places.get(tag):
            self._pop(self._places[tag][-1])

    def _pop(self, i: int) -> None:
        gone = self._stack[i:]
        if any(self.tag[e] in BLOCKS for e in gone):
            self._flush()
        for e in gone:
            self._places[self.tag[e]].pop()
            self._links -= self.tag[e] == "a"
            self._hidden -= self.mark[e] == "never"
        del self._stack[i:]

    def settle(self) -> None:
        """Lifts marks of elements that wrap round more than 60 % of the page's text; then says which elements are clear
        of marks, their own and those of what is round them."""
        size = [0] * len(self.tag)
        for e, text, _ in self.blocks:
            size[e] += len(text)
        for e in range(len(self.tag) - 1, 0, -1):
            size[self.parent[e]] += size[e]
        for e, mark in enumerate(self.mark):
            if mark in WRAPPING and size[e] > 0.6 * size[0]:
                self.mark[e] = ""
        self.clear = [True]
        for e in range(1, len(self.tag)):
            self.clear.append(self.clear[self.parent[e]] and not self.mark[e])

    def container(self) -> tuple[str, float]:
        """The path and score of the page's container: text outside links goes to the nearest container in full and to
        those above by halves, and from the best one it is climbed to where the whole article is."""
        score: dict[int, float] = {}
        own: dict[int, float] = {}  # by nearest container, what it holds itself
        for e, text, linked in self.blocks:
            if self.clear[e]:
                part, at = float(len(text) - linked), self.holder[e]
                if 2 * linked <= len(text):
                    own[at] = own.get(at, 0.0) + (PART if self.tag[e] in HEADINGS else part)
                score[at] = score.get(at, 0.0) + part
        for c in range(len(self.tag) - 1, 0, -1):
            if c in score and (up := self.holder[self.parent[c]]) > 0:
                score[up] = score.get(up, 0.0) + score[c] / 2
        score = {c: x * WEIGHT.get(self.tag[c], 1.0) for c, x in score.items()}
        best = max(score, key=lambda c: (score[c], -c), default=-1)
        if best < 0 or score[best] <= 0:
            return "", 0.0
        top = self._whole(best, own)
        return self.path[top], score.get(top, score[best])

    def holders(self, path: str) -> dict[str, bool]:
        """Paths of the nearest containers of unmarked text outside links, and whether they stand under ``path``."""
        found = self._finder(path)
        out: dict[str, bool] = {}
        for e, _ in self._free():
            q = self.path[self.holder[e]]
            out[q] = out.get(q, False) or found[e] is True
        return out

    def _free(self) -> list[tuple[int, int]]:
        """Elements of blocks that aren't in marked parts, and the characters of each outside links."""
        return [(e, len(t) - linked) for e, t, linked in self.blocks if len(t) > linked and self.clear[e]]

    def choose(self, paths: list[str], outside: list[str]) -> str | None:
        """The text of this page, given its host's winning paths and the holders that the host's pages leave outside."""
        own = self.container()[0]
        mine = self._finder(own)
        outside, known = set(outside), set(self.path)
        free = [(e, n, self.path[self.holder[e]] in outside) for e, n in self._free() if mine[e]]
        total, sure = sum(n for _, n, _ in free), sum(n for _, n, out in free if not out)
        best, covers = None, (0, 0)
        for path in paths:
            if path in known:
                found = self._finder(path)
                got = sum(n for e, n, out in free if not out and found[e]), sum(n for e, n, _ in free if found[e])
                if got[0] > covers[0]:
                    best, covers = path, got
        if best is not None and covers[1] >= AT_LEAST * total:
            if covers[0] >= sure:
                return self.text(best)
            return self.text(own, outside)
        return self.text(own)

    def _around(self, nodes: set[int]) -> int:
        """The lowest element round all of these, or the one of them that is round the others."""
        held = [0] * len(self.tag)
        for e in nodes:
            held[e] += 1
        for e in range(len(self.tag) - 1, 0, -1):
            if held[e] == len(nodes):  # parents come first, so this is the lowest
                return e
            held[self.parent[e]] += held[e]
        return 0

    def _whole(self, best: int, own: dict[int, float]) -> int:
        """The lowest container round all parts of the article that the best container belongs to.

        Parts are the outermost article and main elements if the best container is in one, else all containers that hold
        unmarked text outside links; those with less than ``PART`` characters and no heading only if they stand round it.
        """
        parts = {c for c, n in own.items() if n >= PART} | {best}
        outer = [0] * len(self.tag)  # the outermost article or main element round each
        for e in range(1, len(self.tag)):
            outer[e] = outer[self.parent[e]] or (e if self.tag[e] in ("article", "main") else 0)
        if outer[best]:
            parts = {outer[c] for c in parts if outer[c]}
        else:
            e = best
            while e > 0:
                e = self.parent[e]
                if e in own:
                    parts.add(e)
        return self.holder[self._around(parts)]

    def _finder(self, path: str) -> list[bool | None]:
        """Whether each element is under one of that path: None if in a marked part of it."""
        titled = any(self.tag[e] == "h1" and self.clear[e] for e, _, _ in self.blocks)
        inside: list[bool | None] = [path == ""]
        mark = [0]  # the nearest marked element at or round each
        for e in range(1, len(self.tag)):
            up = self.parent[e]
            mark.append(e if self.mark[e] else mark[up])
            now = True if self.path[e] == path else None if inside[up] and self.mark[e] else inside[up]
            if now is None and self.tag[e] in HEADINGS and not self.mark[e]:
                # A header straight in the body is the site's if the page has another title.
                h = mark[e]
                if self.mark[h] == "header" and (not titled or self.tag[self.parent[h]] not in ("", "html", "body")) and inside[self.parent[h]]:
                    now = True
            inside.append(now)
        return inside

    def text(self, path: str, outside: list[str] | set | tuple = ()) -> str | None:
        """Text of the blocks under elements of that path, without marked parts and what those holders hold; null if the
        page has none."""
        if path not in self.path:
            return None
        found, outside = self._finder(path), set(outside)
        return "\n\n".join(t for e, t, _ in self.blocks if found[e] and self.path[self.holder[e]] not in outside)


def decoded(raw: str) -> str:
    """Text with its character references decoded, of any length."""
    if "&#" in raw:
        raw = BEYOND.sub("\ufffd", ZEROS.sub(r"&#\1", raw))
    return unescape(raw)


def marked(names: str) -> str:
    """The first marked word of a name that says nothing but that, or an empty string."""
    for name in names.split():
        words = [w for w in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower()) if w]
        found = [w for i, w in enumerate(words) if w in MARKED and not (i and words[i - 1] in ("with", "has", "no", "without"))]
        if found and all(w in MARKED or w in PLAIN or len(w) == 1 for w in words):
            return found[0]
    return ""


def parse(html: str | None) -> Page:
    page = Page(html or "")
    page.settle()
    return page


def vote(html: str | None) -> tuple[str, float]:
    return parse(html).container()


def votes(html: str | None) -> list[tuple[str, float, int, int, int]]:
    """(path, score, vote, held, inside): the page's vote, and its holders of text with 1 if they are in its container."""
    page = parse(html)
    path, score = page.container()
    if score <= 0:
        return []
    return [(path, score, 1, 0, 0), *((q, 0.0, 0, 1, int(ok)) for q, ok in page.holders(path).items())]


def extract(html: str | None, paths: list[str] | None, outside: list[str] | None = None) -> str:
    """The text under that one of the host's winning paths that covers most of the page's own container, if it covers all
    of it but what stands in containers ``outside`` the host's articles; else what is in its own container but not in
    those. If no winning path covers a tenth of it, they aren't heard and all of its own container is taken."""
    page = parse(html)
    return (page.choose(paths or [], outside or []) if paths else page.text(page.container()[0])) or ""


def host_paths(pages: DataFrame, *, host: str, html: str, least: float = 0.1) -> DataFrame:
    """(host, paths, outside): each host's winning container paths, best first, and paths whose text isn't the article's.

    Every page votes once, for the generalised path (tags and classes, numbers as #) of its container. Paths with the
    votes of at least ``least`` of the host's pages, and of two, win, so they are few for each host (ties: the higher score, then the path);
    pages of a host without any keep their own container. Outside are the nearest containers of text that stand on so many
    pages, and in the voted container on some but less than half of them.
    """
    cast = "votes array<struct<path:string,score:double,vote:int,held:int,inside:int>>"
    said = map_columns(pages, [host], [html], cast, lambda h: [[[dict(zip(("path", "score", "vote", "held", "inside"), v)) for v in votes(x)] for x in h]])
    said = said.select(host, F.inline("votes"))
    sums = [F.sum("vote").alias("n"), F.sum(F.round("score", 3)).alias("score"), F.sum("held").alias("held"), F.sum("inside").alias("inside")]
    said = materialize(said.groupBy(host, "path").agg(*sums), "host-votes")
    counts = said.groupBy(host).agg((F.sum("n") * least).alias("few"))
    often = said.where("n >= 2 or held > 2 * inside and inside > 0").join(counts, host)
    won = F.when((F.col("n") >= 2) & (F.col("n") >= F.col("few")), F.struct((-F.col("n")).alias("n"), (-F.col("score")).alias("score"), "path"))
    out = F.when((F.col("inside") > 0) & (F.col("held") > 2 * F.col("inside")) & (F.col("held") >= F.col("few")), F.col("path"))
    hosts = often.groupBy(host).agg(F.sort_array(F.collect_list(won)).alias("r"), F.sort_array(F.collect_list(out)).alias("outside"))
    return hosts.select(host, F.transform("r", lambda x: x.path).alias("paths"), "outside")


def extract_pages(pages: DataFrame, *, url: str = "url", html: str = "html", least: float = 0.1) -> DataFrame:
    """The pages with the main text of their html in ``text`` and its length in ``n_chars`` (code points).

    Pages are read twice: once for their vote, once, beside their host's winning paths, for the text. Menus, headers (but
    headings in an article's own), footers, sidebars, notices, adverts, forms, scripts, styles, hidden parts and reader
    comments go; references are decoded, white space in a block becomes one blank, blocks are joined by two line ends.

    The host is what stands between ``://`` and the next ``/ ? #``; null urls form one host. Null and empty html give an
    empty text, broken html is closed as browsers would, long and deep pages are read whole, in time that grows with
    their size. Repeated rows are pages of their
    own; an empty table gives an empty result; other columns stay, ones named text or n_chars are replaced.
    """
    pages = tidy(pages, [url, html], ["text", "n_chars", "_host", "_paths", "_outside"])
    pages = pages.withColumn("_host", F.coalesce(F.lower(F.regexp_extract(url, r"://([^/?#]*)", 1)), F.lit("")))
    paths = materialize(host_paths(pages, host="_host", html=html, least=least), "host-paths").withColumnsRenamed({"paths": "_paths", "outside": "_outside"})
    both = pages.join(paths, "_host", "left")

    def texts(htmls, paths, outside):
        got = [extract(*x) for x in zip(htmls, paths, outside)]
        return got, list(map(len, got))

    return map_columns(both, pages.drop("_host").columns, [html, "_paths", "_outside"], "text string, n_chars long", texts)
