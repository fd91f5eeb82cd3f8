"""A plain extractor to hold the quick one against: it walks up and down the page for each question."""

import re
from html import unescape

from taxaflow.llm.html_extract import (
    AT_LEAST, ATTRIBUTE, BLOCKS, BOILERPLATE, CLOSES, CONTAINERS, HEADINGS, MARKABLE, NEVER, NOT_IN_P, PART, RAW, VOID, WEIGHT, WRAPPING, marked,
)

TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:-->|--!>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)  # fmt: skip


class PlainPage:
    """A page read by one pattern, every question answered by walking up from each element."""

    def __init__(self, html: str):
        self.tag, self.path, self.parent, self.mark = [""], [""], [-1], [""]
        self.blocks: list[tuple[int, str, int]] = []
        self._stack, self._text, self._linked, self._links, self._hidden = [0], [], 0, 0, 0
        at, lower = 0, None
        while (m := TOKEN.search(html, at)) is not None:
            if m.start() > at:
                self._add(html[at : m.start()])
            at = m.end()
            tag = (m[2] or m[5] or "").lower()
            if not tag:
                if html.startswith("<![CDATA[", m.start()):
                    self._add(html[m.start() + 9 : at - 3 * html.endswith("]]>", 0, at)])
                continue
            if m[1] or m[4]:
                self._close(tag)
                continue
            rest = m[3] if m[2] else m[6]
            if tag in RAW:
                lower = html.lower() if lower is None else lower
                if len(lower) != len(html):  # lower case may change lengths outside ASCII
                    end = re.compile(rf"</{tag}", re.I).search(html, at)
                    at = end.start() if end else len(html)
                else:
                    end = lower.find(f"</{tag}", at)
                    at = end if end >= 0 else len(html)
                if (close := html.find(">", at)) >= 0 and at < len(html):
                    at = close + 1
                continue
            self._open(tag, rest)
        self._add(html[at:])
        self._flush()

    def _add(self, raw: str) -> None:
        if self._hidden:
            return
        self._text.append(raw)
        if self._links:
            self._linked += len(raw)

    def _flush(self) -> None:
        if self._text:
            text = " ".join(unescape("".join(self._text)).split())
            if text:
                at = next(e for e in reversed(self._stack) if self.tag[e] in BLOCKS or e == 0)
                self.blocks.append((at, text, min(self._linked, len(text))))
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
        up = self._stack[-1]
        names = ".".join(sorted({re.sub(r"\d+", "#", x.lower()) for x in names.split()}))
        self._stack.append(len(self.tag))
        self.tag.append(tag)
        self.path.append(f"{self.path[up]}/{tag}{'.' + names if names else ''}")
        self.parent.append(up)
        self.mark.append(mark)
        if tag == "a":
            self._links += 1
        if mark == "never":
            self._hidden += 1
        if rest.endswith("/") and tag not in BLOCKS:
            self._close(tag)

    def _end(self, tags: set[str], until: set[str]) -> None:
        for i in range(len(self._stack) - 1, 0, -1):
            tag = self.tag[self._stack[i]]
            if tag in tags:
                self._pop(i)
                return
            if tag in until:
                return

    def _close(self, tag: str) -> None:
        if tag in BLOCKS or tag == "br":
            self._flush()
        for i in range(len(self._stack) - 1, 0, -1):
            if self.tag[self._stack[i]] == tag:
                self._pop(i)
                return

    def _pop(self, i: int) -> None:
        gone = self._stack[i:]
        if any(self.tag[e] in BLOCKS for e in gone):
            self._flush()
        self._links -= sum(self.tag[e] == "a" for e in gone)
        self._hidden -= sum(self.mark[e] == "never" for e in gone)
        del self._stack[i:]

    def settle(self) -> None:
        """Lifts marks of elements that wrap round more than 60 % of the page's text."""
        size = [0] * len(self.tag)
        for e, text, _ in self.blocks:
            while e >= 0:
                size[e] += len(text)
                e = self.parent[e]
        for e, mark in enumerate(self.mark):
            if mark in WRAPPING and size[e] > 0.6 * size[0]:
                self.mark[e] = ""

    def container(self) -> tuple[str, float]:
        """The path and score of the page's container: text outside links goes to the nearest container in full and to
        those above by halves, and from the best one it is climbed to where the whole article is."""
        score: dict[int, float] = {}
        own: dict[int, float] = {}  # by nearest container, what it holds itself
        for e, text, linked in self.blocks:
            up, chain = e, []
            while up > 0 and not self.mark[up]:
                if self.tag[up] in CONTAINERS:
                    chain.append(up)
                up = self.parent[up]
            if up > 0:
                continue
            part = float(len(text) - linked)
            at = chain[0] if chain else 0
            if 2 * linked <= len(text):
                own[at] = own.get(at, 0.0) + (PART if self.tag[e] in HEADINGS else part)
            for c in chain or [0]:
                score[c] = score.get(c, 0.0) + part * WEIGHT.get(self.tag[c], 1.0)
                part /= 2
        best = max(score, key=lambda c: (score[c], -c), default=-1)
        if best < 0 or score[best] <= 0:
            return "", 0.0
        top = self._whole(best, own)
        return self.path[top], score.get(top, score[best])

    def holders(self, path: str) -> dict[str, bool]:
        """Paths of the nearest containers of unmarked text outside links, and whether they stand under ``path``."""
        found = self._finder(path)
        out: dict[str, bool] = {}
        for e, n in self._free():
            q = self.path[self._holder(e)]
            out[q] = out.get(q, False) or found(e) is True
        return out

    def _holder(self, e: int) -> int:
        while e > 0 and self.tag[e] not in CONTAINERS:
            e = self.parent[e]
        return e

    def _free(self) -> list[tuple[int, int]]:
        """Elements of blocks that aren't in marked parts, and the characters of each outside links."""
        return [(e, len(t) - linked) for e, t, linked in self.blocks if len(t) > linked and not any(self.mark[x] for x in self._above(e))]

    def choose(self, paths: list[str], outside: list[str]) -> str | None:
        """The text of this page, given its host's winning paths and the holders that the host's pages leave outside."""
        own = self.container()[0]
        mine = self._finder(own)
        free = [(e, n, self.path[self._holder(e)] in outside) for e, n in self._free() if mine(e)]
        total, sure = sum(n for _, n, _ in free), sum(n for _, n, out in free if not out)
        best, covers = None, (0, 0)
        for path in paths:
            if path in self.path:
                found = self._finder(path)
                got = sum(n for e, n, out in free if not out and found(e)), sum(n for e, n, _ in free if found(e))
                if got[0] > covers[0]:
                    best, covers = path, got
        if best is not None and covers[1] >= AT_LEAST * total:
            if covers[0] >= sure:
                return self.text(best)
            return self.text(own, outside)
        return self.text(own)

    def _above(self, e: int) -> list[int]:
        """The element and those round it, outermost first."""
        chain = [e]
        while chain[-1] > 0:
            chain.append(self.parent[chain[-1]])
        return chain[::-1]

    def _whole(self, best: int, own: dict[int, float]) -> int:
        """The lowest container round all parts of the article that the best container belongs to.

        Parts are the outermost article and main elements if the best container is in one, else all containers that hold
        unmarked text outside links; those with less than ``PART`` characters and no heading only if they stand round it.
        """
        parts = {c: self._above(c) for c, n in own.items() if n >= PART}
        parts[best] = self._above(best)
        if any(self.tag[e] in ("article", "main") for e in parts[best]):
            ends = ([i for i, e in enumerate(p) if self.tag[e] in ("article", "main")] for p in parts.values())
            chains = [p[: i[0] + 1] for p, i in zip(parts.values(), ends) if i]
        else:
            chains = [*parts.values(), *(p for c in own if c in parts[best] for p in [self._above(c)])]
        shared = chains[0]
        for p in chains[1:]:
            n = next((i for i, (a, b) in enumerate(zip(shared, p)) if a != b), min(len(shared), len(p)))
            shared = shared[:n]
        return next((e for e in reversed(shared) if self.tag[e] in CONTAINERS), 0)

    def _finder(self, path: str):
        """A function that says whether an element is under one of that path: None if in a marked part of it."""
        inside: dict[int, bool | None] = {0: path == ""}
        titled = any(self.tag[e] == "h1" and not any(self.mark[x] for x in self._above(e)) for e, _, _ in self.blocks)

        def owned(e: int) -> bool:  # a header straight in the body is the site's if the page has another title
            return not titled or self.tag[self.parent[e]] not in ("", "html", "body")

        def found(e: int) -> bool | None:
            if e not in inside:
                if self.path[e] == path:
                    inside[e] = True
                else:
                    up = found(self.parent[e])
                    inside[e] = None if up and self.mark[e] else up
                    if up is None and self.tag[e] in HEADINGS and not self.mark[e]:
                        h = next(x for x in reversed(self._above(e)) if self.mark[x])
                        if self.mark[h] == "header" and owned(h) and found(self.parent[h]):
                            inside[e] = True
            return inside[e]

        return found

    def text(self, path: str, outside: list[str] | tuple = ()) -> str | None:
        """Text of the blocks under elements of that path, without marked parts and what those holders hold; null if the
        page has none."""
        if path not in self.path:
            return None
        found = self._finder(path)
        return "\n\n".join(t for e, t, _ in self.blocks if found(e) and not (outside and self.path[self._holder(e)] in outside))


def parse(html):
    page = PlainPage(html or "")
    page.settle()
    return page


def extract(html, paths=None, outside=()):
    page = parse(html)
    return (page.choose(paths, outside) if paths else page.text(page.container()[0])) or ""


def votes(html):
    page = parse(html)
    path, score = page.container()
    return [(path, score, 1, 0, 0), *((q, 0.0, 0, 1, int(ok)) for q, ok in page.holders(path).items())] if score > 0 else []
