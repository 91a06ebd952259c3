"""A page as a tree of block elements: nodes, text blocks, and features of every node."""

from __future__ import annotations

import html
import math
import re

# Fixed values of the markup language: elements without content, elements whose content is no
# text of the page, elements that stand in lines of text rather than make a block.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SILENT = set("script style noscript template iframe svg title textarea select button object audio video canvas head".split())
RAW = {"script", "style", "title", "textarea", "iframe", "noscript"}
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span"
    " strike strong sub sup time tt u var math mfrac mi mn mo mrow ms msqrt msub msubsup msup mtext semantics".split()
)
# Elements that may stand in a head; any other one ends it.
IN_HEAD = set("base link meta noscript script style title head".split())
# A start tag ends an open element of the second set, unless one of the third stands between.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"datalist"}),
}

# What it costs to reject a node inside main text, in log odds.
APART = 3.0

_TAG = re.compile(r"""<(?:!--.*?(?:--!?>|\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|(/?)([a-zA-Z][^\s/>]*)([^>]*)>|/?(?:[a-zA-Z][^>]*)?\Z|/[^>]*>)""", re.S)
_MARK = re.compile(r"""\b(class|id|role|itemprop|aria-label)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_TOKEN = re.compile(r"[a-z]+")

# What names of classes, ids and roles say about a node.
HINTS = {
    "body": "article body content entry main post story text prose document page",
    "menu": "nav navigation navbar menu breadcrumb breadcrumbs tabs toc pagination pager links",
    "advert": "ad ads advert adverts advertisement adsense banner promo promotion promoted sponsor sponsored sponsors dfp",
    "reader": "comment comments reply replies discussion disqus respond reaction reactions thread",
    "foot": "footer foot copyright legal colophon imprint disclaimer bottom",
    "side": "sidebar side aside widget related recommended recommendations trending popular rail complementary teaser more",
    "notice": "cookie cookies notice consent gdpr popup modal overlay alert message warning privacy",
    "form": "form login signin signup subscribe subscription newsletter search register contact",
    "head": "header head masthead logo brand top topbar banner contentinfo title hero",
    "share": "share sharing social follow tags meta byline author",
}
_HINT = {}
for _place, _words in enumerate(HINTS.values()):
    for _word in _words.split():
        _HINT[_word] = _HINT.get(_word, 0) | 1 << _place
TAGS = (
    "p", "h1 h2 h3", "h4 h5 h6", "li dt dd", "ul ol dl menu", "div", "section", "article main", "nav", "aside", "header", "footer",
    "form fieldset", "table tbody thead tr td th", "blockquote pre figure figcaption", "body html",
)
_KIND = {tag: place for place, tags in enumerate(TAGS) for tag in tags.split()}
FEATURES = len(TAGS) + 2 * len(HINTS) + len(TAGS) + 18


class Page:
    """Nodes in document order (a parent before its children) and blocks of text (node, text, link characters)."""

    __slots__ = ("tags", "parents", "hints", "blocks", "marks")

    def __init__(self, source: str, marked: bool = False):
        self.tags, self.parents, self.hints, self.blocks = ["html"], [-1], [0], []
        # For training pages: the value of data-main of a node, or of the nearest ancestor that has one.
        self.marks: list[bool] = [False]
        self._read(source, marked)

    def _read(self, source: str, marked: bool) -> None:
        open_: list[tuple[str, int]] = [("html", 0)]
        words: list[str] = []
        links = in_link = 0
        at, silent, depth = 0, "", 0
        # Whether the silent element has no end tag; the elements known to have none any more.
        loose, never = False, set()

        def flush() -> None:
            nonlocal links
            if words:
                text = " ".join(html.unescape("".join(words)).split())
                if text:
                    self.blocks.append((open_[-1][1], text, min(links, len(text))))
                words.clear()
            links = 0

        def close(upto: int) -> None:
            nonlocal in_link
            flush()
            in_link = 0
            del open_[upto:]

        while tag := _TAG.search(source, at):
            if not silent and tag.start() > at:
                piece = source[at : tag.start()]
                words.append(piece)
                links += in_link and len(piece)
            at = tag.end()
            name = tag[2] or tag[5]
            if not name:
                continue
            name, ends = name.lower(), bool(tag[1] or tag[4])
            if silent == "head" and not ends and name not in IN_HEAD:
                silent = ""
            if silent and loose and (any(name == o for o, _ in open_[1:]) if ends else name in _KIND):
                silent = ""
            if silent:
                # Only its own end tag ends a silent element that has one; elements that can hold themselves are counted.
                if name == silent:
                    depth += -1 if ends else 1
                if depth <= 0 or (silent == "head" and name == "body"):
                    silent = ""
                if name != "body":
                    if name in RAW and not ends:
                        at = self._after(source, name, at)
                    continue
            attributes = tag[3] if tag[2] else tag[6]
            if name in SILENT:
                if name in RAW and not ends:
                    at = self._after(source, name, at)
                elif not ends and not (attributes or "").rstrip().endswith("/"):
                    silent, depth, loose = name, 1, self._unclosed(source, name, at, never)
                continue
            if name in INLINE:
                if name == "a":
                    in_link = 0 if ends else 1
                continue
            if name == "br":
                words.append(" ")
                continue
            if name in VOID:
                if name == "hr":
                    flush()
                continue
            if ends:
                for place in range(len(open_) - 1, 0, -1):
                    if open_[place][0] == name:
                        close(place)
                        break
                else:
                    flush()
                continue
            if name == "html":
                continue
            flush()
            # A block ends an open paragraph; items and cells end the ones before them.
            if open_[-1][0] == "p":
                close(len(open_) - 1)
            if name in CLOSES:
                ended, walls = CLOSES[name]
                for place in range(len(open_) - 1, 0, -1):
                    if open_[place][0] in walls:
                        break
                    if open_[place][0] in ended:
                        close(place)
                        if name not in ("tr", "tbody"):
                            break
            elif name[0] == "h" and name[1:].isdigit() and open_[-1][0][0] == "h" and open_[-1][0][1:].isdigit():
                close(len(open_) - 1)
            hint = 0
            if attributes and "=" in attributes:
                for key, value in _MARK.findall(attributes):
                    for word in _TOKEN.findall(value.lower()):
                        hint |= _HINT.get(word, 0)
            self.parents.append(open_[-1][1])
            self.tags.append(name)
            self.hints.append(hint)
            if marked:
                own = re.search(r'data-main="(\d)"', attributes or "")
                self.marks.append(own[1] == "1" if own else self.marks[open_[-1][1]])
            open_.append((name, len(self.tags) - 1))
        if not silent and at < len(source):
            rest = source[at:]
            words.append(rest)
            links += in_link and len(rest)
        flush()

    @staticmethod
    def _unclosed(source: str, name: str, at: int, never: set[str]) -> bool:
        """Whether an element that starts before ``at`` has no end tag; buttons and selects do not hold themselves."""
        if name in never:
            return True
        found = re.compile(rf"<(/?){name}\b" if name in ("button", "select") else rf"<(/){name}\b", re.I).search(source, at)
        if found is None:
            never.add(name)
        return found is None or not found[1]

    @staticmethod
    def _after(source: str, name: str, at: int) -> int:
        """Behind the end tag of an element that holds raw text."""
        end = re.compile(rf"</{name}[^>]*>", re.I).search(source, at)
        return end.end() if end else len(source)

    def features(self) -> list[list[float]]:
        """One row for each node."""
        n = len(self.tags)
        chars, linked, blocks, points, kids = [0] * n, [0] * n, [0] * n, [0] * n, [0] * n
        own, starts, order, longest = [0] * n, [-1] * n, [0] * n, [0] * n
        seen = 0
        for node, text, links in self.blocks:
            size = len(text)
            mark = text.count(".") + text.count(",") + text.count(";") + text.count("?") + text.count(":")
            own[node] += size
            up = node
            while up >= 0:
                chars[up] += size
                linked[up] += links
                blocks[up] += 1
                points[up] += mark
                longest[up] = max(longest[up], size)
                if starts[up] < 0:
                    starts[up] = seen
                up = self.parents[up]
            seen += size
        total = max(seen, 1)
        depth, before, above, best = [0] * n, [0] * n, [0] * n, max([len(t) for _, t, _ in self.blocks], default=1)
        previous, latest = [-1] * n, {}
        following = [-1] * n
        for i in range(1, n):
            parent = self.parents[i]
            depth[i] = depth[parent] + 1
            order[i] = kids[parent]
            kids[parent] += 1
            above[i] = above[parent] | self.hints[parent]
            kind = _KIND.get(self.tags[parent])
            before[i] = before[parent] | (1 << kind if kind is not None else 0)
            if parent in latest:
                previous[i] = latest[parent]
                following[latest[parent]] = i
            latest[parent] = i
        log = math.log1p
        rows = []
        for i in range(n):
            parent = max(self.parents[i], 0)
            c = chars[i]
            row = [0.0] * FEATURES
            kind = _KIND.get(self.tags[i])
            if kind is not None:
                row[kind] = 1.0
            at = len(TAGS)
            hint, hints = self.hints[i], above[i]
            for k in range(len(HINTS)):
                if hint >> k & 1:
                    row[at + k] = 1.0
                if hints >> k & 1:
                    row[at + len(HINTS) + k] = 1.0
            at += 2 * len(HINTS)
            kinds = before[i]
            for k in range(len(TAGS)):
                if kinds >> k & 1:
                    row[at + k] = 1.0
            at += len(TAGS)
            left, right = previous[i], following[i]
            row[at:] = (
                depth[i], log(c), log(own[i]), linked[i] / c if c else 0.0, points[i] / c if c else 0.0, log(blocks[i]),
                c / total, c / chars[parent] if chars[parent] else 0.0, max(starts[i], 0) / total, c / blocks[i] if blocks[i] else 0.0,
                order[i], kids[parent] - order[i], log(kids[i]), log(chars[left]) if left >= 0 else -1.0, log(chars[right]) if right >= 0 else -1.0,
                linked[parent] / chars[parent] if chars[parent] else 0.0, log(longest[i]), longest[i] / best,
            )
            rows.append(row)
        return rows

    def decode(self, logits: list[float]) -> list[bool]:
        """Whether each node is of the main text: the best labels in which nothing below a rejected node is kept.

        A node is a frame around main text (``outside``), main text, or rejected. Below a frame
        all three may stand, below main text main text and rejected parts, below a rejected node
        only rejected ones. Nodes with text of their own are no frames.
        """
        n = len(self.tags)
        texts = [False] * n
        for node, _, _ in self.blocks:
            texts[node] = True
        frame, inside, out = [0.0] * n, [0.0] * n, [0.0] * n
        for i in range(n - 1, -1, -1):
            frame[i] = -1e9 if texts[i] else frame[i] - 0.1
            inside[i] += logits[i]
            out[i] -= logits[i]
            if i:
                p = self.parents[i]
                frame[p] += max(frame[i], inside[i], out[i])
                inside[p] += max(inside[i], out[i] - APART)
                out[p] += out[i]
        states = [0] * n
        for i in range(n):
            above = states[self.parents[i]] if i else 0
            options = (frame[i], inside[i], out[i] - APART * (above == 1))
            states[i] = max(range(above, 3), key=lambda k: options[k]) if above < 2 else 2
        return [state == 1 for state in states]

    def text(self, kept: list[bool]) -> str:
        return "\n".join(text for node, text, _ in self.blocks if kept[node])
