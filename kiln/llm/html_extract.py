"""Main text of web pages by tag-path ratios.

Every text node belongs to the path of tags (with class names) from the root to
it.  Text length and punctuation are summed per path and divided by its nodes;
the two ratios are smoothed over neighbouring paths, multiplied, and paths at or
above a share of the spread of all scores hold content.  If one <article> or <main>
holds most of the content characters, elements of these names are the article
(with all such elements that hold content); otherwise the smallest element
around all of the content is, never a single block or a part of a
text like a list.  Its blocks and the headings that lead to it are the result, so
that headings and short paragraphs stay, but blocks of links on paths below the
threshold go.  Menus, scripts and embedded objects are not read.  Elements that
seldom hold an article (forms, footers, adverts, comments and the like, by tag,
role, class or id, and hidden ones) are left out before the scores, unless one
holds most of the page's text outside links, or there is no other text.

Defined results: a null or empty page, or one without text that is read, gives
an empty string; text outside any element counts as a block; unclosed tags end with
their parent, an unclosed script or style at the end of the page; repeated rows
give repeated results; further columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import DataFrame

from kiln.llm.common import map_texts

# Element names of the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set("""address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol option p pre search section summary
    table tbody tfoot thead tr ul""".split())
SPACE = set("br td th wbr img".split())
UNREAD = set("""script style noscript template head title nav button select textarea iframe svg canvas object audio video
    menu""".split())
ASIDE = {"footer", "aside", "form", "dialog"}       # seldom hold the article
IN_HEAD = set("base link meta title style script noscript template".split())
HEADING = {"h1", "h2", "h3", "h4", "h5", "h6", "hgroup"}
# Parts of a text that are never the whole of it.
PARTS = HEADING | set("""address blockquote caption dd dl dt figcaption figure hr li ol option p pre summary table tbody tfoot
    thead tr ul""".split())
CLOSES_P = BLOCK - {"body", "html", "option", "caption", "tbody", "thead", "tfoot", "tr"}
SAME = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "option": ({"option"}, {"select"})}
# Names of classes, ids and roles that mark other matter than the article, alone or in compounds of them.
OTHER = set("""ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner
    sidebar sidenav menu nav navbar navigation breadcrumb breadcrumbs footer masthead topbar toolbar cookie cookies
    consent gdpr notice alert popup modal overlay newsletter subscribe signup login comment comments disqus respond
    reply replies share sharing social related recommended recommendations widget pagination pager skip complementary
    contentinfo search dialog""".split())
HEADER = {"header", "head", "masthead", "banner"}
ARTICLE = {"article", "main"}
PUNCTUATION = re.compile(r"[.,;:!?…。，！？؟]")
CUT_OFF = re.compile(r"<[/!a-zA-Z][^<>]*\Z")     # a tag that the page's end cuts off
SHARE = 0.25            # of the standard deviation of the path scores


class _Page(HTMLParser):
    """Text nodes of a page: (text, path, enclosing elements, block, in a link?)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, str, int]] = []     # tag, label, element number
        self.elements = 0
        self.tags = [""]                                # by element number, 0: the page
        self.block = 0
        self.unread = 0                                 # depth at which reading stopped, 0: reads
        self.nodes: list[tuple[str, str, tuple[int, ...], int, bool]] = []
        self.articles: list[int] = []                   # element numbers
        self.others: set[int] = set()                   # elements that seldom hold the article

    def _other(self, tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        inside = any(t in ARTICLE for t, _, _ in self.stack)
        if tag in ASIDE or tag == "header" and not inside:
            return True
        if tag in ("html", "body", "article", "main"):
            return False
        for k, v in attrs:
            if k == "hidden" or k == "aria-hidden" and v == "true":
                return True
            if k == "style" and re.search(r"display\s*:\s*none", v or "", re.I):
                return True
            if k in ("class", "id", "role"):
                for name in (v or "").lower().split():
                    parts = re.findall("[a-z]+", name)
                    if not inside and name in HEADER or parts and all(n in OTHER for n in parts):
                        return True
        return False

    def _pop(self, upto: int) -> None:
        while len(self.stack) > upto:
            if self.stack.pop()[0] in BLOCK:
                self.block += 1
        if self.unread > len(self.stack):
            self.unread = 0

    def _close(self, tags: set[str], fence: set[str]) -> None:
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] in tags:
                return self._pop(k)
            if self.stack[k][0] in fence:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.stack and self.stack[-1][0] == "head" and tag not in IN_HEAD:
            self._pop(len(self.stack) - 1)
        elif tag == "body":
            self._close({"head"}, {"body"})
        if tag in CLOSES_P:
            self._close({"p"}, {"td", "th", "button", "object"} | BLOCK - {"p"})
        if tag in SAME:
            self._close(*SAME[tag])
        if tag in BLOCK:
            self.block += 1
        if tag in SPACE:
            self.handle_data(" ")
        if tag in VOID:
            return
        self.elements += 1
        self.tags.append(tag)
        names = " ".join(v or "" for k, v in attrs if k == "class").split()
        if not self.unread and self._other(tag, attrs):
            self.others.add(self.elements)
        self.stack.append((tag, ".".join([tag, *sorted(names)]), self.elements))
        if self.unread:
            return
        if tag in UNREAD:
            self.unread = len(self.stack)
        elif tag in ARTICLE:
            self.articles.append(self.elements)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in ("svg", "iframe"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID:
            return
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == tag:
                return self._pop(k)
        if tag in BLOCK:                                # an end without a beginning still ends a block
            self.block += 1

    def handle_data(self, data: str) -> None:
        if self.stack and self.stack[-1][0] == "head" and data.strip():
            self._pop(len(self.stack) - 1)
        if not self.unread and data:
            self.nodes.append((data, "/".join(s[1] for s in self.stack), tuple(s[2] for s in self.stack), self.block,
                               any(s[0] == "a" for s in self.stack)))


def without_others(page: _Page) -> list[tuple[str, str, tuple[int, ...], int, bool]]:
    """The text nodes outside elements that seldom hold the article, unless such an element holds most of the text."""
    size = dict.fromkeys(page.others, 0)        # characters outside links
    total = 0
    for text, _, elements, _, link in page.nodes:
        n = 0 if link else len(text.strip())
        total += n
        for e in page.others.intersection(elements) if n else ():
            size[e] += n
    left_out = {e for e, n in size.items() if 2 * n <= total}
    while True:
        nodes = [x for x in page.nodes if left_out.isdisjoint(x[2])]
        if not total or any(x[0].strip() and not x[4] for x in nodes):
            return nodes
        left_out.discard(max(left_out, key=lambda e: (size[e], -e)))        # the largest, the outer one of equals


def path_scores(nodes: list[tuple[str, str, tuple[int, ...], int, bool]]) -> dict[str, float]:
    """Fused, smoothed text and punctuation ratios of every path, text inside links counting nothing."""
    sums: dict[str, list[int]] = {}
    for text, path, _, _, link in nodes:
        if text.strip():
            s = sums.setdefault(path, [0, 0, 0])
            s[0] += 1
            if not link:
                s[1] += len(text.strip())
                s[2] += len(PUNCTUATION.findall(text))
    if not sums:
        return {}
    n, chars, marks = np.array(list(sums.values()), dtype=float).T
    fused = np.ones(len(n))
    for ratio in (chars / n, (1 + marks) / n):
        around = np.concatenate((ratio[:1], ratio, ratio[-1:]))
        fused *= 0.1 * around[:-2] + 0.8 * ratio + 0.1 * around[2:]
    return dict(zip(sums, np.where(chars > 0, fused, 0.0), strict=True))


def holder(content: list[tuple[tuple[int, ...], int]], tags: list[str]) -> tuple[int, ...]:
    """Chain of the smallest element that holds all content nodes (enclosing elements, block) and their sibling blocks."""
    common = content[0][0]
    for elements, _ in content:
        n = min(len(common), len(elements))
        common = common[:next((k for k in range(n) if common[k] != elements[k]), n)]

    def outer(n: int) -> int:
        while n and (tags[common[n - 1]] not in BLOCK or tags[common[n - 1]] in PARTS):
            n -= 1
        return n

    n = outer(len(common))
    if n and len({b for _, b in content}) == 1 and not any(tags[e] in BLOCK for e in content[0][0][n:]):
        n = outer(n - 1)                # the element is a block itself
    return common[:n]


def main_text(html: str) -> str:
    """The article's blocks, joined by an empty line."""
    page = _Page()
    page.feed(CUT_OFF.sub("", html))
    page.close()
    nodes = without_others(page)
    scores = path_scores(nodes)
    if not scores:
        return ""
    least = SHARE * float(np.std(list(scores.values())))
    content = []
    inside: Counter[int] = Counter()    # element -> content characters, 0: the page
    for text, path, elements, block, _ in nodes:
        if text.strip() and scores[path] >= least:
            content.append((elements, block))
            size = len(text.strip())
            for e in (0, *elements):
                inside[e] += size
    named = {e for e in page.articles if inside[e]}
    chain: tuple[int, ...] = ()
    if any(2 * inside[e] > inside[0] for e in named):
        holders = named                 # the article by its name, with the others of that name
    else:
        chain = holder(content, page.tags)
        holders = set(chain[-1:]) or {0}
    first = content[0][1]

    def kept(elements: tuple[int, ...], block: int) -> bool:
        if 0 in holders or holders.intersection(elements):
            return True
        # a heading beside the holder or one of the elements around it, before the content
        k = next((k for k, e in enumerate(elements) if e not in chain), len(elements))
        return bool(chain) and block < first and k < len(elements) and page.tags[elements[k]] in HEADING

    blocks: dict[int, list] = {}
    for text, path, elements, block, link in nodes:
        if kept(elements, block):
            b = blocks.setdefault(block, [[], 0, 0, 0.0])
            b[0].append(text)
            b[1] += len(text.strip())
            b[2] += len(text.strip()) if link else 0
            b[3] = max(b[3], scores.get(path, 0.0))
    out = []
    for texts, size, linked, score in blocks.values():
        text = " ".join("".join(texts).split())
        if text and not (linked > 0.6 * size and score < least):
            out.append(text)
    return "\n\n".join(out)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of every page."""

    def run(htmls: list[str]) -> dict:
        texts = list(map(main_text, htmls))
        return {"text": texts, "n_chars": list(map(len, texts))}

    return map_texts(pages, html_col, {id_col: id_col, url_col: url_col}, {"text": "string", "n_chars": "long"}, run)
