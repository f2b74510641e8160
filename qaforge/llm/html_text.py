"""Main text of web pages by composite text density.

Each page becomes a DOM tree (an element list in page order, parents before
children; end tags that HTML lets out are implied). Elements that can hold no
article text (scripts, forms, menus, page headers and footers, sidebars, and
those whose class or id names them as adverts, notices, comments, ...) are
cut first; inside an article, longer names that only begin or end with such a
word ("share-price") cut an element only if half of its text is links. Every
other node has

    density = C / T * log_b(C / LC * T / LT),  b = ln(C / nLC * LC + LC_body / C_body * C + e)

with C characters, T tags, LC characters and LT tags in links and nLC
characters outside links (each at least 1): characters per tag, adjusted for
links. The node with the largest sum of its children's densities is the core
of the article. The topmost node on the path from ``body`` to the core that
is at least as dense as the core is taken whole (what stands beside the core
in it does not thin it out). The smallest density on the path is the
threshold: siblings of the path, children of ``body`` included, that reach it
belong to the article too, by their density or, if less than half of their
text is links, by the sum of their children's densities.

Two tag rules stay beside the densities: an ``article`` or ``main`` that holds
the core is taken whole, and siblings with no text outside ``h1`` to ``h6``
belong if a sibling up to the next heading does (a headline is too short to be
dense). The chosen subtrees give their text whole.

Blocks are the runs of text between block-level tags. Character references
are decoded before characters are counted, white space inside a block becomes one space, blocks are trimmed
and joined by one line end.

Defined cases: null or empty html gives an empty text; a page without tags is
one block; of equal density sums the first node in page order wins; repeated
rows give repeated results; null ids and urls are carried; very long and
deeply nested pages are read whole, without recursion; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

import html as _html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import bounded_batches, trimmed

TOKEN = re.compile(r"""<!--(?:>|->|.*?(?:-->|--!>|\Z))
    |<!\[CDATA\[.*?(?:\]\]>|\Z)
    |<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>"']++|"[^"]*"|'[^']*')*+)>
    |</?[a-zA-Z][^>]*(?:>|\Z)
    |<[!?/][^>]*(?:>|\Z)""", re.S | re.X)
NAMES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
RAW = frozenset("script style title textarea iframe noframes xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol optgroup option p pre search section summary
    table caption tbody td tfoot th thead tr ul""".split())
#: Start tags that end an open paragraph.
ENDS_P = BLOCK - frozenset("html body td th tr tbody thead tfoot caption option optgroup".split())
SCOPE = frozenset("html body table td th caption button object template".split())
#: A start tag ends an open element of the second set, up to one of the third.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "tbody": ({"tr", "td", "th", "thead", "tbody", "tfoot"}, {"table"}),
        "tfoot": ({"tr", "td", "th", "thead", "tbody", "tfoot"}, {"table"})}
CUT_TAGS = frozenset("""head script style noscript template title textarea iframe noframes object embed canvas svg math
    audio video map nav menu footer aside form button select datalist input label dialog search""".split())
CUT_NAMES = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie
    cookies consent notice notices alert popup modal overlay newsletter subscribe subscription signup login sidebar
    sidebars aside widget widgets nav navbar navigation menu menus breadcrumb breadcrumbs header masthead footer footers
    copyright comment comments reply replies discussion disqus share sharing social related recommended search pagination
    pager toolbar complementary contentinfo""".split())
#: Names that are also plain words: at the end of a longer name ("market-share") they say little.
PLAIN = frozenset("""share sharing social related recommended search notice notices alert copyright discussion reply replies
    complementary""".split())
#: What a longer name may have beside one of the names above and still mean it ("share-buttons", "comment-list").
PARTS = frozenset("""area articles bar block body box button buttons container content form group icon icons inner item items
    link links list outer panel post posts row section slot stories thread unit wrap wrapper""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
WORD = re.compile(r"[a-z]+")


#: What an element's tag and names say: its text stays, goes, or goes if it is mostly links.
STAYS, GOES, DOUBTFUL = 0, 1, 2


def _names(name: str, inside: bool) -> int:
    """What one class, id or role says. Inside an article only whole names and plain pairs are taken at their word."""
    words = WORD.findall(name)
    if not words or not (words[0] in CUT_NAMES or words[-1] in CUT_NAMES) or inside and words[-1] == "header":
        return STAYS
    if not inside or len(words) == 1 or words[-1] in CUT_NAMES - PLAIN or words[0] in CUT_NAMES and PARTS.issuperset(words[1:]):
        return GOES
    return DOUBTFUL


def _is_cut(tag: str, attrs: str, inside: bool) -> int:
    if tag in CUT_TAGS:
        return GOES
    if tag in ("html", "body", "article", "main") and not attrs:
        return STAYS
    if tag == "header":
        return STAYS if inside else GOES  # an article's own header holds its headline
    said = STAYS
    if attrs and tag not in ("html", "body"):
        for m in NAMES.finditer(attrs):
            for name in (m[1] or m[2] or m[3] or "").lower().split():
                now = _names(name, inside)
                if now == GOES:
                    return GOES
                said = now or said
    return said


class Page:
    """The element list of one page: ``tags``, ``parents`` and, in page order, its texts by element."""

    def __init__(self, source: str):
        self.tags, self.parents, self.cut, self.doubtful = ["html"], [-1], [False], []
        #: (element, text) of each text, (element, None) where a block-level tag stands
        self.texts: list[tuple[int, str | None]] = []
        self._parse(source)
        if self.doubtful:
            self._settle_doubtful()

    def _parse(self, source: str) -> None:
        tags, parents, cut, texts = self.tags, self.parents, self.cut, self.texts
        stack, open_ = [0], Counter()
        inside = 0  # open article and main elements
        at, find, lower = 0, TOKEN.search, None

        def close_to(depth: int) -> None:
            nonlocal inside
            while len(stack) > depth:
                t = tags[stack.pop()]
                open_[t] -= 1
                if t in ("article", "main"):
                    inside -= 1

        def close_nearest(names, stop) -> None:
            if any(open_[t] for t in names):
                for k in range(len(stack) - 1, 0, -1):
                    t = tags[stack[k]]
                    if t in names:
                        close_to(k)
                        return
                    if t in stop:
                        return

        while True:
            m = find(source, at)
            text = source[at:m.start()] if m else source[at:]
            if text:
                texts.append((stack[-1], _html.unescape(text)))  # a reference ends with its text node
            if m is None:
                return
            at = m.end()
            tag = m["tag"]
            if tag is None:
                if m[0].startswith("<![CDATA["):
                    texts.append((stack[-1], m[0][9:-3]))
                continue
            tag = tag.lower()
            if m["end"]:
                if open_[tag]:
                    for k in range(len(stack) - 1, 0, -1):
                        if tags[stack[k]] == tag:
                            close_to(k)
                            break
                if tag in BLOCK:
                    texts.append((stack[-1], None))
                continue
            attrs = m["attrs"]
            if tag in ("html", "body"):
                if tag == "body" and not open_["body"]:
                    close_to(1)
                elif tag == "html" or open_[tag]:
                    continue
            if tag in ENDS_P:
                close_nearest(("p",), SCOPE)
            if tag in ENDS:
                close_nearest(*ENDS[tag])
            parent = stack[-1]
            me = len(tags)
            tags.append(tag)
            parents.append(parent)
            said = _is_cut(tag, attrs, inside > 0)
            cut.append(cut[parent] or said == GOES)
            if said == DOUBTFUL:
                self.doubtful.append(me)
            if tag in BLOCK:
                texts.append((parent, None))
            elif tag == "br":
                texts.append((parent, " "))
            if tag in VOID or attrs.endswith("/") and tag not in BLOCK and tag not in RAW:
                continue
            if tag in RAW:
                if lower is None:
                    lower = source.lower() if len(source.lower()) == len(source) else source
                end = lower.find("</" + tag, at)
                at = len(source) if end < 0 else end
                continue_at = source.find(">", at)
                at = len(source) if continue_at < 0 else continue_at + 1
                continue
            stack.append(me)
            open_[tag] += 1
            if tag in ("article", "main"):
                inside += 1

    def _settle_doubtful(self) -> None:
        """Cut the doubtful elements of whose characters at least half stand in links."""
        n = len(self.tags)
        chars, links, linked = [0] * n, [0] * n, [False] * n
        for k in range(1, n):
            linked[k] = linked[self.parents[k]] or self.tags[k] == "a"
        for k, text in self.texts:
            if text and not self.cut[k]:
                c = len("".join(text.split()))
                chars[k] += c
                links[k] += c * linked[k]
        for k in range(n - 1, 0, -1):
            chars[self.parents[k]] += chars[k]
            links[self.parents[k]] += links[k]
        for k in self.doubtful:
            self.cut[k] = self.cut[k] or 2 * links[k] >= chars[k]
        for k in range(1, n):
            self.cut[k] = self.cut[k] or self.cut[self.parents[k]]

    def chosen(self) -> list[bool]:
        """Which elements' texts belong to the article."""
        tags, parents, cut = self.tags, self.parents, self.cut
        n = len(tags)
        chars, links, heads, tag_n, link_n = [0] * n, [0] * n, [0] * n, [1] * n, [0] * n
        linked, heading = [False] * n, [False] * n
        for k in range(1, n):
            linked[k] = linked[parents[k]] or tags[k] == "a"
            heading[k] = heading[parents[k]] or tags[k] in HEADINGS
            link_n[k] = int(tags[k] == "a")
        for k, text in self.texts:
            if text and not cut[k]:
                c = len("".join(text.split()))
                chars[k] += c
                links[k] += c * linked[k]
                heads[k] += c * heading[k]
        for k in range(n - 1, 0, -1):
            if not cut[k]:
                p = parents[k]
                chars[p] += chars[k]
                links[p] += links[k]
                heads[p] += heads[k]
                tag_n[p] += tag_n[k]
                link_n[p] += link_n[k]
        body = next((k for k in range(n) if tags[k] == "body" and not cut[k]), 0)
        link_share = links[body] / max(chars[body], 1)
        density, sums = [0.0] * n, [0.0] * n
        for k in range(n - 1, -1, -1):
            if chars[k] and not cut[k]:
                c, lc, t, lt = chars[k], max(links[k], 1), tag_n[k], max(link_n[k], 1)
                base = math.log(c / max(c - links[k], 1) * links[k] + link_share * c + math.e)
                density[k] = c / t * max(math.log(c / lc * t / lt), 0.0) / base if base > 0 else 0.0
                if k:
                    sums[parents[k]] += density[k]
        best = max(range(body, n), key=lambda k: (sums[k], -k)) if n > body else body
        path, k = [], best
        while k >= body:
            path.append(k)
            k = parents[k]
        least = min((density[k] for k in path), default=0.0)
        # the topmost of these is taken whole
        whole = [k for k in path if density[k] >= density[best] > 0 or k > body and tags[k] in ("article", "main")]
        top = whole[-1] if whole else best
        above, on_path = set(path[path.index(top) + 1:]), set(path)
        chosen = {top}
        section: dict[int, tuple[bool, bool]] = {}  # by parent: does what follows, up to the next heading, belong; is that heading next
        for k in range(n - 1, body, -1):
            p = parents[k]
            if p not in above or cut[k] or not chars[k]:
                continue
            fate, headed = section.get(p, (False, False))
            if heads[k] == chars[k] and k not in on_path:
                headed = True
            else:
                dense = density[k] >= least or (2 * links[k] < chars[k] and sums[k] >= least)
                own = k in on_path or 0 < least and dense
                fate, headed = own or fate and not headed, False
            if k not in on_path and (fate if headed else own):
                chosen.add(k)
            section[p] = fate, headed
        take = [False] * n
        for k in range(n):
            take[k] = not cut[k] and (k in chosen or k > 0 and take[parents[k]])
        return take

    def main_text(self) -> str:
        take = self.chosen()
        blocks, now = [], []
        for k, text in self.texts:
            if text is None:
                if now:
                    blocks.append("".join(now))
                    now = []
            elif take[k]:
                now.append(text)
        blocks.append("".join(now))
        out = (" ".join(b.split()) for b in blocks)
        return "\n".join([b for b in out if b])


def main_text(source: str | None) -> str:
    return Page(source).main_text() if source else ""


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages``."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                texts = [main_text(s.as_py()) for s in part.column("html")]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    bounded_batches(pages)
    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(trimmed(rows), f"page_id {kind}, url string, text string, n_chars long")
