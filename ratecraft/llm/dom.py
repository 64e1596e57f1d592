"""Pages as flat node arrays: a forgiving HTML reader and features of every node.

Nodes are elements and text runs in page order, so a subtree is a contiguous
range and its statistics are differences of running sums.
"""

from __future__ import annotations

import re

import numpy as np

# fixed values of HTML
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title iframe noembed noframes xmp".split())
EMBEDDED = set("math mi mn mo ms mtext mrow msup msub msubsup mfrac msqrt mroot mover munder munderover mstyle mspace semantics annotation "
               "svg g defs use path circle ellipse line polygon polyline rect object".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span "
             "strike strong sub sup time tt u var wbr".split()) | EMBEDDED
CLOSES_P = set("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol "
               "p pre section table ul".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}
CONTROLS = set("button input select option textarea label fieldset".split())

# words of class, id, role and itemprop that tell what an element is for
CONTENT_WORDS = set("article articlebody body content entry main mainentity page paragraph post prose read reading story text".split())
CHROME_WORDS = set(
    "ad ads adslot advert advertisement alert banner bottombar breadcrumb breadcrumbs byline comment comments complementary consent "
    "contentinfo cookie cookies copyright discussion disqus feedback foot footer form gdpr head header hidden links login "
    "masthead menu menubar message modal nav navbar navigation newsletter notice notification outbrain overlay pager pagination "
    "paywall popup promo promoted promotion recommended related replies reply respond reviews rail search share sharing "
    "sidebar signup skip social sponsor sponsored subscribe tags teaser toc toolbar topbar trending warning widget".split())

GROUPS = [{"article", "main"}, {"nav", "menu"}, {"header"}, {"footer"}, {"aside"}, {"form", *CONTROLS}, {"div", "section", "body"},
          {"p", "blockquote", "pre"}, {"ul", "ol", "li", "dl", "dt", "dd"}, {"h1", "h2", "h3", "h4", "h5", "h6"},
          {"table", "tbody", "thead", "tr", "td", "th"}, INLINE - CONTROLS, {"#text"}, {"figure", "figcaption", "dialog", "details"}, RAW | {"head"}]
GROUP_OF = {tag: g for g, tags in reversed(list(enumerate(GROUPS))) for tag in tags}
N_GROUPS = len(GROUPS) + 1

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/><]*)"
    r"""([^>"'<]*(?:"[^"<]*"[^>"'<]*|'[^'<]*'[^>"'<]*)*>|[^>]*(?:>|\Z))""", re.S)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|itemprop|data-y)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?=[\s>/=]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Nodes:
    """The nodes of some pages, one after the other."""

    def __init__(self):
        self.page, self.parent, self.tag, self.depth, self.end = [], [], [], [], []
        self.content, self.chrome, self.hidden, self.label = [], [], [], []
        self.text: list[str | None] = []
        self.pages = 0
        self._seen: dict[str, tuple[int, int, int, int]] = {}

    def _add(self, page, parent, tag, depth, meaning, text=None) -> int:
        i = len(self.tag)
        self.page.append(page)
        self.parent.append(parent)
        self.tag.append(tag)
        self.depth.append(depth)
        self.end.append(i + 1)
        self.content.append(meaning[0])
        self.chrome.append(meaning[1])
        self.hidden.append(meaning[2])
        self.label.append(meaning[3])
        self.text.append(text)
        return i

    def _meaning(self, attributes: str) -> tuple[int, int, int, int]:
        """(content words, chrome words, is hidden, training label or -1) of an element's attributes."""
        known = self._seen.get(attributes)
        if known is None:
            words, label = [], -1
            for name, *values in _ATTRIBUTE.findall(attributes):
                if name.lower() == "data-y":
                    label = int(values[0])
                else:
                    words += [w.lower() for w in _WORD.findall("".join(values))]
            known = (sum(w in CONTENT_WORDS for w in words), sum(w in CHROME_WORDS for w in words), int(bool(_HIDDEN.search(attributes))), label)
            if len(self._seen) < 10_000:
                self._seen[attributes] = known
        return known

    def read(self, html: str) -> None:
        """Append the nodes of one page, below a root of its own."""
        page, none = self.pages, (0, 0, 0, -1)
        self.pages += 1
        stack = [self._add(page, -1, "#root", 0, none)]
        tags = ["#root"]
        places: dict[str, list[int]] = {}      # of the open elements, by tag

        def close(to: int) -> None:
            for i, name in zip(stack[to:], tags[to:], strict=True):
                self.end[i] = len(self.tag)
                if places.get(name):
                    places[name].pop()
            del stack[to:], tags[to:]

        def last(names) -> int:
            return max((places[name][-1] for name in names if places.get(name)), default=0)

        def words(text: str) -> None:
            if text:
                self._add(page, stack[-1], "#text", len(stack), none, text)

        at, n = 0, len(html)
        while at < n:
            m = _TOKEN.search(html, at)
            if m is None:
                words(html[at:])
                break
            words(html[at:m.start()])
            at = m.end()
            tag = m[2]
            if tag is None:
                if m[0].startswith("<![CDATA["):
                    words(m[0][9:].removesuffix("]]>"))
                continue
            tag = tag.lower()
            if m[1]:
                if places.get(tag):
                    close(places[tag][-1])
                continue
            if tag in CLOSES_P and places.get("p"):
                close(places["p"][-1])
            elif tag in CLOSED_BY and last(CLOSED_BY[tag]) > last(SCOPE[tag]):
                close(last(CLOSED_BY[tag]))
            attributes = m[3].rstrip(">")
            i = self._add(page, stack[-1], tag, len(stack), self._meaning(attributes))
            if tag in RAW:
                # nothing inside is text of the page
                if not attributes.endswith("/"):
                    stop = re.compile(rf"</{re.escape(tag)}\s*[^>]*(?:>|\Z)", re.I).search(html, at)
                    at = stop.end() if stop else n
            elif tag not in VOID and not (attributes.endswith("/") and tag not in CLOSES_P and (tag not in INLINE or tag in EMBEDDED)):
                places.setdefault(tag, []).append(len(stack))
                stack.append(i)
                tags.append(tag)
        close(0)

    def features(self) -> np.ndarray:
        """One row per node."""
        n = len(self.tag)
        parent, page, end, depth = (np.array(x, np.int64) for x in (self.parent, self.page, self.end, self.depth))
        here = np.arange(n)
        is_text = np.array([t is not None for t in self.text])
        texts = [" ".join(t.split()) if t else "" for t in self.text]
        chars = np.fromiter(map(len, texts), np.float64, n)
        words = np.fromiter((t.count(" ") + (t != "") for t in texts), np.float64, n)
        marks = np.fromiter((t.count(".") + t.count(",") + t.count("!") + t.count("?") for t in texts), np.float64, n)
        group = np.array([GROUP_OF.get(t, N_GROUPS - 1) for t in self.tag])
        up = np.maximum(parent, 0)
        has_up = parent >= 0
        own = np.stack([np.array(self.content), np.array(self.chrome), np.array(self.hidden),
                        *(group == g for g in (0, 1, 2, 3, 4, 5))]).astype(np.float64)
        anchor = np.array([t == "a" for t in self.tag])

        def over(x: np.ndarray) -> np.ndarray:
            """The sum over what a node stands in: nodes count from the next one on, to where they end."""
            return np.cumsum(np.concatenate([[0.0], x]) - np.bincount(end, x, minlength=n + 1))[:n]

        above, link = np.stack([over(x) for x in own]), over(anchor.astype(np.float64)) > 0
        sub = lambda x: (c := np.concatenate([[0.0], np.cumsum(x)]))[end] - c[here]
        tag_is = lambda *names: np.array([t in names for t in self.tag], np.float64)
        s_chars, s_words, s_marks, s_link = sub(chars), sub(words), sub(marks), sub(chars * link)
        elements, runs = sub(~is_text), sub(is_text & (chars > 0))
        root = here[~has_up][page]
        before = np.concatenate([[0.0], np.cumsum(chars)])
        total = np.maximum(s_chars[root], 1.0)
        children = np.bincount(up[has_up], minlength=n).astype(np.float64)
        first = np.full(n, n)
        np.minimum.at(first, up[has_up], here[has_up])
        order = np.lexsort((here, parent))
        rank = np.zeros(n)
        starts = np.flatnonzero(np.r_[True, np.diff(parent[order]) != 0])
        rank[order] = here - np.repeat(starts, np.diff(np.r_[starts, n]))
        _, which, alike = np.unique(parent * N_GROUPS + group, return_inverse=True, return_counts=True)
        siblings = children[up]
        log = np.log1p
        columns = [log(s_chars), s_link / np.maximum(s_chars, 1), s_chars / np.maximum(elements, 1), log(s_words),
                   s_marks / np.maximum(s_words, 1), s_chars / np.maximum(runs, 1), depth, (before[here] - before[root]) / total,
                   (before[end] - before[root]) / total, s_chars / np.maximum(s_chars[up], 1), s_chars / total,
                   log(siblings), rank / np.maximum(siblings, 1), log(alike[which]), s_chars * siblings / np.maximum(s_chars[up], 1),
                   log(sub(tag_is("p"))), log(sub(tag_is("li"))), log(sub(group == 5)), log(sub(group == 9)), sub(own[1]),
                   *own[:3], *above, *(group == g for g in range(N_GROUPS)), *(group[up] == g for g in (6, 7, 8))]
        return np.stack([np.asarray(c, np.float32) for c in columns], axis=1)

    def positives(self) -> np.ndarray:
        """Training labels: does a node's subtree hold text of an element labelled 1?"""
        n = len(self.tag)
        state, text = np.zeros(n, bool), np.zeros(n)
        for i in range(n):
            own = self.label[i]
            state[i] = own == 1 if own >= 0 else (self.parent[i] >= 0 and state[self.parent[i]])
            text[i] = state[i] and self.text[i] is not None and not self.text[i].isspace()
        sums = np.concatenate([[0.0], np.cumsum(text)])
        return sums[np.array(self.end)] - sums[:n] > 0
