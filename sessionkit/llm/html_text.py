"""Main text of web pages by consensus host paths.

1. Each page is parsed into containers and text blocks.  Containers that are
   menus, headers, footers, sidebars, notices, adverts, forms or reader
   comments by their tag, role, class or id are left out with all they hold.
   A class or id alone does not leave out the page's text (``no-sidebar``,
   ``overflow-hidden``): what it names stays if it holds an ``article`` or
   ``main`` not shorter than any beside it, or, with none beside it, more text
   outside links than all that stays otherwise.  Reader comments stay only around an ``article`` or
   ``main`` that is no list of them (three quarters of the text of those held),
   or on a page of nothing else.
   Every other container is scored by the text it holds outside links; an
   ``article`` or ``main`` counts more, and a container gives way to one within
   only if nothing but link or left-out text lies beside that.
2. Each page votes for the generalised paths of its containers (tags and
   classes from the root, digits replaced) with their scores; votes are summed
   per host and path in Spark, so a host of any size is a few counts per task.
3. Pages are parsed again and take the text under their host's winning path.
   A page on which that path lacks an ``h1`` or more than a twentieth of the text
   of its own best container (another template) takes its own best container
   instead; boxes named as teasers of other texts are no lack, as long as the
   path holds a quarter.

Blocks keep page order and are joined by an empty line; character references
are decoded and white space inside a block becomes one space.  Null html is
empty text; a page without any text gives an empty string.  Pages without a
host vote as one host.  Repeated rows give repeated results; extra columns are
not read; an empty table gives no rows.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import only
from .url_filter import url_parts

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'<>`]+))""")
CLASS_PART = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
DIGITS = re.compile(r"\d+")

# Fixed values of the HTML standard.
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
        "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn",
          "em", "font", "i", "ins", "kbd", "label", "mark", "nobr", "q", "ruby", "rb", "rt", "rp",
          "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var"}
CLOSED_BY = {"p": None, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"},
             "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option", "optgroup"}}

# What is not main text, by tag, role and the parts of class and id names.
DROP_TAGS = {"nav", "header", "footer", "aside", "form", "button", "select", "noscript", "template",
             "dialog", "menu", "svg", "canvas", "object", "audio", "video", "head", "fieldset"}
DROP_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert",
              "alertdialog", "menu", "menubar", "toolbar", "form", "status"}
DROP_NAMES = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "sponsor",
              "sponsored", "promo", "promotion", "banner", "cookie", "cookies", "consent", "gdpr",
              "notice", "notices", "alert", "popup", "modal", "overlay", "sidebar", "rail", "menu",
              "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer", "header",
              "masthead", "disqus", "reply", "replies", "respond", "discussion", "share",
              "sharing", "social", "related", "recommended", "newsletter", "subscribe", "signup",
              "login", "widget", "pagination", "pager", "toolbar", "form", "search", "hidden",
              "disclaimer", "toc", "skip"}
DROP_STARTS = ("advert", "breadcrumb", "comment", "cookie", "newsletter", "sidebar", "sponsor")
COMMENT_NAMES = {"comment", "comments", "disqus", "reply", "replies", "respond", "discussion"}
COMMENTARY = {"commentary", "commentaries"}  # of the writer, not of readers
NEVER_DROP = {"html", "body", "main"}
TEASER_NAMES = {"teaser", "teasers", "related", "recommended", "promo", "sponsored"}
NAMED, COMMENTS = 1, 2  # containers that their class or id may leave out
BEST_TAGS = {"article", "main"}


class Page:
    """Containers (parents before children) and text blocks of one page."""

    def __init__(self, source: str):
        self.parent, self.tag, self.path, self.dropped = [-1], ["#root"], [""], [False]
        self.named, self.teaser = [0], [False]
        self.blocks: list = []  # (container, text, characters in links)
        self.stack = [0]
        self.text: list = []
        self.links = 0
        self.link_chars = 0
        self._parse(source)
        self._flush()
        if any(self.named):
            self._settle()

    def _flush(self):
        if self.text:
            text = " ".join("".join(self.text).split())
            if text and not self.dropped[self.stack[-1]]:
                self.blocks.append((self.stack[-1], text, min(self.link_chars, len(text))))
            self.text = []
        self.link_chars = 0

    def _add(self, raw: str):
        text = html.unescape(raw) if "&" in raw else raw
        self.text.append(text)
        if self.links:
            self.link_chars += len(text.strip())

    def _open(self, tag: str, attributes: str):
        names, role, classes = set(), "", []
        hidden = False
        if attributes:
            for m in ATTRIBUTE.finditer(attributes):
                key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
                if key in ("class", "id"):
                    names.update(x.lower() for x in CLASS_PART.findall(value))
                    if key == "class":
                        classes = sorted(value.split())
                elif key == "role":
                    role = value.strip().lower()
                elif key == "aria-hidden" and value.strip().lower() == "true":
                    hidden = True
                elif key == "style" and "display:none" in value.replace(" ", "").lower():
                    hidden = True
        top = self.stack[-1]
        out, named = False, 0
        if tag == "article":
            named = COMMENTS if names & COMMENT_NAMES else 0
        elif tag not in NEVER_DROP:
            out = tag in DROP_TAGS or hidden or role in DROP_ROLES
            if names & COMMENT_NAMES or any(n.startswith("comment") and n not in COMMENTARY
                                            for n in names):
                named = COMMENTS
            elif names & DROP_NAMES or any(n.startswith(DROP_STARTS) for n in names):
                named = NAMED
        self.parent.append(top)
        self.named.append(named)
        self.teaser.append(self.teaser[top] or bool(names & TEASER_NAMES))
        self.tag.append("main" if role == "main" else tag)
        self.dropped.append(self.dropped[top] or out)
        self.path.append(self.path[top] + "/" + ".".join([tag, *(DIGITS.sub("#", c) for c in classes)]))
        self.stack.append(len(self.tag) - 1)

    def _close(self, tag: str):
        for at in range(len(self.stack) - 1, 0, -1):
            if self.tag[self.stack[at]] == tag or self.path[self.stack[at]].rpartition("/")[2] \
                    .partition(".")[0] == tag:
                self.links = 0
                del self.stack[at:]
                return

    def _parse(self, source: str):
        at, end = 0, len(source)
        while at < end:
            m = TOKEN.search(source, at)
            if m is None:
                self._add(source[at:])
                return
            if m.start() > at:
                self._add(source[at:m.start()])
            at = m.end()
            name = m[2] or m[5]
            if name is None:  # a comment or declaration
                continue
            tag, closing = name.lower(), (m[1] or m[4]) == "/"
            if tag == "br":
                self.text.append(" ")
            elif tag in VOID and tag != "hr":  # an image does not end its block
                pass
            elif tag == "a":
                self.links = 0 if closing else 1
            elif tag in INLINE:
                pass
            elif tag in RAW:
                if not closing:
                    stop = re.compile(f"</{re.escape(tag)}(?=[\\s/>])[^>]*(?:>|\\Z)", re.I).search(
                        source, at)
                    at = stop.end() if stop else end
            elif closing:
                self._flush()
                self._close(tag)
            else:
                self._flush()
                if tag in VOID:
                    continue
                while len(self.stack) > 1:
                    top = self.tag[self.stack[-1]]
                    if top not in CLOSED_BY or not (CLOSED_BY[top] is None or tag in CLOSED_BY[top]):
                        break
                    self.stack.pop()
                self._open(tag, m[3] or "")

    def _settle(self):
        """Leave out the containers that their class or id names, but for those
        that hold the page's article, main or most of its text."""
        n, parent, named = len(self.tag), self.parent, self.named
        for i in range(1, n):
            if self.dropped[i]:
                named[i] = 0
        inside = [0] * n  # the innermost named container at or above
        for i in range(1, n):
            inside[i] = i if named[i] else inside[parent[i]]
        held, alone = [0] * n, [0] * n  # characters outside links; those of them in no named child
        for c, text, linked in self.blocks:
            held[c] += len(text) - linked
            alone[c] += len(text) - linked
        net = [0] * n  # by innermost named container
        for i in range(n):
            net[inside[i]] += held[i]
        longest, total = [0] * n, [0] * n  # of the articles and mains held
        rival = [0] * n  # the longest article or main in a named container and in none within
        for i in range(n - 1, 0, -1):
            if self.tag[i] in BEST_TAGS and held[i]:
                longest[i], total[i] = max(longest[i], held[i]), held[i]
                rival[inside[i]] = max(rival[inside[i]], alone[i])
            up = parent[i]
            if named[i] == COMMENTS and (4 * longest[i] <= 3 * total[i] or self.tag[i] == "article"):
                longest[i] = 0
                continue
            held[up] += held[i]
            if not named[i]:
                alone[up] += alone[i]
            longest[up] = max(longest[up], longest[i])
            total[up] += total[i]
        kept = {0}
        for i in range(1, n):
            up = inside[parent[i]]
            if named[i] and up in kept and longest[i] and longest[i] >= rival[up]:
                kept.add(i)
        live = sum(net[i] for i in kept)
        main = {i for i in range(1, n) if self.tag[i] in BEST_TAGS and alone[i] and inside[i] in kept}
        for i in sorted((i for i in range(1, n) if named[i] == NAMED and i not in kept),
                        key=lambda i: (-held[i], i)):
            if held[i] <= live:
                break
            up, above = parent[i], 0
            while up > 0 and above < len(main):
                above, up = above + (up in main), parent[up]
            if inside[parent[i]] in kept and above == len(main):
                kept.add(i)
                live += net[i]
        if not any(inside[c] in kept for c, _, _ in self.blocks):
            kept.update(i for i in range(n) if named[i] == COMMENTS)
        for i in range(1, n):
            self.dropped[i] = self.dropped[i] or self.dropped[parent[i]] \
                or bool(named[i]) and i not in kept
        self.blocks = [b for b in self.blocks if not self.dropped[b[0]]]

    # -- scores
    def weights(self) -> list:
        """Characters outside links under each container."""
        held = [0] * len(self.tag)
        for c, text, linked in self.blocks:
            held[c] += len(text) - linked
        for i in range(len(held) - 1, 0, -1):
            held[self.parent[i]] += held[i]
        return held

    def scores(self) -> dict:
        """Score of each container that may be the main one."""
        held = self.weights()
        return {i: held[i] / held[0] * (2.0 if self.tag[i] in BEST_TAGS else 1.0)
                for i in range(1, len(held))
                if not self.dropped[i] and held[i] and self.tag[i] != "p"}

    def best(self):
        """The main container: of those with the best score the one that holds
        most, and of those that hold the same the innermost."""
        scores, held = self.scores(), self.weights()
        return max(scores, key=lambda i: (scores[i], held[i], i)) if scores else 0

    def votes(self) -> dict:
        """Generalised path -> score, for containers of at least half the text;
        all but the best one at half their score."""
        out: dict = {}
        held, best = self.weights(), self.best()
        for i, s in self.scores().items():
            if 2 * held[i] >= held[0]:
                out[self.path[i]] = max(s if i == best else 0.5 * s, out.get(self.path[i], 0.0))
        return out

    def extract(self, path: str | None) -> str:
        """Text under the containers of ``path``, or under the best one."""
        inside = [p == path for p in self.path] if path else [False] * len(self.path)
        best = self.best()
        own = [i == best for i in range(len(self.path))]
        for i in range(1, len(inside)):
            inside[i] = inside[i] or inside[self.parent[i]]
            own[i] = own[i] or own[self.parent[i]]
        mine = [(c, len(t) - linked) for c, t, linked in self.blocks if own[c]]
        if not any(n for _, n in mine):  # a page of links
            mine = [(c, len(t)) for c, t, _ in self.blocks if own[c]]
        size = sum(n for _, n in mine)
        shared = sum(n for c, n in mine if inside[c])
        lost = [(c, n) for c, n in mine if not inside[c] and not self.teaser[c]]
        fits = 4 * shared > size and 20 * sum(n for _, n in lost) <= size \
            and not any(n and self.tag[c] == "h1" for c, n in lost)
        chosen = inside if fits else own
        return "\n\n".join(t for c, t, _ in self.blocks if chosen[c])


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, path): the path with the most votes of each host."""
    def run(batches):
        for b in batches:
            hosts, paths, scores = [], [], []
            for host, source in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for path, score in Page(source or "").votes().items():
                    hosts.append(host)
                    paths.append(path)
                    scores.append(score)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(paths, pa.string()),
                 pa.array(scores, pa.float64())], names=["host", "path", "score"])
    votes = only(pages, url=url_col, html=html_col).select(url_parts("url")[0].alias("host"), "html") \
        .mapInArrow(run, "host string, path string, score double")
    summed = votes.groupBy("host", "path").agg(F.sum("score").alias("score"))
    return materialize(summed.groupBy("host").agg(
        F.max(F.struct(F.round("score", 6).alias("score"), F.length("path").alias("size"),
                       "path")).alias("best"))
        .select("host", F.col("best.path").alias("path")), "host-paths")


TEXT_SCHEMA = "page_id bigint, url string, text string, n_chars bigint"


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
              html_col: str = "html") -> DataFrame:
    """Per page: page_id, url, text, n_chars (code points).

    The winners are a written table of one row per host: Spark broadcasts it
    while its size is below the broadcast threshold, and otherwise shuffles by
    host, splitting hot hosts."""
    def run(batches):
        for b in batches:
            texts = [Page(source or "").extract(path)
                     for source, path in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])
    rows = only(pages, page_id=id_col, url=url_col, html=html_col) \
        .withColumn("host", url_parts("url")[0])
    return rows.join(host_paths(pages, url_col, html_col), "host", "left") \
        .select("page_id", "url", "html", "path").mapInArrow(run, TEXT_SCHEMA)
