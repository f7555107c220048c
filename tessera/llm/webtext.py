"""Main text of web pages by consensus of their host.

Method: consensus host paths. Every page's containers are scored by the text they hold outside links and
boilerplate, and the page votes for the generalised tag-class path of its best one (digits of classes read
``#``). Spark counts the votes of each host; paths with an eighth of them win, so at most eight. Each page is
then extracted again: along its own path if that wins, else along the first winning path it has text under,
else (none, or no host) along its own.

A page is read once from left to right; the depth of open elements is bounded as in browsers, so the time
grows with the length of the page whatever it holds. Votes are counted before they are shuffled; the
winners (one row per host) are a written table whose size decides whether the join broadcasts it.

Defined cases: null html is empty; a page without text outside boilerplate gives an empty text; a null url or
one without ``://`` has no host, so its page goes by its own path; cut-off tags and comments end the page;
unclosed elements end with their parent; repeated pages vote each; an empty table gives no row; other
columns of the input are left out.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import row_slices, written

#: A winning path has at least one vote in so many.
SHARE = 8
#: Deeper elements are read, but not opened.
DEPTH = 512
#: Longest path and longest step of one.
STEPS, STEP_CHARS = 24, 60

# Element names of HTML by what they mean for the text.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea iframe noembed noframes xmp".split())
BLOCK = set("""address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 head header html legend li main menu nav ol optgroup option p pre section
    summary table tbody td tfoot th thead tr ul""".split())
CONTAINER = set("article body center div main section td".split())
NOT_TEXT = set("""aside audio button canvas datalist dialog footer form head menu nav noscript object select svg
    template video""".split())
NOT_TEXT_ROLES = set("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
#: What a new element ends, and where the search for it stops.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "tr": ({"tr"}, {"table", "tbody", "thead", "tfoot"}), "option": ({"option"}, {"select"})}
CELLS = {"td", "th"}
#: Words of class and id names that mark what is not the article.
NOT_TEXT_WORDS = set("""ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment
    comments commentlist consent cookie cookies disqus footer gdpr header login masthead menu menus modal nav navbar
    navigation newsletter notice notices overlay pager pagination popup promo promoted promotion recommended related
    replies reply respond share sharing sidebar signup social sponsor sponsored subscribe subscription teaser toolbar
    widget widgets""".split())
EXCUSED = {"has", "with", "no", "without"}
HEADLINE = {"article", "entry", "post", "story"}

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_REST = re.compile(r"""(?>(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')|=)*+)>""")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_RAW_END = {name: re.compile(f"</{name}(?=[\\s/>])", re.I) for name in RAW}
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_DIGITS = re.compile(r"\d+")
_HIDDEN = re.compile(r"display\s*:\s*none", re.I)


class Page:
    """Blocks and containers of one page, in page order.

    ``blocks``: (text, container, characters outside links, is a headline). ``containers``: parent, path and
    whether it is an article or main element; the root is number 0.
    """

    def __init__(self, html: str):
        self.blocks: list[tuple[str, int, int, bool]] = []
        self.parents, self.paths, self.marked = [-1], [""], [False]
        self._steps = [0]
        self._stack = [("", 0, False, False)]  # name, container, left out, in a link
        self._open: dict[str, int] = {}
        self._texts: list[str] = []
        self._plain, self._headline = 0, False
        self._read(html)
        self._flush()
        totals = [0] * len(self.parents)
        self.direct_headline = [False] * len(self.parents)
        for _, c, plain, headline in self.blocks:
            totals[c] += plain
            self.direct_headline[c] |= headline
        for c in range(len(totals) - 1, 0, -1):
            totals[self.parents[c]] += totals[c]
        #: Characters outside links and boilerplate under each container.
        self.totals = totals

    def _read(self, html: str) -> None:
        at, end = 0, len(html)
        while at < end:
            i = html.find("<", at)
            if i < 0:
                return self._text(html[at:])
            if i > at:
                self._text(html[at:i])
            tag = _TAG.match(html, i)
            if tag:
                rest = _REST.match(html, tag.end())
                if not rest:
                    return None
                at = rest.end()
                name = tag[2].lower()
                if tag[1]:
                    self._ended(name)
                elif name in RAW:
                    close = _RAW_END[name].search(html, at)
                    if not close:
                        return None
                    at = close.start()
                else:
                    self._started(name, html[tag.end():at - 1])
            elif html.startswith("<!--", i):
                at = html.find("-->", i + 2) + 3
                if at == 2:
                    return None
            elif html[i + 1:i + 2] in ("!", "?", "/"):
                at = html.find(">", i) + 1
                if not at:
                    return None
            else:
                self._text("<")
                at = i + 1
        return None

    def _text(self, text: str) -> None:
        _, _, out, link = self._stack[-1]
        if not out:
            text = entities.unescape(text) if "&" in text else text
            self._texts.append(text)
            if not link:
                self._plain += len(text) - text.count(" ")

    def _flush(self) -> None:
        text = " ".join("".join(self._texts).split())
        if text:
            self.blocks.append((text, self._stack[-1][1], self._plain, self._headline))
        self._texts, self._plain = [], 0

    def _pop(self, depth: int) -> None:
        """Ends all elements from ``depth`` of the stack on."""
        for name, *_ in self._stack[depth:]:
            self._open[name] -= 1
            if name in BLOCK:
                self._flush()
                if name == "h1":
                    self._headline = False
        del self._stack[depth:]

    def _find(self, names: set[str], stop) -> int:
        """Depth of the nearest open element of these names before one at which ``stop`` holds; 0 if none."""
        if not any(self._open.get(n) for n in names):
            return 0
        for depth in range(len(self._stack) - 1, 0, -1):
            name = self._stack[depth][0]
            if name in names:
                return depth
            if stop(name):
                return 0
        return 0

    def _started(self, name: str, attributes: str) -> None:
        if name in VOID:
            if name == "br":
                self._texts.append(" ")
            elif name == "hr":
                self._flush()
            return
        if name in BLOCK:
            depth = self._find({"p"}, BLOCK.__contains__)
            if depth:
                self._pop(depth)
            self._flush()
        if name in ENDS:
            same, stop = ENDS[name]
            depth = self._find(same, stop.__contains__)
            if depth:
                self._pop(depth)
        if len(self._stack) >= DEPTH:
            return
        _, container, out, link = self._stack[-1]
        found = {}
        if attributes and name != "a":
            found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
        out = out or self._left_out(name, found, container)
        if name in CONTAINER and not out:
            container = self._container(name, found.get("class", ""), container)
        if name == "h1":
            self._headline = True
        self._stack.append((name, container, out, link or name == "a"))
        self._open[name] = self._open.get(name, 0) + 1

    def _left_out(self, name: str, found: dict[str, str], container: int) -> bool:
        if name in NOT_TEXT or name == "header" and not self.marked[container]:
            return True
        if not found or name in ("html", "body", "main", "article"):
            return False
        if "hidden" in found or found.get("aria-hidden") == "true" or found.get("role", "").lower() in NOT_TEXT_ROLES:
            return True
        if _HIDDEN.search(found.get("style", "")):
            return True
        words = {w.lower() for w in _WORD.findall(f"{found.get('class', '')} {found.get('id', '')}")}
        hits = words & NOT_TEXT_WORDS
        if hits == {"header"} and words & HEADLINE:
            return False
        return bool(hits) and not words & EXCUSED

    def _container(self, name: str, classes: str, parent: int) -> int:
        step = ".".join([name, *sorted({_DIGITS.sub("#", c) for c in classes.split()})])[:STEP_CHARS]
        deep = self._steps[parent] >= STEPS
        self.parents.append(parent)
        self.paths.append(self.paths[parent] if deep else f"{self.paths[parent]}>{step}")
        self._steps.append(self._steps[parent] + 1)
        # inside an article or main element a header is the article's own
        self.marked.append(self.marked[parent] or name in ("article", "main"))
        return len(self.parents) - 1

    def _ended(self, name: str) -> None:
        if name == "br":
            self._texts.append(" ")
            return
        if name in BLOCK:
            inner = name not in ENDS and name not in ("table", "tbody", "thead", "tfoot", "html", "body")
            depth = self._find({name}, (lambda n: n in CELLS) if inner else (lambda n: n == "table" and name != "table"))
            if depth or name == "p":
                self._flush()
        else:
            depth = self._find({name}, BLOCK.__contains__)
        if depth:
            self._pop(depth)

    def best(self) -> str | None:
        """Path of the container that holds the article: from the root down to the child with at least half
        of the text, as far as an element that is marked as the article or holds the headline itself."""
        if not self.totals[0]:
            return None
        heaviest = [0] * len(self.parents)  # child with most text; the first of equals
        for c in range(1, len(self.parents)):
            p = self.parents[c]
            if not heaviest[p] or self.totals[c] > self.totals[heaviest[p]]:
                heaviest[p] = c
        c = 0
        while True:
            child = heaviest[c]
            if not child or 2 * self.totals[child] < self.totals[c]:
                return self.paths[c]
            marked = self.marked[c] and not (self.marked[child] and self.paths[child].rpartition(">")[2].startswith("article"))
            if marked or self.direct_headline[c] and self.parents[c] > 0:
                return self.paths[c]
            c = child

    def texts(self, path: str) -> list[str]:
        """Blocks under the containers of ``path``; a headline that stands before them goes with them."""
        under = [False] * len(self.parents)
        for c, p in enumerate(self.paths):
            under[c] = p == path or c > 0 and under[self.parents[c]]
        kept = [k for k, b in enumerate(self.blocks) if under[b[1]]]
        if kept and not any(self.blocks[k][3] for k in kept):
            kept = [k for k in range(kept[0]) if self.blocks[k][3]][-1:] + kept
        return [self.blocks[k][0] for k in kept]

    def holds(self, path: str) -> bool:
        return any(p == path and t for p, t in zip(self.paths, self.totals))


def main_text(page: Page, winners: list[str] | None) -> tuple[str, str | None]:
    """(text, path) of a page, given its host's winning paths by falling votes."""
    own = page.best()
    if own is None:
        return "", None
    path = own
    if winners and own not in winners:
        path = next((w for w in winners if page.holds(w)), own)
    return "\n\n".join(page.texts(path)), path


def host_of(url: str = "url"):
    """Host of a url, letters A-Z lower-cased; null without ``://`` or with nothing after it."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    host = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(host != "", host)


def _votes(batches):
    for batch in batches:
        for part in row_slices(batch):
            hosts, paths, sizes = [], [], []
            for host, html in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                page = Page(html or "")
                path = page.best()
                if path is not None:
                    hosts.append(host)
                    paths.append(path)
                    sizes.append(page.totals[0])
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(sizes, pa.int64())],
                                             names=["host", "path", "size"])


def winning_paths(pages: DataFrame) -> DataFrame:
    """(host, winners): the paths with at least one of ``SHARE`` votes of the host, by falling votes, then
    text, then path. ``pages`` has host and html."""
    votes = pages.where("host IS NOT NULL").select("host", "html").mapInArrow(_votes, "host string, path string, size long")
    counts = written(votes.groupBy("host", "path").agg(F.count(F.lit(1)).alias("votes"), F.sum("size").alias("size")), "votes")
    totals = counts.groupBy("host").agg(F.sum("votes").alias("all"))
    won = counts.join(totals, "host").where(F.col("votes") * SHARE >= F.col("all"))
    ranked = won.groupBy("host").agg(F.sort_array(F.collect_list(F.struct((-F.col("votes")).alias("v"), (-F.col("size")).alias("s"), "path"))).alias("w"))
    return ranked.select("host", F.col("w.path").alias("winners"))


_OUT = "page_id long, url string, text string, n_chars long, path string"


def _texts(batches):
    for batch in batches:
        for part in row_slices(batch):
            out = [main_text(Page(html or ""), winners)
                   for winners, html in zip(part.column(2).to_pylist(), part.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [part.column(0).cast(pa.int64()), part.column(1).cast(pa.string()), pa.array([t for t, _ in out], pa.string()),
                 pa.array([len(t) for t, _ in out], pa.int64()), pa.array([p for _, p in out], pa.string())],
                names=["page_id", "url", "text", "n_chars", "path"])


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars, path) of every page: its main text, blocks joined by an empty line, and
    the path it was found under."""
    hosted = pages.select("page_id", "url", host_of().alias("host"), "html")
    winners = written(winning_paths(hosted), "winners")
    joined = hosted.join(winners, "host", "left").select("page_id", "url", "winners", "html")
    return joined.mapInArrow(_texts, _OUT)
