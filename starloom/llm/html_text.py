"""Main text of web pages by host-wide consensus on the container that holds it.

Pass one scores the containers of every page by the share of the page's running text they
hold, how deep they are, and what they are called. Pages vote on generalised tag-class paths,
and Spark sums the votes per host and path. Pass two extracts each page again from the
containers at its host's winning path; a page without text there uses its own best container.
From there it climbs to the article or main element around them, so that a title or a lead
beside an inner content container is kept.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from starloom.llm.common import SLICE, slices, texts
from starloom.llm.url_filter import host_and_path
from starloom.session import stage

# HTML element names by their role.
CONTAINERS = frozenset("article body center div main section td".split())
BLOCKS = frozenset(
    "address blockquote caption dd details dl dt figcaption figure h1 h2 h3 h4 h5 h6 hgroup hr li ol p pre summary table tbody"
    " tfoot thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SPACING = frozenset("br img td th option".split())
DROPPED = frozenset("aside button datalist dialog footer form head header menu nav option select".split())
#: An opening tag of the key ends an open element of the value.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
DROPPED_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
# Words in class names and ids of what is not the article.
DROPPED_WORDS = frozenset(
    "ad ads adsbygoogle advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments consent"
    " cookie cookies discussion disqus footer form gdpr header login masthead menu modal nav navbar navigation newsletter notice"
    " notices notification overlay pager pagination popup promo promoted promotion recommended related replies reply respond"
    " search share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar topbar widget".split()
)
#: Words that say what part of a page an element is, and not what is in it.
PARTS = frozenset(
    "area article articles bar block box button buttons container content email field group holder icon icons inner item items left link"
    " links list main menu outer page panel post posts reader readers right row section site slot stories story thread top unit user users"
    " wrap wrapper".split()
)
#: One of these words and parts of a page written together, as in ``commentlist``.
_JOINED = re.compile(rf"(?:advert|breadcrumb|comment|cookie|footer|navbar|newsletter|sidebar|sponsor|subscribe)s?(?:{'|'.join(sorted(PARTS))})*")
#: Lists and tables, which are dropped only where all words of a name say so.
LISTS = frozenset("dl li ol table ul".split())
#: Headings of articles whose ids are made from their text.
HEADINGS = frozenset("discussion form notice notices search social".split())
#: Elements whose names count: containers and lists, not headings, paragraphs and inline elements.
NAMED = CONTAINERS - {"article", "body", "main"} | LISTS
#: A class name that starts so only says what is or isn't beside the element.
ABOUT_LAYOUT = frozenset("has is no not with without".split())
ARTICLE_WORDS = frozenset("article body content entry main post story text".split())
#: Of these, the ones whose container is the article and not only a part of it or of the page.
WHOLE_WORDS = frozenset("article entry post story".split())

#: A path names an element and so many of those around it, which bounds it on deeply nested pages.
LEVELS = 6

_NAME = r"([a-zA-Z][^\s/>]*)"
# an attribute list ends before the next tag, so that no tag is looked for beyond it
_ATTRIBUTES = r"((?:\"[^\"<]*\"|'[^'<]*'|[^<>\"'])*+)"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|textarea|iframe|svg|title|audio|video|canvas)\b[^>]*>.*?(?:</\1\b[^>]*>|\Z)"
    r"|<[!?][^>]*>"
    rf"|<(/?){_NAME}(?:{_ATTRIBUTES}|([^>]*))>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""(?:^|(?<=[\s"'/]))([^\s=/"'>]++)\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s"'>]++))|(\bhidden\b)""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


#: A form around an article, as some page frameworks make.
_WRAPPED = re.compile(r"(?:(?!/?form\b)[^<]*<)*?(?:article|main|h1)\b", re.I)


def _furniture(word: str) -> bool:
    return word in DROPPED_WORDS or _JOINED.fullmatch(word) is not None


class Page:
    """Containers (path, parent, depth, factor) and text blocks (container, text, characters in links) of a page."""

    def __init__(self, html: str) -> None:
        self.containers: list[tuple[str, int, int, float]] = [("body", -1, 0, 1.0)]
        #: Per container 2 for an article element, 1 for main and what is named like an article, else 0.
        self.kinds = [0]
        self.blocks: list[tuple[int, str, int]] = []
        #: Elements with names of what is no article, by the one around each, and what stands in them.
        self._named_in: list[int] = []
        self._held_in: list[int] = [-1]
        self._found: list[tuple[int, str, int, int]] = []
        self._read(html)
        self._drop_named()

    def _read(self, html: str) -> None:
        stack: list[tuple[str, int, bool, bool, int]] = []  # name, container, dropped, in a link, in a named element
        container, dropped, linked, named = 0, False, False, -1
        pieces: list[str] = []
        link_size = at = 0

        def flush() -> None:
            nonlocal link_size
            if pieces:
                text = " ".join("".join(pieces).split())
                if text:
                    self._found.append((container, text, min(link_size, len(text)), named))
                pieces.clear()
            link_size = 0

        def add(text: str) -> None:
            nonlocal link_size
            if text and not dropped:
                text = unescape(text) if "&" in text else text
                pieces.append(text)
                link_size += len(text) if linked else 0

        def state() -> tuple[int, bool, bool, int]:
            return stack[-1][1:] if stack else (0, False, False, -1)

        # where elements of a name are open, and where such are that end the search for an element to close
        places: defaultdict[str, list[int]] = defaultdict(list)
        bounds: list[int] = []

        def leave(depth: int) -> None:
            for element in reversed(stack[depth:]):
                places[element[0]].pop()
            del stack[depth:]
            while bounds and bounds[-1] >= depth:
                bounds.pop()

        # without a closing bracket behind it a "<" is text
        for token in _TOKEN.finditer(html, 0, html.rfind(">") + 1):
            add(html[at : token.start()])
            at = token.end()
            name = token[3]
            if name is None:
                continue
            name = name.lower()
            if token[2]:
                if places[name]:
                    depth = places[name][-1]
                    if any(s[0] in CONTAINERS or s[0] in BLOCKS or s[2] for s in stack[depth:]):
                        flush()
                    leave(depth)
                    container, dropped, linked, named = state()
                continue
            block = name in BLOCKS or name in CONTAINERS or name in DROPPED
            closing = CLOSES.get(name, set()) | ({"p"} if block else set()) | ({"head"} if name == "body" else set())
            if closing:
                depth = max((places[c][-1] for c in closing if places[c]), default=-1)
                if depth >= (bounds[-1] if bounds else 0):
                    flush()
                    leave(depth)
                    container, dropped, linked, named = state()
            if block:
                flush()
            if name in SPACING:
                add(" ")
            if name in VOID or (token[4] or token[5] or "").endswith("/"):
                continue
            classes, out, marked = self._named(name, token[4] if token[4] is not None else token[5] or "", bool(places["article"]))
            if out and name == "form" and _WRAPPED.match(html, at):
                out = False
            if out and not dropped:
                flush()
            dropped = dropped or out
            if marked and not dropped:
                flush()
                self._named_in.append(named)
                named = len(self._named_in) - 1
            linked = linked or name == "a"
            if name in CONTAINERS and not dropped:
                container = self._container(name, classes, container)
                if len(self._held_in) < len(self.containers):
                    self._held_in.append(named)
            places[name].append(len(stack))
            if name in CONTAINERS or name in ("ul", "ol", "table", "dl"):
                bounds.append(len(stack))
            stack.append((name, container, dropped, linked, named))
        add(html[at:].partition("<!--")[0])
        flush()

    def _drop_named(self) -> None:
        """Leave out the text of named elements, but not of one around the article: main, or an article with as much text as stands outside."""
        held = [0] * len(self.containers)
        outside = 0
        for container, text, links, named in self._found:
            if 2 * links <= len(text):
                held[container] += len(text)
                outside += len(text) if named < 0 else 0
        for i in range(len(held) - 1, 0, -1):
            held[self.containers[i][1]] += held[i]
        around = [False] * len(self._named_in)
        articles = [i for i, kind in enumerate(self.kinds) if kind == 2]
        largest = max(articles, key=lambda i: held[i], default=-1)
        for i, named in enumerate(self._held_in):
            name = self.containers[i][0].split(">")[-1].split(".")[0]
            if name == "main" and held[i] or i == largest and held[i] >= outside:
                while named >= 0 and not around[named]:
                    around[named] = True
                    named = self._named_in[named]
        if largest < 0 and self._named_in and not any(self.kinds[i] and held[i] for i in range(len(held)) if self._held_in[i] < 0):
            self._keep_most(around)
        dropped = [False] * len(self._named_in)
        for i, outer in enumerate(self._named_in):
            dropped[i] = not around[i] or outer >= 0 and dropped[outer]
        self.blocks = [block[:3] for block in self._found if block[3] < 0 or not dropped[block[3]]]
        self._found = []

    def _keep_most(self, around: list[bool]) -> None:
        """Mark named elements with over half of the page's running text, in several blocks, where nothing is called an article."""
        sizes, blocks, total = [0] * len(around), [0] * len(around), 0
        for _, text, links, named in self._found:
            if 2 * links <= len(text):
                total += len(text)
                if named >= 0:
                    sizes[named] += len(text)
                    blocks[named] += 1
        for i in range(len(around) - 1, -1, -1):
            around[i] = around[i] or blocks[i] > 1 and 2 * sizes[i] > total
            if self._named_in[i] >= 0:
                sizes[self._named_in[i]] += sizes[i]
                blocks[self._named_in[i]] += blocks[i]

    def _named(self, name: str, attributes: str, in_article: bool) -> tuple[str, bool, bool]:
        """Generalised class text of an element, whether it is no part of an article, and whether its names say so.

        One word of a class will do for a container outside an article; inside one, and for lists and tables, all
        words of the class must be furniture or parts of a page.
        """
        out, marked = name in DROPPED, False
        if not attributes.strip():
            return "", out, marked
        values = {}
        for m in _ATTRIBUTE.finditer(attributes):
            values[(m[1] or m[5]).lower()] = m[2] or m[3] or m[4] or ""
        classes = values.get("class", "").split()
        if name in NAMED:
            for label in classes:
                words = [w.lower() for w in _WORD.findall(label)]
                told = not (in_article or name in LISTS) or all(w in PARTS or _furniture(w) for w in words)
                marked = marked or told and bool(words) and words[0] not in ABOUT_LAYOUT and any(map(_furniture, words))
            for label in values.get("id", "").split():
                words = [w.lower() for w in _WORD.findall(label)]
                known = bool(words) and all(w in PARTS or _furniture(w) for w in words) and any(map(_furniture, words))
                marked = marked or known and not (len(words) == 1 and words[0] in HEADINGS)
        if name not in ("html", "body", "main", "article"):
            out = out or values.get("role", "").lower() in DROPPED_ROLES or values.get("aria-hidden") == "true"
            out = out or "hidden" in values or re.search(r"display\s*:\s*none", values.get("style", "")) is not None
        general = sorted({re.sub(r"\d+", "0", c.lower()) for c in classes})
        return "".join(f".{c}" for c in general), out, marked

    def _container(self, name: str, classes: str, parent: int) -> int:
        path, _, depth, _ = self.containers[parent]
        if name == "body":
            self.containers[0] = ("body" + classes, -1, 0, 1.0)
            return 0
        words = set(_WORD.findall(classes)) | {name}
        factor = 1.5 if words & ARTICLE_WORDS else 1.0
        self.kinds.append(2 if name == "article" else int(name == "main" or bool(words & WHOLE_WORDS)))
        steps = path.split(">")[-LEVELS:]
        self.containers.append((">".join([*steps, name + classes]), parent, depth + 1, factor))
        return len(self.containers) - 1

    def scores(self) -> dict[str, float]:
        """Score of every path: its best container by text share, depth and name. Blocks made of links don't count."""
        held = [0] * len(self.containers)
        for container, text, links in self.blocks:
            if 2 * links <= len(text):
                held[container] += len(text)
        for i in range(len(held) - 1, 0, -1):
            held[self.containers[i][1]] += held[i]
        found: dict[str, float] = {}
        for (path, _, depth, factor), size in zip(self.containers, held):
            if size:
                share = size / held[0]
                found[path] = max(found.get(path, 0.0), share * share * (1 + 0.25 * depth) * factor)
        return found

    def text(self, path: str | None) -> str:
        """Blocks of the article around the containers at ``path``; without text there, around the best one of the page."""
        inside = self._inside(path) if path is not None else []
        if not inside and self.blocks:
            scores = self.scores()
            inside = self._inside(max(scores, key=lambda p: (scores[p], p))) if scores else [b[1] for b in self.blocks]
        return "\n\n".join(inside)

    def _below(self, tops: set[int]) -> list[bool]:
        """Whether each container is one of ``tops`` or inside one."""
        within = [False] * len(self.containers)
        for i, (_, parent, _, _) in enumerate(self.containers):
            within[i] = i in tops or (parent >= 0 and within[parent])
        return within

    def _inside(self, path: str) -> list[str]:
        found = {i for i, c in enumerate(self.containers) if c[0] == path}
        within = self._below(found)
        if not any(within[container] for container, _, _ in self.blocks):
            return []
        within = self._below(self._around(found))
        return [text for container, text, _ in self.blocks if within[container]]

    def _around(self, found: set[int]) -> set[int]:
        """The outermost article around each of ``found``, and main or a container named like an article around that.

        The latter only counts if it adds neither blocks made of links nor other articles.
        """
        article, tops = [-1] * len(self.containers), set()
        for i, (_, parent, _, _) in enumerate(self.containers):
            article[i] = article[parent] if parent >= 0 and article[parent] >= 0 else i if self.kinds[i] == 2 else -1
            if i in found:
                tops.add(article[i] if article[i] >= 0 else i)
        within = self._below(tops)
        other = [int(kind == 2 and not inside) for kind, inside in zip(self.kinds, within)]
        for container, text, links in self.blocks:
            other[container] += 2 * links > len(text) and not within[container]
        holds = [i in tops for i in range(len(within))]
        for i in range(len(within) - 1, 0, -1):
            other[self.containers[i][1]] += other[i]
            holds[self.containers[i][1]] |= holds[i]
        return tops | {i for i, kind in enumerate(self.kinds) if kind == 1 and holds[i] and not other[i]}


def container_votes(html: Column) -> Column:
    """The page's paths and their shares of its vote."""

    @arrow_udf("array<struct<path:string,vote:double>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("path", pa.string()), ("vote", pa.float64())]))
        for part in slices(batches):
            rows = []
            for page in texts(part):
                scores = Page(page).scores()
                total = sum(scores.values())
                rows.append([{"path": p, "vote": s / total} for p, s in scores.items()])
            yield pa.array(rows, kind)

    return run(html)


def main_text(html: Column, path: Column) -> Column:
    @arrow_udf("string")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for pages, paths in batches:
            for i in range(0, len(pages), SLICE):
                rows = zip(texts(pages.slice(i, SLICE)), paths.slice(i, SLICE).to_pylist())
                yield pa.array([Page(h).text(p) for h, p in rows], pa.string())

    return run(html, path)


def winning_paths(pages: DataFrame) -> DataFrame:
    """(``host``, ``path``) with the largest sum of votes per host; ties go to the larger path."""
    host, _ = host_and_path(F.col("url"))
    votes = pages.select(host.alias("host"), F.explode(container_votes(F.col("html"))).alias("v"))
    summed = votes.groupBy("host", "v.path").agg(F.round(F.sum("v.vote"), 6).alias("votes"))
    return summed.groupBy("host").agg(F.max(F.struct("votes", "path")).alias("best")).select("host", "best.path")


def extracted(pages: DataFrame) -> DataFrame:
    """Per row of ``pages``: ``page_id``, ``url``, ``text``, ``n_chars`` (code points).

    Null html counts as empty and gives the empty text; pages without a host vote together.
    Repeated rows are kept, other columns are not read; empty table: no rows. The winners
    are one row per host and are joined on the host, so a host with many pages is split.
    """
    rows = pages.select("page_id", "url", "html")
    best = stage(winning_paths(rows), "html-paths").withColumnRenamed("host", "of_host")
    host, _ = host_and_path(F.col("url"))
    joined = rows.withColumn("host", host).join(best, F.col("host") == F.col("of_host"), "left")
    found = joined.select("page_id", "url", main_text(F.col("html"), F.col("path")).alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("long"))
