"""HTML extraction by equivalence-class template deduction.

A page is read as tokens: tags and text segments, each told apart by its path of elements
(name, class, id). Over the pages of a host, a token's occurrence vector (its count on each
page) is reduced to sums of page hashes, which tasks add before the shuffle; tokens of equal
vectors form an equivalence class. Classes that are frequent, large and nested (each token's
enclosing element is a token of the template) make the host's template. What is
left of a page is its slots: runs of text between template tokens. A slot's role follows
from the template's elements around it: slots of menus, headers, footers, sidebars,
notices, adverts, forms and reader comments go, and of the rest those in the page's
articles stay: the largest, and the others unless more than in it is template text or links. In them an element that holds template text only, so no slot, is a notice or
advert of the host and goes, whatever it is named; a repeated paragraph or heading between
slots is the article's own and stays. Where pages mark no article, the deepest element that
holds most of the host's slot text outside links stays, and elements named as content with it.

Copies of a page count once for its host's template, so that an article is never taken for
a template because it was published twice.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, sliced, table
from .url_filter import host_of

#: Pages of a host that a template needs, its least share of them, and the least size of a class.
LEAST_PAGES = 4
SUPPORT = 0.5
CLASS_SIZE = 3
#: Share of a host's slot text that its main element holds.
MAIN_SHARE = 0.7
#: Templates are broadcast up to so many tokens in all; beyond, pages are joined with them by host.
BROADCAST_TOKENS = 1 << 20

# A quoted value is bounded here, so that quotes without an end cost no scan of the whole page for each tag; ``_Ends`` reads the tags with longer ones.
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]{0,20000}"|'[^']{0,20000}')*)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)>|<[!?/][^>]*>""", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_SIGN = re.compile(r"[\"'>]")
_NAMES = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
# Elements of HTML by their kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Elements of running text: alone they are no part of a page's structure.
FLOW = INLINE | frozenset("p h1 h2 h3 h4 h5 h6 hgroup pre blockquote li dt dd caption thead tbody tfoot tr td th figcaption summary".split())
DROPPED = frozenset("head nav footer aside form menu dialog template noscript svg canvas object audio video select button script style textarea title xmp iframe noembed noframes datalist fieldset".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead"}, "body": {"head"}}
SCOPES = frozenset("ul ol dl table article section div main body".split())
# Words in class and id names, and roles, of elements that are no article text.
BOILERPLATE = frozenset("ad ads adv advert adverts advertisement advertising adsense banner banners sponsor sponsored promo promotion promoted sidebar sidebars sidenav menu menus nav navbar navigation breadcrumb breadcrumbs footer foot masthead topbar cookie cookies consent gdpr notice notices alert alerts popup modal overlay newsletter subscribe subscription signup share sharing social related recommended recommendations comment comments commentlist disqus discussion replies respond pagination pager widget widgets toolbar login search skip disclaimer copyright paywall".split())
#: Those of them that also name sections of a text; there its template text, links and forms decide.
AMBIGUOUS = frozenset("discussion related recommendations social search copyright disclaimer consent advertising promotion".split())
COMMENTS = frozenset("comment comments commentlist disqus replies reply respond".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
MAIN_NAMES = frozenset("article content main post entry story".split())


def _digest(text: str, seed: int = 0) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"), seed & 0xFFFFFFFFFFFFFFFF)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


class _Element:
    __slots__ = ("name", "path", "dropped", "article", "main", "link", "depth", "parent", "framed", "heading", "doubtful", "hinted", "answers", "chars", "repeated", "linked", "titles", "title_links", "inside", "gone")

    def __init__(self, name, path, dropped, article, main, link, depth, parent=None, framed=False, doubtful=False):
        self.name, self.path, self.dropped, self.article, self.main, self.link, self.depth = name, path, dropped, article, main, link, depth
        #: Whether it has a class, an id or blocks of its own, is in a heading, has an ambiguous name, is in such an element, and holds a form or comments.
        self.parent, self.framed, self.doubtful, self.answers = parent, framed, doubtful, False
        self.heading = name in HEADINGS or parent is not None and parent.heading
        self.hinted = doubtful or parent is not None and parent.hinted
        #: Its characters, those of the template and in links, of headings and in their links.
        self.chars = self.repeated = self.linked = self.titles = self.title_links = 0
        #: Whether it is within the page's main text, and whether it is boilerplate.
        self.inside, self.gone = False, None

    def marks(self) -> set[str]:
        """What tells that the element is a list of links, a teaser or the template's."""
        found = {"template": self.repeated == self.chars, "links": 2 * self.linked >= self.chars, "title": 0 < self.titles == self.title_links, "answers": self.answers}
        return {k for k, v in found.items() if v}


class _Ends:
    """Ends of a page's tags, past quoted values of any length.

    A tag whose quotes have no end or no ``>`` after them has none. The quotes that such a tag
    opened are kept: a later tag that opens one of them has no end either, so that all tags
    together read the page a few times at most.
    """

    def __init__(self, source: str):
        self._source, self._vain = source, set()
        self._last = {q: source.rfind(q) for q in "\"'"}

    def of(self, at: int) -> int:
        """Place of the ``>`` that ends the tag whose attributes start at ``at``, or -1."""
        opened = []
        while m := _SIGN.search(self._source, at):
            at = m.start()
            if m[0] == ">":
                return at
            if at in self._vain or at >= self._last[m[0]]:
                break
            opened.append(at)
            at = self._source.find(m[0], at + 1) + 1
        self._vain.update(opened)
        return -1


class Page:
    """Tag tokens (path hash and its parent's) and text segments of one page."""

    def __init__(self, source: str | None):
        self.tags: list[tuple[int, int]] = []
        #: (text, enclosing element, number of the block)
        self.segments: list[tuple[str, _Element, int]] = []
        self._block = self._articles = 0
        self._found: dict[_Element, bool] = {}
        self._stack = [_Element("", 0, False, 0, 0, False, 0)]
        self._read(source or "")

    def _open(self, name: str, attributes: str) -> None:
        stack = self._stack
        if name not in INLINE:
            self._block += 1
            if name not in VOID or name == "hr":
                self._close_implied({"p"} if name not in CLOSES else CLOSES[name] | {"p"})
        if name in VOID:
            return
        top = stack[-1]
        names: set[str] = set()
        ids: set[str] = set()
        marks = role = ""
        hidden = framed = False
        for m in _ATTRIBUTE.finditer(attributes):
            key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if key in ("class", "id"):
                found = _NAMES.findall(_CAMEL.sub(" ", value).lower())
                names.update(found)
                ids.update(found if key == "id" or name == "section" else ())
                framed |= bool(value.strip())
                marks += f".{value}" if not any(c.isdigit() for c in value) else ""
            elif key == "role":
                role = value.lower().strip()
            elif key == "style":
                hidden |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I))
            elif key == "hidden" or value.lower() == "true":
                hidden = True
        path = _digest(name + marks, top.path)
        whole = name in ("html", "body", "article", "main")
        words = set() if whole else names & BOILERPLATE
        doubtful = bool(words) and words <= AMBIGUOUS & ids
        dropped = top.dropped or name in DROPPED or hidden or role in ROLES or (name == "header" and not top.article) or (bool(words) and not doubtful) or (name == "article" and bool(names & {"comment", "comments", "ad", "advert", "related", "promo", "teaser"}))
        article = top.article
        if name == "article" and not article and not dropped and not top.hinted:
            self._articles += 1
            article = self._articles
        main = max(top.main, 2 if name == "main" or role == "main" else 1 if name in ("div", "section", "td") and names & MAIN_NAMES else 0)
        top.framed |= name not in INLINE
        if top.hinted and (name in ("form", "textarea") or names & COMMENTS):
            for e in stack:
                e.answers |= e.doubtful
        stack.append(_Element(name, path, dropped, article, main, top.link or name == "a", top.depth + 1, top, framed, doubtful))
        self.tags.append((path, top.path))

    def _close_implied(self, names: set[str]) -> None:
        stack = self._stack
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].name in names:
                del stack[i:]
                names = names - {"p"}
                continue
            if stack[i].name in SCOPES:
                return

    def _close(self, name: str) -> None:
        stack = self._stack
        if name not in INLINE:
            self._block += 1
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].name == name:
                del stack[i:]
                return
            if name in INLINE and stack[i].name not in INLINE:
                return

    def _text(self, text: str) -> None:
        if text:
            self.segments.append((text, self._stack[-1], self._block))

    def _read(self, source: str) -> None:
        at, lower, ends = 0, None, None
        end_of_tags = source.rfind(">") + 1  # behind it no tag can end, and looking for one would scan the rest for each
        while m := _TAG.search(source, at, end_of_tags):
            self._text(source[at : m.start()])
            at = m.end()
            if m[0].startswith("<!--") and not m[0].endswith("-->"):
                at = len(source)
                break
            name = (m[2] or m[5] or "").lower()
            if not name:
                continue
            attributes = m[3] or m[6] or ""
            if m[5] and ('"' in attributes or "'" in attributes):
                ends = ends or _Ends(source)
                if (end := ends.of(m.start(6))) >= 0:
                    attributes, at = source[m.start(6) : end], end + 1
            if m[1] or m[4]:
                self._close(name)
                continue
            self._open(name, attributes)
            if name in RAW:
                lower = source.lower() if lower is None and source.isascii() else lower
                end = lower.find(f"</{name}", at) if lower is not None else next((x.start() for x in re.compile(f"</{name}", re.I).finditer(source, at)), -1)
                at = len(source) if end < 0 else end
            elif attributes.endswith("/") and name in ("svg", "path"):
                self._close(name)
        self._text(source[at:].partition("<!--")[0])

    def tokens(self) -> dict[int, tuple[int, int, bool]]:
        """Token: (count, token of the enclosing element, whether it is text)."""
        counts = Counter(path for path, _ in self.tags)
        out = {path: (counts[path], parent, False) for path, parent in self.tags}
        texts = Counter((e.path, " ".join(t.split())) for t, e, _ in self.segments)
        for (path, text), n in texts.items():
            if text:
                out[_digest(text, path ^ 0x5BD1E995)] = (n, path, True)
        return out

    def masses(self) -> dict[int, tuple[int, int]]:
        """Slot text outside links and dropped elements: (characters, depth) of each enclosing block element."""
        own: Counter[_Element] = Counter()
        for text, element, _ in self.segments:
            if not element.dropped and not element.hinted and not element.link:
                own[element] += len(text.strip())
        out: dict[int, list[int]] = {}
        for element in _inner_first(own):
            out.setdefault(element.path, [0, element.depth])[0] += own[element]
            if element.parent is not None:
                own[element.parent] += own[element]
        return {p: (n, d) for p, (n, d) in out.items() if n}

    def _within(self, element: _Element | None, main: int) -> bool:
        """Whether the element or one around it has the path; what is found is kept, so that no element is asked twice."""
        chain = []
        while element is not None and element not in self._found and element.path != main:
            chain.append(element)
            element = element.parent
        found = element is not None and (element.path == main or self._found.get(element, False))
        self._found.update(dict.fromkeys(chain, found))
        return found

    def _weigh(self, kept: list, template: set[int]) -> None:
        """Counts the text of each element, what of it the template holds, and what is in links and headings."""
        held: set[_Element] = set()
        for text, element, _ in kept:
            if words := text.split():
                n = sum(map(len, words))
                known = n if template and _digest(" ".join(words), element.path ^ 0x5BD1E995) in template else 0
                held.add(element)
                element.chars += n
                element.repeated += known
                element.linked += n * element.link
                element.titles += (n - known) * element.heading
                element.title_links += (n - known) * (element.heading and element.link)
        for element in _inner_first(held):
            if (up := element.parent) is not None:
                for field in ("chars", "repeated", "linked", "titles", "title_links"):
                    setattr(up, field, getattr(up, field) + getattr(element, field))

    def _gone(self, element: _Element, main: int | None) -> bool:
        """Whether the element, or one around it, is boilerplate by the host's template, its links or its forms."""
        chain = []
        while element is not None and element.gone is None:
            chain.append(element)
            element = element.parent
        gone = element is not None and element.gone
        for e in reversed(chain):
            up = e.parent
            e.inside = up is not None and bool(up.inside or up.article or up.main == 2 or (main and up.path == main))
            filled = up is not None and up.article and e.framed and e.name not in FLOW and 0 < e.chars == e.repeated
            gone = e.gone = bool(gone or filled or (e.doubtful and (not e.inside or e.marks())))
        return gone

    def _articles_of(self, kept: list) -> set[int]:
        """Numbers of the articles that stay: the largest, and those that no mark tells from it."""
        tops: dict[int, _Element] = {}
        for _, element, _ in kept:
            if element.article and element.article not in tops:
                while element.parent.article:
                    element = element.parent
                tops[element.article] = element
        best = max(tops, key=lambda a: (tops[a].chars, -a))
        return {a for a, e in tops.items() if a == best or e.marks() <= tops[best].marks()}

    def extract(self, template: set[int], main: int | None) -> str:
        kept = [s for s in self.segments if not s[1].dropped]
        self._weigh(kept, template)
        if any(s[1].article for s in kept):
            articles = self._articles_of(kept)
            kept = [s for s in kept if s[1].article in articles]
            return _joined([s for s in kept if not self._gone(s[1], main)]) or _joined(kept)
        kept = [s for s in kept if not self._gone(s[1], main)]
        level = max((s[1].main for s in kept if s[0].strip()), default=0)
        held = [s for s in kept if main is not None and self._within(s[1], main)]
        if level < 2 and held and not self._whole(held, main):
            kept = [s for s in kept if s[1].main or self._within(s[1], main)]
        elif level:
            kept = [s for s in kept if s[1].main == level]
        # A block is template text only where all of it is.
        own = {block for text, element, block in kept if text.strip() and _digest(" ".join(text.split()), element.path ^ 0x5BD1E995) not in template}
        return _joined([s for s in kept if s[2] in own]) or _joined(kept)

    def _whole(self, held: list, main: int) -> bool:
        """Whether the main element is the whole page and elements named as content hold half of it: these tell more."""
        top = held[0][1]
        while top.path != main:
            top = top.parent
        named = sum(len(s[0].strip()) for s in held if s[1].main)
        return top.name in ("", "html", "body") and 2 * named >= sum(len(s[0].strip()) for s in held)


def _inner_first(elements: Iterable[_Element]) -> Iterator[_Element]:
    """The elements and all around them, each once and before the one around it."""
    levels: dict[int, set[_Element]] = {}
    for element in elements:
        levels.setdefault(element.depth, set()).add(element)
    for depth in range(max(levels, default=-1), -1, -1):
        for element in levels.get(depth, ()):
            if element.parent is not None:
                levels.setdefault(depth - 1, set()).add(element.parent)
            yield element


def _joined(segments: list) -> str:
    blocks: dict[int, list[str]] = {}
    for text, _, block in segments:
        blocks.setdefault(block, []).append(text)
    return " ".join(x for x in (" ".join(entities.unescape("".join(b)).split()) for b in blocks.values()) if x)


TOKENS = "host string, page long, token long, parent long, n int, is_text boolean, mass long, depth int"


def _tokens(pages: DataFrame) -> DataFrame:
    """Tokens of each page, and with a null token the text mass of its elements (as parent)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 50):
            rows = []
            for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                page, key = Page(source), _signed(_digest(source))
                rows += [(host, key, _signed(t), _signed(parent), n, text, None, None) for t, (n, parent, text) in page.tokens().items()]
                rows += [(host, key, None, _signed(p), None, None, n, d) for p, (n, d) in page.masses().items()]
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 8, kinds)], names=["host", "page", "token", "parent", "n", "is_text", "mass", "depth"])

    return pages.filter("host <> '' AND html IS NOT NULL").select("host", "html").mapInArrow(run, TOKENS)


def templates(scratch: Scratch, pages: DataFrame) -> DataFrame:
    """(host, tokens, main) of hosts with a template or a main element, from ``pages`` (host, html)."""
    rows = scratch.cut(_tokens(pages).distinct(), "tokens")
    sizes = scratch.cut(rows.filter("token IS NULL AND depth = 0").groupBy("host").agg(F.count(F.lit(1)).alias("pages"), F.sum("mass").alias("whole")), "sizes")
    sizes = sizes.filter(F.col("pages") >= LEAST_PAGES)
    at = F.pmod(F.xxhash64("page"), F.lit(1 << 31))
    other = F.pmod(F.xxhash64("page", F.lit(1)), F.lit(1 << 31))
    vectors = rows.filter("token IS NOT NULL").groupBy("host", "token", "parent", "is_text").agg(F.count(F.lit(1)).alias("support"), F.sum("n").alias("total"), F.sum(at * F.col("n")).alias("v1"), F.sum(other * F.col("n")).alias("v2"))
    frequent = scratch.cut(vectors.join(sizes.select("host", "pages"), "host").filter(F.col("support") >= F.greatest(F.lit(LEAST_PAGES), F.col("pages") * SUPPORT)), "frequent")
    key = ["host", "support", "total", "v1", "v2"]
    large = frequent.groupBy(*key).agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") >= CLASS_SIZE)
    valid = frequent.join(large, key).select("host", "token", "parent")
    nested = valid.join(frequent.filter("NOT is_text").select("host", F.col("token").alias("parent")), ["host", "parent"], "left_semi").unionByName(valid.filter("parent = 0"))
    tokens = nested.groupBy("host").agg(F.collect_set("token").alias("tokens"))  # at most tokens of a page / SUPPORT
    masses = rows.filter("token IS NULL").groupBy("host", "parent").agg(F.sum("mass").alias("mass"), F.max("depth").alias("depth"))
    main = masses.join(sizes, "host").filter(F.col("mass") >= MAIN_SHARE * F.col("whole")).groupBy("host").agg(F.max_by("parent", "depth").alias("main"))
    return scratch.cut(sizes.select("host").join(tokens, "host", "left").join(main, "host", "left"), "templates")


def extract(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: one row per row of ``pages`` (page_id, url, html).

    Null and empty html gives an empty text. A page whose url has no host, and one of a host
    with fewer than ``LEAST_PAGES`` different pages, has no template: its elements' roles
    alone decide. Character references are decoded; blocks are joined by one space, runs of
    white space are one space. Repeated rows and ids stay; other columns are ignored.
    """
    scratch = Scratch(spark, "html-extract")
    pages = pages.select("page_id", "url", F.col("html").cast("string").alias("html"), host_of(F.col("url")).alias("host"))
    found = templates(scratch, pages)
    total = found.agg(F.coalesce(F.sum(F.size("tokens") + F.lit(1)), F.lit(0))).first()[0]
    joined = pages.join(F.broadcast(found) if total <= BROADCAST_TOKENS else found, "host", "left").select("page_id", "url", "html", "tokens", "main")
    out = pages.select("page_id", "url").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 200):
            texts = []
            for source, tokens, main in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4))):
                texts.append(Page(source).extract({t & 0xFFFFFFFFFFFFFFFF for t in tokens or ()}, None if main is None else main & 0xFFFFFFFFFFFFFFFF))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    ids = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in out.fields)
    return joined.mapInArrow(run, f"{ids}, text string, n_chars long")


def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark, table(spark, sf_dir, "pages"))
