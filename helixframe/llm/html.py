"""HTML extraction by equivalence-class template deduction.

A page is a sequence of tokens: opening tags, blocks of text and, outside an article, the words of the blocks, each told
apart by the path of elements above it (a hash that grows by one step an element, so deep markup costs no more than flat).
Over the distinct pages of a host every token has an occurrence vector, its count on each page; a linear 64-bit fingerprint
of that vector is summed by a plain aggregation, so no host's pages ever meet in one task. Tokens of one host and one
vector form an equivalence class. Then every page is read against its host's classes, and a class is valid if its tokens
come in one order on all pages that have it and its span on them never partly crosses that of a larger class: valid classes
nest into the host's template. What lies between template tokens are slots.

A block is template if it is a template token as a whole, or all its words are; the text of a page are the blocks with a slot. Tags
say where to look first, and the template what is a slot there, be the host's pages many or few (three distinct ones make a template):
an article is a slot if one of its blocks is, and then all its blocks are text, also those that other pages repeat; an article that
is template as a whole (a card, a notice) is none. Without an article the blocks of the main element, or else of the whole page, are judged one by one.
Copies are no template: pages of equal content count as one, and a page of which the template would explain
every block is kept whole. What never is text are menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader
comments, known by tag, role, and whole classes or ids; names made of several words count only for parts that pages
surely have (`site-footer`, but not `has-sidebar`, `market-share`), and the template decides on the rest. Such a mark
does not reach an article or main element inside it (a wrapper), unless it is that of comments, a dialog, navigation or something hidden;
articles in marked wrappers are read only if there is none outside.

Templates are bounded by the size of a page. They are broadcast if all of them together are small (counted first), else
joined by host, hosts of very many pages in parts.

Defined cases: null and empty html give an empty text; null urls share the host ""; repeated rows each give a row,
but copies count as one page of their host; markup may be unclosed, cut off or nested without limit; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm.common import Scratch, skewed_join, slices, table

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>?""", re.DOTALL)
ATTRIBUTE = re.compile(r"""([^\s=/"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
RAW = {"script", "style", "title", "textarea", "iframe", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset",
    "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend", "li",
    "main", "menu", "nav", "ol", "optgroup", "option", "p", "pre", "search", "section", "summary", "table", "tbody", "td", "tfoot", "th",
    "thead", "tr", "ul",
}
NEVER = {"head", "nav", "footer", "aside", "form", "script", "style", "noscript", "template", "iframe", "button", "select", "textarea", "dialog", "menu", "object", "svg", "canvas", "audio", "video", "search", "title"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "form", "menu", "menubar", "toolbar"}
HINTS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner", "cookie", "cookies",
    "consent", "gdpr", "notice", "notices", "popup", "modal", "overlay", "newsletter", "subscribe", "sidebar", "menu", "nav", "navbar",
    "navigation", "breadcrumb", "breadcrumbs", "footer", "masthead", "comment", "comments", "respond", "disqus", "social", "share", "sharing",
    "related", "recommended", "widget", "pagination", "pager", "toolbar",
}
COMMENTS = {"comment", "comments", "respond", "disqus"}
#: Last words of longer names that mean the part itself, and words with which they tell of another element.
PARTS = {"breadcrumb", "breadcrumbs", "comments", "footer", "header", "masthead", "menu", "nav", "navbar", "navigation", "pagination", "sidebar", "toolbar"}
#: Last words of names that a hint as first word makes an advert, a list of links or comments, and the like.
HOLDERS = {"banner", "bar", "box", "buttons", "icons", "links", "list", "posts", "signup", "slot", "unit", "widget"}
ABOUT = {"has", "no", "with", "without", "full", "below", "under", "after", "before"}
#: Inside an article only these are judged by class, and by nothing less than a whole one.
CONTAINERS = {"article", "center", "details", "div", "dl", "fieldset", "ol", "section", "table", "ul"}
#: What an opening tag closes if it is the innermost of these elements.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
WORDS = re.compile(r"[a-z0-9]+")
CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")


NOT, WRAPPED, NEVER_TEXT = 0, 1, 2


def excluded(tag: str, attributes: str, inside: bool) -> int:
    """Whether an element, by tag or attributes, holds no text of the article: NOT; WRAPPED, but for an article or main element in
    it; NEVER_TEXT. inside: it lies in an article."""
    if tag in ("form", "header") and not inside:
        return WRAPPED
    if tag in NEVER:
        return NEVER_TEXT
    if not attributes or tag in ("html", "body", "main"):
        return NOT
    got = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)}
    role = got.get("role", "").lower()
    hidden = "hidden" in got or got.get("aria-hidden", "").lower() == "true" or "display:none" in got.get("style", "").replace(" ", "").lower()
    classes, name = got.get("class", "").split(), got.get("id", "")
    if inside:
        whole = {c.lower() for c in classes} if tag in CONTAINERS else set()
        if tag == "article":
            return NEVER_TEXT if whole & COMMENTS else NOT
        return NEVER_TEXT if whole & HINTS or tag in CONTAINERS and name.lower() in COMMENTS or role in ROLES or hidden else NOT
    whole = {c.lower() for c in (*classes, name)}
    parts = [w for c in (*classes, name) if len(w := WORDS.findall(CAMEL.sub(" ", c).lower())) > 1 and (w[-1] in PARTS or w[0] in HINTS and w[-1] in HOLDERS) and not ABOUT.intersection(w)]
    if whole & COMMENTS or any(COMMENTS & {w[0], w[-1]} for w in parts):
        return NEVER_TEXT
    if tag == "article":
        return NOT
    if hidden or role in ROLES and role != "form":
        return NEVER_TEXT
    return WRAPPED if role == "form" or parts or whole & HINTS or "header" in whole else NOT


#: Zones of blocks; the marked ones are under a marked wrapper.
ARTICLE, MAIN, LOOSE, OUT, MARKED_ARTICLE, MARKED_MAIN = "article", "main", "loose", "out", "marked article", "marked main"
#: In these blocks are text whatever the template is.
SLOTS = (ARTICLE, MARKED_ARTICLE)


class Page:
    """Blocks (zone, path, text) and opening tags (a path with no text) of a page in order. One pass; every element on the
    stack holds a hash of its path, and the innermost block and the places of each open tag are known, so closing and implied
    closing cost no search."""

    def __init__(self, page: str | None) -> None:
        self.found: list[tuple[str, int, str | None]] = []
        self.stack: list[tuple[str, int, str, int]] = []  # tag, excluded, zone, path
        self.blocks: list[int] = []  # places of block elements on the stack
        self.open: dict[str, list[int]] = {}
        self.parts: list[str] = []  # text of the open block
        self.hidden: list[str] = []  # text under an excluded element, which may be inline in an open block
        self.articles: list[int] = []  # how much was found before each article that lies in no other
        if page:
            self.read(page)

    def top(self) -> tuple[str, int, str, int]:
        return self.stack[-1] if self.stack else ("", NOT, LOOSE, 0)

    def cut(self, k: int) -> None:
        """Close the element at place k and all inside it."""
        for tag, *_ in self.stack[k:]:
            self.open[tag].pop()
        del self.stack[k:]
        while self.blocks and self.blocks[-1] >= k:
            self.blocks.pop()

    def flush(self) -> None:
        _, no, zone, path = self.top()
        pieces = self.hidden if no else self.parts
        if pieces:
            text = " ".join("".join(map(entities.unescape, pieces)).split())  # a reference never runs over markup
            pieces.clear()
            if text:
                self.found.append((OUT if no else zone, path, text))

    def add(self, piece: str) -> None:
        (self.hidden if self.stack and self.stack[-1][1] else self.parts).append(piece)

    def read(self, page: str) -> None:
        at, end = 0, len(page)
        while at < end:
            lt = page.find("<", at)
            if lt < 0:
                self.add(page[at:])
                break
            if lt > at:
                self.add(page[at:lt])
            m = TAG.match(page, lt)
            if not m:
                self.add("&lt;")
                at = lt + 1
                continue
            at = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            if m[1]:
                if tag in BLOCKS or self.top()[1]:
                    self.flush()
                if self.open.get(tag):
                    self.cut(self.open[tag][-1])
                continue
            if tag == "br":
                self.add(" ")
            if tag in BLOCKS:
                self.flush()
            if tag in VOID:
                continue
            if tag in RAW:
                close = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*>?", re.IGNORECASE).search(page, at)
                at = close.end() if close else end
                continue
            if tag in BLOCKS and self.blocks:
                last = self.stack[self.blocks[-1]][0]
                if last == "p" and tag not in CLOSES or last in CLOSES.get(tag, ()):
                    self.cut(self.blocks[-1])
            if not m[3].endswith("/") or tag in BLOCKS:
                self.enter(tag, m[3])
        self.flush()
        while self.stack and self.stack[-1][1]:
            self.cut(len(self.stack) - 1)
        self.flush()

    def enter(self, tag: str, attributes: str) -> None:
        _, no, zone, path = self.top()
        own = excluded(tag, attributes, zone in SLOTS and not no)
        marked = no == WRAPPED and own == NOT and tag in ("article", "main")
        if marked or not no and tag == "main" and zone == LOOSE:
            zone = MARKED_MAIN if marked else MAIN
        if tag == "article" and (marked or not no and zone not in SLOTS):
            zone = MARKED_ARTICLE if marked or zone == MARKED_MAIN else ARTICLE
            self.articles.append(len(self.found))
        no = NOT if marked else max(no, own)
        path = xxhash.xxh64_intdigest(tag + "!" * bool(no), path)
        self.found.append((OUT, path, None))
        if tag in BLOCKS:
            self.blocks.append(len(self.stack))
        self.open.setdefault(tag, []).append(len(self.stack))
        self.stack.append((tag, no, zone, path))

    def zone(self) -> str:
        """Where the page's text is: in articles; else in the most wordy of the main element and those in marked wrappers; else in
        loose blocks."""
        words: dict[str, int] = {}
        for z, _, text in self.found:
            if text is not None:
                words[z] = words.get(z, 0) + text.count(" ") + 1
        if ARTICLE in words:
            return ARTICLE
        return max((z for z in (MAIN, MARKED_ARTICLE, MARKED_MAIN) if z in words), key=words.__getitem__, default=LOOSE)

    def content(self) -> list[tuple[int, str]]:
        """Path and text of the blocks in the page's zone."""
        return [block for piece in self.pieces() for block in piece]

    def pieces(self) -> list[list[tuple[int, str]]]:
        """The content by what the template judges as one: an article, or elsewhere a block."""
        zone, last, out = self.zone(), -1, []
        for k, (z, path, text) in enumerate(self.found):
            if z == zone and text is not None:
                article = bisect_right(self.articles, k) if zone in SLOTS else -1
                if article < 0 or article != last:
                    out.append([])
                last = article
                out[-1].append((path, text))
        return out


def host_of(url: str = "url") -> Column:
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.coalesce(F.lower(found), F.lit(""))


def signed(n: int) -> int:
    return n - (1 << 64) if n >> 63 else n


def token_of(text: str, path: int, role: int = 0) -> int:
    """A token: 48 bits of hash above 16 bits of role, which tells words of different paths apart and is 0 for others."""
    return signed(xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), path) >> 16 << 16 | role)


def word_tokens(text: str, path: int) -> list[int]:
    role = path & 0xFFFF | 1
    return [token_of(f" {w}", path, role) for w in text.split(" ")]  # no block's text begins with a space


def tokens_of(page: Page) -> list[int]:
    """The page's tokens in order: tags, blocks, and words of the blocks that are neither excluded nor in an article."""
    out: list[int] = []
    for zone, path, text in page.found:
        if text is None:
            out.append(token_of("", path))
            continue
        out.append(token_of(text, path))
        if zone != OUT and zone not in SLOTS:
            out += word_tokens(text, path)
    return out


SEEN = "page_id long, host string, content long, tokens array<long>, n array<int>, first array<int>, last array<int>"


def page_tokens(pages: DataFrame) -> DataFrame:
    """One row per page: host, fingerprint of its content, and its distinct tokens by first place, with count and places."""
    names = [x.strip().split(" ")[0] for x in SEEN.split(",")]
    types = [pa.int64(), pa.string(), pa.int64(), pa.list_(pa.int64()), *[pa.list_(pa.int32())] * 3]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            rows = []
            for page_id, host, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                page = Page(text)
                where: dict[int, list[int]] = {}
                for k, t in enumerate(tokens_of(page)):
                    where.setdefault(t, []).append(k)
                content = token_of("\n".join(x for _, x in page.content()), 0)
                rows.append((page_id, host, content, list(where), [len(x) for x in where.values()], [x[0] for x in where.values()], [x[-1] for x in where.values()]))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * len(types), types, strict=True)], names=names)

    return pages.select(F.col("page_id").cast("long").alias("page_id"), host_of().alias("host"), "html").mapInArrow(run, SEEN)


def with_host(rows: DataFrame, of_host: DataFrame, by: list[str], size: str, most: int) -> DataFrame:
    """rows left join of_host on host: broadcast if the lists `size` of all hosts have `most` values at most, else joined."""
    total = of_host.agg(F.sum(F.size(size)).alias("n"), F.count("*").alias("hosts")).first()
    if (total.n or 0) + total.hosts <= most:
        return rows.join(F.broadcast(of_host), "host", "left")
    return skewed_join(rows, of_host, ["host"], by, "left")


def order_and_span(classes: list[dict], tokens: list[int], first: list[int], last: list[int]) -> Iterator[tuple[int, int, bool]]:
    """(class, fingerprint of the order of its tokens, whether its span partly crosses a larger class's) on one page."""
    at = {t: k for k, t in enumerate(tokens)}
    here: list[tuple[int, int, np.ndarray]] = []
    for c in classes:  # the largest first
        own = sorted(at[t] for t in c["members"] if t in at)
        if own:
            places = np.unique([x for k in own for x in (first[k], last[k])])
            here.append((c["id"], signed(xxhash.xxh64_intdigest(np.array([tokens[k] for k in own], np.int64).tobytes())), places))
    lo, hi = np.array([p[0] for *_, p in here], np.int64), np.array([p[-1] for *_, p in here], np.int64)
    crossed = np.zeros(len(here), bool)
    for k, (*_, places) in enumerate(here):
        inside = np.searchsorted(places, hi[k + 1 :], "right") - np.searchsorted(places, lo[k + 1 :], "left")
        # a smaller class holds some but not all places of the larger one, or ends in another of its gaps
        crossed[k + 1 :] |= (inside > 0) & (inside < len(places))
    for (name, order, _), bad in zip(here, crossed.tolist(), strict=True):
        yield name, order, bad


def templates(seen: DataFrame, scratch: Scratch, share: float = 0.5, least_pages: int = 3, most: int = 4_000_000) -> DataFrame:
    """(host, host_pages, tokens) of every host with a template: its distinct pages and the template's tokens. `seen` (written): page_tokens. A class has tokens on at least `share` of a host's distinct pages and
    `least_pages`, which are at most 1 / share pages' worth, so the lists collected here are bounded by the size of a page."""
    # copies are no evidence: pages of equal content are one, so what a template leaves has varied around it
    distinct = scratch.written(seen.groupBy("host", "content").agg(F.min(F.struct("tokens", "n", "first", "last")).alias("x")).select("host", "content", "x.*"), "distinct")
    sizes = distinct.groupBy("host").agg(F.count("*").alias("host_pages"))
    each = distinct.select("host", "content", F.explode(F.arrays_zip("tokens", "n")).alias("x"))
    vector = F.col("x.n") * F.xxhash64("content").bitwiseAND((1 << 40) - 1)  # a weight per page; the sum is a linear fingerprint
    counted = each.groupBy("host", F.col("x.tokens").alias("token")).agg(F.sum(vector.cast("decimal(38,0)")).alias("vector"), F.count("*").alias("n_pages")).where(F.col("n_pages") >= least_pages)
    common = skewed_join(scratch.written(counted, "counted"), sizes, ["host"], ["token"]).where(F.col("n_pages") >= share * F.col("host_pages"))
    role = F.col("token").bitwiseAND(0xFFFF).alias("role")  # words make a class with words of their own path, two at least
    classes = common.groupBy("host", "host_pages", "vector", "n_pages", role).agg(F.sort_array(F.collect_list("token")).alias("members")).where("role = 0 or size(members) > 1")
    ranked = F.struct((-F.col("n_pages")).alias("rank"), (-F.size("members")).alias("size"), "members")
    listed = classes.groupBy("host", "host_pages").agg(F.sort_array(F.collect_list(ranked)).alias("classes"))
    numbered = F.transform("classes", lambda x, k: F.struct(k.alias("id"), (-x["rank"]).alias("pages"), x["members"].alias("members")))
    of_host = scratch.written(listed.select("host", "host_pages", numbered.alias("classes"), F.flatten(F.transform("classes", lambda x: x["members"])).alias("every")), "classes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            rows = [(host, *x) for host, classes, *lists in zip(*(c.to_pylist() for c in b.columns), strict=True) for x in order_and_span(classes, *lists)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.int32(), pa.int64(), pa.bool_()))], names=["host", "id", "sorted", "crossed"])

    read = with_host(distinct, of_host, ["content"], "every", most).where("classes is not null").select("host", "classes", "tokens", "first", "last")
    judged = read.mapInArrow(run, "host string, id int, sorted long, crossed boolean").groupBy("host", "id").agg(F.min("sorted").alias("a"), F.max("sorted").alias("b"), F.max("crossed").alias("crossed"))
    valid = judged.where("a = b and not crossed").groupBy("host").agg(F.collect_set("id").alias("valid"))
    kept = F.filter("classes", lambda c: F.array_contains("valid", c["id"]))
    members = lambda cs: F.flatten(F.transform(cs, lambda c: c["members"]))
    return of_host.join(valid, "host").select("host", "host_pages", members(kept).alias("tokens"))


def text_of(page: Page, template: set[int]) -> str:
    """The page's text: the articles, or elsewhere the blocks, of its zone that the template does not explain; all, if it explains
    every one."""
    known = lambda path, x: token_of(x, path) in template or template.issuperset(word_tokens(x, path))
    pieces = page.pieces()
    kept = [piece for piece in pieces if not all(known(path, x) for path, x in piece)] if template else pieces
    return "\n".join(x for piece in kept or pieces for _, x in piece)


def extract(pages: DataFrame, share: float = 0.5, least_pages: int = 3, most: int = 4_000_000) -> DataFrame:
    """page_id, url, text and n_chars of every page. `most`: values in all templates up to which they are broadcast."""
    scratch = Scratch(pages.sparkSession, "html")
    of_host = scratch.result(templates(scratch.written(page_tokens(pages), "tokens"), scratch, share, least_pages, most))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host_of().alias("host"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, set[int]] = {}
        for b in slices(batches):
            texts = []
            for k, (text, host) in enumerate(zip(*(b.column(c).to_pylist() for c in ("html", "host")), strict=True)):
                if host not in known:
                    if len(known) > 200:
                        known.clear()
                    known[host] = set(b.column("tokens")[k].as_py() or ())
                texts.append(text_of(Page(text), known[host]))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    joined = with_host(rows, of_host, ["page_id", "url"], "tokens", most).select("page_id", "url", "html", "host", "tokens")
    return joined.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
