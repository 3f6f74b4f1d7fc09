"""Main-text extraction by consensus host paths.

Every page is cut into its containers; a container's score is the text of its
kept blocks, less what stands in links, weighted by what its tag and class
names promise.  Elements whose names tell of a part beside the article (sidebars, adverts,
comments, forms) go, unless they hold most of the page's unlinked text: a name may be that of
a wrapper around the article as well.  The page votes for the generalised tag-class path (digits in
class names generalised) of its best container.  For every path of a host, Spark
counts the pages that have it and those that vote for it.  A page keeps its own path
if most other pages that have that path vote for it; else it takes the path that the
largest majority of those that have it vote for, if this holds a fair share of the
page's score; else its own.  Pages that lack a path say nothing about it, so a template
is judged alike however many others its host has.
"""

from __future__ import annotations

import hashlib
import html as html_lib
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsewise.llm.common import attach, map_text, materialize, small

#: A path that is not the page's own must hold this share of its best container's score.
FAIR_SHARE = 0.05

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_DIGITS = re.compile(r"\d+")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_CONTAINERS = frozenset("body article main section div td".split())
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot "
    "th thead tr ul".split())
#: Elements that never hold main text.
_DROPPED = frozenset(
    "aside audio button canvas datalist dialog embed footer form head iframe input label map menu nav noembed noframes "
    "noscript object optgroup option select script style svg template textarea title video xmp math".split())
_DROPPED_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
#: Words of class and id names that tell a part beside the article.
_BESIDE = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disclaimer disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices overlay "
    "pager pagination popup promo promotion recommended related replies reply respond share sharing sidebar signup "
    "skyscraper social sponsor sponsored subscribe subscription toolbar widget".split())
#: Words for what readers write.
_READERS = frozenset("comment comments disqus replies reply respond".split())
#: Shares of the page's unlinked text from which an element stays, whatever it is called: if
#: the name says other things too, and if it says nothing else; then no more than
#: OUTSIDE characters may stand outside.
MOST, NEARLY_ALL, OUTSIDE = 0.5, 0.9, 200
#: Words that tell the article.
_ARTICLE = frozenset("article body content entry main post story text".split())


class _Element:
    __slots__ = ("tag", "region", "dropped", "link", "inside", "block")

    def __init__(self, tag, region, dropped, link, inside, block):
        self.tag, self.region, self.dropped, self.link, self.inside, self.block = tag, region, dropped, link, inside, block


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): html_lib.unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(raw)}


def _beside(tag: str, attrs: dict[str, str], inside: bool) -> tuple[bool, int, bool]:
    """Whether an element goes, whether its name lets it stand beside the article (1: among other
    things, 2: it says nothing else), and whether it promises the article."""
    if tag in _DROPPED and tag != "form" or (tag == "header" and not inside):
        return True, 0, False
    doubt = int(tag == "form")
    if not attrs:
        return False, doubt, tag in ("article", "main")
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in attrs.get("style", "").replace(" ", "").lower():
        return True, 0, False
    role = attrs.get("role", "").lower()
    good = tag in ("article", "main") or role in ("main", "article") or attrs.get("itemprop") == "articleBody"
    names = [{w.lower() for w in _NAME.findall(n)} for n in (*attrs.get("class", "").split(), attrs.get("id", ""))]
    if tag in ("html", "body"):
        return False, 0, good
    if not good:
        if role in _DROPPED_ROLES:
            return True, 0, False
        for words in names:
            told = words & _BESIDE
            if told and (told == words or words & _READERS):
                doubt = 2
            elif told:
                doubt = max(doubt, 1)
    elif any(words & _READERS for words in names):
        return False, 2, False  # an article of the readers
    return False, doubt, good or any(words & _ARTICLE for words in names)


class Page:
    """A page's blocks of text and its regions: containers, and elements that may stand
    beside the article.  Regions know their parent only, so a page's cost grows with its size,
    however deep it is nested."""

    def __init__(self, source: str):
        #: of every region
        self.parent, self.label, self.key, self.depth = [-1], [""], [b""], [0]
        self.promise, self.doubt = [0.0], [0]
        self.blocks: list[tuple[str, int, int]] = []  # text, characters in links, region
        self._pending: list[list[tuple[str, bool, int]]] = []
        self._chunks: list[tuple[str, bool, int]] = []
        self._parse(source)
        self._settle()

    def _flush(self) -> None:
        if self._chunks:
            self._pending.append(self._chunks)
            self._chunks = []

    def _region(self, parent: int, label: str, promise: float, doubt: int) -> int:
        """A new region; one with a label is a container, named by the labels down to it."""
        key = hashlib.blake2b(self.key[parent] + b">" + label.encode(), digest_size=12).digest() if label else self.key[parent]
        self.parent.append(parent)
        self.label.append(label)
        self.key.append(key)
        self.depth.append(self.depth[parent] + bool(label))
        self.promise.append(promise)
        self.doubt.append(doubt)
        return len(self.parent) - 1

    def _parse(self, source: str) -> None:
        stack = [_Element("", 0, False, False, False, 0)]
        self._at: dict[str, list[int]] = {}  # places of each open tag in the stack
        at, end = 0, len(source)
        while at < end:
            m = _TAG.search(source, at)
            top = stack[-1]
            text = source[at: m.start() if m else end]
            if text and not top.dropped:
                self._chunks.append((html_lib.unescape(text) if "&" in text else text, top.link, top.region))
            if not m:
                break
            at = m.end()
            closing, tag, raw = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
            if not tag:
                if m[0].startswith("<![CDATA[") and not top.dropped:
                    self._chunks.append((m[0][9:].removesuffix("]]>"), False, top.region))
                continue
            if not m[2] and not m[0].endswith(">"):
                break  # a tag that the page's end cuts
            tag = tag.lower()
            if closing:
                self._close(stack, tag)
                continue
            if tag == "br":
                if not top.dropped:
                    self._chunks.append((" ", False, top.region))
                continue
            if tag in _BLOCKS:
                self._flush()
                self._imply_end(stack, tag)
                top = stack[-1]
            attrs = _attributes(raw) if raw and not raw.isspace() else {}
            if tag in _VOID:
                continue
            gone, doubt, good = _beside(tag, attrs, top.inside)
            region = top.region
            if not (top.dropped or gone):
                if doubt:
                    region = self._region(region, "", 0.0, doubt)
                if tag in _CONTAINERS:
                    names = ".".join(sorted(_DIGITS.sub("#", c) for c in attrs.get("class", "").split()))
                    semantic = tag in ("article", "main") or attrs.get("role") == "main"
                    promise = (2.0 if semantic else 1.7 if good else 0.8 if tag == "body" else 1.0) * 1.01 ** min(len(stack), 20)
                    region = self._region(region, tag + (f".{names}" if names else ""), promise, 0)
            if tag in _RAW:
                close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(source, at)
                at = close.end() if close else end
                continue
            if raw.rstrip().endswith("/") and tag in ("svg", "path", "use"):
                continue
            block = len(stack) if tag in _BLOCKS else top.block
            inside = top.inside or good or tag in ("article", "main")
            self._at.setdefault(tag, []).append(len(stack))
            stack.append(_Element(tag, region, top.dropped or gone, top.link or tag == "a", inside, block))
        self._flush()

    def _cut(self, stack, at: int) -> None:
        for e in stack[at:]:
            self._at[e.tag].pop()
        del stack[at:]

    def _close(self, stack, tag: str) -> None:
        block = tag in _BLOCKS
        if block:
            self._flush()
        open_at = self._at.get(tag)
        # a closing inline tag never ends a block
        if open_at and (block or open_at[-1] > stack[-1].block):
            self._cut(stack, open_at[-1])

    def _imply_end(self, stack, tag: str) -> None:
        """End the open elements that a block's start ends."""
        ends = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"),
                "tr": ("tr", "td", "th"), "option": ("option",)}.get(tag, ())
        stops = ("ul", "ol", "dl", "table", "tbody", "thead", "tfoot", "body", "article", "main", "section", "div")
        i = stack[-1].block
        while i > 0:
            open_tag = stack[i].tag
            if open_tag == "p" or open_tag in ends:
                self._cut(stack, i)
                if open_tag != "p":
                    return
            elif open_tag in stops or not ends:
                return
            i = stack[i - 1].block if i < len(stack) else stack[-1].block

    def _upward(self, own: list) -> list:
        """Sums of every region with all that lie in it."""
        total = list(own)
        for r in range(len(total) - 1, 0, -1):
            total[self.parent[r]] += total[r]
        return total

    def _settle(self) -> None:
        """Decide on the regions in doubt, the plain ones first; keep the blocks of the others."""
        n = len(self.parent)
        gone = [False] * n
        plain = [0] * n
        for block in self._pending:
            for text, link, region in block:
                if not link:
                    plain[region] += len("".join(text.split()))
        for sure in (2, 1):
            if sure not in self.doubt:
                continue
            total = self._upward([0 if gone[r] else plain[r] for r in range(n)])
            for r in range(1, n):
                if gone[self.parent[r]]:
                    gone[r] = True
                elif self.doubt[r] == sure:
                    most = NEARLY_ALL if sure == 2 else MOST
                    stays = total[r] >= most * total[0] and total[r] and (sure == 1 or total[0] - total[r] <= OUTSIDE)
                    gone[r] = not stays
        for block in self._pending:
            kept = [c for c in block if not gone[c[2]]]
            text = " ".join("".join(t for t, _, _ in kept).split())
            if text:
                linked = sum(len(t) for t, link, _ in kept if link)
                region = next((r for t, _, r in kept if not t.isspace()), kept[0][2])
                self.blocks.append((text, min(linked, len(text)), region))
        del self._pending

    def scores(self) -> dict[bytes, float]:
        """Score of every generalised path by its key; containers of one path add up."""
        worth, seen = [0.0] * len(self.parent), [0] * len(self.parent)
        for text, linked, region in self.blocks:
            worth[region] += max(0.0, len(text) - 2.0 * linked)
            seen[region] += 1
        worth, seen = self._upward(worth), self._upward(seen)
        out: dict[bytes, float] = {}
        self._first: dict[bytes, int] = {}
        for r in range(1, len(worth)):
            if self.label[r] and seen[r]:
                out[self.key[r]] = out.get(self.key[r], 0.0) + worth[r] * self.promise[r]
                self._first.setdefault(self.key[r], r)
        return out

    def best(self) -> bytes | None:
        return self.best_of(self.scores())

    def best_of(self, scores: dict[bytes, float]) -> bytes | None:
        return max(scores, key=lambda k: (scores[k], self.depth[self._first[k]], k)) if scores else None

    def spelled(self, key: bytes | None) -> str | None:
        """A path from its key: the labels of the containers down to it."""
        if key is None:
            return None
        labels, r = [], self._first[key]
        while r > 0:
            if self.label[r]:
                labels.append(self.label[r])
            r = self.parent[r]
        return "".join(">" + x for x in reversed(labels))

    def text(self, key: bytes | None) -> str:
        """The kept blocks inside the containers of a path, all kept blocks without one."""
        inside = [key is None] * len(self.parent)
        for r in range(1, len(inside)):
            inside[r] = inside[self.parent[r]] or (bool(self.label[r]) and self.key[r] == key)
        return "\n".join(t for t, _, r in self.blocks if inside[r])


def host_of(url_col: str):
    """Lower-case host without user, port and a leading ``www.``."""
    host = F.regexp_extract(F.lower(F.col(url_col)), r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.regexp_replace(host, r"^www\.", "")


def census(pages: DataFrame) -> DataFrame:
    """(host, path, votes, has): pages that vote for a path, one vote a page for that of
    its best container, and pages that have it; paths that no other page can take are left out."""

    def kernel(batch):
        votes, has = Counter(), Counter()
        for host, source in zip(batch.column("host").to_pylist(), batch.column("text").to_pylist()):
            if source and host:
                page = Page(source)
                scores = page.scores()
                if scores:
                    votes[host, page.best_of(scores)] += 1
                    has.update((host, path) for path in scores)
        return pa.RecordBatch.from_pydict({
            "host": pa.array([h for h, _ in has], pa.string()), "path": pa.array([p for _, p in has], pa.binary()),
            "votes": pa.array([votes[k] for k in has], pa.int64()), "has": pa.array(list(has.values()), pa.int64())})

    return map_text(pages, kernel, "host string, path binary, votes long, has long").groupBy("host", "path").agg(
        F.sum("votes").alias("votes"), F.sum("has").alias("has")).where("has > 1 AND 2 * votes > has - 1")


def chosen_path(page: Page, known: dict[bytes, tuple[int, int]]) -> bytes | None:
    """The path a page is extracted with; ``known``: votes and pages of its host's paths."""
    scores = page.scores()
    best = page.best_of(scores)
    if best is None:
        return None
    votes, has = known.get(best, (0, 0))
    if has > 1 and 2 * (votes - 1) > has - 1:
        return best
    fair = [(known[p][0] / (known[p][1] - 1), known[p][0], p) for p in scores
            if p != best and p in known and scores[p] >= FAIR_SHARE * scores[best]]
    return max(fair)[2] if fair else best


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            limit: int | None = None) -> DataFrame:
    """The main text of every page: page_id, url, text, n_chars, path.

    Blocks stand in page order, one a line, white space inside a block as one
    space.  Null, empty or textless html: empty text and a null path.  Null url
    or a url without a host: the page is judged alone.  Repeated rows and ids
    are kept; empty table: no rows; other columns are not read.  Very long and very deeply
    nested pages take time and memory in proportion to their size.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("text"),
                        F.coalesce(host_of(url_col), F.lit("")).alias("host"))
    paths = materialize(census(rows), "host_paths")

    def extracted(batch, known):
        texts, used = [], []
        for source, mine in zip(batch.column("text").to_pylist(), known):
            text, path = "", None
            if source:
                page = Page(source)
                key = chosen_path(page, mine)
                text, path = page.text(key), page.spelled(key)
            texts.append(text)
            used.append(path if text else None)
        return pa.RecordBatch.from_pydict({
            "page_id": batch.column("page_id"), "url": batch.column("url"), "text": pa.array(texts, pa.string()),
            "n_chars": pa.array([len(t) for t in texts], pa.int64()), "path": pa.array(used, pa.string())})

    schema = "page_id long, url string, text string, n_chars long, path string"
    if small(paths, limit):
        table: dict[str, dict[bytes, tuple[int, int]]] = {}
        for r in paths.collect():
            table.setdefault(r["host"], {})[bytes(r["path"])] = (r["votes"], r["has"])
        held = pages.sparkSession.sparkContext.broadcast(table)
        return map_text(rows, lambda batch: extracted(
            batch, [held.value.get(h, {}) for h in batch.column("host").to_pylist()]), schema)

    # each page's own paths meet the counts, so that no row holds all paths of a host
    def own(batch):
        keys, hosts, names = [], [], []
        for key, host, source in zip(*(batch.column(c).to_pylist() for c in ("key", "host", "text"))):
            if source and host:
                mine = Page(source).scores()
                keys += [key] * len(mine)
                hosts += [host] * len(mine)
                names += mine
        return pa.RecordBatch.from_pydict({
            "key": pa.array(keys, pa.int64()), "host": pa.array(hosts, pa.string()), "path": pa.array(names, pa.binary())})

    rows = rows.withColumn("key", F.xxhash64("host", "text"))
    mine = map_text(rows, own, "key long, host string, path binary").distinct().join(paths, ["host", "path"]).groupBy("key").agg(
        F.collect_list(F.struct("path", "votes", "has")).alias("known"))
    return map_text(attach(rows, materialize(mine, "page_paths"), ["key"], "left", limit), lambda batch: extracted(
        batch, [{bytes(k["path"]): (k["votes"], k["has"]) for k in known or []} for known in batch.column("known").to_pylist()]), schema)
