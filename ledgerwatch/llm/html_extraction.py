"""Main text of web pages: structure first, then a suffix array of each host's pages.

A page is read into blocks, each with what its surroundings say of it. Menus, headers,
footers, sidebars, notices, adverts, forms and reader comments are told by element, role
and name, and don't count. Names are whole words of a class or id, and don't count
against an element around the article. Where a page marks its article, only its blocks are looked at.

Then the blocks of a host's pages are compared, marked or not. The token streams of
a shard of pages are concatenated, and a suffix array over them, by doubling ranks,
gives the runs of ``RUN`` tokens that several pages share. A host is in one shard up to
``HOST_BYTES`` of markup, or ``SHARES`` of a task; the shards of a larger one exchange their runs by
hash, so a host may have any number of pages. A run is boilerplate if at least ``PAGES``
different pages and ``SHARE`` of the host's different pages hold it. A block whose tokens
are all covered by such runs is boilerplate; blocks with words of their own stay. The marks of
an article speak for its blocks: these are boilerplate only if ``MARKED_PAGES`` and
``MARKED_SHARE`` hold all of their runs, such as a notice that stands in every article.

Near copies are one page: a page doesn't count if most of its runs are those of one page
with a smaller digest. Runs that ``SHARE`` of the host's pages hold say nothing of that,
unless less than ``OWN`` of the page's words are outside them. What isn't counted only
makes fewer runs boilerplate. Pages are compared by their prints: the runs with the least hash of
``WINDOW`` neighbours, and all runs of a page with few. Shards exchange prints, and the runs that several of their pages
hold; all runs, where a shard has less than ``FEW_PAGES`` of the host. So a count lacks at most one page of so many.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm import blocks as B
from ledgerwatch.workspace import stage, stage_counted

#: Tokens of a run, a power of two.
RUN = 8
#: Different pages that hold a run of boilerplate, at least, and their least share of the host's.
PAGES, SHARE = 3, 0.5
#: Share of words outside the host's common runs, from which a page is told by its other runs.
OWN = 0.2
#: The same as ``PAGES`` and ``SHARE`` for blocks of a marked article.
MARKED_PAGES, MARKED_SHARE = 8, 0.9
#: Markup of a host that is compared in one task, at most, also as a multiple of a task's share of all markup.
HOST_BYTES, SHARES = 12 << 20, 3
#: Neighbouring runs of which one is a print at least (a power of two), runs of a page that are all prints, and pages of a shard that are few.
WINDOW, FEW_RUNS, FEW_PAGES = 16, 64, 64

# Element and role names of HTML, and words of class names and ids.
SKIPPED = {"nav", "header", "footer", "aside", "form", "script", "style", "noscript", "template", "iframe", "button", "select", "textarea", "svg", "math", "object", "canvas", "audio", "video", "dialog", "menu", "head", "title"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "alert", "alertdialog", "dialog", "form", "menu", "menubar", "toolbar", "status"}
NAMES = set("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu
breadcrumb breadcrumbs header footer sidebar cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe
subscription signup login share sharing social related recommended comment comments reply replies disqus respond pagination pager toolbar
masthead copyright disclaimer""".split())
#: What a name may have beside the words above (``comment-list``, ``siteFooter``), and what it may have unless it is a header, which may hold the title.
NEUTRAL = set("box boxes container wrapper wrap list item items link links button buttons bar block blocks widget widgets icon icons area section inner site main posts articles stories".split())
OF_ARTICLES = set("post article entry story".split())
#: Names that may also be what a part of an article is about.
TOPICS = set("advertising alert consent copyright navigation notice notices promotion related share sharing social subscription".split())
COMMENTS = set("comment comments reply replies disqus".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q ruby rp rt s samp small span strike strong sub sup time tt u var wbr nobr".split())
RAW = {"script", "style", "textarea", "title", "template", "noscript", "iframe"}
#: An element of the first kind ends an open one of the second kinds.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BODY_NAMES = ("articlebody", "article-body", "article-content", "post-content", "post-body", "entry-content", "story-body", "main-content")

_LETTERS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
_NAME_END = re.compile(r"[\s/>]")
_STOP = re.compile(r"[\"'>]")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
_NAME = re.compile(r"[a-z0-9]+")


def _mark(tag: str, attributes: str) -> str:
    """``skip``, ``name`` or ``topic`` (skipped as :func:`_main_blocks` says), ``article``, ``main``, ``body`` or nothing."""
    if tag in SKIPPED:
        return "skip"
    if attributes.strip(" /\n\t\r"):
        given = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
        role = given.get("role", "").lower()
        style = given.get("style", "").replace(" ", "").lower()
        if role in ROLES or "hidden" in given or given.get("aria-hidden") == "true" or "display:none" in style:
            return "skip"
        names = f"{given.get('class', '')} {given.get('id', '')}".split()
        parts = [(n, _NAME.findall(_CAMEL.sub("-", n).lower())) for n in names]
        if tag in ("html", "body"):
            return ""
        if tag in ("article", "main"):
            return "name" if any(not COMMENTS.isdisjoint(p) and _furniture(n, p) for n, p in parts) else tag
        if tag not in INLINE:
            if role == "main":
                return "main"
            body = any(b in n.lower() for n, p in parts if NAMES.isdisjoint(p) for b in BODY_NAMES)
            if body or any(b in given.get("itemprop", "").lower() for b in BODY_NAMES):
                return "body"
        found = [n for n, p in parts if _furniture(n, p)]
        if found:
            return "topic" if all(n.lower() in TOPICS for n in found) else "name"
    return tag if tag in ("article", "main") else ""


def _furniture(name: str, parts: list[str]) -> bool:
    """Whether a class or id as a whole names a menu, sidebar, advert or the like."""
    if name.lower() in NAMES:
        return True
    said = NAMES.intersection(parts)
    return bool(said) and all(p in said or p in NEUTRAL or p in OF_ARTICLES and said.isdisjoint(("header", "banner")) for p in parts)


class _Region:
    """A marked or named element in the one around it, and the words read in it."""

    def __init__(self, kind: str, around: _Region | None):
        self.kind, self.around = kind, around
        self.marks = kind in ("article", "main", "body")
        self.words = self.linked = self.left = 0
        self.regions = 1
        self.paragraphs = self.skipped = self.core = self.around_core = self.stray = False
        #: Words of the longest article in it, and whether a main or body region is.
        self.article, self.main = 0, False
        self.in_marks = self.marks or around is not None and around.in_marks


def _main_blocks(blocks: list[tuple[str, _Region | None]], regions: list[_Region]) -> tuple[list[str], bool]:
    """The blocks that count, and whether the page marks them; ``regions`` are as they were opened.

    A name doesn't skip an element around a main or body region, or around an article as long
    as any outside; nor does one of ``TOPICS`` skip running text of an article. With a body
    or else a main region, shorter articles beside it are stray and don't count.
    """
    for r in reversed(regions):
        if up := r.around:
            up.words, up.linked, up.regions, up.paragraphs = up.words + r.words, up.linked + r.linked, up.regions + r.regions, up.paragraphs or r.paragraphs
            up.article = max(up.article, r.article, r.words if r.kind == "article" else 0)
            up.main = up.main or r.main or r.kind in ("main", "body") and r.words > 0
    # The longest marked region from each on, and before each.
    later, earlier = [0] * (len(regions) + 1), 0
    for i in range(len(regions) - 1, -1, -1):
        later[i] = max(later[i + 1], regions[i].words if regions[i].marks else 0)
    for i, r in enumerate(regions):
        up = r.around
        r.skipped = up is not None and up.skipped
        if r.kind in ("name", "topic") and not r.skipped:
            holds = r.main or r.article and r.article >= max(earlier, later[i + r.regions])
            own = r.words - r.linked
            tells = r.kind == "topic" and r.in_marks and own > r.linked and (r.paragraphs or own >= 5)
            r.skipped = not (holds or tells)
        if r.marks and not r.skipped:
            earlier = max(earlier, r.words)
    blocks = [(t, r) for t, r in blocks if r is None or not r.skipped]
    for text, r in blocks:
        if r:
            r.left += len(text.split())
    for r in reversed(regions):
        if r.around:
            r.around.left += r.left
    core = "body" if any(r.kind == "body" and r.left for r in regions) else "main"
    longest = max((r.left for r in regions if r.kind == core), default=0)
    for r in reversed(regions):
        if r.around and (r.around_core or r.kind == core and r.left):
            r.around.around_core = True
    for r in regions:
        up = r.around
        r.core = r.kind == core or up is not None and up.core
        r.stray = up is not None and up.stray or r.kind == "article" and r.left < longest and not (r.core or r.around_core)
    chosen = [t for t, r in blocks if r and r.in_marks and not r.stray]
    return (chosen, True) if chosen else ([t for t, _ in blocks], False)


class _Tags:
    """The tags of a page from left to right, in time that grows with the page, however broken it is.

    A tag ends at the first ``>`` outside quotes. One that never ends is text. What follows a
    quote or ``>`` is found once for all tags that may hold it.
    """

    def __init__(self, page: str):
        self.page, self.last = page, page.rfind(">")
        self.name_end = self.stop = -1
        self.ends: dict[int, int] = {}

    def after(self, at: int) -> tuple[int, int, bool, str, str] | None:
        """Start and end of the next tag or comment, whether it is an end tag, its name in lower case (none for a comment) and attributes."""
        page = self.page
        while (start := page.find("<", at)) >= 0:
            at = start + 1
            if page.startswith("!--", at):
                end = page.find("-->", start + 4)
                return start, end + 3 if end >= 0 else len(page), False, "", ""
            if start > self.last:  # only an open comment can follow
                at = page.find("<!--", start)
                if at < 0:
                    return None
                continue
            if page[at] in "!?":
                return start, page.index(">", at) + 1, False, "", ""
            first = at + (page[at] == "/")
            if page[first : first + 1] not in _LETTERS:
                continue
            if self.name_end <= first:
                self.name_end = _NAME_END.search(page, first + 1).start()
            end = self._end(self.name_end)
            if end >= 0:
                return start, end, first > at, page[first : self.name_end].lower(), page[self.name_end : end - 1]
        return None

    def _end(self, at: int) -> int:
        """Where a tag whose attributes start at ``at`` ends, or -1."""
        if self.stop < at:
            self.stop = self._next_stop(at)
        seen, end, stop = [], -1, self.stop
        while stop < len(self.page):
            if stop in self.ends:
                end = self.ends[stop]
                break
            seen.append(stop)
            if self.page[stop] == ">":
                end = stop + 1
                break
            close = self.page.find(self.page[stop], stop + 1)
            if close < 0:
                break
            stop = self._next_stop(close + 1)
        self.ends.update(dict.fromkeys(seen, end))
        return end

    def _next_stop(self, at: int) -> int:
        found = _STOP.search(self.page, at)
        return found.start() if found else len(self.page)


def page_blocks(page: str) -> tuple[list[str], bool]:
    """The page's blocks of text in order, and whether the page itself marks its article."""
    blocks: list[tuple[str, _Region | None]] = []
    open_: list[tuple[str, str]] = []
    #: Where the open elements of each name are in ``open_``.
    places: defaultdict[str, list[int]] = defaultdict(list)
    held: list[str] = []
    regions: list[_Region] = []
    within: _Region | None = None
    skips = links = 0

    def hold(text: str) -> None:
        held.append(text)
        if within:
            words = len(text.split())
            within.words += words
            within.linked += words if links else 0

    def flush() -> None:
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            held.clear()
            if text:
                blocks.append((text, within))

    def close(count: int) -> None:
        nonlocal skips, links, within
        for _ in range(count):
            tag, mark = open_.pop()
            places[tag].pop()
            links -= tag == "a"
            if mark:
                flush()
                if mark == "skip":
                    skips -= 1
                else:
                    within = within.around

    def nearest(tags: Iterable[str]) -> int:
        return max((places[t][-1] for t in tags if places[t]), default=-1)

    def close_nearest(tags: set[str], barrier: set[str]) -> None:
        place = nearest(tags)
        if place >= 0 and place > nearest(barrier):
            flush()
            close(len(open_) - place)

    at, tags = 0, _Tags(page)
    while found := tags.after(at):
        start, end, ending, tag, attributes = found
        if start > at and not skips:
            hold(page[at:start])
        at = end
        if not tag:
            continue
        if ending:
            if tag not in INLINE:
                flush()
            if places[tag]:
                close(len(open_) - places[tag][-1])
            continue
        if tag not in INLINE:
            if not skips:
                flush()
            if tag not in VOID:
                close_nearest({"p"}, {"article", "main", "section", "div", "td", "th", "li", "body", "nav", "aside", "form", "header", "footer", "button"})
            if tag in ENDS:
                close_nearest(ENDS[tag], {"ul", "ol", "dl", "table", "select"})
        if tag in RAW:
            # What is inside is no markup; it ends at its own end tag only.
            own = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = own.end() if own else len(page)
            continue
        if tag in VOID or attributes.endswith("/") and tag in SKIPPED:
            continue
        mark = _mark(tag, attributes)
        if mark:
            if not skips:
                flush()
            if mark == "skip":
                skips += 1
            else:
                within = _Region(mark, within)
                regions.append(within)
        links += tag == "a"
        if tag == "p" and within and not skips:
            within.paragraphs = True
        places[tag].append(len(open_))
        open_.append((tag, mark))
    if at < len(page) and not skips:
        hold(page[at:])
    flush()
    return _main_blocks(blocks, regions)


PARSED = "id long, url string, host string, digest string, marked boolean, blocks array<string>"


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests, marks, texts = [], [], []
        for page in batch.column("html").to_pylist():
            found, marked = page_blocks(page or "")
            digests.append(hashlib.md5("\n".join([str(marked), *found]).encode("utf-8", "surrogatepass")).hexdigest())
            marks.append(marked)
            texts.append(found)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("url"), batch.column("host"), pa.array(digests, pa.string()), pa.array(marks, pa.bool_()), pa.array(texts, pa.list_(pa.string()))],
            names=["id", "url", "host", "digest", "marked", "blocks"],
        )


def suffix_ranks(tokens: np.ndarray, stops: np.ndarray, run: int) -> np.ndarray:
    """Rank of every suffix by its first ``run`` tokens; -1 where the stream ends before.

    ``stops`` is where the stream of each token ends. Doubles the ranked length each time.
    """
    n = len(tokens)
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    length = 1
    while length < run:
        follow = np.full(n, -1, np.int64)
        follow[: max(n - length, 0)] = rank[length:]
        follow[np.arange(n) + length >= stops] = -1
        rank = np.unique(rank * (n + 1) + follow + 1, return_inverse=True)[1].astype(np.int64)
        length *= 2
    rank[np.arange(n) + run > stops] = -1
    return rank


class _Codes(dict):
    """The tokens of one host's words."""

    def __init__(self, host: str | None):
        self.host = host

    def __missing__(self, word: str) -> int:
        code = self[word] = hash_token(self.host, word)
        return code


def _streams(table: pa.Table) -> tuple[np.ndarray, ...]:
    """Tokens of all pages with the host mixed in, their page and block, where each stream ends, and the hash of the run from each on."""
    tokens, blocks, sizes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], []
    codes: dict[str | None, _Codes] = {}
    for host, found in zip(table["host"].to_pylist(), table["blocks"].to_pylist()):
        if host not in codes:
            codes[host] = _Codes(host)
        known = codes[host]
        words = [b.split() for b in found]
        counts = [len(w) for w in words]
        tokens.append(np.fromiter(map(known.__getitem__, chain.from_iterable(words)), np.uint64, sum(counts)))
        blocks.append(np.repeat(np.arange(len(found)), counts))
        sizes.append(sum(counts))
    page, stops = np.repeat(np.arange(len(sizes)), sizes), np.repeat(np.cumsum(sizes), sizes)
    code = np.concatenate(tokens)
    return code, page, np.concatenate(blocks), stops.astype(np.int64), _run_hashes(code)


def hash_token(host: str | None, word: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(f"{host or ''}\n{word}")


def _run_hashes(tokens: np.ndarray) -> np.ndarray:
    padded = np.concatenate([tokens, np.zeros(RUN, np.uint64)])
    code = np.zeros(len(tokens), np.uint64)
    for k in range(RUN):
        code = B.mix(code, k + 1) + padded[k : k + len(tokens)]
    return B.mix(code, 11)


def _page_runs(pages: pa.Table, streams: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct runs of each page, found by the suffix array, the page of each, whether it is a print, and whether a second page of the shard has it.

    The host is one more run of each page with words, so that its pages are counted likewise.
    """
    tokens, page, _, stops, hashes = streams
    rank = suffix_ranks(tokens, stops, RUN)
    starts = rank >= 0
    prints = starts & (_prints(np.where(starts, hashes, np.uint64(2**64 - 1))) | (np.bincount(page[starts], minlength=pages.num_rows) <= FEW_RUNS)[page])
    # A run that occurs again in its page is the same run, so it is a print if any occurrence is.
    key = np.where(starts, rank * max(pages.num_rows, 1) + page, -1)
    order = np.argsort(key)
    order = order[np.searchsorted(key[order], 0) :]
    at = np.flatnonzero(np.r_[True, np.diff(key[order]) > 0][: len(order)])
    pick, chosen = order[at], np.logical_or.reduceat(prints[order], at) if len(at) else np.zeros(0, bool)
    shared = np.bincount(rank[pick])[rank[pick]] > 1
    worded = np.unique(page)
    every = np.ones(len(worded), bool)
    return np.r_[hashes[pick], _host_codes(pages)[worded]], np.r_[page[pick], worded], np.r_[chosen, every], np.r_[shared, every]


def _prints(hashes: np.ndarray) -> np.ndarray:
    """Which hashes are the least of a window of neighbours."""
    out = np.zeros(len(hashes), bool)
    if len(hashes) < WINDOW:
        return ~out
    least, span = hashes, 1
    while span < WINDOW:
        least, span = np.minimum(least[:-span], least[span:]), 2 * span
    for k in range(WINDOW):
        out[k : k + len(least)] |= hashes[k : k + len(least)] == least
    return out


def _host_codes(pages: pa.Table) -> np.ndarray:
    return np.array([hash_token(h, "") for h in pages["host"].to_pylist()], np.uint64)


#: Bits of a page that tell its shard, so that copies in several shards count once.
_SHARD = np.uint64((1 << 24) - 1)


def _digests(pages: pa.Table) -> np.ndarray:
    return np.array([hash_token("", d) for d in pages["digest"].to_pylist()], np.uint64) & ~_SHARD


def _totals(code: np.ndarray, count: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each code once, in order, with the sum of its counts and the least of its pages."""
    order = np.argsort(code, kind="stable")
    code = code[order]
    at = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    return code[at], np.add.reduceat(count[order], at), np.minimum.reduceat(low[order], at)


def _ask(block: int, buckets: int, code: np.ndarray, count: np.ndarray, low: np.ndarray) -> pa.Table:
    if not len(code):
        return B.messages([])
    code, count, low = _totals(code, count, low)
    return B.messages([(b, block, _packed(code[i:j], count[i:j], low[i:j])) for b, i, j in B.slices(B.place(code, buckets)[0])])


def _packed(code: np.ndarray, count: np.ndarray, low: np.ndarray) -> bytes:
    """Codes, counts and pages; a page is written once and else named by its place, in byte planes."""
    pages, at = np.unique(low, return_inverse=True)
    return B.pack(code.tobytes(), B.planes(count), pages.tobytes(), B.planes(at.astype(np.uint32), 4))


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    code, count, pages, at = B.unpack(data)
    return np.frombuffer(code, np.uint64), B.unplanes(count, 8, np.int64), np.frombuffer(pages, np.uint64)[B.unplanes(at, 4, np.uint32)]


def _told(answers: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes in order, their counts and least pages."""
    parts = [_unpacked(d) for d in answers["data"].to_pylist()]
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    code, count, low = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(code)
    return code[order], count[order], low[order]


def _shard(buckets: int):
    """Per shard of pages: its distinct runs with the number of pages and the least page that have each."""

    @B.frugal
    def run(key: tuple[pa.Scalar, ...], pages: pa.Table) -> pa.Table:
        pages = _distinct(pages)[0]
        code, page, prints, shared = _page_runs(pages, _streams(pages))
        hosts = _host_codes(pages)
        few = _counts_of(hosts)[page] < FEW_PAGES
        sent = prints | shared | few
        code, page = code[sent], page[sent]
        return _ask(key[0].as_py(), buckets, code, np.ones(len(code), np.int64), (_digests(pages) | _shard_bits(key))[page])

    return run


def _counts_of(values: np.ndarray) -> np.ndarray:
    """How often each value occurs, at its places."""
    _, at, counts = np.unique(values, return_inverse=True, return_counts=True)
    return counts[at]


def _shard_bits(key: tuple[pa.Scalar, ...]) -> np.uint64:
    return np.uint64(key[0].as_py()) & _SHARD


def _distinct(table: pa.Table) -> tuple[pa.Table, list[int]]:
    """A shard's different pages, and which of them each row has."""
    first: dict[tuple[str, str], int] = {}
    which = [first.setdefault(k, len(first)) for k in zip(table["host"].to_pylist(), table["digest"].to_pylist())]
    places = np.unique(np.array(which, np.int64), return_index=True)[1]
    return table.select(["host", "digest", "marked", "blocks"]).take(pa.array(places)), which


def _shared(least: int):
    """Per bucket: the totals of runs that ``least`` pages hold, to each block that asked."""

    @B.frugal
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        parts = [_unpacked(d) for d in table["data"].to_pylist()]
        code, count, low = _totals(*(np.concatenate(x) for x in zip(*parts)))
        many = count >= least
        code, count, low = code[many], count[many], low[many]
        rows = []
        for block, part in zip(table["block"].to_pylist(), parts):
            found, at = B.find(code, part[0])
            at = at[found]
            if len(at):
                rows.append((key[0].as_py(), block, _packed(code[at], count[at], low[at])))
        return B.messages(rows)

    return run


def _covered(hit: np.ndarray) -> np.ndarray:
    """Which tokens are in a run that starts where ``hit`` says."""
    out = np.zeros(len(hit) + RUN, bool)
    for k in range(RUN):
        out[k : k + len(hit)] |= hit
    return out[: len(hit)]


def _look_up(told: tuple[np.ndarray, ...], code: np.ndarray, absent: int) -> np.ndarray:
    found, at = B.find(told[0], code)
    out = np.full(len(code), absent, np.int64)
    out[found] = told[1][at[found]]
    return out


def _different(pages: pa.Table, streams: tuple, runs: tuple[np.ndarray, ...], told: tuple[np.ndarray, ...], shard: np.uint64) -> np.ndarray:
    """Which pages count: those that aren't near copies of a page with a smaller digest."""
    tokens, page, _, stops, hashes = streams
    needed = np.maximum(2, SHARE * _look_up(told, _host_codes(pages), 1))
    starts = np.arange(len(tokens)) + RUN <= stops
    common = _covered(starts & (_look_up(told, hashes, 1) >= needed[page]))
    words, other = np.bincount(page, minlength=len(needed)), np.bincount(page[~common], minlength=len(needed))
    by_common = other < OWN * words
    n = len(runs[0]) - np.count_nonzero(words)
    code, owner = runs[0][:n][runs[2][:n]], runs[1][:n][runs[2][:n]]
    digests = _digests(pages) | shard
    pick = by_common[owner] == (_look_up(told, code, 1) >= needed[owner])
    code, owner = code[pick], owner[pick]
    found, at = B.find(told[0], code)
    first = digests[owner]
    first[found] = told[2][at[found]]
    # The page that is first in most of the runs.
    order = np.lexsort((first, owner))
    first, owner = first[order], owner[order]
    different = words > 0
    if len(owner):
        start = np.flatnonzero(np.r_[True, (first[1:] != first[:-1]) | (owner[1:] != owner[:-1])])
        size = np.diff(np.r_[start, len(owner)])
        best = np.lexsort((-size, owner[start]))
        best = best[np.r_[True, np.diff(owner[start][best]) > 0]]
        different[owner[start][best]] = first[start][best] == digests[owner[start][best]]
    return different


def _count_different(buckets: int):
    """Per shard of pages: its shared runs with the number of different pages that have each."""

    @B.frugal
    def run(key: tuple[pa.Scalar, ...], pages: pa.Table, answers: pa.Table) -> pa.Table:
        pages = _distinct(pages)[0]
        told, streams = _told(answers), _streams(pages)
        code, page, *_ = runs = _page_runs(pages, streams)
        different = _different(pages, streams, runs, told, _shard_bits(key)).astype(np.int64)
        shared = B.find(told[0], code)[0]
        code, page = code[shared], page[shared]
        return _ask(key[0].as_py(), buckets, code, different[page], np.zeros(len(code), np.uint64))

    return run


def _kept(pages: pa.Table, streams: tuple, told: tuple[np.ndarray, ...]) -> list[str]:
    """The text of each page without its blocks of boilerplate."""
    tokens, page, block, stops, hashes = streams
    marked = pages["marked"].to_numpy(zero_copy_only=False).astype(bool)
    different = _look_up(told, _host_codes(pages), 0)
    needed = np.where(marked, np.maximum(MARKED_PAGES, MARKED_SHARE * different), np.maximum(PAGES, SHARE * different))
    covered = _covered((np.arange(len(tokens)) + RUN <= stops) & (_look_up(told, hashes, 0) >= needed[page]))
    own: dict[int, set[int]] = {}
    page, block = page[~covered], block[~covered]
    last = np.flatnonzero(np.r_[(page[1:] != page[:-1]) | (block[1:] != block[:-1]), True][: len(page)])
    for p, b in zip(page[last].tolist(), block[last].tolist()):
        own.setdefault(p, set()).add(b)
    return [" ".join(t for k, t in enumerate(found) if k in own.get(i, ())) for i, found in enumerate(pages["blocks"].to_pylist())]


TEXTS = "id long, url string, text string"


def _texts(table: pa.Table, which: list[int], texts: list[str]) -> pa.Table:
    return pa.table({"id": table["id"], "url": table["url"], "text": pa.array([texts[i] for i in which], pa.string())})


@B.frugal
def _keep(key: tuple[pa.Scalar, ...], table: pa.Table, answers: pa.Table) -> pa.Table:
    pages, which = _distinct(table)
    return _texts(table, which, _kept(pages, _streams(pages), _told(answers)))


def _at_least(least: int, code: np.ndarray, count: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, ...]:
    if not len(code):
        return code, count, low
    code, count, low = _totals(code, count, low)
    many = count >= least
    return code[many], count[many], low[many]


@B.frugal
def _whole_hosts(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """All pages of some hosts: what :func:`_shard` to :func:`_keep` do, without an exchange."""
    pages, which = _distinct(table)
    streams = _streams(pages)
    code, page, *_ = runs = _page_runs(pages, streams)
    told = _at_least(2, code, np.ones(len(code), np.int64), _digests(pages)[page])
    different = _different(pages, streams, runs, told, np.uint64(0)).astype(np.int64)
    return _texts(table, which, _kept(pages, streams, _at_least(PAGES, code, different[page], np.zeros(len(code), np.uint64))))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id``, ``url`` and ``text`` for every row of ``pages``.

    Character references are decoded, white space inside a block is one space, and blocks
    are joined by one space in page order. Null and empty pages have an empty text.
    Copies and near copies count as one page of their host, so they don't erase each
    other; a page without a host is compared with others without. Repeated rows give equal rows.
    """
    spark = pages.sparkSession
    given = pages.select(pages[id_col].cast("long").alias("id"), pages[url_col].cast("string").alias("url"), pages[html_col].cast("string").alias("html"))
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    given = given.withColumn("host", host)
    n, buckets = B.counts(spark, given, F.col("html"))
    # Such hosts are as many as fit the markup, so no hint: Spark broadcasts the list if it is small.
    sizes = stage(given.groupBy("host").agg(F.sum(F.octet_length("html")).alias("bytes")), "hosts")
    share = (sizes.agg(F.sum("bytes")).first()[0] or 0) // n
    large, n_large = stage_counted(sizes.where(F.col("bytes") > min(HOST_BYTES, SHARES * share)).select("host"), "large-hosts")
    small = given.join(large, "host", "left_anti") if n_large else given
    small = small.select("id", "url", "host", "html").mapInArrow(_parse, PARSED).withColumn("block", B.block_of(n, F.col("host")))
    done = small.groupBy("block").applyInArrow(_whole_hosts, TEXTS)
    if not n_large:
        return done
    # Copies are dealt to all shards, however many there are. All three steps read the shards alike, so their shuffle is one.
    rest = given.join(large, "host", "left_semi").select("id", "url", "host", "html").mapInArrow(_parse, PARSED)
    rest = rest.withColumn("block", B.block_of(n, F.col("host"), F.col("id"), F.col("url")))
    asked = rest.groupBy("block").applyInArrow(_shard(buckets), B.MESSAGE)
    held = asked.groupBy("bucket").applyInArrow(_shared(2), B.MESSAGE)
    counted = rest.groupBy("block").cogroup(held.groupBy("block")).applyInArrow(_count_different(buckets), B.MESSAGE)
    answers = counted.groupBy("bucket").applyInArrow(_shared(PAGES), B.MESSAGE)
    return done.unionByName(rest.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_keep, TEXTS))
