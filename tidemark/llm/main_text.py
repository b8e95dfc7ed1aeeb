"""Main text of web pages, by what the pages of a host have in common.

The pages of a host become token streams: a mark per block (its element), then its words.
Suffix arrays over the concatenated streams of some pages at a time, with the lengths of
common prefixes of neighbours, find the runs of RUN tokens and how many pages hold them;
these counts are added up over all pages of a host, so it does not matter how large a host
is or which pages are looked at together. Blocks covered by runs that enough distinct pages
of the host share are boilerplate, the rest are the page's own; a block shorter than a run
counts as one if as many pages have just that block. Equal pages count once.

What the markup says outright comes before what repetition suggests: an explicit article
keeps what it holds (passages may well repeat between articles) but for short blocks at its
edges that are no sentence and that many pages of the host have, such as "Read more"; and
navigation, forms, adverts and the like go even where they are unique. A mere word in a
class or id is weaker: it does not throw out what holds the page's article or most of its
text.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import columns, mapped, mix, prepare, put, scratch_dir, uri, windows

# Tokens of a shared run, at least, and the share of a host's distinct pages (two at
# least) that must hold it, where that is not more than so many pages; a block is
# boilerplate if this share of its tokens is covered.
RUN, SHARED_BY, MANY, COVERED = 8, 0.3, 8, 0.8
# Pages that must share a block at an article's edge, its most words, and what ends a
# sentence, which is the article's own.
EDGE_PAGES, EDGE_WORDS = 8, 12
SENTENCE = re.compile(r"[.!?…:;,。！？]\W*$")
# Html bytes of the pages that are looked at together, and of one bucket of counts.
GROUP_BYTES, HTML_PER_TASK = 3 << 20, 32 << 20
# Counts that a task gathers before it hands them on; bits of a hash that are kept.
GATHERED, BITS = 4_000_000, 56

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|svg|iframe|textarea|object|math|title)\b"
    r"(?:\"[^\"]*\"|'[^']*'|[^>\"'])*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|<[a-zA-Z][^>]*\Z"
    r"|[^<]+|<",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li"
    " main menu nav ol p pre search section summary table tbody tfoot thead tr ul".split()
)
# Elements whose open ones are tracked, so that what they hold can be told.
HOLDERS = BLOCKS - frozenset("p hr h1 h2 h3 h4 h5 h6 li dt dd tr".split()) | {
    "button",
    "select",
    "label",
}
VOID = frozenset("hr br img input meta link wbr source area col embed track base".split())
# A start tag that ends an open holder of the same name need not close it: only these do.
OUT = frozenset(
    "nav footer aside form head button select label dialog menu search fieldset".split()
)
OUT_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu"
    " menubar toolbar".split()
)
# Words of class and id that name what is not the article.
OUT_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo"
    " promotion nav navbar navigation menu breadcrumb breadcrumbs sidebar footer masthead"
    " cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe"
    " subscription share sharing social related recommended comment comments reply replies"
    " respond responses disqus login signup search pagination pager widget toolbar skip"
    " topnav subnav colophon announcement promoted".split()
)
# Names that mean the page's frame, and nothing inside an article.
FRAME_NAMES = frozenset("header topbar".split())
# In one class name with such a word, a name says how the page is laid out, not what is in it.
LAYOUT_NAMES = frozenset("has no not with without hide enabled disabled open closed".split())
# What readers wrote is no article, even where it is all the articles there are.
REPLY_NAMES = frozenset("comment comments reply replies respond responses disqus".split())
# Names that say enough to throw out most of a page.
FIRM_NAMES = REPLY_NAMES | frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promoted"
    " promotion nav navbar navigation menu breadcrumb breadcrumbs sidebar footer cookie cookies"
    " consent gdpr related recommended login signup pagination pager toolbar topnav subnav".split()
)
# Elements that hold text alone, and those that a like one ends.
LINES = frozenset("p h1 h2 h3 h4 h5 h6".split())
ITEMS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",)}
LISTS = frozenset("ul ol menu dir dl table".split())
HEADS = frozenset("h1 h2 h3 h4 h5 h6".split())
ARTICLE, MAIN = 2, 1


@dataclass
class Block:
    tag: str
    text: str
    depth: int  # ARTICLE, MAIN or 0: the best holder around it
    out: bool  # the markup says it is no article text


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(text)}


def _names(found: dict[str, str]) -> set[str]:
    """Words of class and id, without class names that tell of the layout."""
    out: set[str] = set()
    for name in [*found.get("class", "").split(), found.get("id", "")]:
        words = set(re.split(r"[^a-z]+", name.lower()))
        if not words & LAYOUT_NAMES:
            out |= words
    return out


@lru_cache(4096)
def _judge(tag: str, attributes: str, depth: int) -> tuple[int, bool, frozenset[str]]:
    """How deep an element is in an article, whether it is none of it, and the words of
    its class and id by which it may be none."""
    found = _attributes(attributes) if attributes and not attributes.isspace() else {}
    if tag in ("html", "body"):
        return depth, False, frozenset()
    role = found.get("role", "").lower()
    names = _names(found)
    hidden = "hidden" in found or re.search(
        r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", "").lower()
    )
    out = bool(tag in OUT or role in OUT_ROLES or hidden or found.get("aria-hidden") == "true")
    words: set[str] = set()
    if tag not in ("article", "main"):
        words = names & OUT_NAMES
        if depth < ARTICLE and tag in HOLDERS:
            out |= tag == "header"
            words |= names & FRAME_NAMES
    elif names & {"comment", "comments", "reply", "ad", "advert", "sponsored", "promo"}:
        out = True
    if tag == "article" or role == "article" or found.get("itemprop") == "articleBody":
        depth = ARTICLE
    elif tag == "main" or role == "main":
        depth = max(depth, MAIN)
    return depth, out, frozenset(words)


@dataclass(eq=False)
class _Doubt:
    """An element that the words of its class or id would throw out."""

    words: frozenset[str]
    depth: int  # around it
    around: _Doubt | None  # the next such element around it
    size: int = 0  # letters of its blocks, and of those of inner ones that are kept
    deepest: int = 0  # of these blocks
    kept: bool = False
    holds: bool = False  # an article or main
    stays: bool = False  # with all those around it
    could: bool = False  # if holding an article were enough


class _Names:
    """A stack of names that knows which it holds."""

    def __init__(self):
        self.names: list[str] = []
        self.often: Counter[str] = Counter()

    def push(self, name: str) -> None:
        self.names.append(name)
        self.often[name] += 1

    def pop(self) -> None:
        self.often[self.names.pop()] -= 1

    def clear(self) -> None:
        self.names.clear()
        self.often.clear()

    def __contains__(self, name: str) -> bool:
        return self.often[name] > 0

    def __bool__(self) -> bool:
        return bool(self.names)


def blocks(html: str | None) -> list[Block]:
    """The text blocks of a page in order, white space made single."""
    found: list[Block] = []
    pieces: list[str] = []
    # open holders: what was before, name, doubt
    stack: list[tuple[str, int, bool, _Doubt | None, _Names, str, _Doubt | None]] = []
    opened = Counter()  # names on the stack
    lists: list[Counter[str]] = [Counter()]  # items open in the innermost list, and around
    tag, depth, out = "body", 0, False
    doubt: _Doubt | None = None  # around what comes next
    doubted: list[_Doubt | None] = []  # around each block
    ended: list[_Doubt] = []
    mute = _Names()  # open inline elements that are thrown out

    def flush() -> None:
        text = " ".join(unescape("".join(pieces)).split())
        pieces.clear()
        if text:
            found.append(Block(tag, text, depth, out))
            doubted.append(doubt)

    def start(name: str, deeper: int, gone: bool, words: frozenset[str]) -> None:
        nonlocal tag, depth, out, doubt, mute
        own = _Doubt(words, depth, doubt) if words and not gone else None
        stack.append((tag, depth, out, doubt, mute, name, own))
        opened[name] += 1
        if name in LISTS:
            lists.append(Counter())
        elif name in ITEMS:
            lists[-1][name] += 1
        tag, depth, out = name, deeper, out or gone or bool(mute)
        mute = _Names()
        doubt = own or doubt

    def end(name: str | None) -> None:
        """Leave holders up to and with one of this name; all of them for None."""
        nonlocal tag, depth, out, doubt, mute
        while stack:
            tag, depth, out, doubt, mute, left, own = stack.pop()
            opened[left] -= 1
            if left in LISTS:
                lists.pop()
            elif left in ITEMS:
                lists[-1][left] -= 1
            if own:
                ended.append(own)
            if left == name:
                break

    def open_item(names: tuple[str, ...]) -> str | None:
        """The innermost open item of these names, in the innermost list."""
        if any(lists[-1][n] > 0 for n in names):
            return next(held[5] for held in reversed(stack) if held[5] in names)
        return None

    for m in TOKEN.finditer(html or ""):
        name = m[3]
        if name is None:
            part = m[0]
            if not mute and (part[0] != "<" or len(part) == 1):
                pieces.append(part)
            continue
        name = name.lower()
        if name == "br":
            pieces.append(" ")
        elif name in ("td", "th"):
            pieces.append(" ")
        if name not in BLOCKS and name not in HOLDERS:
            if m[2]:
                if mute and mute.names[-1] == name:
                    mute.pop()
            elif name not in VOID and not m[4].endswith("/") and (mute or m[4]):
                _, gone, words = _judge(name, m[4], depth)
                if gone or words or name in mute:
                    mute.push(name)
            continue
        flush()
        if stack and stack[-1][5] in LINES and (not m[2] or name == stack[-1][5]):
            end(stack[-1][5])  # a line ends with itself and where another block begins
            if m[2]:
                tag = "text"
                continue
        if name not in HOLDERS:
            if name in ITEMS and (held := open_item(ITEMS[name] if not m[2] else (name,))):
                end(held)
            if m[2] or tag in LINES or tag in ITEMS:
                mute.clear()
            if not m[2] and name not in VOID and (m[4] and not m[4].isspace()):
                _, gone, words = _judge(name, m[4], depth)
                if gone or words:
                    start(name, depth, gone, words)
                    continue
            tag = name if not m[2] else "text"
            continue
        if not m[2]:
            if m[4].endswith("/") or name in VOID:
                continue
            start(name, *_judge(name, m[4], depth))
        elif opened[name] > 0:
            end(name)
    flush()
    end(None)
    if ended:
        _settle(found, doubted, ended)
    return found


def _settle(
    found: list[Block], doubted: list[_Doubt | None], ended: list[_Doubt]
) -> None:
    """Throw out the blocks of doubtful elements, unless these hold what the page is for."""
    whole, articles = 0, False
    for block, doubt in zip(found, doubted, strict=True):
        if block.out:
            continue
        whole += len(block.text)
        if doubt is None:
            articles |= block.depth >= MAIN
        else:
            doubt.size += len(block.text)
            doubt.deepest = max(doubt.deepest, block.depth)
    for doubt in ended:  # inner ones come first
        doubt.holds = doubt.deepest > doubt.depth
        most = 2 * doubt.size > whole and not doubt.words & FIRM_NAMES
        if doubt.holds:
            doubt.kept = not doubt.words & REPLY_NAMES and (not articles or most)
        else:
            doubt.kept = most and not articles
        if doubt.kept and doubt.around:
            doubt.around.size += doubt.size
            doubt.around.deepest = max(doubt.around.deepest, doubt.deepest)
    for doubt in reversed(ended):  # outer ones come first
        around = doubt.around
        doubt.stays = doubt.kept and (not around or around.stays)
        doubt.could = (doubt.kept or doubt.holds) and (not around or around.could)
    gone = [doubt is not None and not doubt.stays for doubt in doubted]
    if all(b.out or g for b, g in zip(found, gone, strict=True)):
        # nothing is left: take the articles, whatever is around them
        gone = [doubt is not None and not doubt.could for doubt in doubted]
    for block, g in zip(found, gone, strict=True):
        block.out |= g


def suffix_array(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order of their suffixes, and how many items each has in common with
    the one before it.

    Prefix doubling: suffixes sorted by 1, 2, 4, ... items, of which only those that are
    not alone yet are sorted further. Common prefixes are then found by halving, from
    hashes of all prefixes; 64-bit hashes stand for equality there.
    """
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    first = np.flatnonzero(np.diff(ids[order], prepend=ids[order[0]] - 1 if n else 0))
    rank = np.empty(n, np.int64)  # where the group of equal prefixes begins
    sizes = np.diff(np.append(first, n))
    rank[order] = np.repeat(first, sizes)
    slots = np.flatnonzero(np.repeat(sizes, sizes) > 1)
    width = 1
    while len(slots):
        here = order[slots]
        group = rank[here]
        after = np.where(here + width < n, rank[np.minimum(here + width, n - 1)] + 1, 0)
        by = np.argsort(group * (n + 1) + after, kind="stable")
        here, group, after = here[by], group[by], after[by]
        order[slots] = here
        new = np.flatnonzero((np.diff(group, prepend=-1) != 0) | (np.diff(after, prepend=-1) != 0))
        sizes = np.diff(np.append(new, len(slots)))
        rank[here] = np.repeat(slots[new], sizes)
        slots = slots[np.repeat(sizes, sizes) > 1]
        width *= 2
    # hashes of prefixes: that of a stretch is a difference, scaled to its place
    odd = np.uint64(0x9E3779B97F4A7C15)
    power = np.cumprod(np.append(np.uint64(1), np.full(n, odd)), dtype=np.uint64)
    prefix = np.append(
        np.uint64(0), np.cumsum(mix(ids.astype(np.uint64)) * power[:n], dtype=np.uint64)
    )
    left, right = order[:-1], order[1:]
    common = np.zeros(max(n - 1, 0), np.int64)
    step = 1
    while step < width:
        step *= 2
    while step:
        try_ = common + step
        fits = (np.maximum(left, right) + try_ <= n).nonzero()[0]
        a, b, k = left[fits], right[fits], try_[fits]
        same = (prefix[a + k] - prefix[a]) * power[b] == (prefix[b + k] - prefix[b]) * power[a]
        common[fits[same]] += step
        step //= 2
    return order, np.append(0, common) if n else common


def _key(kind: str, *parts: str) -> int:
    return xxhash.xxh3_64_intdigest("\0".join((kind, *parts))) >> (64 - BITS) & ~1


def _page_key(host: str, page: list[Block]) -> int:
    """Odd, as no other key is."""
    return _key("page", host, *(f"{b.tag}\0{b.text}" for b in page)) | 1


def _block_keys(host: str, page: list[Block]) -> list[int]:
    return [_key("block", host, b.tag, b.text) for b in page]


def _run_keys(hosts: np.ndarray, runs: np.ndarray) -> np.ndarray:
    return mix(runs ^ hosts) >> np.uint64(64 - BITS) & ~np.uint64(1)


def _host_hash(host: str) -> int:
    return xxhash.xxh3_64_intdigest(host)


class _Tokens(dict):
    """Numbers of tokens, in turn."""

    def __missing__(self, token: str) -> int:
        value = self[token] = len(self)
        return value

    def hashes(self) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, self), np.uint64, len(self))

    def of(self, page: list[Block]) -> tuple[list[int], list[int]]:
        """Of a page's tokens, and where its blocks end among them."""
        found: list[int] = []
        ends = []
        for block in page:
            found.append(self[f"<{block.tag}>"])
            found.extend(map(self.__getitem__, block.text.split(" ")))
            ends.append(len(found))
        return found, ends


def tally(pages: list[tuple[str, list[Block]]]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of what distinct pages (host, blocks) hold, and how many of them hold each: runs
    of RUN tokens, blocks, and the pages of a host; each page has a key of its own besides."""
    counts: Counter[int] = Counter()
    distinct: dict[int, tuple[str, list[Block]]] = {}
    for host, page in pages:
        distinct.setdefault(_page_key(host, page), (host, page))
    tokens, stream, ends, hosts = _Tokens(), array("q"), [], []
    for k, (host, page) in enumerate(sorted(distinct.values(), key=lambda p: p[0])):
        counts[_key("pages", host)] += 1
        counts.update(set(_block_keys(host, page)))
        stream.extend(tokens.of(page)[0])
        stream.append(-1 - k)  # a page's own end: no run goes over it
        ends.append(len(stream))
        hosts.append(_host_hash(host))
    counts.update(distinct.keys())
    keys = np.fromiter(counts.keys(), np.uint64, len(counts))
    often = np.fromiter(counts.values(), np.int32, len(counts))
    ids = np.frombuffer(stream, np.int64)
    if len(ids) <= RUN:
        return keys, often
    owner = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    order, common = suffix_array(ids)
    run = np.cumsum(common < RUN)  # suffixes that begin with the same run
    whole = order + RUN < np.array(ends)[owner[order]]
    order, run = order[whole], run[whole]
    both, first = np.unique(run * len(ends) + owner[order], return_index=True)
    if not len(both):
        return keys, often
    place = order[first]
    host = np.array(hosts, np.uint64)[both % len(ends)]  # pages are in order of hosts
    run = both // len(ends)
    new = np.flatnonzero(np.append(True, (np.diff(run) != 0) | (host[1:] != host[:-1])))
    marks = ids < 0
    hashes = tokens.hashes()[np.where(marks, 0, ids)]
    keys = np.append(keys, _run_keys(host[new], windows(hashes, RUN)[place[new]]))
    return keys, np.append(often, np.diff(np.append(new, len(both))).astype(np.int32))


def texts(pages: list[tuple[str, list[Block]]], held) -> list[str]:
    """The text of each page, where ``held`` tells the counts of keys."""
    every = [not any(b.depth >= ARTICLE and not b.out for b in page) for _, page in pages]
    found = marks(pages, held, every)
    return [chosen(page, common) for (_, page), common in zip(pages, found, strict=True)]


def marks(pages: list[tuple[str, list[Block]]], held, every: list[bool]) -> list[list[int]]:
    """Per block of each page: 0 if it is the page's own, 1 if the pages of its host have
    it in common, 2 if EDGE_PAGES of them have just this block. Runs are looked up in the
    pages marked in ``every`` alone, as others are not asked for what is common."""
    tokens, keys = _Tokens(), []
    streams = [tokens.of(page) if e else None for (_, page), e in zip(pages, every, strict=True)]
    hashes = tokens.hashes()
    for (host, page), stream in zip(pages, streams, strict=True):
        keys.append(np.array([_key("pages", host), *_block_keys(host, page)], np.uint64))
        if stream and len(stream[0]) >= RUN:
            runs = windows(hashes[stream[0]], RUN)
            keys.append(_run_keys(np.uint64(_host_hash(host)), runs))
    counts = held(np.concatenate(keys)) if keys else []
    out, at = [], 0
    for (_, page), stream in zip(pages, streams, strict=True):
        # a host's only page may have been left out of the counts: it shares nothing
        least = max(2, min(MANY, int(np.ceil(SHARED_BY * counts[at]))))
        often = counts[at + 1 : at + 1 + len(page)]
        at += 1 + len(page)
        found = np.where(often >= EDGE_PAGES, 2, 0)
        if stream:
            n = len(stream[0])
            starts = max(0, n - RUN + 1)
            edge = np.zeros(n + 1, np.int64)
            edge[:starts] += counts[at : at + starts] >= least
            edge[n + 1 - starts :] -= counts[at : at + starts] >= least
            at += starts
            total = np.append(0, np.cumsum(np.cumsum(edge[:n]) > 0))
            ends = np.array([0, *stream[1]])
            size, covered = np.diff(ends), np.diff(total[ends])
            own = (size < RUN) & (often >= least) | (covered >= COVERED * size)
            found[(found == 0) & own] = 1
        out.append(found.tolist())
    return out


def repeated(pages: list[list[Block]]) -> list[list[int]]:
    """The marks of all pages of one host."""
    mine = [("", page) for page in pages]
    keys, often = tally(mine)
    counts = dict(zip(keys.tolist(), often.tolist(), strict=True))

    def held(some: np.ndarray) -> np.ndarray:
        return np.array([counts.get(k, 0) for k in some.tolist()], np.int64)

    return marks(mine, held, [True] * len(mine))


def _is_line(block: Block) -> bool:
    """Whether a block may be a line of the site's: short, no heading and no sentence."""
    if block.tag in HEADS or len(block.text.split()) > EDGE_WORDS:
        return False
    return not SENTENCE.search(block.text)


def chosen(page: list[Block], common: list[int]) -> str:
    """The article's blocks where there is an article, without short ones at its edges
    that many pages have, else the page's own blocks."""
    both = list(zip(page, common, strict=True))
    inside = [(b, c) for b, c in both if b.depth >= ARTICLE and not b.out]
    if inside:
        edge = [c == 2 and _is_line(b) for b, c in inside]
        if not all(edge):
            while edge[-1]:
                edge.pop()
            begin = edge.index(False)
            inside = inside[begin : len(edge)]
        return "\n".join(b.text for b, _ in inside)
    for depth in (MAIN, 0):
        some = [(b.text, c) for b, c in both if b.depth >= depth and not b.out]
        if some:
            return "\n".join([t for t, c in some if not c] or [t for t, _ in some])
    return ""


def _bucket(keys: np.ndarray, n: int) -> np.ndarray:
    return (keys >> np.uint64(BITS - 32)) * np.uint64(n) >> np.uint64(32)


def _summed(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Keys in order, each once, and its counts added up as far as 32 bits go."""
    keys, counts = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order].astype(np.int64)
    new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[new], np.clip(np.add.reduceat(counts, new), -(1 << 31), (1 << 31) - 1)


COUNTS = "bucket long, first long, low binary, high binary, often binary"


def _sent(found: list[tuple[np.ndarray, np.ndarray]], n: int) -> Iterator[pa.RecordBatch]:
    """Counts by bucket, their keys in order as differences: the low 32 bits of these are
    beyond compression, the rest are mostly alike."""
    keys, counts = _summed(found)
    bucket = _bucket(keys, n)
    bounds = np.append(np.flatnonzero(np.diff(bucket, prepend=-1.0)), len(keys)).tolist()
    step = np.diff(keys, prepend=keys[:1])
    low = step.astype("<u4")  # modulo 2 ** 32
    high, often = (step >> np.uint64(32)).astype("<u4"), counts.astype("<i4")
    for some in range(0, len(bounds) - 1, 100):
        cuts = list(zip(bounds[some : some + 100], bounds[some + 1 : some + 101], strict=False))
        begins = [a for a, _ in cuts]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(bucket[begins].astype(np.int64)),
                pa.array(keys[begins].astype(np.int64)),
                pa.array([low[a:b].tobytes() for a, b in cuts], pa.binary()),
                *(
                    pa.array(
                        [pa.compress(x[a:b].tobytes(), "zstd", asbytes=True) for a, b in cuts],
                        pa.binary(),
                    )
                    for x in (high, often)
                ),
            ],
            names=["bucket", "first", "low", "high", "often"],
        )


def _received(first: int, low: bytes, high: bytes, often: bytes) -> tuple[np.ndarray, np.ndarray]:
    step = np.frombuffer(low, "<u4").astype(np.uint64)
    size = 4 * len(step)
    more = np.frombuffer(pa.decompress(high, size, "zstd"), "<u4").astype(np.uint64)
    step |= more << np.uint64(32)
    step[0] = first
    counts = np.frombuffer(pa.decompress(often, size, "zstd"), "<i4")
    return np.cumsum(step, dtype=np.uint64), counts


def _added(counts: DataFrame, n: int, root: str, least: int | None) -> int:
    """Add up counts and write the sums below ``root``, those of ``least`` or more if it is
    given; how many pages were counted more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close() -> int:
            keys, often = _summed(held)
            held.clear()
            if least is not None:
                keys, often = keys[often >= least], often[often >= least]
            put(uri(root, f"{at}.counts"), often.astype("<i4").tobytes())
            put(uri(root, f"{at}.keys"), keys.astype("<u8").tobytes())
            return int(((keys & np.uint64(1) == 1) & (often > 1)).sum())

        at, held, copies = None, [], 0
        for batch in batches:
            names = ("bucket", "first", "low", "high", "often")
            for bucket, *row in zip(*columns(batch, *names), strict=True):
                if bucket != at and held:
                    copies += close()
                at = bucket
                held.append(_received(*row))
        if held:
            copies += close()
        yield pa.RecordBatch.from_pydict({"copies": pa.array([copies], pa.int64())})

    dealt = counts.repartition(n, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "copies long").agg(F.sum("copies")).first()[0] or 0


def _lookup(roots: list[str], n: int):
    """What tells the counts of keys, added up over ``roots``."""

    def held(keys: np.ndarray) -> np.ndarray:
        some, back = np.unique(keys, return_inverse=True)
        bucket = _bucket(some, n)
        bounds = np.append(np.flatnonzero(np.diff(bucket, prepend=-1.0)), len(some)).tolist()
        out = np.zeros(len(some), np.int64)
        for begin, end in zip(bounds, bounds[1:], strict=False):
            for root in roots:
                there = mapped(uri(root, f"{bucket[begin]}.keys"), "<u8")
                if len(there):
                    counts = mapped(uri(root, f"{bucket[begin]}.counts"), "<i4")
                    at = np.searchsorted(there, some[begin:end])
                    at[at == len(there)] = 0
                    same = there[at] == some[begin:end]
                    out[begin:end] += np.where(same, counts[at], 0)
        return out[back]

    return held


def _chunks(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[list[list]]:
    """Columns of rows with some GROUP_BYTES of html; html is the last column."""
    rows, size = [], 0
    for batch in batches:
        for row in zip(*columns(batch, *names), strict=True):
            rows.append(row)
            size += len(row[-1])
            if size >= GROUP_BYTES:
                yield list(map(list, zip(*rows, strict=True)))
                rows, size = [], 0
    if rows:
        yield list(map(list, zip(*rows, strict=True)))


def _counted(rows: DataFrame, n: int, root: str) -> list[str]:
    """Count what the pages of each host (host, html) hold, over all of them; where the
    counts are. Equal pages that several chunks counted are taken back until they count once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0
        for hosts, htmls in _chunks(batches, "host", "html"):
            found.append(tally(list(zip(hosts, map(blocks, htmls), strict=True))))
            size += len(found[-1][0])
            if size >= GATHERED:
                yield from _sent(found, n)
                found, size = [], 0
        if found:
            yield from _sent(found, n)

    whole, less = uri(root, "whole"), uri(root, "less")
    if not _added(rows.mapInArrow(count, COUNTS), n, whole, 2):
        return [whole]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _lookup([whole], n)
        for hosts, htmls in _chunks(batches, "host", "html"):
            pages = [_page_key(h, blocks(x)) for h, x in zip(hosts, htmls, strict=True)]
            often = held(np.array(pages, np.uint64))
            some = [k for k, x in enumerate(often.tolist()) if x > 1]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([pages[k] for k in some], pa.int64()),
                    pa.array(often[some], pa.int64()),
                    pa.array([hosts[k] for k in some], pa.string()),
                    pa.array([htmls[k] for k in some], pa.string()),
                ],
                names=["page", "often", "host", "html"],
            )

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0
        for often, hosts, htmls in _chunks(batches, "often", "host", "html"):
            for times, host, html in zip(often, hosts, htmls, strict=True):
                keys, counts = tally([(host, blocks(html))])
                found.append((keys, counts * np.int32(1 - times)))
                size += len(keys)
            if size >= GATHERED:
                yield from _sent(found, n)
                found, size = [], 0
        if found:
            yield from _sent(found, n)

    copies = rows.mapInArrow(find, "page long, often long, host string, html string")
    _added(copies.dropDuplicates(["page"]).mapInArrow(take, COUNTS), n, less, None)
    return [whole, less]


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages`` (page_id, url, html).

    NULL html and pages without text give an empty text; NULL urls are a host of their
    own. Pages stay where they are read: once to count what those of a host have in common,
    once to take their texts. What two pages or more have is kept below the shared folder,
    in buckets of hashes, and each task looks its pages' hashes up there.
    """
    spark = pages.sparkSession
    prepare(spark)
    host = F.lower(F.coalesce(F.regexp_extract("url", r"//([^/?#]+)", 1), F.lit("")))
    rows = pages.select(
        "page_id", "url", host.alias("host"), F.coalesce("html", F.lit("")).alias("html")
    )
    total = rows.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // HTML_PER_TASK))
    roots = _counted(rows.select("host", "html"), n, scratch_dir(spark, "main-text"))
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, pa_kind = _lookup(roots, n), pa.int64()

        def typed() -> Iterator[pa.RecordBatch]:
            nonlocal pa_kind
            for batch in batches:
                pa_kind = batch.schema.field("page_id").type
                yield batch

        for ids, urls, hosts, htmls in _chunks(typed(), "page_id", "url", "host", "html"):
            found = texts(list(zip(hosts, map(blocks, htmls), strict=True)), held)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa_kind),
                    pa.array(urls, pa.string()),
                    pa.array(found, pa.string()),
                    pa.array(list(map(len, found)), pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    return rows.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
