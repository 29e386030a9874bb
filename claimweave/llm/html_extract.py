"""Main text of web pages by union-free wrappers of their hosts.

A page is a stream of tags and texts. Streams of one host are aligned one after
the other into a wrapper: a sequence of tokens in which sibling runs of the same
shape are one repeated group, tokens that only some pages have are optional, and
every text is a slot. No alternatives are needed, so the wrapper stays one line.
Each task aligns its own pages and the wrappers of the tasks are aligned again,
so all pages of a host shape its wrapper, but no task ever holds them.

The wrapper decides which of its slots hold the article. What stands in menus,
adverts, comments and the like is not the article's, and neither is a group that
reads the same from page to page. Inside an article mark everything else stays,
whatever it reads on other pages; the mark is preferred as long as it holds most
of the text. Class words that look outside are judged by element: inside an article
only containers named by such words alone are.
"""

from __future__ import annotations

import functools
import hashlib
import html
import json
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of wrappers that are broadcast at most; more are joined by a shuffle.
_BROADCAST_BYTES = 32_000_000
#: Tokens of a wrapper's alignment at most; beyond that the rest of a stream is appended as optional.
_ALIGNED = 400
#: Pages whose changing slots hold less than this part (one in so many characters) of their text are copies of each other.
_COPIES = 10
#: Different pages that must agree in a text before it counts as constant.
_PROOF = 2

#: Attributes of a tag. A tag that is not closed before the next one begins is text; nothing is read twice.
_ATTRIBUTES = r"(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    rf"|<(script|style|noscript|template|textarea|iframe|svg|select)\b{_ATTRIBUTES}>.*?(?:</\1\s*>|\Z)"
    rf"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)({_ATTRIBUTES})>",
    re.S | re.I,
)
_NAMED = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
#: Fixed element sets of HTML.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong"
    " sub sup time tt u var wbr".split()
)
_CLOSES = {"p": "p", "li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}
_SCOPES = frozenset("html body article main section div nav aside header footer ul ol dl table form blockquote".split())
_BLOCKS_CLOSE_P = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()
)
#: Elements that others close, and by which.
_CLOSED = frozenset(" ".join(_CLOSES.values()).split())
_CLOSED_BY = {t: frozenset((_CLOSES.get(t, "") + (" p" if t in _BLOCKS_CLOSE_P else "")).split()) for t in {*_CLOSES, *_BLOCKS_CLOSE_P}}
#: Elements, and words of class, id and role, around text that is not the article's.
_OUTSIDE_TAGS = frozenset("head nav footer aside form button dialog menu title".split())
_OUTSIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies dialog"
    " disqus footer login menu modal nav navbar navigation newsletter notice pager pagination popup promo promotion"
    " related replies respond search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget"
    " complementary contentinfo alert alertdialog".split()
)
#: Words that say nothing about what an element holds. Inside an article only names made of these and the words above count.
_PLAIN_WORDS = frozenset(
    "area article articles bar block bottom box buttons container content entry footer form group holder inner item items left"
    " links list main module outer page panel post posts right row section site stories story top widget wrap wrapper".split()
)
#: Elements that hold others; a paragraph, heading or table inside an article is the article's whatever its name.
_CONTAINERS = frozenset("aside div dl footer form header li nav ol section span ul".split())
#: Headings inside a page, which may read the same on every page of a host.
_HEADINGS = frozenset("h2 h3 h4 h5 h6 caption dt th legend figcaption".split())
#: The same, but fine inside an article.
_OUTSIDE_HEADERS = frozenset("header masthead topbar".split())
_MAIN_WORDS = frozenset(["main"])
#: Elements around whole pages or articles, which are never outside by a word of theirs.
_WHOLE = frozenset("html body article main".split())
#: Words that turn the next ones of a name into a remark on the page: no-comments, has-sidebar.
_REMARKS = frozenset("no non not has have with without hide hidden show is enable enabled disable disabled supports".split())


def _element(tag: str, attributes: str) -> tuple[str, str]:
    """Shape of an element (tag, class and id words) and what it is.

    "", "main", "outside" (by its tag, or hidden), "header", or by a word or as a
    form, which the wrapper may overrule, "likely outside". "maybe outside" is one
    by a word that only counts around or beside an article, not inside it.
    """
    words, own, strict, hidden = [], set(), False, False
    if attributes.strip():
        for name, *values in _NAMED.findall(attributes):
            value, name = "".join(values), name.lower()
            if name in ("class", "id", "role"):
                for one in value.split():
                    parts = [w.lower() for w in _PART.findall(one) if not w.isdigit()]
                    words += parts
                    if not parts or parts[0] in _REMARKS:
                        continue
                    own.update(parts)
                    named = _OUTSIDE_WORDS.intersection(parts)
                    strict = strict or bool(named) and named.union(_PLAIN_WORDS).issuperset(parts)
            elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
                hidden = True
            elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                hidden = True
    shape = ".".join([tag, *sorted(set(words))])
    if tag not in _WHOLE:
        if hidden or tag in _OUTSIDE_TAGS and tag != "form":
            return shape, "outside"
        if tag == "form" or strict and tag in _CONTAINERS:
            return shape, "likely outside"
        if _OUTSIDE_WORDS.intersection(own):
            return shape, "maybe outside"
    if tag in ("article", "main") or tag not in _WHOLE and _MAIN_WORDS.intersection(own):
        return shape, "main"
    if tag not in _WHOLE and (tag == "header" or _OUTSIDE_HEADERS.intersection(own)):
        return shape, "header"
    return shape, ""


_element_cached = functools.lru_cache(maxsize=20_000)(_element)


class _Place:
    """Where an event stands: an element, linked to the one around it.

    ``slot`` names the chain of block elements, and of inline ones that mean
    something, by a hash of its parent's name and its own shape, so that a page
    takes memory in proportion to its length however deep it nests. ``inside``:
    in an article mark. ``barrier``: the innermost element around it that looks
    outside, ``around``: whether all those contain the mark. ``group``: the
    slot of the block around its block.
    """

    __slots__ = ("around", "barrier", "group", "heading", "inside", "known", "parent", "slot", "soft", "wide")

    def __init__(self, parent: _Place | None, tag: str = "", shape: str = "", what: str = ""):
        self.parent, self.known = parent, {}
        if parent is None:
            self.slot, self.group, self.inside, self.barrier, self.around = "", "", False, None, True
            self.soft, self.wide, self.heading = True, True, False
            return
        self.slot, self.group, self.inside = parent.slot, parent.group, parent.inside
        self.barrier, self.around, self.wide, self.heading = parent.barrier, parent.around, parent.wide, parent.heading
        self.soft = parent.soft
        if what or tag not in _INLINE:
            self.slot = hashlib.blake2b(f"{parent.slot}>{shape}/{what}".encode("utf-8", "replace"), digest_size=8).hexdigest()
            self.group, self.wide, self.heading = parent.slot, tag in ("html", "body"), tag in _HEADINGS
        stops = what in ("outside", "likely outside") or what in ("maybe outside", "header") and not parent.inside
        if stops:
            self.barrier, self.around = self, not parent.inside
            self.soft = parent.soft and what in ("likely outside", "maybe outside")
        self.inside = parent.inside or what == "main"

    def child(self, tag: str, attributes: str) -> _Place:
        """The place of an element here; equal siblings share one."""
        shape, what = _element_cached(tag, attributes)
        found = self.known.get((shape, what))
        if found is None:
            found = self.known[shape, what] = _Place(self, tag, shape, what)
        return found

    def standing(self) -> list:
        """[inside, barrier, around, group, page level, heading], as the wrapper holds it."""
        wide = self.parent is None or self.group == "" or self._group_is_wide()
        return [self.inside, self.barrier.slot if self.barrier else "", self.inside and self.around, self.group, wide, self.heading]

    def _group_is_wide(self) -> bool:
        at = self
        while at.parent is not None and at.slot != self.group:
            if at.parent.slot == self.group:
                return at.parent.wide
            at = at.parent
        return at.wide

    def barriers(self) -> Iterator[tuple[str, list]]:
        """The barriers around, innermost first: slot, and [the next one, all of them likely only]."""
        at = self.barrier
        while at is not None:
            outer = at.parent.barrier
            yield at.slot, [outer.slot if outer else "", at.soft]
            at = outer


def read_page(page: str) -> Iterator[tuple[str, _Place, str, bool]]:
    """Events in page order: ("<", place, "", breaks), (">", place, "", breaks) and ("#", place, text, False).

    Elements that HTML lets authors leave open are closed where HTML does; stray
    end tags are ignored. Every step looks at a bounded part of what is open.
    """
    place = _Place(None)
    stack: list[tuple[str, _Place]] = []
    opened: Counter[str] = Counter()
    scopes: list[dict[str, list[int]]] = [{}]  # depths of elements that others close, since the innermost scope

    def pop() -> str:
        nonlocal place
        tag, old = stack.pop()
        opened[tag] -= 1
        if tag in _SCOPES:
            scopes.pop()
        elif tag in _CLOSED:
            scopes[-1][tag].pop()
        place = old.parent
        return tag

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            yield "#", place, page[at : m.start()], False
        at = m.end()
        tag = m.group(3)
        if not tag:
            if m.group().startswith("<![CDATA["):
                yield "#", place, html.escape(m.group()[9:].removesuffix("]]>")), False
            continue
        tag = tag.lower()
        if m.group(2):
            if opened[tag]:
                closed = ""
                while closed != tag:
                    closed = pop()
                    yield ">", place, "", closed not in _INLINE
            elif tag not in _INLINE:
                yield "|", place, "", True
            continue
        if tag in _VOID:
            yield "|", place, "", tag not in _INLINE
            continue
        closes = _CLOSED_BY.get(tag)
        if closes:
            depth = min((scopes[-1][c][0] for c in closes if scopes[-1].get(c)), default=None)
            while depth is not None and len(stack) > depth:
                pop()
                yield ">", place, "", True
        if m.group(4).rstrip().endswith("/"):
            continue
        place = place.child(tag, m.group(4))
        if tag in _SCOPES:
            scopes.append({})
        elif tag in _CLOSED:
            scopes[-1].setdefault(tag, []).append(len(stack))
        stack.append((tag, place))
        opened[tag] += 1
        yield "<", place, "", tag not in _INLINE
    if at < len(page):
        tail = page[at:]
        cut = re.search(r"<[a-zA-Z/!][^<>]*\Z", tail)  # a tag that the page breaks off in
        yield "#", place, tail[: cut.start()] if cut else tail, False


def page_stream(page: str) -> tuple[list[list], dict[str, list]]:
    """Tokens of a page, [slot, hash of its texts, repeated, characters, standing], with runs of equal slots folded, and its barriers."""
    folded: dict[str, list] = {}
    barriers: dict[str, list] = {}
    for event, place, text, _ in read_page(page):
        if event != "#" or not text.strip():
            continue
        slot = place.slot
        if slot in folded:  # the group around the first one repeats
            token = folded[slot]
            token[1], token[2] = hash_text(text, token[1]), True
            token[3] += len(text)
        else:
            folded[slot] = [slot, hash_text(text), False, len(text), place.standing()]
            for name, entry in place.barriers():
                if name in barriers:
                    break
                barriers[name] = entry
    return list(folded.values()), barriers


def hash_text(text: str, before: int = 0) -> int:
    return zlib.crc32((" ".join(text.split()) + "\n").encode("utf-8", "replace"), before)


def page_wrapper(page: str) -> dict:
    """The wrapper of one page."""
    tokens, barriers = page_stream(page)
    whole = zlib.crc32(repr([t[:2] for t in tokens]).encode("utf-8", "replace"))
    return {"pages": 1, "tokens": [[*token, 1, [whole]] for token in tokens], "barriers": barriers}


def align(wrapper: dict, stream: dict) -> dict:
    """Align two wrappers {"pages", "tokens": [[slot, mark, repeated, characters, standing, pages with it, some pages], ...], "barriers"}.

    ``mark`` is the hash of the slot's texts, None when pages differ in them; ``some
    pages`` are the hashes of the first different pages with it, as many as prove a constant.

    Tokens of both, in the order of a longest common subsequence, with the rest
    of either in between as optional (their count of pages falls short).
    """
    a, b = wrapper["tokens"], stream["tokens"]
    index_a, index_b = {t[0]: t for t in a}, {t[0]: t for t in b}
    if [t[0] for t in a] == [t[0] for t in b]:
        order = [t[0] for t in a]
    else:
        order = _merge_order([t[0] for t in a[:_ALIGNED]], [t[0] for t in b[:_ALIGNED]])
        order += [t[0] for t in [*a[_ALIGNED:], *b[_ALIGNED:]]]
        order = list(dict.fromkeys(order))
    tokens = []
    for slot in order:
        x, y = index_a.get(slot), index_b.get(slot)
        if x and y:
            mark = x[1] if x[1] == y[1] else None
            tokens.append([slot, mark, x[2] or y[2], x[3] + y[3], x[4], x[5] + y[5], sorted({*x[6], *y[6]})[:_PROOF]])
        else:
            tokens.append(list(x or y))
    return {"pages": wrapper["pages"] + stream["pages"], "tokens": tokens, "barriers": wrapper["barriers"] | stream["barriers"]}


def _merge_order(a: list[str], b: list[str]) -> list[str]:
    """Both sequences merged along a longest common subsequence."""
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            out.append(a[i])
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            out.append(a[i])
            i += 1
        else:
            out.append(b[j])
            j += 1
    return out + a[i:] + b[j:]


def infer_wrappers(pages: DataFrame, host: str = "host", html_col: str = "html") -> DataFrame:
    """``(host, wrapper)`` with the wrapper as JSON, from all pages of each host."""

    def learn(batches):
        known: dict[str, dict] = {}
        for batch in batches:
            for name, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                one = page_wrapper(page or "")
                known[name] = align(known[name], one) if name in known else one
            if len(known) > 10_000:  # hosts of one task; what is sent early is aligned later
                yield _wrapper_rows(known)
                known = {}
        yield _wrapper_rows(known)

    def join(batches):
        name, held = None, None
        for batch in batches:
            done = {}
            for host_name, one in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if held is not None and host_name != name:
                    done[name] = held
                    held = None
                name, held = host_name, json.loads(one) if held is None else align(held, json.loads(one))
            yield _wrapper_rows(done)
        if held is not None:
            yield _wrapper_rows({name: held})

    parts = pages.select(host, html_col).mapInArrow(learn, "host string, wrapper string")
    return parts.repartition("host").sortWithinPartitions("host", "wrapper").mapInArrow(join, "host string, wrapper string")


def _wrapper_rows(known: dict[str, dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(known), pa.string()), pa.array([json.dumps(w) for w in known.values()], pa.string())], ["host", "wrapper"]
    )


def _constant(token: list, pages: int) -> bool:
    """Whether a slot was seen with the same text on several different pages, and on most of the host's."""
    return token[1] is not None and len(token[6]) >= _PROOF and token[5] * 2 > pages


def _changing(tokens: list[list], pages: int) -> list[list]:
    """Tokens without the host's own; all of them if hardly anything is left, as then the pages are copies.

    What reads the same on every page is the host's if its group, the block around
    it, holds nothing else; beside text that changes it is a part of the article, as
    ``Ingredients`` and ``Method`` are in recipes. On page level only headings are.
    """
    changing = {t[4][3] for t in tokens if not _constant(t, pages)}
    left = [t for t in tokens if not _constant(t, pages) or t[4][3] in changing and (not t[4][4] or t[4][5])]
    return left if _size(left) * _COPIES >= _size(tokens) else tokens


def _size(tokens: list[list]) -> int:
    return sum(t[3] for t in tokens)


@functools.lru_cache(maxsize=2000)
def _content_slots(wrapper: str) -> list[frozenset]:
    """The slots that hold the article, then those to take from pages that have none of them."""
    spec = json.loads(wrapper)
    pages, barriers = spec["pages"], spec["barriers"]
    marked, free, within, likely = [], [], [], []
    for token in spec["tokens"]:
        inside, barrier, around = token[4][:3]
        if not barrier:
            (marked if inside else free).append(token)
        elif around:
            within.append(token)  # in an article that outside elements contain
        elif barriers[barrier][1]:
            likely.append(token)
    # Inside an article mark text is the article's, whatever it reads on other pages.
    best, others = marked, _changing(free, pages)
    if _size(best) < _size(others):  # the marks are around something else, or around a part
        best = marked + others
    levels = [best, others, marked + free]
    if not marked:  # no article but those that outside elements contain, or elements that look outside by a word of theirs
        if _size(within) > _size(best):
            levels = [within, *levels]
        elif not within:
            held = _wrapped(likely, barriers, pages)
            if _size(held) > _size(best) * _COPIES:
                levels = [_changing(free + held, pages), *levels]
    return [frozenset(t[0] for t in level) for level in levels]


def _wrapped(tokens: list[list], barriers: dict[str, list], pages: int) -> list[list]:
    """What holds the article if only elements that look outside hold text: the largest is none, and so on inwards.

    Only that element is cleared; those inside it, adverts say, are judged as anywhere.
    """
    tokens = _changing(tokens, pages)
    own: dict[str, list] = {}
    for token in tokens:
        own.setdefault(token[4][1], []).append(token)
    inner: dict[str, set] = {}
    sizes: Counter[str] = Counter()
    # From the innermost barriers outwards: one that holds text is reached from each of those in it.
    depth = _depths(own, barriers)
    for name in sorted(depth, key=depth.get, reverse=True):
        sizes[name] += _size(own.get(name, []))
        outer = barriers[name][0]
        inner.setdefault(outer, set()).add(name)
        sizes[outer] += sizes[name]
    at = ""
    while at not in own and inner.get(at):
        at = max(sorted(inner[at]), key=sizes.__getitem__)
    return own.get(at, [])


def _depths(names: Iterable[str], barriers: dict[str, list]) -> dict[str, int]:
    """How many barriers are around each of ``names`` and around those."""
    depth = {"": 0}
    for name in names:
        chain = []
        while name not in depth:
            chain.append(name)
            name = barriers[name][0]
        for above in reversed(chain):
            depth[above] = depth[name] + 1
            name = above
    del depth[""]
    return depth


def main_text(page: str | None, wrapper: str | None) -> str:
    """The article of one page under its host's wrapper.

    A page without the slots that hold the article on its host falls back to the
    other slots whose text varies, and if there are none to all text that is not outside.
    """
    if not page:
        return ""
    levels = _content_slots(wrapper or json.dumps(page_wrapper(page)))
    blocks: list[list[str]] = [[] for _ in levels]
    open_: list[list[str]] = [[] for _ in levels]

    def close():
        for parts, done in zip(open_, blocks, strict=True):
            if parts:
                text = " ".join(html.unescape("".join(parts)).split())
                if text:
                    done.append(text)
                parts.clear()

    for event, place, text, breaks in read_page(page):
        if event != "#":
            if breaks:
                close()
            continue
        slot, blank = place.slot, not text.strip()
        for parts, level in zip(open_, levels, strict=True):
            if blank or slot in level:
                parts.append(text)
    close()
    return " ".join(next((done for done in blocks if done), []))


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(id, url, text, n_chars)`` for every row of ``pages``.

    Blocks are in page order, joined by one blank, with character references
    decoded and white space in them turned to single blanks. Null and empty
    pages, and pages without an article, give an empty text. A page without an
    address shares a wrapper with the others of its kind. Rows are extracted one
    by one, so repeated rows and ids need no care; other columns are ignored.
    """
    host = F.lower(F.coalesce(F.regexp_extract(url_col, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), F.lit("")))
    base = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host.alias("host"))
    from claimweave.storage import cut_lineage

    wrappers = cut_lineage(infer_wrappers(base))
    size = wrappers.agg(F.coalesce(F.sum(F.length("host") + F.length("wrapper") + 64), F.lit(0))).first()[0]
    joined = base.join(F.broadcast(wrappers) if size <= _BROADCAST_BYTES else wrappers, "host", "left")

    def extract(batches):
        for batch in batches:
            texts = [main_text(p, w) for p, w in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["id", "url", "text", "n_chars"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in base.schema}
    out = joined.select("id", "url", "html", "wrapper").mapInArrow(
        extract, f"id {kinds['id']}, url {kinds['url']}, text string, n_chars long"
    )
    return out.withColumnsRenamed({"id": id_col, "url": url_col})
