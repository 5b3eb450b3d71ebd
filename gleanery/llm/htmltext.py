"""Main text of web pages by wrappers: union-free regular expressions inferred for each host.

A page is a stream of tags and texts. Siblings that begin with the same tag and naming words are folded into one position, a repeated group if a page
has several; so below a position every name is once. Streams of one host are aligned one after another, position by position, and what differs is resolved: texts into slots,
elements that only some pages have into optional groups, those that some pages repeat into repeated ones. The result is the host's
wrapper (``expression`` writes it out).

Each task aligns the pages it reads and sends one wrapper for each host; wrappers of a host are aligned in turn, in any order with the same
result. So a host with a third of all pages costs one small row for each task, and no page is shuffled for inference. Elements deeper than
DEEP lie at one position for each name. A wrapper has at most POSITIONS, the least by depth and then by hash: that choice is
the same in any order, and what holds a position is always kept with it.

The wrapper says where the host keeps its article and which texts there are its own (``reading``). A page is then matched with it: its text is
what stands at and under the content's positions, and under no menu, header, footer, sidebar, notice, advert, form or comment list.
Fixed lists of tags and class words name these and seed the choice of the content; where no name helps, slots alone decide. Inside a content that
was found by its name, a word among others, or one on prose or a table, cuts nothing unless the wrapper agrees: what it names holds links nearly alone or never varies.
Prose (paragraphs, headings, entries, cells, quotations) never loses a text to the template.

Null and empty pages have an empty text, so have pages of markup alone. Nothing is recursive: nesting and length have no bound.
"""

from __future__ import annotations

import html as htmllib
import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import fresh, small_batches, table
from gleanery.llm.urlfilter import url_parts
from gleanery.operators.skew import join_spread
from gleanery.session import cut

#: Wrappers up to this size in all are broadcast; beyond it they are joined by host.
BROADCAST_BYTES = 32 << 20
#: Hosts that are broadcast with their rules even then.
HOT_HOSTS = 100
#: Different pages that must agree on a text for it to count as the template's.
CONSTANT_PAGES = 5
#: Positions of a wrapper at most, those of all wrappers that a task holds before it sends them, and the depth below which positions aren't told apart by their paths.
POSITIONS, HELD, DEEP = 20_000, 200_000, 256
#: Different texts of a page at one position, beyond which it counts as a slot.
TEXTS = 256
#: Share of the varying text that makes a container the content's, and of link text that makes a repeated group a menu.
SHARE, LINKED = 0.7, 0.8
#: Parts in which a host's wrappers are aligned before the last step.
FAN = 64

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?][^>]*>?""", re.S)
_ATTR = re.compile(r"""(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/]|\Z)""", re.I)
_NAME = re.compile(r"[a-z]+")
# Elements by their role in a page, after the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead "
    "tr ul".split()
)
#: Elements that hold blocks.
HOLDERS = frozenset("div section table tbody tr td center ul ol dl body main article".split())
#: Elements that hold an article's own words.
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th caption figcaption blockquote pre".split())
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6".split())
TABLES = frozenset("table thead tbody tfoot tr".split())
#: Unclosed elements that end where one of the key's opens.
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
OUT_TAGS = frozenset("nav aside footer form button select menu dialog svg canvas object audio video map head search".split())
OUT_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices "
    "alert alerts warning popup modal overlay newsletter subscribe subscription signup share sharing social related recommended recommendations "
    "sidebar widget widgets menu nav navbar navigation navbox breadcrumb breadcrumbs comment comments reply replies respond disqus footer masthead "
    "login search pagination pager skip toolbar complementary contentinfo noprint".split()
)
#: Words beside those that say nothing about what an element is for.
NEUTRAL = frozenset("area articles block body box button buttons col column container group holder icon icons inner item items link links list outer panel posts row section stories text wrap wrapper".split())
MAIN_NAMES = frozenset("article content story post entry maintext articlebody".split())


def tokens(page: str) -> list[tuple[str, str, str]]:
    """(kind, name, text): ``o`` opens an element (name: tag and its naming words), ``c`` closes one, ``t`` is text as written."""
    out, at, n = [], 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            out.append(("t", "", page[at:]))
            break
        if m.start() > at:
            out.append(("t", "", page[at : m.start()]))
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            out.append(("c", tag, ""))
            continue
        attrs = m[3] or m[6] or ""
        names = []
        if attrs:
            for a in _ATTR.finditer(attrs):
                kind, value = a[1].lower(), a[2] or a[3] or a[4] or ""
                if kind == "hidden" or kind == "aria-hidden" and value.lower() == "true":
                    names.append("hidden")
                elif kind in ("class", "id", "role"):
                    names += _NAME.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower())
        out.append(("o", ".".join([tag, *dict.fromkeys(names)]), ""))
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*>?", re.I).search(page, at)
            at = end.end() if end else n
            out.append(("c", tag, ""))
    return out


def pairs(stream: list[tuple[str, str, str]]) -> dict[int, int]:
    """For each opening token that is closed, the position of its closing one, and the other way round."""
    stack: list[tuple[str, int]] = []
    depths: dict[str, list[int]] = {}  # of each tag's open elements, however deep
    out: dict[int, int] = {}
    for k, (kind, name, _) in enumerate(stream):
        if kind == "o":
            if (tag := name.partition(".")[0]) not in VOID:
                depths.setdefault(tag, []).append(len(stack))
                stack.append((tag, k))
        elif kind == "c" and depths.get(name):
            d = depths[name][-1]
            out[stack[d][1]] = k
            out[k] = stack[d][1]
            for tag, _ in stack[d:]:
                depths[tag].pop()
            del stack[d:]
    return out


class Frame:
    """An open element: its tag, name, position (a hash of the names on its path) and depth, whether it is closed somewhere, and what holds it."""

    __slots__ = ("above", "at", "closed", "depth", "floor", "name", "state", "tag")

    def __init__(self, tag: str, name: str, closed: bool, above: Frame | None):
        self.tag, self.name, self.closed, self.above, self.state = tag, name, closed, above, None
        self.depth = above.depth + 1 if above else 0
        # Containers of an article lie together whatever other words they have, and so does what is very deep.
        key = f"{tag}.{word}" if (word := _seed(name)) else name
        self.floor = above.floor if above and self.depth > DEEP else self
        self.at = _position((self.floor if self.floor is not self else above).at, key) if above else ROOT


ROOT = 0
_POSITIONS: dict[tuple[int, str], int] = {}


def _position(above: int, name: str) -> int:
    got = _POSITIONS.get((above, name))
    if got is None:
        if len(_POSITIONS) > 50_000:
            _POSITIONS.clear()
        got = _POSITIONS[above, name] = (xxhash.xxh64_intdigest(f"{above}>{name}") >> 1) | 1
    return got


def walk(page: str) -> list[tuple[str, Frame, str]]:
    """The page's events in order: ``o`` an element opens (the frame is its own), ``t`` a text stands in the frame, ``b`` a block begins or ends.

    What was never closed doesn't hold a container that opens later with a name for the article."""
    stream = tokens(page)
    match = pairs(stream)
    stack = [Frame("", "", True, None)]
    out: list[tuple[str, Frame, str]] = []
    for k, (kind, name, text) in enumerate(stream):
        if kind == "t":
            out.append(("t", stack[-1], text))
            continue
        tag = name.partition(".")[0]
        if tag in BLOCK:
            out.append(("b", stack[-1], ""))
        if kind == "o":
            if tag in VOID:
                continue
            if _seed(name) and not all(_holds(f) for f in stack):
                held = [f for f in stack if _holds(f)]
                stack = held[:1]
                for f in held[1:]:
                    stack.append(Frame(f.tag, f.name, f.closed, stack[-1]))
                    out.append(("o", stack[-1], "again"))
            elif tag in CLOSES:  # end tags that this one implies
                for d in range(len(stack) - 1, 0, -1):
                    above = stack[d]
                    if above.closed or above.tag in BLOCK and above.tag not in CLOSES[tag]:
                        break
                    if above.tag in CLOSES[tag]:
                        del stack[d:]
                        break
            stack.append(Frame(tag, name, k in match, stack[-1]))
            out.append(("o", stack[-1], ""))
        elif k in match:
            for d in range(len(stack) - 1, 0, -1):
                if stack[d].tag == name:
                    del stack[d:]
                    break
    return out


def _names(name: str) -> tuple[str, set[str]]:
    tag, *names = name.split(".")
    return tag, set(names)


@lru_cache(1 << 16)
def _seed(name: str) -> str:
    """``article``, ``main`` or a naming word, if the name is one of an article's container; else empty."""
    tag, names = _names(name)
    if tag in ("article", "main"):
        return tag
    return "main" if "main" in names else min(names & MAIN_NAMES, default="")


def _holds(frame: Frame) -> bool:
    return frame.closed or frame.tag in ("html", "body") or bool(_seed(frame.name))


@lru_cache(1 << 16)
def _is_out(name: str) -> int:
    """Whether a name is that of a menu, advert and the like: 2 by its tag or by all of its words, 1 by a word among others, or of prose or a table; else 0."""
    tag, names = _names(name)
    if tag in OUT_TAGS or tag in RAW or "hidden" in names:
        return 2
    if not OUT_NAMES & names or tag in ("body", "html"):
        return 0
    return 1 if names - OUT_NAMES - NEUTRAL or tag in PROSE or tag in TABLES else 2


def _crc(text: str) -> int:
    return zlib.crc32(text.strip().encode("utf-8", "surrogatepass"))


# A wrapper is a dict from position to [position above, name, depth, pages, repeated, signs, characters, those in links, texts that all pages have, whether some have others].
ABOVE, NAME, DEPTH, PAGES, REPEATED, SIGNS, CHARS, LINKS, SAME, VARY = range(10)


def infer(page: str) -> dict[int, list]:
    """A page's wrapper of its own: siblings that begin alike lie at one position, a repeated group if a page has several."""
    found: dict[int, list] = {ROOT: [ROOT, "", 0, 1, False, [], 0, 0, set(), False]}
    last: dict[int, Frame] = {}
    sign = 0  # of the texts that aren't links, menus, adverts and the like
    for kind, frame, text in walk(page):
        if kind == "o":
            link, out = frame.above.state or (False, False)
            frame.state = (link or frame.tag == "a", out or bool(_is_out(frame.name)))
            node = found.get(frame.at)
            if node is None:
                above = frame.above if frame.floor is frame else frame.floor
                name = f"{frame.tag}.{word}" if (word := _seed(frame.name)) else frame.name
                found[frame.at] = [above.at, name, above.depth + 1, 1, False, [], 0, 0, set(), False]
            elif text != "again" and last.get(frame.at) is frame.above:
                node[REPEATED] = True
            last[frame.at] = frame.above
        elif kind == "t" and (text := text.strip()):
            node = found[frame.at]
            link, out = frame.state or (False, False)
            crc = _crc(text)
            node[CHARS] += len(text)
            node[LINKS] += len(text) if link else 0
            if len(node[SAME]) <= TEXTS:
                node[SAME].add(crc)
            sign = sign if link or out else (sign * 1_000_003 + crc) & 0xFFFFFFFF
    for node in found.values():
        node[SIGNS] = [sign]
        node[VARY] = len(node[SAME]) > TEXTS
        node[SAME] = [] if node[VARY] else sorted(node[SAME])
    return _trimmed(found)


def _trimmed(wrapper: dict[int, list]) -> dict[int, list]:
    if len(wrapper) > POSITIONS:
        for at in sorted(wrapper, key=lambda at: (wrapper[at][DEPTH], at))[POSITIONS:]:
            del wrapper[at]
    return wrapper


def merge(a: dict[int, list], b: dict[int, list]) -> dict[int, list]:
    """Align two wrappers, in any order with the same result: positions of both meet, one that some pages lack is optional, texts that differ are slots.
    ``a`` is changed. Signs are of pages that differ in what they say outside links, menus and adverts, CONSTANT_PAGES of them at most. Of more than
    POSITIONS the least by depth and hash are kept (twice as many for a while, so that they aren't sorted for each page): a position that is kept in the end was kept by all."""
    for at, y in b.items():
        x = a.get(at)
        if x is None:
            a[at] = y
            continue
        x[PAGES] += y[PAGES]
        x[REPEATED] |= y[REPEATED]
        x[SIGNS] = sorted({*x[SIGNS], *y[SIGNS]})[:CONSTANT_PAGES]
        x[CHARS] += y[CHARS]
        x[LINKS] += y[LINKS]
        x[VARY] |= y[VARY]
        if x[SAME] != y[SAME]:
            x[VARY] = True
            x[SAME] = sorted(set(x[SAME]).intersection(y[SAME]))
    return _trimmed(a) if len(a) > 2 * POSITIONS else a


def expression(wrapper: dict[int, list]) -> str:
    """The wrapper as a union-free expression: ``+`` repeated, ``?`` optional, ``#`` a slot, ``=`` a text that never varies."""
    below = _below(wrapper)
    done: dict[int, str] = {}
    for at in sorted(wrapper, key=lambda at: -wrapper[at][DEPTH]):
        x = wrapper[at]
        inner = [done[c] for c in below.get(at, ())]
        inner[:0] = ["=" if _constant(x) else "#"] if x[CHARS] else []
        optional = "?" if x[PAGES] < wrapper.get(x[ABOVE], x)[PAGES] else ""
        done[at] = f"{x[NAME]}({' '.join(inner)}){'+' if x[REPEATED] else ''}{optional}"
    return done[ROOT]


def _below(wrapper: dict[int, list]) -> dict[int, list[int]]:
    out: dict[int, list[int]] = {}
    for at in sorted(wrapper, key=lambda at: (wrapper[at][NAME], at)):
        if at != ROOT:
            out.setdefault(wrapper[at][ABOVE], []).append(at)
    return out


def _constant(node: list) -> bool:
    return bool(node[SAME]) and len(node[SIGNS]) >= CONSTANT_PAGES


@dataclass
class Rule:
    """How a host's pages are read: positions of the article's containers, of what else to leave out in them, the template's own texts by position, and whether
    a name told the containers."""

    content: frozenset[int]
    out: frozenset[int]
    constants: dict[int, frozenset[int]]
    named: bool

    def dumps(self) -> str:
        return json.dumps([sorted(self.content), sorted(self.out), [[k, *sorted(v)] for k, v in sorted(self.constants.items())], self.named])

    @classmethod
    def loads(cls, text: str) -> Rule:
        content, out, constants, named = json.loads(text)
        return cls(frozenset(content), frozenset(out), {k: frozenset(v) for k, *v in constants}, named)


def reading(wrapper: dict[int, list]) -> Rule:
    """The rule that a wrapper gives.

    Its content is a position with a name for an article's container: ``article``, else ``main``, else the naming word under which
    most text varies. Without any, it is found from the slots: from the body on, down to the container that holds most of the text that varies
    and stands in no link; there, repeated groups that are links nearly alone are out. In the content, a container that says the same on
    every page that has it, on CONSTANT_PAGES different ones at least, is the template's, if anything else in the content varies: its texts go but for
    prose. Texts that stand in no container within the content never go."""
    order = sorted(wrapper, key=lambda at: wrapper[at][DEPTH])
    below = _below(wrapper)
    out, mass, chars, links, looped, vary = {}, {}, {}, {}, {}, {}
    for at in order:
        x = wrapper[at]
        out[at] = at != ROOT and (out.get(x[ABOVE], False) or bool(_is_out(x[NAME])))
        vary[at] = x[CHARS] > 0 and (x[VARY] or not _constant(x))
        chars[at], links[at] = x[CHARS], x[LINKS]
        mass[at] = 0 if out[at] or _constant(x) and not x[REPEATED] else x[CHARS] - x[LINKS]
        looped[at] = x[REPEATED]
    for at in reversed(order):
        x = wrapper[at]
        if at != ROOT and x[ABOVE] in wrapper:
            up = x[ABOVE]
            mass[up] += mass[at]
            chars[up] += chars[at]
            links[up] += links[at]
            looped[up] |= looped[at]
            vary[up] |= vary[at]
    seeds: dict[str, list[int]] = {}
    for at in order[1:]:
        if not out[at] and mass[at] and (word := _seed(wrapper[at][NAME])):
            seeds.setdefault(word, []).append(at)
    word = next((w for w in ("article", "main") if w in seeds), None) or max(sorted(seeds), key=lambda w: sum(mass[at] for at in seeds[w]), default=None)
    menus: set[int] = set()
    if word:
        content = set(seeds[word])
    else:
        at = next((k for k in order if wrapper[k][NAME].partition(".")[0] == "body"), ROOT)
        while True:
            kids = [c for c in below.get(at, ()) if not out[c] and wrapper[c][NAME].partition(".")[0] in HOLDERS and 2 * wrapper[c][PAGES] >= wrapper[at][PAGES]]
            best = max(kids, key=lambda c: (mass[c], c), default=None)
            if best is None or mass[best] < SHARE * mass[at] or not mass[best]:
                break
            at = best
        content = {at}
    # Of each position inside: the prose that holds it, the container that it stands in, and whether it is out.
    inside: dict[int, tuple[str, int | None, bool]] = {}
    for at in order:
        if at in content:
            inside[at] = ("", None, False)
        elif at != ROOT and wrapper[at][ABOVE] in inside:
            prose, holder, gone = inside[wrapper[at][ABOVE]]
            tag = wrapper[at][NAME].partition(".")[0]
            if prose and tag in HOLDERS and prose in PARAGRAPHS:  # left open: a container ends it
                prose = ""
            weak, link_list = _is_out(wrapper[at][NAME]), links[at] >= LINKED * chars[at] > 0
            if not word and tag in HOLDERS and looped[at] and link_list or word and weak == 1 and (link_list or not vary[at] and not prose and tag not in PROSE):
                menus.add(at)
            inside[at] = (tag if tag in PROSE else prose, at if tag in HOLDERS else holder, gone or at in menus or weak == 2 or weak == 1 and not word)
    varies = any(mass[at] for at in content)
    constants = {
        at: frozenset(wrapper[at][SAME])
        for at, (prose, holder, gone) in inside.items()
        if varies and not gone and not prose and holder is not None and not vary[holder] and _constant(wrapper[at])
    }
    return Rule(frozenset(content), frozenset(menus), constants, bool(word))


def extract(page: str | None, rule: Rule | None = None) -> str:
    """A page's main text by its host's rule: texts at and under the rule's content that aren't the template's own. A page that has none of the rule's
    containers is read by its own ``article``, else ``main``, else whole."""
    events = walk(page or "")
    opened = {frame.at for kind, frame, _ in events if kind == "o"} | {ROOT}
    content = rule.content & opened if rule else frozenset()
    whole = False
    if not content:
        words = {_seed(frame.name): 1 for kind, frame, _ in events if kind == "o"}
        word = next((w for w in ("article", "main") if w in words), None)
        whole = word is None
    elif ROOT in content:
        whole = True
    menus, constants, named = (rule.out, rule.constants, rule.named) if rule and content else (frozenset(), {}, not whole)
    blocks: list[str] = []
    piece: list[str] = []
    own = True  # whether all texts of the block are the template's

    def flush() -> None:
        if not own and (text := " ".join("".join(piece).split())):
            blocks.append(text)
        piece.clear()

    for kind, frame, text in events:
        if kind == "o":
            # Whether it is in the article, out of it, and in a header: 1, below a heading there: 2
            main, out, header = frame.above.state or (whole, False, 0)
            tag = frame.tag
            main = main or (frame.at in content if content else _seed(frame.name) == word)
            header = 1 if tag == "header" else 2 if header == 1 and len(tag) == 2 and tag[0] == "h" and tag[1].isdigit() else header
            named_out = _is_out(frame.name)
            frame.state = (main, out or frame.at in menus or named_out == 2 or named_out == 1 and not (main and named), header)
        elif kind == "t":
            main, out, header = frame.state or (whole, False, 0)
            if main and not out and header != 1 and not (whole and header):
                own = own and (not text.strip() or frame.at in constants and _crc(text) in constants[frame.at])
                piece.append(htmllib.unescape(text))
        else:
            flush()
            own = True
    flush()
    return " ".join(blocks)


def _dumps(wrapper: dict[int, list]) -> str:
    return json.dumps([[at, *node] for at, node in wrapper.items()])


def _loads(text: str) -> dict[int, list]:
    return {at: node for at, *node in json.loads(text)}


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper, rule, pages), the wrapper and the rule as JSON, from a table (host, html)."""

    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[str, dict] = {}
        held = 0
        for pdf in batches:
            for host, page in zip(pdf["host"], pdf["html"], strict=True):
                own = infer(page or "")
                before = len(found.get(host, ()))
                found[host] = merge(found[host], own) if host in found else own
                held += len(found[host]) - before
                if held > HELD:  # much in one task: send what there is, the rest is aligned later
                    yield pd.DataFrame({"host": list(found), "wrapper": [_dumps(w) for w in found.values()]}, dtype=object)
                    found, held = {}, 0
        yield pd.DataFrame({"host": list(found), "wrapper": [_dumps(w) for w in found.values()]}, dtype=object)

    def unite(pdf: pd.DataFrame) -> dict[int, list]:
        whole: dict[int, list] = {}
        for w in sorted(pdf["wrapper"]):
            whole = merge(whole, _loads(w))
        return _trimmed(whole)

    def some(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"host": pdf["host"].iloc[:1], "wrapper": [_dumps(unite(pdf))]})

    def last(pdf: pd.DataFrame) -> pd.DataFrame:
        whole = unite(pdf)
        return pd.DataFrame({"host": pdf["host"].iloc[:1], "wrapper": [_dumps(whole)], "rule": [reading(whole).dumps()], "pages": [whole[ROOT][PAGES]]})

    sent = pages.select("host", "html").mapInPandas(local, "host string, wrapper string")
    # In two steps, so that a host found by very many tasks isn't aligned by one.
    dealt = sent.withColumn("part", F.spark_partition_id() % FAN).groupBy("host", "part").applyInPandas(some, "host string, wrapper string")
    return dealt.groupBy("host").applyInPandas(last, "host string, wrapper string, rule string, pages long")


def main_text(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """``pages`` with a column ``text``: each page's main text by its host's wrapper, empty for null or empty pages and for those without any. A
    column of that name is replaced, all others stay, whatever their names. Null and malformed URLs share the empty host. Rows come out
    as often as they go in; the order of pages never matters."""
    small_batches(pages.sparkSession)
    host = url_parts(F.col(url))[0]
    found = cut(wrappers(pages.select(host.alias("host"), F.col(html).alias("html"))))
    at, how, n, whole = fresh(pages, "at", "rule", "n", "whole")
    rules = found.select(F.col("host").alias(at), F.col("rule").alias(how), F.col("pages").alias(n))
    size, total = found.agg(F.coalesce(F.sum(F.length("host") + F.length("rule")), F.lit(0)), F.coalesce(F.sum("pages"), F.lit(0))).first()

    @F.pandas_udf("string")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for page, rule in batches:
            known = {r: Rule.loads(r) for r in rule.dropna().unique()}
            yield pd.Series([extract(h, known.get(r)) for h, r in zip(page, rule, strict=True)], dtype=object)

    kept = [F.col(c) for c in pages.columns if c.lower() != "text" or c == html]
    # Every host has a rule. Beyond the bound, pages of the HOT_HOSTS largest hosts at most stay where they are, and no task gets more than their share of others.
    joined = join_spread(pages.withColumn(at, host), rules, at, n, total, hot_keys=HOT_HOSTS, few=total if size <= BROADCAST_BYTES else 0)
    return joined.select(*kept, run(F.col(html), F.col(how)).alias(whole)).withColumnRenamed(whole, "text")


def op4_htmltext(spark, sf_dir):
    out = main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
