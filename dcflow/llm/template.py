"""Main text of pages by equivalence-class template deduction.

1. Each page is parsed once into blocks (runs of text between block tags) and into the
   containers that hold them; a container's token is the chain of tags and classes above it.
   Parsing is linear in the page, however deep it nests. Attributes are read by HTML's rules:
   a quote opens a value only after an equals sign. Set aside are: menus, headers, footers,
   sidebars and controls, by their tags; containers whose class, id or role has a name made up
   of listed words alone (``cookie-notice``, not ``no-ads``), other than html, body, main,
   article and what holds them (an article inside an article, as comments are, does not
   count); and forms that are forms, with at most ``FORM_WORDS`` words a control. What holds the
   page's only article or main element is never set aside by its tag. An element left open
   takes in what follows it, so it is set aside only if it holds less than a fifth of the text or mostly
   links. A page left empty falls back to all its blocks, and then to what was set aside by words.
   A page's content is the text of its article, else its main element, else its deepest
   container that holds four fifths of its text; pages of a host with equal content are one
   distinct page, whatever stands around it.
2. Per host, a token (container or text block in its place) has an occurrence vector: how often
   each distinct page has it. Tokens with equal vectors form an equivalence class (their vectors
   are compared by 128-bit hashes, so a host of any size is one partial aggregation). A class is
   accepted if its members occur once a page, on at least half of a host's pages, and are two
   or more; a text on one page only is no member.
3. The host's classes are joined to its distinct pages and their members put in document order.
   A member that has one place among its class's on nine tenths of their pages is valid; nested
   by their chains the valid members are the template. Its main container is the article (else
   the main element, else the deepest container that holds at least four fifths of a page's
   text on at least half of the distinct pages, however long each is).
4. The template is joined to the pages. In an article or main element the slot is all of it. In
   another container it goes from the first to the last block that is no member text, so
   template text before and after goes and nothing between does; nothing goes either if on
   most distinct pages that would leave less than half of the container's text, which is then
   no template but copies. On a page where the slot holds less than four fifths of the text
   that is no template text outside it, it widens to the first container around it that holds
   as much. The slot's blocks are joined by spaces. A page without the host's main container uses its own article or main element,
   and failing that all its blocks.

Defined results: a null or empty html gives an empty text; a null url belongs to an unnamed
host; repeated rows are one distinct page for the template and a row each in the result;
markup cut off at the end of a page is dropped and the text before it kept; very long and
very deep pages are read whole; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import enum
import html as entities
import json
import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

# Element names of HTML and words that pages use in class, id and role.
SKIPPED = {"head", "nav", "footer", "aside", "form", "menu", "dialog", "select", "button", "svg", "canvas", "object", "audio",
           "video", "datalist", "map"}
RAW = "script|style|textarea|iframe|title|xmp"
CONTAINERS = SKIPPED | {"html", "body", "main", "article", "section", "div", "header", "table", "tbody", "tr", "td", "ul", "ol", "dl",
                        "blockquote", "figure", "details", "center", "fieldset"}
BLOCKS = CONTAINERS | {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "br", "hr", "pre", "th", "thead", "tfoot", "caption",
                       "figcaption", "address", "summary", "option", "legend"}
SKIPPED_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner",
                 "cookie", "cookies", "consent", "gdpr", "notice", "popup", "modal", "overlay", "newsletter", "subscribe", "sidebar",
                 "widget", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer", "masthead", "comment",
                 "comments", "disqus", "replies", "related", "recommended", "share", "sharing", "social", "login", "search",
                 "complementary", "contentinfo", "alert"}
VOID = {"br", "hr", "img", "input", "meta", "link", "wbr", "source", "area", "base", "col", "embed", "param", "track"}
CONTROLS = {"input", "select", "textarea", "button", "label", "option"}
#: a form of more words a control than this is a page's body in a form
FORM_WORDS = 20
#: an equivalence class has at least so many members
LEAST_MEMBERS = 2

MARKUP = re.compile(rf"<!--.*?(?:-->|\Z)|<({RAW})\b[^<>]*+>.*?(?:</\1\s*>|\Z)|<(noscript|template)\b[^<>]*+>.*?</\2\s*>"
                    r"|<(/?)([a-z][a-z0-9:-]*+)((?:[^<>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|))*+)>|<[!?/][^>]*+(?:>|\Z)|<[a-z][^<]*+\Z", re.I | re.S)
ATTRIBUTE = re.compile(r"([^\s=>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
WORDS = re.compile(r"[a-z]+")


def _chain(up: int, name: str) -> int:
    return xxhash.xxh64_intdigest(f"{up}/{name}") - (1 << 63)


class Kind(enum.IntEnum):
    """Why a container may be set aside."""

    NO, WORDS, TAG, OPEN, FORM = range(5)


def parse(page: str) -> tuple[list[list], list[tuple], list[int], list[str]]:
    """Containers (token, parent's place or -1, rank, chars, depth, place), blocks (container,
    text), the blocks' places and the texts set aside.

    rank: 3 for an article, 2 for a main element, 1 for others; chars: text inside it; places
    count containers and blocks in document order."""
    nodes: list[list] = [[_chain(0, ""), -1, 0, 0, 0, 0]]
    kinds = [Kind.NO]
    controls = [0]  # by container: controls, characters of links, words, all without its children's
    links, words = [0], [0]
    holds = [True]  # whether it holds an article, main element or body
    found: list[tuple[int, str]] = []
    stack: list[tuple[str, int]] = [("", 0)]
    opened: Counter[str] = Counter()
    places: list[int] = []
    pieces: list[str] = []
    linked, in_link = 0, False

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(entities.unescape("".join(pieces)).split())
            if text:
                places.append(len(nodes) + len(found))
                found.append((stack[-1][1], text))
                links[stack[-1][1]] += min(linked, len(text))
                words[stack[-1][1]] += text.count(" ") + 1
            pieces.clear()
        linked = 0

    def close(name: str) -> None:
        """Close the innermost element of a name; those left open inside it end there too."""
        if not opened[name]:
            return
        while True:
            top, k = stack.pop()
            opened[top] -= 1
            if top == name:
                return
            if kinds[k] == Kind.TAG:
                kinds[k] = Kind.OPEN

    def text(lo: int, hi: int) -> None:
        nonlocal linked
        pieces.append(page[lo:hi])
        linked += (hi - lo) * in_link

    at = 0
    for m in MARKUP.finditer(page):
        if m.start() > at:
            text(at, m.start())
        at = m.end()
        name = (m[4] or m[1] or "").lower()
        if name in CONTROLS and not m[3] and "hidden" not in (m[5] or ""):
            controls[stack[-1][1]] += 1
        if name == "a":
            in_link = not m[3]
        if not m[4] or name not in BLOCKS:
            continue
        flush()
        if name not in CONTAINERS:
            continue
        if m[3]:
            close(name)
            continue
        attrs = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(m[5])} if m[5] else {}
        if name == "body":
            close("head")
        up = stack[-1][1]
        rank = 3 if name == "article" else 2 if name == "main" or attrs.get("role") == "main" else 1
        kind = Kind.NO
        if name == "form":
            kind = Kind.FORM
        elif name in SKIPPED or name == "header" and not opened["article"] and not opened["main"]:
            kind = Kind.TAG
        elif attrs and rank == 1 and name not in ("html", "body") and _listed(attrs):
            kind = Kind.WORDS
        if (rank > 1 or name == "body") and not opened["article"]:
            k = up
            while k >= 0 and not holds[k]:
                holds[k] = True
                k = nodes[k][1]
        label = name + "." + re.sub(r"[0-9]+", "#", ".".join(sorted(attrs.get("class", "").split())))
        nodes.append([_chain(nodes[up][0], label), up, rank, 0, nodes[up][4] + 1, len(nodes) + len(found)])
        for column, value in ((kinds, kind), (controls, 0), (links, 0), (words, 0), (holds, False)):
            column.append(value)
        stack.append((name, len(nodes) - 1))
        opened[name] += 1
    text(at, len(page))
    flush()
    for _, k in stack:
        if kinds[k] == Kind.TAG:
            kinds[k] = Kind.OPEN
    aside = _aside(nodes, kinds, controls, links, words, holds, found)
    spare = [text for k, text in found if aside[k] == Kind.WORDS]
    number: dict[int, int] = {}
    left: list[list] = []
    for k, (token, up, *rest) in enumerate(nodes):
        if not aside[k]:
            if kinds[k] == Kind.OPEN:  # an element never closed is no container: what it took in is its parent's
                number[k] = number[up]
            else:
                number[k] = len(left)
                left.append([token, number.get(up, -1), *rest])
    kept = [(number[k], text, place) for (k, text), place in zip(found, places) if not aside[k]]
    nodes = left
    for k, text, _ in kept:
        nodes[k][3] += len(text)
    _sum_up(nodes, [n[3] for n in nodes], 3)
    return nodes, [x[:2] for x in kept], [x[2] for x in kept], spare


def _sum_up(nodes: list, own: list[int], column: int | None = None) -> list[int]:
    """What each container and those inside it hold together, also as a column of ``nodes``."""
    for k in range(len(nodes) - 1, 0, -1):  # parents come first
        own[nodes[k][1]] += own[k]
    if column is not None:
        for node, value in zip(nodes, own):
            node[column] = value
    return own


def _aside(nodes, kinds, controls, links, words, holds, found) -> list[Kind]:
    """Per container, what it or a container around it was set aside for, or ``Kind.NO``."""
    chars = [0] * len(nodes)
    for k, text in found:
        chars[k] += len(text)
    _sum_up(nodes, chars)
    for column in (controls, links, words):
        _sum_up(nodes, column)
    by_tag = (Kind.TAG, Kind.OPEN, Kind.FORM)
    inside: list[bool] = []
    for node, kind in zip(nodes, kinds):
        inside.append(kind in by_tag or node[1] >= 0 and inside[node[1]])
    elsewhere = any(node[2] > 1 and chars[k] and not inside[k] for k, node in enumerate(nodes))
    out: list[Kind] = []
    for k, (node, kind) in enumerate(zip(nodes, kinds)):
        needed = holds[k] and (kind == Kind.WORDS or not elsewhere)
        if kind == Kind.OPEN:
            needed |= 5 * chars[k] >= chars[0] and 2 * links[k] <= chars[k]
        elif kind == Kind.FORM:
            needed |= words[k] > FORM_WORDS * controls[k]
        above = out[node[1]] if node[1] >= 0 else Kind.NO
        out.append(above or (Kind.NO if needed else kind))
    return out


def _listed(attrs: dict[str, str]) -> bool:
    """Whether a whole name of a class, id or role is made up of listed words."""
    return any((words := WORDS.findall(name)) and SKIPPED_WORDS.issuperset(words) for v in attrs.values() for name in v.lower().split())


SCHEMA = ("page_id long, url string, host string, page long, content long, "
          "tokens array<struct<token:long,n:int,chars:long,most:boolean,rank:int,depth:int,place:int,last:int>>, body binary")


def _inside(nodes: list, which) -> list[bool]:
    """Per container, whether it is one of those or lies in one (parents come first)."""
    inside: list[bool] = []
    for k, node in enumerate(nodes):
        inside.append(bool(which(k, node)) or node[1] >= 0 and inside[node[1]])
    return inside


def content_hash(nodes: list, blocks: list[tuple[int, str]]) -> int:
    """The hash of a page's content."""
    whole = nodes[0][3]
    slot = max(range(len(nodes)), key=lambda k: (nodes[k][2], -k) if nodes[k][2] > 1 else (1, nodes[k][4]) if 10 * nodes[k][3] >= 8 * whole else (0, 0))
    inside = _inside(nodes, lambda k, _: k == slot)
    return xxhash.xxh64_intdigest("\n".join(text for k, text in blocks if inside[k]).encode("utf-8", "surrogatepass")) - (1 << 63)


def _mark(container: int, text: str) -> int:
    """The token of a text block in its place."""
    return _chain(container, " " + text)


def parsed(pages: DataFrame) -> DataFrame:
    """Pages with their tokens (container or text block, n times) and their compressed body: the
    containers' (token, parent), the blocks, and the page's own article or main element."""
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    src = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                       host.alias("host"), F.xxhash64(html).alias("page"), html.alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.name for f in out_schema]
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                tokens, contents, bodies = [], [], []
                for page in part.column(4):
                    nodes, blocks, places, spare = parse(page.as_py())
                    seen: dict[int, list[int]] = {}
                    ends = [node[5] for node in nodes]  # the last block inside
                    for (k, _), place in zip(blocks, places):
                        ends[k] = place
                    for k in range(len(nodes) - 1, 0, -1):
                        ends[nodes[k][1]] = max(ends[nodes[k][1]], ends[k])
                    for (token, _, rank, chars, depth, place), end in zip(nodes, ends):
                        e = seen.setdefault(token, [0, 0, rank, depth, place, place])
                        e[0] += 1
                        e[1] += chars
                        e[5] = max(e[5], end)
                    for (k, text), place in zip(blocks, places):
                        e = seen.setdefault(_mark(nodes[k][0], text), [0, 0, -1, 0, place, place])
                        e[0] += 1
                        e[1] += len(text)
                        e[5] = place
                    tokens.append([{"token": t, "most": 10 * e[1] >= 8 * nodes[0][3], **dict(zip(("n", "chars", "rank", "depth", "place", "last"), e))}
                                   for t, e in seen.items()])
                    contents.append(content_hash(nodes, blocks))
                    own = max(((n[2], -k, n[0]) for k, n in enumerate(nodes) if n[2] > 1), default=(0, 0, None))[2]
                    bodies.append(zlib.compress(json.dumps([[n[:3] for n in nodes], blocks, own, spare], ensure_ascii=False).encode("utf-8", "surrogatepass"), 3))
                yield pa.RecordBatch.from_arrays([*part.columns[:4], pa.array(contents, pa.int64()), pa.array(tokens, out_schema.field("tokens").type), pa.array(bodies, pa.binary())], names=names)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    out_schema = to_arrow_schema(StructType.fromDDL(SCHEMA))
    return src.mapInArrow(run, SCHEMA)


def distinct_pages(pages: DataFrame) -> DataFrame:
    """(host, page, tokens) of one page of each content."""
    return pages.groupBy("host", F.col("content").alias("page")).agg(F.min_by("tokens", "page").alias("tokens"))


def classes(pages: DataFrame) -> DataFrame:
    """(host, members): the tokens of each host's accepted equivalence classes."""
    distinct = distinct_pages(pages)
    size = distinct.groupBy("host").agg(F.count("*").alias("pages"))
    tokens = distinct.select("host", "page", F.explode("tokens").alias("x")).select("host", "page", "x.*")
    vectors = (tokens.groupBy("host", "token").agg(
        F.count("*").alias("support"), F.max("n").alias("often"), F.sum(F.col("most").cast("int")).alias("votes"), F.max("rank").alias("rank"),
        F.min("depth").alias("depth"), F.bit_xor(F.xxhash64(F.lit(1), "page", "n")).alias("v1"),
        F.bit_xor(F.xxhash64(F.lit(2), "page", "n")).alias("v2")))
    frequent = vectors.where("often = 1 AND (rank >= 0 OR support > 1)").join(size, "host").where("2 * support >= pages")
    return (frequent.groupBy("host", "v1", "v2").agg(F.collect_list(F.struct("token", "rank", "depth", (2 * F.col("votes") >= F.col("pages")).alias("most"), "v1", "v2")).alias("members"))
            .where(F.size("members") >= LEAST_MEMBERS).groupBy("host").agg(F.flatten(F.collect_list("members")).alias("members")))


def placed(pages: DataFrame, accepted: DataFrame) -> DataFrame:
    """(host, token, rank, depth, most, place, keeps): where a class's members stand in it, page by
    page, and whether a container keeps half of its text without the member texts before and after.
    Containers are counted among the containers, texts among all members."""
    joined = distinct_pages(pages).join(accepted, "host").select("host", "tokens", "members")
    schema = "host string, token long, rank int, depth int, most boolean, place int, keeps int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                out: list[tuple] = []
                for host, tokens, members in zip(*(c.to_pylist() for c in b.slice(lo, 256).columns)):
                    at = {x["token"]: x["place"] for x in tokens}
                    known = {m["token"] for m in members}
                    page = {x["token"]: x for x in tokens}
                    texts = sorted((x for x in tokens if x["rank"] < 0), key=lambda x: x["place"])
                    starts = [x["place"] for x in texts]
                    ahead = list(accumulate((x["chars"] for x in texts), initial=0))
                    free = [i for i, x in enumerate(texts) if x["token"] not in known]

                    def keeps(box: dict) -> bool:
                        lo, hi = bisect_right(starts, box["place"]), bisect_right(starts, box["last"])
                        a, z = bisect_left(free, lo), bisect_left(free, hi)
                        held = ahead[hi] - ahead[lo]
                        return 2 * (ahead[free[z - 1] + 1] - ahead[free[a]] if z > a else 0) >= held

                    counts: dict[tuple[int, int], list[int]] = {}
                    for m in sorted((m for m in members if m["token"] in at), key=lambda m: at[m["token"]]):
                        c = counts.setdefault((m["v1"], m["v2"]), [0, 0])
                        out.append((host, m["token"], m["rank"], m["depth"], m["most"], c[m["rank"] < 0],
                                    int(m["rank"] in (0, 1) and keeps(page[m["token"]]))))
                        c[1] += 1
                        c[0] += m["rank"] >= 0
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)], names=names)

    types = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int32(), pa.int32()]
    names = ["host", "token", "rank", "depth", "most", "place", "keeps"]
    return joined.mapInArrow(run, schema)


def templates(pages: DataFrame) -> DataFrame:
    """(host, main, fixed): the token of the host's main container, and the marks of its template
    text, none if that is an article or main element or would lose most of its text."""
    places = placed(pages, staged(classes(pages), "page-classes"))
    flat = (places.groupBy("host", "token", "rank", "depth", "most", "place").agg(F.count("*").alias("n"), F.sum("keeps").alias("keeps"))
            .groupBy("host", "token", "rank", "depth", "most").agg(F.max("n").alias("usual"), F.sum("n").alias("n"), F.sum("keeps").alias("keeps"))
            .where("10 * usual >= 9 * n"))
    order = F.when(F.col("rank") > 1, -F.col("depth")).otherwise(F.col("depth"))  # outermost article, deepest container
    slot = F.when((F.col("rank") > 1) | (F.col("rank") >= 0) & F.col("most"),
                  F.struct(F.greatest("rank", F.lit(1)).alias("rank"), order.alias("order"), "token", (2 * F.col("keeps") >= F.col("n")).alias("keeps")))
    return (flat.withColumn("slot", slot).groupBy("host")
            .agg(F.max("slot").alias("slot"), F.collect_list(F.when(F.col("rank") < 0, F.col("token"))).alias("fixed"))
            .select("host", F.col("slot").getItem("token").alias("main"),
                    F.when((F.col("slot").getItem("rank") > 1) | ~F.col("slot").getItem("keeps"), F.array().cast("array<long>"))
                    .otherwise(F.col("fixed")).alias("fixed")))


def slot_text(body: bytes, main: int | None, fixed: set[int]) -> str:
    """The text of a page's slot: its main container from the first to the last block that is
    no template text, or what is around it where that holds too little of the page."""
    nodes, blocks, own, spare = json.loads(zlib.decompress(body))
    at = next((k for k, (token, _, _) in enumerate(nodes) if token == main), None)
    if at is None:
        main = own
        fixed = fixed if own is None else set()
    inside = _inside(nodes, lambda _, node: main is None or node[0] == main)
    held = [i for i, (k, _) in enumerate(blocks) if inside[k]]
    own_text = {i for i, (k, text) in enumerate(blocks) if not fixed or _mark(nodes[k][0], text) not in fixed}
    free = [i for i in held if i in own_text]
    slot = held[held.index(free[0]):held.index(free[-1]) + 1] if free else []
    if at is not None and nodes[at][2] < 2:
        free, size, first = sorted(own_text.union(slot)), [0] * len(nodes), at
        for i in free:
            size[blocks[i][0]] += len(blocks[i][1])
        _sum_up(nodes, size)
        held = sum(len(blocks[i][1]) for i in slot)
        while 10 * held < 8 * size[0] and nodes[at][1] >= 0:
            at = nodes[at][1]
            held = size[at]
        if at != first:
            inside = _inside(nodes, lambda k, _: k == at)
            slot = [i for i in free if inside[blocks[i][0]]]
    return " ".join([blocks[i][1] for i in slot] or [text for _, text in blocks] or spare)


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars, one row per row of ``pages``."""
    rows = staged(parsed(pages), "pages-parsed")
    # written, so that the join below has an exchange on either side and a host with a third
    # of all pages can be split
    known = staged(templates(rows), "page-templates")
    joined = rows.select("page_id", "url", "host", "body").join(known, "host", "left").select("page_id", "url", "body", "main", "fixed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                text = [slot_text(x.as_py(), m.as_py(), {*(f.as_py() or ())}) for x, m, f in zip(*part.columns[2:])]
                yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array(text, pa.string()), pa.array(map(len, text), pa.int64())],
                                                 names=["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(run, "page_id long, url string, text string, n_chars long")
