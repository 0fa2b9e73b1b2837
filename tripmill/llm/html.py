"""Main text of web pages by template deduction over the pages of a host.

A page is cut into blocks of text, each with its path of elements. Tokens of a page are its element paths
and its texts at their paths. In Spark every token of a host gets its occurrence vector, how often each
page has it, as a hash over pages; pages with the same texts count once. Tokens with equal vectors form an
equivalence class. A class on enough pages is valid if it holds an element path, on which its texts hang, so
that texts which only repeat are no template; in a second pass over the pages its texts are held to their
order, and one that changes places within its class is no template. What is left are slots: text that varies
between pages. Slots nest by the paths of their elements: text counts for its element and all around it.

The article is the innermost element of the template that holds nearly all (MAIN_SHARE) of the varying text of
its pages, with all slots in it, the texts that repeat in the same elements as its slots, and varying sections
beside it. Elements whose names or classes say that they are menus, footers, forms,
adverts, comments and the like are left out before, wherever they lie. Hosts with few pages have no template;
there, and on pages without that element, it is chosen by the text of the page alone.

Tag names come last, as a check: a page with an `article` or `main` element has all text of that, and only that.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.llm.common import stored, without

MIN_PAGES = 5
#: A class is valid if its tokens occur on this share of a host's pages.
SHARE = 0.3
#: The article's element holds this share of the varying text of the pages it is on.
MAIN_SHARE = 0.8
#: Templates of more hosts than this are joined with a shuffle, those of fewer are broadcast.
BROADCAST_HOSTS = 2_000
#: Tokens that a broadcast template may hold in all.
BROADCAST_TOKENS = 200_000

# Element names of HTML and the words by which pages mark what is not the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu nav noscript object ol "
    "option p pre section select summary svg table tbody td template textarea tfoot th thead title tr ul".split()
)
NOT_TEXT = frozenset(
    "aside button dialog footer form head iframe menu nav noscript object select svg template textarea title canvas "
    "audio video map datalist".split()
)
TEXT_LEAF = frozenset(
    "p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre table tbody thead tfoot tr td th caption figure figcaption "
    "address hgroup summary details".split()
)
ARTICLE = frozenset("article main".split())
NOISE = frozenset(
    "ad ads adsense advert adverts advertisement advertising adbox banner breadcrumb breadcrumbs byline-share comment "
    "comments commentlist consent cookie cookies copyright discussion disqus feedback footer gdpr lightbox login masthead "
    "menu modal nav navbar navigation newsletter notice notices notification outbrain pager pagination popup promo "
    "promoted promotion recommended related replies reply respond responses share sharing sidebar signup skip social "
    "sponsor sponsored subscribe subscription taboola toolbar topbar widget widgets alert aside".split()
)
HEADER_WORDS = frozenset("header topnav".split())
NOISE_ROLES = frozenset(
    "navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split()
)

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|textarea|title|xmp|noembed|noframes)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|</?[a-z](?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>"
    r"|</?[a-z][^>]*+(?:>|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)|</[^>]*+(?:>|\Z)",
    re.I | re.S,
)
NAME = re.compile(r"</?([a-z][^\s/>]*)", re.I)
ATTRIBUTE = re.compile(r"""([a-z][a-z0-9:_-]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)"

OPEN_CLOSES = {
    "li": ("li", {"ul", "ol", "menu"}),
    "dt": ("dd dt", {"dl"}),
    "dd": ("dd dt", {"dl"}),
    "tr": ("tr td th", {"table"}),
    "td": ("td th", {"tr", "table"}),
    "th": ("td th", {"tr", "table"}),
    "option": ("option", {"select"}),
}


class Tag:
    """A start tag: its name, its label in paths, and whether it opens an article or leaves text out."""

    __slots__ = ("name", "label", "article", "noise", "closed", "header")

    def __init__(self, raw: str) -> None:
        self.name = NAME.match(raw)[1].lower()
        self.closed = self.name in VOID
        given: dict[str, str] = {}
        for key, value in ATTRIBUTE.findall(raw[len(self.name) + 1 :]):
            given.setdefault(key.lower(), value.strip("\"'"))
        marks = f"{given.get('class', '')} {given.get('id', '')}".strip()
        role = given.get("role", "").lower()
        self.label = ".".join([self.name, *sorted(set(re.sub(r"\d+", "", marks).split()))])
        self.article = self.name in ARTICLE or role in ("main", "article") or given.get("itemprop", "").lower() == "articlebody"
        words = {w.lower() for w in WORDS.findall(marks)}
        hidden = "hidden" in given or given.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", given.get("style", ""))
        region = self.name in ("html", "body") or self.article
        self.noise = bool(hidden) or self.name in NOT_TEXT or (not region and (bool(words & NOISE) or role in NOISE_ROLES))
        # A heading of an article may lie in a header element; a header of the page is no part of it.
        self.header = not region and (self.name == "header" or bool(words & HEADER_WORDS))


_tags: dict[str, Tag] = {}


def tag_of(raw: str) -> Tag:
    found = _tags.get(raw)
    if found is None:
        if len(_tags) > 50_000:
            _tags.clear()
        found = _tags[raw] = Tag(raw)
    return found


class Block:
    """A run of text: its path, its container's path, its text, whether it is in an article or left out."""

    __slots__ = ("path", "container", "text", "article", "noise")

    def __init__(self, stack: list[Tag], text: str) -> None:
        labels = [t.label for t in stack if t.name in BLOCK]
        names = [t.name for t in stack if t.name in BLOCK]
        self.path, self.text = "/".join(labels), text
        while names and names[-1] in TEXT_LEAF:
            names.pop()
        self.container = "/".join(labels[: len(names)])
        self.article = any(t.article for t in stack)
        self.noise = any(t.noise for t in stack) or (not self.article and any(t.header for t in stack))


def blocks_of(html: str | None) -> list[Block]:
    """Blocks of a page in page order, white space within each turned into one space; empty ones left out."""
    out: list[Block] = []
    stack: list[Tag] = []
    pieces: list[str] = []

    def end_block() -> None:
        if pieces:
            text = " ".join("".join(pieces).split())
            pieces.clear()
            if text:
                out.append(Block(stack, text))

    def pop_to(names: set[str] | tuple[str, ...], stop: set[str]) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i].name in names:
                del stack[i:]
                return
            if stack[i].name in stop:
                return

    html = html or ""
    at = 0
    for found in MARKUP.finditer(html):
        start = found.start()
        if start > at:
            said = html[at:start]
            pieces.append(unescape(said) if "&" in said else said)
        at = found.end()
        raw = found[0]
        if raw[1] in "!?" or found[1] or len(raw) < 3:
            if found[1] and found[1].lower() in BLOCK:
                end_block()
            continue
        if raw[1] == "/":
            name = NAME.match(raw)
            if not name:
                continue
            name = name[1].lower()
            if name in BLOCK:
                end_block()
                pop_to((name,), {"article", "main", "body"} - {name} if name in TEXT_LEAF else set())
            elif name == "br":
                pieces.append(" ")
            else:
                pop_to((name,), BLOCK)
            continue
        tag = tag_of(raw)
        if tag.name in BLOCK:
            end_block()
            pop_to(("p",), {"article", "body", "div", "section", "td", "th", "li", "blockquote", "main", "aside", "button", "object", "figure"})
            if tag.name in OPEN_CLOSES:
                names, stop = OPEN_CLOSES[tag.name]
                pop_to(tuple(names.split()), stop)
        elif tag.name == "br":
            pieces.append(" ")
        if not tag.closed and not (raw.endswith("/>") and tag.name in ("svg", "path")):
            stack.append(tag)
    if at < len(html):
        said = html[at:]
        pieces.append(unescape(said) if "&" in said else said)
    end_block()
    return out


def token(*parts: str) -> int:
    return xxhash.xxh64_intdigest("\x00".join(parts)) - (1 << 63)


def prefixes(path: str) -> list[str]:
    labels = path.split("/")
    return ["/".join(labels[: i + 1]) for i in range(len(labels))]


def weights(blocks: list[Block]) -> Counter:
    """Length of the text in each element path, with all that lies below it."""
    sizes: Counter = Counter()
    for b in blocks:
        for p in prefixes(b.container):
            sizes[p] += len(b.text)
    return sizes


def main_path(varying: list[Block], main: int | None) -> str | None:
    """Path of the main element; on a page without it, of the innermost element that holds nearly all varying text."""
    paths = {p for b in varying for p in prefixes(b.container)}
    if main is not None:
        for p in paths:
            if token("path", p) == main:
                return p
    sizes = weights(varying)
    whole = sum(len(b.text) for b in varying)
    held = [p for p in sizes if sizes[p] >= MAIN_SHARE * whole]
    return max(held, key=lambda p: (p.count("/"), sizes[p], p)) if held else None


def beside(container: str, best: str) -> bool:
    """Whether an element next to the main one is a part of the article.

    That holds for a `section`, for text right in their common parent, and for an element that has no class
    of its own or one of the main element's; in the body itself only for a `section`.
    """
    parent, _, own = best.rpartition("/")
    if not parent or not (container == parent or container.startswith(parent + "/")):
        return False
    label = container[len(parent) + 1 :].split("/")[0]
    name, *marks = label.split(".")
    if name == "section":
        return True
    if parent.rpartition("/")[2].split(".")[0] in ("body", "html"):
        return False
    return not marks or bool(set(marks) & set(own.split(".")[1:]))


def slots_of(blocks: list[Block], template_texts: set[int], main: int | None) -> list[Block]:
    """Blocks in the slots of the main element, with the sections of the article beside it.

    A text that repeats over the host's pages stays where its element also has varying text of this page, such as a
    heading that every article has; right in the body only between varying texts.
    """
    varies = [token("text", b.path, b.text) not in template_texts for b in blocks]
    varying = [b for b, v in zip(blocks, varies) if v]
    best = main_path(varying, main)
    if best is None:
        return varying
    slot = {b.container for b in varying if best in prefixes(b.container) or beside(b.container, best)}
    at = [i for i, (b, v) in enumerate(zip(blocks, varies)) if v and b.container in slot]
    in_body = {c for c in slot if c.rpartition("/")[2].split(".")[0] in ("body", "html", "")}
    return [
        b
        for i, (b, v) in enumerate(zip(blocks, varies))
        if b.container in slot and (v or b.container not in in_body or at[0] < i < at[-1])
    ]


def main_text(html: str | None, template_texts: set[int], main: int | None) -> str:
    blocks = [b for b in blocks_of(html) if not b.noise]
    found = slots_of(blocks, template_texts, main)
    # The check by tag names comes last: a page that marks its article has all of that, and nothing else.
    return "\n".join(b.text for b in [b for b in blocks if b.article] or found)


TOKENS = "host string, token long, is_text boolean, sign long"


def page_tokens(pages: DataFrame) -> DataFrame:
    """Tokens of each page, once per page, with a hash of its texts and the count. `pages` has host, page, html."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for host, html in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                blocks = [b for b in blocks_of(html) if not b.noise]
                body = xxhash.xxh64_intdigest("\x00".join(b.text for b in blocks))
                counts: Counter = Counter()
                for b in blocks:
                    counts[token("text", b.path, b.text), True] += 1
                    for p in prefixes(b.container):
                        counts[token("path", p), False] += 1
                        counts[token("here", p), False] = 1
                counts[0, False] = 1  # the page itself
                for key, n in counts.items():
                    rows.append((host, *key, xxhash.xxh64_intdigest(f"{body} {n}") - (1 << 63)))
            columns = list(zip(*rows)) or [[] for _ in range(4)]
            kinds = [pa.string(), pa.int64(), pa.bool_(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["host", "token", "is_text", "sign"]
            )

    return pages.select("host", "page", "html").mapInArrow(run, TOKENS)


def classes_of(pages: DataFrame) -> DataFrame:
    """(host, kinds, groups, tokens): tokens on enough pages, with their equivalence class; lists in step.

    Pages with the same texts are one page: a group of copies says nothing about the template. A host's
    template is bounded by the tokens of a page divided by SHARE, however many pages it has.
    """
    counted = page_tokens(pages).distinct().groupBy("host", "token", "is_text").agg(
        F.count("*").alias("pages"), F.bit_xor("sign").alias("vector")
    )
    counted = stored(counted, "tokens")
    sizes = counted.filter("token = 0").select("host", F.col("pages").alias("all_pages")).filter(F.col("all_pages") >= MIN_PAGES)
    # Tokens on too few pages for the smallest host are no template anywhere; they are most of a host's tokens.
    often = counted.filter((F.col("token") != 0) & (F.col("pages") >= MIN_PAGES * SHARE))
    valid = often.join(sizes, "host").filter(F.col("pages") >= F.col("all_pages") * SHARE)
    listed = F.collect_list(F.struct("token", "is_text", F.xxhash64("vector", "pages").alias("group")))
    return valid.groupBy("host").agg(listed.alias("l")).select(
        "host", F.col("l.token").alias("tokens"), F.col("l.is_text").alias("kinds"), F.col("l.group").alias("groups")
    )


def with_hosts(pages: DataFrame, found: DataFrame, on: str, tokens: str) -> DataFrame:
    size = found.agg(F.count("*").alias("hosts"), F.coalesce(F.sum(F.size(tokens)), F.lit(0)).alias("tokens")).first()
    small = size["hosts"] <= BROADCAST_HOSTS and size["tokens"] <= BROADCAST_TOKENS
    return pages.join(F.broadcast(found) if small else found, on, "left")


def anchored(tokens: list[int], kinds: list[bool], groups: list[int]) -> dict[int, int]:
    """Class of each token. A class of texts only is data that repeats, not template, and is left out."""
    built = {g for g, text in zip(groups, kinds) if not text}
    return {t: g for t, g in zip(tokens, groups) if g in built}


def templates(pages: DataFrame) -> DataFrame:
    """(host, texts, main, classes): the template of each host with enough pages.

    `texts` are the text tokens of valid classes, `main` the path token of the innermost element that holds
    the varying text of its pages, `classes` the number of equivalence classes on enough pages.
    """
    found = stored(classes_of(pages), "classes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            kept: dict[str, dict[int, int]] = {}
            names = ("host", "html", "tokens", "kinds", "groups")
            at = {n: batch.column(batch.schema.get_field_index(n)) for n in names}
            for i in range(batch.num_rows):
                host = at["host"][i].as_py()
                if host not in kept:
                    kept[host] = anchored(*(at[n][i].as_py() for n in names[2:]))
                of = kept[host]
                blocks = [b for b in blocks_of(at["html"][i].as_py()) if not b.noise]
                texts = [token("text", b.path, b.text) for b in blocks]
                sizes = weights([b for b, t in zip(blocks, texts) if t not in of])
                whole = sum(len(b.text) for b, t in zip(blocks, texts) if t not in of)
                ranks: Counter = Counter()
                seen = set()
                for b, t in zip(blocks, texts):
                    for depth, p in enumerate(prefixes(b.container)):
                        k = token("path", p)
                        if k in of and k not in seen:
                            seen.add(k)
                            rows.append((host, k, False, ranks[of[k]], depth, sizes[p], whole))
                            ranks[of[k]] += 1
                    if t in of and t not in seen:
                        seen.add(t)
                        rows.append((host, t, True, ranks[of[t]], 0, 0, 0))
                        ranks[of[t]] += 1
            columns = list(zip(*rows)) or [[] for _ in range(7)]
            kinds = [pa.string(), pa.int64(), pa.bool_(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["host", "token", "is_text", "rank", "depth", "inside", "whole"],
            )

    rows = with_hosts(pages.select("host", "html"), found, "host", "tokens").filter("tokens IS NOT NULL")
    checked = (
        rows.mapInArrow(run, "host string, token long, is_text boolean, rank long, depth long, inside long, whole long")
        .groupBy("host", "token", "is_text")
        # Tokens of a class that change places are out of order.
        .agg(
            (F.min("rank") == F.max("rank")).alias("ordered"),
            F.max("depth").alias("depth"),
            F.sum("inside").alias("inside"),
            F.sum("whole").alias("whole"),
        )
    )
    # The innermost element of those that hold nearly all varying text of their pages, and are on most text's pages.
    held = F.expr("NOT is_text AND whole > 0") & (F.col("inside") >= MAIN_SHARE * F.col("whole"))
    template = checked.groupBy("host").agg(
        F.collect_list(F.when(F.col("is_text") & F.col("ordered"), F.col("token"))).alias("texts"),
        F.collect_list(F.when(held, F.struct("depth", "inside", "token", "whole"))).alias("held"),
    ).withColumn("main", F.expr("array_max(filter(held, x -> 2 * x.whole >= array_max(held.whole))).token"))
    return template.join(found.select("host", F.size(F.array_distinct("groups")).cast("long").alias("classes")), "host").select(
        "host", "texts", "main", "classes"
    )


def extract(pages: DataFrame, *, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """The table with `text`, the main text of each page: blocks in page order, joined by line ends.

    A null or empty page, or one without an article, gives an empty text. Pages without a host in their
    URL share one host. Every row keeps its columns; a column named text is replaced. Unclosed elements,
    cut pages and stray tags are read as far as they go.
    """
    base = without(pages, ["text", "__host", "__texts", "__main"])
    host = F.lower(F.regexp_extract(F.coalesce(F.col(f"`{url_column}`"), F.lit("")), HOST, 1))
    hosted = base.withColumn("__host", host)
    found = stored(
        templates(
            hosted.select(
                F.col("__host").alias("host"),
                F.xxhash64(F.col(f"`{id_column}`"), F.col(f"`{url_column}`")).alias("page"),
                F.col(f"`{html_column}`").alias("html"),
            )
        ).select(F.col("host").alias("__host"), F.col("texts").alias("__texts"), F.col("main").alias("__main")),
        "templates",
    )
    joined = with_hosts(hosted, found, "__host", "__texts")

    columns = [c for c in base.columns]
    schema = T.StructType([*base.schema.fields, T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for html, tokens, main in zip(*(batch.column(c).to_pylist() for c in (html_column, "__texts", "__main"))):
                texts.append(main_text(html, set(tokens or ()), main))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(texts, pa.string())], names=[*columns, "text"]
            )

    return joined.select(*[F.col(f"`{c}`") for c in columns], "__texts", "__main").mapInArrow(run, schema)
