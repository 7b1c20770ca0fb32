"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree: an element node for each path of
tags and classes.  Over the pages each node has presentation styles (the
sequences of its block children) and contents (the phrases of the text it holds
itself).  Both are measured by entropy over the pages the node is on: a menu
that looks and reads the same on every page has entropy 0 in both, an article's
paragraphs are all different.

    presentation = sum of -p log_m p over the node's styles
    content      = mean of 1 - log_m n over the phrases in the node and below it
    importance   = (1 - GAMMA ** l) * presentation + GAMMA ** l * content

(m: pages with the node, n: those with the phrase there, l: number of styles; a
node without block children has its content alone).  A node seen on few pages
leans on the node of the same tags and class over all hosts, and that on 1, each
as strong as ``PRIOR`` pages.  A node is as important as the most important text
in it.  Pages that are equal but for scripts, styles and comments count once.

A block under ``LEAST`` importance (of the node that holds it) goes.  Tags and
classes are evidence beside: of paragraphs and headlines less is asked (by
``PROSE``), of blocks in an article still less (by ``INSIDE``), and paragraphs
of an article stay.  Blocks in a branch that names itself menu, header, footer,
sidebar, notice, advert, form or comments go, as do those beside an article or
main element with text.  A class counts by whole tokens (``has-sidebar`` names
no sidebar).  Names never take the main part away: where they leave nothing
but headlines that the tree thinks important, they alone decide, and where that
is nothing, importance alone does.

Text: character references are decoded, white space inside a block becomes one
space, blocks are joined in page order by two newlines.

Defined results: null and empty html give an empty text; a page whose url has
no host belongs to the host ''; markup may be broken or cut off anywhere;
repeated rows are extracted each on their own.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, row_count_at_most, short_batches, signed, table

GAMMA = 0.9
LEAST = 0.85
#: Pages that what is known beforehand weighs.
PRIOR = 80.0
#: What being a paragraph or headline, and what being in an article, takes from what is asked.
PROSE, INSIDE = 0.35, 0.75
#: Parts over which the pages of one host are dealt where branches aren't broadcast.
SALT = 16
#: Branch rows that may be broadcast; more are joined by host.
BROADCAST_ROWS = 100_000

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(?P<raw>script|style|noscript|template|textarea|title|iframe|svg|math|object|select|xmp|noframes)\b(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.DOTALL | re.IGNORECASE,
).finditer
_DIGITS = re.compile(r"[0-9]+").sub
_CLASS = re.compile(r"(?<![\w-])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE).findall

_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
_NOISE_TAGS = set("nav footer header aside form button input select label menu dialog head".split())
_HEADS = set("h1 h2 h3 h4 h5 h6".split())
_PROSE = _HEADS | set("p blockquote pre caption figcaption td th".split())
_ENDS_P = _BLOCK - {"body", "html", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "legend", "option", "optgroup"}
#: An open element that a start tag of the other names closes.
_CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "tr": {"tr"}, "option": {"option"}}
#: Words of a class, id or role that say a branch isn't the article, and words that may stand beside them.
_NOISE_WORDS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay "
    "nav navbar navigation menu menus breadcrumb breadcrumbs sidebar aside footer header masthead topbar toolbar comment comments disqus replies respond reply "
    "share sharing social related recommended recommendations newsletter subscribe subscription signup login search pagination pager widget widgets copyright "
    "legal disclaimer skip complementary contentinfo".split()
)
_BESIDE = set("site page main global top bottom left right primary secondary upper lower inner outer list lists box container wrapper wrap bar bars area block col column row section group panel item items link links button buttons form slot unit icons text the my js".split())
#: Of these a compound's last word is enough: what comes before says whose they are.
_ALWAYS = set("comments replies ads adverts advertisement advertisements breadcrumbs pagination newsletter".split())
_WORDS = re.compile(r"[a-z]+").findall
_PHRASES = re.compile(r"[.!?;:|\u00b7\u2022\u2013\u2014]+").split


def _named(marks: str) -> bool:
    """Whether a whole token of a class, id or role names a part that isn't the article."""
    for token in marks.split():
        words = _WORDS(token)
        if not _NOISE_WORDS.isdisjoint(words) and (_NOISE_WORDS.union(_BESIDE).issuperset(words) or (words[-1] in _ALWAYS and words[0] not in ("has", "with", "no", "without", "not"))):
            return True
    return False


def _node(path: int, name: str) -> int:
    return xxhash.xxh3_64_intdigest(name, seed=path)


class Page:
    """The blocks of a page with the element nodes around each."""

    __slots__ = ("nodes", "blocks", "has_main", "source", "by_class", "noisy", "root")

    def __init__(self, source: str, by_class: bool = True, root: int = 0):
        #: (path, tag, noise, in main, block children, path of tags alone, that with the own class)
        self.nodes: list[list] = []
        #: (open nodes, text)
        self.blocks: list[tuple[tuple[int, ...], str]] = []
        self.source, self.by_class, self.root = source, by_class, root
        #: whether an article's own class made it noise
        self.noisy = False
        self._parse(source)
        #: whether an article or main element that isn't noise has text
        self.has_main = any(any(self.nodes[n][3] for n in around) and not any(self.nodes[n][2] for n in around) for around, _ in self.blocks)

    def _parse(self, source: str) -> None:
        nodes, blocks = self.nodes, self.blocks
        stack: list[int] = []  # places in nodes
        tags: list[str] = []
        words: list[str] = []

        def flush() -> None:
            if words:
                text = " ".join(html.unescape("".join(words)).split())
                words.clear()
                if text:
                    blocks.append((tuple(stack), text))

        def close(depth: int) -> None:
            while len(stack) > depth:
                if tags[-1] in _BLOCK:
                    flush()
                stack.pop()
                tags.pop()

        for m in _TOKEN(source):
            kind = m.lastgroup
            if kind == "text":
                words.append(m["text"])
                continue
            tag = m["tag"]
            if tag is None:
                if m["raw"] or m[0].startswith("<!--"):
                    words.append("" if m[0].startswith("<!--") else " ")
                continue
            tag = tag.lower()
            if m["close"]:
                if tag == "p" and "p" not in tags:
                    flush()
                elif tag in tags:
                    close(len(tags) - 1 - tags[::-1].index(tag))
                continue
            if tag in _VOID:
                words.append(" ") if tag != "wbr" else None
                if tag == "hr":
                    flush()
                continue
            if tag in _ENDS_P and "p" in tags:
                close(len(tags) - 1 - tags[::-1].index("p"))
            if tag in _CLOSED_BY:
                for depth in range(len(tags) - 1, -1, -1):
                    if tags[depth] in ("ul", "ol", "dl", "table", "select"):
                        break
                    if tag in _CLOSED_BY.get(tags[depth], ()):
                        close(depth)
                        break
            if tag in _BLOCK:
                flush()
            attrs = m["attrs"]
            marks = " ".join(filter(None, (x for some in _CLASS(attrs) for x in some))).lower() if attrs and "=" in attrs else ""
            parent = nodes[stack[-1]] if stack else None
            own = _DIGITS("", marks)
            path = _node(parent[0] if parent else self.root, f"{tag} {own}")
            plain = _node(parent[5] if parent else 0, tag)
            if parent and tag in _BLOCK:
                parent[4].append(tag)
            outer_noise, inside = bool(parent and parent[2]), bool(parent and parent[3])
            named = bool(marks) and _named(marks)
            # a header of the article itself holds its headline
            noise = outer_noise or (tag in _NOISE_TAGS and not (tag == "header" and (inside or marks == "main"))) or named
            if tag in ("html", "body") or (tag in ("article", "main") and not self.by_class):
                noise = outer_noise
            elif tag in ("article", "main") and noise and not outer_noise:
                self.noisy = True
            main = inside or ((tag in ("article", "main") or marks == "main") and not noise)
            nodes.append([path, tag, noise, main, [], plain, _node(plain, own)])
            if not attrs.rstrip().endswith("/") or tag in _BLOCK:
                stack.append(len(nodes) - 1)
                tags.append(tag)
        flush()
        close(0)

    def holder(self, around: tuple[int, ...]) -> int:
        """The innermost of the open nodes that is a block; -1 where none is."""
        return next((n for n in reversed(around) if self.nodes[n][1] in _BLOCK), -1)

    def enough(self, around: tuple[int, ...], importance: Mapping[int, float], inside: bool, least: float) -> bool:
        """Whether the tree keeps a block."""
        n = self.holder(around)
        if n < 0:
            return True
        return importance.get(self.nodes[n][0], 1.0) >= least - (INSIDE if inside else PROSE if self.nodes[n][1] in _PROSE else 0.0)

    def text(self, importance: Mapping[int, float], names: bool = True, least: float = LEAST) -> str:
        """What is left by the importance of paths (those not in the mapping are 1), and by names or without them."""
        nodes = self.nodes
        importance = importance or {}
        inside = [names and any(nodes[n][3] for n in around) for around, _ in self.blocks]
        by_name = [not names or ((main or not self.has_main) and not any(nodes[n][2] for n in around)) for (around, _), main in zip(self.blocks, inside)]
        if not any(by_name) and self.noisy:  # there is no other text than what a class calls noise
            return Page(self.source, by_class=False, root=self.root).text(importance, names, least)
        by_tree = [self.enough(around, importance, main, least) for (around, _), main in zip(self.blocks, inside)]
        # inside the article a branch that holds paragraphs stays
        stays = [name and (tree or (main and any(nodes[n][1] == "p" and nodes[n][3] for n in around))) for name, tree, main, (around, _) in zip(by_name, by_tree, inside, self.blocks)]
        for others in (by_name, by_tree):
            if not any(x and self._body(b) for x, b in zip(stays, self.blocks)) and any(x and self._body(b) for x, b in zip(others, self.blocks)):
                stays = others  # nothing but headlines left: what repeats is the article
        return "\n\n".join(text for x, (_, text) in zip(stays, self.blocks) if x)

    def _body(self, block: tuple[tuple[int, ...], str]) -> bool:
        return _HEADS.isdisjoint(self.nodes[n][1] for n in block[0])


def host_of(url: str | None) -> str:
    m = re.match(r"(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else ""


_HOST = r"^(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)"
#: What differs between copies of a page.
_UNREAD = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
#: Kinds of counted rows: key, other, n.  Styles and phrases of a node of a host and over all hosts, the pages each is on,
#: and for a host's node its node over all hosts, the nodes it lies in (itself too) and the host.
_STYLE, _PHRASE, _PAGES, _ALL_STYLE, _ALL_PHRASE, _ALL_PAGES, _SAME, _WITHIN, _ROOT = range(9)


def with_copies(pages: DataFrame) -> DataFrame:
    """url, html and __weight: one over the number of pages of its host that are equal but for what isn't read."""
    rows = pages.select("url", "html", F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), _HOST, 1)).alias("__host"), F.xxhash64(F.regexp_replace(F.coalesce("html", F.lit("")), _UNREAD, "")).alias("__same"))
    copies = rows.groupBy("__host", "__same").count().where("count > 1")
    copies = copies.withColumnRenamed("count", "__copies")
    if row_count_at_most(copies, BROADCAST_ROWS):
        copies = F.broadcast(copies)
    return rows.join(copies, ["__host", "__same"], "left").select("url", "html", (1 / F.coalesce("__copies", F.lit(1))).alias("__weight"))


def root_of(url: str | None) -> int:
    """The root of a host's tree."""
    return xxhash.xxh3_64_intdigest(host_of(url).encode("utf-8", "surrogatepass"))


def style_counts(pages: DataFrame) -> DataFrame:
    """kind, key, other, n: what the pages show (``_STYLE`` and so on), each page by its weight."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            kind, key, other = (np.array(x, dtype=np.uint64) for x in zip(*counts))
            return pa.RecordBatch.from_arrays([pa.array(kind.astype(np.int32)), pa.array(signed(key)), pa.array(signed(other)), pa.array(list(counts.values()), pa.float64())], names=["kind", "key", "other", "n"])

        counts: dict[tuple[int, int, int], float] = {}
        for batch in batches:
            for url, source, weight in zip(*(batch.column(i).to_pylist() for i in range(3))):
                page = Page(source or "", root=root_of(url))
                rows, shown, known = set(), [], set()
                for around, text in page.blocks:
                    here = page.holder(around)
                    if here < 0:
                        continue
                    node = page.nodes[here]
                    if here not in known:
                        known.add(here)
                        rows.update(((_SAME, node[0], node[6]), (_ROOT, node[0], page.root), *((_WITHIN, node[0], page.nodes[n][0]) for n in around[: around.index(here) + 1] if page.nodes[n][1] in _BLOCK)))
                    for phrase in _PHRASES(text):
                        if phrase := phrase.strip():
                            what = xxhash.xxh3_64_intdigest(phrase)
                            rows.update(((_PHRASE, node[0], what), (_ALL_PHRASE, node[6], what)))
                for node in page.nodes:
                    if node[1] in _BLOCK:
                        rows.update(((_PAGES, node[0], 0), (_ALL_PAGES, node[6], 0)))
                        if node[4]:
                            style = xxhash.xxh3_64_intdigest(" ".join(node[4]))
                            shown += ((_STYLE, node[0], style), (_ALL_STYLE, node[6], style))
                for row in (*rows, *shown):
                    counts[row] = counts.get(row, 0.0) + weight
            if len(counts) > 300_000:
                yield out()
                counts = {}
        if counts:
            yield out()

    return pages.select("url", "html", "__weight").mapInArrow(run, "kind int, key long, other long, n double").groupBy("kind", "key", "other").agg(F.sum("n").alias("n"))


def summary(counts: DataFrame) -> DataFrame:
    """kind, key, other (of the last three kinds only), total, nlogn, variants: all that importance needs, a few numbers a node."""
    n = F.greatest("n", F.lit(1.0))
    link = F.when(F.col("kind") >= _SAME, F.col("other"))
    return counts.groupBy("kind", "key", link.alias("other")).agg(F.sum("n").alias("total"), F.sum(F.col("n") * F.log(n)).alias("nlogn"), F.count(F.lit(1)).alias("variants"))


def importance(found: DataFrame) -> DataFrame:
    """path, pages, presentation, content, own, importance of each node of a host that holds text."""
    of = lambda kind, *names: found.where(F.col("kind") == kind).select(F.col("key").alias("path"), *(F.col(c).alias(n) for c, n in names))

    def measured(styles: int, pages: int, phrases: DataFrame) -> DataFrame:
        """``phrases``: path, new (sum of 1 - entropy), read (phrases)."""
        out = of(pages, ("total", "pages")).join(of(styles, ("total", "styled"), ("nlogn", "style_nlogn"), ("variants", "l")), "path", "left").join(phrases, "path")
        span = F.greatest(F.log("pages"), F.log(F.lit(2.0)))
        presentation = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (F.log("styled") - F.col("style_nlogn") / F.col("styled")) / span))
        content = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("new") / F.col("read")))
        share = F.pow(F.lit(GAMMA), F.col("l"))
        mixed = F.when(F.col("l").isNull(), content).otherwise((1 - share) * presentation + share * content)
        return out.select("path", "pages", presentation.alias("presentation"), content.alias("content"), mixed.alias("measured"))

    def phrases(kind: int, pages: int) -> DataFrame:
        read = of(kind, ("total", "read"), ("nlogn", "nlogn")).join(of(pages, ("total", "on")), "path")
        return read.select("path", (F.col("read") - F.col("nlogn") / F.greatest(F.log("on"), F.log(F.lit(2.0)))).alias("new"), "read")

    weight = lambda c: F.greatest(F.col(c) - 1, F.lit(0.0))
    every = measured(_ALL_STYLE, _ALL_PAGES, phrases(_ALL_PHRASE, _ALL_PAGES))
    every = every.select(F.col("path").alias("same"), ((weight("pages") * F.col("measured") + PRIOR) / (weight("pages") + PRIOR)).alias("elsewhere"))
    within = of(_WITHIN, ("other", "outer"))
    below = phrases(_PHRASE, _PAGES).join(within, "path").groupBy(F.col("outer").alias("path")).agg(F.sum("new").alias("new"), F.sum("read").alias("read"))
    own = measured(_STYLE, _PAGES, below).join(of(_SAME, ("other", "same")), "path").join(every, "same", "left")
    own = own.withColumn("own", (weight("pages") * F.col("measured") + PRIOR * F.coalesce("elsewhere", F.lit(1.0))) / (weight("pages") + PRIOR))
    most = own.select("path", "own").join(within, "path").groupBy(F.col("outer").alias("path")).agg(F.max("own").alias("importance"))
    return own.join(most, "path").select("path", "pages", "presentation", "content", "own", "importance")


def unimportant(pages: DataFrame, scratch: Scratch, least: float = LEAST) -> DataFrame:
    """root, path, importance of the nodes that hold text and are less important than ``least``."""
    found = scratch.stage(summary(style_counts(with_copies(pages))), "summary")
    roots = found.where(F.col("kind") == _ROOT).select(F.col("key").alias("path"), F.col("other").alias("root"))
    return scratch.stage(importance(found).where(F.col("importance") < least).join(roots, "path").select("root", "path", F.col("importance").cast("float")), "low")


def extract(pages: DataFrame, keep: list[str] | None = None, least: float = LEAST, names: bool = True, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``keep`` columns of ``pages`` (all but html by default) with the main text, which replaces a column of that name.

    ``names`` false leaves the tree alone to decide.
    """
    spark = pages.sparkSession
    short_batches(spark)
    keep = [c for c in (pages.columns if keep is None else keep) if c not in ("html", "text")]
    low = unimportant(pages, Scratch(spark, "pages"), least)
    rows = pages.select(*keep, F.col("url").alias("__url"), F.col("html").alias("__html"))
    schema = T.StructType([*rows.schema.fields[: len(keep)], T.StructField("text", T.StringType())])
    few_paths = row_count_at_most(low, broadcast_rows)
    if few_paths:
        found = low.toArrow()  # at most broadcast_rows
        shared = spark.sparkContext.broadcast(dict(zip(found["path"].to_numpy().view(np.uint64).tolist(), found["importance"].to_pylist())))
    else:
        # by host; the pages of one host are dealt over SALT parts
        shared = None
        root = F.udf(lambda url: root_of(url) - (1 << 64 if root_of(url) >> 63 else 0), "long")
        parts = low.groupBy("root").agg(F.collect_list(F.struct("path", "importance")).alias("__low")).withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)))).withColumnRenamed("root", "__root")
        rows = rows.withColumn("__root", root("__url")).withColumn("__part", F.pmod(F.xxhash64("__html"), F.lit(SALT)).cast("int"))
        rows = rows.join(parts, ["__root", "__part"], "left").select(*keep, "__url", "__html", "__low")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(keep)
        for batch in batches:
            out = []
            lows = [shared.value] * batch.num_rows if shared else [{x["path"] & 0xFFFFFFFFFFFFFFFF: x["importance"] for x in some or ()} for some in batch.column(k + 2).to_pylist()]
            for url, source, some in zip(batch.column(k).to_pylist(), batch.column(k + 1).to_pylist(), lows):
                out.append(Page(source, root=root_of(url)).text(some, names, least) if source else "")
            yield pa.RecordBatch.from_arrays([*batch.columns[:k], pa.array(out, pa.string())], names=schema.names)

    return rows.mapInArrow(run, schema)


def op8_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract(table(spark, sf_dir, "pages"), keep=["page_id", "url"])
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
