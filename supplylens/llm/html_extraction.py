"""Main text of web pages with a site style tree.

The DOMs of a host's pages are merged into one tree whose nodes are style paths (tags with their classes from
the root down), whole: article, neutral and marked branches (menu, advert, form and the like) alike. Each node that
carries text gets an importance from two parts: its presentation, which of the three it is, and the entropy of its
content: text that is spread evenly over the pages of the host tells nothing, text of a single page tells all. The
texts of a node have an importance of their own in the same way. Nodes and texts of low importance are taken out of
every page. Pages are parsed once, in Python; merging, entropy and removal are joins and groupings.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplylens.llm.common import written
from supplylens.llm.url_filter import split_url


@dataclass(frozen=True)
class Weights:
    """``presentation`` is the share of presentation in a node's importance; below ``least`` it is removed.

    Entropy is measured against ``pages`` pages of a host at least, so that the little evidence of a small host weighs
    little, by one rule for hosts of any size. A marked node is out by its presentation, whatever its content.
    """

    presentation: float = 0.3
    least: float = 0.35
    pages: int = 8
    main: float = 1.0
    neutral: float = 0.5
    marked: float = -1.0


#: Presentation of a block: in a marked branch, in none of the named ones, in article or main.
MARKED, NEUTRAL, MAIN = 0, 1, 2


MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
TOKENS = re.compile(r"[a-z]+")
SPACE = re.compile(r"\s+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup, skipped up to their end tag.
RAW = frozenset("script style title textarea noscript template iframe noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody "
    "td tfoot th thead tr ul".split()
)
#: An element of these starts only after an open one of the same group has ended.
ENDS = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table body html article main section div select menu".split())
NOISE_TAGS = frozenset("nav footer aside form button select dialog menu object svg canvas audio video head".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar "
    "navigation menu sidebar footer cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe "
    "signup share sharing social related recommended breadcrumb breadcrumbs comment comments commentlist disqus replies "
    "pagination pager widget toolbar masthead alert login search".split()
)
KEEP = frozenset("html body article main".split())


def _noise(tag: str, attributes: str, in_main: bool) -> tuple[bool, str]:
    """Whether an element starts a branch of noise, and its style: the tag with its classes."""
    names, hidden = [], False
    for key, value in ATTRIBUTE.findall(attributes) if attributes.strip(" /") else ():
        key, value = key.lower(), value.strip("\"'").lower()
        if key in ("class", "id"):
            names += TOKENS.findall(value)
        elif key == "role":
            hidden |= bool(NOISE_ROLES.intersection(value.split()))
        elif key == "style":
            hidden |= "display:none" in value.replace(" ", "")
        elif key == "hidden":
            hidden |= value != "until-found"
        elif value == "true":
            hidden = True
    style = ".".join([tag, *sorted(set(names))])
    if tag in ("html", "body"):
        return False, style
    marked = any(n in NOISE_WORDS for n in names) and not (tag in ("article", "main") and "comment" not in names)
    header = not in_main and (tag == "header" or "header" in names)
    return tag in NOISE_TAGS or hidden or marked or header, style


def dom_blocks(html: str) -> list[tuple[int, int, str]]:
    """All text blocks of a page in order: hash of the style path, presentation, text.

    Marked text within a block of others is a block of its own behind it.
    """
    blocks: list[tuple[int, int, str]] = []
    stack: list[tuple[str, str, bool, bool, bool]] = []  # tag, style, in a marked branch, in main, part of the path
    held: list[str] = []
    marked: list[str] = []
    behind: list[tuple[int, int, str]] = []

    def block(parts: list[str], shown: int) -> list[tuple[int, int, str]]:
        text = " ".join(SPACE.sub(" ", unescape("".join(parts))).split())
        parts.clear()
        if not text:
            return []
        path = "/".join(s[1] for s in stack if s[4] and (shown == MARKED or s[0] in BLOCK))
        return [(xxhash.xxh64_intdigest(path) - (1 << 63), shown, text)]

    def flush() -> None:
        if marked:
            behind.extend(block(marked, MARKED))
        if held:
            blocks.extend(block(held, MAIN if stack and stack[-1][3] else NEUTRAL))
        blocks.extend(behind)
        behind.clear()

    def close(at: int) -> None:
        if any(s[0] in BLOCK for s in stack[at:]):
            flush()
        elif marked and any(s[4] for s in stack[at:]):
            behind.extend(block(marked, MARKED))
        del stack[at:]

    at, size = 0, len(html)
    while at < size:
        found = MARKUP.search(html, at)
        stop = found.start() if found else size
        if stop > at:
            (marked if stack and stack[-1][2] else held).append(html[at:stop])
        if not found:
            break
        at = found.end()
        end, tag, attributes = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if not tag:
            continue
        tag = tag.lower()
        if end:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    close(i)
                    break
                if stack[i][0] in ("article", "main", "body") and tag not in KEEP:
                    break
            continue
        if tag in RAW:
            done = re.compile(rf"</{re.escape(tag)}\s*[^>]*>", re.I).search(html, at)
            at = done.end() if done else size
            continue
        if tag == "br":
            (marked if stack and stack[-1][2] else held).append(" ")
            continue
        if tag in BLOCK:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p" or stack[i][0] in ENDS.get(tag, ()):
                    close(i)
                    break
                if stack[i][0] in SCOPE:
                    break
            flush()
        if tag in VOID:
            continue
        above = stack[-1] if stack else ("", "", False, False, False)
        noise, style = _noise(tag, attributes, above[3])
        starts = noise and not above[2]
        if starts and tag not in BLOCK:
            held.append(" ")
        stack.append((tag, style, above[2] or noise, above[3] or tag in ("article", "main"), starts or tag in BLOCK))
    flush()
    return blocks


def parse(html: str) -> list[tuple[int, bool, str]]:
    """The blocks that presentation alone speaks for, with the hash of the style path and whether in article or main:
    none of marked branches and, if any block lies in article or main, only such blocks."""
    blocks = [(node, shown == MAIN, text) for node, shown, text in dom_blocks(html) if shown != MARKED]
    return [b for b in blocks if b[1]] if any(b[1] for b in blocks) else blocks


def parsed(pages: DataFrame) -> DataFrame:
    """page_id, url, host, copy (hash of the unmarked blocks, if any) and blocks (node, shown, text) of every page."""
    host, _ = split_url(F.col("url"))

    @F.pandas_udf("array<struct<node:bigint,shown:tinyint,text:string>>")
    def blocks(html: pd.Series) -> pd.Series:
        return pd.Series(
            [
                [{"node": n, "shown": s, "text": t} for n, s, t in dom_blocks(h or "")]
                for h in html
            ],
            dtype=object,
        )

    rows = pages.select("page_id", "url", host.alias("host"), blocks(F.col("html")).alias("blocks"))
    unmarked = F.filter("blocks", lambda b: b["shown"] != MARKED)
    return rows.withColumn("copy", F.xxhash64(F.when(F.size(unmarked) > 0, unmarked).otherwise(F.col("blocks"))))


def importance(shown: Column, entropy: Column, w: Weights) -> Column:
    """Importance of a node or text from how it is presented and how much its content varies over the host."""
    feature = F.when(shown == MAIN, w.main).otherwise(w.neutral)
    return F.when(shown == MARKED, w.marked).otherwise(w.presentation * feature + (1 - w.presentation) * (1 - entropy))


def style_tree(rows: DataFrame, w: Weights = Weights()) -> tuple[DataFrame, DataFrame]:
    """Importance of each text node of each host (host, node, shown, pages, importance) and of each text of a node
    (host, node, key, importance), keys of texts being their hashes.

    A text found on c of the m pages that have the node has the entropy log c / log max(m, ``w.pages``); that of a node is
    the mean over the texts on its pages. Copies of a page count once. Counting is by (host, node, text) first, so a hot host is
    spread over its texts.
    """
    seen = F.transform("blocks", lambda b: F.struct(b["node"].alias("node"), b["shown"].alias("shown"), F.xxhash64(b["text"]).alias("key")))
    pages = F.transform("blocks", lambda b: F.struct(b["node"].alias("node"), b["shown"].alias("shown"), F.lit(None).cast("long").alias("key")))
    leaves = rows.select("host", "copy", F.explode(F.array_distinct(F.concat(seen, pages))).alias("b"))
    leaves = leaves.select("host", "copy", "b.*").distinct()  # without a key: the page has the node
    texts = written(leaves.groupBy("host", "node", "shown", "key").agg(F.count("*").alias("c")), "style-counts")
    of_text = F.col("key").isNotNull()
    nodes = texts.groupBy("host", "node", "shown").agg(
        F.max(F.when(~of_text, F.col("c"))).alias("pages"),
        F.sum(F.when(of_text, F.col("c"))).alias("n"),
        F.sum(F.when(of_text, F.col("c") * F.log("c"))).alias("spread"),
    )
    m = F.log(F.greatest("pages", F.lit(w.pages)).cast("double"))
    nodes = nodes.withColumn("importance", importance(F.col("shown"), F.col("spread") / F.col("n") / m, w))
    # only a text on several pages can fall below its node
    often = texts.where(of_text & (F.col("c") > 1)).join(nodes.select("host", "node", "shown", "pages"), ["host", "node", "shown"])
    often = often.withColumn("importance", importance(F.col("shown"), F.log("c") / m, w))
    return nodes.drop("n", "spread"), often.select("host", "node", "shown", "key", "importance")


def extracted(pages: DataFrame, w: Weights = Weights()) -> DataFrame:
    """Main text of each row of ``pages`` (page_id, url, html): page_id, url, text, n_chars.

    Marked branches (menus, forms, comments and the like) are out on hosts of any size; of the rest stays what the style
    tree of the host finds important. Nulls: a null html is empty and gives the empty text; a null url belongs to the host
    without name. Very long pages are parsed whole. Repeated rows stay repeated and count as one page in the tree. An empty table gives an empty table. Other columns are not
    carried.
    """
    rows = written(parsed(pages), "dom")
    nodes, texts = style_tree(rows, w)
    # marked branches go by themselves; the lists hold what content decided
    unfit = (F.col("importance") < w.least) & (F.col("shown") != MARKED)
    low = nodes.where(unfit).select("host", F.xxhash64("node", "shown").alias("id"))
    low = low.union(texts.where(unfit).select("host", F.xxhash64("node", "shown", "key"))).groupBy("host").agg(F.collect_set("id").alias("low"))
    joined = rows.join(written(low, "style-tree"), "host", "left")  # written, so that its size is known

    def stays(b: Column) -> Column:
        ids = F.xxhash64(b["node"], b["shown"]), F.xxhash64(b["node"], b["shown"], F.xxhash64(b["text"]))
        repeated = F.coalesce(F.array_contains("low", ids[0]) | F.array_contains("low", ids[1]), F.lit(False))
        return (b["shown"] != MARKED) & ~repeated

    text = F.array_join(F.transform(F.filter("blocks", stays), lambda b: b["text"]), "\n")
    out = joined.select("page_id", "url", text.alias("text"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
