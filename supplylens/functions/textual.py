"""Text expressions: numbers, labels, tables, sections and code blocks.

All of them are row-local Column expressions over the whole text, so a scan of
the texts is the only work and nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and status words.
NUMBER = r"-?[\d,]+\.?\d*"
FENCED_SQL = r"(?s)```sql\s*\n(.*?)\n\s*```"
BARE_SQL = r"(?i)(SELECT\s+[\s\S]{10,}?FROM\s+\S+[\s\S]*?)(?:\n\n|\z)"
PIPE_TABLE = r"(\|[^\n]+\|\n\|[\s\-:|]+\|\n(?:\|[^\n]+\|\n?)+)"
SECTION_BREAK = r"\n(?=(?:#{1,3}\s|\d+\.\s*\*\*))"
SECTION_HEAD = r"^(?:#{1,3}\s*|\d+\.\s*\*\*)(.*?)(?:\*\*)?$"
SAID_EXACT = r"(\d+)\s+(?:of|out of)\s+(?:the\s+)?(\d+)\b.*?EXACT"
SAID_COUNT = r"(\d+)\s+(?:(?:metrics?\s+)?(?:were|as)\s+)?"
SAID_NONE = r"\bno\s+"
LISTED_EXACT = r":\s*EXACT\b"
LISTED_MISSING = r":\s*NOT_FOUND\b"
DATE_LITERAL = r"20\d{2}-\d{2}-\d{2}"
STATUS_WORDS = {"exact": "EXACT", "close": "CLOSE", "miss": "MISS"}
METRIC_LABELS = {
    "revenue_aug": r"(?:August|Aug).*?(?:revenue|total)[:\s]*\$?([\d,]+\.?\d*)",
    "revenue_jul": r"(?:July|Jul).*?(?:revenue|total)[:\s]*\$?([\d,]+\.?\d*)",
    "revenue_change_pct": r"(?:change|decline|drop|decrease)[:\s]*[\-−]?([\d.]+)\s*%",
    "revenue_change_dollars": r"(?:change|decline|drop|decrease)[:\s]*\$?([\d,]+\.?\d*)",
    "otd_rate": r"on[- ]time\s*(?:delivery)?\s*rate[:\s]*([\d.]+)\s*%",
    "late_delivery_rate": r"late\s*delivery\s*rate[:\s]*([\d.]+)\s*%",
    "avg_delay_days": r"(?:average|avg)\s*delay[:\s]*([\d.]+)\s*day",
    "total_shipments": r"total\s*shipments[:\s]*([\d,]+)",
    "late_shipments": r"late\s*shipments[:\s]*([\d,]+)",
    "wasted_freight": r"wasted\s*freight[:\s]*\$?([\d,]+\.?\d*)",
    "positions_below_ss": r"positions?\s*below\s*safety\s*stock[:\s]*([\d,]+)",
    "stockout_skus": r"(?:unique\s*)?SKUs?\s*(?:in\s*)?stockout[:\s]*([\d,]+)",
    "days_of_supply": r"(?:avg|average)\s*days?\s*of\s*supply[:\s]*([\d.]+)",
    "total_pos": r"total\s*(?:purchase\s*)?(?:POs?|orders)[:\s]*([\d,]+)",
    "late_pos": r"late\s*(?:purchase\s*)?(?:POs?|orders)[:\s]*([\d,]+)",
    "po_late_pct": r"(?:PO|supplier|order|vendor).*?late.*?([\d.]+)\s*%",
    "asia_late_rate": r"Asia[^.]*late.*?([\d.]+)\s*%",
    "fill_rate": r"fill\s*rate[:\s]*([\d.]+)\s*%",
    "sla_penalties": r"SLA\s*penalt(?:y|ies)[:\s]*\$?([\d,]+\.?\d*)",
    "cost_of_disruption": r"[Cc]ost\s*of\s*[Dd]isruption[:\s]*\$?([\d,]+\.?\d*)",
    "q3_target": r"Q3\s*(?:service.level\s*)?target[:\s]*([\d.]+)\s*%",
}


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body reads it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def to_number(token: Column) -> Column:
    """Token to double, thousands commas removed; null when it is not a number."""
    return F.replace(token, F.lit(","), F.lit("")).try_cast("double")


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def numbers(text: Column) -> Column:
    """Every number of the text in order, bad tokens dropped."""
    tokens = F.regexp_extract_all(text, F.lit(NUMBER), F.lit(0))
    return F.filter(F.transform(tokens, to_number), lambda n: n.isNotNull())


def labelled_value(text: Column, label: str) -> Column:
    """First number behind the label, case ignored; null without one."""
    return to_number(F.nullif(F.regexp_extract(text, "(?i)" + METRIC_LABELS[label], 1), F.lit("")))


def sql_blocks(text: Column) -> Column:
    """Every fenced SQL block, or else every bare statement."""
    bare = F.transform(F.regexp_extract_all(text, F.lit(BARE_SQL), F.lit(1)), stripped)
    fenced = F.regexp_extract_all(text, F.lit(FENCED_SQL), F.lit(1))
    return let(fenced, lambda found: F.when(F.size(found) > 0, found).otherwise(bare))


def without_edge_pipes(line: Column) -> Column:
    return F.regexp_replace(stripped(line), r"^\|+|\|+$", "")


def header_columns(text: Column) -> Column:
    """Column names of a pipe-delimited first line."""
    cells = F.split(without_edge_pipes(F.split(text, "\n")[0]), r"\|")
    return F.filter(F.transform(cells, stripped), lambda c: c != "")


def table_rows(table: Column) -> Column:
    """Rows of one markdown table as arrays of cells; separator rows left out."""
    lines = F.filter(F.split(table, "\n"), lambda line: stripped(line) != "")
    rows = F.transform(lines, lambda line: F.transform(F.split(without_edge_pipes(line), r"\|"), stripped))
    rule = lambda row: F.forall(F.filter(row, lambda c: c != ""), lambda c: c.rlike("^[-:]+$"))
    return F.filter(rows, lambda row: ~rule(row))


def section_title(section: Column, position: Column) -> Column:
    head = F.split(section, "\n")[0]
    named = stripped(F.regexp_extract(head, SECTION_HEAD, 1))
    return F.when(head.rlike(SECTION_HEAD), named).otherwise(F.concat(F.lit("section_"), position.cast("string")))


def last_sections(text: Column) -> Column:
    """Array of (title, pos, body), one per title, the last body of a repeated title.

    Sorting the entries puts equal titles side by side, so the text never leaves its row.
    """
    entries = F.transform(
        F.split(text, SECTION_BREAK),
        lambda part, i: F.struct(
            section_title(part, i).alias("title"), i.alias("pos"), stripped(part).alias("body")
        ),
    )
    following = lambda s, i: F.try_element_at(s, i + 2)["title"]
    return let(
        F.array_sort(entries),
        lambda s: F.filter(s, lambda e, i: F.coalesce(following(s, i) != e["title"], F.lit(True))),
    )


def requoted(sql: Column, regions: list[str], date_pattern: str = DATE_LITERAL) -> Column:
    """Quotes put back around region names and date literals."""
    names = "|".join(regions)
    quoted = F.regexp_replace(sql, rf"=\s*({names})\b", "= '$1'")
    return F.regexp_replace(quoted, rf"DATE\s+({date_pattern})", "DATE '$1'")


def narrated_counts(narration: Column, total: Column) -> dict[str, Column]:
    """Counts of EXACT, CLOSE, MISS and NOT_FOUND read out of a sentence.

    A stated count above the total is ignored and "no X" means zero. With only an
    exact count the rest was not found; with no counts at all, per-metric verdict
    lines are counted, and failing those everything was not found.
    """
    clean = F.replace(narration, F.lit("**"), F.lit(""))
    first = lambda pattern: F.regexp_extract(clean, pattern, 1).try_cast("bigint")
    zero = F.lit(0).cast("bigint")

    def bounded(word: str, absent: str) -> Column:
        count = first(SAID_COUNT + word)
        value = F.coalesce(F.when(count <= total, count), zero)
        return F.when(clean.rlike(SAID_NONE + absent), zero).otherwise(value)

    exact = F.coalesce(first(SAID_EXACT), zero)
    close, miss = bounded("CLOSE", "CLOSE"), bounded("MISS(?!_)", "MISS")
    missing = bounded("NOT_FOUND", "NOT_FOUND")
    missing = F.when((exact > 0) & (close + miss + missing == 0), F.greatest(zero, total - exact)).otherwise(missing)
    nothing = exact + close + miss + missing == 0
    listed_exact = F.regexp_count(clean, F.lit(LISTED_EXACT)).cast("bigint")
    listed_missing = F.regexp_count(clean, F.lit(LISTED_MISSING)).cast("bigint")
    unlisted = listed_exact + listed_missing == 0
    return {
        "exact": F.when(nothing, listed_exact).otherwise(exact),
        "close": close,
        "miss": miss,
        "not_found": F.when(nothing, F.when(unlisted, total).otherwise(listed_missing)).otherwise(missing),
    }


def best_block(blocks: Column, metric: Column, least: int = 2) -> Column:
    """The first block naming most of the metric's words longer than three letters."""
    words = F.filter(F.split(F.lower(metric), r"\s+"), lambda w: F.length(w) > 3)
    scored = F.transform(
        blocks,
        lambda block, i: F.struct(
            F.size(F.filter(words, lambda w: F.lower(block).contains(w))).alias("hits"),
            (-i).alias("earliness"),
            block.alias("block"),
        ),
    )
    best = F.array_max(scored)
    return F.when(best["hits"] >= least, best)
