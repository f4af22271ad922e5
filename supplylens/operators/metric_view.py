"""Named measures over a source, queried by any declared dimensions."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class MetricView:
    """A governed set of measures.

    ``dimensions`` and ``measures`` map public names to Column expressions, and
    ``synonyms`` maps a measure or dimension name to the phrases people use for it. Where measures are distinct
    counts, ``bucket`` and ``partials`` aggregate the source by dimensions and bucket first, and the measures are
    declared over the partials.
    """

    name: str
    source: DataFrame
    dimensions: dict[str, Column]
    measures: dict[str, Column]
    synonyms: dict[str, list[str]] = field(default_factory=dict)
    bucket: Column | None = None
    partials: dict[str, Column] = field(default_factory=dict)

    def query(self, dims: list[str] | None = None, measures: list[str] | None = None) -> DataFrame:
        """Measures by dimensions; no dimension gives one overall row."""
        dims = dims or []
        chosen = measures or list(self.measures)
        unknown = [n for n in dims if n not in self.dimensions] + [n for n in chosen if n not in self.measures]
        if unknown:
            raise KeyError(f"{self.name} declares no {', '.join(unknown)}")
        keys = [self.dimensions[d].alias(d) for d in dims]
        rows, by = self.source, keys
        if self.partials:
            first = rows.groupBy(*keys, self.bucket.alias("_bucket"))
            rows, by = first.agg(*[p.alias(n) for n, p in self.partials.items()]), dims
        return rows.groupBy(*by).agg(*[self.measures[m].alias(m) for m in chosen])

    def terms(self) -> list[tuple[str, str, str]]:
        """(phrase, view, field) for every declared name and synonym."""
        named = [(n.replace("_", " "), self.name, n) for n in [*self.dimensions, *self.measures]]
        spoken = [(phrase.lower(), self.name, n) for n, phrases in self.synonyms.items() for phrase in phrases]
        return named + spoken


def match_terms(df: DataFrame, text: str, terms: list[tuple[str, ...]], names: list[str]) -> DataFrame:
    """One row per term whose phrase occurs in the text (case ignored).

    ``terms`` is the declared dictionary, a list fixed by the views and not by the
    data, so it travels inside the plan: the texts are scanned once, nothing is
    joined or shuffled. One pattern finds the longest phrase at every position of
    the text; the phrases inside a found one are listed with it, so none is missed.
    """
    entries: dict[str, list[tuple[str, ...]]] = {}
    phrases = {term[0].lower() for term in terms}
    for phrase in phrases:
        entries[phrase] = [term for term in terms if term[0].lower() in phrase]
    inside = F.create_map(
        *[
            part
            for phrase, held in sorted(entries.items())
            for part in (
                F.lit(phrase),
                F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, term)]) for term in held]),
            )
        ]
    )
    hits = F.array_distinct(F.regexp_extract_all(F.lower(F.col(text)), F.lit(phrase_pattern(phrases)), F.lit(1)))
    held = F.array_distinct(F.flatten(F.transform(hits, lambda hit: F.element_at(inside, hit))))
    return df.select(*df.columns, F.explode(held).alias("_term")).select(*df.columns, "_term.*")


def phrase_pattern(phrases: set[str]) -> str:
    """Zero-width pattern capturing the longest phrase at a position, branched on the first letter."""
    by_letter: dict[str, list[str]] = {}
    for phrase in sorted(phrases, key=lambda p: (-len(p), p)):
        by_letter.setdefault(phrase[0], []).append(re.escape(phrase[1:]))
    branches = [re.escape(letter) + "(?:" + "|".join(rest) + ")" for letter, rest in sorted(by_letter.items())]
    return "(?=(" + "|".join(branches) + "))"
