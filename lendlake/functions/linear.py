"""Weighted sums of columns: one description serves scores, probabilities and attributions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import clip, literal, sigmoid


@dataclass(frozen=True)
class Term:
    """``weight * (column - center)``; ``column`` may be any SQL expression text."""

    column: str
    weight: float
    center: float = 0.0

    def sql(self) -> str:
        x = f"({self.column} - {literal(float(self.center))})" if self.center else self.column
        return f"{x} * {literal(float(self.weight))}"


@dataclass(frozen=True)
class LinearIndex:
    """``intercept + sum(terms)``, optionally limited to [low, high]."""

    terms: Sequence[Term]
    intercept: float | None = None
    low: float | None = None
    high: float | None = None

    def raw_sql(self) -> str:
        start = [] if self.intercept is None else [literal(float(self.intercept))]
        return " + ".join([*start, *[t.sql() for t in self.terms]])

    def score_sql(self) -> str:
        if self.low is None and self.high is None:
            return self.raw_sql()
        return clip.sql(self.raw_sql(), self.low, self.high)

    def probability_sql(self) -> str:
        return sigmoid.sql(self.raw_sql())

    def contributions(self, background: Mapping[str, float], names: Mapping[str, str]) -> Column:
        """Array of (size, name, value): each term's part relative to its background mean."""
        parts = []
        for t in self.terms:
            value = f"{literal(float(t.weight))} * ({t.column} - {literal(float(background[t.column]))})"
            name = literal(names.get(t.column, t.column))
            parts.append(f"named_struct('size', abs({value}), 'name', {name}, 'value', {value})")
        return F.expr(f"array({', '.join(parts)})")


def weighted(weights: Mapping[str, float], **kw) -> LinearIndex:
    """Index from a plain name-to-weight table."""
    return LinearIndex([Term(c, w) for c, w in weights.items()], **kw)
