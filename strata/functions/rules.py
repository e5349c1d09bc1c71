"""Row-level validation rules compiled into one error-text column.

A :class:`Rule` pairs a failure predicate with a message. Compiling a rule
list gives a single ``concat`` of ``CASE WHEN`` pieces, in list order, so every
failed rule of a row is reported, not just the first one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    name: str
    message: str
    failed: Callable[[], Column]

    def piece(self) -> Column:
        return F.when(self.failed(), F.lit(self.message)).otherwise(F.lit(""))


def null_or_empty(col: str) -> Callable[[], Column]:
    return lambda: F.col(col).isNull() | (F.col(col) == F.lit(""))


def null_or_outside(col: str, low: float | None = None, high: float | None = None,
                    low_inclusive: bool = True) -> Callable[[], Column]:
    """NULL, below ``low`` (or at it when not inclusive) or above ``high`` fails."""

    def predicate() -> Column:
        c = F.col(col)
        out = c.isNull()
        if low is not None:
            out = out | ((c < F.lit(low)) if low_inclusive else (c <= F.lit(low)))
        if high is not None:
            out = out | (c > F.lit(high))
        return out

    return predicate


# The six rules of the source pipeline and their exact
# messages, in reporting order. Each message ends with "; ".
PRODUCT_RULES: tuple[Rule, ...] = (
    Rule("name_present", "name is null/empty; ", null_or_empty("name")),
    Rule("main_category_present", "main_category is null/empty; ", null_or_empty("main_category")),
    Rule("ratings_range", "ratings out of range [0-5]; ", null_or_outside("ratings", 0, 5)),
    Rule("no_of_ratings_non_negative", "no_of_ratings < 0; ", null_or_outside("no_of_ratings", 0)),
    Rule("discount_price_non_negative", "discount_price < 0; ", null_or_outside("discount_price", 0)),
    Rule("actual_price_positive", "actual_price <= 0; ",
         null_or_outside("actual_price", 0, low_inclusive=False)),
)

MESSAGE_SEPARATOR = "; "
# What is wrong with a row whose source line could not be taken apart (ours).
MALFORMED_LINE = "malformed line; "


def error_text(rules: Sequence[Rule]) -> Column:
    """Concatenated messages of every failed rule; ``""`` when none failed."""
    if not rules:
        return F.lit("")
    return F.concat(*[r.piece() for r in rules])


def rule_messages(rules: Sequence[Rule]) -> list[str]:
    return [r.message[: -len(MESSAGE_SEPARATOR)] if r.message.endswith(MESSAGE_SEPARATOR)
            else r.message for r in rules]
