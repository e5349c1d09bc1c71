"""Column-level building blocks (pure ``Column`` expressions, no actions)."""

from strata.functions.buckets import PRICE_BUCKETS, Bucket, bucketize
from strata.functions.cleaning import (
    CURRENCY_SYMBOLS,
    THOUSANDS_SEPARATOR,
    clean_label,
    clean_text,
    strip_chars,
    to_double,
    to_price,
)
from strata.functions.names import quoted, unused_names
from strata.functions.rules import (
    MALFORMED_LINE,
    MESSAGE_SEPARATOR,
    PRODUCT_RULES,
    Rule,
    error_text,
    null_or_empty,
    null_or_outside,
    rule_messages,
)

__all__ = [
    "Bucket",
    "CURRENCY_SYMBOLS",
    "MALFORMED_LINE",
    "MESSAGE_SEPARATOR",
    "PRICE_BUCKETS",
    "PRODUCT_RULES",
    "Rule",
    "THOUSANDS_SEPARATOR",
    "bucketize",
    "clean_label",
    "clean_text",
    "error_text",
    "null_or_empty",
    "null_or_outside",
    "quoted",
    "rule_messages",
    "strip_chars",
    "to_double",
    "to_price",
    "unused_names",
]
