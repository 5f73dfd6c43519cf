"""Masking of card numbers as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_token(value: Column) -> Column:
    """Five dot-separated parts, trailing empty parts not counted."""
    parts = F.split(F.regexp_replace(value, "[.]+$", ""), "[.]")
    return (F.instr(value, ".") > 0) & (F.size(parts) == 5)


def mask(value: Column, prefix: int = 6, suffix: int = 4, character: str = "*") -> Column:
    """Keep the first ``prefix`` and last ``suffix`` characters; tokens become a fixed placeholder."""
    length = F.length(value)
    hidden = F.repeat(F.lit(character), length - F.lit(prefix + suffix))
    tail = F.substring(value, length - F.lit(suffix - 1), F.lit(suffix)) if suffix else F.lit("")
    return (
        F.when(is_token(value), F.lit("******" + character * 6 + "****"))
        .when(length <= prefix + suffix, value)
        .otherwise(F.concat(F.substring(value, 1, prefix), hidden, tail))
    )


def tokenize(clear: Column, prefix: int = 6, suffix: int = 4, character: str = "*") -> Column:
    """Stand-in for a decrypted number."""
    return F.concat(F.lit("TOK-"), mask(clear, prefix, suffix, character))
