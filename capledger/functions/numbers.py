"""Amounts, identifiers and ratios."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from capledger.functions.text import has_number, has_text, strip


def comparable_amount(amount: Column) -> Column:
    """Amounts that can be similar to another: finite and not zero; else null."""
    finite = (amount != 0) & ~F.isnan(amount) & (F.abs(amount) < float("inf"))
    return F.when(F.coalesce(finite, F.lit(False)), amount)


def amounts_are_similar(a: Column, b: Column, threshold: float) -> Column:
    """``(larger - smaller) / larger`` is at most ``threshold``.

    Zero and missing amounts match nothing. The ratio of two negative amounts is negative,
    so these always match.
    """
    a, b = comparable_amount(a), comparable_amount(b)
    larger, smaller = F.greatest(a, b), F.least(a, b)
    both = a.isNotNull() & b.isNotNull()
    return F.coalesce(both & (F.try_divide(F.abs(larger - smaller), larger) <= threshold), F.lit(False))


def completeness(amount: Column, pre_money: Column, post_money: Column, lead: Column) -> Column:
    """How many of the four optional facts are present (0..4)."""
    facts = [has_number(amount), has_number(pre_money), has_number(post_money), has_text(lead)]
    total = facts[0].cast("int")
    for fact in facts[1:]:
        total = total + fact.cast("int")
    return total


_DIGITS = r"\d(_?\d)*"
_NUMBER = (
    rf"(?i)^[+-]?(({_DIGITS}\.?({_DIGITS})?|\.{_DIGITS})(e[+-]?{_DIGITS})?|inf|infinity)\z|^nan\z"
)


def number_from_text(text: Column) -> Column:
    """A decimal number in text as double; null for anything else."""
    clean = strip(text)
    return F.when(clean.rlike(_NUMBER), F.replace(clean, F.lit("_"), F.lit("")).try_cast("double"))


def padded_cik(cik: Column) -> Column:
    """Left-pad with zeros to ten characters; longer values stay as they are."""
    text = cik.cast("string")
    return F.when(F.length(text) < 10, F.lpad(text, 10, "0")).otherwise(text)


def unpadded_cik(cik: Column) -> Column:
    return cik.try_cast("bigint")


def percent(part: Column, whole: Column) -> Column:
    """``part / whole`` in percent; 0 when there is no whole."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")) * 100, F.lit(0.0))


# Gigabytes moved per company, and the monthly level that raises a warning.
TRAFFIC_GB_PER_COMPANY = 0.00045
TRAFFIC_WARNING_GB = 9.5


def estimated_traffic_gb(companies: Column) -> Column:
    return companies * F.lit(TRAFFIC_GB_PER_COMPANY)
