"""Locale-aware price parsing, entirely as JVM expressions.

An offer's price text may hold several amounts (old price, current price, taxes). Each amount token is read with
the first matching number format of ``rules.AMOUNT_FORMATS``; the offer price is the smallest positive amount,
rounded half-to-even to two decimals. Higher-order ``transform``/``filter`` keep the work in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from offerlake import rules


def rint_round(c: Column, digits: int) -> Column:
    """Round half-to-even at ``digits`` decimals the way numpy's ``round`` does (scale, ``rint``, unscale).

    Spark's ``round`` is half-up and ``bround`` works on the decimal expansion; neither matches numpy.
    """
    scale = float(10 ** digits)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def exact_round2(c: Column) -> Column:
    """Round to two decimals by the exact binary value, half to even, as Python's ``round`` does.

    ``c * 100`` is rounded itself, so it can fall on a half that the exact product misses. The product's error follows
    exactly from the two halves of ``c`` (26 bits each, by splitting with 2^27 + 1); it decides only where the rounded
    product is a half.
    """
    product = c * F.lit(100.0)
    big = c * F.lit(134217729.0)
    high = big - (big - c)
    error = (high * F.lit(100.0) - product) + (c - high) * F.lit(100.0)
    below = F.floor(product).cast("double")
    half = (product - below) == F.lit(0.5)
    cents = F.when(half & (error > 0), below + 1).when(half & (error < 0), below).otherwise(F.rint(product))
    return cents / F.lit(100.0)


def amount_tokens(c: Column) -> Column:
    """All amount-like tokens in a text: a digit, optionally followed by digits/dots/commas ending in a digit."""
    return F.regexp_extract_all(c, F.lit(rules.AMOUNT_TOKEN_PATTERN), 0)


def _normalize_token(t: Column) -> Column:
    # Character-level rewrites with translate (no regex): "eu" maps ',' to '.' and deletes '.', in one pass.
    no_commas = F.translate(t, ",", "")
    actions = {
        "eu": F.translate(t, ",.", "."),
        "drop_commas": no_commas,
        "comma_decimal": F.translate(t, ",", "."),
    }
    def chain(formats):
        expr = None
        for pattern, action in formats:
            cond = t.rlike("^(?:" + pattern + ")$")
            expr = F.when(cond, actions[action]) if expr is None else expr.when(cond, actions[action])
        return no_commas if expr is None else expr.otherwise(no_commas)

    # a format with a mark that a token lacks cannot match it: such formats are not tried
    dots, commas = ([(p, a) for p, a in rules.AMOUNT_FORMATS if _needs(p, mark)] for mark in ".,")
    plain = [f for f in rules.AMOUNT_FORMATS if f not in dots and f not in commas]
    no_dots = [f for f in rules.AMOUNT_FORMATS if f not in dots]
    without_commas = chain(plain + [f for f in dots if f not in commas]) if plain or any(f not in commas for f in dots) else t
    return (F.when(~t.contains(","), without_commas).when(~t.contains("."), chain(no_dots)).otherwise(chain(rules.AMOUNT_FORMATS)))


def _needs(pattern: str, mark: str) -> bool:
    """Whether a text without ``mark`` surely cannot match a format: the mark stands in it, and no part of it is optional."""
    return not any(c in pattern for c in "|[?*") and "{0" not in pattern and ("\\." if mark == "." else mark) in pattern


def parse_amount(t: Column) -> Column:
    """One token to a double; unparseable text (``1.299.999``) gives null."""
    return _normalize_token(t).try_cast("double")


def parse_price(raw: Column, digits: int = 2, floor: float | None = None) -> Column:
    """Offer price: smallest positive amount in ``raw``, rounded; null when there is none.

    ``floor`` (off by default) ignores amounts below a plausibility floor, e.g. instalment counts or a tax rate
    written next to the price; without it any small number in the text wins, as in the reference.
    """
    values = F.transform(amount_tokens(raw), parse_amount)
    if floor is None:
        positive = F.filter(values, lambda v: v > 0)
    else:
        positive = F.filter(values, lambda v: (v > 0) & (v >= F.lit(float(floor))))
    least = F.array_min(positive)
    if digits != 2:
        return rint_round(least, digits)
    # through a one-element array, so the tokens are parsed once
    return F.get(F.transform(F.array(least), exact_round2), F.lit(0))
