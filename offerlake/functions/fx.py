"""Currency conversion expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from offerlake.functions.price import rint_round


def rates_map(rates: Mapping[str, float]) -> Column:
    """Literal ``map<string,double>`` of currency -> rate (a handful of entries, compiled into the plan)."""
    items = []
    for k, v in rates.items():
        items += [F.lit(k), F.lit(float(v))]
    return F.create_map(*items)


def convert(usd: Column, rate: Column, digits: int = 2) -> Column:
    """``round(usd * rate, digits)`` half-to-even."""
    return rint_round(usd * rate, digits)


def rates_json(rates: Column) -> Column:
    """Rates used, as JSON text stored on each row for traceability."""
    return F.to_json(rates)
