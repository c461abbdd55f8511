"""The offer chain over the driver tables: offer view -> staged offers -> deduplicated -> comparison."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from offerlake import rules
from offerlake.operators.compare import best_prices
from offerlake.operators.dedup import keep_most_complete
from offerlake.operators.normalize import normalize_columns, standardize
from offerlake.operators.staging import (add_canonical_key, add_price, convert_currencies, drop_unpriced,
                                         relevance_filter, standardize_dates)
from offerlake.sources.offers import offers_from_tables, offers_with_copies
from offerlake.sources.tables import Tables

# Processing date used by registered queries so results are reproducible (invalid dates take this value).
RUN_DATE = "2026-06-30"


def offer_view(t: Tables) -> DataFrame:
    return offers_from_tables(t.lineitem, t.part, t.supplier, t.nation)


def offer_view_with_copies(t: Tables) -> DataFrame:
    return offers_with_copies(offer_view(t))


def standardized(offers: DataFrame, run_date: str = RUN_DATE) -> DataFrame:
    """Steps 2-4: homologated columns, standard dates, standard text."""
    return standardize(standardize_dates(normalize_columns(offers), run_date))


def priced(offers: DataFrame, run_date: str = RUN_DATE) -> DataFrame:
    """Steps 2-6: relevant rows with ``precio_usd`` (null where no positive amount is found)."""
    return add_price(relevance_filter(standardized(offers, run_date)))


def keyed(offers: DataFrame, run_date: str = RUN_DATE) -> DataFrame:
    """Steps 2-9: priced rows with the canonical key."""
    return add_canonical_key(drop_unpriced(priced(offers, run_date)))


def staged_before_dedup(offers: DataFrame, rates: Mapping[str, float] = rules.FALLBACK_RATES,
                        run_date: str = RUN_DATE) -> DataFrame:
    """Steps 2-10: priced rows with canonical key and converted prices."""
    return convert_currencies(keyed(offers, run_date), rates)


def staged(offers: DataFrame, rates: Mapping[str, float] = rules.FALLBACK_RATES, run_date: str = RUN_DATE) -> DataFrame:
    """The staged offer table: steps 2-11 (dedup last), with the currency fan-out applied after dedup.

    The converted prices and the rates text are functions of ``precio_usd`` (a dedup key) and run constants, so they
    never change which row survives (same completeness offset and tie order for every row of a key); converting
    after dedup keeps them out of the shuffled survivor struct. Output equals dedup-after-conversion.
    """
    return convert_currencies(keep_most_complete(keyed(offers, run_date)), rates)


def comparison(t: Tables) -> DataFrame:
    """Flagship: cheapest store per product over the deduplicated staged offers."""
    return best_prices(staged(offer_view(t)))

