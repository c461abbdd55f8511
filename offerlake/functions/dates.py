"""Date standardisation and calendar attributes."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from offerlake import rules


def parse_any_timestamp(c: Column, formats: Sequence[str] = rules.DATE_FORMATS) -> Column:
    """First format that parses wins; unparseable or null text gives null (no exception, ANSI-safe)."""
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(fmt)) for fmt in formats])


#: Fields of a date format that stand for a fixed shape.
SHAPES = {"yyyy": r"(?!0000)[0-9]{4}", "MM": "[0-9]{2}", "dd": "[0-9]{2}", "HH": "(?:[01][0-9]|2[0-3])", "mm": "[0-5][0-9]", "ss": "[0-5][0-9]"}
_FIELD = re.compile("'([^']*)'|(yyyy|MM|dd|HH|mm|ss)|([^A-Za-z'])")


def _shape(fmt: str) -> str | None:
    """Regular expression of a format that begins with year, month and day, two digits each; None for any other one."""
    out, at = "", 0
    while at < len(fmt):
        m = _FIELD.match(fmt, at)
        if m is None:
            return None
        out += SHAPES[m[2]] if m[2] else re.escape(m[1] if m[1] is not None else m[3])
        at = m.end()
    return out if re.match("yyyy[^A-Za-z']MM[^A-Za-z']dd", fmt) else None


def parse_any_date(c: Column, formats: Sequence[str] = rules.DATE_FORMATS) -> Column:
    """The date of ``parse_any_timestamp``: the shape of the text is tested once for all formats, and the day is read from its places;
    formats without such a shape are parsed one after the other."""
    shapes = [_shape(f) for f in formats]
    if None in shapes:
        return F.to_date(parse_any_timestamp(c, formats))
    day = F.concat_ws("-", F.substring(c, 1, 4), F.substring(c, 6, 2), F.substring(c, 9, 2)).try_cast("date")
    return F.when(c.rlike("^(?:" + "|".join(shapes) + r")\z"), day)


def standardize_date(c: Column, run_date: Column, formats: Sequence[str] = rules.DATE_FORMATS) -> Column:
    """``YYYY-MM-DD`` date of ``c``; invalid or null values take the processing date ``run_date``."""
    return F.coalesce(parse_any_date(c, formats), run_date)


def calendar_columns(d: Column) -> dict[str, Column]:
    """ISO week, month, quarter, year and English day name of a date."""
    return {
        "semana_iso": F.weekofyear(d),
        "mes": F.month(d),
        "trimestre": F.quarter(d),
        "anio": F.year(d),
        "nombre_dia": F.date_format(d, "EEEE"),
    }
