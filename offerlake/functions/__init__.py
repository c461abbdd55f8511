"""Column expressions: every function returns a ``Column`` built from JVM-side built-ins (whole-stage codegen)."""

from offerlake.functions.regex import java_regex
from offerlake.functions.text import collapse_ws, clean_log_text
from offerlake.functions.price import amount_tokens, parse_amount, parse_price, rint_round
from offerlake.functions.keys import canonical_key, strip_brackets
from offerlake.functions.dates import standardize_date, parse_any_timestamp
from offerlake.functions.fx import convert, rates_map, rates_json

__all__ = [
    "java_regex", "collapse_ws", "clean_log_text",
    "amount_tokens", "parse_amount", "parse_price", "rint_round",
    "canonical_key", "strip_brackets", "standardize_date", "parse_any_timestamp",
    "convert", "rates_map", "rates_json",
]
