"""offerlake: Spark-native price analytics over store offers.

Raw offers, exchange rates, specifications and survey answers land as tables; the staging chain cleans them with native
column expressions, quality controls measure every step, and the comparison answers which store sells each product
cheapest. Every operator is a function ``DataFrame -> DataFrame`` that builds a lazy plan; nothing collects rows.
"""

__version__ = "0.1.0"
