"""Sources: driver tables, raw landing files, exchange-rate documents, survey and spec files."""

from offerlake.sources.tables import Tables, read_table

__all__ = ["Tables", "read_table"]
