"""Table sources: canonical loader and the P2P tables derived from the driver data."""

from procura.sources.derived import derived_tables, oracle_ctes
from procura.sources.tables import SCHEMAS, TABLES, conform_table, load_tables

__all__ = ["SCHEMAS", "TABLES", "conform_table", "derived_tables", "load_tables", "oracle_ctes"]
