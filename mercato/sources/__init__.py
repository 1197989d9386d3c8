"""Sources and sinks: table schemas, the ``Tables`` mapping, file writers."""

from mercato.sources.schema import SCHEMAS
from mercato.sources.tables import EXPECTED_TABLES, Tables

__all__ = ["EXPECTED_TABLES", "SCHEMAS", "Tables"]
