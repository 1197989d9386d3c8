"""mercato: marketplace analytics as lazy Spark DataFrame operators.

Five analyses (seller scorecard, ABC product tiers, cohort retention,
delivery by state, monthly revenue), the data-quality checks that run
before them, and the report tables and file sinks that follow them.
Every operator takes a :class:`~mercato.sources.tables.Tables` mapping and
:class:`~mercato.params.Params` and returns a lazy ``DataFrame``.
"""

from mercato.params import Params
from mercato.sources.tables import Tables

__all__ = ["Params", "Tables"]
