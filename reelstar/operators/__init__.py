"""Relational operators and the five table builders (``dims``, ``facts``)."""

from reelstar.operators.dedupe import key_violations, latest_per_key
from reelstar.operators.joins import bounded_broadcast, lookup_join
from reelstar.operators.spine import date_spine, date_spine_between

__all__ = ["latest_per_key", "key_violations", "bounded_broadcast", "lookup_join",
           "date_spine", "date_spine_between"]
