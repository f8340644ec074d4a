"""Column-level helpers shared by every operator (all JVM-side expressions)."""

from lapse.functions.columns import bound, present, str_class
from lapse.functions.numeric import exact_mean, exact_sum, half_even, pct
from lapse.functions.ordering import domain, reindex

__all__ = [
    "bound", "present", "str_class",
    "exact_mean", "exact_sum", "half_even", "pct",
    "domain", "reindex",
]
