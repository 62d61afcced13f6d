"""Operators on logs and on the tables they describe."""

from logbrook.operators.grouping import latest_per_key, merge, regroup_changes, regrouped_counts
from logbrook.operators.running import PLACE, heavy_keys, running_state
from logbrook.operators.upkeep import log_differences, log_differences_by_range, retained, sequence_faults
from logbrook.operators.wording import rekeyed, word_counts, word_records

__all__ = [
    "PLACE",
    "heavy_keys",
    "latest_per_key",
    "log_differences",
    "log_differences_by_range",
    "merge",
    "regroup_changes",
    "regrouped_counts",
    "rekeyed",
    "retained",
    "running_state",
    "sequence_faults",
    "word_counts",
    "word_records",
]
