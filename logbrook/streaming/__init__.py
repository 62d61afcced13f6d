"""Continuous forms of the pipelines, on Structured Streaming."""

from logbrook.streaming.by_batch import batch_results, start_alerts, start_occupancy_changelog
from logbrook.streaming.pipelines import (
    TO_END,
    copy_lines,
    forget_changes,
    latest_changes,
    running_alerts,
    running_alerts_aligned,
    running_occupancy,
    running_occupancy_changelog,
    running_sequence_check,
    running_word_counts,
    sequence_faults_so_far,
    start_broker,
    start_changes,
    start_topic,
)

__all__ = [
    "TO_END",
    "batch_results",
    "copy_lines",
    "forget_changes",
    "latest_changes",
    "running_alerts",
    "running_alerts_aligned",
    "running_occupancy",
    "running_occupancy_changelog",
    "running_sequence_check",
    "running_word_counts",
    "sequence_faults_so_far",
    "start_alerts",
    "start_broker",
    "start_changes",
    "start_occupancy_changelog",
    "start_topic",
]
