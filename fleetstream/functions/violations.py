"""Violation predicates over an event type."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from fleetstream.schemas import KNOWN_VIOLATIONS, NORMAL


def violation_flag(event_type: Column | str = "event_type") -> Column:
    """0 for exactly ``Normal``, else 1. Unknown types and nulls are violations."""
    col = F.col(event_type) if isinstance(event_type, str) else event_type
    return F.when(col == NORMAL, F.lit(0)).otherwise(F.lit(1))


def is_known_violation(event_type: Column | str = "event_type") -> Column:
    """Member of the vocabulary's non-normal types; unknown types are not."""
    col = F.col(event_type) if isinstance(event_type, str) else event_type
    return col.isin(*KNOWN_VIOLATIONS)
