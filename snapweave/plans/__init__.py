"""Driver-side planning: schema reconciliation."""

from .schema import SchemaConflict, can_widen, conform, conform_columns, reconcile, widen

__all__ = ["SchemaConflict", "can_widen", "conform", "conform_columns", "reconcile", "widen"]
