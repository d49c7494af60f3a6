"""Composite plans and plan helpers (size-checked broadcast, lineage cuts)."""
