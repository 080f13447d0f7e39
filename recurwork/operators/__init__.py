"""Reusable relational building blocks (dimension de-dup, skew-safe lag, top-N lists, paging)."""
