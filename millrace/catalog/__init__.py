"""Every query with its oracle, by name."""

from __future__ import annotations

from millrace.catalog import choices, rendering, rows, sources, vocabulary

CATALOG = {
    **sources.QUERIES,
    **rendering.QUERIES,
    **vocabulary.QUERIES,
    **rows.QUERIES,
    **choices.QUERIES,
}
