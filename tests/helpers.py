"""Shared by the tests."""

from __future__ import annotations


def rows(df, *cols):
    """Collected rows as sorted tuples (of the given columns, or all)."""
    cols = cols or tuple(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.select(*[f"`{c}`" for c in cols]).collect()]
    return sorted(out, key=lambda t: tuple((v is not None, v) for v in t))
