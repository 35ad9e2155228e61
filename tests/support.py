"""Shared values and helpers of the test modules."""

SF001 = "/root/testdata/sf0.001"


def rows(df, *cols):
    """Collected rows as sorted tuples (optionally a column subset)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple((v is not None, v) for v in t))
