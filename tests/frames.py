"""What the test modules share: the small table folder and row comparison (a module of its own, as two conftests exist)."""

SF_SMALL = "/root/testdata/sf0.001"


def rows(df, *cols):
    """Sorted list of tuples for order-insensitive comparison."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
