"""Shared by the tests: the run timestamp, and small frames as sorted tuples."""

RUN_TS = "2024-06-01 00:00:00"


def rows(df, *cols):
    """Collect sorted tuples of the given columns (small test frames only)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()),
                  key=lambda t: tuple((x is None, str(x)) for x in t))
