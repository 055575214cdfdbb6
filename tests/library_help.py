"""Helpers shared by the library's tests."""

SF_SMALL = "/root/testdata/sf0.001"


def rows(df, *cols):
    """Collect selected columns as a list of tuples, sorted for stable asserts."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))
