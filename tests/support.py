"""Helpers of the tests; a module of its own, since every folder may have its ``conftest``."""

SMALL = "/root/testdata/sf0.001"


def rows(df, *columns):
    """Sorted tuples of a DataFrame."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple(str(v) for v in r))
