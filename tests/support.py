"""Helpers shared by the tests (not a conftest: every folder may have one of its own)."""

SF_SMALL = "/root/testdata/sf0.001"


def rows(df, *cols):
    """Sorted list of tuples of `cols` (all columns if none given)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def as_dict(df, key, value="n"):
    return {r[key]: r[value] for r in df.collect()}
