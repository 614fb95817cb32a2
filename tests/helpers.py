"""Shared by the test modules (a module of its own: ``conftest`` names one in every folder)."""

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


def rows(df, order=None):
    cols = df.columns
    out = [tuple(r[c] for c in cols) for r in df.collect()]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))
