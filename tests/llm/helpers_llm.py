import brute

__all__ = ["brute", "column", "rows"]


def rows(df, key):
    """Rows by key; each key once."""
    found = df.collect()
    out = {r[key]: r for r in found}
    assert len(out) == len(found)
    return out


def column(name):
    return name[2:].split("_")[0]
