"""Rows of a result in a fixed order, for exact comparisons."""


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
