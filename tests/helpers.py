def rows(df, *columns):
    """Rows as sorted tuples."""
    found = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in found.collect()), key=repr)


def one(df):
    (row,) = df.collect()
    return row
