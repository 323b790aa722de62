def rows_of(df, *order):
    found = df.orderBy(*order) if order else df
    return [tuple(r) for r in found.collect()]
