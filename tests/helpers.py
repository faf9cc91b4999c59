def rows(df, *columns):
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))


def values(df, column):
    return [r[0] for r in rows(df, column)]
