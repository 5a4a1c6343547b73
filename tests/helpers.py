import decimal


def norm(v):
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, (int, float)):
        return f"{v:.9g}"
    return str(v)


def same(df, duck, sql):
    """Same columns and the same rows in any order."""
    got = [tuple(r) for r in df.collect()]
    r = duck.execute(sql)
    names = [x[0] for x in r.description]
    want = r.fetchall()
    assert sorted(df.columns) == sorted(names)
    a = [df.columns.index(c) for c in sorted(names)]
    b = [names.index(c) for c in sorted(names)]
    assert sorted(tuple(norm(x[i]) for i in a) for x in got) == sorted(tuple(norm(x[i]) for i in b) for x in want)


def rows(df):
    return sorted(tuple(r) for r in df.collect())
