import decimal
import math


def plain(value):
    if value is None:
        return None
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else int(value) if value == int(value) else round(value, 6)
    if hasattr(value, "isoformat"):
        return str(value)[:19].replace(" 00:00:00", "")
    return value


def rows(names, some):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in some), key=str)


def spark_rows(df):
    return sorted(df.columns), rows(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    return sorted(names), rows(names, found.fetchall())
