"""Small-frame helpers shared by the tests."""

from datetime import datetime


def ts(text: str) -> datetime:
    """'2024-01-01 10:00' or a bare '10:00' on 2024-01-01."""
    if " " not in text:
        text = f"2024-01-01 {text}"
    return datetime.fromisoformat(text)


def frame(spark, columns: str, rows):
    """Frame with SQL-typed columns; time strings become timestamps."""
    fields = [c.split() for c in columns.split(",")]
    names = [n for n, _ in fields]
    times = [n for n, kind in fields if kind == "timestamp"]
    plain = ", ".join(f"{n} string" if n in times else f"{n} {kind}" for n, kind in fields)
    df = spark.createDataFrame([tuple(r) for r in rows], plain)
    out = []
    for n in names:
        if n in times:
            out.append(f"CAST(IF(length(`{n}`) < 9, concat('2024-01-01 ', `{n}`), `{n}`) AS TIMESTAMP) AS `{n}`")
        else:
            out.append(n)
    return df.selectExpr(*out)


def tuples(df, *columns):
    rows = df.select(*columns).collect() if columns else df.collect()
    return sorted((tuple(r) for r in rows), key=repr)
