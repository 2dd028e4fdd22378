import math

from pointmill.schema import POINT

DEFAULTS = {"x": 0.0, "y": 0.0, "z": 0.0, "red": 0, "green": 0, "blue": 0,
            "intensity": 0.0, "timestamp": 0.0, "scan_angle": 0.0, "label": 1}


def points(spark, *rows):
    """Points from partial rows; what is not given takes a default."""
    return spark.createDataFrame([tuple({**DEFAULTS, **row}[c] for c in POINT.names) for row in rows], POINT)


def rows(df, *columns):
    """Rows as sorted tuples."""
    out = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(out, key=lambda r: [(v is None, str(type(v)), v if v is not None else 0) for v in r])


def canonical(names, values):
    """Column order and row order taken out, so results of two engines compare."""
    order = sorted(range(len(names)), key=lambda i: names[i])

    def text(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "NULL"
        return repr(v + 0.0) if isinstance(v, float) else str(v)

    return [names[i] for i in order], sorted(tuple(text(r[i]) for i in order) for r in values)
