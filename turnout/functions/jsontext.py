"""JSON text of values and of ordered points (charts are objects whose order matters)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_value(value: Column) -> Column:
    """JSON text of one value: whole numbers stay whole, null is ``null``."""
    text = F.to_json(F.struct(value.alias("v")), {"ignoreNullFields": "false"})
    return F.substring(text, F.lit(6), F.length(text) - 6)


def json_object(points: Column) -> Column:
    """A JSON object of an array of (x, y), y being JSON text, in that order.  A key that occurred before
    gets its place in brackets, as two areas may share a name."""
    def told_apart(p: Column, i: Column) -> Column:
        again = F.exists(F.slice(points, F.lit(1), i), lambda q: q["x"] == p["x"])
        return F.when(again, F.concat(p["x"], F.lit(" ("), (i + 1).cast("string"), F.lit(")"))).otherwise(p["x"])
    fields = F.transform(points, lambda p, i: F.concat(json_value(told_apart(p, i)), F.lit(":"), p["y"]))
    return F.concat(F.lit("{"), F.array_join(fields, ","), F.lit("}"))
