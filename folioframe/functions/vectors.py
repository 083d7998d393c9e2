"""Vector expressions over ``array<float>`` or ``array<double>`` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioframe.functions.text import as_column


def dot(a: Column | str, b: Column | str) -> Column:
    products = F.zip_with(as_column(a), as_column(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine similarity in double precision; 0 when either vector is zero."""
    a, b = as_column(a), as_column(b)
    scale = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.coalesce(F.try_divide(dot(a, b), scale), F.when(scale == 0, F.lit(0.0)))
