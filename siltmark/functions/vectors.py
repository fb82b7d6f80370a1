"""Vector functions over array<double>, in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltmark.functions.text import let


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def norm(v: Column) -> Column:
    return F.sqrt(_sum(F.transform(v, lambda x: x * x)))


def unit(v: Column) -> Column:
    """Null for a zero vector."""
    return let(norm(v), lambda n: F.when(n > 0, F.transform(v, lambda x: x / n)))


def vector_mean(vectors: Column) -> Column:
    """Of one vector, itself. Of several, the normalised mean of their unit vectors, zero vectors left out. Null where dimensions differ or the mean is zero."""
    dims = F.size(F.get(vectors, 0))
    units = F.filter(F.transform(vectors, unit), lambda u: u.isNotNull())

    def mean(us: Column) -> Column:
        zero = F.transform(F.get(us, 0), lambda _: F.lit(0.0))
        total = F.aggregate(us, zero, lambda a, u: F.zip_with(a, u, lambda x, y: x + y))
        return unit(F.transform(total, lambda x: x / F.size(us)))

    return (
        F.when(F.size(vectors) == 0, F.lit(None).cast("array<double>"))
        .when(F.exists(vectors, lambda v: F.size(v) != dims), F.lit(None).cast("array<double>"))
        .when(F.size(vectors) == 1, F.get(vectors, 0))
        .otherwise(let(units, lambda us: F.when(F.size(us) > 0, mean(us))))
    )


def cosine(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x * y)) / (norm(a) * norm(b))


def stub_vector(text: Column) -> Column:
    """A deterministic stand-in for an embedding model."""
    return F.array((F.char_length(text) % 7).cast("double"), F.lit(1.0), F.lit(0.5))
