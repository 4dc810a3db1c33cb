"""Array columns: vectors, positional equality, compacted flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stackroom.functions.numbers import let, round_exact


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def cosine_similarity(a: Column, b: Column) -> Column:
    """Cosine in double precision; 0 for empty, unequal-length or zero vectors."""
    usable = (F.size(a) == F.size(b)) & (F.size(a) > 0)
    norms = F.when(usable, F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))
    return let(norms, lambda n: F.coalesce(F.when(n > 0, dot(a, b) / n), F.lit(0.0)))


def positional_similarity(left: Column, right: Column) -> Column:
    """Share of equal characters by position over the longer length; 0 when either is empty."""
    a, b = F.split(left, ""), F.split(right, "")
    equal = F.aggregate(
        F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)).cast("int")),
        F.lit(0),
        lambda acc, x: acc + x,
    )
    longer = F.greatest(F.length(left), F.length(right))
    empty = F.coalesce(F.length(left) == 0, F.lit(True)) | F.coalesce(F.length(right) == 0, F.lit(True))
    return F.when(empty, F.lit(0.0)).otherwise(round_exact(equal / longer, 6))


def flags(*tests: tuple[Column, str]) -> Column:
    """The labels whose test holds, in the given order."""
    return F.array_compact(F.array(*[F.when(test, F.lit(label)) for test, label in tests]))
