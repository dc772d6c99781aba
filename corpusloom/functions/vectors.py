"""Vector and membership expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """Inner product in double precision, summed from the first element on."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0).cast("double"), lambda total, x: total + x)


def l2_norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def l2_normalize(v: Column) -> Column:
    """Unit vector; a zero vector stays zero.

    The norm goes in as an array, so that it is computed once per row and not once per element.
    """
    norms = F.array_repeat(F.nullif(l2_norm(v), F.lit(0.0)), F.size(v))
    return F.zip_with(v, norms, lambda x, norm: F.coalesce(x.cast("double") / norm, F.lit(0.0)))


def dominant(probs: Column) -> Column:
    """Index of the largest membership, the lowest index on ties."""
    return (F.array_position(probs, F.array_max(probs)) - 1).cast("int")


def ranked_clusters(probs: Column) -> Column:
    """Structs ``(p, cluster)`` from the most probable cluster on, lowest index first on ties."""
    keyed = F.transform(probs, lambda p, i: F.struct((-p).alias("minus_p"), i.cast("int").alias("cluster")))
    return F.transform(
        F.array_sort(keyed), lambda s: F.struct((-s["minus_p"]).alias("p"), s["cluster"].alias("cluster"))
    )


def route(probs: Column, depth: int = 3) -> Column:
    """The ``depth`` most probable clusters, best first: where a query looks for cached entries."""
    return F.transform(F.slice(ranked_clusters(probs), 1, depth), lambda s: s["cluster"])


def probability_map(probs: Column, n: int = 5, places: int = 4) -> Column:
    """``cluster_i -> probability`` of the ``n`` most probable clusters."""
    entries = F.transform(
        F.slice(ranked_clusters(probs), 1, n),
        lambda s: F.struct(F.concat(F.lit("cluster_"), s["cluster"].cast("string")), F.round(s["p"], places)),
    )
    return F.map_from_entries(entries)
