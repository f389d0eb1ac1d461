"""Vector expressions over ``ARRAY<FLOAT|DOUBLE>`` columns.

Spark 4.1 has no built-in vector dot product, so these are higher-order
array expressions.  They are evaluated row by row outside generated code: use them for
candidate rows, and the block products of ``operators.knn`` for whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def dot(a, b) -> Column:
    """Inner product, accumulated in double."""
    prods = F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prods, F.lit(0.0), lambda acc, v: acc + v)


def norm(a) -> Column:
    return F.sqrt(F.aggregate(_c(a), F.lit(0.0), lambda acc, v: acc + v.cast("double") * v.cast("double")))


def l2_normalize(a, floor: float = 1e-12) -> Column:
    """Divide by the L2 norm, the norm floored at ``floor`` (double).  The norm is bound to a lambda's variable: a
    plain expression inside ``transform`` would be evaluated again for every element."""
    norms = F.array(F.greatest(norm(a), F.lit(floor)))
    return F.transform(norms, lambda n: F.transform(_c(a), lambda v: v.cast("double") / n))[0]
