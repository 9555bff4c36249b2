"""Pearson correlation and its two-sided p-value as SQL expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def pearson_r(x: Column, y: Column) -> Column:
    """Correlation of the rows where both sides are present; NULL if a side has no spread.

    Built from moments that merge, so each task combines its own rows before the shuffle. The built-in
    ``corr`` raises on a constant side under ANSI, hence the guarded division. The result is clamped
    to [-1, 1]; NaN (from infinities) stays NaN.
    """
    left = F.when(y.isNotNull(), x)
    right = F.when(x.isNotNull(), y)
    ratio = F.try_divide(F.covar_pop(x, y), F.stddev_pop(left) * F.stddev_pop(right))
    return F.when(F.abs(ratio) > 1.0, F.when(F.isnan(ratio), ratio).otherwise(F.signum(ratio))).otherwise(ratio)


def _inverse_beta_half(a: Column) -> Column:
    """1 / B(a, 1/2) for a > 0.

    The asymptotic series of ln(Γ(a+1/2) / Γ(a)) is exact to rounding beyond 15, so a is moved up by
    15 first and the factors that adds are divided out.
    """
    moved = a + 15.0
    log_ratio = (
        0.5 * F.ln(moved)
        - 1.0 / (8.0 * moved)
        + 1.0 / (192.0 * F.pow(moved, 3))
        - 1.0 / (640.0 * F.pow(moved, 5))
        + 17.0 / (14336.0 * F.pow(moved, 7))
    )
    undo = F.aggregate(F.sequence(F.lit(0), F.lit(14)), F.lit(1.0), lambda done, k: done * ((a + k) / (a + k + 0.5)))
    return F.exp(log_ratio) * undo / F.sqrt(F.pi())


def _beta_fraction(a: Column, b: Column, x: Column) -> Column:
    """Continued fraction of the incomplete beta function, evaluated from its tail.

    It needs on the order of sqrt(a + b) terms on the side where it is used.
    """
    terms = F.ceil(40.0 + 6.0 * F.sqrt(a + b)).cast("int")

    def fold(tail: Column, k: Column) -> Column:
        even = k * (b - k) * x / ((a + 2 * k - 1.0) * (a + 2 * k))
        odd = (a + k) * (a + b + k) * x / ((a + 2 * k) * (a + 2 * k + 1.0))
        return 1.0 + even / (1.0 - odd / tail)

    tail = F.aggregate(F.sequence(terms, F.lit(1), F.lit(-1)), F.lit(1.0), fold)
    return 1.0 / (1.0 - (a + b) * x / (a + 1.0) / tail)


def pearson_p(r: Column, n: Column) -> Column:
    """Two-sided p-value of a correlation over n pairs (n >= 3): I_x((n-2)/2, 1/2) at x = 1 - r².

    Near r = 0 the complement converges faster; there p is large, so subtracting loses nothing. NULL where
    r is NULL or NaN or n is below 3. The terms are bound once by a transform over one element: written
    out in place they would repeat in every expression that uses p.
    """
    a = (F.greatest(n, F.lit(3)).cast("double") - 2.0) / 2.0
    bound = F.struct(
        r.alias("r"), a.alias("a"), (r * r).alias("square"), ((1.0 - r) * (1.0 + r)).alias("rest")
    )
    half = F.lit(0.5)

    def value(t: Column) -> Column:
        scale = _inverse_beta_half(t["a"]) * F.pow(t["rest"], t["a"]) * F.abs(t["r"])
        return (
            F.when(F.abs(t["r"]) >= 1.0, F.lit(0.0))
            .when(t["r"] == 0.0, F.lit(1.0))
            .when(t["square"] * (t["a"] + 2.5) > 1.5, scale * _beta_fraction(t["a"], half, t["rest"]) / t["a"])
            .otherwise(1.0 - scale * _beta_fraction(half, t["a"], t["square"]) / 0.5)
        )

    defined = r.isNotNull() & ~F.isnan(r) & (n >= 3)
    return F.when(defined, F.transform(F.array(bound), value)[0])


def has_spread(column: Column) -> Column:
    """Aggregate: two distinct values exist exactly if the smallest is below the largest; no distinct set is kept."""
    return F.min(column) < F.max(column)
