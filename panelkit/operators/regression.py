"""Ordinary least squares over a whole panel, or over every group of it."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.functions.numeric import t_quantile, two_sided_p

cloudpickle.register_pickle_by_value(sys.modules[__name__])

INTERCEPT = "(Intercept)"
# A regressor is aliased when regressors before it leave less than this share of its sum of squares.
SINGULAR = 1e-10


def swept(products: np.ndarray, least: float = SINGULAR) -> tuple[np.ndarray, np.ndarray]:
    """Sweep the regressors of many matrices of centred cross-products, in order; the response comes last.

    A regressor that those before it leave nearly nothing of is not swept: it is
    aliased. Returns the swept matrices, whose last column holds the coefficients
    and last corner the residual sum of squares, and which regressors are in.
    """
    m = np.array(products, float)
    k = m.shape[1] - 1
    whole = np.diagonal(products, axis1=1, axis2=2).copy()
    used = np.zeros((len(m), k), bool)
    for j in range(k):
        at = np.flatnonzero(m[:, j, j] > least * whole[:, j])
        used[at, j] = True
        if not len(at):
            continue
        some = m[at]
        pivot = some[:, j, j][:, None].copy()
        row, column = some[:, j, :] / pivot, some[:, :, j].copy()
        some -= column[:, :, None] * row[:, None, :]
        some[:, j, :] = row
        some[:, :, j] = -column / pivot
        some[:, j, j] = 1 / pivot[:, 0]
        m[at] = some
    return m, used


def coefficients(n: np.ndarray, means: np.ndarray, products: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Estimates and standard errors (the intercept last) and residual degrees of freedom.

    Aliased terms are NaN, and so are standard errors without degrees of freedom.
    """
    k = means.shape[1] - 1
    # A constant is aliased with the intercept; its sum of squares is rounding noise.
    products = np.array(products, float)
    constant = np.diagonal(products, axis1=1, axis2=2)[:, :k] <= 1e-20 * n[:, None] * means[:, :k] ** 2
    for group, j in np.argwhere(constant):
        products[group, j, :] = products[group, :, j] = 0.0
    m, used = swept(products)
    slopes = np.where(used, m[:, :k, k], 0.0)
    inverse = m[:, :k, :k] * (used[:, :, None] & used[:, None, :])
    dof = n - 1 - used.sum(axis=1)
    with np.errstate(divide="ignore", invalid="ignore"):
        variance = np.where(dof > 0, np.maximum(m[:, k, k], 0.0) / dof, np.nan)
        spread = np.sqrt(variance[:, None] * np.diagonal(inverse, axis1=1, axis2=2))
        base = np.sqrt(variance * (1 / n + np.einsum("gi,gij,gj->g", means[:, :k], inverse, means[:, :k])))
    estimates = np.column_stack((np.where(used, slopes, np.nan), means[:, k] - (slopes * means[:, :k]).sum(axis=1)))
    return estimates, np.column_stack((np.where(used, spread, np.nan), base)), dof


def ols_coefficients(df: DataFrame, y: str, xs: Sequence[str], level: float = 0.95, min_rows: int = 11,
                     by: Sequence[str] = ()) -> DataFrame:
    """Tidy coefficients of ``y ~ xs`` with confidence limits, for every group of ``by``.

    Means and centred cross-products are summed on the executors in one pass, and
    the small matrices of all groups are swept in batches. A regressor that is constant
    or a combination of earlier ones is aliased: its row is there with the degrees
    of freedom and nulls, and the others are what they are without it. Rows with
    a missing or NaN value are left out. Groups of fewer than ``min_rows`` rows have no rows.
    """
    k, columns = len(xs), [*xs, y]
    values = [F.when(~F.isnan(F.col(f"`{c}`").cast("double")), F.col(f"`{c}`").cast("double")).alias(f"v{i}") for i, c in enumerate(columns)]
    groups = [F.col(f"`{c}`").alias(f"g{i}") for i, c in enumerate(by)]
    names = [f"v{i}" for i in range(k + 1)]
    data = df.select(*groups, *values).dropna(subset=names)
    pairs = [(i, j) for i in range(k + 1) for j in range(i, k + 1)]
    sums = data.groupBy(*[f"g{i}" for i in range(len(by))]).agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.avg(c) for c in names]).alias("means"),
        F.array(*[F.covar_pop(names[i], names[j]) for i, j in pairs]).alias("products")).where(F.col("n") >= max(min_rows, 1))
    kept = [T.StructField(f"g{i}", data.schema[f"g{i}"].dataType) for i in range(len(by))]
    schema = T.StructType([*kept, T.StructField("term", T.StringType()), T.StructField("estimate", T.DoubleType()),
                           T.StructField("std_error", T.DoubleType()), T.StructField("dof", T.LongType())])
    terms = [*xs, INTERCEPT]

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if not len(rows):
                continue
            n = rows["n"].to_numpy(float)
            products = np.zeros((len(rows), k + 1, k + 1))
            flat = np.stack(rows["products"].to_list()) * n[:, None]
            for place, (i, j) in enumerate(pairs):
                products[:, i, j] = products[:, j, i] = flat[:, place]
            estimates, errors, dof = coefficients(n, np.stack(rows["means"].to_list()), products)
            out = {f.name: rows[f.name].repeat(k + 1).to_numpy() for f in kept}
            null = lambda x: [None if v != v else v for v in x.ravel().tolist()]
            yield pd.DataFrame({**out, "term": terms * len(rows), "estimate": pd.Series(null(estimates), dtype=object),
                                "std_error": pd.Series(null(errors), dtype=object), "dof": np.repeat(dof.astype(np.int64), k + 1)})

    found = sums.mapInPandas(solve, schema)
    statistic = F.try_divide("estimate", "std_error")
    half = t_quantile(level, "dof") * F.col("std_error")
    return found.select(
        *[F.col(f"g{i}").alias(c) for i, c in enumerate(by)], "term", "estimate", "std_error", statistic.alias("statistic"),
        two_sided_p(statistic, "dof").alias("p_value"), "dof",
        (F.col("estimate") - half).alias("conf_low"), (F.col("estimate") + half).alias("conf_high"))
