"""Forecast-error metrics as aggregates over rows with a prediction and a truth."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _err(p: str, t: str) -> Column:
    return F.col(p) - F.col(t)


def mae(p: str = "pred", t: str = "true") -> Column:
    return F.avg(F.abs(_err(p, t)))


def mse(p: str = "pred", t: str = "true") -> Column:
    return F.avg(_err(p, t) * _err(p, t))


def rmse(p: str = "pred", t: str = "true") -> Column:
    return F.sqrt(mse(p, t))


def mape(p: str = "pred", t: str = "true") -> Column:
    """Rows whose truth is 0 have no relative error and are left out."""
    return F.avg(F.abs(F.try_divide(_err(p, t), F.col(t))))


def mspe(p: str = "pred", t: str = "true") -> Column:
    r = F.try_divide(_err(p, t), F.col(t))
    return F.avg(r * r)


def rse(p: str = "pred", t: str = "true") -> Column:
    return F.sqrt(F.sum(_err(p, t) * _err(p, t))) / F.sqrt(F.count(t) * F.var_pop(t))


def r2(p: str = "pred", t: str = "true") -> Column:
    return 1 - F.sum(_err(p, t) * _err(p, t)) / (F.count(t) * F.var_pop(t))


def nd(p: str = "pred", t: str = "true") -> Column:
    return F.sum(F.abs(_err(p, t))) / F.sum(t)


def nrmse(p: str = "pred", t: str = "true") -> Column:
    return F.sqrt(mse(p, t)) / F.avg(t)


def gaussian_nll(x: Column, mu: Column, sigma: Column) -> Column:
    return 0.5 * math.log(2 * math.pi) + F.ln(sigma) + (x - mu) * (x - mu) / (2 * sigma * sigma)


def loss_mask(truth: Column, how: str = "nonzero") -> Column:
    """Which rows count in a loss: those whose truth isn't 0, or isn't negative (``known``)."""
    return {"nonzero": truth != 0, "known": truth >= 0}[how]


def patch_error(patches: DataFrame, keys: list[str], true: str = "patch", pred: str = "rebuilt") -> DataFrame:
    """Mean square error of rebuilt patches over patches and the places in them; patches of a key are of one length."""
    square = F.zip_with(true, pred, lambda a, b: (a - b) * (a - b))
    return patches.groupBy(*keys).agg(F.avg(F.aggregate(square, F.lit(0.0), lambda s, x: s + x) / F.size(true)).alias("error"))


def bundle(df: DataFrame, keys: list[str], p: str = "pred", t: str = "true") -> DataFrame:
    """mae, mse, rmse, mape, mspe, rse and corr of each key; corr over series if there is a column ``cell``, else over single cells."""
    names = {"mae": mae, "mse": mse, "rmse": rmse, "mape": mape, "mspe": mspe, "rse": rse}
    out = df.groupBy(*keys).agg(*[f(p, t).alias(n) for n, f in names.items()])
    return out.join(corr(df, keys, "cell", p, t), keys) if "cell" in df.columns else out


def corr(df: DataFrame, keys: list[str], cell: str, p: str = "pred", t: str = "true", scale: float = 0.01, eps: float = 1e-12) -> DataFrame:
    """scale * mean over cells of sum(dt dp) / (sqrt(sum(dt^2 dp^2)) + eps); the sums go over the samples of a cell. Not Pearson's."""
    part = Window.partitionBy(*keys, cell)
    d = df.select(*keys, cell, (F.col(t) - F.avg(t).over(part)).alias("dt"), (F.col(p) - F.avg(p).over(part)).alias("dp"))
    cells = d.groupBy(*keys, cell).agg(F.sum(F.col("dt") * F.col("dp")).alias("u"), F.sqrt(F.sum(F.col("dt") * F.col("dt") * F.col("dp") * F.col("dp"))).alias("d"))
    return cells.groupBy(*keys).agg((F.avg(F.try_divide(F.col("u"), F.col("d") + eps)) * scale).alias("corr"))


def top_k_loss(df: DataFrame, keys: list[str], k: int, loss: str = "loss", tie: str = "id") -> DataFrame:
    """Mean of each key's k largest losses."""
    order = Window.partitionBy(*keys).orderBy(F.desc(loss), tie)
    return df.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= k).groupBy(*keys).agg(F.avg(loss).alias("top_k_loss"))


def lp_loss(df: DataFrame, keys: list[str], p: float = 2.0, pred: str = "pred", t: str = "true") -> DataFrame:
    """Lp distance of each example, and relative to the norm of the truth."""
    norm = lambda x: F.pow(F.sum(F.pow(F.abs(x), F.lit(p))), F.lit(1.0 / p))
    return df.groupBy(*keys).agg(norm(_err(pred, t)).alias("lp"), F.try_divide(norm(_err(pred, t)), norm(F.col(t))).alias("lp_rel"))


def masked_mse(p: str = "pred", t: str = "true", mask: str = "mask") -> Column:
    return F.try_divide(F.sum(_err(p, t) * _err(p, t) * F.col(mask)), F.sum(mask))


def weighted_mean(loss: str, weight: str) -> Column:
    return F.try_divide(F.sum(F.col(loss) * F.col(weight)), F.sum(weight))


def covariance(df: DataFrame, series: str, index: str, value: str) -> DataFrame:
    """Population covariance of every pair of series (a, b), matched by index."""
    left, right = df.select(F.col(index).alias("i"), F.col(series).alias("a"), F.col(value).alias("x")), df.select(F.col(index).alias("i"), F.col(series).alias("b"), F.col(value).alias("y"))
    return left.join(right, "i").groupBy("a", "b").agg(F.covar_pop("x", "y").alias("cov"))
