"""Image-array functions (P14 label map, F12-F14).

Images are rows ``(id, channels ARRAY<ARRAY<FLOAT>>)`` with each channel a
flattened h x w grid.  Min-max and flips are built-in array expressions;
resize and rotation need 2-D index arithmetic and run as Arrow-batched pandas
UDFs over NumPy.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayspark.functions.tokens import HASH_MOD, arith_hash

# The 13 class names of the image data set, in label-id order (0..12).
LABELS = [
    "Actin_disruptors",
    "Aurora_kinase_inhibitors",
    "Cholesterol-lowering",
    "DMSO",
    "DNA_damage",
    "DNA_replication",
    "Eg5_inhibitors",
    "Epithelial",
    "Kinase_inhibitors",
    "Microtubule_destabilizers",
    "Microtubule_stabilizers",
    "Protein_degradation",
    "Protein_synthesis",
]


def minmax_channels(channels: Column, constant_to_zero: bool = False, eps: float = 1e-8) -> Column:
    """per-channel (x - min) / (max - min).

    A constant channel is left as is (data-set variant) or becomes 0 with the
    denominator clamped at ``eps`` (export-wrapper variant).
    """

    def one(ch: Column) -> Column:
        lo, hi = F.array_min(ch), F.array_max(ch)
        if constant_to_zero:
            return F.transform(ch, lambda x: (x - lo) / F.greatest(hi - lo, F.lit(eps)))
        return F.when(hi == lo, ch).otherwise(F.transform(ch, lambda x: (x - lo) / (hi - lo)))

    return F.transform(channels, one)


def flip_h(channels: Column, w: int) -> Column:
    """Horizontal flip of flattened h x w channels (reverse each row)."""

    def one(ch: Column) -> Column:
        n = F.size(ch)
        return F.transform(
            F.sequence(F.lit(0), n - 1),
            lambda i: F.element_at(ch, (F.floor(i / w) * w + (w - 1 - i % w) + 1).cast("int")),
        )

    return F.transform(channels, one)


def flip_v(channels: Column, w: int) -> Column:
    """Vertical flip of flattened h x w channels (reverse the row order)."""

    def one(ch: Column) -> Column:
        n = F.size(ch)
        h = (n / w).cast("int")
        return F.transform(
            F.sequence(F.lit(0), n - 1),
            lambda i: F.element_at(ch, ((h - 1 - F.floor(i / w)) * w + i % w + 1).cast("int")),
        )

    return F.transform(channels, one)


def hash_uniform(*cols: Column, seed: int = 42) -> Column:
    """Reproducible U[0,1) draw from key columns (independent of partitioning, and the same in SQL)."""
    return arith_hash(*cols, F.lit(seed)) / float(HASH_MOD)


def _bilinear_matrix(n_in: int, n_out: int) -> np.ndarray:
    """Interpolation weights with half-pixel centres (no corner alignment), edges clamped."""
    scale = n_in / n_out
    src = (np.arange(n_out) + 0.5) * scale - 0.5
    src = np.clip(src, 0, n_in - 1)
    lo = np.floor(src).astype(int)
    hi = np.minimum(lo + 1, n_in - 1)
    frac = src - lo
    m = np.zeros((n_out, n_in))
    m[np.arange(n_out), lo] += 1 - frac
    m[np.arange(n_out), hi] += frac
    return m


def resize_udf(h: int, w: int, out_h: int, out_w: int):
    """bilinear resize (half-pixel centres) as a pandas UDF: out = A . X . B^T per channel."""
    a = _bilinear_matrix(h, out_h)
    b = _bilinear_matrix(w, out_w)

    @F.pandas_udf(T.ArrayType(T.ArrayType(T.FloatType())))
    def resize(chs: pd.Series) -> pd.Series:
        out = []
        for img in chs:
            res = []
            for ch in img:
                x = np.asarray(ch, dtype=np.float64).reshape(h, w)
                res.append((a @ x @ b.T).astype(np.float32).ravel())
            out.append(res)
        return pd.Series(out)

    return resize


def augment_udf(h: int, w: int):
    """F14 as one Arrow-batched UDF: optional H/V flips, then nearest-neighbour rotation about the centre
    (degrees, zeros outside); the same draw applies to every channel of an image."""

    @F.pandas_udf(T.ArrayType(T.ArrayType(T.FloatType())))
    def aug(chs: pd.Series, fh: pd.Series, fv: pd.Series, angle: pd.Series) -> pd.Series:
        yy, xx = np.mgrid[0:h, 0:w]
        cy, cx = (h - 1) / 2.0, (w - 1) / 2.0
        out = []
        for img, do_h, do_v, ang in zip(chs, fh, fv, angle):
            t = np.deg2rad(ang)
            c, s = np.cos(t), np.sin(t)
            # inverse map: output pixel -> source pixel
            sx = c * (xx - cx) + s * (yy - cy) + cx
            sy = -s * (xx - cx) + c * (yy - cy) + cy
            ix, iy = np.rint(sx).astype(int), np.rint(sy).astype(int)
            ok = (ix >= 0) & (ix < w) & (iy >= 0) & (iy < h)
            res = []
            for ch in img:
                x = np.asarray(ch, dtype=np.float32).reshape(h, w)
                if do_h:
                    x = x[:, ::-1]
                if do_v:
                    x = x[::-1, :]
                y = np.zeros_like(x)
                y[ok] = x[iy[ok], ix[ok]]
                res.append(y.ravel())
            out.append(res)
        return pd.Series(out)

    return aug


def augment(df, channels: str, id_col: str, epoch: int, h: int, w: int, seed: int = 42, max_angle: float = 90.0):
    """flip H and V with p = 0.5 each and rotate by U(-max_angle, max_angle); one draw per (id, epoch) for all channels."""
    key = [F.col(id_col), F.lit(epoch)]
    u1 = hash_uniform(*key, seed=seed)
    u2 = hash_uniform(*key, seed=seed + 1)
    u3 = hash_uniform(*key, seed=seed + 2)
    x = df.withColumn("_flip_h", u1 < 0.5).withColumn("_flip_v", u2 < 0.5).withColumn("_angle", (u3 * 2 - 1) * max_angle)
    return x.withColumn(channels, augment_udf(h, w)(F.col(channels), F.col("_flip_h"), F.col("_flip_v"), F.col("_angle")))
