"""Vectors and hashes: expressions where Spark has them, Arrow batches for blobs."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, FloatType


def dot(a: Column, b: Column) -> Column:
    """Inner product in double precision."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def l2_normalize(a: Column) -> Column:
    """Unit length; the norm counts as 1e-12 at least."""
    return F.transform(a, lambda x: x / F.greatest(norm(a), F.lit(1e-12)))


def quantize(a: Column) -> Column:
    """Each x as tinyint: 127 x rounded half to even, within -128 and 127."""
    return F.transform(a, lambda x: F.greatest(F.lit(-128.0), F.least(F.lit(127.0), F.bround(x.cast("float") * F.lit(127).cast("float"), 0).cast("double"))).cast("tinyint"))


def dequantize(a: Column) -> Column:
    return F.transform(a, lambda x: x.cast("float") / F.lit(127).cast("float"))


def quantization_error(a: Column, q: Column) -> Column:
    """struct(cosine_error, l2_error) between unit vectors; null where a norm is under 1e-9 or lengths differ."""
    back = F.transform(q, lambda x: x.cast("double") / 127.0)
    na, nb = norm(a), norm(back)
    cosine = dot(a, back) / (na * nb)
    ok = (F.size(a) == F.size(q)) & (na >= 1e-9) & (nb >= 1e-9)
    apart = F.zip_with(a, back, lambda x, y: F.pow(x.cast("double") / na - y / nb, F.lit(2.0)))
    return F.when(ok, F.struct((1 - cosine).alias("cosine_error"), F.sqrt(F.aggregate(apart, F.lit(0.0), lambda s, x: s + x)).alias("l2_error")))


def diagnostics(a: Column) -> Column:
    """struct(dim, norm, min, max, has_nan, has_inf, first8) of a vector."""
    nan, inf = F.exists(a, lambda x: F.isnan(x)), F.exists(a, lambda x: F.abs(x) == float("inf"))
    return F.struct(F.size(a).alias("dim"), norm(a).alias("norm"), F.array_min(a).alias("min"), F.array_max(a).alias("max"), nan.alias("has_nan"), inf.alias("has_inf"), F.slice(a, 1, 8).alias("first8"))


def hash_prefix(content: Column, digits: int = 64) -> Column:
    """The first hex digits of the sha256 of bytes (a vector's blob, a model file); all 64 by default."""
    return F.substring(F.sha2(content, 256), 1, digits)


def average_hash(pixels: Column) -> Column:
    """64 values as 64 bits, the first the highest: 1 where a value is at least their mean."""
    mean = F.aggregate(pixels, F.lit(0.0), lambda s, x: s + x.cast("double")) / F.size(pixels)
    bit = lambda s, x: F.shiftleft(s, 1).bitwiseOR(F.when(x.cast("double") >= mean, F.lit(1)).otherwise(F.lit(0)).cast("long"))
    return F.aggregate(pixels, F.lit(0).cast("long"), bit)


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


@F.pandas_udf(ArrayType(FloatType()))
def decode_blob(blobs: pd.Series) -> pd.Series:
    """Little-endian float32 bytes as an array."""
    return blobs.map(lambda b: None if b is None else np.frombuffer(b, "<f4").copy())


@F.pandas_udf(BinaryType())
def encode_blob(vectors: pd.Series) -> pd.Series:
    """An array as little-endian float32 bytes."""
    return vectors.map(lambda v: None if v is None else np.asarray(v, "<f4").tobytes())
