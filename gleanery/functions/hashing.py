"""Content hashes and perceptual hashes."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from gleanery.shipping import ship


def md5_hex(content: Column) -> Column:
    return F.md5(content.cast("binary"))


def _blake2b(contents):
    return contents.map(lambda x: None if x is None else hashlib.blake2b(bytes(x), digest_size=16).hexdigest())


def blake2b_128(content: Column) -> Column:
    """16-byte BLAKE2b in hexadecimal, which the JVM has no function for."""
    if session := SparkSession.getActiveSession():
        ship(session)
    return F.pandas_udf(_blake2b, "string")(content.cast("binary"))


def hamming(a: Column, b: Column) -> Column:
    """Differing bits of two 64-bit hashes."""
    return F.bit_count(a.bitwiseXOR(b))


def perceptual_hash(pixels: np.ndarray) -> int:
    """64-bit DCT hash of an RGB or grey image, as a signed number.

    Grey values are averaged to 32 x 32, transformed, and the 8 x 8 lowest frequencies compared with their median. The same
    pixels always have the same hash; bits are not promised to equal another library's, which resamples otherwise.
    """
    from gleanery.functions.pixels import resample

    grey = pixels.astype(np.float64)
    if grey.ndim == 3:
        grey = grey[..., :3] @ np.array([0.299, 0.587, 0.114])
    small = resample(grey, 32, 32)
    k = np.arange(32)
    basis = np.cos(np.pi * (2 * k[None, :] + 1) * k[:, None] / 64)
    low = (basis @ small @ basis.T)[:8, :8]
    bits = (low > np.median(low)).reshape(-1)
    return int(np.packbits(bits).view(">i8")[0])
