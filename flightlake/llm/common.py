"""Helpers shared by the operators of this package."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.session import stored

# ASCII bytes that are part of a word after lower-casing: digits and letters;
# every byte of a non-ASCII character belongs to a word. All else separates.
_WORD = b"0123456789abcdefghijklmnopqrstuvwxyz"
_TO_WORD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or b in _WORD else 32 for b in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8 bytes: ASCII lower-cased runs of digits,
    letters and non-ASCII characters. None has no words."""
    if not text:
        return []
    return text.encode("utf-8", "surrogatepass").translate(_TO_WORD).split()


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table under the cluster's checkpoint folder and read it
    back: the lineage ends there and every executor sees the files."""
    return stored(df, name)


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` less the columns that an operator is about to add (any case)."""
    gone = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in gone])


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """True where crc32 of the id as text leaves ``remainder`` (null id: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of uint64 values (finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(h: np.ndarray, k: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Polynomial hashes (mod 2^64) of every k consecutive values of ``h``,
    built by doubling; empty if there are fewer than k."""
    if len(h) < k:
        return h[:0]
    out, size, p = None, 0, np.uint64(base)
    power, block, width = p, h, 1
    rest = k
    with np.errstate(over="ignore"):
        while rest:
            if rest & 1:
                if out is None:
                    out, size, out_p = block, width, power
                else:
                    n = min(len(out), len(block) - size)
                    out = out[:n] + out_p * block[size:size + n]
                    out_p, size = out_p * power, size + width
            rest >>= 1
            if rest:
                block = block[:len(block) - width] + power * block[width:]
                width, power = 2 * width, power * power
    return out[:len(h) - k + 1]
