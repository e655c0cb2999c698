"""What several operators share: word patterns, row keys, permutations and hashing inside tasks."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words between ASCII blanks; in Python, ``bytes.split()`` cuts at the same six characters.
WORDS = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of letters, digits and everything beyond ASCII, before lower-casing. Listed one by one, ASCII
#: characters are looked up in a bitmap, which is three times as fast as ranges or their complement.
ALNUM_WORDS = rf"[0123456789{UPPER}{LOWER}\x{{80}}-\x{{10FFFF}}]+"

#: Rows of a frame that may be broadcast; larger ones are joined by a shuffle.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def whole_row(docs: DataFrame) -> Column:
    """All columns as one struct, ``_row``, whose names can't clash with working columns."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")


def columns_of(docs: DataFrame) -> list[Column]:
    """The columns of ``docs`` out of the struct ``_row``."""
    return [F.col("_row").getField(c).alias(c) for c in docs.columns]


def lower_ascii(text: Column) -> Column:
    """``A-Z`` lower-cased and nothing else; plain ``lower`` does it where all characters are ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def bounded_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcasting if it has at most ``rows`` rows, else as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def forget(staged: DataFrame) -> None:
    """Remove the files of a staged frame that nothing reads any more."""
    spark = staged.sparkSession
    for folder in {file.rsplit("/", 1)[0] for file in staged.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def permute(index: Column, size: Column, seed: int, *tweak: Column, rounds: int = 24) -> Column:
    """A keyed permutation of ``0 .. size - 1`` by swap-or-not rounds.

    Each round pairs ``x`` with ``key - x`` (mod size) and swaps the pair if a hash of its larger
    member is odd, so every round, and all of them together, is one-to-one for any size.
    """
    size = size.cast("long")

    def turn(x: Column, r: Column) -> Column:
        key = F.pmod(F.xxhash64(F.lit(seed), r, *tweak), size)
        other = F.pmod(key + size - x, size)
        odd = F.xxhash64(F.lit(seed + 1), r, F.greatest(x, other), *tweak).bitwiseAND(F.lit(1))
        return F.when(odd == 1, other).otherwise(x)

    steps = F.array(*[F.lit(r) for r in range(rounds)])
    return F.aggregate(steps, index.cast("long"), turn)


MIX = np.uint64(0x9E3779B97F4A7C15)
_FINISH = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def word_hashes(words: Iterable[bytes], count: int) -> np.ndarray:
    """A 64-bit hash of each word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, count)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of each number over all 64 (a one-to-one finisher)."""
    h = h ^ (h >> np.uint64(30))
    h = h * _FINISH[0]
    h = h ^ (h >> np.uint64(27))
    h = h * _FINISH[1]
    return h ^ (h >> np.uint64(31))


def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every run of ``width`` words, from the hashes of the words."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for j in range(width):
        h = h * MIX + hashes[j : j + n]
    return mixed(h)
