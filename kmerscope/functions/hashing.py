"""Feature hashing and MinHash expressions that any SQL engine can reproduce.

Spark ML's ``HashingTF`` uses murmur3, which SQL engines lack; the native path
here hashes a packed k-mer code with plain integer arithmetic instead, so an
oracle query can compute the very same feature ids and signatures.
"""

from __future__ import annotations

import random

from pyspark.sql import Column
from pyspark.sql import functions as F

from .kmers import CODE_BITS

# Fixed values.
MERSENNE_31 = 2147483647          # modulus of the polynomial k-mer hash
POLY_BASE = 1000003               # multiplier of the polynomial k-mer hash
MINHASH_PRIME = 2038074743        # modulus of the MinHash permutations (as in Spark ML MinHashLSH)
DEFAULT_NUM_FEATURES = 1 << 14    # 16,384 hashed features
DEFAULT_SEED = 42


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def code_points(code, k: int = 3) -> list[Column]:
    """The k code points packed in a k-mer code, first character first."""
    c = _col(code)
    mask = F.lit((1 << CODE_BITS) - 1)
    return [F.shiftright(c, CODE_BITS * (k - 1 - j)).bitwiseAND(mask) for j in range(k)]


def feature_id(code, k: int = 3, num_features: int = DEFAULT_NUM_FEATURES) -> Column:
    """Hashed feature id of a packed k-mer: polynomial hash mod 2**31-1, then mod num_features.

    All intermediates stay below 2**52, so no engine overflows.
    """
    cps = code_points(code, k)
    h = cps[0]
    for cp in cps[1:]:
        h = (h * F.lit(POLY_BASE) + cp) % F.lit(MERSENNE_31)
    if k == 1:
        h = h % F.lit(MERSENNE_31)
    return (h % F.lit(num_features)).cast("bigint")


def feature_set(codes, k: int = 3, num_features: int = DEFAULT_NUM_FEATURES) -> Column:
    """Distinct hashed feature ids of an array of k-mer codes (the non-zero slots of a TF vector)."""
    return F.array_distinct(F.transform(_col(codes), lambda c: feature_id(c, k, num_features)))


def minhash_coefficients(num_hashes: int, seed: int = DEFAULT_SEED) -> list[tuple[int, int]]:
    """``(a, b)`` pairs of the permutations ``((1 + f) * a + b) mod p``, from a seeded generator."""
    rng = random.Random(seed)
    return [(rng.randrange(1, MINHASH_PRIME), rng.randrange(0, MINHASH_PRIME)) for _ in range(num_hashes)]


def band_keys(signature, num_bands: int, rows_per_band: int) -> Column:
    """array<struct<band int, key bigint>>: one bucket key per band of the signature.

    One row per band keeps the value itself; wider bands are hashed (a
    collision only adds a candidate, which verification removes).
    """
    s = _col(signature)
    out = []
    for j in range(num_bands):
        if rows_per_band == 1:
            key = s[j]
        else:
            key = F.xxhash64(F.slice(s, j * rows_per_band + 1, rows_per_band))
        out.append(F.struct(F.lit(j).alias("band"), key.cast("bigint").alias("key")))
    return F.array(*out)
