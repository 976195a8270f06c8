"""One-hash bitmap offset (M3, M4).

The reference's bitmap stores a user at bit ``h(id) & (capacity - 1)`` with
``h = h * seed + char`` folded over the id's characters.  Masking inside the
fold gives the same value (arithmetic mod 2^k commutes with the mask) and
keeps every intermediate below ``capacity * seed``, so no ANSI overflow.
The fold is a SQL higher-order function: it stays inside whole-stage codegen
and needs no Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the reference: seed 97, bitmap of 2^29 bits, default
# capacity 2^27 when no positive size is given.
DEFAULT_SEED = 97
DEFAULT_BITS = 29
FALLBACK_CAPACITY = 1 << 27


def bitmap_capacity(size: int | None) -> int:
    """M4: the capacity rule, validated (the mask is only right for 2^k)."""
    cap = size if size and size > 0 else FALLBACK_CAPACITY
    if cap & (cap - 1):
        raise ValueError(f"bitmap capacity must be a power of two, got {cap}")
    return cap


def poly_hash(col: Column | str, seed: int = DEFAULT_SEED,
              capacity: int = 1 << DEFAULT_BITS) -> Column:
    """M3: ``fold(h * seed + code(ch)) & (capacity - 1)`` over the string."""
    cap = bitmap_capacity(capacity)
    mask = cap - 1
    s = F.col(col) if isinstance(col, str) else col
    chars = F.split(s.cast("string"), "")
    return F.aggregate(
        chars, F.lit(0).cast("bigint"),
        lambda acc, ch: (acc * F.lit(seed) + F.ascii(ch).cast("bigint"))
        .bitwiseAND(F.lit(mask).cast("bigint")))
