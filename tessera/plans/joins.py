"""Dictionary / parameter lookups with a checked broadcast.

A fitted dictionary is broadcast only when its row count (an exact, already
computed number) is under ``BROADCAST_MAX_ROWS`` and its bytes are under
``BROADCAST_MAX_BYTES``. Above that the lookup is a
shuffled join whose big side is salted, so a category holding a third of all
rows is spread over at least ``SALT`` reducers instead of one; the dictionary side is
replicated once per salt value (it has one row per distinct key, no hot key).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 64 << 20
SALT = 32               # reducers of one hot key, at least; grows with the shuffle partitions


def fits_broadcast(small: DataFrame, rows: int) -> bool:
    """Rows and bytes of ``small`` are under the bounds (the bytes of strings are
    measured, one small aggregate; other columns count 16 bytes)."""
    if rows > BROADCAST_MAX_ROWS:
        return False
    strings = [f.name for f in small.schema.fields if f.dataType.simpleString() == "string"]
    if rows <= 1000 or not strings:
        return True
    size = F.lit(16 * len(small.columns))
    for c in strings:
        size = size + F.coalesce(F.octet_length(c), F.lit(0))
    return (small.agg(F.sum(size.cast("long"))).first()[0] or 0) <= BROADCAST_MAX_BYTES


def lookup_join(big: DataFrame, small: DataFrame, on: list[str], small_rows: int,
                how: str = "left", salt: int = SALT) -> DataFrame:
    """``big`` joined with a dictionary ``small`` that is unique on ``on``."""
    if how not in ("left", "inner"):
        raise ValueError("lookup_join supports left and inner joins")
    if fits_broadcast(small, small_rows):
        return big.join(F.broadcast(small), on, how)
    salt = max(salt, int(big.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 8)
    # salt from the row's content alone, so a retried task sends a row to the
    # same place again (map columns cannot be hashed)
    hashable = [F.col(f.name) for f in big.schema.fields if not isinstance(f.dataType, MapType)]
    salted_big = big.withColumn(
        "_salt", F.pmod(F.xxhash64(*hashable), F.lit(salt)))
    salted_small = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    return salted_big.join(salted_small, on + ["_salt"], how).drop("_salt")
