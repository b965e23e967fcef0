"""Left joins to a table of unique keys that survive null and hot keys without help from the planner.

All null keys of one side hash to one partition, and so do all rows of a hot key.  A null key matches nothing,
so it may be replaced by any value that no key has: its rows are spread over ``SLOTS`` such values, chosen by a
hash of another column (deterministic, so a task that runs again deals its rows out alike).  A hot key's rows are
spread over ``salts`` copies of its one row in the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOTS = 1024


def lookup(df: DataFrame, dim: DataFrame, keys: list[tuple[Column, str]], by: str, salts: int = 1) -> DataFrame:
    """``df`` left-joined to ``dim`` on ``(expression over df, column of dim)`` pairs; ``by`` spreads the rows.

    The key columns of ``dim`` are unique and are dropped; its others must not clash with ``df``'s.
    """
    nothing = F.lit(False)
    for left, _ in keys:
        nothing = nothing | left.isNull()
    slot = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(by), F.lit(SLOTS)).cast("string"))
    key = F.concat_ws("\u0001", *(left.cast("string") for left, _ in keys))
    d = df.withColumn("_lookup", F.when(nothing, slot).otherwise(F.concat(F.lit("\u0001"), key)))
    names = [name for _, name in keys]
    r = dim.where(F.expr(" AND ".join(f"`{n}` IS NOT NULL" for n in names))).withColumn(
        "_lookup", F.concat(F.lit("\u0001"), F.concat_ws("\u0001", *(F.col(n).cast("string") for n in names)))).drop(*names)
    on = ["_lookup"]
    if salts > 1:
        on.append("_salt")
        d = d.withColumn("_salt", F.pmod(F.xxhash64(F.lit(17), F.col(by)), F.lit(salts)).cast("int"))
        r = r.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return d.join(r, on, "left").drop(*on)
