"""Insert-or-update and insert-if-absent as joins, and ids for the new rows.

Plain Parquet tables have no MERGE. Each function returns the rows to write; the caller publishes
a new version or appends (see :mod:`marketlake.operators.sinks`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketlake.operators.ranking import first_per_key, with_position
from marketlake.session import stored

# New rows that are numbered in one task; only the plan depends on it.
FEW_ROWS = 20_000


def upsert(
    existing: DataFrame,
    incoming: DataFrame,
    key: str,
    update: Sequence[str],
    keep_existing_on_null: bool = False,
) -> DataFrame:
    """The table after the upsert, with the columns of ``existing``.

    New keys bring all their columns. A known key takes only the ``update`` columns from the
    incoming row; with ``keep_existing_on_null`` an incoming NULL does not replace a value.
    Columns that ``incoming`` lacks are NULL in new rows; a key that comes twice in it is an error.
    """
    old = existing.withColumn("_old", F.lit(True)).alias("old")
    new = _counted(incoming, key).withColumn("_new", F.lit(True)).alias("new")
    columns = []
    for name in existing.columns:
        if name == key:
            columns.append(_refused(key))
            continue
        was = F.col(f"old.{name}")
        if name not in incoming.columns:
            columns.append(was)
            continue
        now = F.col(f"new.{name}")
        if name not in update:
            value = F.when(F.col("_old"), was).otherwise(now)
        elif keep_existing_on_null:
            value = F.coalesce(now, was)
        else:
            value = F.when(F.col("_new"), now).otherwise(was)
        columns.append(value.alias(name))
    return old.join(new, key, "full_outer").select(*columns)


def _counted(incoming: DataFrame, key: str) -> DataFrame:
    """One row per key and the number of rows it had, with the shuffle that the join needs anyway."""
    others = [c for c in incoming.columns if c != key]
    rows = incoming.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"), F.first(F.struct(key, *others)).alias("_row"))
    return rows.select(key, "_rows", *(F.col(f"_row.{c}").alias(c) for c in others))


def _refused(key: str) -> Column:
    fault = F.raise_error(F.concat(F.lit(f"more than one incoming row for {key} "), F.col(key).cast("string")))
    return F.when(F.col("_rows") > 1, fault).otherwise(F.col(key)).alias(key)


def upsert_with_ids(
    existing: DataFrame,
    incoming: DataFrame,
    key: str,
    update: Sequence[str],
    id_column: str,
    keep_existing_on_null: bool = False,
) -> DataFrame:
    """The table after the upsert, where new keys get the next ids in their order.

    One join, whose result is stored: its rows without an id are the new ones. Only these are numbered, from the largest
    id on (that and their number reach the driver).
    """
    incoming = incoming.select([c for c in incoming.columns if c != id_column])
    merged = stored(upsert(existing, incoming, key, update, keep_existing_on_null), "upserted")
    unnumbered = F.col(id_column).isNull()
    last, new = merged.agg(F.max(id_column), F.count_if(unnumbered)).first()
    if not new:
        return merged
    fresh = _numbered(merged.filter(unnumbered), new, key)
    number = (F.col("_position") + F.lit((last or 0) + 1)).cast(existing.schema[id_column].dataType)
    return merged.filter(~unnumbered).unionByName(fresh.withColumn(id_column, number).select(*existing.columns))


def _numbered(rows: DataFrame, count: int, key: str) -> DataFrame:
    """Stored rows with their place by key: few ones by a window in one task, more by a range sort."""
    if count <= FEW_ROWS:
        return rows.withColumn("_position", F.row_number().over(W.orderBy(key)) - 1)
    return with_position(rows, key, name="_position")


def absent(existing: DataFrame, incoming: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Incoming rows whose key the table lacks, one per key."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    rest = [c for c in incoming.columns if c not in keys]
    one = first_per_key(incoming, keys, *rest) if rest else incoming.distinct()
    return one.join(existing.select(*keys), keys, "left_anti")


def with_new_ids(rows: DataFrame, id_column: str, *order: str, start: int | None = None) -> DataFrame:
    """Give rows without an id the next ids in ``order``; the other rows keep theirs.

    ``start`` is the last id in use (one number to the driver); by default the largest in ``rows``.
    """
    rows = stored(rows, "ids")
    known = rows.filter(F.col(id_column).isNotNull())
    if start is None:
        start = known.agg(F.max(id_column)).first()[0] or 0
    fresh = with_position(rows.filter(F.col(id_column).isNull()), *order, name="_position")
    kind = rows.schema[id_column].dataType
    fresh = fresh.withColumn(id_column, (F.col("_position") + F.lit(start + 1)).cast(kind)).drop("_position")
    return known.unionByName(fresh)


def hash_ids(existing: DataFrame, incoming: DataFrame, key: str, id_column: str, bits: int = 63, most_rounds: int = 40) -> DataFrame:
    """key, id: ids for the incoming keys that the table lacks, taken from a hash of the key.

    No row is sorted and none is numbered after another, so loads in any order give a key the same id. Only where
    two keys have one hash, or a stored id has it already, one takes the hash of the next round: among new keys those
    after the least one. ``bits`` is how many of the hash are kept; with 63, a billion keys meet about once in twenty
    such tables, so a second round is rarely needed, and it has the few colliding keys only.
    """
    new = incoming.select(key).filter(F.col(key).isNotNull()).distinct().join(existing.select(key), key, "left_anti")
    taken, open_ = existing.select(F.col(id_column).cast("long").alias("id")), stored(new, "keys")
    given: DataFrame | None = None
    for number in range(most_rounds):
        tried = open_.select(key, F.shiftrightunsigned(F.xxhash64(F.lit(number), F.col(key)), 64 - bits).alias("id"))
        first = tried.groupBy("id").agg(F.min(key).alias(key)).join(taken, "id", "left_anti")
        placed = stored(first.select(key, "id"), "ids")
        given = placed if given is None else given.unionByName(placed)
        open_ = stored(open_.join(placed, key, "left_anti"), "keys")
        if open_.isEmpty():
            return given
        taken = taken.unionByName(placed.select("id"))
    raise RuntimeError(f"keys without an id after {most_rounds} rounds: {bits} bits are too few")
