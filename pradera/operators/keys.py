"""Surrogate ids, id maps, foreign-key remaps and key updates.

Numbering never uses an unpartitioned window: rows are dealt by ranges of the order, sorted in each range and written
once with their place, whatever the ids' values are; the ranges are counted from what was written.  What the rows are
made from is computed once, not again for counts, samples and summaries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import write_once
from .aggregate import keep_last

_PLACE_BITS = 33  # of monotonically_increasing_id: the place in a partition; the partition is above


def row_numbers(df: DataFrame, order: Sequence[Column | str], name: str = "row_no") -> DataFrame:
    """Global 1-based numbering in ``order`` (nulls first), as long; ``df`` is written once, with its places.

    Partitions and places only mean something together with the rows that were written, so nothing is numbered again.
    Rows that share all of ``order`` can't be parted."""
    by = {f"_by{i}": F.col(o) if isinstance(o, str) else o for i, o in enumerate(order)}
    ranged = df.withColumns(by).repartitionByRange(*by).sortWithinPartitions(*by)
    rows = write_once(ranged.select(*[F.col(f"`{c}`") for c in df.columns], F.monotonically_increasing_id().alias("_at")),
                      "row-numbers")
    part = F.shiftrightunsigned("_at", _PLACE_BITS).cast("int")
    counted = dict(rows.groupBy(part.alias("part")).count().collect())  # a row for each partition that holds any
    before, total = [], 0
    for p in range(max(counted, default=-1) + 1):
        before.append(f"{total}L")
        total += counted.get(p, 0)
    start = F.get(F.expr(f"array({','.join(before) or '0L'})"), part)
    place = F.col("_at").bitwiseAND((1 << _PLACE_BITS) - 1)
    return rows.withColumn(name, start + place + F.lit(1)).drop("_at")


def assign_ids(df: DataFrame, old_id: str, start_after: Column, name: str = "new_id",
               tie: Sequence[str] = ()) -> DataFrame:
    """``new_id = start_after + row_number() over (order by old_id)``; rows without an old id come first.

    ``start_after`` is usually a scalar subquery (``max`` of the stored ids),
    so the stored table's existing ids are never reused (trap T11).  ``tie``
    columns break ties between equal old ids.  The rows are stored first: ranges are drawn from them, and what makes
    them (joins, mostly) would run again for that."""
    n = row_numbers(write_once(df, "without-ids"), [F.col(old_id), *[F.col(t) for t in tie]], "_no")
    return n.withColumn(name, F.coalesce(start_after, F.lit(0)) + F.col("_no")).drop("_no")


def id_map(df: DataFrame, old_id: str, start_after: Column, old_name: str = "old_id",
           new_name: str = "new_id") -> DataFrame:
    """The ``(old, new)`` map for distinct old ids."""
    d = df.select(F.col(old_id).alias(old_name)).filter(F.col(old_name).isNotNull()).distinct()
    return assign_ids(d, old_name, start_after, new_name)


def remap(facts: DataFrame, fk: str, maps: Sequence[DataFrame], old: str = "old_id", new: str = "new_id",
          out: str | None = None) -> DataFrame:
    """J14 (T17): replace ``fk`` through the union of id maps; unmapped -> null."""
    u = maps[0].select(old, new)
    for m in maps[1:]:
        u = u.unionByName(m.select(old, new))
    u = u.withColumnsRenamed({old: "_old", new: "_new"})
    j = facts.join(u, facts[fk] == u["_old"], "left")
    return j.withColumn(out or fk, F.col("_new")).drop("_old", "_new")


def zip_rows(left: DataFrame, right: DataFrame, left_order: Sequence[Column | str],
             right_order: Sequence[Column | str]) -> DataFrame:
    """Positional zip = full join on explicit row numbers of both sides."""
    return row_numbers(left, left_order, "_pos").join(row_numbers(right, right_order, "_pos"), on="_pos", how="full")


def key_update(target: DataFrame, updates: DataFrame, key: str, col: str, value: str | None = None,
               order: Sequence[Column | str] | None = None, unmatched_to_null: bool = True) -> DataFrame:
    """K6: ``UPDATE target SET col = updates.value WHERE key = ...`` as a new snapshot.

    An update never adds rows: of several updates for one key the last in ``order`` counts (without one, the largest
    value).  Rows without an update get null, as the original's second pass does, or keep theirs."""
    u = updates.select("*", F.col(value or col).alias("_uv"), F.col(key).alias("_uk")).where("_uk is not null")
    u = keep_last(u, ["_uk"], list(order) if order else ["_uv"]).select("_uk", "_uv", F.lit(True).alias("_hit"))
    j = target.join(u, target[key] == u["_uk"], "left")
    new = F.col("_uv")
    if col in target.columns and not unmatched_to_null:
        new = F.when(F.col("_hit"), F.col("_uv")).otherwise(F.col(col))
    cols = [new.alias(col) if c == col else F.col(c) for c in target.columns]
    if col not in target.columns:
        cols.append(new.alias(col))
    return j.select(*cols)
