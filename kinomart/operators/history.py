"""Row history: what each row was from when to when, from refreshes and updates in any order.

A history has the key, the values, valid_from and valid_to (null: still). It is the same as a sequence of
events for each key: a value from a moment on, or the row's end. Updates are more events; a key's
intervals follow from its events in their order, so it does not matter when an event became known.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinomart.functions.columns import ntz

INTERVAL = ("valid_from", "valid_to")


def _moment(at: Column | datetime) -> Column:
    return ntz(at) if isinstance(at, datetime) else at


def values_of(history: DataFrame, keys: Sequence[str]) -> list[str]:
    return [c for c in history.columns if c not in (*keys, *INTERVAL)]


def start(rows: DataFrame, keys: Sequence[str], at: Column | datetime) -> DataFrame:
    """A history that begins with these rows."""
    empty = rows.where("false").withColumns({c: F.lit(None).cast("timestamp_ntz") for c in INTERVAL})
    return apply_updates(empty, rows, keys, at)


def _events(rows: DataFrame, keys: Sequence[str], values: Sequence[str], at: Column, known: int, gone: Column | None = None) -> DataFrame:
    """Events that became known in the order of `known`."""
    gone = F.lit(False) if gone is None else gone
    return rows.select(*keys, at.alias("at"), F.lit(known).alias("known"), gone.alias("gone"), F.struct(*values).alias("value"))


def _as_events(history: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Each interval's begin, and its end; an interval that begins there is known later than the end."""
    begins = _events(history, keys, values, F.col("valid_from"), 1)
    ended = history.where("valid_to IS NOT NULL")
    return begins.union(_events(ended, keys, values, F.col("valid_to"), 0, F.lit(True)))


def intervals(events: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """The history of events (keys, at, known, gone, value).

    Of a key's events of one moment the one known last counts, of those known alike the greatest value,
    a value rather than the row's end. Neighbouring intervals of one value are one interval. A key's
    events are sorted in one task; they are as many as its changes.
    """
    rank = F.struct("known", (~F.col("gone")).alias("there"), "value")
    one = events.groupBy(*keys, "at").agg(F.max_by(F.struct("gone", "value"), rank).alias("e"))
    along = Window.partitionBy(*keys).orderBy("at")
    before = F.lag("e").over(along)
    same = before.isNotNull() & (F.col("e.gone").eqNullSafe(before["gone"])) & (F.col("e.gone") | F.col("e.value").eqNullSafe(before["value"]))
    changes = one.withColumn("_same", same).where("not _same")
    spans = changes.withColumn("valid_to", F.lead("at").over(along)).where("not e.gone")
    return spans.select(*keys, *[F.col(f"e.value.{v}").alias(v) for v in values], F.col("at").alias("valid_from"), "valid_to")


def apply_updates(
    history: DataFrame, updates: DataFrame, keys: Sequence[str], at: Column | datetime, gone: Column | None = None
) -> DataFrame:
    """The history after updates: rows with new values from `at` on (a moment, or a column of the
    updates), or the row's end where `gone` holds.

    A late update holds until the next change that is known. Of several updates of one key and moment
    the greatest counts. Keys without updates pass as they are. Updates without key or moment are left
    out; `unusable` lists them.
    """
    keys, values = list(keys), values_of(history, keys)
    at = _moment(at)
    usable = updates.where(at.isNotNull())
    for k in keys:
        usable = usable.where(F.col(k).isNotNull())
    fresh = _events(usable, keys, values, at, 2, gone)
    touched = fresh.select(*keys).distinct()
    kept = history.join(touched, keys, "left_anti")
    mine = history.join(touched, keys, "left_semi")
    return kept.unionByName(intervals(_as_events(mine, keys, values).union(fresh), keys, values))


def unusable(updates: DataFrame, keys: Sequence[str], at: Column | datetime) -> DataFrame:
    """Updates that cannot be placed: without key, or without moment."""
    missing = _moment(at).isNull()
    for k in keys:
        missing = missing | F.col(k).isNull()
    return updates.where(missing)


def as_of(history: DataFrame, at: datetime | Column) -> DataFrame:
    """The rows as they were at a moment."""
    at = _moment(at)
    return history.where((F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (F.col("valid_to") > at))).drop(*INTERVAL)


def apply_refresh(
    history: DataFrame, state: DataFrame, keys: Sequence[str], at: datetime, refreshes: Sequence[datetime] = ()
) -> DataFrame:
    """The history after a full refresh of moment `at`: keys that it lacks end there.

    `refreshes` are the moments of those applied already. A late refresh says what held until the next
    one of them, which still holds as it did. Of the refresh's rows of one key the greatest counts.
    """
    keys, values = list(keys), values_of(history, keys)
    later = min((m for m in refreshes if m > at), default=None)

    def side(rows: DataFrame, name: str) -> DataFrame:
        known = rows
        for k in keys:
            known = known.where(F.col(k).isNotNull())
        return known.groupBy(*keys).agg(F.max(F.struct(*values)).alias(name))

    pairs = side(as_of(history, at), "_old").join(side(state, "_new"), keys, "full")
    differing = pairs.where(~F.col("_old").eqNullSafe(F.col("_new")))
    missing = F.col("_new").isNull()
    value = F.coalesce("_new", "_old")
    updates = differing.select(*keys, ntz(at).alias("_at"), missing.alias("_gone"), value.alias("_value"))
    if later is not None:
        held = differing.select(*keys).join(side(as_of(history, later), "_then"), keys, "left")
        # The value of a row's end says nothing; it is one of the right type.
        back = held.join(differing.select(*keys, value.alias("_any")), keys).select(
            *keys, ntz(later).alias("_at"), F.col("_then").isNull().alias("_gone"), F.coalesce("_then", "_any").alias("_value")
        )
        updates = updates.union(back)
    flat = updates.select(*keys, "_at", "_gone", *[F.col(f"_value.{v}").alias(v) for v in values])
    return apply_updates(history, flat, keys, F.col("_at"), F.col("_gone"))
