"""Gold by changed days: after new Silver rows only the days that they touch are worked out again."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.operators.settle import settle
from trendloom.plans import gold
from trendloom.plans.jobs import BUILDERS, kept_by_id, side_by_side
from trendloom.schemas import FEEDS
from trendloom.sources.tables import TableStore

#: Gold tables that are kept by days, and the column that names the hour or day of a row.
BY_DAY = {"trending_topics": "hour_window", "source_activity": "hour_window", "language_momentum": "day_window"}
SILVER = [("silver", name) for name in (*FEEDS, "enriched")]


def refresh_gold(
    store: TableStore, as_of: datetime | None = None, target: TableStore | None = None, owner: str = "gold"
) -> dict[str, int]:
    """Bring the Gold tables up to the present Silver tables; returns the rows written per table.

    A run reads one pinned version of each Silver table and records these versions with its tables.
    The next run asks which rows were written since, takes the days in which these rows stand now
    and stood before, and replaces those days. A row that moved between hours changes both. The
    leaderboard covers a few days only and is made anew from those. Without earlier tables, or if
    a version of then is gone, all days are made. The result is that of a full run.

    Hours of a day are made together, so a refresh costs the changed days, whatever the history is.
    """
    target = target or store
    now = store.pin(f"{owner}-next", SILVER)
    feeds = [name for name in FEEDS if f"silver/{name}" in now]
    if not feeds:
        raise FileNotFoundError(f"no upserted Silver tables under {store.root}; run the Silver job first")
    before = _versions_behind(target)
    days = None if before is None else changed_days(store, before, now)

    changed = combined_where(store, now, None if days is None else in_days(days))
    target.overwrite(gold.for_builders(changed), "work", "changed")
    rows = target.read("work", "changed")

    def one(name: str) -> int:
        return target.replace_days(BUILDERS[name](rows, as_of), "gold", name, BY_DAY[name], days, now)

    def leaders() -> int:
        recent = combined_where(store, now, F.col("published_at") >= gold._period_start(as_of, gold.LEADERBOARD_DAYS))
        target.overwrite(gold.for_builders(recent), "work", "recent")

        def texts(ids: DataFrame) -> DataFrame:
            few = [store.read_matching("silver", feed, ids, now[f"silver/{feed}"]) for feed in feeds]
            return gold.combine_silver(few, unique=kept_by_id(store)).select("unified_id", *gold.LOOKED_UP)

        made = gold.top_content(target.read("work", "recent"), as_of, texts=texts)
        return target.overwrite(made, "gold", "top_content", now)

    tasks = {name: partial(one, name) for name in BY_DAY} if days is None or days else {}
    written = dict.fromkeys(BY_DAY, 0) | side_by_side({**tasks, "top_content": leaders})
    store.pin(owner, SILVER, now)
    return written


def _versions_behind(target: TableStore) -> dict[str, int] | None:
    """The Silver versions that all tables kept by days were made from; the oldest of each if a run was
    lost between two tables, since a day that is made twice is the same.
    """
    found = [target.made_from("gold", name) for name in BY_DAY]
    if not all(found) or len({frozenset(f) for f in found}) > 1:
        return None
    return {table: min(f[table] for f in found) for table in found[0]}


def changed_days(store: TableStore, before: dict[str, int], now: dict[str, int]) -> list[date | None] | None:
    """Days of all rows that differ between two states of the Silver tables, and perhaps some more; None
    if that cannot be told. A row without a time has the day None.

    The days of a table are bounded by the calendar, so they may go to the driver.
    """
    if set(before) - set(now):
        return None
    ids = []
    for table, version in now.items():
        layer, name = table.split("/")
        if before.get(table) == version:
            continue
        fresh = store.written_since(layer, name, before[table], version) if table in before else store.read(layer, name, version)
        if fresh is None:
            return None
        ids.append(fresh.select("unified_id"))
    if not ids:
        return []
    keys = settle(reduce(DataFrame.unionAll, ids).distinct())[0]
    # One join for all feeds and both states: a part that was there before and is there now is met once.
    moments = reduce(DataFrame.unionAll, [
        store.every_row_of("silver", feed, {s[f"silver/{feed}"] for s in (before, now) if f"silver/{feed}" in s})
        .select("unified_id", "published_at")
        for feed in FEEDS if f"silver/{feed}" in now
    ])
    found = moments.join(keys, "unified_id", "left_semi").select(F.to_date("published_at").alias("day")).distinct()
    return [row["day"] for row in found.collect()]


def in_days(days: list[date | None]) -> Column:
    """Rows published on one of ``days``; the first and last of them prune files before the rest is tested."""
    known = [d for d in days if d is not None]
    test = F.lit(False)
    if known:
        between = (F.col("published_at") >= F.lit(min(known)).cast("timestamp")) & (
            F.col("published_at") < F.lit(max(known) + timedelta(days=1)).cast("timestamp")
        )
        test = between & F.to_date("published_at").isin(known)
    return test | F.col("published_at").isNull() if None in days else test


def combined_where(store: TableStore, versions: dict[str, int], condition: Column | None) -> DataFrame:
    """The combined Silver rows of one state that fulfil ``condition``."""
    tables = [
        store.read("silver", feed, versions[f"silver/{feed}"]) if condition is None
        else store.read_where("silver", feed, condition, versions[f"silver/{feed}"])
        for feed in FEEDS if f"silver/{feed}" in versions
    ]
    at = versions.get("silver/enriched")
    return gold.combine_silver(tables, store.read("silver", "enriched", at) if at else None, kept_by_id(store))
