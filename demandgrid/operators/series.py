"""Row windows over series, also where one series holds a large part of all rows.

Normally one exchange and one sort on the series serve all lag and rolling features. A series longer than
``limit`` rows would put its whole history into one task; its rows get their exact position first, are cut into
blocks by position, and every block carries the rows before it that its frames reach.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, WindowSpec, functions as F

from .. import constants as k
from ..session import keep
from .ordered import rolling_frames
from .ranks import running_start

Features = Callable[[WindowSpec], dict[str, Column]]


@dataclass(frozen=True)
class Rolling:
    """Measures of ``value`` over the last rows of its series: kind and rows by column name."""
    value: str
    names: dict[str, tuple[str, int]]
    closed: str = "right"


def _order(df: DataFrame, time: str, tie: list[str]) -> DataFrame:
    """``_at``: microseconds, NULL last. ``_tie``: settles equal times the same way in every run."""
    if "timestamp" in df.schema[time].dataType.typeName() or df.schema[time].dataType.typeName() == "date":
        at = F.unix_micros(F.col(time).cast("timestamp"))
    else:
        at = F.col(time).cast("bigint")
    return df.withColumns({"_at": F.coalesce(at, F.lit(2**63 - 1)), "_tie": F.xxhash64(*[F.col(c) for c in tie])})


def positions(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows packed by equality, with ``_copies`` and the 0-based ``_first`` position in their series.

    Exact copies are counted before the shuffle. Positions come from three levels of running totals, per day of
    a series, per time and hash lane of a day, and per row of a lane, so no group holds the whole series.
    """
    day, lane = F.floor(F.col("_at") / 86_400_000_000).alias("_day"), F.shiftright("_tie", 56).alias("_lane")
    packed = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies")).select("*", day, lane)
    per_lane = packed.groupBy(*keys, "_day", "_at", "_lane").agg(F.sum("_copies").alias("_n"))
    per_day = per_lane.groupBy(*keys, "_day").agg(F.sum("_n").alias("_n"))

    def start(partition, order, amount):
        frame = W.partitionBy(*partition).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
        return F.coalesce(F.sum(amount).over(frame), F.lit(0))

    day_start = per_day.select(*keys, "_day", start(keys, ["_day"], "_n").alias("_d"))
    lane_start = per_lane.select(*keys, "_day", "_at", "_lane", start([*keys, "_day"], ["_at", "_lane"], "_n").alias("_l"))
    spot = [*keys, "_day", "_at", "_lane"]
    return (packed.join(lane_start, spot).join(day_start, [*keys, "_day"])
            .withColumn("_first", F.col("_d") + F.col("_l") + start(spot, ["_tie"], "_copies"))
            .drop("_day", "_lane", "_d", "_l"))


def _blocks(df: DataFrame, keys: list[str], rows: int, reach: int) -> DataFrame:
    """Rows with ``_pos`` and ``_block``; a block also holds the ``reach`` rows before its first."""
    packed = positions(df, keys)
    first, last = F.col("_first"), F.col("_first") + F.col("_copies") - 1
    spread = packed.withColumn("_block", F.explode(F.sequence(F.floor(first / rows), F.floor((last + reach) / rows))))
    begin = F.greatest(first, F.col("_block") * rows - reach)
    end = F.least(last, (F.col("_block") + 1) * rows - 1)
    return (spread.repartition(*keys, "_block")
            .withColumn("_pos", F.explode(F.sequence(begin, end))).drop("_first", "_copies"))


def over_series(df: DataFrame, features: Features, reach: int, keys: list[str] = k.SERIES, time: str = k.TIME,
                tie: list[str] | None = None, limit: int = 1_000_000, block: int = 250_000,
                position: str | None = None, lengths: DataFrame | None = None, rolling: Rolling | None = None) -> DataFrame:
    """Add the window columns that ``features`` builds from a spec ordered by time within each series.

    ``rolling`` adds measures over sliding frames on the same exchange and sort.

    ``reach`` is how many earlier rows the frames look back. ``position`` also adds the 0-based place of the
    row in its series under that name. Rows without a complete key belong to no series: they get NULL.
    ``lengths`` is a table of the keys and ``n_rows`` if there is one already; else the rows are counted first.
    """
    columns = list(df.columns)
    # rows at one time are ordered by all they hold, so that blocks and lanes settle ties alike in every run
    ordered = _order(df, time, tie or [f.name for f in df.schema if not f.dataType.typeName() == "map"])
    complete = F.lit(True)
    for c in keys:
        complete = complete & F.col(c).isNotNull()
    # rows outside any series are spread out so that they form no large group
    loose = F.when(~complete, F.pmod("_tie", F.lit(1024))).otherwise(F.lit(-1))

    def finish(frame: DataFrame, spec: WindowSpec, place: Column, groups: list[str], order: list[str]) -> DataFrame:
        added = dict(features(spec))
        if position:
            added[position] = place
        helpers = dict.fromkeys([*(["_loose", "_block"] if rolling else []), *(order if rolling else []), "_pos", "_block"])
        frame = frame.select(*columns, *[F.when(complete, c).alias(n) for n, c in added.items()], *[c for c in helpers if c in frame.columns])
        if rolling:
            if not added:
                frame = frame.repartition(*groups)
            frame = rolling_frames(frame, groups, order, rolling.value, rolling.names, rolling.closed)
            frame = frame.withColumns({n: F.when(complete, F.coalesce(n, F.lit(0.0)) if kind == "std" else F.col(n)) for n, (kind, _) in rolling.names.items()})
        return frame.drop("_loose", "_at", "_tie")

    def plain(part: DataFrame) -> DataFrame:
        keyed = part.withColumn("_loose", loose)
        spec = W.partitionBy(*keys, "_loose").orderBy("_at", "_tie")
        return finish(keyed, spec, F.row_number().over(spec).cast("bigint") - 1, [*keys, "_loose"], ["_at", "_tie"])

    # held, so that Spark knows its true size and picks the join for it
    if lengths is None:
        lengths = df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    long = keep(lengths.dropna(subset=keys).filter(F.col("n_rows") > limit).select(*keys))
    if long.count() == 0:
        return plain(ordered)

    rows = max(block, reach + 1)
    long_rows = _blocks(ordered.join(long, keys, "left_semi"), keys, rows, reach)
    spec = W.partitionBy(*keys, "_block").orderBy("_pos")
    cut = (finish(long_rows, spec, F.col("_pos"), [*keys, "_block"], ["_pos"])
           .filter(F.col("_pos") >= F.col("_block") * rows).drop("_pos", "_block"))
    return plain(ordered.join(long, keys, "left_anti")).unionByName(cut)


def global_position(df: DataFrame, name: str, keys: list[str] = k.SERIES, position: str = "_place") -> DataFrame:
    """Place of a row in the order of store, product and time over the whole table; NULL without a complete key.

    ``df`` carries the place in the series as ``position``. Rows per store are totalled across value ranges of
    the store id, rows per product within the store.
    """
    return df.join(series_starts(df, keys).drop("_n"), keys, "left").withColumn(name, F.col("_start") + F.col(position)).drop("_start")


def series_starts(df: DataFrame, keys: list[str] = k.SERIES) -> DataFrame:
    """For every series its rows ``_n`` and the place ``_start`` of its first one in the order of store and product."""
    outer, inner = keys
    per_series = df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    store_start = running_start(per_series.groupBy(outer).agg(F.sum("_n").alias("_n")), outer, "_n", "_outer").drop("_n")
    before = W.partitionBy(outer).orderBy(inner).rowsBetween(W.unboundedPreceding, -1)
    return (per_series.withColumn("_inner", F.coalesce(F.sum("_n").over(before), F.lit(0))).join(store_start, outer)
            .withColumn("_start", F.col("_outer") + F.col("_inner")).drop("_outer", "_inner"))


def parts_at(df: DataFrame, places: list[int], name: str, keys: list[str] = k.SERIES, time: str = k.TIME) -> DataFrame:
    """The contiguous part of every row where the order of store, product and time is cut at ``places`` (ascending): how many of
    them do not lie beyond the row. NULL without a complete key.

    Only the few series that hold a cut are looked into. All rows are then compared with the rows at the cuts, so they are neither
    shuffled nor sorted. Of equal rows on both sides of a cut, as many as belong before it come before it.
    """
    ordered = _order(df, time, [f.name for f in df.schema if not f.dataType.typeName() == "map"])
    starts = series_starts(df.select(*keys), keys)
    holding = F.lit(False)
    for p in places:
        holding = holding | ((F.col("_start") <= p) & (F.col("_start") + F.col("_n") > p))
    held = starts.filter(holding).collect()
    complete, found = F.lit(True), {}
    for c in keys:
        complete = complete & F.col(c).isNotNull()
    if held:
        few = df.sparkSession.createDataFrame([tuple(r[c] for c in [*keys, "_start"]) for r in held], starts.select(*keys, "_start").schema)
        inside = positions(ordered.join(few.select(*keys), keys, "left_semi").select(*keys, "_at", "_tie"), keys).join(few, keys)
        for p in places:
            first = F.col("_start") + F.col("_first")
            inside = inside.withColumn(f"_skip_{p}", F.when((first <= p) & (first + F.col("_copies") > p), p - first))
        cuts = [f"_skip_{p}" for p in dict.fromkeys(places)]
        for r in inside.filter(F.coalesce(*cuts).isNotNull()).collect():
            found |= {p: (*(r[c] for c in [*keys, "_at", "_tie"]), r[f"_skip_{p}"]) for p in places if r[f"_skip_{p}"] is not None}

    def beyond(cut: tuple, equal: Column) -> Column:
        """Whether a row lies at or behind the row at a cut; the tie is looked at only where all else is equal."""
        for c, v in reversed(list(zip([*keys, "_at", "_tie"], cut))):
            equal = F.when(F.col(c) == v, equal).otherwise(F.col(c) > v)
        return equal

    def part(copy: Column) -> Column:
        # a place beyond the last row cuts nothing off
        ends = [beyond(found[p], copy >= found[p][-1]).cast("int") for p in places if p in found]
        return F.when(complete, sum(ends, F.lit(0)))

    torn = [cut for cut in found.values() if cut[-1]]
    if not torn:
        return ordered.withColumn(name, part(F.lit(0))).select(*df.columns, name)
    split = F.lit(False)
    for cut in torn:
        same = complete
        for c, v in zip([*keys, "_at", "_tie"], cut):
            same = same & (F.col(c) == v)
        split = split | same
    split = F.coalesce(split, F.lit(False))
    spot = [*keys, "_at", "_tie"]
    packed = ordered.filter(split).groupBy(*ordered.columns).agg(F.count(F.lit(1)).alias("_copies"))
    before = W.partitionBy(*spot).orderBy(F.xxhash64(*df.columns)).rowsBetween(W.unboundedPreceding, -1)
    copies = (packed.withColumn("_before", F.coalesce(F.sum("_copies").over(before), F.lit(0)))
              .withColumn("_copy", F.explode(F.sequence(F.col("_before"), F.col("_before") + F.col("_copies") - 1))))
    return (ordered.filter(~split).withColumn(name, part(F.lit(0))).select(*df.columns, name)
            .unionByName(copies.withColumn(name, part(F.col("_copy"))).select(*df.columns, name)))
