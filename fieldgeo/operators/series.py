"""Ordered-series operators. Each works within `by` groups (a flight, a run), so that groups are independent tasks."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import workers
from ..functions import geodesy
from ..functions.matching import match


BLOCK_STEPS = 1000  # grid steps that are exploded from one row


def _w(by: Sequence[str] | str, *order):
    return Window.partitionBy(*([by] if isinstance(by, str) else by)).orderBy(*order)


def segment_by_flag(df: DataFrame, flag: str, order: str, by: str, out: str = "segment") -> DataFrame:
    """A segment number from 1 on rows where flag is set, a new one each time it turns on; null elsewhere."""
    on = F.coalesce(F.col(flag), F.lit(False))
    starts = df.withColumn("__start", (on & ~F.coalesce(F.lag(on).over(_w(by, order)), F.lit(False))).cast("int"))
    number = F.sum("__start").over(_w(by, order).rowsBetween(Window.unboundedPreceding, 0))
    return starts.withColumn(out, F.when(on, number)).drop("__start")


def deltas(df: DataFrame, columns: Sequence[str], order: str, by: str) -> DataFrame:
    """d_<column>: the difference to the row before, null on the first."""
    return df.withColumns({f"d_{c}": F.col(c) - F.lag(c).over(_w(by, order)) for c in columns})


def interpolate_grid(df: DataFrame, by: str = "flight_id", ts: str = "ts_ms", values: Sequence[str] = ("lat", "lon", "alt"), flag: str = "recording", step_ms: int = 10, segment: str | None = None) -> DataFrame:
    """Recording rows, and rows on a step_ms grid linearly between each of them and the row before (recording or not).

    Columns: by, ts, values, interpolated, and segment if given. Gaps of step_ms or less get no grid rows; a grid time equal
    to a row's own time isn't repeated. Each gap's grid is exploded from its two ends alone, in blocks of BLOCK_STEPS steps
    first, so that no row holds more than a block or the list of a gap's blocks.
    """
    w = _w(by, ts)
    before = {c: F.lag(c).over(w) for c in (ts, *values)}
    linked = df.withColumns({f"__p_{c}": v for c, v in before.items()}).where(F.coalesce(F.col(flag), F.lit(False)))
    keep = [by, *([segment] if segment else [])]
    own = linked.select(*keep, ts, *values, F.lit(False).alias("interpolated"))
    first = (F.floor(F.col(f"__p_{ts}") / step_ms) + 1) * step_ms
    last = (F.ceil(F.col(ts) / step_ms) - 1) * step_ms
    gaps = linked.where((F.col(ts) - F.col(f"__p_{ts}") > step_ms) & (first <= last)).withColumn("__b", F.explode(F.sequence(first, last, F.lit(step_ms * BLOCK_STEPS).cast("long"))))
    gaps = gaps.withColumn("__t", F.explode(F.sequence(F.col("__b"), F.least(F.col("__b") + (BLOCK_STEPS - 1) * step_ms, last), F.lit(step_ms).cast("long"))))
    share = (F.col("__t") - F.col(f"__p_{ts}")) / (F.col(ts) - F.col(f"__p_{ts}"))
    grid = gaps.select(*keep, F.col("__t").alias(ts), *[(F.col(f"__p_{c}") + (F.col(c) - F.col(f"__p_{c}")) * share).alias(c) for c in values], F.lit(True).alias("interpolated"))
    return own.unionByName(grid)


def frame_times(frames: DataFrame, segments: DataFrame, by: Sequence[str], index: str = "i") -> DataFrame:
    """ts_ms of the frame with index i (from 0) in its segment: start_ms + i * duration_ms / frames, rounded down."""
    rate = frame_rate(frames, segments, by)
    joined = frames.join(rate, list(by))
    return joined.withColumn("ts_ms", F.floor(F.col("start_ms") + F.col(index) * F.col("interval_ms")).cast("long"))


def segment_durations(df: DataFrame, by: Sequence[str] = ("flight_id", "segment"), ts: str = "ts_ms") -> DataFrame:
    """start_ms, end_ms and duration_ms of each segment; rows without one are left out."""
    rows = df.where(F.col(by[-1]).isNotNull())
    return rows.groupBy(*by).agg(F.min(ts).alias("start_ms"), F.max(ts).alias("end_ms"), (F.max(ts) - F.min(ts)).alias("duration_ms"))


def frame_rate(frames: DataFrame, segments: DataFrame, by: Sequence[str]) -> DataFrame:
    """Of each segment: n_frames, interval_ms = duration / frames, frames_per_s = 1000 / interval."""
    n = frames.groupBy(*by).agg(F.count("*").alias("n_frames"))
    interval = F.col("duration_ms") / F.col("n_frames")
    return segments.join(n, list(by)).withColumn("interval_ms", interval).withColumn("frames_per_s", F.when(interval > 0, 1000 / interval))


SLICE_ROWS = 2_000_000  # rows of a group that as-of joins put into one task, about
CELLS_EACH, MOST_CELLS = 16, 4096  # cells of time that a slice is put together from, and those that anything is cut into at most


def _cell(lo: str = "__lo", width: str = "__width", cells: str = "__cells") -> Column:
    """The cell that __at lies in, of equal ones from lo on."""
    return F.greatest(F.lit(0), F.least(F.floor((F.col("__at") - F.col(lo)) / F.col(width)), F.col(cells) - 1)).cast("int")


def _slice_table(rows: DataFrame, by: str, slice_rows: int) -> DataFrame:
    """(by, __lo, __width, __cells, __slices) of groups of over slice_rows rows (by, __at): what slice each of a group's equal cells of time is in.

    Cells are counted and put together in order until a slice has its rows; a cell of more than slice_rows (a burst after long
    gaps) is cut into equal cells again. The table has a row for each large group, so at most rows / slice_rows rows, each with some 16
    numbers for each slice_rows of its rows.
    """
    cells = lambda n: F.least(F.lit(MOST_CELLS), CELLS_EACH * F.ceil(F.col(n) / slice_rows)).cast("int")
    before = lambda *keys: F.coalesce(F.sum("__k").over(_w(keys[:-1], keys[-1]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    big = rows.groupBy(by).agg(F.count("*").alias("__n"), F.min("__at").alias("__lo"), F.max("__at").alias("__hi")).where((F.col("__n") > slice_rows) & (F.col("__hi") > F.col("__lo")))
    big = big.withColumn("__cells", cells("__n")).select(by, "__lo", "__cells", ((F.col("__hi") - F.col("__lo")) / F.col("__cells")).alias("__width"))
    group = [by, "__lo", "__cells", "__width"]
    met = rows.join(F.broadcast(big), by).withColumn("__c", _cell())
    empty = big.select(*group, F.explode(F.sequence(F.lit(0), F.col("__cells") - 1)).alias("__c"), F.lit(0).alias("__k"))
    counts = met.select(*group, "__c", F.lit(1).alias("__k")).unionAll(empty).groupBy(*group, "__c").agg(F.sum("__k").alias("__k"))
    counts = counts.withColumn("__s", F.floor(before(by, "__c") / slice_rows) * (2 * MOST_CELLS))
    heavy = counts.where(F.col("__k") > slice_rows).select(by, "__c", cells("__k").alias("__parts"), (F.col("__lo") + F.col("__c") * F.col("__width")).alias("__from"), F.col("__width").alias("__cell"))
    heavy = heavy.select(by, "__c", "__parts", "__from", (F.col("__cell") / F.col("__parts")).alias("__step"))
    part = [by, "__c", "__parts", "__from", "__step"]
    inner = met.select(by, "__c", "__at").join(F.broadcast(heavy), [by, "__c"]).select(*part, _cell("__from", "__step", "__parts").alias("__p"), F.lit(1).alias("__k"))
    empty = heavy.select(*part, F.explode(F.sequence(F.lit(0), F.col("__parts") - 1)).alias("__p"), F.lit(0).alias("__k"))
    inner = inner.unionAll(empty).groupBy(*part, "__p").agg(F.sum("__k").alias("__k")).withColumn("__i", F.floor(before(by, "__c", "__p") / slice_rows).cast("int"))
    subs = inner.groupBy(by, "__c").agg(F.transform(F.array_sort(F.collect_list(F.struct("__p", "__i"))), lambda x: x["__i"]).alias("__subs"))
    return counts.join(subs, [by, "__c"], "left").groupBy(*group).agg(F.array_sort(F.collect_list(F.struct("__c", "__s", "__subs"))).alias("__slices"))


def _slice() -> Column:
    """The slice of __at by its group's row of the table; null where the group has none."""
    cell = F.get("__slices", _cell())
    parts = F.size(cell["__subs"])
    within = F.greatest(F.lit(0), F.least(F.floor((F.col("__at") - F.col("__lo") - cell["__c"] * F.col("__width")) / (F.col("__width") / parts)), parts - 1)).cast("int")
    return cell["__s"] + F.when(cell["__subs"].isNotNull(), F.get(cell["__subs"], within)).otherwise(F.lit(0))


def _has_large(rows: DataFrame, by: str, slice_rows: int) -> bool:
    """Whether any group has over slice_rows rows; a job over the groups' column alone."""
    return not rows.where(F.col(by).isNotNull()).groupBy(by).agg(F.count("*").alias("__n")).where(F.col("__n") > slice_rows).isEmpty()


def _merged(left: DataFrame, right: DataFrame, on: str, by: str, payload: Sequence[str], shift: int, carry: Sequence[str], slice_rows: int, sizes: DataFrame | None = None) -> DataFrame:
    """Both sides' keys in one frame: probes with all their columns, keys with their payload in one struct, each with its slice.

    Keys without a time or group take no part. Probes without one get slices of their own, a number below 0 for each task they come
    from, in which there are no keys. carry: 'next' gives each slice of a large group also the first key after it, 'last' the last one
    before it, found by a scan over the slices' ends.
    """
    probes = left.select(by, on, F.lit(1).alias("__probe"), F.struct(*left.columns).alias("__row"), F.lit(None).cast(right.select(F.struct(on, *payload).alias("x")).schema[0].dataType).alias("__key"))
    keys = right.where(F.col(on).isNotNull() & F.col(by).isNotNull()).select(by, on, F.lit(0).alias("__probe"), F.lit(None).cast(probes.schema["__row"].dataType).alias("__row"), F.struct(on, *payload).alias("__key"))
    both = probes.unionByName(keys).withColumn("__place", F.col(on) + F.when(F.col("__probe") == 1, F.lit(shift)).otherwise(F.lit(0)))
    timed = F.col(by).isNotNull() & F.col("__place").isNotNull()
    alone = -1 - F.spark_partition_id()
    if not _has_large(left.select(by).unionAll(right.select(by)) if sizes is None else sizes.select(by), by, slice_rows):
        return both.withColumn("__slice", F.when(timed, F.lit(0)).otherwise(alone).cast("long"))
    both = both.withColumn("__at", F.col("__place").cast("double"))
    table = _slice_table(both.where(timed).select(by, "__at"), by, slice_rows)
    slices = both.join(F.broadcast(table), by, "left").withColumn("__large", F.col("__slices").isNotNull() & F.col("__at").isNotNull())
    number = F.when(~timed, alone.cast("long")).otherwise(F.coalesce(_slice(), F.lit(0)))
    slices = slices.withColumn("__slice", number).drop("__lo", "__width", "__cells", "__slices", "__at")
    key_place = F.when(F.col("__probe") == 0, F.col("__place"))
    ends = slices.where("__large").groupBy(by, "__slice").agg(F.min_by("__key", key_place).alias("__first"), F.max_by("__key", key_place).alias("__last"))
    before = lambda order: Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    carried = {"next": F.last("__first", ignorenulls=True).over(before(F.desc("__slice"))), "last": F.last("__last", ignorenulls=True).over(before(F.asc("__slice")))}
    out = slices.drop("__large")
    for name in carry:
        found = ends.select(by, "__slice", carried[name].alias("__key")).where("__key is not null")
        empty = {"__probe": F.lit(0), "__row": F.lit(None).cast(probes.schema["__row"].dataType), "__place": F.col(f"__key.{on}"), on: F.col(f"__key.{on}")}
        out = out.unionByName(found.withColumns(empty))
    return out


def _probes(df: DataFrame, left: DataFrame, right_on: str, payload: Sequence[str], on: str) -> DataFrame:
    rows = df.where("__probe = 1")
    match = F.col("__match")
    return rows.select(*[F.col(f"__row.{c}").alias(c) for c in left.columns], match[on].alias(right_on), *[match[c].alias(c) for c in payload], F.abs(match[on] - F.col(f"__row.{on}")).alias("delta"))


def asof_forward(left: DataFrame, right: DataFrame, on: str, by: str, payload: Sequence[str] = (), strict: bool = False, shift: int = 0, slice_rows: int = SLICE_ROWS, sizes: DataFrame | None = None) -> DataFrame:
    """Each left row with the first right key at or after it (strict: after on + shift): match_<on>, payload, delta.

    Null where no key follows, and for rows whose time or group is null; keys without one match nothing. Of keys at one time any
    is taken. `on` is a number; payload names must not be left's. Groups of over slice_rows rows are cut into slices of time of about so
    many rows each, so that a task holds one slice: union, and one window over (by, slice), read from its end so that the frame only grows.
    Whether there are such groups is counted first, in both sides or, where those are dear to compute, in the rows of `sizes`.
    """
    both = _merged(left, right, on, by, payload, shift, ["next"], slice_rows, sizes)
    # at equal times a key must stand after the probe that may take it, and before one that may not
    tie = F.col("__probe") if strict else 1 - F.col("__probe")
    w = Window.partitionBy(by, "__slice").orderBy(F.desc("__place"), F.desc("__tie")).rowsBetween(Window.unboundedPreceding, 0)
    both = both.withColumn("__tie", tie).withColumn("__match", F.last("__key", ignorenulls=True).over(w))
    return _probes(both, left, f"match_{on}", payload, on)


def asof_nearest(left: DataFrame, right: DataFrame, on: str, by: str, payload: Sequence[str] = (), slice_rows: int = SLICE_ROWS, sizes: DataFrame | None = None) -> DataFrame:
    """Each left row with the right key nearest to it, the earlier one if two are as near. Nulls and slices as in asof_forward."""
    both = _merged(left, right, on, by, payload, 0, ["next", "last"], slice_rows, sizes).withColumn("__tie", F.col("__probe"))
    so_far = lambda *order: Window.partitionBy(by, "__slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = F.last("__key", ignorenulls=True).over(so_far(on, "__tie"))
    after = F.last("__key", ignorenulls=True).over(so_far(F.desc(on), F.desc("__tie")))  # read from the end, so that the frame only grows
    both = both.withColumns({"__before": before, "__after": after})
    nearer = F.col("__after").isNotNull() & (F.col("__before").isNull() | (F.col("__after")[on] - F.col(on) < F.col(on) - F.col("__before")[on]))
    return _probes(both.withColumn("__match", F.when(nearer, F.col("__after")).otherwise(F.col("__before"))), left, f"match_{on}", payload, on)


def zip_by_order(images: DataFrame, events: DataFrame, by: str, image_order: str, event_order: str) -> DataFrame:
    """The i-th image with the i-th event of the same group, and status: matched, fewer images (those keep no event), or more images.

    Columns: by, i (from 1), images' and events' other columns, status. Only groups whose counts agree are zipped.
    """
    number = lambda df, order: df.withColumn("i", F.row_number().over(_w(by, order)))
    count = lambda df, name: df.groupBy(by).agg(F.count("*").alias(name))
    counts = count(images, "__m").join(count(events, "__n"), by, "left").withColumn("__n", F.coalesce("__n", F.lit(0)))
    status = F.when(F.col("__m") == F.col("__n"), "matched").when(F.col("__m") < F.col("__n"), "fewer images").otherwise("more images")
    left = number(images, image_order).join(counts.select(by, status.alias("status")), by)
    right = number(events, event_order).withColumn("__status", F.lit("matched"))
    return left.join(right.withColumnRenamed("__status", "status"), [by, "i", "status"], "left")


def match_in_order(images: DataFrame, events: DataFrame, on: str, by: str, image: str, event: str) -> DataFrame:
    """(by, image, its time, event, match_<on>, delta) of each image: no event twice, both in the order of their times, the sum of time differences least.

    Within a group as many pairs are made as the shorter side has rows. Images left over, without a time or in groups without events have a null event; events
    without a time or group aren't used. Of equal sums earlier events are taken; rows at one time go by their image or event. A group is one task, whose
    memory is linear in the group's rows.
    """
    workers.ready(images.sparkSession)
    left = images.select(by, F.col(image).alias("name"), F.col(on).alias("at"))
    right = events.where(F.col(on).isNotNull() & F.col(by).isNotNull()).select(F.col(by).alias("other"), F.col(event).alias("event"), F.col(on).alias("event_at"))
    schema = T.StructType([left.schema[by], T.StructField(image, left.schema["name"].dataType), T.StructField(on, left.schema["at"].dataType), T.StructField(event, right.schema["event"].dataType), T.StructField(f"match_{on}", right.schema["event_at"].dataType)])
    names = schema.names

    def pair(rows: pa.Table, keys: pa.Table) -> pa.Table:
        rows, keys = rows.sort_by([("at", "ascending"), ("name", "ascending")]), keys.sort_by([("event_at", "ascending"), ("event", "ascending")])
        n = rows.num_rows - rows.column("at").null_count  # nulls stand last
        a, b = rows.column("at").to_numpy()[:n].astype(float), keys.column("event_at").to_numpy().astype(float)
        partner = np.full(rows.num_rows, -1)
        if n <= len(b):
            partner[:n] = match(a, b)
        else:
            partner[match(b, a)] = np.arange(len(b))
        at = pa.array(partner, mask=partner < 0)
        return pa.table([*rows.columns, keys.column("event").take(at), keys.column("event_at").take(at)], names=names)

    found = left.where(F.col(by).isNotNull()).groupBy(by).cogroup(right.groupBy("other")).applyInArrow(pair, schema)
    alone = left.where(F.col(by).isNull()).select(by, F.col("name").alias(image), F.col("at").alias(on), *[F.lit(None).cast(schema[c].dataType).alias(c) for c in (event, f"match_{on}")])
    return found.unionByName(alone).withColumn("delta", F.abs(F.col(f"match_{on}") - F.col(on)))


def zip_folders(folders: DataFrame, segments: DataFrame, by: str, folder: str = "folder", segment: str = "segment") -> DataFrame:
    """Image folders in the order of their names with recording segments in theirs: one row a folder, by as zip_by_order has it."""
    return zip_by_order(folders.select(by, folder).distinct(), segments, by, folder, segment)


def sliding(df: DataFrame, columns: Sequence[str], order: str, by: str, n: int, step: int = 1) -> DataFrame:
    """w_<column>: arrays of n successive values, from every step-th row of a group that has n rows left."""
    if not 0 < step <= n:
        raise ValueError("step must be between 1 and the window's size")
    w = _w(by, order)
    rows = df.withColumns({f"w_{c}": F.collect_list(F.struct(order, c)).over(w.rowsBetween(0, n - 1)) for c in columns} | {"__i": F.row_number().over(w) - 1})
    full = rows.where((F.size(f"w_{columns[0]}") == n) & (F.col("__i") % step == 0))
    return full.withColumns({f"w_{c}": F.col(f"w_{c}")[c] for c in columns}).drop("__i")


def heading_sign(df: DataFrame, y: str = "y", order: str = "ts_ms", by: str = "run_id", n: int = 5, offset: float = 0.24, decided_only: bool = False) -> DataFrame:
    """heading '+' or '-' and y_corrected from n rows from each on: '+' if over n / 2 of the n - 1 steps don't fall, '-' if under.

    The last n - 1 rows of a group, and rows with exactly n / 2, stay undecided (null), or go if decided_only is set.
    """
    w = _w(by, order)
    rises = df.withColumn("__up", (F.col(y) <= F.lead(y).over(w)).cast("int"))
    ups = F.sum("__up").over(w.rowsBetween(0, n - 2))
    full = F.count("__up").over(w.rowsBetween(0, n - 2)) == n - 1
    out = rises.withColumn("__ups", F.when(full, ups))
    sign = F.when(F.col("__ups") > n / 2, "+").when(F.col("__ups") < n / 2, "-")
    out = out.withColumn("heading", sign)
    if decided_only:
        out = out.where(F.col("heading").isNotNull())
    return out.withColumn("y_corrected", F.when(F.col("heading") == "+", F.col(y) + offset).when(F.col("heading") == "-", F.col(y) - offset)).drop("__up", "__ups")


def repair_clock(df: DataFrame, ms: str = "clock_ms", order: str = "seq", by: str = "run_id", bad: Column | None = None, step_ms: int = 800) -> DataFrame:
    """repaired_ms: bad stamps become the last good one plus step_ms for each row since; null before the first good one."""
    bad = F.col(ms).isNull() | (F.col(ms) == 0) if bad is None else bad
    w = _w(by, order).rowsBetween(Window.unboundedPreceding, 0)
    good = F.when(~bad, F.struct(F.col("__row").alias("row"), F.col(ms).alias("ms")))
    rows = df.withColumn("__row", F.row_number().over(_w(by, order))).withColumn("__good", F.last(good, ignorenulls=True).over(w))
    return rows.withColumn("repaired_ms", F.col("__good.ms") + (F.col("__row") - F.col("__good.row")) * step_ms).drop("__row", "__good")


def bearings(df: DataFrame, order: str = "ts_ms", by: str = "flight_id", lat: str = "lat", lon: str = "lon") -> DataFrame:
    w = _w(by, order)
    return df.withColumn("bearing", geodesy.bearing(F.lag(lat).over(w), F.lag(lon).over(w), F.col(lat), F.col(lon))).withColumn("compass", geodesy.compass(F.col("bearing")))


def first_hit(df: DataFrame, key: str, order: str, by: str) -> DataFrame:
    """The first row of each key on a group's path; rows without a key are left out."""
    ranked = df.where(F.col(key).isNotNull()).withColumn("__n", F.row_number().over(_w([by, key], order)))
    return ranked.where("__n = 1").drop("__n")


def range_segments(waypoints: DataFrame, by: str = "flight_id", seq: str = "seq", ts: str = "ts_ms", start: str = "recording_ms") -> DataFrame:
    """Odd and even waypoints as ranges: segment_id WP_aa-bb, start_ms (from the recording's start), duration_ms, up to the first time that runs back.

    The first waypoint's time is the recording's start. A range whose end is before the end of the one before it, and all
    ranges after, are left out.
    """
    w = _w(by, seq)
    timed = waypoints.withColumn("__t", F.when(F.row_number().over(w) == 1, F.col(start)).otherwise(F.col(ts)))
    paired = timed.withColumns({"__b": F.lead(seq).over(w), "__tb": F.lead("__t").over(w)}).where((F.col(seq) % 2 == 1) & F.col("__b").isNotNull())
    back = F.coalesce(F.lag("__tb").over(w), F.lit(0)) > F.col("__tb")
    kept = paired.withColumn("__back", back).withColumn("__bad", F.max(F.col("__back").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))).where("__bad = 0")
    name = F.format_string("WP_%02d-%02d", F.col(seq), F.col("__b"))
    return kept.select(by, name.alias("segment_id"), (F.col("__t") - F.col(start)).alias("start_ms"), (F.col("__tb") - F.col("__t")).alias("duration_ms"))


def range_lines(df: DataFrame, by: Sequence[str], order: str = "ts_ms", x: str = "lon", y: str = "lat", pieces: int = 1) -> DataFrame:
    """line: array of pieces + 1 points from a path's first to its last, at equal steps of the row number."""
    w = _w(by, order)
    rows = df.withColumns({"__i": F.row_number().over(w) - 1, "__n": F.count("*").over(Window.partitionBy(*by))})
    marks = F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(pieces)), lambda k: F.floor(k * (F.col("__n") - 1) / pieces)))
    picked = rows.where(F.array_contains(marks, F.col("__i").cast("long")))
    line = F.transform(F.array_sort(F.collect_list(F.struct("__i", F.col(x).alias("x"), F.col(y).alias("y")))), lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))
    return picked.groupBy(*by).agg(line.alias("line"))


def numbered(df: DataFrame, order: str, by: str, out: str = "i", start: int = 0) -> DataFrame:
    return df.withColumn(out, F.row_number().over(_w(by, order)) - 1 + start)


def ordered(df: DataFrame, order: str, by: str) -> DataFrame:
    """df sorted by group and order, by ranges of both."""
    return df.orderBy(by, order)


def every_nth(df: DataFrame, n: int, order: str, by: str) -> DataFrame:
    return numbered(df, order, by, "__i").where(F.col("__i") % n == 0).drop("__i")
