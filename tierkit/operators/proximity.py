"""Joins by distance on the globe: all rows within a radius, and the nearest rows.

Both work on points of the unit sphere, where a great-circle distance is a chord: there is no
date line, the poles are places like any other, and cells have the same size everywhere. Boxes
around points only choose candidates; ``haversine_distance`` of the given coordinates decides.

Rows without a place (a coordinate NULL or NaN, or a latitude beyond 90 degrees) are near nothing and
don't appear. Columns of both sides are handed through; no two may have the same name.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierkit.functions._columns import quoted
from tierkit.functions.geo import EARTH_RADIUS_MI, UNIT_FACTOR, haversine_distance
from tierkit.scratch import Scratch

HOT_CELL = 4096
BLOCK_BITS = 5
FAN_BITS = 4
TOP_NODES = 64
#: What boxes are wider than the chords, so that rounding loses no pair; some millimetres.
SLACK = 1e-9
AXES = ("x", "y", "z")


def _placed(df: DataFrame, row: str, lat: str, lon: str) -> DataFrame:
    """``row`` (all columns), ``lat``, ``lon`` and the point on the unit sphere."""
    whole = F.struct(*[F.col(quoted(c)) for c in df.columns]).alias(row)
    at = df.select(whole, *[F.col(quoted(c)).cast("double").alias(n) for c, n in ((lat, "lat"), (lon, "lon"))])
    at = at.filter("abs(lat) <= 90 AND NOT isnan(lon) AND abs(lon) < double('infinity')")
    flat, turn = F.radians("lat"), F.radians("lon")
    return at.select("*", (F.cos(flat) * F.cos(turn)).alias("x"), (F.cos(flat) * F.sin(turn)).alias("y"), F.sin(flat).alias("z"))


def _joined(left: DataFrame, right: DataFrame, *more: str) -> None:
    names = [c.lower() for c in (*left.columns, *right.columns, *more)]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"both sides, or the result, have columns named {', '.join(twice)}")


def _unit(unit: str) -> float:
    if unit not in UNIT_FACTOR:
        raise ValueError(f"unit must be one of {sorted(UNIT_FACTOR)}, got {unit!r}")
    return EARTH_RADIUS_MI * UNIT_FACTOR[unit]


def within_distance(
    left: DataFrame,
    right: DataFrame,
    radius: float,
    left_at: tuple[str, str] = ("lat", "lon"),
    right_at: tuple[str, str] = ("lat", "lon"),
    unit: str = "mi",
    distance: str = "distance",
    hot_cell: int = HOT_CELL,
) -> DataFrame:
    """Every pair of rows at most ``radius`` apart, with their ``distance``.

    Space is cut into cubes of half the radius. A right row lies in one; a left row is sent to those
    that the ball around it touches, some forty, so pairs meet in one join on equal cells, and every second
    pair that meets is near. Pass the smaller table as ``left``. A cell with more than ``hot_cell`` right
    rows is dealt out evenly: its right rows go to one part each, the left rows that touch it to all, so
    no task holds a crowded cell. The join has as many tasks as ``spark.sql.shuffle.partitions`` says,
    since its work grows with the pairs and not with the bytes that it reads.
    """
    _joined(left, right, distance)
    globe = _unit(unit)
    if not radius >= 0:
        raise ValueError(f"radius must not be negative, got {radius!r}")
    reach = 2 * math.sin(min(radius / globe, math.pi) / 2) + SLACK
    side = reach / 2

    def cell(at: Column) -> Column:
        return F.floor((at + 1) / side)

    there = _placed(right, "there", *right_at)
    there = there.select("there", *(F.col(c).alias(f"{c}_to") for c in ("lat", "lon", *AXES)), *(cell(F.col(a)).alias(a) for a in AXES))
    crowded = there.groupBy(*AXES).agg(F.count("*").alias("n")).filter(F.col("n") > hot_cell)
    crowded = crowded.select(*AXES, F.ceil(F.col("n") / hot_cell).alias("parts"))
    # rows in one place are told apart by what can be hashed
    hashed = [F.col(f"there.{quoted(f.name)}") for f in right.schema if not _has_map(f.dataType)]
    part = F.pmod(F.xxhash64("lat_to", "lon_to", *hashed), F.coalesce("parts", F.lit(1)))
    there = there.join(crowded, list(AXES), "left").withColumn("part", part).drop("parts")

    here = _placed(left, "here", *left_at).withColumnsRenamed({a: f"{a}_at" for a in AXES})
    gap = F.lit(0.0)
    for a in AXES:
        at = F.col(f"{a}_at")
        here = here.withColumn(a, F.explode(F.sequence(cell(at - reach), cell(at + reach))))
        low = F.col(a) * side - 1
        off = F.greatest(low - at, at - low - side, F.lit(0.0))
        gap += off * off
        # cells beyond the ball; rounding is far below the slack
        here = here.filter(gap <= (reach + SLACK) ** 2)
    here = here.join(crowded, list(AXES), "left")
    here = here.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")

    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    here, there = (side.repartition(tasks, *AXES, "part") for side in (here, there))
    chord = sum(((F.col(f"{a}_at") - F.col(f"{a}_to")) * (F.col(f"{a}_at") - F.col(f"{a}_to")) for a in AXES), F.lit(0.0))
    apart = haversine_distance("lat", "lon", "lat_to", "lon_to", unit)
    # the chord spares most pairs that are not near the distance itself
    pairs = here.join(there, [*AXES, "part"]).filter(chord <= (reach + SLACK) ** 2)
    pairs = pairs.withColumn("apart", apart).filter(F.col("apart") <= radius)
    return pairs.select("here.*", "there.*", F.col("apart").alias(distance))


def _has_map(kind) -> bool:
    return "map<" in kind.simpleString() or "variant" in kind.simpleString()


def _code() -> Column:
    """Place on a curve through space: 20 bits of each coordinate, interleaved."""
    # Masks that leave every third bit when a number is spread in five steps.
    masks = (0x1F00000000FFFF, 0x1F0000FF0000FF, 0x100F00F00F00F00F, 0x10C30C30C30C30C3, 0x1249249249249249)
    out = F.lit(0).cast("long")
    for turn, axis in enumerate(AXES):
        v = F.floor((F.col(axis) + 1) / 2 * ((1 << 20) - 1))
        for shift, mask in zip((32, 16, 8, 4, 2), masks):
            v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
        out = out.bitwiseOR(F.shiftleft(v, turn))
    return out


class _Tree:
    """Points in the order of a curve through space, cut into blocks of equal numbers, and the boxes
    around blocks, around 16 blocks, and so on. A crowded place is just many blocks."""

    def __init__(self, points: DataFrame, scratch: Scratch):
        ordered = points.withColumn("code", _code()).repartitionByRange("code").sortWithinPartitions("code")
        ordered = scratch.store(ordered.drop("code").withColumn("seat", F.monotonically_increasing_id()))
        task = F.shiftright("seat", 33)
        before = F.sum("n").over(Window.orderBy("task")) - F.col("n")  # one row a task
        tasks = ordered.groupBy(task.alias("task")).agg(F.count("*").alias("n")).select("task", before.alias("before"))
        number = F.col("before") + F.col("seat").bitwiseAND((1 << 33) - 1)
        ordered = ordered.withColumn("task", task).join(tasks, "task")
        ordered = ordered.withColumn("number", number).drop("task", "before", "seat")
        self.points = ordered.withColumn("node", F.shiftright("number", BLOCK_BITS))
        #: from the blocks up; the last level has ``TOP_NODES`` nodes at most, below one root, node -1
        self.levels = []
        boxes = [f(a).alias(f"{name}_{a}") for a in AXES for f, name in ((F.min, "low"), (F.max, "high"))]
        level = self.points.groupBy("node").agg(F.count("*").alias("n"), *boxes)
        while True:
            level = scratch.store(level)
            if level.count() <= TOP_NODES:
                break
            self.levels.append(level.withColumn("parent", F.shiftright("node", FAN_BITS)))
            boxes = [f(f"{name}_{a}").alias(f"{name}_{a}") for a in AXES for f, name in ((F.min, "low"), (F.max, "high"))]
            level = level.groupBy(F.shiftright("node", FAN_BITS).alias("node")).agg(F.sum("n").alias("n"), *boxes)
        self.levels.append(level.withColumn("parent", F.lit(-1).cast("long")))

    def children(self, height: int, side: str) -> DataFrame | None:
        """Nodes of a height as columns of a side; None above the top."""
        if height >= len(self.levels):
            return None
        return self.levels[height].select(*[F.col(c).alias(f"{side}_{c}") for c in self.levels[height].columns])


def _chords() -> tuple[Column, Column]:
    """Least and greatest chord between the boxes of two nodes."""
    low = high = F.lit(0.0)
    for a in AXES:
        ahead = F.col(f"r_low_{a}") - F.col(f"l_high_{a}")
        behind = F.col(f"l_low_{a}") - F.col(f"r_high_{a}")
        gap = F.greatest(ahead, behind, F.lit(0.0))
        span = F.greatest(F.col(f"r_high_{a}") - F.col(f"l_low_{a}"), F.col(f"l_high_{a}") - F.col(f"r_low_{a}"))
        low, high = low + gap * gap, high + span * span
    return F.sqrt(low), F.sqrt(high)


def _within_bounds(pairs: DataFrame, left: str, k: int) -> DataFrame:
    """Pairs that may hold one of the ``k`` nearest: the boxes that surely hold ``k`` bound the rest, and so
    does ``cap``, a bound known before, if there is one; what that rules out is not shuffled."""
    low, high = _chords()
    pairs = pairs.withColumns({"low": low, "high": high}).filter(F.col("cap").isNull() | (F.col("low") <= F.col("cap") + SLACK))
    of_left = Window.partitionBy(left)
    held = F.sum("r_n").over(of_left.orderBy("high", "r_node").rowsBetween(Window.unboundedPreceding, 0))
    pairs = pairs.withColumn("held", held)
    bound = F.least(F.min(F.when(F.col("held") >= k, F.col("high"))).over(of_left), "cap")
    return pairs.withColumn("bound", bound).filter(F.col("bound").isNull() | (F.col("low") <= F.col("bound") + SLACK))


def _in_reach(pairs: DataFrame, near: _Tree, far: _Tree, k: int) -> DataFrame:
    """``lat, lon, lat_to, lon_to, there``: pairs of rows that may be among the ``k`` nearest, from pairs
    ``l, r`` of blocks; ``first`` are the right blocks that surely hold ``k`` for the left one."""

    def chord(one: Callable[[str], Column], two: Callable[[str], Column]) -> Column:
        return F.sqrt(sum(((one(a) - two(a)) * (one(a) - two(a)) for a in AXES), F.lit(0.0)))

    here = near.points.select(F.col("node").alias("l"), "number", "lat", "lon", *AXES)
    places = far.points.select(F.col("node").alias("r"), F.struct(*AXES).alias("place"))
    firsts = pairs.filter("first").join(places, "r").groupBy("l").agg(F.collect_list("place").alias("places"))
    chords = F.transform("places", lambda place: chord(F.col, place.getField))
    here = here.join(firsts, "l").withColumn("cap", F.get(F.sort_array(chords), F.lit(k - 1))).drop("places")

    # each row is a box of its own against the blocks that its block has left
    own = [F.col(a).alias(f"l_{name}_{a}") for a in AXES for name in ("low", "high")]
    found = pairs.select("l", "r").join(here.select("l", "number", "lat", "lon", "cap", *own), "l").drop("l")
    found = found.join(far.children(0, "r"), F.col("r") == F.col("r_node"))
    place = [F.col(f"l_low_{a}").alias(f"{a}_at") for a in AXES]
    found = _within_bounds(found, "number", k).select("lat", "lon", "r", "bound", *place)
    there = [F.col(c).alias(f"{c}_to") for c in ("lat", "lon", *AXES)]
    found = found.join(far.points.select(F.col("node").alias("r"), "there", *there), "r")
    apart = chord(lambda a: F.col(f"{a}_at"), lambda a: F.col(f"{a}_to"))
    # before the ranking, whose sort would else hold every row of every block
    return found.filter(F.col("bound").isNull() | (apart <= F.col("bound") + SLACK))


def nearest(
    left: DataFrame,
    right: DataFrame,
    k: int,
    order_by: Sequence[str],
    left_at: tuple[str, str] = ("lat", "lon"),
    right_at: tuple[str, str] = ("lat", "lon"),
    unit: str = "mi",
    distance: str = "distance",
    rank: str = "rank",
    scratch: Scratch | None = None,
) -> DataFrame:
    """For every left row the ``k`` nearest right rows, fewer if there are fewer, with ``distance`` and ``rank``.

    Distances that agree in six decimals are equal; the right side's ``order_by`` decides among those.

    Both sides become trees of boxes, in blocks of equal numbers however crowded a place is. Pairs
    of boxes are opened level by level: the right boxes of a left box that surely hold ``k`` rows
    bound its distance, and what begins beyond the bound goes. In the end a row is a box itself, and
    meets the rows of the few blocks that it has left. The right rows that surely are ``k`` for its
    block cap its distance beforehand, and only rows within that are ranked, hardly more than ``k``. Left
    rows in one place are looked up once, and of right rows in one place the first ``k`` are enough. Tables of the search are kept in ``scratch``; without one they
    stay until the process ends.
    """
    _joined(left, right, distance, rank)
    _unit(unit)
    if k < 1:
        raise ValueError(f"k must be at least 1, got {k!r}")
    scratch = scratch or Scratch(left.sparkSession)
    here = _placed(left, "here", *left_at)
    there = _placed(right, "there", *right_at)
    ties = [F.asc_nulls_last(f"there.{quoted(c)}") for c in order_by]
    # a group limit before the shuffle: a crowded place sends k rows a task
    first = F.row_number().over(Window.partitionBy("lat", "lon").orderBy(*ties))
    there = there.withColumn("first", first).filter(F.col("first") <= k).drop("first")
    spots = here.select("lat", "lon", *AXES).dropDuplicates(["lat", "lon"])
    near, far = _Tree(spots, scratch), _Tree(there, scratch)

    pairs = left.sparkSession.range(1).select(*[F.lit(-1).cast("long").alias(s) for s in ("l", "r")], F.lit(None).cast("double").alias("cap"))
    for height in reversed(range(max(len(near.levels), len(far.levels)))):
        opened = {"l": near.children(height, "l"), "r": far.children(height, "r")}
        for side, nodes in opened.items():
            if nodes is not None:
                pairs = pairs.join(nodes, F.col(side) == F.col(f"{side}_parent")).drop(side)
        # the root of a lower tree waits for its turn
        ends = [F.col(s if nodes is None else f"{s}_node").alias(s) for s, nodes in opened.items()]
        if None not in opened.values():
            # the bound of a box holds for those inside it
            pairs = _within_bounds(pairs, "l_node", k).withColumn("cap", F.col("bound"))
            ends.append((F.col("held") - F.col("r_n") < k).alias("first"))
        pairs = scratch.store(pairs.select(*ends, "cap"))

    found = _in_reach(pairs, near, far, k)
    apart = haversine_distance("lat", "lon", "lat_to", "lon_to", unit)
    found = found.select("lat", "lon", "there", apart.alias("apart"))
    order = Window.partitionBy("lat", "lon").orderBy(F.round("apart", 6), *ties)
    found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    rows = here.select("here", "lat", "lon").join(found, ["lat", "lon"])
    return rows.select("here.*", "there.*", F.col("apart").alias(distance), F.col("rank").alias(rank))
