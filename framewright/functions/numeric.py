"""Column functions over numbers: bins, scaling, vectors, quaternions, rotations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quantile_edges(df: DataFrame, columns: list[str], bins: int) -> DataFrame:
    """(dim, edges): exact linear quantiles from 0 to 1 in `bins` steps, equal edges once; nulls don't count.

    Values are counted, their counts sorted by range over all tasks and added up, and the values at the ranks of the
    steps picked, two for each: no task has all distinct values.
    """
    from ..operators.sequences import global_order

    out = None
    for dim, c in enumerate(columns):
        counted = df.filter(F.col(c).isNotNull()).groupBy(F.col(c).cast("double").alias("x")).agg(F.count("*").alias("n"))
        placed = global_order(counted, ["x"], "before", "n")
        total = placed.agg(F.max(F.col("before") + F.col("n")).alias("total"))  # one row
        at = lambda i: (F.col("total") - 1) * i / bins  # noqa: E731, B023
        steps = F.array(*(F.struct(F.lit(i).alias("step"), F.floor(at(i)).alias("low"), F.ceil(at(i)).alias("high"), (at(i) - F.floor(at(i))).alias("part")) for i in range(bins + 1)))
        has = lambda rank: (rank >= F.col("before")) & (rank < F.col("before") + F.col("n"))
        picked = placed.crossJoin(F.broadcast(total)).select("x", "before", "n", F.explode(F.filter(steps, lambda s: has(s["low"]) | has(s["high"]))).alias("s"))
        low, high = (F.max(F.when(has(F.col(f"s.{side}")), F.col("x"))) for side in ("low", "high"))
        edges = picked.groupBy("s.step").agg((low + (high - low) * F.max("s.part")).alias("edge"))
        one = edges.agg(F.array_sort(F.collect_set("edge")).alias("edges")).select(F.lit(dim).alias("dim"), "edges")  # `bins` numbers
        out = one if out is None else out.unionByName(one)
    return out


def assign_bin(x: Column, edges: Column, most: int = 256) -> Column:
    """Left-closed bin; below the first edge is bin 0, from the last edge on the last bin; null where x is no number.

    `most` bounds the number of edges, each of which is one comparison.
    """
    reached = sum((F.coalesce(F.get(edges, F.lit(i)) <= x, F.lit(False)).cast("int") for i in range(most)), F.lit(0))
    place = F.least(F.greatest(reached - 1, F.lit(0)), F.size(edges) - 2)
    return F.when(x.isNotNull() & ~F.isnan(x.cast("double")), place)


def bin_middle(edges: Column, i: Column) -> Column:
    """Midpoint of a bin; 1 outside the bins."""
    return F.coalesce((F.get(edges, i) + F.get(edges, i + 1)) / 2, F.lit(1.0))


def clip(x: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))


def rescale(x: Column, low: float, high: float, new_low: float, new_high: float, margin: float = 0.0) -> Column:
    """Linear map of one range to another, clipped inside the new one by a margin."""
    y = (x - low) / (high - low) * (new_high - new_low) + new_low
    return clip(y, new_low + margin, new_high - margin)


def clip_and_scale(x: Column, low: float, high: float) -> Column:
    """[-1, 1] to [low, high]."""
    return F.lit(0.5 * (high + low)) + F.lit(0.5 * (high - low)) * clip(x, -1.0, 1.0)


def unscale(x: Column, low: float, high: float) -> Column:
    return (x - 0.5 * (high + low)) / (0.5 * (high - low))


def denormalize(x: Column, mean: Column, std: Column) -> Column:
    return x * std + mean


def dead_band(x: Column, threshold: float, signed: bool = True) -> Column:
    """Small moves are none. Unsigned, the sign isn't looked at, so every negative move is none."""
    return F.when((F.abs(x) if signed else x) < threshold, F.lit(0.0)).otherwise(x)


def binarize(x: Column) -> Column:
    return F.when(x > 0.5, 1.0).otherwise(-1.0)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Column, eps: float = 1e-6) -> Column:
    """Scaled to length one; a vector shorter than eps becomes zero."""
    n = norm(a)
    return F.transform(a, lambda x: F.when(n < eps, 0.0).otherwise(x / n))


def angle(a: Column, b: Column) -> Column:
    return F.acos(clip(dot(unit(a), unit(b)), -1.0, 1.0))


def wxyz_to_xyzw(q: Column) -> Column:
    return F.concat(F.slice(q, 2, 3), F.slice(q, 1, 1))


def xyzw_to_wxyz(q: Column) -> Column:
    return F.concat(F.slice(q, 4, 1), F.slice(q, 1, 3))


def quaternion_angle(q: Column) -> Column:
    """Rotation angle of a unit quaternion wxyz."""
    return 2 * F.atan2(norm(F.slice(q, 2, 3)), F.abs(F.get(q, F.lit(0))))


def rotate2(x: Column, y: Column, theta: Column) -> tuple[Column, Column]:
    return x * F.cos(theta) - y * F.sin(theta), x * F.sin(theta) + y * F.cos(theta)


def transform_point(matrix: Column, p: Column) -> Column:
    """Rows of a 3x4 rigid transform applied to a point."""
    return F.transform(matrix, lambda row: dot(F.slice(row, 1, 3), p) + F.get(row, F.lit(3)))


def inverse_transform_point(matrix: Column, p: Column) -> Column:
    moved = F.zip_with(p, F.transform(matrix, lambda row: F.get(row, F.lit(3))), lambda a, b: a - b)
    column = lambda i: F.transform(matrix, lambda row: F.get(row, F.lit(i)))
    columns = F.array(*map(column, range(3)))
    return F.transform(columns, lambda c: dot(c, moved))


def chordal_angle(p: Column, g: Column) -> Column:
    """asin(|P - G| / (2 sqrt 2)) of two rotation matrices given as flat arrays: half the angle between them, pi / 2 at most."""
    x = norm(F.zip_with(p, g, lambda a, b: a - b)) / F.lit(2 * 2**0.5)
    return F.asin(F.when(F.isnan(x), x).otherwise(F.least(x, F.lit(1.0))))  # least alone makes 1 of NaN


def euler_to_axis_angle(roll: Column, pitch: Column, yaw: Column) -> Column:
    """(x, y, z, angle) of the rotation z(yaw) y(pitch) x(roll); no rotation has the axis x."""
    c = [F.cos(a / 2) for a in (roll, pitch, yaw)]
    s = [F.sin(a / 2) for a in (roll, pitch, yaw)]
    w = c[0] * c[1] * c[2] + s[0] * s[1] * s[2]
    x = s[0] * c[1] * c[2] - c[0] * s[1] * s[2]
    y = c[0] * s[1] * c[2] + s[0] * c[1] * s[2]
    z = c[0] * c[1] * s[2] - s[0] * s[1] * c[2]
    n = F.sqrt(x * x + y * y + z * z)
    sign = F.when(w < 0, -1.0).otherwise(1.0)
    part = lambda v, none: F.when(n < 1e-12, none).otherwise(sign * v / n)
    return F.array(part(x, 1.0), part(y, 0.0), part(z, 0.0), 2 * F.atan2(n, F.abs(w)))


def pixel(x: Column) -> Column:
    return x / 127.5 - 1


def linspace(low: float, high: float, n: int) -> Column:
    step = (high - low) / max(n - 1, 1)
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.lit(low) + i * F.lit(step))
