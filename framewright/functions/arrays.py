"""Column functions over arrays: padding, sampling, shifting, masks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pad_right(a: Column, n: int, value: Column) -> Column:
    """Cut or filled to n elements."""
    return F.slice(F.concat(a, F.array_repeat(value, n)), 1, n)


def pad_with_last(a: Column, n: int) -> Column:
    return F.concat(a, F.array_repeat(F.element_at(a, -1), F.greatest(F.lit(n) - F.size(a), F.lit(0))))


def spread(n: Column, k: int) -> Column:
    """k ordinals spread evenly over 0..n-1, the last one pinned; one is the first."""
    if k == 1:
        return F.array(F.lit(0))
    step = (n - 1) / F.lit(float(k - 1))
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.when(i == k - 1, n - 1).otherwise((i * step).cast("int")).cast("int"))


def frames_of(a: Column, per_frame: int) -> Column:
    """A flat array cut to frames of fixed size; what is left over is dropped."""
    n = F.floor(F.size(a) / per_frame).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.slice(a, i * per_frame + 1, per_frame))).otherwise(F.array().cast("array<array<int>>"))


def inputs(tokens: Column) -> Column:
    return F.slice(tokens, 1, F.greatest(F.size(tokens) - 1, F.lit(0)))


def targets(tokens: Column) -> Column:
    return F.slice(tokens, 2, F.greatest(F.size(tokens) - 1, F.lit(0)))


def last_rise(mask: Column) -> Column:
    """The last place j >= 1 with mask false at j and true at j + 1; null if there is none."""
    places = F.filter(F.sequence(F.lit(1), F.greatest(F.size(mask) - 2, F.lit(1))), lambda j: ~F.coalesce(F.get(mask, j), F.lit(True)) & F.coalesce(F.get(mask, j + 1), F.lit(False)))
    return F.array_max(places)


def choice(a: Column, seed: Column) -> Column:
    """One element by a hash of the seed."""
    return F.get(a, F.pmod(F.xxhash64(seed), F.size(a).cast("long")).cast("int"))


def out_of_range(a: Column, domain: int) -> Column:
    return F.exists(a, lambda x: (x < 0) | (x >= domain))


def one_hot(code: Column, domain: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(domain - 1)), lambda k: F.when(k == code, 1).otherwise(0))


def mask_runs(*runs: tuple[bool, Column]) -> Column:
    """A mask of runs, each of one value and a length."""
    return F.concat(*(F.array_repeat(F.lit(value), n) for value, n in runs))
