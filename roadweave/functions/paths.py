"""Expressions over paths: arrays of unit ids in driving order. Text with `|` exists only where data is read or written."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def split_path(text: Column) -> Column:
    """Units of a `|` separated path, blanks trimmed, empty tokens dropped; null stays null."""
    return F.filter(F.transform(F.split(text, r"\|"), lambda x: F.trim(x)), lambda x: x != "")


def join_path(path: Column) -> Column:
    return F.array_join(path.cast("array<string>"), "|")


def reversed_unit(unit: Column) -> Column:
    """The opposite direction's unit: last two characters 10 become 20 and the other way round; null for any other id."""
    stem = F.left(unit, F.length(unit) - 2)
    return F.when(F.right(unit, F.lit(2)) == "10", F.concat(stem, F.lit("20"))).when(F.right(unit, F.lit(2)) == "20", F.concat(stem, F.lit("10")))


def adjacent_dedup(path: Column) -> Column:
    """The path without units that equal the one before."""
    return F.filter(path, lambda x, i: (i == 0) | (x != F.get(path, i - 1)))


def first_position(path: Column, unit: Column) -> Column:
    """Place of a unit's first visit from 1; 0 if there is none."""
    return F.array_position(path, unit)


def last_position(path: Column, unit: Column) -> Column:
    back = F.array_position(F.reverse(path), unit)
    return F.when(back > 0, F.size(path) + 1 - back).otherwise(F.lit(0))


def neighbours(path: Column, n: int) -> Column:
    """Structs `0`, `1`, .. of each n elements in a row; none if there are fewer. The array itself is made once a row, not once an element as in a lambda that looks it up."""
    count = F.greatest(F.size(path) - (n - 1), F.lit(0))
    return F.arrays_zip(*(F.slice(path, F.lit(i + 1), count).alias(str(i)) for i in range(n)))


def visits_in_order(path: Column, a: Column, b: Column) -> Column:
    """Whether some visit of a comes before some visit of b."""
    return (first_position(path, a) > 0) & (first_position(path, a) < last_position(path, b))


def hits(path: Column, units: Column) -> Column:
    """Visits of the given units, in the path's order."""
    return F.filter(path, lambda x: F.array_contains(units, x))


def affected_units(path: Column, units: Column) -> Column:
    """The given units that the path visits, in the order in which they were given."""
    return F.filter(units, lambda x: F.array_contains(path, x))


def flow_anchor(path: Column, units: Column) -> Column:
    """The unit at which a path's flow is counted: its first affected unit, else its first unit."""
    return F.coalesce(F.get(affected_units(path, units), F.lit(0)), F.get(path, F.lit(0)))


def endpoints_key(path: Column) -> Column:
    """Both ends of a path regardless of direction: the smaller, then the larger number, joined by `|`; null for an empty path."""
    a, b = F.get(path, F.lit(0)), F.get(path, F.size(path) - 1)
    return F.when(F.size(path) > 0, F.concat_ws("|", F.least(a, b).cast("string"), F.greatest(a, b).cast("string")))


def interval_name(name: Column, frequent: int = 3) -> Column:
    """Words of a `-` separated name that occur less than `frequent` times, each once in order; all distinct ones if none is left."""
    words = F.filter(F.transform(F.split(name, "-"), lambda x: F.trim(x)), lambda x: x != "")
    rare = F.filter(words, lambda w: F.size(F.filter(words, lambda v: v == w)) < frequent)
    return F.array_join(F.array_distinct(F.when(F.size(rare) > 0, rare).otherwise(words)), "-")


def window_class(path: Column, start: Column, end: Column, units: Column) -> Column:
    """pass: the path visits start before end and any of the units. bypass: it visits start before end, but none of them. none: neither."""
    return F.when(~visits_in_order(path, start, end), "none").when(F.arrays_overlap(path, units), "pass").otherwise("bypass")


def pair_dedup(numbers: Sequence[int]) -> list[int]:
    """A section path without repeated pairs.

    Neighbours that are equal collapse. The rest is cut into pairs from the first and from the second element; a pair
    that equals the one before it goes with it, and the shorter of both results (the first, if equally long) is taken,
    neighbours collapsed again. A lone element at either end is a pair with nothing.
    """

    def collapsed(x: Sequence) -> list:
        return [v for i, v in enumerate(x) if i == 0 or v != x[i - 1]]

    base = collapsed(numbers)
    if not base:
        return []

    def without_repeats(offset: int) -> list[int]:
        head = [(None, base[0])] if offset else []
        body = [tuple(base[i : i + 2]) for i in range(offset, len(base), 2)]
        pairs = head + [p if len(p) == 2 else (p[0], None) for p in body]
        kept, i = [], 0
        while i < len(pairs):
            kept.append(pairs[i])
            i += 2 if i + 1 < len(pairs) and pairs[i + 1] == pairs[i] else 1
        return [v for pair in kept for v in pair if v is not None]

    return collapsed(min((without_repeats(0), without_repeats(1)), key=len))


def pair_dedup_udf(kind: str = "array<int>") -> Callable[[Column], Column]:
    """pair_dedup as a column function; call it on distinct paths."""
    def run(paths: pd.Series) -> pd.Series:
        return paths.map(lambda x: None if x is None else pair_dedup(list(x)))

    return F.pandas_udf(run, kind)
