"""Array and map helpers as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

Fn = Callable[[Column], Column]


def first_match(values: Column, test: Fn) -> Column:
    """First element meeting the test, else NULL."""
    return F.get(F.filter(values, test), 0)


def take_first(values: Column) -> Column:
    """First value that is neither NULL nor empty."""
    return first_match(values, lambda v: v.isNotNull() & (v != ""))


def map_compose(values: Column, *steps: Fn) -> Column:
    """Apply each step to every value; a value that becomes NULL is dropped."""
    for step in steps:
        values = F.filter(F.transform(values, step), lambda v: v.isNotNull())
    return values


def last_wins_map(entries: Column) -> Column:
    """Map from an array of (k, v) structs; of equal keys the last is kept, in the order of those.

    Entries are sorted by key and place, and each is compared with the next only. The sorted array is an
    argument of ``zip_with``, so it is worked out once per row and not once per entry.
    """
    numbered = F.transform(entries, lambda e, i: F.struct(e["k"].alias("k"), i.alias("i"), e["v"].alias("v")))
    ordered = F.array_sort(F.filter(numbered, lambda e: e["k"].isNotNull()))
    marked = F.zip_with(
        ordered,
        F.filter(ordered, lambda _, i: i > 0),
        lambda e, after: F.struct(e["i"].alias("i"), e["k"].alias("k"), e["v"].alias("v"), (e["k"] == after["k"]).alias("again")),
    )
    kept = F.array_sort(F.filter(marked, lambda e: ~F.coalesce(e["again"], F.lit(False))))
    return F.map_from_entries(F.transform(kept, lambda e: F.struct(e["k"].alias("k"), e["v"].alias("v"))))


def key_containing(mapping: Column, part: str) -> Column:
    """Value of the first key, in document order, that holds the given text."""
    return F.get(F.map_values(F.map_filter(mapping, lambda k, _: k.contains(part))), 0)


def pairs(names: Column, values: Column) -> Column:
    """(k, v) structs from two arrays of equal length."""
    return F.zip_with(names, values, lambda k, v: F.struct(k.alias("k"), v.alias("v")))


def parse_params(text: Column, **first: Column) -> Column:
    """``a=1&b=2`` as a map; named columns come first and a parameter of the same name overwrites."""
    given = [F.struct(F.lit(k).alias("k"), v.cast("string").alias("v")) for k, v in first.items()]
    parsed = F.transform(
        F.filter(F.split(text, "&"), lambda p: p != ""),
        lambda p: F.struct(
            F.substring_index(p, "=", 1).alias("k"),
            F.when(p.contains("="), F.substr(p, F.instr(p, "=") + 1)).alias("v"),
        ),
    )
    empty = F.array().cast("array<struct<k:string,v:string>>")
    whole = F.coalesce(parsed, empty)
    return last_wins_map(F.concat(F.array(*given), whole) if given else whole)
