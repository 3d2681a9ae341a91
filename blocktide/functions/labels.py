"""Deterministic text forms of a label map."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sorted_entries(labels: Column) -> Column:
    return F.array_sort(F.map_entries(labels))


def labels_key(labels: Column) -> Column:
    """``k=v`` pairs sorted by key and joined with commas; ``''`` when empty."""
    pairs = F.transform(_sorted_entries(labels), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return F.coalesce(F.array_join(pairs, ","), F.lit(""))


def labels_json(labels: Column) -> Column:
    """JSON object with keys in sorted order; ``{}`` when empty."""
    return F.coalesce(F.to_json(F.map_from_entries(_sorted_entries(labels))), F.lit("{}"))


def labels_from_json(text: Column) -> Column:
    """Map from its JSON form; an empty object reads as NULL."""
    parsed = F.from_json(text, "map<string,string>")
    return F.when(F.size(parsed) > 0, parsed)


def set_entry(attributes: Column, key: str, value: Column) -> Column:
    """Map with ``key`` set, other entries kept; unchanged where ``value`` is NULL."""
    rest = F.map_filter(attributes, lambda k, _: k != F.lit(key))
    return F.when(
        value.isNotNull(), F.map_concat(rest, F.create_map(F.lit(key), value))
    ).otherwise(attributes)
