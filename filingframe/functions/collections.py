"""Maps, arrays and nested values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from filingframe.functions.text import ColumnOrName, as_col


def merge_maps(*maps: ColumnOrName) -> Column:
    """One map, later ones override, null maps are skipped."""
    cols = [as_col(m) for m in maps]

    def merge(left: Column, right: Column) -> Column:
        kept = F.map_filter(left, lambda k, _: ~F.coalesce(F.map_contains_key(right, k), F.lit(False)))
        both = F.map_concat(kept, right)
        return F.coalesce(both, left, right)

    return reduce(merge, cols)


def nested_get(json: ColumnOrName, *path: str, default: str | None = None) -> Column:
    """Value at a path of a JSON text, or the default."""
    where = "$" + "".join(f"['{step}']" for step in path)
    value = F.get_json_object(as_col(json), where)
    return value if default is None else F.coalesce(value, F.lit(default))


def flatten(nested: ColumnOrName) -> Column:
    return F.flatten(as_col(nested))


def unique(values: ColumnOrName) -> Column:
    """Distinct elements, first occurrence first."""
    return F.array_distinct(as_col(values))
