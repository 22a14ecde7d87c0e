"""Grouped metadata: ``MAP<STRING, MAP<STRING, BINARY>>`` columns and their algebra.

Every function takes and returns Columns, so nothing is changed in place. User metadata may be
written; operators never write system metadata.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from msgflow.functions.scalars import let

METADATA_TYPE = "map<string,map<string,binary>>"
GROUP_TYPE = "map<string,binary>"


def empty_metadata() -> Column:
    return F.create_map().cast(METADATA_TYPE)


def empty_group() -> Column:
    return F.create_map().cast(GROUP_TYPE)


def _meta(md: Column | str) -> Column:
    return F.coalesce(F.col(md) if isinstance(md, str) else md, empty_metadata())


def _lit(x: Column | str) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def group_from(values: dict[str, Column | str | bytes]) -> Column:
    """A group from a dict; text values are stored as UTF-8 bytes."""
    if not values:
        return empty_group()
    parts: list[Column] = []
    for k, v in values.items():
        parts += [F.lit(k), (v if isinstance(v, Column) else F.lit(v)).cast("binary")]
    return F.create_map(*parts)


def meta_from_dict(groups: dict[str, dict[str, Column | str | bytes]]) -> Column:
    if not groups:
        return empty_metadata()
    parts: list[Column] = []
    for g, values in groups.items():
        parts += [F.lit(g), group_from(values)]
    return F.create_map(*parts)


def meta_groups(md: Column | str) -> Column:
    return F.sort_array(F.map_keys(_meta(md)))


def meta_keys(md: Column | str, group: Column | str) -> Column:
    keys = F.map_keys(F.try_element_at(_meta(md), _lit(group)))
    return F.sort_array(F.coalesce(keys, F.array().cast("array<string>")))


def meta_value(md: Column | str, group: Column | str, key: Column | str) -> Column:
    return F.try_element_at(F.try_element_at(_meta(md), _lit(group)), _lit(key))


def meta_contains(md: Column | str, group: Column | str) -> Column:
    return F.map_contains_key(_meta(md), _lit(group))


def _missing_group(group: Column) -> Column:
    return F.raise_error(F.concat(F.lit("no such metadata group: "), group))


def meta_get_group(md: Column | str, group: Column | str, *, strict: bool = True) -> Column:
    g = _lit(group)
    if not strict:
        return F.try_element_at(_meta(md), g)
    missing = _missing_group(g).cast(GROUP_TYPE)
    return let(
        _meta(md), lambda m: F.when(F.map_contains_key(m, g), F.try_element_at(m, g)).otherwise(missing)
    )


def meta_remove_group(md: Column | str, group: Column | str) -> Column:
    g = _lit(group)
    return F.map_filter(_meta(md), lambda k, _: k != g)


def meta_set_group(md: Column | str, group: Column | str, values: Column) -> Column:
    return F.map_concat(meta_remove_group(md, group), F.create_map(_lit(group), values.cast(GROUP_TYPE)))


def meta_create_group(md: Column | str, group: Column | str) -> Column:
    g = _lit(group)
    return let(
        _meta(md),
        lambda m: F.when(F.map_contains_key(m, g), m).otherwise(F.map_concat(m, F.create_map(g, empty_group()))),
    )


def meta_del_group(md: Column | str, group: Column | str) -> Column:
    g = _lit(group)
    missing = _missing_group(g).cast(METADATA_TYPE)
    return let(
        _meta(md),
        lambda m: F.when(F.map_contains_key(m, g), F.map_filter(m, lambda k, _: k != g)).otherwise(missing),
    )


def meta_add_key(md: Column | str, group: Column | str, key: Column | str, value: Column | str | bytes) -> Column:
    g, k = _lit(group), _lit(key)
    pair = F.create_map(k, _lit(value).cast("binary"))

    def add(m: Column) -> Column:
        old = F.coalesce(F.try_element_at(m, g), empty_group())
        changed = F.map_concat(F.map_filter(old, lambda name, _: name != k), pair)
        return F.map_concat(F.map_filter(m, lambda name, _: name != g), F.create_map(g, changed))

    return let(_meta(md), add)


def meta_remove_key(
    md: Column | str, group: Column | str, key: Column | str, *, keep_empty: bool = False
) -> Column:
    """Remove one key. A group that this empties goes too, unless ``keep_empty``.

    An absent group or key changes nothing.
    """
    g, k = _lit(group), _lit(key)

    def remove(m: Column) -> Column:
        had_key = F.coalesce(F.map_contains_key(F.try_element_at(m, g), k), F.lit(False))
        stripped = F.transform_values(
            m, lambda name, vals: F.when(name == g, F.map_filter(vals, lambda x, _: x != k)).otherwise(vals)
        )
        if not keep_empty:
            stripped = F.map_filter(stripped, lambda name, vals: (name != g) | (F.size(vals) > 0))
        return F.when(had_key, stripped).otherwise(m)

    return let(_meta(md), remove)


def meta_clear() -> Column:
    return empty_metadata()


def meta_len(md: Column | str) -> Column:
    return F.size(_meta(md))


def meta_text(md: Column | str) -> Column:
    """Metadata as one ordered text, ``group{key=value,...};...``, for logs and comparisons."""

    def one_group(entry: Column) -> Column:
        pairs = F.transform(
            F.array_sort(F.map_entries(entry["value"])),
            lambda kv: F.concat(kv["key"], F.lit("="), F.decode(kv["value"], "UTF-8")),
        )
        return F.concat(entry["key"], F.lit("{"), F.array_join(pairs, ","), F.lit("}"))

    def text(m: Column) -> Column:
        names = F.sort_array(F.map_keys(m))
        groups = F.transform(names, lambda g: F.struct(g.alias("key"), F.element_at(m, g).alias("value")))
        return F.array_join(F.transform(groups, one_group), ";")

    return let(_meta(md), text)
