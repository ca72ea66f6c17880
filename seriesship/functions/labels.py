"""Label lists: arrays of (name, value) sorted by name. Not maps, because duplicates survive."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from seriesship.schema import LABELS


def pair(name: Column | str, value: Column) -> Column:
    name = F.lit(name) if isinstance(name, str) else name
    return F.struct(name.alias("name"), value.alias("value"))


def no_labels() -> Column:
    return F.array().cast(LABELS)


def literal_labels(items: dict[str, str]) -> Column:
    """A fixed label list, sorted by name in byte order."""
    if not items:
        return no_labels()
    ordered = sorted(items.items(), key=lambda kv: kv[0].encode())
    return F.array(*[pair(k, F.lit(v)) for k, v in ordered])


def sort_labels(c: Column) -> Column:
    """Stable sort by name in byte order: the position breaks ties, so duplicates keep their order."""
    keyed = F.transform(
        c, lambda x, i: F.struct(x["name"].alias("name"), i.alias("i"), x["value"].alias("value"))
    )
    return F.transform(F.sort_array(keyed), lambda x: pair(x["name"], x["value"]))


def present(labels: Column) -> Column:
    """Drop pairs with a null name or value; a null list counts as empty."""
    kept = F.filter(labels, lambda x: x["name"].isNotNull() & x["value"].isNotNull())
    return F.coalesce(kept, no_labels())


def build_labels(name: Column, extra: Column | None, labels: Column) -> Column:
    """Metric name, the optional bucket or quantile list, then the metric's own labels; unsorted."""
    parts = [F.array(pair("__name__", name))]
    if extra is not None:
        parts.append(extra)
    return F.concat(*parts, present(labels))


def missing_from(labels: Column, external: Column) -> Column:
    """External pairs whose name the list does not carry."""
    return F.filter(external, lambda e: ~F.exists(labels, lambda x: x["name"] == e["name"]))


def merge_external(labels: Column, external: Column) -> Column:
    """Add external labels whose name is absent; the metric's own label wins. Sorted result."""
    return sort_labels(F.concat(labels, missing_from(labels, external)))


def external_from_map(c: Column) -> Column:
    """A map column as a sorted label list."""
    return F.sort_array(F.transform(F.map_entries(c), lambda e: pair(e["key"], e["value"])))


def label_value(labels: Column, name: str) -> Column:
    """Value of the first label of that name, empty text when absent."""
    found = F.get(F.filter(labels, lambda x: x["name"] == name), F.lit(0))
    return F.coalesce(found["value"], F.lit(""))


def set_label(labels: Column, name: Column, value: Column) -> Column:
    """Replace or add one label; empty text removes it."""
    others = F.filter(labels, lambda x: x["name"] != name)
    return F.when(value == "", others).otherwise(F.concat(others, F.array(pair(name, value))))


def render(labels: Column) -> Column:
    """One comparable text for a label list."""
    return F.array_join(
        F.transform(labels, lambda x: F.concat(x["name"], F.lit("="), x["value"])), "|"
    )


def label_bytes(labels: Column) -> Column:
    """Bytes of names and values plus two per label."""
    return F.aggregate(
        labels,
        F.lit(0).cast("bigint"),
        lambda a, x: a + F.octet_length(x["name"]) + F.octet_length(x["value"]) + 2,
    )
