"""Ordered relabel rules compiled to column expressions on the label list."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesship.functions import labels as L
from seriesship.functions.regex import Translated, translate
from seriesship.functions.text import let

ANY = "(.*)"
FIRST_GROUP = "$1"
ACTIONS = (
    "replace",
    "keep",
    "drop",
    "keepequal",
    "dropequal",
    "hashmod",
    "labelmap",
    "labeldrop",
    "labelkeep",
    "lowercase",
    "uppercase",
)
NEED_TARGET = {"replace", "keepequal", "dropequal", "hashmod", "lowercase", "uppercase"}
LEGACY_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*\Z")
LEGACY_TEMPLATE = re.compile(r"(?:[A-Za-z_]|\$(?:\{\w+\}|\w+))(?:\w|\$(?:\{\w+\}|\w+))*\Z")
REFERENCE = re.compile(r"\$(?:\$|\{(\w+)\}|(\w+))", re.ASCII)


@dataclass(frozen=True)
class Rule:
    """One rule. Unset fields take these defaults, also the separator."""

    action: str = "replace"
    source_labels: tuple[str, ...] = ()
    separator: str = ";"
    regex: str = ANY
    target_label: str = ""
    replacement: str = FIRST_GROUP
    modulus: int = 0


def _has_reference(template: str) -> bool:
    return any(m.group(0) != "$$" for m in REFERENCE.finditer(template))


def _valid_name(name: str, scheme: str, template: bool = False) -> bool:
    if scheme == "utf8":
        return name != ""
    return bool((LEGACY_TEMPLATE if template else LEGACY_NAME).match(name))


def _parsed(regex: str) -> Translated:
    try:
        return translate(regex)
    except ValueError as e:
        raise ValueError(f"invalid rule: regex: {e}") from e


def check_rules(rules: Sequence[Rule], name_scheme: str = "legacy") -> tuple[Rule, ...]:
    """Reject an invalid rule set before any data is read."""
    for r in rules:
        problem = _problem(r, name_scheme)
        if problem:
            raise ValueError(f"invalid rule: {problem}: {r}")
        _parsed(r.regex)
    return tuple(rules)


def _problem(r: Rule, scheme: str) -> str | None:
    if r.action not in ACTIONS:
        return "unknown action"
    if r.action in NEED_TARGET and not r.target_label:
        return "target_label is required"
    if r.action == "hashmod" and r.modulus <= 0:
        return "a positive modulus is required"
    if r.action in NEED_TARGET:
        template = r.action == "replace" and _has_reference(r.target_label)
        if not _valid_name(r.target_label, scheme, template):
            return "target_label is not a label name"
    if r.action in ("lowercase", "uppercase", "keepequal", "dropequal"):
        if r.replacement != FIRST_GROUP:
            return "replacement has no effect"
    if r.action in ("keepequal", "dropequal"):
        if r.regex != ANY or r.modulus or r.separator != ";":
            return "only source_labels and target_label have an effect"
    if r.action in ("labeldrop", "labelkeep"):
        if r.source_labels or r.target_label or r.modulus or r.separator != ";":
            return "only regex has an effect"
        if r.replacement != FIRST_GROUP:
            return "replacement has no effect"
    if r.action == "labelmap":
        if not _valid_name(r.replacement, scheme, template=True):
            return "replacement is not a label name"
    return None


def anchored(regex: str) -> str:
    """The regex as a full match in the JVM's dialect."""
    return rf"\A(?:{_parsed(regex).pattern})\z"


def expand(template: str, regex: str, text: Column) -> Column:
    """Fill ``$name``, ``${name}`` and ``$$`` from the groups of a match; unknown groups are empty."""
    parsed = _parsed(regex)
    parts: list[Column] = []
    at = 0
    for m in REFERENCE.finditer(template):
        if m.start() > at:
            parts.append(F.lit(template[at : m.start()]))
        at = m.end()
        ref = m.group(1) or m.group(2)
        if ref is None:
            parts.append(F.lit("$"))
            continue
        group = int(ref) if ref.isdigit() else parsed.names.get(ref, -1)
        if 0 <= group <= parsed.groups:
            parts.append(F.regexp_extract(text, anchored(regex), group))
    if at < len(template):
        parts.append(F.lit(template[at:]))
    if not parts:
        return F.lit("")
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def _source(labels: Column, r: Rule) -> Column:
    values = [L.label_value(labels, n) for n in r.source_labels]
    if not values:
        return F.lit("")
    return values[0] if len(values) == 1 else F.concat_ws(r.separator, *values)


def _valid_target(target: Column, scheme: str) -> Column:
    return target != "" if scheme == "utf8" else target.rlike(r"\A[A-Za-z_][A-Za-z0-9_]*\z")


def _replace(labels: Column, r: Rule, scheme: str) -> Column:
    def change(src: Column) -> Column:
        target = expand(r.target_label, r.regex, src)
        changed = let(
            expand(r.replacement, r.regex, src), lambda v: L.set_label(labels, target, v)
        )
        ok = src.rlike(anchored(r.regex))
        if _has_reference(r.target_label):
            ok = ok & _valid_target(target, scheme)
        return F.when(ok, changed).otherwise(labels)

    return let(_source(labels, r), change)


def _set(labels: Column, r: Rule, value: Column) -> Column:
    return let(value, lambda v: L.set_label(labels, F.lit(r.target_label), v))


def _hash_bucket(text: Column, modulus: int) -> Column:
    low64 = F.conv(F.substring(F.md5(text), 17, 16), 16, 10).cast("decimal(20,0)")
    return (low64 % F.lit(modulus).cast("decimal(20,0)")).cast("decimal(20,0)").cast("string")


def _labelmap(labels: Column, r: Rule) -> Column:
    rx = anchored(r.regex)
    mapped = F.transform(
        F.filter(labels, lambda x: x["name"].rlike(rx)),
        lambda x: L.pair(expand(r.replacement, r.regex, x["name"]), x["value"]),
    )

    def add(mapped: Column) -> Column:
        # Of several sources for one name the last wins.
        last = F.filter(
            mapped,
            lambda x, i: ~F.exists(
                F.slice(mapped, i + 2, F.greatest(F.size(mapped), F.lit(1))),
                lambda y: y["name"] == x["name"],
            ),
        )
        return F.concat(L.missing_from(mapped, labels), last)

    return let(mapped, add)


def apply_rule(labels: Column, r: Rule, scheme: str = "legacy") -> Column:
    """The label list after a rule that changes labels."""
    if r.action == "replace":
        return _replace(labels, r, scheme)
    if r.action == "hashmod":
        return _set(labels, r, _hash_bucket(_source(labels, r), r.modulus))
    if r.action == "lowercase":
        return _set(labels, r, F.lower(_source(labels, r)))
    if r.action == "uppercase":
        return _set(labels, r, F.upper(_source(labels, r)))
    if r.action == "labelmap":
        return _labelmap(labels, r)
    rx = anchored(r.regex)
    if r.action == "labeldrop":
        return F.filter(labels, lambda x: ~x["name"].rlike(rx))
    return F.filter(labels, lambda x: x["name"].rlike(rx))


def keeps(labels: Column, r: Rule) -> Column:
    """Whether a series passes a filtering rule."""
    src = _source(labels, r)
    if r.action in ("keepequal", "dropequal"):
        same = src == L.label_value(labels, r.target_label)
        return same if r.action == "keepequal" else ~same
    match = src.rlike(anchored(r.regex))
    return match if r.action == "keep" else ~match


FILTERING = ("keep", "drop", "keepequal", "dropequal")


def relabel(
    df: DataFrame, rules: Sequence[Rule], name_scheme: str = "legacy", column: str = "labels"
) -> DataFrame:
    """Run the rules in order over the label column; without rules nothing changes.

    A pass through rules also removes empty values and sorts by name. Each rule is one projection. A
    dropped series carries a null list to a generate at the end: unlike a filter, that is not pushed below
    the projections, where it would work out all their expressions a second time.
    """
    rules = check_rules(rules, name_scheme)
    if not rules:
        return df
    c = F.col(column)
    out = df.withColumn(column, F.filter(c, lambda x: x["value"] != ""))
    for r in rules:
        if r.action in FILTERING:
            out = out.withColumn(column, F.when(keeps(c, r), c))
        else:
            out = out.withColumn(column, F.when(c.isNotNull(), apply_rule(c, r, name_scheme)))
    # No rule sets an empty value, so those are gone already.
    others = [x for x in df.columns if x != column]
    whole = F.when(c.isNotNull(), F.array(L.sort_labels(c)))
    kept = out.select(*others, F.explode(whole).alias(column))
    return kept.select(*df.columns)
