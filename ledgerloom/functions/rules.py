"""Ordered rules as data, compiled into CASE expressions: the first rule that matches wins. No join is planned for them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.text import text_or_empty


def _chain(cases: Sequence[tuple[Column, Column]], default: Column) -> Column:
    if not cases:
        return default
    chain = F.when(*cases[0])
    for condition, value in cases[1:]:
        chain = chain.when(condition, value)
    return chain.otherwise(default)


def first_match(c: Column, rules: Sequence[tuple[str, str]], default: str | None = None, ignore_case: bool = True) -> Column:
    """The name of the first rule whose pattern is found anywhere in the text."""
    flag = "(?i)" if ignore_case else ""
    return _chain([(text_or_empty(c).rlike(flag + pattern), F.lit(name)) for name, pattern in rules], F.lit(default))


def first_full_match(c: Column, rules: Sequence[tuple[str, str]], default: str | None = None) -> Column:
    """The name of the first rule whose pattern is the whole text."""
    return _chain([(text_or_empty(c).rlike(rf"\A(?:{pattern})\z"), F.lit(name)) for name, pattern in rules], F.lit(default))


def longest_prefix(c: Column, prefixes: Mapping[str, str]) -> Column:
    """struct(name, rest) for the longest prefix that the text starts with, followed by a blank; NULL without one."""
    text = F.trim(text_or_empty(c))
    kind = "struct<name:string,rest:string>"
    cases = [
        (text.startswith(p + " "), F.struct(F.lit(prefixes[p]).alias("name"), F.trim(F.substring(text, F.lit(len(p) + 2), F.length(text))).alias("rest")))
        for p in sorted(prefixes, key=lambda p: (-len(p), p))
    ]
    return _chain(cases, F.lit(None).cast(kind))


@dataclass(frozen=True)
class TypeRules:
    """How documents are typed: by format, then by ordered title rules; with the value classes of types."""

    by_format: Mapping[str, str] = field(default_factory=dict)
    by_title: Sequence[tuple[str, str]] = ()
    values: Mapping[str, str] = field(default_factory=dict)
    translation: str = "(?!)"
    quick_reference: str = "(?!)"
    collection: str = "document collection"
    other: str = "Other"

    def document_type(self, title: Column, fmt: Column) -> Column:
        by_format = F.try_element_at(F.create_map(*[F.lit(x) for p in self.by_format.items() for x in p]), fmt) if self.by_format else F.lit(None).cast("string")
        collected = F.when(F.lower(text_or_empty(title)).contains(self.collection), self.by_format.get("collection", "Collection"))
        return F.coalesce(by_format, collected, first_match(title, self.by_title, self.other))

    def is_translation(self, title: Column) -> Column:
        return text_or_empty(title).rlike("(?i)" + self.translation)

    def is_quick_reference(self, title: Column) -> Column:
        return text_or_empty(title).rlike("(?i)" + self.quick_reference)

    def value_class(self, kind: Column) -> Column:
        return F.try_element_at(F.create_map(*[F.lit(x) for p in self.values.items() for x in p]), kind) if self.values else F.lit(None).cast("string")


def type_rules(config: Mapping) -> TypeRules:
    """Rules from a YAML-shaped mapping with types, by_format, rules, translation and quick_reference."""
    kinds = config.get("types") or {}
    values = {name: (spec or {}).get("value", "") if isinstance(spec, Mapping) else str(spec) for name, spec in kinds.items()}
    rules = [(next(iter(r.items())) if isinstance(r, Mapping) else tuple(r)) for r in config.get("rules") or []]
    return TypeRules(
        dict(config.get("by_format") or {}), rules, values, config.get("translation") or "(?!)", config.get("quick_reference") or "(?!)"
    )


@dataclass(frozen=True)
class ProductRules:
    """Families by kind: ordered, each with patterns that must match an entry's whole name."""

    families: Sequence[tuple[str, str, str]] = ()

    def place(self, entry: Column) -> Column:
        """struct(kind, family) of an entry; NULL for one that no family takes."""
        cases = [
            (text_or_empty(entry).rlike(rf"\A(?:{pattern})\z"), F.struct(F.lit(kind).alias("kind"), F.lit(family).alias("family")))
            for kind, family, pattern in self.families
        ]
        return _chain(cases, F.lit(None).cast("struct<kind:string,family:string>"))


def product_rules(config: Mapping) -> ProductRules:
    """kind -> family -> pattern or patterns, in the order written."""
    return ProductRules(
        [
            (kind, family, pattern)
            for kind, families in config.items()
            for family, patterns in (families or {}).items()
            for pattern in ([patterns] if isinstance(patterns, str) else patterns)
        ]
    )
