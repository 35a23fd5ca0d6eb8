"""Named, swappable filter sets applied conjunctively.

A ``FilterSet`` is an ordered mapping name -> Column.  Business owners change
scope by adding, removing or toggling entries, never by editing query text.
Predicates given as SQL text are parsed by Spark (``F.expr``); values are bound
as literals by the builders in ``cargomart.functions.predicates``, so no value
is ever spliced into SQL text.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargomart.functions.predicates import all_of


@dataclass(frozen=True)
class FilterSet:
    name: str
    filters: tuple[tuple[str, Column], ...] = field(default_factory=tuple)

    @classmethod
    def of(cls, name: str, filters: Mapping[str, Column | str]) -> FilterSet:
        items = tuple((k, F.expr(v) if isinstance(v, str) else v) for k, v in filters.items())
        return cls(name, items)

    @property
    def names(self) -> list[str]:
        return [k for k, _ in self.filters]

    def only(self, *names: str) -> FilterSet:
        self._check(names)
        return FilterSet(self.name, tuple((k, c) for k, c in self.filters if k in names))

    def without(self, *names: str) -> FilterSet:
        self._check(names)
        return FilterSet(self.name, tuple((k, c) for k, c in self.filters if k not in names))

    def plus(self, name: str, cond: Column | str) -> FilterSet:
        if name in self.names:
            raise KeyError(f"filter {name!r} already in set {self.name!r}")
        cond = F.expr(cond) if isinstance(cond, str) else cond
        return FilterSet(self.name, self.filters + ((name, cond),))

    def condition(self) -> Column:
        return all_of(c for _, c in self.filters)

    def apply(self, df: DataFrame) -> DataFrame:
        return df.where(self.condition()) if self.filters else df

    def _check(self, names: Iterable[str]) -> None:
        unknown = set(names) - set(self.names)
        if unknown:
            raise KeyError(f"unknown filters {sorted(unknown)} in set {self.name!r}")
