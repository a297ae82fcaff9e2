"""A source described by data: how its rows become records of one common shape."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import non_blank


@dataclass
class Adapter:
    """``columns`` (new name: old name), ``constants``, ``codes`` (column: map of its codes, others become ``unknown``), ``parties`` (column of names
    between semicolons: role), ``placeholders`` (names that stand for nobody), ``noise`` (column: prefixes whose rows go), ``required``."""

    columns: dict[str, str]
    constants: dict[str, object] = field(default_factory=dict)
    codes: dict[str, dict[str, str]] = field(default_factory=dict)
    parties: dict[str, str] = field(default_factory=dict)
    placeholders: tuple[str, ...] = ()
    noise: dict[str, tuple[str, ...]] = field(default_factory=dict)
    required: tuple[str, ...] = ()
    unknown: str = "OTHER"

    def apply(self, df: DataFrame) -> DataFrame:
        for column, prefixes in self.noise.items():
            for p in prefixes:
                df = df.where(~F.coalesce(F.upper(F.trim(column)).startswith(p.upper()), F.lit(False)))
        out = {new: F.col(f"`{old}`") for new, old in self.columns.items()}
        for name, table in self.codes.items():
            known = F.create_map(*[x for k, v in table.items() for x in (F.lit(k), F.lit(v))])
            out[name] = F.coalesce(known[F.upper(F.trim(out[name]))], F.lit(self.unknown))
        out |= {k: F.lit(v) for k, v in self.constants.items()}
        if self.parties:
            out["parties"] = F.flatten(F.array(*[self._named(c, role) for c, role in self.parties.items()]))
        rows = df.select(*[c.alias(k) for k, c in out.items()])
        for name in self.required:
            rows = rows.where(non_blank(F.col(name).cast("string")).isNotNull())
        return rows

    def _named(self, column: str, role: str) -> Column:
        names = F.transform(F.split(F.coalesce(F.col(column), F.lit("")), ";"), lambda n: F.trim(n))
        kept = F.filter(names, lambda n: (n != "") & ~F.upper(n).isin([p.upper() for p in self.placeholders]))
        return F.transform(kept, lambda n: F.struct(n.alias("name"), F.lit(role).alias("role")))


class Registry:
    """Adapters or translators by name; a name cannot be taken twice unless by force."""

    def __init__(self) -> None:
        self.known: dict[str, Adapter | Callable[[DataFrame], DataFrame]] = {}

    def register(self, name: str, adapter: Adapter | Callable[[DataFrame], DataFrame], force: bool = False) -> None:
        if name in self.known and not force:
            raise ValueError(f"{name} is registered")
        self.known[name] = adapter

    def lookup(self, name: str) -> Callable[[DataFrame], DataFrame]:
        if name not in self.known:
            raise KeyError(name)
        found = self.known[name]
        return found.apply if isinstance(found, Adapter) else found
