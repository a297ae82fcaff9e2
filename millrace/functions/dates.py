"""Named date rules: what a rule makes of a date, and how the result moves off days that are closed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import scalars as S


def _closed(c: Column, closed: list[str]) -> Column:
    return (F.weekday(c) >= 5) | F.date_format(c, "MM-dd").isin(closed)


def _walk(c: Column, closed: list[str], step: int) -> Column:
    """The first date that is not closed, going by ``step`` days; the date itself if there is none in a round of all closed days and weekends."""
    steps = F.sequence(F.lit(0), F.lit(9 + 2 * len(closed)))
    first = F.get(F.filter(steps, lambda i: ~_closed(F.date_add(c, i * step), closed)), 0)
    return F.date_add(c, F.coalesce(first, F.lit(0)) * step)


def shifted(c: Column, mode: str, closed: list[str] = ()) -> Column:
    """The date moved off weekends and closed days ("MM-dd"): ``none``, ``next``, ``previous``, ``nearest`` (next if both are as near) or ``week`` (whole weeks on).

    ``listed:Wed``, ``listed:next`` and ``listed:previous`` move off the closed days only, once: to the next such weekday, or the working day after or before."""
    closed = list(closed)
    if mode == "none":
        return c
    if mode == "next":
        return _walk(c, closed, 1)
    if mode == "previous":
        return _walk(c, closed, -1)
    if mode == "nearest":
        after, before = _walk(c, closed, 1), _walk(c, closed, -1)
        return F.when(F.date_diff(after, c) <= F.date_diff(c, before), after).otherwise(before)
    if mode == "week":
        return _walk(c, closed, 7)
    if mode.startswith("listed:"):
        return _listed(c, mode.removeprefix("listed:"), closed)
    raise ValueError(f"no such mode: {mode}")


def _listed(c: Column, to: str, closed: list[str]) -> Column:
    """A date that is one of the closed days moves once, to the next such weekday (``Wed``) or the ``next`` or ``previous`` working day; all others stay, weekends too."""
    if to == "next":
        moved = S.business_day(F.date_add(c, 1))
    elif to == "previous":
        before = F.date_add(c, -1)
        moved = F.date_add(before, -F.greatest(F.weekday(before) - 4, F.lit(0)))
    else:
        moved = F.next_day(c, to)
    return F.when(F.date_format(c, "MM-dd").isin(closed), moved).otherwise(c) if closed else c


class DateRules:
    """Rules by name. A name that is not registered means the first of the month."""

    def __init__(self) -> None:
        self.rules: dict[str, Callable[[Column], Column]] = {"first_of_month": lambda c: F.trunc(c, "MM"), "last_of_month": F.last_day, "first_business_day": lambda c: S.business_day(F.trunc(c, "MM"))}
        for day in ("Mon", "Tue", "Wed", "Thu", "Fri"):
            self.rules[f"first_{day.lower()}"] = lambda c, day=day: S.first_weekday(c, day)

    def register(self, name: str, rule: Callable[[Column], Column], force: bool = False) -> None:
        if name in self.rules and not force:
            raise ValueError(f"{name} is registered")
        self.rules[name] = rule

    def apply(self, name: str, c: Column, mode: str = "none", closed: list[str] = ()) -> Column:
        return shifted(self.rules.get(name, self.rules["first_of_month"])(c), mode, closed)

    def by(self, rule: Column, c: Column, mode: str = "none", closed: list[str] = ()) -> Column:
        """As ``apply``, with the rule's name in a column. The rules are told apart first and their date is moved once."""
        out = F
        for name in self.rules:
            out = out.when(rule == name, self.apply(name, c))
        return shifted(out.otherwise(self.apply("", c)), mode, closed)
