"""Kinds of assistant interaction and the factors that go with them; which there are is up to the deployment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from decimal import Decimal
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class KindRule(NamedTuple):
    """``kind`` where ``source`` ("app" or "agent") equals one of ``values`` or, with ``prefix``, begins with one."""

    kind: str
    source: str
    values: Sequence[str]
    prefix: bool = False


class Factors(NamedTuple):
    """What goes with a kind: its use-case code (None: that of the other kinds), automation, hours saved a request."""

    code: str | None
    automation: str
    hours: str


@dataclass(frozen=True)
class Interactions:
    """The first rule that fits names the kind; ``other`` is the kind of all else."""

    rules: Sequence[KindRule] = ()
    factors: Mapping[str, Factors] = field(default_factory=dict)
    other: str = "Other"

    def kind(self, app: Column, agent: Column) -> Column:
        found = []
        for rule in self.rules:
            value = {"app": app, "agent": agent}[rule.source]
            for text in rule.values:
                found.append(F.when(value.startswith(text) if rule.prefix else value == text, F.lit(rule.kind)))
        return F.coalesce(*found, F.lit(self.other))

    def use_case_code(self, kind: Column) -> Column:
        """Unknown and missing kinds, and kinds without a code, get the code of ``other``."""
        codes = {name: F.lit(f.code) for name, f in self.factors.items() if f.code is not None}
        fallback = self.factors[self.other].code if self.other in self.factors else None
        return F.coalesce(_pick(codes, kind, "string"), F.lit(fallback).cast("string"))

    def automation_factor(self, kind: Column) -> Column:
        return self._factor({name: f.automation for name, f in self.factors.items()}, kind)

    def hours_saved_factor(self, kind: Column) -> Column:
        return self._factor({name: f.hours for name, f in self.factors.items()}, kind)

    @staticmethod
    def _factor(texts: Mapping[str, str], kind: Column) -> Column:
        """NULL for unknown and missing kinds."""
        return _pick({name: F.lit(Decimal(text)).cast("decimal(18,8)") for name, text in texts.items()}, kind, "decimal(18,8)")


def hours_saved(requests: Column, hours: Column, multiplier: Column) -> Column:
    return requests.cast("decimal(18,8)") * hours * multiplier


def hours_total(requests: Column, hours: Column, automation: Column) -> Column:
    return requests.cast("decimal(18,8)") * F.try_divide(hours, automation)


def _pick(values: Mapping[str, Column], kind: Column, dtype: str) -> Column:
    if not values:
        return F.lit(None).cast(dtype)
    pairs = [item for name, value in values.items() for item in (F.lit(name), value)]
    return F.try_element_at(F.create_map(*pairs), kind)
