"""Sensor registry: which sensor belongs to which domain and how it rolls up.

The registry is a handful of rows, so it is applied as literal map
expressions (one constant ``map(..)``) rather than as a join: no shuffle,
no broadcast, and the lookup stays inside whole-stage codegen.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Sensor:
    name: str
    topic: str
    domain: str
    kind: str  # "gauge", "counter" or "flag"
    how: str  # daily roll-up: "sum", "avg" or "diff" (counter difference)


# The sensors of the household, their topics, domains and
# daily roll-ups, as the reference's simulator and streaming jobs use them.
HOUSEHOLD = (
    Sensor("HVAC1", "IoT/energy/Airconditioning/HVAC1", "energy", "gauge", "sum"),
    Sensor("HVAC2", "IoT/energy/Airconditioning/HVAC2", "energy", "gauge", "sum"),
    Sensor("MiAC1", "IoT/energy/Rest_appliances/MiAC1", "energy", "gauge", "sum"),
    Sensor("MiAC2", "IoT/energy/Rest_appliances/MiAC2", "energy", "gauge", "sum"),
    Sensor("Etot", "IoT/energy/Etot", "energy", "counter", "diff"),
    Sensor("W1", "IoT/water/W1", "water", "gauge", "sum"),
    Sensor("Wtot", "IoT/water/Wtot", "water", "counter", "diff"),
    Sensor("TH1", "IoT/temperature/TH1", "temp", "gauge", "avg"),
    Sensor("TH2", "IoT/temperature/TH2", "temp", "gauge", "avg"),
    Sensor("Mov1", "IoT/movement/Mov1", "temp", "flag", "sum"),
)

DOMAINS = ("energy", "water", "temp")


def map_literal(pairs) -> Column:
    """A constant ``MAP<STRING, STRING>`` column, built in one expression."""
    def q(v: str) -> str:
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return F.expr("map(" + ", ".join(f"{q(k)}, {q(v)}" for k, v in pairs) + ")")


def _lookup(sensors, field: str, key: Column) -> Column:
    return F.try_element_at(map_literal((s.name, getattr(s, field)) for s in sensors), key)


def domain_of(sensor: Column, sensors=HOUSEHOLD) -> Column:
    """Domain of a sensor name (NULL if unknown)."""
    return _lookup(sensors, "domain", sensor)


def how_of(sensor: Column, sensors=HOUSEHOLD) -> Column:
    """Daily roll-up of a sensor name: "sum", "avg" or "diff"."""
    return _lookup(sensors, "how", sensor)


def names(sensors=HOUSEHOLD, domain: str | None = None, kind: str | None = None,
          how: str | None = None) -> list[str]:
    return [s.name for s in sensors
            if (domain is None or s.domain == domain)
            and (kind is None or s.kind == kind)
            and (how is None or s.how == how)]


def topics(sensors=HOUSEHOLD, domain: str | None = None) -> list[str]:
    return [s.topic for s in sensors if domain is None or s.domain == domain]
