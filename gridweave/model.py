"""Catalog entries as plain objects, for use outside DataFrames. Column functions do the same for whole catalogs."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from typing import Any

from gridweave.functions.hashing import signed_xxh3
from gridweave.functions.scalars import glob_pattern
from gridweave.operators.catalog import CURVE_TYPES, DATA_TYPES


def text_or_none(value: Any) -> str | None:
    text = "" if value is None else str(value).strip()
    return text or None


def texts(value: Any) -> tuple[str, ...]:
    items = [value] if isinstance(value, str) else (value or ())
    return tuple(t for t in map(text_or_none, items) if t)


def numbers(value: Any) -> tuple[float, ...]:
    return tuple(float(x) for x in value or () if x is not None)


def kind(value: Any, known: tuple[str, ...], default: str) -> str:
    """The name of a known kind; nothing and NONE are the default."""
    name = (text_or_none(value) or "NONE").upper()
    if name == "NONE":
        return default
    if name not in known:
        raise ValueError(f"unknown kind: {value}")
    return name


def utc_datetime(value: Any) -> dt.datetime | None:
    """Texts and times as UTC; without a zone they count as UTC."""
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value.strip().replace("Z", "+00:00")) if value.strip() else None
    if value is None:
        return None
    return value.replace(tzinfo=dt.timezone.utc) if value.tzinfo is None else value.astimezone(dt.timezone.utc)


def plain_name(value: Any) -> str:
    return re.sub(r"[^a-z0-9]+", "_", (value or "").lower()).strip("_")


@dataclass(frozen=True, slots=True)
class Resolution:
    frequency: str | None = None
    timezone: str | None = None


@dataclass(frozen=True, slots=True)
class Access:
    by: str | None = None
    package: str | None = None


@dataclass(frozen=True, slots=True)
class Subscription:
    access: str | None = None
    area: str | None = None
    label: str | None = None
    package: str | None = None
    type: str | None = None


@dataclass(frozen=True, slots=True)
class Place:
    type: str | None = None
    key: str | None = None
    name: str | None = None
    unit: str | None = None
    area: str | None = None
    areas: tuple[str, ...] = ()
    location: tuple[float, ...] = ()
    fuels: tuple[str, ...] = ()
    remit_units: tuple[str, ...] = ()


def parse_part(cls: type, value: Any):
    """One of the parts above from a mapping, an instance or nothing."""
    if value is None:
        return cls()
    if isinstance(value, cls):
        return value
    if not isinstance(value, Mapping):
        raise TypeError(f"expected {cls.__name__}, a mapping or None, got {type(value).__name__}")
    many = {"areas": texts, "fuels": texts, "remit_units": texts, "location": numbers}
    out = {k: many.get(k, text_or_none)(value.get(k)) for k in cls.__dataclass_fields__}
    if cls is Resolution and (out["frequency"] or "").lower() == "none":
        out["frequency"] = None
    return cls(**out)


@dataclass(frozen=True, slots=True)
class Curve:
    name: str = ""
    curve_type: str = "TIMESERIES"
    data_type: str = "NORMAL"
    area: str | None = None
    area_sink: str | None = None
    categories: tuple[str, ...] = ()
    commodity: str | None = None
    denominator: str | None = None
    source: str | None = None
    unit: str | None = None
    instance_issued_timezone: str | None = None
    access: Access = field(default_factory=Access)
    resolution: Resolution = field(default_factory=Resolution)
    subscription: Subscription = field(default_factory=Subscription)
    place: Place = field(default_factory=Place)

    @classmethod
    def parse(cls, value: Any) -> Curve:
        if isinstance(value, cls):
            return value
        if not isinstance(value, Mapping):
            raise TypeError(f"expected Curve or a mapping, got {type(value).__name__}")
        parts = {"access": Access, "resolution": Resolution, "subscription": Subscription, "place": Place}
        plain = {k: text_or_none(value.get(k)) for k in ("area", "area_sink", "commodity", "denominator", "source", "unit", "instance_issued_timezone")}
        return cls(text_or_none(value.get("name")) or "", kind(value.get("curve_type"), CURVE_TYPES, "TIMESERIES"), kind(value.get("data_type"), DATA_TYPES, "NORMAL"), categories=texts(value.get("categories")), **plain, **{k: parse_part(c, value.get(k)) for k, c in parts.items()})

    @property
    def id(self) -> int:
        """The hash of the name; 0 without one."""
        return signed_xxh3(self.name) if self.name else 0

    @property
    def is_instance(self) -> bool:
        return self.curve_type == "INSTANCE"

    @property
    def is_period_instance(self) -> bool:
        return self.curve_type == "INSTANCE_PERIOD"

    def cluster_key(self) -> str:
        return f"{plain_name(self.data_type)}_{plain_name(self.curve_type)}"

    def table_name(self, prefix: str = "") -> str:
        return "_".join(filter(None, [plain_name(prefix), self.cluster_key(), *map(plain_name, self.categories[:2])]))

    def tags(self) -> dict[str, str]:
        pairs = {k: getattr(self, k) for k in ("name", "area", "unit", "commodity", "data_type", "curve_type")}
        return {k: v for k, v in (pairs | {"categories": ",".join(self.categories)}).items() if v}


    def to_metadata_row(self, now: dt.datetime) -> dict[str, Any]:
        """The row of the catalog table; unlike whole catalogs', it tells the access too."""
        plain = {f"curve_{k}": getattr(self, k) for k in ("name", "curve_type", "data_type", "area", "area_sink", "commodity", "source", "unit", "denominator", "instance_issued_timezone")}
        plain["curve_type"] = plain.pop("curve_curve_type")
        nested = {"curve_resolution_frequency": self.resolution.frequency, "curve_resolution_timezone": self.resolution.timezone, "curve_access_by": self.access.by, "curve_access_package": self.access.package}
        return {"curve_id": self.id, **plain, **nested, "curve_categories": list(self.categories), "table_category": self.table_name(), "updated_at": now}


def find_curve(curve: Curve | str, known: Mapping[str, Curve]) -> Curve:
    """A curve, or the known one of that name; ValueError if there is none."""
    if isinstance(curve, Curve):
        return curve
    if curve not in known:
        raise ValueError(f"unknown curve: {curve}")
    return known[curve]


def iter_curves(curves: Curve | str | Iterable[Curve | str], known: Mapping[str, Curve]) -> Iterable[Curve]:
    """The curves meant by a curve, a name or glob, or several of these."""
    if isinstance(curves, Curve):
        yield curves
    elif isinstance(curves, str):
        if curves in known:
            yield known[curves]
        else:
            fits = re.compile(glob_pattern([curves]))
            yield from (c for name, c in known.items() if fits.search(name.lower()))
    else:
        for curve in curves:
            yield find_curve(curve, known)


@dataclass(frozen=True, slots=True)
class Instance:
    """One issue of a forecast curve."""

    curve: Curve
    issued_at: dt.datetime
    created_at: dt.datetime | None = None
    modified_at: dt.datetime | None = None
    tag: str | None = None
