"""Typed settings: loaded from plain mappings, checked, fingerprinted; limits of a run; waits between tries."""

from __future__ import annotations

import dataclasses
import hashlib
import json
import time
from dataclasses import dataclass, field
from typing import Any, get_args, get_type_hints

from .filters import FilterProfile
from .packaging import check_ratios


@dataclass(frozen=True)
class Shards:
    prefix: str = "corpus"
    target_bytes: int = 200_000_000
    folder: str = "shards"


@dataclass(frozen=True)
class Deduplication:
    exact: bool = True
    fuzzy: bool = False
    threshold: float = 0.8
    permutations: int = 128
    shingle_words: int = 5


@dataclass(frozen=True)
class Packing:
    length: int = 4096
    eos: int = 0
    split_ratios: tuple[float, ...] = (0.98, 0.01, 0.01)
    seed: str = "v1-stable"
    type_ratios: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Limits:
    """Nothing is limited by 0."""

    max_items: int = 0
    max_runtime_s: int = 0
    max_bytes_written: int = 0
    max_failed_items: int = 0


@dataclass(frozen=True)
class Config:
    """Everything a run depends on."""

    filters: FilterProfile = FilterProfile()
    shards: Shards = Shards()
    dedup: Deduplication = Deduplication()
    packing: Packing = Packing()
    limits: Limits = Limits()


def load_config(values: dict[str, Any], of: type = Config, at: str = "") -> Any:
    """``of`` from nested mappings; unknown names, wrong types and values out of range raise ``ValueError`` with their place, missing ones keep their default."""
    known = {f.name: f for f in dataclasses.fields(of)}
    hints = get_type_hints(of)
    if extra := sorted(set(values) - set(known)):
        raise ValueError(f"unknown settings: {', '.join(at + x for x in extra)}")
    made = {}
    for name, value in values.items():
        kind, place = hints[name], at + name
        if dataclasses.is_dataclass(kind):
            if not isinstance(value, dict):
                raise ValueError(f"{place}: a mapping is needed")
            made[name] = load_config(value, kind, place + ".")
            continue
        plain = getattr(kind, "__origin__", kind)
        if plain is float and isinstance(value, int) and not isinstance(value, bool):
            value = float(value)
        if plain is tuple and isinstance(value, list):
            value = tuple(value)
        if not isinstance(value, plain) or (isinstance(value, bool) and plain is not bool):
            raise ValueError(f"{place}: {plain.__name__} is needed, not {type(value).__name__}")
        if plain is tuple and not all(isinstance(x, get_args(kind)[0]) for x in value):
            raise ValueError(f"{place}: wrong element")
        if isinstance(value, (int, float)) and not isinstance(value, bool) and value < 0:
            raise ValueError(f"{place}: must not be negative")
        made[name] = value
    out = of(**made)
    if isinstance(out, FilterProfile):
        for name in ("min_confidence", "max_url_ratio", "max_repeated_lines", "min_alpha_ratio", "max_ngram_2", "max_ngram_3", "max_ngram_4", "max_non_latin"):
            if getattr(out, name) > 1:
                raise ValueError(f"{at}{name}: must be at most 1")
        if out.min_chars > out.max_chars:
            raise ValueError(f"{at}min_chars: must not be above max_chars")
    if isinstance(out, Packing):
        if len(out.split_ratios) != 3 or abs(sum(out.split_ratios) - 1) > 1e-6:
            raise ValueError(f"{at}split_ratios: three shares that add up to 1")
        if out.type_ratios:
            check_ratios(out.type_ratios)
    return out


def fingerprint(config: Any) -> str:
    """SHA-256 of the settings as canonical JSON; equal for equal settings whatever their order."""
    plain = dataclasses.asdict(config) if dataclasses.is_dataclass(config) else config
    return hashlib.sha256(json.dumps(plain, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


class Guardrails:
    """Stops a run between its steps: counts what is done against :class:`Limits`, in a fixed order of checks."""

    def __init__(self, limits: Limits, clock=time.monotonic):
        self.limits, self.clock, self.start = limits, clock, clock()
        self.items = self.bytes = self.failed = 0

    def add(self, items: int = 0, bytes_written: int = 0, failed: int = 0) -> None:
        self.items += items
        self.bytes += bytes_written
        self.failed += failed

    def reached(self) -> str:
        """The first limit that is reached, with both numbers; empty if none is."""
        now = (("max_items", self.items), ("max_runtime_s", int(self.clock() - self.start)), ("max_bytes_written", self.bytes), ("max_failed_items", self.failed))
        for name, value in now:
            most = getattr(self.limits, name)
            if 0 < most <= value:
                return f"guardrail.{name}: {value} >= {most}"
        return ""


def waits(tries: int, base: float, exponential: bool = True) -> list[float]:
    """Seconds to wait after each failed try: ``base * 2^k``, or ``base * k`` from 1."""
    return [base * 2**k if exponential else base * (k + 1) for k in range(tries)]

