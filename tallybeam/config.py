"""Configuration of a search: plain data, read from YAML or JSON, with a content hash."""

from __future__ import annotations

import dataclasses
import json
from dataclasses import dataclass, field
from typing import Any, get_type_hints

from tallybeam.operators.bank import content_hash


@dataclass
class Gating:
    threshold: float = 50.0
    pad_s: float = 0.25
    longest_s: float = 2.0


@dataclass
class Conditioning:
    rate: float = 2048.0
    highpass: float = 15.0
    low_frequency: float = 20.0
    segment_s: float = 64.0
    skip_s: float = 0.0
    notches: list[tuple[float, float]] = field(default_factory=list)


@dataclass
class Bank:
    method: str = "stochastic"
    mass1: tuple[float, float] = (10.0, 80.0)
    mass2: tuple[float, float] = (10.0, 80.0)
    min_match: float = 0.97
    mismatch: float = 0.03
    f_lower: float = 20.0
    quick: bool = False
    cap: int = 256
    #: Spins of a grid bank; the path of a stored bank.
    spins: list[float] = field(default_factory=list)
    path: str | None = None
    #: A folder that keeps built banks by their parameters.
    cache: str | None = None


@dataclass
class Background:
    slides: int = 200
    spacing_s: float = 0.1
    window_s: float = 0.015
    excise_above: float = 12.0
    excise_s: float = 4.0
    same_template: bool = True
    #: Windows of pairs of sensors, as "H1,L1": seconds; others get window_s.
    pair_windows_s: dict[str, float] = field(default_factory=dict)
    #: Slides of the second and third sensor in a search for triples.
    strategy: str = "diagonal"
    fraction: float = 0.1


@dataclass
class Runtime:
    ifos: tuple[str, ...] = ("H1", "L1")
    threshold: float = 8.0
    chisq_from: float = 9.0
    cluster_s: float = 1.0
    block_s: float = 512.0
    dedup_s: float = 1.0
    tolerance_s: float = 1.0
    #: pairs of all sensors, or triples of the first three.
    network: str = "pairs"
    start_mode: str = "latest"
    start_s: float | None = None
    lookback_s: float = 7 * 86_400.0
    direction: str = "forward"
    backward_stop_s: float | None = None
    follow: bool = False
    poll_s: float = 60.0
    stop_file: str | None = None
    templates_per_task: int = 16


@dataclass
class Config:
    gating: Gating = field(default_factory=Gating)
    conditioning: Conditioning = field(default_factory=Conditioning)
    bank: Bank = field(default_factory=Bank)
    background: Background = field(default_factory=Background)
    runtime: Runtime = field(default_factory=Runtime)

    @classmethod
    def of(cls, data: dict[str, Any]) -> Config:
        """Sections by name; unknown names are errors, given values stay even if they are 0 or empty."""
        return _build(cls, data)

    @classmethod
    def from_text(cls, text: str) -> Config:
        """YAML where the library is there, else JSON."""
        try:
            import yaml
        except ImportError:
            return cls.of(json.loads(text))
        return cls.of(yaml.safe_load(text) or {})

    def to_json(self) -> str:
        return json.dumps(dataclasses.asdict(self), sort_keys=True)

    def hash(self) -> str:
        return content_hash(dataclasses.asdict(self))


def _build(kind: type, data: dict[str, Any]) -> Any:
    hints = get_type_hints(kind)
    if unknown := set(data) - set(hints):
        raise ValueError(f"{kind.__name__} has no {', '.join(sorted(unknown))}")
    made = {}
    for name, value in data.items():
        made[name] = _build(hints[name], value) if dataclasses.is_dataclass(hints[name]) else tuple(value) if str(hints[name]).startswith("tuple") else value
    return kind(**made)
