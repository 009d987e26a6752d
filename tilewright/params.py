"""Parameters of the selection pipeline, with defaults and checks."""

from __future__ import annotations

import hashlib
import logging
from dataclasses import asdict, dataclass, fields, replace

from tilewright.functions.seq import genetic_code

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Params:
    length: int = 75
    divergence: float = 0.15
    translation_table: int = 1
    reroot: bool = True
    name_pattern: str = ".+"
    guide_weight: float = 1.0
    penetrance: float = 50.0
    similarity: float = 75.0
    contiguity: int = 15
    candidates: int = 0
    gc_min: float = 30.0
    gc_max: float = 70.0
    tm_range: float = 10.0
    tm_min: float | None = None
    tm_max: float | None = None
    lcr_window: int = 64
    lcr_threshold: float = 20.0
    hit_identity: float = 75.0
    hit_length: int = 20
    density: int = 5
    probes: int = 0
    min_baits: int = 30
    flank: int = 25
    constant_tiling: bool = False
    max_regions: int = 0
    max_baits: int = 0
    auto_tune: bool = False

    def __post_init__(self) -> None:
        for low, high in (("gc_min", "gc_max"), ("tm_min", "tm_max")):
            a, b = getattr(self, low), getattr(self, high)
            if a is not None and b is not None and a > b:
                log.warning("%s and %s are swapped", low, high)
                object.__setattr__(self, low, b)
                object.__setattr__(self, high, a)
        if self.length < self.contiguity:
            raise ValueError("length must not be below contiguity")
        if self.translation_table:
            genetic_code(self.translation_table)
        for name, low, high in (("penetrance", 0, 100), ("similarity", 0, 100), ("gc_min", 0, 100), ("gc_max", 0, 100), ("divergence", 0, 1), ("density", 1, self.length)):
            if not low <= getattr(self, name) <= high:
                raise ValueError(f"{name} must be from {low} to {high}")

    @property
    def gc_bounds(self) -> tuple[int, int]:
        """Counts of G and C that pass: from the first, below the second."""
        return int(self.length * self.gc_min / 100), int(self.length * self.gc_max / 100 + 1)

    @property
    def max_identity(self) -> int:
        """Equal bases that two windows may have; one more is rejected."""
        return int(self.similarity * self.length // 100)

    @property
    def first(self) -> int:
        """Where the earliest window of a cluster begins."""
        return self.flank + 1

    def banner(self) -> str:
        """All parameters, a line each."""
        return "\n".join(f"{k}\t{'' if v is None else v}" for k, v in asdict(self).items())

    def digest(self) -> str:
        """Names a set of parameters: results kept under it hold for no other."""
        return hashlib.sha256(self.banner().encode()).hexdigest()[:16]

    def with_genomes(self, genomes: int) -> Params:
        return self if self.probes else replace(self, probes=100 * genomes)

    @classmethod
    def from_pairs(cls, pairs: dict[str, str]) -> Params:
        """From configuration text; unknown keys are named in a warning."""
        kinds = {f.name: f.type for f in fields(cls)}
        known = {}
        for key, value in pairs.items():
            name = key.replace("-", "_")
            if name not in kinds:
                log.warning("unknown setting %s", key)
            else:
                known[name] = value if "str" in kinds[name] else value.lower() in ("1", "true", "yes", "on") if kinds[name] == "bool" else (int(value) if kinds[name] == "int" else float(value))
        return cls(**known)
