"""Switches of the engine; the defaults are the shipped profile."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class EngineConfig:
    """on: shipped on; the others are off, some because they were measured to harm or to do nothing."""

    reason_adjudication: bool = True
    stamp_rescue: bool = True
    snap_repairs: bool = True
    menu_fill: bool = True
    menu_fusion: bool = True
    synthesis_reader: bool = True
    strip_pass: bool = True
    escalation_views: bool = False
    rotation_probe: bool = False
    note_rescue: bool = False
    joint_names: bool = False
    menu_margin: bool = False
    discharge: bool = False
    discharge_fee: bool = True
    discharge_arrival: bool = True
    discharge_sole_gap: bool = True
    cross_channel_veto: bool = False
    row_restore: bool = False
    user_words: bool = False

    @classmethod
    def from_options(cls, options: Mapping[str, str]) -> EngineConfig:
        """Switches by name: "1", "true", "yes" and "on" turn one on, "0", "false", "no" and "off" turn it off; others are errors."""
        words = {"1": True, "true": True, "yes": True, "on": True, "0": False, "false": False, "no": False, "off": False}
        names = {f.name for f in fields(cls)}
        unknown = set(options) - names
        if unknown:
            raise ValueError(f"no such switch: {sorted(unknown)}")
        return cls(**{k: words[v.strip().lower()] for k, v in options.items()})

    def active(self, name: str) -> bool:
        """A switch; parts of the discharge heads need the heads' own switch too."""
        return getattr(self, name) and (not name.startswith("discharge_") or self.discharge)
