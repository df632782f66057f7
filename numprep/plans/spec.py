"""What to do with each column: bounds, affixes, rounding, and how to treat values out of range."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, replace
from pathlib import Path

from numprep.functions.numbers import NUMBER_TEXT

Bound = bool | int | float | str

_CONVERTER_KEYS = ("min_val", "max_val", "clip_oor", "prefix", "suffix", "rounding", "strict_affix")
_NORMALIZER_KEYS = ("clip", "reject")


@dataclass(frozen=True)
class ColumnSpec:
    """Settings of one column.

    A bound is ``False`` (none), ``True`` (taken from the data), a number, or text with the column's affixes.
    ``0`` and ``1`` are numbers, not ``False`` and ``True``. ``clip_oor`` clamps values to the bounds; without
    it the inverse marks values beyond them. ``clip`` clamps to the fitted range and to [0, 1]; ``reject``
    marks inverse input beyond [0, 1]. ``rounding=None`` turns rounding off. ``strict_affix`` accepts only
    text that carries exactly these affixes; without it that many characters are dropped unseen.
    """

    column: str
    min_val: Bound = False
    max_val: Bound = False
    clip_oor: bool = True
    prefix: str = ""
    suffix: str = ""
    rounding: int | None = 6
    clip: bool = False
    reject: bool = False
    strict_affix: bool = False

    def __post_init__(self) -> None:
        for name in ("clip_oor", "clip", "reject", "strict_affix"):
            if not isinstance(getattr(self, name), bool):
                raise ValueError(f"{self.column}: {name} must be true or false")
        for name in ("prefix", "suffix"):
            if not isinstance(getattr(self, name), str):
                raise ValueError(f"{self.column}: {name} must be text")
        if self.rounding is not None and (isinstance(self.rounding, bool) or not isinstance(self.rounding, int)):
            raise ValueError(f"{self.column}: rounding must be a whole number or null")
        for name in ("min_val", "max_val"):
            object.__setattr__(self, name, self._bound(name))
        low, high = self.fixed_min, self.fixed_max
        if low is not None and high is not None and low > high:
            raise ValueError(f"{self.column}: min_val {low} is above max_val {high}")

    def _bound(self, name: str) -> bool | float:
        value = getattr(self, name)
        if isinstance(value, bool):
            return value
        if isinstance(value, str):
            return self._number_in(name, value)
        if not isinstance(value, (int, float)) or math.isnan(value):
            raise ValueError(f"{self.column}: {name} must be a number, text, true or false")
        return float(value) if math.isfinite(value) else False

    def _number_in(self, name: str, text: str) -> float:
        bare = text[len(self.prefix) : len(text) - len(self.suffix)]
        affixed = text.startswith(self.prefix) and text.endswith(self.suffix)
        if not affixed or not re.match(NUMBER_TEXT, bare):
            raise ValueError(f"{self.column}: {name} {text!r} is no number with this prefix and suffix")
        return float(bare)

    @property
    def fixed_min(self) -> float | None:
        return None if isinstance(self.min_val, bool) else self.min_val

    @property
    def fixed_max(self) -> float | None:
        return None if isinstance(self.max_val, bool) else self.max_val


def load_specs(
    config: Mapping[str, Mapping] | Iterable[ColumnSpec] | str | Path, columns: Iterable[str] | None = None
) -> list[ColumnSpec]:
    """Specs from ``{column: {converter: {...}, normalizer: {...}}}``, from such a YAML or JSON file, or as given.

    ``columns`` keeps only those, and an unknown name among them is an error.
    """
    if isinstance(config, (str, Path)):
        config = _read_config(Path(config))
    if isinstance(config, Mapping):
        specs = [_spec(column, sections or {}) for column, sections in config.items()]
    else:
        specs = list(config)
    names = [spec.column for spec in specs]
    if len(set(names)) != len(names):
        raise ValueError("a column is configured twice")
    if columns is None:
        return specs
    wanted = list(columns)
    unknown = [name for name in wanted if name not in names]
    if unknown:
        raise ValueError(f"columns not configured: {', '.join(unknown)}")
    return [spec for spec in specs if spec.column in wanted]


def _spec(column: str, sections: Mapping) -> ColumnSpec:
    spec = ColumnSpec(column)
    for section, keys in (("converter", _CONVERTER_KEYS), ("normalizer", _NORMALIZER_KEYS)):
        values = sections.get(section) or {}
        unknown = [key for key in values if key not in keys]
        if unknown:
            raise ValueError(f"{column}: unknown {section} settings: {', '.join(unknown)}")
    settings = {**(sections.get("converter") or {}), **(sections.get("normalizer") or {})}
    unknown = [key for key in sections if key not in ("converter", "normalizer")]
    if unknown:
        raise ValueError(f"{column}: unknown sections: {', '.join(unknown)}")
    return replace(spec, **settings)


def _read_config(path: Path) -> Mapping:
    text = path.read_text(encoding="utf-8")
    if path.suffix == ".json":
        return json.loads(text)
    try:
        import yaml
    except ImportError as missing:
        raise RuntimeError("PyYAML is needed to read a YAML configuration; JSON works without it") from missing
    return yaml.safe_load(text)
