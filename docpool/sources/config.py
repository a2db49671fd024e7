"""Small inputs that are read on the driver: configurations, ratios, manifests."""

from __future__ import annotations

import json
import math
import os
from dataclasses import dataclass, field

BOUNDLESS = 10**18


@dataclass(frozen=True)
class GatesConfig:
    """Bounds are inclusive; an allow-list of None lets everything but DROP pass, an empty one nothing."""

    min_image_num: int = 1
    max_image_num: int = BOUNDLESS
    token_total_min: int = 0
    token_total_max: int = BOUNDLESS
    layout_decision_ok: frozenset[str] | None = None
    layout_score_min: float = -math.inf
    nsfw_gate_enabled: bool = True
    nsfw_decision_ok: frozenset[str] | None = None
    nsfw_score_max: float = math.inf
    languages_ok: frozenset[str] | None = None
    chapter_level: int | None = None


@dataclass(frozen=True)
class SliceParams:
    min_page_num: int = 15
    max_page_num: int = 100
    min_imgs_count: int = 1
    min_texts_len: int = 100


@dataclass(frozen=True)
class MakeDataConfig:
    gates: GatesConfig = field(default_factory=GatesConfig)
    run_mode: str = "make_data"
    dedupe: bool = True
    emit_original_when_split_empty: bool = True
    split_enabled: bool = False
    split_records: bool = True
    slices: SliceParams = field(default_factory=SliceParams)


def allow_list(value: str | list | None) -> frozenset[str] | None:
    """None and "" are no list; a string is a list of one."""
    if value is None or value == "":
        return None
    return frozenset([value] if isinstance(value, str) else map(str, value))


def comma_list(value: str | None) -> frozenset[str] | None:
    """A list on the command line: cut at commas, not trimmed."""
    return frozenset(value.split(",")) if value else None


def gates_from_dict(given: dict | None) -> GatesConfig:
    given = given or {}
    base = GatesConfig()

    def get(name: str, cast: type):
        value = given.get(name)
        return getattr(base, name) if value is None else cast(value)

    lists = {k: allow_list(given.get(k)) for k in ("layout_decision_ok", "nsfw_decision_ok", "languages_ok")}
    numbers = {k: get(k, int) for k in ("min_image_num", "max_image_num", "token_total_min", "token_total_max", "chapter_level")}
    return GatesConfig(**lists, **numbers, layout_score_min=get("layout_score_min", float), nsfw_score_max=get("nsfw_score_max", float), nsfw_gate_enabled=get("nsfw_gate_enabled", bool))


def make_config_from_dict(given: dict) -> MakeDataConfig:
    split, base = given.get("chapter_split") or {}, SliceParams()
    names = ("min_page_num", "max_page_num", "min_imgs_count", "min_texts_len")
    return MakeDataConfig(
        gates=gates_from_dict(given.get("gates")),
        run_mode=str(given.get("run_mode", "make_data")),
        dedupe=bool(given.get("dedupe_pdf_md5", True)),
        emit_original_when_split_empty=bool(given.get("emit_original_when_split_empty", True)),
        split_enabled=bool(split.get("enabled", False)),
        # records of the pool can be split in every reading mode that reads records
        split_records=str(split.get("read_mode", "read_record")).startswith("read_"),
        slices=SliceParams(**{n: int(split.get(n, getattr(base, n))) for n in names}),
    )


def load_make_config(path: str | None) -> MakeDataConfig:
    """The configuration in a JSON file; defaults without a file."""
    if not path:
        return MakeDataConfig()
    with open(path, encoding="utf-8") as f:
        return make_config_from_dict(json.load(f))


def parse_ratios(given: str) -> dict[str, float]:
    """Category ratios, as JSON or in a file of that name; what is no number is left out."""
    if os.path.exists(given):
        with open(given, encoding="utf-8") as f:
            data = json.load(f)
    else:
        data = json.loads(given)
    if not isinstance(data, dict):
        raise ValueError("ratios must be a JSON object")
    ratios = {k: float(v) for k, v in data.items() if isinstance(v, int | float)}
    if not ratios:
        raise ValueError("no ratio is a number")
    return ratios


def quotas(ratios: dict[str, float], total: int) -> dict[str, int]:
    """Whole numbers in proportion to the ratios, by largest remainder; ties go to the larger code."""
    if total <= 0:
        raise ValueError("the sample's size must be over 0")
    whole = sum(v for v in ratios.values() if v > 0)
    if whole <= 0:
        raise ValueError("the ratios' sum must be over 0")
    shares = {k: v / whole * total for k, v in ratios.items() if v > 0}
    out = {k: int(v) for k, v in shares.items()}
    left = total - sum(out.values())
    for _, k in sorted(((shares[k] - out[k], k) for k in shares), reverse=True)[: max(0, left)]:
        out[k] += 1
    return {k: n for k, n in out.items() if n}
