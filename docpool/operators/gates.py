"""Quality gates as one expression over flat columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docpool.sources.config import GatesConfig


def _yes(c: Column) -> Column:
    """A condition whose null is no."""
    return F.coalesce(c, F.lit(False))


def _decision(c: Column, allowed: frozenset[str] | None) -> Column:
    return c != "DROP" if allowed is None else c.isin(*sorted(allowed)) if allowed else F.lit(False)


def images_pass(cfg: GatesConfig) -> Column:
    return _yes(F.col("image_num").between(cfg.min_image_num, cfg.max_image_num))


def tokens_pass(cfg: GatesConfig) -> Column:
    return _yes(F.col("token_total").between(cfg.token_total_min, cfg.token_total_max))


def layout_pass(cfg: GatesConfig) -> Column:
    """NaN is below no bound."""
    score = F.col("layout_score")
    return _yes(_decision(F.col("layout_decision"), cfg.layout_decision_ok) & (F.isnan(score) | (score >= cfg.layout_score_min)))


def nsfw_pass(cfg: GatesConfig) -> Column:
    """Without a decision only an allow-list rejects; NaN is over no bound."""
    if not cfg.nsfw_gate_enabled:
        return F.lit(True)
    decision, score = F.col("nsfw_decision"), F.col("nsfw_score")
    judged = _yes(_decision(decision, cfg.nsfw_decision_ok) & (F.isnan(score) | (score <= cfg.nsfw_score_max)))
    return F.when(decision.isNull() | score.isNull(), F.lit(cfg.nsfw_decision_ok is None)).otherwise(judged)


def language_pass(cfg: GatesConfig) -> Column:
    if cfg.languages_ok is None:
        return F.lit(True)
    return _yes(F.col("language").isin(*sorted(cfg.languages_ok))) if cfg.languages_ok else F.lit(False)


def chapter_pass(cfg: GatesConfig, allow_missing: bool = False) -> Column:
    if cfg.chapter_level is None or allow_missing:
        return F.lit(True)
    return _yes(F.array_contains("levels", cfg.chapter_level))


def gates(cfg: GatesConfig, allow_missing_chapters: bool = False) -> dict[str, Column]:
    """The gates in the order in which a record's reason for rejection is named."""
    return {"images": images_pass(cfg), "tokens": tokens_pass(cfg), "layout": layout_pass(cfg), "nsfw": nsfw_pass(cfg), "language": language_pass(cfg), "chapter": chapter_pass(cfg, allow_missing_chapters)}


def passes(cfg: GatesConfig, allow_missing_chapters: bool = False) -> Column:
    return reduce(Column.__and__, gates(cfg, allow_missing_chapters).values())


def reject_reason(cfg: GatesConfig, allow_missing_chapters: bool = False) -> Column:
    """The first gate that a record fails, null if it passes."""
    return F.coalesce(*[F.when(~ok, F.lit(name)) for name, ok in gates(cfg, allow_missing_chapters).items()])


def gated(records: DataFrame, cfg: GatesConfig, allow_missing_chapters: bool = False) -> DataFrame:
    return records.where(passes(cfg, allow_missing_chapters))


def eligible(records: DataFrame, cfg: GatesConfig) -> DataFrame:
    """Gated records that can be sampled: they have a fingerprint and a category."""
    return gated(records, cfg).where("pdf_md5 <> '' and category_code <> ''")


#: Spellings of the two languages that the share counts.
TWO_LANGUAGES = ("zh", "zh-cn", "zh_cn", "chinese", "en", "english")


def parsed_with_images() -> Column:
    """Chinese or English, with images, and a layout that was parsed."""
    return _yes(F.lower("language").isin(*TWO_LANGUAGES) & (F.col("image_num") > 0) & (F.upper("layout_decision") == "PARSE"))
