"""A corpus pipeline of five stages over `documents`: see `staygrid.llm.pipeline`."""

from __future__ import annotations

from staygrid.llm.pipeline import MIX_SHARE, ORACLE_SQL, STAGES, mixing_stage, near_dedup_stage, packing_stage, quality_stage, run, substring_stage

__all__ = ["MIX_SHARE", "ORACLE_SQL", "STAGES", "mixing_stage", "near_dedup_stage", "packing_stage", "quality_stage", "run", "substring_stage"]
