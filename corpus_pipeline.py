"""The corpus pipeline: STAGES of (name, function), run(spark, sf_dir) and ORACLE_SQL. The stages themselves are in pulsemill.llm.stages."""

from __future__ import annotations

from pulsemill.llm.stages import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
