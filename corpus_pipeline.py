"""Corpus preparation, stage by stage; the stages are in ``coverledger.llm.pipeline``."""

from __future__ import annotations

from coverledger.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
