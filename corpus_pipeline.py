"""A training corpus made from raw documents: five stages, each over all that the one before it kept.

    run(spark, "/data/sf")      # stages in turn, each written as Parquet and read again
"""

from __future__ import annotations

from martloom.llm.pipeline import ORACLE_SQL, STAGES, run
from martloom.llm.scratch import stored

__all__ = ["ORACLE_SQL", "STAGES", "run", "stored"]
