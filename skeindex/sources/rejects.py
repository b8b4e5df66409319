"""One table of what flows leave out: lines, pages, texts and chunks, with reason, source and detail.

Rejects are written from what a flow has computed and stored anyway, and counted by the pass that writes them.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from skeindex.sources.objects import read_if_present

log = logging.getLogger(__name__)

SCHEMA = "reason string, source string, detail string, run string"
BROKEN_LINE, FAILED_PAGE, NO_TERMS, FAILED_TEXT = "broken line", "failed page", "no terms", "failed text"


@dataclass(frozen=True)
class RejectLog:
    """The table at ``root``; ``run`` names what is done with it now."""

    root: str
    run: str = ""

    def write(self, rows: DataFrame, reason: str, source: Column, detail: Column) -> int:
        """Append ``rows`` as rejects of one reason; their number, as observed while they were written."""
        seen = Observation(reason)
        found = rows.select(F.lit(reason).alias("reason"), source.cast("string").alias("source"), detail.alias("detail"), F.lit(self.run).alias("run"))
        found.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(self.root)
        if seen.get["rows"]:
            log.warning("%d rows rejected: %s", seen.get["rows"], reason)
        return seen.get["rows"]

    def read(self, spark: SparkSession) -> DataFrame:
        """All rejects so far."""
        found = read_if_present(spark, self.root, SCHEMA)
        return spark.createDataFrame([], SCHEMA) if found is None else found
