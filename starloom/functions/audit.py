"""The audit block at the tail of every table."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AUDIT_COLUMNS = ("etl_job_id", "etl_run_id", "etl_task_name", "etl_updated_at")

# Run variable, environment variable, default.
SETTINGS = (
    ("etl_job_id", "DBT_ETL_JOB_ID", "local"),
    ("etl_run_id", "DBT_ETL_RUN_ID", "local"),
    ("etl_task_name", "DBT_ETL_TASK_NAME", "manual"),
)


@dataclass(frozen=True)
class Audit:
    """Who wrote a row and when. One instance per run, so all its tables carry one stamp."""

    etl_job_id: str
    etl_run_id: str
    etl_task_name: str
    etl_updated_at: datetime

    @classmethod
    def of_run(cls, variables: Mapping[str, str] | None = None, environ: Mapping[str, str] | None = None) -> Audit:
        """Run variable first, then the environment, then the default.

        An empty run variable counts as not given; an empty environment variable is a value.
        """
        given = variables or {}
        env = os.environ if environ is None else environ
        values = {name: given.get(name) or env.get(variable, default) for name, variable, default in SETTINGS}
        return cls(**values, etl_updated_at=datetime.now(timezone.utc))

    def columns(self) -> list[Column]:
        return [F.lit(getattr(self, name)).alias(name) for name in AUDIT_COLUMNS]

    def on(self, df: DataFrame) -> DataFrame:
        return df.select("*", *self.columns())
