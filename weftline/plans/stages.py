"""Stages in order, with restart and stop, each result kept in the shared store."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from weftline.functions.seq import duration


@dataclass
class Plan:
    """Named stages; each takes (spark, tables so far) and returns a table under the stage's name.

    ``run`` starts at one stage and stops after another; what lies before the start is read back from ``store``. An
    earlier result of a stage that runs again is kept beside it as ``_previous``."""

    store: str
    stages: list[tuple[str, Callable[[SparkSession, dict[str, DataFrame]], DataFrame]]] = field(default_factory=list)
    times: dict[str, str] = field(default_factory=dict)

    def add(self, name: str, stage: Callable) -> Plan:
        if name in dict(self.stages):
            raise ValueError(f"stage {name} is there already")
        self.stages.append((name, stage))
        return self

    def run(self, spark: SparkSession, tables: dict[str, DataFrame], restart_from: str | None = None, stop_after: str | None = None) -> dict[str, DataFrame]:
        names = [n for n, _ in self.stages]
        for n in (restart_from, stop_after):
            if n is not None and n not in names:
                raise ValueError(f"no stage {n}: {', '.join(names)}")
        first = names.index(restart_from) if restart_from else 0
        last = names.index(stop_after) if stop_after else len(names) - 1
        if first > last:
            raise ValueError(f"{stop_after} comes before {restart_from}")
        out = dict(tables)
        for name in names[:first]:
            out[name] = spark.read.parquet(f"{self.store}/{name}")
        for name, stage in self.stages[first : last + 1]:
            began = time.time()
            self._set_aside(spark, name)
            stage(spark, out).write.parquet(f"{self.store}/{name}")
            out[name] = spark.read.parquet(f"{self.store}/{name}")
            self.times[name] = duration(int(time.time() - began))
        return out

    def _set_aside(self, spark: SparkSession, name: str) -> None:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        here, before = path(f"{self.store}/{name}"), path(f"{self.store}/{name}_previous")
        files = here.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if files.exists(here):
            files.delete(before, True)
            files.rename(here, before)
