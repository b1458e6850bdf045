"""Stored model versions, side by side.

Two Parquet tables under one folder (shared storage on a cluster), both
partitioned by version:

* ``state``: a row per entity (what a forecast needs of its history);
* ``versions``: one row per version: cut-off, interval offsets, evaluation.

A version is written once. Its row in ``versions`` comes last and makes it
visible: a publication that is lost half-way shows nothing and is repeated under
the same name. Readers name a version, so only its partition is read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandgrid.sources import incremental as INC

VERSION = "version"


@dataclass(frozen=True)
class ModelStore:
    spark: SparkSession
    path: str

    def _table(self, name: str) -> str:
        return f"{self.path.rstrip('/')}/{name}"

    def publish(self, version: str, state: DataFrame, info: DataFrame) -> None:
        """Store ``state`` (a row per entity) and the one row ``info`` as
        ``version``; a version that is there already is an error."""
        if self.has(version):
            raise ValueError(f"version: {version!r} is published already")
        rows = info.count()
        if rows != 1:
            raise ValueError(f"info: {rows} rows in place of one")
        if INC.append_batch(state, self._table("state"), version) == 0:
            raise ValueError("state: no rows")
        INC.append_batch(info.coalesce(1), self._table("versions"), version)

    def versions(self) -> DataFrame:
        """The published versions, a row each."""
        return INC.read_batches(self.spark, self._table("versions")).withColumnRenamed(INC.BATCH, VERSION)

    def has(self, version: str) -> bool:
        try:
            return not self.versions().where(F.col(VERSION) == version).isEmpty()
        except FileNotFoundError:
            return False

    def latest(self) -> str:
        """The version with the latest cut-off (of equal ones the greatest name)."""
        row = self.versions().agg(F.max(F.struct("data_cutoff", VERSION))).first()[0]
        if row is None:
            raise FileNotFoundError(f"no version at {self.path}")
        return row[VERSION]

    def info(self, version: str) -> DataFrame:
        """The version's row; an unknown version is an error."""
        if not self.has(version):
            raise KeyError(f"no version {version!r} at {self.path}")
        return self.versions().where(F.col(VERSION) == version)

    def entities(self) -> DataFrame:
        """State of all published versions, a row per version and entity."""
        state = INC.read_batches(self.spark, self._table("state")).withColumnRenamed(INC.BATCH, VERSION)
        return state.join(self.versions().select(VERSION), VERSION, "left_semi")

    def state(self, version: str) -> DataFrame:
        """The version's state (its partition only)."""
        self.info(version)
        return INC.read_batches(self.spark, self._table("state")).where(F.col(INC.BATCH) == version).drop(INC.BATCH)
