"""Monthly tables behind a manifest: replacing months is atomic, and a delivery counts once.

A table is a folder with ``data``, where every delivery writes its months into a folder of its own, and ``manifest``, a file per version
that names the folder of each month. A version is made by creating the next file, which a store does for one writer only. Readers
take the months of the newest version, so they never see a part of a replacement; a delivery that broke off, or lost a
race, has left files that no version names. The manifest has a line per month and per delivery, small enough for the driver.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from climagrid.sinks.manifest import Manifest
from climagrid.sinks.tables import PERIOD, _layout, _partition_values, by_name, checked_periods, with_period


class MonthTable:
    """Observations by month at ``path``, with the time column ``time``."""

    def __init__(self, spark: SparkSession, path: str, time: str):
        self.spark, self.path, self.time = spark, path.rstrip("/"), time
        self.versions = Manifest(spark, f"{self.path}/manifest", {"schema": None, "months": {}, "deliveries": []})

    def manifest(self) -> dict:
        """The newest version: ``version``, ``schema``, ``months`` ("year-month" to folder) and the ids of its deliveries."""
        version, content = self.versions.newest()
        return {"version": version, **content}

    def read(self) -> DataFrame:
        """All rows of the newest version, with year and month."""
        manifest = self.manifest()
        if manifest["schema"] is None:
            raise FileNotFoundError(f"nothing stored at {self.path}")
        schema = T.StructType.fromJson(json.loads(manifest["schema"]))
        if not manifest["months"]:
            return self.spark.createDataFrame([], schema)
        stored = T.StructType([*schema.fields, T.StructField("delivery", T.StringType())])
        folders = [f"{self.path}/data/{folder}" for folder in manifest["months"].values()]
        return self.spark.read.schema(stored).option("basePath", f"{self.path}/data").parquet(*folders).select(*schema.names)

    def replace(self, incoming: DataFrame, delivery: str, older: bool = False) -> bool:
        """Swap in the months of ``incoming`` as one version; False, and nothing changes, if the delivery is stored already.

        Months before the newest stored one are refused unless ``older`` is set, and so are rows without a time. The first
        delivery sets the columns; later ones are matched by name.
        """
        known = self.manifest()
        if delivery in known["deliveries"]:
            return False
        dated = with_period(incoming, self.time)
        if known["schema"] is not None:
            stored = T.StructType.fromJson(json.loads(known["schema"]))
            dated = with_period(by_name(incoming, self.spark.createDataFrame([], stored).drop(*PERIOD)), self.time)
        attempt = f"delivery={uuid.uuid4().hex}"
        _layout(checked_periods(dated, self.time, None if older else self._newest(known)), PERIOD).write.parquet(
            f"{self.path}/data/{attempt}", partitionBy=list(PERIOD)
        )
        written = {
            f"{year}-{month}": f"{attempt}/year={year}/month={month}"
            for year in _partition_values(self.spark, f"{self.path}/data/{attempt}", "year")
            for month in _partition_values(self.spark, f"{self.path}/data/{attempt}/year={year}", "month")
        }
        while True:
            if not older and written:
                newest = self._newest(known)
                if newest is not None and min(self._number(m) for m in written) < newest[0] * 12 + newest[1]:
                    raise RuntimeError("a month before the newest stored one")
            following = {
                "schema": known["schema"] or dated.schema.json(), "months": known["months"] | written, "deliveries": [*known["deliveries"], delivery],
            }
            if self.versions.create(known["version"] + 1, following):
                return True
            known = self.manifest()  # another writer was first
            if delivery in known["deliveries"]:
                return False

    @staticmethod
    def _number(month: str) -> int:
        year, number = month.split("-")
        return int(year) * 12 + int(number)

    def _newest(self, manifest: dict) -> tuple[int, int] | None:
        if not manifest["months"]:
            return None
        year, month = max(manifest["months"], key=self._number).split("-")
        return int(year), int(month)
