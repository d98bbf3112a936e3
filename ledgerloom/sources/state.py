"""State that outlives a run: a table by key on disk, of which an update rewrites only what it touches.

Rows are dealt into buckets by a hash of their key. A version is a small file that names, for each bucket, the folder that holds it; the highest version that is there counts. An update writes the buckets that its changes fall
into to a folder of its own and then the next version, by one rename. If it fails before that, the state is what it was, and the same update can be run again; run twice it changes nothing.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.sources.sinks import children, delete, make_folder, move, write_text

_BUCKET = "_bucket"


class State:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    @classmethod
    def create(cls, rows: DataFrame, path: str, keys: list[str], buckets: int = 64) -> State:
        """A state with rows, of which each key has one."""
        self = cls(rows.sparkSession, path)
        if self.version():
            raise ValueError(f"{path} holds a state already")
        base = {"keys": keys, "buckets": buckets, "schema": rows.schema.jsonValue(), "folders": {}}
        self._advance(0, base, rows)
        return self

    def versions(self) -> list[int]:
        return [int(n[1:-5]) for n in children(self.spark, f"{self.path}/versions") if n.endswith(".json")]

    def version(self) -> int:
        """The version that counts; 0 if there is none."""
        return max(self.versions(), default=0)

    def _about(self, version: int) -> dict:
        return json.loads(self.spark.read.text(f"{self.path}/versions/v{version:08d}.json", wholetext=True).first()["value"])

    def _dealt(self, rows: DataFrame, about: dict) -> DataFrame:
        return rows.withColumn(_BUCKET, F.pmod(F.xxhash64(*about["keys"]), F.lit(about["buckets"])).cast("int"))

    def _of(self, about: dict, buckets: list[str]) -> DataFrame:
        schema = StructType.fromJson(about["schema"])
        folders = [about["folders"][b] for b in buckets if b in about["folders"]]
        return self.spark.read.schema(schema).parquet(*(f"{self.path}/{f}" for f in folders)) if folders else self.spark.createDataFrame([], schema)

    def read(self, version: int | None = None) -> DataFrame:
        """All rows, as of a version, by default the last."""
        about = self._about(version or self.version())
        return self._of(about, sorted(about["folders"]))

    def _advance(self, version: int, about: dict, rows: DataFrame) -> None:
        """rows replace the buckets they fall into."""
        folder = f"data/{uuid.uuid4().hex}"
        self._dealt(rows, about).repartition(_BUCKET).write.partitionBy(_BUCKET).parquet(f"{self.path}/{folder}")
        made = {n.split("=")[1]: f"{folder}/{n}" for n in children(self.spark, f"{self.path}/{folder}") if n.startswith(f"{_BUCKET}=")}
        name = f"{self.path}/versions/v{version + 1:08d}.json"
        draft = f"{self.path}/drafts/{uuid.uuid4().hex}"
        write_text(self.spark, draft, json.dumps(about | {"folders": about["folders"] | made}))
        make_folder(self.spark, f"{self.path}/versions")
        if self.version() != version:
            raise ValueError(f"another update of {self.path} came first")
        move(self.spark, draft, name)

    def upsert(self, changes: DataFrame, order: Column) -> list[int]:
        """The latest change of each key replaces its row or is added. Returns the buckets that were rewritten, of which there are as many as the state has at most."""
        from ledgerloom.plans.reports import upsert

        version = self.version()
        about = self._about(version)
        touched = [r[_BUCKET] for r in self._dealt(changes, about).select(_BUCKET).distinct().collect()]
        if touched:
            self._advance(version, about, upsert(self._of(about, [str(b) for b in touched]), changes, about["keys"], order))
        return sorted(touched)

    def vacuum(self, keep: int = 1) -> None:
        """Delete all but the last versions, and what none of these names."""
        versions = sorted(self.versions())
        for v in versions[:-keep]:
            delete(self.spark, f"{self.path}/versions/v{v:08d}.json")
        used = {f.split("/")[1] for v in versions[-keep:] for f in self._about(v)["folders"].values()}
        for name in children(self.spark, f"{self.path}/data"):
            if name not in used:
                delete(self.spark, f"{self.path}/data/{name}")
