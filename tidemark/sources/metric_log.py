"""An append-only log of metric samples that is kept small: old samples are merged into one row per label set.

    ROOT/<file>.parquet               appended samples, as many files as appends
    ROOT/_merged/<id>/...             the last sample per label set of everything absorbed so far
    ROOT/_merges/<number>.json        which merged table counts, which log files it has absorbed, and up to when

A merge lists the log files, writes a new merged table and then creates the next
numbered record, which only one merge can. Files that were appended meanwhile are
in no record and so stay in the log: none is lost, and none counts twice, as the
last sample of a label set is the same however often it is read.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import files, sinks
from tidemark.sources.schemas import METRIC_SCHEMA

LABELS = ["metric", "snapshot_date", "model_id"]


class MetricLog:
    """The samples of one mart; `tiebreak` names a further column that decides between samples of one time."""

    def __init__(self, spark: SparkSession, root: str, tiebreak: str | None = None, schema: str = METRIC_SCHEMA):
        self.spark, self.root, self.tiebreak, self.schema = spark, root.rstrip("/"), tiebreak, schema

    def append(self, df: DataFrame) -> None:
        fields = [c.split()[0] for c in self.schema.split(", ")]
        df.select(*fields).write.mode("append").parquet(self.root)

    def _record(self) -> dict:
        held = [name for name, _ in files.names(self.spark, f"{self.root}/_merges") if re.fullmatch(r"\d{12}\.json", name)]
        if not held:
            return {"number": 0, "merged": None, "absorbed": [], "upto": None}
        return json.loads(files.read_text(self.spark, f"{self.root}/_merges/{held[-1]}"))

    def _log_files(self) -> list[str]:
        return [name for name, _ in files.names(self.spark, self.root) if name.endswith(".parquet")]

    def _read(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def samples(self) -> DataFrame:
        """The merged rows and every sample that is not in them yet."""
        record = self._record()
        absorbed = set(record["absorbed"])
        merged = [f"{self.root}/_merged/{record['merged']}"] if record["merged"] else []
        return self._read(merged + [f"{self.root}/{name}" for name in self._log_files() if name not in absorbed])

    def latest(self) -> DataFrame:
        """The last sample of each label set; the same before and after a merge."""
        return sinks.latest_metrics(self.samples(), self.tiebreak)

    def merge(self, watermark=None) -> int | None:
        """Absorb the log files whose samples were all taken before `watermark` (all files without one); the record's number.

        A label set keeps its last sample. None, and nothing changed, if there is
        nothing to absorb or another merge came first. Files are absorbed whole:
        one with a later sample waits for the next merge.
        """
        record = self._record()
        fresh = sorted(set(self._log_files()) - set(record["absorbed"]))
        if watermark is not None and fresh:
            name = F.element_at(F.split(F.input_file_name(), "/"), -1)
            dated = self._read([f"{self.root}/{n}" for n in fresh]).select(name.alias("name"), "logged_at")
            late = dated.groupBy("name").agg(F.max("logged_at").alias("last")).filter(F.col("last") >= F.lit(watermark).cast("timestamp"))
            fresh = sorted(set(fresh) - {r["name"] for r in late.select("name").collect()})
        if not fresh:
            return None
        before = [f"{self.root}/_merged/{record['merged']}"] if record["merged"] else []
        rows = self._read(before + [f"{self.root}/{n}" for n in fresh])
        key = F.max(F.struct("logged_at", *([self.tiebreak] if self.tiebreak else []), "value", *[
            c for c in rows.columns if c not in ("logged_at", "value", self.tiebreak, *LABELS)])).alias("last")
        version = uuid.uuid4().hex
        rows.groupBy(*LABELS).agg(key).select(*LABELS, "last.*").select(*rows.columns).write.parquet(f"{self.root}/_merged/{version}")
        number = record["number"] + 1
        text = json.dumps({
            "number": number, "merged": version, "absorbed": sorted({*record["absorbed"], *fresh}),
            "upto": None if watermark is None else str(watermark), "at": dt.datetime.now(dt.timezone.utc).isoformat()})
        return number if files.create_if_absent(self.spark, f"{self.root}/_merges/{number:012d}.json", text) else None

    def clean(self, older_than_hours: float = 24.0) -> int:
        """Delete absorbed log files and merged tables that the newest record has replaced, if old enough for their readers to be done; how many."""
        record = self._record()
        limit = (dt.datetime.now().timestamp() - 3600 * older_than_hours) * 1000
        absorbed = set(record["absorbed"])
        gone = [n for n, at in files.names(self.spark, self.root) if n in absorbed and at <= limit]
        gone += [f"_merged/{n}" for n, at in files.names(self.spark, f"{self.root}/_merged") if n != record["merged"] and at <= limit]
        for path in gone:
            files.delete(self.spark, f"{self.root}/{path}")
        if gone:
            left = sorted(absorbed - set(gone))
            number = record["number"] + 1
            files.create_if_absent(
                self.spark, f"{self.root}/_merges/{number:012d}.json", json.dumps({**record, "number": number, "absorbed": left}))
        return len(gone)
