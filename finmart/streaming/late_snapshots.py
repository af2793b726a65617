"""A stored type-2 history that takes its extracts in any order (see
``operators.scd2_late``).  A run writes fresh folders and then a manifest that
appears whole or not at all; a run of a time that is in already changes nothing."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from finmart.operators.scd2_late import history, splice
from finmart.sources.sinks import version_tag
from finmart.sources.storage import child_names, delete_folder, publish_text, read_text


class LateSnapshots:
    def __init__(self, spark: SparkSession, root: str, key: str, check_cols: list[str]):
        self.spark, self.root, self.key, self.check_cols = spark, root.rstrip("/"), key, check_cols

    def state(self) -> dict:
        names = [n for n in child_names(self.spark, f"{self.root}/log") if n[0] != "."]
        if names:
            return json.loads(read_text(self.spark, f"{self.root}/log/{max(names)}"))
        return {"number": 0, "runs": [], "folder": None}

    def _stored(self, state: dict, part: str) -> DataFrame | None:
        return self.spark.read.parquet(f"{self.root}/{state['folder']}/{part}") if state["folder"] else None

    def apply(self, extract: DataFrame, as_of: str) -> bool:
        """Puts an extract in its place in time; False if that run is there already."""
        state = self.state()
        if version_tag(as_of) in map(version_tag, state["runs"]):
            return False
        seen, unclear = splice(self._stored(state, "observations"), self._stored(state, "unclear"),
                               state["runs"], extract, self.key, as_of)
        folder = f"runs/{version_tag(as_of)}-{uuid.uuid4().hex[:12]}"
        seen.write.parquet(f"{self.root}/{folder}/observations")
        unclear.write.parquet(f"{self.root}/{folder}/unclear")
        publish_text(self.spark, f"{self.root}/log", f"{state['number'] + 1:012d}.json", json.dumps(
            {"number": state["number"] + 1, "runs": state["runs"] + [as_of], "folder": folder}))
        return True

    def history(self) -> DataFrame | None:
        seen = self._stored(self.state(), "observations")
        return None if seen is None else history(seen, self.key, self.check_cols)

    def vacuum(self) -> None:
        keep = self.state()["folder"]
        for n in child_names(self.spark, f"{self.root}/runs"):
            if f"runs/{n}" != keep:
                delete_folder(self.spark, f"{self.root}/runs/{n}")
