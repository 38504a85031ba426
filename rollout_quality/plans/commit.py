"""Output that appears as a whole or not at all.

A run writes its artifacts below `_staging/<run>` of the output folder. Once all are there it notes what is to be
published (`_READY`), moves the artifacts to their places and names itself in `_BUILD`. A run that dies before `_READY`
has published nothing; one that dies later is carried through by `recover`, which every new run calls first. Readers
that ask `committed` never see a mixture. One run at a time may write to an output folder.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import SparkSession

from rollout_quality.files import Files

STAGING = "_staging"
READY = "_READY"
MARKER = "_BUILD"


def committed(spark: SparkSession, root: str) -> dict | None:
    """The published run ({"run", "parts"}), or None if there is none or publishing has not ended."""
    root = root.rstrip("/")
    files = Files(spark, root)
    return json.loads(files.read_text(f"{root}/{MARKER}")) if files.exists(f"{root}/{MARKER}") else None


def recover(spark: SparkSession, root: str) -> None:
    """End what dead runs left: carry publishing through, drop what never got that far."""
    root = root.rstrip("/")
    files = Files(spark, root)
    for run in files.names(f"{root}/{STAGING}"):
        if files.exists(f"{root}/{STAGING}/{run}/{READY}"):
            _publish(files, root, run)
        else:
            files.delete(f"{root}/{STAGING}/{run}")
    files.delete(f"{root}/{STAGING}")


def _publish(files: Files, root: str, run: str) -> None:
    """Every step can be repeated, so this may start again wherever it ended."""
    staged = f"{root}/{STAGING}/{run}"
    noted = json.loads(files.read_text(f"{staged}/{READY}"))
    files.delete(f"{root}/{MARKER}")
    for part in noted["outdated"]:
        files.delete(f"{root}/{part}")
    for part in noted["parts"]:
        if files.exists(f"{staged}/{part}"):
            files.delete(f"{root}/{part}")
            files.move(f"{staged}/{part}", f"{root}/{part}")
    files.write_text(f"{root}/{MARKER}", json.dumps({"run": run, "parts": noted["parts"]}))
    files.delete(f"{root}/{STAGING}")


class StagedOutput:
    """Where a run writes (`path`) until it publishes; leaving the block by an error drops it all."""

    def __init__(self, spark: SparkSession, root: str):
        self.root, self.run = root.rstrip("/"), uuid.uuid4().hex
        self.path = f"{self.root}/{STAGING}/{self.run}"
        self._spark, self._files = spark, Files(spark, root)

    def __enter__(self) -> "StagedOutput":
        recover(self._spark, self.root)
        return self

    def publish(self, parts: Sequence[str]) -> None:
        """Put these parts (paths below the output folder) in their places. Parts of the last run that this one
        does not have go with it."""
        before = (committed(self._spark, self.root) or {"parts": []})["parts"]
        note = {"parts": list(parts), "outdated": [p for p in before if p not in parts]}
        self._files.write_text(f"{self.path}/{READY}", json.dumps(note))
        _publish(self._files, self.root, self.run)

    def __exit__(self, kind, value, trace) -> None:
        if kind is not None and not self._files.exists(f"{self.path}/{READY}"):
            self._files.delete(f"{self.root}/{STAGING}")
