"""Outputs that appear all at once: staged under a version of their own, then named by a manifest.

``overwrite`` deletes the old output before the new one is there, so a job that fails half-way,
or whose driver is lost, leaves neither. Here a job writes to ``<out>/versions/<number>-<id>/``
and, when everything is written, puts ``<out>/manifests/<number>.json`` in place by one rename.
Readers take the paths of the highest manifest. The number is one above the highest there was
when the job began; of two jobs that run at the same time the second to finish is refused.

A failed job's version is deleted on the spot. One left by a lost driver is never named, and the
next job that publishes deletes it, with the versions before the last ``KEEP``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from tillroll.session import file_system
from tillroll.sources.files import MissingInputError

KEEP = 2  # versions that stay, the newest included, for readers that still use the last one


class PublishConflict(RuntimeError):
    """Another job published to the same place meanwhile."""


def _names(spark: SparkSession, folder: str) -> list[str]:
    at, fs = file_system(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def _manifests(spark: SparkSession, out_dir: str) -> list[int]:
    names = _names(spark, f"{out_dir}/manifests")
    return [int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith((".", "_"))]


def _read(spark: SparkSession, path: str) -> str:
    at, fs = file_system(spark, path)
    stream = fs.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _write(spark: SparkSession, path: str, text: str) -> None:
    at, fs = file_system(spark, path)
    stream = fs.create(at, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def _delete(spark: SparkSession, path: str) -> None:
    at, fs = file_system(spark, path)
    fs.delete(at, True)


def published(spark: SparkSession, out_dir: str, number: int | None = None) -> dict[str, str]:
    """The paths of the newest published outputs by name (or of one version)."""
    out_dir = out_dir.rstrip("/")
    numbers = _manifests(spark, out_dir)
    if not numbers or (number is not None and number not in numbers):
        raise MissingInputError(f"nothing published at {out_dir!r}; run the pipeline first.")
    manifest = json.loads(_read(spark, f"{out_dir}/manifests/{number or max(numbers):08d}.json"))
    return {name: f"{out_dir}/versions/{manifest['version']}/{at}" for name, at in manifest["outputs"].items()}


class Stage:
    """A version that is being written."""

    def __init__(self, spark: SparkSession, out_dir: str):
        self.spark, self.out_dir = spark, out_dir.rstrip("/")
        self.number = max(_manifests(spark, self.out_dir), default=0) + 1
        self.version = f"{self.number:08d}-{uuid.uuid4().hex[:8]}"
        self.path = f"{self.out_dir}/versions/{self.version}"

    def commit(self, paths: dict[str, str]) -> None:
        outputs = {name: p.removeprefix(f"{self.path}/") for name, p in paths.items()}
        text = json.dumps({"version": self.version, "outputs": outputs}, indent=1)
        side = f"{self.out_dir}/manifests/.{self.version}"
        _write(self.spark, side, text)
        at, fs = file_system(self.spark, side)
        to, _ = file_system(self.spark, f"{self.out_dir}/manifests/{self.number:08d}.json")
        # local file systems rename over a file that is there, others refuse
        if fs.exists(to) or not fs.rename(at, to):
            fs.delete(at, False)
            raise PublishConflict(f"version {self.number} of {self.out_dir!r} was published by another job")
        self._tidy()

    def _tidy(self) -> None:
        """Delete older versions, named or not, and their manifests; not those of jobs that
        began after this one's number was given."""
        for version in _names(self.spark, f"{self.out_dir}/versions"):
            if int(version.split("-")[0]) <= self.number - KEEP or (
                int(version.split("-")[0]) < self.number and not self._named(version)
            ):
                _delete(self.spark, f"{self.out_dir}/versions/{version}")
        for n in _manifests(self.spark, self.out_dir):
            if n <= self.number - KEEP:
                _delete(self.spark, f"{self.out_dir}/manifests/{n:08d}.json")

    def _named(self, version: str) -> bool:
        n = int(version.split("-")[0])
        if n not in _manifests(self.spark, self.out_dir):
            return False
        return json.loads(_read(self.spark, f"{self.out_dir}/manifests/{n:08d}.json"))["version"] == version


@contextmanager
def staged(spark: SparkSession, out_dir: str) -> Iterator[Stage]:
    """A new version under ``out_dir``; call ``commit`` with its outputs. Without that, or after
    an error, nothing of it stays and what was published before remains."""
    stage = Stage(spark, out_dir)
    done = False
    commit = stage.commit

    def once(paths: dict[str, str]) -> None:
        nonlocal done
        commit(paths)
        done = True

    stage.commit = once  # type: ignore[method-assign]
    try:
        yield stage
    finally:
        if not done:
            _delete(spark, stage.path)
