"""Folders of immutable layers: what a span of runs wrote, later folded into wider layers.

A layer is a folder whose name tells its kind, the first and the last run it covers, and a
mark. It counts once Spark has put its `_SUCCESS` file there, so a half-written layer is
never read. A wider layer replaces those inside its span without touching them: a reader
takes the widest that there are, and a reader that began earlier still finds its files.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from shelfdiff.functions.times import as_utc

_TIME = "%Y%m%dT%H%M%S.%f"
NO_MARK = "none"


def version_name(run_ts: datetime) -> str:
    """A run's time as text that sorts like the time."""
    return as_utc(run_ts).strftime(_TIME)


def version_time(name: str) -> datetime | None:
    if name == NO_MARK:
        return None
    return datetime.strptime(name, _TIME).replace(tzinfo=timezone.utc)


@dataclass(frozen=True)
class Layer:
    folder: str
    kind: str
    first: str
    last: str
    mark: str
    unique: str

    @property
    def path(self) -> str:
        return f"{self.folder}/{self.kind}_{self.first}_{self.last}_{self.mark}_{self.unique}"


def new_layer(folder: str, kind: str, first: str, last: str, mark: str = NO_MARK) -> Layer:
    return Layer(folder, kind, first, last, mark, uuid.uuid4().hex)


def _open(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path in it."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def child_names(spark: SparkSession, folder: str) -> list[str]:
    fs, path = _open(spark, folder)
    try:
        return sorted(s.getPath().getName() for s in fs.listStatus(path))
    except Py4JJavaError as exc:
        if "FileNotFoundException" not in exc.java_exception.getClass().getName():
            raise
        return []


def exists(spark: SparkSession, path: str) -> bool:
    fs, found = _open(spark, path)
    return fs.exists(found)


def remove_paths(spark: SparkSession, paths: Iterable[str]) -> None:
    for path in paths:
        fs, found = _open(spark, path)
        fs.delete(found, True)


def remove(spark: SparkSession, layers: Iterable[Layer]) -> None:
    remove_paths(spark, [layer.path for layer in layers])


def all_layers(spark: SparkSession, folder: str) -> list[Layer]:
    """All layers of a folder, half-written ones too."""
    parts = [name.split("_") for name in child_names(spark, folder)]
    return [Layer(folder, *p) for p in parts if len(p) == 5]


def complete(spark: SparkSession, layers: Iterable[Layer]) -> list[Layer]:
    return [layer for layer in layers if exists(spark, f"{layer.path}/_SUCCESS")]


def widest(layers: Iterable[Layer]) -> list[Layer]:
    """The layers that lie in no other one, in the order of runs. Spans are nested or apart."""
    out: list[Layer] = []
    for layer in sorted(layers, key=lambda x: x.last, reverse=True):
        # Runs go down; of layers that end together the one that starts first is widest.
        if out and out[-1].last == layer.last:
            if layer.first < out[-1].first:
                out[-1] = layer
        elif not out or layer.last < out[-1].first:
            out.append(layer)
    return out[::-1]


def newest_layer(layers: Iterable[Layer]) -> Layer | None:
    """The layer that ends last, the widest of those."""
    return max(layers, key=lambda x: (x.last, [-ord(c) for c in x.first]), default=None)
