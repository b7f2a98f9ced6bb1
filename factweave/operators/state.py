"""State of a collection between runs (F17, A01, C07, C08, L07, L08, R35): hashes, run logs and what has changed."""

from __future__ import annotations

import hashlib
import json
import os
import time
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factweave.operators.rows import member, q

CHUNK = 32 << 20


def file_hash(path: str, name: str = "sha1") -> str:
    digest = hashlib.new(name)
    with open(path, "rb") as f:
        while block := f.read(CHUNK):
            digest.update(block)
    return digest.hexdigest()


def directory_hash(folder: str, exclude: tuple[str, ...] = ()) -> str:
    """sha1 over the names and bytes of all files below a folder, in order of their names."""
    digest = hashlib.sha1()
    for where, folders, names in os.walk(folder):
        folders.sort()
        for name in sorted(names):
            path = os.path.join(where, name)
            relative = os.path.relpath(path, folder)
            if relative in exclude:
                continue
            digest.update(relative.encode())
            with open(path, "rb") as f:
                while block := f.read(CHUNK):
                    digest.update(block)
    return digest.hexdigest()


@dataclass
class State:
    """What a run depended on."""

    code: str = ""
    specification: str = ""
    collection: str = ""
    pipeline: str = ""
    resources: str = ""
    transform_count: int = 0

    @classmethod
    def build(cls, code: str, specification: str, collection: str, pipeline: str, resources: str, transform_count: int = 0) -> "State":
        return cls(code, *(directory_hash(d) for d in (specification, collection, pipeline, resources)), transform_count)

    def save(self, path: str) -> None:
        with open(path, "w") as f:
            json.dump(asdict(self), f, sort_keys=True)

    @classmethod
    def load(cls, path: str) -> "State":
        with open(path) as f:
            return cls(**json.load(f))

    def differences(self, other: "State", ignore: tuple[str, ...] = ("resources", "transform_count")) -> list[str]:
        return [k for k, v in asdict(self).items() if k not in ignore and v != getattr(other, k)]


@dataclass
class RunLog:
    """One run of a resource; only finished runs are saved, and a failure to save is told, not raised."""

    dataset: str
    resource: str
    code_version: str
    config_hash: str
    specification_hash: str
    status: str = "STARTED"
    began: float = field(default_factory=time.time)

    def finish(self, status: str, path: str) -> bool:
        self.status = status
        if status not in ("COMPLETE", "ERROR", "FAILED"):
            return False
        try:
            with open(path, "w") as f:
                json.dump(asdict(self) | {"elapsed": time.time() - self.began}, f, sort_keys=True)
            return True
        except OSError:
            return False


def entity_count(rows: DataFrame) -> DataFrame:
    """The number of distinct entities that are not blank."""
    return rows.agg(F.count_distinct(F.nullif(F.trim(q("entity").cast("string")), F.lit(""))).alias("entity_count"))


def organisations_of(organisations: DataFrame, dataset: str) -> DataFrame:
    """Organisations that provide a dataset."""
    return organisations.where((F.coalesce(q("dataset"), F.lit("")) == dataset) | member("dataset", dataset)).select("organisation").distinct()


def all_tasks(*tasks: DataFrame) -> DataFrame:
    """Tasks of all kinds, one row per reference."""
    out = tasks[0]
    for t in tasks[1:]:
        out = out.unionByName(t)
    return out.dropDuplicates(["reference"])
