"""Tables in partitions, each a base and the deltas since, by a commit log."""

from __future__ import annotations

import time
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..fs import SharedFiles
from .log import CommitLog
from .once import data_files, folder, with_all_files


# In rows whose partitions share folders: the number of the partition. The partition column then names the folder.
MEMBER = "_member"


def _live(state: dict) -> set[int]:
    return {p[0] for p in state["base"].values()} | {p[0] for parts in state["deltas"].values() for p in parts}


def fold(state: dict, version: int, entry: dict) -> None:
    """``base`` and ``deltas`` say for every partition in which versions its rows lie, with their bytes and number of files, and
    the folder if it shares one: then the bytes are its share by rows, and the files those of the folder. ``stale`` are versions that nothing needs any more, with the time since when; ``facts`` are those of the last entry."""
    base, deltas = state.setdefault("base", {}), state.setdefault("deltas", {})
    before = _live(state)
    for name in entry["replaces"]:
        base.pop(name, None)
        deltas.pop(name, None)
    for name, wrote in entry["wrote"].items():
        if entry["kind"] == "base":
            base[name] = [version, *wrote]
        else:
            deltas.setdefault(name, []).append([version, *wrote])
    state["facts"] = entry["facts"]
    stale = [s for s in state.get("stale", []) if s[0] not in entry["deleted"]]
    state["stale"] = stale + [[v, entry["time"]] for v in sorted(before - _live(state))]


def held_bytes(state: dict) -> int:
    return sum(p[1] for p in state["base"].values()) + sum(p[1] for parts in state["deltas"].values() for p in parts)


@dataclass(frozen=True)
class PartedTable:
    """Folders ``<path>/batch=<version>/<partition>=<name>``. One writer at a time: a second one fails.

    Small partitions with numbers for names may share folders, so that files do not become as many as partitions.
    """

    spark: SparkSession
    path: str
    partition: str

    def log(self) -> CommitLog:
        return CommitLog(self.spark, self.path, fold=fold)

    def state(self) -> dict:
        return self.log().state()

    def versions(self) -> list[int]:
        """The versions that are needed or not yet deleted."""
        state = self.state()
        return sorted(_live(state) | {s[0] for s in state["stale"]}) if "base" in state else []

    def names(self, state: dict) -> set[str]:
        """The partitions, as their folders are named."""
        return {*state.get("base", {}), *state.get("deltas", {})}

    def stored(self, schema: T.StructType, parts: Iterable[tuple[str, list]]) -> DataFrame:
        """The rows of (partition, part) as they lie there, with the version that wrote them as ``batch``."""
        folders: dict[str, int] = {}
        shared: dict[int, list[str]] = {}
        for name, (version, _, files, *place) in parts:
            folders[f"{folder(self.path, version)}/{self.partition}={place[0] if place else name}"] = files
            if place:
                shared.setdefault(version, []).append(name)
        member = [T.StructField(MEMBER, T.IntegerType())] if shared else []
        schema = T.StructType([*schema, *member, T.StructField("batch", T.LongType())])
        if not folders:
            return self.spark.createDataFrame([], schema)
        found = self.spark.read.schema(schema).option("basePath", self.path).parquet(*folders)
        found = with_all_files(found, sum(folders.values()), self.path)
        if not shared:
            return found
        # Text, as thousands of numbers are one call that way.
        mine = [f"(batch = {version} AND {MEMBER} IN ({', '.join(names)}))" for version, names in shared.items()]
        return found.filter(F.expr(" OR ".join([f"{MEMBER} IS NULL", *mine]))).drop(MEMBER)

    def _shares(self, staging: str, folders: dict[str, list[int]]) -> dict[str, list]:
        """What each partition has of the folder that it shares with others."""
        schema = T.StructType([T.StructField(MEMBER, T.IntegerType()), T.StructField(self.partition, T.StringType())])
        rows = self.spark.read.schema(schema).parquet(staging).groupBy(self.partition, MEMBER).count().collect()
        total: dict[str, int] = {}
        for place, _, n in rows:
            total[place] = total.get(place, 0) + n
        return {str(member): [folders[place][0] * n // total[place], folders[place][1], place] for place, member, n in rows}

    def write(
        self, state: dict, rows: DataFrame, kind: str, replaces: Iterable[str], job: str, batch: int, keep_seconds: float, **facts
    ) -> None:
        """Add ``rows``, laid out by partition, as deltas or, for the partitions in ``replaces``, as the new base.

        With a column ``MEMBER`` the rows are laid out by folder, and that column is the number of their partition.
        """
        files, log, now = SharedFiles(self.spark), self.log(), time.time()
        deleted = [v for v, since in state.get("stale", []) if now - since > keep_seconds]
        version = log.claim(state, job, batch, alone=True)
        staging, target = f"{self.path}/_staging/{version}", folder(self.path, version)
        rows.write.mode("overwrite").partitionBy(self.partition).parquet(staging)
        wrote: dict[str, list] = {}
        for name, size in data_files(files, staging).items():
            part = wrote.setdefault(name.split("/")[0].removeprefix(f"{self.partition}="), [0, 0])
            part[0] += size
            part[1] += 1
        if MEMBER in rows.columns:
            wrote = self._shares(staging, wrote)
        files.delete(target)  # what an attempt left that did not get as far as its entry
        files.rename(staging, target)
        log.publish(version, {
            "job": job, "batch": batch, "kind": kind, "wrote": wrote, "replaces": sorted(replaces), "deleted": deleted, "time": now, "facts": facts,
        })
        for old in deleted:
            files.delete(folder(self.path, old))

    def grown(self, state: dict, most: int, least_bytes: int, share: float) -> set[str]:
        """The partitions with more than ``most`` deltas, or with more in them than ``share`` of the base and ``least_bytes``."""
        return {
            name for name, parts in state["deltas"].items()
            if len(parts) > most or sum(p[1] for p in parts) > max(least_bytes, share * state["base"].get(name, [0, 0])[1])
        }
