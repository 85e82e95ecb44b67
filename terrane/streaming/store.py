"""A store of entities that is merged when it is read: a batch writes its own rows, and no more.

Rows are dealt over buckets by a hash of their key. A batch is a delta: the last change of each of its
entities, tombstones among them. Buckets whose deltas have grown to a part of their base are
compacted, each by itself, so that what is written stays in proportion to what has come in. A snapshot is
a manifest: which base each bucket has, which deltas it lacks, and which sequences are in. Manifests are made under a name of
their own and renamed without replacing, so of two writers one commits first and the other builds on that.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.operators.entities import latest

#: Rows of deltas whose keys are sent to all executors, at most: untouched rows then stay where they are.
SENT = 500_000
TRIES = 20


class Store:
    """Entities by key at ``path``; ``schema`` has their columns, a version and ts among them."""

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: tuple = ("id",), buckets: int = 16, compact_at: float = 0.5):
        self.spark, self.path, self.schema, self.keys = spark, path, schema, tuple(keys)
        self.buckets, self.compact_at = buckets, compact_at
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    # Files ------------------------------------------------------------------

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _names(self, folder: str) -> list[str]:
        at = self._at(folder)
        fs = at.getFileSystem(self._conf)
        return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []

    def snapshots(self) -> list[int]:
        """Numbers of the manifests, the newest last."""
        return sorted(int(n[:-5]) for n in self._names("manifest") if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, snapshot: int | None = None) -> dict:
        numbers = self.snapshots()
        number = snapshot if snapshot is not None else numbers[-1] if numbers else None
        if number is None:
            return {"snapshot": -1, "sequences": [], "base": {}, "deltas": []}
        at = self._at(f"manifest/{number}.json")
        stream = at.getFileSystem(self._conf).open(at)
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _commit(self, change: Callable[[dict], dict | None]) -> bool:
        """Put the manifest that ``change`` makes of the newest one in place; again if another writer was first. False if there is nothing to do."""
        for _ in range(TRIES):
            new = change(self.manifest())
            if new is None:
                return False
            new["snapshot"] += 1
            own, final = self._at(f"manifest/.{uuid.uuid4().hex}"), self._at(f"manifest/{new['snapshot']}.json")
            fs = own.getFileSystem(self._conf)
            out = fs.create(own, False)
            out.write(bytearray(json.dumps(new, sort_keys=True).encode()))
            out.close()
            files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(own.getFileSystem(self._conf).getUri(), self._conf)
            try:
                files.rename(fs.makeQualified(own), fs.makeQualified(final), self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0))
                return True
            except Py4JJavaError as e:
                fs.delete(own, False)
                if "FileAlreadyExists" not in str(e):
                    raise
        raise RuntimeError("other writers were first each time")

    # Rows --------------------------------------------------------------------

    def _schema(self) -> str:
        return f"{self.schema}, deleted boolean, sequence long"

    def _load(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(self._schema()).parquet(*paths) if paths else self.spark.createDataFrame([], self._schema())

    def _write(self, rows: DataFrame, folder: str) -> tuple[str, dict[str, int]]:
        """Write rows by bucket; the folder and its rows by bucket."""
        name = f"{folder}/{uuid.uuid4().hex}"
        placed = rows.withColumn("bucket", F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)))
        placed.repartition("bucket").sortWithinPartitions("bucket", *self.keys).write.partitionBy("bucket").parquet(f"{self.path}/{name}")
        counts = self.spark.read.schema(f"{self._schema()}, bucket int").parquet(f"{self.path}/{name}").groupBy("bucket").count().collect()  # a row a bucket
        return name, {str(r["bucket"]): r["count"] for r in counts}

    def _merged(self, manifest: dict, buckets: set[str] | None = None) -> DataFrame:
        """The last version of every entity of the buckets, tombstones included: of one version what came first stays."""
        mine = lambda b: buckets is None or b in buckets
        base = self._load([f"{self.path}/{x['path']}/bucket={b}" for b, x in manifest["base"].items() if mine(b)])
        pieces = [(f"{self.path}/{d['path']}/bucket={b}", n) for d in manifest["deltas"] for b, n in d["rows"].items() if mine(b)]
        if not pieces:
            return base
        deltas = self._load([p for p, _ in pieces])
        keys = deltas.select(*self.keys).distinct()
        if sum(n for _, n in pieces) <= SENT:
            keys = F.broadcast(keys)
        on = list(self.keys)
        touched = base.join(keys, on, "left_semi").unionByName(deltas)
        return base.join(keys, on, "left_anti").unionByName(latest(touched, on, [F.desc("version"), F.asc("sequence")]))

    def read(self, snapshot: int | None = None) -> DataFrame:
        """The living entities, now or at an earlier snapshot that has not been vacuumed."""
        return self._merged(self.manifest(snapshot)).where("not deleted").drop("deleted", "sequence")

    def apply(self, batch: DataFrame, sequence: int, hook: Callable[[DataFrame], None] | None = None) -> None:
        """Take in a batch of changes (the store's columns and action) under its number; one that is in changes nothing.

        A change that is older than what is there loses, whenever it comes. ``hook`` gets the changes that win.
        """
        if _within(sequence, self.manifest()["sequences"]):
            return
        last = latest(batch, self.keys, [F.desc("version"), F.desc("ts")])
        if hook:
            held = self._merged(self.manifest()).select(*self.keys, F.col("version").alias("held_version"))
            hook(last.join(held, list(self.keys), "left").where("held_version is null or version > held_version").drop("held_version"))
        rows = last.withColumns({"deleted": F.col("action") == "delete", "sequence": F.lit(sequence).cast("long")})
        columns = self.spark.createDataFrame([], self._schema()).columns
        path, counts = self._write(rows.select(*columns), "delta")

        def add(now: dict) -> dict | None:
            if _within(sequence, now["sequences"]):
                return None
            return now | {"sequences": _with(sequence, now["sequences"]), "deltas": [*now["deltas"], {"path": path, "rows": counts}]}

        if self._commit(add):
            self.compact()

    def compact(self, at: float | None = None) -> list[str]:
        """Merge the deltas of buckets that have more than ``at`` of their base's rows in them; the buckets' names."""
        at, before = self.compact_at if at is None else at, self.manifest()
        grown: dict[str, int] = {}
        for d in before["deltas"]:
            for b, n in d["rows"].items():
                grown[b] = grown.get(b, 0) + n
        due = {b for b, n in grown.items() if n > at * before["base"].get(b, {"rows": 0})["rows"]}
        if not due:
            return []
        path, counts = self._write(self._merged(before, due).withColumn("sequence", F.lit(-1).cast("long")), "base")
        done = {(d["path"], b) for d in before["deltas"] for b in d["rows"] if b in due}
        was = {b: before["base"].get(b) for b in due}

        def swap(now: dict) -> dict | None:
            if any(now["base"].get(b) != was[b] for b in due):
                return None  # another writer has compacted them meanwhile
            left = [d | {"rows": {b: n for b, n in d["rows"].items() if (d["path"], b) not in done}} for d in now["deltas"]]
            return now | {"base": now["base"] | {b: {"path": path, "rows": counts[b]} for b in due}, "deltas": [d for d in left if d["rows"]]}

        return sorted(due) if self._commit(swap) else []

    def vacuum(self, keep: int = 1) -> int:
        """Delete all but the last ``keep`` manifests and what only those name; the number of folders. No batch may be under way."""
        numbers = self.snapshots()
        kept = [self.manifest(n) for n in numbers[-keep:]]
        used = {x["path"] for m in kept for x in [*m["base"].values(), *m["deltas"]]}
        gone = [f"{top}/{n}" for top in ("base", "delta") for n in self._names(top) if f"{top}/{n}" not in used]
        for name in [f"manifest/{n}.json" for n in numbers[:-keep]] + gone:
            self._at(name).getFileSystem(self._conf).delete(self._at(name), True)
        return len(gone)


def _within(n: int, ranges: list[list[int]]) -> bool:
    return any(a <= n <= b for a, b in ranges)


def _with(n: int, ranges: list[list[int]]) -> list[list[int]]:
    """Ranges of whole numbers with one more: as short as the numbers are dense."""
    out: list[list[int]] = []
    for a, b in sorted([*ranges, [n, n]]):
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out
