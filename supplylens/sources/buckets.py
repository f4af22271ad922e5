"""Keyed tables in buckets: a change rewrites the buckets of its keys and nothing else.

A store is a folder with one or more tables. The rows of a table are dealt to buckets by the hash of its key, and each
bucket is a folder of parquet files written once. A manifest names the folder of every bucket of every table; the one of
the highest number is in force for all sessions. A change reads the buckets its keys fall into, writes these anew beside
the old ones, and commits by adding the next manifest: a file that appears as a whole, and only if no other writer added
it before. A writer that is lost on the way leaves the manifest before in force, and readers of older manifests keep
their files until these are expired.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from supplylens.operators.windows import latest_per_key
from supplylens.session import drop_folder, names_in, new_file, new_folder, read_file
from supplylens.sources.tables import deleted, replaced_slice, updated, upserted


@dataclass(frozen=True)
class Staged:
    """Buckets of a table that are written but not yet in force; ``folders`` has the ones that hold rows."""

    name: str
    touched: frozenset[int]
    folders: dict[int, str]
    spec: dict


@dataclass
class Manifest:
    """``tables``: by name their key, number of buckets, schema and folder by bucket; ``notes``: of the writers."""

    version: int = 0
    tables: dict[str, dict] = field(default_factory=dict)
    notes: dict = field(default_factory=dict)


class BucketStore:
    """Keyed tables below ``root``, a folder all executors reach.

    The number of buckets is chosen when a table is created, so that one is a few files of the usual size; a change of k
    keys rewrites k buckets at most. Null keys share a bucket. A hot key is one bucket, whose files Spark may split.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    @classmethod
    def new(cls, spark: SparkSession, label: str) -> BucketStore:
        return cls(spark, new_folder(spark, label))

    # manifests

    def versions(self) -> list[int]:
        names = names_in(self.spark, f"{self.root}/manifests")
        return sorted(int(n.split(".")[0]) for n in names if n[0].isdigit())

    def manifest(self, version: int | None = None) -> Manifest:
        known = self.versions()
        if version is None and not known:
            return Manifest()
        return Manifest(**json.loads(read_file(self.spark, self._manifest_path(known[-1] if version is None else version))))

    def _manifest_path(self, version: int) -> str:
        return f"{self.root}/manifests/{version:012d}.json"

    # reading

    def table(self, name: str, version: int | None = None) -> DataFrame:
        spec = self.manifest(version).tables[name]
        return self._read(spec, range(spec["buckets"]))

    def lookup(self, name: str, keys: DataFrame) -> DataFrame:
        """Rows of the given keys; only their buckets are read."""
        spec = self.manifest().tables[name]
        rows = self._read(spec, self._buckets_of(keys, spec))
        return rows.join(keys.select(spec["key"]).distinct(), spec["key"], "left_semi")

    def _read(self, spec: dict, buckets) -> DataFrame:
        schema = StructType.fromJson(spec["schema"])
        folders = [f"{self.root}/{spec['folders'][str(b)]}" for b in buckets if str(b) in spec["folders"]]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    @staticmethod
    def _bucket(spec: dict) -> Column:
        key = F.col(spec["key"]).cast(StructType.fromJson(spec["schema"])[spec["key"]].dataType)  # one hash for all widths
        return F.pmod(F.xxhash64(key), F.lit(spec["buckets"])).cast("int")

    def _buckets_of(self, rows: DataFrame, spec: dict) -> list[int]:
        """At most as many numbers as there are buckets."""
        return sorted(r[0] for r in rows.select(self._bucket(spec)).distinct().collect())

    # writing

    def stage(self, name: str, df: DataFrame, spec: dict, touched, base: Manifest) -> Staged:
        """Write the next state of the touched buckets; nothing of it is in force before ``commit``."""
        folder = f"data/{base.version:012d}-{uuid.uuid4().hex[:12]}"
        rows = df.withColumn("_bucket", self._bucket(spec)).hint("rebalance", "_bucket")
        rows.write.partitionBy("_bucket").parquet(f"{self.root}/{folder}")
        written = [n for n in names_in(self.spark, f"{self.root}/{folder}") if n.startswith("_bucket=")]
        return Staged(name, frozenset(touched), {int(n.split("=")[1]): f"{folder}/{n}" for n in written}, spec)

    def rows_of(self, staged: Staged) -> DataFrame:
        """What was staged, to derive more from it before it is committed."""
        folders = {str(b): f for b, f in staged.folders.items()}
        return self._read(staged.spec | {"folders": folders}, sorted(staged.folders))

    def commit(self, base: Manifest, staged: list[Staged], **notes) -> Manifest:
        """Put all staged buckets in force at once, or raise FileExistsError if another change came first."""
        tables = dict(base.tables)
        for s in staged:
            old = {b: f for b, f in s.spec["folders"].items() if int(b) not in s.touched}
            tables[s.name] = s.spec | {"folders": old | {str(b): f for b, f in s.folders.items()}}
        new = Manifest(base.version + 1, tables, base.notes | notes)
        new_file(self.spark, self._manifest_path(new.version), json.dumps(vars(new)))
        return new

    def create(self, name: str, df: DataFrame, key: str, buckets: int = 16) -> None:
        """A new table, or a new state of all rows of a table."""
        base = self.manifest()
        spec = {"key": key, "buckets": buckets, "schema": df.schema.jsonValue(), "folders": {}}
        self.commit(base, [self.stage(name, df, spec, range(buckets), base)])

    def changed(self, base: Manifest, name: str, changes: DataFrame, next_state) -> Staged:
        """Stage ``next_state`` of the rows in the buckets of the changed keys."""
        spec = base.tables[name]
        touched = self._buckets_of(changes, spec)
        return self.stage(name, next_state(self._read(spec, touched)), spec, touched, base)

    def upsert(self, name: str, source: DataFrame, order: list[str]) -> None:
        """Rows replaced or extended by the source; its newest row wins per key."""
        base = self.manifest()
        key = base.tables[name]["key"]
        self.commit(base, [self.changed(base, name, source, lambda rows: upserted(rows, source, key, order))])

    def update(self, name: str, changes: DataFrame, column: str, value: str, order: list[str] | None = None) -> None:
        """``column`` set from ``changes[value]`` where the key matches."""
        base = self.manifest()
        key = base.tables[name]["key"]
        self.commit(base, [self.changed(base, name, changes, lambda rows: updated(rows, changes, key, column, value, order))])

    def delete(self, name: str, keys: DataFrame) -> None:
        base = self.manifest()
        key = base.tables[name]["key"]
        self.commit(base, [self.changed(base, name, keys, lambda rows: deleted(rows, keys, key))])

    def replace_slice(self, name: str, slice_rows: DataFrame, column: str) -> None:
        """Drop every row of the slice's values of ``column``, then add the new rows.

        Where ``column`` is not the key, the buckets that hold old rows of the slice are found by reading the two columns.
        """
        base = self.manifest()
        spec = base.tables[name]
        keys = slice_rows.select(spec["key"])
        if column != spec["key"]:
            values = slice_rows.select(column).distinct()
            keys = keys.union(self.table(name, base.version).join(values, column, "left_semi").select(spec["key"]))
        self.commit(base, [self.changed(base, name, keys, lambda rows: replaced_slice(rows, slice_rows, column))])

    def expire(self, keep: int = 2) -> None:
        """Remove manifests but the last ``keep``, and the files that only the removed ones, or lost writers before them, left."""
        known = self.versions()
        old, kept = known[:-keep], known[-keep:]
        if not old:
            return
        live = {f for v in kept for spec in self.manifest(v).tables.values() for f in spec["folders"].values()}
        for folder in names_in(self.spark, f"{self.root}/data"):
            if int(folder.split("-")[0]) >= kept[0]:  # written on top of a kept version, perhaps not committed yet
                continue
            for bucket in names_in(self.spark, f"{self.root}/data/{folder}"):
                if f"data/{folder}/{bucket}" not in live:
                    drop_folder(self.spark, f"{self.root}/data/{folder}/{bucket}")
        for version in old:
            drop_folder(self.spark, self._manifest_path(version))


def decide(store: BucketStore, items: str, decisions: str, new: DataFrame) -> None:
    """Record decisions and carry each into its action's status, in one commit."""
    base = store.manifest()
    choices = latest_per_key(new, ["action_id"], ["decided_at", "decision"])
    recorded = store.changed(base, decisions, choices, lambda rows: upserted(rows, choices, "action_id", ["decided_at"]))
    carried = store.changed(base, items, choices, lambda rows: updated(rows, choices, "action_id", "status", "decision"))
    store.commit(base, [recorded, carried])


def reset_decisions(store: BucketStore, items: str, decisions: str, keys: DataFrame, status: str = "PENDING") -> None:
    """Withdraw decisions and put their actions back in the queue, in one commit."""
    base = store.manifest()
    back = keys.select("action_id").distinct().withColumn("_status", F.lit(status))
    withdrawn = store.changed(base, decisions, back, lambda rows: deleted(rows, back, "action_id"))
    queued = store.changed(base, items, back, lambda rows: updated(rows, back, "action_id", "status", "_status"))
    store.commit(base, [withdrawn, queued])
