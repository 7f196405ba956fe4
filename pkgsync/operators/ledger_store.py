"""The ledger as an append-only store: a base, delta files of touched keys, and a manifest that names what counts.

A run appends only the rows that it changed.  Reading merges base and deltas (``ledger.current``: the latest row of each
key); ``compact`` folds them into a new base.  Data is written first and the manifest last, into a folder of its own that
Spark's committer fills at once, so a run killed in between leaves the snapshot before it readable, and its orphaned data
is never named.  One run writes at a time: two manifests of one number are an error.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ledger as LG

KEYS = {"repositories": LG.REPO_KEY, "packages": LG.PKG_KEY, "versions": LG.VER_KEY}
MANIFEST = "seq bigint, base string, deltas array<string>"


@dataclass(frozen=True)
class Snapshot:
    seq: int
    base: str | None = None
    deltas: list[str] = field(default_factory=list)


def changed(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` that are not in ``old`` as they are (nulls equal); both have one row per key."""
    values = [c for c in new.columns if c not in keys]
    was = old.select(*keys, F.struct(*values).alias("_was"))
    return new.join(was, keys, "left").where(F.col("_was").isNull() | ~F.struct(*values).eqNullSafe(F.col("_was"))).select(*new.columns)


class LedgerStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # --- manifests ---------------------------------------------------------------------

    def snapshot(self) -> Snapshot | None:
        """The current snapshot; None where no run has finished one."""
        try:
            found = (self.spark.read.schema(MANIFEST).option("recursiveFileLookup", "true").json(f"{self.root}/manifests")
                     .orderBy(F.desc("seq")).limit(2).collect())
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e):
                return None
            raise
        if len(found) == 2 and found[0]["seq"] == found[1]["seq"]:
            raise RuntimeError(f"two runs wrote snapshot {found[0]['seq']} of {self.root}")
        return Snapshot(found[0]["seq"], found[0]["base"], list(found[0]["deltas"])) if found else None

    def name(self, snapshot: Snapshot) -> Snapshot:
        """Write the manifest: from here on the snapshot counts."""
        row = self.spark.createDataFrame([(snapshot.seq, snapshot.base, snapshot.deltas)], MANIFEST)
        row.coalesce(1).write.json(f"{self.root}/manifests/{snapshot.seq:012d}-{uuid.uuid4().hex}")
        return snapshot

    def next_folder(self, now: Snapshot | None, kind: str) -> str:
        return f"{kind}/{(now.seq if now else -1) + 1:012d}-{uuid.uuid4().hex}"

    def write(self, folder: str, tables: dict[str, DataFrame]) -> None:
        """All three tables into a folder; those not given are empty."""
        for kind, schema in LG.SCHEMAS.items():
            table = tables[kind].select(*schema.names) if kind in tables else LG.empty_table(self.spark, kind)
            LG.write_snapshot(table, f"{self.root}/{folder}/{kind}")

    # --- tables ------------------------------------------------------------------------

    def create_if_absent(self, tables: dict[str, DataFrame] | None = None) -> Snapshot:
        """A10: an empty ledger (or one that begins with ``tables``) where there is none; an existing one stays."""
        now = self.snapshot()
        if now:
            return now
        if not tables:
            return self.name(Snapshot(0))
        folder = self.next_folder(None, "base")
        self.write(folder, tables)
        return self.name(Snapshot(0, folder))

    def clean(self) -> Snapshot:
        """The next snapshot is empty; earlier data stays on disk until it is removed from outside."""
        now = self.snapshot()
        return self.name(Snapshot(now.seq + 1 if now else 0))

    def part(self, folder: str, kind: str) -> DataFrame:
        return self.spark.read.schema(LG.SCHEMAS[kind]).parquet(f"{self.root}/{folder}/{kind}").select(*LG.SCHEMAS[kind].names)

    def read(self, now: Snapshot | None = None) -> dict[str, DataFrame]:
        """the tables as of a snapshot (the current one): the latest row of each key."""
        now = now or self.snapshot()
        out = {}
        for kind in LG.SCHEMAS:
            base = self.part(now.base, kind) if now and now.base else LG.empty_table(self.spark, kind)
            if now and now.deltas:
                rows = base.withColumn("_seq", F.lit(-1))
                for i, folder in enumerate(now.deltas):
                    rows = rows.unionByName(self.part(folder, kind).withColumn("_seq", F.lit(i)))
                base = LG.current(rows, KEYS[kind], "_seq").select(*LG.SCHEMAS[kind].names)
            out[kind] = base
        return out

    def append(self, tables: dict[str, DataFrame]) -> Snapshot:
        """New tables, written as the rows in which they differ from the current snapshot."""
        now = self.snapshot() or Snapshot(-1)
        old, folder = self.read(now), self.next_folder(now, "delta")
        self.write(folder, {kind: changed(old[kind], t.select(*LG.SCHEMAS[kind].names), KEYS[kind]) for kind, t in tables.items()})
        return self.name(Snapshot(now.seq + 1, now.base, [*now.deltas, folder]))

    def compact(self) -> Snapshot:
        """Base and deltas folded into a new base; earlier snapshots stay as they were."""
        now = self.snapshot() or Snapshot(-1)
        folder = self.next_folder(now, "base")
        self.write(folder, self.read(now))
        return self.name(Snapshot(now.seq + 1, folder))
