"""Partitioned Parquet store of the whole model, with a manifest for each snapshot.

Rows are dealt to partitions by a hash of the table's key. A commit writes files for the
partitions it touches and a manifest that lists them beside all files it takes over from
the snapshot before, so its cost follows the change and not the table. A snapshot exists
once its manifest is whole; a failed write leaves the old one readable. Old snapshots are
expired, with the files that no kept snapshot names.

``put`` replaces all rows of some keys by adding files: the newest put of a key hides its
older rows when a partition is read, and a partition that has gathered several puts is
compacted. A commit may carry the query and number of a streaming batch; the manifest
remembers the last one of each query, so a batch that is replayed changes nothing.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from decreta.schemas import TABLES
from decreta.session import shuffled

# Key whose rows are replaced together; other tables go by their id.
KEYS = {"registry_sources": "code", "assignments": "order_id"}
PARTITIONS = 16
# Snapshots that stay readable, and puts in a partition that make it worth compacting.
KEPT_SNAPSHOTS, COMPACT_PUTS = 3, 8

_MANIFEST = "part int, path string, seq bigint, puts boolean, query string, batch bigint"
# Commit of a row, whether it replaces older rows of its key, and whether it only does that.
_INTERNAL = "_seq bigint, _put boolean, _gone boolean"


@dataclass(frozen=True)
class Entry:
    """A file of a snapshot, or (without a path) the last batch of a query."""

    part: int | None
    path: str | None
    seq: int
    puts: bool
    query: str | None = None
    batch: int | None = None


class Store:
    """Named tables under one folder."""

    def __init__(self, spark: SparkSession, root: str, partitions: int = PARTITIONS,
                 keep: int = KEPT_SNAPSHOTS, compact_puts: int = COMPACT_PUTS):
        self.spark, self.root = spark, root.rstrip("/")
        self.partitions, self.keep, self.compact_puts = partitions, keep, compact_puts

    # --- snapshots -----------------------------------------------------------------------
    def _files(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def _names(self, path: str) -> list[str]:
        fs, place = self._files(path)
        return [s.getPath().getName() for s in fs.listStatus(place)] if fs.exists(place) else []

    def snapshots(self, name: str) -> list[int]:
        """Numbers of the readable snapshots, ascending."""
        folder = f"{self.root}/{name}/manifests"
        return sorted(int(n.split("=")[1]) for n in self._names(folder) if n.startswith("seq=") and "_SUCCESS" in self._names(f"{folder}/{n}"))

    def entries(self, name: str, seq: int | None = None) -> list[Entry]:
        """Files and batches of a snapshot, the newest one unless ``seq`` is given: as
        many as there are partitions, times the puts and splits of each."""
        known = self.snapshots(name)
        if not known:
            return []
        path = f"{self.root}/{name}/manifests/seq={seq or known[-1]:012d}"
        return [Entry(**r.asDict()) for r in self.spark.read.schema(_MANIFEST).parquet(path).collect()]

    def read(self, name: str, seq: int | None = None) -> DataFrame:
        """A snapshot with the declared schema; empty when there is none yet."""
        return self._visible(name, self.entries(name, seq)).select(self._columns(name))

    def _columns(self, name: str) -> list[str]:
        return self.spark.createDataFrame([], TABLES[name]).columns

    def _visible(self, name: str, entries: list[Entry]) -> DataFrame:
        """Rows that no newer put of their key hides."""
        key = KEYS.get(name, "id")
        merged = {e.part for e in entries if e.puts}

        def load(paths: list[str]) -> DataFrame:
            ddl = f"{TABLES[name]}, {_INTERNAL}"
            return self.spark.read.schema(ddl).parquet(*paths) if paths else self.spark.createDataFrame([], ddl)

        plain = load([e.path for e in entries if e.path and e.part not in merged])
        if not merged:
            return plain
        rows = load([e.path for e in entries if e.path and e.part in merged])
        puts = load([e.path for e in entries if e.puts]).filter("_put")
        newest = puts.groupBy(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("_key")).agg(F.max("_seq").alias("_newest"))
        seen = rows.join(shuffled(newest), F.coalesce(F.col(key).cast("string"), F.lit("")) == F.col("_key"), "left").filter(
            "NOT _gone AND (_newest IS NULL OR _seq >= _newest)").drop("_key", "_newest")
        return plain.unionByName(seen)

    # --- changes -------------------------------------------------------------------------
    def append(self, name: str, df: DataFrame, batch: tuple[str, int] | None = None) -> bool:
        """Add rows. Like every change: false if the batch was applied before."""
        return self._change(name, self._shaped(name, df), False, batch, lambda old, _: old)

    def overwrite(self, name: str, df: DataFrame, batch: tuple[str, int] | None = None) -> bool:
        """Put ``df``, which may be computed from the table, in the place of all rows."""
        return self._change(name, self._shaped(name, df), False, batch, lambda old, _: [e for e in old if e.path is None])

    def put(self, name: str, df: DataFrame, touched: DataFrame | None = None, batch: tuple[str, int] | None = None) -> bool:
        """Replace all rows of the touched keys (those of ``df``, and of ``touched``, whose
        keys may have no new rows). Only the partitions of these keys get files."""
        key, rows = KEYS.get(name, "id"), self._shaped(name, df)
        if touched is not None:
            gone = self._shaped(name, touched.select(key).distinct()).withColumn("_gone", F.lit(True))
            rows = rows.unionByName(gone)
        done = self._change(name, rows, True, batch, lambda old, _: old)
        if done:
            self.compact(name)
        return done

    def compact(self, name: str) -> int:
        """Merge the puts of partitions that have gathered ``compact_puts`` of them;
        returns how many partitions were written anew."""
        entries = self.entries(name)
        commits = {}
        for e in entries:
            if e.puts:
                commits.setdefault(e.part, set()).add(e.seq)
        full = {p for p, seqs in commits.items() if len(seqs) >= self.compact_puts}
        if full:
            rows = self._visible(name, [e for e in entries if e.part in full])
            self._change(name, rows.drop("_seq", "_put"), False, None, lambda old, _: [e for e in old if e.part not in full])
        return len(full)

    def _change(self, name: str, rows: DataFrame, puts: bool, batch: tuple[str, int] | None, kept) -> bool:
        """Write the files of a commit, then its manifest. Another writer that commits
        first makes this one fail, and its files are left to expiry."""
        known = self.snapshots(name)
        old = self.entries(name)
        if batch and any(e.query == batch[0] and e.batch >= batch[1] for e in old if e.path is None):
            return False
        seq = (known[-1] if known else 0) + 1
        new = [Entry(p, path, seq, puts) for p, path in self._write(name, rows, seq, puts)]
        entries = kept(old, new) + new
        if batch:
            entries = [e for e in entries if e.query != batch[0]] + [Entry(None, None, seq, False, *batch)]
        manifest = self.spark.createDataFrame([(e.part, e.path, e.seq, e.puts, e.query, e.batch) for e in entries], _MANIFEST)
        manifest.coalesce(1).write.mode("errorifexists").parquet(f"{self.root}/{name}/manifests/seq={seq:012d}")
        self._expire(name, seq)
        return True

    def _write(self, name: str, rows: DataFrame, seq: int, puts: bool) -> list[tuple[int, str]]:
        """One file for each partition that has rows; a partition beyond the advisory size
        of a task is split by Spark."""
        key = F.coalesce(F.col(KEYS.get(name, "id")).cast("string"), F.lit(""))
        dealt = rows.withColumns({"_seq": F.lit(seq).cast("bigint"), "_put": F.lit(puts), "_part": F.pmod(F.xxhash64(key), F.lit(self.partitions)).cast("int")})
        folder = f"{self.root}/{name}/data/c{seq}-{uuid.uuid4().hex}"
        dealt.hint("rebalance", "_part").write.partitionBy("_part").parquet(folder)
        parts = [n for n in self._names(folder) if n.startswith("_part=")]
        return [(int(p.split("=")[1]), f"{folder}/{p}/{f}") for p in parts for f in self._names(f"{folder}/{p}") if f.endswith(".parquet")]

    def _expire(self, name: str, seq: int) -> None:
        """Drop snapshots but the newest ``keep``, and data that none of those names."""
        known = self.snapshots(name)
        kept, old = known[-self.keep:], known[:-self.keep]
        if not old:
            return
        used = {e.path.rsplit("/", 3)[1] for s in kept for e in self.entries(name, s) if e.path}
        for s in old:
            self._delete(f"{self.root}/{name}/manifests/seq={s:012d}")
        for folder in self._names(f"{self.root}/{name}/data"):
            if folder not in used and int(folder[1:].split("-")[0]) < kept[0]:
                self._delete(f"{self.root}/{name}/data/{folder}")

    def _delete(self, path: str) -> None:
        fs, place = self._files(path)
        fs.delete(place, True)

    def _shaped(self, name: str, df: DataFrame) -> DataFrame:
        """Declared columns in order; missing ones are null."""
        want = self.spark.createDataFrame([], TABLES[name]).schema
        have = set(df.columns)
        return df.select(*[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in want], F.lit(False).alias("_gone"))


def append_log(store: Store, entries: DataFrame) -> None:
    """Append processing-log entries."""
    store.append("processing_log", entries)
