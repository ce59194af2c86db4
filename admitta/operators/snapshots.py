"""What changed between consecutive full snapshots (problem 5).

Of the last snapshot an index is kept: one row per key with the hash of its digest and the hash of its
compared values, bucketed by key in the shared folder. A new snapshot is reduced to such an index too,
from its own rows only; probing the kept one with it joins bucket by bucket without a shuffle. Values
are fetched for keys that came out as changed, and the new index takes the place of the old, whose
folder is dropped. Several snapshots that are due are indexed in one pass over their rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from admitta.session import delete_path, list_path, make_path, materialize, shared_dir

#: Rows of one snapshot in one bucket, about.
BUCKET_ROWS = 500_000
#: Deliveries are few; their list is refused beyond this.
MOST_RUNS = 100_000
#: Bits of the filter on changed keys, and its largest size: 2^20 broadcast rows of 64 bits.
BITS_A_KEY, MOST_BITS = 16, 1 << 26
COMPARED = ("name", "level", "duration_years", "admission_year", "spots_budget", "spots_tax")


def clean_key(col: Column) -> Column:
    """Key in lower case without any blanks; an empty one is null."""
    return F.nullif(F.lower(F.regexp_replace(col.cast("string"), r"\s+", "")), F.lit(""))


def clean_digest(col: Column) -> Column:
    """Digest in lower case without blanks and without an algorithm prefix; an empty one is null."""
    bare = F.lower(F.regexp_replace(col.cast("string"), r"\s+", ""))
    return F.nullif(F.regexp_replace(bare, r"^sha-?256:", ""), F.lit(""))


def pack_key(key: Column) -> Column:
    """Half the bytes for keys that are whole hex digests (tag 1), UTF-8 for all others (tag 0)."""
    is_hex = key.rlike("^(?:[0-9a-f]{2})+$")
    return F.when(is_hex, F.concat(F.lit(b"\x01"), F.unhex(key))).otherwise(F.concat(F.lit(b"\x00"), F.encode(key, "UTF-8")))


def unpack_key(packed: Column) -> Column:
    body = F.substring(packed, 2, 2**30)
    return F.when(F.substring(packed, 1, 1) == F.lit(b"\x01"), F.lower(F.hex(body))).otherwise(F.decode(body, "UTF-8"))


def values_hash(names: Sequence[str]) -> Column:
    """64-bit hash of the values, with nulls told apart from every value and from each other."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(f"`{n}`").cast("string")), F.lit("-")) for n in names]
    return F.xxhash64(*parts)


def full_runs(manifests: DataFrame, success: str = "success") -> DataFrame:
    """(run_id, run_ord): the full snapshots in order of their start, numbered from 0.

    The number of runs is small by nature (one row per delivery), so one window over all is fine.
    Runs without an id are left out; a run listed twice counts once, at its first start.
    """
    runs = (
        manifests.where((F.lower(F.trim("status")) == success) & F.col("run_id").isNotNull())
        .groupBy("run_id")
        .agg(F.min("started_at").alias("began"))
    )
    order = Window.orderBy(F.col("began").asc_nulls_first(), "run_id")
    return runs.select("run_id", (F.row_number().over(order) - 1).alias("run_ord"))


def run_order(manifests: DataFrame) -> list[str]:
    """The full snapshots in order: one row per delivery."""
    rows = full_runs(manifests).orderBy("run_ord").limit(MOST_RUNS + 1).collect()
    if len(rows) > MOST_RUNS:
        raise ValueError(f"more than {MOST_RUNS} full snapshots")
    return [r.run_id for r in rows]


def hashes(compared: Sequence[str]) -> Column:
    """What stands for a row: the latest scraped_at first, then the hashes, so that ties are settled."""
    digest = clean_digest(F.col("content_hash"))
    return F.struct(F.col("scraped_at").cast("timestamp").alias("at"), F.xxhash64(digest).alias("d"), digest.isNull().alias("no_d"), values_hash(compared).alias("v"))


@dataclass
class SnapshotIndex:
    """Bucketed key-to-hash index of the last snapshot, kept under ``label`` in the shared folder.

    ``open`` finds it again, also from another session; ``advance`` takes later snapshots in, returns
    what changed and swaps the index for that of the newest one; ``drop`` forgets it. A break between
    taking in and swapping leaves the older index, and the next ``advance`` starts from it again.
    """

    spark: SparkSession
    label: str
    compared: Sequence[str] = COMPARED
    buckets: int = 0
    current: str | None = None
    runs: list[str] = field(default_factory=list)

    @classmethod
    def open(cls, spark: SparkSession, label: str, compared: Sequence[str] = COMPARED, buckets: int = 0) -> SnapshotIndex:
        if not label.isidentifier() and not label.isalnum():
            raise ValueError(f"a label is letters, digits and underscores: {label!r}")
        index = cls(spark, label, compared, buckets)
        kept = [name for name in list_path(spark, index.root) if name.startswith("buckets=")]
        if kept:
            index.buckets = int(kept[0].partition("=")[2])
            index._create()
            spark.sql(f"ALTER TABLE {index.table_name} RECOVER PARTITIONS")
            index.runs = index._partitions()
        return index

    @property
    def root(self) -> str:
        return f"{shared_dir(self.spark)}/snapshot-index/{self.label}"

    @property
    def table_name(self) -> str:
        return f"snapshot_index_{self.label}"

    def _create(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table_name}")
        self.spark.sql(
            f"CREATE TABLE {self.table_name} (k BINARY, d BIGINT, v BIGINT, run_id STRING) USING parquet PARTITIONED BY (run_id)"
            f" CLUSTERED BY (k) SORTED BY (k) INTO {self.buckets} BUCKETS LOCATION '{self.root}/buckets={self.buckets}'"
        )

    def _partition(self, run_id: str) -> str:
        return f"PARTITION (run_id = '{_quoted(run_id)}')"

    def _partitions(self) -> list[str]:
        """The kept run, those of a broken advance and those just taken in."""
        return [unquote(r[0].partition("=")[2]) for r in self.spark.sql(f"SHOW PARTITIONS {self.table_name}").collect()]

    def _folder(self, run_id: str) -> str:
        return self.spark.sql(f"DESCRIBE FORMATTED {self.table_name} {self._partition(run_id)}").where("col_name = 'Location'").first().data_type

    def _forget(self, run_id: str) -> None:
        at = self._folder(run_id)
        self.spark.sql(f"ALTER TABLE {self.table_name} DROP {self._partition(run_id)}")
        delete_path(self.spark, at)
        self.runs.remove(run_id)

    def take_in(self, snapshots: DataFrame, due: Sequence[str]) -> None:
        """Index the rows of the runs that are due, in one pass.

        Repeated rows are combined on the map side, so a key delivered any number of times reaches one
        task as one row per map task. Rows without key are left out; a null ``scraped_at`` is older
        than any; ties are settled by the hashes.
        """
        rows = snapshots.where(F.col("run_id").isin(list(due)))
        if not self.buckets:
            self.buckets = max(1, min(1 << 17, -(-rows.count() // (BUCKET_ROWS * len(due)))))
        if not self.spark.catalog.tableExists(self.table_name):
            self._create()
        keyed = rows.select(pack_key(clean_key(F.col("uid"))).alias("k"), F.col("run_id").alias("run_id"), hashes(self.compared).alias("e")).where(F.col("k").isNotNull())
        last = keyed.groupBy("k", "run_id").agg(F.max("e").alias("e"))
        index = last.select("k", F.when(~F.col("e.no_d"), F.col("e.d")).alias("d"), F.col("e.v").alias("v"), "run_id")
        # all of a run's bucket in one task, which writes one sorted file of it
        placed = index.repartition(min(self.buckets * len(due), 1 << 17), "run_id", F.pmod(F.hash("k"), F.lit(self.buckets)))
        placed.write.mode("append").option("compression", "zstd").insertInto(self.table_name)
        there = self._partitions()
        for run_id in [r for r in due if r not in there]:  # a snapshot without rows is one, too
            self.spark.sql(f"ALTER TABLE {self.table_name} ADD IF NOT EXISTS {self._partition(run_id)}")
            make_path(self.spark, self._folder(run_id))
        self.runs += due

    def of(self, run_id: str) -> DataFrame:
        return self.spark.table(self.table_name).where(F.col("run_id") == run_id).select("k", "d", "v", F.lit(True).alias("here"))

    def probe(self, old_id: str, run_id: str) -> DataFrame:
        """(run_id, k, change_kind) of a snapshot against the index of the one before, bucket by bucket."""
        old = self.of(old_id).select(F.col("k").alias("ko"), F.col("d").alias("do"), F.col("v").alias("vo"), F.col("here").alias("was"))
        differs = F.when(F.col("d").isNotNull() & F.col("do").isNotNull(), F.col("d") != F.col("do")).otherwise(F.col("v") != F.col("vo"))
        kind = F.when(F.col("was").isNull(), "added").when(F.col("here").isNull(), "removed").when(differs, "changed")
        both = self.of(run_id).join(old.hint("merge"), F.col("k") == F.col("ko"), "full_outer")
        return both.select(F.lit(run_id).alias("run_id"), F.coalesce("k", "ko").alias("k"), kind.alias("change_kind")).where(F.col("change_kind").isNotNull())

    def advance(self, snapshots: DataFrame, order: Sequence[str], keep: bool = True) -> DataFrame:
        """(run_id, before_id, uid, change_kind) of the full snapshots after the kept one.

        ``order`` lists the full snapshots so far; those up to the kept one are not read again. A kept
        run that is no longer listed starts anew with the first one. Without ``keep`` nothing is swapped,
        for an index that is dropped next.
        """
        known = [r for r in order if r in self.runs]
        self.current = known[0] if known else None
        for run_id in [r for r in self.runs if r != self.current]:
            self._forget(run_id)
        due = list(order[order.index(self.current) + 1 :]) if self.current else list(order)
        if due:
            self.take_in(snapshots, due)
        steps = [r for r in ([self.current] if self.current else []) + due if r]
        parts = [self.probe(a, b).select("run_id", F.lit(a).alias("before_id"), unpack_key(F.col("k")).alias("uid"), "change_kind") for a, b in zip(steps, steps[1:])]
        out = self.spark.createDataFrame([], "run_id string, before_id string, uid string, change_kind string")
        for k, part in enumerate(parts):
            out = part if k == 0 else out.unionAll(part)
        if parts:
            out = materialize(out)
        if steps and keep:
            self.swap(steps[-1])
        return out

    def swap(self, run_id: str) -> None:
        """The index of ``run_id`` is the kept one; all others are dropped."""
        self.current = run_id
        for other in [r for r in self.runs if r != run_id]:
            self._forget(other)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table_name}")
        delete_path(self.spark, self.root)
        self.runs, self.current = [], None


def _quoted(s: str) -> str:
    return s.replace("\\", "\\\\").replace("'", "\\'")


def diff_snapshots(snapshots: DataFrame, manifests: DataFrame, compared: Sequence[str] = COMPARED, buckets: int = 0) -> DataFrame:
    """(run_id, before_id, uid, change_kind) for every pair of consecutive full snapshots.

    ``change_kind`` is added, removed or changed; the first snapshot gives no rows, and with fewer
    than two full snapshots the result is empty. The index lives for this one call.
    """
    index = SnapshotIndex.open(snapshots.sparkSession, uuid.uuid4().hex, compared, buckets)
    try:
        return index.advance(snapshots, run_order(manifests), keep=False)
    finally:
        index.drop()


def key_filter(keys: DataFrame, hashed: str) -> tuple[DataFrame, int]:
    """(word, bits): a bit per hash of the keys, in words of 64 bits, and the number of bits.

    ``MOST_BITS`` bounds the words whatever the number of keys; a full filter only lets more rows pass.
    """
    bits = 1 << 16
    n = keys.count()
    while bits < min(MOST_BITS, BITS_A_KEY * n):
        bits *= 2
    words = keys.select(F.pmod(F.col(hashed), F.lit(bits)).alias("p")).select(F.shiftright("p", 6).alias("word"), F.expr("shiftleft(1L, cast(p & 63 AS INT))").alias("bit"))
    return words.groupBy("word").agg(F.bit_or("bit").alias("bits")), bits


def changed_values(changes: DataFrame, snapshots: DataFrame, compared: Sequence[str] = COMPARED) -> DataFrame:
    """Old and new values of the keys that changed: (run_id, uid, old, new), structs of the compared columns.

    Only rows of runs with changes are read, and only those that a filter on the changed keys lets
    pass are shuffled.
    """
    changed = changes.where(F.col("change_kind") == "changed").select("run_id", "before_id", "uid")
    sides = F.array(*(F.struct(F.col(c).alias("from_id"), F.lit(side).alias("side")) for c, side in (("run_id", "new"), ("before_id", "old"))))
    wanted = materialize(changed.select("uid", "run_id", F.explode(sides).alias("w")).select("uid", "w.*", "run_id").withColumn("h", F.xxhash64("uid", "from_id")))
    runs = [r[0] for r in wanted.select("from_id").distinct().collect()]  # at most one per delivery
    words, bits = key_filter(wanted, "h")
    rows = snapshots.where(F.col("run_id").isin(runs)).select(clean_key(F.col("uid")).alias("uid"), F.col("run_id").alias("from_id"), hashes(compared).alias("rank"), F.struct(*(F.col(f"`{c}`") for c in compared)).alias("vals"))
    place = F.pmod(F.xxhash64("uid", "from_id"), F.lit(bits))
    tested = rows.withColumn("p", place).withColumn("word", F.shiftright("p", 6)).join(F.broadcast(words), "word").where(F.expr("bits & shiftleft(1L, cast(p & 63 AS INT))") != 0)
    latest = tested.groupBy("uid", "from_id").agg(F.max_by("vals", "rank").alias("vals"))
    side = lambda s: F.max_by(F.when(F.col("side") == s, F.col("vals")), F.when(F.col("side") == s, F.lit(1))).alias(s)
    return latest.join(wanted, ["uid", "from_id"]).groupBy("run_id", "uid").agg(side("old"), side("new"))
