"""Messages delivered more than once: an exactly-once table that takes in batches.

The table keeps one row of every identifier. Its rows lie in partitions by time of arrival; an identifier index holds the hash of every identifier with the partition in which it lies. merge() looks up the identifiers of a batch in the index, reads only the partitions that the index names and those the batch's own rows belong to, recomputes the single winners over both together, and puts new versions of just those partitions in place with one rename of a manifest. A crash before that rename leaves the old version whole; a reader sees one version or the other. Every writer writes to folders of its own, so one that loses the race for a version has touched nothing that the winner published.

The index is made of deltas, one a batch, each cut into buckets by a function of the identifier. A batch reads only the buckets that its own identifiers fall into, and adds only its own identifiers. A delta takes up the smaller ones before it, so their number grows with the logarithm of the rows. An identifier whose winner moved keeps its old entry, which at worst names a partition that need not be read.

Hot identifiers: winners come from a partially aggregated minimum and losers are found by identifier and order value together, so no task gets all copies of one identifier.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.session import small
from barloom.storage import Files

#: Buckets of an index whose place is not given.
BUCKETS = 64


@dataclass
class Merge:
    """What one merge() did."""

    version: int
    rewritten: list[str] = field(default_factory=list)
    looked_up: list[str] = field(default_factory=list)
    removed_rows: int = 0
    index_files: int = 0


class MessageTable:
    """root: a folder that all executors share. id_columns: the identifier; a row with a null in one of required has no identity and is passed through untouched. order_column: the winner of an identifier is the row with its smallest value; a null there loses against any value. Rows of an identifier that tie in it are the same delivery stored twice: one of them is kept and the others are counted as removed. partition: an expression for the arrival partition; null goes to partition pnone.

    cluster: messages don't come in order of arrival, so rows are brought together by partition before they are written; without it a task writes a file for each partition it sees, which are few where the input is in order, and the rows aren't shuffled.
    bucket: an expression over the identifier's columns alone that says where in the index an identifier lies, with values that are few and fit into a path; identifiers that come together should lie together, as by the time in them. Default: BUCKETS ranges of the identifier's hash.

    Columns of the messages that start with _mt_ would clash with the table's own and are refused. The partitions and the buckets, which the driver lists, are bounded by the time the table spans, not by its rows.
    """

    def __init__(self, spark: SparkSession, root: str, id_columns: dict[str, Column], required: list[str], order_column: str, partition: Column, cluster: bool = False, bucket: Column | None = None):
        self.cluster = cluster
        self.spark, self.files = spark, Files(spark, root)
        self.ids, self.required, self.order = id_columns, required, order_column
        self.names = [f"_mt_{n}" for n in id_columns]
        self.partition = F.concat(F.lit("p"), F.coalesce(partition.cast("string"), F.lit("none")))
        spread = F.pmod(F.xxhash64(*self.names), F.lit(BUCKETS)) if bucket is None else bucket
        self.bucket = F.concat(F.lit("b"), F.coalesce(spread.cast("string"), F.lit("none")))
        self.known = reduce(lambda a, b: a & b, [F.col(f"_mt_{n}").isNotNull() for n in required])

    # -- versions

    def _manifest(self) -> dict:
        """version; partitions: {name: folder}; removed: [folder]; index: [{at, rows, buckets}], the oldest and largest delta first."""
        versions = [int(n[:-5]) for n in self.files.names("_manifest") if n.endswith(".json") and n[:-5].isdigit()]
        if not versions:
            return {"version": 0, "partitions": {}, "removed": [], "index": []}
        return json.loads(self.files.read_text("_manifest", f"{max(versions):08d}.json"))

    def _data(self, parts: dict[str, str]) -> DataFrame | None:
        """The given partitions from their folders; each folder is one scan."""
        by: dict[str, list[str]] = {}
        for p, v in parts.items():
            by.setdefault(v, []).append(p)
        got = []
        for v, ps in sorted(by.items()):
            base = f"{self.files.root}/data/{v}"
            got.append(self.spark.read.option("basePath", base).parquet(*[f"{base}/_mt_part={p}" for p in sorted(ps)]))
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), got) if got else None

    def _index(self, deltas: list[dict], buckets: set[str] | None = None) -> DataFrame | None:
        """(_mt_hash, _mt_part, _mt_bucket) of the given buckets, of all if None; other buckets aren't opened."""
        got = []
        for d in deltas:
            base = f"{self.files.root}/index/{d['at']}"
            some = sorted(d["buckets"] if buckets is None else buckets & set(d["buckets"]))
            if some:
                got.append(self.spark.read.schema("_mt_hash long, _mt_part string, _mt_bucket string").option("basePath", base).parquet(*[f"{base}/_mt_bucket={b}" for b in some]))
        return reduce(DataFrame.unionByName, got) if got else None

    # -- reading

    def read(self) -> DataFrame | None:
        """One row of every identifier, and the rows without identity; None before the first merge."""
        got = self._data(self._manifest()["partitions"])
        return None if got is None else got.drop("_mt_h1", "_mt_h2", "_mt_part")

    def removed(self) -> DataFrame:
        """The order values of all rows that were taken out as further copies, over all merges, one row for each."""
        folders = self._manifest()["removed"]
        if not folders:
            raise ValueError("nothing was merged yet")
        gone = self.spark.read.parquet(*[f"{self.files.root}/removed/{v}" for v in folders])
        # Copies of one order value are few; where a delivery was stored very often, its rows are spread over the pieces of the count.
        piece = F.lit(100_000)
        parts = gone.select(self.order, F.explode(F.sequence(F.lit(0).cast("long"), F.col("_mt_copies") - 1, piece)).alias("_mt_i"), "_mt_copies")
        return parts.select(self.order, F.explode(F.sequence(F.col("_mt_i"), F.least(F.col("_mt_i") + piece, F.col("_mt_copies")) - 1))).select(self.order)

    def vacuum(self) -> None:
        """Deletes folders and partitions that the current manifest does not name. Not to be run beside a reader of an older version or a writer."""
        now = self._manifest()
        live = {(p, v) for p, v in now["partitions"].items()}
        for v in self.files.names("data"):
            for part in self.files.names("data", v):
                if part.startswith("_mt_part=") and (part.partition("=")[2], v) not in live:
                    self.files.delete("data", v, part)
        for kind, named in (("index", {d["at"] for d in now["index"]}), ("removed", set(now["removed"])), ("winners", set()), ("keys", set())):
            for v in self.files.names(kind):
                if v not in named:
                    self.files.delete(kind, v)

    # -- merging

    def _keyed(self, df: DataFrame) -> DataFrame:
        """df with its partition and, where it has an identity, a hash of 128 bits that stands for the identifier, and its bucket."""
        df = df.withColumns({f"_mt_{n}": c for n, c in self.ids.items()})
        two = {"_mt_h1": F.xxhash64(*self.names), "_mt_h2": F.xxhash64(F.lit(1), *self.names), "_mt_bucket": self.bucket}
        return df.withColumns({n: F.when(self.known, c) for n, c in two.items()} | {"_mt_part": self.partition}).drop(*self.names)

    def merge(self, incoming: DataFrame) -> Merge:
        """Takes in a batch, which is read twice and must be the same each time: a table, not a sample or a clock. An empty one makes a version in which nothing changed. A null in a column that is no identifier, or in the partition, changes nothing about identity; columns that a batch lacks or adds are null for the other rows. Raises if another writer published the same version first; nothing is changed then and the batch can be merged again."""
        if bad := [c for c in incoming.columns if c.startswith("_mt_")]:
            raise ValueError(f"columns reserved for the table: {bad}")
        now = self._manifest()
        version = now["version"] + 1
        own = f"v={version:08d}-{uuid.uuid4().hex[:12]}"  # this writer's folders
        pair = ["_mt_h1", "_mt_h2"]

        # 1. The index names the partitions that hold identifiers of the batch.
        batch = self._keyed(incoming)
        keys = self._written(batch.select(*pair, F.col(self.order).alias("_mt_order"), "_mt_part", "_mt_bucket"), "keys", own)
        seen = keys.groupBy("_mt_part", "_mt_bucket").count().collect()
        parts_in, buckets = {r[0] for r in seen}, {r[1] for r in seen if r[1] is not None}
        index = self._index(now["index"], buckets)
        looked_up: list[str] = []
        if index is not None:
            asked = keys.where("_mt_h1 is not null").select(F.col("_mt_h1").alias("_mt_hash")).distinct()
            looked_up = sorted(r[0] for r in index.join(asked, "_mt_hash", "left_semi").select("_mt_part").distinct().collect() if r[0] in now["partitions"])
        touched = sorted({*looked_up, *(parts_in & set(now["partitions"]))})

        # 2. Those partitions and the batch together.
        history = self._data({p: now["partitions"][p] for p in touched})
        narrow = keys.select(*pair, "_mt_order")
        if history is not None:
            narrow = history.select(*pair, F.col(self.order).alias("_mt_order")).unionByName(narrow)
        narrow = narrow.where("_mt_h1 is not null").select(*pair, F.struct(F.col("_mt_order").isNull().alias("late"), F.col("_mt_order").alias("at")).alias("_mt_order"))

        # 3. Single winners: a partially aggregated minimum. Its losers by identifier and order value together.
        winners = narrow.groupBy(*pair).agg(F.min("_mt_order").alias("_mt_best"), F.count(F.lit(1)).alias("_mt_n")).where("_mt_n > 1")
        winners = self._written(winners, "winners", own)
        total, n_ids = winners.agg(F.coalesce(F.sum("_mt_n"), F.lit(0)), F.count(F.lit(1))).first()
        copies = narrow.join(small(winners.drop("_mt_n"), n_ids, 48), pair).withColumn("_mt_won", F.col("_mt_order").eqNullSafe(F.col("_mt_best")))
        copies = copies.groupBy(*pair, F.col("_mt_order.at").alias(self.order), "_mt_won").agg(F.count(F.lit(1)).alias("_mt_copies"))
        gone = copies.withColumn("_mt_copies", F.col("_mt_copies") - F.col("_mt_won").cast("long")).where("_mt_copies > 0")
        gone = self._written(gone, "removed", own)
        n_gone, n_lost, n_tied = gone.agg(F.coalesce(F.sum("_mt_copies"), F.lit(0)), F.count(F.when(~F.col("_mt_won"), 1)), F.count(F.when(F.col("_mt_won"), 1))).first()
        if n_gone != total - n_ids:
            raise RuntimeError("the batch changed while it was read")

        # 4. New versions of the touched partitions, nothing else.
        out = batch.drop("_mt_bucket")
        if history is not None:
            out = history.unionByName(out, allowMissingColumns=True)
        at = F.col(self.order).eqNullSafe(F.col("_mt_at"))
        same = (F.col("_mt_h1") == F.col("_mt_g1")) & (F.col("_mt_h2") == F.col("_mt_g2")) & at
        gone = gone.select(F.col("_mt_h1").alias("_mt_g1"), F.col("_mt_h2").alias("_mt_g2"), F.col(self.order).alias("_mt_at"), "_mt_won")
        kept = out.join(small(gone.where("not _mt_won").drop("_mt_won"), n_lost, 48), same, "left_anti") if n_lost else out
        if n_tied:
            tied = small(gone.where("_mt_won").drop("_mt_won"), n_tied, 48)
            kept = kept.join(tied, same, "left_anti").unionByName(kept.join(tied, same, "left_semi").dropDuplicates(pair))
        if self.cluster:
            kept = kept.hint("rebalance", "_mt_part")
        self._write(kept, "data", own, "_mt_part")
        new = [n.partition("=")[2] for n in self.files.names("data", own) if n.startswith("_mt_part=")]
        parts = {p: v for p, v in now["partitions"].items() if p not in touched} | {p: own for p in new}

        # 5. The batch's identifiers as a delta of the index, together with the smaller deltas before it.
        deltas = list(now["index"])
        if buckets:
            delta = keys.where("_mt_h1 is not null").select(F.col("_mt_h1").alias("_mt_hash"), "_mt_part", "_mt_bucket")
            rows, older = sum(r[2] for r in seen if r[1] is not None), []
            while deltas and deltas[-1]["rows"] <= rows:
                older.append(deltas.pop())
                rows += older[-1]["rows"]
            if older:
                delta = delta.unionByName(self._index(older))
            delta = delta.hint("rebalance", "_mt_bucket").sortWithinPartitions("_mt_bucket", "_mt_hash")
            self._write(delta, "index", own, "_mt_bucket")
            there = [n.partition("=")[2] for n in self.files.names("index", own) if n.startswith("_mt_bucket=")]
            deltas.append({"at": own, "rows": rows, "buckets": there})

        # 6. One rename makes all of it visible.
        manifest = {"version": version, "partitions": parts, "removed": [*now["removed"], own], "index": deltas}
        if not self.files.write_new(json.dumps(manifest), "_manifest", f"{version:08d}.json"):
            for kind in ("data", "index", "removed", "winners", "keys"):
                self.files.delete(kind, own)
            raise RuntimeError(f"another writer put version {version} in place first; merge again")
        self.files.delete("winners", own)
        self.files.delete("keys", own)
        return Merge(version, touched, looked_up, int(n_gone), 0 if index is None else len(index.inputFiles()))

    def _written(self, df: DataFrame, kind: str, own: str) -> DataFrame:
        self._write(df, kind, own)
        return self.spark.read.schema(df.schema).parquet(f"{self.files.root}/{kind}/{own}")

    def _write(self, df: DataFrame, kind: str, own: str, by: str | None = None) -> None:
        w = df.write.mode("error").option("partitionOverwriteMode", "static")
        (w.partitionBy(by) if by else w).parquet(f"{self.files.root}/{kind}/{own}")
