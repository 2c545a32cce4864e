"""The request table, merged on read.

Rows lie in ``buckets`` hash buckets of the request id. A batch of change rows is
written as change files of the buckets that it touches and listed in a new
manifest; ``compact`` rewrites only the buckets that have change files, as new
base files. Every manifest is its own version and names the live folders of each
bucket, so readers see whole batches, nothing live is overwritten, and a bucket
that a batch does not touch is neither read nor written.

An upsert keeps what belongs to the first row of a request: ``opportunity_id`` and
``created_at`` (the time of its first change). All other columns are those of its
highest ``change_seq``, in whatever order the batches come. ``validation_errors``
is kept as JSON text. A batch number that a manifest already names is not applied
again, so a retried batch changes nothing.

Rows per status (E2, E3, O2) are kept with the table: a batch gives -1 for the
status that a request leaves and +1 for the one that it gets, merged into the
counts of the version before. They are written before the manifest that names
them, so rows and counts are always of the same batches. A batch reads three
columns of the buckets that it touches; nothing is ever counted in full again.
A change older than the row that the table has moves no count.

Scale: the manifest holds a few paths per bucket (the bucket count is fixed when
the table is made and meant to give buckets of about a gigabyte); merging is one
partial aggregate over the touched buckets' rows. Driver: the manifest and the
touched bucket numbers. One writer at a time.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans import policy as P

LATEST = ["status", "validation_errors", "approved_by", "approved_at", "registration_number", "submitted_at", "error", "updated_at", "change_seq"]
SCHEMA = ("request_id string, opportunity_id string, status string, validation_errors string, approved_by string, approved_at timestamp, "
          "registration_number string, submitted_at timestamp, error string, updated_at timestamp, change_seq long, created_at timestamp, first_seq long")


def merged(rows: DataFrame) -> DataFrame:
    """One row per request: the columns of its highest ``change_seq``, the first row's
    ``opportunity_id`` and ``created_at``."""
    last = F.max_by(F.struct(*LATEST), "change_seq").alias("l")
    first = F.min_by(F.struct("opportunity_id", "created_at", "first_seq"), "first_seq").alias("f")
    return rows.groupBy("request_id").agg(last, first).select(
        "request_id", "f.opportunity_id", *[f"l.{c}" for c in LATEST], "f.created_at", "f.first_seq")


def status_moves(before: DataFrame, batch: DataFrame) -> DataFrame:
    """``(status, n)``: what a batch of one row per request adds to the counts.
    Both sides have ``request_id, status, change_seq``; ``before`` needs only the
    batch's requests. NULL is a status like any other."""
    old = before.select(F.col("request_id").alias("known"), F.col("status").alias("was"), F.col("change_seq").alias("seq"))
    both = batch.join(old, F.col("request_id") == F.col("known"), "left")
    new = F.col("known").isNull()
    moved = (F.col("change_seq") > F.col("seq")) & ~F.col("status").eqNullSafe(F.col("was"))
    gain, loss = F.struct("status", F.lit(1).alias("n")), F.struct(F.col("was").alias("status"), F.lit(-1).alias("n"))
    steps = F.when(new, F.array(gain)).when(moved, F.array(gain, loss))
    return both.select(F.inline(steps)).groupBy("status").agg(F.sum("n").cast("long").alias("n"))


def merged_counts(counts: DataFrame, moves: DataFrame) -> DataFrame:
    """Stored counts and moves as one row per status that any request has."""
    return counts.unionByName(moves).groupBy("status").agg(F.sum("n").cast("long").alias("n")).where("n <> 0")


def json_text(errors: str = "validation_errors"):
    """The JSON text of a list; a missing list is the empty one."""
    return F.coalesce(F.to_json(errors), F.lit("[]"))


@dataclass
class RequestTable:
    spark: SparkSession
    root: str
    buckets: int = 64

    def _versions(self) -> list[int]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/manifest")
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return []
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path
        whole = [s.getPath() for s in fs.listStatus(path) if fs.exists(hadoop(s.getPath(), "_SUCCESS"))]
        return sorted(int(p.getName().split("=")[1]) for p in whole)

    def manifest(self) -> dict:
        """The newest whole manifest: the table's state."""
        versions = self._versions()
        if not versions:
            return {"version": 0, "buckets": self.buckets, "batches": [], "live": {}, "counts": None}
        text = self.spark.read.text(f"{self.root}/manifest/version={versions[-1]}", wholetext=True).first()[0]
        return json.loads(text)

    def _commit(self, now: dict, **changes) -> dict:
        new = {**now, **changes, "version": now["version"] + 1}
        one = self.spark.createDataFrame([(json.dumps(new),)], "value string").coalesce(1)
        one.write.mode("overwrite").text(f"{self.root}/manifest/version={new['version']}")
        return new

    def _write(self, rows: DataFrame, folder: str, buckets: int) -> list[int]:
        """Writes ``rows`` by bucket; the buckets that got any."""
        bucket = F.pmod(F.xxhash64("request_id"), F.lit(buckets)).cast("int")
        path = f"{self.root}/{folder}"
        rows.withColumn("bucket", bucket).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)
        return [r.bucket for r in self.spark.read.schema("bucket int").parquet(path).select("bucket").distinct().collect()]

    def _read(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(*[f"{self.root}/{f}" for f in folders])

    def apply(self, changes: DataFrame, batch: int) -> dict:
        """Adds a batch of change rows (``validation_errors`` as a list or as text)."""
        now = self.manifest()
        if batch in now["batches"]:
            return now
        if changes.schema["validation_errors"].dataType.typeName() == "array":
            changes = changes.withColumn("validation_errors", json_text())
        rows = changes.withColumn("created_at", F.col("updated_at")).withColumn("first_seq", F.col("change_seq"))
        kinds = [f.split() for f in SCHEMA.split(", ")]
        rows = merged(rows.select(*[F.col(c).cast(k).alias(c) for c, k in kinds]))
        folder = f"changes/version={now['version'] + 1}"
        live = {b: list(f) for b, f in now["live"].items()}
        for b in self._write(rows, folder, now["buckets"]):
            live.setdefault(str(b), []).append(f"{folder}/bucket={b}")
        counts = f"counts/version={now['version'] + 1}"
        self._counted(now, live, folder).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/{counts}")
        return self._commit(now, live=live, batches=[*now["batches"], batch], counts=counts)

    def _counted(self, now: dict, live: dict, folder: str) -> DataFrame:
        """The counts with the batch in ``folder``, from the buckets that it touched."""
        touched = [b for b in live if live[b][-1].startswith(f"{folder}/")]
        before = self._read([f for b in touched for f in now["live"].get(b, [])])
        before = before.groupBy("request_id").agg(F.max_by("status", "change_seq").alias("status"), F.max("change_seq").alias("change_seq"))
        batch = self._read([live[b][-1] for b in touched]).select("request_id", "status", "change_seq")
        return merged_counts(self.counts(), status_moves(before, batch))

    def counts(self) -> DataFrame:
        """``(status, n)`` of the newest version, as the batches left it."""
        kept = self.manifest()["counts"]
        if kept is None:
            return self.spark.createDataFrame([], "status string, n long")
        return self.spark.read.schema("status string, n long").parquet(f"{self.root}/{kept}")

    def summary(self, validated: str = P.VALIDATED, failed: str = P.VALIDATION_FAILED) -> DataFrame:
        """O2: the three headline counts, read from the kept counts alone."""
        n = lambda status: F.coalesce(F.sum(F.when(F.col("status") == status, F.col("n"))), F.lit(0)).cast("long")
        return self.counts().agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("opportunities"),
                                 n(validated).alias("validated"), n(failed).alias("validation_failures"))

    def compact(self) -> dict:
        """Rewrites the buckets of more than one folder; the others stay as they are."""
        now = self.manifest()
        touched = [b for b, folders in now["live"].items() if len(folders) > 1]
        if not touched:
            return now
        folder = f"base/version={now['version'] + 1}"
        self._write(merged(self._read([f for b in touched for f in now["live"][b]])), folder, now["buckets"])
        return self._commit(now, live={**now["live"], **{b: [f"{folder}/bucket={b}"] for b in touched}})

    def read(self, request_ids: list[str] | None = None) -> DataFrame:
        """The current rows; for a few ids, only their buckets are read."""
        now = self.manifest()
        if request_ids is None:
            return merged(self._read([f for folders in now["live"].values() for f in folders])).drop("first_seq")
        ids = self.spark.createDataFrame([(i,) for i in request_ids], "request_id string")
        own = {str(r[0]) for r in ids.select(F.pmod(F.xxhash64("request_id"), F.lit(now["buckets"]))).collect()}
        rows = self._read([f for b in sorted(own) for f in now["live"].get(b, [])])
        return merged(rows.join(F.broadcast(ids), "request_id", "left_semi")).drop("first_seq")
