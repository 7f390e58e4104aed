"""Resume state as deltas: each batch writes only the rows it changes, in hash buckets of the query.

Layout under one folder (any file system Hadoop knows):

* ``completed/batch=R/bucket=K``: queries finished by batch R, with their items;
* ``ledger/batch=R/bucket=K``: (query, run) of failed runs that batch R found;
* ``attempts/batch=R/bucket=K``: the landed attempts of batch R;
* ``_commits/R``: written last; a batch without it does not exist for readers;
* ``base=R/...``: the same tables merged up to batch R by ``compact``, with ``_commits/base-R``.

Completed queries stay completed and ledger entries are facts, so the state is the union of the newest base and
the committed deltas after it: nothing is rewritten per batch, and a batch that is run again after a crash overwrites
its own folders and then commits, giving the same state. Readers filter by bucket, so a batch reads the history of the
buckets it touches and Spark prunes the other folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..schema import COMPLETED, LANDED
from .state_store import _child, _files

LEDGER = T.StructType([T.StructField("query", T.StringType()), T.StructField("run", T.IntegerType())])
TABLES = {"completed": COMPLETED, "ledger": LEDGER, "attempts": LANDED}


def bucket_of(query, buckets: int):
    return F.pmod(F.xxhash64(query), F.lit(buckets)).cast("int")


class DeltaState:
    def __init__(self, spark: SparkSession, path: str, buckets: int = 64) -> None:
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    # markers ---------------------------------------------------------------------------------

    def _marks(self) -> list[str]:
        fs, root = _files(self.spark, f"{self.path}/_commits")
        return [e.getPath().getName() for e in fs.listStatus(root)] if fs.exists(root) else []

    def committed(self) -> list[int]:
        return sorted(int(m) for m in self._marks() if m.lstrip("-").isdigit())

    def base(self) -> int | None:
        bases = [int(m[5:]) for m in self._marks() if m.startswith("base-")]
        return max(bases) if bases else None

    def _mark(self, name: str) -> None:
        fs, _ = _files(self.spark, self.path)
        out = fs.create(_child(self.spark, f"{self.path}/_commits", name), True)
        out.close()

    # reading ---------------------------------------------------------------------------------

    def _read(self, folder: str, schema: T.StructType) -> DataFrame | None:
        fs, root = _files(self.spark, folder)
        if not fs.exists(root):
            return None
        full = T.StructType([*schema.fields, T.StructField("batch", T.IntegerType()),
                             T.StructField("bucket", T.IntegerType())])
        return self.spark.read.schema(full).option("basePath", folder).parquet(folder)

    def table(self, name: str, buckets: list[int] | None = None, also: int | None = None) -> DataFrame:
        """The rows of ``name`` in the state (base and committed deltas after it), of ``buckets`` if given;
        ``also`` adds an uncommitted batch, the one being written."""
        schema = TABLES[name]
        base, done = self.base(), self.committed()
        parts = []
        if base is not None:
            parts.append(self._read(f"{self.path}/base={base}/{name}", schema))
        deltas = self._read(f"{self.path}/{name}", schema)
        wanted = [b for b in done if base is None or b > base] + ([also] if also is not None else [])
        if deltas is not None and wanted:
            parts.append(deltas.where(F.col("batch").isin(wanted)))
        rows = [p for p in parts if p is not None]
        if not rows:
            return self.spark.createDataFrame([], schema)
        out = rows[0]
        for more in rows[1:]:
            out = out.unionByName(more)
        if buckets is not None:
            out = out.where(F.col("bucket").isin(buckets))
        return out.select(*schema.names)

    def failures(self, ledger: DataFrame) -> DataFrame:
        return ledger.groupBy("query").agg(F.count_distinct("run").cast("int").alias("n"))

    # writing ---------------------------------------------------------------------------------

    def write(self, batch: int, **tables: DataFrame) -> None:
        """Write the deltas of ``batch`` (tables by name), each overwriting its own folder, then commit."""
        for name, rows in tables.items():
            (rows.select(*TABLES[name].names).withColumn("bucket", bucket_of(F.col("query"), self.buckets))
             .repartition("bucket").write.mode("overwrite").partitionBy("bucket")
             .parquet(f"{self.path}/{name}/batch={batch}"))
        self._mark(str(batch))

    def seed(self, completed: DataFrame, failures: DataFrame) -> None:
        """Start from a saved state of counts, as batch -1 (streamed batches count from 0): n earlier failures
        become n distinct earlier runs (-1 .. -n)."""
        ledger = failures.where("n > 0").select(
            "query", F.explode(F.sequence(F.lit(-1), -F.col("n").cast("int"), F.lit(-1))).alias("run"))
        self.write(-1, completed=completed, ledger=ledger)

    def compact(self) -> int | None:
        """Merge the base and all committed deltas into a new base; readers switch at its marker."""
        done = self.committed()
        if not done:
            return None
        upto = done[-1]
        for name in ("completed", "ledger", "attempts"):
            rows = self.table(name)
            if name == "ledger":
                rows = rows.distinct()
            (rows.withColumn("bucket", bucket_of(F.col("query"), self.buckets)).withColumn("batch", F.lit(upto))
             .repartition("bucket").write.mode("overwrite").partitionBy("batch", "bucket")
             .parquet(f"{self.path}/base={upto}/{name}"))
        self._mark(f"base-{upto}")
        return upto
