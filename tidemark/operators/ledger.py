"""Work that goes on where it stopped: a ledger of what was done on which input, with what outcome.

The ledger is a folder of small tables, one for each batch. A batch first writes its results and then its
ledger table, whose presence commits it: a batch that was killed in between has no entry, and its number
and its results are used again by the next. Nothing is kept on the driver but the numbers of batches.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

if TYPE_CHECKING:
    import pandas as pd

_ENTRY = "fingerprint long, outcome string, attempt int, batch int, error string"


def fingerprint(columns: Sequence[str]) -> Column:
    """An aggregate over rows that changes with any value, with their number, and not with their order."""
    row = F.xxhash64(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0null")) for c in columns])
    return F.xxhash64(F.sum(row.cast("decimal(38,0)")), F.bit_xor(row), F.count("*"))


class Ledger:
    """The ledger of one job in ``folder``, on the cluster's shared storage; ``unit`` are the columns that name a piece of work."""

    def __init__(self, spark: SparkSession, folder: str, unit: Sequence[tuple[str, str]]) -> None:
        self.spark, self.folder, self.unit = spark, folder.rstrip("/"), [name for name, _ in unit]
        self.schema = ", ".join(f"`{name}` {kind}" for name, kind in unit) + ", " + _ENTRY

    def _batches(self) -> list[int]:
        root = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/ledger")
        system = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not system.exists(root):
            return []
        marked = [p.getPath() for p in system.listStatus(root)]
        done = [p for p in marked if system.exists(self.spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
        return sorted(int(p.getName().partition("=")[2]) for p in done)

    def entries(self) -> DataFrame:
        """Every attempt that was committed."""
        paths = [f"{self.folder}/ledger/n={n}" for n in self._batches()]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def latest(self) -> DataFrame:
        """The last attempt at each unit and fingerprint."""
        by = [*self.unit, "fingerprint"]
        return self.entries().groupBy(*by).agg(F.max_by(F.struct("outcome", "attempt", "batch", "error"), "batch").alias("_e")).select(*by, "_e.*")

    def present(self, work: DataFrame) -> DataFrame:
        """(unit, fingerprint) of the rows of ``work``."""
        return work.groupBy(*self.unit).agg(fingerprint(work.columns).alias("fingerprint"))

    def written(self, df: DataFrame, name: str) -> DataFrame:
        """``df``, with a row for a unit, written to the ledger's folder and read again: the work is not read anew for it, and its size is known."""
        path = f"{self.folder}/units/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def todo(self, work: DataFrame, most: int) -> DataFrame:
        """(unit, fingerprint, attempt): what is new or changed, and what failed fewer than ``most`` times on this input."""
        return self.left(self.present(work), most)

    def left(self, wanted: DataFrame, most: int) -> DataFrame:
        """``todo`` from what ``present`` gives."""
        known = self.latest().select(*self.unit, "fingerprint", "outcome", F.col("attempt").alias("_before"))
        on = [wanted[c].eqNullSafe(known[c]) for c in (*self.unit, "fingerprint")]
        left = wanted.join(known, on, "left").where((F.col("outcome").isNull()) | ((F.col("outcome") == "failed") & (F.col("_before") < most)))
        return left.select(*[wanted[c] for c in (*self.unit, "fingerprint")], (F.coalesce("_before", F.lit(0)) + 1).alias("attempt"))

    def commit(self, batch: int, entries: DataFrame) -> None:
        entries.write.mode("overwrite").parquet(f"{self.folder}/ledger/n={batch}")

    def next_batch(self) -> int:
        return max(self._batches(), default=0) + 1


def process(
    work: DataFrame, unit: Sequence[str], function: Callable[[pd.DataFrame], pd.DataFrame], schema: str, folder: str, most: int = 3, rounds: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """(results, failed): ``function`` applied to the rows of each unit, as a job that can be killed and called again.

    ``results`` has the function's columns, ``schema``, for every unit of ``work`` that succeeded on its
    present rows. ``failed`` has the units that raised, with the attempts made and the last error. A call
    does what is not done yet and retries failures, each unit at most ``most`` times on the same input;
    ``rounds`` limits the batches of this call. The fingerprints are taken once a call, at its start; what is
    to do is written for each batch, so that the rows of other units are left out before they are shuffled
    where that is small enough to be sent to the tasks. Units are processed in parallel and each is held by one
    task: choose units that fit. A unit without rows does not exist; units with a null are units.
    """
    names = work.sparkSession.createDataFrame([], schema).columns
    ledger = Ledger(work.sparkSession, folder, [(c, work.schema[c].dataType.simpleString()) for c in unit])
    kinds = f"{schema}, _error string, " + ", ".join(f"`_u_{c}` {work.schema[c].dataType.simpleString()}" for c in unit) + ", _fingerprint long, _attempt int"

    def guarded(rows: pd.DataFrame) -> pd.DataFrame:
        import pandas as pd

        own = {f"_u_{c}": rows[f"_u_{c}"].iloc[0] for c in unit} | {"_fingerprint": rows["_fingerprint"].iloc[0], "_attempt": rows["_attempt"].iloc[0]}
        mark = pd.DataFrame([[None] * len(names)], columns=names).assign(_error="", **own)  # an entry even if there are no results
        try:
            found = function(rows.drop(columns=[*own]))
        except Exception as error:  # noqa: BLE001  any failure of the work is an outcome
            return mark.assign(_error=f"{type(error).__name__}: {error}")
        return pd.concat([mark, found.assign(_error=None, **own)], ignore_index=True) if len(found) else mark

    done, present = 0, ledger.written(ledger.present(work), "present")
    while rounds is None or done < rounds:
        todo = ledger.written(ledger.left(present, most), "todo")
        if todo.isEmpty():
            break
        batch, done = ledger.next_batch(), done + 1
        named = todo.select(*[F.col(c).alias(f"_u_{c}") for c in unit], F.col("fingerprint").alias("_fingerprint"), F.col("attempt").alias("_attempt"))
        rows = work.join(named, [work[c].eqNullSafe(named[f"_u_{c}"]) for c in unit])
        rows.groupBy(*[f"_u_{c}" for c in unit]).applyInPandas(guarded, kinds).write.mode("overwrite").parquet(f"{ledger.folder}/out/n={batch}")
        out = work.sparkSession.read.schema(kinds).parquet(f"{ledger.folder}/out/n={batch}").where("_error IS NOT NULL")
        ledger.commit(
            batch,
            out.select(
                *[F.col(f"_u_{c}").alias(c) for c in unit], F.col("_fingerprint").alias("fingerprint"), F.when(F.col("_error") == "", "done").otherwise("failed").alias("outcome"),
                F.col("_attempt").alias("attempt"), F.lit(batch).alias("batch"), F.nullif("_error", F.lit("")).alias("error"),
            ),
        )
    latest = ledger.latest()
    now = latest.join(present, [latest[c].eqNullSafe(present[c]) for c in (*unit, "fingerprint")], "left_semi")
    spark, numbers = work.sparkSession, ledger._batches()
    if not numbers:
        return spark.createDataFrame([], schema), now.select(*unit, "attempt", "error")
    out = spark.read.schema(kinds + ", n int").option("basePath", f"{ledger.folder}/out").parquet(*[f"{ledger.folder}/out/n={n}" for n in numbers]).where("_error IS NULL")
    good = now.where("outcome = 'done'").select(*[F.col(c).alias(f"_d_{c}") for c in unit], F.col("batch").alias("_batch"))
    results = out.join(good, [out[f"_u_{c}"].eqNullSafe(good[f"_d_{c}"]) for c in unit] + [out["n"] == good["_batch"]]).select(*[f"`{c}`" for c in names])
    return results, now.where("outcome = 'failed'").select(*unit, "attempt", "error")


def run_stages(source: DataFrame, stages: Sequence[tuple[str, Callable[[DataFrame], DataFrame]]], folder: str) -> Iterator[tuple[str, bool, DataFrame]]:
    """(name, done before, result) of each stage in turn; each works on the result of the one before, read from where it was written.

    A stage is skipped if the ledger has it with the same chain of names and the same source, so a job
    that was killed goes on with the first stage that is not committed, and a changed source runs anew.
    """
    spark = source.sparkSession
    ledger = Ledger(spark, folder, [("stage", "string")])
    chain, docs = source.agg(fingerprint(source.columns)).first()[0], source
    for name, function in stages:
        chain = spark.range(1).select(F.xxhash64(F.lit(chain), F.lit(name))).first()[0]
        known = ledger.entries().where((F.col("stage") == name) & (F.col("fingerprint") == chain)).select("batch").first()
        batch = known["batch"] if known else ledger.next_batch()
        path = f"{ledger.folder}/out/n={batch}"
        if not known:
            function(docs).write.mode("overwrite").parquet(path)
            ledger.commit(batch, spark.range(1).select(F.lit(name).alias("stage"), F.lit(chain).alias("fingerprint"), F.lit("done").alias("outcome"), F.lit(1).alias("attempt"), F.lit(batch).alias("batch"), F.lit(None).cast("string").alias("error")))
        docs = spark.read.parquet(path)
        yield name, bool(known), docs
