"""Totals by key and period kept in state: corrections replace what they correct, and a timer closes a period."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

if TYPE_CHECKING:
    import pandas as pd

#: The store that keeps state on disk; this kind of operator needs it.
_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_STORE_CONF = "spark.sql.streaming.stateStore.providerClass"


class _Totals(StatefulProcessor):
    """State of one key: the entries of an open period, or only the totals of a closed one."""

    def __init__(self, keys: Sequence[str], day_ms: int) -> None:
        self.keys, self.day_ms = list(keys), day_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.entries = handle.getValueState("entries", "ids array<long>, versions array<long>, amounts array<long>")
        self.totals = handle.getValueState("totals", "n long, total long, closed boolean")

    def _result(self, key: tuple, n: int, total: int, closed: bool) -> pd.DataFrame:
        import pandas as pd

        return pd.DataFrame([[*key, n, total, closed]], columns=[*self.keys, "n", "total", "closed"])

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        if self.totals.exists() and self.totals.get()[2]:
            for _ in rows:  # corrections of a closed period come too late
                pass
            return
        known: dict[int, tuple[int, int]] = {}
        if self.entries.exists():
            known = {i: (v, a) for i, v, a in zip(*self.entries.get(), strict=True)}
        else:
            import pandas as pd

            self.handle.registerTimer(int(pd.Timestamp(key[-1]).value // 10**6) + self.day_ms)
        for part in rows:
            for i, version, amount in zip(part["id"].tolist(), part["version"].tolist(), part["amount"].tolist(), strict=True):
                if i not in known or version > known[i][0]:
                    known[i] = (version, amount)
        total = sum(a for _, a in known.values())
        self.entries.update(([*known], [v for v, _ in known.values()], [a for _, a in known.values()]))
        self.totals.update((len(known), total, False))
        yield self._result(key, len(known), total, False)

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        n, total, _ = self.totals.get()
        self.entries.clear()
        self.totals.update((n, total, True))
        yield self._result(key, n, total, True)

    def close(self) -> None:
        pass


def keyed_totals(spark: SparkSession, path: str, schema: str, keys: Sequence[str], folder: str, late: str = "30 days", files: int = 4) -> DataFrame:
    """(keys, day, n, total, closed) over all files that have arrived at ``path``; a later call with the same ``folder`` goes on from its state.

    ``schema`` has ``keys``, id and version (long), amount (long) and time (timestamp). A row is an entry
    of its key and day; of rows with the same id the highest version counts, of equal versions the first
    that came, so corrections and repeated deliveries do not add up. Rows more than ``late`` behind the
    latest time seen are dropped, and once that is past a day's end its timer frees the entries and keeps
    the totals. The open entries of one key and day are held by one task.

    Results are appended by batch, a repeated batch replacing itself; the last of each key counts.
    """
    before = spark.conf.get(_STORE_CONF)
    spark.conf.set(_STORE_CONF, _STORE)
    try:
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", str(files)).parquet(path)
        stream = stream.withWatermark("time", late).select(*keys, F.date_trunc("day", "time").alias("day"), "id", "version", "amount", "time")
        by, kinds = [*keys, "day"], dict(stream.dtypes)
        result = ", ".join(f"`{k}` {kinds[k]}" for k in by) + ", n long, total long, closed boolean"
        found = stream.groupBy(*by).transformWithStateInPandas(_Totals(by, 86_400_000), result, "Update", "EventTime")

        def add(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{folder}/changes/batch={number}")

        query = found.writeStream.outputMode("update").foreachBatch(add).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        spark.conf.set(_STORE_CONF, before)
    changes = spark.read.schema(result + ", batch long").parquet(f"{folder}/changes")
    last = changes.groupBy(*by).agg(F.max_by(F.struct("n", "total", "closed"), F.struct("batch", "closed")).alias("_last"))
    return last.select(*by, "_last.*")
