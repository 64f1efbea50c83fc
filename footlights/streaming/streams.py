"""Structured Streaming forms of the incremental operators.

Sources are file streams with a given schema; every stream works on event time with watermarks, so late rows and state
have bounds. Results are streaming DataFrames or ``foreachBatch`` writers; the caller starts them with its checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from ..operators.groups import group_evenings
from ..operators.saved_groups import refresh_saved


#: State with timers and maps needs this store (fixed value of the engine's setting).
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def stateful_session(spark: SparkSession) -> SparkSession:
    """A session beside the caller's whose streams keep their state in RocksDB; the caller's settings stay as they are."""
    own = spark.newSession()
    own.conf.set(*STATE_STORE)
    for name in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        own.conf.set(name, spark.conf.get(name))
    return own


def read_stream(spark: SparkSession, path: str, schema: StructType | str, files_per_trigger: int = 1) -> DataFrame:
    """A rate-limited stream of Parquet files."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def stream_stage(rows: DataFrame, ts: str = "scraped_at", key: str = "dedupe_key", late: str = "2 days") -> DataFrame:
    """Idempotent staging: the first row of each key within the watermark."""
    return rows.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def stream_refresh_groups(changes: DataFrame, load_rows: Callable[[DataFrame], DataFrame], save: Callable[[DataFrame, int], None]):
    """A ``foreachBatch`` writer that makes anew only the evenings named in a micro-batch.

    changes: old_key, new_key. ``load_rows`` gives the current rows of the evenings ``(ek)``; ``save`` upserts groups.
    """

    def batch(df: DataFrame, number: int) -> None:
        keys = df.select(F.explode(F.array_compact(F.array("old_key", "new_key"))).alias("ek")).distinct()
        save(group_evenings(load_rows(keys)), number)

    return changes.writeStream.foreachBatch(batch)


def stream_saved_groups(changes: DataFrame, path: str, load_rows: Callable[[], DataFrame], buckets: int = 64, dealt: bool = False):
    """A ``foreachBatch`` writer that keeps the groups saved at ``path`` up to date.

    changes: old_key, new_key. ``load_rows`` gives the rows as they are when a micro-batch runs; a micro-batch that is
    replayed after a failure gives the same table. ``buckets``, ``dealt``: as in ``refresh_saved``.
    """

    def batch(df: DataFrame, number: int) -> None:
        keys = df.select(F.explode(F.array_compact(F.array("old_key", "new_key"))).alias("ek"))
        refresh_saved(path, load_rows(), keys, buckets, dealt)

    return changes.writeStream.foreachBatch(batch)


class InOrder(StatefulProcessor):
    """Rows of a key by event time: they wait in slots of ``slot`` seconds until the watermark has passed a slot's end.

    A slot is one entry of a map state and one timer; timers fire in order of time, so a task holds one slot of one key and
    never a key's rows. ``play`` gets a slot's rows as tuples in order. ``keep`` seconds of event time after a key's last slot
    its state is removed. Rows later than the watermark are dropped by the engine.
    """

    columns: str
    memory: dict[str, str]

    def __init__(self, slot: int, keep: int):
        self.slot, self.keep = slot * 1000, keep * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.slots = handle.getMapState("slots", "ends long", f"rows array<struct<{self.columns}>>")
        self.last = handle.getValueState("last", "ends long")
        self.held = {name: handle.getValueState(name, schema) for name, schema in self.memory.items()}

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in self.columns.split(", ")]
        for page in rows:
            micros = page["at"].astype("datetime64[us]").astype("int64")
            ends = (micros // 1000 // self.slot + 1) * self.slot
            for end, part in page.assign(at=micros)[names].groupby(ends):
                end = int(end)
                there = [tuple(r) for r in self.slots.getValue((end,))[0]] if self.slots.containsKey((end,)) else []
                self.slots.updateValue((end,), (there + [tuple(r) for r in part.astype(object).itertuples(index=False)],))
                if not there:
                    self.handle.registerTimer(end)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end = expiredTimerInfo.getExpiryTimeInMs()
        last = self.last.get()[0] if self.last.exists() else None
        if self.slots.containsKey((end,)):
            rows = sorted((tuple(r) for r in self.slots.getValue((end,))[0]), key=lambda r: [(v is not None, v) for v in r])
            self.slots.removeKey((end,))
            if last is not None:
                self.handle.deleteTimer(last + self.keep)
            self.last.update((end,))
            self.handle.registerTimer(end + self.keep)
            yield self.play(key, rows)
        elif last is not None and last + self.keep <= end:
            for state in (self.last, *self.held.values()):
                state.clear()
            self.forget()

    def play(self, key: tuple, rows: list[tuple]) -> pd.DataFrame:
        raise NotImplementedError

    def forget(self) -> None:
        """Remove what is kept beside ``memory``."""

    def close(self) -> None:
        pass


def _played(rows: DataFrame, keys: list[str], processor: InOrder, schema: str, late: str) -> DataFrame:
    """Run a processor over the rows that have an event time ``at``; the session's state store must be RocksDB."""
    return rows.where("at is not null").withWatermark("at", late).groupBy(*keys).transformWithStateInPandas(processor, schema, "append", "EventTime")


class _Ledger(InOrder):
    columns, memory = "at long, run_id string, amount long", {"total": "sum long"}

    def __init__(self, month_cap: int, run_cap: int, slot: int, keep: int):
        super().__init__(slot, keep)
        self.month_cap, self.run_cap = month_cap, run_cap

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.runs = handle.getMapState("runs", "run_id string", "sum long")

    def play(self, key: tuple, rows: list[tuple]) -> pd.DataFrame:
        total = self.held["total"].get()[0] if self.held["total"].exists() else 0
        sums, out = {}, []
        for at, run, amount in rows:
            if run not in sums:
                sums[run] = self.runs.getValue((run,))[0] if self.runs.containsKey((run,)) else 0
            ok = total + amount <= self.month_cap and sums[run] + amount <= self.run_cap
            if ok:
                total += amount
                sums[run] += amount
            out.append((key[0], pd.Timestamp(at, unit="us"), run, amount, ok, total))
        self.held["total"].update((total,))
        for run, n in sums.items():
            self.runs.updateValue((run,), (n,))
        return pd.DataFrame(out, columns=["month", "at", "run_id", "amount", "ok", "month_sum"])

    def forget(self) -> None:
        self.runs.clear()


def stream_ledger(requests: DataFrame, month_cap: int, run_cap: int, late: str = "1 hour", slot: int = 3600) -> DataFrame:
    """Reservations in order of time: admitted while the month's and the run's sums stay within their caps.

    requests: month, at, run_id, amount (whole cents; null: no request). A request is decided when the watermark has passed its slot, ties by
    run and amount; state is the month's sum and an entry for each run, removed 40 days after the month's last request.
    """
    asked = requests.where("amount is not null").select("month", "at", "run_id", "amount")
    return _played(asked, ["month"], _Ledger(month_cap, run_cap, slot, 40 * 86_400), "month string, at timestamp, run_id string, amount long, ok boolean, month_sum long", late)


class _Changes(InOrder):
    columns, memory = "at long, text_hash string", {"reading": "hash string, at long"}

    def __init__(self, days: int, slot: int):
        super().__init__(slot, 2 * days * 86_400)
        self.days = days

    def play(self, key: tuple, rows: list[tuple]) -> pd.DataFrame:
        last = self.held["reading"].get() if self.held["reading"].exists() else None
        out = []
        for at, text_hash in rows:
            told = "new" if last is None else "changed" if last[0] != text_hash else "expired" if at - last[1] > self.days * 86_400_000_000 else "unchanged"
            if told != "unchanged":
                last = (text_hash, at)
            out.append((*key, pd.Timestamp(at, unit="us"), told))
        self.held["reading"].update(tuple(last))
        return pd.DataFrame(out, columns=["url", "role", "at", "state"])


def stream_changes(pages: DataFrame, days: int = 28, late: str = "1 hour", slot: int = 86_400) -> DataFrame:
    """Each page opened against its last reading, in order of time: ``(url, role, at, state)``.

    pages: url, role, text_hash, at; states are new, changed, unchanged or expired. Kept for each page: the last reading's
    hash and time, gone after twice ``days`` unseen.
    """
    return _played(pages.select("url", "role", "text_hash", "at"), ["url", "role"], _Changes(days, slot), "url string, role string, at timestamp, state string", late)


def stream_pending(requests: DataFrame, answers: DataFrame, days: int = 30) -> DataFrame:
    """Requests with the answers that come within ``days``; without one a request comes out unanswered after that.

    requests: batch_id, custom_id, sent_at, estimate; answers: batch, custom, answered_at, result."""
    r, a = requests.withWatermark("sent_at", "1 hour"), answers.withWatermark("answered_at", "1 hour")
    on = (F.col("batch_id") == F.col("batch")) & (F.col("custom_id") == F.col("custom")) & (F.col("answered_at") >= F.col("sent_at")) & (F.col("answered_at") <= F.col("sent_at") + F.expr(f"interval {days} days"))
    return r.join(a, on, "left_outer").select("batch_id", "custom_id", "sent_at", "estimate", "answered_at", "result")


def stream_stalls(progress: DataFrame, minutes: int = 30, late: str = "10 minutes") -> DataFrame:
    """Spells of progress of each job (job, at): a gap of ``minutes`` ends one; ``(job, started, ended, n)``."""
    spells = progress.withWatermark("at", late).groupBy(F.session_window("at", f"{minutes} minutes").alias("w"), "job").agg(F.count("*").alias("n"))
    return spells.select("job", F.col("w.start").alias("started"), F.col("w.end").alias("ended"), "n")


class _Answered(InOrder):
    columns, memory = "at long, asked int", {"open": "n long"}

    def play(self, key: tuple, rows: list[tuple]) -> pd.DataFrame:
        n = self.held["open"].get()[0] if self.held["open"].exists() else 0
        done = []
        for at, asked in rows:
            n -= asked
            if n == 0:
                done.append(pd.Timestamp(at, unit="us"))
        self.held["open"].update((n,))
        return pd.DataFrame({"source_id": pd.Series([key[0]] * len(done), dtype="object"), "at": pd.Series(done, dtype="datetime64[us]")})


def stream_save_when_answered(changes: DataFrame, late: str = "1 hour", slot: int = 86_400) -> DataFrame:
    """Sources whose pending count comes to 0, each time it does: ``(source_id, at)``, in order of time, asked before answered.

    changes: source_id string, at, delta (+1 asked, -1 answered). A source without change for 30 days is forgotten."""
    signed = changes.select("source_id", "at", (-F.col("delta")).cast("int").alias("asked"))
    return _played(signed, ["source_id"], _Answered(slot, 30 * 86_400), "source_id string, at timestamp", late)


def stalls(progress: DataFrame, minutes: int = 30) -> DataFrame:
    """Batch form: gaps longer than ``minutes`` between two signs of progress of a job: ``(job, since, until)``."""
    from pyspark.sql import Window

    before = F.lag("at").over(Window.partitionBy("job").orderBy("at"))
    rows = progress.select("job", "at").distinct().withColumn("since", before)
    return rows.where(F.unix_seconds("at") - F.unix_seconds("since") > minutes * 60).select("job", "since", F.col("at").alias("until"))
