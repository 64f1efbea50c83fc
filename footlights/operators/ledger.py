"""A shared spending ledger: reservations against monthly and per-run caps, blocks, sums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .fold import fold_sorted


def _shape(rows: DataFrame, *columns: str, **more: str) -> StructType:
    out = StructType([rows.schema[c] for c in columns])
    for name, kind in more.items():
        out.add(name, kind)
    return out


def spend_reserve(requests: DataFrame, month_cap: int, run_cap: int) -> DataFrame:
    """Decide reservations in order: ``(month, seq, run_id, amount, ok, why, month_sum, run_sum)``.

    requests: month, seq (total order within the month), run_id, amount (whole cents; null: 0). A request is admitted if
    neither the month's nor the run's sum would pass its cap; a refused one changes no sum, so this is a fold and no
    running sum. A task carries a month's sum and those of its runs, never the requests.
    """

    def step(state: dict, seq: int, run: str, amount: int | None) -> tuple:
        amount, spent = amount or 0, state["runs"].get(run, 0)
        why = "month" if state["month"] + amount > month_cap else "run" if spent + amount > run_cap else None
        if why is None:
            state["month"] += amount
            state["runs"][run] = spent = spent + amount
        return seq, run, amount, why is None, why, state["month"], spent

    shape = _shape(requests, "month", "seq", "run_id", amount="long", ok="boolean", why="string", month_sum="long", run_sum="long")
    return fold_sorted(requests, "month", ["seq"], ["run_id", "amount"], lambda: {"month": 0, "runs": {}}, step, shape)


def _pay(state: dict, amount: int, cap: int, block: int) -> tuple[bool, int]:
    """Pay from what is free; beyond it reserve a block or what is missing. A refused reservation stops the job."""
    need = max(block, amount - state["free"]) if amount > state["free"] else 0
    if state["stopped"] or state["total"] + need > cap:
        state["stopped"] = True
        return False, 0
    state["free"] += need - amount
    state["total"] += need
    return True, need


def budget_blocks(spends: DataFrame, cap: int, block: int) -> DataFrame:
    """Payments from blocks: ``(job, seq, amount, paid, reserved)``; after a refused block a job stays stopped.

    spends: job, seq, amount (whole cents). A payment beyond what is available reserves max(block, what is missing),
    if the job's reservations stay within ``cap``. A task carries three numbers a job."""

    def step(state: dict, seq: int, amount: int | None) -> tuple:
        amount = amount or 0
        return seq, amount, *_pay(state, amount, cap, block)

    shape = _shape(spends, "job", "seq", amount="long", paid="boolean", reserved="long")
    return fold_sorted(spends, "job", ["seq"], ["amount"], lambda: {"free": 0, "total": 0, "stopped": False}, step, shape)


def budget_ledger(events: DataFrame, cap: int, block: int, flush_seconds: int = 120) -> DataFrame:
    """A job's whole ledger: ``(job, seq, paid, reserved, adjusted)`` for every event, and one row more at its end.

    events: job, seq, at, estimate, actual (whole cents). An event without ``actual`` is a payment of its estimate, as in
    ``budget_blocks``; one with it is an answer, whose actual cost replaces the estimate that was paid for it. What the
    answers so far differ by is written as a correction (``adjusted``) when an answer comes more than ``flush_seconds``
    after the last flush (or the job's first event), and counts against ``cap`` from then on. The last row (null
    ``seq``) holds the last correction and, as a negative reservation, what was reserved and not used.
    """

    def start() -> dict:
        return {"free": 0, "total": 0, "stopped": False, "owed": 0, "flushed": 0, "at": None}

    def flush(state: dict) -> int:
        delta = state["owed"] - state["flushed"]
        state["flushed"] += delta
        state["total"] += delta
        return delta

    def step(state: dict, seq: int, at, estimate: int | None, actual: int | None) -> tuple:
        state["at"] = state["at"] or at
        if actual is None:
            return seq, *_pay(state, estimate or 0, cap, block), 0
        state["owed"] += actual - (estimate or 0)
        adjusted = 0
        if at and (at - state["at"]).total_seconds() > flush_seconds:
            state["at"], adjusted = at, flush(state)
        return seq, None, 0, adjusted

    shape = _shape(events, "job", "seq", paid="boolean", reserved="long", adjusted="long")
    return fold_sorted(events, "job", ["seq"], ["at", "estimate", "actual"], start, step, shape, lambda state: (None, None, -state["free"], flush(state)))


def spend_by_run(ledger: DataFrame) -> DataFrame:
    """Sums of a ledger (run_id, at, part, usd) by run: collect, review, total, first and last entry."""
    of = lambda part: F.round(F.sum(F.when(F.col("part") == part, F.col("usd"))), 2)
    return ledger.groupBy("run_id").agg(F.min("at").alias("first_at"), F.max("at").alias("last_at"), of("collect").alias("collect_usd"), of("review").alias("review_usd"), F.round(F.sum("usd"), 2).alias("total_usd"))
