"""Costs of readings: prices, estimates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Output tokens assumed for an answer, and for one that thinks first; prompts beyond the limit cost a multiple (fixed values).
ANSWER_TOKENS, THINKING_TOKENS, LONG_PROMPT = 1500, 4500, 100_000


def with_prices(requests: DataFrame, prices: DataFrame, model: str = "model") -> DataFrame:
    """Join prices ``(model, p_in, p_out, p_write, p_read, long_factor)`` per million tokens; unknown models cost like the dearest.

    The price table is a list of models, a few rows by nature.
    """
    dearest = prices.select(F.max(F.struct("p_in", "p_out", "p_write", "p_read")).alias("d"))
    known = F.broadcast(prices.withColumnRenamed("model", "_model"))
    out = requests.join(known, F.col(model) == F.col("_model"), "left").crossJoin(F.broadcast(dearest))
    columns = [F.coalesce(F.col(c), F.col(f"d.{c}")).alias(c) for c in ("p_in", "p_out", "p_write", "p_read")]
    return out.select(*requests.columns, *columns, F.coalesce("long_factor", F.lit(1)).alias("long_factor"))


def cost_usd(n_in: Column, n_out: Column, n_write: Column, n_read: Column, batch: Column) -> Column:
    """Cost from token counts and the price columns of ``with_prices``; batches cost half."""
    zero = lambda c: F.coalesce(c, F.lit(0))
    prompt = zero(n_in) + zero(n_write) + zero(n_read)
    usd = (zero(n_in) * F.col("p_in") + zero(n_out) * F.col("p_out") + zero(n_write) * F.col("p_write") + zero(n_read) * F.col("p_read")) / 1_000_000
    return usd * F.when(prompt > LONG_PROMPT, F.col("long_factor")).otherwise(1) * F.when(batch, 0.5).otherwise(1.0)


def estimate_request(fixed_tokens: Column, user_tokens: Column, thinks: Column, batch: Column) -> Column:
    """Cost of a request before it is sent: the fixed part read from the cache, the page at full price, a usual answer."""
    return cost_usd(user_tokens, F.when(thinks, THINKING_TOKENS).otherwise(ANSWER_TOKENS), F.lit(0), fixed_tokens, batch)


def trim_step(sizes: Column, most: int = 85_000) -> Column:
    """The first of several estimates that fits, by its place from 1; the last if none does."""
    first = F.array_position(F.transform(sizes, lambda n: n <= most), True)
    return F.when(first > 0, first).otherwise(F.size(sizes)).cast("int")
