"""Generator usage: tokens, cost and audits of rate limits over a call log."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Tokens a word, prices of a million tokens, and limits of a minute.
TOKENS_A_WORD = 1.3
PRICE_IN, PRICE_OUT = 0.075, 0.30
REQUESTS, TOKENS = 15, 1_000_000
MINUTE = 60_000_000


def _tokens(*words: str):
    total = F.col(words[0]) * F.lit(TOKENS_A_WORD)
    for w in words[1:]:
        total = total + F.col(w) * F.lit(TOKENS_A_WORD)
    return F.floor(total).cast("long")


def usage_stats(calls: DataFrame) -> DataFrame:
    """Requests, estimated tokens, cost and success rate of calls (failed, prompt_words, response_words); failed ones have no tokens."""
    good = ~F.col("failed")
    spent = lambda c: F.coalesce(F.sum(F.when(good, _tokens(c))), F.lit(0))
    sums = calls.agg(F.count(F.lit(1)).alias("total_requests"), F.count_if(good).alias("successful_requests"), F.count_if(F.col("failed")).alias("failed_requests"), spent("prompt_words").alias("input_tokens"), spent("response_words").alias("output_tokens"))
    cost = F.col("input_tokens") / 1_000_000 * F.lit(PRICE_IN) + F.col("output_tokens") / 1_000_000 * F.lit(PRICE_OUT)
    rate = F.when(F.col("total_requests") > 0, F.bround(F.col("successful_requests") / F.col("total_requests") * 100, 1)).otherwise(0.0)
    return sums.withColumn("estimated_cost_usd", F.bround(cost, 4)).withColumn("success_rate", rate)


def request_limit(calls: DataFrame, limit: int = REQUESTS) -> DataFrame:
    """calls (event_id, api_key, us) with the calls of their key in the 60 s before, and whether they had to wait.

    A call is counted in its own minute and shown to the next, so a window holds
    two minutes of a key's calls, however many calls the key has. There a running sum
    counts a call at its time and takes it off again a minute later: calls of the
    minute before come in as all of them, less those that have left by then. So a
    window is passed once, however many calls a minute has.
    """
    minute = F.floor(F.col("us") / MINUTE)
    here = F.struct(minute.alias("_in"), F.col("us").alias("_at"), F.lit(1).alias("_one"))
    gone = F.struct((minute + 1).alias("_in"), (F.col("us") + MINUTE).alias("_at"), F.lit(-1).alias("_one"))
    # calls without a time are counted among themselves
    shown = calls.select("*", F.inline(F.when(F.col("us").isNull(), F.array(here)).otherwise(F.array(here, gone))))
    minutes = Window.partitionBy("api_key", "_in")
    so_far = F.sum("_one").over(minutes.orderBy("_at").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    counted = shown.withColumn("earlier", so_far + F.count_if(F.col("_one") < 0).over(minutes) - 1).filter("_one > 0")
    return counted.select(*calls.columns, "earlier", (F.col("earlier") >= limit).alias("limited"))


def tokens_per_minute(calls: DataFrame, limit: int = TOKENS) -> DataFrame:
    """Tokens of successful calls by minute, and whether they pass the limit."""
    minutes = calls.filter(~F.col("failed")).groupBy(F.floor(F.col("us") / MINUTE).alias("minute")).agg(F.count(F.lit(1)).alias("calls"), F.sum(_tokens("prompt_words", "response_words")).alias("tokens"))
    return minutes.withColumn("over_limit", F.col("tokens") > limit)
