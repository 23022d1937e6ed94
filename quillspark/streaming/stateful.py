"""Streams whose state is a program: first occurrences by order, exact trailing windows, and two outputs held side by side.

The first two are ``transformWithState`` processors. They need Spark's RocksDB state
store; ``program_state`` sets it while a query starts and puts the session's own back.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..functions.text import normalize_question
from ..operators.usage import MINUTE, REQUESTS, TOKENS, TOKENS_A_WORD

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHANGES = "batch_id int, q_norm string, chunk_id long, chunk_ord long, pair_idx int, change int"
LIMITED = "event_id long, api_key string, us long, earlier long, limited boolean"


@contextmanager
def program_state(spark: SparkSession) -> Iterator[None]:
    """Queries that start within keep their state in RocksDB."""
    own = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, own)


def _ms(ts: datetime) -> int:
    return round(ts.replace(tzinfo=timezone.utc).timestamp() * 1000) if ts.tzinfo is None else round(ts.timestamp() * 1000)


#: Parts that a batch's questions are dealt to; a part's first occurrences are read and stored together.
PARTS = 4096


class FirstByOrder(StatefulProcessor):
    """Of each (batch_id, q_norm) the least (chunk_ord, pair_idx) so far; when an earlier one comes late, the old one is taken back.

    The state is kept by parts of many questions: a call to the state store costs as much as
    many comparisons, and a question of its own would need several.
    """

    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.firsts = handle.getListState("firsts", "q_norm string, chunk_ord long, pair_idx int, chunk_id long, until long")
        self.timer = handle.getValueState("timer", "at long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802
        new: dict[str, tuple[tuple, int]] = {}
        for r in rows:
            place, until = (r.chunk_ord, r.pair_idx, r.chunk_id), r.ms + self.keep_ms
            had = new.get(r.q_norm)
            new[r.q_norm] = (place, until) if had is None else (min(had[0], place), max(had[1], until))
        passed, at = timerValues.getCurrentWatermarkInMs(), self.timer.get() if self.timer.exists() else None
        # questions whose time has passed are new ones; rows are handed in before timers
        known = {f[0]: (tuple(f[1:4]), f[4]) for f in self.firsts.get() if f[4] > passed} if at is not None else {}
        out = []
        for q_norm, (place, until) in new.items():
            old = known.get(q_norm)
            if old is None or place[:2] < old[0][:2]:
                out += [(q_norm, *old[0], -1)] if old is not None else []
                out.append((q_norm, *place, 1))
            else:
                place = old[0]
            known[q_norm] = (place, until if old is None else max(until, old[1]))
        self.firsts.put([(q_norm, *place, until) for q_norm, (place, until) in known.items()])
        last = max(until for _, until in known.values())
        if at is None or at[0] != last:
            if at is not None:
                self.handle.deleteTimer(at[0])
            self.handle.registerTimer(last)
            self.timer.update((last,))
        for q_norm, chunk_ord, pair_idx, chunk_id, change in out:
            yield Row(batch_id=key[0], q_norm=q_norm, chunk_id=chunk_id, chunk_ord=chunk_ord, pair_idx=pair_idx, change=change)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802
        self.firsts.clear()  # the timer is that of the part's last question
        self.timer.clear()
        yield from ()

    def close(self) -> None:
        pass


def first_by_order(stream: DataFrame, late: str = "10 minutes", keep_seconds: int = 3600) -> DataFrame:
    """Changes (CHANGES) to the set of first occurrences of each batch's normalised questions, by order and not by arrival.

    stream has batch_id, chunk_id, chunk_ord, pair_idx, question, ts. A row that comes
    before the known first of its question takes its place: the old one is given out
    again with change -1. A question's state goes once the watermark, ``late`` behind
    the latest ts, is ``keep_seconds`` beyond its own last row (it stays in the store until its part is
    touched again or the part's last question goes, too); within that time the
    changes of each place add up to 1 for first occurrences and to 0 for others.
    """
    keyed = stream.withColumn("q_norm", normalize_question(F.coalesce("question", F.lit("")))).select("batch_id", F.pmod(F.xxhash64("q_norm"), F.lit(PARTS)).alias("part"), "q_norm", "chunk_id", "chunk_ord", "pair_idx", "ts", F.unix_millis("ts").alias("ms"))
    return keyed.withWatermark("ts", late).groupBy("batch_id", "part").transformWithState(FirstByOrder(keep_seconds * 1000), CHANGES, "Append", "EventTime")


def settled(changes: DataFrame) -> DataFrame:
    """The first occurrences that all changes so far leave: (batch_id, q_norm, chunk_id, chunk_ord, pair_idx)."""
    place = ["batch_id", "q_norm", "chunk_id", "chunk_ord", "pair_idx"]
    return changes.groupBy(*place).agg(F.sum("change").alias("n")).filter("n > 0").select(*place)


class TrailingMinute(StatefulProcessor):
    """Calls of a key wait until the watermark has passed them, and stay until no later call can count them."""

    def __init__(self, limit: int):
        self.limit = limit

    def init(self, handle) -> None:
        self.handle = handle
        self.calls = handle.getListState("calls", "us long, event_id long")
        self.told = handle.getValueState("told", "us long, passed long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802
        rows = [(r.us, r.event_id, r.ms) for r in rows]
        self.calls.appendList([r[:2] for r in rows])
        for second in {r[2] // 1000 for r in rows}:
            self.handle.registerTimer((second + 1) * 1000)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        told, before = self.told.get() if self.told.exists() else (-(1 << 62), None)
        if before == passed:
            return  # another timer has told all of this watermark
        calls = sorted((c[0], c[1]) for c in self.calls.get())
        begin, n = 0, 0
        last = told
        for k, (us, event_id) in enumerate(calls):
            if us >= passed:
                break
            if us > told:
                while calls[begin][0] <= us - MINUTE:
                    begin += 1
                n = k
                while n + 1 < len(calls) and calls[n + 1][0] == us:
                    n += 1  # calls of the same moment count each other
                yield Row(event_id=event_id, api_key=key[0], us=us, earlier=n - begin, limited=n - begin >= self.limit)
                last = us
        self.told.update((last, passed))
        if last > told:
            kept = [c for c in calls if c[0] > last - MINUTE]
            self.calls.put(kept) if kept else self.calls.clear()

    def close(self) -> None:
        pass


def request_limit(calls: DataFrame, late: str = "10 seconds", limit: int = REQUESTS) -> DataFrame:
    """A stream of calls (event_id, api_key, us) with the calls of their key in the 60 s before each and whether it had to wait: ``usage.request_limit`` over a stream, exactly.

    A call is given out once the watermark, ``late`` behind the latest call, has passed
    it; calls that come later than that are left out. A key holds its last minute.
    """
    timed = calls.select("event_id", "api_key", "us", F.timestamp_micros("us").alias("ts"), F.floor(F.col("us") / 1000).alias("ms"))
    return timed.withWatermark("ts", late).groupBy("api_key").transformWithState(TrailingMinute(limit), LIMITED, "Append", "EventTime")


def tokens_per_minute(calls: DataFrame, late: str = "10 seconds", limit: int = TOKENS) -> DataFrame:
    """A stream of calls (us, failed, prompt_words, response_words) as the tokens of each closed minute, and whether they pass the limit."""
    tokens = F.floor(F.col("prompt_words") * F.lit(TOKENS_A_WORD) + F.col("response_words") * F.lit(TOKENS_A_WORD)).cast("long")
    timed = calls.filter(~F.col("failed")).withColumn("ts", F.timestamp_micros("us")).withWatermark("ts", late)
    minutes = timed.groupBy(F.window("ts", "1 minute").alias("at")).agg(F.count(F.lit(1)).alias("calls"), F.sum(tokens).alias("tokens"))
    return minutes.select((F.unix_micros("at.start") / MINUTE).cast("long").alias("minute"), "calls", "tokens", (F.col("tokens") > limit).alias("over_limit"))


def side_by_side(raw: DataFrame, filtered: DataFrame, late: str = "10 minutes", within: str = "1 hour") -> DataFrame:
    """Each raw pair (batch_id, chunk_id, pair_idx, ts) with whether the stream of filtered pairs (the same columns) has it.

    Both outputs grow on their own. A pair is given out as accepted when both have it,
    and as not accepted once the watermark of both says that no filtered row of it,
    up to ``within`` after the raw one, can still come; a side that lags holds it back.
    """
    a = raw.select("batch_id", "chunk_id", "pair_idx", F.col("ts").alias("made")).withWatermark("made", late).alias("a")
    b = filtered.select("batch_id", "chunk_id", "pair_idx", F.col("ts").alias("kept")).withWatermark("kept", late).alias("b")
    same = (F.col("a.batch_id") == F.col("b.batch_id")) & (F.col("a.chunk_id") == F.col("b.chunk_id")) & (F.col("a.pair_idx") == F.col("b.pair_idx"))
    near = F.expr(f"b.kept >= a.made and b.kept <= a.made + interval {within}")
    return a.join(b, same & near, "left_outer").select("a.batch_id", "a.chunk_id", "a.pair_idx", F.col("b.kept").isNotNull().alias("accepted"))
