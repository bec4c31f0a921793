"""The limiter and the lock-outs as streams: state kept for each key, let go by timers.

A batch's rows of a key are judged in order of time, on top of what earlier batches left;
rows of one key are as many in one task as a batch brings. Keys lie together in buckets by a
hash of the key, and a bucket's state is read and written once a batch. State lies in RocksDB beside the
checkpoint, so a restarted query goes on where it was, and a repeated batch starts from the
state before it. The batch jobs in `operators.guards` give the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from murmur import settings as S

REFUSED = "key STRING, second BIGINT, attempts BIGINT, refused BIGINT"
LOCKED = "key STRING, locked_at BIGINT, locked_until BIGINT, failures BIGINT"
STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, which these rules need."""
    before = spark.conf.get(STORE)
    spark.conf.set(STORE, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(STORE, before)


#: Keys share a state by a hash, so a batch asks for at most so many states, however many keys it has: each question
#: is a message between Python and the store, and these were nearly all of the time.
BUCKETS = 4096


def bucket_of(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int").alias("bucket")


class SlidingLimiter(StatefulProcessor):
    """Admits `limit` attempts of a key in any `seconds`; refused ones are not kept."""

    def __init__(self, limit: int, seconds: int):
        self.limit, self.seconds = limit, seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "key STRING, second BIGINT, n BIGINT")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        attempts: dict[tuple, int] = {}
        for row in rows:
            at = row.key, row.second
            attempts[at] = attempts.get(at, 0) + 1
        stored: dict[str, list[tuple[int, int]]] = {}
        for name, second, n in self.held.get():
            stored.setdefault(name, []).append((second, n))
        timer = self._expiry(stored)
        # From the end of its span on, nothing of a key counts any more.
        passed = timerValues.getCurrentWatermarkInMs()
        keys = {name: held for name, held in stored.items() if (held[-1][0] + self.seconds) * 1000 > passed}
        for name, second in sorted(attempts, key=lambda at: at[1]):
            tried = attempts[name, second]
            held = [x for x in keys.get(name, ()) if second - x[0] < self.seconds]
            admitted = min(tried, self.limit - sum(n for _, n in held))
            if admitted > 0:
                held.append((second, admitted))
            keys[name] = held
            if tried > admitted:
                yield Row(key=name, second=second, attempts=tried, refused=tried - admitted)
        kept = [(name, *x) for name, held in keys.items() for x in held]
        self.held.put(kept) if kept else self.held.clear()
        expiry = self._expiry(keys)
        if timer != expiry:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if expiry is not None:
                self.handle.registerTimer(expiry)

    def _expiry(self, keys: dict) -> int | None:
        """When the last span of these keys ends, in milliseconds."""
        return max(((held[-1][0] + self.seconds) * 1000 for held in keys.values() if held), default=None)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.held.clear()
        return iter(())

    def close(self) -> None:
        pass


class Account(StatefulProcessor):
    """Counts failures in a row and locks at `failures`; the counter outlives the lock, a success ends it."""

    def __init__(self, failures: int, seconds: int):
        self.failures, self.seconds = failures, seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getListState("accounts", "key STRING, counter BIGINT, until BIGINT")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        accounts = {name: (counter, until) for name, counter, until in self.state.get()}
        attempts = [(row.second, row.at, row.order, row.failed, row.key) for row in rows]
        for second, _, _, failed, name in sorted(attempts, key=_in_order):
            counter, until = accounts.get(name, (0, -1))
            if second < until:
                continue
            counter, until = counter + 1 if failed else 0, -1
            if failed and counter >= self.failures:
                until = second + self.seconds
                yield Row(key=name, locked_at=second, locked_until=until, failures=counter)
            accounts[name] = counter, until
        # The others are as if never seen.
        kept = [(name, counter, until) for name, (counter, until) in accounts.items() if counter or until > 0]
        self.state.put(kept) if kept else self.state.clear()

    def close(self) -> None:
        pass


def _in_order(attempt: tuple) -> list[tuple]:
    """By time, then place, then outcome; nulls first, as Spark sorts them."""
    return [(value is not None, value) for value in attempt[:4]]


def sliding_refusals(log: DataFrame, key: str, limit: int = S.SIGNUP_LIMIT[0], seconds: int = S.SIGNUP_LIMIT[1],
                     watermark: str = S.WATERMARK) -> DataFrame:
    """Refusals (REFUSED) of a stream of attempts; a second that two batches share has a row of each.

    Rows older than the watermark are dropped. A key's state goes when its span has passed.
    """
    name = F.col(key).cast("string")
    rows = log.withWatermark("timestamp", watermark).select(
        bucket_of(name), name.alias("key"), "timestamp", F.unix_timestamp("timestamp").alias("second"))
    return rows.groupBy("bucket").transformWithState(SlidingLimiter(limit, seconds), REFUSED, "Append", "EventTime")


def locks(log: DataFrame, key: str, order: str, failed: Column, failures: int = S.LOCKOUT_FAILURES,
          seconds: int = S.LOCKOUT_SECONDS) -> DataFrame:
    """Locks (LOCKED) of a stream of attempts; attempts of one time go by `order`.

    Only accounts with failures since their last success, or a lock, have state.
    """
    name = F.col(key).cast("string")
    rows = log.select(bucket_of(name), name.alias("key"), F.unix_timestamp("timestamp").alias("second"),
                      F.unix_micros("timestamp").alias("at"), F.col(order).alias("order"), failed.alias("failed"))
    return rows.groupBy("bucket").transformWithState(Account(failures, seconds), LOCKED, "Append", "None")
