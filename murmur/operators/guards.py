"""Rate limits, sign-in bursts and lock-outs over a log of attempts.

Times are whole seconds. A user may own a third of the log, so attempts are first
summed per user and second. What is then sequential runs over at most one row per
second of the log's span, only within stretches whose start state is known, and within
these in blocks of time that run at the same time; see `machines`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from murmur import settings as S
from murmur.functions.text import bind
from murmur.operators.machines import Rule, run_rule
from murmur.operators.spans import last_seen, running_max, sliding_sum

FAR = 1 << 40
#: Seconds of a block, drawn up to a whole number of the rule's own spans: a steady key then meets each block alike.
BLOCK = 86_400


def _block(seconds: int) -> int:
    return -(-BLOCK // seconds) * seconds


def per_second(log: DataFrame, key: str) -> DataFrame:
    return (log.groupBy(F.col(key).alias("key"), F.unix_timestamp("timestamp").alias("second"))
            .agg(F.count("*").alias("attempts")))


def fixed_window_breaches(log: DataFrame, key: str, limit: int = S.API_LIMIT[0],
                          seconds: int = S.API_LIMIT[1]) -> DataFrame:
    """Key and clock window over the limit, refused requests counted too."""
    second = F.unix_timestamp("timestamp")
    return (log.groupBy(F.col(key).alias("key"), (second - second % seconds).alias("window_second"))
            .agg(F.count("*").alias("attempts")).filter(F.col("attempts") > limit)
            .withColumn("refused", F.col("attempts") - limit))


def busy_seconds(log: DataFrame, key: str, limit: int = S.API_LIMIT[0],
                 seconds: int = S.API_LIMIT[1]) -> DataFrame:
    """Key and second at which the trailing span holds more than `limit` attempts.

    The screening form: it counts every attempt, refused or not.
    """
    rolled = sliding_sum(per_second(log, key), ["key"], "second", seconds - 1, {"in_span": F.col("attempts")})
    return rolled.filter(F.col("in_span") > limit)


def _stretches(seen: DataFrame, limit: int, span: int) -> DataFrame:
    """The seconds a limiter has to walk through, grouped into independent stretches.

    While the trailing sum of all attempts stays within the limit nothing can be
    refused. Once that has held for a whole span, the limiter's memory is just the
    attempts of that span: a stretch starts there, from its warm-up rows.
    """
    key, second = ["key"], F.col("second")
    rolled = sliding_sum(seen, key, "second", span, {"in_span": F.col("attempts")})
    near = last_seen(rolled, key, "second", span, F.col("in_span") > limit, "last_over")
    contested = F.col("last_over").isNotNull()
    opened = last_seen(near, key, "second", span, contested, "before", strict=True)
    starts = contested & F.col("before").isNull()
    ahead = last_seen(opened.withColumn("back", FAR - second), key, "back", span, starts, "ahead", strict=True)
    # A second that is not contested itself warms up the stretch that opens within a
    # span after it, or else still counts towards the one it follows.
    walked = ahead.filter(contested | F.col("before").isNotNull() | F.col("ahead").isNotNull())
    marked = running_max(walked, key, "second", F.when(starts, second), "last_start")
    stretch = F.when(~contested & F.col("ahead").isNotNull(), FAR - F.col("ahead")).otherwise(F.col("last_start"))
    return marked.select("key", "second", "attempts", stretch.alias("stretch"))


HELD = "struct<stretch:bigint,held:array<struct<second:bigint,n:bigint>>>"


def _limiter(limit: int, seconds: int) -> Rule:
    """The sliding limiter: its state is what it admitted in the span, refused attempts are not in it."""
    def state(stretch: Column, held: Column) -> Column:
        return F.struct(stretch.alias("stretch"), held.alias("held")).cast(HELD)

    def held_at(s: Column, row: Column) -> Column:
        fresh = F.filter(s["held"], lambda x: row["second"] - x["second"] < seconds)
        return F.when(s["stretch"] == row["stretch"], fresh).otherwise(F.array().cast("array<struct<second:bigint,n:bigint>>"))

    def step(s: Column, row: Column) -> Column:
        def admitted(held: Column) -> Column:
            used = F.aggregate(held, F.lit(0).cast("bigint"), lambda n, x: n + x["n"])
            return F.least(row["attempts"], F.lit(limit).cast("bigint") - used)

        def told(x: Column) -> Column:
            more = F.array(F.struct(row["second"].alias("second"), x["n"].alias("n")))
            refused = F.array(F.struct(row["second"].alias("second"), row["attempts"].alias("attempts"), (row["attempts"] - x["n"]).alias("refused")))
            return F.struct(state(row["stretch"], F.when(x["n"] > 0, F.concat(x["held"], more)).otherwise(x["held"])).alias("state"),
                            F.when(row["attempts"] > x["n"], refused).otherwise(F.array().cast(REFUSALS)).alias("out"))
        return bind(held_at(s, row), lambda held: bind(F.struct(held.alias("held"), admitted(held).alias("n")), told))
    def apart(a: Column, b: Column) -> Column:
        return F.when((a["stretch"] == b["stretch"]) & (F.size(a["held"]) == F.size(b["held"])), F.aggregate(
            F.zip_with(a["held"], b["held"], lambda x, y: F.abs(x["second"] - y["second"])), F.lit(0).cast("bigint"), lambda n, x: n + x))
    return Rule(
        start=state(F.lit(None), F.array()), step=step, apart=apart,
        enter=lambda s, first: bind(held_at(s, first), lambda held: state(F.when(F.size(held) > 0, s["stretch"]), held)),
        moved=lambda s, by: state(s["stretch"], F.transform(s["held"], lambda x: F.struct((x["second"] + by).alias("second"), x["n"].alias("n")))))


REFUSALS = "array<struct<second:bigint,attempts:bigint,refused:bigint>>"


def sliding_window_refusals(log: DataFrame, key: str, limit: int = S.SIGNUP_LIMIT[0],
                            seconds: int = S.SIGNUP_LIMIT[1]) -> DataFrame:
    """Refusals per key and second of a limiter that does not record refused attempts.

    For sign-in bursts pass the log of failed attempts: only those are recorded.
    """
    walked = _stretches(per_second(log, key), limit, seconds - 1)
    return run_rule(walked, _limiter(limit, seconds), REFUSALS, _block(seconds))


def outcome_seconds(log: DataFrame, key: str, order: str, failed: Column) -> DataFrame:
    """Per key and second, what a failure counter needs to know of the attempts in it.

    `lead` failures before the first success, `tail` failures after the last one,
    `longest` the longest run of failures after any success.
    """
    rows = log.select(F.col(key).alias("key"), F.unix_timestamp("timestamp").alias("second"),
                      "timestamp", order, failed.alias("failed"))
    run = F.count_if(~F.col("failed")).over(
        W.partitionBy("key", "second").orderBy("timestamp", order).rowsBetween(W.unboundedPreceding, 0))
    runs = (rows.withColumn("run", run).groupBy("key", "second", "run")
            .agg(F.count_if("failed").alias("failures"), F.count("*").alias("attempts")))
    return runs.groupBy("key", "second").agg(
        F.sum("attempts").alias("attempts"), F.sum("failures").alias("failures"),
        F.coalesce(F.max(F.when(F.col("run") == 0, F.col("failures"))), F.lit(0)).alias("lead"),
        F.coalesce(F.max(F.when(F.col("run") > 0, F.col("failures"))), F.lit(0)).alias("longest"),
        F.max_by("failures", "run").alias("tail"))


def lockouts(log: DataFrame, key: str, order: str, failed: Column,
             failures: int = S.LOCKOUT_FAILURES, seconds: int = S.LOCKOUT_SECONDS) -> DataFrame:
    """Every lock of an account: when, until when, and its failure counter then.

    Attempts during a lock are refused uncounted; the counter outlives the lock, so
    the next failure locks again; a success resets it. A success with no failure in
    the span before it is surely let through, which makes it a safe cut.
    """
    seen = outcome_seconds(log, key, order, failed)
    recent = last_seen(seen, ["key"], "second", seconds - 1, F.col("failures") > 0, "before", strict=True)
    cut = F.when((F.col("lead") == 0) & F.col("before").isNull(), F.col("second"))
    stretches = running_max(recent, ["key"], "second", cut, "stretch").fillna(-1, ["stretch"])
    rows = stretches.select("key", "second", "attempts", "lead", "longest", "tail", "stretch")
    return run_rule(rows, _account(failures, seconds), LOCKS, _block(seconds))


LOCKS = "array<struct<locked_at:bigint,locked_until:bigint,failures:bigint>>"
ACCOUNT = "struct<stretch:bigint,counter:bigint,until:bigint,extra:bigint,reset:boolean>"


def _account(failures: int, seconds: int) -> Rule:
    """An account's failure counter and lock.

    From `failures` on, how high the counter is changes nothing but what is reported, so it
    counts up to there and `extra` beyond; `reset` tells that this no longer adds to what an
    earlier block brought.
    """
    def state(stretch, counter, until, extra, reset) -> Column:
        return F.struct(stretch.alias("stretch"), counter.alias("counter"), until.alias("until"), extra.alias("extra"),
                        reset.alias("reset")).cast(ACCOUNT)
    none, no, yes = F.lit(-1), F.lit(False), F.lit(True)

    def current(s: Column, row: Column) -> Column:
        return F.when(s["stretch"] == row["stretch"], s).otherwise(state(row["stretch"], F.lit(0), none, F.lit(0), yes))

    def step(before: Column, row: Column) -> Column:
        def told(s: Column) -> Column:
            until = row["second"] + seconds
            again = s["counter"] >= failures
            by_lead = (row["lead"] > 0) & (s["counter"] + row["lead"] >= failures)
            by_later = (row["lead"] < row["attempts"]) & (row["longest"] >= failures)
            full = F.lit(failures)
            unbroken = row["lead"] == row["attempts"]
            after = (F.when(row["second"] < s["until"], s)
                     .when(by_lead, state(s["stretch"], full, until, F.when(again, s["extra"] + 1).otherwise(0), s["reset"] | ~again))
                     .when(by_later, state(s["stretch"], full, until, F.lit(0), yes))
                     .otherwise(state(s["stretch"], row["tail"] + F.when(unbroken, s["counter"]).otherwise(0), none, F.lit(0), yes)))
            locked = (row["second"] >= s["until"]) & (by_lead | by_later)
            return bind(after, lambda a: F.struct(a.alias("state"), F.when(locked, F.array(F.struct(
                row["second"].alias("locked_at"), until.alias("locked_until"), (a["counter"] + a["extra"]).alias("failures"))).cast(LOCKS))
                .otherwise(F.array().cast(LOCKS)).alias("out")))
        return bind(current(before, row), told)

    def alone(s: Column) -> Column:
        return state(s["stretch"], s["counter"], s["until"], F.lit(0), no)

    def enter(s: Column, first: Column) -> Column:
        until = F.when(s["until"] > first["second"], s["until"]).otherwise(-1)
        seen = state(s["stretch"], s["counter"], until, s["extra"], no)
        nothing = (s["stretch"] != first["stretch"]) | s["stretch"].isNull() | ((until < 0) & (s["counter"] == 0))
        return F.when(nothing, start).otherwise(seen)
    start = state(F.lit(None), F.lit(0), none, F.lit(0), no)
    def apart(a: Column, b: Column) -> Column:
        same = (a["stretch"] == b["stretch"]) & (a["counter"] == b["counter"]) & (a["until"] > 0) & (b["until"] > 0)
        return F.when(same, F.abs(a["until"] - b["until"]))
    return Rule(
        start=start, step=step, enter=enter, alone=alone, apart=apart,
        moved=lambda s, by: state(s["stretch"], s["counter"], F.when(s["until"] > 0, s["until"] + by).otherwise(-1), s["extra"], no),
        joined=lambda s, end: state(end["stretch"], end["counter"], end["until"],
                                    end["extra"] + F.when(end["reset"], 0).otherwise(s["extra"]), no))
