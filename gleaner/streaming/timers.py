"""Retries that come due as event time passes: state and timers per key, gone after the outcome."""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from gleaner.functions.retry import MILLIS
from gleaner.streaming.ingest import run_to_end

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_EPOCH = datetime.fromtimestamp(0, timezone.utc)


@contextmanager
def rocksdb_state(spark: SparkSession):
    """State with timers needs the RocksDB store; the session's own setting comes back afterwards."""
    own = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, own) if own else spark.conf.unset(_PROVIDER)


def _waiting_micros(key: Sequence, failures: int) -> int:
    """What :func:`gleaner.operators.ledger.retry_decision` waits, for one key."""
    seed = "|".join(str(k) for k in (*key, failures) if k is not None)
    return (1 << (failures - 1)) * 1_000_000 + int(hashlib.md5(seed.encode()).hexdigest()[:6], 16) % (MILLIS + 1) * 1000


class RetryScheduler(StatefulProcessor):
    """Attempts of a key in order of event time, whatever order they come in; its next retry as a timer.

    An attempt waits in the state until the watermark has passed it. A failure below ``max_tries`` sets a timer; if it
    goes off before another attempt, the retry is due. A success, the last failure, and ``ttl_seconds`` without an
    attempt end the run and remove all state of the key; an attempt after that begins a new run.

    Keys come in buckets, so that a micro-batch costs some calls a bucket and not some a key: a bucket is one value, with
    one timer for the first moment at which something is to be done for a key of it.
    """

    def __init__(self, keys: Sequence[str], max_tries: int, ttl_seconds: int):
        self.keys, self.max_tries, self.ttl = list(keys), max_tries, ttl_seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.outcome = handle, Row(*self.keys, "action", "failures", "at")
        # ``held`` is a pickled list of ``key, moment, run, attempts``: the moment at which the key needs a look, its run
        # ``(failures, last_at, due_at)`` or None, and the attempts that wait.
        self.state = handle.getValueState("runs", "timer long, n_keys int, held binary")

    def _read(self):
        """The timer that is set, or None, and what is held of the keys."""
        state = self.state.get()
        return (None, []) if state is None else (state[0], pickle.loads(state[2]))

    def _write(self, timer, held: list) -> None:
        if not held:
            if timer is not None:
                self.handle.deleteTimer(timer)
                self.state.clear()
            return
        wake = -(-min(h[1] for h in held) // 1000)
        if wake != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(wake)
        self.state.update((wake, len(held), pickle.dumps(held, pickle.HIGHEST_PROTOCOL)))

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        n, new = len(self.keys), {}
        for r in rows:
            # Values that cannot be hashed, and those that differ from themselves, are keys too.
            name = repr(r[:n])
            if name not in new:
                new[name] = (tuple(r[:n]), [])
            new[name][1].append(tuple(r[n:n + 3]))
        if new:
            timer, held = self._read()
            for i, (k, moment, run, waiting) in enumerate(held):
                _, more = new.pop(repr(k), (k, None))
                if more:
                    held[i] = (k, min(moment, min(more)[0]), run, sorted(waiting + more))
            held += [(k, min(more)[0], None, sorted(more)) for k, more in new.values()]
            self._write(timer, held)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        timer, held = self._read()
        kept, told = [], []
        for entry in held:
            if entry[1] > now:
                kept.append(entry)
                continue
            k, _, run, waiting = entry
            found: list = []
            run, waiting = self._work_off(k, run, waiting, now, found)
            times = [waiting[0][0]] if waiting else []
            times += [x for x in (run[2], run[1] + self.ttl) if x is not None] if run else []
            if times:
                kept.append((k, min(times), run, waiting))
            told += [(k, *f) for f in found]
        self._write(timer, kept)
        for k, action, failures, at in told:
            yield self.outcome(*k, action, failures, _EPOCH + timedelta(microseconds=at))

    def _work_off(self, key, run, waiting: list, now: int, found: list):
        """The run and the attempts that still wait at ``now``."""
        passed = [x for x in waiting if x[0] <= now]
        for ts, _, status in passed:
            run = self._pass_time(key, run, ts - 1, found)
            failures = (run[0] if run else 0) + (status == "failed")
            if status == "completed" or failures >= self.max_tries:
                found.append(("done" if status == "completed" else "failed", failures, ts))
                run = None
            else:
                # A run begins with a failure; nothing is kept of attempts before it.
                run = (failures, ts, ts + _waiting_micros(key, failures)) if failures else None
        return self._pass_time(key, run, now, found), waiting[len(passed):]

    def _pass_time(self, key, state, now: int, found: list):
        """The state at ``now``: a due retry is told once, a run without attempts for too long is gone."""
        if state and state[2] is not None and state[2] <= min(now, state[1] + self.ttl):
            found.append(("retry", state[0], state[2]))
            state = (state[0], state[1], None)
        return None if state and state[1] + self.ttl <= now else state

    def close(self) -> None:
        pass


def retry_timers(attempts: DataFrame, keys: Sequence[str], max_tries: int = 5, delay: str = "1 hour",
                 ttl_seconds: int = 30 * 86_400, ts: str = "ts", seq: str = "seq", buckets: int = 2048) -> DataFrame:
    """Stream of ``keys, action, failures, at`` from a stream of attempts (``status``, ``ts``, ``seq``).

    ``retry`` comes when its time ``at`` has passed without another attempt, ``failed`` and ``done`` when the run ends.
    Times are those of the attempts: what comes out does not depend on how attempts are cut into files, as long as none
    comes more than ``delay`` behind the newest; such late attempts are left out and counted (:func:`run_retries`). An
    attempt without time is none; null keys are keys.

    The state is kept by ``buckets`` of keys, which a micro-batch reads and writes whole if it has an attempt or a moment
    of one of their keys: take more for more live keys. A checkpoint keeps the number it began with.
    """
    kinds = dict(attempts.dtypes)
    rows = attempts.withWatermark(ts, delay).where(F.col(ts).isNotNull()).select(
        *keys, F.unix_micros(ts).alias("attempt_us"), F.coalesce(F.col(seq).cast("bigint"), F.lit(0)).alias("attempt_seq"),
        F.coalesce("status", F.lit("")).alias("attempt_status"), F.col(ts).alias("attempt_ts"),
        F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("attempt_bucket"))
    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", action string, failures int, at timestamp"
    return rows.groupBy("attempt_bucket").transformWithState(
        RetryScheduler(keys, max_tries, ttl_seconds), schema, "append", "eventTime")


def run_retries(outcomes: DataFrame, target: str, checkpoint: str) -> dict[str, int]:
    """Append what :func:`retry_timers` gives to ``target`` exactly once, until all files are worked off.

    Returns the counts of this run: ``late`` attempts that were left out, and ``keys`` that have state at its end.
    """
    spark = outcomes.sparkSession
    with rocksdb_state(spark):
        query = run_to_end(outcomes.writeStream.format("parquet").outputMode("append")
                           .option("checkpointLocation", checkpoint).option("path", target))
        states = [p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"]]
        buckets = spark.read.format("statestore").option("stateVarName", "runs").load(checkpoint) if states else None
        keys = buckets.agg(F.sum("value.n_keys")).first()[0] if states else 0
    return {"late": sum(s["numRowsDroppedByWatermark"] for s in states), "keys": keys or 0}
