"""Keyed state of streams: processors for ``transformWithState``, which needs the RocksDB state store."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Row
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

DAY_MS = 86_400_000
ROCKS = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class ReminderCooldown(StatefulProcessor):
    """A user's last notification, until ``burst_days`` after it."""

    def __init__(self, burst_days: int) -> None:
        self.span = burst_days * DAY_MS

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "time_ms long, seq long, type string")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        last = self.last.get() if self.last.exists() else None
        was = last
        for r in sorted(rows, key=lambda r: (r.time_ms, r.decision is not None, r.seq if r.seq is not None else -1)):
            if r.decision is not None:
                if last is not None and last[2] != "PRE_BURST" and last[0] > r.time_ms - self.span:
                    continue
                yield Row(user_id=key[0], time_ms=r.time_ms, seq=r.seq, decision=r.decision)
            now = (r.time_ms, r.seq if r.seq is not None else -1, r.decision if r.decision is not None else r.type if r.type and r.type.strip() else "UNKNOWN")
            if last is None or now[:2] >= (last[0], last[1]):
                last = now
        if last != was:
            if was is not None:
                self.handle.deleteTimer(was[0] + self.span)
            self.last.update(tuple(last))
            self.handle.registerTimer(last[0] + self.span)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.last.clear()
        return iter([])

    def close(self) -> None:
        pass


class AttemptCounter(StatefulProcessor):
    """How often a request has failed, until it ends."""

    def __init__(self, limit: int, delay_ms: int) -> None:
        self.limit, self.delay_ms = limit, delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.failed = handle.getValueState("failed", "n int")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        before = n = self.failed.get()[0] if self.failed.exists() else 0
        for r in sorted(rows, key=lambda r: (r.time_ms, r.http_status)):
            attempt, outcome = n + 1, r.outcome
            if outcome == "retry" and attempt >= self.limit:
                outcome = "dead"
            n = attempt if outcome == "retry" else 0
            again = r.time_ms + self.delay_ms * 2 ** (attempt - 1) if outcome == "retry" else None
            yield Row(request_id=key[0], http_status=r.http_status, time_ms=r.time_ms, outcome=outcome, attempt=attempt, next_try_ms=again)
        if n:
            self.failed.update((n,))
        elif before:
            self.failed.clear()

    def close(self) -> None:
        pass
