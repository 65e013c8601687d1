"""Circuit breaker and budget as the state of a run that goes on over many micro-batches.

Attempts of a provider come as a stream, in rising order within a provider from batch to batch; within one batch in any
order. State a provider: errors and hits so far, what was spent, and where it stopped. A provider that is silent for `idle`
is forgotten by a timer, so it starts anew and the state does not grow with providers that are gone.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

#: The state store that processors with timers need.
STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
_STATE = "errors long, hits long, spent double, stopped boolean, seen long"


class _Breaker(StatefulProcessor):
    def __init__(self, threshold: int, budget: float | None, idle_ms: int | None):
        self.threshold, self.budget, self.idle_ms = threshold, budget, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", _STATE)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        every = pd.concat(list(rows), ignore_index=True).sort_values("o", kind="stable")
        errors, hits, spent, stopped, seen = self.run.get() if self.run.exists() else (0, 0, 0.0, False, 0)
        out = {"errors_before": [], "hits_before": [], "spent_before": [], "attempted": []}
        for error, hit, cost in zip(every["error"], every["hit"], every["cost"], strict=True):
            stopped = stopped or (errors >= self.threshold and hits == 0)
            room = self.budget is None or spent < self.budget
            out["errors_before"].append(errors)
            out["hits_before"].append(hits)
            out["spent_before"].append(spent)
            out["attempted"].append(not stopped and room)
            errors, hits = errors + bool(error), hits + bool(hit)
            spent += float(cost) if not stopped and room else 0.0
        if self.idle_ms:
            for due in list(self.handle.listTimers()):
                self.handle.deleteTimer(due)
            seen = max(seen, int(every["ms"].max()))
            self.handle.registerTimer(seen + self.idle_ms)
        self.run.update((errors, hits, spent, stopped, seen))
        yield pd.DataFrame({"provider": [key[0]] * len(every), "o": every["o"].to_numpy(), **out})

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.run.clear()
        return iter(())

    def close(self) -> None:
        pass


def attempts(stream: DataFrame, provider: str, order: str, error: Column, hit: Column, cost: Column | None = None, threshold: int = 5, budget: float | None = None, event_time: str | None = None, delay: str = "0 seconds", idle_seconds: float | None = None) -> DataFrame:
    """provider, `order`, errors_before, hits_before, spent_before, attempted for each attempt of the stream.

    A provider stops for good once `threshold` errors came before any hit; it rests while no budget is left (what is begun
    with some left may overspend it). Counts are of all attempts, costs of those attempted. Splitting the stream into other
    batches changes nothing. event_time and idle_seconds go together: rows later than the watermark (`delay` behind the
    latest) are dropped, and a provider is forgotten `idle_seconds` after its last row. The session needs the state store in
    STORE.
    """
    kinds = dict(stream.dtypes)
    if (event_time is None) != (idle_seconds is None):
        raise ValueError("event_time and idle_seconds go together")
    zero, timed = F.lit(0.0), []
    if event_time:
        stream = stream.withWatermark(event_time, delay)
        timed = [F.col(event_time).alias("__t"), F.unix_millis(event_time).alias("ms")]
    rows = stream.select(F.col(provider).alias("provider"), F.col(order).alias("o"), F.coalesce(error, F.lit(False)).alias("error"), F.coalesce(hit, F.lit(False)).alias("hit"), F.coalesce((zero if cost is None else cost).cast("double"), zero).alias("cost"), *timed)
    out = StructType.fromDDL(f"provider {kinds[provider]}, o {kinds[order]}, errors_before long, hits_before long, spent_before double, attempted boolean")
    idle_ms = int(idle_seconds * 1000) if idle_seconds else None
    decided = rows.groupBy("provider").transformWithStateInPandas(_Breaker(threshold, budget, idle_ms), out, "Append", "EventTime" if idle_ms else "None")
    return decided.withColumnsRenamed({"provider": provider, "o": order})
