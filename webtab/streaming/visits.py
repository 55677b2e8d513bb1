"""A visited set that forgets: visits of each key, open while rows keep coming and closed once the watermark says none can."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

# the code of the tasks travels with them
cloudpickle.register_pickle_by_value(sys.modules[__name__])

VISIT = "key string, first_seen timestamp, first_referrer string, last_seen timestamp, n long"
OPEN = "start array<long>, end array<long>, referrer array<string>, n array<long>"


def _merged(spans: list[list], idle: int) -> list[list]:
    """Spans (start, end, referrer, n) that lie at most ``idle`` apart become one; the earliest referrer stays."""
    out: list[list] = []
    for span in sorted(spans, key=lambda s: (s[0], s[2] or "")):
        if out and span[0] - out[-1][1] <= idle:
            last = out[-1]
            last[1], last[3] = max(last[1], span[1]), last[3] + span[3]
        else:
            out.append(list(span))
    return out


def _visits_of(idle: int) -> Callable[..., Iterator[pd.DataFrame]]:
    """What is done with a key: its state are the open visits, as lists of their starts, ends, first referrers and numbers of rows (microseconds).

    A late row may lie between two open visits and join them, so a visit is only given out when the watermark has
    passed its end by ``idle``: the key's timeout waits for the first such end, and the key forgets the visit.
    """
    def due(span: list) -> int:
        return -(-(span[1] + idle) // 1000)

    def run(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        mark = state.getCurrentWatermarkMs()
        spans = [list(s) for s in zip(*state.get, strict=True)] if state.exists else []
        for part in parts:
            # rows at the watermark or before it come too late
            spans += [[at, at, referrer, 1] for at, referrer in zip(part["at"].tolist(), part["referrer"].tolist(), strict=True) if at > mark * 1000]
            spans = _merged(spans, idle)
        done, left = [s for s in spans if due(s) <= mark], [s for s in spans if due(s) > mark]
        if left:
            state.update(tuple(map(list, zip(*left, strict=True))))
            state.setTimeoutTimestamp(min(map(due, left)))
        elif state.exists:
            state.remove()
        if done:
            start, end, referrer, n = zip(*done, strict=True)
            yield pd.DataFrame({"key": [key[0]] * len(done), "first_seen": pd.to_datetime(list(start), unit="us"), "first_referrer": list(referrer),
                                "last_seen": pd.to_datetime(list(end), unit="us"), "n": list(n)})
    return run


def visits(stream: DataFrame, key: str, event_time: str, referrer: str, idle: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """Closed visits (``VISIT``) of a stream: rows of a key that lie at most ``idle`` apart, with the referrer of the first one.

    Rows older than the watermark (``delay`` behind the latest event time) are dropped. Rows without key or time take no part.
    """
    spark = stream.sparkSession
    span = spark.sql(f"SELECT unix_micros(timestamp'2000-01-01 00:00:00' + INTERVAL {idle}) - unix_micros(timestamp'2000-01-01 00:00:00') AS n").first()["n"]
    rows = (stream.withWatermark(event_time, delay).filter(F.col(key).isNotNull() & F.col(event_time).isNotNull())
            .select(F.col(key).cast("string").alias("key"), F.col(event_time), F.unix_micros(event_time).alias("at"),
                    F.col(referrer).cast("string").alias("referrer")))
    return rows.groupBy("key").applyInPandasWithState(_visits_of(span), VISIT, OPEN, "append", GroupStateTimeout.EventTimeTimeout)
