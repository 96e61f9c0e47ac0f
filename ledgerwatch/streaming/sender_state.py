"""Keyed state of the velocity rule: the recent transfers of one sender.

Kept apart from the rest because Python workers run it. The module is pickled by
value, so the workers need not have this package installed.
"""

from __future__ import annotations

import heapq
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATE = T.StructType([T.StructField("at_micros", T.LongType())])
OUTPUT = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("sender_iban", T.StringType()),
        T.StructField("risk_tier", T.StringType()),
        T.StructField("at_micros", T.LongType()),
        T.StructField("event_count", T.LongType()),
        T.StructField("late", T.BooleanType()),
    ]
)


def counts_in_arrival_order(recent: list[int], times: list[int], span: int) -> list[int]:
    """Size of the window after each arrival; ``recent`` is a heap, updated in place.

    An arrival drops every entry that is ``span`` or more older than itself, for
    good. Entries dated later than the arrival stay and count.
    """
    counts = []
    for time in times:
        heapq.heappush(recent, time)
        while recent[0] <= time - span:
            heapq.heappop(recent)
        counts.append(len(recent))
    return counts


def still_counting(times: np.ndarray, span: int) -> np.ndarray:
    """Which of a sender's arrivals, in order, no later one has dropped."""
    newest_after = np.maximum.accumulate(times[::-1])[::-1]
    return times > newest_after - span


class SenderWindow(StatefulProcessor):
    """Emits the transfers of a sender that reach the limit, and the late ones.

    The state is a list with one entry for each transfer, in order of arrival. A micro-batch
    adds its own entries behind the stored ones; the list is only written anew, without the entries
    that are dropped for good, once these are more than half of it. So an entry is written
    about twice, however long it stays.

    If ``bounded``, transfers that are not after the watermark are late: they are emitted as such
    and never counted. The state of a sender is cleared when the watermark has passed the newest transfer by the
    window length, as no transfer that is not late could still count it.
    """

    def __init__(self, limit: int, span_micros: int, bounded: bool):
        self.limit = limit
        self.span = span_micros
        self.bounded = bounded

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getListState("recent", STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        parts = list(rows)
        batch = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
        order = np.argsort(batch["arrival"].to_numpy(), kind="stable")
        times = batch["at_micros"].to_numpy(dtype=np.int64)[order]
        late = times <= timerValues.getCurrentWatermarkInMs() * 1000 if self.bounded else np.zeros(len(times), bool)
        counts = np.zeros(len(times), np.int64)
        if not late.all():
            counts[~late] = self._counts(times[~late])
        # Most senders have nothing to tell, and an empty frame for each would cost more than the rule.
        told = np.r_[np.flatnonzero(~late & (counts >= self.limit)), np.flatnonzero(late)]
        if len(told):
            yield batch.iloc[order[told]].assign(event_count=counts[told], late=late[told])[OUTPUT.fieldNames()]

    def _counts(self, times: np.ndarray) -> list[int]:
        stored = np.array([entry[0] for entry in self.state.get()], dtype=np.int64)
        recent = stored[still_counting(stored, self.span)].tolist() if len(stored) else []
        heapq.heapify(recent)
        counts = counts_in_arrival_order(recent, times.tolist(), self.span)
        every = np.concatenate([stored, times])
        kept = every[still_counting(every, self.span)]
        if len(stored) and 2 * len(kept) < len(every):
            self.state.put([(int(t),) for t in kept])
        else:
            self.state.appendList([(int(t),) for t in times])
        if self.bounded and not len(stored):
            self._start_timer(int(times.max()))
        return counts

    def _start_timer(self, newest: int) -> None:
        self.handle.registerTimer((newest + self.span) // 1000 + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """A sender with a state has one timer; if transfers have come since it was set, it is set again."""
        newest = max((entry[0] for entry in self.state.get()), default=None)
        if newest is not None and (newest + self.span) // 1000 + 1 > expiredTimerInfo.getExpiryTimeInMs():
            self._start_timer(newest)
        else:
            self.state.clear()
        return iter(())

    def close(self) -> None:
        pass
