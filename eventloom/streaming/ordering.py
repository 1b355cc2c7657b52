"""Messages of a keyed stream put back into the order of their key, with gaps flagged."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Groups of keys; each is called at most once a batch, with the messages that its keys got.
GROUPS = 1024

_STATE = "keys array<string>, places array<bigint>, lasts array<bigint>, held array<int>, times array<bigint>, numbers array<bigint>, bodies array<string>"


def _release(group: tuple[Any, ...], arrived: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Put out what the watermark has passed, in order by key; hold the rest until it does."""
    keys, places, lasts, held, times, numbers, bodies = state.get if state.exists else ([],) * 7
    parts = list(arrived)
    # The keys of the state come first, so that their codes are their places in it; the same for what was held.
    codes, known = pd.factorize(np.concatenate([np.array(keys, object), *[p["_key"].to_numpy(object) for p in parts]]))
    fresh = len(known) - len(keys)
    places, lasts = (np.concatenate([np.array(v, np.int64), np.zeros(fresh, np.int64)]) for v in (places, lasts))
    code = np.concatenate([np.array(held, np.int64), codes[len(keys):]])
    time = np.concatenate([np.array(times, np.int64), *[p["_time"].to_numpy(np.int64) for p in parts]])
    number = np.concatenate([np.array(numbers, np.int64), *[p["_number"].to_numpy(np.int64) for p in parts]])
    body = np.concatenate([np.array(bodies, object), *[p["_body"].to_numpy(object) for p in parts]])
    order = np.lexsort((number, time, code))
    again = np.zeros(len(order), bool)  # a message delivered again while held counts once
    again[1:] = (np.diff(code[order]) == 0) & (np.diff(time[order]) == 0) & (np.diff(number[order]) == 0)
    order = order[~again]
    mark = state.getCurrentWatermarkMs()
    passed = time[order] <= mark * 1000
    ready, rest = order[passed], order[~passed]
    if len(ready):
        of, out = code[ready], number[ready]
        first = np.append(True, of[1:] != of[:-1])
        begin = np.flatnonzero(first)
        runs = np.diff(np.append(begin, len(of)))
        before = np.where(first, lasts[of], np.append(0, out[:-1]))
        yield pd.DataFrame({
            "key": known[of], "place": places[of] + 1 + np.arange(len(of)) - np.repeat(begin, runs), "number": out,
            "time": time[ready].astype("datetime64[us]"), "missing": out - before - 1, "body": body[ready],
        })
        places[of[begin]] += runs
        lasts[of[begin]] = out[begin + runs - 1]
    state.update((known.tolist(), places.tolist(), lasts.tolist(), *(v[rest].tolist() for v in (code, time, number, body))))
    if len(rest):
        state.setTimeoutTimestamp(max(int(time[rest].min()) // 1000, mark + 1))


def in_key_order(
    messages: DataFrame, key: str, number: str, time: str, delay: str, body: str, groups: int = GROUPS
) -> DataFrame:
    """key, place (from 1), number, time, missing, body: the messages of a stream by key in order of time and number.

    A message waits until the watermark passes its time, so messages that come at most ``delay`` out of order are put
    right; later ones are dropped by the watermark (``keep_late`` can hold them). ``missing`` is how many numbers lie
    between a message and the one before it. A message delivered again counts once. The state of a key is its last
    place and number and the messages of the last ``delay``; messages without key, number or time are left out.

    Keys are dealt by hash over ``groups``, whose states are kept and called as one, because a call of Python costs
    milliseconds and a stream has far more keys than that allows. ``groups`` stays the same for one checkpoint.
    """
    shape = "key string, place bigint, number bigint, time timestamp, missing bigint, body string"
    named = messages.select(
        F.col(key).cast("string").alias("_key"), F.col(number).cast("long").alias("_number"), F.col(time).cast("timestamp").alias("_at"),
        F.unix_micros(F.col(time).cast("timestamp")).alias("_time"), F.col(body).cast("string").alias("_body"),
    ).where("_key IS NOT NULL AND _number IS NOT NULL AND _at IS NOT NULL")
    dealt = named.withColumn("_group", F.pmod(F.xxhash64("_key"), F.lit(groups)))
    keyed = dealt.withWatermark("_at", delay).groupBy("_group")
    return keyed.applyInPandasWithState(_release, shape, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
