"""De-duplication of a stream by keyed state that expires with event time.

Keys are dealt to buckets by hash, and a bucket is one entry of the state store: the hashes of the
keys seen, each with its event time. A row whose key has been seen within the horizon is a copy
and goes; every other row stays, however late it comes (``dropDuplicatesWithinWatermark`` drops
late rows, unique ones as well, for which reason it will not do). When a bucket is touched, what
lies more than the horizon behind the watermark is forgotten, so that the state is as large as
the orders of one horizon, not as the log, and nothing stored is read again.

Defined results: copies older than the horizon behind the watermark are not recognised (keyed
tables fold them); rows without a key are no copies; of copies in one batch, the oldest by event
time that its task sees first stays; a batch that runs again, from the state it started with,
keeps rows of the same keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from tidemark.operators.windows import window_seconds

BUCKETS = 4096
_META = ("_key", "_time", "_keyless")


def _coded(df: DataFrame, column: str):
    """A column as text and back, so that no type passes through floats."""
    if isinstance(df.schema[column].dataType, T.TimestampType):
        return F.unix_micros(column).cast("string")
    return F.col(column).cast("string")


def _decoded(field: T.StructField):
    if isinstance(field.dataType, T.TimestampType):
        return F.timestamp_micros(F.col(field.name).cast("bigint")).alias(field.name)
    return F.col(field.name).cast(field.dataType).alias(field.name)


def pack(seen: dict[int, list[int]], oldest: int) -> bytes:
    """The state of a bucket: keys and times, without what is older than ``oldest``."""
    pairs = [(k, t) for k, times in seen.items() for t in times if t >= oldest]
    return np.array(pairs, np.int64).reshape(-1, 2).tobytes()


def unpack(data: bytes) -> dict[int, list[int]]:
    seen: dict[int, list[int]] = {}
    for k, t in np.frombuffer(data, np.int64).reshape(-1, 2).tolist():
        seen.setdefault(k, []).append(t)
    return seen


def _first(frames: Iterator[pd.DataFrame], state, horizon: int, names: list[str]) -> Iterator[pd.DataFrame]:
    seen = unpack(state.get[0]) if state.exists else {}
    oldest = state.getCurrentWatermarkMs() * 1000 - horizon
    for frame in frames:
        keep = np.zeros(len(frame), bool)
        keys, times, keyless = (frame[c].to_numpy() for c in _META)
        for i in np.argsort(times, kind="stable"):
            k, t = int(keys[i]), int(times[i])
            known = seen.setdefault(k, [])
            keep[i] = keyless[i] or not any(abs(t - x) <= horizon for x in known)
            if keep[i] and not keyless[i]:
                known.append(t)
        yield frame.loc[keep, names]
    state.update((pack(seen, oldest),))


def first_copies(stream: DataFrame, key: str, within: str, delay: str = "5 seconds",
                 time_col: str = "event_time", buckets: int = BUCKETS) -> DataFrame:
    """The rows of a stream that are no copies of one within the event-time horizon ``within``."""
    horizon = window_seconds(within) * 1_000_000
    fields, names, k = stream.schema.fields, stream.columns, F.xxhash64(key)
    row = F.xxhash64(*stream.columns)
    meta = [F.pmod(F.when(F.col(key).isNull(), row).otherwise(k), F.lit(buckets)).alias("_bucket"), k.alias("_key"),
            F.coalesce(F.unix_micros(time_col), F.lit(0)).alias("_time"), F.col(key).isNull().alias("_keyless"),
            F.col(time_col).alias("_at")]   # as it is: the state asks for its watermark
    rows = stream.withWatermark(time_col, delay).select(*[_coded(stream, f.name).alias(f.name) for f in fields], *meta)
    kept = rows.groupBy("_bucket").applyInPandasWithState(
        lambda _, frames, state: _first(frames, state, horizon, names), T.StructType([rows.schema[n] for n in names]),
        "entries binary", "append", GroupStateTimeout.NoTimeout)
    return kept.select(*[_decoded(f) for f in fields])
