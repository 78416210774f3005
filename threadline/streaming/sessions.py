"""Sessions of a stream: each source's rows numbered in time order as ``operators.chat.sessionise`` numbers them, however they arrive.

Rows wait in the state of their source until the watermark has passed them; then no earlier row can come and they get their number. What
stays is the time of the last counted row, the session number and the rows that still wait, so state is bounded by what comes within the delay.
Sources share states by a hash of their number, so that many are numbered at once, by arrays, and a call and a state are not paid for each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Arrays as bytes: source, time, id and kind of the rows that wait; source, time of the last counted row and session of all sources seen.
STATE = "source binary, t binary, id binary, counted binary, known binary, last binary, session binary"
KINDS = (np.int64, np.int64, np.int64, np.bool_, np.int64, np.int64, np.int64)
#: Stands for the last counted row of a source that has none.
NEVER = np.iinfo(np.int64).min


def stream_sessions(stream: DataFrame, source: str, id_col: str, ts: str, counts: Column, delay: str = "1 day", hours: float = 4.0, shares: int = 2048) -> DataFrame:
    """(source, id, ts, session_no) of every row once the watermark has passed it, as a stream to append.

    Rows that come later than ``delay`` are left out; rows whose kind is not counted do not move the clock but get the session around them.
    Ties in time go by id. Ids and sources are whole numbers; rows without a time take no part. There are ``shares`` states, and one for
    rows without a source; a stream goes on from its state only with the same number of them.
    """
    gap = int(hours * 3_600_000_000)

    def number(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = state.get if state.exists else [b""] * len(KINDS)
        *rows, known, last, session = (np.frombuffer(x, kind) for x, kind in zip(held, KINDS, strict=True))
        new = [b for b in batches if len(b)]
        of, t, i, c = (np.concatenate([x, *(b[n].to_numpy(kind) for b in new)]) for x, n, kind in zip(rows, ("source", "t", "id", "counted"), KINDS, strict=False))
        order = np.lexsort((i, t, of))
        mark = state.getCurrentWatermarkMs() * 1000
        ready, waiting = order[t[order] <= mark], order[t[order] > mark]

        names = np.union1d(known, of[ready])
        lasts, sessions, old = np.full(len(names), NEVER), np.ones(len(names), np.int64), np.searchsorted(names, known)
        lasts[old], sessions[old] = last, session
        at, counted = np.searchsorted(names, of[ready]), c[ready]
        k, now = at[counted], t[ready][counted]
        before = lasts[k]  # of the first counted row of a source
        again = np.flatnonzero(k[1:] == k[:-1]) + 1
        before[again] = now[again - 1]
        cut = np.zeros(len(ready), np.int64)
        cut[counted] = (before != NEVER) & (now - before >= gap)
        cuts = np.cumsum(cut)
        numbers = sessions[at] + cuts - (cuts - cut)[np.searchsorted(at, at)]
        lasts[k], sessions[at] = now, numbers  # of a source's rows the last one stays

        kept = (of[waiting], t[waiting], i[waiting], c[waiting], names, lasts, sessions)
        state.update(tuple(x.tobytes() for x in kept))
        if len(waiting):
            state.setTimeoutTimestamp(max(int(t[waiting].min()), mark) // 1000 + 1)
        if len(ready):
            yield pd.DataFrame({"source": of[ready] if key[0] >= 0 else None, "id": i[ready], "t": t[ready], "session_no": numbers})

    own = F.col(source).cast("long")
    share = F.when(own.isNull(), -1).otherwise(F.pmod(F.xxhash64(own), F.lit(shares)))
    rows = stream.select(share.alias("share"), F.coalesce(own, F.lit(0)).alias("source"), F.col(id_col).cast("long").alias("id"), F.col(ts).cast("timestamp").alias("ts"), F.coalesce(counts, F.lit(False)).alias("counted"))
    rows = rows.where("ts is not null").withColumn("t", F.unix_micros("ts"))
    held = rows.withWatermark("ts", delay).groupBy("share")
    numbered = held.applyInPandasWithState(number, "source bigint, id bigint, t bigint, session_no bigint", STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return numbered.select("source", "id", F.timestamp_micros("t").alias("ts"), "session_no")


def run_to_end(stream: DataFrame, sink: str, state: str) -> None:
    """All that the stream has now, appended to a folder of Parquet files."""
    stream.writeStream.format("parquet").option("checkpointLocation", state).option("path", sink).outputMode("append").trigger(availableNow=True).start().awaitTermination()
