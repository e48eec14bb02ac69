"""Session starts of a stream of log records.

A user's records may arrive in any order inside the delay of the watermark. They wait in the
user's state until the watermark has passed them, and then follow the rule of
:func:`trailmine.operators.sessions.session_starts` in the order ``(ts_ms, seq)``. So the
starts equal those of a batch over the same records.

A record that arrives when the watermark has passed its ``ts`` is late and left out, as if it
were not in the log. Records behind the watermark (the last ``delay`` before the latest one)
have no starts yet; they get them once later records of any user have arrived.

The state of a user holds the records that wait, the start of each query of the last span, and
the query of the last record. The latter stays for good, as the next record may have the same.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from trailmine.operators.sessions import expiry_ms
from trailmine.params import SESSION_SPAN_S, STREAM_DELAY
from trailmine.schemas import STARTS


def _opened(
    passed: list, previous: str | None, last: dict[str, int], expiry: int, seeds: set[str] | None
) -> tuple[list, str | None]:
    """Those of ``passed``, in order, that open a session, and the last query; ``last`` takes their starts."""
    starts = []
    for ms, seq, query in passed:
        other = query is not None and previous is not None and query != previous
        if other and (seeds is None or query in seeds) and (query not in last or ms >= last[query] + expiry):
            last[query] = ms
            starts.append((query, ms, seq))
        previous = query
    return starts, previous


def _advance(expiry: int, seeds: set[str] | None):
    def advance(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = json.loads(state.get[0]) if state.exists else {"previous": "", "last": {}, "waiting": []}
        waiting, last = held["waiting"], held["last"]
        for frame in frames:
            waiting += [
                [int(ms), int(seq), None if pd.isna(query) else query]
                for ms, seq, query in zip(frame["ts_ms"], frame["seq"], frame["query"])
            ]
        # No record before the watermark can still arrive.
        mark = state.getCurrentWatermarkMs()
        passed = sorted((r for r in waiting if r[0] < mark), key=lambda r: r[:2])
        waiting = [r for r in waiting if r[0] >= mark]
        starts, previous = _opened(passed, held["previous"], last, expiry, seeds)
        last = {query: ms for query, ms in last.items() if ms + expiry > mark}
        state.update((json.dumps({"previous": previous, "last": last, "waiting": waiting}),))
        if waiting:
            state.setTimeoutTimestamp(max(min(r[0] for r in waiting), mark + 1))
        if starts:
            rows = pd.DataFrame(starts, columns=["query", "ts_ms", "seq"])
            rows.insert(0, "user_id", key[0])
            yield rows

    return advance


def stream_session_starts(
    log: DataFrame,
    span_s: int = SESSION_SPAN_S,
    seed_queries: Sequence[str] | None = None,
    delay: str = STREAM_DELAY,
) -> DataFrame:
    """Records of a streaming log that open a session: ``user_id, query, ts_ms, seq``.

    ``log`` has ``user_id, ts, ts_ms, seq, query``; ``parse_log_lines`` with ``seq=`` makes it
    of a stream of lines. To be written in append mode.
    """
    seeds = None if seed_queries is None else set(seed_queries)
    rows = log.select("user_id", "ts", "ts_ms", "seq", "query").withWatermark("ts", delay)
    return rows.groupBy("user_id").applyInPandasWithState(
        _advance(expiry_ms(span_s), seeds), STARTS, "held string", "append", GroupStateTimeout.EventTimeTimeout)
