"""Progress throttling and the circuit breaker: stateful streams, and the same over tables."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

MIN_SECONDS, MIN_PCT = 0.5, 1.0
EVENT = "job string, t double, phase string, progress_pct double, message string"
STATE = "t double, pct double, phase string"
FAILURES, OPEN_SECONDS = 5, 60.0


def throttle(rows: Iterable[tuple], state: tuple | None) -> tuple[list[tuple], tuple | None]:
    """rows (t, phase, pct, message) in order -> (those passed on, with pct to 2 digits; the state after)."""
    out = []
    for t, phase, pct, message in rows:
        if state is None or phase != state[2] or (pct - state[1] >= MIN_PCT and t - state[0] >= MIN_SECONDS):
            out.append((t, phase, round(pct, 2), message))
            state = (t, pct, phase)
    return out, state


def _frame(job: str, rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["t", "phase", "progress_pct", "message"])
    out.insert(0, "job", job)
    return out.astype({"t": float, "progress_pct": float})


def _rows(pdf: pd.DataFrame) -> list[tuple]:
    pdf = pdf.sort_values(["t", "progress_pct"], kind="stable")
    return list(zip(pdf["t"], pdf["phase"], pdf["progress_pct"], pdf["message"]))


def throttle_stream(events: DataFrame) -> DataFrame:
    """A stream of events(job, t, phase, progress_pct, message), throttled per job across micro-batches.

    Within a micro-batch events are folded by time; one that comes a batch late is folded when it comes, as a live progress
    bar would have it. Hold events back before this step where their order across batches matters.
    """
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = [r for p in parts for r in _rows(p)]
        out, after = throttle(sorted(rows, key=lambda r: r[0]), tuple(state.get) if state.exists else None)
        if after is not None:
            state.update(after)
        yield _frame(key[0], out)

    return events.groupBy("job").applyInPandasWithState(step, EVENT, STATE, "append", GroupStateTimeout.NoTimeout)


def throttle_table(events: DataFrame) -> DataFrame:
    """The same over a table."""

    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return _frame(key[0], throttle(_rows(pdf), None)[0])

    return events.groupBy("job").applyInPandas(one, EVENT)


def replay_breaker(calls: DataFrame) -> DataFrame:
    """calls(job, t, ok) -> with ``made``: false while the breaker is open, which it is for a minute from the fifth
    failure in a row on; a success closes it."""

    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("t", kind="stable")
        until, failed, made = float("-inf"), 0, []
        for t, ok in zip(pdf["t"], pdf["ok"]):
            made.append(t >= until)
            if made[-1]:
                failed = 0 if ok else failed + 1
                until = t + OPEN_SECONDS if failed >= FAILURES else float("-inf") if ok else until
        return pdf.assign(made=made)

    return calls.select("job", "t", "ok").groupBy("job").applyInPandas(one, "job string, t double, ok boolean, made boolean")


def retry_plan(statuses: list[int | None], retries: int = 3, base_s: float = 2.0) -> list[float]:
    """Waits before each further attempt: server errors and timeouts (null) are retried, anything else ends the calls."""
    waits: list[float] = []
    for n, status in enumerate(statuses[:retries]):
        if status is not None and not 500 <= status < 600:
            break
        waits.append(base_s * 2**n)
    return waits
