"""Delivery with retries, on the executors."""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame


class DeliveryError(RuntimeError):
    """All attempts failed: the task fails, and with it the query."""


@dataclass(frozen=True)
class Retry:
    """Exponential waits with jitter, until the time in all is used up."""

    first_s: float = 1.5
    factor: float = 1.2
    jitter: float = 0.5
    most_s: float = 5.0
    total_s: float = 300.0
    sleep: Callable[[float], None] = time.sleep

    def waits(self) -> Iterator[float]:
        wait, spent = self.first_s, 0.0
        while spent < self.total_s:
            now = wait * random.uniform(1 - self.jitter, 1 + self.jitter)
            spent += now
            yield now
            wait = min(wait * self.factor, self.most_s)

    def call(self, f: Callable[[], object]) -> tuple[object, int]:
        """What f returns, and how many calls it took."""
        error, n = None, 1
        waits = self.waits()
        while True:
            try:
                return f(), n
            except Exception as e:  # noqa: BLE001 - any failure of a client is tried again
                error = e
            wait = next(waits, None)
            if wait is None:
                raise DeliveryError(f"given up after {n} attempts: {error}") from error
            self.sleep(wait)
            n += 1


def deliver(batches: DataFrame, send: Callable, retry: Retry, keys: list[str]) -> DataFrame:
    """Calls send(row) for every batch and reports keys, written (what send returns) and attempts."""
    kinds = {f.name: f.dataType.simpleString() for f in batches.schema}

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row in frame.to_dict("records"):
                written, attempts = retry.call(lambda row=row: send(row))
                out.append([*(row[k] for k in keys), written, attempts])
            yield pd.DataFrame(out, columns=[*keys, "written", "attempts"])

    return batches.mapInPandas(run, ", ".join(f"{k} {kinds[k]}" for k in keys) + ", written long, attempts int")
