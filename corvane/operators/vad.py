"""Voice activity: a hysteresis over frame probabilities, independent of how the stream is cut into blocks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame

WINDOW = 512
MOST_SAMPLES = 480_000


@dataclass
class Activity:
    """State of one episode; feed window probabilities, then finish at the true end.

    Speech starts at a probability of at least `threshold`, padded backwards. Below the lower threshold
    silence runs; at `silence` samples of it the span closes, padded forwards. Between the two nothing
    changes. Spans reach `most` samples at most: there they are cut, and both the span and its continuation
    carry the mark. Spans shorter than `speech` are dropped unless they continue another.
    """

    threshold: float = 0.5
    silence: int = 1600
    speech: int = 4000
    pad: int = 480
    most: int = MOST_SAMPLES
    position: int = 0
    start: int | None = None
    quiet: int | None = None
    continued: bool = False

    def feed(self, probabilities: Iterable[float]) -> Iterator[tuple[int, int, bool]]:
        low = max(0.01, self.threshold - 0.15)
        for p in probabilities:
            if p >= self.threshold:
                self.quiet = None
                if self.start is None:
                    self.start = max(0, self.position - self.pad)
            elif p < low and self.start is not None:
                if self.quiet is None:
                    self.quiet = self.position
                if self.position + WINDOW - self.quiet >= self.silence:
                    yield from self._close(min(self.position + WINDOW, self.quiet + self.pad), False)
            self.position += WINDOW
            while self.start is not None and self.position - self.start >= self.most:
                # The silence begun before a forced cut keeps running.
                cut = self.start + self.most
                yield self.start, cut, True
                self.start, self.continued = cut, True

    def finish(self, total: int) -> Iterator[tuple[int, int, bool]]:
        if self.start is not None and self.start < total:
            end = total if self.quiet is None else min(total, self.quiet + self.pad)
            yield from self._close(end, False)
        self.start = self.quiet = None

    def _close(self, end: int, forced: bool) -> Iterator[tuple[int, int, bool]]:
        if self.continued or end - self.start >= self.speech:
            yield self.start, end, forced or self.continued
        self.start, self.quiet, self.continued = None, None, False


def spans_of(probabilities: Iterable[float], total: int | None = None, **options) -> list[tuple[int, int, bool]]:
    state = Activity(**options)
    found = list(state.feed(probabilities))
    return found + list(state.finish(state.position if total is None else total))


def segments(frames: DataFrame, **options) -> DataFrame:
    """(episode, frame, p) to spans (episode, begin, finish, cut) in samples. One episode is one task: its state is sequential."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("frame")
        found = spans_of(pdf["p"].tolist(), **options)
        return pd.DataFrame([(pdf["episode"].iloc[0], a, b, c) for a, b, c in found], columns=["episode", "begin", "finish", "cut"])

    kind = frames.schema["episode"].dataType.simpleString()
    return frames.select("episode", "frame", "p").groupBy("episode").applyInPandas(run, f"episode {kind}, begin long, finish long, cut boolean")
