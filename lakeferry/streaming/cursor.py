"""A forward-only cursor over a finite result, as a remote stream would be read; not Structured Streaming."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame

from ..settings import settings

#: Rows of a chunk at most.
CHUNK = 2048


class Cursor:
    """Reads df in chunks, one partition at a time on the driver; cancel(), close() or `timeout` seconds (0: none; query_timeout where not given) stop its jobs."""

    def __init__(self, df: DataFrame, chunk: int = CHUNK, timeout: float | None = None):
        self.df, self.chunk, self.tag, self.done, self.timeout = df, chunk, f"cursor-{uuid.uuid4().hex}", False, settings["query_timeout"] if timeout is None else timeout

    def __iter__(self) -> Iterator[list]:
        spark = self.df.sparkSession
        spark.sparkContext.addJobTag(self.tag)
        timer = threading.Timer(self.timeout, self.cancel) if self.timeout else None
        if timer:
            timer.start()
        try:
            held = []
            for row in self.df.toLocalIterator(prefetchPartitions=True):
                if self.done:
                    return
                held.append(row)
                if len(held) == self.chunk:
                    yield held
                    held = []
            if held and not self.done:
                yield held
        finally:
            if timer:
                timer.cancel()
            spark.sparkContext.removeJobTag(self.tag)

    def cancel(self) -> None:
        self.done = True
        self.df.sparkSession.sparkContext.cancelJobsWithTag(self.tag)

    def close(self) -> None:
        self.cancel()

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.close()
