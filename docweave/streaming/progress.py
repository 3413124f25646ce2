"""Progress of streams: what each micro-batch did, and whether a stream has stalled."""

from __future__ import annotations

import threading
import time

from pyspark.sql.streaming import StreamingQueryListener


class ProgressLog(StreamingQueryListener):
    """Keeps, by stream, the rows and seconds of its last ``keep`` batches and when it last did something.

    Add it with ``spark.streams.addListener``. A stream has stalled if it runs and has not made progress for so many seconds.
    """

    def __init__(self, keep: int = 100):
        self._keep = keep
        self._lock = threading.Lock()
        self._batches: dict[str, list[tuple[int, int, float]]] = {}
        self._seen: dict[str, float] = {}
        self._ended: set[str] = set()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self._touch(str(event.id))

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        with self._lock:
            own = self._batches.setdefault(str(p.id), [])
            own.append((p.batchId, p.numInputRows, p.batchDuration / 1000))
            del own[: -self._keep]
            self._seen[str(p.id)] = time.monotonic()

    def onQueryIdle(self, event) -> None:  # noqa: N802
        self._touch(str(event.id))

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        with self._lock:
            self._ended.add(str(event.id))

    def _touch(self, stream: str) -> None:
        with self._lock:
            self._seen[stream] = time.monotonic()

    def batches(self, stream: str) -> list[tuple[int, int, float]]:
        """(batch, rows, seconds) of a stream's last batches."""
        with self._lock:
            return list(self._batches.get(str(stream), []))

    def ended(self, stream: str) -> bool:
        with self._lock:
            return str(stream) in self._ended

    def stalled(self, seconds: float = 100.0) -> list[str]:
        """The streams that run and did nothing for so long."""
        now = time.monotonic()
        with self._lock:
            return [s for s, at in self._seen.items() if s not in self._ended and now - at > seconds]
