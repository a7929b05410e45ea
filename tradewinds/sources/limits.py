"""Request quotas over sliding windows."""

from __future__ import annotations

import math
import threading
import time
from collections import deque
from collections.abc import Callable, Mapping, Sequence

SECONDS = {"seconds": 1, "minutes": 60, "hours": 3600, "days": 86400, "weeks": 604800}


class Quota:
    """Several limits at once, each ``(requests, seconds)``; a request counts against all of them.

    ``lanes`` tasks that share the limits without talking to each other get an equal part each: fewer
    requests in a window or, where a limit has fewer requests than there are lanes, one in a longer window.
    """

    def __init__(self, limits: Sequence[tuple[int, float]], lanes: int = 1, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        if not limits or any(n < 1 or s <= 0 for n, s in limits) or lanes < 1:
            raise ValueError(f"a quota needs positive limits and lanes, not {list(limits)} and {lanes}")
        self.limits = [(n // lanes, s) if n >= lanes else (1, s * math.ceil(lanes / n)) for n, s in limits]
        self._taken: deque[float] = deque()
        self._lock, self._clock, self._sleep = threading.Lock(), clock, sleep
        self._longest = max(s for _, s in self.limits)

    @classmethod
    def of(cls, spec: Mapping | Sequence[Mapping], **options) -> Quota:
        """From ``{"requests": n, "unit": "minutes", "count": k}`` or a list of such."""
        specs = [spec] if isinstance(spec, Mapping) else list(spec)
        unknown = {s["unit"] for s in specs} - set(SECONDS)
        if unknown:
            raise ValueError(f"unknown units {sorted(unknown)}; there are {list(SECONDS)}")
        return cls([(int(s["requests"]), SECONDS[s["unit"]] * s.get("count", 1)) for s in specs], **options)

    def _used(self, now: float) -> list[int]:
        while self._taken and self._taken[0] <= now - self._longest:
            self._taken.popleft()
        return [sum(t > now - s for t in self._taken) for _, s in self.limits]

    def remaining(self) -> int:
        """Requests that may start at once."""
        with self._lock:
            return min(n - used for (n, _), used in zip(self.limits, self._used(self._clock()), strict=True))

    def reset(self) -> None:
        with self._lock:
            self._taken.clear()

    def acquire(self) -> None:
        """Waits until every limit has room, then counts one request."""
        while True:
            with self._lock:
                now = self._clock()
                waits = [self._taken[-n] + s - now for (n, s), used in zip(self.limits, self._used(now), strict=True) if used >= n]
                if not waits:
                    self._taken.append(now)
                    return
            self._sleep(max(waits))
