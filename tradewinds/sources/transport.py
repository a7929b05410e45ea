"""HTTP GET with retries; any callable of the same shape can stand in for it."""

from __future__ import annotations

import gzip
import logging
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Mapping
from urllib.parse import urlencode

#: Statuses that are worth another try.
PASSING = (429, 500, 502, 503, 504)


class NoRecords(Exception):
    """The source says that nothing matches the request."""


def plain(body: bytes) -> str:
    """A response's text, whether or not it is compressed (by its first two bytes)."""
    return (gzip.decompress(body) if body[:2] == b"\x1f\x8b" else body).decode("utf-8-sig")


def url_of(base: str, path: str, params: Mapping[str, object] | None = None) -> str:
    """A whole URL; brackets, colons, commas and plus signs of filters stay as they are."""
    query = urlencode(dict(params or {}), safe="[]:,+*")
    return f"{base.rstrip('/')}/{path.lstrip('/')}" + (f"?{query}" if query else "")


def get(url: str, headers: Mapping[str, str] | None = None, timeout: float = 30, retries: int = 3, backoff: float = 0.5, proxy: str | None = None, sleep: Callable[[float], None] = time.sleep) -> str:
    """The text at ``url``; ``NoRecords`` for 404, the last error where retries don't help."""
    handlers = [urllib.request.ProxyHandler({"http": f"http://{proxy}", "https": f"http://{proxy}"})] if proxy else []
    opener = urllib.request.build_opener(*handlers)
    for attempt in range(retries + 1):
        try:
            with opener.open(urllib.request.Request(url, headers=dict(headers or {})), timeout=timeout) as response:
                return plain(response.read())
        except urllib.error.HTTPError as error:
            if error.code == 404:
                raise NoRecords(url) from error
            if error.code not in PASSING or attempt == retries:
                logging.getLogger(__name__).error("%s: %s %s", url, error.code, error.read()[:500])
                raise
        except (urllib.error.URLError, TimeoutError):
            if attempt == retries:
                raise
        sleep(backoff * 2**attempt)
    raise AssertionError("unreachable")
