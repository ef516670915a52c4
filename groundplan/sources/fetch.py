"""Polite fetching of pages: robots rules, a pause between requests to one host, retries. The transport is the caller's.

`get(url)` gives (status, headers, body) or raises; with it the engine stays free of network code and can be tested without
any. A host is one task's, so that its pages are fetched one after the other whatever the number of executors; hosts run
side by side. A lost task starts its hosts anew.
"""

from __future__ import annotations

import gzip
import re
import time
from collections.abc import Callable, Iterator
from urllib.parse import urlsplit
from urllib.robotparser import RobotFileParser

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

Get = Callable[[str], tuple[int, dict[str, str], bytes]]
#: Answers that ask for patience.
BUSY = (403, 429, 503)


class Fetcher:
    """Fetches the pages of one task; clock and pause are parameters for tests."""

    def __init__(self, get: Get, agent: str = "groundplan", delay: float = 1.0, tries: int = 3, pause: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.monotonic):
        self.get, self.agent, self.delay, self.tries, self.pause, self.clock = get, agent, delay, tries, pause, clock
        self.rules: dict[str, RobotFileParser] = {}
        self.last: dict[str, float] = {}

    def allowed(self, url: str) -> bool:
        """Whether the host's robots.txt lets the agent in; a host without one, or whose can't be read, does."""
        at = urlsplit(url)
        host = f"{at.scheme}://{at.netloc}"
        if host not in self.rules:
            rules = RobotFileParser()
            try:
                status, headers, body = self.get(f"{host}/robots.txt")
                rules.parse(text_of(headers, body).splitlines() if status == 200 else [])
            except Exception:  # the transport's own kinds of failure
                rules.parse([])
            self.rules[host] = rules
        return self.rules[host].can_fetch(self.agent, url)

    def _wait(self, host: str) -> None:
        left = self.last.get(host, -self.delay) + self.delay - self.clock()
        if host in self.last and left > 0:
            self.pause(left)
        self.last[host] = self.clock()

    def fetch(self, url: str) -> tuple[str | None, int | None, int]:
        """Text (None: not allowed or failed), last status, and requests made."""
        if not self.allowed(url):
            return None, None, 0
        status = None
        for turn in range(1, self.tries + 1):
            self._wait(urlsplit(url).netloc)
            try:
                status, headers, body = self.get(url)
                text = text_of(headers, body) if status < 400 else None
            except Exception:  # the transport's own kinds of failure, and bodies that are cut short
                status = None
                if turn < self.tries:
                    self.pause(2.0**turn)
                continue
            if status < 400:
                return text, status, turn
            if status not in BUSY:
                break
            if turn < self.tries:
                self.pause(10.0 * turn)
        return None, status, turn


def text_of(headers: dict[str, str], body: bytes) -> str:
    """A body as text: gzip undone, in the charset that the headers name, else UTF-8; what can't be read is replaced."""
    if body[:2] == b"\x1f\x8b":
        body = gzip.decompress(body)
    kind = next((v for k, v in headers.items() if k.lower() == "content-type"), "")
    found = re.search(r"charset=[\"']?([\w.:-]+)", kind, re.I)
    try:
        return body.decode(found[1] if found else "utf-8", "replace")
    except (LookupError, UnicodeError):
        return body.decode("utf-8", "replace")


def fetch(urls: DataFrame, get: Get, url: str = "url", **how) -> DataFrame:
    """url, html, status, requests of each distinct URL; html is null where it isn't allowed or failed. Null URLs drop out."""
    host = F.regexp_extract(F.col(url), "^[a-zA-Z]+://([^/?#]+)", 1)
    dealt = urls.select(F.col(url).alias("url"), host.alias("host")).filter("url is not null").distinct().repartition("host").sortWithinPartitions("host", "url").select("url")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fetcher = Fetcher(get, **how)
        for batch in it:
            for u in batch.column("url").to_pylist():
                html, status, n = fetcher.fetch(u)
                yield pa.RecordBatch.from_arrays([pa.array([u]), pa.array([html], pa.string()), pa.array([status], pa.int32()), pa.array([n], pa.int32())], names=["url", "html", "status", "requests"])

    return dealt.mapInArrow(run, "url string, html string, status int, requests int")
