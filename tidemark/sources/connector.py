"""A paged remote source, as rows: cursors are followed with guards, and pages are kept before the next is asked for.

The transport is a plain function, so a source can be a service, a folder or a test. A plan's requests are independent
of each other: they are dealt over the executors, each reading its own pages in order.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame

#: Answers after which the same page may be asked for again.
RETRYABLE = frozenset({408, 425, 429, 500, 502, 503, 504})
PAGES = "request_id string, page_sequence int, url string, body string, sha256 string, is_last boolean"

#: url -> (status, body, wait in seconds that the answer asks for, or None)
Transport = Callable[[str], tuple[int, str, float | None]]


class SourceError(RuntimeError):
    """A remote source that can't be read on."""


@dataclass(frozen=True)
class PagedSource:
    fetch: Transport
    next_field: str = "next_url"
    attempts: int = 5
    pause: float = 0.5
    least_interval: float = 0.0
    sleep: Callable[[float], None] = time.sleep

    def pages(self, url: str, start_sequence: int = 0) -> Iterator[tuple[int, str, str, bool]]:
        """(sequence, url, body, is_last) from url on: give the next cursor of a kept page to resume behind it."""
        origin, seen, k = urlsplit(url)[:2], set(), start_sequence
        while url:
            if urlsplit(url)[:2] != origin:
                raise SourceError("a cursor leads to another origin")
            if url in seen:
                raise SourceError("a cursor repeats")
            seen.add(url)
            body = self.read(url)
            after = json.loads(body).get(self.next_field)
            yield k, url, body, not after
            url, k = after, k + 1
            if url and self.least_interval:
                self.sleep(self.least_interval)

    def read(self, url: str) -> str:
        for n in range(self.attempts):
            status, body, wait = self.fetch(url)
            if status == 200:
                return body
            if status not in RETRYABLE or n == self.attempts - 1:
                raise SourceError(f"status {status}")
            self.sleep(self.pause * 2**n if wait is None else wait)
        raise SourceError("no attempts")

    def rows(self, plan: DataFrame, parallel: int) -> DataFrame:
        """PAGES of a plan (request_id, url); at most `parallel` requests are read at once."""
        source = self

        def run(frames):
            for frame in frames:
                for request, url in frame[["request_id", "url"]].itertuples(index=False):
                    for k, at, body, last in source.pages(url):
                        yield pd.DataFrame([[request, k, at, body, hashlib.sha256(body.encode()).hexdigest(), last]], columns=[c.split()[0] for c in PAGES.split(", ")])

        return plan.select("request_id", "url").repartition(parallel, "request_id").mapInPandas(run, PAGES)


def mock(url: str) -> tuple[int, str, float | None]:
    """A transport that answers every request with one empty page."""
    return 200, json.dumps({"results": [], "status": "OK"}), None


def keep_pages(source: PagedSource, request_id: str, url: str, load: Callable[[str], str | None], save: Callable[[str, str], None]) -> int:
    """Keeps a request's pages one by one, then its checkpoint, then asks for the next; a second run resumes. Pages kept."""
    mark = json.loads(load(f"{request_id}/checkpoint.json") or "{}")
    if mark.get("done"):
        return mark["pages"]
    kept = mark.get("pages", 0)
    for k, _, body, last in source.pages(mark.get("next", url), kept):
        save(f"{request_id}/{k:06d}.json", body)
        kept = k + 1
        save(f"{request_id}/checkpoint.json", json.dumps({"pages": kept, "next": json.loads(body).get(source.next_field), "done": last}))
    return kept
