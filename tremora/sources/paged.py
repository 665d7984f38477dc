"""A paged HTTP feed as a Spark data source: counts first, then a partition a page, each with its own retries.

    spark.dataSource.register(PagedFeed)
    spark.read.format("paged_feed").option("requests", json.dumps([url, ...])).option("limit", 20000).load()

Rows are pages as they came: (request, page, page_offset, uri, status, attempts, sha256, payload). The driver asks each
request's count (the same address with format=count) and knows all pages by then; bodies are read by the executors only,
and a lost executor's pages are read again. A transport is a function (url, timeout in seconds) -> (status, headers,
body), named as module:function; without one, urllib's. A feed that grows between count and pages is cut at the count, as
the next run's overlap sees the rest.
"""

from __future__ import annotations

import hashlib
import importlib
import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from urllib.parse import parse_qsl, urlencode, urlsplit, urlunsplit

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

Response = tuple[int, Mapping[str, str], bytes]
Transport = Callable[[str, float], Response]
SCHEMA = "request string, page int, page_offset long, uri string, status int, attempts int, sha256 string, payload string"


class FeedError(RuntimeError):
    """A request that failed for good, with its status (0: no answer) and the number of attempts."""


@dataclass(frozen=True)
class Backoff:
    """Waits double from `first` to `most` seconds; a server's Retry-After in seconds takes their place, up to `most`."""

    attempts: int = 4
    first: float = 1.0
    most: float = 60.0

    def wait(self, attempt: int, headers: Mapping[str, str]) -> float:
        said = next((v for k, v in headers.items() if k.lower() == "retry-after"), "").strip()
        if said.isascii() and said.isdigit():
            return min(self.most, float(said))
        return min(self.most, self.first * 2.0 ** min(attempt - 1, 60))


def retryable(status: int) -> bool:
    return status == 429 or 500 <= status < 600


def urllib_transport(url: str, timeout: float) -> Response:
    try:
        with urllib.request.urlopen(url, timeout=timeout) as r:  # noqa: S310  the caller names the scheme
            return r.status, dict(r.headers), r.read()
    except urllib.error.HTTPError as e:
        return e.code, dict(e.headers or {}), b""


def request(transport: Transport, url: str, backoff: Backoff, timeout: float, most_bytes: int, sleep: Callable[[float], None] = time.sleep) -> tuple[Response, int]:
    """The answer and the number of attempts. Network errors and retryable answers are tried again; a body that is too long is an error at once."""
    for attempt in range(1, backoff.attempts + 1):
        last = attempt == backoff.attempts
        try:
            status, headers, body = transport(url, timeout)
        except OSError as e:
            if last:
                raise FeedError(f"{url}: no answer in {attempt} attempts: {e}") from e
            sleep(backoff.wait(attempt, {}))
            continue
        if 200 <= status < 300:
            if len(body) > most_bytes:
                raise FeedError(f"{url}: {len(body)} bytes, more than {most_bytes}")
            return (status, headers, body), attempt
        if last or not retryable(status):
            raise FeedError(f"{url}: status {status} after {attempt} attempts")
        sleep(backoff.wait(attempt, headers))
    raise ValueError("a backoff has at least one attempt")


def with_query(url: str, **values: object) -> str:
    """The address with query parameters set, others as they are."""
    parts = urlsplit(url)
    kept = [(k, v) for k, v in parse_qsl(parts.query, keep_blank_values=True) if k not in values]
    return urlunsplit(parts._replace(query=urlencode(kept + [(k, str(v)) for k, v in values.items()])))


def offsets(total: int, limit: int) -> range:
    """First records of the pages, from 1."""
    if limit < 1:
        raise ValueError("a page has at least one record")
    return range(1, total + 1, limit)


@dataclass
class Page(InputPartition):
    request: str
    page: int
    offset: int
    uri: str


class PagedReader(DataSourceReader):
    def __init__(self, options: Mapping[str, str]):
        self.requests: list[str] = json.loads(options["requests"])
        self.limit = int(options.get("limit", "20000"))
        self.backoff = Backoff(int(options.get("attempts", "4")), float(options.get("first_wait", "1")), float(options.get("most_wait", "60")))
        self.timeout, self.most_bytes = float(options.get("timeout", "60")), int(options.get("most_bytes", str(64 << 20)))
        self.transport_name = options.get("transport")

    def transport(self) -> Transport:
        if not self.transport_name:
            return urllib_transport
        module, _, name = self.transport_name.partition(":")
        return getattr(importlib.import_module(module), name)

    def count(self, url: str) -> int:
        (_, _, body), _ = request(self.transport(), with_query(url, format="count"), self.backoff, self.timeout, self.most_bytes)
        text = body.decode("utf-8", "replace").strip()
        if not (text.isascii() and text.isdigit()):
            raise FeedError(f"{url}: the count is no non-negative integer")
        return int(text)

    def partitions(self) -> list[Page]:
        return [Page(url, n, first, with_query(url, limit=self.limit, offset=first)) for url in self.requests for n, first in enumerate(offsets(self.count(url), self.limit))]

    def read(self, partition: Page) -> Iterator[tuple]:
        if not isinstance(partition, Page):  # no page at all: Spark reads one empty partition
            return
        (status, _, body), attempts = request(self.transport(), partition.uri, self.backoff, self.timeout, self.most_bytes)
        yield partition.request, partition.page, partition.offset, partition.uri, status, attempts, hashlib.sha256(body).hexdigest(), body.decode("utf-8")


class PagedFeed(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged_feed"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: object) -> PagedReader:
        return PagedReader(self.options)
