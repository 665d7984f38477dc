"""The paged feed: counts, pages, retries."""

import hashlib
import json
import sys
from pathlib import Path

import pytest

from tremora.sources import paged


@pytest.fixture(scope="module")
def feed(spark):
    spark.sparkContext.environment["PYTHONPATH"] = f"{Path(__file__).parent}:{Path(__file__).parents[1]}"
    sys.path.insert(0, str(Path(__file__).parent))
    spark.dataSource.register(paged.PagedFeed)

    def load(urls, limit, **options):
        return spark.read.format("paged_feed").options(requests=json.dumps(urls), limit=str(limit), transport="feed:transport", first_wait="0", **options).load()

    return load


def test_pages_hold_every_record_once(feed):
    rows = feed(["http://x/q?format=geojson&total=10", "http://x/q?total=3", "http://x/q?total=0"], 4).orderBy("request", "page").collect()
    by = {}
    for r in rows:
        by.setdefault(r.request, []).extend(json.loads(r.payload))
        assert r.sha256 == hashlib.sha256(r.payload.encode()).hexdigest() and (r.status, r.attempts) == (200, 1)
        assert f"offset={r.page_offset}" in r.uri and "limit=4" in r.uri and r.page_offset == 1 + 4 * r.page
    assert by == {"http://x/q?format=geojson&total=10": list(range(1, 11)), "http://x/q?total=3": [1, 2, 3]}


def test_nothing_to_read(feed):
    assert feed(["http://x/q?total=0"], 4).count() == 0 and feed([], 4).count() == 0


def test_busy_pages_are_tried_again(feed, tmp_path):
    rows = feed([f"http://x/q?total=5&busy=2&at={tmp_path}"], 2).collect()
    assert sorted(r.page for r in rows) == [0, 1, 2] and {r.attempts for r in rows} == {3}


def test_a_page_that_stays_busy_fails_the_job(feed, tmp_path):
    with pytest.raises(Exception, match="status 503 after 2 attempts"):
        feed([f"http://x/q?total=1&busy=99&at={tmp_path}"], 2, attempts="2").collect()


def answers(*replies):
    todo, waits = list(replies), []

    def transport(url, timeout):
        reply = todo.pop(0)
        if isinstance(reply, Exception):
            raise reply
        return reply

    def go(backoff, most=100):
        return paged.request(transport, "u", backoff, 1, most, waits.append)

    return go, waits


def test_waits_double_up_to_the_most_and_heed_the_server():
    go, waits = answers((500, {}, b""), OSError("reset"), (429, {"retry-after": " 7 "}, b""), (503, {"Retry-After": "9999"}, b""), (503, {"Retry-After": "soon"}, b""), (200, {}, b"ok"))
    (_, _, body), attempts = go(paged.Backoff(attempts=6, first=1, most=10))
    assert (body, attempts, waits) == (b"ok", 6, [1, 2, 7, 10, 10])


@pytest.mark.parametrize(("reply", "says"), [((404, {}, b""), "status 404 after 1"), ((302, {}, b""), "status 302 after 1"), ((200, {}, b"x" * 101), "101 bytes"), (OSError("gone"), "no answer in 1")])
def test_what_is_not_tried_again(reply, says):
    go, waits = answers(reply)
    with pytest.raises(paged.FeedError, match=says):
        go(paged.Backoff(attempts=1))
    assert waits == []


@pytest.mark.parametrize("text", [b"-1", b"x", b"", b"1.5"])
def test_a_count_is_a_number(text, monkeypatch):
    reader = paged.PagedReader({"requests": '["http://x"]'})
    monkeypatch.setattr(paged.PagedReader, "transport", lambda self: lambda url, timeout: (200, {}, text))
    with pytest.raises(paged.FeedError, match="count"):
        reader.partitions()


def test_offsets():
    assert list(paged.offsets(0, 5)) == [] and list(paged.offsets(10, 5)) == [1, 6] and list(paged.offsets(11, 5)) == [1, 6, 11]
    with pytest.raises(ValueError):
        paged.offsets(3, 0)
