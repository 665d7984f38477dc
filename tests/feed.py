"""A feed without a network for tests: answers by the query parameters of the address."""

import json
from pathlib import Path
from urllib.parse import parse_qs, urlsplit


def transport(url, timeout):
    """`total` records in all; every page's first `busy` attempts are refused (attempts are counted in files below `at`)."""
    q = {k: v[0] for k, v in parse_qs(urlsplit(url).query).items()}
    total = int(q["total"])
    if q.get("format") == "count":
        return 200, {}, f" {total}\n".encode()
    first, limit = int(q["offset"]), int(q["limit"])
    if "at" in q:
        seen = Path(q["at"]) / f"page-{first}"
        tried = len(seen.read_text()) if seen.exists() else 0
        seen.write_text("x" * (tried + 1))
        if tried < int(q.get("busy", 0)):
            return 503, {"Retry-After": "0"}, b""
    return 200, {}, json.dumps(list(range(first, min(total, first + limit - 1) + 1))).encode()
