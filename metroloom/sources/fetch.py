"""Fetching datasets over HTTP, on the driver, with a fingerprinted cache."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable
from dataclasses import asdict, dataclass
from datetime import UTC, datetime
from pathlib import Path

ATTEMPTS, BACKOFF_S, TIMEOUT_S = 6, 2.0, 240.0


class QueryError(RuntimeError):
    """The service answered, but not with data: trying again does not help."""


@dataclass
class Meta:
    query: str
    endpoint: str
    fetchedAt: str  # noqa: N815  the stored field's name
    osmTimestamp: str | None  # noqa: N815
    counts: dict[str, int]


def counts(document: dict) -> dict[str, int]:
    kinds = [e.get("type") for e in document["elements"]]
    return {f"{t}s": kinds.count(t) for t in ("node", "way", "relation")}


def request_once(endpoint: str, query: str, timeout: float = TIMEOUT_S) -> dict:
    """One POST (S1)."""
    body = urllib.parse.urlencode({"data": query}).encode()
    try:
        with urllib.request.urlopen(urllib.request.Request(endpoint, body), timeout=timeout) as r:  # noqa: S310
            text = r.read().decode()
    except urllib.error.HTTPError as e:
        raise ConnectionError(f"{e.code}: {e.read().decode(errors='replace')[:300]}") from e
    try:
        document = json.loads(text)
    except ValueError as e:
        raise QueryError(f"not JSON: {text[:300]}") from e
    if not isinstance(document.get("elements"), list):
        raise QueryError("no elements in the answer")
    return document


def run_query(query: str, endpoints: list[str], post: Callable[[str, str], dict] = request_once, sleep: Callable[[float], None] = time.sleep) -> tuple[dict, str]:
    """Up to ATTEMPTS tries over the mirrors in turn, waiting twice as long after each."""
    last: Exception | None = None
    for n in range(ATTEMPTS):
        endpoint = endpoints[n % len(endpoints)]
        try:
            return post(endpoint, query), endpoint
        except QueryError:
            raise
        except OSError as e:
            last = e
            if n + 1 < ATTEMPTS:
                sleep(BACKOFF_S * 2**n)
    raise ConnectionError(f"no mirror answered: {last}") from last


def read_cached(folder: Path, name: str) -> tuple[dict, Meta] | None:
    """Data and meta, only if both are there (S3)."""
    data, meta = folder / f"{name}.json", folder / f"{name}.meta.json"
    if not (data.exists() and meta.exists()):
        return None
    return json.loads(data.read_text()), Meta(**json.loads(meta.read_text()))


def fetch_dataset(folder: Path, name: str, query: str, endpoints: list[str], refresh: bool = False, **how) -> tuple[dict, bool]:
    """The document, and whether it came from the cache: it does if the trimmed query is the stored one."""
    held = read_cached(folder, name)
    if held and not refresh and held[1].query.strip() == query.strip():
        return held[0], True
    document, endpoint = run_query(query, endpoints, **how)
    meta = Meta(query, endpoint, datetime.now(UTC).isoformat(), (document.get("osm3s") or {}).get("timestamp_osm_base"), counts(document))
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{name}.json").write_text(json.dumps(document))
    (folder / f"{name}.meta.json").write_text(json.dumps(asdict(meta), indent=2))
    return document, False


def fetch_all(folder: Path, queries: dict[str, str], endpoints: list[str], only: str | None = None, refresh: bool = False, **how) -> dict[str, Exception]:
    """Datasets one after another; failures by name, raised by nobody."""
    failed: dict[str, Exception] = {}
    for name, query in queries.items():
        if only in (None, name):
            try:
                fetch_dataset(folder, name, query, endpoints, refresh, **how)
            except (OSError, QueryError) as e:
                failed[name] = e
    return failed
