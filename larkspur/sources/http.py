"""Live sources: a paged REST listing as a Python data source, and keyed fetches that run once a missing key.

Fetching is given in as a function of a URL, so tests and captured responses need no network. Retries: only 429, 5xx and
network errors, exponential with a cap; 404 is no row; 401 ends the run.
"""

from __future__ import annotations

import hashlib
import importlib
import json
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

Fetch = Callable[[str], tuple[int, str, dict]]


def get_url(url: str) -> tuple[int, str, dict]:
    """(status, body, headers) by the standard library."""
    import urllib.error
    import urllib.request

    try:
        with urllib.request.urlopen(url, timeout=30) as r:  # noqa: S310
            return r.status, r.read().decode(), dict(r.headers)
    except urllib.error.HTTPError as e:
        return e.code, "", dict(e.headers or {})


def with_retries(fetch: Fetch, url: str, retries: int = 5, cap: float = 30.0, sleep: Callable[[float], None] = time.sleep) -> str | None:
    """The body; None for 404. Retry-After is honoured up to the cap."""
    for attempt in range(retries + 1):
        try:
            status, body, headers = fetch(url)
        except OSError:
            status, body, headers = 599, "", {}
        if status == 200:
            return body
        if status == 404:
            return None
        if status == 401:
            raise PermissionError(f"401 for {url}")
        if status != 429 and status < 500:
            raise RuntimeError(f"{status} for {url}")
        if attempt < retries:
            wait = headers.get("Retry-After", "")
            sleep(min(cap, float(wait) if wait.replace(".", "", 1).isdigit() else 2.0**attempt))
    raise RuntimeError(f"no answer from {url} after {retries + 1} attempts")


def load(name: str) -> Fetch:
    """A fetch function named `module:function`; executors import it."""
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


class PagedRest(DataSource):
    """format("paged_rest"): page int, pos int, item string. Options: url with {page} or {cursor}, fetch, items, page_size,
    max_pages, cursor (path of the next cursor, as pagination.nextCursor), more (path of a flag that more pages follow),
    total (path of the number of all items), select (columns, appended to the url).

    A listing by cursor ends without a further one, where the flag says no, at a cursor met before, and at max_pages; one by
    pages at an empty or short page, or once it has `total` items.

    As a stream a batch takes up to `pages_per_batch` pages of each listing, and the offset is where each one stands. Pages are
    fetched once each, `fetchers` listings at a time, into the folder `spool` that driver and executors share, where the
    tasks read them; a batch that is run again reads them there, and its commit deletes them. A listing that has ended is
    not asked again. Ids are not compared between pages: use dropDuplicates.
    """

    @classmethod
    def name(cls) -> str:
        return "paged_rest"

    def schema(self) -> str:
        return "page int, pos int, item string"

    def reader(self, schema: object) -> DataSourceReader:
        return _PagedReader(dict(self.options))

    def streamReader(self, schema: object) -> DataSourceStreamReader:
        return _PagedStream(dict(self.options))


def _at(payload: object, path: str | None) -> object:
    """The value at a path of member names; None if any is missing."""
    for name in (path or "").split("."):
        payload = payload.get(name) if isinstance(payload, dict) else None
    return payload


class _PagedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(x) for x in self.options["url"].split(" ")]  # one listing each

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        o = self.options
        fetch = load(o.get("fetch", "larkspur.sources.http:get_url"))
        size, most, cursor = int(o.get("page_size", 100)), int(o.get("max_pages", 200)), ""
        seen: set[str] = set()
        cursors, got = {cursor}, 0
        listing = partition.value
        if o.get("select"):
            listing += ("&" if "?" in listing else "?") + "select=" + o["select"]
        for page in range(1, most + 1):
            body = with_retries(fetch, listing.replace("{page}", str(page)).replace("{cursor}", cursor))
            payload = json.loads(body) if body else None
            rows = _rows(payload, o)
            got += len(rows)
            for pos, item in enumerate(rows):
                key = str(item.get(o.get("id", "id")) or "") if isinstance(item, dict) else ""
                if key and key in seen:
                    continue
                seen.add(key)
                yield page, pos, json.dumps(item, ensure_ascii=False)
            if o.get("cursor"):
                cursor = str(_at(payload, o["cursor"]) or "")
                if cursor in cursors or (o.get("more") and not _at(payload, o["more"])):
                    return
                cursors.add(cursor)
            elif not rows or len(rows) < size or (o.get("total") and isinstance(total := _at(payload, o["total"]), int) and got >= total):
                return


def _short(text: str) -> str:
    return hashlib.md5(text.encode()).hexdigest()[:16]


class _Page(InputPartition):
    def __init__(self, listing: str, page: int):
        self.listing, self.page = listing, page


class _PagedStream(DataSourceStreamReader):
    """Offsets: for each listing the page it has come to, the next cursor, items so far, the cursors met (hashed), whether it ended."""

    def __init__(self, options: dict):
        if not options.get("spool"):
            raise ValueError("a stream of pages needs the option spool: a folder that the driver and all executors share")
        self.options, self.listings = options, options["url"].split(" ")
        self.at: dict | None = None

    def initialOffset(self) -> dict:
        return {x: {"page": 0, "cursor": "", "got": 0, "met": _short(""), "done": False} for x in self.listings}

    def latestOffset(self) -> dict:
        if self.at is None:
            self.at = self.initialOffset()
        # a listing that was added to the options of a running query starts at its first page
        before = self.initialOffset() | self.at
        with ThreadPoolExecutor(int(self.options.get("fetchers", 8))) as pool:
            self.at = before | dict(zip(self.listings, pool.map(self._advance, self.listings, [before[x] for x in self.listings]), strict=True))
        return self.at

    def _advance(self, listing: str, before: dict) -> dict:
        o, now = self.options, dict(before)
        for _ in range(int(o.get("pages_per_batch", 10))):
            if now["done"] or now["page"] >= int(o.get("max_pages", 200)):
                break
            page = now["page"] + 1
            body = self._spooled(listing, page, now["cursor"])
            payload = json.loads(body) if body else None
            rows = _rows(payload, o)
            now |= {"page": page, "got": now["got"] + len(rows)}
            if o.get("cursor"):
                now["cursor"] = str(_at(payload, o["cursor"]) or "")
                met = now["met"].split(",")
                now["done"] = _short(now["cursor"]) in met or bool(o.get("more") and not _at(payload, o["more"]))
                now["met"] = ",".join([*met, _short(now["cursor"])])  # at most max_pages of them
            else:
                total = _at(payload, o["total"]) if o.get("total") else None
                now["done"] = len(rows) < int(o.get("page_size", 100)) or (isinstance(total, int) and now["got"] >= total)
        return now

    def _file(self, listing: str, page: int) -> tuple[fs.FileSystem, str]:
        where, folder = fs.FileSystem.from_uri(self.options["spool"])
        return where, f"{folder.rstrip('/')}/{_short(listing)}/{page:08d}.json"

    def _spooled(self, listing: str, page: int, cursor: str) -> str:
        """The page's body, from the spool if a run before has fetched it; put there by a rename, so whole or not at all."""
        where, file = self._file(listing, page)
        if where.get_file_info(file).type == fs.FileType.File:
            return _read(where, file)
        o = self.options
        url = listing + (("&" if "?" in listing else "?") + "select=" + o["select"] if o.get("select") else "")
        body = with_retries(load(o.get("fetch", "larkspur.sources.http:get_url")), url.replace("{page}", str(page)).replace("{cursor}", cursor)) or ""
        where.create_dir(file.rsplit("/", 1)[0], recursive=True)
        part = f"{file}.{uuid.uuid4().hex}"
        with where.open_output_stream(part) as out:
            out.write(body.encode())
        where.move(part, file)
        return body

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        if self.at is None:  # a query that starts again plans its last batch first
            self.at = end
        first = lambda x: start.get(x, {}).get("page", 0)
        return [_Page(x, n) for x in end for n in range(first(x) + 1, end[x]["page"] + 1)]

    def read(self, partition: _Page) -> Iterator[tuple]:
        body = _read(*self._file(partition.listing, partition.page))
        for pos, item in enumerate(_rows(json.loads(body) if body else None, self.options)):
            yield partition.page, pos, json.dumps(item, ensure_ascii=False)

    def commit(self, end: dict) -> None:
        for listing, now in end.items():
            where, file = self._file(listing, 0)
            for info in where.get_file_info(fs.FileSelector(file.rsplit("/", 1)[0], allow_not_found=True)):
                if info.base_name.endswith(".json") and int(info.base_name[:-5]) <= now["page"]:
                    where.delete_file(info.path)


def _read(where: fs.FileSystem, file: str) -> str:
    with where.open_input_stream(file) as f:
        return f.read().decode()


def _rows(payload: object, options: dict) -> list:
    rows = _at(payload, options["items"]) if options.get("items") and isinstance(payload, dict) else payload
    return rows if isinstance(rows, list) else []


def fetch_missing(wanted: DataFrame, cached: DataFrame, key: str, url: str, fetch: str = "larkspur.sources.http:get_url", partitions: int = 12) -> DataFrame:
    """key, body for wanted keys that the cache lacks, each fetched once; a key not found gives no row."""
    missing = wanted.select(key).distinct().join(cached.select(key), key, "left_anti").repartition(partitions, key)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        get = load(fetch)
        for pdf in frames:
            bodies = [with_retries(get, url.replace("{key}", str(k))) for k in pdf[key]]
            yield pd.DataFrame({key: pdf[key], "body": bodies}).dropna(subset=["body"])

    return missing.mapInPandas(run, f"{key} string, body string")
