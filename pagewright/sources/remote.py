"""A remote document store as a Spark sink: one request at a time, spaced, with retries, and a bearer token.

`as_documents(rows, children)` makes a document a record: its properties and its blocks in batches.
`df.write.format("remote_documents").option("url", ...).option("token", ...).mode("append").save()`
brings each document to the store: one that the store knows by its post id is updated and its blocks
replaced, any other is created, so a task that is tried again writes nothing twice. The store's limit
is the rate of its requests, so documents go through one task, as a stream of rows that is never held.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

#: status, headers, body
Reply = tuple[int, Mapping[str, str], str]
ATTEMPTS = 5
DOCUMENT = "post_id string, properties string, batches array<string>"


def plain_send(method: str, url: str, headers: dict[str, str], body: bytes | None, timeout: float) -> Reply:
    asked = urllib.request.Request(url, data=body, method=method, headers=headers)  # noqa: S310
    try:
        with urllib.request.urlopen(asked, timeout=timeout) as r:  # noqa: S310
            return r.status, dict(r.headers), r.read().decode()
    except urllib.error.HTTPError as e:
        return e.code, dict(e.headers), e.read().decode(errors="replace")


class RemoteError(RuntimeError):
    """A refusal of the store: its status, code, message and the id of the request."""


def refusal(method: str, path: str, reply: Reply) -> RemoteError:
    status, headers, body = reply
    try:
        said = json.loads(body)
    except ValueError:
        said = None
    said = said if isinstance(said, dict) else {}
    named = {k.lower(): v for k, v in headers.items()}
    request = said.get("request_id") or named.get("x-request-id", "")
    text = said.get("message") or body[:1000] or "no body"
    return RemoteError(f"HTTP {status} [{said.get('code', 'unknown_error')}] {method} {path}: {text}" + (f" (request_id={request})" if request else ""))


@dataclass
class RemoteClient:
    """Waits `spacing` seconds between requests. A full queue (429) and a failing server (5xx) are asked again, five times in all."""

    base: str
    token: str
    spacing: float = 0.38
    timeout: float = 30.0
    send_once: Callable[[str, str, dict[str, str], bytes | None, float], Reply] = plain_send
    sleep: Callable[[float], None] = time.sleep
    clock: Callable[[], float] = time.monotonic
    _last: float = field(default=-1e9, init=False)

    def __post_init__(self) -> None:
        if not self.token.strip():
            raise ValueError("the remote store needs a token")

    def request(self, method: str, path: str, body: dict | None = None) -> dict:
        headers = {"Authorization": f"Bearer {self.token}", "Content-Type": "application/json"}
        data = None if body is None else json.dumps(body, ensure_ascii=False).encode()
        for attempt in range(1, ATTEMPTS + 1):
            if (wait := self._last + self.spacing - self.clock()) > 0:
                self.sleep(wait)
            reply = self.send_once(method, self.base.rstrip("/") + path, headers, data, self.timeout)
            self._last = self.clock()
            status, answered, text = reply
            if status == 429:
                self.sleep(float({k.lower(): v for k, v in answered.items()}.get("retry-after", 2 * attempt)))
            elif status >= 500 and attempt < ATTEMPTS:
                self.sleep(2 * attempt)
            elif status >= 400:
                raise refusal(method, path, reply)
            else:
                return json.loads(text) if text else {}
        raise RemoteError(f"{method} {path} was refused {ATTEMPTS} times")

    def all_of(self, method: str, path: str, body: dict | None = None) -> Iterator[dict]:
        """The results of all pages of an answer."""
        cursor = None
        while True:
            if method == "GET":
                got = self.request(method, path + (f"?start_cursor={cursor}" if cursor else ""))
            else:
                got = self.request(method, path, (body or {}) | ({"start_cursor": cursor} if cursor else {}))
            yield from got.get("results", [])
            cursor = got.get("next_cursor")
            if not got.get("has_more") or not cursor:
                return

    def put(self, post_id: str, properties: dict, batches: list[list[dict]]) -> str:
        """Creates or updates one document; `created` or `updated`."""
        held = next(self.all_of("POST", "/documents/query", {"post_id": post_id}), None)
        if held:
            at = held["id"]
            self.request("PATCH", f"/documents/{at}", {"properties": properties})
            for block in list(self.all_of("GET", f"/documents/{at}/children")):
                self.request("DELETE", f"/blocks/{block['id']}")
        else:
            at = self.request("POST", "/documents", {"post_id": post_id, "properties": properties})["id"]
        for batch in batches:
            self.request("PATCH", f"/documents/{at}/children", {"children": batch})
        return "updated" if held else "created"


def as_documents(rows: DataFrame, children: DataFrame) -> DataFrame:
    """post_id, properties and batches as JSON of rows of the target and their child blocks (child_blocks()), in order."""
    block = F.struct("pos", "kind", "texts", "link")
    by_batch = children.groupBy("post_id", "batch").agg(F.array_sort(F.collect_list(block)).alias("blocks"))  # of a batch's fixed size
    text = F.to_json(F.transform("blocks", lambda b: F.struct(b.kind.alias("kind"), b.texts.alias("texts"), b.link.alias("link"))))
    every = by_batch.groupBy("post_id").agg(F.array_sort(F.collect_list(F.struct("batch", text.alias("json")))).alias("b"))
    named = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})
    got = rows.select("post_id", named.alias("properties")).join(every, "post_id", "left")
    return got.select("post_id", "properties", F.coalesce(F.transform("b", lambda x: x.json), F.array().cast("array<string>")).alias("batches"))


@dataclass
class Written(WriterCommitMessage):
    created: int
    updated: int


class RemoteWriter(DataSourceWriter):
    def __init__(self, options) -> None:
        self.url, self.token = options.get("url", ""), options.get("token", "")
        self.spacing = float(options.get("spacing", 0.38))
        RemoteClient(self.url, self.token)  # a token that lacks is an error before anything is sent

    def write(self, iterator) -> Written:
        client, n = RemoteClient(self.url, self.token, self.spacing), {"created": 0, "updated": 0}
        for row in iterator:
            n[client.put(row.post_id, json.loads(row.properties), [json.loads(b) for b in row.batches])] += 1
        return Written(**n)


class RemoteDocuments(DataSource):
    @classmethod
    def name(cls) -> str:
        return "remote_documents"

    def schema(self) -> str:
        return DOCUMENT

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return RemoteWriter(self.options)


def write(documents: DataFrame, url: str, token: str, spacing: float = 0.38) -> None:
    """Sends documents (as_documents()) to the store at url, in one task."""
    from pagewright.functions.ship import ship

    ship(documents.sparkSession)
    documents.sparkSession.dataSource.register(RemoteDocuments)
    out = documents.repartition(1).write.format("remote_documents").option("url", url).option("token", token)
    out.option("spacing", spacing).mode("append").save()
