"""Remote folders over HTTP: a paged JSON listing as a data source, and files by their id.

The listing is asked for as ``GET <base>/files?parent=<id>&pageToken=<token>`` and answered by ``{"files": [{"id", "name", "mimeType"}, ...],
"nextPageToken"}``, the form of public file-listing services; a file's bytes are at ``GET <base>/files/<id>?alt=media``. The folders of the top
level are partitions of their own, as are the pages of the top level itself, so that a large tree is listed by many tasks;
a page that fails is asked for again from its token.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

FOLDER = "folder"
TRIES, WAIT, TIMEOUT = 4, 0.5, 60.0


def _get(url: str, token: str = "", tries: int = TRIES, wait: float = WAIT) -> bytes:
    """What a URL gives; asked again after failures of the server or the line, not where it says that there is no such thing."""
    if not url.startswith(("http://", "https://")):
        raise ValueError(f"{url} is not a remote folder: http or https is asked for")
    request = urllib.request.Request(url, headers={"Authorization": f"Bearer {token}"} if token else {})
    for turn in range(tries):
        try:
            with urllib.request.urlopen(request, timeout=TIMEOUT) as answer:
                return answer.read()
        except urllib.error.HTTPError as e:
            if e.code < 500 and e.code != 429 or turn == tries - 1:
                raise OSError(f"{url.split('?')[0]}: {e.code} {e.reason}") from e
        except (urllib.error.URLError, TimeoutError, ConnectionError) as e:
            if turn == tries - 1:
                raise OSError(f"{url.split('?')[0]}: {e}") from e
        time.sleep(wait * 2**turn)
    raise AssertionError


@dataclass(frozen=True)
class Remote:
    base: str
    token: str = ""

    def page(self, parent: str, page: str = "") -> tuple[list[dict], str]:
        """(files, token of the next page, empty at the end) of a folder."""
        query = urllib.parse.urlencode({"parent": parent, **({"pageToken": page} if page else {})})
        answer = _get(f"{self.base.rstrip('/')}/files?{query}", self.token)
        try:
            found = json.loads(answer)
            return found["files"], found.get("nextPageToken") or ""
        except (ValueError, KeyError, TypeError) as e:
            raise OSError(f"{self.base} doesn't answer with a listing: {e}") from e

    def pages(self, parent: str) -> Iterator[list[dict]]:
        token = ""
        while True:
            files, token = self.page(parent, token)
            yield files
            if not token:
                return

    def tree(self, parent: str, path: str) -> Iterator[tuple[str, str, str, str]]:
        """(id, path, name, mime) of all below a folder; a folder that is met again on the way to itself isn't entered twice."""
        left, seen = [(parent, path)], {parent}
        while left:
            folder, at = left.pop()
            for files in self.pages(folder):
                for f in files:
                    mime = f.get("mimeType") or ""
                    yield f["id"], f"{at}{f['name']}", f["name"], mime
                    if FOLDER in mime and f["id"] not in seen:
                        seen.add(f["id"])
                        left.append((f["id"], f"{at}{f['name']}/"))


@dataclass
class _Part(InputPartition):
    """A page of the top level, listed already (rows), or a folder of it."""

    rows: tuple = ()
    folder: str = ""
    path: str = ""


class _Reader(DataSourceReader):
    def __init__(self, remote: Remote, folder: str):
        self.remote, self.folder = remote, folder

    def partitions(self) -> list[_Part]:
        parts: list[_Part] = []
        for files in self.remote.pages(self.folder):
            parts.append(_Part(rows=tuple((f["id"], f["name"], f["name"], f.get("mimeType") or "") for f in files)))
            parts += [_Part(folder=f["id"], path=f"{f['name']}/") for f in files if FOLDER in (f.get("mimeType") or "")]
        return parts

    def read(self, partition: _Part) -> Iterator[tuple]:
        yield from self.remote.tree(partition.folder, partition.path) if partition.folder else partition.rows


class HttpListing(DataSource):
    """(id, path, name, mime) of all that a remote folder holds. Options: path, the base URL; folder, its id; token."""

    @classmethod
    def name(cls) -> str:
        return "http_listing"

    def schema(self) -> str:
        return "id string, path string, name string, mime string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(Remote(self.options["path"], self.options.get("token", "")), self.options.get("folder", "root"))


def reader_of(base: str, token: str = "") -> Callable[[str], bytes]:
    """What gives the bytes of a file by its id."""
    url = f"{base.rstrip('/')}/files/"

    def read(key: str) -> bytes:
        return _get(f"{url}{urllib.parse.quote(key, safe='')}?alt=media", token)

    return read
