"""Fetching documents over HTTP or from files: retries, basic authentication, limits by origin, cache headers."""

from __future__ import annotations

import base64
import threading
import time
import urllib.error
import urllib.request
from collections import defaultdict
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import urlsplit

from ..functions.scalars import is_remote
from ..plans.config import Fetch

ACCEPT = "application/trig, application/n-quads, text/turtle;q=0.9, application/n-triples;q=0.8"
ACCEPT_METADATA = "application/metadata+trig, " + ACCEPT


class FetchError(OSError):
    """A document could not be had."""


@dataclass(frozen=True)
class Document:
    """``url`` is where the text came from in the end."""

    url: str
    text: str
    immutable: bool = False
    max_age: int | None = None


def cache_control(header: str | None) -> tuple[bool, int | None]:
    """(immutable, max-age) of a Cache-Control header."""
    parts = [p.strip().lower() for p in (header or "").split(",")]
    age = next((p.partition("=")[2].strip() for p in parts if p.startswith("max-age=")), "")
    return "immutable" in parts, int(age) if age.isdigit() else None


class _Redirects(urllib.request.HTTPRedirectHandler):
    """Follows redirects; credentials stay with the host that they are for."""

    def redirect_request(self, req, fp, code, msg, headers, newurl):  # noqa: ANN001, PLR0913
        made = super().redirect_request(req, fp, code, msg, headers, newurl)
        if made is not None and urlsplit(newurl).netloc.lower() != urlsplit(req.full_url).netloc.lower():
            made.remove_header("Authorization")
        return made


_OPENER = urllib.request.build_opener(_Redirects)


class Fetcher:
    """Fetches documents under one configuration; its ``open`` may take the place of the one here."""

    def __init__(self, config: Fetch, open_: Callable | None = None, sleep: Callable[[float], None] = time.sleep):
        self.config, self.open, self.sleep = config, open_ or config.open or _OPENER.open, sleep
        self.gates: dict[str, threading.Semaphore] = defaultdict(lambda: threading.Semaphore(config.concurrent))
        self.lock = threading.Lock()

    def get(self, url: str, accept: str = ACCEPT) -> Document:
        if not is_remote(url):
            path = url.removeprefix("file://")
            with open(path, encoding="utf-8") as f:
                return Document(url, f.read())
        target = url.partition("#")[0]
        with self.lock:
            gate = self.gates["{0.scheme}://{0.netloc}".format(urlsplit(target))]
        with gate:
            return self._tried(target, accept)

    def _tried(self, url: str, accept: str) -> Document:
        wait, tries, auth = self.config.base_s, 0, False
        while True:
            try:
                return self._once(url, accept, auth)
            except urllib.error.HTTPError as e:
                if e.code == 401 and not auth and self._may_sign(url):
                    auth = True
                    continue
                if e.code not in self.config.codes:
                    raise FetchError(f"{url}: status {e.code}") from e
                reason = f"status {e.code}"
            except (urllib.error.URLError, TimeoutError, ConnectionError) as e:
                if not self.config.safe:
                    raise FetchError(f"{url}: {e}") from e
                self.sleep(wait)
                continue
            tries += 1
            if self.config.max_retries and tries >= self.config.max_retries:
                raise FetchError(f"{url}: {reason} after {tries} tries")
            self.sleep(wait)
            wait *= 2

    def _may_sign(self, url: str) -> bool:
        """Whether credentials may go to a host: only to the one they are given for."""
        own = (self.config.auth_host or "").lower()
        return self.config.username is not None and own != "" and own in (urlsplit(url).hostname, urlsplit(url).netloc.rpartition("@")[2].lower())

    def _once(self, url: str, accept: str, auth: bool) -> Document:
        headers = {"Accept": accept} | dict(self.config.headers)
        if auth:
            pair = f"{self.config.username}:{self.config.password or ''}".encode()
            headers["Authorization"] = "Basic " + base64.b64encode(pair).decode()
        with self.open(urllib.request.Request(url, headers=headers), timeout=self.config.timeout_s) as answer:
            immutable, age = cache_control(answer.headers.get("Cache-Control"))
            return Document(answer.geturl(), answer.read().decode("utf-8"), immutable, age)

    def all(self, urls: list[str], accept: str = ACCEPT) -> list[Document | FetchError]:
        """Documents in the order of their addresses, some at a time; what fails is its error."""

        def one(url: str) -> Document | FetchError:
            try:
                return self.get(url, accept)
            except OSError as e:
                return e if isinstance(e, FetchError) else FetchError(f"{url}: {e}")

        with ThreadPoolExecutor(max(1, self.config.concurrent)) as pool:
            return list(pool.map(one, urls))
