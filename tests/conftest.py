import http.server
import threading
import time

import pytest
from pyspark.sql import SparkSession

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


class Site:
    """A web server for pages of text; counts requests, may fail some, marks pages as immutable."""

    def __init__(self):
        self.pages, self.immutable, self.failures, self.requests, self.auth, self.redirects = {}, set(), {}, [], None, {}
        self.slow, self.now, self.most, self.lock = 0.0, 0, 0, threading.Lock()
        site = self

        class Handler(http.server.BaseHTTPRequestHandler):
            def do_GET(self):
                with site.lock:
                    site.now += 1
                    site.most = max(site.most, site.now)
                time.sleep(site.slow)
                try:
                    self.answer()
                finally:
                    with site.lock:
                        site.now -= 1

            def answer(self):
                path = self.path.partition("?")[0]
                site.requests.append((path, self.headers.get("Authorization"), self.headers.get("Accept")))
                if site.auth and self.headers.get("Authorization") != site.auth:
                    self.send_response(401)
                    self.end_headers()
                    return
                if site.failures.get(path, 0) > 0:
                    site.failures[path] -= 1
                    self.send_response(429)
                    self.end_headers()
                    return
                if path in site.redirects:
                    self.send_response(302)
                    self.send_header("Location", site.redirects[path])
                    self.end_headers()
                    return
                text = site.pages.get(path)
                self.send_response(200 if text is not None else 404)
                self.send_header("Content-Type", "text/turtle")
                if path in site.immutable:
                    self.send_header("Cache-Control", "public, max-age=604800, immutable")
                self.end_headers()
                self.wfile.write((text or "").encode())

            def log_message(self, *_):
                pass

        self.server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        self.base = f"http://127.0.0.1:{self.server.server_port}"
        threading.Thread(target=self.server.serve_forever, daemon=True).start()

    def put(self, path, text, immutable=False):
        self.pages[path] = text.replace("BASE", self.base)
        (self.immutable.add if immutable else self.immutable.discard)(path)

    def fetched(self, path):
        return sum(p == path for p, _, _ in self.requests)


@pytest.fixture
def site():
    s = Site()
    yield s
    s.server.shutdown()
