"""Command line: replicates a stream to standard output or files as N-Quads."""

from __future__ import annotations

import argparse
import contextlib
import logging
import signal
import sys
import threading
from collections.abc import Iterator

from pyspark.sql import SparkSession

from .operators import conditions
from .plans import condition_files
from .plans.config import Config, Fetch
from .plans.replicate import Replication, pulled
from .sources import sinks


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="fragstream", description=__doc__)
    p.add_argument("url")
    flag = lambda *names, **k: p.add_argument(*names, action="store_true", **k)
    p.add_argument("-f", "--follow", action="store_true", help="poll pages that may change")
    p.add_argument("--poll-interval", type=int, default=200, help="milliseconds between polls")
    p.add_argument("--polls", type=int, help="end after so many")
    p.add_argument("-o", "--ordered", choices=("none", "ascending", "descending"), default="none")
    p.add_argument("-s", "--save", dest="state_path", help="folder of the saved state")
    flag("--start-fresh", help="forget the saved state")
    flag("--url-is-view")
    flag("-l", "--loose", help="follow links of any subject of a page")
    flag("--no-shape")
    p.add_argument("--shape-file", help="file or address of a shape")
    flag("--only-default-graph")
    p.add_argument("--condition", help="file of a condition")
    p.add_argument("--before")
    p.add_argument("--after")
    p.add_argument("-t", "--default-timezone", default="AoE")
    flag("--materialize", help="name versions after their entity")
    flag("--last-version-only")
    flag("-m", "--metadata", help="ask for metadata of pages")
    p.add_argument("--concurrent", type=int, default=10)
    p.add_argument("--basic-auth", help="user:password")
    p.add_argument("--auth-host", help="host that the credentials are for; by default that of the url")
    p.add_argument("--retry-count", type=int, default=3)
    p.add_argument("--retry-base", type=float, default=0.5, help="seconds")
    p.add_argument("--http-codes", nargs="*", default=[], help="codes to retry")
    flag("--safe")
    p.add_argument("-q", "--quiet", action="store_true", help="print neither members nor progress")
    p.add_argument("--sds-stream", help="wrap members for this stream")
    p.add_argument("--out", help="folder of text files instead of standard output")
    return p


def config_of(a: argparse.Namespace) -> Config:
    user, _, password = (a.basic_auth or "").partition(":")
    codes = tuple(int(x) for c in a.http_codes for x in c.split(",") if x.strip()) or Fetch.codes
    fetch = Fetch(codes=codes, base_s=a.retry_base, max_retries=a.retry_count, safe=a.safe, username=user or None, password=password or None, auth_host=a.auth_host, concurrent=a.concurrent)
    cond = condition_files.load(a.condition, a.default_timezone) if a.condition else conditions.Condition()
    return Config(url=a.url, url_is_view=a.url_is_view, loose=a.loose, polling=a.follow, poll_interval_ms=a.poll_interval, no_shape=a.no_shape, shape_file=a.shape_file, only_default_graph=a.only_default_graph, condition=cond, before=a.before, after=a.after, default_timezone=a.default_timezone, materialize=a.materialize, last_version_only=a.last_version_only, include_metadata=a.metadata, concurrent_fetches=a.concurrent, state_path=a.state_path, start_fresh=a.start_fresh, ordered=a.ordered, fetch=fetch)


@contextlib.contextmanager
def ending(run: Replication) -> Iterator[None]:
    """A first SIGINT or SIGTERM closes the run after the step under way, so that the state fits what was printed; a second one kills it."""
    if threading.current_thread() is not threading.main_thread():
        yield
        return
    before = {n: signal.getsignal(n) for n in (signal.SIGINT, signal.SIGTERM)}

    def close(*_) -> None:
        run.close()
        for n, was in before.items():
            signal.signal(n, was)

    for n in before:
        signal.signal(n, close)
    try:
        yield
    finally:
        for n, was in before.items():
            signal.signal(n, was)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    run = Replication(spark or SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate(), config_of(a))
    count = 0

    def sink(members, poll: int = 0) -> None:
        nonlocal count
        if a.sds_stream:
            members = sinks.enveloped(members, a.sds_stream)
        if a.out:
            sinks.write_text(members, a.out, "append")
            return
        for row in pulled(sinks.text(members)):
            count += 1
            if not a.quiet:
                sys.stdout.write(row[0])

    if not a.quiet:  # progress, by level of the crawl
        logging.basicConfig(stream=sys.stderr, format="%(message)s")
        logging.getLogger("fragstream").setLevel(logging.INFO)
    with ending(run):
        if a.follow:
            run.follow(sink, a.polls)
        elif a.ordered != "none":
            run.run_early(sink)
        else:
            run.run(sink)
    print(f"{run.member_count} members, {run.fragment_count} fragments", file=sys.stderr)
    return 0


if __name__ == "__main__":
    sys.exit(main())
