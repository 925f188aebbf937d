"""Options of a replication, with their defaults."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, fields, replace
from urllib.parse import urlsplit

from ..functions import partial_dates
from ..operators.conditions import Condition

ORDERS = ("none", "ascending", "descending")


@dataclass(frozen=True)
class Fetch:
    """How pages are fetched. ``max_retries`` 0 retries forever; ``safe`` also retries forever when no answer comes at all.

    Credentials go to ``auth_host`` alone: a host, or a host and port; a ``Config``
    sets it to that of its url. ``concurrent`` limits the fetches from one origin.
    ``open`` may replace how a request is opened: (request, timeout) to an answer
    as ``urllib`` gives it.
    """

    codes: tuple[int, ...] = (408, 425, 429, 500, 502, 503, 504)
    base_s: float = 0.5
    max_retries: int = 5
    safe: bool = False
    username: str | None = None
    password: str | None = None
    auth_host: str | None = None
    timeout_s: float = 60.0
    headers: tuple[tuple[str, str], ...] = ()
    concurrent: int = 10
    open: Callable | None = None


@dataclass(frozen=True)
class Config:
    url: str
    url_is_view: bool = False
    loose: bool = False
    polling: bool = False
    poll_interval_ms: int = 200
    no_shape: bool = False
    shape_file: str | None = None
    only_default_graph: bool = False
    condition: Condition = field(default_factory=Condition)
    before: str | None = None
    after: str | None = None
    default_timezone: str = partial_dates.DEFAULT_ZONE
    materialize: bool = False
    last_version_only: bool = False
    include_metadata: bool = False
    concurrent_fetches: int = 10
    state_path: str | None = None
    start_fresh: bool = False
    refetch_mutable: bool = False
    ordered: str = "none"
    strict: bool = False
    compat: bool = False
    fetch: Fetch = field(default_factory=Fetch)

    def __post_init__(self) -> None:
        if self.ordered not in ORDERS:
            raise ValueError(f"an order is one of {', '.join(ORDERS)}, not {self.ordered!r}")
        if self.fetch.username is not None and self.fetch.auth_host is None and self.url.startswith(("http://", "https://")):
            object.__setattr__(self, "fetch", replace(self.fetch, auth_host=urlsplit(self.url).netloc.rpartition("@")[2]))

    @property
    def timezone(self) -> str:
        """The default time zone; one that can't be read counts as anywhere on earth."""
        try:
            return partial_dates.check_zone(self.default_timezone)
        except ValueError:
            return partial_dates.DEFAULT_ZONE

    @classmethod
    def of(cls, **options) -> Config:
        """A config of known options; those that are None take their default."""
        known = {f.name for f in fields(cls)}
        if unknown := set(options) - known:
            raise ValueError(f"unknown options: {', '.join(sorted(unknown))}")
        return cls(**{k: v for k, v in options.items() if v is not None})
