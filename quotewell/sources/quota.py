"""A request quota that all tasks of an application share.

The driver holds a token bucket and lends its tokens over HTTP, so that tasks on any executor draw on one budget. A task reserves a few tokens, and spends each just
before its request. A reservation that is neither spent nor released, because its task is lost, falls back to the bucket after a while; a token is never spent twice. In
any window of w seconds at most burst + rate * w requests are sent. A new bucket is empty, as nobody knows what an earlier driver has spent.
"""

from __future__ import annotations

import json
import secrets
import threading
import time
import urllib.request
from collections.abc import Callable
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlparse


class Bucket:
    """rate tokens a second, burst of them at most; reservations last `hold` seconds."""

    def __init__(self, rate: float, burst: int, hold: float = 60.0, clock: Callable[[], float] = time.monotonic) -> None:
        if rate <= 0 or burst < 1:
            raise ValueError("rate and burst must be positive")
        self.rate, self.burst, self.hold, self.clock = rate, burst, hold, clock
        self.tokens, self.at = 0.0, clock()
        self.leases: dict[str, tuple[int, float]] = {}
        self.lock = threading.Lock()

    def _settle(self) -> float:
        now = self.clock()
        back = 0
        for lease, (left, until) in list(self.leases.items()):
            if until <= now:
                back += left
                del self.leases[lease]
        # what is reserved still counts against the burst: it may all be spent at once
        reserved = sum(left for left, _ in self.leases.values())
        self.tokens = min(self.burst - reserved, self.tokens + back + (now - self.at) * self.rate)
        self.at = now
        return now

    def reserve(self, wanted: int = 1) -> tuple[str | None, int, float]:
        """(lease, tokens, 0), with 1 to `wanted` tokens, or (None, 0, seconds until there may be one)."""
        with self.lock:
            now = self._settle()
            got = min(int(self.tokens), wanted, self.burst)
            if got < 1:
                return None, 0, max(0.01, (1 - self.tokens) / self.rate)
            self.tokens -= got
            lease = secrets.token_hex(8)
            self.leases[lease] = (got, now + self.hold)
            return lease, got, 0.0

    def spend(self, lease: str) -> bool:
        """Whether a token of the lease could be spent; not if it has run out or fallen back."""
        with self.lock:
            self._settle()
            left, until = self.leases.get(lease, (0, 0.0))
            if left < 1:
                return False
            self.leases[lease] = (left - 1, until)
            if left == 1:
                del self.leases[lease]
            return True

    def release(self, lease: str) -> None:
        with self.lock:
            self._settle()
            self.tokens += self.leases.pop(lease, (0, 0.0))[0]

    def drain(self) -> None:
        """The provider says that nothing is left: all tokens and reservations are void."""
        with self.lock:
            self._settle()
            self.tokens = 0.0
            self.leases.clear()


class QuotaServer:
    """with QuotaServer(rate, burst, host) as quota: options(quota=quota.address)"""

    def __init__(self, rate: float, burst: int, host: str = "127.0.0.1", hold: float = 60.0) -> None:
        bucket, path = Bucket(rate, burst, hold), f"/{secrets.token_hex(16)}/"

        class Handler(BaseHTTPRequestHandler):
            def do_POST(self) -> None:
                asked = urlparse(self.path)
                given = {k: v[0] for k, v in parse_qs(asked.query).items()}
                if not asked.path.startswith(path):
                    self.send_error(404)
                    return
                act = asked.path.removeprefix(path)
                if act == "reserve":
                    said = bucket.reserve(int(given.get("n", 1)))
                elif act == "spend":
                    said = bucket.spend(given["lease"])
                else:
                    said = bucket.release(given["lease"]) if act == "release" else bucket.drain()
                out = json.dumps(said).encode()
                self.send_response(200)
                self.send_header("Content-Length", str(len(out)))
                self.end_headers()
                self.wfile.write(out)

            def log_message(self, *_: object) -> None:
                pass

        self.bucket = bucket
        self.server = ThreadingHTTPServer((host, 0), Handler)
        self.server.daemon_threads = True
        self.address = f"http://{host}:{self.server.server_port}{path}"

    def __enter__(self) -> QuotaServer:
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        return self

    def __exit__(self, *_: object) -> None:
        self.server.shutdown()
        self.server.server_close()


class Quota:
    """A task's side: turn() returns when one request may be sent."""

    def __init__(self, address: str, at_once: int = 1, sleep: Callable[[float], None] = time.sleep) -> None:
        self.address, self.at_once, self.sleep = address, at_once, sleep
        self.lease: str | None = None

    def _ask(self, what: str) -> object:
        with urllib.request.urlopen(urllib.request.Request(self.address + what, method="POST"), timeout=30) as r:
            return json.loads(r.read())

    def turn(self) -> None:
        while not (self.lease and self._ask(f"spend?lease={self.lease}")):
            self.lease, _, wait = self._ask(f"reserve?n={self.at_once}")
            if wait:
                self.sleep(min(wait, 5.0))

    def drain(self) -> None:
        self._ask("drain")

    def close(self) -> None:
        if self.lease:
            self._ask(f"release?lease={self.lease}")
            self.lease = None
