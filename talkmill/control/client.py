"""A caller for an outside model: cached, retried with growing pauses, and with one try of a second model."""

from __future__ import annotations

import hashlib
import random
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Protocol


class Store(Protocol):
    """What the cache must offer; the manifest does."""

    def reply(self, key: str) -> str | None: ...
    def keep_reply(self, key: str, model: str, reply: str) -> None: ...


class Transient(Exception):
    """A failure that may pass: too many requests, a lost connection, a timeout."""


class Exhausted(RuntimeError):
    """No answer within the attempts."""


class BadReply(ValueError):
    """An empty or overlong reply; never cached."""


def request_key(model: str, system: str, user: str, max_tokens: int, temperature: float) -> str:
    """The same key as `model_lane.cache_key` gives a column."""
    lines = [f"model={model}", f"system={system}", f"user={user}", f"max_tokens={max_tokens}", f"temperature={temperature + 0.0:.6f}"]
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


@dataclass
class Client:
    """`send(model, system, user, max_tokens, temperature)` does the call. Answers are kept under the first model's key whoever gave them."""

    send: Callable[[str, str, str, int, float], str]
    store: Store
    model: str
    second: str | None = None
    attempts: int = 3
    longest: int = 4096
    sleep: Callable[[float], None] = time.sleep
    jitter: random.Random = field(default_factory=random.Random)
    calls: int = 0
    hits: int = 0

    def pause(self, n: int) -> float:
        """Seconds before attempt n + 1: 1, 2, 4, ... up to 30, and up to a tenth more."""
        return min(2.0 ** (n - 1), 30.0) * (1 + 0.1 * self.jitter.random())

    def ask(self, system: str, user: str, max_tokens: int = 256, temperature: float = 0.0) -> str:
        key = request_key(self.model, system, user, max_tokens, temperature)
        if (kept := self.store.reply(key)) is not None:
            self.hits += 1
            return kept
        reply = self._tried(system, user, max_tokens, temperature)
        if not reply.strip() or len(reply) > self.longest:
            raise BadReply(f"{len(reply)} characters")
        self.store.keep_reply(key, self.model, reply)
        return reply

    def _tried(self, *request) -> str:
        last: Exception | None = None
        for n in range(1, self.attempts + 1):
            try:
                self.calls += 1
                return self.send(self.model, *request)
            except Transient as e:
                last = e
                if n < self.attempts:
                    self.sleep(self.pause(n))
        if self.second:
            try:
                self.calls += 1
                return self.send(self.second, *request)
            except Transient as e:
                last = e
        raise Exhausted(f"no answer after {self.attempts} attempts") from last


class NoStore:
    """On executors answers are kept by the table that they're written to, not by the caller."""

    def reply(self, key: str) -> str | None:
        return None

    def keep_reply(self, key: str, model: str, reply: str) -> None:
        pass


@dataclass
class Calls:
    """What a layer needs to ask an outside model: the sender (it must pickle), the request's fixed parts and the limits.

    `budget` bounds the new calls of a batch, `concurrency` how many tasks call at once.
    """

    send: Callable[[str, str, str, int, float], str]
    model: str
    system: str
    second: str | None = None
    max_tokens: int = 256
    temperature: float = 0.0
    budget: int = 1000
    concurrency: int = 16

    def __call__(self, text: str) -> str:
        """Asks with retries; runs in a task."""
        return Client(self.send, NoStore(), self.model, self.second).ask(self.system, text, self.max_tokens, self.temperature)
