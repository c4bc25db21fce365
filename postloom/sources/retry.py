"""Repeated tries of a fetch, for readers that are given a fetch function."""

from __future__ import annotations

import random
import time
from collections.abc import Callable
from dataclasses import dataclass
from typing import TypeVar

T = TypeVar("T")


class FetchError(Exception):
    """A fetch that failed, with its HTTP status or the code of its network error."""

    def __init__(self, message: str, status: int | None = None, code: str | None = None):
        super().__init__(message)
        self.status, self.code = status, code


@dataclass(frozen=True)
class Retry:
    """How often and how long to wait: doubled each time, with a random part; picklable, so it travels to readers."""

    # Tries, first wait and largest random part in seconds, and the network errors that pass.
    attempts: int = 3
    first_wait: float = 0.7
    jitter: float = 0.2
    codes: tuple[str, ...] = ("ECONNRESET", "ETIMEDOUT", "ENOTFOUND", "EAI_AGAIN", "ECONNREFUSED", "ECONNABORTED")

    def passes(self, error: FetchError) -> bool:
        """Whether another try may succeed: too many requests, a server's own fault, or a passing network error."""
        return error.status == 429 or (error.status or 0) >= 500 or error.code in self.codes

    def wait(self, tried: int) -> float:
        """Seconds to wait after so many tries, without the random part."""
        return self.first_wait * 2 ** (tried - 1)

    def run(self, fetch: Callable[[], T], sleep: Callable[[float], None] = time.sleep, chance: Callable[[], float] = random.random) -> T:
        """The result of ``fetch``; its last error where every try failed or none may help."""
        for tried in range(1, self.attempts + 1):
            try:
                return fetch()
            except FetchError as error:
                if tried == self.attempts or not self.passes(error):
                    raise
            sleep(self.wait(tried) + chance() * self.jitter)
        raise ValueError("at least one attempt is needed")
