"""Deterministic translators. Those that remember use files, as workers are other processes."""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DELIMITER = " |||TRANS-SPLIT||| "


def tag(text: str) -> str:
    return "[es] " + text


def tag_each(text: str) -> str:
    return tag(text.replace(DELIMITER, DELIMITER + "[es] "))


@dataclass(frozen=True)
class Fake:
    """Calls `reply(text)` and logs each call; fails the first `failures` calls for a text."""

    folder: str
    reply: Callable[[str], str] = tag
    failures: int = 0
    bad: str = ""  # texts that contain this always fail
    provider: str = "fake"
    model: str = ""
    source: str = "en"
    target: str = "es"

    def open(self) -> Callable[[str], str]:
        def call(text: str) -> str:
            log = Path(self.folder) / hashlib.sha256(text.encode()).hexdigest()
            with log.open("a") as file:
                file.write("x")
            if self.bad and self.bad in text:
                raise RuntimeError("refused")
            if log.stat().st_size <= self.failures:
                raise RuntimeError("try again")
            return self.reply(text)

        return call

    def calls(self) -> int:
        return sum(p.stat().st_size for p in Path(self.folder).iterdir())

    def texts(self) -> int:
        return len(list(Path(self.folder).iterdir()))
