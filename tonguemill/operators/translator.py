"""The one stage that calls out: distinct texts in, replies out, on Arrow batches."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonguemill.functions.tokens import tokenizer
from tonguemill.operators.segments import Policy

TRANSLATED, FAILED, SKIPPED_TOKENS, UNCHANGED = "translated", "failed", "skipped_tokens", "unchanged"

REPLY_SCHEMA = "text_hash binary, translated string, status string, attempts int"


class Translator(Protocol):
    """A serialisable description of a service. `open` runs on the executor, once for each thread that calls."""

    provider: str
    model: str
    source: str
    target: str

    def open(self) -> Callable[[str], str]: ...


@dataclass(frozen=True)
class FunctionTranslator:
    """A translator made of one function, for services with a plain call and for deterministic rewrites."""

    call: Callable[[str], str]
    provider: str = "function"
    model: str = ""
    source: str = "en"
    target: str = "es"

    def open(self) -> Callable[[str], str]:
        return self.call


def over_token_limit(text: Column | str, policy: Policy) -> Column:
    """Whether a request would exceed the model's context. Such a text is returned untranslated."""
    if policy.max_tokens is None:
        return F.lit(False)
    return F.lit(policy.prompt_tokens) + tokenizer(policy.tokens)(text) > policy.max_tokens


def call_with_retries(call: Callable[[str], str], text: str, policy: Policy, sleep=time.sleep) -> tuple[str, str, int]:
    """(reply, status, attempts). The original text where every attempt failed."""
    for attempt in range(policy.max_retries):
        try:
            reply = call(text)
            if not isinstance(reply, str) or (policy.strip_reply and not reply):
                raise ValueError("the service sent no text")
            return (reply.strip() if policy.strip_reply else reply), TRANSLATED, attempt + 1
        except Exception:  # noqa: BLE001 - whatever a service raises is one failed attempt
            if attempt + 1 < policy.max_retries and policy.backoff > 0:  # 0 means no wait, also where 0**0 would be 1
                sleep(policy.backoff**attempt)
    return text, FAILED, policy.max_retries


def translate_distinct(texts: DataFrame, translator: Translator, policy: Policy, in_flight: int = 1) -> DataFrame:
    """Replies to (text_hash, piece, over_limit) rows, one call each. Rows stream through a task.

    A task keeps at most `in_flight` calls going, retries included; while the last calls of a batch end, those of the
    next begin. `open` runs once in each of these threads.
    """
    if in_flight < 1:
        raise ValueError("a task needs at least one call in flight")

    def stage(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = threading.local()

        def reply(text: str, over: bool) -> tuple[str, str, int]:
            if over:
                return text, SKIPPED_TOKENS, 0
            if not hasattr(own, "call"):
                own.call = translator.open()
            return call_with_retries(own.call, text, policy)

        def answered(batch: pd.DataFrame, replies: Iterable[tuple[str, str, int]]) -> pd.DataFrame:
            out = pd.DataFrame(list(replies), columns=["translated", "status", "attempts"])
            out.insert(0, "text_hash", batch["text_hash"].to_numpy())
            return out

        if in_flight == 1:
            for batch in batches:
                yield answered(batch, map(reply, batch["piece"], batch["over_limit"]))
            return
        with ThreadPoolExecutor(in_flight) as threads:
            waiting = None
            for batch in batches:
                started = batch, threads.map(reply, batch["piece"], batch["over_limit"])
                if waiting:
                    yield answered(*waiting)
                waiting = started
            if waiting:
                yield answered(*waiting)

    return texts.mapInPandas(stage, REPLY_SCHEMA)
