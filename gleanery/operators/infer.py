"""Calling a model on every row."""

from __future__ import annotations

import hashlib
import logging
import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.resource import ResourceProfile
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.session import prepare

log = logging.getLogger(__name__)

Model = Callable[[list[Any]], list[str | Exception]]
ModelFactory = Callable[[], Model]

_RESULT = T.StructType(
    [
        T.StructField("answer", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("attempts", T.IntegerType()),
    ]
)
_RESULT_ARROW = pa.struct([("answer", pa.string()), ("error", pa.string()), ("attempts", pa.int32())])

# One model per Python worker and factory.
_models: dict[str, Model] = {}


@dataclass(frozen=True)
class RetryPolicy:
    """Waits ``base * 2**(k-1)`` seconds, at most ``limit``, after failed attempt k."""

    max_attempts: int = 3
    base: float = 4.0
    limit: float = 60.0
    sleep: Callable[[float], None] = time.sleep

    def delay(self, attempt: int) -> float:
        return min(self.base * 2 ** (attempt - 1), self.limit)


def _call(model: Model, requests: list[Any]) -> list[str | Exception]:
    answers = model(requests)
    if len(answers) != len(requests):
        raise ValueError(f"model gave {len(answers)} answers to {len(requests)} requests")
    return [answer if isinstance(answer, Exception) else answer.strip() for answer in answers]


def ask_one(model: Model, request: Any, retry: RetryPolicy) -> dict[str, Any]:
    """One request; only ``RuntimeError`` is tried again."""
    return ask_many(model, [request], retry)[0]


def ask_many(model: Model, requests: list[Any], retry: RetryPolicy) -> list[dict[str, Any]]:
    """Several requests in one call, an attempt of each of them; at most ``max_attempts`` calls see a request.

    A model may return an exception in place of an answer; then only that
    request has failed. If a call of several fails as a whole, each may be to
    blame, and all are asked again one by one. With a single attempt they are
    asked one by one from the start, so that a bad row fails alone.
    """
    results: list[dict[str, Any]] = [{} for _ in requests]
    order = range(len(requests))
    calls = [(list(order), 1)] if retry.max_attempts > 1 else [([i], 1) for i in reversed(order)]
    while calls:
        rows, attempt = calls.pop()
        unclear = False
        try:
            answers = _call(model, [requests[i] for i in rows])
        except Exception as exc:
            log.warning("a call of %d requests failed at attempt %d: %s", len(rows), attempt, exc)
            answers, unclear = [exc] * len(rows), len(rows) > 1
        again = []
        for i, answer in zip(rows, answers, strict=True):
            result = {"answer": None, "error": None, "attempts": attempt}
            if not isinstance(answer, Exception):
                result["answer"] = answer
            elif not (unclear or isinstance(answer, RuntimeError)):
                result["error"] = str(answer)
            elif attempt < retry.max_attempts:
                again.append(i)
            else:
                result["error"] = f"generation failed after {attempt} attempts"
            results[i] = result
        if again and any(isinstance(answer, RuntimeError) for answer in answers):
            retry.sleep(retry.delay(attempt))
        calls += [([i], attempt + 1) for i in reversed(again)]
    return results


def infer(
    df: DataFrame,
    model_factory: ModelFactory,
    request: str | Column | Sequence[str] = "messages",
    out: str = "answer",
    *,
    retry: RetryPolicy = RetryPolicy(),
    call_rows: int = 8,
    profile: ResourceProfile | None = None,
) -> DataFrame:
    """Add ``out``, ``model_error`` and ``attempts``.

    ``request`` is a column (or several, sent as a struct); a row whose request
    is NULL is not sent.  The factory runs once per Python worker, at the first
    request.  With ``profile`` the stage runs on its resources, which takes the
    whole row through Python; otherwise only the request goes there.
    """
    prepare(df.sparkSession)
    if isinstance(request, str):
        request = F.col(request)
    elif not isinstance(request, Column):
        request = F.struct(*request)
    key = hashlib.sha256(cloudpickle.dumps(model_factory)).hexdigest()

    def answers(requests: pa.Array) -> pa.Array:
        results: list[dict[str, Any] | None] = [None] * len(requests)
        wanted = [i for i, value in enumerate(requests) if value.is_valid]
        for at in range(0, len(wanted), call_rows):
            if key not in _models:
                _models[key] = model_factory()
            part = wanted[at : at + call_rows]
            found = ask_many(_models[key], [requests[i].as_py() for i in part], retry)
            for i, result in zip(part, found):
                results[i] = result
        return pa.array(results, type=_RESULT_ARROW)

    if profile is None:

        @F.arrow_udf(_RESULT)
        def ask(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for batch in batches:
                yield answers(batch)

        asked = df.withColumn("_result", ask.asNondeterministic()(request))
    else:
        sent = df.withColumn("_request", request)
        schema = T.StructType(list(df.schema.fields)).add("_result", _RESULT)

        def ask_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = batch.schema.get_field_index("_request")
                columns = batch.columns[:at] + [answers(batch.column(at))]
                yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:at] + ["_result"])

        asked = sent.mapInArrow(ask_rows, schema, profile=profile)

    return asked.select(
        *df.columns,
        F.col("_result.answer").alias(out),
        F.col("_result.error").alias("model_error"),
        F.col("_result.attempts").alias("attempts"),
    )
