"""A language model as a column: prompts go to any callable, batch by batch, with retries."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from quarry.functions.text import RETRYABLE

ANSWER = "raw string, seconds double, finish_reason string"


def ask(model: Callable, prompt: str | list[str], retries: int = 4, wait_s: float = 60, sleep: Callable[[float], None] = time.sleep) -> tuple:
    """(answer, seconds, finish reason); the wait doubles with each retry, and a time-out or what cannot be retried gives no answer."""
    began = time.monotonic()
    for k in range(retries + 1):
        try:
            return model(prompt), time.monotonic() - began, "STOP"
        except TimeoutError:
            break
        except Exception as e:  # noqa: BLE001  whatever a client raises
            if k == retries or not any(p in str(e).lower() for p in RETRYABLE):
                return None, time.monotonic() - began, f"ERROR: {e}"
            sleep(wait_s * 2**k)
    return None, time.monotonic() - began, "TIMEOUT"


def answered(rows: DataFrame, prompt: str, model: Callable[[], Callable[[str], str]], **how) -> DataFrame:
    """rows with raw, seconds and finish_reason. `model` makes a client, one for each task; a null prompt is not sent."""
    at = rows.columns.index(prompt)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = model()
        for batch in batches:
            found = [(None, 0.0, None) if p is None else ask(client, p, **how) for p in batch.column(at).to_pylist()]
            cols = list(zip(*found, strict=True)) or [(), (), ()]
            more = [pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.float64(), pa.string()), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "raw", "seconds", "finish_reason"])

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields)
    return rows.mapInArrow(run, kinds + ANSWER)


def embedded(rows: DataFrame, text: str, model: Callable[[], Callable[[list[str]], list]], size: int = 80, dim: int = 768, **how) -> DataFrame:
    """rows with the vector `embedding` of a text; the model gets at most `size` texts at a time and is asked again as by ask().

    Null texts have no vector; a call that gives none, or a vector of another length, is an error, as rows without vectors would go unseen.
    """
    at = rows.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = model()
        for batch in batches:
            texts = batch.column(at).to_pylist()
            given = [i for i, t in enumerate(texts) if t is not None]
            found: list[list[float] | None] = [None] * len(texts)
            for k in range(0, len(given), size):
                part = given[k : k + size]
                vectors, _, reason = ask(client, [texts[i] for i in part], **how)
                if vectors is None or len(vectors) != len(part) or any(len(v) != dim for v in vectors):
                    raise ValueError(f"no vectors of {dim} components: {reason}")
                for i, v in zip(part, vectors, strict=True):
                    found[i] = list(v)
            made = pa.array(found, pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=[*batch.schema.names, "embedding"])

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields)
    return rows.mapInArrow(run, kinds + "embedding array<float>")
