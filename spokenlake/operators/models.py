"""Models as pluggable functions over batches: registry, calls with retries and feedback, fallbacks, a rate gate."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A text model takes prompts and returns as many answers; it is shipped to the workers, where it opens its connections.
TextModel = Callable[[list[str]], list[str]]
_BACKENDS: dict[str, Callable[..., TextModel]] = {}
CALLED = "answer string, attempts int, ok boolean, error string"


class Retryable(Exception):
    """An error that may go away: connection, timeout, too many requests, a server's error."""


def register(name: str, make: Callable[..., TextModel]) -> None:
    _BACKENDS[name.strip().lower()] = make


def backend(name: str, **settings: object) -> TextModel:
    """The model of a registered backend; an unknown name is an error."""
    found = _BACKENDS.get(name.strip().lower())
    if not found:
        raise ValueError(f"no backend {name!r}; known: {sorted(_BACKENDS)}")
    return found(**settings)


def delay(attempt: int, base: float = 1.0, most: float = 8.0) -> float:
    return min(base * 2 ** (attempt - 1), most)


def feedback(prompt: str, answer: str, error: str) -> str:
    """The next prompt after an answer that was refused."""
    return f"{prompt}\n\n{answer}\n\n{error}"


class Gate:
    """Lets calls pass no faster than a rate; each task has its own, so the cluster's rate is that times the tasks."""

    def __init__(self, per_minute: float | None, now: Callable[[], float] = time.monotonic, wait: Callable[[float], None] = time.sleep):
        self.pause, self.now, self.wait, self.free = 60.0 / per_minute if per_minute else 0.0, now, wait, 0.0

    def enter(self) -> None:
        at = self.now()
        if at < self.free:
            self.wait(self.free - at)
        self.free = max(at, self.free) + self.pause


def call_once(model: TextModel, prompt: str, check: Callable[[str], str | None], most: int, wait: Callable[[float], None], gate: Gate) -> tuple[str | None, int, bool, str | None]:
    """(answer, attempts, ok, error). A refused answer goes into the next prompt with its error; an error that cannot go
    away ends the attempts."""
    asked, answer, error = prompt, None, None
    for attempt in range(1, most + 1):
        gate.enter()
        try:
            answer = model([asked])[0]
            error = check(answer)
            if error is None:
                return answer, attempt, True, None
            asked = feedback(prompt, answer, error)
        except Retryable as e:
            error = str(e)
            if attempt < most:
                wait(delay(attempt))
        except Exception as e:  # noqa: BLE001 - a model's other errors end its row, not the job
            return answer, attempt, False, str(e)
    return answer, most, False, error


def call(
    rows: DataFrame, models: list[TextModel], check: Callable[[str], str | None] = lambda answer: None, prompt: str = "prompt", most: int = 3,
    tasks: int | None = None, per_minute: float | None = None, wait: Callable[[float], None] = time.sleep,
) -> DataFrame:
    """rows with answer, attempts, ok and error. Each row is asked of the first model up to ``most`` times, then of the next
    (fallback). ``tasks`` bounds the calls in flight; ``per_minute`` is the rate of all tasks together. A null prompt is not
    asked (not ok). The order of rows is that of their own columns: carry a position to restore it."""
    rows = rows.repartition(tasks) if tasks else rows
    share = per_minute / tasks if per_minute and tasks else per_minute
    names = rows.columns
    at = names.index(prompt)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gate = Gate(share)
        for batch in batches:
            out = []
            for text in batch.column(at).to_pylist():
                got: tuple = (None, 0, False, "no prompt")
                for model in models if text is not None else ():
                    before = got[1]
                    got = call_once(model, text, check, most, wait, gate)
                    got = (got[0], got[1] + before, *got[2:])
                    if got[2]:
                        break
                out.append(got)
            kinds = (pa.string(), pa.int32(), pa.bool_(), pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)]], names=[*names, "answer", "attempts", "ok", "error"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", " + CALLED
    return rows.mapInArrow(run, schema)


def extract(episodes: DataFrame, chunks: DataFrame, model: TextModel, check: Callable[[str], str | None], key: str, pos: str, **settings: object) -> DataFrame:
    """Fan out an episode's chunks to the model and in again: key, answers (in the chunks' order), ok, error of the first
    failing chunk, and merge, whether the candidates need a merging call (more than one chunk, and any answer)."""
    asked = call(chunks, [model], check, **settings)
    per = asked.groupBy(key).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(pos, "answer"))), lambda x: x["answer"]).alias("answers"), F.bool_and("ok").alias("ok"), F.count("*").alias("chunks"),
        F.min_by("error", F.when(~F.col("ok"), F.col(pos))).alias("error"),
    )
    out = episodes.join(per, key, "left").withColumn("ok", F.coalesce("ok", F.lit(False)))
    return out.withColumn("merge", merge_needed(F.coalesce("chunks", F.lit(0)), F.coalesce(F.size(F.filter("answers", lambda a: a != "")), F.lit(0))))


def merge_needed(chunks, candidates):
    return (chunks > 1) & (candidates > 0)


def staged(items: DataFrame, steps: list[Callable[[DataFrame], DataFrame]], write: Callable[[DataFrame, int], DataFrame] | None = None, most: int = 5) -> DataFrame:
    """Runs steps over all items. With ``write`` each step ends in a table before the next begins (a barrier), and a step
    that fails is tried again up to ``most`` times; without it all steps are one plan."""
    for k, step in enumerate(steps):
        for attempt in range(1, most + 1):
            try:
                made = step(items)
                items = write(made, k) if write else made
                break
            except KeyboardInterrupt:
                raise
            except Exception:
                if attempt == most or not write:
                    raise
    return items


def table_model(rows: DataFrame, make: Callable[[], Callable[[dict[str, list]], dict[str, list]]], schema: str) -> DataFrame:
    """A batch model: columns in, columns out, any number of rows for each batch. ``make`` opens it once in each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = make()
        for batch in batches:
            got = model(batch.to_pydict())
            yield pa.RecordBatch.from_pydict(got)

    return rows.mapInArrow(run, schema)


def piped(rows: DataFrame, command: list[str], request: str = "request") -> DataFrame:
    """rows with response: each request, a line of JSON, goes to a child process of its task, which answers with a line.
    The process lives as long as the task; if it ends early the task fails and is tried again."""
    names = rows.columns
    at = names.index(request)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import subprocess

        with subprocess.Popen(command, stdin=subprocess.PIPE, stdout=subprocess.PIPE, text=True, encoding="utf-8", bufsize=1) as worker:
            for batch in batches:
                out = []
                for line in batch.column(at).to_pylist():
                    worker.stdin.write(line + "\n")
                    worker.stdin.flush()
                    answer = worker.stdout.readline()
                    if not answer:
                        raise RuntimeError("the worker process ended")
                    out.append(answer.rstrip("\n"))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], names=[*names, "response"])
            worker.stdin.close()

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", response string"
    return rows.mapInArrow(run, schema)


def transcribed(segments: DataFrame, model: Callable[[str, str], str], key: str = "doc_id") -> DataFrame:
    """segments: key, idx, request, cached -> key, idx, text: each segment is asked in order with the text before it; one
    that is cached is not asked again. A task streams through its keys' sorted rows and holds one text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple = (None, "")
        for batch in batches:
            out: list[tuple] = []
            for k, i, request, cached in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                before = last[1] if last[0] == k else ""
                last = (k, cached if cached is not None else model(request, before))
                out.append((k, i, last[1]))
            yield pa.RecordBatch.from_arrays([pa.array([o[n] for o in out], t) for n, t in enumerate((pa.int64(), pa.int64(), pa.string()))], names=[key, "idx", "text"])

    given = segments.select(F.col(key).cast("long").alias(key), F.col("idx").cast("long").alias("idx"), "request", "cached")
    return given.repartition(key).sortWithinPartitions(key, "idx").mapInArrow(run, f"{key} long, idx long, text string")


def greedy(scores, eos: int):
    """Column: the likeliest symbol of each step (of equal ones the first) up to the end symbol."""
    best = F.transform(scores, lambda s: (F.array_position(s, F.array_max(s)) - 1).cast("int"))
    end = F.array_position(best, eos)
    return F.when(end > 0, F.slice(best, 1, (end - 1).cast("int"))).otherwise(best)
