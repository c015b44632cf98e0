"""Asking services and external programs from tasks: what a snapshot cannot answer.

A fetcher is any picklable function from a title to (status, body); the library has none of its own that needs a
network. Words are made distinct before anything is asked, rates are shared out over the tasks, and a whole batch is
asked by one task, whose connections the fetcher may keep.
"""

from __future__ import annotations

import json
import os
import random
import select
import subprocess
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Answer = tuple[int, str | None]
Fetcher = Callable[[str], Answer]
#: From where a page begins to its members and where the next one begins.
Ask = Callable[[str | None], tuple[list[str], str | None]]
RETRYABLE = frozenset({429, 500, 502, 503, 504})


@dataclass(frozen=True)
class Backoff:
    """How often and how long to wait. ``attempts`` counts the first one."""

    attempts: int = 6
    first: float = 0.5
    most: float = 10.0
    jitter: float = 0.0

    def delays(self, rng: random.Random) -> Iterator[float]:
        for n in range(self.attempts):
            yield min(self.most, self.first * 2**n) * (1 - self.jitter + 2 * self.jitter * rng.random())


#: The policies of the two tools.
DUMP, CLEANSE = Backoff(6, 0.5, 10.0), Backoff(7, 0.75, 20.0, 0.2)


def fetch_dump(title: str, fetcher: Fetcher, policy: Backoff = DUMP, sleep: Callable[[float], None] = time.sleep) -> Answer:
    """Asks until there is an answer: server errors, too many requests, broken JSON and exceptions are tried again; any
    other status comes back at once. Status 0 when all attempts are used up. The body is null unless it is an object."""
    for delay in policy.delays(random.Random(title)):
        try:
            status, body = fetcher(title)
            if status == 200:
                return 200, body if isinstance(json.loads(body or ""), dict) else None
            if status not in RETRYABLE:
                return status, None
        except Exception:  # noqa: BLE001 - any failure of the fetcher is a transient one
            pass
        sleep(delay)
    return 0, None


def fetch_cleanse(title: str, fetcher: Fetcher, policy: Backoff = CLEANSE, sleep: Callable[[float], None] = time.sleep) -> Answer:
    """Only too many requests are tried again; an exception is status -1 at once."""
    delays = list(policy.delays(random.Random(title)))
    try:
        for n, delay in enumerate(delays):
            status, body = fetcher(title)
            if status != 429 or n == len(delays) - 1:
                break
            sleep(delay)
        return (200, body if isinstance(json.loads(body or ""), dict) else None) if status == 200 else (status, None)
    except Exception:  # noqa: BLE001
        return -1, None


def paced(ask: Callable[[str], Answer], per_second: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> Callable[[str], Answer]:
    """``ask`` with at least 1 / per_second between calls; 0 is no limit."""
    last = [float("-inf")]

    def run(title: str) -> Answer:
        if per_second > 0:
            wait = last[0] + 1 / per_second - clock()
            if wait > 0:
                sleep(wait)
            last[0] = clock()
        return ask(title)

    return run


def snapshot(titles: DataFrame, ask: Callable[[str], Answer], per_second: float = 0.0, tasks: int = 4) -> DataFrame:
    """(title, status, payload) of each distinct title, asked in ``tasks`` tasks that share the rate."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        slow = paced(ask, per_second / tasks)
        for batch in batches:
            answers = [slow(t) for t in batch.title]
            yield pd.DataFrame({"title": batch.title, "status": [s for s, _ in answers], "payload": [b for _, b in answers]})

    return titles.select("title").distinct().repartition(tasks, "title").mapInPandas(run, "title string, status int, payload string")


def pages(first: str | None, ask: Ask, pause: Callable[[], None] = lambda: None) -> Iterator[str]:
    """The members of a listing that comes page by page; ``ask`` gives a page and where the next one begins."""
    at = first
    while True:
        members, at = ask(at)
        yield from members
        if at is None:
            return
        pause()


def listed(rows: DataFrame, service: Callable[[Iterator[pd.DataFrame]], Ask], size: int = 10_000) -> DataFrame:
    """(title): the members of a listing in as many ranges as ``rows`` has tasks, each followed page by page in its task from
    its beginning on. ``service`` makes of a task's rows what its pages are asked of; no member passes through the driver."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        members = pages(None, service(batches))
        while held := list(islice(members, size)):
            yield pd.DataFrame({"title": held})

    return rows.mapInPandas(run, "title string")


def run_command(template: list[str], word: str, timeout: float = 2.0) -> list[str]:
    """The non-empty, stripped lines that a command prints for a word; none if it takes too long."""
    try:
        done = subprocess.run([a.replace("{word}", word) for a in template], capture_output=True, text=True, timeout=timeout, check=False)
    except subprocess.TimeoutExpired:
        return []
    return [x for line in done.stdout.splitlines() if (x := line.strip())]


def analysed(words: DataFrame, template: list[str], timeout: float = 2.0, word: str = "word") -> DataFrame:
    """``words`` with ``analyses``; the command runs once for each distinct word."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({word: batch[word], "analyses": [run_command(template, w, timeout) for w in batch[word]]})

    return words.join(words.select(word).distinct().mapInPandas(run, f"{word} string, analyses array<string>"), word, "left")


class LineWorker:
    """A program that reads a word a line and answers each with lines up to an ``end`` line. It is started when it is first
    needed, and again after a word that takes longer than ``timeout`` seconds or that it dies of; such words have no lines."""

    def __init__(self, command: list[str], timeout: float = 2.0, end: str = ""):
        self.command, self.timeout, self.end = command, timeout, end
        self.process: subprocess.Popen | None = None
        self.started, self.held = 0, b""

    def close(self) -> None:
        if self.process:
            self.process.kill()
            self.process.stdin.close()
            self.process.stdout.close()
            self.process.wait()
        self.process, self.held = None, b""

    def _line(self, deadline: float) -> str:
        """The next line, or an error if there is none in time."""
        while b"\n" not in self.held:
            out = self.process.stdout.fileno()
            if not select.select([out], [], [], max(0.0, deadline - time.monotonic()))[0]:
                raise TimeoutError
            got = os.read(out, 1 << 16)
            if not got:
                raise EOFError
            self.held += got
        line, self.held = self.held.split(b"\n", 1)
        return line.decode("utf-8", "replace")

    def ask(self, word: str) -> list[str]:
        """The non-empty, stripped lines for a word; a word with a line break is not asked."""
        if "\n" in word or "\r" in word:
            return []
        if not self.process:
            self.process = subprocess.Popen(self.command, stdin=subprocess.PIPE, stdout=subprocess.PIPE, stderr=subprocess.DEVNULL, bufsize=0)
            self.started += 1
        deadline, out = time.monotonic() + self.timeout, []
        try:
            self.process.stdin.write(word.encode() + b"\n")
            while (line := self._line(deadline)) != self.end:
                if line.strip():
                    out.append(line.strip())
        except (TimeoutError, EOFError, OSError):
            self.close()  # what it still says belongs to this word
            return []
        return out


def analysed_lines(words: DataFrame, command: list[str], timeout: float = 2.0, word: str = "word", end: str = "", tasks: int | None = None) -> DataFrame:
    """``words`` with ``analyses``, the lines of a ``LineWorker`` for each distinct word: a process for each task, through which
    its words stream, and one more for each word that fails. A null word has none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        worker = LineWorker(command, timeout, end)
        try:
            for batch in batches:
                yield pd.DataFrame({word: batch[word], "analyses": [worker.ask(w) for w in batch[word]]})
        finally:
            worker.close()

    asked = words.select(word).where(F.col(word).isNotNull()).distinct()
    asked = asked.repartition(tasks, word) if tasks else asked
    return words.join(asked.mapInPandas(run, f"{word} string, analyses array<string>"), word, "left")


def analysed_batches(words: DataFrame, template: list[str], batch: str = "batch", word: str = "word", timeout: float = 60.0) -> DataFrame:
    """(batch, line): what a command prints for the words of a batch, which it reads one to a line with a blank line
    behind each. Batches are of a fixed size, so a group is small."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        fed = "".join(f"{w}\n\n" for w in frame.sort_values("row_idx")[word])
        done = subprocess.run(template, input=fed, capture_output=True, text=True, timeout=timeout, check=False)
        return pd.DataFrame({"batch": frame[batch].iloc[0], "line": done.stdout.splitlines()})

    return words.select(batch, word, "row_idx").groupBy(batch).applyInPandas(run, "batch long, line string")


def joined_analyses(words: DataFrame, sep: str = "|") -> DataFrame:
    return words.withColumn("analyses", F.array_join(F.coalesce("analyses", F.array().cast("array<string>")), sep))
