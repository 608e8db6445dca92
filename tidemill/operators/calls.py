"""Calls to a service from one task: bounded in flight, each with a deadline, results in the order of the inputs."""

from __future__ import annotations

import queue
import threading
import time
from collections import deque
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import islice
from typing import Any

TIMEOUT = "timeout"
#: Errors of the program and not of the service: they fail the task.
PROGRAM_ERRORS = (TypeError, AttributeError, NameError)


@dataclass(frozen=True)
class Outcome:
    """The result of a call, or why there is none: ``timeout``, or the kind of error and its text."""

    value: Any = None
    error: str | None = None


def _attempt(call: Callable[[Any], Any], given: Any) -> Outcome:
    try:
        return Outcome(call(given))
    except PROGRAM_ERRORS:
        raise
    except Exception as error:
        return Outcome(error=f"{type(error).__name__}: {error}")


class Inputs:
    """What calls are made for: ``size`` inputs at most, in rounds.  ``calls`` gives the inputs of the next round (none: all
    is done), ``answered`` takes their outcomes in the same order."""

    def __init__(self, given: Sequence[Any]):
        self.given, self.size, self.outcomes = given, len(given), []

    def calls(self) -> Sequence[Any]:
        given, self.given = self.given, []
        return given

    def answered(self, outcomes: list[Outcome]) -> None:
        self.outcomes = outcomes


def timed_calls(
    call: Callable[[Any], Any], inputs: Sequence[Any], deadline_seconds: float | None = None, in_flight: int = 10
) -> list[Outcome]:
    """One outcome for each input, in their order; with a deadline as in ``timed_stream``, all calls end after
    ``ceil(len(inputs) / in_flight)`` deadlines at most.  Without one the calls run one after another in this thread."""
    if deadline_seconds is None:
        return [_attempt(call, given) for given in inputs]
    return next(timed_stream(call, iter([Inputs(inputs)]), deadline_seconds, in_flight)).outcomes


def timed_stream(
    call: Callable[[Any], Any], parts: Iterator[Inputs], deadline_seconds: float, in_flight: int = 10,
    wait_seconds: float = 0.0, ahead: int = 10_000,
) -> Iterator[Inputs]:
    """The ``parts`` in their order, each once its rounds are done; a part's next round begins after ``wait_seconds``.

    At most ``in_flight`` calls run at once, so the client must bear that.  A call that is not done after
    ``deadline_seconds`` is given up and its place is free for the next one, of this part or a later one: parts are read
    while earlier ones wait, until those not yet given back hold ``ahead`` inputs.  Python cannot stop a thread; one that
    was given up goes on until its client returns, and its answer is ignored, so the client should have a limit of its own
    as well.
    """
    if deadline_seconds <= 0 or in_flight < 1:
        raise ValueError("a deadline and a number of calls in flight above 0 are needed")
    answers: queue.SimpleQueue = queue.SimpleQueue()
    unfinished: deque[Inputs] = deque()  # not yet given back
    done: set[int] = set()  # those of them without a further round, by identity
    waiting: deque = deque()  # calls not begun: their round, place and input
    later: deque = deque()  # rounds not begun that wait first: their time, part and inputs
    started: dict[int, tuple[float, list, int]] = {}
    held = numbers = 0

    def run(number: int, given: Any) -> None:
        try:
            outcome, error = _attempt(call, given), None
        except BaseException as caught:
            outcome, error = None, caught
        answers.put((number, time.monotonic(), outcome, error))

    def begin(part: Inputs, given: Sequence[Any]) -> None:
        own = [part, [None] * len(given), len(given)]  # outcomes, and how many are missing
        waiting.extend((own, place, one) for place, one in enumerate(given))

    def end(own: list, place: int, outcome: Outcome) -> None:
        own[1][place] = outcome
        own[2] -= 1
        if not own[2]:
            own[0].answered(own[1])
            if given := own[0].calls():
                later.append((time.monotonic() + wait_seconds, own[0], given))
            else:
                done.add(id(own[0]))

    parts, more = iter(parts), True
    while True:
        while later and later[0][0] <= time.monotonic():
            _, part, given = later.popleft()
            begin(part, given)
        while len(started) < in_flight and (waiting or (more and held < ahead)):
            if waiting:
                own, place, given = waiting.popleft()
                started[numbers] = (time.monotonic(), own, place)
                threading.Thread(target=run, args=(numbers, given), daemon=True).start()
                numbers += 1
            elif (part := next(parts, None)) is None:
                more = False
            else:
                unfinished.append(part)
                held += part.size
                if given := part.calls():
                    begin(part, given)
                else:
                    done.add(id(part))
        while unfinished and id(unfinished[0]) in done:
            part = unfinished.popleft()
            done.remove(id(part))
            held -= part.size
            yield part
        if not unfinished and not more:
            return
        if not started and not later:
            continue
        ends = [begun + deadline_seconds for begun, _, _ in islice(started.values(), 1)]  # calls begin in order and have one deadline
        ends += [due for due, _, _ in islice(later, 1)]
        try:
            number, at, outcome, error = answers.get(timeout=max(min(ends) - time.monotonic(), 0.001))
        except queue.Empty:
            now = time.monotonic()
            for number in [n for n, (begun, _, _) in started.items() if now >= begun + deadline_seconds]:
                _, own, place = started.pop(number)
                end(own, place, Outcome(error=TIMEOUT))
            continue
        if number not in started:
            continue  # given up before
        if error is not None:
            raise error
        begun, own, place = started.pop(number)
        # a part may have been long in coming meanwhile: the time of the answer counts
        end(own, place, outcome if at <= begun + deadline_seconds else Outcome(error=TIMEOUT))
