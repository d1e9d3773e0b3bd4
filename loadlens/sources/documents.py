"""Nested run documents of any length, in parts.

A document is cut at the ends of its phases, and a very long phase at the ends of its steps. Each part is a document of its own
with the run's fields and some of the phases, and tells their positions; nothing holds more than a part and a block of text.
Where a document opens and closes is a matter of what stands before, so a file is read in order, by one task: in Python, over
blocks of bytes, of which only the brackets and quotes are looked at.
"""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

QUOTE, BACKSLASH = ord('"'), ord("\\")
#: Bytes that matter, and how they change the depth.
MARKS = np.zeros(256, bool)
MARKS[[ord(c) for c in '"{}[]']] = True
STEP_OF = np.zeros(256, np.int64)
STEP_OF[[ord("{"), ord("[")]], STEP_OF[[ord("}"), ord("]")]] = 1, -1
#: Depth inside a document, the list of phases, a phase, the list of its steps, and a step.
DOCUMENT, PHASES, PHASE, STEPS, STEP = range(1, 6)

Part = tuple[int, int, bytes]
OUT = "file string, first_phase int, first_step int, value binary"
_OUT = pa.schema([("file", pa.string()), ("first_phase", pa.int32()), ("first_step", pa.int32()), ("value", pa.binary())])


def _is_list(before: bytes, name: bytes) -> bool:
    """Whether the bracket that follows ``before`` opens the field ``name``."""
    return re.search(rb'(?<!\\)"' + name + rb'"\s*:\s*$', before[-200:]) is not None


def _outside_strings(block: np.ndarray, in_string: bool, slashes: int) -> tuple[np.ndarray, np.ndarray, bool, int]:
    """Positions of brackets outside strings and their change of depth; whether the block ends in a string, and behind how many
    backslashes. ``in_string`` and ``slashes`` tell the same of what was before."""
    marks = np.flatnonzero(MARKS[block])
    kinds = block[marks]
    quotes = kinds == QUOTE
    at = marks[quotes]
    run, back = np.zeros(len(at), np.int64), at - 1
    live = np.flatnonzero((back >= 0) & (block[back] == BACKSLASH))
    run[(at == 0)] += slashes
    while len(live):  # a round for every backslash of the longest row of them
        run[live] += 1
        back[live] -= 1
        run[live[back[live] < 0]] += slashes
        live = live[(back[live] >= 0) & (block[back[live]] == BACKSLASH)]
    real = np.zeros(len(marks), np.int64)
    real[quotes] = run % 2 == 0
    count = np.cumsum(real) + in_string
    ending = 0
    while ending < len(block) and block[-1 - ending] == BACKSLASH:
        ending += 1
    kept = ~quotes & (count % 2 == 0)
    return marks[kept], STEP_OF[kinds[kept]], bool((count[-1] if len(count) else in_string) % 2), ending + (slashes if ending == len(block) else 0)


class Cutter:
    """Takes the bytes of one file and gives ``(first_phase, first_step, text)`` of its parts, each of about ``size`` bytes.

    Offsets count from the start of the file; ``text`` holds what is still needed, from ``base`` on.
    """

    def __init__(self, size: int):
        self.size, self.text, self.base = size, b"", 0
        self.depth, self.in_string, self.slashes = 0, False, 0
        self.start = self.head = self.part = self.phase = self.long = None
        self.listed = self.done = self.given = False  # inside the list of phases; behind the document; some part was given
        self.first, self.last, self.end = 0, -1, 0  # positions of the part's first phase and the last phase, and where that ended
        self.deep: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def cut(self, at: int, to: int) -> bytes:
        return self.text[at - self.base : to - self.base]

    def take(self, block: np.ndarray) -> Iterator[Part]:
        if self.done or not len(block):
            return
        start = self.base + len(self.text)
        self.text += block.tobytes()
        marks, change, self.in_string, self.slashes = _outside_strings(block, self.in_string, self.slashes)
        depths, marks, opening = self.depth + np.cumsum(change), marks + start, change > 0
        self.depth = int(depths[-1]) if len(depths) else self.depth
        main = np.flatnonzero(depths <= np.where(opening, PHASE, PHASES))
        deep = np.flatnonzero((depths > np.where(opening, PHASE, PHASES)) & (depths <= np.where(opening, STEP, STEPS)))
        since = 0  # of the phase that is open, what lies in this block
        inner = lambda to: (lambda i: (marks[i], opening[i], depths[i]))(deep[np.searchsorted(deep, since) : np.searchsorted(deep, to)])
        for i, at, opens, depth in zip(main.tolist(), marks[main].tolist(), opening[main].tolist(), depths[main].tolist(), strict=True):
            if self.listed and opens:
                yield from self.phase_starts(at)
                since = i
            elif self.listed and depth == PHASES:
                if self.long is not None:
                    self.long.follow([inner(i)])
                    for step, text in self.long.slices(at):
                        yield self.last, step, self.head + text + b"]}"
                    self.given, self.long = True, None
                self.phase, self.end = None, at + 1
            elif self.listed:
                self.listed = False
                if self.part is None:  # behind a long phase: there may be elements that are no objects
                    comma = self.cut(self.end, at).find(b",")
                    self.part, self.first = (self.end + comma + 1 if comma >= 0 else at), self.last + 1
            elif opens and depth == DOCUMENT and self.start is None:
                self.start = at
            elif opens and depth == PHASES and self.head is None and self.cut(at, at + 1) == b"[" and _is_list(self.cut(max(self.base, at - 200), at), b"phases"):
                self.listed, self.head, self.part, self.end = True, self.cut(self.start, at + 1), at + 1, at + 1
            elif not opens and depth <= 0:
                if self.start is not None:
                    self.given = True
                    yield (0, 0, self.cut(self.start, at + 1)) if self.head is None else (self.first, 0, self.head + self.cut(self.part, at + 1))
                self.done, self.text = self.given, b"" if self.given else self.text
                return
        if self.phase is not None:
            self.deep.append(inner(len(marks)))
            if self.long is None and start + len(block) - self.phase > 2 * self.size:
                yield from self.before(self.phase)
                self.long = LongPhase(self, self.phase)
            if self.long is not None:
                self.long.follow(self.deep)
                self.deep = []
        if self.start is not None:
            keep = self.start if self.head is None else self.long.keep if self.long is not None else self.end if self.part is None else self.part
            self.text, self.base = self.text[keep - self.base :], keep

    def phase_starts(self, at: int) -> Iterator[Part]:
        between = self.cut(self.end, at)  # more than one comma where an element between is no object
        if self.last >= 0 and (self.part is None or self.end - self.part >= self.size):
            if self.part is not None:
                self.given = True
                yield self.first, 0, self.head + self.cut(self.part, self.end) + b"]}"
            self.part, self.first = self.end + between.find(b",") + 1, self.last + 1
        self.last = between.count(b",") + max(self.last, 0)
        self.phase, self.deep = at, []

    def before(self, at: int) -> Iterator[Part]:
        """What the part has before a long phase, which gets parts of its own."""
        text = self.cut(self.part, at).rstrip().removesuffix(b",")
        if text:
            self.given = True
            yield self.first, 0, self.head + text + b"]}"
        self.part = None

    def finish(self) -> Iterator[Part]:
        """A text that ends early or is no document is given as it is, and does not parse; if parts were given before, it ends with them."""
        if not self.given:
            yield 0, 0, (self.head or b"") + self.text


class LongPhase:
    """A phase of more than a part: its steps go to a temporary file in slices, since its own fields may stand behind them."""

    def __init__(self, document: Cutter, start: int):
        self.document, self.size, self.keep = document, document.size, start
        self.fields = self.behind = None  # up to the list of steps, and where that ended
        self.first, self.last, self.end = 0, -1, 0
        self.kept: list[tuple[int, int]] = []  # the first step and the length of every slice
        self.file = tempfile.TemporaryFile()

    def follow(self, events: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
        cut = self.document.cut
        for marks, opening, depths in events:
            for at, opens, depth in zip(marks.tolist(), opening.tolist(), depths.tolist(), strict=True):
                if self.fields is None:
                    if opens and depth == STEPS and cut(at, at + 1) == b"[" and _is_list(cut(max(self.keep, at - 200), at), b"steps"):
                        self.fields, self.keep, self.end = cut(self.keep, at + 1), at + 1, at + 1
                elif self.behind is None and opens and depth == STEP:
                    between = cut(self.end, at)
                    if self.last >= 0 and self.end - self.keep >= self.size:
                        self.put(self.end)
                        self.keep, self.first = self.end + between.find(b",") + 1, self.last + 1
                    self.last = between.count(b",") + max(self.last, 0)
                elif self.behind is None and not opens and depth == STEPS:
                    self.end = at + 1
                elif self.behind is None and not opens and depth == PHASE:
                    self.put(at)
                    self.behind = self.keep = at

    def put(self, to: int) -> None:
        text = self.document.cut(self.keep, to)
        self.file.write(text)
        self.kept.append((self.first, len(text)))

    def slices(self, at: int) -> Iterator[tuple[int, bytes]]:
        rest = self.document.cut(self.keep, at + 1)
        if self.fields is None:
            yield 0, rest
        else:
            self.file.seek(0)
            for first, length in self.kept:
                yield first, self.fields + self.file.read(length) + rest
        self.file.close()


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray]]:
    """The bytes of a batch, file by file: texts that follow one another lie so in memory."""
    files, values = batch.column(0), batch.column(1)
    wide = np.int64 if pa.types.is_large_string(values.type) else np.int32
    ends = np.frombuffer(values.buffers()[1], wide)[values.offset : values.offset + len(values) + 1]
    data = np.frombuffer(values.buffers()[2] or b"", np.uint8)
    one = files[0].as_py() == files[-1].as_py()
    names = [files[0].as_py()] if one else files.to_pylist()
    starts = [0] if one else [i for i, x in enumerate(names) if not i or x != names[i - 1]]
    for i, to in zip(starts, [*starts[1:], len(values)], strict=True):
        yield names[i], data[ends[i] : ends[to]]


def parts(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Texts in the order of their files (file, value) to parts of documents, as ``OUT`` names them."""
    file, cutter = None, None

    def found() -> Iterator[tuple[str, Part]]:
        nonlocal file, cutter
        for batch in batches:
            for name, block in _blocks(batch) if batch.num_rows else ():
                if name != file:
                    if cutter is not None:
                        yield from ((file, x) for x in cutter.finish())
                    file, cutter = name, Cutter(size)
                yield from ((file, x) for x in cutter.take(block))
        if cutter is not None:
            yield from ((file, x) for x in cutter.finish())

    rows, held = [], 0
    for name, (phase, step, text) in found():
        rows.append((name, phase, step, text))
        held += len(text)
        if held >= 4 * size:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), _OUT, strict=True)], schema=_OUT)
            rows, held = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), _OUT, strict=True)], schema=_OUT)
