"""Arrow maps over the byte ranges of JSON files that are cut at every ``}``.

Rows are ``file, block, length, value`` and more, in file order; a range's rows follow
each other in one task. Each piece ``value`` stands for its text and the brace it was cut at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SUMMARY = "file string, block bigint, length bigint, odd int, outside bigint, inside bigint, array boolean"
OBJECT = "value binary"
FRAGMENT = "file string, block bigint, part int, ends int, value binary"

_QUOTE, _OPEN, _CLOSE, _SLASH = 1, 2, 3, 4
_KIND = np.zeros(256, np.int8)
_KIND[ord('"')], _KIND[ord("\\")] = _QUOTE, _SLASH
_KIND[[ord(c) for c in "{["]], _KIND[[ord(c) for c in "}]"]] = _OPEN, _CLOSE
_BRACE = ord("}")
_BLANKS = (b" ", b"\t", b"\n", b"\x0b", b"\f", b"\r", b"\xef\xbb\xbf")


class _Pieces:
    """Some pieces in a row: their bytes, where each ends, and how they move the depth."""

    def __init__(self, values: pa.Array):
        values = values.cast(pa.large_binary())
        _, offsets, data = values.buffers()
        offsets = np.frombuffer(offsets, np.int64)[values.offset : values.offset + len(values) + 1]
        whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
        self.data, self.ends = whole[offsets[0] : offsets[-1]], offsets[1:] - offsets[0]
        marks = _KIND[self.data]
        slashes = np.flatnonzero(marks == _SLASH)
        if len(slashes):
            piece = np.searchsorted(self.ends, slashes, "right")
            fresh = slashes == np.append(0, self.ends)[piece]  # what ends a piece escapes nothing in the next
            fresh |= np.append(True, slashes[1:] != slashes[:-1] + 1)
            order = np.arange(len(slashes))
            escapes = (order - np.maximum.accumulate(np.where(fresh, order, 0))) % 2 == 0
            marks[slashes] = 0
            escaped = slashes[escapes] + 1
            marks[escaped[escaped < self.ends[piece[escapes]]]] = 0
        at = np.flatnonzero(marks)
        kind = marks[at]
        self.quotes = np.cumsum(kind == _QUOTE)
        self.steps = (kind == _OPEN).astype(np.int64) - (kind == _CLOSE)
        self.seen = np.searchsorted(at, self.ends)  # marks before each piece's end

    @property
    def odd(self) -> int:
        return int(self.quotes[-1]) & 1 if len(self.quotes) else 0

    def levels(self, state: int) -> tuple[np.ndarray, np.ndarray]:
        """For pieces that begin outside (0) or inside (1) a string: the change of depth up to each piece's brace, and whether that counts."""
        moved = np.append(0, np.cumsum(np.where((self.quotes + state) & 1, 0, self.steps)))[self.seen]
        counts = (np.append(0, self.quotes)[self.seen] + state) & 1 == 0
        return moved - np.cumsum(counts), counts

    def text(self, first: int, last: int) -> np.ndarray:
        """The bytes of the pieces from ``first`` to before ``last``, with their braces."""
        start = self.ends[first - 1] if first else 0
        ends = self.ends[first:last]
        return np.insert(self.data[start : ends[-1]], ends - start, _BRACE) if len(ends) else np.empty(0, np.uint8)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, tuple[str, int]]]:
    """Slices of the batches that lie in one range, each with its file and block."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        cuts = [0, n]
        for column in (batch.column("file"), batch.column("block")):
            changes = pc.not_equal(column.slice(1), column.slice(0, n - 1))
            cuts += (np.flatnonzero(changes.to_numpy(zero_copy_only=False)) + 1).tolist()
        cuts = sorted(set(cuts))
        for a, b in zip(cuts[:-1], cuts[1:]):
            run = batch.slice(a, b - a)
            yield run, (run.column("file")[0].as_py(), run.column("block")[0].as_py())


def _begins_array(text: bytes) -> bool:
    while blank := next((b for b in _BLANKS if text.startswith(b)), None):
        text = text[len(blank) :]
    return text.startswith(b"[")


def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow map: a row per range, how it moves string state and depth for either state at its start."""
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("length", pa.int64()), ("odd", pa.int32()), ("outside", pa.int64()), ("inside", pa.int64()), ("array", pa.bool_())])
    held = None
    for run, place in _runs(batches):
        if held is None or (held["file"], held["block"]) != place:
            if held is not None:
                yield pa.RecordBatch.from_pylist([held], schema)
            first = run.column("value").slice(0, 1).cast(pa.binary())[0].as_py()
            held = {"file": place[0], "block": place[1], "length": run.column("length")[0].as_py(), "odd": 0, "outside": 0, "inside": 0, "array": _begins_array(first)}
        pieces = _Pieces(run.column("value"))
        for name, state in (("outside", 0), ("inside", 1)):
            held[name] += int(pieces.levels((state + held["odd"]) & 1)[0][-1])
        held["odd"] = (held["odd"] + pieces.odd) & 1
    if held is not None:
        yield pa.RecordBatch.from_pylist([held], schema)


def _objects(data: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
    """The texts of ``data`` that end at ``ends``."""
    offsets = np.append(0, ends).astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])], names=["value"])


class _Range:
    """What is open in one range: string state, depth, and the text since the last end of an object."""

    def __init__(self, run: pa.RecordBatch, place: tuple[str, int]):
        first = {name: run.column(name)[0].as_py() for name in ("state", "depth", "base", "opens", "last")}
        if first["state"] is None:
            raise RuntimeError(f"the byte range at {place[1]} of {place[0]} was not summed up: files or ranges changed while they were read")
        self.place, self.state, self.depth, self.base, self.last = place, first["state"], first["depth"], first["base"], first["last"]
        self.headless = not first["opens"]  # the text up to the first end continues that of the range before
        self.carry: list[np.ndarray] = []

    def take(self, carried: np.ndarray) -> np.ndarray:
        held, self.carry = [*self.carry, carried], []
        return np.concatenate(held)

    def fragment(self, part: int, ends: int, text: np.ndarray) -> pa.RecordBatch:
        columns = [pa.array([self.place[0]], pa.string()), pa.array([self.place[1]], pa.int64()), pa.array([part], pa.int32()), pa.array([ends], pa.int32())]
        return pa.RecordBatch.from_arrays([*columns, pa.array([text.tobytes()], pa.binary())], names=["file", "block", "part", "ends", "value"])


def cut(whole: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Arrow map of pieces with their range's place: the objects that lie in one range (``whole``), or
    what ranges begin and end with that belongs to others (0, with ``ends`` 1 if an object ends there; 1)."""

    def end(held: _Range) -> Iterator[pa.RecordBatch]:
        text = held.take(np.empty(0, np.uint8))
        complete = held.last and not held.headless
        if len(text) and complete == whole:
            yield _objects(text, np.array([len(text)])) if whole else held.fragment(1, 0, text)

    def pieces_cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for run, place in _runs(batches):
            if held is None or held.place != place:
                if held is not None:
                    yield from end(held)
                held = _Range(run, place)
            pieces = _Pieces(run.column("value"))
            level, counts = pieces.levels(held.state)
            ends = np.flatnonzero(counts & (level + held.depth == held.base)) + 1
            held.state, held.depth = (held.state + pieces.odd) & 1, held.depth + int(level[-1])
            if not len(ends):
                held.carry.append(pieces.text(0, run.num_rows))
                continue
            first, final = int(ends[0]), int(ends[-1])
            if held.headless != whole:
                text = held.take(pieces.text(0, first))
                yield _objects(text, np.array([len(text)])) if whole else held.fragment(0, 1, text)
            held.headless, held.carry = False, []
            if whole and final > first:
                size = pieces.ends + np.arange(1, run.num_rows + 1)
                yield _objects(pieces.text(first, final), size[ends[1:] - 1] - size[first - 1])
            held.carry.append(pieces.text(final, run.num_rows))
        if held is not None:
            yield from end(held)

    return pieces_cut
