"""Byte-level BPE over batches of texts, one computation for each distinct piece.

The splitter of the byte-level vocabularies cuts a text into pieces (contractions, words,
numbers, symbols, each with one leading space, and white space) and merges never cross
pieces. Here pieces are cut with array operations on code points, and every distinct piece
is encoded once by the library (:meth:`PieceCoder.ids`) or once by the prefix dynamic
programme (:meth:`PieceCoder.prefix_counts`); the worker remembers them up to a bound.

Texts that hold the vocabulary's special string are cut there first, as the library does.
"""

from __future__ import annotations

import os
import unicodedata
from dataclasses import dataclass
from itertools import chain

import numpy as np

from lendlayer.llm.textkit import U64, mix, span_hashes

# Fixed values of the byte-level splitter: contractions it cuts off after an apostrophe.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")

LETTER, NUMBER, BLANK, OTHER = 0, 1, 2, 3
# White space as the splitter's \s has it.
_BLANKS = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)

#: Bytes of a piece up to which the prefix programme runs on arrays.
WIDE = 32
_ROLL = U64(0x2545F4914F6CDD1D)
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * U64(0xD1342543DE82EF95))

#: Pieces that a worker remembers at most; beyond it starts anew (results are the same).
REMEMBER = 600_000

_tables: list[np.ndarray] = []


def char_classes() -> tuple[np.ndarray, np.ndarray]:
    """Class and scrambled 64-bit symbol of every code point (built once per worker)."""
    if not _tables:
        kinds = np.full(0x110000, OTHER, dtype=np.uint8)
        major = {"L": LETTER, "N": NUMBER}
        for c in range(0x110000):
            k = major.get(unicodedata.category(chr(c))[0])
            if k is not None:
                kinds[c] = k
        kinds[list(_BLANKS)] = BLANK
        _tables.extend([kinds, mix(np.arange(1, 0x110001, dtype=np.uint64) * U64(0x9E3779B97F4A7C15))])
    return _tables[0], _tables[1]


@dataclass
class Pieces:
    """Pieces of several texts laid end to end: spans, rows, and white space before a body.

    ``blank_ends`` are the last positions of white-space runs of two or more characters
    that a further piece of the same text follows.
    """

    codes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    blank_starts: np.ndarray
    blank_ends: np.ndarray


def split_pieces(text: str, bounds: np.ndarray) -> Pieces:
    """Cut the texts ``text[bounds[i]:bounds[i+1]]`` into pieces."""
    kinds, _ = char_classes()
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    n = len(codes)
    if n == 0:
        none = np.empty(0, np.int64)
        return Pieces(codes, none, none, np.zeros(len(bounds), np.int64), none, none)
    kind = kinds[codes]
    change = np.empty(n, dtype=bool)
    change[0] = True
    np.not_equal(kind[1:], kind[:-1], out=change[1:])
    edge = np.zeros(n + 1, dtype=bool)
    edge[bounds] = True
    change |= edge[:n]
    starts = np.flatnonzero(change)
    ends = np.append(starts[1:], n)
    blank = kind[starts] == BLANK
    # Runs of white space with a body after them in the same text give their last character away.
    inner = blank & ~edge[ends]
    begin = change.copy()
    last = ends[inner] - 1
    joined = codes[last] == 0x20
    begin[last] = True  # a run of one keeps its own start, which is the same position
    begin[last[joined] + 1] = False  # the body goes on from the space
    # Contractions: an apostrophe alone in its run, not led by a space, and letters after it.
    at = np.flatnonzero(
        (codes[starts] == 0x27) & (ends - starts == 1) & ~edge[ends] & begin[starts]
    )
    at = at[kind[np.minimum(ends[at], n - 1)] == LETTER]
    for run in at.tolist():
        a = int(starts[run])
        stop = int(ends[run + 1])
        head = text[a : min(a + 3, stop)]
        suffix = next((c for c in CONTRACTIONS if head.startswith(c)), None)
        if suffix:
            begin[a + 1] = False
            if a + len(suffix) < stop:
                begin[a + len(suffix)] = True
    piece_starts = np.flatnonzero(begin)
    piece_ends = np.append(piece_starts[1:], n)
    long_run = ends[inner] - starts[inner] >= 2
    return Pieces(
        codes, piece_starts, piece_ends, np.searchsorted(piece_starts, bounds), starts[inner][long_run], last[long_run]
    )


def piece_keys(pieces: Pieces) -> np.ndarray:
    _, symbols = char_classes()
    return span_hashes(symbols[pieces.codes], pieces.starts, pieces.ends)


def spans_of(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Positions first[i] .. first[i]+length[i]-1, one span after another."""
    total = int(length.sum())
    ahead = np.cumsum(length) - length
    return np.repeat(first - ahead, length) + np.arange(total)


class _Store:
    """Variable-length rows by 64-bit key: an open-addressing table over flat arrays."""

    def __init__(self, dtype) -> None:
        self.dtype = dtype
        self.clear()

    def clear(self) -> None:
        self.slots = np.zeros(1 << 17, dtype=np.uint64)  # key, 0 for none
        self.place = np.zeros(1 << 17, dtype=np.int32)  # row of the key
        self.flat = np.empty(1 << 17, dtype=self.dtype)
        self.start = np.zeros(1 << 16, dtype=np.int64)
        self.length = np.zeros(1 << 16, dtype=np.int64)
        self.count = self.used = 0

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, or the free slot where it belongs."""
        mask = U64(len(self.slots) - 1)
        slot = keys & mask
        open_ = np.flatnonzero((self.slots[slot] != keys) & (self.slots[slot] != 0))
        while len(open_):
            slot[open_] = (slot[open_] + U64(1)) & mask
            at = self.slots[slot[open_]]
            open_ = open_[(at != keys[open_]) & (at != 0)]
        return slot

    def _place(self, keys: np.ndarray, rows: np.ndarray) -> None:
        left = np.arange(len(keys))
        while len(left):
            slot = self._find(keys[left])
            self.slots[slot] = keys[left]  # of keys that meet in a free slot the last one gets it
            won = self.slots[slot] == keys[left]
            self.place[slot[won]] = rows[left[won]]
            left = left[~won]

    def add(self, keys: np.ndarray, rows: list) -> None:
        n, lengths = self.count, np.fromiter(map(len, rows), dtype=np.int64, count=len(rows))
        total = int(lengths.sum())
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        while n + len(rows) > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.length = np.concatenate([self.length, np.zeros_like(self.length)])
        self.length[n : n + len(rows)] = lengths
        self.start[n : n + len(rows)] = self.used + np.cumsum(lengths) - lengths
        self.flat[self.used : self.used + total] = np.fromiter(chain.from_iterable(rows), dtype=self.dtype, count=total)
        self.used += total
        self.count += len(rows)
        if 2 * self.count > len(self.slots):
            full = np.flatnonzero(self.slots)
            old = self.slots[full], self.place[full]
            size = 1 << (4 * self.count - 1).bit_length()
            self.slots, self.place = np.zeros(size, dtype=np.uint64), np.zeros(size, dtype=np.int32)
            self._place(*old)
        self._place(keys, np.arange(n, n + len(rows), dtype=np.int32))

    def rows(self, distinct: np.ndarray, make) -> np.ndarray:
        """Row number of each distinct key; ``make(positions)`` gives the rows not yet known."""
        distinct = np.maximum(distinct, U64(1))
        if self.count + len(distinct) > REMEMBER and self.count:
            self.clear()
        slot = self._find(distinct)
        missing = np.flatnonzero(self.slots[slot] == 0)
        if len(missing):
            self.add(distinct[missing], make(missing))
            slot = self._find(distinct)
        return self.place[slot]


def _byte_letters() -> dict[int, str]:
    """The printable stand-in that byte-level vocabularies use for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return {b: chr(b) if b in set(plain) else chr(next(spare)) for b in range(256)}


class _Vocabulary:
    """Token ids by rolling hash of their bytes."""

    def __init__(self, vocabulary: dict[str, int], letters: dict[int, str]) -> None:
        byte = {c: b for b, c in letters.items()}
        keys = np.zeros(len(vocabulary), dtype=np.uint64)
        for k, token in enumerate(vocabulary):
            h = 0
            for c in token:
                h = (h * int(_ROLL) + int(_BYTES[byte[c]])) % (1 << 64)
            keys[k] = h
        self.table = _Store(np.int32)
        self.table.add(keys, [[i] for i in vocabulary.values()])

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Id of each key, -1 where no token has it."""
        t = self.table
        slot = t._find(keys)
        return np.where(t.slots[slot] == keys, t.flat[t.start[t.place[slot]]], -1)


class PieceCoder:
    """One vocabulary of the ``tokenizers`` library, with what this worker has encoded so far."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = sorted(
            ((t.content, i) for i, t in self.library.get_added_tokens_decoder().items() if t.special), key=lambda x: -len(x[0])
        )
        self.vocabulary = self.library.get_vocab(with_added_tokens=False)
        self.longest = max(map(len, self.vocabulary))
        self.letters = _byte_letters()
        self.pairs: dict[tuple[str, str], bool] = {}
        self.names = {i: t for t, i in self.vocabulary.items()}
        self.known_pairs = _Store(np.int8)
        self.tokens = _Vocabulary(self.vocabulary, self.letters)
        self.known_ids = _Store(np.uint32)
        self.known_counts = _Store(np.int8)
        self.newline = self.vocabulary[self.letters[0x0A]]

    # -- the prefix dynamic programme ---------------------------------------------------

    def _stays(self, a: str, b: str) -> bool:
        """Whether the vocabulary keeps tokens a and b apart when they stand side by side."""
        ok = self.pairs.get((a, b))
        if ok is None:
            if len(self.pairs) > 4 * REMEMBER:
                self.pairs.clear()
            made = self.library.model.tokenize(a + b)
            ok = self.pairs[a, b] = len(made) == 2 and made[0].value == a
        return ok

    def prefix_counts(self, piece: str) -> list[int]:
        """Tokens of every prefix of one piece, by character.

        ``last[i]`` is the one token that can end an encoding of the first i bytes: the
        encoding before it is that of the shorter prefix, and the token must not merge
        with the last one there. So each prefix's count is one more than a shorter one's.
        """
        raw = piece.encode("utf-8", "surrogatepass")
        word = "".join(map(self.letters.__getitem__, raw))
        n = len(word)
        last = [""] * (n + 1)
        count = [0] * (n + 1)
        vocabulary, stays = self.vocabulary, self._stays
        for i in range(1, n + 1):
            for j in range(max(0, i - self.longest), i):
                token = word[j:i]
                if token in vocabulary and (j == 0 or (last[j] and stays(last[j], token))):
                    last[i], count[i] = token, count[j] + 1
                    break
        if n == len(piece):
            out = count[1:]
        else:
            out = [count[i] for i in range(1, n + 1) if i == n or raw[i] & 0xC0 != 0x80]
        if piece in CONTRACTIONS and len(piece) == 3:
            out[1] = 2  # cut short, it is no contraction but an apostrophe and a letter
        return out

    def _pair_keeps(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """:meth:`_stays` for arrays of token ids; each distinct pair is asked once."""
        key = mix((a.astype(np.uint64) << U64(32) | b.astype(np.uint64)) + U64(1))
        distinct, first, inverse = np.unique(key, return_index=True, return_inverse=True)
        name, tokenize = self.names, self.library.model.tokenize

        def ask(which: np.ndarray) -> list[list[int]]:
            out = []
            for x, y in zip(a[first[which]].tolist(), b[first[which]].tolist()):
                made = tokenize(name[x] + name[y])
                out.append([int(len(made) == 2 and made[0].id == x)])
            return out

        rows = self.known_pairs.rows(distinct, ask)
        return self.known_pairs.flat[self.known_pairs.start[rows]][inverse] > 0

    def _prefix_steps(self, pieces: list[str]) -> list[list[int]]:
        """Steps of :meth:`prefix_counts` for many pieces at once.

        Short pieces go through the same programme column by column, all of them together;
        the rare long ones go one at a time.
        """
        out: list[list[int]] = [[] for _ in pieces]
        short = []
        for k, piece in enumerate(pieces):
            if len(piece) <= WIDE and piece not in CONTRACTIONS:
                raw = piece.encode("utf-8", "surrogatepass")
                if len(raw) <= WIDE:
                    short.append((k, raw))
                    continue
            counts = self.prefix_counts(piece)
            out[k] = [y - x for x, y in zip([0, *counts], counts)]
        if not short:
            return out
        size = np.array([len(r) for _, r in short])
        grid = np.frombuffer(b"".join(r.ljust(WIDE, b"\0") for _, r in short), dtype=np.uint8).reshape(-1, WIDE)
        n, wide = len(short), int(size.max())
        sums = np.zeros((wide + 1, n), dtype=np.uint64)
        with np.errstate(over="ignore"):
            for i in range(wide):
                sums[i + 1] = sums[i] * _ROLL + _BYTES[grid[:, i]]
        last = np.zeros((wide + 1, n), dtype=np.int64)
        count = np.zeros((wide + 1, n), dtype=np.int16)
        for i in range(1, wide + 1):
            todo = np.flatnonzero(size >= i)
            for j in range(max(0, i - self.longest), i):
                with np.errstate(over="ignore"):
                    seen = sums[i, todo] - sums[j, todo] * U64(pow(int(_ROLL), i - j, 1 << 64))
                token = self.tokens.get(seen)
                hit = np.flatnonzero(token >= 0)
                if j and len(hit):
                    hit = hit[self._pair_keeps(last[j, todo[hit]], token[hit])]
                if len(hit):
                    at = todo[hit]
                    last[i, at] = token[hit]
                    count[i, at] = count[j, at] + 1
                    todo = np.delete(todo, hit)
                    if not len(todo):
                        break
        # Only prefixes of whole characters: the last byte of each.
        ends = np.ones((n, wide), dtype=bool)
        ends[:, :-1] = (grid[:, 1:wide] & 0xC0) != 0x80
        ends &= np.arange(wide) < size[:, None]
        ends[np.arange(n), size - 1] = True
        values = count[1:].T[ends].tolist()
        stop = np.cumsum(ends.sum(axis=1)).tolist()
        start = 0
        for (k, _), end in zip(short, stop):
            counts = values[start:end]
            out[k] = [y - x for x, y in zip([0, *counts], counts)]
            start = end
        return out

    # -- batches ------------------------------------------------------------------------

    def _segments(self, texts: list[str]) -> tuple[list[str], list[int], list[int]]:
        """Texts cut at special strings: segments, their rows, and the special id after each (-1: none)."""
        parts, rows, after = [], [], []
        for row, text in enumerate(texts):
            while True:
                found = [(text.find(s), -len(s), s, i) for s, i in self.special]
                found = [f for f in found if f[0] >= 0]
                if not found:
                    break
                at, _, s, i = min(found)
                parts.append(text[:at])
                rows.append(row)
                after.append(i)
                text = text[at + len(s) :]
            parts.append(text)
            rows.append(row)
            after.append(-1)
        return parts, rows, after

    def _pieces(self, parts: list[str], store: _Store, make) -> tuple[Pieces, np.ndarray, str]:
        text = "".join(parts)
        bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        pieces = split_pieces(text, bounds)
        if not len(pieces.starts):
            return pieces, np.empty(0, np.int64), text
        distinct, first, inverse = np.unique(piece_keys(pieces), return_index=True, return_inverse=True)

        def missing(which: np.ndarray) -> list:
            at = first[which]
            return make([text[a:b] for a, b in zip(pieces.starts[at].tolist(), pieces.ends[at].tolist())])

        return pieces, store.rows(distinct, missing)[inverse], text

    def _encode(self, pieces: list[str]) -> list[list[int]]:
        """Ids of distinct pieces: one text with a piece a line, as merges never cross lines."""
        lines = [p for p in pieces if "\n" not in p and not p.isspace()]
        made = self.library.encode("\n".join(lines), add_special_tokens=False).ids if lines else []
        found: list[list[int]] = [[]]
        for i in made:
            if i == self.newline:
                found.append([])
            else:
                found[-1].append(i)
        rest = iter(found)
        return [
            next(rest) if "\n" not in p and not p.isspace() else self.library.encode(p, add_special_tokens=False).ids for p in pieces
        ]

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """Token ids of each text, as the library gives them without added tokens."""
        parts, rows, after = self._segments(texts)
        store = self.known_ids
        pieces, which, _ = self._pieces(parts, store, self._encode)
        length = store.length[which]
        flat = store.flat[spans_of(store.start[which], length)]
        edges = np.concatenate([[0], np.cumsum(length)])[pieces.bounds]
        if len(parts) == len(texts):
            return [flat[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
        out: list[list[np.ndarray]] = [[] for _ in texts]
        for k, row in enumerate(rows):
            out[row].append(flat[edges[k] : edges[k + 1]])
            if after[k] >= 0:
                out[row].append(np.array([after[k]], dtype=np.uint32))
        return [np.concatenate(x) for x in out]

    def count_steps(self, texts: list[str]) -> list[np.ndarray]:
        """For each text, by how much the token count grows (or falls) with each character.

        The running sum is the exact token count of every prefix of the text.
        """
        parts, rows, after = self._segments(texts)
        store = self.known_counts
        pieces, which, text = self._pieces(parts, store, self._prefix_steps)
        steps = store.flat[spans_of(store.start[which], store.length[which])].astype(np.int16)
        # A prefix that ends with a whole white-space run has it as one piece.
        for a, b in zip(pieces.blank_starts.tolist(), pieces.blank_ends.tolist()):
            run = text[a : b + 1]
            off = self.prefix_counts(run)[-1] - self.prefix_counts(run[:-1])[-1] - int(steps[b])
            steps[b] += off
            steps[b + 1] -= off
        edges = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).tolist()
        if len(parts) == len(texts):
            return [steps[a:b] for a, b in zip(edges[:-1], edges[1:])]
        names = {i: s for s, i in self.special}
        out: list[list[np.ndarray]] = [[] for _ in texts]
        for k, row in enumerate(rows):
            out[row].append(steps[edges[k] : edges[k + 1]])
            if after[k] >= 0:
                out[row].append(self._special_steps(parts[k], names[after[k]]))
        return [np.concatenate(x) for x in out]

    def _special_steps(self, before: str, special: str) -> np.ndarray:
        """Steps over a special string: cut short it is ordinary text that joins the piece before it."""
        pieces = split_pieces(before, np.array([0, len(before)]))
        body = [a for a, b in zip(pieces.starts.tolist(), pieces.ends.tolist()) if not before[a:b].isspace()]
        tail = before[body[-1] :] if body else before
        plain = lambda t: sum(self._plain_count(t))
        base = plain(tail)
        totals = [0, *(plain(tail + special[:j]) - base for j in range(1, len(special))), 1]
        return np.diff(np.array(totals)).astype(np.int16)

    def _plain_count(self, text: str) -> list[int]:
        pieces = split_pieces(text, np.array([0, len(text)]))
        return [self.prefix_counts(text[a:b])[-1] for a, b in zip(pieces.starts.tolist(), pieces.ends.tolist())]


_coders: dict[str, PieceCoder] = {}


def coder(path: str) -> PieceCoder:
    """The worker's coder for a vocabulary file."""
    if path not in _coders:
        _coders[path] = PieceCoder(path)
    return _coders[path]
