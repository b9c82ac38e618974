"""Token ids of many texts, with each distinct word of a batch encoded once.

Arrow cuts texts into units that the tokenizer never joins, numbers the distinct ones, and numpy puts their ids together again, so the only
Python work is on units that are new to the task.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MARKS = ".,;:!?*&%$#|()"
# Unicode's white space, as tokenizers' \s has it.
SPACE = r"\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
CUT = "\x1f"
# A word of Latin letters, with the blank before it, and the marks after it; and words that no normalizer changes.
MARKED_WORD = f"^(?P<stem>[ \n]?[A-Za-zÀ-ÖØ-öø-ɏ]+)(?P<tail>[{re.escape(MARKS)}]*)$"
PLAIN_WORD = "^ ?[A-Za-zÀ-ÖØ-öø-ÿ]+$"
LOWER_WORD = "^[a-zß-öø-ÿ]+$"
ASCII_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
WIDE_SPACE = r"[\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
# Units that a Python worker keeps from task to task, about 40 MB; only those that come OFTEN in a batch.
FREQUENT = 200_000
OFTEN = 3

_frequent: dict[tuple, dict[str, bytes]] = {}


@lru_cache(maxsize=2)
def loaded(path: str, special: bool = True):
    """The tokenizer of a file, which a Python worker keeps; ``special``: whether the names of special tokens stand for these."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = not special
    return tokenizer


def byte_letters() -> dict[int, str]:
    """Byte-level tokenizers write a byte as one character: itself where it is visible, the others from U+0100 on in order."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + k) for k, b in enumerate(hidden)}


LETTERS = byte_letters()


def words(texts: pa.Array) -> pa.ListArray:
    """Texts cut at ASCII blanks, which are dropped, A-Z lower-cased: for tokenizers that lower-case, drop blanks and have no use for them."""
    return pc.ascii_split_whitespace(pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts)))


def led_words(texts: pa.Array) -> pa.ListArray:
    """Texts cut before each run of white space: for byte-level tokenizers, whose pieces never have a blank behind another character."""
    if pc.any(pc.match_substring_regex(texts, WIDE_SPACE)).as_py():
        marked = pc.replace_substring_regex(texts, f"([^{SPACE}])([{SPACE}])", rf"\1{CUT}\2")
        return pc.split_pattern(marked, CUT)
    # With ASCII blanks only, the cuts are found in the bytes, which stay where they are.
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)
    first, last = int(ends[0]), int(ends[-1])
    space = ASCII_SPACE[np.frombuffer(texts.buffers()[2] or b"", np.uint8)[first:last]]
    cut = np.zeros(last - first, bool)
    cut[1:] = space[1:] & ~space[:-1]
    # An empty text is one empty unit, as split_pattern has it; a text begins a unit of its own.
    begins = ends[:-1][ends[:-1] < ends[1:]] - first
    cut[begins] = False
    inside = np.flatnonzero(cut)
    starts = np.sort(np.concatenate([inside, ends[:-1] - first]), kind="stable")
    before = np.searchsorted(inside, ends - first) + np.arange(len(ends))
    units = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer((np.r_[starts, last - first] + first).astype(np.int32)), texts.buffers()[2]])
    return pa.ListArray.from_arrays(pa.array(before.astype(np.int32)), units)


def batches_of_bytes(column: pa.Array, most: int):
    """First row and rows of the slices of a text column with about ``most`` bytes each."""
    size = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < len(column):
        before = size[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(size, before + most, "right")))
        yield lo, hi - lo
        lo = hi


def as_text(column: pa.Array) -> pa.Array:
    """Bytes as UTF-8, with what is not UTF-8 replaced."""
    try:
        return column.cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([None if v is None else v.decode("utf-8", "replace") for v in column.to_pylist()], pa.string())


class WordCoder:
    """Encodes texts for one task; ids of units are kept while they take no more than ``hold`` bytes, and forgotten with the task.

    ``kept`` names the tokenizer and its settings: coders of the same name in a worker share the ids of at most FREQUENT frequent units.
    """

    def __init__(self, tokenizer, units=words, hold: int = 32_000_000, kept: tuple | None = None):
        self.tokenizer, self.units, self.hold = tokenizer, units, hold
        self.base = {} if kept is None else _frequent.setdefault((*kept, units.__name__), {})
        # Words of letters go to the model itself, past the steps that find words, where these do nothing to them.
        self.plain = (PLAIN_WORD if tokenizer.normalizer is None else LOWER_WORD) if self._is_byte_level() else None
        self.kind = np.dtype("<u2" if tokenizer.get_vocab_size() <= 65_536 else "<u4")
        self.known: dict[str, bytes] = {}
        self.held = 0

    def _is_byte_level(self) -> bool:
        if type(self.tokenizer.model).__name__ != "BPE":
            return False
        probes = ["a", "letter", "unbelievably", "année", "größte"] + ([] if self.tokenizer.normalizer else [" a", " Letters", " Ärzte"])
        return all(self._by_model(p) == self.tokenizer.encode(p, add_special_tokens=False).ids for p in probes)

    def _by_model(self, unit: str) -> list[int]:
        return [t.id for t in self.tokenizer.model.tokenize(unit.encode().decode("latin-1").translate(LETTERS))]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and the number of ids of each text; a null text has none."""
        texts = pc.fill_null(as_text(texts), "")
        odd = pc.match_substring(texts, CUT)
        apart = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        lists = self.units(pc.if_else(odd, "", texts))
        units = lists.flatten().dictionary_encode()
        index = units.indices.to_numpy(zero_copy_only=False)
        flat, size = self._ids(units.dictionary, np.bincount(index, minlength=len(units.dictionary)))
        ids, ends = gathered(flat, size, index)
        count = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        text_end = np.r_[0, ends][np.cumsum(count)] if len(texts) else np.zeros(0, np.int64)
        length = np.diff(np.r_[0, text_end])
        if len(apart):
            # Texts with the cut mark itself are encoded whole.
            own = [np.array(e.ids, self.kind) for e in self.tokenizer.encode_batch_fast([texts[i].as_py() for i in apart.tolist()], add_special_tokens=False)]
            parts = np.split(ids, text_end[:-1])
            for i, v in zip(apart.tolist(), own):
                parts[i], length[i] = v, len(v)
            ids = np.concatenate(parts)
        return ids, length

    def _ids(self, units: pa.Array, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct units one after the other, and the number of ids of each; ``times``: how often each comes."""
        # Letters and the marks after them are coded apart: "word," as "word" and ",".
        parts = pc.extract_regex(units, MARKED_WORD)
        stem, tail = (pc.if_else(parts.is_valid(), pc.struct_field(parts, k), other).dictionary_encode() for k, other in (("stem", units), ("tail", "")))
        stem_at, tail_at = (v.indices.to_numpy(zero_copy_only=False).astype(np.int64) for v in (stem, tail))
        letters = np.zeros(len(stem.dictionary), bool)
        letters[stem_at] = parts.is_valid().to_numpy(zero_copy_only=False)
        often = np.bincount(stem_at, times, len(stem.dictionary)) >= OFTEN
        raw = self._raw(stem.dictionary, letters, often) + self._raw(tail.dictionary, np.zeros(len(tail.dictionary), bool), np.ones(len(tail.dictionary), bool))
        size = np.fromiter(map(len, raw), np.int64, len(raw)) // self.kind.itemsize
        both = np.stack([stem_at, len(stem.dictionary) + tail_at], axis=1).reshape(-1)
        ids, ends = gathered(np.frombuffer(b"".join(raw), self.kind), size, both)
        return ids, np.diff(np.r_[0, ends[1::2]])

    def _raw(self, names: pa.Array, letters: np.ndarray, often: np.ndarray) -> list[bytes]:
        """The ids of each name, as bytes; ``letters``: words of letters only, ``often``: those that the worker may keep."""
        if self.held > self.hold:
            self.known, self.held = {}, 0
        known, base, units = self.known, self.base, names.to_pylist()
        raw = [base.get(u) or known.get(u) for u in units]
        new = np.array([r is None for r in raw], bool)
        self._learn_words(names.filter(pa.array(new & letters)))
        self._learn(names.filter(pa.array(new & ~letters)).to_pylist())
        at = np.flatnonzero(new).tolist()
        for i in at:
            raw[i] = known[units[i]]
        # An entry takes about 150 bytes beside its characters.
        self.held += sum(len(units[i]) for i in at) + 150 * len(at)
        if len(base) < FREQUENT:
            for i in np.flatnonzero(often).tolist():
                if len(base) >= FREQUENT:
                    break
                base[units[i]] = raw[i]
        return raw

    def _learn(self, units: list[str]) -> None:
        for lo in range(0, len(units), 5_000):
            part = units[lo:lo + 5_000]
            for u, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                self.known[u] = array("H" if self.kind.itemsize == 2 else "I", e.ids).tobytes()

    def _learn_words(self, words: pa.Array) -> None:
        if self.plain is None or not len(words):
            return self._learn_joined(words.to_pylist())
        direct = pc.match_substring_regex(words, self.plain)
        own, of, kind = words.filter(direct).to_pylist(), self.tokenizer.model.tokenize, "H" if self.kind.itemsize == 2 else "I"
        # All at once as the model writes bytes; no word has a line break.
        for u, letters in zip(own, "\n".join(own).encode().decode("latin-1").translate(LETTERS).split(LETTERS[10])):
            self.known[u] = array(kind, [t.id for t in of(letters)]).tobytes()
        self._learn_joined(words.filter(pc.invert(direct)).to_pylist())

    def _learn_joined(self, units: list[str]) -> None:
        """Words of letters only, all in one text with NUL between them, which is a token of its own there."""
        mark = self.tokenizer.encode("\0", add_special_tokens=False).ids
        if len(mark) != 1:
            return self._learn(units)
        for lo in range(0, len(units), 5_000):
            part = units[lo:lo + 5_000]
            ids = np.array(self.tokenizer.encode_batch_fast(["\0".join(part)], add_special_tokens=False)[0].ids, self.kind)
            ends = np.flatnonzero(ids == mark[0]) * self.kind.itemsize
            raw = ids.tobytes()
            for u, a, b in zip(part, [0, *(ends + self.kind.itemsize).tolist()], [*ends.tolist(), len(raw)]):
                self.known[u] = raw[a:b]


def gathered(flat: np.ndarray, size: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of runs that lie one after the other in ``flat``, with ``size`` values each, those at ``index``; and where each of these ends."""
    each = size[index]
    ends = np.cumsum(each)
    start = np.cumsum(size) - size
    return flat[np.repeat(start[index] - (ends - each), each) + np.arange(int(ends[-1]) if len(ends) else 0)], ends


def with_end(ids: np.ndarray, length: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with an end id after each text."""
    return np.insert(ids, np.cumsum(length), end), length + 1


def as_binary(ids: np.ndarray, length: np.ndarray) -> pa.Array:
    """One value of bytes per text."""
    offsets = np.r_[0, np.cumsum(length)] * ids.itemsize
    return pa.Array.from_buffers(pa.binary(), len(length), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(ids))])
