"""Token ids of whole texts inside a task, from the tokenizers library.

A byte-level BPE tokenizer cuts text before merging. Its pattern never lets a
token run from a character that is not white space into white space, nor from a
letter into a comma or full stop, so a text may be cut at all such places and
its ids are the ids of its parts, joined. Parts repeat a lot; each worker keeps
the ids of the short ones it has met, in tables of bounded size, and has the
library encode the others in one call.
"""

from __future__ import annotations

import hashlib
import os
import re
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from snapledger.llm.memory import give_back

# Where a text may be cut.
_CUT = re.compile(r"(?<=\S)(?=[ \n])")
_SPACE_IN_SPACE = re.compile(r"\s[ \n]")
# Texts that hold none of these cannot match the pattern above, which takes longer to find out.
_MAY_BE_SPACE_IN_SPACE = [a + b for a in " \n" for b in " \n"]
_MAY_BE_SPACE_IN_SPACE += [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
# A comma or full stop that does not follow a letter, the first character included.
_MARK_AFTER_OTHER = re.compile(r"[,.](?<![A-Za-zÀ-ÖØ-öø-ÿ][,.])")

_MARK = "\0"
_START_BYTES = [*b" \n"]
_SPACE_BYTES = [i for i in range(128) if chr(i).isspace()]

_KEEP_PARTS = 400_000  # entries of each of a worker's two tables, about 70 MB
_KEEP_IDS = 16  # times as many ids are held by a table at most, and those of one batch
_KEEP_CHARS = 40  # longer parts are not kept
_RUN = 2000  # parts that the library is given as one text

_ENCODERS: dict[str, Encoder] = {}


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def version_digest(path: str) -> str:
    """Names the tokenizer: its file's content, the library's version, the settings."""
    import tokenizers

    with open(path, "rb") as file:
        content = hashlib.sha256(file.read())
    content.update(f"|{tokenizers.__version__}|add_special_tokens=False".encode())
    return content.hexdigest()


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file; loaded once a process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def forget_encoders() -> None:
    """Drop the worker's tokenizers and their tables, at the end of a task that others do not follow."""
    _ENCODERS.clear()
    give_back()


def _has_space_in_space(text: str) -> bool:
    return any(map(text.__contains__, _MAY_BE_SPACE_IN_SPACE)) and bool(_SPACE_IN_SPACE.search(text))


class Encoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Without truncation, padding or added tokens, whatever the file says.
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.parts, self.older = _Parts(), _Parts()
        added = self.tokenizer.get_added_tokens_decoder()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size = max(vocabulary.values()) + 1
        lengths = np.zeros(self.size, np.int64)
        for token, i in vocabulary.items():
            # A character of a byte-level token stands for one byte.
            lengths[i] = len(added[i].content.encode()) if i in added else len(token)
        self.byte_lengths = lengths
        self.splittable = (
            type(self.tokenizer.pre_tokenizer).__name__ == "ByteLevel"
            and self.tokenizer.normalizer is None
            and not any(" " in t.content or t.lstrip or t.rstrip for t in added.values())
        )

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        ids, bounds = self.encode_flat(texts)
        ids, bounds = ids.tobytes(), (4 * bounds).tolist()
        return [ids[a:b] for a, b in zip(bounds, bounds[1:])]

    def encode_flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the bounds of each text's."""
        if not self.splittable:
            return _joined(self._whole(texts))
        cut = pc.split_pattern(pa.array([self._marked(text) for text in texts], pa.large_string()), _MARK)
        named = cut.flatten().dictionary_encode()
        if self.parts.full():
            # Parts that are still in use move from the older table to the newer.
            self.older, self.parts = self.parts, _Parts()
        slots = self._find(named.dictionary)
        # The ids of the different parts lie end to end; each place in a text takes its part's.
        ids, ends = self.parts.take(slots[named.indices.to_numpy()])
        bounds = ends[cut.offsets.to_numpy()]
        # The library itself encodes texts that hold the mark.
        odd = [i for i, text in enumerate(texts) if _MARK in text]
        if odd:
            own = [ids[a:b] for a, b in zip(bounds, bounds[1:])]
            for i, found in zip(odd, self._whole([texts[i] for i in odd])):
                own[i] = found
            return _joined(own)
        return ids, bounds

    def _find(self, parts: pa.LargeStringArray) -> np.ndarray:
        """Slots of different parts in the worker's newer table, which gains those it lacks."""
        names = parts.to_numpy(zero_copy_only=False)
        short = pc.utf8_length(parts).to_numpy() <= _KEEP_CHARS
        slots = self.parts.slots(names.tolist())
        absent = np.flatnonzero(slots < 0)
        if self.older.n_slots:
            known = self.older.slots(names[absent].tolist())
            old, known = absent[known >= 0], known[known >= 0]
            ids, ends = self.older.take(known)
            slots[old] = self.parts.add(names[old], short[old], ids, np.diff(ends))
            absent = np.flatnonzero(slots < 0)
        if len(absent):
            at, ids, sizes = self._encode_parts(parts.take(pa.array(absent)))
            absent = absent[at]
            slots[absent] = self.parts.add(names[absent], short[absent], ids, sizes)
        return slots

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in found]

    @staticmethod
    def _marked(text: str) -> str:
        """The text with a mark at each place where it is cut; empty if it holds the mark."""
        if _MARK in text:
            return ""
        if text[:1].isspace() or _has_space_in_space(text):
            return _MARK.join(_CUT.split(text))
        text = text.replace(" ", _MARK + " ").replace("\n", _MARK + "\n")
        # Before commas and full stops only where all of them follow a letter.
        if not _MARK_AFTER_OTHER.search(text):
            text = text.replace(",", _MARK + ",").replace(".", _MARK + ".")
        return text

    def _encode_parts(self, parts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which part, ids end to end and number of ids, of each part in an order of its own."""
        # Parts that start with white space and do not end with it may stand side by side.
        offsets, content = _content(parts)
        some = np.flatnonzero(np.diff(offsets))
        first, last = content[offsets[some]], content[offsets[some + 1] - 1]
        beside = np.zeros(len(parts), bool)
        beside[some] = np.isin(first, _START_BYTES) & ~np.isin(last, _SPACE_BYTES)
        for i in some[beside[some] & (last >= 0x80)].tolist():
            beside[i] = not parts[i].as_py()[-1].isspace()
        run, alone = np.flatnonzero(beside), np.flatnonzero(~beside)
        ids, sizes = self._encode_run(parts.take(pa.array(run)))
        if len(alone):
            more, bounds = _joined(self._whole(parts.take(pa.array(alone)).to_pylist()))
            ids, sizes = np.concatenate([ids, more]), np.concatenate([sizes, np.diff(bounds)])
        return np.concatenate([run, alone]), ids, sizes

    def _encode_run(self, run: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids end to end and number of ids of parts that may stand side by side."""
        offsets, content = _content(run)
        found, sizes = [], []
        for a in range(0, len(run), _RUN):
            ends = offsets[a : a + _RUN + 1]
            text = content[ends[0] : ends[-1]].tobytes().decode()
            ids = self._whole([text])[0]
            ends = ends[1:] - ends[0]
            token_ends = np.cumsum(self.byte_lengths[ids])
            at = np.searchsorted(token_ends, ends)
            if token_ends[-1] == ends[-1] and np.array_equal(token_ends[at], ends):
                found.append(ids)
                sizes.append(np.diff(at + 1, prepend=0))
            else:
                alone = self._whole(run.slice(a, _RUN).to_pylist())
                found += alone
                sizes.append([*map(len, alone)])
        return _joined(found)[0], np.concatenate([np.zeros(0, np.int64), *sizes])


def _content(texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """Where the bytes of each text begin and end, and all bytes."""
    _, offsets, content = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if offsets else np.zeros(1, int)
    return bounds, np.frombuffer(content or b"", np.uint8)


class _Parts:
    """Ids of parts, end to end in one array; a part's slot tells where they lie."""

    def __init__(self):
        self.names: dict[str, int] = {}
        # The ids of a slot lie between its bound and the next.
        self.ids, self.bounds = np.zeros(0, np.uint32), np.zeros(1, np.int64)
        self.n_ids = self.n_slots = 0

    def full(self) -> bool:
        return self.n_slots > _KEEP_PARTS or self.n_ids > _KEEP_IDS * _KEEP_PARTS

    def slots(self, names: list[str]) -> np.ndarray:
        """The slot of each part, -1 where there is none."""
        return np.fromiter(map(self.names.get, names, repeat(-1)), np.int64, len(names))

    def add(self, names: np.ndarray, short: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """New slots for parts. Those that are not short cannot be found by name later."""
        at, slot = self.n_ids, self.n_slots
        self.n_ids, self.n_slots = at + len(ids), slot + len(sizes)
        self.ids = _room(self.ids, self.n_ids)
        self.bounds = _room(self.bounds, self.n_slots + 1)
        self.ids[at : self.n_ids] = ids
        self.bounds[slot + 1 : self.n_slots + 1] = at + np.cumsum(sizes)
        new = np.arange(slot, self.n_slots)
        self.names.update(zip(names[short].tolist(), new[short].tolist()))
        return new

    def take(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the slots end to end, and where each slot's begin and end."""
        starts = self.bounds[slots]
        sizes = self.bounds[slots + 1] - starts
        ends = np.zeros(len(slots) + 1, np.int64)
        np.cumsum(sizes, out=ends[1:])
        at = np.repeat(starts - ends[:-1], sizes)
        at += np.arange(len(at))
        return self.ids[at], ends


def _room(values: np.ndarray, n: int) -> np.ndarray:
    """The array, or one that begins with it and has room for ``n`` values."""
    if n <= len(values):
        return values
    grown = np.empty(max(n, len(values) + len(values) // 4), values.dtype)
    grown[: len(values)] = values
    return grown


def _joined(found: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Arrays end to end, and their bounds."""
    bounds = np.cumsum([0, *map(len, found)])
    return np.concatenate(found or [np.zeros(0, np.uint32)]), bounds


def batches(texts: list, chars: int = 500_000):
    """Cut a column of texts into runs of a bounded number of characters; null is empty."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size > chars and i > start:
            yield start, i
            start, size = i, len(text or "")
    if start < len(texts):
        yield start, len(texts)


def encode_column(path: str, column) -> list[bytes]:
    """Ids of every row of an Arrow text column; null is the empty text."""
    texts = [t or "" for t in column.to_pylist()]
    tool, out = encoder(path), []
    for a, b in batches(texts):
        out += tool.encode(texts[a:b])
    return out
