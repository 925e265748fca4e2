"""Alignment of two tokenizers over whole texts, by interval coalescing.

Both tokenizers cut a text before a space that follows a character that is not
white space: no token of either runs across that place. A text, led by a space,
is thus a list of words led by a space each, and its tokens are its words'
tokens. In each chunk of texts every different word is encoded once by both, the
tokens of all words are laid out on one line of bytes, and one pass over them in
order of their start cuts the line into groups wherever a start reaches the
greatest end so far. Inside groups the overlapping pairs are listed.

Texts keep the numbers of their words, chunks the tables of theirs. Counts of id
pairs are added up over all chunks and sent back to the chunks that hold the pair.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from snapledger.session import stage

_RUN_CHARS = 250_000
_SLICE = 500  # rows of a batch made Python objects at once
_COMPRESSION = "zstd"

# The space inside a run of white space, and where words end.
_SPACE_AFTER_SPACE = re.compile(r"\s ")
_WORD_END = re.compile(r"(?<=\S) ")
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


def words_of(text: str) -> list[str]:
    """The words of a text, each without the space that leads it; only the last can end with white space."""
    if _SPACE_AFTER_SPACE.search(text) or text[:1] == " ":
        return _WORD_END.split(text)
    return text.split(" ")


def _byte_alphabet() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable
    Latin-1 characters for themselves, the others in order from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """Tokenizer A: a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = True
        alphabet = _byte_alphabet()
        added = self.tokenizer.get_added_tokens_decoder()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes[i] = token.encode() if i in added else bytes(alphabet[c] for c in token)

    def encode(self, text: str) -> list[int]:
        """Ids of a space and ``text``."""
        return self.tokenizer.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids


class Pieces:
    """Tokenizer B: a sentencepiece model that puts a space before the text."""

    def __init__(self, path: str):
        import sentencepiece

        self.tokenizer = sentencepiece.SentencePieceProcessor(model_file=path)
        self.space = self.tokenizer.piece_to_id("▁")
        self.bytes = []
        for i in range(self.tokenizer.vocab_size()):
            piece = self.tokenizer.id_to_piece(i)
            byte = _BYTE_PIECE.fullmatch(piece) if self.tokenizer.is_byte(i) else None
            self.bytes.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode())

    def encode(self, text: str) -> list[int]:
        # At the end of a longer text a space by itself is one piece; an empty text has none.
        return self.tokenizer.encode(text, num_threads=1) if text else [self.space]


class Aligner:
    """Both tokenizers, loaded once a task, and the alignment of many words at once."""

    def __init__(self, path_a: str, path_b: str):
        self.tools = (ByteLevel(path_a), Pieces(path_b))
        self.lengths = [np.array([len(b) for b in t.bytes], np.int64) for t in self.tools]
        self.names = [[str(i) for i in range(len(t.bytes))] for t in self.tools]

    def _encode(self, word: str) -> tuple[list[int], list[int]] | None:
        """Ids of both for a space and ``word``; None where the bytes of either differ from it."""
        want = b" " + word.encode()
        both = []
        for tool in self.tools:
            ids = tool.encode(word)
            if b"".join(map(tool.bytes.__getitem__, ids)) != want:
                return None
            both.append(ids)
        return tuple(both)

    def align(self, words: list[str]) -> Words:
        """Encodes different words and coalesces their tokens. Words that do not end with
        white space stand side by side in runs; where a run's bytes differ, and for
        other words, each is encoded by itself."""
        together, alone = [], []
        for i, word in enumerate(words):
            (together if word and not word[-1].isspace() else alone).append(i)
        order, ids, sizes, valid = [], ([], []), [], np.zeros(len(words), bool)

        def add(members, both):
            order.extend(members)
            valid[members] = True
            for side in (0, 1):
                ids[side].append(np.array(both[side], np.int64))

        start = 0
        while start < len(together):
            stop, chars = start, 0
            while stop < len(together) and (chars == 0 or chars < _RUN_CHARS):
                chars += len(words[together[stop]]) + 1
                stop += 1
            run = together[start:stop]
            both = self._encode(" ".join([words[i] for i in run]))
            if both is None:
                alone.extend(run)
            else:
                add(run, both)
            start = stop
        for i in alone:
            both = self._encode(words[i])
            if both is not None:
                add([i], both)
        sizes = np.array([len(words[i].encode()) + 1 for i in order], np.int64)
        flat = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in ids]
        return Words(len(words), valid, np.array(order, np.int64), np.cumsum(sizes), flat, self.lengths, self.names)


class Words:
    """The groups of many words, each different group once.

    ``word_groups`` lists the groups of word 0, of word 1 and so on, as numbers;
    ``n_groups`` says how many each word has. Of a group: its text, how many tokens
    of A and B it holds, and its links, as numbers into ``pairs``.
    """

    def __init__(self, n, valid, order, word_ends, ids, lengths, names):
        self.valid = valid
        self.lengths = lengths
        self.n_groups = np.zeros(n, np.uint32)
        self.word_groups = np.zeros(0, np.uint32)
        self.texts = []
        self.sizes = [np.zeros(0, np.int32), np.zeros(0, np.int32)]
        self.n_links = np.zeros(0, np.uint32)
        self.links = np.zeros(0, np.uint32)
        self.pairs = np.zeros(0, np.int64)
        if len(order):
            group_start, sides = self._coalesce(ids, lengths)
            word = np.searchsorted(word_ends, group_start, side="right")
            count = np.bincount(word, minlength=len(order))
            self.n_groups[order] = count
            numbers = self._number(sides, ids, names)
            # Words were encoded in another order than they are numbered in.
            by_number = np.argsort(order, kind="stable")
            first = np.cumsum(count) - count
            many = count[by_number]
            along = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first[by_number], many)
            self.word_groups = numbers[along].astype(np.uint32)

    @staticmethod
    def _coalesce(ids, lengths):
        """Where each group starts, and how many tokens of A and of B it holds."""
        sizes = [size[i] for size, i in zip(lengths, ids)]
        end = np.concatenate([np.cumsum(s) for s in sizes])
        start = end - np.concatenate(sizes)
        of_b = np.repeat([False, True], [len(s) for s in sizes])
        along = np.lexsort((end, start))
        start, end, of_b = start[along], end[along], of_b[along]
        reach = np.maximum.accumulate(end)
        opens = np.ones(len(start), bool)
        opens[1:] = start[1:] >= reach[:-1]
        group = np.cumsum(opens) - 1
        n = int(group[-1]) + 1
        return start[opens], (np.bincount(group[~of_b], minlength=n), np.bincount(group[of_b], minlength=n))

    def _number(self, sides, ids, names):
        """The number of every group; fills in what is known of each different one."""
        # Tokens of one side keep their order, so a group is a run of each side.
        a, b = ids
        from_a, from_b = (np.cumsum(n) - n for n in sides)
        single = (sides[0] == 1) & (sides[1] == 1)
        singles, which = np.unique(a[from_a[single]] << 32 | b[from_b[single]], return_inverse=True)
        numbers = np.empty(len(from_a), np.int64)
        numbers[single] = which
        members = [((x,), (y,)) for x, y in zip((singles >> 32).tolist(), (singles & 0xFFFFFFFF).tolist())]
        several: dict = {}
        rest = np.flatnonzero(~single)
        spans = zip(*(x[rest].tolist() for x in (from_a, sides[0], from_b, sides[1])))
        numbers[rest] = [
            several.setdefault((a[i : i + m].tobytes(), b[j : j + n].tobytes()), len(members) + len(several))
            for i, m, j, n in spans
        ]
        members += [tuple(tuple(np.frombuffer(x, np.int64).tolist()) for x in both) for both in several]
        self.texts = ["|".join([",".join(map(n.__getitem__, x)) for n, x in zip(names, both)]) for both in members]
        self.sizes = [np.array([len(both[side]) for both in members], np.int32) for side in (0, 1)]
        self._link(members)
        return numbers

    def _link(self, members):
        """Links of the different groups: within each, a token of A overlaps the tokens
        of B from the one that holds its first byte to the one that holds its last."""
        flat = [np.array([i for both in members for i in both[side]], np.int64) for side in (0, 1)]
        ends = [np.cumsum(size[i]) for size, i in zip(self.lengths, flat)]
        starts = [end - size[i] for end, size, i in zip(ends, self.lengths, flat)]
        first = np.searchsorted(ends[1], starts[0], side="right")
        many = np.searchsorted(starts[1], ends[0], side="left") - first
        at_a = np.repeat(np.arange(len(flat[0])), many)
        at_b = np.arange(len(at_a)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)
        group = np.repeat(np.arange(len(members)), self.sizes[0])[at_a]
        self.n_links = np.bincount(group, minlength=len(members)).astype(np.uint32)
        self.pairs, links = np.unique(flat[0][at_a] << 32 | flat[1][at_b], return_inverse=True)
        self.links = links.astype(np.uint32)


_STAGED = """chunk string, doc_id long, words binary, n_words long, texts array<string>, sizes binary,
    links binary, n_groups binary, word_groups binary, pairs array<long>, counts array<long>"""
_FIELDS = [
    ("chunk", pa.string()), ("doc_id", pa.int64()), ("words", pa.binary()), ("n_words", pa.int64()),
    ("texts", pa.list_(pa.string())), ("sizes", pa.binary()), ("links", pa.binary()),
    ("n_groups", pa.binary()), ("word_groups", pa.binary()), ("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())),
]


def _pack(values: np.ndarray) -> bytes:
    """Whole numbers below 2^32: first bytes, second bytes and so on, compressed."""
    planes = np.ascontiguousarray(values, np.uint32).view(np.uint8).reshape(-1, 4).T
    return pa.compress(planes.tobytes(), codec=_COMPRESSION, asbytes=True)


def _unpack(packed: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.int64)
    planes = np.frombuffer(pa.decompress(packed, 4 * n, codec=_COMPRESSION), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view(np.uint32).reshape(-1).astype(np.int64)


def _table(rows: dict) -> pa.RecordBatch:
    n = len(rows["chunk"])
    return pa.RecordBatch.from_arrays(
        [pa.array(rows.get(name, [None] * n), kind) for name, kind in _FIELDS], [name for name, _ in _FIELDS]
    )


def _encode_chunk(aligner: Aligner, chunk: str, ids: list, texts: list):
    """One row a text with the numbers of its words, and one row with the tables of the chunk's words and groups."""
    numbers: dict[str, int] = {}
    at = []
    for text in texts:
        words = words_of(text) if text else []
        for word in words:
            if word not in numbers:
                numbers[word] = len(numbers)
        at.append(np.fromiter(map(numbers.__getitem__, words), np.uint32, len(words)))
    found = aligner.align(list(numbers))
    del numbers
    # A text with a word whose bytes differ has no tokens.
    at = [a if found.valid[a].all() else a[:0] for a in at]
    yield _table(
        {"chunk": [chunk] * len(ids), "doc_id": ids, "words": [_pack(a) for a in at], "n_words": [len(a) for a in at]}
    )
    times = np.bincount(np.concatenate(at), minlength=len(found.valid))
    times = np.bincount(found.word_groups, np.repeat(times, found.n_groups), minlength=len(found.texts))
    counts = np.bincount(found.links, np.repeat(times, found.n_links), minlength=len(found.pairs))
    yield _table(
        {
            "chunk": [chunk],
            "n_words": [len(found.valid)],
            "texts": [found.texts],
            "sizes": [_pack(np.concatenate([*found.sizes, found.n_links]))],
            "links": [_pack(found.links)],
            "n_groups": [_pack(found.n_groups)],
            "word_groups": [_pack(found.word_groups)],
            "pairs": [found.pairs],
            "counts": [counts.astype(np.int64)],
        }
    )


def _encode(path_a: str, path_b: str, chunk_chars: int):
    def run(batches):
        aligner, part = Aligner(path_a, path_b), TaskContext.get().partitionId()
        ids, texts, size, n = [], [], 0, 0
        for batch in batches:
            for start in range(0, batch.num_rows, _SLICE):
                some = batch.slice(start, _SLICE)
                for i, text in zip(some.column("doc_id").to_pylist(), some.column("text").to_pylist()):
                    ids.append(i)
                    texts.append(text)
                    size += len(text or "")
                    if size >= chunk_chars:
                        yield from _encode_chunk(aligner, f"{part}-{n}", ids, texts)
                        ids, texts, size, n = [], [], 0, n + 1
        if ids:
            yield from _encode_chunk(aligner, f"{part}-{n}", ids, texts)

    return run


def _finish(left: pa.Table, right: pa.Table) -> pa.Table:
    """The texts of one chunk, from the tables of its words and groups and the counts of its pairs."""
    table = left.filter(left.column("texts").is_valid()).to_pylist()[0]
    docs = left.filter(left.column("texts").is_null()).select(["doc_id", "words", "n_words"])
    n, texts, pairs = table["n_words"], table["texts"], np.array(table["pairs"], np.int64)
    n_a, n_b, n_links = _unpack(table["sizes"], 3 * len(texts)).reshape(3, -1)
    links = _unpack(table["links"], int(n_links.sum()))
    count, best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
    place = np.searchsorted(pairs, right.column("pair").to_numpy())
    count[place] = right.column("n").to_numpy()
    best[place] = right.column("best").to_numpy()

    def add_up(values, sizes):
        """Sums of runs of ``values``; runs may be empty."""
        upto = np.concatenate([[0], np.cumsum(values)])
        stop = np.cumsum(sizes)
        return upto[stop] - upto[stop - sizes]

    n_groups = _unpack(table["n_groups"], n)
    word_groups = _unpack(table["word_groups"], int(n_groups.sum()))
    of_group = (n_a, n_b, np.ones(len(texts), np.int64), n_links, add_up(best[links], n_links), add_up(count[links], n_links))
    of_word = np.stack([add_up(values[word_groups], n_groups) for values in of_group])
    stops = np.cumsum(n_groups).tolist()
    held = [texts[g] for g in word_groups.tolist()]
    word_texts = [held[b - k] if k == 1 else ";".join(held[b - k : b]) for b, k in zip(stops, n_groups.tolist())]
    del held
    sums, groups = [], []
    for words, size in zip(docs.column("words").to_pylist(), docs.column("n_words").to_pylist()):
        at = _unpack(words, size)
        sums.append(of_word[:, at].sum(axis=1))
        groups.append(";".join([word_texts[i] for i in at.tolist()]))
    sums = np.array(sums, np.int64).reshape(-1, 6)
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    columns = {name: pa.array(sums[:, i], pa.int64()) for i, name in enumerate(names)}
    return pa.table({"doc_id": docs.column("doc_id")} | columns | {"groups": pa.array(groups, pa.string())})


def align_documents(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_chars: int = 3_000_000,
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups: one row per row of ``docs``.

    A, a byte-level BPE file of the tokenizers library, reads a space and the
    text; B, a sentencepiece model that adds the space itself, reads the text.
    Strings of special tokens are plain text. ``groups`` lists the ids between
    the byte offsets where tokens of both end: ``a1,a2|b1;a3|b2,b3``. A link is a
    token of A and one of B whose bytes overlap; the count of a pair of ids is the
    number of links that hold it in all texts. ``count_sum`` adds the counts of
    a text's links, ``n_best`` is how many of them have the highest count of
    their id of B, ties included.

    Null and empty texts, and texts whose tokens of A or B do not give back the
    bytes, have no tokens: zeros and ''. Null and repeated ids are kept; each
    row counts. Texts are taken in chunks of about ``chunk_chars`` characters,
    which do not affect results; a text of any length is one piece of work. An
    empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    staged = stage(rows.mapInArrow(_encode(path_a, path_b, chunk_chars), _STAGED), "aligned")
    held = staged.where("pairs is not null").select(
        "chunk", F.explode(F.arrays_zip(F.col("pairs").alias("pair"), F.col("counts").alias("n"))).alias("p")
    ).select("chunk", F.col("p.pair").alias("pair"), F.col("p.n").alias("n")).where("n > 0")
    totals = stage(held.groupBy("pair").agg(F.sum("n").alias("n")), "pair-totals")
    of_b = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    most = totals.groupBy(of_b.alias("b")).agg(F.max("n").alias("most"))
    known = totals.join(most, of_b == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).cast("long").alias("best"))
    looked = held.select("chunk", "pair").join(known, "pair").select(F.col("chunk").alias("of"), "pair", "n", "best")
    return (
        staged.groupBy("chunk")
        .cogroup(looked.groupBy("of"))
        .applyInArrow(
            _finish,
            "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string",
        )
    )
