"""Encoding, token counts, packing and sequence files, against the tokenizers library itself."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from snapledger.llm import encoding, packing, sequence_files, token_counts
from snapledger.llm.queries import QUERIES
from snapledger.session import new_path

PATH = encoding.vocabulary_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("keep", [400_000, 50])
def test_parts_give_the_librarys_ids(library, monkeypatch, keep):
    monkeypatch.setattr(encoding, "_KEEP_PARTS", keep)
    rng = random.Random(0)
    letters = " \n\t\x85\xa0\x1c　abéZ中1!,.'<|\0"
    texts = ["", " ", "a <|endoftext|> b<|endoftext|>c  d", "it's 'll don 't", "1,000.5, x.y,z .", "end. \nNext,\n"]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += [" ".join(rng.choice(["ab,", "cd.", "ef", "x" * 60]) for _ in range(50)) for _ in range(50)]
    tool = encoding.Encoder(PATH)
    for a, b in encoding.batches(texts, 2000):
        got = tool.encode(texts[a:b])
        assert [np.frombuffer(g, "<u4").tolist() for g in got] == [ids_of(library, t) for t in texts[a:b]]


@pytest.mark.parametrize("most", [1, 2, 2000])
def test_parts_are_looked_up_once_a_chunk(library, monkeypatch, most):
    """Ids of a chunk end to end; the library gets a part once, and long parts do not pile up."""
    monkeypatch.setattr(encoding, "_RUN", most)
    tool, given = encoding.Encoder(PATH), []
    whole = tool._whole
    monkeypatch.setattr(tool, "_whole", lambda texts: given.extend(texts) or whole(texts))
    texts = ["one two two\u3000 two", "", "é two one\0 two", " two" * 50, "x" * 60 + " " + "y" * 60]
    for _ in range(2):
        ids, bounds = tool.encode_flat(texts)
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [ids_of(library, t) for t in texts]
    # Two different parts, one of which holds it twice, and the text with the mark, which is never kept.
    assert "".join(given).count(" two") == 1 + 2 + 2 * 2
    monkeypatch.setattr(encoding, "_KEEP_PARTS", 10)
    for i in range(100):
        tool.encode_flat([f"{i}" * 500 + f" {i}z"])
        assert tool.parts.n_slots < 30 and tool.parts.n_ids < 2000


def test_other_tokenizers_encode_whole_texts():
    path = encoding.vocabulary_path("word_bpe_49k.json")
    tool, plain = encoding.Encoder(path), Tokenizer.from_file(path)
    assert not tool.splittable
    texts = ["Hello  World", "", "a <|endoftext|> b"]
    assert [len(x) // 4 for x in tool.encode(texts)] == [len(ids_of(plain, t)) for t in texts]


def test_counts(spark, awkward, empty, library):
    cache = token_counts.DigestCache(spark, new_path(spark, "counts"))
    got = token_counts.count_tokens(awkward, PATH, cache).collect()
    want = [(r.doc_id, len((r.text or "").encode()), len(ids_of(library, r.text))) for r in awkward.collect()]
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_tokens) for r in got) == sorted((a or 0, b, c) for a, b, c in want)
    # Copies are one entry; a second run adds none; a new text adds one.
    texts = {r.text or "" for r in awkward.collect()}
    assert spark.read.parquet(cache.path).count() == len(texts)
    token_counts.count_tokens(awkward, PATH, cache)
    assert spark.read.parquet(cache.path).count() == len(texts)
    more = spark.createDataFrame([(1, "new"), (2, "new"), (3, "word")], "doc_id long, text string")
    assert {r.doc_id: r.n_tokens for r in token_counts.count_tokens(more, PATH, cache).collect()} == {1: 1, 2: 1, 3: 1}
    assert spark.read.parquet(cache.path).count() == len(texts) + 1
    # Another tokenizer has entries of its own.
    token_counts.count_tokens(more, encoding.vocabulary_path("word_bpe_49k.json"), cache)
    assert spark.read.parquet(cache.path).count() == len(texts) + 3
    assert token_counts.count_tokens(empty, PATH, token_counts.DigestCache(spark, new_path(spark, "none"))).count() == 0


def test_sequence_files(spark, awkward, empty, library, tmp_path):
    folder = str(tmp_path / "sequences")
    manifest = sequence_files.write_sequences(awkward, PATH, folder, length=64)
    got = sequence_files.read_documents(spark, folder, manifest).orderBy("start").collect()
    rows = sorted(awkward.collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    want = {}
    for r in rows:
        ids = np.array([*ids_of(library, r.text), 0], "<u4")
        want.setdefault(r.doc_id, []).append((len(ids), zlib.crc32(ids)))
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:i]) for i in range(len(got))]
    assert [r.doc_id for r in got] == [r.doc_id for r in rows]
    found = {}
    for r in got:
        found.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_crc32))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in want.items()}
    nothing = sequence_files.write_sequences(empty, PATH, str(tmp_path / "none"))
    assert sequence_files.read_documents(spark, str(tmp_path / "none"), nothing).count() == 0


def test_sequences_are_views_of_the_file(spark, library, tmp_path):
    docs = spark.createDataFrame([(1, "one two three four"), (2, "five")], "doc_id long, text string").coalesce(1)
    folder = str(tmp_path / "files")
    name = sequence_files.write_sequences(docs, PATH, folder, length=4).orderBy("file").first().file
    files = [sequence_files.SequenceFile(f"{folder}/{r.file}") for r in
             sequence_files.write_sequences(docs, PATH, str(tmp_path / "b"), length=4).limit(0).collect()]
    assert files == []
    file = sequence_files.SequenceFile(f"{folder}/{name}")
    before = pa.total_allocated_bytes()
    first = file.ids(0)
    assert pa.total_allocated_bytes() == before
    assert first.tolist() == [*ids_of(library, "one two three four"), 0][:4]
    assert not first.flags.owndata
    assert len(file.mask(0)) == 4 and file.mask(0).to_pylist() == [True] * 4
    with pytest.raises(IndexError):
        file.ids(len(file))


def check_packing(rows, capacity):
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in sequences.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


def test_packing(spark, awkward, empty, library):
    got = packing.pack(packing.pieces(awkward, PATH, capacity=128), capacity=128).collect()
    check_packing(got, 128)
    pieces = {}
    for r in got:
        pieces.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32, r.piece))
    texts = {}
    for r in awkward.collect():
        texts.setdefault(r.doc_id, []).append(r.text)
    for name, own in texts.items():
        want = []
        for text in own:
            ids = np.array([*ids_of(library, text), 2], "<u4")
            firsts = [0, *range((len(ids) - 1) % 128 + 1, len(ids), 128)]
            for k, (a, b) in enumerate(zip(firsts, [*firsts[1:], len(ids)])):
                want.append((a, b - a, zlib.crc32(ids[a:b]), k))
        assert sorted(pieces[name]) == sorted(want)
    assert packing.pack(packing.pieces(empty, PATH)).count() == 0


def test_genetic_steps_keep_every_item():
    rng = random.Random(3)
    sizes = np.array([rng.randint(1, 1023) for _ in range(400)], np.int64)
    order = np.argsort(-sizes, kind="stable").tolist()
    a = packing.pack_in_order(sizes, order, 1024)
    b = packing.pack_in_order(sizes, rng.sample(order, len(order)), 1024)
    for p in (a, b, packing.crossover(a, b, sizes, 1024, rng), packing.mutate(a, sizes, 1024, rng)):
        assert p.fills.max() <= 1024 and p.fills.sum() == sizes.sum() and len(p.assign) == len(sizes)
        places = packing.offsets(p.assign, sizes)
        for k in range(p.bins):
            own = np.flatnonzero(p.assign == k)
            assert places[own].tolist() == np.cumsum([0, *sizes[own]])[:-1].tolist()
    best = packing.evolve(sizes, [], 1024, rng)[0]
    assert best.bins <= a.bins
    again = packing.evolve(sizes, [best.assign], 1024, rng)[0]
    assert again.key() <= best.key()


def test_packing_is_close_to_the_bound(spark, sf):
    got = QUERIES["op2_best_fit_packing"](spark, sf).collect()
    assert check_packing(got, 1024) <= 1.02 * (sum(r.length for r in got) / 1024) + 2


def triplets(rng, n):
    """Sizes that fill ``n`` sequences of 1024 exactly, three each; best fit does not find that."""
    out = []
    for _ in range(n):
        a = rng.randint(390, 500)
        b = rng.randint(260, (1024 - a) // 2)
        out += [a, b, 1024 - a - b]
    rng.shuffle(out)
    return out


def test_search_beats_its_best_first_packing():
    for seed in range(3):
        sizes = np.array(triplets(random.Random(seed), 100), np.int64)
        first = packing.pack_in_order(sizes, np.argsort(-sizes, kind="stable").tolist(), 1024)
        islands = [[], []]
        for epoch in range(2):
            islands = [
                [p.assign for p in packing.evolve(sizes, islands[i] + islands[1 - i][:1], 1024, random.Random(f"{seed}{i}{epoch}"))]
                for i in range(2)
            ]
        end = min(len(set(e.tolist())) for island in islands for e in island)
        assert 100 <= end <= first.bins - 3


def as_pieces(spark, sizes):
    rows = [(i, 0, 0, int(n), i) for i, n in enumerate(sizes)]
    return spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")


@pytest.mark.parametrize("kind", ["mixed", "triplets", "large", "equal"])
def test_dealings_lose_nothing_and_come_near_the_bound(spark, monkeypatch, kind):
    """Many blocks, twenty times smaller than real ones: any sizes, sizes that best fit packs badly, that
    never fit together, and ties."""
    monkeypatch.setattr(packing, "_BLOCK", 100)
    rng = random.Random(kind)
    sizes = {
        "mixed": [rng.randint(1, 1024) for _ in range(1500)],
        "triplets": triplets(rng, 100),
        "large": [rng.randint(600, 1023) for _ in range(300)],
        "equal": [256] * 403,
    }[kind]
    got = packing.pack(as_pieces(spark, sizes)).collect()
    assert sorted((r.doc_id, r.length) for r in got) == list(enumerate(sizes))
    plain = packing.pack_in_order(np.array(sizes), np.argsort(-np.array(sizes), kind="stable").tolist(), 1024).bins
    assert check_packing(got, 1024) <= {"mixed": 1.02 * plain, "triplets": plain, "large": 300, "equal": 101}[kind]


def test_packing_goes_one_way_at_every_size(spark, monkeypatch):
    """One block or many: best fit first, then the search; no more sequences than either alone finds."""
    steps = []
    for name in ("_fill_blocks", "_search"):
        step = getattr(packing, name)
        monkeypatch.setattr(packing, name, lambda *args, name=name, step=step: steps.append(name) or step(*args))
    rng = random.Random(1)
    sizes = [rng.randint(200, 500) for _ in range(400)]
    for block in (2048, 100):
        monkeypatch.setattr(packing, "_BLOCK", block)
        steps.clear()
        got = packing.pack(as_pieces(spark, sizes)).collect()
        check_packing(got, 1024)
        assert len(got) == 400 and steps[0] == "_fill_blocks" and steps[-1] == "_search"
        first = steps.index("_search")
        assert set(steps[:first]) == {"_fill_blocks"} and set(steps[first:]) == {"_search"}
