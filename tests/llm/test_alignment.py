"""Alignment of two tokenizers against a version token by token."""

import hashlib
import random
from collections import Counter

import pytest

from prose import prose
from snapledger.llm.alignment import ByteLevel, Pieces, align_documents, words_of
from snapledger.llm.encoding import vocabulary_path
from snapledger.llm.queries import PIECES, QUERIES, TOKENIZER


@pytest.fixture(scope="module")
def tools():
    return ByteLevel(vocabulary_path(TOKENIZER)), Pieces(vocabulary_path(PIECES))


def spans(tool, text):
    out, at = [], 0
    for i in tool.encode(text):
        out.append((at, at + len(tool.bytes[i]), i))
        at += len(tool.bytes[i])
    return out, b"".join(tool.bytes[i] for _, _, i in out)


def plain(tools, texts):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of each text, whole texts encoded at once."""
    cut = []
    for text in texts:
        a, b = [], []
        if text:
            (a, bytes_a), (b, bytes_b) = (spans(t, text) for t in tools)
            if not bytes_a == bytes_b == (" " + text).encode():
                a, b = [], []
        cut.append((a, b))
    links = [
        [(x[2], y[2]) for x in a for y in b if x[0] < y[1] and y[0] < x[1]] if len(a) < 400 else sweep(a, b) for a, b in cut
    ]
    counts = Counter(link for some in links for link in some)
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    out = []
    for (a, b), some in zip(cut, links):
        shared = sorted({x[1] for x in a} & {y[1] for y in b})
        groups, low = [], 0
        for high in shared:
            left = ",".join(str(x[2]) for x in a if low < x[1] <= high) if len(shared) < 400 else None
            right = ",".join(str(y[2]) for y in b if low < y[1] <= high) if len(shared) < 400 else None
            groups.append(f"{left}|{right}")
            low = high
        best = sum(counts[p] == most[p[1]] for p in some)
        text = ";".join(groups) if len(shared) < 400 else None
        out.append((len(a), len(b), len(shared), len(some), best, sum(counts[p] for p in some), text))
    return out


def sweep(a, b):
    out, j = [], 0
    for start, end, i in a:
        while b[j][1] <= start:
            j += 1
        k = j
        while k < len(b) and b[k][0] < end:
            out.append((i, b[k][2]))
            k += 1
    return out


def check(got, want, texts):
    for r, w, text in zip(got, want, texts):
        found = (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum)
        assert found == w[:6], text
        if w[6] is not None:
            assert r.groups == w[6], text


ODD = [
    "  two  spaces ", " a\n\nb ", "a\tb", "ﬁ́", "　x", "a\xa0 b", "<s> </s><unk><|endoftext|>", "a ▁ b", "▁",
    "\r\n", "\x00a", "\U0001f600中文 字", " ", "   ", "\n", "x" * 3000, "a   b", "don't  we'll\n \n x", "<0x41> <0x0A>",
    "é é ẛ̣", "a b\n", "\t leading", "tab\t tab", "\x1c y \x1d",
]


def test_odd_texts(spark, tools):
    texts = ODD + [None, "", prose(40, 1), prose(3000, 2)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = align_documents(docs, vocabulary_path(TOKENIZER), vocabulary_path(PIECES)).orderBy("doc_id").collect()
    want = plain(tools, texts)
    check(got, want, texts)
    assert want[ODD.index("a ▁ b")][0] == 0 and want[ODD.index("  two  spaces ")][0] > 0


@pytest.mark.parametrize("size", [60, 4000])
def test_random_texts_in_small_chunks(spark, tools, size):
    """Words cut from their text are encoded as in the whole text."""
    rng = random.Random(6)
    letters = "  aab.,'\n\téß中\U0001f6009- ​<>s"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    paths = vocabulary_path(TOKENIZER), vocabulary_path(PIECES)
    got = align_documents(docs, *paths, chunk_chars=size).orderBy("doc_id").collect()
    check(got, plain(tools, texts), texts)


def test_words_give_back_the_text():
    rng = random.Random(7)
    for _ in range(2000):
        text = "".join(rng.choice("  ab\n\t ") for _ in range(rng.randint(1, 12)))
        words = words_of(text)
        assert " ".join(words) == text
        assert not any(w[-1:].isspace() or not w for w in words[:-1])


def test_awkward_tables(spark, tools, awkward, empty):
    paths = vocabulary_path(TOKENIZER), vocabulary_path(PIECES)
    rows = awkward.collect()
    got = align_documents(awkward, *paths).collect()
    texts = [r.text for r in rows]
    want = plain(tools, texts)
    key = lambda v: tuple(str(x) for x in v)
    assert sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum) for r in got), key=key) == sorted(
        ((r.doc_id, *w[:6]) for r, w in zip(rows, want)), key=key
    )
    assert align_documents(empty, *paths).isEmpty()


def test_registered_query(spark, sf, tools):
    got = {r.doc_id: r for r in QUERIES["op11_tokenizer_alignment"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = plain(tools, [d.text for d in docs])
    assert len(got) == len(docs)
    for d, w in zip(docs, want):
        r = got[d.doc_id]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum) == w[:6]
        if w[0] == 0:
            assert r.groups_sha256 == ""
        elif w[6] is not None:
            assert r.groups_sha256 == hashlib.sha256(w[6].encode()).hexdigest()
