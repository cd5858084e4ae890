"""Alignment of two tokenizers against the libraries and plain Python."""

import hashlib
import os
import random
import sys
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

sys.path.insert(0, os.path.dirname(__file__))
from llm_cases import edge_docs, empty_docs, sentence, texts  # noqa: E402
from quire.llm import token_alignment as ta  # noqa: E402
from quire.llm.common import small_batches  # noqa: E402

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(A)
    tok.encode_special_tokens = True
    return tok, sentencepiece.SentencePieceProcessor(model_file=B)


def plain_tokens(libraries, text):
    """(id, bytes) lists by the libraries, or none."""
    tok, model = libraries
    if not text:
        return [], []
    printable = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
    table = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in printable)}
    enc = tok.encode(" " + text, add_special_tokens=False)
    a = [(i, bytes(table[c] for c in t)) for i, t in zip(enc.ids, enc.tokens)]
    b = [(i, bytes([int(p[3:5], 16)]) if len(p) == 6 and p[:3] == "<0x" else p.replace("▁", " ").encode())
         for i, p in ((i, model.id_to_piece(i)) for i in model.encode(text))]
    want = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == want and b"".join(x for _, x in b) == want else ([], [])


def plain_alignment(a, b):
    def ranges(tokens):
        out, at = [], 0
        for _, x in tokens:
            out.append((at, at + len(x)))
            at += len(x)
        return out

    ra, rb = ranges(a), ranges(b)
    common = sorted({y for _, y in ra} & {y for _, y in rb})
    groups, low = [], 0
    for high in common:
        groups.append(([t[0] for t, (x, y) in zip(a, ra) if low < y <= high], [t[0] for t, (x, y) in zip(b, rb) if low < y <= high]))
        low = high
    links = [(s[0], t[0]) for s, (x, y) in zip(a, ra) for t, (v, w) in zip(b, rb) if x < w and v < y]
    return ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups), len(groups), links


def test_align_finds_every_common_end():
    rng = random.Random(2)
    for _ in range(4000):
        n, p, q = rng.randint(1, 60), rng.choice([0.1, 0.5, 0.9, 1.0]), rng.choice([0.1, 0.5, 0.9, 1.0])
        a = [x for x in range(1, n) if rng.random() < p] + [n]
        b = [x for x in range(1, n) if rng.random() < q] + [n]
        if rng.random() < 0.5:
            b = sorted({*a[: len(a) // 2], *b, n})
        stops_a, stops_b, li, lj = ta.align(a, b)
        assert [a[i - 1] for i in stops_a] == [b[j - 1] for j in stops_b] == sorted(set(a) & set(b))
        starts_a, starts_b = [0, *a[:-1]], [0, *b[:-1]]
        assert list(zip(li, lj)) == [(i, j) for i in range(len(a)) for j in range(len(b)) if starts_a[i] < b[j] and starts_b[j] < a[i]]


def test_pieces_encode_like_whole_texts(libraries):
    rng, tokens = random.Random(3), ta.Pair(A, B)
    marks = ["a", "b'll", " ", " ", "  ", "\n", "\t", "é", "é", "1", "23", ".", "!!", "<|endoftext|>", "<s>", "\x1f", "\x85", " ", "中", "▁", "\x00", "😀", "the", "ing", " "]
    tests = ["".join(rng.choice(marks) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    tests += ["".join(chr(c) for c in rng.choices([c for c in range(1, 0x3000) if not 0xD800 <= c < 0xE000], k=12)) for _ in range(1000)]
    for text, blocks in zip(tests, tokens.encode(tests)):
        want = plain_tokens(libraries, text)
        assert tuple([i for b in blocks for i in b[side].tolist()] for side in (0, 1)) == tuple([i for i, _ in x] for x in want), repr(text)


def test_long_texts_go_in_blocks(libraries, monkeypatch):
    monkeypatch.setattr(ta, "SLICE_BYTES", 100)
    text = sentence(random.Random(8), 300)
    (blocks,) = ta.Pair(A, B).encode([text])
    assert len(blocks) > 5
    assert tuple([i for b in blocks for i in b[side].tolist()] for side in (0, 1)) == tuple([i for i, _ in x] for x in plain_tokens(libraries, text))


def test_equal_pieces_are_aligned_once(libraries, monkeypatch):
    rng, seen, align = random.Random(5), [], ta.align
    monkeypatch.setattr(ta, "align", lambda x, y: seen.append(len(x)) or align(x, y))
    words = sentence(rng, 60).split()
    tests = [" ".join(rng.choices(words, k=200)) for _ in range(40)]
    tokens = ta.Pair(A, B)
    assert sum(row[0] for blocks in tokens.aligned(tests) for row, *_ in blocks) > 8000
    assert sum(seen) == len(tokens.flat[0]) < 400
    tokens.aligned(tests)
    assert sum(seen) < 400


@pytest.mark.parametrize("limits", [{}, {"CACHE_PIECES": 40, "LONGEST_CACHED": 5}, {"SLICE_BYTES": 30}])
def test_alignment_of_pieces_is_that_of_the_text(libraries, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(ta, name, value)
    rng, tokens = random.Random(6), ta.Pair(A, B)
    marks = ["thheingble", "é", "ﬁ", "中文", "▁", "  ", "\n", "\t", "1234", "!!", "<s>", "a▁b", "\x00", "😀", "unhappinessly", "e\u0301", "x" * 30]
    tests = ["", "▁", "\u3000"] + [" ".join("".join(rng.choices(marks, k=rng.randint(1, 2))) for _ in range(rng.randint(1, 9))) for _ in range(1500)]
    for at in range(0, len(tests), 100):
        for text, blocks in zip(tests[at : at + 100], tokens.aligned(tests[at : at + 100])):
            a, b = plain_tokens(libraries, text)
            groups, n_groups, links = plain_alignment(a, b)
            assert b";".join(x for _, x, _ in blocks).decode() == groups, repr(text)
            assert [sum(x) for x in zip(*[row for row, *_ in blocks])] == ([len(a), len(b), n_groups, len(links)] if a else []), repr(text)
            assert [(p >> 32, p & 0xFFFFFFFF) for *_, pairs in blocks for p in pairs.tolist()] == links, repr(text)


def test_query_equals_plain_python(spark, libraries):
    rows = [(i, t) for i, t in texts() if t is None or len(t) < 5000] + [(50, "a▁b c"), (51, " x  y "), (52, "<s> <|endoftext|>"), (53, "x" * 700)]
    frame = spark.createDataFrame([(i, t, "7", "c", [1]) for i, t in rows], "doc_id long, text string, chunk string, pair string, docs array<int>").repartition(3)
    alignments = [(i, *plain_tokens(libraries, t)) for i, t in rows]
    alignments = [(i, len(a), len(b), *plain_alignment(a, b)) for i, a, b in alignments]
    held = Counter(p for *_, links in alignments for p in set(links))
    most = defaultdict(int)
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    want = Counter(
        (i, n_a, n_b, n_groups, len(links), sum(held[p] == most[p[0]] for p in links), sum(held[p] for p in links),
         hashlib.sha256(groups.encode()).hexdigest() if n_a else "")
        for i, n_a, n_b, groups, n_groups, links in alignments)
    for size in (ta.CHUNK_BYTES, 300):
        got = Counter(tuple(r) for r in ta.alignment_digests(frame, A, B, chunk_bytes=size).collect())
        assert got == want
    assert ta.alignment_digests(empty_docs(spark), A, B).count() == 0
    assert ta.alignment_digests(edge_docs(spark), A, B).count() == edge_docs(spark).count()


def test_repeated_pieces_outlive_a_full_cache(libraries, monkeypatch):
    monkeypatch.setattr(ta, "CACHE_PIECES", 600)
    rng, seen, align = random.Random(9), [], ta.align
    monkeypatch.setattr(ta, "align", lambda x, y: seen.append(len(x)) or align(x, y))
    hot = [f"{x}q" for x in range(200)]
    tests = [" ".join([*hot, *(f"z{rng.random():.9f}" for _ in range(30))]) for _ in range(80)]
    tokens, n_hot = ta.Pair(A, B), sum(len(plain_tokens(libraries, x)[0]) for x in hot)
    for text in tests:
        (blocks,) = tokens.aligned([text])
        a, b = plain_tokens(libraries, text)
        groups, n_groups, links = plain_alignment(a, b)
        assert b";".join(x for _, x, _ in blocks).decode() == groups
        assert [(p >> 32, p & 0xFFFFFFFF) for *_, pairs in blocks for p in pairs.tolist()] == links
        assert len(tokens.index) <= 600 + 30
    cold = sum(len(plain_tokens(libraries, t)[0]) - n_hot for t in tests)
    assert sum(seen) < cold + 2 * n_hot  # hot pieces are aligned once, however often the cache is full


def test_rows_hold_slices_and_not_chunks(spark):
    """Rows of whole chunks stood in the JVM's heap, in Arrow's buffers and in workers at once."""
    rng = random.Random(10)
    docs = [(i, sentence(rng, 12_000)) for i in range(40)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    total = sum(len(t) for _, t in docs)
    rows = ta.chunks(frame, A, B).collect()
    assert total > 2 * ta.SLICE_BYTES and len({r.chunk for r in rows}) == 1
    slices = [[dict(docs)[i] for i in r.doc_ids] for r in rows if r.doc_ids]
    assert sorted(t for x in slices for t in x) == sorted(t for _, t in docs)
    assert all(sum(len(t.encode()) for t in x) <= ta.SLICE_BYTES for x in slices)
    assert all(len(r.pairs) <= ta.PART_PAIRS for r in rows if r.pairs is not None)
    assert max(len(r.links) for r in rows if r.links) < ta.SLICE_BYTES


def test_arrow_batches_are_small(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    frame = spark.range(0, 3000, 1, 1).selectExpr("repeat('ab ', 3000) as text")

    def sizes(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.get_total_buffer_size()]})

    with small_batches(spark):
        got = [r.n for r in frame.mapInArrow(sizes, "n long").collect()]
    assert sum(got) >= 27_000_000 and max(got) < 6 << 20
    assert spark.conf.get(name) == before


def test_links_pack_and_unpack():
    rng = np.random.default_rng(11)
    for sizes in ([], [0], [0, 3, 0, 5], [70_000]):
        ranks = np.concatenate([np.empty(0, np.int64), *[np.sort(rng.choice(100_000, n, replace=False)) for n in sizes]])
        times, codes = rng.integers(1, 1 << 30, len(ranks)), rng.permutation(100_000)
        got = ta._unlinked(ta._links(sizes, ranks, times, codes))
        assert [x.tolist() for x in got] == [sizes, codes[ranks].tolist() if len(ranks) else [], times.tolist()]


def test_dictionary_numbers_pairs_as_they_come():
    rng, known, docs, codes = random.Random(12), ta.Dictionary(), Counter(), {}
    for _ in range(50):
        pairs = np.array(sorted(rng.sample(range(1 << 40, (1 << 40) + 500), rng.randint(0, 60))), np.int64)
        held = np.array([rng.randint(1, 9) for _ in pairs], np.int64)
        for p, c, n in zip(pairs.tolist(), known.add(pairs, held).tolist(), held.tolist()):
            assert codes.setdefault(p, c) == c
            docs[p] += n
    parts = list(known.parts(64))
    assert [at for at, *_ in parts] == list(range(0, len(codes), 64))
    assert {p: at + k for at, x, _ in parts for k, p in enumerate(x.tolist())} == codes
    assert {p: n for _, x, y in parts for p, n in zip(x.tolist(), y.tolist())} == docs
