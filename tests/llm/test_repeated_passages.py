"""Removal of repeated passages against brute force over all windows."""

import hashlib
import os
import random
import re
import sys
from collections import Counter

import numpy as np

sys.path.insert(0, os.path.dirname(__file__))
from llm_cases import edge_docs, empty_docs, sentence, texts  # noqa: E402
from quire.llm import repeated_passages as rp  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows):
    words = [WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[p : p + 35]) for w in words for p in range(len(w) - 34))
    out = Counter()
    for (i, _), w in zip(rows, words):
        gone = {q for p in range(len(w) - 34) if seen[tuple(w[p : p + 35])] > 1 for q in range(p, p + 35)}
        kept = " ".join(x for q, x in enumerate(w) if q not in gone)
        out[i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


def check(spark, rows, parts=3):
    frame = spark.createDataFrame([(i, t, "1", "x", 3) for i, t in rows], "doc_id long, text string, rid string, k1 string, least int").repartition(parts)
    result = rp.without_repeats(frame).collect()
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in result)
    assert got == plain(rows)
    return result


def corpus():
    rng = random.Random(4)
    passages = [sentence(rng, n).split() for n in (34, 35, 36, 60, 61, 150, 400)]
    rows = []
    for i in range(220):
        words = sentence(rng, rng.choice([5, 20, 40, 90, 200])).split()
        for _ in range(rng.choice([0, 0, 1, 2, 3])):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            b = rng.randint(a, len(p)) if rng.random() < 0.5 else len(p)
            at = rng.randint(0, len(words))
            words[at:at] = p[a if rng.random() < 0.5 else 0 : b]
        if rng.random() < 0.2 and rows:  # a near copy
            words = (rows[rng.randrange(len(rows))][1] or "x").split()
            if words and rng.random() < 0.7:
                words[rng.randrange(len(words))] = "changed"
        rows.append((i, rng.choice([" ", "\n", " \t"]).join(words)))
    rows += [(300, "a " * 34), (301, "b " * 35), (302, "c " * 36), (303, "d " * 200), (304, "d " * 300), (305, "e f g " * 60), (306, "h i " * 17 + "j"), (307, "k " * 60 + "l " * 60)]
    rows += [(400 + k, " ".join(passages[4])) for k in range(40)]  # a text that many rows hold
    rows += [(500 + k, sentence(rng, 12) + " " + " ".join(passages[5][:90]) + " " + sentence(rng, 12)) for k in range(60)]
    return rows


def test_query_equals_brute_force(spark):
    result = check(spark, corpus())
    check(spark, texts() + [(60, "w" * 70_000 + " " + "x " * 40 + "w" * 70_000), (61, None)], 2)
    for r in result:
        spans = list(zip(r.spans[::2], r.spans[1::2]))
        assert sum(b - a for a, b in spans) == r.n_removed and all(b - a >= 35 for a, b in spans)
    assert rp.without_repeats(empty_docs(spark)).count() == 0
    assert rp.without_repeats(edge_docs(spark)).count() == edge_docs(spark).count()


def test_small_alphabets_equal_brute_force(spark):
    """Few different words: edges that repeat inside a path, long runs and cycles."""
    rng = random.Random(9)
    rows = []
    for i in range(60):
        period = [rng.choice("ab") for _ in range(rng.choice([1, 2, 3, 7, 26, 36, 60]))]
        words = (period * 200)[: rng.choice([35, 40, 61, 120, 200])]
        for _ in range(rng.choice([0, 1, 3])):
            words[rng.randrange(len(words))] = "c"
        rows.append((i, " ".join(words)))
    check(spark, rows)


def test_hashes_do_not_depend_on_the_place():
    rng = random.Random(1)
    words = [sentence(rng, 1) for _ in range(300)] + ["a" * 70_000, "é" * 40_000, "é"]
    one, counts = rp.word_hashes([w.encode() for w in words])
    assert counts.tolist() == [1] * len(words)
    other, counts = rp.word_hashes([(" \n".join(words[:200])).encode(), b"", b" ", ("x " + " ".join(words[200:])).encode()])
    assert counts.tolist() == [200, 0, 0, len(words) - 199]
    assert np.array_equal(one, np.concatenate([other[:200], other[201:]])) and len(set(one.tolist())) == len(set(words))
