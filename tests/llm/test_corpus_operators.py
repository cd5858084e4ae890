"""Operators over whole tables: joins, models, mixtures, shards and the pipeline."""

import itertools
import math
import os
import random
import re
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))
from llm_cases import edge_docs, empty_docs, labels, sentence, texts  # noqa: E402

from quire.llm import attention_quality, mixing, sharding, shingle_join, toxicity  # noqa: E402
from quire.llm.common import written  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ------------------------------------------------------------------------------------------------ shingle join


def brute_classes(rows):
    """Per row: (least row of its class, links); rows are ``(id, text)``."""
    sets = []
    for _, text in rows:
        words = WORD.findall(text or "")
        k = min(5, len(words))
        sets.append(frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if words else frozenset())
    distinct = list(dict.fromkeys(sets))
    links, parent = Counter(), {s: s for s in distinct}

    def top(s):
        while parent[s] is not s and parent[s] != s:
            s = parent[s]
        return s

    for a, b in itertools.combinations([s for s in distinct if s], 2):
        if len(a & b) >= 0.8 * len(a | b) - 1e-9:
            links[a] += 1
            links[b] += 1
            parent[top(a)] = top(b)
    least, copies = {}, Counter(sets)
    for (i, _), s in zip(rows, sets, strict=True):
        key = (i is not None, i)
        least[top(s)] = min(least.get(top(s), key), key)
    return Counter((i, least[top(s)][1], copies[s], links[s]) for (i, _), s in zip(rows, sets, strict=True))


def near_rows():
    """A chain and a group of near copies, unrelated texts that share a passage, and short texts."""
    rng = random.Random(1)
    base, passage = sentence(rng, 150).split(), sentence(rng, 40)
    rows, chain = [], list(base)
    for i in range(12):
        rows.append((i, " ".join(chain)))
        chain = list(chain)
        chain[(7 * i) % 150] = f"new{i}"
    other = sentence(rng, 200).split()
    for i in range(40):
        near = list(other)
        near[rng.randrange(200)] = f"edit{i}"
        rows.append((100 + i, " ".join(near)))
    rows += [(200 + i, sentence(rng, 100) + " " + passage + " " + sentence(rng, 100)) for i in range(30)]
    rows += [(300, "one two"), (301, "one\ttwo"), (302, "one two three"), (303, None), (304, "")]
    return rows


@pytest.mark.parametrize(("bucket", "block"), [(4, 4), (4, 1024), (256, 16)])
def test_near_duplicates_against_all_pairs(spark, monkeypatch, bucket, block):
    monkeypatch.setattr(shingle_join, "BUCKET", bucket)
    monkeypatch.setattr(shingle_join, "BLOCK", block)
    monkeypatch.setattr(shingle_join.leaves, "__defaults__", (0.8, 0.9999, 3, bucket))
    rows = near_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = shingle_join.near_duplicates(docs).collect()
    assert Counter((r["doc_id"], r["class_id"], r["copies"], r["n_links"]) for r in got) == brute_classes(rows)


def near_cluster(n, words=400, edits=14):
    """``n`` copies of one text, each with its own edits, so that similarities lie on both sides of 0.8."""
    rng = random.Random(11)
    base = sentence(rng, words).split()
    rows = []
    for i in range(n):
        near = list(base)
        for at in rng.sample(range(words), rng.randint(1, edits)):
            near[at] = f"e{rng.randrange(50)}"
        rows.append((i, " ".join(near)))
    return rows


def test_a_cluster_of_near_copies_is_compared_about_once(spark):
    """Links of 1,500 near copies (over 10^5 at 0.8 to 0.85): recall, and the pairs in all tiles against all pairs."""
    from pyspark.sql import functions as F

    rows = near_cluster(1500)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    grams = [set(zip(*[(w := t.split())[k:] for k in range(5)])) for _, t in rows]
    number = {}
    x = np.zeros((len(rows), len({g for s in grams for g in s})), np.float32)
    for i, s in enumerate(grams):
        x[i, [number.setdefault(g, len(number)) for g in s]] = 1
    both, size = x @ x.T, x.sum(1)
    likeness = both / (size[:, None] + size - both)
    linked = likeness >= 0.8 - 1e-7
    np.fill_diagonal(linked, False)
    got = {r["doc_id"]: r["n_links"] for r in shingle_join.near_duplicates(docs).collect()}
    want, found = linked.sum(1), np.array([got[i] for i in range(len(rows))])
    assert ((likeness < 0.85) & linked).sum() / 2 > 10**5
    assert (found <= want).all() and found.sum() >= 0.99 * want.sum()
    reps = written(shingle_join.equal_classes(shingle_join.sketched(docs)), "test-reps")
    grouped = written(shingle_join.families(shingle_join.leaves(reps), reps), "test-grouped")
    tile = shingle_join.tiles(grouped, reps).groupBy("family", "a", "b").agg(F.count_if(F.col("side") == 0).alias("l"), F.count_if(F.col("side") == 1).alias("r"))
    pairs = tile.agg(F.sum(F.when(F.col("a") == F.col("b"), F.col("l") * (F.col("l") - 1) / 2).otherwise(F.col("l") * F.col("r")))).first()[0]
    assert pairs < 2 * len(rows) * (len(rows) - 1) / 2


def test_least_linked_and_common():
    rng = np.random.default_rng(3)
    uid = rng.permutation(1000)[:60]
    x, y = np.array([0, 1, 2, 10, 30, 12]), np.array([1, 2, 3, 11, 31, 30])
    want = uid.copy()
    for group in ([0, 1, 2, 3], [10, 11], [30, 31, 12]):
        want[group] = uid[group].min()
    assert (shingle_join._least_linked(uid, x, y) == want).all()
    sets = [np.unique(rng.integers(0, 400, rng.integers(1, 300)).astype(np.uint64)) for _ in range(40)]
    i, j = np.triu_indices(40, 1)
    for some in (slice(None), slice(0, None, 40)):  # by matrices, by lookups
        assert shingle_join._common(sets, i[some], j[some]).tolist() == [len(np.intersect1d(sets[a], sets[b])) for a, b in zip(i[some], j[some])]


def test_near_duplicates_of_odd_rows(spark):
    docs = edge_docs(spark)
    got = shingle_join.near_duplicates(docs).collect()
    assert Counter((r["doc_id"], r["class_id"], r["copies"], r["n_links"]) for r in got) == brute_classes(texts())
    kept = shingle_join.one_per_class(docs)
    assert kept.columns == docs.columns
    classes = {r["class_id"] for r in got}
    assert Counter(r["doc_id"] for r in kept.collect()).keys() == classes and kept.count() == len({(r["class_id"], r["class_hash"]) for r in got})
    assert shingle_join.near_duplicates(empty_docs(spark)).count() == 0 and shingle_join.one_per_class(empty_docs(spark)).count() == 0


def test_runs_reach_the_recall():
    assert shingle_join.runs(0.8, 0.999, 1) == 7 and shingle_join.runs(0.8, 0.999, 3) == 15


def test_components(spark):
    rng = random.Random(6)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100 + rng.randrange(30), 100 + rng.randrange(30)) for _ in range(20)] + [(500, 500)]
    edges = spark.createDataFrame(pairs, "uid long, root long")
    got = {r["uid"]: r["label"] for r in shingle_join.components(edges).collect()}
    parent = {}
    for a, b in pairs:
        if a == b:
            continue
        group = {x for x in parent if parent[x] in (parent.get(a, a), parent.get(b, b))} | {a, b}
        least = min(min(group), parent.get(a, a), parent.get(b, b))
        parent.update(dict.fromkeys(group, least))
    assert got == parent


# ------------------------------------------------------------------------------------------------ toxicity


def all_maximal(scores):
    """Maximal segments by definition: the best segment, then the same on both of its sides."""
    best = max(((sum(scores[i:j]), -(j - i), -i) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)), default=(0, 0, 0))
    if best[0] <= 1e-12:
        return []
    i = -best[2]
    j = i - best[1]
    return all_maximal(scores[:i]) + [(i, j, best[0])] + [(a + j, b + j, s) for a, b, s in all_maximal(scores[j:])]


def test_maximal_segments_against_the_definition():
    rng = random.Random(8)
    for _ in range(300):
        scores = [rng.choice([3.0, 2.25, 1.1]) if rng.random() < 0.4 else -0.77 for _ in range(rng.randint(0, 16))]
        hits = [(i, s, i, i + 1) for i, s in enumerate(scores) if s > 0]
        got = toxicity.maximal_segments(hits, 0.77)
        want = all_maximal(scores)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert np.allclose([s for *_, s in got], [s for *_, s in want])


def labelled(spark, n=400):
    rng = random.Random(3)
    rows, marks = [], []
    for i in range(n):
        words = sentence(rng, rng.randint(5, 60)).split()
        toxic = rng.random() < 0.3
        if toxic:
            for _ in range(rng.randint(1, 4)):
                words.insert(rng.randrange(len(words) + 1), rng.choice(["IDIOT!", "scum", "vequaire", "vequatre", "Moron."]))
        quality = rng.random() < 0.7
        text = " ".join(words) if quality else " ".join(w.upper() + "!!" for w in words) if rng.random() < 0.5 else "| ".join(words) + " ### $$$" * 5
        rows.append((i, text))
        marks.append((i, int(quality), int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(2), labels(spark, marks), marks


def check_held_out(rows, marks, column, least):
    truth = {i: m for i, *m in marks}
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows) and len(held) > 50
    assert sum(r["predicted"] == truth[r["doc_id"]][column] for r in held) / len(held) >= least
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_toxicity_on_held_out_rows(spark):
    docs, marks, truth = labelled(spark)
    got = toxicity.toxicity(docs, marks).collect()
    check_held_out(got, truth, 1, 0.97)
    held_only = marks.where(sharding.F.crc32(sharding.F.col("doc_id").cast("string").cast("binary")) % 3 == 1)
    assert {r["score"] for r in toxicity.toxicity(docs, held_only).collect()} == {0.0}  # held-out labels teach nothing
    model = toxicity.fit(docs, marks)
    spans = toxicity.toxic_passages(spark.createDataFrame([(1, "Go on, IDIOT! scum " + "and so on " * 30)], "doc_id long, text string"), model, "doc_id").first()["passages"]
    assert [(s["first"], s["end"]) for s in spans] == [(7, 18)]


def test_toxic_features_against_counts(spark):
    """Every model's features, out of each fold and of the whole sample, from token counts in plain Python."""
    docs, marks, truth = labelled(spark, 300)
    F = sharding.F
    sample = toxicity.labelled_sample(docs, marks, "toxic", 10_000).withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(toxicity.FOLDS)).cast("int"))
    rows = sample.collect()
    assert {r["doc_id"] for r in rows} == {i for i, *_ in truth if zlib.crc32(str(i).encode()) % 3 != 1}
    counts = toxicity.written(toxicity.feature_counts(sample), "test-counts")
    for out in (0, 1, 2, None):
        n, total = defaultdict(lambda: [0, 0]), [0, 0]
        for r in rows:
            if r["fold"] != out:
                for w in toxicity.WORD.findall(r["text"].lower()):
                    total[r["y"]] += 1
                    n["w", w][r["y"]] += 1
                    if len(w) > toxicity.STEM:
                        n["s", w[: toxicity.STEM]][r["y"]] += 1
        other, toxic = total
        got = toxicity.models(counts, out)
        for (least_z, least_odds), model in zip(toxicity.LIMITS, got, strict=True):
            want = {"w": {}, "s": {}}
            for (kind, feature), (o, t) in n.items():
                prior = toxic * (t + o) / (toxic + other)
                odds = math.log((t + prior) / (toxic + toxic - t - prior)) - math.log((o + prior) / (other + toxic - o - prior))
                z = odds / math.sqrt(1 / (t + prior) + 1 / (o + prior))
                if t > 1 and z >= least_z and odds >= least_odds:
                    want[kind][feature] = odds
            assert model.words == pytest.approx(want["w"]) and model.stems == pytest.approx(want["s"])


def test_toxicity_of_odd_rows(spark):
    _, marks, _ = labelled(spark, 5)
    docs = edge_docs(spark)
    assert toxicity.toxicity(docs, marks).count() == len(texts())
    clean = toxicity.clean_documents(docs, labels(spark))
    assert clean.columns == docs.columns and clean.count() == len(texts())
    assert toxicity.toxicity(empty_docs(spark), labels(spark)).count() == 0


# ------------------------------------------------------------------------------------------------ quality


def test_quality_on_held_out_rows(spark):
    docs, marks, truth = labelled(spark)
    check_held_out(attention_quality.quality(docs, marks).collect(), truth, 0, 0.95)


def test_gradient_of_the_network():
    rng = np.random.default_rng(0)
    net = attention_quality.Network(1)
    x = rng.standard_normal((9, attention_quality.DIM))
    starts, y, weight = np.array([0, 4, 5]), np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 0.5])

    def loss():
        p, _ = net.forward(x, starts)
        return -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / weight.sum()

    p, state = net.forward(x, starts)
    grad = net.gradient(p, y, weight, state, starts)
    for name, value in net.parts.items():
        flat = value.reshape(-1)
        for i in rng.choice(len(flat), min(5, len(flat)), replace=False):
            old = flat[i]
            flat[i] = old + 1e-5
            up = loss()
            flat[i] = old - 1e-5
            down = loss()
            flat[i] = old
            assert abs((up - down) / 2e-5 - grad[name].reshape(-1)[i]) < 1e-5, name


def test_quality_of_odd_rows(spark):
    docs = edge_docs(spark)
    _, marks, _ = labelled(spark, 60)
    for some in (marks, labels(spark)):
        got = attention_quality.quality(docs, some).collect()
        assert len(got) == len(texts()) and all(0 <= r["score"] <= 1 for r in got)
    assert attention_quality.quality(empty_docs(spark), labels(spark)).count() == 0
    assert attention_quality.encode(b"").shape == (1, attention_quality.DIM)


# ------------------------------------------------------------------------------------------------ mixing


def water_fill(sizes, share=1.5, repeat=2):
    """Targets by sharing the excess again and again, as the words have it."""
    weights = dict(zip(sorted(sizes, key=lambda s: (s is None, (s or "").encode())), itertools.cycle((5, 2, 1))))
    free, left, target = set(sizes), share * sum(sizes.values()), {}
    while free:
        level = left / sum(weights[s] for s in free)
        over = {s for s in free if repeat * sizes[s] < weights[s] * level}
        if not over:
            target.update({s: weights[s] * level for s in free})
            break
        for s in over:
            target[s] = repeat * sizes[s]
            left -= target[s]
        free -= over
    return target


def test_targets_and_taken_words(spark):
    rng = random.Random(12)
    rows = [(i, sentence(rng, rng.choice([0, 5, 40, 300])), rng.choice(["a", "a", "a", "b", "é", "Z", None])) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = mixing.taken_words(docs).collect()
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(WORD.findall(text))
    target, source_of = water_fill(sizes), {i: s for i, _, s in rows}
    taken = defaultdict(int)
    for r in got:
        s = source_of[r["doc_id"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(target[s]) and 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    assert len(got) == len(rows)
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 1.5 * mixing.BLOCK
    again = mixing.taken_words(docs.repartition(5)).collect()
    assert {(r["doc_id"], r["taken"]) for r in got} == {(r["doc_id"], r["taken"]) for r in again}


def test_shards_hold_fixed_numbers_of_slots(spark, monkeypatch):
    """Shards are full, sources' totals exact, slots of a source gapless, and counts spread as multinomial ones do."""
    monkeypatch.setattr(mixing, "GROUP_SHARDS", 4)
    want = {0: 5000, 1: 2000, 2: 7, 3: 0, 4: 993}
    sources = spark.createDataFrame([(r, 700, n) for r, n in want.items()], "rank long, blocks long, slots long")
    drawn = [mixing.shard_draws(sources.repartition(k), 3, 50).collect() for k in (1, 4)]
    assert sorted(drawn[0]) == sorted(drawn[1])
    by_shard, by_source = defaultdict(int), defaultdict(list)
    for r in drawn[0]:
        by_shard[r["shard"]] += r["n"]
        by_source[r["rank"]].append((r["first_slot"], r["n"]))
    groups = round(8000 / 200)
    assert sum(v != 50 for v in by_shard.values()) <= groups and max(by_shard.values()) == 50
    for rank, spans in by_source.items():
        spans.sort()
        assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:])) and sum(spans[-1]) == want[rank]
    assert set(by_source) == {0, 1, 2, 4}
    full = [s for s, n in by_shard.items() if n == 50]
    share = np.array([next((r["n"] for r in drawn[0] if r["shard"] == s and r["rank"] == 0), 0) for s in full])
    p = 5000 / 8000
    assert abs(share.mean() - 50 * p) < 1 and 0.6 < share.var() / (50 * p * (1 - p)) < 1.5


def test_shard_counts_keep_both_margins():
    rng = np.random.default_rng(5)
    for _ in range(50):
        n = rng.integers(0, 40, rng.integers(1, 12))
        parts = list(mixing.shard_counts(n, 16, np.random.default_rng(1)))
        assert [s for s, *_ in parts] == list(range(-(-int(n.sum()) // 16)))
        seen = np.zeros(len(n), np.int64)
        for shard, at, ahead, count in parts:
            assert (ahead == seen[at]).all() and (count > 0).all() and count.sum() == min(16, n.sum() - 16 * shard)
            seen[at] += count
        assert (seen == n).all()


def test_mixed_texts_do_not_depend_on_the_layout(spark):
    """Rows of one id and one size differ by their texts, and these are cut alike however rows are spread."""
    rng = random.Random(31)
    rows = [(i // 8, sentence(rng, 90), rng.choice(["a", "a", "b"])) for i in range(160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    one, other = (sorted(mixing.mixed_documents(d).collect()) for d in (docs.repartition(7), docs.orderBy("text").coalesce(2)))
    assert one == other


def test_permutations_are_permutations():
    for n in (1, 2, 3, 7, 64, 1000, 4097):
        key = np.full(n, 99, np.uint64)
        assert sorted(mixing.permuted(np.arange(n), np.full(n, n), key)) == list(range(n))
    a, b = (mixing.permuted(np.arange(500), np.full(500, 500), np.full(500, k, np.uint64)) for k in (1, 2))
    assert (a != b).mean() > 0.9


def test_mixed_documents(spark):
    docs = edge_docs(spark)
    got = mixing.mixed_documents(docs)
    assert got.columns == docs.columns
    words = defaultdict(set)
    for i, t in texts():
        words[i].add(tuple(WORD.findall(t or "")))
    total = 0
    for r in got.collect():
        mine = WORD.findall(r["text"])
        total += len(mine)
        assert mine and r["n_chars"] == len(r["text"]) and any(set(mine) <= set(w) for w in words[r["doc_id"]])
    assert total == sum(r["taken"] for r in mixing.taken_words(docs).collect())
    assert mixing.mixed_documents(empty_docs(spark)).count() == 0 and mixing.taken_words(empty_docs(spark)).count() == 0


# ------------------------------------------------------------------------------------------------ sharding


@pytest.mark.parametrize("hot", [0, 200])
def test_shards_are_even_and_keep_copies(spark, monkeypatch, hot):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 50)
    rng = random.Random(2)
    rows = [(i, sentence(rng, 5)) for i in range(250)]
    rows += [(1000 + i, f"copy {i % 40}") for i in range(120)] + [(2000 + i, "hot") for i in range(hot)] + [(None, None), (None, "x"), (7, "")]
    got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert len(got) == len(rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert set(slots) == set(range(8)) and all(sorted(x) == list(range(len(x))) for x in slots.values())
    counts = [len(x) for x in slots.values()]
    assert max(counts) - min(counts) <= 1
    where = defaultdict(set)
    for r in got:
        if r["doc_id"] is not None and 1000 <= r["doc_id"] < 2000:
            where[r["doc_id"] % 40].add(r["shard"])
    assert sum(len(x) > 1 for x in where.values()) <= (0 if not hot else 10)
    assert {(r["law"], r["grown_shard"]) for r in got} == {("rows", None)}


def test_full_shards_exchange_linked_documents(spark):
    """Every document has one copy, so no shard has free room; a shard pair can keep one pair apart at most."""
    rows = [(i, f"text {i // 2}") for i in range(1600)]
    got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    where = defaultdict(set)
    for r in got:
        where[r["doc_id"] // 2].add(r["shard"])
    assert Counter(r["shard"] for r in got) == dict.fromkeys(range(8), 200)
    assert sum(len(x) > 1 for x in where.values()) <= 28


def test_exchange_of_wishes():
    assert sharding.exchange({(63, 0, 1): 5, (63, 1, 0): 3}, [0, 0]) == ({(0, 1): 3, (1, 0): 3}, [0, 0])
    assert sharding.exchange({(63, 0, 1): 2, (63, 1, 2): 4, (63, 2, 0): 3}, [0, 0, 0])[0] == {(0, 1): 2, (1, 2): 2, (2, 0): 2}
    assert sharding.exchange({(63, 0, 1): 5, (62, 2, 1): 1}, [0, 2, 0]) == ({(2, 1): 1, (0, 1): 1}, [1, 0, 1])
    assert sharding.exchange({(63, 0, 1): 5}, [3, 0]) == ({}, [3, 0])


def test_shards_of_odd_rows(spark):
    assert sharding.shard_documents(edge_docs(spark)).count() == len(texts())
    assert sharding.shard_documents(empty_docs(spark)).count() == 0


# ------------------------------------------------------------------------------------------------ pipeline


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    docs = edge_docs(spark).union(spark.createDataFrame([(900, "token = " + "0a" * 20 + " in the text", "en", "a", 10, *["7"] * 15)], edge_docs(spark).schema))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels(spark).write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        docs = spark.createDataFrame(out.collect(), out.schema)
    assert docs.where("text like '%0a0a0a%'").count() == 0 and docs.where("text like '%[SECRET]%'").count() >= 1
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in docs.collect()}


def test_pipeline_of_empty_tables(spark, tmp_path):
    import corpus_pipeline

    empty_docs(spark).write.parquet(str(tmp_path / "documents.parquet"))
    labels(spark).write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
