"""The near-duplicate stage against brute force, and its large buckets."""

import random
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from polyvant.llm import common, similar, simhash


def _kept(texts, shingle=5, similarity=0.8):
    """The smallest id of each group, by loops."""
    sets = {i: similar._set(t, shingle) for i, t in texts.items()}
    up = {i: i for i in texts}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    def join(a, b):
        a, b = sorted((find(a), find(b)))
        up[b] = a

    held = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            held[x].append(i)
    both = Counter()
    for v in held.values():
        both.update((a, b) for k, a in enumerate(v) for b in v[:k])
    for (a, b), n in both.items():
        if n >= similarity * len(sets[a] | sets[b]):
            join(a, b)
    ids = sorted(texts)
    fp = np.array([simhash.fingerprint(texts[i], shingle) for i in ids], dtype=np.int64).view(np.uint64)
    for k, i in enumerate(ids):
        for j in np.flatnonzero(np.bitwise_count(fp ^ fp[k]) <= 2):
            join(i, ids[j])
    return {i for i in texts if find(i) == i}


def test_stage_against_loops(docs, texts):
    assert {r["doc_id"] for r in simhash.keep_one(docs).collect()} == _kept(texts)


def test_copies_edited_apart_are_one_group(spark):
    """Copies resemble their source, and one another too little: a large bucket's hub has to be the source."""
    rnd = random.Random(3)
    vocab = [f"w{i}" for i in range(5000)]
    texts = {}
    for g in range(3):
        source = [rnd.choice(vocab) for _ in range(240)]
        texts[g * 100 + 50] = " ".join(source)
        for k in range(45):
            w = list(source)
            for at in rnd.sample(range(240), 4):
                w[at] = rnd.choice(vocab)
            texts[g * 100 + k] = " ".join(w)
    texts |= {1000 + i: " ".join(rnd.choice(vocab) for _ in range(100)) for i in range(50)}
    want = _kept(texts)
    assert len(want) == 53
    got = {r["doc_id"] for r in simhash.keep_one(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")).collect()}
    assert got == want


def test_large_buckets_leave_no_link_out(spark):
    """A template with slots, where only neighbours in one slot are similar (0.89), and pairs of near copies in
    boilerplate: most of these links are between members of large buckets of which neither is the hub."""
    rnd = random.Random(8)
    vocab = [f"w{i}" for i in range(20000)]
    pick = lambda n: [rnd.choice(vocab) for _ in range(n)]
    fixed = [pick(12) for _ in range(7)]
    slot = [[f"s{k}x{v}" for v in range(3)] for k in range(6)]
    texts = {i: " ".join(w for k in range(7) for w in fixed[k] + (slot[k][i // 3**k % 3 : i // 3**k % 3 + 1] if k < 6 else [])) for i in range(729)}
    boiler = pick(265)
    for p in range(300):
        own = pick(35)
        for side in range(2):
            w = boiler + own
            for at in (275, 285, 290):
                w[at] = f"{p}x{side}x{at}"
            texts[10000 + 2 * p + side] = " ".join(w)
    sample = [texts[i] for i in (0, 1, 4, 10000, 10001, 10002)]
    assert similar.jaccard(*sample[:2], 5) > 0.8 > similar.jaccard(sample[0], sample[2], 5)
    assert similar.jaccard(*sample[3:5], 5) > 0.8 > similar.jaccard(sample[3], sample[5], 5)
    got = {r["doc_id"] for r in simhash.keep_one(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string"), threshold=0).collect()}
    first, want = {}, {0}
    for p in range(10000, 10600, 2):  # pairs with an equal fingerprint are one group
        of = [simhash.fingerprint(texts[i], 5) for i in (p, p + 1)]
        root = min((first[f] for f in of if f in first), default=p)
        first |= {f: root for f in of if f not in first}
        want |= {root}
    assert len(want) > 280 and got == want


def test_replicas_are_not_broadcast(spark):
    """About 61 rows are made of each fingerprint, which the size of the stored table does not tell."""
    fps = common.cut(spark.range(5000).select(F.xxhash64("id").alias("_fp")), "fps")
    plan = simhash.links(fps)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_stage_sends_the_driver_no_more_than_it_ranks(spark):
    """Buckets grow with the texts, and so do the shingles that two of them hold."""
    bands = F.transform(F.sequence(F.lit(1), F.lit(32)), lambda i: F.xxhash64(F.floor(F.col("id") / 8), i))
    pairs, _ = similar.candidates(common.cut(spark.range(2000).select(F.col("id").alias("_h"), bands.alias("bands")), "sketches"))
    assert "SortMergeJoin" in pairs._jdf.queryExecution().executedPlan().toString() and pairs.count() == 2000 // 8 * 28
    counts = spark.createDataFrame([(x, 2 + x // 10) for x in range(100)], "x bigint, n bigint")
    assert [similar._least(counts, k) for k in (100, 99, 30, 29, 9)] == [2, 3, 9, 10, 1 << 62]
    rnd = random.Random(5)
    texts = [[str(rnd.randrange(60)) for _ in range(12)] for _ in range(60)]
    texts += [[*t[:-1], "z"] for t in texts]
    src = spark.createDataFrame([(i, i, " ".join(t)) for i, t in enumerate(texts)], "_h bigint, root bigint, text string")
    got = [{tuple(r) for r in similar.crossing(src.drop("text"), src.drop("root"), 0.5, lambda t: simhash.shingle_hashes(t, 2), ranked=n).collect()} for n in (0, 20, 1 << 18)]
    similar_enough = {(i, j) for j in range(120) for i in range(j) if similar.jaccard(" ".join(texts[i]), " ".join(texts[j]), 2) >= 0.5}
    assert len(similar_enough) >= 60 and all(similar_enough <= g for g in got)
