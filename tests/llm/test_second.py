"""Decontamination, weak labels, the language model, token packing, toxicity, repeated passages and the pipeline."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from polyvant.llm import common, decontaminate, hmm, linear, packing, queries, secrets, simhash, suffixes, tokenpack, toxicity, weaklabel


# ---- decontamination


def test_op2_finds_all_long_overlaps(spark, sf, texts):
    items = {r["item_id"]: r["text"].split() for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    grams = defaultdict(set)
    for i, w in items.items():
        for k in range(len(w) - 7):
            grams[tuple(w[k : k + 8])].add(i)
    seen = Counter()
    for d, t in texts.items():
        w = t.split()
        for k in range(len(w) - 7):
            for i in grams.get(tuple(w[k : k + 8]), ()):
                seen[d, i] += 1
    want = {k for k, n in seen.items() if n >= 0.6 * (len(items[k[1]]) - 7)}
    got = {(r["doc_id"], r["item_id"]): r["common_share"] for r in queries.op2_latent_decontamination(spark, sf).collect()}
    assert want and want <= set(got)
    assert all(got[k] >= 0.6 for k in got)


def test_op2_paraphrases_and_clean_texts(spark):
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(4000)]
    pick = lambda n: [rnd.choice(vocab) for _ in range(n)]
    items = [(i, pick(rnd.randint(15, 50))) for i in range(30)]
    docs, want = [], set()
    for d in range(300):
        w = pick(rnd.randint(0, 300))
        if d % 4 == 0:
            i, t = items[rnd.randrange(30)]
            t = [rnd.choice(vocab) if rnd.random() < 0.2 else x for x in t]  # every fifth word replaced
            t[-len(t) // 4 :] = items[i][1][-len(t) // 4 :]
            k = rnd.randint(0, len(w))
            w[k:k] = [x.upper() + "," for x in t]
            want.add((d, i))
        docs.append((d, " ".join(w)))
    dd = spark.createDataFrame(docs, "doc_id bigint, text string")
    it = spark.createDataFrame([(i, " ".join(t)) for i, t in items], "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.search(dd, it).collect()}
    assert len(got & want) >= 0.97 * len(want) and not got - want
    left = decontaminate.remove(dd, it)
    assert left.columns == dd.columns and {r["doc_id"] for r in left.collect()} == set(range(300)) - {d for d, _ in got}


def test_op2_short_items_in_long_texts(spark):
    """Against a search of every place: short items, with and without replaced words, amid over 300 other words."""
    rnd = random.Random(6)
    vocab = [f"w{i}" for i in range(3000)]
    pick = lambda n: rnd.choices(vocab, [1 / (i + 3) for i in range(3000)], k=n)
    items = {i: pick((6, 10, 15)[i % 3]) for i in range(60)}
    docs = {}
    for d in range(300):
        w = pick(330)
        w[160:160] = [rnd.choice(vocab) if rnd.random() < (0, 0.2, 0.35)[d // 60 % 3] else x for x in items[d % 60]]
        docs[d] = w
    want = set()
    for d, w in docs.items():
        for i, t in items.items():
            end = t[-max(1, len(t) // 4) :]
            for first in range(0, len(w), decontaminate.HALF):
                around = w[max(0, first - len(t)) : first + 2 * decontaminate.HALF + len(t)]
                if decontaminate.lcs(t, around) >= 0.6 * len(t) and decontaminate.lcs(end, around) >= 0.5 * len(end):
                    want.add((d, i))
                    break
    dd = spark.createDataFrame([(d, " ".join(w)) for d, w in docs.items()], "doc_id bigint, text string")
    it = spark.createDataFrame([(i, " ".join(t)) for i, t in items.items()], "item_id bigint, text string")
    assert len(want) > 200 and {(r["doc_id"], r["item_id"]) for r in decontaminate.search(dd, it).collect()} == want


@pytest.mark.parametrize("size", [16, 30])
def test_op2_item_that_most_passages_hold(spark, size):
    """Copies of an item are more than a quarter of all half-passages: each of its words is frequent."""
    rnd = random.Random(size)
    item = [f"i{k}" for k in range(size)]
    docs = [(d, " ".join(item if d < 45 else [f"w{rnd.randrange(900)}" for _ in range(22)])) for d in range(100)]
    dd = spark.createDataFrame(docs, "doc_id bigint, text string")
    it = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(f"w{k}" for k in range(40)))], "item_id bigint, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.search(dd, it).collect()} == {(d, 1) for d in range(45)}


def test_op2_odd(spark, odd, no_docs):
    items = spark.createDataFrame([(1, "same text here again"), (2, None), (3, "")], "item_id bigint, text string")
    got = decontaminate.search(odd, items).collect()
    assert {r["item_id"] for r in got} == {1} and len(got) == 5
    assert decontaminate.search(no_docs, items).count() == 0 and decontaminate.search(odd, items.limit(0)).count() == 0
    assert decontaminate.remove(odd, items).count() == odd.count() - 5 and decontaminate.remove(odd, items).columns == odd.columns
    assert decontaminate.remove(odd, items.limit(0)).count() == odd.count()


def _zipf(seed, size, n_docs):
    """200 items and texts of frequent words; every other text holds an item, of which 60 to 70 % stay in place, with
    its ending."""
    rnd = random.Random(seed)
    vocab, share = [f"w{i}" for i in range(size)], [1 / (i + 3) for i in range(size)]
    pick = lambda n: rnd.choices(vocab, share, k=n)
    items, docs, planted = {i: pick(rnd.randint(24, 60)) for i in range(200)}, {}, set()
    for d in range(n_docs):
        w = pick(rnd.randint(60, 400))
        if d % 2:
            i = rnd.randrange(200)
            t, end = list(items[i]), max(1, len(items[i]) // 4)
            for at in rnd.sample(range(len(t) - end), int((0.3 + 0.1 * rnd.random()) * len(t))):
                t[at] = rnd.choice(vocab)
            if decontaminate.lcs(items[i], t) >= 0.6 * len(t):
                k = rnd.randrange(len(w))
                w[k:k] = t
                planted.add((d, i))
        docs[d] = w
    return items, docs, planted


@pytest.mark.parametrize("size", [2000, 20000])
def test_op2_recall_with_frequent_words(spark, size):
    items, docs, planted = _zipf(size, size, 600)
    dd = spark.createDataFrame([(d, " ".join(w)) for d, w in docs.items()], "doc_id bigint, text string")
    it = spark.createDataFrame([(i, " ".join(t)) for i, t in items.items()], "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.search(dd, it).collect()}
    print(size, len(got & planted), len(planted), len(got - planted))
    assert len(planted) > 250 and len(got & planted) >= 0.95 * len(planted)


def test_op2_leading_directions():
    rng = np.random.default_rng(0)
    u = np.linalg.qr(rng.standard_normal((60, 12)))[0]
    g = u @ np.diag(0.5 ** np.arange(12)) @ u.T
    omega = rng.standard_normal((60, 20))
    q = decontaminate.leading(g @ omega, omega, 5)
    assert q.shape == (60, 5) and np.allclose(q.T @ q, np.eye(5)) and np.allclose(np.abs(q.T @ u[:, :5]), np.eye(5), atol=1e-5)


def test_lcs():
    rng = np.random.default_rng(0)
    for _ in range(40):
        a, b = rng.integers(1, 6, 20).tolist(), rng.integers(1, 6, 40).tolist()
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert decontaminate.lcs(a, b) == t[-1][-1]


# ---- weak labels


def test_op3_against_labels(spark, sf):
    got = queries.op3_weak_label_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    good, bad = [r["kept"] for r in got if r["quality"]], [not r["kept"] for r in got if not r["quality"]]
    assert np.mean(good) > 0.97 and np.mean(bad) > 0.7


def test_op3_em_recovers_accuracies():
    rng = np.random.default_rng(2)
    k, n = len(weaklabel.LABELLERS), 20000
    kind = np.where(rng.random(n) < 0.8, -1, rng.integers(0, k, n))
    votes = np.ones((n, k), dtype=int)
    votes[rng.random((n, k)) < 0.005] = 0
    for i in range(k):
        for j in (i, (i + 1) % k):  # labellers overlap
            votes[(kind == i) & (rng.random(n) < 0.95), j] = 0
    votes[rng.random((n, k)) < 0.2] = 2
    codes = (votes * 3 ** np.arange(k)).sum(axis=1)
    p, post = weaklabel.estimate(dict(Counter(codes.tolist())))
    truth, seen = kind < 0, (votes == 0).any(axis=1)
    guess = np.array([post[c] for c in codes]) > 0.5
    assert (guess == truth)[seen].mean() > 0.8 and guess[~seen].all()
    assert abs(p[:, 0, 0] - 0.005).max() < 0.02


def test_op3_against_loops(spark, sf, texts):
    """Votes of the query, and EM, computed again by loops over documents, not over counts of codes. (Few steps: later
    on, classes that start alike part by what rounding makes of them.)"""
    rows = {r["doc_id"]: r for r in queries.op3_weak_label_quality(spark, sf).collect()}
    votes = {i: weaklabel.votes(weaklabel.measures(t)) for i, t in texts.items()}
    assert {i: r["votes"] for i, r in rows.items()} == {i: "".join(map(str, v)) for i, v in votes.items()}
    k, n = len(weaklabel.LABELLERS), len(votes)
    p = [[[0.02, 0.98] if c == 0 else [0.97, 0.03] if c == 1 + i else [0.2, 0.8] for c in range(k + 1)] for i in range(k)]
    share = [0.85, *[0.15 / k] * k]
    code = {i: sum(v * 3**j for j, v in enumerate(vs)) for i, vs in votes.items()}
    codes = dict(sorted(Counter(code.values()).items()))
    for _ in range(8):
        mass, hot = [0.0] * (k + 1), [[[0.5, 0.5] for _ in range(k + 1)] for _ in range(k)]
        post = {}
        for d, vs in votes.items():
            like = [math.prod([s, *(p[i][c][v] for i, v in enumerate(vs) if v != 2)]) for c, s in enumerate(share)]
            z = sum(like)
            post[d] = like[0] / z
            for c in range(k + 1):
                mass[c] += like[c] / z
                for i, v in enumerate(vs):
                    if v != 2:
                        hot[i][c][v] += like[c] / z
        share = [(m + 1) / (n + k + 1) for m in mass]
        p = [[[x / (x + y), y / (x + y)] for x, y in row] for row in hot]
        for row in p:
            row[0] = [min(row[0][0], 0.02), 1 - min(row[0][0], 0.02)]
    near, full = (weaklabel.estimate(codes, steps=n)[1] for n in (8, 100))
    assert all(abs(near[code[d]] - x) < 1e-9 for d, x in post.items())
    assert all(abs(rows[d]["posterior"] - full[code[d]]) < 1e-9 for d in rows)
    assert all(r["kept"] == (r["score"] >= 0.5 or r["posterior"] >= 0.5) for r in rows.values())


def test_op3_scorer_sees_words(spark):
    """Bad texts share a word that no labeller looks at: with that word alone, a text is likelier to be bad."""
    rnd = random.Random(9)
    pick = lambda n: [f"w{rnd.randrange(400)}" for _ in range(n)]
    rows = [" ".join([*pick(60), "the", "of", "and", "to", "in", "is"]) for _ in range(300)] + [" ".join(["jackpot", *pick(20), *["$$$", "###"] * 15]) for _ in range(100)]
    tail = pick(60) + ["the", "of", "and", "to", "in", "is"]
    d = spark.createDataFrame([*enumerate(rows), (1000, " ".join(tail)), (1001, " ".join(["jackpot", *tail[1:]]))], "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in weaklabel.classify(d).where("doc_id >= 1000").collect()}
    assert got[1000]["votes"] == got[1001]["votes"] and 1 - got[1001]["score"] > 1.5 * (1 - got[1000]["score"])


def test_op3_odd(odd, no_docs):
    got = weaklabel.classify(odd).collect()
    assert len(got) == odd.count() and all(0 <= r["score"] <= 1 for r in got)
    assert weaklabel.classify(no_docs).count() == 0


# ---- the language model


def _model(s=3, c=20, seed=0):
    rng = np.random.default_rng(seed)
    return hmm.Model(rng.dirichlet(np.ones(s)), rng.dirichlet(np.ones(s), s), rng.dirichlet(np.ones(c), s).T), rng


def _forward(m, x):
    a, total = m.pi * m.b[x[0]], 0.0
    for o in x[1:]:
        a = (a @ m.a) * m.b[o]
        total += math.log(a.sum())
        a /= a.sum()
    return total + math.log(a.sum())


def test_op4_recursion_is_exact():
    m, rng = _model()
    seqs = [rng.integers(0, 20, n).astype(np.int32) for n in (1, 2, 63, 64, 65, 200, 129)]
    assert np.allclose(hmm.log_likelihood(seqs, m), [_forward(m, x) for x in seqs], atol=1e-9)
    starts, moves, emits = hmm.expected_counts(seqs, m)
    assert np.isclose(starts.sum(), len(seqs)) and np.isclose(moves.sum(), sum(len(x) - 1 for x in seqs))
    assert np.allclose(emits.sum(axis=1), np.bincount(np.concatenate(seqs), minlength=20))


def test_op4_baum_welch_never_gets_worse():
    m, rng = _model(seed=1)
    seqs = [rng.integers(0, 20, n).astype(np.int32) for n in (100, 150, 80)]
    last = -1e18
    for _ in range(8):
        now = hmm.log_likelihood(seqs, m).sum()
        assert now >= last - 1e-6
        last = now
        starts, moves, emits = hmm.expected_counts(seqs, m)
        m = hmm.Model(starts / starts.sum(), moves / moves.sum(axis=1, keepdims=True), emits / emits.sum(axis=0, keepdims=True))


def test_op4_base_and_held_out(spark, sf, texts):
    rows = {r["doc_id"]: r for r in queries.op4_hmm_scoring(spark, sf).collect()}
    assert rows.keys() == texts.keys()
    tokens = {i: [*t.encode().lower().split(), b"\n"] for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    c = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    for i, ws in tokens.items():
        r = rows[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(ws), sum(w in c for w in ws), n)
        assert abs(r["base_score"] - sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)) < 1e-6 * max(1, len(ws))
    out = [i for i in rows if held[i]]
    assert sum(rows[i]["score"] for i in out) > sum(rows[i]["base_score"] for i in out)


def test_op4_distributions(spark):
    """Emissions and transitions are distributions, and a tail class shares its mass out over its words and one
    unknown."""
    share = np.array([0.5, 0.3, 0.2])
    m = hmm.maximise(np.array([1.0, 0.0]), np.ones((2, 2)), np.zeros((3, 2)), share)
    assert np.allclose(m.b.sum(axis=0), 1) and np.allclose(m.a.sum(axis=1), 1) and np.isclose(m.pi.sum(), 1) and (m.b > 0).all()
    docs = spark.createDataFrame([(1, "a b a"), (2, "b c"), (3, "a")], "doc_id bigint, text string")
    assert all(r["score"] < 0 for r in hmm.score(docs, F.lit(True), states=2, own_classes=3, common=4).collect())


def test_op4_odd(odd, no_docs):
    got = hmm.score_documents(odd).collect()
    assert len(got) == odd.count() and all(np.isfinite(r["score"]) and np.isfinite(r["base_score"]) for r in got)
    assert min(r["n_tokens"] for r in got) == 1
    assert hmm.score_documents(no_docs).count() == 0
    assert hmm.score(odd, F.lit(False)).count() == odd.count()


def test_op4_start_covers_long_texts(spark):
    texts = [np.arange(n, dtype="<u2") for n in (0, 1, 4096, 4097, 60000)]
    d = spark.createDataFrame([(k, bytearray(t.tobytes())) for k, t in enumerate(texts)], "k int, x binary")
    for r in d.select("k", F.expr(hmm.START).alias("parts")).collect():
        t, parts = texts[r["k"]], [np.frombuffer(p, "<u2") for p in r["parts"]]
        if len(t) <= 4096:
            assert len(parts) == 1 and (parts[0] == t).all()
        else:
            assert [len(p) for p in parts] == [512] * 8 and parts[0][0] == 0 and parts[-1][-1] == t[-1]
            assert {int(b[0]) - int(a[0]) for a, b in zip(parts, parts[1:])} <= {(len(t) - 512) // 7, (len(t) - 512) // 7 + 1}
            assert all((np.diff(p) == 1).all() for p in parts)


def test_op4_same_scores_in_any_layout(spark, texts):
    d = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    a, b = ({r["doc_id"]: r["score"] for r in hmm.score_documents(x).collect()} for x in (d.repartition(3, "doc_id"), d.repartition(5, "text")))
    assert a.keys() == b.keys() and all(abs(a[i] - b[i]) <= 1e-9 * max(1, abs(a[i])) for i in a)


def test_op4_one_state_by_hand(spark, texts):
    """With one state, the fit has a closed form: the classes' smoothed shares. Words of tail classes share these."""
    few = dict(sorted(texts.items())[:40])
    own, common = 50, 200
    d = spark.createDataFrame(list(few.items()), "doc_id bigint, text string")
    got = {r["doc_id"]: r["score"] for r in hmm.score(d, F.col("doc_id") % 3 != 0, states=1, own_classes=own, common=common).collect()}
    tokens = {i: [*t.encode().lower().split(), hmm.END] for i, t in few.items()}
    c = Counter(w for i, ws in tokens.items() if i % 3 for w in ws)
    top = sorted(c, key=lambda w: (-c[w], hmm.word_key(w)))[:own]
    mass, held = (Counter({t: 1 for t in range(hmm.TAILS)}) for _ in range(2))
    for w in set(c).difference(top):
        mass[hmm.tail_class(w)] += c[w] + 1
        held[hmm.tail_class(w)] += c[w]
    total = sum(c[w] for w in top) + sum(held.values())
    share = {w: c[w] / total for w in top} | {t: n / total for t, n in held.items()}
    used = Counter(w if w in top else hmm.tail_class(w) for i, ws in tokens.items() if i % 3 for w in ws)
    b = {k: used[k] + 50 * share[k] + 1e-3 for k in share}
    z = sum(b.values())
    for i, ws in tokens.items():
        want = sum(math.log10(b[w] / z) if w in top else math.log10(b[hmm.tail_class(w)] / z) + math.log10((c[w] + 1) / mass[hmm.tail_class(w)]) for w in ws)
        assert abs(got[i] - want) < 1e-6 * max(1, abs(want))


def test_op4_slices():
    import pyarrow as pa

    x = pa.array(["a" * n if n >= 0 else None for n in (3, -1, 9, 1, 1, 1, 20, 2)])
    assert list(hmm.slices(x, 3, 10)) == [(0, 2), (2, 4), (4, 6), (6, 7), (7, 8)] and list(hmm.slices(x[:0])) == []


# ---- token packing


def test_op8_round_trip(spark, docs, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.default_vocabulary())
    pieces = defaultdict(dict)
    rows = tokenpack.pack_ids(docs).collect()
    for r in rows:
        ids, at = np.frombuffer(r["input_ids"], "<u4"), np.frombuffer(r["position_ids"], "<u4")
        cu = r["cu_seqlens"]
        assert len(ids) == len(at) == 2048 and cu[0] == 0 and cu[-1] == r["n_tokens"] <= 2048 and not ids[r["n_tokens"] :].any() and not at[r["n_tokens"] :].any()
        for k, (a, b) in enumerate(zip(cu, cu[1:])):
            assert at[a:b].tolist() == list(range(b - a))
            pieces[r["doc_ids"][k]][r["pieces"][k]] = (r["starts"][k], ids[a:b])
    for i, text in texts.items():
        got = [pieces[i][k] for k in sorted(pieces[i])]
        assert np.concatenate([x for _, x in got]).tolist() == [*t.encode(text, add_special_tokens=False).ids, 0]
        assert [s for s, _ in got] == [2048 * k for k in range(len(got))]
    assert len(rows) <= 1.1 * sum(r["n_tokens"] for r in rows) / 2048 + 8


def test_op8_best_fit_decreasing():
    rng = np.random.default_rng(3)
    for cap in (1, 7, 64):
        lengths = rng.integers(1, cap + 1, 300).tolist()
        rooms, rows = [], []
        for i in sorted(range(300), key=lambda i: -lengths[i]):
            fit = [r for r in range(len(rows)) if rooms[r] >= lengths[i]]
            best = min(fit, key=lambda r: rooms[r]) if fit else None
            if best is None:
                rows.append([])
                rooms.append(cap)
                best = len(rows) - 1
            rows[best].append(i)
            rooms[best] -= lengths[i]
        got = tokenpack.best_fit_decreasing(lengths, cap)
        assert len(got) == len(rows) and sorted(i for r in got for i in r) == list(range(300))
        assert all(sum(lengths[i] for i in r) <= cap for r in got)


def test_op8_odd(odd, no_docs, tmp_path):
    d = tokenpack.pack_ids(odd, width=64, buffer_tokens=200)
    assert sum(len(r["doc_ids"]) for r in d.collect()) >= odd.count()
    tokenpack.write(d, str(tmp_path / "packed"))
    assert tokenpack.digest(tokenpack.pack_ids(no_docs)).count() == 0


# ---- toxicity


def test_op9_held_out(spark, sf):
    big = sf.replace("sf0.001", "sf0.01")
    got = queries.op9_toxicity(spark, big).join(spark.read.parquet(f"{big}/labels.parquet"), "doc_id").where("held_out").collect()
    y, s = np.array([r["toxic"] for r in got]), np.array([r["score"] for r in got])
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in s[y == 1] for b in s[y == 0]])
    assert auc > 0.85
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in got)


def test_op9_reads_no_held_out_label(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    flipped = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a = {r["doc_id"]: r["score"] for r in toxicity.classify(docs, labels).collect()}
    assert a == {r["doc_id"]: r["score"] for r in toxicity.classify(docs, flipped).collect()}


def test_op9_group_terms_carry_no_weight(spark):
    """Toxic texts name one group most of the time; the penalty keeps its name from counting."""
    rnd = random.Random(1)
    base = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(1200):
        w = [rnd.choice(base) for _ in range(20)]
        y = i % 4 == 0
        if y:
            w.insert(3, rnd.choice(["insult", "slurry", "nastyword"]))
        w.insert(5, "muslims" if rnd.random() < (0.9 if y else 0.1) else "christians")
        rows.append((i, " ".join(w)))
        labels.append((i, int(y)))
    rows += [(9000, "we met muslims today"), (9001, "we met christians today")]
    d, lab = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    gap = {}
    for fairness in (0.0, 5.0):
        s = {r["doc_id"]: r["score"] for r in toxicity.classify(d, lab, fairness=fairness).where("doc_id >= 9000").collect()}
        gap[fairness] = abs(s[9000] - s[9001])
    assert gap[5.0] < 0.05 and gap[5.0] < gap[0.0]


def test_op9_swapped_terms_score_alike(spark, sf):
    """On the registered tables, whose texts name no group: terms are put in, and copies of documents that differ in
    the group alone score alike."""
    big = sf.replace("sf0.001", "sf0.01")
    docs, labels = spark.read.parquet(f"{big}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{big}/labels.parquet")
    rows = toxicity.train_rows(docs, labels, F.lit(True))
    model = toxicity.train(rows)
    assert model.rows > 300 and model.pairs >= model.rows
    some = docs.where("doc_id < 40").collect()
    extra = [(10**6 + 1000 * k + 2 * r["doc_id"] + side, f"{r['text']} {term}") for k, pair in enumerate(toxicity.IDENTITY_PAIRS[::5]) for r in some for side, term in enumerate(pair)]
    both = docs.union(spark.createDataFrame(extra, docs.schema))
    s = {r["doc_id"]: r["score"] for r in toxicity.classify(both, labels).where("doc_id < 40 or doc_id >= 1000000").collect()}
    for i, _ in extra:
        assert abs(s[i] - s[i ^ 1]) < 0.02 and abs(s[i] - s[i % 1000 // 2]) < 0.02


def test_op9_penalty_by_hand():
    """The fit reaches the least objective that coordinate search finds."""
    rng = np.random.default_rng(4)
    f = [rng.choice(5, rng.integers(0, 4), replace=False).tolist() for _ in range(40)]
    y = np.array([float(0 in x) if rng.random() < 0.9 else 0.5 for x in f])
    pairs = [([0], [1]), ([2], [])]
    for fairness in (0.0, 100.0):
        args = (y, f, pairs, fairness, 1e-2, 1e-3)
        w, b = linear.fit(y, f, 5, pairs, fairness, 1e-2, 1e-3, steps=4000)
        x, step = np.zeros(6), 1.0
        best = linear.objective(x[:5], x[5], *args)
        while step > 1e-6:
            tries = [x + step * s * np.eye(6)[k] for k in range(6) for s in (-1, 1)] + [x + step * rng.standard_normal(6) for _ in range(20)]
            values = [linear.objective(t[:5], t[5], *args) for t in tries]
            if min(values) < best:
                best, x = min(values), tries[int(np.argmin(values))]
            else:
                step /= 2
        assert linear.objective(w, b, *args) < best + 1e-5
    assert abs(w[0] - w[1]) < 0.1


def test_op9_repeated_ids_are_one_row(spark):
    d = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (2, None)], "doc_id bigint, text string")
    lab = spark.createDataFrame([(1, 1), (1, 0), (2, 0)], "doc_id bigint, toxic int")
    assert sorted((r["y"], r["text"] or "") for r in toxicity.train_rows(d, lab, F.lit(True)).collect()) == [(0.0, ""), (1.0, "a")]


def test_op9_odd(spark, odd, no_docs):
    labels = spark.createDataFrame([(1, 0), (4, 1), (None, 1), (5, None)], "doc_id bigint, toxic int")
    got = toxicity.classify(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.classify(no_docs, labels).count() == 0
    assert {r["score"] for r in toxicity.classify(odd, labels.limit(0)).collect()} == {0.5}


# ---- repeated passages


def _covered(rows, least=50):
    seen = Counter()
    for _, t in rows:
        w = (t or "").encode().split()
        seen.update(tuple(w[i : i + least]) for i in range(len(w) - least + 1))
    out = {}
    for d, t in rows:
        w = (t or "").encode().split()
        hit = np.zeros(len(w) + 2, dtype=int)
        for i in range(len(w) - least + 1):
            if seen[tuple(w[i : i + least])] > 1:
                hit[i + 1 : i + least + 1] = 1
        edges = np.flatnonzero(np.diff(hit))
        if len(edges):
            out[d] = list(zip(edges[::2].tolist(), edges[1::2].tolist()))
    return out


def _got(d, **kw):
    return {r["doc_id"]: [(x["s"], x["e"]) for x in r["spans"]] for r in suffixes.repeats(d, **kw).collect()}


@pytest.fixture(scope="module")
def passages():
    rnd = random.Random(1)
    vocab = [f"w{i}" for i in range(3000)]
    shared = [[rnd.choice(vocab) for _ in range(n)] for n in (49, 50, 51, 55, 60, 70, 120)]
    rows = []
    for i in range(150):
        w = [rnd.choice(vocab) for _ in range(rnd.randint(0, 300))]
        for _ in range(rnd.randint(0, 2)):
            p = rnd.choice(shared)
            a, b = (rnd.randint(0, 20) if rnd.random() < 0.5 else 0 for _ in range(2))
            k = rnd.randint(0, len(w))
            w[k:k] = p[a : len(p) - b]
        if rnd.random() < 0.2 and rows:
            w = rows[rnd.randrange(len(rows))][1].split()
            for _ in range(3):
                if w:
                    w[rnd.randrange(len(w))] = f"EDIT{rnd.randrange(10)}"
        rows.append((i, " ".join(w)))
    return [*rows, (1000, None), (1001, ""), (1002, rows[5][1]), (1003, "a " * 200), (1004, "a " * 30), (1005, "x " * 28 + "y " * 29 + "z " * 40)]


@pytest.mark.parametrize("long_run", [20_000, 1])
def test_op10_words_that_agree_in_16_bits(spark, long_run):
    """Passages of 49 equal words whose neighbours agree in the 16 bits that extension reads; and of 50 and 51."""
    h, by = suffixes.Hasher(), defaultdict(list)
    for i in range(3000):
        w = f"z{i}"
        by[int((h(w)[0] >> np.uint64(40)) % np.uint64(65535))].append(w)
    twins = [v for v in by.values() if len(v) > 1]
    assert len(twins) > 20
    rows, rnd = [], random.Random(4)
    for n in (48, 49, 50, 51):
        for k, (a, b, *_) in enumerate(twins[:20]):
            passage = [f"p{n}x{k}x{i}" for i in range(n)]
            for side, w in enumerate((a, b)):
                fill = [f"f{n}x{k}x{side}x{i}" for i in range(40)]
                rows.append((len(rows), " ".join([*fill, *([w] if k % 3 else []), *passage, *([w] if k % 3 < 2 else []), *reversed(fill)])))
            if k % 4 == 0:  # runs of more than two
                rows.append((len(rows), " ".join([*passage[: rnd.randint(20, n)], "end"])))
    want = _covered(rows)
    assert len(want) == 80 and _got(spark.createDataFrame(rows, "doc_id bigint, text string"), long_run=long_run) == want


@pytest.mark.parametrize("long_run", [20_000, 1])
def test_op10_exact(spark, passages, long_run):
    assert _got(spark.createDataFrame(passages, "doc_id bigint, text string"), long_run=long_run) == _covered(passages)


def test_op10_long_runs_by_context(spark):
    """Contexts that many texts share, that one text holds often, that end at a text's edge, and that differ by a word."""
    rnd = random.Random(7)
    phrase = [f"p{i}" for i in range(5)]
    passage = [f"q{i}" for i in range(110)]
    texts = [" ".join(phrase * rnd.randint(4, 40)) for _ in range(12)]
    for i in range(60):
        w = list(passage)
        if i % 3 == 0:
            w[rnd.randrange(len(w))] = f"e{rnd.randrange(4)}"
        a, b = (rnd.randint(0, 30) if i % 2 else 0 for _ in range(2))
        own = [f"o{i}_{k}" for k in range(rnd.randint(0, 40))]
        texts.append(" ".join(own + w[a : len(w) - b] + (phrase * 12 if i % 5 == 0 else [])))
    texts.append(" ".join([*passage, "m", *passage[:80], *phrase * 15, *passage[40:]]))
    rows = list(enumerate(texts))
    assert _got(spark.createDataFrame(rows, "doc_id bigint, text string"), long_run=1) == _covered(rows)


def test_op10_documents(spark, sf, texts):
    got = {r["doc_id"]: [(x["s"], x["e"]) for x in r["spans"]] for r in queries.op10_sparse_suffixes(spark, sf).collect()}
    assert got == _covered(list(texts.items()))


def test_op10_reads_two_tables(odd):
    """What the spans are made from is gone when the query returns."""
    left = len(common._session.tables)
    made = suffixes.repeats(odd)
    assert len(set(common.reads(made))) == len(common._session.tables) - left == 2


def test_op10_odd(odd, no_docs):
    got = suffixes.repeats(odd).collect()
    assert [(r["n_words"], r["n_repeated"]) for r in got] == [(3001, 3000)]
    assert suffixes.repeats(no_docs).count() == 0


# ---- the pipeline


def test_pipeline(spark, sf, texts):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "decontamination", "secret_scan", "best_fit_packing"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, spark.createDataFrame(stage(spark, kept, sf).collect(), docs.schema)
        assert kept.columns == docs.columns
        assert {r["doc_id"] for r in kept.collect()} <= {r["doc_id"] for r in before.collect()}
    rows = corpus_pipeline.STAGES[-1][1](spark, kept, sf).collect()
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in kept.collect()} and len(rows) >= kept.count() > 0


def test_pipeline_run(spark, sf, texts):
    """The whole pipeline: what it packs is what the stages leave, one by one; secrets are masked, copies are gone."""
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, sf).collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, sf).collect(), docs.schema)
    left = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert {r["doc_id"] for r in rows} == set(left) and len({t for t in left.values()}) == len(left)
    assert all(r["n_assign"] + r["n_access"] + r["n_hex"] == 0 for r in secrets.report(secrets.scan(docs)).collect())
    one = spark.createDataFrame([(1, 'see token = "24be64439e3e49cf46b2d7c9" there', "en", "s", 3)], docs.schema)
    assert [r["text"] for r in dict(corpus_pipeline.STAGES)["secret_scan"](spark, one, sf).collect()] == ['see [redacted]" there']
    fill = Counter()
    for r in rows:
        fill[r["sequence_id"]] += r["length"]
    assert max(fill.values()) <= 2048


def test_scopes_free_what_is_no_longer_read(spark, odd):
    left = len(common._session.tables)
    for _ in range(3):
        assert suffixes.repeats(odd).count() == 1 and weaklabel.classify(odd).count() == odd.count()
    assert len(common._session.tables) <= left + 3 * 6  # what the results still read: five tables and one


def test_text_ids_and_a_very_long_text(spark):
    d = spark.createDataFrame([(f"id{i}", t) for i, t in enumerate(["a b c " * 30, None, "", "a b c " * 30, "w" + " x1 y2" * 40_000])], "doc_id string, text string")
    ids = {f"id{i}" for i in range(5)}
    for made in (packing.pack(d), weaklabel.classify(d), hmm.score_documents(d), secrets.report(secrets.scan(d)), simhash.near_duplicates(d)):
        assert {r[0] for r in made.select("doc_id").collect()} == ids
    assert {i for r in tokenpack.pack_ids(d).collect() for i in r["doc_ids"]} == ids
    assert {r["doc_id"] for r in suffixes.repeats(d).collect()} == {"id0", "id3", "id4"}
    assert {r["doc_id"] for r in simhash.keep_one(d).collect()} == {"id0", "id1", "id4"}


def test_special_tokens_are_the_tokenizers(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.default_vocabulary())
    texts = ["hello <|endoftext|> world", "<|STARTOFTEXT|> x", "a<|endoftext|>b plain", "no < | endoftext |>"]
    got = {r["doc_id"]: r["ids_crc32"] for r in packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()}
    for i, x in enumerate(texts):
        assert got[i] == zlib.crc32(np.array([*t.encode(x, add_special_tokens=False).ids, 0], dtype="<u4").tobytes())


def test_pipeline_odd(spark, odd, sf):
    import corpus_pipeline

    d = odd.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        for x in (d, d.limit(0)):
            n = stage(spark, x, sf).count()
            assert n == 0 if x is not d else n <= d.count() or _ == "best_fit_packing"
