"""LM scoring, spelling variants and hard negatives against brute force, and their edge cases."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagesieve.llm import hard_negatives, jaccard_trie, lm_scoring, spelling_variants
from pagesieve.llm.langid_hd import held_out

# ------------------------------------------------------------------ op13, hard negatives

EMB = "vec_id long, embedding array<float>, label int, row string, q string, block int"


def brute_negatives(rows, m=hard_negatives.Mining()):
    """The contract, row by row: rows are (vec_id, embedding, label)."""
    valid = []
    for pos, (vid, vec, label, *_) in enumerate(rows):
        if vid is None or label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        label = (label + 1) % 10 if vid % m.relabel_every == 0 else label
        valid.append((pos, vid, label, [math.floor(256 * float(x)) for x in vec]))

    def score(a, b):
        return sum(x * y for x, y in zip(a, b))

    out = []
    for apos, aid, alabel, aq in valid:
        if aid % m.anchor_every:
            continue
        scored = sorted(((-score(aq, q), vid, pos, label) for pos, vid, label, q in valid if pos != apos))
        positives = [(vid, -s) for s, vid, pos, label in scored if label == alabel][:m.positives]
        for pid, ps in positives:
            found = [(vid, -s) for s, vid, pos, label in scored
                     if label != alabel and 50 * ps <= -100 * s <= 95 * ps][:m.negatives]
            out += [(aid, pid, r + 1, nid, ps, ns) for r, (nid, ns) in enumerate(found)]
    return sorted(out)


def random_embeddings(n, seed, width=8):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        vec = [round(r.uniform(-1, 1), 3) for _ in range(width)]
        if i % 9 == 4:
            vec = list(rows[-1][1])                     # ties: the same vector again
        rows.append((i, vec, r.randrange(3), "x", "y", 1))
    rows += [(n, [0.5, None], 1, "x", "y", 1), (n + 1, [float("nan")] * width, 1, "x", "y", 1),
             (n + 2, None, 1, "x", "y", 1), (n + 3, [0.1] * width, None, "x", "y", 1),
             (None, [0.1] * width, 1, "x", "y", 1), (n + 4, [0.3, 0.2], 2, "x", "y", 1),
             (n + 5, [float("inf")] * width, 0, "x", "y", 1), (150, [], 1, "x", "y", 1)]
    rows.append(rows[0])                                # a repeated row, anchor 0 twice
    return rows


@pytest.mark.parametrize("blocks", [(16384, 1024), (7, 2)])
def test_hard_negatives_brute_force(spark, blocks):
    rows = random_embeddings(220, 3)
    m = hard_negatives.Mining(rows_per_block=blocks[0], anchors_per_chunk=blocks[1], check_every=2)
    got = hard_negatives.mine(spark, spark.createDataFrame(rows, EMB), m)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(tuple(r) for r in got.collect()) == brute_negatives(rows, m)


def test_hard_negatives_rows_without_id_and_huge_components(spark, tmp_path):
    """By the contract only labels and vectors shut a row out, and a component may be of any finite size."""
    from pagesieve.llm.queries import op13_hard_negatives
    rows = random_embeddings(220, 5)
    rows = [(None if i % 11 == 3 else vid, vec, label, *more) for i, (vid, vec, label, *more) in enumerate(rows)]
    r = random.Random(2)
    for i, size in enumerate((1e9, 1e12, 3e38)):
        vec = [round(r.uniform(-1, 1), 3) for _ in range(8)]
        vec[i] = size
        rows.append((301 + i, vec, i % 3, "x", "y", 1))
    # a large part in one dimension must not swallow the bound on the others
    rows += [(401 + i, [0.0, 1e13 if i % 2 else 0.0] + [0.9] * 6, 1, "x", "y", 1) for i in range(12)]
    rows += [(450, [1.0, 0.0] + [0.9] * 6, 1, "x", "y", 1), (451, [0.9] * 8, 2, "x", "y", 1)]
    path = str(tmp_path / "embeddings.parquet")
    spark.createDataFrame(rows, EMB).write.parquet(path)
    valid = []
    stored = spark.read.parquet(path).collect()
    for pos, (vid, vec, label, *_) in enumerate(stored):
        if label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        label = (label + 1) % 10 if vid is not None and vid % 7 == 0 else label
        valid.append((pos, vid, label, [math.floor(256 * x) for x in vec]))
    want = []
    for apos, aid, alabel, aq in valid:
        if aid is None or aid % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(aq, q)), vid is None, vid or 0, label)
                        for pos, vid, label, q in valid if pos != apos)
        for s, no_id, pid, _ in [x for x in scored if x[3] == alabel][:5]:
            found = [x for x in scored if x[3] != alabel and -50 * s <= -100 * x[0] <= -95 * s][:3]
            want += [(aid, None if no_id else pid, n + 1, None if x[1] else x[2], -s, -x[0]) for n, x in enumerate(found)]
    assert any(w[1] is None for w in want) and any(w[3] is None for w in want)
    got = op13_hard_negatives(spark, str(tmp_path)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_hard_negatives_empty(spark):
    assert hard_negatives.mine(spark, spark.createDataFrame([], EMB)).count() == 0


def test_scan_bounds_are_exact():
    """Pruned scans give the same top rows as full products."""
    r = np.random.default_rng(1)
    import pandas as pd
    data = pd.DataFrame({"row": np.arange(500), "id": np.arange(500), "label": np.zeros(500, int),
                         "q": list(r.integers(-256, 256, (500, 40)))})
    block = hard_negatives.Block(data)
    for _ in range(20):
        q = r.integers(-256, 256, 40)
        cand, scores = block.scan(q, np.arange(500), hard_negatives.best_of(5), 3)
        full = np.stack(data["q"]) @ q
        best = cand[block.first(cand, scores, 5)]
        assert list(best) == list(np.lexsort((np.arange(500), -full))[:5])
        assert len(cand) < 500


# ------------------------------------------------------------------ op12, spelling variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")
DOCS = "doc_id long, text string, word string, key string, n long, root string"


def brute_forms(rows, min_length=7, min_count=2, factor=10):
    c = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(str.maketrans(spelling_variants.UPPER, spelling_variants.LOWER))
            if doc_id is not None:
                h = zlib.crc32(f"{doc_id}:{run}".encode())
                if h % 31 == 0:
                    i = h % len(run)
                    run = run[:i] + run[i + 1:]
            if len(run) >= min_length:
                c[run] += 1
    words = {w: n for w, n in c.items() if n >= min_count}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        if len(a) < len(b):
            a, b = b, a
        return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))

    table = {}
    for w, n in words.items():
        nb = [v for v in words if v != w and near(w, v)]
        best = min(nb, key=lambda v: (-words[v], v)) if nb else None
        form = best if best and words[best] >= factor * n else None
        table[w] = (form, n, len(nb), words[form] if form else None)
    out = []
    for w, (form, n, k, fn) in table.items():
        root = w
        while table[root][0]:
            root = table[root][0]
        out.append((w, form, root, n, k, fn))
    return sorted(out)


def variant_texts(seed):
    r = random.Random(seed)
    stems = ["colourful", "organisation", "behaviour", "Straße", "naïvement", "aaaabbbb", "mississippi"]
    rows = []
    for d in range(300):
        words = []
        for _ in range(r.randrange(1, 30)):
            w = r.choice(stems)
            if r.random() < 0.2:
                i = r.randrange(len(w))
                w = r.choice([w[:i] + w[i + 1:], w[:i] + "x" + w[i:], w[:i] + "é" + w[i + 1:]])
            words.append(w.upper() if r.random() < 0.1 else w)
        rows.append((d, " ".join(words) + ", 12 ÀÉÎ-ÕÜ", "w", "k", 1, "r"))
    rows += [(None, "colourful colourful", "w", "k", 1, "r"), (400, None, "w", "k", 1, "r"),
             (401, "", "w", "k", 1, "r"), (402, "colourfu " * 3000, "w", "k", 1, "r"), rows[0]]
    return rows


def test_spelling_variants_brute_force(spark):
    rows = variant_texts(5)
    got = spelling_variants.forms(spark, spark.createDataFrame(rows, DOCS))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    expected = brute_forms([(r[0], r[1]) for r in rows])
    assert sorted(tuple(r) for r in got.collect()) == expected
    assert any(r[1] for r in expected) and any(r[1] != r[2] or r[1] is None for r in expected)


def test_spelling_chains_follow_to_the_end(spark):
    rows = [(1, " ".join(["abcdefgh"] * 2 + ["abcdefgx"] * 20 + ["abcdefxx"] * 200), "w", "k", 1, "r")]
    got = {r.word: r for r in spelling_variants.forms(spark, spark.createDataFrame(rows, DOCS)).collect()}
    assert got["abcdefgh"].form == "abcdefgx" and got["abcdefgh"].root == "abcdefxx"
    assert got["abcdefxx"].form is None and got["abcdefxx"].root == "abcdefxx"
    assert sorted(tuple(r) for r in got.values()) == brute_forms([(1, rows[0][1])])


def test_spelling_variants_empty(spark):
    assert spelling_variants.forms(spark, spark.createDataFrame([], DOCS)).count() == 0


# ------------------------------------------------------------------ op11, LM scoring

LM_DOCS = "doc_id long, text string, doc_key string, held_out string, token string, c long"


def lm_texts(seed):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)]
    rows = []
    for d in range(400):
        start = r.randrange(50)
        words = [vocab[(start + k * 3) % 60] if r.random() < 0.8 else r.choice(vocab) for k in range(r.randrange(30))]
        rows.append((d, " ".join(w.upper() if r.random() < 0.1 else w for w in words), "a", "b", "c", 1))
    rows += [(None, "w1 w2", "a", "b", "c", 1), (500, None, "a", "b", "c", 1), (501, "", "a", "b", "c", 1),
             (502, " ".join(f"odd{i}" for i in range(5000)), "a", "b", "c", 1), rows[3]]
    return rows


def brute_base(rows, parts=7, part=2):
    def held(doc_id):
        return doc_id is None or zlib.crc32(str(doc_id).encode()) % parts == part

    def tokens(text):
        return (text or "").encode().lower().decode().split() + [""]

    counts = Counter(t for doc_id, text in rows if not held(doc_id) for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for doc_id, text in rows:
        t = tokens(text)
        out.append((doc_id, held(doc_id), len(t), sum(1 for x in t if counts[x] > 0), n,
                    sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in t)))
    return sorted(out, key=lambda x: (x[0] is None, x[0] or 0, x[2]))


def test_lm_base_and_counts(spark):
    rows = lm_texts(2)
    s = lm_scoring.Settings(vocab=40, dim=8, epochs=1)
    got = lm_scoring.score(spark, spark.createDataFrame(rows, LM_DOCS), held_out("doc_id", 7, 2), s).collect()
    assert [c for c in got[0].asDict()] == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens",
                                            "base_score", "score"]
    mine = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got),
                  key=lambda x: (x[0] is None, x[0] or 0, x[2]))
    want = brute_base([(r[0], r[1]) for r in rows])
    assert [x[:5] for x in mine] == [x[:5] for x in want]
    assert all(abs(a[5] - b[5]) < 1e-6 for a, b in zip(mine, want))
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)


def test_lm_score_is_the_model_probability(spark):
    """score = sum of log10 P per token, recomputed position by position."""
    rows = lm_texts(4)
    s = lm_scoring.Settings(vocab=30, dim=8, epochs=2)
    keyed = spark.createDataFrame(rows, LM_DOCS).select(
        F.monotonically_increasing_id().alias("doc_key"), "doc_id", held_out("doc_id", 7, 2).alias("held_out"), "text")
    model, counts = lm_scoring.train(spark, keyed.where(~F.col("held_out")), s)
    got = {r.doc_id: r.score for r in lm_scoring.apply(spark, keyed, model, counts, s).collect()}
    c = {r.token: r.c for r in counts.collect()}
    index = {t: i for i, t in enumerate(model.tokens)}
    other, start = len(model.tokens), lm_scoring.index_of_end(model)
    rest = model.n_other + model.v_other + 1
    for doc_id, text, *_ in rows[:40]:
        tokens = (text or "").encode().lower().decode().split() + [""]
        ids = [index.get(t, other) for t in tokens]
        total, before = 0.0, [start] * s.context
        for t, i in zip(tokens, ids):
            r = sum(model.C[k] * model.R[before[-1 - k]] for k in range(s.context))
            logits = (model.Q @ r + model.b).astype(np.float64)
            p = math.exp(logits[i] - logits.max()) / np.exp(logits - logits.max()).sum()
            total += math.log10(p) + (math.log10((c.get(t, 0) + 1) / rest) if i == other else 0.0)
            before = before[1:] + [i]
        assert abs(got[doc_id] - total) < 1e-3 * max(1.0, abs(total))


def test_lm_probabilities_sum_to_one():
    r = np.random.default_rng(0)
    model = lm_scoring.Model(["a", "b", ""], np.array([5, 3, 2]), r.standard_normal((4, 6)).astype(np.float32),
                             r.standard_normal((4, 6)).astype(np.float32), np.ones((2, 6), np.float32),
                             r.standard_normal(4).astype(np.float32), 12, 5)
    ctx = np.array([[0, 1]] * 4)
    lp = lm_scoring.log_probabilities(model, ctx, np.arange(4))
    assert abs(np.exp(lp).sum() - 1) < 1e-5


def test_lm_empty_table(spark):
    empty = spark.createDataFrame([], LM_DOCS)
    assert lm_scoring.score(spark, empty, held_out("doc_id", 7, 2), lm_scoring.Settings(epochs=1)).count() == 0


def test_training_takes_every_position_of_every_text(spark, monkeypatch):
    """The weights are fitted on all training texts, also beyond two million positions."""
    import pyarrow as pa
    schema, chunk = lm_scoring._SENT, lm_scoring.CHUNK

    def counting(model, s):
        size = len(model.flat())

        def fit(batches):
            seen = sum(len(t.split()) + 1 for b in batches for t in b.column("text").to_pylist())
            yield pa.RecordBatch.from_pylist(
                [{"chunk": i // chunk, "weight": 1.0, "values": [float(seen)] * min(chunk, size - i)}
                 for i in range(0, size, chunk)], schema=schema)
        return fit

    monkeypatch.setattr(lm_scoring, "_fitter", counting)
    df = spark.range(50).coalesce(1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("ab "), 50_000).alias("text"))
    model, _ = lm_scoring.train(spark, df, lm_scoring.Settings(dim=4, epochs=1))
    assert model.n == 50 * 50_001 and model.b[0] == model.n


def random_model(classes, dim, context, seed, scale=1.0):
    r = np.random.default_rng(seed)
    table = lambda *shape: (scale * r.standard_normal(shape)).astype(np.float32)
    return lm_scoring.Model([str(i) for i in range(classes - 1)], r.integers(1, 99, classes - 1), table(classes, dim),
                            table(classes, dim), table(context, dim), table(classes), 9999, 500)


@pytest.mark.parametrize("context,scale", [(1, 1.0), (2, 1.0), (3, 1.0), (2, 6.0)])
def test_lm_normalisers_do_not_score_all_classes_per_context(monkeypatch, context, scale):
    """They come from tables of factors; scores of all classes are made for sums out of range alone."""
    model = random_model(40, 5, context, 3, scale)
    ctx = np.random.default_rng(4).integers(0, 40, (500, context))
    logits = (model.R[ctx].astype(np.float64) * model.C).sum(axis=1) @ model.Q.T.astype(np.float64) + model.b
    top = logits.max(axis=1)
    right = top + np.log(np.exp(logits - top[:, None]).sum(axis=1))
    if scale == 1.0:
        monkeypatch.setattr(lm_scoring, "predicted", None)
    got = lm_scoring.Normalisers(model).of(ctx)
    assert np.allclose(got, right, rtol=1e-5, atol=1e-4)


def test_lm_training_step_moves_each_class_by_its_mean_change():
    model, rate, r = random_model(20, 6, 2, 5), 0.05, np.random.default_rng(6)
    R, Q, C, b = (x.astype(np.float64) for x in (model.R, model.Q, model.C, model.b))
    ctx, target, noise = r.integers(0, 20, (64, 2)), r.integers(0, 20, 64), r.integers(0, 15, (64, 7))
    log_kpn = np.log(7 * model.unigram())
    moved, seen = {x: np.zeros_like(t) for x, t in (("R", R), ("Q", Q), ("C", C), ("b", b))}, np.zeros((2, 20))
    for c, t, others in zip(ctx, target, noise):
        v, back = (R[c] * C).sum(axis=0), np.zeros(6)
        for i, w in enumerate([t, *others]):
            g = rate * (1 / (1 + math.exp(-(Q[w] @ v + b[w] - log_kpn[w]))) - (i == 0))
            moved["Q"][w] -= g * v
            moved["b"][w] -= g
            back += g * Q[w]
            seen[0, w] += 1
        for i, w in enumerate(c):
            moved["R"][w] -= back * C[i]
            moved["C"][i] -= back * R[w] / 64
            seen[1, w] += 1
    often = np.maximum(seen, 1)
    scratch = lm_scoring.Scratch()
    lm_scoring.nce_step(random_model(20, 6, 2, 1), ctx.repeat(2, 0), target.repeat(2), noise.repeat(2, 0),
                        log_kpn.astype(np.float32), rate, scratch)  # what is left of a larger batch does no harm
    lm_scoring.nce_step(model, ctx, target, noise, log_kpn.astype(np.float32), rate, scratch)
    assert np.allclose(model.Q, Q + moved["Q"] / often[0][:, None], atol=1e-5)
    assert np.allclose(model.b, b + moved["b"] / often[0], atol=1e-5)
    assert np.allclose(model.R, R + moved["R"] / often[1][:, None], atol=1e-5)
    assert np.allclose(model.C, C + moved["C"], atol=1e-5)


def test_lm_draw_is_a_search_in_the_sums():
    shares = random_model(300, 2, 1, 7).unigram()
    chances = np.random.default_rng(8).random((500, 10))
    chances[0, :3] = 0.0, 1 - 2.0 ** -53, np.cumsum(shares)[5]
    right = np.minimum(np.searchsorted(np.cumsum(shares), chances), 299)
    assert (lm_scoring.Draw(shares).of(chances) == right).all()


def test_lm_equal_positions_are_worked_on_together(monkeypatch):
    """Many equal positions cost few rows; their weights add up to all positions."""
    r, s = np.random.default_rng(9), lm_scoring.Settings(batch=64)
    model, rows, weights = random_model(20, 4, 2, 1), [], []
    ctx, target = r.integers(0, 3, (5000, 2)), r.integers(0, 3, 5000)
    keys = lm_scoring.context_keys(ctx, 20) * 20 + target

    def noted(model, ctx, target, noise, log_kpn, rate, scratch, seen, share, often):
        rows.append(np.count_nonzero(seen))
        weights.append(seen.sum())
        assert noise.size * share == pytest.approx(s.noise * noise.shape[0])

    monkeypatch.setattr(lm_scoring, "nce_step", noted)
    p = model.unigram()
    lm_scoring.fit_positions(model, keys, s, lm_scoring.Draw(p), np.log(s.noise * p), r, lm_scoring.Scratch())
    assert sum(weights) == pytest.approx(5000)
    assert sum(rows) <= 5000 / lm_scoring.MOST + 27
    found, tokens, seen = lm_scoring.distinct_positions(keys, 20, 2)
    assert {(*c, t): n for c, t, n in zip(found.tolist(), tokens.tolist(), seen.tolist())} == Counter(
        (*c, t) for c, t in zip(ctx.tolist(), target.tolist()))


def test_lm_step_on_weighted_positions_is_the_step_on_all_of_them():
    r, often = np.random.default_rng(12), (np.full(20, 9.0, np.float32), np.full(20, 5.0, np.float32))
    ctx, target, times = r.integers(0, 20, (16, 2)), r.integers(0, 20, 16), r.integers(1, 5, 16)
    noise, log_kpn = r.integers(0, 20, (1, 7)), np.log(7 * random_model(20, 6, 2, 5).unigram()).astype(np.float32)
    once, all_ = random_model(20, 6, 2, 5), random_model(20, 6, 2, 5)
    lm_scoring.nce_step(once, ctx, target, noise, log_kpn, 0.05, None, times.astype(np.float32), 0.5, often)
    lm_scoring.nce_step(all_, ctx.repeat(times, 0), target.repeat(times), noise, log_kpn, 0.05, None, None, 0.5, often)
    assert np.allclose(once.flat(), all_.flat(), atol=1e-5)


def test_lm_tokens_of_a_batch():
    import pyarrow as pa
    texts = ["", None, " a  B\t", "\x0bq\x1cR\x85s", "\u00c9 x\ny \r\n", " \t", "\u3000 z"]
    tokens, lengths = lm_scoring.tokens_in(pa.array(texts))
    right = [[*(t or "").encode().lower().split(), b""] for t in texts]
    assert [t.encode() for t in tokens.to_pylist()] == [t for x in right for t in x]
    assert lengths.tolist() == [len(x) for x in right]
    ids = np.arange(len(tokens))
    assert lm_scoring.contexts(ids, lengths, 2, -1)[2:6].tolist() == [[-1, -1], [2, -1], [3, 2], [-1, -1]]


def test_lm_only_rare_tokens_are_joined(spark, monkeypatch):
    """Counts of frequent tokens are known where texts are scored; only the others are listed for the join."""
    rows = [(i, " ".join(f"t{k}" for k in range(40)) + f" rare{i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("held_out", F.lit(False))
    s, seen = lm_scoring.Settings(vocab=5, dim=4, epochs=1), []
    plain = lm_scoring._scorer
    monkeypatch.setattr(lm_scoring, "RESOLVED", 1000)
    monkeypatch.setattr(lm_scoring, "_scorer", lambda *x: seen.append({t for t, _ in x[3]}) or plain(*x))
    model, counts = lm_scoring.train(spark, docs, s)
    got = {r.doc_id: r for r in lm_scoring.apply(spark, docs, model, counts, s).collect()}
    assert seen == [{f"t{k}" for k in range(40)} - set(model.tokens)]
    n, v = model.n, model.v
    assert all(abs(got[i].base_score - (41 * math.log10(61 / (n + v + 1)) + math.log10(2 / (n + v + 1)))) < 1e-6
               and got[i].n_known == 42 for i in range(60))


# ------------------------------------------------------------------ near-duplicates: edges between candidates


def test_candidates_of_a_large_group_have_few_edges(spark, tmp_path, monkeypatch):
    """A group of near copies in many tasks is connected by few edges, and its parts are not stored."""
    r = random.Random(5)
    base = [f"w{i}" for i in range(400)]
    rows = []
    for k in range(400):
        words = list(base)
        for i in r.sample(range(400), 4):
            words[i] = f"x{k}y{i}"
        rows.append((k, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(20).cache()
    monkeypatch.setattr(jaccard_trie, "work_path", lambda _, name: f"{tmp_path}/{name}")
    edges, able = jaccard_trie.candidate_edges(docs, "text", 5, 80, bytes(jaccard_trie.COMMON_SLOTS // 8))
    edges = edges.where("a <> b").distinct()
    assert edges.count() < 4 * 400
    assert able.count() == 400
    up = jaccard_trie.roots(*(np.array(c) for c in zip(*edges.collect())))[1]
    assert len(up) == 400 and len(set(up.tolist())) == 1
    stored = sum(f.stat().st_size for f in tmp_path.rglob("*.parquet"))
    assert stored < sum(len(t) for _, t in rows) / 4


def test_parts_of_sets_in_bytes():
    keys, owners = np.arange(5, dtype=np.uint64), np.array([-7, 3, 3, 9, -1])
    views, tops = np.array([0, 1, 2, 3, 0], np.uint8), np.array([-7, -9, -9, 9, -4])
    for n in (5, 1, 0):
        got = jaccard_trie.unpacked(jaccard_trie.packed(keys[:n], owners[:n], views[:n], tops[:n]))
        assert [x.tolist() for x in got] == [x[:n].tolist() for x in (keys, owners, views, tops)]
    assert jaccard_trie.renamed(owners, np.array([-7, 3]), np.array([1, 2])).tolist() == [1, 2, 2, 9, -1]
    assert [x.tolist() for x in jaccard_trie.roots(np.array([5, 9, 4]), np.array([2, 5, 3]))] == [
        [2, 3, 4, 5, 9], [2, 3, 3, 2, 2]]
