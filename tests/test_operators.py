import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from pagesieve.operators import extract, filters, langid, pairing, progress, skew


# --- pairing ----------------------------------------------------------------------
def model(rows, consumes_rule):
    """Row by row: hold the latest page; the first row that consumes it ends the hold."""
    held, pairs = {}, []
    for part, seq, kind, accepted, consumed in sorted(rows):
        if kind == "open":
            held[part] = seq
        elif kind == "close" and part in held and (consumed if consumes_rule else accepted):
            page = held.pop(part)
            if accepted:
                pairs.append((part, page, seq))
    return sorted(pairs)


def random_rows(rng, parts, length):
    rows = []
    for part in range(parts):
        # most rows in one part
        for seq in range(length * (10 if part == 0 else 1)):
            accepted = rng.random() < 0.3
            rows.append((part, seq * rng.choice([1, 1, 1]), rng.choice(["open", "close", "other"]),
                         accepted, accepted or rng.random() < 0.3))
    return rows


@pytest.mark.parametrize("two_step", [False, True])
@pytest.mark.parametrize("stretch_rows", [3, 65_536])
def test_pairing_equals_row_by_row_model(spark, monkeypatch, two_step, stretch_rows):
    monkeypatch.setattr(pairing, "STRETCH_ROWS", stretch_rows)
    rng = random.Random(stretch_rows + two_step)
    rows = random_rows(rng, 60, 30)
    df = spark.createDataFrame(rows, "part int, seq bigint, kind string, acc boolean, con boolean")
    got = pairing.carry_pair(
        df.repartition(7), "part", ["seq"], F.col("kind") == "open", F.col("kind") == "close",
        F.col("acc"), F.col("con") if two_step else None)
    got = sorted((r["part"], r["held"], r["pos"]) for r in got.collect())
    assert got == model(rows, two_step)
    assert len({(p, h) for p, h, _ in got}) == len(got) > 100


def test_pairing_with_two_order_columns(spark, monkeypatch):
    monkeypatch.setattr(pairing, "STRETCH_ROWS", 4)
    rng = random.Random(11)
    rows = random_rows(rng, 8, 40)
    df = spark.createDataFrame(rows, "part int, seq bigint, kind string, acc boolean, con boolean").select(
        "part", F.floor(F.col("seq") / 13).alias("block"), "seq", "kind", "acc", "con",
        F.create_map(F.lit("n"), F.col("seq")).alias("info"))
    got = pairing.carry_pair(df, "part", ["block", "seq"], F.col("kind") == "open", F.col("kind") == "close",
                             F.col("acc"), keep=("info",)).collect()
    assert sorted((r["part"], r["held"]["seq"], r["pos"]["seq"]) for r in got) == model(rows, False)
    assert all(r["info"] == {"n": r["pos"]["seq"]} for r in got)


def test_stale_pairing_in_words(spark):
    # page A; a rejected note; no page; an accepted note meets A; another finds nothing held
    rows = [(0, 0, "close", True), (0, 1, "open", False), (0, 2, "close", False), (0, 3, "other", False),
            (0, 4, "close", True), (0, 5, "close", True), (0, 6, "open", False), (0, 7, "open", False),
            (0, 8, "close", True)]
    df = spark.createDataFrame(rows, "part int, seq bigint, kind string, acc boolean")
    got = pairing.carry_pair(df, "part", ["seq"], F.col("kind") == "open", F.col("kind") == "close", F.col("acc"))
    assert sorted((r["held"], r["pos"]) for r in got.collect()) == [(1, 4), (7, 8)]


def test_running_total(spark, monkeypatch):
    monkeypatch.setattr(pairing, "STRETCH_ROWS", 3)
    df = spark.range(100).select((F.col("id") % 2).alias("p"), "id", (F.col("id") * 3).alias("v"))
    for r in pairing.running_total(df, "p", ("id",), "v", "t").collect():
        assert r["t"] == sum(3 * i for i in range(100) if i % 2 == r["p"] and i <= r["id"])


# --- skew ----------------------------------------------------------------------------
def test_salted_join_keeps_and_drops_like_a_plain_one(spark):
    left = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 11).alias("k"))
    right = spark.createDataFrame([(7, "a"), (2, "b"), (99, "c")], "k bigint, tag string")
    for how in ("inner", "left", "left_anti", "left_semi"):
        want = sorted(left.join(right, ["k"], how).collect())
        assert sorted(skew.salted_join(left, right, ["k"], how, ["id"]).collect()) == want
        assert sorted(skew.lookup_join(left, right, ["k"], how, ["id"]).collect()) == want
        assert sorted(skew.lookup_join(left, right, ["k"], how, ["id"], max_rows=2).collect()) == want


def test_wide_join(spark):
    left = spark.createDataFrame([(i % 7 if i % 3 else None, i) for i in range(60)], "k long, id int")
    right = spark.createDataFrame(
        [(k, "é" * 40, [(j, None) for j in range(30)]) for k in (1, 2, 2, 5, 9)] + [(4, None, None)],
        "k long, s string, a array<struct<x: long, y: long>>")
    assert sorted(r[0] for r in right.select(skew.row_bytes(right)).collect()) == [
        8 + 8 + 8 + 8] + [8 + 8 + (8 + 80) + (8 + 8 + 30 * (8 + 8 + 8 + 8))] * 5
    want = sorted(left.join(right, "k").collect())
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        # all of it is sent, its keys alone, nothing
        for most, joins in ({}, (True, False)), ({"max_bytes": 1000}, (True, True)), ({"max_rows": 2}, (False, True)):
            got = skew.wide_join(left, right, ["k"], **most)
            assert sorted(got.collect()) == want
            plan = got._jdf.queryExecution().executedPlan().toString()
            assert ("BroadcastHashJoin" in plan, "SortMergeJoin" in plan) == joins
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)



@pytest.mark.parametrize("slots", [2, 50, 10_000])
def test_drop_frequent(spark, slots):
    keys = ["hot"] * 500 + ["two"] * 2 + ["three"] * 3 + [None] * 40 + [f"k{i}" for i in range(200)]
    df = spark.createDataFrame(list(enumerate(keys)), "id int, k string")
    got = Counter(r["k"] for r in skew.drop_frequent(df, F.col("k"), 2, slots).collect())
    assert got == {k: n for k, n in Counter(keys).items() if n <= 2 or k is None}


# --- language model -------------------------------------------------------------------
TEXTS = [("en", "the house and the garden of the king"), ("en", "a word in the other hand"),
         ("fr", "la maison et le jardin du roi"), ("fr", "une autre parole à l'école"),
         ("__label__de", "das Haus und der Garten des Königs")]


def grams(text):
    letters = "".join(c if c.isalpha() else " " for c in text.lower())
    s = " " + " ".join(letters.split()) + " "
    return [s[i:i + 3] for i in range(len(s) - 2)]


def brute_profile(texts):
    counts = defaultdict(Counter)
    for lang, text in texts:
        counts[lang.replace("__label__", "")].update(grams(text))
    vocabulary = len({g for c in counts.values() for g in c})
    out = {}
    for lang, c in counts.items():
        space = sum(c.values()) + vocabulary
        rest = round(math.log(1 / space) * 1e6)
        out[lang] = (rest, {g: round(math.log((n + 1) / space) * 1e6) - rest for g, n in c.items()})
    return out


def brute_scores(profile, text):
    g = grams(text)
    score = {lang: sum(w.get(x, 0) for x in g) + len(g) * rest for lang, (rest, w) in profile.items()}
    top = max(score.values())
    e = {lang: math.exp((s - top) / 1e6) for lang, s in score.items()}
    return sorted(((lang, e[lang] / sum(e.values())) for lang in e), key=lambda x: (-score[x[0]], x[0]))


@pytest.fixture(scope="module")
def profile(spark, tmp_path_factory):
    df = spark.createDataFrame(TEXTS, "lang string, text string")
    return langid.store_profile(langid.train_profile(df, "text", "lang"),
                                str(tmp_path_factory.mktemp("model") / "profile"))


def test_profile(spark, profile):
    want = brute_profile(TEXTS)
    got = {(r["lang"], r["gram"]): (r["weight"], r["default_weight"]) for r in profile.collect()}
    assert got == {(lang, g): (w, rest) for lang, (rest, ws) in want.items() for g, w in ws.items()}


def test_scores(spark, profile):
    want = brute_profile(TEXTS)
    texts = ["the king", "le roi et la maison", "Garten!", "zzz", "x", "12 34", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {r["id"]: r["languages"] for r in langid.score_languages(df, ["id"], "text", profile).collect()}
    assert set(got) == {0, 1, 2, 3, 4}, "texts without letters have no prediction"
    for i in got:
        ranked = brute_scores(want, texts[i])
        assert [x["code"] for x in got[i]] == [code for code, _ in ranked]
        assert all(abs(x["prob"] - p) < 1e-9 for x, (_, p) in zip(got[i], ranked))
    top = langid.predict_language(df, ["id"], "text", profile)
    assert {r["id"]: r["prediction"]["code"] for r in top.collect()} == {i: x[0]["code"] for i, x in got.items()}
    ranks = langid.top_k_languages(df, ["id"], "text", profile, 2).collect()
    assert Counter(r["rank"] for r in ranks) == {1: 5, 2: 5}
    assert langid.filter_predicted_language(top, "fr").count() == sum(x[0]["code"] == "fr" for x in got.values())
    assert langid.filter_predicted_language(top, "fr", enabled=False).count() == 5


def test_scores_without_broadcast(spark, profile, monkeypatch):
    df = spark.createDataFrame([(0, "the king of the garden")], "id int, text string")
    want = langid.score_languages(df, ["id"], "text", profile).collect()
    join = skew.lookup_join
    monkeypatch.setattr(langid, "lookup_join", lambda *a, **k: join(*a, **{**k, "max_rows": 0}))
    assert langid.score_languages(df, ["id"], "text", profile).collect() == want


def test_equal_scores_go_by_code(spark, tmp_path):
    df = spark.createDataFrame([("b", "same"), ("a", "same")], "lang string, text string")
    model = langid.store_profile(langid.train_profile(df, "text", "lang"), str(tmp_path / "p"))
    got = langid.score_languages(df.withColumn("id", F.lit(1)).limit(1), ["id"], "text", model).first()
    assert [(x["code"], x["prob"]) for x in got["languages"]] == [("a", 0.5), ("b", 0.5)]


# --- filters, flags, text ----------------------------------------------------------------
def test_short_texts_are_flagged_by_characters(spark):
    df = spark.createDataFrame([(n, "é" * n) for n in (399, 400, 401)], "n int, text string")
    got = {r["n"]: (r["rejected"], r["rejected_reason"]) for r in filters.flag_too_short(df).collect()}
    assert got == {399: (True, "Too_Short"), 400: (False, ""), 401: (False, "")}


def test_drop_repeated_blocks(spark):
    rows = [(p, 0, "a line seen on every page") for p in range(4)]
    rows += [(p, 1, "short") for p in range(4)] + [(p, 2, f"a line of page number {p}") for p in range(4)]
    rows += [(p, 3, "a line that is seen twice") for p in range(2)]
    df = spark.createDataFrame(rows, "page int, pos int, text string")
    kept = extract.drop_repeated_blocks(df).collect()
    assert sorted((r["page"], r["pos"]) for r in kept) == sorted(
        (p, pos) for p, pos, _ in rows if pos in (1, 2, 3))
    joined = {r["page"]: r["text"] for r in extract.text_of_blocks(df, ["page"]).collect()}
    assert joined[0] == "a line seen on every page\nshort\na line of page number 0\na line that is seen twice"


def test_fingerprint(spark):
    import hashlib

    def simhash(text):
        words = text.lower().split()
        bits = [int(hashlib.md5(w.encode()).hexdigest()[:16], 16) for w in words]
        return "%016x" % sum(1 << i for i in range(64) if 2 * sum(b >> i & 1 for b in bits) > len(bits))

    texts = ["one", "One two  three", "日本 語", "a b c d e f g " * 40]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {r["id"]: r["fingerprint"] for r in extract.fingerprint(df, ["id"], "text").collect()}
    assert got == {i: simhash(t) for i, t in enumerate(texts)}


def test_pending_keeps_duplicates_and_failures(spark):
    manifest = spark.createDataFrame([(i, p) for i, p in enumerate("abcab")], "line_no int, warc_path string")
    ledger = spark.createDataFrame([("a", "ok"), ("b", "failed"), ("b", "failed")], "warc_path string, status string")
    todo = progress.pending(manifest, ledger).orderBy("line_no").collect()
    assert [(r["line_no"], r["warc_path"]) for r in todo] == [(1, "b"), (2, "c"), (4, "b")]
    assert progress.pending(manifest, ledger.select("warc_path")).count() == 1
    assert {r["status"]: r["archives"] for r in progress.run_summary(ledger).collect()} == {"ok": 1, "failed": 2}


def test_chunks_have_exactly_the_trigrams_of_the_text(spark):
    """Also with several blanks between words (letters beyond 16 bits), one-letter words and no words."""
    import random
    from collections import Counter
    r = random.Random(8)
    texts = ["".join(r.choice("aàéÇßb 日! 𐐀.\n") for _ in range(r.randrange(40))) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in [*texts, "", "a", " ab ", "a! 𐐀b"]], "text string")
    rows = df.select(langid.trigrams(F.col("text")).alias("whole"),
                     F.flatten(F.transform(langid.chunks(F.col("text")), langid.chunk_trigrams)).alias("parts")).collect()
    assert all(Counter(x.whole) == Counter(x.parts) for x in rows) and any(x.whole for x in rows)


def test_training_goes_through_the_texts_once(spark, tmp_path):
    path = str(tmp_path / "docs")
    spark.createDataFrame([("fr", "le roi et la reine"), ("en", "the king and the queen")], "lang string, text string").write.parquet(path)
    model = langid.train_profile(spark.read.parquet(path), "text", "lang")
    assert path not in model._jdf.queryExecution().executedPlan().toString()
    assert model.where("lang = 'fr' AND gram = ' le'").count() == 1
