import json
import os

import pytest
from pyspark.sql import functions as F

from pagesieve.operators import langid
from pagesieve.operators.progress import pending
from pagesieve.plans.refine import Settings, failed_archives, quarantined, refine
from pagesieve.sources import ledger as L
from pagesieve.sources import sinks
from pagesieve.sources.manifest import read_manifest, with_location
from pagesieve.sources.warc import archive_pieces, land_archives
from pagesieve.streaming.ingest import ingest
from tests.archives import languages, page, record, write_gz

FR = "la maison et le jardin du roi sont dans la ville avec une école et des enfants qui jouent dans la rue. "
EN = "the house and the garden of the king are in the town with a school and children who play in the street. "


@pytest.fixture(scope="module")
def profile(spark, tmp_path_factory):
    df = spark.createDataFrame([("fr", FR * 3), ("en", EN * 3)], "lang string, text string")
    return langid.store_profile(langid.train_profile(df, "text", "lang"),
                                str(tmp_path_factory.mktemp("model") / "profile"))


def french(n, repeat=6):
    return page(FR * repeat + str(n), f"Le jardin du roi et la maison {n}")


def write_all(folder):
    os.makedirs(folder, exist_ok=True)
    write_gz(folder / "ok.warc.gz",
             record("response", "p1", french(1), uri="http://a.example/1"),
             record("metadata", "n1", languages(("fr", 0.8), ("en", 0.1)), refers="p1"),
             record("response", "p2", page(EN * 6, "The garden of the king and the house"), uri="http://a.example/2"),
             record("metadata", "n2", languages(("en", 0.9)), refers="p2"),
             record("response", "p3", french(3, 1), uri="http://a.example/3"),
             record("metadata", "n3", languages(("fr", 0.5), ("en", 0.5)), refers="p3"))
    write_gz(folder / "stale.warc.gz",
             record("metadata", "n0", languages(("fr", 0.9))),
             record("response", "A", french("A"), uri="http://a.example/A"),
             record("metadata", "nA", languages(("en", 0.9)), refers="A"),
             record("response", "pdf", b"%PDF", content_type="application/pdf"),
             record("metadata", "nP", languages(("fr", 0.9)), refers="pdf"),
             record("metadata", "nQ", languages(("fr", 0.9))),
             record("response", "B", french("B"), uri="http://a.example/B"),
             record("metadata", "nX", b"fetchTimeMs: 1\r\n"),
             record("metadata", "nB", languages(("fr", 0.9)), refers="B"))
    write_gz(folder / "bad.warc.gz",
             record("metadata", "orphan", b"x: {broken}\r\n"),
             record("response", "C", french("C"), uri="http://a.example/C"),
             record("metadata", "nC", b"x: {broken}\r\n" + languages(("fr", 0.9)), refers="C"),
             record("response", "D", french("D"), uri="http://a.example/D"),
             record("metadata", "nD", languages(("fr", 0.9)), refers="D"))
    return folder


@pytest.fixture(scope="module")
def records(spark, tmp_path_factory):
    folder = write_all(tmp_path_factory.mktemp("archives"))
    out = str(tmp_path_factory.mktemp("landed"))
    return land_archives(archive_pieces(spark, str(folder)), out, base=str(folder))


def notes_of(docs):
    return sorted(r["id"] for r in docs.select(F.col("rec_headers")["WARC-Record-ID"].alias("id")).collect())


def test_raw_documents(spark, records, profile):
    docs = refine(records, Settings(target="fr"), profile)
    assert docs.columns == ["raw_data", "encoding", "rec_headers", "metadata", "warc_path"]
    # the page of nP is A: the English note left it held, and the PDF was no page
    assert notes_of(docs) == ["<n1>", "<n3>", "<nB>", "<nD>", "<nP>"]
    import base64
    rows = {r["rec_headers"]["WARC-Record-ID"]: r for r in docs.collect()}
    assert base64.b64decode(rows["<nP>"]["raw_data"]) == french("A")
    assert rows["<n1>"]["warc_path"] == "ok.warc.gz" and rows["<n1>"]["encoding"] == "base64"
    assert "\n" not in rows["<n1>"]["raw_data"]


def test_staging_changes_nothing(spark, records, profile, tmp_path):
    plain = refine(records, Settings(target="fr", mode="text"), profile)
    staged = refine(records, Settings(target="fr", mode="text"), profile, stage=str(tmp_path / "stage"))
    key = ["warc_path", "source"]
    cols = [c for c in plain.columns if c not in ("metadata", "rec_headers")]
    assert plain.select(*[F.col(f"`{c}`") for c in cols]).orderBy(*key).collect() == \
        staged.select(*[F.col(f"`{c}`") for c in cols]).orderBy(*key).collect()


def test_classifier_can_be_off(spark, records, profile):
    # p2 is English by its annotation and its title; ask for English with and without the model
    assert notes_of(refine(records, Settings(target="en"), profile)) == ["<n2>"]
    # without the model the English note after page A takes that page
    assert notes_of(refine(records, Settings(target="en", classify=False))) == ["<n2>", "<nA>"]


def test_text_documents(spark, records, profile):
    docs = refine(records, Settings(target="fr", mode="text", run_date="2024-07-08"), profile)
    rows = {r["rec_headers"]["WARC-Record-ID"]: r.asDict() for r in docs.collect()}
    full = rows["<n1>"]
    assert list(full) == (
        "title author hostname date fingerprint id license comments raw_text text language image pagetype filedate "
        "source source-hostname excerpt categories tags rejected rejected_reason languages-fasttext rec_headers "
        "metadata warc_path").split()
    assert full["title"] == "Le jardin du roi et la maison 1" and full["hostname"] == "a.example"
    assert full["text"] == (FR * 6 + "1").strip() and full["rejected"] is False and full["rejected_reason"] == ""
    assert full["filedate"] == "2024-07-08" and full["comments"] == "" and full["id"] is None
    assert full["languages-fasttext"]["code"] == "fr" and len(full["fingerprint"]) == 16
    assert rows["<n3>"]["rejected"] is True and rows["<n3>"]["rejected_reason"] == "Too_Short"
    meta = json.loads(docs.where("rec_headers['WARC-Record-ID'] = '<n1>'").select(F.to_json("metadata")).first()[0])
    assert meta["languages-cld2"]["languages"][0] == {"code": "fr", "text-covered": 0.8}
    assert meta["fetchTimeMs"] == "3"


def test_text_options(spark, records, profile, tmp_path):
    def run(**options):
        run.n = getattr(run, "n", 0) + 1
        return refine(records, Settings(target="fr", mode="text", **options), profile, stage=str(tmp_path / f"s{run.n}"))

    assert run(body_gate=True).count() == 5
    any_json = run(json="any").select(F.to_json("metadata").alias("m"))
    assert all(json.loads(r["m"])["fetchTimeMs"] == 3 for r in any_json.collect())
    assert run(max_repeats=1).count() == 5, "every page has a line of its own"


def test_keyed_pairing(spark, records, profile):
    docs = refine(records, Settings(target="fr", pairing="keyed"), profile)
    assert notes_of(docs) == ["<n1>", "<n3>", "<nB>", "<nD>"]


def test_content_first_pairing(spark, records, profile):
    docs = refine(records, Settings(target="fr", pairing="content_first"), profile)
    # B: closed by the note without languages; rec_headers are the page's own
    assert notes_of(docs) == ["<A>", "<D>", "<p1>", "<p3>"]


def test_failed_archives(spark, records, profile):
    strict = Settings(target="fr", fail_mode="archive")
    assert [r["warc_path"] for r in failed_archives(records, strict).collect()] == ["bad.warc.gz"]
    assert notes_of(refine(records, strict, profile)) == ["<n1>", "<n3>", "<nB>", "<nP>"]
    reasons = {r["record_id"]: r["reason"] for r in quarantined(records).collect()}
    assert reasons == {"<orphan>": "annotation", "<nC>": "annotation"}


def test_unknown_settings(records):
    for bad in (dict(pairing="x"), dict(fail_mode="x"), dict(mode="x"), dict(content_match="x")):
        with pytest.raises(ValueError):
            refine(records, Settings(classify=False, **bad))


# --- sources and sinks ----------------------------------------------------------------
def test_manifest(spark, tmp_path):
    import gzip
    path = tmp_path / "warc.paths.gz"
    path.write_bytes(gzip.compress(b"b/1.warc.gz\na/2.warc.gz\nb/1.warc.gz\n"))
    got = with_location(read_manifest(spark, str(path)), "s3a://x/").orderBy("line_no").collect()
    assert [r["warc_path"] for r in got] == ["b/1.warc.gz", "a/2.warc.gz", "b/1.warc.gz"]
    assert got[0]["location"] == "s3a://x/b/1.warc.gz"


def test_ledger_snapshot(spark, tmp_path):
    path = tmp_path / "progress.txt"
    assert L.read_ledger_snapshot(spark, str(path)).count() == 0
    path.write_text('{"processed_file_names": ["a", "b"], "last_itr_count": 0}')
    assert sorted(r[0] for r in L.read_ledger_snapshot(spark, str(path)).collect()) == ["a", "b"]
    path.write_text("not json")
    assert L.read_ledger_snapshot(spark, str(path)).count() == 0


def test_ledger_batches_replace_themselves(spark, tmp_path):
    path = str(tmp_path / "ledger")
    assert L.read_ledger(spark, path).count() == 0
    rows = spark.createDataFrame([("a", "ok")], "warc_path string, status string")
    for batch in (0, 1, 1):
        L.append_ledger(rows, path, batch)
    assert sorted((r["warc_path"], r["batch_id"]) for r in L.read_ledger(spark, path).collect()) == [("a", 0), ("a", 1)]


def test_json_lines_keep_nulls_and_characters(spark, tmp_path):
    import gzip
    df = spark.createDataFrame([(1, "日本 \"x\"\n", None), (2, "é", "y")], "n int, t string, u string").coalesce(1)
    path = str(tmp_path / "out")
    sinks.write_shards(df, path, "jsonl.gz")
    file, = (f for f in os.listdir(path) if f.startswith("part-"))
    data = gzip.decompress(open(f"{path}/{file}", "rb").read())
    assert data.decode().splitlines() == ['{"n":1,"t":"日本 \\"x\\"\\n","u":null}', '{"n":2,"t":"é","u":"y"}']
    sinks.write_shards(df.where("n = 2"), path, "jsonl.gz", mode="append")
    assert spark.read.schema(df.schema).json(path).count() == 3


def test_shard_ids_sort_by_time(spark):
    ids = [sinks.shard_id("2024-07-08T00:00:00", 2), sinks.shard_id("2024-07-08T00:00:00", 10),
           sinks.shard_id("2024-07-09T00:00:00", 0)]
    assert ids == sorted(ids) and len(set(ids)) == 3


# --- streaming -----------------------------------------------------------------------------
def test_ingest_resumes(spark, profile, tmp_path):
    folder, out = write_all(tmp_path / "in"), str(tmp_path / "out")
    settings = Settings(target="fr", fail_mode="archive")

    def run():
        ingest(spark, str(folder), out, settings, profile, archives_per_batch=2, base=str(folder))
        docs = spark.read.parquet(f"{out}/documents")
        return notes_of(docs), L.read_ledger(spark, f"{out}/ledger")

    found, ledger = run()
    assert found == ["<n1>", "<n3>", "<nB>", "<nP>"]
    status = {r["warc_path"]: r["status"] for r in ledger.collect()}
    assert status == {"ok.warc.gz": "ok", "stale.warc.gz": "ok", "bad.warc.gz": "failed"}
    assert ledger.select("batch_id").distinct().count() == 2
    manifest = spark.createDataFrame([(p,) for p in [*status, "new.warc.gz"]], "warc_path string")
    assert sorted(r[0] for r in pending(manifest, ledger).collect()) == ["bad.warc.gz", "new.warc.gz"]
    assert run()[0] == found, "nothing new, nothing twice"
    write_gz(folder / "new.warc.gz", record("response", "N", french("N"), uri="http://a.example/N"),
             record("metadata", "nN", languages(("fr", 0.9))))
    found, ledger = run()
    assert found == ["<n1>", "<n3>", "<nB>", "<nN>", "<nP>"] and ledger.count() == 4


def _shuffled_columns(df):
    """Names of the columns every hash or range exchange of the physical plan moves."""
    plan = df._jdf.queryExecution().executedPlan()
    found, todo = [], [plan]
    while todo:
        node = todo.pop()
        if "AdaptiveSparkPlan" in node.nodeName():
            todo.append(node.executedPlan())
            continue
        text = node.simpleString(100)
        if node.nodeName() == "Exchange" and "RoundRobin" not in text and "SinglePartition" not in text:
            found.append([a.name() for a in node.output().toSeq()])
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
        subqueries = node.subqueries()
        todo += [subqueries.apply(i) for i in range(subqueries.size())]
    return found


@pytest.mark.parametrize("mode", ["raw", "text"])
def test_no_shuffle_carries_contents(spark, records, profile, tmp_path, mode):
    """Pages meet their pairs and predictions by bitmaps of positions: no exchange moves a page or text.

    Broadcasts of data tables are off; only the bounded, checked ones of the job remain. Exchanges
    that spread a small staged table over all cores (round robin) are not joins and are left out.
    """
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = refine(records, Settings(target="fr", mode=mode), profile, stage=str(tmp_path / "stage"))
        moved = {c for columns in _shuffled_columns(docs) for c in columns}
        assert not moved & {"payload", "html", "raw_text", "text", "raw_data"}
        assert notes_of(docs) == ["<n1>", "<n3>", "<nB>", "<nD>", "<nP>"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_position_bitmaps_keep_exactly_the_positions(spark):
    import random

    from pagesieve.operators.positions import keep_positions, position_bitmaps
    r = random.Random(4)
    seqs = [(p << 33) + r.randrange(200_000) for p in range(3) for _ in range(300)]
    rows = spark.createDataFrame([(f"a{s % 3}", s, "x" * 10) for s in set(seqs)], "warc_path string, rec_seq long, payload string")
    chosen = {s for s in set(seqs) if r.random() < 0.3}
    wanted = spark.createDataFrame([(f"a{s % 3}", s) for s in chosen] + [("other", 5)], "warc_path string, rec_seq long")
    bitmaps = position_bitmaps(wanted)
    for max_bytes in (64 << 20, 9000):          # one round, and several
        kept = keep_positions(rows, bitmaps, max_bytes=max_bytes)
        assert kept.columns == ["warc_path", "rec_seq", "payload"]
        assert sorted(r.rec_seq for r in kept.collect()) == sorted(chosen)


def test_manifest_job_commits_by_ledger_and_retries(spark, profile, tmp_path):
    """Stop between documents and ledger, a damaged archive mended later: no loss, no double."""
    from pagesieve.plans import manifest_job as J
    folder = write_all(tmp_path / "archives")
    (folder / "late.warc.gz").write_bytes(b"\x1f\x8b\x08\x00 not gzip at all")
    listed = tmp_path / "manifest.txt"
    listed.write_text("ok.warc.gz\nstale.warc.gz\nlate.warc.gz\nbad.warc.gz\nok.warc.gz\n")
    manifest = read_manifest(spark, str(listed))
    out, settings = str(tmp_path / "out"), Settings(target="fr")

    def stop(step, batch):
        if step == "documents" and batch == 1:
            raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        J.run_manifest(spark, manifest, str(folder), out, settings, profile, archives_per_batch=2, run="1", interrupt=stop)
    states = {r.warc_path: r.status for r in J.archive_states(J.read_attempts(spark, out)).collect()}
    # batch 1 failed as a whole: its archives were tried alone; the damaged one failed, the other one
    # wrote its documents and was stopped before its ledger rows
    assert states == {"ok.warc.gz": "ok", "stale.warc.gz": "ok", "late.warc.gz": "failed"}
    assert len(os.listdir(f"{out}/shards")) == 2                        # its shard is there, uncommitted
    assert notes_of(J.committed_documents(spark, out)) == ["<n1>", "<n3>", "<nB>", "<nP>"]

    assert J.run_manifest(spark, manifest, str(folder), out, settings, profile, archives_per_batch=2, run="2") == 1
    states = {r.warc_path: (r.status, r.error) for r in J.archive_states(J.read_attempts(spark, out)).collect()}
    assert states["late.warc.gz"][0] == "failed" and states["late.warc.gz"][1] and states["bad.warc.gz"][0] == "ok"
    assert notes_of(J.committed_documents(spark, out)) == ["<n1>", "<n3>", "<nB>", "<nD>", "<nP>"]

    write_gz(folder / "late.warc.gz", record("response", "L", french("L"), uri="http://a.example/L"),
             record("metadata", "nL", languages(("fr", 0.9)), refers="L"))
    assert J.run_manifest(spark, manifest, str(folder), out, settings, profile, archives_per_batch=2, run="3") == 1
    assert notes_of(J.committed_documents(spark, out)) == ["<n1>", "<n3>", "<nB>", "<nD>", "<nL>", "<nP>"]
    assert J.run_manifest(spark, manifest, str(folder), out, settings, profile, run="4") == 0


@pytest.mark.parametrize("step", ["records", "documents", "ledger"])
def test_ingest_replays_a_stopped_batch(spark, profile, tmp_path, step):
    """Stopped after any write of batch 1: the next start replays it into the same folders."""
    folder, out = write_all(tmp_path / "in"), str(tmp_path / "out")
    settings = Settings(target="fr")

    def stop(at, batch_id):
        if at == step and batch_id == 1:
            raise RuntimeError("stopped")

    with pytest.raises(Exception):
        ingest(spark, str(folder), out, settings, profile, archives_per_batch=1, base=str(folder), interrupt=stop)
    ingest(spark, str(folder), out, settings, profile, archives_per_batch=1, base=str(folder))
    assert notes_of(spark.read.parquet(f"{out}/documents")) == ["<n1>", "<n3>", "<nB>", "<nD>", "<nP>"]
    ledger = L.read_ledger(spark, f"{out}/ledger")
    assert ledger.count() == 3 and ledger.select("batch_id").distinct().count() == 3


def test_damaged_page_is_held_not_skipped(spark, profile, tmp_path):
    """An annotation behind a page whose body cannot be read pairs with that page, not an earlier one."""
    folder = tmp_path / "damaged"
    os.makedirs(folder)
    write_gz(folder / "d.warc.gz",
             record("response", "q1", french("q1"), uri="http://a.example/q1"),
             record("response", "q2", b"not gzip at all", uri="http://a.example/q2", http=("Content-Encoding: gzip",)),
             record("metadata", "m2", languages(("fr", 0.9)), refers="q2"),
             record("response", "q3", french("q3"), uri="http://a.example/q3"),
             record("metadata", "m3", languages(("fr", 0.9)), refers="q3"))
    landed = land_archives(archive_pieces(spark, str(folder)), str(tmp_path / "landed"), base=str(folder))
    assert notes_of(refine(landed, Settings(target="fr"), profile)) == ["<m3>"]
    reasons = {r["record_id"]: r["reason"] for r in quarantined(landed).collect()}
    assert reasons == {"<q2>": "coded body"}


def test_manifest_job_takes_small_batches_together(spark, tmp_path, monkeypatch):
    """Seven batches of one archive are three jobs; one damaged archive costs halving, not a job a batch."""
    from pagesieve.plans import manifest_job as J
    calls = []

    def documents(spark, paths, *args):
        calls.append(len(paths))
        if "p12" in paths:
            raise ValueError("damaged")
        return set()

    monkeypatch.setattr(J, "_documents", documents)
    for n, sizes in ((7, [1, 2, 4]), (15, [1, 2, 4, 8, 4, 4, 2, 2, 1, 1])):
        calls.clear()
        rows = [(i, f"p{i:02d}") for i in range(n)]
        manifest = spark.createDataFrame(rows, "line_no long, warc_path string")
        out = str(tmp_path / f"out{n}")
        assert J.run_manifest(spark, manifest, "/none", out, Settings(), archives_per_batch=1, run="1") == n
        assert calls[:4] == sizes[:4] and len(calls) <= len(sizes)
        rows = J.read_attempts(spark, out).collect()
        assert sorted(r.warc_path for r in rows) == [f"p{i:02d}" for i in range(n)]
        assert [r.warc_path for r in rows if r.status != "ok"] == (["p12"] if n > 12 else [])
        assert all(r.batch == int(r.warc_path[1:]) for r in rows)


def test_ingest_takes_small_batches_together(spark, tmp_path, monkeypatch):
    """Three batches of one archive are one job, each with its own folder; a replay replaces the folders."""
    from pagesieve.streaming import ingest as I
    folder, out, calls = write_all(tmp_path / "in"), str(tmp_path / "out"), []

    def refined(landed, *args, **kwargs):
        calls.append(1)
        return landed.where("warc_path <> 'bad.warc.gz'").select("warc_path", "record_id")

    monkeypatch.setattr(I, "refine", refined)

    def stop(step, batch):
        if step == "ledger" and batch == 2:
            raise RuntimeError("stopped")

    with pytest.raises(Exception):
        ingest(spark, str(folder), out, Settings(), None, archives_per_batch=1, base=str(folder), interrupt=stop)
    ingest(spark, str(folder), out, Settings(), None, archives_per_batch=1, base=str(folder))
    assert len(calls) == 2
    docs = spark.read.parquet(f"{out}/documents")
    kept = {r.warc_path: r.batch_id for r in docs.select("warc_path", "batch_id").distinct().collect()}
    ledger = {r.warc_path: r.batch_id for r in L.read_ledger(spark, f"{out}/ledger").collect()}
    assert ledger == {"bad.warc.gz": 0, "ok.warc.gz": 1, "stale.warc.gz": 2}
    assert kept == {k: v for k, v in ledger.items() if k != "bad.warc.gz"}
    assert docs.count() == docs.distinct().count()
