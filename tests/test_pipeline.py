"""End-to-end staged pipeline (T1-T4) on file topics, with restart and replay."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gleaner.functions import clean as C
from gleaner.operators import lake as L
from gleaner.plans.html_fixture import POSTING_HTML
from gleaner.sources import topics as S
from gleaner.streaming import pipeline as PL

SF = "/root/testdata/sf0.001"
PER_PAGE = 5


def list_pages(spark, pages: int):
    """List pages 1..pages, PER_PAGE cards each; page 2 repeats a card of
    page 1 and every page has one card without a job id."""
    rows = []
    for p in range(1, pages + 1):
        ids = [(p - 1) * PER_PAGE + i + 1 for i in range(PER_PAGE)]
        if p == 2:
            ids[0] = 1
        cards = "".join(f'<a role="button" href="/job-search/{j}?page={p}" aria-label="View Role {j}">x</a>'
                        for j in ids)
        cards += '<a role="button" href="/job-search/none" aria-label="View Broken">x</a><a href="/nav">n</a>'
        html = f"<html><body><nav><a href='/home'>h</a></nav><main>{cards}</main></body></html>"
        rows.append((S.LIST_URL_TEMPLATE % (p, PER_PAGE), html, True))
    return spark.createDataFrame(rows, "url string, html string, success boolean")


def detail_pages(spark):
    part = spark.read.parquet(f"{SF}/part.parquet")
    return part.selectExpr(f"{POSTING_HTML} AS html", "p_partkey").select(
        C.canonical_url("p_partkey").alias("url"), "html", (F.col("p_partkey") % 7 != 0).alias("success"))


@pytest.fixture()
def cfg(spark, tmp_path):
    pages = list_pages(spark, 3).unionByName(detail_pages(spark))
    return PL.PipelineConfig(topics_root=str(tmp_path / "topics"), lake_root=str(tmp_path / "lake"),
                             checkpoint_root=str(tmp_path / "ckpt"), pages=pages,
                             dead_letters=str(tmp_path / "dead"))


def test_pipeline_end_to_end_restart_and_replay(spark, cfg):
    PL.start_command(spark, cfg.topics_root, 1, 3, PER_PAGE)
    PL.run_pipeline(spark, cfg)
    lake = L.Lake(spark, cfg.lake_root)
    view = lake.scan()
    expected_ids = set(range(1, 3 * PER_PAGE + 1)) - {PER_PAGE + 1}   # page 2's first card repeats id 1
    posted = {r.job_id for r in view.filter(F.col("job_id").isNotNull()).select("job_id").collect()}
    assert posted == expected_ids
    detail_cmds = S.read_topics(spark, cfg.topics_root, [S.TOPICS["detail_commands"]], streaming=False)
    assert detail_cmds.count() == len(expected_ids)              # new keys only
    ok_ids = {j for j in expected_ids if j % 7 != 0}
    status = {r.key: r.e2_success for r in view.filter(F.col("e2_success").isNotNull()).collect()}
    assert len(status) == len(expected_ids)
    assert {int(k.rsplit("/", 1)[1]) for k, v in status.items() if v} == ok_ids
    load = S.read_topics(spark, cfg.topics_root, [S.TOPICS["load"]], streaming=False)
    enriched = view.filter(F.col("position").isNotNull())
    n_loaded = load.count()
    assert n_loaded == enriched.count() > 0
    dead = spark.read.parquet(cfg.dead_letters)
    assert dead.filter(F.col("stage") == "cards").count() == 3   # one broken card per page
    assert n_loaded + dead.filter(F.col("stage") == "clean").count() == len(ok_ids)

    # restart from the checkpoints with no new input: nothing is re-emitted
    PL.run_pipeline(spark, cfg)
    assert S.read_topics(spark, cfg.topics_root, [S.TOPICS["detail_commands"]], streaming=False).count() \
        == len(expected_ids)
    assert S.read_topics(spark, cfg.topics_root, [S.TOPICS["load"]], streaming=False).count() == n_loaded

    # the same command again: every card is known, so no new detail command
    PL.start_command(spark, cfg.topics_root, 1, 3, PER_PAGE)
    PL.run_pipeline(spark, cfg)
    assert S.read_topics(spark, cfg.topics_root, [S.TOPICS["detail_commands"]], streaming=False).count() \
        == len(expected_ids)

    # a NEW checkpoint over the same lake and topics: stages continue after the
    # existing batch ids, so nothing written before is replaced or re-emitted
    log_before = L.Lake(spark, cfg.lake_root).log().count()
    cfg2 = PL.PipelineConfig(topics_root=cfg.topics_root, lake_root=cfg.lake_root,
                             checkpoint_root=cfg.checkpoint_root + "_new", pages=cfg.pages,
                             dead_letters=cfg.dead_letters)
    PL.run_pipeline(spark, cfg2)
    assert L.Lake(spark, cfg.lake_root).log().count() >= log_before
    assert S.read_topics(spark, cfg.topics_root, [S.TOPICS["detail_commands"]], streaming=False).count() \
        == len(expected_ids)
    assert {r.job_id for r in L.Lake(spark, cfg.lake_root).scan().filter(F.col("job_id").isNotNull())
            .select("job_id").collect()} == expected_ids


def test_new_only_writer_replay_is_idempotent(spark, tmp_path):
    lake = L.Lake(spark, str(tmp_path / "lake"))
    emitted = {}
    writer = PL.NewOnlyWriter(lake, lambda df, b: emitted.__setitem__(b, sorted(r.key for r in df.collect())))
    b0 = spark.createDataFrame([(1, "r1", "u1"), (2, "r2", "u2"), (1, "r1b", "u1")], "job_id long, role string, url string")
    b1 = spark.createDataFrame([(2, "r2", "u2"), (3, "r3", "u3")], "job_id long, role string, url string")
    writer(b0, 0)
    writer(b1, 1)
    first = dict(emitted)
    writer(b1, 1)                   # batch 1 delivered again
    assert first == {0: ["u1", "u2"], 1: ["u3"]}
    assert emitted == first
    assert lake.log().filter(F.col("_batch") == 1).count() == 2   # replay replaced, not appended


def test_merged_runs_keep_new_only_exact(spark, tmp_path):
    """Runs merged every 2 batches: the emitted keys are unchanged, also for a batch that a merge has taken up."""
    emitted = {}
    lake = L.Lake(spark, str(tmp_path / "lake"), buckets=4, fan_in=2)
    writer = PL.NewOnlyWriter(lake, lambda df, b: emitted.__setitem__(b, sorted(r.key for r in df.collect())))
    batches = [[1, 2], [2, 3], [1, 4], [5, 3], [4, 6], [7]]
    for b, ids in enumerate(batches):
        writer(spark.createDataFrame([(i, "r", f"u{i}") for i in ids], "job_id long, role string, url string"), b)
    assert emitted == {0: ["u1", "u2"], 1: ["u3"], 2: ["u4"], 3: ["u5"], 4: ["u6"], 5: ["u7"]}
    assert [(r.level, r.lo, r.hi) for r in lake.runs("postings")] == [(2, 0, 3), (1, 4, 5)]
    writer(spark.createDataFrame([(5, "r", "u5"), (3, "r", "u3")], "job_id long, role string, url string"), 3)
    assert emitted[3] == ["u5"]
    assert PL.next_batch(spark, [lake.writer_path("postings")]) == 6


def test_newer_message_wins_wherever_its_file_lies(spark, tmp_path):
    """One micro-batch of a small older file and a large newer one: the scan takes the large one first."""
    topic = str(tmp_path / "topic")
    schema = "url string, role string, job_id bigint, offset bigint, partition int, filler string"
    old = [("K", "old", 1, 5, 0, "")]
    new = [("K", "new", 2, 2000, 0, "x")] + [(f"u{i}", "r", i, 1000 + i, 0, "y" * 400) for i in range(900)]
    for rows in (old, new):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(topic)
    lake = L.Lake(spark, str(tmp_path / "lake"))
    writer = PL.NewOnlyWriter(lake, lambda df, b: None)
    PL.drain(spark.readStream.schema(schema).parquet(topic), writer, str(tmp_path / "ck"))
    row = lake.scan().where("key = 'K'").first()
    assert (row.role, row.job_id) == ("new", 1)                    # last write wins, the first insert stays


def test_offsets_of_emitted_topics(spark, tmp_path):
    root, topic = str(tmp_path), "t"

    def batch(b, rows):
        df = spark.createDataFrame(rows, "key string, value string, n int").repartition(5)
        PL.emit(df, topic, root, b, "n")

    batch(0, [("a", "0", 0), ("b", "0", 1), ("a", "1", 2)])
    batch(1, [("a", "2", 0), ("c", "2", 1)])
    first = {r.offset for r in S.read_topics(spark, root, [topic], streaming=False).collect()}
    batch(1, [("a", "2", 0), ("c", "2", 1)])                       # delivered again: the same offsets
    batch(2, [("b", "3", 0)])
    rows = S.read_topics(spark, root, [topic], streaming=False)
    got = rows.orderBy("offset").collect()
    assert len({r.offset for r in got}) == 6 and first < {r.offset for r in got}
    assert [(bytes(r.key).decode(), bytes(r.value).decode()) for r in got] == [
        ("a", "0"), ("b", "0"), ("a", "1"), ("a", "2"), ("c", "2"), ("b", "3")]
    newest = {bytes(r.key).decode(): bytes(r.value).decode() for r in S.compact_by_key(rows).collect()}
    assert newest == {"a": "2", "b": "3", "c": "2"}                # S11
    cut = S.replay(rows, topic, from_offset=got[2].offset, to_offset=got[4].offset)
    assert sorted(bytes(r.value).decode() for r in cut.collect()) == ["1", "2", "2"]      # S3
    assert S.publish(spark.createDataFrame([("d", "4")], "key string, value string"), topic, root) == 1
    assert S.read_topics(spark, root, [topic], streaming=False).orderBy(F.desc("offset")).first().key == b"d"


def test_fifty_batches_stay_a_few_runs(spark, tmp_path):
    """Files and bytes that a reader takes do not grow with the batches; the view equals the full log's."""
    lake, full, sizes = L.Lake(spark, str(tmp_path / "lake"), buckets=2, fan_in=4), [], []
    for b in range(50):
        rows = spark.createDataFrame([(f"u{(7 * b + i) % 40}", b, f"r{b}.{i}", i) for i in range(12)],
                                     "url string, _seq long, role string, job_id long").withColumn("created_at", F.lit(f"t{b}"))
        changes = L.upsert_postings(rows, b)
        full.append(changes)
        lake.append(changes, "postings", b)
        if b in (9, 49):
            runs = lake.runs("postings")
            sizes.append((len(runs), sum(len(list(Path(r.path).rglob("*.parquet"))) for r in runs)))
            # a run holds two rows a key at most: its first and its last
            assert all(spark.read.parquet(r.path).groupBy("key").count().where("count > 2").isEmpty() for r in runs if r.level)
    assert [n for n, _ in sizes] == [2 + 2, 3 + 0 + 2] and sizes[1][1] <= 1.5 * sizes[0][1]      # 10 and 50 batches, in base 4
    key = lambda r: tuple(map(str, (r.key, r.role, r.job_id, r.created_at, r._first_batch, r._last_seq)))
    assert sorted(map(key, lake.scan().collect())) == sorted(map(key, L.merged_view(L.union_changes(*full)).collect()))
    assert len(list((tmp_path / "lake/log/_writer=postings").glob("run=*"))) <= 3 * 3 + 2 * 4     # what merges replaced is gone


def test_a_merge_writes_only_touched_buckets(spark, tmp_path):
    lake = L.Lake(spark, str(tmp_path / "lake"), buckets=64, fan_in=2)
    for b in range(2):
        rows = spark.createDataFrame([("one key", b, "r", 1)], "url string, _seq long, role string, job_id long").withColumn("created_at", F.lit("t"))
        lake.append(L.upsert_postings(rows, b), "postings", b)
    (run,) = lake.runs("postings")
    assert run.level == 1 and len(list((tmp_path / "lake/log/_writer=postings" / f"run=1..0..1").glob("bucket=*"))) == 1


def test_new_fields_of_later_batches_are_read(spark, tmp_path):
    lake = L.Lake(spark, str(tmp_path / "lake"), fan_in=2)
    for b, field in enumerate(["position", "company", "about"]):
        lake.append(L.upsert_enriched(spark.createDataFrame([("u", b, field)], f"url string, _seq long, {field} string"), b, ["url", field]), "e", b)
    row = L.Lake(spark, str(tmp_path / "lake")).scan().first()
    assert (row.position, row.company, row.about) == ("position", "company", "about")


def test_drain_and_micro_batch_on_file_topic(spark, tmp_path):
    root = str(tmp_path / "t")
    ev = spark.read.parquet(f"{SF}/events.parquet")
    n = S.publish(S.to_envelope(ev, F.lit("ev"), F.col("user_id").cast("string"), F.col("props"),
                                offset=F.col("event_id"), timestamp=F.col("ts")), None, root)
    assert n == ev.count()
    seen = []
    stream = S.read_topics(spark, root, ["ev"], options={"maxFilesPerTrigger": "1"})
    PL.drain(stream, lambda df, b: seen.append(df.count()), str(tmp_path / "ck"))
    assert sum(seen) == ev.count()
    PL.drain(stream, lambda df, b: seen.append(df.count()), str(tmp_path / "ck"))   # nothing new
    assert sum(seen) == ev.count()
    assert PL.kafka_batching() == {"minOffsetsPerTrigger": "100", "maxTriggerDelay": "30 seconds"}


def test_resolve_base_is_fixed_per_checkpoint(spark, tmp_path):
    out = tmp_path / "topic"
    for b in (0, 1):
        (out / f"batch={b}").mkdir(parents=True)
    (out / "run=1..2..4").mkdir()
    ck = str(tmp_path / "ck")
    assert PL.next_batch(spark, [str(out), str(tmp_path / "missing")]) == 5
    assert PL.resolve_base(spark, ck, [str(out)]) == 5     # new checkpoint: after existing output
    (out / "batch=9").mkdir()
    assert PL.resolve_base(spark, ck, [str(out)]) == 5     # recorded: stable across restarts
