"""Event stream tiers driven by scripted files."""

import json
import time

import pytest
from pyspark.sql import functions as F

from terrace.operators.contracts import Contract
from terrace.plans import stream_queries
from terrace.plans.layers import Lakehouse
from terrace.plans.retail_stream import deliver, land_events
from terrace.session import ROCKSDB, state_on_disk
from terrace.sources.schemas import schema
from terrace.sources.tables import count_rows
from terrace.streaming import events as ev
from terrace.streaming import runs

FORM = ev.EventFormat(
    payload=schema(ref="string", topic="string", sensor="long", site="string", taken="string", level="double"),
    key="ref", time="taken", required=("sensor",), allowed={"topic": ("reading", "reset")}, codes=("site",))


def measures():
    return [F.count(F.lit(1)).alias("n"), F.count_if(F.col("topic") == "reading").alias("readings"),
            F.max("level").alias("peak"), F.approx_count_distinct("sensor").alias("sensors")]


def line(ref, clock, **changes):
    base = dict(ref=ref, topic="reading", sensor=4, site="north", taken=f"2025-05-05T{clock}Z", level=2.5, extra=[1])
    return json.dumps(base | changes)


FILES = [
    [line("p", "08:00:10"), line("p", "08:00:10"), line("q", "08:03:00", level=9.0),
     line("r", "08:04:59", topic="reset", site=" North ", sensor=5), "plain text", line(None, "08:01:00"),
     line(None, "08:01:00")],
    [line("p", "08:00:10"), line("s", "08:40:00"), line("t", "", taken="noon"), line("u", "08:39:00", topic="other"),
     line("v", "08:39:00", topic=None), line("w", "08:39:00", sensor=None)],
    # the watermark is 08:30 by now; "x" moves it past the window of "s"
    [line("x", "09:30:00", site="south")],
    # judged by the watermark of the batch before, 08:30
    [line("y", "08:02:00")],
]
N_LINES = sum(map(len, FILES))


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    folder = tmp_path_factory.mktemp("events")
    for i, lines in enumerate(FILES):
        (folder / f"part-{i}.json").write_text("\n".join(lines) + "\n")
        time.sleep(1.1)  # files are taken in the order of their modification time
    return str(folder)


def bronze_of(spark, landing, max_files=1):
    return ev.stamped(ev.text_stream(spark, landing, max_files), "file", "run-1")


CONTRACT = Contract.of({"rule": "unique", "columns": ["window_start", "site"]},
                       {"rule": "range", "column": "peak", "value": [0, 8], "tolerance_pct": 100})


def tiers_of(bronze):
    decoded = ev.decode(bronze, FORM)
    return [runs.Tier("bronze", "readings", bronze, ("_ingestion_date",)),
            runs.Tier("silver", "readings", ev.once(ev.accepted(decoded), FORM)),
            runs.Tier("refused", "readings", ev.rejected(decoded))]


def windows_of(house, bronze):
    events = runs.read_tier(house, "silver", "readings", ev.accepted(ev.decode(bronze, FORM)).schema)
    return runs.Tier("gold", "windows", ev.window_metrics(events, FORM, ["site"], measures()))


@pytest.fixture(scope="module")
def tiers(spark, landing, tmp_path_factory):
    house = Lakehouse(spark, str(tmp_path_factory.mktemp("lake")), {"gold": {"windows": CONTRACT}})
    bronze = bronze_of(spark, landing)
    with runs.counted(spark) as progress:
        house.together(*[lambda t=t: runs.run_tier(house, t) for t in tiers_of(bronze)])
        runs.run_tier(house, windows_of(house, bronze))
        progress.complete()
    return house, progress


def test_tiers(tiers):
    house, _ = tiers
    assert house.read("bronze", "readings").count() == N_LINES
    silver = house.read("silver", "readings")
    assert sorted(r.ref for r in silver.collect()) == ["p", "q", "r", "s", "x"] and "_processed" in silver.columns
    bad = house.read("refused", "readings").collect()
    # two without a key, plain text, unreadable time, two wrong topics, no sensor
    assert len(bad) == 7 and any(r._payload == "plain text" for r in bad) and not any(r.valid for r in bad)
    assert {(s.layer, s.rows_in, s.rows_out) for s in house.log.steps if s.layer != "gold"} == {
        ("bronze", N_LINES, N_LINES), ("silver", 5, 5), ("refused", 7, 7)}


def test_windows_are_closed_count_every_event_once_and_pass_their_contract(spark, tiers):
    house, _ = tiers
    rows = {(f"{r.window_start:%H:%M}", r.site): r for r in house.read("gold", "windows").collect()}
    assert set(rows) == {("08:40", "NORTH")}  # 09:30 is open, "y" came too late
    # the window of 08:00 has a peak of 9
    bad = spark.read.parquet(f"{house.root}/_quarantine/gold/windows").collect()
    assert [(f"{r.window_start:%H:%M}", f"{r.window_end:%H:%M}", r.site, r._quarantine_reason) for r in bad] == [
        ("08:00", "08:05", "NORTH", "range:peak")]
    assert (bad[0].n, bad[0].readings, bad[0].peak, bad[0].sensors) == (3, 2, 9.0, 2)
    step = next(s for s in house.log.steps if s.layer == "gold")
    assert (step.rows_in, step.rows_out, step.rows_quarantined) == (2, 1, 1)
    assert {(c.rule, c.status) for c in step.checks} == {("unique", "PASS"), ("range", "PASS")}


def test_one_stateful_operator_in_a_query(spark, landing, tmp_path):
    house = Lakehouse(spark, str(tmp_path))
    bronze = bronze_of(spark, landing)
    for tier in [*tiers_of(bronze), windows_of(house, bronze)]:
        plan = tier.stream._jdf.queryExecution().analyzed().toString()
        assert plan.count("Deduplicate") + plan.count("Aggregate") == (1 if tier.layer in ("silver", "gold") else 0)


def test_progress(spark, tiers):
    rows = {r["query"]: r for r in tiers[1].frame(spark).collect()}
    assert rows["bronze.readings"].rows_read == N_LINES and rows["bronze.readings"].batches >= len(FILES)
    assert rows["silver.readings"].late_rows == 1 and rows["gold.windows"].late_rows == 0
    assert rows["gold.windows"].rows_read == 5 and rows["gold.windows"].watermark.startswith("2025-05-05T09:20")


def test_batches_are_counted_beyond_the_kept_reports(spark, tmp_path):
    key = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(key)
    spark.conf.set(key, "3")
    try:
        spark.range(40).repartition(8).write.parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        with runs.counted(spark) as progress:
            q = runs.to_files(stream, f"{tmp_path}/out", f"{tmp_path}/ck", queryName="many")
            runs.supervise({"q": q})
            total = progress.complete()["many"]
        assert len(q.recentProgress) < 8 <= total.batches and total.batches >= 8 and total.rows_read == 40
        assert count_rows(spark, f"{tmp_path}/out") == 40
    finally:
        spark.conf.set(key, before)


def test_a_batch_that_runs_again_repeats_nothing(spark, landing, tmp_path):
    """The sink fails after a batch was written and before it is noted; the restart brings it again."""
    house = Lakehouse(spark, str(tmp_path / "lake"))
    tier = runs.Tier("bronze", "readings", bronze_of(spark, landing))
    with pytest.MonkeyPatch.context() as patch:
        take, calls = Lakehouse.take_in, []

        def breaks(self, *args, **more):
            take(self, *args, **more)
            calls.append(1)
            if len(calls) == 2:
                raise RuntimeError("lost after the write")

        patch.setattr(Lakehouse, "take_in", breaks)
        with pytest.raises(runs.StreamFailure, match="lost after the write"):
            runs.run_tier(house, tier)
    written = house.read("bronze", "readings")
    assert written.select(runs.BATCH).distinct().count() == 2
    step = runs.run_tier(house, tier)
    again = house.read("bronze", "readings")
    assert again.count() == N_LINES and step.rows_out == N_LINES - written.where("_batch = 0").count()
    runs.run_tier(house, tier)
    assert house.read("bronze", "readings").count() == N_LINES
    assert [s.status for s in house.log.steps] == ["ERROR", "OK", "OK"]


def test_windows_go_on_where_they_ended(spark, tmp_path):
    """More files arrive between two runs; the second run closes the window that was open."""
    house = Lakehouse(spark, str(tmp_path / "lake"))
    place = tmp_path / "in"
    place.mkdir()
    for k, lines in enumerate(FILES[:3]):
        (place / f"{k}.json").write_text("\n".join(lines) + "\n")
        bronze = bronze_of(spark, str(place))
        runs.run_tier(house, tiers_of(bronze)[1])
        runs.run_tier(house, windows_of(house, bronze))
    rows = {f"{r.window_start:%H:%M}": r.n for r in house.read("gold", "windows").collect()}
    assert rows == {"08:00": 3, "08:40": 1}


def test_nothing_kept_by_a_tier_is_late_for_the_next(spark, tmp_path):
    """One batch whose files lie hours apart: the reader takes it as a whole, whatever file comes first."""
    house = Lakehouse(spark, str(tmp_path / "lake"))
    place = tmp_path / "in"
    place.mkdir()
    (place / "a.json").write_text("\n".join(line(f"k{h}", f"{h:02d}:00:00") for h in range(24)) + "\n")
    bronze = bronze_of(spark, str(place)).repartition(8)
    runs.run_tier(house, tiers_of(bronze)[1])
    with runs.counted(spark) as progress:
        runs.run_tier(house, windows_of(house, bronze))
        assert progress.complete()["gold.windows"].late_rows == 0
    assert sum(r.n for r in house.read("gold", "windows").collect()) == 23  # the last window is open


def test_restart_adds_nothing(spark, landing, tmp_path):
    for _ in range(2):
        q = runs.to_files(bronze_of(spark, landing, 4), f"{tmp_path}/out", f"{tmp_path}/ck", partitionBy=["_ingestion_date"])
        runs.supervise({"q": q})
    assert count_rows(spark, f"{tmp_path}/out") == N_LINES


def test_state_on_disk(spark, landing, tmp_path):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    with state_on_disk(spark):
        assert spark.conf.get(key) == ROCKSDB != before
        good = ev.accepted(ev.decode(bronze_of(spark, landing), FORM))
        runs.supervise({"q": runs.to_files(ev.once(good, FORM), f"{tmp_path}/out", f"{tmp_path}/ck")})
    assert count_rows(spark, f"{tmp_path}/out") == 5 and spark.conf.get(key) == before


def test_a_time_out_names_what_is_not_finished(spark, landing, tmp_path):
    q = runs.to_files(bronze_of(spark, landing), f"{tmp_path}/out", f"{tmp_path}/ck", "1 hour")
    with pytest.raises(runs.StreamTimeout, match="slow"):
        runs.supervise({"slow": q}, timeout_s=2)
    assert not q.isActive
    q = runs.to_files(bronze_of(spark, landing), f"{tmp_path}/out", f"{tmp_path}/ck", "1 second")
    runs.observe({"demo": q}, 3)
    assert not q.isActive


class Ends:
    """A query that is seen active once and fails right after."""

    def __init__(self):
        self.looks = 0

    @property
    def isActive(self):  # noqa: N802
        self.looks += 1
        return self.looks == 1

    def exception(self):
        return "late" if self.looks > 1 else None

    def awaitTermination(self, _):  # noqa: N802
        return None

    def stop(self):
        return None


def test_failures_are_raised_with_their_cause(spark, landing, tmp_path):
    broken = bronze_of(spark, landing).select(F.raise_error(F.lit("on purpose")).cast("string").alias("x"))
    q = runs.to_files(broken, f"{tmp_path}/out", f"{tmp_path}/ck")
    with pytest.raises(runs.StreamFailure, match="stream 'q'"):
        runs.supervise({"q": q}, 60)
    with pytest.raises(runs.StreamFailure, match="late"):
        runs.supervise({"late": Ends()}, 60)


def test_decode_on_a_batch(spark):
    lines = [line("a", "", taken="2025-05-05T07:00:00-03:00", site=" ce "), line("b", "10:00:00", topic="?"), "", None]
    bronze = ev.stamped(ev.text_envelope(spark.createDataFrame([(s,) for s in lines], "value string")), "file", "r")
    rows = ev.decode(bronze, FORM).collect()
    assert len(rows) == 4 and [r.ref for r in rows if r.valid] == ["a"]
    a = next(r for r in rows if r.ref == "a")
    assert a.site == "CE" and f"{a.taken:%H:%M}" == "10:00" and isinstance(a.latency_s, int)


def test_envelope_and_broker_options(spark):
    options = ev.broker_options("h:9092", "t")
    assert options["maxOffsetsPerTrigger"] == "5000" and options["failOnDataLoss"] == "false"
    row = ev.envelope(spark.createDataFrame([(b"k", b"{}", "t", 3, 9, None)], ev.RECORD)).head()
    assert (row._key, row._payload, row._topic, row._partition, row._offset, row._received_at) == (
        "k", "{}", "t", 3, 9, None)


def test_source_falls_back_to_files(spark, landing):
    stream, source = ev.open_source(spark, landing, servers="h:9092", topic="t")
    assert source == "file" and stream.isStreaming
    with pytest.raises(ValueError):
        ev.open_source(spark, servers="h:9092", topic="t")


def test_a_payload_is_parsed_once(spark):
    """Filters on decoded fields must not read the JSON text again."""
    payloads = [(x,) for lines in FILES for x in lines] + [(None,)]
    bronze = ev.stamped(ev.envelope(spark.createDataFrame(payloads, "value string")), "s", "r")
    decoded = ev.decode(bronze, FORM)
    for out in (ev.accepted(decoded), ev.rejected(decoded)):
        assert out._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
    assert decoded.count() == N_LINES + 1
    assert decoded.where("_payload is null or _payload = 'plain text'").where("not valid and ref is null").count() == 2


def some_events(spark, folder):
    """400 events, one a minute; the first forty come twice in the table."""
    events = spark.range(400).select(
        F.col("id").alias("event_id"),
        F.timestamp_seconds(1735689600 + 60 * F.col("id")).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 9).alias("user_id"), F.lit("view").alias("event_type"), F.lit(1.5).alias("value"),
        F.concat(F.lit('{"k": '), (F.col("id") % 50).cast("string"), F.lit("}")).alias("props"))
    events.union(events.where("event_id < 40")).write.parquet(f"{folder}/events.parquet")
    return str(folder)


def test_a_record_that_comes_twice_is_written_out_once(spark, tmp_path, monkeypatch):
    """Copies are made of the finished text, and late records are held against late ones only."""
    plans, paths = [], []

    def watched(batch, path, write, *more):
        def noted(writer, to):
            plans.append(writer._df._jdf.queryExecution().optimizedPlan().toString())
            write(writer, to)
        paths.append(path)
        return deliver(batch, path, noted, *more)

    monkeypatch.setattr(stream_queries, "deliver", watched)
    stream_queries.record_stream(spark, some_events(spark, tmp_path), copies=2, late=True)
    assert len(plans) == 6 and {p.count("StructsToJson") for p in plans} == {1}
    found = spark.read.parquet(paths[0]).select("offset", F.col("value").cast("string").contains('"late-').alias("late"))
    found = {(r.offset, r.late): r["count"] for r in found.groupBy("offset", "late").count().collect()}
    assert found == {(k, False): 4 if k < 40 else 2 for k in range(400)} | {(k, True): 1 for k in range(3, 200, 20)}


def test_landed_events_are_compressed(spark, tmp_path):
    land_events(spark, some_events(spark, tmp_path), f"{tmp_path}/landing")
    files = [p.name for p in (tmp_path / "landing").iterdir() if p.name.startswith("part-")]
    assert len(files) == 5 * ev.MAX_FILES and all(name.endswith(".txt.gz") for name in files)
    texts = spark.read.text(f"{tmp_path}/landing")
    assert texts.count() == 440 and texts.select(F.get_json_object("value", "$.event_id")).distinct().count() == 400
