"""Hourly files: every odd line the loader must expect."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from eventmart.operators import loads
from eventmart.operators.ranking import head_sample_profile
from eventmart.plans.ingest import ingest_files, read_audit
from eventmart.plans.pipeline import date_state
from eventmart.plans.staging import staging_events
from eventmart.sources.event_files import event_lines, flatten_events, parse_lines, reject_bad_lines, scan_event_files
from eventmart.sources.nested import nested_events
from eventmart.sources.raw_events import scan_raw

FIRST, LATER = "2026-04-16-10.json.gz", "2026-04-16-11.json.gz"


def event(id, **changes):
    full = {
        "id": id,
        "type": "PushEvent",
        "actor": {"login": "testuser", "id": 1},
        "repo": {"name": "test/repo", "id": 1},
        "payload": {"commits": []},
        "public": True,
        "created_at": "2026-04-16T10:00:00Z",
    } | changes
    return json.dumps({k: v for k, v in full.items() if v != "absent"})


LINES = [
    event("1"),
    event("2", type="IssuesEvent", payload={"action": "opened"}, org={"id": 7, "login": "acme"}),
    "this is not json",
    "",
    event("3", public="absent"),
    event("4", payload="absent"),
    event("5", actor=None),
    event("absent"),
    event("6", repo={"id": 0, "name": "zero"}),
    event("7", created_at="2026-04-16T23:59:59Z"),
    event("8", type="WatchEvent"),
    event("8", type="ForkEvent"),
    "[1, 2]",
    '"text"',
    event("9", created_at="no date"),
    event("10") + " trailing",
    event("11") + event("12"),
    event("13") + "," + event("14"),
    event("15") + "]",
    event("16") + "}",
    event("17", public="maybe"),
]


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    with gzip.open(folder / FIRST, "wt", encoding="utf-8") as f:
        f.write("\n".join(LINES) + "\n")
    return folder


def test_scan_sees_every_line(spark, landing):
    lines = scan_event_files(spark, str(landing))
    assert lines.count() == len(LINES)
    assert [r[0] for r in lines.select("source_file").distinct().collect()] == [FIRST]


def test_rejects(spark, landing, rows):
    _, bad = reject_bad_lines(scan_event_files(spark, str(landing)))
    reasons = {r["value"]: r["reject_reason"] for r in rows(bad)}
    assert reasons == {
        "this is not json": "malformed",
        "": "malformed",
        "[1, 2]": "malformed",
        '"text"': "malformed",
        event("9", created_at="no date"): "malformed",
        **dict.fromkeys(LINES[15:], "malformed"),
        event("absent"): "incomplete",
    }


def test_flatten_defaults(spark, landing):
    good, _ = reject_bad_lines(scan_event_files(spark, str(landing)))
    flat = {r["event_id"]: r for r in flatten_events(good).collect()}
    assert flat["1"]["actor_id"] == "1" and flat["1"]["repo_id"] == "1"
    assert (flat["2"]["org_id"], flat["2"]["org_login"]) == ("7", "acme")
    assert json.loads(flat["2"]["payload"]) == {"action": "opened"}
    assert flat["1"]["org_id"] is None
    assert flat["3"]["is_public"] is True
    assert flat["4"]["payload"] == "{}"
    assert flat["5"]["actor_id"] is None and flat["5"]["actor_login"] is None
    assert flat["6"]["repo_id"] is None and flat["6"]["repo_name"] == "zero"
    assert str(flat["7"]["event_date"]) == "2026-04-16" and flat["7"]["created_at"].second == 59


def test_each_line_is_parsed_once(spark, landing):
    good, _ = reject_bad_lines(scan_event_files(spark, str(landing)))
    plan = flatten_events(good)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_load_is_idempotent_and_audited(spark, landing, tmp_path, rows):
    raw, quarantine = str(tmp_path / "raw"), str(tmp_path / "bad")
    first = ingest_files(spark, str(landing), raw, "2026-04-16 12:00:00", quarantine_path=quarantine)
    assert (first.rows_inserted, first.rows_failed) == (8, 12)
    assert first.bytes_processed == sum(len(line.encode()) + 1 for line in LINES)
    assert spark.read.parquet(quarantine).count() == 12
    loaded = rows(scan_raw(spark, raw))
    again = ingest_files(spark, str(landing), raw, "2026-04-16 12:00:00")
    assert again.rows_inserted == 8
    assert rows(scan_raw(spark, raw)) == loaded


def test_later_file_updates_the_same_event(spark, landing, tmp_path):
    raw = str(tmp_path / "raw")
    ingest_files(spark, str(landing), raw, "2026-04-16 12:00:00")
    with gzip.open(landing / LATER, "wt", encoding="utf-8") as f:
        f.write(event("1", type="ReleaseEvent", payload={"v": 2}) + "\n")
        f.write(event("new", created_at="2026-04-17T00:10:00Z") + "\n")
    metrics = ingest_files(spark, str(landing / LATER), raw, "2026-04-16 13:00:00")
    assert metrics.rows_inserted == 2
    table = {r["event_id"]: r for r in scan_raw(spark, raw).collect()}
    assert len(table) == 9
    changed = table["1"]
    assert (changed["event_type"], changed["payload"], changed["source_file"]) == ("ReleaseEvent", '{"v":2}', LATER)
    assert (changed["ingested_at"].hour, changed["updated_at"].hour) == (12, 13)
    assert table["2"]["updated_at"].hour == 12


def test_head_profile_counts_untyped_lines(spark, rows):
    lines = spark.createDataFrame(
        [(1, event("1"), FIRST), (2, event("2", type="absent"), FIRST), (3, "junk", FIRST), (4, event("3"), FIRST)],
        "n int, value string, source_file string",
    )
    found = {r["event_type"]: r["events"] for r in rows(head_sample_profile(lines, 3, ["n"]))}
    assert found == {"PushEvent": 1, "Unknown": 1}


def test_null_line_is_rejected(spark):
    lines = spark.createDataFrame([(None, FIRST)], "value string, source_file string")
    assert parse_lines(lines).filter(F.col("reject_reason") == "malformed").count() == 1


def test_any_file_name_is_kept(spark, tmp_path):
    (tmp_path / "export.json.gz").write_bytes(b"")
    (tmp_path / "export.txt").write_text('{"id": 1}')
    assert [r["source_file"] for r in scan_event_files(spark, str(tmp_path)).collect()] == ["export.txt"]


def test_a_payload_with_a_repeated_key_keeps_its_text(make_raw):
    text = '{"a":1,"a":2}'
    nested = nested_events(make_raw({"payload": text}, {"payload": '{"b":1}'}))
    payloads = {r[0] for r in nested.select(F.to_json("payload")).collect()}
    assert payloads == {json.dumps(text, separators=(",", ":")), '{"b":1}'}
    assert nested.filter("raw_data is null").count() == 0


@pytest.fixture
def zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    yield lambda name: spark.conf.set("spark.sql.session.timeZone", name)
    spark.conf.set("spark.sql.session.timeZone", before)


def test_loads_agree_under_any_session_zone(spark, landing, tmp_path, rows, zone):
    with gzip.open(landing / LATER, "wt", encoding="utf-8") as f:
        f.write(event("20", created_at="2026-03-08T07:30:00.25Z") + "\n" + event("21", created_at="2026-03-08T02:30:00") + "\n")
    raw, found = str(tmp_path / "raw"), []
    for name in ("America/New_York", "UTC", "Asia/Kolkata"):
        zone(name)
        ingest_files(spark, str(landing), raw, "2026-04-16 12:00:00")  # again: finds its own keys
        own = scan_raw(spark, raw)
        staged = rows(staging_events(own).drop("payload"))
        hours = rows(loads.hours_to_process(loads.hour_range(spark, "2026-03-08-1", "2026-03-08-9")))
        due = rows(loads.load_range(own, "2026-04-16 18:20:00"))
        found.append((rows(own), staged, hours, due, rows(event_lines(own)), date_state(own).orderBy("event_date").collect()))
    assert found[0] == found[1] == found[2]
    assert len(found[0][0]) == 10 and [str(r["event_date"]) for r in found[0][0]].count("2026-03-08") == 2
    assert [r["date_hour"] for r in found[0][2]] == [f"2026-03-08-{h}" for h in range(1, 10)]


def test_nothing_after_an_event_gets_in(spark):
    good = '{"id":"1","type":"PushEvent","created_at":"2024-01-10T12:00:00Z"}'
    other = good.replace('"1"', '"2"')
    rests = [",\"x\":1", ',"__end":true', f',"__event":{other}', f',"__line":[{other}', other, f",{other}", "] junk", " junk", "]}", '],"x":[1', ',{"__end":"1"}', ',{"__end":""}']
    lines = [good, f"  {good} ", good[:-1] + ',"__end":"x"}', good[:-1] + ',"__line":[1]}', *[good + r for r in rests]]
    parsed = parse_lines(spark.createDataFrame([(line, "f") for line in lines], "value string, source_file string")).collect()
    assert [r["reject_reason"] for r in parsed] == [None] * 4 + ["malformed"] * len(rests)
    assert {r["event"]["id"] for r in parsed[:4]} == {"1"}


def test_a_broken_file_does_not_end_the_load(spark, tmp_path):
    landing, raw, audit = tmp_path / "landing", str(tmp_path / "raw"), str(tmp_path / "audit")
    landing.mkdir()
    line = '{"id":"%d","type":"PushEvent","created_at":"2026-04-16T%02d:00:00Z"}'
    for hour in range(5):
        text = "\n".join([line % (10 * hour + i, hour) for i in range(hour + 1)] + ["junk"] * (hour == 2))
        whole = gzip.compress(text.encode())
        (landing / f"2026-04-16-{hour}.json.gz").write_bytes(whole[: len(whole) // 2] if hour == 3 else b"no gzip" if hour == 1 else whole)
    with pytest.raises(Exception, match="2026-04-16-[13].json.gz"):
        ingest_files(spark, str(landing), raw, "2026-04-16 12:00:00")
    for _ in range(2):  # again: the same outcome, appended
        done = ingest_files(spark, str(landing), raw, "2026-04-16 12:00:00", audit_path=audit)
        assert (done.rows_inserted, done.rows_failed, done.success) == (9, 1, False)
    rows = read_audit(spark, audit).collect()
    assert len(rows) == 10
    found = {r["source_file"][11:12]: (r["rows_inserted"], r["rows_failed"], r["success"]) for r in rows}
    assert found == {"0": (1, 0, True), "1": (0, 0, False), "2": (3, 1, True), "3": (0, 0, False), "4": (5, 0, True)}
    assert all((r["error"] is None) == r["success"] and r["duration_seconds"] > 0 for r in rows)
    summary = loads.load_summary(read_audit(spark, audit).dropDuplicates(["source_file"])).first()
    assert (summary["hours_processed"], summary["hours_failed"], summary["total_rows_inserted"]) == (3, 2, 9)
    only_broken = ingest_files(spark, str(landing / "2026-04-16-1.json.gz"), raw, audit_path=str(tmp_path / "second"))
    assert (only_broken.rows_inserted, only_broken.success) == (0, False)
