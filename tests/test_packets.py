"""Survey and support packets: valid, rejected and replayed."""

import io
import json
import zipfile

import pytest

from ledgerline.operators import merge
from ledgerline.sources import packets

PLUGIN = "survey.plugin"
SERVER = "p7j6wmx6269jan410vjrylfb2u"
QUESTIONS = [{"id": "q1", "text": "Likely?", "type": "linear_scale"}, {"id": "q2", "text": "Why?", "type": "text"}]
CSV = 'User ID,Submitted At,Likely?,Why?\nu1,23 July 2024,10,"fine, thanks"\nu2,24 July 2024,7,\n'


def metadata(**change):
    fields = {"version": 1, "type": "plugin-packet", "generated_at": 1721728796871, "server_version": "9.1.0", "server_id": SERVER} | change
    lines = [f"{k}: {v}" for k, v in fields.items() if v is not None and k != "plugin"]
    return "\n".join(lines) + f"\nextras:\n  plugin_id: {fields.get('plugin', PLUGIN)}\n  plugin_version: 1.0.1\n  more: data\n"


def survey(**change):
    return json.dumps({
        "id": "xsafa7f17tg67xgbtpxux5ua7o", "detractor_count": 0, "passive_count": 0, "promoter_count": 1, "receipt_count": 1, "response_count": 1,
        "start_time": "1 July 2024", "duration": "30", "questions": QUESTIONS,
    } | change)


def packet(**files):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for name, content in files.items():
            z.writestr(name, content)
    return buffer.getvalue()


def survey_packet(meta=None, info=None, answers=CSV):
    return packet(**{"metadata.yaml": meta or metadata(), "survey_metadata.json": info or survey(), "responses.csv": answers})


def frame(spark, data):
    return spark.createDataFrame([(k, bytearray(v)) for k, v in data.items()], "path string, content binary")


def test_valid_packet(spark):
    rows, rejects = packets.ingest_survey_packets(frame(spark, {"a": survey_packet()}), PLUGIN, "2024-08-01")
    got = {(r["user_id"], r["question"]): r for r in rows.collect()}
    assert len(got) == 4 and rejects.count() == 0
    assert got[("u1", "Why?")]["answer"] == "fine, thanks" and got[("u2", "Why?")]["answer"] == "nan"
    assert got[("u1", "Likely?")]["question_type"] == "linear_scale"
    assert str(got[("u1", "Likely?")]["submitted_at"]) == "2024-07-23"
    assert got[("u1", "Likely?")]["metadata_server_id"] == SERVER and got[("u1", "Likely?")]["metadata_generated_at"].year == 2024


def test_rejected_packets(spark):
    bad = {
        "zip": b"not a zip", "type": survey_packet(metadata(type="other")), "stamp": survey_packet(metadata(generated_at="never")), "server": survey_packet(metadata(server_id="short")),
        "plugin": survey_packet(metadata(plugin="else.where")), "early": survey_packet(info=survey(start_time="1 August 2024")), "none": survey_packet(info=survey(questions=[])),
        "extra": survey_packet(info=survey(questions=QUESTIONS[:1])), "missing": survey_packet(info=survey(questions=[*QUESTIONS, {"id": "q3", "text": "More?", "type": "text"}])),
        "kind": survey_packet(info=survey(questions=[QUESTIONS[0], {"id": "q2", "text": "Why?", "type": "video"}])), "nometa": packet(**{"responses.csv": CSV}),
    }
    rows, rejects = packets.ingest_survey_packets(frame(spark, {**bad, "good": survey_packet()}), PLUGIN, "2024-08-01")
    reasons = {r["source"]: r["reason"] for r in rejects.collect()}
    assert set(reasons) == set(bad)
    assert reasons["early"] == "answer before survey start" and reasons["extra"] == "unknown question" and reasons["missing"] == "question without answers"
    assert {r["source"] for r in rows.select("source").distinct().collect()} == {"good"}


def test_same_packet_twice_keeps_one_copy(spark):
    rows, _ = packets.ingest_survey_packets(frame(spark, {"a": survey_packet()}), PLUGIN, "2024-08-01")
    again = merge.delete_insert(rows, rows, ["metadata_server_id", "source"])
    assert again.count() == rows.count() == 4


SUPPORT = {
    "license_to": "Firm", "server_os": "linux", "server_architecture": "amd64", "server_version": "8.1.9", "build_hash": "abc", "database_type": "postgres", "database_version": '"13.10"',
    "database_schema_version": '"113"', "active_users": 1, "license_supported_users": 200000, "total_channels": 2, "total_posts": 6, "total_teams": 1, "daily_active_users": 1,
    "monthly_active_users": 1, "websocket_connections": 0, "master_db_connections": 14, "read_db_connections": 0, "inactive_user_count": 0,
}
JOB = "- id: j1\n  type: migrations\n  priority: 0\n  createat: 1723734966121\n  startat: 1723734980530\n  lastactivityat: 1723734981002\n  status: success\n  progress: 0\n  data:\n    key: value\n"


def support(drop=None, job=JOB):
    return "".join(f"{k}: {v}\n" for k, v in SUPPORT.items() if k != drop) + f"ldap_sync_jobs: []\nmigration_jobs:\n{job}"


@pytest.mark.parametrize("meta,server", [(metadata(), SERVER), (None, "Unknown")])
def test_support_packet(spark, meta, server):
    files = {"support_packet.yaml": support()} | ({"metadata.yaml": meta} if meta else {})
    wide, jobs, rejects = packets.ingest_support_packets(frame(spark, {"a": packet(**files)}), "2024-08-01")
    row, job = wide.first(), jobs.first()
    assert row["metadata_server_id"] == server and row["database_version"] == "13.10" and row["master_db_connections"] == 14
    assert job["status"] == "success" and json.loads(job["data"]) == {"key": "value"} and job["createat"].year == 2024
    assert rejects.count() == 0


def test_bad_support_packets(spark):
    data = {"missing": packet(**{"support_packet.yaml": support("build_hash")}), "state": packet(**{"support_packet.yaml": support(job=JOB.replace("success", "odd"))})}
    wide, _, rejects = packets.ingest_support_packets(frame(spark, data), "2024-08-01")
    assert wide.count() == 0 and {r["source"]: r["reason"] for r in rejects.collect()} == {"missing": "missing fields", "state": "bad job"}


def test_landed_packets_are_read_rejected_and_resumed(spark, tmp_path):
    """Oversized files are not opened, a member that unpacks too far is a reject, a repeated packet is one copy."""
    from datetime import date

    root = f"file://{tmp_path}/landed"
    big = packet(**{"metadata.yaml": metadata(), "padding": __import__("random").Random(1).randbytes(9000)})
    landed = {"2024-08-01/a.zip": survey_packet(), "2024-08-02/b.zip": survey_packet(), "2024-08-02/c.zip": b"PK no zip", "2024-08-03/d.zip": big, "2024-08-03/e.txt": b"other", "2024-08-04/f.zip": survey_packet()}
    packets.write_packets(frame(spark, landed), root)
    packets.write_packets(frame(spark, {k: v for k, v in landed.items() if "02" in k}), root)
    assert sorted(p.relative_to(tmp_path / "landed").as_posix() for p in (tmp_path / "landed").rglob("*") if p.is_file() and not p.name.endswith(".crc")) == sorted(landed)
    ingest = lambda found: packets.ingest_survey_packets(found, PLUGIN, "2024-09-01")
    rows, rejects = packets.resume_packets(spark, root, None, date(2024, 8, 4), ingest, most_bytes=5000)
    assert {(r["source"], r["ingestion_date"]) for r in rows.collect()} == {("2024-08-01/a.zip", "2024-08-01"), ("2024-08-02/b.zip", "2024-08-02")}
    assert {tuple(r) for r in rejects.collect()} == {("2024-08-02/c.zip", "unreadable packet: BadZipFile"), ("2024-08-03/d.zip", "packet too large")}
    assert packets.new_folders(spark, root, rows, date(2024, 8, 9)) == [f"{root}/2024-08-0{n}" for n in (2, 3, 4)]
    more, _ = packets.resume_packets(spark, root, rows, date(2024, 8, 9), ingest, most_bytes=5000)
    assert {r["source"] for r in more.collect()} == {"2024-08-04/f.zip"}
    none, bad = packets.resume_packets(spark, root + "/nothing", None, date(2024, 8, 9), ingest)
    assert none.count() == 0 and bad.count() == 0


def test_members_that_unpack_too_far(spark):
    unzip = packets._members(["metadata.yaml"], most_member=100)
    import pandas as pd

    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("metadata.yaml", "a" * 100_000)
    out = next(unzip(iter([pd.DataFrame({"path": ["x"], "content": [buffer.getvalue()]})])))
    assert out.iloc[0].tolist() == ["x", "member too large", None]


def test_packets_are_listed_by_tasks_and_opened_in_tasks_by_their_number(spark, tmp_path, monkeypatch):
    """The listing is no call per file on the driver, a task opens a bounded number of packets, and known packets are not opened again."""
    from datetime import date

    monkeypatch.setattr(packets, "PACKETS_PER_TASK", 16)
    monkeypatch.setattr(packets, "LISTED_AT_ONCE", 64)
    landed = {f"2024-08-0{1 + n // 64}/p{n:03}.zip": survey_packet() for n in range(128)}
    root = f"file://{tmp_path}/many"
    packets.write_packets(frame(spark, landed).repartition(1), root)
    (tmp_path / "many" / "2024-08-02" / "_late.zip.part").write_bytes(b"unfinished")
    assert packets.new_folders(spark, root, None, date(2024, 8, 9)) == [f"{root}/2024-08-01", f"{root}/2024-08-02"]
    found, large = packets.read_packets(spark, [f"{root}/2024-08-01", f"{root}/2024-08-02"])
    assert found.rdd.getNumPartitions() == 8 and large.count() == 0
    assert {r["path"]: bytes(r["content"]) for r in found.collect()} == landed
    (tmp_path / "many" / "2024-08-02" / "p100.zip").unlink()
    target = spark.createDataFrame([(path, path[:10]) for path in landed if not path.endswith("127.zip")], "source string, ingestion_date string")
    (tmp_path / "many" / "2024-08-02" / "p101.zip").write_bytes(b"changed after it was ingested")
    rows, rejects = packets.resume_packets(spark, root, target, date(2024, 8, 9), lambda found: packets.ingest_survey_packets(found, PLUGIN, "2024-09-01"))
    assert {r["source"] for r in rows.collect()} == {"2024-08-02/p127.zip"} and rejects.count() == 0


def test_a_listing_or_a_batch_that_ends_evenly_hands_on_no_empty_batch(spark, tmp_path):
    landed = {f"2024-08-01/p{n:03}.zip": survey_packet() for n in range(packets.BATCH_PACKETS)}
    packets.write_packets(frame(spark, landed), f"{tmp_path}/even")
    found, _ = packets.read_packets(spark, f"{tmp_path}/even/2024-08-01")
    rows, rejects = packets.ingest_survey_packets(found, PLUGIN, "2024-09-01")
    assert rows.count() == 4 * packets.BATCH_PACKETS and rejects.count() == 0
