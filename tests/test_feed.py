import base64
import json
import math
import re
import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from regua.streaming import feed, sinklog

EVENT = {
    "event_type": "indicador_atualizado",
    "event_ts": "2025-03-04T05:06:07.123456+00:00",
    "ano": 2024,
    "id_municipio": 3550308,
    "rede": "Pública",
    "taxa_alfabetizacao": 61.25,
    "media_portugues": 743.5001,
    "fonte": "simulacao_streaming",
}


def put(folder, name, payloads):
    """A file of envelopes; payloads are dicts, text, bytes or ready encodings."""
    folder.mkdir(exist_ok=True)
    lines = []
    for payload in payloads:
        if isinstance(payload, tuple):
            encoded = payload[0]
        else:
            if isinstance(payload, dict):
                payload = json.dumps(payload, ensure_ascii=False)
            raw = payload if isinstance(payload, bytes) else payload.encode()
            encoded = base64.b64encode(raw).decode()
        lines.append(json.dumps({"kinesis": {"data": encoded}}))
    (folder / name).write_text("".join(line + "\n" for line in lines))


def ingest(spark, tmp_path, **reading):
    return feed.ingest(
        feed.read_envelopes(spark, str(tmp_path / "in"), **reading),
        str(tmp_path / "out"),
        str(tmp_path / "checkpoint"),
    ).total


def stored(spark, tmp_path, state=feed.VALID):
    return feed.read_events(spark, str(tmp_path / "out"), state).collect()


def test_event_round_trip(spark, tmp_path):
    put(tmp_path / "in", "a.jsonl", [EVENT])
    assert ingest(spark, tmp_path) == 1
    row = stored(spark, tmp_path)[0].asDict()
    assert {name: row[name] for name in EVENT} == EVENT
    assert json.loads(row["payload"]) == EVENT
    assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}\+00:00", row["_ingestion_ts"])
    assert str(row["dt_ingestao"]) == row["_ingestion_ts"][:10]


def test_payload_year_is_not_the_ingestion_year(spark, tmp_path):
    put(tmp_path / "in", "a.jsonl", [{**EVENT, "ano": 1999}])
    ingest(spark, tmp_path)
    assert [r.ano for r in stored(spark, tmp_path)] == [1999]


def test_unknown_keys_and_odd_types_pass(spark, tmp_path):
    spaced = "\n\t {} \r\n"
    put(tmp_path / "in", "a.jsonl", [{**EVENT, "ano": "dois mil", "novo": {"a": [1]}}, spaced])
    assert ingest(spark, tmp_path) == 2
    odd, empty = sorted(stored(spark, tmp_path), key=lambda r: -len(r.payload))
    assert odd.ano is None and odd.id_municipio == 3550308
    assert json.loads(odd.payload)["novo"] == {"a": [1]}
    assert empty.payload == spaced and empty.rede is None


def test_bad_records_do_not_stop_the_batch(spark, tmp_path):
    whole = json.dumps(EVENT)
    bad = ['{"ano": 20', "[1, 2]", '"text"', "12", "null", "", b"\xff\xfe{}", ("!!!",), (None,)]
    bad += [whole + tail for tail in (" x", whole, ",", "," + whole, "]", "}", "] x", ", 1]")]
    put(tmp_path / "in", "a.jsonl", [EVENT, *bad])
    assert ingest(spark, tmp_path) == 1 + len(bad)
    assert len(stored(spark, tmp_path)) == 1
    rejected = stored(spark, tmp_path, feed.INVALID)
    assert len(rejected) == len(bad)
    kept = {r.rejected for r in rejected}
    assert {"!!!", base64.b64encode(b"\xff\xfe{}").decode(), None} <= kept


def test_restart_adds_nothing_and_then_only_the_new(spark, tmp_path):
    put(tmp_path / "in", "a.jsonl", [EVENT] * 3)
    assert ingest(spark, tmp_path) == 3
    assert ingest(spark, tmp_path) == 0
    assert len(stored(spark, tmp_path)) == 3
    put(tmp_path / "in", "b.jsonl", [EVENT])
    assert ingest(spark, tmp_path) == 1
    assert len(stored(spark, tmp_path)) == 4


def test_one_stamp_per_batch(spark, tmp_path):
    for name in "abc":
        put(tmp_path / "in", f"{name}.jsonl", [EVENT] * 2)
    assert ingest(spark, tmp_path, max_files_per_trigger=1) == 6
    stamps = [r._ingestion_ts for r in stored(spark, tmp_path)]
    assert len(stamps) == 6 and len(set(stamps)) == 3


def test_empty_source(spark, tmp_path):
    (tmp_path / "in").mkdir()
    assert ingest(spark, tmp_path) == 0
    assert not list((tmp_path / "out").rglob("*.json"))


def test_stamp_is_utc_in_any_session_zone(spark, tmp_path):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        put(tmp_path / "in", "a.jsonl", [EVENT])
        ingest(spark, tmp_path)
        stamp = stored(spark, tmp_path)[0]._ingestion_ts
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    age = datetime.now(timezone.utc) - datetime.fromisoformat(stamp)
    assert 0 <= age.total_seconds() < 300


def test_counts_do_not_depend_on_remembered_progress(spark, tmp_path):
    name = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(name, "2")
    try:
        for k in range(5):
            put(tmp_path / "in", f"{k}.jsonl", [EVENT, "cut"] if k == 3 else [EVENT])
        envelopes = feed.read_envelopes(spark, str(tmp_path / "in"), max_files_per_trigger=1)
        written = feed.ingest(envelopes, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    finally:
        spark.conf.unset(name)
    assert written == (5, 1)


def crash(tmp_path, batch, *, in_sink):
    """What is left if a run ends after writing the files of a batch: its commits are missing."""
    logs = [tmp_path / "checkpoint" / "commits"]
    logs += [tmp_path / "out" / "_spark_metadata"] if in_sink else []
    for log in logs:
        for name in (f"{batch}", f".{batch}.crc"):
            (log / name).unlink()


@pytest.mark.parametrize("in_sink", [True, False])
def test_a_batch_begun_before_a_crash_is_counted_by_the_run_that_ends_it(spark, tmp_path, in_sink):
    put(tmp_path / "in", "a.jsonl", [EVENT] * 5 + ["cut", "[]"])
    assert ingest(spark, tmp_path) == 7
    crash(tmp_path, 0, in_sink=in_sink)
    assert ingest(spark, tmp_path) == 7
    assert len(stored(spark, tmp_path)) == 5 and len(stored(spark, tmp_path, feed.INVALID)) == 2
    assert ingest(spark, tmp_path) == 0


@pytest.mark.parametrize("in_sink", [True, False])
def test_a_later_batch_after_a_crash(spark, tmp_path, in_sink):
    put(tmp_path / "in", "a.jsonl", [EVENT] * 3)
    assert ingest(spark, tmp_path) == 3
    put(tmp_path / "in", "b.jsonl", [EVENT, "cut"])
    assert ingest(spark, tmp_path) == 2
    crash(tmp_path, 1, in_sink=in_sink)
    put(tmp_path / "in", "c.jsonl", [EVENT] * 4)
    # The repeated batch and the new one.
    assert ingest(spark, tmp_path) == 6
    assert len(stored(spark, tmp_path)) == 8


def test_counts_over_packed_logs(spark, tmp_path):
    """The sink packs its log every tenth batch."""
    for k in range(12):
        put(tmp_path / "in", f"{k:02}.jsonl", [EVENT] * (k + 1))
    assert ingest(spark, tmp_path, max_files_per_trigger=1) == 78
    log = tmp_path / "out" / "_spark_metadata"
    assert list(log.glob("9.compact"))
    # The sink may drop what is packed.
    for k in range(9):
        (log / str(k)).unlink()
        (log / f".{k}.crc").unlink()
    for k in range(12, 24):
        put(tmp_path / "in", f"{k:02}.jsonl", [EVENT, "cut"])
    envelopes = feed.read_envelopes(spark, str(tmp_path / "in"), 1)
    assert feed.ingest(envelopes, str(tmp_path / "out"), str(tmp_path / "checkpoint")) == (12, 12)
    assert len(stored(spark, tmp_path)) == 90


def test_events_by_batch(spark, tmp_path):
    for k in range(3):
        put(tmp_path / "in", f"{k}.jsonl", [EVENT] * (k + 1) + ["cut"] * (k == 1))
    ingest(spark, tmp_path, max_files_per_trigger=1)
    target = str(tmp_path / "out")
    found = feed.events_by_batch(spark, target, sinklog.committed_files(spark, target)).orderBy("stamp")
    assert [(r.valid, r.invalid) for r in found.collect()] == [(1, 0), (2, 1), (3, 0)]


def test_runs_that_overlap_in_time(spark, tmp_path):
    """Two feeds at once, each with its own target and checkpoint."""
    runs = []
    for name, n in (("x", 4), ("y", 9)):
        put(tmp_path / f"in-{name}", "a.jsonl", [EVENT] * n)
        out, checkpoint = str(tmp_path / f"out-{name}"), str(tmp_path / f"cp-{name}")
        known = sinklog.committed_files(spark, out, sinklog.last_commit(spark, checkpoint))
        query = feed.start_ingest(feed.read_envelopes(spark, str(tmp_path / f"in-{name}")), out, checkpoint)
        runs.append((query, out, known))
    for query, _, _ in runs:
        query.awaitTermination()
    counts = [feed.records_written(spark, out, sinklog.files_since(spark, out, known)) for _, out, known in runs]
    assert counts == [(4, 0), (9, 0)]


def once(spark, tmp_path, within="1 hour", key=()):
    envelopes = feed.read_envelopes(spark, str(tmp_path / "in"), 1)
    return feed.ingest(envelopes, str(tmp_path / "out"), str(tmp_path / "checkpoint"), once_within=within, key=key)


def test_redelivered_events_are_stored_once(spark, tmp_path):
    other = {**EVENT, "ano": 2023}
    put(tmp_path / "in", "a.jsonl", [EVENT, EVENT, other, "cut", "cut", ("!!!",), (None,), (None,)])
    # Valid: two; invalid: the cut text, the bad encoding, nothing at all.
    assert once(spark, tmp_path) == (2, 3)
    put(tmp_path / "in", "b.jsonl", [EVENT, other, "cut", {**EVENT, "ano": 2022}])
    assert once(spark, tmp_path) == (1, 0)
    assert sorted(r.ano for r in stored(spark, tmp_path)) == [2022, 2023, 2024]
    assert once(spark, tmp_path) == (0, 0)


def test_redelivered_by_key(spark, tmp_path):
    key = ("id_municipio", "event_ts")
    put(tmp_path / "in", "a.jsonl", [EVENT, {**EVENT, "fonte": "again"}, {**EVENT, "id_municipio": 1}])
    # Without a key field, the text decides.
    put(tmp_path / "in", "b.jsonl", ['{"ano": 1}', '{"ano": 1}', '{"ano": 2}', {**EVENT, "fonte": "once more"}])
    assert once(spark, tmp_path, key=key) == (4, 0)


def test_copies_behind_the_watermark_are_new_and_the_state_is_bounded(spark, tmp_path):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        put(tmp_path / "in", "a.jsonl", [EVENT])
        assert once(spark, tmp_path, "1 second") == (1, 0)
        for k in range(2):
            time.sleep(2.5)
            put(tmp_path / "in", f"later-{k}.jsonl", [{**EVENT, "ano": k}])
            assert once(spark, tmp_path, "1 second") == (1, 0)
        put(tmp_path / "in", "z.jsonl", [EVENT])
        assert once(spark, tmp_path, "1 second") == (1, 0)
        state = spark.read.format("statestore").load(str(tmp_path / "checkpoint"))
        assert state.count() <= 2
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_a_crash_with_state_repeats_nothing(spark, tmp_path):
    put(tmp_path / "in", "a.jsonl", [EVENT] * 3)
    assert once(spark, tmp_path) == (1, 0)
    last = sinklog.last_commit(spark, str(tmp_path / "checkpoint"))
    for batch in range(last, -1, -1):
        crash(tmp_path, batch, in_sink=False)
    assert once(spark, tmp_path) == (1, 0)
    assert len(stored(spark, tmp_path)) == 1


def test_a_target_of_another_checkpoint_is_refused(spark, tmp_path):
    """The sink would take the batch for a repetition and drop it."""
    put(tmp_path / "in", "a.jsonl", [EVENT] * 2)
    assert ingest(spark, tmp_path) == 2
    with pytest.raises(ValueError, match="another checkpoint"):
        feed.ingest(
            feed.read_envelopes(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "new")
        )


@pytest.mark.parametrize(
    "instant",
    ["2026-03-08T02:30:00.000000", "2026-11-01T05:30:00.100000", "2026-11-01T06:30:00.123456",
     "1969-12-31T23:59:59.999999", "2024-02-29T00:00:00.000001"],
)
def test_stamp_is_the_instant_in_every_hour(spark, instant):
    """New York skips 02:30 on the first day and has two 01:30 on the second."""
    moment = datetime.fromisoformat(instant + "+00:00")
    micros = (moment - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        envelopes = spark.createDataFrame([((None,),)], feed.ENVELOPE)
        row = feed.decode_events(envelopes, micros=F.lit(micros)).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert row["_ingestion_ts"] == instant + "+00:00"
    assert str(row["dt_ingestao"]) == instant[:10]


def test_numbers_and_keys_that_strict_json_refuses(spark, tmp_path):
    odd = [
        '{"rede": "x", "taxa_alfabetizacao": NaN, "ano": 2024}',
        '{"ano": 1, "rede": "a", "ano": 2}',
    ]
    bad = [odd[0] + " x", odd[1] + ",", '{"a": NaN}, {"b": 1}', '[{"a": NaN}]']
    put(tmp_path / "in", "a.jsonl", [*odd, *bad])
    ingest(spark, tmp_path)
    first, second = sorted(stored(spark, tmp_path), key=lambda r: -len(r.payload))
    assert math.isnan(first.taxa_alfabetizacao) and (first.ano, first.rede) == (2024, "x")
    assert (second.ano, second.rede) == (2, "a")
    assert len(stored(spark, tmp_path, feed.INVALID)) == len(bad)


def test_strict_reading_is_an_option(spark):
    texts = ['{"a": NaN}', '{"ano": 1, "ano": 2}', '{"ano": 3}']
    rows = [((base64.b64encode(t.encode()).decode(),),) for t in texts]
    found = feed.decode_events(spark.createDataFrame(rows, feed.ENVELOPE), strict=True).collect()
    assert [r.ano for r in found] == [None, None, 3]
    assert [r[feed.STATE_COLUMN] for r in found] == [feed.INVALID, feed.INVALID, feed.VALID]
