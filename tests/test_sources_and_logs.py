from __future__ import annotations

import datetime
import gzip
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from quillvault import fixed_values as fv
from quillvault.operators.audit import alert_counters, by_request, latest, log_tail, recent_queries
from quillvault.sources.corpus import read_corpus, seeded_sample, smallest_keys, write_extract
from quillvault.sources import events as log_events
from quillvault.sources.events import (
    event_line,
    last_lines,
    read_events,
    read_last,
    read_log,
    stream_events,
    typed_details,
    write_events,
)
from quillvault.sources.shared import fresh_path, scratch, shared_folder, staged
from quillvault.streaming.jobs import alerts_to_table, dedup_to_table, windowed_alerts


def write(path, text):
    with open(path, "w", encoding="utf-8") as handle:
        handle.write(text)
    return str(path)


def test_jsonl_defaults_and_blank_lines(spark, tmp_path):
    path = write(
        tmp_path / "c.jsonl",
        '{"context": "a", "source_id": "x1", "question": "q?"}\n\n   \n{"context": "b"}\n{"context": "c", "answer": "é"}\n',
    )
    rows = sorted(read_corpus(spark, path).collect(), key=lambda r: r.ord)
    assert [(r.ord, r.source_id, r.source_ref, r.context) for r in rows] == [
        (0, "x1", "rag12000:x1", "a"),
        (3, "line3", "rag12000:line3", "b"),
        (4, "line4", "rag12000:line4", "c"),
    ]
    assert rows[0].question == "q?" and rows[2].answer == "é"


def test_line_numbers_hold_across_many_blocks(spark, tmp_path):
    lines = [json.dumps({"context": f"text {i} " + "x" * (i % 50)}) for i in range(5000)]
    path = write(tmp_path / "big.jsonl", "\n".join(lines) + "\n")
    previous = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = read_corpus(spark, path)
        assert rows.rdd.getNumPartitions() > 3
        got = {r.source_id: r.context for r in rows.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", previous)
    assert got == {f"line{i}": json.loads(line)["context"] for i, line in enumerate(lines)}


def test_missing_context_and_bad_json_fail(spark, tmp_path):
    with pytest.raises(Exception, match="missing context on line 2"):
        read_corpus(spark, write(tmp_path / "m.jsonl", '{"context":"a"}\n{"question":"b"}\n')).collect()
    with pytest.raises(Exception):
        read_corpus(spark, write(tmp_path / "b.jsonl", '{"context":"a"}\n{"context": \n')).collect()


def test_sample_depends_on_seed_only(spark):
    df = spark.range(500).withColumnRenamed("id", "source_id")
    one = [r.source_id for r in seeded_sample(df, "source_id", 20, 42).orderBy("sample_ord").collect()]
    two = [
        r.source_id
        for r in seeded_sample(df.repartition(7), "source_id", 20, 42).orderBy("sample_ord").collect()
    ]
    other = [r.source_id for r in seeded_sample(df, "source_id", 20, 43).collect()]
    assert one == two and len(one) == 20 and set(one) != set(other)
    assert seeded_sample(df, "source_id", 1000, 1).count() == 500
    places = [r.sample_ord for r in seeded_sample(df, "source_id", 20, 42).collect()]
    assert sorted(places) == list(range(20))


@pytest.mark.parametrize("n", [1, 3, 150, 1999, 2000])
def test_a_threshold_finds_the_smallest_keys(spark, n):
    keyed = spark.range(2000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("k"))
    kept = smallest_keys(keyed, "k", n)
    ordered = [r.id for r in keyed.orderBy("k", "id").limit(n).collect()]
    assert [r.id for r in kept.orderBy("k", "id").limit(n).collect()] == ordered
    if n == 150:
        assert kept.count() < 400


def test_too_low_a_threshold_costs_nothing_but_time(spark):
    keyed = spark.range(3000).select("id", F.lit("f" * 64).alias("k"))  # as uneven as can be
    assert smallest_keys(keyed, "k", 5).count() == 3000


def test_extract(spark):
    df = spark.createDataFrame(
        [(i, f"c{i}", f"q{i}", f"a{i}") for i in range(10)], "id int, context string, question string, answer string"
    )
    path = fresh_path(spark, "extract")
    write_extract(df, path, 4, 42, "id")
    rows = read_corpus(spark, path, ids_given=True).collect()
    assert sorted(r.source_id for r in rows) == ["0", "1", "2", "3"]
    with pytest.raises(ValueError):
        write_extract(df.drop("answer"), path, 4, 42, "id")


def events_frame(spark):
    start = datetime.datetime(2024, 1, 1, 12, 0, 0)
    names = ["query_start", "query_done", "below_threshold", "hmac_mismatch", "other"]
    return spark.createDataFrame(
        [(i, start + datetime.timedelta(seconds=7 * i), names[i % 5], f"r{i // 5}" if i % 2 else None) for i in range(400)],
        "n int, ts timestamp, event string, request_id string",
    )


def lines(df):
    detail = F.struct(F.lit("rag").alias("mode"), F.col("n").alias("n_chunks"), F.lit(1.5).alias("duration_s"))
    return df.select(
        event_line(F.col("ts"), F.col("event"), F.lit("query"), detail, F.col("request_id")).alias("value")
    )


def test_event_lines_round_trip(spark, tmp_path):
    written = [json.loads(r.value) for r in lines(events_frame(spark)).collect()]
    assert written[0] == {
        "ts": "2024-01-01T12:00:00.000+00:00",
        "level": "INFO",
        "event": "query_start",
        "component": "query",
        "detail": {"mode": "rag", "n_chunks": 0, "duration_s": 1.5},
    }
    assert written[1]["request_id"] == "r0" and written[2]["level"] == "WARNING"
    path = fresh_path(spark, "log")
    write_events(lines(events_frame(spark)), path)
    write(os.path.join(path, "zz.txt"), '{"event": "hmac_mis\nnot json\n\n')
    back = read_events(spark, path)
    assert back.count() == 400
    counts = {r.event: r.n for r in alert_counters(back).collect()}
    assert counts == {e: 80 if e in ("below_threshold", "hmac_mismatch") else 0 for e in fv.ALERT_EVENTS}
    newest = recent_queries(back).collect()
    assert [r.n_chunks for r in newest] == [396 - 5 * i for i in range(10)]
    assert newest[0].mode == "rag" and newest[0].duration_s == 1.5


def test_tail_and_latest(spark):
    df = events_frame(spark)
    assert sorted(r.n for r in log_tail(df, "n", 3).collect()) == [397, 398, 399]
    assert [r.n for r in latest(df, "ts", 2).collect()] == [399, 398]


def test_one_row_per_request(spark):
    got = {r.request_id: r for r in by_request(events_frame(spark)).collect()}
    assert len(got) == 80
    assert got["r0"].events == 2 and got["r0"].security_events == 1
    assert got["r0"].started is None and got["r0"].done is not None


def test_late_events_are_dropped(spark, tmp_path):
    """Windows close ten minutes behind the newest event; older rows of a later file do not count."""
    folder = tmp_path / "in"
    folder.mkdir()

    def event(at):
        return json.dumps({"ts": at, "event": "hmac_mismatch", "component": "query", "detail": {}})

    write(folder / "1.json", "\n".join([event("2024-01-01T10:00:05+00:00"), event("2024-01-01T11:00:00+00:00")]))
    out, checkpoint = fresh_path(spark, "out"), fresh_path(spark, "cp")

    def run():
        counted = windowed_alerts(stream_events(spark, str(folder)), fv.ALERT_EVENTS)
        query = (
            counted.writeStream.outputMode("append")
            .format("parquet")
            .option("path", out)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return {str(r.window_start): r.n for r in spark.read.parquet(out).collect()}

    assert run() == {"2024-01-01 10:00:00": 1}
    write(
        folder / "2.json",
        "\n".join([event("2024-01-01T10:00:06+00:00"), event("2024-01-01T10:55:00+00:00"), event("2024-01-01T12:00:00+00:00")]),
    )
    assert run() == {"2024-01-01 10:00:00": 1, "2024-01-01 10:55:00": 1, "2024-01-01 11:00:00": 1}


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_log_is_read_in_line_order_and_its_tail_taken_first(spark, tmp_path):
    lines = [json.dumps({"event": f"e{i}", "detail": {"n": i}}) for i in range(30)]
    lines[27] = lines[27][:9]
    lines[28] = '{"event": "odd", "detail": [1, 2], "ts": "t"}'
    lines[29] = '{"level": "INFO"}'
    lines += ["[1, 2]", "7", ""]
    path = write(tmp_path / "log.jsonl", "\n".join(lines) + "\n")
    got = read_log(spark, path, tail=7).orderBy("line_number").collect()
    assert [(r.line_number, r.event, r.detail) for r in got] == [
        (26, "e26", {"n": "26"}),
        (28, "odd", None),
        (29, None, None),
    ]
    assert read_log(spark, path).count() == 29


@pytest.mark.parametrize("block", [1, 7, 64, 1 << 20])
def test_the_last_lines_are_read_from_the_end(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(log_events, "BLOCK_BYTES", block)
    folder = tmp_path / "log"
    folder.mkdir()
    lines = [json.dumps({"event": f"é{i}", "detail": {"n": "x" * (i % 30)}}, ensure_ascii=False) for i in range(60)]
    ends = ["\n", "\r\n", "\r", "\n"]
    for part in range(4):
        some = lines[15 * part : 15 * part + 15]
        last = "" if part == 2 else ends[part]
        (folder / f"part-{part}.txt").write_bytes((ends[part].join(some) + last).encode())
    (folder / "part-9.txt").write_bytes(b"")
    (folder / "_SUCCESS").write_bytes(b"")
    for wanted in (0, 1, 7, 15, 16, 44, 60, 99):
        assert last_lines(spark, str(folder), wanted) == lines[60 - min(wanted, 60) :]
    events = read_last(spark, str(folder), 16).orderBy("line_number").collect()
    assert [e.event for e in events] == [f"é{i}" for i in range(44, 60)]


def test_a_packed_file_among_the_last(spark, tmp_path):
    folder = tmp_path / "log"
    folder.mkdir()
    (folder / "a.txt").write_text("1\n2\n3\n")
    (folder / "b.txt.gz").write_bytes(gzip.compress(b"4\n5\n"))
    (folder / "c.txt").write_text("6\n")
    for wanted in range(8):
        assert last_lines(spark, str(folder), wanted) == list("123456")[6 - min(6, wanted) :]


def test_the_time_of_the_last_lines_does_not_depend_on_the_log(spark, tmp_path, monkeypatch):
    folder = tmp_path / "log"
    folder.mkdir()
    for i in range(12):
        (folder / f"part-{i:02d}.txt").write_text(f'{{"event": "e{i}"}}\n' * 2000)
    opened = []
    read = log_events._last_of_file

    def noted(spark, file, length, wanted):
        opened.append(file[-11:-4])
        return read(spark, file, length, wanted)

    monkeypatch.setattr(log_events, "_last_of_file", noted)
    assert read_last(spark, str(folder), 2500).groupBy("event").count().count() == 2
    assert opened == ["part-11", "part-10"]


def test_details_keep_their_types(spark):
    lines = [
        '{"event": "a", "level": "INFO", "detail": {"categories": {"IP": 2, "EMAIL": 1}, "list": [1, 2.5], "ok": true}}',
        '{"event": "b", "detail": [1]}', '{"event": "c"}', "broken {", "[1]", '{"event": "d", "detail": "text"}',
    ]
    events = typed_details(spark.createDataFrame([(x,) for x in lines], "value string"))
    got = events.select(
        "event",
        F.try_variant_get("detail", "$.categories", "map<string,int>").alias("categories"),
        F.try_variant_get("detail", "$.list[1]", "double").alias("second"),
        F.try_variant_get("detail", "$.ok", "boolean").alias("ok"),
    ).collect()
    assert [tuple(r) for r in got] == [
        ("a", {"IP": 2, "EMAIL": 1}, 2.5, True), ("b", None, None, None), ("c", None, None, None), ("d", None, None, None),
    ]


def test_streams_into_tables(spark, tmp_path):
    source = str(tmp_path / "in")
    stamp = datetime.datetime(2026, 1, 1)

    def add(rows):
        spark.createDataFrame(rows, "ts timestamp, event string, text string").write.mode("append").parquet(source)

    def stream():
        return spark.readStream.schema("ts timestamp, event string, text string").parquet(source)

    def at(seconds):
        return stamp + datetime.timedelta(seconds=seconds)

    add([(at(1), "hmac_mismatch", "a b"), (at(2), "query_done", "a  b"), (at(31), "auth_failed", "c")])
    path, seen = str(tmp_path / "alerts"), str(tmp_path / "seen")
    table, kept = str(tmp_path / "table"), str(tmp_path / "kept")
    alerts_to_table(stream(), path, seen)
    assert dedup_to_table(stream(), "text", table, kept).count() == 2
    add([(at(3), "hmac_mismatch", "c"), (at(95), "query_done", "d")])
    got = {(r.window_start, r.event): r.n for r in alerts_to_table(stream(), path, seen).collect()}
    assert len(got) == 12
    assert {k: n for k, n in got.items() if n} == {(at(0), "hmac_mismatch"): 2, (at(30), "auth_failed"): 1}
    assert dedup_to_table(stream(), "text", table, kept).count() == 3
    again = dedup_to_table(stream(), "text", table, str(tmp_path / "other"), stream="other")
    assert again.count() == 3


def test_open_windows_stay_few_over_many_batches(spark, tmp_path):
    """Closed windows are written once; what a batch reads does not grow with the batches."""
    rnd, start = random.Random(4), datetime.datetime(2024, 1, 1)
    names, want = ("a", "b"), {}
    folder = tmp_path / "in"
    folder.mkdir()
    for part in range(14):
        rows = []
        for _ in range(20):
            # Up to 50 s behind the newest event of the batch before: late, but not too late.
            at = start + datetime.timedelta(seconds=120 * part + rnd.randint(-50, 119))
            name = rnd.choice(["a", "b", "other"])
            rows.append({"ts": at.isoformat(), "event": name})
            if name != "other":
                key = at.replace(second=30 * (at.second // 30)), name
                want[key] = want.get(key, 0) + 1
        rows.append({"ts": (start + datetime.timedelta(seconds=120 * part + 119)).isoformat(), "event": "a"})
        key = start + datetime.timedelta(seconds=120 * part + 90), "a"
        want[key] = want.get(key, 0) + 1
        path = folder / f"part-{part:02d}.json"
        path.write_text("\n".join(map(json.dumps, rows)))
        os.utime(path, (1_700_000_000 + part, 1_700_000_000 + part))
    stream = (
        spark.readStream.schema("ts timestamp, event string")
        .option("maxFilesPerTrigger", 1)
        .json(str(folder))
    )
    table = str(tmp_path / "table")
    out = alerts_to_table(stream, table, str(tmp_path / "seen"), names, lateness="1 minute")
    got = [(r.window_start, r.event, r.n) for r in out.collect()]
    windows = {w for w, _ in want}
    assert sorted(got) == sorted((w, n, want.get((w, n), 0)) for w in windows for n in names)
    sizes = {r.batch: r["count"] for r in spark.read.parquet(f"{table}/open").groupBy("batch").count().collect()}
    assert len(sizes) >= 14 and max(sizes.values()) <= 2 * 14  # windows of three batches at most
    assert spark.read.parquet(f"{table}/closed").count() > len(got) / 2


def test_staged_tables_are_emptied(spark):
    with scratch(spark):
        table = staged(spark.range(50), "some")
        assert table.count() == 50
        folder = os.path.dirname(table.inputFiles()[0])
    assert spark.read.schema("id bigint").parquet(folder).count() == 0
