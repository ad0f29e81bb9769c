"""Runs from end to end: archive, alerts, reports, ledger and its copy, and raw files through a stream."""
import os
import re

import pytest
from pyspark.sql import functions as F

from veilnote import session
from veilnote.functions.text import py_quoted_list
from veilnote.operators.manifest import MAX_ATTEMPTS, failed_again, with_letters
from veilnote.operators.selection import isolate_errors, skip_processed
from veilnote.plans import daily_run as daily
from veilnote.plans.daily_run import Run, daily_run
from veilnote.sources.notes_csv import count_note_rows, csv_files, no_match_alert, scan_notes_csv
from veilnote.sources.state import append_state, init_state, logged_among, publish_ledger, read_letters, read_state
from veilnote.streaming.incremental import incremental_folder

HEAD = "Date,First Name,Last Name,Note,Support Worker\n"
ROW = "15/01/2025,Petra,Holt,Petra sorted seeds with Mara Quill.,Mara Quill\n"
HELD = "15/01/2025,Ivo,Lund,Ref +61412345678901234567 with Petra.,\n"


def write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as fh:
        fh.write(text)


def test_daily_run_end_to_end(spark, tmp_path):
    inbox, base, archive, copy = (str(tmp_path / n) for n in ("in", "state", "archive", "ledger"))
    write(inbox, "a.csv", HEAD + ROW + HELD)
    write(inbox, "b.csv", HEAD)
    write(inbox, "c.csv", HEAD + "14/01/2025,Ivo,Lund,Yesterday.,\n")
    write(inbox, "readme.md", "stays")
    run = Run(base, "r1", "2025-01-15", "a.csv", archive, copy)
    stats = daily_run(spark, inbox, run).first().asDict()
    assert stats == {"total": 2, "uploaded": 1, "quarantined": 1, "skipped": 0, "errors": 0}
    assert sorted(os.listdir(inbox)) == ["c.csv", "readme.md"]       # the file of the day before waits for its own run
    assert sorted(os.listdir(f"{archive}/2025-01-15")) == ["a.csv", "b.csv"]
    manifest = {r.src_file: (r.rows, r.due, r.logged, r.waiting, r.complete) for r in spark.read.parquet(f"{base}/manifest").collect()}
    assert manifest == {"a.csv": (2, 2, 2, 0, True), "b.csv": (0, 0, 0, 0, True), "c.csv": (1, 0, 0, 1, False)}
    assert [r["CSV File"] for r in read_state(spark, base, "run_ledger").collect()] == ["a.csv"]
    reports = {n: spark.read.parquet(f"{base}/reports/{n}").drop("run_id").collect() for n in ("metrics", "quarantined", "errors", "alerts")}
    assert len(reports["metrics"]) == 5 and not reports["errors"]
    assert [(r.ref_code, r.reason) for r in reports["quarantined"]] == [
        ("PART-002", "Residual NDIS-pattern numbers in output: [masked]")]
    assert {r.src_file for r in reports["alerts"]} == {"b.csv", "c.csv"}
    assert spark.read.option("header", "true").csv(copy).count() == 1

    write(inbox, "late.csv", HEAD + ROW)
    assert daily_run(spark, inbox, run) is None             # the date was archived
    assert "late.csv" in os.listdir(inbox)
    again = daily_run(spark, inbox, Run(base, "r2", "2025-01-15", published=copy)).first()
    assert (again.total, again.uploaded, again.skipped) == (1, 0, 1)
    assert spark.read.option("header", "true").csv(copy).count() == 2
    assert sorted(os.listdir(tmp_path)) == ["archive", "in", "ledger", "state"]


def everything_under(*folders):
    return {os.path.join(top, f): open(os.path.join(top, f), "rb").read() for folder in folders for top, _, names in os.walk(folder) for f in names}


def test_late_files_wait_for_their_date(spark, tmp_path):
    inbox, base, archive = (str(tmp_path / n) for n in ("in", "state", "archive"))
    write(inbox, "a.csv", HEAD + ROW)
    assert daily_run(spark, inbox, Run(base, "r15", "2025-01-15", archive=archive)).first().uploaded == 1
    write(inbox, "late.csv", HEAD + HELD)
    write(inbox, "both.csv", HEAD + "16/01/2025,Ivo,Lund,A walk.,\n17/01/2025,Ivo,Lund,A swim.,\njunk,Ivo,Lund,No date.,\n")
    assert daily_run(spark, inbox, Run(base, "again", "2025-01-15", archive=archive)) is None
    assert daily_run(spark, inbox, Run(base, "r16", "2025-01-16", archive=archive)).first().total == 1
    assert sorted(os.listdir(inbox)) == ["both.csv", "late.csv"] and not os.path.exists(f"{archive}/2025-01-16")
    assert daily_run(spark, inbox, Run(base, "r17", "2025-01-17", archive=archive)).first().uploaded == 1
    assert os.listdir(inbox) == ["late.csv"] and os.listdir(f"{archive}/2025-01-17") == ["both.csv"]
    assert daily_run(spark, inbox, Run(base, "r15b", "2025-01-15")).first().quarantined == 1
    files = [r["CSV File"] for r in read_state(spark, base, "run_ledger").orderBy("Run At (ISO)").collect()]
    assert files == ["1 file(s)"] * 4


def test_failed_notes_come_back(spark, tmp_path):
    inbox, base, archive = (str(tmp_path / n) for n in ("in", "state", "archive"))
    write(inbox, "2025-01-15-PART-001.txt", "Fine.")
    bad = os.path.join(inbox, "2025-01-15-PART-002.txt")
    with open(bad, "wb") as fh:
        fh.write(b"Called \xc3\x28 0437 218 906.")
    run = lambda k: daily_run(spark, inbox, Run(base, f"r{k}", "2025-01-15", archive=archive))
    first = run(1).first()
    assert (first.total, first.uploaded, first.errors) == (2, 1, 1)
    assert os.listdir(inbox) == ["2025-01-15-PART-002.txt"]
    assert [(r.note_id, r.attempt) for r in read_letters(spark, base).collect()] == [("2025-01-15-PART-002", 1)]
    assert run(2).first().errors == 1                       # the date was archived, but a note is to be tried again
    assert [(r.note_id, r.attempt) for r in read_letters(spark, base).collect()] == [("2025-01-15-PART-002", 2)]
    with open(bad, "wb") as fh:
        fh.write(b"Called 0437 218 906.")
    third = run(3).first()
    assert (third.total, third.uploaded, third.errors) == (1, 1, 0)
    assert os.listdir(inbox) == [] and read_letters(spark, base).isEmpty() and run(4) is None
    assert {r.note_id for r in read_state(spark, base, "processed_log").collect()} == {"2025-01-15-PART-001", "2025-01-15-PART-002"}
    assert not any(b"906" in data for data in everything_under(base).values())


def test_notes_are_given_up_in_the_end(spark, tmp_path):
    inbox, base, archive = (str(tmp_path / n) for n in ("in", "state", "archive"))
    os.makedirs(inbox)
    with open(os.path.join(inbox, "2025-01-15-PART-002.txt"), "wb") as fh:
        fh.write(b"\xc3\x28")
    for k in range(1, MAX_ATTEMPTS + 1):
        assert daily_run(spark, inbox, Run(base, f"r{k}", "2025-01-15", archive=archive)).first().errors == 1
        assert os.listdir(inbox) == ([] if k == MAX_ATTEMPTS else ["2025-01-15-PART-002.txt"])
    assert [r.attempt for r in read_letters(spark, base).collect()] == [MAX_ATTEMPTS]
    assert daily_run(spark, inbox, Run(base, "more", "2025-01-15", archive=archive)) is None


def test_letters_without_their_file(spark):
    """Notes of a table are tried again from the letters alone; those given anew replace their letter."""
    columns = "src_file string, src_row long, note_id string, ref_code string, created_at string, note string"
    given = spark.createDataFrame([("f", 1, "n1", "C", "d", "new"), ("f", 2, None, "C", "d", "x"), ("f", 3, "n3", "C", "d", "y")], columns)
    letters = spark.createDataFrame([("f", 9, "n1", "C", "d", "old", "why", 2), ("f", 2, None, "C", "d", "x", "why", 1), ("g", 2, None, "C", "d", "z", "why", 1),
                                     ("f", 4, "n4", "C", "d", "w", "why", 3), ("f", 5, "n5", "C", "d", "v", "why", MAX_ATTEMPTS)], columns + ", reason string, attempt int")
    every = with_letters(given, letters)
    assert sorted((r.note, r.attempt) for r in every.collect()) == [("new", 2), ("w", 3), ("x", 1), ("y", 0), ("z", 1)]
    after = failed_again(isolate_errors(every), letters)
    assert sorted((r.note, r.attempt) for r in after.collect()) == [("v", MAX_ATTEMPTS), ("x", 2), ("z", 2)]
    empty = spark.createDataFrame([], columns)
    assert with_letters(empty, letters.limit(0)).isEmpty()


def test_no_raw_text_is_left(spark, tmp_path, monkeypatch):
    inbox, base, shared = (str(tmp_path / n) for n in ("in", "state", "shared"))
    write(inbox, "a.csv", HEAD + "15/01/2025,Petra,Holt,Petra Zwiebelmeer rang 0437218906.,Mara Quill\n")
    monkeypatch.setattr(session, "shared_folder", lambda spark: shared)
    surfaces = spark.createDataFrame([("Carer", "Zwiebelmeer")], "type string, surface string")
    assert daily_run(spark, inbox, Run(base, "r", "2025-01-15"), surfaces).first().uploaded == 1
    assert not any(b"Zwiebelmeer" in data or b"0437218906" in data for data in everything_under(base, shared).values())
    monkeypatch.setattr(daily, "rendered", lambda *_: 1 / 0)
    write(inbox, "b.csv", HEAD + "15/01/2025,Petra,Holt,Petra Zwiebelmeer again.,Mara Quill\n")
    with pytest.raises(ZeroDivisionError):
        daily_run(spark, inbox, Run(base, "s", "2025-01-15"), surfaces)
    assert not any(b"Zwiebelmeer" in data for data in everything_under(base, shared).values()) and not os.listdir(shared)


def test_log_is_read_by_prefix(spark, tmp_path):
    base = str(tmp_path)
    init_state(spark, base)
    log = spark.range(2000).select(F.concat(F.lit("n"), "id").alias("note_id"), F.current_timestamp().alias("processed_at"), F.lit("").alias("output_path"),
                                   F.lit("success").alias("status"), F.lit("c").alias("ref_code"))
    append_state(log, base, "processed_log", "r")
    asked = spark.createDataFrame([("n5",), ("n77",), (None,), ("new",)], "note_id string")
    near = logged_among(spark, base, asked)
    assert {"n5", "n77"} <= {r.note_id for r in near.collect()} and near.count() < 100
    assert re.search(r"PartitionFilters: \[prefix#\d+ IN \(", near._jdf.queryExecution().executedPlan().toString())
    assert near.select(F.input_file_name().alias("f")).distinct().count() in (2, 3)
    assert [r.note_id for r in skip_processed(asked, near).where("note_id is not null").collect()] == ["new"]
    assert read_state(spark, base, "processed_log", "r").count() == 2000


def test_one_ledger_row_per_run(spark, tmp_path):
    inbox, base = str(tmp_path / "in"), str(tmp_path / "state")
    write(inbox, "a.csv", HEAD + ROW + HELD)
    run = Run(base, "same", "2025-01-15")
    first = daily_run(spark, inbox, run).first().asDict()
    assert daily_run(spark, inbox, run).first().asDict() == first      # a replay counts what the run did
    write(inbox, "late.csv", HEAD + "15/01/2025,Ivo,Lund,Late walk.,\n")
    assert daily_run(spark, inbox, run).first().uploaded == 2
    assert read_state(spark, base, "run_ledger").count() == 1
    log = {r.note_id for r in read_state(spark, base, "processed_log").collect()}
    outputs = [r.note_id for r in spark.read.parquet(f"{base}/outputs").collect()]
    assert len(outputs) == 3 and set(outputs) == log


def test_files_through_a_stream(spark, tmp_path):
    inbox, base = str(tmp_path / "in"), str(tmp_path / "state")

    def take(checkpoint, kind="csv"):
        incremental_folder(spark, inbox, base, str(tmp_path / checkpoint), "2025-01-15", kind).awaitTermination()
        return read_state(spark, base, "processed_log").count()

    write(inbox, "a.csv", HEAD + ROW + HELD)
    assert take("c1") == 2
    write(inbox, "b.csv", "client name,progress note\nPetra Holt,Rang 0437 218 906.\n")
    assert take("c1") == 3 and take("c1") == 3
    assert take("c2") == 3                                  # a new checkpoint takes no note twice
    write(inbox, "2025-01-15-PART-009.txt", "Quiet day.\nAnd a long one.\n\nEnd")      # lines are one note
    assert take("c3", "txt") == 4
    outputs = spark.read.parquet(f"{base}/outputs").select("note_id", "body").collect()
    assert len(outputs) == 4 and len({r.note_id for r in outputs}) == 4
    assert any(r.body.endswith("Rang [PHONE].") for r in outputs) and not any("Petra" in r.body for r in outputs)
    ledger = read_state(spark, base, "run_ledger").collect()
    assert sum(r["Notes Processed"] + r["Notes Quarantined"] for r in ledger) == 4


def test_stream_alerts_and_archives(spark, tmp_path):
    inbox, base, archive = (str(tmp_path / n) for n in ("in", "state", "archive"))

    def take(day):
        incremental_folder(spark, inbox, base, str(tmp_path / "checkpoint"), day, archive=archive).awaitTermination()
        return read_state(spark, base, "processed_log").count()

    write(inbox, "a.csv", HEAD + ROW)
    write(inbox, "b.csv", HEAD)
    write(inbox, "c.csv", HEAD + "16/01/2025,Ivo,Lund,Tomorrow.,\n")
    assert take("2025-01-15") == 1
    assert os.listdir(inbox) == ["c.csv"] and sorted(os.listdir(f"{archive}/2025-01-15")) == ["a.csv", "b.csv"]
    assert {r.src_file for r in spark.read.parquet(f"{base}/reports/alerts").collect()} == {"b.csv", "c.csv"}
    assert take("2025-01-16") == 2 and os.listdir(inbox) == []           # the stream gave the file before
    write(inbox, "d.csv", HEAD + "16/01/2025,Ivo,Lund,More.,\n")
    assert take("2025-01-16") == 3 and os.listdir(inbox) == []


def test_header_only_files_are_counted(spark, tmp_path):
    write(tmp_path, "a.csv", HEAD + ROW)
    write(tmp_path, "b.csv", HEAD)
    rows, files = scan_notes_csv(spark, str(tmp_path)), csv_files(spark, str(tmp_path))
    assert {r.src_file: r.note_rows for r in count_note_rows(rows, files).collect()} == {"a.csv": 1, "b.csv": 0}
    assert {r.src_file: r.alert for r in no_match_alert(rows, "2025-01-15", files).collect()} == {"a.csv": False, "b.csv": True}


def test_published_ledger_of_no_runs(spark, tmp_path):
    publish_ledger(spark, str(tmp_path / "none"), str(tmp_path / "copy"))
    publish_ledger(spark, str(tmp_path / "none"), str(tmp_path / "copy"))
    assert os.listdir(tmp_path) == ["copy"]
    append_state(spark.range(0).select(F.lit("x").alias("note_id"), F.current_timestamp().alias("processed_at"), F.lit("").alias("output_path"),
                                       F.lit("").alias("status"), F.lit("").alias("ref_code")), str(tmp_path / "s"), "processed_log", "r")
    assert read_state(spark, str(tmp_path / "s"), "processed_log").isEmpty()


def test_quoted_lists_escape_white_space(spark):
    values = sorted(f"0437{gap}218" for gap in (" ", "\t", "\n", "\x0b", "\x1c", "\x85", "\xa0", "\u1680", "\u2003", "\u2028", "\u3000"))
    shown = spark.range(1).select(py_quoted_list(F.array(*map(F.lit, values)))).first()[0]
    assert shown == repr(values)
