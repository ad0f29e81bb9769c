"""Nothing is lost, passed over or shown: repeated runs, notes without id, unreadable state, odd line ends."""
import pytest

from veilnote.operators.deidentify import deidentify
from veilnote.operators.stats import report_quarantined
from veilnote.sources.outputs import route_outputs
from veilnote.sources.state import init_state, read_state

COLS = ["ref_code", "first_name", "last_name", "ndis_number", "date_of_birth", "address", "phone", "email"]


def test_outputs_of_a_run_id_are_kept(spark, tmp_path):
    for note in ("n1", "n2"):
        rows = spark.createDataFrame([(note, "pending", "body")], "note_id string, disposition string, body string")
        route_outputs(rows, str(tmp_path), "same")
    assert {r.note_id for r in spark.read.parquet(f"{tmp_path}/outputs/run_id=same").collect()} == {"n1", "n2"}


def test_unreadable_state_is_an_error(spark, tmp_path):
    assert read_state(spark, str(tmp_path / "none"), "registry").isEmpty()
    init_state(spark, str(tmp_path))
    (tmp_path / "registry" / "run_id=bad").mkdir()
    (tmp_path / "registry" / "run_id=bad" / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        read_state(spark, str(tmp_path), "registry").collect()


def test_mask_spans_line_ends(spark):
    rows = spark.createDataFrame([("n", "c", True, "Residual phone numbers in output: ['04\u2028123']")], "note_id string, ref_code string, is_quarantined boolean, quarantine_reason string")
    assert report_quarantined(rows).select("reason").first()[0] == "Residual phone numbers in output: [masked]"


def test_notes_without_id_are_redacted(spark):
    people = spark.createDataFrame([("C-1", "Petra", "Holt", "", "", "", "", ""), ("C-2", "Ivo", "Lund", "", "", "", "", "")], ", ".join(f"{c} string" for c in COLS))
    notes = spark.createDataFrame([(None, "Petra Holt came."), (None, "Ivo Lund left."), (3, "Nobody was in.")], "note_id long, note string")
    got = {r.deidentified_text for r in deidentify(notes, people).collect()}
    assert got == {"C-1 came.", "C-2 left.", "Nobody was in."}
