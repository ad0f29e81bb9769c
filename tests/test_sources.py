import os
import random
import re

import pytest
from pyspark.sql import functions as F

from veilnote import fixed_values
from veilnote.functions.names import name_variations, surface_ok, strip_title
from veilnote.functions.detectors import (
    detect_addresses, detect_dob, detect_emails, detect_ndis, detect_phones, detect_states, detect_suburb_postcode)
from veilnote.functions.keys import client_key, parse_note_date
from veilnote.functions.spans import literal_spans, merge_spans, make_span
from veilnote.functions.values import dob_variants, street_part
from veilnote.operators.codes import assign_codes
from veilnote.operators.selection import dedup_notes, id_collisions
from veilnote.plans.daily_run import Run, daily_run
from veilnote.sources import note_files
from veilnote.sources.note_files import choose_source_mode, file_inventory, notes_from_files, scan_note_files, skipped_files
from veilnote.sources.notes_csv import (
    WIDTH, count_note_rows, header_spots, header_width, no_match_alert, notes_from_rows, resolve_columns, scan_notes_csv)
from veilnote.sources.pii_dictionary import scan_pii_dictionary
from veilnote.sources.state import read_state


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "t string").select(column(F.col("t"))).first()[0]


@pytest.mark.parametrize("column,text,expected", [
    (detect_ndis, "number 518340276 given", ["518340276"]), (detect_ndis, "order 5183402761", []),
    (detect_phones, "rang 0437 218 906 twice", ["0437 218 906"]), (detect_phones, "desk (07) 3811 2065", ["07) 3811 2065"]),
    (detect_emails, "to petra.holt@example.org now", ["petra.holt@example.org"]),
    (detect_addresses, "17 Harbour Street and 9 Main Strand", ["17 Harbour Street", "9 Main St"]),
    (detect_suburb_postcode, "Box Hill, VIC 3128", ["Box Hill", "3128"]), (detect_suburb_postcode, "City, 3000", ["3000"]),
    (detect_suburb_postcode, "Box Hill, 2024", []), (detect_suburb_postcode, "Melbourne VIC 3000", []),
    (name_variations, "Petronella", ["Petronella", "Petronella's"]), (name_variations, "  ", []), (name_variations, "Dr Al", []),
    (strip_title, "Dr Mr X", "Mr X"), (strip_title, "Drew Smith", "Drew Smith"), (client_key, "Jane Smith", "csv_ef6efb88"),
    (street_part, "42 Forest Road", "42 Forest"), (street_part, "42 Andrew Street", "42 Andr"),
    (street_part, "42 Stanley Road", "42 Stanley Road"), (dob_variants, "15/03/1985", []), (dob_variants, "", []),
    (dob_variants, "1985-03-15", ["15/03/1985", "15/03/85", "03/15/1985", "15-03-1985", "15-03-85", "03-15-1985",
                                  "15.03.1985", "15.03.85", "03.15.1985"]),
    (surface_ok, "Worker", False), (surface_ok, "Worker's", True), (surface_ok, "Al", False), (surface_ok, "May", False),
])
def test_column_functions(spark, column, text, expected):
    assert one(spark, text, column) == expected


def test_name_variations_contents(spark):
    assert {"Petra Holt", "Petra", "Holt"} <= set(one(spark, "Petra Holt", name_variations))
    titled = one(spark, "Dr. Ivo Lund", name_variations)
    assert "Ivo Lund" in titled and "Dr." not in titled
    assert "Mike" in one(spark, "Michael Quill", name_variations)
    assert "Elizabeth" in one(spark, "Liz Ng", name_variations)


def test_dates(spark):
    cells = ["15/01/2025", "5/1/2025", "2025-01-15", "15/01/25", "01/15/2025", "15/01/70", "20250115", "junk", ""]
    got = [str(one(spark, c, parse_note_date)) for c in cells]
    assert got == ["2025-01-15", "2025-01-05", "2025-01-15", "2025-01-15", "2025-01-15", "1970-01-15", "2025-01-15", "None", "None"]


@pytest.mark.parametrize("spans,expected", [
    ([(0, 10, "LOCATION"), (5, 20, "EMAIL"), (25, 30, "PHONE")], [(5, 20, "EMAIL"), (25, 30, "PHONE")]),
    ([(0, 9, "NDIS"), (4, 12, "PHONE")], [(0, 12, "NDIS")]),
    ([(0, 9, "NDIS"), (9, 12, "PHONE")], [(0, 9, "NDIS"), (9, 12, "PHONE")]),
    ([(0, 10, "EMAIL"), (8, 15, "LOCATION")], [(0, 10, "EMAIL")]),
])
def test_merge_spans(spark, spans, expected):
    column = merge_spans(F.array(*[make_span(F.lit(s), F.lit(e), label) for s, e, label in spans]))
    got = spark.range(1).select(column).first()[0]
    assert [(s.start, -s.neg_end, s.label) for s in got] == expected


def test_literal_spans_count_characters(spark):
    row = spark.range(1).select(
        literal_spans(F.lit("430123456 é 9430123456ab"), F.lit("430123456"), F.lit("430123456"), "NDIS")).first()[0]
    assert [(s.start, -s.neg_end) for s in row] == [(0, 9), (13, 22)]


def test_resolve_columns():
    got = resolve_columns(["dob", "NOTE", "Progress Note", "Client Name", "x"])
    assert (got["note"], got["dob"], got["full_name"], got["date"]) == (1, 0, 3, None)
    assert resolve_columns(["Text"], {"note": ("Text",)})["note"] == 0


def write(path, name, text):
    with open(os.path.join(path, name), "w", encoding="utf-8") as fh:
        fh.write(text)


CSV = ("Date,First Name,Last Name,Note,Support Worker,NDIS Number,Date of Birth\n"
       "15/01/2025,Petra,Holt,Petra planted beans and watered the herbs.,Mara Quill,518340276,24/10/1968\n")


def test_scan_mixed_layouts(spark, tmp_path):
    write(tmp_path, "a.csv", "﻿" + CSV + '14/01/2025,Ivo,Lund,"said ""hi"",\nthen left",,,\n,Al\n')
    write(tmp_path, "b.csv", "client name,progress note\nPetra Holt,Met Ivo.\n,Alone.\n")
    rows = scan_notes_csv(spark, str(tmp_path)).orderBy("src_file", "src_row").collect()
    assert [r.note for r in rows] == ["Petra planted beans and watered the herbs.",
                                      'said "hi",\nthen left', "", "Met Ivo.", "Alone."]
    assert [r.src_file for r in rows] == ["a.csv"] * 3 + ["b.csv"] * 2
    notes = notes_from_rows(scan_notes_csv(spark, str(tmp_path)), "2025-01-15").orderBy("src_file", "src_row").collect()
    assert [(n.first_name, n.last_name) for n in notes] == [("Petra", "Holt"), ("Petra", "Holt"), ("", "")]
    scanned = scan_notes_csv(spark, str(tmp_path))
    assert {r.src_file: r.note_rows for r in count_note_rows(scanned).collect()} == {"a.csv": 2, "b.csv": 2}
    assert {r.src_file: r.alert for r in no_match_alert(scanned, "2030-01-01").collect()} == {"a.csv": False, "b.csv": False}


def test_folders_inside_are_not_read(spark, tmp_path):
    os.mkdir(tmp_path / "archive")
    for folder in (tmp_path, tmp_path / "archive"):
        write(folder, "a.csv", "client name,progress note\nIvo Lund,Walked.\n")
        write(folder, "2025-01-15-PART-001.txt", "Walked.")
    assert scan_notes_csv(spark, str(tmp_path)).count() == 1
    assert scan_note_files(spark, str(tmp_path)).count() == 1
    assert sorted(r.file_name for r in file_inventory(spark, str(tmp_path)).collect()) == ["2025-01-15-PART-001.txt", "a.csv"]


def test_pipeline_run_twice(spark, tmp_path):
    os.mkdir(tmp_path / "in")
    write(tmp_path / "in", "notes.csv", CSV + "15/01/2025,Ivo,Lund,Ref +61412345678901234567 with Petra,,,\n"
          + "15/01/2025,Ivo,Lund,Ref +61412345678901234567 with Petra,,,\n")
    base = str(tmp_path / "state")
    first = daily_run(spark, str(tmp_path / "in"), Run(base, "r1", "2025-01-15", "notes.csv")).first().asDict()
    assert first == {"total": 3, "uploaded": 1, "quarantined": 1, "skipped": 1, "errors": 0}
    second = daily_run(spark, str(tmp_path / "in"), Run(base, "r2", "2025-01-15")).first().asDict()
    assert second == {"total": 3, "uploaded": 0, "quarantined": 0, "skipped": 3, "errors": 0}
    codes = {r.full_name: r.ref_code for r in read_state(spark, base, "registry").collect()}
    assert codes == {"Petra Holt": "PART-001", "Ivo Lund": "PART-002"}
    assert read_state(spark, base, "processed_log").count() == 2
    assert read_state(spark, base, "run_ledger").count() == 2
    out = spark.read.parquet(f"{base}/outputs/run_id=r1").orderBy("disposition").collect()
    assert out[1].body.endswith("[PHONE]901234567 with PART-001") and out[1].output_path.endswith("_QUARANTINE.txt")
    assert out[0].body.startswith("Reference: PART-001\nDate: 2025-01-15\nSubstitutions: {'NAME→PART-001': 1}\n\n---")


def test_documents_come_first(spark, tmp_path):
    write(tmp_path, "2025-01-15-part-7.txt", "Call 0437 218 906.")
    write(tmp_path, "2025-02-31-PART-8.txt", "bad day")
    write(tmp_path, "2025-01-15-PART-9.txt", " \n")
    write(tmp_path, "other.txt", "x")
    write(tmp_path, "notes.csv", CSV)
    files = scan_note_files(spark, str(tmp_path))
    assert [(r.ref_code, r.created_at, r.note) for r in notes_from_files(files).collect()] == [
        ("PART-7", "2025-01-15", "Call 0437 218 906.")]
    assert skipped_files(files).first().asDict() == {"total": 4, "usable": 1, "skipped": 3}
    assert choose_source_mode(files, files)[0] == "documents"
    assert file_inventory(spark, str(tmp_path)).count() == 5
    stats = daily_run(spark, str(tmp_path), Run(str(tmp_path) + "-state", "r1", "2025-01-16")).first()
    assert (stats.total, stats.uploaded) == (1, 1)


def test_empty_folder(spark, tmp_path):
    os.mkdir(tmp_path / "in")
    write(tmp_path / "in", "readme.md", "x")
    assert daily_run(spark, str(tmp_path / "in"), Run(str(tmp_path / "s"), "r1", "2025-01-15")) is None


def test_dictionary_is_optional(spark, tmp_path):
    write(tmp_path, "d.csv", " Type ,Name\nCarer,Beatrix Lund\nCarer,\nOther,X\nLocation, Box Hill \n")
    got = {(r.type, r.surface) for r in scan_pii_dictionary(spark, str(tmp_path / "d.csv")).collect()}
    assert ("Location", "Box Hill") in got and ("Carer", "Beatrix") in got and len(got) == 7
    write(tmp_path, "bad.csv", "Kind,Name\nCarer,X\n")
    for path in (None, str(tmp_path / "absent.csv"), str(tmp_path / "bad.csv")):
        assert scan_pii_dictionary(spark, path).count() == 0


def test_codes(spark):
    notes = spark.createDataFrame([("f", 1, "B"), ("f", 2, "A"), ("f", 3, "B"), ("e", 9, "K")], "src_file string, src_row long, client_id string")
    known = spark.createDataFrame([("K", "PART-001"), ("L", "PART-002")], "client_id string, ref_code string")
    got = {r.client_id: r.ref_code for r in assign_codes(notes, known).collect()}
    assert got == {"B": "PART-003", "A": "PART-004"}
    many = spark.range(999).select(F.format_string("c%d", "id").alias("client_id"), F.format_string("PART-%03d", F.col("id") + 1).alias("ref_code"))
    assert {r.ref_code for r in assign_codes(notes.where("client_id = 'A'"), many).collect()} == {"PART-1000"}


def test_code_blocks_rank_like_one_sort(spark, monkeypatch):
    from veilnote.operators import codes
    monkeypatch.setattr(codes, "BLOCK", 16)
    notes = spark.range(500).select(F.lit("f").alias("src_file"), F.col("id").alias("src_row"), (F.col("id") * 7 % 101).cast("string").alias("client_id"))
    got = {r.client_id: r.pos for r in codes.assign_codes(notes, spark.createDataFrame([], "client_id string, ref_code string")).collect()}
    order = []
    for i in range(500):
        c = str(i * 7 % 101)
        if c not in order:
            order.append(c)
    assert got == {c: i + 1 for i, c in enumerate(order)}


def test_offsets_of_many_files(spark):
    """Running sums over 100,000 files, dealt by range, equal those of one sort."""
    from veilnote.operators.codes import running_offsets
    sizes = spark.range(100_000).select(F.format_string("f%06d", F.col("id") * 7919 % 100_000).alias("src_file"), F.lit(0).cast("long").alias("block"),
                                        (F.col("id") % 5).alias("n"))
    got = {r.src_file: r.offset for r in running_offsets(sizes, "src_file", "block").collect()}
    total = 0
    for name, n in sorted((f"f{i * 7919 % 100_000:06d}", i % 5) for i in range(100_000)):
        assert got[name] == total
        total += n
    assert running_offsets(sizes.limit(0), "src_file", "block").isEmpty()


def test_copies_leave_the_first(spark):
    notes = spark.range(300).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") != 1, F.col("id").cast("string")).alias("note_id"),
        F.lit("f").alias("src_file"), (299 - F.col("id")).alias("src_row"), F.col("id").cast("string").alias("note"))
    kept = dedup_notes(notes)
    assert kept.count() == 200 and kept.where("note_id = 'hot'").first().src_row == 2 and kept.columns == notes.columns
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"\bAggregate\b", plan)) == 1 and "LeftSemi" in plan
    assert id_collisions(notes).count() == 1


def test_many_layouts_are_one_plan(spark, tmp_path):
    names = ("note", "Progress Note", "NOTES", "case note")
    for k in range(500):
        extra = [f"x{k}_{j}" for j in range(k % 7)]
        header = [*extra, "client name", names[k % 4], *extra[::-1]]
        row = ["-"] * len(extra) + ["Ivo Lund", f"Walk {k}."] + ["-"] * len(extra)
        write(tmp_path, f"f{k:03d}.csv", ",".join(header) + "\n" + ",".join(row) + "\n")
    scanned = scan_notes_csv(spark, str(tmp_path))
    plan = scanned._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and plan.count("Join") == 1
    assert sorted((r.src_file, r.full_name, r.note) for r in scanned.collect()) == [(f"f{k:03d}.csv", "Ivo Lund", f"Walk {k}.") for k in range(500)]


def test_too_wide_a_header_is_an_error(spark, tmp_path):
    write(tmp_path, "a.csv", ",".join(f"c{k}" for k in range(200)) + "\n" + ",".join(["v"] * 200) + "\n")
    with pytest.raises(Exception, match="too many columns in a.csv"):
        scan_notes_csv(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("header", [["dob", "NOTE", "Progress Note", "Client Name", "x"], ["note", "Note", "NOTE"], ["Date", "date", "DATE", "Notes"], [], [""]])
def test_spots_of_columns_equal_those_in_python(spark, header):
    got = spark.createDataFrame([(header,)], "h array<string>").select(header_spots(F.col("h"))).first()[0].asDict()
    assert got == resolve_columns(header)


def test_documents_are_written_as_files_by_tasks(spark, tmp_path):
    """Spark's own writer starts processes and makes a folder for each file; tasks give a folder of files under their names."""
    rows = [("2025-01-15-PART-001.TXT", "Jane\nsmiled."), ("2025-01-16-part-002.txt", None), (None, "é"), ("_x.txt", "h"), ("same.txt", "a"), ("same.txt", "b")]
    folders = note_files.write_note_files(spark.createDataFrame(rows, "file_name string, text string").coalesce(1), str(tmp_path / "in"))
    assert len(folders) == 1 and len(list(tmp_path.glob("in/*/*.txt"))) == 5
    got = {r.file_name: r.text for r in scan_note_files(spark, folders, note_files.stored_name()).collect()}
    assert got.pop("same.txt") in ("a\nb\n", "b\na\n")
    assert got == {"2025-01-15-PART-001.TXT": "Jane\nsmiled.\n", "2025-01-16-part-002.txt": "\n", None: "é\n", "_x.txt": "h\n"}
    sizes = {r.file_name: r.length for r in file_inventory(spark, folders, note_files.stored_name()).collect()}
    assert sizes == {"2025-01-15-PART-001.TXT": 13, "2025-01-16-part-002.txt": 1, None: 3, "_x.txt": 2, "same.txt": 4}
    none = note_files.write_note_files(spark.createDataFrame([], "file_name string, text string"), str(tmp_path / "none"))
    assert scan_note_files(spark, none, note_files.stored_name()).isEmpty()


def test_local_documents_are_listed_by_tasks(spark, tmp_path):
    """The driver holds no file of a folder; rows are those of Spark's reader, whatever the names, bytes and folders inside."""
    names = [f"2025-01-15-PART-{k:03d}.txt" for k in range(300)] + [
        "a b.txt", "a%20b.txt", "\u00e9#?.txt", "nl\n.txt", "\u00a0[x]{y}.txt", 'q"\\`^|<>.txt', "z\u2028\u200b.txt", "\x85\U0001f600.txt", "~!$&'()*,;=@-_+.txt",
        "_h=1.txt", "_h.txt", ".h.txt", "UP.TXT", "_metadata.txt", "empty.txt", "other.md"]
    for k, name in enumerate(names):
        (tmp_path / str(k % 3)).mkdir(exist_ok=True)
        (tmp_path / str(k % 3) / name).write_bytes(b"" if name == "empty.txt" else f"{k} \u00e9\r\n".encode() + b"\xff\x00")
    (tmp_path / "0" / "archive").mkdir()
    (tmp_path / "0" / "archive" / "old.txt").write_text("old")
    folders = [str(tmp_path / str(k)) for k in range(3)]
    shown = lambda df: sorted(map(tuple, df.selectExpr("file_name", "hex(text)").collect()))
    reader = lambda path: spark.read.option("pathGlobFilter", "*.txt").text(path, wholetext=True).selectExpr("_metadata.file_name", "value AS text")
    for path in (folders, folders[0], "file://" + folders[1], [folders[2]] * 2):
        files = scan_note_files(spark, path)
        assert not [f for f in files.inputFiles() if f.endswith(".txt")] and shown(files) == shown(reader(path))
    assert len(shown(scan_note_files(spark, folders))) == 310
    for path in (f"{folders[0]}/2025*", [f"{folders[0]}/a b.txt", f"{folders[0]}/{names[0]}"]):       # left to Spark's reader
        assert shown(scan_note_files(spark, path)) == shown(reader(path))
    (tmp_path / "1" / "day=3").mkdir()
    (tmp_path / "1" / "day=3" / "in.txt").write_text("in")
    assert shown(scan_note_files(spark, folders[1])) == shown(reader(folders[1]))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        scan_note_files(spark, str(tmp_path / "absent"))


def test_lines_are_read_to_the_width_of_headers(spark, tmp_path):
    """No cell of a header is left out, however it is quoted or cut into buffers, and none beyond all headers is asked for."""
    for width in (1, 2, 7, 40, 127):
        for size in (1, 3, 29):
            folder = tmp_path / f"{width}-{size}"
            folder.mkdir()
            cells = ["Date"] + [f"{'x' * size}{k}" for k in range(width - 2)] + ["Note"] * (width > 1)
            (folder / "a.csv").write_text("\n" * (size == 3) + ",".join(cells) + "\n15/01/2025" + ",c" * (width + 3) + "\n", newline="")
            assert header_width(spark, str(folder)) == (width if width > 1 else WIDTH)
            row = scan_notes_csv(spark, str(folder)).first()
            assert (row.date, row.note, row.has_note) == ("15/01/2025", "c" * (width > 1), width > 1)
    quoted = tmp_path / "quoted"
    quoted.mkdir()
    (quoted / "a.csv").write_text('"Service, old",",","x\ny, ""z""",Date,Note\n1,2,3,4,"5,\n6"\n')
    (quoted / "b.csv").write_text("Note,Date\n7,8\n")
    (quoted / "none.csv").write_text("")
    assert 5 <= header_width(spark, str(quoted)) < 16
    assert {(r.date, r.note) for r in scan_notes_csv(spark, str(quoted)).collect()} == {("4", "5,\n6"), ("8", "7")}


def test_guards_let_every_match_through(spark):
    """Detectors with their guard give what their patterns alone give."""
    rng = random.Random(5)
    bits = ["0", "4", "12", "\u0663", "2000", "518340276", "+61", "(", ")", "-", "/", ".", " ", " ", "\n", "\u00a0", ",", ":", "DOB", "Born", "d.o.b.",
            "Box", "Hill", "VIC", "New South Wales", "Main", "Street", "Dr", "x", "\u00e9", "@", "a.b", "com"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(2, 16))) for _ in range(6000)]
    texts += [f"{k} Main{s}Street, VIC{s}3128 DOB{s}1{c}2{c}1980" for k in ("7", "7/", "7-1") for s in (" ", "\n", "\u00a0") for c in "/.-"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    alone = {"ndis": [("(?U)" + fixed_values.NDIS_PATTERN, 0)], "phones": [("(?U)" + p, 0) for p in fixed_values.PHONE_PATTERNS],
             "dob": [("(?iuU)" + fixed_values.DOB_PATTERN, 0)], "addresses": [("(?U)" + fixed_values.ADDRESS_PATTERN, 0)],
             "suburb_postcode": [("(?U)" + fixed_values.SUBURB_POSTCODE_PATTERN, 0)],
             "states": [(r"(?U)\b(?:" + "|".join(fixed_values.STATES) + r")\b", 0)]}
    found = lambda name: F.array_distinct(F.concat(*[F.regexp_extract_all(F.col("t"), F.lit(p), F.lit(g)) for p, g in alone[name]]))
    out = rows.select(*[f(F.col("t")).alias(name) for name, f in (
        ("ndis", detect_ndis), ("phones", detect_phones), ("dob", detect_dob), ("addresses", detect_addresses), ("states", detect_states),
        ("suburb_postcode", detect_suburb_postcode))], *[found(name).alias(f"{name}_alone") for name in alone]).collect()
    for name in ("ndis", "phones", "dob"):
        assert all(r[name] == r[f"{name}_alone"] for r in out) and any(r[name] for r in out)
    for r in out:
        assert set(r.states) == set(r.states_alone)
        assert set(r.addresses) == {a for a in r.addresses_alone if not any(w in a.lower() for w in fixed_values.ADDRESS_STOP_WORDS)}
        kept = [p for p in r.suburb_postcode_alone if 200 <= int(p[-4:]) <= 9999 and not 2020 <= int(p[-4:]) <= 2030]
        assert bool(kept) == bool(r.suburb_postcode)
    assert all(any(r[name] for r in out) for name in alone)
