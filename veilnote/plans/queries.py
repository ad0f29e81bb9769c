"""Registered queries: every operator on whole tables, with comparison SQL."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import detectors as det, keys, names, render, spans, text as tx, values, verify
from ..operators import (
    codes, deidentify as d, manifest, matching as m, rosters, selection as sel, stats as st, surfaces as sf,
)
from ..operators.known_values import known_value_steps
from ..session import Staging, cut_lineage, exists, folder_of, move, scratch_path, written
from ..streaming import incremental
from ..sources import api_pages, note_files, notes_csv, outputs, pii_dictionary, state
from ..fixed_values import CLEAN_MARKER, LEDGER_ERROR_SUFFIX, QUARANTINE_BANNER, QUARANTINE_MARKER
from . import bindings as b, daily_run as daily, oracle as o
from .bindings import TARGET_DATE, with_sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
OUT_COLUMNS = "note_id, text, counts"


def query(name: str, sql: str | None = None):
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return add


def joined(c: Column) -> Column:
    return F.array_join(F.array_sort(c), "|")


def counts_text(counts: Column) -> Column:
    return F.array_join(F.array_sort(F.transform(counts, lambda c: F.concat(
        c["label"], F.lit("="), c["n"].cast("string")))), ";")


def shown(work: DataFrame) -> DataFrame:
    return work.select("note_id", "text", counts_text(verify.total_hits(F.col("hits"))).alias("counts"))


def surfaces_of(spark, sf_dir) -> DataFrame:
    return sf.dictionary_surfaces(b.dictionary(spark, sf_dir))


# --- scans -------------------------------------------------------------------

def exports(spark: SparkSession, sf_dir: str) -> str:
    """Write the export rows as CSV files in three layouts to the shared folder."""
    path = scratch_path(spark, "exports")
    rows = b.rows(spark, sf_dir).withColumn("note", F.replace("note", F.lit("two boards"), F.lit('two "boards",\nand more')))
    layouts = {
        "f0": [("date", "Date"), ("first_name", "First Name"), ("last_name", "Last Name"), ("note", "Note"),
               ("staff", "Support Worker"), ("ndis", "NDIS Number"), ("dob", "Date of Birth")],
        "f1": [("dob", "DOB"), ("date", "Service Date"), ("full_name", "Client Name"), ("note", "Progress Note"),
               ("staff", "Staff"), ("ndis", "NDIS No.")],
        "f2": [("full_name", "client name"), ("date", "date"), ("note", "note")],
    }
    for name, columns in layouts.items():
        rows.where(F.col("src_file") == name).select(*[F.col(c).alias(h) for c, h in columns]).write.options(
            header="true", quote='"', escape='"', ignoreLeadingWhiteSpace="false",
            ignoreTrailingWhiteSpace="false").csv(f"{path}/{name}")
    return f"{path}/*"


@query("scan_notes_csv", with_sql("""
    SELECT date, first_name, last_name, full_name, staff, ndis, dob, src_file <> 'f0' AS has_full_name,
           replace(note, 'two boards', 'two "boards",' || chr(10) || 'and more') AS note FROM fx_rows""", "rows"))
def _(spark, sf_dir):
    return notes_csv.scan_notes_csv(spark, exports(spark, sf_dir)).drop("src_file", "src_row", "has_note")


@query("resolve_columns", with_sql("""
    SELECT date, full_name, note, '' AS first_name, '' AS last_name, staff, '' AS ndis, '' AS dob FROM fx_rows""", "rows"))
def _(spark, sf_dir):
    raw = b.rows(spark, sf_dir).select("note", "date", "full_name", "staff")
    headers = ["CASE NOTE", "start date", "Client Name", "Worker"]
    return notes_csv.logical_rows(raw, headers).select(
        "date", "full_name", "note", "first_name", "last_name", "staff", "ndis", "dob")


def note_file_rows(spark, sf_dir) -> DataFrame:
    """Documents as files: some names and bodies are unusable."""
    k = F.col("doc_id")
    name = F.when(k % 10 == 9, F.format_string("report-%d.txt", k)).when(
        k % 10 == 8, F.format_string("2025-02-31-PART-%d.txt", k)).otherwise(
        F.concat(F.format_string("2025-01-%02d-part-", k % 28 + 1), F.format_string("%03d.TXT", k)))
    return b.table(spark, sf_dir, "documents").select(
        name.alias("file_name"), F.when(k % 10 == 7, " \n").otherwise(F.col("text")).alias("text"))


def note_folders(spark, sf_dir) -> list[str]:
    """One file for each document, under its name, in a folder of each task."""
    return note_files.write_note_files(note_file_rows(spark, sf_dir), scratch_path(spark, "documents"))


_NAME = """CASE WHEN doc_id % 10 = 9 THEN 'report-' || doc_id || '.txt' WHEN doc_id % 10 = 8 THEN '2025-02-31-PART-' || doc_id || '.txt'
    ELSE '2025-01-' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') || '-part-' || printf('%03d', doc_id) || '.TXT' END"""
_BODY = r"CASE WHEN doc_id % 10 = 7 THEN ' ' || chr(10) ELSE text END || chr(10)"


@query("scan_note_files", f"""
    SELECT '2025-01-' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') || '-part-' || printf('%03d', doc_id) AS note_id,
           'PART-' || printf('%03d', doc_id) AS ref_code, {_BODY} AS note,
           '2025-01-' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') AS created_at
    FROM documents WHERE doc_id % 10 < 7 AND trim(text) <> ''""")
def _(spark, sf_dir):
    """Every document as a file of its own, scanned whole (Spark ends a text with a line break)."""
    return note_files.notes_from_files(note_files.scan_note_files(spark, note_folders(spark, sf_dir), note_files.stored_name()))


@query("join_document_pages", """
    SELECT conv_id, string_agg(text, chr(10) ORDER BY turn, text) AS text FROM conversations
    WHERE coalesce(text, '') <> '' GROUP BY conv_id""")
def _(spark, sf_dir):
    return note_files.join_document_pages(b.table(spark, sf_dir, "conversations"), "conv_id", "turn", "text")


@query("choose_source_mode", "SELECT 'documents' AS mode, 'd' || doc_id AS note_id, text AS note FROM documents")
def _(spark, sf_dir):
    mode, chosen = note_files.choose_source_mode(
        b.documents(spark, sf_dir), b.notes(spark, sf_dir).select("note_id", "note"))
    return chosen.withColumn("mode", F.lit(mode))


@query("scan_pii_dictionary", with_sql(f"WITH {o.SURFACES} SELECT type, surface FROM surf", "dictionary"))
def _(spark, sf_dir):
    path = scratch_path(spark, "dictionary")
    b.dictionary(spark, sf_dir).select(F.col("type").alias("Type"), F.col("name").alias(" Name ")).write.option(
        "header", "true").option("escape", '"').csv(path)
    return pii_dictionary.scan_pii_dictionary(spark, path)


@query("optional_source", with_sql("SELECT note_id, note, CAST(0 AS BIGINT) AS surfaces FROM fx_notes", "notes"))
def _(spark, sf_dir):
    gone = pii_dictionary.scan_pii_dictionary(spark, scratch_path(spark, "absent"))
    count = gone.agg(F.count("*")).scalar()
    return b.notes(spark, sf_dir).select("note_id", "note", count.alias("surfaces"))


def registry_rows(spark, sf_dir) -> DataFrame:
    """Positional registry cells: blanks, short rows, and later rows for some clients."""
    r = b.roster(spark, sf_dir)
    k = F.col("k")
    name = F.concat_ws(" ", "first_name", F.lit("Q"), "last_name")
    first = r.select(
        k.alias("row"), F.when(k % 50 == 0, " ").otherwise(F.col("ref_code")).alias("a"), F.col("client_id").alias("b"),
        F.when(k % 7 > 0, name).alias("c"), F.when(k % 7 > 1, F.col("ndis_number")).alias("d"),
        F.when(k % 7 > 2, F.col("date_of_birth")).alias("e"), F.when(k % 7 > 3, F.col("address")).alias("f"),
        F.lit(None).cast("string").alias("g"))
    later = r.join(b.table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "BUILDING"),
                   k == F.col("c_custkey"), "left_semi").select(
        (k + 1_000_000_000).alias("row"), F.concat(F.lit(" "), "ref_code").alias("a"), F.col("client_id").alias("b"),
        F.col("last_name").alias("c"), F.lit("").alias("d"), F.lit("").alias("e"), F.lit("").alias("f"), F.lit("").alias("g"))
    return first.unionByName(later)


@query("scan_registry", with_sql("""
    WITH late AS (SELECT c_custkey AS k FROM customer WHERE c_mktsegment = 'BUILDING'),
    early AS (SELECT * FROM fx_roster WHERE k NOT IN (SELECT k FROM late) AND k % 50 <> 0)
    SELECT client_id, ref_code, last_name AS full_name, '' AS ndis_number, '' AS date_of_birth, '' AS address,
           last_name AS first_name, '' AS last_name FROM fx_roster WHERE k IN (SELECT k FROM late)
    UNION ALL
    SELECT client_id, ref_code, CASE WHEN k % 7 > 0 THEN first_name || ' Q ' || last_name ELSE '' END,
           CASE WHEN k % 7 > 1 THEN ndis_number ELSE '' END, CASE WHEN k % 7 > 2 THEN date_of_birth ELSE '' END,
           CASE WHEN k % 7 > 3 THEN address ELSE '' END, CASE WHEN k % 7 > 0 THEN first_name ELSE '' END,
           CASE WHEN k % 7 > 0 THEN last_name ELSE '' END FROM early""", "roster"))
def _(spark, sf_dir):
    return state.scan_registry(registry_rows(spark, sf_dir)).drop("date_first_assigned")


def log_of(spark, sf_dir) -> DataFrame:
    """Processed log of the notes: those of finished orders, padded and doubled."""
    done = b.notes(spark, sf_dir).where(F.col("status") == "F")
    return done.select(F.concat(F.lit(" "), "note_id", F.lit("\t")).alias("note_id")).unionByName(done.select("note_id"))


@query("scan_processed_log", "SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS note_id FROM orders WHERE o_orderstatus = 'F'")
def _(spark, sf_dir):
    return state.scan_processed_log(log_of(spark, sf_dir))


ITEM = "struct<id:bigint,day:string,kind:string,value:double>"


def landed_pages(spark, sf_dir, entity: str, id_column: str) -> DataFrame:
    """Events as JSON pages of one hundred items."""
    e = b.table(spark, sf_dir, "events")
    item = F.struct(F.col(id_column).alias("id"), F.date_format("ts", "yyyy-MM-dd").alias("day"),
                    F.col("event_type").alias("kind"), "value")
    total = e.agg(F.count("*")).scalar()
    pages = e.groupBy(F.floor(F.col("event_id") / 100).alias("page")).agg(
        F.array_sort(F.collect_list(F.struct("event_id", item.alias("item")))).alias("items"))
    meta = F.struct(total.alias("total_count"), F.lit(100).alias("per_page"), (F.col("page") + 1).alias("current_page"))
    payload = F.struct(F.transform("items", lambda x: x["item"]).alias(entity), meta.alias("meta"))
    return pages.select(
        F.lit(entity).alias("entity"), "page", F.to_json(payload).alias("payload"))


@query("explode_api_pages", """
    SELECT user_id AS id, arg_max(strftime(ts, '%Y-%m-%d'), event_id) AS day, arg_max(event_type, event_id) AS kind,
           arg_max(value, event_id) AS value FROM events GROUP BY user_id""")
def _(spark, sf_dir):
    parsed = api_pages.parse_pages(landed_pages(spark, sf_dir, "clients", "user_id"), "clients", ITEM)
    return api_pages.last_by_id(api_pages.explode_api_pages(parsed))


@query("page_completeness", """
    SELECT count(DISTINCT event_id // 100) AS pages, count(*) AS items, count(*) AS total_count,
           (max(event_id // 100) + 1) * 100 >= count(*) AS complete FROM events""")
def _(spark, sf_dir):
    return api_pages.page_completeness(
        api_pages.parse_pages(landed_pages(spark, sf_dir, "service_notes", "event_id"), "service_notes", ITEM))


@query("date_range_filter", """
    SELECT event_id AS id, strftime(ts, '%Y-%m-%d') AS day, event_type AS kind, value FROM events
    WHERE strftime(ts, '%Y-%m-%d') BETWEEN '2024-01-05' AND '2024-01-09'""")
def _(spark, sf_dir):
    items = api_pages.explode_api_pages(api_pages.parse_pages(
        landed_pages(spark, sf_dir, "service_notes", "event_id"), "service_notes", ITEM))
    return api_pages.date_range_filter(items, "day", "2024-01-05", "2024-01-09").drop("page", "pos")


@query("count_note_rows", with_sql("SELECT src_file, count(*) FILTER (note <> '') AS note_rows FROM fx_rows GROUP BY 1", "rows"))
def _(spark, sf_dir):
    return notes_csv.count_note_rows(b.rows(spark, sf_dir))


def inventory(spark, sf_dir) -> DataFrame:
    """File names of exported documents: one per finished order."""
    return b.notes(spark, sf_dir).where(F.col("status") == "F").select(
        "ref_code", F.col("created_at").alias("run_date"),
        F.concat("created_at", F.lit("-"), "ref_code", F.lit(".pdf")).alias("file_name"))


@query("file_inventory", f"""
    SELECT {_NAME} AS file_name, CAST(strlen({_BODY}) AS BIGINT) AS length, doc_id % 10 = 8 AS of_day FROM documents""")
def _(spark, sf_dir):
    files = note_files.file_inventory(spark, note_folders(spark, sf_dir), note_files.stored_name())
    day = note_files.files_of_date(files, F.lit("2025-02-31"), "txt").select("file_name", F.lit(True).alias("of_day"))
    return files.join(day, "file_name", "left").select("file_name", "length", F.coalesce("of_day", F.lit(False)).alias("of_day"))


# --- projections and filters -------------------------------------------------

@query("parse_note_date", with_sql(
    f"SELECT src_row, date, strftime({o.date_sql('date')}, '%Y-%m-%d') AS parsed FROM fx_rows", "rows"))
def _(spark, sf_dir):
    return b.rows(spark, sf_dir).select(
        "src_row", "date", F.date_format(keys.parse_note_date(F.col("date")), "yyyy-MM-dd").alias("parsed"))


@query("filter_target_date", with_sql(f"SELECT src_row, date FROM fx_rows WHERE {o.PASSES}", "rows"))
def _(spark, sf_dir):
    return b.rows(spark, sf_dir).where(notes_csv.date_ok(TARGET_DATE)).select("src_row", "date")


@query("no_match_alert", with_sql(f"""
    SELECT src_file, count(*) FILTER ({o.PASSES}) AS matched_rows, count(*) FILTER ({o.PASSES}) = 0 AS alert
    FROM fx_rows GROUP BY src_file""", "rows"))
def _(spark, sf_dir):
    return notes_csv.no_match_alert(b.rows(spark, sf_dir), TARGET_DATE)


@query("drop_blank_notes", with_sql("SELECT note_id, note FROM fx_notes WHERE trim(note) <> ''", "notes"))
def _(spark, sf_dir):
    return sel.drop_blank_notes(b.notes(spark, sf_dir)).select("note_id", "note")


_FIRST = "CASE WHEN first_name = '' AND last_name = '' THEN split_part(full_name, ' ', 1) ELSE first_name END"
_LAST = """CASE WHEN first_name = '' AND last_name = '' THEN
    CASE WHEN contains(full_name, ' ') THEN full_name[strpos(full_name, ' ') + 1:] ELSE '' END ELSE last_name END"""
_NAMED = f"""named AS (SELECT *, CASE WHEN trim(f || ' ' || l) = '' THEN 'Unknown' ELSE trim(f || ' ' || l) END AS client_name
    FROM (SELECT *, {_FIRST} AS f, {_LAST} AS l FROM fx_rows))"""


@query("split_person_name", with_sql(
    f"WITH {_NAMED} SELECT src_row, f AS first_name, l AS last_name, client_name FROM named", "rows"))
def _(spark, sf_dir):
    return notes_csv.split_person_name(b.rows(spark, sf_dir)).select("src_row", "first_name", "last_name", "client_name")


@query("client_key", with_sql(
    f"WITH {_NAMED} SELECT src_row, 'csv_' || md5(lower(client_name))[1:8] AS client_id FROM named", "rows"))
def _(spark, sf_dir):
    return notes_csv.split_person_name(b.rows(spark, sf_dir)).select("src_row", "client_id")


@query("note_key", with_sql("""
    SELECT note_id, sha256(note_id || '|2025-01-15|' || note[1:100])[1:16] AS key FROM fx_corpus""", "corpus"))
def _(spark, sf_dir):
    return b.corpus(spark, sf_dir).select(
        "note_id", keys.note_key(F.col("note_id"), F.lit("2025-01-15"), F.col("note")).alias("key"))


@query("registry_name_split", with_sql("""
    SELECT client_id, first_name AS first_name, last_name AS last_name FROM fx_roster""", "roster"))
def _(spark, sf_dir):
    stored = b.roster(spark, sf_dir).select(
        "client_id", F.concat("first_name", F.lit("  Middle "), "last_name").alias("full_name"))
    return state.registry_name_split(stored).drop("full_name")


@query("note_date_or_target", with_sql(f"""
    SELECT note_id, CASE WHEN status = 'O' THEN '{TARGET_DATE}' ELSE created_at END AS day FROM fx_notes""", "notes"))
def _(spark, sf_dir):
    created = F.when(F.col("status") != "O", F.concat("created_at", F.lit("T00:00:00")))
    return b.notes(spark, sf_dir).select(
        "note_id", sel.note_date_or_target(created, F.lit(TARGET_DATE)).alias("day"))


@query("output_name", with_sql("""
    SELECT note_id, created_at || '_' || ref_code || '_note_' || note_id
      || CASE WHEN status = 'P' THEN '_QUARANTINE.txt' ELSE '.txt' END AS name FROM fx_notes""", "notes"))
def _(spark, sf_dir):
    return b.notes(spark, sf_dir).select("note_id", keys.output_name(
        F.col("created_at"), F.col("ref_code"), F.col("note_id"), F.col("status") == "P").alias("name"))


@query("local_yesterday", """
    SELECT event_id, strftime(CAST(timezone('Australia/Melbourne', timezone('UTC', ts)) AS DATE) - 1, '%Y-%m-%d') AS day
    FROM events""")
def _(spark, sf_dir):
    now = F.col("ts").cast("timestamp_ntz")
    return b.table(spark, sf_dir, "events").select("event_id", F.date_format(
        keys.local_yesterday(now, "Australia/Melbourne"), "yyyy-MM-dd").alias("day"))


@query("roster_filter", with_sql("""
    SELECT client_id, first_name || ' ' || last_name AS full_name FROM fx_roster WHERE k % 50 <> 0""", "roster"))
def _(spark, sf_dir):
    code = F.when(F.col("k") % 50 != 0, F.col("ref_code"))
    return sf.roster_filter(b.roster(spark, sf_dir).withColumn("ref_code", code)).select("client_id", "full_name")


_ALL_FORMS = f"""WITH {o.FORMS} """


@query("surface_filter", with_sql(f"""WITH allforms AS (SELECT DISTINCT unnest({o.variants("fn")}) AS form
    FROM (SELECT first_name || ' ' || last_name AS fn FROM fx_roster))
    SELECT form, {o.usable("form")} AS usable, length(form) > 2 AS usable_organization FROM allforms""", "roster"))
def _(spark, sf_dir):
    forms = name_forms(spark, sf_dir).select("form").distinct()
    return forms.select("form", names.surface_ok(F.col("form")).alias("usable"),
                        names.surface_ok(F.col("form"), False).alias("usable_organization"))


# --- joins -------------------------------------------------------------------

@query("note_client_join", with_sql("""
    SELECT note_id, n.client_id, coalesce(r.phone, '') AS phone FROM fx_notes n
    LEFT JOIN (SELECT * FROM fx_roster JOIN customer ON k = c_custkey WHERE c_acctbal > 0) r USING (client_id)""", "notes"))
def _(spark, sf_dir):
    rich = b.table(spark, sf_dir, "customer").where("c_acctbal > 0")
    people = b.roster(spark, sf_dir).join(rich, F.col("k") == F.col("c_custkey"), "left_semi")
    return rosters.with_clients(b.notes(spark, sf_dir).select("note_id", "client_id"), people, "phone")


@query("note_code_join", with_sql("SELECT note_id, ref_code FROM fx_notes", "notes"))
def _(spark, sf_dir):
    return codes.with_codes(b.notes(spark, sf_dir).select("note_id", "client_id"),
                            b.roster(spark, sf_dir)).select("note_id", "ref_code")


@query("skip_processed", with_sql("SELECT note_id FROM fx_notes WHERE status <> 'F'", "notes"))
def _(spark, sf_dir):
    return sel.skip_processed(b.notes(spark, sf_dir), state.scan_processed_log(log_of(spark, sf_dir))).select("note_id")


def keyed_words(spark, sf_dir):
    return m.word_forms(sf.word_steps(b.roster(spark, sf_dir), b.staff(spark, sf_dir)), codes=True)


@query("gazetteer_join", with_sql(f"""WITH {o.start_cte()}, {o.FORMS},
    {o.word_fold("w0", "participants,staff", "w1").split("w1 AS (")[0].rstrip().rstrip(",")}
    SELECT note_id, p AS pass_no, form FROM w1_t JOIN w1_k USING (k) JOIN w0 USING (note_id)
    WHERE contains(lower(text), lower(form)) AND regexp_matches(text, '(?i)\\b' || regexp_escape(form) || '\\b')""",
    "corpus", "staff"))
def _(spark, sf_dir):
    return m.matches(d.start(b.corpus(spark, sf_dir)), keyed_words(spark, sf_dir), m.word_keys).select(
        "note_id", F.col("pass_no").cast("int").alias("pass_no"), "form")


_VALUE_UNION = " UNION ALL ".join(o.VALUE_STEPS[k].replace("{src}", "w0") for k in ("ndis", "dob", "phone", "email", "address"))


@query("roster_value_join", with_sql(f"""WITH {o.start_cte()}
    SELECT note_id, CAST(o3 AS INT) AS kind, form FROM ({_VALUE_UNION}) JOIN w0 USING (note_id)
    WHERE regexp_matches(text, pat)""", "corpus"))
def _(spark, sf_dir):
    forms = m.value_forms(known_value_steps(b.roster(spark, sf_dir)))
    return m.matches(d.start(b.corpus(spark, sf_dir)), forms, m.value_keys, "kind", "form")


@query("already_ran", with_sql("""
    SELECT DISTINCT created_at AS run_date FROM fx_notes
    WHERE created_at NOT IN (SELECT created_at FROM fx_notes WHERE status = 'F')""", "notes"))
def _(spark, sf_dir):
    days = b.notes(spark, sf_dir).select(F.col("created_at").alias("run_date")).distinct()
    return sel.already_ran(days, inventory(spark, sf_dir))


@query("export_worklist", with_sql(f"""
    SELECT ref_code, '{TARGET_DATE}' AS run_date FROM fx_roster
    WHERE ref_code NOT IN (SELECT ref_code FROM fx_notes WHERE status = 'F' AND created_at = '{TARGET_DATE}')""", "notes"))
def _(spark, sf_dir):
    wanted = b.roster(spark, sf_dir).select("ref_code", F.lit(TARGET_DATE).alias("run_date"))
    return sel.export_worklist(wanted, inventory(spark, sf_dir)).select("ref_code", "run_date")


# --- aggregations, order, sets -----------------------------------------------

def day_notes(spark, sf_dir) -> DataFrame:
    return notes_csv.notes_from_rows(b.rows(spark, sf_dir), TARGET_DATE)


_DAY = f"""{_NAMED}, day AS (SELECT *, 'csv_' || md5(lower(client_name))[1:8] AS client_id FROM named
    WHERE {o.PASSES} AND note <> '')"""


@query("client_roster", with_sql(f"""WITH {_DAY}
    SELECT client_id, f AS first_name, l AS last_name, ndis AS ndis_number, dob AS date_of_birth FROM day
    QUALIFY row_number() OVER (PARTITION BY client_id ORDER BY src_file DESC, src_row) = 1""", "rows"))
def _(spark, sf_dir):
    return rosters.client_roster(day_notes(spark, sf_dir)).drop("address", "phone", "email")


@query("staff_roster", with_sql(f"""WITH {_DAY},
    per_file AS (SELECT src_file, src_row, staff FROM day WHERE staff <> ''
      QUALIFY row_number() OVER (PARTITION BY src_file, lower(staff) ORDER BY src_row) = 1)
    SELECT split_part(staff, ' ', 1) AS first_name, split_part(staff, ' ', 2) AS last_name FROM per_file
    QUALIFY row_number() OVER (PARTITION BY lower(staff) ORDER BY src_file DESC, src_row DESC) = 1""", "rows"))
def _(spark, sf_dir):
    return rosters.staff_roster(day_notes(spark, sf_dir))


@query("dictionary_counts", with_sql(
    f"WITH {o.SURFACES} SELECT type, count(DISTINCT surface) AS surfaces FROM surf GROUP BY type", "dictionary"))
def _(spark, sf_dir):
    return pii_dictionary.dictionary_counts(surfaces_of(spark, sf_dir))


def staged(spark, make: Callable[[], DataFrame]) -> DataFrame:
    """What a run gives, computed once; its intermediate tables are removed."""
    with Staging(spark):
        return written(make(), scratch_path(spark, "result"))


def result(spark, sf_dir) -> DataFrame:
    return staged(spark, lambda: d.deidentify(cut_lineage(b.corpus(spark, sf_dir)), b.roster(spark, sf_dir), b.staff(spark, sf_dir),
                                              surfaces_of(spark, sf_dir), cut=True))


@query("substitution_counts", o.deidentify_sql("""
    SELECT split_part(c, '=', 1) AS label, CAST(sum(CAST(split_part(c, '=', 2) AS BIGINT)) AS BIGINT) AS n
    FROM (SELECT unnest(string_split(counts, ';')) AS c FROM done WHERE counts <> '') GROUP BY 1"""))
def _(spark, sf_dir):
    return st.label_totals(result(spark, sf_dir))


BROKEN = 13     # every 13th note has text that isn't UTF-8, so that errors are counted too


def run_of_notes(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """All notes with their error, and the results of those that are new, by all passes."""
    broken = F.col("note_id").cast("bigint") % BROKEN == 0
    bad = F.concat("note", F.unhex(F.lit("C328")).cast("string"))
    every = written(sel.isolate_errors(b.notes(spark, sf_dir).select(
        "note_id", "ref_code", "created_at", F.when(broken, bad).otherwise(F.col("note")).alias("note"))), scratch_path(spark, "every"))
    usable = every.where(F.col("error").isNull()).drop("error")
    fresh = sel.skip_processed(sel.drop_blank_notes(usable), state.scan_processed_log(log_of(spark, sf_dir)))
    columns = ("note_id", "ref_code", "is_quarantined", "quarantine_reason")
    return every, staged(spark, lambda: d.deidentify(
        cut_lineage(fresh), b.roster(spark, sf_dir), b.staff(spark, sf_dir), surfaces_of(spark, sf_dir), cut=True).select(*columns))


def disposed(every: DataFrame, done: DataFrame) -> DataFrame:
    """Every note with its disposition: failed, finished or skipped."""
    ends = done.select("note_id", F.when(F.col("is_quarantined"), "quarantine").otherwise("pending").alias("done"))
    return every.select("note_id", "error").join(ends, "note_id", "left").select(
        "note_id", F.when(F.col("error").isNotNull(), "error").otherwise(F.coalesce("done", F.lit("skipped"))).alias("disposition"))


def stats_of_notes(spark, sf_dir) -> DataFrame:
    return st.run_stats(disposed(*run_of_notes(spark, sf_dir)))


_ROUTED = f"""WITH {o.notes_ctes(f"trim(note) <> '' AND status <> 'F' AND CAST(note_id AS BIGINT) % {BROKEN} <> 0")},
    checked AS (SELECT note_id, {o.reason()} AS reason FROM w4),
    routed AS (SELECT note_id, CASE WHEN CAST(note_id AS BIGINT) % {BROKEN} = 0 THEN 'error' WHEN c.note_id IS NULL THEN 'skipped'
                 WHEN reason IS NULL THEN 'pending' ELSE 'quarantine' END AS disposition, ref_code, reason
               FROM fx_notes LEFT JOIN checked c USING (note_id)),
    stats AS (SELECT count(*) AS total, count(*) FILTER (disposition = 'pending') AS uploaded,
                count(*) FILTER (disposition = 'quarantine') AS quarantined,
                count(*) FILTER (disposition = 'skipped') AS skipped, count(*) FILTER (disposition = 'error') AS errors FROM routed)"""
_LEDGER = with_sql(f"""{_ROUTED} SELECT '{TARGET_DATE}' AS "Run Date", '1998-06-16T08:00:00' AS "Run At (ISO)",
    total AS "Notes Exported", uploaded AS "Notes Processed", quarantined AS "Notes Quarantined", skipped AS "Notes Skipped",
    errors || '{LEDGER_ERROR_SUFFIX}' AS "Errors", 'orders' AS "CSV File" FROM stats""", "notes", "staff", "dictionary")


def ledger_of_notes(spark, sf_dir) -> DataFrame:
    return st.run_ledger_row(stats_of_notes(spark, sf_dir), TARGET_DATE, "1998-06-16T08:00:00", "orders")


@query("run_stats", with_sql(f"{_ROUTED} SELECT * FROM stats", "notes", "staff", "dictionary"))
def _(spark, sf_dir):
    return stats_of_notes(spark, sf_dir)


@query("run_ledger_row", _LEDGER)
def _(spark, sf_dir):
    return ledger_of_notes(spark, sf_dir)


@query("run_report", with_sql(f"""{_ROUTED}
    SELECT 'metrics' AS part, unnest(['Total notes fetched', 'Uploaded to Pending', 'Quarantined', 'Skipped (already processed)',
      'Errors']) AS item, '' AS detail, unnest([total, uploaded, quarantined, skipped, errors]) AS n FROM stats
    UNION ALL SELECT 'quarantined', note_id, ref_code || ' ' || split_part(reason, '[', 1) || '[masked]', 0 FROM routed
      WHERE disposition = 'quarantine'
    UNION ALL SELECT 'errors', note_id, 'text is not valid UTF-8', 0 FROM routed WHERE disposition = 'error'""",
    "notes", "staff", "dictionary"))
def _(spark, sf_dir):
    """The three tables of a report, one under the other."""
    every, done = run_of_notes(spark, sf_dir)
    none = F.lit(0).cast("long")
    metrics = st.report_metrics(st.run_stats(disposed(every, done))).select(
        F.lit("metrics").alias("part"), F.col("metric").alias("item"), F.lit("").alias("detail"), F.col("n").cast("long").alias("n"))
    held = st.report_quarantined(done).select(
        F.lit("quarantined"), "note_id", F.concat_ws(" ", "ref_code", "reason"), none)
    failed = st.report_errors(every).select(F.lit("errors"), "note_id", "error", none)
    return metrics.union(held).union(failed)


@query("assign_codes", with_sql(f"""WITH known AS (SELECT client_id, ref_code FROM fx_roster JOIN customer ON k = c_custkey
      WHERE c_mktsegment = 'BUILDING'),
    base AS (SELECT greatest(count(*), max(CAST(ref_code[6:] AS BIGINT))) AS n FROM known),
    seen AS (SELECT client_id, min((src_file, src_row)) AS first_at FROM fx_notes
      WHERE client_id NOT IN (SELECT client_id FROM known) GROUP BY client_id)
    SELECT client_id, printf('PART-%03d', base.n + row_number() OVER (ORDER BY first_at)) AS ref_code FROM seen, base""", "notes"))
def _(spark, sf_dir):
    building = b.table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "BUILDING")
    known = b.roster(spark, sf_dir).join(building, F.col("k") == F.col("c_custkey"), "left_semi")
    return codes.assign_codes(b.notes(spark, sf_dir), known).drop("pos")


def keyed_notes(spark, sf_dir) -> DataFrame:
    """Notes under content ids: equal notes of one client share an id."""
    return b.notes(spark, sf_dir).withColumn(
        "note_id", keys.note_key(F.col("client_id"), F.lit(TARGET_DATE), F.trim("note")))


_KEYED = f"keyed AS (SELECT *, sha256(client_id || '|{TARGET_DATE}|' || trim(note)[1:100])[1:16] AS key FROM fx_notes)"


@query("dedup_notes", with_sql(f"""WITH {_KEYED} SELECT key AS note_id, src_file, src_row FROM keyed
    QUALIFY row_number() OVER (PARTITION BY key ORDER BY src_file, src_row) = 1""", "notes"))
def _(spark, sf_dir):
    return sel.dedup_notes(keyed_notes(spark, sf_dir)).select("note_id", "src_file", "src_row")


@query("name_dictionary", with_sql(f"WITH {o.FORMS} SELECT form, ref_code, ambiguous, first_pos FROM dict1", "roster", "staff"))
def _(spark, sf_dir):
    return sf.name_dictionary(b.roster(spark, sf_dir))


@query("longest_first", with_sql(f"""WITH {o.FORMS} SELECT ref_code,
    string_agg(form, '|' ORDER BY -length(form), first_pos, form) AS forms FROM dict1 GROUP BY ref_code""", "roster", "staff"))
def _(spark, sf_dir):
    steps = m.word_forms(sf.word_steps(b.roster(spark, sf_dir), None), codes=True)
    return m.longest_first(steps, "tag").select(
        F.col("tag").alias("ref_code"), F.array_join(F.transform("steps", lambda x: x["form"]), "|").alias("forms"))


def all_spans() -> Column:
    return spans.find_spans(F.col("note"), det.detect_locations(F.col("note")))


def span_rows(spark, sf_dir, column: Column) -> DataFrame:
    """One row per span; exploded in place, so the spans are found only once."""
    return b.corpus(spark, sf_dir).select("note_id", F.posexplode(column).alias("pos", "s")).select(
        "note_id", F.col("pos").cast("bigint").alias("pos"), F.col("s.start").cast("bigint").alias("start_at"),
        (-F.col("s.neg_end")).cast("bigint").alias("end_at"), F.col("s.label").alias("label"))


_SPANS = f"WITH {o.start_cte()}, {o.spans('w0', 'sp').strip()}"


@query("find_spans", with_sql(f"{_SPANS} SELECT note_id, st AS start_at, en AS end_at, label FROM sp", "corpus"))
def _(spark, sf_dir):
    return span_rows(spark, sf_dir, all_spans()).drop("pos")


@query("span_order", with_sql(f"""{_SPANS} SELECT note_id, row_number() OVER (PARTITION BY note_id
    ORDER BY st, pri, en DESC, rank) - 1 AS pos, st AS start_at, en AS end_at, label FROM sp""", "corpus"))
def _(spark, sf_dir):
    return span_rows(spark, sf_dir, F.sort_array(all_spans()))


@query("merge_spans", with_sql(f"""{_SPANS}, {o.merged("sp", "mg").strip()}
    SELECT note_id, m.st AS start_at, m.en AS end_at, m.label AS label FROM (SELECT note_id, unnest(ms) AS m FROM mg)""", "corpus"))
def _(spark, sf_dir):
    return span_rows(spark, sf_dir, spans.merge_spans(all_spans())).drop("pos")


@query("splice_spans", with_sql(f"""{_SPANS}, {o.merged("sp", "mg").strip()}, {o.spliced("w0", "mg", "w1").strip()}
    SELECT note_id, text FROM w1""", "corpus"))
def _(spark, sf_dir):
    return b.corpus(spark, sf_dir).select(
        "note_id", spans.splice_spans(F.col("note"), spans.merge_spans(all_spans())).alias("text"))


@query("file_order", with_sql("""
    SELECT src_file, first(note_id ORDER BY src_row) AS first_note, last(note_id ORDER BY src_row) AS last_note
    FROM fx_notes GROUP BY src_file ORDER BY src_file""", "notes"))
def _(spark, sf_dir):
    return sel.file_order(b.notes(spark, sf_dir), "note_id").select(
        "src_file", F.col("first").alias("first_note"), F.col("last").alias("last_note"))


@query("residual_sort", with_sql(f"""
    SELECT note_id, {o.found(" || ".join([o.ndis(), o.phones(), o.emails()]))} AS residual FROM fx_corpus""", "corpus"))
def _(spark, sf_dir):
    n = F.col("note")
    found = verify.residual_sort(F.concat(det.detect_ndis(n), det.detect_phones(n), det.detect_emails(n)))
    return b.corpus(spark, sf_dir).select("note_id", F.array_join(found, "|").alias("residual"))


@query("union_notes", with_sql("SELECT note_id, note FROM fx_corpus", "corpus"))
def _(spark, sf_dir):
    parts = b.notes(spark, sf_dir).select(F.concat(F.lit("n"), "note_id").alias("note_id"), "note", "src_file")
    files = [parts.where(F.col("src_file") == f).drop("src_file") for f in ("f0", "f1", "f2")]
    out = b.documents(spark, sf_dir)
    for part in files:
        out = out.unionByName(part)
    return out


@query("union_surfaces", with_sql(f"WITH {o.SURFACES}, {o.FORMS} SELECT surface FROM surf UNION SELECT form FROM dict1",
                                  "roster", "staff", "dictionary"))
def _(spark, sf_dir):
    return surfaces_of(spark, sf_dir).select("surface").union(
        sf.name_dictionary(b.roster(spark, sf_dir)).select("form")).distinct()


def detector(name: str, column: Callable[[Column], Column], sql: Callable[[], str]):
    @query(name, with_sql(f"SELECT note_id, {o.found(sql())} AS found FROM fx_corpus", "corpus"))
    def run(spark, sf_dir):
        return b.corpus(spark, sf_dir).select("note_id", joined(column(F.col("note"))).alias("found"))


detector("union_phone_matches", det.union_phone_matches, o.phones)
detector("detect_ndis", det.detect_ndis, o.ndis)
detector("detect_phones", det.detect_phones, o.phones)
detector("detect_emails", det.detect_emails, o.emails)
detector("detect_dob", det.detect_dob, o.dob_all)
detector("detect_addresses", det.detect_addresses, o.addresses)
detector("detect_states", det.detect_states, o.states)
detector("detect_suburb_postcode", det.detect_suburb_postcode, o.suburbs)
detector("detect_locations", det.detect_locations, o.locations)


@query("header_contains", with_sql("""
    SELECT type, name FROM fx_dictionary""", "dictionary"))
def _(spark, sf_dir):
    raw = b.dictionary(spark, sf_dir).select(F.col("name").alias("Name "), F.col("type").alias(" Type"))
    assert pii_dictionary.dictionary_rows(raw.drop(" Type")) is None
    return pii_dictionary.dictionary_rows(raw)


# --- string functions --------------------------------------------------------

@query("strip_title", with_sql("""
    SELECT name, trim(regexp_replace(name, '^(?:Dr|Mr|Ms|Mrs|Prof)\\.? ', '')) AS bare FROM fx_dictionary""", "dictionary"))
def _(spark, sf_dir):
    return b.dictionary(spark, sf_dir).select("name", names.strip_title(F.col("name")).alias("bare"))


def name_forms(spark, sf_dir) -> DataFrame:
    r = b.roster(spark, sf_dir)
    full = names.full_name(F.col("first_name"), F.col("last_name"))
    return r.select("k", F.explode(names.name_variations(full)).alias("form"))


@query("name_variations", with_sql(f"""
    SELECT k, unnest({o.variants("fn")}) AS form FROM (SELECT k, first_name || ' ' || last_name AS fn FROM fx_roster)""", "roster"))
def _(spark, sf_dir):
    return name_forms(spark, sf_dir)


@query("nickname_expand", with_sql(f"""
    SELECT k, array_to_string({o._NICK.format(w="first_name")}, '|') AS other FROM fx_roster""", "roster"))
def _(spark, sf_dir):
    return b.roster(spark, sf_dir).select("k", F.array_join(names.nickname_expand(F.col("first_name")), "|").alias("other"))


@query("dob_variants", with_sql(f"""
    SELECT k, array_to_string({o._DOB_FORMS}, '|') AS forms FROM (
      SELECT k, date_of_birth[1:4] AS y, date_of_birth[6:7] AS m, date_of_birth[9:10] AS d FROM fx_roster)""", "roster"))
def _(spark, sf_dir):
    return b.roster(spark, sf_dir).select("k", F.array_join(values.dob_variants(F.col("date_of_birth")), "|").alias("forms"))


@query("normalise_phone", with_sql("SELECT k, phone FROM fx_roster", "roster"))
def _(spark, sf_dir):
    p = F.col("phone")
    written = F.concat(F.lit("("), F.substring(p, 1, 2), F.lit(") "), F.substring(p, 3, 4), F.lit("-"), F.substring(p, 7, 4))
    return b.roster(spark, sf_dir).select("k", values.normalise_phone(written).alias("phone"))


@query("street_part", with_sql(f"""
    SELECT k, CASE WHEN length(address) > 8 THEN {o._STREET} ELSE '' END AS part FROM fx_roster""", "roster"))
def _(spark, sf_dir):
    return b.roster(spark, sf_dir).select("k", values.street_part(F.col("address")).alias("part"))


@query("escape_literal", with_sql("""
    SELECT note_id, replace(note, substr(note, 1, 12), '#') AS replaced FROM fx_corpus WHERE note <> ''""", "corpus"))
def _(spark, sf_dir):
    """The first 12 characters of each text as a pattern, whatever they are: plain replacement of them gives the same."""
    literal = tx.quote_literal(F.substring("note", 1, 12))
    return b.corpus(spark, sf_dir).where("note <> ''").select("note_id", F.regexp_replace(F.col("note"), literal, F.lit("#")).alias("replaced"))


# --- passes ------------------------------------------------------------------

def texts(spark, sf_dir) -> DataFrame:
    """The corpus, made once: a pass reads it for its candidates and again for its fold."""
    return d.start(cut_lineage(b.corpus(spark, sf_dir)))


@query("redact_participants", o.pass_sql(o.FORMS, o.word_fold("w0", "participants", "w1"), last="w1", names=("staff",)))
def _(spark, sf_dir):
    return shown(d.redact_words(texts(spark, sf_dir), b.roster(spark, sf_dir)))


@query("redact_staff", o.pass_sql(o.FORMS, o.word_fold("w0", "staff", "w1"), last="w1", names=("staff",)))
def _(spark, sf_dir):
    return shown(d.redact_words(texts(spark, sf_dir), None, b.staff(spark, sf_dir)))


def known_pass(kind: str):
    @query(f"redact_known_{kind}", o.pass_sql(o.value_fold("w0", kind, "w1"), last="w1"))
    def run(spark, sf_dir):
        return shown(d.redact_known_values(texts(spark, sf_dir), b.roster(spark, sf_dir), (kind,)))


for _kind in ("ndis", "dob", "phone", "email", "address"):
    known_pass(_kind)


def dictionary_pass(name: str, kind: str):
    only = o.SURFACES.replace("WHERE name <> ''", f"WHERE name <> '' AND type = '{kind}'")

    @query(name, o.pass_sql(only, o.word_fold("w0", "dictionary", "w1"), last="w1", names=("dictionary",)))
    def run(spark, sf_dir):
        mine = surfaces_of(spark, sf_dir).where(F.col("type") == kind)
        return shown(d.redact_dictionary(texts(spark, sf_dir), mine))


for _name, _kind in (("redact_carers", "Carer"), ("redact_extra_providers", "Provider"),
                     ("redact_extra_participants", "Participant"), ("redact_organizations", "Organization"),
                     ("redact_known_locations", "Location")):
    dictionary_pass(_name, _kind)


@query("redact_patterns", o.pass_sql(o.patterns("w0", "w1"), last="w1"))
def _(spark, sf_dir):
    return shown(d.redact_patterns(d.start(b.corpus(spark, sf_dir))))


@query("verify_residuals", with_sql(f"SELECT note_id, {o.reason('note')} AS reason FROM fx_corpus", "corpus"))
def _(spark, sf_dir):
    checked = d.verify_residuals(d.start(b.corpus(spark, sf_dir)))
    return checked.select("note_id", F.col("quarantine_reason").alias("reason"))


@query("deidentify", o.deidentify_sql("SELECT note_id, text, counts, reason FROM done"))
def _(spark, sf_dir):
    return result(spark, sf_dir).select(
        "note_id", F.col("deidentified_text").alias("text"), counts_text(F.col("counts")).alias("counts"),
        F.col("quarantine_reason").alias("reason"))


# --- outputs and state -------------------------------------------------------

def whole(spark, sf_dir) -> DataFrame:
    """Every note with a body, by all passes."""
    kept = sel.drop_blank_notes(b.notes(spark, sf_dir)).select("note_id", "ref_code", "created_at", "note")
    return staged(spark, lambda: d.deidentify(cut_lineage(kept), b.roster(spark, sf_dir), b.staff(spark, sf_dir), surfaces_of(spark, sf_dir), cut=True))


_WHOLE = f"""WITH {o.notes_ctes("trim(note) <> ''")},
    lab AS (SELECT note_id, split_part(h, '#', 1) AS label, min(i) AS i, sum(CAST(split_part(h, '#', 2) AS BIGINT)) AS n FROM (
      SELECT note_id, unnest(hits) AS h, unnest(range(len(hits))) AS i FROM w4) GROUP BY ALL),
    shown AS (SELECT note_id, string_agg('''' || label || ''': ' || n, ', ' ORDER BY i) AS c FROM lab GROUP BY note_id),
    done AS (SELECT w4.note_id, ref_code, created_at, text, '{{' || coalesce(c, '') || '}}' AS counts, {o.reason()} AS reason
      FROM w4 JOIN fx_notes USING (note_id) LEFT JOIN shown USING (note_id))"""
_PATTERNED = f"""WITH w0 AS (SELECT note_id, note AS text, {o.locations()} AS locs, []::VARCHAR[] AS hits FROM fx_notes
      WHERE trim(note) <> ''), {o.patterns("w0", "w1")},
    done AS (SELECT note_id, {o.reason()} AS reason FROM w1)"""
_CLEAN = f"""'Reference: ' || ref_code || chr(10) || 'Date: {TARGET_DATE}' || chr(10) || 'Substitutions: ' || counts || chr(10)
    || chr(10) || '{CLEAN_MARKER}' || chr(10) || chr(10) || text"""
_HELD = f"""'{QUARANTINE_BANNER}' || chr(10) || 'Note ID: ' || note_id || chr(10) || 'Reference: ' || ref_code
    || chr(10) || 'Quarantine reason: ' || reason || chr(10) || chr(10) || '{QUARANTINE_MARKER}' || chr(10)
    || chr(10) || text"""


@query("render_clean_note", with_sql(f"{_WHOLE} SELECT note_id, {_CLEAN} AS body FROM done WHERE reason IS NULL", "notes", "staff", "dictionary"))
def _(spark, sf_dir):
    return whole(spark, sf_dir).where(~F.col("is_quarantined")).select("note_id", render.render_clean_note(
        F.lit(TARGET_DATE), F.col("ref_code"), F.col("counts"), F.col("deidentified_text")).alias("body"))


@query("render_quarantine_note", with_sql(f"{_WHOLE} SELECT note_id, {_HELD} AS body FROM done WHERE reason IS NOT NULL", "notes", "staff", "dictionary"))
def _(spark, sf_dir):
    return whole(spark, sf_dir).where("is_quarantined").select("note_id", render.render_quarantine_note(
        F.col("note_id"), F.col("ref_code"), F.col("quarantine_reason"), F.col("deidentified_text")).alias("body"))


@query("route_outputs", with_sql(f"""{_WHOLE} SELECT note_id, CASE WHEN reason IS NULL THEN 'pending' ELSE 'quarantine' END
    AS disposition, created_at || '_' || ref_code || '_note_' || note_id || CASE WHEN reason IS NULL THEN '.txt'
    ELSE '_QUARANTINE.txt' END AS output_path, CASE WHEN reason IS NULL THEN {_CLEAN} ELSE {_HELD} END AS body FROM done""", "notes", "staff", "dictionary"))
def _(spark, sf_dir):
    base = scratch_path(spark, "routed")
    outputs.route_outputs(outputs.rendered(whole(spark, sf_dir), TARGET_DATE), base, "r1")
    return spark.read.parquet(f"{base}/outputs/run_id=r1").select(
        "note_id", F.col("disposition").cast("string").alias("disposition"), "output_path", "body")


def fresh_state(spark, name: str) -> str:
    base = scratch_path(spark, name)
    state.init_state(spark, base)
    return base


@query("append_registry", with_sql("""
    WITH seen AS (SELECT client_id, min((src_file, src_row)) AS first_at FROM fx_notes GROUP BY client_id)
    SELECT client_id, printf('PART-%03d', row_number() OVER (ORDER BY first_at)) AS ref_code, r.first_name || ' ' || r.last_name AS full_name,
           r.ndis_number FROM seen JOIN fx_roster r USING (client_id)""", "notes"))
def _(spark, sf_dir):
    base, n = fresh_state(spark, "registry"), b.notes(spark, sf_dir)
    for run in ("r1", "r2"):        # the second run finds every client known
        known = state.read_state(spark, base, "registry")
        state.append_state(codes.registry_entries(codes.assign_codes(n, known), rosters.client_roster(n)), base, "registry", run)
    return state.read_state(spark, base, "registry").select("client_id", "ref_code", "full_name", "ndis_number")


@query("append_processed_log", with_sql("""
    SELECT note_id, 'success' AS status, ref_code FROM fx_notes WHERE status <> 'X'""", "notes"))
def _(spark, sf_dir):
    base, n = fresh_state(spark, "log"), b.notes(spark, sf_dir)
    for run in ("r1", "r2"):        # the second run finds every note processed
        rest = sel.skip_processed(n, state.read_state(spark, base, "processed_log"))
        state.append_state(rest.select("note_id", F.current_timestamp().alias("processed_at"), F.lit("").alias("output_path"),
                                       F.lit("success").alias("status"), "ref_code"), base, "processed_log", run)
    return state.read_state(spark, base, "processed_log").select("note_id", "status", "ref_code")


def ledger(spark, sf_dir) -> str:
    base = fresh_state(spark, "ledger")
    row = written(ledger_of_notes(spark, sf_dir), scratch_path(spark, "row"))
    for _ in range(2):              # a repeated run replaces its row
        state.append_state(row, base, "run_ledger", "r1")
    return base


@query("append_run_ledger", _LEDGER)
def _(spark, sf_dir):
    return state.read_state(spark, ledger(spark, sf_dir), "run_ledger")


@query("publish_ledger", _LEDGER)
def _(spark, sf_dir):
    base, target = ledger(spark, sf_dir), scratch_path(spark, "published")
    for _ in range(2):              # the copy is replaced, not doubled
        state.publish_ledger(spark, base, target)
    return spark.read.option("header", "true").schema(state.LEDGER_SCHEMA).csv(target)


@query("init_state", with_sql("SELECT note_id, false AS known FROM fx_notes", "notes"))
def _(spark, sf_dir):
    log = state.read_state(spark, fresh_state(spark, "state"), "processed_log")
    known = log.select("note_id", F.lit(True).alias("known"))
    return b.notes(spark, sf_dir).join(known, "note_id", "left").select("note_id", F.coalesce("known", F.lit(False)).alias("known"))


@query("isolate_errors", with_sql("""
    SELECT note_id, CASE WHEN src_row % 13 = 0 AND src_row % 2 = 0 THEN 'text is not valid UTF-8' END AS error,
           CAST(CASE WHEN src_row % 13 <> 0 THEN 0 WHEN src_row % 2 = 0 THEN 2 ELSE 1 END AS INTEGER) AS attempts
    FROM fx_notes WHERE src_row % 13 = 0 OR src_file <> 'f0'""", "notes"))
def _(spark, sf_dir):
    """Two runs: failed notes of the first are input of the second, which gets half of them mended; the others fail again."""
    base = scratch_path(spark, "letters")
    broken = F.col("src_row") % BROKEN == 0
    bad = lambda when: F.when(when, F.concat("note", F.unhex(F.lit("C328")).cast("string"))).otherwise(F.col("note"))
    n = b.notes(spark, sf_dir).select("src_file", "src_row", "note_id", "ref_code", "created_at", "note")
    none = state.read_letters(spark, base)
    state.replace_letters(manifest.failed_again(sel.isolate_errors(manifest.with_letters(n.withColumn("note", bad(broken)), none)), none), base)
    letters = state.read_letters(spark, base)
    mended = broken & (F.col("src_row") % 2 == 1)
    again = n.where(mended | ~broken & (F.col("src_file") != "f0"))
    checked = written(sel.isolate_errors(manifest.with_letters(again, letters)), scratch_path(spark, "checked"))
    state.replace_letters(manifest.failed_again(checked, letters), base)
    left = state.read_letters(spark, base).select("note_id", F.col("attempt").alias("after"))
    return checked.join(left, "note_id", "left").select("note_id", "error", F.coalesce("after", "attempt").alias("attempts"))


NOTE_ROW = ("note_id string, src_file string, src_row long, client_id string, first_name string, last_name string, "
            "ndis_number string, date_of_birth string, staff string, note string, created_at string")


def landed(spark, sf_dir) -> tuple[str, str]:
    """Notes as two drops of Parquet files in one landing folder; the second comes later."""
    base = scratch_path(spark, "landing")
    columns = [c.split()[0] for c in NOTE_ROW.split(", ")]
    n = b.notes(spark, sf_dir).select(*columns)
    n.where(F.col("src_file") != "f2").coalesce(2).write.mode("append").parquet(f"{base}/in")
    return base, columns


def land_rest(spark, sf_dir, base: str, columns) -> None:
    b.notes(spark, sf_dir).select(*columns).where(F.col("src_file") == "f2").coalesce(1).write.mode(
        "append").parquet(f"{base}/in")


@query("incremental_run", with_sql(f"""{_WHOLE} SELECT note_id, CASE WHEN reason IS NULL THEN 'success' ELSE 'quarantine' END AS status, ref_code,
    CAST(1 AS BIGINT) AS outputs, CASE WHEN reason IS NULL THEN {_CLEAN} ELSE {_HELD} END AS body FROM done""", "notes", "staff", "dictionary"))
def _(spark, sf_dir):
    """Three runs over a landing folder (two drops, then nothing new), all clients known: log rows and whole outputs."""
    base, columns = landed(spark, sf_dir)
    state.init_state(spark, f"{base}/state")
    known = b.roster(spark, sf_dir).select("*", F.lit(None).cast("timestamp").alias("date_first_assigned"), F.col("k").alias("pos"),
                                           F.concat_ws(" ", "first_name", "last_name").alias("full_name"))
    state.append_state(known, f"{base}/state", "registry", "known")
    for run in range(3):
        if run == 1:
            land_rest(spark, sf_dir, base, columns)
        stream = incremental.note_stream(spark, f"{base}/in", NOTE_ROW)
        incremental.incremental_run(stream, f"{base}/state", f"{base}/checkpoint", TARGET_DATE, staff=b.staff(spark, sf_dir),
                                    surfaces=surfaces_of(spark, sf_dir)).awaitTermination()
    bodies = spark.read.parquet(f"{base}/state/outputs").groupBy(F.col("note_id").cast("string").alias("note_id")).agg(
        F.count("*").alias("outputs"), F.max("body").alias("body"))
    return state.read_state(spark, f"{base}/state", "processed_log").select("note_id", "status", "ref_code").join(bodies, "note_id", "left")


_FILES, _LOGGED = 40, 30        # files of the archive query, and how many of them have all their rows of other dates logged


@query("archive_inputs", with_sql(f"""WITH {_NAMED},
    keyed AS (SELECT src_row // 8 % {_FILES} AS k, note <> '' AND date <> 'junk' AS counts, coalesce({o.PASSES}, false) AS due,
      (lower(client_name), CASE WHEN {o.PASSES} THEN '{TARGET_DATE}' ELSE strftime({o.date_sql('date')}, '%Y-%m-%d') END, note[1:100]) AS id
      FROM named),
    kept AS (SELECT k, counts, id IN (SELECT id FROM keyed WHERE counts AND (k < {_LOGGED} OR due)) AS logged FROM keyed)
    SELECT 'n' || k || '.csv' AS src_file, count(*) AS rows, count(*) FILTER (counts AND logged) AS logged,
           count(*) FILTER (counts AND NOT logged) AS waiting, count(*) FILTER (counts AND NOT logged) = 0 AS archived
    FROM kept GROUP BY k""", "rows"))
def _(spark, sf_dir):
    """Exports in named files, of which some have rows that aren't logged: only the others move, seen by listing both folders."""
    base = scratch_path(spark, "consumed")
    rows = b.rows(spark, sf_dir).withColumn("k", F.expr(f"src_row div 8 % {_FILES}"))
    heads = [("date", "Date"), ("first_name", "First Name"), ("last_name", "Last Name"), ("full_name", "Client Name"), ("note", "Note")]
    rows.select(*[F.col(c).alias(h) for c, h in heads], "k").repartition("k").write.partitionBy("k").options(
        header="true", quote='"', escape='"', ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(f"{base}/parts")
    for folder in folder_of(spark, base)[0].listStatus(folder_of(spark, f"{base}/parts")[1]):       # as many as files, so _FILES at most
        if folder.isDirectory():
            part = next(p for p in folder_of(spark, base)[0].listStatus(folder.getPath()) if p.getPath().getName().endswith(".csv"))
            move(spark, part.getPath().toString(), f"{base}/in/n{folder.getPath().getName()[2:]}.csv")
    source = notes_csv.scan_notes_csv(spark, f"{base}/in")
    states = manifest.row_states(source, TARGET_DATE)
    k = F.regexp_extract("src_file", r"\d+", 0).cast("int")
    log = states.where((k < _LOGGED) | F.col("due")).select("note_id")
    table = written(manifest.consumed_files(states, log, notes_csv.csv_files(spark, f"{base}/in")), f"{base}/manifest")
    run = daily.Run(base, "r", TARGET_DATE, archive=f"{base}/archive")
    daily.archive_files(spark, f"{base}/in", [r.src_file for r in table.where("complete").collect()], run)
    moved = [f for f in daily.input_files(spark, f"{base}/archive/{TARGET_DATE}") if not exists(spark, f"{base}/in/{f}")]
    there = spark.createDataFrame([(f,) for f in moved], "src_file string").withColumn("archived", F.lit(True))
    return table.join(there, "src_file", "left").select("src_file", "rows", "logged", "waiting", F.coalesce("archived", F.lit(False)).alias("archived"))
