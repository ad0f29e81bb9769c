"""Note-shaped frames derived from the given tables, in Spark and in SQL.

Every frame covers whole tables: one participant per customer, one note per
order, one staff member and one dictionary entry per supplier.  ``SQL`` holds
the same definitions for the comparison engine.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import read_spread

FIRST = ("Jane", "Tom", "Michael", "Harrison", "Al", "May", "David", "Priya", "Liz", "Grace",
         "Noah", "Olivia", "Ethan", "Mia", "Ruby", "Oscar", "Daniel", "Kate", "Chris", "Zoe")
LAST = ("Smith", "Brown", "Worker", "Ng", "O'Neil", "Street")
SYL_A = ("Bar", "Cal", "Den", "Fer", "Gal", "Har", "Kel", "Lan", "Mor", "Tor")
SYL_B = ("ba", "de", "fi", "go", "lu", "ma", "ne", "ri", "so", "va")
SYL_C = ("by", "ck", "ford", "ham", "ley", "man", "rin", "son", "ton", "well")
TARGET_DATE = "1998-06-15"
DICT_TYPES = ("Carer", "Organization", "Location", "Provider", "Participant")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values)).cast("int") + 1)


def _div(c: Column, n: int) -> Column:
    return F.floor(c / F.lit(n)).cast("long")


def _pad(c: Column, n: int) -> Column:
    return F.lpad(c.cast("string"), n, "0")


def roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One participant per customer, with many shared first and last names."""
    k = F.col("c_custkey")
    j = _div(k, 20)
    syllables = F.concat(_pick(SYL_A, j), _pick(SYL_B, _div(j, 10)), _pick(SYL_C, _div(j, 100)))
    first = _pick(FIRST, k)
    last = F.when(j % 25 < len(LAST), _pick(LAST, j % 25)).otherwise(syllables)
    street = F.concat((10 + k % 90).cast("string"), F.lit(" "), _pick(SYL_A, _div(k, 90)),
                      _pick(SYL_B, _div(k, 900)), F.lit(" Street"))
    return read_spread(spark, f"{sf_dir}/customer.parquet").select(
        k.alias("k"),
        F.format_string("PART-%03d", k + 1).alias("ref_code"),
        F.format_string("cl_%d", k).alias("client_id"),
        first.alias("first_name"), last.alias("last_name"),
        _pad(430000000 + k, 9).alias("ndis_number"),
        F.concat((1940 + k % 60).cast("string"), F.lit("-"), _pad(k % 12 + 1, 2), F.lit("-"),
                 _pad(k % 28 + 1, 2)).alias("date_of_birth"),
        F.concat(street, F.lit(", Melbourne VIC 3000")).alias("address"),
        F.concat(F.lit("04"), _pad(k * 7919 % 100000000, 8)).alias("phone"),
        F.concat(F.lower(first), F.lit("."), k.cast("string"), F.lit("@example.com")).alias("email"),
        street.alias("street"),
    )


def _staff_name(s: Column) -> Column:
    return F.concat(_pick(FIRST, s * 3), F.lit(" "), _pick(SYL_A, _div(s, 2)), _pick(SYL_C, s))


def staff(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _staff_name(F.col("s_suppkey"))
    return table(spark, sf_dir, "supplier").select(
        F.substring_index(name, " ", 1).alias("first_name"),
        F.substring_index(name, " ", -1).alias("last_name"))


def _entry_name(s: Column) -> Column:
    a, b, c = _pick(SYL_A, s), _pick(SYL_B, _div(s, 10)), _pick(SYL_C, _div(s, 5))
    person = F.concat(_pick(FIRST, s + 3), F.lit(" "), a, c)
    return (F.when(s % 5 == 1, F.concat(a, b, F.lit(" Health Service")))
            .when(s % 5 == 2, F.concat(a, c, F.lit(" Heights")))
            .when(s % 5 == 3, F.concat(F.lit("Dr. "), person)).otherwise(person))


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(type, name): one entry per supplier."""
    s = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        _pick(DICT_TYPES, s).alias("type"), _entry_name(s).alias("name"))


def _mentions(spark: SparkSession) -> DataFrame:
    """Names a note may mention, by the number ``m`` its template draws."""
    m = F.col("m")
    group = _div(m, 5) * 5
    return spark.range(100).withColumnRenamed("id", "m").select(
        "m", _staff_name(m).alias("worker"), _entry_name(group).alias("carer"),
        _entry_name(group + 1).alias("organization"), _entry_name(group + 2).alias("place"),
        _entry_name(group + 3).alias("provider"), _entry_name(group + 4).alias("other"))


def notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One note per order, written by eight templates, by the ordering customer."""
    o = F.col("o_orderkey")
    ph = F.col("phone")
    dob = [F.substring("date_of_birth", at, size) for at, size in ((9, 2), (6, 2), (1, 4))]
    texts = (
        F.concat("first_name", F.lit(" "), "last_name", F.lit(" attended visit "), (o % 1000).cast("string"),
                 F.lit(" with support worker "), "worker", F.lit(".")),
        F.concat(F.lit("NDIS "), "ndis_number", F.lit(" checked for "), "first_name", F.lit("'s plan at "),
                 "organization", F.lit(", "), "provider", F.lit(" and "), "other", F.lit(" present.")),
        F.concat(F.lit("DOB: "), F.concat_ws("/", *dob), F.lit(", call "), F.substring(ph, 1, 4), F.lit(" "),
                 F.substring(ph, 5, 3), F.lit(" "), F.substring(ph, 8, 3), F.lit(" or "), ph, F.lit(".")),
        F.concat(F.lit("Mail sent to "), "email", F.lit("; home "), F.upper("street"),
                 F.lit(", Box Hill, VIC 3128.")),
        F.concat(F.lit("Called (03) 9123 4567 and +61 412 345 "), _pad(o % 1000, 3), F.lit(" from "),
                 "place", F.lit(" with carer "), "carer", F.lit(".")),
        F.concat(F.lit("Ref +61412345678"), (900000000 + o).cast("string"), F.lit(" noted.")),
        F.lit("Quiet morning, painted two boards and had soup."),
    )
    note = F.when(F.col("n") == 0, texts[0])
    for n, text in enumerate(texts[1:], start=1):
        note = note.when(F.col("n") == n, text)
    orders = read_spread(spark, f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
        (o % 8).alias("n"), (_div(o, 8) % 100).alias("m"))
    people = roster(spark, sf_dir)
    return orders.join(people, orders["o_custkey"] == people["k"]).join(
        F.broadcast(_mentions(spark)), "m").select(
        o.cast("string").alias("note_id"), "client_id", "ref_code", "first_name", "last_name",
        "ndis_number", "date_of_birth",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("created_at"),
        F.concat(F.lit("f"), (o % 3).cast("string")).alias("src_file"), o.alias("src_row"),
        F.col("o_orderstatus").alias("status"), F.col("worker").alias("staff"),
        note.otherwise("  ").alias("note"))


def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export rows under the logical fields: mixed date formats and name columns."""
    n = F.col("src_row")
    day = F.to_date("created_at")
    split_names = F.col("src_file") == "f0"
    nameless = n % 11 == 0
    full = F.concat_ws(" ", "first_name", "last_name")
    date = (F.when(n % 5 == 0, F.date_format(day, "d/M/yyyy")).when(n % 5 == 1, F.col("created_at"))
            .when(n % 5 == 2, F.date_format(day, "dd/MM/yy")).when(n % 5 == 3, "").otherwise("junk"))
    return notes(spark, sf_dir).select(
        "src_file", "src_row", date.alias("date"),
        F.when(split_names & ~nameless, F.col("first_name")).otherwise("").alias("first_name"),
        F.when(split_names & ~nameless, F.col("last_name")).otherwise("").alias("last_name"),
        F.when(~split_names & ~nameless, full).otherwise("").alias("full_name"),
        F.trim("note").alias("note"),
        F.when(F.col("src_file") == "f2", "").when(n % 2 == 0, F.upper("staff")).otherwise(F.col("staff")).alias("staff"),
        F.when(F.col("src_file") == "f2", "").otherwise(F.col("ndis_number")).alias("ndis"),
        F.when(F.col("src_file") == "f2", "").otherwise(F.col("date_of_birth")).alias("dob"),
        F.lit(True).alias("has_note"), (~split_names).alias("has_full_name"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_spread(spark, f"{sf_dir}/documents.parquet").select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("note_id"), F.col("text").alias("note"))


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and every note, whole texts."""
    return documents(spark, sf_dir).unionByName(notes(spark, sf_dir).select(
        F.concat(F.lit("n"), "note_id").alias("note_id"), "note"))


def _sql_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _sql_pick(values, index: str) -> str:
    return f"({_sql_list(values)})[(({index}) % {len(values)}) + 1]"


def _sql_staff_name(s: str) -> str:
    return f"{_sql_pick(FIRST, f'{s} * 3')} || ' ' || {_sql_pick(SYL_A, f'{s} // 2')} || {_sql_pick(SYL_C, s)}"


def _sql_entry_name(s: str) -> str:
    a, b, c = _sql_pick(SYL_A, s), _sql_pick(SYL_B, f"({s}) // 10"), _sql_pick(SYL_C, f"({s}) // 5")
    person = f"{_sql_pick(FIRST, f'({s}) + 3')} || ' ' || {a} || {c}"
    return (f"CASE ({s}) % 5 WHEN 1 THEN {a} || {b} || ' Health Service' WHEN 2 THEN {a} || {c} || ' Heights' "
            f"WHEN 3 THEN 'Dr. ' || {person} ELSE {person} END")


_M = "((o_orderkey // 8) % 100)"
_M5 = f"({_M} // 5 * 5"
SQL = {
    "roster": f"""
      SELECT k, printf('PART-%03d', k + 1) AS ref_code, 'cl_' || k AS client_id, first_name,
             CASE WHEN j % 25 < {len(LAST)} THEN {_sql_pick(LAST, 'j % 25')}
                  ELSE {_sql_pick(SYL_A, 'j')} || {_sql_pick(SYL_B, 'j // 10')} || {_sql_pick(SYL_C, 'j // 100')}
             END AS last_name,
             lpad(CAST(430000000 + k AS VARCHAR), 9, '0') AS ndis_number,
             (1940 + k % 60) || '-' || lpad(CAST(k % 12 + 1 AS VARCHAR), 2, '0') || '-'
               || lpad(CAST(k % 28 + 1 AS VARCHAR), 2, '0') AS date_of_birth,
             street || ', Melbourne VIC 3000' AS address,
             '04' || lpad(CAST(k * 7919 % 100000000 AS VARCHAR), 8, '0') AS phone,
             lower(first_name) || '.' || k || '@example.com' AS email, street
      FROM (SELECT c_custkey AS k, c_custkey // 20 AS j, {_sql_pick(FIRST, 'c_custkey')} AS first_name,
                   (10 + c_custkey % 90) || ' ' || {_sql_pick(SYL_A, 'c_custkey // 90')}
                     || {_sql_pick(SYL_B, 'c_custkey // 900')} || ' Street' AS street
            FROM customer)""",
    "staff": f"""
      SELECT split_part(n, ' ', 1) AS first_name, split_part(n, ' ', -1) AS last_name
      FROM (SELECT {_sql_staff_name('s_suppkey')} AS n FROM supplier)""",
    "dictionary": f"""
      SELECT {_sql_pick(DICT_TYPES, 's_suppkey')} AS type, {_sql_entry_name('s_suppkey')} AS name FROM supplier""",
    "notes": f"""
      SELECT CAST(o_orderkey AS VARCHAR) AS note_id, client_id, ref_code, first_name, last_name, ndis_number,
             date_of_birth, strftime(o_orderdate, '%Y-%m-%d') AS created_at, 'f' || (o_orderkey % 3) AS src_file,
             o_orderkey AS src_row, o_orderstatus AS status, {_sql_staff_name(_M)} AS staff,
             CASE o_orderkey % 8
               WHEN 0 THEN first_name || ' ' || last_name || ' attended visit ' || (o_orderkey % 1000)
                 || ' with support worker ' || {_sql_staff_name(_M)} || '.'
               WHEN 1 THEN 'NDIS ' || ndis_number || ' checked for ' || first_name || '''s plan at '
                 || ({_sql_entry_name(_M5 + ' + 1)')}) || ', ' || ({_sql_entry_name(_M5 + ' + 3)')}) || ' and '
                 || ({_sql_entry_name(_M5 + ' + 4)')}) || ' present.'
               WHEN 2 THEN 'DOB: ' || substr(date_of_birth, 9, 2) || '/' || substr(date_of_birth, 6, 2) || '/'
                 || substr(date_of_birth, 1, 4) || ', call ' || phone[1:4] || ' ' || phone[5:7] || ' '
                 || phone[8:10] || ' or ' || phone || '.'
               WHEN 3 THEN 'Mail sent to ' || email || '; home ' || upper(street) || ', Box Hill, VIC 3128.'
               WHEN 4 THEN 'Called (03) 9123 4567 and +61 412 345 ' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0')
                 || ' from ' || ({_sql_entry_name(_M5 + ' + 2)')}) || ' with carer '
                 || ({_sql_entry_name(_M5 + ')')}) || '.'
               WHEN 5 THEN 'Ref +61412345678' || (900000000 + o_orderkey) || ' noted.'
               WHEN 6 THEN 'Quiet morning, painted two boards and had soup.'
               ELSE '  ' END AS note
      FROM orders JOIN fx_roster ON o_custkey = k""",
    "rows": """
      SELECT src_file, src_row,
             CASE src_row % 5
               WHEN 0 THEN day(d) || '/' || month(d) || '/' || year(d) WHEN 1 THEN created_at
               WHEN 2 THEN strftime(d, '%d/%m/%y') WHEN 3 THEN '' ELSE 'junk' END AS date,
             CASE WHEN src_file = 'f0' AND src_row % 11 <> 0 THEN first_name ELSE '' END AS first_name,
             CASE WHEN src_file = 'f0' AND src_row % 11 <> 0 THEN last_name ELSE '' END AS last_name,
             CASE WHEN src_file <> 'f0' AND src_row % 11 <> 0 THEN first_name || ' ' || last_name ELSE '' END AS full_name,
             trim(note) AS note,
             CASE WHEN src_file = 'f2' THEN '' WHEN src_row % 2 = 0 THEN upper(staff) ELSE staff END AS staff,
             CASE WHEN src_file = 'f2' THEN '' ELSE ndis_number END AS ndis,
             CASE WHEN src_file = 'f2' THEN '' ELSE date_of_birth END AS dob
      FROM (SELECT *, CAST(created_at AS DATE) AS d FROM fx_notes)""",
    "corpus": """
      SELECT 'd' || doc_id AS note_id, text AS note FROM documents
      UNION ALL SELECT 'n' || note_id, note FROM fx_notes""",
}


def with_sql(body: str, *names: str) -> str:
    """Prefix a query with the definitions it needs (as ``fx_<name>``)."""
    needed = {"corpus": ("roster", "notes"), "notes": ("roster",), "rows": ("roster", "notes")}
    order = []
    for name in names:
        for part in (*needed.get(name, ()), name):
            if part not in order:
                order.append(part)
    ctes = ",\n".join(f"fx_{n} AS MATERIALIZED ({SQL[n]})" for n in order)
    body = body.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
