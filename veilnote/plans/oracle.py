"""Comparison SQL for the registered queries.

Written for an engine without the candidate joins of the Spark side: known
values are compared with every text by substring search, names through the
first word of each form, and all folds run as list reductions.
"""
from __future__ import annotations

from ..fixed_values import (
    ADDRESS_PATTERN, ADDRESS_STOP_WORDS, DICTIONARY_TYPES, DOB_PATTERN, EMAIL_PATTERN, GENERIC_TERMS,
    NDIS_PATTERN, NICKNAMES, PHONE_PATTERNS, SPAN_PRIORITY, SPAN_TAG, STATES, STREET_PART_PATTERN,
    SUBURB_POSTCODE_PATTERN, TITLES,
)
from .bindings import TARGET_DATE, with_sql

_GENERIC = "(" + ", ".join(f"'{t}'" for t in GENERIC_TERMS) + ")"
_NICK = "CASE {w} " + " ".join(f"WHEN '{f}' THEN ['{s}'] WHEN '{s}' THEN ['{f}']" for f, s in NICKNAMES.items()) + " ELSE [] END"


def found(values: str) -> str:
    """A list of strings as sorted distinct text."""
    return f"array_to_string(list_sort(list_distinct({values})), '|')"


def ext(pattern: str, text: str = "note", group: int = 0) -> str:
    return f"regexp_extract_all({text}, '{pattern}', {group})"


def ndis(t="note"):
    return f"list_distinct({ext(NDIS_PATTERN, t)})"


def phones(t="note"):
    return "list_distinct(" + " || ".join(ext(p, t) for p in PHONE_PATTERNS) + ")"


def emails(t="note"):
    return f"list_distinct({ext(EMAIL_PATTERN, t)})"


def dob_all(t="note"):
    return ext("(?i)" + DOB_PATTERN, t)


def addresses(t="note"):
    stop = "|".join(ADDRESS_STOP_WORDS)
    return f"list_distinct(list_filter({ext(ADDRESS_PATTERN, t)}, lambda a: NOT regexp_matches(lower(a), '{stop}')))"


def states(t="note"):
    names = "[" + ", ".join(f"'{s}'" for s in STATES) + "]"
    return f"list_filter({names}, lambda s: regexp_matches({t}, '\\b' || s || '\\b'))"


def suburbs(t="note"):
    g1, g2 = ext(SUBURB_POSTCODE_PATTERN, t, 1), ext(SUBURB_POSTCODE_PATTERN, t, 2)
    pairs = f"list_zip({g1}, {g2})"
    kept = (f"list_filter({pairs}, lambda p: CAST(p[2] AS INT) BETWEEN 200 AND 9999 "
            f"AND NOT CAST(p[2] AS INT) BETWEEN 2020 AND 2030)")
    return (f"list_distinct(flatten(list_transform({kept}, lambda p: CASE WHEN lower(p[1]) IN {_GENERIC} "
            f"THEN [p[2]] ELSE [p[1], p[2]] END)))")


def locations(t="note"):
    return f"list_distinct({addresses(t)} || {states(t)} || {suburbs(t)})"


# --- names -------------------------------------------------------------------

def variants(name: str) -> str:
    """Scalar subquery: list of surface forms of a name column."""
    title = "^(?:" + "|".join(TITLES) + r")\.? "
    return f"""(SELECT list_distinct(flatten(list_transform(
        CASE WHEN len(w) >= 2 THEN [n0, c]
               || list_filter([w[1]], lambda v: length(v) > 2 AND NOT regexp_full_match(v, '(?:{"|".join(TITLES)})\\.?'))
               || list_filter([w[-1]], lambda v: length(v) > 2) || {_NICK.format(w="w[1]")}
             ELSE list_filter([c], lambda v: length(v) > 2) END,
        lambda v: [v, v || '''s'])))
      FROM (SELECT n0, c, list_filter(string_split(c, ' '), lambda x: x <> '') AS w
            FROM (SELECT {name} AS n0, trim(regexp_replace(trim({name}), '{title}', '')) AS c)))"""


def usable(form: str) -> str:
    return f"(length({form}) > 2 AND lower({form}) NOT IN {_GENERIC})"


FORMS = f"""
pforms AS (SELECT form, ref_code, k FROM (
    SELECT unnest({variants("fn")}) AS form, ref_code, k
    FROM (SELECT first_name || ' ' || last_name AS fn, ref_code, k FROM fx_roster)) WHERE {usable("form")}),
dict1 AS (SELECT form, arg_max(ref_code, k) AS ref_code, min(ref_code) <> max(ref_code) AS ambiguous, min(k) + 1 AS first_pos
          FROM pforms GROUP BY form),
sforms AS (SELECT DISTINCT form FROM (
    SELECT unnest({variants("fn")}) AS form
    FROM (SELECT first_name || ' ' || last_name AS fn FROM fx_staff)) WHERE {usable("form")})"""

SURFACES = f"""
surf AS (SELECT DISTINCT type, unnest(CASE WHEN type IN ('Carer', 'Provider', 'Participant')
                THEN [name] || {variants("name")} ELSE [name] END) AS surface
         FROM fx_dictionary WHERE name <> '')"""

_PASS = "CASE type " + " ".join(f"WHEN '{t}' THEN {40 + i}" for i, t in enumerate(DICTIONARY_TYPES)) + " END"
_TAG = "CASE type " + " ".join(f"WHEN '{t}' THEN '{v[0]}'" for t, v in DICTIONARY_TYPES.items()) + " END"
_LABEL = "CASE type " + " ".join(f"WHEN '{t}' THEN '{v[1]}'" for t, v in DICTIONARY_TYPES.items()) + " END"

WORD_STEPS = {
    "participants": "SELECT 1 AS p, form, ref_code AS tag, 'NAME→' || ref_code AS label, first_pos FROM dict1",
    "staff": "SELECT 2 AS p, form, '[STAFF_NAME]' AS tag, 'STAFF_NAME' AS label, 0 AS first_pos FROM sforms",
    "dictionary": f"""SELECT {_PASS} AS p, surface AS form, {_TAG} AS tag, {_LABEL} AS label, 0 AS first_pos FROM surf
        WHERE length(surface) > 2 AND (type = 'Organization' OR lower(surface) NOT IN {_GENERIC})""",
}


def start_cte() -> str:
    return f"""w0 AS (SELECT note_id, note AS text, {locations()} AS locs, []::VARCHAR[] AS hits FROM fx_corpus)"""


def _fold(src: str, steps: str, out: str) -> str:
    """Fold ordered steps (note_id, o1, o2, o3, o4, form, tag, label, pat, once)."""
    return f"""
{out} AS (SELECT note_id, coalesce(r.text, text) AS text, locs, hits || coalesce(r.hits, []) AS hits FROM (
    SELECT {src}.*, list_reduce(s.steps, lambda a, x:
        CASE WHEN regexp_matches(a.text, x.pat) THEN
          {{'text': regexp_replace(a.text, x.pat, x.tag, 'g'),
            'hits': a.hits || [x.label || '#' || CASE WHEN x.once THEN 1 ELSE len(regexp_extract_all(a.text, x.pat)) END],
            'pat': '', 'tag': '', 'label': '', 'once': false}} ELSE a END,
        {{'text': {src}.text, 'hits': []::VARCHAR[], 'pat': '', 'tag': '', 'label': '', 'once': false}}) AS r
    FROM {src} LEFT JOIN (
      SELECT note_id, list({{'text': '', 'hits': []::VARCHAR[], 'pat': pat, 'tag': tag, 'label': label, 'once': once}}
                           ORDER BY o1, o2, o3, o4, form, tag) AS steps
      FROM ({steps}) GROUP BY note_id) s USING (note_id)))"""


def word_fold(src: str, steps: str, out: str) -> str:
    """Word forms: first-word join, then substring test, then the fold."""
    sel = " UNION ALL ".join(WORD_STEPS[k] for k in steps.split(","))
    return f"""
{out}_f AS MATERIALIZED (SELECT p, arg_min(form, (first_pos, form, tag)) AS form, arg_min(tag, (first_pos, form, tag)) AS tag,
      arg_min(label, (first_pos, form, tag)) AS label, min(first_pos) AS first_pos FROM ({sel}) GROUP BY p, lower(form)),
{out}_k AS MATERIALIZED (SELECT *, list_filter(string_split_regex(lower(form), '\\W+'), lambda t: t <> '')[1] AS k FROM {out}_f),
{out}_t AS MATERIALIZED (SELECT DISTINCT note_id, k FROM (
      SELECT note_id, unnest(string_split_regex(lower(text), '\\W+')) AS k FROM {src})
      WHERE k IN (SELECT k FROM {out}_k)),
{_fold(src, f'''SELECT note_id, p AS o1, -length(form) AS o2, first_pos AS o3, 0 AS o4, form, tag, label,
        '(?i)\\b' || regexp_escape(form) || '\\b' AS pat, false AS once
      FROM {out}_t JOIN {out}_k USING (k) JOIN {src} USING (note_id) WHERE contains(lower(text), lower(form))''', out).strip()}"""


_STREET = f"regexp_extract(address, '(?i)^{STREET_PART_PATTERN}', 1)"
_DOB_FORMS = "flatten(list_transform(['/', '-', '.'], lambda s: [d || s || m || s || y, d || s || m || s || y[3:], m || s || d || s || y]))"
VALUE_STEPS = {
    "ndis": """SELECT note_id, k AS o2, 1 AS o3, 0 AS o4, ndis_number AS form, '[NDIS_REDACTED]' AS tag, 'NDIS' AS label,
          '\\b' || ndis_number || '\\b' AS pat, true AS once
        FROM (SELECT note_id, unnest(list_distinct(regexp_extract_all(text, '\\d{9}'))) AS ndis_number FROM {src})
        JOIN fx_roster USING (ndis_number)""",
    "dob": f"""SELECT note_id, k AS o2, 2 AS o3, o4, form, '[DOB]' AS tag, 'DOB' AS label, regexp_escape(form) AS pat, true AS once
        FROM (SELECT form, min(k) AS k, arg_min(o4, (k, o4)) AS o4 FROM (SELECT k, unnest({_DOB_FORMS}) AS form, unnest(range(9)) AS o4
              FROM (SELECT k, date_of_birth[1:4] AS y, date_of_birth[6:7] AS m, date_of_birth[9:10] AS d FROM fx_roster))
              GROUP BY form)
        JOIN (SELECT * FROM {{src}} WHERE regexp_matches(text, '\\d\\d[/.-]\\d\\d[/.-]\\d\\d')) ON contains(text, form)""",
    "phone": """SELECT note_id, k AS o2, 3 AS o3, 0 AS o4, phone AS form, '[PHONE]' AS tag, 'PHONE' AS label, phone AS pat, true AS once
        FROM fx_roster JOIN (SELECT * FROM {src} WHERE regexp_matches(text, '04\\d{8}')) ON contains(text, phone)""",
    "email": """SELECT note_id, k AS o2, 4 AS o3, 0 AS o4, email AS form, '[EMAIL]' AS tag, 'EMAIL' AS label,
          '(?i)' || regexp_escape(email) AS pat, false AS once
        FROM fx_roster JOIN (SELECT * FROM {src} WHERE contains(lower(text), '@example.com')) ON contains(lower(text), email)""",
    "address": f"""SELECT note_id, k AS o2, 5 AS o3, 0 AS o4, form, '[ADDRESS]' AS tag, 'ADDRESS' AS label,
          '(?i)' || regexp_escape(form) AS pat, false AS once
        FROM (SELECT min(k) AS k, {_STREET} AS form FROM fx_roster WHERE length(address) > 8 GROUP BY form)
        JOIN (SELECT * FROM {{src}} WHERE regexp_matches(text, '[0-9][0-9]\\s')) ON contains(lower(text), lower(form))
        WHERE form <> ''""",
}


def value_fold(src: str, kinds: str, out: str) -> str:
    steps = " UNION ALL ".join(VALUE_STEPS[k].replace("{src}", src) for k in kinds.split(","))
    return _fold(src, f"SELECT 3 AS o1, * FROM ({steps})", out).strip()


# --- spans -------------------------------------------------------------------

def literals(src: str) -> str:
    """(note_id, text, label, rank, pri, v, pat) of every literal to sweep."""
    rank = list(SPAN_TAG)

    def part(label, values, pat):
        return (f"SELECT note_id, text, '{label}' AS label, {rank.index(label)} AS rank, {SPAN_PRIORITY[label]} AS pri, v, "
                f"{pat} AS pat FROM (SELECT note_id, text, unnest({values}) AS v FROM {src})")
    esc = "regexp_escape(v)"
    return " UNION ALL ".join([
        part("NDIS", ndis("text"), esc), part("PHONE", phones("text"), esc),
        part("EMAIL", emails("text"), f"'(?i)' || {esc}"),
        part("LOCATION", "locs", f"'(?i)\\b' || {esc} || '\\b'")])


def spans(src: str, out: str) -> str:
    """(note_id, st, en, pri, rank, label), one row per occurrence."""
    rank = list(SPAN_TAG)
    return f"""
{out} AS (
  SELECT note_id, st, st + length(v) AS en, pri, rank, label FROM (
    SELECT *, unnest(list_transform(range(1, len(pieces)), lambda i:
        CAST(list_sum(list_transform(pieces[1:i], lambda p: length(p))) + (i - 1) * length(v) AS BIGINT))) AS st
    FROM (SELECT *, string_split_regex(text, pat) AS pieces FROM ({literals(src)})))
  UNION ALL
  SELECT note_id, st, st + ln AS en, {SPAN_PRIORITY["DOB"]}, {rank.index("DOB")}, 'DOB' FROM (
    SELECT note_id, unnest(list_transform(range(1, len(pieces)), lambda i:
        CAST(list_sum(list_transform(pieces[1:i], lambda p: length(p)))
             + coalesce(list_sum(list_transform(ms[1:i - 1], lambda m: length(m))), 0) AS BIGINT))) AS st,
      unnest(list_transform(ms, lambda m: length(m))) AS ln
    FROM (SELECT note_id, string_split_regex(text, '(?i){DOB_PATTERN}') AS pieces, {dob_all("text")} AS ms
          FROM {src} WHERE regexp_matches(text, '(?i){DOB_PATTERN}'))))"""


def merged(src: str, out: str) -> str:
    """Ordered lists of merged spans per note."""
    last = "a.s[len(a.s)]"
    return f"""
{out} AS (SELECT note_id, list_reduce(xs, lambda a, x:
    CASE WHEN len(a.s) = 0 OR x.s[1].st >= {last}.en THEN {{'s': a.s || x.s}}
         WHEN x.s[1].pri < {last}.pri THEN {{'s': a.s[1:len(a.s) - 1] || x.s}}
         WHEN x.s[1].pri = {last}.pri AND x.s[1].en > {last}.en
           THEN {{'s': a.s[1:len(a.s) - 1] || [{{'st': {last}.st, 'en': x.s[1].en, 'pri': {last}.pri, 'label': {last}.label}}]}}
         ELSE a END).s AS ms
  FROM (SELECT note_id, list({{'s': [{{'st': st, 'en': en, 'pri': pri, 'label': label}}]}} ORDER BY st, pri, en DESC, rank) AS xs
        FROM {src} GROUP BY note_id))"""


def spliced(src: str, merged_cte: str, out: str) -> str:
    tag = "CASE sp.label " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SPAN_TAG.items()) + " END"
    return f"""
{out} AS (SELECT note_id, locs,
    CASE WHEN ms IS NULL THEN text ELSE array_to_string(list_transform(ms, lambda sp, i:
        text[CASE WHEN i = 1 THEN 1 ELSE ms[i - 1].en + 1 END : sp.st] || {tag}), '') || text[ms[len(ms)].en + 1:] END AS text,
    hits || coalesce(list_transform(list_reverse(ms), lambda m: m.label || '#1'), []) AS hits
  FROM {src} LEFT JOIN {merged_cte} USING (note_id))"""


def patterns(src: str, out: str) -> str:
    return f"{spans(src, out + '_s').strip()}, {merged(out + '_s', out + '_m').strip()}, {spliced(src, out + '_m', out).strip()}"


_REASONS = [("Residual NDIS-pattern numbers in output: ", ndis), ("Residual phone numbers in output: ", phones),
            ("Residual email addresses in output: ", emails)]


def reason(t: str = "text") -> str:
    return "CASE " + " ".join(
        f"WHEN len({f(t)}) > 0 THEN '{words}[' || array_to_string(list_transform(list_sort({f(t)}), lambda v: '''' || v || ''''), ', ') || ']'"
        for words, f in _REASONS) + " END"


def counted(src: str) -> str:
    """Totals per label as sorted text, joined to the rows of src."""
    return f"""
tot AS (SELECT note_id, string_agg(label || '=' || n, ';' ORDER BY label || '=' || n) AS counts FROM (
    SELECT note_id, split_part(h, '#', 1) AS label, sum(CAST(split_part(h, '#', 2) AS BIGINT)) AS n
    FROM (SELECT note_id, unnest(hits) AS h FROM {src}) GROUP BY ALL) GROUP BY note_id)"""


def pass_sql(*chain: str, last: str, names=()) -> str:
    body = ",\n".join([start_cte(), *[c.strip() for c in chain], counted(last).strip()])
    return with_sql(
        f"WITH {body}\nSELECT note_id, text, coalesce(counts, '') AS counts FROM {last} LEFT JOIN tot USING (note_id)",
        "corpus", *names)


def deidentify_chain() -> tuple[str, ...]:
    return (FORMS, SURFACES, word_fold("w0", "participants,staff", "w1"),
            value_fold("w1", "ndis,dob,phone,email,address", "w2"), word_fold("w2", "dictionary", "w3"), patterns("w3", "w4"))


def notes_ctes(where: str) -> str:
    """All passes over notes, ending in w4."""
    start = (f"w0 AS (SELECT note_id, note AS text, {locations()} AS locs, []::VARCHAR[] AS hits "
             f"FROM fx_notes WHERE {where})")
    return ",\n".join([start, *[c.strip() for c in deidentify_chain()]])


def deidentify_sql(select: str) -> str:
    body = ",\n".join([start_cte(), *[c.strip() for c in deidentify_chain()], counted("w4").strip(),
                       f"done AS (SELECT note_id, text, coalesce(counts, '') AS counts, {reason()} AS reason "
                       f"FROM w4 LEFT JOIN tot USING (note_id))"])
    return with_sql(f"WITH {body}\n{select}", "corpus", "staff", "dictionary")


def date_sql(d: str) -> str:
    """Date of a mixed-format cell, or null."""
    return f"""(CASE
      WHEN regexp_full_match({d}, '\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}')
        THEN coalesce(try_strptime({d}, '%d/%m/%Y'), try_strptime({d}, '%m/%d/%Y'))
      WHEN regexp_full_match({d}, '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN try_strptime({d}, '%Y-%m-%d')
      WHEN regexp_full_match({d}, '\\d{{1,2}}/\\d{{1,2}}/\\d{{2}}') THEN try_strptime({d}, '%d/%m/%y') END)::DATE"""


PASSES = f"(date = '' OR coalesce({date_sql('date')} = DATE '{TARGET_DATE}', false))"
