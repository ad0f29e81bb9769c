import random
import re

import pytest
from pyspark.sql import functions as F

import brute
from veilnote.operators import deidentify as D
from veilnote.operators import matching
from veilnote.operators.surfaces import dictionary_surfaces
from veilnote.plans import bindings as B

COLS = ["ref_code", "first_name", "last_name", "ndis_number", "date_of_birth", "address", "phone", "email"]
P1 = ("PART-001", "Petra", "Holt", "431287650", "1968-10-24", "17 Harbour Street, Melbourne VIC 3000",
      "0437218906", "petra.holt@example.com")
P2 = ("PART-002", "Ivo", "Lund", "562198437", "1979-11-30", "", "", "")
STAFF = [("Mara", "Quill")]
WHOLE = ("Petra Holt (NDIS: 431287650, DOB: 24/10/1968) came to the group at "
         "17 Harbour Street, Melbourne VIC 3000. Helper Mara Quill was there. "
         "Petra's sister rang from 0437 218 906. Ivo Lund looked in later. "
         "Forms went to petra.holt@example.com.")
WHOLE_OUT = ("PART-001 (NDIS: [NDIS_REDACTED], DOB: [DOB]) came to the group at [ADDRESS], "
             "Melbourne [LOCATION] 3000. Helper [STAFF_NAME] was there. PART-001 sister "
             "rang from [PHONE]. PART-002 looked in later. Forms went to [EMAIL].")


def run(spark, notes, people, staff=(), surfaces=(), **kw):
    rows = spark.createDataFrame(list(enumerate(notes)), "note_id long, note string")
    roster = spark.createDataFrame(people, ", ".join(f"{c} string" for c in COLS))
    helpers = spark.createDataFrame(list(staff), "first_name string, last_name string") if staff else None
    words = dictionary_surfaces(spark.createDataFrame(list(surfaces), "type string, name string")) if surfaces else None
    out = D.deidentify(rows, roster, helpers, words, **kw).orderBy("note_id").collect()
    return [(r.deidentified_text, {c.label: c.n for c in r.counts}, r.quarantine_reason) for r in out]


def expect(notes, people, staff=(), surfaces=()):
    people = [dict(zip(COLS, p)) for p in people]
    staff = [dict(zip(("first_name", "last_name"), s)) for s in staff]
    return [brute.deidentify(n, people, staff, surfaces) for n in notes]


def test_whole_note(spark):
    (text, counts, reason), = run(spark, [WHOLE], [P1, P2], STAFF)
    assert text == WHOLE_OUT and reason is None
    assert list(counts.items()) == [
        ("NAME→PART-001", 4), ("NAME→PART-002", 1), ("STAFF_NAME", 1), ("NDIS", 1), ("DOB", 1),
        ("ADDRESS", 1), ("EMAIL", 1), ("PHONE", 1), ("LOCATION", 1)]


def test_single_passes(spark):
    got = run(spark, ["Number 431287650 is on file.", "Ring 0437 218 906.",
                      "Email: petra.holt@example.com", "DOB: 24/10/1968",
                      "Petra planned a walk with Ivo Lund.",
                      "Helper Mara Quill cooked lunch.",
                      "+61412345678901234567"], [P1, P2], STAFF)
    assert [g[0] for g in got] == [
        "Number [NDIS_REDACTED] is on file.", "Ring [PHONE].", "Email: [EMAIL]", "DOB: [DOB]",
        "PART-001 planned a walk with PART-002.",
        "Helper [STAFF_NAME] cooked lunch.", "[PHONE]901234567"]
    assert got[-1][2] == "Residual NDIS-pattern numbers in output: ['901234567']"
    assert got[2][1] == {"NAME→PART-001": 2, "EMAIL": 1}


def test_clean_text_is_stable(spark):
    clean = "A calm afternoon with cards and tea."
    assert run(spark, [clean], [P1, P2]) == [(clean, {}, None)]
    assert run(spark, ["Ref: 640017259"], [P1]) == [("Ref: [NDIS_REDACTED]", {"NDIS": 1}, None)]


FIRST = ["Petra", "Tom", "Part", "Michael", "Anne Marie", "Al", "May", "Liz", "Zoë", "JANE"]
LAST = ["Holt", "Brown", "Part", "O'Neil", "Holt-Jones", "Claire B", "Street", "007", "(Snr)"]


def world(seed):
    rnd = random.Random(seed)
    people = []
    for i in range(25):
        first, last = rnd.choice(FIRST), rnd.choice(LAST)
        people.append((f"PART-{i + 1:03d}", first, last, "N/A" if i in (3, 17) else rnd.choice(["", str(430000000 + i)]),
                       rnd.choice(["", f"19{60 + i}-0{i % 9 + 1}-1{i % 10}", "24/10/1968", "--"]),
                       rnd.choice(["", f"{i} Andrew Street, Box Hill", "42 Forest Road", "short"]),
                       rnd.choice(["", f"04{i:08d}", f"(03) 9123 40{i:02d}", "04" + "1" * 8, "-"]),
                       rnd.choice(["", f"{first}.{i}@example.com".lower().replace(" ", ""), "a@localhost"])))
    staff = [(rnd.choice(FIRST), rnd.choice(["Worker", "Ng", "Barby", "001"])) for _ in range(6)]
    surfaces = [("Carer", "Margaret Holt"), ("Organization", "World Organization"), ("Organization", "Health"),
                ("Location", "Box Hill"), ("Location", "Location"), ("Location", "007 Hill Road"),
                ("Provider", "Dr. Mara Quill"), ("Participant", "Sam Lee"), ("Organization", "***"),
                ("Location", "ew Street"), ("Carer", "Foo [")]
    bits = (FIRST + LAST + [p[c] for p in people for c in range(3, 8) if p[c]] + dob_bits(people)
            + ["Margaret", "Margaret Holt's", "World Organization", "health", "BOX HILL", "Sam", "Lee", "Alex",
               "Hill Road", "007 Hill Road", "***", "NSW", "nsw", "Box Hill, VIC 3128", "0412 345 678",
               "+61412345678901234567", "431287650", "x@y.com", "DOB: 1/2/1990", "part", "Part 003", "visit"])
    notes = []
    for _ in range(120):
        seps = [rnd.choice([" ", " ", " ", ", ", "'s ", "", "-", " / ", "\n", "."]) for _ in range(8)]
        notes.append("".join(rnd.choice(bits) + s for s in seps))
    return notes, people, staff, surfaces


def dob_bits(people):
    return [f for p in people[:8] for f in brute.dob_forms(p[4])[:4] if f and f not in ("//", "--", "..")]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_notes_equal_brute_force(spark, seed):
    notes, people, staff, surfaces = world(seed)
    got = run(spark, notes, people, staff, surfaces)
    want = expect(notes, people, staff, surfaces)
    for note, g, w in zip(notes, got, want):
        assert g == w, note


def shared(seed):
    """Id numbers with three to six holders, glued to short phones and dates that are replaced in between."""
    rnd = random.Random(seed)
    ids = ["430123456", "N/A", "77-1", "A1"]
    people = [(f"PART-{i + 1:03d}", "Fn" + chr(97 + i), "Ln" + chr(97 + i), ids[0] if i in (0, 9) else rnd.choice([*ids, ""]),
               rnd.choice(["", "2001-02-03"]), rnd.choice(["", "12 Reed Street, Kew"]),
               rnd.choice(["", "XA", "3012", "7", "0412"]), rnd.choice(["", "q@r.s"])) for i in range(14)]
    bits = [*ids, "XA", "3012", "7", "0412", "03/02/2001", "q@r.s", "12 Reed Street", "X", "_", "-", " ", "a"]
    return ["".join(rnd.choice(bits) for _ in range(7)) for _ in range(250)], people


@pytest.mark.parametrize("seed", [11, 12])
def test_shared_ids_equal_brute_force(spark, seed):
    notes, people = shared(seed)
    for note, g, w in zip(notes, run(spark, notes, people), expect(notes, people)):
        assert g == w, note


def test_third_holder_of_an_id(spark):
    people = [(f"PART-00{i}", "", "", "430123456" if i % 2 else "", "", "", {2: "XA", 4: "3012"}.get(i, ""), "") for i in range(1, 6)]
    (text, counts, _), = run(spark, ["430123456 XA430123456"], people)
    assert text == "[NDIS_REDACTED] [PHONE][NDIS_REDACTED]" and counts == {"NDIS": 2, "PHONE": 1}


def test_next_holders_over_blocks(spark):
    rnd = random.Random(3)
    held = {p: sorted(rnd.sample(range(60_000), n)) for p, n in (("x", 3), ("y", 400))}
    asked = [(p, rnd.choice([rnd.randrange(70_000), rnd.choice(held[p])])) for p in "xy" for _ in range(200)]
    turns = matching.next_holders(
        spark.createDataFrame(asked, "pattern string, after long").distinct(),
        spark.createDataFrame([(p, h) for p in held for h in held[p]], "pattern string, major long")).collect()
    want = {(p, a): next((h for h in held[p] if h > a), None) for p, a in asked}
    assert {(r.pattern, r.after): r.turn for r in turns} == {k: v for k, v in want.items() if v is not None}


def test_equal_length_names_follow_the_first_holder(spark):
    people = [("PART-001", "Ina", "Smith") + ("",) * 5, ("PART-002", "Bob", "SMITH") + ("",) * 5]
    got = run(spark, ["Mr Smith came."], people)
    assert got == expect(["Mr Smith came."], people) and got[0][0] == "Mr PART-001 came."


def test_shuffle_path_equals_broadcast_path(spark, monkeypatch):
    notes, people, staff, surfaces = world(4)
    monkeypatch.setattr(matching, "fits_broadcast", lambda *a: False)
    assert run(spark, notes, people, staff, surfaces) == expect(notes, people, staff, surfaces)


def test_hot_keys_are_split(spark, monkeypatch):
    """A third of the notes hold one first name, a ninth another: both are dealt out, and no link is lost."""
    monkeypatch.setattr(matching, "fits_broadcast", lambda *a: False)
    names = ["Ina"] * 300 + ["Bob"] * 100 + [f"Name{'abcdefghij'[k % 10]}{'abcdefghij'[k // 10 % 10]}" for k in range(500)]
    notes = spark.createDataFrame([(f"n{k:04d}", f"{name} came.") for k, name in enumerate(names)], "note_id string, text string")
    steps = [(0, name, "T", "L", k) for k, name in enumerate(sorted(set(names)))]
    forms = matching.word_forms(spark.createDataFrame(steps, "pass_no int, form string, tag string, label string, first_pos long"), codes=False)
    exploded = notes.select("note_id", F.explode(matching.word_keys(F.col("text"), forms)).alias("key")).where("key <> 'came'")
    left, right = matching.split_hot_keys(exploded, forms.table)
    dealt = {(r.key, r.salt): r["count"] for r in left.groupBy("key", "salt").count().collect()}
    copies = {r.key: r["count"] for r in right.groupBy("key").count().collect()}
    assert (copies["ina"], copies["bob"]) == (3, 1) and sum(copies.values()) == len(steps) + 2
    assert sum(dealt.values()) == len(names) and max(dealt.values()) <= 2 * len(names) / 8
    found = matching.matches(notes, forms, matching.word_keys, "form")
    assert {(r.note_id, r.form) for r in found.collect()} == {(f"n{k:04d}", name) for k, name in enumerate(names)}
    assert found.count() == len(names)


def test_only_keys_of_forms_are_joined(spark, monkeypatch):
    """Without a broadcast, keys that no form has are dropped before the join, and none that a form has, however full the bits."""
    monkeypatch.setattr(matching, "fits_broadcast", lambda *a: False)
    words = ["".join("abcdefghij"[k // 10 ** i % 10] for i in range(4)) for k in range(2000)]
    steps = [(0, w, "T", "L", k) for k, w in enumerate(words[:200])]
    forms = matching.word_forms(spark.createDataFrame(steps, "pass_no int, form string, tag string, label string, first_pos long"), codes=False)
    assert forms.rows == 200
    exploded = spark.createDataFrame([(f"n{k}", w) for k, w in enumerate(words)], "note_id string, key string")
    kept = {r.key for r in matching.keys_of_forms(exploded, forms).collect()}
    assert set(words[:200]) <= kept and len(kept) < 500
    monkeypatch.setattr(matching, "_SLOTS", 1)
    assert set(words[:200]) <= {r.key for r in matching.keys_of_forms(exploded, forms).collect()}


VALUE_STEP = "pass_no int, major bigint, kind bigint, variant int, form string, tag string, label string, pattern string, once boolean"


def value_forms_of(spark, forms):
    return matching.value_forms(spark.createDataFrame(
        [(3, k, 1, 0, f, "T", "L", re.escape(f), False) for k, f in enumerate(forms)], VALUE_STEP))


def test_only_grams_of_known_shapes_are_keys(spark):
    """A long number gives no key where the forms are dates, and a date gives one."""
    forms = value_forms_of(spark, ["01/02/1980", "11-12-1999", "jo@b.example", "mary.ann@b.example"])
    texts = [("Ref 123456789012345678 noted", []), ("on 01/02/1980.", ["01/02/1980"]), ("1101-02-1980", ["01-02-1980"]),
             ("(03) 1234 5678", []), ("to x.jo@b.example", ["jo@b"])]
    rows = spark.createDataFrame([(t,) for t, _ in texts], "text string").select("text", matching.value_keys(F.col("text"), forms).alias("keys")).collect()
    assert {r.text: r["keys"] for r in rows} == dict(texts)


@pytest.mark.parametrize("most", [0, 2, 32])
def test_shapes_lose_no_value(spark, monkeypatch, most):
    """Forms of few and of many shapes, with signs, other scripts and digits, are found wherever they are in a text."""
    monkeypatch.setattr(matching, "_SHAPES", most)
    rng = random.Random(most)
    make = lambda n: "".join(rng.choice(["1", "2", "\u0663", "a", "\u00e9", "\u4e2d", "/", "\\", " ", "+", "(", "$", "{", "|", "\U0001f600"]) for _ in range(n))
    forms = sorted({rng.choice(["1", "22", "\u0663", "+", "("]) + make(rng.randrange(1, 20)) for _ in range(60)} | {"a.b@c.example", "1980-01-02", "1981-01-02"})
    texts = [make(rng.randrange(6)) + rng.choice(forms) + make(rng.randrange(6)) + rng.choice(forms) for _ in range(300)]
    notes = spark.createDataFrame(list(enumerate(texts)), "note_id long, text string")
    found = [(r.note_id, r.form) for r in matching.matches(notes, value_forms_of(spark, forms), matching.value_keys, "form").collect()]
    assert sorted(found) == sorted((k, f) for k, t in enumerate(texts) for f in forms if f in t)


def test_runs_start_at_words_of_forms(spark):
    """Of the words of a note only those that a form begins with are put together to runs; each form counts once for a note, also where notes share an id."""
    steps = [(0, f, "T", "L", k) for k, f in enumerate(["Jo", "Jo Ann Lee", "Ann Lee", "Mara Quill"])]
    forms = matching.word_forms(spark.createDataFrame(steps, "pass_no int, form string, tag string, label string, first_pos long"), codes=False)
    notes = spark.createDataFrame([(1, "Then Jo saw Jo Ann Lee at noon, with many other people there."), (2, "Mara"), (3, "Mara Quill"), (3, "Mara Quill"), (4, None)],
                                  "note_id long, text string")
    keys = sorted((r.note_id, r.key) for r in matching.note_keys(notes, F.col("text"), forms, matching.word_keys, "note_id").collect())
    assert keys == [(1, "ann lee"), (1, "jo"), (1, "jo"), (1, "jo ann lee"), (1, "jo saw jo"), (3, "mara quill"), (3, "mara quill")]
    found = sorted((r.note_id, r.form) for r in matching.matches(notes, forms, matching.word_keys, "form").collect())
    assert found == [(1, "Ann Lee"), (1, "Jo"), (1, "Jo Ann Lee")] + [(3, "Mara Quill")] * 4


def test_keys_of_a_text_are_made_once(spark):
    """No filter makes the list of keys a second time, and candidates are shuffled only once on their way to their notes."""
    steps = spark.createDataFrame([(0, "Mara Quill", "T", "L", 0)], "pass_no int, form string, tag string, label string, first_pos long")
    words, values = matching.word_forms(steps, codes=False), value_forms_of(spark, ["01/02/1980"])
    notes = spark.createDataFrame([(1, "Mara Quill, 01/02/1980"), (2, None), (None, "Mara Quill")], "note_id long, text string")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    for forms, keys_of, made in ((words, matching.word_keys, r"\W+"), (values, matching.value_keys, "regexp_extract_all(")):
        assert plan(matching.note_keys(notes, F.col("text"), forms, keys_of, "note_id").select("key")).count(made) == 1
    assert plan(matching.apply_forms(notes, values, matching.value_keys)).count("Exchange hashpartitioning") == 2
    assert [r.text for r in matching.apply_forms(notes, words, matching.word_keys).orderBy("text").collect()] == [None, "T", "T, 01/02/1980"]


def test_hot_keys_of_nothing(spark):
    none = spark.createDataFrame([], "note_id string, key string")
    left, right = matching.split_hot_keys(none, none.select("key"))
    assert left.columns == ["note_id", "key", "salt"] and right.columns == ["key", "salt"] and left.isEmpty()


def test_cut_lineage_gives_the_same(spark):
    notes, people, staff, surfaces = world(5)
    assert run(spark, notes, people, staff, surfaces, cut=True) == expect(notes, people, staff, surfaces)


def test_normalise_dob_is_opt_in(spark):
    person = ("PART-009", "Zed", "Quux", "", "24/10/1968", "", "", "")
    assert run(spark, ["on 24/10/1968"], [person])[0][0] == "on 24/10/1968"
    assert run(spark, ["on 24/10/1968"], [person], normalise_dob=True)[0][0] == "on [DOB]"


def test_table_notes_equal_brute_force(spark, sf):
    """Derived notes and whole documents at the smallest scale."""
    corpus = B.corpus(spark, sf)
    people = [r.asDict() for r in B.roster(spark, sf).orderBy("k").collect()]
    staff = [r.asDict() for r in B.staff(spark, sf).collect()]
    entries = [(r["type"], r["name"]) for r in B.dictionary(spark, sf).collect()]
    out = D.deidentify(corpus, B.roster(spark, sf), B.staff(spark, sf),
                       dictionary_surfaces(B.dictionary(spark, sf)))
    got = {r.note_id: r for r in out.collect()}
    rows = corpus.where(F.length("note") < 3000).orderBy(F.xxhash64("note_id")).limit(150).collect()
    for r in rows:
        text, counts, reason = brute.deidentify(r.note, people, staff, entries)
        assert (got[r.note_id].deidentified_text, got[r.note_id].quarantine_reason) == (text, reason)
        assert {c.label: c.n for c in got[r.note_id].counts} == counts


def test_invariants(spark, sf):
    out = D.finish(D.redact_patterns(D.start(B.documents(spark, sf)))).cache()
    assert out.count() == B.documents(spark, sf).count()
    clean = out.where(~F.col("is_quarantined")).select("note_id", F.col("deidentified_text").alias("note"))
    again = D.finish(D.redact_patterns(D.start(clean)))
    assert again.where(F.col("is_quarantined")).count() == 0
    joined = clean.join(again, "note_id")
    assert joined.where(F.col("note") != F.col("deidentified_text")).count() == 0
