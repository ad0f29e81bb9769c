"""Candidate joins between notes and search forms, and the ordered fold.

Replacing forms one after the other, longest first, is a fold: each step edits
the text the next one sees.  Running every form over every note costs
notes x forms regular expressions, so a note first finds its *candidates* by an
equi-join on normalised keys and folds only those.  The candidates are always a
superset of the forms that can match at any step, so the result is the one of
the full fold:

* word forms: the folded word run of a form must occur as a word run of the
  text.  A form may also match words that an earlier step put in (a code or a
  tag); such *re-entrant* forms are found separately and stay candidates of
  every note in which something may be put in.
* value forms (dates, phones, streets, e-mails): they may sit inside longer
  runs, so keys are fixed-length grams that start at a digit, ``+`` or ``(``,
  and for e-mails the text around each ``@``.  Values that give no such key are
  candidates of every note.  Only grams that are shaped like one of the forms
  (digits, letters and signs in the same places) are looked up.

A side is broadcast only after it was measured; a larger one is shuffled.
"""
from __future__ import annotations

from dataclasses import dataclass
from itertools import groupby

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.detectors import detect_locations
from ..functions.text import (
    bind, empty_strings, fold_case, lit_words, ngrams, quote_literal,
    word_pattern, word_tokens,
)
from ..functions.verify import HITS_TYPE, no_hits
from ..session import cut_lineage, fits_broadcast

MAX_RUN = 3            # longer forms are keyed by their first MAX_RUN words
GRAMS = (5, 8, 10, 12, 16)
AT_CONTEXT = 64
ID_PARTS = ("same_id", "no_id")
EVERY_NOTE = ""        # key of forms that are candidates of every note
_BLOCK = 4096          # positions of a window over the holders of one value
_HEAVY = 256           # keys whose frequency is looked at, out of _TRACKED that the sketch holds
_TRACKED = 8192
_KEYLESS = 200         # forms without key that go to every note as one constant; more are joined
_SHAPES = 32           # shapes of the grams of one size that are searched one by one; with more, all grams are keys
_SLOTS = 1 << 22       # slots of 64 bits that say which keys forms have, where the forms are not broadcast

STEP_TYPE = ("struct<pass_no:int,major:bigint,kind:bigint,variant:int,form:string,tag:string,"
             "label:string,pattern:string,once:boolean>")
STEPS_TYPE = f"array<{STEP_TYPE}>"


@dataclass
class KeyedForms:
    """Forms with their join key, and what was measured about them.

    Where the forms are broadcast, notes are joined with numbers of steps alone:
    only those are shuffled, and the steps themselves are looked up afterwards.
    """
    table: DataFrame            # key, reentrant, step, number
    sizes: list[int]            # word-run sizes (or gram sizes) in use
    every_note: bool            # some forms have no key
    emails: bool                # some forms are keyed around '@'
    broadcast: bool
    keyless: DataFrame | None = None    # reentrant, step of the few forms without key, not in the table
    shared: DataFrame | None = None     # later holders of values that several participants have: pattern, major
    rows: int = 0               # rows of the table when it was measured
    shapes: dict[int, list[str]] | None = None      # by gram size, where they are few
    lefts: list[int] | None = None                  # lengths of the keys around '@', up to it


def _step(**parts: Column) -> Column:
    return F.struct(*[parts[name].alias(name) for name in (
        "pass_no", "major", "kind", "variant", "form", "tag", "label", "pattern", "once")]).cast(STEP_TYPE)


def _numbered(table: DataFrame) -> DataFrame:
    """The forms, computed once, each with a number."""
    return cut_lineage(table.withColumn("number", F.monotonically_increasing_id()))


def _keyed(table: DataFrame, sizes: list[int], seen: dict, emails: bool) -> KeyedForms:
    few = 0 < seen["keyless"] <= _KEYLESS
    keyless = table.where(F.col("key") == EVERY_NOTE).select("reentrant", "step") if few else None
    rest = table.where(F.col("key") != EVERY_NOTE) if few else table
    return KeyedForms(rest, sizes, seen["keyless"] > 0 and not few, emails, fits_broadcast(seen["rows"], seen["bytes"]), keyless,
                      rows=seen["rows"])


def _measure(table: DataFrame, size: Column, odd: Column | None = None) -> dict:
    """One small job over the forms: size, key sizes, special keys."""
    return table.agg(
        F.count("*").alias("rows"),
        F.coalesce(F.sum(F.length("key") + 2 * F.length(F.col("step")["form"]) + 120), F.lit(0)).alias("bytes"),
        F.collect_set(size).alias("sizes"),
        F.collect_set(F.when(F.contains(F.col("key"), F.lit("@")), F.length(F.substring_index("key", "@", 1)))).alias("lefts"),
        F.count_if(F.col("key") == EVERY_NOTE).alias("keyless"),
        F.coalesce(F.bool_or(F.contains(F.col("key"), F.lit("@"))), F.lit(False)).alias("emails"),
        F.coalesce(F.bool_or(F.lit(False) if odd is None else odd), F.lit(False)).alias("odd"),
    ).first().asDict()


def _reentrant(tokens: Column, form: Column, tag_words: Column, codes: bool, edges: bool) -> Column:
    """Whether a form can match words put in by a step of the same phase.

    Tags stand in brackets, so only a form holding the tag word itself, or
    reaching over a bracket, can touch them.  Codes are bare words: a form
    holding ``part`` or a code-like number can touch them, and if forms with
    non-word edges exist, words may even be glued to a code.
    """
    risky = F.arrays_overlap(tokens, tag_words) | form.startswith("]") | form.endswith("[")
    if codes:
        number = r"^\d" if edges else r"^(\d{3}|[1-9]\d{3,})$"
        word = r"part$" if edges else r"^part$"
        risky = risky | F.exists(tokens, lambda t: t.rlike(word) | t.rlike(number))
    return risky


def word_forms(steps: DataFrame, codes: bool) -> KeyedForms:
    """Key (pass_no, form, tag, label, first_pos) rows by their folded words.

    Longest first, equal lengths by the position of their first holder, then by
    form.  Forms equal but for case are one step of a pass unless re-entrant: after
    the first one ran nothing is left for the others.
    """
    table = _numbered(_keyed_words(steps, codes, edges=False))
    edge = F.col("step")["form"].rlike(r"(?U)^\W|\W$")
    seen = _measure(table, F.size(F.split("key", " ")), edge)
    if codes and seen["odd"]:       # words may be glued to a code: wider re-entrant test
        table = _numbered(_keyed_words(steps, codes, edges=True))
        seen = _measure(table, F.size(F.split("key", " ")), edge)
    return _keyed(table, sorted(seen["sizes"]), seen, emails=False)


def _keyed_words(steps: DataFrame, codes: bool, edges: bool) -> DataFrame:
    tags = ["staff_name", "carer_name", "participant", "organization", "location"]
    rows = steps.withColumn("tokens", word_tokens(F.col("form")))
    rows = rows.withColumn("reentrant", _reentrant(
        F.col("tokens"), F.col("form"), lit_words(tags), codes, edges))
    rows = rows.withColumn("fold", F.when(F.col("reentrant"), F.col("form")).otherwise(fold_case(F.col("form"))))
    first = rows.groupBy("pass_no", "fold").agg(
        F.min_by(F.struct("form", "tag", "label", "first_pos", "tokens", "reentrant"),
                 F.struct(-F.length("form"), F.col("first_pos"), F.col("form"), F.col("tag"))).alias("r"))
    step = _step(
        pass_no=F.col("pass_no"), major=-F.length("r.form"), kind=F.col("r.first_pos"), variant=F.lit(0),
        form=F.col("r.form"), tag=F.col("r.tag"), label=F.col("r.label"),
        pattern=word_pattern(F.col("r.form")), once=F.lit(False))
    plain = F.filter("r.tokens", lambda t: ~t.rlike(r"part$|^\d") & ~F.array_contains(lit_words(tags), t))
    direct = F.struct(F.array_join(F.slice("r.tokens", 1, MAX_RUN), " ").alias("key"), F.lit(False).alias("reentrant"))
    again = F.struct(F.coalesce(F.get(plain, F.lit(0)), F.lit(EVERY_NOTE)).alias("key"), F.lit(True).alias("reentrant"))
    return first.select(step.alias("step"), F.explode(
        F.when(F.col("r.reentrant"), F.array(direct, again)).otherwise(F.array(direct))).alias("k")).select(
        "k.key", "k.reentrant", "step")


def longest_first(forms: KeyedForms, by: str) -> DataFrame:
    """(by, steps): the steps of each value of a step's field, in the order in which a note's fold takes them."""
    steps = forms.table.select("step")
    if forms.keyless is not None:
        steps = steps.union(forms.keyless.select("step"))
    return steps.distinct().groupBy(F.col("step")[by].alias(by)).agg(F.sort_array(F.collect_list("step")).alias("steps"))


def word_keys(text: Column, forms: KeyedForms) -> Column:
    keys = ngrams(word_tokens(text), forms.sizes)
    return F.concat(keys, F.array(F.lit(EVERY_NOTE))) if forms.every_note else keys


def value_forms(steps: DataFrame) -> KeyedForms:
    """Key (pass_no, major, kind, variant, form, tag, label, pattern, once) rows."""
    v = fold_case(F.col("form"))
    size = F.coalesce(*[F.when(F.length(v) >= n, F.lit(n)) for n in sorted(GRAMS, reverse=True)])
    bracketed = v.contains("[") | v.contains("]")
    gram = F.when(v.rlike(r"(?U)^[\d+(]") & ~bracketed, F.substring(v, F.lit(1), size))
    left, right = F.substring_index(v, "@", 1), F.get(F.split(v, "@"), F.lit(1))
    around = F.when(
        (v.contains("@")) & (left != "") & right.contains(".") & ~bracketed,
        F.concat(F.right(left, F.lit(AT_CONTEXT)), F.lit("@"),
                 F.substring(F.substring_index(right, ".", 1), 1, AT_CONTEXT)))
    key = F.coalesce(gram, around, F.lit(EVERY_NOTE))
    step = _step(**{name: F.col(name) for name in (
        "pass_no", "major", "kind", "variant", "form", "tag", "label", "pattern", "once")})
    table = _numbered(steps.select(key.alias("key"), F.lit(False).alias("reentrant"), step.alias("step")))
    seen = _measure(table, F.when(F.contains(F.col("key"), F.lit("@")), F.lit(None)).otherwise(F.length("key")))
    sizes = sorted(n for n in seen["sizes"] if n in GRAMS)
    forms = _keyed(table, sizes, seen, seen["emails"])
    forms.shapes, forms.lefts = _shapes(table, sizes), sorted(seen["lefts"])
    return forms


def _shapes(table: DataFrame, sizes: list[int]) -> dict[int, list[str]]:
    """Shapes of the grams of each size: 0 for a digit, a for a letter, all else as it is.  Sizes of many shapes are left out."""
    shape = F.regexp_replace(F.regexp_replace("key", r"\p{Nd}", "0"), r"\p{L}", "a")
    grams = table.where((F.col("key") != EVERY_NOTE) & ~F.contains(F.col("key"), F.lit("@")))
    most = _SHAPES * len(GRAMS)
    found = [r["shape"] for r in grams.select(shape.alias("shape")).distinct().limit(most + 1).collect()]
    if len(found) > most:
        return {}
    by_size = {n: sorted(s for s in found if len(s) == n) for n in sizes}
    return {n: shapes for n, shapes in by_size.items() if len(shapes) <= _SHAPES}


def _shape_pattern(shape: str) -> str:
    classes = {"0": r"\p{Nd}", "a": r"\p{L}"}
    return "".join(f"{classes.get(c, rf'\x{{{ord(c):x}}}')}{{{len(list(run))}}}" for c, run in groupby(shape))


def value_keys(text: Column, forms: KeyedForms) -> Column:
    shapes = forms.shapes or {}
    others = [n for n in forms.sizes if n not in shapes]

    def shaped(t: Column, n: int) -> Column:
        """The grams of one size that are shaped like a form's; a gram has one shape, so each start gives one at most."""
        either = "|".join(_shape_pattern(s) for s in shapes[n])
        return F.regexp_extract_all(t, F.lit(rf"(?=[\p{{Nd}}+(])(?=({either}))"), F.lit(1))

    def grams(t: Column) -> Column:
        """One scan for the longest gram at each start, then its prefixes; one that is too short is no form's key."""
        lo, hi = min(others), max(others)
        longest = F.regexp_extract_all(t, F.lit(rf"(?sU)(?=([\d+(].{{{lo - 1},{hi - 1}}}))"), F.lit(1))
        prefixes = lambda found, n: F.transform(found, lambda g: F.substring(g, 1, n))
        return bind(longest, lambda found: F.concat(found, *[prefixes(found, n) for n in others if n < hi]))

    def around_at(t: Column) -> Column:
        def keys(pieces: Column) -> Column:
            def at(piece: Column, i: Column) -> Column:
                label = F.substring(F.substring_index(F.get(pieces, i + 1), ".", 1), 1, AT_CONTEXT)
                lengths = F.array(*[F.lit(n) for n in forms.lefts])     # AT_CONTEXT at most
                return bind(F.right(piece, F.lit(AT_CONTEXT)), lambda left: F.transform(
                    F.filter(lengths, lambda n: n <= F.length(left)), lambda n: F.concat(F.right(left, n), F.lit("@"), label)))
            return F.flatten(F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), at))
        return F.when(t.contains("@"), bind(F.split(t, "@", -1), keys)).otherwise(empty_strings())

    def keys(t: Column) -> Column:
        parts = [shaped(t, n) for n in forms.sizes if n in shapes] + ([grams(t)] if others else []) + ([around_at(t)] if forms.emails else [])
        parts.append(F.array(F.lit(EVERY_NOTE)) if forms.every_note else empty_strings())
        return F.array_distinct(F.concat(*parts))

    return bind(fold_case(text), keys)


def note_keys(notes: DataFrame, text: Column, forms: KeyedForms, keys_of, *columns: str) -> DataFrame:
    """(columns, key): the keys of each note's text, at least those that a broadcast form has.

    Where the word forms are broadcast, a run is put together only from a word that some form's key starts with, at
    the sizes of those keys; a key that a text has several times may come several times.  Keys are made in a
    projection of their own, so that the rows of the explode are compiled together with the joins.  A plain explode
    would first be given a filter on the size of the list, for which each list were made a second time.
    """
    if keys_of is not word_keys or not forms.broadcast:
        return notes.select(*columns, keys_of(text, forms).alias("keys")).select(
            *columns, F.explode_outer("keys").alias("key")).where("key is not null")
    words = word_tokens(text)
    every = F.concat(words, F.array(F.lit(EVERY_NOTE))) if forms.every_note else words
    each = notes.select(*columns, every.alias("words")).select(*columns, "words", F.posexplode_outer("words").alias("at", "word")).where("word is not null")
    starts = forms.table.select(F.substring_index("key", " ", 1).alias("word"), F.size(F.split("key", " ")).alias("run")).distinct()
    return each.join(F.broadcast(starts), "word").where(F.col("at") + F.col("run") <= F.size("words")).select(
        *columns, F.when(F.col("run") == 1, F.col("word")).otherwise(
            F.array_join(F.slice("words", F.col("at") + 1, F.col("run")), " ")).alias("key"))


def candidates(notes: DataFrame, text: Column, forms: KeyedForms, keys_of, *columns: str) -> DataFrame:
    """(columns, reentrant, number), or step instead of number: equi-join of note keys and form keys."""
    columns = columns or ("note_id",)
    exploded = note_keys(notes, text, forms, keys_of, *columns)
    if forms.broadcast:
        return exploded.join(F.broadcast(forms.table.drop("step")), "key").select(*columns, "reentrant", "number")
    # Written once: most keys of a note are of no form, and the keys of all notes are many times their texts.
    left, right = split_hot_keys(cut_lineage(keys_of_forms(exploded, forms)), forms.table, columns[0])
    return left.hint("merge").join(right, ["key", "salt"]).select(*columns, "reentrant", "step")


def keys_of_forms(exploded: DataFrame, forms: KeyedForms) -> DataFrame:
    """The note keys that a form may have: all that one has, and few others.

    A key sets one bit, by its hash, in at most _SLOTS words that every task holds, whatever the number of forms.
    """
    slots = min(_SLOTS, 1 << max(forms.rows // 4, 1).bit_length())      # 16 bits a form or more, below the bound
    slot = F.expr(f"shiftrightunsigned(xxhash64(key), 6) & {slots - 1}L").alias("slot")
    bit = F.expr("shiftleft(1L, cast(xxhash64(key) & 63 as int))").alias("bit")
    taken = forms.table.select(slot, bit).groupBy("slot").agg(F.bit_or("bit").alias("taken"))
    return exploded.select("*", slot, bit).join(F.broadcast(taken), "slot").where("taken & bit <> 0").drop("slot", "bit", "taken")


def split_hot_keys(exploded: DataFrame, table: DataFrame, note_id: str = "note_id") -> tuple[DataFrame, DataFrame]:
    """Both sides of a shuffle join by (key, salt), in which a key of many notes goes to as many tasks as it needs.

    One sketch of the keys of all notes, combined in the tasks, gives the most frequent ones; a key of c in n rows has
    its notes dealt to c * tasks / n salts, rounded up, and its forms copied to each. Keys beyond the sketch are in
    fewer rows than those in it. Counts only steer the dealing: the join is the same whatever they are.
    """
    tasks = int(exploded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    seen = exploded.agg(F.count("*").alias("n"), F.call_function("approx_top_k", F.col("key"), F.lit(_HEAVY), F.lit(_TRACKED)).alias("top")).first()
    parts = {r["item"]: -(-r["count"] * tasks // seen["n"]) for r in seen["top"] or []}
    hot = {key: n for key, n in parts.items() if n > 1}
    if not hot:
        return exploded.withColumn("salt", F.lit(0)), table.withColumn("salt", F.lit(0))
    splits = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in hot.items() for x in pair]), F.col("key")), F.lit(1))
    left = exploded.withColumn("salt", F.pmod(F.xxhash64(note_id), splits).cast("int"))
    return left, table.withColumn("salt", F.explode(F.sequence(F.lit(0), splits.cast("int") - 1)))


def with_steps(found: DataFrame, forms: KeyedForms) -> DataFrame:
    """Candidates with their steps, looked up by number where they were found by number."""
    if "step" in found.columns:
        return found
    return found.join(F.broadcast(forms.table.select("number", "step")), "number").drop("number")


def same_id(note_id: Column) -> dict[str, Column]:
    """Two columns that are equal, and never null, where ids are the same, missing ones too."""
    return dict(zip(ID_PARTS, (F.coalesce(note_id.cast("string"), F.lit("")), note_id.isNull())))


def candidate_steps(notes: DataFrame, text: Column, forms: KeyedForms, keys_of, note_id: str = "note_id") -> DataFrame:
    """(same_id, no_id, direct, again): the steps of a note, those that can match its words and those that can match
    what other steps put in.

    The lists are bounded by the distinct word runs or grams of the note itself.
    """
    found = candidates(notes, text, forms, keys_of, note_id)
    if forms.shared is not None:
        found = with_steps(found, forms)
        if forms.keyless is not None:       # these may be shared too
            found = found.unionByName(notes.select(note_id, F.explode(F.array(*[
                F.struct(F.lit(r["reentrant"]).alias("reentrant"), _constant(r["step"]).alias("step")) for r in forms.keyless.collect()])).alias("k")).select(
                note_id, "k.reentrant", "k.step"))
        found = cut_lineage(found)
        found = found.unionByName(searched_again(found, forms.shared, note_id))
    # Shuffled once, by what the notes are joined by later; where forms are broadcast numbers are shuffled, steps come after it.
    found = with_steps(found.withColumns(same_id(F.col(note_id))).repartition(*ID_PARTS), forms)
    return found.groupBy(*ID_PARTS).agg(
        F.collect_set(F.when(~F.col("reentrant"), F.col("step"))).alias("direct"),
        F.collect_set(F.when(F.col("reentrant"), F.col("step"))).alias("again"))


def ordered_steps(forms: KeyedForms) -> Column:
    """The steps of a note in order, from ``direct`` and ``again``, with those of every note.

    Re-entrant forms count only where something else may put words in.
    """
    direct, again = (F.coalesce(F.col(c), F.array().cast(STEPS_TYPE)) for c in ("direct", "again"))
    if forms.keyless is not None:
        rows = forms.keyless.collect()                            # _KEYLESS at most
        every = [F.array(*[_constant(r["step"]) for r in rows if r["reentrant"] == kind]).cast(STEPS_TYPE) for kind in (False, True)]
        direct, again = F.concat(direct, every[0]), F.concat(again, every[1])
    return F.when(F.size(direct) > 0, F.sort_array(F.array_union(direct, again))).otherwise(F.array().cast(STEPS_TYPE))


def _constant(step) -> Column:
    return _step(**{name: F.lit(value) for name, value in step.asDict().items()})


def searched_again(found: DataFrame, shared: DataFrame, note_id: str = "note_id") -> DataFrame:
    """Further steps of the shared values of a note: after each step of another kind, the next holder's turn.

    Between two such steps a value that was searched once can't match again,
    since only they put in something new.  So the first holder after each of
    them stands for all, and a note gets no more steps than its own steps ask for.
    """
    step = F.col("step")
    mine = found.withColumn("pattern", step["pattern"]).join(shared.select("pattern"), "pattern", "left_semi")
    edits = found.select(note_id, step["kind"].alias("edit"), step["major"].alias("after"))
    asked = mine.join(edits, note_id).where(
        (F.col("edit") != step["kind"]) & (F.col("after") >= step["major"])).select(
        note_id, "reentrant", "step", "pattern", "after").distinct()
    turn = next_holders(asked.select("pattern", "after").distinct(), shared)
    return asked.join(turn, ["pattern", "after"]).select(
        note_id, "reentrant", step.withField("major", F.col("turn")).cast(STEP_TYPE).alias("step")).distinct()


def next_holders(asked: DataFrame, shared: DataFrame) -> DataFrame:
    """(pattern, after, turn): the first position above ``after`` in shared(pattern, major).

    Positions are cut into blocks, so a value held by a third of the roster is
    spread over many windows of at most two rows per position; a second window
    over one row per block finds holders in later blocks.
    """
    block = F.floor(F.col("at") / _BLOCK).alias("block")
    marks = asked.select("pattern", F.col("after").alias("at"), F.lit(None).cast("long").alias("holder")).unionByName(
        shared.select("pattern", F.col("major").alias("at"), F.col("major").alias("holder"))).select("*", block)
    later = Window.partitionBy("pattern").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = marks.groupBy("pattern", "block").agg(F.min("holder").alias("least")).select(
        "pattern", "block", F.min("least").over(later).alias("beyond"))
    above = Window.partitionBy("pattern", "block").orderBy(F.desc("at")).rangeBetween(Window.unboundedPreceding, -1)
    return marks.withColumn("near", F.min("holder").over(above)).where("holder is null").join(
        blocks, ["pattern", "block"]).select(
        "pattern", F.col("at").alias("after"), F.coalesce("near", "beyond").alias("turn")).where("turn is not null")


def fold_steps(text: Column, steps: Column) -> Column:
    """Apply ordered steps; gives ``struct(text, hits)``."""
    def apply(acc: Column, s: Column) -> Column:
        # One search gives both the number of matches and the text without them.
        return bind(F.split(acc["text"], s["pattern"], -1), lambda pieces: F.when(F.size(pieces) > 1, F.struct(
            F.call_function("array_join", pieces, s["tag"]).alias("text"),
            F.array_append(acc["hits"], F.struct(
                s["label"].alias("label"),
                F.when(s["once"], F.lit(1)).otherwise(F.size(pieces) - 1).cast("long").alias("n"))).cast(HITS_TYPE).alias("hits"),
        )).otherwise(acc))

    start = F.struct(text.alias("text"), no_hits().alias("hits"))
    return F.when(F.size(steps) > 0, F.aggregate(steps, start, apply)).otherwise(start)


def with_context(work: DataFrame, text: str = "text") -> DataFrame:
    """Add the empty hits and the places of the text, where still missing."""
    if "locations" not in work.columns:
        work = work.withColumn("locations", detect_locations(F.col(text)))
    if "hits" not in work.columns:
        work = work.withColumn("hits", no_hits())
    return work


def apply_forms(notes: DataFrame, forms: KeyedForms, keys_of, text: str = "text") -> DataFrame:
    """Find candidates of each note and fold them into its text and hits.

    Notes are shuffled once, by note id and with nothing but their own columns;
    a later phase on the result finds them already in place.
    """
    steps = candidate_steps(notes, F.col(text), forms, keys_of)
    # Notes without an id share the candidates of all of them, more than each needs, and none is passed over.
    joined = notes.withColumns(same_id(F.col("note_id"))).join(steps, list(ID_PARTS), "left").drop(*ID_PARTS)
    joined = with_context(joined, text)
    folded = joined.withColumn("steps", ordered_steps(forms)).withColumn("folded", fold_steps(F.col(text), F.col("steps")))
    return folded.withColumn(text, F.col("folded.text")).withColumn(
        "hits", F.concat("hits", "folded.hits")).drop("direct", "again", "steps", "folded")


def matches(notes: DataFrame, forms: KeyedForms, keys_of, *fields: str, text: str = "text") -> DataFrame:
    """(note_id, fields of the step) for forms that occur in the unedited text; else pass_no, form and tag."""
    fields = fields or ("pass_no", "form", "tag")
    if forms.broadcast and keys_of is word_keys:    # a key that a text has several times counts once for each note, also where notes share an id
        row = notes.withColumn("row", F.monotonically_increasing_id())
        found = candidates(row, F.col(text), forms, keys_of, "note_id", "row").where(~F.col("reentrant"))
        found = with_steps(found.repartition("note_id").distinct().drop("row"), forms)
    else:
        found = with_steps(candidates(notes, F.col(text), forms, keys_of).where(~F.col("reentrant")), forms)
    hit = lambda step: F.regexp_count(F.col(text), step["pattern"]) > 0
    pairs = notes.select("note_id", text).join(found, "note_id").where(hit(F.col("step"))).select("note_id", "step")
    if forms.keyless is not None:
        every = F.array(*[_constant(r["step"]) for r in forms.keyless.where("not reentrant").collect()]).cast(STEPS_TYPE)  # _KEYLESS at most
        pairs = pairs.unionByName(notes.select("note_id", F.explode(F.filter(every, hit)).alias("step")))
    return pairs.select("note_id", *[f"step.{name}" for name in fields])


__all__ = ["KeyedForms", "word_forms", "word_keys", "value_forms", "value_keys", "note_keys", "candidates",
           "with_steps", "candidate_steps", "fold_steps", "apply_forms", "matches", "quote_literal"]
