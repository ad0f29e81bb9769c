"""Brute force for tests: every form over every note, in plain Python."""
import re

from veilnote.fixed_values import (
    ADDRESS_PATTERN, ADDRESS_STOP_WORDS, DICTIONARY_TYPES, DOB_PATTERN, EMAIL_PATTERN, GENERIC_TERMS,
    NDIS_PATTERN, NICKNAMES, PHONE_PATTERNS, SPAN_PRIORITY, SPAN_TAG, STATES, STREET_PART_PATTERN,
    SUBURB_POSTCODE_PATTERN, TITLES)


def forms_of(name):
    if not name.strip():
        return set()
    bare = re.sub(r"^(?:%s)\.? " % "|".join(TITLES), "", name.strip(), count=1).strip()
    words = bare.split()
    base = []
    if len(words) < 2:
        base = [bare] if len(bare) > 2 else []
    else:
        base = [name, bare] + [w for w in (words[0], words[-1]) if len(w) > 2]
        base += [s for f, s in NICKNAMES.items() if f == words[0]]
        base += [f for f, s in NICKNAMES.items() if s == words[0]]
    return {b + end for b in base for end in ("", "'s")}


def usable(form, generic=True):
    return len(form) > 2 and not (generic and form.lower() in GENERIC_TERMS)


def ordered(pairs, first=None):
    """Longest first; equal lengths by first holder, then form, then replacement."""
    return sorted(pairs, key=lambda p: (-len(p[0]), first[p[0]] if first else 0, p[0], p[1]))


class Note:
    def __init__(self, text):
        self.text, self.hits = text, {}

    def sub(self, pattern, tag, label, flags=0, once=False):
        new, n = re.subn(pattern, lambda _: tag, self.text, flags=flags)
        if n:
            self.text = new
            self.hits[label] = self.hits.get(label, 0) + (1 if once else n)

    def word(self, form, tag, label):
        self.sub(r"\b" + re.escape(form) + r"\b", tag, label, re.I)


def places(text):
    out = {m for m in re.findall(ADDRESS_PATTERN, text) if not any(s in m.lower() for s in ADDRESS_STOP_WORDS)}
    out |= {s for s in STATES if re.search(rf"\b{s}\b", text)}
    for suburb, code in re.findall(SUBURB_POSTCODE_PATTERN, text):
        if 200 <= int(code) <= 9999 and not 2020 <= int(code) <= 2030:
            out.add(code)
            if suburb.lower() not in GENERIC_TERMS:
                out.add(suburb)
    return out


def detect(text):
    return (set(re.findall(NDIS_PATTERN, text)),
            {m for p in PHONE_PATTERNS for m in re.findall(p, text)},
            set(re.findall(EMAIL_PATTERN, text)))


def spans_of(text, known_places):
    ids, phones, mails = detect(text)
    plan = [("NDIS", v, re.escape(v), 0) for v in ids] + [("PHONE", v, re.escape(v), 0) for v in phones]
    plan += [("EMAIL", v, re.escape(v), re.I) for v in mails] + [("DOB", "", DOB_PATTERN, re.I)]
    plan += [("LOCATION", v, rf"\b{re.escape(v)}\b", re.I) for v in known_places]
    return [(m.start(), m.end(), label) for label, _, p, f in plan for m in re.finditer(p, text, f)]


def merged(spans):
    rank = list(SPAN_TAG)
    kept = []
    for start, end, label in sorted(spans, key=lambda s: (s[0], SPAN_PRIORITY[s[2]], -s[1], rank.index(s[2]))):
        if not kept or start >= kept[-1][1]:
            kept.append((start, end, label))
            continue
        mine, theirs = SPAN_PRIORITY[label], SPAN_PRIORITY[kept[-1][2]]
        if mine < theirs:
            kept[-1] = (start, end, label)
        elif mine == theirs and end > kept[-1][1]:
            kept[-1] = (kept[-1][0], end, kept[-1][2])
    return kept


def dob_forms(dob):
    parts = dob.split("-")
    if len(parts) != 3:
        return []
    y, m, d = parts
    return [s.join(p) for s in "/-." for p in ((d, m, y), (d, m, y[2:]), (m, d, y))]


def deidentify(text, people, staff=(), surfaces=()):
    note = Note(text)
    codes, first = {}, {}
    for at, p in enumerate(people):
        full = f"{p['first_name']} {p['last_name']}".strip()
        if full and p["ref_code"]:
            for f in filter(usable, forms_of(full)):
                codes[f] = p["ref_code"]
                first.setdefault(f, at)
    for form, code in ordered(codes.items(), first):
        note.word(form, code, "NAME→" + code)
    names = {f for s in staff for f in forms_of(f"{s['first_name']} {s['last_name']}".strip()) if usable(f)}
    for form, tag in ordered((f, "[STAFF_NAME]") for f in names):
        note.word(form, tag, "STAFF_NAME")
    for p in people:
        if p["ndis_number"]:
            note.sub(rf"\b{re.escape(p['ndis_number'])}\b", "[NDIS_REDACTED]", "NDIS", once=True)
        for form in dob_forms(p["date_of_birth"]) if p["date_of_birth"] else []:
            if form:
                note.sub(re.escape(form), "[DOB]", "DOB", once=True)
        for form in (p["phone"], re.sub(r"[\s\-()]", "", p["phone"])):
            if form:
                note.sub(re.escape(form), "[PHONE]", "PHONE", once=True)
        if p["email"]:
            note.sub(re.escape(p["email"]), "[EMAIL]", "EMAIL", re.I)
        street = re.match(STREET_PART_PATTERN, p["address"], re.I) if len(p["address"]) > 8 else None
        if street:
            note.sub(re.escape(street.group(1)), "[ADDRESS]", "ADDRESS", re.I)
    for kind, (tag, label, person) in DICTIONARY_TYPES.items():
        mine = {s for t, n in surfaces if t == kind for s in ({n} | (forms_of(n) if person else set()))}
        for form, t in ordered((s, tag) for s in mine if usable(s, kind != "Organization")):
            note.word(form, t, label)
    for start, end, label in reversed(merged(spans_of(note.text, places(text)))):
        note.text = note.text[:start] + SPAN_TAG[label] + note.text[end:]
        note.hits[label] = note.hits.get(label, 0) + 1
    reason = None
    for words, left in zip(("NDIS-pattern numbers", "phone numbers", "email addresses"), detect(note.text)):
        if left:
            reason = f"Residual {words} in output: {sorted(left)}"
            break
    return note.text, note.hits, reason
