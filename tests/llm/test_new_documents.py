"""Class model, divergence audit and ranked search against brute force."""
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from veilnote.llm import class_model, divergence, lexical_search
from test_documents import DOCS, lower, rows_of, texts


def parts_of_speech(n, seed=3):
    """Texts in which a word of one kind follows one of another kind, two languages."""
    draw = random.Random(seed)
    kinds = {(lang, kind): [f"{lang}{kind}{k}" for k in range(40)] for lang in "xy" for kind in "abc"}
    out = []
    for i in range(n):
        lang = draw.choice("xy")
        out.append((i, " ".join(draw.choice(kinds[lang, "abc"[k % 3]]) for k in range(draw.randint(3, 60)))))
    return out


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower(text)), ""]


@pytest.mark.parametrize("chunk", [4 << 20, 3000])
def test_class_scores(frame, monkeypatch, chunk):
    monkeypatch.setattr(class_model, "CHUNK_BYTES", chunk)
    docs = parts_of_speech(300) + [(None, "xa1 xb2 xc3"), (400, None), (401, ""), (402, " \t"), (403, "NEW Xa1 new new xb2"), (3, "xa1"), (404, "u " * 3000)]
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    counts = Counter(t for i, text in docs if not out(i) for t in tokens(text))
    total, kinds = sum(counts.values()), len(counts)
    got = class_model.score(frame(rows_of(docs), DOCS)).collect()
    key = lambda r: (repr(r[0]), r[2], r[5])
    expected = []
    for i, text in docs:
        own = tokens(text)
        base = sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (kinds + 1))) for t in own)
        expected.append((i, out(i), len(own), sum(counts[t] > 0 for t in own), total, base))
    for r, e in zip(sorted(map(tuple, got), key=key), sorted(expected, key=key), strict=True):
        assert r[:5] == e[:5] and r[5] == pytest.approx(e[5], abs=1e-6) and r[6] <= 0
    apart = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 300]
    # the kind and language of a word follow from the one before it: log10(40) each, against log10(240)
    per_word = sum(r.score for r in apart) / sum(r.n_tokens for r in apart)
    assert per_word > -math.log10(40) - 0.25 > sum(r.base_score for r in apart) / sum(r.n_tokens for r in apart)


def test_class_scores_of_little(frame):
    assert class_model.score(frame([], DOCS)).count() == 0
    only = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5 == 1]
    rows = class_model.score(frame(rows_of([(i, "a b c") for i in only]), DOCS)).collect()
    assert {(r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in rows} == {(4, 0, 0, 0.0, 0.0)}
    rows = class_model.score(frame(rows_of([(only[0], "a a"), (None, None)]), DOCS)).collect()
    assert {(r.n_tokens, r.n_known, r.train_tokens) for r in rows} == {(3, 1, 1), (1, 1, 1)}
    assert all(math.isfinite(r.score) for r in rows)


def model_of(seed=5):
    """A model of random words in random classes, and the words."""
    draw = random.Random(seed)
    words = {f"w{k}": (draw.randint(1, 9), draw.randint(1, 6)) for k in range(60)}  # class, count
    bigrams = np.zeros((class_model.CLASSES,) * 2, np.int64)
    for a in range(10):
        bigrams[a, :10] = [draw.randint(0, 50) for _ in range(10)]
    of = lambda keep: [sum(keep(n) for c, n in words.values() if c == k) for k in range(class_model.CLASSES)]
    sums = np.array([of(lambda n: 1), of(lambda n: n), of(lambda n: n == 1), of(lambda n: n == 2)])
    return class_model.Model(bigrams, sums, 20), words


def test_class_model_is_a_distribution():
    model, words = model_of()
    for h in range(12):
        known = [10 ** model.follows[h, c] * (n - model.discount[c]) / model.sizes[c] for c, n in [*words.values(), (0, 20)]]
        assert sum(known) + 10 ** model.unknown[h] == pytest.approx(1)


@pytest.mark.parametrize("top", [0, 1, 255, 256, 65535, 70_000, 1 << 24, (1 << 31) - 1])
def test_packed_codes(top):
    codes = np.array([0, 3, top, top // 2, 0], np.int32)
    assert class_model.unpacked(class_model.packed(codes), 5).tolist() == codes.tolist()
    assert len(class_model.packed(codes)) == 5 * max(1, (max(3, top).bit_length() + 7) // 8)


def test_class_model_along_a_text():
    """Scores of a chunk, with unknown words in runs and at the start, against one token after the other."""
    model, words = model_of()
    draw = random.Random(8)
    code = {w: k + 1 for k, w in enumerate([*words, "new"])}
    docs = [[draw.choice([*words, "new", "new"]) for _ in range(draw.randint(0, 30))] for _ in range(25)] + [["new"] * 50]
    codes = [code[w] if w else 0 for d in docs for w in [*d, ""]]
    given = [*words.values(), (3, 0)]
    told = pa.table({"shard": pa.array([0], pa.int32()), "classes": [np.array([c for c, _ in given], np.uint8).tobytes()],
                     "counts": [np.array([n for _, n in given], np.int64).tobytes()]})
    table = pa.table({"doc_ids": [list(range(26))], "held": [[False] * 26], "codes": [class_model.packed(np.array(codes, np.int32))],
                      "sizes": [np.array([len(d) + 1 for d in docs], np.int64).tobytes()]})
    got = model.scores(table, told).to_pylist()
    for d, r in zip(docs, got, strict=True):
        h, total = 0, 0.0
        for w in d:
            if w in words:
                c, n = words[w]
                total += model.follows[h, c] + math.log10((n - model.discount[c]) / model.sizes[c])
                h = c
            else:
                total += model.unknown[h]
                h = int(model.likely[h])
        total += model.follows[h, 0]
        assert r["score"] == pytest.approx(total) and r["n_tokens"] == len(d) + 1


def test_exact_gain(monkeypatch):
    """A move's gain is the change of the likelihood of the class bigrams."""
    monkeypatch.setattr(class_model, "CLASSES", 5)
    monkeypatch.setattr(class_model, "FREQUENT", 0)
    draw = random.Random(9)
    old = np.array([draw.randint(1, 4) for _ in range(30)])
    line = [0]
    for _ in range(3000):
        line.append(draw.choice([y for y in range(1, 30) if y != line[-1] and (line[-1] + y) % 4]))
    pairs = Counter(zip(line, [*line[1:], 0], strict=True))

    def counts(classes):
        out = np.zeros((5, 5))
        for (x, y), n in pairs.items():
            out[classes[x], classes[y]] += n
        return out

    def likelihood(classes):
        g = counts(classes)
        return class_model.xlogx(g).sum() - class_model.xlogx(g.sum(1)).sum() - class_model.xlogx(g.sum(0)).sum()

    own = np.zeros((30, 10))
    for (x, y), n in pairs.items():
        own[x, old[y]] += n
        own[y, 5 + old[x]] += n
    best = class_model.best_classes(own, old, counts(old))
    right = 0
    for w in range(30):
        each = []
        for c in range(1, 5):
            moved = old.copy()
            moved[w] = c
            each.append(likelihood(moved))
        right += each[best[w] - 1] >= max(each) - 1e-6
    assert right == 30


def plain_audit(docs):
    groups, within, langs = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in docs:
        own = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(text))
        lang, source = lang or "", source or ""
        langs[lang].add(source)
        groups[lang, source].update(own)
        within[lang].update(set(own))
    out = []
    for lang, sources in langs.items():
        kept = sorted(t for t, n in within[lang].items() if n >= 30)
        share = {}
        for s in sources:
            n = sum(groups[lang, s][t] for t in kept)
            share[s] = {t: 1 + 10**9 * (groups[lang, s][t] + 5) // (n + 5 * len(kept)) for t in kept}
        whole = {t: sum(groups[lang, s][t] for s in sources) for t in kept}
        q = {t: 1 + 10**9 * (whole[t] + 5) // (sum(whole.values()) + 5 * len(kept)) for t in kept}
        for s in sources:
            pair = [("pair", o, sum(abs(share[s][t] - share[o][t]) for t in kept)) for o in sources if o != s]
            term = [("term", t, share[s][t] - q[t]) for t in kept if groups[lang, s][t] and share[s][t] > q[t]]
            for rows in (pair, term):
                rows.sort(key=lambda r: (-r[2], r[1].encode()))
                out += [(lang, s, *r, k + 1) for k, r in enumerate(rows) if r[0] == "pair" or k < 50]
    return out


def audited(n, seed=2):
    draw = random.Random(seed)
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(120)] + ["Éa", "İx", "ſ", "a1b", "x" * 300]
    out = []
    for i in range(n):
        lang, source = draw.choice(["en", "en", "de", None, ""]), draw.choice(["s0", "s0", "s1", "s2", None])
        text = " ".join(draw.choices(words, weights=[3 if source == "s0" and k < 10 else 1 for k in range(len(words))], k=draw.randint(0, 80)))
        out += [(text, lang, source)] * draw.choice((1, 1, 1, 4))
    out += [("copy of one text", "en", "s0")] * 200 + [("copy of one text", "en", "s1")] * 70 + [(None, "en", "s9"), ("", "fr", "s1"), ("only", "fr", "s2"), ("one", "xx", "y")]
    draw.shuffle(out)
    return out


@pytest.mark.parametrize("held", [500_000, 40])
def test_audit(frame, monkeypatch, held):
    monkeypatch.setattr(divergence, "HELD", held)
    docs = audited(200)
    given = frame([(k, t, lang, s, "a", 1) for k, (t, lang, s) in enumerate(docs)], "doc_id long, text string, lang string, source string, item string, value int")
    got = [tuple(r) for r in divergence.audit(given).collect()]
    assert sorted(got) == sorted(plain_audit(docs))
    assert divergence.audit(given.limit(0)).count() == 0


def test_audit_collapses_texts(frame):
    docs = audited(60)
    given = frame(docs, "text string, lang string, source string")
    rows = divergence.collapsed(given).collect()
    assert len(rows) == len({(t or "", lang or "") for t, lang, _ in docs})
    assert Counter({(r.lang, r.text, c.source): c.n for r in rows for c in r.copies}) == Counter((lang or "", t or "", s or "") for t, lang, s in docs)


def plain_search(docs, items, k):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(t))
    counted = [(i, Counter(words(t))) for i, t in docs]
    n, length = sum(bool(c) for _, c in counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in counted:
            m = 75 + (25 * sum(c.values()) * n) // max(length, 1)
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t in words(text) if c[t])
            if s > 0:
                scores.append((-s, i is not None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return out


@pytest.mark.parametrize("rows", [200_000, 0])
@pytest.mark.parametrize("waves", [lexical_search.WAVES, (0.02, 0.05, 0.1, 0.2, 0.5), ()])
def test_search(frame, monkeypatch, rows, waves):
    monkeypatch.setattr(lexical_search, "WAVES", waves)
    monkeypatch.setattr(lexical_search, "BROADCAST_ROWS", rows)
    draw = random.Random(4)
    usual, rare = [f"w{k}" for k in range(30)], [f"r{k}" for k in range(2000)]
    docs = [(i, " ".join(draw.choices(usual, k=draw.randint(0, 60)) + draw.choices(rare, k=draw.randint(0, 6)))) for i in range(250)]
    docs += [(None, "w1 r5"), (500, None), (501, ""), (502, ".,;"), (7, docs[7][1]), (503, "W3 w3-w3 Éa é"), (504, "w2 " * 4000)]
    items = [(1, docs[3][1]), (2, "w1 w2 w3 W3"), (3, None), (4, "--"), (5, "unseen"), (6, "r5 r6 r7 éa"), (None, "w4 r9"), (2, docs[9][1]), (8, " ".join(usual))]
    given = frame(items, "item_id long, text string").selectExpr("*", "1 as score", "2 as rank", "3 as id")
    got = [tuple(r) for r in lexical_search.search(frame(rows_of(docs), DOCS), given, k=20).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, plain_search(docs, items, 20)))
    assert lexical_search.search(frame([], DOCS), given).count() == 0
    assert lexical_search.search(frame(rows_of(docs), DOCS), given.limit(0)).count() == 0
