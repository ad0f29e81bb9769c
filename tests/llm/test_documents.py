"""Operators on documents against brute force, on small data with nulls, empty and long texts, ties and repeated rows."""
import hashlib
import math
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest

from veilnote.llm import chosen_path, decontamination, mixing, repeats, sharding, toxicity
from veilnote.llm.boosting import fit, isotonic
from veilnote.llm.suffix_sort import permuted_prefixes, repeated_starts, shard_text, suffix_array

DOCS = "doc_id long, text string, lang string, source string, n_chars long, a long, key string, size string"


def rows_of(texts):
    return [(i, t, "en", None if i is None or i % 5 == 4 else f"s{i % 3}", len(t or ""), 7, "k", "z") for i, t in texts]


def texts(seed=1, n=60):
    draw = random.Random(seed)
    words = [f"w{k}" for k in range(300)]
    out = [(0, None), (1, ""), (2, "one"), (3, "One two"), (4, " \t\n"), (5, "one"), (None, "one two three four five"), (6, "é ü ß one TWO")]
    base = [draw.choice(words) for _ in range(80)]
    for i in range(7, n):
        own = list(base) if i % 3 else [draw.choice(words) for _ in range(draw.randint(1, 200))]
        for _ in range(draw.randint(0, 6)):
            own[draw.randrange(len(own))] = draw.choice(words)
        out.append((i, draw.choice((" ", "\n")).join(own)))
    out += [(n, "x" * 5000), (n + 1, "ab " * 3000), (n + 2, "ab " * 3000), (8, dict(out)[8])]
    return out


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain_components(docs, n=4):
    sets = {}
    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
        sets[i] = {tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y]):
                a, b = find(x), find(y)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_near_duplicates(frame):
    docs = texts()
    got = chosen_path.near_duplicates(frame(rows_of(docs), DOCS), n=4).collect()
    assert len(got) == len(docs)
    expected = plain_components([d for d in docs if d[0] is not None])
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.doc_id is not None)
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]
    assert chosen_path.near_duplicates(frame([], DOCS)).count() == 0


def test_near_duplicates_large_group(frame):
    """A group of copies whose nodes are larger than a leaf, many pairs of it hardly linked: the recall of the trees."""
    docs = [d for d in texts(3, 240) if d[0] is not None]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in chosen_path.near_duplicates(frame(rows_of(docs), DOCS), n=4).collect()}
    expected = plain_components(docs)
    lost = [i for i in expected if got[i] != expected[i]]
    assert all(got[i][1] == i for i in lost) and len(lost) <= 0.01 * len(expected)


def test_near_duplicates_in_large_mixed_nodes(frame):
    """Pairs at 0.80 to 0.85 among thousands of texts that share most of their words: nodes stay large and mixed for
    several narrow levels."""
    draw, base = random.Random(11), [f"base{k}" for k in range(60)]
    docs = []
    for k in range(900):
        own, apart = [f"p{k}w{j}" for j in range(13)], draw.choice((7, 8))
        docs += [(2 * k + x, " ".join(base + own + [f"d{k}x{x}w{j}" for j in range(apart)])) for x in (0, 1)]
    draw.shuffle(docs)
    expected = plain_components(docs)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in chosen_path.near_duplicates(frame(docs, "doc_id long, text string"), n=4).collect()}
    assert sum(expected[i][1] != i for i in expected) == 900
    assert sum(got[i] != expected[i] for i in expected) <= 0.005 * 900


def test_sketches_lose_no_pairs():
    """Chance that a pair of similarity 0.8 has fewer than LEAST_EQUAL equal bytes; unequal tokens may have equal bytes."""
    n, equal = chosen_path.TOKENS, 0.8 + 0.2 / 256
    assert sum(math.comb(n, k) * equal**k * (1 - equal) ** (n - k) for k in range(chosen_path.LEAST_EQUAL)) < 2e-8


def test_near_duplicates_of_strays(frame):
    """Texts that are linked with a single text of a large component each."""
    draw, base = random.Random(12), [f"base{k}" for k in range(60)]
    docs = [(k, " ".join(base + [f"d{k}w{j}" for j in range(5)])) for k in range(1500)]
    docs += [(5000 + k, " ".join(base[8:] + docs[37 * k][1].split()[60:] + [f"e{k}w{j}" for j in range(2)])) for k in range(20)]
    expected = plain_components(docs)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in chosen_path.near_duplicates(frame(docs, "doc_id long, text string"), n=4).collect()}
    assert got == expected


def plain_repeats(docs, size):
    data = [(t or "").encode() for _, t in docs]
    seen = Counter(b[k:k + size] for b in data for k in range(len(b) - size + 1))
    out = []
    for (i, _), b in zip(docs, data, strict=True):
        gone = bytearray(len(b))
        for k in range(len(b) - size + 1):
            if seen[b[k:k + size]] > 1:
                gone[k:k + size] = b"\1" * size
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), sum(gone), sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1])), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [2, 4096, 3 << 20])
def test_remove_repeats(frame, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    draw = random.Random(5)
    passage = " ".join(str(draw.random()) for _ in range(20))
    docs = texts(2, 30) + [(100 + k, f"{draw.random()} {passage} {draw.random()} é") for k in range(12)]
    docs += [(200 + k, f"{k} {'-' * (1500 + k)} end") for k in range(2)] + [(202, "=" * 900), (202, "ab" * 300), (None, passage)]
    got = repeats.remove_repeats(frame(rows_of(docs), DOCS)).drop("kept").collect()
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(map(repr, plain_repeats(docs, 200)))
    assert repeats.remove_repeats(frame([], DOCS)).count() == 0


def test_long_document_in_parts(monkeypatch):
    """A document is cut into parts that overlap; each window is in one of them."""
    monkeypatch.setattr(repeats, "PIECE", 500)
    data = np.frombuffer(bytes(random.Random(1).choices(range(97, 120), k=2345)), np.uint8)
    count = 0
    for _, at, part, own in repeats.pieces_of(data, np.array([0, len(data)]), 200):
        *_, start, windows, _ = repeats.window_runs(part, own, 200)
        assert (start + windows + 199 <= len(part)).all() and bytes(part[:5]) == bytes(data[at:at + 5])
        count += windows.sum()
    assert count == len(data) - 199


def test_suffix_sort():
    draw = random.Random(4)
    for _ in range(150):
        kind = draw.choice((b"a", b"ab", bytes(range(256))))
        pieces = [np.frombuffer(bytes(draw.choices(kind, k=draw.randint(1, 40))), np.uint8) for _ in range(draw.randint(1, 5))]
        text, _ = shard_text(pieces)
        values = text.tolist()
        order = sorted(range(len(values)), key=lambda k: values[k:])  # noqa: B023
        assert suffix_array(text).tolist() == order
        before, shared = permuted_prefixes(text, suffix_array(text))
        for x, y in zip(order, order[1:], strict=False):
            n = 0
            while max(x, y) + n < len(values) and values[x + n] == values[y + n]:
                n += 1
            assert (before[y], shared[y]) == (x, n)
        seen = Counter(bytes(p[k:k + 3]) for p in pieces for k in range(len(p) - 2))
        for p, found in zip(pieces, repeated_starts(pieces, 3), strict=True):
            assert found.tolist() == [k for k in range(len(p) - 2) if seen[bytes(p[k:k + 3])] > 1]


def test_suffix_sort_of_long_runs():
    """Runs of one byte and long common parts are sorted in linear time: minutes, if each byte were a step."""
    dashes = np.full(1 << 20, 45, np.uint8)
    begun = time.monotonic()
    found = repeated_starts([dashes, np.append(dashes, np.uint8(66)), np.append(np.uint8(67), dashes)], 200)
    assert [x[[0, -1]].tolist() for x in found] == [[0, (1 << 20) - 200], [0, (1 << 20) - 200], [1, (1 << 20) - 199]]
    assert [len(x) for x in found] == [(1 << 20) - 199] * 3 and time.monotonic() - begun < 30


@pytest.mark.parametrize("block", [1 << 20, 40])
def test_decontaminate(frame, monkeypatch, block):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", block)
    docs = texts(3, 40)
    source = dict(docs)
    items = [(1, " ".join(source[9].split()[5:40])), (2, "One  two"), (3, None), (4, ""), (5, source[12]), (1, "unseen words here"), (10, source[9])]
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    windows = defaultdict(set)
    for item, t in items:
        w = words(t)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[k:k + n])].add(str(item))
    expected = []
    for i, t in docs:
        w, hit, ids = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if found := windows.get(tuple(w[k:k + n])):
                    hit.update(range(k, k + n))
                    ids |= found
        expected.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    bench = frame(items, "item_id long, text string")
    got = decontamination.decontaminate(frame(rows_of(docs), DOCS), bench).drop("items", "spans").collect()
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(map(repr, expected))
    clean = decontamination.uncontaminated(frame(rows_of(docs), DOCS), bench)
    assert clean.count() == sum(not e[-1] for e in expected) and clean.columns == [c.split()[0] for c in DOCS.split(", ")]
    empty = decontamination.decontaminate(frame(rows_of(docs), DOCS), frame([], "item_id long, text string"))
    assert empty.where("contaminated or n_hit > 0").count() == 0


def test_mix(frame):
    docs = texts(4, 90)
    first = mixing.mix(frame(rows_of(docs), DOCS)).collect()
    again = mixing.mix(frame(rows_of(docs)[::-1], DOCS).repartition(5)).collect()
    key = lambda r: repr((r.doc_id, r["size"], r.taken))
    assert sorted(map(key, first)) == sorted(map(key, again)) and len(first) == len(docs)
    assert all(0 <= r.taken <= 2 * r["size"] and r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in first)
    sources = defaultdict(list)
    for r in first:
        sources[r.source].append(r)
    totals = {s: sum(r["size"] for r in own) for s, own in sources.items()}
    order = sorted(totals, key=lambda s: (s is None, s))
    weights, left, capped = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}, 1.5 * sum(totals.values()), {}
    while True:
        rest = [s for s in order if s not in capped]
        goal = {s: (left - sum(capped.values())) * weights[s] / sum(weights[t] for t in rest) for s in rest}
        over = [s for s in rest if goal[s] > 2 * totals[s]]
        if not over:
            break
        capped |= {s: 2 * totals[s] for s in over}
    goal |= capped
    for s, own in sources.items():
        assert own[0].target == pytest.approx(goal[s])
        assert abs(sum(r.taken for r in own) - goal[s]) <= 2 * max(r["size"] for r in own)
    assert mixing.mix(frame([], DOCS)).count() == 0


def test_sharding(frame):
    table = sharding.lookup_table([f"s{k}" for k in range(7)], 101)
    assert max(Counter(table).values()) - min(Counter(table).values()) <= 1
    fewer = sharding.lookup_table([f"s{k}" for k in range(6)], 101)
    assert sum(x == y for x, y in zip(table, fewer, strict=True) if x < 6) > 60
    got = sharding.place(frame(rows_of(texts()), DOCS)).collect()
    assert len(got) == len(texts()) and all(0 <= r["shard"] < 64 and r["size"] == "z" for r in got)
    shards = defaultdict(set)
    for r in got:
        shards[r.doc_id].add(r["shard"])
    assert all(len(x) == 1 for x in shards.values())
    with pytest.raises(ValueError):
        sharding.lookup_table([], 7)


def test_boosting_and_calibration():
    draw = np.random.default_rng(3)
    x = draw.normal(size=(600, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    assert ((fit(x[:400], y[:400]).raw(x[400:]) > 0) == y[400:]).mean() > 0.9
    knots, values = isotonic(np.array([0.1, 0.2, 0.2, 0.3, 0.9]), np.array([0, 1, 0, 0, 1.0]))
    assert (np.diff(values) >= 0).all() and (np.diff(knots) >= 0).all() and 0 < values.min() and values.max() < 1
    assert len(fit(np.zeros((0, 4)), np.zeros(0)).trees) == 0


def test_toxicity(frame, spark):
    draw = random.Random(6)
    usual = [f"word{k}" for k in range(80)]
    docs, labels = [(-1, None), (-2, "")], [(-1, None), (-2, 5), (None, 1)]
    for i in range(400):
        bad = i % 5 == 0
        own = [draw.choice(usual) for _ in range(40)] + [draw.choice(("idiot", "grumblor", "snarfel"))] * (2 * bad)
        draw.shuffle(own)
        docs.append((i, " ".join(own)))
        labels.append((i, int(bad)))
    toxic = frame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.judge(frame(rows_of(docs), DOCS), toxic).collect()}
    assert len(got) == len(docs) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())
    kept_apart = [r for i, r in got.items() if i >= 0 and r.held_out]
    assert len(kept_apart) > 50 and sum(r.predicted == (r.doc_id % 5 == 0) for r in kept_apart) >= 0.97 * len(kept_apart)
    model = toxicity.train(frame(rows_of(docs), DOCS), toxic)
    kept = toxicity.accepted(frame(rows_of(docs), DOCS), model)
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.predicted}
    none = toxicity.judge(frame(rows_of(docs), DOCS), frame([], "doc_id long, toxic int")).collect()
    assert {r.predicted for r in none} == {0}
    assert toxicity.judge(frame([], DOCS), toxic).count() == 0
