import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from quarrylight.llm import components, decontam, line_dedup, minhash, textsets, toxicity

from .conftest import doc

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _words(rnd, n, size=4000):
    return [f"w{rnd.randrange(size)}" for _ in range(n)]


def _near_docs():
    rnd = random.Random(11)
    rows, base = [], _words(rnd, 120)
    for i in range(120):  # one large group of near copies
        copy = list(base)
        for _ in range(rnd.randrange(4)):
            copy[rnd.randrange(120)] = f"x{rnd.randrange(99)}"
        rows.append(" ".join(copy))
    rows += [rows[0]] * 40 + [" ".join(base[:80] + _words(rnd, 15 + i)) for i in range(30)]
    for i in range(60):
        own = _words(rnd, rnd.randrange(3, 60))
        rows += [" ".join(own), "  " + " ".join(own).upper().replace("W", "w") + "\n", " ".join([*own, "end"])]
    rows += [" ".join(["aa bb cc dd"] * 300), None, "", " \t\n", "one two", "One  two", "é É", "É É"]
    return [doc(i, t) for i, t in enumerate(rows)] + [doc(3, rows[3]), doc(None, rows[0])]


def _shingles(text, k):
    w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


@pytest.mark.parametrize("k", [4, 5])
def test_near_duplicates_equal_brute_force(documents, k):
    rows = _near_docs()
    sets = [_shingles(r[1], k) for r in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                up[top(i)] = top(j)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(top(i), []).append(r[0])
    want = Counter()
    for i, r in enumerate(rows):
        least = min((x for x in groups[top(i)] if x is not None), default=None)
        want[(r[0], len(sets[i]), least, r[0] == least)] += 1
    got = minhash.groups(documents(rows), shingle=k).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == want


@pytest.mark.parametrize("block", [4096, 300])
def test_rare_links_in_large_groups_below_the_threshold(documents, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK_NODES", block)
    rnd, rows, links = random.Random(3), [], []
    for g in range(4):  # copies are 0.65 similar on average, but two pairs of each group are above 0.8
        base = [f"g{g}w{i}" for i in range(160)]
        for i in range(1200):
            places = [20, 60] if i == 5 else [100, 140] if i == 700 else [20, 60, 100, 140] if i % 300 == 9 else rnd.sample(range(10, 150), 4)
            copy = list(base)
            for p in places:
                copy[p] = f"g{g}i{i}p{p}"
            rows.append(" ".join(copy))
    sets = [_shingles(t, 4) for t in rows]
    up = list(range(len(rows)))
    for g in range(4):
        own = range(1200 * g, 1200 * g + 1200)
        names = {x: k for k, x in enumerate(x for x, c in Counter(x for i in own for x in sets[i]).items() if c > 1)}
        held = np.zeros((1200, len(names)), np.float32)
        for i in own:
            held[i - own[0], [names[x] for x in sets[i] if x in names]] = 1
        both, n = held @ held.T, np.array([len(sets[i]) for i in own])
        links += [(own[0] + i, own[0] + j) for i, j in zip(*np.nonzero(100 * both >= 80 * (n[:, None] + n - both)), strict=True) if i < j]
    for i, j in links * 20:
        up[i] = up[j] = min(up[i], up[j])
    assert 4 <= len(links) < 400
    got = {r.doc_id: r.component_id for r in minhash.groups(documents([doc(i, t) for i, t in enumerate(rows)]), shingle=4).collect()}
    assert {i: c for i, c in got.items() if up[i] != c} == {}


@pytest.mark.parametrize("most", [1 << 20, 40])
def test_shared_half_keys_equal_plain_counting(monkeypatch, most):
    monkeypatch.setattr(minhash, "MOST_ROWS", most)
    monkeypatch.setattr(minhash, "DEALT_ROWS", 100)
    rnd = np.random.default_rng(5)
    keys = rnd.integers(0, 60, (40, 2 * minhash.SIDE)) * 100 + np.arange(2 * minhash.SIDE)
    keys[:25, 3] = 3  # a half-key of most nodes
    nodes = np.concatenate([np.arange(40), [7, 7, 9]])  # rows that repeat
    batches = [pa.RecordBatch.from_arrays([pa.array(nodes[a : a + 5]), pa.array(nodes[a : a + 5] + 100), pa.array(keys[nodes[a : a + 5]].tolist(), pa.list_(pa.int64()))], names=["node", "n", "keys"]) for a in range(0, 43, 5)]
    dealt = pa.Table.from_batches(minhash._deal(4)(iter(batches))).sort_by("bucket")
    got = {(r["i"], r["half"], r["node"], r["n"]) for b in minhash._shared(iter(dealt.to_batches())) for r in b.to_pylist()}
    by = {}
    for node in range(40):
        for i, k in enumerate(keys[node].tolist()):
            by.setdefault((i, k), set()).add(node)
    assert got == {(i, k, node, node + 100) for (i, k), own in by.items() if len(own) > 1 for node in own}


def test_deduplicate_keeps_one_row_each(documents):
    df = documents([doc(1, "a b c d e f"), doc(1, "a b c d e f"), doc(2, "A b c d e f"), doc(3, None), doc(4, ""), doc(5, "")])
    out = minhash.deduplicate(df)
    assert out.columns == df.columns
    assert sorted(r.doc_id for r in out.collect()) in ([1, 4, 5], [1, 3, 4, 5])
    assert 3 in {r.doc_id for r in out.collect()}
    assert minhash.groups(documents([])).count() == 0


@pytest.mark.parametrize("local", [0, 1000])
def test_components(spark, monkeypatch, local):
    monkeypatch.setattr(components, "LOCAL_EDGES", local)
    rnd = random.Random(4)
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(120)] + [(500 + i, 501 + i) for i in range(40)] + [(900, 1000 + i) for i in range(50)]
    got = {r.node: r.label for r in components.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    up = {x: x for e in edges for x in e}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = sorted((top(a), top(b)))
        up[y] = x
    assert got == {x: top(x) for x in up if any(x in e and e[0] != e[1] for e in edges)}
    assert components.connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_hashed_words_see_bytes_not_places():
    run = ["Ab cd", "", "ab\tCD  ab", "É é"]
    words, of = textsets.hashed_words([r.encode() for r in run])
    assert of.tolist() == [0, 0, 2, 2, 2, 3, 3]
    assert words[0] == words[2] == words[4] and words[1] == words[3] and len(np.unique(words)) == 4


def _decontaminated(text, items):
    tok = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    w, hit, found = tok(text), set(), set()
    for i, t in items:
        b = tok(t)
        n = min(13, len(b))
        for k in range(len(b) - n + 1) if n else ():
            for at in range(len(w) - n + 1):
                if w[at : at + n] == b[k : k + n]:
                    hit |= set(range(at, at + n))
                    if i is not None:
                        found.add(str(i))
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)


def test_decontamination_equals_brute_force(spark, documents):
    rnd = random.Random(8)
    passages = [" ".join(_words(rnd, n, 50)) for n in (13, 14, 30, 45, 5, 1)]
    items = [*enumerate(passages), (10, passages[2]), (9, "!!!"), (None, " ".join(_words(rnd, 20, 50))), (12, None), (2, passages[2])]
    rows = [doc(i, " ".join([*_words(rnd, rnd.randrange(60), 50), rnd.choice(passages).upper().replace(" ", "-"), *_words(rnd, rnd.randrange(400), 5000)])) for i in range(60)]
    rows += [doc(100, passages[3]), doc(101, None), doc(102, ""), doc(103, "..."), doc(100, passages[3]), doc(104, "café " + passages[0] + "Ünd"), doc(None, passages[1])]
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS h", "2 AS len")
    got = Counter(tuple(r) for r in decontam.report(documents(rows), bench).collect())
    assert got == Counter((r[0], *_decontaminated(r[1], items)) for r in rows)
    assert {r.n_hit for r in decontam.report(documents(rows), bench.limit(0)).collect()} == {0}
    assert decontam.report(documents([]), bench).count() == 0


def test_beyond_the_broadcast_bound(spark, documents, monkeypatch):
    bench = spark.createDataFrame([(1, " ".join(f"b{i}" for i in range(20)))], "item_id long, text string")
    df = documents([doc(1, " ".join(f"B{i}" for i in range(20))), doc(2, "clean")])
    want = sorted(map(tuple, decontam.report(df, bench).collect()))
    monkeypatch.setattr(decontam, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(decontam, "BROADCAST_HITS", 0)
    assert sorted(map(tuple, decontam.report(df, bench).collect())) == want
    assert [r.doc_id for r in decontam.decontaminate(df, bench).collect()] == [2]


def test_documents_and_spans_are_removed(spark, documents):
    passage = " ".join(f"b{i}" for i in range(13))
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    rest = " ".join(f"r{i}" for i in range(300))
    df = documents([doc(1, passage), doc(2, f"{rest}, {passage}! {rest}."), doc(3, rest), doc(4, None)])
    out = decontam.decontaminate(df, bench)
    assert out.columns == df.columns
    assert {r.doc_id: r.text for r in out.collect()} == {2: f"{rest}! {rest}.", 3: rest, 4: None}


def _lines_removed(rows):
    first, sets, out = {}, [], {}
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        for k, line in enumerate(t.split("\n") if t is not None else []):
            s = frozenset(re.findall("[^\x20\x09-\x0d]+", line.translate(LOWER)))
            if not s:
                continue
            near = s not in first and any(100 * len(s & o) >= 80 * len(s | o) for o in sets)
            if s in first or near:
                out.setdefault(i, []).append(k)
            if s not in first:
                first[s] = (i, k)
                sets.append(s)
    return out


@pytest.mark.parametrize(("block", "few"), [(4096, 300_000), (4096, 0), (8, 0)])
def test_line_dedup_equals_brute_force(documents, monkeypatch, block, few):
    monkeypatch.setattr(line_dedup, "BLOCK", block)
    monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", few)
    monkeypatch.setattr(line_dedup, "MORE_PARTNERS", 2 if block == 8 else 16)
    monkeypatch.setattr(line_dedup, "BUCKET_ROWS", 100)
    rnd = random.Random(6)
    lines = [" ".join(_words(rnd, rnd.randrange(1, 30), 300)) for _ in range(80)] + ["", "  ", "the", "The the"]
    for _ in range(120):
        words = rnd.choice(lines[:80]).split()
        words[rnd.randrange(len(words))] = f"n{rnd.randrange(50)}"
        lines.append(" ".join(words))
    rows = [(i, "\n".join(rnd.choices(lines, k=rnd.randrange(1, 9)))) for i in range(90)] + [(200, None), (201, ""), (None, lines[5])]
    df = documents([doc(*r) for r in rows])
    want = _lines_removed(rows)
    got = line_dedup.report(df).collect()
    assert {r.doc_id: r.removed for r in got} == {i: ",".join(map(str, want.get(i, []))) for i, _ in rows}
    assert all(r.n_same + r.n_near == len(want.get(r.doc_id, [])) for r in got)
    texts = {r.doc_id: r.text for r in line_dedup.deduplicate(df).collect()}
    for i, t in rows:
        assert texts[i] == (t if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in want.get(i, [])))
    assert line_dedup.report(documents([])).count() == 0


def test_line_dedup_of_rows_that_share_an_id(documents):
    line = " ".join(f"a{i}" for i in range(20))
    rows = [doc(1, line), doc(1, "zz other words"), doc(2, line + " end"), doc(None, "b1 b2 b3 b4 b5 b6"), doc(None, "zz more\nx\nb1 b2 b3 b4 b5 b6 b7")]
    got = {r.doc_id: (r.n_lines, r.n_same, r.n_near, r.removed) for r in line_dedup.report(documents(rows)).collect()}
    assert got == {1: (2, 0, 0, ""), 2: (1, 0, 1, "0"), None: (4, 0, 1, "2")}


def _toxic_docs(n=900):
    rnd = random.Random(9)
    rows, labels = [], []
    for i in range(n):
        toxic, words = rnd.random() < 0.15, _words(rnd, rnd.randrange(20, 200), 3000)
        if toxic:
            for _ in range(3):
                words[rnd.randrange(len(words))] = rnd.choice(["idiot", "loweia", "loweib", "loweic", "vequx", "vequy", "zorp"])
        rows.append(doc(i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark, documents):
    rows, labels = _toxic_docs()
    df = documents([*rows, doc(5000, None), doc(5001, ""), doc(5002, "x" * 500_000), doc(7, rows[7][1])])
    truth = dict(labels)
    known = spark.createDataFrame([*labels, (7, None), (None, 1)], "doc_id long, toxic int").selectExpr("*", "'q' AS id")
    model = toxicity.train(df, known)
    out = toxicity.score(df, model).collect()
    assert len(out) == len(rows) + 4 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    held = [r for r in out if r.held_out and r.doc_id < 5000]
    assert len(held) > 100 and sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    kept = {r.doc_id for r in toxicity.reject(df, model).collect()}
    assert {5000, 5001, 5002} <= kept and kept == {r.doc_id for r in out if not r.predicted}
    # Held-out labels are never read: turning them over changes nothing.
    import zlib

    turned = [(i, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, t in labels]
    again = toxicity.train(df, spark.createDataFrame(turned, "doc_id long, toxic int"))
    assert again.voters == model.voters and np.allclose(again.weights, model.weights)


@pytest.mark.parametrize("text,caps", [("Abc" * 2000, False), ("aBC" * 2000, True), ("ÄÖé" * 2000, True), ("Äöü" * 2000, False), ("AB" * 20 + "ab" * 20, False), ("", False)])
def test_capitals_are_counted_over_whole_texts(text, caps):
    assert toxicity._patterns(text, [])[0] is caps and toxicity._capitals(text) == sum(map(str.isupper, text))


def test_label_model_equals_plain_steps(monkeypatch):
    """The same steps on whole matrices, in double precision."""
    monkeypatch.setattr(toxicity, "BLOCK", 7)
    rnd = np.random.default_rng(3)
    truth = rnd.random(300) < 0.3
    votes = (rnd.random((300, 6)) < np.where(truth[:, None], 0.7, 0.1)).astype(np.uint8)
    votes[:, 1] = votes[:, 0]  # two voters that always agree share their evidence
    given = (truth ^ (rnd.random(300) < 0.05)).astype(float)
    posterior, fires, share = toxicity.label_model(votes, given, rounds=4)
    p, v = 0.02 + 0.96 * given, votes.astype(float)
    for _ in range(4):
        by = np.stack([1 - p, p])
        mass = by.sum(1)
        rate, told = (by @ v + 0.5) / (mass + 1)[:, None], (by @ given + 0.5) / (mass + 1)
        size = np.zeros((6, 6))
        for c in (0, 1):
            centred = (v - rate[c]) * np.sqrt(by[c])[:, None]
            spread = np.sqrt((centred**2).sum(0)) + 1e-9
            size += mass[c] / 300 * np.abs(centred.T @ centred / np.outer(spread, spread))
        part = 1 / np.maximum(1, np.where(size > 0.2, size, 0).sum(1))
        odds = [sum(part[j] * np.log((rate[1][j] if x[j] else 1 - rate[1][j]) / (rate[0][j] if x[j] else 1 - rate[0][j])) for j in range(6)) + np.log(mass[1] / mass[0]) + np.log((told[1] if g else 1 - told[1]) / (told[0] if g else 1 - told[0])) for x, g in zip(v, given)]
        p = 1 / (1 + np.exp(-np.array(odds)))
    assert np.allclose(p, posterior, atol=1e-3) and np.allclose(rate, fires, atol=1e-3) and np.allclose(part, share, atol=1e-3)
    assert share[0] <= 0.5 + 1e-6 and ((posterior > 0.5) == truth).mean() > 0.95
    weights, bias = toxicity.fit_linear(votes, np.zeros((300, 1)), posterior)
    assert (((votes @ weights[:6] + bias) > 0) == (posterior > 0.5)).mean() > 0.9


def test_toxicity_without_labels(spark, documents):
    df = documents([doc(1, "you idiot, worthless scum"), doc(2, "a fine day")])
    model = toxicity.train(df, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.doc_id: r.predicted for r in toxicity.score(df, model).collect()} == {1: 1, 2: 0}
    assert toxicity.score(df.limit(0), model).count() == 0


def test_parcels_go_to_python_a_few_at_a_time(spark, documents, monkeypatch):
    shared, most = minhash._shared, minhash.PARCELS

    def counted(batches):
        def few():
            for batch in batches:
                assert batch.num_rows <= most, "all parcels of a task in one batch"
                yield batch

        yield from shared(few())

    monkeypatch.setattr(minhash, "BUCKET_ROWS", 64)
    monkeypatch.setattr(minhash, "_shared", counted)
    rows = [doc(i, " ".join(f"w{i // 2}x{j}" for j in range(30))) for i in range(600)]
    got = {r.doc_id: r.component_id for r in minhash.groups(documents(rows).repartition(4)).collect()}
    assert got == {i: i - i % 2 for i in range(600)}
