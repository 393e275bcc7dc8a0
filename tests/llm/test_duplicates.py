"""Similarity join, repeated strings and words, leaks and fingerprints against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest

from floe.llm import decontaminate, fmindex, jaccard, spots, suffix
from floe.llm.common import components

rng = random.Random(3)
VOC = [f"w{i}" for i in range(2000)]
draw = lambda n: [rng.choice(VOC) for _ in range(n)]


def frame(spark, rows, schema="doc_id long, text string, spans int, uid int"):
    """Documents with columns whose names clash with inner ones."""
    return spark.createDataFrame([(i, t, 1, 2) for i, t in rows], schema)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.fixture(scope="module")
def rows():
    base = cur = draw(120)
    out = []
    for _ in range(60):
        out.append(" ".join(cur))
        cur = cur[:]
        cur[rng.randrange(120)] = rng.choice(VOC)
    passages = [draw(rng.randrange(20, 120)) for _ in range(6)]
    for _ in range(120):
        x = []
        for _ in range(rng.randrange(0, 4)):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            x += draw(rng.randrange(40)) + (p[a : rng.randrange(a, len(p))] if rng.random() < 0.6 else p)
        out.append(" ".join(x))
    out += ["ab " * 400, "ab " * 300, "a" * 1000, "x" * 250 + "a" * 400, " ".join(["rep"] * 90), " ".join(base), " ".join(base), "", "  \n", "é" * 300, "é" * 150 + "b", "A b c D"]
    out += [" ".join(rng.choice(VOC[:2]) for _ in range(200)) for _ in range(20)]
    return [*enumerate(out), (9000, None), (5, out[5])]


def sets_of(rows, n):
    out = {}
    for i, t in rows:
        w = words(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out[i] = frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])
    return out


@pytest.mark.parametrize("n, percent", [(3, 90), (5, 80), (2, 50)])
def test_similar_equals_all_pairs(spark, rows, n, percent):
    sets = sets_of(rows, n)
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    got = jaccard.similar(frame(spark, rows), n, percent).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == {(i, len(sets[i]), root(i)) for i in sets}


def test_bound_never_loses_a_link():
    bands = jaccard.Bands(80)
    for _ in range(300):
        a = np.unique(np.random.default_rng(rng.randrange(1 << 30)).integers(1, 1 << 62, rng.randrange(5, 300)).astype(np.uint64))
        b = np.concatenate((a[: int(len(a) * 0.9)], np.arange(int(len(a) * 0.1), dtype=np.uint64)))
        both = len(np.intersect1d(a, b))
        if 100 * both < 80 * (len(a) + len(b) - both):
            continue
        keys, where = jaccard.set_cells(np.concatenate((np.sort(a), np.sort(b))), np.array([len(a), len(b)]), bands)
        assert set(keys[where == 0]) & set(keys[where == 1])


def test_sets_that_agree_on_no_filled_cell_meet_in_empty_ones():
    """Of two sets that both fill few cells, a difference may lie in every filled one."""
    bands = jaccard.Bands(80)
    missed = 0
    for seed in range(4000):
        a = np.unique(np.random.default_rng(seed).integers(1, 1 << 62, 9).astype(np.uint64))
        for b in (a[1:], np.unique(np.append(a, np.uint64(seed + 1)))):
            keys, where = jaccard.set_cells(np.concatenate((a, b)), np.array([len(a), len(b)]), bands)
            missed += not set(keys[where == 0]) & set(keys[where == 1])
    assert not missed


@pytest.mark.parametrize("sizes", [(3000, 2500), (40_000, 33_000), (300, 2100), (1, 9000)])
def test_folded_count_vectors_bound_what_is_shared(sizes):
    hashes = np.unique(np.random.default_rng(sizes[0]).integers(1, 1 << 62, sum(sizes)).astype(np.uint64))
    a, b = np.sort(hashes[: sizes[0]]), np.sort(hashes[sizes[0] // 3 : sizes[0] // 3 + sizes[1]])
    both = len(np.intersect1d(a, b))
    x, y = jaccard._points(np.concatenate((a, b)), np.array([len(a), len(b)]))
    assert [len(x), len(y)] == jaccard.groups_of(np.array([len(a), len(b)])).tolist()
    left, right = jaccard._alike([x, y])
    assert both <= np.minimum(left, right).sum() <= both + 0.95 * (min(sizes) - both) + 50


def test_full_counts_bound_nothing():
    full, few = bytes([jaccard.FULL]) * 512, bytes([jaccard.FULL]) + bytes([1]) * 255
    left, right = jaccard._alike([full, few])
    assert left[0] >= 1 << 20 and right[0] >= 1 << 20 and np.minimum(left, right)[1:].sum() == 255


def cut_by_brute_force(rows, width, split, join):
    cut = {(i, t): split(t) for i, t in rows}
    counts = collections.Counter()
    for i, t in rows:
        x = cut[i, t]
        counts.update(x[k : k + width] if isinstance(x, bytes) else tuple(x[k : k + width]) for k in range(len(x) - width + 1))
    out = set()
    for (i, _), x in cut.items():
        gone = np.zeros(len(x), bool)
        for k in range(len(x) - width + 1):
            if counts[x[k : k + width] if isinstance(x, bytes) else tuple(x[k : k + width])] > 1:
                gone[k : k + width] = True
        edges = np.diff(np.concatenate(([0], gone.view(np.int8), [0])))
        out.add((i, len(x), int(gone.sum()), int((edges == 1).sum()), hashlib.sha256(join(x, ~gone)).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [100_000, 5])
def test_repeated_bytes(spark, rows, hot):
    want = cut_by_brute_force(rows, 200, lambda t: (t or "").encode(), lambda x, keep: np.frombuffer(x, np.uint8)[keep].tobytes())
    got = suffix.remove_repeats(frame(spark, rows), hot_size=hot).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in got} == want


@pytest.mark.parametrize("hot", [100_000, 5])
def test_repeated_words(spark, rows, hot):
    want = cut_by_brute_force(rows, 35, words, lambda x, keep: " ".join(w for w, k in zip(x, keep) if k).encode())
    got = fmindex.remove_repeats(frame(spark, rows), hot_size=hot).collect()
    assert {(r.doc_id, r.n_words, r.n_removed, len(r.spans), hashlib.sha256(r.kept.encode()).hexdigest()) for r in got} == want


def test_suffix_array_order():
    for _ in range(800):
        text = [rng.randrange(rng.choice((2, 3, 6))) for _ in range(rng.randrange(40))]
        order = suffix.suffix_array(text)
        assert order == sorted(range(len(text)), key=lambda i: text[i:])
        shared = suffix.shared_beginnings(text, order)
        for a, b in zip(order, order[1:]):
            k = 0
            while max(a, b) + k < len(text) and text[a + k] == text[b + k]:
                k += 1
            assert shared[b] == k


def test_backward_search_counts():
    text = np.array([rng.randrange(1, 5) for _ in range(300)] + [0])
    index = fmindex.FMIndex(text)
    for _ in range(200):
        p = [rng.randrange(1, 5) for _ in range(rng.randrange(1, 5))]
        low, high = np.array([0]), np.array([len(text)])
        for c in reversed(p):
            low, high = index.extend(np.array([c]), low, high)
        assert int(high[0] - low[0]) == sum(text[i : i + len(p)].tolist() == p for i in range(300))


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 103), (103, 101), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {i: 0 for i in range(1, 51)} | {101: 100, 103: 100}


def word_edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row


def test_leaks_reach_recall_and_are_exact(spark):
    items, docs = [], []
    for n in (8, 12, 20, 38, 60):
        for _ in range(20):
            item = draw(n)
            edited = item[:]
            for _ in range(n // 5):
                k = rng.randrange(len(edited))
                rng.choice((lambda: edited.__setitem__(k, "zz"), lambda: edited.pop(k), lambda: edited.insert(k, "yy")))()
            items.append(item)
            docs.append(" ".join(draw(30) + edited + draw(30)))
    benchmark = spark.createDataFrame([*enumerate(" ".join(i).upper() for i in items), (500, None), (501, "too short")], "item_id long, text string")
    table = frame(spark, [*enumerate(docs), (900, " ".join(draw(400))), (901, None), (902, ""), (903, "too short")])
    got = decontaminate.leaks(table, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in got} <= {(i, i) for i in range(100)}
    assert len(got) >= 95
    for r in got[:30]:
        run = words(docs[r.doc_id])[r.word_start : r.word_start + r.n_words]
        assert word_edits(items[r.item_id], run)[-1] == r.distance <= len(items[r.item_id]) // 5
    kept = decontaminate.clean(table, benchmark)
    assert {r.doc_id for r in kept.collect()} == {i for i in [*range(100), 900, 901, 902, 903] if i not in {r.doc_id for r in got}}
    assert kept.columns == table.columns
    assert decontaminate.leaks(table, benchmark, block=30).count() == len(got)
    assert decontaminate.leaks(table.limit(0), benchmark).count() == 0
    assert decontaminate.leaks(table, benchmark.limit(0)).count() == 0


@pytest.mark.parametrize("n", [61, 120, 250, 400])
def test_leaks_of_long_items(spark, n):
    own = random.Random(n)
    pick = lambda k: [f"w{own.randrange(300)}" for _ in range(k)]
    items, docs = [], []
    for _ in range(40):
        item = pick(n)
        edited = item[:]
        for _ in range(n // 5):
            k = own.randrange(len(edited))
            own.choice((lambda: edited.__setitem__(k, "zz"), lambda: edited.pop(k), lambda: edited.insert(k, "yy")))()
        items.append(item)
        docs.append(" ".join(pick(30) + edited + pick(30)))
    far = items[0][: n // 2] + pick(n)  # half of an item is none
    benchmark = spark.createDataFrame([*enumerate(" ".join(i) for i in items)], "item_id long, text string")
    table = frame(spark, [*enumerate(docs), (900, " ".join(far)), (901, " ".join(items[0][n // 10 :])), (902, " ".join(items[0]))])
    got = {(r.doc_id, r.item_id): r for r in decontaminate.leaks(table, benchmark).collect()}
    assert set(got) <= {(i, i) for i in range(40)} | {(901, 0), (902, 0)} and len([d for d, _ in got if d < 40]) >= 39
    assert (got[902, 0].word_start, got[902, 0].n_words, got[902, 0].distance, got[902, 0].similarity) == (0, n, 0, 1.0)
    assert (got[901, 0].word_start, got[901, 0].n_words, got[901, 0].distance) == (0, n - n // 10, n // 10)
    for (i, _), r in list(got.items())[:4]:
        if i < 40:
            text = words(docs[i])
            assert word_edits(items[i], text[r.word_start : r.word_start + r.n_words])[-1] == r.distance
            best = min((min(word_edits(items[i], text[a : a + n + n // 5])), a) for a in range(len(text)) if 30 - n // 5 <= a <= 30 + n // 5)
            assert (r.distance, r.word_start) == best
    assert decontaminate.clean(table, benchmark).count() == table.count() - len({d for d, _ in got})


def test_items_without_an_id(spark):
    item, other = [f"a{k}" for k in range(20)], [f"b{k}" for k in range(20)]
    benchmark = spark.createDataFrame([(None, " ".join(item)), (None, " ".join(other)), (7, " ".join(other)), (None, None)], "item_id long, text string")
    docs = frame(spark, [(1, " ".join(item)), (2, "x " + " ".join(other)), (None, " ".join(item)), (3, " ".join(draw(40)))])
    got = decontaminate.leaks(docs, benchmark).collect()
    assert sorted(((r.doc_id, r.item_id, r.word_start, r.distance) for r in got), key=str) == sorted([(1, None, 0, 0), (2, None, 1, 0), (2, 7, 1, 0), (None, None, 0, 0)], key=str)
    assert [r.doc_id for r in decontaminate.clean(docs, benchmark).collect()] == [3]


def test_fingerprints_of_edits(spark, rows):
    docs = [(i, t) for i, t in rows if i != 5] + [(5, dict(rows)[5])]
    got = sorted(spots.compare_edits(frame(spark, docs).repartition(5)).collect(), key=lambda r: r.doc_id)
    order = sorted(docs)
    tool = spots.Spots()
    assert [r.doc_id for r in got] == [i for i, _ in order]
    for k, (r, (_, text)) in enumerate(zip(got, order)):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        q = len(text) // 4
        edited = text[: len(text) - q] + following[:q]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.fingerprint == spots.encode(tool.signatures(text.encode()))
        assert r.edited_fingerprint == spots.encode(tool.signatures(edited.encode()))
        assert r.near_next == pytest.approx(spots.likeness(tool.signatures(text.encode()), tool.signatures(following.encode())))
    assert spots.with_next(frame(spark, docs), texts_per_bucket=20).select("bucket").distinct().count() > 5
    assert spots.compare_edits(frame(spark, docs).limit(0)).count() == 0


def test_near_fingerprints_equal_all_pairs(spark, rows):
    prints = spots.fingerprints(frame(spark, rows))
    first = {}
    for r in prints.collect():
        if r.fingerprint:
            first[r.fingerprint] = min(r.doc_id, first.get(r.fingerprint, r.doc_id))
    ids = sorted((i, spots.decode(p)) for p, i in first.items())
    want = {(a, b) for a, x in ids for b, y in ids if a < b and spots.likeness(x, y) >= 0.6}
    assert {(r.a, r.b) for r in spots.near_pairs(prints, 0.6).collect()} == want


@pytest.mark.parametrize("make", [lambda d: jaccard.similar(d), lambda d: suffix.remove_repeats(d), lambda d: fmindex.remove_repeats(d)])
def test_empty_tables(spark, make):
    assert make(frame(spark, [], "doc_id long, text string, spans int, uid int")).count() == 0


def test_verification_in_turns_equals_one_turn(spark, monkeypatch):
    from floe.llm import jaccard

    texts = spark.createDataFrame([(i, " ".join(f"w{(i % 7) * 3 + k}" for k in range(30 + i % 3))) for i in range(40)], "doc_id bigint, text string")
    pairs = spark.createDataFrame([(i, j) for i in range(40) for j in range(i + 1, 40)], "a bigint, b bigint")
    whole = sorted(map(tuple, jaccard._verified(pairs, texts, 3, 80).collect()))
    monkeypatch.setattr(jaccard, "TURN_BYTES", 1)
    monkeypatch.setattr(jaccard, "TURN_SHARE", 5.0)
    assert whole and sorted(map(tuple, jaccard._verified(pairs, texts, 3, 80).collect())) == whole
