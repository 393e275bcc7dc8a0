"""Conversation repair, column-sharded centroids and the two-pass shuffle, held against plain recomputation."""

import hashlib
import heapq
import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest

from floe.llm import centroids, conversations, sharding

# --- conversation repair


def cheapest(kinds):
    """Least (cost, audit) by best-first search over (rows used, roles so far); kinds as the parser's."""
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, audit, at, roles = heapq.heappop(heap)
        tail = roles[-2:] if len(roles) > 2 else roles
        if (at, tail, len(roles) % 2, roles[:1]) in seen:
            continue
        seen.add((at, tail, len(roles) % 2, roles[:1]))
        body = roles.removeprefix("s")
        if at == len(kinds) and (not roles or (body and body == "ua" * (len(body) // 2))):
            return cost, audit
        if len(roles) > 2 * len(kinds) + 6 or ("ua" * 50)[: len(body)] != body:
            continue
        for role in "ua":
            heapq.heappush(heap, (cost + 5, audit + "I", at, roles + role))
        if at == len(kinds):
            continue
        kind = kinds[at]
        heapq.heappush(heap, (cost + 2, audit + "D", at + 1, roles))
        if kind == "-":
            continue
        more = 5 if kind.isupper() else 0
        role = kind.lower()
        if role in "ua" or (role == "s" and not roles):
            heapq.heappush(heap, (cost + more, audit + "K", at + 1, roles + role))
        for role in "ua":
            heapq.heappush(heap, (cost + 1 + more, audit + "R", at + 1, roles + role))


def test_parser_finds_the_cheapest_repair():
    for n in range(5):
        for kinds in itertools.product("suaxUA-", repeat=n):
            assert conversations.finished(conversations.parsed("".join(kinds), 0)) == cheapest("".join(kinds)), kinds


def test_blocks_compose_to_the_whole():
    rng = np.random.default_rng(1)
    for _ in range(200):
        kinds = "".join(rng.choice(list("ssuuaaxSUA-"), 14))
        whole = conversations.parsed(kinds, 0)
        cut = int(rng.integers(0, 15))
        first = {0: conversations.parsed(kinds[:cut], 0)}
        second = {e: conversations.parsed(kinds[cut:], e) for e in conversations.STACKS}
        assert conversations.composed(first, second)[0] == whole


def repair(rows):
    """Everything the query returns, from rows (conv_id, turn, role, text)."""
    space = lambda v: " " if v is None else str(v)
    by = {}
    for conv, turn, role, text in rows:
        mine = by.setdefault(conv, [])
        fault = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else space(text).translate({46: None, 33: None, 63: None}) if fault == 2 else space(text)
        role = "user" if fault == 4 else space(role)
        mine += [(turn, role, text)] * (2 if fault == 3 else 1)
    out = {}
    for conv, mine in by.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
        kinds, seen, counts = "", set(), Counter()
        for _, role, text in mine:
            rest = text.strip(" \t\n\x0b\x0c\r")
            first = role[:1] if role[:1] in tuple("sua") else "x"
            fault = "blank" if not rest else "duplicate" if (role, text) in seen else "truncated" if rest[-1] not in ".!?" else ""
            seen.add((role, text))
            counts[fault] += 1
            kinds += "-" if fault in ("blank", "duplicate") else first.upper() if fault else first
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        turns = [t for t, _, _ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit = cheapest(kinds)
        lines, at, onward = [], 0, "user"
        for edit in audit:
            if edit == "D":
                at += 1
                continue
            role, text = (onward, "") if edit == "I" else (mine[at][1] if edit == "K" else onward, mine[at][2])
            at += edit != "I"
            lines.append(f"{role}:{text}")
            onward = "assistant" if role[0] == "u" else "user"
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, digest)
    return out


CASES = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hello?"), (1, 2, "assistant", "Yes."), (1, 9, "assistant", "no end"),
    (2, 3, None, "What?"), (2, None, "user", None), (2, None, "user", "Late."), (2, 3, "user", "What?"), (2, 3, "user", "What?"),
    (3, 0, "tool", "x" * 200_000), (3, 1, "", "Empty role."), (3, 2, "User", "Capital.\x85"), (4, None, None, None),
    (None, 0, "user", "No id."), (None, 1, "assistant", "ends. "), (5, 5, "user", "\t\n "), *[(6, t, "user assistant".split()[t % 3 % 2], f"Line {t % 5}.") for t in range(60)],
]


@pytest.mark.parametrize("block, fan", [(256, 64), (2, 2)])
def test_repair_equals_brute_force(spark, monkeypatch, block, fan):
    monkeypatch.setattr(conversations, "BLOCK", block)
    monkeypatch.setattr(conversations, "FAN", fan)
    rows = CASES if block == 2 else CASES + [(10 + i, t, r, f"{i} {t}.") for i in range(40) for t, r in enumerate(("system", "user", "assistant", "user", "assistant")[i % 2 :])]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, key string, part int")
    found = {r[0]: tuple(r[1:]) for r in conversations.repaired(frame).collect()}
    assert found == repair(rows)


def test_repair_of_an_empty_table(spark):
    assert conversations.repaired(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")).count() == 0


# --- centroids


def plain_lloyd(rows, k, rounds, size, scale=256):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))[:k]
    centres = [list(v) for _, v in start]
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for j, members in groups.items():
            centres[j] = [sum(x) // len(members) for x in zip(*members)]
    return sorted(((i if i is not None else -1), nearest(v)[1], nearest(v)[0], hashlib.sha256(",".join(map(str, centres[nearest(v)[1]])).encode()).hexdigest()) for i, v in kept)


@pytest.mark.parametrize("wide", [1.0, 1e7, 1e12])
def test_lloyd_equals_plain_integers(spark, wide):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=6) * wide]) for i in range(150)]
    rows += [(7, rows[7][1]), (7, rows[8][1])] + [(200 + i, rows[0][1]) for i in range(60)]  # repeated ids, one hot vector
    rows += [(300, None), (301, []), (302, [1.0] * 5), (303, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (304, [float("nan")] * 6), (305, [float("inf")] * 6), (None, [0.5] * 6)]
    frame = spark.createDataFrame([(i, v, "x", 0) for i, v in rows], "vec_id bigint, embedding array<double>, chunk string, cluster int")
    found = centroids.clustered(frame, k=5, rounds=4, size=6, shards=4, chunk=16).collect()
    plain = plain_lloyd(rows, 5, 4, 6)
    top = (1 << 63) - 1
    assert sorted((r.vec_id if r.vec_id is not None else -1, r.cluster, r.distance, r.centroid_sha256) for r in found) == [(i, c, d if d <= top else None, h) for i, c, d, h in plain]
    sums = Counter()
    for _, c, d, _ in plain:
        sums[c] += d
    known = all(d <= top for _, _, d, _ in plain)
    for r in found:
        if known:
            assert r.cluster_inertia == (sums[r.cluster] if sums[r.cluster] <= top else None) and r.inertia == (sum(sums.values()) if sum(sums.values()) <= top else None)


def test_lloyd_with_few_vectors(spark):
    one = spark.createDataFrame([(1, [0.5] * 64)], "vec_id bigint, embedding array<float>")
    assert [tuple(r)[:5] for r in centroids.clustered(one).collect()] == [(1, 0, 0, 0, 0)]
    assert centroids.clustered(one.limit(0)).count() == 0


# --- two-pass shuffle


def placed(frame, **options):
    return [(r.record, r.shard, r.slot) for r in sharding.sharded(frame, **options).collect()]


@pytest.mark.parametrize("rows, shards", [(0, 40), (7, 40), (40, 40), (1003, 40), (1003, 1)])
def test_shards_are_even_and_whole(spark, rows, shards):
    data = [(i if i % 3 else 5, "same text" if i % 3 == 0 else None if i % 7 == 0 else "" if i % 11 == 0 else f"text {i} " * (i % 50), i, "s") for i in range(rows)]
    frame = spark.createDataFrame(data, "doc_id bigint, text string, bucket bigint, slot string")
    found = placed(frame, shards=shards, bucket_bytes=4000)
    assert Counter(tuple(r) for r, _, _ in found) == Counter(data)
    counts = Counter(s for _, s, _ in found)
    assert rows == 0 or max(counts.values()) - min(counts.get(s, 0) for s in range(shards)) <= 1
    for s in counts:
        assert sorted(slot for _, at, slot in found if at == s) == list(range(counts[s]))


def test_shuffle_mixes_and_repeats(spark, tmp_path):
    spark.range(4000).selectExpr("id as doc_id", "cast(id as string) as text").repartition(3).write.parquet(str(tmp_path / "docs"))
    frame = spark.read.parquet(str(tmp_path / "docs"))
    one, two, other = (sorted((r.doc_id, s, slot) for r, s, slot in placed(frame, shards=10, seed=seed, bucket_bytes=8000)) for seed in (1, 1, 2))
    assert one == two and one != other
    ranks = np.array([s * 400 + slot for _, s, slot in one])
    assert abs(np.corrcoef(np.arange(4000), ranks)[0, 1]) < 0.08
    # every stretch of the input is spread over all shards
    for start in range(0, 4000, 400):
        assert len(set(s for _, s, _ in one[start : start + 400])) == 10


def test_written_shards_keep_their_order(spark, tmp_path):
    frame = spark.range(500).selectExpr("id as doc_id", "repeat('x', cast(id as int)) as text")
    sharding.write_shards(sharding.sharded(frame, shards=4, bucket_bytes=20_000), str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert {r["shard"]: r["count"] for r in back.groupBy("shard").count().collect()} == dict.fromkeys(range(4), 125)
    assert back.filter("length(record.text) <> record.doc_id").count() == 0
