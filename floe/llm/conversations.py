"""Repair of role sequences by a generalised LR parser, whatever the length of a conversation.

The grammar of roles is ``S -> e | H``, ``H -> s u a | u a | H u a``. Its LR(0) automaton drives
a graph-structured stack: a row offers several edits at once (keep, rerole, delete, and an insert
before it), each edit shifts a role or leaves the stack, complete right sides are reduced, and
tops in equal states are merged by their least (cost, audit).

1. Rows are brought in order by a range sort of small keys, so a conversation of any size is
   split over tasks; repeated (role, text) pairs are found by their digests.
2. Rows of a conversation form blocks of at most ``BLOCK``. For each stack that can lie below a
   block the parser finds the best edits to each stack above it. Blocks are composed in rounds
   of ``FAN``: the best way through two blocks is the best meeting stack (equal positions and
   equal costs make audits comparable, no one is the beginning of another).
3. Texts move once: each conversation's audit runs beside its rows, in order, as a stream into
   SHA-256. That hash is sequential, so one task reads one conversation's rows, with bounded
   memory. The audit is a result column and as long as its conversation.

Defined cases: null roles and texts are one space, which is blank and no role; a null conv_id is
a conversation of its own; rows of one turn are ordered by the digest of role and text (null
turns first); a role counts by its first character, an empty role has none and cannot be kept;
an empty table gives no rows. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from floe.llm.common import bounded_batches, free, stored

GRAMMAR = (("S", ""), ("S", "H"), ("H", "sua"), ("H", "ua"), ("H", "Hua"))
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
ROLES = {"u": "user", "a": "assistant"}
BLOCK, FAN, MEMO = 256, 64, 100_000
SPACE = " \t\n\x0b\x0c\r"


# --- grammar and parser


class Automaton:
    """LR(0) states of a grammar: shifts and gotos, the reduction of complete states, accepting states."""

    def __init__(self, grammar):
        self.go: list[dict[str, int]] = []
        self.reduce: dict[int, tuple[str, int]] = {}
        self.accept: set[int] = set()
        names = {left for left, _ in grammar}
        start = self._closed({(i, 0) for i, (left, _) in enumerate(grammar) if left == grammar[0][0]}, grammar, names)
        states, todo = {start: 0}, [start]
        for items in todo:
            onward: dict[str, set] = {}
            for rule, dot in items:
                left, right = grammar[rule]
                if dot < len(right):
                    onward.setdefault(right[dot], set()).add((rule, dot + 1))
                elif left == grammar[0][0]:
                    self.accept.add(states[items])
                else:
                    self.reduce[states[items]] = (left, len(right))
            self.go.append({})
            for symbol in sorted(onward):
                target = self._closed(onward[symbol], grammar, names)
                if target not in states:
                    states[target] = len(states)
                    todo.append(target)
                self.go[states[items]][symbol] = states[target]

    @staticmethod
    def _closed(items: set, grammar, names: set) -> frozenset:
        items, todo = set(items), list(items)
        while todo:
            rule, dot = todo.pop()
            right = grammar[rule][1]
            if dot < len(right) and right[dot] in names:
                for i, (left, _) in enumerate(grammar):
                    if left == right[dot] and (i, 0) not in items:
                        items.add((i, 0))
                        todo.append((i, 0))
        return frozenset(items)


AUTOMATON = Automaton(GRAMMAR)

# A node of the stack graph is (state, nodes below); nodes are shared. In this grammar the state on
# top fixes all that lies below it, so equal tops are equal stacks and may be merged by cost alone.
Node = tuple


def shift(node: Node, role: str) -> list[Node]:
    """The stacks after a role: shift, then reduce along every path below while a right side is complete."""
    onward = AUTOMATON.go[node[0]].get(role)
    if onward is None:
        return []
    open_, out = [(onward, (node,))], []
    while open_:
        top = open_.pop()
        if top[0] not in AUTOMATON.reduce:
            out.append(top)
            continue
        left, length = AUTOMATON.reduce[top[0]]
        bases = [top]
        for _ in range(length):
            bases = [below for n in bases for below in n[1]]
        open_ += [(AUTOMATON.go[base[0]][left], (base,)) for base in bases]
    return out


def stacks() -> dict[int, Node]:
    """All stacks that roles can lead to, by the state on top."""
    found, todo = {0: (0, ())}, [(0, ())]
    while todo:
        node = todo.pop()
        for role in "sua":
            for after in shift(node, role):
                if after[0] not in found:
                    found[after[0]] = after
                    todo.append(after)
    return found


STACKS = stacks()
#: (cost, audit) by the state on top
Tops = dict[int, tuple[int, str]]
_AFTER = {(state, role): [n[0] for n in shift(node, role)] for state, node in STACKS.items() for role in "sua"}


def _merge(tops: Tops, state: int, cost: int, audit: str) -> bool:
    if state in tops and tops[state] <= (cost, audit):
        return False
    tops[state] = (cost, audit)
    return True


def inserted(tops: Tops) -> Tops:
    """Tops after any useful inserts."""
    tops, todo = dict(tops), list(tops)
    while todo:
        state = todo.pop()
        cost, audit = tops[state]
        for role in ROLES:
            todo += [after for after in _AFTER[state, role] if _merge(tops, after, cost + INSERT, audit + "I")]
    return tops


def stepped(tops: Tops, kind: str) -> Tops:
    """Tops after inserts and the edit of one row. Its kind is its role's initial (another letter: no role),
    a capital where the row is truncated, and ``-`` where it must go.
    """
    out: Tops = {}
    more = TRUNCATED if kind.isupper() else 0
    for state, (cost, audit) in inserted(tops).items():
        _merge(out, state, cost + DELETE, audit + "D")
        if kind == "-":
            continue
        for after in _AFTER.get((state, kind.lower()), ()):
            _merge(out, after, cost + KEEP + more, audit + "K")
        for role in ROLES:
            for after in _AFTER[state, role]:
                _merge(out, after, cost + REROLE + more, audit + "R")
    return out


def parsed(kinds: str, entry: int) -> Tops:
    """The best edits of rows above the stack of ``entry``, by the stack they lead to."""
    tops: Tops = {entry: (0, "")}
    for kind in kinds:
        tops = stepped(tops, kind)
    return tops


def finished(tops: Tops) -> tuple[int, str]:
    """The best (cost, audit) that is a sentence."""
    return min(found for state, found in inserted(tops).items() if state in AUTOMATON.accept)


def composed(first: dict[int, Tops], second: dict[int, Tops]) -> dict[int, Tops]:
    """Ways through two blocks in turn."""
    out: dict[int, Tops] = {}
    for entry, middle in first.items():
        tops: Tops = {}
        for state, (cost, audit) in middle.items():
            for after, (more, further) in second[state].items():
                _merge(tops, after, cost + more, audit + further)
        out[entry] = tops
    return out


# --- rows


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of the rows after damage, by crc32 of ``conv_id:turn``."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    named = rows.select("conv_id", F.col("turn").cast("bigint").alias("turn"), space("role").alias("role"), space("text").alias("text"), fault.alias("_fault")).filter("_fault <> 0")
    text = F.when(F.col("_fault") == 1, F.lit("")).when(F.col("_fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("_fault") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.when(F.col("_fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return named.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("_copy")).drop("_copy")


def row_key() -> Column:
    """128 bits that name role and text."""
    return F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))


def ordered(rows: DataFrame) -> DataFrame:
    """Small rows (conv_id, turn, key, kind) in order: (part, place) of each, written."""
    last = F.substring(F.rtrim("text", F.lit(SPACE)), -1, 1)
    kind = F.when(last == "", "b").when(last.isin(".", "!", "?"), "f").otherwise("t")
    initial = F.substring("role", 1, 1)
    role = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    small = rows.select("conv_id", "turn", row_key().alias("key"), F.concat(role, kind).alias("kind"), F.monotonically_increasing_id().alias("tie"))
    small = small.repartitionByRange("conv_id", "turn", "key", "tie").sortWithinPartitions("conv_id", "turn", "key")

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, conv, place = TaskContext.get().partitionId(), (), -1
        for batch in batches:
            places = []
            for value in batch.column("conv_id").to_pylist():
                place = place + 1 if conv == (value,) else 0
                conv = (value,)
                places.append(place)
            yield pa.record_batch([*batch.columns, pa.array([part] * batch.num_rows, pa.int32()), pa.array(places, pa.int64())], names=[*batch.schema.names, "part", "place"])

    kind_of = small.schema["conv_id"].dataType.simpleString()
    return stored(small.drop("tie").mapInArrow(placed, f"conv_id {kind_of}, turn bigint, key binary, kind string, part int, place bigint"), "turns")


def blocks(turns: DataFrame) -> DataFrame:
    """At most BLOCK rows of a conversation each: two letters a row in order, and its turns."""
    where = F.struct("part", "place")
    pairs = turns.groupBy("conv_id", "key").agg(F.min(where).alias("first"), F.count("*").alias("n")).filter("n > 1").select(F.col("conv_id").alias("c"), F.col("key").alias("k"), "first")
    marked = turns.join(pairs, turns["conv_id"].eqNullSafe(pairs["c"]) & (F.col("key") == F.col("k")), "left")
    again = F.coalesce(where > F.col("first"), F.lit(False)) & ~F.col("kind").endswith("b")
    marked = marked.withColumn("kind", F.when(again, F.concat(F.substring("kind", 1, 1), F.lit("d"))).otherwise(F.col("kind")))
    marked = marked.withColumn("block", F.expr(f"place div {BLOCK}"))
    each = marked.groupBy("conv_id", "part", "block").agg(
        F.expr("array_join(transform(array_sort(collect_list(struct(place, kind))), x -> x.kind), '')").alias("kinds"),
        F.min("turn").alias("low"), F.max("turn").alias("high"), F.size(F.collect_set("turn")).cast("bigint").alias("turns"),
    )
    return each.withColumn("number", F.row_number().over(Window.partitionBy("conv_id").orderBy("part", "block")) - 1)


SUMMARY = "first string, last string, blank bigint, duplicate bigint, truncated bigint, illegal bigint, low bigint, high bigint, turns bigint, opens boolean, ways array<struct<entry: int, top: int, cost: bigint, audit: string>>"
WAYS = pa.list_(pa.struct([("entry", pa.int32()), ("top", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
_FIELDS = [("first", pa.string()), ("last", pa.string()), *((n, pa.int64()) for n in ("blank", "duplicate", "truncated", "illegal", "low", "high", "turns")), ("opens", pa.bool_()), ("ways", WAYS)]


def _illegal(roles: str) -> int:
    return sum(pair not in ("su", "ua", "au") for pair in map("".join, zip(roles, roles[1:])))


def _rows_of(ways: dict[int, Tops]) -> list[dict]:
    return [{"entry": e, "top": t, "cost": c, "audit": a} for e, tops in ways.items() for t, (c, a) in tops.items()]


def _ways_of(rows: list[dict]) -> dict[int, Tops]:
    out: dict[int, Tops] = {}
    for r in rows:
        out.setdefault(r["entry"], {})[r["top"]] = (r["cost"], r["audit"])
    return out


def summaries(each: DataFrame) -> DataFrame:
    """Of each block its counts and the best ways through it; the first block stands on the empty stack only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[str, bool], dict] = {}
        for batch in batches:
            out = []
            for kinds, number, low, high, turns, block in zip(*(batch.column(c).to_pylist() for c in ("kinds", "number", "low", "high", "turns", "block"))):
                if (kinds, number == 0) not in known:
                    if len(known) >= MEMO:
                        known.clear()  # a store of repeated answers, refilled from here
                    roles, faults = kinds[::2], kinds[1::2]
                    edits = "".join("-" if f in "bd" else r.upper() if f == "t" else r for r, f in zip(roles, faults))
                    known[kinds, number == 0] = {
                        "first": roles[0], "last": roles[-1], "blank": faults.count("b"), "duplicate": faults.count("d"), "truncated": faults.count("t"), "illegal": _illegal(roles),
                        "ways": _rows_of({e: parsed(edits, e) for e in ([0] if number == 0 else STACKS)}),
                    }
                out.append(known[kinds, number == 0] | {"low": low, "high": high, "turns": turns, "opens": block == 0})
            columns = [pa.array([r[name] for r in out], kind) for name, kind in _FIELDS]
            yield pa.record_batch([batch.column("conv_id"), batch.column("number"), *columns], names=["conv_id", "number", *(n for n, _ in _FIELDS)])

    kind_of = each.schema["conv_id"].dataType.simpleString()
    return each.mapInArrow(run, f"conv_id {kind_of}, number int, {SUMMARY}")


def _joined(parts: list[dict]) -> dict:
    """The summary of neighbouring blocks, in order."""
    whole = dict(parts[0])
    ways = _ways_of(whole["ways"])
    for part in parts[1:]:
        for count in ("blank", "duplicate", "truncated", "illegal"):
            whole[count] += part[count]
        whole["illegal"] += _illegal(whole["last"] + part["first"])
        # a turn may go on from one block to the next
        shared = part["low"] is not None and whole["high"] == part["low"]
        whole["turns"] += part["turns"] - shared
        whole["low"] = part["low"] if whole["low"] is None else whole["low"]
        whole["high"] = whole["high"] if part["high"] is None else part["high"]
        whole["last"] = part["last"]
        ways = composed(ways, _ways_of(part["ways"]))
    return whole | {"ways": _rows_of(ways)}


def composed_blocks(each: DataFrame) -> DataFrame:
    """One summary a conversation, in rounds of FAN neighbouring blocks."""
    spark = each.sparkSession
    names = [n for n, _ in _FIELDS]
    kind_of = each.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(whole.num_rows):  # one row may hold long audits
                batch = whole.slice(i, 1)
                out = _joined(batch.column("parts")[0].as_py())
                yield pa.record_batch([batch.column("conv_id"), batch.column("number"), *(pa.array([out[n]], k) for n, k in _FIELDS)], names=["conv_id", "number", *names])

    each = stored(each, "summaries")
    while not each.filter("number > 0").isEmpty():
        grouped = each.groupBy("conv_id", F.expr(f"number div {FAN}").cast("int").alias("number")).agg(F.array_sort(F.collect_list(F.struct("number", *names))).alias("parts"))
        alone = grouped.filter("size(parts) = 1").select("conv_id", "number", *[F.col("parts")[0][n].alias(n) for n in names])
        after = stored(grouped.filter("size(parts) > 1").mapInArrow(run, f"conv_id {kind_of}, number int, {SUMMARY}").unionByName(alone), "summaries")
        free(spark, each)
        each = after
    return each


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each conversation's summary, followed by its rows in order: its repaired lines are hashed as they pass."""
    now: dict | None = None

    def line(role: str, text: str) -> None:
        now["hash"].update(("\n" if now["lines"] else "").encode() + f"{role}:{text}".encode())
        now["lines"] = True

    def inserts() -> None:
        audit = now["audit"]
        while now["at"] < len(audit) and audit[now["at"]] == "I":
            now["at"] += 1
            line(now["next"], "")
            now["next"] = "assistant" if now["next"] == "user" else "user"

    def closed() -> dict:
        inserts()
        return {k: now[k] for k in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")} | {"repaired_sha256": now["hash"].hexdigest()}

    fields = [("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())]

    def rows(done: list[dict], kind: pa.DataType) -> pa.RecordBatch:
        return pa.record_batch([pa.array([r["conv_id"] for r in done], kind), *(pa.array([r[n] for r in done], k) for n, k in fields)], names=["conv_id", *(n for n, _ in fields)])

    id_type = None
    for batch in batches:
        done, id_type = [], batch.schema.field("conv_id").type
        for conv, role, text, summary in zip(batch.column("conv_id").to_pylist(), batch.column("role"), batch.column("text"), batch.column("summary")):
            if not role.is_valid:
                if now is not None:
                    done.append(closed())
                s = summary.as_py()
                cost, audit = finished(_ways_of(s["ways"]).get(0, {0: (0, "")})) if s and s["ways"] else (0, "")
                counts = {k: s[k] if s and s[k] is not None else 0 for k in ("blank", "duplicate", "truncated", "illegal")}
                gaps = s["high"] - s["low"] + 1 - s["turns"] if s and s["low"] is not None else 0
                now = {"conv_id": conv, "gaps": gaps, "cost": cost, "audit": audit, "at": 0, "next": "user", "hash": hashlib.sha256(), "lines": False} | counts
                continue
            inserts()
            edit = now["audit"][now["at"]]
            now["at"] += 1
            if edit == "D":
                continue
            role = role.as_py() if edit == "K" else now["next"]
            line(role, text.as_py())
            now["next"] = "assistant" if role[:1] == "u" else "user"
        if done:
            yield rows(done, id_type)
    if now is not None:
        yield rows([closed()], id_type)


RESULT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


def repaired(conversations: DataFrame) -> DataFrame:
    """One row a conversation: its faults after damage, the cheapest repair and the hash of the repaired rows."""
    bounded_batches(conversations.sparkSession)
    rows = damaged(conversations)
    turns = ordered(rows)
    found = composed_blocks(summaries(blocks(turns)))
    names = [n for n, _ in _FIELDS]
    every = conversations.select("conv_id").distinct()
    lead = found.select(F.col("conv_id").alias("c"), F.struct(*names).alias("summary"))
    lead = every.join(lead, every["conv_id"].eqNullSafe(lead["c"]), "left").select(
        "conv_id", F.lit(0).alias("step"), F.lit(None).cast("bigint").alias("turn"), F.lit(None).cast("binary").alias("key"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), "summary",
    )
    texts = rows.select("conv_id", F.lit(1).alias("step"), "turn", row_key().alias("key"), "role", "text", F.lit(None).cast(lead.schema["summary"].dataType).alias("summary"))
    stream = lead.unionByName(texts).repartition("conv_id").sortWithinPartitions("conv_id", "step", "turn", "key")
    kind_of = conversations.schema["conv_id"].dataType.simpleString()
    return stream.mapInArrow(_repaired, f"conv_id {kind_of}, {RESULT}")
