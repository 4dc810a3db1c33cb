"""Repair of the turn order of conversations by bidirectional Dijkstra over the lattice of edits."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from heapq import heappop, heappush
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackroom.plans.order import row_index
from stackroom.runtime import materialised

# Rows of a conversation that are searched at once.
BLOCK_ROWS = 256
# White space, sentence ends, the costs of edits and of a kept row without a sentence end.
BLANKS, ENDINGS = " \t\n\x0b\x0c\r", ".!?"
REROLE, DELETE, INSERT, OPEN_END = 3, 4, 3, 3
# States of the pattern (s?(ua)+)? by its last initial, the steps between them, and the state behind the last row.
START, SYSTEM, USER, ASSISTANT, DONE = range(5)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
# The only role that a new or renamed row can have after a state.
FITTING = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
LEGAL = {"su", "ua", "au"}

Node = tuple[int, int]
Edges = dict[Node, list[tuple[str, int, Node]]]


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, copy) with faults by crc32 of ``conv_id:turn`` modulo 20; nulls count as one space.

    0 drops a row, 1 empties its text, 2 removes its sentence ends, 3 repeats it (``copy`` 1), 4 makes it the user's.
    """
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    fault = F.crc32(name.cast("binary")) % 20
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    text = F.when(fault == 1, F.lit("")).when(fault == 2, F.translate(text, ENDINGS, "")).otherwise(text)
    role = F.when(fault == 4, F.lit("user")).otherwise(F.coalesce(F.col("role").cast("string"), F.lit(" ")))
    copies = F.explode(F.sequence(F.lit(0), F.when(fault == 3, F.lit(1)).otherwise(F.lit(0)))).alias("copy")
    return conversations.filter(fault != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), copies)


def lattice(rows: list[tuple[str, bool, bool]], last: bool) -> tuple[Edges, Edges]:
    """Edits as edges (initial, cost, node) from each node (rows passed, state), and the same edges from behind.

    A row is (initial of its role, has to go, lacks a sentence end). New rows stand before a row; behind all rows only
    in the ``last`` block, where the pattern must also be complete.
    """
    ahead: Edges = {}
    behind: Edges = {}

    def edge(at: Node, letter: str, cost: int, to: Node) -> None:
        ahead.setdefault(at, []).append((letter, cost, to))
        behind.setdefault(to, []).append((letter, cost, at))

    for i in range(len(rows) + last):
        for state, fitting in FITTING.items():
            renamed = NEXT[state, fitting[0]]
            edge((i, state), "I", INSERT, (i, renamed))
            if i == len(rows):
                if state in (START, ASSISTANT):
                    edge((i, state), "", 0, (i + 1, DONE))
                continue
            initial, must_go, open_end = rows[i]
            edge((i, state), "D", DELETE, (i + 1, state))
            if not must_go:
                extra = OPEN_END if open_end else 0
                edge((i, state), "R", REROLE + extra, (i + 1, renamed))
                if (state, initial) in NEXT:
                    edge((i, state), "K", extra, (i + 1, NEXT[state, initial]))
    return ahead, behind


def cheapest(ahead: Edges, behind: Edges, source: Node, target: Node) -> tuple[int, str] | None:
    """Least cost from source to target and the ASCII-least audit of that cost.

    A forward heap from the source and a reverse heap from the target settle nodes by cost; edges that cost nothing
    lead to later rows, so equal costs are settled in the order of the rows, and a node's first entry
    has its least audit. No audit of a node is the start of another one of the same cost, so least parts make a
    least whole. Once the sides have met, they go on while a crossing of the same cost may be left.
    """
    heaps: list[list] = [[(0, source[0], "", source)], [(0, -target[0], "", target)]]
    settled: list[dict[Node, tuple[int, str]]] = [{}, {}]
    edges, best = (ahead, behind), None
    while heaps[0] and heaps[1] and (best is None or heaps[0][0][0] + heaps[1][0][0] <= best[0]):
        side = 1 if not settled[1] or heaps[1][0][0] < heaps[0][0][0] else 0
        cost, _, audit, node = heappop(heaps[side])
        own, other = settled[side], settled[1 - side]
        if node in own:
            continue
        own[node] = cost, audit
        for letter, step, to in [("", 0, node), *edges[side].get(node, [])]:
            longer = letter + audit if side else audit + letter
            if to in other:
                rest = other[to]
                met = cost + step + rest[0], rest[1] + longer if side else longer + rest[1]
                best = met if best is None else min(best, met)
            if to not in own:
                heappush(heaps[side], (cost + step, -to[0] if side else to[0], longer, to))
    return best


def options(rows: list[tuple[str, bool, bool]], first: bool, last: bool) -> list[dict]:
    """For each state before and after a block the cheapest edits, ordered by the state before and the audit."""
    ahead, behind = lattice(rows, last)
    found = []
    for state in [START] if first else FITTING:
        for after in [DONE] if last else FITTING:
            best = cheapest(ahead, behind, (0, state), (len(rows) + last, after))
            if best is not None:
                found.append({"before": state, "after": after, "cost": best[0], "audit": best[1]})
    return sorted(found, key=lambda o: (o["before"], o["audit"]))


def edited(rows: list[dict], state: int, audit: str) -> tuple[list[tuple[str, str]], int]:
    """The repaired (role, text) of a block and the state behind it."""
    out: list[tuple[str, str]] = []
    waiting = iter(rows)
    for letter in audit:
        row = None if letter == "I" else next(waiting)
        if letter == "D":
            continue
        role = row["role"] if letter == "K" else FITTING[state]
        out.append((role, row["text"] if row else ""))
        state = NEXT[state, role[0]]
    return out, state


def _searched(schema: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row in batch.select(["rows", "first", "last"]).to_pylist():
                turns = [(r["role"][:1], r["fault"] in ("blank", "duplicate"), r["fault"] == "truncated") for r in row["rows"]]
                found.append(options(turns, row["first"], row["last"]))
            kind = pa.list_(pa.struct([("before", pa.int32()), ("after", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], schema)

    return run


def _in_order(df: DataFrame, each: Callable[[object, Iterator[dict]], Iterator[dict]], schema: str, backward: bool = False) -> DataFrame:
    """``each`` conversation's block rows as a stream, from its first block to its last or backward.

    No conversation is held whole: a task sees one block after the other.
    """
    names = [part.split()[0] for part in schema.split(", ")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            yield from batch.to_pylist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        for conv, blocks in groupby(rows(batches), key=lambda r: r["conv_id"]):
            for row in each(conv, blocks):
                out.append(row)
                if len(out) == 1000:
                    yield batch_of(out)
                    out = []
        yield batch_of(out)

    fields = df.sparkSession.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(fields)

    def batch_of(out: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in out], arrow.field(n).type) for n in names], names)

    order = F.col("cell").desc() if backward else F.col("cell").asc()
    return df.repartition("conv_id").sortWithinPartitions("conv_id", order).mapInArrow(run, schema)


def _costs_behind(conv: object, blocks: Iterator[dict]) -> Iterator[dict]:
    """The least cost from each state behind a block to the end of the conversation."""
    behind = {DONE: 0}
    for block in blocks:
        yield {"conv_id": conv, "cell": block["cell"], "behind": [behind.get(s) for s in range(5)]}
        costs: dict[int, int] = {}
        for o in block["options"]:
            if o["after"] in behind:
                cost = o["cost"] + behind[o["after"]]
                costs[o["before"]] = min(cost, costs.get(o["before"], cost))
        behind = costs


def _choices(conv: object, blocks: Iterator[dict]) -> Iterator[dict]:
    """The option of each block on the cheapest way; of equal ones the first, which has the least audit."""
    state = START
    for block in blocks:
        open_ways = [(n, o) for n, o in enumerate(block["options"]) if o["before"] == state and block["behind"][o["after"]] is not None]
        no, option = min(open_ways, key=lambda way: (way[1]["cost"] + block["behind"][way[1]["after"]], way[0]))
        yield {"conv_id": conv, "cell": block["cell"], "choice": no}
        state = option["after"]


def _same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
    for batch in batches:
        found = []
        for row in batch.to_pylist():
            option, rows = row["option"], row["rows"]
            initials = [r["role"][:1] for r in rows]
            faults = [r["fault"] for r in rows]
            found.append({
                "conv_id": row["conv_id"], "cell": row["cell"], "audit": option["audit"], "cost": option["cost"],
                "turns": [{"role": r, "text": t} for r, t in edited(rows, option["before"], option["audit"])[0]],
                "blank": faults.count("blank"), "duplicate": faults.count("duplicate"), "truncated": faults.count("truncated"),
                "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])), "opening": initials[0], "closing": initials[-1],
            })
        columns = {name: [f[name] for f in found] for name in REPAIRED}
        types = {"turns": kind, "audit": pa.string(), "opening": pa.string(), "closing": pa.string()}
        arrays = [batch.column("conv_id") if n == "conv_id" else pa.array(columns[n], types.get(n, pa.int64())) for n in REPAIRED]
        yield pa.RecordBatch.from_arrays(arrays, REPAIRED)


REPAIRED = ["conv_id", "cell", "audit", "cost", "turns", "blank", "duplicate", "truncated", "illegal", "opening", "closing"]


def with_faults(rows: DataFrame) -> DataFrame:
    """Rows with a global position ``at`` in the order of conversation and turn, and their first ``fault`` or null.

    Rows of the same turn stand in the order of role and text, copies behind their row. A fault is ``blank``, ``duplicate`` (role and
    text of an earlier row of the conversation) or ``truncated``.
    """
    placed = row_index(rows.withColumn("_row", F.monotonically_increasing_id()), ["conv_id", "turn", "role", "text", "_row", "copy"], "at").drop("_row")
    content = F.rtrim(F.col("text"), F.lit(BLANKS))
    first = placed.filter(content != "").groupBy("conv_id", "role", "text").agg(F.min("at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    repeated = materialised(first.filter(F.col("_rows") > 1).select(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("text").alias("_text"), "_first"))
    joined = placed.join(repeated, _same(F.col("conv_id"), F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("text") == F.col("_text")), "left")
    fault = (
        F.when(content == "", F.lit("blank"))
        .when(F.col("at") > F.col("_first"), F.lit("duplicate"))
        .when(~F.right(content, F.lit(1)).isin(*ENDINGS), F.lit("truncated"))
    )
    return joined.withColumn("fault", fault).drop("_conv", "_role", "_text", "_first")


def repaired(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Blocks of repaired conversations: conv_id, cell, audit, cost, turns (role, text), the counts of faults, opening and closing initial.

    ``rows`` has conv_id, turn, role, text and copy. Edits: keep a row, rename its role (R), delete it (D; a must for blank rows and
    repeats) or insert an empty one (I), so that the initials of the roles follow ``(s?(ua)+)?`` at the least cost, ties
    to the ASCII-least audit. The blocks of a conversation, in the order of ``cell``, make up its audit and its turns.

    A conversation of any length is cut into blocks of at most ``block_rows`` rows, which are searched side by side for every
    pair of states before and after them. Small rows of costs are then read backward and forward to choose among them.
    No block's audit is the start of another one that begins in the same state, since each ends with its last row.

    Null ids make one conversation, null turns stand first, null roles and texts must be filled by the caller. Roles with other
    initials than s, u and a cannot be kept. An empty table gives no rows.
    """
    read = rows.select("conv_id", F.col("turn").cast("long"), "role", "text", "copy")
    turn = F.struct("at", "role", "text", "fault")
    cell = F.floor(F.col("at") / block_rows).alias("cell")
    blocks = with_faults(read).groupBy("conv_id", cell).agg(F.array_sort(F.collect_list(turn)).alias("rows"))
    blocks = materialised(blocks)
    ends = blocks.groupBy(F.col("conv_id").alias("_conv")).agg(F.min("cell").alias("_from"), F.max("cell").alias("_to"))
    placed = blocks.join(ends, _same(F.col("conv_id"), F.col("_conv")))
    placed = placed.select("conv_id", "cell", "rows", (F.col("cell") == F.col("_from")).alias("first"), (F.col("cell") == F.col("_to")).alias("last"))
    conv = f"conv_id {read.schema['conv_id'].dataType.simpleString()}"
    option = "struct<before int, after int, cost long, audit string>"
    schema = f"{conv}, cell long, rows array<struct<at long, role string, text string, fault string>>, first boolean, last boolean, options array<{option}>"
    searched = materialised(placed.mapInArrow(_searched(["conv_id", "cell", "rows", "first", "last", "options"]), schema))
    costs = F.transform("options", lambda o: F.struct(o["before"].alias("before"), o["after"].alias("after"), o["cost"].alias("cost"))).alias("options")
    small = searched.select("conv_id", "cell", costs)
    behind = materialised(_in_order(small, _costs_behind, f"{conv}, cell long, behind array<long>", backward=True))
    both = small.join(behind.select(F.col("conv_id").alias("_conv"), F.col("cell").alias("_cell"), "behind"), (F.col("cell") == F.col("_cell")) & _same(F.col("conv_id"), F.col("_conv")))
    chosen = _in_order(both.select("conv_id", "cell", "options", "behind"), _choices, f"{conv}, cell long, choice int")
    chosen = chosen.select(F.col("conv_id").alias("_conv"), F.col("cell").alias("_cell"), "choice")
    whole = searched.join(chosen, (F.col("cell") == F.col("_cell")) & _same(F.col("conv_id"), F.col("_conv")))
    whole = whole.select("conv_id", "cell", "rows", F.get("options", F.col("choice")).alias("option"))
    out = f"{conv}, cell long, audit string, cost long, turns array<struct<role string, text string>>, blank long, duplicate long, truncated long, illegal long, opening string, closing string"
    return materialised(whole.mapInArrow(_repaired, out))


def repaired_turns(blocks: DataFrame) -> DataFrame:
    """The repaired rows: conv_id, cell, place in the block, role, text."""
    return blocks.select("conv_id", "cell", F.posexplode("turns").alias("place", "_turn")).select("conv_id", "cell", "place", "_turn.role", "_turn.text")


def _summed(conv: object, blocks: Iterator[dict]) -> Iterator[dict]:
    total = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost"), 0)
    audit, digest, started, closing = [], hashlib.sha256(), False, None
    for block in blocks:
        for name in total:
            total[name] += block[name]
        total["illegal"] += closing is not None and closing + block["opening"] not in LEGAL
        closing = block["closing"]
        audit.append(block["audit"])
        for turn in block["turns"]:
            digest.update(("\n" if started else "").encode() + f"{turn['role']}:{turn['text']}".encode("utf-8", "surrogatepass"))
            started = True
    yield {"conv_id": conv, **total, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}


def digest(conversations: DataFrame, rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """A row per id of ``conversations``: gaps in the turns of ``rows``, faults, cost, audit and digest of its repaired ``blocks``.

    The digest runs over the conversation as a stream. A conversation without rows has zeros and the digest of nothing.
    """
    conv = f"conv_id {conversations.schema['conv_id'].dataType.simpleString()}"
    counts = "blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    summed = _in_order(blocks, _summed, f"{conv}, {counts}")
    turns = rows.filter(F.col("turn").isNotNull()).select(F.col("conv_id").alias("_conv"), F.col("turn").cast("long").alias("turn")).distinct()
    gaps = turns.groupBy("_conv").agg((F.max("turn") - F.min("turn") + 1 - F.count(F.lit(1))).alias("gaps"))
    ids = conversations.select(F.col("conv_id").alias("_id")).distinct()
    whole = ids.join(summed, _same(F.col("_id"), F.col("conv_id")), "left").join(gaps, _same(F.col("_id"), F.col("_conv")), "left")
    numbers = [F.coalesce(F.col(n), F.lit(0)).cast("long").alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = hashlib.sha256(b"").hexdigest()
    return whole.select(F.col("_id").alias("conv_id"), *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))
