"""Conversation structure repair: the cheapest edits that make the turns alternate, by an auction for shortest paths.

A conversation's rows are the layers of a lattice over the states of the wanted role order.
Node prices start at a dual feasible value; a path grows from an origin along its cheapest arc
while that arc is tight, and is cut back, raising the price of its end, where none is. When
the path reaches the end, the price of the origin is its distance, and every arc of every
cheapest path is tight, so the least list of edits is read off the tight arcs.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sedgemill.llm.textkit import process_store
from sedgemill.operators.shuffles import with_row_index

# States of `(s?(ua)+)?`, costs of the edits, and the spaces of a blank text.
START, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = (USER, USER, ASSISTANT, USER)
KEEPS = {("s", START): SYSTEM, ("u", START): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT}
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
AT_END, TAILS = (0, 2 * INSERT, INSERT, 0), ("", "II", "I", "")
SPACES = " \t\n\x0b\x0c\r"
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}

#: Rows of one task unit, and layers of one lattice; longer conversations are composed of several.
BLOCK, LAYERS = 1024, 64
#: Answers a process keeps, and the layers of the longest of them.
KEPT, KEPT_LAYERS = 1 << 15, 12
FAR = 1 << 60

Step = tuple[str, bool, int]  #: initial of the role ("" where nothing but deletion is possible), truncated, rows it stands for


def lattice(steps: tuple[Step, ...], ends: tuple[int, ...]) -> list[list[tuple[str, int, int]]]:
    """Arcs (edit, cost, target) of each node ``4 * layer + state``; the last node is the end, reached at the prices ``ends``.

    Insertions stand before a row; those behind the last row belong to the prices of the end.
    Arcs to nodes from which the end cannot be reached are left out.
    """
    last = 4 * len(steps) + 4
    arcs: list[list[tuple[str, int, int]]] = []
    for layer, (initial, cut, rows) in enumerate(steps):
        here, there, extra = 4 * layer, 4 * layer + 4, TRUNCATED * cut
        for state in range(4):
            out = [("D" * rows, DELETE * rows, there + state), ("I", INSERT, here + FOLLOWS[state])]
            if initial:
                if (kept := KEEPS.get((initial, state))) is not None:
                    out.append(("K", extra, there + kept))
                out.append(("R", REROLE + extra, there + FOLLOWS[state]))
            arcs.append(out)
    arcs += [[("", ends[state], last)] if ends[state] < FAR else [] for state in range(4)]
    alive = [False] * last + [True]
    for layer in range(len(steps), -1, -1):
        for _ in range(3):  # insertions lead to nodes of the same layer
            for node in range(4 * layer, 4 * layer + 4):
                alive[node] = alive[node] or any(alive[j] for _, _, j in arcs[node])
    return [[arc for arc in out if alive[arc[2]]] for out in arcs] + [[]]


def settle(arcs: list[list[tuple[str, int, int]]], price: list[int], origin: int) -> int:
    """Run the auction from ``origin`` to the last node; ``price`` stays dual feasible and ends with the origin's distance."""
    end = len(arcs) - 1
    if not arcs[origin]:
        price[origin] = FAR
        return FAR
    path = [origin]
    while path[-1] != end:
        node = path[-1]
        best, target = FAR, end
        for _, cost, j in arcs[node]:
            if cost + price[j] < best:
                best, target = cost + price[j], j
        if price[node] < best:
            price[node] = best
            if len(path) > 1:
                path.pop()
        else:
            path.append(target)
    return price[origin]


def trace(arcs: list[list[tuple[str, int, int]]], price: list[int], origin: int) -> tuple[str, int]:
    """The ASCII-least edits along tight arcs from ``origin`` to the end, and the state of the last layer they pass."""
    end, dead, path = len(arcs) - 1, set(), [(origin, "")]
    while path[-1][0] != end:
        node = path[-1][0]
        tight = [(edit, j) for edit, cost, j in arcs[node] if cost + price[j] == price[node] and j not in dead]
        if tight:
            edit, j = min(tight)
            path.append((j, edit))
        else:
            dead.add(path.pop()[0])
    return "".join(edit for _, edit in path), path[-2][0] % 4


def crossing(steps: tuple[Step, ...]) -> list[list[int]]:
    """Cost from each state before the steps to each state behind them."""
    out = [[FAR] * 4 for _ in range(4)]
    for to in range(4):
        arcs = lattice(steps, tuple(0 if state == to else FAR for state in range(4)))
        price = [0] * len(arcs)
        for state in range(4):
            out[state][to] = settle(arcs, price, state)
    return out


def before(matrix: list[list[int]], ends: tuple[int, ...]) -> tuple[int, ...]:
    """Prices in front of a run of rows, from those behind it."""
    return tuple(min(FAR, *(a + b for a, b in zip(row, ends, strict=True))) for row in matrix)


def compose(left: list[list[int]], right: list[list[int]]) -> list[list[int]]:
    return [[min(FAR, *(row[k] + right[k][j] for k in range(4))) for j in range(4)] for row in left]


def _solved(steps: tuple[Step, ...], ends: tuple[int, ...], state: int) -> tuple[str, int, int]:
    """One lattice solved; short conversations are often alike, so a process keeps some answers."""
    kept = process_store("repairs")
    key = (steps, ends, state) if len(steps) <= KEPT_LAYERS else None
    if key in kept:
        return kept[key]
    low = min(ends)
    arcs = lattice(steps, tuple(e - low if e < FAR else FAR for e in ends))
    price = [0] * len(arcs)
    cost = settle(arcs, price, state) + low
    edits, left = trace(arcs, price, state)
    if key is not None and len(kept) < KEPT:
        kept[key] = edits, left, cost
    return edits, left, cost


def solve(steps: tuple[Step, ...], ends: tuple[int, ...], state: int) -> tuple[str, int, int]:
    """Least cheapest edits of the steps from ``state``, the state behind them, and the price in front of them.

    Long runs go through lattices of ``LAYERS`` layers: their crossing costs give the prices
    between them from the back, and the edits are read from the front.
    """
    parts = [steps[i:i + LAYERS] for i in range(0, len(steps), LAYERS)] or [()]
    behind = [ends]
    for part in reversed(parts[1:]):
        behind.append(before(crossing(part), behind[-1]))
    edits, cost = [], None
    for part, price in zip(parts, reversed(behind), strict=True):
        found, state, total = _solved(part, price, state)
        edits.append(found)
        cost = total if cost is None else cost
    return "".join(edits), state, cost


def steps_of(initial: str, blank: bool, cut: bool, first: bool, copies: int) -> list[Step]:
    """Lattice steps of equal rows of one turn: the first can stay if it is neither blank nor a duplicate, the others go."""
    if blank or not first:
        return [("", False, copies)]
    return [(initial or "?", cut, 1)] + [("", False, copies - 1)] * (copies > 1)


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with planted faults: rows (conv_id, turn, role, text) chosen by crc32 of ``conv_id:turn``; nulls read as one space.

    Of 20 remainders, 0 drops a row, 1 empties its text, 2 removes ``[.!?]`` from it, 3 gives
    it twice, 4 makes its role user.
    """
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.encode(F.concat(said("conv_id"), F.lit(":"), said("turn")), "UTF-8")) % 20
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), said("role").alias("role"),
                                said("text").alias("text"), fate.alias("fate"))
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.when(F.col("fate") == 3, 2).otherwise(1)
    return rows.filter("fate <> 0").select(
        "conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(F.array_repeat(F.lit(0), times)).alias("again")).drop("again")


def _initial() -> Column:
    return F.left(F.col("role"), F.lit(1))


def ordered_rows(rows: DataFrame) -> DataFrame:
    """Distinct rows with their ``copies``, numbered in the order of conversation, turn, role and text (nulls first).

    Equal rows are adjacent in that order, so they collapse before the shuffle.
    """
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    plain = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), said("role"), said("text"))
    merged = plain.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    merged = with_row_index(merged, [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")])
    bare = F.rtrim(F.col("text"), F.lit(SPACES))
    return merged.select(
        "*", F.expr(f"row_index div {BLOCK}").alias("block"), (bare == "").alias("blank"),
        (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut"),
        F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256).alias("said"))


def _pieces(rows: DataFrame) -> DataFrame:
    """One row per block and conversation in it: lattice steps in order, and crossing costs where the conversation may go on."""
    narrow = rows.select("row_index", "block", "conv_id", "said", _initial().alias("initial"), "blank", "cut", "copies")
    firsts = narrow.groupBy("conv_id", "said").agg(F.min("row_index").alias("row_index")).select("row_index", F.lit(True).alias("first"))
    narrow = narrow.drop("said").join(firsts, "row_index", "left")

    def work(table: pa.Table) -> pa.Table:
        found = sorted(table.to_pylist(), key=lambda r: r["row_index"])
        out: list[dict] = []
        for r in found:
            if not out or out[-1]["conv_id"] != r["conv_id"]:
                out.append({"block": r["block"], "piece": len(out), "conv_id": r["conv_id"], "initials": [], "cuts": [], "copies": []})
            for initial, cut, copies in steps_of(r["initial"], r["blank"], r["cut"], r["first"] is not None, r["copies"]):
                out[-1]["initials"].append(initial)
                out[-1]["cuts"].append(cut)
                out[-1]["copies"].append(copies)
        for r in (out[0], out[-1]):
            steps = _steps(r)
            cross = [crossing(steps[i:i + LAYERS]) for i in range(0, len(steps), LAYERS)]
            r["cross"] = [x for row in functools.reduce(compose, cross) for x in row]
        return pa.Table.from_pylist(out, schema=kind)

    kind = pa.schema([("block", pa.int64()), ("piece", pa.int64()), ("conv_id", pa.int64()), ("initials", pa.list_(pa.string())),
                      ("cuts", pa.list_(pa.bool_())), ("copies", pa.list_(pa.int64())), ("cross", pa.list_(pa.int64()))])
    schema = "block long, piece long, conv_id long, initials array<string>, cuts array<boolean>, copies array<long>, cross array<long>"
    return narrow.groupBy("block").applyInArrow(work, schema)


def _steps(piece: dict) -> tuple[Step, ...]:
    return tuple(zip(piece["initials"], piece["cuts"], piece["copies"], strict=True))


def _prices(pieces: DataFrame) -> DataFrame:
    """(block, piece, ends): prices behind each piece at a block's edge, from the crossing costs of the pieces after it."""

    def work(table: pa.Table) -> pa.Table:
        found = sorted(table.to_pylist(), key=lambda r: -r["block"])
        ends, out = AT_END, []
        for n, r in enumerate(found):
            out.append({"block": r["block"], "piece": r["piece"], "ends": list(ends), "more": n > 0})
            ends = before([r["cross"][i:i + 4] for i in range(0, 16, 4)], ends)
        return pa.Table.from_pylist(out, schema=kind)

    kind = pa.schema([("block", pa.int64()), ("piece", pa.int64()), ("ends", pa.list_(pa.int64())), ("more", pa.bool_())])
    edges = pieces.filter("cross IS NOT NULL").select("conv_id", "block", "piece", "cross")
    return edges.groupBy("conv_id").applyInArrow(work, "block long, piece long, ends array<long>, more boolean")


def _edited(pieces: DataFrame) -> DataFrame:
    """(conv_id, block, edits, left, costs): for each state in front of a piece its least cheapest edits, the state behind, the price."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                steps, ends = _steps(r), tuple(r["ends"] or AT_END)
                found = [solve(steps, ends, state) for state in range(4 if r["cross"] else 1)]
                if not r["more"]:
                    found = [(edits + TAILS[state], state, cost) for edits, state, cost in found]
                out.append({"conv_id": r["conv_id"], "block": r["block"], "edits": [f[0] for f in found],
                            "left": [f[1] for f in found], "costs": [f[2] for f in found]})
            yield pa.RecordBatch.from_pylist(out, schema=kind)

    kind = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("edits", pa.list_(pa.string())),
                      ("left", pa.list_(pa.int64())), ("costs", pa.list_(pa.int64()))])
    return pieces.mapInArrow(work, "conv_id long, block long, edits array<string>, left array<long>, costs array<long>")


class _Repair:
    """What one conversation's records add up to as they pass by in order."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.cost, self.state = conv_id, None, START
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.low = self.high = self.turn = None
        self.turns, self.before = 0, None
        self.audit: list[str] = []
        self.digest, self.empty = hashlib.sha256(), True
        self.edits, self.at, self.out = "", 0, START

    def piece(self, record: dict) -> None:
        self.finish()
        if self.cost is None:
            self.cost = record["costs"][self.state]
        self.edits, self.at, self.out = record["edits"][self.state], 0, self.state
        self.state = record["left"][self.state]
        self.audit.append(self.edits)

    def put(self, role: str, text: str) -> None:
        self.digest.update(f"{'' if self.empty else '\n'}{role}:{text}".encode())
        self.empty = False

    def inserted(self) -> None:
        while self.edits[self.at:self.at + 1] == "I":
            self.out = FOLLOWS[self.out]
            self.put(ROLE_OF[self.out], "")
            self.at += 1

    def finish(self) -> None:
        """Write the insertions behind the last row of a piece."""
        self.inserted()

    def row(self, r: dict) -> None:
        if r["turn"] is not None:
            self.low = r["turn"] if self.low is None else self.low
            self.high = r["turn"]
            self.turns += r["turn"] != self.turn
            self.turn = r["turn"]
        copies, first = r["copies"], not r["blank"] and r["first"]
        self.counts["illegal"] += copies - 1 + (self.before is not None and self.before + r["initial"] not in ("su", "ua", "au"))
        self.before = r["initial"]
        self.counts["blank"] += copies * r["blank"]
        self.counts["duplicate"] += 0 if r["blank"] else copies - first
        self.counts["truncated"] += bool(first and r["cut"])
        self.inserted()
        if first:
            edit = self.edits[self.at]
            if edit == "K":
                self.out = KEEPS[r["initial"], self.out]
                self.put(r["role"], r["text"])
            elif edit == "R":
                self.out = FOLLOWS[self.out]
                self.put(ROLE_OF[self.out], r["text"])
            self.at += 1
            copies -= 1
            if copies:
                self.inserted()
        self.at += copies

    def result(self) -> dict:
        self.finish()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return {"conv_id": self.conv_id, "gaps": gaps, **self.counts, "cost": self.cost or 0, "audit": "".join(self.audit),
                "repaired_sha256": self.digest.hexdigest()}


def repair(rows: DataFrame, conv_ids: DataFrame | None = None) -> DataFrame:
    """Faults and cheapest repair of every conversation of ``rows`` (conv_id, turn, role, text).

    Columns: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.
    Rows are taken by turn (nulls first), those of one turn by role and text. A row's first
    fault counts: blank, duplicate (role and text seen earlier in the conversation), truncated
    (its last character is none of ``.!?``). Keep is free, giving the role user or assistant
    costs 3, deletion 4 (the only edit of a blank or duplicate row), insertion of an empty
    user or assistant row 3, and a truncated row that stays 3 more. ``audit`` has the edits'
    initials of the cheapest list that brings the roles' initials to ``(s?(ua)+)?``, the
    ASCII-least of several; ``illegal`` counts neighbours that are not su, ua or au.

    ``conv_ids`` names conversations that are returned even if ``rows`` has none of them: with
    zeros, an empty audit and the hash of the empty text. Null roles and texts read as one
    space; a null conv_id is a conversation, null turns come first and make no gap. An empty
    role has no initial and cannot be kept. Equal rows count each; other columns are not read;
    empty tables give no rows.

    Rows are numbered by a range sort and cut into blocks of ``BLOCK``, so no conversation is
    gathered in one task to be solved: the pieces of a long one meet only through 16 crossing
    costs each. A conversation's hash is by its nature made in order; its rows pass one task as
    a stream, of which only the audit is held.
    """
    numbered = ordered_rows(rows)
    pieces = _pieces(numbered)
    priced = pieces.join(_prices(pieces), ["block", "piece"], "left")
    firsts = numbered.groupBy("conv_id", "said").agg(F.min("row_index").alias("row_index")).select(
        "row_index", F.lit(True).alias("first"))
    texts = numbered.join(firsts, "row_index", "left").select(
        "conv_id", "block", F.lit(2).alias("kind"), "row_index", "turn", "role", "text", "copies", "blank", "cut",
        F.col("first").isNotNull().alias("first"), _initial().alias("initial"))
    records = _edited(priced).withColumn("kind", F.lit(1)).unionByName(texts, allowMissingColumns=True)
    if conv_ids is not None:
        named = conv_ids.select(F.col("conv_id").cast("long")).distinct()
        records = records.unionByName(
            named.withColumns({"block": F.lit(-1).cast("long"), "kind": F.lit(0)}), allowMissingColumns=True)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []
        for batch in batches:
            for r in batch.to_pylist():
                if now is None or now.conv_id != r["conv_id"]:
                    if now is not None:
                        done.append(now.result())
                    now = _Repair(r["conv_id"])
                if r["kind"] == 1:
                    now.piece(r)
                elif r["kind"] == 2:
                    now.row(r)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=kind)
                done = []
        if now is not None:
            yield pa.RecordBatch.from_pylist([now.result()], schema=kind)

    longs = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    kind = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in longs], ("audit", pa.string()), ("repaired_sha256", pa.string())])
    schema = f"conv_id long, {', '.join(f'{c} long' for c in longs)}, audit string, repaired_sha256 string"
    dealt = records.repartition("conv_id").sortWithinPartitions("conv_id", "block", "kind", "row_index")
    return dealt.mapInArrow(work, schema)
