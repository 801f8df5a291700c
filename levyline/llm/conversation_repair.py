"""Repair of the structure of conversations at the least cost, with an audit of the edits.

The repaired turns have role initials `(s?(ua)+)?`. Edits of a row are Keep (0), Rerole to user or assistant (2) and Delete (3, the only one for
blank and repeated rows); a truncated row that stays costs 1 more; Insert (2) puts in a turn without text. Of the cheapest audits the least in
the order of characters is chosen.

The program runs over the rows with one path per state of the pattern (`audit_path`). Paths of one state and cost that end at one row hold
equally many edits of rows, and inserted turns cost; so none is the beginning of another, and the lesser one stays the lesser one whatever follows.

No task holds a whole conversation: rows are cut into chunks of 4,096 in order; a conversation that reaches over the edge of its chunk gets a
path from every state to every state, and these are chained afterwards. Texts take no part in this: the program sees roles, faults and digests.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from levyline.llm.audit_path import PRIME, Step, edits, less
from levyline.llm.turns import digest, placed, runs
from levyline.session import written

CHUNK_BITS = 12
SPACE = r"\x20\x09-\x0D"
# States of the pattern: nothing yet, after s, after u, after a.
KEEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
NEXT = {0: 2, 1: 2, 3: 2, 2: 3}  # the state after an inserted or reroled turn
DONE = (0, 3)
ROLE = {2: "user", 3: "assistant"}

PIECE = (
    "conv_id long, chunk long, open boolean, head string, tail string, blank long, duplicate long, truncated long, illegal long, "
    "first_turn long, last_turn long, n_turns long, digests array<binary>, initials array<string>, "
    "paths array<struct<entry:int, exit:int, cost:long, audit:string>>"
)
RESULT = (
    "conv_id long, chunk long, blank long, duplicate long, truncated long, illegal long, first_turn long, last_turn long, n_turns long, "
    "cost long, audit string, steps array<struct<digest:binary, role:string>>"
)
_COUNTS = [(c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal", "first_turn", "last_turn", "n_turns")]
PIECE_BATCH = pa.schema([
    ("conv_id", pa.int64()), ("chunk", pa.int64()), ("open", pa.bool_()), ("head", pa.string()), ("tail", pa.string()), *_COUNTS,
    ("digests", pa.list_(pa.binary())), ("initials", pa.list_(pa.string())),
    ("paths", pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))),
])
RESULT_BATCH = pa.schema([
    ("conv_id", pa.int64()), ("chunk", pa.int64()), *_COUNTS, ("cost", pa.int64()), ("audit", pa.string()),
    ("steps", pa.list_(pa.struct([("digest", pa.binary()), ("role", pa.string())]))),
])


def blank(text: Column) -> Column:
    return ~text.rlike(f"[^{SPACE}]")


def truncated(text: Column) -> Column:
    """The last character that is no space is none of . ! ?"""
    return ~text.rlike(f"[.!?][{SPACE}]*\\z")


class Paths:
    """The cheapest path to every state: (cost, step) or None."""

    def __init__(self, entry: int, prime: int = PRIME):
        self.prime = prime
        self.best: list = [None] * 4
        self.best[entry] = (0, Step(None, ""))
        self._insert()

    def _offer(self, to: list, state: int, cost: int, parent: Step, edit: str) -> None:
        held = to[state]
        if held is None or cost <= held[0]:
            step = Step(parent, edit, self.prime)
            if held is None or cost < held[0] or less(step, held[1]):
                to[state] = (cost, step)

    def _insert(self) -> None:
        for state in (0, 1, 3, 2):  # an inserted turn costs, so one after another gains nothing back
            if self.best[state] is not None:
                cost, step = self.best[state]
                self._offer(self.best, NEXT[state], cost + 2, step, "I")

    def row(self, initial: str, fault: str | None) -> None:
        after: list = [None] * 4
        extra = 1 if fault == "truncated" else 0
        for state, held in enumerate(self.best):
            if held is None:
                continue
            cost, step = held
            self._offer(after, state, cost + 3, step, "D")
            if fault in (None, "truncated"):
                kept = KEEP.get((state, initial))
                if kept is not None:
                    self._offer(after, kept, cost + extra, step, "K")
                self._offer(after, NEXT[state], cost + 2 + extra, step, "R")
        self.best = after
        self._insert()


def cheapest(rows: list[tuple[str, str | None]], prime: int = PRIME) -> tuple[int, str]:
    """Cost and audit of the rows (initial, fault) of a whole conversation."""
    paths = Paths(0, prime)
    for initial, fault in rows:
        paths.row(initial, fault)
    cost, step = _least([paths.best[s] for s in DONE])
    return cost, edits(step)


def _least(held: list) -> tuple[int, Step]:
    best = None
    for one in held:
        if one is not None and (best is None or one[0] < best[0] or one[0] == best[0] and less(one[1], best[1])):
            best = one
    return best


def applied(entry: int, audit: str, initials: list[str], digests: list[bytes]) -> tuple[list[dict], int]:
    """The turns that an audit leaves, as (digest, null for an inserted turn; role, null for a kept one), and the state at its end."""
    out, state, at = [], entry, 0
    for edit in audit:
        if edit == "K":
            state = KEEP[state, initials[at]]
            out.append({"digest": digests[at], "role": None})
        elif edit != "D":
            state = NEXT[state]
            out.append({"digest": digests[at] if edit == "R" else None, "role": ROLE[state]})
        at += edit != "I"
    return out, state


def _legal(before: str, after: str) -> bool:
    return before + after in ("su", "ua", "au")


def _piece(rows: list[dict], at_edge: bool) -> dict:
    initials, turns = [r["initial"] for r in rows], [r["turn"] for r in rows if r["turn"] is not None]
    out = {
        "conv_id": rows[0]["conv_id"], "chunk": rows[0]["chunk"], "open": at_edge, "head": initials[0], "tail": initials[-1],
        "illegal": sum(not _legal(x, y) for x, y in zip(initials, initials[1:], strict=False)),
        "first_turn": turns[0] if turns else None, "last_turn": turns[-1] if turns else None, "n_turns": len(set(turns)),
        "digests": [r["digest"] for r in rows], "initials": initials, "paths": [],
    }
    for fault in ("blank", "duplicate", "truncated"):
        out[fault] = sum(r["fault"] == fault for r in rows)
    for entry in range(4) if at_edge else (0,):
        paths = Paths(entry)
        for r in rows:
            paths.row(r["initial"], r["fault"])
        ends = paths.best if at_edge else [_least([paths.best[s] for s in DONE])]
        out["paths"] += [
            {"entry": entry, "exit": state, "cost": held[0], "audit": edits(held[1])}
            for state, held in enumerate(ends) if held is not None
        ]
    return out


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in runs(batches, ["chunk"]):
        groups: list[list[dict]] = []
        for row in chunk:
            if groups and groups[-1][0]["conv_id"] == row["conv_id"]:
                groups[-1].append(row)
            else:
                groups.append([row])
        last = len(groups) - 1
        yield _batch([_piece(g, i in (0, last)) for i, g in enumerate(groups)], PIECE_BATCH)


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{n: r[n] for n in schema.names} for r in rows], schema=schema)


class _Link:
    """A chosen path of one piece, linked to those of the pieces before."""

    __slots__ = ("before", "audit", "entry", "cost")

    def __init__(self, before: _Link | None, audit: str, entry: int, cost: int):
        self.before, self.audit, self.entry, self.cost = before, audit, entry, cost


def _link_less(a: _Link, b: _Link) -> bool:
    """Order of two chains of the same pieces, built as text only from where they part."""
    left, right = [], []
    while a is not b:
        left.append(a.audit)
        right.append(b.audit)
        a, b = a.before, b.before
    return "".join(reversed(left)) < "".join(reversed(right))


def chained(pieces: list[dict]) -> list[tuple[int, int, str]]:
    """(entry, cost, audit) of each piece of a conversation, the pieces in order."""
    best: list = [None] * 4
    best[0] = (0, None)
    for piece in pieces:
        after: list = [None] * 4
        for path in piece["paths"]:
            held = best[path["entry"]]
            if held is not None:
                cost = held[0] + path["cost"]
                link = _Link(held[1], path["audit"], path["entry"], path["cost"])
                old = after[path["exit"]]
                if old is None or cost < old[0] or cost == old[0] and _link_less(link, old[1]):
                    after[path["exit"]] = (cost, link)
        best = after
    chosen = None
    for held in (best[s] for s in DONE):
        if held is not None and (chosen is None or held[0] < chosen[0] or held[0] == chosen[0] and _link_less(held[1], chosen[1])):
            chosen = held
    out, link = [], chosen[1]
    while link is not None:
        out.append((link.entry, link.cost, link.audit))
        link = link.before
    return out[::-1]


def _result(piece: dict, entry: int, cost: int, audit: str, illegal: int = 0, repeated_turn: int = 0) -> dict:
    steps, _ = applied(entry, audit, piece["initials"], piece["digests"])
    return {
        **{k: piece[k] for k in ("conv_id", "chunk", "blank", "duplicate", "truncated", "first_turn", "last_turn")},
        "illegal": piece["illegal"] + illegal, "n_turns": piece["n_turns"] - repeated_turn, "cost": cost, "audit": audit, "steps": steps,
    }


def _closed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for pieces in runs(batches, ["conv_id"]):
        out, last_turn = [], None
        for i, (piece, path) in enumerate(zip(pieces, chained(pieces), strict=True)):
            edge = int(i > 0 and not _legal(pieces[i - 1]["tail"], piece["head"]))
            out.append(_result(piece, *path, edge, int(last_turn is not None and piece["first_turn"] == last_turn)))
            last_turn = piece["last_turn"] if piece["last_turn"] is not None else last_turn
        yield _batch(out, RESULT_BATCH)


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.to_pylist()
        yield _batch([_result(r, 0, r["paths"][0]["cost"], r["paths"][0]["audit"]) for r in rows], RESULT_BATCH)


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows (conv_id, turn, role, text) after damage by crc32("conv_id:turn") % 20.

    0 drops the row, 1 empties its text, 2 takes . ! ? out of it, 3 repeats it, 4 makes its role user. A null is one space, in the
    hashed text too; conv_id and turn stay null.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), space("role").alias("role"), space("text").alias("text"), kind.alias("kind")
    ).filter("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def judged(rows: DataFrame, label: str = "repair") -> DataFrame:
    """Rows in order with their fault: conv_id, turn, place, initial, digest, fault (blank, duplicate, truncated or null)."""
    light = rows.select(
        "conv_id", "turn", "role", digest(F.col("role"), F.col("text")).alias("digest"), blank(F.col("text")).alias("blank"), truncated(F.col("text")).alias("cut"),
    )
    light = placed(light, f"{label}-placed")
    again = light.groupBy(F.col("conv_id").alias("f_conv"), F.col("digest").alias("f_digest")).agg(F.min("place").alias("first"), F.count("*").alias("n")).filter("n > 1")
    light = light.join(again, light.conv_id.eqNullSafe(F.col("f_conv")) & (light.digest == F.col("f_digest")), "left")
    fault = F.when(F.col("blank"), "blank").when(F.col("first") < F.col("place"), "duplicate").when(F.col("cut"), "truncated")
    return light.select("conv_id", "turn", "place", F.substring("role", 1, 1).alias("initial"), "digest", fault.alias("fault"))


def repair(rows: DataFrame, label: str = "repair", chunk_bits: int = CHUNK_BITS) -> tuple[DataFrame, DataFrame]:
    """(audits, turns) of conversations (conv_id, turn, role, text; role and text not null; other columns are left out).

    audits, one row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit. turns: conv_id, chunk and pos (which
    order the turns), role, text. Rows of one turn follow each other by role and digest, a null turn comes first and takes no part in gaps; a
    null conversation is one. No rows give no rows.
    """
    chunk = F.shiftright("place", chunk_bits)
    faults = judged(rows, label).withColumn("chunk", chunk)
    pieces = written(faults.repartition("chunk").sortWithinPartitions("chunk", "place").mapInArrow(_pieces, PIECE), f"{label}-pieces")
    whole = pieces.filter(~F.col("open")).mapInArrow(_whole, RESULT)
    cut = pieces.filter("open").repartition("conv_id").sortWithinPartitions("conv_id", "chunk").mapInArrow(_closed, RESULT)
    done = written(whole.unionByName(cut), f"{label}-done")
    audit = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "audit"))), lambda p: p.audit), "")
    counts = [F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    gaps = F.max("last_turn") - F.min("first_turn") + 1 - F.sum("n_turns")
    audits = done.groupBy("conv_id").agg(F.coalesce(gaps, F.lit(0)).alias("gaps"), *counts, audit.alias("audit"))
    steps = done.select("conv_id", "chunk", F.posexplode("steps").alias("pos", "step")).select("conv_id", "chunk", "pos", "step.*")
    texts = rows.groupBy(F.col("conv_id").alias("t_conv"), digest(F.col("role"), F.col("text")).alias("t_digest")).agg(
        F.first("role").alias("t_role"), F.first("text").alias("text")
    )
    turns = steps.join(texts, steps.conv_id.eqNullSafe(F.col("t_conv")) & (steps.digest == F.col("t_digest")), "left")
    return audits, turns.select("conv_id", "chunk", "pos", F.coalesce("role", "t_role").alias("role"), F.coalesce("text", F.lit("")).alias("text"))
