"""Repair of the turn structure of conversations, at least cost.

Equal rows are counted before they travel, faults are found by grouping and joining, and all rows are
range-partitioned and sorted by conversation and turn. A conversation is cut into chunks of at most
``CHUNK`` rows; every chunk is searched for each state it can be entered and left in, and chunks are
put together from those costs and audits, so no task holds a conversation, however long. Only the
hash over a repaired conversation runs through it in one task, row by row.
"""

from __future__ import annotations

import hashlib
import itertools
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowplan.llm.common import written
from flowplan.llm.edit_lattice import END, STATES, Item, apply, least_repair

CHUNK = 2048
ROLES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
_SPACES = r"\x20\x09-\x0D"
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_PLACED = "part int, chunk int, pos int, conv_id {id}, role string, text string, initial string, fault string, copies long, found string"
_CHOSEN = "conv_id {id}, part int, chunk int, entry int, audit string, found string"
_REPAIRED = "conv_id {id}, part int, chunk int, pos int, n int, role string, text string"


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with faults put in by crc32(conv_id:turn) % 20; ``copies`` says how often a row stands. Nulls are one space."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    fault = F.col("_fault")
    return (
        conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), (F.crc32(key) % 20).alias("_fault"))
        .where(fault != 0)
        .select(
            "conv_id", "turn",
            F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(fault == 1, "").when(fault == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
            F.when(fault == 3, 2).otherwise(1).cast("long").alias("copies"),
        )
    )


def _with_faults(rows: DataFrame) -> DataFrame:
    """One row for each set of equal rows: the first fault of the first of them, and how many they are."""
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    order = F.struct(F.col("turn").isNotNull().alias("has"), F.col("turn").alias("turn"))
    first = rows.groupBy(*[F.col(c).alias(f"_{c}") for c in ("conv_id", "role", "text")]).agg(F.min(order).alias("_first"))
    same = F.col("conv_id").eqNullSafe(F.col("_conv_id")) & (F.col("role") == F.col("_role")) & (F.col("text") == F.col("_text"))
    fault = (
        F.when(~F.col("text").rlike(f"[^{_SPACES}]"), "blank")
        .when(F.col("_first") < order, "duplicate")
        .when(~F.col("text").rlike(rf"[.!?][{_SPACES}]*\z"), "truncated")
        .otherwise("")
    )
    return rows.join(first, same).select(
        "conv_id", "turn", "role", "text", "copies", F.substring("role", 1, 1).alias("initial"), fault.alias("fault")
    )


def _items(initial: str, fault: str, copies: int) -> list[Item]:
    """Blank rows, and rows seen before, have to go; so do all copies but the first."""
    if fault in ("blank", "duplicate"):
        return [Item(initial, forced=copies)]
    return [Item(initial, fault == "truncated"), *([Item(initial, forced=copies - 1)] if copies > 1 else [])]


class _Chunk:
    """What is to be known of neighbouring rows of a conversation before the rest is seen."""

    def __init__(self, entries):
        self.entries, self.items, self.turns, self.initials = entries, [], [], []
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.distinct = self.rows = 0

    def add(self, turn, initial, fault, copies):
        self.rows += 1
        self.items += _items(initial, fault, copies)
        if turn is not None and (not self.turns or self.turns[-1] != turn):
            self.turns = [*self.turns[:1], turn]
            self.distinct += 1
        if self.initials and self.initials[-1] + initial not in LEGAL:
            self.counts["illegal"] += 1
        self.counts["illegal"] += copies - 1
        self.initials = [*self.initials[:1], initial]
        if fault in ("blank", "duplicate"):
            self.counts[fault] += copies
        else:
            self.counts["duplicate"] += copies - 1
            self.counts["truncated"] += fault == "truncated"

    def found(self, goals) -> str:
        ways = {f"{e},{g}": way for e in self.entries for g in goals if (way := least_repair(self.items, e, g))}
        ends = lambda x: [x[0], x[-1]] if x else []
        return json.dumps({"ways": ways, "turns": ends(self.turns), "distinct": self.distinct, "initials": ends(self.initials), **self.counts})


def _placed(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The sorted rows with their chunk and place, and one row (pos -1) with what was found for each chunk."""
    part, chunk, number, conv = TaskContext.get().partitionId(), None, -1, None
    buffer: list[tuple] = []

    def close(goals):
        buffer.append((part, number, -1, conv, None, None, None, None, None, chunk.found(goals)))

    def flush():
        rows = pa.RecordBatch.from_pylist([dict(zip(schema.names, row, strict=True)) for row in buffer], schema=schema)
        buffer.clear()
        return rows

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "initial", "fault", "copies")]
        for conv_id, turn, role, text, initial, fault, copies in zip(*columns, strict=True):
            if chunk is None or conv_id != conv or chunk.rows >= CHUNK:
                fresh = chunk is not None and conv_id != conv
                if chunk is not None:
                    close([END] if fresh else STATES)
                # Before its first row a task cannot see whether the conversation began earlier.
                chunk, number, conv = _Chunk([0] if fresh else STATES), number + 1, conv_id
            buffer.append((part, number, chunk.rows, conv_id, role, text, initial, fault, copies, None))
            chunk.add(turn, initial, fault, copies)
        yield flush()
    if chunk is not None:
        close([END, *STATES])
        yield flush()


def _by_conversation(rows):
    return itertools.groupby(rows, key=lambda row: (row["conv_id"] is None, row["conv_id"]))


def _rows_of(batches):
    for batch in batches:
        yield from batch.to_pylist()


def _in_batches(rows, schema: pa.Schema, size: int = 1 << 22):
    """Record batches of about ``size`` characters."""
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += 64 + len(row.get("text") or "") + len(row.get("audit") or "")
        if weight >= size:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _chosen(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """For each conversation its report (chunk -1), and for each chunk the state it is entered in and its audit."""

    def rows():
        for _, chunks in _by_conversation(_rows_of(batches)):
            heads = [(c["conv_id"], c["part"], c["chunk"], json.loads(c["found"])) for c in chunks]
            yield from _put_together(heads)

    yield from _in_batches(rows(), schema)


def _put_together(heads):
    best, choice = {END: 0}, []
    for at, (_, _, _, found) in enumerate(reversed(heads)):
        options = {}
        for key, (cost, audit) in found["ways"].items():
            entry, goal = map(int, key.split(","))
            if (goal == END) == (at == 0) and goal in best:
                # Audits to different states differ before either ends, so the first chunk that differs decides.
                options.setdefault(entry, []).append((cost + best[goal], audit, goal))
        choice.append({entry: min(ways) for entry, ways in options.items()})
        best = {entry: way[0] for entry, way in choice[-1].items()}
    state, audits, report = 0, [], dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
    report |= {"gaps": 0, "cost": best[0]}
    turns, distinct, initial = [], 0, None
    for (conv_id, part, chunk, found), ways in zip(heads, reversed(choice), strict=True):
        _, audit, goal = ways[state]
        yield {"conv_id": conv_id, "part": part, "chunk": chunk, "entry": state, "audit": audit, "found": None}
        state = goal
        audits.append(audit)
        for name in ("blank", "duplicate", "truncated", "illegal"):
            report[name] += found[name]
        report["illegal"] += initial is not None and initial + found["initials"][0] not in LEGAL
        initial = found["initials"][1]
        if found["turns"]:
            distinct += found["distinct"] - (bool(turns) and turns[1] == found["turns"][0])
            turns = [turns[0] if turns else found["turns"][0], found["turns"][1]]
    if turns:
        report["gaps"] = turns[1] - turns[0] + 1 - distinct
    yield {"conv_id": heads[0][0], "part": -1, "chunk": -1, "entry": 0, "audit": "".join(audits), "found": json.dumps(report)}


def _repaired(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The rows left and put in, chunk by chunk; the row that names a chunk's audit comes before its rows."""

    def rows():
        for (conv_id, part, chunk), lines in itertools.groupby(_rows_of(batches), key=lambda r: (r["conv_id"], r["part"], r["chunk"])):
            head = next(lines)
            held = list(lines)  # CHUNK rows at most
            items, row_of = [], []
            for row in held:
                made = _items(row["initial"], row["fault"], row["copies"])
                items += made
                row_of += [row] * len(made)
            for n, (i, letter) in enumerate(apply(items, head["audit"], head["entry"])[0]):
                row = row_of[i] if i is not None else None
                yield {
                    "conv_id": conv_id, "part": part, "chunk": chunk, "pos": row["pos"] if row else -1, "n": n,
                    "role": ROLES[letter] if letter else row["role"], "text": row["text"] if row else "",
                }

    yield from _in_batches(rows(), schema)


def _hashed(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    def rows():
        for _, lines in _by_conversation(_rows_of(batches)):
            digest, conv_id = hashlib.sha256(), None
            for k, row in enumerate(lines):
                conv_id = row["conv_id"]
                digest.update(("\n" * (k > 0) + f"{row['role']}:{row['text']}").encode())
            yield {"conv_id": conv_id, "repaired_sha256": digest.hexdigest()}

    yield from _in_batches(rows(), schema)


def _through(df: DataFrame, function, schema: str) -> DataFrame:
    """``df`` through ``function(batches, Arrow schema)``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))
    return df.mapInArrow(lambda batches: function(batches, arrow), schema)


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(repaired rows, reports) of conversations given as conv_id, turn, role, text and ``copies``.

    Rows of a conversation are taken by turn, nulls first, then role, then text. Rows without conv_id
    are one conversation. Null roles and texts must have been replaced. Repaired rows stand in the
    order of part, chunk and n. The report has the counts of faults, cost and audit; a conversation
    without rows has none, an empty table gives empty tables. Columns of other names are not read.
    """
    kind = dict(rows.dtypes)["conv_id"]
    facts = _with_faults(rows)
    head = F.substring("text", 1, 64)
    placed = facts.repartitionByRange("conv_id", "turn", "role", head).sortWithinPartitions("conv_id", "turn", "role", "text")
    placed = written(_through(placed, _placed, _PLACED.format(id=kind)), "turns")
    heads = placed.where("pos = -1").select("conv_id", "part", "chunk", "found")
    heads = heads.repartition("conv_id").sortWithinPartitions("conv_id", "part", "chunk")
    chosen = written(_through(heads, _chosen, _CHOSEN.format(id=kind)), "audits")
    lines = placed.where("pos >= 0").drop("found").withColumn("entry", F.lit(None).cast("int")).withColumn("audit", F.lit(None).cast("string"))
    marks = chosen.where("chunk >= 0").select("conv_id", "part", "chunk", "entry", "audit", F.lit(-1).alias("pos"))
    both = lines.unionByName(marks, allowMissingColumns=True)
    both = both.repartition("conv_id").sortWithinPartitions("conv_id", "part", "chunk", "pos")
    found = F.from_json("found", ", ".join(f"{c} long" for c in _COUNTS))
    reports = chosen.where("chunk = -1").select("conv_id", "audit", found.alias("f")).select("conv_id", "f.*", "audit")
    return _through(both, _repaired, _REPAIRED.format(id=kind)), reports


def hashes(repaired: DataFrame) -> DataFrame:
    """conv_id and the hash of role:text of its repaired rows, newline-joined; takes the rows as ``repair`` hands them out."""
    kind = dict(repaired.dtypes)["conv_id"]
    return _through(repaired, _hashed, f"conv_id {kind}, repaired_sha256 string")


def damage_and_repair(conversations: DataFrame) -> DataFrame:
    """One row for each conv_id: the report of its damaged rows and the hash of what the repair makes of them.

    A conversation that lost all rows has zeros, an empty audit and the hash of nothing. Null values
    count as one space, but a null turn stays null and sorts first; rows that repeat count as often as they stand.
    """
    repaired, reports = repair(damaged(conversations))
    every = conversations.select("conv_id").distinct()
    found, digests = reports.withColumnRenamed("conv_id", "_r"), hashes(repaired).withColumnRenamed("conv_id", "_h")
    rows = every.join(found, F.col("conv_id").eqNullSafe(F.col("_r")), "left").join(digests, F.col("conv_id").eqNullSafe(F.col("_h")), "left")
    return rows.select(
        "conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in _COUNTS],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
