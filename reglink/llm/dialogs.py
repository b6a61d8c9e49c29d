"""Repair of conversation structure by weighted interval parsing.

A conversation's turns are judged (blank, duplicate, truncated) and edited
at least cost until their role initials read ``(s?(ua)+)?``:

- Keep costs 0, Rerole to user or assistant 2, Delete 3 (the only edit of
  blank and duplicate turns), Insert an empty user or assistant turn 2;
- a truncated turn that is not deleted adds 1;
- among the cheapest, the edits whose initials are smallest in ASCII.

The repair grammar is in Chomsky normal form. Its nonterminals are X_pq, "the
edits of this span lead from place p of the wanted pattern to place q", its
binary rules X_pq -> X_pr X_rq, and its start X_0q for the places q where a
conversation may end. A cell holds the least (cost, audit) of one nonterminal
over one span. A leaf is the cell of one turn after the closure over
insertions in front of it; longer spans are combined bottom-up, span length
by span length. The rules exist for every middle place r, so every split of a
span gives the same cells and one split is enough: spans double in length.
(Audits of equal cost over one span are never prefixes of each other, since
more insertions cost more; so the least of a longer span is made of the least
of its parts.)

Turns are counted before any shuffle, so copies travel as one row with a
number, and copies beyond the first are a power of the deletion cell. Without
their texts (a SHA-256 stands for each) they are ordered by range over all
conversations, so a conversation of any size is cut into segments; each
segment is parsed by itself, a conversation's segments are combined in order,
and the audit is dealt back to the segments. Texts join the repaired turns at
the end. Only the digest of a whole repaired conversation needs one task per
conversation, as SHA-256 runs in order; it streams.

Order of turns: by turn (nulls first), equal turns by role and SHA-256 of the
text. Null roles and texts are one space; null conversations are one
conversation. Empty tables give empty results; further columns are passed
over, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reglink.llm import frames

# Places of the pattern: 0 start, 1 after s, 2 after u, 3 after a.
STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ENDS = (0, 3)
RULES = [(p, r, q) for p in range(4) for r in range(4) for q in range(4) if r in (range(4), (1, 2, 3), (2, 3), (2, 3))[p] and q in (range(4), (1, 2, 3), (2, 3), (2, 3))[r]]
SYMBOLS = sorted({(p, q) for p, _, q in RULES})
_AT = {s: i for i, s in enumerate(SYMBOLS)}
_BINARY = [(_AT[p, q], _AT[p, r], _AT[r, q]) for p, r, q in RULES]
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
_NEVER = (1 << 62, "~")
SPACE = " \t\n\x0b\x0c\r"
LEGAL = ("su", "ua", "au")

Cell = list[tuple[int, str]]


def _cell(entries: dict[tuple[int, int], list[tuple[int, str]]]) -> Cell:
    return [min(entries.get(s, [_NEVER])) for s in SYMBOLS]


def combine(left: Cell, right: Cell) -> Cell:
    """The cell of two adjacent spans, by the binary rules."""
    out = [_NEVER] * len(SYMBOLS)
    for to, a, b in _BINARY:
        cost = left[a][0] + right[b][0]
        if cost <= out[to][0]:
            found = (cost, left[a][1] + right[b][1])
            if found < out[to]:
                out[to] = found
    return out


def combine_all(cells: list[Cell]) -> Cell:
    """Adjacent spans bottom-up: every round doubles the span length."""
    while len(cells) > 1:
        cells = [combine(cells[i], cells[i + 1]) if i + 1 < len(cells) else cells[i] for i in range(0, len(cells), 2)]
    return cells[0] if cells else NOTHING


def power(cell: Cell, n: int) -> Cell:
    """The cell of ``n`` equal adjacent spans."""
    out = NOTHING
    while n:
        if n & 1:
            out = combine(out, cell)
        cell, n = combine(cell, cell) if n > 1 else cell, n >> 1
    return out


NOTHING = _cell({(p, p): [(0, "")] for p in range(4)})
_INSERT = _cell({(p, q): [(INSERT, "I")] for (p, role), q in STEPS.items() if role in "ua"})
_once = [min(a, b) for a, b in zip(NOTHING, _INSERT, strict=True)]
# Any number of insertions: no path in the pattern needs more than three.
CLOSURE = combine(_once, combine(_once, _once))


def leaf(initial: str, truncated: bool, deleted: bool) -> Cell:
    """One turn, with the insertions in front of it."""
    more, edits = TRUNCATED if truncated else 0, {(p, p): [(DELETE, "D")] for p in range(4)}
    if not deleted:
        for (p, role), q in STEPS.items():
            if role == initial:
                edits.setdefault((p, q), []).append((KEEP + more, "K"))
            if role in "ua":
                edits.setdefault((p, q), []).append((REROLE + more, "R"))
    return combine(CLOSURE, _cell(edits))


_DELETED = leaf("", False, True)
_LEAVES = {(c, t): leaf(c, t, False) for c in ("s", "u", "a", "") for t in (False, True)}


def best(cell: Cell) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    cell = combine(cell, CLOSURE)
    return min(cell[_AT[0, q]] for q in ENDS)


# --- rows to segments, segments to conversations -----------------------------

_SEGMENT = "conv {0}, part int, n_rows bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, first string, last string, low bigint, high bigint, turns bigint, first_turn bigint, last_turn bigint, costs array<bigint>, audits array<string>"
_DEALT = "conv {0}, part int, edits string, place bigint, odd boolean, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
_REPAIRED = "conv {0}, place bigint, role string, text_role string, digest binary, edit string"
_DIGEST = "conv {0}, repaired_sha256 string"


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096, limit: int = 1 << 24) -> Iterator[pa.RecordBatch]:
    """Rows in batches of a bounded number of rows and of characters."""
    part, held = [], 0
    for row in rows:
        part.append(row)
        held += sum(len(x) for x in row if isinstance(x, str))
        if len(part) >= size or held >= limit:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part, strict=True), schema, strict=True)], schema=schema)
            part, held = [], 0
    if part:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part, strict=True), schema, strict=True)], schema=schema)


def _run(df: DataFrame, work, ddl: str, conv: str) -> DataFrame:
    """``work`` (rows to rows) over the sorted partitions of ``df``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(ddl.format(conv)))
    return df.mapInArrow(lambda batches: _batches(work(_rows(batches)), schema), ddl.format(conv))


def _segments(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(conv, part, turn, initial, n, blank, cut, fresh) in order to one row
    per (conv, part): its counts and its cells."""
    for (conv, part), group in groupby(rows, lambda r: r[:2]):
        cells, n_rows, blank, duplicate, truncated, illegal, turns = [], 0, 0, 0, 0, 0, 0
        first = last = low = high = first_turn = last_turn = None
        for _, _, turn, initial, n, is_blank, cut, fresh in group:
            if last is None:
                first, first_turn = initial, turn
            else:
                illegal += last + initial not in LEGAL
            illegal += n - 1
            if turn is not None:
                turns += turn != last_turn
                low, high = (turn if low is None else low), turn
            last, last_turn = initial, turn
            n_rows += n
            alive = fresh and not is_blank
            if is_blank:
                blank += n
            else:
                duplicate += n - alive
                truncated += alive and cut
            if alive:
                cells.append(_LEAVES[initial if initial in ("s", "u", "a") else "", cut])
            if n > alive:
                cells.append(power(_DELETED, n - alive))
        total = combine_all(cells)
        feasible = [c < _NEVER[0] for c, _ in total]
        yield (
            conv, part, n_rows, blank, duplicate, truncated, illegal, first, last, low, high, turns, first_turn, last_turn,
            [c if f else None for (c, _), f in zip(total, feasible, strict=True)], [a if f else None for (_, a), f in zip(total, feasible, strict=True)],
        )


def _deal(edits: str, begin: int, n: int) -> int:
    """Where the edits of ``n`` turns end that begin at ``begin``."""
    while n:
        n -= edits[begin] != "I"
        begin += 1
    return begin


def _conversations(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Segments of each conversation in order to its totals (on its first
    row) and every segment's edits."""
    for conv, group in groupby(rows, lambda r: r[0]):
        parts = list(group)
        cells = [[_NEVER if c is None else (c, a) for c, a in zip(r[14], r[15], strict=True)] for r in parts]
        cost, audit = best(combine_all(cells))
        blank, duplicate, truncated, illegal = (sum(r[i] for r in parts) for i in range(3, 7))
        illegal += sum(a[8] + b[7] not in LEGAL for a, b in zip(parts, parts[1:], strict=False))
        lows, highs = [r[9] for r in parts if r[9] is not None], [r[10] for r in parts if r[10] is not None]
        turns = sum(r[11] for r in parts) - sum(a[13] is not None and a[13] == b[12] for a, b in zip(parts, parts[1:], strict=False))
        totals = (max(highs) - min(lows) + 1 - turns if lows else 0, blank, duplicate, truncated, illegal, cost, audit)
        odd, begin, place = (len(audit) - audit.count("D")) % 2 == 1, 0, 0
        for i, r in enumerate(parts):
            end = len(audit) if i + 1 == len(parts) else _deal(audit, begin, r[2])
            yield (conv, r[1], audit[begin:end], place, odd, *(totals if not i else (None,) * 7))
            place += end - begin - audit.count("D", begin, end)
            begin = end


def _apply(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(conv, part, kind, role, digest, n, edits, place, odd): a segment's
    edits (kind 0) followed by its turns, to the repaired turns."""
    edits, at, place, odd, conv, part = "", 0, 0, False, None, None

    def inserted(until: int) -> Iterator[tuple]:
        nonlocal place
        for _ in range(at, until):
            yield (conv, place, role_at(), None, None, "I")
            place += 1

    def role_at() -> str:
        return "user" if place % 2 == odd else "assistant"

    for row in rows:
        if row[2] == 0:
            yield from inserted(len(edits))
            conv, part, _, _, _, _, edits, place, odd = row
            at = 0
            continue
        _, _, _, role, digest, n = row[:6]
        for _ in range(n):
            until = at
            while edits[until] == "I":
                until += 1
            yield from inserted(until)
            at = until + 1
            if (edit := edits[until]) != "D":
                yield (conv, place, role if edit == "K" else role_at(), role, digest, edit)
                place += 1
    yield from inserted(len(edits))


def _digests(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Repaired turns of each conversation in order to one digest."""
    for conv, group in groupby(rows, lambda r: r[0]):
        digest = hashlib.sha256()
        for i, (_, role, text) in enumerate(group):
            digest.update((("\n" if i else "") + role + ":" + text).encode("utf-8", "surrogateescape"))
        yield (conv, digest.hexdigest())


# --- the operator -------------------------------------------------------------


def _same(a: DataFrame, b: DataFrame, *columns: str) -> Column:
    """Null-safe equality of columns of two frames."""
    out = F.lit(True)
    for c in columns:
        out = out & a[c].eqNullSafe(b[c])
    return out


class Repair:
    """The repair of a table of turns. ``summary``: one row per conversation
    with turns (conv, gaps, blank, duplicate, truncated, illegal, cost,
    audit). ``turns``: the repaired turns (conv, place, role, text, edit)."""

    def __init__(self, table: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"):
        frames.ready(table.sparkSession)
        space = F.lit(" ")
        rows = table.select(
            F.col(f"`{conv}`").alias("conv"),
            F.col(f"`{turn}`").cast("bigint").alias("turn"),
            F.coalesce(F.col(f"`{role}`").cast("string"), space).alias("role"),
            F.coalesce(F.col(f"`{text}`").cast("string"), space).alias("text"),
        )
        self.kind = kind = rows.schema["conv"].dataType.simpleString()
        body = F.rtrim("text", F.lit(SPACE))
        rows = rows.withColumns(
            {"digest": F.unhex(F.sha2(F.col("text").cast("binary"), 256)), "blank": body == "", "cut": ~F.substring(body, -1, 1).isin(".", "!", "?")}
        )
        counted = rows.groupBy("conv", "turn", "role", "digest", "blank", "cut").agg(F.count(F.lit(1)).alias("n"))
        # Where each (role, text) of a conversation is seen first.
        first = rows.groupBy("conv", "role", "digest").agg(F.min(F.struct(F.col("turn").isNotNull(), "turn")).alias("seen"))
        judged = counted.join(first.hint("merge"), _same(counted, first, "conv", "role", "digest")).select(
            counted["conv"], "turn", counted["role"], counted["digest"], "n", "blank", "cut", F.col("turn").eqNullSafe(F.col("seen.turn")).alias("fresh")
        )
        order = [F.asc_nulls_first("turn"), F.asc("role"), F.asc("digest")]
        ordered = frames.keep(judged.repartitionByRange(F.asc_nulls_first("conv"), *order).withColumn("part", F.spark_partition_id()))
        segment = ordered.repartition("conv", "part").sortWithinPartitions("conv", "part", *order)
        cells = _run(segment.select("conv", "part", "turn", F.substring("role", 1, 1), "n", "blank", "cut", "fresh"), _segments, _SEGMENT, kind)
        dealt = frames.keep(_run(cells.repartition("conv").sortWithinPartitions("conv", "part"), _conversations, _DEALT, kind))
        self.summary = dealt.where(F.col("cost").isNotNull()).select("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")

        edits = dealt.select("conv", "part", F.lit(0).alias("kind"), "edits", "place", "odd").unionByName(
            ordered.select("conv", "part", F.lit(1).alias("kind"), "turn", "role", "digest", "n"), allowMissingColumns=True
        )
        edits = edits.repartition("conv", "part").sortWithinPartitions("conv", "part", "kind", *order).select("conv", "part", "kind", "role", "digest", "n", "edits", "place", "odd")
        repaired = _run(edits, _apply, _REPAIRED, kind)
        texts = rows.where(~F.col("blank")).groupBy("conv", "role", "digest").agg(F.first("text").alias("text"))
        found = texts.withColumnsRenamed({"conv": "text_conv", "role": "spoken_by", "digest": "text_digest"}).hint("merge")
        same = F.col("conv").eqNullSafe(F.col("text_conv")) & (F.col("text_role") == F.col("spoken_by")) & (F.col("digest") == F.col("text_digest"))
        self.turns = repaired.join(found, same, "left").select("conv", "place", "role", F.coalesce("text", F.lit("")).alias("text"), "edit")

    def digests(self) -> DataFrame:
        """(conv, repaired_sha256) of conversations with repaired turns: the
        SHA-256 of their ``role:text``, joined by newlines."""
        ordered = self.turns.repartition("conv").sortWithinPartitions("conv", "place").select("conv", "role", "text")
        return _run(ordered, _digests, _DIGEST, self.kind)


def damage(table: DataFrame) -> DataFrame:
    """The contract's damage, by crc32(``conv_id:turn``) modulo 20."""
    space = F.lit(" ")
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    rows = table.select(
        "conv_id", "turn", F.coalesce(F.col("role").cast("string"), space).alias("role"), F.coalesce(F.col("text").cast("string"), space).alias("text"),
        (F.crc32(key.cast("binary")) % 20).cast("int").alias("fault"),
    ).where("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.array_repeat(F.lit(1), F.when(F.col("fault") == 3, 2).otherwise(1)))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation's faults, cheapest repair and digest after it."""
    table = frames.read(spark, sf_dir, "conversations")
    repair = Repair(damage(table))
    everyone = table.select(F.col("conv_id").alias("conv"))
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    # One aggregate instead of joins: it keeps a null conversation as well.
    union = everyone.unionByName(repair.summary, allowMissingColumns=True).unionByName(repair.digests(), allowMissingColumns=True)
    return union.groupBy(F.col("conv").alias("conv_id")).agg(
        *[F.coalesce(F.max(c), F.lit(0)).cast("bigint").alias(c) for c in counts],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
