"""Repair of conversation structure by weighted interval parsing.

A conversation is well formed if the initials of its roles read ``(s?(ua)+)?``. Rows may be kept, get
another role or be deleted, and rows may be inserted, each at a cost; wanted is the cheapest
repair and, among equally cheap ones, the one whose edits have the least initials.

The grammar, in Chomsky normal form, has the empty interval and one symbol for each pair of first
and last role that an interval of a well-formed conversation may have. ``X -> Y Z`` holds if Y's
last role may stand before Z's first, and the empty interval is neutral. A cell holds, for each
symbol, the least (cost, audit) with which its span of rows becomes such an interval. Cells of
single rows are closed under insertion on both sides, so that longer spans need no closure: an
inserted row belongs to a row beside it. Cells are combined bottom-up by span length. Since
every interval cut anywhere leaves two intervals of the grammar, each split of a span gives the same
least cell. So one split per span is enough, and spans need to double only: a chart of n rows
takes n - 1 combinations instead of n^3.

That is also how a conversation too long for one task is parsed. Rows are sorted into ranges of
(conversation, turn), cut into blocks of 1,024 rows, and each block leaves one cell per conversation. Further rounds
combine 64 cells of neighbours each and store which symbols they chose; the way back down tells each
block its symbol. Audits of equal cost and span never are beginnings of each other (that would be an insertion
more), so the order of audits holds for parts as well as for wholes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import accumulate, groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from parcelpulse.functions.joins import null_safe_join
from parcelpulse.llm.common import prepare
from parcelpulse.session import staged

#: Rows of a block, and cells that one round combines.
BLOCK = 1024
FAN = 64
#: What is no written character, what ends a sentence, and which roles may be given.
SPACES = " \t\n\v\f\r"
ENDS = ".!?"
ROLES = {"u": "user", "a": "assistant"}
AFTER = {"s": "u", "u": "a", "a": "u"}
#: Symbols: the empty interval, then (first, last) roles.
SYMBOLS = ("", "ss", "su", "sa", "uu", "ua", "au", "aa")
PLACE = {x: i for i, x in enumerate(SYMBOLS)}
RULES = tuple(
    (PLACE[y + z if not (y and z) else y[0] + z[1]], PLACE[y], PLACE[z])
    for y in SYMBOLS
    for z in SYMBOLS
    if not (y and z) or AFTER[y[1]] == z[0]
)
#: What a whole conversation may be.
WHOLE = tuple(PLACE[x] for x in ("", "ua", "sa"))

Cell = list[tuple[int, str] | None]


@dataclass(frozen=True)
class Costs:
    """Insertions must cost something: else there would be endless audits of equal cost."""

    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5

    def __post_init__(self):
        if self.insert <= 0 or min(self.rerole, self.delete, self.truncated) < 0:
            raise ValueError("costs are not negative, and that of an insertion is above 0")


def _offer(cell: Cell, symbol: int, cost: int, audit: str) -> bool:
    there = cell[symbol]
    if there is None or (cost, audit) < there:
        cell[symbol] = (cost, audit)
        return True
    return False


def _closed(cell: Cell, costs: Costs) -> Cell:
    """Closed under insertion of rows on both sides; ends, as every insertion costs."""
    grown = True
    while grown:
        grown = False
        for symbol, entry in enumerate(cell):
            if entry is None:
                continue
            cost, audit, name = entry[0] + costs.insert, entry[1], SYMBOLS[symbol]
            for role in ROLES:
                if not name or AFTER[role] == name[0]:
                    grown |= _offer(cell, PLACE[role + (name[1] if name else role)], cost, "I" + audit)
                if not name or AFTER[name[1]] == role:
                    grown |= _offer(cell, PLACE[(name[0] if name else role) + role], cost, audit + "I")
    return cell


def deleted_cell(n: int, costs: Costs) -> Cell:
    """The cell of n neighbours that all have to go. Inserted rows stand before or, which is
    the lesser audit, after them."""
    cell: Cell = [None] * len(SYMBOLS)
    cell[0] = (n * costs.delete, "D" * n)
    return _closed(cell, costs)


def row_cell(initial: str, fault: str, costs: Costs) -> Cell:
    """The cell of one row: kept, with another role or deleted."""
    cell: Cell = [None] * len(SYMBOLS)
    _offer(cell, 0, costs.delete, "D")
    if fault not in ("blank", "duplicate"):
        stays = costs.truncated if fault == "truncated" else 0
        if initial in AFTER:
            _offer(cell, PLACE[initial * 2], stays, "K")
        for role in ROLES:
            _offer(cell, PLACE[role * 2], stays + costs.rerole, "R")
    return _closed(cell, costs)


def combine(left: Cell, right: Cell) -> Cell:
    cell: Cell = [None] * len(SYMBOLS)
    for x, y, z in RULES:
        a, b = left[y], right[z]
        if a is not None and b is not None:
            cost, there = a[0] + b[0], cell[x]
            if there is None or cost <= there[0]:
                entry = (cost, a[1] + b[1])
                if there is None or entry < there:
                    cell[x] = entry
    return cell


def _chart(cells: list[Cell]) -> list[list[Cell]]:
    """Cells of spans of 1, 2, 4 and so on neighbours; the last has one cell, of them all."""
    chart = [cells]
    while len(chart[-1]) > 1:
        low = chart[-1]
        chart.append([combine(*low[i : i + 2]) if i + 1 < len(low) else low[i] for i in range(0, len(low), 2)])
    return chart


def parse(cells: list[Cell]) -> Cell:
    return _chart(cells)[-1][0]


def chosen(cells: list[Cell], whole: int) -> list[int]:
    """The symbol of each of the neighbouring cells in the least derivation of ``whole`` from them all."""
    chart, symbols = _chart(cells), [whole]
    for low, high in zip(chart[-2::-1], chart[:0:-1]):
        below = []
        for i, (symbol, cell) in enumerate(zip(symbols, high)):
            if 2 * i + 1 == len(low):
                below.append(symbol)
                continue
            left, right = low[2 * i], low[2 * i + 1]
            below += next(
                (y, z)
                for x, y, z in RULES
                if x == symbol and left[y] and right[z] and (left[y][0] + right[z][0], left[y][1] + right[z][1]) == cell[symbol]
            )
        symbols = below
    return symbols


def applied(symbol: int, audit: str) -> list[tuple[str, str]]:
    """(edit, role) of each edit of an interval; the role of a kept row is its initial's, a deleted row has none."""
    out, role = [], SYMBOLS[symbol][:1]
    for edit in audit:
        if edit == "D":
            out.append((edit, ""))
            continue
        out.append((edit, role))
        role = AFTER[role]
    return out


def clean_rows(conversations: DataFrame, key: str = "conv_id", order: str = "turn") -> DataFrame:
    """The rows as (conv, turn, role, text); nulls of role and text are one space."""
    return conversations.select(
        F.col(key).alias("conv"), F.col(order).alias("turn"),
        F.coalesce(F.col("role"), F.lit(" ")).alias("role"), F.coalesce(F.col("text"), F.lit(" ")).alias("text"),
    )


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with a fifth of them spoiled, by a digest of conversation and turn: one twentieth each is dropped,
    emptied, loses what ends its sentences, is repeated, or is said by the user."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv", "turn")]
    kind = F.crc32(F.concat_ws(":", *said)) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    role = F.when(kind == 4, ROLES["u"]).otherwise(F.col("role"))
    out = rows.where(kind != 0).select("conv", "turn", role.alias("role"), text.alias("text"), F.when(kind == 3, 2).otherwise(1).alias("times"))
    return out.select("conv", "turn", "role", "text", F.explode(F.sequence(F.lit(1), "times"))).drop("col")


def sorted_rows(rows: DataFrame) -> DataFrame:
    """Adds ``pos``, ascending in each conversation's order, and ``copies``; stored.

    Rows stand by turn, null turns first, then by role and text; rows equal in all of it are one row
    with ``copies``, counted before anything moves. No conversation has to fit a task: the sort is
    by ranges. ``pos`` is the range and, in the low bits, the place in it without gaps.
    """
    spark = rows.sparkSession
    equal = rows.groupBy("conv", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "text"]
    ranged = equal.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order)
    stored = staged(ranged.withColumn("id", F.monotonically_increasing_id()), "repair-rows")
    place = F.col("id").bitwiseAND((1 << 33) - 1)
    bits = max((stored.agg(F.max(place)).first()[0] or 0).bit_length(), BLOCK.bit_length() - 1)
    return stored.withColumn("pos", F.shiftleft(F.shiftright("id", 33), bits) + place).drop("id")


def with_faults(ordered: DataFrame) -> DataFrame:
    """(conv, turn, pos, initial, fault, copies) of every row, without its text.

    A duplicate has role and text of an earlier row of its conversation. Only the first of rows that
    occur at several places are joined, by digest.
    """
    key = F.concat_ws("\0", F.col("conv").isNull().cast("string"), F.coalesce(F.col("conv").cast("string"), F.lit("")), "role", "text")
    last = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    fault = F.when(last == "", "blank").when(~last.isin(*ENDS), "truncated").otherwise("")
    narrow = staged(
        ordered.select(
            "conv", "turn", "pos", "copies", F.left("role", F.lit(1)).alias("initial"), fault.alias("fault"),
            F.unhex(F.sha2(key, 256)).alias("same"),
        ),
        "repair-narrow",
    )
    places = narrow.groupBy("same").agg(F.min("pos").alias("first"), F.max("pos").alias("last"))
    # stored, so that both sides of the join are plain exchanges, of which a hot one can be split
    again_at = staged(places.where("first < last").select("same", "first"), "repair-repeats")
    joined = narrow.join(again_at, "same", "left")
    again = F.coalesce(F.col("first") < F.col("pos"), F.lit(False)) & (F.col("fault") != "blank")
    return joined.withColumn("fault", F.when(again, "duplicate").otherwise(F.col("fault"))).drop("same", "first")


_CELL = "array<struct<cost:long,audit:string>>"
_COUNTS = ("illegal", "blank", "duplicate", "truncated")
_SPAN = f"at long, cell {_CELL}, head string, tail string, " + ", ".join(f"{c} long" for c in _COUNTS)


def _packed(cell: Cell) -> list[dict | None]:
    return [None if e is None else {"cost": e[0], "audit": e[1]} for e in cell]


def _unpacked(cell: list[dict | None]) -> Cell:
    return [None if e is None else (e["cost"], e["audit"]) for e in cell]


def _dicts(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _mapped(df: DataFrame, each: Callable[[Iterator[dict]], Iterator[dict]], schema: str) -> DataFrame:
    """``df`` through a function on its rows, batch by batch."""
    wanted = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for row in each(_dicts(batches)):
            held.append(row)
            if len(held) >= BLOCK:
                yield pa.RecordBatch.from_pylist(held, wanted)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, wanted)

    return df.mapInArrow(run, schema)


def _legal(pair: str) -> bool:
    return pair in ("su", "ua", "au")


def block_cells(faults: DataFrame, costs: Costs) -> DataFrame:
    """Per conversation and block: the cell of its rows, counts of faults, first and last initial.

    A block is 1,024 neighbours in the sorted order, so a conversation lies in one or two, or in as
    many as its length asks for. ``copies`` are those of its rows, which follow each other from ``at``.
    """

    def cells(rows: Iterator[dict]) -> Iterator[dict]:
        row_cells: dict[tuple[str, str], Cell] = {}
        for (_, conv), own in groupby(rows, lambda r: (r["block"], r["conv"])):
            spans, copies, at, head, tail = [], [], None, None, None
            n = dict.fromkeys(_COUNTS, 0)
            for r in own:
                initial, fault, more = r["initial"] if r["initial"] in AFTER else "?", r["fault"], r["copies"] - 1
                if (initial, fault) not in row_cells:
                    row_cells[initial, fault] = row_cell(initial, fault, costs)
                spans.append(row_cells[initial, fault])
                if more:
                    spans.append(deleted_cell(more, costs))
                if fault:
                    n[fault] += 1
                n["blank" if fault == "blank" else "duplicate"] += more
                n["illegal"] += more + (tail is not None and not _legal(tail + initial))  # no role may follow itself
                copies.append(more + 1)
                at, head, tail = r["pos"] if at is None else at, head or initial, initial
            yield {"conv": conv, "at": at, "cell": _packed(parse(spans)), "head": head, "tail": tail, **n, "copies": copies}

    kind = dict(faults.dtypes)["conv"]
    blocks = faults.select(F.shiftright("pos", BLOCK.bit_length() - 1).alias("block"), "conv", "pos", "initial", "fault", "copies")
    dealt = blocks.repartition("block").sortWithinPartitions("pos")
    return _mapped(dealt, cells, f"conv {kind}, {_SPAN}, copies array<long>")


def _round(cells: DataFrame, shift: int) -> DataFrame:
    """Cells of up to 64 neighbours of a conversation as one, with the cells it is made of."""

    def combined(rows: Iterator[dict]) -> Iterator[dict]:
        for row in rows:
            parts = row["parts"]
            n = {c: sum(p[c] for p in parts) for c in _COUNTS}
            n["illegal"] += sum(not _legal(a["tail"] + b["head"]) for a, b in zip(parts, parts[1:]))
            cell = parse([_unpacked(p["cell"]) for p in parts])
            yield {
                "conv": row["conv"], "at": parts[0]["at"], "cell": _packed(cell), "head": parts[0]["head"], "tail": parts[-1]["tail"],
                **n, "parts": [{"at": p["at"], "cell": p["cell"]} for p in parts],
            }

    kind = dict(cells.dtypes)["conv"]
    span = F.struct("at", "cell", "head", "tail", *_COUNTS)
    grouped = cells.groupBy("conv", F.shiftright("at", shift).alias("group")).agg(F.array_sort(F.collect_list(span)).alias("parts"))
    return _mapped(grouped.select("conv", "parts"), combined, f"conv {kind}, {_SPAN}, parts array<struct<at:long,cell:{_CELL}>>")


def _roots(cells: DataFrame) -> DataFrame:
    """The least whole conversation of each cell that has all rows of its own."""
    wholes = F.array(*[
        F.struct(F.get("cell", F.lit(x))["cost"].alias("cost"), F.get("cell", F.lit(x))["audit"].alias("audit"), F.lit(x).alias("symbol")) for x in WHOLE
    ])
    best = F.array_min(F.filter(wholes, lambda w: w["cost"].isNotNull()))
    found = cells.withColumn("best", best)
    return found.select("conv", "at", *_COUNTS, "best.cost", "best.audit", "best.symbol")


def parse_all(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(per conversation its counts, cost and audit; per block cell its symbol in the least derivation).

    Conversations of one cell are done. The cells of the others are combined in rounds of 64, as many
    as the longest needs, and their symbols come down the same way; each round is stored.
    """
    n_cells = leaves.groupBy("conv").agg(F.count(F.lit(1)).alias("n"))
    long = staged(n_cells.where("n > 1").select("conv"), "repair-long")
    if long.isEmpty():
        roots = staged(_roots(leaves), "repair-roots")
        return roots, roots.select("at", "symbol")
    roots = _roots(null_safe_join(leaves, long, ["conv"], "left_anti"))
    cells, rounds, shift = null_safe_join(leaves, long, ["conv"], "left_semi"), [], BLOCK.bit_length() - 1
    while not rounds or not rounds[-1].groupBy("conv").count().where("count > 1").isEmpty():
        shift += FAN.bit_length() - 1
        cells = staged(_round(cells, shift), "repair-round")
        rounds.append(cells)
    roots = staged(roots.unionByName(_roots(cells)), "repair-roots")
    symbols = roots.select("at", "symbol")

    def down(rows: Iterator[dict]) -> Iterator[dict]:
        for row in rows:
            parts = row["parts"]
            for part, symbol in zip(parts, chosen([_unpacked(p["cell"]) for p in parts], row["symbol"])):
                yield {"at": part["at"], "symbol": symbol}

    alone = symbols.join(rounds[-1].select("at"), "at", "left_anti")
    for cells in reversed(rounds):
        symbols = staged(_mapped(cells.select("at", "parts").join(symbols, "at"), down, "at long, symbol int"), "repair-symbols")
    return roots, alone.unionByName(symbols)


def _edits(leaves: DataFrame, symbols: DataFrame) -> DataFrame:
    """(pos, nth, edit, initial) of every row that the repaired conversations have."""

    def edited(rows: Iterator[dict]) -> Iterator[dict]:
        for row in rows:
            audit = row["cell"][row["symbol"]]["audit"]
            ends = iter(accumulate(row["copies"]))
            pos, end, seen = row["at"], next(ends), 0
            for nth, (edit, initial) in enumerate(applied(row["symbol"], audit)):
                if edit != "I":
                    if seen == end:
                        pos, end = pos + 1, next(ends)
                    seen += 1
                if edit != "D":
                    yield {"pos": pos, "nth": nth, "edit": edit, "initial": initial}

    with_symbols = leaves.select("at", "cell", "copies").join(symbols, "at")
    return _mapped(with_symbols, edited, "pos long, nth int, edit string, initial string")


@dataclass(frozen=True)
class Repaired:
    """``report``: a row per conversation with rows (conv, gaps, faults, illegal, cost, audit).
    ``rows``: the repaired conversations (conv, pos, nth, turn, edit, role, text), sorted by pos and nth;
    an inserted row has the turn of a row beside it."""

    report: DataFrame
    rows: DataFrame


def repair(rows: DataFrame, costs: Costs = Costs()) -> Repaired:
    """The cheapest repair of every conversation of (conv, turn, role, text), see ``clean_rows``.

    The first fault of each row counts: blank, duplicate, truncated. Blank rows and duplicates must
    go; a truncated row that stays costs extra. A role counts by its first letter, so a row of an
    empty or unknown role can't be kept as it is. A null conversation is one of its own, null turns
    come first, rows of equal turn stand by role and text, and repeated rows are duplicates
    of the first. Conversations and texts may have any length: only the audit, one letter per row, is
    ever together. A table without rows has no conversations. Columns beyond the four are not
    looked at.
    """
    prepare(rows.sparkSession)
    ordered = sorted_rows(rows)
    faults = staged(with_faults(ordered), "repair-faults")
    leaves = staged(block_cells(faults, costs), "repair-cells")
    roots, symbols = parse_all(leaves)
    turns = faults.groupBy("conv", "turn").agg(F.lit(1).alias("one")).groupBy("conv")
    gaps = turns.agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"))
    report = null_safe_join(roots.drop("at", "symbol"), gaps, ["conv"])
    edits = _edits(leaves, symbols).join(ordered.select("conv", "pos", "turn", "role", "text"), "pos")
    role = F.when(F.col("edit") == "K", F.col("role")).when(F.col("initial") == "u", ROLES["u"]).otherwise(ROLES["a"])
    text = F.when(F.col("edit") == "I", "").otherwise(F.col("text"))
    return Repaired(report, edits.select("conv", "pos", "nth", "turn", "edit", role.alias("role"), text.alias("text")))


def digests(rows: DataFrame) -> DataFrame:
    """(conv, sha256) of the ``role:text`` lines of each repaired conversation.

    A digest has to read its conversation in order, so the lines of one pass one task; they stream
    through it, sorted on disk if need be, and none are held.
    """

    def hashed(lines: Iterator[dict]) -> Iterator[dict]:
        for conv, own in groupby(lines, lambda r: r["conv"]):
            digest = hashlib.sha256()
            for i, line in enumerate(own):
                digest.update((("\n" if i else "") + line["line"]).encode())
            yield {"conv": conv, "sha256": digest.hexdigest()}

    lines = rows.select("conv", "pos", "nth", F.concat_ws(":", "role", "text").alias("line"))
    dealt = lines.repartition("conv").sortWithinPartitions("conv", "pos", "nth").select("conv", "line")
    return _mapped(dealt, hashed, f"conv {dict(rows.dtypes)['conv']}, sha256 string")


def audit_conversations(conversations: DataFrame, rows: DataFrame, costs: Costs = Costs(), key: str = "conv_id") -> DataFrame:
    """One row for every conversation of the table, of which ``rows`` are to be repaired; those without
    any have zeros, an empty audit and the digest of nothing."""
    repaired = repair(rows, costs)
    every = conversations.select(F.col(key).alias("conv")).distinct()
    found = null_safe_join(every, repaired.report, ["conv"], "left")
    found = null_safe_join(found, digests(repaired.rows), ["conv"], "left")
    numbers = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = hashlib.sha256().hexdigest()
    return found.select(
        F.col("conv").alias(key), *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.lit(empty)).alias("repaired_sha256")
    )
