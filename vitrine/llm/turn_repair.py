"""Repair of conversations whose turns are blank, repeated, cut short or in the wrong order of roles.

The repaired roles have to read: at most one system turn, then pairs of a user
and an assistant turn, or nothing at all.  Each turn is kept (K, free), given
the role user or assistant (R) or deleted (D), and empty user or assistant
turns are inserted anywhere (I); blank and repeated turns have to be deleted,
and a turn cut short that stays costs extra.  Of all cheapest repairs the one
whose letters, the audit, come first in ASCII order is taken.

Costs come from dynamic programming over (turns read, state of the roles).
The arcs that lie on cheapest paths form a graph in which one letter leads from
a node to one other node.  Nodes are ranked by the first 1, 2, 4, ... letters of
their least path: a node's next rank is the pair of its own rank and the rank
of the node its pointer reaches, and pointers double with it.  The least path
is then read off through the doubled pointers.

A conversation of any length is cut into pieces of bounded length.  Each piece
yields the least cost from every state before it to every state after it;
running those small tables through a conversation from its end gives the costs
that each piece has to reach, its paths give a state after it for each state
before it, and running these from the start settles the path.  No task holds a
whole conversation, only one small row for each of its pieces.  The digest of
the repaired text is a running sha256, so it reads a conversation's turns as a
sorted stream in one task, holding one at a time.

Null roles and texts are one space, so a null text is blank.  Turns are taken
in ascending order, nulls first; turns of one number follow by role, by the
first 64 characters and then by a hash of their text, so repeated rows stand
side by side, and all but the first are repeated turns.  A null ``conv_id`` is
a conversation of its own.  An empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from vitrine.sources.scratch import cut_lineage

RETITLE, DELETE, INSERT, CUT_SHORT = 3, 4, 3, 3
SPACES = " \t\n\x0b\x0c\r"

#: Rows of a piece, as a power of two, and padded rows that one round of planning holds.
PIECE_BITS = 15
ROUND_ROWS = 1 << 16

# States of the repaired roles: nothing yet, after a system, a user, an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
INITIALS = "sua"
# A turn's code is 3 * (place of its initial in INITIALS, 3 for others) + fault.
SOUND, SHORT, LOST = range(3)
PAD = 12

_FAR = 1 << 40
_LETTERS = b"\0DIKR"
_D, _I, _K, _R = 1, 2, 3, 4
#: State after an inserted turn or a turn with a new role, by the state before.
_NEXT = np.array([USER, USER, ASSISTANT, USER])
#: What it costs to end a conversation in a state: the turns to insert.
_AT_END = np.array([0, 2 * INSERT, INSERT, 0], dtype=np.int64)


def _turn_costs() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """By code and state: cost of keeping, of a new role, of deleting; by code: state after keeping."""
    keep, retitle = np.full((PAD + 1, 4), _FAR), np.full((PAD + 1, 4), _FAR)
    delete, after = np.full((PAD + 1, 4), DELETE), np.zeros(PAD + 1, dtype=np.int64)
    for code in range(PAD):
        initial, fault = divmod(code, 3)
        after[code] = (SYSTEM, USER, ASSISTANT, START)[initial]
        if fault == LOST:
            continue
        extra = CUT_SHORT if fault == SHORT else 0
        retitle[code] = RETITLE + extra
        before = ((START,), (START, SYSTEM, ASSISTANT), (USER,), ())[initial]
        keep[code, list(before)] = extra
    delete[PAD] = 0
    return keep, retitle, delete, after


_KEEP, _RETITLE, _DELETE, _AFTER = _turn_costs()


def _costs(codes: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Least costs at every node: pieces x (turns + 1) x states, from the costs ``after`` the last turn."""
    pieces, turns = codes.shape
    costs = np.empty((pieces, turns + 1, 4), dtype=np.int64)
    costs[:, turns] = after
    rows = np.arange(pieces)
    for j in range(turns - 1, -1, -1):
        code, then = codes[:, j], costs[:, j + 1]
        least = np.minimum(_DELETE[code] + then, _RETITLE[code] + then[:, _NEXT])
        least = np.minimum(least, _KEEP[code] + then[rows, _AFTER[code]][:, None])
        now = costs[:, j]
        now[:, USER] = np.minimum(least[:, USER], INSERT + least[:, ASSISTANT])
        now[:, ASSISTANT] = np.minimum(least[:, ASSISTANT], INSERT + least[:, USER])
        for state in (START, SYSTEM):
            now[:, state] = np.minimum(least[:, state], INSERT + now[:, USER])
        np.minimum(now, _FAR, out=now)
    return costs


def _arcs(codes: np.ndarray, costs: np.ndarray, last: np.ndarray) -> np.ndarray:
    """For each node and letter the node that its arc on a cheapest path leads to, or -1.

    Nodes are numbered by piece, turns read and state; where a piece ends they lead to themselves (letter 0).
    """
    pieces, turns = codes.shape
    node = np.arange(pieces * (turns + 1) * 4).reshape(pieces, turns + 1, 4)
    arcs = np.full((*node.shape, len(_LETTERS)), -1, dtype=np.int64)
    now, then, ahead = costs[:, :turns], costs[:, 1:], node[:, 1:]
    kept = _AFTER[codes][:, :, None]
    for letter, price, to in (
            (_D, _DELETE[codes] + then, ahead),
            (_I, INSERT + now[:, :, _NEXT], node[:, :turns][:, :, _NEXT]),
            (_K, _KEEP[codes] + np.take_along_axis(then, kept, 2),
             np.broadcast_to(np.take_along_axis(ahead, kept, 2), now.shape)),
            (_R, _RETITLE[codes] + then[:, :, _NEXT], ahead[:, :, _NEXT])):
        arcs[:, :turns, :, letter] = np.where(price == now, to, -1)
    ends = node[:, turns]
    arcs[:, turns, :, 0] = ends
    for state in (SYSTEM, USER):  # a conversation ends with inserted turns where a pair is not whole
        arcs[last, turns, state, 0] = -1
        arcs[last, turns, state, _I] = ends[last, _NEXT[state]]
    return arcs.reshape(-1, len(_LETTERS))


def _doubled(target: np.ndarray) -> Iterator[np.ndarray]:
    """Pointers 1, 2, 4, ... letters ahead, until all stand where a piece ends."""
    while True:
        yield target
        further = target[target]
        if np.array_equal(further, target):
            return
        target = further


def ranked_paths(arcs: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """First letter of each node's least path, and the pointers 1, 2, 4, ... letters along it.

    Ranks by the first letter come from the arcs.  The least path of twice a length is the least path of that length
    and then that of the node reached, since its letters lead to no other node.  With the ranks of whole paths, each
    node takes the arc of the least letter and target.
    """
    node = np.arange(len(arcs))
    there = arcs >= 0
    rank = there.argmax(axis=1)
    for pointer in _doubled(arcs[node, rank]):
        pairs = rank * (int(rank.max()) + 1) + rank[pointer]
        rank = np.unique(pairs, return_inverse=True)[1]
    by_letter = np.arange(arcs.shape[1]) * (len(arcs) + 1) + rank[arcs]
    letter = np.where(there, by_letter, np.iinfo(np.int64).max).argmin(axis=1)
    return letter, list(_doubled(arcs[node, letter]))


def least_paths(codes: np.ndarray, begins: np.ndarray, after: np.ndarray,
                last: np.ndarray) -> tuple[list[list[str]], np.ndarray]:
    """Audits and states after the piece, of each piece (right-aligned codes) for each state before it."""
    pieces, turns = codes.shape
    letter, pointers = ranked_paths(_arcs(codes, _costs(codes, after), last))
    entries = ((np.arange(pieces) * (turns + 1) + begins)[:, None] * 4 + np.arange(4)).reshape(-1)
    path = entries[:, None]
    for pointer in pointers:
        path = np.concatenate([path, pointer[path]], axis=1)
    spelled = np.frombuffer(_LETTERS, dtype=np.uint8)[letter[path]]
    audits = [row.tobytes().rstrip(b"\0").decode() for row in spelled]
    ends = pointers[-1][path[:, -1]] % 4
    return [audits[i:i + 4] for i in range(0, len(audits), 4)], ends.reshape(pieces, 4)


def _rounds(codes: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pieces of like length together: their places, right-aligned codes, and where each begins."""
    lengths = np.array([len(c) for c in codes])
    order, at = np.argsort(lengths, kind="stable"), 0
    while at < len(order):
        stop = at + 1
        while stop < len(order) and (stop + 1 - at) * (lengths[order[stop]] + 1) <= ROUND_ROWS:
            stop += 1
        some = order[at:stop]
        turns = int(lengths[some].max())
        padded = np.full((len(some), turns), PAD, dtype=np.int64)
        for row, i in enumerate(some):
            padded[row, turns - lengths[i]:] = codes[i]
        yield some, padded, turns - lengths[some]
        at = stop


def _codes(batch: pa.RecordBatch) -> list[np.ndarray]:
    column = batch.column("codes")
    values, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [values[a:b] for a, b in zip(offsets, offsets[1:])]


def _with_tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each piece the least cost from every state before it to every state after it."""
    for batch in batches:
        if not batch.num_rows:
            continue
        tables = np.empty((batch.num_rows, 4, 4), dtype=np.int64)
        for some, codes, _ in _rounds(_codes(batch)):
            for state in range(4):
                only = np.where(np.arange(4) == state, 0, _FAR)
                tables[some, state] = _costs(codes, only)[:, 0]
        lists = pa.FixedSizeListArray.from_arrays(pa.array(tables.reshape(-1)), 16).cast(pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "table"])


def _run_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From each conversation's last piece to its first: the costs that a piece has to reach."""
    for batch in batches:
        out = []
        for conv_id, pieces in zip(batch.column("conv_id").to_pylist(), batch.column("pieces").to_pylist()):
            after, rows = _AT_END, []
            for piece in reversed(pieces):
                rows.append((piece["piece"], after.tolist(), not rows))
                after = (np.array(piece["table"]).reshape(4, 4) + after[:, None]).min(axis=0)
            out += [(*row, conv_id, int(after[START])) for row in rows]
        if out:
            piece, after, last, conv_id, cost = zip(*out)
            yield pa.RecordBatch.from_arrays([
                pa.array(piece, pa.int64()), pa.array(after, pa.list_(pa.int64())), pa.array(last),
                pa.array(conv_id, batch.schema.field("conv_id").type), pa.array(cost, pa.int64()),
            ], names=["piece", "after", "last", "conv_id", "cost"])


def _with_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each piece the audits and the states after it, by the state before it."""
    for batch in batches:
        if not batch.num_rows:
            continue
        after = np.array(batch.column("after").to_pylist(), dtype=np.int64)
        last = batch.column("last").to_numpy(zero_copy_only=False).astype(bool)
        audits, ends = [None] * batch.num_rows, np.empty((batch.num_rows, 4), dtype=np.int32)
        for some, codes, begins in _rounds(_codes(batch)):
            spelled, ends[some] = least_paths(codes, begins, after[some], last[some])
            for i, audit in zip(some, spelled):
                audits[i] = audit
        yield pa.RecordBatch.from_arrays([
            *(batch.column(c) for c in ("conv_id", "piece", "cost", "codes")),
            pa.array(audits, pa.list_(pa.string())), pa.array(ends.tolist(), pa.list_(pa.int32())),
        ], names=["conv_id", "piece", "cost", "codes", "audits", "ends"])


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each turn of the repaired conversation: what it is made of."""
    for batch in batches:
        out = []
        columns = (batch.column(c).to_pylist() for c in ("conv_id", "piece", "state", "audit"))
        for conv_id, piece, state, audit, codes in zip(*columns, _codes(batch)):
            turn = 0
            for seq, letter in enumerate(audit):
                if letter == "D":
                    turn += 1
                    continue
                kept = letter == "K"
                state = int(_AFTER[codes[turn]] if kept else _NEXT[state])
                role = None if kept else "user" if state == USER else "assistant"
                inserted = letter == "I"
                out.append((conv_id, piece, seq, None if inserted else piece + turn, role))
                turn += not inserted
        if out:
            conv_id, piece, seq, place, role = zip(*out)
            yield pa.RecordBatch.from_arrays([
                pa.array(conv_id, batch.schema.field("conv_id").type), pa.array(piece, pa.int64()),
                pa.array(seq, pa.int32()), pa.array(place, pa.int64()), pa.array(role, pa.string()),
            ], names=["conv_id", "piece", "seq", "place", "new_role"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each run of rows of one conversation."""
    current, digest, out = None, None, []

    def flushed(kind) -> pa.RecordBatch:
        ids, sums = zip(*out)
        return pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(sums)], names=["conv_id", "repaired_sha256"])

    kind = pa.int64()
    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for conv_id, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
            if digest is None or conv_id != current:
                if digest is not None:
                    out.append((current, digest.hexdigest()))
                current, digest = conv_id, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
        if len(out) > 10_000:
            yield flushed(kind)
            out = []
    if digest is not None:
        out.append((current, digest.hexdigest()))
        yield flushed(kind)


def _spaced(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def in_turn(turns: DataFrame, piece_bits: int = PIECE_BITS) -> tuple[DataFrame, DataFrame]:
    """Turns with their place in a table-wide order, written once; and of each place its code and block."""
    role, text = F.col("role"), F.col("text")
    stripped = F.rtrim(text, F.lit(SPACES))
    # the row number only parts rows that are equal otherwise
    order = ["conv_id", F.asc_nulls_first("turn"), "role", F.substring("text", 1, 64), "text_hash", "tie"]
    rows = (turns.select("conv_id", F.col("turn").cast("long").alias("turn"), _spaced("role").alias("role"),
                         _spaced("text").alias("text"))
            .withColumn("text_hash", F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
                                            .cast("binary"), 256))
            .withColumn("tie", F.monotonically_increasing_id())
            .repartitionByRange(*order).sortWithinPartitions(*order)
            .withColumn("place", F.monotonically_increasing_id()))
    blank = stripped == ""
    initial = F.array_position(F.array(*(F.lit(i) for i in INITIALS)), F.substring(role, 1, 1))
    rows = cut_lineage(rows.select(
        "conv_id", "turn", "role", "text", "place", "text_hash", blank.alias("blank"),
        (~blank & ~F.substring(stripped, -1, 1).isin(".", "!", "?")).alias("short"),
        F.when(initial == 0, 3).otherwise(initial - 1).cast("int").alias("initial")))
    firsts = rows.where("NOT blank").groupBy("conv_id", "text_hash").agg(F.min("place").alias("place")).select(
        "place", F.lit(True).alias("first"))
    # joined by place, so no conversation and no repeated text is a key
    lost = F.col("blank") | F.col("first").isNull()
    fault = F.when(lost, LOST).when(F.col("short"), SHORT).otherwise(SOUND)
    marked = rows.select("conv_id", "turn", "place", "blank", "short", "initial").join(firsts, "place", "left").select(
        "conv_id", "turn", "place", F.shiftright("place", piece_bits).alias("block"), "blank",
        (~F.col("blank") & F.col("first").isNull()).alias("duplicate"), (~lost & F.col("short")).alias("truncated"),
        (3 * F.col("initial") + fault).cast("byte").alias("code"))
    return rows.drop("text_hash", "blank", "short", "initial"), marked


def _pieces(marked: DataFrame) -> DataFrame:
    """One row per piece: its first place and the codes of its turns, which stand side by side."""
    held = F.array_sort(F.collect_list(F.struct("place", "code")))
    codes = F.transform(held, lambda x: x["code"])
    pairs = F.transform(F.sequence(F.lit(1), F.size("codes") - 1), lambda i: F.concat(
        _initial(F.get("codes", i - 1)), _initial(F.get("codes", i))))
    return marked.groupBy("conv_id", "block").agg(
        F.min("place").alias("piece"), codes.alias("codes"), F.sum(F.col("blank").cast("long")).alias("blank"),
        F.sum(F.col("duplicate").cast("long")).alias("duplicate"),
        F.sum(F.col("truncated").cast("long")).alias("truncated"),
    ).drop("block").withColumn("illegal", F.when(F.size("codes") > 1, F.size(F.filter(
        pairs, lambda p: ~_legal(p)))).otherwise(0).cast("long"))


def _initial(code: Column) -> Column:
    return F.substring(F.lit("sssuuuaaaooo"), code.cast("int") + 1, F.lit(1))


def _legal(pair: Column) -> Column:
    return pair.isin("su", "ua", "au")


class Repair:
    """The cheapest repair of each conversation of ``conv_id, turn, role, text``.

    ``rows`` are the repaired turns (``conv_id, piece, seq, role, text, edited``;
    sort by ``piece, seq``), ``report`` has one row per conversation with its
    faults, cost, audit and digest.
    """

    def __init__(self, turns: DataFrame, piece_bits: int = PIECE_BITS):
        kind = turns.schema["conv_id"].dataType.simpleString()
        self.turns, marked = in_turn(turns, piece_bits)
        marked = cut_lineage(marked)
        pieces = _pieces(marked)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
        pieces = cut_lineage(pieces.mapInArrow(_with_tables, f"{columns}, table array<bigint>"))

        chain = pieces.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("piece", "table"))).alias("pieces"))
        goals = chain.mapInArrow(
            _run_back, f"piece long, after array<long>, last boolean, conv_id {kind}, cost long")
        paths = cut_lineage(pieces.select("piece", "codes").join(goals, "piece").mapInArrow(
            _with_paths, f"conv_id {kind}, piece long, cost long, codes array<tinyint>, audits array<string>, ends array<int>"))

        # the state before each piece, from the first piece on
        steps = paths.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("piece", "ends"))).alias("pieces"))
        states = F.aggregate("pieces", F.array(F.lit(START)), lambda found, p: F.concat(
            found, F.array(F.get(p["ends"], F.element_at(found, -1)))))
        entries = steps.select(F.explode(F.arrays_zip("pieces.piece", states.alias("state"))).alias("e")).select(
            F.col("e.piece").alias("piece"), F.col("e.state").alias("state")).where("piece IS NOT NULL")
        self.pieces = cut_lineage(paths.join(entries, "piece").select(
            "conv_id", "piece", "cost", "codes", "state", F.get("audits", F.col("state")).alias("audit")))

        edits = self.pieces.select("conv_id", "piece", "state", "audit", "codes").mapInArrow(
            _edits, f"conv_id {kind}, piece long, seq int, place long, new_role string")
        texts = self.turns.select("place", "role", "text")
        kept = edits.where("place IS NOT NULL").join(texts, "place").select(
            "conv_id", "piece", "seq", F.coalesce("new_role", "role").alias("role"), "text",
            F.col("new_role").isNotNull().alias("edited"))
        self.rows = kept.unionByName(edits.where("place IS NULL").select(
            "conv_id", "piece", "seq", F.col("new_role").alias("role"), F.lit("").alias("text"),
            F.lit(True).alias("edited")))
        self.report = self._report(pieces, marked)

    def _report(self, pieces: DataFrame, marked: DataFrame) -> DataFrame:
        kind = self.rows.schema["conv_id"].dataType.simpleString()
        digests = (self.rows.select("conv_id", "piece", "seq", "role", "text").repartition("conv_id")
                   .sortWithinPartitions("conv_id", "piece", "seq").select("conv_id", "role", "text")
                   .mapInArrow(_digests, f"conv_id {kind}, repaired_sha256 string"))
        ends = F.array_sort(F.collect_list(F.struct(
            "piece", F.element_at("codes", 1).alias("first"), F.element_at("codes", -1).alias("last"))))
        faults = pieces.groupBy("conv_id").agg(
            F.sum("blank").alias("blank"), F.sum("duplicate").alias("duplicate"), F.sum("truncated").alias("truncated"),
            F.sum("illegal").alias("inside"), ends.alias("ends"))
        across = F.size(F.filter(F.sequence(F.lit(2), F.size("ends")), lambda i: ~_legal(F.concat(
            _initial(F.element_at("ends", i - 1)["last"]), _initial(F.element_at("ends", i)["first"])))))
        faults = faults.select("conv_id", "blank", "duplicate", "truncated", (
            F.col("inside") + F.when(F.size("ends") > 1, across).otherwise(0)).cast("long").alias("illegal"))
        audits = self.pieces.groupBy("conv_id").agg(F.max("cost").alias("cost"), F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct("piece", "audit"))), lambda x: x["audit"]), "").alias("audit"))
        turns = marked.groupBy("conv_id", "turn").agg(F.lit(1).alias("one")).groupBy("conv_id").agg(
            F.max("turn").cast("decimal(38,0)").alias("most"), F.min("turn").cast("decimal(38,0)").alias("least"),
            F.count("turn").alias("n"))
        gaps = turns.select("conv_id", F.least(F.coalesce(
            F.expr("most - least + 1 - n"), F.lit(0)), F.lit((1 << 63) - 1)).cast("long").alias("gaps"))
        report = faults
        for part in (gaps, audits, digests):
            report = _same(report, part)
        return report


def _same(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join by ``conv_id``, null being a conversation like others."""
    other = right.withColumnRenamed("conv_id", "other_id")
    return left.join(other, F.col("conv_id").eqNullSafe(F.col("other_id")), "left").drop("other_id")


def damaged(conversations: DataFrame) -> DataFrame:
    """The turns with faults made by a hash of conversation and turn, for trials of the repair.

    Of 20 remainders 0 drops a turn, 1 empties its text, 2 takes the ends of its
    sentences, 3 repeats it and 4 makes it a user's.
    """
    kind = F.crc32(F.concat(_spaced("conv_id"), F.lit(":"), _spaced("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", _spaced("role").alias("role"), _spaced("text").alias("text"),
                                kind.alias("kind")).where("kind <> 0")
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(
            F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def repair_report(turns: DataFrame, conversations: DataFrame, piece_bits: int = PIECE_BITS) -> DataFrame:
    """Faults, cost, audit and digest of every conversation named in ``conversations``; zeros without turns."""
    report = _same(conversations.select("conv_id").distinct(), Repair(turns, piece_bits).report)
    empty = hashlib.sha256().hexdigest()
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return report.select("conv_id", *(F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in numbers),
                         F.coalesce("audit", F.lit("")).alias("audit"),
                         F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))
