"""Repair of damaged conversations by cheapest edits, reconstructed by divide and conquer.

A repaired conversation has role initials ``(s?(ua)+)?``. What has been emitted so far matters by four states: nothing, s, u
and a. Going from row to row in order of turns, a row is kept (K, free), gets the role that is due (R, 1) or is deleted (D, 2;
blank and duplicate rows must be); a message of the due role without text can be inserted anywhere (I, 5); a truncated row
that stays costs 5. Wanted are the cheapest edits, and of these the ASCII-least string of their letters.

An element (a row, or a stretch of rows) is a 4 x 4 table of costs from the state before to the state after, and of ranks:
edit strings that leave one state for different ones never begin alike to the end of one of them (each row gives exactly one
of D, K and R, after its inserts), so they are ordered, and the order of joined stretches follows from that of the parts.

``crossings`` is Hirschberg's: the forward vector of four costs and ranks of the first half and the backward vector of four
costs of the second meet in the middle; of the states where they add up to least the one with the least rank is crossed, and
both halves are solved alike. Memory is linear in the rows; all stretches of a level advance together, as numpy rows.

A conversation may hold any share of all rows. Rows, without their texts, are sorted by range, so it spans as many tasks as it
needs, and cut into runs of ``RUN`` rows. Each run is reduced to one element for each conversation in it; while a conversation
has several, ``FAN`` neighbours at a time are reduced to one. Then the crossings are chosen from the top down to the rows.

Edge cases: nulls become one space. A row's initial is the first character of its role, whatever follows; a row whose role
begins otherwise, or is empty, can't be kept. Turns are ordered, null turns first; rows of the same turn by a hash of role and
text. Repeated rows are duplicates. A conversation without rows after damage has none to repair. A null conv_id is a
conversation like others (its name in the damage is a space). An empty table has no conversations. Other columns are not read;
very long texts are hashed where they are read and shuffled once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescast.llm.text import runs as text_runs
from salescast.session import materialize

SPACE = r"\x20\x09-\x0D"
#: Rows of a run, and neighbours that are reduced to one at a time.
RUN, FAN = 4096, 1024
#: Bits of a row's place within its partition.
PLACE = 33
#: Copies that the duplicates of one message are dealt over.
SALT = 16

#: Beyond any cost, and small enough to be added a few times.
NEVER = 1 << 40
#: States: nothing yet, after s, after u, after a; what is due, and where an inserted message leads.
DUE = ["u", "u", "a", "u"]
INSERTED = [2, 2, 3, 2]
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: What is still due at the end.
TAIL = ["", "II", "I", ""]


def _elementary() -> tuple[np.ndarray, np.ndarray, list]:
    """Costs, ranks and letters of a row by its kind: 3 * initial (s, u, a, other) + fault (none, must go, truncated)."""
    costs, ranks = np.full((12, 4, 4), NEVER), np.tile(np.arange(4), (12, 4, 1))
    letters = [[[""] * 4 for _ in range(4)] for _ in range(12)]
    for kind in range(12):
        initial, fault = "sua-"[kind // 3], kind % 3
        for before in range(4):
            options, state = [], before
            for inserts in range(3):
                options.append((DELETE + inserts * INSERT, "I" * inserts + "D", state))
                if fault != 1:
                    stays = inserts * INSERT + TRUNCATED * (fault == 2)
                    options.append((REROLE + stays, "I" * inserts + "R", INSERTED[state]))
                    if initial == DUE[state]:
                        options.append((KEEP + stays, "I" * inserts + "K", INSERTED[state]))
                    if initial == "s" and state == 0:
                        options.append((KEEP + stays, "K", 1))
                state = INSERTED[state]
            best = [min(((c, text) for c, text, after in options if after == to), default=(NEVER, "")) for to in range(4)]
            order = sorted(range(4), key=lambda to: (best[to][0] == NEVER, best[to][1]))
            for to in range(4):
                costs[kind, before, to], letters[kind][before][to] = best[to]
                ranks[kind, before, to] = order.index(to)
    return costs, ranks, letters


COSTS, RANKS, LETTERS = _elementary()


def _advance(cost: np.ndarray, rank: np.ndarray, costs: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward vectors (n, 4) one element further: least costs, then least strings; and the ranks of these strings."""
    choice = (cost[:, :, None] + costs) * 4 + rank[:, :, None]
    best = choice.argmin(axis=1)
    after = np.take_along_axis(choice, best[:, None, :], 1)[:, 0]
    own = np.take_along_axis(ranks, best[:, None, :], 1)[:, 0]
    key = np.where(after // 4 >= NEVER, 1 << 20, 0) + (after % 4) * 4 + own
    key = key * 4 + np.arange(4)
    return np.minimum(after // 4, NEVER), (key[:, :, None] > key[:, None, :]).sum(axis=2)


def reduce_elements(costs: np.ndarray, ranks: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One element for each stretch; ``first[i]`` to ``first[i + 1]`` are the elements of stretch i."""
    sizes = np.diff(first)
    cost = np.full((len(sizes), 4, 4), NEVER)
    cost[:, np.arange(4), np.arange(4)] = 0
    rank = np.tile(np.arange(4), (len(sizes), 4, 1))
    for step in range(int(sizes.max(initial=0))):
        on = np.flatnonzero(sizes > step)
        at = np.repeat(first[on] + step, 4)
        c, r = _advance(cost[on].reshape(-1, 4), rank[on].reshape(-1, 4), costs[at], ranks[at])
        cost[on], rank[on] = c.reshape(-1, 4, 4), r.reshape(-1, 4, 4)
    return cost, rank


def crossings(costs: np.ndarray, ranks: np.ndarray, first: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The state before each element (and, last, after a stretch's last one) on the least path from ``begin`` to ``end``.

    Stretch i has its ``first[i + 1] - first[i] + 1`` states from place ``first[i] + i`` on.
    """
    out = np.zeros(first[-1] + len(first) - 1, np.int64)
    stretch = np.arange(len(first) - 1)
    out[first[:-1] + stretch], out[first[1:] + stretch] = begin, end
    low, high, shift, a, z = first[:-1], first[1:], stretch, begin, end
    while True:
        on = high - low > 1
        low, high, shift, a, z = (x[on] for x in (low, high, shift, a, z))
        if not len(low):
            return out
        middle = (low + high) // 2
        cost = np.full((len(low), 4), NEVER)
        cost[np.arange(len(low)), a] = 0
        rank = np.tile(np.arange(4), (len(low), 1))
        for step in range(int((middle - low).max())):
            still = np.flatnonzero(low + step < middle)
            at = low[still] + step
            cost[still], rank[still] = _advance(cost[still], rank[still], costs[at], ranks[at])
        back = np.full((len(low), 4), NEVER)
        back[np.arange(len(low)), z] = 0
        for step in range(int((high - middle).max())):
            still = np.flatnonzero(high - 1 - step >= middle)
            back[still] = np.minimum((costs[high[still] - 1 - step] + back[still][:, None, :]).min(axis=2), NEVER)
        meet = ((cost + back) * 4 + rank).argmin(axis=1)
        out[middle + shift] = meet
        low, high = np.concatenate([low, middle]), np.concatenate([middle, high])
        shift, a, z = np.concatenate([shift, shift]), np.concatenate([a, meet]), np.concatenate([meet, z])


# Rows -----------------------------------------------------------------------------------------------------


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text): rows dropped, emptied, cut, repeated or given the role user, by a sum of id and turn."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", shown("conv_id"), shown("turn"))) % 20
    rows = conversations.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), kind.alias("kind"))
    rows = rows.where("kind != 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    return rows.drop("copy")


def with_message(rows: DataFrame) -> DataFrame:
    """Adds ``message``, a hash of role and text."""
    return rows.withColumn("message", F.unhex(F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256)))


def placed(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, message, initial, blank, cut, place, part) of ``rows``, by ``place`` in order of conversation and turn.

    Sorted by range: a conversation is a piece of one part, or the end of one, whole parts, and the beginning of another. The
    last key deals out equal rows, whose order says nothing.
    """
    narrow = with_message(rows).select(
        "conv_id", "turn", "message", F.substring("role", 1, 1).alias("initial"), (~F.col("text").rlike(f"[^{SPACE}]")).alias("blank"),
        F.col("text").rlike(rf"[^.!?{SPACE}][{SPACE}]*+\z").alias("cut"), F.xxhash64(F.monotonically_increasing_id()).alias("deal"))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "message", "deal"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = (narrow.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("deal")
           .withColumn("place", F.monotonically_increasing_id()))
    return materialize(out, "placed").withColumn("part", F.shiftright("place", PLACE))


def faults(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, message, place, initial, fault) of placed rows: 0 none, 1 blank, 2 duplicate, 3 truncated.

    The first place of each message found twice or more is a combinable aggregate; a common message is dealt out for the join.
    """
    first = rows.where("not blank").groupBy("conv_id", "message").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    first = first.where("n > 1").select(F.col("conv_id").alias("of"), F.col("message").alias("said"), "first",
                                        F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"))
    salt = (F.col("place") % SALT).cast("int")
    joined = rows.join(first, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("message") == F.col("said")) & (salt == F.col("salt")), "left")
    fault = F.when(F.col("blank"), 1).when(F.col("place") > F.col("first"), 2).when(F.col("cut"), 3).otherwise(0)
    return joined.select("conv_id", "turn", "message", "place", "initial", fault.alias("fault"))


def _kinds(initial: pa.Array, fault: np.ndarray) -> np.ndarray:
    letter = np.array(["sua".find(c) if c else -1 for c in initial.to_pylist()])
    return np.where(letter < 0, 3, letter) * 3 + np.array([0, 1, 1, 2])[fault]


def _stretches(column: pa.Array) -> np.ndarray:
    """Where a new conversation begins in sorted rows, with the end as last."""
    ids = column.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.flatnonzero(np.diff(ids)) + 1, [len(ids)]])


def _legal(before: str, after: str) -> bool:
    return before + after in ("su", "ua", "au")


ELEMENT = "conv_id {id}, block bigint, blocks bigint, first string, last string, illegal bigint, costs array<bigint>, ranks array<bigint>"


def _element_rows(ids: pa.Array, block: pa.Array, blocks: list[int | None], first: pa.Array, last: pa.Array, illegal: np.ndarray,
                  costs: np.ndarray, ranks: np.ndarray) -> pa.Table:
    at = pa.array(np.arange(len(ids) + 1, dtype=np.int32) * 16)
    lists = [pa.ListArray.from_arrays(at, pa.array(x.ravel().astype(np.int64))) for x in (costs, ranks)]
    return pa.table({"conv_id": ids, "block": block, "blocks": pa.array(blocks, pa.int64()), "first": first, "last": last,
                     "illegal": pa.array(illegal.astype(np.int64)), "costs": lists[0], "ranks": lists[1]})


def _tables(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, 4, 4)


def _whole(table: pa.Table, *order: str) -> pa.Table:
    return table.sort_by([(c, "ascending") for c in order]).combine_chunks()


def _reduced_runs(rows: DataFrame, id_type: str) -> DataFrame:
    """An element for each conversation and run of rows (conv_id, place, run, initial, fault)."""

    def join(table: pa.Table) -> pa.Table:
        table = _whole(table, "place")
        initial = table["initial"].combine_chunks()
        first = _stretches(table["conv_id"].combine_chunks())
        kinds = _kinds(initial, table["fault"].to_numpy())
        costs, ranks = reduce_elements(COSTS[kinds], RANKS[kinds], first)
        letters = initial.to_pylist()
        bad = np.cumsum([0, *(not _legal(*pair) for pair in zip(letters, letters[1:]))])
        begin, end = pa.array(first[:-1]), pa.array(first[1:] - 1)
        block = table["run"].combine_chunks().take(begin)  # numbered within the conversation, and counted, later
        return _element_rows(table["conv_id"].combine_chunks().take(begin), block, [None] * len(begin), initial.take(begin), initial.take(end),
                             bad[first[1:] - 1] - bad[first[:-1]], costs, ranks)

    return rows.groupBy("run").applyInArrow(join, ELEMENT.format(id=id_type))


def _dense(elements: DataFrame) -> DataFrame:
    """``block`` numbered from 0 within each conversation, ``blocks`` their number; ``run`` is what ``block`` was.

    Runs of a conversation follow each other within a part, so only (conversation, part) pairs are put in order.
    """
    part = F.shiftright("block", PLACE - int(np.log2(RUN)))
    own = elements.withColumn("part", part)
    pieces = own.groupBy("conv_id", "part").agg(F.min("block").alias("least"), F.count(F.lit(1)).alias("size"))
    whole = Window.partitionBy("conv_id")
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select(F.col("conv_id").alias("of"), F.col("part").alias("in_part"), "least",
                           F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"), F.sum("size").over(whole).alias("all"))
    joined = own.join(pieces, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("part") == F.col("in_part")))
    return joined.select("conv_id", (F.col("before") + F.col("block") - F.col("least")).alias("block"), F.col("block").alias("run"),
                         F.col("all").alias("blocks"), "first", "last", "illegal", "costs", "ranks")


def _reduced(elements: DataFrame, id_type: str) -> DataFrame:
    """Of each conversation, one element for ``FAN`` neighbours."""

    def join(table: pa.Table) -> pa.Table:
        table = _whole(table, "block")
        n = np.array([0, table.num_rows])
        costs, ranks = reduce_elements(_tables(table["costs"]), _tables(table["ranks"]), n)
        first, last = table["first"].to_pylist(), table["last"].to_pylist()
        illegal = sum(table["illegal"].to_pylist()) + sum(not _legal(*pair) for pair in zip(last, first[1:]))
        return _element_rows(table["conv_id"].combine_chunks().slice(0, 1), pa.array([table["block"][0].as_py() // FAN]), [(table["blocks"][0].as_py() - 1) // FAN + 1],
                             pa.array(first[:1], pa.string()), pa.array(last[-1:], pa.string()), np.array([illegal]), costs, ranks)

    grouped = elements.withColumn("above", F.expr(f"block div {FAN}")).groupBy("conv_id", "above")
    return grouped.applyInArrow(join, ELEMENT.format(id=id_type))


STATE = "conv_id {id}, block bigint, before bigint, after bigint"


def _descend(elements: DataFrame, states: DataFrame, id_type: str) -> DataFrame:
    """The states before and after each element, from those of the stretches of ``FAN`` that hold them."""

    def cross(table: pa.Table) -> pa.Table:
        table = _whole(table, "block")
        n = np.array([0, table.num_rows])
        begin, end = (np.array([table[c][0].as_py()]) for c in ("before", "after"))
        found = crossings(_tables(table["costs"]), _tables(table["ranks"]), n, begin, end)
        return pa.table({"conv_id": table["conv_id"], "block": table["block"], "before": pa.array(found[:-1]), "after": pa.array(found[1:])})

    above = states.select(F.col("conv_id").alias("of"), F.col("block").alias("above"), "before", "after")
    joined = elements.select("conv_id", "block", "costs", "ranks", F.expr(f"block div {FAN}").alias("own")).join(
        above, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("own") == F.col("above")))
    return joined.drop("of", "own").groupBy("conv_id", "above").applyInArrow(cross, STATE.format(id=id_type))


def _finish(elements: DataFrame, id_type: str) -> DataFrame:
    """Of conversations reduced to one element: cost, states at both ends, and what is inserted at the end."""
    schema = f"conv_id {id_type}, block bigint, before bigint, after bigint, illegal bigint, cost bigint, tail string"
    ends = np.array([INSERT * len(t) for t in TAIL])

    def end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                tables = [batch[c].flatten().to_numpy(zero_copy_only=False).reshape(-1, 4, 4)[:, 0] for c in ("costs", "ranks")]
                total = tables[0] + ends
                after = (total * 4 + tables[1]).argmin(axis=1)
                yield pa.RecordBatch.from_pydict({
                    "conv_id": batch["conv_id"], "block": batch["block"], "before": pa.array(np.zeros(len(after), np.int64)),
                    "after": pa.array(after), "illegal": batch["illegal"], "cost": pa.array(total[np.arange(len(after)), after]),
                    "tail": pa.array([TAIL[i] for i in after])})

    return elements.mapInArrow(end, schema)


def _edited(rows: DataFrame, states: DataFrame, id_type: str) -> DataFrame:
    """The edits of each row, its inserts first, and the state before them."""

    def choose(left: pa.Table, right: pa.Table) -> pa.Table:
        left, right = _whole(left, "place"), _whole(right, "least")
        kinds = _kinds(left["initial"].combine_chunks(), left["fault"].to_numpy())
        first = np.concatenate([np.searchsorted(left["place"].to_numpy(), right["least"].to_numpy()), [left.num_rows]])
        found = crossings(COSTS[kinds], RANKS[kinds], first, right["before"].to_numpy(), right["after"].to_numpy())
        own = np.arange(left.num_rows) + np.repeat(np.arange(len(first) - 1), np.diff(first))
        states = zip(kinds.tolist(), found[own].tolist(), found[own + 1].tolist())
        return left.select(["conv_id", "turn", "message", "place"]).append_column(
            "letters", pa.array([LETTERS[k][a][z] for k, a, z in states], pa.string())).append_column("before", pa.array(found[own]))

    turn = rows.schema["turn"].dataType.simpleString()
    schema = f"conv_id {id_type}, turn {turn}, message binary, place bigint, letters string, before bigint"
    return rows.groupBy("run").cogroup(states.groupBy("run")).applyInArrow(choose, schema)


@dataclass(frozen=True)
class Repaired:
    """Of each conversation its counts, cost, and what is inserted at its end; of each row its edits; and the rows themselves.

    ``summary``: conv_id, gaps, blank, duplicate, truncated, illegal, cost, tail, state. ``edits``: conv_id, turn, message, place,
    letters (a row's edits, with the inserts before it) and before (the state before these). ``texts``: conv_id, turn, message,
    role, text. Equal rows have the same message, so that edits find their text by it.
    """

    summary: DataFrame
    edits: DataFrame
    texts: DataFrame

    def messages(self) -> DataFrame:
        """(conv_id, place, number, role, text): the repaired conversations, in order of place and number."""

        @F.arrow_udf("array<struct<role: string, text: string>>")
        def apply(letters: pa.Array, before: pa.Array, role: pa.Array, text: pa.Array) -> pa.Array:
            rows = zip(*(c.to_pylist() for c in (letters, before, role, text)))
            kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
            return pa.array([[{"role": r, "text": t} for r, t in edited(*row)] for row in rows], kind)

        texts = self.texts.dropDuplicates(["conv_id", "turn", "message"])
        texts = texts.select(F.col("conv_id").alias("of"), F.col("turn").alias("at"), F.col("message").alias("said"), "role", "text")
        rows = self.edits.where("letters != 'D'").join(texts, F.col("conv_id").eqNullSafe(F.col("of")) & F.col("turn").eqNullSafe(
            F.col("at")) & (F.col("message") == F.col("said")))
        ends = self.summary.where("tail != ''").select("conv_id", F.lit((1 << 63) - 1).alias("place"), F.col("tail").alias("letters"),
                                                       F.col("state").alias("before"), F.lit("").alias("role"), F.lit("").alias("text"))
        rows = rows.select(*ends.columns).unionByName(ends)
        found = rows.select("conv_id", "place", F.posexplode(apply("letters", "before", "role", "text")).alias("number", "one"))
        return found.select("conv_id", "place", "number", "one.role", "one.text")


def repair(rows: DataFrame) -> Repaired:
    """Repair ``rows`` (conv_id, turn, role, text), of which role and text are not null."""
    id_type = rows.schema["conv_id"].dataType.simpleString()
    found = materialize(faults(placed(rows)).withColumn("run", F.expr(f"place div {RUN}")), "faults")
    runs = materialize(_reduced_runs(found, id_type), "elements")
    levels = [materialize(_dense(runs), "numbered")]
    while not (several := levels[-1].where("blocks > 1")).isEmpty():
        levels.append(materialize(_reduced(several, id_type), "elements"))
    # A conversation ends at the level where it has become one element; from there down its crossings are chosen.
    ends = materialize(reduce(DataFrame.unionByName, (_finish(x.where("blocks = 1"), id_type).withColumn("level", F.lit(k))
                                                      for k, x in enumerate(levels))), "ends")
    states = None
    for level, elements in reversed(list(enumerate(levels))):
        whole = ends.where(F.col("level") == level).select("conv_id", "block", "before", "after")
        states = whole if states is None else whole.unionByName(
            materialize(_descend(elements.where("blocks > 1"), states, id_type), "states"))
    least = found.groupBy("conv_id", "run").agg(F.min("place").alias("least"))
    in_run = levels[0].select(F.col("conv_id").alias("of"), F.col("block").alias("number"), "run")
    states = states.join(in_run, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("block") == F.col("number"))).drop("of")
    least = least.select(F.col("conv_id").alias("of"), F.col("run").alias("own"), "least")
    states = states.join(least, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("run") == F.col("own")))
    edits = materialize(_edited(found, states.select("run", "least", "before", "after"), id_type), "edits")

    counts = found.groupBy("conv_id").agg(*(
        F.count_if(F.col("fault") == k).alias(name) for k, name in ((1, "blank"), (2, "duplicate"), (3, "truncated"))))
    turns = found.groupBy("conv_id", "turn").agg(F.lit(1).alias("one"))  # a row each, so that distinct ones are only counted
    gaps = turns.groupBy("conv_id").agg(F.max("turn").alias("most"), F.min("turn").alias("least"), F.count("turn").alias("turns"))
    gaps = gaps.select(F.col("conv_id").alias("of"), F.coalesce(
        F.col("most").cast("long") - F.col("least").cast("long") + 1 - F.col("turns"), F.lit(0)).alias("gaps"))
    ends = ends.select(F.col("conv_id").alias("own"), "illegal", "cost", "tail", F.col("after").alias("state"))
    summary = (counts.join(gaps, F.col("conv_id").eqNullSafe(F.col("of"))).join(ends, F.col("conv_id").eqNullSafe(F.col("own")))
               .select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "tail", "state"))
    texts = with_message(rows).select("conv_id", "turn", "message", "role", "text")
    return Repaired(materialize(summary, "conversations"), edits, texts)


def edited(letters: str, state: int, role: str, text: str) -> list[tuple[str, str]]:
    """The messages (role, text) that a row's edits leave: those inserted before it, and itself unless it is deleted."""
    out = []
    for letter in letters:
        if letter == "D":
            continue
        due = "assistant" if DUE[state] == "a" else "user"
        out.append((role if letter == "K" else due, "" if letter == "I" else text))
        state = 1 if letter == "K" and role[0] == "s" else INSERTED[state]
    return out


def digests(conversations: DataFrame) -> DataFrame:
    """Damage and repair ``conversations``: for each conv_id the counts, the audit and a hash of its repaired messages.

    The hash of a conversation is taken over its messages in order, so these pass one task; they do so in batches, sorted, each
    hashed as it comes. ``Repaired.messages`` has no such step.
    """
    found = repair(damage(conversations))
    id_type = conversations.schema["conv_id"].dataType.simpleString()
    none = lambda kind: F.lit(None).cast(kind)
    # Of equal rows the text comes first, once or more, then the edits of all of them.
    texts = found.texts.select("conv_id", F.lit(0).alias("end"), "turn", "message", F.lit(-1).cast("long").alias("place"), "role", "text",
                               none("string").alias("letters"), none("long").alias("before"))
    edits = found.edits.select("conv_id", F.lit(0).alias("end"), "turn", "message", "place", none("string").alias("role"),
                               none("string").alias("text"), "letters", "before")
    ends = found.summary.select("conv_id", F.lit(1).alias("end"), none(found.edits.schema["turn"].dataType).alias("turn"),
                                none("binary").alias("message"), F.lit(0).cast("long").alias("place"), none("string").alias("role"),
                                none("string").alias("text"), F.col("tail").alias("letters"), F.col("state").alias("before"))
    stream = texts.unionByName(edits).unionByName(ends).repartition("conv_id").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), "end", F.col("turn").asc_nulls_first(), "message", "place")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, sha, joint, role, text = [], hashlib.sha256(), "", "", ""
        for batch in batches:
            out = []
            for part in text_runs(batch, "text", 2 << 20):
                for conv_id, end, own_role, own_text, letters, before in zip(*(c.to_pylist() for c in part.columns)):
                    if letters is None:
                        role, text = own_role, own_text
                        continue
                    audit.append(letters)
                    for r, t in edited(letters, before, role, text):
                        sha.update(f"{joint}{r}:{t}".encode())
                        joint = "\n"
                    if end:
                        out.append((conv_id, "".join(audit), sha.hexdigest()))
                        audit, sha, joint = [], hashlib.sha256(), ""
            columns = zip(*out) if out else ((), (), ())
            kinds = (batch.schema.field("conv_id").type, pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], ["conv_id", "audit", "repaired_sha256"])

    hashed = stream.select("conv_id", "end", "role", "text", "letters", "before").mapInArrow(
        digest, f"conv_id {id_type}, audit string, repaired_sha256 string")
    hashed = hashed.select(F.col("conv_id").alias("of"), "audit", "repaired_sha256")
    counts = found.summary.select(F.col("conv_id").alias("own"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    ids = conversations.select("conv_id").distinct()
    rows = ids.join(counts, F.col("conv_id").eqNullSafe(F.col("own")), "left").join(hashed, F.col("conv_id").eqNullSafe(F.col("of")), "left")
    return rows.select("conv_id", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts.columns[1:]),
                       F.coalesce("audit", F.lit("")).alias("audit"),
                       F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
