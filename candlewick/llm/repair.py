"""Conversation structure repair by rank-convergence parallel Viterbi.

A conversation is to read, by the initials of its roles, `(s?(ua)+)?`. Its rows, in order, may be kept (cost 0), given the role
user or assistant (2) or deleted (3); empty user and assistant rows may be inserted anywhere (2). Blank rows and repeats of an
earlier row have to go; a truncated row that stays costs 1 more. Of the cheapest repairs the one whose audit, the initials of
its edits in order, is least in ASCII is taken.

The automaton has four states (nothing yet, after system, after user, after assistant), so the cheapest cost of repairing the rest
of a conversation is a vector of four numbers, built from the end backwards. Only differences inside the vector matter to the
rows before; there are few such vectors, so steps are remembered. Rows that have to go add the same to all four and are only
counted.

Rows are sorted by conversation and turn over range partitions, so a long conversation spreads over many. Each partition packs
its rows into chunks of at most `CHUNK` rows and runs backwards through them, its last conversation starting from a speculative
vector if it goes on in the next partition. Fix-up passes run those partitions again whose vector turned out otherwise, by more
than a constant, until none is left; mostly one is enough, as vectors forget where they began. The driver sees one row of small
numbers for each partition, never a row for each conversation. With the vectors stitched, each partition traces its rows
forwards: of the edits that keep the cost the first letter is taken. Which state a partition begins in follows from the four
end states of those before it.

Texts stay where they are read until the edits are known; rows are named by conversation, turn and the 128-bit digest of role and
text, and equal rows are one row with a count, summed before the shuffle. A task holds about 40 bytes for each row of its range.

Defined cases: a null role or text is one space; a null conv_id is a conversation of its own; null turns come first; rows of one
turn are ordered by role, text (16 and 32 code points of them) and digest; a role without an s, u or a in front (an empty one
too) can only be changed or deleted; gaps beyond 64 bits are the greatest long; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from candlewick.llm.common import remainder_of, stored, table

CHUNK = 4096
SPACE = " \t\n\x0b\x0c\r"
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
INITIALS = "sua"
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: The state after an inserted row, and after a kept one: the only role that may follow, but for a system row in front.
FORCED = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
KEPT = {(START, 0): SYSTEM, (START, 1): USER, (SYSTEM, 1): USER, (USER, 2): ASSISTANT, (ASSISTANT, 1): USER}
LEGAL = {(0, 1), (1, 2), (2, 1)}
FAR = 1 << 40
GREATEST = (1 << 63) - 1
Vector = tuple[int, int, int, int]


def _closed(costs: list[int]) -> list[int]:
    """Costs that allow for insertions first."""
    for _ in range(3):
        costs = [min(cost, INSERT + costs[FORCED[state]]) for state, cost in enumerate(costs)]
    return costs


class Steps:
    """Backward steps and forward traces over one live row, remembered. A symbol is the class of the initial (3: another) plus 4 if truncated."""

    END: Vector = tuple(_closed([0, FAR, FAR, 0]))

    def __init__(self):
        self.back_of: dict[tuple[Vector, int], Vector] = {}
        self.trace_of: dict[tuple[Vector, int, int], tuple[str, int, int, tuple[int, ...], int]] = {}

    @staticmethod
    def _costs(after: Vector, symbol: int) -> list[int]:
        cut, role = (TRUNCATED if symbol & 4 else 0), symbol & 3
        costs = []
        for state in range(4):
            some = [DELETE + after[state], REROLE + cut + after[FORCED[state]]]
            if (state, role) in KEPT:
                some.append(cut + after[KEPT[state, role]])
            costs.append(min(some))
        return _closed(costs)

    def back(self, after: Vector, symbol: int) -> Vector:
        """The vector before the row, less its least number."""
        found = self.back_of.get((after, symbol))
        if found is None:
            costs = self._costs(after, symbol)
            found = self.back_of[after, symbol] = tuple(x - min(costs) for x in costs)
        return found

    def trace(self, after: Vector, symbol: int, state: int) -> tuple[str, int, int, tuple[int, ...], int]:
        """Edits from `state` over the row: their initials, the state then, their cost, the states after inserted rows, and the
        state after the row's own (-1: deleted, -2: kept as it is)."""
        key = (after, symbol, state)
        if key not in self.trace_of:
            costs, cut, role = self._costs(after, symbol), (TRUNCATED if symbol & 4 else 0), symbol & 3
            edits, spent, inserted = "", 0, []
            while True:
                if costs[state] == DELETE + after[state]:
                    out = (edits + "D", state, spent + DELETE, tuple(inserted), -1)
                elif costs[state] == INSERT + costs[FORCED[state]]:
                    state = FORCED[state]
                    edits, spent = edits + "I", spent + INSERT
                    inserted.append(state)
                    continue
                elif (state, role) in KEPT and costs[state] == cut + after[KEPT[state, role]]:
                    out = (edits + "K", KEPT[state, role], spent + cut, tuple(inserted), -2)
                else:
                    out = (edits + "R", FORCED[state], spent + REROLE + cut, tuple(inserted), FORCED[state])
                break
            self.trace_of[key] = out
        return self.trace_of[key]

    def close(self, state: int) -> list[int]:
        """States after the rows inserted at the end."""
        out = []
        while state not in (START, ASSISTANT):
            state = FORCED[state]
            out.append(state)
        return out


def marked(turns: DataFrame) -> DataFrame:
    """The rows of `turns` that repair looks at: c, c_null, t, t_null (ids without nulls), role, text and `key`, the digest of both."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    plain = turns.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("c"), F.col("conv_id").isNull().alias("c_null"),
        F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("t"), F.col("turn").isNull().alias("t_null"), space("role"), space("text"))
    return plain.withColumn("key", F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))))


def faulty(rows: DataFrame) -> DataFrame:
    """One row for each distinct (conversation, turn, key) of `marked`, without texts: n copies, `initial`, `end` and `later`.

    `end` is 0, 1 for a truncated and 2 for a blank text; `later` tells a repeat of a row of an earlier turn.
    """
    tail = F.rtrim("text", F.lit(SPACE))
    end = F.when(tail == "", 2).when(F.right(tail, F.lit(1)).isin(".", "!", "?"), 0).otherwise(1)
    initial = F.instr(F.lit(INITIALS), F.substring("role", 1, 1))
    initial = F.when((F.col("role") == "") | (initial == 0), 3).otherwise(initial - 1)
    tie = F.concat(F.substring("role", 1, 16), F.lit("\0"), F.substring("text", 1, 32))
    narrow = stored(rows.groupBy("c", "c_null", "t", "t_null", tie.alias("tie"), "key", initial.alias("initial"), end.alias("end")).agg(
        F.count(F.lit(1)).alias("n")), "repair-rows")
    first = F.min(F.struct(~F.col("t_null"), "t")).alias("first")
    several = narrow.groupBy("c", "c_null", "key").agg(first, F.count(F.lit(1)).alias("turns")).where("turns > 1").drop("turns")
    return narrow.join(several, ["c", "c_null", "key"], "left").withColumn(
        "later", F.coalesce(F.col("first") < F.struct(~F.col("t_null"), "t"), F.lit(False))).drop("first")


_CHUNKS = ("part int, seq int, c long, c_null boolean, symbols binary, gaps array<long>, tail long, illegal long, first int, last int, "
           "turns array<long>, turn_nulls array<boolean>, keys array<binary>")


def _chunks(rows: DataFrame, chunk: int) -> DataFrame:
    """Chunks of each range partition, in order of (part, seq): the live rows, and how many rows that have to go lie between them."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, seq, at, now, last = TaskContext.get().partitionId(), 0, None, None, None

        def done() -> tuple:
            symbols, gaps, since, illegal, first, turns, nulls, keys = now
            return (part, seq, *at, bytes(symbols), gaps, since, illegal, first, last, turns, nulls, keys)

        for batch in batches:
            out = []
            for c, c_null, t, t_null, key, initial, end, n, later in zip(*(batch[x].tolist() for x in batch.columns)):
                if at != (c, c_null) or len(now[0]) >= chunk:
                    if now is not None:
                        out.append(done())
                        seq += 1
                    if at != (c, c_null):
                        at, last = (c, c_null), None
                    now = [bytearray(), [], 0, 0, initial, [], [], []]
                now[3] += n - 1 + (last is not None and (last, initial) not in LEGAL)
                last = initial
                if later or end == 2:
                    now[2] += n
                    continue
                now[0].append(initial + 4 * end)
                now[1].append(now[2])
                now[2] = n - 1
                now[5].append(t)
                now[6].append(t_null)
                now[7].append(key)
            if out:
                yield pd.DataFrame(out, columns=[x.split()[0] for x in _CHUNKS.split(", ")])
        if now is not None:
            yield pd.DataFrame([done()], columns=[x.split()[0] for x in _CHUNKS.split(", ")])

    order = [F.col("c_null").desc(), F.col("c"), F.col("t_null").desc(), F.col("t"), F.col("tie"), F.col("key")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(ranged.select("c", "c_null", "t", "t_null", "key", "initial", "end", "n", "later").mapInPandas(pack, _CHUNKS), "repair-chunks")


def _runs(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, list]]:
    """The chunks of one partition after another."""
    part, held = None, []
    for batch in batches:
        for row in batch.itertuples(index=False):
            if row.part != part and held:
                yield part, held
                held = []
            part = row.part
            held.append(row)
    if held:
        yield part, held


def _ends(steps: Steps, chunks: list, vector: Vector) -> list[Vector]:
    """The vector after each chunk; the last conversation's rest has `vector`. The vector before the first chunk is put in front."""
    out, at = [], None
    for row in reversed(chunks):
        if at is not None and at != (row.c, row.c_null):
            vector = Steps.END
        at = row.c, row.c_null
        out.append(vector)
        for symbol in reversed(row.symbols):
            vector = steps.back(vector, symbol)
    return [vector, *reversed(out)]


def _traced(steps: Steps, row, after: Vector, state: int, closes: bool) -> tuple[str, int, int, list[int], list[int]]:
    """A chunk's audit, the state behind it, its cost; for each row that stays its place in the chunk (-1: inserted) and the state
    after it (-2: role as it was)."""
    vectors = [after]
    for symbol in reversed(row.symbols[1:]):
        vectors.append(steps.back(vectors[-1], symbol))
    audit, cost, places, states = [], 0, [], []
    for place, (symbol, gap, vector) in enumerate(zip(row.symbols, row.gaps, reversed(vectors))):
        edits, state, spent, inserted, own = steps.trace(vector, symbol, state)
        audit.append("D" * gap + edits)
        cost += gap * DELETE + spent
        places += [-1] * len(inserted)
        states += inserted
        if own != -1:
            places.append(place)
            states.append(own)
    audit.append("D" * row.tail)
    cost += row.tail * DELETE
    if closes:
        more = steps.close(state)
        audit.append("I" * len(more))
        cost += INSERT * len(more)
        places += [-1] * len(more)
        states += more
    return "".join(audit), state, cost, places, states


class _Seams:
    """What the driver knows of the partitions: one row of small numbers for each, in order."""

    def __init__(self, chunks: DataFrame):
        ends = chunks.groupBy("part").agg(
            F.min_by(F.struct("c", "c_null", "first"), "seq").alias("head"), F.max_by(F.struct("c", "c_null", "last"), "seq").alias("foot"))
        rows = sorted(ends.collect(), key=lambda x: x["part"])
        self.parts = [x["part"] for x in rows]
        conv = lambda x: (x["c"], x["c_null"])
        #: of each partition that goes on in the next one, that one
        self.next = {a["part"]: b["part"] for a, b in zip(rows, rows[1:]) if conv(a["foot"]) == conv(b["head"])}
        #: adjacent roles that meet at a seam and may not
        self.illegal = {b["part"]: int((a["foot"]["last"], b["head"]["first"]) not in LEGAL)
                        for a, b in zip(rows, rows[1:]) if a["part"] in self.next}


def _vectors(chunks: DataFrame, seams: _Seams) -> dict[int, Vector]:
    """The vector behind each partition that goes on in the next: speculative first, put right by fix-up passes."""
    vectors, before = {part: Steps.END for part in seams.next}, {}
    wrong = [part for part in seams.parts if part in seams.next or part in seams.next.values()]
    previous = {after: part for part, after in seams.next.items()}
    while wrong:
        given = {part: vectors.get(part, Steps.END) for part in wrong}

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            steps = Steps()
            for part, rows in _runs(batches):
                yield pd.DataFrame({"part": [part], "vector": [list(_ends(steps, rows, given[part])[0])]})

        some = chunks.where(F.col("part").isin(wrong)) if len(wrong) < len(seams.parts) else chunks
        found = some.select("part", "seq", "c", "c_null", "symbols").repartition("part").sortWithinPartitions("part", "seq").mapInPandas(
            run, "part int, vector array<long>")
        before |= {x["part"]: tuple(x["vector"]) for x in found.collect()}
        wrong = [previous[part] for part in before if part in previous and before[part] != vectors[previous[part]]]
        vectors |= {part: before[seams.next[part]] for part in wrong}
    return vectors


def _states(chunks: DataFrame, seams: _Seams, vectors: dict[int, Vector]) -> dict[int, int]:
    """The state in which each partition begins that goes on with a conversation."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        steps = Steps()
        for part, rows in _runs(batches):
            ends = _ends(steps, rows, vectors[part])[1:]
            conv = (rows[-1].c, rows[-1].c_null)
            begin = next(i for i, row in enumerate(rows) if (row.c, row.c_null) == conv)
            out = []
            for state in range(4) if begin == 0 else (START,):
                for row, after in zip(rows[begin:], ends[begin:]):
                    state = _traced(steps, row, after, state, False)[1]
                out.append(state)
            yield pd.DataFrame({"part": [part], "states": [out if begin == 0 else out * 4]})

    if not seams.next:
        return {}
    some = chunks.where(F.col("part").isin(list(seams.next))).select("part", "seq", "c", "c_null", "symbols", "gaps", "tail")
    found = some.repartition("part").sortWithinPartitions("part", "seq").mapInPandas(run, "part int, states array<int>").collect()
    behind, states = {x["part"]: x["states"] for x in found}, {}
    for part, after in sorted(seams.next.items()):
        states[after] = behind[part][states.get(part, START)]
    return states


_TRACE = ("part int, seq int, c long, c_null boolean, audit string, cost long, illegal long, "
          "rows array<struct<t:long,t_null:boolean,key:binary,role:string>>")


def traced(chunks: DataFrame) -> DataFrame:
    """The edits of each chunk: audit, cost, illegal pairs of the rows given, and the rows that stay, in order.

    A row that stays has its turn and key, and a role if that is new; an inserted one has no key.
    """
    seams = _Seams(chunks)
    vectors = _vectors(chunks, seams)
    states = _states(chunks, seams, vectors)
    illegal = seams.illegal

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        steps = Steps()
        for part, rows in _runs(batches):
            ends, state, out = _ends(steps, rows, vectors.get(part, Steps.END))[1:], states.get(part, START), []
            for i, (row, after) in enumerate(zip(rows, ends)):
                follows = i + 1 == len(rows) and part in vectors or i + 1 < len(rows) and (
                    (row.c, row.c_null) == (rows[i + 1].c, rows[i + 1].c_null))
                audit, state, cost, places, kept = _traced(steps, row, after, state, not follows)
                lines = [
                    (row.turns[p], row.turn_nulls[p], row.keys[p], ROLES.get(s)) if p >= 0 else (0, False, None, ROLES[s])
                    for p, s in zip(places, kept)]
                out.append((part, row.seq, row.c, row.c_null, audit, cost, row.illegal + (illegal.get(part, 0) if i == 0 else 0), lines))
                state = state if follows else START
                if len(out) == 256:
                    yield pd.DataFrame(out, columns=[x.split()[0] for x in _TRACE.split(", ")])
                    out = []
            if out:
                yield pd.DataFrame(out, columns=[x.split()[0] for x in _TRACE.split(", ")])

    dealt = chunks.drop("first", "last").repartition("part").sortWithinPartitions("part", "seq")
    return stored(dealt.mapInPandas(run, _TRACE), "repair-trace")


class Repair:
    """The repair of all conversations of a table: `conversations`, one row each, and `turns`, their rows once repaired."""

    def __init__(self, turns: DataFrame, chunk: int = CHUNK):
        self.rows = marked(turns)
        self.faults = stored(faulty(self.rows), "repair-faults")
        self.trace = traced(_chunks(self.faults, chunk))

    def conversations(self) -> DataFrame:
        """(c, c_null, gaps, blank, duplicate, truncated, illegal, cost, audit) for each conversation with a row."""
        n, blank, later = F.col("n"), F.col("end") == 2, F.col("later")
        turn = F.when(~F.col("t_null"), F.col("t"))
        wide = lambda c: c.cast("decimal(20,0)")
        span = wide(F.max(turn)) - wide(F.min(turn)) + 1 - wide(F.count_distinct(turn))
        counts = self.faults.groupBy("c", "c_null").agg(
            F.coalesce(F.least(span, F.lit(GREATEST)).cast("long"), F.lit(0)).alias("gaps"),
            F.sum(F.when(blank, n).otherwise(0)).alias("blank"),
            F.sum(F.when(blank, 0).when(later, n).otherwise(n - 1)).alias("duplicate"),
            F.sum(F.when(~later & (F.col("end") == 1), 1).otherwise(0)).alias("truncated"))
        # The audit of a conversation is one value of the result; its parts are put in order there.
        audits = self.trace.groupBy("c", "c_null").agg(
            F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"),
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "seq", "audit"))), lambda x: x["audit"]), "").alias("audit"))
        return counts.join(audits, ["c", "c_null"])

    def turns(self) -> DataFrame:
        """(c, c_null, part, seq, place, role, text) of each row of the repaired conversations, in the order of part, seq, place.

        Equal rows are one before texts meet their edits, and both sides are dealt by (conversation, turn, key).
        """
        name = ["c", "c_null", "t", "t_null", "key"]
        kept = self.trace.select("c", "c_null", "part", "seq", F.posexplode("rows").alias("place", "row")).select(
            "c", "c_null", "part", "seq", "place", "row.t", "row.t_null", "row.key", F.col("row.role").alias("new"))
        texts = self.rows.groupBy(*name).agg(F.min("role").alias("role"), F.min("text").alias("text"))
        own = kept.where(F.col("key").isNotNull()).join(texts, name).select(
            "c", "c_null", "part", "seq", "place", F.coalesce("new", "role").alias("role"), "text")
        return own.union(kept.where(F.col("key").isNull()).select("c", "c_null", "part", "seq", "place", F.col("new"), F.lit("")))


def repaired_digests(turns: DataFrame) -> DataFrame:
    """(c, c_null, repaired_sha256): the digest of a conversation's `role:text` lines, each fed into it as it comes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, digest = None, None
        for batch in batches:
            out = []
            for c, c_null, role, text in zip(*(batch[x] for x in ("c", "c_null", "role", "text"))):
                if at != (c, c_null):
                    if at is not None:
                        out.append((*at, digest.hexdigest()))
                    at, digest = (c, c_null), hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            yield pd.DataFrame(out, columns=["c", "c_null", "repaired_sha256"])
        if at is not None:
            yield pd.DataFrame([(*at, digest.hexdigest())], columns=["c", "c_null", "repaired_sha256"])

    dealt = turns.repartition("c", "c_null").sortWithinPartitions("c", "c_null", "part", "seq", "place")
    return dealt.select("c", "c_null", "role", "text").mapInPandas(run, "c long, c_null boolean, repaired_sha256 string")


def damaged(turns: DataFrame) -> DataFrame:
    """`turns` with every twentieth row lost, emptied, cut off, repeated or given to the user, by the crc32 of `conv_id:turn`."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = remainder_of(F.concat(space("conv_id"), F.lit(":"), space("turn")), 20)
    rows = turns.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def damage_repaired(turns: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """One row for each conv_id of `turns`: what its damaged rows need, and the digest of their repair."""
    repair = Repair(damaged(turns), chunk)
    everyone = turns.select(F.coalesce("conv_id", F.lit(0)).cast("long").alias("c"), F.col("conv_id").isNull().alias("c_null"), "conv_id").distinct()
    found = everyone.join(repair.conversations(), ["c", "c_null"], "left").join(repaired_digests(repair.turns()), ["c", "c_null"], "left")
    number = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return found.select(
        "conv_id", *map(number, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return damage_repaired(table(spark, sf_dir, "conversations"))


def _op11_sql() -> str:
    """The contract as one recursion over each conversation's rows: the least (cost, audit, text so far) for each of four states."""
    white = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

    def least(*options: str) -> str:
        return f"list_min([{', '.join(options)}])"

    def after(state: str, cost: str, edit: str, line: str | None) -> str:
        """`state` with one more edit; NULL if it cannot be reached."""
        text = f"{state}.r" if line is None else f"CASE WHEN {state}.r IS NULL THEN {line} ELSE {state}.r || chr(10) || {line} END"
        return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}', 'r': {text}}} END"

    def insert(state: str, role: str) -> str:
        return after(state, str(INSERT), "I", f"'{role}:'")

    def stay(state: str, edit: str, cost: int, role: str, when: str) -> str:
        return f"CASE WHEN NOT must AND {when} THEN {after(state, f'({cost} + cut)', edit, role + " || ':' || text")} END"

    def change(states: str, role: str) -> list[str]:
        first = role[0]
        return [x for s in states for x in (
            stay(f"p{s}", "K", 0, "role", f"left(role, 1) = '{first}'"), stay(f"p{s}", "R", REROLE, f"'{role}'", "true"))]

    gone = [after(f"p{s}", str(DELETE), "D", None) for s in range(4)]
    user, assistant = least("p2", insert("p3", "user"), insert("p0", "user"), insert("p1", "user")), least("p3", insert("q2", "assistant"))
    step = f"""
        SELECT w.conv_id, f.i, {gone[0]} AS p0, {least(gone[1], stay('p0', 'K', 0, 'role', "left(role, 1) = 's'"))} AS p1,
               {least(gone[2], *change('013', 'user'))} AS p2, {least(gone[3], *change('2', 'assistant'))} AS p3
        FROM walk w JOIN faults f ON f.conv_id = w.conv_id AND f.i = w.i + 1"""
    names = "conv_id, i, p0, p1, q2 AS p2, q3 AS p3"
    kind = "STRUCT(c BIGINT, a VARCHAR, r VARCHAR)"
    return f"""
WITH RECURSIVE crc AS (
    SELECT list(t ORDER BY b) AS tab FROM (
        SELECT b, list_reduce(CAST([b, 0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[]),
                              lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS t FROM range(256) r(b))),
kinds AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(
                   string_split(concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' ')), ''),
                   lambda ch: CAST(ascii(ch) AS BIGINT))),
               lambda x, y: xor(x >> 8, tab[(xor(x, y) & 255) + 1])), 4294967295) % 20 AS kind
    FROM conversations, crc),
damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
           CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
    FROM kinds WHERE kind <> 0),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, rtrim(text, {white}) AS bare FROM damaged),
marked AS (
    SELECT *, bare = '' AS blank, bare <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
           coalesce(left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) || left(role, 1) NOT IN ('su', 'ua', 'au'), false) AS illegal
    FROM placed),
faults AS (
    SELECT conv_id, i, role, text, turn, blank, again, illegal, blank OR again AS must,
           CASE WHEN NOT blank AND NOT again AND right(bare, 1) NOT IN ('.', '!', '?') THEN {TRUNCATED} ELSE 0 END AS cut FROM marked),
walk AS (
    SELECT conv_id, CAST(0 AS BIGINT) AS i, CAST({{'c': 0, 'a': '', 'r': NULL}} AS {kind}) AS p0, CAST(NULL AS {kind}) AS p1,
           CAST({{'c': {INSERT}, 'a': 'I', 'r': 'user:'}} AS {kind}) AS p2,
           CAST({{'c': {2 * INSERT}, 'a': 'II', 'r': 'user:' || chr(10) || 'assistant:'}} AS {kind}) AS p3
    FROM (SELECT DISTINCT conv_id FROM faults)
    UNION ALL
    SELECT {names} FROM (SELECT *, {assistant} AS q3 FROM (SELECT *, {user} AS q2 FROM ({step})))),
figures AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
           count(*) FILTER (again) AS duplicate, sum(cut) AS truncated, count(*) FILTER (illegal) AS illegal, max(i) AS i
    FROM faults GROUP BY conv_id),
best AS (SELECT conv_id, {least('p0', 'p3')} AS b FROM walk JOIN figures USING (conv_id, i))
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(b.c, 0) AS BIGINT) AS cost, coalesce(b.a, '') AS audit,
       sha256(coalesce(b.r, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN figures USING (conv_id) LEFT JOIN best USING (conv_id)"""


OP11_SQL = _op11_sql()
