"""Repair of damaged conversations: the cheapest edits that make the roles
alternate.

A conversation is its rows by turn (nulls first; rows of one turn by role,
then text).  Every row has at most one fault, the first of these that holds:

* blank: the text has no character outside ``[\\x20\\x09-\\x0D]``;
* duplicate: an earlier row has the same role and text;
* truncated: the last such character is not one of ``.!?``.

A row is kept (K, cost 0), given the role user or assistant (R, 1) or deleted
(D, 2; blank and duplicate rows must be).  Truncated rows that stay cost 5
more.  Empty rows of the user or assistant may be inserted anywhere (I, 5).
The first characters of the remaining roles must read ``(s?(ua)+)?``; of the
cheapest edits those whose initials are ASCII-least count.

Method.  A finite automaton of four states (nothing yet, after ``s``, after
``u``, after ``a``) reads the roles, so a run of rows is a 4 x 4 table of the
cost from each state before it to each state behind it.  The states between
rows are found by Hirschberg's divide and conquer: a forward cost vector to
the middle and a backward one from the end meet there, the cheapest crossing
state is taken, and both halves are solved alike, in space linear in the rows.
Every block of edits ends with the edit of a row, so of two different edit
texts to the same row none begins with the other; a rank per state, carried
with the forward costs, therefore tells which of equally cheap crossings has
the ASCII-least edits.

Scale.  Rows are sorted by range partitions, so the rows of one conversation,
however many, lie in many tasks.  Runs of at most ``SEGMENT`` of them are
reduced to their tables; tables of ``FAN`` runs are composed to a table of the
longer run until a conversation has one; then the crossings are chosen from
the longest runs down to the rows.  Only the digest of the repaired text reads
a whole conversation in order, row by row, in constant memory.

Defined results.  Null roles and texts are taken as one space.  Rows with a
null conversation id are one conversation.  A conversation without rows has
cost 0 and no edits; an empty table gives no rows.  ``gaps`` counts the turns
missing between the smallest and the largest; null if that passes 64 bits.
Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardstat.llm.components import written
from wardstat.llm.ship import ship

SEGMENT_BITS = 12  # rows of a run: 4096 at most
FAN = 4096  # runs composed to one

# --- fixed values: costs of the edits, and what counts as what -------------------
RELABEL, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
SPACE = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
# ----------------------------------------------------------------------------------

FAULTS = ("", "truncated", "blank", "duplicate")
STATES = range(4)  # nothing yet, after s, after u, after a
_NEXT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
_TAIL = {0: (0, ""), 1: (2 * INSERT, "II"), 2: (INSERT, "I"), 3: (0, "")}  # edits behind the last row
_LEGAL = {"su", "ua", "au"}
_FAR = 1 << 60

# --- one conversation -------------------------------------------------------------
# An element is what one row or one run does: for each state before it, a tuple
# of (state behind it, cost, key), where keys order the edits from that state.


def code_of(initial: str, fault: str) -> str:
    """A row as one character: its role's initial (s, u, a or other) and fault."""
    return chr(65 + 4 * FAULTS.index(fault) + "sua?".index(initial if initial and initial in "sua" else "?"))


def _parts(code: str) -> tuple[str, str]:
    fault, initial = divmod(ord(code) - 65, 4)
    return "sua?"[initial], FAULTS[fault]


def _forward_insert(state: int) -> int:
    return _NEXT["a"].get(state) or _NEXT["u"][state]


@lru_cache(None)
def row_element(code: str) -> tuple:
    """The element of a row; its keys are the edits themselves."""
    initial, fault = _parts(code)
    stay = TRUNCATED if fault == "truncated" else 0
    out = []
    for before in STATES:
        best: dict[int, tuple[int, str]] = {}
        state, cost, text = before, 0, ""
        for _ in range(3):  # a third insertion leads to a state already seen
            moves = [(state, DELETE, "D")]
            if fault not in ("blank", "duplicate"):
                if state in _NEXT.get(initial, ()):
                    moves.append((_NEXT[initial][state], stay, "K"))
                moves += [(_NEXT[r][state], RELABEL + stay, "R") for r in "ua" if state in _NEXT[r]]
            for to, price, edit in moves:
                best[to] = min(best.get(to, (_FAR, "")), (cost + price, text + edit))
            state, cost, text = _forward_insert(state), cost + INSERT, text + "I"
        out.append(tuple((to, c, k) for to, (c, k) in sorted(best.items())))
    return tuple(out)


def _forward(elements: Sequence, lo: int, hi: int, state: int) -> dict[int, tuple[int, int]]:
    """{state: (cost, rank)} behind the elements lo to hi, from ``state``."""
    now = {state: (0, 0)}
    for e in elements[lo:hi]:
        best: dict[int, tuple[int, int, object]] = {}
        for s, (cost, rank) in now.items():
            for to, price, key in e[s]:
                one = (cost + price, rank, key)
                if to not in best or one < best[to]:
                    best[to] = one
        order = sorted(best, key=lambda t: best[t][1:])
        now = {t: (best[t][0], rank) for rank, t in enumerate(order)}
    return now


def _backward(elements: Sequence, lo: int, hi: int, state: int) -> list[int]:
    """The cost from each state before element lo to ``state`` behind hi."""
    now = [_FAR] * 4
    now[state] = 0
    for e in reversed(elements[lo:hi]):
        now = [min([_FAR, *(price + now[to] for to, price, _ in e[s])]) for s in STATES]
    return now


def crossings(elements: Sequence, first: int, last: int) -> list[int]:
    """The state before each element and behind the last one, for the
    cheapest, then ASCII-least, edits that lead from ``first`` to ``last``."""
    out = [first] * len(elements) + [last]
    open_ = [(0, len(elements))]
    while open_:
        lo, hi = open_.pop()
        if hi - lo < 2:
            continue
        mid = (lo + hi) // 2
        there, back = _forward(elements, lo, mid, out[lo]), _backward(elements, mid, hi, out[hi])
        out[mid] = min(there, key=lambda s: (there[s][0] + back[s], there[s][1]))
        open_ += [(lo, mid), (mid, hi)]
    return out


def end_state(reached: dict[int, tuple[int, int]]) -> tuple[int, int]:
    """(state, whole cost) behind the last row: the edits after it included."""
    state = min(reached, key=lambda s: (reached[s][0] + _TAIL[s][0], reached[s][1]))
    return state, reached[state][0] + _TAIL[state][0]


@lru_cache(1 << 14)
def edits_between(codes: str, first: int, last: int) -> tuple[str, ...]:
    """The edits of each row of a run, those inserted before it included."""
    elements = [row_element(c) for c in codes]
    states = crossings(elements, first, last)
    return tuple(next(k for to, _, k in e[s] if to == t) for e, s, t in zip(elements, states, states[1:]))


def best_edits(codes: str) -> tuple[int, str]:
    """(cost, edits) of a whole conversation that fits in memory."""
    state, cost = end_state(_forward([row_element(c) for c in codes], 0, len(codes), 0))
    return cost, "".join(edits_between(codes, 0, state)) + _TAIL[state][1]


# --- runs as flat arrays ------------------------------------------------------------

_RUN = "costs array<long>, ranks array<int>, n_blank long, n_duplicate long, n_truncated long, n_illegal long, head string, foot string"
_COUNTS = ("n_blank", "n_duplicate", "n_truncated", "n_illegal")


def _flat(elements: Sequence) -> tuple[list[int], list[int]]:
    costs, ranks = [-1] * 16, [-1] * 16
    for s in STATES:
        for to, (cost, rank) in _forward(elements, 0, len(elements), s).items():
            costs[4 * s + to], ranks[4 * s + to] = cost, rank
    return costs, ranks


def _element(costs: list[int], ranks: list[int]) -> tuple:
    return tuple(tuple((t, costs[4 * s + t], ranks[4 * s + t]) for t in STATES if costs[4 * s + t] >= 0) for s in STATES)


@lru_cache(1 << 14)
def _run_of(codes: str) -> dict:
    costs, ranks = _flat([row_element(c) for c in codes])
    initials, faults = zip(*map(_parts, codes))
    illegal = sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:]))
    return {
        "costs": costs, "ranks": ranks, "n_blank": faults.count("blank"), "n_duplicate": faults.count("duplicate"),
        "n_truncated": faults.count("truncated"), "n_illegal": illegal, "head": initials[0], "foot": initials[-1],
    }


def _composed(runs: list[dict]) -> dict:
    costs, ranks = _flat([_element(r["costs"], r["ranks"]) for r in runs])
    out = {"costs": costs, "ranks": ranks, "head": runs[0]["head"], "foot": runs[-1]["foot"]}
    out |= {c: sum(r[c] for r in runs) for c in _COUNTS}
    out["n_illegal"] += sum(a["foot"] + b["head"] not in _LEGAL for a, b in zip(runs, runs[1:]))
    return out


def _groups(batches, keys: Sequence[str]) -> Iterator[tuple[tuple, list[dict]]]:
    """Neighbouring rows of equal keys."""
    key, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            own = tuple(row[k] for k in keys)
            if held and own != key:
                yield key, held
                held = []
            key = own
            held.append(row)
    if held:
        yield key, held


def _batches(rows: Iterator[dict], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _per_group(df: DataFrame, keys: Sequence[str], order: str, make, schema: str) -> DataFrame:
    """``make(key, rows)`` gives the rows of each group; a group is one task's,
    its rows in the given order.  Groups here are bounded."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        return _batches((row for key, rows in _groups(batches, keys) for row in make(key, rows)), arrow)

    return df.repartition(*keys).sortWithinPartitions(*keys, order).mapInArrow(run, schema)


# --- tables ---------------------------------------------------------------------------


def damaged(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The rows as the test damages them, by crc32 of ``id:turn`` modulo 20: 0
    drops the row, 1 empties its text, 2 takes ``.!?`` out of it, 3 repeats
    the row, 4 sets the role user.  Nulls count as one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space(id_col), F.lit(":"), space(turn_col)).cast("binary")) % 20
    told = rows.select(F.col(id_col), F.col(turn_col), space(role_col).alias(role_col), space(text_col).alias(text_col), kind.alias("_kind"))
    text = F.expr(f"case _kind when 1 then '' when 2 then translate(`{text_col}`, '.!?', '') else `{text_col}` end")
    role = F.expr(f"case _kind when 4 then 'user' else `{role_col}` end")
    again = F.explode(F.expr("case _kind when 3 then array(0, 1) else array(0) end")).alias("_copy")
    return told.filter("_kind != 0").select(id_col, turn_col, role.alias(role_col), text.alias(text_col), again).drop("_copy")


def _ordered(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, text, same, pos): every row with its place in the
    order of all rows, written."""
    keyed = rows.withColumns({"same": F.md5(F.encode("text", "utf-8")), "head": F.substring("text", 1, 64), "own": F.monotonically_increasing_id()})
    order = ["conv", "turn", "role", "head", "same", "own"]  # equal rows spread over tasks by the last key
    placed = keyed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("pos", F.monotonically_increasing_id())
    return written(placed.drop("head", "own"), "conversation-rows")


def _fault(first: Column) -> Column:
    seen = F.rtrim(F.col("text"), F.lit(SPACE))
    ended = F.substring(seen, -1, 1).isin(*ENDS)
    return F.when(seen == "", 2).when(~first, 3).when(~ended, 1).otherwise(0)


def _codes(rows: DataFrame) -> DataFrame:
    """(conv, seg, pos, code).  The first row of every (role, text) is found by
    a minimum that is combined on the map side and met by its place, which is
    unique, so no join key is hot."""
    first = rows.groupBy("conv", "role", "same").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("first"))
    known = rows.join(first, "pos", "left")
    initial = F.expr("case substring(role, 1, 1) when 's' then 0 when 'u' then 1 when 'a' then 2 else 3 end")
    number = 4 * _fault(F.coalesce("first", F.lit(False))) + initial  # as in code_of
    code = F.substring(F.lit("ABCDEFGHIJKLMNOP"), number + 1, F.lit(1))
    return known.select("conv", F.shiftright("pos", SEGMENT_BITS).alias("seg"), "pos", code.alias("code"))


def _runs(rows: DataFrame, conv_type: str) -> DataFrame:
    """The runs of rows with their tables: (conv, seg, codes, at, ...)."""

    def make(key, found):
        codes = "".join(r["code"] for r in found)
        return [{"conv": key[0], "seg": key[1], "at": found[0]["pos"], "codes": codes, **_run_of(codes)}]

    schema = f"conv {conv_type}, seg long, at long, codes string, {_RUN}"
    return written(_per_group(_codes(rows), ["conv", "seg"], "pos", make, schema), "conversation-runs")


def _with_parent(runs: DataFrame) -> DataFrame:
    from pyspark.sql import Window

    number = F.row_number().over(Window.partitionBy("conv").orderBy("seg")) - 1
    return runs.withColumn("parent", F.floor(number / F.lit(FAN)).cast("long"))


def _solved(runs: DataFrame, conv_type: str) -> tuple[DataFrame, DataFrame]:
    """((conv, seg, before, behind) for every run, (conv, cost, counts))."""
    slim = runs.drop("at", "codes")
    levels = [written(_with_parent(slim), "conversation-level")]
    while levels[-1].filter("parent > 0").limit(1).count():  # a conversation has more than FAN runs
        make = lambda key, found: [{"conv": key[0], "seg": key[1], **_composed(found)}]
        schema = f"conv {conv_type}, seg long, {_RUN}"
        above = _per_group(levels[-1].withColumnRenamed("seg", "child"), ["conv", "parent"], "child", make, schema)
        levels.append(written(_with_parent(above), "conversation-level"))

    def top(key, found):
        elements = [_element(r["costs"], r["ranks"]) for r in found]
        state, cost = end_state(_forward(elements, 0, len(elements), 0))
        whole = _composed(found)
        states = crossings(elements, 0, state)
        for k, (r, a, b) in enumerate(zip(found, states, states[1:])):
            yield {"conv": key[0], "seg": r["seg"], "before": a, "behind": b, "last": k == len(found) - 1, "cost": cost, **{c: whole[c] for c in _COUNTS}}

    counts = ", ".join(f"{c} long" for c in ("cost", *_COUNTS))
    schema = f"conv {conv_type}, seg long, before int, behind int, last boolean"
    states = written(_per_group(levels[-1], ["conv"], "seg", top, f"{schema}, {counts}"), "conversation-states")
    totals = states.filter("last").select("conv", "cost", *_COUNTS)
    for level in reversed(levels[:-1]):

        def down(key, found):
            elements = [_element(r["costs"], r["ranks"]) for r in found]
            inner = crossings(elements, found[0]["before"], found[0]["behind"])
            for k, (r, a, b) in enumerate(zip(found, inner, inner[1:])):
                yield {"conv": key[0], "seg": r["seg"], "before": a, "behind": b, "last": found[0]["last"] and k == len(found) - 1}

        ends = states.select(F.col("conv").alias("_conv"), F.col("seg").alias("_parent"), "before", "behind", "last")
        joined = level.join(ends, level["conv"].eqNullSafe(ends["_conv"]) & (level["parent"] == ends["_parent"])).drop("_conv", "_parent")
        states = written(_per_group(joined, ["conv", "parent"], "seg", down, schema), "conversation-states")
    return states, totals


def _edits(runs: DataFrame, states: DataFrame, conv_type: str) -> DataFrame:
    """(conv, pos, edits) per run, ``pos`` being its first row's: the edits of
    each row, and last what is inserted behind the run, joined by commas."""

    def make(batches):
        for b in batches:
            found = b.to_pylist()
            texts = [",".join([*edits_between(r["codes"], r["before"], r["behind"]), _TAIL[r["behind"]][1] if r["last"] else ""]) for r in found]
            yield pa.RecordBatch.from_arrays([b.column("conv"), b.column("at"), pa.array(texts, pa.string())], names=["conv", "pos", "edits"])

    ends = states.select(F.col("conv").alias("_conv"), F.col("seg").alias("_seg"), "before", "behind", "last")
    joined = runs.join(ends, runs["conv"].eqNullSafe(ends["_conv"]) & (runs["seg"] == ends["_seg"]))
    return joined.select("conv", "at", "codes", "before", "behind", "last").mapInArrow(make, f"conv {conv_type}, pos long, edits string")


class Applied:
    """Applies edits to the rows of one conversation, in order."""

    def __init__(self) -> None:
        self.state = 0

    def row(self, edits: str, role: str | None, text: str | None) -> Iterator[tuple[str, str | None, str | None]]:
        """(edit, role, text) of what comes of one row; of a deleted row
        neither role nor text."""
        for edit in edits:
            if edit == "D":
                yield edit, None, None
                continue
            new_role, new_text = role, text
            if edit != "K":
                new_role, new_text = "assistant" if self.state == 2 else "user", "" if edit == "I" else text
            self.state = _NEXT[new_role[0]][self.state]
            yield edit, new_role, new_text


def _applied(batches) -> Iterator[tuple[object, str, str | None, str | None]]:
    """(conv, edit, role, text) of every edit, the conversations in order."""
    conv, now, held = object(), Applied(), []
    for batch in batches:
        for row in batch.to_pylist():
            if row["conv"] != conv:
                conv, now = row["conv"], Applied()
            if row["kind"] == 0:  # the edits of the next run of rows
                held = row["edits"].split(",")[::-1]
                continue
            yield from ((conv, *x) for x in now.row(held.pop(), row["role"], row["text"]))
            if len(held) == 1:  # what is inserted behind the run
                yield from ((conv, *x) for x in now.row(held.pop(), None, None))


class Repair:
    """The repair of a table of conversations.

    The rows are ordered and their edits found when this is made; both are
    written tables in the shared folder."""

    def __init__(self, rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> None:
        ship(rows.sparkSession)
        space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
        told = rows.select(F.col(id_col).alias("conv"), F.col(turn_col).alias("turn"), space(role_col).alias("role"), space(text_col).alias("text"))
        self.conv_type = told.schema["conv"].dataType.simpleString()
        self.names = (id_col, role_col, text_col)
        self.rows = _ordered(told)
        runs = _runs(self.rows, self.conv_type)
        states, self.totals = _solved(runs, self.conv_type)
        self.edits = _edits(runs, states, self.conv_type)

    def _in_order(self) -> DataFrame:
        none = F.lit(None).cast("string")
        edits = self.edits.select("conv", "pos", F.lit(0).alias("kind"), "edits", none.alias("role"), none.alias("text"))
        rows = self.rows.select("conv", "pos", F.lit(1).alias("kind"), none.alias("edits"), "role", "text")
        return edits.union(rows).repartition("conv").sortWithinPartitions("conv", "pos", "kind")

    def repaired(self) -> DataFrame:
        """The rows of the repaired conversations: (id, place, edit, role,
        text); ``place`` counts from 0 in each conversation."""
        id_col, role_col, text_col = self.names
        schema = pa.schema([(id_col, _arrow_type(self.conv_type)), ("place", pa.int64()), ("edit", pa.string()), (role_col, pa.string()), (text_col, pa.string())])

        def run(batches):
            def rows():
                conv, place = object(), 0
                for c, edit, role, text in _applied(batches):
                    if c != conv:
                        conv, place = c, 0
                    if edit != "D":
                        yield {id_col: c, "place": place, "edit": edit, role_col: role, text_col: text}
                        place += 1

            return _batches(rows(), schema, 1024)

        return self._in_order().mapInArrow(run, f"`{id_col}` {self.conv_type}, place long, edit string, `{role_col}` string, `{text_col}` string")

    def report(self) -> DataFrame:
        """Per conversation with rows: (conv, gaps, blank, duplicate,
        truncated, illegal, cost, audit, repaired_sha256)."""
        schema = pa.schema([("conv", _arrow_type(self.conv_type)), ("audit", pa.string()), ("repaired_sha256", pa.string())])

        def run(batches):
            def rows():
                conv, audit, digest, some = None, None, None, False
                for c, edit, role, text in _applied(batches):
                    if audit is None or c != conv:
                        if audit is not None:
                            yield {"conv": conv, "audit": audit.getvalue(), "repaired_sha256": digest.hexdigest()}
                        conv, audit, digest, some = c, io.StringIO(), hashlib.sha256(), False
                    audit.write(edit)
                    if edit != "D":
                        digest.update(("\n" * some + role + ":" + text).encode())
                        some = True
                if audit is not None:
                    yield {"conv": conv, "audit": audit.getvalue(), "repaired_sha256": digest.hexdigest()}

            return _batches(rows(), schema, 256)

        texts = self._in_order().mapInArrow(run, f"conv {self.conv_type}, audit string, repaired_sha256 string")
        turn = F.col("turn").try_cast("decimal(38,0)")
        missing = F.expr("try_cast(max(t) - min(t) + 1 - count(distinct t) as long)")
        gaps = self.rows.select("conv", turn.alias("t")).groupBy("conv").agg(F.when(F.count("t") == 0, F.lit(0).cast("long")).otherwise(missing).alias("gaps"))
        parts = [
            gaps,
            self.totals.select("conv", "cost", *[F.col(c).alias(c[2:]) for c in _COUNTS]),
            texts,
        ]
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionByName(part, allowMissingColumns=True)
        columns = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
        return whole.groupBy("conv").agg(*[F.max(c).alias(c) for c in columns])


def _arrow_type(name: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(f"c {name}")).field(0).type


def audit(rows: DataFrame, every: DataFrame, id_col: str = "conv_id", **columns: str) -> DataFrame:
    """The report for every conversation id of ``every``, whether or not it
    has rows in ``rows``."""
    report = Repair(rows, id_col=id_col, **columns).report()
    found = report.unionByName(every.select(F.col(id_col).alias("conv")).distinct(), allowMissingColumns=True)
    # a conversation without rows has no edits
    zero = {c: F.lit(0).cast("long") for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    zero |= {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit("").cast("binary"), 256)}
    return found.groupBy(F.col("conv").alias(id_col)).agg(*[F.coalesce(F.max(c), z).alias(c) for c, z in zero.items()])
