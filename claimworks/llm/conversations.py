"""Repair of the turn structure of conversations, with the cheapest and then least audit of edits.

A conversation must read ``(s?(ua)+)?`` in the initials of its roles: system, user, assistant. Rows are
kept, given another role or deleted, and empty turns are inserted, at the least cost; of the cheapest
edits the ASCII-least audit is taken. Its prefixes are linked nodes that share their beginnings, with
ancestors at powers of two and rolling hashes: ties are decided by searching the longest common prefix,
and equal hashes are verified on the letters.

Rows travel as digests, sorted by conversation and turn over all tasks. A task solves what lies wholly
in its range. Conversations that reach across ranges, or are longer than a segment, are solved segment
by segment for every state that they may be entered in; the segments are then chained by their costs.
"""

from __future__ import annotations

import re
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimworks.llm.tables import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

VISIBLE = r"[^\x20\x09-\x0D]"
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3  # costs
SEGMENT_ROWS = 4096
EMPTY, SYSTEM, USER, ASSISTANT = range(4)  # states: what the repaired rows end with so far
FOLLOWS = {("s", EMPTY): SYSTEM, ("a", USER): ASSISTANT} | {("u", q): USER for q in (EMPTY, SYSTEM, ASSISTANT)}
TAIL = {EMPTY: "", SYSTEM: "ua", USER: "a", ASSISTANT: ""}  # turns inserted at the end of a conversation
LEGAL = {"su", "ua", "au"}
# Edits as letters that also tell the role: insert u or a, rerole U or A, keep, delete.
LETTERS = {"u": "I", "a": "I", "U": "R", "A": "R", "K": "K", "D": "D"}
TOKEN = "([ua]*[UAKD])"  # the edits up to and with that of one row
SOLVED = {  # what the solution of a task adds to its rows
    "place": T.LongType(), "edit": T.StringType(), "tail": T.StringType(), "illegal": T.LongType(),
    "segment": T.LongType(), "at": T.IntegerType(), "first": T.StringType(),
    "costs": T.ArrayType(T.IntegerType()), "ranks": T.ArrayType(T.IntegerType()), "audits": T.ArrayType(T.StringType()),
}
CACHED = 64  # rows of a conversation whose solution is remembered


def damage(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with faults put in by a digest of conversation and turn.

    Of twenty rows one is dropped, one emptied, one loses its ``.!?``, one is repeated and one becomes
    the user's. Nulls are one space in the digest, in role and in text; ids and turns stay null.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(blank("text"), "[.!?]", "")).otherwise(blank("text"))
    return rows.select(
        "conv_id", "turn", kind.alias("kind"),
        F.when(kind == 4, "user").otherwise(blank("role")).alias("role"), text.alias("text"),
    ).where("kind <> 0").select(
        "conv_id", "turn", "role", "text",
        F.explode(F.array_repeat(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def edits(rows: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """The edit of every row, as digests; equal rows of one turn are one row with a count.

    Rows stand by turn (nulls first), then by role and SHA-256 of role and text, since the table has no
    order of its own. ``symbol`` is the first fault: ``b`` blank, ``d`` role and text seen earlier, else
    the role's initial (``x`` beyond system, user, assistant), upper case where the text is truncated.
    Of ``copies`` only the first can be other than a duplicate. ``edit`` holds the letters of the turns
    inserted before the row and its own edit, ``tail`` those inserted at the conversation's end,
    ``illegal`` the neighbours of wrong roles that end at this row, ``place`` the order of rows.
    """
    named = _faults(rows).repartitionByRange("conv_id", "turn", "role", "digest").sortWithinPartitions(
        "conv_id", "turn", "role", "digest"
    ).withColumn("part", F.spark_partition_id())
    schema = T.StructType(list(named.schema)[:-1])
    for name, kind in SOLVED.items():
        schema = schema.add(name, kind)
    solved = stored(named.mapInArrow(lambda batches: _solve(batches, segment_rows), schema), "edits")
    columns = [*named.columns[:-1], "place", "edit", "tail", "illegal"]
    done = solved.where("edit IS NOT NULL").select(columns)

    summary = solved.where("costs IS NOT NULL").select("conv_id", "segment", "first", "initial", "costs", "ranks", "audits")
    chained = T.StructType([rows.schema["conv_id"]]).add("segment", T.LongType()).add("pick", T.IntegerType()).add(
        "tail", T.StringType()
    ).add("joint", T.LongType())
    links = summary.drop("audits").groupBy("conv_id").applyInArrow(_chain, chained)
    tokens = summary.select("segment", "audits").join(links, "segment").select(
        "segment", F.posexplode(F.regexp_extract_all(F.get("audits", F.col("pick")), F.lit(TOKEN), F.lit(1))).alias("at", "token")
    )
    ends = links.select(F.col("segment").alias("s"), F.col("tail").alias("t"), "joint")
    last = F.col("costs").isNotNull()
    opened = solved.where("edit IS NULL").join(tokens, ["segment", "at"], "left").join(
        ends, F.col("segment") == F.col("s"), "left"
    )
    return done.unionByName(opened.select(
        *named.columns[:-1], "place", F.coalesce("token", F.lit("D")).alias("edit"),
        F.when(last, F.col("t")).otherwise("").alias("tail"),
        (F.col("illegal") + F.when(last, F.col("joint")).otherwise(0)).alias("illegal"),
    ))


def _digest() -> Column:
    """SHA-256 that stands for role and text."""
    return F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256))


def _faults(rows: DataFrame) -> DataFrame:
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    plain = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    initial = F.substring("role", 1, 1)
    counted = plain.select(
        "conv_id", "turn", "role", _digest().alias("digest"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("initial"),
        (~F.col("text").rlike(VISIBLE)).alias("blank"),
        (~F.col("text").rlike(rf"[.!?][\x20\x09-\x0D]*\z")).alias("cut"),
    ).groupBy("conv_id", "turn", "role", "digest", "initial", "blank", "cut").agg(F.count(F.lit(1)).alias("copies"))
    # where role and text stand in several turns, only the first is no duplicate
    order = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn"))
    again = counted.groupBy("conv_id", "digest").agg(F.min(order).alias("least"), F.count(F.lit(1)).alias("n")).where(
        "n > 1"
    ).select(F.col("conv_id").alias("c"), F.col("digest").alias("d"), "least")
    found = counted.join(again, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")), "left")
    later = F.coalesce(order > F.col("least"), F.lit(False))
    symbol = F.when(F.col("blank"), "b").when(later, "d").when(F.col("cut"), F.upper("initial")).otherwise(F.col("initial"))
    return found.select("conv_id", "turn", "role", "digest", "initial", "copies", symbol.alias("symbol"))


def conversations(rows: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Per conversation its faults, the audit with its cost, and the repaired rows.

    ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost`` (longs), ``audit`` and
    ``repaired``, an array of ``role:text``. Nulls in role or text are one space; null ids are one
    conversation, null turns come first and leave no gap. An unknown role fits nowhere and is rerolled
    or deleted. Repeated rows are duplicates; ties of turn go by role and digest. Texts are whole at any
    length, up to a cell of a table; the audit and the repaired rows of one conversation are one cell
    too. An empty table gives no rows. Other columns are not read.
    """
    rows = rows.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text")
    )
    found = stored(edits(rows, segment_rows), "audits")
    shown = lambda c: F.translate(c, "uaUA", "IIRR")
    forced = F.col("copies") - F.when(F.col("symbol").isin("b", "d"), 0).otherwise(1)
    kept = F.substring("edit", -1, 1) != "D"
    texts = rows.select("conv_id", "turn", "role", _digest().alias("digest"), "text").groupBy(
        *[F.col(c).alias(f"{c}_") for c in ("conv_id", "turn", "digest")]
    ).agg(F.max("text").alias("text"))
    same = [F.col(c).eqNullSafe(F.col(f"{c}_")) for c in ("conv_id", "turn", "digest")]
    lined = found.join(texts, same[0] & same[1] & same[2] & kept, "left")
    cut = lambda c: F.filter(F.split(c, ""), lambda x: x != "")
    turns = lambda c: F.transform(cut(c), lambda x: F.when(x == "u", "user:").otherwise("assistant:"))
    own = F.substring("edit", -1, 1)
    role = F.when(own == "U", "user").when(own == "A", "assistant").otherwise(F.col("role"))
    lines = F.concat(
        turns(F.expr("substring(edit, 1, length(edit) - 1)")),
        F.when(kept, F.array(F.concat(role, F.lit(":"), F.col("text")))).otherwise(F.array().cast("array<string>")),
        turns("tail"),
    )
    inserted = F.length(F.regexp_replace(F.concat("edit", "tail"), "[^ua]", ""))
    optional = ~F.col("symbol").isin("b", "d")
    cut_kept = optional & kept & (F.upper("symbol") == F.col("symbol"))
    cost = (
        inserted * INSERT + F.when(own.isin("U", "A"), REROLE).otherwise(0) + F.when(cut_kept, TRUNCATED).otherwise(0)
        + DELETE * (F.when(optional & ~kept, 1).otherwise(0) + forced)
    )
    # the row's own edit first, then its further copies go, before turns inserted at the end
    letters = F.concat(
        F.when(optional, shown("edit")).otherwise(""), F.repeat(F.lit("D"), forced.cast("int")), shown("tail")
    )
    n = lambda when: F.sum(F.when(when, F.col("copies")).otherwise(0))
    listed = lined.select("*", forced.alias("forced"), cost.alias("paid"), F.struct("place", letters.alias("letters"), lines.alias("lines")).alias("piece"))
    in_order = listed.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.size(F.collect_set("turn")), F.lit(0)).cast("long").alias("gaps"),
        n(F.col("symbol") == "b").alias("blank"),
        F.sum(F.when(F.col("symbol") == "b", 0).otherwise(F.col("forced"))).alias("duplicate"),
        F.sum(F.when(optional & (F.upper("symbol") == F.col("symbol")), 1).otherwise(0)).cast("long").alias("truncated"),
        F.sum("illegal").alias("illegal"), F.sum("paid").cast("long").alias("cost"),
        F.array_sort(F.collect_list("piece")).alias("pieces"),
    )
    return in_order.select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost",
        F.array_join(F.col("pieces.letters"), "").alias("audit"), F.flatten(F.col("pieces.lines")).alias("repaired"),
    )


def _solve(batches, segment_rows: int):
    """The sorted rows of a task with their edits; those of conversations that may go on elsewhere with
    the solutions of their segment instead, on its last row."""
    fields = ["conv_id", "turn", "role", "digest", "initial", "copies", "symbol"]
    kinds, mine, complete, started = None, [], False, False
    part = place = 0
    out = {"rows": [], "size": 0}
    now = object()

    def close(ends: bool):
        nonlocal mine, place
        if mine:
            for row in _segment(mine, part, place, ends):
                out["rows"].append(row)
            place += len(mine)
            mine = []

    for batch in batches:
        kinds = kinds or [batch.schema.field(f).type for f in fields]
        part = batch.column("part")[0].as_py()
        for row in zip(*(batch.column(f).to_pylist() for f in fields), strict=True):
            if row[0] != now or not started:
                close(complete)  # the first conversation of a task may have begun elsewhere
                complete, now, started = started, row[0], True
            elif len(mine) == segment_rows:
                complete = False
                close(False)
            mine.append(row)
        if len(out["rows"]) >= segment_rows:
            yield _table(out["rows"], fields, kinds)
            out["rows"] = []
    close(False)
    if out["rows"]:
        yield _table(out["rows"], fields, kinds)


def _table(rows: list, fields: list, kinds: list) -> pa.RecordBatch:
    more = [
        ("place", pa.int64()), ("edit", pa.string()), ("tail", pa.string()), ("illegal", pa.int64()),
        ("segment", pa.int64()), ("at", pa.int32()), ("first", pa.string()), ("costs", pa.list_(pa.int32())),
        ("ranks", pa.list_(pa.int32())), ("audits", pa.list_(pa.string())),
    ]
    kinds = [*kinds, *(k for _, k in more)]
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.record_batch(columns, names=[*fields, *(n for n, _ in more)])


def _segment(rows: list, part: int, place: int, complete: bool):
    """Output rows of a segment: with edits if it is a whole conversation."""
    symbols = "".join(r[6] for r in rows if r[6] not in "bd")
    number = part << 40 | place
    tokens, tail, summary = None, "", (None, None, None, None)
    if complete:
        _, audit, tail = whole(symbols)
        tokens = re.findall(TOKEN, audit)
    else:
        found = [solution(symbols, entry) for entry in range(4)]
        flat = [x for row in found for x in row]
        summary = (
            rows[0][4], [-1 if x is None else x[0] for x in flat], [r for row in found for r in _ranks(row)],
            [None if x is None else x[1] for x in flat],
        )
    at, before = 0, None
    for i, row in enumerate(rows):
        optional, final = row[6] not in "bd", i == len(rows) - 1
        illegal = row[5] - 1 + (before is not None and before + row[4] not in LEGAL)
        edit = None if not complete else tokens[at] if optional else "D"
        yield (
            *row, part << 40 | (place + i), edit, tail if final else "", illegal, number, at if optional else None,
            *(summary if final else (None, None, None, None)),
        )
        at += optional
        before = row[4]


def _ranks(found: tuple) -> list[int]:
    """The place of each audit among those of one entry state, by ASCII."""
    shown = sorted(letters(x[1]) for x in found if x)
    return [-1 if x is None else shown.index(letters(x[1])) for x in found]


def _chain(table: pa.Table) -> pa.Table:
    """Which solution each segment of one conversation takes: costs to go from the end, then the least
    audit from the start. Audits of a segment differ in a letter wherever they end in different states."""
    rows = sorted(table.to_pylist(), key=lambda r: r["segment"])
    after = [3 * len(TAIL[q]) for q in range(4)]
    to_go = [after]
    for row in reversed(rows):
        c, after = row["costs"], to_go[-1]
        to_go.append([
            min((c[4 * q + t] + after[t] for t in range(4) if c[4 * q + t] >= 0), default=1 << 40) for q in range(4)
        ])
    to_go.reverse()
    state, before, out = EMPTY, None, []
    for i, row in enumerate(rows):
        c, ranks = row["costs"], row["ranks"]
        final = i == len(rows) - 1
        able = [t for t in range(4) if c[4 * state + t] >= 0 and c[4 * state + t] + to_go[i + 1][t] == to_go[i][state]]
        exit_state = min(able, key=lambda t: ranks[4 * state + t])
        joint = int(before is not None and before + row["first"] not in LEGAL)
        out.append((row["segment"], 4 * state + exit_state, TAIL[exit_state] if final else "", joint))
        state, before = exit_state, row["initial"]
    columns = list(zip(*out, strict=True))
    kinds = [pa.int64(), pa.int32(), pa.string(), pa.int64()]
    return pa.table(
        [table.column("conv_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
        names=["conv_id", "segment", "pick", "tail", "joint"],
    )


def letters(edit: str) -> str:
    """The initials of edits."""
    return "".join(LETTERS[x] for x in edit)


class Audits:
    """Prefixes of audits as nodes of a tree: node 0 is empty, any other its parent and one letter."""

    PRIME, BASE = (1 << 61) - 1, 0x1F3D5B79A2C4E681

    def __init__(self):
        self.letter, self.depth, self.hash, self.up = [""], [0], [0], [[]]
        self.equal: dict[int, int] = {}  # nodes whose strings were verified to be the same

    def add(self, parent: int, letter: str) -> int:
        ups = [parent]
        while len(ups) <= len(self.up[ups[-1]]):
            ups.append(self.up[ups[-1]][len(ups) - 1])
        self.up.append(ups)
        self.letter.append(letter)
        self.depth.append(self.depth[parent] + 1)
        self.hash.append(self.digest(self.hash[parent], LETTERS[letter]))
        return len(self.up) - 1

    def digest(self, before: int, initial: str) -> int:
        return (before * self.BASE + ord(initial)) % self.PRIME

    def ancestor(self, node: int, depth: int) -> int:
        while self.depth[node] > depth:
            node = self.up[node][(self.depth[node] - depth).bit_length() - 1]
        return node

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(out))

    def same(self, x: int, y: int) -> bool:
        """Whether two nodes of one depth and hash spell the same initials, letter by letter."""
        a, b = self._known(x), self._known(y)
        while a != b:
            if LETTERS[self.letter[a]] != LETTERS[self.letter[b]]:
                return False
            a, b = self._known(self.up[a][0]), self._known(self.up[b][0])
        if x != y:
            self.equal[max(self._known(x), self._known(y))] = min(self._known(x), self._known(y))
        return True

    def _known(self, node: int) -> int:
        while self.equal.get(node, node) != node:
            node = self.equal[node]
        return node

    def less(self, x: int, y: int) -> bool:
        """Whether the initials of x come before those of y."""
        depth = min(self.depth[x], self.depth[y])
        a, b = self.ancestor(x, depth), self.ancestor(y, depth)
        if self.hash[a] == self.hash[b]:
            if self.same(a, b):
                return self.depth[x] < self.depth[y]
            return letters(self.text(x)) < letters(self.text(y))  # a collision
        for k in reversed(range(len(self.up[a]))):
            if k < len(self.up[a]) and self.hash[self.up[a][k]] != self.hash[self.up[b][k]]:
                a, b = self.up[a][k], self.up[b][k]
        if not self.same(self.up[a][0], self.up[b][0]):
            return letters(self.text(x)) < letters(self.text(y))
        return LETTERS[self.letter[a]] < LETTERS[self.letter[b]]


def _search(symbols: str, entry: int) -> tuple[Audits, dict]:
    """Cheapest, then least edits of rows from a state: ``{state: (cost, node)}`` after them.

    Turns are inserted only before rows that stay: before a deleted row a later place is never worse and
    its audit is less. So all audits of the same rows end with a row's letter, and none begins another.
    """
    audits = Audits()
    best = {entry: (0, 0)}

    def offer(into: dict, state: int, cost: int, parent: int, letter: str):
        had = into.get(state)
        if had and had[0] < cost:
            return
        node = audits.add(parent, letter)
        if not had or cost < had[0] or audits.less(node, had[1]):
            into[state] = (cost, node)

    for symbol in symbols:
        initial, more = symbol.lower(), TRUNCATED * symbol.isupper()
        after: dict = {}
        for state, (cost, node) in best.items():
            offer(after, state, cost + DELETE, node, "D")
        entered = dict(best)
        for state in (EMPTY, SYSTEM, ASSISTANT):
            if state in entered:
                offer(entered, USER, entered[state][0] + INSERT, entered[state][1], "u")
        if USER in entered:
            offer(entered, ASSISTANT, entered[USER][0] + INSERT, entered[USER][1], "a")
        if ASSISTANT in entered:
            offer(entered, USER, entered[ASSISTANT][0] + INSERT, entered[ASSISTANT][1], "u")
        for state, (cost, node) in entered.items():
            if (initial, state) in FOLLOWS:
                offer(after, FOLLOWS[initial, state], cost + more, node, "K")
            target = ASSISTANT if state == USER else USER
            offer(after, target, cost + REROLE + more, node, "A" if target == ASSISTANT else "U")
        best = after
    return audits, best


def _solution(symbols: str, entry: int) -> tuple:
    audits, best = _search(symbols, entry)
    return tuple((best[q][0], audits.text(best[q][1])) if q in best else None for q in range(4))


def solution(symbols: str, entry: int) -> tuple:
    """Per state after the rows ``(cost, edits)``, None where it cannot be reached."""
    return _remembered((symbols, entry), lambda: _solution(symbols, entry))


def _whole(symbols: str) -> tuple[int, str, str]:
    audits, best = _search(symbols, EMPTY)
    found = None
    for state, (cost, node) in best.items():
        end = node
        for turn in TAIL[state]:
            end = audits.add(end, turn)
        cost += INSERT * len(TAIL[state])
        if found is None or cost < found[0] or cost == found[0] and audits.less(end, found[1]):
            found = (cost, end, node, TAIL[state])
    return found[0], audits.text(found[2]), found[3]


def whole(symbols: str) -> tuple[int, str, str]:
    """Cost, edits and turns inserted at the end for the rows of a whole conversation."""
    return _remembered((symbols, None), lambda: _whole(symbols))


_SOLVED: dict = {}


def _remembered(key: tuple, work):
    """Most conversations are short and alike; a worker solves each kind once."""
    if len(key[0]) > CACHED:
        return work()
    if key not in _SOLVED:
        if len(_SOLVED) > 1 << 16:
            _SOLVED.clear()
        _SOLVED[key] = work()
    return _SOLVED[key]
