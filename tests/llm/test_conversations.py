"""Conversation repair against plain versions: all scripts of short ones, costs to go for long ones."""

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from claimworks.llm import conversations as C
from claimworks.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
VISIBLE = re.compile(r"[^\x20\x09-\x0D]")
FORM = re.compile(r"(s?(ua)+)?")


def every_script(symbols, inserts=2):
    """Cheapest, then least audit by trying everything; up to two turns inserted at any place."""
    gaps = ["", "u", "a", "ua", "au"][: 1 + 2 * inserts]
    best = None
    for edits in itertools.product(*(["D"] if x in "bd" else ["K", "U", "A", "D"] for x in symbols)):
        for between in itertools.product(gaps, repeat=len(symbols) + 1):
            roles, audit, cost = "", "", 0
            for gap, symbol, edit in itertools.zip_longest(between, symbols, edits, fillvalue=""):
                roles += gap
                audit += "I" * len(gap)
                cost += 3 * len(gap)
                if edit:
                    audit += {"U": "R", "A": "R"}.get(edit, edit)
                    cost += {"K": 0, "D": 4}.get(edit, 3) + (3 if edit != "D" and symbol.isupper() else 0)
                    roles += {"U": "u", "A": "a", "K": symbol.lower(), "D": ""}[edit]
            if FORM.fullmatch(roles) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def by_costs_to_go(symbols):
    """The same from the end: numbers only, then the least letter that stays on a cheapest way."""
    def moves(i, q):
        if q in "^sa":
            yield "I", 3, i, "u", "user:"
        else:
            yield "I", 3, i, "a", "assistant:"
        if i < len(symbols):
            yield "D", 4, i + 1, q, None
            if symbols[i] not in "bd":
                extra = 3 if symbols[i].isupper() else 0
                initial = symbols[i].lower()
                if (initial == "s" and q == "^") or (initial == "u" and q in "^sa") or (initial == "a" and q == "u"):
                    yield "K", extra, i + 1, initial, "keep"
                yield ("R", 3 + extra, i + 1, "u", "user") if q in "^sa" else ("R", 3 + extra, i + 1, "a", "assistant")

    to_go = {}
    for i in range(len(symbols), -1, -1):
        here = {"^": 0 if i == len(symbols) else 1 << 60, "a": 0 if i == len(symbols) else 1 << 60, "s": 1 << 60, "u": 1 << 60}
        for _ in range(4):
            for q in "^sua":
                for _, cost, j, r, _ in moves(i, q):
                    here[q] = min(here[q], cost + (here[r] if j == i else to_go[j, r]))
        to_go |= {(i, q): c for q, c in here.items()}
    i, q, audit, made = 0, "^", "", []
    while (i, q) not in ((len(symbols), "^"), (len(symbols), "a")) or to_go[i, q]:
        letter, _, j, r, what = min(m for m in moves(i, q) if m[1] + to_go[m[2], m[3]] == to_go[i, q])
        audit += letter
        if what:
            made.append((i if j > i else None, what))
        i, q = j, r
    return to_go[0, "^"], audit, made


symbols_of = lambda n, pool="bdsuaxSUAX": st.text(st.sampled_from(pool), max_size=n)


@settings(max_examples=60, deadline=None)
@given(symbols_of(3))
def test_plain_versions_agree(symbols):
    cost, audit, _ = by_costs_to_go(symbols)
    assert (cost, audit) == every_script(symbols)


@settings(max_examples=400, deadline=None)
@given(symbols_of(40, "suaxSUAX"))
def test_whole_conversations(symbols):
    cost, audit, tail = C._whole(symbols)
    want = by_costs_to_go(symbols)
    assert (cost, C.letters(audit + tail)) == want[:2]


class Colliding(C.Audits):
    PRIME = 3


class Plain(C.Audits):
    def less(self, x, y):
        return C.letters(self.text(x)) < C.letters(self.text(y))


@pytest.mark.parametrize("kind", [Colliding, Plain])
def test_collisions_do_not_decide(monkeypatch, kind):
    rng = random.Random(3)
    cases = ["".join(rng.choice("suaxSUAX") for _ in range(rng.randrange(60))) for _ in range(300)]
    want = [C._whole(c) for c in cases]
    monkeypatch.setattr(C, "Audits", kind)
    assert [C._whole(c) for c in cases] == want


def test_nodes_compare_like_their_strings():
    rng = random.Random(7)
    audits, nodes = C.Audits(), [0]
    for _ in range(400):
        nodes.append(audits.add(rng.choice(nodes[-20:]), rng.choice("uKD")))
    for _ in range(4000):
        x, y = rng.choice(nodes), rng.choice(nodes)
        a, b = C.letters(audits.text(x)), C.letters(audits.text(y))
        assert audits.less(x, y) == (a < b)
        depth = rng.randrange(audits.depth[x] + 1)
        assert audits.text(audits.ancestor(x, depth)) == audits.text(x)[:depth]


def test_a_long_conversation_ends_soon():
    symbols = "".join(random.Random(1).choice("suaxSUAX") for _ in range(4000))
    cost, audit, tail = C._whole(symbols)
    assert (cost, C.letters(audit + tail)) == by_costs_to_go(symbols)[:2]


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        blank = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{blank(conv)}:{blank(turn)}".encode()) % 20
        role, text = blank(role), blank(text)
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def report(rows, ids):
    """Plain version of the query's rows from damaged rows."""
    result = []
    for conv in ids:
        mine = [r[1:] for r in rows if r[0] == conv]
        digest = lambda r: hashlib.sha256(f"{len(r[1].encode())}:{r[1]}{r[2]}".encode()).digest()
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), digest(r)))
        turns = {t for t, *_ in mine if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        seen, symbols = set(), ""
        for _, role, text in mine:
            shown = [c for c in text if VISIBLE.match(c)]
            initial = role[0] if role[:1] in ("s", "u", "a") and role else "x"
            if not shown:
                symbols += "b"
            elif (role, text) in seen:
                symbols += "d"
            else:
                symbols += initial.upper() if shown[-1] not in ".!?" else initial
            seen.add((role, text))
        initials = [r[1][:1] or "-" for r in mine]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        cost, audit, made = by_costs_to_go(symbols)
        lines = []
        for at, what in made:
            if at is None:
                lines.append(what)
            else:
                lines.append(f"{mine[at][1] if what == 'keep' else what}:{mine[at][2]}")
        result.append((
            conv, gaps, symbols.count("b"), symbols.count("d"), sum(x.isupper() for x in symbols), illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        ))
    return sorted(result, key=str)


def found(frame):
    return sorted((
        (*tuple(r)[:8], hashlib.sha256("\n".join(r["repaired"]).encode()).hexdigest()) for r in frame.collect()
    ), key=str)


def odd_rows():
    rng = random.Random(11)
    rows = []
    for conv in [*range(40), None]:
        for turn in rng.sample([None, *range(9)], rng.randrange(1, 8)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None, "User", "ß"])
            text = rng.choice(["Yes.", "no", "Wait! ", "\n\t", "", None, "long " * 3000 + "?", "a ", "Yes.", f"t{turn}."])
            rows += [(conv, turn, role, text)] * rng.choice([1, 1, 1, 3])
    rows += [(99, 3, "user", "same.")] * 200 + [(98, t, "user", "ok.") for t in range(150)]
    rows += [(97, t, rng.choice(["system", "user", "assistant", "x"]), f"{t}{rng.choice('.!x')}") for t in range(300)]
    return rows


SCHEMA = "conv_id long, turn long, role string, text string, symbol string, part int, edit int"


@pytest.mark.parametrize("segment_rows, parts", [(4096, 8), (7, 3), (1, 8)])
def test_matches_plain_version(spark, segment_rows, parts):
    rows = odd_rows()
    frame = spark.createDataFrame([(*r, "s", 1, 2) for r in rows], SCHEMA).repartition(parts)
    blank = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert found(C.conversations(frame, segment_rows)) == report(blank, {r[0] for r in rows})


def test_damage(spark):
    rows = odd_rows()
    frame = spark.createDataFrame([(*r, "s", 1, 2) for r in rows], SCHEMA)
    assert sorted(map(tuple, C.damage(frame).collect()), key=str) == sorted(damaged(rows), key=str)


def test_empty_table(spark):
    assert C.conversations(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query(spark):
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{FOLDER}/conversations.parquet'").fetchall()
    got = sorted(map(tuple, QUERIES["op13_conversation_repair"](spark, FOLDER).collect()), key=str)
    assert got == report(damaged(rows), {r[0] for r in rows})
