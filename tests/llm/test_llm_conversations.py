"""Conversation repair against an exhaustive search, in whole and in pieces."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from ombuds.llm import conversation_repair as cr
from ombuds.llm import queries

GRAMMAR = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string, part int, piece string, steps date"


def cheapest(rows):
    """Least (cost, audit, roles) of all edits, by dynamic programming over whole role strings (their automaton's state)."""

    def state(roles):
        for more in ("", "a", "ua"):
            if GRAMMAR.fullmatch(roles + more):
                return (more, not roles or roles == "s" and "s")
        return None

    found = {"": (0, "")}

    def widen(found):
        out = dict(found)
        for _ in range(3):
            for roles, (cost, audit) in list(out.items()):
                for r in "ua":
                    longer = roles + r
                    if state(longer) is not None and len(longer) <= 2 * len(rows) + 3:
                        out[longer] = min(out.get(longer, (10**9, "")), (cost + 3, audit + "I"))
        return out

    for initial, fault in rows:
        after = {}
        for roles, (cost, audit) in widen(found).items():
            options = [("D", roles, 4)]
            if fault not in "bd":
                extra = 3 * (fault == "t")
                options += [("K", roles + initial, extra)] + [("R", roles + r, 3 + extra) for r in "ua"]
            for edit, longer, more in options:
                if (edit == "D" or initial or edit == "R") and state(longer) is not None:
                    after[longer] = min(after.get(longer, (10**9, "")), (cost + more, audit + edit))
        found = after
    return min((found, roles) for roles, found in widen(found).items() if GRAMMAR.fullmatch(roles))


def test_parser_finds_the_cheapest_edits():
    kinds = [(i, f) for i in "sua " for f in ".tbd"]
    random.seed(3)
    some = [tuple(random.choice(kinds) for _ in range(n)) for n in (1, 2, 3, 4, 5, 6) for _ in range(60)]
    for rows in [*itertools.product(kinds, repeat=2), *some]:
        (cost, audit), roles = cheapest(rows)
        assert cr.finish(cr.parse(rows))[:2] == (cost, audit), rows
        names = {"s": "system", "u": "user", "a": "assistant", " ": " "}
        turns = cr.apply(audit, [names[i] for i, _ in rows], [str(n) for n in range(len(rows))])
        assert "".join(role[0] for role, _, _ in turns) == roles


def expected(rows):
    """The query's rows of (conv_id, turn, role, text) rows."""
    out = {}
    for conv in {row[0] for row in rows}:
        bad = []
        for _, turn, role, text in (row for row in rows if row[0] == conv):
            key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
            kind = zlib.crc32(key.encode()) % 20
            role, text = " " if role is None else role, " " if text is None else text
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            bad += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
        bad.sort(key=lambda row: (row[0] is not None, row[0] or 0, row[1], row[2]))
        seen, faults = set(), []
        for _, role, text in bad:
            words = text.strip("\x20\t\n\x0b\x0c\r")
            faults.append("b" if not words else "d" if (role, text) in seen else "t" if words[-1] not in ".!?" else ".")
            seen.add((role, text))
        roles = [role for _, role, _ in bad]
        cost, audit, _ = cr.finish(cr.parse(zip((r[:1] for r in roles), faults)))
        made = "\n".join(f"{role}:{text}" for role, text, _ in cr.apply(audit, roles, [text for *_, text in bad]))
        turns = {turn for turn, _, _ in bad} - {None}
        illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        counts = (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost)
        out[conv] = (*counts, audit, hashlib.sha256(made.encode()).hexdigest())
    return out


def odd_rows():
    random.seed(5)
    texts = ["Yes.", "no", "Why?", "", None, " \t\n", "a" * 30_000 + ".", "ünï 🙂!", "same head " * 9 + "x.", "same head " * 9 + "y."]
    roles = ["user", "assistant", "user", "assistant", "system", None, "", "tool", "User"]
    rows = [(c, t, random.choice(roles), random.choice(texts)) for c in range(60) for t in range(random.randint(1, 9))]
    rows += [(7, 3, "user", "Yes."), (7, 3, "user", "Yes."), (7, None, "user", "Yes."), (None, None, None, None), (None, 2, "user", "A.")]
    rows += [(99, n, random.choice(roles), random.choice(texts) or "") for n in range(400)] + [(99, 900, "user", "End")]
    rows += [(100, 5, "user", "again and again.")] * 300 + [(101, n, "user", "again and again.") for n in range(300)]
    return rows


def run(spark, tmp_path, rows, schema=SCHEMA):
    width = len(schema.split(",")) - 4
    df = spark.createDataFrame([(*row, *(None,) * width) for row in rows], schema)
    df.repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    out = queries.op12_role_repair(spark, str(tmp_path))
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    got = out.collect()
    assert len(got) == len({row.conv_id for row in got})
    return {row.conv_id: tuple(row[name] for name in names) for row in got}


def test_query_is_the_sequential_repair(spark, tmp_path):
    rows = odd_rows()
    assert run(spark, tmp_path, rows) == expected(rows)


@pytest.mark.parametrize("most", [1, 3, 50])
def test_pieces_of_any_size_give_the_same(most):
    rows = [(r[:1], f) for r in ("user", "assistant", "system", "x") for f in ".tbd"] * 12
    random.seed(most)
    random.shuffle(rows)
    chain = cr._Chain(1, {cr.START: (0, "")}, [], {})
    for at in range(0, len(rows), most):
        piece = cr.Piece(1, True, [i for i, _ in rows[at : at + most]], [""] * most, [f for _, f in rows[at : at + most]])
        chain.add(cr._row(piece, 0, at, {}))
    cost, audit, _ = cr.finish(cr.parse(rows))
    made = list(chain.rows())
    assert "".join(row["edits"] for row in made) == audit
    assert (made[0]["cost"], made[0]["audit"]) == (cost, audit)


def test_long_conversation_is_cut(spark, tmp_path):
    rows = [(1, n, "assistant" if n % 3 else "user", f"Text {n % 6000}.") for n in range(10_000)] + [(2, 0, "user", "A.")]
    assert run(spark, tmp_path, rows) == expected(rows)


def test_no_rows_and_other_ids(spark, tmp_path):
    assert run(spark, tmp_path / "a", []) == {}
    text_ids = "conv_id string, turn int, role string, text string"
    rows = [("a", 1, "user", "A."), ("a", 2, "assistant", "B."), (None, 3, "user", "C")]
    assert run(spark, tmp_path / "b", rows, text_ids) == expected(rows)
