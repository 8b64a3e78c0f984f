"""Conversation repair against a plain search over all states and strings."""

import hashlib
import random
import re
import zlib

import pytest

from tidewatch.llm import dialogue, queries

from ..conftest import SF001

BLANK = re.compile(r"[^\x20\x09-\x0D]")
COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def damage(rows):
    """Rows in order of turn (nulls first), role and text."""
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        role = "user" if fate == 4 else role
        out[conv] += [(turn, role, text)] * (2 if fate == 3 else 1)
    return {c: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c, v in out.items()}


def marks(rows):
    seen, out = set(), []
    for _, role, text in rows:
        said = BLANK.findall(text)
        out.append("blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """Shortest path over (rows done, initials so far as a state), with whole audits and texts, by relaxation."""
    after = {"": ("s", "u"), "s": ("u",), "u": ("a",), "a": ("u",)}
    full = {"u": "user", "a": "assistant"}
    best = {(0, ""): (0, "", ())}
    for k in range(len(rows) + 1):
        for _ in range(4):  # insertions
            for q in ("", "s", "u", "a"):
                if (k, q) in best:
                    cost, audit, said = best[k, q]
                    for s in after[q]:
                        if s != "s":
                            way = (cost + 2, audit + "I", (*said, f"{full[s]}:"))
                            if (k, s) not in best or way[:2] < best[k, s][:2]:
                                best[k, s] = way
        if k == len(rows):
            break
        for q in ("", "s", "u", "a"):
            if (k, q) not in best:
                continue
            cost, audit, said = best[k, q]
            _, role, text = rows[k]
            ways = [(q, 3, "D", ())]
            if faults[k] not in ("blank", "duplicate"):
                extra = faults[k] == "truncated"
                for s in after[q]:
                    if role[:1] == s:
                        ways.append((s, extra, "K", (f"{role}:{text}",)))
                    if s != "s":
                        ways.append((s, 2 + extra, "R", (f"{full[s]}:{text}",)))
            for s, c, e, more in ways:
                way = (cost + c, audit + e, said + more)
                if (k + 1, s) not in best or way[:2] < best[k + 1, s][:2]:
                    best[k + 1, s] = way
    return min((best[len(rows), q] for q in ("", "a") if (len(rows), q) in best), key=lambda w: w[:2])


def expected(rows):
    out = {}
    for conv, own in damage(rows).items():
        faults = marks(own)
        turns = [t for t, _, _ in own if t is not None]
        cost, audit, said = cheapest(own, faults)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own[:-1], own[1:], strict=True))
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                     illegal, cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest())
    return out


def result(frame):
    rows = frame.collect()
    out = {r.conv_id: tuple(r[c] for c in COLUMNS[1:]) for r in rows}
    assert len(out) == len(rows)
    return out


def odd_rows(seed=4, conversations=150):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "why", "", " \t", None, "x. \n", "Yes.", "é?", " ", "a.b", "…"]
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "unknown", "tool", "Ä"]
    rows = []
    for c in range(conversations):
        for k in range(rng.randrange(0, 14)):
            rows.append((c if c else None, rng.choice([k, k, k, None, k + 3, 2]), rng.choice(roles[:5] if c % 2 else roles), rng.choice(texts)))
    return rows + [(500, None, None, None), (501, 5, "user", "Hi.")]


def frame(spark, rows, extra=""):
    return spark.createDataFrame([(*r, *([9] * (3 if extra else 0))) for r in rows], f"conv_id bigint, turn bigint, role string, text string{extra}")


def test_repair_equals_the_search_over_all_states(spark):
    rows = odd_rows()
    assert result(dialogue.repair(frame(spark, rows, ", at bigint, code bigint, conv bigint"))) == expected(rows)


def test_conversations_across_chunks(spark, monkeypatch):
    monkeypatch.setattr(dialogue, "CHUNK_BITS", 2)
    rng = random.Random(8)
    rows = odd_rows(6, 40) + [(700 + c, k, rng.choice(["user", "assistant", "user", "system"]), rng.choice(["Yes.", f"{k}?", "so", f"{k}!"])) for c in range(3) for k in range(150)]
    assert result(dialogue.repair(frame(spark, rows).repartition(5))) == expected(rows)


def test_divide_and_conquer_is_the_least_audit():
    rng = random.Random(2)
    initials, roles = "suax", {"s": "system", "u": "user", "a": "assistant", "x": "x"}
    for _ in range(3000):
        rows = [(k, roles[rng.choice(initials)], rng.choice(["Yes.", "no", "", f"{k}."])) for k in range(rng.randrange(0, 12))]
        faults = marks(rows)
        codes = bytes(initials.index(r[1][0]) * 4 + dialogue.FAULTS.index(f) for r, f in zip(rows, faults, strict=True))
        edits, state = dialogue.solve(codes)
        assert "".join(edits) + (dialogue.CLOSING[state] if rows else "") == cheapest(rows, faults)[1]


def test_repaired_rows_give_the_digest(spark):
    rows = odd_rows(9, 60)
    table = frame(spark, rows)
    ordered, made = dialogue.plan(table)
    said = {}
    for r in sorted(dialogue.repaired(ordered, made).collect(), key=lambda r: (r.at, r.step)):
        said.setdefault(r.conv, [])
        if r.edit != "D":
            said[r.conv].append(f"{r.role}:{r.text}")
    want = expected(rows)
    assert {c: hashlib.sha256("\n".join(v).encode()).hexdigest() for c, v in said.items()} == {c: w[-1] for c, w in want.items() if w[-2]}


def test_equal_rows_and_long_conversation(spark):
    rows = [(1, 7, "user", "Hi.")] * 300 + [(2, k, "user" if k % 2 == 0 else "assistant", f"{k} " * 500 + ".") for k in range(300)]
    assert result(dialogue.repair(frame(spark, rows))) == expected(rows)


def test_empty_table(spark):
    assert dialogue.repair(frame(spark, [])).count() == 0


@pytest.mark.parametrize("dropped", [True, False])
def test_nothing_left_of_a_conversation(spark, dropped):
    conv = next(c for c in range(1000) if (zlib.crc32(f"{c}:0".encode()) % 20 == 0) == dropped)
    out = result(dialogue.repair(frame(spark, [(conv, 0, "user", "Hi.")])))
    assert (out[conv] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())) == dropped


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert result(queries.QUERIES["op12_dialogue_repair"](spark, SF001)) == expected(rows)
