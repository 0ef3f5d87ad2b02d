"""The repair against all edit strings, the checkpoints, and odd rows."""

import hashlib
import heapq
import zlib

import pytest

from ledgerline.llm import repair as R
from llm_helpers import rng  # noqa: F401

ROWS = "conv_id long, turn long, role string, text string, gone boolean"
COST = {"K": 0, "R": 3, "D": 4, "I": 3}


def wanted(role_now: str) -> str:
    return "assistant" if role_now == "u" else "user"


def brute(rows):
    """Least (cost, edits) and the turns, by uniform-cost search over all edit strings."""
    seen, faults = set(), []
    for role, text in rows:
        body = text.strip(R.WHITE)
        faults.append("blank" if not body else "dup" if (role, text) in seen else "cut" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, last, turns = heapq.heappop(heap)
        if i == len(rows) and last in ("", "a"):
            return cost, audit, turns
        if (i, last) in done:
            continue
        done.add((i, last))
        new = wanted(last)
        heapq.heappush(heap, (cost + 3, audit + "I", i, new[0], (*turns, (new, ""))))
        if i == len(rows):
            continue
        heapq.heappush(heap, (cost + 4, audit + "D", i + 1, last, turns))
        if faults[i] in ("blank", "dup"):
            continue
        extra = 3 if faults[i] == "cut" else 0
        role, text = rows[i]
        heapq.heappush(heap, (cost + 3 + extra, audit + "R", i + 1, new[0], (*turns, (new, text))))
        if role[:1] in {"": ("s", "u"), "s": ("u",), "u": ("a",), "a": ("u",)}[last]:
            heapq.heappush(heap, (cost + extra, audit + "K", i + 1, role[0], (*turns, (role, text))))


def code(rows):
    seen, out = set(), bytearray()
    for role, text in rows:
        body = text.strip(R.WHITE)
        fault = R.BLANK if not body else R.DUPLICATE if (role, text) in seen else R.TRUNCATED if body[-1] not in ".!?" else 0
        seen.add((role, text))
        out.append(fault * 4 + "sua".find(role[:1] or "?") % 4)
    return bytes(out)


def random_rows(rng, n):
    role = lambda: rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "sys", "u"])
    return [(role(), rng.choice(["One.", "Two!", "cut", "  ", "", "Three?", "x" + str(rng.random()) + "."]))
            for _ in range(n)]


def walked(rows):
    w = R.Walk(code(rows))
    audit, turns = [], []
    for role, text in rows:
        for edit, new in w.row():
            audit.append(edit)
            if edit != "D":
                turns.append((new or role, "" if edit == "I" else text))
    for edit, new in w.end():
        audit.append(edit)
        turns.append((new, ""))
    return w.cost, "".join(audit), tuple(turns)


def test_walk_equals_all_edit_strings(rng):
    for n in list(range(13)) * 60:
        rows = random_rows(rng, n)
        assert walked(rows) == brute(rows), rows


def test_few_vectors_are_kept(rng):
    rows = random_rows(rng, 10_000)
    w = R.Walk(code(rows))
    assert len(w.kept) == 100 and len(w.vectors) == 101
    cost, audit, turns = walked(rows)
    fault = [c // 4 for c in code(rows)]
    at, paid = 0, 0
    for e in audit:
        paid += COST[e] + (3 if e in "KR" and fault[at] == R.TRUNCATED else 0)
        at += e != "I"
    assert at == len(rows) and paid == cost
    initials = "".join(r[0] for r, _ in turns)
    assert initials.removeprefix("s") == "ua" * (len(initials) // 2)


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows],
                                 "conv_id long, turn long, role string, text string, code string, same int")


def damaged(rows):
    """conv: its rows after damage, by turn."""
    out = {}
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kept = out.setdefault(conv, [])
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fate == 1:
            text = ""
        if fate == 2:
            text = "".join(c for c in text if c not in ".!?")
        if fate == 4:
            role = "user"
        kept += [(turn, role, text)] * {0: 0, 3: 2}.get(fate, 1)
    key = lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest())
    return {conv: sorted(kept, key=key) for conv, kept in out.items()}


def test_report_equals_brute_force(spark, rng):
    rows = [(conv, turn, role, text) for conv in [*range(60), None]
            for turn, (role, text) in enumerate(random_rows(rng, rng.randint(1, 9)), rng.randint(0, 3))]
    rows += [(3, None, "user", "No turn."), (3, None, None, None), (4, 1, "user", "Tie."), (4, 1, "system", "Tie."),
             (4, 1, "user", "Tie."), (5, 90, "assistant", "line\nbreak. \n"), (6, 2, "user", "long " * 50_000 + ".")]
    rows += [(100 + i, 7, "user", "Alone.") for i in range(40)]  # some of these lose all rows
    got = {r.conv_id: r for r in R.report(table(spark, rows)).collect()}
    want = damaged(rows)
    assert set(got) == set(want) and any(not kept for kept in want.values())
    for conv, kept in want.items():
        said = [(role, text) for _, role, text in kept]
        cost, audit, turns = brute(said)
        r = got[conv]
        fault = [c // 4 for c in code(said)]
        have = {t for t, _, _ in kept if t is not None}
        assert (r.cost, r.audit) == (cost, audit)
        assert r.repaired_sha256 == hashlib.sha256("\n".join(f"{a}:{b}" for a, b in turns).encode()).hexdigest()
        assert (r.blank, r.duplicate, r.truncated) == tuple(fault.count(k) for k in (1, 2, 3))
        assert r.gaps == (max(have) - min(have) + 1 - len(have) if have else 0)
        pairs = [(a[:1], b[:1]) for (a, _), (b, _) in zip(said, said[1:])]
        assert r.illegal == sum(p not in {("s", "u"), ("u", "a"), ("a", "u")} for p in pairs)


def test_repaired_turns_and_no_rows(spark):
    rows = spark.createDataFrame([(1, 0, "assistant", "Hello.", False), (1, 1, "user", "Bye.", False), (2, 5, None, None, True)], ROWS)
    assert [(r.role, r.text) for r in R.repaired(rows).orderBy("step").collect()] == [
        ("user", ""), ("assistant", "Hello."), ("user", "Bye."), ("assistant", "")]
    assert R.report(rows.limit(0).drop("gone")).collect() == []


@pytest.mark.parametrize("size", [1, 2, 5])
def test_small_arrow_batches(spark, size):
    rows = table(spark, [(c, t, "user", f"Said {t}.") for c in range(5) for t in range(7)])
    whole = sorted(R.report(rows).collect())
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    try:
        assert sorted(R.report(rows).collect()) == whole
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
