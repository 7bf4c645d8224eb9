import hashlib
import heapq
import random
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerwatch.llm import repair
from tests.oracle import differences

SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_equals_sql(spark, small, scale):
    folder = small.replace("sf0.001", scale)
    assert differences(repair.op12_structure_repair(spark, folder), repair.ORACLE, folder) == []


def brute(codes: str) -> tuple[str, int]:
    """All edits in order of cost and audit."""
    after = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    heap, done = [(0, "", 0, "")], set()
    while True:
        cost, audit, i, last = heapq.heappop(heap)
        if (i, last) in done:
            continue
        done.add((i, last))
        if i == len(codes) and last in ("", "a"):
            return audit, cost
        needed = "a" if last == "u" else "u"
        heapq.heappush(heap, (cost + 2, audit + "I", i, needed))
        if i < len(codes):
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, last))
            if codes[i] != "-":
                more = codes[i].isupper()
                heapq.heappush(heap, (cost + 2 + more, audit + "R", i + 1, needed))
                if codes[i].lower() in after[last]:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, after[last][codes[i].lower()]))


@pytest.mark.parametrize("span", [1, 3, 8, repair.SPAN])
def test_cheapest_edits_by_brute_force(span):
    rng = random.Random(span)
    for _ in range(800):
        codes = "".join(rng.choice("suaSUAxX-uauaua") for _ in range(rng.randrange(25)))
        assert repair._solved(codes, span) == brute(codes)
        assert repair._bounds(codes)[0] <= brute(codes)[1]


@pytest.mark.parametrize("letters", ["ua", "suaSUA-", "s", "sx", "U-", "x"])
def test_long_conversations(letters):
    rng = random.Random(5)
    codes = "".join(rng.choice(letters) for _ in range(3000))
    assert repair.cheapest(codes) == brute(codes)


def plain(rows):
    """The contract by plain loops over one conversation's rows (turn, role, text) after damage."""
    seen, codes, counts, pairs = set(), "", dict.fromkeys(("blank", "duplicate", "truncated"), 0), 0
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    for k, (_, role, text) in enumerate(rows):
        shown = text.rstrip(repair.SPACES)
        fault = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        codes += repair.code(role[:1], fault in ("blank", "duplicate"), fault == "truncated")
        pairs += k > 0 and rows[k - 1][1][:1] + role[:1] not in ("su", "ua", "au")
    audit, cost = brute(codes)
    out, left, last = [], list(rows), ""
    for edit in audit:
        row = None if edit == "I" else left.pop(0)
        if edit != "D":
            role = row[1] if edit == "K" else "assistant" if last == "u" else "user"
            last = role[0]
            out.append((role, row[2] if row else ""))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return {"gaps": gaps, **counts, "illegal": pairs, "cost": cost, "audit": audit}, out


ROWS = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hi?"), (1, 2, "assistant", "Hello."), (2, 0, "assistant", "I first."), (2, 5, "user", "cut off here"),
    (2, 5, "user", "cut off here"), (2, None, "human", "\x0b\n"), (2, None, None, None), (3, 1, "user", " \t"), (3, 2, "", "role is empty!"), (None, 7, "user", "No id. \r\n"),
    (None, 9, "assistant", "日本。"), (4, 1, "sysop", "s!"), (4, 2, "ultra", "u!"), (4, 3, "a", "a!"), (4, 3, "b", "\xa0"), (5, 3, "system", "x" * 30_000 + "."), (5, 4, "system", "late."), (5, 9, "user", "Same."), (5, 10, "user", "Same."),
    *[(6, k, ("user", "assistant")[k % 3 == 1], f"Row {k}" + "." * (k % 4 > 0)) for k in range(200)], *[(7, 1, "user", "Again and again.")] * 50,
]


@pytest.fixture
def rows(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(4)
    return df.withColumns({c: F.lit("x") for c in ("pass", "nth", "shown", "fault", "digest", "audit", "copy", "times")})


def own(conv, rows):
    return [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv]


def test_rows_as_given(spark, rows):
    """No damage: every edge case against plain loops, texts included."""
    given = rows.withColumn("dropped", F.lit(False))
    found = {r["conv_id"]: r.asDict() for r in repair.audits(given).collect()}
    turns = repair.repaired(given).orderBy("conv_id", "place").collect()
    assert set(found) == {c for c, *_ in ROWS}
    for conv, row in found.items():
        facts, out = plain(own(conv, ROWS))
        assert {k: row[k] for k in facts} == facts
        assert [(t["role"], t["text"]) for t in turns if t["conv_id"] == conv] == out
        assert row["repaired_sha256"] == hashlib.sha256("\n".join(f"{r}:{x}" for r, x in out).encode()).hexdigest()


def test_damage(spark, rows):
    after = []
    for conv, turn, role, text in ROWS:
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fate == 1 else text.translate({ord(c): None for c in ".!?"}) if fate == 2 else text
        after += [(conv, turn, "user" if fate == 4 else role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    found = {r["conv_id"]: r.asDict() for r in repair.audits(repair.damaged(rows)).collect()}
    assert set(found) == {c for c, *_ in ROWS}
    for conv, row in found.items():
        facts, _ = plain(own(conv, after))
        assert {k: row[k] for k in facts} == facts


def test_all_rows_dropped(spark):
    rows = spark.createDataFrame([(1, 1, "user", "x")], SCHEMA).withColumn("dropped", F.lit(True))
    row = repair.audits(rows).first().asDict()
    assert row == {"conv_id": 1, **dict.fromkeys(("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), 0), "audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    assert repair.repaired(rows).count() == 0


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.audits(repair.damaged(empty)).count() == 0


def test_one_shuffle(spark, small):
    plan = repair.op12_structure_repair(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
