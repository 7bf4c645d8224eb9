"""Repair of conversation structure by iterative-deepening A* over edits.

The rows of a conversation, by turn, are kept, given the role user or assistant, or deleted, and empty turns are inserted, so that
the initials of the roles read `(s?(ua)+)?`. Keep costs 0, Rerole and Insert 2, Delete 3; a truncated row that stays
costs 1 more, and blank or duplicate rows must go. Among the cheapest edits those whose initials (D, I, K, R) come first
in ASCII order win.

A state is a number of rows done and what came last. The search goes depth first, edits in ASCII order, under a bound on the whole
cost; the bound rises to the least cost that exceeded it. A state that failed is noted with the least cost it
still needs, and is entered again only with that much left, so the first accepting path is the answer. The needs begin with a bound that never
exceeds the truth: rows that must go, truncated rows, and 2 for each of a greatest set of disjoint pairs of
neighbours that cannot stay as they are. Conversations of more than SPAN rows are searched from every SPAN-th row, the last first,
so that each search is guided by exact needs at most SPAN rows ahead.

A fault is the first of: blank (no character but space and tab to carriage return), duplicate (role and text as in
an earlier row), truncated (last such character not one of `.!?`). Rows sort by turn, nulls first, then by role and by the MD5 of the
text. Null texts and roles count as one space; rows with a null conv_id are one conversation. Roles are compared as they are;
only their first character matters to the structure. Repeated rows are rows each.

A conversation is one answer here: its digest must see all of its text in order. Its rows stream through one task, sorted by
Spark. That task holds no text: a byte per row, four bounds per row for the search, and the path of the search, some hundred bytes per row in
all; the audit that it returns has a byte per row as well.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerwatch.llm import text as X

SPAN = 64
SPACES = " \t\n\x0b\x0c\r"
REROLE, INSERT, DELETE, TRUNCATED = 2, 2, 3, 1
# What came last: nothing, a system turn, a user turn, an assistant turn. Only user may follow, but for assistant after user.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
#: State after keeping a row, by state and initial; absent where the row cannot stay.
_KEPT = {(_START, "s"): _SYSTEM, (_START, "u"): _USER, (_SYSTEM, "u"): _USER, (_USER, "a"): _ASSISTANT, (_ASSISTANT, "u"): _USER}
_LEGAL = ("su", "ua", "au")
_ROLES = {_USER: "user", _ASSISTANT: "assistant"}
# A row as one byte: its initial in lower case, in upper case if truncated, or this if it must go.
_GONE = "-"


def code(initial: str, must_go: bool, truncated: bool) -> str:
    if must_go:
        return _GONE
    letter = initial if initial in ("s", "u", "a") else "x"
    return letter.upper() if truncated else letter


def _bounds(codes: str) -> list[int]:
    """For each state a cost that no way to the end undercuts: place 4 i + q is i rows done after q."""
    n = len(codes)
    needs = [0] * (4 * (n + 1))
    # Pairs of the rest by its first row that may stay: greatest number of disjoint ones, and the same without that row.
    cost, first, pairs, later = 0, None, 0, 0
    for i in range(n, -1, -1):
        if i < n:
            c = codes[i]
            if c == _GONE:
                cost += DELETE
            else:
                cost += TRUNCATED * c.isupper()
                c = c.lower()
                if c == "x":  # must be edited, whatever its neighbours are
                    pairs, later = pairs + 1, pairs + 1
                elif first == "x":
                    later = pairs
                else:
                    bad = c != "a" if first is None else c + first not in _LEGAL
                    pairs, later = max(pairs, bad + later), pairs
                first = c
        for q in range(4):
            if first is None:
                bad = q in (_SYSTEM, _USER)
            else:
                bad = first != "x" and (q, first) not in _KEPT
            needs[4 * i + q] = cost + REROLE * max(pairs, bad + later)
    return needs


def _search(codes: str, needs: list[int], i: int, q: int, until: int | None = None) -> tuple[str, int]:
    """Edits from a state to the end, or to row `until` where all needs are exact, and the whole cost. Raises `needs` of states that fail."""
    n, root = len(codes), 4 * i + q
    until = n if until is None else until
    while True:
        bound = needs[root]
        # A frame: state, cost left, edits to try (the last first), the least cost found so far, the edit taken.
        stack = [[root, bound, None, 1 << 60, ""]]
        while stack:
            frame = stack[-1]
            state, left, edits = frame[0], frame[1], frame[2]
            at, last = state >> 2, state & 3
            if edits is None:
                if (last in (_START, _ASSISTANT)) if at == n else at == until:
                    # A cheapest way, so what is left of it is what each of its states needs.
                    rest = left - needs[state]
                    for done in stack:
                        needs[done[0]] = done[1] - rest
                    return "".join(done[4] for done in stack[:-1]), bound - rest
                edits = frame[2] = []
                to = _NEXT[last]
                if at < n:
                    c = codes[at]
                    if c != _GONE:
                        more = TRUNCATED * c.isupper()
                        edits.append(("R", 4 * at + 4 + to, REROLE + more))
                        kept = _KEPT.get((last, c.lower()))
                        if kept is not None:
                            edits.append(("K", 4 * at + 4 + kept, more))
                edits.append(("I", 4 * at + to, INSERT))
                if at < n:
                    edits.append(("D", 4 * at + 4 + last, DELETE))
            if edits:
                letter, child, price = edits.pop()
                need = price + needs[child]
                if need > left:
                    frame[3] = min(frame[3], need)
                else:
                    frame[4] = letter
                    stack.append([child, left - price, None, 1 << 60, ""])
                continue
            # Failed: what it needs is the least that any edit needs.
            needs[state] = max(needs[state], frame[3])
            stack.pop()
            if stack:
                above = stack[-1]
                above[3] = min(above[3], above[1] - left + needs[state])


def _solved(codes: str, span: int) -> tuple[str, int]:
    n, needs = len(codes), _bounds(codes)
    for i in range((n - 1) // span * span, -1, -span) if n > span else ():
        until, short = min(i + span, n), 0
        if until < n:
            # No way gets past row `until` cheaper than its exact needs say: the bounds before it rise by what they were short there.
            short = min(needs[4 * until + q] - ends[q] for q in range(4))
        ends = needs[4 * i : 4 * i + 4]
        for k in range(4 * i, 4 * until):
            needs[k] += short
        for q in range(4 if i else 1):
            _search(codes, needs, i, q, until)
    return _search(codes, needs, 0, _START)


@lru_cache(1 << 16)
def _remembered(codes: str) -> tuple[str, int]:
    return _solved(codes, SPAN)


def cheapest(codes: str, span: int = SPAN) -> tuple[str, int]:
    """The audit and the cost of rows given by their `code`."""
    return _remembered(codes) if len(codes) <= SPAN == span else _solved(codes, span)


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, dropped: faults planted by a checksum of conversation and turn; dropped rows stay as marks."""
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    fate = F.pmod(F.crc32(name.cast("binary")), F.lit(20))
    changed = F.when(fate == 1, "").when(fate == 2, F.translate(text, ".!?", "")).otherwise(text)
    rows = conversations.select(
        "conv_id", "turn", F.when(fate == 4, "user").otherwise(role).alias("role"), changed.alias("text"), (fate == 0).alias("dropped"), F.when(fate == 3, 2).otherwise(1).alias("times")
    )
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times")))).select("conv_id", "turn", "role", "text", "dropped")


def _sorted(rows: DataFrame) -> DataFrame:
    """The rows of each conversation twice, in order: once for their structure, then once with the texts that may stay."""
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    own = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.md5(text.cast("binary")).alias("digest"), F.coalesce("dropped", F.lit(False)).alias("dropped"))
    # All that follows keeps to this one shuffle.
    own = own.repartition("conv_id")
    earlier = Window.partitionBy("conv_id", "dropped", "role", "digest").orderBy(F.asc_nulls_first("turn"))
    shown = F.rtrim("text", F.lit(SPACES))
    own = own.withColumns({"nth": F.row_number().over(earlier), "shown": shown})
    fault = F.when(F.col("shown") == "", "blank").when(F.col("nth") > 1, "duplicate").when(~F.right("shown", F.lit(1)).isin(".", "!", "?"), "truncated")
    own = own.select("conv_id", "turn", "role", "digest", "text", "dropped", fault.alias("fault"))
    stays = (F.col("pass") == 1) & ~F.col("dropped") & F.coalesce(~F.col("fault").isin("blank", "duplicate"), F.lit(True))
    twice = own.withColumn("pass", F.explode(F.array(F.lit(0), F.lit(1))))
    lean = twice.select("conv_id", "pass", "turn", "role", "digest", "dropped", "fault", F.when(stays, F.col("text")).alias("text"))
    return lean.sortWithinPartitions("conv_id", "pass", F.asc_nulls_first("turn"), "role", "digest").drop("digest")


def _lines(audit: str, rows: Iterator[tuple]) -> Iterator[tuple[str, str]]:
    """Role and text of the repaired turns; `rows` gives the role and text of each row."""
    last = _START
    for edit in audit:
        if edit == "D":
            next(rows)
            continue
        role, text = (None, "") if edit == "I" else next(rows)
        last = _NEXT[last] if edit != "K" else _KEPT[last, role[0]]
        yield (role if edit == "K" else _ROLES[last]), text


class _Structure:
    """What the first reading of a conversation gathers: counts, and a byte per row."""

    def __init__(self):
        self.codes = bytearray()
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.illegal = self.turns = 0
        self.least = self.most = self.initial = None

    def add(self, turn, role: str, fault):
        if turn is not None:
            self.turns += turn != self.most
            self.least, self.most = turn if self.least is None else self.least, turn
        initial = role[:1]
        if self.codes:
            self.illegal += self.initial + initial not in _LEGAL
        self.initial = initial
        if fault:
            self.counts[fault] += 1
        self.codes += code(initial, fault in ("blank", "duplicate"), fault == "truncated").encode()

    def row(self) -> dict:
        audit, cost = cheapest(self.codes.decode())
        gaps = 0 if self.most is None else self.most - self.least + 1 - self.turns
        return {"gaps": gaps, **self.counts, "illegal": self.illegal, "cost": cost, "audit": audit}


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for part in X.slices(batch):
            yield from zip(*(part.column(c).to_pylist() for c in ("conv_id", "pass", "turn", "role", "dropped", "fault", "text")), strict=True)


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, structure, repaired turns) one after the other; the turns must be read before the next conversation is."""
    rows = _rows(batches)
    row = next(rows, None)
    while row is not None:
        conv, structure = row[0], _Structure()
        while row is not None and row[0] == conv and row[1] == 0:
            if not row[4]:
                structure.add(row[2], row[3], row[5])
            row = next(rows, None)
        facts = structure.row()
        del structure

        def texts(own):
            nonlocal row
            while row is not None and row[0] == own and row[1] == 1:
                if not row[4]:
                    yield row[3], row[6]
                row = next(rows, None)

        again = texts(conv)
        yield conv, facts, _lines(facts["audit"], again)
        for _ in again:  # rows deleted at the end, and marks
            pass


_AUDIT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_TURNS = "conv_id long, place long, role string, text string"


def audits(rows: DataFrame) -> DataFrame:
    """One row per conversation of (conv_id, turn, role, text, dropped): faults, the cheapest edits and a digest of the repaired turns."""
    into = X.arrow_schema(_AUDIT)

    def run(batches):
        made = {f.name: [] for f in into}
        for conv, facts, turns in _conversations(batches):
            digest, between = hashlib.sha256(), b""
            for role, text in turns:
                digest.update(between + f"{role}:".encode() + text.encode())
                between = b"\n"
            for name, value in {"conv_id": conv, **facts, "repaired_sha256": digest.hexdigest()}.items():
                made[name].append(value)
            if len(made["conv_id"]) >= 4096 or len(facts["audit"]) > X.SLICE_BYTES:
                yield X.record(made, into)
                made = {f.name: [] for f in into}
        yield X.record(made, into)

    return _sorted(rows).mapInArrow(run, _AUDIT)


def repaired(rows: DataFrame) -> DataFrame:
    """conv_id, place, role, text: the turns of the repaired conversations; one left without turns has none."""
    into = X.arrow_schema(_TURNS)

    def run(batches):
        made, held = {f.name: [] for f in into}, 0
        for conv, _, turns in _conversations(batches):
            for place, (role, text) in enumerate(turns):
                for name, value in {"conv_id": conv, "place": place, "role": role, "text": text}.items():
                    made[name].append(value)
                held += len(text) + 64
                if held > X.SLICE_BYTES:
                    yield X.record(made, into)
                    made, held = {f.name: [] for f in into}, 0
        yield X.record(made, into)

    return _sorted(rows).mapInArrow(run, _TURNS)


def op12_structure_repair(spark: SparkSession, folder: str) -> DataFrame:
    return audits(damaged(spark.read.parquet(f"{folder}/conversations.parquet")))


ORACLE = r"""
WITH RECURSIVE named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT) AS bytes
  FROM conversations
), fated AS (
  SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT], bytes), lambda crc, b:
    list_reduce(list_concat([xor(crc, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, z: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 20 AS fate
  FROM named
), after AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN fate = 1 THEN '' WHEN fate = 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM fated, (SELECT unnest([1, 2]) AS copy) WHERE fate <> 0 AND (copy = 1 OR fate = 3)
), ordered AS (
  SELECT *, rtrim(text, E' \t\n\x0b\x0c\r') AS shown, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i,
    lag(role[1]) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) || role[1] AS pair
  FROM after
), faulted AS (
  SELECT *, CASE WHEN shown = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault FROM ordered
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM faulted GROUP BY 1
), rows AS (
  SELECT conv_id, i, role, text, role[1] AS c, coalesce(fault IN ('blank', 'duplicate'), false) AS gone, coalesce(fault = 'truncated', false)::BIGINT AS t FROM faulted
), steps AS (
  -- Per state (nothing, s, u, a) the cheapest way there so far: cost, audit, repaired text; inserts follow each row.
  SELECT conv_id, 0::BIGINT AS i, {'c': 0::BIGINT, 'a': '', 'r': ''} AS qn, NULL::STRUCT(c BIGINT, a VARCHAR, r VARCHAR) AS qs,
    {'c': 2::BIGINT, 'a': 'I', 'r': E'\nuser:'} AS qu, {'c': 4::BIGINT, 'a': 'II', 'r': E'\nuser:\nassistant:'} AS qa FROM counted
  UNION ALL
  SELECT conv_id, i, qn, qs,
    list_min(list_filter([u, CASE WHEN qn IS NOT NULL THEN {'c': qn.c + 2, 'a': qn.a || 'I', 'r': qn.r || E'\nuser:'} END,
      CASE WHEN qs IS NOT NULL THEN {'c': qs.c + 2, 'a': qs.a || 'I', 'r': qs.r || E'\nuser:'} END,
      {'c': a.c + 2, 'a': a.a || 'I', 'r': a.r || E'\nuser:'}], lambda x: x IS NOT NULL)) AS qu,
    list_min(list_filter([a, {'c': u.c + 2, 'a': u.a || 'I', 'r': u.r || E'\nassistant:'},
      CASE WHEN qn IS NOT NULL THEN {'c': qn.c + 4, 'a': qn.a || 'II', 'r': qn.r || E'\nuser:\nassistant:'} END,
      CASE WHEN qs IS NOT NULL THEN {'c': qs.c + 4, 'a': qs.a || 'II', 'r': qs.r || E'\nuser:\nassistant:'} END], lambda x: x IS NOT NULL)) AS qa
  FROM (
    SELECT s.conv_id, r.i,
      {'c': qn.c + 3, 'a': qn.a || 'D', 'r': qn.r} AS qn,
      list_min(list_filter([CASE WHEN qs IS NOT NULL THEN {'c': qs.c + 3, 'a': qs.a || 'D', 'r': qs.r} END,
        CASE WHEN NOT gone AND r.c = 's' THEN {'c': qn.c + t, 'a': qn.a || 'K', 'r': qn.r || E'\n' || role || ':' || text} END], lambda x: x IS NOT NULL)) AS qs,
      list_min(list_filter([{'c': qu.c + 3, 'a': qu.a || 'D', 'r': qu.r}] || list_transform(list_filter([qn, qs, qa], lambda x: x IS NOT NULL AND NOT gone), lambda x:
        CASE WHEN r.c = 'u' THEN {'c': x.c + t, 'a': x.a || 'K', 'r': x.r || E'\n' || role || ':' || text}
             ELSE {'c': x.c + t + 2, 'a': x.a || 'R', 'r': x.r || E'\nuser:' || text} END), lambda x: x IS NOT NULL)) AS u,
      list_min(list_filter([{'c': qa.c + 3, 'a': qa.a || 'D', 'r': qa.r}] || list_transform(list_filter([qu], lambda x: NOT gone), lambda x:
        CASE WHEN r.c = 'a' THEN {'c': x.c + t, 'a': x.a || 'K', 'r': x.r || E'\n' || role || ':' || text}
             ELSE {'c': x.c + t + 2, 'a': x.a || 'R', 'r': x.r || E'\nassistant:' || text} END), lambda x: x IS NOT NULL)) AS a
    FROM steps s JOIN rows r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.i = s.i + 1
  )
), best AS (SELECT conv_id, least(qn, qa) AS b FROM steps JOIN counted USING (conv_id) WHERE i = n)
SELECT d.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(b.c, 0) AS cost, coalesce(b.a, '') AS audit, sha256(coalesce(b.r[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) d LEFT JOIN counted USING (conv_id) LEFT JOIN best USING (conv_id)
"""
