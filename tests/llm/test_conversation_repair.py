"""Conversation repair against all edit scripts of short conversations, and its edge rows."""

from __future__ import annotations

import hashlib
import heapq
import itertools
import re
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from lakemart.llm import conversation_repair as cr
from lakemart.llm.queries import op13_conversation_repair

SPACES = " \t\n\x0b\x0c\r"
GOOD = re.compile(r"(s?(ua)+)?\Z")


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.rstrip(SPACES)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, edits, lines) by Dijkstra over (rows read, lines written), ASCII-least among equals; nothing of the automaton."""
    faults = faults_of(rows)
    heap = [(0, "", 0, ())]
    most = 2 * len(rows) + 2
    done = set()
    while heap:
        cost, edits, i, lines = heapq.heappop(heap)
        initials = "".join(x[0][:1] or "?" for x in lines)
        if i == len(rows) and GOOD.match(initials):
            return cost, edits, lines
        if (i, initials, edits) in done or len(lines) > most or not any(GOOD.match(initials + e) for e in ("", "a", "ua", "uaua")):
            continue
        done.add((i, initials, edits))
        for role in ("user", "assistant"):
            heapq.heappush(heap, (cost + 3, edits + "I", i, (*lines, (role, ""))))
        if i == len(rows):
            continue
        _, role, text = rows[i]
        heapq.heappush(heap, (cost + 4, edits + "D", i + 1, lines))
        if faults[i] in ("", "truncated"):
            extra = 3 if faults[i] else 0
            heapq.heappush(heap, (cost + extra, edits + "K", i + 1, (*lines, (role, text))))
            for to in ("user", "assistant"):
                heapq.heappush(heap, (cost + extra + 3, edits + "R", i + 1, (*lines, (to, text))))


def plain(rows):
    """The digest columns of one conversation's rows, given in order."""
    faults = faults_of(rows)
    cost, edits, lines = cheapest(rows)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
    return (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, edits, sha)


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def audited(spark, rows, **kwargs):
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return {r[0]: tuple(r[1:]) for r in cr.audit(cr.repair_conversations(turns, **kwargs)).collect()}


def test_every_short_conversation(spark):
    """All role sequences up to five rows, with sound, truncated and blank texts in turn."""
    rows, want, conv = [], {}, 0
    for n in range(1, 6):
        for k, roles in enumerate(itertools.product(("system", "user", "assistant", "x"), repeat=n)):
            own = []
            for i, role in enumerate(roles):
                text = ("fine.", "cut off", " \t", f"{i}!", f"{i} ?\n")[(k * 7 + i * 3 + i * i * k) % 5]
                own.append((i + (i > 2), role, text))
            rows += [(conv, *r) for r in own]
            want[conv] = plain(order(own))
            conv += 1
    assert audited(spark, rows) == want


def spoil(table):
    """The contract's damage, row by row."""
    convs: dict = {}
    for conv, turn, role, text in table:
        own = convs.setdefault(conv, [])
        kind = crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if role is None else role), (" " if text is None else text)
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        own += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return {c: plain(order(r)) for c, r in convs.items()}


@pytest.mark.parametrize("batch", ["2", "512"])
def test_query_equals_plain_reading(spark, sf_small, batch):
    table = spark.read.parquet(f"{sf_small}/conversations.parquet").select("conv_id", "turn", "role", "text")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        turns = cr.damage(table)
        got = cr.audit(cr.repair_conversations(turns, present=~F.col("dropped"))).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    assert {r[0]: tuple(r[1:]) for r in got} == spoil(map(tuple, table.collect()))


def test_query_equals_its_sql(spark, sf_small):
    import duckdb

    from lakemart.llm.queries import ORACLE_SQL

    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf_small}/conversations.parquet'")
    want = con.execute(ORACLE_SQL["op13_conversation_repair"]).fetchall()
    assert sorted(map(tuple, op13_conversation_repair(spark, sf_small).collect())) == sorted(want)


def test_nulls_ties_repeats_and_dropped(spark):
    rows = [
        (None, None, None, None), (None, 3, "user", "a."), (None, 3, "assistant", "b."),
        (1, 0, "user", "q?"), (1, 0, "user", "q?"), (1, 1, "assistant", "a."), (1, 5, "", "x."),
        (2, 0, "user", None), (3, None, "user", "q"), (3, 4, "assistant", "é" * 100_000 + "."),
        (4, -2, "system", "s."), (4, 9, "User", "no."),
    ]
    rows += [(5, 0, "assistant", "dropped")]
    want = spoil([])
    for conv in {r[0] for r in rows}:
        own = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv and c != 5]
        want[conv] = plain(order(own))
    got = audited(spark, rows, present=F.coalesce(F.col("conv_id") != 5, F.lit(True)))
    assert got == want
    assert got[5] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_clashing_columns_empty_table_and_real_outputs(spark):
    rows = [("c", 0, "user", "q?", 1, 2, "z"), ("c", 1, "user", "again?", 1, 2, "z"), ("c", 2, "assistant", "a", 1, 2, "z")]
    turns = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string, seq int, fault int, conv string")
    edits = cr.repair_conversations(turns)
    assert [(r.step, r.edit, r.fault) for r in edits.orderBy("step").collect()] == [(0, "K", ""), (1, "I", None), (2, "K", ""), (3, "K", "truncated")]
    assert [tuple(r) for r in cr.mended(edits).orderBy("step").collect()] == [("c", 0, "user", "q?"), ("c", 1, "assistant", ""), ("c", 2, "user", "again?"), ("c", 3, "assistant", "a")]
    assert cr.audit(cr.repair_conversations(turns.limit(0))).count() == 0


def test_one_shuffle(spark):
    turns = spark.createDataFrame([(1, 0, "user", "q")], "conv_id long, turn long, role string, text string")
    plan = cr.audit(cr.repair_conversations(turns))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_long_conversation(spark):
    n = 30_000
    turns = spark.range(n).select(
        F.lit(1).alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.col("id").cast("string"), F.lit(".")).alias("text"),
    )
    row = cr.audit(cr.repair_conversations(turns)).first()
    assert (row.cost, row.audit, row.illegal, row.gaps) == (0, "K" * n, 0, 0)
