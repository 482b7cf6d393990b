"""Conversation repair against every edit sequence that could matter, and on odd rows."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from farestrata.llm import conversations, queries
from farestrata.llm.common import table

SCHEMA = "conv_id bigint, turn bigint, role string, text string, cost int, audit int, part int"
SOUND = re.compile(r"(s?(ua)+)?")
BEGINNING = re.compile(r"(s?(ua)*u?)?")
SPACES = " \t\n\x0b\x0c\r"


def damaged(rows):
    """The contract's damage, row by row."""
    out = []
    for conv, turn, role, text in rows:
        name = ":".join(" " if v is None else str(v) for v in (conv, turn))
        hit = zlib.crc32(name.encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        if hit == 0:
            continue
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        out += [(conv, turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)
    return out


def judged(rows):
    """Faults and edits of one conversation's rows, by trying all edits whose initials can still become sound."""
    digest = lambda text: hashlib.md5(text.encode()).hexdigest()
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], digest(r[3])))
    seen, faults = set(), []
    for _, _, role, text in rows:
        bare = text.strip(SPACES)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    best = [None]

    def go(at, cost, audit, initials, kept, inserted):
        if best[0] and cost > best[0][0] or not BEGINNING.fullmatch(initials):
            return
        if at == len(rows) and SOUND.fullmatch(initials):
            best[0] = min(filter(None, (best[0], (cost, audit, kept))), key=lambda b: b[:2])
        if inserted < 3:
            for role in ("user", "assistant"):
                go(at, cost + 3, audit + "I", initials + role[0], [*kept, f"{role}:"], inserted + 1)
        if at < len(rows):
            _, _, role, text = rows[at]
            go(at + 1, cost + 4, audit + "D", initials, kept, 0)
            if faults[at] in ("", "truncated"):
                more = 3 * (faults[at] == "truncated")
                if role:
                    go(at + 1, cost + more, audit + "K", initials + role[0], [*kept, f"{role}:{text}"], 0)
                for new in ("user", "assistant"):
                    go(at + 1, cost + more + 3, audit + "R", initials + new[0], [*kept, f"{new}:{text}"], 0)

    go(0, 0, "", "", [], 0)
    cost, audit, kept = best[0]
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = zip(rows, rows[1:], strict=False)
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in pairs)
    digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
    return gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest


def expected(rows):
    convs = defaultdict(list)
    for row in rows:
        convs[row[0]]
    for row in damaged(rows):
        convs[row[0]].append(row)
    return {conv: judged(own) for conv, own in convs.items()}


def repaired(frame):
    rows = conversations.faults(conversations.damage(frame))
    return {r[0]: tuple(r)[1:] for r in conversations.repair_digests(rows, conversations.verdicts(rows)).collect()}


@pytest.fixture(scope="module")
def odd():
    rng = random.Random(5)
    rows = []
    for conv in [*range(60), None]:
        for n in range(rng.choice([1, 1, 2, 3, 5])):
            turn = n if rng.random() < 0.7 else rng.choice([None, 0, 1, 9])
            role = rng.choice(["user", "assistant", "system", "user", "assistant", None, "", "tool"])
            text = rng.choice([None, "", " \t", "Yes.", "No", "Why? ", f"Go on {n}!\n"])
            rows.append((conv, turn, role, text))
    return rows + [(900, None, "user", "x.")] * 3 + [(901, 5, "user", "same"), (901, 5, "user", "same"), (901, 5, "assistant", "é.")]


@pytest.mark.parametrize("partitions", [1, 7])
def test_repair_against_all_edits(spark, odd, partitions):
    frame = spark.createDataFrame([(*row, 1, 2, 3) for row in odd], SCHEMA)
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found, wanted = repaired(frame), expected(odd)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found.keys() == wanted.keys()
    assert {k: (found[k], wanted[k]) for k in wanted if found[k] != wanted[k]} == {}


def test_query_against_all_edits(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").collect()]
    found = {r[0]: tuple(r)[1:] for r in queries.op11_conversation_repair(spark, folder).collect()}
    assert found == expected(rows)


def test_blocks_and_pieces_change_nothing(spark, monkeypatch):
    """One long conversation by one run of the agenda, by blocks of four rows, and spread over tasks."""
    rng = random.Random(9)
    rows = [(rng.choice("usaat"), rng.choice([0, 0, 0, 1, 2, 3]), rng.choice([1, 1, 1, 3])) for _ in range(150)]
    steps = [conversations.moves(*row) for row in rows]
    wanted = conversations.lightest(steps, conversations.ENDS, (0,))[0]
    monkeypatch.setattr(conversations, "BLOCK", 4)
    stretch = conversations.Stretch()
    for initial, fault, copies in rows:
        stretch.add(None, initial, copies, fault)
    found = stretch.piece(0, False)
    assert (found["cost"], found["audit"]) == wanted
    parts = [conversations.joined(steps[i:i + 37]) for i in range(0, 150, 37)]
    assert conversations.lightest(parts, conversations.ENDS, (0,))[0] == wanted


def test_a_hot_conversation_of_copies(spark):
    rows = [(1, 1, "user", "again and again")] * 4_000 + [(1, n, "assistant", f"{n}.") for n in range(2, 600)] + [(2, 0, "user", "x.")]
    frame = spark.createDataFrame([(*row, 1, 2, 3) for row in rows], SCHEMA).repartition(6)
    known = conversations.faults(conversations.whole(frame))
    verdict = {r.conv_id: r for r in conversations.verdicts(known).collect()}[1]
    assert (verdict.duplicate, verdict.truncated, verdict.gaps) == (3_999, 1, 0)
    assert verdict.audit.count("D") >= 3_999 and len(verdict.audit.replace("I", "")) == 4_598
    turns = conversations.repaired_turns(known, conversations.verdicts(known)).where("conv_id = 1").orderBy("position").collect()
    assert SOUND.fullmatch("".join(t.role[0] for t in turns))
    assert [t.edit for t in turns] == [letter for letter in verdict.audit if letter != "D"]


def test_no_conversations(spark):
    assert repaired(spark.createDataFrame([], SCHEMA)) == {}
