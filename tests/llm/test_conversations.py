import hashlib
import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from ratingloom.llm import conversations as conv

ROWS = "conv_id bigint, turn bigint, role string, text string"
FULL = {"s": "system", "u": "user", "a": "assistant"}
STEP = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}


def damaged_by_hand(rows):
    out = []
    for c, turn, role, text in rows:
        key = f"{' ' if c is None else c}:{' ' if turn is None else turn}"
        role, text, fault = " " if role is None else role, " " if text is None else text, zlib.crc32(key.encode()) % 20
        if fault == 1:
            text = ""
        if fault == 2:
            text = text.translate({ord(x): None for x in ".!?"})
        out += [] if fault == 0 else [(c, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def faults(rows):
    seen, found = set(), []
    for _, role, text in rows:
        bare = text.rstrip("\x20\x09\x0a\x0b\x0c\x0d")
        found.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return found


def cheapest(rows):
    """(cost, audit, messages) by keeping the whole audit of every state."""
    flaws = faults(rows)
    states = {"": (0, "", ())}
    for (_, role, text), flaw in zip(rows, flaws, strict=True):
        wider = dict(states)
        for _ in range(3):
            wider = inserted(wider)
        fresh = {}

        def offer(state, cost, audit, said):
            if state not in fresh or (cost, audit) < fresh[state][:2]:
                fresh[state] = (cost, audit, said)

        for state, (cost, audit, said) in wider.items():
            offer(state, cost + 2, audit + "D", said)
            if flaw in ("blank", "duplicate"):
                continue
            more = 5 * (flaw == "truncated")
            if (state, role[:1]) in STEP:
                offer(STEP[state, role[:1]], cost + more, audit + "K", (*said, (role, text)))
            for to in "ua":
                if (state, to) in STEP:
                    offer(STEP[state, to], cost + more + 1, audit + "R", (*said, (FULL[to], text)))
        states = fresh
    for _ in range(3):
        states = inserted(states)
    return min(value for state, value in states.items() if state in ("", "a"))


def inserted(states):
    out = dict(states)
    for state, (cost, audit, said) in states.items():
        for to in "ua":
            if (state, to) in STEP:
                offer = (cost + 5, audit + "I", (*said, (FULL[to], "")))
                if to not in out or offer[:2] < out[to][:2]:
                    out[to] = offer
    return out


def by_hand(rows):
    """What op13 has to return, conversation by conversation."""
    reports = {}
    kept = damaged_by_hand(rows)
    for c in {r[0] for r in rows}:
        own = sorted(
            ((turn, role, text) for d, turn, role, text in kept if d == c),
            key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()),
        )
        flaws, turns = faults(own), [t for t, _, _ in own if t is not None]
        cost, audit, said = cheapest(own)
        pairs = zip(own, own[1:])
        reports[c] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(flaws.count(flaw) for flaw in ("blank", "duplicate", "truncated")),
            sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairs),
            cost,
            audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest(),
        )
    return reports


def random_rows(seed, conversations=60):
    rng = random.Random(seed)
    rows = []
    for c in range(conversations):
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant", "assistant", "user", "system", "User", "tool", ""])
            text = rng.choice(["Yes.", "No", "Why?", " \n", "", "So. ", f"Text {rng.random():.3f}!", "open \t"])
            rows.append((c, rng.choice([turn, turn, turn + 2]), role, text))
    return rows


def reports(frame):
    return {r.conv_id: tuple(r)[1:] for r in conv.repair_plans(conv.damaged(frame)).collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_reports_equal_the_search_over_whole_audits(spark, seed):
    rows = random_rows(seed)
    random.Random(seed).shuffle(rows)
    assert reports(spark.createDataFrame(rows, ROWS).repartition(5)) == by_hand(rows)


def test_every_short_conversation(spark):
    """All role patterns of up to four messages, each whole or cut."""
    told = [("s", "A."), ("u", "B."), ("a", "C."), ("u", "d"), ("a", "e"), ("t", "F.")]
    rows = []
    for number, pattern in enumerate(p for n in range(1, 5) for p in itertools.product(told, repeat=n)):
        rows += [(number, i, FULL.get(r, "tool"), f"{i}{text}") for i, (r, text) in enumerate(pattern)]
    assert reports(spark.createDataFrame(rows, ROWS)) == by_hand(rows)


def test_repaired_messages_have_the_hash(spark):
    frame = conv.damaged(spark.createDataFrame(random_rows(3), ROWS))
    plans = conv.repair_plans(frame).collect()
    told = {}
    for r in sorted(conv.repaired(frame, conv.repair_plans(frame)).collect(), key=lambda r: (r.conv_id, r.place)):
        told.setdefault(r.conv_id, []).append(r)
    for plan in plans:
        own = told.get(plan.conv_id, [])
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in own).encode()).hexdigest() == plan.repaired_sha256
        assert "".join(r.edit for r in own) == plan.audit.replace("D", "")


def test_state_goes_over_batches_and_choices_over_files(spark, conf, monkeypatch):
    rows = [(1, i, ("user", "assistant", "user")[i % 3], f"{i}{'.' if i % 7 else ''}") for i in range(700)] + random_rows(4, 9)
    expected = by_hand(rows)
    conf(spark__sql__execution__arrow__maxRecordsPerBatch="3")
    assert reports(spark.createDataFrame(rows, ROWS)) == expected

    monkeypatch.setattr(conv, "SPILL", 64)
    kept = sorted((t, role, text) for c, t, role, text in damaged_by_hand(rows) if c == 1)
    conversation = conv._Open()
    for (turn, role, text), flaw in zip(kept, faults(kept), strict=True):
        conversation.read(turn, role, text, *(flaw == name for name in ("blank", "duplicate", "truncated")))
    assert conversation.choices.file is not None
    assert tuple(conversation.close().values()) == expected[1]


def test_one_conversation_with_a_third_of_all_rows(spark):
    rows = random_rows(5, 300)
    rows += [(7, None, "user", "same.")] * 400 + [(7, i, "assistant", "same.") for i in range(300)]
    assert reports(spark.createDataFrame(rows, ROWS)) == by_hand(rows)


def test_odd_rows(spark):
    rows = [(None, None, None, None), (None, 1, "user", "Hi."), (1, 5, "user", None), (2, None, None, "Hm."), (3, -4, "assistant", "x" * 2_000_000 + "."),
            (4, 1, "user", "A."), (4, 1, "user", "A."), (5, -(2**62), "user", "a."), (5, 2**62, "assistant", "b.")]
    frame = spark.createDataFrame(rows, ROWS).selectExpr("*", "'x' AS blank", "1 AS seen", "2 AS conv")
    assert reports(frame) == by_hand(rows)
    assert reports(frame.limit(0)) == {}
    texts = frame.withColumn("conv_id", F.concat(F.lit("c"), "conv_id"))
    assert conv.repair_plans(conv.damaged(texts)).schema["conv_id"].dataType.simpleString() == "string"
    dropped = [(0, t, "user", "A.") for t in range(3000) if zlib.crc32(f"0:{t}".encode()) % 20 == 0][:2]
    assert reports(spark.createDataFrame(dropped, ROWS)) == {0: (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}
