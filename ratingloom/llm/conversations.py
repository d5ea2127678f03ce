"""Repair of damaged conversations by the cheapest edits.

A repaired conversation is empty or reads ``user, assistant`` again and again, after a
``system`` message or not. Rows may be kept, given another role or deleted, and empty
messages may be inserted; see :data:`COSTS`.

Rows travel once, by conversation, and are sorted by turn. A task reads them as a stream
of Arrow batches and carries, from batch to batch, one entry for each of four states of
the role pattern: the least cost that leads there, its rank among equally cheap audits,
and a running hash of the text repaired so far. No row is held. What the choice was is
kept as one byte a state and row; of a giant conversation these bytes leave memory in
chunks (see :class:`_Choices`), and are read backwards once it ends.

Ranks suffice to find the least of equally cheap audits: just after a row no audit is the
beginning of another one (both name as many rows and end in a row's letter), so two of
them differ where the order of their beginnings, or what follows these, says.

Defined results: a null id, turn, role or text counts as one space where texts are built,
and a null turn sorts first. Rows of equal turns go by role and text. Repeated rows are
rows (all but the first are duplicates). Empty table: no rows. Other columns are ignored.
Ids may be of any type that a string can stand for.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Costs of the edits by their initials; a truncated row that stays costs ``TRUNCATED`` more. (Fixed values.)
COSTS = {"K": 0, "R": 1, "D": 2, "I": 5}
TRUNCATED = 5
#: Bytes of choices kept in memory before they go to disk.
SPILL = 16 << 20

#: States of the role pattern: nothing yet, after system, after user, after assistant.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = {"s": {_START: _SYSTEM}, "u": {_START: _USER, _SYSTEM: _USER, _ASSISTANT: _USER}, "a": {_USER: _ASSISTANT}}
_FULL = {"s": "system", "u": "user", "a": "assistant"}
_DONE = (_START, _ASSISTANT)
_LETTERS = "DKR"
#: Per state: (messages inserted before the next row, state then, their roles).
_INSERTED = {
    _START: ((0, _START, ""), (1, _USER, "u")),
    _SYSTEM: ((0, _SYSTEM, ""), (1, _USER, "u"), (2, _ASSISTANT, "ua")),
    _USER: ((0, _USER, ""), (1, _ASSISTANT, "a")),
    _ASSISTANT: ((0, _ASSISTANT, ""), (1, _USER, "u")),
}


def _text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, dropped)``: rows damaged by the hash of ``conv_id:turn``, dropped ones marked."""
    fault = F.crc32(F.concat(_text("conv_id"), F.lit(":"), _text("turn"))) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.translate(_text("text"), ".!?", "")).otherwise(_text("text"))
    return conversations.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(_text("role")).alias("role"),
        text.alias("text"),
        (fault == 0).alias("dropped"),
        F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def _streamed(rows: DataFrame) -> DataFrame:
    """Rows of one conversation after the other, by turn, with the flags that need no order of roles.

    Both windows and the sort use the one exchange by conversation.
    """
    turned = rows.select(
        F.col("conv_id").cast("string").alias("conv"),
        F.coalesce(F.col("turn").cast("bigint"), F.lit(0)).alias("turn"),
        F.col("turn").isNotNull().alias("timed"),
        _text("role").alias("role"),
        _text("text").alias("text"),
        F.coalesce(F.col("dropped"), F.lit(False)).alias("dropped"),
    ).repartition("conv")
    same = Window.partitionBy("conv", "role", "text", "dropped").orderBy("timed", "turn")
    bare = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\f\r"))
    return (
        turned.withColumn("seen", F.row_number().over(same) > 1)
        .withColumn("blank", bare == "")
        .withColumn("cut", ~F.substring(bare, -1, 1).isin(".", "!", "?"))
        .sortWithinPartitions("conv", "dropped", "timed", "turn", "role", "text", "seen")
    )


class _Choices:
    """Four bytes a row: how each state was reached. Long stretches go to a file and are read backwards.

    The file is nameless, in Spark's local folder where there is one, and belongs to the task
    alone, like the spilled part of a sort: a task that runs again writes its own.
    """

    def __init__(self) -> None:
        self.recent, self.file = bytearray(), None

    def add(self, choices: bytes) -> None:
        self.recent += choices
        if len(self.recent) >= SPILL:
            if self.file is None:
                folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
                self.file = tempfile.TemporaryFile(dir=folder if os.path.isdir(folder) else None)
            self.file.write(self.recent)
            self.recent = bytearray()

    def backwards(self) -> Iterator[memoryview]:
        """The rows' choices from the last to the first."""
        view = memoryview(self.recent)
        for end in range(len(view), 0, -4):
            yield view[end - 4 : end]
        if self.file is not None:
            at = self.file.tell()
            while at:
                start = max(0, at - (SPILL & ~3))
                self.file.seek(start)
                view = memoryview(self.file.read(at - start))
                for end in range(len(view), 0, -4):
                    yield view[end - 4 : end]
                at = start

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


class _Open:
    """The conversation that is being read."""

    def __init__(self) -> None:
        # Per state: (cost, rank, hash of the repaired text or None while there is no message).
        self.states: list[tuple | None] = [(0, 0, None), None, None, None]
        self.choices = _Choices()
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = self.rows = 0
        self.first_turn = self.last_turn = self.last_initial = None

    def read(self, turn: int | None, role: str, text: str, blank: bool, seen: bool, cut: bool) -> None:
        if turn is not None and turn != self.last_turn:
            self.first_turn = turn if self.turns == 0 else self.first_turn
            self.last_turn, self.turns = turn, self.turns + 1
        initial = role[:1]
        if self.rows and f"{self.last_initial}{initial}" not in ("su", "ua", "au"):
            self.illegal += 1
        self.last_initial, self.rows = initial, self.rows + 1
        fault = "blank" if blank else "duplicate" if seen else "truncated" if cut else None
        if fault:
            setattr(self, fault, getattr(self, fault) + 1)
        self._advance(role, text, initial, fault)

    def _advance(self, role: str, text: str, initial: str, fault: str | None) -> None:
        reached: list[list] = [[], [], [], []]
        extra = TRUNCATED if fault == "truncated" else 0
        stays = fault not in ("blank", "duplicate")
        for state, entry in enumerate(self.states):
            if entry is None:
                continue
            cost, rank, _ = entry
            for inserted, then, _ in _INSERTED[state]:
                base, by = cost + COSTS["I"] * inserted, (rank, "I" * inserted)
                reached[then].append((base + COSTS["D"], by[0], by[1] + "D", state, inserted, ""))
                if not stays:
                    continue
                kept = _NEXT.get(initial, {}).get(then)
                if kept is not None:
                    reached[kept].append((base + extra, by[0], by[1] + "K", state, inserted, initial))
                for to in "ua":
                    changed = _NEXT[to].get(then)
                    if changed is not None:
                        reached[changed].append((base + COSTS["R"] + extra, by[0], by[1] + "R", state, inserted, to))
        best = [min(options) if options else None for options in reached]
        order = sorted({option[1:3] for option in best if option})
        ranks = {key: place for place, key in enumerate(order)}
        packed = bytearray(4)
        states: list[tuple | None] = [None] * 4
        for state, option in enumerate(best):
            if option is None:
                continue
            cost, rank, letters, parent, inserted, to = option
            packed[state] = parent | inserted << 2 | _LETTERS.index(letters[-1]) << 4
            digest = self._written(self.states[parent][2], parent, inserted)
            if to:
                spoken = role if letters[-1] == "K" else _FULL[to]
                digest = _said(digest, f"{spoken}:{text}")
            states[state] = (cost, ranks[rank, letters], digest)
        self.states = states
        self.choices.add(packed)

    @staticmethod
    def _written(digest, state: int, inserted: int):
        for to in _INSERTED[state][inserted][2]:
            digest = _said(digest, f"{_FULL[to]}:")
        return digest

    def close(self) -> dict:
        """The report of the conversation."""
        ends = []
        for state, entry in enumerate(self.states):
            for inserted, then, _ in _INSERTED[state] if entry else ():
                if then in _DONE:
                    ends.append((entry[0] + COSTS["I"] * inserted, entry[1], inserted, state))
        cost, _, inserted, state = min(ends)
        digest = self._written(self.states[state][2], state, inserted)
        audit = ["I" * inserted]
        for choices in self.choices.backwards():
            choice = choices[state]
            audit.append(_LETTERS[choice >> 4])
            audit.append("I" * (choice >> 2 & 3))
            state = choice & 3
        self.choices.close()
        gaps = self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0
        return {
            "gaps": min(gaps, (1 << 63) - 1),
            "blank": self.blank,
            "duplicate": self.duplicate,
            "truncated": self.truncated,
            "illegal": self.illegal,
            "cost": cost,
            "audit": "".join(reversed(audit)),
            "repaired_sha256": (digest or hashlib.sha256()).hexdigest(),
        }


def _said(digest, message: str):
    """The running hash with one more message; the hash given stays as it is."""
    data = message.encode("utf-8", "surrogatepass")
    if digest is None:
        return hashlib.sha256(data)
    digest = digest.copy()
    digest.update(b"\n" + data)
    return digest


_REPORT = (
    "conv string, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
    "cost bigint, audit string, repaired_sha256 string"
)


def repair_plans(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text, dropped): faults, cost, audit, hash.

    A conversation whose rows are all dropped is reported with nothing in it.
    """
    kind = rows.schema["conv_id"].dataType

    def stream(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_id, conversation, reports = None, None, []
        for frame in frames:
            columns = (frame[c] for c in ("conv", "turn", "timed", "role", "text", "dropped", "blank", "seen", "cut"))
            for conv, turn, timed, role, text, dropped, blank, seen, cut in zip(*columns, strict=True):
                if conversation is None or conv != open_id:
                    if conversation is not None:
                        reports.append({"conv": open_id, **conversation.close()})
                    open_id, conversation = conv, _Open()
                if not dropped:
                    conversation.read(turn if timed else None, role, text, blank, seen, cut)
            if reports:
                yield pd.DataFrame(reports)
                reports = []
        if conversation is not None:
            yield pd.DataFrame([{"conv": open_id, **conversation.close()}])

    reports = _streamed(rows).mapInPandas(stream, _REPORT)
    return reports.withColumn("conv", F.col("conv").cast(kind)).withColumnRenamed("conv", "conv_id")


def repaired(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """The repaired conversations: ``(conv_id, place, edit, role, text)``, one row per message that they have.

    ``plans`` are those of the same ``rows``. An audit and the rows it speaks of meet in one
    sorted stream, so no conversation is held here either.
    """
    kind = rows.schema["conv_id"].dataType
    no_audit = F.lit(None).cast("string").alias("audit")
    spoken = _streamed(rows).filter("NOT dropped").select("conv", "timed", "turn", "role", "text", "seen", no_audit)
    audits = plans.select(F.col("conv_id").cast("string").alias("conv"), "audit")
    both = spoken.unionByName(audits, allowMissingColumns=True).repartition("conv")
    both = both.sortWithinPartitions("conv", F.col("audit").isNull(), "timed", "turn", "role", "text", "seen")

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        audit, at, place, last = "", 0, 0, _START
        for frame in frames:
            out = []

            def say(conv, edit, role, text):
                nonlocal place
                out.append((conv, place, edit, role, text))
                place += 1

            def insert(conv):
                nonlocal at, last
                while at < len(audit) and audit[at] == "I":
                    last = _ASSISTANT if last == _USER else _USER
                    say(conv, "I", "user" if last == _USER else "assistant", "")
                    at += 1

            for conv, role, text, given in zip(frame["conv"], frame["role"], frame["text"], frame["audit"], strict=True):
                if given is not None:
                    audit, at, place, last = given, 0, 0, _START
                    stays = sum(letter != "D" for letter in audit)
                    opening = stays % 2  # an odd number of messages begins with the system's
                else:
                    edit = audit[at]
                    at += 1
                    if edit != "D":
                        last = _SYSTEM if opening and place == 0 else _ASSISTANT if last == _USER else _USER
                        fresh = "user" if last == _USER else "assistant"
                        say(conv, edit, role if edit == "K" else fresh, text)
                insert(conv)
            yield pd.DataFrame(out, columns=["conv", "place", "edit", "role", "text"])

    schema = "conv string, place bigint, edit string, role string, text string"
    written = both.select("conv", "role", "text", "audit").mapInPandas(write, schema)
    return written.withColumn("conv", F.col("conv").cast(kind)).withColumnRenamed("conv", "conv_id")
