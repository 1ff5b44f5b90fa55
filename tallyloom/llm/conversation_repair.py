"""Repair of the structure of conversations by the cheapest edits, streamed turn by turn.

A sound conversation is empty, or reads user, assistant, user, assistant … after at most one system turn, ends with the
assistant, and has neither blank nor repeated turns. The rows are dealt by conversation and sorted by turn, and
mapInPandas streams them: a conversation may be spread over any number of Arrow batches, and between two batches only
the state of the dynamic programme is carried.

The programme runs from the last turn to the first. For each of four expectations (nothing yet, after the system turn,
after a user turn, after an assistant turn) it holds the least cost of all that follows, and for each turn it notes the
first edit of the best repair: one byte for the four, one more for the kind of the turn. These notes go to a file next to
Spark's own spill files once a conversation is too long for memory. When the first turn is reached, the notes are read
backwards and give the edits. A second stream in ascending order, with each conversation's edits ahead of its turns,
applies them. No text is held: a conversation of any length needs two bytes of memory or spill for each turn, and its
edits as one string.

NULL roles and texts are one space. Turns stand in ascending order, NULL first; turns of one number in order of their
role and then of a hash of role and text, so equal turns are neighbours. NULL is a conversation of its own. A table
without rows has no conversations.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.tables import columns_of, stored

#: What the edits cost.
DELETE, REROLE, INSERT, LEFT_TRUNCATED = 4, 3, 3, 3
#: Notes of one conversation that stay in memory, in bytes; more of them go to a file.
IN_MEMORY = 64 << 20

_SYSTEM, _USER, _ASSISTANT, _OTHER = range(4)
_SOUND, _TRUNCATED, _BLANK, _DUPLICATE = range(4)
_GONE = 16  # a turn that the damage removed: it only says that its conversation exists
# States: 0 nothing yet, 1 after the system turn, 2 after a user turn, 3 after an assistant turn.
_NEXT = (2, 2, 3, 2)  # after a user or assistant turn where it is due
_KEPT = ({_SYSTEM: 1, _USER: 2}, {_USER: 2}, {_ASSISTANT: 3}, {_USER: 2})
_EDITS = "DIKR"  # ascending, so the least of equally cheap edits is the first
_ENDING = {0: "", 1: "II", 2: "I", 3: ""}
_LEGAL = {(_SYSTEM, _USER), (_USER, _ASSISTANT), (_ASSISTANT, _USER)}


def _step(after: tuple[int, ...], code: int) -> tuple[tuple[int, ...], int]:
    """(costs from this turn on, notes): one step of the programme towards the first turn."""
    role, fault = code & 3, code >> 2
    extra = LEFT_TRUNCATED if fault == _TRUNCATED else 0
    best, edit = [], []
    for state in range(4):
        ways = [(DELETE + after[state], 0)]
        if fault < _BLANK:
            if role in _KEPT[state]:
                ways.append((extra + after[_KEPT[state][role]], 2))
            ways.append((REROLE + extra + after[_NEXT[state]], 3))
        cost, which = min(ways)
        best.append(cost)
        edit.append(which)
    # Insertions before the turn: from 2 to 3 or back, and from 0 and 1 to 2.
    after_user, after_assistant = min(best[2], INSERT + best[3]), min(best[3], INSERT + best[2])
    full = (min(best[0], INSERT + after_user), min(best[1], INSERT + after_user), after_user, after_assistant)
    notes = 0
    for state in range(4):
        ways = [(1, INSERT + full[_NEXT[state]])] + [(edit[state], best[state])]
        notes |= min(e for e, cost in ways if cost == full[state]) << 2 * state
    return full, notes


class _Automaton:
    """The programme's steps as a table: costs matter only up to their least, so there are few states."""

    def __init__(self) -> None:
        self.states: dict[tuple, int] = {}
        self.known: list[tuple] = []
        self.steps: list[dict[int, tuple[int, int, int, int]]] = []
        self.start = self._number((0, 2 * INSERT, INSERT, 0), -1)

    def _number(self, costs: tuple[int, ...], role: int) -> int:
        key = (costs, role)
        if key not in self.states:
            self.states[key] = len(self.known)
            self.known.append(key)
            self.steps.append({})
        return self.states[key]

    def learn(self, state: int, code: int) -> tuple[int, int, int, int]:
        """(next state, cost, notes, pairs of roles that are out of order)."""
        costs, following = self.known[state]
        full, notes = _step(costs, code)
        least = min(full)
        illegal = int(following >= 0 and (code & 3, following) not in _LEGAL)
        entry = (self._number(tuple(c - least for c in full), code & 3), least, notes, illegal)
        self.steps[state][code] = entry
        return entry

    def cost_of(self, state: int, least: int) -> int:
        """Of a whole conversation, from the state that its first turn led to."""
        return least + self.known[state][0][0]


_automaton = _Automaton()


def _spill_folder() -> str | None:
    """Where Spark lets a worker process spill."""
    return (os.environ.get("SPARK_LOCAL_DIRS") or "").split(",")[0] or None


class _Conversation:
    """What is carried of one conversation while its turns arrive, the last one first."""

    def __init__(self, key: object):
        self.key = key
        self.state, self.cost, self.illegal = _automaton.start, 0, 0
        self.notes = tempfile.SpooledTemporaryFile(max_size=IN_MEMORY, dir=_spill_folder())
        self.faults = np.zeros(3, dtype=np.int64)
        self.high = self.low = self.turn = None
        self.turns = 0

    def add(self, codes: np.ndarray, turns: np.ndarray, numbered: np.ndarray) -> None:
        """Turns in descending order."""
        kinds = np.bincount(codes >> 2, minlength=4)
        self.faults += kinds[[_BLANK, _DUPLICATE, _TRUNCATED]]
        known = turns[numbered]
        if len(known):
            if self.high is None:
                self.high = int(known[0])
            new = int((known[1:] != known[:-1]).sum()) + (self.turn is None or int(known[0]) != self.turn)
            self.turns += new
            self.low = self.turn = int(known[-1])
        steps, learn = _automaton.steps, _automaton.learn
        state, cost, illegal = self.state, self.cost, self.illegal
        notes = bytearray()
        for code in codes.tolist():
            entry = steps[state].get(code) or learn(state, code)
            state = entry[0]
            cost += entry[1]
            notes.append(entry[2])
            notes.append(code)
            illegal += entry[3]
        self.state, self.cost, self.illegal = state, cost, illegal
        self.notes.write(notes)

    def edits(self) -> str:
        """The edits in order of the turns, from the notes read backwards."""
        out, state, end = [], 0, self.notes.tell()
        while end:
            size = min(end, 1 << 20)
            self.notes.seek(end - size)
            block = self.notes.read(size)
            end -= size
            for at in range(size - 2, -1, -2):
                notes = block[at]
                edit = notes >> 2 * state & 3
                while edit == 1:
                    out.append("I")
                    state = _NEXT[state]
                    edit = notes >> 2 * state & 3
                out.append(_EDITS[edit])
                if edit == 2:
                    state = _KEPT[state][block[at + 1] & 3]
                elif edit == 3:
                    state = _NEXT[state]
        self.notes.close()
        return "".join(out) + _ENDING[state]

    def row(self) -> tuple:
        gaps = 0 if self.high is None else self.high - self.low + 1 - self.turns
        blank, duplicate, truncated = (int(n) for n in self.faults)
        cost = _automaton.cost_of(self.state, self.cost)
        return self.key, gaps, blank, duplicate, truncated, self.illegal, cost, self.edits()


def _runs(keys: pd.Series) -> Iterator[tuple[object, int, int]]:
    """(key, from, to) of each run of equal keys; None equals None."""
    values = keys.fillna("").to_numpy(dtype=object)
    missing = keys.isna().to_numpy()
    change = np.flatnonzero((values[1:] != values[:-1]) | (missing[1:] != missing[:-1])) + 1
    cuts = [0, *change.tolist(), len(values)]
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield (None if missing[a] else values[a]), a, b


def _audits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    open_: _Conversation | None = None
    for batch in batches:
        if not len(batch):
            continue
        done = []
        codes = batch["code"].to_numpy()
        turns, numbered = batch["turn"].to_numpy(), batch["numbered"].to_numpy()
        for key, a, b in _runs(batch["conv"]):
            if open_ is not None and open_.key != key:
                done.append(open_.row())
                open_ = None
            if open_ is None:
                open_ = _Conversation(key)
            here = slice(a, b)
            if (codes[here] == _GONE).any():
                stay = codes[here] != _GONE
                open_.add(codes[here][stay], turns[here][stay], numbered[here][stay])
            else:
                open_.add(codes[here], turns[here], numbered[here])
        if done:
            yield pd.DataFrame(done, columns=columns)
    if open_ is not None:
        yield pd.DataFrame([open_.row()], columns=columns)


def _turns(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, gone: str | None) -> DataFrame:
    """The input under the operator's own names; `gone` marks turns that are no more."""
    names = {"conv": conv_col, "turn": turn_col, "role": role_col, "text": text_col, **({"gone": gone} if gone else {})}
    out = columns_of(rows, **names)
    return out.select(
        F.col("conv").cast("string").alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        (F.coalesce("gone", F.lit(False)) if gone else F.lit(False)).alias("gone"),
    ).withColumn("h1", F.xxhash64("role", "text")).withColumn("h2", F.xxhash64(F.lit(7), "text", "role"))


def audits(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    gone: str | None = None,
) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit) for each conversation; conv as a string.

    Faults are counted once a turn, the first of: blank (white space alone), duplicate (role and text stand earlier in the
    conversation), truncated (the last other character is none of `.!?`). `illegal` counts neighbours whose roles do not
    begin with su, ua or au, `gaps` numbers missing between the first and last turn. `audit` is the cheapest repair as the
    initials of Keep, Rerole, Delete and Insert in order, the least in ASCII of several. A blank or repeated turn must be
    deleted, and a truncated one that stays costs more. A conversation whose turns are all marked in the column `gone` has
    zeros and an empty audit.
    """
    end = F.expr("trim(TRAILING ' \\t\\n\\u000b\\u000c\\r' FROM text)")
    slim = _turns(rows, conv_col, turn_col, role_col, text_col, gone).select(
        "conv", "turn", "role", "h1", "h2", "gone", F.substring("role", 1, 1).alias("initial"), F.right(end, F.lit(1)).alias("last"))
    slim = slim.repartition("conv")
    # Rows dealt by conversation are dealt by conversation and text too: the window shuffles nothing.
    seen = F.row_number().over(Window.partitionBy("conv", "gone", "h1", "h2").orderBy(F.col("turn").asc_nulls_first()))
    fault = (
        F.when(F.col("last") == "", _BLANK).when(F.col("seen") > 1, _DUPLICATE)
        .when(~F.col("last").isin(".", "!", "?"), _TRUNCATED).otherwise(_SOUND))
    role = F.when(F.col("initial") == "s", _SYSTEM).when(F.col("initial") == "u", _USER).when(
        F.col("initial") == "a", _ASSISTANT).otherwise(_OTHER)
    coded = slim.withColumn("seen", seen).select(
        "conv", "turn", "role", "h1", "h2", "seen",
        F.when(F.col("gone"), _GONE).otherwise(fault * 4 + role).cast("tinyint").alias("code"))
    ordered = coded.sortWithinPartitions(
        F.col("conv"), F.col("turn").desc_nulls_last(), F.col("role").desc(), F.col("h1").desc(), F.col("h2").desc(),
        F.col("seen").desc())
    stream = ordered.select(
        "conv", F.coalesce("turn", F.lit(0)).alias("turn"), F.col("turn").isNotNull().alias("numbered"), "code")
    return stream.mapInPandas(
        _audits, "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")


def _replayed(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[object, bool, list[tuple[str, str, str]], bool]]:
    """(conversation, is its first part, edited turns as (edit, role, text), is its last part)."""
    key: object = None
    audit, at, state, open_ = "", 0, 0, False
    for batch in batches:
        if not len(batch):
            continue
        roles, texts, audits_ = (batch[c].tolist() for c in ("role", "text", "audit"))
        for found, a, b in _runs(batch["conv"]):
            if open_ and found != key:
                yield key, False, _inserted(audit, at, state)[0], True
                open_ = False
            first = not open_
            if first:
                key, open_, audit, at, state = found, True, audits_[a] or "", 0, 0
                a += 1
            out: list[tuple[str, str, str]] = []
            for i in range(a, b):
                new, at, state = _inserted(audit, at, state)
                out += new
                edit = audit[at]
                at += 1
                if edit == "K":
                    state = _KEPT[state]["sua".index(roles[i][0])]
                    out.append((edit, roles[i], texts[i]))
                elif edit == "R":
                    state = _NEXT[state]
                    out.append((edit, _due(state), texts[i]))
                else:
                    out.append((edit, roles[i], texts[i]))
            yield key, first, out, False
    if open_:
        yield key, False, _inserted(audit, at, state)[0], True


def _due(state: int) -> str:
    return "user" if state == 2 else "assistant"


def _inserted(audit: str, at: int, state: int) -> tuple[list[tuple[str, str, str]], int, int]:
    out = []
    while audit[at : at + 1] == "I":
        state = _NEXT[state]
        out.append(("I", _due(state), ""))
        at += 1
    return out, at, state


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    done: list[tuple[object, str]] = []
    digest, empty = hashlib.sha256(), True
    for key, first, turns, last in _replayed(batches):
        if first:
            digest, empty = hashlib.sha256(), True
        lines = [f"{role}:{text}" for edit, role, text in turns if edit != "D"]
        if lines:
            digest.update(("" if empty else "\n").encode() + "\n".join(lines).encode())
            empty = False
        if last:
            done.append((key, digest.hexdigest()))
            if len(done) >= 5000:
                yield pd.DataFrame(done, columns=["conv", "repaired_sha256"])
                done = []
    if done:
        yield pd.DataFrame(done, columns=["conv", "repaired_sha256"])


def _rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    place = 0
    for key, first, turns, _ in _replayed(batches):
        place = 0 if first else place
        if turns:
            frame = pd.DataFrame(turns, columns=["edit", "role", "text"])
            frame.insert(0, "place", range(place, place + len(turns)))
            frame.insert(0, "conv", key)
            place += len(turns)
            yield frame


def _with_audits(rows: DataFrame, found: DataFrame, names: tuple[str, str, str, str], gone: str | None) -> DataFrame:
    """Each conversation's audit and then its turns, in order."""
    turns = _turns(rows, *names, gone).filter("not gone").select(
        "conv", F.lit(1).alias("part"), "turn", "role", "h1", "h2", "text", F.lit(None).cast("string").alias("audit"))
    head = found.select(
        "conv", F.lit(0).alias("part"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit(0).cast("long").alias("h1"),
        F.lit(0).cast("long").alias("h2"), F.lit("").alias("text"), "audit")
    both = turns.unionByName(head).repartition("conv")
    return both.sortWithinPartitions("conv", "part", F.col("turn").asc_nulls_first(), "role", "h1", "h2").select(
        "conv", "role", "text", "audit")


def repaired_turns(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    found: DataFrame | None = None, gone: str | None = None,
) -> DataFrame:
    """(conv, place, edit, role, text): every turn with its edit (`K`, `R`, `D` or `I`) and what the repair makes of it.

    Without the rows of `D` these are the repaired conversations. `found` are the audits, if they are at hand.
    """
    names = (conv_col, turn_col, role_col, text_col)
    found = found if found is not None else audits(rows, *names, gone=gone)
    stream = _with_audits(rows, found, names, gone)
    return stream.mapInPandas(_rows, "conv string, place long, edit string, role string, text string")


def repaired(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    gone: str | None = None,
) -> DataFrame:
    """The audits of all conversations and the SHA-256 of each repaired one (`role:text`, joined by newlines)."""
    names = (conv_col, turn_col, role_col, text_col)
    found = stored(audits(rows, *names, gone=gone), "audits")
    made = _with_audits(rows, found, names, gone).mapInPandas(_digests, "conv string, repaired_sha256 string")
    out = found.join(made, found["conv"].eqNullSafe(made["conv"])).drop(made["conv"])
    kind = rows.schema[conv_col].dataType
    return out.select(
        F.col("conv").cast(kind).alias(conv_col), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        "repaired_sha256")


def _damage() -> Column:
    conv, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv", "turn"))
    return F.crc32(F.encode(F.concat(conv, F.lit(":"), turn), "UTF-8")) % 20


def damaged(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """(conv, turn, role, text, gone): turns with faults of known kinds, to try a repair on.

    crc32 of `conv:turn` modulo 20 decides: 0 removes the turn (`gone`), 1 empties its text, 2 removes `.!?`, 3 repeats the
    turn, 4 makes it a user's.
    """
    out = columns_of(rows, conv=conv_col, turn=turn_col, role=role_col, text=text_col)
    out = out.withColumn("kind", _damage())
    kind, role, text = F.col("kind"), F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    return out.select(
        "conv", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (kind == 0).alias("gone"), F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")
