from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from functools import lru_cache

import pytest

from tallyloom.llm import conversation_repair as repair
from tallyloom.llm.queries import QUERIES
from tests.llm.frames import CLASHING, collected
from pyspark.sql import functions as F


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def cheapest(rows):
    """(cost, edits) by trying every edit at every place, memoised on the whole rest."""
    @lru_cache(None)
    def best(i, state):
        ways = []
        if i == len(rows):
            if state in (0, 3):
                return 0, ""
        else:
            role, fault = rows[i]
            cost, edits = best(i + 1, state)
            ways.append((4 + cost, "D" + edits))
            if fault not in ("blank", "duplicate"):
                extra = 3 if fault == "truncated" else 0
                to = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
                if (state, role[:1]) in to:
                    cost, edits = best(i + 1, to[state, role[:1]])
                    ways.append((extra + cost, "K" + edits))
                cost, edits = best(i + 1, 3 if state == 2 else 2)
                ways.append((3 + extra + cost, "R" + edits))
        # at most two insertions in a row can help
        for n in (1, 2):
            s = state
            for _ in range(n):
                s = 3 if s == 2 else 2
            if i < len(rows):
                tail = no_insert(i, s)
            else:
                tail = (0, "") if s == 3 else None
            if tail:
                ways.append((3 * n + tail[0], "I" * n + tail[1]))
        return min(ways)

    @lru_cache(None)
    def no_insert(i, state):
        role, fault = rows[i]
        cost, edits = best(i + 1, state)
        ways = [(4 + cost, "D" + edits)]
        if fault not in ("blank", "duplicate"):
            extra = 3 if fault == "truncated" else 0
            to = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
            if (state, role[:1]) in to:
                cost, edits = best(i + 1, to[state, role[:1]])
                ways.append((extra + cost, "K" + edits))
            cost, edits = best(i + 1, 3 if state == 2 else 2)
            ways.append((3 + extra + cost, "R" + edits))
        return min(ways)

    return best(0, 0)


def brute(rows):
    """{conv: row} of undamaged rows (conv, turn, role, text)."""
    out = {}
    hurt = damage(rows)
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in hurt if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))
        seen, faults = set(), []
        for _, _, role, text in own:
            core = re.sub(r"[\x20\x09-\x0D]+$", "", text)
            if not core:
                faults.append("blank")
            elif (role, text) in seen:
                faults.append("duplicate")
            else:
                faults.append("" if core[-1] in ".!?" else "truncated")
            seen.add((role, text))
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum((a[2][:1] + b[2][:1]) not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit = cheapest(tuple((r[2], f) for r, f in zip(own, faults)))
        lines, i, roles = [], 0, ""
        for edit in audit:
            due = "assistant" if roles[-1:] == "u" else "user"
            if edit == "I":
                lines.append(due + ":")
                roles += due[0]
                continue
            _, _, role, text = own[i]
            i += 1
            if edit != "D":
                role = due if edit == "R" else role
                lines.append(f"{role}:{text}")
                roles += role[0]
        assert i == len(own) and re.fullmatch("(s?(ua)+)?", roles)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, digest)
    return out


def frame(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return df.select("*", *[F.lit(f"x{i}").alias(c) for i, c in enumerate(CLASHING) if c not in ("turn", "role", "text")])


def repaired(df):
    turns = repair.damaged(df)
    out = repair.repaired(turns, conv_col="conv", gone="gone")
    return {k: tuple(r)[1:] for k, r in collected(out, "conv").items()}


def test_same_as_brute_force(spark):
    random.seed(12)
    texts = ["Yes.", "No", "Why?", "", " \t\n", "Well! ", "\x0b", "é…", "ok.\r\n", None, "Über allem. ", "a"]
    rows = []
    for conv in range(150):
        for turn in range(random.randrange(1, 14)):
            if random.random() < 0.9:
                rows.append((conv, turn * random.choice([1, 1, 1, 2]), random.choice(["user", "assistant", "user", "assistant", "system", "tool", None]), random.choice(texts)))
    rows = [list(g)[0] for _, g in itertools.groupby(sorted(rows, key=lambda r: r[:2]), key=lambda r: r[:2])]
    rows += [(None, 1, "user", "Hi."), (None, 2, "assistant", "Ho."), (9999, None, "system", "S."), (9999, 5, "user", "x."), (9999, 6, "assistant", "y.")]
    random.shuffle(rows)
    got, want = repaired(frame(spark, rows).repartition(5)), brute(rows)
    for k in want:
        assert got[k] == want[k], [r for r in sorted(damage(rows), key=lambda r: (r[1] or 0)) if r[0] == k]
    assert got == want


def test_given_table_as_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {k: tuple(r)[1:] for k, r in collected(QUERIES["op12_conversation_repair"](spark, sf_dir), "conv_id").items()}
    assert got == brute(rows)


def test_giant_conversation_over_many_batches(spark, monkeypatch):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"turn {i}" + ("." if i % 7 else "")) for i in range(30_000)]
    df = frame(spark, rows)
    out = collected(repair.repaired(df), "conv_id")[1]
    whole = sorted(rows, key=lambda r: r[1])
    assert out["audit"] == "K" * len(rows) and out["truncated"] == out["cost"] // 3 == sum(r[1] % 7 == 0 for r in rows)
    assert out["repaired_sha256"] == hashlib.sha256("\n".join(f"{r[2]}:{r[3]}" for r in whole).encode()).hexdigest()


def test_notes_in_a_file_give_the_same_edits(monkeypatch):
    import numpy as np

    random.seed(5)
    codes = np.array([random.randrange(16) for _ in range(5000)], dtype=np.int8)
    turns = np.arange(5000, 0, -1)
    rows = []
    for size in (1 << 30, 100):
        monkeypatch.setattr(repair, "IN_MEMORY", size)
        talk = repair._Conversation("x")
        for at in range(0, 5000, 700):
            talk.add(codes[at : at + 700], turns[at : at + 700], np.ones(len(codes[at : at + 700]), dtype=bool))
        rows.append(talk.row())
    assert rows[0] == rows[1]


def test_repaired_turns_are_sound(spark):
    df = frame(spark, [(1, 0, "assistant", "A."), (1, 1, "assistant", "B."), (1, 2, "user", " "), (2, 0, "user", "")])
    rows = repair.repaired_turns(df).orderBy("conv", "place").collect()
    roles = "".join(r["role"][0] for r in rows if r["conv"] == "1" and r["edit"] != "D")
    assert re.fullmatch("(ua)+", roles)
    assert [(r["edit"], r["role"], r["text"]) for r in rows if r["conv"] == "2"] == [("D", "user", "")]


@pytest.mark.parametrize("rows", [[], [(7, None, None, None)]])
def test_empty_and_null(spark, rows):
    assert repaired(frame(spark, rows)) == brute(rows)
