"""Conversation repair against a plain search over whole edit strings."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from lakeloom.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string"
WHITE = re.compile(r"[^\x20\x09-\x0D]")
GOAL = re.compile(r"(s?(ua)+)?")


def damaged(rows):
    for conv, turn, role, text in rows:
        show = lambda v: " " if v is None else str(v)
        k = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = show(role), show(text)
        if k == 1:
            text = ""
        if k == 2:
            text = re.sub("[.!?]", "", text)
        if k == 4:
            role = "user"
        for _ in range(0 if k == 0 else 2 if k == 3 else 1):
            yield conv, turn, role, text


def faults_of(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        solid = WHITE.findall(text)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """All edit strings that could be best, kept per text of role initials so far and rows used."""
    def fits(initials):
        return any(GOAL.fullmatch(initials + tail) for tail in ("", "a", "ua"))

    ways = {"": (0, "", ())}  # a short text that goes on like the initials so far -> cost, audit, messages
    short = lambda x: x if x in ("", "s") else {"u": "u", "a": "ua"}[x[-1]]

    def add(pool, initials, way):
        if fits(initials):
            key = short(initials)
            if key not in pool or way[:2] < pool[key][:2]:
                pool[key] = way

    def inserted(ways):
        pool = dict(ways)
        for _ in range(2):
            for x, (c, a, m) in list(pool.items()):
                for role in ("user", "assistant"):
                    add(pool, x + role[0], (c + 5, a + "I", (*m, f"{role}:")))
        return pool

    for (_, _, role, text), fault in zip(rows, faults):
        pool = {}
        for x, (c, a, m) in inserted(ways).items():
            add(pool, x, (c + 2, a + "D", m))
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                add(pool, x + role[:1] if role else "??", (c + more, a + "K", (*m, f"{role}:{text}")))
                for new in ("user", "assistant"):
                    add(pool, x + new[0], (c + more + 1, a + "R", (*m, f"{new}:{text}")))
        ways = pool
    return min(w for x, w in inserted(ways).items() if GOAL.fullmatch(x))


def brute(rows):
    out = []
    for conv in {r[0] for r in rows}:
        mine = [r for r in damaged(rows) if r[0] == conv]
        mine.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        turns = [r[1] for r in mine if r[1] is not None]
        faults = faults_of(mine)
        cost, audit, messages = cheapest(mine, faults)
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(mine, mine[1:])]
        out.append((
            conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(messages).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def random_rows(seed, convs=60):
    rng = random.Random(seed)
    texts = ["Fine.", "Fine.", "cut", "é!  \n", "  ", "", "What? ", "Done. x", None, "a\nb."]
    rows = []
    for c in range(convs):
        for t in range(rng.choice([1, 2, 4, 9, 14])):
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.4 else ["user", "assistant"][t % 2]
            role = rng.choice(["system", "other", None, "", role]) if rng.random() < 0.15 or t == 0 and rng.random() < 0.5 else role
            rows.append((None if c == 7 else c, rng.choice([t, t, t, t + 1, t + 3, None]), role, rng.choice([*texts, f"Turn {t}.", f"Turn {t}.", f"Turn {t}!"])))
    return rows


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


@pytest.mark.parametrize("seed,cell", [(1, 4096), (2, 3), (3, 1)])
def test_against_brute_force(spark, monkeypatch, seed, cell):
    monkeypatch.setattr(repair, "CELL", cell)
    rows = random_rows(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    got = repair.audited(repair.damage(df), df, cell=cell).select(COLUMNS).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_one_stretch_against_all_edits():
    """Every edit string of up to six letters over every three kinds of rows."""
    state = {"s": 0, "u": 1, "a": 2}

    def run(kinds, edits):
        out, cost, i = "", 0, 0
        for e in edits:
            if e == "I":
                nxt = "a" if out[-1:] == "u" else "u"
                out, cost = out + nxt, cost + 5
                continue
            if i == len(kinds):
                return None
            kind, i = kinds[i], i + 1
            if e == "D":
                cost += 2
            elif kind % 4 in (repair.BLANK, repair.DUPLICATE):
                return None
            else:
                out += {v: k for k, v in state.items()}.get(kind // 4, "?") if e == "K" else "a" if out[-1:] == "u" else "u"
                cost += (e == "R") + 5 * (kind % 4 == repair.CUT)
        return (cost, edits) if i == len(kinds) and GOAL.fullmatch(out) else None

    strings = ["".join(e) for n in range(2, 7) for e in itertools.product("DIKR", repeat=n) if sum(x != "I" for x in e) == 2]
    for kinds in itertools.product(range(16), repeat=2):
        want = min(w for s in strings if (w := run(kinds, s)))
        cost, rank = repair.forward(kinds, repair.NOTHING)
        stop = repair.crossing(cost, rank, repair.LAST)
        got = "".join(f[0] for f in repair.solve(kinds, repair.NOTHING, stop)) + "I" * len(repair.closing(stop))
        assert (cost[stop] + repair.LAST[stop], got) == want


def test_empty_and_clashing_columns(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert repair.audited(df, df).count() == 0
    rows = random_rows(4, 20)
    wide = spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], SCHEMA + ", place long, key string, audit long, _slice long")
    got = repair.audited(repair.damage(wide), wide).select(COLUMNS).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_one_conversation_with_most_rows(spark):
    rows = [(1, t, ["user", "assistant"][t % 2], f"Turn {t % 900}{'.' if t % 13 else ''}") for t in range(3000)] + [(2, 0, "user", "x" * 100_000)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = repair.audited(repair.damage(df), df, cell=64).select(COLUMNS).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_messages_fit_the_pattern(spark):
    df = spark.createDataFrame(random_rows(6), SCHEMA)
    _, messages = repair.repair(df)
    by = {}
    for r in messages.orderBy("conv_id", "place", "part").collect():
        by.setdefault(r.conv_id, []).append(r.role[:1])
    assert by and all(GOAL.fullmatch("".join(x)) for x in by.values())
