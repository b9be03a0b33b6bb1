"""Repaired conversations against exhaustive search."""

import hashlib
import itertools
import random

import pytest

from ratewise.llm import turn_repair as R

BLANK = " \t\n\v\f\r"


def faults(turns):
    """(role, text, fault) in order."""
    seen, out = set(), []
    for role, text in turns:
        bare = text.rstrip(BLANK)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def legal(roles):
    rest = roles[1:] if roles[:1] == "s" else roles
    return not roles or (rest and len(rest) % 2 == 0 and rest == "ua" * (len(rest) // 2))


def brute(turns):
    """Every combination of edits with up to two insertions in a gap."""
    inserts = [()] + [((r, "", "I", 5),) for r in ("user", "assistant")] + [
        ((a, "", "I", 5), (b, "", "I", 5)) for a, b in itertools.product(("user", "assistant"), repeat=2)
    ]
    options = []
    for role, text, fault in faults(turns):
        ways = [(None, None, "D", 2)]
        late = 5 if fault == "truncated" else 0
        if fault in (None, "truncated"):
            ways += [(role, text, "K", late)] + [(r, text, "R", 1 + late) for r in ("user", "assistant")]
        options += [inserts, [(w,) for w in ways]]
    best = None
    for chosen in itertools.product(*options, inserts):
        steps = [s for group in chosen for s in group]
        kept = [s for s in steps if s[2] != "D"]
        if legal("".join((s[0] or "?")[:1] or "?" for s in kept)):
            found = (sum(s[3] for s in steps), "".join(s[2] for s in steps), "\n".join(f"{s[0]}:{s[1]}" for s in kept))
            best = found if best is None else min(best, found)
    return best


def sequential(turns):
    """The least (cost, audit, text) of every state, turn by turn; checked against ``brute`` on short ones."""
    def fill(best):
        for _ in range(2):
            for s in list(best):
                c, a, out = best[s]
                role = "assistant" if s == "u" else "user"
                new = (c + 5, a + "I", out + [f"{role}:"])
                if role[0] not in best or new < best[role[0]]:
                    best[role[0]] = new
        return best

    best = {"": (0, "", [])}
    for role, text, fault in faults(turns):
        nxt = {}
        for s, (c, a, out) in fill(dict(best)).items():
            late = 5 if fault == "truncated" else 0
            ways = [(s, c + 2, a + "D", out)]
            follow = "assistant" if s == "u" else "user"
            if fault in (None, "truncated"):
                if role[:1] == follow[0] or (s == "" and "I" not in a and not out and role[:1] == "s"):
                    ways.append((role[0], c + late, a + "K", out + [f"{role}:{text}"]))
                ways.append((follow[0], c + late + 1, a + "R", out + [f"{follow}:{text}"]))
            for state, *rest in ways:
                rest = tuple(rest)
                if state not in nxt or rest < nxt[state]:
                    nxt[state] = rest
        best = nxt
    c, a, out = min(v for s, v in fill(best).items() if s in ("", "a"))
    return c, a, "\n".join(out)


def random_turns(rng, n):
    roles, texts = ["system", "user", "assistant", "tool", "", "user", "assistant"], ["yes.", "no", " ", "", "Go!", "so?\n", "x"]
    return [(rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"t{rng.randrange(99)}" + rng.choice([".", ""])) for _ in range(n)]


def test_sequential_search_is_exhaustive():
    rng = random.Random(5)
    for n in (0, 1, 1, 2, 2, 2, 2, 2, 2, 2, 2, 3, 3):
        turns = random_turns(rng, n)
        assert sequential(turns) == brute(turns), turns


def solved(turns, cut=None):
    codes = []
    for role, _, fault in faults(turns):
        kind = "sua".find(role[:1]) if role[:1] else 3
        codes.append(8 if fault in ("blank", "duplicate") else (3 if kind < 0 else kind) + (4 if fault else 0))
    codes = bytes(codes)
    if cut is None:
        return "".join(R.solve(codes + b"\x09", 0, 0))
    parts = [codes[a:b] for a, b in zip([0, *cut], [*cut, len(codes)])]
    states = R.crossings([R.transfer(p) for p in parts])
    words = [R.solve(p, s, t) for p, s, t in zip(parts, states, states[1:])]
    return "".join(sum(words, []) + R.solve(parts[-1] + b"\x09", states[-1], 0))


def test_halves_and_segments_give_the_least_audit():
    rng = random.Random(6)
    for n in [*range(1, 40), 70, 130, 131, 400]:
        turns = random_turns(rng, n)
        want = sequential(turns)[1]
        assert solved(turns) == want
        cut = sorted(rng.sample(range(1, n), min(n - 1, rng.randrange(1, 6)))) if n > 1 else []
        assert solved(turns, cut) == want, (turns, cut)


SCHEMA = "conv_id long, turn long, role string, text string, audit string, conv long"


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        mine = [(t, r or "", x or "") for c, t, r, x, *_ in rows if c == conv]
        key = lambda m: (m[0] is not None, m[0] or 0, m[1].encode(), hashlib.md5(m[2].encode()).digest())
        turns = [(r, x) for _, r, x in sorted(mine, key=key)]
        cost, audit, text = sequential(turns)
        told = [f for _, _, f in faults(turns)]
        ids = {t for t, *_ in mine if t is not None}
        pairs = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        gaps = max(ids) - min(ids) + 1 - len(ids) if ids else 0
        out[conv] = (gaps, *(told.count(f) for f in ("blank", "duplicate", "truncated")), pairs, cost, audit, hashlib.sha256(text.encode()).hexdigest(), bool(text))
    return out


@pytest.mark.parametrize("partitions", [None, 7])
def test_tables_of_conversations(spark, partitions):
    rng = random.Random(9)
    rows = []
    for conv in [*range(12), None]:
        for turn, (role, text) in enumerate(random_turns(rng, rng.choice([1, 3, 8, 20]))):
            rows.append((conv, rng.choice([turn, turn * 2, None]), role, text, "x", 1))
    rows += [(77, i // 2, *t, None, 2) for i, t in enumerate(random_turns(rng, 900))]  # most rows: one conversation
    rows += [(78, 5, "user", "same.", None, 3)] * 60 + [(78, 5, "assistant", "ok.", None, 3)] * 2 + [(79, -3, None, None, None, 3)]
    rows += [(80, -(2**62), "user", "a " * 60_000 + ".", None, 3), (80, 2**62, "assistant", "b.", None, 3)]
    rng.shuffle(rows)
    report, repaired = R.repair(spark.createDataFrame(rows, SCHEMA), partitions)
    digests = {r.conv_id: r.sha256 for r in R.conversation_digests(repaired).collect()}
    want = expected(rows)
    want[80] = (2**63 - 1, *want[80][1:]) if want[80][0] < 2**63 else (None, *want[80][1:])
    got = {r.conv_id: tuple(r)[1:] for r in report.collect()}
    assert {c: w[:7] for c, w in want.items()} == got
    assert {c: w[7] for c, w in want.items() if w[8]} == digests


def test_empty_table(spark):
    report, repaired = R.repair(spark.createDataFrame([], SCHEMA))
    assert report.count() == 0 and repaired.count() == 0 and R.conversation_digests(repaired).count() == 0
