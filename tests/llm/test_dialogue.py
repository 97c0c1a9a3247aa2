import hashlib
import heapq
import random
import re
import zlib

import pytest

from ionframe.llm import dialogue, queries

SCHEMA = "conv_id long, turn long, role string, text string, first boolean, signature int"


def solid(text: str) -> str:
    return text.strip("\x20\x09\x0a\x0b\x0c\x0d")


def damaged(rows):
    out = []
    for c, t, r, x in rows:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        if k == 1:
            x = ""
        if k == 2:
            x = re.sub("[.!?]", "", x)
        out += [(c, t, "user" if k == 4 else r, x)] * (0 if k == 0 else 2 if k == 3 else 1)
    return out


def cheapest(rows):
    """(cost, audit, turns) by a search in order of (cost, audit) over edits and the roles they give; rows (role, text, fault)."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, roles, turns = heapq.heappop(heap)
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, audit, turns
        if (i, roles) in done or not re.fullmatch("s?(ua)*u?", roles):
            continue
        done.add((i, roles))
        for r in ("user", "assistant"):
            heapq.heappush(heap, (cost + 2, audit + "I", i, roles + r[0], (*turns, (r, ""))))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, roles, turns))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                for r in ("user", "assistant"):
                    heapq.heappush(heap, (cost + 2 + more, audit + "R", i + 1, roles + r[0], (*turns, (r, text))))
                if role[:1]:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, roles + role[0], (*turns, (role, text))))


def brute(rows):
    """Rows (conv_id, turn, role, text) in their order, damaged already; {conv_id: report}."""
    out = {}
    for c in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == c and r[2] is not None),
                      key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).digest()))
        seen, told = set(), []
        for _, _, r, x in mine:
            fault = "blank" if not solid(x) else "duplicate" if (r, x) in seen else "" if solid(x)[-1] in ".!?" else "truncated"
            seen.add((r, x))
            told.append((r, x, fault))
        turns = {r[1] for r in mine} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(told, told[1:]))
        cost, audit, left = cheapest(told)
        sha = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in left).encode()).hexdigest()
        n = [sum(f == k for _, _, f in told) for k in ("blank", "duplicate", "truncated")]
        out[c] = (c, gaps, *n, illegal, cost, audit, sha)
    return out


def conversations(seed: int, n: int):
    r = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    texts = ["Hi.", "Hi.", "no end", "Why?", "", " \t", "Done!  ", None, "a.\x0b", "b .c", "ü ", "ok."]
    return [(c, t if r.random() > .1 else r.choice([None, t, 2 * t, 0]), r.choice(roles), r.choice(texts)) for c in range(n) for t in range(r.randrange(0, 7))]


def with_empty(rows, report):
    """Conversations that lost all rows."""
    sha = hashlib.sha256(b"").hexdigest()
    return {c: report.get(c, (c, 0, 0, 0, 0, 0, 0, "", sha)) for c in {r[0] for r in rows}}


def frame(spark, rows, parts=5):
    return spark.createDataFrame([(*r, True, 1) for r in rows], SCHEMA).repartition(parts)


def report(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_conversations_equal_brute_force(spark, seed):
    rows = conversations(seed, 250) + [(None, 1, "user", "Hi."), (None, None, "assistant", "x")]
    want = with_empty(rows, brute(damaged(rows)))
    got = dialogue.repair_report(dialogue.damage(frame(spark, rows)))
    assert report(got) == sorted(want.values(), key=str)


def test_without_damage_and_turns(spark):
    rows = [(1, 0, "system", "Be good."), (1, 1, "user", "Hi."), (1, 2, "user", "Hi."), (1, 3, "assistant", "Yes"), (1, 5, "user", "Bye."),
            (2, 7, "assistant", ""), (3, 1, "user", "Hi.")]
    d = dialogue.turns_of(frame(spark, rows))
    assert report(dialogue.repair_report(d)) == sorted(brute([(c, t, r, x) for c, t, r, x in rows]).values(), key=str)
    got = sorted(map(tuple, dialogue.repaired_turns(d).collect()))
    assert [g for g in got if g[0] == 1] == [(1, 0, "system", "Be good.", "K"), (1, 1, "user", "Hi.", "K"), (1, 2, "assistant", "Yes", "K")
                                             , (1, 3, "user", "Bye.", "K"), (1, 4, "assistant", "", "I")]
    assert [g for g in got if g[0] == 3] == [(3, 0, "user", "Hi.", "K"), (3, 1, "assistant", "", "I")] and not [g for g in got if g[0] == 2]


def test_long_conversation_over_many_ranges(spark):
    r = random.Random(4)
    rows = [(1, t, r.choice(["user", "assistant"]), r.choice([f"t{t}.", "same.", "cut"])) for t in range(6000)]
    rows += [(1, None, "user", "again.")] * 500 + [(c, 0, "user", "Hi.") for c in range(2, 60)]
    got = {g.conv_id: g for g in dialogue.repair_report(dialogue.turns_of(frame(spark, rows))).collect()}
    text = [(t is not None, t or 0, role, hashlib.sha256(x.encode()).digest(), x) for c, t, role, x in rows if c == 1]
    path, seen, signature = dialogue.Path(), set(), ""
    for _, _, role, _, x in sorted(text):
        fault = 3 if (role, x) in seen else 0 if x[-1] == "." else 1
        seen.add((role, x))
        signature += dialogue.SYMBOLS["sua".index(role[0]) * 4 + fault]
    forced = [s for i, s in enumerate(dialogue.SYMBOLS) if i % 4 > 1]
    path.follow("".join("C" if s in forced else s for s in reversed(signature)))
    cost, audit = path.read()
    assert (got[1].cost, got[1].audit, got[1].gaps, got[1].duplicate) == (cost, audit, 0, sum(s in forced for s in signature))
    assert len(path.nodes) < 200 and len(got) == 59


def test_nodes_are_shared():
    path = dialogue.Path()
    for back in ("", "E", "EI", "EIE", "EIEC", "IEI", "F", "FFFFFFFF", "N" * 50):
        path.follow(back)
        assert path.read()[0] >= 0
    made = len(path.nodes)
    path.follow("EIEC")
    path.read()
    assert len(path.nodes) == made


def test_empty_table_and_long_text(spark):
    assert dialogue.repair_report(dialogue.damage(frame(spark, []))).count() == 0
    rows = [(1, 0, "user", "w" * 3_000_000 + " " * 1_000_000), (1, 1, "assistant", " " * 2_000_000)]
    assert report(dialogue.repair_report(dialogue.turns_of(frame(spark, rows)))) == sorted(brute(rows).values(), key=str)


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.QUERIES["op11_conversations"](spark, sf)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert report(got) == sorted(with_empty(rows, brute(damaged(rows))).values(), key=str)
