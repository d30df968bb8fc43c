"""The conversation trie against a dictionary of prefixes: nulls, ties, repeats, long and deep ones, clashing columns."""

import hashlib
import random
import zlib

import pytest

from opstelemetry.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth long, a long, __part long, band long, place long"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows):
    of = {}
    for c, turn, role, text in (r[:4] for r in rows):
        if c is not None:
            role, text = role or "", text or ""
            of.setdefault(c, []).append((turn is not None, turn or 0, role.encode(), text[:64].encode(), sha(text), text))
    of = {c: [(t[2], t[5]) for t in sorted(v)] for c, v in of.items()}
    rebuilt = {}
    for c, own in of.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        rebuilt[c] = of.get(base, [])[:h] + own[h:]
    members = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    least = {p: min(m) for p, m in members.items()}
    children = {p: 0 for p in members}
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for p, m in members.items():
        own = (len(m) - 1) * len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += own
    out = []
    for p, m in members.items():
        end = ",".join(map(str, sorted(c for c in m if len(rebuilt[c]) == len(p))))
        out.append((least[p], len(p), least[p[:-1]] if p else None, len(m), children[p], leaves[p], saved[p], sha(end)))
    return sorted(map(repr, out))


def found(spark, rows, **kwargs):
    full = [(*r[:4], 7, 8, 9, 10, 11) for r in rows]
    df = prefix_trie.trie(spark.createDataFrame(full, SCHEMA).repartition(3), **kwargs)
    return sorted(repr(tuple(r)) for r in df.select(*COLUMNS).collect())


def made(seed, convs, most=12):
    rnd = random.Random(seed)
    out = []
    for c in convs:
        for t in range(rnd.randint(1, most)):
            role, text = rnd.choice(["user", "assistant", None]), rnd.choice(["hi", "yes", "nö", None, "x" * 70 + rnd.choice("ab")])
            out.append((c, t if rnd.random() < 0.9 else rnd.choice([None, 3]), role, text))
    return out


@pytest.mark.parametrize("height", [2, 16])
def test_small(spark, height):
    rows = made(1, [*range(40), 53, 77, 101, -3, -5, 10**15])
    rows += rows[:7] + [(None, 1, "user", "no conversation"), (3, 1, "user", "long " * 100_000)]
    assert found(spark, rows, height=height) == expected(rows)


def test_deep_and_hot(spark):
    rnd = random.Random(2)
    deep = [(c, t, "user", "same" if t < 150 else rnd.choice("pq")) for c in (5, 500) for t in range(200)]
    copies = [(c, t, "user", "hello") for c in range(1000, 4000) for t in range(2)]
    rows = deep + copies
    assert found(spark, rows, height=4) == expected(rows)


def test_long_list_of_ends(spark):
    copies = [(c, 0, "user", "hello") for c in range(0, 15000, 5)]
    assert found(spark, copies) == expected(copies)


def test_empty(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, None, None, None)]) == []
    # c = 1 keeps none of its turns and has no first conversation: a turnless one
    assert found(spark, [(1, 0, "user", "x")]) == expected([(1, 0, "user", "x")])
