import hashlib
import random
import zlib
from math import fmod

import pytest

from granary.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]


def brute(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, digest(role or "", text or ""), (role or "", text or "")))
    own = {c: [x[3] for x in sorted(v)] for c, v in convs.items()}
    whole = {}
    for c, said in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = own.get(c - int(fmod(c, 100)), [])[:h] + said[h:]
    nodes = {}
    for c, said in whole.items():
        for d in range(len(said) + 1):
            nodes.setdefault(tuple(said[:d]), []).append(c)
    out = []
    for p, members in nodes.items():
        under = {q: m for q, m in nodes.items() if q[: len(p)] == p}
        children = {q[len(p)] for q in under if len(q) > len(p)}
        leaves = [q for q in under if not any(len(x) == len(q) + 1 and x[:-1] == q for x in under)]
        saved = sum((len(m) - 1) * len(q[-1][1]) for q, m in under.items() if q)
        ends = sorted(c for c in members if len(whole[c]) == len(p))
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), len(children), len(leaves), saved,
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def drawn(seed, convs, turns, words):
    draw, rows = random.Random(seed), []
    for c in draw.sample(range(-150, 450), convs):
        for t in range(draw.randrange(1, turns)):
            rows.append((c, t, draw.choice(["user", "assistant"]), draw.choice(words)))
    return rows


def got(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as box", "1 as ids", "2 as n", "3 as i").repartition(3)
    return sorted((tuple(r[c] for c in NAMES) for r in trie.prefix_trie(df).select(*NAMES).collect()), key=str)


@pytest.mark.parametrize("segment,container", [(1024, 1024), (2, 3), (3, 1), (1, 4)])
def test_against_brute_force(spark, monkeypatch, segment, container):
    monkeypatch.setattr(trie, "SEGMENT", segment)
    monkeypatch.setattr(trie, "CONTAINER", container)
    rows = drawn(3, 60, 9, ["a", "bé", "", "long text"])
    rows += [(c, t, "user", "same") for c in range(1000, 1030) for t in range(7)]  # copies
    rows += [(5000, t, "user", "same" if t < 8 else str(t % 3)) for t in range(25)]  # much longer than the others
    rows += [(100, None, None, None), (100, 1, "user", "x"), (100, 1, "user", "x"), (100, 1, "a", "user"), (None, 0, "user", "nobody"), (2**60 + 1, 0, "u", "y")]
    assert got(spark, rows) == brute(rows)


def test_turnless_and_empty(spark):
    rows = [(c, 0, "user", "only turn") for c in (101, 102, 103, 104, 105, 7)]  # their own turn goes, no conversation 100 or 0
    assert any(r[1] == 0 and r[7] != trie.EMPTY for r in brute(rows))
    assert got(spark, rows) == brute(rows)
    assert trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert trie.prefix_trie(spark.createDataFrame([(None, 0, "user", "x")], SCHEMA)).count() == 0


def test_numbers_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE", 7)
    rows = spark.range(1, 101).select(trie.F.col("id").alias("conv_id"), trie.F.lit(b"k").alias("key"))
    (row,) = trie.end_digests(rows).collect()
    assert (row.ends, row.digest) == (1, hashlib.sha256(",".join(map(str, range(1, 101))).encode()).hexdigest())
