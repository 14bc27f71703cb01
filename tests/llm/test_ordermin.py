import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from granary.llm import ordermin
from granary.llm.ordermin import K, SKETCHES, TUPLE, kmers, likeness, sketches, spelled

SCHEMA = "doc_id long, text string"


def naive(text):
    """Every permutation over every (k-mer, occurrence), sorted; places in the order of the text."""
    hashes = [int(h) for h in kmers(text)]
    if not hashes:
        return "0000" * SKETCHES
    seen, keys = Counter(), []
    for h in hashes:
        o = seen[h]
        seen[h] += 1
        keys.append(h if o == 0 else int(ordermin._mixed(np.array([(h + o * int(ordermin._GOLD)) % 2**64], np.uint64))[0]))
    out = ""
    for mask in ordermin._MASKS.tolist():
        chosen = sorted(sorted(range(len(keys)), key=lambda p: keys[p] ^ mask)[:TUPLE])
        value = len(chosen)
        for p in chosen:
            value = int(ordermin._mixed(np.array([(value * int(ordermin._STEP) + hashes[p]) % 2**64], np.uint64))[0])
        out += f"{value >> 48:04x}"
    return out


def words(draw, n):
    return " ".join("".join(draw.choice("abcdefghijklmnop") for _ in range(draw.randint(2, 8))) for _ in range(n))


def test_sketches_are_the_minima_of_all_permutations():
    draw = random.Random(1)
    texts = ["a", "abcd", "abcde", "abcdef", "ab" * 40, "é日本𝄞x" * 9, " " * 30, *[words(draw, n) for n in (2, 9, 60)], words(draw, 30) * 3]
    for text in texts:
        assert spelled(sketches(kmers(text))) == naive(text), text
    assert spelled(sketches(kmers(""))) == "0000" * SKETCHES


def test_likeness_follows_edits_and_order():
    draw = random.Random(2)
    near, far, moved, plain = [], [], [], []
    for _ in range(60):
        text = words(draw, 80)
        one = words(draw, 1).join([text[:100], text[104:]])
        parts = text.split(" ")
        swapped = " ".join(parts[40:] + parts[:40])
        own = sketches(kmers(text))
        near.append(likeness(own, sketches(kmers(one))))
        moved.append(likeness(own, sketches(kmers(swapped))))
        far.append(likeness(own, sketches(kmers(words(draw, 80)))))
        plain.append(len(set(kmers(text).tolist()) & set(kmers(swapped).tolist())) / len(set(kmers(text).tolist()) | set(kmers(swapped).tolist())))
    assert np.mean(near) > 0.85 > 0.75 > np.mean(moved) > 0.3 and max(far) < 0.1
    assert np.mean(plain) > 0.95  # the same k-mers, in another order


def brute(rows):
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for k, (i, t) in enumerate(order):
        u = order[(k + 1) % len(order)][1]
        m = len(t) // 3
        e = t[: len(t) - m] + u[:m]
        a, b, c = (sketches(kmers(x)) for x in (t, e, u))
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), spelled(a), spelled(b), likeness(a, b), likeness(a, c)))
    return sorted(out, key=str)


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_every_document_meets_its_successor(spark, parts):
    draw = random.Random(3)
    rows = [(i, words(draw, draw.choice([1, 5, 40]))) for i in draw.sample(range(-50, 10_000), 90)]
    rows += [(2**60 + 1, "é" * 50), (2**60 + 2, None), (20_000, ""), (20_001, "x"), (None, "last of all"), (30_000, words(draw, 30_000))]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as h", "1 as part", "2 as n_chars").repartition(4)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = [tuple(r) for r in ordermin.with_edits(df).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(got, key=str) == brute(rows)


def test_repeats_single_and_empty(spark):
    text = "one text that stands twice"
    twice = ordermin.with_edits(spark.createDataFrame([(1, text), (1, text)], SCHEMA)).collect()
    assert [r.near_next for r in twice] == [1.0, 1.0] and twice[0] == twice[1]
    (alone,) = ordermin.with_edits(spark.createDataFrame([(4, "abcdefghi")], SCHEMA)).collect()
    assert alone.near_next == 1.0 and alone.edited_sha256 == hashlib.sha256(b"abcdefabc").hexdigest()
    (blank,) = ordermin.with_edits(spark.createDataFrame([(4, None)], SCHEMA)).collect()
    assert (blank.n_chars, blank.near_edited, blank.near_next) == (0, 1.0, 1.0)
    assert ordermin.with_edits(spark.createDataFrame([], SCHEMA)).count() == 0
    col = spark.createDataFrame([(1, text), (2, None)], SCHEMA).select(ordermin.fingerprint_column("text").alias("f")).collect()
    assert [r.f for r in col] == [spelled(sketches(kmers(text))), "0000" * SKETCHES] and K == 5
