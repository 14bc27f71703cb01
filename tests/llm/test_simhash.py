import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from granary.llm import simhash
from granary.llm.components import components


def brute_print(text, words=4):
    tokens = text.encode().lower().split()
    if not tokens:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(tokens[i : i + words]), 42) for i in range(max(1, len(tokens) - words + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(links, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_fingerprint_is_the_definition():
    draw = random.Random(3)
    for _ in range(60):
        text = " ".join(draw.choice(["a", "Ab", "É", "the", "x\x0b y"]) for _ in range(draw.randrange(12)))
        assert simhash.fingerprint(text.encode()) == brute_print(text)


def test_all_links_within_four_bits_are_found(spark):
    draw = random.Random(5)
    prints = {0}
    for _ in range(120):
        base = draw.getrandbits(64)
        prints.add(base)
        for _ in range(4):
            prints.add(base ^ sum({1 << draw.randrange(64) for _ in range(draw.randrange(8))}))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    linked = {tuple(r) for r in simhash.links(df).collect()}
    want = classes([(a, b) for a in signed for b in signed if a < b and bin((a ^ b) & (2**64 - 1)).count("1") <= 4], signed)
    got = classes(linked, signed)
    assert {frozenset(n for n in signed if want[n] == r) for r in want.values()} == {
        frozenset(n for n in signed if got[n] == r) for r in got.values()
    }


def test_large_group_of_near_copies_is_one_component(spark):
    rng = np.random.default_rng(0)
    base = int(rng.integers(0, 2**62))
    df = spark.createDataFrame([(base ^ (1 << int(i)) ^ (1 << int(j)),) for i in range(40) for j in range(i)], "fp long")
    assert simhash.links(df).selectExpr("a").union(simhash.links(df).selectExpr("b")).distinct().count() == 40 * 39 // 2


def test_components_of_a_path_in_any_order(spark):
    draw = random.Random(2)
    pairs = [(i, i + 1) for i in range(60)] + [(100, 101), (7, 7), (101, 100)]
    draw.shuffle(pairs)
    df = spark.createDataFrame([*pairs, (None, 3)], "a long, b long")
    got = {r.node: r.root for r in components(df).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    assert components(df.limit(0)).count() == 0


def test_odd_rows(spark):
    rows = [(5, None), (4, ""), (9, " \t\n"), (7, "one two three four five"), (3, "One two three FOUR five"), (3, "One two three FOUR five"),
            (None, "one two three four five"), (8, "z " * 50_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("fingerprint", "component_id", "fp", "root")})
    out = {(r.doc_id, r.fingerprint): r.component_id for r in simhash.near_duplicates(df).collect()}
    zero, one = "0" * 16, f"{brute_print('one two three four five'):016x}"
    assert out[(5, zero)] == out[(4, zero)] == out[(9, zero)] == 4
    assert out[(7, one)] == out[(3, one)] == out[(None, one)] == 3
    assert simhash.near_duplicates(df.limit(0)).count() == 0
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 8]


def test_long_texts_are_decided_exactly(spark):
    draw, rows, want, wrong = random.Random(11), [], [], 0
    for k in range(60):
        a = [f"w{draw.randrange(10**6)}" for _ in range(1500)]
        cut = 334 if k % 2 else 372  # of the end, in one piece: similar by 0.80 or 0.78
        b = a[: 1500 - cut // 2] + [f"v{draw.randrange(10**6)}" for _ in range(cut // 2 - 2 * (k % 2))]
        x, y = (" ".join(t).encode() for t in (a, b))
        exact = simhash.exact_similarity(simhash.all_shingles(x), simhash.all_shingles(y))
        wrong += (simhash.similarity(simhash.signature(x)["sketch"], simhash.signature(y)["sketch"]) >= 0.8) != (exact >= 0.8)
        rows += [(2 * k, x.decode()), (2 * k + 1, y.decode())]
        want.append(exact >= 0.8)
    assert wrong > 3 and 10 < sum(want) < 50
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("xxhash64(text) as copy", "text", "doc_id")
    at = {r.doc_id: r.copy for r in df.collect()}
    pairs = spark.createDataFrame([(at[2 * k], at[2 * k + 1]) for k in range(60)], "a long, b long")
    assert {r.a for r in simhash._exactly_similar(df.select("copy", "text"), pairs).collect()} == {at[2 * k] for k in range(60) if want[k]}
    kept = {r.doc_id for r in simhash.keep_one(df.select("doc_id", "text")).collect()}
    assert all(2 * k in kept for k in range(60)) and all(2 * k + 1 in kept for k in range(60) if not want[k])


def edited(draw, words, share):
    """A text and an edited copy whose five-word shingles are 0.8 to 0.9 alike."""
    while True:
        a = [f"w{draw.randrange(10**6)}" for _ in range(words)]
        b = a[: words - draw.randrange(2)]
        for _ in range(draw.randrange(1 + max(1, round(words * share)))):
            b[draw.choice([draw.randrange(len(b)), -1, 0])] = f"v{draw.randrange(10**6)}"
        b += [f"v{draw.randrange(10**6)}" for _ in range(draw.randrange(2))]
        x, y = (simhash.all_shingles(" ".join(t).encode()) for t in (a, b))
        if 0.8 <= simhash.exact_similarity(x, y) <= 0.9:
            return " ".join(a), " ".join(b)


def test_edited_copies_of_any_length_are_found(spark):
    draw, rows, pairs = random.Random(17), [], {}
    for words in (9, 12, 25, 60, 120):
        pairs[words] = []
        for _ in range(60):
            n = len(rows)
            rows += [(n + k, t) for k, t in enumerate(edited(draw, words, 0.02))]
            pairs[words].append(n)
    kept = {r.doc_id for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for words, firsts in pairs.items():
        assert {n for n in firsts} <= kept and not [n for n in firsts if n + 1 in kept], words


def test_short_texts_against_all_pairs(spark):
    """Chains, shared openings that many texts have, and a large group of near copies."""
    draw = random.Random(23)
    opening = [f"o{i}" for i in range(12)]
    rows = [" ".join(opening + [f"w{draw.randrange(10**6)}" for _ in range(draw.randrange(1, 20))]) for _ in range(150)]
    base = [f"b{i}" for i in range(40)]
    rows += [" ".join(base[:-1] + [f"x{i}"]) for i in range(80)]
    chain = [f"c{i}" for i in range(30)]
    for i in range(12):
        rows.append(" ".join(chain))
        chain[2 * i] = f"y{i}"
    rows += ["a", "a", "b", "a b c d e f", "A B C D E F"]
    prints = [simhash.all_shingles(t.encode()) for t in rows]
    close = [(i, j) for i in range(len(rows)) for j in range(i) if simhash.exact_similarity(prints[i], prints[j]) >= 0.8]
    want = set(classes(close, range(len(rows))).values())
    got = {r.doc_id for r in simhash.keep_one(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()}
    assert got == want


def test_edited_long_texts_are_found(spark):
    """Edits all over a text flip many bits of its fingerprint; pairs just above and just below the line."""
    draw, rows = random.Random(31), []
    for words in (200, 400, 900):
        for k in range(70):
            a = [f"w{draw.randrange(10**6)}" for _ in range(words)]
            b = list(a)
            for at in draw.sample(range(2, words - 2, 5), round(words * (0.0215 if k % 2 else 0.0235))):
                b[at] = f"v{draw.randrange(10**6)}"
            rows += [" ".join(a), " ".join(b)]
    rows += ["shared opening of very many texts " + " ".join(f"u{draw.randrange(10**6)}" for _ in range(150)) for _ in range(200)]
    prints = [simhash.all_shingles(t.encode()) for t in rows]
    close = [i for i in range(0, 420, 2) if simhash.exact_similarity(prints[i], prints[i + 1]) >= 0.8]
    assert 80 < len(close) < 130
    kept = {r.doc_id for r in simhash.keep_one(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()}
    assert set(range(len(rows))) - kept == {i + 1 for i in close}


def test_order_of_frequent_shingles_changes_nothing(spark, monkeypatch):
    """Texts of one template with their own middles, some close, in any order of the shingles."""
    draw = random.Random(37)
    template = [f"t{i}" for i in range(150)]
    rows = []
    for _ in range(60):
        own = [f"m{draw.randrange(10**6)}" for _ in range(draw.randrange(10, 60))]
        rows.append(" ".join(template[:75] + own + template[75:]))
        if draw.random() < 0.3:
            rows.append(" ".join(template[:75] + own[:-2] + template[70:]))
    prints = [simhash.all_shingles(t.encode()) for t in rows]
    close = [(i, j) for i in range(len(rows)) for j in range(i) if simhash.exact_similarity(prints[i], prints[j]) >= 0.8]
    want = set(classes(close, range(len(rows))).values())
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(4)
    for sampled, listed in ((1, 100_000), (1, 40), (2, 100_000)):
        monkeypatch.setattr(simhash, "SAMPLED", sampled)
        monkeypatch.setattr(simhash, "LISTED", listed)
        assert {r.doc_id for r in simhash.keep_one(df).collect()} == want
    shared = set(rows[0].split())
    texts = df.selectExpr("xxhash64(text) AS copy", "text")
    groups = texts.select(F.col("copy").alias("node"), F.col("copy").alias("root"))
    monkeypatch.setattr(simhash, "SAMPLED", 1)
    monkeypatch.setattr(simhash, "LISTED", 100_000)
    late = simhash._late_shingles(texts, groups)
    assert len(late) >= 140 and len(shared) > 150


def test_pairs_to_verify_grow_no_faster_than_a_group_of_near_copies(spark, monkeypatch):
    draw = random.Random(17)
    letters = "abcdefghijklmnopqrstuvwxyz"

    def word():
        return "".join(draw.choice(letters) for _ in range(7))

    def near(base, edits):
        words = list(base)
        for at in draw.sample(range(len(words)), edits):
            words[at] = word()
        return " ".join(words)

    one, other = [word() for _ in range(240)], [word() for _ in range(240)]
    # pairs of the first are about SIMILAR and of fingerprints far apart; the others share half their words and no more
    texts = [near(one, 3) for _ in range(150)] + [" ".join(other[:120] + [word() for _ in range(120)]) for _ in range(150)]
    verified, exactly = [], simhash._exactly_similar

    def counted(rows, pairs):
        verified.append(pairs.count())
        return exactly(rows, pairs)

    monkeypatch.setattr(simhash, "_exactly_similar", counted)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = sorted(r["doc_id"] for r in simhash.keep_one(df).collect())
    sets = [np.frombuffer(simhash.all_shingles(t.encode()), "<u8") for t in texts]
    links = [(a, b) for a in range(300) for b in range(a + 1, 300) if simhash.exact_similarity(sets[a].tobytes(), sets[b].tobytes()) >= simhash.SIMILAR]
    assert kept == sorted(set(classes(links, range(300)).values()))
    assert len(kept) < 200 and sum(verified) < 20 * len(texts)
