"""SimHash fingerprints and the links between all that differ in a few bits.

Meet in the middle: two 64-bit fingerprints at most 2 r bits apart have a common variant at
most r bits from each. Every distinct fingerprint emits its variants, and those that share a
variant are linked. A variant is dealt out by its leading block of bits: the variants of one
fingerprint that fall into one block value travel as a single row (block value, fingerprint)
and are spelled out in the task that has the block, which compares them by one sort. With b
bits in the block a fingerprint is 1 + b + b (b - 1) / 2 rows instead of 2,081, for r = 2.

All fingerprints that share a variant v are within r of v, so within 2 r of each other: the
group is a clique and a star to its smallest member keeps its links. A task hands on a
spanning forest of its links; the components of all forests are found by
:mod:`granary.llm.components`. Copies share a fingerprint and enter once, so a large group of
copies is one row; a group of near copies is bounded by the number of its fingerprints.

Results: a null or blank text has fingerprint zero, linked like any other; repeated rows
share a component; rows without doc_id get the component of their fingerprint; other columns
of the input are left behind and can't clash.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.llm.common import as_bytes, concat, released, slices, small_batches, text_or_empty
from granary.llm.components import components
from granary.session import durable

BITS = 64
RADIUS = 4
WORDS = 4
SEED = 42
#: Fingerprints of a block value at most, on average; more rows of a task than VARIANTS are cut.
PER_BLOCK = 64
VARIANTS = 1_000_000
_BYTE_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_OFFSETS = (np.arange(8) * 256).astype(np.int64)


def _shingles(tokens: list[bytes], words: int, seed: int = SEED) -> np.ndarray:
    if not tokens:
        return np.empty(0, np.uint64)
    one = xxhash.xxh64_intdigest
    if len(tokens) <= words:
        return np.array([one(b" ".join(tokens), seed)], np.uint64)
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1)
    starts = np.concatenate([[0], ends[: len(tokens) - words]]).tolist()
    return np.array([one(joined[s:e], seed) for s, e in zip(starts, (ends[words - 1 :] - 1).tolist())], np.uint64)


def _runs(tokens: list[bytes], hashes: np.ndarray, words: int) -> np.ndarray:
    """Hashes of the runs of ``words`` tokens, mixed from the tokens' own; of fewer tokens that of all."""
    n = len(tokens) - words + 1
    if n <= 0:
        return np.array([xxhash.xxh64_intdigest(b" ".join(tokens), SEED)] if tokens else [], np.uint64)
    out = hashes[:n] * _FACTORS[0]
    for j in range(1, words):
        out += hashes[j : j + n] * _FACTORS[j]
    return _mixed(out, 0)


def _hashed(tokens: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, tokens), np.uint64, len(tokens))


def _majority(hashes: np.ndarray) -> int:
    counts = np.bincount((hashes.view(np.uint8).reshape(-1, 8) + _OFFSETS).reshape(-1), minlength=2048)
    set_bits = (counts.reshape(8, 256) @ _BYTE_BITS).reshape(-1)
    return int(np.packbits(set_bits * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: bytes, words: int = WORDS, seed: int = SEED) -> int:
    """A bit is set if it is set in over half the hashes of the word shingles."""
    tokens = text.lower().split()  # of bytes: A-Z, and runs of space and \t to \r
    return _majority(_shingles(tokens, words, seed)) if tokens else 0


def fingerprint_column(text: Column, words: int = WORDS, seed: int = SEED) -> Column:
    """Fingerprint of ``text`` as a signed long."""

    @F.arrow_udf("long")
    def prints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield concat(
                (
                    pa.array(
                        np.fromiter((fingerprint(t, words, seed) for t in as_bytes(part)), np.uint64, len(part)).view(np.int64)
                    )
                    for part in slices(batch)
                ),
                pa.int64(),
            )

    return prints(text)


def flips(bits: list[int], most: int) -> list[int]:
    """All masks over ``bits`` with at most ``most`` bits set."""
    return [sum(1 << b for b in chosen) for k in range(most + 1) for chosen in combinations(bits, k)]


def block_bits(fingerprints: int) -> int:
    """Bits of the block, so that a block value has about PER_BLOCK fingerprints of its own."""
    return min(32, max(12, math.ceil(math.log2(max(1, fingerprints / PER_BLOCK)))))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def dealt(fingerprints: DataFrame, block: int, half: int, width: int = BITS) -> DataFrame:
    """(block value, flips left, fingerprint) for every block value that variants fall into."""
    top = list(range(width - block, width))
    masks = F.array(*[F.struct(F.lit(_signed(m)).cast("long").alias("m"), F.lit(half - m.bit_count()).cast("byte").alias("left"))
                      for m in flips(top, half)])
    value = F.shiftrightunsigned(F.col("fp").bitwiseXOR(F.col("x.m")), width - block)
    return fingerprints.select("fp", F.explode(masks).alias("x")).select(value.alias("block"), F.col("x.left").alias("left"), "fp")


def neighbours(block: np.ndarray, left: np.ndarray, fps: np.ndarray, bits: int, masks: list[np.ndarray], width: int) -> np.ndarray:
    """Pairs (smaller, larger) of fingerprints that share a variant: next to each other, and each with the least."""
    low = np.uint64((1 << (width - bits)) - 1)
    keys, owners = [], []
    for k, own in enumerate(masks):
        mine = np.flatnonzero(left == k)
        if len(mine):
            base = (block[mine].astype(np.uint64) << np.uint64(width - bits)) | (fps[mine] & low)
            keys.append((base[:, None] ^ own[None, :]).reshape(-1))
            owners.append(np.repeat(fps[mine], len(own)))
    key, owner = np.concatenate(keys), np.concatenate(owners)
    order = np.argsort(key)
    key, owner = key[order], owner[order]
    same = np.concatenate([[False], key[1:] == key[:-1]])
    shared = same | np.append(same[1:], False)
    key, owner = key[shared], owner[shared]
    order = np.lexsort((owner, key))  # only what shares a variant is put in order
    key, owner = key[order], owner[order]
    first = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.empty(0, bool)
    later = np.flatnonzero(~first)
    least = owner[np.flatnonzero(first)[np.cumsum(first) - 1]] if len(key) else owner
    pairs = np.concatenate([np.column_stack([owner[later - 1], owner[later]]), np.column_stack([least[later], owner[later]])])
    return np.unique(pairs[pairs[:, 0] != pairs[:, 1]], axis=0)


def forest(pairs: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprint, smallest of its tree) that connect what the pairs connect."""
    near = np.bitwise_count(pairs[:, 0] ^ pairs[:, 1]) <= radius  # neighbours in a variant always are
    return _trees(pairs[near])


def closest(pairs: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """At most two of the pairs for each fingerprint: with the closest one, and with the smallest."""
    distance = np.bitwise_count(pairs[:, 0] ^ pairs[:, 1])
    pairs, distance = pairs[distance <= radius], distance[distance <= radius]
    a, b, d = np.concatenate([pairs[:, 0], pairs[:, 1]]), np.concatenate([pairs[:, 1], pairs[:, 0]]), np.concatenate([distance, distance])
    chosen = []
    for order in (np.lexsort((b, d, a)), np.lexsort((b, a))):
        one = np.concatenate([[True], a[order][1:] != a[order][:-1]]) if len(a) else np.empty(0, bool)
        chosen.append(np.column_stack([a[order][one], b[order][one]]))
    kept = np.unique(np.sort(np.concatenate(chosen), axis=1), axis=0)
    return kept[:, 0], kept[:, 1]


def _trees(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    nodes, at = np.unique(pairs, return_inverse=True)
    at = at.reshape(pairs.shape)
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[at[:, 0]], root[at[:, 1]])
        before = root.copy()
        np.minimum.at(root, root[at[:, 0]], low)
        np.minimum.at(root, root[at[:, 1]], low)
        root = root[root]
        if (before == root).all():
            break
    inner = root != np.arange(len(nodes))
    return nodes[inner], nodes[root[inner]]


def links(fingerprints: DataFrame, radius: int = RADIUS, width: int = BITS, choose=forest) -> DataFrame:
    """(a, b): pairs of distinct ``fp`` that differ in at most ``radius`` of ``width`` bits.

    ``forest`` gives links that connect all that are connected; ``closest`` some real pairs of each.
    """
    half, n = radius // 2, fingerprints.count()
    bits = block_bits(n)
    rest = list(range(width - bits))
    masks = [np.array(flips(rest, k), dtype=np.uint64) for k in range(half + 1)]
    sizes = np.array([len(m) for m in masks])

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by block; whole blocks are taken together up to VARIANTS variants."""
        held, weight = [], 0
        for batch in batches:
            if len(batch):
                held.append(batch)
                weight += int(sizes[batch["left"].to_numpy()].sum())
            if weight > VARIANTS:
                rows = pd.concat(held)
                last = rows["block"].to_numpy() == rows["block"].iloc[-1]
                if not last.all():
                    yield rows[~last]
                    held = [rows[last]]
                    weight = int(sizes[held[0]["left"].to_numpy()].sum())
        if held:
            yield pd.concat(held)

    def linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        try:
            for rows in pieces(batches):
                fps = rows["fp"].to_numpy().view(np.uint64)
                a, b = choose(neighbours(rows["block"].to_numpy(), rows["left"].to_numpy(), fps, bits, masks, width), radius)
                yield pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})
        finally:
            released()

    parts = dealt(fingerprints, bits, half, width).repartition("block").sortWithinPartitions("block")
    return parts.mapInPandas(linked, "a long, b long")


def near_duplicates(df: DataFrame, text: str = "text", words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (smallest doc_id linked) of every row."""
    prints = durable(df.select("doc_id", fingerprint_column(text_or_empty(text), words).alias("fp")))
    classes = durable(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(classes.select("fp"), radius))
    rooted = classes.join(roots, classes.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(smallest, "root").select("fp", "component_id")
    return prints.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


#: For similar texts: FAMILIES fingerprints of FAMILY_BITS bits over pairs of words propose, and the
#: similarity of five-word shingles decides. Their SKETCH smallest hashes set aside the pairs that
#: look less than FAR similar, six standard errors below; texts of at most SKETCH different shingles
#: have their exact similarity from them, others from all shingles. What the proposals miss,
#: or a sketch sets aside, the exact search finds.
FAMILIES, FAMILY_BITS, FAMILY_WORDS = 1, 48, 2
SHINGLE_WORDS, SIMILAR, SKETCH, FAR = 5, 0.8, 256, 0.65
#: The exact search puts frequent shingles last: those that OFTEN groups of a sample of one text in SAMPLED have, the LISTED
#: most frequent at most. The order has no influence on the result. BLOCK texts work per row of a shingle.
SAMPLED, OFTEN, LISTED, BLOCK = 32, 3, 100_000, 4096
#: Before it, texts whose shingles CROWD others or more have meet a few leaders of these shingles, up to TURNS times, so that a
#: large group of near copies is one group when the exact search begins and few of it meet all. No influence on the result.
CROWD, LEADERS, TURNS = 16, 12, 3
#: Bits of the marks that tell most pairs that cannot be SIMILAR; a power of two.
MARKS = 1024
_MARKS = pa.struct([(f"m{k}", pa.int64()) for k in range(MARKS // 64)])
_MARKS_SQL = "struct<" + ",".join(f"m{k}:long" for k in range(MARKS // 64)) + ">"
#: Odd factors of the words of a shingle.
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53], np.uint64)
_SIGNATURE = pa.struct([*[(f"f{k}", pa.int64()) for k in range(FAMILIES)], ("sketch", pa.binary())])
_SIGNATURE_SQL = "struct<" + ",".join([*[f"f{k}:long" for k in range(FAMILIES)], "sketch:binary"]) + ">"


def _mixed(hashes: np.ndarray, k: int) -> np.ndarray:
    """Another hash of the same shingles, by a multiply-and-shift finish."""
    x = hashes ^ np.uint64((0x9E3779B97F4A7C15 * (k + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signature(text: bytes) -> dict:
    tokens = text.lower().split()
    hashes = _hashed(tokens)
    pairs = _runs(tokens, hashes, FAMILY_WORDS)
    out = {f"f{k}": _majority(_mixed(pairs, k)) >> (BITS - FAMILY_BITS) for k in range(FAMILIES)}
    out["sketch"] = np.unique(_runs(tokens, hashes, SHINGLE_WORDS) >> np.uint64(32))[:SKETCH].astype("<u4").tobytes()
    return out


def similarity(a: bytes, b: bytes) -> float:
    """Share of common shingles, over the smallest hashes of both texts together; 1 if both are blank."""
    x, y = np.frombuffer(a, "<u4"), np.frombuffer(b, "<u4")
    both = np.union1d(x, y)[: SKETCH if max(len(x), len(y)) == SKETCH else None]
    return float(np.isin(both, x).astype(int) @ np.isin(both, y)) / len(both) if len(both) else 1.0


def exact_similarity(a: bytes, b: bytes) -> float:
    """Share of common shingles of :func:`all_shingles`; 1 if both are blank."""
    x, y = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
    common = len(np.intersect1d(x, y, assume_unique=True))
    return common / (len(x) + len(y) - common) if len(x) or len(y) else 1.0


def _set_of(text: bytes) -> np.ndarray:
    tokens = text.lower().split()
    return np.unique(_runs(tokens, _hashed(tokens), SHINGLE_WORDS))


def all_shingles(text: bytes) -> bytes:
    """The different shingle hashes of a text, in order."""
    return _set_of(text).astype("<u8").tobytes()


def _candidates(classes: DataFrame) -> DataFrame:
    """(a, b): pairs of ``copy`` that some family proposes; few for each text."""
    found = None
    for k in range(FAMILIES):
        prints = durable(classes.groupBy(F.col(f"f{k}").alias("fp")).agg(F.min("copy").alias("lead")))
        near = links(prints.select("fp"), RADIUS, FAMILY_BITS, closest)
        lead = near.join(prints.toDF("a", "x"), "a").join(prints.toDF("b", "y"), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
        same = classes.join(prints, F.col(f"f{k}") == F.col("fp")).select(F.col("lead").alias("a"), F.col("copy").alias("b"))
        family = lead.unionByName(same.where("a <> b"))
        found = family if found is None else found.unionByName(family)
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def keep_one(documents: DataFrame, text: str = "text") -> DataFrame:
    """``documents`` with one row of each group of similar texts: the smallest doc_id, then hash of the text.

    Equal texts are one class from the start. Classes whose fingerprints of some family differ
    in at most RADIUS bits are compared, and linked if their five-word shingles are SIMILAR; so are
    all pairs that these links leave apart, found by an exact search, so a group is whatever SIMILAR pairs
    connect. Of rows that repeat a doc_id and text, one stays. Null doc_ids come last; blank texts are alike.
    """
    spark_text = text_or_empty(text)

    @F.arrow_udf(_SIGNATURE_SQL)
    def signatures(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        try:
            for batch in batches:
                yield concat((pa.array([signature(t) for t in as_bytes(part)], _SIGNATURE) for part in slices(batch)), _SIGNATURE)
        finally:
            released()

    copy = F.xxhash64(spark_text)
    with small_batches(documents.sparkSession):
        signed = durable(documents.select("doc_id", copy.alias("copy"), signatures(spark_text).alias("s")).select("doc_id", "copy", "s.*"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "copy")
    prints = [F.min(f"f{k}").alias(f"f{k}") for k in range(FAMILIES)]  # equal within a class
    classes = durable(signed.groupBy("copy").agg(F.min(order).alias("first"), *prints))
    pairs = durable(_candidates(classes))
    wanted = pairs.select(F.col("a").alias("copy")).union(pairs.select("b")).distinct()
    sketches = durable(signed.join(wanted, "copy", "left_semi").groupBy("copy").agg(F.min("sketch").alias("sketch")))

    @F.arrow_udf("double")
    def alike(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([similarity(x, y) for x, y in zip(a.to_pylist(), b.to_pylist())], pa.float64())

    both = pairs.join(sketches.toDF("a", "sketch_a"), "a").join(sketches.toDF("b", "sketch_b"), "b")
    full = (F.octet_length("sketch_a") == 4 * SKETCH) | (F.octet_length("sketch_b") == 4 * SKETCH)
    # a filter on a deterministic function would be computed a second time below the projection
    share = alike.asNondeterministic()("sketch_a", "sketch_b")
    judged = durable(both.select("a", "b", full.alias("full"), share.alias("share")).where(F.col("share") >= FAR))
    sure = judged.where(~F.col("full") & (F.col("share") >= SIMILAR)).select("a", "b")
    texts = documents.select(copy.alias("copy"), spark_text.alias("text"))
    with small_batches(documents.sparkSession):
        roots = durable(components(sure.unionByName(_exactly_similar(texts, judged.where("full")))))
        beginnings = durable(_marked(texts, durable(_beginnings(texts, roots))))
        joined, links = roots.limit(0), []
        crowd = durable(_crowds(beginnings))
        for turn in range(TURNS):
            near = durable(_leaders(crowd, joined, turn))
            linked = durable(_exactly_similar(texts, near).join(near, ["a", "b"]).select("group_a", "group_b"))
            if not linked.take(1):
                break
            links.append(linked)
            joined = durable(components(_all(links), "group_a", "group_b"))
        apart = durable(_pairs_apart(_regrouped(beginnings, joined)))
        links.append(_exactly_similar(texts, apart).join(apart, ["a", "b"]).select("group_a", "group_b"))
        joined = components(_all(links), "group_a", "group_b")
    first = classes.join(roots, classes["copy"] == roots["node"], "left").select(F.coalesce("root", "copy").alias("group"), "first")
    named = first.join(joined, first["group"] == joined["node"], "left")
    kept = named.groupBy(F.coalesce("root", "group")).agg(F.min("first").alias("first"))
    return _rows_of(documents, copy, kept.select(F.col("first.doc_id").alias("kept_id"), F.col("first.copy").alias("kept_copy")))


_PREFIX_SQL = "struct<n:int,shingles:array<long>>"
_PREFIX = pa.struct([("n", pa.int32()), ("shingles", pa.list_(pa.int64()))])


def _prefixes(texts: DataFrame, groups: DataFrame, late: np.ndarray | None) -> DataFrame:
    """(copy, group, n, shingles) of each text: the first of its n shingles, those of ``late`` last; without ``late`` all.

    Of two SIMILAR texts of at most n shingles each, the first n - ceil(SIMILAR n) + 1 in any one order
    share a shingle. The order is that of the hashes, then that of ``late``.
    """
    hashes = np.sort(late) if late is not None else None
    ranks = np.argsort(late) if late is not None else None
    shared = texts.sparkSession.sparkContext.broadcast((hashes, ranks))  # LISTED at most

    def prefix(text: bytes) -> dict:
        own = _set_of(text).view(np.int64)
        hashes, ranks = shared.value
        if hashes is None:
            return {"n": len(own), "shingles": own}
        if len(hashes):
            at = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
            hot = hashes[at] == own
            order = np.concatenate([own[~hot], own[hot][np.argsort(ranks[at[hot]])]])
        else:
            order = own
        return {"n": len(own), "shingles": order[: _begins(len(own))]}

    @F.arrow_udf(_PREFIX_SQL)
    def prefixes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        try:
            for batch in batches:
                yield concat((pa.array([prefix(t) for t in as_bytes(part)], _PREFIX) for part in slices(batch)), _PREFIX)
        finally:
            released()

    single = texts.select("copy", prefixes("text").alias("p")).groupBy("copy").agg(F.min("p").alias("p"))
    grouped = single.join(groups, single["copy"] == groups["node"], "left")
    return grouped.select("copy", F.coalesce("root", "copy").alias("group"), "p.n", "p.shingles")


def _begins(n: int) -> int:
    return n - math.ceil(SIMILAR * n - 1e-9) + 1


def _late_shingles(texts: DataFrame, groups: DataFrame) -> np.ndarray:
    """Hashes of the shingles that very many groups have, the rarest first, from a sample of the texts."""
    some = _prefixes(texts.where(F.pmod("copy", F.lit(SAMPLED)) == 0), groups, None)
    each = some.select("group", F.explode("shingles").alias("shingle")).distinct()
    often = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("often")).where(F.col("often") >= OFTEN)
    listed = often.orderBy(F.col("often").desc(), "shingle").limit(LISTED)
    return listed.toPandas()["shingle"].to_numpy(np.int64)[::-1]


def _beginnings(texts: DataFrame, groups: DataFrame) -> DataFrame:
    """(copy, group, n, shingle) of the beginnings of all texts, where a shingle has several groups."""
    rows = _prefixes(texts, groups, _late_shingles(texts, groups))
    return _shared(rows.select("copy", "group", "n", F.explode("shingles").alias("shingle")))


def _shared(rows: DataFrame) -> DataFrame:
    one = Window.partitionBy("shingle")
    several = F.min("group").over(one) != F.max("group").over(one)
    return rows.select("*", several.alias("several")).where("several").drop("several")


def _regrouped(rows: DataFrame, joined: DataFrame) -> DataFrame:
    """``rows`` with the roots of their groups, (node, root) in ``joined``."""
    names = [c for c in rows.columns if c != "group"]
    return rows.join(joined, rows["group"] == joined["node"], "left").select(*names, F.coalesce("root", "group").alias("group"))


def _crowds(beginnings: DataFrame) -> DataFrame:
    """The rows of shingles that CROWD texts or more have outside their largest group."""
    sizes = beginnings.groupBy("shingle", "group").agg(F.count(F.lit(1)).alias("m"))
    crowded = sizes.groupBy("shingle").agg((F.sum("m") - F.max("m")).alias("strays")).where(F.col("strays") >= CROWD)
    return beginnings.join(crowded, "shingle", "left_semi")


def _leaders(crowd: DataFrame, joined: DataFrame, turn: int) -> DataFrame:
    """(a, b, group_a, group_b): each text beside LEADERS leaders at most, drawn from those of its shingles."""
    rows = _regrouped(crowd, joined)
    drawn = F.xxhash64("copy", "shingle", F.lit(turn))
    lead = rows.groupBy("shingle").agg(F.min(F.struct(drawn.alias("by"), "copy", "group", "n", "marks")).alias("lead"))
    may = _may_be_similar(F.col("n"), F.col("lead.n"), F.col("marks"), F.col("lead.marks"))
    others = rows.join(lead, "shingle").where((F.col("group") != F.col("lead.group")) & may)
    chosen = [
        F.min(F.struct(F.xxhash64("lead.copy", "copy", F.lit(k)).alias("by"), "lead.copy", "lead.group")).alias(f"l{k}") for k in range(LEADERS)
    ]
    each = others.groupBy("copy", "group").agg(*chosen)
    one = F.explode(F.array_distinct(F.array(*[F.struct(f"l{k}.copy", f"l{k}.group") for k in range(LEADERS)]))).alias("lead")
    met = each.select("copy", "group", one).select(F.col("copy").alias("x"), F.col("group").alias("gx"), F.col("lead.copy").alias("y"), F.col("lead.group").alias("gy"))
    return _in_order(met).distinct()


def _marked(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` with the marks of their texts: for each of MARKS bits whether an odd number of shingles falls on it."""

    def mark(text: bytes) -> dict:
        odd = np.bincount((_set_of(text) >> np.uint64(64 - (MARKS - 1).bit_length())).astype(np.int64), minlength=MARKS) & 1
        return {f"m{k}": m for k, m in enumerate(np.packbits(odd.astype(np.uint8)).view(np.int64).tolist())}

    @F.arrow_udf(_MARKS_SQL)
    def marks(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        try:
            for batch in batches:
                yield concat((pa.array([mark(t) for t in as_bytes(part)], _MARKS) for part in slices(batch)), _MARKS)
        finally:
            released()

    wanted = texts.join(rows.select("copy").distinct(), "copy", "left_semi")
    known = wanted.select("copy", marks("text").alias("marks")).groupBy("copy").agg(F.min("marks").alias("marks"))
    return rows.join(known, "copy")


def _may_be_similar(m: Column, n: Column, marks_m: Column, marks_n: Column) -> Column:
    """By the numbers of shingles, and the marks: two texts differ in as many shingles as in bits, or more."""
    size = F.least(m, n) >= F.greatest(m, n) * F.lit(SIMILAR) - F.lit(1e-6)
    bits = functools.reduce(Column.__add__, [F.bit_count(marks_m[f"m{k}"].bitwiseXOR(marks_n[f"m{k}"])) for k in range(MARKS // 64)])
    return size & (m + n - bits >= (m + n) * F.lit(2 * SIMILAR / (1 + SIMILAR)) - F.lit(1e-6))


def _in_order(met: DataFrame, *more: Column) -> DataFrame:
    x_first = F.col("x") < F.col("y")
    return met.select(
        F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"),
        F.when(x_first, F.col("gx")).otherwise(F.col("gy")).alias("group_a"), F.when(x_first, F.col("gy")).otherwise(F.col("gx")).alias("group_b"),
        *more,
    )


def _all(frames: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, frames)


def _pairs_apart(beginnings: DataFrame) -> DataFrame:
    """(a, b, group_a, group_b): all pairs of ``copy`` from different groups that may be SIMILAR.

    The texts outside the largest group of a shingle meet all texts that have it, dealt into blocks; a group
    meets itself nowhere. Common shingles are in both beginnings or behind the longer rest of the
    two, so a pair has to share so many shingles of its beginnings that SIMILAR is within reach.
    """
    prefix = _shared(beginnings)
    sizes = prefix.groupBy("shingle", "group").agg(F.count(F.lit(1)).alias("m"))
    mixed = sizes.groupBy("shingle").agg(F.sum("m").alias("m"), F.max(F.struct("m", "group")).alias("most"))
    mixed = durable(mixed.select("shingle", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks"), F.col("most.group").alias("main")))
    held = prefix.join(mixed, "shingle")
    strays = held.where("group <> main").select(
        "shingle", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.col("copy").alias("x"), F.col("group").alias("gx"), F.col("n").alias("nx"), F.col("marks").alias("mx")
    )
    others = held.select(
        "shingle", F.pmod(F.xxhash64("copy"), F.col("blocks")).cast("int").alias("block"), F.col("copy").alias("y"), F.col("group").alias("gy"), F.col("n").alias("ny"), F.col("marks").alias("my"),
        (F.col("group") == F.col("main")).alias("of_main"),
    )
    # two strays meet twice
    once = (F.col("gx") != F.col("gy")) & (F.col("of_main") | (F.col("x") < F.col("y")))
    may = _may_be_similar(F.col("nx"), F.col("ny"), F.col("mx"), F.col("my"))
    met = strays.join(others, ["shingle", "block"]).where(once & may)
    pairs = _in_order(met, (F.col("nx") + F.col("ny")).alias("total"), F.greatest("nx", "ny").alias("larger"))
    pairs = pairs.groupBy("a", "b", "group_a", "group_b", "total", "larger").agg(F.count(F.lit(1)).alias("common"))
    behind = F.ceil(F.col("larger") * F.lit(SIMILAR) - F.lit(1e-9)) - 1
    wanted = F.ceil(F.col("total") * F.lit(SIMILAR / (1 + SIMILAR)) - F.lit(1e-6))
    return pairs.where(F.col("common") + behind >= wanted).select("a", "b", "group_a", "group_b")


def _exactly_similar(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b) of the ``pairs`` of ``copy`` whose shingles, all of them, are SIMILAR."""

    @F.arrow_udf("binary")
    def shingles(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        try:
            for batch in batches:
                yield concat((pa.array([all_shingles(t) for t in as_bytes(part)], pa.binary()) for part in slices(batch)), pa.binary())
        finally:
            released()

    @F.arrow_udf("double")
    def exact(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array((exact_similarity(x.as_py(), y.as_py()) for x, y in zip(a, b)), pa.float64())

    wanted = pairs.select(F.col("a").alias("copy")).union(pairs.select("b")).distinct()
    hashed = texts.join(wanted, "copy", "left_semi").withColumn("shingles", shingles("text"))
    known = durable(hashed.groupBy("copy").agg(F.min("shingles").alias("shingles")))
    both = pairs.join(known.toDF("a", "shingles_a"), "a").join(known.toDF("b", "shingles_b"), "b")
    return both.where(exact("shingles_a", "shingles_b") >= SIMILAR).select("a", "b")


def _rows_of(documents: DataFrame, copy: Column, kept: DataFrame) -> DataFrame:
    """One row for each kept key; the rank's limit reaches below the shuffle, so repeats don't travel."""
    names = documents.columns
    keyed = documents.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), copy.alias("kept_copy"), F.col("doc_id").alias("kept_id"))
    rank = F.row_number().over(Window.partitionBy("kept_id", "kept_copy").orderBy(F.xxhash64("row")))
    single = keyed.withColumn("rank", rank).where("rank = 1")
    same = single["kept_id"].eqNullSafe(kept["kept_id"]) & (single["kept_copy"] == kept["kept_copy"])
    return single.join(kept, same, "left_semi").select(*[F.col("row")[c].alias(c) for c in names])
