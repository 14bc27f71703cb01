"""Prefix trie of conversations, by burst tries whose containers are spread over the cluster.

A turn becomes an id (the leading 16 bytes of SHA-256 of role and text), a conversation the
string of its ids, in segments of at most SEGMENT turns. Equal strings become one record with a
count, so copies weigh nothing. Records are suffixes that stand in containers under trie heads.
A container of more than CONTAINER turns is burst: the turns that all its suffixes share become
a chain of nodes, and each suffix moves on to the container of its next turn id. What remains
is dealt out by head, sorted, and swept into nodes in the tasks. A burst round is one grouping
of the records that are still waiting.

Totals of subtrees: a sweep knows those of its container; those of burst heads are summed from
their containers, in the order opposite to the bursts. A later segment of a conversation hangs
below its previous one: every node belongs to its smallest member, and what a member owns in
later segments is added where its earlier segment ends. So the work of a conversation of any
length, and of a turn, prefix or conversation that very many share, is spread.

The conversations that end at a node are hashed in two steps, the numbers of a range of
(conversation string, conv_id) first, and then these pieces in a stream for each node.

Rebuilding, as the query wants it: conversation c gets the first h turns of conversation
c - c % 100, h = crc32(decimal c) % 6, in place of its own first h.

Results: turns are ordered by turn (null first), those of one number by the digest of role and
text; null role or text is empty; repeated rows are turns of their own; rows without conv_id
take no part; ids may be negative, % then takes the sign of c; an empty table gives no nodes;
further columns are left behind. A suffix tree that branches off one suffix at a time takes a
round for each CONTAINER turns or fewer: such input is slow, not wrong.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.operators.skew import attach, number_rows, running_sums
from granary.session import durable

#: Bytes of a turn id, turns of a segment at most, and turns of a container that is swept.
WIDTH, SEGMENT, CONTAINER = 16, 1024, 1024
#: Rows of burst heads that are broadcast at most, some hundred bytes each; more are joined by key.
BROADCAST_ROWS = 50_000
#: Numbers of conversations that a piece of a digest holds at most.
PIECE = 1 << 16
ROOT = bytes(WIDTH)
BLOCK, REPLACED = 100, 6


def _digest(*parts: Column) -> Column:
    return F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 2 * WIDTH))


def _tokens(ids: str) -> Column:
    return F.octet_length(ids) / F.lit(WIDTH)


def turn_rows(turns: DataFrame) -> DataFrame:
    """conv_id, i (from 1), id and chars of every turn; texts go no further."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        _digest(F.encode(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), "utf-8")).alias("id"),
        F.length(text).cast("long").alias("chars"),
    )
    return durable(number_rows(rows, ["turn", "id"], "i", ["conv_id"]).select("conv_id", "i", "id", "chars"))


def rebuilt(numbered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, d, id, chars, n) after rebuilding, and conversations (conv_id, n), turnless ones too."""
    h = F.crc32(F.encode(F.col("conv_id").cast("string"), "utf-8")) % REPLACED
    base = numbered.where((F.col("conv_id") % BLOCK == 0) & (F.col("i") < REPLACED))
    heads = base.groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(F.struct("i", "id", "chars"))).alias("first"))
    own = numbered.groupBy("conv_id").agg(F.count("*").alias("own")).select("*", h.cast("int").alias("h"), (F.col("conv_id") - F.col("conv_id") % BLOCK).alias("base"))
    taken = F.coalesce(F.slice("first", F.lit(1), F.col("h")), F.array().cast("array<struct<i:bigint,id:binary,chars:bigint>>"))
    convs = own.join(heads, "base", "left").select("conv_id", "own", "h", taken.alias("taken"))
    convs = durable(convs.select("*", (F.size("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).cast("long").alias("n")))
    later = attach(numbered.where(F.col("i") > h), convs.select("conv_id", "h", F.size("taken").alias("p"), "n"), ["conv_id"])
    later = later.select("conv_id", (F.col("i") - F.col("h") + F.col("p")).alias("d"), "id", "chars", "n")
    first = convs.select("conv_id", "n", F.explode("taken").alias("t")).select("conv_id", F.col("t.i").alias("d"), "t.id", "t.chars", "n")
    return first.unionByName(later), convs.select("conv_id", "n")


def segments(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """conv_id, layer, ids, chars (an array), n and last of every segment; a turnless conversation has an empty one."""
    layer = F.floor((F.col("d") - 1) / F.lit(SEGMENT)).cast("int")
    rows = turns.groupBy("conv_id", layer.alias("layer")).agg(F.sort_array(F.collect_list(F.struct("d", "id", "chars"))).alias("t"), F.max("n").alias("n"))
    some = rows.select(
        "conv_id", "layer", F.unhex(F.array_join(F.transform("t", lambda x: F.hex(x["id"])), "")).alias("ids"),
        F.transform("t", lambda x: x["chars"]).alias("chars"), "n",
    )
    none = convs.where("n = 0").select(
        "conv_id", F.lit(0).alias("layer"), F.lit(b"").alias("ids"), F.array().cast("array<bigint>").alias("chars"), "n"
    )
    last = F.col("layer") == F.floor(F.greatest(F.col("n") - 1, F.lit(0)) / F.lit(SEGMENT))
    return some.unionByName(none).withColumn("last", last)


def _later_heads(found: DataFrame) -> DataFrame:
    """(conv_id, layer, box, top) for every later segment: its head, and the smallest conversation through it.

    A prefix is known by four sums of 32 bits over hashes of its (id, position) pairs, which add
    up along a conversation of any length.
    """
    whole = found.where(F.col("n") >= SEGMENT)
    place = lambda x, j: F.sha2(F.concat(F.hex(x), F.lit("."), (F.col("layer") * F.lit(SEGMENT).cast("long") + j).cast("string")), 256)
    each = F.transform(F.sequence(F.lit(0), (_tokens("ids") - 1).cast("int")), lambda j: place(F.substring("ids", j * WIDTH + 1, F.lit(WIDTH)), j))
    part = lambda k: F.transform("each", lambda x: F.conv(F.substring(x, 8 * k + 1, 8), 16, 10).cast("long"))
    lanes = {f"lane{k}": F.aggregate(part(k), F.lit(0).cast("long"), lambda a, x: a + x) for k in range(4)}
    placed = whole.select("conv_id", "layer", _tokens("ids").cast("int").alias("m"), each.alias("each"))
    summed = running_sums(placed.select("conv_id", "layer", "m", *[c.alias(f"own_{n}") for n, c in lanes.items()]), ["conv_id"], ["layer"],
                          {n: F.col(f"own_{n}") for n in lanes})
    head = F.concat(*[F.lpad(F.hex(F.col(n) % F.lit(1 << 32)), 8, "0") for n in lanes])
    behind = durable(summed.where(F.col("m") == SEGMENT).select("conv_id", (F.col("layer") + 1).alias("layer"), head.alias("head")))
    tops = behind.groupBy("layer", "head").agg(F.min("conv_id").alias("top"))
    return behind.join(tops, ["layer", "head"]).select(
        "conv_id", "layer", _digest(F.encode(F.concat(F.lit("layer "), F.col("layer").cast("string"), F.lit(" "), F.col("head")), "utf-8")).alias("box"), "top"
    )


def _records(found: DataFrame) -> DataFrame:
    """Equal segments under one head, counted."""
    return found.groupBy("box", "ids").agg(
        F.any_value("layer").alias("layer"), F.any_value("chars").alias("chars"), F.any_value("top").alias("top"), F.count("*").alias("n"),
        F.min("conv_id").alias("least"), F.min(F.when(F.col("last"), F.col("conv_id"))).alias("ends"), F.max(~F.col("last")).alias("more"),
        F.sum("kids").alias("kids"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"),
    ).select(
        "*", F.lit(None).cast("binary").alias("parent_box"), F.lit(0).alias("at"), (F.col("layer") > 0).alias("boundary"), F.lit(0).cast("long").alias("head_chars")
    )


def _shared(a: str, b: str) -> Column:
    """Number of leading ids that ``a`` and ``b`` share."""
    least = F.least(_tokens(a), _tokens(b)).cast("int")
    part = lambda c, j: F.substring(c, j * WIDTH + 1, F.lit(WIDTH))
    same = F.transform(F.sequence(F.lit(0), least - 1), lambda j: part(a, j) == part(b, j))
    return F.when(least == 0, F.lit(0)).otherwise(F.coalesce(F.nullif(F.array_position(same, F.lit(False)), F.lit(0)) - 1, least.cast("long"))).cast("int")


def burst(records: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """The records of containers small enough to sweep, and the burst heads of every round."""
    waiting, ready, heads = durable(records), [], []
    while True:
        sizes = waiting.groupBy("box").agg(
            F.sum(_tokens("ids")).alias("turns"), F.count("*").alias("suffixes"), F.min("ids").alias("low"), F.max("ids").alias("high"),
            F.min_by("chars", "ids").alias("chars"), F.sum("n").alias("n"), F.min("least").alias("least"),
            *[F.any_value(c).alias(c) for c in ("layer", "at", "boundary", "top", "head_chars", "parent_box")],
        )
        over = (F.col("turns") > CONTAINER) & (F.col("suffixes") > 1)
        big = sizes.where(over | (F.col("box") == F.lit(ROOT))).withColumn("q", _shared("low", "high"))
        big = durable(big.select(*[c for c in big.columns if c not in ("turns", "suffixes", "low", "high", "chars")], F.slice("chars", F.lit(1), F.col("q")).alias("chain")))
        count = big.count()
        if count == 0:
            ready.append(waiting)
            break
        last = F.when(F.col("boundary") & (F.col("q") == 0), F.col("top")).otherwise(F.col("least"))  # of the chain's last node
        marks = big.select("box", F.col("q"), last.alias("box_least"))
        moved = durable(waiting.join(F.broadcast(marks) if count <= BROADCAST_ROWS else marks, "box", "left"))
        ready.append(moved.where("q IS NULL").drop("q", "box_least"))
        moved = moved.where("q IS NOT NULL")
        at_head = moved.where(_tokens("ids") == F.col("q")).select("box", "ends", "more", "kids", "leaves", "saved")
        heads.append(big.join(at_head, "box", "left"))
        step = (F.col("q") + 1) * WIDTH
        waiting = moved.where(_tokens("ids") > F.col("q")).select(
            _digest(F.col("box"), F.substring("ids", F.lit(1), step)).alias("box"), F.col("box").alias("parent_box"), "layer",
            (F.col("at") + F.col("q") + 1).alias("at"), F.lit(False).alias("boundary"), F.col("box_least").alias("top"),
            F.element_at("chars", F.col("q") + 1).alias("head_chars"), F.substring("ids", step + 1, F.octet_length("ids")).alias("ids"),
            F.slice("chars", F.col("q") + 2, F.size("chars")).alias("chars"), "n", "least", "ends", "more", "kids", "leaves", "saved",
        )
    out = ready[0]
    for part in ready[1:]:
        out = out.unionByName(part)
    return out, heads


NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends long, "
    "has_ends boolean, last_chars long, leaf boolean, parent_box binary"
)
_NAMES = [x.split()[0] for x in NODE.split(", ")]


def sweep(rows: list, depth: int, boundary: bool, top: int, head_chars: int, parent_box: bytes | None) -> list[tuple]:
    """Nodes of one container, from its suffixes in order; ``boundary``: the head is a node of the segment before."""
    # n, least, children, leaves, saved, chars, ends, more, parent, depth
    nodes = [[0, None, 0, 0, 0, head_chars, None, False, -1, depth]]
    path, before = [0], b""
    for ids, chars, n, least, ends, more, kids, leaves, saved in rows:
        size = min(len(before), len(ids)) // WIDTH
        if before[: size * WIDTH] == ids[: size * WIDTH]:
            common = size
        else:
            a, b = (np.frombuffer(x, np.uint8, size * WIDTH) for x in (before, ids))
            common = int(np.argmax(a != b)) // WIDTH
        del path[common + 1 :]
        for j in range(common, len(ids) // WIDTH):
            nodes.append([0, None, 0, 0, 0, chars[j], None, False, path[-1], depth + j + 1])
            path.append(len(nodes) - 1)
        node, before = nodes[path[-1]], ids
        node[0] += n
        node[1] = least if node[1] is None else min(node[1], least)
        node[6], node[7] = ends, more
        for k, x in ((2, kids), (3, leaves), (4, saved)):
            node[k] += x
    for node in reversed(nodes):  # a node stands before those below it
        leaf = node[2] == 0 and not node[7]
        node[3] += leaf
        node[4] += (node[0] - 1) * node[5]
        node.append(leaf)
        if node[8] >= 0:
            above = nodes[node[8]]
            above[0] += node[0]
            above[1] = node[1] if above[1] is None else min(above[1], node[1])
            above[2] += 1
            above[3] += node[3]
            above[4] += node[4]
    if boundary:
        nodes[0][1] = top
    out = []
    for k, (n, least, children, leaves, saved, chars, ends, _, parent, at, leaf) in enumerate(nodes):
        if k or not boundary:
            up = nodes[parent][1] if k else top
            out.append((least, at, up, n, children, leaves, saved, ends or 0, ends is not None, chars, leaf, None if k else parent_box))
    return out


def _swept(ready: DataFrame, segment: int) -> DataFrame:
    def containers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, rows, said, done = None, [], (), []

        def close() -> None:
            done.extend(sweep(rows, *said))
            rows.clear()

        for batch in batches:
            for x in batch.itertuples(index=False):
                if rows and x.box != key:
                    close()
                if not rows:
                    key, said = x.box, (x.layer * segment + x.at, x.boundary, x.top, x.head_chars, x.parent_box)
                rows.append((x.ids, x.chars.tolist(), x.n, x.least, x.ends if x.has_ends else None, x.more, x.kids, x.leaves, x.saved))
            if len(done) >= 10_000:
                yield pd.DataFrame(done, columns=_NAMES)
                done.clear()
        if rows:
            close()
        if done:
            yield pd.DataFrame(done, columns=_NAMES)

    known = ready.withColumns({"has_ends": F.col("ends").isNotNull(), "ends": F.coalesce("ends", F.lit(0))})
    return durable(known.repartition("box").sortWithinPartitions("box", "ids").mapInPandas(containers, NODE))


def _head_nodes(heads: list[DataFrame], swept: DataFrame, segment: int) -> list[DataFrame]:
    """Nodes of the burst heads and the chains below them, from the last round to the first."""
    sums = [F.sum(c).alias(c) for c in ("below", "below_leaves", "below_saved")]
    known = swept.where("parent_box IS NOT NULL").select(
        "parent_box", F.lit(1).cast("long").alias("below"), F.col("n_leaves").alias("below_leaves"), F.col("saved_tokens").alias("below_saved")
    )
    known = durable(known.groupBy("parent_box").agg(*sums))
    out = []
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    for head in reversed(heads):
        met = head.join(known.withColumnRenamed("parent_box", "box"), "box", "left").withColumn("n_children", zero("below") + zero("kids"))
        leaf = (F.col("n_children") == 0) & ~F.coalesce("more", F.lit(False))
        chars = F.concat(F.array("head_chars"), F.col("chain"))
        met = met.select("*", leaf.alias("leaf"), (zero("below_leaves") + zero("leaves") + leaf.cast("long")).alias("n_leaves"),
                         (zero("below_saved") + zero("saved")).alias("own_saved"), chars.alias("lengths"))
        total = F.col("own_saved") + (F.col("n") - 1) * F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)
        met = durable(met.withColumn("total", total))
        more = met.where("parent_box IS NOT NULL").select("parent_box", F.lit(1).cast("long").alias("below"), F.col("n_leaves").alias("below_leaves"), F.col("total").alias("below_saved"))
        known = durable(known.unionByName(more).groupBy("parent_box").agg(*sums))
        each = met.select("*", F.explode(F.sequence(F.lit(0), F.col("q"))).alias("j")).where((F.col("j") > 0) | ~F.col("boundary"))
        rest = F.aggregate(F.slice("lengths", F.col("j") + 1, F.size("lengths")), F.lit(0).cast("long"), lambda a, x: a + x)
        final = F.col("j") == F.col("q")
        above = F.when(F.col("boundary"), F.col("top")).otherwise(F.col("least"))  # of the first of a chain below a boundary
        out.append(
            each.select(
                F.col("least").alias("conv_id"), (F.col("layer") * F.lit(segment).cast("long") + F.col("at") + F.col("j")).alias("depth"),
                F.when(F.col("j") == 0, F.col("top")).when(F.col("j") == 1, above).otherwise(F.col("least")).alias("parent_conv_id"),
                F.col("n").alias("n_convs"), F.when(final, F.col("n_children")).otherwise(F.lit(1)).alias("n_children"), "n_leaves",
                (F.col("own_saved") + (F.col("n") - 1) * rest).alias("saved_tokens"), F.when(final, F.col("ends")).alias("ends"),
                F.element_at("lengths", F.col("j") + 1).alias("last_chars"), (final & F.col("leaf")).alias("leaf"),
            )
        )
    return out


def _nodes(found: DataFrame) -> DataFrame:
    """All nodes of the containers that the segments ``found`` fill."""
    ready, heads = burst(_records(found))
    swept = _swept(ready, SEGMENT)
    out = swept.withColumn("ends", F.when(F.col("has_ends"), F.col("ends"))).drop("has_ends", "parent_box")
    for part in _head_nodes(heads, swept, SEGMENT):
        out = out.unionByName(part)
    return out


def _owned(later: DataFrame) -> DataFrame:
    """(conv_id, layer, kids, leaves, saved): what hangs below a segment in later ones, under its smallest members."""
    layer = F.floor((F.col("depth") - 1) / F.lit(SEGMENT)).cast("int")
    own = _nodes(later).groupBy("conv_id", layer.alias("layer")).agg(
        F.count_if((F.col("depth") - 1) % SEGMENT == 0).alias("kids"), F.count_if("leaf").alias("own_leaves"),
        F.sum((F.col("n_convs") - 1) * F.col("last_chars")).alias("own_saved"),
    )
    # every later segment of a conversation, also those in which it owns nothing
    rows = later.select("conv_id", "layer").join(own, ["conv_id", "layer"], "left").fillna(0).withColumn("back", -F.col("layer"))
    summed = running_sums(rows, ["conv_id"], ["back"], {"leaves": F.col("own_leaves"), "saved": F.col("own_saved")})
    return summed.select("conv_id", (F.col("layer") - 1).alias("layer"), "kids", "leaves", "saved")


def end_digests(rows: DataFrame) -> DataFrame:
    """(ends, digest) for every ``key``: its smallest conv_id, and the hash of all of them in order, comma-joined."""

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, ids, done = None, [], []

        def close() -> None:
            done.append((now, ids[0], ",".join(map(str, ids))))
            ids.clear()

        for batch in batches:
            for key, conv in zip(batch["key"], batch["conv_id"].tolist()):
                if ids and (key != now or len(ids) >= PIECE):
                    close()
                now = key
                ids.append(conv)
            if done:
                yield pd.DataFrame(done, columns=["key", "first", "said"])
                done.clear()
        if ids:
            close()
            yield pd.DataFrame(done, columns=["key", "first", "said"])

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, first, state, done = None, 0, None, []
        for batch in batches:
            for key, start, said in zip(batch["key"], batch["first"].tolist(), batch["said"]):
                if state is None or key != now:
                    if state is not None:
                        done.append((first, state.hexdigest()))
                    now, first, state = key, start, hashlib.sha256(said.encode())
                else:
                    state.update(f",{said}".encode())
            if done:
                yield pd.DataFrame(done, columns=["ends", "digest"])
                done = []
        if state is not None:
            yield pd.DataFrame([*done, (first, state.hexdigest())], columns=["ends", "digest"])

    order = ("key", "conv_id")
    dealt = rows.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(pieces, "key binary, first long, said string")
    return dealt.repartition("key").sortWithinPartitions("key", "first").mapInPandas(hashed, "ends long, digest string")


EMPTY = hashlib.sha256(b"").hexdigest()


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Nodes of the trie over (conv_id, d, id, chars, n) rows and (conv_id, n) conversations."""
    found = durable(segments(turns, convs))
    nothing = {c: F.lit(0).cast("long") for c in ("kids", "leaves", "saved")}
    start = found.where("layer = 0").select("*", F.lit(ROOT).alias("box"), F.lit(None).cast("long").alias("top"))
    if (convs.agg(F.max("n")).first()[0] or 0) >= SEGMENT:
        later = durable(found.where("layer > 0").join(_later_heads(found), ["conv_id", "layer"]))
        below = durable(_owned(later.withColumns(nothing)))
        everything = start.unionByName(later).join(below, ["conv_id", "layer"], "left").fillna(0, list(nothing))
    else:
        everything = start.withColumns(nothing)
    nodes = durable(_nodes(everything))
    key = _digest(F.col("box"), F.col("ids"))
    digests = end_digests(everything.where("last").select(key.alias("key"), "conv_id"))
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
    some = nodes.where("ends IS NOT NULL").join(digests, "ends").select(*names, F.col("digest").alias("ends_sha256"))
    return some.unionByName(nodes.where("ends IS NULL").select(*names, F.lit(EMPTY).alias("ends_sha256")))


def prefix_trie(turns: DataFrame) -> DataFrame:
    """Nodes of the trie over all rebuilt conversations."""
    return trie(*rebuilt(turn_rows(turns)))
