"""Secret scan: all rules in one pass over the bytes of every text.

The rules are compiled into one automaton (:mod:`granary.llm.automaton`). A slice of texts is
one byte array, cut at bytes that lead every state back to the start into thousands of lanes;
the lanes advance together, one byte a step. Where a rule's match ends, the matches of the
stretch since the last such byte are settled from left to right, the longest first, by the
rule's own automaton. Rows are worked on where they lie: no shuffle, no group.

Results: a null or empty text has no spans; spans of one kind don't overlap; equal rows have
equal spans; other columns pass through, and a column of the output's name is replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm.automaton import Automaton, compile_rules
from granary.llm.common import as_bytes, concat, slices

SPANS = "array<struct<kind:string,start:int,end:int>>"
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
LANES = 4096
LEAST_LANE = 256


def _either(word: str) -> str:
    """Regex for ``word`` with its letters in either case."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


@dataclass(frozen=True)
class Rule:
    """``pattern``: classes, groups, alternatives and repeats over ASCII, longest match.

    ``part``: a group that must have ``least`` characters, or the match is dropped; it has no
    say in where matches begin and end. Long counts belong there: inside the pattern every
    count multiplies the states of the others. ``hex`` has its count inside, since runs of such
    letters are in every word, and only there would every run be settled on its own.
    """

    kind: str
    pattern: str
    part: int = 0
    least: int = 0


#: Rules whose spans are always found.
ASSIGN = (
    "(" + "|".join(map(_either, ("password", "passwd", "secret", "token"))) + "|" + _either("api") + "_?" + _either("key")
    + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
BASE = (
    Rule("assign", ASSIGN, part=2, least=6),
    Rule("access", "(AKIA[A-Z0-9]+)", part=1, least=20),
    Rule("hex", "[0-9a-f]{24,}"),
)
#: Formats of keys that name themselves.
MORE = (
    Rule("forge", "gh[oprsu]_([A-Za-z0-9]+)", part=1, least=36),
    Rule("chat", "xox[abprs]-([A-Za-z0-9-]+)", part=1, least=10),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE + MORE


class Scanner:
    """The compiled rules; small, and built once on the driver."""

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        self.all = compile_rules([r.pattern for r in rules], anywhere=True)
        self.each = [compile_rules([r.pattern], anywhere=False) for r in rules]
        if not self.all.resets[10]:
            raise ValueError("a rule may not match a line end")

    def ends(self, buffer: np.ndarray, resets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of ``buffer`` behind which rules have matched, ascending, and the rules' bits."""
        a = self.all
        lanes = max(1, min(LANES, len(buffer) // LEAST_LANE))
        wanted = np.searchsorted(resets, np.linspace(0, len(buffer), lanes, endpoint=False).astype(np.int64))
        starts = np.unique(np.concatenate([[0], resets[wanted[wanted < len(resets)]] + 1]))
        starts = starts[starts < len(buffer)]
        lengths = np.diff(np.append(starts, len(buffer)))
        order = np.argsort(-lengths, kind="stable")
        at, falling = starts[order], -lengths[order]
        classes = a.byte_class[buffer]
        state = np.zeros(len(at), dtype=np.int64)
        found, masks = [], []
        for done in range(int(-falling[0])):
            open_lanes = int(np.searchsorted(falling, -done, side="left"))
            here = at[:open_lanes]
            state = a.step[state[:open_lanes] + classes[here]]
            hit = np.flatnonzero(state >= a.accepting)
            if len(hit):
                found.append(here[hit])
                masks.append(a.rules[state[hit] // a.classes])
            here += 1
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        at_end, mask = np.concatenate(found), np.concatenate(masks)
        order = np.argsort(at_end, kind="stable")
        return at_end[order] + 1, mask[order]

    def scan(self, texts: list[bytes]) -> list[list[tuple[str, int, int]]]:
        """Spans (kind, start, end) of each text in code points, by start, then rule."""
        joined = b"\n".join(texts) + b"\n"
        buffer = np.frombuffer(joined, dtype=np.uint8)
        resets = np.flatnonzero(self.all.resets[buffer])
        ends, masks = self.ends(buffer, resets)
        starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
        owner = np.searchsorted(starts, ends - 1, side="right") - 1
        out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
        for k in np.unique(owner):
            mine = owner == k
            spans = self._settle(joined, int(starts[k]), ends[mine], masks[mine], resets)
            out[k] = [(kind, *where) for kind, *where in self._points(buffer, int(starts[k]), spans)]
        return out

    def _settle(self, text: bytes, start: int, ends, masks, resets) -> list[tuple[int, int, int]]:
        found = []
        for k, rule in enumerate(self.rules):
            mine, position, i = ends[(masks >> k) & 1 == 1].tolist(), start, 0
            while i < len(mine):
                zone = int(np.searchsorted(resets, mine[i] - 1))
                first = max(position, int(resets[zone - 1]) + 1 if zone else 0)
                for s in range(first, mine[i]):
                    if end := _longest(self.each[k], text, s):
                        if not rule.part or len(re.match(rule.pattern.encode(), text[s:end])[rule.part]) >= rule.least:
                            found.append((s, k, end))
                        position = end
                        break
                i = max(i + 1, bisect_right(mine, position))
        return sorted(found)

    def _points(self, buffer: np.ndarray, start: int, spans) -> Iterator[tuple[str, int, int]]:
        """The spans with offsets in code points of their text."""
        cuts = sorted({x for s, _, e in spans for x in (s, e)})
        points, before, behind = {}, 0, start
        for x in cuts:
            before += int(np.count_nonzero((buffer[behind:x] & 0xC0) != 0x80))
            points[x], behind = before, x
        for s, k, e in spans:
            yield self.rules[k].kind, points[s], points[e]


def _longest(a: Automaton, text: bytes, start: int) -> int:
    """End of the longest match that begins at ``start``; 0 if there is none."""
    state, end = 0, 0
    for i in range(start, len(text)):
        state = int(a.step[state + int(a.byte_class[text[i]])])
        if state == a.dead:
            break
        if state >= a.accepting:
            end = i + 1
    return end


def secret_spans(spark: SparkSession, text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Column of the spans of all rules in ``text``: kind, start, end in code points."""
    shared = spark.sparkContext.broadcast(Scanner(rules))  # arrays of the size of the rules

    @F.arrow_udf(SPANS)
    def spans(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = shared.value
        for batch in batches:
            yield concat(
                (
                    pa.array(
                        [[dict(zip(("kind", "start", "end"), s)) for s in found] for found in scanner.scan(as_bytes(part))],
                        pa.list_(_SPAN),
                    )
                    for part in slices(batch)
                ),
                pa.list_(_SPAN),
            )

    return spans(text)


def scan_secrets(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, into: str = "spans") -> DataFrame:
    """``df`` with the spans of all secrets in column ``into``."""
    return df.withColumn(into, secret_spans(df.sparkSession, F.col(text), rules))


def redact(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``df`` with every stretch covered by spans replaced by ``<secret>``; null texts stay null."""
    shared = df.sparkSession.sparkContext.broadcast(Scanner(rules))

    @F.arrow_udf("string")
    def redacted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = shared.value
        for batch in batches:
            yield concat((pa.array(_redacted(scanner, part), pa.string()) for part in slices(batch)), pa.string())

    return df.withColumn(text, redacted(F.col(text)))


def _redacted(scanner: Scanner, texts: pa.Array) -> list[str | None]:
    out = texts.to_pylist()
    for k, spans in enumerate(scanner.scan(as_bytes(texts))):
        if not spans:
            continue
        pieces, done = [], 0
        for _, start, end in spans:
            if start >= done:
                pieces += [out[k][done:start], "<secret>"]
            done = max(done, end)
        out[k] = "".join([*pieces, out[k][done:]])
    return out


def digest(df: DataFrame, spans: str = "spans") -> DataFrame:
    """doc_id, counts of the base kinds, hash of the base spans, and all spans as text."""
    base = [r.kind for r in BASE]

    def listed(column: Column) -> Column:
        return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")

    def of(*kinds: str) -> Column:
        return F.filter(F.col(spans), lambda s: s.kind.isin(*kinds))

    return df.select(
        "doc_id",
        *[F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in base],
        F.sha2(listed(of(*base)), 256).alias("base_sha256"),
        listed(F.col(spans)).alias("spans"),
    )
