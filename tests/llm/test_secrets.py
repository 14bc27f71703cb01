import random
import re

from granary.llm import secrets
from granary.llm.automaton import compile_rules
from granary.llm.secrets import BASE, RULES, Scanner

SCANNER = Scanner()
ALPHABET = [
    "token", "secret", "api_key", "apikey", "PassWord", "=", ":", " ", '"', "'", "abc", "AKIA", "ABCDEF0123456789XYZ",
    "0123456789abcdef", "deadbeef", "é", "\n", "ghp_", "xoxb-", "-----BEGIN ", "RSA ", "PRIVATE KEY-----", "a", "ab.c", "日本",
]


def brute(text):
    found = []
    for k, rule in enumerate(RULES):
        for m in re.finditer(rule.pattern, text):
            if not rule.part or len(m[rule.part]) >= rule.least:
                found.append((m.start(), k, m.end()))
    return [(RULES[k].kind, s, e) for s, k, e in sorted(found)]


def test_spans_are_those_of_each_regex_alone():
    draw = random.Random(1)
    texts = ["".join(draw.choice(ALPHABET) for _ in range(draw.randrange(60))) for _ in range(3000)]
    found = SCANNER.scan([t.encode() for t in texts])
    assert found == [brute(t) for t in texts]
    assert {kind for spans in found for kind, *_ in spans} == {r.kind for r in RULES}


def test_a_dropped_match_still_ends_where_it_ends():
    # the value "token" is too short, and what it covers is not searched again
    assert SCANNER.scan([b"secret=token : abcdefgh"]) == [[]] == [brute("secret=token : abcdefgh")]


def test_long_texts_and_matches_across_lanes():
    text = "x" * 3000 + " token=" + "A" * 50_000 + " " + "0f" * 30_000 + "\n" + "é" * 2000 + "AKIA" + "B" * 16
    assert SCANNER.scan([text.encode(), b"", text.encode()]) == [brute(text), [], brute(text)]


def test_automaton_is_minimal_and_resets():
    a = compile_rules(["ab|cb"], anywhere=True)
    assert len(a.rules) == 3 and a.resets[10] and not a.resets[ord("a")]


def test_rules_that_cannot_be_compiled_are_refused():
    for pattern in ("a*", "é", "(a)\\1", "^a"):
        try:
            compile_rules([pattern], anywhere=True)
        except ValueError:
            continue
        raise AssertionError(pattern)


def test_query_columns_and_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, "é token=abcdef1", "c"), (3, "é token=abcdef1", "c"), (None, "AKIA" + "A" * 16, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    out = secrets.digest(secrets.scan_secrets(df)).collect()
    assert [r.spans for r in out] == ["", "", "assign:2:15", "assign:2:15", "access:0:20"]
    assert [r.n_assign for r in out] == [0, 0, 1, 1, 0]
    assert secrets.scan_secrets(df.limit(0)).count() == 0
    assert [r.text for r in secrets.redact(df).collect()] == [None, "", "é <secret>", "é <secret>", "<secret>"]
    assert [r.kind for r in BASE] == ["assign", "access", "hex"]
