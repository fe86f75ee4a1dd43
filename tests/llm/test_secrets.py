import itertools
import math
import os
import random
import re

import pytest

from reelforge.llm import queries, secrets
from tests.llm.helpers import documents

SF = "/root/testdata/sf0.01"


def base_spans(text):
    """The base patterns as they are given: every match, failing ones dropped afterwards."""
    out = []
    for m in re.finditer(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 12:
            out.append(("assign", *m.span()))
    out += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out, key=lambda s: (s[1], secrets.KINDS.index(s[0])))


def test_base_patterns_on_random_texts():
    rng = random.Random(9)
    bits = ["password", "PassWd", "secret", "token", "apikey", "API_KEY", "AKIA", "ABCDEF123456789012", "0123456789abcdef", "=", ":", " ", "'", '"', "x", "ſecret", "Key", "deadbeef", "é", "longvalue1234567", "\n"]
    for _ in range(4000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(1, 14)))
        assert [s for s in secrets.spans(text) if s[0] != "guess"] == base_spans(text), text


def test_costs_rank_values():
    cheap = ["password123", "qwertyuiop", "20240131", "aaaaaaaaaa", "abcabcabcabc", "abcdefgh", "hunter2"]
    dear = ["xK9$mQ2!vL", "Tr0ub4dor&3zz", "e3b3ed3cc8548923d6"]
    assert max(map(secrets.guess_bits, cheap)) < secrets.THRESHOLD_BITS < min(map(secrets.guess_bits, dear))
    assert secrets.guess_bits("thhation", frozenset({"thhation"})) < secrets.guess_bits("thhation")


def part_bits(value, words):
    """Least bits of value as one part, each kind taken literally."""
    low, n = value.lower(), len(value)
    chars = sum(math.log2(10) if c.isdigit() else math.log2(26) if c.isalpha() else math.log2(33) for c in value)
    costs = [chars]
    capital = min(2, sum(c.isupper() for c in value))
    if 3 <= n <= 24 and low in secrets.COMMON_WORDS:
        costs.append(math.log2(secrets.COMMON_WORDS.index(low) + 2) + capital)
    elif 4 <= n <= 24 and low in words:
        costs.append(math.log2(len(words) + len(secrets.COMMON_WORDS) + 2) + capital)
    year, short, month, day = r"(19|20)[0-9]{2}", "[0-9]{2}", "(0[1-9]|1[0-2])", "(0[1-9]|[12][0-9]|3[01])"
    for form in (f"{year}[-/.]?{month}[-/.]?{day}", f"{day}[-/.]?{month}[-/.]?{year}", f"{day}[-/.]?{month}[-/.]?{short}"):
        if re.fullmatch(form, value):
            costs.append(secrets.DATE_BITS)
    if re.fullmatch(year, value):
        costs.append(secrets.YEAR_BITS)
    for near, (start, turn) in zip(secrets.RUNS, secrets.RUN_BITS, strict=True):
        if n >= 3 and all(near(a, b) for a, b in zip(low, low[1:])):
            costs.append(start + turn * (n - 1))
    for k in range(1, 7):
        if n >= max(3, 2 * k) and all(low[i] == low[i + k] for i in range(n - k)):
            unit = sum(math.log2(10) if c.isdigit() else math.log2(26) if c.isalpha() else math.log2(33) for c in value[:k])
            costs.append(unit + len(bin(n // k)) - 2)
    return secrets.PART_BITS + min(costs)


def all_cuts(value, words):
    """Least cost over all 2^(n - 1) cuts, one by one."""
    n = len(value)
    parts = {(a, b): part_bits(value[a:b], words) for a in range(n) for b in range(a + 1, n + 1)}
    return min(
        sum(parts[a, b] for a, b in zip([0, *cut], [*cut, n]))
        for size in range(n)
        for cut in itertools.combinations(range(1, n), size)
    )


def test_least_cost_against_all_cuts():
    rng = random.Random(4)
    bits = ["qwe", "asd", "123", "321", "abc", "cba", "aaa", "abab", "the", "The", "star", "lorn", "2021", "0131", "31.", "12.99", "-", "x", "9", "!", "Q", "lo", "zz"]
    words = frozenset({"lorn", "thes"})
    for _ in range(400):
        value = "".join(rng.choice(bits) for _ in range(4))[: rng.randrange(1, 11)]
        assert math.isclose(secrets.guess_bits(value, words), all_cuts(value, words)), value
    for value in ("aaaaaaaaaaaa", "abcabcabcabc", "qwertyqwerty", "20210131lorn"):
        assert math.isclose(secrets.guess_bits(value, words), all_cuts(value, words)), value


def test_costs_of_long_values():
    assert secrets.guess_bits("Zq") == secrets.PART_BITS + 2 * secrets._char_bits("q")
    assert secrets.guess_bits("x" * 100_000) < 40  # a repeat, however long
    assert secrets.guess_bits("abcdef" * 20_000) < 60


def test_every_context_value_is_scored(spark):
    texts = ["token=0123456789abcdef0123", "password: hunter2x", "pwd='aaaaaaaa' secret=\"zJ8kq1Wp!x\"", "nothing", None, ""]
    got = {r["doc_id"]: r for r in secrets.scan(documents(spark, list(enumerate(texts)))).collect()}
    assert [len(got[i]["values"]) for i in range(6)] == [1, 1, 2, 0, 0, 0]
    for i, text in enumerate(texts[:3]):
        for v in got[i]["values"]:
            assert v["bits"] == secrets.guess_bits(text[v["start"] : v["end"]], frozenset(re.findall(r"[a-z]{4,24}", text.lower())) - {text[v["start"] : v["end"]].lower()})
    assert got[2]["n_guess"] == 1 and "guess" in got[2]["spans"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_values_in_the_tables_are_scored(spark):
    rows = queries.op4_secret_scan(spark, SF).collect()
    assert sum(r["n_values"] for r in rows) > 0 and sum(r["n_guess"] for r in rows) > 0 and max(r["most_bits"] for r in rows) >= secrets.THRESHOLD_BITS


def test_added_spans_leave_base_alone():
    found = secrets.spans("db pwd: zJ8kq1Wp!x and token=correcthorsebattery")
    assert [s[0] for s in found if s[0] != "guess"] == ["assign"] and ("guess", 8, 18) in found
    assert secrets.redacted("pwd: zJ8kq1Wp!x!") == "pwd: [SECRET]"


def test_values_are_scored_whole():
    """The whole value is one guess span, beside base spans of its parts, and nothing of it stays in the text."""
    for value in ("Xy7(kd9,Qw!2pLz", "hV9#kLm2,Qz8!rT4", "a<b;Zq8 >tR(5!)v", "correct horse battery staple", "abcdefgh1234!K9#xQ", "zJ8k\\'1Wp\\\"!x,Q", "q;X9!vL 0123456789abcdef0123 &tR"):
        for text in (f'password = "{value}", user', f"{{'secret': '{value}'}}", f'api_key:="{value}"', f'token => """{value}"""', f"pwd='''{value}'''"):
            at = text.index(value)
            assert ("guess", at, at + len(value)) in secrets.spans(text), text
            left = secrets.redacted(text)
            assert "[SECRET]" in left and not any(part in left for part in (value[:3], value[-3:])), (text, left)
    text = "password=abcdefgh1234!K9#xQ"
    assert secrets.spans(text) == [("assign", 0, 21), ("guess", 9, 27)] and secrets.redacted(text) == "[SECRET]"
    assert secrets.redacted('password = "Xy7(kd9,Qw!2pLz and') == 'password = "[SECRET] and'
    assert secrets.redacted('secret = "-Xy7(kd9,Qw!2pLz\\" + x') == 'secret = "[SECRET]" + x'
    # a value that a base span covers wholly is scored too; cheap ones get no span
    text = 'token = "24be64439e3e49cf46b2d7c90f3602a3"'
    assert secrets.spans(text) == sorted([*base_spans(text), ("guess", 9, 41)], key=lambda s: (s[1], secrets.KINDS.index(s[0])))
    assert not secrets.spans('password = "", secret = "your password", call(token=none,user=x)')


def test_redaction(spark):
    docs = documents(spark, [(1, "key token=abcdefghijkl0123 end"), (2, None), (3, "clean")])
    got = {r["doc_id"]: r for r in secrets.redact(docs).collect()}
    assert got[1]["text"] == "key [SECRET] end" and got[1]["n_chars"] == 16 and got[2]["text"] is None and got[3]["text"] == "clean"
