"""All spans of secrets against a plain reading of the rules, also with very many matches."""

import math
import random
import re
import time
from collections import Counter

import pytest

from tripwright.llm import entropy_secrets

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.I | re.A,
)
FIRST = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def entropy(text: str) -> float:
    def of(window: str) -> float:
        n = len(window)
        return -sum(c / n * math.log2(c / n) for c in Counter(window).values())

    return max(of(text[i : i + 20]) for i in range(len(text) - 19))


def brute(text: str) -> str:
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]{16,}", text)]
    covered = bytearray(len(text))
    for start, _, end in spans:
        covered[start:end] = b"\1" * (end - start)
    for m in re.finditer("[A-Za-z0-9+/_=-]{20,}", text):
        found, is_hex = m[0], re.fullmatch("[0-9a-fA-F]+", m[0])
        if any(re.search(p, found) for p in entropy_secrets.ALLOW) or any(covered[m.start() : m.end()]):
            continue
        if not (re.search("[0-9]", found) and re.search("[A-Za-z]", found)):
            continue
        if entropy(found.lower() if is_hex else found) >= (3.0 if is_hex else 3.8) - 1e-12:
            spans.append((m.start(), 3, m.end()))
    return ",".join(f"{entropy_secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def pieces(draw: random.Random, n: int) -> str:
    def key(alphabet: str, least: int, most: int) -> str:
        return "".join(draw.choices(alphabet, k=draw.randint(least, most)))

    kinds = (
        lambda: key("0123456789abcdef", 12, 40),
        lambda: key("0123456789ABCDEF", 16, 40),
        lambda: key(FIRST + "0123456789+/_-", 10, 40),
        lambda: "secret=" + key(FIRST + "0123456789.", 8, 30),
        lambda: "AKIA" + key(FIRST[:26] + "0123456789", 10, 20),
        lambda: key(FIRST, 20, 30) + "😀" + key("0123456789abcdef", 16, 20),
        lambda: "word/" + key(FIRST[26:], 3, 9) + "/" + key("abcdef0123456789", 16, 20),
    )
    return "".join(draw.choice(kinds)() + draw.choice((" ", "\n", ". ", "=")) for _ in range(n))


@pytest.mark.parametrize("n", (1, 3, 40, 255, 256, 257, 513))
def test_spans_are_brute_force(spark, n):
    draw = random.Random(n)
    texts = [pieces(draw, n) for _ in range(8)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in entropy_secrets.report(frame).collect():
        assert r.spans == brute(texts[r.doc_id])


def test_a_text_of_forty_thousand_matches(spark):
    """Ten times the matches must not take a hundred times as long."""
    draw = random.Random(8)
    times = {}
    for n in (400, 4000, 40_000):  # the first one warms up
        text = " ".join(f"{draw.getrandbits(72):018x}" for _ in range(n))
        text += " Zq8Rk2Lw9Xv4Tb7Nc1Ye6Uj3"
        frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
        began = time.monotonic()
        row = entropy_secrets.report(frame).first()
        times[n] = time.monotonic() - began
        assert row.n_hex == n and row.spans == brute(text)
    assert times[40_000] < 30 * max(times[4000], 0.5)
