"""PII (op 2): equal to the plain patterns, and linear in very long runs."""
import random
import re
import time

from awkward import none, odd, small  # noqa: F401

from tidemark.llm import pii

IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


def test_spelled_addresses_equal_their_patterns():
    random.seed(4)
    parts = ["[at]", "(AT)", "[at)", " ", ".", "a", "b1", "_", "-", "+", "[dot]", "(dot)", " (DOT] ", "x.y", "é", "\n", ",", "..", "a.b"]
    for _ in range(20_000):
        t = "".join(random.choices(parts, k=random.randint(1, 14)))
        for j in range(2):
            assert list(pii._spelled(t, j)) == [m.span() for m in pii._LOOSE[j][2].finditer(t)], t


def test_ip_pattern_is_the_contracts():
    random.seed(5)
    for _ in range(20_000):
        t = "".join(random.choices("0129. x", k=random.randint(1, 25)))
        assert [m.span() for m in pii._IP.finditer(t)] == [m.span() for m in IP.finditer(t)], t


def test_overlaps_equal_all_pairs(small):
    random.seed(6)
    bits = ["+1 415 555 2671 ", "555 123 4567", "a.b@c.de ", "10.0.0.1 ", "4111 1111 1111 1111", " token = abcdef0123456789", "x [at] y [dot] com", " ", "-"]
    for t in ["".join(random.choices(bits, k=12)) for _ in range(500)] + [r.text for r in small.collect()]:
        base, rows = pii.candidates(t)
        loose = [(s, e) for _, s, e, b, _ in rows if not b]
        assert not any(s < y and x < e for s, e in loose for _, x, y in base)
        assert not any(s < y and x < e for i, (s, e) in enumerate(loose) for x, y in loose[:i])


def test_long_runs_take_linear_time():
    n = 1_000_000
    for t in ("1" * n, "." * n, "-" * n, "a." * n, "1." * n, "0" * n + ".1.1.1", "[at] " + "a." * n, "a" * n + "[at]", "(at)" * (n // 4), "+1" + " " * n, "a@" * n,
              "+1 415 555 2671 " * (n // 50), "1-" * n, "(12) " * (n // 5)):
        began = time.time()
        pii.candidates(t)
        assert time.time() - began < 30, t[:10]


def test_gazetteers():
    known = pii._known
    assert known("card", "4111 1111 1111 1111") and not known("card", "9111 1111 1111 1111") and not known("card", "3411 1111 1111 1111")
    assert known("phone", "+49 30 901820") and known("phone", "+1 415 555 2671") and not known("phone", "+1 415 555 26")
    assert known("email", "a [at] b [dot] org") and not known("email", "a@b.zzz")
    assert known("ip", "2001:db8::1") and known("secret", "db_password = x") and not known("secret", "colour = abc")
