"""Periodic runs against a brute-force search."""

import random
import zlib
from hashlib import sha256

from scarmap.llm import periodic


def runs_by_trying(words):
    n, out = len(words), []
    for i in range(n):
        for q in range(1, n // 4 + 1):
            if i and i - 1 + q < n and words[i - 1] == words[i - 1 + q]:
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length < max(6, 4 * q):
                continue
            part = words[i : i + length]
            if any(all(part[k] == part[k + d] for k in range(length - d)) for d in range(1, q)):
                continue
            out.append((i, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_of_random_texts():
    rng = random.Random(5)
    for _ in range(400):
        words = [rng.choice("abc"[: rng.randint(1, 3)]) for _ in range(rng.randint(0, 40))]
        if rng.random() < 0.6:
            words += words[: rng.randint(1, 6)] * rng.randint(3, 7)
        assert periodic.find_runs(words) == runs_by_trying(words), words


def test_long_periods_are_found():
    rng = random.Random(6)
    for q in (63, 64, 65, 100, 127, 128, 129, 200, 255, 256, 257):
        part = [str(rng.randint(0, 9)) for _ in range(q)]
        words = [str(rng.randint(10, 99)) for _ in range(rng.randint(0, 300))] + part * 4 + part[: rng.randint(0, q - 1)] + ["x", "y"] + [str(rng.randint(10, 99)) for _ in range(rng.randint(0, 300))]
        assert [r for r in periodic.find_runs(words) if r[2] >= 30] == [r for r in runs_by_trying(words) if r[2] >= 30]
        assert any(r[2] == q for r in periodic.find_runs(words))


def test_lags_leave_out_no_run():
    rng = random.Random(7)
    for _ in range(30):
        words = []
        while len(words) < 3000:
            part = [rng.choice("ab") for _ in range(rng.randint(60, 160))]
            words += part * rng.randint(1, 5)
        assert {r[2] for r in periodic.find_runs(words)} == {r[2] for r in runs_all_lags(words)}


def runs_all_lags(words):
    kept, periodic.DENSE = periodic.DENSE, 1 << 30
    try:
        return periodic.find_runs(words)
    finally:
        periodic.DENSE = kept


def collapsed_by_hand(words, runs):
    return [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs)]


def test_query_rows(spark):
    long_text = " ".join(["p q r"] * 40_000)
    texts = [(1, None), (2, ""), (3, " \t\n"), (4, "a " * 6), (5, "a a a a a"), (6, "x y x y " * 4), (6, "x y x y " * 4), (None, "b b b b b b"), (7, long_text)]
    rng = random.Random(8)
    texts += [(i, " ".join(rng.choice("abcd") for _ in range(rng.randint(1, 90)))) for i in range(10, 130)]
    docs = spark.createDataFrame([(d, t, "other", 1) for d, t in texts], "doc_id long, text string, runs string, collapsed int")
    rows = periodic.run_digest(periodic.periodic_runs(docs, periodic.planted_runs)).collect()
    assert len(rows) == len(texts)
    got = sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id or 0))
    for r, (d, t) in zip(got, sorted(texts, key=lambda x: (x[0] is None, x[0] or 0)), strict=True):
        words = periodic.WORDS.findall(t or "")
        h = zlib.crc32(str(d).encode()) if d is not None else 1
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        runs = runs_by_trying(words) if len(words) < 1000 else [(0, 120_000, 3)]
        assert r.n_runs == len(runs)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else None
        assert (r.start, r.length, r.period) == (best or (None, None, None))
        assert r.exponent_milli == (1000 * best[1] // best[2] if best else None)
        assert r.runs_sha256 == sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        if len(words) < 1000:
            assert r.collapsed_sha256 == sha256(" ".join(collapsed_by_hand(words, runs)).encode()).hexdigest()
    assert any(zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in texts if d)
    assert periodic.run_digest(periodic.periodic_runs(docs.limit(0))).count() == 0


def test_very_long_repetitive_texts():
    for part in (["a"], ["a", "b", "c"], [str(i) for i in range(70)]):
        words = part * (300_000 // len(part))
        assert periodic.find_runs(words) == [(0, len(words), len(part))]
    rng = random.Random(9)
    part = [rng.choice("ab") for _ in range(90)]
    nested = [w for _ in range(4) for w in (["a", "b"] * 200 + part * 5 + ["c"] * 7)]
    assert periodic.find_runs(nested) == runs_all_lags(nested)
