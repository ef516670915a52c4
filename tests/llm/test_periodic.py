"""Runs against all pairs of places and periods; the contract's query against the same."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa

from groundplan.llm import periodic, textscan

ODD = ["", None, " \n ", "a", "x " * 5, "x " * 6, "x y " * 4, "x y " * 3, "é　b\x0bé　b " * 5, "Unbroken" * 500]


def brute(words):
    """(start, length, period) by all periods, the smallest for equal ends."""
    n, best = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                best.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((a, b - a, q) for (a, b), q in best.items())


def words_of(text, doc_id):
    w = re.findall("[^\x20\x09-\x0d]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if h % 10 == 0 and n and doc_id is not None:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def told(words):
    runs = brute(words)
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(runs), *top, sha("".join(f"{a},{n},{q}\n" for a, n, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def made(r):
    """A text with powers of random roots within random words, of a small alphabet."""
    out = []
    for _ in range(r.randint(1, 6)):
        letters = "ab" if r.random() < 0.5 else "abcdefgh"
        root = [r.choice(letters) for _ in range(r.randint(1, 9))]
        out += root * r.randint(1, 7) + root[: r.randint(0, len(root))] + [r.choice(letters) for _ in range(r.randint(0, 6))]
    return " ".join(out)


def test_automaton_seeds_every_run():
    r = random.Random(5)
    for _ in range(400):
        words = made(r).split()
        codes = np.array([ord(w) for w in words])
        assert periodic.runs_within(codes, [(0, len(codes))]) == brute(words)


def test_stretches_lose_no_run():
    r = random.Random(6)
    texts = [made(r) for _ in range(600)] + [" ".join(r.choice("abc") for _ in range(300)) for _ in range(30)] + [t or "" for t in ODD]
    for s in textscan.slices(pa.array(texts), 20_000):
        got = periodic._measured(s, lambda d, n: None)
        assert got == [told(words_of(t, None)) for t in texts[s.lo : s.hi]]


def test_windows_of_long_stretches(monkeypatch):
    r = random.Random(7)
    root = [r.choice("abcdefgh") for _ in range(300)]
    words = ["x"] * 900 + root * 5 + ["a", "b"] * 400 + [r.choice("ab") for _ in range(500)]
    monkeypatch.setattr(periodic, "_windows", lambda found, f=periodic._windows: f(found, 64))
    (s,) = textscan.slices(pa.array([" ".join(words)]))
    assert periodic._measured(s, lambda d, n: None) == [told(words)]


def test_long_text():
    words = "lorem ipsum dolor sit amet " * 60_000
    (s,) = textscan.slices(pa.array([words]))
    assert periodic._measured(s, lambda d, n: None)[0][:5] == (1, 0, 300_000, 5, 60_000_000)


def test_query(spark, tmp_path):
    r = random.Random(8)
    rows = [(i if i != 3 else None, t, "x") for i, t in enumerate([*ODD, *(made(r) for _ in range(300)), *ODD])] + [(77, "same same " * 9, "y")] * 3
    spark.createDataFrame(rows, "doc_id long, text string, n_runs string").write.parquet(f"{tmp_path}/documents.parquet")
    got = periodic.op12_periodic_runs(spark, str(tmp_path))
    assert got.columns == ["doc_id", *periodic.NAMES]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(repr((i, *told(words_of(t, i)))) for i, t, _ in rows)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = {r.doc_id: r.text for r in docs.collect()}
    short = [i for i, t in rows.items() if len(t or "") < 9000]
    got = {r.doc_id: tuple(r)[1:] for r in periodic.op12_periodic_runs(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(rows) and sum(x[0] > 0 for x in got.values()) > 5
    assert all(got[i] == told(words_of(rows[i], i)) for i in short)


def test_empty_table_and_clashing_names(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert periodic.runs(empty).count() == 0
    clash = spark.createDataFrame([("a a a a a a a", 5, 1)], "text string, period int, Length int")
    x = periodic.runs(clash, key="period")
    assert x.columns == ["_period", *periodic.NAMES] and tuple(x.first())[:5] == (5, 1, 0, 7, 1)
