"""The audit against plain counting, over odd tables, long dictionaries and many sources."""

import collections
import random
import re

import numpy as np

from groundplan.llm import divergence


def brute(rows, least=10):
    docs, count, groups = collections.Counter(), collections.Counter(), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text or "")]
        groups.add((lang, source))
        for t in terms:
            count[lang, source, t] += 1
            count[lang, None, t] += 1
        docs.update((lang, t) for t in set(terms))
    out = []
    for lang in {x for x, _ in groups}:
        kept = sorted((t for x, t in docs if x == lang and docs[x, t] >= least), key=lambda t: t.encode())
        sources = [None, *sorted(s for x, s in groups if x == lang)]
        p = {}
        for s in sources:
            n = sum(count[lang, s, t] for t in kept)
            p[s] = [1 + 10**9 * (count[lang, s, t] + 2) // (n + 2 * len(kept)) for t in kept]
        f = lambda x, y: (x - y) ** 2 // (x + y)
        for s in sources[1:]:
            pairs = [(sum(map(f, p[s], p[o])), o) for o in sources[1:] if o != s]
            terms = [(f(x, q), t) for x, q, t in zip(p[s], p[None], kept, strict=True) if count[lang, s, t] and x > q]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda r: (-r[0], r[1].encode()))
                out += [(lang, s, part, item, v, k) for k, (v, item) in enumerate(found, 1) if part == "pair" or k <= 10]
    return sorted(out)


def rows_of(df):
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"] and [t for _, t in df.dtypes[-2:]] == ["bigint", "int"]
    return sorted(map(tuple, df.collect()))


def corpus(n, words, sources, langs=("en", "de", None), seed=3):
    r = random.Random(seed)
    vocabulary = [r.choice(["", "É", "zż", "日本", "X"]) + "".join(r.choice("abcXYZñ") for _ in range(r.randint(1, 4))) for _ in range(words)]
    odd = [None, "", " 12 3", "wORD-wORD'word", "\x7fé\x00é", "w" * 5000]
    text = lambda: " ".join(r.choices(vocabulary, k=r.randint(0, 40), weights=[1 / (i + 1) for i in range(words)]))
    return [(r.choice(odd) if r.random() < 0.1 else text(), r.choice(langs), r.choice(sources)) for _ in range(n)]


def test_against_counting(spark):
    rows = corpus(400, 60, [None, "a", "B", "ß", "src 1"])
    rows += rows[:40] + [("alone", "xx", "one"), ("alone too", "xx", "two"), (None, "yy", "three")]
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(3)
    assert rows_of(divergence.audit(df)) == brute(rows)


def test_small_chunks_and_blocks(spark, monkeypatch):
    """Chunks of few terms or cells, matrices of few cells, sources in blocks: equal results. Patched where the driver holds the code."""
    rows = corpus(500, 80, [f"s{i}" for i in range(14)], ("en", "fr"))
    table = __import__("pyarrow").table([list(c) for c in zip(*[(t, x, s) for t, x, s in rows], strict=True)], names=["text", "lang", "source"])
    want = brute(rows, 3)
    counts = spark.createDataFrame(table.to_pandas(), "text string, lang string, source string").repartition(3)
    counts = divergence.term_counts(counts).filter("term <> ''").orderBy("lang", "term").toArrow().combine_chunks()
    for cells, terms, dense in ((1 << 18, 1024, 1 << 21), (50, 5, 1 << 21), (7, 1000, 64), (3, 2, 20), (1 << 18, 1024, 10)):
        for name, value in (("CELLS", cells), ("TERMS", terms), ("DENSE", dense)):
            monkeypatch.setattr(divergence, name, value)
        made = []
        monkeypatch.setattr(divergence, "map_arrow", lambda df, run, schema: made.append(run))
        divergence.chunks(spark.createDataFrame([], divergence.COUNTS), 3)
        rows_in = [b for b in counts.to_batches(max_chunksize=23)]
        chunks = [r for b in made[0](iter(rows_in)) for r in b.to_pylist()]
        assert max(len(c["terms"]) for c in chunks) <= max(terms, 1)
        by = collections.defaultdict(collections.Counter)
        for c in chunks:
            for s, n in zip(c["sources"], c["sums"], strict=True):
                by[c["lang"]][s] += n
        langs = {x: {"members": [{"source": s, "n": by[x][s]} for s in sorted({s for _, y, s in rows if y == x})], "all_n": sum(by[x].values()), "n_kept": sum(len(c["terms"]) for c in chunks if c["lang"] == x)} for x in ("en", "fr")}
        import pyarrow as pa

        out = [r for b in divergence._compared(iter([pa.RecordBatch.from_pylist([c | langs[c["lang"]]]) for c in chunks])) for r in b.to_pylist()]
        sums = collections.Counter()
        for r in out:
            if r["part"] == "pair":
                sums[r["lang"], r["source"], r["item"]] += r["value"]
                sums[r["lang"], r["item"], r["source"]] += r["value"]
        assert dict(sums) == {(x, s, i): v for x, s, part, i, v, _ in want if part == "pair"}
        best = collections.defaultdict(set)
        for r in out:
            if r["part"] == "term":
                best[r["lang"], r["source"]].add((-r["value"], r["item"].encode()))
        got = [(x, s, "term", t.decode(), -v, k) for (x, s), found in best.items() for k, (v, t) in enumerate(sorted(found)[:10], 1)]
        assert sorted(got) == [r for r in want if r[2] == "term"]
        monkeypatch.undo()


def test_share_is_exact():
    r = random.Random(1)
    for _ in range(3000):
        of = r.randint(1, 2 ** r.randint(1, 52))
        n = r.randint(0, of)
        assert divergence.share(np.int64(n), np.int64(of)) == 1 + 10**9 * n // of


def test_empty_table_clashing_and_missing_types(spark):
    assert divergence.audit(spark.createDataFrame([], "text string, lang string, source string")).count() == 0
    df = spark.createDataFrame([("aa bb", "en", "s", 1, "x"), ("aa", "en", "t", 2, "y")], "text string, lang string, source string, value int, rank string")
    assert rows_of(divergence.audit(df)) == [("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)]
