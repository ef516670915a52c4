"""The join against all pairs, over odd texts, near copies around the threshold, common passages and long lists."""

import os
import random
import re

import numpy as np
import pytest

from groundplan.llm import ngram_join

ODD = [None, "", " \n ", "a", "A", "a b", "a B c", "a b\tc", "x y", "x y", "word " * 500, "Word " * 700, "é É日本 🙂 b", "b " * 4]


def brute(rows, percent=85):
    def shingles(t):
        w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return frozenset(tuple(w[i : i + 4]) for i in range(len(w) - 3)) or frozenset([tuple(w)] if w else [])

    found = [shingles(t) for _, t in rows]
    by = {}
    for i, s in enumerate(found):
        for g in s:
            by.setdefault(g, []).append(i)
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, s in enumerate(found):
        shared = {}
        for g in s:
            for j in by[g]:
                shared[j] = shared.get(j, 0) + (j > i)
        for j, k in shared.items():
            if j > i and 100 * k >= percent * (len(s) + len(found[j]) - k):
                up[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(repr((d, len(s), least.get(root(i), d) if s else d)) for i, ((d, _), s) in enumerate(zip(rows, found, strict=True)))


def prose(r, n, words=400):
    return [f"w{r.randrange(words)}" for _ in range(n)]


def near(r, words, changes):
    words = list(words)
    for _ in range(changes):
        words[r.randrange(len(words))] = f"n{r.randrange(10**6)}"
    return words


def corpus(seed):
    """Bases with copies on both sides of the threshold; passages in very many texts, some of them almost nothing else."""
    r = random.Random(seed)
    out = []
    passage, other = prose(r, 60), prose(r, 40)
    for _ in range(25):
        base = prose(r, r.randint(5, 250))
        out += [near(r, base, r.randint(0, 1 + len(base) // 40)) for _ in range(r.randint(1, 12))]
    for k in range(70):
        own = prose(r, r.randint(0, 300 if k % 3 else 12))
        out.append(own + passage + (other if k % 2 else []) + prose(r, 3))
    chain = prose(r, 120)
    for _ in range(15):
        chain = chain[3:] + prose(r, 3)
        out.append(chain)
    hot = prose(r, 200)
    out += [near(r, hot, 2) for _ in range(60)] + [near(r, hot, 9) for _ in range(60)]
    texts = [" ".join(w.upper() if r.random() < 0.02 else w for w in x) for x in out]
    rows = list(enumerate(ODD + texts, 1)) + [(500 + i, r.choice(texts)) for i in range(40)]
    r.shuffle(rows)
    return rows


def got(spark, rows, **more):
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, size string").repartition(3)
    x = ngram_join.groups(df, **more)
    assert x.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted(map(repr, map(tuple, x.collect())))


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, monkeypatch, seed):
    for name, value in (("COMMON", 6), ("SHORT", 4), ("BLOCK", 8)):
        monkeypatch.setattr(ngram_join, name, value)
    rows = corpus(seed)
    rows += [(None, rows[0][1]), (None, "no id here at all"), rows[1], rows[1], (rows[2][0], "same id, other text " * 5)]
    assert got(spark, rows) == brute(rows)


def test_production_settings_and_other_thresholds(spark):
    rows = corpus(3)
    assert got(spark, rows) == brute(rows)
    assert got(spark, rows, percent=60) == brute(rows, 60)


def test_prefixes_are_lengthened(spark, monkeypatch):
    """Texts with a common passage look up rare shingles only; one that is nothing else has to look up common ones."""
    from groundplan.scratch import Scratch

    r = random.Random(4)
    passage = prose(r, 60)
    rows = [(i, " ".join(prose(r, 200, 10**6) + passage)) for i in range(80)] + [(100 + i, " ".join([*passage, f"x{i}"])) for i in range(5)]
    monkeypatch.setattr(Scratch, "drop", lambda self, *names: None)
    scratch = Scratch(spark, "test")
    assert got(spark, rows, scratch=scratch) == brute(rows)
    lists = spark.read.parquet(f"{scratch.root}/lists")
    longer = lists.filter("extra > 0")
    assert longer.select("node").distinct().count() > 70 and longer.filter("probe and size > 200").count() < 80


def test_empty_table_null_ids_and_key_name(spark):
    assert ngram_join.groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    x = ngram_join.groups(spark.createDataFrame([("a b c d e", None), ("a b c d e", None), (None, 3)], "text string, N_Shingles int"), key="N_Shingles")
    assert x.columns == ["_N_Shingles", "n_shingles", "component_id"] and sorted(map(str, x.collect())) == sorted(["Row(_N_Shingles=None, n_shingles=2, component_id=None)"] * 2 + ["Row(_N_Shingles=3, n_shingles=0, component_id=3)"])
    with pytest.raises(ValueError):
        ngram_join.groups(x, percent=0)


def test_size_of_prefixes():
    for n in range(1, 400):
        k = ngram_join._first(np.int64(n), 85)
        least = -(-85 * n // 100)
        assert k == n - least + 1 and 1 <= k <= n


def test_small_blocks_are_gathered_at_large_ones(spark):
    # each pair of blocks meets, small ones beside one another in a row: far fewer rows than pairs
    at = ("home", "tag", "probe", "part")
    blocks = [(1, -1, k < 70, k, [(1000 * k + j,) for j in range(3 if k < 70 else 60)]) for k in range(74)]
    frame = spark.createDataFrame(blocks, "home long, tag long, probe boolean, part long, nodes array<struct<node: long>>")
    pairs = [(*x[:4], *y[:4], len(x[4]), len(y[4])) for i, x in enumerate(blocks) for y in blocks[i:] if x[2] or y[2]]
    met = spark.createDataFrame(pairs, "home long, tag long, probe boolean, part long, home_ long, tag_ long, probe_ boolean, part_ long, n int, n_ int")
    rows = ngram_join._gathered(met, frame, at).collect()
    found = [frozenset((a.node // 1000, b.node // 1000)) for r in rows for a in r.nodes[:1] for b in r.others if b.node % 1000 == 0]
    assert sorted(map(sorted, found)) == sorted(sorted({p[3], p[7]}) for p in pairs)
    assert all(len({a.node // 1000 for a in r.nodes}) == 1 and len(r.nodes) == len(blocks[r.nodes[0].node // 1000][4]) for r in rows)
    assert len(pairs) == 2765 and len(rows) < 200 and max(len(r.others) for r in rows) <= 3 * ngram_join.GATHERED


def test_common_shingles_come_last(spark, monkeypatch):
    """A passage of many texts isn't in their prefixes, so that they meet in no long list; any order gives the same result."""
    from groundplan.scratch import Scratch

    monkeypatch.setattr(ngram_join, "ROWS", 10)
    monkeypatch.setattr(ngram_join, "PART", 1)
    r = random.Random(6)
    passage = prose(r, 60)
    rows = [(i, " ".join(prose(r, 200, 10**6) + passage)) for i in range(80)] + [(100 + i, " ".join([*passage, f"x{i}"])) for i in range(5)]
    monkeypatch.setattr(Scratch, "drop", lambda self, *names: None)
    scratch = Scratch(spark, "test")
    assert got(spark, rows, scratch=scratch) == brute(rows)
    lists = spark.read.parquet(f"{scratch.root}/listed")
    assert lists.count() > 0 and lists.groupBy("token").count().filter(f"count > {ngram_join.COMMON}").count() == 0
    for name, value in (("SHORT", 4), ("BLOCK", 8), ("COLUMNS", 16), ("SEEN", 6)):
        monkeypatch.setattr(ngram_join, name, value)
    rows = corpus(5)
    assert got(spark, rows) == brute(rows)


def test_needed_in_prefixes(spark):
    """Linked sets share as many shingles in their prefixes as is asked for, whatever the order."""
    r, rows = random.Random(7), []
    for _ in range(4000):
        n = r.randint(1, 120)
        base = r.sample(range(10**6), n)
        x, y = [sorted(set(base[: n - r.randint(0, n // 6)]) | {r.randrange(10**6) for _ in range(r.randint(0, n // 12))}) for _ in "ab"]
        c = len({*x} & {*y})
        if x and y and 100 * c >= 85 * (len(x) + len(y) - c):
            rows.append((len(x), len(y), len({*x[: ngram_join._first(len(x), 85)]} & {*y[: ngram_join._first(len(y), 85)]})))
    frame = spark.createDataFrame(rows, "a long, b long, n long")
    need = [k.need for k in frame.select(ngram_join._needed("a", "b", 85).alias("need")).collect()]
    assert len(rows) > 300 and max(need) > 5 and all(n >= k for k, (_, _, n) in zip(need, rows, strict=True))
    assert any(n == k > 1 for k, (_, _, n) in zip(need, rows, strict=True))


def test_links_between_blocks(monkeypatch):
    """Two blocks of near copies are joined by fewer links than they have nodes, and by all that is needed."""
    import pyarrow as pa

    monkeypatch.setattr(ngram_join, "COLUMNS", 50)
    r = random.Random(8)
    bases = [prose(r, 150, 10**6) for _ in range(3)]
    texts = [" ".join(near(r, bases[k % 3], 1)) for k in range(60)]
    block = lambda ks: pa.StructArray.from_arrays([pa.array(ks), pa.array(ks), pa.array([texts[k] for k in ks])], names=["node", "label", "text"])
    found = [*ngram_join._forest(block([*range(30)]), block([*range(30, 60)]), 85)]
    assert len(found) == 57 and all(a < b and a % 3 == b % 3 for a, b in found)
    assert len([*ngram_join._forest(block([*range(30)]), block([*range(30)]), 85)]) == 27


def test_sketches_lose_no_link(spark):
    """Sketches never tell of more differing shingles than there are, whatever their lengths; unlike texts are told apart before they are fetched."""
    import pyarrow as pa

    r = np.random.default_rng(9)
    sets, pairs = [], []
    for n in (1, 2, 15, 16, 17, 130, 1000, 5000, 1 << 17):
        base = r.integers(0, 2**64, n, np.uint64)
        for part in (0, 0.1, 0.17, 0.5, 1):
            sets += [np.unique(base), np.unique(np.concatenate([base[int(n * part) :], r.integers(0, 2**64, int(n * part * r.random()) + 1, np.uint64)]))]
            pairs.append((len(sets) - 2, len(sets) - 1))
    sets += [np.arange(1, 400, dtype=np.uint64) << np.uint64(20), np.arange(1, 380, dtype=np.uint64) << np.uint64(20)]  # all at one place, which holds 255 at most
    pairs += [(len(sets) - 2, len(sets) - 1), (len(sets) - 1, 0)]
    sketches = ngram_join._sketches(np.concatenate(sets), np.cumsum([0, *map(len, sets)]))
    a, b = (sketches.take(pa.array(x)) for x in zip(*pairs, strict=True))
    found = ngram_join._differences(a, b).tolist()
    assert found == ngram_join._differences(b.slice(0), a).tolist() and found[3:] == ngram_join._differences(a.slice(3), b.slice(3)).tolist()
    assert all(k <= len(np.setxor1d(sets[i], sets[j])) for k, (i, j) in zip(found, pairs, strict=True))
    rows = [(k, len(x), bytes(y.as_py())) for k, (x, y) in enumerate(zip(sets, sketches, strict=True))]
    frame = spark.createDataFrame([(*p, 0, 0) for p in pairs], "a long, b long, sa long, sb long")
    kept = {(x.a, x.b) for x in ngram_join._sifted(frame, spark.createDataFrame(rows, "node long, n long, sketch binary"), 85).collect()}
    links = {(i, j) for i, j in pairs if 100 * len(np.intersect1d(sets[i], sets[j])) >= 85 * len(np.union1d(sets[i], sets[j]))}
    assert links <= kept and len(links) > 10 and all(len(np.intersect1d(sets[i], sets[j])) >= 0.5 * len(sets[i]) for i, j in kept if len(sets[i]) > 100)


def test_texts_of_unlike_candidates_are_not_fetched(spark, monkeypatch):
    """Texts that meet in lists of a common passage, and lists' pivots, are sifted before any text is sent; short savings lengthen nothing."""
    from groundplan.scratch import Scratch

    r = random.Random(10)
    passages = [prose(r, 120, 10**6) for _ in range(4)]
    rows = [(i, " ".join(prose(r, 780 if i // 4 % 2 else 665, 10**6) + passages[i % 4])) for i in range(160)]
    rows += [(200 + i, " ".join(near(r, rows[i][1].split(), 2))) for i in range(10)]
    monkeypatch.setattr(Scratch, "drop", lambda self, *names: None)
    scratch = Scratch(spark, "test")
    assert got(spark, rows, scratch=scratch) == brute(rows)
    read = lambda name: spark.read.parquet(f"{scratch.root}/{name}")
    assert read("short").count() > 500 and read("sifted").count() <= 12 and read("texts").count() <= 24
    assert "longer" not in os.listdir(scratch.root.removeprefix("file:"))
