"""Each stage of the pipeline against a brute-force version over the stage's own input."""

import collections
import re
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from groundplan.llm import pii, quality
from groundplan.scratch import Scratch

SF = "/root/testdata/sf0.001"


def shingled(t):
    w = re.findall("[^\x20\x09-\x0d]+", t)
    return collections.Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def jp(a, b):
    return sum(1 / sum(max(a.get(j, 0) / a[i], b.get(j, 0) / b[i]) for j in a.keys() | b.keys()) for i in a.keys() & b.keys())


def first_of_classes(texts):
    ids = sorted(texts)
    sets, parent = {i: shingled(texts[i]) for i in ids}, {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, i in enumerate(ids):
        for j in ids[:n]:
            if len(sets[i].keys() & sets[j].keys()) * 2 > min(len(sets[i]), len(sets[j])) and jp(sets[i], sets[j]) >= 0.8:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {find(i) for i in ids}


def kept_by_rules(t):
    w = re.findall("[^\x20\x09-\x0d]+", t)
    grams = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    again = {j for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in t.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    n, chars = len(w), sum(map(len, w))
    fails = [
        n < 10, 100 * len(again) > 20 * n, 10 * sum(c in "#*$%&|<>" for c in t) > n, chars < 2 * n, chars > 15 * n, 10 * (len(lines) - len(set(lines))) > 5 * len(lines),
        10 * len(re.findall("[A-Z]", t)) > 4 * chars and n >= 10, 2 * len(re.findall(r"[!|{}\[\]=_~^\\/@]", t)) > n, 10 * sum(a == b for a, b in zip(w, w[1:], strict=False)) > 3 * n,
    ]
    return not any(fails)


def test_stages(spark):
    scratch = Scratch(spark, "pipeline-test")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    at = [docs]
    for name, stage in corpus_pipeline.STAGES:
        at.append(scratch.save(stage(spark, at[-1], SF), name))
    assert all(x.columns == docs.columns for x in at[:-1])
    rows = [{r.doc_id: r for r in x.collect()} for x in at[:-1]]
    model = quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert rows[1].keys() == {r.doc_id for r in quality.score(docs, model).filter("score >= 0.5").collect()}
    assert rows[2].keys() == {i for i, r in rows[1].items() if kept_by_rules(r.text)}
    assert rows[3].keys() == first_of_classes({i: r.text for i, r in rows[2].items()})
    p = pii.Pseudonyms(pii.DEMO_KEY)
    assert {i: r.text for i, r in rows[4].items()} == {i: p.replace(r.text) for i, r in rows[3].items()}
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    placed, sequences = collections.defaultdict(list), collections.Counter()
    for r in at[5].collect():
        placed[r.doc_id].append(r)
        sequences[r.sequence_id] += r.length
    assert placed.keys() == rows[4].keys() and max(sequences.values()) <= 4096
    for i, pieces in placed.items():
        ids = np.array([*tok.encode(rows[4][i].text, add_special_tokens=False).ids, 2], "<u4")
        start = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == start and r.ids_crc32 == zlib.crc32(ids[start : start + r.length].tobytes())
            start += r.length
        assert start == len(ids)
    assert corpus_pipeline.run(spark, SF).count() == at[5].count()


def test_garbage_is_collected_as_tables_are_written(spark):
    from groundplan.scratch import TIDY, Scratch

    full = lambda: sum(b.getCollectionCount() for b in spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans() if "Old" in b.getName() or "Mark" in b.getName())
    before, scratch = full(), Scratch(spark, "test")
    for i in range(TIDY):
        scratch.save(spark.range(3), f"t{i}")
    assert full() > before
