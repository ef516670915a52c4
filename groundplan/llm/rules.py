"""Quality rules as a bitmask ledger.

Each rule is evaluated once for each document: `ledger` adds the measures and one long whose bit k says that rule k
failed. A policy is a version name and the mask of the rules that it enforces, so a verdict under any policy is
`failures & mask = 0`, and every ablation (what would stay without rule k) is arithmetic over the counts of the distinct
masks: the texts aren't read again.

Null and empty texts have no words and fail `few_words`. Repeated rows get equal results, an empty table none; extra columns,
also such that are named like a measure, pass through untouched, but a column named like one of the two results of `ledger`
is replaced by it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from groundplan.llm import textscan
from groundplan.llm.frames import append_column, fresh, longs, struct_of

#: Rules over the measures, in the order of their bits; never reorder, only append.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 10"),
    ("repeated_passages", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 15 * n_words"),
    ("duplicate_lines", "10 * n_dup_lines > 5 * n_lines"),
    ("shouting", "10 * n_upper > 4 * word_chars and n_words >= 10"),
    ("marks", "2 * n_marks > n_words"),
    ("stuttering", "10 * n_twice_running > 3 * n_words"),
    ("many_words", "n_words > 1000000"),
)


@dataclass(frozen=True)
class Policy:
    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        names = [n for n, _ in RULES]
        return sum(1 << names.index(r) for r in self.rules)


BASE = Policy("base", ("few_words", "repeated_passages"))
POLICIES = {
    p.version: p
    for p in (
        BASE,
        Policy("v1", ("few_words", "repeated_passages", "symbols", "short_words", "long_words")),
        Policy("v2", ("few_words", "repeated_passages", "symbols", "short_words", "long_words", "duplicate_lines", "shouting", "marks", "stuttering")),
    )
}
PRODUCTION = "v2"


def measures(docs: DataFrame, text: str = "text", into: str = "measures") -> DataFrame:
    """docs with a struct of textscan.MEASURES of each whole text."""
    names = textscan.MEASURES

    def work(batch: pa.RecordBatch) -> pa.Array:
        parts = [textscan.measure(s) for s in textscan.slices(batch.column(text))]
        return struct_of(names, [np.concatenate([p[k] for p in parts]) if parts else np.empty(0, np.int64) for k in names])

    return append_column(docs, T.StructField(into, longs(*names)), work)


def failure_bits(struct: str) -> Column:
    """The long with a bit for each failed rule, from the struct of measures."""
    bits = F.lit(0).cast("long")
    for k, (_, rule) in enumerate(RULES):
        test = rule
        for name in sorted(textscan.MEASURES, key=len, reverse=True):
            test = test.replace(name, f"\0{textscan.MEASURES.index(name)}\1")
        for i, name in enumerate(textscan.MEASURES):
            test = test.replace(f"\0{i}\1", f"`{struct}`.`{name}`")
        bits = bits.bitwiseOR(F.when(F.expr(test), F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long")))
    return bits


def ledger(docs: DataFrame, text: str = "text", measured: str = "measures", failures: str = "failures") -> DataFrame:
    """docs with the measures and the failure bits of every rule."""
    return measures(docs, text, measured).drop(failures).withColumn(failures, failure_bits(measured))


def verdict(failures: str | Column, policy: Policy | str = PRODUCTION) -> Column:
    """Whether the policy keeps a document."""
    policy = POLICIES[policy] if isinstance(policy, str) else policy
    col = F.col(failures) if isinstance(failures, str) else failures
    return col.bitwiseAND(F.lit(policy.mask).cast("long")) == 0


def keep(docs: DataFrame, text: str = "text", policy: Policy | str = PRODUCTION) -> DataFrame:
    """The rows of docs that the policy keeps, with the columns of docs."""
    m, f = fresh(docs, "rule_measures"), fresh(docs, "rule_failures")
    return ledger(docs, text, m, f).filter(verdict(f, policy)).drop(m, f)


def ablations(ledgered: DataFrame, failures: str = "failures") -> DataFrame:
    """For each policy and rule: documents that fail it, fail it alone, and that stay with and without it.

    The ledger is first counted by distinct mask (2**len(RULES) rows at most); the rest is bit arithmetic on those. An
    empty ledger gives zeros.
    """
    spark = ledgered.sparkSession
    counts = ledgered.groupBy(F.col(failures).alias("f")).agg(F.count(F.lit(1)).alias("n"))
    rows = [(p.version, name, p.mask, 1 << k) for p in POLICIES.values() for k, (name, _) in enumerate(RULES) if p.mask >> k & 1]
    grid = spark.createDataFrame(rows, "policy string, rule string, mask long, bit long")
    out = grid.join(F.broadcast(counts), F.lit(True), "left")

    def total(test: Column) -> Column:
        return F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0)).cast("long")

    f, mask, bit = F.col("f"), F.col("mask"), F.col("bit")
    hit = f.bitwiseAND(mask)
    return out.groupBy("policy", "rule").agg(
        total(f.bitwiseAND(bit) != 0).alias("n_failed"),
        total(hit == bit).alias("n_failed_alone"),
        total(hit == 0).alias("n_kept"),
        total((hit == 0) | (hit == bit)).alias("n_kept_without"),
    )


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Every document's base measures, base verdict and the production policy's verdict."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    m = F.col("measures")
    base_failed = ~verdict("failures", BASE)
    return ledger(docs).select(
        "doc_id",
        *[m[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        base_failed.alias("base_failed"),
        (~base_failed & verdict("failures")).alias("kept"),
        "failures",
    )
