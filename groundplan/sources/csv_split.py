"""CSV with line breaks in quoted fields, read by many tasks a file.

A task that starts somewhere in a file can't see whether it stands within quotes. So every split is scanned twice. First each
tells how it ends for both ways in which it may begin, and going through the splits of a file, one row each, gives how each
does begin. Then the splits are cut into records, and a record that reaches over a border is put together from its parts. What
comes to the driver is a boolean a split, as many as Spark itself holds there.

A field is quoted if it begins with a quote; a doubled quote within it stands for one; other quotes are text.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

_FIELD = re.compile(r'"(?:[^"]|"")*+"[^,]*|[^",][^,]*|(?=,)|\Z')
_CLOSE = re.compile(r'(?:[^"]|"")*+"')


def ends_quoted(line: str, quoted: bool) -> bool:
    """Whether the line break after a line is within quotes, if its start is or isn't."""
    at = 0
    if quoted:
        m = _CLOSE.match(line)
        if not m:
            return True
        at = line.find(",", m.end()) + 1
        if not at:
            return False
    while True:
        m = _FIELD.match(line, at)
        if not m:  # a quote that isn't closed
            return True
        at = m.end() + 1
        if m.end() >= len(line):
            return False


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _blocks(it: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bool, pa.Array]]:
    """file, block, whether a block begins, lines: stretches of one block, in order."""
    last = None
    for batch in it:
        file, block = batch.column("file").to_pylist(), batch.column("block").to_pylist()
        cuts = [0, *(i for i in range(1, len(block)) if block[i] != block[i - 1] or file[i] != file[i - 1]), len(block)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a < b:
                yield file[a], block[a], (file[a], block[a]) != last, batch.column("value").slice(a, b - a)
                last = file[a], block[a]


def _with_quotes(lines: pa.Array) -> list[int]:
    return np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False)).tolist()


def _transfers(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How each block ends, if it begins outside (0) or within (1) quotes."""
    now: tuple[str, int, list[bool]] | None = None

    def told() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"file": now[0], "block": now[1], "end0": now[2][0], "end1": now[2][1]}])

    for file, block, begins, lines in _blocks(it):
        if begins:
            if now:
                yield told()
            now = file, block, [False, True]
        for i in _with_quotes(lines):
            line = lines[i].as_py()
            now[2][:] = [ends_quoted(line, q) for q in now[2]]
    if now:
        yield told()


def _begun(rows):
    """Of one file: whether each block begins within quotes."""
    rows = rows.sort_values("block")
    quoted, begins = False, []
    for ends in rows[["end0", "end1"]].itertuples(index=False):
        begins.append(quoted)
        quoted = bool(ends[quoted])
    return rows[["file", "block"]].assign(quoted=begins)


def records(spark: SparkSession, path: str) -> DataFrame:
    """record and first (whether it is its file's first) for each CSV record; empty lines are none."""
    lines = _lines(spark, path)
    ends = lines.mapInArrow(_transfers, "file string, block long, end0 boolean, end1 boolean")
    begun = {(r.file, r.block): r.quoted for r in ends.groupBy("file").applyInPandas(_begun, "file string, block long, quoted boolean").collect()}

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        at, count, part = ("", -1), 0, []  # the block, its records so far, and the lines of the one that is open
        quoted = head = False  # head: the open record began in an earlier block

        def add(text: str, kind: str | None = None) -> None:
            nonlocal count
            if kind or text.strip("\r"):
                out.append((*at, kind, text if kind else text.removesuffix("\r"), kind != "head" and at[1] == 0 and count == 0))
                count += 1

        def close() -> None:
            """The block ends: what is open goes on in the next one."""
            if part:
                add("\n".join(part), "whole" if head else "tail")

        for file, block, begins, values in _blocks(it):
            if begins:
                close()
                if (file, block) not in begun:
                    raise RuntimeError("the file has been split in another way than before; read it again")
                at, count, part = (file, block), 0, []
                quoted = head = begun[file, block]
            texts, done = values.to_pylist(), 0
            for i in [*_with_quotes(values), len(texts)]:
                if quoted:
                    part += texts[done:i]
                else:
                    for text in texts[done:i]:
                        add(text)
                done = i + 1
                if i == len(texts):
                    break
                was, quoted = quoted, ends_quoted(texts[i], quoted)
                if not was and not quoted:
                    add(texts[i])
                    continue
                part.append(texts[i])
                if not quoted:
                    add("\n".join(part), "head" if head else None)
                    part, head = [], False
            if len(out) > 4096:
                yield _rows(out)
                out.clear()
        close()
        if out:
            yield _rows(out)

    cut = lines.mapInArrow(run, "file string, block long, part string, record string, first boolean")
    single = cut.filter("part is null").select("record", "first")
    # A record over a border is a tail, whole blocks, and a head; within a block a head comes before a tail.
    order = Window.partitionBy("file").orderBy("block", F.when(F.col("part") == "tail", 1).otherwise(0))
    numbered = cut.filter("part is not null").withColumn("number", F.sum(F.when(F.col("part") == "tail", 1).otherwise(0)).over(order))
    listed = F.array_sort(F.collect_list(F.struct("block", "record")))
    one = numbered.groupBy("file", "number").agg(F.array_join(F.transform(listed, lambda s: s["record"]), "\n").alias("record"), F.max("first").alias("first"))
    return single.union(one.select(F.regexp_replace("record", "\r$", "").alias("record"), "first"))


def _rows(out: list[tuple]) -> pa.RecordBatch:
    kinds = (("file", pa.string()), ("block", pa.int64()), ("part", pa.string()), ("record", pa.string()), ("first", pa.bool_()))
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(zip(*out, strict=True), kinds, strict=True)], names=[n for n, _ in kinds])


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records as text columns, named by the first record of a file; as Spark's reader with header and multiLine."""
    every = records(spark, path)
    named = every.filter("first").select("record").first()
    if named is None:
        return spark.createDataFrame([], "struct<>")
    names = next(csv.reader(io.StringIO(named.record, newline="")))
    how = {"escape": '"', "multiLine": "true"}
    parsed = every.filter("not first").select(F.from_csv("record", ", ".join(f"c{i} string" for i in range(len(names))), how).alias("r")).select("r.*")
    return parsed.toDF(*[f"{n}{i}" if names.count(n) > 1 else n or f"_c{i}" for i, n in enumerate(names)])
