"""Roles of transcript lines by a hidden Markov model, and canonical turns.

A transcript is lines in order. A line's state is its role and whether it opens a turn; what is seen of it is the speaker
marker at its start (if any) and features of the line (length, question mark, a blank line before it). Start, transition
and emission probabilities are smoothed counts over transcripts whose roles are known. Viterbi decoding recovers the roles,
turns are cut where a line opens one, markers are removed, and turns are rendered in the ChatML form.

Any conversation may be arbitrarily long: rows are range-partitioned by (conversation, position, row), so one conversation
may span partitions. A first pass gives, for each partition's first and last conversation only, the max-plus transfer
matrix of its lines; those few numbers (at most two matrices a partition) are chained on the driver into entry scores and
exit states; a second pass decodes each partition with them. The result is the exact Viterbi path of whole conversations.

Defined results: a null text is an empty line; blank lines belong to the turn above them and don't count as evidence;
a transcript without any marker is decoded by line features alone; repeated rows are lines of their own; ties in position
are ordered by the text; rows without a key form one transcript; an empty table has no turns. A turn cut by a partition's
border continues in a row with `continues` true.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from groundplan.llm.frames import key_name, map_arrow, position
from groundplan.scratch import shared_dir

ROLES = ("system", "user", "assistant")
#: Usual speaker markers, lower case (fixed values).
MARKERS = {
    "system": ("system", "instructions", "context"),
    "user": ("user", "human", "q", "question", "customer", "prompter"),
    "assistant": ("assistant", "ai", "bot", "a", "answer", "gpt", "agent", "response"),
}
_BY_WORD = {w: r for r, ws in MARKERS.items() for w in ws}
_MARKER = re.compile(r"\s*(?:#{1,4}\s*|\*\*|\[|<\|?)?(" + "|".join(sorted(_BY_WORD, key=len, reverse=True)) + r")(?:\*\*)?\s*(?::(?:\*\*)?|\]:?|\|?>)\s*", re.I)
#: States: role index * 2, plus 1 inside a turn.
N = 2 * len(ROLES)


def marker(line: str) -> tuple[str, int]:
    """The role that a line's marker names ('' for none), and where the content starts."""
    m = _MARKER.match(line)
    return (_BY_WORD[m[1].lower()], m.end()) if m else ("", 0)


def features(line: str, blank_before: bool) -> tuple[str, int, int, int]:
    """What the model sees of a line that isn't blank."""
    role, at = marker(line)
    size = len(line) - at
    return role, int(np.searchsorted((20, 60, 120, 250, 500), size)), int("?" in line[at:]), int(blank_before)


@dataclass
class Model:
    start: np.ndarray  # log probabilities
    step: np.ndarray
    marker: dict[str, np.ndarray]
    rest: list[np.ndarray]  # for each further feature: values x states

    def emission(self, f: tuple) -> np.ndarray:
        out = self.marker[f[0]].copy()
        for table, v in zip(self.rest, f[1:], strict=True):
            out += table[v]
        return out

    @staticmethod
    def of_counts(counts: dict[tuple, int], smooth: float = 0.5) -> Model:
        """counts: ('start', state), ('step', from, to), ('seen', feature number, value, state)."""
        start = np.full(N, smooth)
        step = np.full((N, N), smooth)
        marks = {m: np.full(N, smooth) for m in ("", *ROLES)}
        rest = [np.full((6, N), smooth), np.full((2, N), smooth), np.full((2, N), smooth)]
        for key, n in counts.items():
            if key[0] == "start":
                start[key[1]] += n
            elif key[0] == "step":
                step[key[1], key[2]] += n
            elif key[1] == 0:
                marks[key[2]][key[3]] += n
            else:
                rest[key[1] - 1][key[2], key[3]] += n
        start[1::2] = 1e-9  # a transcript opens with a turn
        for s in range(N):
            for t in range(1, N, 2):
                if s // 2 != t // 2:
                    step[s, t] = 1e-9  # a role changes only where a turn opens
        total = sum(marks.values())
        return Model(
            np.log(start / start.sum()), np.log(step / step.sum(1, keepdims=True)), {m: np.log(v / total) for m, v in marks.items()}, [np.log(r / r.sum(0)) for r in rest]
        )


def count(turns: Iterator[tuple[object, str, str]]) -> Counter:
    """Counts of one ordered stream of (conversation, role, raw text) turns."""
    out: Counter = Counter()
    conversation, before, blank = object(), None, False
    for key, role, text in turns:
        if key != conversation:
            conversation, before, blank = key, None, False
        if role not in ROLES:
            continue
        opened = False
        for line in text.split("\n"):
            if not line.strip():
                blank = True
                continue
            s = 2 * ROLES.index(role) + opened
            opened = True
            out[("start", s) if before is None else ("step", before, s)] += 1
            for k, v in enumerate(features(line, blank)):
                out["seen", k, v, s] += 1
            before, blank = s, False
    return out


def fit(turns: DataFrame, key: str, order: str, role: str, text: str) -> Model:
    """A model from turns with known roles. Only counts reach the driver: their number doesn't depend on the data."""
    rows = _dealt(turns.select(F.col(key).alias("k"), F.col(order).alias("o"), F.col(role).alias("r"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t")), "r")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = (row for b in it for row in zip(b.column("k").to_pylist(), b.column("r").to_pylist(), b.column("t").to_pylist(), strict=True))
        found = count(stream)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([json.dumps(k) for k in found]), pa.array(list(found.values()), pa.int64())], names=["what", "n"])

    total = map_arrow(rows, run, "what string, n long").groupBy("what").agg(F.sum("n").alias("n"))
    return Model.of_counts({tuple(json.loads(w)): n for w, n in total.collect()})


def _dealt(rows: DataFrame, *more: str) -> DataFrame:
    """Rows (k, o, t, ...) in order over partitions; a long conversation is spread over several."""
    spark = rows.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    tie = F.xxhash64("t", *more)
    return rows.withColumn("tie", tie).repartitionByRange(n, "k", "o", "tie").sortWithinPartitions("k", "o", "tie").drop("tie")


def _runs(it: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[tuple[object, int, str]]]]:
    """(conversation, its lines here as (position, line number, line)) in order."""
    now, lines, begun = None, [], False
    for b in it:
        for k, o, t in zip(b.column("k").to_pylist(), b.column("o").to_pylist(), b.column("t").to_pylist(), strict=True):
            if begun and k != now:
                yield now, lines
                lines = []
            now, begun = k, True
            lines += [(o, i, line) for i, line in enumerate(t.split("\n"))]
    if begun:
        yield now, lines


def _emissions(model: Model, lines: list[tuple[object, int, str]], blank: bool) -> tuple[np.ndarray, list[int], bool]:
    """Emission scores of the lines that aren't blank, their numbers, and whether the last line is blank."""
    out, at = [], []
    for i, (_, _, line) in enumerate(lines):
        if line.strip():
            out.append(model.emission(features(line, blank)))
            at.append(i)
            blank = False
        else:
            blank = True
    return np.array(out).reshape(-1, N), at, blank


def transfer(model: Model, seen: np.ndarray) -> np.ndarray:
    """Best score from each state before the lines to each state of the last line (max-plus product)."""
    out = np.full((N, N), -np.inf)
    np.fill_diagonal(out, 0.0)
    for e in seen:
        out = (out[:, :, None] + model.step[None]).max(1) + e
    return out


def viterbi(model: Model, seen: np.ndarray, entry: np.ndarray | None, leave: int | None) -> np.ndarray:
    """States of the lines; entry: scores of the states before them (None: they open a transcript); leave: the last state."""
    if not len(seen):
        return np.empty(0, np.int64)
    score = (model.start if entry is None else (entry[:, None] + model.step).max(0)) + seen[0]
    back = np.zeros((len(seen), N), np.int64)
    for i in range(1, len(seen)):
        ways = score[:, None] + model.step
        back[i] = ways.argmax(0)
        score = ways.max(0) + seen[i]
    path = np.empty(len(seen), np.int64)
    path[-1] = score.argmax() if leave is None else leave
    for i in range(len(seen) - 1, 0, -1):
        path[i - 1] = back[i, path[i]]
    return path


def _borders(model: Model, cut: DataFrame) -> dict[int, dict[str, tuple]]:
    """For each partition, entry scores, blank flag and exit state of a first run that continues, and exit state of a last run that goes on."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        ends: list[tuple[object, list]] = []
        n = 0
        for r in _runs(it):
            n += 1
            ends = [r] if not ends else [ends[0], r]
        for which, (k, lines) in zip({0: (), 1: ("only",), 2: ("first", "last")}[len(ends)], ends, strict=True):
            # A line's blank_before at the run's start depends on the run before, so both cases are given.
            for blank in (False, True):
                seen, at, last = _emissions(model, lines, blank)
                value = {"which": which, "k": json.dumps(k, default=str), "blank": blank, "n": len(at), "last_blank": last, "m": transfer(model, seen).tolist(), "first": seen[0].tolist() if len(at) else None}
                if len(at):
                    value["rest"] = transfer(model, seen[1:]).tolist()
                yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([json.dumps(value)])], names=["part", "value"])

    rows = sorted(((p, json.loads(v)) for p, v in map_arrow(cut, run, "part long, value string").collect()), key=lambda x: (x[0], x[1]["which"] == "last"))
    chains: list[list[tuple[int, dict]]] = []
    pieces: dict[tuple[int, str], dict[bool, dict]] = {}
    order = []
    for p, v in rows:
        if (p, v["which"]) not in pieces:
            order.append((p, v["which"]))
        pieces.setdefault((p, v["which"]), {})[v["blank"]] = v
    for x in order:
        k = pieces[x][False]["k"]
        if chains and x[1] != "last" and chains[-1][-1][1][False]["k"] == k and chains[-1][-1][0][0] != x[0]:
            chains[-1].append((x, pieces[x]))
        else:
            chains.append([(x, pieces[x])])
    out: dict[int, dict[str, tuple]] = {}
    for chain in chains:
        if len(chain) == 1:
            continue
        score, blank, used, entries = None, False, [], []
        for x, both in chain:
            v = both[blank]
            entries.append((score, blank))
            used.append(v)
            if v["n"]:
                if score is None:
                    score = (model.start + np.array(v["first"]))[:, None] + np.array(v["rest"])
                    score = score.max(0)
                else:
                    score = (score[:, None] + np.array(v["m"])).max(0)
            blank = v["last_blank"]
        leave = None if score is None else int(score.argmax())
        for i in range(len(chain) - 1, -1, -1):
            (part, which), _ = chain[i]
            entry, flag = entries[i]
            out.setdefault(part, {})["last" if which == "last" else "first"] = (entry, flag, leave, i > 0)
            if used[i]["n"] and leave is not None and entry is not None:
                leave = int((entry + np.array(used[i]["m"])[:, leave]).argmax())
    return out


def turns(lines: DataFrame, model: Model, key: str = "conv_id", order: str = "position", text: str = "text") -> DataFrame:
    """key (as key_name says), at (position of the turn's first line), line (its number in that row's text), continues, role, content, rendered."""
    shared_dir(lines.sparkSession)
    kinds = {c: lines.schema.fields[position(lines, c)].dataType.simpleString() for c in (key, order)}
    results = ("at", "line", "continues", "role", "content", "rendered")
    name = key_name(key, results)
    rows = lines.select(F.col(f"`{key}`").alias("k"), F.col(f"`{order}`").alias("o"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("t"))
    cut = _dealt(rows).checkpoint()
    borders = _borders(model, cut)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = borders.get(TaskContext.get().partitionId(), {})
        out: list[tuple] = []
        kind_k = kind_o = None

        def schema(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal kind_k, kind_o
            for b in batches:
                kind_k, kind_o = b.schema.field("k").type, b.schema.field("o").type
                yield b

        def batch() -> pa.RecordBatch:
            cols = list(zip(*out, strict=True))
            types = (kind_k, kind_o, pa.int64(), pa.bool_(), pa.string(), pa.string(), pa.string())
            made = pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], names=[name, *results])
            out.clear()
            return made

        held = None
        first = True
        for r in _runs(schema(it)):
            if held is not None:
                out += _decoded(model, *held, mine.get("first") if first else None)
                first = False
                if len(out) >= 5000:
                    yield batch()
            held = r
        if held is not None:
            out += _decoded(model, *held, mine.get("first") if first else mine.get("last"))
        if out:
            yield batch()

    return map_arrow(cut, run, f"`{name}` {kinds[key]}, at {kinds[order]}, line long, continues boolean, role string, content string, rendered string")


def _decoded(model: Model, key, lines: list[tuple[object, int, str]], border: tuple | None) -> list[tuple]:
    entry, blank, leave, later = border or (None, False, None, False)
    seen, at, _ = _emissions(model, lines, blank)
    path = viterbi(model, seen, entry, leave)
    out: list[list] = []
    for i, s in zip(at, path.tolist(), strict=True):
        o, n, line = lines[i]
        opens = s % 2 == 0
        if opens or not out:
            out.append([o, n, not opens and later, ROLES[s // 2], [], i])
        said, cut = marker(line)
        if opens and said:
            line = line[cut:]
        while out[-1][5] < i:  # blank lines within the turn
            if out[-1][4]:
                out[-1][4].append("")
            out[-1][5] += 1
        out[-1][4].append(line)
        out[-1][5] = i + 1
    rows = []
    for o, n, goes_on, role, content, _ in out:
        body = "\n".join(content).strip("\n")
        rows.append((key, o, n, goes_on, role, body, render(role, body)))
    return rows


def render(role: str, content: str) -> str:
    """One turn in the ChatML form; its own control words in a content are broken up."""
    safe = content.replace("<|im_", "<|​im_")
    return f"<|im_start|>{role}\n{safe}<|im_end|>\n"


#: Marker styles of raw transcripts: system, user, assistant.
STYLES = (("System: ", "User: ", "Assistant: "), ("### Context: ", "### Question: ", "### Answer: "), ("[system] ", "[human] ", "[ai] "), ("System: ", "Q: ", "A: "))


def transcripts(conversations: DataFrame) -> DataFrame:
    """Raw transcript rows of a table of turns: conv_id, position, text with a marker that every eighth turn lacks.

    Which marker style and which turns lack one is decided by hashes of conversation and turn; a turn without a marker
    follows a blank line.
    """
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(STYLES)))
    bare = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(8)) == 0
    which = F.array_position(F.array(*[F.lit(r) for r in ROLES]), F.col("role"))
    table = F.array(*[F.array(*[F.lit(x) for x in s]) for s in STYLES])
    head = F.coalesce(F.get(F.get(table, style), which.cast("int") - 1), F.lit(""))
    return conversations.select("conv_id", F.col("turn").alias("position"), "role", F.concat(F.when(bare, F.lit("\n")).otherwise(head), F.coalesce(F.col("text"), F.lit(""))).alias("text"))


def op9_chat_turns(spark, sf_dir: str) -> DataFrame:
    """Recovered turns of all conversations, from raw transcripts; the model counts the turns of all conversations."""
    raw = transcripts(spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text"))
    model = fit(raw, "conv_id", "position", "role", "text")
    return turns(raw.drop("role"), model)
