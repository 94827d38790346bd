"""Large JSON arrays, read by more than one task a file.

Spark reads the file as pieces that end in ``}``, which it can split anywhere. Whether a
piece lies inside a string, and how deep, depends on all that comes before it. So a first
pass sums up every byte range (for both cases: it starts inside a string or not), a scan
over one row per range says how each one starts, and a second pass cuts the elements out.
An element that crosses ranges is put together from its parts. Elements leave as JSON
lines, which every later step can split.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

MARKS = re.compile(r'\\.|["{}\[\]]', re.DOTALL)
ENDS = re.compile(r"[\r\n]+")
RANGE = "path string, low bigint"


def marks(piece: str, in_string: bool):
    """((place, change of depth) of every bracket outside strings, whether the piece ends inside one)."""
    found = []
    for m in MARKS.finditer(piece):
        mark = m.group()
        if mark == '"':
            in_string = not in_string
        elif not in_string and mark in "{[":
            found.append((m.start(), 1))
        elif not in_string and mark in "}]":
            found.append((m.start(), -1))
    return found, in_string


def _ranges(batches):
    """(path, low, pieces) runs of rows of one byte range, in order."""
    for batch in batches:
        paths, lows, values = (batch.column(c).to_pylist() for c in ("path", "low", "value"))
        at = 0
        while at < len(values):
            to = at
            while to < len(values) and (paths[to], lows[to]) == (paths[at], lows[at]):
                to += 1
            yield paths[at], lows[at], [v + "}" for v in values[at:to]]
            at = to


def _summaries(batches):
    """Per byte range and assumed start: where it ends, the change of depth and the least depth on the way."""
    held: dict[tuple, list] = {}
    for path, low, pieces in _ranges(batches):
        state = held.setdefault((path, low), [[False, 0, 0], [True, 0, 0], ""])
        for piece in pieces:
            state[2] = state[2] or piece.lstrip("\ufeff \t\r\n")[:1]
            for case in state[:2]:
                found, case[0] = marks(piece, case[0])
                for _, change in found:
                    case[1] += change
                    case[2] = min(case[2], case[1])
    rows = [
        {"path": p, "low": low, "first": s[2], **{f"{n}{i}": s[i][j] for i in (0, 1) for j, n in enumerate(("inside", "depth", "least"))}}
        for (p, low), s in held.items()
    ]
    schema = [("path", pa.string()), ("low", pa.int64()), ("first", pa.string())]
    schema += [(f"{n}{i}", t) for i in (0, 1) for n, t in (("inside", pa.bool_()), ("depth", pa.int64()), ("least", pa.int64()))]
    yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(schema))


def range_starts(summaries) -> dict[tuple[str, int], tuple[bool, int, int, int | None]]:
    """(path, low) -> (starts inside a string, depth, depth outside elements, range in which the open element began)."""
    out, file = {}, None
    for r in sorted(summaries, key=lambda r: (r["path"], r["low"])):
        if r["path"] != file:
            file, inside, depth, began = r["path"], False, 0, None
            base = 1 if r["first"] == "[" else 0
        out[file, r["low"]] = (inside, depth, base, began)
        case = 1 if inside else 0
        if depth + r[f"least{case}"] <= base:
            began = None
        inside, depth = r[f"inside{case}"], depth + r[f"depth{case}"]
        if depth > base and began is None:
            began = r["low"]
    return out


PARTS = pa.schema([("path", pa.string()), ("began", pa.int64()), ("low", pa.int64()), ("text", pa.string())])


def _elements(starts):
    def run(batches):
        at: dict[tuple, list] = {}

        def row(path, began, low, text):
            return {"path": path, "began": began, "low": low, "text": ENDS.sub(" ", "".join(text))}

        for path, low, pieces in _ranges(batches):
            inside, depth, base, began = starts[path, low]
            state = at.setdefault((path, low), [inside, depth, began, []])
            rows = []
            for piece in pieces:
                found, state[0] = marks(piece, state[0])
                since = 0
                for place, change in found:
                    before, state[1] = state[1], state[1] + change
                    if change > 0 and before == base and piece[place] == "{":
                        since = place
                    elif change < 0 and state[1] == base and before == base + 1 and piece[place] == "}":
                        state[3].append(piece[since : place + 1])
                        rows.append(row(path, state[2], low, state[3]))
                        state[2], state[3] = None, []
                        since = place + 1
                if state[1] > base:
                    state[3].append(piece[since:])
            yield pa.RecordBatch.from_pylist(rows, schema=PARTS)
        rest = [row(p, low if s[2] is None else s[2], low, s[3]) for (p, low), s in at.items() if s[3]]
        yield pa.RecordBatch.from_pylist(rest, schema=PARTS)

    return run


def json_elements(spark: SparkSession, path: str) -> DataFrame:
    """(value) one JSON object per row: the objects of the array in each file, or the single object it holds.

    Files are read in byte ranges of ``spark.sql.files.maxPartitionBytes``, each by a task of its
    own. Brackets inside strings and escaped quotes are told apart; elements of the array that
    are no objects are left out, as is whatever follows the array. One row per byte range, not
    per element, passes through the driver.
    """
    pieces = spark.read.option("lineSep", "}").text(path).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("low")
    )
    ddl = f"{RANGE}, first string, " + ", ".join(f"inside{i} boolean, depth{i} bigint, least{i} bigint" for i in (0, 1))
    starts = range_starts([r.asDict() for r in pieces.mapInArrow(_summaries, ddl).collect()])
    parts = pieces.mapInArrow(_elements(starts), "path string, began bigint, low bigint, text string")
    whole = parts.filter("began IS NULL").select(F.col("text").alias("value"))
    crossing = parts.filter("began IS NOT NULL").groupBy("path", "began").agg(F.array_sort(F.collect_list(F.struct("low", "text"))).alias("p"))
    joined = crossing.select(F.array_join(F.transform("p", lambda x: x["text"]), "").alias("value"))
    return whole.unionByName(joined).filter("endswith(value, '}')")
