"""Records of large CSV files whose quoted fields hold newlines, read by many tasks (A1).

Spark's ``multiLine`` reader parses a file in one task. Here the file is read as lines, which split, and
whether a line starts inside a quoted field is worked out as a prefix over the splits:

1. every split reports where it would end if it started outside and if it started inside quotes
   (a function of two states, one row a split);
2. windows over those rows compose the functions, which gives each split its true start;
3. every split cuts its lines into records; the pieces of a record that crosses splits carry the split
   in which it began and are joined by that. Spark's own ``from_csv`` then parses each record.

Lines are scanned a batch at a time, by one pattern over their text; Python makes no call a line.
Only rows of splits (as many as the driver's own list of them) are broadcast, and only records that cross
a split are shuffled. The records are written once as a stage table: two scans of the file in all.

Defined results: those of the ``multiLine`` reader, quotes and newlines at split borders, quotes inside
unquoted fields, CRLF files, blank lines and one header per file included. A quote that never closes
takes the rest of its file into one field, less a newline at the file's end. A file is CRLF if its first line
ends so, and ``\\r\\n`` inside its quotes is then ``\\n``; files of ``\\r`` alone are not cut.
"""
from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import write_stage

#: A field that ends in its line, and whole records with their newlines. Possessive throughout, so linear.
_FIELD = rb'(?:"[^"]*+(?:""[^"]*+)*+"[^,\n]*+|(?!")[^,\n]*+)'
_RECORD = re.compile(rb"(?:" + _FIELD + rb",)*+" + _FIELD + rb"\n")
_ALL_RECORDS = re.compile(rb"(?:" + _RECORD.pattern + rb")*+")

#: Encodings in which quote, comma and newline are the ASCII bytes, and their names in Spark.
SPLIT_ENCODINGS = {"utf-8": "UTF-8", "utf8": "UTF-8", "us-ascii": "US-ASCII", "ascii": "US-ASCII",
                   "iso-8859-1": "ISO-8859-1", "latin-1": "ISO-8859-1", "latin1": "ISO-8859-1"}

_ENDS = "file string, block long, ends_out int, ends_in int, closes_in boolean, blank boolean, crlf boolean"
_RECORDS = "file string, owner long, block long, header boolean, text binary"


#: Stands for an unquoted empty field, as ``from_csv`` takes no NULL for an option.
_NO_VALUE = "\0no value\0"


#: Records that are none.
_BLANK = (b"", b"\r")


def _rows(rows: list[tuple], ddl: str):
    import pyarrow as pa
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
    fields = [f.split() for f in ddl.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[k]) for i, (_, k) in enumerate(fields)],
                                      names=[n for n, _ in fields])


def _stretches(batch):
    """The rows of each split in a batch: the first row's number, its file and block, and the lines. A split's rows follow each other."""
    import pyarrow.compute as pc
    n, keys = batch.num_rows, [batch.column("file"), batch.column("block")]
    if not n:
        return
    file, block = (pc.not_equal(k.slice(1), k.slice(0, n - 1)) for k in keys)
    starts = [0, *(i + 1 for i in pc.indices_nonzero(pc.or_(file, block)).to_pylist())]
    lines = batch.column("line").to_pylist()
    for start, end in zip(starts, [*starts[1:], n]):
        yield start, tuple(k[start].as_py() for k in keys), lines[start:end]


def _run(text: bytes, inside: int) -> tuple[int, bool]:
    """Whether whole lines end inside a quoted field, from whether they start in one, and whether any line ends outside.

    The newline behind the last line would end a record outside quotes: what no record takes is an open field.
    """
    text = b'"' + text if inside else text
    end = _ALL_RECORDS.match(text).end()
    return int(end < len(text)), end > 0


def _ends_inside(line: bytes, inside: int) -> int:
    """Whether a line ends inside a quoted field, from whether it starts in one."""
    return _run(line + b"\n", inside)[0]


def _split_ends(batches):
    """One row per split: the end state for both start states."""
    key, state = None, None
    for batch in batches:
        done = []
        for _, split, lines in _stretches(batch):
            if split != key:
                if key:
                    done.append((*key, *state))
                key, state = split, [0, 1, False, True, lines[0].endswith(b"\r")]
            text = b"\n".join(lines) + b"\n"
            same = state[0] == state[1]
            state[1], closes = _run(text, state[1])
            state[0] = state[1] if same else _run(text, state[0])[0]
            state[2] = state[2] or closes
            state[3] = state[3] and not text.replace(b"\r\n", b"\n").strip(b"\n")
        if done:
            yield _rows(done, _ENDS)
    if key:
        yield _rows([(*key, *state)], _ENDS)


def _records(text: bytes) -> tuple[list[bytes], int]:
    """The records of whole lines, without their newlines, and where the open rest starts."""
    found, at = [], 0
    while m := _RECORD.match(text, at):
        end = m.end()
        found.append(text[at:end - 1])
        at = end
    return found, at


def _cut_records(batches):
    """The records of each split from its start state; pieces of records that cross splits name their first split."""
    import pyarrow as pa
    key, held, goes_on, owner, header, crlf = None, [], False, None, False, False

    def whole(texts):
        n = len(texts)
        return pa.RecordBatch.from_arrays([pa.repeat(key[0], n), pa.nulls(n, pa.int64()), pa.repeat(pa.scalar(key[1], pa.int64()), n),
                                           pa.repeat(False, n), pa.array(texts, pa.binary())], names=[f.split()[0] for f in _RECORDS.split(", ")])

    def left_over():
        # the lines of an open record, less the newline behind the last
        return (key[0], owner if goes_on else key[1], key[1], header and not goes_on, b"".join(held)[:-1])

    for batch in batches:
        for start, split, lines in _stretches(batch):
            if split != key:
                if held:
                    yield _rows([left_over()], _RECORDS)
                inside, owner, header, crlf = (batch.column(c)[start].as_py() for c in ("inside", "owner", "header", "crlf"))
                if inside is None:
                    raise RuntimeError(f"{split[0]}: the splits changed while it was read; set spark.sql.files.minPartitionNum to keep them")
                key, held, goes_on = split, [], bool(inside)
            text = b"\n".join(lines) + b"\n"
            if crlf:
                text = text.replace(b"\r\n", b"\n")
            if held or goes_on:
                # inside a quoted field, which the quote put before opens again
                found, rest = _records(b'"' + text)
                if not found:
                    held.append(text)
                    continue
                found[0] = b"".join(held) + found[0][1:]
                rest -= 1
            else:
                found, rest = _records(text)
            held = [text[rest:]] if rest < len(text) else []
            if goes_on and found:
                yield _rows([(key[0], owner, key[1], False, found.pop(0))], _RECORDS)
                goes_on = False
            found = [t for t in found if t not in _BLANK]
            if found and header:
                del found[0]
                header = False
            if found:
                yield whole(found)
    if held:
        yield _rows([left_over()], _RECORDS)


def split_starts(ends: DataFrame) -> DataFrame:
    """For each split: whether it starts inside quotes, the split its open record began in, whether the header is in it.

    A split's function keeps the state, swaps it or always ends alike; so the state is the last constant
    before the split, swapped as often as splits after that constant swap.
    """
    upto = Window.partitionBy("file").orderBy("block")
    before = upto.rowsBetween(Window.unboundedPreceding, -1)
    constant = F.col("ends_out") == F.col("ends_in")
    swaps = ends.withColumn("swaps", F.coalesce(F.sum(F.when(F.col("ends_out") > F.col("ends_in"), 1).otherwise(0)).over(upto), F.lit(0)))
    last = F.last(F.when(constant, F.struct("ends_out", "swaps")), ignorenulls=True).over(before)
    known = (swaps.withColumn("last", last).withColumn("swaps_before", F.coalesce(F.lag("swaps").over(upto), F.lit(0)))
             .withColumn("inside", ((F.coalesce("last.ends_out", F.lit(0)) + F.col("swaps_before")
                                     - F.coalesce("last.swaps", F.lit(0))) % 2).cast("int")))
    ends_inside = F.when(F.col("inside") == 1, F.col("ends_in")).otherwise(F.col("ends_out")) == 1
    begins = ends_inside & ((F.col("inside") == 0) | F.col("closes_in"))
    filled = F.coalesce(F.max((~F.col("blank")).cast("int")).over(before), F.lit(0))
    return (known.withColumn("begins", begins)
            .select("file", "block", "inside",
                    F.last(F.when(F.col("begins"), F.col("block")), ignorenulls=True).over(before).alias("owner"),
                    ((filled == 0) & ~F.col("blank")).alias("header"),
                    F.first("crlf").over(upto).alias("crlf")))


def decoded(text: Column, encoding: str) -> Column:
    name = SPLIT_ENCODINGS[encoding.lower()]
    return text.cast("string") if name == "UTF-8" else F.decode(text, name)


def record_texts(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """One row (record) per data record of the CSV files at ``path``, headers and blank lines left out."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("line"))
    starts = split_starts(lines.mapInArrow(_split_ends, _ENDS))
    cut = lines.join(F.broadcast(starts), ["file", "block"], "left").mapInArrow(_cut_records, _RECORDS)
    cut = write_stage(cut, "csv_records")
    text = decoded(F.col("text"), encoding)
    whole = cut.where(F.col("owner").isNull()).select(text.alias("record"))
    pieces = F.array_sort(F.collect_list(F.struct("block", text.alias("text"))))
    crossing = (cut.where(F.col("owner").isNotNull()).groupBy("file", "owner")
                .agg(F.array_join(pieces["text"], "\n").alias("record"), F.max("header").alias("header"))
                .where(~F.col("header")).select("record"))
    return whole.unionAll(crossing)


def parse_records(texts: DataFrame, names: list[str]) -> DataFrame:
    """Columns ``names`` from ``record``, all text, by Spark's own CSV parser; unquoted empty fields are NULL."""
    options = {"escape": '"', "nullValue": _NO_VALUE, "emptyValue": "", "lineSep": "\n", "multiLine": "true"}
    slots = [f"c{i}" for i in range(len(names))]
    parsed = F.from_csv("record", ", ".join(f"{s} string" for s in slots), options)
    return texts.select(parsed.alias("r")).select(*[F.col(f"r.{s}").alias(n) for s, n in zip(slots, names)])
