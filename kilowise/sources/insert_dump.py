"""Rows of ``INSERT INTO t VALUES (...), (...);`` dumps, read by a lexer that runs on all splits at once.

Where a split begins, nobody knows yet whether that place lies in a quoted text or a comment. So each
split is first read for every mode it could begin in: what mode does it end in, and how many parentheses
does it open? These answers, one row per split, are put together along the file and give the mode
and depth at the begin of every split. The second reading starts from those and cuts the text into units
at the commas and semicolons outside of quotes, comments and parentheses. A unit holds one tuple, the first of a
statement also its head. The two units at the ends of a split may be parts of longer ones; only these
are gathered per file and joined to whole units, and they say which table goes on in the next split.

Texts may be in single or double quotes, hold commas, parentheses, marks of comments and line ends, and
double a quote to mean it. Statements, tuples and comments may go on over any number of lines and splits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kilowise.plans.sizing import BROADCAST_BYTES, base_bytes
from kilowise.plans.storage import materialize

PLAIN = "plain"
_CLOSING = {"single": "'", "double": '"', "comment": "*/"}
_OPENING = {"'": "single", '"': "double", "/*": "comment"}
MODES = (PLAIN, *_CLOSING)
# Whole quoted texts and comments, openers of ones that do not end here, and the marks between units.
_TOKEN = re.compile(r"""'[^']*+'|"[^"]*+"|--[^\n]*+|/\*(?s:.*?)\*/|/\*|['"(),;]""")

_SPLIT = ("file", "block")
_UNIT = "file string, block long, seq long, first boolean, mark string, table string, columns array<string>, body array<string>, text string"
NO_TABLE = ""  # of units in statements that are no INSERT


class DumpError(ValueError):
    pass


def skim(text: str, mode: str) -> tuple[str, int]:
    """The mode that whole lines end in when they begin in ``mode``, and the parentheses that they leave open."""
    at = 0
    if mode != PLAIN:
        end = text.find(_CLOSING[mode])
        if end < 0:
            return mode, 0
        at = end + len(_CLOSING[mode])
    opened = 0
    for token in _TOKEN.finditer(text, at):
        mark = token.group()
        if mark == "(":
            opened += 1
        elif mark == ")":
            opened -= 1
        elif mark in _OPENING:
            return _OPENING[mark], opened
    return PLAIN, opened


class Lexer:
    """Cuts text that comes in stretches of whole lines into units, comments left out."""

    def __init__(self, mode: str = PLAIN, depth: int = 0) -> None:
        self.mode, self.depth = mode, depth
        self._parts: list[str] = []

    def rest(self) -> str:
        """Text of the unit that has not come to its end."""
        return "".join(self._parts)

    def feed(self, text: str) -> Iterator[tuple[str, str]]:
        """Units that end here, each with the mark behind it."""
        at = 0
        if self.mode != PLAIN:
            closing = _CLOSING[self.mode]
            end = text.find(closing)
            at = len(text) if end < 0 else end + len(closing)
            if self.mode != "comment":
                self._parts.append(text[:at])
            if end < 0:
                return
            self.mode = PLAIN
        for token in _TOKEN.finditer(text, at):
            mark = token.group()
            if mark == "(":
                self.depth += 1
            elif mark == ")":
                self.depth -= 1
            elif mark in (",", ";") and not self.depth:
                self._parts.append(text[at : token.start()])
                at = token.end()
                yield self.rest(), mark
                self._parts.clear()
            elif mark == ";":
                raise DumpError(f"a statement ends inside of parentheses: {self.rest()[-200:]}{text[at : token.start()][-200:]}")
            elif mark.startswith(("--", "/*")):
                self._parts += [text[at : token.start()], " "]
                at = token.end() if mark != "/*" else len(text)
            if mark in _OPENING:
                self.mode = _OPENING[mark]
                break
        self._parts.append(text[at:])


class Unit(NamedTuple):
    """``table``: None where the unit goes on with the statement before it."""

    table: str | None
    columns: list[str] | None
    body: list[str | None] | None


def _outer_parts(text: str) -> tuple[list[str], list[tuple[int, str]]]:
    """Words outside of parentheses; outer parentheses, each with the number of words before it."""
    words: list[str] = []
    groups: list[tuple[int, str]] = []
    depth = at = 0
    for token in _TOKEN.finditer(text):
        mark = token.group()
        if mark == "(":
            if not depth:
                words += text[at : token.start()].split()
                at = token.end()
            depth += 1
        elif mark == ")":
            depth -= 1
            if not depth:
                groups.append((len(words), text[at : token.start()]))
                at = token.end()
    return words + text[at:].split(), groups


def _name(word: str) -> str:
    return word.rpartition(".")[2].strip('"`[]').lower()


def _value(raw: str) -> str | None:
    raw = raw.strip()
    quote = raw[:1]
    if quote in ("'", '"') and len(raw) > 1 and raw.endswith(quote):
        inner = raw[1:-1].replace(quote * 2, "\0")
        if quote not in inner:
            return inner.replace("\0", quote)
    return None if raw.upper() in ("", "NULL", "DEFAULT") else raw


def _values(body: str) -> list[str | None]:
    values, depth, at = [], 0, 0
    for token in _TOKEN.finditer(body):
        mark = token.group()
        depth += (mark == "(") - (mark == ")")
        if mark == "," and not depth:
            values.append(_value(body[at : token.start()]))
            at = token.end()
    return [*values, _value(body[at:])]


def read_unit(text: str, first: bool, wanted: str) -> Unit:
    """One unit of a dump; ``first`` says that a statement begins with it. Values are read for the wanted
    table, and for units that do not say which table they belong to: those further on in a statement, and
    tuples that stand alone behind one. An INSERT may also follow a comma."""
    words, groups = _outer_parts(text)
    upper = [w.upper() for w in words]
    insert = upper[:2] == ["INSERT", "INTO"] and len(words) > 2
    if not insert and (not first or not words):
        # Text without a tuple has no values, which no table takes; if the statement is of no table, it is none the worse.
        return Unit(None, None, _values(groups[0][1]) if groups else [] if words else None)
    if not insert or _name(words[2]) != wanted:
        return Unit(NO_TABLE, None, None)
    if "VALUES" not in upper[3:]:
        raise DumpError(f"an INSERT without VALUES: {text.strip()[:200]}")
    at = upper.index("VALUES", 3) + 1
    before, after = ([body for n, body in groups if (n >= at) == side] for side in (False, True))
    if not after:
        raise DumpError(f"VALUES without a tuple: {text.strip()[:200]}")
    return Unit(wanted, [_name(c.strip()) for c in before[0].split(",")] if before else None, _values(after[0]))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, str, dict]]:
    """Split, whole lines and first row of each stretch of rows of one split, in order."""
    for batch in batches:
        rows = batch.to_pylist()
        for split, own in groupby(rows, key=lambda r: (r["file"], r["block"])):
            lines = list(own)
            yield split, "\n".join(r["value"] for r in lines) + "\n", lines[0]


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per split and mode that it may begin in: mode and parentheses at its end."""
    for split, stretches in groupby(_texts(batches), key=lambda x: x[0]):
        now = [(mode, 0) for mode in MODES]
        for _, text, _ in stretches:
            after = {mode: skim(text, mode) for mode in {m for m, _ in now}}
            now = [(after[mode][0], depth + after[mode][1]) for mode, depth in now]
        modes, opened = zip(*now)
        yield pa.RecordBatch.from_pylist([{"file": split[0], "block": split[1], "modes": list(modes), "opened": list(opened)}])


def _begins(splits: pd.DataFrame) -> pd.DataFrame:
    """Mode and depth at the begin of each split of one file."""
    rows, mode, depth = [], PLAIN, 0
    for s in splits.sort_values("block").itertuples():
        rows.append((s.file, s.block, mode, depth))
        place = MODES.index(mode)
        mode, depth = s.modes[place], depth + s.opened[place]
        if depth < 0:
            raise DumpError(f"parentheses are closed that were not opened: {s.file}, split at {s.block}")
    if mode != PLAIN or depth:
        raise DumpError(f"{s.file} ends inside of a quoted text, a comment or parentheses")
    return pd.DataFrame(rows, columns=["file", "block", "mode", "depth"])


def _cut(wanted: str):
    """Units of each split. Those at its two ends are given as text, the others as values; units of other tables go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("file", pa.string()), ("block", pa.int64()), ("seq", pa.int64()), ("first", pa.bool_()), ("mark", pa.string()),
             ("table", pa.string()), ("columns", pa.list_(pa.string())), ("body", pa.list_(pa.string())), ("text", pa.string())]
        )
        for split, stretches in groupby(_texts(batches), key=lambda x: x[0]):
            lexer, seq, first = None, 0, False
            table, columns = None, None  # of the last statement that began in this split
            for _, text, row in stretches:
                lexer = lexer or Lexer(row["mode"], row["depth"])
                rows = []
                for unit, mark in lexer.feed(text):
                    known = (*split, seq, first, mark)
                    if not seq:
                        rows.append((*known, None, None, None, unit))
                    else:
                        own, own_columns, body = read_unit(unit, first or table == NO_TABLE, wanted)
                        if own is not None:
                            table, columns = own, own_columns
                        if body is not None and table != NO_TABLE:
                            rows.append((*known, table, columns, body, None))
                    seq, first = seq + 1, mark == ";"
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(schema), schema)], schema=schema)
            last = {"file": split[0], "block": split[1], "seq": seq, "first": first, "table": table, "columns": columns, "text": lexer.rest()}
            yield pa.RecordBatch.from_pylist([last], schema=schema)

    return run


def _seams(wanted: str):
    """Whole units from the parts at the ends of a file's splits, and for each split the table that goes on into it."""

    def run(parts: pd.DataFrame) -> pd.DataFrame:
        rows = []
        text, first = "", True
        table, columns = NO_TABLE, None

        def end() -> None:
            nonlocal table, columns
            unit = read_unit(text, first or table == NO_TABLE, wanted)
            if unit.table is not None:
                table, columns = unit.table, unit.columns
            if table == wanted and unit.body is not None:
                rows.append((file, None, table, columns, unit.body))

        for p in parts.sort_values(["block", "seq"]).itertuples():
            file = p.file
            if p.mark is not None:  # the unit that the split began with
                text += p.text
                end()
                rows.append((file, p.block, table, columns, None))
            elif p.seq:  # the one that it ends with
                text, first = p.text, p.first
                if p.table is not None:
                    table, columns = p.table, p.columns
            else:  # a split inside of one unit
                text += p.text
        end()
        return pd.DataFrame(rows, columns=["file", "block", "table", "columns", "body"])

    return run


def _units(spark: SparkSession, path: str, wanted: str) -> DataFrame:
    """columns, body: the values of each tuple of a table, and the column list of its statement if there is one."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value",
        F.monotonically_increasing_id().alias("row"),
    )
    text = lines.drop("row")
    ends = materialize(text.mapInArrow(_ends, "file string, block long, modes array<string>, opened array<long>"), "dump-ends")
    begins = materialize(ends.groupBy("file").applyInPandas(_begins, "file string, block long, mode string, depth long"), "dump-begins")
    size = base_bytes(begins)
    if size is not None and size <= BROADCAST_BYTES:  # the rows stay in the order of the file
        placed = text.join(F.broadcast(begins), [*_SPLIT])
    else:
        placed = lines.join(begins, [*_SPLIT]).repartition(*_SPLIT).sortWithinPartitions(*_SPLIT, "row").drop("row")
    found = materialize(placed.mapInArrow(_cut(wanted), _UNIT), "dump-units")
    seams = found.filter("text IS NOT NULL").groupBy("file")
    seams = materialize(seams.applyInPandas(_seams(wanted), "file string, block long, table string, columns array<string>, body array<string>"), "dump-seams")
    inside = found.filter("text IS NULL")
    inherited = seams.filter((F.col("block").isNotNull()) & (F.col("table") == wanted)).select(*_SPLIT, F.col("columns").alias("of_table"))
    own = inside.filter(F.col("table") == wanted).select("columns", "body")
    goes_on = inside.filter("table IS NULL").join(inherited, [*_SPLIT]).select(F.col("of_table").alias("columns"), "body")
    return own.unionByName(goes_on).unionByName(seams.filter("block IS NULL").select("columns", "body"))


def read_insert_dump(spark: SparkSession, path: str, table: str, schema: T.StructType | None = None) -> DataFrame:
    """Typed rows of one table; all its INSERT statements are kept, statements of other kinds and tables are passed over.

    A value takes the field that the statement's column list names it for, or without a list the field at its
    place. NULL, DEFAULT, and what its type cannot take are null. A tuple with too many or too few values, an INSERT of
    the table without VALUES, and a file that ends inside of a quoted text, a comment or a tuple raise: no row is
    lost in silence. Without a schema the columns are texts named col_0, col_1 ..., as many as the first row has.
    """
    units = _units(spark, path, table.lower())
    if schema is None:
        first = units.first()
        if first is None:
            raise ValueError(f"no rows of {table} in {path}")
        schema = T.StructType([T.StructField(f"col_{i}", T.StringType()) for i in range(len(first["body"]))])
        units = units.withColumn("columns", F.lit(None).cast("array<string>"))
    names = [f.name.lower() for f in schema.fields]
    wrong = (F.size("body") != F.coalesce(F.array_size("columns"), F.lit(len(names)))) | (
        F.col("columns").isNotNull() & ~F.coalesce(F.arrays_overlap("columns", F.array(*map(F.lit, names))), F.lit(False))
    )
    shown = F.concat(F.lit(f"this tuple does not fit the columns of {table}: "), F.to_json("body"))
    body = F.when(wrong, F.raise_error(shown).cast("array<string>")).otherwise(F.col("body"))

    def field(place: int, name: str) -> Column:
        listed = F.array_position("columns", name).cast("int") - 1
        index = F.when(F.col("columns").isNull(), F.lit(place)).otherwise(F.nullif(listed, F.lit(-1)))
        return F.get("body", index)

    typed = [field(i, n).try_cast(f.dataType).alias(f.name) for i, (n, f) in enumerate(zip(names, schema.fields))]
    return units.withColumn("body", body).select(*typed)
