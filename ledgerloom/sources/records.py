"""Records of delimited files whose quoted values may hold line breaks, read in splits (A1).

Where a record begins depends on everything before it in its file. At the start of a line a reader is
in one of two states: at a new record, or inside a quoted value. What a line does to the state is a
function of two states, and so is what a split does: its lines one after the other. The splits'
functions are found first, each by its own task; run one after the other, split by split, they say in
which state every split begins, and then the splits can be read independently. A quote counts only
where it opens, closes or doubles within a quoted value; elsewhere it is a character like others.

No line is shuffled, except those of records that lie across the edge of a split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.operators.joins import MAX_BROADCAST_ROWS
from ledgerloom.session import shared_dir

RECORD, HEADER, LEAD, TAIL = range(4)
_BOM = "﻿"


def ends_quoted(line: Column, delimiter: str, quote: str) -> Column:
    """Whether a line that begins a record ends inside a quoted value.

    Fields are taken off from the left: a quoted one up to its closing quote and on to the next
    delimiter, a bare one up to the delimiter. Only a quoted value without an end is left over.
    """
    d, q = (f"\\x{{{ord(c):x}}}" for c in (delimiter, quote))
    field = f"\\G{d}(?:{q}[^{q}]*+(?:{q}{q}[^{q}]*+)*+{q}[^{d}]*+|(?!{q})[^{d}]*+)"
    return F.length(F.regexp_replace(F.concat(F.lit(delimiter), line), field, "")) > 0


def _lines(spark: SparkSession, path: str | list[str], delimiter: str, quote: str) -> DataFrame:
    """Lines with their split and what they do: whether they end quoted if they begin a record
    (``_bare``), and if they begin inside a quoted value (``_quoted``)."""
    # Both passes must see the same splits, also if executors come and go between them.
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", spark.sparkContext.defaultParallelism)
    at = F.col("_metadata.file_block_start")
    marked = F.col("value").startswith(_BOM) & (at == 0)
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("source_file"), at.alias("_at"),
        F.when(marked, F.substr("value", F.lit(2))).otherwise(F.col("value")).alias("_line"),
    )
    has_quote = F.col("_line").contains(quote)
    return lines.withColumns({
        "_bare": has_quote & ends_quoted(F.col("_line"), delimiter, quote),
        # Inside a quoted value a line is like one that opens with a quote.
        "_quoted": ~has_quote | ends_quoted(F.concat(F.lit(quote), F.col("_line")), delimiter, quote),
    })


def walk(bare: np.ndarray, quoted: np.ndarray, start: bool) -> np.ndarray:
    """The state before each line and after the last one, True inside a quoted value."""
    turns = np.cumsum(bare & ~quoted) & 1
    fixed = np.maximum.accumulate(np.where(bare == quoted, np.arange(len(bare)), -1))
    since = np.where(fixed >= 0, bare[fixed] ^ (turns[fixed] == 1), start)
    return np.concatenate([[start], since ^ (turns == 1)])


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """The parts of a batch that lie in one split each."""
    at = batch.column("_at").to_numpy()
    code = batch.column("source_file").dictionary_encode().indices.to_numpy()
    cuts = np.flatnonzero((np.diff(at) != 0) | (np.diff(code) != 0)) + 1
    for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
        if b > a:
            yield batch.column("source_file")[a].as_py(), int(at[a]), batch.slice(a, b - a)


def _flags(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(part.column(c).to_numpy(zero_copy_only=False) for c in ("_bare", "_quoted"))


def _split_functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per split: its state at the end for either state at the start, and for the first
    split of a file whether its first line has a carriage return at the end, or elsewhere, and
    whether no record ends in it."""
    split, ends, first, headless = None, (False, True), None, True

    def row():
        whole = first is not None
        return pa.RecordBatch.from_pylist([{
            "source_file": split[0], "_at": split[1], "_bare": bool(ends[0]), "_quoted": bool(ends[1]),
            "_crlf": whole and first.endswith(b"\r"), "_cr": whole and b"\r" in first[:-1],
            "_headless": whole and bool(headless)}])

    for batch in batches:
        for file, at, part in _runs(batch):
            if split != (file, at):
                if split:
                    yield row()
                split, ends, headless = (file, at), (False, True), True
                first = part.column("_first")[0].as_py() if at == 0 else None
            walks = [walk(*_flags(part), start) for start in ends]
            headless = headless and walks[0][1:].all()
            ends = tuple(states[-1] for states in walks)
    if split:
        yield row()


def _states(functions: DataFrame) -> DataFrame:
    """Each split with the state it begins and ends in; one row per split is sorted by file."""
    by_file = Window.partitionBy("source_file")
    order = by_file.orderBy("_at")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    fixed = F.col("_bare") == F.col("_quoted")
    turns = F.sum(F.when(F.col("_bare") & ~F.col("_quoted"), 1).otherwise(0)).over(
        order.rowsBetween(Window.unboundedPreceding, 0))
    last = F.last(F.when(fixed, F.struct("_bare", "_turns")), ignorenulls=True).over(before)
    turned = F.coalesce(F.lag("_turns").over(order), F.lit(0)) - F.coalesce("_last._turns", F.lit(0))
    start = F.coalesce("_last._bare", F.lit(False)) != (turned % 2 == 1)
    return (
        functions.withColumn("_turns", turns).withColumn("_last", last)
        .withColumn("_start", start)
        .withColumn("_end", F.when(F.col("_start"), F.col("_quoted")).otherwise(F.col("_bare")))
        .select("source_file", "_at", "_start", "_end", "_headless",
                F.bool_or("_crlf").over(by_file).alias("_crlf"), F.bool_or("_cr").over(by_file).alias("_cr"))
    )


def _records(parts: bool):
    """Whole records of each split, or else (``parts``) what it holds of records across its edges."""
    names = ["source_file", "_at", "_kind", "_text"]

    def rows(file: str, at: int, kind: int, texts: pa.Array) -> pa.RecordBatch:
        n = len(texts)
        return pa.RecordBatch.from_arrays(
            [pa.array([file], pa.string()).take(pa.array(np.zeros(n, np.int64))), pa.array(np.full(n, at)),
             pa.array(np.full(n, kind, np.int32)), texts], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, state, open_lines, lead, header_due = None, False, [], False, False

        def piece(kind: int) -> pa.RecordBatch:
            return rows(*split, kind, pa.array([b"\n".join(open_lines)], pa.binary()))

        for batch in batches:
            for file, at, part in _runs(batch):
                if split != (file, at):
                    if open_lines and parts:
                        yield piece(LEAD if lead else TAIL)
                    split, open_lines = (file, at), []
                    state = lead = part.column("_start")[0].as_py()
                    header_due = at == 0
                lines = part.column("_line")
                states = walk(*_flags(part), state)
                alone = ~states[:-1] & ~states[1:]
                if header_due:  # the first line that is not blank begins the header
                    blank = pc.is_in(lines, pa.array([b"", b"\r"], pa.binary())).to_numpy(zero_copy_only=False)
                    filled = np.flatnonzero(~alone | ~blank)
                    if len(filled) and alone[filled[0]]:
                        if not parts:
                            yield rows(file, at, HEADER, lines.slice(int(filled[0]), 1))
                        alone[:filled[0] + 1] = False
                        joined = np.flatnonzero(~alone)
                        joined = joined[joined > filled[0]]
                        header_due = False
                    else:
                        joined = np.flatnonzero(~alone)
                        alone[:joined[0] if len(joined) else len(alone)] = False
                else:
                    joined = np.flatnonzero(~alone)
                if not parts and alone.any():
                    yield rows(file, at, RECORD, lines.filter(pa.array(alone)))
                for i in joined:
                    open_lines.append(lines[int(i)].as_py())
                    if not states[i + 1]:
                        if lead:
                            if parts:
                                yield piece(LEAD)
                        elif not parts:
                            yield piece(HEADER if header_due else RECORD)
                            header_due = False
                        open_lines, lead = [], False
                state = bool(states[-1])
        if open_lines and parts:
            yield piece(LEAD if lead else TAIL)
    return run


def _across(pieces: DataFrame) -> DataFrame:
    """Records put together from their pieces: a tail, and the leads that follow it in its file."""
    earlier = Window.partitionBy("source_file").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    tail = F.last(F.when(F.col("_kind") == TAIL, F.col("_at")), ignorenulls=True).over(earlier)
    whole = pieces.withColumn("_of", tail).groupBy("source_file", "_of").agg(
        F.array_sort(F.collect_list(F.struct("_at", "_kind", F.col("_text").cast("string").alias("text"))))
        .alias("_pieces"))
    text = F.array_join(F.transform("_pieces", lambda p: p["text"]), "\n")
    return whole.select("source_file", F.lit(RECORD).alias("_kind"), text.alias("_text"))


def split_records(
    spark: SparkSession, path: str | list[str], headers: list[str], delimiter: str = ",", quote: str = '"',
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame | None:
    """Rows of UTF-8 exports as text, one column per header and ``source_file``, read in splits.

    Values are those between the delimiters, line breaks within quotes as they are; blank lines are no
    rows. A record ends with its line, whether that ends with a line feed or with a carriage return
    before it, or with its file. Of columns with one name the last counts; a file whose header is
    not ``headers`` is an error. The result is None if the files need a reader that sees them
    whole: lines end with carriage returns alone, a header is longer than a split, or more splits
    begin inside a value than may be broadcast.
    """
    if len(delimiter) != 1 or len(quote) != 1:
        return None
    lines = _lines(spark, path, delimiter, quote)
    stored = shared_dir(spark, "splits")
    first = F.when(F.col("_at") == 0, F.col("_line").cast("binary")).alias("_first")
    functions = lines.select("source_file", "_at", "_bare", "_quoted", first).mapInArrow(
        _split_functions, "source_file string, _at long, _bare boolean, _quoted boolean, _crlf boolean, "
                            "_cr boolean, _headless boolean")
    _states(functions).write.mode("overwrite").parquet(stored)
    splits = spark.read.parquet(stored)
    # Other splits begin and end with a record, and their lines end with a line feed alone.
    special = splits.filter("_start OR _end OR _crlf OR _cr")
    facts = special.agg(
        F.count("*").alias("n"), F.bool_or("_cr").alias("cr"), F.bool_or("_end").alias("edges"),
        F.bool_or(F.expr("_at = 0 AND _end AND _headless")).alias("first"),
    ).first()
    if facts.cr or facts.first or facts.n > max_broadcast_rows:
        return None
    known = F.broadcast(special.select("source_file", "_at", "_start", "_end", "_crlf"))
    schema = "source_file string, _at long, _kind int, _text binary"
    no = F.lit(False)

    def read(parts: bool, how: str) -> DataFrame:
        found = lines.join(known, ["source_file", "_at"], how)
        return found.select(
            "source_file", "_at", "_bare", "_quoted", F.coalesce("_start", no).alias("_start"),
            F.col("_line").cast("binary").alias("_line"),
        ).mapInArrow(_records(parts), schema)

    text = F.col("_text").cast("string").alias("_text")
    whole = read(False, "left").select("source_file", "_kind", text)
    if facts.edges:
        whole = whole.unionByName(_across(read(True, "inner")))
    if facts.n:
        crlf = F.broadcast(special.filter("_crlf").select("source_file").distinct())
        marked = whole.join(crlf.withColumn("_crlf", F.lit(True)), "source_file", "left")
        whole = marked.withColumn("_text", F.when(F.coalesce("_crlf", no), F.regexp_replace("_text", r"\r\z", ""))
                                  .otherwise(F.col("_text")))
    names = [f"_{i}" for i in range(len(headers))]
    parsed = F.from_csv("_text", ", ".join(f"{n} STRING" for n in names),
                        {"sep": delimiter, "quote": quote, "escape": quote})
    rows = whole.filter((F.col("_kind") == HEADER) | (F.col("_text") != "")) \
        .select("source_file", "_kind", "_text", parsed.alias("_row"))
    same = F.lit(True)
    for n, header in zip(names, headers):
        same = same & (F.coalesce(f"_row.{n}", F.lit("")) == F.lit(header))
    wrong = F.concat(F.lit("export has another header: "), F.substring("_text", 1, 1000))
    keep = F.when(F.col("_kind") != HEADER, True).when(same, False).otherwise(F.raise_error(wrong).cast("boolean"))
    last = {h: n for n, h in zip(names, headers) if h}
    return rows.filter(keep).select("source_file", *(F.col(f"_row.{n}").alias(h) for h, n in last.items()))
