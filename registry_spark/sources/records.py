"""CSV whose quoted fields hold line breaks, read in as many tasks as the files have blocks.

A line alone does not tell whether it lies inside a quoted field; that depends on all lines before. What a line
does to that state is one of four things, though: leave it, turn it, open a field, or close one. These are worked
out line by line without a look at others, and composed: over the lines of a block by a window, over the
blocks of a file by a second one on one row a block. Lines that are records go straight to the parser;
only those of longer records are brought together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A field: quoted (what follows its end up to the comma belongs to it), plain, or empty.
FIELD = r'(?:"(?:[^"]++|"")*+"[^,]*+|[^",][^,]*+|)'
COMPLETE = f"^{FIELD}(?:,{FIELD})*+$"


def lines_of(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """Lines with their file, the block of it they were read in, and ``at``, their order inside the block."""
    text = spark.read.option("lineSep", "\n").text(path)
    value = F.col("value") if encoding.upper() == "UTF-8" else F.decode(F.col("value").cast("binary"), encoding)
    return text.select(
        value.alias("line"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
    )


def inside_after(line: Column, inside: bool) -> Column:
    """Whether a quoted field is open after a line that begins inside or outside of one."""
    quoted = F.contains(line, F.lit('"'))
    text = F.concat(F.lit('"'), line) if inside else line
    return F.when(quoted, ~F.rlike(text, F.lit(COMPLETE))).otherwise(F.lit(inside))


def composed(df: DataFrame, order: Window, known: Column, turned: Column, names: tuple[str, str]) -> DataFrame:
    """Running composition: ``names[0]`` is the state set last, as turned since (NULL if never set); ``names[1]`` whether turns are odd.

    ``known`` is the state a row sets, else NULL; ``turned`` whether it turns the state.
    """
    turns = F.sum(F.when(turned, 1).otherwise(0)).over(order)
    df = df.withColumn("_turns", turns).withColumn("_known", known)
    state = F.last(F.when(F.col("_known").isNotNull(), F.struct("_known", "_turns")), ignorenulls=True).over(order)
    df = df.withColumn("_last", state)
    odd = lambda n: n % 2 == 1
    return df.withColumns({
        names[0]: F.when(F.col("_last").isNotNull(), F.col("_last._known") != odd(F.col("_turns") - F.col("_last._turns"))),
        names[1]: odd(F.col("_turns")),
    }).drop("_turns", "_known", "_last")


def with_state(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lines with ``before`` and ``after``, whether a field is open there, and the blocks with theirs."""
    outer, inner = F.col("o"), F.col("q")
    lines = lines.withColumns({"o": inside_after(F.col("line"), False), "q": inside_after(F.col("line"), True)})
    in_block = Window.partitionBy("file", "block").orderBy("at")
    lines = composed(lines, in_block, F.when(outer == inner, outer), outer & ~inner, ("known", "odd")).drop("o", "q")
    blocks = lines.groupBy("file", "block").agg(F.max_by(F.struct("known", "odd"), "at").alias("end"))
    in_file = Window.partitionBy("file").orderBy("block")
    blocks = composed(blocks, in_file, F.col("end.known"), F.col("end.known").isNull() & F.col("end.odd"), ("known", "odd"))
    closing = F.coalesce("known", "odd")
    blocks = blocks.select("file", "block", closing.alias("closing"), F.lag(closing, 1, False).over(in_file).alias("opening"))
    lines = lines.join(blocks.select("file", "block", "opening"), ["file", "block"])
    lines = lines.withColumn("after", F.coalesce("known", F.col("opening") != F.col("odd"))).drop("known", "odd")
    return lines.withColumn("before", F.coalesce(F.lag("after").over(in_block), "opening")).drop("opening"), blocks


def records_of(lines: DataFrame) -> DataFrame:
    """Records as text, by the block and number of their first line: file, block, number, text."""
    in_block = Window.partitionBy("file", "block").orderBy("at")
    lines = lines.withColumn("number", F.sum(F.when(F.col("before"), 0).otherwise(1)).over(in_block))
    # Filters of later steps may be evaluated before this one, so lines that are no records have no text to parse.
    whole = ~F.col("before") & ~F.col("after")
    alone = lines.filter(whole).select("file", "block", "number", F.when(whole, F.col("line")).alias("text"))
    several = lines.filter("before OR after")
    # Lines at the head of a block that go on with a record of an earlier one: its last.
    blocks = lines.groupBy("file", "block").agg(F.max("number").alias("n"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    open_record = F.last(F.when(F.col("n") > 0, F.struct("block", "n")), ignorenulls=True).over(earlier)
    blocks = blocks.select("file", "block", open_record.alias("open"))
    several = several.join(blocks, ["file", "block"])
    first = F.when(F.col("number") > 0, F.struct("block", F.col("number").alias("n"))).otherwise(F.col("open"))
    stitched = several.groupBy("file", first.alias("first")).agg(F.sort_array(F.collect_list(F.struct("block", "at", "line"))).alias("lines"))
    text = F.array_join(F.transform("lines", lambda x: x["line"]), "\n")
    return alone.unionByName(stitched.select("file", F.col("first.block").alias("block"), F.col("first.n").alias("number"), text.alias("text")))


def read_records(spark: SparkSession, path: str, *, encoding: str = "UTF-8", mode: str = "FAILFAST") -> DataFrame:
    """CSV files with a header each, all columns text, ``NA`` NULL; line breaks in quoted fields are kept as ``\\n``.

    Every file is cut into blocks as without line breaks. Empty lines are left out. The header is one line. A quoted
    field without an end stops the read, as does, in mode FAILFAST, a record with too few or too many fields.
    """
    columns = spark.read.options(header=True, encoding=encoding, escape='"').csv(path).columns
    lines, blocks = with_state(lines_of(spark, path, encoding))
    last = blocks.groupBy("file").agg(F.max_by("closing", "block").alias("closing"))
    unclosed = [r["file"] for r in last.filter("closing").select("file").limit(1).collect()]
    if unclosed:
        raise ValueError(f"a quoted field has no end: {unclosed[0]}")
    records = records_of(lines).filter("NOT (block = 0 AND number = 1)")
    text = F.regexp_replace(F.regexp_replace("text", "\r\n", "\n"), "\r$", "")
    schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in columns)
    options = {"mode": mode, "escape": '"', "nullValue": "NA", "columnPruning": "false"}
    some = F.trim(text) != ""
    parsed = records.filter(some).select(F.from_csv(F.when(some, text), schema, options).alias("record"))
    return parsed.select("record.*")
