"""Window expressions over each symbol's rows in date order.

The plain form is one ``Window.partitionBy("symbol")``: one task per symbol.
With one row per symbol and day that is bounded, because a century of daily
rows is 36,525 rows. Without that promise a symbol, or even one symbol and day,
may hold any share of the input. So the rows of hot symbols go through a
segmented scan: range partitions of the whole order are the segments, what a
segment hands on is its last few rows (its tail), and the rows before a segment
(its halo) come from the tails of those before it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from candlewick.storage import scratch_folder

# A symbol is hot above HOT_ROWS rows and above 1/MAX_BLOCKS of all rows. So
# there are at most MAX_BLOCKS hot symbols and about as many blocks in all,
# which bounds everything that is broadcast below.
HOT_ROWS = 1_000_000
MAX_BLOCKS = 20_000
# Rows with more identical copies than this share of a block are counted instead of sorted.
COPIES_SHARE = 4
COPIES_PER_TASK = 100_000

Expressions = Mapping[str, Callable[[WindowSpec], Column]]


def over_series(
    bars: DataFrame,
    expressions: Expressions,
    reach: int,
    tie: Sequence[str] = (),
    unique: bool = False,
    hot_rows: int = HOT_ROWS,
    split: bool = True,
) -> DataFrame:
    """Add ``expressions``, each a function of a window that looks at most ``reach`` rows back.

    ``unique`` promises one row per symbol and date. Otherwise rows of one date
    are ordered by ``tie`` and then by the remaining columns, so the result
    does not depend on how the input is partitioned.

    Unless told ``unique`` or ``split=False``, the symbols are counted first; if
    none is hot, the result is the plain window over ``bars`` and nothing else.
    Otherwise the hot symbols' rows are written to the scratch folder, in order,
    before the result is returned, so that a lost executor changes no block.
    """
    # Either form below returns zeros without a sign, so a symbol's size changes no value.
    plain = {c: F.when(F.col(c) == 0, F.lit(0).cast(t)).otherwise(F.col(c)) for c, t in bars.dtypes if t in ("double", "float")}
    bars = bars.withColumns(plain) if plain else bars
    rest = [c for c in bars.columns if c not in {"symbol", "date", *tie}]
    order = ["date"] if unique else ["date", *tie, *rest]
    window = Window.partitionBy("symbol").orderBy(*order)
    whole = bars.withColumns(_bind(expressions, window))
    if unique or not split:
        return whole
    hot = hot_symbols(bars, hot_rows)
    found = hot.agg(F.max("_block_rows").alias("block_rows"), F.sum("_rows").alias("rows")).first()
    if found.rows is None:
        return whole

    folder = scratch_folder(bars.sparkSession)
    hot = F.broadcast(_stored(hot, f"{folder}/hot"))
    is_hot = F.col("symbol").eqNullSafe(F.col("_hot"))
    cold = bars.join(hot, is_hot, "left_anti").withColumns(_bind(expressions, window))
    packed = _collapse_copies(bars.join(hot, is_hot).select(bars.columns), found.block_rows, f"{folder}/many")
    rows = _put_in_order(packed, order, -(-found.rows // found.block_rows), found.block_rows, f"{folder}/rows")
    blocks = _spell_out_copies(rows, reach)
    window = Window.partitionBy("symbol", "_block").orderBy("_at", "_copy")
    extended = blocks.unionByName(_rows_before_each_block(rows, reach)).withColumns(_bind(expressions, window))

    columns = [*bars.columns, *expressions]
    return (
        cold.select(columns)
        .unionByName(extended.filter(~F.col("_halo")).select(columns))
        .unionByName(_further_copies(rows, bars.columns, expressions, reach).select(columns))
    )


def _bind(expressions: Expressions, window: WindowSpec) -> dict[str, Column]:
    return {name: build(window) for name, build in expressions.items()}


def hot_symbols(bars: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``_hot`` symbol, its ``_rows``, and ``_block_rows``, the wanted rows per block; at most MAX_BLOCKS rows.

    Reads only the symbol column and shuffles one count per symbol and map task.
    """
    sizes = bars.groupBy("symbol").agg(F.count(F.lit(1)).alias("_rows"))
    limit = sizes.agg(F.greatest(F.lit(hot_rows), F.ceil(F.sum("_rows") / MAX_BLOCKS))).scalar()
    return sizes.withColumn("_block_rows", limit).filter("_rows > _block_rows").select(
        F.col("symbol").alias("_hot"), "_rows", "_block_rows"
    )


def _stored(rows: DataFrame, folder: str) -> DataFrame:
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def _collapse_copies(rows: DataFrame, block_rows: int, folder: str) -> DataFrame:
    """Rows with ``_copies``: identical ones as one row and a count if there are very many, others as they are.

    Which ones are many is found by counting hashes, so that no row is moved
    for it; there are at most COPIES_SHARE such hashes per block.
    """
    content = F.xxhash64(*rows.columns)
    hashed = rows.groupBy(content.alias("_hash")).agg(F.count(F.lit(1)).alias("_n"))
    many = _stored(hashed.filter(F.col("_n") > block_rows // COPIES_SHARE).select("_hash"), folder)
    if many.isEmpty():
        return rows.withColumn("_copies", F.lit(1).cast("long"))
    is_many = content == F.col("_hash")
    few = rows.join(F.broadcast(many), is_many, "left_anti").withColumn("_copies", F.lit(1).cast("long"))
    copies = rows.join(F.broadcast(many), is_many, "left_semi").groupBy(*rows.columns)
    return few.unionByName(copies.agg(F.count(F.lit(1)).alias("_copies")))


def _put_in_order(packed: DataFrame, order: list[str], blocks: int, block_rows: int, folder: str) -> DataFrame:
    """The rows with ``_at``, their place in the order, and ``_block``, a range partition.

    The partitions' bounds compare only as many leading columns of the order as
    are needed to tell rows apart in groups no larger than a block, because the
    bounds are sampled on the driver; within a partition all columns count.
    """
    leading = 1
    while leading < len(order):
        groups = packed.groupBy("symbol", *order[:leading]).agg(F.count(F.lit(1)).alias("n"))
        if groups.agg(F.max("n")).first()[0] <= block_rows:
            break
        leading = min(2 * leading, len(order))
    ranged = packed.repartitionByRange(int(blocks), "symbol", *order[:leading]).sortWithinPartitions("symbol", *order)
    # Places of partition p start at p * 2 ** 33.
    rows = _stored(ranged.withColumn("_at", F.monotonically_increasing_id()), folder)
    return rows.withColumn("_block", F.shiftright("_at", 33))


def _spell_out_copies(rows: DataFrame, reach: int) -> DataFrame:
    """The first ``reach + 1`` copies of each row."""
    copies = F.sequence(F.lit(1), F.least("_copies", F.lit(reach + 1)).cast("int"))
    return rows.withColumns({"_copy": F.explode(copies), "_halo": F.lit(False)}).drop("_copies")


def _rows_before_each_block(rows: DataFrame, reach: int) -> DataFrame:
    """The ``reach`` rows before each block, numbered into that block and marked.

    Tails are found by place alone; at most ``reach`` places per block and symbol
    are shuffled and broadcast. A block holds at least one row, so ``reach``
    earlier blocks always suffice.
    """
    places = _spell_out_copies(rows.select("symbol", "_block", "_at", "_copies"), reach)
    backwards = Window.partitionBy("symbol", "_block").orderBy(F.desc("_at"), F.desc("_copy"))
    tails = (
        places.withColumn("_back", F.row_number().over(backwards))
        .filter(F.col("_back") <= reach)
        .groupBy("symbol", "_block")
        .agg(F.sort_array(F.collect_list(F.struct("_at", "_copy"))).alias("_tail"))
    )
    earlier = Window.partitionBy("symbol").orderBy("_block").rowsBetween(-reach, -1)
    before = tails.withColumn("_before", F.flatten(F.collect_list("_tail").over(earlier)))
    last = F.filter("_before", lambda _, i: i >= F.size("_before") - reach)
    halo = before.select(F.col("_block").alias("_next"), F.explode(last).alias("_row")).select(
        "_next", F.col("_row._at").alias("_place"), "_row._copy"
    )
    return (
        rows.join(F.broadcast(halo), F.col("_at") == F.col("_place"))
        .withColumns({"_block": F.col("_next"), "_halo": F.lit(True)})
        .drop("_next", "_place", "_copies")
    )


def _further_copies(
    rows: DataFrame, columns: list[str], expressions: Expressions, reach: int
) -> DataFrame:
    """The copies of a row past ``reach + 1``: they see nothing but copies of themselves.

    So all of them carry the values of copy ``reach + 1`` of a series made of
    that row alone. They are spread over tasks before they are spelled out.
    """
    many = rows.filter(F.col("_copies") > reach + 1).withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), F.lit(reach + 1)))
    )
    alone = Window.partitionBy("_at").orderBy("_copy")
    last = many.withColumns(_bind(expressions, alone)).filter(F.col("_copy") == reach + 1)
    left = F.col("_copies") - (reach + 1)
    pieces = last.withColumn("_left", left).withColumn(
        "_start", F.explode(F.expr(f"sequence(0L, _left - 1, {COPIES_PER_TASK}L)"))
    )
    length = F.least(F.col("_left") - F.col("_start"), F.lit(COPIES_PER_TASK)).cast("int")
    return pieces.repartition("_at", "_start").withColumn(
        "_n", F.explode(F.sequence(F.lit(1), length))
    )
