"""Layout clustered on several columns by a space-filling curve.

Every column is cut into ranges of about equal counts.  The range numbers of a
row are a cell of a grid, and the cells are visited along a curve on which
neighbours stay near each other in all columns.  The table is range-partitioned
by the place on the curve, so a file covers a small box of the grid and its
minimum and maximum of every column rule it out for most filters.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.ranking import cut_points, slot_of

#: ranges per column, as a power of two
BITS = 6


def interleaved(numbers: list[Column], bits: int = BITS) -> Column:
    """Place on the Z curve: the bits of the range numbers in turn, the highest first."""
    parts = []
    for bit in range(bits):
        for i, n in enumerate(numbers):
            place = bit * len(numbers) + len(numbers) - 1 - i
            parts.append(F.shiftleft(F.shiftright(n, bit).bitwiseAND(F.lit(1)).cast("bigint"), place))
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def along_curve(x: Column, y: Column, bits: int = BITS) -> Column:
    """Place on the Hilbert curve of two range numbers; unlike on the Z curve, consecutive cells always touch."""
    start = F.struct(x.cast("bigint").alias("x"), y.cast("bigint").alias("y"), F.lit(0).cast("bigint").alias("at"))

    def step(acc: Column, s: Column) -> Column:
        right, up = (acc["x"].bitwiseAND(s) > 0), (acc["y"].bitwiseAND(s) > 0)
        # quadrants in the order of the curve: lower left, upper left, upper right, lower right
        quadrant = F.when(right, F.when(up, 2).otherwise(3)).otherwise(F.when(up, 1).otherwise(0))
        inner = lambda c: c.bitwiseAND(s - 1)
        a = F.when(up, inner(acc["x"])).when(right, s - 1 - inner(acc["y"])).otherwise(inner(acc["y"]))
        b = F.when(up, inner(acc["y"])).when(right, s - 1 - inner(acc["x"])).otherwise(inner(acc["x"]))
        return F.struct(a.alias("x"), b.alias("y"), (acc["at"] + s * s * quadrant).alias("at"))

    sizes = F.array(*[F.lit(1 << i).cast("bigint") for i in range(bits - 1, -1, -1)])
    return F.aggregate(sizes, start, step, lambda acc: acc["at"])


def _places(bits: int) -> list[int]:
    """Places of all cells on the Hilbert curve, by ``x`` and then ``y``, built up from the curve of half the side."""
    if bits == 0:
        return [0]
    inner, half = _places(bits - 1), 1 << (bits - 1)
    last, cells, out = half - 1, half * half, []
    for x in range(2 * half):
        for y in range(2 * half):
            a, b = x % half, y % half
            if y >= half:
                quadrant = 2 if x >= half else 1
            else:
                quadrant, (a, b) = (3, (last - b, last - a)) if x >= half else (0, (b, a))
            out.append(cells * quadrant + inner[a * half + b])
    return out


def along_known_curve(x: Column, y: Column, bits: int = BITS) -> Column:
    """:func:`along_curve` looked up in one array of all cells, for grids of a few thousand cells."""
    places = F.split(F.lit(",".join(map(str, _places(bits)))), ",").cast("array<bigint>")
    return F.get(places, (F.shiftleft(x.cast("int"), bits) + y.cast("int")))


def curve_place(df: DataFrame, columns: list[str], bits: int = BITS) -> Column:
    """Place of a row on the curve over some columns; null counts as before all values."""
    numbers = [F.coalesce(slot_of(F.col(c), cut_points(df, c, 1 << bits)), F.lit(0)) for c in columns]
    if len(numbers) != 2:
        return interleaved(numbers, bits)
    return along_known_curve(*numbers, bits) if bits <= BITS else along_curve(*numbers, bits)


def write_clustered(df: DataFrame, columns: list[str], files: int, path: str, bits: int = BITS) -> None:
    """About ``files`` files, each a stretch of the curve."""
    placed = df.withColumn("_place", curve_place(df, columns, bits))
    placed.repartitionByRange(files, "_place", *columns).sortWithinPartitions("_place", *columns).drop("_place").write.mode("overwrite").parquet(path)


def files_that_may_hold(df: DataFrame, column: str, low, high) -> DataFrame:
    """Files of a stored table whose minimum and maximum of a column meet a range, and all files."""
    per_file = df.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    return per_file.agg(F.count_if((F.col("lo") <= F.lit(high)) & (F.col("hi") >= F.lit(low))).alias("read"), F.count("*").alias("files"))
