"""Groups of any size as pairs of bounded chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekpanel.session import cut_lineage


def chunk_pairs(rows: DataFrame, key: list[str], node: str, left: str, chunk: int) -> DataFrame:
    """``rows`` with columns i, j, is_left, is_right: within each (key, i, j) the
    left rows have to meet the right rows.

    Groups of up to ``chunk`` rows stay one, with i = j = 0. In a larger group left rows are dealt by
    the hash of ``node`` into chunks i and right rows into chunks j of about that size, and every
    left chunk meets every right chunk in a group of its own; few left rows cost few copies of the right ones. ``left`` names the
    column of rows that stand on the left; all rows stand on the right. Each (left, right) pair of rows meets exactly once."""
    columns = rows.columns
    large = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("c"), F.count_if(F.col(left)).alias("l")).where(F.col("c") > chunk)
    chunks = lambda n: F.greatest(F.ceil(F.col(n) / chunk), F.lit(1)).cast("int")
    large = cut_lineage(large.select(*key, chunks("l").alias("k_left"), chunks("c").alias("k_right")), "large")
    whole = rows.withColumns({"i": F.lit(0), "j": F.lit(0), "is_left": F.col(left), "is_right": F.lit(True)})
    if large.isEmpty():
        return whole
    own = lambda k: F.pmod(F.xxhash64(node, F.lit(7)), F.col(k)).cast("int")
    cut = rows.join(large, key).withColumns({"own_left": own("k_left"), "own_right": own("k_right")})
    as_left = F.when(F.col(left), F.transform(F.sequence(F.lit(0), F.col("k_right") - 1), lambda o: F.struct(
        F.col("own_left").alias("i"), o.alias("j"), F.lit(True).alias("is_left"), (o == F.col("own_right")).alias("is_right"))))
    rest = F.filter(F.sequence(F.lit(0), F.col("k_left") - 1), lambda o: (o != F.col("own_left")) | ~F.col(left))
    as_right = F.transform(rest, lambda o: F.struct(o.alias("i"), F.col("own_right").alias("j"), F.lit(False).alias("is_left"), F.lit(True).alias("is_right")))
    none = F.array().cast("array<struct<i:int,j:int,is_left:boolean,is_right:boolean>>")
    cut = cut.withColumn("p", F.explode(F.concat(F.coalesce(as_left, none), as_right)))
    small = whole.join(large.select(*key), key, "left_anti").select(*columns, "i", "j", "is_left", "is_right")
    return small.unionByName(cut.select(*columns, "p.i", "p.j", "p.is_left", "p.is_right"))
