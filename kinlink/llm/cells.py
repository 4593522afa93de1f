"""Comparison of what is left of a group in cells of bounded size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kinlink.llm.store import written


def cell_rows(rows: DataFrame, i: Column, j: Column, kind: int, label: Column, payload: str) -> DataFrame:
    """(cell, query, id, label, payload): rows of one side of cell (grp, i, j). kind: 0 index, 1 query, 2 both."""
    key = F.struct(F.col("grp"), i.alias("i"), j.alias("j")).cast("struct<grp:bigint,i:int,j:int>")
    return rows.select(key.alias("cell"), F.lit(kind).alias("query"), "id", label.alias("label"), payload)


def minority_cells(labelled: DataFrame, payload: str, block: int) -> DataFrame:
    """Cells that bring each row together with all rows of its group that have other labels.

    labelled has grp, id, label and the payload. Rows outside the commonest label of their group are queries, dealt
    into blocks of about `block` rows; each block meets every block of the group's rows. Rows of the commonest label
    are not compared with each other, and groups of one label make no cells.
    """
    main = (labelled.groupBy("grp", "label").agg(F.count("*").alias("n")).groupBy("grp")
            .agg(F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("m")).where("top.n < m")
            .select("grp", F.col("top.label").alias("main"), F.ceil(F.col("m") / block).cast("int").alias("blocks"),
                    F.ceil((F.col("m") - F.col("top.n")) / block).cast("int").alias("query_blocks")))
    rows = written(labelled.select("grp", "id", "label", payload).join(main, "grp")
                   .withColumn("block", F.expr("cast(pmod(xxhash64(id), blocks) AS int)")), "labelled")
    each = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    queries = (rows.where("label != main").withColumn("own", F.expr("cast(pmod(xxhash64(id, 2), query_blocks) AS int)"))
               .withColumn("each", each("blocks")))
    index = rows.withColumn("each", each("query_blocks"))
    label = F.col("label")
    return (cell_rows(queries, F.col("own"), F.col("each"), 1, label, payload)
            .union(cell_rows(index, F.col("each"), F.col("block"), 0, label, payload)))
