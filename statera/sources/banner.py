"""Delimited tables with a banner line above the header."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statera.functions.cleaning import none_if_token
from statera.sources.files import CSV_OPTIONS


def read_banner_table(
    spark: SparkSession, path: str, sep: str = ",", multiline: bool = False
) -> DataFrame:
    """All-string table whose header is line 2; empty rows and empty columns go.

    Several files must share banner and header.
    """
    banner, header = [row.value for row in spark.read.text(path).limit(2).collect()]
    # Two lines, each cut into its cells.
    banner_cells, header_cells = csv.reader([banner, header], delimiter=sep)
    width = len(header_cells)
    slots = [f"_c{i}" for i in range(width)]
    cells = (
        spark.read.schema(", ".join(f"{slot} string" for slot in slots))
        .options(**CSV_OPTIONS, sep=sep, header=False, multiLine=multiline)
        .csv(path)
    )

    def equals(line: list[str]):
        padded = (line + [""] * width)[:width]
        same = F.col("_metadata.file_block_start") == 0
        for slot, cell in zip(slots, padded):
            same = same & (F.coalesce(F.col(slot), F.lit("")) == cell)
        return same

    # A data row may look like one of the two lines, so only one such row of a file goes.
    line = F.when(equals(header_cells), 1).when(equals(banner_cells), 0)
    marked = cells.withColumns({"__line": line, "__file": F.col("_metadata.file_path")})
    of_line = Window.partitionBy("__file", "__line").orderBy("__line")
    lines = 2 if banner_cells == header_cells else 1
    look_alikes = marked.filter("__line is not null").withColumn(
        "__n", F.row_number().over(of_line)
    )
    data = marked.filter("__line is null").select(*slots)
    data = data.unionByName(look_alikes.filter(F.col("__n") > lines).select(*slots))
    body = data.select(
        *[
            none_if_token(F.col(slot)).alias(name.strip().lower() or f"unnamed_{i}")
            for i, (slot, name) in enumerate(zip(slots, header_cells))
        ]
    )
    body = body.dropna(how="all")
    filled = body.agg(*[F.count(F.col(f"`{name}`")).alias(name) for name in body.columns]).first()
    return body.select(*[F.col(f"`{name}`") for name in body.columns if filled[name] > 0])
