"""Jobs done in pieces, so that the shuffle files of one piece go before the next writes its own."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import col
from ..session import drop_folder, release, working_path

# Lines of a piece, and the most pieces: each one scans the tables anew.
LINES = 1 << 22
MOST = 16
PIECE = "__piece"


@dataclass(frozen=True)
class Piece:
    """Orders whose number hashes to ``number`` of ``of``; a missing number has its place as well."""

    number: int
    of: int


def pieces_of(lines: DataFrame, size: int | None = None) -> list[Piece | None]:
    """Pieces to do a table of lines in; one, None, where it is small. The lines are counted, which stored tables know."""
    n = min(MOST, -(-lines.count() // (size or LINES)))
    return [Piece(i, n) for i in range(n)] if n > 1 else [None]


def _place(order: Column | str, of: int) -> Column:
    return F.pmod(F.xxhash64(col(order).cast("bigint")), F.lit(of)).cast("int")


def in_piece(df: DataFrame, order: Column | str, piece: Piece | None) -> DataFrame:
    """Rows of the piece's orders; all rows without a piece. Every row is in one piece, and rows of one order are in the same."""
    if piece is None:
        return df
    if PIECE in df.columns:
        return df.filter(F.col(PIECE) == piece.number).drop(PIECE)
    return df.filter(_place(order, piece.of) == piece.number)


def in_turn(
    src: Mapping[str, DataFrame], orders: Mapping[str, Column | str], pieces: list[Piece | None]
) -> Iterator[tuple[Mapping[str, DataFrame], Piece | None]]:
    """Each piece with the tables to make it from, once what the one before it shuffled is off the disk.

    ``orders`` names the line tables and their order numbers. Several pieces have these dealt into a folder a piece first, so that
    none of them reads the others' rows; the folder goes with its piece.
    """
    if len(pieces) == 1:
        yield src, pieces[0]
        return
    tables, paths = _Over(src), []
    for name, order in orders.items():
        df = src[name]
        spark, path = df.sparkSession, working_path(df.sparkSession, f"{name}_pieces")
        release(spark)
        placed = df.withColumn(PIECE, _place(order, len(pieces)))
        placed.write.partitionBy(PIECE).option("compression", "zstd").parquet(path)
        tables[name] = spark.read.schema(placed.schema).parquet(path)
        paths.append(path)
    for piece in pieces:
        release(spark)
        yield tables, piece
        for path in paths:
            drop_folder(spark, f"{path}/{PIECE}={piece.number}")


class _Over(dict):
    """Some tables in place of those of the same name."""

    def __init__(self, src: Mapping[str, DataFrame]):
        super().__init__()
        self.src = src

    def __missing__(self, name: str) -> DataFrame:
        return self.src[name]


def gathered(frames: Iterable[DataFrame], name: str) -> DataFrame:
    """Write frames of one schema one after the other below the shared folder and read them back as one."""
    frame, path = None, None
    for frame in frames:
        path = path or working_path(frame.sparkSession, name)
        frame.write.mode("append").option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
