"""Exact deduplication in DataFrame functions alone (operator 13).

Texts are equal when they are the same after blanks are deleted. Rows are grouped by a 128-bit hash of that content, kept as
narrow rows; of a group the row with the longest original stays, on a tie that of smallest id. Texts that share a hash are
then compared byte by byte: they are grouped by hash and content, combined on the map side, so that a text that a third of
the rows repeat is shuffled once a task. A hash found with two contents is taken apart by content; its rows
never share a group.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import attach
from .common import stored, texts_of

BLANKS = " \t\n\x0b\x0c\r"
# Hashes of repeated texts are sent to every task up to this many; beyond it all texts are grouped.
MOST_SENT = 250_000


def normalised(text: Column) -> Column:
    """The text without blanks; a missing one is empty."""
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, "")


def content_hash(content: Column) -> tuple[Column, Column]:
    """128 bits of a text."""
    return F.xxhash64(content), F.xxhash64(F.lit("again"), content)


def _groups(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Size of each group, and place and id of the row that stays."""
    first = F.min(F.struct((-F.col("length")).alias("shorter"), F.isnull("doc_id").alias("unnamed"), "doc_id", "place"))
    made = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("group_size"), first.alias("first"))
    return made.select(*keys, "group_size", F.col("first.doc_id").alias("keep_id"), F.col("first.place").alias("keep_place"))


def duplicates(
    docs: DataFrame, hashed: Callable[[Column], tuple[Column, Column]] = content_hash, most_sent: int = MOST_SENT,
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row of (doc_id, text).

    Missing texts are empty. Rows without id are rows like others and stay only where no row of the same length has an id (keep_id is
    missing then). Of wholly repeated rows one is kept. An empty table gives no rows; other columns are ignored.
    """
    texts = texts_of(docs).select("doc_id", F.char_length(F.coalesce("text", F.lit(""))).alias("length"),
                                  normalised(F.col("text")).alias("content"))
    h1, h2 = hashed(F.col("content"))
    texts = texts.withColumns({"h1": h1, "h2": h2})
    # Places are given while this table is written and are fixed from then on.
    rows = stored(texts.select("doc_id", "length", "h1", "h2", F.unhex(F.sha2("content", 256)).alias("sha"),
                               F.monotonically_increasing_id().alias("place")), "hashed")
    groups = stored(_groups(rows, ["h1", "h2"]), "groups")
    repeated = groups.filter("group_size > 1").select("h1", "h2")
    contents = texts.select("h1", "h2", "content")
    if repeated.limit(most_sent + 1).count() <= most_sent:
        contents = contents.join(F.broadcast(repeated), ["h1", "h2"], "left_semi")
    clashes = stored(contents.distinct().groupBy("h1", "h2").count().filter("count > 1").select("h1", "h2"), "clashes")
    if clashes.isEmpty():
        return _decided(rows, groups, ["h1", "h2"])
    sure = _decided(rows.join(clashes, ["h1", "h2"], "left_anti"), groups, ["h1", "h2"])
    told_apart = stored(texts.join(clashes, ["h1", "h2"], "left_semi").withColumns({
        "sha": F.unhex(F.sha2("content", 256)), "place": F.monotonically_increasing_id()}), "clashing")
    keys = ["h1", "h2", "content"]
    return sure.unionByName(_decided(told_apart, stored(_groups(told_apart, keys), "contents"), keys))


def _decided(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with their group's; the null-safe join shuffles both sides, so a hot group is split."""
    joined = attach(rows, groups, keys, "inner")
    return joined.select("doc_id", "keep_id", "group_size", (F.col("place") == F.col("keep_place")).alias("kept"),
                         F.lower(F.hex("sha")).alias("text_sha256"))


def without_duplicates(docs: DataFrame) -> DataFrame:
    """Documents whose row stays: (doc_id, text_sha256), one row a text."""
    return duplicates(docs).filter("kept").select("doc_id", "text_sha256")
