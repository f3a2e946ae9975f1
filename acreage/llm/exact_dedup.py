"""Exact deduplication by a tree-merge of digest runs, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreage.llm.scratch import stage

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else. Texts of ASCII alone take the short way."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def digests(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, salt, sha, chk, size): two independent digests and the length of each normalised text; salt deals rows out evenly."""
    norm = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    return docs.select(
        F.col(id_col).cast("long").alias("id"), F.xxhash64(F.monotonically_increasing_id()).alias("salt"),
        F.unhex(F.sha2(norm, 256)).alias("sha"), F.xxhash64(norm).alias("chk"), F.octet_length(norm).alias("size"),
    )


def merged(rows: DataFrame) -> DataFrame:
    """One sorted run for each slot: (slot, sha, top, n) of rows (slot, sha, top, n), each digest once.

    top is (id, chk, size) of the row that stays; equal digests whose second hash or length differ raise an error. A
    struct has no place in a hash aggregate's buffer, so Spark sorts each run by digest and merges neighbours.
    """
    proof = F.struct("top.chk", "top.size")
    out = rows.groupBy("slot", "sha").agg(
        F.max("top").alias("top"), F.sum("n").alias("n"), F.min(proof).alias("low"), F.max(proof).alias("high")
    )
    same = F.col("low") == F.col("high")
    return out.select(
        "slot", "sha",
        F.when(same, F.col("top")).otherwise(F.raise_error(F.lit("two texts have the same SHA-256"))).alias("top"), "n"
    )


def tree_merge(runs: DataFrame, slots: int, fan_in: int) -> DataFrame:
    """(sha, top, n): the sorted runs of all slots merged in rounds, fan_in neighbours into one, until one run is left.

    In each round the runs of a group of slots go to one owner for each digest, already merged in the tasks that send
    them. The single last run is one logical run: it is dealt by digest over all partitions, never gathered in one task.
    """
    while slots > 1:
        slots = -(-slots // fan_in)
        runs = merged(runs.withColumn("slot", F.floor(F.col("slot") / fan_in).cast("int")))
    return runs.drop("slot")


def slots_for(rows: int) -> int:
    """So many runs that none has more than some 2**18 rows: what a task reads of a text that very many rows share."""
    return 1 << max(6, (rows >> 18).bit_length())


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, slots: int | None = None, fan_in: int = 4
) -> DataFrame:
    """One row for each row of docs: (id, keep_id, group_size, kept, text_sha256).

    Texts are equal when identical after lower-casing A-Z. The row with the largest id of equal texts stays. Equality is
    held by SHA-256 and verified by a second hash and the length in every round of the merge; a mismatch raises an error.
    Null texts count as empty. A null id loses to any other; where all ids of a group are null, keep_id is null and kept
    is true for each. Rows that repeat an id and a text are alike, so each of them is kept. An empty table gives no rows;
    other columns are ignored.

    Rows are dealt to slots at random, as many as slots_for says, so a text shared by a third of all rows is spread over
    all of them, and the way back goes down the same tree: first to (slot, digest), then to rows. No task holds the rows
    of a whole group.
    """
    held = stage(digests(docs, id_col, text_col), "digests")
    slots = slots or slots_for(held.count())
    rows = held.withColumn("slot", F.pmod("salt", F.lit(slots)).cast("int"))
    runs = merged(rows.select("slot", "sha", F.struct("id", "chk", "size").alias("top"), F.lit(1).cast("long").alias("n")))
    best = tree_merge(runs, slots, fan_in).select("sha", F.col("top.id").alias("keep_id"), F.col("n").alias("group_size"))
    by_slot = rows.select("slot", "sha").distinct().join(best, "sha")
    return rows.join(by_slot, ["slot", "sha"]).select(
        F.col("id").alias(id_col), "keep_id", "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
