"""Operator 1: sharding by jump consistent hashing (Lamping and Veach, 2014), with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborline.llm.common import gapless_rank

#: The generator of the published method: state <- state * MULTIPLIER + 1, modulo 2^64.
MULTIPLIER = 2862933555777941757
LOW = 0xFFFFFFFF


def _low32(a: Column, m: int) -> Column:
    """The low 32 bits of a * m for 0 <= a, m < 2^32, without leaving 64 signed bits (ANSI mode forbids wrapping)."""
    return (a * F.lit(m & 0xFFFF) + F.shiftleft((a * F.lit(m >> 16)).bitwiseAND(F.lit(0xFFFF)), 16)).bitwiseAND(F.lit(LOW))


def next_state(state: Column) -> Column:
    """state * MULTIPLIER + 1 modulo 2^64, on a signed long."""
    low, high = state.bitwiseAND(F.lit(LOW)), F.shiftrightunsigned(state, 32)
    m_low, m_high = MULTIPLIER & LOW, MULTIPLIER >> 32
    top = low * F.lit(m_low >> 16)
    first = low * F.lit(m_low & 0xFFFF) + F.shiftleft(top.bitwiseAND(F.lit(0xFFFF)), 16)
    one_more = first.bitwiseAND(F.lit(LOW)) + F.lit(1)
    carry = F.shiftright(first, 32) + F.shiftright(top, 16) + F.shiftright(one_more, 32)
    upper = (carry + _low32(high, m_low) + _low32(low, m_high)).bitwiseAND(F.lit(LOW))
    return F.shiftleft(upper, 32).bitwiseOR(one_more.bitwiseAND(F.lit(LOW)))


def key_of(df: DataFrame, column: str) -> Column:
    """The 64-bit key of a row: an integer itself, anything else by xxhash64; null is 0."""
    whole = dict(df.dtypes)[column] in ("tinyint", "smallint", "int", "bigint")
    return F.coalesce(F.col(column).cast("long") if whole else F.xxhash64(F.col(column)), F.lit(0).cast("long"))


def jump_shard(key: Column, shards: int, most_jumps: int = 128) -> Column:
    """The shard of a 64-bit key: its last jump below the number of shards.

    A key's jumps are one fixed rising sequence, so another shard takes rows only into itself. A key makes about
    ln(shards) jumps; the sequence ends after ``most_jumps``, the same for every number of shards.
    """
    start = F.struct(F.lit(0).cast("long").alias("b"), F.lit(0).cast("long").alias("j"), key.cast("long").alias("s"))

    def jump(acc: Column, _: Column) -> Column:
        s = next_state(acc["s"])
        ahead = ((acc["j"] + F.lit(1)).cast("double") * (F.lit(float(1 << 31)) / (F.shiftrightunsigned(s, 33) + F.lit(1)).cast("double"))).cast("long")
        return F.when(acc["j"] < F.lit(shards), F.struct(acc["j"].alias("b"), ahead.alias("j"), s.alias("s"))).otherwise(acc)

    return F.aggregate(F.sequence(F.lit(1), F.lit(min(shards, most_jumps))), start, jump, lambda acc: acc["b"].cast("int"))


#: Parts into which rows of one key are dealt for ranking.
SPREAD = 16


def shard(df: DataFrame, key: str, shards: int, spread: Column | None = None, buckets: int = 256) -> DataFrame:
    """Add shard, grown_shard (with one shard more) and slot (gapless from 0 in each shard) to df.

    spread: a whole number that tells rows of one key apart, such as a checksum; by default a hash of the whole row. Each shard's rows are ranked in
    ``buckets`` (a power of two up to 2^20) parts by key times SPREAD by spread, so that a key with many rows isn't one task's;
    numbers of rows by shard and part are broadcast.

    Cases: a null key counts as 0, a null spread too; equal keys share a shard and get slots of their own; rows equal in key and spread tie
    and get slots in any order; texts matter neither empty nor long; an empty table stays empty; no column but
    ``key`` decides the shard, and input columns with the names of the three outputs are replaced.
    """
    df = df.drop("shard", "grown_shard", "slot")
    k = key_of(df, key)
    placed = df.withColumns({"shard": jump_shard(k, shards), "grown_shard": jump_shard(k, shards + 1)})
    apart = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]) if spread is None else F.coalesce(spread.cast("long"), F.lit(0).cast("long"))
    part = F.shiftrightunsigned(next_state(k), 64 - (buckets.bit_length() - 1)).cast("int") * F.lit(SPREAD) + F.pmod(apart, F.lit(SPREAD)).cast("int")
    return gapless_rank(placed, ["shard"], part, [F.col(key)], "slot")
