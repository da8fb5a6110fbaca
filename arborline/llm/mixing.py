"""Operator 4: mixing sources to target weights by Poisson replication, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborline.llm.common import checkpointed, fresh

#: Up to so many sources the rates are broadcast (at most 1.1 kB each besides the name); beyond, they are joined on salted keys.
BROADCAST_SOURCES = 10_000
SALTS = 64
#: A rate above this is dealt into equal parts that are drawn apart: a sum of Poisson numbers is Poisson, and no table of probabilities gets long.
MOST_RATE = 32.0


def hash_uniform(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) with 52 bits, from md5 of the seed and the parts; nulls are a part of their own."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("\\N")) for p in parts]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def poisson_cdf(rate: Column) -> Column:
    """P(X <= 0), P(X <= 1), ... for a rate of at most MOST_RATE, as far as a 52-bit number can tell; at most 130 of them."""
    most = F.ceil(rate + F.lit(12.0) * F.sqrt(rate) + F.lit(30.0)).cast("int")
    zero = F.exp(-rate)
    start = F.struct((-rate).alias("l"), F.array(zero).alias("c"))

    def step(acc: Column, k: Column) -> Column:
        log_p = acc["l"] + F.log(rate) - F.log(k.cast("double"))
        return F.struct(log_p.alias("l"), F.concat(acc["c"], F.array(F.element_at(acc["c"], -1) + F.exp(log_p))).alias("c"))

    grown = F.aggregate(F.sequence(F.lit(1), most), start, step, lambda acc: acc["c"])
    return F.when(rate > 0, grown).otherwise(F.array(F.lit(1.0)))


def source_rates(df: DataFrame, source: str, size: Column, weights: dict[str, float] | None, alpha: float) -> DataFrame:
    """(source, rate): how often a row of each source is repeated on average so that sizes meet the weights.

    The total size is kept. weights: by source, others get none; None: the source's own size to the power alpha.
    """
    own = checkpointed(df.groupBy(F.col(source).alias("s")).agg(F.coalesce(F.sum(size), F.lit(0)).cast("double").alias("n")))
    if weights is None:
        weight = F.pow("n", F.lit(alpha))
    else:
        weight = F.lit(0.0)
        for name, w in weights.items():
            weight = F.when(F.col("s") == name, F.lit(float(w))).otherwise(weight)
    own = own.withColumn("w", weight)
    total = own.agg(F.sum("n"), F.sum("w")).first()
    share = F.lit((total[0] or 0.0) / total[1]) if total[1] else F.lit(0.0)
    return own.select("s", F.coalesce(F.round(F.try_divide(F.col("w") * share, F.col("n")), 9), F.lit(0.0)).alias("rate"))


def mix(df: DataFrame, key: str, source: str, size: Column, weights: dict[str, float] | None = None, alpha: float = 0.5, seed: int = 17) -> DataFrame:
    """Repeat every row a Poisson number of times with its source's rate, and shuffle all rows.

    Adds copy (int from 0) and mix_key (hex; rows lie in hashed partitions, sorted by it, so ordering all rows by it gives
    one global shuffle). A row's number inverts the Poisson distribution at a hash of (seed, key): it is the same in any
    run and at any partitioning. size must be positive. Cases: null keys and null sources count as values; repeated rows
    with one key get the same number each; empty texts and very long ones matter by their size only, a null size counts as none; copies of
    rows with one key tie in mix_key and lie in any order; an empty table stays empty; input columns copy and mix_key are replaced.
    """
    df = df.drop("copy", "mix_key")
    parts = F.greatest(F.ceil(F.col("rate") / F.lit(MOST_RATE)), F.lit(1)).cast("int")
    rates = checkpointed(source_rates(df, source, size, weights, alpha).select("s", parts.alias("parts"), poisson_cdf(F.col("rate") / parts).alias("cdf")))
    s, cdf, salt, each_part = fresh(df, "s"), fresh(df, "cdf"), fresh(df, "salt"), fresh(df, "parts")
    rates = rates.select(F.col("s").alias(s), F.col("cdf").alias(cdf), F.col("parts").alias(each_part))
    if rates.count() <= BROADCAST_SOURCES:
        joined = df.join(F.broadcast(rates), df[source].eqNullSafe(rates[s]))
    else:
        salted = df.withColumn(salt, F.pmod(F.xxhash64(F.col(key)), F.lit(SALTS)))
        each = rates.withColumn(salt, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        joined = salted.join(each, salted[source].eqNullSafe(each[s]) & (salted[salt] == each[salt])).drop(salted[salt]).drop(each[salt])
    drawn = lambda u: F.size(F.filter(F.col(cdf), lambda c: c <= u))
    numbers = F.transform(F.sequence(F.lit(1), F.col(each_part) - F.lit(1)), lambda i: drawn(hash_uniform(seed, F.col(key), i)))
    first = drawn(hash_uniform(seed, F.col(key)))
    times = F.when(F.col(each_part) > 1, first + F.aggregate(numbers, F.lit(0), lambda a, n: a + n)).otherwise(first)
    copies = joined.withColumn("copy", F.explode(F.when(times > 0, F.sequence(F.lit(0), times - 1)).otherwise(F.array().cast("array<int>"))))
    mixed = copies.withColumn("mix_key", F.md5(F.concat_ws("|", F.lit(f"{seed}-order"), F.coalesce(F.col(key).cast("string"), F.lit("\\N")), F.col("copy")))).drop(s, cdf, each_part)
    return mixed.repartition(F.col("mix_key")).sortWithinPartitions("mix_key")
