"""Operator 11: fill-in-middle transformation, in column expressions only.

A text is cut into units by one regular expression; the hash of a seed and the key gives two cuts, whether the text is transformed at all, and the
order of its parts. The parts stand behind sentinels, so a transformed text is its own record: parsing the sentinels gives the text back.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborline.llm.common import fresh

#: A unit: white space with the word after it, or white space at the end. Java and RE2 read it alike.
UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
PLAIN, PSM, SPM = "plain", "psm", "spm"
OUTPUTS = ("n", "form", "output", "prefix_chars", "middle_chars")


@dataclass(frozen=True)
class Sentinels:
    """What stands before each part. None may be part of another, and no end of one may begin another: then text around them makes no further ones."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self) -> None:
        every = (self.prefix, self.suffix, self.middle)
        for a in every:
            for b in every:
                if not a or (a is not b and a in b) or any(a.endswith(b[:k]) for k in range(1, len(b))):
                    raise ValueError(f"sentinels {a!r} and {b!r} can't be told apart")

    def within(self, text: Column) -> Column:
        return text.contains(self.prefix) | text.contains(self.suffix) | text.contains(self.middle)


def _draw(digest: Column, k: int) -> Column:
    """The k-th group of 8 hex digits as an unsigned number."""
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")


def _behind(text: Column, mark: str) -> Column:
    """What follows the first occurrence of mark, which is there."""
    return F.substr(text, F.locate(mark, text) + F.lit(len(mark)))


def restored(output: Column, form: Column, marks: Sentinels = Sentinels()) -> Column:
    """The text that an output of this form was made of, by its sentinels alone; null for a null or unknown form."""
    before = lambda text, mark: F.substring_index(text, mark, 1)
    psm = _behind(output, marks.prefix)
    psm = F.concat(before(psm, marks.suffix), _behind(psm, marks.middle), before(_behind(psm, marks.suffix), marks.middle))
    spm = _behind(output, marks.suffix)
    spm = F.concat(before(_behind(spm, marks.prefix), marks.middle), _behind(spm, marks.middle), before(spm, marks.prefix))
    return F.when(form == PLAIN, output).when(form == PSM, psm).when(form == SPM, spm)


def fill_in_middle(df: DataFrame, key: str, text: str, seed: int = 42, rate: int = 50, spm_rate: int = 80, marks: Sentinels = Sentinels()) -> DataFrame:
    """Add n (units), form (plain, psm or spm), output, and prefix_chars and middle_chars (code points; null if plain) to df.

    rate: the percentage of texts to transform; spm_rate: how many of them, in percent, put the suffix first. The draws depend on seed and key only. No row
    moves. Cases: a null text counts as empty, and is plain; so is any text that holds a sentinel, which could not be parsed back; a null key draws as an empty
    one; rows that share a key draw alike; texts of any length are taken whole; an empty table stays empty; other columns are carried, those with
    the outputs' names replaced unless they are the key or the text.
    """
    taken = {c.lower() for c in OUTPUTS} & {key.lower(), text.lower()}
    if taken:
        raise ValueError(f"rename {sorted(taken)} first: the result has columns of these names")
    df = df.drop(*OUTPUTS)
    whole, units, digest, low, high = (fresh(df, c) for c in ("whole", "units", "digest", "low", "high"))
    out = df.withColumns({whole: F.coalesce(F.col(text), F.lit("")), digest: F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)})
    out = out.withColumn(units, F.regexp_extract_all(whole, F.lit(UNIT), F.lit(0))).withColumn("n", F.size(units).cast("long"))
    cut = lambda k: F.pmod(_draw(F.col(digest), k), F.col("n") + F.lit(1))
    form = F.when((F.col(whole) == "") | marks.within(F.col(whole)) | (F.pmod(_draw(F.col(digest), 2), F.lit(100)) >= rate), PLAIN)
    form = form.when(F.pmod(_draw(F.col(digest), 3), F.lit(100)) < spm_rate, SPM).otherwise(PSM)
    out = out.withColumns({low: F.least(cut(0), cut(1)).cast("int"), high: F.greatest(cut(0), cut(1)).cast("int"), "form": form})
    part = lambda a, b: F.array_join(F.slice(units, a + F.lit(1), b - a), "")
    prefix, middle, suffix = fresh(out, "prefix"), fresh(out, "middle"), fresh(out, "suffix")
    size = F.col("n").cast("int")
    out = out.withColumns({prefix: part(F.lit(0), F.col(low)), middle: part(F.col(low), F.col(high)), suffix: part(F.col(high), size)})
    p, m, s = F.lit(marks.prefix), F.lit(marks.middle), F.lit(marks.suffix)
    made = F.when(F.col("form") == PLAIN, F.col(whole)).when(F.col("form") == PSM, F.concat(p, prefix, s, suffix, m, middle)).otherwise(F.concat(s, suffix, p, prefix, m, middle))
    moved = F.col("form") != PLAIN
    return out.withColumns({
        "output": made, "prefix_chars": F.when(moved, F.char_length(prefix).cast("long")), "middle_chars": F.when(moved, F.char_length(middle).cast("long")),
    }).drop(whole, units, digest, low, high, prefix, middle, suffix)
