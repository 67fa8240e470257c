"""Porter's stemmer (M. F. Porter, 1980) as columns of regular expressions.

A ``y`` that counts as a consonant is written ``Y`` while stemming, so that consonants and
vowels are plain character classes. A step looks for the longest of its endings, tests what
is in front of it and puts another ending there. Each step is one projection.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

C, V = "[^aeiouy]", "[aeiouy]"
M_ABOVE_0 = f"^{C}*{V}+{C}"
M_ABOVE_1 = f"^{C}*{V}+{C}+{V}+{C}"
M_IS_1 = f"^{C}*{V}+{C}+{V}*$"
HAS_VOWEL = V
SHORT_END = f"{C}{V}[^aeiouywxY]$"
DOUBLE_END = "(" + "|".join(c * 2 for c in "bcdfghjkmnpqrtvwx") + ")$"


@dataclass(frozen=True)
class Step:
    """Endings with what replaces them, and the condition on the letters before."""

    endings: dict[str, str]
    condition: str = ""

    @property
    def pattern(self) -> str:
        longest_first = sorted(self.endings, key=len, reverse=True)
        return "(" + "|".join(longest_first) + ")$"


def _pairs(text: str) -> dict[str, str]:
    return {old: new.strip("-") for old, new in (p.split(">") for p in text.split())}


# The endings of the algorithm as its author last published it.
STEP_1A = Step(_pairs("sses>ss ies>i ss>ss s>-"))
STEP_2 = Step(
    _pairs(
        "ational>ate tional>tion enci>ence anci>ance izer>ize bli>ble alli>al entli>ent eli>e "
        "ousli>ous ization>ize ation>ate ator>ate alism>al iveness>ive fulness>ful ousness>ous "
        "aliti>al iviti>ive biliti>ble logi>log"
    ),
    M_ABOVE_0,
)
STEP_3 = Step(
    _pairs("icate>ic ative>- alize>al iciti>ic ical>ic ful>- ness>-"), M_ABOVE_0
)
STEP_4 = Step(
    _pairs(
        "al>- ance>- ence>- er>- ic>- able>- ible>- ant>- ement>- ment>- ent>- ion>- ou>- ism>- "
        "ate>- iti>- ous>- ive>- ize>-"
    ),
    M_ABOVE_1,
)


def _front(word: Column, ending: Column) -> Column:
    return F.substring(word, F.lit(1), F.length(word) - F.length(ending))


def _apply(df: DataFrame, step: Step) -> DataFrame:
    df = df.withColumn("_end", F.regexp_extract("_w", step.pattern, 1))
    df = df.withColumn("_front", _front(F.col("_w"), F.col("_end")))
    replacement = F.lit("")
    for old, new in step.endings.items():
        if new:
            replacement = F.when(F.col("_end") == old, F.lit(new)).otherwise(replacement)
    fits = F.col("_end") != ""
    if step.condition:
        fits = fits & F.col("_front").rlike(step.condition)
    if "ion" in step.endings:
        fits = fits & ((F.col("_end") != "ion") | F.col("_front").rlike("[st]$"))
    return df.withColumn(
        "_w", F.when(fits, F.concat("_front", replacement)).otherwise(F.col("_w"))
    )


def _past_and_participle(df: DataFrame) -> DataFrame:
    """Step 1b: -eed, -ed and -ing, and the repair of what -ed and -ing leave."""
    w, front = F.col("_w"), F.col("_front")
    df = df.withColumn("_end", F.regexp_extract("_w", "(eed|ed|ing)$", 1))
    df = df.withColumn("_front", _front(w, F.col("_end")))
    cut = F.col("_end").isin("ed", "ing") & front.rlike(HAS_VOWEL)
    df = df.withColumn("_cut", cut).withColumn(
        "_w",
        F.when((F.col("_end") == "eed") & front.rlike(M_ABOVE_0), F.concat("_front", F.lit("ee")))
        .when(cut, front)
        .otherwise(w),
    )
    repaired = (
        F.when(w.rlike("(at|bl|iz)$"), F.concat(w, F.lit("e")))
        .when(w.rlike(DOUBLE_END), F.substring(w, F.lit(1), F.length(w) - 1))
        .when(w.rlike(M_IS_1) & w.rlike(SHORT_END), F.concat(w, F.lit("e")))
        .otherwise(w)
    )
    return df.withColumn("_w", F.when(F.col("_cut"), repaired).otherwise(w))


def _last_y(df: DataFrame) -> DataFrame:
    """Step 1c: a final y behind a vowel-bearing stem turns into i."""
    w = F.col("_w")
    front = F.substring(w, F.lit(1), F.length(w) - 1)
    hit = w.rlike("[yY]$") & front.rlike(HAS_VOWEL)
    return df.withColumn("_w", F.when(hit, F.concat(front, F.lit("i"))).otherwise(w))


def _last_e(df: DataFrame) -> DataFrame:
    """Step 5: a final e and a final double l."""
    w, front = F.col("_w"), F.col("_front")
    df = df.withColumn("_front", F.substring(w, F.lit(1), F.length(w) - 1))
    short = front.rlike(M_IS_1) & ~front.rlike(SHORT_END)
    df = df.withColumn(
        "_w",
        F.when(w.rlike("e$") & (front.rlike(M_ABOVE_1) | short), front).otherwise(w),
    )
    return df.withColumn(
        "_w",
        F.when(
            w.rlike("ll$") & w.rlike(M_ABOVE_1), F.substring(w, F.lit(1), F.length(w) - 1)
        ).otherwise(w),
    )


def with_stem(df: DataFrame, column: str, name: str) -> DataFrame:
    """Add the stem of a lower-case word; words of one or two letters are their own stem."""
    kept = df.columns
    marked = F.regexp_replace(F.col(column), "(^|[aeiou])y", "$1Y")
    work = df.withColumn("_w", marked)
    work = _apply(work, STEP_1A)
    work = _past_and_participle(work)
    work = _last_y(work)
    for step in (STEP_2, STEP_3, STEP_4):
        work = _apply(work, step)
    work = _last_e(work)
    stem = F.when(F.length(column) < 3, F.col(column)).otherwise(F.lower("_w"))
    return work.select(*kept, stem.alias(name))
