"""Quality rules whose cutoffs are certified on labelled holdouts.

A rule rejects a document when one of its measures lies above a cutoff. The labelled documents
of a stratum are split by a hash of their id. On the smaller part each rule gets the cutoff of a
fixed grid that rejects most bad documents beyond the good ones, among those that reject at most
a share ``risk / rules`` of good ones; rules without one are off, the others are put in order
of that gain. The larger part, the holdout, *certifies* them together, in that order: the first
``j`` rules are on if the exact binomial probability of at most as many good holdout documents
rejected by any of them as were found, under a share ``risk``, does not exceed ``doubt`` divided by
the number of strata tested (Bonferroni). Within a stratum the tests are a fixed sequence, set
before the holdout is looked at, that ends at its first failure, so they need no correction
among themselves. So with probability ``1 - doubt`` the rules reject at most a share ``risk`` of
the good documents in every stratum. A stratum with too few labels has no rules.

Everything is DataFrame expressions. A text is measured inside its row, by sorting its
windows, so texts are never shuffled; only measures (a few numbers per document) are stored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphfeed.lineage import stored
from graphfeed.llm.common import words

MIN_WORDS = 50
REPEAT_PERCENT = 50
RISK = 0.05
DOUBT = 0.05
CHOOSING = 2  # fifths of the labels that choose cutoffs; the others are the holdout

# For each rule the cutoffs that are tested, mildest last.
CUTOFFS = {
    "symbols_per_word": [0.1, 0.2, 0.3, 0.5, 0.7, 0.9, 1.5],
    "dup_line_share": [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.8],
    "repeat_word_share": [0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.45],
    "chars_per_word": [6.0, 7.0, 8.0, 9.0, 10.0, 12.0, 15.0],
    "short_words": [0.25, 0.3, 0.35, 0.4, 0.45, 0.5, 0.6],
}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_MEASURED = ["_n_lines", "_n_short"]


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda a, x: a + x)


def text_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` without the text, with the five counts and two that only rules use.

    Null and empty texts count 0 throughout. A column of ``df`` named like a count is replaced.
    """
    given = [c for c in df.columns if c != text and c not in COUNTS]
    body = F.coalesce(F.col(text), F.lit(""))
    step = df.select(
        *given,
        words(body).alias("_words"),
        F.filter(F.split(body, "\n", -1), lambda x: x.rlike(r"[^ \t-\r]")).alias("_lines"),
        (F.length(body) - F.length(F.regexp_replace(body, r"[#*$%&|<>]+", "")))
        .cast("long").alias("n_symbols"),
    )
    # hash and place of every window of three words
    window = F.transform("_words", lambda w, i: F.struct(
        F.xxhash64(w, F.get("_words", i + 1), F.get("_words", i + 2)).alias("h"), i.alias("at")))
    step = step.select(
        *given, "n_symbols",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_lines").cast("long").alias("_n_lines"),
        F.size(F.filter("_words", lambda w: F.length(w) <= 2)).cast("long").alias("_n_short"),
        F.sort_array(F.slice(window, 1, F.greatest(F.size("_words") - 2, F.lit(0))))
        .alias("_windows"),
    )
    # windows with an equal neighbour in hash order, back in text order
    twice = F.filter("_windows", lambda x, i: (x.h == F.get("_windows", i + 1).h)
                     | (x.h == F.get("_windows", i - 1).h))
    step = step.withColumn("_at", F.sort_array(F.transform(twice, lambda x: x.at)))
    covered = F.transform("_at", lambda p, i: F.least(
        F.lit(3), F.coalesce(F.get("_at", i + 1) - p, F.lit(3))).cast("long"))
    return step.select(*given, *COUNTS[:-1], _total(covered).alias("n_repeat_words"), *_MEASURED)


def measures() -> dict[str, Column]:
    """What each rule looks at, from the columns of ``text_counts``."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "symbols_per_word": F.col("n_symbols") / n,
        "dup_line_share": F.col("n_dup_lines") / F.greatest(F.col("_n_lines"), F.lit(1)),
        "repeat_word_share": F.col("n_repeat_words") / n,
        "chars_per_word": F.col("word_chars") / n,
        "short_words": F.col("_n_short") / n,
    }


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def binomial_at_most(k: Column, n: Column, share: float) -> Column:
    """P(X <= k) for X of n trials with chance ``share``, summed exactly in logarithms."""
    odds = F.log(F.lit(share / (1 - share)))
    start = F.struct((n * F.log(F.lit(1 - share))).alias("term"), F.lit(0.0).alias("sum"))

    def add(acc: Column, i: Column) -> Column:
        more = F.log(F.greatest(n - i, F.lit(0.5)) / (i + 1)) + odds
        return F.struct((acc.term + more).alias("term"),
                        (acc["sum"] + F.exp(acc.term)).alias("sum"))

    return F.aggregate(F.sequence(F.lit(0), k.cast("int")), start, add, lambda acc: acc["sum"])


def certified_cutoffs(
    labelled: DataFrame, risk: float = RISK, doubt: float = DOUBT,
    cutoffs: dict[str, list[float]] | None = None,
) -> DataFrame:
    """(stratum, rule, cutoff, place, n_good, false_rejects) of the rules switched on.

    ``labelled`` has ``stratum``, ``good`` (boolean; rows without it are left out), ``holdout``
    (boolean) and the counts of ``text_counts``. ``n_good`` are the good documents of the holdout and
    ``false_rejects`` those of them that a rule up to this ``place`` rejects. At most strata x
    rules rows.
    """
    cutoffs = cutoffs or CUTOFFS
    grid = {rule: F.array(*[F.lit(float(c)) for c in values]) for rule, values in cutoffs.items()}
    what = measures()

    def passed(rule: str) -> Column:
        return F.size(F.filter(grid[rule], lambda c: what[rule] > c))

    level = [F.struct(F.lit(rule).alias("rule"), grid[rule].alias("cutoffs"),
                      passed(rule).alias("level")) for rule in cutoffs]
    # how many cutoffs, mildest last and so in ascending order, each document lies above
    counted = (
        labelled.filter(F.col("good").isNotNull() & ~F.col("holdout"))
        .select("stratum", "good", F.inline(F.array(*level)))
        .groupBy("stratum", "rule", "cutoffs", "level")
        .agg(F.sum(F.col("good").cast("long")).alias("good"),
             F.sum((~F.col("good")).cast("long")).alias("bad"))
    )
    # bounded from here on by strata x rules x cutoffs
    tested = (
        counted
        .select("stratum", "rule", "good", "bad", "level", F.posexplode("cutoffs"))
        .groupBy("stratum", "rule", F.col("col").alias("cutoff"))
        .agg(F.sum("good").alias("n_good"),
             F.sum(F.when(F.col("level") > F.col("pos"), F.col("good")).otherwise(0))
             .alias("false_rejects"),
             F.sum(F.when(F.col("level") > F.col("pos"), F.col("bad")).otherwise(0))
             .alias("bad_rejects"))
    )
    gain = F.col("bad_rejects") - F.col("false_rejects")
    best = F.max_by(F.struct("cutoff", gain.alias("gain")), F.struct(gain, "cutoff"))
    order = Window.partitionBy("stratum").orderBy(F.desc("gain"), "rule")
    # every stratum has a first place, and no place has more strata than the first
    strata = F.max("_strata").over(Window.partitionBy("stratum"))
    chosen = stored(
        tested.filter((gain > 0) & (F.col("false_rejects") <= F.col("n_good") * (risk / len(cutoffs))))
        .groupBy("stratum", "rule").agg(best.alias("_best")).select("stratum", "rule", "_best.*")
        .withColumn("place", F.row_number().over(order))
        .withColumn("_strata", F.count(F.lit(1)).over(Window.partitionBy("place")))
        .withColumn("_strata", strata), "chosen-cutoffs")

    # the first place of each good document of the holdout at which a rule rejects it
    by_stratum = chosen.groupBy(F.col("stratum").alias("_stratum")).agg(F.map_from_entries(
        F.collect_list(F.struct("rule", F.struct("cutoff", "place")))).alias("_rules"))
    rule_of = {rule: F.element_at(F.col("_rules"), rule) for rule in cutoffs}
    places = F.array_min(F.array(*[
        F.when(what[rule] > rule_of[rule].cutoff, rule_of[rule].place) for rule in cutoffs]))
    firsts = (
        labelled.filter(F.col("good") & F.col("holdout"))
        .join(by_stratum, F.col("stratum").eqNullSafe(F.col("_stratum")))
        .groupBy("_stratum", places.alias("first")).agg(F.count(F.lit(1)).alias("n"))
    )
    certified = (
        chosen.join(firsts, F.col("stratum").eqNullSafe(F.col("_stratum")))
        .groupBy("stratum", "rule", "cutoff", "place", "_strata")
        .agg(F.sum("n").alias("n_good"),
             F.coalesce(F.sum(F.when(F.col("first") <= F.col("place"), F.col("n"))), F.lit(0))
             .alias("false_rejects"))
    )
    # rejections only grow along the sequence, so what holds is a beginning of it
    holds = F.when(
        F.col("false_rejects") <= F.col("n_good") * risk,
        binomial_at_most(F.col("false_rejects"), F.col("n_good"), risk) <= doubt / F.col("_strata"),
    ).otherwise(False)
    return certified.filter(holds).drop("_strata")


def in_holdout(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string").cast("binary")) % 5 >= CHOOSING


def labels_by_id(labels: DataFrame, id_col: str = "doc_id", label: str = "quality") -> DataFrame:
    """(id, good, holdout), one row per id; ids with a null or with both labels are left out."""
    marks = labels.filter(F.col(id_col).isNotNull() & F.col(label).isNotNull())
    return (marks.groupBy(F.col(id_col).alias("_label_id"))
            .agg(F.min(F.col(label)).alias("_low"), F.max(F.col(label)).alias("_high"))
            .filter(F.col("_low") == F.col("_high"))
            .select("_label_id", (F.col("_low") == 1).alias("good"),
                    in_holdout(F.col("_label_id")).alias("holdout")))


def verdicts(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text",
    stratum: str = "lang", risk: float = RISK, doubt: float = DOUBT,
) -> DataFrame:
    """Per row of ``docs``: id, counts, ``base_failed``, ``kept`` and ``rejected_by``.

    Rows are judged one by one, so repeated rows and null ids each give a row of their own.
    A null stratum is a stratum like others. ``rejected_by`` lists the certified rules that
    reject the document. With no labels the base verdict alone counts.
    """
    measured = stored(
        text_counts(docs.select(F.col(id_col).alias("_id"), F.col(stratum).alias("stratum"),
                                F.col(text).alias("_text")), "_text"), "text-counts")
    marked = measured.join(labels_by_id(labels, id_col), F.col("_id") == F.col("_label_id"))
    on = certified_cutoffs(marked, risk, doubt)
    by_stratum = on.groupBy(F.col("stratum").alias("_stratum")).agg(
        F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("_cutoffs"))
    broken = F.array(*[
        F.when(value > F.element_at(F.col("_cutoffs"), rule), F.lit(rule))
        for rule, value in measures().items()])
    return (
        measured.join(by_stratum, F.col("stratum").eqNullSafe(F.col("_stratum")), "left")
        .withColumn("base_failed", base_failed())
        .withColumn("rejected_by", F.coalesce(F.array_compact(broken), F.array().cast("array<string>")))
        .select(F.col("_id").alias(id_col), *COUNTS, "base_failed",
                (~F.col("base_failed") & (F.size("rejected_by") == 0)).alias("kept"),
                F.array_join("rejected_by", ",").alias("rejected_by"))
    )


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text",
              stratum: str = "lang") -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns.

    Texts are measured where they are, once for the cutoffs and once for the filter, so none is
    ever shuffled, and rows with null or repeated ids are judged by their own text.
    """
    measured = stored(
        text_counts(docs.select(F.col(id_col).alias("_id"), F.col(stratum).alias("stratum"),
                                F.col(text).alias("_text")), "_text"), "text-counts")
    on = certified_cutoffs(measured.join(
        labels_by_id(labels, id_col), F.col("_id") == F.col("_label_id")))
    by_stratum = on.groupBy(F.col("stratum").alias("_stratum")).agg(
        F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("_cutoffs"))
    row = F.struct(*[F.col(c) for c in docs.columns]).alias("_row")
    # the number keeps the filter above the counts, which it would otherwise work out anew for
    # every place where it names them
    counted = text_counts(
        docs.select(row, F.col(stratum).alias("stratum"), F.col(text).alias("_text")), "_text"
    ).withColumn("_n", F.monotonically_increasing_id())
    broken = [F.coalesce(value > F.element_at(F.col("_cutoffs"), rule), F.lit(False))
              for rule, value in measures().items()]
    any_broken = broken[0]
    for more in broken[1:]:
        any_broken = any_broken | more
    return (
        counted.join(stored(by_stratum, "cutoffs"),
                     F.col("stratum").eqNullSafe(F.col("_stratum")), "left")
        .filter((F.col("_n") >= 0) & ~base_failed() & ~any_broken)
        .select("_row.*")
    )
