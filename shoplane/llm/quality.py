"""Quality rules with risk-controlled thresholds; DataFrame expressions only.

The base rule is fixed. On top of it a text is rejected where any feature of ``RULES`` is above its cutoff, and the cutoffs are chosen
per stratum (language) on a labelled holdout: the texts that have a label and pass the base rule. The cutoffs tried form one
fixed sequence of levels, from loose to strict, each a cutoff for every rule; a level is tested as a whole, so the risk is that of
all rules together. A level is safe if the exact binomial bound on its false rejections (good texts it rejects) is at most
``risk``: if k of n good texts are rejected, the chance of k or fewer at that risk must not exceed the doubt. Levels are tested
in their order until the first that is not safe, and the last safe one is used. As the order is fixed beforehand, no level but the first
unsafe one can err, so the sequence needs no correction for its length; ``doubt`` is divided by the number of strata and one.
So with probability 1 - doubt all strata at once lose at most ``risk`` of their good texts.

A stratum with too few good texts for any level (fewer than ln(doubt share) / ln(1 - risk), with none rejected) takes the level of the
pooled holdout of all strata, the one more test; the guarantee then is that of the corpus as a whole. A stratum without a label, and
any where not even the first level is safe, has the base rule only.

Null texts have no words. A null language is a stratum of its own. Labels that are null do not count, and ids whose labels
disagree are left out. Repeated rows are judged alike; a repeated id counts in the holdout as often as it stands in the
documents. Empty tables give no rows; without labels only the base rule rejects. Other columns are ignored or kept by name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplane.llm.common import SPACE, stored

# Fixed values of the contract.
WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8

#: Feature of a rule (an expression over the counts) and its cutoff at every level, from loose to strict.
RULES: dict[str, tuple[str, tuple[float, ...]]] = {
    "symbol_share": ("n_symbols / greatest(word_chars, 1)", (0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.08, 0.06, 0.04, 0.03, 0.02, 0.01)),
    "repeat_share": ("n_repeat_words / greatest(n_words, 1)", (0.3, 0.29, 0.28, 0.27, 0.26, 0.25, 0.24, 0.22, 0.2, 0.18, 0.16, 0.14)),
    "dup_line_share": ("n_dup_lines / greatest(n_lines, 1)", (0.9, 0.8, 0.75, 0.7, 0.65, 0.6, 0.55, 0.5, 0.45, 0.4, 0.35, 0.3)),
    "shout_share": ("n_shouts / greatest(n_words, 1)", (0.8, 0.7, 0.6, 0.5, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1, 0.05)),
    "word_length": ("word_chars / greatest(n_words, 1)", (24.0, 20.0, 18.0, 16.0, 15.0, 14.0, 13.0, 12.0, 11.0, 10.0, 9.5, 9.0)),
}
LEVELS = 12
RISK = 0.02
DOUBT = 0.05


def _once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), use)[0]


def _count(text: Column, letters: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, letters, ""))


def _covered(hashes: Column) -> Column:
    """Words inside windows that occur twice or more, from the windows' hashes in order."""

    def spread(ordered: Column) -> Column:
        last = F.size(ordered) - 1
        twice = F.filter(
            ordered,
            lambda x, i: F.coalesce((i > 0) & (ordered[F.greatest(i - 1, F.lit(0))]["h"] == x["h"]), F.lit(False))
            | F.coalesce((i < last) & (ordered[F.least(i + 1, last)]["h"] == x["h"]), F.lit(False)),
        )
        places = F.sort_array(F.transform(twice, lambda x: x["i"]))
        zero = F.struct(F.lit(-WINDOW).alias("at"), F.lit(0).alias("n"))
        return F.aggregate(
            places,
            zero,
            lambda sofar, at: F.struct(at.cast("int").alias("at"), (sofar["n"] + F.least(F.lit(WINDOW), at - sofar["at"])).cast("int").alias("n")),
            lambda sofar: sofar["n"],
        )

    def full(found: Column) -> Column:
        ordered = F.array_sort(F.transform(found, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(found)) == F.size(found), 0).otherwise(_once(ordered, spread))

    return _once(hashes, full)


def _repeats(words: Column) -> Column:
    numbered = F.transform(words, lambda word: F.xxhash64(word))

    def windows(hashes: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(hashes) - WINDOW), lambda i: F.xxhash64(F.slice(hashes, i + 1, WINDOW)))

    return F.when(F.size(words) <= WINDOW, 0).otherwise(_covered(_once(numbered, windows)))


def features(text: Column) -> list[Column]:
    """n_words, the four contract counts, and n_lines and n_shouts for the rules."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    words = F.array_remove(F.split(text, SPACE), "")
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(WHITE)) != "")
    repeated = _once(words, lambda w: F.struct(F.size(w).alias("n"), _repeats(w).alias("r")))
    by_line = _once(lines, lambda found: F.struct(F.size(found).alias("n"), (F.size(found) - F.size(F.array_distinct(found))).alias("d")))
    return [
        repeated.alias("_words"),
        by_line.alias("_lines"),
        F.char_length(F.translate(text, WHITE, "")).cast("long").alias("word_chars"),
        _count(text, SYMBOLS).cast("long").alias("n_symbols"),
        _count(text, "!").cast("long").alias("n_shouts"),
    ]


def measured(documents: DataFrame, text: Column, keep: list[Column]) -> DataFrame:
    """``keep`` with the counts, the rules' features and base_failed."""
    raw = documents.select(*keep, *features(text))
    kept = [name for name in raw.columns if name not in ("_words", "_lines", "word_chars", "n_symbols", "n_shouts")]
    counted = raw.select(
        *kept,
        F.col("_words.n").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.col("_lines.d").cast("long").alias("n_dup_lines"),
        F.col("_words.r").cast("long").alias("n_repeat_words"),
        F.col("_lines.n").cast("long").alias("n_lines"),
        "n_shouts",
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return counted.select("*", failed.alias("base_failed"), *[F.expr(feature).alias(name) for name, (feature, _) in RULES.items()])


def _safe(n: str, k: str, risk: str, doubt: str) -> Column:
    """Whether the chance of ``k`` or fewer among ``n`` at ``risk`` is at most ``doubt``, summed exactly in logarithms."""
    first = f"{n} * ln(1 - {risk})"
    total = f"""aggregate(sequence(1, cast({k} as int)), named_struct('term', {first}, 'sum', {first}),
        (s, j) -> named_struct(
            'term', s.term + ln(({n} - j + 1) / j) + ln({risk} / (1 - {risk})),
            'sum', greatest(s.sum, s.term + ln(({n} - j + 1) / j) + ln({risk} / (1 - {risk})))
                + log1p(exp(-abs(s.sum - (s.term + ln(({n} - j + 1) / j) + ln({risk} / (1 - {risk}))))))),
        s -> s.sum)"""
    return F.expr(f"case when {n} = 0 or {k} >= {n} * {risk} then false when {k} = 0 then {first} <= ln({doubt}) else {total} <= ln({doubt}) end")


def _last_safe(n: str, k: str, risk: str, doubt: str) -> Column:
    """The number of levels that are safe one after the other from the first; k of level L is in ``k`` + L."""
    level = F.lit(LEVELS)
    for place in reversed(range(LEVELS)):
        level = F.when(~_safe(n, f"{k}{place}", risk, doubt), place).otherwise(level)
    return level


def cutoffs(holdout: DataFrame, risk: float = RISK, doubt: float = DOUBT) -> DataFrame:
    """Per stratum the level, and its cutoff of each rule (null at level 0: none). ``holdout`` has stratum, good and the features."""
    good = F.col("good")

    def rejected(level: int) -> Column:
        over = F.lit(False)
        for name, (_, values) in RULES.items():
            over = over | F.coalesce(F.col(name) > values[level], F.lit(False))
        return over

    counts = holdout.groupBy("stratum").agg(F.count_if(good).alias("n"), *[F.count_if(good & rejected(at)).alias(f"k{at}") for at in range(LEVELS)])
    pooled = counts.agg(F.count("*").alias("strata"), F.coalesce(F.sum("n"), F.lit(0)).alias("pn"), *[F.coalesce(F.sum(f"k{at}"), F.lit(0)).alias(f"pk{at}") for at in range(LEVELS)])
    share = F.lit(doubt) / (F.col("strata") + 1)
    pooled = pooled.withColumn("each", share).withColumn("risk", F.lit(risk)).withColumn("pooled", _last_safe("pn", "pk", "risk", "each"))
    tests = counts.crossJoin(F.broadcast(pooled.select("each", "risk", "pooled")))  # one row of three numbers
    few = F.expr("n * ln(1 - risk) > ln(each)")
    chosen = tests.select("stratum", F.when(few, F.col("pooled")).otherwise(_last_safe("n", "k", "risk", "each")).alias("level"))
    picked = [F.get(F.array(*[F.lit(value) for value in values]), F.col("level") - 1).alias(f"cut_{name}") for name, (_, values) in RULES.items()]
    return chosen.select("stratum", "level", *picked)


def holdout_of(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows with one agreed label that pass the base rule; ``rows`` has doc_id, stratum and the features."""
    marks = labels.filter("quality is not null and doc_id is not null").groupBy("doc_id")
    marks = marks.agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
    marks = marks.select(F.col("doc_id").cast("long").alias("_id"), (F.col("high") == 1).alias("good"), (F.col("low") != F.col("high")).alias("_mixed"))
    held = rows.join(marks, F.col("doc_id") == F.col("_id"))
    return held.filter(~F.greatest("base_failed", "_mixed")).drop("_mixed")  # one condition on both sides: see ``judged``


def judged(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """``rows`` with kept. It is one condition on both sides of the join: a part that needs the rows only would be
    moved below the join as a filter of its own, which counts every text once more."""
    cut = rows.join(chosen.drop("level").withColumnRenamed("stratum", "_stratum"), F.col("stratum").eqNullSafe(F.col("_stratum")), "left")
    over = [F.coalesce(F.col(name) > F.col(f"cut_{name}"), F.lit(False)) for name in RULES]
    return cut.withColumn("kept", ~F.greatest("base_failed", *over)).select(*rows.columns, "kept")


def _stratum(lang: Column) -> Column:
    return lang.cast("string").alias("stratum")


def assess(documents: DataFrame, labels: DataFrame, risk: float = RISK, doubt: float = DOUBT) -> DataFrame:
    """doc_id, the counts, base_failed and kept of every document."""
    rows = stored(measured(documents, F.col("text"), [F.col("doc_id").cast("long").alias("doc_id"), _stratum(F.col("lang"))]), "quality")
    return judged(rows, cutoffs(holdout_of(rows, labels), risk, doubt))


def keep_good(documents: DataFrame, labels: DataFrame, risk: float = RISK, doubt: float = DOUBT) -> DataFrame:
    """The documents that pass, with their columns. Texts are measured twice rather than shuffled to their verdicts."""
    small = measured(documents, F.col("text"), [F.col("doc_id").cast("long").alias("doc_id"), _stratum(F.col("lang"))])
    chosen = stored(cutoffs(holdout_of(small, labels), risk, doubt), "cutoffs")
    row = F.struct(*[F.col(f"`{name}`") for name in documents.columns]).alias("_row")
    held = documents.select(row, F.col("text").cast("string").alias("_text"), _stratum(F.col("lang")))
    return judged(measured(held, F.col("_text"), [F.col("_row"), F.col("stratum")]), chosen).filter("kept").select("_row.*")
