"""Quality rules with thresholds that adapt to each language and source, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandweave.session import Cut

#: ASCII white space, which separates words.
BLANK = r"[\x20\x09-\x0D]"
WINDOW = 8
#: Rates that are compared with the breaks of their group, and whether low values of them are odd, too.
RATES = {"symbol_rate": False, "dup_line_rate": False, "repeat_rate": False, "word_length": True}
#: Shares of a group's documents between whose quantiles a break is looked for; low values by the mirrored shares.
LADDER = (0.9, 0.95, 0.97, 0.98, 0.99, 0.995, 1.0)


def _repeated_words(hashes: Column, words: Column) -> Column:
    """Words covered by windows whose hash comes twice or more, from an array of window hashes in order."""
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(_covered(hashes))


def _covered(hashes: Column) -> Column:
    placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def at_repeats(sorted_: Column) -> Column:
        again = F.filter(sorted_, lambda x, j: F.coalesce(F.get(sorted_, j - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(sorted_, j + 1)["h"] == x["h"], F.lit(False)))
        return F.array_sort(F.transform(again, lambda x: x["i"]))

    def total(positions: Column) -> Column:
        steps = F.transform(positions, lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(positions, j + 1) - p, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    # each step runs inside a one-element transform, so that its array is computed once
    once = F.transform(F.array(placed), at_repeats)
    return F.get(F.transform(once, total), F.lit(0))


def measures(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of every whole text.

    A null text has no words. Windows are compared by 64-bit hashes of their words.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", "lang", "source", text.alias("text"))
    split = rows.withColumn("words", F.filter(F.split("text", BLANK + "+"), lambda w: w != ""))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counted = split.select(
        "doc_id", "lang", "source",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.transform(F.array(lines), lambda x: F.size(x) - F.size(F.array_distinct(x)))[0].cast("long").alias("n_dup_lines"),
        F.transform(F.array(lines), F.size)[0].cast("long").alias("n_lines"),
        # a window's hash is made of its words' hashes, so no window is copied
        F.transform("words", lambda w: F.xxhash64(w)).alias("codes"),
    )
    n = F.size("codes")
    windows = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), F.greatest(n - WINDOW, F.lit(0))), lambda i: F.xxhash64(*(F.get("codes", i + k) for k in range(WINDOW))))).otherwise(F.array().cast("array<bigint>"))
    hashed = counted.withColumn("windows", windows).drop("codes")
    return hashed.withColumn("n_repeat_words", _repeated_words(F.col("windows"), F.col("n_words")).cast("long")).drop("windows")


def _rates(rows: DataFrame) -> DataFrame:
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    return rows.withColumns({
        "symbol_rate": F.col("n_symbols") / chars,
        "dup_line_rate": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
        "repeat_rate": F.col("n_repeat_words") / words,
        "word_length": F.col("word_chars") / words,
    })


def _break(sketch: Column, shares: list[float]) -> Column:
    """The middle of the widest gap between successive quantiles of a ladder, the first of equal ones; its end where all are equal."""
    steps = F.array(*(F.kll_sketch_get_quantile_double(sketch, F.lit(q)) for q in shares))

    def middle(v: Column) -> Column:
        gaps = F.transform(F.sequence(F.lit(0), F.lit(len(shares) - 2)), lambda i: F.struct(F.abs(F.get(v, i + 1) - F.get(v, i)).alias("wide"), (-i).alias("back")))
        widest = F.array_max(gaps)
        return F.when(widest["wide"] == 0, F.get(v, F.lit(len(shares) - 1))).otherwise((F.get(v, -widest["back"]) + F.get(v, 1 - widest["back"])) / 2)

    # inside a one-element transform, so that the ladder is computed once
    return F.get(F.transform(F.array(steps), middle), F.lit(0))


def thresholds(rates: DataFrame, shards: int = 16, k: int = 1024, prior: int = 100) -> DataFrame:
    """Per (lang, source) the bounds of each rate, from quantile sketches.

    Every shard of a group has a sketch of its own (KLL of size ``k``, exact up to about k rows) and the shards' sketches
    are merged, so a source that holds a third of all rows is read by many tasks and only sketches meet. A bound is the
    break in the tail of a group's rates: the middle of the widest gap between the quantiles of LADDER. The break of n
    documents counts n / (n + prior), the rest comes from the sketch of the language and, likewise, that of all rows, so
    small groups lean on larger ones without a jump. Null keys form a group of their own.
    """
    shard = F.pmod(F.xxhash64("doc_id"), F.lit(shards))
    parts = rates.groupBy("lang", "source", shard.alias("shard")).agg(F.count("*").alias("n"), *(F.kll_sketch_agg_double(c, F.lit(k)).alias(c) for c in RATES))
    parts = Cut(parts, "quality-sketches").df
    merged = [F.sum("n").alias("n"), *(F.kll_merge_agg_double(c, F.lit(k)).alias(c) for c in RATES)]
    sides = [(c, side) for c, low in RATES.items() for side in (("high", "low") if low else ("high",))]
    ladder = {"high": list(LADDER), "low": [1 - q for q in LADDER]}

    def breaks(df: DataFrame, tag: str) -> DataFrame:
        return df.select(*(x for x in ("lang", "source") if x in df.columns), F.col("n").alias(f"{tag}_n"), *(_break(F.col(c), ladder[side]).alias(f"{tag}_{c}_{side}") for c, side in sides))

    # one row each for all and for a language; both are joined to as many rows as there are groups
    of_all = breaks(parts.agg(*merged), "all")
    of_lang = breaks(parts.groupBy("lang").agg(*merged), "lang").withColumnRenamed("lang", "of_lang")
    own = breaks(parts.groupBy("lang", "source").agg(*merged), "own").join(F.broadcast(of_all)).join(of_lang, F.col("lang").eqNullSafe(F.col("of_lang")))
    lean = lambda tag, value, parent: (F.col(f"{tag}_n") * value + prior * parent) / (F.col(f"{tag}_n") + prior)
    at = lambda tag, c, side: F.col(f"{tag}_{c}_{side}")
    return own.select("lang", "source", *(lean("own", at("own", c, side), lean("lang", at("lang", c, side), at("all", c, side))).alias(f"{c}_{side}") for c, side in sides))


def judge(docs: DataFrame) -> DataFrame:
    """Rows ``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept)``.

    base_failed: fewer than 20 words, or over 30 % of the words repeated. kept: not base_failed, and every rate within
    the bounds of its language and source, of which only documents that pass the base rules are the measure. An empty
    table gives no rows; repeated rows are judged each.
    """
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    rows = _rates(Cut(measures(docs), "quality-measures").df.withColumn("base_failed", base))
    limits = thresholds(rows.where("not base_failed"))
    keyed = limits.withColumnsRenamed({"lang": "of_lang", "source": "of_source"})
    fits = F.lit(True)
    for c, low in RATES.items():
        fits = fits & (F.col(c) <= F.col(f"{c}_high"))
        fits = fits & (F.col(c) >= F.col(f"{c}_low")) if low else fits
    joined = rows.join(keyed, F.col("lang").eqNullSafe(F.col("of_lang")) & F.col("source").eqNullSafe(F.col("of_source")), "left")
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & F.coalesce(fits, F.lit(True))).alias("kept"))
