"""What filters of a corpus remove alone, behind one another and in every order, from exact counts of what fails which of them."""

from __future__ import annotations

from fractions import Fraction
from itertools import permutations
from math import comb, factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: ASCII white space, which separates words.
BLANK = r"[\x20\x09-\x0D]+"


def text_rules(text: Column) -> dict[str, Column]:
    """Failure conditions of whole texts by letter: few words, repeated words, capitals, signs. A null text is an empty one."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, BLANK), lambda w: w != "")
    n_words, n_distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": n_words < 50,
        "B": 100 * n_distinct < 65 * n_words,
        "C": F.lit(100).cast("long") * capitals > 5 * F.length(text),
        "D": F.rlike(text, F.lit("[#$%&*|]")),
    }


def tabulate(docs: DataFrame, labels: DataFrame, rules: dict[str, Column], copies: str) -> DataFrame:
    """(part, mask, n, good, toxic): documents of each source by the set of filters that they fail, bit i for the i-th letter.

    ``docs`` is (doc_id, text, source), ``rules`` are conditions on its rows, and ``copies``, the last letter, is failed by
    a document whose text is that of any smaller doc_id in the table. Texts meet as SHA-256 digests. Rows are counted per
    document beside its labels and then per digest, so that a text of a third of all rows is a few rows where digests meet.
    A null source is the empty string; a null doc_id has no smaller one and is none; of repeated rows of a doc_id each
    counts; a document is good or toxic if any of its labels says so. An empty table gives an empty table.
    """
    bits = [F.when(rule, F.lit(1 << i)).otherwise(F.lit(0)) for i, rule in enumerate(rules.values())]
    rows = docs.select(
        "doc_id",
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("digest"),
        sum(bits[1:], bits[0]).alias("mask"),
    )
    said = labels.groupBy(F.col("doc_id").alias("of")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("is_good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("is_toxic")
    )
    own = rows.join(said, rows["doc_id"] == said["of"], "left").withColumns({c: F.coalesce(F.col(c), F.lit(False)) for c in ("is_good", "is_toxic")})
    kind = ["part", "digest", "mask", "is_good", "is_toxic"]
    documents = own.groupBy("doc_id", *kind).agg(F.count("*").alias("n"))
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n")))
    groups = documents.groupBy(*kind).agg(F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("unnamed"), first.alias("first"))
    least = F.min("first.doc_id").over(Window.partitionBy("digest"))
    stays = F.col("unnamed") + F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0)
    split = groups.withColumn("least", least).withColumn("stays", F.coalesce(stays, "unnamed"))
    both = F.explode(F.array(F.struct("mask", F.col("stays").alias("n")), F.struct((F.col("mask") + (1 << len(rules))).alias("mask"), (F.col("n") - F.col("stays")).alias("n"))))
    counted = split.select("part", "is_good", "is_toxic", both.alias("x")).groupBy("part", F.col("x.mask").alias("mask"))
    count = lambda name: F.sum(F.when(F.col(name), F.col("x.n")).otherwise(0))
    return counted.agg(F.sum("x.n").alias("n"), count("is_good").alias("good"), count("is_toxic").alias("toxic"))


def attribution(n: int) -> list[list[int]]:
    """Rows of weights: n! times the Shapley value of player i is the sum of rows[i][S] * v(S) over coalitions S.

    The values minimise the sum of w(S) * (v(S) - sum of x_i in S)^2 over coalitions of 1 to n - 1 players, with the kernel
    weight w(S) = (n - 1) / (C(n, s) * s * (n - s)), under the constraint that all x_i sum to v(all). The normal equations
    with the constraint's multiplier are solved in rationals for all right-hand sides at once; v of no player is 0. Times
    n! all weights of the solution are whole numbers.
    """
    all_of = (1 << n) - 1
    member = lambda s, i: s >> i & 1
    weight = {s: Fraction(n - 1, comb(n, k) * k * (n - k)) for s in range(1, all_of) for k in [s.bit_count()]}
    table = []
    for i in range(n):
        left = [sum((w for s, w in weight.items() if member(s, i) and member(s, j)), Fraction(0)) for j in range(n)]
        table.append(left + [Fraction(1)] + [weight[s] if s in weight and member(s, i) else Fraction(0) for s in range(all_of + 1)])
    table.append([Fraction(1)] * n + [Fraction(0)] + [Fraction(int(s == all_of)) for s in range(all_of + 1)])
    for c in range(n + 1):
        pivot = next(r for r in range(c, n + 1) if table[r][c] != 0)
        table[c], table[pivot] = table[pivot], table[c]
        table[c] = [x / table[c][c] for x in table[c]]
        for r in range(n + 1):
            if r != c and table[r][c] != 0:
                table[r] = [x - table[r][c] * y for x, y in zip(table[r], table[c])]
    return [[int(factorial(n) * x) for x in row[n + 1 :]] for row in table[:n]]


def audit(counts: DataFrame, letters: str) -> DataFrame:
    """Per part, order of the filters and step: what stays, goes, is failed but gone already, and each filter's share.

    ``counts`` is what ``tabulate`` gives. Per part the removals of all 2^n coalitions of filters are tabulated once; a step
    of an order is the difference of two of them, and n! times a filter's Shapley value is a fixed combination of all
    (``attribution``), so nothing grows with the documents here. Zeros are rows too.
    """
    n = len(letters)
    sets = range(1 << n)
    removed = lambda c: F.array(*(F.sum(F.when(F.col("mask").bitwiseAND(s) != 0, F.col(c)).otherwise(0)) for s in sets))
    games = counts.groupBy("part").agg(F.sum("n").alias("total"), removed("n").alias("all"), removed("good").alias("good"), removed("toxic").alias("toxic"))
    share = lambda row: sum((F.get("all", F.lit(s)) * F.lit(w) for s, w in enumerate(row) if w), F.lit(0).cast("long"))
    games = games.withColumn("shares", F.array(*(share(row) for row in attribution(n))))
    orders = F.explode(F.array(*(F.lit("".join(p)) for p in permutations(letters))))
    steps = games.select("*", orders.alias("filter_order")).select("*", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("step"))
    bits = lambda text: sum((F.when(F.contains(text, F.lit(c)), 1 << i).otherwise(0) for i, c in enumerate(letters)), F.lit(0))
    filter_ = F.substring(F.col("filter_order"), F.col("step"), F.lit(1))
    steps = steps.withColumns({"after": bits(F.substring(F.col("filter_order"), F.lit(1), F.col("step"))), "before": bits(F.substring(F.col("filter_order"), F.lit(1), F.col("step") - 1)), "own": bits(filter_)})
    gone = lambda c: F.get(c, F.col("after")) - F.get(c, F.col("before"))
    return steps.select(
        "part", "filter_order", "step",
        (F.col("total") - F.get("all", F.col("after"))).alias("kept"),
        gone("all").alias("removed"),
        (F.get("all", F.col("own")) - gone("all")).alias("redundant"),
        (F.get("all", F.lit((1 << n) - 1)) - F.get("all", F.lit((1 << n) - 1) - F.col("own"))).alias("unique_fails"),
        gone("good").alias("good_lost"),
        gone("toxic").alias("toxic_lost"),
        F.get("shares", F.instr(F.lit(letters), filter_) - 1).alias("shapley"),
    )
