"""Soft-membership mixing of documents to target domain weights, in DataFrame functions only."""

from __future__ import annotations

import math
import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandweave.session import Cut

#: Share of all expected tokens that each domain of the labelled table shall have.
TARGETS = {"high": 0.70, "low": 0.27, "toxic": 0.03}
#: Upper edges of the bins of each feature; the last bin is open.
EDGES = {
    "symbols": (0.002, 0.02, 0.08),
    "capitals": (0.02, 0.05, 0.2, 0.5),
    "blanks": (0.08, 0.12, 0.16, 0.2),
    "size": (100.0, 1000.0, 5000.0),
    "repeats": (0.01, 0.1, 0.3),
    "marked": (0.5, 1.5, 3.5),
}


def _features(text: Column, keywords: list[str]) -> dict[str, Column]:
    size = F.greatest(F.length(text), F.lit(1))
    lines = F.filter(F.split(text, "\n"), lambda x: x != "")
    words = "|".join(map(re.escape, keywords))
    return {
        "symbols": F.length(F.regexp_replace(text, r"[^#*$%&|<>!]+", "")) / size,
        "capitals": F.length(F.regexp_replace(text, r"[^A-Z]+", "")) / size,
        "blanks": (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))) / size,
        "size": size.cast("double"),
        "repeats": F.transform(F.array(lines), lambda x: (F.size(x) - F.size(F.array_distinct(x))) / F.greatest(F.size(x), F.lit(1)))[0],
        "marked": F.regexp_count(F.lower(text), F.lit(rf"(?<!\p{{L}})(?:{words})(?!\p{{L}})")).cast("double") if keywords else F.lit(0.0),
    }


def _bin(value: Column, edges: tuple[float, ...]) -> Column:
    out = F.lit(len(edges))
    for i in reversed(range(len(edges))):
        out = F.when(value < edges[i], F.lit(i)).otherwise(out)
    return out


def _bins(rows: DataFrame, keywords: list[str]) -> dict[str, Column]:
    return {name: _bin(value, EDGES[name]) for name, value in _features(F.coalesce("text", F.lit("")), keywords).items()}


def _domain() -> Column:
    return F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "high").otherwise("low")


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = 6000, keywords: int = 24) -> dict:
    """A naive Bayes classifier of the labelled documents' domains: binned text features and counts of marker words.

    Fitted on a bounded sample, the ``max_docs`` labelled documents of smallest hash of doc_id. Marker words are the
    ``keywords`` words that most set toxic documents of the sample apart. The model is a few hundred numbers.
    """
    named = labels.where("quality is not null or toxic is not null").select(F.col("doc_id").alias("of"), _domain().alias("domain")).groupBy("of").agg(F.max("domain").alias("domain"))
    picked = named.orderBy(F.xxhash64("of"), "of").limit(max_docs)  # (of, domain): bounded, so it may be broadcast
    sample = Cut(docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("of")).select("doc_id", "text", "domain"), "mixing-sample")
    counts = {r["domain"]: r["n"] for r in sample.df.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    domains = sorted(set(TARGETS) | set(counts))
    bad, rest = counts.get("toxic", 0), sum(counts.values()) - counts.get("toxic", 0)
    words = sample.df.select("domain", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}{3,})"), 1))).alias("word"))
    table = words.groupBy("word").agg(F.count_if(F.col("domain") == "toxic").alias("a"), F.count_if(F.col("domain") != "toxic").alias("b"))
    odds = F.log((F.col("a") + 0.5) / (bad + 1.0)) - F.log((F.col("b") + 0.5) / (rest + 1.0))
    marks = [r["word"] for r in table.where(F.col("a") >= max(3, bad // 50)).withColumn("odds", odds).where("odds > 2").orderBy(F.desc("odds"), "word").limit(keywords).collect()]
    bins = sample.df.select("domain", *(v.alias(k) for k, v in _bins(sample.df, marks).items()))
    stacked = bins.select("domain", F.explode(F.map_from_arrays(F.array(*map(F.lit, EDGES)), F.array(*(F.col(c) for c in EDGES)))).alias("feature", "bin"))
    seen = {(r["domain"], r["feature"], r["bin"]): r["n"] for r in stacked.groupBy("domain", "feature", "bin").agg(F.count("*").alias("n")).collect()}
    sample.drop()
    total = sum(counts.values())
    prior = {d: math.log((counts.get(d, 0) + 1) / (total + len(domains))) for d in domains}
    logs = {(d, f, b): math.log((seen.get((d, f, b), 0) + 0.5) / (counts.get(d, 0) + 0.5 * (len(EDGES[f]) + 1))) for d in domains for f in EDGES for b in range(len(EDGES[f]) + 1)}
    return {"domains": domains, "prior": prior, "logs": logs, "keywords": marks}


def posteriors(docs: DataFrame, model: dict) -> DataFrame:
    """(row_, n_tokens, p_<domain>...) of every whole text; n_tokens counts words between ASCII white space.

    ``row_`` is the row of ``docs`` as a struct, so that its columns may have any names.
    """
    rows = docs.select(F.struct("*").alias("row_"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    binned = rows.select("row_", F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("double").alias("n_tokens"), *(v.alias(f"bin_{k}") for k, v in _bins(rows, model["keywords"]).items()))
    scores = {}
    for d in model["domains"]:
        value = F.lit(model["prior"][d])
        for f, edges in EDGES.items():
            value = value + F.get(F.array(*(F.lit(model["logs"][d, f, b]) for b in range(len(edges) + 1))), F.col(f"bin_{f}"))
        scores[d] = value
    scored = binned.select("row_", "n_tokens", *(v.alias(f"s_{d}") for d, v in scores.items()))
    top = F.greatest(*(F.col(f"s_{d}") for d in model["domains"])) if len(model["domains"]) > 1 else F.col(f"s_{model['domains'][0]}")
    expd = scored.withColumn("top", top).select("row_", "n_tokens", *(F.exp(F.col(f"s_{d}") - F.col("top")).alias(f"e_{d}") for d in model["domains"]))
    norm = sum((F.col(f"e_{d}") for d in model["domains"]), F.lit(0.0))
    return expd.select("row_", "n_tokens", *(F.round(F.col(f"e_{d}") / norm, 6).alias(f"p_{d}") for d in model["domains"]))


def _moved(rate: Column, step: list[Column], domains: list[str]) -> Column:
    """A document's rate after a step along its posteriors, which stays >= 0."""
    return F.greatest(F.lit(0.0), rate - sum((F.col(f"p_{d}") * v for d, v in zip(domains, step, strict=True)), F.lit(0.0)))


def _rate(domains: list[str], steps: list[dict[str, float]]) -> Column:
    """The projected-gradient path of a document's rate, from 1."""
    if not steps:
        return F.lit(1.0)
    path = F.array(*(F.array(*(F.lit(float(s[d])) for d in domains)) for s in steps))
    return F.aggregate(path, F.lit(1.0), lambda r, s: _moved(r, [F.get(s, F.lit(i)) for i in range(len(domains))], domains))


def solve(members: DataFrame, domains: list[str], targets: dict[str, float], tolerance: float = 1e-4) -> list[dict[str, float]]:
    """Steps of projected gradient descent for min |A r - t|, r >= 0.

    A r are the expected tokens of each domain under rates r, t the targets times all tokens. The gradient is taken in
    the metric of the documents' tokens, in which a step of a document is its posteriors times a vector of one number
    per domain, so rates depend on posteriors alone: documents of equal posteriors are summed first, and each round
    reads these sums and sends back a few numbers. A round searches along the projected path of the gradient, plain (in
    lengths from 1.9 / (largest eigenvalue of the Gram matrix), which always descends) and scaled by the inverse Gram
    matrix of the documents whose rate is above 0, and takes the length of least |A r - t|, all in one pass. The end is
    a residual of at most ``tolerance`` of all tokens or, where no rates meet the targets, the point where a round
    gains less than a hundredth of that; since every other round gains more, there is an end.
    """
    keys = [f"p_{d}" for d in domains]
    groups = Cut(members.groupBy(*keys).agg(F.sum("n_tokens").alias("n_tokens")).coalesce(8), "mixing-groups")
    total = groups.df.agg(F.sum("n_tokens")).first()[0] or 0.0
    if not total:
        return []
    share = sum(targets.values())
    goal = np.array([total * targets.get(d, 0.0) / share for d in domains])
    pairs = [(a, b) for a in keys for b in keys]
    tokens = lambda rate: [F.sum(F.col("n_tokens") * F.col(k) * rate) for k in keys]
    named = lambda move: dict(zip(domains, map(float, move), strict=True))
    steps: list[dict[str, float]] = []
    while True:
        rated = groups.df.withColumn("r", _rate(domains, steps))
        gram = lambda kept: [F.sum(F.when(kept, F.col("n_tokens") * F.col(a) * F.col(b)).otherwise(0.0)) for a, b in pairs]
        got = np.array(rated.agg(*tokens(F.col("r")), *gram(F.col("r") > 0), *gram(F.lit(True))).first(), float)
        off = got[: len(keys)] - goal
        if abs(off).max() <= tolerance * total:
            break
        active, whole = got[len(keys) :].reshape(2, len(keys), len(keys))
        scaled, largest = np.linalg.lstsq(active, off, rcond=1e-9)[0], np.linalg.eigvalsh(whole).max()
        moves = [scaled * 0.5**i for i in range(8)] + [off * c / largest for c in (1.9, 8.0, 32.0, 128.0, 512.0)]
        sums = [x for m in moves for x in tokens(_moved(F.col("r"), [F.lit(v) for v in named(m).values()], domains))]
        ends = np.array(rated.agg(*sums).first(), float).reshape(len(moves), len(keys))
        lengths = np.linalg.norm(ends - goal, axis=1)
        if np.linalg.norm(off) - lengths.min() <= 0.01 * tolerance * total:
            break
        steps.append(named(moves[int(lengths.argmin())]))
    groups.drop()
    return steps


def rated(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """(row_, n_tokens, p_<domain>..., rate, copies) of every row of ``docs``; see ``mix``."""
    model = fit(docs, labels)
    members = Cut(posteriors(docs, model), "mixing-members").df
    steps = solve(members, model["domains"], targets or TARGETS)
    found = members.withColumn("rate", _rate(model["domains"], steps))
    chance = F.pmod(F.xxhash64("row_.doc_id"), F.lit(1_000_003)) / 1_000_003.0
    copies = F.floor("rate") + F.when(chance < F.col("rate") - F.floor("rate"), 1).otherwise(0)
    return found.withColumn("copies", copies.cast("long"))


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """Rows ``(doc_id, n_tokens, p_<domain>..., rate, copies)``: how often each document shall be used.

    ``rate`` >= 0 is fitted so that expected tokens per domain match ``targets`` (shares, default ``TARGETS``);
    ``copies`` is the rate rounded up or down by a hash of doc_id, in proportion. Every row has a row, repeated ones
    too; each counts with its tokens. Null and empty texts have no tokens and their copies follow their rate all the
    same. A document labelled twice has the last of its domains in order of name. Without labels, posteriors are equal;
    an empty table stays empty. Columns besides doc_id and text are not read.
    """
    found = rated(docs.select("doc_id", "text"), labels, targets)
    return found.select("row_.doc_id", *(c for c in found.columns if c != "row_"))


def resampled(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """The rows of ``docs``, each as often as its ``copies`` say; columns of any name are kept, no row is joined."""
    found = rated(docs, labels, targets).where("copies > 0")
    return found.select("row_", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("row_.*")
