"""Secrets in texts: fixed patterns, and values behind credential words that a guesser would need too many tries for."""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import log2

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandweave.session import Cut

#: Kinds of spans in the order in which they follow each other at one start. ``guess`` is the method's own.
KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
#: A credential word, what may stand between it and its value, and the value up to a blank, quote or angle bracket.
CONTEXT = re.compile(
    r"""(?<![A-Za-z])(?:pass(?:phrase|code|word|wd|wort)?|pwd|pw|secret|token|bearer|credentials?|login|pin|clave|contraseña|kennwort|mot\x20de\x20passe"""
    r"""|(?:api|access|private|secret|auth|client|account|session)[\x20_-]?(?:key|token|secret))["']?"""
    r"""(?:\x20*(?:[:=]|[=-]>)\x20*|\x20+(?:is|ist|est|es|was)\x20+|\x20+)["'(`]?([^\s"'<>`]{6,})""",
    re.I,
)
TRAILING = ".,;:!?)]}"
#: Digits and signs that stand for letters in passwords.
LEET = str.maketrans("013457@$", "oieastas")
SHORTEST, LONGEST = 3, 24
#: Rows of a keyboard, each half a key or less to the right of the one above; a walk steps from a key to one beside it.
KEYBOARD = (("1234567890", 0.0), ("qwertyuiop", 0.5), ("asdfghjkl", 0.75), ("zxcvbnm", 1.25))
_KEY = {c: (row, x + i) for row, (keys, x) in enumerate(KEYBOARD) for i, c in enumerate(keys)}
_DAY, _MONTH, _YEAR = r"(?:0[1-9]|[12]\d|3[01])", r"(?:0[1-9]|1[0-2])", r"(?:19|20)\d\d"
#: Dates and the bits of the days and years that they tell apart.
DATES = [
    (re.compile(_YEAR), log2(200)),
    (re.compile(rf"{_YEAR}{_MONTH}{_DAY}|{_DAY}{_MONTH}{_YEAR}|{_MONTH}{_DAY}{_YEAR}"), log2(3 * 366 * 200)),
    (re.compile(rf"{_YEAR}([-./_]){_MONTH}\1{_DAY}|{_DAY}([-./_]){_MONTH}\2{_YEAR}|{_MONTH}([-./_]){_DAY}\3{_YEAR}"), log2(12 * 366 * 200)),
    (re.compile(rf"{_DAY}{_MONTH}\d\d|{_MONTH}{_DAY}\d\d"), log2(2 * 366 * 100)),
]
#: Bits to tell which kind of segment comes next.
SEGMENT_BITS = log2(5)
LONGEST_UNIT, MOST_TIMES = 16, 32


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, place of the kind in KINDS) of the fixed patterns' matches, in code points, ends exclusive."""
    out = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    out += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    return out + [(m.start(), m.end(), 2) for m in HEX.finditer(text)]


def context_values(text: str) -> list[tuple[int, int, str]]:
    """(start, end, value) of values behind credential words, without closing signs at their ends."""
    out = []
    for m in CONTEXT.finditer(text):
        value = m.group(1).rstrip(TRAILING)
        if len(value) >= 6:
            out.append((m.start(1), m.start(1) + len(value), value))
    return out


def plain(value: str) -> str:
    """The value in lower case, code point by code point, with leet signs as the letters that they stand for."""
    return "".join(c.lower() if len(c.lower()) == 1 else c for c in value).translate(LEET)


def pieces(value: str) -> set[str]:
    """All substrings of the plain value that might be words."""
    out = set()
    for run in re.finditer(r"[^\W\d_]+", text := plain(value)):
        for i in range(run.start(), run.end() - SHORTEST + 1):
            out.update(text[i:j] for j in range(i + SHORTEST, min(run.end(), i + LONGEST) + 1))
    return out


def _sign_bits(c: str) -> float:
    return log2(10) if c.isdigit() else log2(26) if c.isascii() and c.isalpha() else log2(33) if c.isascii() else log2(1000)


def _word_bits(written: str, word_bits: float) -> float:
    """Bits of a word and of how it is written: capitals and leet signs."""
    letters = [c for c in written if c.isalpha()]
    upper = sum(c.isupper() for c in letters)
    cased = 0 if upper == 0 else 1 if upper == len(letters) or (upper == 1 and written[0].isupper()) else len(letters)
    return word_bits + cased + (len(written) - len(letters))


def _beside(a: str, b: str) -> tuple[int, int] | None:
    """The step from a key to one beside it, or between neighbours of the alphabet."""
    if a in _KEY and b in _KEY:
        (r, x), (s, y) = _KEY[a], _KEY[b]
        if a != b and abs(r - s) <= 1 and abs(x - y) <= 1:
            return s - r, 1 if y > x else -1
    if a.isascii() and b.isascii() and a.isalpha() and b.isalpha() and abs(ord(a) - ord(b)) == 1:
        return 9, ord(b) - ord(a)
    return None


def _walks(text: str) -> list[tuple[int, int, float]]:
    """(start, end, bits) of keyboard walks and alphabet runs of three keys and more: first key, length, and each turn."""
    out = []
    lower = text.lower() if len(text.lower()) == len(text) else text
    steps = [_beside(a, b) for a, b in zip(lower, lower[1:])]
    for i in range(len(steps)):
        turns, j = 0, i
        while j < len(steps) and steps[j] is not None and j - i < 64:
            turns += j > i and steps[j] != steps[j - 1]
            j += 1
            if j - i >= 2:
                out.append((i, j + 1, log2(47) + log2(j - i + 1) + 3 * turns))
    return out


def _repeats(text: str) -> list[tuple[int, int, int]]:
    """(start, end, length of the unit) of units that come in a row from each start: 2 to MOST_TIMES times, and as often as they do."""
    out = []
    n = len(text)
    for unit in range(1, min(LONGEST_UNIT, n // 2) + 1):
        same = 0
        for i in range(n - unit - 1, -1, -1):
            same = same + 1 if text[i] == text[i + unit] else 0
            most = same // unit + 1
            out.extend((i, i + times * unit, unit) for times in {*range(2, min(most, MOST_TIMES) + 1), most} if times > 1 and times * unit >= 3)
    return out


def guess_bits(value: str, words: dict[str, float]) -> float:
    """The log2 of the guesses that the cheapest way to build a value takes, by dynamic programming over its prefixes.

    A value is cut into words (``words``: bits of each), dates, repeats, keyboard walks and spans of brute force. Every
    segment costs its kind besides; in a span of brute force each sign costs its class.
    """
    return _cheapest(value, plain(value), words)


def _cheapest(value: str, text: str, words: dict[str, float]) -> float:
    n = len(value)
    ending: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
    for i in range(n):
        for j in range(i + SHORTEST, min(n, i + LONGEST) + 1):
            if (bits := words.get(text[i:j])) is not None:
                ending[j].append((i, _word_bits(value[i:j], bits)))
        for pattern, bits in DATES:
            if m := pattern.match(value, i):
                ending[m.end()].append((i, bits))
    for i, j, bits in _walks(value):
        ending[j].append((i, bits))
    for i, j, unit in _repeats(value):
        ending[j].append((i, sum(map(_sign_bits, value[i : i + unit])) + log2((j - i) // unit)))
    best, brute = [0.0] + [float("inf")] * n, float("inf")
    for j in range(1, n + 1):
        brute = min(brute, best[j - 1] + SEGMENT_BITS) + _sign_bits(value[j - 1])
        best[j] = min([brute, *(best[i] + SEGMENT_BITS + bits for i, bits in ending[j])])
    return best[n]


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
_VALUES = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("value", pa.string())]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t or "" for t in batch["text"].to_pylist()]
        base = pa.array([[{"start": s, "kind": k, "end": e} for s, e, k in base_spans(t)] for t in texts], _SPANS)
        values = pa.array([[{"start": s, "end": e, "value": v} for s, e, v in context_values(t)] for t in texts], _VALUES)
        yield pa.record_batch([batch["doc_id"], batch["row"], base, values], ["doc_id", "row", "base", "found"])


def word_counts(docs: DataFrame, values: DataFrame) -> DataFrame:
    """(word, n): words of SHORTEST to LONGEST letters in all whole texts, without those that stand in ``values`` (value, n)."""
    words = lambda text: F.explode(F.regexp_extract_all(F.lower(text), F.lit(rf"(\p{{L}}{{{SHORTEST},}})"), 1))
    said = docs.select(words(F.col("text")).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    inside = values.select(words(F.col("value")).alias("word"), "n").groupBy("word").agg((-F.sum("n")).alias("n"))
    both = said.unionByName(inside).where(F.length("word") <= LONGEST).groupBy("word").agg(F.sum("n").alias("n"))
    return both.where("n > 0")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        own = [(v, p) for v in batch["value"].to_pylist() for p in sorted(pieces(v))]
        yield pa.record_batch([pa.array([x[i] for x in own], pa.string()) for i in (0, 1)], ["value", "piece"])


def value_bits(values: DataFrame, counts: DataFrame) -> DataFrame:
    """(value, bits): the guess cost of each distinct value; a word costs the log2 of all words by its own count.

    The substrings of values meet the corpus's words in a join, so no task needs the whole vocabulary.
    """
    total = counts.agg(F.sum("n").alias("n")).first()["n"] or 1
    parts = values.select("value").mapInArrow(_pieces, "value string, piece string")
    known = parts.join(counts.withColumnRenamed("word", "piece"), "piece").groupBy("value").agg(F.collect_list(F.struct("piece", "n")).alias("words"))

    def cost(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [{x["piece"]: log2(total / x["n"]) for x in w or []} for w in batch["words"].to_pylist()]
            bits = [guess_bits(v, w) for v, w in zip(batch["value"].to_pylist(), words)]
            yield pa.record_batch([batch["value"], pa.array(bits, pa.float64())], ["value", "bits"])

    return values.select("value").join(known, "value", "left").mapInArrow(cost, "value string, bits double")


def scan(docs: DataFrame, least_bits: float = 32.0) -> DataFrame:
    """(doc_id, spans, most_bits): per row the spans (start, kind, end) of its secrets by start, then kind as in KINDS.

    Spans are in code points of the whole text, ends exclusive. Fixed patterns give ``assign`` (the word, sign and value),
    ``access`` and ``hex``; each value behind a credential word whose guess cost is ``least_bits`` (2^32 guesses) or more gives ``guess``, also
    where a fixed pattern has it. ``most_bits`` is the highest cost of a row's values, null where it has none. A null text
    is empty; repeated rows are scanned each; a null doc_id is kept; other columns are not read; an empty table gives none.
    """
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    span = "array<struct<start:int,kind:int,end:int>>"
    found = Cut(rows.mapInArrow(_scan, f"doc_id {kind}, row long, base {span}, found array<struct<start:int,end:int,value:string>>"), "secrets").df
    single = found.select("row", F.explode("found").alias("x")).select("row", "x.*")
    values = Cut(single.groupBy("value").agg(F.count("*").alias("n")), "values").df
    counts = Cut(word_counts(docs, values), "word-counts").df
    judged = Cut(value_bits(values, counts), "value-bits").df
    own = single.join(judged, "value").groupBy("row").agg(
        F.collect_list(F.when(F.col("bits") >= least_bits, F.struct("start", F.lit(KINDS.index("guess")).alias("kind"), "end"))).alias("added"), F.max("bits").alias("most_bits")
    )
    named = lambda x: F.struct(x["start"].alias("start"), F.get(F.array(*map(F.lit, KINDS)), x["kind"]).alias("kind"), x["end"].alias("end"))
    spans = F.array_sort(F.concat("base", F.coalesce("added", F.array().cast(span))))
    return found.select("doc_id", "row", "base").join(own, "row", "left").select("doc_id", F.transform(spans, named).alias("spans"), "most_bits")


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
