"""PII surrogates: keyed replacements of the same type, gender, script and format, checked for collisions."""

from __future__ import annotations

import hashlib
import re
import unicodedata
import uuid
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from strandweave.session import Cut

# Given names by script and gender, words before a name with the gender they tell, and endings of
# surnames that differ by gender.
GIVEN = {
    ("latin", "f"): "Mary Patricia Jennifer Elizabeth Margaret Susan Jessica Françoise Isabelle Camille Brigitte Wolfgard Heike Ulrike Guadalupe Lucía Mercedes Fatima".split(),
    ("latin", "m"): "James Robert Michael William Richard Thomas Christopher François Jacques Guillaume Jürgen Wolfgang Günther Javier Alejandro Santiago Mohammed Ibrahim".split(),
    ("cyrillic", "f"): "Мария Анна Елена Ольга Наталья Татьяна Ирина Светлана".split(),
    ("cyrillic", "m"): "Иван Алексей Дмитрий Сергей Андрей Николай Михаил Владимир".split(),
}
TITLES = {
    "m": "Mr Herr Monsieur Señor Sr Signor Senhor Господин Κύριος".split(),
    "f": "Mrs Ms Miss Frau Madame Mme Señora Sra Signora Senhora Госпожа Κυρία".split(),
    "n": "Dr Prof Доктор".split(),
}
PHRASES = ["my name is", "My name is", "mein Name ist", "Mein Name ist", "ich heiße", "Ich heiße", "je m'appelle", "Je m'appelle", "mon nom est", "Mon nom est", "me llamo", "Me llamo", "mi nombre es", "Mi nombre es", "меня зовут", "Меня зовут"]
ENDINGS = "ская цкая ский цкий ова ева ёва ина ына ов ев ёв ин ын ová ova eva ská ska cká cka ský ski cký cki dóttir sson ides idis ου ης ος".split()
# End of fixed values.

SYLLABLES = {
    "latin": ("b d f g h k l m n p r s t v w".split(), "a e i o u".split()),
    "cyrillic": ("б в г д ж к л м н п р с т".split(), "а е и о у".split()),
    "greek": ("β γ δ ζ θ κ λ μ ν π ρ τ φ".split(), "α ε ι ο υ".split()),
}
_KIND_OF_NAME = {name: (script, gender) for (script, gender), names in GIVEN.items() for name in names}
_GENDER_OF_TITLE = {title: gender for gender, titles in TITLES.items() for title in titles}
#: Words one of which a text without any phrase must hold to have a name.
_CUES = frozenset([*_KIND_OF_NAME, *_GENDER_OF_TITLE])
_WORD = re.compile(r"\w+")
_TITLE_WORD = rf"(?:{'|'.join(_GENDER_OF_TITLE)})(?!\w)"
#: A capitalised word, or one of a script without case, with further ones behind hyphens or apostrophes.
_NAME_WORD = rf"(?!{_TITLE_WORD})[\p{{Lu}}\p{{Lt}}\p{{Lo}}][\p{{L}}\p{{M}}]*(?:[-'’][\p{{Lu}}\p{{Lo}}][\p{{L}}\p{{M}}]*)*"
_CUED = regex.compile(
    rf"(?<!\w)(?:(?P<title>(?:{_TITLE_WORD}\.? )+)|(?P<phrase>(?:{'|'.join(PHRASES)}) )|(?=(?:{'|'.join(_KIND_OF_NAME)}) ))(?P<names>{_NAME_WORD}(?: {_NAME_WORD}){{0,2}})(?![\p{{L}}\p{{M}}])"
)
_NAMES = regex.compile(rf"(?<![\p{{L}}\p{{M}}\p{{N}}_])(?:{_NAME_WORD})(?![\p{{L}}\p{{M}}\p{{N}}_])")
_EMAIL = re.compile(r"[\w.%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_SECRET = re.compile(r"(?i)(?<!\w)(?:password|passwd|pwd|passphrase|secret|token|api[_-]?key|access[_-]?key)\"?[ \t]*[=:][ \t]*(?:\"([^\"\n]{4,})\"|'([^'\n]{4,})'|([^\s\"',;<>]{6,}))")
_DIGITS = re.compile(
    r"""(?P<ip>(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\w|\.\d))
    |(?P<key>(?<![A-Za-z0-9])(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{20,}|xox[abp]-[A-Za-z0-9-]{10,}|AIza[\w-]{30,}|sk-[A-Za-z0-9]{20,})(?![A-Za-z0-9]))
    |(?P<hex>(?<![A-Za-z0-9])(?=[0-9]*[a-f])(?=[a-f]*[0-9])[0-9a-f]{18,}(?![A-Za-z0-9]))
    |(?P<iban>(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))
    |(?P<card>(?<![\w.])[3-6]\d{3}(?:[ -]?\d{4}){2}[ -]?\d{3,7}(?!\w))
    |(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))
    |(?P<phone>(?<![\w.])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\w)|(?<![\w.])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\w)|(?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-]))""",
    re.X,
)
_ANY_DIGIT = re.compile("[0-9]")


def detect(text: str | None) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, value) of the entities of a text, in order and without overlap; the first to start wins, then the earlier kind.

    Names are the up to three capitalised words behind a title or a phrase such as "my name is", and those that start
    with a listed given name; the last of several is the surname. Where one of them stands elsewhere in the text, before
    or behind, it is the same entity. Card numbers must pass the Luhn check. Quoted secrets have four characters at
    least, bare ones six, and no upper bound; those without a letter or digit are masks and left alone.
    """
    if not text:
        return []
    found: list[tuple[int, int, str]] = []
    if "@" in text:
        found += [(m.start(), m.end(), "email") for m in _EMAIL.finditer(text)]
    if "=" in text or ":" in text:
        found += [(*m.span(m.lastindex), "secret") for m in _SECRET.finditer(text) if any(c.isalpha() or c.isdecimal() for c in m[m.lastindex])]
    if _ANY_DIGIT.search(text):
        found += [(m.start(), m.end(), m.lastgroup) for m in _DIGITS.finditer(text) if m.lastgroup != "card" or luhn(_PUNCTUATION.sub("", m[0]))]
    if any(p in text for p in PHRASES) or not _CUES.isdisjoint(_WORD.findall(text)):
        found += _names(text)
    out, end = [], 0
    for start, stop, kind in sorted(found, key=lambda x: x[0]):
        if start >= end:
            out.append((start, stop, kind, text[start:stop]))
            end = stop
    return out


def _names(text: str) -> list[tuple[int, int, str]]:
    known: dict[str, str] = {}
    for m in _CUED.finditer(text):
        words = m["names"].split(" ")
        if len(words) == 1 and not m["title"] and not m["phrase"]:
            continue
        title = next((g for t in (m["title"] or "").replace(".", "").split() if (g := _GENDER_OF_TITLE[t]) != "n"), "n")
        given = words[:-1] if len(words) > 1 or m["title"] else words
        for word in given:
            kind = "given:{}:{}".format(*_KIND_OF_NAME[word]) if word in _KIND_OF_NAME else f"forename:{script_of(word[0])}:{title}"
            known.setdefault(word, kind)
            known.setdefault(word.upper(), kind)
        if len(words) > len(given):
            for form in (words[-1], words[-1].upper()):
                known.setdefault(form, f"surname:{script_of(words[-1][0])}")
    return [(m.start(), m.end(), known[m[0]]) for m in _NAMES.finditer(text) if m[0] in known] if known else []


@lru_cache(maxsize=4096)
def script_of(c: str) -> str:
    """The script of a letter, by the first word of its Unicode name."""
    return unicodedata.name(c, "unknown").split()[0].lower()


@lru_cache(maxsize=65536)
def alphabet(c: str) -> tuple[str, ...]:
    """What a letter may turn into: letters of its script and case, of its run of 256 characters."""
    if script_of(c) == "latin":
        letters = "abcdefghijklmnopqrstuvwxyz"
        return tuple(letters.upper() if c.isupper() else letters)
    start, kind = ord(c) & ~0xFF, unicodedata.category(c)
    near = tuple(x for x in map(chr, range(start, start + 256)) if unicodedata.category(x) == kind and script_of(x) == script_of(c) and not unicodedata.decomposition(x))
    return near if len(near) > 1 else (c,)


def norm(kind: str, value: str) -> str:
    """What makes two mentions one entity: e-mail addresses and names regardless of case, numbers by their digits.

    Listed given names stand in their own spelling.
    """
    if kind in ("phone", "card", "ssn", "iban"):
        return _PUNCTUATION.sub("", value)
    if kind.startswith("given"):
        return value if value in _KIND_OF_NAME else value.capitalize()
    return value.lower() if kind == "email" or kind.startswith(("surname", "forename")) else value


_PUNCTUATION = re.compile(r"[ .()-]")


def _stream(key: str, *parts: object, size: int = 64) -> bytes:
    return hashlib.shake_256("\0".join([key, *map(str, parts)]).encode()).digest(size)


def _shaped(value: str, noise: bytes, hexadecimal: bool = False) -> str:
    """Another string of the same shape: digit for digit, letter for letter of the same script and case, the rest as it is."""
    out = []
    for c, b in zip(value, noise, strict=False):
        if hexadecimal and c in "0123456789abcdef":
            out.append("0123456789abcdef"[b % 16])
        elif c.isdecimal():
            out.append(str(b % 10))
        elif c.isalpha():
            letters = alphabet(c)
            out.append(letters[b % len(letters)])
        else:
            out.append(c)
    return "".join(out)


def _name_part(part: str, script: str, noise: bytes, more: int, ending: str) -> str:
    """A made-up name in place of one part of a name: syllables where the script's are known, else letters of it."""
    if script not in SYLLABLES:
        return _shaped(part + part[-1] * more, noise)
    heads, tails = SYLLABLES[script]
    count = max(3, len(part) // 2) + more
    body = "".join(heads[noise[2 * i] % len(heads)] + tails[noise[2 * i + 1] % len(tails)] for i in range(count))
    return body[: -1 if ending and ending[0] in "aeiouаеёиоуαειουάέίόύ" else None] + (ending or heads[noise[-1] % len(heads)])


def _name(kind: str, value: str, key: str, attempt: int) -> str:
    """A name of the same script, parts and gender; longer by a syllable after every fourth attempt."""
    script, gender = kind.split(":")[1], kind.split(":")[-1]
    out = []
    for i, part in enumerate(re.split(r"([-'’ ])", value)):
        if i % 2 or not part:
            out.append(part)
            continue
        ending = next((e for e in ENDINGS if part.endswith(e) and len(part) >= len(e) + 2), "") if kind.startswith("surname") else {"f": {"latin": "a", "cyrillic": "а", "greek": "α"}.get(script, "")}.get(gender, "")
        stem = part[: len(part) - len(ending)] if kind.startswith("surname") else part  # one family, whatever the gender
        noise = _stream(key, kind, stem, attempt, i, size=64 + 2 * len(part) + 2 * attempt)
        out.append(_name_part(stem, script, noise, attempt // 4, ending))
    return "".join(out)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _candidate(kind: str, value: str, key: str, attempt: int) -> str:
    """value: normalised. The surrogate of an entity in normal form; its mentions take on their own punctuation.

    From the sixth attempt on a shape that can be short (secrets, local parts of e-mail addresses, phone numbers) gets
    longer by two characters an attempt, so that it cannot run out; from the fortieth on, every shape but that of an IP
    address does, of which there are four thousand million.
    """
    more = 2 * max(0, attempt % 1000 - (5 if kind in ("secret", "email", "phone") else 40))
    filler = "0" if kind in ("phone", "card", "ssn", "iban", "hex") else "a"
    longer = _shaped(filler * more, _stream(key, kind, value, attempt, "more", size=more)) if more else ""
    noise = _stream(key, kind, value, attempt, size=max(64, len(value)))
    family, _, rest = kind.partition(":")
    if family == "given":
        names = GIVEN[tuple(rest.split(":"))]
        order = sorted(names, key=lambda n: _stream(key, rest, n))
        return order[(order.index(value) + 1) % len(order)]  # a cycle over the names of one script and gender
    if family in ("surname", "forename"):
        return _name(kind, value, key, attempt)
    if kind == "email":
        local, _, domain = value.partition("@")
        labels = domain.split(".")
        fixed = 2 if len(labels) > 2 else 1
        own = ".".join(labels[:-fixed])
        return _shaped(local, noise) + longer + "@" + ".".join([_shaped(own, _stream(key, "domain", domain, size=len(own) + 1)), *labels[-fixed:]])
    if kind == "ip":
        return ".".join(str(1 + b % 254) for b in noise[:4])
    if kind == "key":
        head = re.match(r"AKIA|ASIA|gh[pousr]_|xox[abp]-|AIza|sk-", value)[0]
        return head + _shaped(value[len(head) :], noise) + longer
    if kind == "iban":
        return value[:2] + _shaped(value[2:], noise) + longer
    if kind == "card":
        body = value[0] + _shaped(value[1:-1], noise) + longer
        return next(body + d for d in "0123456789" if luhn(body + d))
    if kind == "phone":
        head = re.match(r"\+1|\+\d{2}|", value)[0]
        body = _shaped(value[len(head) :], noise)
        return head + (str(2 + noise[-1] % 8) + body[1:] if body[0] in "01" else body) + longer
    hexadecimal = bool(re.fullmatch("[0-9a-f]+", value)) and not value.isdecimal()
    return _shaped(value, noise, hexadecimal) + longer


def surrogate(kind: str, value: str, key: str, attempt: int = 0) -> str:
    """The surrogate of a normalised value; never the value itself as long as the shape leaves a choice."""
    for again in range(8):
        new = _candidate(kind, value, key, attempt + 1000 * again)
        if new != value:
            break
    return new


def fitted(kind: str, mention: str, new: str) -> str:
    """``new`` with the punctuation and case of a mention."""
    if kind in ("phone", "card", "ssn", "iban"):
        rest = iter(new.replace("+", ""))
        return "".join([c if c in " .()-+" else next(rest) for c in mention] + list(rest))
    if kind.startswith(("surname", "forename", "given")):
        return new.upper() if mention.isupper() and len(mention) > 1 else re.sub(r"[^-'’ ]+", lambda m: m[0].capitalize(), new)
    return new


def entities(docs: DataFrame, key: str) -> DataFrame:
    """Distinct (kind, value, surrogate) of all texts; values in normal form, surrogates of the first attempt."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = {(kind, norm(kind, value)) for at in range(0, batch.num_rows, 512) for text in batch.column(0).slice(at, 512).to_pylist() for _, _, kind, value in detect(text)}
            yield _rows((kind, value, surrogate(kind, value, key)) for kind, value in own)

    return docs.select("text").mapInArrow(work, "kind string, value string, surrogate string").distinct()


def _rows(rows) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["kind", "value", "surrogate"])


def collisions(fresh: DataFrame, taken: DataFrame) -> DataFrame:
    """Rows of ``fresh`` whose surrogate another entity holds: one of ``taken``, a real value, or a smaller one of ``fresh``."""
    owner = fresh.groupBy("surrogate").agg(F.min(F.struct("kind", "value")).alias("owner"))
    twice = fresh.join(owner, "surrogate").where(F.struct("kind", "value") != F.col("owner"))
    held = taken.select(F.explode(F.array("surrogate", "value")).alias("surrogate")).distinct()
    both = fresh.where(~F.col("kind").startswith("given")).join(held, "surrogate", "left_semi")
    return twice.select("kind", "value").unionByName(both.select("kind", "value")).distinct()


def settle(found: DataFrame, key: str) -> DataFrame | None:
    """(kind, value, surrogate) of the entities whose first surrogate collides, with one that does not; None if none does.

    Given names are permuted within their script and gender and so never collide with one another. Each round gives the
    colliding entities their next surrogate and checks those against all surrogates and all real values, until none
    collides; as shapes get longer, that comes to an end.
    """
    values = found.select("kind", "value", F.col("value").alias("surrogate"))
    todo = Cut(collisions(found, values), "collisions")
    if todo.df.isEmpty():
        todo.drop()
        return None
    first = todo.df
    settled: Cut | None = None
    free = found.join(first, ["kind", "value"], "left_anti")
    for attempt in count(1):

        def work(batches: Iterator[pa.RecordBatch], attempt: int = attempt) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield _rows((k, v, surrogate(k, v, key, attempt)) for k, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))

        fresh = Cut(todo.df.mapInArrow(work, "kind string, value string, surrogate string"), "surrogates")
        taken = free.unionByName(values) if settled is None else free.unionByName(values).unionByName(settled.df)
        again = Cut(collisions(fresh.df, taken), "collisions")
        good = fresh.df.join(again.df, ["kind", "value"], "left_anti")
        held, settled = settled, Cut(good if settled is None else settled.df.unionByName(good), "settled")
        for old in (held, fresh, todo if attempt > 1 else None):
            if old is not None:
                old.drop()
        if again.df.isEmpty():
            return settled.df
        todo = again


def _replace(text: str | None, key: str, special: dict[tuple[str, str], str], memory: dict) -> tuple[str | None, int]:
    spans = detect(text)
    if not spans:
        return text, 0
    out, at = [], 0
    for start, end, kind, value in spans:
        entity = (kind, norm(kind, value))
        new = special.get(entity) or memory.get(entity)
        if new is None:
            if len(memory) > 100_000:
                memory.clear()
            new = memory[entity] = surrogate(*entity, key)
        out += [text[at:start], fitted(kind, value, new)]
        at = end
    return "".join([*out, text[at:]]), len(spans)


def pseudonymise(docs: DataFrame, key: str, most_broadcast: int = 50_000) -> DataFrame:
    """``docs`` with every detected entity of ``text`` replaced, and ``n_entities`` (long): how many were, per row.

    One entity has one surrogate everywhere, and two entities never the same: surrogates are drawn by ``key`` alone,
    checked over all texts, and only those that collide are drawn again. These few go to the tasks if they are at most
    ``most_broadcast`` rows; beyond that they are joined to the texts that need them, with the same result. Texts are
    read twice and not shuffled in the first case. A null text stays null with 0; texts without entities are unchanged;
    an empty table stays empty; repeated rows and other columns of any name stay, a column ``n_entities`` is replaced.
    """
    docs = docs.drop("n_entities")
    found = Cut(entities(docs, key), "entities")
    special = settle(found.df, key)
    found.drop()
    names = docs.columns
    at = names.index("text")
    few = special is None or special.limit(most_broadcast + 1).count() <= most_broadcast
    small = {(r["kind"], r["value"]): r["surrogate"] for r in special.collect()} if special is not None and few else {}
    rows = docs if few else _with_own(docs, special)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict = {}
        for batch in batches:
            texts, n = [], []
            own = batch.column(len(names)).to_pylist() if not few else [None] * batch.num_rows
            for i, text in enumerate(batch.column(at).to_pylist()):
                chosen = {(e["kind"], e["value"]): e["surrogate"] for e in own[i] or ()} if not few else small
                new, count = _replace(text, key, chosen, memory)
                texts.append(new), n.append(count)
            columns = [batch.column(i) for i in range(len(names))]
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n, pa.int64())], [*names, "n_entities"])

    return rows.mapInArrow(work, StructType([*docs.schema.fields, StructField("n_entities", LongType())]))


def _with_own(docs: DataFrame, special: DataFrame) -> DataFrame:
    """``docs`` and, behind its columns, the special surrogates of each text's entities, joined by the text's digest."""
    digest, own = (f"{x}_{uuid.uuid4().hex}" for x in ("digest", "own"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {(d, kind, norm(kind, value)) for d, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for _, _, kind, value in detect(text)}
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in list(zip(*found, strict=True)) or [(), (), ()]], ["digest", "kind", "value"])

    keyed = docs.withColumn(digest, F.sha2("text", 256))
    named = keyed.select(digest, "text").mapInArrow(work, "digest string, kind string, value string").distinct()
    lists = named.join(special, ["kind", "value"]).groupBy(F.col("digest").alias(digest)).agg(F.collect_list(F.struct("kind", "value", "surrogate")).alias(own))
    return keyed.join(lists, digest, "left").select(*docs.columns, own)
