"""URL filtering by a sorted digest array and host rules."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandweave.llm.wavelet import open_store, read_file, write_file
from strandweave.session import Cut, fresh_path

URL = re.compile(r"://([^/?#]*)([^?#]*)", re.S)
#: Words in a host name that mark it as junk, for lists that are taken from a table of pages.
JUNK_HOST = r"(^|[.-])(spam|ads|ad|porn|casino|malware|phish|track|tracker)([.-]|$)"
#: Parameters of a campaign in a url.
CAMPAIGN = r"[?&]utm_"
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def parse(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty for a null url or one without ``://``."""
    found = URL.search(url) if url else None
    return (found[1].translate(LOWER), found[2]) if found else ("", "")


def write_digests(entries: DataFrame, column: str, shard_rows: int = 2_000_000) -> DataFrame:
    """Files of sorted 64-bit xxhash keys with the full strings behind them; returns (path, low, high, n) per file.

    Entries are host names, or ``host/path`` prefixes. Null and empty entries are left out, repeated ones kept once.
    Keys are computed and dealt out by key range in Spark, so no list passes through the driver, and a task writes a
    file after about every ``shard_rows`` entries, which is all it holds. An empty list has no files.
    """
    out_dir = fresh_path(entries.sparkSession, "digests")

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            signed = np.array([xxhash.xxh64_intdigest(t.encode()) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(signed), batch.column(0)], ["key", "entry"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        number = 0

        def flush() -> pa.RecordBatch:
            nonlocal number
            table = pa.Table.from_batches(held)
            key, texts = table.column(0).to_numpy(), [t.encode() for t in table.column(1).to_pylist()]
            ends = np.cumsum([0, *map(len, texts)], dtype="<i8")
            path = f"{out_dir}/{TaskContext.get().partitionId():05d}-{number:04d}-{uuid.uuid4().hex[:8]}.dig"
            write_file(path, len(key).to_bytes(8, "little") + key.astype("<i8").tobytes() + ends.tobytes() + b"".join(texts))
            held.clear()
            number += 1
            return pa.RecordBatch.from_pylist([{"path": path, "low": int(key[0]), "high": int(key[-1]), "n": len(key)}])

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) >= shard_rows:
                yield flush()
        if held:
            yield flush()

    rows = entries.select(F.col(column).alias("entry")).where("entry is not null and entry <> ''").distinct()
    keyed = rows.mapInArrow(keys, "key long, entry string")
    return Cut(keyed.repartitionByRange("key").sortWithinPartitions("key", "entry").mapInArrow(write, "path string, low long, high long, n long"), "digest-files").df


#: Bytes of digest files that a worker keeps where files cannot be mapped; the file in use comes on top.
KEPT_BYTES = 256 << 20
_KEPT: dict[str, tuple[np.ndarray, np.ndarray, memoryview]] = {}


def digest_file(path: str) -> tuple[np.ndarray, np.ndarray, memoryview]:
    """Keys, string ends and strings: mapped where the store is a mounted file system, else read.

    Files that were read are kept up to KEPT_BYTES, the last used ones first.
    """
    store, inner = open_store(path)
    if store.type_name == "local":
        return _parts(np.memmap(inner, np.uint8, "r"))
    if (found := _KEPT.pop(path, None)) is None:
        found = _parts(np.frombuffer(read_file(path), np.uint8))
    _KEPT[path] = found
    size = lambda f: f[0].nbytes + f[1].nbytes + f[2].nbytes
    while len(_KEPT) > 1 and sum(map(size, _KEPT.values())) > KEPT_BYTES:
        _KEPT.pop(next(iter(_KEPT)))
    return found


def _parts(whole: np.ndarray) -> tuple[np.ndarray, np.ndarray, memoryview]:
    n = int(whole[:8].view("<i8")[0])
    return whole[8 : 8 + 8 * n].view("<i8"), whole[8 + 8 * n : 16 + 16 * n].view("<i8"), memoryview(whole[16 + 16 * n :])


def probe(files: list[tuple[str, int, int, int]], candidates: list[str]) -> np.ndarray:
    """Which candidates are listed: one vectorised binary search per file that may hold some, then the stored strings are compared.

    Candidates are looked up in order of their keys, so each file is opened once, whatever the number of files.
    """
    raw = [c.encode() for c in candidates]
    keys = np.array([xxhash.xxh64_intdigest(r) for r in raw], np.uint64).view(np.int64)
    order = np.argsort(keys, kind="stable")
    placed = keys[order]
    out = np.zeros(len(raw), bool)
    starts = np.searchsorted(placed, [f[1] for f in files], "left")
    stops = np.searchsorted(placed, [f[2] for f in files], "right")
    for (path, *_), start, stop in zip(files, starts.tolist(), stops.tolist(), strict=True):
        mine = order[start:stop]
        mine = mine[~out[mine]]
        if not len(mine):
            continue
        digests, ends, strings = digest_file(path)
        first, last = np.searchsorted(digests, keys[mine], "left"), np.searchsorted(digests, keys[mine], "right")
        for i, a, b in zip(mine[first < last].tolist(), first[first < last].tolist(), last[first < last].tolist(), strict=True):
            out[i] = any(strings[ends[k] : ends[k + 1]] == raw[i] for k in range(a, b))
    return out


def suffixes(host: str) -> list[str]:
    parts = host.split(".")
    return [".".join(parts[i:]) for i in range(len(parts))]


def listed_names(host: str, path: str) -> list[str]:
    """What of a url can be in the list: each domain above it, with each leading part of its path."""
    hosts = [s for s in suffixes(host) if s]
    cuts = [i for i, c in enumerate(path) if c == "/" and i] + [len(path)]
    return hosts + [s + path[:c] for s in hosts for c in dict.fromkeys(cuts) if path[:c] not in ("", "/")]


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], files: DataFrame) -> DataFrame:
    """Rows ``(page_id, host, path, rule, verdict)`` for every url.

    ``rules``: (verdict, host, path prefix); a rule holds for its host and all subdomains if the path starts with its
    path; the longest host + path decides (of equal ones, the first). Other urls are blocked if the digest files of
    ``write_digests`` hold one of their domains or path prefixes, else allowed. A null url and one without ``://`` have
    an empty host and path and are allowed; repeated rows stay. Only the list of files goes to the tasks, a row
    of some 100 bytes for every two million entries; the files are mapped where they are.
    """
    listing = sorted(((r["path"], r["low"], r["high"], r["n"]) for r in files.collect()), key=lambda f: f[1])
    by_host: dict[str, list[tuple[str, str]]] = {}
    for verdict, host, path in rules:
        by_host.setdefault(host, []).append((path, verdict))

    def ruled(host: str, path: str) -> tuple[str | None, str | None]:
        found = [(len(s) + len(p), s + p, v) for s in suffixes(host) if host for p, v in by_host.get(s, ()) if path.startswith(p)]
        best = max(found, key=lambda x: x[0], default=(0, None, None))
        return best[1], best[2]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parsed = [parse(url) for url in batch.column(1).to_pylist()]
            got = [ruled(*p) for p in parsed]
            names = [listed_names(*p) if rule is None else [] for p, (rule, _) in zip(parsed, got, strict=True)]
            flat = list(dict.fromkeys(n for own in names for n in own))
            bad = {n for n, hit in zip(flat, probe(listing, flat), strict=True) if hit} if flat else set()
            verdicts = [v or ("allow" if bad.isdisjoint(own) else "block") for (_, v), own in zip(got, names, strict=True)]
            columns = [[p[0] for p in parsed], [p[1] for p in parsed], [r for r, _ in got], verdicts]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.string()) for c in columns)], ["page_id", "host", "path", "rule", "verdict"])

    rows = pages.select("page_id", "url")
    return rows.mapInArrow(work, f"page_id {rows.schema['page_id'].dataType.simpleString()}, host string, path string, rule string, verdict string")


def listed_entries(pages: DataFrame, least_urls: int = 2, percent: int = 30) -> DataFrame:
    """(entry): hosts of a page table to list, by what all their urls together show.

    Those that name themselves as junk by ``JUNK_HOST``, and those of ``least_urls`` urls or more of which ``percent``
    in a hundred or more carry campaign parameters. Null urls and empty hosts are left out.
    """
    host = F.translate(F.regexp_extract("url", r"://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    seen = pages.select(host.alias("entry"), F.col("url").rlike(CAMPAIGN).alias("marked")).where("entry <> ''")
    sums = seen.groupBy("entry").agg(F.count("*").alias("n"), F.count_if("marked").alias("k"))
    return sums.where(F.col("entry").rlike(JUNK_HOST) | ((F.col("n") >= least_urls) & (100 * F.col("k") >= percent * F.col("n")))).select("entry")
