"""URL filter: a sorted array of 64-bit digests, memory-mapped by the tasks.

A list entry is a host with a path prefix (``net/``, ``example.com/de/``) or a host alone. It fits the host
and its subdomains where the url's path starts with its path. Entries are hashed with XXH64; the sorted
digests, and the entries' strings in the same order, are three files that Spark distributes once to each
executor. Tasks map them into memory (one copy per machine, however many tasks), look all candidates of an
Arrow batch up in one vectorised binary search, and compare the stored string of each hit, so that two
strings with one digest are never taken for each other.

The array is for lists of at most ``max_entries`` rows (8 bytes and the string each). A longer list is not
shipped: candidates then meet it in a join (``judge_by_join``), with the same rows.

Defined results: a null url or one without ``://`` has an empty host and path, no rule and the verdict
``allow``; repeated rows stay; an empty list allows all; null keys of a list are dropped; equal entries count
once, ``block`` before ``allow``.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_ENTRIES = 5_000_000
#: The fixed rules: verdict, host, path.
RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]
#: Words that put a host on the list of the registered query (fixed values).
SPAM_WORDS = ["ads", "bets", "casino", "pills", "spam"]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOWER = str.maketrans(UPPER, LOWER)
_HOST, _PATH = re.compile(r"[^/?#]*"), re.compile(r"[^?#]*")


def host(url: Column) -> Column:
    """The host as a column expression."""
    after = F.when(F.instr(url, "://") > 0, F.substring_index(F.substr(url, F.instr(url, "://") + 3), "/", 1))
    return F.coalesce(F.translate(F.regexp_extract(after, r"^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def host_and_path(url: str | None) -> tuple[str, str]:
    at = url.find("://") if url else -1
    if at < 0:
        return "", ""
    found = _HOST.match(url, at + 3)
    return found[0].translate(_LOWER), _PATH.match(url, found.end())[0]


def rule_entries(spark) -> DataFrame:
    return spark.createDataFrame(
        [(h, p, v, True) for v, h, p in RULES], "host string, path string, verdict string, is_rule boolean"
    )


def listed_hosts(pages: DataFrame) -> DataFrame:
    """Hosts of a page table that have a spam word among the parts of their labels, as list entries."""
    word = r"(^|[.-])(" + "|".join(SPAM_WORDS) + r")([.-]|$)"
    hosts = pages.select(host(F.col("url")).alias("host")).where(F.col("host").rlike(word)).distinct()
    return hosts.select("host", F.lit("").alias("path"), F.lit("block").alias("verdict"),
                        F.lit(False).alias("is_rule"))


def _unique(entries: DataFrame) -> DataFrame:
    """One row per key; ``block`` wins over ``allow``, a rule over a listed host."""
    return (
        entries.where("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL")
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"), F.max("is_rule").alias("is_rule"))
    )


class DigestArray:
    """Sorted digests with the strings behind them."""

    def __init__(self, folder: str, name: str):
        part = lambda kind: np.load(os.path.join(folder, f"{name}-{kind}.npy"), mmap_mode="r")
        self.digests, self.ends, self.bytes, self.flags = part("digests"), part("ends"), part("bytes"), part("flags")

    @staticmethod
    def write(folder: str, name: str, keys: list[str], flags: list[int], digest=xxhash.xxh64_intdigest) -> list[str]:
        raw = [k.encode() for k in keys]
        digests = np.array([digest(k) for k in raw], dtype=np.uint64)
        order = np.argsort(digests, kind="stable")
        raw = [raw[i] for i in order]
        parts = {
            "digests": digests[order],
            "ends": np.cumsum([0, *map(len, raw)], dtype=np.int64),
            "bytes": np.frombuffer(b"".join(raw), dtype=np.uint8),
            "flags": np.array(flags, dtype=np.uint8)[order],
        }
        paths = [os.path.join(folder, f"{name}-{kind}.npy") for kind in parts]
        for path, values in zip(paths, parts.values(), strict=True):
            np.save(path, values)
        return paths

    def find(self, keys: list[bytes], digest=xxhash.xxh64_intdigest) -> np.ndarray:
        """Each key's place in the array, -1 where it isn't there."""
        found = np.full(len(keys), -1, dtype=np.int64)
        if not len(self.digests) or not keys:
            return found
        wanted = np.fromiter(map(digest, keys), dtype=np.uint64, count=len(keys))
        first = np.searchsorted(self.digests, wanted)
        inside = first < len(self.digests)
        hits = np.flatnonzero(inside & (self.digests[np.where(inside, first, 0)] == wanted))
        for i in hits:
            at = first[i]
            while at < len(self.digests) and self.digests[at] == wanted[i]:
                if self.bytes[self.ends[at]:self.ends[at + 1]].tobytes() == keys[i]:
                    found[i] = at
                    break
                at += 1
        return found


def _candidates(name: str, path: str, labels: int, lengths: list[int]) -> Iterator[tuple[str, str]]:
    """(host suffix, path prefix) of the lengths that entries have."""
    parts = name.split(".")
    for i in range(max(0, len(parts) - labels), len(parts)):
        suffix = ".".join(parts[i:])
        for n in lengths:
            if n <= len(path):
                yield suffix, path[:n]


def judge(pages: DataFrame, entries: DataFrame, max_entries: int = MAX_ENTRIES) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages`` (page_id, url).

    ``entries`` is (host, path, verdict, is_rule). The longest fitting rule decides; without one, a listed
    host blocks.
    """
    spark = pages.sparkSession
    rows = _unique(entries).limit(max_entries + 1).collect()  # bounded: the list, not the pages
    if len(rows) > max_entries:
        return judge_by_join(pages, entries)
    keys = [r.host + r.path for r in rows]
    flags = [(r.verdict == "block") + 2 * r.is_rule for r in rows]
    labels = max((r.host.count(".") + 1 for r in rows), default=0)
    lengths = sorted({len(r.path) for r in rows})
    name = f"digests-{uuid.uuid4().hex}"
    for path in DigestArray.write(tempfile.mkdtemp(prefix="digests-"), name, keys, flags):
        spark.sparkContext.addFile(path)  # Spark brings the driver's files to each executor

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = DigestArray(SparkFiles.getRootDirectory(), name)
        for batch in batches:
            urls = batch.column("url").to_pylist()
            split = [host_and_path(u) for u in urls]
            owner, probes = [], []
            for i, (h, p) in enumerate(split):
                for suffix, prefix in _candidates(h, p, labels, lengths):
                    owner.append(i)
                    probes.append((suffix + prefix).encode())
            at = array.find(probes)
            rule, verdict = [None] * len(urls), ["allow"] * len(urls)
            ruled = [-1] * len(urls)
            for k in np.flatnonzero(at >= 0):
                i, flag = owner[k], int(array.flags[at[k]])
                text = probes[k].decode()
                if flag & 2:
                    if len(text) > ruled[i]:
                        ruled[i], rule[i], verdict[i] = len(text), text, "block" if flag & 1 else "allow"
                elif ruled[i] < 0 and flag & 1:
                    verdict[i] = "block"
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), pa.array([h for h, _ in split], pa.string()),
                 pa.array([p for _, p in split], pa.string()), pa.array(rule, pa.string()),
                 pa.array(verdict, pa.string())],
                names=["page_id", "host", "path", "rule", "verdict"],
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url").mapInArrow(
        probe, f"page_id {kind}, host string, path string, rule string, verdict string"
    )


def judge_by_join(pages: DataFrame, entries: DataFrame) -> DataFrame:
    """The same rows for a list too long to ship: distinct (host, path) pairs meet the list in a join."""
    listed = _unique(entries)
    url = F.col("url")
    after = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))
    raw = F.regexp_extract(after, r"^[^/?#]*", 0)
    split = pages.select(
        "page_id", F.coalesce(F.translate(raw, UPPER, LOWER), F.lit("")).alias("host"),
        F.coalesce(F.regexp_extract(F.substr(after, F.length(raw) + 1), r"^[^?#]*", 0), F.lit("")).alias("path"),
    )
    shape = listed.agg(F.max(F.size(F.split("host", r"\."))).alias("labels"),
                       F.collect_set(F.length("path")).alias("lengths")).first()
    lengths = sorted(shape.lengths or [])
    parts = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(F.size(parts), F.lit(shape.labels or 1))),
        lambda n: F.array_join(F.slice(parts, -n, n), "."),
    )
    pairs = split.select("host", "path").distinct()
    probes = pairs.select("*", F.explode(suffixes).alias("_host")).select(
        "*", F.explode(F.array(*[F.lit(n) for n in lengths]) if lengths else F.array().cast("array<int>")).alias("_n")
    ).where(F.col("_n") <= F.length("path")).withColumn("_path", F.substring("path", F.lit(1), F.col("_n")))
    hits = probes.join(listed.select(F.col("host").alias("_host"), F.col("path").alias("_path"), "verdict", "is_rule"),
                       ["_host", "_path"])
    key = F.concat("_host", "_path")
    best = hits.groupBy("host", "path").agg(
        F.max(F.when(F.col("is_rule"), F.struct(F.length(key).alias("n"), key.alias("rule"), "verdict"))).alias("_rule"),
        F.max(F.when(~F.col("is_rule"), F.col("verdict"))).alias("_listed"),
    )
    return split.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("_rule.rule").alias("rule"),
        F.coalesce("_rule.verdict", "_listed", F.lit("allow")).alias("verdict"),
    )
