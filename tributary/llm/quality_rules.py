"""Quality rules per document, and per host from the documents' failures.

Every document is measured and judged by itself (``base_failed``). Failures are then added up per host (the
``source``); the hosts' rates are shrunk towards the overall rate by a beta prior fitted to all hosts by the
method of moments, so that a host with few documents is not judged by them alone; a host whose shrunk rate
is above ``max_host_rate`` has all its documents dropped.

DataFrame functions only. A text is measured inside its own row: no words or windows are shuffled. Window
hashes are compared in a hash set first, and only texts with a repeat sort theirs.

Defined results: a null text has no words and fails; a null source is no host, its documents are judged by
themselves; repeated rows stay and count each; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import SPACE, stored

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MAX_HOST_RATE = 0.5
SYMBOLS = "#*$%&|<>"


def _words(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def measure(docs: DataFrame) -> DataFrame:
    """(doc_id, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.trim(line, F.lit(SPACE)) != "")
    counted = docs.select(
        "doc_id", "source", _words(text).alias("words"), lines.alias("lines"),
        F.length(_without(text, SPACE)).cast("long").alias("word_chars"),
        (F.length(text) - F.length(_without(text, SYMBOLS))).cast("long").alias("n_symbols"),
    ).select(
        "doc_id", "source", "word_chars", "n_symbols", F.size("words").cast("long").alias("n_words"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    at = lambda i: F.xxhash64(*[F.get("hashes", i + k) for k in range(WINDOW)])
    windows = F.when(
        F.col("n_words") >= WINDOW, F.transform(F.sequence(F.lit(0), F.size("hashes") - WINDOW), at)
    )
    windowed = counted.withColumn("windows", windows).drop("hashes")
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    by_hash = F.sort_array(F.transform("windows", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    ordered = windowed.withColumn("ordered", F.when(repeats, by_hash)).drop("windows")

    def twice(x: Column, j: Column) -> Column:
        same = lambda k: F.coalesce(F.get("ordered", k)["w"] == x["w"], F.lit(False))
        return same(j - 1) | same(j + 1)

    starts = F.sort_array(F.transform(F.filter("ordered", twice), lambda x: x["i"]))
    covered = F.aggregate(
        starts,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")),
        lambda acc, i: F.struct(
            (acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).cast("long").alias("n"), i.alias("last")
        ),
        lambda acc: acc["n"],
    )
    done = ordered.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("ordered")
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    return done.withColumn("base_failed", failed)


def host_rates(measured: DataFrame) -> DataFrame:
    """(source, n, failed, host_rate): the shrunk failure rate of each host.

    With overall rate m and the variance v of the hosts' rates beyond binomial noise, the prior is
    beta(m k, (1 - m) k) with k = m (1 - m) / v - 1, at least 1; without excess variance k is 1e6.
    """
    hosts = measured.where("source IS NOT NULL").groupBy("source").agg(
        F.count("*").alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failed")
    )
    total = hosts.agg(
        F.sum("n").alias("all_n"), F.count("*").alias("hosts"),
        (F.sum("failed") / F.sum("n")).alias("m"),
        (F.sum(F.col("failed") * F.col("failed") / F.col("n")) / F.sum("n")).alias("square"),
    )
    noise = F.col("m") * (1 - F.col("m"))
    excess = F.col("square") - F.col("m") * F.col("m") - noise * F.col("hosts") / F.col("all_n")
    strength = F.when(excess > 1e-9, F.greatest(noise / excess - 1, F.lit(1.0))).otherwise(F.lit(1e6))
    prior = total.select("m", strength.alias("k"))
    # one row with the prior meets every host
    return hosts.withColumn("_one", F.lit(1)).join(prior.withColumn("_one", F.lit(1)), "_one").select(
        "source", "n", "failed",
        ((F.col("failed") + F.col("m") * F.col("k")) / (F.col("n") + F.col("k"))).alias("host_rate"),
    )


def judge(docs: DataFrame, max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The measures of every document with ``host_rate`` and ``kept``."""
    measured = stored(measure(docs), "quality-rules")
    rates = host_rates(measured).select("source", "host_rate")
    bad_host = F.coalesce(F.col("host_rate") > max_host_rate, F.lit(False))
    return measured.join(rates, "source", "left").withColumn("kept", ~F.col("base_failed") & ~bad_host)
