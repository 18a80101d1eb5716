"""Benchmark passages found in documents by an FM-index per shard, and the spans to remove.

A shard is some 600,000 words of documents that lie together; its index (``fm_index``) is built once, in
the task that reads them, and stored with the shard's word list. Test phrases are all windows of
``WINDOW`` words of the benchmark's items (an item of fewer words is one window), each distinct one once. They
go to the indexes in blocks of ``BLOCK`` windows: a block is all that passes the driver or is sent to tasks, and
all indexes are searched for it, backward word by word; no document or index is ever shuffled for that.
Occurrences are located by walks to sampled positions and merged into spans of words per document.

Words are runs of ASCII letters and digits, A-Z lower-cased, and of all other characters beyond ASCII.
A document of more words than a shard holds is cut into pieces that overlap by a window less one word, so no
occurrence is lost and memory does not grow with it.

Defined results: a null text and one without words have no words and no hits; a null item, or one without
words, has no window; items of the same id are one item; an item with a null id marks words but is not
listed. Repeated documents and null doc_ids are rows of their own. Empty tables give no rows, or rows without
hits. Other columns of either table are not read. There are no ties: every occurrence counts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tributary.llm.common import bucket_count, numbered, row_columns, stored, whole_row
from tributary.llm.fm_index import MOST, FMIndex
from tributary.operators.skew import sliced_join

WINDOW = 10
SHARD = 600_000
BLOCK = 200_000
TEXT = 4 << 20  # bytes of a text cut into words at a time

# Characters that end a word, and the lower case of those that do not.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FOLD = bytes(
    c if c > 127 or chr(c).isdigit() or chr(c) in LOWER else ord(chr(c).lower()) if chr(c) in UPPER else 32
    for c in range(256)
)

INDEX = (
    "shard long, size int, levels int, tree binary, totals binary, marked binary, samples binary, words binary,"
    " pieces array<struct<key:long,doc_id:{kind},at:int,offset:long,n_words:long>>"
)
HITS = "key long, spans array<struct<start:long,end:long>>, wins array<long>"


def _word_runs(text: bytes) -> Iterator[list[bytes]]:
    """A text's words, a few megabytes of it at a time."""
    at = 0
    while at < len(text):
        part = text[at:at + TEXT].translate(FOLD)
        cut = part.rfind(b" ") + 1
        while at + len(part) < len(text) and not cut:  # one word so far
            more = text[at + len(part):at + len(part) + TEXT].translate(FOLD)
            if (found := more.find(b" ")) >= 0:
                cut = len(part) + found + 1
            part += more
        if at + len(part) == len(text):
            cut = len(part)
        yield part[:cut].split()
        at += cut


class _Shard:
    """Documents gathered until they fill an index."""

    def __init__(self, shard: int):
        self.shard, self.size = shard, 0
        self.numbers: dict[bytes, int] = {}
        self.symbols: list[np.ndarray] = []
        self.pieces: list[tuple] = []

    def add(self, key: int, doc_id, offset: int, numbers: np.ndarray, n_words: int) -> None:
        self.pieces.append((key, doc_id, self.size, offset, n_words))
        if len(numbers):
            self.symbols += [numbers, np.zeros(1, dtype=np.int64)]
            self.size += len(numbers) + 1

    def number(self, words: list[bytes]) -> np.ndarray:
        numbers = self.numbers
        return np.fromiter((numbers.setdefault(w, len(numbers) + 1) for w in words), dtype=np.int64, count=len(words))

    def row(self) -> dict:
        symbols = np.concatenate(self.symbols) if self.symbols else np.zeros(1, dtype=np.int64)
        starts = np.array(sorted({p[2] for p in self.pieces if p[2] < len(symbols)}), dtype=np.int64)
        index = FMIndex.of(symbols, len(self.numbers) + 1, starts)
        return {
            "shard": self.shard, "size": index.size, "levels": len(index.tree), "tree": index.tree.tobytes(),
            "totals": index.totals.astype(np.int64).tobytes(), "marked": index.marked.tobytes(),
            "samples": index.samples.tobytes(), "words": b" ".join(self.numbers),
            "pieces": [dict(zip(("key", "doc_id", "at", "offset", "n_words"), p, strict=True)) for p in self.pieces],
        }


def _pieces(text: str | None, room: int, overlap: int) -> Iterator[tuple[int, int, list[bytes]]]:
    """(offset, own words, words) of a text in pieces of at most ``room`` words, each with the last ``overlap``
    words of the one before it."""
    offset, kept, own = 0, [], 0
    for run in _word_runs(text.encode("utf-8", "surrogatepass") if text else b""):
        while len(kept) + len(run) > room:
            take = room - len(kept)
            kept, own, run = kept + run[:take], own + take, run[take:]
            yield offset, own, kept
            tail = kept[len(kept) - overlap:]
            offset, kept, own = offset + len(kept) - len(tail), tail, 0
        kept += run
        own += len(run)
    yield offset, own, kept


def build(docs: DataFrame, window: int = WINDOW, shard_words: int = SHARD, key: str | None = None) -> DataFrame:
    """The stored indexes of ``docs`` (doc_id, text); ``key`` names a column that numbers the rows, if there is one."""
    if not window <= shard_words < MOST - 1:
        raise ValueError(f"shard_words must be from {window} to {MOST - 2}")
    kind = docs.schema["doc_id"].dataType
    schema = INDEX.format(kind=kind.simpleString())
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # numbers of shards and rows from the partition's own; once stored they are fixed
        base = TaskContext.get().partitionId() << 33
        shards, rows = base, base
        shard = _Shard(shards)
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            for i in range(batch.num_rows):
                number = batch.column(key)[i].as_py() if key else rows
                rows += 1
                doc_id = ids[i].as_py()
                for offset, own, words in _pieces(texts[i].as_py(), shard_words, window - 1):
                    if shard.size and shard.size + len(words) + 1 > shard_words + 1:
                        yield pa.RecordBatch.from_pylist([shard.row()], arrow)
                        shards += 1
                        shard = _Shard(shards)
                    shard.add(number, doc_id, offset, shard.number(words), own)
        if shard.pieces:
            yield pa.RecordBatch.from_pylist([shard.row()], arrow)

    wanted = docs.select(*([key] if key else []), "doc_id", "text")
    return stored(wanted.mapInArrow(run, schema), "fm-index")


def windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, win): every window of every item as its words in lower case, one space between them."""
    words = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(WORD), F.lit(0))
    found = benchmark.select("item_id", words.alias("_words")).where(F.size("_words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("_words") - window + 1, F.lit(1)))
    one = F.transform(starts, lambda i: F.array_join(F.slice("_words", i, F.lit(window)), " "))
    return found.select("item_id", F.explode(F.array_distinct(one)).alias("win")).distinct()


def _numbered(pairs: DataFrame) -> DataFrame:
    """(id, win): the distinct windows, numbered without gaps however they are dealt out."""
    wins = pairs.select("win").distinct().withColumn("_all", F.lit(0))
    rows = numbered(wins, ["_all"], ["win"], "id", bucket_count(pairs.count()))
    return stored(rows.select("id", "win"), "windows")


def _sent(ids: list[int], wins: list[str]) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
    """A block as it goes to the tasks: ids, the distinct words, and the windows as rows of places in that list."""
    place: dict[bytes, int] = {}
    rows = [[place.setdefault(w, len(place)) for w in win.encode("utf-8", "surrogatepass").split(b" ")] for win in wins]
    lengths = np.array([len(r) for r in rows], dtype=np.int64)
    table = np.zeros((len(rows), max(lengths, default=1)), dtype=np.int64)
    for i, row in enumerate(rows):
        table[i, :len(row)] = row
    return np.array(ids, dtype=np.int64), list(place), table, lengths


def _merge(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Spans that overlap or touch, as one."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.append(True, starts[1:] > ends[:-1])
    last = np.append(np.flatnonzero(new)[1:] - 1, len(starts) - 1)
    return list(zip(starts[new].tolist(), ends[last].tolist(), strict=True))


def search(index: DataFrame, sent: Broadcast) -> DataFrame:
    """(key, spans, wins) of the documents in which any window of the block ``sent`` occurs: spans of words, and
    the ids of the windows. A document in several shards has a row in each."""

    def hits(row: dict) -> Iterator[dict]:
        id_of, words, table, lengths = sent.value
        known = {w: i + 1 for i, w in enumerate(row["words"].split(b" "))} if row["words"] else {}
        here = np.array([known.get(w, 0) for w in words], dtype=np.int64)
        phrases = here[table]
        used = np.arange(table.shape[1]) < lengths[:, None]
        possible = np.flatnonzero(~((phrases == 0) & used).any(axis=1))
        index = FMIndex(
            row["size"], np.frombuffer(row["tree"], dtype=np.uint64).reshape(row["levels"], -1),
            np.frombuffer(row["totals"], dtype=np.int64), np.frombuffer(row["marked"], dtype=np.uint64),
            np.frombuffer(row["samples"], dtype=np.int32),
        )
        low, high = index.search(phrases[possible], lengths[possible])
        times = high - low
        if not times.sum():
            return
        window = np.repeat(possible, times)
        first = np.repeat(low - np.concatenate([[0], np.cumsum(times)[:-1]]), times)
        at = index.locate(first + np.arange(len(window)))
        pieces = [p for p in row["pieces"] if p["n_words"] or p["offset"]]
        starts = np.array([p["at"] for p in pieces])
        piece = np.searchsorted(starts, at, side="right") - 1
        order = np.argsort(piece, kind="stable")
        cuts = np.flatnonzero(np.append(True, np.diff(piece[order]) != 0))
        for a, b in zip(cuts, np.append(cuts[1:], len(order)), strict=True):
            group = order[a:b]
            p = pieces[piece[group[0]]]
            start = at[group] - p["at"] + p["offset"]
            yield {"key": p["key"], "spans": [{"start": s, "end": e} for s, e in _merge(start, start + lengths[window[group]])],
                   "wins": np.unique(id_of[window[group]]).tolist()}

    arrow = to_arrow_schema(T.StructType.fromDDL(HITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found = list(hits({c: batch.column(c)[i].as_py() for c in batch.schema.names}))
                if found:
                    yield pa.RecordBatch.from_pylist(found, arrow)

    pieces = F.transform("pieces", lambda p: F.struct(p["key"].alias("key"), p["at"].alias("at"), p["offset"].alias("offset"), p["n_words"].alias("n_words")))
    return index.select("size", "levels", "tree", "totals", "marked", "samples", "words", pieces.alias("pieces")).mapInArrow(run, HITS)


def merged(spans: DataFrame) -> DataFrame:
    """(key, spans) from rows (key, spans): sorted, and those that overlap or touch made one."""
    order = Window.partitionBy("key").orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = spans.select("key", F.inline("spans")).withColumn("new", F.coalesce(F.col("start") > before, F.lit(True)))
    one = rows.withColumn("island", F.count_if("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    islands = one.groupBy("key", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return islands.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))


def find(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_words: int = SHARD, block: int = BLOCK, key: str | None = None
) -> DataFrame:
    """(key, doc_id, n_words, spans, items) of every document: the spans of words to remove, and the ids of the
    items that occur, as text in code point order."""
    pairs = stored(windows(benchmark, window), "item-windows")
    placed = _numbered(pairs)
    index = build(docs, window, shard_words, key)
    found = None
    for first in range(0, placed.count(), block):
        rows = placed.where(F.col("id").between(first, first + block - 1)).collect()
        sent = docs.sparkSession.sparkContext.broadcast(_sent([r.id for r in rows], [r.win for r in rows]))
        hits = stored(search(index, sent), "window-hits")
        sent.destroy()
        found = hits if found is None else found.unionAll(hits)
    pieces = index.select(F.inline("pieces")).select("key", "doc_id", "n_words")
    rows = pieces.groupBy("key").agg(F.first("doc_id").alias("doc_id"), F.sum("n_words").alias("n_words"))
    if found is None:
        return rows.withColumn("spans", F.array().cast("array<struct<start:bigint,end:bigint>>")).withColumn(
            "items", F.array().cast("array<string>"))
    spans = merged(found)
    named = pairs.where("item_id IS NOT NULL").join(placed.select("id", "win"), "win").select("id", F.col("item_id").cast("string").alias("item"))
    met = found.select("key", F.explode("wins").alias("id")).distinct()
    counts = met.groupBy("id").agg(F.count("*").alias("n"))
    items = sliced_join(met, named, ["id"], ["key"], counts).groupBy("key").agg(F.array_sort(F.collect_set("item")).alias("items"))
    none = F.array()
    return rows.join(spans.join(items, "key", "left"), "key", "left").select(
        "key", "doc_id", "n_words", F.coalesce("spans", none).alias("spans"), F.coalesce("items", none).alias("items"))


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every document."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return find(docs, benchmark).select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def without_spans(text: str | None, spans: Sequence | None) -> str | None:
    """A text without the words of these spans and what stands between them."""
    if text is None or spans is None:
        return text
    raw = text.encode("utf-8", "surrogatepass")
    folded = np.frombuffer(raw.translate(FOLD), dtype=np.uint8) != 32
    edge = np.flatnonzero(np.diff(np.concatenate([[False], folded, [False]]).astype(np.int8)))
    begin, end = edge[::2], edge[1::2]
    kept, at = [], 0
    for span in spans:
        kept.append(raw[at:begin[span["start"]]])
        at = end[span["end"] - 1]
    return (b"".join(kept) + raw[at:]).decode("utf-8", "surrogatepass")


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The table with the hit spans cut out of its texts; all other rows and columns as they were."""
    rows = stored(docs.select(whole_row(docs)).withColumn("key", F.monotonically_increasing_id()), "keyed-documents")
    hit = find(rows.select("key", "doc.doc_id", "doc.text"), benchmark, window, key="key").where(F.size("spans") > 0).select("key", "spans")

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([without_spans(t, s) for t, s in zip(texts, spans, strict=True)], dtype=object)

    joined = rows.join(hit, "key", "left")
    return joined.select(*row_columns(docs, text=F.when(F.col("spans").isNull(), F.col("doc.text")).otherwise(cut("doc.text", "spans"))))
