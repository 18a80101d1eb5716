"""SentencePiece encoding and decoding: a relational lattice.

Texts are cut into segments (words, see ``pieces``), and every distinct word is encoded once, by joins: all
substrings up to the longest piece are exploded, joined to the piece table on their text, the hits grouped
by word as edges of a lattice, and the best path folded with ``aggregate``. Exploding, the join with the
broadcast piece table (bounded by the vocabulary file) and the grouping all stay in the partitions of the
words: the lattice itself shuffles nothing.

Around it, documents are dealt into groups of about ``GROUP_BYTES`` of text by a hash of the row, as
compressed Arrow batches. A group sends its distinct words, sorted and joined to one message for each bucket of
words; a bucket encodes its distinct words once and answers every message with the ids of its words in the
order of the message, and the group puts its texts together. So a word that stands in every document travels
once per group, without a row or a place of its own. ``REGION`` groups share a set of buckets: a bucket has that many
messages at most, however large the table is, and a word is encoded once per region. Words are segments cut further,
between any two characters that stand side by side in no piece (``Cutter``): no piece goes across, so the best paths of
the parts make that of the whole, and different segments share their parts. A part of more than ``LONG``
characters is not a word of the table: the fold copies its state, so its time would grow with the square; such parts
are encoded in the group with the same rules by ``pieces.Viterbi``.

Decoding joins the bytes of the pieces; texts without U+2581 come back exactly.

Defined results: a null or empty text has no ids and decodes to an empty text; repeated rows are encoded
each; columns other than doc_id and text are not looked at, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm import pieces

GROUP_BYTES = 12 << 20
LONG = 64
REGION = 4096  # groups that share their dictionary
BUCKETS = 6  # of words, for each group of a region
HEAD = 3  # characters that tell which lengths are looked up
CHARACTERS = 1 << 18  # that are looked at a time

_viterbi: dict = {}
_cutters: dict = {}


def _local_viterbi(vocabulary: pieces.Vocabulary, path: str) -> pieces.Viterbi:
    if path not in _viterbi:
        _viterbi[path] = pieces.Viterbi(vocabulary)
    return _viterbi[path]


class Cutter:
    """Cuts tokens wherever no piece goes across: where two characters stand side by side in no piece. All cuts of
    ``Vocabulary.segments`` are among these. The table of pairs is bounded by the vocabulary's characters."""

    def __init__(self, vocabulary: pieces.Vocabulary):
        pairs = {p[i : i + 2] for p in vocabulary.score for i in range(len(p) - 1)}
        number = {c: n for n, c in enumerate(sorted(set("".join(pairs))), 1)}
        self.number = np.zeros(0x110000, dtype=np.int32)  # 0: in no pair
        self.number[[ord(c) for c in number]] = list(number.values())
        self.joined = np.zeros((len(number) + 1, len(number) + 1), dtype=bool)
        for a, b in pairs:
            self.joined[number[a], number[b]] = True

    def _stops(self, text: bytes, ends: np.ndarray) -> np.ndarray:
        """Where the parts of a text end, by bytes: at ``ends`` at least."""
        characters, stops, base = text.decode(), [], 0
        for at in range(0, len(characters), CHARACTERS):
            code = np.frombuffer(characters[at : at + CHARACTERS + 1].encode("utf-32-le"), dtype=np.uint32)
            number, here = self.number[code], code[:CHARACTERS]
            behind = base + np.cumsum(1 + (here > 0x7F) + (here > 0x7FF) + (here > 0xFFFF), dtype=np.int64)
            last = ends[np.searchsorted(ends, behind)] == behind
            last[: len(code) - 1] |= ~self.joined[number[:-1], number[1:]]
            stops.append(behind[last])
            base = int(behind[-1])
        return np.concatenate(stops)

    def parts(self, whole: pa.StringArray) -> Iterator[tuple[pa.StringArray, np.ndarray]]:
        """Some of the strings (none is empty) at a time: the parts of them all, and how many each has."""
        if not len(whole):
            return
        _, offsets, data = whole.buffers()
        ends = np.frombuffer(offsets, dtype=np.int32, count=len(whole) + 1, offset=4 * whole.offset).astype(np.int64)
        for a, b in _runs((ends[:-1] - ends[0]) // CHARACTERS):
            text, own = data.slice(int(ends[a]), int(ends[b] - ends[a])), ends[a + 1 : b + 1] - ends[a]
            stops = self._stops(text.to_pybytes(), own)
            starts = pa.py_buffer(np.append(0, stops).astype(np.int32))
            yield pa.StringArray.from_buffers(len(stops), starts, text), np.diff(np.searchsorted(stops, own, side="right"), prepend=0)

    def cut(self, tokens: list[str]) -> Iterator[tuple[list[str], np.ndarray]]:
        """The same of a list of tokens (``_tokens``)."""
        whole = [t[1:] if t[0] == " " else pieces.SPACE + t for t in tokens]
        for parts, sizes in self.parts(pa.array(whole, pa.string())):
            yield parts.to_pylist(), sizes


def _local_cutter(vocabulary: pieces.Vocabulary, path: str) -> Cutter:
    if path not in _cutters:
        _cutters[path] = Cutter(vocabulary)
    return _cutters[path]


def piece_table(spark, vocabulary: pieces.Vocabulary) -> DataFrame:
    rows = [(p, s, vocabulary.ids[p]) for p, s in vocabulary.score.items()]
    return spark.createDataFrame(rows, "piece string, score double, id int")


def beginnings(spark, vocabulary: pieces.Vocabulary) -> DataFrame:
    """(head, lengths): the lengths of the pieces that ``head`` begins with, or that begin with it, and 1."""
    lengths = defaultdict(set)
    for piece in vocabulary.score:
        if len(piece) >= HEAD:
            lengths[piece[:HEAD]].add(len(piece))
    rows = [(h, sorted({1, *more, *[n for n in range(1, HEAD) if h[:n] in vocabulary.score]})) for h, more in lengths.items()]
    return spark.createDataFrame(rows, "head string, lengths array<int>")


def edges(words: DataFrame, vocabulary: pieces.Vocabulary) -> DataFrame:
    """The columns of ``words`` with (start, end, score, id): every piece in every word, and characters without one (id -1).

    Substrings are of the lengths that pieces with their beginning have; both tables are bounded by the vocabulary."""
    table = F.broadcast(piece_table(words.sparkSession, vocabulary))
    heads = F.broadcast(beginnings(words.sparkSession, vocabulary))
    size, shorter = F.length("word"), F.array(*map(F.lit, range(1, HEAD)))
    starts = words.where(size > 0).select("*", F.explode(F.sequence(F.lit(0), size - 1)).alias("start"))
    spans = starts.withColumn("head", F.substring("word", F.col("start") + 1, F.lit(HEAD))).join(heads, "head", "left").select(
        *words.columns, "start", F.explode(F.coalesce("lengths", shorter)).alias("n")
    ).where(F.col("start") + F.col("n") <= size)
    found = spans.withColumn("piece", F.substring("word", F.col("start") + 1, F.col("n"))).join(table, "piece", "left").where(
        F.col("id").isNotNull() | (F.col("n") == 1)
    )
    return found.select(
        *words.columns, "start", (F.col("start") + F.col("n")).alias("end"),
        F.coalesce("score", F.lit(vocabulary.unknown_score)).alias("score"), F.coalesce("id", F.lit(-1)).alias("id"),
    )


def arrivals(lattice: Column) -> Column:
    """The best arrival (score, start, id) at each place of a word, from its edges sorted by end and start:
    an edge adds its place or, if strictly better, replaces the arrival there."""

    def step(best: Column, edge: Column) -> Column:
        total = F.get(best, edge["start"])["score"] + edge["score"]
        arrival = F.array(F.struct(total.alias("score"), edge["start"].alias("start"), edge["id"].alias("id")))
        return (
            F.when(F.size(best) == edge["end"], F.concat(best, arrival))
            .when(F.get(best, edge["end"])["score"] < total, F.concat(F.slice(best, F.lit(1), edge["end"]), arrival))
            .otherwise(best)
        )

    first = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(-1).alias("start"), F.lit(-1).alias("id")))
    return F.aggregate(lattice, first.cast("array<struct<score:double,start:int,id:int>>"), step)


def way_back(word: Column, places: Column, vocabulary: pieces.Vocabulary) -> Column:
    """The ids of the best path, from the arrivals; a character without a piece gives those of its bytes."""
    byte_ids = F.array(*map(F.lit, vocabulary.byte_ids))

    def as_bytes(start: Column) -> Column:
        digits = F.hex(F.substring(word, start + 1, F.lit(1)))
        code = lambda j: F.conv(F.substring(digits, 2 * j - 1, F.lit(2)), 16, 10).cast("int")
        return F.transform(F.sequence(F.lit(1), (F.length(digits) / 2).cast("int")), lambda j: F.element_at(byte_ids, code(j) + 1))

    def back(way: Column, _: Column) -> Column:
        here = F.get(places, way["at"])
        ids = F.when(here["id"] >= 0, F.array(here["id"])).otherwise(as_bytes(here["start"]))
        longer = F.struct(here["start"].alias("at"), F.concat(ids, way["ids"]).alias("ids"))
        return F.when(way["at"] > 0, longer).otherwise(way)

    start = F.struct((F.size(places) - 1).alias("at"), F.array().cast("array<int>").alias("ids"))
    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(places) - 1)), start, back, lambda way: way["ids"])


def encode_words(words: DataFrame, vocabulary: pieces.Vocabulary) -> DataFrame:
    """``words`` with ``ids``; its rows are distinct, their words not empty and of up to ``LONG`` characters."""
    keys = ["word", *[c for c in words.columns if c != "word"]]
    edge = F.struct("end", "start", "score", "id")
    # rows are sorted by the first key: by numbers in the order in which the words come apart, they are in order already
    numbered = words.withColumn("_n", F.monotonically_increasing_id())
    lattices = edges(numbered, vocabulary).groupBy("_n", *keys).agg(F.sort_array(F.collect_list(edge)).alias("lattice"))
    reached = lattices.select(*keys, arrivals(F.col("lattice")).alias("places"))
    return reached.select(*keys, way_back(F.col("word"), F.col("places"), vocabulary).alias("ids"))


# Documents


def _grouped(docs: DataFrame, groups: int) -> DataFrame:
    """(part, packed): compressed batches of (doc_id, text), each of one group."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))
        for batch in batches:
            part = batch.column("part").to_numpy()
            order = np.argsort(part, kind="stable")
            cuts = np.flatnonzero(np.diff(part[order], prepend=-1))
            names, packed = [], []
            for rows in np.split(order, cuts[1:]):
                if len(rows):
                    chosen = batch.select(["doc_id", "text"]).take(pa.array(rows))
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, chosen.schema, options=options) as writer:
                        writer.write_batch(chosen)
                    names.append(int(part[rows[0]]))
                    packed.append(sink.getvalue().to_pybytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int32()), pa.array(packed, pa.binary())], names=["part", "packed"]
            )

    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)).cast("int")
    return docs.select("doc_id", "text", part.alias("part")).mapInArrow(pack, "part int, packed binary")


def _unpacked(table: pa.Table) -> Iterator[pa.RecordBatch]:
    for packed in table.column("packed"):
        yield from pa.ipc.open_stream(packed.as_buffer())


def _dealt(words: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of a group's distinct words by bucket and hash, and the buckets in that order: the same
    whenever a task is run, in whatever order its rows come."""
    hashes = np.fromiter((xxhash.xxh64_intdigest(w.encode()) for w in words), dtype=np.uint64, count=len(words))
    bucket = (hashes % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((hashes, bucket))
    if np.any(hashes[order][1:] == hashes[order][:-1]):  # words of one hash come by their characters
        order = np.array(sorted(order.tolist(), key=lambda i: (bucket[i], hashes[i], words[i])), dtype=np.int64)
    return order, bucket[order]


def _runs(sorted_numbers: np.ndarray) -> Iterator[tuple[int, int]]:
    cuts = np.append(np.flatnonzero(np.diff(sorted_numbers, prepend=-1)), len(sorted_numbers))
    return zip(cuts[:-1], cuts[1:], strict=True)


def _gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The pieces of ``flat`` at ``starts`` of ``sizes``, one after another."""
    before = np.cumsum(sizes) - sizes
    return flat[np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))]


def _tokens(text: str | None, vocabulary: pieces.Vocabulary) -> list[str]:
    """What stands between the spaces of a text: cheaper than its segments, which are those of its tokens. Where
    they would not be (runs of spaces, the space piece itself) its segments, marked by a space before them."""
    tokens = text.split(" ") if text else []
    if text and (pieces.SPACE in text or "" in tokens):
        return [" " + segment for segment in vocabulary.segments(text)]
    return tokens


def _split(text: pa.StringArray, vocabulary: pieces.Vocabulary) -> tuple[pa.StringArray, np.ndarray]:
    """The tokens of all texts, marked by the space piece where ``_tokens`` marks them by a space, and how many each has.
    Only texts whose tokens are marked are looked at one by one."""
    text = text.cast(pa.string())
    text = pc.if_else(pc.equal(pc.binary_length(text), 0), pa.scalar(None, pa.string()), text)
    odd = pc.or_(pc.or_(pc.match_substring(text, "  "), pc.match_substring(text, pieces.SPACE)),
                 pc.or_(pc.starts_with(text, " "), pc.ends_with(text, " ")))
    if pc.any(odd).as_py():
        marked = [" ".join([pieces.SPACE + t[1:] for t in _tokens(x.as_py(), vocabulary)]) for x in text.filter(odd)]
        text = pc.replace_with_mask(text, odd.fill_null(False), pa.array(marked, pa.string()))
    lists = pc.split_pattern(text, " ")
    return lists.flatten(), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def _whole(tokens: pa.StringArray) -> pa.StringArray:
    """Tokens (``_split``) as the strings that are cut."""
    marked = pc.starts_with(tokens, pieces.SPACE)
    return pc.if_else(marked, pc.utf8_slice_codeunits(tokens, 1), pc.binary_join_element_wise(pieces.SPACE, tokens, ""))


def _coded(chunks: list[pa.Array]) -> tuple[pa.StringArray, list[np.ndarray]]:
    """The distinct strings of all chunks, and for every chunk their numbers."""
    coded = pa.chunked_array(chunks, pa.string()).dictionary_encode()
    known = coded.chunk(0).dictionary if coded.num_chunks else pa.array([], pa.string())
    numbers = np.concatenate([np.empty(0, dtype=np.int32), *[chunk.indices.to_numpy() for chunk in coded.chunks]])
    return known, np.split(numbers, np.cumsum(list(map(len, chunks)))[:-1]) if chunks else []  # empty chunks are not kept


class Spelling:
    """Compares ids with texts: the bytes of a text's ids are laid side by side."""

    def __init__(self, spelling: list[bytes]):
        self.spelling = spelling
        self.size = np.fromiter(map(len, spelling), dtype=np.int64, count=len(spelling))
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(spelling), dtype=np.uint8)

    def same(self, text: str, ids: np.ndarray) -> bool:
        """Whether ids decode to a text. Where their bytes are not the text's behind a space, they are decoded."""
        if len(ids) <= CHARACTERS and _gathered(self.flat, self.start[ids], self.size[ids]).tobytes() == b" " + text.encode():
            return True
        return pieces.decoded(ids.tolist(), self.spelling) == text


def _kept(vocabulary: pieces.Vocabulary) -> type:
    """The type of ids on their way."""
    return np.uint16 if len(vocabulary.pieces) < 1 << 16 else np.int32


def encode(docs: DataFrame, path: str = pieces.PATH, group_bytes: int = GROUP_BYTES, region: int = REGION,
           verify: bool = False) -> DataFrame:
    """(doc_id, ids, text_crc32) for every row of ``docs`` (doc_id, text); ``region`` groups share a dictionary.
    ``verify`` adds ``round_trip``: whether the ids, decoded where they are made, give the text."""
    spark = docs.sparkSession
    vocabulary = pieces.load(path)
    shared = spark.sparkContext.broadcast(vocabulary)  # bounded by its file
    spelling = spark.sparkContext.broadcast(pieces.spelled(vocabulary))  # the same
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(-(-size // group_bytes), 2 * spark.sparkContext.defaultParallelism)
    buckets = BUCKETS * min(groups, region)
    packed = _grouped(docs, groups)

    def ask(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        tokens = pc.unique(pa.chunked_array([_split(batch.column("text"), shared.value)[0] for batch in _unpacked(table)]))
        cut = _local_cutter(shared.value, path).parts(_whole(tokens))
        found = pc.unique(pa.chunked_array([parts for parts, _ in cut], pa.string()))
        words = found.filter(pc.less_equal(pc.utf8_length(found), LONG)).to_pylist()
        del tokens, found
        order, bucket = _dealt(words, buckets)
        first = part // region * buckets
        # no word has a space; the part leads the message, so that both readers of the exchange take the same column
        rows = [(first + int(bucket[a]), " ".join([str(part), *[words[i] for i in order[a:b]]])) for a, b in _runs(bucket)]
        return pa.table({"bucket": pa.array([b for b, _ in rows], pa.int32()), "message": pa.array([m for _, m in rows], pa.string())})

    messages = packed.groupBy("part").applyInArrow(ask, "bucket int, message string").repartition(
        buckets * -(-groups // region), "bucket")
    listed = F.split("message", " ")
    words = messages.select("bucket", F.explode(F.slice(listed, F.lit(2), F.size(listed))).alias("word")).distinct()
    known = encode_words(words, vocabulary)

    def reply(messages: pa.Table, known: pa.Table) -> pa.Table:
        place = {w.as_py(): i for i, w in enumerate(known.column("word"))}
        ids = known.column("ids").combine_chunks()
        flat = ids.flatten().to_numpy(zero_copy_only=False)
        sizes = ids.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        kept = _kept(shared.value)
        parts, counts, answers = [], [], []
        for message in messages.column("message"):
            part, *asked = message.as_py().split(" ")
            at = np.array([place[w] for w in asked], dtype=np.int64)
            parts.append(int(part))
            counts.append(sizes[at].astype(np.uint16).tobytes())  # at most four for each of LONG characters
            answers.append(_gathered(flat, starts[at], sizes[at]).astype(kept).tobytes())
        return pa.table({"part": pa.array(parts, pa.int32()), "bucket": messages.column("to"),
                         "counts": pa.array(counts, pa.binary()), "ids": pa.array(answers, pa.binary())})

    asked = messages.select(F.col("bucket").alias("to"), "message")
    replies = asked.groupBy("to").cogroup(known.groupBy("bucket")).applyInArrow(
        reply, "part int, bucket int, counts binary, ids binary")

    def answer(table: pa.Table, replies: pa.Table) -> pa.Table:
        vocabulary = shared.value
        split = [_split(batch.column("text"), vocabulary) for batch in _unpacked(table)]
        tokens, numbers = _coded([some for some, _ in split])
        numbered = [(n, np.concatenate(([0], np.cumsum(sizes)))) for n, (_, sizes) in zip(numbers, split, strict=True)]
        del split
        cut = list(_local_cutter(vocabulary, path).parts(_whole(tokens)))
        found, at = _coded([parts for parts, _ in cut])
        at = np.concatenate([np.empty(0, dtype=np.int32), *at])  # of each part
        token_ends = np.concatenate(([0], np.cumsum(np.concatenate([np.empty(0, dtype=np.int64), *[sizes for _, sizes in cut]]))))
        is_long = pc.greater(pc.utf8_length(found), LONG).to_numpy(zero_copy_only=False).astype(bool)
        words = found.to_pylist()
        del tokens, cut, found
        long, short = np.flatnonzero(is_long), np.flatnonzero(~is_long)
        order, _ = _dealt([words[i] for i in short], buckets)
        every = np.concatenate((short[order], long))
        here = [np.array(_local_viterbi(vocabulary, path).encode_array(words[i]), dtype=np.int32) for i in long]
        del words
        pa.default_memory_pool().release_unused()
        replies = replies.sort_by("bucket")
        joined = lambda name: b"".join(v.as_buffer() for v in replies.column(name))
        sizes, starts = np.zeros(len(every), dtype=np.int64), np.zeros(len(every), dtype=np.int64)
        sizes[every] = np.concatenate((np.frombuffer(joined("counts"), dtype=np.uint16), np.array(list(map(len, here)), dtype=np.int64)))
        starts[every] = np.cumsum(sizes[every]) - sizes[every]
        flat = np.concatenate([np.frombuffer(joined("ids"), dtype=_kept(vocabulary)).astype(np.int32), *here])
        # from the ids of the parts to those of the tokens
        flat = _gathered(flat, starts[at], sizes[at])
        ends = np.concatenate(([0], np.cumsum(sizes[at])))[token_ends]
        starts, sizes = ends[:-1], np.diff(ends)
        done, spelled = [], Spelling(spelling.value) if verify else None
        for batch, (at, stops) in zip(_unpacked(table), numbered, strict=True):
            ids = _gathered(flat, starts[at], sizes[at])
            stops = np.concatenate(([0], np.cumsum(sizes[at])))[stops]
            texts = [t.as_py() or "" for t in batch.column("text")]
            columns = {
                "doc_id": batch.column("doc_id"),
                "ids": pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.array(ids, pa.int32())),
                "text_crc32": pa.array([zlib.crc32(t.encode("utf-8", "surrogatepass")) for t in texts], pa.int64()),
            }
            if verify:
                spans = zip(texts, stops[:-1].tolist(), stops[1:].tolist(), strict=True)
                columns["round_trip"] = pa.array([spelled.same(t, ids[a:b]) for t, a, b in spans])
            done.append(pa.RecordBatch.from_pydict(columns))
        return pa.Table.from_batches(done)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return packed.groupBy("part").cogroup(replies.groupBy("part")).applyInArrow(
        answer, f"doc_id {kind}, ids array<int>, text_crc32 long{', round_trip boolean' if verify else ''}"
    )


def decode(encoded: DataFrame, path: str = pieces.PATH) -> DataFrame:
    """``encoded`` with ``text`` added, from its column ``ids``; null ids give a null text."""
    shared = encoded.sparkSession.sparkContext.broadcast(pieces.spelled(pieces.load(path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("ids")
            flat, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
            texts = [
                pieces.decoded(flat[a:b].tolist(), shared.value) if ok else None
                for a, b, ok in zip(ends[:-1], ends[1:], column.is_valid().to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "text"]
            )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(run, f"{kinds}, text string")
