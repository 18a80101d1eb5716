"""Token counts by count-only Viterbi.

Each text is cut into segments (see ``pieces``); a segment's count comes from dynamic programming over the
pieces that an Aho-Corasick automaton finds, carrying the best score and the piece count with the
tokenizer's tie rule, and no way back. Segments are counted once per text, and their counts are remembered
by the worker, up to ``MEMO`` short segments: the memory stays bounded and the results are the same.

Defined results: a null or empty text has no tokens; repeated rows are counted each; a long segment takes
time and memory in proportion to its length.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tributary.llm import pieces

MEMO = 1_000_000
SHORT = 64

_counters: dict = {}


class Counting:
    """Counts with a memory of segments already counted."""

    def __init__(self, vocabulary: pieces.Vocabulary):
        self.viterbi = pieces.Viterbi(vocabulary)
        self.known: dict[str, int] = {}

    def text(self, text: str | None) -> int:
        total, known = 0, self.known
        for segment, times in Counter(self.viterbi.vocabulary.segments(text)).items():
            n = known.get(segment)
            if n is None:
                n = self.viterbi.count(segment)
                if len(segment) <= SHORT:
                    if len(known) >= MEMO:
                        known.clear()
                    known[segment] = n
            total += times * n
        return total


def token_counts(docs: DataFrame, path: str = pieces.PATH) -> DataFrame:
    """(doc_id, n_tokens) for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(pieces.load(path))  # the vocabulary: bounded by its file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _counters:  # kept by the worker from task to task
            _counters[path] = Counting(shared.value)
        counting = _counters[path]
        for batch in batches:
            counts = [counting.text(x.as_py()) for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64())], names=["doc_id", "n_tokens"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long")
