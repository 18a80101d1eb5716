"""A SentencePiece vocabulary read as a unigram model, and Viterbi over it.

A text becomes ``▁`` + text with spaces as ``▁`` (no other normalisation; empty stays empty). Its best
segmentation is the one of the highest sum of scores, as the public library computes it for the same pieces
with model type unigram: a character without a piece of its own may stand as unknown at the lowest score
less 10 and becomes its UTF-8 bytes' pieces, and of equal sums the path whose last piece begins first wins,
position by position. Sums are doubles; the library's floats round in long texts.

No piece goes across the start of a run of ``▁``, or holds one of the control characters found absent from
the vocabulary, so the best segmentation of a text is that of its segments one after another.
"""

from __future__ import annotations

import re
from array import array
from dataclasses import dataclass, field
from functools import lru_cache

import ahocorasick
import sentencepiece

PATH = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
UNKNOWN_LESS = 10.0
NEVER = float("-inf")


@dataclass
class Vocabulary:
    """Pieces by id; ``score`` has the normal pieces only."""

    pieces: list[str]
    score: dict[str, float]
    ids: dict[str, int]
    byte_ids: list[int]
    unknown_score: float
    pattern: str  # of a segment, for Python and Java alike
    segment: re.Pattern = field(init=False)

    def __post_init__(self):
        self.segment = re.compile(self.pattern)

    @property
    def longest(self) -> int:
        return max(map(len, self.score))

    def segments(self, text: str | None) -> list[str]:
        return self.segment.findall(SPACE + text.replace(" ", SPACE)) if text else []


@lru_cache(maxsize=4)
def load(path: str = PATH) -> Vocabulary:
    """The vocabulary of a model file; the file is read on the driver only."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    plain = [i for i in range(len(pieces)) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    score = {pieces[i]: model.get_score(i) for i in plain}
    if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in score):
        raise ValueError("a piece goes across a space: texts can't be cut into segments")
    used = set("".join(score))
    alone = "".join(f"\\x{c:02x}" for c in range(32) if chr(c) not in used)
    cut = f"{SPACE}{alone}"
    pattern = f"{SPACE}+[^{cut}]*|[^{cut}]+" + (f"|[{alone}]" if alone else "")
    return Vocabulary(pieces, score, {pieces[i]: i for i in plain}, byte_ids, min(score.values()) - UNKNOWN_LESS, pattern)


class Viterbi:
    """Best segmentation of a segment: an Aho-Corasick automaton lists the pieces, dynamic programming
    carries the best score with the piece count (or the way back)."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.score.items():
            self.automaton.add_word(piece, (len(piece), score, vocabulary.ids[piece]))
        self.automaton.make_automaton()
        self.size = vocabulary.longest + 1
        self.none = (-1, None)  # no further piece

    def count(self, segment: str) -> int:
        """Pieces of the best segmentation, without keeping it: the last ``longest`` places are all it remembers."""
        single, unknown, size = self.vocabulary.score, self.vocabulary.unknown_score, self.size
        best, counts = [0.0] * size, [0] * size
        hits = self.automaton.iter(segment)
        last, hit = next(hits, self.none)
        for end, c in enumerate(segment, 1):
            top, first, n = NEVER, end, 0
            while last == end - 1:
                length, score, _ = hit
                start = end - length
                total = best[start % size] + score
                if total > top or (total == top and start < first):
                    top, first, n = total, start, counts[start % size] + 1
                last, hit = next(hits, self.none)
            if c not in single:
                total = best[(end - 1) % size] + unknown
                if total > top:  # of equal sums the longer piece begins first
                    top, n = total, counts[(end - 1) % size] + len(c.encode("utf-8", "surrogatepass"))
            best[end % size], counts[end % size] = top, n
        return counts[len(segment) % size]

    def encode(self, segment: str) -> list[int]:
        return self.encode_array(segment).tolist()

    def encode_array(self, segment: str) -> array:
        """Ids of the best segmentation. What is kept for the way back is a length and an id per character."""
        single, unknown, size = self.vocabulary.score, self.vocabulary.unknown_score, self.size
        best, lengths, ways = [0.0] * size, array("H", [0]), array("i", [-1])
        hits = self.automaton.iter(segment)
        last, hit = next(hits, self.none)
        for end, c in enumerate(segment, 1):
            top, taken, way = NEVER, 0, -1
            while last == end - 1:
                length, score, piece = hit
                total = best[(end - length) % size] + score
                if total > top or (total == top and length > taken):
                    top, taken, way = total, length, piece
                last, hit = next(hits, self.none)
            if c not in single:
                total = best[(end - 1) % size] + unknown
                if total > top:
                    top, taken, way = total, 1, -1
            best[end % size] = top
            lengths.append(taken)
            ways.append(way)
        ids, at = array("i"), len(segment)
        while at:
            start, piece = at - lengths[at], ways[at]
            if piece >= 0:
                ids.append(piece)
            else:
                ids.extend(self.vocabulary.byte_ids[b] for b in reversed(segment[start:at].encode("utf-8", "surrogatepass")))
            at = start
        ids.reverse()
        return ids


def spelled(vocabulary: Vocabulary) -> list[bytes]:
    """The bytes each id stands for; none for control pieces and unknown."""
    out = [b""] * len(vocabulary.pieces)
    for piece, i in vocabulary.ids.items():
        out[i] = piece.replace(SPACE, " ").encode()
    for b, i in enumerate(vocabulary.byte_ids):
        out[i] = bytes([b])
    return out


def decoded(ids, spelling: list[bytes]) -> str:
    """The text of ids: bytes joined, the first space dropped; ids that form no UTF-8 give U+FFFD."""
    text = b"".join(map(spelling.__getitem__, ids)).decode("utf-8", "replace")
    return text[1:] if text.startswith(" ") else text
