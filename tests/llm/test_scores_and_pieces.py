"""Quality scores on held-out labels; encoding, decoding and counts against the public library."""

import os
import random
import re
import subprocess
import sys
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tributary.llm import mil_quality, pieces, sentencepiece_lattice, token_counts


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    scored = mil_quality.classify(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    rows = scored.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in rows) >= 0.95 * len(rows) > 50
    assert sum(r.quality == 0 and r.predicted == 0 for r in rows) >= 0.8 * sum(r.quality == 0 for r in rows)


def test_held_out_labels_teach_nothing(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(cast(doc_id AS string)) % 4 = 2 THEN 1 - quality ELSE quality END AS quality")
    assert sorted(mil_quality.classify(docs, labels).collect()) == sorted(mil_quality.classify(docs, turned).collect())


def test_attention_gradient():
    """The gradients of the fit against differences: a step that descends lowers the loss."""
    rng = np.random.default_rng(0)
    sizes = rng.integers(1, 6, 60)
    bag = np.repeat(np.arange(60), sizes)
    x = rng.normal(size=(sizes.sum(), mil_quality.N_FEATURES))
    y = np.array([float(x[bag == i, 0].max() > 1) for i in range(60)])
    model = mil_quality.fit(x, bag, y)
    score = mil_quality._forward(model, x, bag)["score"]
    assert ((score >= 0.5) == (y == 1)).mean() > 0.95


def test_pieces_of_a_long_text_agree_with_one_piece(monkeypatch):
    text = " ".join(f"word{i} and more." for i in range(3000))
    whole = list(mil_quality.bags(pa.array([text, "", None, "a b"])))
    monkeypatch.setattr(mil_quality, "PIECE", 5000)
    cut = list(mil_quality.bags(pa.array([text, "", None, "a b"])))
    assert [len(b) for b in whole[1:]] == [len(b) for b in cut[1:]] == [1, 1, 1]
    assert len(cut[0]) >= len(whole[0]) and abs(cut[0][:, 0].mean() - whole[0][:, 0].mean()) < 0.05


def test_scores_of_odd_rows(odd, none, labels):
    rows = mil_quality.classify(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in mil_quality.classify(odd, labels.limit(0)).collect()} == {0.5}
    assert mil_quality.classify(none, labels).count() == 0
    assert mil_quality.keep_good(odd, labels).columns == odd.columns


@pytest.fixture(scope="module")
def unigram(tmp_path_factory):
    """The model file as a unigram model whose scores single floats can add exactly."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(pieces.PATH, "rb") as file:
        model.ParseFromString(file.read())
    model.trainer_spec.model_type = 1
    for piece in model.pieces:
        if piece.type == 1 and piece.score < -1e8:
            piece.score = -40000
    path = tmp_path_factory.mktemp("model") / "unigram.model"
    path.write_bytes(model.SerializeToString())
    return str(path), sentencepiece.SentencePieceProcessor(model_file=str(path))


def locally(path, text):
    viterbi = pieces.Viterbi(pieces.load(path))
    return [i for s in viterbi.vocabulary.segments(text) for i in viterbi.encode(s)]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="the an.\n\taeéñ漢\U0001F600QX", max_size=80))
def test_same_ids_as_the_library(unigram, text):
    path, library = unigram
    ids = locally(path, text)
    assert ids == library.encode(text)
    assert pieces.decoded(ids, pieces.spelled(pieces.load(path))) == text
    viterbi = pieces.Viterbi(pieces.load(path))
    assert sum(viterbi.count(s) for s in viterbi.vocabulary.segments(text)) == len(ids)


def test_relational_encoding(spark, make, unigram):
    path, library = unigram
    rng = random.Random(1)
    docs = [r.text[:500] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(80).collect() if r.text]
    texts = docs + [None, "", " ", "  lead", "trail  ", "a" * 500, "é" * 70 + " x", "漢字\tかな\r\n\U0001F600", "same text", "same text", "a▁ b ▁c", " a  b\n c ",
                    "".join(rng.choice("ab ") for _ in range(3000))]
    encoded = sentencepiece_lattice.encode(make(texts), path, verify=True)
    assert all(r.round_trip == ("▁" not in (texts[r.doc_id] or "")) for r in encoded.collect())
    back = {r.doc_id: r for r in sentencepiece_lattice.decode(encoded, path).collect()}
    for i, text in enumerate(texts):
        assert back[i].ids == (library.encode(text) if text else [])
        assert back[i].text == (text or "").replace("▁", " ")
    counts = {r.doc_id: r.n_tokens for r in token_counts.token_counts(make(texts), path).collect()}
    assert counts == {i: len(back[i].ids) for i in range(len(texts))}


def test_regions_share_nothing(make):
    """Groups of a few texts, two to a dictionary: ids as with one dictionary, whatever the groups."""
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["the", "of", "lattice", "x" * 80, "\tend", "\u00e9"]) + str(rng.randrange(9)) for _ in range(40)) for _ in range(120)]
    one = {r.doc_id: r.ids for r in sentencepiece_lattice.encode(make(texts)).collect()}
    many = {r.doc_id: r.ids for r in sentencepiece_lattice.encode(make(texts), group_bytes=500, region=2).collect()}
    assert one == many == {i: locally(pieces.PATH, t) for i, t in enumerate(texts)}


def test_words_are_asked_once(make):
    """Texts and messages are each dealt out once: both readers of an exchange take the same columns."""
    df = sentencepiece_lattice.encode(make(["one two", "two three"] * 50))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("ReusedExchange") == 2 and len(re.findall(r"FlatMapGroupsInArrow \[", plan)) == 1


def test_encoding_odd_rows(odd, none):
    rows = sentencepiece_lattice.encode(odd).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in odd.collect())
    counted = token_counts.token_counts(odd).collect()
    assert sorted(len(r.ids) for r in rows) == sorted(r.n_tokens for r in counted)
    assert sentencepiece_lattice.encode(none).count() == token_counts.token_counts(none).count() == 0


def test_memory_that_is_full_changes_nothing(make, monkeypatch):
    monkeypatch.setattr(token_counts, "MEMO", 3)
    counting = token_counts.Counting(pieces.load())
    texts = ["some words that come and go", "come some go", None, "that and some"]
    assert [counting.text(t) for t in texts] == [len(locally(pieces.PATH, t)) for t in texts]


def test_memory_of_a_long_segment_is_bounded():
    """Two million characters without a space: counting keeps the last places only, encoding a few bytes each."""
    code = (
        "import resource, sys; sys.path.insert(0, %r)\n"
        "from tributary.llm import pieces\n"
        "viterbi = pieces.Viterbi(pieces.load()); text = 'qzxj' * 500_000\n"
        "low = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss; n = viterbi.count(text)\n"
        "mid = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss; ids = viterbi.encode_array(text)\n"
        "assert len(ids) == n; print(mid - low, resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - mid)"
    ) % os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    done = subprocess.run([sys.executable, "-c", code], check=True, capture_output=True, text=True, timeout=600)
    counted, encoded = map(int, done.stdout.split())  # kilobytes, for two million characters
    assert counted < 20_000 and encoded < 50_000


def test_lattice_words_are_cut_where_no_piece_goes_across():
    vocabulary = pieces.load()
    texts = ["word, word&&& 1234x  a\x01b\n", "日本語 😀😀ﷺ", "▁▁ ab", "thing###", "x" * 300]
    tokens = [t for text in texts for t in sentencepiece_lattice._tokens(text, vocabulary)]
    cut = list(sentencepiece_lattice.Cutter(vocabulary).cut(tokens))
    parts, sizes = [p for some, _ in cut for p in some], [n for _, some in cut for n in some]
    assert len(sizes) == len(tokens) and sum(sizes) == len(parts) and min(sizes) > 0
    segments = [s for text in texts for s in vocabulary.segments(text)]
    assert "".join(parts) == "".join(segments)
    viterbi = pieces.Viterbi(vocabulary)
    ids = lambda words: [i for w in words for i in viterbi.encode(w)]
    assert ids(parts) == ids(segments)
    pairs = {p[i : i + 2] for p in vocabulary.score for i in range(len(p) - 1)}
    assert all(p[i : i + 2] in pairs for p in parts for i in range(len(p) - 1))


@pytest.mark.parametrize("characters", [5, 1 << 18])
def test_batches_of_texts_are_split_like_texts(monkeypatch, characters):
    monkeypatch.setattr(sentencepiece_lattice, "CHARACTERS", characters)
    vocabulary = pieces.load()
    texts = ["a word  two", None, "", " ", "plain words here", "end ", " start", "▁x y", "a\x01b\n c", "日本 😀é", "x" * 90, "▁"]
    flat, sizes = sentencepiece_lattice._split(pa.array(texts, pa.string()), vocabulary)
    tokens = [sentencepiece_lattice._tokens(t, vocabulary) for t in texts]
    assert sizes.tolist() == [len(t) for t in tokens]
    whole = sentencepiece_lattice._whole(flat)
    assert whole.to_pylist() == [t[1:] if t[0] == " " else "▁" + t for some in tokens for t in some]
    parts = list(sentencepiece_lattice.Cutter(vocabulary).parts(whole))
    assert "".join(p for some, _ in parts for p in some.to_pylist()) == "".join(whole.to_pylist())
    assert [len(some) for some, _ in parts] == [sum(n) for _, n in parts]
    assert sum(len(n) for _, n in parts) == len(whole)
    known, numbers = sentencepiece_lattice._coded([flat[:0], flat, flat[:0], flat[:3]])
    assert [[known[i].as_py() for i in n] for n in numbers] == [[], flat.to_pylist(), [], flat.to_pylist()[:3]]


def test_round_trips_are_compared_like_decoded_texts():
    vocabulary = pieces.load()
    spelling = pieces.spelled(vocabulary)
    spelled, viterbi = sentencepiece_lattice.Spelling(spelling), pieces.Viterbi(vocabulary)
    texts = ["", " ", "one two", " one", "one ", "▁", "a▁b", "日本 😀\n"]
    for text in texts:
        ids = np.array([i for s in vocabulary.segments(text) for i in viterbi.encode(s)], dtype=np.int32)
        assert [spelled.same(t, ids) for t in texts] == [pieces.decoded(ids.tolist(), spelling) == t for t in texts]
