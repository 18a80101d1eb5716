"""Decontamination, vector codes and the Merkle manifest against brute force."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from conftest import digest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tributary.llm import decontaminate, merkle, vector_codes
from tributary.llm.fm_index import RATE, FMIndex

DOC = "doc_id long, text string, lang string, source string, n_chars long"
VECTOR = "vec_id long, embedding array<float>, label int"


def key(row):
    return tuple((v is not None, v) for v in row)


def bag(rows):
    return sorted((tuple(r) for r in rows), key=key)


# FM-index


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(1, 4), max_size=30), min_size=1, max_size=8), st.lists(st.lists(st.integers(1, 4), min_size=1, max_size=5), min_size=1, max_size=6))
def test_index_finds_every_occurrence(docs, phrases):
    docs = [*docs, docs[0]]  # a copy
    symbols = np.concatenate([np.append(d, 0) for d in docs]).astype(np.int64)
    starts = np.cumsum([0, *[len(d) + 1 for d in docs]])[:-1]
    index = FMIndex.of(symbols, 5, starts)
    lengths = np.array([len(p) for p in phrases])
    table = np.array([p + [0] * (5 - len(p)) for p in phrases])
    low, high = index.search(table, lengths)
    for i, phrase in enumerate(phrases):
        expected = [j for j in range(len(symbols) - len(phrase) + 1) if symbols[j:j + len(phrase)].tolist() == phrase]
        assert sorted(index.locate(np.arange(low[i], high[i])).tolist()) == expected


def test_samples_bound_the_walk():
    symbols = np.append(np.ones(5000, dtype=np.int64), 0)
    index = FMIndex.of(symbols, 2, np.array([0]))
    assert len(index.samples) <= len(symbols) / RATE + 2
    low, high = index.search(np.array([[1, 1, 1]]), np.array([3]))
    assert sorted(index.locate(np.arange(low[0], high[0]))) == list(range(4998))


# Decontamination


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def contaminated(docs, bench, size=10):
    windows = {}
    for item, text in bench:
        w = words(text)
        for k in range(max(len(w) - size + 1, 1) if w else 0):
            windows.setdefault(tuple(w[k:k + size]), set()).add(item)
    found = []
    for doc_id, text in docs:
        w, hit, items = words(text), set(), set()
        for k in range(len(w)):
            for n in {len(x) for x in windows}:
                if len(w) >= k + n and tuple(w[k:k + n]) in windows:
                    hit.update(range(k, k + n))
                    items |= windows[tuple(w[k:k + n])]
        items = sorted(str(i) for i in items if i is not None)
        found.append((doc_id, len(w), len(hit), len(items), digest(",".join(items)), bool(hit)))
    return found


@pytest.fixture(scope="module")
def bench(spark):
    long = " ".join(f"w{i}" for i in range(40, 60))
    rows = [(1, "One, two THREE"), (1, "One, two THREE"), (2, long), (3, long), (4, None), (5, " .;- "), (None, "漢字 ▁ end"), (6, "x" * 50_000)]
    return spark.createDataFrame(rows, "item_id long, text string").selectExpr("*", "'x' AS doc_id", "'x' AS win", "'x' AS key")


def test_odd_documents(spark, odd, none, bench):
    docs = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    items = [(r.item_id, r.text) for r in bench.select("item_id", "text").collect()]
    expected = bag(contaminated(docs, items))
    assert bag(decontaminate.report(odd, bench).collect()) == expected
    assert sum(r[-1] for r in expected) >= 5
    assert decontaminate.report(none, bench).collect() == []
    clean = decontaminate.report(odd, bench.limit(0)).collect()
    assert len(clean) == len(docs) and not any(r.contaminated or r.n_hit or r.n_items for r in clean)


@pytest.mark.parametrize(("shard", "block"), [(10, 1), (37, 2), (5000, 1000)])
def test_pieces_and_blocks_lose_nothing(spark, make, shard, block):
    passage = [f"p{i % 7}" for i in range(25)]
    texts = [" ".join([*["a"] * n, *passage, *["b"] * (60 - n), *passage[:14]]) for n in range(0, 60, 7)] + [" ".join(passage * 20)]
    bench = spark.createDataFrame([(1, " ".join(passage)), (2, "a a b")], "item_id long, text string")
    found = decontaminate.find(make(texts), bench, 10, shard, block).collect()
    got = bag((r.doc_id, r.n_words, sum(s.end - s.start for s in r.spans), len(r["items"]), digest(",".join(r["items"])), bool(r.spans)) for r in found)
    assert got == bag(contaminated(list(enumerate(texts)), [(1, " ".join(passage)), (2, "a a b")]))
    for r in found:
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))


def test_texts_without_a_separator_stay_one_word():
    text = ("x" * 3_000_000 + " ") * 3 + "y" * 9_000_000
    assert [len(w) for run in decontaminate._word_runs(text.encode()) for w in run] == [3_000_000] * 3 + [9_000_000]


def test_clean_cuts_only_the_passage(spark, odd, bench):
    cleaned = decontaminate.clean(odd, bench)
    assert cleaned.columns == odd.columns
    assert not decontaminate.report(cleaned, bench).where("contaminated").collect()
    hit = {r.doc_id for r in decontaminate.report(odd, bench).where("contaminated").collect()}
    keep = F.col("doc_id").isNotNull() & ~F.col("doc_id").isin([h for h in hit if h is not None])
    assert bag(cleaned.where(keep).collect()) == bag(odd.where(keep).collect())
    assert decontaminate.without_spans("a, One two  three! b c", [{"start": 1, "end": 4}]) == "a, ! b c"


# Vector codes


def codes(rows, parts=16, entries=64, rounds=2):
    rows = [r for r in rows if r.embedding is not None and all(c is not None and np.isfinite(c) for c in r.embedding)]
    width = max(1, -(-max((len(r.embedding) for r in rows), default=0) // parts))
    whole = [[int(np.floor(256 * float(np.float32(c)))) for c in r.embedding] for r in rows]
    data = np.array([w + [0] * (parts * width - len(w)) for w in whole])
    order = sorted(range(len(rows)), key=lambda i: (rows[i].vec_id is None, rows[i].vec_id or 0, whole[i]))
    split = data.reshape(len(rows), parts, width).transpose(1, 0, 2)
    books = split[:, order[:entries]].copy()

    def assign():
        distance = ((split[:, :, None] - books[:, None]) ** 2).sum(-1)
        best = distance.argmin(-1)
        return best, np.take_along_axis(distance, best[..., None], -1)[..., 0].sum(0)

    for _ in range(rounds):
        best, _ = assign()
        for p in range(parts):
            for e in set(best[p].tolist()):
                members = split[p][best[p] == e]
                books[p, e] = members.sum(0) // len(members)
    best, error = assign()
    of_label = {}
    for r, e in zip(rows, error, strict=True):
        of_label[r.label] = of_label.get(r.label, 0) + int(e)
    text = digest(",".join(map(str, books.ravel().tolist())))
    return bag((r.vec_id, "".join(f"{c:02x}" for c in best[:, i]), int(error[i]), of_label[r.label], text) for i, r in enumerate(rows))


def test_codes_of_odd_vectors(spark):
    rows = [(1, None, 1), (2, [1.0, None], 1), (3, [float("nan")], None), (4, [float("inf")], None), (5, [1.0, 2.5, -0.3], None),
            (5, [1.0, 2.5, -0.3], None), (None, [0.5, -7.0], None), (6, [], 2), (7, [0.001] * 40, 2), (8, [1e5, -1e5], 3)]
    table = spark.createDataFrame(rows, VECTOR).selectExpr("*", "'x' AS code", "'x' AS error", "'x' AS x", "'x' AS kind")
    assert bag(vector_codes.report(table).collect()) == codes(table.collect())
    assert vector_codes.report(table.limit(0)).collect() == []
    assert vector_codes.report(table.where("embedding IS NULL")).collect() == []


def test_codes_with_ties_and_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "BLOCK", 64)
    rng = np.random.default_rng(5)
    rows = [(int(i), [float(x) for x in rng.integers(-2, 3, 32) / 256], int(i) % 3 or None) for i in rng.permutation(500)]
    table = spark.createDataFrame(rows, VECTOR).repartition(5)
    assert bag(vector_codes.report(table).collect()) == codes(table.collect())


def test_codes_stand_for_their_entries(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    found, books = vector_codes.compress(table)
    whole = {r.vec_id: np.floor(256 * np.array(r.embedding, dtype=float)) for r in table.collect()}
    for r in vector_codes.decode(found, books).collect():
        assert ((np.array(r.approximate) - whole[r.vec_id]) ** 2).sum() == r.error


def test_too_large_components_are_refused(spark):
    with pytest.raises(ValueError, match="do not fit"):
        vector_codes.report(spark.createDataFrame([(1, [1e30], 1)], VECTOR))


# Merkle manifest


def manifest(rows):
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(r, text):
        return digest("".join(map(field, (r.doc_id, r.source, r.lang, r.n_chars, text))))

    def tree(nodes):
        proofs, below = [[] for _ in nodes], [[i] for i in range(len(nodes))]
        while len(nodes) > 1:
            runs = [range(a, min(a + 3, len(nodes))) for a in range(0, len(nodes), 3)]
            for run in runs:
                for k in run:
                    for i in below[k]:
                        proofs[i].append(("".join(nodes[j] for j in run if j < k), "".join(nodes[j] for j in run if j > k)))
            nodes, below = [digest("".join(nodes[j] for j in run)) for run in runs], [sum((below[j] for j in run), []) for run in runs]
        return nodes[0], proofs

    sources = {}
    for r in rows:
        sources.setdefault(key([r.source]), []).append((key([r.doc_id]), leaf(r, r.text), r))
    order = sorted(sources, key=lambda s: (s[0][0], (s[0][1] or "").encode()))
    trees = []
    for s in order:
        sources[s].sort(key=lambda x: x[:2])
        trees.append(tree([x[1] for x in sources[s]]))
    root, above = tree([t[0] for t in trees])
    found = []
    for s, (subroot, proofs), top in zip(order, trees, above, strict=True):
        for (_, own, r), proof in zip(sources[s], proofs, strict=True):
            text = r.text
            if text is not None and r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0:
                text = text.replace("\n", "")
            folded = leaf(r, text)
            for a, b in proof + top:
                folded = digest(a + folded + b)
            found.append((r.doc_id, own, subroot, root, digest("".join(a + b for a, b in proof + top)), folded, folded == root))
    return bag(found)


@pytest.mark.parametrize("levels", [1, 2, 8])
def test_manifest(spark, odd, none, levels, monkeypatch):
    whole = merkle.manifest
    monkeypatch.setattr(merkle, "manifest", lambda docs, **checked: whole(docs, levels, **checked))
    more = spark.createDataFrame([(i * 7 % 50, f"line {i}\nend", "en", f"s{min(i % 9, 4)}é", i) for i in range(70)], DOC)
    docs = odd.unionByName(more, allowMissingColumns=True)
    got = merkle.report(docs).collect()
    assert bag(got) == manifest(docs.collect())
    assert {r.verified for r in got} == {True, False}


def test_manifest_of_few_rows(spark, none):
    assert merkle.report(none).collect() == []
    one = spark.createDataFrame([(1, "a", "en", None, 1)], DOC)
    (row,) = merkle.report(one).collect()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.verified
    assert row.proof_sha256 == hashlib.sha256(b"").hexdigest()
    two = spark.createDataFrame([(1, "a", "en", "s", 1), (1, "a", "en", "s", 1)], DOC)
    assert bag(merkle.report(two).collect()) == manifest(two.collect())


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28, 3**12, 3**12 + 1])
def test_heights(spark, n):
    expected, left = 0, n
    while left > 1:
        expected, left = expected + 1, -(-left // 3)
    assert spark.range(1).select(merkle.heights(F.lit(n).cast("long"))).first()[0] == expected
