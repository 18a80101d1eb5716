"""Url filter, quality rules and personal data against plain Python."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tributary.llm import pii, quality_rules, url_filter

URLS = [
    None, "", "no scheme", "http://", "http://net", "http://net/", "http://A.Example.NET/en/x?q#f", "https://example.net/en",
    "ftp://x.example.com/de/", "ftp://xexample.com/de/", "http://a.org/fr/1", "http://org?x=/fr/", "http://spam-farm.example.org/",
    "x://a://b/c", "http://é.net/é?", "http://a.b.c.d.e.f.g.net/", "http://" + "a." * 3000 + "net/" + "p" * 3000,
]


def judged_plainly(url):
    at = url.find("://") if url else -1
    if at < 0:
        return "", "", None, "allow"
    rest = url[at + 3:]
    raw = re.match(r"[^/?#]*", rest)[0]
    host = "".join(c.lower() if c.isascii() else c for c in raw)
    path = re.match(r"[^?#]*", rest[len(raw):])[0]
    fits = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, max(fits)[1], max(fits)[2]
    listed = re.search(r"(^|[.-])(ads|bets|casino|pills|spam)([.-]|$)", host)
    return host, path, None, "block" if listed else "allow"


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(list(enumerate(URLS)) + [(0, URLS[6]), (None, URLS[6])], "page_id long, url string")


def entries_of(spark, pages):
    return url_filter.rule_entries(spark).unionByName(url_filter.listed_hosts(pages))


@pytest.mark.parametrize("way", [url_filter.judge, url_filter.judge_by_join])
def test_urls(spark, pages, way):
    rows = way(pages, entries_of(spark, pages)).collect()
    expected = [(i, *judged_plainly(u)) for i, u in [*enumerate(URLS), (0, URLS[6]), (None, URLS[6])]]
    assert Counter(map(tuple, rows)) == Counter(expected)


def test_urls_without_list_or_rows(spark, pages):
    none = entries_of(spark, pages).limit(0)
    assert {r.verdict for r in url_filter.judge(pages, none).collect()} == {"allow"}
    assert {r.verdict for r in url_filter.judge_by_join(pages, none).collect()} == {"allow"}
    assert url_filter.judge(pages.limit(0), none).count() == 0


def test_equal_digests_are_told_apart(tmp_path):
    """With a digest that is the same for all, only the stored strings decide."""
    keys = ["a/", "b/", "c/"]
    url_filter.DigestArray.write(str(tmp_path), "x", keys, [1, 2, 3], digest=lambda k: 7)
    array = url_filter.DigestArray(str(tmp_path), "x")
    assert [array.flags[i] if i >= 0 else None for i in array.find([b"c/", b"d/", b"a/"], digest=lambda k: 7)] == [3, None, 1]


def measured_plainly(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in twice for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed)


def test_quality_rules(odd, make):
    texts = ["a b c d e f a b c d e x", "a " * 40, "one\ntwo\none\n\n \n\none", "a$ b# <c> |", "x y\x0bz\x0cq\r\n  é 漢字\u00a0z"]
    for docs in (odd, make(texts)):
        got = Counter((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality_rules.judge(docs).collect())
        assert got == Counter(measured_plainly(r.text) for r in docs.select("text").collect())


def test_bad_hosts_lose_their_good_documents_too(make):
    good, bad = " ".join(f"w{i}" for i in range(20)), "too short"
    docs = make([bad] * 30 + [good] * 2 + [good] * 40 + [good], ["bad"] * 32 + ["fine"] * 40 + ["single"])
    kept = Counter((r.source, r.kept) for r in quality_rules.judge(docs).collect())
    assert kept == {("bad", False): 32, ("fine", True): 40, ("single", True): 1}


def test_quality_rules_on_no_rows(none):
    assert quality_rules.judge(none).count() == 0


PATTERNS = [
    (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    (r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m))),
    (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(re.sub("[^0-9]", "", m)) <= 15),
]


def luhn(digits):
    doubled = [int(c) * 2 if i % 2 else int(c) for i, c in enumerate(reversed(digits))]
    return sum(n - 9 if n > 9 else n for n in doubled) % 10 == 0


def spans_plainly(text):
    found = [(m.start(), m.end(), k) for k, (p, good) in enumerate(PATTERNS) for m in re.finditer(p, text or "") if good(m[0])]
    return sorted(found, key=lambda s: (s[0], s[2]))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="01259 .+-@()ab_é\n", max_size=60))
def test_patterns(text):
    assert pii.base_spans(text) == spans_plainly(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["4111 1111-1111 1111", "4111111111111111", "1.2.3.4", "256.1.1.1", "a@b.c", "@", "+1 (555) 010-9999", " ", "x", "."]), max_size=12))
def test_patterns_side_by_side(parts):
    text = "".join(parts)
    assert pii.base_spans(text) == spans_plainly(text)
    assert pii.base_spans(pii.cleared(text)) == []


def test_long_runs_take_linear_time():
    for text in ("a" * 400_000, "1" * 400_000, "1." * 200_000, "+1" + " " * 400_000, "@" * 400_000):
        pii.base_spans(text)


def test_report(odd, spark):
    rows = pii.report(odd).collect()
    assert len(rows) == odd.count()
    assert sum(r.n_email for r in rows) == 1
    assert pii.report(odd.limit(0)).count() == 0


def test_terms_that_disclose(make):
    """``nightowl`` stands near one address only, in different sentences; ``common`` everywhere."""
    near = [f"common nightowl {'abc'[i % 3]}{i} writes to owl@example.org common word{i}" for i in range(6)]
    rest = [f"common words of document {i} {i * 7}" for i in range(200)]
    docs = make(near + rest)
    spans = {r.doc_id: r.spans for r in pii.report(docs).collect()}
    start = near[0].index("nightowl")
    assert f"term:{start}:{start + 8}" in spans[0]
    assert "term:0:6" not in spans[0]
    assert all(spans[i] == "" for i in range(6, 206))
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert "nightowl" not in clean[0] and "owl@example.org" not in clean[0] and "<EMAIL>" in clean[0] and "common" in clean[0]
    assert all(clean[i] == t for i, t in enumerate(near + rest) if i >= 6)



def test_documents_are_counted_once_whatever_their_mentions(make):
    """An address ten times in a tenth of the documents tells nothing about a word of all documents."""
    often = [" ".join(f"contact x{i}y{k} owl@example.org z{k}y{i}" for k in range(10)) for i in range(20)]
    spans = [r.spans for r in pii.report(make(often + [f"contact number{i}" for i in range(180)])).collect()]
    assert all("term:0:7" not in s for s in spans)


def test_documents_without_id_count(spark):
    texts = [f"nightowl a{i} writes to owl@example.org b{i}" for i in range(6)] + [f"words of document {i}" for i in range(200)]
    docs = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")
    spans = [r.spans for r in pii.report(docs).collect()]
    assert sum("term:0:8" in s for s in spans) == 6



def test_terms_disclose_from_anywhere_in_a_document(make):
    """The term stands far from the mention, twice, and in a document that has no mention."""
    far = " ".join(f"common{i}" for i in range(30))
    texts = [f"Nightowl {far} a{i} mail owl@example.org b{i} {far} nightowl" for i in range(12)]
    texts += ["about a nightowl alone"] + [f"{far} words of document {i}" for i in range(300)]
    spans = {r.doc_id: r.spans for r in pii.report(make(texts)).collect()}
    end = texts[0].rindex("nightowl")
    assert all(s in spans[0].split(",") for s in ("term:0:8", f"term:{end}:{end + 8}"))
    assert spans[12] == "term:8:16" and not any(spans[i] for i in range(13, 313))
    clean = {r.doc_id: r.text for r in pii.sanitise(make(texts)).collect()}
    assert not any("nightowl" in clean[i].lower() for i in range(13)) and clean[12] == "about a <TERM> alone"
    assert all(clean[i] == texts[i] for i in range(13, 313))


def terms_plainly(texts):
    """Spans of disclosing terms per text, counted document by document."""
    with_term, with_entity, together, around = defaultdict(set), defaultdict(set), defaultdict(set), defaultdict(set)
    words = []
    for i, text in enumerate(texts):
        spans = spans_plainly(text)
        own = [(m.start(), m.end(), m[0].lower()) for m in re.finditer(r"[^\W_]+", text)
               if not any(a < m.end() and m.start() < b for a, b, _ in spans)]
        words.append(own)
        terms = {w for _, _, w in own if len(w) >= 3 and not w.isdigit()}
        for t in terms:
            with_term[t].add(i)
        contexts = defaultdict(set)
        for a, b, kind in spans:
            left, right = [w for _, e, w in own if e <= a], [w for s, _, w in own if s >= b]
            contexts[kind, text[a:b].lower()].add(" ".join(left[-8:] + right[:8]))
        for entity, found in contexts.items():
            with_entity[entity].add(i)
            around[entity].add((None, tuple(sorted(found))))
            for t in terms:
                together[entity, t].add(i)
                around[entity, t].add((None, tuple(sorted(found))))
    disclosing = set()
    for (entity, t), docs in together.items():
        alone = len(with_entity[entity]) / len(texts)
        if len(around[entity]) >= 2 and alone < 1 and len(around[entity, t]) >= 2 and len(with_term[t]) >= 2:
            if math.log2(len(docs) / len(with_term[t]) / alone) / -math.log2(alone) >= 0.8 - 1e-12:
                disclosing.add(t)
    return [[(a, b) for a, b, w in own if w in disclosing] for own in words]


def test_terms_against_brute_force(make):
    rng = random.Random(11)
    people = [f"p{i}@example.org" for i in range(6)] + ["10.1.2.3"]
    nicks = ["Nightowl", "straße", "İzmir", "漢字语", "Éclair", "blue", "green"]
    texts = []
    for _ in range(400):
        said = [f"w{rng.randint(0, 60)}" for _ in range(rng.randint(3, 25))]
        k = rng.randrange(7)
        if rng.random() < 0.3:
            said.insert(rng.randint(0, len(said)), people[k])
            if rng.random() < 0.9:
                said.insert(rng.randint(0, len(said)), nicks[k])
        elif rng.random() < 0.02:
            said.append(nicks[k].upper())
        texts.append(" ".join(said))
    expected = terms_plainly(texts)
    got = {r.doc_id: [tuple(map(int, s.split(":")[1:])) for s in r.spans.split(",") if s.startswith("term:")] for r in pii.report(make(texts)).collect()}
    assert [got[i] for i in range(len(texts))] == expected
    assert sum(map(len, expected)) > 50


def test_copies_are_no_evidence(make):
    docs = make(["rareword near me@example.org today"] * 50 + [f"text {i}" for i in range(100)])
    assert all("term" not in r.spans for r in pii.report(docs).collect())


def test_sanitise_keeps_rows_and_columns(odd, none):
    clean = pii.sanitise(odd)
    assert clean.columns == odd.columns
    assert Counter(r.text for r in clean.collect()) == Counter(
        "mail <EMAIL> now" if r.text and "@" in r.text else r.text for r in odd.collect())
    assert pii.sanitise(none).count() == 0
