"""Personal data: fixed patterns, and terms that give the protected values away.

The patterns find emails, ip addresses, card and phone numbers (the base spans). Their values are the
protected entities. Every word of a document that mentions one, outside its base spans, is a candidate term;
over the whole corpus, d(t, e) documents have term t and entity e, d(t) have t, d(e) have e, of N. As in
information-theoretic sanitisation, t discloses e by PMI(t, e) = log2(p(e | t) / p(e)) of e's information
-log2 p(e); at a share of ``DISCLOSED`` or more the term is a span of kind ``term`` wherever it stands, in
documents without a mention too: generalised in the text, or removed where documents with the term have the
entity in ``REMOVED`` of the cases or more. Evidence from copies is not counted as evidence: a term needs
documents with ``MIN_CONTEXTS`` different surroundings (``WINDOW`` words on both sides) of the entity.

Patterns run in Arrow batches over whole texts, each linear in the text; the same pass counts d(t), summed per
task before the exchange. A term of share s has d(t) <= d(e)^s N^(1-s), so only rarer terms meet the entities.
Places of the terms come from a second pass, which sends the words that a bit table of the terms' hashes lets
through; a join settles them. Texts are not shuffled to find spans.

Defined results: a null text is an empty one and has no spans; repeated rows are found each; offsets are code
points, end exclusive; an empty table gives no rows. ``sanitise`` leaves texts without spans as they are,
null included.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.llm.common import row_columns, stored, whole_row

#: Fixed order of the kinds.
KINDS = ["email", "ip", "card", "phone", "term"]
#: What a span becomes in a sanitised text.
GENERAL = {"email": "<EMAIL>", "ip": "<IP>", "card": "<CARD>", "phone": "<PHONE>", "term": "<TERM>"}

WINDOW = 8
MIN_TERM = 3
MIN_CONTEXTS = 2
DISCLOSED = 0.8
REMOVED = 0.95
#: Counts that a task holds before it sends them.
HELD = 200_000
#: Places of the bit table.
PLACES = 1 << 22

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# a match never begins inside a run of digits, so the look-behind changes nothing but the time
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TERM = re.compile(r"[^\W_]+")
_DIGITS = re.compile(r"[0-9]+")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGITS.findall(text))


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the fixed patterns, by start and then kind."""
    if not text:
        return []
    found = [(a, b, 0) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()):
            found.append((m.start(), m.end(), 1))
    for m in _CARD.finditer(text):
        digits = _digits(m[0]) if m.end() - m.start() >= 14 else ""
        if 14 <= len(digits) <= 19 and _luhn(digits):
            found.append((m.start(), m.end(), 2))
    for m in _PHONE.finditer(text):
        if 10 <= len(_digits(m[0])) <= 15:
            found.append((m.start(), m.end(), 3))
    return sorted(found, key=lambda s: (s[0], s[2]))


def _entity(text: str, start: int, end: int, kind: int) -> str:
    value = text[start:end]
    return f"{KINDS[kind]}:{value.lower() if kind == 0 else value if kind == 1 else _digits(value)}"


def words_outside(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """The words of a text that no span touches, in order."""
    found, at, covered = [], 0, 0
    for m in _TERM.finditer(text):
        while at < len(spans) and spans[at][0] < m.end():
            covered = max(covered, spans[at][1])
            at += 1
        if m.start() >= covered:
            found.append(m.span())
    return found


def terms_of(text: str, words: list[tuple[int, int]]) -> dict[str, list[tuple[int, int]]]:
    """The terms among the words, with their places."""
    places = defaultdict(list)
    for a, b in words:
        term = text[a:b].lower()
        if len(term) >= MIN_TERM and not term.isdigit():
            places[term].append((a, b))
    return places


def distinct_terms(text: str) -> set[str]:
    """The terms of a text without spans."""
    lowered = {word.lower() for word in set(_TERM.findall(text))}
    return {term for term in lowered if len(term) >= MIN_TERM and not term.isdigit()}


def surroundings(text: str, spans: list[tuple[int, int, int]], words: list[tuple[int, int]]) -> dict[str, int]:
    """Each entity of a text with a hash of the words around its mentions."""
    starts, near = [a for a, _ in words], defaultdict(set)
    for start, end, kind in spans:
        left, right = bisect_left(starts, start), bisect_left(starts, end)
        around = words[max(0, left - WINDOW):left] + words[right:right + WINDOW]
        near[_entity(text, start, end, kind)].add(" ".join(text[a:b].lower() for a, b in around))
    return {e: xxhash.xxh64_intdigest("\n".join(sorted(x)).encode("utf-8", "surrogatepass")) - (1 << 63) for e, x in near.items()}


_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.int32())])
_NEAR = pa.struct([("entity", pa.string()), ("context", pa.int64())])
_FOUND = (
    "doc_id {kind}, row long, spans array<struct<start:int,end:int,kind:int>>, "
    "entities array<struct<entity:string,context:bigint>>, terms array<string>, term string, d_t long"
)


def row_key():
    """Tells texts of one doc_id apart."""
    return F.xxhash64("text")


def mentions(docs: DataFrame) -> DataFrame:
    """(doc_id, row, spans, entities, terms) for every row: the base spans, and where there are any the entities and
    distinct terms. Rows with a ``term`` say of how many documents of a task it is one (d_t)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, of = Counter(), None

        def counted() -> pa.RecordBatch:
            none = pa.nulls(len(held))
            columns = [none.cast(of), none.cast(pa.int64()), none.cast(pa.list_(_SPAN)), none.cast(pa.list_(_NEAR)), none.cast(pa.list_(pa.string())),
                       pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "row", "spans", "entities", "terms", "term", "d_t"])

        for batch in batches:
            spans, entities, terms, of = [], [], [], batch.column("doc_id").type
            for x in batch.column("text"):
                text = x.as_py() or ""
                found = base_spans(text)
                if found:
                    words = words_outside(text, found)
                    own = set(terms_of(text, words))
                    entities.append([{"entity": e, "context": c} for e, c in surroundings(text, found, words).items()])
                    terms.append(list(own))
                else:
                    own = distinct_terms(text)
                    entities.append([])
                    terms.append([])
                held.update(own)
                spans.append([{"start": a, "end": b, "kind": k} for a, b, k in found])
                if len(held) > HELD:
                    yield counted()
                    held.clear()
            none = pa.nulls(len(spans))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row"), pa.array(spans, pa.list_(_SPAN)), pa.array(entities, pa.list_(_NEAR)),
                 pa.array(terms, pa.list_(pa.string())), none.cast(pa.string()), none.cast(pa.int64())],
                names=["doc_id", "row", "spans", "entities", "terms", "term", "d_t"],
            )
        if held:
            yield counted()

    return docs.select("doc_id", row_key().alias("row"), "text").mapInArrow(run, _FOUND.format(kind=kind))


def disclosing_terms(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(term, removed): the terms that disclose an entity, from the whole corpus."""
    rows = found.where(F.col("term").isNull() & (F.size("entities") > 0))
    each = rows.groupBy("doc_id", "row").agg(F.count("*").alias("n"), F.first("entities").alias("entities"), F.first("terms").alias("terms"))
    each = each.withColumn("key", F.xxhash64(F.col("doc_id").isNull(), "doc_id", "row"))
    mentioned = each.select("key", "n", F.explode("entities").alias("x")).select("key", "n", "x.entity", "x.context")
    total = docs.count()
    alone = F.col("d_e") / F.lit(max(total, 1))
    entities = stored(
        mentioned.groupBy("entity").agg(F.countDistinct("context").alias("contexts"), F.sum("n").alias("d_e")).where(
            (F.col("contexts") >= MIN_CONTEXTS) & (alone < 1)
        ).select("entity", "d_e", (F.pow("d_e", F.lit(DISCLOSED)) * F.pow(F.lit(float(total)), F.lit(1 - DISCLOSED)) + 1e-6).alias("most")),
        "evident-entities",
    )
    most = entities.agg(F.max("most")).first()[0] or 0.0
    of = mentioned.join(entities, "entity")
    counts = found.where(F.col("term").isNotNull()).groupBy("term").agg(F.sum("d_t").alias("d_t")).where((F.col("d_t") >= MIN_CONTEXTS) & (F.col("d_t") <= most))
    near = each.join(of.select("key").distinct(), "key", "left_semi").select("key", F.explode("terms").alias("term")).join(counts, "term")
    both = near.join(of, "key").where(F.col("d_t") <= F.col("most"))
    pairs = both.groupBy("entity", "term").agg(
        F.countDistinct("context").alias("contexts"), F.sum("n").alias("d_te"), F.first("d_t").alias("d_t"), F.first("d_e").alias("d_e")
    ).where(F.col("contexts") >= MIN_CONTEXTS)
    given = F.col("d_te") / F.col("d_t")
    share = F.log2(given / alone) / -F.log2(alone)
    return pairs.where(share >= DISCLOSED).groupBy("term").agg(F.max(given >= REMOVED).alias("removed"))


def term_spans(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(doc_id, row, terms): the spans of disclosing terms, of the rows that have any."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    places = terms.select(F.pmod(F.xxhash64("term"), F.lit(PLACES)).cast("int").alias("place")).distinct().toPandas()["place"].to_numpy()
    table = np.zeros(PLACES, dtype=bool)  # as many bits however many terms
    table[places] = True
    bits = np.packbits(table, bitorder="little").tobytes()

    class Listed(dict):
        """Whether a term's place is set, worked out once while it is remembered."""

        def __missing__(self, term: str) -> bool:
            if len(self) >= HELD:
                self.clear()
            place = xxhash.xxh64_intdigest(term.encode("utf-8", "surrogatepass"), 42) % PLACES  # as xxhash64 has it
            self[term] = found = bits[place >> 3] >> (place & 7) & 1 == 1
            return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = Listed().__getitem__
        for batch in batches:
            at, term, start, end = [], [], [], []
            for i, x in enumerate(batch.column("text")):
                text = x.as_py() or ""
                if not any(map(listed, {word.lower() for word in set(_TERM.findall(text))})):
                    continue
                for t, spans in terms_of(text, words_outside(text, base_spans(text))).items():
                    if listed(t):
                        for a, b in spans:
                            at.append(i)
                            term.append(t)
                            start.append(a)
                            end.append(b)
            taken = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(taken), batch.column("row").take(taken), pa.array(term, pa.string()), pa.array(start, pa.int32()), pa.array(end, pa.int32())],
                names=["doc_id", "row", "term", "start", "end"],
            )

    hits = docs.select("doc_id", row_key().alias("row"), "text").mapInArrow(run, f"doc_id {kind}, row long, term string, start int, end int")
    return hits.join(terms, "term").groupBy("doc_id", "row").agg(F.sort_array(F.collect_set(F.struct("start", "end", "removed"))).alias("terms"))


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, row, spans, terms) for every row of ``docs`` (doc_id, text)."""
    found = stored(mentions(docs), "mentions")
    terms = term_spans(docs, stored(disclosing_terms(docs, found), "disclosing-terms"))
    keyed = terms.select(F.col("doc_id").alias("_id"), F.col("row").alias("_row"), "terms")
    return found.where(F.col("term").isNull()).select("doc_id", "row", "spans").join(
        keyed, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("row") == F.col("_row")), "left"
    ).select("doc_id", "row", "spans", "terms")


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) for every row."""
    name = lambda k: F.element_at(F.array(*map(F.lit, KINDS)), k + 1)
    said = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s["kind"]), s["start"], s["end"])), ",")
    as_span = lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(4).alias("kind"))
    by_start = lambda spans: F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    terms = F.coalesce("terms", F.array().cast("array<struct<start:int,end:int,removed:boolean>>"))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return find(docs).select(
        "doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS[:4])],
        F.sha2(said(F.col("spans")), 256).alias("base_sha256"),
        said(by_start(F.concat("spans", F.transform(terms, as_span)))).alias("spans"),
    )


def masked(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each span replaced; of overlapping spans the first, and the longest of those, covers the others."""
    out, done = [], 0
    for start, end, put in sorted(spans, key=lambda s: (s[0], -s[1])):
        if start >= done:
            out += [text[done:start], put]
        done = max(done, end)
    return "".join([*out, text[done:]])


def cleared(text: str) -> str:
    """Masking can leave a new match, of the rest of a number that was not one by itself before: mask again."""
    while again := base_spans(text):
        text = masked(text, [(a, b, GENERAL[KINDS[k]]) for a, b, k in again])
    return text


def sanitise(docs: DataFrame) -> DataFrame:
    """The documents with their spans generalised or removed; the columns of ``docs``, ``n_chars`` renewed if it is one."""
    found = find(docs).where((F.size("spans") > 0) | F.col("terms").isNotNull()).dropDuplicates(["doc_id", "row"])
    rows = docs.select(whole_row(docs), "text", row_key().alias("key"))
    joined = rows.join(
        found, F.col("doc.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("row")), "left"
    ).select("doc", "text", "spans", "terms")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, spans, terms in zip(*(batch.column(c).to_pylist() for c in ("text", "spans", "terms")), strict=True):
                cut = [(s["start"], s["end"], GENERAL[KINDS[s["kind"]]]) for s in spans or []]
                cut += [(t["start"], t["end"], "" if t["removed"] else GENERAL["term"]) for t in terms or []]
                texts.append(cleared(masked(text, cut)) if cut else text)
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(texts, pa.string())], names=["doc", "text"])

    clean = joined.mapInArrow(run, T.StructType([joined.schema["doc"], T.StructField("text", T.StringType())]))
    changed = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        counted = F.when(F.col("text").isNotNull(), F.length("text")).otherwise(F.col("doc.n_chars"))
        changed["n_chars"] = counted.cast(docs.schema["n_chars"].dataType)
    return clean.select(row_columns(docs, **changed))
