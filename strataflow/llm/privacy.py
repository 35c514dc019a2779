"""Personal data: fixed patterns, and terms that reveal a protected entity by co-occurrence.

The patterns find e-mail addresses, IP addresses, card and phone numbers. Each distinct value is a
protected entity. How much a term ``t`` near an entity ``e`` discloses it is estimated from the whole
corpus as pointwise mutual information over the entity's information content,

    PMI(e; t) / IC(e) = log(p(e|t) / p(e)) / log(1 / p(e)),  p(e) = n(e) / N,
    p(e|t) = (n(e,t) + PRIOR p(e)) / (n(t) + PRIOR),

where ``n`` counts documents and ``n(e,t)`` those in which ``t`` stands near ``e`` (after Sanchez and
Batet 2016). 1 means that the term occurs with the entity only. Above ``GENERALISE`` a term is replaced by
its kind, above ``REMOVE`` it is removed. Every pair is scored, also one seen in a single document: the
``PRIOR``, more documents in which the term meets the entity as often as any text does, lowers what
few documents say. A term of one document still discloses an entity that is rare in the corpus.
Co-occurrence is counted near the entities; what discloses one is marked wherever it stands in any text.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.tokens import bound_batches, chunks, words
from strataflow.storage import materialize

KINDS = ("email", "ip", "card", "phone", "term")

# The base patterns. An e-mail's local part and domain are matched from its @.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_DOTTED = re.compile(r"[0-9]+(?:\.[0-9.]*)?")
_NO_DIGIT = re.compile(r"[^0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")

WINDOW = 8  # words on each side of an entity, as far as they lie within WINDOW_CHARS
WINDOW_CHARS = 400
PRIOR = 1.25  # documents: one co-occurrence discloses an entity of fewer than 1 in (1 + PRIOR)^5 = 58 documents
GENERALISE, REMOVE = 0.8, 0.95

_HELD_WORDS = 4 << 20
SIEVE_BITS = 26  # 8 MB of bits, two per flagged term; whatever passes is joined exactly


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def _ips(text: str) -> Iterator[tuple[int, int]]:
    # A match lies in one run of digits and dots; runs with fewer than three dots are skipped.
    for run in _DOTTED.finditer(text):
        if run.group().count(".") >= 3:
            for m in _IP.finditer(text, run.start(), run.end()):
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                    yield m.span()


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _NO_DIGIT.sub("", m.group())
            if 16 <= len(digits) <= 19 and _luhn(digits):
                yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_NO_DIGIT.sub("", m.group())) <= 15:
                yield m.span()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` in code points, by kind as in ``KINDS``, then start."""
    finders = (_emails, _ips, _cards, _phones)
    return [(kind, start, end) for kind, find in enumerate(finders) for start, end in find(text)]


def _entity(kind: int, value: str) -> int:
    """Number of a protected entity; its spelling does not count."""
    plain = value.lower() if kind == 0 else value if kind == 1 else _NO_DIGIT.sub("", value)
    return int.from_bytes(hashlib.blake2b(f"{kind}:{plain}".encode(), digest_size=8).digest(), "little", signed=True)


def _near(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """Places of the words around a span."""
    low, high = max(0, start - WINDOW_CHARS), min(len(text), end + WINDOW_CHARS)
    left = [m.span() for m in _WORD.finditer(text, low, start)]
    right = [m.span() for m in _WORD.finditer(text, end, high)]
    # Pieces of words at the rims, and what sticks to the entity, are no terms.
    if left and left[0][0] == low and low > 0:
        left = left[1:]
    if left and left[-1][1] == start:
        left = left[:-1]
    if right and right[0][0] == end:
        right = right[1:]
    if right and right[-1][1] == high and high < len(text):
        right = right[:-1]
    return left[-WINDOW:] + right[:WINDOW]


_SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
_PLACE = pa.struct([("term", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])
_SPANS_DDL = "array<struct<kind:int,start:int,end:int>>"
_PLACES_DDL = "array<struct<term:long,start:int,end:int>>"


def _term_hashes(terms: list[str]) -> list[int]:
    data = np.frombuffer(" ".join(terms).encode("utf-8"), np.uint8)
    return words(data, np.array([0, len(data)]), lower=True).hash.view(np.int64).tolist()


def _covered(spans: list[tuple[int, int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the union of spans."""
    starts, ends = [], []
    for start, end in sorted((s, e) for _, s, e in spans):
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    return starts, ends


def _is_covered(starts: list[int], ends: list[int], start: int, end: int) -> bool:
    before = bisect_left(starts, end) - 1  # the last covered stretch that starts before the word ends
    return before >= 0 and ends[before] > start


def _contexts(text: str | None) -> set[tuple[int, int | None]]:
    """Entities of a text, each alone and with every term near it."""
    text = text or ""
    spans = base_spans(text)
    starts, ends = _covered(spans)
    pairs, owners, terms = set(), [], []
    for kind, start, end in spans:
        entity = _entity(kind, text[start:end])
        pairs.add((entity, None))
        for s, e in _near(text, start, end):
            if not _is_covered(starts, ends, s, e):
                owners.append(entity)
                terms.append(text[s:e])
    return pairs | set(zip(owners, _term_hashes(terms)))


def _pair_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entities and their terms, once per text; a row without entity has the number of texts."""
    for batch in batches:
        pairs = [(None, None, batch.num_rows)]
        pairs += [(entity, term, 1) for text in batch["text"].to_pylist() for entity, term in _contexts(text)]
        yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*pairs)], names=["entity", "term", "n"])


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per term, summed over many documents of a task before anything is shuffled."""
    held, size = [], 0

    def counted() -> pa.RecordBatch:
        terms, counts = np.unique(np.concatenate(held), return_counts=True)
        return pa.record_batch([terms.view(np.int64), counts], names=["term", "n_t"])

    for batch in batches:
        for _, data, offsets in chunks(batch["text"]):
            found = words(data, offsets, lower=True)
            held += [np.unique(found.hash[a:b]) for a, b in zip(found.first[:-1], found.first[1:])]
            size += len(found.hash)
            if size > _HELD_WORDS:
                yield counted()
                held, size = [], 0
    if held:
        yield counted()


def disclosures(texts: DataFrame, generalise: float = GENERALISE) -> DataFrame:
    """``entity, term, disclosure`` of all pairs that reach ``generalise``.

    Document counts of terms cover every text; only those of terms that may disclose are joined.
    """
    counted = materialize(
        texts.select("text").mapInArrow(_pair_up, "entity long, term long, n long")
        .groupBy("entity", "term").agg(F.sum("n").alias("n")), "privacy_pairs")
    n_docs = counted.where("entity is null").agg(F.coalesce(F.sum("n"), F.lit(1))).first()[0]
    entities = counted.where("entity is not null and term is null").select("entity", F.col("n").alias("n_e"))
    pairs = counted.where("term is not null").withColumnRenamed("n", "n_et")
    frequency = texts.select("text").mapInArrow(_count_terms, "term long, n_t long").groupBy("term").agg(F.sum("n_t").alias("n_t"))
    base = F.col("n_e") / F.lit(float(n_docs))
    given = (F.col("n_et") + PRIOR * base) / (F.col("n_t") + PRIOR)
    score = F.when(base < 1, F.ln(given / base) / -F.ln(base)).otherwise(F.lit(0.0))
    return (
        pairs.join(entities, "entity").join(frequency, "term")
        .select("entity", "term", score.alias("disclosure")).where(F.col("disclosure") >= generalise)
    )


def _slots(term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    term = term.view(np.uint64)
    return term >> np.uint64(64 - SIEVE_BITS), term & np.uint64((1 << SIEVE_BITS) - 1)


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        slot = np.unique(np.concatenate(_slots(batch["term"].to_numpy())))
        yield pa.record_batch([(slot >> np.uint64(6)).view(np.int64), np.left_shift(np.uint64(1), slot & np.uint64(63)).view(np.int64)],
                              names=["at", "bit"])


def _sieve(terms: DataFrame) -> np.ndarray:
    """Bits that every one of ``terms`` has and few other words have; of one size for any corpus."""
    marked = terms.select("term").mapInArrow(_mark, "at long, bit long").groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    sieve = np.zeros(1 << (SIEVE_BITS - 6), np.uint64)
    sieve[marked["at"].to_numpy()] = marked["bits"].to_numpy().view(np.uint64)
    return sieve


def _passes(sieve: np.ndarray, term: np.ndarray) -> np.ndarray:
    first, second = (sieve[s >> np.uint64(6)] >> (s & np.uint64(63)) & np.uint64(1) for s in _slots(term))
    return (first & second).astype(bool)


def _locate(sent, keep_text: bool):
    """Base spans of every text, and the places of all its words that the sieve lets through."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve = sent.value
        names = ["doc_id"] + ["text"] * keep_text
        for batch in batches:
            found, places = [base_spans(text or "") for text in batch["text"].to_pylist()], []
            for row, data, offsets in chunks(batch["text"]):
                at = words(data, offsets, lower=True)
                passed = np.flatnonzero(_passes(sieve, at.hash))
                bounds = np.searchsorted(passed, at.first)
                points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # code points before a byte
                for i, (low, high) in enumerate(zip(bounds[:-1], bounds[1:])):
                    starts, ends = _covered(found[row + i]) if high > low else ((), ())
                    some = passed[low:high]
                    begin, end = (points[x[some]] - points[offsets[i]] for x in (at.start, at.end))
                    places.append([
                        {"term": t, "start": s, "end": e}
                        for t, s, e in zip(at.hash[some].view(np.int64).tolist(), begin.tolist(), end.tolist())
                        if not _is_covered(starts, ends, s, e)])
            spans = [[{"kind": k, "start": s, "end": e} for k, s, e in f] for f in found]
            yield pa.record_batch(
                [*(batch[c] for c in names), pa.array(spans, pa.list_(_SPAN)), pa.array(places, pa.list_(_PLACE))],
                names=[*names, "base", "places"])

    return run


def find_personal_data(docs: DataFrame, keep_text: bool = False, generalise: float = GENERALISE,
                       remove: float = REMOVE) -> DataFrame:
    """``doc_id, base, terms`` (and ``text``) of every row of ``docs (doc_id, text)``.

    ``base`` are the patterns' spans ``kind, start, end``; ``terms`` those of all words of all texts that
    disclose any entity, ``start, end, remove``. Code points, ends exclusive. A null text is empty. Every
    row is a document of its own, also if rows repeat; other columns are ignored.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    flagged = materialize(
        disclosures(texts, generalise).groupBy("term").agg(F.max("disclosure").alias("d")), "privacy_flagged")
    kept = ", text string" * keep_text
    located = texts.mapInArrow(_locate(spark.sparkContext.broadcast(_sieve(flagged)), keep_text),
                               f"doc_id long{kept}, base {_SPANS_DDL}, places {_PLACES_DDL}")
    # The written table fixes the row numbers.
    found = materialize(located.withColumn("row", F.monotonically_increasing_id()), "privacy_located")
    terms = (
        found.where(F.size("places") > 0).select("row", F.inline("places")).join(flagged, "term")
        .groupBy("row").agg(F.array_sort(F.collect_list(
            F.struct("start", "end", (F.col("d") >= remove).alias("remove")))).alias("terms"))
    )
    none = F.array().cast("array<struct<start:int,end:int,remove:boolean>>")
    return found.join(terms, "row", "left").select(
        "doc_id", *["text"] * keep_text, "base", F.coalesce("terms", none).alias("terms"))


def digest(found: DataFrame) -> DataFrame:
    """Counts per kind, checksum of the base spans, and all spans as text."""
    names = F.array(*map(F.lit, KINDS))
    base = F.transform("base", lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
    terms = F.transform("terms", lambda s: F.concat_ws(
        ":", F.lit(KINDS[4]), s["start"].cast("string"), s["end"].cast("string")))
    of_kind = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        *(of_kind(k).alias(f"n_{name}") for k, name in enumerate(KINDS[:4])),
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join(F.concat(base, terms), ",").alias("spans"),
        F.size("terms").cast("long").alias("n_term"),
    )


def _shape(term: str) -> str:
    return "<NUMBER>" if any(c.isdigit() for c in term) else "<NAME>" if term[:1].isupper() else "<TERM>"


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, base, terms in zip(batch["text"].to_pylist(), batch["base"].to_pylist(), batch["terms"].to_pylist()):
            edits = [(s["start"], s["end"], f"<{KINDS[s['kind']].upper()}>") for s in base]
            edits += [(s["start"], s["end"], "" if s["remove"] else _shape(text[s["start"]:s["end"]])) for s in terms]
            parts, at = [], 0
            for start, end, new in sorted(edits):
                if start >= at:
                    parts += [text[at:start], new]
                at = max(at, end)
            out.append(None if text is None else "".join([*parts, text[at:]]))
        yield pa.record_batch([batch["doc_id"], pa.array(out, pa.string())], names=["doc_id", "text"])


def sanitise(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with entities masked by kind, disclosing terms generalised or removed."""
    return find_personal_data(docs, keep_text=True).mapInArrow(_rewrite, "doc_id long, text string")
