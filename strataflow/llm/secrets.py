"""Secrets in texts: fixed patterns, and strings that look random to character Markov models.

Only DataFrame functions are used; a text is scanned where it lies and nothing is shuffled.

Two first-order Markov chains over ``ALPHABET`` are trained from labelled samples: the values that
the fixed patterns find are random strings, the other tokens of the same documents that are too short
to be judged are ordinary identifiers. A token of ``MIN_TOKEN`` characters or more is a secret if the log-likelihood ratio
of the two chains is high, in total and per character.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base patterns, the least length of a hit, and the order of kinds.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
MIN_VALUE, MIN_ACCESS, MIN_HEX = 8, 16, 32
KINDS = ("assign", "access", "hex", "markov")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_OF_ALPHABET = "[A-Za-z0-9+/_=-]"
MIN_TOKEN = 20
MIN_LOG_RATIO = 20.0
MIN_LOG_RATIO_PER_CHAR = 0.5

# A transition is estimated from its count, backed by BACKING pseudo-counts of the chain's own character
# frequencies; these in turn hold a share of UNIFORM of every character.
BACKING = 100.0
UNIFORM = 0.01

# The chains are fitted on about so many documents at most, those with the smallest hashes of their id:
# random strings are rare and come from more documents than ordinary identifiers.
RANDOM_DOCS = 20_000
ORDINARY_DOCS = 1_000

_SPANS = "array<struct<start:int,end:int,match:string>>"


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _scan(items: Column, count, of_type: str, step, start=0, view=None) -> Column:
    """Array of ``out`` of ``step(pos, item, seen)``, a struct of the next ``pos`` and ``out``, over ``items`` in order.

    An array grows by copying, so the items are taken in blocks of about the square root of their number: a
    block's results grow on their own and are added as one. ``seen`` is ``view(pos, block)``, made once per block.
    """
    none = F.array().cast(of_type)

    def over(items: Column) -> Column:
        size = count(items)
        width = F.ceil(F.sqrt(size)).cast("int")

        def block(done: Column, first: Column) -> Column:
            part = F.slice(items, first, F.least(width, size - first + 1))

            def inside(seen: Column) -> Column:
                def one(state: Column, item: Column) -> Column:
                    return _bound(step(state["pos"], item, seen), lambda new: F.struct(
                        new["pos"].alias("pos"), F.concat(state["out"], F.array(new["out"])).alias("out")))

                return F.aggregate(part, F.struct(done["pos"].alias("pos"), none.alias("out")), one, lambda d: F.struct(
                    d["pos"].alias("pos"), F.concat(done["out"], F.array(d["out"])).alias("out")))

            return _bound(F.lit(0) if view is None else view(done["pos"], part), inside)

        empty = F.array().cast(f"array<{of_type}>")
        firsts = F.sequence(F.lit(1), size, width)
        return F.when(size > 0, F.aggregate(
            firsts, F.struct(F.lit(start).alias("pos"), empty.alias("out")), block, lambda d: F.flatten(d["out"]))).otherwise(none)

    return _bound(items, over)


def _located(text: Column, pattern: str, present: Column) -> Column:
    """Matches with their places in code points; empty where ``present`` is false."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    # The text after the last hit is a gap without a match.
    pairs = F.zip_with(hits, F.split(text, pattern, -1), lambda hit, gap: F.struct(F.length(gap).alias("gap"), hit.alias("match")))

    def step(pos: Column, pair: Column, _) -> Column:
        start = pos + pair["gap"]
        end = start + F.length(pair["match"])
        return F.struct(end.alias("pos"), F.struct(start.alias("start"), end.alias("end"), pair["match"].alias("match")).alias("out"))

    found = _scan(pairs, lambda p: F.size(p) - 1, _SPANS, step)
    return F.when(present, found).otherwise(F.array().cast(_SPANS))


def _indices(token: Column) -> Column:
    return F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)


def _pairs(token: Column) -> Column:
    """Numbers of the character pairs of a token over the alphabet."""
    places = _indices(token)
    count = F.greatest(F.size(places) - 1, F.lit(0))
    first, second = F.slice(places, F.lit(1), count), F.slice(places, F.lit(2), count)
    return F.zip_with(first, second, lambda x, y: x * len(ALPHABET) + y)


def _base_spans(text: Column) -> list[Column]:
    """Arrays of ``kind, start, end, match`` of the fixed patterns, unsuccessful matches dropped."""
    assign = F.filter(
        _located(text, ASSIGN, text.rlike("(?i)password|passwd|secret|token|api_?key")),
        lambda s: F.length(F.regexp_extract(s["match"], ASSIGN, 2)) >= MIN_VALUE)
    access = F.filter(_located(text, ACCESS, text.contains("AKIA")),
                      lambda s: F.length(s["match"]) >= MIN_ACCESS)
    # Shorter runs are dropped anyway, and cutting them out of the pattern moves no other match.
    digits = _located(text, f"[0-9a-f]{{{MIN_HEX},}}+", text.rlike(f"[0-9a-f]{{{MIN_HEX}}}"))
    return [_of_kind(spans, number) for number, spans in enumerate((assign, access, digits))]


def _of_kind(spans: Column, number: int) -> Column:
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(number).alias("kind"), s["end"].alias("end"), s["match"].alias("match")))


def _sample(docs: DataFrame, share: float) -> DataFrame:
    text = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return text if share >= 1 else text.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))


def train(docs: DataFrame, random_docs: int = RANDOM_DOCS, ordinary_docs: int = ORDINARY_DOCS) -> list[float]:
    """Log-likelihood ratio (random against ordinary) of every character pair, row by row of the alphabet.

    Counts are made on the executors; the driver gets at most two rows per pair. Without any
    example of a kind its chain is uniform.
    """
    total = max(docs.count(), 1)
    assign, access, digits = _base_spans(F.col("text"))
    values = F.transform(assign, lambda s: F.regexp_extract(s["match"], ASSIGN, 2))
    others = F.transform(F.concat(access, digits), lambda s: s["match"])
    random = _sample(docs, random_docs / total).select(F.lit(True).alias("random"), F.explode(F.concat(values, others)).alias("token"))
    rest = F.regexp_replace(F.regexp_replace(F.col("text"), ASSIGN, " "), f"{ACCESS}|[0-9a-f]{{{MIN_HEX},}}", " ")
    short = f"(?<!{_OF_ALPHABET}){_OF_ALPHABET}{{6,{MIN_TOKEN - 1}}}+(?!{_OF_ALPHABET})"
    ordinary = _sample(docs, ordinary_docs / total).select(
        F.lit(False).alias("random"), F.explode(F.regexp_extract_all(rest, F.lit(short), F.lit(0))).alias("token"))
    counts = (
        random.union(ordinary)
        .select("random", F.explode(_pairs(F.regexp_replace("token", r"[^A-Za-z0-9+/_=-]", ""))).alias("pair"))
        .groupBy("random", "pair").count().collect()
    )
    return log_ratios({(r["random"], r["pair"]): r["count"] for r in counts})


def log_ratios(counts: dict[tuple[bool, int], int]) -> list[float]:
    """Smoothed transition probabilities of both chains, compared. A character that neither has seen is neutral."""
    size = len(ALPHABET)

    def chain(random: bool) -> list[float]:
        table = [[counts.get((random, a * size + b), 0) for b in range(size)] for a in range(size)]
        total = sum(map(sum, table))
        ends = [sum(row[b] for row in table) for b in range(size)]
        single = [(1 - UNIFORM) * (n / total if total else 1 / size) + UNIFORM / size for n in ends]
        return [math.log((n + BACKING * p) / (sum(row) + BACKING)) for row in table for n, p in zip(row, single)]

    return [round(r - o, 6) for r, o in zip(chain(True), chain(False))]


def _random_looking(spans: Column, ratios: list[float]) -> Column:
    table = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<double>")  # folded to a constant

    def keep(span: Column) -> Column:
        total = F.aggregate(_pairs(span["match"]), F.lit(0.0), lambda sum_, pair: sum_ + F.get(table, pair))
        least = F.greatest(F.lit(MIN_LOG_RATIO), MIN_LOG_RATIO_PER_CHAR * F.length(span["match"]))
        return total >= least

    return F.filter(spans, keep)


def spans_of(text: Column, ratios: list[float]) -> Column:
    """All spans of a text: an array of ``start, kind (number), end, match``, sorted."""
    text = F.coalesce(text, F.lit(""))
    base = F.concat(*_base_spans(text))
    pattern = f"(?<!{_OF_ALPHABET}){_OF_ALPHABET}{{{MIN_TOKEN},}}+"
    tokens = _random_looking(_located(text, pattern, text.rlike(pattern)), ratios)
    return _without_overlaps(F.concat(base, _of_kind(tokens, 3)))


_ALL = "array<struct<start:int,kind:int,end:int,match:string>>"
_NOT_YET = 2**31 - 1


def _without_overlaps(spans: Column) -> Column:
    """Spans by start and kind; random-looking ones that overlap a fixed pattern are left out.

    Two scans: forward against the furthest end of a pattern so far, backward against its nearest start.
    """
    fixed = lambda s: s["kind"] < len(KINDS) - 1

    def forward(end: Column, s: Column, _) -> Column:
        return F.struct(F.when(fixed(s), F.greatest(end, s["end"])).otherwise(end).alias("pos"),
                        F.when(fixed(s) | (s["start"] >= end), s).alias("out"))

    def backward(start: Column, s: Column, _) -> Column:
        return F.struct(F.when(fixed(s), F.least(start, s["start"])).otherwise(start).alias("pos"),
                        F.when(fixed(s) | (s["end"] <= start), s).alias("out"))

    def mixed(spans: Column) -> Column:
        some = F.exists(spans, fixed) & F.exists(spans, lambda s: ~fixed(s))
        ahead = _scan(F.array_sort(spans), F.size, _ALL, forward)
        back = _scan(F.reverse(F.filter(ahead, lambda s: s.isNotNull())), F.size, _ALL, backward, _NOT_YET)
        return F.when(some, F.reverse(F.filter(back, lambda s: s.isNotNull()))).otherwise(F.array_sort(spans))

    return _bound(spans, mixed)


def find_secrets(docs: DataFrame, ratios: list[float] | None = None) -> DataFrame:
    """``doc_id, spans`` of every row of ``docs (doc_id, text)``; a null text is empty.

    ``spans`` holds ``start, kind, end, match`` in code points, sorted by start, then kind (a
    number, see ``KINDS``). Every row is scanned for itself, whatever its id; other columns are ignored. An empty
    table gives an empty result. The time for one text grows with the power 1.5 of its hits.
    """
    ratios = train(docs) if ratios is None else ratios
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), spans_of(F.col("text"), ratios).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts per kind, checksum of the base spans, and all spans as text."""
    names = F.array(*map(F.lit, KINDS))
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda number: F.size(F.filter("spans", lambda s: s["kind"] == number)).cast("long")
    return found.select(
        "doc_id", *(count(i).alias(f"n_{kind}") for i, kind in enumerate(KINDS[:3])),
        F.sha2(written(F.filter("spans", lambda s: s["kind"] < 3)), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
        count(3).alias("n_markov"),
    )


def redact(docs: DataFrame, ratios: list[float] | None = None, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``mark``; texts without one, and null ones, stay as they are.

    All columns stay, whatever their names; overlapping spans get one mark; rows without id are redacted too.
    """
    ratios = train(docs) if ratios is None else ratios
    text = F.col("text")

    # Pieces of a block are cut from the part of the text that the block covers, not from the whole text.
    def part(pos: Column, block: Column) -> Column:
        end = F.greatest(pos, F.array_max(F.transform(block, lambda s: s["end"])))
        return F.struct(pos.alias("from"), F.substring(text, pos + 1, end - pos).alias("text"))

    def step(pos: Column, span: Column, seen: Column) -> Column:
        gap = F.substring(seen["text"], pos - seen["from"] + 1, span["start"] - pos)
        piece = F.when(span["start"] >= pos, F.concat(gap, F.lit(mark))).otherwise("")
        return F.struct(F.greatest(pos, span["end"]).alias("pos"), piece.alias("out"))

    found = "_spans"
    while found in docs.columns:
        found += "_"
    last = F.array_max(F.transform(found, lambda s: s["end"]))
    pieces = _scan(F.col(found), F.size, "array<string>", step, view=part)
    cleaned = F.concat(F.array_join(pieces, ""), F.substring(text, last + 1, F.length(text)))
    marked = docs.withColumn(found, spans_of(text, ratios))
    return marked.withColumn("text", F.when(F.size(found) > 0, cleaned).otherwise(text)).drop(found)
