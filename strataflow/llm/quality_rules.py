"""Quality rules whose thresholds follow the corpus: quantile sketches per language and source.

Every document is measured (:func:`measure`). Each language and source gets a mergeable KLL sketch of
every ratio; sketches of a language, and of all, are merged from these. The outer fences of a group of ``n`` documents
(Tukey: beyond ``FENCE`` interquartile ranges from the quartiles, where the range is at least a floor) weigh
``n / (n + PRIOR)``, those of its language the rest, which in turn lean on all documents the same way. So a
threshold moves smoothly from the corpus to the group as the group grows. The thresholds are joined to the measures; texts
are read once and never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.tokens import IS_SPACE, bound_batches, chunks, mix, shingles, split_runs, words
from strataflow.storage import materialize

# Fixed base rule.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

FENCE = 3.0
PRIOR = 10  # documents of a group that weigh as much as its language

# Ratio -> least interquartile range, and whether low values fail as well.
RATIOS = {
    "symbol_ratio": (0.02, False),
    "dup_line_ratio": (0.1, False),
    "repeat_ratio": (0.1, False),
    "upper_ratio": (0.05, False),
    "mean_word_length": (0.75, True),
}

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_CONTINUED = (np.arange(256) & 0xC0) == 0x80
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True

_COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper")


def _later_equal(keys: np.ndarray) -> np.ndarray:
    """True where the same key occurs at an earlier index."""
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    return out


def _repeated(keys: np.ndarray) -> np.ndarray:
    """True where a key occurs at another index too."""
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Number of set flags between consecutive bounds."""
    running = np.concatenate([[0], np.cumsum(flags)])
    return np.diff(running[bounds])


def count_chunk(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    space = IS_SPACE[data]
    found = words(data, offsets)
    texts = len(offsets) - 1

    lines = split_runs(data, offsets, data != 10)
    solid = np.concatenate([[0], np.cumsum(~space)])
    worded = solid[lines.end] > solid[lines.start]
    keys = lines.hash + mix(lines.text.astype(np.uint64) + np.uint64(1))
    again = np.zeros(len(keys), bool)
    again[worded] = _later_equal(keys[worded])

    hashed, at = shingles(found.hash, found.first, 3, whole=False)
    text = np.repeat(np.arange(texts), np.diff(at))
    begin = np.arange(len(hashed)) - at[text] + found.first[text]
    twice = begin[_repeated(hashed + mix(text.astype(np.uint64) + np.uint64(1)))]
    covered = np.zeros(len(found.start) + 2, bool)
    for j in range(3):
        covered[twice + j] = True

    return {
        "n_words": np.diff(found.first),
        "word_chars": _per_text(~space & ~_CONTINUED[data], offsets),
        "n_symbols": _per_text(_SYMBOL[data], offsets),
        "n_lines": _per_text(worded, lines.first),
        "n_dup_lines": _per_text(again, lines.first),
        "n_repeat_words": _per_text(covered[:len(found.start)], found.first),
        "n_upper": _per_text(_UPPER[data], offsets),
    }


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, data, offsets in chunks(batch["text"]):
            counts = count_chunk(data, offsets)
            size = len(offsets) - 1
            yield pa.record_batch(
                [batch[c].slice(row, size) for c in ("doc_id", "lang", "source")]
                + [pa.array(counts[c].astype(np.int64)) for c in _COUNTS],
                names=["doc_id", "lang", "source", *_COUNTS])


def measure(docs: DataFrame) -> DataFrame:
    """Counts of every text of ``docs (doc_id, text, lang, source)`` and the ratios made of them."""
    bound_batches(docs.sparkSession)
    counted = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
    ).mapInArrow(_measure, "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in _COUNTS))

    def ratio(part: str, whole: str):
        return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))

    return counted.select(
        "*",
        ratio("n_symbols", "word_chars").alias("symbol_ratio"),
        ratio("n_dup_lines", "n_lines").alias("dup_line_ratio"),
        ratio("n_repeat_words", "n_words").alias("repeat_ratio"),
        ratio("n_upper", "word_chars").alias("upper_ratio"),
        ratio("word_chars", "n_words").alias("mean_word_length"),
        ((F.col("n_words") < MIN_WORDS)
         | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))).alias("base_failed"),
    )


def _fences(sketched: DataFrame, fence: float, name: str) -> DataFrame:
    """Sketches replaced by a struct of lowest and highest values; ratios that only fail upwards have no lowest one."""
    out = []
    for r, (floor, low) in RATIOS.items():
        q1, q3 = (F.kll_sketch_get_quantile_double(F.col(r), F.lit(q)) for q in (0.25, 0.75))
        spread = fence * F.greatest(q3 - q1, F.lit(floor))
        out.append(F.struct((q1 - spread if low else F.lit(None).cast("double")).alias("low"), (q3 + spread).alias("high")).alias(r))
    return sketched.withColumn(name, F.when(F.col("n") > 0, F.struct(*out))).drop(*RATIOS)


def _lean(own: str, wider: str, prior: int) -> F.Column:
    """``own`` fences by ``n / (n + prior)`` and ``wider`` ones by the rest; ``wider`` alone where there is no document."""
    share = F.col("n") / (F.col("n") + F.lit(prior))
    mixed = [
        F.struct(*((share * F.col(f"{own}.{r}.{end}") + (1 - share) * F.col(f"{wider}.{r}.{end}")).alias(end) for end in ("low", "high"))
                 ).alias(r)
        for r in RATIOS
    ]
    return F.when(F.col(own).isNotNull(), F.struct(*mixed)).otherwise(F.col(wider))


def thresholds(measured: DataFrame, prior: int = PRIOR, fence: float = FENCE) -> DataFrame:
    """``lang, source`` and ``allowed``: a lowest (null: none) and a highest value of every ratio.

    Sketches cover the documents that pass the base rule. Null is a language or source of its own.
    """
    sketches = measured.groupBy("lang", "source").agg(
        F.count_if(~F.col("base_failed")).alias("n"),
        *(F.kll_sketch_agg_double(F.when(~F.col("base_failed"), F.col(r))).alias(r) for r in RATIOS),
    )
    groups = materialize(sketches, "quality_sketches")
    merged = [F.sum("n").alias("n"), *(F.kll_merge_agg_double(r).alias(r) for r in RATIOS)]
    overall = _fences(groups.where("n > 0").agg(*merged), fence, "overall").select("overall")
    by_lang = (
        _fences(groups.where("n > 0").groupBy("lang").agg(*merged), fence, "own").join(overall, F.lit(True), "left")  # one row
        .select(F.col("lang").alias("l"), _lean("own", "overall", prior).alias("by_lang"))
    )
    return (
        _fences(groups, fence, "own").join(by_lang, F.col("lang").eqNullSafe(F.col("l")), "left")
        .select("lang", "source", _lean("own", "by_lang", prior).alias("allowed"))
    )


def judge(docs: DataFrame, prior: int = PRIOR, fence: float = FENCE) -> DataFrame:
    """One row per document: its counts and ratios, ``base_failed``, ``kept`` and ``failed_rules``.

    Null or empty texts have zero words and fail the base rule. Extra columns are ignored, repeated
    rows are judged alike, and an empty table gives no rows.
    """
    measured = materialize(measure(docs), "quality_measures")
    bounds = thresholds(measured, prior, fence).select(
        F.col("lang").alias("l"), F.col("source").alias("s"), "allowed")
    same = F.col("lang").eqNullSafe(F.col("l")) & F.col("source").eqNullSafe(F.col("s"))
    failed = F.array_compact(F.array(*(
        F.when((F.col(r) > F.col(f"allowed.{r}.high")) | (F.col(r) < F.col(f"allowed.{r}.low")), F.lit(r)) for r in RATIOS
    )))
    joined = measured.join(bounds, same, "left").withColumn("failed_rules", failed)
    return joined.withColumn(
        "kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)
    ).drop("l", "s", "allowed")
