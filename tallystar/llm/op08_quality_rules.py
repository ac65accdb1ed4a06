"""Quality rules by gradient-boosted trees over document statistics.

Every document is turned into statistics; base rules reject some outright, and boosted trees, fitted to labelled
statistics under monotonic constraints and flattened into node arrays, decide about the rest.

The trees are fitted to at most SAMPLE labelled rows, those of the smallest hash of doc_id among the folds that
may be learned; everything else covers all rows.

Defined cases: a null or empty text has no words and fails the base rules. Labels that are null, or ids that are
labelled twice with different labels, are not learned from. Without usable labels the verdict is to keep. Extra
columns are ignored; repeated rows are judged each.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.llm import boosting
from tallystar.llm.common import durable, held_out, ids, map_batches, stream, table, text_bytes

SAMPLE = 20_000
KEEP_FROM = 0.5

SYMBOLS = b"#*$%&|<>"
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
UPPER = bytes(range(65, 91))
DIGITS = bytes(range(48, 58))
PUNCTUATION = bytes(b for b in range(33, 127) if not chr(b).isalnum())

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
# Statistic and its constraint: +1 quality may only rise with it, -1 only fall, 0 free.
FEATURES = [
    ("log_words", 1), ("mean_word", 0), ("symbol_rate", -1), ("dup_line_rate", -1), ("repeat_word_rate", -1),
    ("upper_rate", -1), ("digit_rate", -1), ("punctuation_rate", -1), ("distinct_rate", 0), ("words_per_line", 0),
    ("top_word_rate", 0), ("short_line_rate", 0), ("long_word_rate", -1), ("sentence_end_rate", 0), ("same_end_rate", -1),
]
NAMES = [name for name, _ in FEATURES]

SCHEMA = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", " + ", ".join(f"{c} double" for c in NAMES)
ARROW = pa.schema(
    [("doc_id", pa.int64())] + [(c, pa.int64()) for c in COUNTS] + [(c, pa.float64()) for c in NAMES]
)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window standing twice or more in the text."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    total, until = 0, 0
    for start, window in enumerate(windows):
        if times[window] > 1:
            total += start + 3 - max(start, until)
            until = start + 3
    return total


def statistics(text: bytes) -> tuple:
    words = text.split()
    n = len(words)
    lines = [line for line in text.split(b"\n") if line.strip()]
    visible = len(text) - sum(text.count(s) for s in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
    # Code points: bytes that do not continue one.
    word_chars = visible - len(text) + len(text.decode("utf-8", "replace")) if not text.isascii() else visible
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    dup_lines = len(lines) - len(set(lines))
    repeats = repeated_words(words)
    times = Counter(words)
    chars, count, n_lines = max(word_chars, 1), max(n, 1), max(len(lines), 1)
    ends = Counter(w[-2:] for w in words)

    def rate(of: bytes) -> float:
        return (len(text) - len(text.translate(None, of))) / chars

    return (
        n, word_chars, symbols, dup_lines, repeats,
        float(np.log1p(n)), word_chars / count, symbols / chars, dup_lines / n_lines, repeats / count,
        rate(UPPER), rate(DIGITS), rate(PUNCTUATION), len(times) / count, n / n_lines,
        max(times.values(), default=0) / count, sum(len(x) < 20 for x in lines) / n_lines,
        sum(len(w) > 24 for w in words) / count, (text.count(b".\n") + text.count(b". ") + text.endswith(b".")) / count,
        max(ends.values(), default=0) / count,
    )


def _statistics_batch(batch: pa.RecordBatch) -> dict[str, list]:
    rows = [statistics(text) for text in text_bytes(batch)]
    return dict(zip(ARROW.names, [ids(batch), *map(list, zip(*rows, strict=True))], strict=True))


def document_statistics(docs: DataFrame) -> DataFrame:
    return map_batches(docs.select("doc_id", "text"), partial(stream, one=_statistics_batch, schema=ARROW), SCHEMA)


def fit_quality(statistics_: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> boosting.Forest:
    """Fit on at most `sample` labelled rows, chosen by hash; the driver sees those rows' statistics only."""
    usable = (
        labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("y"), F.max("quality").alias("other"))
        .filter("y = other")
        .select("doc_id", "y")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    once = statistics_.dropDuplicates(["doc_id"]).select("doc_id", *NAMES)
    learned = once.join(usable, "doc_id").orderBy("doc_id").toPandas()
    return boosting.fit(
        learned[NAMES].to_numpy(float), learned["y"].to_numpy(float), [constraint for _, constraint in FEATURES]
    )


def quality_rules(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per document: base counts, base verdict, the trees' score and the final verdict."""
    counted = durable(document_statistics(docs))
    forest = fit_quality(counted, labels, sample)

    def score(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in iterator:
            rows = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in NAMES], axis=1)
            columns = [batch.column(c) for c in ["doc_id", *COUNTS]] + [pa.array(forest.score(rows))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *COUNTS, "score"])

    scored = map_batches(counted, score, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", score double")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return scored.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("score") >= KEEP_FROM))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return verdicts.select("doc_id", *COUNTS, "base_failed", "kept", "score")
