"""Toxicity by noisy-channel deobfuscation.

1. A character language model: counts of four characters in a row over the whole corpus, interpolated.
2. Suspicious tokens of a text (figures or symbols next to letters, doubled letters, separators within a word,
   single letters in a row with one or two separators) become character lattices: a figure may stand for a letter, a repeated letter or a
   separator may be dropped. Viterbi finds the reading of smallest cost under channel and model; it replaces
   the token. Other tokens have a single path and stay. Suspicious tokens are counted over all documents: the
   frequent ones are decoded once for the corpus, rare ones where they stand, and a frequent token of plain letters
   with ordinary doubled letters (worthless) is a word and stays as it is.
3. The restored text is scored by a lexicon of words and word beginnings, and a logistic model over what it
   finds, both learned from labelled rows. Of labelled near copies, one is learned from.

Labels are learned from at most SAMPLE rows of the folds that may be learned, those of the smallest hash of
doc_id; labels, lang, source and doc_id are never inputs of a score. Everything else covers all rows.

Defined cases: null and empty texts are scored as texts without words. Null labels, and ids with contradicting
labels, are not learned from; without usable labels every score is the smoothed rate of label 1. Extra columns
are ignored; repeated rows are scored each.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tallystar.llm.common import durable, held_out, ids, map_batches, table, text_bytes

SAMPLE = 20_000
TOXIC_FROM = 0.7
SLICE = 512  # documents that are looked at together
HELD = 200_000  # different suspicious tokens a task counts before it hands them on
MOST_TOKENS = 200_000  # frequent tokens that are decoded once for the corpus
LEAST_TOKEN = 4

SYMBOLS = 28  # 0 boundary, 1 to 26 letters, 27 other letters
ORDER = 4

# What a figure or symbol may stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "*": "aeiou",
}
SEPARATORS = " .-_*,/"

# Channel costs, in nats.
AS_LETTER, AS_BOUNDARY, DROP_SEPARATOR, DROP_SYMBOL, STAR = 0.7, 1.5, 0.5, 2.5, 1.5
DROP_DOUBLE, DROP_REPEAT = 3.0, 0.3  # a letter like the one before; one of three or more

LEAST_DOCS = 5  # toxic documents a lexicon word must occur in
LEAST_RATIO = 12.0  # and the log likelihood ratio against chance
PREFIXES = (4, 5, 6, 7)  # lengths of word beginnings, in bytes

CODE = np.zeros(256, np.int64)
CODE[97:123] = CODE[65:91] = np.arange(1, 27)
CODE[128:] = 27
LETTER = CODE > 0
FIGURE = np.isin(np.arange(256), list(b"0123456789"))
SYMBOL = np.isin(np.arange(256), list(b"@$!|+*("))
SPACE = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c\x00"))
SEPARATOR = np.isin(np.arange(256), list(SEPARATORS.encode()))
SIGNS = re.compile(rb"[A-Za-z0-9\x80-\xff@$!|+(]")
# A single sign has separators or white space around it.
SPELLED = re.compile(rb"(?<![^ .\-_*,/\t\n\r\x0b\x0c\x00])%b(?:[ .\-_*,/]{1,2}%b)+(?![^ .\-_*,/\t\n\r\x0b\x0c\x00])" % (SIGNS.pattern, SIGNS.pattern))

WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def gather(docs: DataFrame) -> DataFrame:
    """Over all documents: (run, null, n) for each run of ORDER characters, (null, token, n) for each suspicious token.

    Tasks sum both before they are shuffled; they hold HELD different tokens at most.
    """
    size = SYMBOLS**ORDER

    def rows(run: np.ndarray, tokens: list[bytes], n) -> pa.RecordBatch:
        columns = [pa.array(run, pa.int32()), pa.nulls(len(run), pa.binary())] if len(run) else [pa.nulls(len(tokens), pa.int32()), pa.array(tokens, pa.binary())]
        return pa.RecordBatch.from_arrays([*columns, pa.array(n, pa.int64())], names=["run", "token", "n"])

    def count(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(size, np.int64), Counter()
        for batch in iterator:
            for at in range(0, batch.num_rows, SLICE):
                texts = text_bytes(batch.slice(at, SLICE))
                joined = b"\n\n\n\n".join([b"", *texts, b""])
                code = CODE[np.frombuffer(joined, np.uint8)].astype(np.int32)
                run = code[: 1 - ORDER].copy()
                for i in range(1, ORDER):
                    run *= SYMBOLS
                    run += code[i : len(code) - ORDER + 1 + i]
                total += np.bincount(run, minlength=size)
                joined = b"\n" + b"\n".join(texts) + b"\n"
                seen.update([joined[a:b] for a, b in suspicious_spans(joined)])
            if len(seen) >= HELD:
                yield rows(np.empty(0), list(seen), list(seen.values()))
                seen.clear()
        found = np.flatnonzero(total)
        if len(found):
            yield rows(found, [], total[found])
        if seen:
            yield rows(np.empty(0), list(seen), list(seen.values()))

    counted = map_batches(docs.select("text"), count, "run int, token binary, n long")
    return counted.groupBy("run", "token").agg(F.sum("n").alias("n"))


def character_counts(gathered: DataFrame) -> np.ndarray:
    """How often each run of ORDER characters occurs; SYMBOLS ** ORDER counts at most."""
    rows = gathered.filter("run IS NOT NULL").select("run", "n").toPandas()
    counts = np.zeros(SYMBOLS**ORDER)
    counts[rows["run"].to_numpy()] = rows["n"].to_numpy()
    return counts


def count_characters(docs: DataFrame) -> np.ndarray:
    return character_counts(gather(docs))


def frequent_readings(gathered: DataFrame, model) -> dict[bytes, bytes]:
    """What the frequent suspicious tokens say, decoded in parallel; `model` is a broadcast of the language model.

    A token is frequent from LEAST_TOKEN occurrences and one in MOST_TOKENS of all occurrences on, so there are at
    most MOST_TOKENS of them at any size of the corpus.
    """
    tokens = gathered.filter("token IS NOT NULL")
    total = tokens.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    least = max(LEAST_TOKEN, -(-total // MOST_TOKENS))
    parts = max(1, tokens.sparkSession.sparkContext.defaultParallelism * 2)

    def read(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in iterator:
            raw = batch.column("token").to_pylist()
            said = [t if ordinary(t) else decode(t, model.value) for t in raw]
            yield pa.RecordBatch.from_arrays([pa.array(raw, pa.binary()), pa.array(said, pa.binary())], names=["token", "said"])

    chosen = tokens.filter(F.col("n") >= least).select("token").repartition(parts)
    return {bytes(r["token"]): bytes(r["said"]) for r in map_batches(chosen, read, "token binary, said binary").collect()}


def language_model(counts: np.ndarray) -> np.ndarray:
    """log P(character | the three before), of shape (SYMBOLS ** 3, SYMBOLS), interpolated with shorter contexts."""
    p = np.full(SYMBOLS, 1.0 / SYMBOLS)
    full = counts.reshape([SYMBOLS] * ORDER)
    for n in range(1, ORDER + 1):
        grams = full.sum(axis=tuple(range(ORDER - n))) if n < ORDER else full
        kinds = (grams > 0).sum(axis=-1, keepdims=True) + 1.0  # Witten-Bell: more kinds, less trust
        p = (grams + kinds * p) / (grams.sum(axis=-1, keepdims=True) + kinds)
    return np.log(p).reshape(SYMBOLS ** (ORDER - 1), SYMBOLS).astype(np.float32)


def _readings(raw: bytes, i: int) -> list[tuple[int, bytes, float]]:
    """(symbol, written, cost) of what raw[i] may stand for; symbol -1 writes nothing."""
    b = raw[i]
    char = chr(b)
    if LETTER[b]:
        lower = bytes([b + 32]) if 65 <= b <= 90 else bytes([b])
        found = [(int(CODE[b]), lower, 0.0)]
        if i and raw[i - 1 : i].lower() == lower and b < 128:
            around = raw[max(0, i - 2) : i - 1] + raw[i + 1 : i + 2]
            found.append((-1, b"", DROP_REPEAT if lower in around.lower() else DROP_DOUBLE))
        return found
    found = [(0, b" ", 0.0 if char in " ," else AS_BOUNDARY)]
    if char in LEET:
        cost = STAR if char == "*" else AS_LETTER
        found += [(ord(x) - 96, x.encode(), cost) for x in LEET[char]]
    found.append((-1, b"", DROP_SEPARATOR if char in SEPARATORS else DROP_SYMBOL))
    return found


def decode(raw: bytes, model: np.ndarray) -> bytes:
    """The likeliest text behind a token: Viterbi over the lattice, a state being the last three symbols."""
    keep = SYMBOLS ** (ORDER - 2)
    states: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
    for i in range(len(raw)):
        after: dict[int, tuple[float, tuple | None]] = {}
        readings = _readings(raw, i)
        for state, (cost, path) in states.items():
            for symbol, written, channel in readings:
                if symbol < 0 or (symbol == 0 and state % SYMBOLS == 0):
                    to, total, longer = state, cost + channel, path
                else:
                    to = state % keep * SYMBOLS + symbol
                    total = cost + channel - model[state, symbol]
                    longer = (written, path)
                known = after.get(to)
                if known is None or total < known[0]:
                    after[to] = (total, longer)
        states = after
    # The token ends with a boundary.
    _, path = min(((c - model[s, 0] * (s % SYMBOLS > 0), p) for s, (c, p) in states.items()), key=lambda x: x[0])
    written = []
    while path is not None:
        written.append(path[0])
        path = path[1]
    return b"".join(reversed(written))


def suspicious(joined: np.ndarray) -> np.ndarray:
    """Positions within tokens that may be obfuscated."""
    letter, figure, symbol, space = LETTER[joined], FIGURE[joined], SYMBOL[joined], SPACE[joined]
    hit = np.zeros(len(joined), bool)
    hit[1:] |= figure[1:] & letter[:-1]
    hit[:-1] |= figure[:-1] & letter[1:]
    hit[1:] |= symbol[1:] & letter[:-1]
    hit[:-1] |= symbol[:-1] & letter[1:]
    # A separator within a token: behind a letter, and before a letter or another separator.
    gap = SEPARATOR[joined] & ~space
    hit[1:-1] |= gap[1:-1] & letter[:-2] & (letter | gap)[2:]
    lower = np.where(letter, joined | 32, 0)
    hit[1:] |= letter[1:] & (joined[1:] < 128) & (lower[1:] == lower[:-1])
    return np.flatnonzero(hit)


def spelled_out(joined: bytes) -> list[tuple[int, int]]:
    """Stretches of three or more single characters with one or two separators between each two."""
    # Three signs at least; figures alone are no word.
    found = (m for m in SPELLED.finditer(joined) if len(SIGNS.findall(m[0])) >= 3)
    return [m.span() for m in found if LETTER[np.frombuffer(m[0], np.uint8)].sum() >= 2]


def suspicious_spans(joined: bytes) -> list[tuple[int, int]]:
    """Tokens and spelled out stretches that may be obfuscated, in order and apart from each other.

    `joined` begins and ends with white space.
    """
    codes = np.frombuffer(joined, np.uint8)
    space = np.flatnonzero(SPACE[codes])
    tokens = np.unique(np.searchsorted(space, suspicious(codes)))
    spans = spelled_out(joined) + [(int(space[k - 1]) + 1, int(space[k])) for k in tokens.tolist()]
    apart, done = [], 0
    for a, b in sorted(spans):
        if a >= done:  # else within a stretch that is there already
            apart.append((a, b))
            done = b
    return apart


def ordinary(token: bytes) -> bool:
    """Plain letters with doubled ones as words have them: none three times in a row, fewer than half doubled."""
    lower = token.lower()
    if not all(LETTER[b] for b in lower):
        return False
    doubled = [a == b for a, b in zip(lower, lower[1:])]
    return not any(a and b for a, b in zip(doubled, doubled[1:])) and 4 * sum(doubled) < len(lower)


@dataclass
class Restorer:
    """Restores texts. `frequent` tokens are decoded already; of others a bounded number is remembered per worker."""

    model: np.ndarray
    frequent: dict[bytes, bytes] = field(default_factory=dict)
    known: dict[bytes, bytes] = field(default_factory=dict)
    limit: int = 100_000

    def token(self, raw: bytes) -> bytes:
        found = self.frequent.get(raw) or self.known.get(raw)
        if found is None:
            if len(self.known) >= self.limit:
                self.known.clear()
            found = self.known[raw] = decode(raw, self.model)
        return found

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        """The restored texts. They are looked at in one array, with white space in between."""
        joined = b"\n" + b"\n".join(texts) + b"\n"
        ends = np.cumsum([len(t) + 1 for t in texts])  # of each text, in `joined`
        out = list(texts)
        changes: dict[int, list[tuple[int, int, bytes]]] = {}
        spans = suspicious_spans(joined)
        owners = np.searchsorted(ends, [a for a, _ in spans], side="left").tolist()
        for text, (a, b) in zip(owners, spans, strict=True):
            changes.setdefault(text, []).append((a, b, self.token(joined[a:b])))
        for text, own in changes.items():
            start = int(ends[text]) - len(texts[text])
            parts, last = [], start
            for a, b, restored in own:
                parts += [joined[last:a], restored]
                last = b
            out[text] = b"".join([*parts, joined[last : start + len(texts[text])]])
        return out


def restored_words(batch: pa.RecordBatch, restorer: Restorer) -> Iterator[tuple[object, list[bytes]]]:
    for at in range(0, batch.num_rows, SLICE):
        part = batch.slice(at, SLICE)
        for doc_id, text in zip(ids(part), restorer(text_bytes(part)), strict=True):
            yield doc_id, text.translate(WORDS).split()


def terms_of(word: bytes) -> list[bytes]:
    """A word and its beginnings, which end with a sign no word has."""
    return [word, *(word[:n] + b"-" for n in PREFIXES if len(word) > n)]


@dataclass
class Scorer:
    """Lexicon weights and a logistic model of their sum, their share of the words and their variety."""

    weights: dict[bytes, float]
    coefficients: np.ndarray
    known: dict[bytes, float] = field(default_factory=dict)
    limit: int = 200_000

    def weight(self, word: bytes) -> float:
        """The largest weight of a word's terms, 0 if it has none."""
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= self.limit:
                self.known.clear()
            found = self.known[word] = max([self.weights.get(t, 0.0) for t in terms_of(word)])
        return found

    def features(self, words: list[bytes]) -> tuple[float, float, float]:
        hits = {w: x for w in set(words) if (x := self.weight(w))}
        if not hits:
            return 0.0, 0.0, 0.0
        found = [hits[w] for w in words if w in hits]
        return float(np.log1p(sum(found))), min(1.0, 20.0 * len(found) / len(words)), float(np.log1p(len(hits)))

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-(self.coefficients[0] + features @ self.coefficients[1:])))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50) -> np.ndarray:
    """Intercept and coefficients by Newton's method, with a ridge on the latter."""
    rate = (y.sum() + 1.0) / (len(y) + 2.0)
    beta = np.zeros(x.shape[1] + 1)
    beta[0] = np.log(rate / (1 - rate))
    if not 0 < y.sum() < len(y):
        return beta
    rows = np.hstack([np.ones((len(x), 1)), x])
    penalty = np.diag([1e-6] + [ridge] * x.shape[1])
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(rows @ beta, -30, 30)))
        gradient = rows.T @ (p - y) + penalty @ beta
        hessian = (rows * (p * (1 - p))[:, None]).T @ rows + penalty
        step = np.linalg.solve(hessian, gradient)
        beta -= step
        if np.abs(step).max() < 1e-9:
            break
    return beta


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """(doc_id, text, y) of at most `sample` labelled rows of the folds that may be learned, chosen by hash."""
    usable = (
        labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.min("toxic").alias("y"), F.max("toxic").alias("other"))
        .filter("y = other")
        .select("doc_id", "y")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    # At most `sample` ids: the texts stay where they are.
    joined = docs.select("doc_id", "text").join(F.broadcast(usable), "doc_id")
    # Near copies share the smallest hash of five words with the probability of their similarity.
    words = F.split(F.lower(F.coalesce("text", F.lit(""))), r"\s+")
    fives = F.sequence(F.lit(1), F.greatest(F.size("w") - 4, F.lit(1)))
    key = F.array_min(F.transform(fives, lambda i: F.xxhash64(F.slice("w", i, 5))))
    once = joined.withColumn("w", words).withColumn("key", key).groupBy("key").agg(F.min(F.struct("doc_id", "text", "y")).alias("row"))
    return once.select("row.*")


def restored_sample(sampled: DataFrame, restorer_of) -> DataFrame:
    """(words, y): the restored words of the sampled rows, joined by spaces."""

    def restore(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = restorer_of()
        for batch in iterator:
            words = [b" ".join(words) for _, words in restored_words(batch, restorer)]
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), batch.column("y").cast(pa.int64())], names=["words", "y"])

    return map_batches(sampled, restore, "words binary, y long")


def lexicon(restored: DataFrame) -> dict[bytes, float]:
    """Terms that stand in toxic documents more often than chance explains; among the sampled rows."""

    def count(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, clean = Counter(), Counter()
        for batch in iterator:
            for words, y in zip(batch.column("words").to_pylist(), ids(batch, "y"), strict=True):
                own = toxic if y == 1 else clean
                own.update({t for w in set(words.split()) for t in terms_of(w)})
                own[b""] += 1
        words = list(toxic.keys() | clean.keys())
        yield pa.RecordBatch.from_pydict({
            "word": pa.array(words, pa.binary()),
            "toxic": pa.array([toxic[w] for w in words], pa.int64()),
            "clean": pa.array([clean[w] for w in words], pa.int64()),
        })

    counted = map_batches(restored, count, "word binary, toxic long, clean long")
    counted = durable(counted.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))
    totals = counted.filter(F.col("word") == F.lit(b"")).collect()
    if not totals:
        return {}
    n1, n0 = totals[0]["toxic"], totals[0]["clean"]
    t, c = F.col("toxic"), F.col("clean")
    odds = F.log((t + 0.5) / (n1 + 1.0)) - F.log((c + 0.5) / (n0 + 1.0))
    rate = n1 / max(n1 + n0, 1)
    if not 0 < rate < 1:
        return {}
    ratio = t * F.log(t / (t + c) / rate) + F.when(c > 0, c * F.log(c / (t + c) / (1 - rate))).otherwise(0.0)
    chosen = counted.filter((F.col("word") != F.lit(b"")) & (t >= LEAST_DOCS) & (t > rate * (t + c)))
    chosen = chosen.withColumn("odds", odds).filter((ratio >= LEAST_RATIO) & (F.col("odds") > 2.0))
    return {bytes(r["word"]): float(r["odds"]) for r in chosen.orderBy("word").collect()}


def with_scores(docs: DataFrame, labels: DataFrame, name: str, sample: int = SAMPLE) -> DataFrame:
    """`docs`, each row with its own score in the column `name`."""
    context = docs.sparkSession.sparkContext
    gathered = durable(gather(docs))
    model = context.broadcast(language_model(character_counts(gathered)))
    frequent = context.broadcast(frequent_readings(gathered, model))

    def restorer() -> Restorer:
        return Restorer(model.value, frequent.value)

    restored = durable(restored_sample(labelled_sample(docs, labels, sample), restorer))
    weights = lexicon(restored)
    plain = Scorer(weights, np.zeros(4))

    def features(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in iterator:
            rows = np.array([plain.features(words.split()) for words in batch.column("words").to_pylist()]).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([batch.column("y"), *map(pa.array, rows.T)], names=["y", "a", "b", "c"])

    learned = map_batches(restored, features, "y long, a double, b double, c double")
    learned = learned.toPandas().sort_values(["y", "a", "b", "c"])
    scorer = Scorer(weights, logistic(learned[["a", "b", "c"]].to_numpy(float), learned["y"].to_numpy(float)))

    def score(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = restorer()
        for batch in iterator:
            rows = np.array([scorer.features(words) for _, words in restored_words(batch, own)]).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scorer.score(rows))], names=[*batch.schema.names, name])

    return map_batches(docs, score, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per document: fold, score, prediction."""
    scored = with_scores(docs.select("doc_id", "text"), labels, "score", sample)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: rows that are predicted toxic go. Each row is judged by its own text, whatever its id."""
    scored = with_scores(docs, table(spark, sf_dir, "labels"), "_toxicity")
    return scored.filter(F.col("_toxicity") < TOXIC_FROM).select(docs.columns)


def op7_noisy_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
