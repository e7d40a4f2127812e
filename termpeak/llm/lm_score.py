"""LM scoring with a hashed maximum-entropy model over classes of words.

Method. The probability of a token is that of its class given the history times that
of the token within its class. The end of a text and the most frequent words are
classes by themselves; all other words fall into classes by their last two bytes.
Classes are predicted by a softmax over hashed features of the history: the last
word, the classes of the last two, the word two back and the class three back (skips
over what is between), and a bias. Within a
class a word has its smoothed share of the class's training tokens, the maximum
likelihood answer of a softmax with a feature for each word.

Training is by distributed gradient updates. The gradient of a weight is how often its
feature and class were observed together less how often the model expects them; both are
sums over all training tokens, so tasks return sums and what is learnt does not depend
on how the texts are dealt out. The first weights come from the observed counts alone:
``START`` times the log of how much likelier the class is with the feature than without,
the counts smoothed by ``SMOOTH`` tokens of the class's share. What is maximised is the
likelihood of all training tokens under a Gaussian prior, which takes ``PRIOR`` / 2 times
the squares of the weights (not of the bias) from its log. Each round adds ``STEP`` times
the log of observed to expected, smoothed alike and by the prior, whose pull is on one
side: the gradient, scaled by how much the expectation bends. A round that lowers the
objective is taken back and made with half the step. Training goes on until a round gains
less than ``TOLERANCE`` (natural logs, for each token); no number of rounds ends it.
Every training text has part in every sum.

Scale. Training texts are cut and hashed once for all rounds: each chunk's distinct
(history, class) pairs are written to the shared folder, as a long and a count each, and
the rounds read only these. Sums have a fixed size; they travel in blocks and are added up as streams, in two
steps, so that no task gets a block from every other. Word counts are aggregated in each
chunk before they are shuffled. Words with at least one in ``HEAD`` of all tokens reach
every task, and there can be no more of them than ``HEAD``; so the join with the counts,
which holds for all other words, has no hot key. It runs over what scoring wrote to the
shared folder, where each row has got its number once and for all. Texts are cut and
numbered a chunk at a time without a Python step for each token.

Defined results: null text counts as empty and is only an end; a null ``doc_id`` is in
the training part; with nothing to learn from, all known words are none and the
classes are equally likely. Rows that repeat give rows that repeat.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from itertools import chain
from uuid import uuid4

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termpeak.llm.common import (
    LOWER,
    checkpoint_folder,
    checkpointed,
    encoded,
    lower_words,
    shuffles_released,
)

END = b""  # no word is empty
HEAD = 500_000  # words that can have one token in so many, or more
SINGLES = 31
SUFFIXES = 32
CLASSES = 1 + SINGLES + SUFFIXES
ROWS = 1 << 14  # hashed features
BLOCK = 256  # rows of weights that travel together
START = 0.45  # the four features of a token overlap in what they say
STEP = 0.35
PRIOR = 4.0  # tokens that pull a weight of one back to nought
TOLERANCE = 0.002
SMOOTH = 100.0
BATCH = 4096  # tokens whose probabilities are held at a time
CHUNK_BYTES = 4 << 20  # texts held as arrays at a time
PIECE = 1 << 16  # pairs in a row of what the rounds read
ADDERS = 16  # tasks that add up a block first
_SHORT = 16  # segments up to this long are summed side by side
_KINDS = 4  # of features, each with its share of the rows
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\x0b\x0c\r")] = True


def tokens_of(text: str | None) -> list[bytes]:
    return [*lower_words(text), END]


def held_out(doc_id: Column) -> Column:
    part = F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5))
    return F.coalesce(part == 1, F.lit(False))


def suffix_class(word: Column) -> Column:
    return F.pmod(F.crc32(F.substring(word, -2, 2)), F.lit(SUFFIXES)).cast("int")


@dataclass(frozen=True)
class Model:
    """Everything of fixed size that scoring needs."""

    weights: np.ndarray  # ROWS + 1 by CLASSES, the bias last
    singles: dict[bytes, int]  # words that are a class, with its number
    head: dict[bytes, int]  # counts of the most frequent words
    class_log: np.ndarray  # log10 of each suffix class's tokens, smoothed
    tokens: int  # in training
    words: int  # distinct ones

    def class_of(self, word: bytes) -> int:
        own = self.singles.get(word)
        return 1 + SINGLES + zlib.crc32(word[-2:]) % SUFFIXES if own is None else own


@dataclass(frozen=True)
class Chunk:
    """Some texts as arrays over their tokens."""

    vocabulary: list[bytes]
    word: np.ndarray  # number in the vocabulary
    classes: np.ndarray
    features: np.ndarray  # rows of weights, one for each kind of feature
    ends: np.ndarray  # of the texts, exclusive


def numbered(texts: list[str | None]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The words of some texts, the end first; the number of every token; where texts end."""
    raw = [encoded(t) for t in texts]
    data = np.frombuffer(b" ".join(raw).translate(LOWER), np.uint8)
    ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)) + 1)
    inside = ~_SPACE[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    at = np.flatnonzero(starts)
    own = np.searchsorted(ends, at, "right")
    letters = data[inside]
    offsets = np.append(np.cumsum(inside, dtype=np.int64)[at] - 1, len(letters))
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]
    ).dictionary_encode()
    word = np.zeros(len(at) + len(raw), np.int64)
    word[np.arange(len(at)) + own] = words.indices.to_numpy().astype(np.int64) + 1
    sizes = np.bincount(own, minlength=len(raw)) + 1
    return [END, *words.dictionary.to_pylist()], word, np.cumsum(sizes)


def _in_chunks(texts: Iterator[str | None]) -> Iterator[list[str | None]]:
    """Texts in lists of about ``CHUNK_BYTES``, or one longer text."""
    held: list[str | None] = []
    size = 0
    for text in texts:
        own = len(text or "")
        if held and size + own > CHUNK_BYTES:
            yield held
            held, size = [], 0
        held.append(text)
        size += own
    if held:
        yield held


def chunks_of(model: Model, texts: Iterator[str | None]) -> Iterator[Chunk]:
    return (_chunk(model, held) for held in _in_chunks(texts))


def _chunk(model: Model, texts: list[str | None]) -> Chunk:
    vocabulary, word, ends = numbered(texts)
    hashed = np.fromiter(map(zlib.crc32, vocabulary), np.uint64, len(vocabulary))[word]
    classes = np.fromiter(map(model.class_of, vocabulary), np.int64, len(vocabulary))[word]
    sizes = np.diff(np.append(0, ends))
    place = np.arange(len(word)) - np.repeat(ends - sizes, sizes)

    def before(values: np.ndarray, k: int) -> np.ndarray:
        """What stands ``k`` tokens earlier in the same text, else nought."""
        out = np.zeros(len(values), np.uint64)
        out[k:] = values[: max(0, len(values) - k)]
        out[place < k] = 0
        return out

    kind = classes.astype(np.uint64) + np.uint64(1)
    history = [
        before(hashed, 1),
        before(hashed, 2),
        before(kind, 1) * np.uint64(CLASSES + 1) + before(kind, 2),
        before(kind, 3),
    ]
    share = ROWS // _KINDS
    features = [
        np.uint64(k * share)
        + ((h + np.uint64(k + 1)) * np.uint64(m) >> np.uint64(40)) % np.uint64(share)
        for k, (h, m) in enumerate(zip(history, _MIXERS, strict=True))
    ]
    return Chunk(vocabulary, word, classes, np.stack(features, 1).astype(np.int64), ends)


# Odd numbers that spread what they multiply over 64 bits.
_MIXERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)


def packed(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (history, class) pairs of a chunk as sorted longs, and how often they stand."""
    share = ROWS // _KINDS
    keys = np.zeros(len(chunk.classes), np.int64)
    for k in range(_KINDS):
        keys = keys * share + (chunk.features[:, k] - k * share)
    return np.unique(keys * CLASSES + chunk.classes, return_counts=True)


def unpacked(histories: np.ndarray) -> np.ndarray:
    """The features of histories, which are the longs of :func:`packed` without the class."""
    share = ROWS // _KINDS
    features = np.empty((len(histories), _KINDS), np.int64)
    for k in reversed(range(_KINDS)):
        histories, own = np.divmod(histories, share)
        features[:, k] = own + k * share
    return features


def _logits(weights: np.ndarray, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the features' weights, less the greatest of each token; and that."""
    logits = weights.take(features[:, 0], axis=0)
    part = np.empty_like(logits)
    for k in range(1, features.shape[1]):
        logits += weights.take(features[:, k], axis=0, out=part, mode="clip")
    logits += weights[ROWS]
    # the greatest by halves, as rows are short
    half = (logits.shape[1] + 1) // 2
    greatest = np.maximum(logits[:, :half], logits[:, -half:])
    while half > 1:
        width, half = half, (half + 1) // 2
        greatest = np.maximum(greatest[:, :half], greatest[:, width - half : width])
    logits -= greatest
    return logits, greatest[:, 0]


def _row_sums(values: np.ndarray) -> np.ndarray:
    return values @ np.ones(values.shape[1], values.dtype)


def _segment_sums(rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """As ``np.add.reduceat(rows, starts, axis=0)``, whose inner loop is slow for many short ones."""
    sizes = np.diff(np.append(starts, len(rows)))
    total = rows.take(starts, axis=0)
    for k in np.flatnonzero(sizes > _SHORT):
        total[k] = rows[starts[k] : starts[k] + sizes[k]].sum(0)
    some = np.flatnonzero((sizes > 1) & (sizes <= _SHORT))
    for k in range(1, _SHORT):
        if not len(some):
            break
        total[some] += rows.take(starts[some] + k, axis=0)
        some = some[sizes[some] > k + 1]
    return total


def class_log_probabilities(weights: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Natural logs of the classes' probabilities, one row for each token."""
    logits, _ = _logits(weights, features)
    return logits - np.log(_row_sums(np.exp(logits)))[:, None]


def observed_sums(model: Model, chunk: Chunk, sums: np.ndarray) -> None:
    """Add how often each feature, and the bias, stands with each class."""
    _add_observed(chunk.features, chunk.classes, None, sums)


def expected_sums(model: Model, chunk: Chunk, sums: np.ndarray) -> None:
    """Add how often the model expects each feature, and the bias, with each class."""
    _add_expected(model.weights, chunk.features, np.ones(len(chunk.word), np.int64), sums)


def _add_observed(
    features: np.ndarray, classes: np.ndarray, times: np.ndarray | None, sums: np.ndarray
) -> None:
    for k in range(_KINDS):
        cells = features[:, k] * CLASSES + classes
        sums[:ROWS] += np.bincount(cells, times, ROWS * CLASSES).reshape(ROWS, CLASSES)
    sums[ROWS] += np.bincount(classes, times, CLASSES)


def _add_expected(
    weights: np.ndarray, features: np.ndarray, times: np.ndarray, sums: np.ndarray
) -> float:
    """Also returns the sum, over the tokens, of the logs the softmax divides by."""
    logs = 0.0
    for k in range(0, len(features), BATCH):
        own, often = features[k : k + BATCH], times[k : k + BATCH]
        chance, greatest = _logits(weights, own)
        np.exp(chance, out=chance)
        total = _row_sums(chance)
        logs += float((often * (np.log(total) + greatest.astype(np.float64))).sum())
        chance *= (often / total).astype(np.float32)[:, None]
        rows = own.ravel().astype(np.uint16)  # short ones are sorted by their digits
        order = np.argsort(rows, kind="stable")
        ranked = rows[order]
        starts = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
        found = _segment_sums(chance.take(order // own.shape[1], axis=0), starts)
        sums[ranked[starts].astype(np.int64)] += found
        sums[ROWS] += chance.sum(0)
    return logs


def _word_counts(docs: DataFrame) -> DataFrame:
    """``word``, ``c`` of the training texts, ends among them."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for texts in _in_chunks(chain.from_iterable(f["text"] for f in frames)):
            vocabulary, word, _ = numbered(texts)
            counts = np.bincount(word, minlength=len(vocabulary))
            yield pd.DataFrame({"word": vocabulary, "c": counts})

    pieces = docs.select("text").mapInPandas(count, "word binary, c long")
    return pieces.groupBy("word").agg(F.sum("c").alias("c"))


def _pairs_of(docs: DataFrame, shared: Broadcast) -> DataFrame:
    """What training needs of all texts, written out: ``pairs`` as of :func:`packed`, ``times``."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk in chunks_of(shared.value, chain.from_iterable(f["text"] for f in frames)):
            pairs, times = packed(chunk)
            times = times.astype(np.int32)
            for k in range(0, len(pairs), PIECE):
                own, often = pairs[k : k + PIECE], times[k : k + PIECE]
                yield pd.DataFrame({"pairs": [own.tobytes()], "times": [often.tobytes()]})

    path = f"{checkpoint_folder(docs.sparkSession)}/lm-pairs-{uuid4().hex}"
    schema = "pairs binary, times binary"
    found = docs.select("text").mapInPandas(cut, schema)
    found.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path)


def _add_pairs_observed(
    weights: np.ndarray, pairs: np.ndarray, times: np.ndarray, sums: np.ndarray
) -> float:
    histories, classes = np.divmod(pairs, CLASSES)
    _add_observed(unpacked(histories), classes, times, sums)
    return 0.0


def _add_pairs_expected(
    weights: np.ndarray, pairs: np.ndarray, times: np.ndarray, sums: np.ndarray
) -> float:
    histories = pairs // CLASSES
    starts = np.flatnonzero(np.append(True, histories[1:] != histories[:-1]))
    often = np.add.reduceat(times.astype(np.int64), starts)
    return _add_expected(weights, unpacked(histories[starts]), often, sums)


def _summed(pairs: DataFrame, weights: np.ndarray, add: Callable) -> tuple[np.ndarray, float]:
    """The sums that ``add`` makes of all pairs, a row to a feature, and of what it returns."""
    shared = pairs.sparkSession.sparkContext.broadcast(weights)

    def collect(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((ROWS + 1, CLASSES))
        more = 0.0
        for frame in frames:
            for own, often in frame[["pairs", "times"]].itertuples(index=False):
                some = np.frombuffer(own, np.int64), np.frombuffer(often, np.int32)
                more += add(shared.value, *some, sums)
        blocks = [k for k in range(0, ROWS + 1, BLOCK) if sums[k : k + BLOCK].any()]
        found = {k: sums[k : k + BLOCK].tobytes() for k in blocks}
        if found:
            found[-1] = np.float64(more).tobytes()
            yield pd.DataFrame({"block": list(found), "sums": list(found.values())})

    def together(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[int, np.ndarray] = {}
        for frame in frames:
            for block, raw in frame[["block", "sums"]].itertuples(index=False):
                own = np.frombuffer(raw)
                found[block] = found[block] + own if block in found else own
        rows = [(block, own.tobytes()) for block, own in found.items()]
        yield pd.DataFrame(rows, columns=["block", "sums"])

    schema = "block int, sums binary"
    parts = pairs.mapInPandas(collect, schema)
    salt = F.pmod(F.spark_partition_id(), F.lit(ADDERS))
    some = parts.withColumn("salt", salt).repartition("block", "salt")
    added = some.select("block", "sums").mapInPandas(together, schema)
    # every round shuffles as much again, and no round reads what another one shuffled
    with shuffles_released(pairs.sparkSession):
        rows = added.repartition("block").mapInPandas(together, schema).collect()
    out, more = np.zeros((ROWS + 1, CLASSES)), 0.0
    for row in rows:
        own = np.frombuffer(bytes(row["sums"]))
        if row["block"] < 0:
            more = float(own[0])
        else:
            own = own.reshape(-1, CLASSES)  # 8 MiB in all
            out[row["block"] : row["block"] + len(own)] = own
    shared.unpersist()
    return out, more


def first_weights(observed: np.ndarray) -> np.ndarray:
    """Weights from counts alone: what each feature tells of the classes."""
    shares = (observed[ROWS] + 0.5) / (observed[ROWS].sum() + 0.5 * CLASSES)
    totals = observed.sum(1, keepdims=True)
    weights = START * np.log((observed + SMOOTH * shares) / ((totals + SMOOTH) * shares))
    weights[ROWS] = np.log(shares)
    return weights.astype(np.float32)


def next_weights(
    weights: np.ndarray,
    observed: np.ndarray,
    expected: np.ndarray,
    step: float = STEP,
    prior: float = 0.0,
) -> np.ndarray:
    """One step along the gradient, observed less expected and the prior, on the scale of logs."""
    shares = (observed[ROWS] + 0.5) / (observed[ROWS].sum() + 0.5 * CLASSES)
    pull = prior * weights.astype(np.float64)
    pull[ROWS] = 0
    both = SMOOTH * shares + prior  # as much as the pull bends, or the step would be too long
    move = np.log(
        (observed + both + np.maximum(-pull, 0)) / (expected + both + np.maximum(pull, 0))
    )
    return (weights + step * move).astype(np.float32)


def objective(weights: np.ndarray, observed: np.ndarray, logs: float) -> float:
    """Log likelihood of the training tokens' classes and the prior, for each token."""
    plain = weights.astype(np.float64)
    prior = PRIOR / 2 * np.square(plain[:ROWS]).sum()
    return float(((observed * plain).sum() - logs - prior) / observed[ROWS].sum())


def fitted(weights: np.ndarray, observed: np.ndarray, expect: Callable) -> np.ndarray:
    """The weights after all rounds; ``expect`` returns the expected sums and logs of some."""
    step = STEP
    expected, logs = expect(weights)
    best = objective(weights, observed, logs)
    while True:
        moved = next_weights(weights, observed, expected, step, PRIOR)
        sums, logs = expect(moved)
        value = objective(moved, observed, logs)
        gain = value - best
        if gain >= 0:
            weights, expected, best = moved, sums, value
        # a step that is too long says nothing of how far there is to go
        if abs(gain) < TOLERANCE:
            return weights
        if gain < 0:
            step /= 2


def train(docs: DataFrame, doc_id: str = "doc_id") -> tuple[Model, DataFrame]:
    """The model, and the counts of all words of the training texts."""
    learning = docs.where(~held_out(F.col(doc_id)))
    counts = checkpointed(_word_counts(learning))
    totals = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    # there are at most HEAD such words, however many tokens and words there are; and the end
    often = F.col("c") * HEAD >= totals[0]
    head = counts.where(often | (F.octet_length("word") == 0)).collect()
    head_counts = {bytes(r["word"]): r["c"] for r in head}
    frequent = sorted(head_counts, key=lambda w: (-head_counts[w], w))[: SINGLES + 1]
    frequent = [w for w in frequent if w != END][:SINGLES]
    singles = {END: 0} | {w: 1 + k for k, w in enumerate(frequent)}
    log = np.full(CLASSES, math.log10(0.5))
    known = F.array(*(F.lit(bytearray(w)) for w in singles))
    others = counts.where(~F.array_contains(known, F.col("word")))
    sums = others.groupBy(suffix_class(F.col("word")).alias("k")).agg(
        F.sum("c").alias("c"), F.count("*").alias("v")
    )
    for row in sums.collect():  # at most SUFFIXES rows
        log[1 + SINGLES + row["k"]] = math.log10(row["c"] + 0.5 * (row["v"] + 1))
    weights = np.zeros((ROWS + 1, CLASSES), np.float32)
    model = Model(weights, singles, head_counts, log, totals[0], totals[1])
    if not totals[0]:
        return model, counts
    shared = docs.sparkSession.sparkContext.broadcast(model)
    pairs = _pairs_of(learning, shared)
    observed, _ = _summed(pairs, weights, _add_pairs_observed)
    shared.unpersist()
    weights = fitted(
        first_weights(observed), observed, lambda w: _summed(pairs, w, _add_pairs_expected)
    )
    return replace(model, weights=weights), counts


_PARTIAL = (
    "struct<n_tokens:bigint,head_known:bigint,head_log:double,model_log:double,"
    "tail_tokens:array<binary>,tail_counts:array<int>>"
)


def _partial_scores(shared: Broadcast, text: Column) -> Column:
    """All that can be said of a text without the counts of rarer words."""

    @F.pandas_udf(_PARTIAL)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for texts in batches:
            rows = [row for chunk in chunks_of(model, texts) for row in _chunk_rows(model, chunk)]
            yield pd.DataFrame(
                rows,
                columns=[
                    "n_tokens", "head_known", "head_log", "model_log", "tail_tokens", "tail_counts",
                ],
            )

    return score(F.coalesce(text, F.lit("")))


def _chunk_rows(model: Model, chunk: Chunk) -> Iterator[tuple]:
    logs = np.empty(len(chunk.word))
    for k in range(0, len(chunk.word), BATCH):
        rows, _ = _logits(model.weights, chunk.features[k : k + BATCH])
        own = rows[np.arange(len(rows)), chunk.classes[k : k + BATCH]]
        logs[k : k + BATCH] = own - np.log(_row_sums(np.exp(rows, out=rows)))
    logs /= math.log(10)
    logs -= np.where(chunk.classes > SINGLES, model.class_log[chunk.classes], 0.0)
    # with nothing learned there are no frequent words, and the end has no count
    count = np.array([model.head.get(w, -1) for w in chunk.vocabulary])
    count[0] = max(count[0], 0)
    smoothed = np.where(count >= 0, np.log10(np.maximum(count, 0) + 0.5), 0.0)
    single = np.array([w in model.singles for w in chunk.vocabulary])
    in_class = np.where(single, 0.0, smoothed)[chunk.word]
    start = 0
    for end in chunk.ends:
        word = chunk.word[start:end]
        tail, times = np.unique(word[count[word] < 0], return_counts=True)
        yield (
            int(end - start),
            int((count[word] > 0).sum()),
            float(smoothed[word].sum()),
            float(logs[start:end].sum() + in_class[start:end].sum()),
            [chunk.vocabulary[k] for k in tail],
            times.tolist(),
        )
        start = end


def score_texts(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, token counts, and both scores of every text."""
    model, counts = train(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    partial = docs.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.monotonically_increasing_id().alias("row"),
        _partial_scores(shared, F.col("text")).alias("p"),
    )
    path = f"{checkpoint_folder(docs.sparkSession)}/lm-{uuid4().hex}"
    partial.write.option("compression", "zstd").parquet(path)
    partial = docs.sparkSession.read.parquet(path)

    pairs = F.arrays_zip(F.col("p.tail_tokens").alias("word"), F.col("p.tail_counts").alias("n"))
    tail = partial.select("row", F.inline(pairs)).toDF("row", "word", "n")
    rarer = tail.join(counts, "word", "left")
    known = F.coalesce(F.col("c"), F.lit(0))
    sums = rarer.groupBy("row").agg(
        F.sum(F.col("n") * F.log10(known + 0.5)).alias("tail_log"),
        F.sum(F.when(known > 0, F.col("n")).otherwise(0)).alias("tail_known"),
    )
    tail_log = F.coalesce(F.col("tail_log"), F.lit(0.0))
    norm = math.log10(model.tokens + 0.5 * (model.words + 1))
    return partial.join(sums, "row", "left").select(
        "doc_id",
        "held_out",
        F.col("p.n_tokens").alias("n_tokens"),
        (F.col("p.head_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        (F.col("p.head_log") + tail_log - F.col("p.n_tokens") * F.lit(norm)).alias("base_score"),
        (F.col("p.model_log") + tail_log).alias("score"),
    )


def lm_query(docs: DataFrame) -> DataFrame:
    return score_texts(docs)
