"""Toxicity scores from subword-bag embeddings (operator 6)."""

from __future__ import annotations

import re
import uuid
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .workers import kept, release

WORD = re.compile(r"\w+")
#: The model is fitted on at most so many labelled rows, and on whole texts of so many
#: characters together: the bounds of the one task that trains.
TRAIN_ROWS, TRAIN_CHARS = 6_000, 32_000_000
#: Writing without spaces makes one run of a whole passage; a run of more than RUN
#: characters counts as words of PART, which overlap so that no n-gram is lost.
RUN, PART, OVERLAP = 32, 16, 4
BUCKETS, DIM, WINDOW = 1 << 17, 8, 5
MASK = BUCKETS - 1
#: Word scores a Python worker keeps, over the tasks of this operator; emptied when full.
MEMO_WORDS = 400_000


def words_of(text: str | None) -> list[str]:
    """The lower-cased words of a whole text, long runs in overlapping parts."""
    out = []
    for run in WORD.findall((text or "").lower()):
        if len(run) <= RUN:
            out.append(run)
        else:
            out += [run[at : at + PART] for at in range(0, len(run) - OVERLAP, PART - OVERLAP)]
    return out


def subwords(word: str) -> list[int]:
    """Buckets of a word's n-grams (3 to 5 bytes) and of the word itself, so
    that an unseen spelling shares vectors with the seen ones."""
    w = f"<{word}>".encode("utf-8", "surrogatepass")
    crc, n = zlib.crc32, len(w)
    grams = [crc(w[i : i + 3]) & MASK for i in range(n - 2)]
    grams += [crc(w[i : i + 4]) & MASK for i in range(n - 3)]
    grams += [crc(w[i : i + 5]) & MASK for i in range(n - 4)]
    grams.append(crc(w) & MASK)
    return grams


@dataclass
class Model:
    """``embeddings`` (buckets x dim), ``weights`` (dim x 2), ``bias`` (2)."""

    embeddings: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    def bucket_logits(self) -> list[float]:
        """What each bucket adds to logit(toxic) - logit(clean) in a bag of one."""
        return (self.embeddings @ (self.weights[:, 1] - self.weights[:, 0])).tolist()


def word_logit(word: str, logits: list[float]) -> float:
    buckets = subwords(word)
    return sum(map(logits.__getitem__, buckets)) / len(buckets)


def best_window(scores: np.ndarray, window: int) -> tuple[int, float]:
    """Start and mean of the run of ``window`` words (all, if fewer) with the highest mean."""
    n = min(window, len(scores))
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    means = (sums[n:] - sums[:-n]) / n
    at = int(means.argmax())
    return at, float(means[at])


def fit(texts: list[str], labels: np.ndarray, epochs: int = 10, seed: int = 7) -> Model:
    """Trains embeddings and the softmax jointly by Adagrad.

    A bag is first the whole text, then, as toxic passages are short, the text's
    window that the model scores highest (labels are of texts, so this is
    multiple-instance learning)."""
    rng = np.random.default_rng(seed)
    vocab: dict[str, int] = {}
    docs = [np.array([vocab.setdefault(w, len(vocab)) for w in words_of(t)], np.int32) for t in texts]
    numbers, lengths = array("i"), array("i", [0])  # packed: a corpus has many words
    for word in vocab:
        found = subwords(word)
        numbers.extend(found)
        lengths.append(len(found))
    del vocab
    start, flat = np.cumsum(lengths), np.array(numbers, np.int32)
    inverse = 1.0 / np.maximum(np.diff(start), 1)
    emb = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM))
    w = rng.normal(0, 0.3, (DIM, 2))
    bias = np.zeros(2)
    g_emb, g_w, g_bias = np.full((BUCKETS, 1), 1e-6), np.full((DIM, 2), 1e-6), np.full(2, 1e-6)
    usable = np.array([i for i, d in enumerate(docs) if len(d)], np.int64)
    for epoch in range(epochs):
        if epoch >= 3:
            logits = np.add.reduceat((emb @ (w[:, 1] - w[:, 0])).astype(np.float32)[flat], start[:-1]) * inverse
            bags = [d[(a := best_window(logits[d], WINDOW)[0]) : a + WINDOW] if len(d) else d for d in docs]
        else:
            bags = docs
        for batch in np.array_split(rng.permutation(usable), max(1, len(usable) // 32)):
            words = np.concatenate([bags[i] for i in batch])
            lens = np.array([len(bags[i]) for i in batch])
            counts = start[words + 1] - start[words]
            where = np.repeat(np.arange(len(batch)), lens).repeat(counts)
            share = (inverse[words] / lens.repeat(lens)).repeat(counts)
            first = np.cumsum(counts) - counts
            buckets = flat[np.arange(counts.sum()) - first.repeat(counts) + start[words].repeat(counts)]
            means = np.zeros((len(batch), DIM))
            np.add.at(means, where, emb[buckets] * share[:, None]) if len(buckets) < 20_000 else means.__iadd__(
                np.stack([np.bincount(where, emb[buckets, k] * share, len(batch)) for k in range(DIM)], 1)
            )
            z = means @ w + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            err = p.copy()
            err[np.arange(len(batch)), labels[batch]] -= 1
            # every text's gradient for its subwords is err @ w.T times their share
            step = err @ w.T
            near, back = np.unique(buckets, return_inverse=True)
            grad = np.stack([np.bincount(back, step[where, k] * share, len(near)) for k in range(DIM)], 1)
            g_emb[near, 0] += (grad**2).mean(axis=1)
            emb[near] *= 1 - 1e-3
            emb[near] -= 0.3 * grad / np.sqrt(g_emb[near])
            grad_w = means.T @ err / len(batch)
            g_w += grad_w**2
            w -= 0.1 * grad_w / np.sqrt(g_w)
            grad_b = err.mean(axis=0)
            g_bias += grad_b**2
            bias = bias - 0.1 * grad_b / np.sqrt(g_bias)
    return Model(emb.astype(np.float32), w, bias)


def held_out(id_col: str = "doc_id"):
    """Rows that no label is learnt from: crc32 of the id as text is 2 mod 4."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, chars: int = TRAIN_CHARS) -> Model:
    """Fits on at most ``rows`` labelled texts that are not held out, taken in the order
    of a hash of the id until whole texts of ``chars`` characters are together.

    One task of an executor trains, so the driver gets the model alone (4 MB).  A
    document with conflicting labels counts as toxic; null labels and ids, and labels
    other than 0 and 1, teach nothing; with no label left, every score is 0.5."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    data = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(picked), "doc_id")
    order = F.xxhash64("doc_id").alias("place")
    data = data.select(order, "doc_id", "text", "toxic").distinct().repartition(1).sortWithinPartitions("place", "doc_id", "text")

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        texts: list[str] = []
        marks: list[int] = []
        left = chars
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                left -= len(text)
                if len(texts) < rows and (left >= 0 or not texts):
                    texts.append(text)
                    marks.append(toxic)
        if texts:
            m = fit(texts, np.array(marks, np.int64))
            parts = (m.embeddings, m.weights.astype(np.float32), m.bias.astype(np.float32))
            texts.clear()
            release()
            yield pd.DataFrame({"k": range(3), "part": [p.tobytes() for p in parts]})

    parts = [bytes(r["part"]) for r in sorted(data.mapInPandas(learn, "k int, part binary").collect())]
    if not parts:
        return Model(np.zeros((BUCKETS, DIM), np.float32), np.zeros((DIM, 2)), np.zeros(2))
    arrays = [np.frombuffer(p, np.float32) for p in parts]
    return Model(arrays[0].reshape(BUCKETS, DIM), arrays[1].reshape(DIM, 2), arrays[2])


def worker_state(shared) -> tuple[float, list[float], dict[str, float]]:
    """Bias, bucket logits and word memo of the model, once for each Python worker."""
    model = shared.value
    return kept(model.name, lambda: (float(model.bias[1] - model.bias[0]), model.bucket_logits(), {}))


def probabilities(texts: list[str | None], shared) -> np.ndarray:
    """Scores of a batch of whole texts."""
    offset, logits_of, memo = worker_state(shared)
    logits = np.empty(len(texts))
    for k, text in enumerate(texts):
        words = words_of(text)
        if len(memo) > MEMO_WORDS:
            memo.clear()
        for word in set(words).difference(memo):
            memo[word] = word_logit(word, logits_of)
        each = np.fromiter(map(memo.__getitem__, words), np.float64, len(words))
        logits[k] = offset + (best_window(each, WINDOW)[1] if words else 0.0)
    return 1 / (1 + np.exp(-np.clip(logits, -500, 500)))


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    The score is the softmax of the bag with the highest logit among the windows
    of WINDOW words (the whole text, if shorter).  Defined cases: null, empty and
    wordless texts score as an empty bag (the bias alone); a null id is not held
    out; repeated rows score alike; an empty table gives an empty result; further
    columns are not read.
    """
    # 4 MB, whatever the corpus: DIM x BUCKETS floats
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = probabilities(batch.column(2).to_pylist(), shared)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), "text").mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int"
    )


def drop_toxic(
    docs: DataFrame, labels: DataFrame, training_docs: DataFrame | None = None, text_col: str = "text", threshold: float = 0.3
) -> DataFrame:
    """The rows of ``docs`` whose text scores below ``threshold``; all columns stay.

    Each row goes or stays by its own text (rows that repeat an id with other texts are
    judged one by one); null and empty texts, and those without a word, stay; without a
    usable label nothing is rejected; the schema, whatever its column names, and an empty
    table stay as they are.  Rows pass through the scoring task with their columns, so
    nothing is shuffled."""
    model = train(docs if training_docs is None else training_docs, labels)
    if not model.weights.any():  # only a model that has learnt nothing
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            bare = np.array([not WORD.search(t or "") for t in texts], bool)
            yield batch.filter(pa.array(bare | (probabilities(texts, shared) < threshold)))

    return docs.mapInArrow(run, docs.schema)
