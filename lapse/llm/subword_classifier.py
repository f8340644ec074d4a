"""Quality classifier: supervised subword embeddings.

A document is the bag of its words' features: the word itself and its character n-grams (bytes of
``<word>``), hashed into ``BUCKETS`` vectors; a word that repeats the one before it adds one more
word, ``REPEAT``.  The average of the vectors goes through a softmax layer; vectors and layer are
learned together by stochastic gradient descent in numpy.

Fitting takes at most ``MAX_TRAIN_ROWS`` labelled documents (those with the smallest hash of their
id); tasks send only their bags of hashed features.  Scoring covers all documents: as the layer is
linear, each bucket has one number, and a document's score is the average of its features' numbers.

Results for odd input: a null or empty text has no features and gets the score of the bias alone;
rows with a null label or id are not learned from; an id labelled both ways counts as label 1, and of
several texts under one labelled id the smallest (in byte order) is learned from, once; texts of any
length are read whole; without any label of one class every score is
the share of label 1 (0.5 without labels); repeated rows give repeated scores; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapse.llm.bpe_codec import _source
from lapse.llm.common import col, coded_words, fresh, gathered, id_crc, in_tasks, per_text, text_batches, text_or_empty

BUCKET_BITS, DIM, NGRAMS = 16, 12, (3, 4, 5)
BUCKETS = 1 << BUCKET_BITS
MAX_TRAIN_ROWS, EPOCHS, RATE, SEED = 2500, 6, 0.8, 7
THRESHOLD = 0.7
REPEAT = b"\x00repeat"


def word_features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of every word's features, word by word, and how many each word has."""
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 2
    raw = np.frombuffer(b"".join(b"<" + w + b">" for w in words), dtype=np.uint8).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), size)
    left = np.repeat(np.cumsum(size), size) - np.arange(len(raw))  # bytes from here to the word's end
    buckets = [np.fromiter((zlib.crc32(w) >> (32 - BUCKET_BITS) for w in words), dtype=np.int64, count=len(words))]
    owners = [np.arange(len(words))]
    for n in NGRAMS:
        at = np.flatnonzero(left >= n)
        h = np.full(len(at), n, dtype=np.uint64)
        for k in range(n):
            h = (h + raw[at + k] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        buckets.append((h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))
        owners.append(owner[at])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(buckets)[order], np.bincount(owner, minlength=len(words))


def _read(texts: list[str]):
    """Distinct words, and every document's word numbers with the REPEAT marks appended as one more word."""
    distinct, numbers, starts = coded_words(texts)
    document = np.repeat(np.arange(len(texts)), np.diff(starts))
    again = np.zeros(len(numbers), dtype=bool)
    again[1:] = (numbers[1:] == numbers[:-1]) & (document[1:] == document[:-1])
    repeats = np.bincount(document[again], minlength=len(texts))
    return distinct.to_pylist() + [REPEAT], numbers, starts, repeats


def bags(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text: its buckets in ascending order, and how often each occurs."""
    words, numbers, starts, repeats = _read(texts)
    feature, count = word_features(words)
    at = np.concatenate(([0], np.cumsum(count)))
    out = []
    for i in range(len(texts)):
        own, times = np.unique(np.append(numbers[starts[i]:starts[i + 1]], len(words) - 1), return_counts=True)
        times[-1] = repeats[i]  # the REPEAT word is last
        weights = np.zeros(BUCKETS)
        for w, n in zip(own.tolist(), times.tolist()):
            np.add.at(weights, feature[at[w]:at[w + 1]], n)
        ids = np.flatnonzero(weights)
        out.append((ids.astype(np.int32), weights[ids].astype(np.float32)))
    return out


@dataclass
class Model:
    weight: np.ndarray  # of every bucket
    bias: float

    def scores(self, texts: list[str]) -> np.ndarray:
        words, numbers, starts, repeats = _read(texts)
        value, count = self._words(words)
        total = per_text(value[numbers], starts) + repeats * value[-1]
        n = per_text(count[numbers].astype(float), starts) + repeats * count[-1]
        z = np.where(n > 0, total / np.maximum(n, 1), 0.0) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


    def _words(self, words: list[bytes], block: int = 20_000) -> tuple[np.ndarray, np.ndarray]:
        """Sum of the numbers of every word's features, and how many it has; in blocks, to bound memory."""
        value, count = np.empty(len(words)), np.empty(len(words), dtype=np.int64)
        for i in range(0, len(words), block):
            feature, n = word_features(words[i:i + block])
            value[i:i + block] = np.add.reduceat(self.weight[feature], np.cumsum(n) - n)
            count[i:i + block] = n
        return value, count


def fit(samples: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS, rate: float = RATE) -> Model:
    """Learn vectors and softmax layer from bags of features by stochastic gradient descent."""
    share = float(labels.mean()) if len(labels) else 0.5
    if share in (0.0, 1.0) or not len(labels):
        return Model(np.zeros(BUCKETS), float(np.log((share + 1e-6) / (1 - share + 1e-6))))
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM))
    layer, bias = np.zeros((2, DIM)), np.zeros(2)
    bags_ = [(ids, (w / max(w.sum(), 1))[:, None].astype(float)) for ids, w in samples]
    steps, step = epochs * len(samples), 0
    for _ in range(epochs):
        for i in rng.permutation(len(samples)).tolist():
            lr = rate * (1 - step / steps)
            step += 1
            ids, share_of = bags_[i]
            own = vectors[ids]
            hidden = (share_of * own).sum(axis=0)
            z = layer @ hidden + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1
            vectors[ids] = own - lr * len(ids) ** 0.5 * share_of * (p @ layer)
            layer -= lr * np.outer(p, hidden)
            bias -= 0.1 * lr * p
    return Model(vectors @ (layer[1] - layer[0]), float(bias[1] - bias[0]))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          learn: Column | None = None, max_rows: int = MAX_TRAIN_ROWS) -> Model:
    """Fit on at most ``max_rows`` labelled documents; ``learn`` is a condition on the label rows."""
    known = labels.where(col(label_col).isin(0, 1) & col(id_col).isNotNull())
    known = known if learn is None else known.where(learn)
    chosen = (known.groupBy(col(id_col).alias("id")).agg(F.max(col(label_col)).cast("int").alias("label"))
              .orderBy(F.xxhash64("id"), "id").limit(max_rows))
    rows = docs.select(col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    # One text per chosen id (the smallest), so that at most max_rows bags of at most BUCKETS features leave the tasks.
    rows = rows.join(F.broadcast(chosen), "id").groupBy("id", "label").agg(F.min("text").alias("text"))

    def run(batches):
        import pyarrow as pa
        for group, texts in text_batches(batches):
            found = bags(texts)
            yield pa.RecordBatch.from_arrays(
                [gathered(group, "id").cast(pa.string()), gathered(group, "label"), pa.array([a.tobytes() for a, _ in found], type=pa.binary()),
                 pa.array([b.tobytes() for _, b in found], type=pa.binary())], names=["id", "label", "ids", "weights"])

    got = in_tasks(rows, run, "id string, label int, ids binary, weights binary").collect()
    got.sort(key=lambda r: (r.id, bytes(r.ids), bytes(r.weights)))
    return fit([(np.frombuffer(r.ids, np.int32), np.frombuffer(r.weights, np.float32)) for r in got],
               np.array([r.label for r in got], dtype=np.int64))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score): the probability of label 1 for every document."""
    source, id_type = _source(docs, id_col, text_col)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa
        for group, texts in text_batches(batches):
            yield pa.RecordBatch.from_arrays([gathered(group, "id"), pa.array(sent.value.scores(texts))], names=["id", "score"])

    return in_tasks(source, run, f"id {id_type}, score double").withColumnRenamed("id", id_col)


def held_out(id_col: str = "doc_id") -> Column:
    return id_crc(id_col) % 4 == 2


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows whose score is under the threshold; all columns as they came."""
    mark, text = fresh(docs, "_score", "_text")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    read = docs.withColumn(text, text_or_empty(text_col))
    names = docs.columns

    def run(batches):
        import pyarrow as pa
        for group, texts in text_batches(batches, text):
            good, at = sent.value.scores(texts) >= threshold, 0
            for batch, first, last in group:
                yield batch.select(names).slice(first, last - first).filter(pa.array(good[at:at + last - first]))
                at += last - first

    return in_tasks(read, run, docs.schema)


def quality_classifier(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Digest: doc_id, held_out, score, predicted."""
    model = train(docs, labels, learn=~held_out())
    scored = score(docs, model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
