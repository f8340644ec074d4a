"""Language-model scoring: a log-bilinear model trained in numpy by noise-contrastive estimation.

Outcomes.  Every word belongs to one class: the end of a text, each of the ``SINGLES`` most frequent
words, or one of ``BUCKETS`` classes for all others, by a hash of its first and last two bytes.  Then
P(word | history) = P(class | two classes before) * P(word | class).  The first factor is the neural
model; the second is the word's share in its class, counted over the whole training corpus, with the
share n1 / (N + n1) of unknown words taken from the words seen once.  Both add up to 1.

Work.  Three passes over the texts: word counts (grouped by Spark); training, where every task goes
once through its own tokens from the same start and Spark averages the parameters, weighted by tokens;
scoring, where matrix products over all distinct histories of a task give the logarithm of their
normalising sums, each once.  Texts become numbers ``PART_CHARS`` characters at a time; training gathers
the classes (2 bytes each) of ``BATCH_CHARS`` characters, among which it draws.  Counts of the ``FREQUENT`` most frequent words (of at most ``MAX_BYTES`` bytes, so the
table has a fixed bound) go to the tasks; all other words of a text leave it as (text, word, times) and
meet their counts in a join.

Results for odd input: a null or empty text is the end token alone; rows with a null id count as id ''
(whose crc32 is 0: held out); an empty training set gives every token the unknown share; repeated rows
are scored each, and counted each in training; texts of any length are scored whole; an empty table gives an empty result; extra columns are
ignored.  The input must give the same rows in the same order when read again, as files do.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapse.functions.materialize import freeze
from lapse.llm.common import BATCH_CHARS, coded_words, col, gathered, id_crc, in_tasks, per_text, text_batches, text_or_empty

SINGLES, BUCKETS, FREQUENT, MAX_BYTES = 255, 256, 200_000, 64
PART_CHARS = 4_000_000
CLASSES = 1 + SINGLES + BUCKETS  # class 0 is the end, which also stands before the first word
DIM, NOISE, BATCH, RATE, SEED = 16, 32, 4096, 0.15, 11
PRIOR = 0.1  # added to every count in the base score


def bucket_of(words: list[bytes]) -> np.ndarray:
    return np.fromiter((zlib.crc32(w[:2] + b"\x00" + w[-2:]) % BUCKETS for w in words), dtype=np.int64, count=len(words))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    source = docs.select(col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    return source, source.schema["id"].dataType.simpleString()


def word_counts(training: DataFrame) -> DataFrame:
    """(word, bucket, c) over all training texts."""
    def run(batches):
        import pyarrow as pa
        for _, texts in text_batches(batches, limit=PART_CHARS):
            words, numbers, _ = coded_words(texts, lower=True)
            counts = np.bincount(numbers, minlength=len(words))
            used = np.flatnonzero(counts)
            words, counts = words.take(used), counts[used]
            yield pa.RecordBatch.from_arrays([words.cast(pa.binary()), pa.array(bucket_of(words.to_pylist()).astype("i4")), pa.array(counts)],
                                             names=["word", "bucket", "c"])

    parts = in_tasks(training.select("text"), run, "word binary, bucket int, c long")
    return parts.groupBy("word").agg(F.first("bucket").alias("bucket"), F.sum("c").alias("c"))


@dataclass
class Lexicon:
    """What every task knows of the words: the frequent ones with counts and classes, and totals."""
    words: object  # Arrow binary array, most frequent first
    counts: np.ndarray
    classes: np.ndarray
    class_log: np.ndarray  # log10 of P(word | class)
    n_tokens: int
    n_words: int  # distinct, with the end
    n_texts: int
    total: np.ndarray  # per bucket: tokens of its words
    once: np.ndarray  # per bucket: words seen once
    class_share: np.ndarray  # of all training tokens, per class

    def base_log(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + PRIOR) / (self.n_tokens + PRIOR * (self.n_words + 1)))


def _frequent_over(counts: DataFrame, most: int) -> int:
    """A count that at most ``most`` words exceed (the smallest such, as near as quantiles tell)."""
    words = counts.count()
    if words <= most:
        return 0
    over = counts.agg(F.percentile_approx("c", F.lit(1 - most / words), F.lit(100_000))).first()[0]
    while counts.where(F.col("c") > over).count() > most:
        over += 1 + over // 10
    return over


def lexicon(counts: DataFrame, n_texts: int, frequent: int = FREQUENT, singles: int = SINGLES) -> Lexicon:
    import pyarrow as pa
    short = counts.where(F.octet_length("word") <= MAX_BYTES)
    kept = short.where(F.col("c") > _frequent_over(short, frequent)).collect()  # at most ``frequent`` rows
    kept.sort(key=lambda r: (-r.c, bytes(r.word)))
    alone = [bytes(r.word) for r in kept[:singles]]
    others = counts.where(~F.col("word").isin(alone)) if alone else counts
    by_bucket = {r.bucket: r for r in others.groupBy("bucket").agg(
        F.sum("c").alias("n"), F.sum((F.col("c") == 1).cast("long")).alias("once")).collect()}
    total = np.array([by_bucket[b].n if b in by_bucket else 0 for b in range(BUCKETS)], dtype=np.int64)
    once = np.array([by_bucket[b].once if b in by_bucket else 0 for b in range(BUCKETS)], dtype=np.int64)
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    c = np.array([r.c for r in kept], dtype=np.int64)
    bucket = np.array([r.bucket for r in kept], dtype=np.int64)
    classes = np.where(np.arange(len(kept)) < singles, 1 + np.arange(len(kept)), 1 + SINGLES + bucket)
    log = np.where(np.arange(len(kept)) < singles, 0.0, np.log10(np.maximum(c, 1) / (total + once + 1)[bucket]))
    share = np.zeros(CLASSES)
    share[0] = n_texts
    share[1:1 + len(c[:singles])] = c[:singles]
    share[1 + SINGLES:] = total
    return Lexicon(pa.array([bytes(r.word) for r in kept], type=pa.large_binary()), c, classes, log, int(n) + n_texts,
                   int(v) + (1 if n_texts else 0), n_texts, total, once, (share + 0.5) / (share + 0.5).sum())


@dataclass
class Read:
    """A batch as numbers: ``place`` is a word's row in the lexicon or -1; classes include the ends."""
    words: object
    numbers: np.ndarray
    starts: np.ndarray
    place: np.ndarray
    buckets: np.ndarray  # of the distinct words that the lexicon does not hold
    target: np.ndarray
    before: np.ndarray  # the class before, and the one before that
    earlier: np.ndarray
    ends: np.ndarray  # index of each text's end token in target


def read(texts: list[str], lex: Lexicon) -> Read:
    import pyarrow.compute as pc
    words, numbers, starts = coded_words(texts, lower=True)
    found = pc.index_in(words, value_set=lex.words)
    place = found.fill_null(-1).to_numpy().astype(np.int64)
    rare = np.flatnonzero(place < 0)
    buckets = np.zeros(len(words), dtype=np.int64)
    buckets[rare] = bucket_of(words.take(rare).to_pylist())
    of_word = np.where(place >= 0, np.append(lex.classes, 0)[place], 1 + SINGLES + buckets)
    ends = starts[1:] + np.arange(len(texts))
    target = np.zeros(len(numbers) + len(texts), dtype=np.int64)
    inner = np.ones(len(target), dtype=bool)
    inner[ends] = False
    target[inner] = of_word[numbers]
    before = np.concatenate(([0], target[:-1]))
    # What stands before a text's first word is the end of the text before it, as class 0 says; the word
    # before that must not be seen across it.
    earlier = np.where(before == 0, 0, np.concatenate(([0, 0], target[:-2]))[:len(target)])
    return Read(words, numbers, starts, place, buckets, target, before, earlier, ends)


@dataclass
class Params:
    inputs: np.ndarray  # a vector of every class as history
    outputs: np.ndarray  # and as outcome
    near: np.ndarray  # matrices of the two positions
    far: np.ndarray
    bias: np.ndarray

    @staticmethod
    def start(lex: Lexicon) -> Params:
        rng = np.random.default_rng(SEED)
        return Params(rng.normal(0, 0.1, (CLASSES, DIM)), rng.normal(0, 0.1, (CLASSES, DIM)), np.eye(DIM), 0.5 * np.eye(DIM), np.log(lex.class_share))

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.inputs, self.outputs, self.near, self.far, self.bias)])

    def like(self, flat: np.ndarray) -> Params:
        shapes = [x.shape for x in (self.inputs, self.outputs, self.near, self.far, self.bias)]
        cuts = np.cumsum([int(np.prod(s)) for s in shapes])[:-1]
        return Params(*[p.reshape(s) for p, s in zip(np.split(flat, cuts), shapes)])

    def predicted(self, before: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        return self.inputs[before] @ self.near + self.inputs[earlier] @ self.far


def _scatter(rows: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sum of the value rows of each class."""
    order = np.argsort(rows, kind="stable")
    rows = rows[order]
    first = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
    out = np.zeros((CLASSES, values.shape[1]))
    out[rows[first]] = np.add.reduceat(values[order], first, axis=0)
    return out


class Trainer:
    """One pass of noise-contrastive estimation with AdaGrad steps."""

    def __init__(self, start: Params, lex: Lexicon, seed: int):
        self.p, self.rng, self.seen = start.like(start.flat().copy()), np.random.default_rng([SEED, seed]), 0
        self.log_noise = np.log(NOISE * lex.class_share)
        self.cumulated = np.cumsum(lex.class_share)
        self.squares = start.like(np.full(len(start.flat()), 1e-2))

    def learn(self, target: np.ndarray, before: np.ndarray, earlier: np.ndarray) -> None:
        order = self.rng.permutation(len(target))
        self.seen += len(order)
        for i in range(0, len(order), BATCH):
            rows = order[i:i + BATCH]
            self._step(target[rows], before[rows], earlier[rows])

    def _step(self, target, before, earlier) -> None:
        p, n = self.p, len(target)
        noise = np.minimum(np.searchsorted(self.cumulated, self.rng.random(NOISE)), CLASSES - 1)
        a, b = p.inputs[before], p.inputs[earlier]
        predicted = a @ p.near + b @ p.far
        true_out, noise_out = p.outputs[target], p.outputs[noise]
        true = (predicted * true_out).sum(axis=1) + p.bias[target] - self.log_noise[target]
        false = predicted @ noise_out.T + p.bias[noise] - self.log_noise[noise]
        up = 1 / (1 + np.exp(np.clip(true, -30, 30)))  # 1 - P(from the corpus)
        down = -1 / (1 + np.exp(np.clip(-false, -30, 30)))
        to_predicted = up[:, None] * true_out + down @ noise_out
        out = _scatter(target, up[:, None] * np.column_stack((predicted, np.ones(n))))
        np.add.at(out, noise, np.column_stack((down.T @ predicted, down.sum(axis=0))))
        back = _scatter(np.concatenate((before, earlier)), np.concatenate((to_predicted @ p.near.T, to_predicted @ p.far.T)))
        for name, step in (("inputs", back), ("outputs", out[:, :-1]), ("near", a.T @ to_predicted), ("far", b.T @ to_predicted), ("bias", out[:, -1])):
            step = step / n
            square = getattr(self.squares, name)
            square += step * step
            getattr(p, name)[...] += RATE * step / np.sqrt(square + 1e-8)


def class_groups(batches, lex: Lexicon):
    """(target, before, earlier) of the groups that ``text_batches`` makes, without their texts."""
    def classes(texts):
        r = read(texts, lex)
        return [x.astype(np.int16) for x in (r.target, r.before, r.earlier)]

    held, size = [], 0
    for _, texts in text_batches(batches, limit=PART_CHARS):
        first = 0
        for i, text in enumerate(texts):
            if (held or i > first) and size + len(text) > BATCH_CHARS:
                if i > first:
                    held.append(classes(texts[first:i]))
                yield [np.concatenate(x) for x in zip(*held)]
                held, size, first = [], 0, i
            size += len(text)
        held.append(classes(texts[first:]))
    if held:
        yield [np.concatenate(x) for x in zip(*held)]


def train(training: DataFrame, lex: Lexicon) -> Params:
    """Every task's pass from the same start; parameters averaged by Spark, weighted by tokens."""
    start = Params.start(lex)
    if not lex.n_texts:
        return start
    sent = training.sparkSession.sparkContext.broadcast(lex)

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        trainer = Trainer(Params.start(sent.value), sent.value, TaskContext.get().partitionId())
        for group in class_groups(batches, sent.value):
            trainer.learn(*group)
        if trainer.seen:
            flat = trainer.p.flat()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype="i4")), pa.array(flat * trainer.seen), pa.array(np.full(len(flat), float(trainer.seen)))],
                                             names=["i", "x", "w"])

    parts = in_tasks(training.select("text"), run, "i int, x double, w double")
    rows = parts.groupBy("i").agg((F.sum("x") / F.sum("w")).alias("x")).collect()  # one number per parameter
    flat = start.flat()
    flat[[r.i for r in rows]] = [r.x for r in rows]
    return start.like(flat)


def class_logs(r: Read, p: Params, sums: np.ndarray | None = None, block: int = 2048) -> np.ndarray:
    """log10 P(class | history) of every token: products over the distinct histories, normalised.

    ``sums`` keeps the histories' normalising sums from batch to batch (NaN: not met yet).
    """
    sums = np.full(CLASSES * CLASSES, np.nan) if sums is None else sums
    near, far = p.inputs @ p.near, p.inputs @ p.far
    history = r.earlier * CLASSES + r.before
    met = np.zeros(len(sums), dtype=bool)
    met[history] = True
    new = np.flatnonzero(met & np.isnan(sums))
    outputs, bias = p.outputs.T.astype(np.float32), p.bias.astype(np.float32)
    for i in range(0, len(new), block):
        h = new[i:i + block]
        z = (near[h % CLASSES] + far[h // CLASSES]).astype(np.float32) @ outputs + bias
        top = z.max(axis=1, keepdims=True)
        sums[h] = top[:, 0] + np.log(np.exp(z - top).sum(axis=1, dtype=np.float64))
    out = np.empty(len(history))
    for i in range(0, len(out), 1 << 15):
        w = slice(i, i + (1 << 15))
        predicted, t = (near[r.before[w]] + far[r.earlier[w]]).astype(np.float32), r.target[w]
        out[w] = (predicted * p.outputs[t]).sum(axis=1) + p.bias[t] - sums[history[w]]
    return out / np.log(10)


def score(docs: DataFrame, counts: DataFrame, lex: Lexicon, params: Params, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, base_score, score) of every text."""
    source, id_type = _texts(docs, id_col, text_col)
    sent = docs.sparkSession.sparkContext.broadcast((lex, params))

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        lex, params = sent.value
        number = TaskContext.get().partitionId() << 40
        end = (lex.base_log(np.array([lex.n_texts]))[0], 1 if lex.n_texts else 0)
        sums = np.full(CLASSES * CLASSES, np.nan)
        for group, texts in text_batches(batches, limit=PART_CHARS):
            r = read(texts, lex)
            logs = class_logs(r, params, sums)
            known = r.place >= 0
            place = np.where(known, r.place, 0)
            base = np.where(known, lex.base_log(np.append(lex.counts, 0)[place]), 0.0)
            within = np.where(known, np.append(lex.class_log, 0.0)[place], 0.0)
            text_of = np.repeat(np.arange(len(texts)), np.diff(r.starts))
            n_class = np.concatenate(([0], r.ends + 1))
            # One row per text, then one per text and word that the lexicon does not hold.
            n = np.diff(r.starts) + 1
            rows = number + np.arange(len(texts))
            number += len(texts)
            pairs, times = np.unique((text_of * (len(r.words) + 1) + r.numbers)[~known[r.numbers]], return_counts=True)
            owner, word = pairs // (len(r.words) + 1), pairs % (len(r.words) + 1)
            m, k = len(texts), len(pairs)
            keys = pa.concat_arrays([pa.array([b" %d" % x for x in rows.tolist()], type=pa.binary()), r.words.take(pa.array(word)).cast(pa.binary())])
            zeros, none = np.zeros(k), pa.nulls(k, gathered(group, "id").type)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate((rows, rows[owner]))), keys, pa.array(np.concatenate((np.zeros(m, "i4"), r.buckets[word].astype("i4")))),
                pa.array(np.concatenate((np.zeros(m, "i4"), times.astype("i4")))), pa.concat_arrays([gathered(group, "id"), none]),
                pa.array(np.concatenate((n, zeros.astype(np.int64)))), pa.array(np.concatenate((per_text(known[r.numbers].astype(np.int64), r.starts) + end[1], zeros.astype(np.int64)))),
                pa.array(np.concatenate((per_text(base[r.numbers], r.starts) + end[0], zeros))),
                pa.array(np.concatenate((per_text(logs, n_class) + per_text(within[r.numbers], r.starts), zeros)))],
                names=["row", "word", "bucket", "times", "id", "n_tokens", "n_known", "base", "score"])

    parts = in_tasks(source, run, f"row long, word binary, bucket int, times int, id {id_type}, n_tokens long, n_known long, base double, score double")
    met = parts.join(counts.select("word", "c"), "word", "left")
    c = F.coalesce("c", F.lit(0))
    per_bucket = [F.array(*[F.lit(float(x)) for x in xs]) for xs in (lex.total + lex.once + 1, lex.once + 1)]
    base = F.log10((c + PRIOR) / F.lit(float(lex.n_tokens + PRIOR * (lex.n_words + 1))))
    within = F.log10(F.when(c > 0, c.cast("double")).otherwise(F.get(per_bucket[1], F.col("bucket"))) / F.get(per_bucket[0], F.col("bucket")))
    whole = met.select(
        "row", "id", "n_tokens", (F.col("n_known") + F.when((c > 0) & (F.col("times") > 0), F.col("times")).otherwise(0)).alias("n_known"),
        (F.col("base") + F.when(F.col("times") > 0, F.col("times") * base).otherwise(0.0)).alias("base"),
        (F.col("score") + F.when(F.col("times") > 0, F.col("times") * within).otherwise(0.0)).alias("score"))
    return whole.groupBy("row").agg(F.max("id").alias(id_col), F.sum("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"),
                                    F.sum("base").alias("base_score"), F.sum("score").alias("score")).drop("row")


def held_out(id_col: str = "doc_id") -> Column:
    return id_crc(id_col) % 10 == 0


def lm_scores(docs: DataFrame) -> DataFrame:
    """Digest: doc_id, held_out, token counts, base score and the model's score (log10) of every text."""
    training = docs.where(~held_out()).select(text_or_empty("text").alias("text"))
    counts = freeze(word_counts(training))
    lex = lexicon(counts, training.count())
    scored = score(docs, counts, lex, train(training, lex))
    return scored.select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known",
                         F.lit(lex.n_tokens).cast("long").alias("train_tokens"), "base_score", "score")
