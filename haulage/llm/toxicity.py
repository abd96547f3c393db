"""Toxicity by a convolutional text classifier, trained in numpy.

A word is the sum of hashed embeddings of itself and of its first bytes (so that
unseen inflections share a part). Filters of several widths slide over the words;
the largest answer of each filter in the whole text feeds a logistic output.
Long texts are read in pieces that overlap by the widest filter, and the
largest answers are carried on, so memory does not grow with the text.

The model is fitted on at most ``max_per_class`` labelled documents of each class, of together
``MAX_SAMPLE_BYTES``, in an order fixed by a hash; everything else covers all rows. Of rows that
share a labelled doc_id one is fitted on; an id that is labelled both ways takes no part. A threshold for each
language is the step of ``GRID`` with the fewest errors in all labelled rows of that
language that were not fitted on: all beyond the sample, and what ``_kept_apart``
leaves out of it. A language with fewer than ``MIN_CALIBRATION`` such rows of a class
uses 0.5. The score never sees the language.

Defined results: null or wordless text has the score of an empty document; null
language uses 0.5; repeated rows score alike; without labelled rows of both
classes the model scores every text near 0; an empty table gives no rows; other
columns pass through ``without_toxic`` unchanged.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from haulage.llm.storing import small_batches
from haulage.llm.words import mix, words_of

WIDTHS = (1, 2, 3)
FILTERS = 12
DIMENSIONS = 12
TABLE_BITS = 15
HEADS = (4, 6)
MAX_PER_CLASS = 2500
MAX_SAMPLE_BYTES = 1 << 26
EPOCHS = 5
MIN_UPDATES = 1000
BATCH = 32
STEP = 0.08
PIECE_WORDS = 1 << 16
MIN_CALIBRATION = 20
THRESHOLD_RANGE = (0.2, 0.8)
GRID = np.linspace(*THRESHOLD_RANGE, 25)


def features(column: pa.Array, bits: int = TABLE_BITS):
    """Per chunk of rows: table places of every word's parts, and where each row begins."""
    for chunk in words_of(column, lower=True, heads=HEADS):
        parts = [mix(h, 21 + i) >> np.uint64(64 - bits) for i, h in enumerate([chunk.hash, *chunk.heads])]
        yield np.stack(parts, axis=1).astype(np.int32), chunk.offsets()


@dataclass
class Classifier:
    """Embeddings, filters by width, output weights, and thresholds by language."""

    table: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    out: np.ndarray
    out_bias: float
    thresholds: dict[str, float] = field(default_factory=dict)

    @classmethod
    def new(cls, seed: int = 2) -> Classifier:
        random = np.random.default_rng(seed)
        normal = lambda *shape, scale: random.normal(0, scale, shape).astype(np.float32)
        return cls(
            normal(1 << TABLE_BITS, DIMENSIONS, scale=0.1),
            [normal(w * DIMENSIONS, FILTERS, scale=(w * DIMENSIONS) ** -0.5) for w in WIDTHS],
            [np.zeros(FILTERS, dtype=np.float32) for _ in WIDTHS],
            normal(FILTERS * len(WIDTHS), scale=0.1),
            0.0,
        )

    def pooled(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The largest answer of each filter (0 at least), where it was, and the embedded words."""
        words = self.table[places].sum(axis=1)
        answers, where = [], []
        for width, weights, bias in zip(WIDTHS, self.filters, self.biases, strict=True):
            n = len(words) - width + 1
            if n <= 0:
                answers.append(np.zeros(FILTERS, np.float32))
                where.append(np.full(FILTERS, -1))
                continue
            total = np.zeros((n, FILTERS), dtype=np.float32)
            for i in range(width):
                total += words[i : i + n] @ weights[i * DIMENSIONS : (i + 1) * DIMENSIONS]
            at = total.argmax(axis=0)
            most = total[at, np.arange(FILTERS)] + bias
            answers.append(np.maximum(most, 0))
            where.append(np.where(most > 0, at, -1))
        return np.concatenate(answers), np.concatenate(where), words

    def score(self, places: np.ndarray) -> float:
        most = np.zeros(len(self.out), dtype=np.float32)
        for at in range(0, max(len(places), 1), PIECE_WORDS):
            part = places[at : at + PIECE_WORDS + max(WIDTHS) - 1]
            most = np.maximum(most, self.pooled(part)[0])
        return float(1 / (1 + np.exp(-np.clip(most @ self.out + self.out_bias, -30, 30))))

    def fit(self, texts: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 2) -> None:
        """Adagrad on the logistic loss, both classes weighing the same.

        Only the places that gave a maximum learn. A small sample is read more often.
        """
        random = np.random.default_rng(seed)
        parameters = [self.table, *self.filters, *self.biases, self.out]
        seen = [np.full(p.shape, 1e-6, dtype=np.float32) for p in parameters]
        bias_seen = 1e-6
        share = float(np.clip(labels.mean(), 0.05, 0.95))
        weights = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
        for _ in range(max(epochs, -(-MIN_UPDATES * BATCH // len(texts)))):
            order = random.permutation(len(texts))
            for at in range(0, len(order), BATCH):
                batch = order[at : at + BATCH]
                steps = [np.zeros_like(p) for p in parameters[1:]]
                rows, row_steps, bias_step = [], [], 0.0
                for d in batch:
                    answers, where, words = self.pooled(texts[d])
                    error = 1 / (1 + np.exp(-np.clip(answers @ self.out + self.out_bias, -30, 30))) - labels[d]
                    error *= weights[d]
                    steps[-1] += error * answers
                    bias_step += error
                    back = error * self.out
                    for f in np.flatnonzero(where >= 0):
                        which, column = divmod(int(f), FILTERS)
                        width, begin = WIDTHS[which], int(where[f])
                        steps[which][:, column] += back[f] * words[begin : begin + width].ravel()
                        steps[len(WIDTHS) + which][column] += back[f]
                        to = back[f] * self.filters[which][:, column].reshape(width, DIMENSIONS)
                        for i in range(width):
                            rows.append(texts[d][begin + i])
                            row_steps.append(to[i])
                for p, g, s in zip(parameters[1:], steps, seen[1:], strict=True):
                    g /= len(batch)
                    s += g * g
                    p -= STEP * g / np.sqrt(s)
                bias_step /= len(batch)
                bias_seen += bias_step**2
                self.out_bias -= STEP * bias_step / bias_seen**0.5
                if rows:
                    flat_rows = np.concatenate(rows)
                    values = np.repeat(np.array(row_steps, dtype=np.float32) / len(batch), [len(r) for r in rows], axis=0)
                    touched, inverse = np.unique(flat_rows, return_inverse=True)
                    total = np.zeros((len(touched), DIMENSIONS), dtype=np.float32)
                    np.add.at(total, inverse, values)
                    seen[0][touched] += total * total
                    self.table[touched] -= STEP * total / np.sqrt(seen[0][touched])

    def calibrate(self, counts: dict[str, np.ndarray]) -> None:
        """The threshold of each language with the fewest errors, nearest to 0.5.

        ``counts`` has, by language, the rows of each class (0 and 1) and step (``steps``).
        """
        for lang, (plain, toxic) in counts.items():
            if min(plain.sum(), toxic.sum()) >= MIN_CALIBRATION:
                errors = np.cumsum(toxic)[:-1] + plain.sum() - np.cumsum(plain)[:-1]
                self.thresholds[lang] = float(GRID[min(range(len(GRID)), key=lambda i: (errors[i], abs(GRID[i] - 0.5)))])

    def threshold(self, lang: str | None) -> float:
        return self.thresholds.get(lang or "", 0.5)

    def scores(self, column: pa.Array) -> np.ndarray:
        out = [
            self.score(places[a:b]) for places, bounds in features(column) for a, b in zip(bounds[:-1], bounds[1:], strict=True)
        ]
        return np.array(out, dtype=np.float64)


def steps(scores: np.ndarray) -> np.ndarray:
    """How many steps of ``GRID`` each score reaches."""
    return np.searchsorted(GRID, scores, side="right")


def _steps(model: Classifier):
    def run(batches):
        for batch in batches:
            reached = pa.array(steps(model.scores(batch.column(1))).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), reached], names=["doc_id", "lang", "step"])

    return run


def _kept_apart(truth: np.ndarray, langs: list[str | None]) -> np.ndarray:
    """The sampled rows that calibrate: a fifth, and ``MIN_CALIBRATION`` of each language and class.

    A language is given these as long as half of its class is left to fit, the
    one that lacks least first.
    """
    apart = np.arange(len(truth)) % 5 == 0
    kinds = np.array([x or "" for x in langs], dtype=object)
    for label in (0, 1):
        room = (truth == label).sum() // 2 - (apart & (truth == label)).sum()
        lacks = []
        for lang in sorted({x for x in kinds if x}):
            own = (kinds == lang) & (truth == label)
            more = MIN_CALIBRATION - (apart & own).sum()
            if more > 0 and own.sum() >= MIN_CALIBRATION:
                lacks.append((more, lang))
        for more, lang in sorted(lacks):
            if more <= room:
                apart[np.flatnonzero((kinds == lang) & (truth == label) & ~apart)[:more]] = True
                room -= more
    return apart


def sampled(docs: DataFrame, chosen: DataFrame, max_bytes: int = MAX_SAMPLE_BYTES) -> pa.Table:
    """label_id, order, toxic, lang, text: one document of each chosen id, in the ids' order.

    ``chosen`` has a bounded number of distinct ids, so it can be broadcast. Documents are taken as
    far as their texts fit into ``max_bytes``, the least text of those that share an id.
    """
    joined = docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))
    key = ["label_id", "order", "toxic"]
    one = F.min(F.struct(F.octet_length("text").alias("bytes"), F.xxhash64("text", "lang").alias("hash"))).alias("one")
    sizes = sorted(joined.groupBy(*key).agg(one).collect(), key=lambda r: (r["order"], r["toxic"]))
    total, kept = 0, []
    for row in sizes:
        total += row["one"]["bytes"] or 0
        if kept and total > max_bytes:
            break
        kept.append((row["label_id"], row["one"]["hash"]))
    id_type = chosen.schema["label_id"].dataType.simpleString()
    taken = docs.sparkSession.createDataFrame(kept, f"taken_id {id_type}, taken_hash long")
    is_taken = (F.col("label_id") == F.col("taken_id")) & (F.xxhash64("text", "lang") == F.col("taken_hash"))
    rows = joined.join(F.broadcast(taken), is_taken).groupBy(*key).agg(F.min(F.struct("lang", "text")).alias("row"))
    return rows.select(*key, "row.lang", "row.text").orderBy("order", "toxic").toArrow()


def train(docs: DataFrame, labels: DataFrame, max_per_class: int = MAX_PER_CLASS, epochs: int = EPOCHS) -> Classifier:
    """Fit on a bounded sample of labelled documents; ``labels`` has doc_id and toxic.

    Thresholds are calibrated on all labelled documents that were not fitted on.
    """
    marked = labels.select(F.col("doc_id").alias("label_id"), F.col("toxic").cast("int").alias("toxic")).filter("toxic IN (0, 1)")
    marked = marked.groupBy("label_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).filter("toxic = most").drop("most")
    order = F.md5(F.concat(F.lit("order:"), F.col("label_id").cast("string")).cast("binary"))
    chosen = None
    for label in (0, 1):
        part = marked.filter(F.col("toxic") == label).withColumn("order", order).orderBy("order").limit(max_per_class)
        chosen = part if chosen is None else chosen.unionAll(part)
    own = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    table = sampled(own, chosen)
    model = Classifier.new()
    truth = np.array(table.column("toxic").to_pylist(), dtype=np.float32)
    if len(set(truth.tolist())) < 2:
        model.out[:] = 0
        model.out_bias = -10.0
        return model
    texts = [
        places[a:b]
        for places, bounds in features(table.column("text").combine_chunks())
        for a, b in zip(bounds[:-1], bounds[1:], strict=True)
    ]
    fitted = np.flatnonzero(~_kept_apart(truth, table.column("lang").to_pylist()))
    model.fit([texts[i] for i in fitted], truth[fitted], epochs)

    ids = [(x,) for x in sorted(set(table.column("label_id").take(pa.array(fitted)).to_pylist()))]
    used = docs.sparkSession.createDataFrame(ids, marked.select("label_id").schema)
    others = marked.join(F.broadcast(used), "label_id", "left_anti")
    # texts stay where they are; a row per language, class and step comes to the driver
    columns = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    reached = columns.mapInArrow(_steps(model), f"doc_id {dict(docs.dtypes)['doc_id']}, lang string, step int")
    met = reached.join(others, F.col("doc_id") == F.col("label_id")).filter("lang != ''")
    with small_batches(docs.sparkSession):
        totals = met.groupBy("lang", "toxic", "step").count().collect()
    counts: dict[str, np.ndarray] = {}
    for lang, label, step, n in totals:
        counts.setdefault(lang, np.zeros((2, len(GRID) + 1), dtype=np.int64))[label, step] += n
    model.calibrate(counts)
    return model


def _scores(model: Classifier):
    def run(batches):
        for batch in batches:
            score = model.scores(batch.column(1))
            limit = np.array([model.threshold(x) for x in batch.column(2).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score), pa.array(limit), pa.array(score >= limit)],
                names=["doc_id", "score", "threshold", "toxic"],
            )

    return run


def score(docs: DataFrame, model: Classifier) -> DataFrame:
    """doc_id, score, the language's threshold, and whether the score reaches it."""
    columns = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    kind = dict(docs.dtypes)["doc_id"]
    return columns.mapInArrow(_scores(model), f"doc_id {kind}, score double, threshold double, toxic boolean")


def _keep(model: Classifier, text_at: int, lang_at: int):
    def run(batches):
        for batch in batches:
            limit = np.array([model.threshold(x) for x in batch.column(lang_at).to_pylist()])
            yield batch.filter(pa.array(model.scores(batch.column(text_at)) < limit))

    return run


def without_toxic(docs: DataFrame, model: Classifier) -> DataFrame:
    """The documents below their language's threshold, with all their columns."""
    at = docs.columns.index
    return docs.mapInArrow(_keep(model, at("text"), at("lang")), docs.schema)
