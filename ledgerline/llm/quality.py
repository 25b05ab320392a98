"""Quality by co-training: a text-content and a page-metadata classifier teach
each other, then their calibrated views are combined.

*Views.* Text: shares of character classes, of repeated words and lines, and
lengths, taken from the whole text. Metadata: the document's source, language
and stated length (hashed one-hot and logarithm). Each view has a ridge logistic
regression of its own.

*Co-training.* Up to ``TRAIN_ROWS`` labelled documents, in the order of a hash
of doc_id, are read; a fifth of them is set aside. The pool is every row without
a label; its features are written once and stay distributed. In each of
``ROUNDS`` rounds every view labels the whole pool, and its ``SHARE`` most
confident documents of each class, if surer than ``CONFIDENT``, join the other
view's training set with those pseudo-labels. Confidences are compared in steps
of 1 / ``STEPS`` of log odds: the documents of the step in which the share ends
join with the weight that makes the share exact, so no order decides. The views
are fitted on the labelled rows and sums (moments, gradient, Hessian) over all
chosen rows; a task recomputes the choices from the rounds' models.

*Calibration and combination.* On the set-aside labelled documents each view's
log odds are calibrated (Platt), and a logistic regression with non-negative
weights combines the calibrated log odds. All documents are then scored in one pass.

Defined cases: null and empty texts have the features of a text without words;
null metadata is a value of its own; without labels of both classes every score
is the smoothed base rate; repeated label rows count once; an empty table gives an empty
result; columns other than doc_id, text, lang, source and n_chars are not read,
and missing metadata columns count as null.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.near_dedup import with_ids
from ledgerline.llm.storage import materialise
from ledgerline.llm.textscan import text_chunks, word_hashes, word_spans

TRAIN_ROWS = 8_000
ROUNDS = 3
SHARE = 0.05
CONFIDENT = 0.9
STEPS = 256
REJECT_BELOW = 0.3                      # documents with a lower probability of being good go
META_BUCKETS = 64

_CLASS_CHARS = (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\n", b"\n",
                b".,;:", b"!", b"?", b"|", b"$%&#*", b"\"'()[]{}", b"<>=/\\_+-@^~`")
_CLASSES = np.zeros((len(_CLASS_CHARS), 256), dtype=np.float32)
for _k, _chars in enumerate(_CLASS_CHARS):
    _CLASSES[_k, list(_chars)] = 1
N_TEXT = len(_CLASS_CHARS) * 2 + 7


def text_features(texts) -> np.ndarray:
    """One row per text: per character class its share of bytes (also as a
    square root, which spreads small shares), mean word length, share of
    distinct words, share of the commonest word, share of repeated lines'
    words, log lengths, and whether there are no words."""
    rows = []
    for _, _, data, offsets in text_chunks(texts):
        starts, ends, doc_words = word_spans(data, offsets)
        words = word_hashes(data, starts, ends)
        for k in range(len(offsets) - 1):
            part = data[offsets[k]:offsets[k + 1]]
            w = words[doc_words[k]:doc_words[k + 1]]
            out = np.zeros(N_TEXT)
            if len(w) == 0:
                out[-1] = 1
                rows.append(out)
                continue
            share = _CLASSES @ np.bincount(part, minlength=256).astype(np.float32) / len(part)
            _, times = np.unique(w, return_counts=True)
            lines = [line for line in part.tobytes().split(b"\n") if line]
            repeated = sum(map(len, lines)) - sum(map(len, set(lines)))
            span = (ends - starts)[doc_words[k]:doc_words[k + 1]]
            out[:-7] = np.concatenate([share, np.sqrt(share)])
            out[-7:] = (span.mean() / 10, len(times) / len(w), times.max() / len(w), repeated / len(part),
                        np.log1p(len(w)) / 10, np.log1p(len(lines)) / 10, 0)
            rows.append(out)
    return np.array(rows, dtype=np.float32).reshape(-1, N_TEXT)


def _bucket(value) -> int:
    return zlib.crc32(str(value).encode()) % META_BUCKETS


def meta_features(source: list[int], lang: list[int], n_chars: list) -> np.ndarray:
    """One row per document; ``source`` and ``lang`` are bucket numbers."""
    n = len(source)
    out = np.zeros((n, 2 * META_BUCKETS + 2), dtype=np.float32)
    out[np.arange(n), source] = 1
    out[np.arange(n), META_BUCKETS + np.asarray(lang, dtype=np.int64)] = 1
    out[:, -2] = [np.log1p(max(0, c or 0)) / 10 for c in n_chars]
    out[:, -1] = [c is None for c in n_chars]
    return out


@dataclass
class Logistic:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> Logistic:
        mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        design = np.column_stack([np.ones(len(x)), (x - mean) / scale])
        w = np.zeros(design.shape[1])
        penalty = np.diag([1e-6, *[ridge] * x.shape[1]])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
            step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + penalty,
                                   design.T @ (y - p) - penalty @ w)
            w += step
            if np.abs(step).max() < 1e-6:
                break
        return cls(mean, scale, w)

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.weights[0] + np.clip((x - self.mean) / self.scale, -20, 20) @ self.weights[1:]

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.margin(x), -30, 30)


def _platt(logits: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    fitted = Logistic.fit(logits[:, None], y)
    slope = fitted.weights[1] / fitted.scale[0]
    return float(max(slope, 0.0)), float(fitted.weights[0] - slope * fitted.mean[0])


@dataclass
class CoTrained:
    views: tuple[Logistic, Logistic]
    platt: list[tuple[float, float]]
    weights: tuple[float, float]
    intercept: float

    def score(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        z = np.full(len(text), self.intercept)
        for view, (a, b), w, x in zip(self.views, self.platt, self.weights, (text, meta)):
            z += w * (a * view.logit(x) + b)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Choice:
    """What a pupil's teacher gives it in a round: per class (good, bad) the
    step that the share ends in, and the weight of that step's rows."""
    teacher: Logistic
    cuts: tuple[tuple[float, float], tuple[float, float]]


def _steps(margin: np.ndarray) -> np.ndarray:
    return np.floor(np.clip(margin, -200, 200) * STEPS)


def _sure(margin: np.ndarray) -> np.ndarray:
    return margin >= np.log(CONFIDENT / (1 - CONFIDENT))


def _pseudo_labels(choices: list[Choice], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Labels and weights that one pupil's rounds gave the rows whose teacher's
    view is ``x``; weight 0 for rows that weren't chosen."""
    labels, weights = np.zeros(len(x)), np.zeros(len(x))
    for choice in choices:
        free, margin = weights == 0, choice.teacher.margin(x)
        for label, side, (cut, part) in zip((1.0, 0.0), (margin, -margin), choice.cuts):
            steps = _steps(side)
            weight = np.where(steps > cut, 1.0, np.where(steps == cut, part, 0.0)) * (free & _sure(side))
            labels[weight > 0] = label
            weights += weight
    return labels, weights


def _confident(state, views) -> np.ndarray:
    """(pupil, class, step, rows) of the sure rows that are still free. ``state``:
    each pupil's choices so far and its teacher."""
    out = [np.empty((0, 4))]
    for pupil, (choices, teacher) in enumerate(state):
        x = views[1 - pupil]
        free, margin = _pseudo_labels(choices, x)[1] == 0, teacher.margin(x)
        for label, side in ((0, margin), (1, -margin)):
            steps, n = np.unique(_steps(side)[free & _sure(side)], return_counts=True)
            out.append(np.column_stack([np.full(len(n), pupil), np.full(len(n), label), steps, n]))
    return np.concatenate(out)


def _moments(state, views) -> np.ndarray:
    """Per pupil: weight, sums of x - centre and of its square. ``state``: each
    pupil's choices and centre."""
    out = []
    for pupil, (choices, centre) in enumerate(state):
        w = _pseudo_labels(choices, views[1 - pupil])[1]
        x = views[pupil][w > 0] - centre
        w = w[w > 0]
        out += [[w.sum()], w @ x, w @ x ** 2]
    return np.concatenate(out)


def _newton_sums(design: np.ndarray, y: np.ndarray, w: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Gradient and Hessian of the log likelihood, in one row."""
    p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
    return np.concatenate([design.T @ (w * (y - p)), ((design * (w * p * (1 - p))[:, None]).T @ design).ravel()])


def _standard(model: Logistic, x: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(x)), (x - model.mean) / model.scale])


def _newton(state, views) -> np.ndarray:
    """Per pupil the sums of a Newton step. ``state``: choices and model."""
    out = []
    for pupil, (choices, model) in enumerate(state):
        y, w = _pseudo_labels(choices, views[1 - pupil])
        rows = w > 0
        out.append(_newton_sums(_standard(model, views[pupil][rows]), y[rows], w[rows], model.weights))
    return np.concatenate(out)


class ArrayPool:
    """Unlabelled rows in memory."""

    def __init__(self, views: tuple[np.ndarray, np.ndarray]):
        self.views, self.size = views, len(views[0])

    def counts(self, state) -> np.ndarray:
        return _confident(state, self.views)

    def sums(self, what, state) -> np.ndarray:
        return what(state, self.views)


class TablePool:
    """Unlabelled rows as a written table of compact views; a task keeps sums
    of its rows, so what reaches the driver doesn't grow with them."""

    def __init__(self, table: DataFrame):
        self.table, self.size = table, table.count()

    def counts(self, state) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = _confident(state, _compact_views(batch)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in found.T], ["pupil", "class", "step", "n"])
        rows = (self.table.mapInArrow(run, "pupil long, class long, step long, n long")
                .groupBy("pupil", "class", "step").agg({"n": "sum"}).toArrow())
        return np.column_stack([c.to_numpy() for c in rows.columns]).astype(float).reshape(-1, 4)

    def sums(self, what, state) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                part = what(state, _compact_views(batch))
                total = part if total is None else total + part
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])
        return sum(np.frombuffer(r.sums) for r in self.table.mapInArrow(run, "sums binary").collect())


def _cut(steps: np.ndarray, n: np.ndarray, most: int) -> tuple[float, float]:
    """The step in which the ``most`` surest rows end, and the part of its rows
    that belongs to them."""
    order = np.argsort(-steps)
    upto = np.cumsum(n[order])
    k = int(np.searchsorted(upto, most))
    if k == len(upto):
        return -np.inf, 1.0
    return float(steps[order][k]), float((most - upto[k] + n[order][k]) / n[order][k])


def _fit_pupils(sets: list[tuple[np.ndarray, np.ndarray]], pool, choices: list[list[Choice]],
                ridge: float = 1.0) -> list[Logistic]:
    """Both views' regressions over the labelled rows and the chosen rows."""
    centres = [x.mean(axis=0) for x, _ in sets]
    found = pool.sums(_moments, list(zip(choices, centres)))
    models, at = [], 0
    for (x, _), centre in zip(sets, centres):
        k = len(centre)
        n, first, second = found[at], found[at + 1:at + 1 + k], found[at + 1 + k:at + 1 + 2 * k]
        at += 1 + 2 * k
        shift = first / (len(x) + n)
        square = (((x - centre) ** 2).sum(axis=0) + second) / (len(x) + n)
        models.append(Logistic(centre + shift, np.sqrt(np.maximum(square - shift ** 2, 0)) + 1e-6, np.zeros(k + 1)))
    for _ in range(30):
        found, at, largest = pool.sums(_newton, list(zip(choices, models))), 0, 0.0
        for model, (x, y) in zip(models, sets):
            k = len(model.weights)
            total = found[at:at + k + k * k] + _newton_sums(_standard(model, x), y, np.ones(len(x)), model.weights)
            at += k + k * k
            penalty = np.diag([1e-6, *[ridge] * (k - 1)])
            step = np.linalg.solve(total[k:].reshape(k, k) + penalty, total[:k] - penalty @ model.weights)
            model.weights = model.weights + step
            largest = max(largest, np.abs(step).max())
        if largest < 1e-6:
            break
    return models


def co_train(views: tuple[np.ndarray, np.ndarray], y: np.ndarray, pool, held: np.ndarray,
             rounds: int = ROUNDS) -> CoTrained:
    """``views``: text and metadata features of the labelled rows; ``pool``: the
    unlabelled rows' (arrays or a :class:`TablePool`); ``held``: which labelled
    rows are set aside for calibration."""
    pool = ArrayPool(pool) if isinstance(pool, tuple) else pool
    sets = [(v[~held], y[~held]) for v in views]
    choices: list[list[Choice]] = [[], []]
    models = [Logistic.fit(*s) for s in sets]
    most = max(1, int(SHARE * pool.size))
    for _ in range(rounds if pool.size else 0):
        found = pool.counts([(choices[pupil], models[1 - pupil]) for pupil in (0, 1)])
        for pupil in (0, 1):
            cuts = tuple(_cut(*found[(found[:, 0] == pupil) & (found[:, 1] == k)][:, 2:].T, most) for k in (0, 1))
            choices[pupil] = [*choices[pupil], Choice(models[1 - pupil], cuts)]
        models = _fit_pupils(sets, pool, choices)
    z = [m.logit(v[held]) for m, v in zip(models, views)]
    platt = [_platt(logits, y[held]) for logits in z]
    calibrated = np.column_stack([a * logits + b for (a, b), logits in zip(platt, z)])
    both = Logistic.fit(calibrated, y[held])
    weights = np.maximum(both.weights[1:] / both.scale, 0.0)
    rate = np.log((y[held].sum() + 0.5) / (len(y[held]) - y[held].sum() + 0.5))
    intercept = both.weights[0] - float(weights @ both.mean) if weights.any() else rate
    return CoTrained(tuple(models), platt, tuple(weights.tolist()), float(intercept))


def _columns(docs: DataFrame) -> DataFrame:
    def or_null(name: str, kind: str):
        return (F.col(name).cast(kind) if name in docs.columns else F.lit(None).cast(kind)).alias(name)
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), or_null("source", "string"),
                       or_null("lang", "string"), or_null("n_chars", "long"))


def _meta_columns(batch: pa.RecordBatch) -> tuple[list[int], list[int], list]:
    source, lang, n_chars = (batch.column(batch.schema.get_field_index(c)).to_pylist()
                             for c in ("source", "lang", "n_chars"))
    return [_bucket(s) for s in source], [_bucket(x) for x in lang], n_chars


def _views(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return text_features(batch.column(batch.schema.get_field_index("text"))), meta_features(*_meta_columns(batch))


def _view_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents' views in a compact form."""
    for batch in batches:
        text = text_features(batch.column(batch.schema.get_field_index("text")))
        source, lang, n_chars = _meta_columns(batch)
        columns = {"doc_id": batch.column(batch.schema.get_field_index("doc_id")),
                   "text_view": pa.array([row.tobytes() for row in text], pa.binary()),
                   "source": pa.array(source, pa.int32()), "lang": pa.array(lang, pa.int32()),
                   "n_chars": pa.array(n_chars, pa.int64())}
        yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _compact_views(table) -> tuple[np.ndarray, np.ndarray]:
    """The views of a batch or table of compact ones."""
    source, lang, n_chars, text = (table.column(table.schema.get_field_index(c)).to_pylist()
                                   for c in ("source", "lang", "n_chars", "text_view"))
    return (np.frombuffer(b"".join(text), dtype=np.float32).reshape(-1, N_TEXT).astype(float),
            meta_features(source, lang, n_chars).astype(float))


def learn(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> CoTrained | None:
    """The classifier, or nothing without labels of both classes. The driver
    gets the features of at most ``train_rows`` labelled documents; the pool of
    all others stays a written table of their features."""
    order = F.xxhash64(F.col("doc_id"), F.lit("quality"))
    known = (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
             .groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality")))
    sample = materialise(known.orderBy(order, "doc_id").limit(train_rows).select(F.col("doc_id").alias("sampled"), "quality")
                         .withColumn("held", F.pmod(F.xxhash64("sampled", F.lit("held")), F.lit(5)) == 0), "quality-ids")
    schema = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL(
        "text_view binary, source int, lang int, n_chars long").fields])
    compact = materialise(_columns(docs).mapInArrow(_view_batches, schema), "quality-views")
    table = (compact.join(F.broadcast(sample), F.col("doc_id") == F.col("sampled")).drop("sampled")
             .dropDuplicates(["doc_id"]).toArrow())
    y = table["quality"].to_numpy().astype(float)
    held = table["held"].to_numpy(zero_copy_only=False).astype(bool)
    if min((y[~held] == 0).sum(), (y[~held] == 1).sum()) == 0:
        return None
    views = _compact_views(table)
    pool = TablePool(materialise(with_ids(compact, known, "left_anti", "doc_id"), "quality-pool"))
    if len(set(y[held].tolist())) < 2:              # too few to set aside: calibrate on all
        return co_train(tuple(np.vstack([v] * 2) for v in views), np.concatenate([y, y]), pool,
                        np.concatenate([np.zeros(len(y), bool), np.ones(len(y), bool)]))
    return co_train(views, y, pool, held)


def _score_batches(model: CoTrained | None, rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.score(*_views(batch)) if model else np.full(batch.num_rows, rate)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])
    return run


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, score (probability of being good),
    accepted."""
    model = learn(docs, labels)
    rate = 0.5
    if model is None:
        n = labels.filter(F.col("quality").isin(0, 1)).agg(F.sum("quality").alias("good"), F.count("*").alias("n")).first()
        rate = ((n.good or 0) + 0.5) / (n.n + 1)
    schema = T.StructType([docs.schema["doc_id"], T.StructField("score", T.DoubleType())])
    return (_columns(docs).mapInArrow(_score_batches(model, rate), schema)
            .withColumn("accepted", F.col("score") >= REJECT_BELOW))


def _filter_batches(model: CoTrained | None, rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = ("text", "source", "lang", "n_chars")
            fields = [batch.column(batch.schema.get_field_index("view")).field(c) for c in names]
            scores = (model.score(*_views(pa.RecordBatch.from_arrays(fields, list(names))))
                      if model else np.full(batch.num_rows, rate))
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("row"))], ["row"]).filter(
                pa.array(scores >= REJECT_BELOW))
    return run


def drop_low_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents that the classifier rejects: one pass, no
    shuffle of texts."""
    model = learn(docs, labels)
    if model is None:
        return docs
    view = _columns(docs)
    names = [c for c in view.columns if c != "doc_id"]
    own = {c: (F.col(f"`{c}`") if c in docs.columns else F.lit(None)) for c in names}
    kinds = {"text": "string", "source": "string", "lang": "string", "n_chars": "long"}
    both = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.struct(*[own[c].cast(kinds[c]).alias(c) for c in names]).alias("view"))
    schema = T.StructType([T.StructField("row", docs.schema)])
    return both.mapInArrow(_filter_batches(model, 0.5), schema).select("row.*")
