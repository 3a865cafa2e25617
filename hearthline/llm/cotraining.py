"""Quality classifier by co-training of a text view and a page-metadata view.

The text view is a logistic regression on hashed byte bigrams and trigrams of the raw text. The
metadata view is one on what a page record tells without its words: language, source, length and
layout numbers (shares of letters, capitals, digits, marks and line ends, mean word and line
length, repeated words and lines). Both start from the labelled sample and are calibrated on
labelled rows that neither was fitted on (Platt). In each round both views score all unlabelled
documents; either one labels up to ``exchanged`` texts that it is sure of, in the classes'
proportion, and hands them to the other view, which is fitted anew. Copies (equal text, language
and source) are one text. To be of use to the taker, the texts come in equal parts from bands of
the taker's own score, the giver's surest of each band first; and the giver's score has to differ
from the mere share of the class, so a view that tells nothing of a label hands nothing over. A
round that raises the loss on the calibration rows is undone, and the label exchanges no more. The
calibrated log odds of both views are added, less the prior that both contain.

Every label column is learned in the same way: ``quality`` and ``toxic``.

Fitting uses a bounded sample of the labelled rows, about ``labelled`` drawn by a hash of the id,
and the rows exchanged. The unlabelled side is every document without a label, in each round;
a ``pool`` can be named to draw only about so many. Scoring covers every row and whole texts, and
no text is shuffled but those exchanged.

Defined results: a null text is empty; null metadata is a value of its own; labels that are null
or of unknown documents are left out, of several labels of a document the smallest counts; with
labels of less than two classes every score is the share of ones (0.5 without any); repeated
rows are scored each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthline.llm.common import in_portions, table, whole_text

DIMENSIONS = 4096
BUCKETS = 64
#: Layout numbers of the metadata view.
LAYOUT = 12
LABELLED = 4000
ROUNDS, EXCHANGED = 4, 150
#: Giver and taker of labels: the text view is 0, the metadata view 1.
EXCHANGES = (0, 1), (1, 0)
TARGETS = ("quality", "toxic")
#: A giver's score that is sure enough, and how far its log odds have to be from the prior's.
_SAFE, _TELLING = 0.9, 1.0
#: Ends of the bands of the taker's score.
BANDS = (0.1, 0.35, 0.65, 0.9)
#: Learning rate and penalty of the text view and of the metadata view.
_FITTING = (0.5, 1e-5), (0.05, 1e-3)


def text_view(text: str) -> np.ndarray:
    """Counts of hashed byte bigrams and trigrams."""
    codes = np.frombuffer(f" {text} ".encode(), dtype=np.uint8).astype(np.uint32)
    pairs = codes[:-1] << 8 | codes[1:]
    triples = pairs[:-1] << 8 | codes[2:] | np.uint32(1 << 24)
    grams = np.concatenate([pairs, triples]) * np.uint32(2654435761)
    return np.bincount(grams >> np.uint32(20), minlength=DIMENSIONS)


def metadata_view(text: str, lang: str | None, source: str | None) -> np.ndarray:
    """Layout numbers, then one place each for the hashed language and source."""
    size = max(1, len(text))
    words, lines = text.split(), text.split("\n")
    letters = sum(map(str.isalpha, words)) if words else 0
    held = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256)
    numbers = [
        np.log1p(len(text)), np.log1p(len(words)), np.log1p(len(lines)),
        letters / max(1, len(words)), held[65:91].sum() / size, held[48:58].sum() / size,
        (held[33:48].sum() + held[58:65].sum() + held[91:97].sum() + held[123:127].sum()) / size,
        held[10] / size, len(text) / max(1, len(words)), len(text) / len(lines),
        len(set(words)) / max(1, len(words)), len(set(lines)) / len(lines),
    ]
    places = np.zeros(2 * BUCKETS)
    places[crc32(repr(lang).encode()) % BUCKETS] = 1
    places[BUCKETS + crc32(repr(source).encode()) % BUCKETS] = 1
    return np.concatenate([numbers, places])


class Logistic:
    """L2-regularised logistic regression on prepared rows, fitted by full gradients (Adam)."""

    def __init__(self, rate: float, penalty: float, steps: int = 80):
        self.rate, self.penalty, self.steps = rate, penalty, steps

    def fit(self, x: np.ndarray, labels: np.ndarray) -> Logistic:
        weight = np.zeros(x.shape[1], np.float32)
        share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
        bias = float(np.log(share / (1 - share)))
        first, second = np.zeros(len(weight) + 1), np.zeros(len(weight) + 1)
        for step in range(1, self.steps + 1):
            error = (_sigmoid(x @ weight + bias) - labels).astype(np.float32)
            slope = np.append(x.T @ error / len(x) + self.penalty * weight, error.mean())
            first = 0.9 * first + 0.1 * slope
            second = 0.99 * second + 0.01 * slope**2
            move = self.rate * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
            weight -= move[:-1].astype(np.float32)
            bias -= float(move[-1])
        self.weight, self.bias = weight, bias
        return self

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weight + self.bias


def prepared_text(rows: np.ndarray) -> np.ndarray:
    """Logarithms of the counts, scaled to length one."""
    found = np.log1p(rows, dtype=np.float32)
    found /= np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-12)
    return found


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _platt(odds: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset that make log odds fit the labels (bounded Newton steps, smoothed targets)."""
    ones = labels.sum()
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (len(labels) - ones + 2))
    x = np.stack([odds, np.ones_like(odds)], axis=1)
    fitted = np.array([1.0, 0.0])
    for _ in range(50):
        p = _sigmoid(x @ fitted)
        curve = x.T @ (x * (p * (1 - p))[:, None]) + np.eye(2)
        step = np.linalg.solve(curve, x.T @ (p - target) + fitted - [1, 0])
        fitted = fitted - step / max(1.0, float(np.abs(step).max()) / 0.5)
    return max(1e-3, float(fitted[0])), float(fitted[1])


class Lessons:
    """The rows that the two views of one label are fitted on."""

    def __init__(
        self, texts: np.ndarray, metadata: np.ndarray, labels: np.ndarray, calibration: np.ndarray
    ):
        """``texts`` are prepared rows; ``calibration`` marks rows that are not fitted on."""
        self.views, self.labels = (texts, metadata), labels
        self.fitted, self.held = np.flatnonzero(~calibration), np.flatnonzero(calibration)
        self.given: list[list[tuple[np.ndarray, np.ndarray]]] = [[], []]

    def give(self, taker: int, rows: np.ndarray, pseudo: np.ndarray) -> None:
        """Rows of the view ``taker`` with the labels that the other view gave them."""
        self.given[taker].append((rows, pseudo))

    def take_back(self) -> None:
        """Undoes the last exchange of both views."""
        for parts in self.given:
            parts.pop()

    def of(self, view: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows of a view with their labels; one copy is made."""
        parts = self.given[view]
        known = np.concatenate([self.labels[self.fitted], *(pseudo for _, pseudo in parts)])
        own = self.views[view]
        rows = np.empty((len(known), own.shape[1]), own.dtype)
        at = len(self.fitted)
        np.take(own, self.fitted, axis=0, out=rows[:at])
        for some, _ in parts:
            rows[at : at + len(some)] = some
            at += len(some)
        return rows, known


class CoTrained:
    """The two views of one label after co-training and calibration."""

    def __init__(
        self,
        texts: np.ndarray,
        metadata: np.ndarray,
        labels: np.ndarray,
        calibration: np.ndarray,
        rounds: int = ROUNDS,
        exchanged: int = EXCHANGED,
    ):
        """``texts`` are prepared rows. ``labels`` belong to the first rows of both views, the
        other rows are unlabelled; ``calibration`` marks labelled rows that are not fitted on."""
        count = len(labels)
        lessons = Lessons(texts[:count], metadata[:count], labels, calibration)
        self.learn(lessons)
        others = texts[count:], metadata[count:]
        # By view: the unlabelled rows that it was not given yet.
        free = [np.arange(len(others[0])) for _ in others]
        for _ in range(rounds if self.models else 0):
            odds = self.calibrated(*others)
            for giver, taker in EXCHANGES:
                rows, pseudo = surest(
                    odds[giver][free[taker]], odds[taker][free[taker]], self.prior_odds(),
                    self.wanted(exchanged),
                )
                lessons.give(taker, others[taker][free[taker][rows]], pseudo)
                free[taker] = np.delete(free[taker], rows)
            if not self.improve(lessons):
                break

    @classmethod
    def taught(cls, lessons: Lessons) -> CoTrained:
        model = cls.__new__(cls)
        model.learn(lessons)
        return model

    def learn(self, lessons: Lessons) -> None:
        """Fits and calibrates both views anew."""
        labels, fitted, held = lessons.labels, lessons.fitted, lessons.held
        self.prior = float(labels.mean()) if len(labels) else 0.5
        self.models: list[Logistic] = []
        if len(set(labels[fitted])) < 2 or len(set(labels[held])) < 2:
            return
        metadata = lessons.views[1][fitted]
        self.mean = metadata.mean(axis=0)
        self.scale = np.maximum(metadata.std(axis=0), 1e-6)
        for view, (rate, penalty) in enumerate(_FITTING):
            rows, known = lessons.of(view)
            if view:
                rows = self._prepared_metadata(rows)
            self.models.append(Logistic(rate, penalty).fit(rows, known))
        odds = self.view_odds(*(view[held] for view in lessons.views))
        self.scales = [_platt(o, labels[held]) for o in odds]

    def improve(self, lessons: Lessons) -> bool:
        """Learns from what was given last; undone if the loss on the calibration rows rises."""
        before, loss = dict(vars(self)), self.loss(lessons)
        self.learn(lessons)
        if self.loss(lessons) <= loss:
            return True
        vars(self).clear()
        vars(self).update(before)
        lessons.take_back()
        return False

    def loss(self, lessons: Lessons) -> float:
        """Mean log loss of the combined score on the calibration rows."""
        held, truth = lessons.held, lessons.labels[lessons.held]
        score = np.clip(self.score(*(view[held] for view in lessons.views))[0], 1e-6, 1 - 1e-6)
        return float(-np.mean(truth * np.log(score) + (1 - truth) * np.log(1 - score)))

    def calibrated(self, texts: np.ndarray, metadata: np.ndarray) -> list[np.ndarray]:
        """Calibrated log odds of the text view and of the metadata view."""
        odds = self.view_odds(texts, metadata)
        return [slope * o + offset for o, (slope, offset) in zip(odds, self.scales)]

    def prior_odds(self) -> float:
        prior = np.clip(self.prior, 1e-3, 1 - 1e-3)
        return float(np.log(prior / (1 - prior)))

    def view_odds(self, texts: np.ndarray, metadata: np.ndarray) -> list[np.ndarray]:
        """Log odds of the text view and of the metadata view, not calibrated."""
        views = texts, self._prepared_metadata(metadata)
        return [m.log_odds(view) for m, view in zip(self.models, views)]

    def wanted(self, exchanged: int) -> tuple[int, int]:
        """How many zeros and ones a view gives in a round: the classes' proportion."""
        ones = int(round(exchanged * self.prior))
        return exchanged - ones, ones

    def _prepared_metadata(self, rows: np.ndarray) -> np.ndarray:
        return ((rows - self.mean) / self.scale).astype(np.float32)

    def score(self, texts: np.ndarray, metadata: np.ndarray) -> tuple[np.ndarray, ...]:
        """Calibrated scores of both views together, the text view and the metadata view."""
        if not self.models:
            same = np.full(len(texts), self.prior)
            return same, same, same
        a, b = self.calibrated(texts, metadata)
        return _sigmoid(a + b - self.prior_odds()), _sigmoid(a), _sigmoid(b)


def graded(
    given: np.ndarray, taken: np.ndarray, prior: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Label (1, 0, or -1 where the giver is not sure), band of the taker's score, and sureness.

    All three arguments are calibrated log odds: of the giver, of the taker, and of the prior.
    """
    safe = np.log(_SAFE / (1 - _SAFE))
    label = np.full(len(given), -1)
    label[(given >= safe) & (given - prior >= _TELLING)] = 1
    label[(given <= -safe) & (prior - given >= _TELLING)] = 0
    return label, np.searchsorted(BANDS, _sigmoid(taken)), np.abs(given)


def quota(wanted: int) -> int:
    """How many texts of a class come from one band."""
    return -(-wanted // (len(BANDS) + 1))


def surest(
    given: np.ndarray, taken: np.ndarray, prior: float, wanted: tuple[int, int]
) -> tuple[np.ndarray, np.ndarray]:
    """Places of the surest texts of each class and band, and the labels given to them."""
    label, band, sure = graded(given, taken, prior)
    order = np.argsort(-sure, kind="stable")
    rows = [
        order[(label[order] == one) & (band[order] == b)][: quota(wanted[one])]
        for one in (1, 0) for b in range(len(BANDS) + 1)
    ]
    places = np.concatenate(rows)
    return places, label[places].astype(float)


def _drawn(salt: str, share: float) -> Column:
    return F.pmod(F.xxhash64("doc_id", F.lit(salt)), F.lit(1 << 30)) < int(min(1.0, share) * (1 << 30))


def _views(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Prepared text rows and metadata rows."""
    texts = [np.frombuffer(t, "<u4") for t in rows["text_view"]]
    meta = [np.frombuffer(m, "<f8") for m in rows["metadata_view"]]
    return (
        prepared_text(np.array(texts, dtype="<u4").reshape(-1, DIMENSIONS)),
        np.array(meta, dtype="<f8").reshape(-1, LAYOUT + 2 * BUCKETS),
    )


def _both_views() -> Column:
    @F.pandas_udf("text_view binary, metadata_view binary")
    def views(text: pd.Series, lang: pd.Series, source: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({
            "text_view": [text_view(t).astype("<u4").tobytes() for t in text],
            "metadata_view": [
                metadata_view(*r).astype("<f8").tobytes() for r in zip(text, lang, source)
            ],
        })

    return views(whole_text(), "lang", "source").alias("views")


def _content() -> Column:
    """One number for all that both views see of a document."""
    columns = [whole_text()]
    for name in ("lang", "source"):
        columns += [F.col(name), F.col(name).isNull()]
    return F.xxhash64(*columns).alias("content")


def _all_odds(docs: DataFrame, models: dict[str, CoTrained]) -> DataFrame:
    """doc_id, content and the calibrated log odds of both views of every model, of every row."""
    names = [f"odds_{k}" for k in range(2 * len(models))]

    @F.pandas_udf(", ".join(f"{n} double" for n in names))
    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, parts = list(zip(*batch)), [np.zeros((0, len(names)))]
            for first in range(0, len(rows), 256):
                some = rows[first : first + 256]
                text = prepared_text(np.array([text_view(r[0]) for r in some]))
                meta = np.array([metadata_view(*r) for r in some])
                odds = [o for model in models.values() for o in model.calibrated(text, meta)]
                parts.append(np.stack(odds, axis=1))
            yield pd.DataFrame(np.concatenate(parts), columns=names)

    found = docs.select(
        "doc_id", _content(), run(whole_text(), "lang", "source").alias("found")
    )
    return found.select("doc_id", "content", "found.*")


def _surest_contents(
    unlabelled: DataFrame, models: dict[str, CoTrained], exchanged: int, had: dict
) -> dict[tuple[str, int], tuple[np.ndarray, np.ndarray]]:
    """By target and taker: the contents that the other view is surest of among all rows of
    ``unlabelled``, without those the taker ``had``, and the labels given to them.

    Copies are one row. Each task passes on its surest rows of each band, and of these the surest
    of all tasks are taken in Spark: the driver gets no more rows than are exchanged.
    """
    slots = [
        (k, (target, taker), models[target], 2 * i + giver, 2 * i + taker)
        for k, (i, target, giver, taker) in enumerate(
            (i, t, giver, taker) for i, t in enumerate(models) for giver, taker in EXCHANGES
        )
    ]
    most = quota(exchanged)

    def tops(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = None
        for batch in batches:
            parts = [best]
            for slot, key, model, giver, taker in slots:
                given, taken = batch[f"odds_{giver}"], batch[f"odds_{taker}"]
                label, band, sure = graded(
                    given.to_numpy(), taken.to_numpy(), model.prior_odds()
                )
                part = pd.DataFrame({
                    "slot": slot, "label": label, "band": band, "content": batch["content"],
                    "sure": sure,
                })
                parts.append(part[(label >= 0) & ~part["content"].isin(had[key])])
            rows = pd.concat([p for p in parts if p is not None])
            rows = rows.sort_values(["sure", "content"], ascending=[False, True])
            best = rows.groupby(["slot", "label", "band"]).head(most)
        if best is not None:
            yield from in_portions(best)

    odds = [c for c in unlabelled.columns if c.startswith("odds_")]
    distinct = unlabelled.groupBy("content").agg(*(F.first(c).alias(c) for c in odds))
    held = distinct.mapInPandas(tops, "slot int, label int, band int, content long, sure double")
    best_first = Window.partitionBy("slot", "label", "band").orderBy(F.desc("sure"), "content")
    allowed = F.lit(0)
    for slot, _, model, *_ in slots:
        for one, wanted in enumerate(model.wanted(exchanged)):
            own = (F.col("slot") == slot) & (F.col("label") == one)
            allowed = F.when(own, quota(wanted)).otherwise(allowed)
    found = (
        held.withColumn("place", F.row_number().over(best_first))
        .where((F.col("place") <= most) & (F.col("place") <= allowed)).toPandas()
    )
    chosen = {}
    for slot, key, *_ in slots:
        rows = found[found["slot"] == slot].sort_values("content")
        chosen[key] = rows["content"].to_numpy(np.int64), rows["label"].to_numpy(float)
    return chosen


def _views_of(docs: DataFrame, contents: np.ndarray) -> tuple[dict[int, int], tuple]:
    """Places of the contents among the rows, and the rows of both views; copies are one row."""
    spark = docs.sparkSession
    wanted = spark.createDataFrame(pd.DataFrame({"content": contents}), "content long")
    rows = (
        docs.select(_content(), F.struct(whole_text().alias("text"), "lang", "source").alias("row"))
        .join(F.broadcast(wanted), "content", "left_semi")
        .groupBy("content").agg(F.first("row").alias("row")).select("content", "row.*")
        .select("content", _both_views()).select("content", "views.*").toPandas()
    )
    return {c: i for i, c in enumerate(rows["content"])}, _views(rows)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    targets=TARGETS,
    labelled: int = LABELLED,
    pool: int | None = None,
    rounds: int = ROUNDS,
    exchanged: int = EXCHANGED,
) -> dict[str, CoTrained]:
    """One co-trained pair of views for each label column."""
    known = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        *(F.min(t).cast("double").alias(t) for t in targets)
    )
    taken = known.where(_drawn("labelled", labelled / max(1, known.count())))
    columns = docs.select("doc_id", "text", "lang", "source")
    # At most about ``labelled`` rows are broadcast.
    rows = columns.join(F.broadcast(taken), "doc_id").select("doc_id", _both_views(), *targets)
    rows = rows.select("doc_id", "views.*", *targets).toPandas().sort_values("doc_id")

    texts, metadata = _views(rows)
    calibration = np.array([crc32(str(i).encode()) % 5 == 0 for i in rows["doc_id"]], dtype=bool)
    lessons = {}
    for target in targets:
        answer = rows[target].to_numpy(float)
        usable = np.flatnonzero(~np.isnan(answer))
        # All rows are usable as a rule: then nothing is copied.
        every = slice(None) if len(usable) == len(answer) else usable
        lessons[target] = Lessons(texts[every], metadata[every], answer[every], calibration[every])
    del rows
    models = {t: CoTrained.taught(lesson) for t, lesson in lessons.items()}
    learning = {t: m for t, m in models.items() if m.models}
    if pool is not None:
        columns = columns.where(_drawn("pool", pool / max(1, docs.count())))
    had = {(t, taker): np.zeros(0, np.int64) for t in learning for _, taker in EXCHANGES}
    for _ in range(rounds):
        if not learning:
            break
        unlabelled = _all_odds(columns, learning).join(known.select("doc_id"), "doc_id", "left_anti")
        chosen = _surest_contents(unlabelled, learning, exchanged, had)
        places, views = _views_of(columns, np.unique(np.concatenate([c for c, _ in chosen.values()])))
        for (target, taker), (contents, pseudo) in chosen.items():
            at = np.array([places[c] for c in contents.tolist()], dtype=int)
            lessons[target].give(taker, views[taker][at], pseudo)
            had[target, taker] = np.r_[had[target, taker], contents]
        learning = {t: m for t, m in learning.items() if m.improve(lessons[t])}
    return models


def scores(docs: DataFrame, models: dict[str, CoTrained]) -> DataFrame:
    """doc_id and, by label, the score of both views together and of each."""
    names = [f"{t}{part}" for t in models for part in ("", "_by_text", "_by_metadata")]

    @F.pandas_udf(", ".join(f"{n} double" for n in names))
    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = []
            rows = list(zip(*batch))
            for first in range(0, len(rows), 256):
                some = rows[first : first + 256]
                text = prepared_text(np.array([text_view(r[0]) for r in some]))
                meta = np.array([metadata_view(*r) for r in some])
                columns = []
                for model in models.values():
                    columns += model.score(text, meta)
                parts.append(np.stack(columns, axis=1))
            found = np.concatenate(parts) if parts else np.zeros((0, len(names)))
            yield pd.DataFrame(found, columns=names)

    return docs.select("doc_id", run(whole_text(), "lang", "source").alias("found")).select(
        "doc_id", "found.*"
    )


def op6_cotraining(spark, sf_dir: str) -> DataFrame:
    """Quality and toxicity of every document, and whether to keep it."""
    documents = table(spark, sf_dir, "documents")
    found = scores(documents, fit(documents, table(spark, sf_dir, "labels")))
    return found.withColumn("keep", (F.col("quality") >= 0.5) & (F.col("toxic") < 0.5))
