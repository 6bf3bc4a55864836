"""Quality classifier by co-training of a text view and a page-metadata view.

Two logistic models are fitted on a bounded sample of labelled rows: one sees only the text's content (hashed words and
measures of its characters and lines), the other only its language, source and length. In each round both models look at
every document without a label, in the executors, and each labels those that it is surest of for the other to learn from:
``per_round`` a class, found by a distributed top-k over the whole table. Held-out labelled rows calibrate both views, and
other held-out rows combine them. Every document is scored, in place, in one pass over the table; of texts, only features
are written for the rounds, and the driver holds the labelled sample and what the views exchange, both of bounded size.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra.llm.common import discard, staged, table, text_bytes

#: Labelled rows that are used at most, chosen by a seeded hash of the id.
MAX_LABELLED = 12_000
#: Rounds, rows of each class that a view labels for the other in a round, and how sure it must be.
ROUNDS, PER_ROUND, SURE = 4, 300, 0.97
THRESHOLD = 0.5
LANG_SLOTS, SOURCE_SLOTS, WORD_SLOTS = 8, 32, 64

_SIGNS = np.frombuffer(b"#*$%&|<>", np.uint8)
_UPPER, _DIGIT = slice(65, 91), slice(48, 58)


MEASURES = 12
TEXT_SIZE = MEASURES + WORD_SLOTS


def text_features(raw: bytes) -> list[float]:
    """Measures of a UTF-8 text, then how much of it each slot of hashed words takes; an empty text gives zeros."""
    if not raw:
        return [0.0] * TEXT_SIZE
    count, size = np.bincount(np.frombuffer(raw, np.uint8), minlength=256), len(raw)
    words = raw.split()
    n = max(1, len(words))
    lines = [x for x in raw.split(b"\n") if x]
    in_words, times = sum(map(len, words)), Counter(words)
    slots = np.bincount([crc32(w.lower()) % WORD_SLOTS for w in times], list(times.values()), minlength=WORD_SLOTS) if times else np.zeros(WORD_SLOTS)
    return [
        np.log1p(len(words)), in_words / n, np.log1p(100 * count[_SIGNS].sum() / n), np.log1p(100 * count[33] / n),
        np.log1p(100 * count[_UPPER].sum() / size), np.log1p(100 * count[_DIGIT].sum() / size), len(times) / n ** 0.8,
        len(times) / n, len(set(lines)) / max(1, len(lines)), np.log1p(100 * (count[44] + count[46]) / n),
        count[128:].sum() / size, np.log1p(len(lines) / n), *np.sqrt(slots / n).tolist(),
    ]


def meta_features(lang: str | None, source: str | None, n_chars: float | None) -> list[float]:
    """Hashed one-hot language and source, and the length; nulls have slots of their own."""
    out = [0.0] * (LANG_SLOTS + SOURCE_SLOTS + 2)
    out[xxhash.xxh32_intdigest(repr(lang), 1) % LANG_SLOTS] = 1.0
    out[LANG_SLOTS + xxhash.xxh32_intdigest(repr(source), 2) % SOURCE_SLOTS] = 1.0
    if n_chars is not None and n_chars == n_chars:
        out[-2] = float(np.log1p(max(0.0, float(n_chars))))
        out[-1] = out[-2] ** 2 / 10
    return out


@dataclass
class View:
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    slope: float = 1.0
    offset: float = 0.0
    squares: int = 0

    def design(self, x: np.ndarray) -> np.ndarray:
        """A constant, all features, and the squares of the first few."""
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.hstack([np.ones((len(x), 1)), z, z[:, : self.squares] ** 2])

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self.slope * (self.design(x) @ self.weight) + self.offset


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _logistic(a: np.ndarray, y: np.ndarray, ridge: float) -> np.ndarray:
    """Newton's method for the ridge-penalised logistic likelihood; the first column is not penalised."""
    w, eye = np.zeros(a.shape[1]), np.eye(a.shape[1])
    eye[0, 0] = 1e-6
    for _ in range(30):
        p = _sigmoid(a @ w)
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge * eye, a.T @ (p - y) + ridge * eye @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _view(x: np.ndarray, y: np.ndarray, squares: int) -> View:
    view = View(x.mean(0), np.maximum(x.std(0), 1e-3), np.zeros(0), squares=squares)
    view.weight = _logistic(view.design(x), y, 1.0)
    return view


@dataclass
class CoTrained:
    text: View | None
    meta: View | None
    blend: np.ndarray
    prior: float = 1.0

    def scores(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(combined, text view's, metadata view's) calibrated probability of good quality."""
        if self.text is None or self.meta is None:
            return (np.full(len(text), self.prior),) * 3
        a, b = self.text.logit(text), self.meta.logit(meta)
        return _sigmoid(np.column_stack([np.ones(len(a)), a, b]) @ self.blend), _sigmoid(a), _sigmoid(b)


#: Squares that each view's model sees beside the features themselves.
SQUARES = (MEASURES, 0)

#: (confident rows of both views) of one round: asks for the surest rows under two models.
Sure = Callable[[View, View], list[tuple[int, int, float, list[float], list[float]]]]


def co_train(text: np.ndarray, meta: np.ndarray, y: np.ndarray, part: np.ndarray, sure: Sure | None = None, rounds: int = ROUNDS) -> CoTrained:
    """Fit both views on the rows of part 2 and more; part 0 calibrates them and part 1 combines them.

    sure(text view, metadata view) gives the round's surest rows as (view, row number, label, text, metadata features), the
    surest first and no row of an earlier round; copies are one row. Without both classes in each part, scores are the mean label.
    """
    if len(y) == 0 or any(len(set(y[x])) < 2 for x in (part == 0, part == 1, part > 1)):
        return CoTrained(None, None, np.zeros(3), float(y.mean()) if len(y) else 1.0)
    fits = part > 1
    sets = [[text[fits], y[fits]], [meta[fits], y[fits]]]
    views = [_view(x, t, s) for (x, t), s in zip(sets, SQUARES, strict=True)]
    for _ in range(rounds if sure else 0):
        given, taken = sure(*views), set()
        for me in (0, 1):
            rows = [r for r in given if r[0] == me and r[1] not in taken]
            taken |= {r[1] for r in rows}
            if rows:
                other = 1 - me
                sets[other] = [np.vstack([sets[other][0], [r[4 if other else 3] for r in rows]]), np.r_[sets[other][1], [r[2] for r in rows]]]
        if not taken:
            break
        views = [_view(x, t, s) for (x, t), s in zip(sets, SQUARES, strict=True)]
    logits = []
    for view, x in zip(views, (text, meta), strict=True):
        raw = view.logit(x[part == 0])
        view.offset, view.slope = _logistic(np.column_stack([np.ones(len(raw)), raw]), y[part == 0], 0.5)
        logits.append(view.logit(x[part == 1]))
    blend = _logistic(np.column_stack([np.ones(len(logits[0])), *logits]), y[part == 1], 0.5)
    return CoTrained(views[0], views[1], blend, float(y.mean()))


def _surest(pool: DataFrame, per_round: int, at_least: float) -> Sure:
    """pool(row, tf, mf) as staged: the surest rows of each view and class that no earlier round has taken."""
    spark, taken = pool.sparkSession, []

    def ask(text: View, meta: View) -> list[tuple]:
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                f = f.drop_duplicates("row")
                for me, view, col in ((0, text, "tf"), (1, meta, "mf")):
                    p = np.round(_sigmoid(view.logit(np.array(f[col].tolist(), float).reshape(len(f), -1))), 9)
                    for label, s in ((1.0, p), (0.0, 1 - p)):
                        pick = np.flatnonzero(s >= at_least)
                        pick = pick[np.lexsort((f["row"].to_numpy()[pick], -s[pick]))[:per_round]]
                        yield pd.DataFrame({"me": me, "label": label, "sure": s[pick], **{c: f[c].to_numpy()[pick] for c in ("row", "tf", "mf")}})

        free = pool.join(F.broadcast(spark.createDataFrame([(x,) for x in taken], "row long")), "row", "left_anti") if taken else pool
        found = free.mapInPandas(run, "me int, label double, sure double, row long, tf array<float>, mf array<float>")
        place = F.row_number().over(Window.partitionBy("me", "label").orderBy(F.col("sure").desc(), "row"))
        best = found.dropDuplicates(["me", "label", "row"]).withColumn("place", place).where(F.col("place") <= per_round).collect()
        best = sorted(best, key=lambda r: (r["me"], r["label"], r["place"]))
        taken.extend({r["row"] for r in best})
        return [(r["me"], r["row"], r["label"], r["tf"], r["mf"]) for r in best]

    return ask


def _featured(docs: DataFrame, cols: dict[str, str]) -> list[Column]:
    """The columns that a document's features come from, under fixed names."""
    chars = F.col(cols["n_chars"]).cast("double") if cols["n_chars"] in docs.columns else F.lit(None).cast("double")
    lang, source = (F.col(cols[c]).cast("string") if cols[c] in docs.columns else F.lit(None).cast("string") for c in ("lang", "source"))
    return [text_bytes(cols["text"]).alias("t"), lang.alias("lang"), source.alias("source"), chars.alias("n_chars")]


COLUMNS = {"id": "doc_id", "text": "text", "lang": "lang", "source": "source", "n_chars": "n_chars"}


def _features(docs: DataFrame) -> DataFrame:
    """docs(..., t, lang, source, n_chars) -> the other columns, tf and mf."""
    kept = [c for c in docs.columns if c not in ("t", "lang", "source", "n_chars")]
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in docs.schema if f.name in kept] + ["tf array<float>", "mf array<float>"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            t = [text_features(x) for x in f["t"]]
            m = [meta_features(*x) for x in zip(f["lang"], f["source"], f["n_chars"], strict=True)]
            yield f[kept].assign(tf=t, mf=m)

    return docs.mapInPandas(run, schema)


def fit(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", seed: int = 5, columns: dict[str, str] = COLUMNS,
    limit: int = MAX_LABELLED, rounds: int = ROUNDS, per_round: int = PER_ROUND, sure: float = SURE,
) -> CoTrained:
    """Train on at most ``limit`` labelled documents of docs, chosen by a seeded hash of the id, and on all others' features.

    A document labelled more than once counts by the mean of its labels; null labels and ids are ignored. Of texts that
    share a labelled id, the one with the least hash is used; rows without a label are all looked at in every round.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy(F.col("doc_id").cast("long").alias("id")).agg((F.avg(label_col) >= 0.5).cast("double").alias("y"))
    some = known.orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(limit)
    own = docs.select(F.col(columns["id"]).cast("long").alias("id"), *_featured(docs, columns))
    picked = _features(own.withColumn("tie", F.xxhash64("t", "lang", "source", "n_chars")).join(F.broadcast(some), "id"))
    one = picked.groupBy("id").agg(F.min_by(F.struct("y", "tf", "mf"), "tie").alias("x"))
    rows = one.select("id", "x.*").toPandas().sort_values("id", ignore_index=True)
    if rows.empty:
        return CoTrained(None, None, np.zeros(3))
    tf, mf, y = np.array(rows["tf"].tolist(), float), np.array(rows["mf"].tolist(), float), rows["y"].to_numpy(float)
    part = np.array([xxhash.xxh32_intdigest(str(i), seed) % 6 for i in rows["id"]])
    if len(set(y)) < 2:
        return co_train(tf, mf, y, part)
    # Features before the join: no text is shuffled.
    number = F.xxhash64("id", "t", "lang", "source", "n_chars")
    pool = staged(_features(own.withColumn("row", number)).join(known.select("id"), "id", "left_anti").drop("id"), "pool")
    model = co_train(tf, mf, y, part, _surest(pool, per_round, sure), rounds)
    discard(pool)
    return model


def scored(docs: DataFrame, model: CoTrained, columns: dict[str, str] = COLUMNS, name: str = "quality") -> DataFrame:
    """docs plus a struct column ``name`` (score, text_score, meta_score); one pass, no shuffle, every row scored."""

    @F.pandas_udf("score double, text_score double, meta_score double")
    def score(t: pd.Series, lang: pd.Series, source: pd.Series, n_chars: pd.Series) -> pd.DataFrame:
        tf = np.array([text_features(x) for x in t], float).reshape(len(t), TEXT_SIZE)
        mf = np.array([meta_features(*x) for x in zip(lang, source, n_chars, strict=True)], float)
        # The last bits of a matrix product depend on the batch's shape.
        found = [np.round(x, 9) for x in model.scores(tf, mf)]
        return pd.DataFrame(dict(zip(("score", "text_score", "meta_score"), found, strict=True)))

    return docs.withColumn(name, score(*_featured(docs, columns)))


def classify(docs: DataFrame, labels: DataFrame, label_col: str = "quality", columns: dict[str, str] = COLUMNS) -> DataFrame:
    """(doc_id, score, text_score, meta_score, accepted), one row per input row.

    accepted is score >= THRESHOLD. Null texts count as empty, null metadata as values of their own; repeated rows are
    scored alike. Without labels of both classes all rows get the mean label, or 1 without any label. An empty table
    gives an empty result; other columns are ignored.
    """
    out = scored(docs.select(*{columns[c]: 0 for c in columns if columns[c] in docs.columns}), fit(docs, labels, label_col, columns=columns), columns)
    return out.select(F.col(columns["id"]).alias("doc_id"), "quality.*", (F.col("quality.score") >= THRESHOLD).alias("accepted"))


def accepted(docs: DataFrame, labels: DataFrame, label_col: str = "quality", columns: dict[str, str] = COLUMNS) -> DataFrame:
    """The rows of docs that the classifier accepts, with their columns; repeated rows and nulls as in ``classify``."""
    name = "__quality"
    return scored(docs, fit(docs, labels, label_col, columns=columns), columns, name).where(F.col(f"{name}.score") >= THRESHOLD).drop(name)


def op9_quality_classifier(spark, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
