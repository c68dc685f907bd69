"""Toxicity by a chain of linear classifiers.

Categories are predicted one after the other, and the log-odds of the earlier ones are
features of the later ones.  The later models learn from predictions that models of other
folds made (out of fold), so that they see earlier categories as uncertain as they will be.
The labelled table names the categories: here ``low_quality`` (quality = 0) and then
``toxic``, the only two that it has.

Defined results: a null text is empty.  Without labelled rows every probability is a half
and nothing is toxic.  Repeated rows are scored each.  An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm import linear

FOLDS = 5
LIMIT = 0.5


def default_categories() -> dict[str, Column]:
    return {"low_quality": 1 - F.col("quality"), "toxic": F.col("toxic")}


def _odds(p: np.ndarray) -> np.ndarray:
    return np.log(np.clip(p, 1e-6, 1 - 1e-6) / np.clip(1 - p, 1e-6, 1 - 1e-6))


def chain(data: linear.Sample) -> list[linear.Linear]:
    """A model for each column of the labels, in their order."""
    n, models = len(data.labels), []
    earlier, fold = np.zeros((n, 0)), np.arange(n) % FOLDS
    for k in range(data.labels.shape[1]):
        label = data.labels[:, k]
        models.append(linear.fit(data, label, 2, earlier))
        if k + 1 == data.labels.shape[1]:
            break
        odds = np.zeros(n)
        for f in range(FOLDS):
            model = linear.fit(data, label, 2, earlier, fold != f)
            out = linear.softmax(model.scores(data.at, data.value, data.row, n, earlier))[:, 1]
            odds[fold == f] = _odds(out[fold == f])
        earlier = np.column_stack([earlier, odds])
    return models


def scored(docs: DataFrame, labels: DataFrame, categories: dict[str, Column] | None = None,
           doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, p_<category> for each category, toxic (the last one reaches LIMIT)."""
    categories = categories or default_categories()
    known = F.array(*[c.cast("int") for c in categories.values()])
    known = F.when(~F.exists(known, lambda x: x.isNull()), known)
    data = linear.sample(docs, labels, known, doc_id, text)
    models, width = chain(data) if len(data.labels) else [], len(categories)

    def score(at, value, row, rows):  # noqa: ANN001, ANN202
        if not models:
            return np.full((rows, width), 0.5)
        earlier = np.zeros((rows, 0))
        out = []
        for model in models:
            out.append(linear.softmax(model.scores(at, value, row, rows, earlier))[:, 1])
            earlier = np.column_stack([earlier, _odds(out[-1])])
        return np.column_stack(out)

    wanted = np.unique(np.concatenate([m.buckets for m in models] or [np.zeros(0, np.int64)]))
    found = linear.scored(docs, [doc_id], text, width, wanted, score, "toxicity")
    last = len(categories) - 1
    return found.select(
        F.col(doc_id).alias("doc_id"),
        *[F.get("p", k).alias(f"p_{name}") for k, name in enumerate(categories)],
        (F.get("p", last) > LIMIT).alias("toxic"),
    )
