"""Preparation of features and learner as one stored pipeline.

Codes, medians, means and deviations are fitted on the training rows alone and kept as stages, so a
pipeline that is loaded in another session prepares and scores new rows as it did at first. All stages
are expressions or MLlib transformers that Spark writes itself; no Python code is stored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model, PipelineModel
from pyspark.ml.feature import SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelworks.operators.features import exact_medians

#: What an absent category counts as, and the code of one that the training rows do not have.
UNKNOWN, UNSEEN = "unknown", -1.0


def _with(columns: dict[str, str]) -> SQLTransformer:
    """A stage that adds columns by SQL expressions; ``__THIS__`` is the frame at hand."""
    added = ", ".join(f"{expression} AS `{name}`" for name, expression in columns.items())
    return SQLTransformer(statement=f"SELECT *, {added} FROM __THIS__")


def fit_preparation(
    train: DataFrame, coded: Sequence[str], numeric: Sequence[str], name: str = "features"
) -> PipelineModel:
    """Stages that add the code of each ``coded`` column (``<column>_enc``) and the vector ``name``.

    Codes are alphabetical; a null is the category "unknown", and a category that ``train`` does not hold has code -1.
    A null number becomes the exact median of ``train`` (0 if it holds none), then numbers are centred and
    divided by the population deviation. The vector holds the codes and then the numbers.
    """
    stages: list = []
    if coded:
        filled = _with({f"_{c}": f"coalesce(CAST(`{c}` AS STRING), '{UNKNOWN}')" for c in coded})
        indexer = StringIndexer(
            inputCols=[f"_{c}" for c in coded],
            outputCols=[f"_{c}_index" for c in coded],
            stringOrderType="alphabetAsc",
            handleInvalid="keep",
        ).fit(filled.transform(train))
        sizes = [len(labels) for labels in indexer.labelsArray]
        codes = _with({f"{c}_enc": f"if(`_{c}_index` = {n}, {UNSEEN}D, `_{c}_index`)" for c, n in zip(coded, sizes)})
        stages += [filled, indexer, codes]
    if numeric:
        # one number per column passes the driver
        medians = {r["column"]: r["median"] for r in exact_medians(train, numeric).collect()}
        value = {c: f"coalesce(CAST(`{c}` AS DOUBLE), {medians.get(c, 0.0)!r}D)" for c in numeric}
        found = train.agg(*(f(F.expr(value[c])).alias(f"{k}{i}") for i, c in enumerate(numeric) for k, f in (("m", F.avg), ("s", F.stddev_pop)))).first()
        scaled = {}
        for i, c in enumerate(numeric):
            mean, deviation = found[f"m{i}"] or 0.0, found[f"s{i}"] or 1.0
            scaled[f"_{c}_scaled"] = f"({value[c]} - {mean!r}D) / {deviation!r}D"
        stages.append(_with(scaled))
    inputs = [*(f"{c}_enc" for c in coded), *(f"_{c}_scaled" for c in numeric)]
    kept = [*(f"_{c}" for c in coded), *(f"_{c}_index" for c in coded), *(f"_{c}_scaled" for c in numeric)]
    dropped = ", ".join(f"`{c}`" for c in kept)
    stages.append(VectorAssembler(inputCols=inputs, outputCol=name))
    stages.append(SQLTransformer(statement=f"SELECT * EXCEPT ({dropped}) FROM __THIS__"))
    return PipelineModel(stages)


def with_learner(preparation: PipelineModel, model: Model) -> PipelineModel:
    """The preparation and a model fitted on its vectors as one pipeline."""
    return PipelineModel([*preparation.stages, model])


def feature_names(pipeline: PipelineModel) -> list[str]:
    """The features of a stored pipeline, in the order of its vector."""
    assembler = next(s for s in pipeline.stages if isinstance(s, VectorAssembler))
    return [c.removeprefix("_").removesuffix("_scaled") if c.endswith("_scaled") else c for c in assembler.getInputCols()]
