"""A frozen projection of vectors, and a store that encodes only texts it does not have."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.pipeline import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.store import Store

STORE = "text string, vector array<double>"


def fit_projection(df: DataFrame, k: int = 16) -> PipelineModel:
    """Centring and PCA, fitted once; the model is saved and only applied later."""
    vectors = df.select(array_to_vector(F.col("embedding").cast("array<double>")).alias("raw"))
    return Pipeline(stages=[StandardScaler(inputCol="raw", outputCol="centred", withMean=True, withStd=False), PCA(k=k, inputCol="centred", outputCol="projected")]).fit(vectors)


def save_projection(model: PipelineModel, path: str) -> None:
    """Only a refit on request replaces a saved model."""
    model.write().overwrite().save(path)


def load_projection(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def apply_projection(df: DataFrame, model: PipelineModel, key: str, order: str | None = None) -> DataFrame:
    """(key, projected); with an order column the last row of each key counts."""
    if order is not None:
        df = df.groupBy(key).agg(F.max_by("embedding", order).alias("embedding"))
    out = model.transform(df.select(key, array_to_vector(F.col("embedding").cast("array<double>")).alias("raw")))
    return out.select(key, vector_to_array("projected").alias("projected"))


def hashing_encoder(texts: pd.Series, dim: int = 64) -> list[list[float]]:
    """Default encoder: signed word hashing, unit length."""
    out = np.zeros((len(texts), dim))
    for i, t in enumerate(texts):
        for w in (t or "").split():
            h = zlib.crc32(w.encode())
            out[i, h % dim] += 1 if h & 0x10000 else -1
    return (out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)).tolist()


def text_store(spark: SparkSession, path: str, buckets: int = 64) -> Store:
    """Encoded texts by bucket of the text's hash. The more buckets, the fewer parts a small batch has to look at."""
    return Store(spark, path, STORE, key="text", day=None, buckets=buckets)


def append_new(spark: SparkSession, texts: DataFrame, path: str, encoder: Callable[[pd.Series], list[list[float]]] | None = None, buckets: int = 64) -> DataFrame:
    """Encode the texts that the store at ``path`` lacks, append them to it, and read the store. Parts that cannot hold one of the texts are not read."""
    store = text_store(spark, path, buckets)
    new = texts.select("text").where("text is not null").distinct()
    store.change(append=embed_new(new, store.read(store.parts_of(new)), encoder or hashing_encoder))
    store.compact()
    return store.read()


def embed_new(texts: DataFrame, store: DataFrame, encoder: Callable[[pd.Series], list[list[float]]] = hashing_encoder) -> DataFrame:
    """(text, vector) of the distinct texts that the store does not have."""
    fresh = texts.select("text").distinct().join(store.select("text"), "text", "left_anti")

    def run(batches):
        for p in batches:
            yield pd.DataFrame({"text": p["text"], "vector": encoder(p["text"])})

    return fresh.mapInPandas(run, STORE)
