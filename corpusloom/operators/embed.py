"""Text to unit vectors."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.session import ship

DIMENSION = 384


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; zero rows stay zero."""
    norm = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    return np.divide(matrix, norm, out=np.zeros_like(matrix), where=norm > 0)


def tokens(text: Column) -> Column:
    """Runs of ASCII letters and digits, lower case; empty strings may stand at the ends."""
    return F.split(F.lower(text), "[^a-z0-9]+")


def token_code(token: str, dimension: int) -> tuple[int, float]:
    """Bucket and sign of a token, from the first nine hex digits of its md5.

    Eight digits give the bucket, the parity of the ninth gives the sign.
    """
    value = int(hashlib.md5(token.encode()).hexdigest()[:9], 16)
    return (value >> 4) % dimension, -1.0 if value % 2 else 1.0


def hash_embedding(text: Column, dimension: int = DIMENSION) -> Column:
    """Signed token counts by bucket, scaled to unit length; null for a missing text.

    Adding into a dense array is the one step without a built-in, so it is an Arrow function over
    whole batches. Every distinct token of a batch is hashed once.
    """
    ship()

    @F.arrow_udf("array<float>")
    def scatter(lists: pa.Array) -> pa.Array:
        present = lists.is_valid().to_numpy(zero_copy_only=False)
        lengths = np.where(present, np.diff(lists.offsets.to_numpy()), 0)
        words = lists.flatten().dictionary_encode()
        codes = [token_code(word, dimension) if word else (0, 0.0) for word in words.dictionary.to_pylist()]
        bucket, sign = (np.array(column) for column in zip(*codes)) if codes else (np.zeros(0, int), np.zeros(0))
        which = words.indices.to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(lists)), lengths)
        cells = np.bincount(row * dimension + bucket[which], sign[which], len(lists) * dimension)
        vectors = unit_rows(cells.reshape(len(lists), dimension))
        offsets = np.arange(len(lists) + 1, dtype=np.int32) * dimension
        return pa.ListArray.from_arrays(
            pa.array(offsets), pa.array(vectors.ravel(), pa.float32()), mask=pa.array(~present)
        )

    return scatter(tokens(text))


def embed_documents(
    df: DataFrame,
    text: str = "cleaned_text",
    dimension: int = DIMENSION,
    encoder: Callable[[], Callable[[list[str]], np.ndarray]] | None = None,
    batch_size: int = 64,
) -> DataFrame:
    """Add ``embedding`` (unit-length floats).

    ``encoder`` makes a model inside the task; the model turns a list of texts into a matrix.
    Without one, the hashing embedding is used.
    """
    if encoder is None:
        return df.withColumn("embedding", hash_embedding(F.col(text), dimension))

    ship(df.sparkSession)

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = None
        for frame in frames:
            model = model or encoder()
            texts = frame[text].tolist()
            parts = [
                unit_rows(np.asarray(model(texts[i : i + batch_size]), dtype=np.float64))
                for i in range(0, len(texts), batch_size)
            ]
            yield frame.assign(embedding=[row.astype(np.float32) for part in parts for row in part])

    schema = T.StructType([*df.schema.fields, T.StructField("embedding", T.ArrayType(T.FloatType()))])
    return df.mapInPandas(encode, schema)
