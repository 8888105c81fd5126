"""Made documents for the tests."""

import random

from pyspark.sql import types as T

#: The columns of ``documents`` and names that the operators use themselves.
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        *(T.StructField(c, T.StringType()) for c in ("id", "row", "text_hash", "label", "key", "n", "token", "kept", "_id", "_hash", "entities x")),
    ]
)


def make_docs(spark, rows, parts=3):
    """Documents from (doc_id, text[, lang, source]); the other columns hold noise."""
    full = [(*r, *(None,) * (4 - len(r)), *("x",) * 11) for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


def words(seed, n):
    rng = random.Random(seed)
    return [rng.choice("abcdefghijklmnop") + "".join(rng.choice("aeioulnrst") for _ in range(5)) for _ in range(n)]
