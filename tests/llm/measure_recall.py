"""python tests/llm/measure_recall.py [N]: recall of the embedding forest against brute force.

Clusters are planted at cosines just above the threshold, the hardest there are;
check_h's own embeddings, where they are installed, are measured too.
"""

import os
import sys

import numpy as np
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
from ledgerly.llm import embedding_forest  # noqa: E402


def planted(n: int, size: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of which every fifth has a partner at a cosine from 0.93 to 0.95."""
    rng = np.random.default_rng(13)
    x = rng.standard_normal((n, size))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for i in range(0, n - 1, 5):
        side = rng.standard_normal(size)
        side -= (side @ x[i]) * x[i]
        c = rng.uniform(0.9305, 0.95)
        x[i + 1] = c * x[i] + np.sqrt(1 - c * c) * side / np.linalg.norm(side)
    return x, np.zeros(n, int)


def recall(spark: SparkSession, df, x: np.ndarray, label: np.ndarray) -> tuple[int, int]:
    true, u = 0, x / np.linalg.norm(x, axis=1, keepdims=True)
    for own in np.unique(label):
        v = u[label == own]
        true += sum(int((v[i : i + 1000] @ v.T >= 0.93).sum()) for i in range(0, len(v), 1000)) - len(v)
    return embedding_forest.near_duplicates(df).agg(F.sum("n_links")).first()[0] or 0, true


if __name__ == "__main__":
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 40_000
    spark = SparkSession.builder.master("local[8]").config("spark.driver.memory", "8g").config("spark.sql.shuffle.partitions", "16").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    x, label = planted(n)
    df = spark.createDataFrame([(i, e.tolist(), 0) for i, e in enumerate(x)], "vec_id long, embedding array<double>, label int")
    found, true = recall(spark, df, x, label)
    print(f"planted at 0.93 to 0.95, {n} vectors of one label: {found} of {true}, recall {found / true:.4f}")
    if os.path.isdir("/root/testdata/check_h"):
        df = spark.read.parquet("/root/testdata/check_h/embeddings.parquet")
        fine = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v)) & F.exists("embedding", lambda v: v != 0) & F.col("label").isNotNull()
        rows = df.where(F.coalesce(fine, F.lit(False))).collect()
        by = {}
        for r in rows:
            by.setdefault(len(r["embedding"]), []).append(r)
        wide = max(by, key=lambda k: len(by[k]))
        x, label = np.array([r["embedding"] for r in by[wide]], float), np.array([r["label"] for r in by[wide]])
        found, true = recall(spark, spark.createDataFrame(by[wide], df.schema), x, label)
        print(f"check_h, {len(x)} vectors: {found} of {true}, recall {found / max(1, true):.4f}")
