"""Projection of standardised rows by a table of loadings, and a check of the loadings against the data.

A loading table is (feature, component, weight), features and components being whole numbers from 0 on. Rows come
sparse, as (entity, feature, value) cells with 0 where there is none, or dense, as one array per row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Components whose sums one row of the sparse product carries.
BLOCK = 32
#: Weights that may be broadcast as one matrix (8 bytes each).
MOST_WEIGHTS = 8_000_000
#: Columns of the largest matrix that the model check holds on the driver (8 bytes a pair of columns).
MOST_FEATURES = 8_000


def cell_statistics(cells: DataFrame, entities: int) -> DataFrame:
    """(feature, mean, spread) over all ``entities``, those without the feature at 0; the spread is the sample deviation."""
    sums = cells.groupBy("feature").agg(F.sum("value").alias("s"), F.sum(F.col("value") * F.col("value")).alias("ss"))
    n = float(entities)
    variance = (F.col("ss") - F.col("s") * F.col("s") / n) / max(n - 1, 1.0)
    return sums.select("feature", (F.col("s") / n).alias("mean"), F.sqrt(F.greatest(variance, F.lit(0.0))).alias("spread"))


def project_cells(cells: DataFrame, loadings: DataFrame, statistics: DataFrame, places: int = 3) -> DataFrame:
    """(entity, component, score) of every entity that has a cell of a loaded feature, as a distributed sparse matrix product.

    A standardised cell is ``value / spread - mean / spread``. The second term is there for every feature, present
    or not, so its product with the loadings is one number per component; only the first is multiplied cell by
    cell, and no row is ever filled up with zeros. Weights are joined in blocks of ``BLOCK`` components, whose
    sums are combined before the shuffle. A feature that all entities have is a hot key of the join; the weights are the
    small side, which Spark broadcasts or against which it splits the hot partitions. Features with spread 0 count nothing.
    """
    flat = F.when(F.col("spread") > 0, F.col("weight") / F.col("spread")).otherwise(0.0)
    scaled = loadings.join(statistics, "feature").withColumn("_w", flat).withColumn("_block", F.expr(f"component div {BLOCK}"))
    at = F.col("component") % BLOCK
    columns = [F.coalesce(F.sum(F.when(at == i, F.col("_w"))), F.lit(0.0)) for i in range(BLOCK)]
    blocks = scaled.groupBy("feature", "_block").agg(F.array(*columns).alias("_ws"))
    sums = cells.join(blocks, "feature").groupBy("entity", "_block").agg(
        F.array(*[F.sum(F.col("value") * F.col("_ws")[i]) for i in range(BLOCK)]).alias("_sums")
    )
    shifts = scaled.groupBy("_block", "component").agg(F.sum(F.col("mean") * F.col("_w")).alias("shift"))
    per_block = shifts.groupBy("_block").agg(F.collect_list(F.struct("component", "shift")).alias("_shifts"))
    rows = sums.join(per_block, "_block").select("entity", "_sums", F.explode("_shifts").alias("_s"))
    score = F.element_at("_sums", (F.col("_s.component") % BLOCK + 1).cast("int")) - F.col("_s.shift")
    return rows.select("entity", F.col("_s.component").alias("component"), F.round(score, places).alias("score"))


def loading_matrix(loadings: DataFrame, features: int) -> np.ndarray:
    """The table as a matrix (component, feature) on the driver; more than ``MOST_WEIGHTS`` weights are refused."""
    n = loadings.count()
    if n > MOST_WEIGHTS:
        raise ValueError(f"{n} weights are too many for one matrix; use project_cells")
    table = loadings.select("feature", "component", F.col("weight").cast("double")).toArrow()
    feature, component = (table[c].to_numpy().astype(np.int64) for c in ("feature", "component"))
    if n and (feature.max() >= features or feature.min() < 0):
        raise ValueError(f"loadings of features outside 0 to {features - 1}")
    out = np.zeros((int(component.max(initial=-1)) + 1, features))
    out[component, feature] = table["weight"].to_numpy()
    return out


def project_rows(df: DataFrame, vector: str, features: int, loadings: DataFrame, name: str = "projected", places: int = 3) -> DataFrame:
    """``df`` with the products of a dense vector and each component: one matrix product per batch of rows.

    A null vector, or one of another length than ``features``, gives null.
    """
    weights = df.sparkSession.sparkContext.broadcast(loading_matrix(loadings, features))
    columns = [c for c in df.columns if c != name]
    at = columns.index(vector)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix = weights.value
        for batch in batches:
            column = batch.column(at)
            sizes = column.value_lengths().fill_null(-1).to_numpy()
            good = np.flatnonzero(sizes == features)
            flat = column.take(pa.array(good)).flatten().to_numpy(zero_copy_only=False).astype(float)
            found = np.round(flat.reshape(len(good), features) @ matrix.T, places) + 0.0
            sizes = np.zeros(len(column), np.int64)
            sizes[good] = matrix.shape[0]
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            mask = np.ones(len(column), bool)
            mask[good] = False
            out = pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.reshape(-1)), mask=pa.array(mask))
            yield pa.RecordBatch.from_arrays([*batch.columns, out], [*batch.schema.names, name])

    schema = T.StructType([*[df.schema[c] for c in columns], T.StructField(name, T.ArrayType(T.DoubleType()))])
    return df.select(*columns).mapInArrow(multiply, schema)


def correlations(df: DataFrame, vector: str, features: int) -> np.ndarray:
    """The Gramian of the standardised rows over n - 1, from one aggregate; columns without spread are 0 throughout."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Correlation

    if features > MOST_FEATURES:
        raise ValueError(f"{features} columns are too many for one matrix on the driver")
    rows = df.where(F.size(vector) == features).select(array_to_vector(F.transform(vector, lambda x: x.cast("double"))).alias("v"))
    found = np.nan_to_num(Correlation.corr(rows, "v").first()[0].toArray())
    spread = df.agg(F.array(*[F.expr(f"coalesce(stddev_samp(cast(`{vector}`[{i}] as double)), 0D)") for i in range(features)]).alias("s")).first()["s"]
    found[np.array(spread) == 0] = 0
    found[:, np.array(spread) == 0] = 0
    return found


def check_loadings(df: DataFrame, vector: str, features: int, loadings: DataFrame) -> DataFrame:
    """One row per component, of the loadings held against the standardised rows of ``df``.

    ``variance``: of the projected rows; ``share``: of the total variance; ``norm``: of the loadings;
    ``overlap``: the largest product with another component (0 for orthogonal loadings); ``residual``: how far the
    component is from an eigenvector, as the length of ``C w - (w'Cw / w'w) w``.
    """
    spark = df.sparkSession
    c, w = correlations(df, vector, features), loading_matrix(loadings, features)
    moved, products = w @ c, w @ w.T
    norms, variance = np.diag(products), np.einsum("ij,ij->i", moved, w)
    others = np.abs(products - np.diag(norms))
    rate = np.divide(variance, norms, out=np.zeros_like(variance), where=norms > 0)
    residual = np.linalg.norm(moved - rate[:, None] * w, axis=1)
    total = float(np.trace(c)) or 1.0
    rows = [(i, float(variance[i]), float(variance[i]) / total, float(np.sqrt(norms[i])), float(others[i].max()), float(residual[i])) for i in range(len(w))]
    return spark.createDataFrame(rows, "component long, variance double, share double, norm double, overlap double, residual double")


def principal_loadings(df: DataFrame, vector: str, components: int) -> DataFrame:
    """(feature, component, weight): the principal components of standardised rows, fitted by Spark ML; the largest
    weight of each component is positive."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector

    model = PCA(k=components, inputCol="_v", outputCol="_o").fit(df.select(array_to_vector(vector).alias("_v")))
    weights = model.pc.toArray()
    weights = weights * np.sign(weights[np.abs(weights).argmax(axis=0), np.arange(components)])
    rows = [(i, c, float(weights[i, c])) for i in range(len(weights)) for c in range(components)]
    return df.sparkSession.createDataFrame(rows, "feature long, component long, weight double")
