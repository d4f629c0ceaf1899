"""Embedding near-duplicates by PCA-ordered tiles.

Equal vectors are one row with a weight. Unit vectors are rotated to the
eigenvectors of their second-moment matrix, largest first (a rotation keeps every
cosine), sorted by their first coordinate and written as tiles of ``TILE`` rows.
Unit vectors of cosine t are at most sqrt(2-2t) apart, in every coordinate; pairs
of tiles whose boxes over the leading coordinates are further apart than that are
never read. A pair of tiles accumulates products of ``STEP`` leading dimensions at
a time; what is missing is at most the product of the two suffix norms, and a pair
of vectors is given up as soon as that can't lift it to the threshold. Cosines next
to the threshold are computed anew from the input vectors.

Tiles are files in the shared folder, read where they are needed, so no vector is
shuffled per tile pair. A tile pair gives sums of links per vector and a spanning
forest, at most one row a vector, never its links. The comparison is exact; what
the bounds can't prune is quadratic in the number of tiles.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components link with nothing. Vectors of different lengths don't link. Repeated
rows are vectors of their own, linked to each other. Rows with a null id get a
component but never name one. Other columns are ignored.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklens.llm.common import materialize
from clicklens.llm.components import connected_components
from clicklens.llm.files import make_folder, read_file, write_file
from clicklens.session import scratch_path

TILE = 2048
STEP = 16
BOX = 8  # leading coordinates of a tile's box
# Cosines this close to the threshold are computed anew; far above the rotation's rounding.
NEAR = 1e-9


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _groups(vectors: DataFrame) -> DataFrame:
    """Adds the key (length and two hashes) of valid vectors; null otherwise."""
    e = F.col("embedding")
    valid = (F.size(e) > 0) & F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(e, lambda v: v != 0)
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").withColumn(
        "key", F.when(F.coalesce(valid, F.lit(False)), F.struct(F.size(e).alias("dim"), F.xxhash64(e).alias("h1"), F.xxhash64(F.lit(1), e).alias("h2"))))


def _rotation(distinct: DataFrame, dim: int) -> np.ndarray:
    """Eigenvectors of the second-moment matrix, as columns: dim x dim sums reach the driver."""
    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((dim, dim))
        for part in batches:
            if len(part):
                u = unit(np.stack(part["embedding"].to_numpy()))
                total += u.T @ u
        yield pd.DataFrame({"cell": np.arange(dim * dim), "s": total.ravel()})

    cells = distinct.select("embedding").mapInPandas(moments, "cell int, s double").groupBy("cell").agg(F.sum("s").alias("s"))
    sums = np.zeros(dim * dim)
    for row in cells.collect():
        sums[row.cell] = row.s
    return np.linalg.eigh(sums.reshape(dim, dim))[1][:, ::-1]


def _write_tiles(folder: str, rotation: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        base, count, held = TaskContext.get().partitionId() << 24, 0, []

        def write(part: pd.DataFrame) -> pd.DataFrame:
            nonlocal count
            x = np.stack(part["embedding"].to_numpy())
            y = (unit(x) @ rotation)[:, :BOX]
            tile, path = base + count, f"{folder}/tile-{uuid.uuid4().hex}"
            count += 1
            out = io.BytesIO()
            np.savez(out, x=x, weight=part["n"].to_numpy())
            write_file(path, out.getvalue())
            return pd.DataFrame({"tile": tile, "file": path, "h1": part["h1"].to_numpy(), "h2": part["h2"].to_numpy(),
                                 "gid": (np.int64(tile) << 16) + np.arange(len(part)),
                                 "low": [y.min(axis=0).tolist()] * len(part), "high": [y.max(axis=0).tolist()] * len(part)})

        for part in batches:
            held.append(part)
            while sum(map(len, held)) >= TILE:
                part = pd.concat(held)
                yield write(part.iloc[:TILE])
                held = [part.iloc[TILE:]]
        if sum(map(len, held)):
            yield write(pd.concat(held))

    return run


def links(a: np.ndarray, b: np.ndarray, rotation: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (row of a, row of b) whose cosine is at least the threshold."""
    ya, yb = unit(a) @ rotation, unit(b) @ rotation
    dim = ya.shape[1]
    rest = [np.sqrt(np.cumsum((y * y)[:, ::-1], axis=1)[:, ::-1]) for y in (ya, yb)]  # norm from a dimension on
    dense, at, dot = np.zeros((len(a), len(b))), None, None
    for d in range(0, dim, STEP):
        e = min(d + STEP, dim)
        ra, rb = (r[:, e] if e < dim else np.zeros(len(r)) for r in rest)
        if at is None:
            dense += ya[:, d:e] @ yb[:, d:e].T
            alive = dense + ra[:, None] * rb >= threshold - NEAR
            if alive.mean() < 0.05 or e == dim:
                at = np.nonzero(alive)
                dot = dense[at]
            continue
        dot = dot + np.einsum("ij,ij->i", ya[at[0], d:e], yb[at[1], d:e])
        keep = dot + ra[at[0]] * rb[at[1]] >= threshold - NEAR
        at, dot = (at[0][keep], at[1][keep]), dot[keep]
    near = np.flatnonzero(np.abs(dot - threshold) <= NEAR)
    for i in near:
        x, y = (v.astype(np.float64) / np.abs(v).max() for v in (a[at[0][i]], b[at[1][i]]))
        dot[i] = (x @ y) / (np.sqrt(x @ x) * np.sqrt(y @ y))
    keep = dot >= threshold
    return at[0][keep], at[1][keep]


def forest(src: np.ndarray, dst: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) of the nodes of some links, roots left out."""
    nodes, at = np.unique(np.concatenate([src, dst]), return_inverse=True)
    i, j = at[:len(src)], at[len(src):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[i], label[j])
        now = label.copy()
        np.minimum.at(now, i, low)
        np.minimum.at(now, j, low)
        now = now[now]
        if (now == label).all():
            break
        label = now
    own = label != np.arange(len(nodes))
    return nodes[own], nodes[label[own]]


def _compare(rotation: np.ndarray, threshold: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, dict] = {}

        def tile(path: str, keep: str) -> dict:
            if path not in held:
                for old in [p for p in held if p != keep]:
                    del held[old]
                z = np.load(io.BytesIO(read_file(path)))
                held[path] = {"x": z["x"], "weight": z["weight"]}
            return held[path]

        for part in batches:
            for row in part.itertuples(index=False):
                a = tile(row.file_a, row.file_b)
                b = tile(row.file_b, row.file_a)
                i, j = links(a["x"], b["x"], rotation, threshold)
                if row.a == row.b:
                    i, j = i[i < j], j[i < j]
                ga, gb = (np.int64(row.a) << 16) + i, (np.int64(row.b) << 16) + j
                if not len(ga):
                    continue
                own, at = np.unique(np.concatenate([ga, gb]), return_inverse=True)
                n = np.bincount(at, np.concatenate([b["weight"][j], a["weight"][i]])).astype(np.int64)
                node, root = forest(ga, gb)
                yield pd.DataFrame({"kind": np.repeat(np.int32([0, 1]), [len(own), len(node)]),
                                    "x": np.concatenate([own, node]), "y": np.concatenate([n, root])})

    return run


def near_duplicates(vectors: DataFrame, threshold: float = 0.95) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row for each vector."""
    spark = vectors.sparkSession
    rows = _groups(vectors)
    distinct = materialize(
        rows.where("key IS NOT NULL").groupBy("key").agg(F.first("embedding").alias("embedding"), F.count(F.lit(1)).alias("n"),
                                                         F.min("vec_id").alias("first_id")).select("key.*", "embedding", "n", "first_id"),
        "embed-distinct")
    dims = [r.dim for r in distinct.select("dim").distinct().collect()]
    sums = [_one_length(spark, distinct.where(F.col("dim") == d), d, threshold) for d in sorted(dims)]
    if not sums:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    found = sums[0]
    for s in sums[1:]:
        found = found.unionByName(s)
    flat = rows.select("vec_id", "key.dim", "key.h1", "key.h2")
    out = flat.join(found, ["dim", "h1", "h2"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("dim").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _one_length(spark, distinct: DataFrame, dim: int, threshold: float) -> DataFrame:
    """(dim, h1, h2, n_links, component_id) of the distinct vectors of one length."""
    rotation = _rotation(distinct, dim)
    first = [float(v) for v in rotation[:, 0]]
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, v: s + v.cast("double") * v))
    lead = F.aggregate(F.zip_with("embedding", F.array(*map(F.lit, first)), lambda v, r: v * r), F.lit(0.0), lambda s, v: s + v) / norm
    folder = scratch_path(spark, "tiles")
    make_folder(folder)
    tiles = materialize(
        distinct.select("embedding", "n", "h1", "h2", lead.alias("lead")).repartitionByRange("lead").sortWithinPartitions("lead")
        .mapInPandas(_write_tiles(folder, rotation), "tile long, file string, h1 long, h2 long, gid long, low array<double>, high array<double>"),
        "embed-tiles")
    boxes = tiles.where("gid % 65536 = 0").select("tile", "file", "low", "high")
    reach = float(np.sqrt(2 - 2 * threshold)) + 1e-6
    cells = boxes.select("*", F.floor(F.col("low")[0] / reach).alias("c0"), F.floor(F.col("high")[0] / reach).alias("c1"))
    left = cells.select(F.col("tile").alias("a"), F.col("file").alias("file_a"), F.col("low").alias("low_a"), F.col("high").alias("high_a"),
                        F.explode(F.sequence("c0", F.col("c1") + 1)).alias("cell"))
    right = cells.select(F.col("tile").alias("b"), F.col("file").alias("file_b"), F.col("low").alias("low_b"), F.col("high").alias("high_b"),
                         F.explode(F.sequence("c0", F.col("c1") + 1)).alias("cell"))
    low = F.zip_with("low_a", "low_b", lambda p, q: F.greatest(p, q))
    high = F.zip_with("high_a", "high_b", lambda p, q: F.least(p, q))
    gap = F.aggregate(F.zip_with(low, high, lambda p, q: F.greatest(p - q, F.lit(0.0))), F.lit(0.0), lambda s, v: s + v * v)
    pairs = materialize(left.join(right, "cell").where((F.col("a") <= F.col("b")) & (gap <= reach * reach))
                        .select("a", "b", "file_a", "file_b").distinct(), "embed-pairs")
    tasks = max(1, min(pairs.count(), 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    found = materialize(pairs.repartition(tasks, "a", "b").sortWithinPartitions("a", "b")
                        .mapInPandas(_compare(rotation, threshold), "kind int, x long, y long"), "embed-links")
    comps = connected_components(found.where("kind = 1").select(F.col("x").alias("src"), F.col("y").alias("dst")))
    sums = found.where("kind = 0").groupBy(F.col("x").alias("gid")).agg(F.sum("y").alias("others"))
    groups = (tiles.select("h1", "h2", "gid").join(distinct.select("dim", "h1", "h2", "n", "first_id"), ["h1", "h2"])
              .join(sums, "gid", "left").join(comps, F.col("gid") == F.col("node"), "left")
              .withColumn("root", F.coalesce("component", "gid")))
    named = groups.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return groups.join(named, "root").select("dim", "h1", "h2", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id")


ORACLE = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (SELECT vec_id, e FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_inner_product(e, e) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
          WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
comp AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN comp ON comp.a = vec_id LEFT JOIN degree ON degree.a = vec_id
"""
