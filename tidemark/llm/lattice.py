"""Near-duplicate embeddings by lattice hashing; every link found is verified by its cosine.

Vectors are compared when their labels are equal. Each of ``TABLES`` tables projects the unit
vectors to eight random directions, shifts them and decodes them to points of the lattice E8
(the nearer of the best points of its two cosets). A vector is indexed in each table's cell and
looks into the ``PROBES`` nearest cells, its own included; vectors near each other that lie on
different sides of a cell's border meet in one of these.

In a cell, all that look in are compared to those that are indexed there, by matrix products in
double precision. A pair can meet in several cells: it counts only where it meets first (by
table, then at the smaller vector's cell), which is worked out again from the vectors. So the
number of links of each vector comes from sums, and no table of pairs is made; for the
components each cell gives one edge for each linked vector. A cell with more than ``CELL`` rows
is cut into chunks, and every two chunks are compared by a task of their own.

Equal vectors of a label are one class: compared once, and counted as often as there are.

Recall is measured in the tests against all pairs (0.99 or more for cosines at the limit with
the settings below). The index covers every row.

Defined results: a vector that is null, empty or zero or holds null or non-finite components, or
has no label, is linked with nothing: no links, its own component, kept; vectors of unlike
lengths are not linked; a null id takes its component's smallest id, is kept only if there is
none; repeated rows are vectors of their own, linked with each other; an empty table gives no
rows; extra columns are not read.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, col
from tidemark.llm.components import components
from tidemark.llm.words import mixed

#: Tables; cells that a vector looks into; cell size (larger: finer cells); rows of a cell that one task compares.
TABLES, PROBES, SCALE, CELL = 6, 4, 0.7, 2048

#: Rows of a task's cells together.
BUCKET_ROWS = 20_000

LEAST = 0.93

_PAIRS = [(i, j) for i in range(8) for j in range(i + 1, 8)]
#: Changes of a rounded point to its neighbours: none, one coordinate, or two.
_FLIPS = np.array([[0] * 8] + [[int(k == i) for k in range(8)] for i in range(8)] + [[int(k in p) for k in range(8)] for p in _PAIRS])
_FLIPPED = _FLIPS.sum(1)


@lru_cache(maxsize=32)
def directions(size: int, table: int) -> tuple[np.ndarray, np.ndarray]:
    """A table's random projection and shift, for vectors of a size: the same everywhere."""
    random = np.random.default_rng([77, size, table])
    return random.standard_normal((size, 8)) * SCALE, random.uniform(0, 2, 8)


def nearest(points: np.ndarray, count: int) -> np.ndarray:
    """For each point, the ``count`` nearest E8 points among the neighbours of both roundings, in
    order of distance, doubled (E8 has halves): (n, count, 8)."""
    found, far = [], []
    for shift in (0.0, 0.5):
        at = points - shift
        base = np.rint(at)
        off = at - base
        cost = (off**2).sum(1)[:, None] + (1 - 2 * np.abs(off)) @ _FLIPS.T
        even = (base.sum(1).astype(np.int64) & 1) == 0
        cost[(_FLIPPED % 2 == 0)[None, :] != even[:, None]] = np.inf
        found.append((base, np.where(off >= 0, 1, -1)))
        far.append(cost)
    far = np.concatenate(far, 1)
    best = np.argsort(far, 1, kind="stable")[:, :count]
    coset, flip = best // len(_FLIPS), _FLIPS[best % len(_FLIPS)]
    base = np.where(coset[:, :, None] == 0, found[0][0][:, None, :], found[1][0][:, None, :] + 0.5)
    step = np.where(coset[:, :, None] == 0, found[0][1][:, None, :], found[1][1][:, None, :])
    return (2 * (base + flip * step)).astype(np.int64)


def cells(unit: np.ndarray, label: np.ndarray, table: int, probes: int = PROBES) -> np.ndarray:
    """Keys of the cells that each vector looks into, its own first: (n, probes)."""
    matrix, shift = directions(unit.shape[1], table)
    points = nearest(unit @ matrix + shift, probes).astype(np.uint64)
    key = mixed(label.astype(np.uint64) * np.uint64(1000003) + np.uint64(table * 7919 + unit.shape[1]))[:, None]
    for k in range(8):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + points[:, :, k])
    return key


def unit_rows(vectors: list[bytes], wide: np.ndarray) -> np.ndarray:
    """Stored vectors of one size as unit rows in double precision."""
    data = np.stack([np.frombuffer(v, np.float64 if w else np.float32) for v, w in zip(vectors, wide)]).astype(np.float64)
    return data / np.linalg.norm(data, axis=1)[:, None]


def _stored(batches):
    """(vec_id, label, vector) to the same with the vector's bytes, null if it cannot be compared."""
    for batch in batches:
        wide = pa.types.is_float64(batch.column(2).type.value_type)
        out = []
        for vector, label in zip(batch.column(2), batch.column(1)):
            x = None
            if vector.is_valid and label.is_valid and vector.values.null_count == 0:
                x = vector.values.to_numpy(zero_copy_only=False)
                # the norm in double precision must be a positive number
                size = np.linalg.norm(x.astype(np.float64))
                x = x.tobytes() if len(x) and np.isfinite(size) and size > 0 else None
            out.append(x)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary()), pa.array([wide] * batch.num_rows)],
                                         names=["vec_id", "label", "vector", "wide"])


def by_size(frame: pd.DataFrame):
    """Rows with vectors of one size at a time."""
    size = frame["vector"].map(len) // np.where(frame["wide"], 8, 4)
    for _, rows in frame.groupby(size, sort=True):
        yield rows


def _deal(frames):
    for frame in frames:
        for rows in by_size(frame):
            unit, label = unit_rows(rows["vector"], rows["wide"].to_numpy()), rows["label"].to_numpy()
            for table in range(TABLES):
                keys = cells(unit, label, table)
                for p in range(PROBES):
                    yield pd.DataFrame({"cell": keys[:, p].view(np.int64), "place": np.int32(table), "own": p == 0, "k": rows["k"].to_numpy(),
                                        "label": label, "times": rows["times"].to_numpy(), "vector": rows["vector"].to_numpy(), "wide": rows["wide"].to_numpy()})


DEALT = "cell bigint, place int, own boolean, k bigint, label bigint, times bigint, vector binary, wide boolean"


def _pairs(unit: np.ndarray, own: np.ndarray, k: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Links in one cell: positions (x, y), x indexed there, each pair once. Indexed rows first."""
    left, right, indexed = [], [], int(own.sum())
    for i in range(0, indexed, 512):
        x, y = np.nonzero(unit[i : min(i + 512, indexed)] @ unit.T >= least)
        x += i
        keep = (x != y) & (~own[y] | (k[x] < k[y]))
        left.append(x[keep])
        right.append(y[keep])
    none = [np.zeros(0, np.int64)]
    return np.concatenate(left or none), np.concatenate(right or none)


def _compare(frame: pd.DataFrame, least: float) -> pd.DataFrame:
    """The cells of one bucket: rows (k, links) and (k, to) for the links that count in them."""
    out = []
    for rows in by_size(frame):
        rows = rows.sort_values(["cell", "place", "lo", "hi", "own", "k"], ascending=[True, True, True, True, False, True])
        k, own, label, place = (rows[c].to_numpy() for c in ("k", "own", "label", "place"))
        unit = unit_rows(rows["vector"], rows["wide"].to_numpy())
        task = rows[["cell", "place", "lo", "hi"]].to_numpy()
        edges = np.append(np.flatnonzero(np.append(True, (task[1:] != task[:-1]).any(1))), len(rows))
        left, right = [], []
        for i, j in zip(edges[:-1], edges[1:]):
            if j - i > 1 and own[i]:
                x, y = _pairs(unit[i:j], own[i:j], k[i:j], least)
                left.append(x + i)
                right.append(y + i)
        if not left:
            continue
        x, y = np.concatenate(left), np.concatenate(right)
        part, both = rows["part"].to_numpy(), (rows["lo"] != rows["hi"]).to_numpy()
        apart = ~both[x] | (part[x] != part[y])  # two chunks: pairs across; one: pairs inside
        x, y = x[apart], y[apart]
        # Positions in the rows that have links, and the cells these look into, table by table.
        some, at = np.unique(np.concatenate([x, y]), return_inverse=True)
        at_x, at_y = at[: len(x)], at[len(x) :]
        before = np.zeros(len(x), bool)
        for table in range(TABLES if len(x) else 0):
            keys = cells(unit[some], label[some], table)
            x_in_y, y_in_x = (keys[at_y] == keys[at_x, :1]).any(1), (keys[at_x] == keys[at_y, :1]).any(1)
            before |= (place[x] > table) & (x_in_y | y_in_x)
            # In the same table, y looks in from its own cell: the pair counts at the smaller one's.
            before |= (place[x] == table) & ~own[y] & (k[y] < k[x]) & y_in_x
        x, y = x[~before], y[~before]
        times = rows["times"].to_numpy()
        out.append(pd.DataFrame({"k": np.concatenate([k[x], k[y]]), "links": np.concatenate([times[y], times[x]])})
                   .groupby("k", as_index=False).sum().assign(to=pd.NA))
        # The smallest vector that each one hangs together with by these links.
        low = k.copy()
        while True:
            last = low.copy()
            np.minimum.at(low, x, low[y])
            np.minimum.at(low, y, low[x])
            if (low == last).all():
                break
        moved = np.flatnonzero(low != k)
        out.append(pd.DataFrame({"k": k[moved], "links": 0, "to": low[moved]}))
    if not out:
        return pd.DataFrame({"k": pd.Series([], dtype="int64"), "links": pd.Series([], dtype="int64"), "to": pd.Series([], dtype="Int64")})
    return pd.concat([x.astype({"k": "int64", "links": "int64", "to": "Int64"}) for x in out], ignore_index=True)


def near_vectors(df: DataFrame, least: float = LEAST, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept) for every row of ``df``."""
    scratch = Scratch(df.sparkSession, "lattice")
    kind = dict(df.dtypes)[vec_id]
    rows = df.select(col(vec_id).alias("vec_id"), col(label).cast("bigint").alias("label"), col(vector).alias("vector"))
    rows = rows.mapInArrow(_stored, f"vec_id {kind}, label bigint, vector binary, wide boolean")
    rows = scratch.save(rows.withColumn("k", F.when(F.col("vector").isNotNull(), F.xxhash64("label", "vector"))))
    classes = scratch.save(rows.where("k is not null").groupBy("k").agg(
        F.first("label").alias("label"), F.count("*").alias("times"), F.first("vector").alias("vector"), F.first("wide").alias("wide")))
    dealt = classes.mapInPandas(_deal, DEALT)

    # Cells by their rows: those with one row, or none indexed, have no pairs; large ones are cut.
    sums = (classes.mapInPandas(lambda frames: (x[["cell", "place", "own"]] for x in _deal(frames)), "cell bigint, place int, own boolean")
            .groupBy("cell", "place").agg(F.count("*").alias("rows"), F.max("own").alias("indexed")).where("rows > 1 and indexed")
            .select("cell", "place", F.ceil(F.col("rows") / CELL).cast("int").alias("chunks")))
    dealt = dealt.join(sums, ["cell", "place"])
    part = F.pmod(F.xxhash64("k"), F.col("chunks")).cast("int")
    dealt = (dealt.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
             .withColumn("lo", F.least("part", "other")).withColumn("hi", F.greatest("part", "other")).drop("other"))
    buckets = max(8, classes.count() * TABLES * PROBES // BUCKET_ROWS)
    dealt = dealt.withColumn("bucket", F.pmod(F.xxhash64("cell", "place", "lo", "hi"), F.lit(buckets)))
    found = scratch.save(dealt.groupBy("bucket").applyInPandas(lambda x: _compare(x, least), "k bigint, links bigint, to bigint"))

    links = found.groupBy("k").agg(F.sum("links").alias("others"))
    parts = components(found.where("to is not null").select("k", "to"), scratch)
    joined = (rows.select("vec_id", "k").join(links, "k", "left").join(parts.withColumnRenamed("node", "k"), "k", "left")
              .join(classes.select("k", "times"), "k", "left").withColumn("group", F.coalesce("component", "k")))
    named = joined.where("group is not null").groupBy("group").agg(F.min("vec_id").alias("least"))
    out = joined.join(named, "group", "left").select(
        "vec_id", F.when(F.col("k").isNull(), F.lit(0)).otherwise(F.coalesce("others", F.lit(0)) + F.col("times") - 1).cast("bigint").alias("n_links"),
        F.when(F.col("k").isNull(), F.col("vec_id")).otherwise(F.col("least")).cast("bigint").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull()))


def op10_lattice_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
