"""Near-duplicate classes by DartMinHash signatures, banding and exact verification.

Texts are weighted sets: word shingles with their number of occurrences. Hashed darts fall on
(element, weight, rank); a text keeps the darts below its elements' weights, and per coordinate
the one of least rank. Two texts agree in a coordinate with the probability of their weighted
Jaccard similarity. Only about k log k darts are thrown for a text, whatever its length.

1. Equal texts are one node, named by the MD5 of the text.
2. Nodes that agree in all rows of a band share a bucket. Each bucket links its members to the
   member with the fullest buckets (its centre) - a star, never all pairs - and the links are
   verified on the texts.
3. Buckets that still hold several components after that are joined to clouds. Their members
   are compared block by block: signatures first, then the shingles of those that may match.
   A block keeps a spanning forest of its links, so no group is written out as pairs.
4. Verified links make components; every document gets the least document id of its component.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import map_arrow, materialised, parts, strings
from tallymark.llm.components import components
from tallymark.llm.shingles import chunks, mixed, shingles, unit
from tallymark.operators.rows import fresh_rows

SHINGLE, THRESHOLD = 5, 0.8
#: 32 bands of 4 rows: a pair at the threshold is missed with probability 5e-8.
BANDS, ROWS = 32, 4
K = BANDS * ROWS
#: Pairs whose signatures agree in fewer coordinates are not verified (5.6 deviations below 0.8).
AGREEING = int(0.6 * K)
#: Members of a cloud compared at once with as many others.
BLOCK = 256


# ---- signatures ----------------------------------------------------------------------------------


def _darts(
    hashes: np.ndarray, weights: np.ndarray, limits: np.ndarray, seed: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Darts of rank below its element's limit: element index, rank, name of the dart.

    The weight axis is cut at 0, 1, 2, 4, ...; in a region of width w, ranks arrive as a Poisson
    process of rate w and weights are uniform. Everything follows from hashes of the element,
    region and arrival, so different texts see the same darts on the same element.
    """
    found = []
    low, width, level = 0.0, 1.0, 0
    there = np.arange(len(hashes))
    while len(there):
        region = mixed(hashes[there] ^ mixed(np.array([seed * 1000 + level], np.uint64)))
        at, rank, arrival = there, np.zeros(len(there)), 0
        while len(at):
            # As many arrivals at once as most of these elements need.
            many = int(np.clip(np.median(limits[at] - rank) * width + 1, 1, 64))
            numbers = np.arange(arrival, arrival + many, dtype=np.uint64)
            names = mixed(region[:, None] + mixed(numbers)[None, :])
            ranks = rank[:, None] + np.cumsum(-np.log(unit(names)) / width, axis=1)
            weight = low + width * unit(mixed(names))
            kept = (ranks < limits[at][:, None]) & (weight <= weights[at][:, None])
            i, j = np.nonzero(kept)
            found.append((at[i], ranks[i, j], names[i, j]))
            more = ranks[:, -1] < limits[at]
            at, rank, region = at[more], ranks[more, -1], region[more]
            arrival += many
        low += width
        width = max(1.0, low)
        level += 1
        there = there[weights[there] > low]
    if not found:
        return np.zeros(0, int), np.zeros(0), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def signatures(
    rows: np.ndarray, hashes: np.ndarray, weights: np.ndarray, n: int, k: int = K, seed: int = 1
) -> np.ndarray:
    """(n, k) names of the earliest darts of n weighted sets given as (row, element, weight).

    Rows without elements stay zero. Coordinates that no dart reached are tried again with a
    doubled rank limit; what was found below the old limit stays.
    """
    out = np.zeros((n, k), np.uint64)
    total = np.bincount(rows, weights, minlength=n)
    limit = np.divide(k * (np.log(k) + 2), total, out=np.zeros(n), where=total > 0)
    todo = np.flatnonzero(total > 0)
    while len(todo):
        mine = np.isin(rows, todo) if len(todo) < n else np.ones(len(rows), bool)
        r, h, w = rows[mine], hashes[mine], weights[mine]
        element, rank, name = _darts(h, w, limit[r], seed)
        coordinate = (mixed(name ^ np.uint64(0xA5A5A5A5)) % np.uint64(k)).astype(np.int64)
        cell = r[element] * k + coordinate
        order = np.lexsort((rank, cell))
        cell, name = cell[order], name[order]
        first = np.ones(len(cell), bool)
        first[1:] = cell[1:] != cell[:-1]
        out.reshape(-1)[cell[first]] = name[first]
        reached = np.bincount(cell[first] // k, minlength=n)
        todo = todo[reached[todo] < k]
        limit[todo] *= 2
    return out


def _signed(texts: list[str], size: int) -> tuple[pa.Array, pa.Array]:
    """Band keys (none without words) and 16 bits of each coordinate, of every text."""
    keys, lows, has = [], [], []
    for a, b in chunks(texts):
        rows, hashes, times = shingles(texts[a:b], size)
        names = signatures(rows, hashes, times.astype(float), b - a)
        key = np.zeros((b - a, BANDS), np.uint64)
        for row in range(ROWS):
            key = mixed(key ^ names[:, row::ROWS])
        keys.append(mixed(key ^ np.arange(BANDS, dtype=np.uint64)[None, :]).view(np.int64))
        lows.append((names & np.uint64(0xFFFF)).astype("<u2"))
        has.append(np.bincount(rows, minlength=b - a) > 0)
    has = np.concatenate(has)
    offsets = np.concatenate([[0], np.cumsum(has * BANDS)]).astype(np.int32)
    bands = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(keys)[has].ravel()))
    sketches = pa.array([x.tobytes() for low in lows for x in low], pa.binary())
    return bands, sketches


def _signature_table(docs: DataFrame, size: int) -> DataFrame:
    """node, bands, sketch of every document that has words (node: MD5 of the text)."""
    source = docs.select("id", "node", "text")
    id_type = source.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in parts(batches):
            bands, sketches = _signed(strings(batch.column(2)), size)
            arrays = [batch.column(0), batch.column(1), bands, sketches]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "node", "bands", "sketch"])

    return map_arrow(source, run, f"id {id_type}, node binary, bands array<long>, sketch binary")


# ---- verification --------------------------------------------------------------------------------


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two sorted (hashes, times)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = np.minimum(a[1][i], b[1][j]).sum()
    whole = a[1].sum() + b[1].sum() - common
    return float(common / whole) if whole else 1.0


def _verified(pairs: DataFrame, texts: DataFrame, size: int, threshold: float) -> DataFrame:
    """The (a, b) whose texts are as similar as the threshold asks."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("tb"))

    def run(batches):
        last, held = None, None
        for batch in parts(batches, 128):
            ta, tb = strings(batch.column(2)), strings(batch.column(3))
            keep = np.zeros(len(ta), bool)
            for i, (x, y) in enumerate(zip(ta, tb, strict=True)):
                if y != last:
                    last, held = y, shingles([y], size)[1:]
                keep[i] = similarity(shingles([x], size)[1:], held) >= threshold - 1e-12
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(pa.array(keep)), batch.column(1).filter(pa.array(keep))],
                ["a", "b"],
            )

    both = pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb")
    return map_arrow(both, run, "a binary, b binary")


# ---- clouds --------------------------------------------------------------------------------------


def _block_pairs(members: DataFrame) -> DataFrame:
    """Deal the members of each cloud into blocks and copy them to every pair of blocks.

    Adds block_a <= block_b and side: 0 in the first block, 1 in the second (0 where equal).
    """
    sizes = members.groupBy("cloud").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    # Written first: where the table is small, members need no shuffle by cloud to meet it.
    dealt = members.join(materialised(sizes, "dedup-cloud-sizes"), "cloud").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return dealt.withColumn("other", other).select(
        *[c for c in members.columns],
        F.least("block", "other").alias("block_a"),
        F.greatest("block", "other").alias("block_b"),
        (F.col("block") > F.col("other")).cast("int").alias("side"),
    )


def _promising(pdf: pd.DataFrame) -> pd.DataFrame:
    """Members of a block pair with a signature close to one of another component."""
    names = np.frombuffer(b"".join(pdf["sketch"]), "<u2").reshape(len(pdf), K)
    component = pd.factorize(pdf["component"])[0]
    side = pdf["side"].to_numpy()
    keep = np.zeros(len(pdf), bool)
    cross = len(set(side)) > 1
    for at in range(0, len(pdf), 64):
        part = slice(at, at + 64)
        same = np.zeros((len(names[part]), len(names)), np.int16)
        for c in range(K):
            same += names[part, c][:, None] == names[:, c][None, :]
        close = (same >= AGREEING) & (component[part][:, None] != component[None, :])
        if cross:
            close &= side[part][:, None] != side[None, :]
        keep[part] |= close.any(1)
        keep |= close.any(0)
    return pdf.loc[keep, ["cloud", "block_a", "block_b", "node", "component", "side"]]


def _forest(pdf: pd.DataFrame, size: int, threshold: float) -> pd.DataFrame:
    """Links between components inside a block pair: enough to connect what is linked."""
    rows, hashes, times = shingles(list(pdf["text"]), size)
    starts = np.searchsorted(rows, np.arange(len(pdf) + 1))
    sets = [
        (hashes[a:b], times[a:b]) for a, b in zip(starts[:-1], starts[1:], strict=True)
    ]
    totals = np.array([t.sum() for _, t in sets], float)
    root = pd.factorize(pdf["component"])[0]
    # Upper bound of what two texts share, from shingles that at least two of them have.
    kinds, inverse, uses = np.unique(hashes, return_inverse=True, return_counts=True)
    column = np.cumsum(uses > 1) - 1
    common = uses[inverse] > 1
    shared = np.zeros((len(pdf), len(pdf)), np.float32)
    width = int((uses > 1).sum())
    for low in range(0, width, 8192):
        mine = common & (column[inverse] >= low) & (column[inverse] < low + 8192)
        part = np.zeros((len(pdf), min(8192, width - low)), np.float32)
        part[rows[mine], column[inverse[mine]] - low] = np.sqrt(times[mine])
        shared += part @ part.T
    # min(x, y) <= sqrt(x * y), so this never lies below the similarity.
    bound = shared / np.maximum(totals[:, None] + totals[None, :] - shared, 1e-9)
    a, b = np.nonzero(np.triu(bound >= threshold - 1e-3, 1))
    nodes, links = pdf["node"].to_numpy(), []
    for i, j in zip(a, b, strict=True):
        if root[i] != root[j] and similarity(sets[i], sets[j]) >= threshold - 1e-12:
            links.append((nodes[i], nodes[j]))
            root[root == root[j]] = root[i]
    return pd.DataFrame(links, columns=["a", "b"])


def _cloud_links(
    members: DataFrame, labels: DataFrame, sketches: DataFrame, texts: DataFrame, size: int, threshold: float
) -> DataFrame | None:
    """Links that the stars of step 2 missed: all pairs of different components in a cloud."""
    own = labels.withColumnRenamed("component", "c")
    placed = members.join(own, "node", "left").select(
        "bucket", "node", F.coalesce("c", "node").alias("component")
    )
    mixed_ones = placed.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y"))
    open_ = mixed_ones.filter("x != y").select("bucket")
    rest = materialised(placed.join(fresh_rows(open_), "bucket"), "dedup-open")
    if rest.isEmpty():
        return None
    hubs = rest.groupBy("bucket").agg(F.min("node").alias("b"))
    grown = components(rest.join(fresh_rows(hubs), "bucket").select(F.col("node").alias("a"), "b"))
    clouds = grown.select("node", F.col("component").alias("cloud"))
    inside = rest.select("node", "component").distinct().join(clouds, "node").join(sketches, "node")
    schema = "cloud binary, block_a int, block_b int, node binary, component binary, side int"
    close = (
        _block_pairs(inside)
        .groupBy("cloud", "block_a", "block_b")
        .applyInPandas(lambda pdf: _promising(pdf), schema)
    )
    return (
        close.join(texts, "node")
        .groupBy("cloud", "block_a", "block_b")
        .applyInPandas(lambda pdf: _forest(pdf, size, threshold), "a binary, b binary")
    )


# ---- the operator --------------------------------------------------------------------------------


def _named(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    named = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    return named.withColumn("node", F.unhex(F.md5("text")))


def _node_classes(named: DataFrame, size: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(id, node) of all rows, and (node, component) of all nodes, both written."""
    signed = materialised(_signature_table(named, size), "dedup-signatures")
    # One row a node; `id` tells which document's text stands for it.
    nodes = signed.groupBy("node").agg(F.min("id").alias("id"))
    keys = ["node", "id"]
    mine = (F.col("node") == F.col("n")) & F.col("id").eqNullSafe(F.col("i"))
    chosen = nodes.select(F.col("node").alias("n"), F.col("id").alias("i"))
    single = signed.join(fresh_rows(chosen), mine).dropDuplicates(keys)
    single = materialised(single.select("node", "id", "bands", "sketch"), "dedup-nodes")

    exploded = single.select("node", F.explode("bands").alias("bucket"))
    full = exploded.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    members = materialised(exploded.join(fresh_rows(full), "bucket"), "dedup-members")
    degree = members.groupBy("node").agg(F.sum("n").alias("degree"))
    degree = materialised(degree, "dedup-degrees")
    ranked = members.join(degree, "node")
    centres = ranked.groupBy("bucket").agg(F.max(F.struct("degree", "node")).alias("top"))
    centres = centres.select("bucket", F.col("top.node").alias("b"))
    pairs = members.join(fresh_rows(centres), "bucket").filter("node != b")
    pairs = materialised(pairs.select(F.col("node").alias("a"), "b").distinct(), "dedup-pairs")

    involved = degree.select("node").join(single.select("node", "id"), "node")
    involved = involved.select(F.col("node").alias("n"), F.col("id").alias("i"))
    texts = named.join(involved, mine).dropDuplicates(keys).select("node", "text")
    texts = materialised(texts, "dedup-texts")

    links = materialised(_verified(pairs, texts, size, threshold), "dedup-links")
    labels = materialised(components(links), "dedup-labels")
    sketches = single.select("node", "sketch")
    more = _cloud_links(members.select("bucket", "node"), labels, sketches, texts, size, threshold)
    if more is not None:
        more = materialised(more, "dedup-more")
        labels = materialised(components(links.union(more)), "dedup-all-labels")
    own = labels.select(F.col("node").alias("n"), "component")
    classes = nodes.select("node").join(own, F.col("node") == F.col("n"), "left")
    classes = classes.select("node", F.coalesce("component", "node").alias("component"))
    return signed.select("id", "node"), materialised(classes, "dedup-classes")


def near_duplicate_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SHINGLE,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Per row: id, class_id (least id of its class), class_size (rows).

    Texts are in one class if a chain of links of at least `threshold` joins them; words are
    what white space separates, and texts of fewer words than a shingle are one shingle. A null
    text is empty; all empty texts are equal, and texts of nothing but white space are linked
    with no other text. Rows with a null id take part, and class_id ignores their ids (null if a
    class has no other). Repeated rows are rows of the same class. Other columns are neither
    read nor returned.
    """
    rows, classes = _node_classes(_named(docs, id_col, text_col), size, threshold)
    counted = rows.groupBy("node").agg(F.min("id").alias("least"), F.count("*").alias("rows"))
    counted = counted.join(classes, "node")
    found = counted.groupBy("component").agg(
        F.min("least").alias("class_id"), F.sum("rows").alias("class_size")
    )
    of_node = counted.select("node", "component").join(found, "component").drop("component")
    of_node = materialised(of_node, "dedup-found")
    return rows.join(of_node, "node").select(F.col("id").alias(id_col), "class_id", "class_size")


def one_of_each(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SHINGLE,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The rows of docs without near duplicates: one row of every class, all columns kept.

    The row of the least id stays (nulls last, then the least text hash); of rows equal in id and
    text any one.
    """
    rows, classes = _node_classes(_named(docs, id_col, text_col), size, threshold)
    rank = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("node"))
    first = rows.groupBy("node").agg(F.min(rank).alias("first")).join(classes, "node")
    kept = first.groupBy("component").agg(F.min("first").alias("first"))
    kept = materialised(
        kept.select(F.col("first.node").alias("kept_node"), F.col("first.id").alias("kept_id")),
        "dedup-kept",
    )
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    text = F.coalesce(F.col(f"row.{text_col}").cast("string"), F.lit(""))
    mine = (F.col("node") == F.col("kept_node")) & F.col("id").eqNullSafe(F.col("kept_id"))
    keyed = packed.withColumn("node", F.unhex(F.md5(text))).withColumn("id", F.col(f"row.{id_col}"))
    return keyed.join(kept, mine).dropDuplicates(["node", "id"]).select("row.*")
