"""Hard negatives by an inverted multi-index (operator 12).

A vector becomes whole numbers, floor(scale * x); a row's score for an anchor is their inner product, exact. An anchor's positives are the first rows of its label by score; for each, the negatives are the
first rows of other labels in a window of scores below the positive's. Ties go by the smaller id, null ids last.

Vectors are cut in two halves; each half has a codebook, and a pair of codewords is a cell. A half's score is at most the anchor's score with the codeword plus the anchor's length times the codeword's radius, the
distance of its farthest member; a cell's is the sum. A heap over the two sorted lists of bounds gives an anchor's cells from the highest bound down. Each of the two searches, positives and then negatives, goes
in two steps. First the cells that hold the first SEED rows are scored; what is found is a window's certain lower edge: the last of enough rows found. Then the heap goes on where it stopped, until the next cell's
bound is below the lowest such edge: no row beyond can be in a result, whatever the codebooks are. Where a window is not full its edge is the window's own, or none for positives, so all cells are visited.

Codebooks are fitted on a bounded sample, at most FIT_ROWS rows and FIT_BYTES; every row is indexed, and since stopping is certified the sample only changes how much is visited. Vectors meet only within
their dimension; one whose dimension the sample lacks is in a cell of its dimension's own, which is always visited. What the driver collects is a row per codeword or cell, CODEWORDS squared at most for a dimension.

Cells and the anchors that visit them are dealt in blocks of BLOCK, so a cell that holds a third of all rows is many tasks; a task returns the first few rows for each of its anchors, never its pairs. Of rows equal in
vector and label only the first few by id can be in any result (as many as are wanted and the anchor itself), so the others are left out of the index before, each task its own first; they are anchors all the same.

Rows with a null label or vector, an empty vector, null or non-finite components take no part; nor do those whose whole numbers' squares sum to 2**62 or more, as their scores may not fit 64 bits. Repeated rows are
rows of their own, so are rows of equal id. An empty table gives no rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .pq_neighbours import _nearest, k_means
from .store import written

FIT_ROWS, FIT_BYTES = 16384, 64 << 20
#: Rows in a cell that the number of codewords aims at, and the most codewords of a half.
CELL_ROWS, CODEWORDS = 512, 512
SEED = 4096
BLOCK, SLICE = 4096, 256
SLACK = 1e-9  # of bounds, against rounding, in parts of the lengths multiplied
FOREIGN = -1  # the cell of a dimension without codebooks
EXACT = float(1 << 53)  # doubles hold all whole numbers up to here


class Halves:
    """Two codebooks over vectors of one dimension."""

    def __init__(self, sample: np.ndarray, codewords: int):
        self.middle = sample.shape[1] // 2
        self.books = [k_means(x, codewords) if x.shape[1] else np.zeros((1, 0)) for x in (sample[:, : self.middle], sample[:, self.middle :])]
        self.radii = [np.full(len(b), -np.inf) for b in self.books]  # -inf: no member
        self.counts = np.zeros((len(self.books[0]), len(self.books[1])), np.int64)

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[:, : self.middle], x[:, self.middle :]

    def code(self, x: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Codeword of each half and the distance to it."""
        at = [_nearest(h, b)[0] for h, b in zip(self.halves(x), self.books)]
        return at, [np.sqrt(((h - b[i]) ** 2).sum(1)) for h, b, i in zip(self.halves(x), self.books, at)]

    def bounds(self, x: np.ndarray) -> list[np.ndarray]:
        """(row, codeword) of each half: the most that a member's half can score."""
        out = []
        for h, b, r in zip(self.halves(x), self.books, self.radii):
            length, reach = np.sqrt((h**2).sum(1))[:, None], np.sqrt((b**2).sum(1))
            with np.errstate(invalid="ignore"):
                out.append(np.where(np.isfinite(r), h @ b.T + length * r + SLACK * length * (reach + np.maximum(r, 0) + 1), -np.inf))
        return out

    def visits(self, first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int, int]]:
        """(bound, cell, rows) of each cell that has rows, from the highest sum of the two bounds down."""
        a, b = (np.argsort(-x, kind="stable")[: int(np.isfinite(x).sum())].tolist() for x in (first, second))
        heap = [(-(first[a[0]] + second[b[0]]), 0, 0)] if a and b else []
        width = len(second)
        while heap:
            bound, i, j = heapq.heappop(heap)
            if n := int(self.counts[a[i], b[j]]):
                yield -bound, a[i] * width + b[j], n
            if j + 1 < len(b):
                heapq.heappush(heap, (-(first[a[i]] + second[b[j + 1]]), i, j + 1))
            if j == 0 and i + 1 < len(a):
                heapq.heappush(heap, (-(first[a[i + 1]] + second[b[0]]), i + 1, 0))


def _vectors(column) -> np.ndarray:
    """Rows of one dimension."""
    return np.frombuffer(b"".join(column), np.int32).reshape(len(column), -1)


def _whole(rows: DataFrame, scale: float) -> DataFrame:
    """id (0 for null), known (whether there is one), label, anchor, dim and v, the vector as 32-bit whole numbers, of the rows that take part."""
    names = ["id", "known", "label", "anchor"]

    def run(batches):
        for batch in batches:
            own = batch.filter(pc.and_(batch.column("label").is_valid(), batch.column("vector").is_valid()))
            vectors, keep, out = own.column("vector"), [], []
            for k in range(len(own)):
                x = vectors[k].values
                if len(x) and not x.null_count:
                    with np.errstate(over="ignore", invalid="ignore"):
                        y = np.floor(scale * x.to_numpy())
                        fits = np.isfinite(x.to_numpy()).all() and (y**2).sum() < 2.0**62
                    if fits:
                        keep.append(k)
                        out.append(y.astype(np.int32))
            some = own.take(pa.array(keep, pa.int64()))
            more = [pa.array([len(y) for y in out], pa.int32()), pa.array([y.tobytes() for y in out], pa.binary())]
            yield pa.RecordBatch.from_arrays([*[some.column(n) for n in names], *more], [*names, "dim", "v"])

    return rows.mapInArrow(run, "id long, known boolean, label long, anchor boolean, dim int, v binary")


def _first(frame: DataFrame, per: list[str], n: int, *best: str) -> DataFrame:
    """The first n rows of each group: by the columns named, downwards, then ids and rows upwards; with their place as rank."""
    order = Window.partitionBy(*per).orderBy(*[F.desc(c) for c in best], F.desc("known"), "id", "row")
    return frame.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


class Index:
    """members: row, id, known, label, dim, v."""

    def __init__(self, members: DataFrame):
        self.spark = members.sparkSession
        sizes = members.agg(F.count("*"), F.max("dim")).first()
        wanted = min(FIT_ROWS, FIT_BYTES // (4 * (sizes[1] or 1)) + 1)
        share = min(1.0, 1.2 * wanted / max(sizes[0], 1))
        drawn = members.filter(F.pmod(F.xxhash64("v", "row"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
        sample = drawn.select("dim", "v").limit(wanted).toPandas()
        self.books: dict[int, Halves] = {}
        for dim, own in sample.groupby("dim"):
            rows = sizes[0] * len(own) / len(sample)
            self.books[int(dim)] = Halves(_vectors(own["v"]).astype(float), min(max(int((rows / CELL_ROWS) ** 0.5), 2), CODEWORDS))
        held = self.spark.sparkContext.broadcast(self.books)  # of the bounded sample

        def code(batches):
            for batch in batches:
                dims = np.asarray(batch.column("dim"))
                for dim in np.unique(dims):
                    own = batch.filter(pa.array(dims == dim))
                    x = _vectors(own.column("v").to_pylist())
                    if book := held.value.get(int(dim)):
                        (i, j), far = book.code(x.astype(float))
                    else:
                        i, j, far = np.full(len(x), FOREIGN), np.zeros(len(x), int), [np.zeros(len(x))] * 2
                    cell = np.where(i < 0, FOREIGN, i * (book.counts.shape[1] if book else 1) + j)
                    more = [pa.array(cell.astype(np.int32)), pa.array(far[0]), pa.array(far[1])]
                    yield pa.RecordBatch.from_arrays([*own.columns, *more], [*own.schema.names, "cell", "far1", "far2"])

        coded = members.select("row", "id", "known", "label", "dim", "v").mapInArrow(code, "row long, id long, known boolean, label long, dim int, v binary, cell int, far1 double, far2 double")
        self.members = written(coded, "cells")
        self.sizes = written(self.members.groupBy("dim", "cell").agg(F.count("*").alias("n"), F.max("far1").alias("far1"), F.max("far2").alias("far2")), "cell_sizes")
        for dim, cell, n, far1, far2 in self.sizes.filter(f"cell <> {FOREIGN}").collect():  # a row per cell
            book = self.books[dim]
            i, j = divmod(cell, book.counts.shape[1])
            book.counts[i, j] = n
            book.radii[0][i], book.radii[1][j] = max(book.radii[0][i], far1), max(book.radii[1][j], far2)
        self.held = self.spark.sparkContext.broadcast(self.books)

    def probes(self, anchors: DataFrame, seed: bool) -> DataFrame:
        """A row for each cell that an anchor visits: the seed cells, or those after them whose bound is not below the anchor's lowest edge.

        anchors: row, label, dim, v, tops, lows: each window's upper and lower edge; a null lower edge is none.
        """
        held = self.held

        def run(batches):
            for batch in batches:
                dims, lows = np.asarray(batch.column("dim")), batch.column("lows").to_pylist()
                take, cells = [], []
                for dim in np.unique(dims):
                    at = np.flatnonzero(dims == dim)
                    book = held.value.get(int(dim))
                    if book is None:
                        take += at.tolist() if seed else []
                        cells += [FOREIGN] * len(at) if seed else []
                        continue
                    first, second = book.bounds(_vectors(batch.column("v").take(pa.array(at)).to_pylist()).astype(float))
                    for k, a in enumerate(at.tolist()):
                        seen, least = 0, -np.inf if None in lows[a] else min(lows[a])
                        for bound, cell, n in book.visits(first[k], second[k]):
                            if seen < SEED:
                                seen += n
                                if not seed:
                                    continue
                            elif seed or bound < least:
                                break
                            take.append(a)
                            cells.append(cell)
                rows = batch.take(pa.array(take, pa.int64()))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(cells, pa.int32())], [*rows.schema.names, "cell"])

        return anchors.select("row", "label", "dim", "v", "tops", "lows").mapInArrow(run, "row long, label long, dim int, v binary, tops array<long>, lows array<long>, cell int")

    def search(self, anchors: DataFrame, seed: bool, same: bool, n: int) -> DataFrame:
        """anchor, top, score, id, known, row: the first n rows of each task for each window of its anchors, of the anchor's label (same; top is null) or of others."""
        probes = written(self.probes(anchors, seed), "probes")
        counts = probes.groupBy("dim", "cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("q"))
        counts = counts.join(self.sizes.select("dim", "cell", F.ceil(F.col("n") / BLOCK).cast("int").alias("m")), ["dim", "cell"])
        part = lambda k: F.pmod(F.xxhash64("row"), F.col(k)).cast("int")
        every = lambda k: F.explode(F.sequence(F.lit(0), F.col(k) - 1))
        left = probes.join(counts, ["dim", "cell"]).withColumn("i", part("q")).withColumn("j", every("m")).drop("q", "m")
        right = self.members.drop("far1", "far2").join(counts, ["dim", "cell"]).withColumn("j", part("m")).withColumn("i", every("q")).drop("q", "m")

        def task(queries: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
            return _score(queries, members, same, n)

        keys = ["dim", "cell", "i", "j"]
        return left.groupBy(keys).cogroup(right.groupBy(keys)).applyInPandas(task, "anchor long, top long, score long, id long, known boolean, row long")


def _best(scores: np.ndarray, mask: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the n highest masked scores of each row, the first columns among equals."""
    if scores.shape[1] > n and np.count_nonzero(mask) > 64 * len(scores):
        least = np.iinfo(np.int64).min if scores.dtype.kind == "i" else -np.inf
        held = np.where(mask, scores, least)
        mask = mask & (held >= np.partition(held, scores.shape[1] - n, axis=1)[:, -n, None])
    r, c = np.nonzero(mask)
    order = np.lexsort((c, -scores[r, c], r))
    r, c = r[order], c[order]
    place = np.arange(len(r)) - np.searchsorted(r, r)
    return r[place < n], c[place < n]


def _score(queries: pd.DataFrame, members: pd.DataFrame, same: bool, n: int) -> pd.DataFrame:
    out = {"anchor": [], "top": [], "score": [], "at": []}
    if len(queries) and len(members):
        members = members.sort_values(["known", "id", "row"], ascending=[False, True, True])
        x, y = _vectors(queries["v"]), _vectors(members["v"])
        squares = [(z.astype(float) ** 2).sum(1).max() for z in (x, y)]
        kind = float if np.sqrt(squares[0] * squares[1]) < EXACT else np.int64
        x, y = x.astype(kind), y.astype(kind)
        labels, rows, own, anchors = members["label"].to_numpy(), members["row"].to_numpy(), queries["label"].to_numpy(), queries["row"].to_numpy()
        windows = max(map(len, queries["lows"]))
        lowest, highest = (-np.inf, np.inf) if kind is float else (np.iinfo(np.int64).min, np.iinfo(np.int64).max)
        lows = np.full((len(x), windows), highest, kind)  # a window that an anchor lacks holds nothing
        tops = np.full((len(x), windows), lowest if not same else highest, kind)
        named = np.zeros((len(x), windows), np.int64)  # tops as they are
        for k, (low, top) in enumerate(zip(queries["lows"], queries["tops"])):
            lows[k, : len(low)] = [lowest if v is None or v != v else v for v in low]
            if not same:
                tops[k, : len(top)] = named[k, : len(top)] = top
        for a in range(0, len(x), SLICE):
            scores = x[a : a + SLICE] @ y.T
            fits = own[a : a + SLICE, None] == labels
            fits = fits & (anchors[a : a + SLICE, None] != rows) if same else ~fits
            for w in range(windows):
                mask = fits & (scores >= lows[a : a + SLICE, w, None]) & (scores <= tops[a : a + SLICE, w, None])
                r, c = _best(scores, mask, n)
                out["anchor"].append(anchors[a + r])
                out["top"].append(named[a + r, w])
                out["score"].append(scores[r, c])
                out["at"].append(c)
    whole = {k: np.concatenate(v).astype(np.int64) if v else np.zeros(0, np.int64) for k, v in out.items()}
    found = members.iloc[whole["at"]]
    top = pd.array([None] * len(found) if same else whole["top"], dtype="Int64")
    return pd.DataFrame({"anchor": whole["anchor"], "top": top, "score": whole["score"], "id": found["id"].to_numpy(), "known": found["known"].to_numpy(), "row": found["row"].to_numpy()})


def mine(vectors: DataFrame, anchor: Column, key: str = "vec_id", label: str | Column = "label", vector: str = "embedding", scale: float = 256, positives: int = 5, negatives: int = 5, window: tuple[int, int] = (80, 100)) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    anchor: which rows are anchors, over the columns of vectors; window: the least and the greatest share of the positive's score, in hundredths, that a negative has (a negative score has no such shares).
    """
    label = F.col(label) if isinstance(label, str) else label
    number = F.col(key).cast("long")
    own = vectors.select(F.coalesce(number, F.lit(0)).alias("id"), number.isNotNull().alias("known"), label.cast("long").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"), F.col(vector).cast("array<double>").alias("vector"))
    rows = written(_whole(own, scale).withColumn("row", F.monotonically_increasing_id()), "rows")
    index = Index(written(_first(rows, ["v", "label"], max(positives, negatives) + 1).drop("rank", "anchor"), "members"))
    state = written(rows.filter("anchor").drop("anchor"), "anchors")
    none = F.array(F.lit(None).cast("long"))

    seeds = written(_first(index.search(state.withColumns({"tops": none, "lows": none}), True, True, positives), ["anchor"], positives, "score"), "positive_seeds")
    edges = seeds.groupBy(F.col("anchor").alias("row")).agg(F.when(F.count("*") == positives, F.min("score")).alias("low"))
    more = index.search(state.join(edges, "row", "left").withColumns({"tops": none, "lows": F.array("low")}), False, True, positives)
    found = _first(seeds.drop("rank").unionByName(more), ["anchor"], positives, "score").drop("top", "rank")

    def share(hundredths: int, up: bool) -> Column:
        exact = F.col("score").cast("decimal(20,0)") * hundredths / 100
        return F.when(F.col("score") >= 0, (F.ceil(exact) if up else F.floor(exact)).cast("long"))

    found = written(found.withColumns({"top": share(window[1], False), "low": share(window[0], True)}), "positives")
    windows = written(found.filter("top is not null").groupBy("anchor", "top").agg(F.min("low").alias("low")), "windows")  # positives of one upper edge share a window

    def with_windows(frame: DataFrame) -> DataFrame:
        each = frame.groupBy(F.col("anchor").alias("row")).agg(F.collect_list(F.struct("top", "low")).alias("w"))  # a struct per positive
        return state.join(each.select("row", F.col("w.top").alias("tops"), F.col("w.low").alias("lows")), "row")

    seeds = written(_first(index.search(with_windows(windows), True, False, negatives), ["anchor", "top"], negatives, "score"), "negative_seeds")
    edges = seeds.groupBy("anchor", "top").agg(F.when(F.count("*") == negatives, F.min("score")).alias("edge"))
    sharper = windows.join(edges, ["anchor", "top"], "left").withColumn("low", F.coalesce("edge", "low"))
    more = index.search(with_windows(sharper), False, False, negatives)
    last = written(_first(seeds.drop("rank").unionByName(more), ["anchor", "top"], negatives, "score"), "negatives")

    given = lambda name: F.when(F.col("known"), F.col("id")).alias(name)
    pairs = found.select("anchor", "top", "low", given("positive_id"), F.col("score").alias("positive_score"))
    pairs = pairs.join(last.select("anchor", "top", F.col("rank").cast("int").alias("rank"), given("negative_id"), F.col("score").alias("negative_score")), ["anchor", "top"])
    named = pairs.filter("negative_score >= low").join(state.select(F.col("row").alias("anchor"), given("anchor_id")), "anchor")
    return named.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def digest_query(vectors: DataFrame) -> DataFrame:
    """Anchors are ids divisible by 100; labels of ids divisible by 7 are moved on by one of ten first."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors, F.col("vec_id") % 100 == 0, label=label)


def oracle() -> str:
    """The result in SQL: every anchor with every row."""
    return """
        WITH v AS (
          SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * cast(x AS DOUBLE))) AS e, len(embedding) AS n
          FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
          SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, cast(list_inner_product(a.e, b.e) AS BIGINT) AS score
          FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND a.n = b.n),
        p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
        SELECT p.anchor_id, positive_id, cast(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank, other_id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
        QUALIFY rank <= 5"""
