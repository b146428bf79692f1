"""Near-duplicate vectors by product quantisation (operator 8).

Equal unit vectors are made one class first. Coarse centroids split the space into inverted lists; a vector's residual to its centroid is cut into subspaces, each coded
by the nearest of CODES codewords. A query is compared with the lists it probes through a table of distances from its residual to every codeword (asymmetric: the
query is not quantised); candidates are ranked again by exact cosine in double precision.

Probes and candidates are sufficient, not a fixed number. With cosine c, unit vectors lie within r = sqrt(2 - 2c) of each other. A partner of the query can only be in
another list if that list's border with any list is at most r beyond the query along the border's normal, and if the query is at most r farther from the list's centroid
than its farthest member and at most r nearer than its nearest. A pair's difference lies along a given normal with r * sqrt(share) at most in the mean of squares, where share is the
part of the spread that lies along that normal: measured for each border in the sample's covariance and in that of its residuals, and taken as 1 / effective dimension (the participation ratio
of either covariance) at least, so vectors of many stored and few effective dimensions have wide margins. Borders are tested with MARGIN of these deviations, or with the whole r, which is certain,
where that is no more, and for queries of all lists that hold ends of the fitting sample's links, unless each of these links, measured along the list's borders, stays within two thirds of the margin.
So groups dense enough to shape centroids are probed with certainty however they are spread, and others with chance of 0.003 to lose a pair that lies just at the line
between two lists. Of two lists that may hold partners of each other, one is probed from the other, and a link found so counts for both its ends. A partner's table
distance is at most r plus the length of what its code leaves over, which is kept with each code, so no candidate is lost in a list. Centroids and codewords are fitted
on FIT_ROWS classes of least hash, a documented bound; every class is indexed. The number of lists is the root of the number of classes, within LISTS.

Lists are dealt out in blocks of BLOCK members and BLOCK queries to a task, each task returns the number of links of each of its queries and a spanning forest of the
links it found, never the pairs themselves; counts are added up and forests joined into components.

Vectors that are null, zero, or hold nulls or non-finite components link with nothing. Vectors of different dimension only link within their dimension. Rows of equal
vec_id and vector count as vectors of their own in n_links, and so do vectors of equal or null vec_id. Classes have ids of their own; a component is named by the least
vec_id in it, and is null only where all are. Ties do not arise: a pair either reaches the cosine or does not. Other columns are not read, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import functools
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .store import written

COSINE = 0.95
LISTS, SUBSPACES, CODES = (16, 4096), 8, 32
MARGIN = 3.0  # deviations of a pair's difference along a border's normal where pairs point anywhere
BORDERS = 8
FIT_ROWS = (8192, 32768)  # eight for each list, within these
BLOCK = 2048
SLACK = 1e-9
ROUNDING = 1e-5  # of table distances in single precision; candidates are ranked again in double


def _nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of each row's nearest centre, the first among equals."""
    at, least, own = np.zeros(len(x), np.int64), np.zeros(len(x)), (centres**2).sum(1)
    for a in range(0, len(x), 1024):
        part = x[a : a + 1024]
        d = (part**2).sum(1)[:, None] - 2 * part @ centres.T + own
        at[a : a + 1024] = d.argmin(1)
        least[a : a + 1024] = np.maximum(d.min(1), 0)
    return at, least


def k_means(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Centres from Lloyd rounds that begin with evenly spread distinct rows."""
    x = np.ascontiguousarray(x)
    own = np.unique(x, axis=0)
    centres = own[np.linspace(0, len(own) - 1, min(k, len(own))).astype(int)].copy()
    for _ in range(rounds):
        at, _ = _nearest(x, centres)
        n = np.bincount(at, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, at, x)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def _distances(x: np.ndarray) -> np.ndarray:
    """Between all rows, from inner products; single precision, never below the exact value."""
    square = (x**2).sum(1)
    out = np.empty((len(x), len(x)), np.float32)
    for a in range(0, len(x), 512):
        d = square[a : a + 512, None] + square - 2 * x[a : a + 512] @ x.T
        out[a : a + 512] = np.sqrt(np.maximum(d, 0)) * (1 + 1e-6) + 1e-6
    return out


def _spread(x: np.ndarray) -> tuple[np.ndarray, float]:
    """(R with R R' = the covariance over its trace, participation ratio: the number of dimensions over which the spread is even)."""
    values, vectors = np.linalg.eigh(np.cov(x, rowvar=False, bias=True).reshape(x.shape[1], x.shape[1]))
    values = np.maximum(values, 0)
    total = values.sum()
    if not total:
        return np.zeros((x.shape[1], 1)), 1.0
    return vectors * np.sqrt(values / total), float(total**2 / (values**2).sum())


class Quantiser:
    def __init__(self, sample: np.ndarray, lists: int):
        """sample: unit vectors of one dimension."""
        self.coarse = k_means(sample, lists)
        at, _ = _nearest(sample, self.coarse)
        self.edges = np.linspace(0, sample.shape[1], min(SUBSPACES, sample.shape[1]) + 1).astype(int)
        rest = sample - self.coarse[at]
        self.books = [k_means(rest[:, a:b], CODES) for a, b in zip(self.edges, self.edges[1:])]
        self.shares = [_spread(sample), _spread(rest)]

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "borders"}  # lists squared: made where it is used

    @functools.cached_property
    def borders(self) -> tuple[np.ndarray, np.ndarray]:
        """(list, list): the distance of the centroids, and that times the share of a difference along the border, as its root: single precision, rounded up."""
        between = _distances(self.coarse)
        along = between * max(1 / np.sqrt(ratio) for _, ratio in self.shares)
        for root, _ in self.shares:
            np.maximum(along, _distances(self.coarse @ root), out=along)
        return between, np.minimum(along, between)

    def code(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(list, codes, length of what the codes leave over) of each row."""
        at, _ = _nearest(x, self.coarse)
        rest = x - self.coarse[at]
        codes, over = np.empty((len(x), len(self.books)), np.uint8), np.zeros(len(x))
        for j, book in enumerate(self.books):
            codes[:, j], d = _nearest(rest[:, self.edges[j] : self.edges[j + 1]], book)
            over += d
        return at, codes, np.sqrt(over)

    def probes(self, x: np.ndarray, reach: float, shells: tuple[np.ndarray, np.ndarray] | None = None, whole: np.ndarray | bool = True, margin: float = MARGIN) -> np.ndarray:
        """(row, list): whether a vector within reach of the row can be in the list.

        shells: distances of each list's nearest and farthest member to its centroid; whole: of each row, whether borders are tested with the whole reach or with so many deviations as margin says.
        """
        d = (x**2).sum(1)[:, None] - 2 * x @ self.coarse.T + (self.coarse**2).sum(1)
        row, near = np.arange(len(x)), np.ones(d.shape, bool)
        between, along = self.borders
        whole = np.broadcast_to(np.asarray(whole), len(x))[:, None]
        n = min(BORDERS, d.shape[1])
        others = np.argpartition(d, n - 1, axis=1)[:, :n] if n < d.shape[1] else np.tile(np.arange(n), (len(x), 1))
        for other in others.T:  # borders with the nearest lists, the row's own among them
            wide = np.where(whole, between[other], np.minimum(between[other], margin * along[other]))
            near &= d - d[row, other][:, None] <= 2 * reach * wide + SLACK
        if shells is not None:
            least, most = shells
            near &= (d <= (most + reach + SLACK) ** 2) & (d >= np.maximum(least - reach - SLACK, 0) ** 2 - SLACK)
        return near

    def reaches(self, sample: np.ndarray, reach: float) -> np.ndarray:
        """Whether queries of each list probe with the whole reach: where two thirds of the margin lose a link of the sample. In slices; what is held of all is a bit per vector and list."""
        at, _ = _nearest(sample, self.coarse)
        near = np.concatenate([np.packbits(self.probes(sample[a : a + 1024], reach, whole=False, margin=MARGIN * 2 / 3), axis=1) for a in range(0, len(sample), 1024)])
        reached = lambda i, j: near[i, at[j] >> 3] >> (7 - (at[j] & 7)) & 1 > 0
        out = np.zeros(len(self.coarse), bool)
        for a in range(0, len(sample), 1024):
            i, j = np.nonzero(sample[a : a + 1024] @ sample.T >= 1 - reach**2 / 2)
            i = i + a
            out[at[i[~(reached(i, j) & reached(j, i))]]] = True
        return out

    def tables(self, x: np.ndarray, at: int) -> np.ndarray:
        """(subspace, code, row): squared distances from the rows' residuals to the codewords in a list."""
        rest = x - self.coarse[at]
        out = np.full((len(self.books), CODES, len(x)), np.inf, np.float32)
        for j, book in enumerate(self.books):
            own = rest[:, self.edges[j] : self.edges[j + 1]]
            out[j, : len(book)] = np.maximum((own**2).sum(1) - 2 * book @ own.T + (book**2).sum(1)[:, None], 0)
        return out


def _rows(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.float64).reshape(len(column), -1)


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect what the pairs connect, no more than there are ends."""
    parent: dict[int, int] = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist()):
        p, q = root(x), root(y)
        if p != q:
            parent[max(p, q)] = min(p, q)
            out.append((x, y))
    return out


def block(q: Quantiser, at: int, queries: pd.DataFrame, members: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Links from the queries to the members of one list: rows (a, null, count) and forest edges (a, b, null).

    A query of the list itself (own) meets its partners as queries too; a link of any other counts for the member as well.
    """
    none = pd.DataFrame({"a": pd.Series([], dtype="int64"), "b": pd.Series([], dtype="Int64"), "links": pd.Series([], dtype="Int64")})
    if queries.empty or members.empty:
        return none
    x, y = _rows(queries["unit"]), _rows(members["unit"])
    codes, over = np.frombuffer(b"".join(members["codes"]), np.uint8).reshape(len(y), -1), members["over"].to_numpy()
    qi, mi, size = queries["rep"].to_numpy(), members["rep"].to_numpy(), members["size"].to_numpy()
    own, weight = queries["own"].to_numpy(), queries["size"].to_numpy()
    reach = np.sqrt(2 - 2 * cosine)
    counts, back, forest = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64), []
    limit = ((reach + over + ROUNDING) ** 2).astype(np.float32)[:, None]
    for a in range(0, len(x), 256):
        part = x[a : a + 256]
        table, found = q.tables(part, at), []
        for b in range(0, len(y), 512):
            own_codes = codes[b : b + 512]
            far = table[0][own_codes[:, 0]]  # a row of the table for each member: all queries at once
            for j in range(1, codes.shape[1]):
                far += table[j][own_codes[:, j]]
            m, i = np.nonzero(far <= limit[b : b + 512])
            found.append((i, m + b))
        i, m = (np.concatenate(z) for z in zip(*found))
        other = qi[a + i] != mi[m]
        i, m = i[other], m[other]
        exact = np.einsum("ij,ij->i", part[i], y[m])
        hit = exact >= cosine
        i, m = i[hit], m[hit]
        counts[a : a + len(part)] = np.bincount(i, size[m], minlength=len(part)).astype(np.int64)
        once = ~own[a + i]
        back += np.bincount(m[once], weight[a + i[once]], minlength=len(y)).astype(np.int64)
        forest += _forest(qi[a + i], mi[m])
    ends = np.array(forest, np.int64).reshape(-1, 2)
    ends = np.array(_forest(ends[:, 0], ends[:, 1]), np.int64).reshape(-1, 2)
    ids, counts = np.concatenate([qi, mi]), np.concatenate([counts, back])
    some = np.flatnonzero(counts)
    return pd.DataFrame(
        {
            "a": np.concatenate([ids[some], ends[:, 0]]),
            "b": pd.array([None] * len(some) + ends[:, 1].tolist(), dtype="Int64"),
            "links": pd.array(counts[some].tolist() + [None] * len(ends), dtype="Int64"),
        }
    )


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of vectors."""
    spark = vectors.sparkSession
    own = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))

    def units(batches):
        """A usable vector's class key is the bytes of its unit vector."""
        for batch in batches:
            out = []
            for v in batch.column(1).to_pylist():
                x = np.array(v, float) if v and None not in v else np.zeros(0)
                norm = 0.0
                if len(x) and np.isfinite(x).all():
                    scale = np.abs(x).max()
                    x = x / scale if scale else x  # squares of very large or small numbers would not be finite, or zero
                    norm = np.sqrt((x**2).sum())
                out.append((x / norm + 0.0).tobytes() if norm else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["vec_id", "unit"])

    rows = written(own.mapInArrow(units, "vec_id long, unit binary"), "units")
    sizes = rows.filter("unit is not null").groupBy("unit").agg(F.min("vec_id").alias("name"), F.count("*").alias("size"))
    classes = written(sizes.withColumn("rep", F.monotonically_increasing_id()), "classes")  # as a table, so that the ids stay
    kinds = classes.groupBy(F.octet_length("unit").alias("bytes")).agg(F.count("*").alias("n")).filter("n > 1")  # a class alone has no links
    dims = sorted(r["bytes"] for r in kinds.collect())
    parts = []
    for n in dims:  # one for tables of one kind of vector
        parts.append(_links(classes.filter(F.octet_length("unit") == n), n // 8, cosine))
    many = len(parts) > 1
    while len(parts) > 1:  # in pairs, so that plans stay shallow
        parts = [reduce(DataFrame.unionByName, parts[k : k + 2]) for k in range(0, len(parts), 2)]
    found = parts[0] if parts else spark.createDataFrame([], "a long, b long, links long")
    if many:
        found = written(found, "found")
    counts = found.filter("links is not null").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    joined = components(found.filter("b is not null").select("a", "b"))
    named = classes.join(counts, "rep", "left").join(joined.withColumnRenamed("id", "rep"), "rep", "left")
    named = named.select("unit", "name", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component"))
    named = written(named, "named")
    names = named.groupBy("component").agg(F.min("name").alias("component_id"))
    named = written(named.join(names, "component").select("unit", "n_links", "component_id"), "named")  # a table, so that a hot vector's side of the join can be split
    return rows.join(named, "unit", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("component_id") == F.col("vec_id"), F.lit(True)).alias("kept"),
    )


def _links(classes: DataFrame, dimension: int, cosine: float) -> DataFrame:
    spark = classes.sparkSession
    lists = min(max(int(classes.count() ** 0.5), LISTS[0]), LISTS[1])
    sample = _rows(classes.orderBy(F.xxhash64("unit"), "rep").limit(min(max(8 * lists, FIT_ROWS[0]), FIT_ROWS[1])).select("unit").toPandas()["unit"])
    q = Quantiser(sample, lists)
    held = spark.sparkContext.broadcast(q)  # so many vectors, and CODES
    reach = float(np.sqrt(2 - 2 * cosine))
    whole = q.reaches(sample, reach)

    def index(batches):
        for batch in batches:
            x = _rows(batch.column(1).to_pylist())
            at, codes, over = held.value.code(x)
            far = np.sqrt(((x - held.value.coarse[at]) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(at, pa.int32()), batch.column(0), batch.column(2), batch.column(1), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(over), pa.array(far)],
                ["list", "rep", "size", "unit", "codes", "over", "far"],
            )

    own = classes.select("rep", "unit", "size")
    members = written(own.mapInArrow(index, "list int, rep long, size long, unit binary, codes binary, over double, far double"), "index")
    least, most = np.full(len(q.coarse), np.inf), np.full(len(q.coarse), -np.inf)
    for at, a, b in members.groupBy("list").agg(F.min("far"), F.max("far")).collect():  # a row per list
        least[at], most[at] = a, b
    filled = np.flatnonzero(np.isfinite(most))
    least[~np.isfinite(most)], most[~np.isfinite(most)] = 0, 0

    def probe(batches):
        q, lists = held.value, np.arange(len(held.value.coarse))
        for batch in batches:
            home = np.asarray(batch.column(0))
            near = q.probes(_rows(batch.column(2).to_pylist()), reach, (least, most), whole[home])
            apart = lists - home[:, None]
            near &= np.where((lists + home[:, None]) % 2 == 0, apart > 0, apart < 0)  # one of each two lists probes the other
            near[:, np.setdiff1d(lists, filled)] = False
            near[np.arange(len(home)), home] = True
            i, at = np.nonzero(near)
            take = pa.array(i)
            rest = [batch.column(n).take(take) for n in (1, 2, 3)]
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *rest, pa.array(at == home[i])], ["list", "rep", "unit", "size", "own"])

    queries = written(members.select("list", "rep", "unit", "size").mapInArrow(probe, "list int, rep long, unit binary, size long, own boolean"), "probes")
    blocks = lambda f, name: f.groupBy("list").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(name))  # noqa: E731  a row per list
    counts = F.broadcast(blocks(members, "m").join(blocks(queries, "n"), "list"))
    part = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = queries.join(counts, "list").withColumn("i", part("n")).withColumn("j", every("m")).select("list", "i", "j", "rep", "unit", "size", "own")
    right = members.join(counts, "list").withColumn("j", part("m")).withColumn("i", every("n")).select("list", "i", "j", "rep", "size", "unit", "codes", "over")

    def task(key, a, b):
        return block(held.value, int(key[0]), a, b, cosine)

    keys = ["list", "i", "j"]
    return written(left.groupBy(keys).cogroup(right.groupBy(keys)).applyInPandas(task, "a long, b long, links long"), "found")


def oracle() -> str:
    """The result in SQL: all pairs, and their components."""
    return """
        WITH RECURSIVE v AS (SELECT vec_id, cast(embedding AS DOUBLE[]) AS e FROM embeddings),
        u AS (SELECT * FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
        l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id WHERE len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
        n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a),
        r AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
        SELECT r.a AS vec_id, coalesce(any_value(n_links), 0) AS n_links, min(b) AS component_id, r.a = min(b) AS kept FROM r LEFT JOIN n ON r.a = n.a GROUP BY r.a"""
