"""Near-duplicate documents by DartMinHash and banded joining (operator 5).

Elements are runs of SHINGLE words (all words of a shorter text), weighted by how often they occur. Hashed darts are thrown into each element's region: an
element of weight w has w unit cells, and in a cell the darts arrive as a Poisson process along the rank axis, drawn from the element's hash alone, so that all
documents that hold the element see the same darts. A document of total weight W takes the darts of rank below t / W, about t of them whatever its length;
each dart has a coordinate, and the earliest dart of a coordinate is its signature there. Two documents agree on a coordinate with a probability equal to their
weighted Jaccard similarity.

Exact copies are made one class first. Classes that agree on a whole band share a bucket. Each member is compared with the bucket's smallest id, on the whole
texts, where total weights allow a link, and links are closed into components. In buckets that still hold several components their members are then compared across
components: strangers with the members of the bucket's main component, whose texts are carried once however many buckets they share, and with each other. A task
returns the links that join components, never pairs. No bucket is expanded into its pairs.

Result: doc_id, class_id (smallest doc_id of the component), kept (doc_id = class_id). A text without words, or null, links with nothing. Rows of equal doc_id
and text are one document; texts of one doc_id stay apart unless they are alike; a null doc_id gets class null and is kept. A similarity of exactly 0.8 links. Texts of
any length are compared whole, in blocks of BLOCK_BYTES, a longer text as a block. Other columns, whatever their names, are left out, or carried in a struct by
keep_first(). An empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernels as K
from .components import components
from .store import written

SHINGLE = 5
THRESHOLD = (4, 5)  # similarity of 0.8 or more
COORDINATES, ROWS = 100, 5
DARTS = COORDINATES * (math.log(COORDINATES) + 3)
BLOCK = 1024
BLOCK_BYTES = 1 << 19
TASK_BYTES = 16 << 20


def elements(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of each unit cell: the n-th occurrence of a shingle in its document is a cell of its own."""
    start, end, first = K.words(data, offsets)
    hashes = K.spans(K.prefix(data), start, end)
    count = np.diff(first)
    h, at = K.windows(hashes, first[1:], SHINGLE)
    doc = np.searchsorted(first, at, "right") - 1
    short = np.flatnonzero((count > 0) & (count < SHINGLE))
    if len(short):
        total = np.zeros(len(short), K.U)
        for j in range(SHINGLE - 1):
            own = count[short] > j
            total[own] = total[own] * K.U(K.BASE) + hashes[first[short[own]] + j]
        h, doc = np.concatenate([h, K.mix(total + count[short].astype(K.U))]), np.concatenate([doc, short])
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    place = np.arange(len(h))
    nth = place - np.maximum.accumulate(np.where(again, 0, place))
    return K.mix(h + nth.astype(K.U) * K.U(K.MIX1)), doc


def signatures(cells: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """(n, COORDINATES) dart ids; rows of documents without cells are 0."""
    weight = np.bincount(doc, minlength=n)
    out = np.zeros(n * COORDINATES, K.U)
    todo, reach = weight > 0, np.where(weight > 0, DARTS / np.maximum(weight, 1), 0.0)
    while todo.any():
        best = np.full(n * COORDINATES, np.inf)
        live = np.flatnonzero(todo[doc])
        cell, own = cells[live], doc[live]
        rank, turn, slots, ranks, darts = np.zeros(len(live)), 0, [], [], []
        while len(cell):
            turn += 1
            dart = K.mix(cell + K.U(turn * K.BASE % (1 << 64)))
            rank = rank - np.log(((dart >> K.U(11)).astype(np.float64) + 1.0) * 2.0**-53)
            hit = rank < reach[own]
            cell, own, rank, dart = cell[hit], own[hit], rank[hit], dart[hit]
            slots.append(own * COORDINATES + (K.mix(dart ^ K.U(K.MIX2)) % K.U(COORDINATES)).astype(np.int64))
            ranks.append(rank)
            darts.append(dart)
        slot, rank, dart = np.concatenate(slots), np.concatenate(ranks), np.concatenate(darts)
        np.minimum.at(best, slot, rank)
        hit = rank == best[slot]
        out[slot[hit]] = dart[hit]
        empty = (~np.isfinite(best)).reshape(n, -1).any(1)
        todo &= empty
        reach = reach * 2
    return out.reshape(n, COORDINATES)


def _sign(batches):
    for batch in batches:
        data, offsets = K.buffers(batch.column(1))
        for a, b in K.blocks(offsets, BLOCK_BYTES):
            own = offsets[a : b + 1] - offsets[a]
            cells, doc = elements(data[offsets[a] : offsets[b]], own)
            s = signatures(cells, doc, b - a)
            bands = np.zeros((b - a, COORDINATES // ROWS), K.U)
            for j in range(ROWS):
                bands = K.mix(bands * K.U(K.BASE) + s[:, j::ROWS])
            bands = K.mix(bands + np.arange(bands.shape[1]).astype(K.U))
            weight = np.bincount(doc, minlength=b - a)
            full = weight > 0
            rows = np.flatnonzero(full)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(a, b - a).filter(pa.array(full)),
                    batch.column(2).slice(a, b - a).filter(pa.array(full)),
                    pa.array(weight[rows]),
                    pa.array(np.diff(own)[rows]),
                    pa.array(list(bands[rows].astype(np.int64)), pa.list_(pa.int64())),
                ],
                ["doc_id", "text_hash", "weight", "bytes", "bands"],
            )


def similar(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Whether each pair of texts has a weighted Jaccard similarity of THRESHOLD or more."""
    n = len(left)
    (ld, lo), (rd, ro) = K.buffers(left), K.buffers(right)
    out = np.zeros(n, bool)
    for a, b in K.blocks(lo + ro, BLOCK_BYTES):
        one = elements(ld[lo[a] : lo[b]], lo[a : b + 1] - lo[a])
        two = elements(rd[ro[a] : ro[b]], ro[a : b + 1] - ro[a])
        h, p = np.concatenate([one[0], two[0]]), np.concatenate([one[1], two[1]])
        order = np.lexsort((h, p))
        h, p = h[order], p[order]
        both = np.bincount(p[1:][(h[1:] == h[:-1]) & (p[1:] == p[:-1])], minlength=b - a)
        union = np.bincount(p, minlength=b - a) - both
        out[a:b] = (both * THRESHOLD[1] >= union * THRESHOLD[0]) & (union > 0)
    return out


def _verify(batches):
    for batch in batches:
        yes = pa.array(similar(batch.column(2), batch.column(3)))
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(yes), batch.column(1).filter(yes)], ["a", "b"])


def _across(ordered: bool):
    """Links between two sets of texts, on the whole texts: a spanning set of those that join different components; ordered: only from a smaller rep to a greater.

    A text's cells are marked in an array over all cells of the task, and its overlaps with all texts of the other set are sums over that array.
    """

    def run(key, left, right):
        import pandas as pd

        out = []
        if not left.empty and not right.empty:
            n = len(left)
            texts = pa.array([*left["text"], *right["text"]], pa.large_string())
            cells, doc = elements(*K.buffers(texts))
            _, code = np.unique(cells, return_inverse=True)
            first = np.searchsorted(doc, np.arange(len(texts) + 1))
            size = np.diff(first)
            label = np.concatenate([left["component"].to_numpy(), right["component"].to_numpy()])
            rep = np.concatenate([left["rep"].to_numpy(), right["rep"].to_numpy()])
            mark = np.zeros(len(cells) + 1, bool)
            for i in np.argsort(rep[:n], kind="stable").tolist():
                near = np.minimum(size[n:], size[i]) * THRESHOLD[1] >= np.maximum(size[n:], size[i]) * THRESHOLD[0]
                other = n + np.flatnonzero((label[n:] != label[i]) & near & (rep[n:] > rep[i] if ordered else True))
                if not len(other):
                    continue
                own = code[first[i] : first[i + 1]]
                mark[own] = True
                part = np.concatenate([code[first[j] : first[j + 1]] for j in other.tolist()])
                both = np.add.reduceat(mark[part].astype(np.int64), np.cumsum(size[other]) - size[other])
                mark[own] = False
                hit = other[both * THRESHOLD[1] >= (size[i] + size[other] - both) * THRESHOLD[0]]
                if len(hit):
                    names, at = np.unique(label[hit], return_index=True)
                    out += [(rep[i], rep[j]) for j in hit[at].tolist()]
                    label[np.isin(label, names)] = label[i]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return run


def _may_link(a: str, b: str):
    """Whether total weights allow a similarity of THRESHOLD."""
    return F.least(a, b) * THRESHOLD[1] >= F.greatest(a, b) * THRESHOLD[0]


def _strangers(named: DataFrame, texts: DataFrame) -> DataFrame | None:
    """Links between members of one bucket that its centre did not show, both not the centre; named: bucket, rep, weight, centre, component of all members.

    A bucket's largest component is its main one, members of others are strangers. A stranger is compared with the main component's members, whose texts are carried
    once for all buckets; strangers of several components in one bucket are compared with each other. Every side of a comparison is dealt in blocks of about BLOCK texts or TASK_BYTES bytes, whichever are
    more, so a task holds two blocks however many strangers or members there are.
    """
    counts = named.groupBy("bucket", "component").agg(F.count("*").alias("n"), F.count_if(F.col("rep") != F.col("centre")).alias("others"))
    mixed = counts.groupBy("bucket").agg(F.max(F.struct("n", "component", "others")).alias("main"), F.count("*").alias("kinds")).filter("kinds > 1")
    mixed = written(mixed.select("bucket", "kinds", F.col("main.component").alias("main"), F.col("main.others").alias("others")), "mixed")
    strange = written(named.filter("rep <> centre").join(mixed, "bucket").filter("component <> main").select("bucket", "rep", "weight", "bytes", "component", "main", "others", "kinds"), "strangers")
    if strange.isEmpty():
        return None
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    dealt = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    in_blocks = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("bytes") / TASK_BYTES)).cast("int")  # by texts and by bytes, whichever makes more

    # Strangers against main components: where the main component has the centre alone in the bucket, all was compared before.
    whole = named.select("rep", "weight", "bytes", "component").distinct()
    items = strange.filter("others > 0").select(F.col("main"), "rep", "weight", "bytes", "component").distinct()
    mains = whole.join(items.select(F.col("main").alias("component")).distinct(), "component", "left_semi")
    spread = mains.groupBy("component").agg(in_blocks.alias("n"), F.min("weight").alias("low"), F.max("weight").alias("high")).withColumnRenamed("component", "main")
    fits = (F.col("weight") * THRESHOLD[1] >= F.col("low") * THRESHOLD[0]) & (F.col("high") * THRESHOLD[1] >= F.col("weight") * THRESHOLD[0])
    items = written(items.join(spread, "main").filter(fits).select("main", "n", "rep", "component", "bytes"), "items")
    used = written(items.groupBy("main", "n").agg(in_blocks.alias("m")), "dealt")
    fresh = lambda names: [F.col(c).alias(c) for c in names]  # noqa: E731  columns of their own for either side
    sides, keys = fresh(["main", "i", "j", "rep", "component", "text"]), ["main", "i", "j"]
    left = items.drop("n").join(used, "main").withColumn("i", dealt("m")).withColumn("j", every("n")).join(texts, "rep").select(sides)
    right = mains.withColumnRenamed("component", "main").join(used, "main").withColumn("j", dealt("n")).withColumn("i", every("m")).join(texts, "rep").withColumn("component", F.col("main")).select(sides)
    found = written(left.groupBy(keys).cogroup(right.groupBy(keys)).applyInPandas(_across(False), "a long, b long"), "links")

    # Strangers against each other; equal sets of them are compared once.
    several = strange.groupBy("bucket").agg(
        F.count("*").alias("n"), in_blocks.alias("blocks"), F.min("component").alias("low"), F.max("component").alias("high"), F.bit_xor(F.xxhash64("rep")).alias("x"), F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("y")
    )
    sets = several.filter("low <> high").groupBy("n", "x", "y", "blocks").agg(F.min("bucket").alias("bucket")).select("bucket", "blocks")
    own = written(strange.join(sets, "bucket").select("bucket", "rep", "component", "blocks"), "sets")
    if own.isEmpty():
        return found
    carried = own.join(texts, "rep").withColumn("at", dealt("blocks"))
    sides, keys = fresh(["bucket", "i", "j", "rep", "component", "text"]), ["bucket", "i", "j"]
    left = carried.withColumn("i", F.col("at")).withColumn("j", every("blocks")).select(sides)
    right = carried.withColumn("j", F.col("at")).withColumn("i", every("blocks")).select(sides)
    more = written(left.groupBy(keys).cogroup(right.groupBy(keys)).applyInPandas(_across(True), "a long, b long"), "links")
    return found.unionByName(more)


def _classes(documents: DataFrame, key: str, text: str) -> DataFrame:
    """text_hash, class_id, first (whether the text stands for the class) of each text with words: a written table."""
    own = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    hashed = own.select("doc_id", "text", _hash("text"))
    signed = written(hashed.filter("doc_id is not null").mapInArrow(_sign, "doc_id long, text_hash string, weight long, bytes long, bands array<long>"), "signed")
    least = signed.groupBy("text_hash").agg(F.min(F.struct("doc_id", "weight", "bytes", "bands")).alias("x")).select("text_hash", F.col("x.doc_id").alias("name"), "x.weight", "x.bytes", "x.bands")
    classes = written(least.withColumn("rep", F.monotonically_increasing_id()), "classes")  # as a table, so that the ids stay; a doc_id may have several texts
    placed = classes.select("rep", "weight", "bytes", F.explode("bands").alias("bucket"))
    centres = placed.groupBy("bucket").agg(F.min(F.struct("rep", "weight")).alias("centre"), F.count("*").alias("n")).filter("n > 1")
    centres = written(centres.select("bucket", F.col("centre.rep").alias("centre"), F.col("centre.weight").alias("centre_weight")), "centres")  # a table, as below, so that a hot key's side of the join can be split
    shared = written(placed.join(centres, "bucket"), "buckets")

    needed = classes.join(shared.select("rep").distinct(), "rep", "left_semi").select("rep", "text_hash", F.col("name").alias("doc_id"))
    texts = written(hashed.join(needed, ["doc_id", "text_hash"]).select("rep", "text").dropDuplicates(["rep"]), "texts")
    side = lambda name: texts.select(F.col("rep").alias(name), F.col("text").alias(f"{name}_text"))

    def linked(pairs: DataFrame) -> DataFrame:
        whole = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "a_text", "b_text")
        return written(whole.mapInArrow(_verify, "a long, b long"), "links")

    pairs = shared.filter((F.col("rep") != F.col("centre")) & _may_link("weight", "centre_weight"))
    links = linked(pairs.select(F.col("centre").alias("a"), F.col("rep").alias("b")).distinct())
    first = components(links)
    named = shared.join(first.withColumnRenamed("id", "rep"), "rep", "left").select("bucket", "rep", "weight", "bytes", "centre", F.coalesce("component", "rep").alias("component"))
    more = _strangers(written(named, "members"), texts)
    final = first if more is None or more.isEmpty() else components(links.unionByName(more))
    named = classes.select("text_hash", "name", "rep").join(final.withColumnRenamed("id", "rep"), "rep", "left").select("text_hash", "name", F.coalesce("component", "rep").alias("component"))
    named = written(named, "named")
    names = named.groupBy("component").agg(F.min(F.struct("name", "text_hash")).alias("least"))
    first = (F.col("text_hash") == F.col("least.text_hash")).alias("first")
    return written(named.join(names, "component").select("text_hash", F.col("least.name").alias("class_id"), first), "named")  # a table, so that a hot text's side of the join can be split


def _hash(text: str):
    return F.md5(F.coalesce(F.col(text), F.lit(""))).alias("text_hash")


def near_duplicates(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, class_id, kept for each row of documents."""
    every = documents.select(F.col(key).cast("long").alias("doc_id"), _hash(text)).join(_classes(documents, key, text).drop("first"), "text_hash", "left")
    class_id = F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id")
    return every.select("doc_id", class_id).select("*", F.coalesce(F.col("class_id") == F.col("doc_id"), F.lit(True)).alias("kept"))


def keep_first(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class, all columns: of its smallest id, and the text of least hash where that id has several. Rows without an id or words stay, once each."""
    carried = F.struct(*documents.columns).alias("carried")
    own = documents.select(F.col(key).cast("long").alias("doc_id"), _hash(text), carried).join(_classes(documents, key, text), "text_hash", "left")
    free = F.col("doc_id").isNull() | F.col("class_id").isNull()
    kept = own.filter(free | (F.col("first") & (F.col("doc_id") == F.col("class_id"))))
    # What repeats among the few rows left of a class: equal texts of one id.
    return kept.withColumn("of", F.when(free, F.struct("doc_id", "text_hash", F.xxhash64("carried").alias("x"))).otherwise(F.struct("doc_id", "text_hash", F.lit(0).cast("long").alias("x")))).dropDuplicates(["of"]).select("carried.*")


def oracle() -> str:
    """The result in SQL: all pairs that share a shingle, and their components."""
    return r"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM documents WHERE text IS NOT NULL),
        s AS (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS shingle FROM w),
        c AS (SELECT doc_id, shingle, count(*) AS n FROM s GROUP BY ALL), t AS (SELECT doc_id, sum(n) AS total FROM c GROUP BY ALL),
        p AS (SELECT a.doc_id AS a, b.doc_id AS b, sum(least(a.n, b.n)) AS shared FROM c a JOIN c b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
        l AS (SELECT a, b FROM p JOIN t x ON a = x.doc_id JOIN t y ON b = y.doc_id WHERE 5 * shared >= 4 * (x.total + y.total - shared)),
        r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
        SELECT a AS doc_id, min(b) AS class_id, a = min(b) AS kept FROM r GROUP BY a"""
